"""The stages one by one against brute force, and the whole run."""

import brute
import pyarrow.parquet as pq

import corpus_pipeline
from conftest import SF_SMALL
from sessionlens.llm import pii, quality_rules
from sessionlens.llm.tables import DOCUMENT_COLUMNS, table


def test_stages(spark):
    docs = table(spark, SF_SMALL, "documents").cache()
    items = pq.read_table(f"{SF_SMALL}/benchmark.parquet").to_pandas()
    rows = {r.doc_id: r.text for r in docs.collect()}

    def step(name, docs):
        out = dict(corpus_pipeline.STAGES)[name](spark, docs, SF_SMALL).cache()
        assert out.columns == DOCUMENT_COLUMNS
        return out

    good = step("quality_rules", docs)
    kept = {r.doc_id for r in quality_rules.measure(docs).filter("kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept
    assert all(not brute.quality_base(rows[i])[-1] for i in kept)

    single = step("near_duplicates", good)
    left = [(r.doc_id, r.text) for r in single.collect()]
    groups = brute.jaccard_components([(i, rows[i]) for i in sorted(kept)], 5, 80)
    assert {i for i, _ in left} == {c for _, _, c in groups}

    clean = step("decontamination", single)
    judged = brute.contamination(left, zip(items.item_id.tolist(), items.text.tolist()))
    assert {r.doc_id for r in clean.collect()} == {i for i, _, _, _, bad in judged if not bad}

    masked = {r.doc_id: r for r in step("pii", clean).collect()}
    assert all(r.text == pii.masked(rows[i]) and r.n_chars == len(r.text) for i, r in masked.items())

    packed = dict(corpus_pipeline.STAGES)["packing"](spark, clean, SF_SMALL).collect()
    assert {r.doc_id for r in packed} == set(masked)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out.columns)
    rows = out.collect()
    used = {}
    for r in rows:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert rows and max(used.values()) <= 4096
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "pii", "packing"]
