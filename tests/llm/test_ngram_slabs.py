"""Cells, slabs and bounds of the n-gram join."""

import random

import brute
import numpy as np
from pyspark.sql import functions as F

from sessionlens.llm import ngram_join
from sessionlens.session import cut_lineage

SCHEMA = "doc_id long, text string"


def _near_copies(n, words, seed, edits):
    """Texts that differ from one base in some places each."""
    r = random.Random(seed)
    base = [f"w{r.randrange(10**6)}" for _ in range(words)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(words)] = f"e{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    return rows


def _cells(spark, rows, n, percent):
    docs = spark.createDataFrame(rows, SCHEMA)
    classes = ngram_join._classes(docs, n, percent, 1000)
    members = cut_lineage(ngram_join.cells(classes, percent)).withColumn("component", F.col("key"))
    return docs, classes, members


def test_linked_sets_share_the_spare_tokens_of_their_prefixes():
    r = np.random.default_rng(5)
    order = ngram_join.Order(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    seen = 0
    for percent in (80, 90):
        for _ in range(300):
            k = int(r.integers(1, 120))
            a = np.unique(r.integers(0, 2**40, k, dtype=np.uint64))
            b = np.unique(np.concatenate([r.permutation(a)[int(r.integers(0, 1 + k // 8)):],
                                          r.integers(0, 2**40, int(r.integers(0, 1 + k // 8)), dtype=np.uint64)]))
            inter, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
            if 100 * inter < percent * union:
                continue
            seen += 1
            shared = None
            for x in (a, b):
                size = len(x)
                prefix = order.first(x, size - ngram_join._least(size, percent) + ngram_join._spare(size, percent))
                shared = prefix if shared is None else np.intersect1d(shared, prefix)
            for x in (a, b):
                assert len(shared) >= ngram_join._spare(ngram_join._least(len(x), percent), percent)
    assert seen > 100


def test_pairs_do_not_depend_on_blocks_or_slabs(spark):
    rows = _near_copies(60, 90, 3, 4)
    _, classes, members = _cells(spark, rows, 3, 80)
    got = [sorted(map(tuple, ngram_join.candidate_pairs(members, classes, 80, block, weight).collect()))
           for block, weight in ((1024, 1 << 16), (4, 1 << 16), (4, 8), (1024, 8))]
    assert got[0] and all(g == got[0] for g in got)
    # every link is among them
    key = {i: ngram_join.class_key(next(ngram_join.token_sets([t.encode()], 3))) for i, t in rows}
    sets = [(key[i], brute.shingles(t, 3)) for i, t in rows]
    links = {tuple(sorted((x, y))) for k, (x, a) in enumerate(sets) for y, b in sets[:k]
             if x != y and 100 * len(a & b) >= 80 * len(a | b)}
    assert links and links <= set(got[0])


def test_long_texts_that_share_cells_move_their_points_once(spark):
    rows = _near_copies(20, 6000, 7, 2500)
    _, classes, members = _cells(spark, rows, 5, 80)
    if members.count() == 0:  # too far apart to meet at all
        return
    moved = ngram_join.slabs(members, classes, ngram_join.BLOCK_POINTS, ngram_join.SLAB_WEIGHT).agg(
        F.sum(F.octet_length("fine") + 24 * F.size("cells"))).first()[0]
    assert moved <= 10 * sum(len(t) for _, t in rows)


def test_both_ways_of_fetching_texts(spark, monkeypatch):
    rows = _near_copies(40, 60, 11, 5)
    exp = sorted(brute.jaccard_components(rows, 3, 80), key=repr)
    docs = spark.createDataFrame(rows, SCHEMA)
    for most in (1 << 19, 0):  # pairs sent to the texts, and shuffled
        monkeypatch.setattr(ngram_join.verify, "__defaults__", (most,))
        assert sorted(map(tuple, ngram_join.join_classes(docs, 3, 80, block_points=8).collect()), key=repr) == exp


def test_prefix_tokens_are_dealt_out_once(spark):
    """Cells and their members come from one pass over the prefixes: a scan
    for the tokens of the sample, and one for the others."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame(_near_copies(40, 60, 5, 3), SCHEMA)
    classes = ngram_join._classes(docs, 3, 80, 1000)
    n = classes.count()
    narrow = classes.select("key", "size", "prefix", "common")
    members = cut_lineage(ngram_join.cells(narrow.mapInArrow(counted, narrow.schema), 80))
    assert members.count() > 0 and n <= seen.value <= 2 * n
