"""The registered ``opN_*`` queries: each applies its operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.llm import (conversation_repair, decontaminate, license_scan, mixing, ngram_join, oracle, packing, pii,
                             quality_model, quality_rules, secret_scan, spelling, substring_dedup, warc)
from sessionlens.llm.tables import table
from sessionlens.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: Added personal-data kinds, scores, token ids and packings have no SQL: they are tested in tests/llm
ORACLE_SQL = {
    "op1_ngram_join": oracle.NGRAM_JOIN,
    "op3_decontamination": oracle.DECONTAMINATION,
    "op6_license_scan": oracle.LICENSE_SCAN,
    "op7_secret_scan": oracle.SECRET_SCAN,
    "op8_substring_dedup": oracle.SUBSTRING_DEDUP,
    "op9_quality_rules": oracle.QUALITY_RULES,
    "op10_warc_audit": oracle.WARC_AUDIT,
    "op11_conversation_repair": oracle.CONVERSATION_REPAIR,
    "op12_spelling_variants": oracle.SPELLING_VARIANTS,
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_ngram_join(spark, sf_dir):
    return ngram_join.join_classes(table(spark, sf_dir, "documents"), n=3, percent=90)


@query
def op2_pii(spark, sf_dir):
    return pii.digest(pii.detect(table(spark, sf_dir, "documents")))


@query
def op3_decontamination(spark, sf_dir):
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_quality(spark, sf_dir):
    return quality_model.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_packing(spark, sf_dir):
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


@query
def op6_license_scan(spark, sf_dir):
    return license_scan.digest(license_scan.scan(table(spark, sf_dir, "documents")))


@query
def op7_secret_scan(spark, sf_dir):
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


@query
def op8_substring_dedup(spark, sf_dir):
    return substring_dedup.digest(substring_dedup.dedup(table(spark, sf_dir, "documents")))


@query
def op9_quality_rules(spark, sf_dir):
    return quality_rules.measure(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


@query
def op10_warc_audit(spark, sf_dir):
    """Archives all pages into a replica that loses and alters some records by
    a rule on their ids, then audits the replica's files."""
    recs = warc.records(table(spark, sf_dir, "pages"))
    listed = warc.manifest(recs)
    rule = F.conv(F.substring("record_id", 1, 6), 16, 10).cast("long")
    damaged = recs.filter(rule % 59 != 0).withColumn(
        "html", F.when(rule % 53 == 0, F.translate("html", "aeiou", "eioua")).otherwise(F.col("html")))
    path = scratch_path(spark, "warc")
    warc.write_archive(damaged, path)
    return warc.audit(listed, warc.read_archive(spark, path))


@query
def op11_conversation_repair(spark, sf_dir):
    """Rows get faults by a checksum of ``conv_id:turn``; all are repaired."""
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.with_all(
        conversation_repair.repair(conversation_repair.damage(conversations)), conversations)


@query
def op12_spelling_variants(spark, sf_dir):
    """The documents' own words, one run in 97 with a letter left out."""
    return spelling.group(spelling.vocabulary(table(spark, sf_dir, "documents"), slip_one_in=97))


@query
def op13_source_mix(spark, sf_dir):
    return mixing.shares(table(spark, sf_dir, "documents"))
