"""Secret scans with corpus-wide ownership, DataFrame functions only.

One projection finds candidate secrets with their spans. The values are then
counted over the whole corpus: in how many distinct repositories and by how
many distinct owners each one occurs. A value that many owners hold is a
copied example; one that stays with few owners looks live.

Base kinds: ``assign`` (a key word, an equals sign or colon, a value of 6 or
more characters), ``access`` (AKIA and capitals or digits, 20 or more),
``hex`` (24 or more lower-case hex digits). Added kinds: ``github``,
``slack``, ``stripe``, ``jwt``, ``private_key``.

Counting is two plain aggregations, first per (value, repository, owner), so a
value held by a third of all rows arrives as one row a task.

The work on one text grows with its length and findings, not with their square.

Defined results: null and empty texts have no spans; spans count code points,
end exclusive; a null source is one owner of its own; rows that repeat a
doc_id share the sums of their findings; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.session import cut_lineage

BASE = ["assign", "access", "hex"]
MANY_OWNERS = 3
CHUNK = 128

# pattern, group that holds the value, least characters of that group
PATTERNS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    # a run of 24 or more: shorter runs cannot hold or start a match
    "hex": ("[0-9a-f]{24,}", 0, 24),
    "github": ("gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    "slack": ("xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    "stripe": ("[sr]k_live_[A-Za-z0-9]{16,}", 0, 24),
    "jwt": (r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 30),
    "private_key": ("-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
}
KINDS = list(PATTERNS)

_SPAN = "array<struct<start:int,rank:int,end:int,value:string>>"


def _bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running_sum(numbers: Column) -> Column:
    """Inclusive running sums of an array of ints (at least one).

    Appending to an array copies it, so sums run inside chunks of ``CHUNK``
    and then over the chunks' totals: work grows with the array's size times
    the chunk, and no array but the numbers of one chunk or the totals is
    ever copied a number at a time."""
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def sums(xs: Column) -> Column:
        return F.aggregate(xs, none, lambda acc, x: F.struct(
            (acc.at + x).alias("at"), F.concat(acc.out, F.array(acc.at + x)).alias("out")), lambda acc: acc.out)

    def chunked(xs: Column) -> Column:
        chunks = F.ceil(F.size(xs) / CHUNK).cast("int")
        inner = F.transform(F.sequence(F.lit(0), F.greatest(chunks - 1, F.lit(0))),
                            lambda c: sums(F.slice(xs, c * CHUNK + 1, F.lit(CHUNK))))
        return _bind(inner, joined)

    def joined(parts: Column) -> Column:
        before = F.concat(F.array(F.lit(0)), sums(F.transform(parts, F.array_max)))  # sums never fall
        return F.flatten(F.zip_with(parts, F.slice(before, 1, F.size(parts)),
                                    lambda part, base: F.transform(part, lambda x: x + base)))

    return _bind(numbers, chunked)


def _spans(text: Column, kind: str) -> Column:
    """Spans of one kind. The parts between matches and the matches alternate,
    so a running sum of their lengths gives every end."""
    pattern, group, least = PATTERNS[kind]
    rx = F.lit(pattern)
    whole = F.regexp_extract_all(text, rx, F.lit(0))
    value = F.regexp_extract_all(text, rx, F.lit(group))
    gaps = F.split(text, pattern, -1)
    rows = F.zip_with(F.arrays_zip(whole.alias("whole"), value.alias("value")), F.slice(gaps, 1, F.size(whole)),
                      lambda m, gap: F.struct(F.length(gap).alias("gap"), F.length(m["whole"]).alias("size"), m["value"].alias("value")))

    def placed(rows: Column) -> Column:
        ends = _running_sum(F.transform(rows, lambda r: r.gap + r.size))
        return F.zip_with(rows, ends, lambda r, end: F.struct(
            (end - r.size).alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), r.value.alias("value")))

    found = F.filter(_bind(rows, placed), lambda s: F.length(s.value) >= least)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPAN))


def detect(docs: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """doc_id, repository, owner and ``found``: spans by start, then kind,
    each with the hash of its value."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), repository.cast("string").alias("repository"),
                       owner.cast("string").alias("owner"), text.alias("text"))
    spans = F.array_sort(F.concat(*[_spans(F.col("text"), k) for k in KINDS]))
    names = F.array(*[F.lit(k) for k in KINDS])
    return rows.select("doc_id", "repository", "owner", F.transform(spans, lambda s: F.struct(
        F.element_at(names, s.rank + 1).alias("kind"), s.start.alias("start"), s.end.alias("end"),
        F.sha2(s.value, 256).alias("value"))).alias("found"))


def ownership(found: DataFrame, many_owners: int = MANY_OWNERS) -> DataFrame:
    """value, n_rows, n_repositories, n_owners, copied."""
    values = found.select("repository", "owner", F.explode("found.value").alias("value"))
    per_place = values.groupBy("value", "repository", "owner").agg(F.count("*").alias("n"))
    per_owner = per_place.groupBy("value", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("places"))
    # a repository belongs to one owner, so places of owners add up
    return per_owner.groupBy("value").agg(
        F.sum("n").alias("n_rows"), F.sum("places").alias("n_repositories"), F.count("*").alias("n_owners")).withColumn(
        "copied", F.col("n_owners") >= many_owners)


def scan(docs: DataFrame, repository: Column | None = None, owner: Column | None = None,
         many_owners: int = MANY_OWNERS) -> DataFrame:
    """doc_id, ``found``, and how many of its findings are copied examples or
    look live."""
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", F.col("source"), F.col("lang")) if repository is None else repository
    found = cut_lineage(detect(docs, repository, owner))
    kinds = ownership(found, many_owners).select("value", "copied")
    held = found.select("doc_id", F.explode("found.value").alias("value"))
    per_doc = held.join(kinds, "value").groupBy("doc_id").agg(
        F.count_if("copied").alias("n_copied"), F.count_if(~F.col("copied")).alias("n_live"))
    none = F.lit(0).cast("long")
    return found.join(per_doc, "doc_id", "left").select(
        "doc_id", "found", F.coalesce("n_copied", none).alias("n_copied"), F.coalesce("n_live", none).alias("n_live"))


def digest(scanned: DataFrame) -> DataFrame:
    line = lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))
    base = F.filter("found", lambda s: s.kind.isin(BASE))
    count = lambda k: F.size(F.filter("found", lambda s: s.kind == k)).cast("long").alias(f"n_{k}")
    return scanned.select(
        "doc_id", *[count(k) for k in BASE], F.sha2(F.array_join(F.transform(base, line), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("found", line), ",").alias("spans"), "n_copied", "n_live")
