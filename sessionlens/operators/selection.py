"""The k-th row of a hash order, found by counting (rows 147-150).

A split "first 80 % in hash order" needs the border row only, not every row's
rank. Rows are counted by the leading characters of their hash, one aggregate
that combines before its shuffle; running counts tell the bucket in which each
wanted rank falls, and only that bucket is counted again by more characters.
Once the border buckets are small, the rows in them are ranked. Every other row
is then placed by a comparison, so no payload is shuffled or sorted, whatever
the size of a group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.session import cut_lineage

STEP_CHARS = 3  # 16**3 = 4096 buckets a step
BORDER_ROWS = 1 << 14
BROADCAST_BORDERS = 1 << 16
HASH_CHARS = 32  # of an md5


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def _small(df: DataFrame) -> DataFrame:
    """Borders are a row a group and rank; broadcast while their counted number is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_BORDERS else df


def borders(keys: DataFrame, group_cols, hash_col: str, tie_col: str, ranks: Column,
            border_rows: int = BORDER_ROWS) -> DataFrame:
    """The border rows of each group: group columns (prefixed ``_g_``), ``_n``
    (rows of the group) and ``_borders``, for each wanted rank the (hash, tie)
    of the row at this place (1-based), null for ranks below 1.

    ``ranks`` is an array of longs over ``_n``; ranks above ``_n`` mean the
    last row. (hash, tie) must be unique in a group; hashes are md5 strings.
    """
    g = list(group_cols)
    k = [f"_g_{c}" for c in g]
    keys = keys.select(*[F.col(c).alias(x) for c, x in zip(g, k)], F.col(hash_col).alias("_h"), F.col(tie_col).alias("_t"))
    chars = STEP_CHARS
    counts = cut_lineage(keys.groupBy(*k, F.substring("_h", 1, chars).alias("_b")).agg(F.count(F.lit(1)).alias("_cnt")))
    sizes = counts.groupBy(*k).agg(F.sum("_cnt").alias("_n"))
    wanted = sizes.select(*k, "_n", F.posexplode(ranks).alias("_i", "_want")).select(
        *k, "_n", "_i", F.least(F.col("_want").cast("long"), F.col("_n")).alias("_r"))
    asked = wanted.where("_r >= 1").select(*k, "_i", "_r", F.lit("").alias("_p"))
    hit = _refine(counts, asked, k)
    while chars < HASH_CHARS and (hit.agg(F.max("_cnt")).first()[0] or 0) > border_rows:
        near = _inside(keys, hit, k, chars)
        chars = min(HASH_CHARS, chars + STEP_CHARS)
        counts = cut_lineage(near.groupBy(*k, F.substring("_h", 1, chars).alias("_b")).agg(F.count(F.lit(1)).alias("_cnt")))
        hit = _refine(counts, hit.select(*k, "_i", F.col("_rest").alias("_r"), F.col("_b").alias("_p")), k)
    # the rows of the border buckets, ranked
    rows = _inside(keys, hit, k, chars).withColumn("_b", F.substring("_h", 1, chars))
    ranked = rows.withColumn("_pos", F.row_number().over(Window.partitionBy(*k, "_b").orderBy("_h", "_t")))
    at = hit.select(*[F.col(c).alias(f"_r{c}") for c in k], F.col("_b").alias("_rb"), "_i", "_rest")
    found = ranked.join(_small(at), _same(k, [f"_r{c}" for c in k]) & (F.col("_b") == F.col("_rb")) & (F.col("_pos") == F.col("_rest")))
    found = found.select(*k, F.col("_i").alias("_fi"), F.struct(F.col("_h").alias("h"), F.col("_t").alias("t")).alias("_border"))
    found = found.select(*[F.col(c).alias(f"_f{c}") for c in k], "_fi", "_border")
    both = wanted.join(found, _same(k, [f"_f{c}" for c in k]) & (F.col("_i") == F.col("_fi")), "left")
    return cut_lineage(both.groupBy(*k).agg(
        F.first("_n").alias("_n"),
        F.transform(F.array_sort(F.collect_list(F.struct("_i", "_border"))), lambda x: x["_border"]).alias("_borders")))


def _refine(counts: DataFrame, asked: DataFrame, k: list[str]) -> DataFrame:
    """The bucket of each asked rank inside its prefix, its size, and the rank in it."""
    deep = counts.join(_small(asked.select(*[F.col(c).alias(f"_a{c}") for c in k], "_i", "_r", "_p")),
                       _same(k, [f"_a{c}" for c in k]) & F.col("_b").startswith(F.col("_p")))
    w = Window.partitionBy(*k, "_i").orderBy("_b")  # at most 4096 buckets
    deep = deep.withColumn("_upto", F.sum("_cnt").over(w))
    hit = deep.where((F.col("_r") <= F.col("_upto")) & (F.col("_r") > F.col("_upto") - F.col("_cnt")))
    return cut_lineage(hit.select(*k, "_i", "_b", "_cnt", (F.col("_r") - F.col("_upto") + F.col("_cnt")).alias("_rest")))


def _inside(keys: DataFrame, hit: DataFrame, k: list[str], chars: int) -> DataFrame:
    buckets = hit.select(*[F.col(c).alias(f"_a{c}") for c in k], F.col("_b").alias("_ab")).distinct()
    return keys.join(_small(buckets), _same(k, [f"_a{c}" for c in k]) & (F.substring("_h", 1, chars) == F.col("_ab")), "left_semi")


def with_borders(df: DataFrame, found: DataFrame, group_cols) -> DataFrame:
    """``df`` with ``_n`` and ``_borders`` of each row's group."""
    g = list(group_cols)
    return df.join(_small(found), _same(g, [f"_g_{c}" for c in g])).drop(*[f"_g_{c}" for c in g])


def reaches(hash_col, tie_col, i: int) -> Column:
    """Whether a row lies at or before border ``i`` of its group."""
    border = F.col("_borders")[i]
    key = F.struct(hash_col.alias("h"), tie_col.alias("t"))
    return F.coalesce(key <= border, F.lit(False))
