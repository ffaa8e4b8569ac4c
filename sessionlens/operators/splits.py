"""User-level splits, row splits and samples (inventory rows 141-151).

Randomness is a hash order: ``md5("{seed}|{id}")``. The same order comes
out of Spark and DuckDB, and of any executor that recomputes a lost
partition, so splits are reproducible and survive retries (``rand()``
would not, unless the input order were fixed).

User splits rank users within their group in hash order. No group is sorted
in one task: ids are bucketed by a hash prefix (monotone in the hash order);
each (group, bucket) is ranked on its own, and bucket sizes (groups x 4096
rows at most) give the offsets. A group holding a third of all users is
spread over its buckets. Row splits and samples need no ranks: they find the
border rows by counting (``selection.borders``) and compare every row with
these, so rows stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.operators.selection import borders, reaches, with_borders
from sessionlens.schema import RANDOM_STATE, RARE_GROUP_THRESHOLD, ROW_ORD, SPLIT_RATIOS, TARGET, TEST_PRODUCT

BUCKET_CHARS = 3  # 16**3 = 4096 buckets per group


def hash_key(seed, id_col: str) -> Column:
    """The shuffle order: md5 of "{seed}|{id}"."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")))


def rank_by_hash(df: DataFrame, group_cols, hash_col: str, tie_col: str,
                 out: str = "_pos", size_out: str = "_n") -> DataFrame:
    """1-based position of each row within its group in (hash, tie) order,
    plus the group size."""
    g = list(group_cols)
    d = df.withColumn("_b", F.substring(hash_col, 1, BUCKET_CHARS))
    local = d.withColumn("_local", F.row_number().over(
        Window.partitionBy(*g, "_b").orderBy(hash_col, tie_col)))
    sizes = d.groupBy(*g, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    wg = Window.partitionBy(*g)
    offs = sizes.select(*g, "_b",
                        F.coalesce(F.sum("_cnt").over(wg.orderBy("_b").rowsBetween(
                            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
                        F.sum("_cnt").over(wg).alias(size_out))
    offs = offs.select(*[F.col(c).alias(f"_k_{c}") for c in [*g, "_b"]], "_off", size_out)
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in [*g, "_b"]]  # a null class is a group too
    return (local.join(offs, same, "inner")
                 .withColumn(out, F.col("_local") + F.col("_off"))
                 .drop("_b", "_local", "_off", *[f"_k_{c}" for c in [*g, "_b"]]))


def _assign(pos: Column, n: Column, ratios, mode: str) -> Column:
    """Split label from a position: first ratio0*n train, next ratio1*n val
    (capped at what is left), rest test. ``round`` = Python's half-even
    round, ``floor`` = int()."""
    f = (lambda x: F.bround(x, 0)) if mode == "round" else F.floor
    n1 = f(F.lit(float(ratios[0])) * n)
    n2 = F.least(f(F.lit(float(ratios[1])) * n), n - n1)
    return F.when(pos <= n1, "train").when(pos <= n1 + n2, "val").otherwise("test")


def user_labels(df: DataFrame, distinct_sessions: bool = True) -> DataFrame:
    """(user_id, label) with label ``"{n}_sessions_{k}_clicks"``."""
    sessions = F.count_distinct("session_id") if distinct_sessions else F.count("session_id")
    st = df.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        sessions.alias("_s"), F.coalesce(F.sum(TARGET), F.lit(0)).alias("_c"))
    return st.select("user_id", F.concat(F.col("_s").cast("string"), F.lit("_sessions_"),
                                         F.col("_c").cast("string"), F.lit("_clicks")).alias("label"))


def _with_group_size(users: DataFrame, col: str = "label") -> DataFrame:
    sizes = users.groupBy(col).agg(F.count(F.lit(1)).alias("_gsize"))
    return users.join(sizes, col)


def assign_user_splits(df: DataFrame, ratios=SPLIT_RATIOS, seed=RANDOM_STATE,
                       rare_threshold: int = RARE_GROUP_THRESHOLD, part: DataFrame | None = None) -> DataFrame:
    """(user_id, split): users grouped by behaviour label, labels with fewer
    than ``rare_threshold`` users merged into one "rare" group, each group
    cut in hash order by rounded ratios (row 141). ``part`` (user_id,
    _part) splits several user populations in the same pass, each with
    its own groups."""
    if abs(sum(ratios) - 1.0) > 1e-9:
        raise ValueError("Split ratios must sum to 1")
    u = user_labels(df)
    u = u.join(part, "user_id", "left") if part is not None else u
    u = u.withColumn("_part", F.coalesce(F.col("_part"), F.lit(False)) if part is not None else F.lit(False))
    sizes = u.groupBy("_part", "label").agg(F.count(F.lit(1)).alias("_gsize"))
    u = u.join(sizes, ["_part", "label"])
    u = u.withColumn("_grp", F.when(F.col("_gsize") < rare_threshold, F.lit("rare")).otherwise(F.col("label")))
    r = rank_by_hash(u.withColumn("_h", hash_key(seed, "user_id")), ["_part", "_grp"], "_h", "user_id")
    return r.select("user_id", _assign(F.col("_pos"), F.col("_n"), ratios, "round").alias("split"))


def split_by_user(df: DataFrame, ratios=SPLIT_RATIOS, seed=RANDOM_STATE,
                  rare_threshold: int = RARE_GROUP_THRESHOLD) -> DataFrame:
    """Rows with a ``split`` column; rows follow their user (row 141).
    Rows without a user get no split and are dropped, like the reference."""
    return df.join(assign_user_splits(df, ratios, seed, rare_threshold), "user_id", "inner")


def leave_one_product_out(df: DataFrame, product: str = TEST_PRODUCT, ratios=SPLIT_RATIOS,
                          seed=RANDOM_STATE, leave_out: bool = True) -> DataFrame:
    """Users who saw ``product`` and the other users are split apart (each
    with its own labels and groups, in one pass keyed by the population);
    then rows of ``product`` leave train (row 142)."""
    seen = (df.where(F.col("product") == product).select("user_id").distinct()
              .withColumn("_part", F.lit(True)))
    out = df.join(assign_user_splits(df, ratios, seed, part=seen), "user_id", "inner")
    if leave_out:
        out = out.where(~((F.col("split") == "train") & (F.col("product") == F.lit(product)))
                        | F.col("product").isNull())
    return out


def split_stats(split_df: DataFrame, total_rows: int | None = None) -> DataFrame:
    """Percent of rows (of ``total_rows``, default the split rows), CTR,
    users and mean sessions per user, by split (row 143)."""
    g = split_df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.avg(TARGET).alias("ctr"),
                                      F.count_distinct("user_id").alias("users"))
    if total_rows is None:
        # a handful of rows: one per split
        g = g.withColumn("_t", F.sum("rows").over(Window.partitionBy(F.lit(0))))
    else:
        g = g.withColumn("_t", F.lit(total_rows))
    return g.select("split", "rows", (F.col("rows") * 100.0 / F.col("_t")).cast("double").alias("pct_rows"),
                    "ctr", "users", (F.col("rows") / F.col("users")).alias("mean_sessions_per_user"))


def split_integrity(split_df: DataFrame, product: str = TEST_PRODUCT, ratios=SPLIT_RATIOS) -> DataFrame:
    """One row of checks: rows of the test product in train, users found in
    more than one split, and whether the ratios sum to 1 (row 144)."""
    in_train = split_df.agg(F.count(F.when((F.col("split") == "train") & (F.col("product") == product), 1))
                            .alias("test_product_rows_in_train"))
    multi = (split_df.groupBy("user_id").agg(F.count_distinct("split").alias("_k"))
                     .agg(F.count(F.when(F.col("_k") > 1, 1)).alias("users_in_several_splits")))
    return in_train.crossJoin(multi).withColumn("ratios_sum_to_one", F.lit(abs(sum(ratios) - 1.0) < 1e-9))


def assert_split_integrity(split_df: DataFrame, product: str = TEST_PRODUCT) -> None:
    r = split_integrity(split_df, product).first()
    if r["test_product_rows_in_train"] or r["users_in_several_splits"] or not r["ratios_sum_to_one"]:
        raise AssertionError(f"split integrity failed: {r.asDict()}")


def split_common_rare(df: DataFrame, ratios=SPLIT_RATIOS, seed=RANDOM_STATE, min_group: int = 6) -> DataFrame:
    """Labels (row counts, not distinct sessions) with at least
    ``min_group`` users are split per label by rounding; the other users are
    pooled and cut with int() sizes (row 145)."""
    u = _with_group_size(user_labels(df, distinct_sessions=False))
    u = u.withColumn("_common", F.col("_gsize") >= min_group)
    u = u.withColumn("_grp", F.when(F.col("_common"), F.col("label")).otherwise(F.lit("__rare__")))
    r = rank_by_hash(u.withColumn("_h", hash_key(seed, "user_id")), ["_grp"], "_h", "user_id")
    common = _assign_two_stage(F.col("_pos"), F.col("_n"), ratios)
    rare = _assign(F.col("_pos"), F.col("_n"), ratios, "floor")
    users = r.select("user_id", F.when(F.col("_common"), common).otherwise(rare).alias("split"))
    return df.join(users, "user_id", "inner")


def _assign_two_stage(pos: Column, n: Column, ratios) -> Column:
    """Train = round(r0 * n); the rest is cut again by r1 / (r1 + r2)."""
    n1 = F.bround(F.lit(float(ratios[0])) * n, 0)
    rest = n - n1
    n2 = F.bround(F.lit(float(ratios[1]) / float(ratios[1] + ratios[2])) * rest, 0)
    return F.when(pos <= n1, "train").when(pos <= n1 + n2, "val").otherwise("test")


def split_user_stratified(df: DataFrame, ratios=SPLIT_RATIOS, seed=RANDOM_STATE, min_group: int = 2) -> DataFrame:
    """Labels with fewer than ``min_group`` users are dropped; the rest are
    split per label in two stages (row 146). Rows of dropped users get no
    split, as in the reference."""
    u = _with_group_size(user_labels(df)).where(F.col("_gsize") >= min_group)
    r = rank_by_hash(u.withColumn("_h", hash_key(seed, "user_id")), ["label"], "_h", "user_id")
    users = r.select("user_id", _assign_two_stage(F.col("_pos"), F.col("_n"), ratios).alias("split"))
    return df.join(users, "user_id", "inner")


def _split_sizes(n: Column, ratios) -> tuple[Column, Column]:
    n1 = F.bround(F.lit(float(ratios[0])) * n, 0)
    return n1, n1 + F.least(F.bround(F.lit(float(ratios[1])) * n, 0), n - n1)


def split_stratified_rows(df: DataFrame, ratios=SPLIT_RATIOS, seed=RANDOM_STATE,
                          label: str = TARGET, id_col: str = ROW_ORD) -> DataFrame:
    """Row split keeping the class share: each class cut by rounded ratios
    in hash order of the (unique) row id (row 147)."""
    h = hash_key(seed, id_col)
    n1, n2 = _split_sizes(F.col("_n"), ratios)
    found = borders(df.select(label, id_col, h.alias("_hash")), [label], "_hash", id_col, F.array(n1, n2))
    tie = F.col(id_col)
    split = F.when(reaches(h, tie, 0), "train").when(reaches(h, tie, 1), "val").otherwise("test")
    return with_borders(df, found, [label]).withColumn("split", split).drop("_n", "_borders")


def holdout_split(df: DataFrame, test_size: float = 0.2, seed=RANDOM_STATE, id_col: str = ROW_ORD) -> DataFrame:
    """Unstratified split: ceil(test_size * n) rows to test (row 148)."""
    h = hash_key(seed, id_col)
    n_train = F.col("_n") - F.ceil(F.lit(float(test_size)) * F.col("_n"))
    found = borders(df.select(F.lit(0).alias("_all"), id_col, h.alias("_hash")), ["_all"], "_hash", id_col, F.array(n_train))
    split = F.when(reaches(h, F.col(id_col), 0), "train").otherwise("test")
    return with_borders(df.withColumn("_all", F.lit(0)), found, ["_all"]).withColumn("split", split).drop("_n", "_borders", "_all")


def balanced_samples(df: DataFrame, k: int = 5, ratio: int = 2, id_col: str = ROW_ORD) -> DataFrame:
    """``k`` samples: every click plus ``ratio`` x as many non-clicks drawn
    without replacement, sample i in hash order of seed i (row 149). A
    non-click is copied into the samples that take it and no others."""
    clicks = df.where(F.col(TARGET) == 1)
    non = df.where(F.col(TARGET) == 0)
    n_clicks = clicks.count()
    ids = F.array(*[F.lit(i) for i in range(k)])
    # counted in flight by (sample, hash prefix): nothing is shuffled but counts
    keys = non.select(id_col, F.explode(ids).alias("sample_id")).withColumn(
        "_hash", F.md5(F.concat_ws("|", F.col("sample_id").cast("string"), F.col(id_col).cast("string"))))
    found = borders(keys, ["sample_id"], "_hash", id_col, F.array(F.lit(n_clicks * ratio)))
    by = {r["_g_sample_id"]: r["_borders"][0] for r in found.collect()}  # a row a sample
    takes = []
    for i in range(k):
        b = by.get(i)
        if b is None:
            continue
        h = hash_key(i, id_col)
        inside = (h < b["h"]) | ((h == b["h"]) & (F.col(id_col) <= F.lit(b["t"])))
        takes.append(F.when(inside, F.lit(i)))
    taken = F.array_compact(F.array(*takes)) if takes else F.expr("CAST(array() AS array<int>)")
    return clicks.withColumn("sample_id", F.explode(ids)).unionByName(non.withColumn("sample_id", F.explode(taken)))


def kfold(df: DataFrame, k: int = 5, seed=RANDOM_STATE, id_col: str = ROW_ORD) -> DataFrame:
    """Shuffled k-fold: contiguous blocks of the hash order; the first
    n % k folds get one extra row (row 150)."""
    h, tie = hash_key(seed, id_col), F.col(id_col)
    n = F.col("_n")
    ends = F.array(*[F.floor(n / k) * (i + 1) + F.least(n % k, F.lit(i + 1)) for i in range(k - 1)])
    found = borders(df.select(F.lit(0).alias("_all"), id_col, h.alias("_hash")), ["_all"], "_hash", id_col, ends)
    fold = F.lit(k - 1)
    for i in reversed(range(k - 1)):
        fold = F.when(reaches(h, tie, i), F.lit(i)).otherwise(fold)
    return with_borders(df.withColumn("_all", F.lit(0)), found, ["_all"]).withColumn("fold", fold.cast("int")).drop(
        "_n", "_borders", "_all")


def balance_report(samples: DataFrame) -> DataFrame:
    """Rows per sample and class (row 151)."""
    return samples.groupBy("sample_id", TARGET).agg(F.count(F.lit(1)).alias("rows"))
