"""Row splits by border rows, and the level dictionary."""

import collections
import hashlib
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from sessionlens.operators import encode, selection, splits
from sessionlens.session import scratch_path


def _order(ids, seed):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}|{i}".encode()).hexdigest(), i))


def _rows(n):
    r = random.Random(n)
    return [(i, r.choice([0, 0, 0, 1, None]), "x" * (i % 3)) for i in range(n)]


def _df(spark, rows):
    return spark.createDataFrame(rows, "row_ord long, is_click int, _n_payload string").repartition(4)


@pytest.fixture(autouse=True, params=[(3, 1 << 14), (1, 2)])
def fine(request, monkeypatch):
    """The usual buckets, and ones so small that borders are refined again and again."""
    step, rows = request.param
    monkeypatch.setattr(selection, "STEP_CHARS", step)
    monkeypatch.setattr(selection.borders, "__defaults__", (rows,))


@pytest.mark.parametrize("n", [0, 1, 7, 200])
def test_holdout_and_folds(spark, n):
    df = _df(spark, _rows(n))
    order = _order(range(n), 42)
    test = -(-n * 2 // 10)
    got = {r.row_ord: r.split for r in splits.holdout_split(df).collect()}
    assert got == {i: "train" if p < n - test else "test" for p, i in enumerate(order)}
    folds = {r.row_ord: r.fold for r in splits.kfold(df, 3).collect()}
    sizes = [n // 3 + (i < n % 3) for i in range(3)]
    assert folds == dict(zip(order, [i for i in range(3) for _ in range(sizes[i])]))


def test_stratified_rows_keep_null_classes(spark):
    rows = _rows(150)
    got = {r.row_ord: r.split for r in splits.split_stratified_rows(_df(spark, rows)).collect()}
    ratios = splits.SPLIT_RATIOS
    for y in (0, 1, None):
        order = _order([i for i, c, _ in rows if c == y], 42)
        n1 = round(ratios[0] * len(order))
        n2 = min(round(ratios[1] * len(order)), len(order) - n1)
        assert [got[i] for i in order] == ["train"] * n1 + ["val"] * n2 + ["test"] * (len(order) - n1 - n2)


def test_balanced_samples_take_the_first_of_each_order(spark):
    rows = [(i, int(i % 7 == 0), "") for i in range(160)]
    got = splits.balanced_samples(_df(spark, rows), k=3, ratio=2).collect()
    clicks = [i for i, y, _ in rows if y]
    for s in range(3):
        mine = sorted(r.row_ord for r in got if r.sample_id == s)
        assert mine == sorted(clicks + _order([i for i, y, _ in rows if not y], s)[:2 * len(clicks)])
    few = splits.balanced_samples(_df(spark, [(1, 1, ""), (2, 1, ""), (3, 0, "")]), k=2).collect()
    assert sorted((r.sample_id, r.row_ord) for r in few) == [(s, i) for s in (0, 1) for i in (1, 2, 3)]
    assert splits.balanced_samples(_df(spark, [(1, 1, "")]), k=2).count() == 2


def test_no_payload_is_shuffled(spark):
    plan = splits.holdout_split(_df(spark, _rows(50)))._jdf.queryExecution().executedPlan().toString()
    above = plan.split("Exchange RoundRobinPartitioning")[0]  # of the fixture itself
    assert "hashpartitioning" not in above and "SortMergeJoin" not in above and "Window" not in above


def test_dictionary_numbers_levels_by_count(spark, monkeypatch):
    r = random.Random(1)
    rows = [(i, r.choice("aaabbc") if i % 9 else None, r.randint(0, 30)) for i in range(300)]
    df = spark.createDataFrame(rows, "row_ord long, a string, b int").repartition(3)
    new = spark.createDataFrame([(1, "c", 5), (2, "zz", None), (3, None, 99)], "row_ord long, a string, b int")
    model = encode.one_hot_pipeline(["a", "b"]).fit(df)
    exp = {}
    for c, k in (("a", 1), ("b", 2)):
        n = collections.Counter(str(x[k]) for x in rows if x[k] is not None)
        exp[c] = {v: i for i, v in enumerate(sorted(n, key=lambda v: (-n[v], v)))}
    path = scratch_path(spark, "ohe")
    model.write().overwrite().save(path)
    for most in (1 << 16, 0):
        monkeypatch.setattr(encode, "BROADCAST_LEVELS", most)
        for m in (model, PipelineModel.load(path)):
            for frame in (df, new):
                for x in encode.one_hot_positions(m, frame, ["a", "b"]).collect():
                    for c in "ab":
                        assert x[c + "_pos"] == (None if x[c] is None else exp[c].get(str(x[c])))
            v = {x.row_ord: (x.a_ohe, x.b_ohe) for x in m.transform(new).collect()}
            assert v[1][0].size == 3 and list(v[1][0].indices) == [exp["a"]["c"]] and v[2][0].numNonzeros() == 0
            assert v[1][1].size == len(exp["b"]) and v[3][1].numNonzeros() == 0


def test_many_levels_stay_off_the_driver(spark):
    df = spark.range(200_000).select(F.col("id").alias("row_ord"), (F.col("id") % 150_000).alias("a"))
    model = encode.LevelDictionary(inputCols=["a"], outputCols=["a_idx"]).fit(df)
    assert model.sizes() == {0: 150_000}
    out = model.transform(df).agg(F.count_distinct("a_idx"), F.max("a_idx")).first()
    assert tuple(out) == (150_000, 149_999.0)


def test_dummies_are_bounded(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "p string")
    assert encode.dummies(df, "p").columns == ["p", "p_a", "p_b"]
    with pytest.raises(ValueError):
        encode.dummies(df, "p", max_levels=1)
