"""The mixture of sources: targets, permutations, blocks."""

import collections
import random
import re

import numpy as np
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from sessionlens.llm import mixing
from sessionlens.llm.tables import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, size long, no long, h long, start long, place long"


def water(sizes, weights=(1, 2, 3), limit=3):
    """Targets by resharing the excess until no source is above its stop."""
    order = sorted((s is None, s) for s in sizes)
    weight = {s: weights[i % len(weights)] for i, (_, s) in enumerate(order)}
    total, stopped = sum(sizes.values()), {}
    while True:
        rest = {s for s in sizes if s not in stopped}
        level = (total - sum(stopped.values())) / max(1, sum(weight[s] for s in rest))
        above = {s for s in rest if limit * sizes[s] < level * weight[s] * (1 - 1e-12)}
        if not above:
            return {s: stopped.get(s, level * weight[s]) for s in sizes}
        stopped.update({s: limit * sizes[s] for s in above})


def check(rows, got, block):
    exp = [(i, s, len(WORD.findall(t or ""))) for i, t, s in rows]
    sizes = collections.Counter()
    for _, s, n in exp:
        sizes[s] += n
    target = water(sizes)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted((i is None, i or 0, n) for i, _, n in exp)
    by_target = collections.defaultdict(lambda: [0, set()])
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        by_target[round(r.target, 6), r.source_size][0] += r.taken
    want = collections.Counter()
    for s, t in target.items():
        want[round(t, 6), sizes[s]] += t
    assert set(by_target) == set(want)
    for k, t in want.items():
        assert abs(by_target[k][0] - t) <= 2 * block * sum(sizes[s] == k[1] for s in sizes)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 5, 6, 7, 8, 9) for i, t, s in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    out = [(None, "a b c", "x"), (1, None, "x"), (2, "", None), (3, " \t\n", "empty"), (4, "w " * 4000, "long"), (4, "w " * 4000, "long")]
    out += [(10 + i, " ".join("t" * r.randint(1, 9) for _ in range(r.randint(0, 90))), r.choice(["hot"] * 8 + ["b", "c", None, "É", "e"]))
            for i in range(400)]
    return out + [out[-1], (2000, "one", "tiny")]


@pytest.mark.parametrize("block,shard", [(8, 16), (64, 1 << 16)])
def test_shares(spark, rows, block, shard):
    got = mixing.shares(frame(spark, rows), block_words=block, shard_slots=shard).collect()
    check(rows, got, block)
    again = mixing.shares(frame(spark, rows).repartition(5), block_words=block, shard_slots=shard).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_one_source_far_above_the_rest_stops_all_others(spark):
    rows = [(i, "w " * 50, f"s{i:02}") for i in range(20)] + [(99, "w " * 100000, "z")]
    check(rows, mixing.shares(frame(spark, rows), block_words=10, shard_slots=64).collect(), 10)


def test_the_mixture_holds_the_words(spark, rows):
    """Blocks are whole, each pass takes a block once, words come from the texts."""
    df = frame(spark, rows)
    got = mixing.mix(df, block_words=16, shard_slots=32).collect()
    shares = mixing.shares(df, block_words=16, shard_slots=32).collect()
    assert sum(r.taken for r in shares) == sum(r.length for r in got)
    blocks = collections.defaultdict(list)
    for r in got:
        assert len(r.words.split(" ")) == r.length
        blocks[r.shard, r.place].append(r)
    assert len({(b[0].source, b[0].block, b[0].turn) for b in blocks.values()}) == len(blocks)
    size = collections.Counter(sum(r.length for r in b) for b in blocks.values())
    assert max(size) == 16 and size[16] > 0.9 * len(blocks)
    places = collections.defaultdict(set)
    for shard, place in blocks:
        places[shard].add(place)
    assert all(p == set(range(len(p))) for p in places.values())
    assert sorted(len(p) for p in places.values())[1:] == [32] * (len(places) - 1)
    texts = collections.defaultdict(set)
    for i, t, _ in rows:
        texts[i].add(tuple(WORD.findall(t or "")))
    assert all(any(" ".join(t[r.first:r.first + r.length]) == r.words for t in texts[r.doc_id]) for r in got)
    # every shard draws near its share
    hot = collections.Counter(b[0].shard for b in blocks.values() if b[0].source == "hot")
    assert max(hot.values()) - min(hot.values()) < 28


def test_permutations():
    for n in (1, 2, 3, 5, 64, 65, 1000):
        for k in (0, 7):
            out = mixing.permute(np.arange(n), np.full(n, n), np.full(n, k))
            assert sorted(out.tolist()) == list(range(n))


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mixing.shares(none).collect() == [] and mixing.mix(none).collect() == []
    blank = frame(spark, [(1, None, None), (2, "", "a")])
    assert sorted(map(tuple, mixing.shares(blank).collect())) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_query(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text", "source").collect()
    check([tuple(r) for r in docs], E.queries()["op13_source_mix"](spark, SF_SMALL).collect(), mixing.BLOCK_WORDS)


def test_slots_meet_the_blocks_in_a_shuffle(spark, rows, capsys):
    """The slots grow with the texts, which Spark's estimate does not see: broadcast, they would go through the driver."""
    df = frame(spark, rows)
    for out in (mixing.shares(df, block_words=16), mixing.mix(df, block_words=16)):
        capsys.readouterr()
        out.explain()
        assert re.findall(r"(\w+Join) \[no#\w+, block#\w+\]", capsys.readouterr().out) == ["SortMergeJoin"]
