"""Mixing sources to target weights, block by block.

1. *Targets.* The total number of words is shared among the sources by weight.
   A source stops at ``limit`` times its own words and the excess goes to the
   others by weight, until none is above: in the order of words per weight
   the stopped sources come first, so prefix sums over the sources give the
   level in one scan.
2. *Blocks.* The texts of a source, in a hash order of their ids, are one row
   of words, cut into blocks of ``block_words``. Places come from a keyed scan
   (range partitions with carried sums), so one source may hold most rows.
3. *Draws.* A source is due ``target / words`` of its blocks, in slots. Each
   output shard draws its source counts from a multinomial over the slots due.
   Slots drawn above what a source is due are exchanged, by a pseudorandom
   permutation, for those drawn too few, so every source gets what is due.
4. *Blocks by index.* A source's slot numbers run through its blocks, pass
   after pass, each pass in its own pseudorandom permutation of the block
   numbers (a Feistel cipher, walked until it falls inside the range). Slots
   and blocks meet in one equi-join on (source, block). No block is taken more
   than ``limit`` times, so no text is.

The driver holds a few numbers for each source (``MAX_SOURCES`` at most, else
an error). Everything depends on the seed and the rows only, so reruns agree.

Defined results: null and empty texts have size 0 and are never taken; a
source without words has target 0; a null source is one source, the last in
order; rows that repeat are rows of their own; an empty table gives an empty
result; extra columns are ignored. A word longer than any block is one word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.textblock import mix as scramble
from sessionlens.operators.ordering import keyed_scan
from sessionlens.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
LIMIT = 3
BLOCK_WORDS = 128
SHARD_SLOTS = 1 << 16
MAX_SOURCES = 1 << 20


# -- targets -------------------------------------------------------------------

def _sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, f (a hash of the text) and text of every row."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.xxhash64(text).alias("f"), text.alias("text"))


def targets(sized: DataFrame, weights=WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """source, no (its place by code point, null last), weight, source_size
    and target of every source of ``sized`` (source, size)."""
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("all", F.lit(0))
    ranked = keyed_scan(by, "all", ["source"], count_out="no")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("no") % len(weights) + 1).cast("int"))
    ranked = cut_lineage(ranked.withColumn("weight", weight.cast("long")).withColumn("most", F.col("source_size") * limit)
                         .withColumn("ratio", F.col("most") / F.col("weight")))
    whole = ranked.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).first()
    words, weights_sum = whole.words or 0, whole.weights or 0
    # the first source, by ratio, that the level does not stop
    scan = keyed_scan(ranked, "all", ["ratio", "no"], sum_cols=["most", "weight"])
    left, share = F.lit(words) - F.col("_sum_most"), F.lit(weights_sum) - F.col("_sum_weight")
    open_from = scan.filter(F.col("ratio") >= left / share).select(
        "ratio", "no", left.alias("left"), share.alias("share")).orderBy("ratio", "no").limit(1).collect()
    if not open_from:  # no source at all
        target = F.lit(0.0)
    else:
        o = open_from[0]
        stopped = (F.col("ratio") < o.ratio) | ((F.col("ratio") == o.ratio) & (F.col("no") < o.no))
        target = F.when(stopped, F.col("most").cast("double")).otherwise(F.lit(o.left) * F.col("weight") / F.lit(o.share))
    return ranked.select("source", "no", "weight", "source_size", target.cast("double").alias("target"))


# -- permutations ------------------------------------------------------------------

def permute(x: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Place of each ``x`` (0 <= x < n) in the permutation of 0 .. n - 1 that
    ``key`` names. Arrays of one length; ``n`` is at most 2**60."""
    x, n, key = x.astype(np.uint64), n.astype(np.uint64), key.astype(np.uint64)
    half = np.ones(len(x), np.uint64)  # bits of each half
    while (short := (np.uint64(1) << (half * np.uint64(2))) < n).any():
        half[short] += np.uint64(1)
    out, live = x.copy(), np.arange(len(x))
    while len(live):
        h, k = half[live], key[live]
        mask = (np.uint64(1) << h) - np.uint64(1)
        a, b = out[live] >> h, out[live] & mask
        for r in range(4):
            a, b = b, a ^ (scramble(b ^ scramble(k + np.full(len(k), r + 1, np.uint64))) & mask)
        out[live] = (a << h) | b
        live = live[out[live] >= n[live]]
    return out.astype(np.int64)


# -- slots ---------------------------------------------------------------------------

class Due:
    """Blocks, slots due and slots drawn of each source, by number."""

    def __init__(self, blocks: np.ndarray, slots: np.ndarray, seed: int):
        self.blocks, self.slots, self.seed = blocks, slots, seed
        self.drawn = np.zeros(len(slots), np.int64)

    def settle(self, drawn: np.ndarray) -> None:
        self.drawn = drawn
        over, under = np.maximum(drawn - self.slots, 0), np.maximum(self.slots - drawn, 0)
        self.over_from = np.cumsum(over) - over
        self.under_to = np.cumsum(under)
        self.under_from = self.under_to - under

    def key(self, *parts: np.ndarray) -> np.ndarray:
        out = np.full(len(parts[0]), self.seed, np.uint64)
        for p in parts:
            out = scramble(out * np.uint64(0x9E3779B97F4A7C15) + p.astype(np.uint64) + np.uint64(1))
        return out

    def place(self, source: np.ndarray, ordinal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Source, block and pass of the ``ordinal``-th slot drawn for ``source``."""
        slot = permute(ordinal, self.drawn[source], self.key(source, np.full(len(source), 1 << 40)))
        over = np.flatnonzero(slot >= self.slots[source])
        if len(over):
            source = source.copy()
            at = self.over_from[source[over]] + slot[over] - self.slots[source[over]]
            at = permute(at, np.full(len(at), self.under_to[-1]), self.key(np.full(len(at), 1 << 41)))
            to = np.searchsorted(self.under_to, at, side="right")
            source[over] = to
            slot[over] = self.drawn[to] + at - self.under_from[to]
        turn, index = slot // self.blocks[source], slot % self.blocks[source]
        return source, permute(index, self.blocks[source], self.key(source, turn)), turn


def slots(spark, due: Due, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """shard, place, no, block, turn: each slot of every output shard."""
    total = int(due.slots.sum())
    shards = -(-total // shard_slots)
    sent = spark.sparkContext.broadcast((due.slots, due.seed))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quota, seed = sent.value
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                n = min(shard_slots, total - shard * shard_slots)
                got = np.random.default_rng([seed, shard]).multinomial(n, quota / quota.sum())
                no = np.flatnonzero(got)
                got = got[no]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(no), shard)), pa.array(no), pa.array(got), pa.array(np.cumsum(got) - got),
                     pa.array(np.full(len(no), n))], ["shard", "no", "drawn", "before", "shard_n"])

    counts = cut_lineage(spark.range(shards).mapInArrow(draw, "shard long, no long, drawn long, before long, shard_n long"))
    drawn = np.zeros(len(due.slots), np.int64)
    for r in counts.groupBy("no").agg(F.sum("drawn").alias("drawn")).collect():  # one row a source
        drawn[r.no] = r.drawn
    due.settle(drawn)
    settled = spark.sparkContext.broadcast(due)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, no, n, before, shard_n, first in zip(*(c.to_pylist() for c in batch.columns)):
                d = settled.value
                source, block, turn = d.place(np.full(n, no), first + np.arange(n))
                place = permute(before + np.arange(n), np.full(n, shard_n), d.key(np.full(n, 1 << 42), np.full(n, shard)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, shard)), pa.array(place), pa.array(source), pa.array(block), pa.array(turn)],
                    ["shard", "place", "no", "block", "turn"])

    numbered = keyed_scan(counts, "no", ["shard"], sum_cols=["drawn"]).select(
        "shard", "no", "drawn", "before", "shard_n", F.col("_sum_drawn").cast("long").alias("first"))
    # Spark takes this for as small as the counts and would broadcast it; it has a row for each slot
    return numbered.mapInArrow(expand, "shard long, place long, no long, block long, turn long").hint("merge")


# -- blocks -----------------------------------------------------------------------------

def pieces(sized: DataFrame, sources: DataFrame, block_words: int = BLOCK_WORDS, with_text: bool = False) -> DataFrame:
    """no, block, doc_id, size, start (the text's words before it in its
    source), first, length and, on demand, words of every text's part in every
    block that it reaches."""
    keep = ["doc_id", "size", "no", "h", "f"] + (["text"] if with_text else [])
    rows = sized.filter("size > 0").withColumn("h", F.xxhash64("doc_id"))
    rows = rows.join(F.broadcast(sources.select(F.col("source").alias("s"), "no")), F.col("source").eqNullSafe(F.col("s"))).select(*keep)
    placed = keyed_scan(rows, "no", ["h", "doc_id", "size", "f"], sum_cols=["size"])
    start = F.col("_sum_size")
    low = lambda b: F.greatest(b * block_words - start, F.lit(0))
    high = lambda b: F.least((b + 1) * block_words - start, F.col("size"))
    if with_text:  # words are cut inside the array, so that no row carries its whole text on
        placed = placed.withColumn("w", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
        cut = lambda b: F.array_join(F.slice("w", (low(b) + 1).cast("int"), (high(b) - low(b)).cast("int")), " ")
        part = lambda b: F.struct(b.alias("block"), low(b).alias("first"), (high(b) - low(b)).alias("length"), cut(b).alias("words"))
    else:
        part = lambda b: F.struct(b.alias("block"), low(b).alias("first"), (high(b) - low(b)).alias("length"))
    reach = F.sequence(F.floor(start / block_words), F.floor((start + F.col("size") - 1) / block_words))
    return placed.select("no", "doc_id", "size", start.alias("start"), F.explode(F.transform(reach, part)).alias("p")).select(
        "no", "doc_id", "size", "start", "p.*")


def _due(sources: DataFrame, block_words: int, limit: int, seed: int) -> Due:
    known = sources.select("no", "source_size", "target").orderBy("no").limit(MAX_SOURCES + 1).collect()
    if len(known) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    size = np.array([r.source_size for r in known], np.int64)
    target = np.array([r.target for r in known], float)
    blocks = -(-size // block_words)
    wanted = np.divide(target * blocks, size, out=np.zeros(len(size)), where=size > 0)
    return Due(blocks, np.minimum(np.rint(wanted).astype(np.int64), limit * blocks), seed)


def mix(docs: DataFrame, weights=WEIGHTS, limit: int = LIMIT, block_words: int = BLOCK_WORDS,
        shard_slots: int = SHARD_SLOTS, seed: int = 7, with_text: bool = True) -> DataFrame:
    """The mixture: shard, place, turn, source, block, doc_id, first, length
    and words of every piece, where (shard, place) is a block of the output."""
    sized = _sizes(docs)
    sources = cut_lineage(targets(sized, weights, limit))
    drawn = slots(docs.sparkSession, _due(sources, block_words, limit, seed), shard_slots)
    cut = pieces(sized, sources, block_words, with_text)
    return drawn.join(cut, ["no", "block"]).join(F.broadcast(sources.select("no", "source")), "no").select(
        "shard", "place", "turn", "source", "block", "doc_id", "first", "length", *(["words"] if with_text else []))


def shares(docs: DataFrame, weights=WEIGHTS, limit: int = LIMIT, block_words: int = BLOCK_WORDS,
           shard_slots: int = SHARD_SLOTS, seed: int = 7) -> DataFrame:
    """doc_id, size, source_size, target and taken (words that the mixture
    takes, repeats counted) of every row."""
    sized = cut_lineage(_sizes(docs).drop("text"))
    sources = cut_lineage(targets(sized, weights, limit))
    drawn = slots(docs.sparkSession, _due(sources, block_words, limit, seed), shard_slots)
    cut = pieces(sized, sources, block_words)
    taken = F.coalesce(F.sum(F.when(F.col("place").isNotNull(), F.col("length"))), F.lit(0)).alias("taken")
    full = cut.join(drawn, ["no", "block"], "left").groupBy("no", "start", "doc_id", "size").agg(taken)
    facts = F.broadcast(sources.select("no", "source", "source_size", "target"))
    bare = sized.filter("size = 0").join(facts.drop("no"), sized["source"].eqNullSafe(facts["source"]))
    out = ["doc_id", "size", "source_size", "target", "taken"]
    return full.join(facts, "no").select(*out).unionByName(bare.withColumn("taken", F.lit(0).cast("long")).select(*out))
