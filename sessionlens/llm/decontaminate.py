"""Benchmark decontamination as a prefix-filtered set join.

Every benchmark item becomes windows of ``size`` words (a shorter item is one
window). A window is a set of short word shingles that a document must hold
completely, so one necessary prefix token per window is enough: the shingle
that fewest documents hold. The first pass counts in how many documents each
benchmark shingle occurs; the second joins the words of every document with
the prefix tokens, drops occurrences where the window would leave the text
(length and positional bounds) and compares the surviving windows word by
word.

The benchmark side travels in blocks of ``block_windows`` windows, each
broadcast for one narrow step over the documents. Documents are never
shuffled, and no block grows with them.

Defined results: null and empty texts have no words and no hits; an item
without words, or without an id, gives no window; repeated items with one id
count once; repeated documents are judged one by one; an empty benchmark
leaves every document clean; extra columns are kept by ``annotate``. Words are
compared by their 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.tables import id_text
from sessionlens.llm.textblock import ALNUM_WORDS, Block, blocks, ngram_hashes, signed, utf8

WINDOW = 13
SHINGLE = 3
BLOCK_WINDOWS = 1 << 18

_WINDOWS = "window long, item string, words array<long>"


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per distinct (window, item): the word hashes of the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for b in blocks(utf8(batch.column(1)), ALNUM_WORDS, lower=True):
                h = b.hashes()
                key, item, words = [], [], []
                for i in range(len(b)):
                    own = h[b.first[i]:b.first[i + 1]]
                    if len(own) == 0 or ids[b.rows + i] is None:
                        continue
                    n = min(size, len(own))
                    for at, k in enumerate(signed(ngram_hashes(own, n)).tolist()):
                        key.append(k)
                        item.append(ids[b.rows + i])
                        words.append(signed(own[at:at + n]).tolist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.int64()), pa.array(item, pa.string()), pa.array(words, pa.list_(pa.int64()))],
                    ["window", "item", "words"])

    pairs = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    return pairs.mapInArrow(run, _WINDOWS).dropDuplicates(["window", "item"])


class _Index:
    """One block of windows: word hashes padded to ``size``, their lengths,
    their items, and the shingles each holds."""

    def __init__(self, rows: list, size: int):
        by_key: dict[int, list] = {}
        for r in rows:
            by_key.setdefault(r.window, [r.words, []])[1].append(r.item)
        self.items = [sorted(v[1]) for v in by_key.values()]
        self.lengths = np.array([len(v[0]) for v in by_key.values()], np.int64)
        self.words = np.zeros((len(by_key), size), np.uint64)
        for i, v in enumerate(by_key.values()):
            self.words[i, :len(v[0])] = np.array(v[0], np.int64).view(np.uint64)
        # shingle -> windows and offsets; a short window is one shingle
        owner, offset, token, width = [], [], [], []
        for i, n in enumerate(self.lengths.tolist()):
            k = min(SHINGLE, n)
            for o, t in enumerate(ngram_hashes(self.words[i, :n], k).tolist()):
                owner.append(i)
                offset.append(o)
                token.append(t)
                width.append(k)
        self.owner = np.array(owner, np.int64)
        self.offset = np.array(offset, np.int64)
        self.token = np.array(token, np.uint64)
        self.width = np.array(width, np.int64)
        self.tokens = {k: np.unique(self.token[self.width == k]) for k in set(width)}

    def keep_prefix(self, frequency: dict[int, int]) -> None:
        """Keep each window's rarest shingle, by (documents holding it, hash)."""
        rank = np.array([frequency.get(t, 0) for t in signed(self.token).tolist()], np.int64)
        order = np.lexsort((self.token, rank, self.owner))
        first = np.ones(len(order), bool)
        first[1:] = self.owner[order[1:]] != self.owner[order[:-1]]
        keep = order[first]
        keep = keep[rank[keep] > 0]  # a shingle no document holds rules its window out
        self.owner, self.offset, self.token, self.width = (
            x[keep] for x in (self.owner, self.offset, self.token, self.width))
        by_token = np.argsort(self.token, kind="stable")
        self.owner, self.offset, self.token, self.width = (
            x[by_token] for x in (self.owner, self.offset, self.token, self.width))

    def candidates(self, b: Block, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, word at which it would start) pairs inside the bounds."""
        found_w, found_s = [], []
        for k in np.unique(self.width).tolist():
            mine = np.flatnonzero(self.width == k)
            token = self.token[mine]
            at = b.windows(k)
            grams = ngram_hashes(h, k)[at] if len(at) else np.zeros(0, np.uint64)
            lo = np.searchsorted(token, grams, "left")
            n = np.searchsorted(token, grams, "right") - lo
            some = n > 0
            at, lo, n = at[some], lo[some], n[some]
            pick = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            w = self.owner[mine[pick]]
            place = np.repeat(at, n)
            s = place - self.offset[mine[pick]]
            d = b.doc[place]
            inside = (s >= b.first[d]) & (s + self.lengths[w] <= b.first[d + 1])
            found_w.append(w[inside])
            found_s.append(s[inside])
        if not found_w:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_w), np.concatenate(found_s)

    def occurrences(self, b: Block, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The candidates whose words all agree."""
        w, s = self.candidates(b, h)
        for j in range(self.words.shape[1]):
            used = self.lengths[w] > j
            same = np.ones(len(w), bool)
            same[used] = h[s[used] + j] == self.words[w[used], j]
            w, s = w[same], s[same]
        return w, s


def _frequencies(docs: DataFrame, index) -> dict[int, int]:
    """Documents that hold each shingle of the block (at most its shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = index.value.tokens
        for batch in batches:
            total: dict[int, np.ndarray] = {k: np.zeros(len(t), np.int64) for k, t in tokens.items()}
            for b in blocks(utf8(batch.column(0)), ALNUM_WORDS, lower=True):
                h = b.hashes()
                for k, known in tokens.items():
                    at = b.windows(k)
                    if len(at) == 0 or len(known) == 0:
                        continue
                    grams = ngram_hashes(h, k)[at]
                    place = np.minimum(np.searchsorted(known, grams), len(known) - 1)
                    hit = known[place] == grams
                    pair = np.unique(np.stack([place[hit], b.doc[at[hit]]]), axis=1)
                    total[k] += np.bincount(pair[0], minlength=len(known))
            for k, known in tokens.items():
                some = np.flatnonzero(total[k])
                yield pa.RecordBatch.from_arrays([pa.array(signed(known[some])), pa.array(total[k][some])], ["token", "n"])

    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "token long, n long")
    return dict(counts.groupBy("token").agg(F.sum("n").alias("n")).toLocalIterator())


_WORDS, _HIT, _ITEMS = "_decontaminate_words", "_decontaminate_hit", "_decontaminate_items"


def _annotated(docs: DataFrame, benchmark: DataFrame, size: int, block_windows: int) -> DataFrame:
    spark = docs.sparkSession
    windows = item_windows(benchmark, size)
    n = windows.count()
    parts = max(1, -(-n // block_windows))
    windows = windows.withColumn("part", F.pmod(F.col("window"), F.lit(parts)))
    out = docs.select("*", F.lit(None).cast("int").alias(_WORDS), F.array().cast("array<int>").alias(_HIT),
                      F.array().cast("array<string>").alias(_ITEMS))
    for part in range(parts):
        index = _Index(windows.filter(F.col("part") == part).select("window", "item", "words").collect(), size)
        sent = spark.sparkContext.broadcast(index)
        index.keep_prefix(_frequencies(docs, sent))
        out = out.mapInArrow(_step(spark.sparkContext.broadcast(index), out.columns), out.schema)
    return out


def annotate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW,
             block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The documents with ``n_words``, ``hit_words`` (sorted numbers of words
    inside a window's occurrence) and ``items`` (sorted ids, as strings);
    columns of the documents with these names give way."""
    new = {"n_words": F.col(_WORDS), "hit_words": F.col(_HIT), "items": F.col(_ITEMS)}
    rows = _annotated(docs, benchmark, size, block_windows)
    return rows.select(*[c for c in docs.columns if c not in new], *[v.alias(k) for k, v in new.items()])


def _step(index, names: list[str]):
    text_at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        for batch in batches:
            hits = batch.column(names.index(_HIT)).to_pylist()
            items = batch.column(names.index(_ITEMS)).to_pylist()
            n_words: list[int] = []
            for b in blocks(utf8(batch.column(text_at)), ALNUM_WORDS, lower=True):
                w, s = ix.occurrences(b, b.hashes())
                n_words += np.diff(b.first).tolist()
                doc = b.doc[s]
                for i in np.unique(doc).tolist():
                    mine = np.flatnonzero(doc == i)
                    words = np.concatenate([np.arange(s[j], s[j] + ix.lengths[w[j]]) for j in mine]) - b.first[i]
                    row = b.rows + i
                    hits[row] = np.union1d(words, hits[row]).astype(np.int32).tolist()
                    items[row] = sorted({*items[row], *(x for j in np.unique(w[mine]) for x in ix.items[j])})
            cols = {name: batch.column(i) for i, name in enumerate(names)}
            cols[_WORDS] = pa.array(n_words, pa.int32())
            cols[_HIT] = pa.array(hits, pa.list_(pa.int32()))
            cols[_ITEMS] = pa.array(items, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(list(cols.values()), names)

    return run


def contaminated(hit_words: str = "hit_words", n_words: str = "n_words"):
    """The rule on ``annotate``'s columns: hits cover a twentieth of the words."""
    n_hit = F.size(hit_words).cast("long")
    return (n_hit > 0) & (F.lit(20) * n_hit >= F.col(n_words))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Counts, item digest and verdict of each document."""
    return annotate(id_text(docs), benchmark).select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    rows = _annotated(docs, benchmark, WINDOW, BLOCK_WINDOWS)
    return rows.filter(~contaminated(_HIT, _WORDS)).select(*docs.columns)
