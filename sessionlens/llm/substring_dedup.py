"""Removal of repeated passages with phrase automata.

A phrase is ``size`` consecutive words. Every phrase that starts in two
documents belongs to the one with the smallest id; all others lose the words
it covers. Four steps, none of which gathers the corpus:

1. *Anchors.* In every window the least of the short word grams inside it (by
   hash) is its anchor, so equal windows have equal anchors. Texts are packed into compressed blocks of about 1 MB; each block
   reports its distinct anchors once.
2. *Confirm.* Windows whose anchor is known from two documents are candidates.
   Each block reports each distinct candidate window once, with the smallest
   document of the block that holds it; a minimum over all blocks confirms the
   recurring phrases and their owners.
3. *Compile.* Each block gets the phrases that one of its documents must lose:
   one shard of the phrase set. Their leading ``CUE`` words, taken from the
   block, become the patterns of an Aho-Corasick automaton over words (whole
   phrases would triple its nodes); each pattern lists its phrases.
4. *Stream.* All documents of the block run through its automaton, which finds
   every occurrence; those of a document after the owner are removed.

A passage held by a third of the corpus is one row a block in every shuffle,
and one pattern a block, so no key grows with its copies.

In the automaton a word is ``LETTERS`` characters of small alphabets, one
alphabet a place (it keeps the nodes' fan-out small, and matches start at
words only); a match counts only if the 64-bit hash of the whole window that
starts there is one of the pattern's phrases.

Defined results: null and empty texts have no words; texts shorter than a
phrase lose nothing; repeated rows of one ``doc_id`` are one owner, so none of
them loses words to another; rows without an id come last, after every id, and
never own a phrase that an id holds; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.llm.tables import id_text
from sessionlens.llm.textblock import BLOCK_BYTES, Block, covered, mix, ngram_hashes, signed, split_block, utf8
from sessionlens.session import cut_lineage

SIZE = 13
GRAM = 5
CUE = 4  # leading words of a phrase in the automaton
LETTERS, BITS = 3, 7
LAST = (1 << 63) - 1  # stands for a missing id

_BLOCKS = "ids array<long>, sizes array<int>, texts binary"


def pack_blocks(docs: DataFrame, target: int = BLOCK_BYTES) -> DataFrame:
    """Documents as rows of (block, ids, sizes, compressed texts), hash
    partitioned by block and checkpointed with that partitioning, so the later
    steps join by block without moving texts again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=6)
        for batch in batches:
            ids = [LAST if i is None else i for i in batch.column(0).to_pylist()]
            texts = utf8(batch.column(1))
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to]) <= target):
                    size += len(texts[to])
                    to += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[at:to]], pa.list_(pa.int64())),
                     pa.array([[len(t) for t in texts[at:to]]], pa.list_(pa.int32())),
                     pa.array([press.compress(b"".join(texts[at:to]))], pa.binary())], ["ids", "sizes", "texts"])
                at = to

    rows = id_text(docs).mapInArrow(run, _BLOCKS)
    # the name of a block must survive a retry: it depends on its content only
    rows = rows.withColumn("block", F.xxhash64("ids", "texts"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(rows.repartition(parts, "block"))


def _open(row: dict) -> tuple[np.ndarray, list[bytes], Block]:
    whole = zstandard.ZstdDecompressor().decompress(row["texts"]) if row["texts"] else b""
    edges = np.concatenate([[0], np.cumsum(row["sizes"], dtype=np.int64)])
    texts = [whole[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
    return np.array(row["ids"], np.int64), texts, split_block(texts)


def _anchors(b: Block, words: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows (their first words) and the anchor of each."""
    at = b.windows(size)
    if len(at) == 0:
        return at, np.zeros(0, np.uint64)
    grams = ngram_hashes(words, gram)
    best = grams[at]
    for k in range(1, size - gram + 1):
        best = np.minimum(best, grams[at + k])
    return at, mix(best)


def _distinct(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, and the smallest and the largest id of each."""
    if len(keys) == 0:
        return keys, ids[:0], ids[:0]
    order = np.argsort(keys)
    k, i = keys[order], ids[order]
    head = np.ones(len(k), bool)
    head[1:] = k[1:] != k[:-1]
    first = np.flatnonzero(head)
    return k[first], np.minimum.reduceat(i, first), np.maximum.reduceat(i, first)


def _anchor_rows(blocks: DataFrame, size: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, _, b = _open(row)
                at, anchor = _anchors(b, b.hashes(), size, gram)
                doc = b.doc[at]
                new = np.ones(len(at), bool)  # neighbouring windows mostly share their anchor
                new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
                keys, low, high = _distinct(anchor[new], ids[doc[new]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(keys)), pa.array(np.full(len(keys), row["block"])), pa.array(low != high)],
                    ["anchor", "block", "many"])

    return blocks.mapInArrow(run, "anchor long, block long, many boolean")


def recurring_anchors(blocks: DataFrame, size: int, gram: int) -> DataFrame:
    """block and its anchors known from two blocks, or from two documents of
    one. A block reports an anchor once, so the window over an anchor holds a
    row a block, however many documents share it."""
    same = Window.partitionBy("anchor")
    rows = _anchor_rows(blocks, size, gram).select(
        "anchor", "block", ((F.count("*").over(same) > 1) | F.max("many").over(same)).alias("known"))
    return rows.filter("known").groupBy("block").agg(
        F.collect_list("anchor").alias("anchors"))  # at most the windows of a block


def _windows(row: dict, size: int, gram: int):
    """Candidate windows of a block: their first words and hashes."""
    ids, texts, b = _open(row)
    words = b.hashes()
    at, anchor = _anchors(b, words, size, gram)
    known = np.sort(np.array(row["anchors"] or [], np.int64).view(np.uint64))
    if len(known) == 0 or len(at) == 0:
        return ids, texts, b, words, at[:0], np.zeros(0, np.uint64)
    place = np.minimum(np.searchsorted(known, anchor), len(known) - 1)
    at = at[known[place] == anchor]
    return ids, texts, b, words, at, ngram_hashes(words, size)[at]


def confirmed_phrases(blocks: DataFrame, size: int, gram: int) -> DataFrame:
    """block, phrase, owner: the phrases that some document of the block holds
    and a smaller one owns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, _, b, _, at, key = _windows(row, size, gram)
                keys, low, high = _distinct(key, ids[b.doc[at]])
                base = np.full(len(keys), ids.min() if len(ids) else 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), row["block"])), pa.array(signed(keys)), pa.array(base),
                     pa.array(low ^ base), pa.array(high ^ low)], ["block", "phrase", "base", "low", "high"])

    # ids travel as differences, which are mostly zero bytes
    held = blocks.mapInArrow(run, "block long, phrase long, base long, low long, high long")
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    low = F.col("base").bitwiseXOR(F.col("low"))
    held = held.repartition(parts, "phrase").select("block", "phrase", low.alias("low"), low.bitwiseXOR(F.col("high")).alias("high"))
    owner = F.min("low").over(Window.partitionBy("phrase"))  # a row a block
    return held.withColumn("owner", owner).filter(F.col("owner") < F.col("high")).select("block", "phrase", "owner")


def _as_text(words: np.ndarray) -> str:
    """``LETTERS`` characters a word: ``BITS`` bits of its hash each."""
    out = np.empty((len(words), LETTERS), "<u2")
    for k in range(LETTERS):
        out[:, k] = ((words >> np.uint64(k * BITS)) & np.uint64((1 << BITS) - 1)) + np.uint64((k + 2) << BITS)
    return out.tobytes().decode("utf-16-le")


def _removed(ids: np.ndarray, b: Block, words: np.ndarray, size: int, phrases: list[int],
             owner_ids: list[int]) -> np.ndarray:
    """Mask of the block's words that the automaton removes."""
    import ahocorasick

    mask = np.zeros(len(words), bool)
    if not phrases:
        return mask
    cue = min(CUE, size)
    text = _as_text(words)
    own = ngram_hashes(words, size)
    automaton = ahocorasick.Automaton()
    owners: dict[str, dict[int, int]] = {}
    order = np.argsort(own)
    wanted = np.array(phrases, np.int64).view(np.uint64)
    places = order[np.searchsorted(own[order], wanted)]  # each phrase is in the block
    for phrase, owner, place in zip(phrases, owner_ids, places.tolist()):
        owners.setdefault(text[LETTERS * place:LETTERS * (place + cue)], {})[phrase] = owner
    for pattern, by_hash in owners.items():
        automaton.add_word(pattern, by_hash)
    automaton.make_automaton()
    keys = signed(own).tolist()
    starts = []
    for i in range(len(b)):
        first, last = int(b.first[i]), int(b.first[i + 1])
        if last - first < size:
            continue
        me = int(ids[i])
        for end, by_hash in automaton.iter(text[LETTERS * first:LETTERS * last]):
            at = first + (end + 1) // LETTERS - cue
            owner = by_hash.get(keys[at]) if at + size <= last else None
            if owner is not None and owner < me:
                starts.append(at)
    return covered(len(words), np.array(starts, np.int64), size) if starts else mask


def dedup(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by one space."""
    blocks = pack_blocks(docs)
    candidates = blocks.join(recurring_anchors(blocks, size, gram), "block", "left").select(
        "block", "ids", "sizes", "texts", "anchors")
    phrases = confirmed_phrases(candidates, size, gram).groupBy("block").agg(
        F.collect_list("phrase").alias("phrases"), F.collect_list("owner").alias("owners"))  # at most the block's windows
    both = blocks.join(phrases, "block", "left").select("ids", "sizes", "texts", "phrases", "owners")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, _, b = _open(row)
                words = b.hashes()
                gone = _removed(ids, b, words, size, row["phrases"] or [], row["owners"] or [])
                left = np.concatenate([[0], np.cumsum(gone)])
                n = np.diff(b.first)
                cut = left[b.first[1:]] - left[b.first[:-1]]
                whole = b.data.tobytes()
                kept = []
                for i in range(len(b)):
                    span = np.arange(b.first[i], b.first[i + 1])
                    span = span[~gone[span]]
                    kept.append(b" ".join(whole[s:e] for s, e in zip(b.start[span].tolist(), b.end[span].tolist())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None if i == LAST else i for i in ids.tolist()], pa.int64()), pa.array(n), pa.array(cut),
                     pa.array([k.decode() for k in kept], pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return both.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def digest(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
