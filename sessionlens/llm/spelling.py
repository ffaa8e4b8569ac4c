"""Spelling variants grouped with PartEnum signatures.

1. *Words.* Letter runs (A-Z, a-z, U+00C0 to U+00FF) of every text, A-Z in
   lower case, counted by block of texts and then over all documents.
2. *Signatures.* A word's letter multiset is a binary vector with one
   dimension for each (letter, occurrence). Words one edit apart differ in at
   most two dimensions: an insertion or deletion changes one, a replacement
   two. The dimensions are dealt into ``PARTS`` parts by a hash; leaving out
   any two parts gives a word's signatures, and two vectors that differ in at
   most two dimensions agree on the signature that leaves those parts out.
3. *Equi-join.* Words meet under equal signatures: one row for each (word,
   signature), shuffled by the signature. A signature held by more than
   ``group_rows`` words is split by a second exact key, the hash of a word
   with one letter left out: near words share one of those, so they meet in
   one of the buckets that the hashes pick, and no task takes a whole hot
   signature.
4. *Verification.* Inside a signature two words are near if one less a letter
   is the other, or both less the letter at one position are equal. The words
   less a letter are hashed and sorted, so no pairs of a signature are listed;
   equal hashes are compared letter by letter. Anagrams stay apart here.
5. *Forms and roots.* Each word's most frequent near word, if frequent enough,
   is its form. Roots come by pointer doubling over the forms.

Defined results: null and empty texts have no words; a null id counts as an
empty one; repeated rows count again; an empty table gives an empty result;
extra columns are ignored; equal counts go to the smallest word by code point.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.tables import id_text
from sessionlens.llm.textblock import BLOCK_BYTES, LOWER, code_points, mix, signed, span_hashes, utf8
from sessionlens.session import cut_lineage

MIN_LETTERS = 5
MIN_COUNT = 3
PARTS = 4
GROUP_ROWS = 16_384
CHUNK_LETTERS = 1 << 20
BROADCAST_HOT = 1 << 18  # two longs each

_ASCII = np.zeros(256, bool)
_ASCII[0x61:0x7B] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


# -- words -------------------------------------------------------------------

class Runs:
    """Letter runs of some texts: ``data`` with A-Z in lower case, and each
    run's text number, first and last byte. U+00C0 to U+00FF are the byte
    0xC3 and the byte behind it."""

    def __init__(self, texts: list[bytes]):
        self.data = LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
        letter = _ASCII[self.data] | (self.data == 0xC3)
        letter[1:] |= self.data[:-1] == 0xC3
        edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
        if len(letter) and letter[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[::2], edge[1::2]  # a blank ends the data
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.doc = np.searchsorted(ends, self.start, side="right")
        self.size = code_points(self.data)[self.end] - code_points(self.data)[self.start]


def word_counts(docs: DataFrame, slip_one_in: int | None = None, min_letters: int = MIN_LETTERS) -> DataFrame:
    """word and its n in each block of texts, for words of ``min_letters`` or
    more. ``slip_one_in``: a run leaves out the letter that the checksum of
    ``id:run`` picks, when this number divides the checksum."""

    def one_block(ids: list, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        found = Runs(texts)
        long = np.flatnonzero(found.size >= min_letters)
        start, end, doc = found.start[long], found.end[long], found.doc[long]
        hashes = span_hashes(found.data, start, end)
        if slip_one_in:  # a run is counted for each text, as its slip depends on the id
            hashes = mix(hashes + doc.astype(np.uint64) * _STEP)
        _, at, n = np.unique(hashes, return_index=True, return_counts=True)
        raw = found.data.tobytes()
        total: dict[bytes, int] = {}
        seeds = [zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids]
        for s, e, k, d in zip(start[at].tolist(), end[at].tolist(), n.tolist(), doc[at].tolist()):
            word = raw[s:e]
            if slip_one_in and (h := zlib.crc32(word, seeds[d])) % slip_one_in == 0:
                text = word.decode()
                word = (text[:h % len(text)] + text[h % len(text) + 1:]).encode()
            total[word] = total.get(word, 0) + k
        return [w.decode() for w in total], np.fromiter(total.values(), np.int64, len(total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), utf8(batch.column(1))
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to]) <= BLOCK_BYTES):
                    size += len(texts[to])
                    to += 1
                words, n = one_block(ids[at:to], texts[at:to])
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], ["word", "n"])
                at = to

    return id_text(docs).mapInArrow(run, "word string, n long").filter(F.length("word") >= min_letters)


def vocabulary(docs: DataFrame, slip_one_in: int | None = None, min_letters: int = MIN_LETTERS,
               min_count: int = MIN_COUNT) -> DataFrame:
    """word and n of the words that are long and frequent enough."""
    counts = word_counts(docs, slip_one_in, min_letters)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# -- letters of a batch --------------------------------------------------------

class Letters:
    """Code points of a batch of words, one after the other."""

    def __init__(self, words: list[str]):
        self.code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
        self.size = np.array([len(w) for w in words], np.int64)
        self.first = np.zeros(len(words) + 1, np.int64)
        np.cumsum(self.size, out=self.first[1:])
        self.word = np.repeat(np.arange(len(words)), self.size)
        self.at = np.arange(len(self.code)) - self.first[self.word]

    def dimensions(self) -> np.ndarray:
        """Hash of each letter's (letter, occurrence) in its word."""
        order = np.lexsort((self.code, self.word))
        code, word = self.code[order], self.word[order]
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (word[1:] != word[:-1])
        start = np.flatnonzero(new)
        occurrence = np.arange(len(code)) - np.repeat(start, np.diff(np.append(start, len(code))))
        out = np.empty(len(code), np.uint64)
        out[order] = mix(code * _STEP + occurrence.astype(np.uint64))
        return out

    def less_one(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each whole word, and of its word less each letter."""
        # position-weighted sums: letters behind the gap count one place less
        power = np.ones(int(self.size.max(initial=0)) + 1, np.uint64)
        power[1:] = _STEP
        power = np.multiply.accumulate(power)
        seen = mix(self.code + np.uint64(1))
        total = np.zeros(len(seen) + 1, np.uint64)
        np.cumsum(seen * power[self.at], out=total[1:])
        shifted = np.zeros(len(seen) + 1, np.uint64)
        np.cumsum(seen * power[np.maximum(self.at - 1, 0)], out=shifted[1:])
        end = self.first[1:][self.word]
        here = np.arange(len(seen))
        before = total[here] - total[self.first[self.word]]
        behind = shifted[end] - shifted[here + 1]
        whole = mix(total[self.first[1:]] - total[self.first[:-1]] + self.size.astype(np.uint64))
        less = mix(before + behind + (self.size[self.word] - 1).astype(np.uint64))
        return whole, less


def part_hashes(letters: Letters, parts: int) -> np.ndarray:
    """One hash of each word's dimensions in each part."""
    dims = letters.dimensions()
    out = np.zeros((len(letters.size), parts), np.uint64)
    np.bitwise_xor.at(out, (letters.word, (mix(dims) % np.uint64(parts)).astype(np.int64)), dims)
    return out


def signatures(vocab: DataFrame, parts: int = PARTS) -> DataFrame:
    """sig, word, n: a row for each word and each two parts left out."""
    left_out = list(combinations(range(parts), 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = part_hashes(Letters(batch.column(0).to_pylist()), parts)
            whole = np.bitwise_xor.reduce(hashes, axis=1)
            for k, (p, q) in enumerate(left_out):
                sig = mix((whole ^ hashes[:, p] ^ hashes[:, q]) + mix(np.array([k + 1], np.uint64)))
                yield pa.RecordBatch.from_arrays([pa.array(signed(sig)), *batch.columns], ["sig", "word", "n"])

    return vocab.select("word", "n").mapInArrow(run, "sig long, word string, n long")


# -- near words -----------------------------------------------------------------

def near_in(sig: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (both ways round) of near words under equal ``sig``."""
    letters = Letters(words)
    whole, less = letters.less_one()
    key = mix(sig)
    # replacements: equal at a position's gap; else: one word is the other less a letter
    gap = mix((less ^ key[letters.word]) + (letters.at.astype(np.uint64) + np.uint64(2)) * _STEP)
    joined = np.concatenate([mix(less ^ key[letters.word]), mix(whole ^ key)])
    row = np.concatenate([letters.word, np.arange(len(words))])
    found = [_equal(gap, letters.word), _equal(joined, row)]
    x = np.concatenate([f[0] for f in found])
    y = np.concatenate([f[1] for f in found])
    one = np.unique(x * len(words) + y)
    x, y = one // max(1, len(words)), one % max(1, len(words))
    ok = np.array([sig[a] == sig[b] and one_edit(words[a], words[b]) for a, b in zip(x.tolist(), y.tolist())], bool)
    x, y = x[ok], y[ok]
    return np.concatenate([x, y]), np.concatenate([y, x])


def _equal(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs x < y of different rows with an equal key. Rows of one key are
    words less the same letter: no more than an alphabet for each position."""
    order = np.argsort(key, kind="stable")
    key, row = key[order], row[order]
    xs, ys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = 1
    live = np.flatnonzero(key[1:] == key[:-1])
    while len(live):
        a, b = row[live], row[live + step]
        different = a != b
        xs.append(np.minimum(a, b)[different])
        ys.append(np.maximum(a, b)[different])
        step += 1
        live = live[live + step < len(key)]
        live = live[key[live] == key[live + step]]
    return np.concatenate(xs), np.concatenate(ys)


def one_edit(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1:] if len(a) < len(b) else a[i + 1:] == b[i + 1:]


def _buckets(rows: DataFrame) -> DataFrame:
    """sig, word, n, bucket: rows of hot signatures (``held`` words, dealt
    over ``nb`` buckets) go to each bucket that a word's hashes pick."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = Letters(batch.column(1).to_pylist())
            nb = batch.column(3).to_numpy().astype(np.uint64)
            whole, less = letters.less_one()
            row = np.concatenate([letters.word, np.arange(len(nb))])
            to = np.concatenate([less, whole]) % nb[row]
            picked = np.unique(np.stack([row.astype(np.uint64), to], 1), axis=0).astype(np.int64)
            for at in range(0, len(picked), 1 << 16):
                part = picked[at:at + (1 << 16)]
                kept = [batch.column(i).take(pa.array(part[:, 0])) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(part[:, 1].astype(np.int32))], ["sig", "word", "n", "bucket"])

    return rows.select("sig", "word", "n", "nb").mapInArrow(run, "sig long, word string, n long, bucket int")


def near_words(vocab: DataFrame, parts: int = PARTS, group_rows: int = GROUP_ROWS,
               chunk_letters: int = CHUNK_LETTERS, broadcast_hot: int = BROADCAST_HOT) -> DataFrame:
    """word, near, near_n: each near pair, both ways round, once."""
    sigs = signatures(vocab, parts)
    hot = cut_lineage(sigs.groupBy("sig").count().filter(F.col("count") > group_rows).select(
        "sig", F.ceil(F.col("count") / F.lit(group_rows)).cast("long").alias("nb")))
    dealt = sigs.join(F.broadcast(hot) if hot.count() <= broadcast_hot else hot, "sig", "left")
    cool = dealt.filter("nb IS NULL").select("sig", "word", "n", F.lit(0).alias("bucket"))
    rows = cool.unionByName(_buckets(dealt.filter("nb IS NOT NULL")))
    tasks = int(vocab.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, "sig", "bucket").sortWithinPartitions("sig", "bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig, bucket, words, n, letters = [], [], [], [], 0

        def flush(upto: int) -> Iterator[pa.RecordBatch]:
            group = mix(np.array(sig[:upto], np.int64).view(np.uint64)) + np.array(bucket[:upto], np.uint64)
            x, y = near_in(group, words[:upto])
            if len(x):
                w, k = pa.array(words[:upto], pa.string()), pa.array(n[:upto], pa.int64())
                yield pa.RecordBatch.from_arrays([w.take(pa.array(x)), w.take(pa.array(y)), k.take(pa.array(y))],
                                                 ["word", "near", "near_n"])

        for batch in batches:
            for s, w, k, b in zip(*(c.to_pylist() for c in batch.columns)):
                if letters >= chunk_letters and (s, b) != (sig[-1], bucket[-1]):
                    yield from flush(len(sig))
                    sig, bucket, words, n, letters = [], [], [], [], 0
                sig.append(s)
                bucket.append(b)
                words.append(w)
                n.append(k)
                letters += len(w)
        if sig:
            yield from flush(len(sig))

    return rows.mapInArrow(run, "word string, near string, near_n long").distinct()


# -- forms and roots --------------------------------------------------------------

def roots(forms: DataFrame) -> DataFrame:
    """word and root of every word that has a form: each round doubles how
    far a word looks along its forms, whose counts grow at every step."""
    jump = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        on = jump.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = cut_lineage(jump.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        jump = moved.select("word", "root")
        if not moved.filter("moved").limit(1).count():
            return jump


def group(vocab: DataFrame, parts: int = PARTS, group_rows: int = GROUP_ROWS, ratio: int = 2) -> DataFrame:
    """word, n, form, root, n_near and form_n of every word of ``vocab``
    (word, n). A form is at least ``ratio`` times as frequent as its word."""
    vocab = cut_lineage(vocab)
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("word"))).alias("best")
    near = near_words(vocab, parts, group_rows).groupBy("word").agg(F.count("*").alias("n_near"), best)
    taken = -F.col("best.minus") >= ratio * F.col("n")
    rows = cut_lineage(vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best.word")).alias("form"), F.when(taken, -F.col("best.minus")).alias("form_n")))
    found = roots(rows.filter("form IS NOT NULL"))
    return rows.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
