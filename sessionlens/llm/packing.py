"""Best-fit packing by bin completion.

Documents become token ids (a public vocabulary, then one end id); only a
document longer than a sequence is cut. Pieces that fill a sequence are
sequences of their own. The rest are dealt evenly, by a hash of their row
number, to shards of about ``shard_pieces`` pieces, and each shard is packed
by branch and bound over bin completions:

* the largest piece left opens a sequence;
* its undominated fillings, of any number of pieces, are enumerated lazily in
  order of waste;
* a branch is cut when its waste exceeds what one sequence less than the
  incumbent allows;
* the incumbent starts as best-fit decreasing, and a shard stops as soon as it
  meets the lower bound ceil(tokens / size) or its node budget.

A shard loses at most the tail of its last sequence. Only lengths travel to
the shards, not ids. The deal is taken from a checkpoint, so a retried task
sees the same rows.

Defined results: a null or empty text is one piece holding the end id alone;
repeated rows are packed one by one (``doc_id`` may then repeat); an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.tables import id_text
from sessionlens.llm.textblock import utf8
from sessionlens.session import cut_lineage

SIZE = 4096
END_ID = 1
SHARD_PIECES = 16384
VOCABULARY = "word_bpe_49k.json"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
SIGNS = "★♥☆♡❤✨"
_TEXTS_AT_ONCE = 256
BRANCHES = 3


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds:
    """Ids of whole texts through a cache of words.

    The vocabulary drops white space and its merges never cross it, so a
    text's ids are those of its space-separated words in order. The cache
    starts anew when it holds ``limit`` words, which bounds a worker's memory.
    """

    def __init__(self, path: str, limit: int = 700_000, at_once: int = 256):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit, self.at_once = limit, at_once
        # a sign with one id of its own parts the ids of new words
        ids = {c: self.tokenizer.encode(c, add_special_tokens=False).ids for c in SIGNS}
        self.sign = next((c for c in SIGNS if len(ids[c]) == 1), None)
        self.sign_id = ids[self.sign][0] if self.sign else None
        self.known = _Known()

    def texts(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.known) > self.limit:
            self.known.clear()
        look, new = self.known.__getitem__, self.known.new
        split = [t.split() for t in texts]
        ids, gaps = [], []
        for words in split:
            had = len(new)
            found = list(map(look, words))
            ids.append(found)
            # "None in found" would cost as much as the look-ups
            gaps.append([i for i, x in enumerate(found) if x is None] if len(new) > had else [])
        self._learn(list(dict.fromkeys(new)))
        new.clear()
        for words, found, gap in zip(split, ids, gaps):
            for i in gap:
                found[i] = look(words[i])
        return [b"".join(found) for found in ids]

    def _learn(self, words: list[bytes]) -> None:
        """Add the ids of new words, many to a call, parted by the sign. Words
        that hold the sign, and runs that do not part cleanly, go alone."""
        words = [w.decode() for w in words]
        alone = [w for w in words if self.sign is None or self.sign in w]
        joined = [w for w in words if self.sign is not None and self.sign not in w]
        runs = [joined[i:i + self.at_once] for i in range(0, len(joined), self.at_once)]
        coded = self.tokenizer.encode_batch_fast([f" {self.sign} ".join(r) for r in runs], add_special_tokens=False)
        for run, e in zip(runs, coded):
            ids = np.array(e.ids, "<u4")
            cut = np.flatnonzero(ids == self.sign_id) * 4
            if len(cut) != len(run) - 1:
                alone += run
                continue
            whole = ids.tobytes()
            for w, a, b in zip(run, [0, *(cut + 4).tolist()], [*cut.tolist(), len(whole)]):
                self.known[w.encode()] = whole[a:b]
        for w, e in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)):
            self.known[w.encode()] = np.array(e.ids, "<u4").tobytes()


class _Known(dict):
    """Ids by word; looking up a word without ids notes it in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> None:
        self.new.append(word)


@lru_cache(4)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def _token_ids(batch: pa.RecordBatch, path: str) -> Iterator[tuple[int, bytes]]:
    """(row, ids with the end id) of a batch of (doc_id, text)."""
    texts = utf8(batch.column(1))
    end = np.array([END_ID], "<u4").tobytes()
    for at in range(0, len(texts), _TEXTS_AT_ONCE):
        for row, ids in enumerate(_word_ids(path).texts(texts[at:at + _TEXTS_AT_ONCE]), at):
            yield row, ids + end


def pieces(docs: DataFrame, size: int = SIZE, path: str | None = None) -> DataFrame:
    """One row per piece: where it starts in its document's ids, its length
    and the CRC of its ids."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in _token_ids(batch, path):
                for p, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at:at + 4 * size]
                    row.append(i)
                    piece.append(p)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            doc = batch.column(0).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return id_text(docs).mapInArrow(run, PIECES)


class Completion:
    """Branch and bound over the multiset of lengths of one shard.

    Sets of lengths are bits of an int: bit x of ``left`` says that a piece of
    length x is left.
    """

    def __init__(self, lengths: np.ndarray, size: int, nodes_per_bin: int = 3, steps_per_node: int = 64):
        self.size = size
        self.counted = count = np.bincount(lengths, minlength=size + 1)
        self.total = int(lengths.sum())
        self.bound = -(-self.total // size)
        self.best = best_fit(count, size)
        self.budget = nodes_per_bin * len(self.best), steps_per_node * nodes_per_bin * len(self.best)

    def pack(self) -> list[list[int]]:
        """Lengths of each sequence. Fullest sequences first suits mixed lengths;
        few pieces a sequence first suits a narrow range of them."""
        for self.few_first in (False, True):
            if len(self.best) > self.bound:
                self.nodes, self.steps = self.budget
                self.count = self.counted.tolist()
                self.left = sum(1 << x for x in np.flatnonzero(self.counted).tolist())
                self._search()
        return self.best

    def _reach(self) -> tuple[list[int], list[int]]:
        """Lengths left in order, and the sums that the first k of them reach."""
        lengths = [x for x in range(1, self.left.bit_length()) if self.left >> x & 1]
        sums, mask = [1], (2 << self.size) - 1
        for x in lengths:
            reached, copies, step = sums[-1], min(self.count[x], self.size // x), 1
            while copies:
                step = min(step, copies)
                reached |= reached << x * step & mask
                copies -= step
                step *= 2
            sums.append(reached)
        return lengths, sums

    def _fillings(self, room: int, slack: int, reach: tuple[list[int], list[int]]) -> Iterator[tuple[list[int], int]]:
        """Undominated fillings of ``room`` of any number of pieces, with their
        waste of at most ``slack``, least waste first. ``reach`` may be that of
        a level above, which had all pieces of this one."""
        if slack < 0:
            return
        if self.left >> room & 1:  # dominates all others
            yield [room], 0
            return
        first = [f for f in self._few(room) if sum(f) >= room - slack] if self.few_first else []
        for fill in first:
            yield fill, room - sum(fill)
        least = max(0, room - slack)
        fits = reach[1][bisect_right(reach[0], room)]
        fits = (fits & (2 << room) - 1) >> least << least
        while fits:
            total = fits.bit_length() - 1
            fits ^= 1 << total
            for fill in self._exact(total, room - total, *reach):
                if fill not in first:
                    yield fill, room - total

    def _exact(self, total: int, waste: int, lengths: list[int], sums: list[int]) -> Iterator[list[int]]:
        """Undominated sets of pieces of exactly ``total``, larger pieces first.

        A set is dominated if one unused piece can take the place of some of
        its pieces (or of none) without being smaller than they are and without
        overfilling: the two could change places in any packing.
        """
        fill: list[int] = []
        # per piece: its place in ``lengths``; unused pieces, sums of subsets before it
        levels: list[tuple[int, int, int]] = []
        unused, subsets = self.left, 0
        k = bisect_right(lengths, total)
        while self.steps > 0:
            if total == 0:
                if not unused & (2 << waste) - 2:
                    yield list(fill)
                k = 0
            k = min(k, bisect_right(lengths, total))
            while k and not (unused >> lengths[k - 1] & 1 and sums[k] >> total - lengths[k - 1] & 1):
                k = k - 1 if sums[k] >> total & 1 else 0
            if k == 0:
                if not fill:
                    return
                total += fill.pop()
                k, unused, subsets = levels.pop()
                k -= 1
                continue
            self.steps -= 1
            x = lengths[k - 1]
            rest = unused ^ 1 << x if fill.count(x) + 1 == self.count[x] else unused
            better = _smear(subsets << x, waste) | _smear(2 << x, waste - 1)
            if better & rest:
                k -= 1
                continue
            levels.append((k, unused, subsets))
            fill.append(x)
            unused, subsets = rest, subsets | subsets << x | 1 << x
            total -= x

    def _few(self, room: int) -> list[list[int]]:
        """The fullest fillings of one, two or three pieces, least waste first:
        where the second search begins, not all that it tries."""
        count = np.array(self.count)
        have = count[:room + 1] > 0
        below = np.maximum.accumulate(np.where(have, np.arange(room + 1), 0))  # largest length up to each
        one = int(below[room])
        if one == room or one == 0:
            return [[one]] if one else [[]]
        # a pair matters only if it fills more than the best single piece;
        # for each larger half, the best partner dominates smaller ones
        xs = np.flatnonzero(have[:one + 1])
        xs = xs[xs > 0]
        ys = np.minimum(below[room - xs], xs)
        ys = np.where((ys == xs) & (count[xs] < 2), below[np.maximum(xs - 1, 0)], ys)
        sums = np.where(ys > 0, xs + ys, 0)
        top = int(sums.argmax())
        if sums[top] == room:
            return [[int(xs[top]), int(ys[top])]]
        found = {(one,): one}
        few = min(BRANCHES, len(sums))
        for i in np.argpartition(-sums, few - 1)[:few]:
            if sums[i] > one:
                found[(int(xs[i]), int(ys[i]))] = int(sums[i])
        for x in xs[::-1][:8].tolist():
            left = room - x
            ys = xs[xs <= min(x, left)]
            zs = np.minimum(below[left - ys], ys)
            used = (ys == x).astype(int) + 1
            zs = np.where((zs == ys) & (count[ys] <= used), below[np.maximum(ys - 1, 0)], zs)
            ok = (count[ys] >= used) & (zs > 0) & ((zs != x) | (count[x] > 1))
            sums = np.where(ok, x + ys + zs, 0)
            if len(sums) and sums.max() > one:
                j = int(sums.argmax())
                found[(x, int(ys[j]), int(zs[j]))] = int(sums[j])
                if sums[j] == room:
                    break
        order = sorted(found, key=lambda f: (-found[f], len(f), tuple(-x for x in f)))
        return [list(f) for f in order[:BRANCHES]]

    def _search(self) -> None:
        """Depth-first; each level keeps its fillings not yet tried."""
        # each: largest piece, filling, waste, further fillings, reach
        stack: list[list] = []
        waste, allowed = 0, (len(self.best) - 1) * self.size - self.total
        while self.nodes > 0 and self.steps > 0:
            if self.left == 0:  # all placed, in fewer sequences than the incumbent
                self.best = [[level[0], *level[1]] for level in stack]
                if len(self.best) <= self.bound:
                    return
                allowed = (len(self.best) - 1) * self.size - self.total
            else:
                self.nodes -= 1
                distinct = self.left.bit_count()
                reach = stack[-1][4] if stack else None
                if reach is None or distinct < 128 or 10 * distinct < 9 * len(reach[0]):
                    reach = self._reach()
                big = self.left.bit_length() - 1
                self._take([big], -1)
                more = self._fillings(self.size - big, allowed - waste, reach)
                stack.append([big, [], 0, more, reach])
            # the next filling of the deepest level that has one
            while stack:
                level = stack[-1]
                self._take(level[1], 1)
                waste -= level[2]
                found = next((f for f in level[3] if waste + f[1] <= allowed), None)
                level[1:3] = found or ([], 0)
                if found is not None:
                    self._take(level[1], -1)
                    waste += level[2]
                    break
                self._take([level[0]], 1)
                stack.pop()
            else:
                return

    def _take(self, fill: list[int], sign: int) -> None:
        for x in fill:
            self.count[x] += sign
            if self.count[x] == (sign > 0):
                self.left ^= 1 << x


def _smear(bits: int, by: int) -> int:
    """``bits`` with the ``by`` places above each; none if ``by`` is negative."""
    if by < 0:
        return 0
    done = 1
    while done <= by:
        step = min(done, by + 1 - done)
        bits |= bits << step
        done += step
    return bits


def best_fit(count: np.ndarray, size: int) -> list[list[int]]:
    """Best-fit decreasing over a table of lengths."""
    by_room: list[list[list[int]]] = [[] for _ in range(size + 1)]
    open_rooms = np.zeros(size + 1, bool)
    out: list[list[int]] = []
    for x in np.flatnonzero(count)[::-1].tolist():
        for _ in range(int(count[x])):
            at = int(open_rooms[x:].argmax()) + x
            if open_rooms[at]:
                bin_ = by_room[at].pop()
                open_rooms[at] = bool(by_room[at])
            else:
                bin_, at = [], size
                out.append(bin_)
            bin_.append(x)
            if at > x:
                by_room[at - x].append(bin_)
                open_rooms[at - x] = True
    return out


def pack(parts: DataFrame, size: int = SIZE, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``."""
    rows = cut_lineage(parts).withColumn("row", F.monotonically_increasing_id())
    full = rows.filter(F.col("length") == size).withColumns(
        {"sequence_id": -1 - F.col("row"), "offset": F.lit(0).cast("long")}).drop("row")
    rest = rows.filter(F.col("length") < size)
    shards = max(1, -(-rest.count() // shard_pieces))
    rest = rest.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards))).repartition(shards, "shard")
    names = full.columns

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = pdf["length"].to_numpy()
        own = np.argsort(lengths, kind="stable")
        at = np.zeros(size + 2, np.int64)
        np.cumsum(np.bincount(lengths, minlength=size + 1), out=at[1:])
        sequence = np.zeros(len(pdf), np.int64)
        offset = np.zeros(len(pdf), np.int64)
        for i, fill in enumerate(Completion(lengths, size).pack()):
            place = 0
            for x in fill:
                row = own[at[x]]
                at[x] += 1
                sequence[row], offset[row] = i, place
                place += x
        pdf["sequence_id"] = sequence + (int(pdf["shard"].iloc[0]) << 32)
        pdf["offset"] = offset
        return pdf[names]

    return full.unionByName(rest.groupBy("shard").applyInPandas(run, full.schema))


def sequences(docs: DataFrame, packed: DataFrame, size: int = SIZE, path: str | None = None) -> DataFrame:
    """The packed sequences themselves: sequence_id and its ids, for documents
    with distinct ``doc_id``. Texts are tokenised again, so ids never travel
    with the packing."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, ids in _token_ids(batch, path):
                ids = np.frombuffer(ids, "<u4").astype(np.int32)
                cut = [ids[at:at + size].tolist() for at in range(0, len(ids), size)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([row] * len(cut))), pa.array(range(len(cut)), pa.int32()),
                     pa.array(cut, pa.list_(pa.int32()))], ["doc_id", "piece", "ids"])

    ids = id_text(docs).mapInArrow(run, "doc_id long, piece int, ids array<int>")
    both = packed.select("doc_id", "piece", "sequence_id", "offset").join(ids, ["doc_id", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most ``size`` pieces
    return both.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p.ids)).alias("ids"))
