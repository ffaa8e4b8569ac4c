"""Quality rules by repetition coverage.

For each text, rolling hashes of every n-gram length in ``coverage_limits``
(and of the lines) are compared inside the text; the characters of words that
lie in an n-gram found twice or more, and of lines equal to an earlier line,
are measured against all word characters. A text passes when it has enough
words, the 3-word windows do not repeat over more than half of its words, and
no coverage exceeds its limit.

Defined results: a null, empty or blank text has no words, so it fails;
very long texts are one block each; repeated rows are judged one by one; an
empty table gives an empty result; extra columns are carried through by
``keep_good`` and ignored by ``measure``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sessionlens.llm.tables import id_text
from sessionlens.llm.textblock import (Block, U64, blocks, code_points, mix, ngram_hashes,
                                       span_hashes, utf8)


@dataclass(frozen=True)
class Rules:
    """Limits; a coverage is a share of word characters, 0 to 1.

    The n-gram and line limits are the published ones for web text.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    coverage_limits: dict = field(default_factory=lambda: {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10})
    line_limit: float = 0.20


SYMBOLS = np.zeros(256, np.int64)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = 1

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, line_coverage double, max_ngram_excess double, "
          "base_failed boolean, kept boolean")


def _per_text(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sum of values[edges[i]:edges[i+1]] for each i."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[edges[1:]] - total[edges[:-1]]


def _repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs twice or more."""
    if len(keys) == 0:
        return np.zeros(0, bool)
    s = np.sort(keys)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if len(twice) == 0:
        return np.zeros(len(keys), bool)
    at = np.searchsorted(twice, keys)
    at[at == len(twice)] = 0
    return twice[at] == keys


def _later(keys: np.ndarray) -> np.ndarray:
    """Which keys have an equal one before them."""
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return again


def ngram_cover(b: Block, hashes: np.ndarray, n: int, later: bool = False) -> np.ndarray:
    """Mask of words inside an n-gram that its text has twice or more; with
    ``later`` only inside its second and further occurrences."""
    at = b.windows(n)
    mask = np.zeros(len(hashes), bool)
    if len(at) == 0:
        return mask
    keys = mix(ngram_hashes(hashes, n)[at] ^ mix(b.doc[at].astype(U64)))
    at = at[_later(keys) if later else _repeated(keys)]
    edge = np.zeros(len(hashes) + 1, np.int32)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    return np.cumsum(edge[:-1]) > 0


def _lines(b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number of each line with a word, whether an earlier line of the
    text equals it, and the index range of its words (as a repeat count)."""
    cut = np.flatnonzero(b.data == 0x0A)
    start = np.union1d(b.offsets[:-1], cut + 1)
    end = np.append(start[1:], len(b.data)) if len(start) else start
    doc = np.searchsorted(b.offsets, start, side="right") - 1
    stop = np.where((end > 0) & (end <= len(b.data)) & (end > start), end, start)
    # a line ends before its newline; a line cut by the next text has none
    newline = np.zeros(len(stop), bool)
    some = stop > start
    newline[some] = b.data[stop[some] - 1] == 0x0A
    stop = stop - newline
    n_words = np.searchsorted(b.start, stop) - np.searchsorted(b.start, start)
    has = (n_words > 0) & (doc < len(b))
    start, stop, doc, n_words = start[has], stop[has], doc[has], n_words[has]
    keys = mix(span_hashes(b.data, start, stop) ^ mix(doc.astype(U64)))
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return doc, again, n_words


def _measure_block(b: Block, rules: Rules) -> dict[str, np.ndarray]:
    hashes = b.hashes()
    points = code_points(b.data)
    chars = points[b.end] - points[b.start]
    n_words = np.diff(b.first)
    word_chars = _per_text(chars, b.first)
    symbols = _per_text(SYMBOLS[b.data], b.offsets)
    repeat = _per_text(ngram_cover(b, hashes, 3), b.first)
    doc, again, line_words = _lines(b)
    dup_lines = np.bincount(doc[again], minlength=len(b))[:len(b)]
    in_dup = np.repeat(again, line_words)
    share = np.maximum(word_chars, 1)
    line_cover = _per_text(chars * in_dup, b.first) / share
    excess = np.full(len(b), -1.0)
    for n, limit in rules.coverage_limits.items():
        cover = _per_text(chars * ngram_cover(b, hashes, n, later=True), b.first) / share
        excess = np.maximum(excess, cover - limit)
    failed = (n_words < rules.min_words) | (100 * repeat > rules.max_repeat_percent * n_words)
    kept = ~failed & (excess <= 0) & (line_cover <= rules.line_limit)
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": symbols,
            "n_dup_lines": dup_lines, "n_repeat_words": repeat, "line_coverage": line_cover,
            "max_ngram_excess": excess, "base_failed": failed, "kept": kept}


def measure(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per document: counts, coverages and the verdict. One scan, no
    shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for b in blocks(utf8(batch.column(1))):
                cols = _measure_block(b, rules)
                part = ids.slice(b.rows, len(b))
                yield pa.RecordBatch.from_arrays([part, *[pa.array(v) for v in cols.values()]], ["doc_id", *cols])

    return id_text(docs).mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with all their columns, in the same scan."""
    names = docs.columns
    text_at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(utf8(batch.column(text_at))):
                good = _measure_block(b, rules)["kept"]
                yield batch.slice(b.rows, len(b)).filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)

