"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over the text: at-signs
and their spelled-out forms, plus-digit, digit-dot-digit, adjacent digits,
``scheme://`` and identifier cues. Small deterministic parsers then expand
each anchor to its boundaries and validate it.

Base kinds (leftmost, non-overlapping within a kind; a failing match is
dropped and not tried again): ``email``, ``ip`` (parts at most 255), ``card``
(16 to 19 digits, Luhn), ``phone`` (8 to 15 digits). Added kinds: ``spelled``
(``name (at) host (dot) tld``), ``userinfo`` (``user:password`` before the
host of a URL) and ``account`` (IBAN with a valid checksum, or a social
security number after its cue).

Defined results: null and empty texts have no spans; spans count code points,
end exclusive; very long texts are scanned whole; repeated rows give repeated
results; extra columns are ignored by ``detect`` and kept by ``mask``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.tables import id_text

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "spelled", "userinfo", "account"]

_LOCAL = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = set("0123456789")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_QUAD = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_AT = r"[ ]?[(\[][ ]?at[ ]?[)\]][ ]?"
_DOT = r"(?:[ ]?[(\[][ ]?dot[ ]?[)\]][ ]?|\.)"
_SPELLED = re.compile(rf"{_AT}([A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+)", re.I | re.A)
_USERINFO = re.compile(r"://([^\s/@?#:]+:[^\s/@?#]+)@")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SSN = re.compile(r"[ :#=]{1,3}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")

SCHEMA = "doc_id long, spans array<struct<kind:string,start:int,end:int>>"


@lru_cache(1)
def _automaton():
    """Anchors -> which parser they call."""
    import ahocorasick

    a = ahocorasick.Automaton()
    digits = "0123456789"
    a.add_word("@", "email")
    a.add_word("://", "userinfo")
    for d in digits:
        a.add_word(f"+{d}", "phone")
        for e in digits:
            a.add_word(f"{d}.{e}", "ip")
            for sep in ("", " ", "-"):
                a.add_word(f"{d}{sep}{e}", "card")
    for left in "([":
        for at in ("at", "At", "AT"):
            for gap in ("", " "):
                a.add_word(f"{left}{gap}{at}", "spelled")
    for cue in ("IBAN", "Iban", "iban"):
        a.add_word(cue, "iban")
    for cue in ("SSN", "ssn", "Social Security Number", "social security number"):
        a.add_word(cue, "ssn")
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c)
        if i % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _left(text: str, at: int, floor: int, allowed: set) -> int:
    while at > floor and text[at - 1] in allowed:
        at -= 1
    return at


class _Scan:
    """Spans of one text; ``done[kind]`` is the end of the last match, kept or
    dropped, before which nothing of that kind starts."""

    def __init__(self, text: str):
        self.text = text
        self.done = dict.fromkeys(KINDS, 0)
        self.spans: list[tuple[str, int, int]] = []

    def _match(self, kind: str, start: int, end: int, ok: bool) -> None:
        self.done[kind] = end
        if ok:
            self.spans.append((kind, start, end))

    def email(self, start: int, end: int) -> None:
        local = _left(self.text, start, self.done["email"], _LOCAL)
        if local < start and (m := _DOMAIN.match(self.text, end)):
            self._match("email", local, m.end(), True)

    def ip(self, start: int, end: int) -> None:
        if start < self.done["ip"]:
            return
        first = _left(self.text, start, self.done["ip"], _DIGITS)
        if m := _QUAD.match(self.text, first):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            self._match("ip", first, m.end(), all(len(p) < 4 and int(p or 0) <= 255 for p in parts))

    def card(self, start: int, end: int) -> None:
        if start >= self.done["card"] and (m := _CARD.match(self.text, start)):
            digits = m[0].replace(" ", "").replace("-", "")
            self._match("card", start, m.end(), 16 <= len(digits) <= 19 and luhn(digits))

    def phone(self, start: int, end: int) -> None:
        if start >= self.done["phone"] and (m := _PHONE.match(self.text, start)):
            self._match("phone", start, m.end(), 8 <= sum(c in _DIGITS for c in m[0]) <= 15)

    def spelled(self, start: int, end: int) -> None:
        at = start - (start > 0 and self.text[start - 1] == " ")
        local = _left(self.text, at, self.done["spelled"], _LOCAL)
        if local < at and (m := _SPELLED.match(self.text, at)):
            self._match("spelled", local, m.end(), True)

    def userinfo(self, start: int, end: int) -> None:
        if start >= self.done["userinfo"] and (m := _USERINFO.match(self.text, start)):
            self._match("userinfo", m.start(1), m.end(1), True)

    def iban(self, start: int, end: int) -> None:
        m = _IBAN.search(self.text, end, end + 44)
        if not m or m.start() - end > 4 or m.start() < self.done["account"]:
            return
        body = m[0]
        while len(body) > 14:  # trailing words may look like part of it
            if body[-1] != " " and iban_ok(body):
                self._match("account", m.start(), m.start() + len(body), True)
                return
            body = body[:-1]

    def ssn(self, start: int, end: int) -> None:
        m = _SSN.match(self.text, end)
        if m and m.start(1) >= self.done["account"]:
            self._match("account", m.start(1), m.end(1), m[1][:3] not in ("000", "666") and m[1][0] != "9")


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans, by kind as listed, then start."""
    scan = _Scan(text)
    a = _automaton()
    if text:
        for end, (size, kind) in _anchors(a, text):
            getattr(scan, kind)(end + 1 - size, end + 1)
    return sorted(scan.spans, key=lambda s: (KINDS.index(s[0]), s[1]))


_SIZES = {"email": 1, "userinfo": 3, "phone": 2, "ip": 3}


def _anchors(a, text: str) -> Iterator[tuple[int, tuple[int, str]]]:
    for end, kind in a.iter(text):
        size = _SIZES.get(kind)
        if size is None:
            if kind == "card":
                size = 2 if text[end - 1] in _DIGITS else 3
            elif kind == "spelled":
                size = 4 if text[end - 2] == " " else 3
            else:
                size = 0  # cues: only their end matters
        yield end, (size, kind)


def detect(docs: DataFrame) -> DataFrame:
    """doc_id and its spans, one row per input row, in one scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in find(t or "")]
                     for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    return id_text(docs).mapInArrow(run, SCHEMA)


def masked(text: str) -> str:
    """The text with every span replaced by its kind; overlapping spans are
    replaced once, under the kind of the one that starts first."""
    out, at = [], 0
    for kind, start, end in sorted(find(text), key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame) -> DataFrame:
    """The documents with masked texts and their new lengths; null stays null."""
    names = docs.columns
    text_at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if t is None else masked(t) for t in batch.column(text_at).to_pylist()]
            cols = {n: batch.column(i) for i, n in enumerate(names)}
            cols["text"] = pa.array(texts, batch.schema.field(text_at).type)
            if "n_chars" in cols:
                kind = batch.schema.field("n_chars").type
                cols["n_chars"] = pa.array([None if t is None else len(t) for t in texts], kind)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names)

    return docs.mapInArrow(run, docs.schema)


def digest(spans: DataFrame) -> DataFrame:
    """Counts and digests of the spans of ``detect``."""
    line = lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))
    base = F.filter("spans", lambda s: s.kind.isin(BASE))
    count = lambda k: F.size(F.filter("spans", lambda s: s.kind == k)).cast("long").alias(f"n_{k}")
    return spans.select(
        "doc_id", *[count(k) for k in BASE],
        F.sha2(F.array_join(F.transform(base, line), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", line), ",").alias("spans"))
