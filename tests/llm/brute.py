"""Plain Python statements of what the registered queries return."""

import collections
import hashlib
import re

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def lower(t: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def shingles(text, n):
    w = SPACE.findall(lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def jaccard_components(rows, n, percent):
    """rows: (id, text). id -> (set size, component)."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    return [(i, len(x), None if i is None else find(i)) for i, x in sets]


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def pii_base(t):
    t, out = t or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def contamination(rows, items, size=13):
    """rows, items: (id, text). [(id, n_words, n_hit, items, contaminated)]."""
    wins = collections.defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(lower(t or ""))
        if w and i is not None:
            n = min(size, len(w))
            for k in range(len(w) - n + 1):
                wins[tuple(w[k:k + n])].add(str(i))
    lengths = {len(k) for k in wins}
    out = []
    for i, t in rows:
        w = ALNUM.findall(lower(t or ""))
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in wins:
                    hit |= set(range(k, k + n))
                    found |= wins[tuple(w[k:k + n])]
        out.append((i, len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def secrets_base(t):
    t, out = t or "", []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(out)]


def spans_text(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def repeated_passages(rows, size=13):
    """rows: (id, text). [(id, n_words, n_removed, kept)]."""
    last = float("inf")
    words = [(last if i is None else i, SPACE.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - size + 1):
            x = tuple(w[k:k + size])
            first[x] = min(first.get(x, last), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < i:
                gone[k:k + size] = [True] * size
        out.append((None if i == last else i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def quality_base(t):
    t = t or ""
    w = SPACE.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if SPACE.search(line):
            dup += line in seen
            seen.add(line)
    c = collections.Counter(zip(w, w[1:], w[2:]))
    rep = [False] * len(w)
    for i in range(len(w) - 2):
        if c[tuple(w[i:i + 3])] > 1:
            rep[i:i + 3] = [True] * 3
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, sum(rep), n < 50 or 100 * sum(rep) > 50 * n)


def coverage(t, n):
    """Share of word characters inside n-grams that came before in the text."""
    w = SPACE.findall(t or "")
    seen, inside = set(), [False] * len(w)
    for i in range(len(w) - n + 1):
        if tuple(w[i:i + n]) in seen:
            inside[i:i + n] = [True] * n
        seen.add(tuple(w[i:i + n]))
    return sum(len(x) for x, g in zip(w, inside) if g) / max(1, sum(map(len, w)))
