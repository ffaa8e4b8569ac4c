"""Spelling variants against brute force."""

import collections
import random
import zlib

import pytest
import regex

import __spark_entry__ as E
from brute import lower
from conftest import SF_SMALL
from sessionlens.llm import spelling
from sessionlens.llm.tables import table

ROWS = [
    (1, "Colour colour COLOUR color color color color color color Colours"), (2, None), (3, ""), (None, "colour color"),
    (4, "\u00c9cole \u00e9cole \u00c9cole \u00c9cole \u00e9cole \u00c9coles \u00c9cole \u00e9coles \u00e9coles \u00e9coles \u00c9coles"),
    (4, "naïve naive naive naïve naïve naive naive naive naive naive na\u00d7ve\u0100stop"),
    (5, "listen silent tinsel enlist " * 7 + "x" * 3000 + " " + ("y" * 2999 + " ") * 4), (5, "listen silent " * 2),
    (6, "aaaaa aaaaaa aaaaaaa aaaaaaaa " * 3 + "aaaaa " * 20 + "aaaaaa " * 9),
    (7, "bread breads breed broad braid " * 3 + "bread " * 9 + "\U0001f600breed\u4e2dbreed"),
]


def expected(rows, slip, min_letters=5, min_count=3):
    count = collections.Counter()
    for i, t in rows:
        for run in regex.findall("[A-Za-z\u00c0-\u00ff]+", lower(t or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slip and h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    n = {w: k for w, k in count.items() if len(w) >= min_letters and k >= min_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    found = {w: [x for x in n if abs(len(x) - len(w)) < 2 and near(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(found[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(found[w]), n[form[w]] if w in form else None))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


@pytest.mark.parametrize("parts,group_rows", [(4, 16384), (6, 3), (3, 2)])
def test_variants_on_edges(spark, parts, group_rows):
    df = spark.createDataFrame([(i, t, "w", 1) for i, t in ROWS], "doc_id long, text string, word string, n int").repartition(3)
    exp = expected(ROWS, None)
    assert any(r[1] != r[2] and r[1] for r in exp) or any(r[1] for r in exp)
    assert rows_of(spelling.group(spelling.vocabulary(df), parts, group_rows)) == exp
    assert rows_of(spelling.group(spelling.vocabulary(df, 3), parts, group_rows)) == expected(ROWS, 3)


def test_hot_signatures_lose_no_pair(spark):
    """Words of two letters only: a few multisets hold nearly all of them."""
    r = random.Random(3)
    words = list({"".join(r.choice("ab") for _ in range(r.randint(9, 11))) for _ in range(700)})
    counted = [(w, r.choice([3, 4, 9, 20, 50])) for w in words]
    vocab = spark.createDataFrame(counted, "word string, n long")
    rows = [(0, " ".join(w for w, n in counted for _ in range(n)))]
    for broadcast in (1 << 18, 0):
        near = spelling.near_words(vocab, 4, 16, chunk_letters=64, broadcast_hot=broadcast).collect()
        assert len(near) == len(set(near)) == sum(r[4] for r in expected(rows, None))
    assert rows_of(spelling.group(vocab, 4, 16)) == expected(rows, None)


def test_a_long_chain_of_forms_has_one_root(spark):
    words = ["a" * 5 + "b" * i for i in range(12)]
    vocab = spark.createDataFrame([(w, 3 * 2 ** (12 - i)) for i, w in enumerate(words)], "word string, n long")
    assert {r.root for r in spelling.group(vocab).collect()} == {words[0]}


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.group(spelling.vocabulary(empty, 97)).collect() == []


def test_query(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    assert rows_of(E.queries()["op12_spelling_variants"](spark, SF_SMALL)) == expected([tuple(r) for r in docs], 97)
