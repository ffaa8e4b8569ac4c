"""Conversation repair against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from sessionlens.llm import conversation_repair as repair
from sessionlens.llm.tables import table

SCHEMA = "conv_id long, turn long, role string, text string, block long, at long, audit string, copies int, k long"
LEGAL = re.compile("(s?(ua)+)?")


def damaged(rows):
    """Rows by conversation, in order, after the query's damage."""
    out = {}
    for conv, turn, role, text in rows:
        name = lambda x: " " if x is None else x
        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = name(role), name(text)
        own = out.setdefault(conv, [])
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        own += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    return out


def faults(own):
    seen, out = set(), []
    for _, role, text in own:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(own, bad):
    """(cost, audit, repaired rows), states by what the roles read so far may go on with."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    roles = {"u": "user", "a": "assistant"}

    def with_inserts(front):
        for _ in range(3):
            for state, (cost, audit, out) in list(front.items()):
                for t in "ua":
                    to = after.get((state, t))
                    new = (cost + 5, audit + "I", out + [f"{roles[t]}:"])
                    if to and (to not in front or new[:2] < front[to][:2]):
                        front[to] = new
        return front

    front = {"": (0, "", [])}
    for (_, role, text), fault in zip(own, bad):
        nxt = {}

        def offer(to, new):
            if to is not None and (to not in nxt or new[:2] < nxt[to][:2]):
                nxt[to] = new

        extra = 5 if fault == "truncated" else 0
        for state, (cost, audit, out) in with_inserts(front).items():
            offer(state, (cost + 2, audit + "D", out))
            if fault in ("", "truncated"):
                offer(after.get((state, role[:1])), (cost + extra, audit + "K", out + [f"{role}:{text}"]))
                for t in "ua":
                    offer(after.get((state, t)), (cost + extra + 1, audit + "R", out + [f"{roles[t]}:{text}"]))
        front = nxt
    return min(v for k, v in with_inserts(front).items() if k in ("", "a"))


def expected(rows):
    out = []
    for conv, own in damaged(rows).items():
        bad = faults(own)
        cost, audit, done = cheapest(own, bad)
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        first = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
        out.append((conv, gaps, *(bad.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256("\n".join(done).encode()).hexdigest()))
    return sorted(out, key=repr)


def run(df, block_rows):
    got = repair.with_all(repair.repair(repair.damage(df), block_rows), df).collect()
    return sorted(map(tuple, got), key=repr)


def talk(seed, n):
    r = random.Random(seed)
    text = lambda: r.choice(["Hi.", "Ok!", "What?", "cut", "", " \n", None, f"t{r.randint(0, 99)}.", f"t{r.randint(0, 99)}", "Ok. \t"])
    return [(r.randint(0, 40), r.choice([None, *range(9)]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
             text()) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    hot = random.Random(9)
    big = [(77, i, ["user", "assistant"][(i + (hot.random() < 0.1)) % 2], hot.choice([f"say {i}.", f"say {i}", "again."])) for i in range(600)]
    return talk(1, 260) + [(None, 1, "user", "Hi."), (None, None, "assistant", "Yo."), (50, None, None, None)] + big + \
        [(78, 0, "system", "S."), *[(78, 1, "user", "same.")] * 300, (78, 2, "assistant", "A.")]


@pytest.mark.parametrize("block_rows", [1, 7, 1 << 14])
def test_repair(spark, rows, block_rows):
    df = spark.createDataFrame([(*r, 1, 2, "x", 3, 4) for r in rows], SCHEMA).repartition(3)
    assert run(df, block_rows) == expected(rows)


def test_brute_force_is_cheapest_of_all_edits():
    """Every edit of short conversations, listed one by one."""
    r = random.Random(2)
    for _ in range(60):
        own = [(i, r.choice(["user", "assistant", "system", "tool"]), r.choice(["a.", "b.", "c"])) for i in range(r.randint(0, 3))]
        bad, roles = faults(own), {"u": "user", "a": "assistant"}
        options = []
        for (_, role, text), fault in zip(own, bad):
            extra = 5 if fault == "truncated" else 0
            o = [("D", 2, "", [])]
            if fault in ("", "truncated"):
                o.append(("K", extra, role[:1], [f"{role}:{text}"]))
                o += [("R", 1 + extra, t, [f"{roles[t]}:{text}"]) for t in "ua"]
            options.append(o)
        ins = [("", 0, "", [])] + [("I" * len(t), 5 * len(t), t, [f"{roles[c]}:" for c in t]) for t in ("u", "a", "ua", "au")]
        best = None
        for edits in itertools.product(*options):
            for gaps in itertools.product(ins, repeat=len(own) + 1):
                parts = [gaps[0], *(x for pair in zip(edits, gaps[1:]) for x in pair)]
                if LEGAL.fullmatch("".join(p[2] for p in parts)):
                    new = (sum(p[1] for p in parts), "".join(p[0] for p in parts), [x for p in parts for x in p[3]])
                    best = min(best or new, new)
        assert cheapest(own, bad) == best
        rows = [(role[:1], f in ("blank", "duplicate"), f == "truncated") for (_, role, _), f in zip(own, bad)]
        cost, steps = repair.replay(rows, 0, None)
        assert (cost, "".join(a for a, _ in steps)) == best[:2]


def test_empty(spark):
    assert run(spark.createDataFrame([], SCHEMA), 5) == []


def test_query(spark):
    rows = table(spark, SF_SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()
    got = E.queries()["op11_conversation_repair"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, got), key=repr) == expected([tuple(r) for r in rows])
