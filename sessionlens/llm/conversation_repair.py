"""Conversation structure repair by a generalised LR parse of the roles.

The role grammar ``S -> nothing | s P | P, P -> P E | E, E -> u a`` (system,
user, assistant) is compiled into an LR table. Reading a conversation, each row
may be kept (0), reroled to user or assistant (1) or deleted (2, the only way
for blank and duplicate rows); empty user or assistant rows may be inserted (5);
a truncated row that stays adds 5. All readings share one graph-structured
stack: a node is (LR state, node below), and at each row readings with the same
stack merge into the one with the least (cost, audit), the audit being the
string of edit initials. This is exact: readings with different stacks have
different audits, and none is the beginning of another at the same row, so
their order never changes later. The order is kept as a rank, never as a string.

Rows are first counted by (conversation, turn, role, text), so that repeated
rows are one row with its number. Later rows with a text that the role had
before are found by one aggregation and a join. The rows are then put in order
by range partitions, so that a conversation may hold most of all rows, and cut
into blocks of ``block_rows``. A conversation inside one block is repaired
there. One that meets a block's border is parsed from every stack it could
enter a block with; a block's small table (costs and order of entry and exit
stacks) is chained over the blocks, and the chosen ways are then replayed, block
by block. Only its SHA-256, sequential by nature, runs through one task, as a
stream of chunks of bounded size.

Defined results: a null conversation id is one conversation; null roles and
texts read as one blank; null turns come first; rows of one turn are ordered by
role, then by the MD5 of the text; a conversation without rows has an empty
repair at cost 0; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.session import cut_lineage

RULES = (("S", ""), ("S", "sP"), ("S", "P"), ("P", "PE"), ("P", "E"), ("E", "ua"))
ROLES = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLOCK_ROWS = 1 << 14
CHUNK_CHARS = 1 << 20
SHOWN = r"[^\x20\x09-\x0D]"


# -- the LR table and the stacks -------------------------------------------------

class RoleParser:
    """LR(0) states of ``RULES`` and the stacks that readings can have.

    The rules are left-recursive, so a stack never outgrows a few states and
    all stacks can be numbered: ``shift[(stack, terminal)]`` is the stack after
    reading a terminal and doing all reductions, ``accepting`` the stacks at
    which the conversation may end.
    """

    def __init__(self, rules=RULES):
        self.rules = rules
        heads = {h for h, _ in rules}

        def closure(items):
            items = set(items)
            while True:
                more = {(r, 0) for i, dot in items for r, (h, _) in enumerate(rules)
                        if rules[i][1][dot:dot + 1] == h} - items
                if not more:
                    return frozenset(items)
                items |= more

        def goto(items, symbol):
            return closure({(i, dot + 1) for i, dot in items if rules[i][1][dot:dot + 1] == symbol})

        start = rules[0][0]
        first = closure({(r, 0) for r, (h, _) in enumerate(rules) if h == start})
        self.nodes = {(first, None): 0}  # (state, node below) -> number
        self.stacks = [(first, None)]
        self.shift: dict[tuple[int, str], int] = {}
        terminals = {c for _, body in rules for c in body} - heads

        def push(node, symbol):
            state = goto(self.stacks[node][0], symbol)
            return self._node(state, node) if state else None

        todo, seen = [0], {0}
        while todo:
            node = todo.pop()
            for t in sorted(terminals):
                top = push(node, t)
                while top is not None:  # reduce what is complete, but for the start rule
                    whole = [rules[i] for i, dot in self.stacks[top][0] if dot == len(rules[i][1]) and rules[i][0] != start]
                    if not whole:
                        break
                    below = top
                    for _ in whole[0][1]:
                        below = self.stacks[below][1]
                    top = push(below, whole[0][0])
                if top is not None:
                    self.shift[node, t] = top
                    if top not in seen:
                        seen.add(top)
                        todo.append(top)
        self.accepting = {n for n, (state, _) in enumerate(self.stacks)
                          if any(rules[i][0] == start and dot == len(rules[i][1]) for i, dot in state)}

    def _node(self, state, below: int) -> int:
        key = (state, below)
        if key not in self.nodes:
            self.nodes[key] = len(self.stacks)
            self.stacks.append(key)
        return self.nodes[key]


PARSER = RoleParser()
Front = dict[int, tuple[int, int]]  # stack -> cost, rank of its audit


def inserted(front: Front) -> dict[int, tuple[int, int, str, int, str]]:
    """stack -> cost, rank, inserted terminals, stack before them, and the
    audit of the insertions; stacks merge by (cost, audit)."""
    out = {n: (c, r, "", n, "") for n, (c, r) in front.items()}
    todo = list(out)
    while todo:
        node = todo.pop()
        cost, rank, terms, origin, audit = out[node]
        for t in ROLES:
            to = PARSER.shift.get((node, t))
            if to is None:
                continue
            new = (cost + INSERT, rank, terms + t, origin, audit + "I")
            old = out.get(to)
            if old is None or (new[0], new[1], new[4]) < (old[0], old[1], old[4]):
                out[to] = new
                todo.append(to)
    return out


def step(front: Front, initial: str, must_go: bool, cut_off: bool) -> tuple[Front, dict[int, tuple[int, str, str]]]:
    """Reads one row. The new front, and for each of its stacks where it came
    from: stack, audit of the row (insertions and edit), terminals."""
    best: dict[int, tuple[int, int, str, int, str]] = {}
    for node, (cost, rank, terms, origin, audit) in inserted(front).items():
        moves = [(node, DELETE, "D", "")]
        if not must_go:
            stay = TRUNCATED if cut_off else 0
            if (node, initial) in PARSER.shift:
                moves.append((PARSER.shift[node, initial], stay, "K", initial))
            moves += [(PARSER.shift[node, t], REROLE + stay, "R", t) for t in ROLES if (node, t) in PARSER.shift]
        for to, more, edit, t in moves:
            new = (cost + more, rank, audit + edit, origin, terms + t)
            if to not in best or new[:3] < best[to][:3]:
                best[to] = new
    order = {n: k for k, n in enumerate(sorted(best, key=lambda n: best[n][1:3]))}
    return {n: (b[0], order[n]) for n, b in best.items()}, {n: (b[3], b[2], b[4]) for n, b in best.items()}


def ending(front: Front) -> tuple[int, int, str] | None:
    """Cost, stack before the last insertions, and these, of the best end."""
    ends = [(c, r, a, origin, terms) for n, (c, r, terms, origin, a) in inserted(front).items() if n in PARSER.accepting]
    if not ends:
        return None
    cost, _, _, origin, terms = min(ends)
    return cost, origin, terms


def replay(rows: list, entry: int, leave: int | None) -> tuple[int, list[tuple[str, str]]]:
    """Cost and (audit, terminals) of each row, from stack ``entry`` to stack
    ``leave``; None: to the end of the conversation, whose last insertions
    come as one more entry. rows: (initial, must_go, cut_off)."""
    front, ways = {entry: (0, 0)}, []
    for row in rows:
        front, way = step(front, *row)
        ways.append(way)
    tail = ""
    if leave is None:
        cost, leave, tail = ending(front)
    else:
        cost = front[leave][0]
    out, node = [("I" * len(tail), tail)], leave
    for way in reversed(ways):
        node, audit, terms = way[node]
        out.append((audit, terms))
    return cost, out[::-1]


def crossing(rows: list) -> tuple[list[int], list[int]]:
    """Costs and order of leaving with each stack, for each entering one (-1
    where there is no way)."""
    n = len(PARSER.stacks)
    costs, orders = [-1] * (n * n), [-1] * (n * n)
    for entry in range(n):
        front: Front = {entry: (0, 0)}
        for row in rows:
            front = step(front, *row)[0]
        for leave, (cost, rank) in front.items():
            costs[entry * n + leave], orders[entry * n + leave] = cost, rank
    return costs, orders


def chain(blocks: list[tuple[list[int], list[int]]]) -> tuple[int, list[tuple[int, int]]]:
    """Cost of the best way through the blocks, and its entering and leaving
    stack in each."""
    n = len(PARSER.stacks)
    front: Front = {0: (0, 0)}
    back = []
    for costs, orders in blocks:
        best: dict[int, tuple[int, tuple[int, int], int]] = {}
        for entry, (cost, rank) in front.items():
            for leave in range(n):
                if costs[entry * n + leave] >= 0:
                    new = (cost + int(costs[entry * n + leave]), (rank, int(orders[entry * n + leave])), entry)
                    if leave not in best or new < best[leave]:
                        best[leave] = new
        order = {x: k for k, x in enumerate(sorted(best, key=lambda x: best[x][1]))}
        front = {x: (b[0], order[x]) for x, b in best.items()}
        back.append({x: b[2] for x, b in best.items()})
    cost, node, _ = ending(front)
    ways = []
    for b in reversed(back):
        ways.append((b[node], node))
        node = b[node]
    return cost, ways[::-1]


# -- rows --------------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows with the faults that a checksum
    of ``conv_id:turn`` picks (see the query)."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), kind.alias("kind"),
        F.when(kind == 4, "user").otherwise(blank("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text")).alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies")).filter("kind <> 0").drop("kind")


def ordered(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The distinct rows (conv_id, turn, role, text, copies) in order, with
    their faults and their block (checkpointed)."""
    blank = ~F.col("text").rlike(SHOWN)
    rows = rows.groupBy("conv_id", "turn", "role", F.md5("text").alias("m")).agg(
        F.min("text").alias("text"), F.sum("copies").alias("copies"))
    said = rows.groupBy("conv_id", "role", "m").agg(
        F.count("*").alias("k"), F.min(F.struct("turn")).alias("lead")).filter("k > 1")
    said = said.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("m").alias("o"), F.col("lead.turn").alias("since"),
                       F.lit(True).alias("again"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("m") == F.col("o"))
    later = F.coalesce(F.col("again"), F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("since"))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    rows = rows.join(said, same, "left").select(
        "conv_id", "turn", "role", "m", "text", "copies", blank.alias("blank"), (~blank & later).alias("later"),
        (~blank & ~last.isin(".", "!", "?")).alias("cut_off"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "m")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("m")
    # the number of a partition and a row's place in it, fixed by the checkpoint
    return cut_lineage(rows.withColumn("at", F.monotonically_increasing_id())).withColumn(
        "block", F.floor(F.col("at") / block_rows).cast("long"))


_PIECE = ["conv_id", "block", "open", "blank", "duplicate", "truncated", "illegal", "low", "high", "turns", "first_turn",
          "last_turn", "first_role", "last_role", "cost", "audit", "repaired", "costs", "orders"]
_PIECE_SCHEMA = """conv_id long, block long, open boolean, blank long, duplicate long, truncated long, illegal long, low long,
  high long, turns long, first_turn long, last_turn long, first_role string, last_role string, cost long, audit string,
  repaired string, costs array<long>, orders array<long>"""


class Piece:
    """The rows of a conversation in one block."""

    def __init__(self, rows: list[tuple]):
        self.read: list[tuple[str, bool, bool]] = []  # initial, must go, cut off
        self.shown: list[tuple[str, str]] = []  # role, text
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        turns = []
        for turn, role, text, copies, blank, later, cut_off in rows:
            turns.append(turn)
            initial = role[:1]
            for k in range(copies):
                again = later or k > 0
                self.blank += blank
                self.duplicate += not blank and again
                self.truncated += cut_off and not again
                if self.read:
                    self.illegal += self.read[-1][0] + initial not in LEGAL_PAIRS
                self.read.append((initial, blank or again, cut_off))
                self.shown.append((role, text if k == 0 else ""))  # repeats go
        known = [t for t in turns if t is not None]
        self.low, self.high = (min(known), max(known)) if known else (None, None)
        self.turns = len(set(known))
        self.first_turn, self.last_turn = turns[0], turns[-1]

    def repaired(self, steps: list[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
        """edit, role and text of each kept, reroled or inserted row."""
        for (audit, terms), (role, text) in zip(steps, [*self.shown, ("", "")]):
            edits = [e for e in audit if e != "D"]
            for e, t in zip(edits, terms):
                yield e, (role if e == "K" else ROLES[t]), ("" if e == "I" else text)

    def facts(self) -> list:
        return [self.blank, self.duplicate, self.truncated, self.illegal, self.low, self.high, self.turns,
                self.first_turn, self.last_turn, self.read[0][0], self.read[-1][0]]


_COLUMNS = ["conv_id", "block", "turn", "role", "text", "copies", "blank", "later", "cut_off"]


def _read_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, int, bool, Piece]]:
    """conv_id, block, whether it may go on in another block, and the piece,
    from rows in order; holds the rows of one piece."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(len(_COLUMNS))))

    for block, inside in groupby(rows(), key=lambda r: r[1]):
        first, held = True, None
        for conv, own in groupby(inside, key=lambda r: r[0]):
            if held is not None:
                yield held[0], block, first, held[1]
                first = False
            held = conv, Piece([r[2:] for r in own])
        yield held[0], block, True, held[1]


def _joined(rows: Iterator[tuple[str, str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for _, role, text in rows)


def _pieces(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = []
        for conv, block, is_open, piece in _read_pieces(batches):
            if is_open:
                own = [None, None, None, *crossing(piece.read)]
            else:
                cost, steps = replay(piece.read, 0, None)
                text = _joined(piece.repaired(steps))
                own = [cost, "".join(a for a, _ in steps), hashlib.sha256(text.encode()).hexdigest(), None, None]
            out.append([conv, block, is_open, *piece.facts(), *own])
            if len(out) >= 1024:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return rows.select(*_COLUMNS).mapInArrow(run, _PIECE_SCHEMA)


_ARROW = pa.schema([(c, pa.bool_() if c == "open" else pa.string() if c in ("first_role", "last_role", "audit", "repaired")
                     else pa.list_(pa.int64()) if c in ("costs", "orders") else pa.int64()) for c in _PIECE])


def _batch(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def _chained(pieces: DataFrame) -> DataFrame:
    """conv_id, block, entry, leave, final, cost: the way of each open
    conversation through its blocks (a small row for each block)."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        cost, ways = chain(list(zip(group["costs"], group["orders"])))
        return pd.DataFrame({"conv_id": group["conv_id"], "block": group["block"], "entry": [w[0] for w in ways],
                             "leave": [w[1] for w in ways], "final": [False] * (len(ways) - 1) + [True], "cost": cost})

    return pieces.select("conv_id", "block", "costs", "orders").groupBy("conv_id").applyInPandas(
        run, "conv_id long, block long, entry int, leave int, final boolean, cost long")


def _replayed(rows: DataFrame, ways: DataFrame) -> DataFrame:
    """conv_id, block, part, edit, role, text: the repaired rows of open
    conversations, block by block; the first of each block carries its audit."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("at")
        entry, leave, final = (group[c].iloc[0] for c in ("entry", "leave", "final"))
        turns = [None if pd.isna(t) else int(t) for t in group["turn"]]
        piece = Piece(list(zip(turns, *(group[c] for c in ("role", "text", "copies", "blank", "later", "cut_off")))))
        front_end = None if final else int(leave)
        _, steps = replay(piece.read, int(entry), front_end)
        got = list(piece.repaired(steps))
        audit = "".join(a for a, _ in steps)
        return pd.DataFrame({"conv_id": group["conv_id"].iloc[0], "block": group["block"].iloc[0], "part": range(len(got) + 1),
                             "audit": [audit, *[None] * len(got)], "edit": [None, *[g[0] for g in got]],
                             "role": [None, *[g[1] for g in got]], "text": [None, *[g[2] for g in got]]})

    w = ways.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "entry", "leave", "final")
    on = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
    return rows.join(w, on).drop("c", "b").groupBy("conv_id", "block").applyInPandas(
        run, "conv_id long, block long, part long, audit string, edit string, role string, text string")


def _hashed(parts: DataFrame) -> DataFrame:
    """conv_id, repaired: SHA-256 of the repaired rows, streamed in order."""
    tasks = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = parts.select("conv_id", "block", "part", "role", "text").repartition(tasks, "conv_id").sortWithinPartitions(
        "conv_id", "block", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, begun = (), None, False
        done: list[tuple] = []
        for batch in batches:
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4))):
                if (conv,) != last:
                    if last:
                        done.append((last[0], state.hexdigest()))
                    last, state, begun = (conv,), hashlib.sha256(), False
                if role is not None:
                    state.update((("\n" if begun else "") + f"{role}:{text}").encode())
                    begun = True
        if last:
            done.append((last[0], state.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())],
                                         ["conv_id", "repaired"])

    return rows.mapInArrow(run, "conv_id long, repaired string")


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256 of every conversation that has rows (conv_id, turn, role,
    text, copies)."""
    rows = ordered(rows, block_rows)
    pieces = cut_lineage(_pieces(rows))
    closed, opened = pieces.filter("NOT open"), pieces.filter("open")
    ways = cut_lineage(_chained(opened))
    parts = cut_lineage(_replayed(rows, ways))
    names = ["conv_id", "blank", "duplicate", "truncated", "illegal", "low", "high", "turns", "cost", "audit", "repaired"]

    # piece by piece: sums, and what happens at the borders
    seam = F.aggregate(
        F.sequence(F.lit(1), F.size("p") - 1), F.struct(F.lit(0).cast("long").alias("illegal"), F.lit(0).cast("long").alias("turns")),
        lambda a, i: F.struct(
            (a["illegal"] + (~F.concat(F.col("p")[i - 1]["last_role"], F.col("p")[i]["first_role"]).isin(*LEGAL_PAIRS)).cast("long")).alias("illegal"),
            (a["turns"] + F.coalesce(F.col("p")[i - 1]["last_turn"] == F.col("p")[i]["first_turn"], F.lit(False)).cast("long")).alias("turns")))
    none = F.struct(F.lit(0).cast("long").alias("illegal"), F.lit(0).cast("long").alias("turns"))
    whole = opened.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "turns")], F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.array_sort(F.collect_list(F.struct("block", "first_turn", "last_turn", "first_role", "last_role"))).alias("p"))
    whole = whole.withColumn("seam", F.when(F.size("p") > 1, seam).otherwise(none)).select(
        "conv_id", "blank", "duplicate", "truncated", (F.col("illegal") + F.col("seam.illegal")).alias("illegal"), "low", "high",
        (F.col("turns") - F.col("seam.turns")).alias("turns"))
    audits = parts.filter("part = 0").groupBy(F.col("conv_id").alias("c1")).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    costs = ways.filter("final").select(F.col("conv_id").alias("c2"), "cost")
    hashes = _hashed(parts).withColumnRenamed("conv_id", "c3")
    for extra, c in ((audits, "c1"), (costs, "c2"), (hashes, "c3")):
        whole = whole.join(extra, F.col("conv_id").eqNullSafe(F.col(c)))
    found = closed.select(*names).unionByName(whole.select(*names))
    return found.select(
        "conv_id", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps"), "blank",
        "duplicate", "truncated", "illegal", "cost", "audit", F.col("repaired").alias("repaired_sha256"))


def with_all(found: DataFrame, conversations: DataFrame) -> DataFrame:
    """``found`` for every conversation id, also those left without rows."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("id")).distinct()
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"), *[zero[c].alias(c) for c in zero], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
