"""N-gram Jaccard join with count-vector R-trees.

Two texts link when the Jaccard similarity of their sets of word n-grams is at
least ``percent`` / 100, exactly. The result gives every document its class of
linked documents. Steps:

1. *Points.* Tokens (n-gram hashes) are hashed into groups, more for larger
   sets; the counts per group are a document's point. Groups nest, so points
   fold to fewer groups: trees use about eight tokens a group, the last bound
   before verification one or two. Documents with equal sets are one
   class from here on (hash aggregation, so a third of the corpus being copies
   of one text costs one row a task).
2. *Cells.* A pair above the threshold shares a token among the first
   ``|A| - ceil(t |A|) + 1`` of each, in any common order of tokens, and at
   least ``s`` among the first ``|A| - ceil(t |A|) + s``: sets that share fewer
   of these with any other set have no link and are left out. A pair's
   sizes lie in one size band or in two that follow each other (a band spans
   the factor t). Tokens met often in a bounded sample come last in the order;
   the sample only sets the order, so it changes cost and never results. Each
   (token, band) held by two classes or more is a cell, with the classes of its
   band and of the band below; of cells with equal members one is kept.
3. *First links.* Each member is compared with its cell's least member and
   with one that a hash picks for each cell, so that a group without one near
   centre hangs together too, and linked classes are joined into components.
   This leaves few pairs to check in a large group of near copies.
4. *R-trees.* Cells that still hold two components or more are dealt, by band
   and then by token, into *slabs* of bounded size; a cell above
   ``block_points`` members meets in pairs of blocks. A slab gets each class
   once, with its point and the list of its cells there. The points of a cell
   are packed into leaves with their maxima; summed coordinate minima bound the
   overlap of two leaves, then of two points, last of two points at all their
   groups. Pairs of one component are skipped, and pairs that a slab finds in
   several cells are one row.
5. *Verification.* Surviving pairs are compared by their full sets, and their
   links close the components.

One global tree over all points would not do: with Jaccard 0.8 or 0.9 the ball
around a point crosses nearly every split of the few dimensions a tree of any
feasible depth uses, so every query would visit nearly all leaves.

Defined results: null, empty and blank texts have an empty set and are classes
of their own; texts shorter than n words have one token, the whole sequence;
repeated rows are copies; a row without an id has no component and links
nothing; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.llm.components import components
from sessionlens.llm.tables import id_text, text_batches
from sessionlens.llm.textblock import SPACE_WORDS, blocks, mix, ngram_hashes, signed, utf8
from sessionlens.session import cut_lineage

N = 5
PERCENT = 80
SAMPLE_DOCS = 4_000
COMMON_TOKENS = 1 << 19
BLOCK_POINTS = 1_024
SLAB_WEIGHT = 1 << 16
PAIRS_AT_ONCE = 1 << 20
LEAF = 32
BROADCAST_PAIRS = 1 << 19  # three longs each


def token_sets(texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    for b in blocks(texts, SPACE_WORDS, lower=True):
        words = b.hashes()
        grams = ngram_hashes(words, n)
        for i in range(len(b)):
            first, last = int(b.first[i]), int(b.first[i + 1])
            if last - first >= n:
                yield np.unique(grams[first:last - n + 1])
            else:
                yield ngram_hashes(words[first:last], last - first) if last > first else words[:0]


def class_key(tokens: np.ndarray) -> int:
    """64-bit key of a set, whatever its order."""
    return int(signed(mix(np.array([mix(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))], np.uint64)))[0])


def counts(tokens: np.ndarray, bits: int = 9, load: int = 2) -> bytes:
    """Counts of the groups, named by the leading bits of a token: one byte
    with the number of bits (``bits``, and 2 more each time the set outgrows
    ``load`` tokens a group), then the counts in the narrowest unsigned type."""
    while len(tokens) > load << bits and bits < 15:
        bits += 2
    v = np.bincount((mix(tokens) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    top = int(v.max())
    return bytes([bits]) + v.astype(np.uint8 if top < 256 else np.uint16 if top < 65536 else np.uint32).tobytes()


def point(packed: bytes) -> np.ndarray:
    width = (len(packed) - 1) >> packed[0]
    return np.frombuffer(packed, {1: np.uint8, 2: np.uint16, 4: np.uint32}[width], offset=1)


def fold(p: np.ndarray, groups: int) -> np.ndarray:
    """The point over fewer groups: neighbours add up."""
    return p.reshape(groups, -1).sum(1, dtype=np.int32)


def points(packed: list[bytes]) -> np.ndarray:
    """Points over the most groups that all of them have."""
    groups = 1 << min(v[0] for v in packed)
    out = [fold(point(v), groups) for v in packed]
    return np.array(out, np.uint16 if max(int(p.max()) for p in out) < 65536 else np.int32)


def tree_points(fine: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The points over fewer groups, about eight tokens each, for the trees."""
    groups = min(fine.shape[1], max(64, 1 << (int(size.max()) // 8).bit_length()))
    return fine.reshape(len(fine), groups, -1).sum(2, dtype=np.int32)


def overlap_bound(a: bytes, b: bytes) -> int:
    """Summed coordinate minima at the groups both points have."""
    x, y = point(a), point(b)
    if len(x) > len(y):
        x = fold(x, len(y))
    elif len(y) > len(x):
        y = fold(y, len(x))
    return int(np.minimum(x, y).sum(dtype=np.int64))


def _least(size: int, percent: int) -> int:
    """Fewest tokens that a set of this size shares with a linked set."""
    return -(-percent * size // 100)


def _spare(size: int, percent: int) -> int:
    """How many tokens the prefixes of two linked sets share at least, when
    each is that much longer (less one) than one common token needs."""
    return size * (100 - percent) // 400 + 1


class Order:
    """The common order of tokens: rank in the sample, then hash."""

    def __init__(self, tokens: np.ndarray, rank: np.ndarray):
        by = np.argsort(tokens)
        self.tokens, self.rank = tokens[by], rank[by]

    def first(self, tokens: np.ndarray, k: int) -> np.ndarray:
        if len(self.tokens) == 0:
            return tokens[:k]
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        rank = np.where(self.tokens[at] == tokens, self.rank[at], 0)
        return tokens[np.argsort(rank, kind="stable")[:k]]

    def known(self, tokens: np.ndarray) -> int:
        """How many of these tokens, all last in the order, the sample holds."""
        if len(self.tokens) == 0:
            return 0
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return int((self.tokens[at] == tokens).sum())


def sample_order(docs: DataFrame, n: int, sample_docs: int = SAMPLE_DOCS) -> Order:
    """Order from about ``sample_docs`` documents and at most
    ``COMMON_TOKENS`` tokens."""
    step = max(1, docs.count() // sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in token_sets(utf8(batch.column(0)), n):
                yield pa.RecordBatch.from_arrays([pa.array(signed(s))], ["token"])

    tokens = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0).select("text").mapInArrow(run, "token long")
    often = tokens.groupBy("token").count().filter("count > 1").orderBy(F.desc("count"), "token").limit(COMMON_TOKENS)
    got = often.collect()
    return Order(np.array([r.token for r in got], np.int64).view(np.uint64), np.array([r["count"] for r in got], np.int64))


def signatures(docs: DataFrame, n: int, percent: int, order: Order) -> DataFrame:
    """doc_id, key, size, the prefix tokens (the last ``common`` of them are
    in the sample), fine and coarse point of each set."""
    sent = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(1))
            for at in range(0, len(texts), 512):
                keys, sizes, prefixes, common, fine, coarse = [], [], [], [], [], []
                for s in token_sets(texts[at:at + 512], n):
                    k = len(s)
                    keys.append(class_key(s))
                    sizes.append(k)
                    prefix = sent.value.first(s, k - _least(k, percent) + _spare(k, percent) if k else 0)
                    prefixes.append(signed(prefix))
                    common.append(sent.value.known(prefix))
                    fine.append(counts(s))
                    coarse.append(counts(s, 6, 8))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(keys)), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(prefixes, pa.list_(pa.int64())), pa.array(common, pa.int64()), pa.array(fine, pa.binary()), pa.array(coarse, pa.binary())],
                    ["doc_id", "key", "size", "prefix", "common", "fine", "coarse"])

    return docs.mapInArrow(run, "doc_id long, key long, size long, prefix array<long>, common long, fine binary, coarse binary")


def memberships(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, key and size only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(class_key(s), len(s)) for s in token_sets(utf8(batch.column(1)), n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([k for k, _ in sets], pa.int64()), pa.array([c for _, c in sets], pa.int64())],
                ["doc_id", "key", "size"])

    return docs.mapInArrow(run, "doc_id long, key long, size long")


def cells(classes: DataFrame, percent: int) -> DataFrame:
    """token, band, key, size, held, leader and picked (the cell's least member
    and one by a hash, with their sizes): the members of each kept cell."""
    rows = classes.select("key", "size", (F.size("prefix") - F.col("common")).alias("rare"), F.posexplode("prefix").alias("place", "token"))
    # tokens of the sample may be in most sets and count as shared; others are
    # counted in one shuffle, in which none of them can be frequent
    often = rows.filter("place >= rare").drop("rare")
    seldom = rows.filter("place < rare").drop("rare")
    held = F.count("*").over(Window.partitionBy("token"))
    live = seldom.withColumn("n", held).filter("n > 1").drop("n").unionByName(often)
    # a linked set is no smaller than `least`, so both prefixes share its `spare` tokens or more
    least = F.expr(f"({percent} * size + 99) div 100")
    shared = F.count("*").over(Window.partitionBy("key"))
    live = live.withColumn("n", shared).filter(
        (F.col("n") >= F.floor(least * (100 - percent) / 400) + 1) & (F.col("place") <= F.col("size") - least))
    # a little wider than the threshold, so that rounding parts no pair
    width = math.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1.0
    own = F.floor(F.log(F.col("size").cast("double")) / width).cast("int")
    # narrow rows, dealt out before the cells' wide buffers are made: cells and members read what leads here once
    live = live.select("key", "size", "token", F.explode(F.array(own, own + 1)).alias("band"))
    live = live.filter("token IS NOT NULL AND band IS NOT NULL").repartition("token", "band")  # the join's filter: one shuffle for both
    cell = live.withColumn("own", own).groupBy("token", "band").agg(
        F.count("*").alias("held"), F.max("own").alias("top"), F.min(F.struct("key", "size")).alias("leader"),
        F.min(F.struct(F.xxhash64("key", "token").alias("h"), "key", "size")).alias("picked"), F.bit_xor(F.xxhash64("key")).alias("who"))
    # cells of the band below alone were whole in that band
    cell = cell.filter("held > 1 AND top = band").drop("top")
    kept = cell.groupBy("band", "held", "leader", "who").agg(F.min(F.struct("token", "picked")).alias("m")).select(
        "band", "held", "leader", "m.token", "m.picked")
    return live.join(kept, ["token", "band"])


def _reaches(overlap, size_a, size_b, percent: int):
    """100 * overlap >= percent * union, with union = |A| + |B| - overlap."""
    return (100 + percent) * overlap >= percent * (size_a + size_b)


class Leaves:
    """Points packed into leaves: by component and size first, so that leaves
    are small boxes and many hold one component only."""

    def __init__(self, which: np.ndarray, component: np.ndarray, size: np.ndarray, point: np.ndarray):
        order = which[np.lexsort((point[which].argmax(1), component[which], size[which]))]
        self.members = [order[i:i + LEAF] for i in range(0, len(order), LEAF)]
        self.top = np.stack([point[m].max(0) for m in self.members])
        self.small = np.array([size[m].min() for m in self.members])
        self.only = np.array([component[m[0]] if (component[m] == component[m[0]]).all() else -1 for m in self.members])


def tree_join(a: Leaves, b: Leaves, same: bool, component: np.ndarray, size: np.ndarray, point: np.ndarray,
              percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of different components whose bound reaches the threshold."""
    left, right = [], []
    for i, mine in enumerate(a.members):
        start = i if same else 0
        bound = np.minimum(a.top[i], b.top[start:]).sum(1)
        near = _reaches(bound, a.small[i], b.small[start:], percent)
        near &= ~((a.only[i] == b.only[start:]) & (a.only[i] >= 0))
        for j in (np.flatnonzero(near) + start).tolist():
            theirs = b.members[j]
            overlap = np.minimum(point[mine][:, None, :], point[theirs][None, :, :]).sum(2)
            ok = _reaches(overlap, size[mine][:, None], size[theirs][None, :], percent)
            ok &= component[mine][:, None] != component[theirs][None, :]
            if same and i == j:
                ok &= np.tri(len(mine), len(theirs), -1, dtype=bool)
            x, y = np.nonzero(ok)
            left.append(mine[x])
            right.append(theirs[y])
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def slabs(members: DataFrame, classes: DataFrame, block_points: int, slab_weight: int) -> DataFrame:
    """slab, key, component, size, fine, cells: each class once in each slab
    that it has cells in, from rows (token, band, held, key, component). The
    cells of a band lie in as many slabs as its members and points need."""
    nb = F.ceil(F.col("held") / block_points).cast("int")
    mine = F.pmod(F.xxhash64("key", "token"), nb).cast("int")
    rows = members.withColumn("nb", nb).withColumn("mine", mine)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).select(
        "key", "component", "band", F.struct("token", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                                             "mine").alias("cell"))
    facts = classes.select("key", "size", "fine")
    weights = classes.select("key", (1 + F.octet_length("fine") / 1024).alias("weight"))  # the points stay where they are
    bands = rows.join(weights, "key").groupBy("band").agg(F.ceil(F.sum("weight") / slab_weight).alias("n"))
    part = F.pmod(F.xxhash64("cell.token", "cell.i", "cell.j"), F.col("n"))
    rows = rows.join(F.broadcast(bands), "band").withColumn("slab", F.struct("band", part.alias("part")))  # a row a band
    once = rows.groupBy("key", "slab").agg(F.first("component").alias("component"), F.collect_list("cell").alias("cells"))
    return once.join(facts, "key")


def candidate_pairs(members: DataFrame, classes: DataFrame, percent: int, block_points: int = BLOCK_POINTS,
                    slab_weight: int = SLAB_WEIGHT) -> DataFrame:
    """Distinct (a, b) that pass the bound, from rows (token, band, held, key,
    component)."""
    rows = slabs(members, classes, block_points, slab_weight)
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select("slab.band", "slab.part", "key", "component", "size", "fine", "cells")
    rows = rows.repartition(parts, "band", "part").sortWithinPartitions("band", "part")

    def cell_pairs(at: np.ndarray, block: np.ndarray, split: bool, component, size, packed) -> tuple[np.ndarray, np.ndarray]:
        fine = points([packed[i] for i in at.tolist()])
        component, size = component[at], size[at]
        point = tree_points(fine, size)
        own = np.arange(len(at))
        if not split:
            leaves = Leaves(own, component, size, point)
            x, y = tree_join(leaves, leaves, True, component, size, point, percent)
        else:
            one, two = own[block == block.min()], own[block != block.min()]
            x, y = tree_join(Leaves(one, component, size, point), Leaves(two, component, size, point), False,
                             component, size, point, percent)
        ok = np.zeros(len(x), bool)
        step = max(1, (1 << 22) // fine.shape[1])
        for k in range(0, len(x), step):
            i, j = x[k:k + step], y[k:k + step]
            ok[k:k + step] = _reaches(np.minimum(fine[i], fine[j]).sum(1, dtype=np.int64), size[i], size[j], percent)
        return at[x[ok]], at[y[ok]]

    def slab_pairs(t: pa.Table) -> pa.RecordBatch | None:
        key, size = t.column("key").to_numpy(), t.column("size").to_numpy()
        # component names become small numbers
        component = np.unique(t.column("component").to_numpy(), return_inverse=True)[1]
        packed = t.column("fine").to_pylist()
        lists = t.column("cells").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        row = np.repeat(np.arange(t.num_rows), lists.value_lengths().to_numpy())
        token, i, j, mine = (lists.flatten().field(c).to_numpy() for c in ("token", "i", "j", "mine"))
        order = np.lexsort((j, i, token))
        token, i, j, mine, row = token[order], i[order], j[order], mine[order], row[order]
        cut = np.flatnonzero((token[1:] != token[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
        pairs, n_pairs = [], 0
        for start, stop in zip([0, *cut.tolist()], [*cut.tolist(), len(row)]):
            at, block = row[start:stop], mine[start:stop]
            split = bool(i[start] != j[start])
            if len(at) < 2 or (component[at] == component[at[0]]).all() or (split and (block == block[0]).all()):
                continue
            x, y = cell_pairs(at, block, split, component, size, packed)
            if len(x):
                pairs.append(np.minimum(x, y) * len(key) + np.maximum(x, y))
                n_pairs += len(x)
                if n_pairs > PAIRS_AT_ONCE:  # cells repeat each other's pairs
                    pairs = [np.unique(np.concatenate(pairs))]
                    n_pairs = len(pairs[0])
        if not pairs:
            return None
        found = np.unique(np.concatenate(pairs))
        x, y = key[found // len(key)], key[found % len(key)]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []  # the open slab
        last = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            band, part = t.column("band").to_numpy(), t.column("part").to_numpy()
            cuts = [0, *(np.flatnonzero((band[1:] != band[:-1]) | (part[1:] != part[:-1])) + 1).tolist(), t.num_rows]
            for start, stop in zip(cuts, cuts[1:]):
                if start == stop:
                    continue
                here = (int(band[start]), int(part[start]))
                if here != last and held:
                    if (got := slab_pairs(pa.concat_tables(held))) is not None:
                        yield got
                    held = []
                last = here
                held.append(t.slice(start, stop - start))
        if held and (got := slab_pairs(pa.concat_tables(held))) is not None:
            yield got

    return rows.mapInArrow(run, "a long, b long").distinct()


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, n: int, percent: int,
           broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """The pairs of classes whose full sets reach the threshold. Only texts of
    classes in a pair move; the pairs are sent to the texts while their count
    is within ``broadcast_pairs``, and meet them in a shuffle beyond it."""
    doc = lambda s: classes.select(F.col("key").alias(s), F.col("doc_id").alias(f"doc_{s}"))
    pairs = cut_lineage(pairs.join(doc("a"), "a").join(doc("b"), "b").select("a", "b", "doc_a", "doc_b"))
    small = pairs.count() <= broadcast_pairs

    def texts(rows: DataFrame, side: str) -> DataFrame:
        rows = F.broadcast(rows) if small else rows
        return docs.join(rows, docs["doc_id"] == rows[f"doc_{side}"]).drop("doc_id", f"doc_{side}").withColumnRenamed(
            "text", f"text_{side}")

    both = texts(pairs.drop("doc_a"), "b").join(texts(pairs.select("a", "doc_a").distinct(), "a"), "a")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ok = []
            for i, (x, y) in enumerate(zip(token_sets(utf8(batch.column(2)), n), token_sets(utf8(batch.column(3)), n))):
                # an id may be repeated with another text, of another class
                mine = class_key(x) == a[i] and class_key(y) == b[i]
                ok.append(mine and bool(_reaches(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent)))
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(ok, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def near_bound(pairs: DataFrame, classes: DataFrame, percent: int, of: str) -> DataFrame:
    """Pairs whose summed coordinate minima, of the points ``of``, reach the threshold."""
    side = lambda s: classes.select(F.col("key").alias(s), F.col("size").alias(f"size_{s}"), F.col(of).alias(f"point_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "size_a", "size_b", "point_a", "point_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())
            bound = np.array([overlap_bound(a, b) for a, b in pairs], np.int64)
            ok = pa.array(_reaches(bound, batch.column(2).to_numpy(), batch.column(3).to_numpy(), percent), pa.bool_())
            yield pa.RecordBatch.from_arrays([c.filter(ok) for c in batch.columns[:2]], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def _classes(docs: DataFrame, n: int, percent: int, sample_docs: int) -> DataFrame:
    """key, doc_id, size, prefix and points of each distinct set (checkpointed)."""
    known = docs.filter(F.col("doc_id").isNotNull())
    signed_docs = signatures(known, n, percent, sample_order(known, n, sample_docs)).filter("size > 0")
    least = F.min(F.struct("doc_id", "size", "prefix", "common", "fine", "coarse")).alias("m")
    return cut_lineage(signed_docs.groupBy("key").agg(least).select("key", "m.*"))


def _within(size_a, size_b, percent: int):
    """Whether sets of these sizes can reach the threshold at all."""
    return 100 * F.least(size_a, size_b) >= percent * F.greatest(size_a, size_b)


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of the cells that hold two components or more, with these."""
    placed = members.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "component", F.coalesce("root", "key")).drop("root")
    mixed = placed.groupBy("token", "band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return cut_lineage(placed.join(mixed.filter("lo <> hi").select("token", "band"), ["token", "band"]))


def join_classes(docs: DataFrame, n: int = N, percent: int = PERCENT, sample_docs: int = SAMPLE_DOCS,
                 block_points: int = BLOCK_POINTS) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id reachable by
    links) of every row."""
    text_batches(docs.sparkSession)
    docs = id_text(docs)
    classes = _classes(docs, n, percent, sample_docs)
    members = cut_lineage(cells(classes, percent))
    star = None
    for head in ("leader", "picked"):
        apart = (F.col("key") != F.col(f"{head}.key")) & _within(F.col("size"), F.col(f"{head}.size"), percent)
        pairs = members.filter(apart).select(F.least("key", f"{head}.key").alias("a"), F.greatest("key", f"{head}.key").alias("b"))
        star = pairs if star is None else star.union(pairs)
    star = cut_lineage(near_bound(star.distinct(), classes, percent, "coarse"))
    links = verify(near_bound(star, classes, percent, "fine"), classes, docs, n, percent)
    labels = components(links)  # key -> root
    pairs = cut_lineage(candidate_pairs(_open(members, labels), classes, percent, block_points))
    more = verify(pairs, classes, docs, n, percent)
    root = lambda side: labels.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
    joined = more.join(root("a"), "a", "left").join(root("b"), "b", "left").select(
        F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    upper = components(joined).select(F.col("node").alias("root"), F.col("root").alias("top"))

    final = classes.select("key", "doc_id").join(labels.withColumnRenamed("node", "key"), "key", "left")
    final = final.select("key", "doc_id", F.coalesce("root", "key").alias("root")).join(upper, "root", "left").select(
        "key", "doc_id", F.coalesce("top", "root").alias("top"))
    smallest = final.groupBy("top").agg(F.min("doc_id").alias("component_id"))
    of_key = final.join(smallest, "top").select("key", "component_id")
    rows = memberships(docs, n).join(of_key, "key", "left")
    return rows.select(
        "doc_id", F.col("size").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("size") > 0, F.col("component_id")), "doc_id")).alias("component_id"))


def link_counts(docs: DataFrame, n: int = N, percent: int = PERCENT, sample_docs: int = SAMPLE_DOCS,
                block_points: int = BLOCK_POINTS) -> DataFrame:
    """component_id, n_rows, n_links and n_equal of every component: its rows
    with an id, the pairs of them that link, and those with equal sets.

    No pair of sets is skipped for being in one component, so the work grows
    with the links between different sets. Rows of equal sets are counted by
    their number and never become pairs.
    """
    text_batches(docs.sparkSession)
    docs = id_text(docs)
    classes = _classes(docs, n, percent, sample_docs)
    members = cut_lineage(cells(classes, percent)).select("token", "band", "held", "key", F.col("key").alias("component"))
    pairs = candidate_pairs(members, classes, percent, block_points)
    links = cut_lineage(verify(pairs, classes, docs, n, percent).distinct())
    zero = F.lit(0).cast("long")

    sizes = memberships(docs.filter(F.col("doc_id").isNotNull()), n)
    rows = sizes.filter("size > 0").groupBy("key").agg(F.count("*").alias("m"), F.min("doc_id").alias("least"))
    rows = rows.join(components(links).withColumnRenamed("node", "key"), "key", "left")
    rows = cut_lineage(rows.withColumn("root", F.coalesce("root", "key")))
    side = lambda s: rows.select(F.col("key").alias(s), F.col("m").alias(f"m_{s}"))
    between = links.join(side("a"), "a").join(side("b"), "b").join(rows.select(F.col("key").alias("a"), "root"), "a")
    between = between.groupBy("root").agg(F.sum(F.col("m_a") * F.col("m_b")).alias("between"))
    equal = F.sum(F.expr("m * (m - 1) div 2"))
    whole = rows.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("m").alias("n_rows"), equal.alias("n_equal"))
    whole = whole.join(between, "root", "left").select(
        "component_id", "n_rows", (F.coalesce("between", zero) + F.col("n_equal")).alias("n_links"), "n_equal")
    bare = sizes.filter("size = 0").groupBy(F.col("doc_id").alias("component_id")).agg(F.count("*").alias("n_rows"))
    return whole.unionByName(bare.withColumns({"n_links": zero, "n_equal": zero}))


def keep_first(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """One document of each class, the one with the smallest id (rows that
    repeat this id stay with it). Documents without an id stay."""
    drop = cut_lineage(join_classes(docs, n, percent).filter("doc_id <> component_id").select("doc_id").distinct())
    return docs.join(F.broadcast(drop) if drop.count() <= BROADCAST_PAIRS else drop, "doc_id", "left_anti")
