"""WARC archives and their Merkle fixity audit.

Pages become WARC records, one per distinct (page_id, url, html), ordered by
page and content and written as gzip part files. A manifest gives each record
its number, its offset in the concatenated uncompressed archive, its length and
its hash. Records are the leaves of a tree: ranges of ``RANGE_BYTES`` of
offsets are the lowest nodes, ``FANOUT`` nodes make one above, up to one root.

A replica's tree is built from its own files alone: its records in the order
of its files, at its own offsets. ``audit`` compares the two roots, then goes
down level by level, joining only children of nodes that differ. Leaves are
read and matched by id for differing ranges alone; every record in an equal
range is intact. A lost or added record shifts all that follows it, so those
ranges differ too, and their records are reported as moved by that shift.

Sums along the order are two-level: within range partitions, then over one row
a partition. No level gathers more than ``FANOUT`` children or one range.

Defined results: null url or html counts as empty, a null page_id sorts last;
repeated rows are one record with their number in ``copies``; an empty table
gives an empty manifest and an audit without rows; a part file that ends early
or cannot be unpacked counts up to its fault; a record whose id is unreadable
is extra, and the listed one missing; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionlens.session import cut_lineage

RANGE_BYTES = 1 << 20
FANOUT = 16
RECORDS_A_FILE = 2_000  # a file is read whole by one task
END = "\r\n\r\n"


def records(pages: DataFrame) -> DataFrame:
    """page_id, record_id, head, html of every page; equal pages share an id."""
    url, html = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("url", "html"))
    page = F.col("page_id").cast("long")
    rid = F.sha2(F.concat_ws("\n", F.coalesce(page.cast("string"), F.lit("-")), F.length(url).cast("string"), url, html), 256)
    rows = pages.select(page.alias("page_id"), rid.alias("record_id"), url.alias("url"), html.alias("html"))
    # a header field is one line
    target = F.regexp_replace("url", "[\r\n]", " ")
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:sha256:"), F.col("record_id"),
                    F.lit(">\r\nWARC-Target-URI: "), target, F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                    F.octet_length("html").cast("string"), F.lit(END))
    return rows.select("page_id", "record_id", head.alias("head"), "html")


def _parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_archive(recs: DataFrame, path: str) -> None:
    """Ordered part files, each a gzip WARC file of whole records."""
    order = [F.col("page_id").asc_nulls_last(), F.col("record_id")]
    # equal records meet in the same range, so dropping copies needs no further shuffle
    rows = recs.repartitionByRange(_parts(recs.sparkSession), *order).dropDuplicates(["page_id", "record_id"])
    rows = rows.sortWithinPartitions(*order)
    lines = rows.select(F.concat("head", "html").alias("value")).write.option("lineSep", END)
    lines.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_A_FILE).text(path)


def unpack(packed: bytes) -> bytes:
    """The bytes of a gzip file (of any number of members) up to its first fault."""
    out = []
    while packed:
        member = zlib.decompressobj(31)
        for at in range(0, len(packed), 1 << 16):
            try:
                out.append(member.decompress(packed[at:at + (1 << 16)]))
            except zlib.error:
                return b"".join(out)
            if member.eof:
                packed = member.unused_data + packed[at + (1 << 16):]
                break
        else:
            return b"".join(out)
    return b"".join(out)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """file, place, record_id, length and sha256 of every record in the part
    files: ``place`` is the record's number in its file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rid, length, digest = [], [], []
                for name, whole in split_records(unpack(packed)):
                    rid.append(name)
                    length.append(len(whole))
                    digest.append(hashlib.sha256(whole).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * len(rid), pa.string()), pa.array(range(len(rid)), pa.int64()),
                     pa.array(rid, pa.string()), pa.array(length, pa.int64()), pa.array(digest, pa.string())],
                    ["file", "place", "record_id", "length", "sha256"])

    files = spark.read.format("binaryFile").load(f"{path}/part-*").select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return files.mapInArrow(run, "file string, place long, record_id string, length long, sha256 string")


def split_records(data: bytes) -> Iterator[tuple[str, bytes]]:
    """(id, bytes) of each record. A broken length is repaired by the next
    record start, so damage stays inside its record."""
    at, mark, end = 0, b"WARC/1.1\r\n", END.encode()
    while at < len(data):
        body = data.find(end, at)
        head = data[at:body if body >= 0 else len(data)].decode("utf-8", "replace")
        fields = dict(line.partition(": ")[::2] for line in head.split("\r\n")[1:])
        size = fields.get("Content-Length", "")
        stop = body + 4 + int(size) + 4 if body >= 0 and size.isdigit() else -1
        if not (0 <= stop <= len(data) and data[stop - 4:stop] == end and data[stop:stop + 10] in (b"", mark)):
            nxt = data.find(end + mark, at + 1)
            stop = nxt + 4 if nxt >= 0 else len(data)
        yield fields.get("WARC-Record-ID", "").removeprefix("<urn:sha256:").removesuffix(">"), data[at:stop]
        at = stop


def _placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """The rows with ``ordinal`` and ``offset`` along the order (checkpointed)."""
    rows = rows.repartitionByRange(_parts(rows.sparkSession), *order).withColumn("part", F.spark_partition_id())
    rows = cut_lineage(rows)  # the sampled bounds must not move between reads
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("part").agg(F.count("*").alias("n"), F.sum("length").alias("bytes"))
    zero = F.lit(0).cast("long")
    base = totals.select("part", F.coalesce(F.sum("n").over(before), zero).alias("n0"),
                         F.coalesce(F.sum("bytes").over(before), zero).alias("b0"))
    rows = rows.withColumns({"n1": F.count("*").over(inside), "b1": F.coalesce(F.sum("length").over(inside), zero)})
    rows = rows.join(base, "part").withColumns({"ordinal": F.col("n0") + F.col("n1"), "offset": F.col("b0") + F.col("b1")})
    return rows.drop("part", "n0", "n1", "b0", "b1")


def manifest(recs: DataFrame) -> DataFrame:
    """page_id, record_id, copies, ordinal, offset, length, sha256."""
    whole = F.concat("head", "html", F.lit(END))
    rows = recs.select("page_id", "record_id", F.octet_length(whole).cast("long").alias("length"),
                       F.sha2(whole, 256).alias("sha256"))
    rows = rows.groupBy("record_id").agg(F.first("page_id").alias("page_id"), F.first("length").alias("length"),
                                         F.first("sha256").alias("sha256"), F.count("*").alias("copies"))
    return _placed(rows, [F.col("page_id").asc_nulls_last(), F.col("record_id")]).select(
        "page_id", "record_id", "copies", "ordinal", "offset", "length", "sha256")


def placed_replica(replica: DataFrame) -> DataFrame:
    """record_id, sha256, length, ordinal and offset of a replica's records,
    in the order of its files (by their task and file numbers, then name)."""
    number = lambda rx: F.regexp_extract("file", rx, 1).try_cast("long")
    rows = replica.select("file", "place", "record_id", "length", "sha256").withColumns(
        {"task": number(r"^part-(\d+)"), "split": number(r"-c(\d+)")})
    order = [F.col(c) for c in ("task", "split", "file", "place")]
    return _placed(rows, order).select("record_id", "sha256", "length", "ordinal", "offset")


def _node(children: Column) -> Column:
    return F.sha2(F.array_join(F.transform(F.array_sort(children), lambda c: F.concat_ws(":", c["at"].cast("string"), c["digest"])), "\n"), 256)


def _range(range_bytes: int) -> Column:
    return F.floor(F.col("offset") / range_bytes).cast("long")


def tree(leaves: DataFrame, last: int, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels (node, digest) from ranges to the root over nodes 0 to ``last``,
    from (offset, sha256)."""
    children = F.collect_list(F.struct(F.col("offset").alias("at"), F.col("sha256").alias("digest")))  # one range
    levels = [cut_lineage(leaves.groupBy(_range(range_bytes).alias("node")).agg(_node(children).alias("digest")))]
    while last > 0:
        up = F.floor(F.col("node") / fanout).cast("long")
        children = F.collect_list(F.struct(F.col("node").alias("at"), F.col("digest")))  # at most ``fanout``
        levels.append(cut_lineage(levels[-1].groupBy(up.alias("node")).agg(_node(children).alias("digest"))))
        last //= fanout
    return levels


def differing_ranges(one: list[DataFrame], two: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """Lowest nodes that differ or that one tree lacks, reached through
    differing nodes only (checkpointed)."""
    bad = None
    for a, b in zip(reversed(one), reversed(two)):
        if bad is not None:
            up = F.floor(F.col("node") / fanout).cast("long").alias("up")
            above = bad.select(F.col("node").alias("up"))
            a, b = (x.select("node", "digest", up).join(above, "up", "left_semi").select("node", "digest") for x in (a, b))
        b = b.select("node", F.col("digest").alias("other"))
        bad = a.join(b, "node", "full").filter(~F.col("digest").eqNullSafe(F.col("other"))).select("node")
    return cut_lineage(bad)


def differing(listed: DataFrame, there: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """Nodes of the ranges in which the manifest and a placed replica differ."""
    last = max(x.agg(F.max(_range(range_bytes))).first()[0] or 0 for x in (listed, there))
    return differing_ranges(*(tree(x.select("offset", "sha256"), last, range_bytes, fanout) for x in (listed, there)), fanout)


def leaves_in(rows: DataFrame, ranges: DataFrame, range_bytes: int = RANGE_BYTES, how: str = "left_semi") -> DataFrame:
    """The leaves of the given ranges (or, ``left_anti``, of all others)."""
    return rows.withColumn("node", _range(range_bytes)).join(ranges, "node", how).drop("node")


def audit(listed: DataFrame, replica: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """The manifest's rows with ``status``, ``found`` (the replica's records of
    that id) and ``shift`` (bytes from the listed offset to the replica's); and
    a row of status extra per id of the replica that is not listed.

    missing: no record of that id; corrupt: none of them has the listed hash;
    duplicated: one has, and there are more; moved: the one record stands at
    another offset; intact: all else.
    """
    listed = cut_lineage(listed)
    there = cut_lineage(placed_replica(replica))
    bad = differing(listed, there, range_bytes, fanout)
    suspects = cut_lineage(leaves_in(listed, bad, range_bytes))
    # equal records of one id are one row before they meet the manifest
    seen = cut_lineage(leaves_in(there, bad, range_bytes).groupBy("record_id", "sha256").agg(
        F.count("*").alias("n"), F.min("offset").alias("at")))
    one = F.lit(1).cast("long")
    zero = F.lit(0).cast("long")
    equal = leaves_in(listed, bad, range_bytes, "left_anti").withColumns(
        {"status": F.lit("intact"), "found": one, "shift": zero})
    same = F.col("sha256") == F.col("listed")
    held = seen.join(suspects.select("record_id", F.col("sha256").alias("listed")), "record_id")
    held = held.groupBy("record_id").agg(
        F.sum("n").alias("n"), F.min(F.when(same, F.col("at"))).alias("same_at"), F.min("at").alias("any_at"))
    shift = F.coalesce("same_at", "any_at") - F.col("offset")
    status = (F.when(F.col("n").isNull(), "missing").when(F.col("same_at").isNull(), "corrupt")
              .when(F.col("n") > 1, "duplicated").when(shift != 0, "moved").otherwise("intact"))
    checked = suspects.join(held, "record_id", "left").select(
        *listed.columns, status.alias("status"), F.coalesce("n", zero).alias("found"), shift.alias("shift"))
    rest = cut_lineage(seen.join(suspects, "record_id", "left_anti"))
    if rest.isEmpty():
        return equal.unionByName(checked)
    # ids outside the suspects: a further copy of a record in an equal range, or not listed at all
    more = rest.groupBy("record_id").agg(F.sum("n").alias("n"), F.max("sha256").alias("sha256"))
    copies = more.select("record_id", "n")
    equal = equal.join(copies, "record_id", "left").select(
        *listed.columns, F.when(F.col("n").isNull(), "intact").otherwise("duplicated").alias("status"),
        (one + F.coalesce("n", zero)).alias("found"), "shift")
    extra = more.join(listed, "record_id", "left_anti").select(
        "record_id", "sha256", F.lit("extra").alias("status"), F.col("n").alias("found"))
    return equal.unionByName(checked).unionByName(extra, allowMissingColumns=True)
