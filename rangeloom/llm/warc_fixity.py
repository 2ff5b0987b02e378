"""WARC archives and their fixity: Merkle trees over records, compared between replicas.

An archive is a folder of compressed WARC files, written and read by Spark's text source,
so any file system will do. Records are told apart by a line with the archive's file name, of
which 128 bits are drawn when it is written and kept in its warcinfo record: no page written
before can hold it, whatever it quotes.

The audit hashes each record of a file, then ranges of :data:`RANGE_BYTES` of the file
from the hashes of the records that begin there, in the order of offsets, then ranges of
:data:`FANOUT` ranges, up to a root per file. Replicas compare roots, and only below a
root or range that differs are the next finer ranges looked at, down to the records.
There records are aligned by their digests, then by id and order in the file: after one
that was truncated, lengthened, lost or added, all others have another offset.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rangeloom.llm.common import write_once

RANGE_BYTES = 1 << 16
FANOUT = 16
DATE = "1970-01-01T00:00:00Z"

_END = "\r\n\r\n"


def _separator(name: str) -> str:
    return f"WARC/1.1\r\nWARC-Filename: {name}.warc\r\n"


def _one_line(value: Column) -> Column:
    return F.regexp_replace(value, r"[\r\n]", " ")


def _payload_digest(payload: Column) -> Column:
    return F.sha2(payload, 256)


def write_archive(
    pages: DataFrame, target: str, name: str, *, stored: Column | None = None, date: str = DATE
) -> None:
    """Write a record per row of ``pages`` (``page_id, url, html``) to the new folder ``target``.

    A null html is an empty payload, a null url has no target line and a null id is the id
    "null". Rows keep their order and division into files; nothing is shuffled, so a
    replica written from the same pages has the same files. ``stored`` is written in place
    of the html under the html's own digest: a replica with damage, for trials.
    """
    spark, name = pages.sparkSession, f"{name}-{uuid.uuid4().hex}"
    about = f"{_separator(name)}WARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {date}\r\nContent-Length: 0{_END}{_END[:-1]}"
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{target}/warcinfo")
    payload = F.coalesce(F.col("html"), F.lit(""))
    stored = payload if stored is None else F.coalesce(stored, payload)
    record = F.concat(
        F.lit(_separator(name) + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("null")),
        F.lit(f">\r\nWARC-Date: {date}\r\n"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), _one_line(F.col("url")), F.lit("\r\n")), F.lit("")),
        F.lit("WARC-Payload-Digest: sha256:"), _payload_digest(payload),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(payload).cast("string"),
        F.lit(_END), stored,
        F.lit(_END[:-1]),  # the writer adds the last line feed
    )
    pages.select(record.alias("value")).write.option("compression", "gzip").text(f"{target}/records")


def read_archive(spark: SparkSession, target: str) -> DataFrame:
    """Records of an archive: ``file, offset, n_bytes, page_id, url, stated, payload, record``.

    ``file`` is the number in a file's name, ``offset`` the record's place in the file
    before compression, ``stated`` the payload digest its header states.
    """
    about = "\n".join(r.value for r in spark.read.text(f"{target}/warcinfo").collect())
    separator = _separator(re.search(r"WARC-Filename: (.*)\.warc", about)[1])
    pieces = (
        spark.read.option("lineSep", separator).text(f"{target}/records")
        .select("value", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int").alias("file"))
        .withColumn("place", F.monotonically_increasing_id())
    )
    # Places rise within a file, which one task reads. Only sizes and digests are shuffled.
    size = F.octet_length("value") + len(separator)
    upto = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    head = F.substring_index("value", _END, 1)
    field = lambda pattern: F.regexp_extract("head", pattern, 1)
    after = F.col("value").substr(F.length("head") + 5, F.length("value") - F.length("head") - 8)
    return (
        pieces.withColumn("head", head)
        .select(
            "file", "place", size.cast("long").alias("n_bytes"),
            field(r"(?m)^WARC-Record-ID: <urn:page:([^>]*)>").try_cast("long").alias("page_id"),
            F.nullif(field(r"(?m)^WARC-Target-URI: ([^\r\n]*)"), F.lit("")).alias("url"),
            field(r"(?m)^WARC-Payload-Digest: sha256:([0-9a-f]*)").alias("stated"),
            _payload_digest(after).alias("payload"), F.sha2("value", 256).alias("record"),
        )
        .withColumn("offset", F.coalesce(F.sum("n_bytes").over(upto), F.lit(0)) - F.lit(len(separator)))
        .where("offset >= 0")  # what stands before the first separator: nothing
        .drop("place")
    )


def _digest_of(children: str, *order: str) -> Column:
    parts = F.sort_array(F.collect_list(F.struct(*order, children)))
    return F.sha2(F.array_join(F.transform(parts, lambda p: p[children]), "\n"), 256)


def merkle_levels(records: DataFrame, levels: int) -> list[DataFrame]:
    """Nodes ``(file, range, digest)`` of each level; a node has at most :data:`FANOUT` children.

    Level 0 has the ranges of :data:`RANGE_BYTES`, the last level a root per file.
    """
    number = F.floor(F.col("offset") / RANGE_BYTES)
    nodes = [
        write_once(
            records.groupBy("file", number.alias("range")).agg(_digest_of("record", "offset").alias("digest"))
        )
    ]
    for _ in range(levels):
        children = nodes[-1].withColumnRenamed("range", "child")
        nodes.append(
            children.groupBy("file", F.floor(F.col("child") / FANOUT).alias("range"))
            .agg(_digest_of("digest", "child").alias("digest"))
        )
    return nodes


def _levels_for(*replicas: DataFrame) -> int:
    longest = max((r.agg(F.max("offset")).first()[0] or 0) for r in replicas)
    levels, reach = 0, RANGE_BYTES
    while reach <= longest:
        levels, reach = levels + 1, reach * FANOUT
    return levels


def _differing(ours: DataFrame, theirs: DataFrame, key: list[str], digest: str) -> DataFrame:
    """Keys whose digests differ, or that one side lacks."""
    one = ours.select(*key, F.col(digest).alias("ours"))
    other = theirs.select(*key, F.col(digest).alias("theirs"))
    return one.join(other, key, "full").where(~F.col("ours").eqNullSafe(F.col("theirs"))).select(*key)


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Records that two replicas of an archive do not agree on, as read by :func:`read_archive`.

    One row per record: ``file, offset, page_id, status`` ("differs", "missing" in
    ``theirs``, "extra" there, or "moved"), both payload digests and ``ours_sound`` and
    ``theirs_sound``: whether the payload has the digest its own header states. ``offset``
    is that in ``ours``, of extra records that in ``theirs``. "moved" are records at whose
    offset another one stands, in files that have the same records in another order.
    Equal replicas, two empty ones too, give no rows.
    """
    ours, theirs = write_once(ours), write_once(theirs)
    levels = _levels_for(ours, theirs)
    trees = [merkle_levels(r, levels) for r in (ours, theirs)]
    bad = write_once(_differing(trees[0][-1], trees[1][-1], ["file", "range"], "digest"))
    for level in range(levels - 1, -1, -1):
        if bad.isEmpty():
            break
        up = bad.withColumnRenamed("range", "up")
        below = [
            t[level].withColumn("up", F.floor(F.col("range") / FANOUT)).join(up, ["file", "up"], "left_semi") for t in trees
        ]
        bad = write_once(_differing(*below, ["file", "range"], "digest"))
    number = F.floor(F.col("offset") / RANGE_BYTES)
    columns = ["file", "offset", "page_id", "payload", "stated", "record"]
    sides = [
        records.withColumn("range", number).join(bad, ["file", "range"], "left_semi").select(*columns) for records in (ours, theirs)
    ]
    # Ranges that agree have as many copies of a record in both, so the copies in the others tell.
    signed = [s.select("file", "record", F.lit(sign).alias("sign")) for s, sign in zip(sides, (1, -1), strict=True)]
    uneven = write_once(signed[0].union(signed[1]).groupBy("file", "record").agg(F.sum("sign").alias("net")).where("net <> 0"))
    last = Window.partitionBy("file", "record").orderBy(F.col("offset").desc())
    place = Window.partitionBy("file", "page_id").orderBy("offset")
    left = []
    for records, name, net in ((sides[0], "ours", F.col("net")), (sides[1], "theirs", -F.col("net"))):
        surplus = uneven.select("file", "record", net.alias("net")).where("net > 0")
        found = records.join(surplus, ["file", "record"]).withColumn("copy", F.row_number().over(last)).where("copy <= net")
        found = found.withColumn("place", F.row_number().over(place))
        left.append(found.select(*[F.col(c).alias(f"{name}_{c}") for c in [*columns, "place"]]))
    same = F.lit(True)
    for c in ("file", "page_id", "place"):
        same = same & F.col(f"ours_{c}").eqNullSafe(F.col(f"theirs_{c}"))
    status = F.when(F.col("theirs_record").isNull(), "missing").when(F.col("ours_record").isNull(), "extra").otherwise("differs")
    both = left[0].join(left[1], same, "full").withColumn("status", status)
    reordered = write_once(bad.select("file").distinct().join(uneven, "file", "left_anti"))
    if not reordered.isEmpty():
        kept = [
            s.join(reordered, "file", "left_semi").select(*[F.col(c).alias(f"{name}_{c}") for c in columns])
            for s, name in zip(sides, ("ours", "theirs"), strict=True)
        ]
        at = (F.col("ours_file") == F.col("theirs_file")) & (F.col("ours_offset") == F.col("theirs_offset"))
        moved = kept[0].join(kept[1], at, "left").where(~F.col("ours_record").eqNullSafe(F.col("theirs_record")))
        # What stands at the offset is another record; the moved one is the same in both.
        moved = moved.select(
            *[F.col(f"ours_{c}") for c in columns], *[F.col(f"ours_{c}").alias(f"theirs_{c}") for c in columns],
            F.lit("moved").alias("status"),
        )
        both = both.drop("ours_place", "theirs_place").unionByName(moved)
    return both.select(
        *[F.coalesce(f"ours_{c}", f"theirs_{c}").alias(c) for c in ("file", "offset", "page_id")], "status",
        "ours_payload", "theirs_payload",
        (F.col("ours_payload") == F.col("ours_stated")).alias("ours_sound"),
        (F.col("theirs_payload") == F.col("theirs_stated")).alias("theirs_sound"),
    )
