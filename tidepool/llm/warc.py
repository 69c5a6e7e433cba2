"""WARC archives: writing with revisit records, and reading by boundary-chain verification.

An archive is read in splits by whatever reads its file system.  Every place where the magic line
stands is a candidate; its header names where the next record must begin.  Within a split the
candidates are chained up at once, so only where a chain leaves a split crosses tasks.  Pointer
jumping from the start of each file over those exits finds the entry of every split, and whatever the
chains from there do not reach, such as magic lines inside payloads, is no record.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.storage import materialize, sized_join

# Fixed values of the format.
MAGIC = "WARC/1.0\r\n"
MAGICS = (MAGIC, "WARC/1.1\r\n")  # of the versions that are read, equally long
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

_MAGIC, _END = MAGIC.encode(), END.encode()
_RECORD = ("page_id long, record_type string, refers_to long, target_uri string, "
           "payload_bytes long, payload_digest string")
_NAMES = [c.split()[0] for c in _RECORD.split(", ")]


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: five hexadecimal digits are four characters."""
    digest = F.sha1(payload)
    groups = [F.conv(F.substring(digest, 5 * g + 1, 5), 16, 10).cast("int") for g in range(8)]
    return F.concat(*[F.substring(F.lit(BASE32), F.shiftright(n, shift).bitwiseAND(F.lit(31)) + 1,
                                  F.lit(1)) for n in groups for shift in (15, 10, 5, 0)])


def page_records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """``pages`` as records: type, what they refer to, digest, and the text of the whole record.

    Of equal payloads of at least ``min_revisit_bytes`` bytes the one with the smallest ``page_id``
    is a response and the others revisit it; rows that share that id are responses too, as are
    smaller payloads.  A null page id counts as larger than any, a null payload as empty.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    uri = F.col("url")
    for plain, coded in (("\r", "%0D"), ("\n", "%0A")):
        uri = F.replace(uri, F.lit(plain), F.lit(coded))
    rows = pages.select(
        "page_id", uri.alias("target_uri"), F.coalesce("html", F.lit("")).alias("html"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        base32_sha1(html).alias("payload_digest"))
    shared = rows.filter(F.col("payload_bytes") >= min_revisit_bytes).groupBy("payload_digest").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    shared = shared.filter("n > 1 and first_id is not null").drop("n")
    rows = sized_join(rows, shared, ["payload_digest"], spread="target_uri", how="left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    rows = rows.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(
        c.cast("string"), F.lit("none")), F.lit(">\r\n"))
    header = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.col("record_type"), F.lit("\r\nWARC-Record-ID: "),
        name(F.col("page_id")), F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\n"),
        F.when(F.col("target_uri").isNull(), F.lit("")).otherwise(
            F.concat(F.lit("WARC-Target-URI: "), F.col("target_uri"), F.lit("\r\n"))),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit("\r\n"),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "),
                                 name(F.col("first_id")))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(END))
    return rows.select(
        "page_id", "record_type", F.when(revisit, F.col("first_id")).alias("refers_to"),
        "payload_bytes", "payload_digest", F.concat(header, block).alias("record"))


def write_warc(pages: DataFrame, path: str, min_revisit_bytes: int = 0) -> None:
    """One uncompressed archive per task; the separator of lines is what ends a record."""
    records = page_records(pages, min_revisit_bytes).select(F.col("record").alias("value"))
    records.write.option("lineSep", END).text(path)


def _header(piece: bytes) -> tuple[int, int, dict[str, str]] | None:
    """(start of the block, its length, fields) of what follows a magic line, if it is a header."""
    end = piece.find(_END)
    if end < 0:
        return None
    fields = {}
    for line in piece[:end].split(b"\r\n"):
        key, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", length):
        return None
    return end + len(_END), int(length), fields


def _page(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]{1,19})>", value or "")
    return int(found[1]) if found else None


def _record(fields: dict[str, str], block: bytes) -> tuple:
    """The columns of a record; a response's size and digest come from its payload itself."""
    http, _, payload = block.partition(_END)
    kind = fields.get("warc-type")
    if kind == "revisit":
        stated = re.search(rb"(?im)^content-length:\s*([0-9]{1,18})\s*$", http)
        size = int(stated[1]) if stated else None
        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    else:
        size = len(payload)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return (_page(fields.get("warc-record-id")), kind, _page(fields.get("warc-refers-to")),
            fields.get("warc-target-uri"), size, digest)


def _pieces(spark: SparkSession, path: str, magic: str) -> DataFrame:
    """What stands between magic lines, in the order of the file within each split."""
    lines = spark.read.option("lineSep", magic).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("split"),
                        F.col("value").cast("binary").alias("value"))


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """(file, split, place, piece): the place counts bytes from the first piece of the split."""
    here, at = None, 0
    for batch in batches:
        for file, split, value in zip(*(batch.column(i) for i in range(3))):
            key, piece = (file.as_py(), split.as_py()), value.as_py()
            if key != here:
                here, at = key, 0
            yield *key, at, piece
            at += len(piece) + len(_MAGIC)


_CANDIDATE = ("file string, split long, place long, size long, next long, exit long, "
              f"whole boolean, {_RECORD}")


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per piece; ``next`` and ``exit`` are places where a record must follow.

    ``exit`` is where the chain from here leaves the split.  The rows of one split are held until
    its end; they do not hold payloads.
    """
    names = [c.split()[0] for c in _CANDIDATE.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    types = [kinds[c.split()[1]] for c in _CANDIDATE.split(", ")]

    def chained(rows):
        exits = {}
        for row in reversed(rows):
            row[5] = exits.get(row[4], row[4])
            exits[row[2]] = row[5]
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    rows: list[list] = []
    for file, split, place, piece in _placed(batches):
        if rows and (rows[-1][0], rows[-1][1]) != (file, split):
            yield chained(rows)
            rows = []
        head = _header(piece)
        row = [file, split, place, len(piece), None, None, False, *[None] * len(_NAMES)]
        if head:
            start, length, fields = head
            size = start + length + len(_END)
            row[4] = place + size + len(_MAGIC)
            if size == len(piece) and piece.endswith(_END):
                row[6:] = [True, *_record(fields, piece[start:start + length])]
        rows.append(row)
    if rows:
        yield chained(rows)


def _entries(rows: DataFrame) -> DataFrame:
    """``file, place``: where the chain from each file's start enters a split, by pointer jumping.

    Places are of the first byte after the magic line; the first record of a file is at its length.
    """
    start = rows.filter(F.col("place") == len(_MAGIC)).select("file", "place")
    targets = rows.select("file", F.col("exit").alias("place")).union(start).distinct()
    jump = materialize(rows.select("file", "place", "exit").join(
        targets, ["file", "place"]).filter("exit is not null"), "jump")
    known = rows.select("file", "place").join(targets, ["file", "place"])
    reached = materialize(start, "reached")
    while not jump.isEmpty():
        hop = jump.select("file", "place", "exit")
        more = reached.join(hop, ["file", "place"]).select("file", F.col("exit").alias("place"))
        reached = materialize(reached.union(more).distinct(), "reached")
        second = jump.select("file", F.col("place").alias("exit"), F.col("exit").alias("then"))
        jump = materialize(jump.join(second, ["file", "exit"]).select(
            "file", "place", F.col("then").alias("exit")), "jump")
    return reached.join(known, ["file", "place"], "left_semi")


def _walk(rows: pa.Table) -> pa.Table:
    """Marks the records of one split and gives every piece the end of the record it belongs to."""
    rows = rows.sort_by("place")
    places, following = rows["place"].to_pylist(), rows["next"].to_pylist()
    entry, later = rows["entry"][0].as_py(), rows["later"][0].as_py()
    end = entry if entry is not None else later
    marked, ends = [], []
    for place, then in zip(places, following):
        record = place == end and entry is not None
        if record:
            end = then
        marked.append(record)
        ends.append(end)
    return rows.append_column("record", pa.array(marked, pa.bool_())).append_column(
        "end", pa.array(ends, pa.int64()))


def _versions(spark: SparkSession, path: str) -> list[str]:
    """The magic lines that stand in the first splits of the files, as the first ones must."""
    lines = spark.read.option("lineSep", "\r\n").text(path).filter("_metadata.file_block_start = 0")
    found = lines.filter(F.col("value").isin([m.strip() for m in MAGICS])).select("value").distinct()
    return [f"{r['value']}\r\n" for r in found.collect()]  # two at most


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records that a chain from the start of their file reaches, for archives of versions 1.0 and
    1.1, which may stand in one folder; a file has one version.

    ``page_id, record_type, refers_to, target_uri, payload_bytes, payload_digest``: size and digest
    of a response are taken from the payload as read.  A file that does not begin with a record, and
    whatever follows a broken record, yields none.  A folder without archives yields no rows.
    """
    read = [_read_version(spark, path, magic) for magic in _versions(spark, path)]
    return reduce(DataFrame.unionByName, read) if read else spark.createDataFrame([], _RECORD)


def _read_version(spark: SparkSession, path: str, magic: str) -> DataFrame:
    scanned = materialize(_pieces(spark, path, magic).mapInArrow(_candidates, _CANDIDATE), "candidates")
    splits = scanned.groupBy("file", "split").agg(F.sum(F.col("size") + len(MAGIC)).alias("n"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = materialize(splits.select("file", "split", F.coalesce(
        F.sum("n").over(before), F.lit(0)).alias("base")), "splits")
    moved = [(F.col(c) + F.col("base")).alias(c) for c in ("place", "next", "exit")]
    rows = materialize(scanned.join(splits, ["file", "split"]).select(
        "file", "split", "base", *moved, "whole", *_NAMES), "placed")

    entered = rows.select("file", "split", "place").join(_entries(rows), ["file", "place"])
    entered = entered.groupBy("file", "split").agg(F.min("place").alias("entry"))
    after = Window.partitionBy("file").orderBy("split").rowsBetween(1, Window.unboundedFollowing)
    starts = splits.join(entered, ["file", "split"], "left").select(
        "file", "split", "entry", F.min("entry").over(after).alias("later"))
    columns = "file string, split long, base long, place long, next long, exit long, " \
              f"whole boolean, {_RECORD}, entry long, later long, record boolean, end long"
    walked = rows.join(starts, ["file", "split"])
    walked = walked.select(*[c.split()[0] for c in columns.split(", ")[:-2]])
    walked = materialize(walked.groupBy("file", "split").applyInArrow(_walk, columns), "walked")

    broken = walked.filter("record and not whole and next is not null")
    plain = walked.filter("record and whole").select(*_NAMES)
    if broken.isEmpty():
        return plain
    pieces = walked.join(broken.select("file", "end").distinct(), ["file", "end"]).select(
        "file", "split", (F.col("place") - F.col("base")).alias("local"), "place", "end")
    return plain.union(_joined(spark, path, magic, materialize(pieces, "parts")))


def _joined(spark: SparkSession, path: str, magic: str, parts: DataFrame) -> DataFrame:
    """Records whose payload holds magic lines: their pieces are read again and put together."""
    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, split, place, piece in _placed(batches):
            yield pa.RecordBatch.from_pylist(
                [{"file": file, "split": split, "local": place, "piece": piece}])

    schema = "file string, split long, local long, piece binary"
    found = sized_join(_pieces(spark, path, magic).mapInArrow(again, schema), parts,
                       ["file", "split", "local"], spread="piece")
    found = materialize(found, "pieces")
    if found.count() != parts.count():
        raise RuntimeError("the archive was split differently when it was read again")
    whole = found.groupBy("file", "end").agg(F.array_sort(F.collect_list(
        F.struct("place", "piece"))).alias("pieces"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string() if " string" in c else pa.int64() for c in _RECORD.split(", ")]
        for batch in batches:
            out = []
            for pieces in batch.column(0):
                text = magic.encode().join(p["piece"] for p in pieces.as_py())
                start, length, fields = _header(text)
                if text[start + length:] == _END:
                    out.append(_record(fields, text[start:start + length]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), kinds)], _NAMES)

    return whole.select("pieces").mapInArrow(parse, _RECORD)
