"""WARC archives: writing with revisit records, and splittable reading by boundary-chain verification.

Writing is a Spark text write: one record per row, with the second half of the
record's closing blank lines as the line separator, so Spark's committer
handles retries and lost executors.

Reading cuts files into byte ranges. Each task emits, for every place in its
range that looks like the start of a record, where the chain of successors
that begins there leaves the range. Pointer jumping from offset 0 of each file
then finds the one true entry of every range, so a record header inside a
payload is never taken for a record. A second pass reads each range from its
entry. Payloads are not shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regline.llm.common import text_or_empty, written
from regline.session import ship_package

MAGIC = b"WARC/1."
CLOSE = b"\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of an archive that one range covers, and that a task reads or returns at a time.
RANGE_BYTES = 32 << 20
BLOCK = 4 << 20


def sha1_base32(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: four times 40 bits as eight digits."""
    hexes = F.sha1(data)
    digits = [F.lpad(F.conv(F.substring(hexes, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def records_to_write(
    pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", min_bytes: int = 0, date: str = DATE
) -> DataFrame:
    """One row per page: ``value``, its WARC record without the last line separator.

    Of pages with equal payloads of at least ``min_bytes``, the one with the
    largest id (null is smallest; of repeated rows any one) is a response and
    the others are revisits of it. Null payloads count as empty, a null uri
    has no header, and control characters in uris are percent-encoded.
    """
    payload = text_or_empty(F.col(payload_col))
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.regexp_replace(F.col(uri_col).cast("string"), "[\\x00-\\x20\\x7F]", "%20").alias("uri"),
        payload.alias("payload"),
        F.octet_length(payload).alias("size"),
        sha1_base32(payload.cast("binary")).alias("digest"),
    )
    # Both tables are written: small beside the payloads if copies are few, and then broadcast by the planner.
    copied = written(
        rows.where(F.col("size") >= min_bytes)
        .groupBy("digest")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("c_digest"), "keep_id"),
        "copied-payloads",
    )
    repeated = written(
        rows.groupBy("digest", "id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
            F.col("digest").alias("r_digest"), F.col("id").alias("r_id")
        ),
        "repeated-pages",
    )
    is_repeated = (F.col("digest") == F.col("r_digest")) & F.col("id").eqNullSafe(F.col("r_id"))
    # Pages with the same id and payload are told apart by numbers that writing them fixes.
    again = written(rows.join(repeated, is_repeated, "left_semi").withColumn("row", F.monotonically_increasing_id()), "repeated-rows")
    leading = written(again.groupBy("digest", "id").agg(F.min("row").alias("first_row")), "leading-rows").select(
        F.col("digest").alias("r_digest"), F.col("id").alias("r_id"), "first_row"
    )
    numbered = rows.join(repeated, is_repeated, "left_anti").withColumn("copy", F.lit(None).cast("bigint")).unionByName(
        again.join(leading, is_repeated).select(*rows.columns, F.when(F.col("row") != F.col("first_row"), F.col("row")).alias("copy"))
    )
    judged = numbered.join(copied, (F.col("digest") == F.col("c_digest")) & (F.col("size") >= min_bytes), "left")
    revisit = F.col("c_digest").isNotNull() & ~(F.col("id").eqNullSafe(F.col("keep_id")) & F.col("copy").isNull())

    def urn(ident: Column) -> Column:
        return F.concat(F.lit("urn:x-page:"), F.coalesce(ident.cast("string"), F.lit("")), F.lit(":"), F.col("digest"))

    first = urn(F.col("keep_id"))
    record_id = F.concat(urn(F.col("id")), F.coalesce(F.concat(F.lit(":"), F.col("copy")), F.lit("")))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit("\r\n\r\n")
    )
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.concat(F.lit("<"), record_id, F.lit(">"))),
        _line("WARC-Date", F.lit(date)),
        F.coalesce(_line("WARC-Target-URI", F.col("uri")), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
    )
    as_revisit = F.concat(
        _line("WARC-Profile", F.lit(REVISIT_PROFILE)),
        _line("WARC-Refers-To", F.concat(F.lit("<"), first, F.lit(">"))),
        F.lit("Content-Length: 0\r\n\r\n"),
    )
    as_response = F.concat(
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        _line("Content-Length", F.octet_length(http) + F.col("size")),
        F.lit("\r\n"),
        http,
        F.col("payload"),
    )
    return judged.select(F.concat(head, F.when(revisit, as_revisit).otherwise(as_response), F.lit("\r\n")).alias("value"))


def write(pages: DataFrame, path: str, **columns) -> None:
    """Write a folder of uncompressed archives; see ``records_to_write``. No pages give an empty folder."""
    records_to_write(pages, **columns).write.option("lineSep", "\r\n").option("compression", "none").text(path)


def parse_head(read, offset: int) -> tuple[int, dict[str, str]] | None:
    """Length and fields (lower-case names; the last of equal names) of the record head at ``offset``, or None.

    ``read(at, n)`` gives up to n bytes.
    """
    head, size = b"", 4096
    while (stop := head.find(CLOSE)) < 0:
        more = read(offset + len(head), size)
        if not more or not (head := head + more).startswith(MAGIC[: len(head)]):
            return None
        size *= 2
    lines = head[:stop].decode("utf-8", "replace").split("\r\n")
    if not re.fullmatch(r"WARC/1\.\d+", lines[0]):
        return None
    fields, last = {}, None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last:  # a folded line
            fields[last] += " " + line.strip()
        else:
            name, colon, value = line.partition(":")
            if not colon:
                return None
            last = name.strip().lower()
            fields[last] = value.strip()
    if not re.fullmatch(r"\d+", fields.get("content-length", "")):
        return None
    return stop + len(CLOSE), fields


def successor(read, offset: int, length: int) -> int | None:
    """Where the record after the one at ``offset`` starts; None if no whole record starts here."""
    found = parse_head(read, offset)
    if found is None:
        return None
    size, fields = found
    follows = offset + size + int(fields["content-length"]) + len(CLOSE)
    return follows if follows <= length else None


def candidates_in(read, start: int, stop: int, length: int) -> list[tuple[int, int]]:
    """Every offset in the range where a record seems to start, and where the chain from there leaves the range."""
    places, lead = [], len(CLOSE)
    for at in range(start, stop, BLOCK):
        # Four bytes before, and the rest of a magic that the block cuts.
        first = max(at - lead, 0)
        block = read(first, min(at + BLOCK, stop) - first + len(MAGIC) - 1)
        place = block.find(MAGIC)
        while place >= 0:
            offset = first + place
            if at <= offset < stop and (offset == 0 or block[max(place - lead, 0) : place] == CLOSE):
                places.append(offset)
            place = block.find(MAGIC, place + 1)
    leaves: dict[int, int] = {}
    for offset in reversed(places):
        follows = successor(read, offset, length)
        if follows is not None and (follows >= stop or follows in leaves):
            leaves[offset] = leaves.get(follows, follows)
    return sorted(leaves.items())


def _reader(path: str):
    from regline.sources.fs import open_input

    file = open_input(path)

    def read(at: int, n: int) -> bytes:
        file.seek(at)
        return file.read(n)

    return file, read


def _emit_candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            file, read = _reader(row["path"])
            with file:
                found = candidates_in(read, row["start"], row["stop"], row["length"])
            yield pa.RecordBatch.from_pydict(
                {
                    "path": pa.array([row["path"]] * len(found), pa.string()),
                    "length": pa.array([row["length"]] * len(found), pa.int64()),
                    "at": pa.array([a for a, _ in found], pa.int64()),
                    "to": pa.array([b for _, b in found], pa.int64()),
                }
            )


def entries(candidates: DataFrame) -> DataFrame:
    """``path, length, at, to`` -> the rows that a chain from offset 0 of their file passes.

    Pointer jumping: the steps double each round, so the rounds are
    logarithmic in the number of ranges of the largest file.
    """
    reached = candidates.where("at = 0")
    jumps = candidates.where("to < length").select("path", "at", "to")
    while not jumps.isEmpty():
        hop = jumps.select(F.col("path").alias("h_path"), F.col("at").alias("h_at"), F.col("to").alias("h_to"))
        next_at = reached.join(hop, (F.col("path") == F.col("h_path")) & (F.col("at") == F.col("h_at"))).select(
            F.col("h_path").alias("n_path"), F.col("h_to").alias("n_at")
        )
        further = candidates.join(next_at, (F.col("path") == F.col("n_path")) & (F.col("at") == F.col("n_at")), "left_semi")
        reached = written(reached.unionByName(further), "entries")
        twice = jumps.join(hop, (F.col("path") == F.col("h_path")) & (F.col("to") == F.col("h_at")))
        jumps = written(twice.select("path", "at", F.col("h_to").alias("to")), "jumps")
    return reached


RECORDS = (
    "path string, offset bigint, record_type string, record_id string, target_uri string, "
    "refers_to string, payload_digest string, payload binary"
)


def _payload(block: bytes, fields: dict[str, str]) -> bytes:
    """What follows the head of an HTTP message; any other block whole."""
    if fields.get("content-type", "").lower().startswith("application/http"):
        return block.partition(CLOSE)[2]
    return block


def _emit_records(range_bytes: int):
    names = [field.split()[0] for field in RECORDS.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows, held = [], 0
                at, stop = row["at"], (row["at"] // range_bytes + 1) * range_bytes
                file, read = _reader(row["path"])
                with file:
                    while at < min(stop, row["length"]) and (follows := successor(read, at, row["length"])):
                        size, fields = parse_head(read, at)
                        payload = _payload(read(at + size, int(fields["content-length"])), fields)
                        rows.append(
                            (
                                row["path"], at, fields.get("warc-type"), _bare(fields.get("warc-record-id")),
                                fields.get("warc-target-uri"), _bare(fields.get("warc-refers-to")),
                                fields.get("warc-payload-digest"), payload,
                            )
                        )
                        held += len(payload)
                        at = follows
                        if held >= BLOCK:
                            yield batch_of(rows)
                            rows, held = [], 0
                yield batch_of(rows)

    return emit


def _bare(uri: str | None) -> str | None:
    return uri if uri is None else uri.removeprefix("<").removesuffix(">")


def read(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of the uncompressed archives below ``path``: see RECORDS.

    A file's records are those that the chain of lengths from its first byte
    reaches. What follows a damaged or cut record of a file is not reached,
    and a file that does not start with a record has none. ``payload`` is the
    body of HTTP blocks, and the whole block of others. Executors open the
    files through Arrow's filesystems.
    """
    ship_package(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint")))
    ranges = files.where("length > 0").select("path", "length", starts.alias("start"))
    ranges = ranges.withColumn("stop", F.least(F.col("start") + range_bytes, "length"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = ranges.repartition(tasks).mapInArrow(_emit_candidates, "path string, length bigint, at bigint, to bigint")
    true_entries = entries(written(found, "candidates"))
    return true_entries.repartition(tasks).mapInArrow(_emit_records(range_bytes), RECORDS)
