"""WARC archives: written by Spark's text writer, read back by boundary-chain verification.

An archive file is a run of records: ``WARC/1.1``, headers, a blank line, the payload, two
line ends. Files are read in splits as the pieces between magics, so a magic inside a
payload gives a false piece. Every task turns each piece of its split that looks like a
record into a candidate, and follows the candidates' offsets to their successors as far as
the split goes. Only where a chain leaves a split does it need the other splits: jumps
from entry to entry are doubled (pointer jumping) from the start of the file until all
splits that the true chain enters are known. Each split then yields the records on the
chain from its entry; a payload that spans pieces is put together again.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage, work_dir
from .native import sent_if_small, small

VERSION_LINE = "WARC/1.1\r\n"
# What versions 1.0 and 1.1 begin with; a digit and a line end must follow.
MAGIC = "WARC/1."
END = "\r\n\r\n"
LEAST_REVISIT_BYTES = 0
BROADCAST_ROWS = 100_000

_MAGIC = MAGIC.encode()
_HEAD_END = b"\r\n\r\n"
# The digits of base 32 as Spark writes them and as RFC 4648 does.
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_LENGTH = re.compile(rb"\r\nContent-Length: *(\d+)\r\n", re.IGNORECASE)
_REST_OF_MAGIC = re.compile(rb"\d\r\n")
_HEX_SHA1 = re.compile("[0-9A-Fa-f]{40}")
_FIELD = re.compile(rb"(?:^|\r\n)([A-Za-z-]+): *([^\r\n]*)")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base 32 of the SHA-1, eight digits from every ten hexadecimal ones."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


def plan_records(pages: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """(page_id, refers_to) of the pages that revisit: equal payload, a smaller page_id exists.

    Payloads are told by SHA-1 and length. Only digests are shuffled, one row per payload
    and task at first; a digest that very many pages share is spread over ``salt``.
    """
    digests = stage(
        pages.filter("page_id is not null")
        .select("page_id", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
        .select("page_id", F.sha1("payload").alias("digest"), F.length("payload").alias("size"))
        .filter(F.col("size") >= least_bytes),
        "digests",
    )
    shared = (
        digests.groupBy("digest", "size")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
        .filter("n > 1")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
        .drop("n")
    )
    return (
        digests.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(16)).cast("int"))
        .join(shared, ["digest", "size", "salt"])
        .filter("page_id > refers_to")
        .select("page_id", "refers_to")
        .distinct()
    )


def _record_id(page_id: Column) -> Column:
    """A URN that names the page: a UUID whose last digits are the id."""
    digits = F.lpad(F.lower(F.hex(page_id)), 16, "0")
    return F.concat(
        F.lit("<urn:uuid:00000000-0000-5000-"), F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 12), F.lit(">")
    )


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_REVISIT_BYTES) -> None:
    """Write a record per row of ``pages`` (page_id, url, html), in the row's own partition.

    A null payload is empty. Line ends in a url are written as blanks, a null url as an
    empty one. Rows without an id are responses. Of rows that repeat an id, all are written
    alike: revisits if the id is one.
    """
    revisits = stage(plan_records(pages, least_bytes), "revisits")
    rows = pages.select("page_id", "url", "html").join(sent_if_small(revisits, BROADCAST_ROWS), "page_id", "left")
    payload = F.coalesce("html", F.lit(""))
    full = payload.cast("binary")
    revisit = F.col("refers_to").isNotNull()
    written = F.when(revisit, F.lit("")).otherwise(payload)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    head = F.concat(
        F.lit(VERSION_LINE),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.coalesce(_record_id(F.col("page_id")), F.lit("<urn:uuid:none>"))),
        line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ")),
        F.when(
            revisit,
            F.concat(
                line("WARC-Refers-To", _record_id(F.col("refers_to"))),
                line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            ),
        ).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(full))),
        line("X-Payload-Length", F.length(full).cast("string")),
        F.lit("Content-Type: text/html\r\n"),
        line("Content-Length", F.length(written.cast("binary")).cast("string")),
        F.lit("\r\n"),
    )
    rows.select(F.concat(head, written).alias("value")).write.option("lineSep", END).text(folder)


@dataclass
class Piece:
    """What stands between two magics; ``size`` counts the magic before it."""

    at: int  # of the magic, from the first magic of the split
    body: bytes
    length: int | None = None  # of the whole record, if it looks like one


def _look(at: int, body: bytes) -> Piece:
    end = body.find(_HEAD_END) if _REST_OF_MAGIC.match(body) else -1
    found = _LENGTH.search(b"\r\n" + body[: end + 2]) if end >= 0 else None
    if not found:
        return Piece(at, body)
    return Piece(at, body, len(_MAGIC) + end + 4 + int(found[1]) + 4)


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    """(file, split, order, value): a split's rows stay together in one task, in order."""
    return (
        spark.read.option("lineSep", MAGIC)
        .text(folder)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("order"),
            F.col("value").cast("binary").alias("value"),
        )
    )


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[tuple[int, bytes]]]]:
    """Splits of the task one by one, with (offset after the previous pieces, piece) each."""
    from itertools import groupby

    def rows():
        for batch in batches:
            files, splits, values = (batch.column(c) for c in ("file", "split", "value"))
            for k in range(batch.num_rows):
                yield files[k].as_py(), splits[k].as_py(), values[k].as_py()

    for (file, split), own in groupby(rows(), key=lambda r: r[:2]):

        def placed(own=own):
            at = 0
            for _, _, value in own:
                yield at, value
                at += len(value) + len(_MAGIC)

        yield file, split, placed()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: its bytes, and every candidate with the offset at which its chain leaves the split."""
    for file, split, pieces in _by_split(batches):
        jumps: list[tuple[int, int]] = []
        end = 0
        for at, value in pieces:
            # A piece's magic stands before it: in the split's first piece it belongs to the last split.
            piece = _look(at - len(_MAGIC), value)
            if piece.length is not None:
                jumps.append((piece.at, piece.at + piece.length))
            end = at + len(value) + len(_MAGIC)
        leaves: dict[int, int] = {}
        for at, successor in reversed(jumps):
            leaves[at] = leaves.get(successor, successor)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([file], pa.string()),
                pa.array([split], pa.int64()),
                pa.array([end], pa.int64()),
                pa.array([list(leaves)], pa.list_(pa.int64())),
                pa.array([list(leaves.values())], pa.list_(pa.int64())),
            ],
            ["file", "split", "bytes", "candidates", "leaves"],
        )


def find_entries(spark: SparkSession, folder: str) -> DataFrame:
    """(file, split, start, entry): where each split starts, and the first true record in it.

    ``start`` is the file offset of the split's first piece; ``entry`` is null for a split
    in which no true record starts.
    """
    scanned = stage(
        _pieces(spark, folder).mapInArrow(
            _scan, "file string, split long, bytes long, candidates array<long>, leaves array<long>"
        ),
        "scan",
    )
    # One row a split, and the splits of one file together.
    before = F.aggregate(
        F.filter("all", lambda x: x["split"] < F.col("split")), F.lit(0).cast("long"), lambda s, x: s + x["bytes"]
    )
    starts = stage(
        scanned.groupBy("file")
        .agg(F.collect_list(F.struct("split", "bytes")).alias("all"))
        .select("file", "all", F.explode("all.split").alias("split"))
        .select("file", "split", before.alias("start"), F.size("all").alias("splits")),
        "starts",
    )
    jumps = (
        scanned.join(starts, ["file", "split"])
        .select("file", "start", F.explode(F.arrays_zip("candidates", "leaves")).alias("x"))
        .select("file", (F.col("start") + F.col("x.candidates")).alias("at"), (F.col("start") + F.col("x.leaves")).alias("to"))
    )
    roots = starts.select("file").distinct().withColumn("at", F.lit(0).cast("long"))
    # Only records where a chain enters a split matter: targets of other chains, and file starts.
    targets = jumps.select("file", F.col("to").alias("at")).distinct().unionByName(roots)
    step = stage(jumps.join(targets.distinct(), ["file", "at"], "left_semi"), "jumps")
    reached = roots
    rounds = max(1, (starts.agg(F.max("splits")).first()[0] or 1).bit_length())
    for _ in range(rounds):
        further = reached.join(step, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = stage(reached.unionByName(further).distinct(), "reached")
        twice = step.alias("x").join(
            step.alias("y"), (F.col("x.file") == F.col("y.file")) & (F.col("x.to") == F.col("y.at"))
        )
        step = stage(twice.select("x.file", "x.at", "y.to"), "jumps")
    entries = (
        reached.join(jumps.select("file", "at"), ["file", "at"], "left_semi")
        .join(starts.withColumnRenamed("start", "first"), "file")
        .join(scanned.select("file", "split", "bytes"), ["file", "split"])
        .filter((F.col("at") >= F.col("first") - len(MAGIC)) & (F.col("at") < F.col("first") + F.col("bytes") - len(MAGIC)))
        .groupBy("file", "split")
        .agg(F.min("at").alias("entry"))
    )
    return starts.select("file", "split", "start").join(entries, ["file", "split"], "left")


_RECORDS = "file string, at long, head binary, size long, sha1 string, part long, bytes binary"


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records on the chain from each split's entry; whole payloads as size and SHA-1.

    A payload that may go on in the next split comes as parts; so do the pieces before the
    split's entry, which belong to a record that started earlier (``at`` is null).
    """
    columns: list[list] = [[] for _ in range(7)]
    held = 0

    def emit(*row):
        nonlocal held
        for column, value in zip(columns, row, strict=True):
            column.append(value)
        held += len(row[6] or b"") + 200

    def flush():
        nonlocal columns, held
        types = [pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            ["file", "at", "head", "size", "sha1", "part", "bytes"],
        )
        columns, held = [[] for _ in range(7)], 0
        return out

    for (file, split, start, entry), pieces in _with_entries(batches):
        due = entry  # file offset of the next true record
        parts: list[bytes] = []
        opened = -1
        for at, value in pieces:
            magic_at = start + at - len(_MAGIC)
            if due is None or magic_at < due:
                if parts:
                    parts += [_MAGIC, value]
                elif magic_at >= 0:
                    emit(file, None, None, None, None, magic_at, (_MAGIC if at or split else b"") + value)
                continue
            if parts:
                _close(emit, file, opened, parts)
            piece = _look(magic_at, value)
            if magic_at != due or piece.length is None:
                raise ValueError(f"{file}: no record where one must start, at {due}")
            opened, parts, due = magic_at, [value], magic_at + piece.length
            if held > 1 << 22:
                yield flush()
        if parts:
            if start + at + len(value) >= due:
                _close(emit, file, opened, parts)
            else:
                body = b"".join(parts)
                emit(file, opened, None, None, None, opened, body)
        if columns[0]:
            yield flush()


def _close(emit, file: str, at: int, parts: list[bytes]) -> None:
    body = b"".join(parts)
    end = body.index(_HEAD_END)
    size = int(_LENGTH.search(b"\r\n" + body[: end + 2])[1])
    payload = body[end + 4 : end + 4 + size]
    emit(file, at, body[:end], size, base64.b32encode(hashlib.sha1(payload).digest()).decode(), None, None)


def _with_entries(batches: Iterator[pa.RecordBatch]):
    """Like :func:`_by_split`, with the split's start and entry from the joined columns."""
    from itertools import groupby

    def rows():
        for batch in batches:
            columns = [batch.column(c) for c in ("file", "split", "start", "entry", "value")]
            for k in range(batch.num_rows):
                yield tuple(c[k].as_py() for c in columns)

    for key, own in groupby(rows(), key=lambda r: r[:4]):

        def placed(own=own):
            at = 0
            for row in own:
                yield at, row[4]
                at += len(row[4]) + len(_MAGIC)

        yield key, placed()


def _headers(head: bytes) -> dict[str, str]:
    return {k.decode().lower(): v.decode("utf-8", "replace") for k, v in _FIELD.findall(head)}


def _page(urn: str | None) -> int | None:
    digits = re.fullmatch(r"<urn:uuid:00000000-0000-5000-([0-9a-f]{4})-([0-9a-f]{12})>", urn or "")
    if not digits:
        return None
    value = int(digits[1] + digits[2], 16)
    return value - (1 << 64) if value >= 1 << 63 else value


def _sha1(digest: str | None) -> str | None:
    """The SHA-1 a digest header tells, in base 32; None without one and for other algorithms."""
    name, _, value = (digest or "").partition(":")
    if name.strip().lower() != "sha1":
        return None
    value = value.strip()
    return base64.b32encode(bytes.fromhex(value)).decode() if _HEX_SHA1.fullmatch(value) else value.upper()


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            fields = _headers(row["head"])
            kind = fields.get("warc-type")
            told = _sha1(fields.get("warc-payload-digest"))
            # What stands in the record is its block; of a captured HTTP message the payload is a part only.
            checks = [_sha1(fields.get("warc-block-digest"))]
            if kind != "revisit" and not fields.get("content-type", "").startswith("application/http"):
                checks.append(told)
            if any(x not in (None, row["sha1"]) for x in checks):
                raise ValueError(f"{row['file']}: payload at {row['at']} does not match its digest")
            length = fields.get("x-payload-length") if kind == "revisit" else row["size"]
            rows.append(
                {
                    "page_id": _page(fields.get("warc-record-id")),
                    "url": fields.get("warc-target-uri"),
                    "payload_bytes": None if length is None else int(length),
                    "payload_digest": told or (None if kind == "revisit" else row["sha1"]),
                    "record_type": kind,
                    "refers_to": _page(fields.get("warc-refers-to")),
                }
            )
        yield pa.RecordBatch.from_pylist(
            rows,
            schema=pa.schema(
                [
                    ("page_id", pa.int64()),
                    ("url", pa.string()),
                    ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string()),
                    ("record_type", pa.string()),
                    ("refers_to", pa.int64()),
                ]
            ),
        )


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of all true records.

    Versions 1.0 and 1.1, plain or compressed record by record (``.gz``, read in one split).
    Sizes are those of the bytes read. A SHA-1 in the headers, in base 32 or hexadecimal, must
    match them and a mismatch fails; without one (digests are optional, other algorithms are
    not checked) the digest is that of the bytes. The payload digest of a captured HTTP message
    covers a part of the record and is passed on as told. A revisit carries its own size and
    digest, null where it tells none. Records of all types come out; ids that are not of
    :func:`write_archives` are null.
    """
    entries = stage(find_entries(spark, folder), "entries")
    # One row a split. Where they are too many to send, the merge of both has to put pieces in order again.
    if small(entries, BROADCAST_ROWS):
        joined = _pieces(spark, folder).join(F.broadcast(entries), ["file", "split"])
    else:
        merged = _pieces(spark, folder).join(entries.hint("merge"), ["file", "split"])
        joined = merged.sortWithinPartitions("file", "split", "order")
    found = stage(joined.select("file", "split", "start", "entry", "value").mapInArrow(_extract, _RECORDS), "records")
    whole = found.filter("sha1 is not null").select("file", "at", "head", "size", "sha1")
    parts = found.filter("sha1 is null").select("file", "at", "part", "bytes")
    if not parts.isEmpty():
        # A record over several splits: its parts are those up to the next such record of the file.
        upto = Window.partitionBy("file").orderBy("part")
        owned = parts.withColumn("owner", F.last("at", ignorenulls=True).over(upto))
        merged = owned.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("part", "bytes"))).alias("parts"))
        whole = whole.unionByName(merged.mapInArrow(_join_parts, "file string, at long, head binary, size long, sha1 string"))
    return whole.mapInArrow(
        _describe,
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long",
    )


def _join_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []

        def emit(file, at, head, size, sha1, _part, _bytes, rows=rows):
            rows.append((file, at, head, size, sha1))

        for row in batch.to_pylist():
            _close(emit, row["file"], row["owner"], [x["bytes"] for x in row["parts"]])
        names = ["file", "at", "head", "size", "sha1"]
        types = [pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names
        )


def archive_of_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives under the shared folder and read them back."""
    folder = work_dir(pages.sparkSession, "warc")
    write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder)
