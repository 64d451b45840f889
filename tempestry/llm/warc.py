"""WARC archives of pages, and an index of their captures merged from sorted runs."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempestry.llm.common import FEW_ROWS, batches_of, saved, share
from tempestry.session import scratch_path

#: Payloads from this size on are stored once, later copies as revisits.
SMALLEST = 100
#: The end of a line and of a record, the version, and the profile of revisits (fixed values of the format).
CRLF, RECORD_END = "\r\n", "\r\n\r\n"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Date of a capture that has none: so many seconds after this one as its identifier says, within ten years.
FIRST_DATE, DATES = 1_577_836_800, 315_360_000
#: Captures of one key range of the merged index, about.
RANGE_ROWS = 50_000
#: The order of the index; archive and place tell all captures apart.
ORDER = ("url_key", "captured", "archive", "place")
#: Where the page's identifier is kept.
ID_FIELD = "X-Page-ID"

CAPTURE = "run int, place long, url_key string, captured string, page_id long, record_id string, record_type string, "
CAPTURE += "refers_to_record string, url string, payload_bytes long, payload_digest string, claimed_digest string, archive string, "
CAPTURE += "offset long, length long"
_CAPTURE = pa.schema(
    [
        (name, {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[kind])
        for name, kind in (c.split() for c in CAPTURE.split(", "))
    ]
)
_NAMES = [f.name for f in _CAPTURE]


# Writing ---------------------------------------------------------------------------------------------------------------


def _uuid(*parts: Column) -> Column:
    """An identifier that follows from the parts."""
    digest = F.md5(F.concat_ws("\n", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _record_id(page_id: Column, digest: Column) -> Column:
    return _uuid(F.lit("record"), F.coalesce(page_id.cast("string"), F.lit("none")), digest)


def _date(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _field(name: str, value: Column) -> Column:
    """A header line; none for a null value. Characters that would end the line or be trimmed are percent-encoded."""
    safe = value.cast("string")
    for character, code in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), (" ", "%20")):
        safe = F.replace(safe, F.lit(character), F.lit(code))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(CRLF)), F.lit(""))


def records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date_col: str | None = None
) -> DataFrame:
    """One text per row of ``pages``: its WARC record, without the two line ends after it.

    Payloads are compared by SHA-256 and size. The row with the smallest
    identifier of an equal payload (null counts as larger) is a response, and
    so are rows that repeat that identifier; the others revisit it.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("payload"),
        (F.unix_timestamp(F.col(date_col).cast("timestamp")) if date_col else F.lit(None).cast("long")).alias("seconds"),
    )
    derived = F.lit(FIRST_DATE) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(DATES))
    rows = rows.withColumn("seconds", F.coalesce("seconds", derived))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload"))
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "seconds", "url")
    large = rows.where(F.col("bytes") >= SMALLEST).select("digest", "bytes", order.alias("order"))
    # A payload of very many pages leaves each task as one row; only payloads of several pages are looked up.
    firsts = large.groupBy("digest", "bytes").agg(F.min("order").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    firsts = share(saved(firsts.drop("copies"), "repeated-payloads"), FEW_ROWS)
    known = rows.join(firsts, ["digest", "bytes"], "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first.page_id")), F.lit(False)) & F.col("first").isNotNull()
    http = F.concat(
        F.lit(CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "])),
        F.col("bytes").cast("string"),
        F.lit(RECORD_END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    head = [
        F.lit(VERSION + CRLF),
        _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _field("WARC-Date", _date(F.col("seconds"))),
        _field("WARC-Target-URI", F.col("url")),
        _field(ID_FIELD, F.col("page_id")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _field("WARC-Profile", F.when(revisit, PROFILE)),
        _field("WARC-Refers-To", F.when(revisit, _record_id(F.col("first.page_id"), F.col("digest")))),
        _field("WARC-Refers-To-Target-URI", F.when(revisit, F.col("first.url"))),
        _field("WARC-Refers-To-Date", F.when(revisit, _date(F.col("first.seconds")))),
        F.lit("Content-Type: application/http;msgtype=response" + CRLF),
        _field("Content-Length", F.octet_length("block")),
        F.lit(CRLF),
        F.col("block"),
    ]
    return known.withColumn("block", block).select(F.concat(*head).alias("value"))


def write(pages: DataFrame, path: str, **columns: str) -> None:
    """The records of ``pages`` as gzip-compressed archives, one for each task, in the folder ``path``.

    Spark's text writer ends each record with its two line ends. It commits a
    task's file when the task is done, so a lost executor leaves no half
    archive. Records are streamed and never held together.
    """
    options = {"lineSep": RECORD_END, "compression": "gzip"}
    records(pages, **columns).write.options(**options).text(path)


# Reading ---------------------------------------------------------------------------------------------------------------

_SCHEME = re.compile(r"^[a-z][a-z0-9+.-]*://", re.IGNORECASE)
_HOST = re.compile(r"^(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)(:\d*)?", re.DOTALL)


def url_key(url: str | None) -> str:
    """A sort key of an address: the parts of its host turned round, then port, path and query.

    ``https://www.Example.org:443/a?b#c`` becomes ``org,example)/a?b``. Addresses that differ in scheme, a
    leading ``www``, the default port or the fragment share a key; null has the empty one.
    """
    if not url:
        return ""
    found = _SCHEME.match(url)
    rest = url[found.end() :] if found else url
    host = _HOST.match(rest)
    name, port, tail = host[1].lower().rstrip("."), host[2] or "", rest[host.end() :].split("#", 1)[0]
    name = re.sub(r"^www\d*\.(?=.*\.)", "", name)
    turned = name if name.startswith("[") else ",".join(reversed(name.split(".")))
    port = "" if port in (":", ":80", ":443") else port
    return f"{turned}{port}){tail if tail.startswith('/') else '/' + tail}"


def _stamp(date: str) -> str:
    return re.sub(r"\D", "", date)[:14]


def _whole(value: str | None) -> int | None:
    return int(value) if value and re.fullmatch(r"-?\d{1,18}", value) else None


class Broken(ValueError):
    """An archive that does not follow the format."""


def parsed(lines: Iterable[bytes], archive: str = "") -> Iterator[dict]:
    """The records of one archive, from its lines without line feeds, in a stream.

    Blocks are hashed as they pass. ``offset`` and ``length`` count bytes of
    the uncompressed archive, the line ends after a record not included.
    """
    lines, at = iter(lines), 0
    for line in lines:
        start = at
        at += len(line) + 1
        if line in (b"\r", b""):  # what ends a record
            continue
        if not line.startswith(b"WARC/"):
            raise Broken(f"{archive}: no record begins at byte {start}")
        head: dict[str, str] = {}
        for line in lines:
            at += len(line) + 1
            if line in (b"\r", b""):
                break
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        else:
            raise Broken(f"{archive}: the record at byte {start} ends in its header")
        left = int(head.get("content-length", -1))
        if left < 0:
            raise Broken(f"{archive}: the record at byte {start} has no length")
        inside = not head.get("content-type", "").startswith("application/http")
        digest, size, end = hashlib.sha256(), 0, at + left
        told = 0
        while left > 0:
            line = next(lines, None)
            if line is None:
                raise Broken(f"{archive}: the record at byte {start} is cut off")
            piece = line + b"\n"
            at += len(piece)
            over, piece = max(0, len(piece) - left), piece[:left]
            left -= len(piece)
            if inside:
                digest.update(piece)
                size += len(piece)
            elif piece in (b"\r\n", b"\n"):
                inside = True
            elif piece.lower().startswith(b"content-length:"):
                told = int(piece.split(b":", 1)[1])
            if over > 1:  # the line goes on behind the block
                if line[-1:] != b"\r" or over != 2:
                    raise Broken(f"{archive}: the record at byte {start} is longer than it says")
        yield {"head": head, "bytes": size, "told": told, "digest": digest.hexdigest(), "offset": start, "length": end - start}


def _captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of lines of archives, one archive after the other, to a row per record."""

    def lines() -> Iterator[tuple[str, int, bytes]]:
        for batch in batches:
            for archive, run, value in zip(*(batch.column(k) for k in range(3))):
                yield archive.as_py(), run.as_py(), value.as_py()

    stream = lines()
    ahead = next(stream, None)

    def of_archive(name: str) -> Iterator[bytes]:
        nonlocal ahead
        while ahead is not None and ahead[0] == name:
            line, ahead = ahead[2], next(stream, None)
            yield line

    def rows() -> Iterator[tuple]:
        while ahead is not None:
            archive, run = ahead[:2]
            for record in parsed(of_archive(archive), archive):
                head = record["head"]
                kind = head.get("warc-type")
                if kind not in ("response", "revisit"):
                    continue
                url, page = head.get("warc-target-uri"), head.get(ID_FIELD.lower())
                claimed = head.get("warc-payload-digest", "").removeprefix("sha256:") or None
                stored = kind == "response"
                yield (
                    run, record["offset"], url_key(url), _stamp(head.get("warc-date", "")), _whole(page),
                    head.get("warc-record-id"), kind, head.get("warc-refers-to"), url,
                    record["bytes"] if stored else record["told"], record["digest"] if stored else None, claimed,
                    archive, record["offset"], record["length"],
                )

    yield from batches_of(rows(), _CAPTURE, 5000)


def read(spark, path: str) -> DataFrame:
    """A row per response and revisit in the gzip-compressed archives of a folder, written by anyone.

    Spark streams the lines of an archive through one task, so an archive of any size needs little memory; members
    that are compressed apart are read one after the other. ``run`` is the task, ``place`` the byte where a record begins.
    """
    raw = spark.read.option("lineSep", "\n").text(path)
    lines = raw.select(F.col("_metadata.file_path").alias("archive"), F.spark_partition_id().alias("run"), F.col("value").cast("binary").alias("value"))
    return lines.mapInArrow(_captures, CAPTURE)


# The index -------------------------------------------------------------------------------------------------------------


def merged_runs(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """The items of sorted runs in order, by a loser tree.

    Inner node k has the children 2k and 2k + 1, and the runs are the leaves. Each inner
    node keeps the run that lost there, and the winner goes on. After the
    winner's item is out, only the matches on its path to the root are played
    again: one comparison for each doubling of the runs. Equal items come in the order of their runs.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[tuple | None] = [next(run, None) for run in runs] + [None] * (size - len(runs))

    def before(a: int, b: int) -> bool:
        if heads[a] is None or heads[b] is None:
            return heads[b] is None and (heads[a] is not None or a < b)
        return heads[a] < heads[b] or heads[a] == heads[b] and a < b

    won, lost = [0] * size + list(range(size)), [0] * size
    for node in range(size - 1, 0, -1):
        a, b = won[2 * node], won[2 * node + 1]
        won[node], lost[node] = (a, b) if before(a, b) else (b, a)
    winner = won[1]
    while heads[winner] is not None:
        yield heads[winner]
        heads[winner] = next(runs[winner], None)
        node = (winner + size) // 2
        while node:
            if before(lost[node], winner):
                lost[node], winner = winner, lost[node]
            node //= 2


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The captures of a key range, of all runs, to the same in order."""
    held = pa.Table.from_batches(list(batches), schema=_CAPTURE).combine_chunks()
    if not held.num_rows:
        return
    part = held.column("run").to_numpy()
    items = list(zip(*(held.column(c).to_pylist() for c in ORDER), range(held.num_rows)))
    # A run's rows come in blocks that have its order; a piece ends with its run, or where the order does.
    begins = [0, *(i for i in range(1, len(items)) if part[i] != part[i - 1] or items[i] < items[i - 1]), len(items)]
    pieces = [iter(items[a:b]) for a, b in zip(begins, begins[1:])]
    place = np.fromiter((item[-1] for item in merged_runs(pieces)), np.int64, len(items))
    yield from held.take(pa.array(place)).combine_chunks().to_batches(max_chunksize=5000)


def histories(captures: DataFrame) -> DataFrame:
    """All captures ordered by address key, date, archive and place, over the partitions one after the other.

    1. Each task that read archives sorts its captures and writes them: the runs.
    2. Key ranges of about RANGE_ROWS captures are drawn by a sample of the runs. The order
       includes the place in the archive, so an address with very many captures is cut too.
    3. Each range merges its pieces of all runs.
    """
    runs = saved(captures.sortWithinPartitions(*ORDER), "capture-runs")
    ranges = max(1, -(-runs.count() // RANGE_ROWS))
    merged = runs.select(*_NAMES).repartitionByRange(ranges, *ORDER).mapInArrow(_merge, CAPTURE)
    return saved(merged.withColumn("range", F.spark_partition_id()), "capture-histories")


def resolved(merged: DataFrame) -> DataFrame:
    """The captures, each revisit with the size and digest of the response it refers to.

    A response whose payload does not have the digest it claims, and a revisit
    whose response is missing or has another digest, are errors.
    """
    stored = merged.where("record_type = 'response'")
    asked = merged.where("record_type = 'revisit'").select(F.col("refers_to_record").alias("record_id")).distinct()
    targets = (
        stored.join(share(saved(asked, "asked-records"), FEW_ROWS), "record_id", "left_semi")
        .groupBy(F.col("record_id").alias("target"))
        .agg(
            F.min("page_id").alias("target_page"), F.min("payload_bytes").alias("target_bytes"), F.min("payload_digest").alias("target_digest")
        )
    )
    targets = share(saved(targets, "revisited"), FEW_ROWS)
    known = merged.join(targets, merged["refers_to_record"] == targets["target"], "left")
    revisit = F.col("record_type") == "revisit"
    digest = F.when(revisit, F.col("target_digest")).otherwise(F.col("payload_digest"))
    wrong = F.concat(F.lit("the payload of record "), F.coalesce("record_id", F.lit("without id")), F.lit(" is missing or not what its digest says"))
    checked = F.when(digest.eqNullSafe(F.coalesce("claimed_digest", digest)) & digest.isNotNull(), digest).otherwise(
        F.raise_error(wrong).cast("string")
    )
    return known.select(
        "url_key",
        "captured",
        "range",
        "page_id",
        "url",
        F.when(revisit, F.col("target_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        checked.alias("payload_digest"),
        "record_type",
        F.when(revisit, F.col("target_page")).alias("refers_to"),
        "record_id",
        "archive",
        "offset",
        "length",
    )


def archive_pages(pages: DataFrame, **columns: str) -> DataFrame:
    """Write an archive of all pages, read it back, and return its captures from the merged index.

    Columns: ``url_key, captured`` (14 digits), ``range`` (of the index),
    ``page_id, url, payload_bytes, payload_digest, record_type, refers_to,
    record_id, archive, offset, length``.

    Null html is an empty payload, a null url or identifier is left out of the
    record and read as null. Rows repeated are captures of their own and of
    equal type. Payloads that are equal but all without identifier are
    responses. An empty table gives no rows; further columns are ignored.
    """
    path = scratch_path(pages.sparkSession, "archives")
    write(pages, path, **columns)
    return resolved(histories(read(pages.sparkSession, path)))
