"""WARC archives: written with segmented, chunked and revisit records, read back and reassembled."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.llm.base import text_batches, written

#: Bytes of an HTTP message per record, and of a payload per chunk.
SEGMENT, CHUNK = 16_384, 4_096
END = b"\r\n\r\n"
HTTP = (
    b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    b"Transfer-Encoding: chunked\r\n\r\n"
)


# ---- framing -------------------------------------------------------------------------------


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """Payload of a chunked body; None if the framing is broken or cut off."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            return None
        if size < 0 or body[end + 2 + size : end + 4 + size] != b"\r\n":
            return None
        if size == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def http_payload(message: bytes) -> bytes | None:
    head, _, body = message.partition(END)
    fields = [line.lower().replace(b" ", b"") for line in head.split(b"\r\n")[1:]]
    return unchunked(body) if b"transfer-encoding:chunked" in fields else body


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """Header and block of a record, without the two line ends behind it."""
    lines = [f"{k}: {str(v).translate({10: '%0A', 13: '%0D'})}" for k, v in fields if v is not None]
    lines += [f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(lines)).encode() + END + block


def records(
    uuid: str, page: str | None, url: str | None, payload: bytes, digest: str, refers: str | None,
    revisit: bool, date: str, segment: int,
) -> Iterator[bytes]:
    """Records of one page: a revisit, or a response with its continuations."""
    own = f"<urn:uuid:{uuid}>"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", own), ("WARC-Date", date),
        ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Page-ID", page), ("X-Payload-Length", len(payload)),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("X-Refers-To-Page-ID", refers),
        ]
        yield _record(fields, b"")
        return
    message = HTTP + chunked(payload)
    parts = [message[i : i + segment] for i in range(0, len(message), segment)]
    fields.append(("Content-Type", "application/http;msgtype=response"))
    if len(parts) == 1:
        yield _record(fields, message)
        return
    yield _record([*fields, ("WARC-Segment-Number", 1)], parts[0])
    for number, part in enumerate(parts[1:], 2):
        yield _record(
            [
                ("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid[:-4]}{number:04x}-{number}>"),
                ("WARC-Date", date), ("WARC-Target-URI", url), ("WARC-Segment-Origin-ID", own),
                ("WARC-Segment-Number", number),
                ("WARC-Segment-Total-Length", len(message) if number == len(parts) else None),
            ],
            part,
        )


# ---- writing -------------------------------------------------------------------------------


def write_archives(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
    least: int = 100, date: str = "2000-01-01T00:00:00Z", segment: int = SEGMENT, per_file: int = 5000,
) -> None:
    """Write a record for every row of ``pages`` to gzip-compressed WARC files at ``path``.

    The payload is ``html`` in UTF-8 (null: empty). Of rows with equal payloads of ``least`` bytes
    or more the one with the smallest key is a response and the others revisit it; if that key is
    in several such rows they are all responses, and rows with a null key revisit the smallest
    one there is. Files hold at most ``per_file`` records, so that a reader's memory is bounded.
    """
    text_batches(pages.sparkSession)
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(key).alias("_k"), F.col(url).cast("string").alias("_u"), payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    copies = written(
        rows.where(F.octet_length("payload") >= least).groupBy("digest")
        .agg(F.min("_k").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").drop("n"),
        "copies",
    )
    revisit = F.col("first").isNotNull() & ~F.coalesce(F.col("_k") == F.col("first"), F.lit(False))
    typed = rows.join(copies, "digest", "left").select(
        F.expr("uuid()").alias("uuid"), F.col("_k").cast("string").alias("page"), "_u", "payload", "digest",
        F.when(revisit, F.col("first").cast("string")).alias("refers"), revisit.alias("revisit"),
    )

    def framed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 500):
                out = [r for row in frame.iloc[at : at + 500].itertuples(index=False) for r in records(*row, date, segment)]
                yield pd.DataFrame({"value": out})

    (
        typed.mapInPandas(framed, "value binary").select(F.col("value").cast("string"))
        .write.option("lineSep", END.decode()).option("compression", "gzip")
        .option("maxRecordsPerFile", per_file).text(path)
    )


# ---- reading -------------------------------------------------------------------------------


def parse(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and blocks of a stream of WARC records."""
    buffer, at = bytearray(), 0
    chunks = iter(chunks)

    def fill() -> bool:
        nonlocal at
        more = next(chunks, None)
        if more is None:
            return False
        if at > 1 << 20:
            del buffer[:at]
            at = 0
        buffer.extend(more)
        return True

    while True:
        while (end := buffer.find(END, at)) < 0:
            if not fill():
                if len(buffer) > at:
                    raise ValueError("a record is cut off")
                return
        lines = bytes(buffer[at:end]).decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        head = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
        size = int(head["content-length"])
        at = end + len(END)
        while len(buffer) < at + size + len(END):
            if not fill():
                raise ValueError("a record is cut off")
        yield head, bytes(buffer[at : at + size])
        at += size + len(END)


def _inflated(content: bytes) -> Iterator[bytes]:
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    while content:  # one member or many
        inflate = zlib.decompressobj(31)
        for at in range(0, len(content), 1 << 18):
            yield inflate.decompress(content[at : at + (1 << 18)])
        yield inflate.flush()
        content = inflate.unused_data


SEGMENTS = (
    "origin string, number int, total long, block binary, type string, page string, refers string, "
    "digest string, length long, url string"
)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives at ``path``, continuations under their origin's identifier."""

    def opened(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                rows = []
                for head, block in parse(_inflated(content)):
                    get = head.get
                    number, total, length = (
                        None if get(k) is None else int(get(k))
                        for k in ("warc-segment-number", "warc-segment-total-length", "x-payload-length")
                    )
                    kind = get("warc-type")
                    rows.append((
                        get("warc-segment-origin-id", get("warc-record-id")), number, total, block,
                        None if kind == "continuation" else kind, get("x-page-id"), get("x-refers-to-page-id"),
                        (get("warc-payload-digest") or "").removeprefix("sha256:") or None, length, get("warc-target-uri"),
                    ))
                    if len(rows) == 500:
                        yield _segments(rows)
                        rows = []
                yield _segments(rows)

    def _segments(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in SEGMENTS.split(", ")])
        return out.astype({"number": "Int32", "total": "Int64", "length": "Int64"})

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(opened, SEGMENTS)


def reassemble(segments: DataFrame) -> DataFrame:
    """One row per response or revisit: ``page, url, record_type, payload, payload_bytes,
    payload_digest, refers_to, complete``.

    Only segmented records are grouped, by their origin's identifier, and put in order by segment
    number. ``complete`` is false, and the payload null, if numbers are missing or double, the
    total length is absent or wrong, the chunked framing is broken or the digest differs. A
    continuation without its first record gives a row with a null ``record_type``.
    """
    part = F.struct("number", "total", "block")
    columns = ["type", "page", "refers", "digest", "length", "url"]
    whole = segments.where("number IS NULL").select(F.array(part).alias("parts"), *columns)
    split = segments.where("number IS NOT NULL").groupBy("origin").agg(
        F.array_sort(F.collect_list(part)).alias("parts"), *[F.max(c).alias(c) for c in columns]
    ).drop("origin")

    def finished(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                parts = [(p["number"], p["total"], p["block"]) for p in r.parts]
                payload, size, digest = None, None if pd.isna(r.length) else int(r.length), r.digest
                if r.type == "revisit":
                    complete = digest is not None
                else:
                    message = b"".join(p[2] for p in parts)
                    ordered = len(parts) == 1 and parts[0][0] is None or (
                        [p[0] for p in parts] == [*range(1, len(parts) + 1)] and parts[-1][1] == len(message)
                    )
                    payload = http_payload(message) if ordered and r.type else None
                    if payload is not None and hashlib.sha256(payload).hexdigest() != digest:
                        payload = None
                    complete = payload is not None
                    size = len(payload) if complete else size
                out.append((r.page, r.url, r.type, payload, size, digest, r.refers, complete))
            names = ["page", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to", "complete"]
            yield pd.DataFrame(out, columns=names).astype({"payload_bytes": "Int64"})

    return whole.unionByName(split).mapInPandas(
        finished,
        "page string, url string, record_type string, payload binary, payload_bytes long, "
        "payload_digest string, refers_to string, complete boolean",
    )
