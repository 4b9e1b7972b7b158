"""WARC archives written and read as tables of chunks.

A record is a run of rows ``record_id, chunk_no, chunk``; no step needs a whole payload at once. A
writer compresses the chunks into one gzip member per record while it carries the digest along, and
leaves an index of where each record lies. A reader starts at such a place, decompresses a
bounded piece at a time, and gives the chunks back with the digest and the size so far.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sluice.llm.components import dropped, stored
from sluice.session import scratch_path

CHUNK = 1 << 16
# Payloads shorter than this are never replaced by a reference.
LEAST_REVISIT = 1000
# A new archive begins after the record that takes one beyond this size.
ARCHIVE_BYTES = 1 << 30
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

INDEX = "record_id string, archive string, place long, size long"
CHUNKS = (
    "record_id string, page_id long, url string, record_type string, refers_to long, chunk_no long, chunk binary, "
    "bytes_so_far long, digest_so_far string, is_last boolean, stated_bytes long, stated_digest string"
)


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest`` of every page.

    The payload is the page in UTF-8, empty for null. Other columns are ignored.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    all_ = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    return all_.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha1("payload"))


def revisits(found: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``payload_digest, page_id, response`` for every page that revisits another one.

    Of equal payloads of at least ``least`` bytes, the one with the largest id is the response. Rows
    without an id, and rows that share the largest id, are responses. Only digests and ids are
    shuffled; a popular page is summed up before.
    """
    held = found.where((F.col("payload_bytes") >= least) & F.col("page_id").isNotNull()).select("payload_digest", "page_id").distinct()
    again = held.groupBy("payload_digest").agg(F.max("page_id").alias("response"), F.count("*").alias("pages")).where("pages > 1")
    return held.join(again, "payload_digest").where("page_id < response").select("payload_digest", "page_id", "response")


def chunked(found: DataFrame, least: int = LEAST_REVISIT, chunk: int = CHUNK, used: list[str] | None = None) -> DataFrame:
    """One row per chunk of each record, the rows of a record together and in order.

    A record without a payload, as a revisit is, has one empty chunk. Payloads are cut where they are
    read, so no whole one is shuffled or sorted. The revisits are written first: while they are
    small enough for a broadcast, the chunks they let out go before any shuffle; beyond, chunks meet
    them by digest and id, so that a popular page is no hot key.
    """
    known = stored(revisits(found, least), "warc-revisits", used)
    last = F.greatest(F.lit(0), F.floor((F.col("payload_bytes") - 1) / chunk)).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), last), lambda n: F.substring("payload", n * chunk + 1, F.lit(chunk)))
    # Rows that are equal in all columns are told apart by where they are read; their chunks come from one task.
    placed = found.withColumn("copy", F.monotonically_increasing_id())
    facts = ("page_id", "url", "payload_bytes", "payload_digest", "copy")
    rows = placed.select(*facts, F.posexplode(pieces).alias("chunk_no", "chunk")).join(known, ["payload_digest", "page_id"], "left")
    revisit = F.col("response").isNotNull()
    return (
        rows.where(~revisit | (F.col("chunk_no") == 0))
        .select(
            *facts,
            F.when(revisit, "revisit").otherwise("response").alias("record_type"),
            F.col("response").alias("refers_to"),
            "chunk_no",
            F.when(revisit, F.lit(b"")).otherwise(F.col("chunk")).alias("chunk"),
        )
        .sortWithinPartitions("payload_digest", "page_id", "url", "copy", "chunk_no")
        .drop("copy")
    )


def record_name(page: int | None, digest: str) -> str:
    return f"urn:page:{page}" if page is not None else f"urn:page:none:{digest}"


def header(row: dict) -> bytes:
    """The WARC and HTTP headers of a record up to its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    revisit = row["record_type"] == "revisit"
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <{record_name(row['page_id'], row['payload_digest'])}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {' '.join((row['url'] or '').split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (0 if revisit else row['payload_bytes'])}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_name(row['refers_to'], row['payload_digest'])}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def write(chunks: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the chunk rows, a file or more per partition below ``folder``; gives the index of the records.

    Equal partitions give equal files, and a file gets its name when it is complete, so an attempt
    that is repeated replaces it by itself.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for n in range(batch.num_rows):
                yield {c: batch.column(c)[n].as_py() for c in batch.schema.names}

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        out, index, number, place = None, [], 0, 0
        system.create_dir(base, recursive=True)

        def close():
            out.close()
            system.move(f"{base}/.{name}-{task.taskAttemptId()}", f"{base}/{name}")

        for row in rows(batches):
            if row["chunk_no"] == 0:
                if out is not None and place >= archive_bytes:
                    close()
                    out, number = None, number + 1
                if out is None:
                    name, place = f"part-{task.partitionId():06d}-{number:04d}.warc.gz", 0
                    out = system.open_output_stream(f"{base}/.{name}-{task.taskAttemptId()}")
                begin, done, digest = place, 0, hashlib.sha1()
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                place += out.write(packer.compress(header(row)))
            digest.update(row["chunk"])
            done += len(row["chunk"])
            place += out.write(packer.compress(row["chunk"]))
            if row["record_type"] == "revisit" or done == row["payload_bytes"]:
                if row["record_type"] != "revisit" and digest.hexdigest() != row["payload_digest"]:
                    raise ValueError(f"payload of page {row['page_id']} changed on its way")
                place += out.write(packer.compress(b"\r\n\r\n") + packer.flush())
                index.append((record_name(row["page_id"], row["payload_digest"]), f"{folder}/{name}", begin, place - begin))
            if len(index) >= 10_000:
                yield table(index)
                index = []
        if out is not None:
            close()
        if index:
            yield table(index)

    def table(index: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch(dict(zip(("record_id", "archive", "place", "size"), map(pa.array, zip(*index)))))

    return stored(chunks.mapInArrow(put, INDEX), "warc-index")


def pieces_of(stream, size: int, step: int = CHUNK) -> Iterator[tuple[bool, bytes]]:
    """Decompress ``size`` bytes of gzip members in bounded pieces; the flag marks the first piece of a member."""
    unpacker, first, left = zlib.decompressobj(31), True, size
    data = b""
    while True:
        if not data and left > 0:
            data = stream.read(min(step, left))
            left -= len(data)
        out = unpacker.decompress(data, step)
        data = unpacker.unconsumed_tail
        if out:
            yield first, out
            first = False
        if unpacker.eof:
            data, first = unpacker.unused_data, True
            if not data and left <= 0:
                return
            unpacker = zlib.decompressobj(31)
        elif not out and not data and left <= 0:
            return


def fields(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def page_of(name: str | None) -> int | None:
    last = (name or "").strip("<>").removeprefix("urn:page:")
    return int(last) if last.lstrip("-").isdigit() else None


def read_records(stream, size: int) -> Iterator[tuple]:
    """The rows of ``CHUNKS`` in ``size`` bytes of an archive, with at most two pieces in memory."""
    held, state = b"", None
    for first, piece in pieces_of(stream, size):
        if first:
            held, state = b"", None
        held += piece
        if state is None:
            head, gap, rest = held.partition(b"\r\n\r\n")
            http, gap2, body = rest.partition(b"\r\n\r\n")
            if not gap or not gap2:
                continue
            warc, told = fields(head), fields(http)
            left = int(warc["content-length"]) - len(http) - 4
            state = {"warc": warc, "left": left, "n": 0, "done": 0, "digest": hashlib.sha1(), "bytes": int(told["content-length"])}
            held = body
        while state["left"] or not state["n"]:
            part = held[: min(CHUNK, state["left"])]
            if len(part) < min(CHUNK, state["left"]):
                break
            held = held[len(part) :]
            state["left"] -= len(part)
            state["done"] += len(part)
            state["digest"].update(part)
            warc = state["warc"]
            stated = base64.b32decode(warc["warc-payload-digest"].removeprefix("sha1:")).hex()
            yield (
                warc["warc-record-id"].strip("<>"),
                page_of(warc["warc-record-id"]),
                warc.get("warc-target-uri"),
                warc["warc-type"],
                page_of(warc.get("warc-refers-to")),
                state["n"],
                part,
                state["done"],
                state["digest"].hexdigest(),
                not state["left"],
                state["bytes"],
                stated,
            )
            state["n"] += 1


def read(index: DataFrame) -> DataFrame:
    """The chunk rows of all indexed records. Rows of an index need only ``archive, place, size``."""
    names = [part.split()[0] for part in CHUNKS.split(", ")]
    kinds = pa.schema(
        [(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}[part.split()[1]]) for n, part in zip(names, CHUNKS.split(", "))]
    )

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("archive", "place", "size"))))
        rows, held = [], 0
        for archive, group in itertools.groupby(places, key=lambda p: p[0]):
            system, path = fs.FileSystem.from_uri(archive)
            with system.open_input_file(path) as stream:
                for _, place, size in group:
                    stream.seek(place)
                    for row in read_records(stream, size):
                        rows.append(row)
                        held += len(row[6])
                        if held > 64 * CHUNK or len(rows) >= 2000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)

    return index.select("archive", "place", "size").mapInArrow(get, CHUNKS)


def round_trip(pages: DataFrame, folder: str | None = None, least: int = LEAST_REVISIT, **columns: str) -> DataFrame:
    """Write all pages into archives below ``folder`` (the shared folder if none is named) and read them back."""
    spark, used = pages.sparkSession, []
    folder = folder or scratch_path(spark, "warc")
    index = write(chunked(records(pages, **columns), least, used=used), folder)
    dropped(spark, used)
    return read(index)


def summary(chunks: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` per record, from its last chunk.

    What a response holds is measured; a revisit states the size and the digest of what it refers to.
    """
    own = F.col("record_type") == "response"
    return chunks.where("is_last").select(
        "page_id",
        F.when(own, F.col("bytes_so_far")).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
        F.when(own, F.col("digest_so_far")).otherwise(F.col("stated_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
