"""WARC archives: a deterministic sharded writer, and a reader.

Records are sorted by page id. The ranges of the shards come from a sample chosen by the rows' own content, and all that a
record holds (ids, digests, lengths, a given date) follows from its page, so the same pages give the same archives. Each
record is a gzip member of its own; a file is rolled when its compressed size reaches a bound. Of pages with equal long
payloads only the one with the largest id keeps its payload on the way to its shard; the others are ``revisit`` records.

A task writes under names of its own attempt. What it returns, the list of its files, is written to the shared folder;
then the listed files get their final names, and the manifest is written last. A lost executor leaves at most files that no
manifest names.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import new_dir, store
from . import files

ROLL_BYTES = 64 << 20
LEAST_PAYLOAD = 1000
#: Shards: one for so many bytes of payload, within bounds; and sampled rows for each shard.
SHARD_BYTES, LEAST_SHARDS, MOST_SHARDS, SAMPLED = 16 << 20, 64, 20_000, 32
DATE = "2024-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
MANIFEST = "shard int, number int, temporary string, final string, records long, bytes long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, position long"


# ---- records -----------------------------------------------------------------------------------------------------


def _label(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _uri(url: str) -> str:
    """Characters that would break a header line are percent-encoded."""
    return "".join(c if 32 < ord(c) < 127 else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url)


def record(page: dict, name: str, date: str = DATE) -> bytes:
    """One WARC record of a page (page_id, url, payload, digest, bytes, head: the id it revisits, revisit: bool)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {page['bytes']}\r\n\r\n".encode()
    block = http if page["revisit"] else http + page["payload"]
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if page['revisit'] else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_NAMESPACE, name)}>", f"WARC-Date: {date}"]
    if page["url"] is not None:
        lines.append(f"WARC-Target-URI: {_uri(page['url'])}")
    if page["page_id"] is not None:
        lines.append(f"Page-ID: {page['page_id']}")
    if page["revisit"]:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(_NAMESPACE, head_name(page['head'], page['digest']))}>")
        if page["head"] is not None:
            lines.append(f"Refers-To-Page-ID: {page['head']}")
    lines += [
        f"WARC-Payload-Digest: {_label(page['digest'])}", f"WARC-Block-Digest: {_label(hashlib.sha1(block).digest())}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def head_name(page_id: int | None, digest: bytes) -> str:
    return f"{page_id}/{digest.hex()}"


def member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def members(source, step: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """Position and content of each gzip member of a stream."""
    position, open_, parts = 0, zlib.decompressobj(31), []
    start, rest = 0, b""
    while True:
        data = rest or source.read(step)
        if not data:
            break
        parts.append(open_.decompress(data))
        rest = open_.unused_data
        position += len(data) - len(rest)
        if open_.eof:
            yield start, b"".join(parts)
            start, open_, parts = position, zlib.decompressobj(31), []
    if parts:
        raise ValueError("the archive ends within a record")


def parse(data: bytes) -> dict[str, object] | None:
    """Fields of a record, checked against its digests; None for a ``warcinfo``."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if fields["WARC-Type"] == "warcinfo":
        return None
    if _label(hashlib.sha1(block).digest()) != fields["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = base64.b32decode(fields["WARC-Payload-Digest"][5:])
    if fields["WARC-Type"] == "response":
        digest, size = hashlib.sha1(payload).digest(), len(payload)
        if digest != stated:
            raise ValueError(f"payload digest of {fields['WARC-Record-ID']}")
    else:
        digest, size = stated, int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("Page-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest.hex(),
        "record_type": fields["WARC-Type"], "refers_to": number("Refers-To-Page-ID"),
    }


# ---- plan --------------------------------------------------------------------------------------------------------


def _groups(digested: DataFrame) -> DataFrame:
    """Of each payload that several long pages share: its digest, the page that keeps it, and how often that one is there."""
    by_page = digested.where(F.col("bytes") >= LEAST_PAYLOAD).groupBy("digest", "page_id").agg(F.count("*").alias("n"), F.min("url").alias("first_url"))
    best = F.max(F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "n", "first_url")).alias("best")
    groups = by_page.groupBy("digest").agg(best, F.sum("n").alias("all")).where(F.col("all") > 1)
    return groups.select("digest", F.col("best.page_id").alias("head"), F.col("best.n").alias("heads"), F.col("best.first_url").alias("head_url"), F.lit(True).alias("shared"))


def _decided(pages: DataFrame) -> DataFrame:
    """Every record with ``revisit``; revisits have lost their payload."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    digested = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    digested = digested.withColumns({"digest": F.unhex(F.sha1("payload")), "bytes": F.octet_length("payload").cast("long")})
    groups = store(_groups(digested), "payload-groups")
    rows = digested.join(groups, "digest", "left")
    is_head = F.coalesce("shared", F.lit(False)) & F.col("page_id").eqNullSafe(F.col("head"))
    repeated = is_head & (F.col("heads") > 1)
    revisit = F.coalesce("shared", F.lit(False)) & ~is_head
    kept = ["page_id", "url", "payload", "digest", "bytes", "head", "revisit"]
    out = rows.where(~repeated).withColumn("revisit", revisit)
    if not groups.where("heads > 1").isEmpty():
        # the page that keeps a payload is there several times: one copy keeps it
        copies = (
            rows.where(repeated).groupBy("digest", "page_id", "url", "bytes", "head", "head_url")
            .agg(F.first("payload").alias("payload"), F.count("*").alias("n"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
            .withColumn("revisit", ~((F.col("copy") == 1) & F.col("url").eqNullSafe(F.col("head_url"))))
        )
        out = out.select(kept).unionByName(copies.select(kept))
    return out.select(*kept[:2], F.when(~F.col("revisit"), F.col("payload")).alias("payload"), *kept[3:])


def _ranges(pages: DataFrame) -> np.ndarray:
    """Least keys of all shards but the first, from a sample of a bounded size chosen by content."""
    size = F.coalesce(F.octet_length("html"), F.lit(0))
    n, total = pages.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    shards = min(MOST_SHARDS, max(LEAST_SHARDS, -(-total // SHARD_BYTES)))
    # SAMPLED x shards rows are expected, 640,000 numbers at most
    share = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30)) < F.lit(int(min(1.0, SAMPLED * shards / max(n, 1)) * (1 << 30)))
    keys = _sortable(*(np.array(c, dtype=np.int64) for c in zip(*pages.where(share).select(*_key()).collect(), (0, 0))))[:-1]
    keys.sort()
    if not len(keys):
        return keys
    return keys[np.arange(1, shards) * len(keys) // shards]


def _key() -> list:
    """Sort key: the page id (null first), then the hash of the address."""
    return [F.coalesce(F.col("page_id").cast("long"), F.lit(-(1 << 63))), F.xxhash64("page_id", "url")]


def _shard(bounds: np.ndarray, key: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Shard of each key. Rows with a key that fills several shards are dealt to them by turns."""
    low, high = np.searchsorted(bounds, key, side="left"), np.searchsorted(bounds, key, side="right")
    return np.where(high - low > 1, low + 1 + turn % np.maximum(high - low, 1), high).astype(np.int32)


def _sortable(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Two integers as 16 bytes that sort like them."""
    flip = np.uint64(1 << 63)
    both = np.stack([first.astype(np.int64).view(np.uint64) ^ flip, second.astype(np.int64).view(np.uint64) ^ flip], axis=1)
    return np.ascontiguousarray(both.astype(">u8")).view("S16").ravel()


# ---- write and read ----------------------------------------------------------------------------------------------


def write(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, date: str = DATE) -> DataFrame:
    """Write a record for every row of ``pages`` (page_id, url, html); returns the manifest as read back.

    A null html is an empty payload; null ids and urls leave their header out. Repeated rows have a record each.
    """
    session = pages.sparkSession
    folder = files.qualified(session, folder)
    bounds = _ranges(pages)

    @F.pandas_udf("int")
    def shard_of(first, second, turn):
        import pandas as pd

        return pd.Series(_shard(bounds, _sortable(first.to_numpy(), second.to_numpy()), turn.to_numpy()))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store_, place = files.open_fs(folder)
        store_.create_dir(place, recursive=True)
        now = None

        def listed() -> pa.RecordBatch:
            out.close()
            row = [now, number, temporary, final, records, size]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], [f.split()[0] for f in MANIFEST.split(", ")])

        for batch in batches:
            for page in batch.to_pylist():
                if now is not None and (page["shard"] != now or size >= roll_bytes):
                    yield listed()
                    number = number + 1 if page["shard"] == now else 0
                    now = None
                elif now is None:
                    number = 0
                if now is None:
                    now, records = page["shard"], 0
                    final = f"pages-{now:06d}-{number:05d}.warc.gz"
                    temporary = files.attempt_name(final)
                    out = store_.open_output_stream(files.join(place, temporary), compression=None)
                    data = member(_info(final, date))
                    size = out.write(data)
                name = head_name(page["page_id"], page["digest"]) if page["head"] is not None and not page["revisit"] else f"{final}/{records}"
                size += out.write(member(record(page, name, date)))
                records += 1
        if now is not None:
            yield listed()

    first, second = _key()
    keyed = _decided(pages).withColumns({"_first": first, "_second": second})
    placed = keyed.withColumn("shard", shard_of("_first", "_second", F.monotonically_increasing_id()))
    ordered = placed.repartition("shard").sortWithinPartitions("shard", "_first", "_second", "digest").drop("_first", "_second")
    path = files.join(folder, "_list")
    ordered.mapInArrow(put, MANIFEST).write.parquet(path)
    return files.publish(session.read.schema(MANIFEST).parquet(path), folder)


def _info(name: str, date: str) -> bytes:
    body = b"software: stellate\r\nformat: WARC File Format 1.1\r\n"
    lines = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_NAMESPACE, name)}>", f"WARC-Date: {date}"]
    lines += [f"WARC-Filename: {name}", "Content-Type: application/warc-fields", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per response or revisit of the listed archives. Digests are checked; a response's digest and length are
    those of the payload as read, a revisit's those of its headers."""
    folder = files.qualified(manifest.sparkSession, folder)

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store_, place = files.open_fs(folder)
        kind = pa.schema([(f.split()[0], {"long": pa.int64(), "string": pa.string()}[f.split()[1]]) for f in RECORD.split(", ")])
        for batch in batches:
            for name in batch.column("final").to_pylist():
                rows = []
                with store_.open_input_stream(files.join(place, name), compression=None) as source:
                    for position, data in members(source):
                        fields = parse(data)
                        if fields is not None:
                            rows.append(fields | {"file": name, "position": position})
                        if len(rows) >= 4096:
                            yield pa.RecordBatch.from_pylist(rows, kind)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kind)

    return files.readers(manifest.select("final")).mapInArrow(get, RECORD)


def round_trip(pages: DataFrame, folder: str | None = None, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write all pages and read the archives back. An empty table writes no archive and gives no row."""
    folder = folder or new_dir(pages.sparkSession, "warc")
    return read(write(pages.select("page_id", "url", "html"), folder, roll_bytes), folder)
