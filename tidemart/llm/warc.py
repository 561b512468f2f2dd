"""WARC archives written index first, and read back by coalesced byte ranges.

Writing: each task writes its rows' records, one gzip member a record, into a file of its own and returns a line per record
for the index: file, offset, length, URL and payload digest. The index is written as a table before anything is read. A file's
name holds a random part, so what a lost or repeated attempt leaves behind is named by no index.

Reading: the selected lines of the index are dealt out by file and offset, sorted, and neighbours whose ranges lie within
`GAP` bytes are fetched in one read of at most `RUN` bytes; the records are cut from it and parsed. Only files and ranges with
selected records are touched.

Of records with equal payloads of at least `least` bytes, that with the smallest key is a response and the others are
revisits: they carry the HTTP head, the digest and a reference, not the payload. Smaller payloads are all responses.
Null payloads are empty. Rows that repeat the smallest key with its payload are responses too; a null key is smaller than
none, so it is a response only if all its equals have null keys. Null URLs are left out of the record. An empty table gives
an empty index.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm import files
from tidemart.llm.rows import quoted, text_or_empty
from tidemart.session import materialize

VERSION = b"WARC/1.1"
#: The profile of a revisit whose payload is that of the record it refers to.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads under so many bytes are stored each time.
LEAST_BYTES = 100
#: Ranges so near to each other are read together, in reads of so many bytes; a longer record is a read of its own.
GAP, RUN = 64 << 10, 8 << 20
#: A reading task gets about so many bytes of records.
TASK_BYTES = 64 << 20
INDEX = "file string, offset long, length long, url string, digest string, record_type string"


def record_id(key: str | None, digest: str, kind: str) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{kind}:{digest}" if key is None else f"{kind}:{digest}:{key}").urn


def _head(first: bytes, fields: list[tuple[str, str]]) -> bytes:
    return first + b"".join(f"\r\n{name}: {value}".encode() for name, value in fields) + b"\r\n\r\n"


def response_head(size: int) -> bytes:
    return _head(b"HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(size))])


def record(key: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One record: a response with its payload, or a revisit of the record of `refers_to` without."""
    http = response_head(len(payload))
    block = http if refers_to is not None else http + payload
    kind = "response" if refers_to is None else "revisit"
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id(key, digest, kind)}>"), ("WARC-Date", date)]
    if key is not None:
        fields.append(("Key", quote(key)))
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe=";/?:@&=+$,#[]!*'()%-._~")))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if refers_to is not None:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", f"<{record_id(refers_to, digest, 'response')}>"), ("Refers-To-Key", quote(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return _head(VERSION, fields) + block + b"\r\n\r\n"


@dataclass(frozen=True)
class Record:
    kind: str
    fields: dict[str, str]
    http: dict[str, str]
    payload: bytes


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def _named(spelt: str | None) -> str | None:
    return None if spelt is None else unquote(spelt)


def parse(data: bytes) -> Record:
    """The record of one gzip member; a block that is cut short or a payload with another digest is an error."""
    plain = zlib.decompress(data, wbits=31)
    head, found, rest = plain.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/"):
        raise ValueError("no WARC record at this place")
    fields = _fields(head)
    size = int(fields["content-length"])
    if len(rest) != size + 4:
        raise ValueError(f"the block of {fields['warc-record-id']} has {len(rest) - 4} bytes instead of {size}")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    if fields["warc-type"] == "response" and hashlib.sha256(payload).hexdigest() != fields["warc-payload-digest"].partition(":")[2]:
        raise ValueError(f"the payload of {fields['warc-record-id']} is not what its digest says")
    return Record(fields["warc-type"], fields, _fields(http), payload)


def payload_roles(pages: DataFrame, key: Column, payload: Column, least: int = LEAST_BYTES) -> DataFrame:
    """`pages` with `digest` (SHA-256 of the payload's bytes) and `first`: the smallest key with the same payload, where rows share it.

    Digests are counted before the join, which only those that several rows share take part in, so a payload that very many rows hold is one
    row on one side and is split on the other by the adaptive skew join.
    """
    digested = pages.withColumns({"digest": F.sha2(F.encode(payload, "UTF-8"), 256), "size": F.octet_length(payload)})
    shared = (
        digested.filter(F.col("size") >= least).groupBy("digest").agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("first")).filter("rows > 1").select("digest", "first")
    )
    return digested.join(materialize(shared, "shared_payloads"), "digest", "left")


def write_archive(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST_BYTES, date: str = "1970-01-01T00:00:00Z", level: int = 6) -> DataFrame:
    """Write the rows' payloads below `folder` and return the index: key, file, offset, length, URL, digest, record type."""
    rows = pages.select(F.col(quoted(key)).alias("key"), F.col(quoted(url)).cast("string").alias("url"), text_or_empty(payload).alias("payload"))
    placed = payload_roles(rows, F.col("key"), F.col("payload"), least)
    revisits = F.when(F.col("key").isNull() | (F.col("key") != F.col("first")), F.col("first").cast("string"))
    placed = placed.select("key", F.col("key").cast("string").alias("name"), "url", "payload", "digest", revisits.alias("refers_to"))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, offset = None, 0
        place = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        for batch in batches:
            if not batch.num_rows:
                continue
            if stream is None:
                stream = files.open_new(place)
            offsets, lengths, kinds = [], [], []
            for row in zip(*(batch.column(at) for at in range(1, 6)), strict=True):
                name, target, text, digest, refers_to = (one.as_py() for one in row)
                one = record(name, target, text.encode(), digest, refers_to, date)
                data = gzip.compress(one, level, mtime=0)
                stream.write(data)
                offsets.append(offset)
                lengths.append(len(data))
                kinds.append("response" if refers_to is None else "revisit")
                offset += len(data)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([place] * len(kinds)), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), batch.column(2), batch.column(4), pa.array(kinds)],
                ["key", "file", "offset", "length", "url", "digest", "record_type"],
            )
        if stream is not None:
            stream.close()

    kind = rows.schema["key"].dataType.simpleString()
    return materialize(placed.mapInArrow(written, f"key {kind}, {INDEX}"), "warc_index").withColumnRenamed("key", key)


def coalesced(lines: list[tuple[str, int, int]], gap: int = GAP, run: int = RUN) -> Iterator[tuple[str, int, int, list[int]]]:
    """(file, from, to, places of the lines inside) of reads that cover sorted lines (file, offset, length)."""
    at = 0
    while at < len(lines):
        file, start, length = lines[at]
        end, inside = start + length, [at]
        while at + 1 < len(lines):
            other, offset, size = lines[at + 1]
            if other != file or offset > end + gap or max(end, offset + size) - start > run:
                break
            at += 1
            end = max(end, offset + size)
            inside.append(at)
        yield file, start, end, inside
        at += 1


def read_records(selected: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of lines of an index: key and url as text from the record, type, payload size and digest, the key it refers to, and the payload."""
    spark = selected.sparkSession
    total = selected.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    ordered = selected.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = list(zip(*(column.to_pylist() for column in batch.columns), strict=True))
            for file, start, end, inside in coalesced(lines):
                data = files.read_range(file, start, end - start)
                found = [parse(data[lines[k][1] - start : lines[k][1] - start + lines[k][2]]) for k in inside]
                out = {
                    "key": [_named(one.fields.get("key")) for one in found],
                    "url": [one.fields.get("warc-target-uri") for one in found],
                    "record_type": [one.kind for one in found],
                    "payload_bytes": [int(one.http["content-length"]) for one in found],
                    "payload_digest": [one.fields["warc-payload-digest"].partition(":")[2] for one in found],
                    "refers_to": [_named(one.fields.get("refers-to-key")) for one in found],
                    **({"payload": [one.payload if one.kind == "response" else None for one in found]} if payloads else {}),
                }
                yield pa.RecordBatch.from_pydict(out, schema=arrow)

    names = {"key": pa.string(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.string()}
    arrow = pa.schema({**names, **({"payload": pa.binary()} if payloads else {})})
    schema = "key string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string" + (", payload binary" if payloads else "")
    return ordered.mapInArrow(records, schema)


def with_payloads(records: DataFrame) -> DataFrame:
    """Records with each revisit's payload taken from the response that it refers to."""
    held = records.filter("record_type = 'response'").select(F.col("payload_digest").alias("digest"), "key", F.col("payload").alias("held"))
    visits = records.filter("record_type = 'revisit'").drop("payload").alias("v")
    first = held.groupBy("digest", "key").agg(F.first("held").alias("payload")).alias("h")
    met = visits.join(first, (F.col("v.payload_digest") == F.col("h.digest")) & (F.col("v.refers_to") == F.col("h.key")), "left").select("v.*", "h.payload")
    return records.filter("record_type = 'response'").unionByName(met)
