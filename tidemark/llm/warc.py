"""WARC archives: a monolithic gzip normaliser with a sidecar offset index.

Archives that were compressed as one gzip stream can't be entered in the middle. The normaliser inflates each file
once, as a stream, rewrites every record as a gzip member of its own and writes, beside the archive, an index of
member offsets. Any record can then be read on its own. A file is one task; what a task holds is a chunk of input and
one record. Files are written under a temporary name and moved, so a task that runs again leaves the same file.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import new_path, written

REVISIT_BYTES = 1000
#: Digests with several pages, at most, that are broadcast (about 60 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 100_000
CHUNK = 1 << 20
LEVEL = 6
GZIP = 16 + zlib.MAX_WBITS
_BREAK = b"\r\n\r\n"
#: Fixed by the WARC format: what a revisit of an equal payload says of itself.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def page_records(pages: DataFrame) -> DataFrame:
    """One record a row: ``page_id``, ``url``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``payload``.

    Of payloads that are equal and at least ``REVISIT_BYTES`` long, the row with the largest page_id is the response
    and the others revisit it; a revisit's payload is null. A null html is an empty payload. Rows that share the
    largest page_id are all responses; a null page_id is smaller than any.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.select("page_id", "url", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), "payload")
    large = rows.where(F.col("payload_bytes") >= REVISIT_BYTES)
    shared = large.groupBy("payload_digest").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    # only digests and ids are grouped; payloads stay where they were read unless the shared ones are too many
    shared = written(shared, "warc-shared")
    if shared.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        shared = F.broadcast(shared)
    out = rows.join(shared, "payload_digest", "left")
    revisit = F.coalesce((F.col("payload_bytes") >= REVISIT_BYTES) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.lit(False))
    return out.select(
        "page_id", "url", "payload_bytes", "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"), F.when(~revisit, F.col("payload")).alias("payload"),
    )


def record_text(records: DataFrame, date: str | None = None) -> DataFrame:
    """``value``: each record's bytes but for the two line breaks that end it. ``date`` is the moment of capture, by default now."""
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    header = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.when(F.col("refers_to").isNotNull(), F.concat(F.lit("WARC-Refers-To: "), name(F.col("refers_to")))),
        F.when(F.col("record_type") == "revisit", F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.coalesce(F.octet_length("payload"), F.lit(0)).cast("string")),
    )
    return records.select(F.concat(header, F.lit("\r\n\r\n"), F.coalesce(F.col("payload").cast("string"), F.lit(""))).alias("value"))


def write_monolithic(records: DataFrame, path: str) -> str:
    """Archives of whole records, each file one gzip stream, one file a task."""
    record_text(records).write.option("compression", "gzip").option("lineSep", "\r\n\r\n").text(path)
    return path


def _opened(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a URI; Hadoop's names of S3 are the same store to Arrow."""
    scheme, _, rest = uri.partition(":")
    if scheme in ("s3a", "s3n"):
        uri = f"s3:{rest}"
    elif scheme == "file" and not rest.startswith("//"):
        uri = f"file://{rest}"
    try:
        return pyarrow.fs.FileSystem.from_uri(uri)
    except pa.ArrowInvalid as e:
        raise ValueError(f"archives can't be read or written at {uri}: use a file, hdfs, s3a or gs folder for spark.checkpoint.dir") from e


def _inflated(stream) -> Iterator[bytes]:
    """Any sequence of gzip members as chunks."""
    engine = zlib.decompressobj(GZIP)
    while data := stream.read(CHUNK):
        while data:
            yield engine.decompress(data)
            data = engine.unused_data
            if engine.eof:
                engine = zlib.decompressobj(GZIP) if data else engine
                if not data:
                    rest = stream.read(CHUNK)
                    if not rest:
                        return
                    engine, data = zlib.decompressobj(GZIP), rest
    tail = engine.flush()
    if not engine.eof:
        raise ValueError("the gzip stream breaks off")
    yield tail


def records_of(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and the whole record, from a stream of inflated chunks."""
    held = bytearray()
    more = True

    def fill(n: int) -> bool:
        nonlocal more
        while more and len(held) < n:
            chunk = next(chunks, None)
            more = chunk is not None
            held.extend(chunk or b"")
        return len(held) >= n

    while fill(1):
        cut = held.find(_BREAK)
        while cut < 0:
            if not fill(len(held) + 1):
                raise ValueError("a WARC header breaks off")
            cut = held.find(_BREAK)
        lines = bytes(held[:cut]).decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = cut + 4 + int(fields["content-length"])
        if not fill(size):
            raise ValueError("a WARC block breaks off")
        record = bytes(held[:size])
        fill(size + 4)
        del held[: size + 4 * (held[size : size + 4] == _BREAK)]
        yield fields, record


def _member(record: bytes) -> bytes:
    engine = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
    return engine.compress(record + _BREAK) + engine.flush()


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite every archive under ``source`` into ``target``: ``name.warc.gz`` and its index ``name.idx.jsonl``.

    Returns a row an archive: ``archive``, ``index``, ``records``. Input files may be one stream or many members; an
    empty file gives an empty archive. A broken stream or header fails the task.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path", "length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                fs, inner = _opened(path)
                out, folder = _opened(target)
                out.create_dir(folder, recursive=True)
                name = f"{folder}/{hashlib.sha1(path.encode()).hexdigest()[:20]}"
                temporary = f"{folder}/.{uuid.uuid4().hex}"
                offset, n = 0, 0
                with fs.open_input_stream(inner, compression=None, buffer_size=CHUNK) as stream, out.open_output_stream(f"{temporary}.warc.gz", compression=None) as archive, out.open_output_stream(f"{temporary}.jsonl", compression=None) as index:
                    for fields, record in records_of(_inflated(stream)):
                        member = _member(record)
                        archive.write(member)
                        entry = {"archive": f"{name}.warc.gz", "offset": offset, "length": len(member), "type": fields.get("warc-type"), "id": fields.get("warc-record-id"), "uri": fields.get("warc-target-uri"), "digest": fields.get("warc-payload-digest")}
                        index.write(json.dumps(entry).encode() + b"\n")
                        offset, n = offset + len(member), n + 1
                out.move(f"{temporary}.warc.gz", f"{name}.warc.gz")
                out.move(f"{temporary}.jsonl", f"{name}.idx.jsonl")
                yield pa.RecordBatch.from_pylist([{"archive": f"{name}.warc.gz", "index": f"{name}.idx.jsonl", "records": n}])

    # one archive a task: by key alone, adaptive execution would join all of these short rows in one task
    return files.repartition(max(1, files.count())).mapInArrow(run, "archive string, index string, records long")


INDEX_SCHEMA = "archive string, offset long, length long, type string, id string, uri string, digest string"


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of normalised archives, found by the index and inflated on its own.

    ``id``, ``type``, ``uri``, ``refers_to``, ``digest`` and ``payload_length`` as the headers say, ``block`` (binary)
    and ``block_sha1`` of the bytes read.
    """
    index = spark.read.schema(INDEX_SCHEMA).json(f"{folder}/*.idx.jsonl")
    scheme = folder.split(":", 1)[0] if "://" in folder or folder.startswith("file:") else "file"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                out = []
                for entry in batch.slice(lo, 256).to_pylist():
                    if entry["archive"] != name:
                        name = entry["archive"]
                        fs, inner = _opened(name if ":" in name else f"{scheme}://{name}")
                        file = fs.open_input_file(inner)
                    file.seek(entry["offset"])
                    whole = zlib.decompress(file.read(entry["length"]), GZIP)
                    fields, record = next(records_of(iter([whole])))
                    block = record[record.find(_BREAK) + 4 :]
                    out.append((fields.get("warc-record-id"), fields.get("warc-type"), fields.get("warc-target-uri"), fields.get("warc-refers-to"), fields.get("warc-payload-digest"), int(fields.get("x-payload-length", len(block))), block, hashlib.sha1(block).hexdigest()))
                names = ["id", "type", "uri", "refers_to", "digest", "payload_length", "block", "block_sha1"]
                kinds = [pa.string()] * 5 + [pa.int64(), pa.binary(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    schema = "id string, type string, uri string, refers_to string, digest string, payload_length long, block binary, block_sha1 string"
    return index.mapInArrow(run, schema)


def op1_warc_normalise(spark, sf_dir: str) -> DataFrame:
    """A row for each of ``pages``, read back from its record in the normalised archives; null html is an empty payload, rows that share a page_id share a record id."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    raw, clean = new_path(spark, "warc-raw"), new_path(spark, "warc")
    write_monolithic(page_records(pages), raw)
    normalise(spark, raw, clean).agg(F.sum("records")).collect()
    records = read_records(spark, clean)
    page = lambda c: F.nullif(F.regexp_extract(c, r"^<urn:page:(.*)>$", 1), F.lit("")).cast("long")
    stated = F.regexp_replace("digest", "^sha1:", "")
    return records.select(
        page(F.col("id")).alias("page_id"), F.col("payload_length").alias("payload_bytes"),
        F.when(F.col("type") == "response", F.col("block_sha1")).otherwise(stated).alias("payload_digest"),
        F.col("type").alias("record_type"), page(F.col("refers_to")).alias("refers_to"),
    )


OP1_SQL = """
with p as (
  select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), m as (
  select *, max(page_id) over (partition by payload_digest) as last_id from p
)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and page_id is distinct from last_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id is distinct from last_id then last_id end as refers_to
from m
"""
