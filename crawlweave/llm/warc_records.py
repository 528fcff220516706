"""Operator 12: WARC archives from a chunked record table.

``records_of`` settles each row's record: payload length and SHA-1, and whether
it is a response or revisits one.  ``chunk_table`` makes rows (record, chunk
number, data) of at most CHUNK_BYTES, so that an oversized payload is streamed
in pieces from there on.  ``write_archives`` appends the chunks to gzip members,
one a record, and carries an incremental digest from chunk to chunk that must
end in the stated one.  ``read_archives`` inflates the archives step by step and
returns a chunk table again, with the running digest and byte count on every
row; a record's last row has the digest and length of the whole payload.  No
step beyond the source table's own cell holds more of a record than a chunk.

Of the records with equal payloads of at least ``min_revisit`` bytes those with
the largest id are responses, the others are revisits of it: HTTP headers with
the full payload's length and digest, and no payload.  The largest ids come
from a map-side reduced table of slim rows; large groups are joined by
broadcast (``common.join_by_group``), so that copies never meet in one task.

An archive counts once its rows are in the folder's committed index; files of
lost or repeated tasks carry their attempt's number and are not in it.

Null payloads count as empty.  Rows repeated with the largest id and an equal
payload are all responses; rows without an id revisit the largest id, or are
responses where no copy has one.  A null URL leaves its header out; control and
other characters outside printable ASCII in a URL are percent-encoded.  An
empty table gives an index without rows.  Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlweave.llm.common import join_by_group, prepare
from crawlweave.session import ensure_local_dir, filesystem_for, scratch_dir

#: Payload bytes in a row of the chunk table.
CHUNK_BYTES = 256 << 10
#: An archive file is closed after the record that passes this many bytes.
ARCHIVE_BYTES = 256 << 20
#: Bytes of chunk rows handed to Spark at once.
YIELD_BYTES = 4 << 20
#: Longest header block of a record that is read.
HEADER_BYTES = 1 << 20
MIN_REVISIT = 1000

RESPONSE, REVISIT = "response", "revisit"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "<urn:crawlweave:"

CHUNKS = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("chunk_no", T.LongType()), T.StructField("last", T.BooleanType()),
    T.StructField("data", T.BinaryType()),
])
INDEX = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("record_id", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("payload_bytes", T.LongType()),
])
READ = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()), *CHUNKS.fields[:3],
    T.StructField("url", T.StringType()), T.StructField("chunk_no", T.LongType()),
    T.StructField("last", T.BooleanType()), T.StructField("bytes_so_far", T.LongType()),
    T.StructField("sha1_so_far", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("data", T.BinaryType()),
])


# ------------------------------------------------------------ records and chunks

def records_of(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str | None = "url",
               min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``id``, ``url``, ``payload`` (binary, null for revisits), ``payload_bytes``, ``payload_digest`` (hex),
    ``record_type`` and ``refers_to`` (an id, null for responses) of each row."""
    spark = pages.sparkSession
    payload = F.coalesce(pages[payload_col].cast("binary"), F.lit(b""))
    url = pages[url_col].cast("string") if url_col else F.lit(None).cast("string")
    rows = (pages.select(pages[id_col].alias("id"), url.alias("url"), payload.alias("payload"))
            .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
            .withColumn("digest", F.unhex(F.sha1("payload"))))
    folder = scratch_dir(spark, "warc-digests")
    rows.filter(F.col("payload_bytes") >= min_revisit).select("id", "digest").write.parquet(folder)
    slim = spark.read.parquet(folder)
    groups = (slim.groupBy("digest").agg(F.max("id").alias("largest"), F.count("*").alias("rows"))
              .filter("rows > 1 AND largest IS NOT NULL"))
    revisits = (join_by_group(slim, groups, "digest", "rows", slim.count())
                .filter(F.col("largest").isNotNull() & ~F.col("id").eqNullSafe(F.col("largest")))
                .groupBy(F.col("id").alias("__id"), F.col("digest").alias("__digest"))
                .agg(F.first("largest").alias("refers_to")))
    joined = rows.join(revisits, rows["id"].eqNullSafe(revisits["__id"])
                       & (rows["digest"] == revisits["__digest"])
                       & (rows["payload_bytes"] >= min_revisit), "left")
    revisit = F.col("refers_to").isNotNull()
    return joined.select("id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes",
                         F.lower(F.hex("digest")).alias("payload_digest"),
                         F.when(revisit, REVISIT).otherwise(RESPONSE).alias("record_type"), "refers_to")


def chunk_table(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows of CHUNKS, a record's in order one after the other; a record without payload is one empty chunk."""
    last = F.floor(F.greatest(F.coalesce(F.octet_length("payload"), F.lit(0)) - 1, F.lit(0)) / chunk_bytes)
    rows = records.select("*", last.cast("int").alias("last_no")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("last_no"))).alias("no"))
    data = F.coalesce(F.substr("payload", F.col("no") * chunk_bytes + 1, F.lit(chunk_bytes)), F.lit(b""))
    return rows.select(
        F.col("id").cast("string").alias("record_id"), "record_type",
        F.col("refers_to").cast("string").alias("refers_to"), "url", "payload_bytes", "payload_digest",
        F.col("no").cast("long").alias("chunk_no"), (F.col("no") == F.col("last_no")).alias("last"),
        data.alias("data"))


# ------------------------------------------------------------ writing

def record_urn(record_id: str | None, digest: str) -> str:
    return f"{_URN}{digest}>" if record_id is None else f"{_URN}{digest}:{quote(record_id, safe='')}>"


def urn_id(urn: str) -> str | None:
    name = urn.removeprefix(_URN).removesuffix(">")
    return unquote(name.split(":", 1)[1]) if ":" in name else None


def head_of(row: dict, date: str) -> bytes:
    """The WARC and HTTP header blocks of a record whose payload follows (or is left out)."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {row['payload_bytes']}\r\n\r\n").encode()
    revisit = row["record_type"] == REVISIT
    sha1 = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}",
             f"WARC-Record-ID: {record_urn(row['record_id'], row['payload_digest'])}", f"WARC-Date: {date}"]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + quote(row["url"], safe="".join(map(chr, range(33, 127)))))
    lines.append(f"WARC-Payload-Digest: sha1:{sha1}")
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}",
                  f"WARC-Refers-To: {record_urn(row['refers_to'], row['payload_digest'])}"]
    lines += ["Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(http) + (0 if revisit else row['payload_bytes'])}"]
    return "\r\n".join(lines).encode("ascii") + b"\r\n\r\n" + http


class _Archives:
    """The archive files of one task: records come in as chunk rows, index rows go out."""

    def __init__(self, folder: str, limit: int, date: str):
        self.fs, self.root = filesystem_for(folder)
        task = TaskContext.get()
        self.name = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        self.limit, self.date, self.number = limit, date, 0
        self.file, self.out, self.at = "", None, 0
        self.packer = self.sha1 = None
        self.begin = self.expected = self.held = 0

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, row: dict) -> tuple | None:
        """Take the next chunk; the index row when it was the record's last."""
        if row["chunk_no"] == 0:
            if self.out is None:
                self.file, self.at = f"{self.name}-{self.number:05d}.warc.gz", 0
                self.out = self.fs.open_output_stream(f"{self.root}/{self.file}", compression=None)
                self.number += 1
            self.begin, self.expected, self.held = self.at, 0, 0
            self.packer, self.sha1 = zlib.compressobj(6, zlib.DEFLATED, 31), hashlib.sha1()
            self._put(self.packer.compress(head_of(row, self.date)))
        if row["chunk_no"] != self.expected or self.packer is None:
            raise ValueError(f"record {row['record_id']}: chunk {row['chunk_no']} comes where "
                             f"{self.expected} should")
        self.expected += 1
        self.sha1.update(row["data"])
        self.held += len(row["data"])
        self._put(self.packer.compress(row["data"]))
        if not row["last"]:
            return None
        if row["record_type"] == RESPONSE and (self.held, self.sha1.hexdigest()) != (
                row["payload_bytes"], row["payload_digest"]):
            raise ValueError(f"record {row['record_id']}: chunks do not add up to the stated payload")
        self._put(self.packer.compress(b"\r\n\r\n") + self.packer.flush())
        self.packer = None
        entry = (self.file, self.begin, self.at - self.begin, row["record_id"], row["record_type"],
                 row["payload_bytes"])
        if self.at >= self.limit:
            self.close()
        return entry

    def close(self) -> None:
        if self.packer is not None:
            raise ValueError("a record's last chunk is missing")
        if self.out is not None:
            self.out.close()
            self.out = None


def write_archives(chunks: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write gzip archives below ``folder``/archives and their index (INDEX) as ``folder``/index.

    A record's chunks must follow one another in one partition, as
    ``chunk_table`` makes them.  Every task writes its own files.
    """
    spark = prepare(chunks.sparkSession)
    archives = f"{folder}/archives"
    ensure_local_dir(archives)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, out = _Archives(archives, archive_bytes, date), []
        for batch in batches:
            for i in range(batch.num_rows):
                entry = writer.add({f.name: batch.column(k)[i].as_py() for k, f in enumerate(CHUNKS)})
                if entry:
                    out.append(entry)
            if len(out) >= 10_000:
                yield _batch(out, INDEX)
        writer.close()
        if out:
            yield _batch(out, INDEX)

    chunks.select(*CHUNKS.names).mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    """The rows as a batch; the list is emptied."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    columns = zip(*rows, strict=True)
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)],
                                       schema=arrow)
    rows.clear()
    return batch


# ------------------------------------------------------------ reading

class _Member:
    """The bytes of the gzip members of a stream, inflated no further than they are asked for."""

    def __init__(self, stream, step: int):
        self.stream, self.step = stream, step
        self.raw = b""      # compressed bytes not yet taken in
        self.at = 0         # place in the file of the next byte of ``raw``
        self.text = bytearray()
        self.inflater = None

    def open(self) -> bool:
        """Go to the next member; False at the end of the file."""
        if not self.raw:
            self.raw = self.stream.read(self.step)
        self.inflater = zlib.decompressobj(31)
        self.text.clear()
        return bool(self.raw)

    def more(self) -> bool:
        """Inflate at most ``step`` bytes more; False at the member's end."""
        while not self.inflater.eof:
            if not self.raw:
                self.raw = self.stream.read(self.step)
                if not self.raw:
                    raise ValueError("the archive ends inside a member")
            had = len(self.raw)
            made = self.inflater.decompress(self.raw, self.step)
            self.raw = self.inflater.unused_data if self.inflater.eof else self.inflater.unconsumed_tail
            self.at += had - len(self.raw)
            if made:
                self.text += made
                return True
        return False

    def block(self) -> tuple[dict[str, str], int]:
        """The header block ahead by lower-case name, and its length in bytes."""
        searched = 0
        while (end := self.text.find(b"\r\n\r\n", searched)) < 0:
            searched = max(0, len(self.text) - 3)
            if len(self.text) > HEADER_BYTES or not self.more():
                raise ValueError("a header block does not end")
        lines = bytes(self.text[:end]).decode("latin-1").split("\r\n")
        del self.text[:end + 4]
        pairs = (x.split(":", 1) for x in lines[1:] if ":" in x)
        return {k.strip().lower(): v.strip() for k, v in pairs}, end + 4

    def take(self, size: int) -> bytes:
        """The next ``size`` bytes; fewer only at the member's end."""
        while len(self.text) < size and self.more():
            pass
        out = bytes(self.text[:size])
        del self.text[:size]
        return out


def archive_chunks(stream, name: str, chunk_bytes: int, with_data: bool) -> Iterator[tuple]:
    """READ rows of one archive, a chunk at a time."""
    member = _Member(stream, min(chunk_bytes, 256 << 10))
    while True:
        begin = member.at
        if not member.open():
            return
        try:
            warc, _ = member.block()
            http, size = member.block()
            left = int(warc["content-length"]) - size
            revisit = warc["warc-type"] == REVISIT
            stated = base64.b32decode(warc["warc-payload-digest"].removeprefix("sha1:")).hex()
            sha1, so_far, no = hashlib.sha1(), 0, 0
            while True:
                data = member.take(min(chunk_bytes, left))
                left -= len(data)
                so_far += len(data)
                sha1.update(data)
                last = left <= 0
                if not data and not last:
                    raise ValueError("the record ends before its stated length")
                whole = (int(http["content-length"]) if revisit else so_far) if last else None
                digest = (stated if revisit else sha1.hexdigest()) if last else None
                if last and not revisit and digest != stated:
                    raise ValueError("the payload's digest is not the stated one")
                refers = urn_id(warc["warc-refers-to"]) if revisit else None
                yield (name, begin, urn_id(warc["warc-record-id"]), warc["warc-type"], refers,
                       warc.get("warc-target-uri"), no, last, so_far, sha1.hexdigest(), whole, digest,
                       data if with_data else None)
                no += 1
                if last:
                    break
            if member.take(5) != b"\r\n\r\n":
                raise ValueError("the record does not end where it says")
        except (ValueError, KeyError, zlib.error) as e:
            raise ValueError(f"{name}, member at {begin}: {e}") from e


def read_archives(spark: SparkSession, folder: str, chunk_bytes: int = CHUNK_BYTES,
                  with_data: bool = True) -> DataFrame:
    """The records of the committed archives as READ rows; ``payload_bytes`` and ``payload_digest`` are on
    a record's last row.  One task reads an archive at most a chunk at a time; a damaged archive is an error."""
    prepare(spark)
    index = spark.read.parquet(f"{folder}/index")
    files = index.select("file").distinct()
    archives = f"{folder}/archives"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem_for(archives)
        out, held = [], 0
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with fs.open_input_stream(f"{root}/{name}", compression=None, buffer_size=1 << 20) as stream:
                    for row in archive_chunks(stream, name, chunk_bytes, with_data):
                        out.append(row)
                        held += len(row[-1] or b"")
                        if held >= YIELD_BYTES or len(out) >= 1000:
                            yield _batch(out, READ)
                            held = 0
        if out:
            yield _batch(out, READ)

    # as many tasks as files: the rows are slim, what is behind them is not
    return files.repartition(max(1, files.count())).mapInArrow(run, READ)


def round_trip(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str | None = "url",
               min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write ``pages`` to archives in the scratch folder and list the records read back: ``id_col``,
    ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``file`` and ``offset``."""
    spark = pages.sparkSession
    folder = scratch_dir(spark, "warc")
    write_archives(chunk_table(records_of(pages, id_col, payload_col, url_col, min_revisit)), folder)
    kind = pages.schema[id_col].dataType
    return (read_archives(spark, folder, with_data=False).filter("last")
            .select(F.col("record_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type",
                    F.col("refers_to").cast(kind).alias("refers_to"), "file", "offset"))
