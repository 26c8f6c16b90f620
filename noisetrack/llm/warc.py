"""WARC: a deterministic sharded writer and a reader.

Records are range-sorted by page_id, digest and url into shards of equal payload bytes: running sums over a thin table of
keys and sizes, computed range by range, give the first key of each shard exactly, so shards depend on the pages alone and
not on sampling or on how the input was dealt.  A shard is a task (``repartitionById``), which streams it into gzip members,
rolls to a new file when the compressed size is reached, writes under a temporary name and renames; files carry the shard
and roll number, so a task that runs again writes the same bytes to the same names.  Shards grow with the table once there
are ``MAX_SHARDS``, so that is a bound on the list of their first keys (a few MB) that tasks get.  Once all tasks are done
the manifest (file, records, bytes, SHA-256, first and last record) is committed, also by renaming; a folder without it is
not an archive.  Headers and digests are made anew from the payload; nothing depends on the clock.

The first record of equal payloads is a response, later ones are revisits that refer to it.  Which page that is, is found
on a thin table of ids and digests, pre-aggregated before the shuffle.

Edge cases: null html is an empty payload; page_id may be of any type that has an order, text too; a row without page_id is
written with an empty page header, sorts first and revisits a row with an id if one has its payload, else it is a response;
of repeated rows with an id the first is the response and the others revisit it; equal rows (id, payload and url) are in one
shard, written as a stream; an empty table writes an empty manifest; a very large payload makes a file of its own; extra
columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noisetrack.llm.common import new_path, stored

ROLL_BYTES = 4 << 20
SHARD_BYTES, MAX_SHARDS, RECORD_BYTES = 16 << 20, 1 << 16, 600  # a record's headers
BROADCAST_ROWS = 200_000
DATE = "2024-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL name space of RFC 4122


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _lines(*pairs: tuple[str, object]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in pairs if v is not None).encode()


def _packed(page_id: object | None) -> str | None:
    """An id as a header's value: percent-encoded, so that any text is one line and reads back as it was; null has no header."""
    return None if page_id is None else quote(str(page_id), safe="", errors="surrogatepass")


def _unpacked(value: str | None) -> str | None:
    return None if value is None else unquote(value, errors="surrogatepass")


def _clean(url: str | None) -> str:
    return "".join(c for c in url or "" if c > " ") or "urn:unknown"


def record(page_id: object, url: str | None, payload: bytes, refers_to: object | None) -> bytes:
    """One gzip member with a response, or a revisit that keeps only the HTTP headers."""
    name = "" if page_id is None else page_id
    http = b"HTTP/1.1 200 OK\r\n" + _lines(("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))) + b"\r\n"
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = b"WARC/1.1\r\n" + _lines(
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{name}|{_clean(url)}|{digest(payload)}')}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _clean(url)),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
        ("WARC-Refers-To-Page", _packed(refers_to)),
        ("WARC-Page", _packed(page_id)),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    )
    return gzip.compress(head + b"\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def parse(data: bytes) -> Iterator[dict]:
    """The records of an archive, headers checked against their blocks."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data)))
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"no record begins with {line[:40]!r}")
        head = {}
        while (line := stream.readline()) != b"\r\n":
            key, _, value = line.decode().rstrip("\r\n").partition(": ")
            head[key] = value
        block = stream.read(int(head["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n" or head["WARC-Block-Digest"] != f"sha1:{digest(block)}":
            raise ValueError(f"damaged record {head['WARC-Record-ID']}")
        http, _, payload = block.partition(b"\r\n\r\n")
        revisit = head["WARC-Type"] == "revisit"
        if not revisit and head["WARC-Payload-Digest"] != f"sha1:{digest(payload)}":
            raise ValueError(f"damaged payload in {head['WARC-Record-ID']}")
        length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        yield {
            "page_id": _unpacked(head.get("WARC-Page")),
            "url": head["WARC-Target-URI"],
            "record_type": head["WARC-Type"],
            "refers_to": _unpacked(head.get("WARC-Refers-To-Page")),
            "payload_bytes": length,
            "payload_digest": head["WARC-Payload-Digest"].partition(":")[2],
            "payload": None if revisit else payload,
        }


def within_bound(df: DataFrame) -> DataFrame:
    """Broadcast up to ``BROADCAST_ROWS`` rows of keys (some 30 MB), so that payloads and files aren't shuffled for a join."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def sort_key(page_id: object, key: str, url: str) -> tuple:
    """The order of records: rows without page_id first."""
    return (page_id is not None, 0 if page_id is None else page_id, key, url)


def shard_starts(thin: DataFrame) -> list[tuple]:
    """Sort keys that begin the shards after the first, from rows (page_id, key, url, size).

    Rows are dealt to ranges, summed range by range, and a row begins a shard where the running sum passes a multiple of the
    shard's bytes."""
    spark = thin.sparkSession
    order = [F.col("page_id").asc_nulls_first(), "key", "url"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = thin.withColumn("salt", F.monotonically_increasing_id())  # rows with all keys equal may be split
    ranged = stored(salted.repartitionByRange(n, *order, "salt").withColumn("range", F.spark_partition_id()), "warc-ranges")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("range").agg(F.sum("size").alias("s"))  # a row a range
    total = sums.agg(F.sum("s")).first()[0] or 0
    shard = max(SHARD_BYTES, -(-total // MAX_SHARDS))
    sums = sums.select("range", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("start"))
    running = F.sum("size").over(Window.partitionBy("range").orderBy(*order, "salt").rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("start")
    at = ranged.join(F.broadcast(sums), "range").withColumn("end", running)
    passes = F.floor((F.col("end") - F.col("size")) / shard) < F.floor(F.col("end") / shard)
    rows = at.where(passes & (F.col("end") < total)).select("page_id", "key", "url").distinct().collect()  # a row a shard, MAX_SHARDS at most
    return sorted(sort_key(*r) for r in rows)


def write_archive(pages: DataFrame, path: str, roll_bytes: int = ROLL_BYTES, least: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC files under ``path`` and return the manifest."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    # 256 bits stand for the payload; equal ones of ``least`` bytes or more share a response.
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    thin = stored(pages.select("page_id", F.sha2(payload, 256).alias("key"), url.alias("url"), (F.octet_length(payload) + RECORD_BYTES).cast("long").alias("size")), "warc-thin")
    shared = thin.where(F.col("size") >= least + RECORD_BYTES).groupBy("key").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select("key", "first_id")
    shared = within_bound(stored(shared, "warc-shared"))
    starts = shard_starts(thin)

    @F.arrow_udf("int")
    def shard_of(page: pa.Array, key: pa.Array, url: pa.Array) -> pa.Array:
        rows = zip(page.to_pylist(), key.to_pylist(), url.to_pylist(), strict=True)
        return pa.array([bisect.bisect_right(starts, sort_key(*r)) for r in rows], pa.int32())

    rows = pages.select("page_id", url.alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("key")).join(shared, "key", "left")
    rows = rows.select(shard_of("page_id", "key", "url").alias("shard"), "page_id", "url", "payload", "key", "first_id")
    rows = rows.repartitionById(len(starts) + 1, "shard").sortWithinPartitions("shard", F.col("page_id").asc_nulls_first(), "key", "url")

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path)
        fs.create_dir(root, recursive=True)
        out: dict = {}
        done: list[dict] = []
        before: tuple | None = None

        def close() -> None:
            if out:
                out["stream"].close()
                fs.move(out["temporary"], f"{root}/{out['file']}")
                done.append({"file": out["file"], "records": out["records"], "bytes": out["bytes"], "sha256": out["sha"].hexdigest(), "first_page": out["first"], "last_page": out["last"]})
                out.clear()

        shard_now, roll = None, 0
        for batch in it:
            for row in batch.to_pylist():
                if row["shard"] != shard_now:
                    close()
                    shard_now, roll = row["shard"], 0
                elif out and out["bytes"] >= roll_bytes:
                    close()
                    roll += 1
                again = before == (row["page_id"], row["key"])
                before = (row["page_id"], row["key"])
                first = row["first_id"] if len(row["payload"]) >= least else None
                refers = first if first is not None and (row["page_id"] != first or again) else None
                data = record(row["page_id"], row["url"], row["payload"], refers)
                if not out:
                    name = f"part-{shard_now:06d}-{roll:04d}.warc.gz"
                    temporary = f"{root}/_{name}.{TaskContext.get().taskAttemptId()}.tmp"
                    out |= {"file": name, "temporary": temporary, "stream": fs.open_output_stream(temporary, compression=None), "records": 0, "bytes": 0, "sha": hashlib.sha256(), "first": str(row["page_id"])}
                out["stream"].write(data)
                out["sha"].update(data)
                out["records"] += 1
                out["bytes"] += len(data)
                out["last"] = str(row["page_id"])
        close()
        if done:
            yield pa.RecordBatch.from_pylist(done)

    manifest = rows.mapInArrow(write, "file string, records long, bytes long, sha256 string, first_page string, last_page string")
    staged = f"{path}/_manifest-{uuid.uuid4().hex}"
    manifest.write.parquet(staged)  # a row a file; its tasks are those that write the archives
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = jvm_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(jvm_path(staged), jvm_path(f"{path}/_manifest")):
        raise OSError(f"the manifest of {path} is there already")
    return spark.read.schema(manifest.schema).parquet(f"{path}/_manifest")


def read_archive(spark: SparkSession, path: str, page_type: str = "bigint") -> DataFrame:
    """The records of a committed archive, one row each, digests verified against the bytes read."""
    manifest = spark.read.schema("file string, records long, bytes long, sha256 string, first_page string, last_page string").parquet(f"{path}/_manifest")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.warc.gz").load(path)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").join(within_bound(manifest.select("file", "sha256", "records")), "file")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for row in batch.to_pylist():
                if hashlib.sha256(row["content"]).hexdigest() != row["sha256"]:
                    raise ValueError(f"{row['file']} isn't as the manifest says")
                rows, seen = [], 0
                for r in parse(row["content"]):
                    rows.append(r)
                    seen += 1
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_pylist(rows, names)
                        rows = []
                if seen != row["records"]:
                    raise ValueError(f"{row['file']} has {seen} records, not {row['records']}")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, names)

    names = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
    rows = files.mapInArrow(run, "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary")
    return rows.withColumns({"page_id": F.col("page_id").cast(page_type), "refers_to": F.col("refers_to").cast(page_type)})


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to the shared folder and read the records back."""
    path = new_path(pages.sparkSession, "warc")
    write_archive(pages, path)
    return read_archive(pages.sparkSession, path, pages.schema["page_id"].dataType.simpleString())
