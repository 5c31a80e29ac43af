"""WARC archives: a deterministic sharded writer and a reader.

Records are dealt to shards by ranges of their keys, cut so that shards hold about the same number of bytes, and sorted within them. A task
writes one gzip member per record and starts a new file when the compressed size reaches the limit. Files are written under temporary names;
the rows of the attempts that succeeded become the manifest, whose files are renamed, and the manifest is written last: a folder
without one holds no archive. Headers and digests follow from the payloads, so the same records give the same bytes.
"""

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phenolith.session import write_once

ROLL_BYTES = 32 << 20  # a file is closed once its compressed size reaches this
SHARD_BYTES = 64 << 20  # payload bytes that a shard aims at
FILES_PER_TASK = 2  # read by one task, one after another
RANGES = 1 << 16  # key ranges that are counted to cut shards; their counts are all the driver sees
MAX_TASKS = 50_000
_DIGITS = 15  # hex digits of a digest that cut the records of one key
DATE = "2020-01-01T00:00:00Z"  # of every record, so that the bytes don't depend on the clock

_MANIFEST = "shard bigint, file string, temporary string, records bigint, bytes bigint, sha256 string"


def qualified(spark: SparkSession, folder: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _files(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a qualified folder, in a task, and the folder's path there."""
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return pafs.FileSystem.from_uri(folder)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(name: str, value) -> bytes:
    return f"{name}: {re.sub(r'[\r\n]', ' ', str(value))}\r\n".encode()


def record(key, url: str | None, payload: bytes, refers_to) -> bytes:
    """One WARC record, uncompressed: a response, or a revisit of ``refers_to`` whose payload is left out."""
    sha, head = digest(payload), b"HTTP/1.1 200 OK\r\n" + _line("Content-Type", "text/html; charset=utf-8") + _line("Content-Length", len(payload)) + b"\r\n"
    revisit = refers_to is not None
    block = head if revisit else head + payload
    lines = [b"WARC/1.1\r\n", _line("WARC-Type", "revisit" if revisit else "response"), _line("WARC-Record-ID", f"<urn:page:{'' if key is None else key}>"), _line("WARC-Date", DATE)]
    if url is not None:
        lines.append(_line("WARC-Target-URI", url))
    if revisit:
        lines += [_line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), _line("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    lines += [
        _line("Content-Type", "application/http; msgtype=response"), _line("WARC-Payload-Digest", "sha1:" + sha),
        _line("WARC-Block-Digest", "sha1:" + digest(block)), _line("Content-Length", len(block)), b"\r\n"]
    return b"".join(lines) + block + b"\r\n\r\n"


def _writer(folder: str, roll: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(folder)
        files.create_dir(f"{root}/_temporary", recursive=True)
        out = shard = None
        number, note = 0, (None, None, None)

        def start(of):
            nonlocal out, shard, number
            number = number + 1 if of == shard else 0
            shard, name = of, f"part-{of:07d}-{number:05d}.warc.gz"
            temporary = f"_temporary/{name}.{uuid.uuid4().hex}"
            out = {"shard": of, "file": name, "temporary": temporary, "records": 0, "bytes": 0, "sha": hashlib.sha256(), "to": files.open_output_stream(f"{root}/{temporary}", compression=None)}

        def finish() -> pa.RecordBatch:
            nonlocal out
            out["to"].close()
            row, out = [out["shard"], out["file"], out["temporary"], out["records"], out["bytes"], out["sha"].hexdigest()], None
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=["shard", "file", "temporary", "records", "bytes", "sha256"])

        for batch in batches:
            columns = [batch.column(c) for c in ("shard", "key", "sha", "url", "payload", "refers_to", "page")]
            for i in range(len(batch)):
                of, key, sha, url, payload, refers, page = (c[i].as_py() for c in columns)
                if not page:  # stands before the pages it is about
                    note = key, sha, refers
                    continue
                refers = note[2] if note[:2] == (key, sha) else None
                if out is not None and (of != out["shard"] or out["bytes"] >= roll):
                    yield finish()
                if out is None:
                    start(of)
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                data = packer.compress(record(key, url, payload or b"", refers)) + packer.flush()
                out["to"].write(data)
                out["sha"].update(data)
                out["records"] += 1
                out["bytes"] += len(data)
        if out is not None:
            yield finish()

    return run


def _renamer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(folder)
        for batch in batches:
            for row in batch.select(["file", "temporary"]).to_pylist():
                target, source = f"{root}/{row['file']}", f"{root}/{row['temporary']}"
                if files.get_file_info(source).type != pafs.FileType.NotFound:  # else an earlier attempt has renamed it
                    files.move(source, target)
                if files.get_file_info(target).type != pafs.FileType.File:
                    raise FileNotFoundError(target)
            yield batch

    return run


def _cells(df: DataFrame, place: Column, by: list[str]) -> list:
    """Bytes and key bounds of each cell, in order; a cell's rows share ``by`` and the ``place`` in it."""
    cells = df.groupBy(*by, place.alias("place")).agg(
        F.sum(F.col("n") + 512).alias("bytes"), F.min("key").alias("lo"), F.max("key").alias("hi"), F.min("sha").alias("first"), F.max("sha").alias("last"))
    return sorted(cells.collect(), key=lambda r: [r[c] for c in (*by, "place")])


def _shards(df: DataFrame, shard_bytes: int) -> tuple[DataFrame, int]:
    """``df`` with ``shard``, consecutive ranges of key and payload digest of about ``shard_bytes``, and how many there are. Null keys come first, in shard 0.

    Keys are counted in ranges of one width; a range that holds more than a shard is counted again within its own smallest and largest key, and a key that
    holds more by its digests, until no cell does or all its records are equal. What comes to the driver grows with the number of shards.
    """
    ends = df.agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.sum(F.col("n") + 512).alias("bytes")).first()
    if ends["lo"] is None:
        return df.withColumn("shard", F.lit(0).cast("bigint")), 1
    width = max(1, -(-(ends["hi"] - ends["lo"] + 1) // RANGES))
    placed = df.withColumn("p0", F.coalesce(F.floor((F.col("key") - F.lit(ends["lo"])) / width), F.lit(0)))
    # Cells by path: (path, bytes); a heavy cell is replaced by those it is cut into, which are sorted right where it was.
    done: dict[tuple, int] = {}
    open_ = [((r["place"],), r) for r in _cells(placed, F.col("p0"), [])]
    by, depth = ["p0"], 0
    while True:
        heavy = [(path, r) for path, r in open_ if r["bytes"] > shard_bytes and (r["lo"], r["first"]) != (r["hi"], r["last"]) and r["lo"] is not None]
        cut = {path for path, _ in heavy}
        done |= {path: r["bytes"] for path, r in open_ if path not in cut}
        if not heavy:
            break
        depth += 1
        rows = []
        for path, r in heavy:
            parts = 4 * -(-r["bytes"] // shard_bytes)
            single = r["lo"] == r["hi"]
            lo, hi = (int(r["first"][:_DIGITS], 16), int(r["last"][:_DIGITS], 16)) if single else (r["lo"], r["hi"])
            if single and lo == hi:  # digests that begin alike: as good as equal
                done[path] = r["bytes"]
                continue
            rows.append((*path, single, lo, max(1, -(-(hi - lo + 1) // parts))))
        if not rows:
            break
        names = [*by, "_single", "_lo", "_width"]
        table = df.sparkSession.createDataFrame(rows, ", ".join(f"{c} {'boolean' if c == '_single' else 'bigint'}" for c in names))
        value = F.when(F.col("_single"), F.conv(F.substring("sha", 1, _DIGITS), 16, 10).cast("bigint")).otherwise(F.col("key"))
        joined = placed.join(F.broadcast(table), by, "left")  # a row per heavy cell, fewer than there are shards
        # A null key has its cell's first place.
        placed = joined.withColumn(f"p{depth}", F.coalesce(F.floor((value - F.col("_lo")) / F.col("_width")), F.lit(0))).withColumn("_cut", F.col("_lo").isNotNull())
        cells = _cells(placed.where("_cut"), F.col(f"p{depth}"), by)
        placed = placed.drop("_single", "_lo", "_width", "_cut")
        open_ = [((*[r[c] for c in by], r["place"]), r) for r in cells]
        by = [*by, f"p{depth}"]
    order = sorted(done)
    sizes = [done[path] for path in order]
    starts = np.cumsum(sizes) - sizes
    full = lambda path: (*path, *[0] * (len(by) - len(path)))
    rows = [(*map(int, full(path)), int(t // shard_bytes)) for path, t in zip(order, starts, strict=True)]
    number = {s: i for i, s in enumerate(sorted({r[-1] for r in rows}))}  # a heavy cell may have left numbers out
    table = df.sparkSession.createDataFrame([(*r[:-1], number[r[-1]]) for r in rows], ", ".join(f"{c} bigint" for c in by) + ", shard bigint")
    return placed.join(F.broadcast(table), by).drop(*by), len(number)  # a row per cell: RANGES and four a shard at most


def write_archive(df: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0,
                  roll: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES, level: int = 6) -> DataFrame:
    """Write a record per row of ``df`` below ``folder`` and return the manifest (one row per file).

    Of the records with equal payloads of at least ``least`` bytes the one with the smallest key is a response, the others
    revisit it. ``key`` is a whole number. Null payloads are empty, null addresses leave their header out. Rows of one key
    with the same payload are copies of one record: all of them are responses if no smaller key has the payload. Null keys are responses. Ties in the order of keys go by
    payload digest and address. An empty table gives an archive without files; other columns are left out.
    """
    spark = df.sparkSession
    folder = qualified(spark, folder)
    data = F.coalesce(F.encode(F.col(f"`{payload}`").cast("string"), "UTF-8"), F.lit(b""))
    rows = df.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), data.alias("payload"))
    rows = rows.withColumns({"n": F.octet_length("payload").cast("bigint"), "sha": F.sha1("payload")})
    narrow = rows.where((F.col("n") >= least) & F.col("key").isNotNull()).select("sha", "key")
    groups = narrow.groupBy("sha").agg(F.min("key").alias("refers_to"), F.max("key").alias("last")).where("refers_to < last").drop("last")
    again = narrow.join(groups, "sha").where("key > refers_to").distinct()
    # What a page revisits travels as a note that is sorted right before it, so that pages are shuffled once and for the order only.
    notes = again.select("key", "sha", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), F.lit(0).cast("bigint").alias("n"), "refers_to", F.lit(False).alias("page"))
    pages = rows.select("key", "sha", "url", "payload", "n", F.lit(None).cast("bigint").alias("refers_to"), F.lit(True).alias("page"))
    placed, shards = _shards(pages.unionByName(notes), shard_bytes)
    # One partition per shard, in their order; beyond MAX_TASKS of them, as many shards in a row to each.
    tasks = min(shards, MAX_TASKS)
    sorted_ = placed.repartitionById(tasks, F.expr(f"int(shard * {tasks} div {shards})")).sortWithinPartitions("shard", "key", "sha", "page", "url").select("shard", "key", "sha", "url", "payload", "refers_to", "page")
    written = write_once(sorted_.mapInArrow(_writer(folder, roll, level), _MANIFEST), "archive-files")
    manifest = written.mapInArrow(_renamer(folder), _MANIFEST).drop("temporary")
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_temporary")
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)  # what failed attempts have left
    return spark.read.parquet(f"{folder}/manifest")


def parse_records(stream) -> Iterator[tuple[dict, bytes]]:
    """Headers (lower-case names) and block of each record of an uncompressed stream."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record has no end")
        yield headers, block


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The records of a committed archive: ``key``, ``url``, ``record_type``, ``refers_to``, ``payload`` (null for revisits), ``payload_bytes``, ``payload_digest``.

    Digests of blocks and payloads are computed again and compared. The files are read where they are, one after another in each task.
    """
    folder = qualified(spark, folder)

    def page(value: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
        return int(found[1]) if found else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(folder)
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
        names = ["key", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest"]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        for name in (n for batch in batches for n in batch.column("file").to_pylist()):
            rows, size = [], 0
            with files.open_input_stream(f"{root}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                for headers, block in parse_records(stream):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    length = int(re.search(rb"(?i)content-length: (\d+)", head)[1])
                    sha, response = headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"] == "response"
                    if headers["warc-block-digest"] != "sha1:" + digest(block) or response and (sha != digest(payload) or length != len(payload)):
                        raise ValueError(f"{name}: a digest differs")
                    rows.append((page(headers["warc-record-id"]), headers.get("warc-target-uri"), headers["warc-type"], page(headers.get("warc-refers-to")), payload if response else None, length, sha))
                    size += len(block)
                    if size > 1 << 20:
                        yield pack(rows)
                        rows, size = [], 0
            if rows:
                yield pack(rows)

    manifest = spark.read.parquet(f"{folder}/manifest").select("file")
    tasks = max(1, -(-manifest.count() // FILES_PER_TASK))
    return manifest.repartition(tasks).mapInArrow(
        run, "key bigint, url string, record_type string, refers_to bigint, payload binary, payload_bytes bigint, payload_digest string")
