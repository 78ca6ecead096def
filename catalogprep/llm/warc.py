"""WARC archives, written index first and read back by coalesced byte ranges.

Writing: every row becomes one record, a gzip member of its own, in an archive of the task
that holds the row; an archive is closed at ``ARCHIVE`` bytes.  Tasks return the index, one
row for each record (file, offset, length, url, digest and so on), which Spark's committer
writes as Parquet.  An archive's name holds a random number, so a task that is run again
writes files of its own, and only what the committed index names is ever read.

Equal payloads: digests are counted first.  Of the records with one payload of at least
``LEAST`` bytes, the one with the largest page_id is stored as a response; the others are
revisits, which name it and hold headers only.

Reading: selected rows of the index are dealt by stretches of archives and sorted by offset;
neighbouring records, up to ``GAP`` bytes apart, are read by one request of at most ``REQUEST``
bytes (or one record).  Each record is unpacked and its payload's digest compared.  A
revisit's payload is that of the response with its digest.

Archives are written and read through ``pyarrow.fs``, which knows local and shared folders,
HDFS and the object stores, below the folder named by ``spark.checkpoint.dir`` or another.

Defined results: a null payload is empty; rows without an id are never referred to while
a row with one has the same payload; rows that share the largest page_id and payload are
each a response, as a page can't revisit itself; equal rows are a record each; null urls are
written as ``urn:none:`` and read as null; extra columns are kept out; an empty table
gives no archive and an empty result.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogprep.llm._common import fresh_path, read_table, saved, small_side

LEAST = 1000
ARCHIVE = 256 << 20
STRETCH = 64 << 20
REQUEST = 8 << 20
GAP = 64 << 10
SALTS = 16
DATE = "2000-01-01T00:00:00Z"
NO_URL = "urn:none:"
INDEX = ("page_id long, url string, payload_digest string, payload_bytes long, record_type string, refers_to long, "
         "file string, offset long, length long")
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str = "response", refers_to: int | None = None) -> bytes:
    """One WARC record; a revisit holds no payload."""
    block = _HTTP + payload if kind == "response" else _HTTP
    name = "none" if page_id is None else str(page_id)
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {NO_URL if url is None else re.sub('[\r\n]', ' ', url)}", f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record; raises where it is damaged."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    if not version.startswith("WARC/") or rest[int(headers["Content-Length"]):] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return headers, rest[:int(headers["Content-Length"])].partition(b"\r\n\r\n")[2]


def _page(name: str) -> int | None:
    found = name.removeprefix("<urn:page:").removesuffix(">")
    return None if found == "none" else int(found)


class _Archives:
    """The archives of one task, written one after another."""

    def __init__(self, folder: str):
        self.fs, self.folder = pa.fs.FileSystem.from_uri(folder)
        self.out = None

    def add(self, data: bytes) -> tuple[str, int, int]:
        if self.out is None:
            self.fs.create_dir(self.folder, recursive=True)
            self.name, self.at = f"{uuid.uuid4().hex}.warc.gz", 0
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None)
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed = packer.compress(data) + packer.flush()
        self.out.write(packed)
        place = self.name, self.at, len(packed)
        self.at += len(packed)
        if self.at >= ARCHIVE:
            self.close()
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def keyed(pages: DataFrame) -> DataFrame:
    """page_id, url, html (never null), payload_digest and payload_bytes of every row."""
    html = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha1(html.cast("binary")).alias("payload_digest"),
                        F.octet_length(html).cast("long").alias("payload_bytes"))


def spread_join(rows: DataFrame, side: DataFrame, keys: list[str], name: str, most: int = 8 << 20) -> DataFrame:
    """Left join with a table of one row a key: broadcast if it is small, and else by a shuffle
    in which it stands ``SALTS`` times, so that the rows of a very common key meet it in
    many tasks."""
    side = saved(side, name)
    hinted = small_side(side, most)
    if hinted is not side:
        return rows.join(hinted, keys, "left")
    salt = F.pmod(F.xxhash64(F.lit(11), "page_id", "url"), F.lit(SALTS)).cast("int")
    side = side.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", salt).join(side, [*keys, "salt"], "left").drop("salt")


def with_types(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """``rows`` (see ``keyed``) with record_type and refers_to."""
    repeated = (rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
                .agg(F.count("*").alias("times"), F.max("page_id").alias("kept_id"))
                .where("times > 1 AND kept_id IS NOT NULL").select("payload_digest", "kept_id"))
    revisits = F.col("kept_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept_id"))
    return (spread_join(rows, repeated, ["payload_digest"], "repeated").withColumns(
        {"record_type": F.when(revisits, "revisit").otherwise("response"), "refers_to": F.when(revisits, F.col("kept_id"))}).drop("kept_id"))


def _archives(spark: SparkSession, folder: str) -> str:
    """The archives' folder with the file system that Spark would take for it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/archives")
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub("^file:/(?!/)", "file:///", uri)


def write(pages: DataFrame, folder: str, least: int = LEAST) -> None:
    """Archives of all rows of ``pages`` (page_id, url, html) below ``folder``/archives, and
    their index in ``folder``/index."""
    archives = _archives(pages.sparkSession, folder)

    def run(batches):
        out = _Archives(archives)
        for b in batches:
            heads = zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload_digest", "record_type", "refers_to")))
            places = [out.add(record(i, u, t.as_buffer().to_pybytes(), d, k, r)) for (i, u, d, k, r), t in zip(heads, b.column("html"))]
            names, offsets, lengths = zip(*places) if places else ((), (), ())
            kept = b.drop_columns(["html"]).to_pydict() | {"file": names, "offset": offsets, "length": lengths}
            yield pa.RecordBatch.from_pydict({c: pa.array(kept[c], t) for c, t in _INDEX_TYPES.items()})
        out.close()

    rows = with_types(keyed(pages), least).select("page_id", "url", "html", "payload_digest", "payload_bytes", "record_type", "refers_to")
    rows.mapInArrow(run, INDEX).write.parquet(f"{folder.rstrip('/')}/index")


_INDEX_TYPES = {c.split()[0]: pa.string() if c.endswith("string") else pa.int64() for c in INDEX.split(", ")}


def index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder.rstrip('/')}/index")


def requests(offsets: np.ndarray, lengths: np.ndarray, gap: int = GAP, most: int = REQUEST) -> list[tuple[int, int]]:
    """Bounds (first, last + 1) of the records, sorted by offset, that one request reads."""
    ends, out, first = offsets + lengths, [], 0
    for i in range(1, len(offsets) + 1):
        if i == len(offsets) or offsets[i] - ends[i - 1] > gap or ends[i] - offsets[first] > most:
            out.append((first, i))
            first = i
    return out


def _fetched(folder: str, rows: pd.DataFrame):
    """Unpacked records of index rows, in their order (by file and offset)."""
    fs, path = pa.fs.FileSystem.from_uri(folder)
    for name, part in rows.groupby("file", sort=False):
        offsets, lengths = part["offset"].to_numpy(), part["length"].to_numpy()
        with fs.open_input_file(f"{path}/{name}") as f:
            for a, b in requests(offsets, lengths):
                start = int(offsets[a])
                data = f.read_at(int(offsets[b - 1] + lengths[b - 1]) - start, start)
                for o, n in zip((offsets[a:b] - start).tolist(), lengths[a:b].tolist()):
                    yield parse(zlib.decompress(data[o:o + n], 31))


def read(selected: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_digest, stored_bytes and, if asked for, the
    stored payload of the index rows ``selected``, all from the archives.  Raises where a
    payload has not the digest that its record states."""
    archives = _archives(selected.sparkSession, folder)

    def run(batches):
        for b in batches:
            out = []
            for headers, payload in _fetched(archives, b):
                kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"a payload of {headers['WARC-Record-ID']} is damaged")
                url, refers = headers["WARC-Target-URI"], headers.get("WARC-Refers-To")
                out.append((_page(headers["WARC-Record-ID"]), None if url == NO_URL else url, kind, refers and _page(refers),
                            digest, len(payload), payload if payloads else None))
            yield pd.DataFrame(out, columns=_READ).astype({"page_id": "Int64", "refers_to": "Int64", "payload": object})

    stretch = F.floor(F.col("offset") / STRETCH)
    return (selected.select("file", "offset", "length").repartition("file", stretch).sortWithinPartitions("file", "offset")
            .mapInPandas(run, "page_id long, url string, record_type string, refers_to long, payload_digest string, "
                              "stored_bytes long, payload binary"))


_READ = ["page_id", "url", "record_type", "refers_to", "payload_digest", "stored_bytes", "payload"]


def resolved(records: DataFrame) -> DataFrame:
    """``records`` (see ``read``) with payload_bytes, the size of the whole payload: a revisit
    has that of the response with its digest."""
    cols = [c for c in records.columns if c not in ("stored_bytes", "payload")]
    revisits = records.where("record_type = 'revisit'")
    wanted = revisits.select(F.col("refers_to").alias("page_id"), "payload_digest").distinct()
    sizes = (records.where("record_type = 'response'").join(wanted, ["page_id", "payload_digest"])
             .groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("stored_bytes").alias("payload_bytes")))
    found = spread_join(revisits.select(*cols), sizes, ["refers_to", "payload_digest"], "sizes")
    stored = records.where("record_type = 'response'").select(*cols, F.col("stored_bytes").alias("payload_bytes"))
    return stored.unionByName(found.select(*cols, "payload_bytes"))


def query(spark, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "warc")
    write(read_table(spark, sf_dir, "pages"), folder)
    records = saved(read(index(spark, folder), folder, payloads=False).drop("payload"), "records")
    return resolved(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
k AS (SELECT payload_digest, max(page_id) AS kept FROM p WHERE payload_bytes >= {LEAST} GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN kept IS NOT NULL AND page_id IS DISTINCT FROM kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN kept IS NOT NULL AND page_id IS DISTINCT FROM kept THEN kept END AS refers_to
FROM p LEFT JOIN k USING (payload_digest)
"""
