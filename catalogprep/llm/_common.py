"""Helpers shared by the corpus operators."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogprep.session import checkpoint_dir

#: Words between ASCII white space, and lower-case letters, digits and non-ASCII, as patterns.
SPACED = r"[^\x20\x09-\x0D]+"
LETTERED = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SPACED_RE_B = re.compile(SPACED.encode())

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TO_LOWER = {ord(c): c.lower() for c in _UPPER}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, everything else unchanged."""
    return F.translate(c, _UPPER, _UPPER.lower())


def py_ascii_lower(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_TO_LOWER)


def text_of(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def words(c: Column, pattern: str = SPACED) -> Column:
    """All words of a text, in order, as an array."""
    return F.regexp_extract_all(c, F.lit(pattern), 0)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/catalogprep-llm/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage is cut,
    a lost executor costs nothing, and Spark knows the table's size."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_bytes: int = 8 << 20) -> DataFrame:
    """``df`` with a broadcast hint if its values take at most ``max_bytes`` (a job
    sums their lengths), else as it is, for a sort-merge join.  Give a saved table of
    numbers, strings and binaries."""
    width = F.lit(8 * len(df.columns))
    for f in df.schema.fields:
        if f.dataType.simpleString().startswith(("array", "map", "struct")):
            raise ValueError(f"the size of {f.name} is not known")
        if f.dataType.simpleString() in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
    size = df.agg(F.sum(width.cast("bigint"))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


def salted_join(rows: DataFrame, side: DataFrame, keys: list[str], times: str, salt_by: list[str], cap: int = 4096) -> DataFrame:
    """Inner join of ``rows`` with ``side``, a saved table of one row a key whose column ``times``
    (which goes) says how many of ``rows`` have it.  Keys of more than ``cap`` rows, of which there are at
    most a ``cap``-th as many as rows, are dealt over a salt, so that none is one task's work."""
    n = F.ceil(F.col(times) / cap).cast("int")
    hot = saved(side.where(F.col(times) > cap).select(*keys, n.alias("__salts")), "hot-keys")
    salt = F.pmod(F.xxhash64(F.lit(17), *salt_by), F.coalesce("__salts", F.lit(1))).cast("int")
    dealt = rows.join(small_side(hot), keys, "left").withColumn("__salt", salt).drop("__salts")
    salted = side.withColumn("__salt", F.explode(F.sequence(F.lit(0), n - 1))).drop(times)
    return dealt.join(salted, [*keys, "__salt"]).drop("__salt")


def hash_sample(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """About ``n`` rows (never more): those with the smallest hash of ``keys``.  Rows whose
    hash lies well above the n-th smallest are left out before the ordering, so tasks
    send few rows however many there are."""
    rows = df.count()
    h = F.xxhash64(F.lit(3), *keys)
    if rows > 8 * n:
        df = df.where(h < F.lit(int(-(1 << 63) + (1 << 64) * 8 * n / rows)).cast("bigint"))
    return df.orderBy(h, *keys).limit(n)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges`` (a, b: long) as (node, component), for nodes
    that have an edge; component is the smallest node.

    Large-star and small-star steps: every node links its larger neighbours, then its
    smaller ones, to the smallest of them, until nothing changes (a few rounds, as the
    callers give nearly star-shaped edges).  All of it is joins and minima with partial
    aggregation, so a node with very many neighbours needs no group in one task."""
    spark = edges.sparkSession
    now = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)

    def mark(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b") % 1000003)).first())

    seen = mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # large star: each larger neighbour of n goes to n's smallest
        large = (now.join(low, now.b == low.n).select(F.col("a"), F.col("m").alias("b")).where("a <> b").distinct())
        # small star: n and its smaller neighbours go to the smallest
        low2 = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = (large.join(low2, large.a == low2.n)
                 .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                           F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.*").where("a <> b").distinct())
        now = saved(small, name)
        last, seen = seen, mark(now)
        if seen == last:
            break
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
