"""SimHash near-duplicates by pivot distance tables.

A document's fingerprint has a bit set where over half of its shingles' XXH64 values do.
Equal fingerprints are one node.  Every fingerprint has a table of its Hamming distances to
reference fingerprints (pivots), kept for each block of bits by itself; a whole distance is
the sum over the blocks.  Two fingerprints that differ in at most k bits agree in at least
two of k + 2 blocks, and so agree there in all pivot distances: for every two blocks, the
distances form a bucket key, and pairs are looked for within buckets only.  Within a
bucket, pairs whose whole distance to any pivot differs by more than k are discarded (the
triangle inequality); what survives is verified by the Hamming distance itself.  No link is
lost.  Buckets of near copies are cut into units (see ``pairs``); a unit returns a spanning
forest of its links, and components are found over these.

Defined results: null and empty texts have fingerprint zero and link like any other; rows
repeated with one id and text get the same component; a component of rows without an id has
a null component_id; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogprep.llm._common import components, read_table, saved
from catalogprep.llm.pairs import forest, to_units, unit_pairs, whole_units

SHINGLE = 4
MAX_BITS = 4
PIVOTS = 16


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of the lower-cased (A-Z) words, repeats included."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined, k = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())
    return np.fromiter((digest(joined[a:b], 42) for a, b in spans), np.uint64, len(words) - k + 1)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    h = shingle_hashes(text, shingle)
    count = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 15):
        part = np.ascontiguousarray(h[i:i + (1 << 15)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash and fp (the fingerprint's 64 bits as a signed long)."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts)).view(np.int64))

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), fp("text").alias("fp"))


def _masks(blocks: int) -> list[int]:
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def pivot_tables(fp: np.ndarray, max_bits: int = MAX_BITS, pivots: int = PIVOTS) -> np.ndarray:
    """Hamming distances to the pivots, by block: (rows, blocks, pivots)."""
    refs = np.array([xxhash.xxh64_intdigest(f"pivot-{j}".encode(), 42) for j in range(pivots)], dtype=np.uint64)
    off = fp[:, None] ^ refs[None, :]
    return np.stack([np.bitwise_count(off & np.uint64(m)) for m in _masks(max_bits + 2)], axis=1)


def bucket_keys(table: np.ndarray) -> np.ndarray:
    """One key for every two blocks: the pivot distances in both, as a number."""
    n, blocks, pivots = table.shape
    odd = np.array([[xxhash.xxh64_intdigest(f"mix-{b}-{j}".encode(), 42) | 1 for j in range(pivots)] for b in range(blocks)],
                   dtype=np.uint64)
    with np.errstate(over="ignore"):
        block = (table.astype(np.uint64) * odd[None]).sum(axis=2, dtype=np.uint64)
        return np.stack([block[:, a] + block[:, b] for a, b in combinations(range(blocks), 2)], axis=1)


def _bucketed(fps: DataFrame, max_bits: int) -> DataFrame:
    n = len(list(combinations(range(max_bits + 2), 2)))

    def run(batches):
        for b in batches:
            fp = b["fp"].to_numpy().view(np.uint64)
            keys = bucket_keys(pivot_tables(fp, max_bits))
            yield pd.DataFrame({"pair": np.tile(np.arange(n, dtype=np.int32), len(fp)), "bucket": keys.view(np.int64).ravel(),
                                "fp": np.repeat(fp.view(np.int64), n)})

    return fps.select("fp").mapInPandas(run, "pair int, bucket long, fp long")


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that span the graph of all links."""
    keys = ["pair", "bucket"]

    def run(batches):
        for df, ends in whole_units(batches, keys):
            fp = df["fp"].to_numpy().view(np.uint64)
            pivot = pivot_tables(fp, max_bits).sum(axis=1, dtype=np.int16)
            found = []
            for i, j in unit_pairs(df, ends):
                near = np.abs(pivot[i] - pivot[j]).max(axis=1) <= max_bits
                i, j = i[near], j[near]
                ok = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
                found.append((i[ok], j[ok]))
            root = forest(len(fp), found)
            at = np.flatnonzero(root != np.arange(len(fp)))
            yield pd.DataFrame({"a": fp[at].view(np.int64), "b": fp[root[at]].view(np.int64)})

    return to_units(_bucketed(fps, max_bits), keys, "fp").mapInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, text_hash, fp, root (the component's smallest fingerprint), component_id for
    every row of ``docs``."""
    marked = saved(fingerprints(docs, shingle), "simhash")
    fps = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    member = components(links(fps, max_bits), "simhash-links").withColumnRenamed("node", "fp")
    rooted = fps.join(member, "fp", "left").select("fp", "first_id", F.coalesce("component", "fp").alias("root"))
    rooted = saved(rooted, "simhash-nodes")
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group: the one with the smallest id (none last), of different texts
    of that id in the group the one with the smallest hash, and of rows equal in both the
    one with the smallest hash of all columns."""
    found = near_duplicates(docs.select("doc_id", "text"), shingle, max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("__id"), F.col("text_hash").alias("__kept"))).alias("first")
    kept = found.groupBy("root").agg(first).select("first.__id", "first.__kept")  # a text has one root, so no key twice
    rows, whole = docs.withColumn("__text", F.xxhash64("text")), [F.col(f"`{c}`") for c in docs.columns]
    return (rows.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__kept")))
            .groupBy("doc_id", "__text").agg(F.min_by(F.struct(*whole), F.xxhash64(*whole)).alias("row"))
            .select("row.*"))


def query(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
