"""Embedding near-duplicates by Euclidean p-stable hashing.

Vectors are normalised; a table projects them on k random Gaussian directions, adds random
offsets and quantises by a width, and the k numbers form the bucket.  Every vector is put
in L tables.  k follows the number of vectors, so that chance buckets stay about as large
at any size, and L follows k, so that a pair exactly at the threshold meets in some table
with the wanted recall (closer pairs with more).  Pairs that meet are checked by exact
cosine in double precision, so no link lies below the threshold; a pair counts in the first
table in which it meets.

Equal vectors are one node with a count.  Buckets of near copies are cut into units (see
``pairs``); a unit returns its members' link counts and a spanning forest of the links.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components
link with nothing and are components of their own; vectors of different lengths never
link; rows repeated with one id count as vectors; an empty table gives an empty result;
vectors without an id are counted as partners, and a component of them alone has no id.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogprep.llm._common import components, read_table, saved
from catalogprep.llm.pairs import forest, to_units, unit_pairs, whole_units

THRESHOLD = 0.9
WIDTH = 2.0
RECALL = 0.98
CHANCE_BUCKET = 64
LEAST_PROJECTIONS = 10
SEED = 20240229


def collision(distance: float, width: float) -> float:
    """Probability that two vectors at this distance share one quantised projection."""
    if distance <= 0:
        return 1.0
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan_tables(n: int, threshold: float = THRESHOLD, width: float = WIDTH, recall: float = RECALL) -> tuple[int, int]:
    """Projections per table and number of tables for n vectors."""
    far, near = collision(math.sqrt(2), width), collision(math.sqrt(2 - 2 * threshold), width)
    k = max(LEAST_PROJECTIONS, math.ceil(math.log(max(n, 2) / CHANCE_BUCKET) / -math.log(far)))
    return k, math.ceil(math.log(1 - recall) / math.log(1 - near ** k))


def usable(c: str) -> Column:
    """A vector that can link: not null, finite throughout, not zero."""
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.size(c) > 0, F.lit(False)) & F.coalesce(fine, F.lit(False)) & F.exists(c, lambda x: x != 0)


def _unit_rows(vectors: pd.Series) -> np.ndarray:
    m = np.array(vectors.tolist(), dtype=np.float64)
    m /= np.abs(m).max(axis=1, keepdims=True)  # no overflow in the squares
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _hashed(reps: DataFrame, k: int, tables: int, width: float, seed: int) -> DataFrame:
    def run(batches):
        planes: dict[int, tuple] = {}
        odd = np.random.default_rng(seed).integers(0, 1 << 62, (tables, k), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for b in batches:
            dims = b["v"].map(len)
            for dim, part in b.groupby(dims):
                if dim not in planes:
                    rng = np.random.default_rng([seed, dim])
                    planes[dim] = rng.standard_normal((dim, tables * k)), rng.uniform(0, width, tables * k)
                a, off = planes[dim]
                q = np.floor((_unit_rows(part["v"]) @ a + off) / width).astype(np.int64).view(np.uint64)
                with np.errstate(over="ignore"):
                    h = (q.reshape(-1, tables, k) * odd[None]).sum(axis=2, dtype=np.uint64) ^ np.uint64(dim)
                h = h.view(np.int64)
                for t in range(tables):
                    yield pd.DataFrame({"tbl": np.full(len(part), t, np.int32), "bucket": h[:, t], "rep": part["rep"].to_numpy(),
                                        "n": part["n"].to_numpy(), "v": part["v"].to_numpy(), "earlier": list(h[:, :t])})

    kind = reps.schema["v"].dataType.simpleString()
    return reps.mapInPandas(run, f"tbl int, bucket long, rep long, n long, v {kind}, earlier array<long>")


def _linked(hashed: DataFrame, threshold: float) -> DataFrame:
    """(rep, other, links): links of a node found in a unit, and a node that it reaches there."""
    keys = ["tbl", "bucket"]

    def run(batches):
        for df, ends in whole_units(batches, keys):
            rep, n, found = df["rep"].to_numpy(), df["n"].to_numpy(), []
            size = df["v"].map(len).to_numpy()
            links = np.zeros(len(df), dtype=np.int64)
            unit = np.zeros((len(df), int(size.max())))
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                unit[at, :dim] = _unit_rows(df["v"].iloc[at])
            earlier = df["earlier"].tolist()
            for i, j in unit_pairs(df, ends):
                ok = (np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold) & (size[i] == size[j])
                i, j = i[ok], j[ok]
                found.append((i, j))
                if not len(i):
                    continue
                # rows of one unit are of one table, so their lists are equally long
                first = np.fromiter((not np.any(earlier[x] == earlier[y]) for x, y in zip(i, j)), bool, len(i))
                np.add.at(links, i[first], n[j[first]])
                np.add.at(links, j[first], n[i[first]])
            root = forest(len(df), found)
            at = np.flatnonzero((links > 0) | (root != np.arange(len(df))))
            yield pd.DataFrame({"rep": rep[at], "other": rep[root[at]], "links": links[at]})

    return to_units(hashed, keys, "rep").mapInPandas(run, "rep long, other long, links long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, width: float = WIDTH, recall: float = RECALL, seed: int = SEED) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.when(usable(vector_col), F.col(vector_col)).alias("v"))
    some = rows.where("v is not null")
    # a node is a distinct vector; its number is fixed by the written table
    reps = saved(some.groupBy("v").agg(F.count("*").alias("n"), F.min("vec_id").alias("low"))
                 .withColumn("rep", F.monotonically_increasing_id()), "vectors")
    k, tables = plan_tables(reps.count(), threshold, width, recall)
    found = saved(_linked(_hashed(reps.select("rep", "n", "v"), k, tables, width, seed), threshold), "vector-links")
    degree = found.groupBy("rep").agg(F.sum("links").alias("links"))
    member = components(found.select(F.col("rep").alias("a"), F.col("other").alias("b")), "vector-links")
    rooted = saved(reps.join(degree, "rep", "left").join(member.withColumnRenamed("node", "rep"), "rep", "left")
                   .select("v", "low", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                           F.coalesce("component", "rep").alias("root")), "vector-nodes")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("v", "n_links", "component_id")
    linked = some.join(named, "v").select("vec_id", "n_links", "component_id")
    alone = rows.where("v is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"),
                                           F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


#: All pairs, and the closure of the links.
ORACLE = f"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS u, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT u, vec_id, e, len(e) AS n, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.u AS a, b.u AS b FROM ok a JOIN ok b ON a.u <> b.u AND a.n = b.n
  WHERE list_dot_product(a.e, b.e) / a.norm / b.norm >= {THRESHOLD}),
r AS (SELECT u AS a, u AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT r.a AS u, min(v.vec_id) AS component_id FROM r JOIN v ON v.u = r.b GROUP BY 1),
k AS (SELECT a AS u, count(*) AS n FROM l GROUP BY 1)
SELECT vec_id, coalesce(k.n, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM v JOIN c USING (u) LEFT JOIN k USING (u)
"""
