"""Exact top-k by inner product: M-tree pages, best-first search.

Components are quantised to integers, floor(256 * x).  Vectors get one more coordinate,
sqrt(M^2 - |x|^2) with M the longest length, so that the Euclidean distance to a query
(with 0 there) orders them exactly as the inner product does, and a metric tree applies.

The tree is spread over the cluster.  A bounded sample gives routing objects; every vector
goes to its nearest one, and a routing object's vectors are dealt to pages of bounded size
(so one very common vector fills many pages, not one).  A page is a metric node: it stores
its own routing vector, the covering radius, and each entry's distance to the routing
vector (its parent).  Routing objects are put in a chain of neighbours, and consecutive pages
along it form a branch, which is a node over pages in the same way, with a centre and a radius.

1. Every query searches the branch of its nearest routing object, best-first: pages in the order of
   their least possible distance, stopping when that exceeds the k-th best so far; entries
   whose stored parent distance already puts them beyond it are not computed.
2. The k-th score found is carried over: branches whose centre and radius put all they hold
   beyond it are ruled out; the query searches the others in the same way.

A branch is repeated only for every ``QUERIES_PER_BLOCK`` queries that search it, so the work is that
of the pairs of queries and branches that are left.  Scores are exact integers; bounds have a
slack well above rounding.  The k best of each branch are merged.

Defined results: vectors that are null or hold null or non-finite components take no part,
as queries or candidates; queries meet candidates of their own length only; a query's own
row (same id) is no candidate, and neither is a row without an id; rows repeated with one id
are candidates each, and a query id that is repeated is searched once, with the smallest of
its vectors; ties go to the smaller vec_id; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalogprep.llm._common import hash_sample, read_table, saved, small_side

K = 5
SCALE = 256
PAGE = 512
PAGES_PER_BRANCH = 32
QUERIES_PER_BLOCK = 1024
#: Routing objects: the square root of the number of vectors, within these bounds.
ROUTES = (256, 2048)
#: Balls that one task compares with as many queries, some queries at a time.
BRANCHES_PER_BLOCK = 4096
AT_ONCE = 512
SLACK = 1e-6


def quantised(c: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null if the vector can't take part."""
    whole = F.transform(F.col(c), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(F.coalesce(F.size(c) > 0, F.lit(False)) & F.coalesce(fine, F.lit(False)), whole)


def _matrix(rows) -> np.ndarray:
    return np.array([np.asarray(r) for r in rows], dtype=np.int64)


def _lifted(q: np.ndarray, longest2: float) -> np.ndarray:
    x = q.astype(np.float64)
    return np.c_[x, np.sqrt(np.maximum(0.0, longest2 - (x * x).sum(axis=1)))]


def reach_of(score, q2: float, longest2: float):
    """Distance of an entry with this score; infinite for none."""
    return np.sqrt(np.maximum(0.0, q2 + longest2 - 2.0 * score)) * (1 + SLACK) + SLACK


class Page:
    """A leaf node: entries around a routing vector."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, longest2: float):
        order = np.argsort(ids, kind="stable")
        self.ids, self.q = ids[order], q[order]
        x = _lifted(self.q, longest2)
        self.route = x.mean(axis=0)
        self.parent = np.sqrt(((x - self.route) ** 2).sum(axis=1))
        self.radius = float(self.parent.max())


class Branch:
    """A node over pages; search() is best-first over its pages."""

    def __init__(self, pages: list[Page], longest2: float):
        self.pages, self.longest2 = pages, longest2
        routes = np.array([p.route for p in pages])
        self.route = routes.mean(axis=0)
        self.parent = np.sqrt(((routes - self.route) ** 2).sum(axis=1))
        self.routes, self.radii = routes, np.array([p.radius for p in pages])

    def search(self, query: np.ndarray, own: int, k: int, best: list, least_score: float = -np.inf) -> list:
        """The k best (score, -id) of ``best`` and this branch's entries, of those with at least
        ``least_score``; a heap."""
        q = np.r_[query.astype(np.float64), 0.0]
        q2 = float(q @ q)

        def reach() -> float:
            # distance of the k-th best; an entry beyond it can't enter, not even by a tie
            return reach_of(max(least_score, best[0][0] if len(best) >= k else -np.inf), q2, self.longest2)

        to_parent = float(np.sqrt(((q - self.route) ** 2).sum()))
        near = np.abs(to_parent - self.parent) - self.radii <= reach()  # without their distances
        at = np.flatnonzero(near)
        dist = np.sqrt(((self.routes[at] - q) ** 2).sum(axis=1))
        queue = list(zip((dist - self.radii[at]).tolist(), at.tolist(), dist.tolist()))
        heapq.heapify(queue)
        while queue:
            nearest, i, to_route = heapq.heappop(queue)
            if nearest > reach():
                break
            page = self.pages[i]
            entry = np.flatnonzero(np.abs(to_route - page.parent) <= reach())
            if not len(entry):
                continue
            score = page.q[entry] @ query
            if len(best) >= k:
                hit = score >= best[0][0]
                entry, score = entry[hit], score[hit]
            if len(entry) > 4 * k:  # entries are in id order, so a stable sort keeps ties right; + 1 for the own row
                top = np.argsort(-score, kind="stable")[:_enough(page.ids[entry], own, k)]
                entry, score = entry[top], score[top]
            for s, v in zip(score.tolist(), page.ids[entry].tolist()):
                if v == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (s, -v))
                elif (s, -v) > best[0]:
                    heapq.heapreplace(best, (s, -v))
        return best


def _enough(ids: np.ndarray, own: int, k: int) -> int:
    return k + int((ids == own).sum())


def chained(routes: np.ndarray) -> np.ndarray:
    """Place of each routing object in a chain that goes on to the nearest one not yet in it."""
    size = (routes ** 2).sum(axis=1)
    off = size[:, None] + size[None, :] - 2.0 * (routes @ routes.T)
    place, at = np.full(len(routes), -1), 0
    for i in range(len(routes)):
        place[at] = i
        left = np.flatnonzero(place < 0)
        if len(left):
            at = left[np.argmin(off[at, left])]
    return place


def _with_route(rows: DataFrame, by_dim: dict[int, np.ndarray], longest2: float, lift: bool) -> DataFrame:
    """``rows`` (vec_id, dim, q) with the place of their nearest routing object in the chain."""
    def nearest(batches):
        for b in batches:
            route = np.zeros(len(b), dtype=np.int32)
            for d in b["dim"].unique():
                at = np.flatnonzero(b["dim"].to_numpy() == d)
                if d in by_dim:
                    q = _matrix(b["q"].iloc[at])
                    x, r = _lifted(q, longest2) if lift else np.c_[q.astype(np.float64), np.zeros(len(q))], by_dim[d]
                    route[at] = np.argmin((r * r).sum(axis=1)[None, :] - 2.0 * (x @ r.T), axis=1)
            yield b.assign(route=route)

    return rows.select("vec_id", "dim", "q").mapInPandas(nearest, "vec_id long, dim int, q array<long>, route int")


def _blocked(asked: DataFrame, placed: DataFrame, per_block: int) -> tuple[DataFrame, DataFrame]:
    """Queries (with dim, branch) dealt to blocks of about ``per_block`` for each branch, and the
    branches that they search, repeated for each of their blocks."""
    where = ["dim", "branch"]
    need = saved(asked.groupBy(*where).agg(F.ceil(F.count("*") / per_block).cast("int").alias("blocks")), "blocks")
    mine = asked.join(small_side(need), where).withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(9)), "blocks").cast("int")).drop("blocks")
    held = placed.join(small_side(need), where).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    return mine, held


def _search(asked: DataFrame, placed: DataFrame, longest2: float, k: int, per_block: int) -> DataFrame:
    """query_id, vec_id, score: the k best of each pair of query and branch in ``asked``."""
    def search(cand: pd.DataFrame, mine: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(mine) and len(cand):
            tree = Branch([Page(p["vec_id"].to_numpy(), _matrix(p["q"]), longest2) for _, p in cand.groupby(["route", "page"])], longest2)
            for own, q, least in zip(mine["vec_id"].tolist(), _matrix(mine["q"]), mine["least"].tolist()):
                out += [(own, -v, s) for s, v in tree.search(q, own, k, [], least)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    mine, held = _blocked(asked, placed, per_block)
    keys = ["dim", "branch", "block"]
    return (held.groupBy(*keys).cogroup(mine.groupBy(*keys))
            .applyInPandas(search, "query_id long, vec_id long, score long"))


def branch_balls(placed: DataFrame, longest2: float) -> DataFrame:
    """dim, branch, centre, radius: a ball around all that a branch holds."""
    def ball(part: pd.DataFrame) -> pd.DataFrame:
        x = _lifted(_matrix(part["q"]), longest2)
        centre = x.mean(axis=0)
        radius = float(np.sqrt(((x - centre) ** 2).sum(axis=1)).max())
        return pd.DataFrame({"dim": [part["dim"].iloc[0]], "branch": [part["branch"].iloc[0]], "centre": [centre], "radius": [radius]})

    return placed.select("dim", "branch", "q").groupBy("dim", "branch").applyInPandas(
        ball, "dim int, branch int, centre array<double>, radius double")


def not_ruled_out(asked: DataFrame, balls: DataFrame, longest2: float, per_block: int) -> DataFrame:
    """vec_id, dim, q, least, branch: branches that a query (with dim, q, home, least) still has to
    search.  Queries and balls meet in blocks; what leaves a block are the pairs that are left."""
    n_asked, n_balls = asked.count(), balls.count()
    many, few = max(1, -(-n_asked // per_block)), max(1, -(-n_balls // BRANCHES_PER_BLOCK))
    left = (asked.withColumn("qb", F.pmod(F.xxhash64("vec_id", F.lit(21)), F.lit(many)).cast("int"))
            .withColumn("bb", F.explode(F.sequence(F.lit(0), F.lit(few - 1)))))
    right = (balls.withColumn("bb", F.pmod(F.xxhash64("branch", F.lit(22)), F.lit(few)).cast("int"))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(many - 1)))))

    def kept(mine: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(mine) and len(near):
            c, radius, branch = np.array(near["centre"].tolist()), near["radius"].to_numpy(), near["branch"].to_numpy()
            c2 = (c * c).sum(axis=1)
            for k in range(0, len(mine), AT_ONCE):
                some = mine.iloc[k:k + AT_ONCE]
                q = np.c_[_matrix(some["q"]).astype(np.float64), np.zeros(len(some))]
                q2 = (q * q).sum(axis=1)
                dist = np.sqrt(np.maximum(0.0, q2[:, None] + c2[None, :] - 2.0 * (q @ c.T)))
                # the matrix product rounds, by less than the slack
                reach = reach_of(some["least"].to_numpy(), q2, longest2) + 1e-6 * (1.0 + np.sqrt(q2.max() + longest2))
                i, j = np.nonzero((dist - radius[None, :] <= reach[:, None]) & (branch[None, :] != some["home"].to_numpy()[:, None]))
                parts.append(some[["vec_id", "dim", "q", "least"]].iloc[i].assign(branch=branch[j]))
        left = pd.concat(parts) if parts else pd.DataFrame(columns=["vec_id", "dim", "q", "least", "branch"])
        return left.astype({"vec_id": "int64", "dim": "int32", "least": "float64", "branch": "int32"})

    return left.groupBy("dim", "qb", "bb").cogroup(right.groupBy("dim", "qb", "bb")).applyInPandas(
        kept, "vec_id long, dim int, q array<long>, least double, branch int")


def _tree(rows: DataFrame, longest2: float, page: int, routes: int | None, per_branch: int):
    """Vectors placed in branches and pages (dim, route, page, branch), and queries with their home."""
    n = rows.count()
    wanted = routes or int(min(max(n ** 0.5, ROUTES[0]), ROUTES[1]))
    sample = hash_sample(rows.select("vec_id", "dim", "q"), wanted, "vec_id").collect()
    by_dim: dict[int, np.ndarray] = {}
    for d in {r.dim for r in sample}:
        x = _lifted(_matrix(r.q for r in sample if r.dim == d), longest2)
        by_dim[d] = x[np.argsort(chained(x))]
    routed = saved(_with_route(rows, by_dim, longest2, True), "routed")
    sizes = routed.groupBy("dim", "route").agg(F.ceil(F.count("*") / page).cast("int").alias("pages"))
    # a row per routing object: pages are numbered along the chain
    before = F.sum("pages").over(Window.partitionBy("dim").orderBy("route")) - F.col("pages")
    sizes = saved(sizes.withColumn("first", before.cast("int")), "route-sizes")
    page_of = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.col("pages")).cast("int")
    branch_of = F.floor((F.col("first") + page_of) / per_branch).cast("int")
    placed = (routed.join(small_side(sizes), ["dim", "route"]).withColumns({"branch": branch_of, "page": page_of})
              .drop("pages", "first"))
    queries = rows.where("is_query").groupBy("vec_id").agg(F.min(F.struct("dim", "q")).alias("x")).select("vec_id", "x.*")
    # a routing object that nothing is nearest to has no page: the first branch is as good
    homes = (_with_route(queries, by_dim, longest2, False).join(small_side(sizes), ["dim", "route"], "left")
             .withColumn("home", F.coalesce(branch_of, F.lit(0))).select("vec_id", "dim", "q", "home"))
    return saved(placed, "placed"), saved(homes, "homes")


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
          scale: int = SCALE, page: int = PAGE, routes: int | None = None, per_branch: int = PAGES_PER_BRANCH,
          per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every query row."""
    all_rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), quantised(vector_col, scale).alias("q"),
                               F.coalesce(is_query, F.lit(False)).alias("is_query"))
                .where("q is not null and vec_id is not null").withColumn("dim", F.size("q")))
    rows = saved(all_rows, "quantised")
    length2 = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x * x)
    longest2 = float(rows.agg(F.max(length2)).first()[0] or 0)
    placed, homes = _tree(rows, longest2, page, routes, per_branch)
    none = F.lit(float("-inf"))
    first = saved(_search(homes.select("vec_id", "dim", "q", F.col("home").alias("branch"), none.alias("least")), placed, longest2, k, per_block),
                  "home-search")
    # the k-th score found at home; fewer than k rule nothing out
    found = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("last"))
    least = F.when(F.col("n") >= k, F.col("last").cast("double")).otherwise(none)
    asked = homes.join(found, homes.vec_id == found.query_id, "left").select("vec_id", "dim", "q", "home", F.coalesce(least, none).alias("least"))
    balls = saved(branch_balls(placed, longest2), "balls")
    others = saved(not_ruled_out(saved(asked, "asked"), balls, longest2, 4 * per_block), "left-to-search")
    more = _search(others, placed, longest2, k, per_block)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return (first.unionByName(more).withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def query(spark, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
