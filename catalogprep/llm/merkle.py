"""Merkle dataset manifest by a cogrouped subtree exchange.

Every row is a leaf, a SHA-256 of its length-prefixed fields.  Leaves of one source, in
order of their ids, form a tree in which every three consecutive nodes become one; the
sources' roots form the top tree in the same way.  Trees are worked on in superblocks of
``3 ** depth`` consecutive leaves, which become exactly one node of level ``depth``:

1. Leaves are numbered within their source: ranges of (source, id, leaf) are dealt over the
   cluster and sorted, and the counts of each range, one row per source it holds, give the
   offsets.  A source with a third of all rows is spread over many ranges.
2. Up: superblocks are reduced to one node each; these are the leaves of the next, smaller
   round, until every tree is one node.
3. Down: in every round, last one first, the leaves of a superblock and the outer nodes
   that its proofs need (siblings on the way from the superblock's node to the root) are
   cogrouped by superblock.  One ``applyInPandas`` call finishes the local reduction, joins
   local and outer siblings to whole proofs, and, in the leaves' round, folds the leaf
   found in the data with its proof.

A group is one superblock, so no task holds more than ``3 ** depth`` leaves of 64 bytes and
their outer nodes, two for each level.  Digests are hexadecimal text, as they are hashed.

Defined results: leaves with equal ids are ordered by their digest; rows without an id come
first in their source and are never taken as tampered with; equal rows are a leaf each; a
source with one leaf has that leaf as its root, and so has a dataset with one source; the proof of the only
leaf is empty; columns other than the hashed ones do not matter; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalogprep.llm._common import read_table, saved, small_side

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WAYS = 3
DEPTH = 7


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(**values: Column) -> Column:
    """SHA-256 of the fields in order: ``-`` for null, else byte count, colon, value."""
    parts = []
    for c in values.values():
        s = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def tree_key(source: Column) -> Column:
    """A source as a text that is never null and sorts bytewise, null first."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit(""))


def numbered(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """``rows``, saved, with ``idx``, each row's place in its tree, and ``n``, the tree's size."""
    at = F.monotonically_increasing_id()
    rows = saved(rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
                 .withColumns({"__at": at, "__range": F.shiftright(at, 33)}), "ranges")
    spans = rows.groupBy(tree, "__range").agg(F.min("__at").alias("__first"), F.count("*").alias("__count"))
    # one row for each range and source in it
    w = Window.partitionBy(tree)
    before = F.coalesce(F.sum("__count").over(w.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = saved(spans.withColumns({"__shift": before - F.col("__first"), "n": F.sum("__count").over(w)})
                  .select(tree, "__range", "__shift", "n"), "spans")
    return (rows.join(small_side(spans), [tree, "__range"])
            .withColumn("idx", F.col("__at") + F.col("__shift")).drop("__at", "__range", "__shift"))


def _levels(leaves: list[str], size: int, depth: int) -> list[list[str]]:
    """Nodes of a superblock by level, leaves first, of a tree with ``size`` leaves."""
    levels, left = [leaves], size
    while left > 1 and len(levels) <= depth:
        last = levels[-1]
        levels.append([_h("".join(last[i:i + WAYS])) for i in range(0, len(last), WAYS)])
        left = -(-left // WAYS)
    return levels


def _blocked(nodes: DataFrame, depth: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("idx") / WAYS ** depth))


def up(nodes: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(tree, idx, n, digest) of the next round: one node for each superblock of ``nodes``."""
    def top(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("idx")
        size = int(block["n"].iloc[0])
        digest = _levels(block["digest"].tolist(), size, depth)[-1][0]
        return pd.DataFrame([(block["tree"].iloc[0], block["block"].iloc[0], -(-size // WAYS ** depth), digest)],
                            columns=["tree", "idx", "n", "digest"])

    return (_blocked(nodes, depth).select("tree", "block", "idx", "n", "digest").groupBy("tree", "block")
            .applyInPandas(top, "tree string, idx long, n long, digest string"))


def _positioned(block: pd.DataFrame, depth: int):
    """For every leaf of a superblock its local siblings as (place among the run's others, texts)."""
    levels = _levels(block["digest"].tolist(), int(block["n"].iloc[0]), depth)
    for i in range(len(block)):
        path, j = [], i
        for nodes in levels[:-1]:
            a = j - j % WAYS
            run = nodes[a:a + WAYS]
            path.append((j - a, run[:j - a] + run[j - a + 1:]))
            j //= WAYS
        yield path


def _packed(path) -> str:
    """A proof as text: by level the node's place in its run and the siblings' digests."""
    return ",".join(f"{k}{''.join(others)}" for k, others in path)


def _unpacked(proof: str) -> list[tuple[int, list[str]]]:
    return [(int(x[0]), [x[1 + i:65 + i] for i in range(0, len(x) - 1, 64)]) for x in proof.split(",")] if proof else []


def fold(leaf: str, path) -> str:
    """The root that a leaf and the siblings of its way up give."""
    node = leaf
    for k, others in path:
        node = _h("".join([*others[:k], node, *others[k:]]))
    return node


def down(nodes: DataFrame, outer: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(tree, idx, proof) of all ``nodes``; ``outer`` has (tree, idx, proof) of their superblocks."""
    def joined(key, block: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("idx")
        above = outside["proof"].iloc[0]
        proofs = [",".join(filter(None, (_packed(path), above))) for path in _positioned(block, depth)]
        return pd.DataFrame({"tree": block["tree"], "idx": block["idx"], "proof": proofs})

    return _exchange(nodes.select("tree", "idx", "n", "digest"), outer, joined, "tree string, idx long, proof string", depth)


def _exchange(nodes: DataFrame, outer: DataFrame, finish, schema: str, depth: int) -> DataFrame:
    blocks = _blocked(nodes, depth).groupBy("tree", "block")
    return blocks.cogroup(outer.withColumnRenamed("idx", "block").groupBy("tree", "block")).applyInPandas(finish, schema)


def proofs_of(nodes: DataFrame, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """(tree, digest) of all trees' roots, and (tree, idx, proof) of the superblocks of
    ``nodes``: the siblings from the superblock's node up to its tree's root."""
    rounds = [nodes]
    while True:
        rounds.append(saved(up(rounds[-1], depth), "nodes"))
        if rounds[-1].where("n > 1").isEmpty():
            break
    roots = rounds[-1]
    outer = roots.select("tree", "idx", F.lit("").alias("proof"))
    for level in rounds[-2:0:-1]:
        outer = saved(down(level, outer, depth), "proofs")
    return roots.select("tree", "digest"), outer


def manifest(leaves: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Roots and proofs of ``leaves`` (doc_id, source, leaf, found: the digest of the data that is
    verified): doc_id, leaf, subroot, root, proof (see ``_packed``), folded_root, verified."""
    keyed = leaves.select("doc_id", tree_key(F.col("source")).alias("tree"), F.col("leaf").alias("digest"), "found")
    # a sample of the keys is drawn to the driver, so they hold a digest's first 60 bits as a number;
    # equal rows have equal keys, and another number keeps very many of them out of one range
    lead = F.conv(F.substring("digest", 1, 15), 16, 10).cast("long")
    nodes = numbered(keyed.withColumns({"__lead": lead, "__salt": F.xxhash64(F.monotonically_increasing_id())}), "tree", "doc_id", "__lead", "__salt")
    subroots, blocks = proofs_of(nodes.select("tree", "idx", "n", "digest"), depth)
    tops = saved(numbered(subroots.withColumnRenamed("tree", "source").withColumn("tree", F.lit("")), "tree", "source"), "tops")
    root, outer = proofs_of(tops.select("tree", "idx", "n", "digest"), depth)
    first = root.first()
    whole = first["digest"] if first else ""
    # the siblings above a source's root follow those below it
    top = down(tops, outer, depth).join(tops.select("idx", "source", F.col("digest").alias("subroot")), "idx")
    top = saved(top.select(F.col("source").alias("tree"), F.col("proof").alias("above"), "subroot"), "top-proofs")
    outside = (blocks.join(small_side(top), "tree").select(
        "tree", "idx", F.concat_ws(",", *(F.when(F.col(c) != "", F.col(c)) for c in ("proof", "above"))).alias("proof"), "subroot"))

    def finish(key, block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("idx")
        above = _unpacked(outer["proof"].iloc[0])
        proofs, folded = [], []
        for found, path in zip(block["found"], _positioned(block, depth)):
            path += above
            proofs.append(_packed(path))
            folded.append(fold(found, path))
        return pd.DataFrame({"id": block["id"], "leaf": block["digest"], "subroot": outer["subroot"].iloc[0], "root": whole,
                             "proof": proofs, "folded_root": folded, "verified": [f == whole for f in folded]})

    # ids travel as text, as pandas has no exact whole numbers beside nulls
    done = _exchange(nodes.select(F.col("doc_id").cast("string").alias("id"), "tree", "idx", "n", "digest", "found"), outside, finish,
                     "id string, leaf string, subroot string, root string, proof string, folded_root string, verified boolean", depth)
    return done.withColumn("id", F.col("id").cast(leaves.schema["doc_id"].dataType)).withColumnRenamed("id", "doc_id")


def proof_digest(proof: Column) -> Column:
    """SHA-256 of a proof's siblings, level by level, left to right."""
    return F.sha2(F.regexp_replace(proof, "(^|,)[0-9]", ""), 256)


def query(spark, sf_dir: str, depth: int = DEPTH) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(*FIELDS)
    leaf = leaf_digest(**{c: F.col(c) for c in FIELDS})
    tampered = leaf_digest(**{c: F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in FIELDS})
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    leaves = saved(docs.select("doc_id", "source", leaf.alias("leaf"), F.when(picked, tampered).otherwise(leaf).alias("found")), "leaves")
    return manifest(leaves, depth).select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                                          "folded_root", "verified")


#: CRC-32 of a decimal text: its bytes, each followed by eight shifts.
_CRC = """xor(list_reduce(flatten(list_transform(range(1, length(s) + 1), lambda i:
  [ascii(substr(s, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END, 4294967295), 4294967295)"""

ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS u, doc_id, source, lang, n_chars, text, CAST(doc_id AS VARCHAR) AS s FROM documents),
t AS (
  SELECT u, CASE WHEN s IS NOT NULL AND {_CRC} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS kept FROM d),
f AS (
  SELECT d.u, doc_id, source,
    coalesce(strlen(s) || ':' || s, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head, text, kept
  FROM d JOIN t USING (u)),
l AS (
  SELECT u, doc_id, coalesce('s' || source, '') AS tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(kept) || ':' || kept, '-')) AS found FROM f),
n AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, u) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM l),
-- nodes by level, until a tree has one
v AS (
  SELECT tree, 0 AS level, idx, n, leaf AS digest FROM n
  UNION ALL
  SELECT tree, level + 1, idx // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM v WHERE n > 1 GROUP BY tree, level, idx // 3),
r AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM v WHERE v.n = 1),
w AS (
  SELECT 0 AS level, idx, n, subroot AS digest FROM r
  UNION ALL
  SELECT level + 1, idx // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM w WHERE n > 1 GROUP BY level, idx // 3),
-- each node's run without it: the siblings before and after
sv AS (
  SELECT a.tree, a.level, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx), '') AS lo,
    coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx), '') AS hi
  FROM v a JOIN v b ON a.tree = b.tree AND a.level = b.level AND a.idx // 3 = b.idx // 3 WHERE a.n > 1 GROUP BY ALL),
sw AS (
  SELECT a.level, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx), '') AS lo,
    coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx), '') AS hi
  FROM w a JOIN w b ON a.level = b.level AND a.idx // 3 = b.idx // 3 WHERE a.n > 1 GROUP BY ALL),
g AS (
  SELECT u, tree, 0 AS level, idx, '' AS proof, found AS node FROM n
  UNION ALL
  SELECT u, g.tree, g.level + 1, g.idx // 3, proof || lo || hi, sha256(lo || node || hi)
  FROM g JOIN sv ON g.tree = sv.tree AND g.level = sv.level AND g.idx = sv.idx),
h AS (
  SELECT u, 0 AS level, r.idx, proof, node FROM (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY u ORDER BY level DESC) = 1) x
    JOIN r USING (tree)
  UNION ALL
  SELECT u, h.level + 1, h.idx // 3, proof || lo || hi, sha256(lo || node || hi)
  FROM h JOIN sw ON h.level = sw.level AND h.idx = sw.idx),
e AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY u ORDER BY level DESC) = 1)
SELECT doc_id, leaf, subroot, w.digest AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = w.digest AS verified
FROM n JOIN e USING (u) JOIN r ON n.tree = r.tree JOIN w ON w.n = 1
"""
