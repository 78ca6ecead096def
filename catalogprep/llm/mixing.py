"""Mixing sources to target weights.

Tokens (words) are summed per source, a repetition rate is derived for each source, and
every document is emitted floor(rate) times plus once more with a probability equal to
the fraction, drawn from a hash of a seed, its id and its text, so reruns agree.

Defined results: a null text has size 0; null is a source of its own, ordered last;
a source without words has target 0 and its documents are not emitted; different texts
under one id, or without an id (drawn as the text 'null'), draw each for itself; rows equal
in id and text draw the same number; other columns do not matter, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalogprep.llm._common import SPACED, saved, small_side, text_of

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
SEED = "mix-1"


def text_size(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SPACED)).cast("bigint")


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 sum of the id and the text's MD5 sum."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.md5(text.cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target) from one row per source (source, source_size).

    The level by which a weight is multiplied rises until no further source passes
    ``max_repeat`` times its size; each step is one small aggregate over the sources."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    # one row per source stands here, after the documents are summed
    ranked = sizes.withColumn("k", (F.row_number().over(order) - 1) % len(weights))
    table = saved(ranked.select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), F.col("k") + 1)
                                .cast("double").alias("weight")), "sources")
    cap = F.col("source_size").cast("double") * max_repeat
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > cap
        total, held, free, n = table.agg(
            F.sum(F.col("source_size").cast("double")), F.sum(F.when(over, cap).otherwise(0.0)),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))), F.sum(over.cast("int"))).first()
        if not total or not free or n == capped:
            break
        level, capped = (total - held) / free, n
    return table.select("source", "source_size", F.least(F.col("weight") * F.lit(level), cap).alias("target"))


def _planned(sized: DataFrame, weights, max_repeat: int) -> DataFrame:
    """``sized`` (source, size, draw and others) with source_size, target and copies."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sums, weights, max_repeat).withColumnRenamed("source", "__source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate)
    copies = (whole + (F.col("draw") < rate - whole).cast("bigint")).cast("bigint")
    return (sized.join(small_side(targets), F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")
            .withColumn("copies", copies))


def mix_plan(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, copies (how often the mix emits the
    document) and taken (words taken, repeats counted) of every row."""
    sized = docs.select("doc_id", "source", text_size(text_of()).alias("size"), draw(F.col("doc_id"), text_of(), seed).alias("draw"))
    return _planned(sized, weights, max_repeat).drop("draw").withColumn("taken", F.col("copies") * F.col("size"))


def mix(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as the mix takes it."""
    rows = docs.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("row"), "source", text_size(text_of()).alias("size"),
                       draw(F.col("doc_id"), text_of(), seed).alias("draw"))
    plan = _planned(rows, weights, max_repeat).where("copies > 0")
    return (plan.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"))
            .select("row.*"))


def query(spark, sf_dir: str) -> DataFrame:
    from catalogprep.llm._common import read_table

    return mix_plan(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS th,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS DOUBLE) AS weight FROM s),
-- a source is held at its cap when the level that fills the sources after it (by cap / weight) lies above
r AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap,
         row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source IS NULL, source) AS k,
         (sum(source_size) OVER ())::DOUBLE AS total
  FROM w),
l AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM r),
f AS (SELECT coalesce(arg_min(lev, k) FILTER (WHERE weight * lev <= cap), 0) AS level FROM l),
t AS (SELECT source, source_size, least(weight * level, cap) AS target FROM r, f),
x AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null') || ':' || th), 1, 13) AS BIGINT)::DOUBLE
           / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM x
"""
