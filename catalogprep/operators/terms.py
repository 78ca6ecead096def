"""Terms of a text column by id: statistics of terms, and TF-IDF rows over a bounded vocabulary.

No row per id and term is made or shuffled.  Statistics are one aggregate over the texts'
terms, with partial sums per term; a text's terms are counted, weighted and normalised within
its row (Spark ML's ``CountVectorizerModel``, ``ElementwiseProduct`` and ``Normalizer``).

Rows that share an id are one document.  A scan of the ids finds them; they alone take the way by
grouped counts of (id, term), which no frequent id makes one task's work.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogprep.operators._common import parked


class Documents(NamedTuple):
    """Rows with an id of their own, and those with an id of several rows (None: there are none)."""

    id_col: str
    single: DataFrame
    several: DataFrame | None


def documents(df: DataFrame, id_col: str) -> Documents:
    repeated = parked(df.groupBy(F.col(id_col).alias("_repeated")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_repeated"), "repeated-ids")
    if repeated.isEmpty():
        return Documents(id_col, df, None)
    same = F.col(id_col).eqNullSafe(F.col("_repeated"))
    return Documents(id_col, df.join(repeated, same, "left_anti"), df.join(repeated, same, "left_semi"))


def _grouped_counts(docs: Documents, toks: Column) -> DataFrame:
    """``(id, term, tf)`` of the ids with several rows."""
    return (docs.several.select(docs.id_col, F.explode(toks).alias("term"))
            .groupBy(docs.id_col, "term").agg(F.count(F.lit(1)).alias("tf")))


def term_statistics(docs: Documents, toks: Column) -> DataFrame:
    """``(term, total, df)``: how often each term occurs, and in how many ids."""
    # a row's terms, then each of them once
    rows = docs.single.select(toks.alias("t")).select(F.size("t").alias("k"), F.posexplode(F.concat("t", F.array_distinct("t"))).alias("at", "term"))
    counts = rows.select("term", (F.col("at") < F.col("k")).cast("long").alias("total"), (F.col("at") >= F.col("k")).cast("long").alias("df"))
    if docs.several is not None:
        counts = counts.unionByName(_grouped_counts(docs, toks).select("term", F.col("tf").alias("total"), F.lit(1).cast("long").alias("df")))
    return counts.groupBy("term").agg(F.sum("total").alias("total"), F.sum("df").alias("df"))


def tfidf_rows(docs: Documents, toks: Column, terms: list[str], idf: list[float]) -> DataFrame:
    """``(id, idx, val)``: places in ``terms`` of an id's known terms, in order, and their count times
    ``idf``, L2-normalised.  An id without a known term has empty arrays or no row."""
    i = docs.id_col
    if not terms:
        return docs.single.limit(0).select(i, F.array().cast("array<int>").alias("idx"), F.array().cast("array<double>").alias("val"))
    rows = docs.single.select(i, F.coalesce(toks, F.array().cast("array<string>")).alias("_toks"))
    rows = CountVectorizerModel.from_vocabulary(terms, inputCol="_toks", outputCol="_tf").transform(rows)
    rows = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="_raw").transform(rows)
    rows = Normalizer(p=2.0, inputCol="_raw", outputCol="_val").transform(rows).select(i, F.unwrap_udt("_val").alias("_v"))
    rows = rows.select(i, F.col("_v.indices").alias("idx"), F.col("_v.values").alias("val"))
    if docs.several is None:
        return rows
    known = F.broadcast(docs.single.sparkSession.createDataFrame(  # as many rows as terms
        [(t, k, float(w)) for k, (t, w) in enumerate(zip(terms, idf))], "term string, idx int, idf double"))
    raw = _grouped_counts(docs, toks).join(known, "term").select(i, "idx", (F.col("tf") * F.col("idf")).alias("raw"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(i)))
    merged = raw.select(i, F.struct("idx", (F.col("raw") / norm).alias("val")).alias("e")).groupBy(i).agg(F.array_sort(F.collect_list("e")).alias("e"))
    return rows.unionByName(merged.select(i, "e.idx", "e.val"))
