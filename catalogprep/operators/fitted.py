"""The feature chain as two steps: a fit that is kept, and a transform that applies it.

``fit_features`` writes what it learns as Parquet: one row per feature, with its index, and
one row with the settings.  ``transform_features`` reads them and gives every row of any other
table a sparse vector over these features:

* a number, scaled by the fit's mean and population deviation (a zero one divides by 1); a
  missing number has no entry;
* 1 for the label of a categorical column and for each label of a list column;
* the TF-IDF weight of a term, by the fit's document frequencies, normalised over the row's
  known terms.

Labels and terms that the fit has not seen have no feature and are left out.  The labels of
all columns are found in one job, however many columns there are, and may be many: a
vector holds only what its row has, and no label ever becomes a column.  Joins with the feature table are
left to the planner, which knows its size.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalogprep.functions.text import ENGLISH_STOP_WORDS, WORD_TOKEN, drop_stop_words, tokens
from catalogprep.operators import terms as T

FEATURE_SCHEMA = "idx int, kind string, column string, label string, mean double, scale double, idf double"


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns become features; ``id_col`` is unique."""

    id_col: str
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    lists: tuple[str, ...] = ()
    text: str | None = None
    max_features: int = 5_000
    stop_words: tuple[str, ...] = field(default=ENGLISH_STOP_WORDS)
    pattern: str = WORD_TOKEN


def label_entries(df: DataFrame, spec: FeatureSpec, *keep: str) -> DataFrame:
    """``keep`` with (column, label) of every label of the categorical and list columns."""
    def entry(c: str):
        return lambda x: F.struct(F.lit(c).alias("column"), x.cast("string").alias("label"))

    one = [F.array(entry(c)(F.col(c))) for c in spec.categorical]
    many = [F.transform(F.coalesce(F.array_distinct(c), F.array().cast("array<string>")), entry(c)) for c in spec.lists]
    return (df.select(*keep, F.explode(F.concat(*one, *many)).alias("_e")).select(*keep, "_e.column", "_e.label")
            .where(F.col("label").isNotNull()))


def label_domains(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """``(column, label, n)`` of all label columns: one job with a partial aggregate."""
    return label_entries(df, spec).groupBy("column", "label").agg(F.count(F.lit(1)).alias("n"))


def _terms(spec: FeatureSpec) -> Column:
    return drop_stop_words(tokens(spec.text, spec.pattern), spec.stop_words)


def _vocabulary(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    n = df.agg(F.count(F.lit(1))).scalar()
    terms = T.term_statistics(T.documents(df.select(spec.id_col, spec.text), spec.id_col), _terms(spec))
    idf = F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return terms.orderBy(F.desc("total"), F.asc("term")).limit(spec.max_features).select(F.col("term").alias("label"), idf.alias("idf"))


def fit_features(df: DataFrame, spec: FeatureSpec, path: str) -> None:
    """Learn the features of ``df`` and write them below ``path`` (``features``, ``settings``).

    Features are ordered: numbers as given, labels by column as given and by value, terms
    by value.  A column without a value in ``df`` has no label feature, or a number of mean 0."""
    none = lambda t: F.lit(None).cast(t)
    parts = []
    if spec.numeric:
        fit = df.agg(*[F.struct(F.lit(c).alias("column"), F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in spec.numeric])
        numbers = fit.select(F.posexplode(F.array(*[f"`{c}`" for c in spec.numeric])).alias("nth", "s"))
        parts.append(numbers.select(
            F.lit(0).alias("part"), "nth", F.lit("number").alias("kind"), "s.column", none("string").alias("label"),
            F.coalesce("s.m", F.lit(0.0)).alias("mean"), F.when(F.col("s.s") > 0, F.col("s.s")).otherwise(1.0).alias("scale"), none("double").alias("idf")))
    if spec.categorical or spec.lists:
        nth = F.array_position(F.array(*map(F.lit, (*spec.categorical, *spec.lists))), F.col("column")).cast("int")
        parts.append(label_domains(df, spec).select(
            F.lit(1).alias("part"), nth.alias("nth"), F.lit("label").alias("kind"), "column", "label",
            none("double").alias("mean"), none("double").alias("scale"), none("double").alias("idf")))
    if spec.text:
        parts.append(_vocabulary(df, spec).select(
            F.lit(2).alias("part"), F.lit(0).alias("nth"), F.lit("term").alias("kind"), F.lit(spec.text).alias("column"), "label",
            none("double").alias("mean"), none("double").alias("scale"), "idf"))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    # one row per feature stands here: numbered within its column, then moved by the columns before it
    spark = df.sparkSession
    within = Window.partitionBy("part", "nth").orderBy("label")
    rows.withColumn("place", F.row_number().over(within) - 1).write.mode("overwrite").parquet(f"{path}/numbered")
    rows = spark.read.parquet(f"{path}/numbered")
    ahead = F.sum("size").over(Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1))
    shift = rows.groupBy("part", "nth").agg(F.count(F.lit(1)).alias("size")).select("part", "nth", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    features = rows.join(F.broadcast(shift), ["part", "nth"]).withColumn("idx", (F.col("place") + F.col("ahead")).cast("int"))  # one row per column
    features.select("idx", "kind", "column", "label", "mean", "scale", "idf").write.mode("overwrite").parquet(f"{path}/features")
    spark.createDataFrame([(json.dumps(asdict(spec)),)], "spec string").coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")


def fitted_spec(spark: SparkSession, path: str) -> FeatureSpec:
    raw = json.loads(spark.read.parquet(f"{path}/settings").first()["spec"])
    return FeatureSpec(**{k: tuple(v) if isinstance(v, list) else v for k, v in raw.items()})


def fitted_features(spark: SparkSession, path: str) -> DataFrame:
    """``(idx, kind, column, label, mean, scale, idf)``: what a vector's places mean."""
    return spark.read.schema(FEATURE_SCHEMA).parquet(f"{path}/features")


def _scaled(df: DataFrame, spec: FeatureSpec, features: DataFrame) -> list[Column]:
    """Entries of the numeric columns (their features, one a column, are read by the driver)."""
    found = {r.column: r for r in features.where("kind = 'number'").collect()}
    return [F.when(F.col(c).isNotNull(), F.struct(
        F.lit(r.idx).alias("idx"), ((F.col(c).cast("double") - F.lit(r["mean"])) / F.lit(r.scale)).alias("val")))
        for c in spec.numeric for r in [found[c]]]


def transform_features(df: DataFrame, path: str) -> DataFrame:
    """``(id, idx, val)`` for every row of ``df``: aligned arrays in the order of the features
    that ``path`` keeps.  A row with nothing known has empty arrays."""
    spark = df.sparkSession
    spec, features = fitted_spec(spark, path), fitted_features(spark, path)
    entry = "array<struct<idx:int,val:double>>"
    # one row per id here, so that ids without any label or term stay
    numbers = F.array_compact(F.array(*_scaled(df, spec, features))) if spec.numeric else F.from_json(F.lit("[]"), entry)
    parts = [df.select(spec.id_col, numbers.alias("e"))]
    if spec.categorical or spec.lists:
        labels = features.where("kind = 'label'").select("idx", "column", "label")
        one = F.array(F.struct("idx", F.lit(1.0).alias("val"))).alias("e")
        parts.append(label_entries(df, spec, spec.id_col).join(labels, ["column", "label"]).select(spec.id_col, one))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    # terms come last among the features, side by side: their rows are whole and in order
    terms = features.where("kind = 'term'").orderBy("idx").collect() if spec.text else []  # max_features at most
    if terms:
        docs = T.documents(df.select(spec.id_col, spec.text), spec.id_col)
        found = T.tfidf_rows(docs, _terms(spec), [r.label for r in terms], [r.idf for r in terms])
        rows = rows.unionByName(found.withColumnsRenamed({"idx": "t", "val": "w"}), allowMissingColumns=True)
    else:
        rows = rows.withColumns({"t": F.lit(None).cast("array<int>"), "w": F.lit(None).cast("array<double>")})
    whole = rows.groupBy(spec.id_col).agg(F.array_sort(F.flatten(F.collect_list("e"))).alias("e"),
                                          F.flatten(F.collect_list("t")).alias("t"), F.flatten(F.collect_list("w")).alias("w"))
    first = terms[0].idx if terms else 0
    return whole.select(spec.id_col, F.concat("e.idx", F.transform("t", lambda k: k + F.lit(first))).alias("idx"), F.concat("e.val", "w").alias("val"))
