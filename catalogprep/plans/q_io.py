"""Queries: source/sink round trips and lookup builders.

They write to a fresh sub-folder of the shared checkpoint folder
(``spark.checkpoint.dir``) and return the read-back DataFrame.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogprep.operators.multivalue import member_lookup
from catalogprep.plans import oracle_sql as S
from catalogprep.plans import standins
from catalogprep.plans.registry import register, render
from catalogprep.session import scratch_path
from catalogprep.sources import readers as R
from catalogprep.sources import writers as W
from catalogprep.sources.readers import read_table

CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@register("io_roundtrip", "SELECT * FROM customer")
def io_roundtrip(spark, d):
    """customer -> CSV -> JSON lines -> Parquet, each read back with a
    declared schema; the result must equal the source table."""
    base = scratch_path(spark, "io-roundtrip")
    src = read_table(spark, d, "customer")
    W.write_csv(src, f"{base}/csv")
    from_csv = R.read_csv(spark, f"{base}/csv", CUSTOMER_SCHEMA)
    W.write_json_lines(from_csv, f"{base}/json")
    from_json = R.read_json_lines(spark, f"{base}/json", CUSTOMER_SCHEMA)
    return W.write_parquet(from_json, f"{base}/parquet")


@register(
    "lookup_build",
    S.with_(S.VALID, S.LANG_MAP, """info AS (
  SELECT coalesce(v.country, m.country) AS country, v.country IS NOT NULL AS is_valid,
         m.country IS NOT NULL AS is_mapped, coalesce(m.languages, []) AS languages
  FROM (SELECT DISTINCT country FROM valid_countries) v
  FULL OUTER JOIN (SELECT country, list_sort(list_distinct(flatten(list(Languages)))) AS languages
                   FROM lang_map GROUP BY country) m ON v.country = m.country)""")
    + "SELECT country, is_valid, is_mapped, array_to_string(languages, ', ') AS languages FROM info",
)
def lookup_build(spark, d):
    """Write both lookups in the generator's shapes (header-less name list,
    one JSON object ``{country: [languages]}``), read them back, and build
    the member table the validation uses."""
    base = scratch_path(spark, "lookups")
    W.write_valid_countries(standins.valid_nations(spark, d), f"{base}/valid", header=False)
    W.write_language_map(standins.nation_languages(spark, d), f"{base}/langs", shape="object")
    valid = R.read_valid_countries(spark, f"{base}/valid", header=False)
    langs = R.read_language_map(spark, f"{base}/langs")
    info = member_lookup(valid, langs)
    return info.select("country", "is_valid", "is_mapped", render("languages").alias("languages"))


@register("text_lines", "SELECT CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(length(n_name)) AS BIGINT) AS n_chars FROM nation")
def text_lines(spark, d):
    """Plain-text sink and scan: one nation name per line."""
    base = scratch_path(spark, "text")
    read_table(spark, d, "nation").select("n_name").write.mode("overwrite").text(f"{base}/names")
    lines = R.read_text_lines(spark, f"{base}/names", "n_name")
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("n_name")).cast("bigint").alias("n_chars"))
