"""The job reads its CSV once, and what it wrote is compared with what can be read back."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from catalogprep import schemas
from catalogprep.operators import quality as Q
from catalogprep.plans import catalog_job as J
from catalogprep.sources import lookups
from catalogprep.sources import readers as R
from catalogprep.sources import writers as W


@pytest.fixture()
def paths(spark, tmp_dir):
    rows = [(f"s{i}", "Movie" if i % 3 else "TV Show", f"T{i}", None if i % 4 else "D", "C" if i % 5 else None,
             ["Canada", "France, Canada", None, "Atlantis"][i % 4], "July 24, 2020", str(2000 + i % 20), "PG" if i % 7 else None,
             "90 min" if i % 3 else "2 Seasons", "Dramas, Comedies", f"about {i}") for i in range(200)]
    raw = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in schemas.RAW_TITLE_COLUMNS))
    W.write_csv(raw.repartition(3), f"{tmp_dir}/titles")
    W.write_valid_countries(lookups.valid_countries_df(spark), f"{tmp_dir}/valid", header=True)
    W.write_language_map(lookups.language_map_df(spark), f"{tmp_dir}/langs")
    return [f"{tmp_dir}/{x}" for x in ("titles", "valid", "langs", "out")]


@pytest.mark.parametrize("mode", ["compat", "keep_all"])
def test_observed_profile_equals_the_profile_by_a_scan(spark, paths, mode):
    res = J.run(spark, *paths, mode=mode)
    raw = J._data(R.read_titles_csv(spark, paths[0]))
    lazy = J.clean_titles(raw, R.read_valid_countries(spark, paths[1], header=True), R.read_language_map(spark, paths[2]), mode=mode)
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(res.null_profile) == rows(lazy.null_profile) == rows(Q.fill_profile(raw, J.FILL_UNKNOWN))
    assert rows(res.titles) == rows(lazy.titles) and res.titles.count() > 0


@pytest.mark.parametrize("mode", ["compat", "keep_all"])
def test_one_scan_of_the_csv(spark, paths, mode):
    profile = Q.ObservedFillProfile(J._data(R.read_titles_csv(spark, paths[0])), J.FILL_UNKNOWN)
    cleaned = Q.drop_null_rows(Q.fill_nulls(profile.watched, J.FILL_UNKNOWN))
    titles = J.typed_titles(cleaned, R.read_valid_countries(spark, paths[1], header=True), R.read_language_map(spark, paths[2]), mode=mode)
    titles.collect()
    plan = titles._jdf.queryExecution().executedPlan().toString()
    final = plan.split("\n+- == Initial Plan ==")[0]
    assert len(re.findall(r"FileScan csv \[show_id", final)) == 1
    assert {r.total_rows for r in profile.frame().collect()} == {200}


def test_a_missing_or_truncated_file_raises(spark, tmp_dir, monkeypatch):
    df = spark.range(1000).repartition(4).withColumn("s", F.col("id").cast("string"))
    path = f"{tmp_dir}/t"
    back = W.write_parquet(df, path)
    W.check_written(df, back, 1000)
    part = sorted(glob.glob(f"{path}/part-*"))[0]
    whole = open(part, "rb").read()
    open(part, "wb").write(whole[:len(whole) // 2])
    with pytest.raises(Exception):
        W.check_written(df, spark.read.schema(df.schema).parquet(path), 1000)
    os.remove(part)
    with pytest.raises(W.IncompleteWrite, match="rows"):
        W.check_written(df, spark.read.parquet(path), 1000)

    def lossy(self, path, *args, write=DataFrameWriter.parquet, **kw):
        write(self, path, *args, **kw)
        os.remove(sorted(glob.glob(f"{path}/part-*"))[0])

    monkeypatch.setattr(DataFrameWriter, "parquet", lossy)
    with pytest.raises(W.IncompleteWrite, match="rows"):
        W.write_parquet(df, f"{tmp_dir}/u")
    W.write_parquet(df, f"{tmp_dir}/v", verify=False)


def test_another_schema_raises(spark, tmp_dir):
    df = spark.range(3)
    spark.range(3).select(F.col("id").cast("int")).write.parquet(f"{tmp_dir}/t")
    with pytest.raises(W.IncompleteWrite, match="int"):
        W.check_written(df, spark.read.parquet(f"{tmp_dir}/t"), 3)


def test_append_partitions_and_no_rows(spark, tmp_dir):
    df = spark.range(10).select("id", (F.col("id") % 3).cast("string").alias("k"))
    assert W.write_parquet(df, f"{tmp_dir}/p", partition_by=["k"]).count() == 10
    assert W.write_parquet(df, f"{tmp_dir}/p", mode="append", partition_by=["k"]).count() == 20
    assert W.write_parquet(df, f"{tmp_dir}/q", mode="append").count() == 10
    for by in (None, ["k"]):
        empty = W.write_parquet(df.limit(0), f"{tmp_dir}/e{len(by or [])}", partition_by=by)
        assert empty.count() == 0 and set(empty.columns) == {"id", "k"}
