import pytest

from catalogprep.operators import quality as Q

SCHEMA = "id int, a string, b double, c string"
ROWS = [(1, "x", None, None), (2, None, 1.0, None), (3, "y", 2.0, None), (4, None, None, None)]


def test_null_profile_one_pass(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = [tuple(r) for r in Q.null_profile(df).orderBy("position").collect()]
    assert got == [
        (0, "id", 0, 0.0, 4), (1, "a", 2, 50.0, 4), (2, "b", 2, 50.0, 4), (3, "c", 4, 100.0, 4),
    ]


def test_null_profile_empty_table_has_null_pct(spark):
    df = spark.createDataFrame([], SCHEMA)
    got = Q.null_profile(df).collect()
    assert all(r.null_pct is None and r.total_rows == 0 for r in got)


def test_fill_profile_before_after_and_drop_count(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    prof = {r.column_name: r for r in Q.fill_profile(df, {"a": "Unknown", "c": "Unknown"}).collect()}
    assert prof["a"].null_count == 2 and prof["a"].nulls_after_fill == 0
    assert prof["b"].nulls_after_fill == 2
    assert prof["c"].pct_after_fill == 0.0
    assert prof["id"].rows_after_drop == 2  # rows 2 and 3 have b


def test_clean_nulls_fill_then_drop(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    cleaned, _ = Q.clean_nulls(df, {"a": "Unknown", "c": "Unknown"})
    assert sorted(tuple(r) for r in cleaned.collect()) == [(2, "Unknown", 1.0, "Unknown"), (3, "y", 2.0, "Unknown")]


def test_fill_unknown_column_is_an_error(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    with pytest.raises(ValueError):
        Q.fill_nulls(df, {"nope": "x"})


def test_missing_report_sorted_and_capped(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = [(r.column_name, r.null_count) for r in Q.missing_report(df, top=3).collect()]
    assert got == [("c", 4), ("a", 2), ("b", 2)]


def test_dedupe_with_array_column(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (1, ["a", "b"]), (1, ["b", "a"]), (1, [])], "k int, v array<string>")
    assert Q.dedupe(df).count() == 3


def test_schema_report_and_shape(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    rep = [tuple(r) for r in Q.schema_report(df).orderBy("position").collect()]
    assert rep == [(0, "id", "int", 4), (1, "a", "string", 2), (2, "b", "double", 2), (3, "c", "string", 0)]
    assert tuple(Q.shape(df).collect()[0]) == (4, 4)


def test_preview_is_deterministic(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert [r.id for r in Q.preview(df, 2, ["id"]).collect()] == [1, 2]
