import datetime as dt


from catalogprep.functions import dates as D
from catalogprep.functions import strings as S


def _one(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_split_list_keeps_empty_tokens(spark):
    got = _one(spark, [("a, b,c",), ("",), ("x,",), (None,)], "s string", S.split_list("s"))
    assert got == [["a", "b", "c"], [""], ["x", ""], None]


def test_strip_leading_comma(spark):
    got = _one(spark, [(", France",), (" ,  Chile, Peru",), ("Peru",)], "s string", S.strip_leading_comma("s"))
    assert got == ["France", "Chile, Peru", "Peru"]


def test_split_trim_and_literal(spark):
    assert _one(spark, [("a , b,c ",)], "s string", S.split_trim("s")) == [["a", "b", "c"]]
    assert _one(spark, [("a, b,c",)], "s string", S.split_literal("s", ", ")) == [["a", "b,c"]]


def test_units_and_numbers(spark):
    rows = [("113 min",), ("2 Seasons",), ("1 Season",), ("12 Seasons",), ("",), ("TV-PG",), (None,)]
    assert _one(spark, rows, "s string", S.remove_unit("s").try_cast("int")) == [113, None, None, None, None, None, None]
    assert _one(spark, rows, "s string", S.digits_only("s").try_cast("int")) == [113, 2, 1, 12, None, None, None]
    assert _one(spark, rows, "s string", S.first_number("s")) == [113.0, 2.0, 1.0, 12.0, None, None, None]


def test_to_int_edges(spark):
    rows = [(" 2020 ",), ("",), ("TV-PG",), ("1.5",), ("2021",)]
    assert _one(spark, rows, "s string", S.to_int("s")) == [2020, None, None, None, 2021]


def test_parse_text_date_edges(spark):
    rows = [("July 24, 2020",), ("July 04, 2020",), (" August 4, 2017",), ("Jan 1, 2023",), ("July 24",),
            ("Unknown",), ("February 30, 2021",), (None,)]
    got = _one(spark, rows, "s string", D.parse_text_date("s"))
    assert got == [dt.date(2020, 7, 24), dt.date(2020, 7, 4), dt.date(2017, 8, 4), None, None, None, None, None]
    untrimmed = _one(spark, rows[2:3], "s string", D.parse_text_date("s", trim=False))
    assert untrimmed == [None]


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.date(2020, 7, 24),), (dt.date(2024, 1, 1),)], "d date")
    text = df.select(*[c.alias(k) for k, c in D.date_text_parts("d").items()]).collect()
    assert [tuple(r) for r in text] == [("2020", "July", "24", "Friday"), ("2024", "January", "1", "Monday")]
    ints = df.select(*[c.alias(k) for k, c in D.date_int_parts("d").items()]).collect()
    # Monday = 0, as pandas' dayofweek
    assert [tuple(r) for r in ints] == [(2020, 7, 24, 4), (2024, 1, 1, 0)]


def test_age_in_years_pinned(spark):
    assert _one(spark, [(2000,), (None,)], "y int", D.age_in_years("y", 2025)) == [25, None]


def test_stop_words_match_spark_default(spark):
    from pyspark.ml.feature import StopWordsRemover

    from catalogprep.functions.text import ENGLISH_STOP_WORDS

    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_tokens_unicode_and_pairs(spark):
    from catalogprep.functions.text import adjacent_pairs, tokens

    df = spark.createDataFrame([("Héllo wörld_x a B2",), ("one",), ("",)], "t string")
    got = [r[0] for r in df.select(tokens("t")).collect()]
    assert got == [["héllo", "wörld_x", "b2"], ["one"], []]
    pairs = [r[0] for r in df.select(adjacent_pairs(tokens("t"))).collect()]
    assert pairs == [["héllo wörld_x", "wörld_x b2"], [], []]
