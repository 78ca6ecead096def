import datetime as dt
import json
import os

import pytest

from catalogprep import schemas
from catalogprep.plans.catalog_job import run
from catalogprep.sources import lookups, readers as R, writers as W

HEADER = "show_id,type,title,director,cast,country,date_added,release_year,rating,duration,listed_in,description\n"
CSV_ROWS = [
    't1,Movie,Alpha,Dir A,"Cast A, Cast B",United States,"July 24, 2020",2020,TV-MA,113 min,"International Movies, Dramas",A film.\n',
    't2,TV Show,Beta,,Cast C,"Canada, Costa Rica","August 4, 2017",2017,TV-14,2 Seasons,Docuseries,"A ""good"" show."\n',
    # unquoted comma in the date: one token too many -> corrupt record, last token dropped
    't3,Movie,Gamma,Dir G,Cast G,France,July 24, 2020,2020,PG,90 min,Comedies,Desc\n',
    # one token short
    't4,Movie,Delta,Dir D,Cast D,France,"May 1, 2019",2019,PG,95 min,Comedies\n',
    # newline inside quotes, stray leading comma, unparsable year
    't5,Movie,Epsilon,Dir E,,", Mexico","Jan 1, 2023",TV-PG,R,80 min,"Thrillers","line one\nline two"\n',
    # empty country -> Unknown -> vanishes in compat mode
    't6,TV Show,Zeta,Dir Z,Cast Z,,"March 3, 2021",2021,TV-Y,1 Season,Kids,Short.\n',
]


@pytest.fixture()
def titles_csv(tmp_dir):
    path = os.path.join(tmp_dir, "titles.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(HEADER + "".join(CSV_ROWS))
    return path


def test_csv_permissive_with_corrupt_records(spark, titles_csv):
    df = R.read_titles_csv(spark, titles_csv, multi_line=True)
    rows = {r.show_id: r for r in df.collect()}
    assert set(rows) == {"t1", "t2", "t3", "t4", "t5", "t6"}
    assert rows["t1"].cast == "Cast A, Cast B" and rows["t1"]._corrupt_record is None
    assert rows["t2"].description == 'A "good" show.'
    assert rows["t3"].date_added == "July 24" and rows["t3"]._corrupt_record is not None
    assert rows["t4"].description is None and rows["t4"]._corrupt_record is not None
    assert rows["t5"].description == "line one\nline two"


def test_valid_countries_header_option(spark, tmp_dir):
    path = os.path.join(tmp_dir, "valid.txt")
    with open(path, "w") as f:
        f.write("country\nFrance\n Chile \n\nBosnia, Herzegovina\n")
    assert [r.country for r in R.read_valid_countries(spark, path).collect()] == ["France", "Chile", "Bosnia, Herzegovina"]
    assert R.read_valid_countries(spark, path, header=False).count() == 4


def test_language_map_both_shapes(spark, tmp_dir):
    arr = os.path.join(tmp_dir, "arr.json")
    obj = os.path.join(tmp_dir, "obj.json")
    with open(arr, "w") as f:
        json.dump([{"country": "Chile", "Languages": ["Spanish"]}, {"country": "Canada", "Languages": ["English", "French"]}], f, indent=2)
    with open(obj, "w") as f:
        json.dump({"Chile": ["Spanish"], "Canada": ["English", "French"]}, f)
    for p in (arr, obj):
        got = sorted((r.country, tuple(r.Languages)) for r in R.read_language_map(spark, p).collect())
        assert got == [("Canada", ("English", "French")), ("Chile", ("Spanish",))]


def test_lookup_writers_round_trip(spark, tmp_dir):
    langs = lookups.language_map_df(spark)
    for shape in ("array", "object"):
        out = os.path.join(tmp_dir, f"langs-{shape}")
        W.write_language_map(langs, out, shape=shape)
        back = R.read_language_map(spark, out)
        assert back.select("country").distinct().count() == 119
    out = os.path.join(tmp_dir, "langs-lines")
    W.write_language_map(langs, out, shape="lines")
    assert R.read_language_map(spark, out, shape="lines").count() == 120
    vpath = os.path.join(tmp_dir, "valid")
    W.write_valid_countries(lookups.valid_countries_df(spark), vpath, header=False)
    assert R.read_valid_countries(spark, vpath, header=False).count() == 122


def test_bundled_lookups_facts(spark):
    from catalogprep.operators.multivalue import member_lookup

    info = member_lookup(lookups.valid_countries_df(spark), lookups.language_map_df(spark))
    unmapped = sorted(r.country for r in info.where("is_valid and not is_mapped").collect())
    invalid = sorted(r.country for r in info.where("is_mapped and not is_valid").collect())
    assert unmapped == ["Hungary", "Mauritius", "Netherlands", "Pakistan", "United Kingdom", "Vatican City", "Vietnam"]
    assert invalid == ["Belize", "Costa Rica", "El Salvador", "Honduras"]


def test_refuse_overwriting_input(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p")
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError):
        W.write_parquet(spark.read.parquet(path), path)


def test_job_end_to_end(spark, tmp_dir, titles_csv):
    vpath = os.path.join(tmp_dir, "valid")
    lpath = os.path.join(tmp_dir, "langs")
    W.write_valid_countries(lookups.valid_countries_df(spark), vpath, header=True)
    W.write_language_map(lookups.language_map_df(spark), lpath, shape="array")
    out = os.path.join(tmp_dir, "clean")
    res = run(spark, titles_csv, vpath, lpath, out, multi_line=True)
    titles = res.titles
    assert [(f.name, f.dataType) for f in titles.schema.fields] == [
        (f.name, f.dataType) for f in schemas.CLEAN_TITLES.fields
    ]
    rows = sorted(titles.collect(), key=lambda r: (r.show_id, r.released_countries))
    ids = [r.show_id for r in rows]
    # t4 (one token short) keeps a null and is dropped; t3 (one token too many)
    # survives with its fields shifted; t6 has no mapped country
    assert ids == ["t1", "t2", "t2", "t3", "t5"]
    t1 = rows[0]
    assert (t1.released_countries, t1.released_languages, t1.movie_type, t1.show_type) == (
        ["United States"], ["English"], "Global", None)
    assert (t1.movie_duration, t1.seasons, t1.release_year) == (113, None, 2020)
    assert (t1.added_date, t1.year, t1.month, t1.day, t1.day_of_week) == (
        dt.date(2020, 7, 24), "2020", "July", "24", "Friday")
    assert t1.genres == ["International Movies", "Dramas"]
    t2 = {tuple(r.released_countries): r for r in rows[1:3]}
    assert t2[("Canada", "Costa Rica")].released_languages == ["English", "French"]
    assert t2[("Unknown",)].released_languages == ["Spanish"]
    assert t2[("Canada", "Costa Rica")].seasons == 2 and t2[("Canada", "Costa Rica")].director == "Unknown"
    t3 = rows[3]
    assert (t3.date_added, t3.added_date, t3.release_year, t3.rating) == ("July 24", None, 2020, "2020")
    t5 = rows[4]
    assert (t5.release_year, t5.added_date, t5.released_countries, t5.cast) == (None, None, ["Mexico"], "Unknown")
    prof = {r.column_name: r for r in res.null_profile.collect()}
    assert prof["director"].null_count == 1 and prof["director"].nulls_after_fill == 0
    assert prof["show_id"].total_rows == 6 and prof["show_id"].rows_after_drop == 5


def test_job_keep_all_mode(spark, tmp_dir, titles_csv):
    from catalogprep.plans.catalog_job import clean_titles

    raw = R.read_titles_csv(spark, titles_csv, multi_line=True)
    res = clean_titles(raw, lookups.valid_countries_df(spark), lookups.language_map_df(spark), mode="keep_all")
    rows = {r.show_id: r for r in res.titles.collect()}
    assert sorted(rows) == ["t1", "t2", "t3", "t5", "t6"]
    assert rows["t2"].released_countries == ["Canada", "Unknown"]
    assert rows["t6"].released_countries == ["Unknown"] and rows["t6"].released_languages == []


def test_generic_readers_and_partitioned_sink(spark, tmp_dir):
    arr = os.path.join(tmp_dir, "records.json")
    with open(arr, "w") as f:
        json.dump([{"a": 1, "b": "x"}, {"a": 2, "b": "y"}], f, indent=2)
    assert sorted(tuple(r) for r in R.read_json_array(spark, arr, "a int, b string").collect()) == [(1, "x"), (2, "y")]
    lines = os.path.join(tmp_dir, "lines.txt")
    with open(lines, "w") as f:
        f.write("one\ntwo\n")
    assert [r.word for r in R.read_text_lines(spark, lines, "word").collect()] == ["one", "two"]
    csv = os.path.join(tmp_dir, "t.csv")
    with open(csv, "w") as f:
        f.write("k,v\n1,a\n2,\n")
    assert [tuple(r) for r in R.read_csv(spark, csv, "k int, v string").collect()] == [(1, "a"), (2, None)]
    src = spark.createDataFrame([("Movie", 1), ("TV Show", 2), ("Movie", 3)], "type string, n int")
    back = W.write_parquet(src, os.path.join(tmp_dir, "by_type"), partition_by=["type"])
    assert sorted((r.type, r.n) for r in back.collect()) == [("Movie", 1), ("Movie", 3), ("TV Show", 2)]
    assert os.path.isdir(os.path.join(tmp_dir, "by_type", "type=Movie"))
