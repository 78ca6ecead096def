"""Country validation and language enrichment.

The expected results come from a plain-Python model of the published job
(explode -> anti-join invalid list -> isin flag -> inner join with the map ->
collect languages per list value -> join back -> drop -> dedupe), applied to
invented rows covering every case of FIXTURES.md section 5.
"""

import re

import pytest

from catalogprep.operators import multivalue as M

VALID = ["United States", "Canada", "Mexico", "France", "Hungary", "Unknownland"]
LANGS = [
    ("United States", ["English"]),
    ("Canada", ["English", "French"]),
    ("Mexico", ["Spanish"]),
    ("France", ["French"]),
    ("Costa Rica", ["Spanish"]),        # mapped, not valid
    ("Belize", ["English", "Kriol"]),  # mapped, not valid
    ("Canada", ["Inuktitut"]),          # duplicated entry
]
TITLES = [
    ("s1", "United States"),                 # valid + mapped
    ("s2", "United States, Atlantis"),       # valid + invalid (unmapped)
    ("s3", "Atlantis"),                      # only invalid
    ("s4", "Unknown"),                       # filled null
    ("s5", "Costa Rica"),                    # mapped-not-valid alone
    ("s6", "Costa Rica, Mexico"),            # mapped-not-valid with a valid one
    ("s7", "Hungary"),                       # valid-not-mapped alone
    ("s8", "Hungary, France"),               # valid-not-mapped with a mapped one
    ("s9", ", Canada"),                      # stray leading comma
    ("s10", "Canada,"),                      # trailing comma -> '' member
    ("s11", "Mexico, Mexico"),               # repeated country
    ("s12", "Belize, Canada"),               # duplicated map entry + mapped-invalid
    ("s12", "Belize, Canada"),               # duplicate input row
]


def published_model(titles, valid, langs):
    """The published algorithm, literally, in plain Python."""
    exploded = []
    for sid, text in titles:
        members = re.split(r",\s*", re.sub(r"^\s*,\s*", "", text))
        for c in members:
            exploded.append((sid, tuple(members), c))
    invalid = {c for _, _, c in exploded if c not in set(valid)}
    flagged = [(sid, ("Unknown",) if c in invalid else ms, c) for sid, ms, c in exploded]
    joined = [(sid, cc, c, tuple(ls)) for sid, cc, c in flagged for mc, ls in langs if mc == c]
    per_key = {}
    for _, cc, _, ls in joined:
        per_key.setdefault(cc, set()).update(ls)
    out = {(sid, cc, tuple(sorted(per_key[cc])) if per_key.get(cc) else None) for sid, cc, _, _ in joined}
    return sorted(out, key=repr)


def _frames(spark):
    titles = spark.createDataFrame(TITLES, "show_id string, country string")
    valid = spark.createDataFrame([(v,) for v in VALID], "country string")
    langs = spark.createDataFrame(LANGS, "country string, Languages array<string>")
    return titles, valid, langs


def _rows(df):
    return sorted(
        ((r.show_id, tuple(r.released_countries),
          tuple(r.released_languages) if r.released_languages is not None else None) for r in df.collect()),
        key=repr,
    )


@pytest.mark.parametrize("max_lookup_rows", [100_000, 0])
def test_compat_equals_published_model(spark, max_lookup_rows):
    titles, valid, langs = _frames(spark)
    got = _rows(M.enrich_languages(titles, valid, langs, mode="compat", max_lookup_rows=max_lookup_rows))
    assert got == published_model(TITLES, VALID, LANGS)


def test_compat_known_rows(spark):
    titles, valid, langs = _frames(spark)
    got = _rows(M.enrich_languages(titles, valid, langs))
    unknown_langs = ("English", "Kriol", "Spanish")  # union over Costa Rica and Belize
    assert ("s1", ("United States",), ("English",)) in got
    assert ("s6", ("Costa Rica", "Mexico"), ("Spanish",)) in got
    assert ("s6", ("Unknown",), unknown_langs) in got
    assert ("s12", ("Belize", "Canada"), ("English", "French", "Inuktitut")) in got
    assert not [r for r in got if r[0] in ("s3", "s4", "s7")]  # no mapped member: vanish
    assert len([r for r in got if r[0] == "s12"]) == 2          # duplicate input collapsed


@pytest.mark.parametrize("max_lookup_rows", [100_000, 0])
def test_keep_all_one_row_per_title(spark, max_lookup_rows):
    titles, valid, langs = _frames(spark)
    got = M.enrich_languages(titles, valid, langs, mode="keep_all", max_lookup_rows=max_lookup_rows)
    rows = {(r.show_id, tuple(r.released_countries), tuple(r.released_languages)) for r in got.collect()}
    assert got.count() == len(TITLES)
    assert ("s2", ("United States", "Unknown"), ("English",)) in rows
    assert ("s3", ("Unknown",), ()) in rows
    assert ("s6", ("Unknown", "Mexico"), ("Spanish",)) in rows
    assert ("s8", ("Hungary", "France"), ("French",)) in rows
    assert ("s11", ("Mexico",), ("Spanish",)) in rows


def test_invalid_members_and_flag(spark):
    titles, valid, _ = _frames(spark)
    ex = M.explode_members(titles)
    bad = sorted(r.country for r in M.invalid_members(ex, valid).collect())
    assert bad == ["", "Atlantis", "Belize", "Costa Rica", "Unknown"]
    flagged = M.flag_invalid_members(ex, valid)
    s2 = sorted((r.country, tuple(r.country_clean)) for r in flagged.where("show_id = 's2'").collect())
    assert s2 == [("Atlantis", ("Unknown",)), ("United States", ("United States", "Atlantis"))]


def test_member_lookup_unions_duplicates(spark):
    _, valid, langs = _frames(spark)
    info = {r.country: (r.is_valid, r.is_mapped, tuple(r.languages)) for r in M.member_lookup(valid, langs).collect()}
    assert info["Canada"] == (True, True, ("English", "French", "Inuktitut"))
    assert info["Hungary"] == (True, False, ())
    assert info["Belize"] == (False, True, ("English", "Kriol"))


def test_enrich_plan_has_no_python_udf_or_cross_join(spark):
    titles, valid, langs = _frames(spark)
    plan = M.enrich_languages(titles, valid, langs)._jdf.queryExecution().executedPlan().toString()
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


@pytest.mark.parametrize("max_lookup_rows", [100_000, 0])
def test_compat_when_unknown_is_itself_valid_and_mapped(spark, max_lookup_rows):
    valid = VALID + ["Unknown"]
    langs = LANGS + [("Unknown", ["Esperanto"])]
    titles = spark.createDataFrame(TITLES, "show_id string, country string")
    got = _rows(M.enrich_languages(
        titles, spark.createDataFrame([(v,) for v in valid], "country string"),
        spark.createDataFrame(langs, "country string, Languages array<string>"),
        max_lookup_rows=max_lookup_rows,
    ))
    assert got == published_model(TITLES, valid, langs)


@pytest.mark.parametrize("mode", ["compat", "keep_all"])
def test_a_list_of_half_the_rows_is_dealt_over_tasks(spark, monkeypatch, mode):
    rows = [(i, "France, Canada" if i % 2 else ["Chile", "Atlantis, Chile", None, ", France,Chile", "", "France , Canada"][i // 2 % 6]) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, country string").repartition(6)
    valid = spark.createDataFrame([("France",), ("Canada",), ("Chile",)], "country string")
    langs = spark.createDataFrame([("France", ["French"]), ("Canada", ["English", "French"]), ("Chile", ["Spanish"]), ("Atlantis", ["Old"])],
                                  "country string, Languages array<string>")
    listed = lambda out: sorted((repr(r) for r in out.collect()))
    want = listed(M.enrich_languages(df, valid, langs, mode=mode))
    monkeypatch.setattr(M._enrich_with_join, "__defaults__", (20,))
    got = M.enrich_languages(df, valid, langs, mode=mode, max_lookup_rows=0)
    assert listed(got) == want
    entries = M.list_dictionary(df, M.member_lookup(valid, langs), "country", mode, "Unknown", M.LIST_SEPARATOR)
    assert {r._list: r._times for r in entries.collect()}["France, Canada"] == 200 and entries.count() == 6
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}  # else one task takes all of so few rows
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        dealt = M._join_dictionary(df, entries, "country", 20).where("country = 'France, Canada'")
        sizes = [r["count"] for r in dealt.groupBy(M.F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 200 and max(sizes) < 150
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
