"""Multi-valued attributes: split, explode, validate against a reference
list, enrich with languages from a lookup.

Design (scale): the two lookups (valid countries, country -> languages) are
dimensions bounded by the number of countries.  They are folded into one
member-info table and, behind a checked row bound, into a single map value
(scalar subquery, evaluated once and shipped to every task like a broadcast;
lookups in a map value scan its keys, hence a bound of ``MAP_LOOKUP_MAX_ROWS``).
Each title then resolves its own members with higher-order functions —
no explode / join / group-back round trip and no shuffle except the final
full-row de-duplication the semantics require.  The data-wide language
union of the ``['Unknown']`` rows rides that same de-duplication as marker
rows, so the input is read once (see :func:`_finish_compat`).  Above the
bound the distinct lists are resolved by a join, each once, and joined back.

``mode="compat"`` reproduces the published job exactly:

1. every listed country is one exploded row; a member absent from the valid
   list turns its row's list into ``['Unknown']``, valid members keep the
   whole original list;
2. rows whose member has no lookup entry vanish (inner join);
3. languages are unioned per list value, so all ``['Unknown']`` rows share
   one global union (over every invalid-but-mapped member in the data);
4. the exploded member is dropped and full rows are de-duplicated.

So a title yields at most two rows: ``(its list, union of languages of its
valid+mapped members)`` and ``(['Unknown'], global union)``.  Languages are
sorted (the published job leaves their order to shuffle timing).

``mode="keep_all"`` keeps one row per title: invalid members become
``'Unknown'`` in place (deduplicated), languages come from valid+mapped
members, and an empty language list is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogprep.functions.strings import LIST_SEPARATOR, split_list, strip_leading_comma
from catalogprep.operators._common import parked

UNKNOWN = "Unknown"

#: Largest member table resolved per row from one map value.  Spark looks a
#: key up in a map value by scanning its keys, so the map path is only cheap
#: for small lookups (country lists have a few hundred entries); larger
#: lookups use the dictionary of distinct lists.
MAP_LOOKUP_MAX_ROWS = 1_000


def _empty() -> Column:
    return F.array().cast("array<string>")


def member_list(c: str | Column, pattern: str = LIST_SEPARATOR) -> Column:
    """Comma list text -> array, after removing a stray leading comma."""
    return split_list(strip_leading_comma(c), pattern)


def explode_members(
    df: DataFrame,
    list_col: str = "country",
    *,
    member_col: str = "country",
    lists_col: str = "countries",
    outer: bool = True,
    pattern: str = LIST_SEPARATOR,
) -> DataFrame:
    """Split ``list_col`` into ``lists_col`` and explode it into
    ``member_col`` (one row per member; ``outer`` keeps null/empty lists)."""
    members = member_list(list_col, pattern)
    gen = F.explode_outer if outer else F.explode
    return df.withColumn(lists_col, members).withColumn(member_col, gen(lists_col))


def _distinct_valid(valid_df: DataFrame, valid_col: str) -> DataFrame:
    return (
        valid_df.select(F.col(valid_col).alias("_valid_name"))
        .where(F.col("_valid_name").isNotNull())
        .distinct()
    )


def invalid_members(
    exploded: DataFrame,
    valid_df: DataFrame,
    *,
    member_col: str = "country",
    valid_col: str = "country",
) -> DataFrame:
    """Distinct members with no match in the valid list (left anti join; a
    NULL member never matches, so it is reported too).  Stays distributed:
    distinct first (partial aggregation), then the anti join."""
    members = exploded.select(F.col(member_col).alias(member_col)).distinct()
    valid = _distinct_valid(valid_df, valid_col)
    return members.join(valid, members[member_col] == valid["_valid_name"], "left_anti")


def flag_invalid_members(
    exploded: DataFrame,
    valid_df: DataFrame,
    *,
    member_col: str = "country",
    lists_col: str = "countries",
    out_col: str = "country_clean",
    valid_col: str = "country",
    unknown: str = UNKNOWN,
    drop_lists: bool = True,
) -> DataFrame:
    """Per exploded row: ``['Unknown']`` when the member is not valid, else
    the whole original list (a NULL member keeps its list, as ``isin`` with
    a NULL result falls to the ``otherwise`` branch).  The list is joined as
    a left-join flag, not collected to the driver."""
    # the planner (or AQE, by bytes at run time) decides on a broadcast
    valid = _distinct_valid(valid_df, valid_col).withColumn("_is_valid", F.lit(True))
    joined = exploded.join(valid, exploded[member_col] == valid["_valid_name"], "left")
    bad = F.col(member_col).isNotNull() & F.col("_is_valid").isNull()
    out = joined.withColumn(
        out_col, F.when(bad, F.array(F.lit(unknown))).otherwise(F.col(lists_col))
    ).drop("_valid_name", "_is_valid")
    return out.drop(lists_col) if drop_lists and lists_col != out_col else out


def member_lookup(
    valid_df: DataFrame,
    lang_map_df: DataFrame,
    *,
    valid_col: str = "country",
    country_col: str = "country",
    languages_col: str = "Languages",
) -> DataFrame:
    """One row per known country: ``country, is_valid, is_mapped, languages``
    (languages of duplicate lookup entries are unioned and sorted)."""
    valid = valid_df.select(
        F.col(valid_col).alias("country"), F.lit(True).alias("_v"), F.lit(False).alias("_m"), _empty().alias("_l")
    )
    mapped = lang_map_df.select(
        F.col(country_col).alias("country"), F.lit(False).alias("_v"), F.lit(True).alias("_m"),
        F.coalesce(F.col(languages_col), _empty()).alias("_l"),
    )
    # one aggregate over both lookups (a single small shuffle)
    return (
        valid.unionByName(mapped)
        .where(F.col("country").isNotNull())
        .groupBy("country")
        .agg(
            F.max("_v").alias("is_valid"),
            F.max("_m").alias("is_mapped"),
            _sorted_union(F.collect_list("_l")).alias("languages"),
        )
    )


def _lookup_map(info: DataFrame) -> Column:
    """The member table as one ``map<country, struct>`` value (scalar subquery)."""
    entry = F.struct("country", F.struct("is_valid", "is_mapped", "languages"))
    return info.agg(F.map_from_entries(F.collect_list(entry))).scalar()


def _sorted_union(arrays: Column) -> Column:
    """Distinct non-null elements of all the arrays, sorted (a null language is no language)."""
    return F.array_sort(F.array_distinct(F.array_compact(F.flatten(arrays))))


def _none_if_empty(a: Column) -> Column:
    return F.when(F.size(a) > 0, a)


def enrich_languages(
    df: DataFrame,
    valid_df: DataFrame,
    lang_map_df: DataFrame,
    *,
    list_col: str = "country",
    countries_out: str = "released_countries",
    languages_out: str = "released_languages",
    mode: str = "compat",
    unknown: str = UNKNOWN,
    pattern: str = LIST_SEPARATOR,
    valid_col: str = "country",
    country_col: str = "country",
    languages_col: str = "Languages",
    max_lookup_rows: int = MAP_LOOKUP_MAX_ROWS,
) -> DataFrame:
    """Validate the comma list in ``list_col`` and add languages.

    Returns ``df`` without ``list_col`` plus ``countries_out`` and
    ``languages_out`` (both ``array<string>``); see the module docstring for
    the two modes.  ``compat`` ends with a full-row de-duplication.
    ``max_lookup_rows`` bounds the member table resolved per row from a map
    value; above it each distinct list is resolved by a join, and joined back.  Both paths give the same rows:
    a NULL list stays NULL in both outputs of ``keep_all`` and has no row in
    ``compat``; NULL languages of the lookup are left out.
    """
    if mode not in ("compat", "keep_all"):
        raise ValueError(f"unknown mode {mode!r}")
    info = member_lookup(
        valid_df, lang_map_df, valid_col=valid_col, country_col=country_col, languages_col=languages_col
    )
    others = [c for c in df.columns if c != list_col]
    if info.agg(F.count(F.lit(1))).first()[0] <= max_lookup_rows:
        return _enrich_with_map(df, info, others, list_col, countries_out, languages_out, mode, unknown, pattern)
    return _enrich_with_join(df, info, others, list_col, countries_out, languages_out, mode, unknown, pattern)


def _enrich_with_map(df, info, others, list_col, countries_out, languages_out, mode, unknown, pattern):
    # The lookup value is projected once as a column: subqueries may not sit
    # inside higher-order functions, column references may.
    df = df.withColumn("_lookup", _lookup_map(info))
    lookup = F.col("_lookup")
    # members and their lookups are projected once: every later expression
    # refers to them several times, and higher-order functions run
    # interpreted, so an inlined copy would be re-evaluated per reference
    df = df.withColumn("_members", member_list(list_col, pattern))
    members = F.col("_members")
    df = df.withColumn(
        "_infos", F.transform(members, lambda c: F.struct(c.alias("c"), F.try_element_at(lookup, c).alias("i")))
    )
    infos = F.col("_infos")
    valid = lambda x: F.coalesce(x["i"]["is_valid"], F.lit(False))
    mapped = lambda x: F.coalesce(x["i"]["is_mapped"], F.lit(False))
    good = F.filter(infos, lambda x: valid(x) & mapped(x))
    good_langs = _sorted_union(F.transform(good, lambda x: x["i"]["languages"]))

    if mode == "keep_all":
        cleaned = F.array_distinct(F.transform(infos, lambda x: F.when(valid(x), x["c"]).otherwise(F.lit(unknown))))
        return df.select(*others, cleaned.alias(countries_out), good_langs.alias(languages_out))

    unknown_list = F.array(F.lit(unknown))
    is_unknown_list = members == unknown_list
    to_unknown = lambda x: mapped(x) & (~valid(x) | is_unknown_list)

    routed_langs = _sorted_union(F.transform(F.filter(infos, to_unknown), lambda x: x["i"]["languages"]))
    has_own = (F.size(good) > 0) & ~is_unknown_list
    has_unknown = F.exists(infos, to_unknown)
    no_list = F.lit(None).cast("array<string>")
    rows = F.concat(
        F.filter(
            F.array(
                F.when(has_own, F.struct(members.alias("_rc"), _none_if_empty(good_langs).alias("_rl"),
                                         F.lit(False).alias("_b"), F.lit(False).alias("_m"))),
                F.when(has_unknown, F.struct(unknown_list.alias("_rc"), no_list.alias("_rl"),
                                             F.lit(True).alias("_b"), F.lit(False).alias("_m"))),
            ),
            lambda r: r.isNotNull(),
        ),
        # one marker per routed language (feeds the data-wide union)
        F.transform(routed_langs, lambda lang: F.struct(no_list.alias("_rc"), F.array(lang).alias("_rl"),
                                                        F.lit(False).alias("_b"), F.lit(True).alias("_m"))),
    )
    pre = df.select(*others, F.explode(rows).alias("_r")).select(
        *[F.when(~F.col("_r._m"), F.col(c)).alias(c) for c in others], "_r.*"
    )
    return _finish_compat(pre, others, countries_out, languages_out)


def _finish_compat(pre: DataFrame, others: list[str], countries_out: str, languages_out: str) -> DataFrame:
    """De-duplicate and give every ``['Unknown']`` row the data-wide language
    union, reading the input once.

    ``pre`` holds the candidate rows — ``_rc`` (list), ``_rl`` (languages of
    an own-list row), ``_b`` (an ``['Unknown']`` row) — plus marker rows
    (``_m``) carrying one routed language each with every other column NULL.
    The full-row de-duplication (a hash aggregate with a map-side partial
    step) collapses the markers to one per language, so a language present
    in every row still costs one row per task.  The union is a one-row
    aggregate of the de-duplicated markers (the planner reuses the same
    shuffle instead of re-reading the input), joined back on the ``_b`` flag
    as a one-row broadcast — an equi-join, not a cross join.
    """
    # The de-duplication groups on every visible column; the marker flag is
    # an aggregate output (max), so filters on it are never pushed below the
    # aggregate, and both consumers below share one shuffle of the input.
    # (A marker never collides with a real row: its list column is NULL.)
    deduped = pre.groupBy(*others, "_rc", "_rl", "_b").agg(F.max("_m").alias("_mm"))
    union = deduped.agg(
        _sorted_union(F.collect_list(F.when(F.col("_mm"), F.col("_rl")))).alias("_u"),
        F.max("_mm").alias("_k"),  # from the data, not a literal: keeps an equi-join
    )
    j = deduped.join(F.broadcast(union), deduped["_b"] == union["_k"], "left")
    return j.where(~F.col("_mm")).select(
        *others,
        F.col("_rc").alias(countries_out),
        F.when(F.col("_b"), _none_if_empty(F.col("_u"))).otherwise(F.col("_rl")).alias(languages_out),
    )


def list_dictionary(df: DataFrame, info: DataFrame, list_col: str, mode: str, unknown: str, pattern: str) -> DataFrame:
    """``(list, times, members, ...)``: every distinct list value of ``df`` resolved once against the
    member table, with the number of rows that hold it.

    Lists are counted first (a partial aggregate), so members are exploded and joined once per
    distinct list, not per row; what is regrouped is a list's few members."""
    lists = df.where(F.col(list_col).isNotNull()).groupBy(F.col(list_col).alias("_list")).agg(F.count(F.lit(1)).alias("_times"))
    members = member_list("_list", pattern)
    ex = lists.select("_list", "_times", members.alias("_m"), F.posexplode_outer(members).alias("_p", "_c"))
    j = ex.join(info, ex["_c"] == info["country"], "left").drop("country")
    valid = F.coalesce("is_valid", F.lit(False))
    mapped = F.coalesce("is_mapped", F.lit(False))
    good = valid & mapped
    kept = [F.any_value("_times").alias("_times"), F.any_value("_m").alias("_m"),
            _sorted_union(F.collect_list(F.when(good, F.col("languages")))).alias("_langs")]
    if mode == "keep_all":
        cleaned_member = F.when(valid, F.col("_c")).otherwise(F.lit(unknown))
        per = j.groupBy("_list").agg(*kept, F.array_sort(F.collect_list(F.struct("_p", cleaned_member.alias("v")))).alias("_pairs"))
        return per.select("_list", "_times", "_langs", F.array_distinct(F.transform("_pairs", lambda s: s["v"])).alias("_cleaned"))
    is_unknown_list = F.col("_m") == F.array(F.lit(unknown))
    to_unknown = mapped & (~valid | is_unknown_list)
    return j.groupBy("_list").agg(
        *kept, F.max(good & ~is_unknown_list).alias("_own"), F.max(to_unknown).alias("_unk"),
        _sorted_union(F.collect_list(F.when(to_unknown, F.col("languages")))).alias("_routed"))


#: Rows of one list value that a task of the join with the dictionary gets at most.
ROWS_PER_SALT = 100_000


def _join_dictionary(df: DataFrame, entries: DataFrame, list_col: str, rows_per_salt: int) -> DataFrame:
    """``df`` beside its lists' entries; a list held by very many rows is dealt over a salt.
    Joins are the planner's, by the sizes of the tables as written."""
    salts = F.ceil(F.col("_times") / rows_per_salt).cast("int")
    hot = entries.where(F.col("_times") > rows_per_salt).select(F.col("_list").alias("_hot"), salts.alias("_salts"))
    # by the rows' other columns, not at random: a task that is run again deals alike
    spread_by = [f.name for f in df.schema.fields if f.name != list_col and "map<" not in f.dataType.simpleString()]
    salt = F.pmod(F.xxhash64(F.lit(7), *spread_by), F.coalesce("_salts", F.lit(1))).cast("int")
    dealt = df.join(hot, df[list_col] == hot["_hot"], "left").withColumn("_salt", salt).drop("_hot", "_salts")
    salted = entries.withColumn("_entry_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_times")
    on = (dealt[list_col] == salted["_list"]) & (dealt["_salt"] == salted["_entry_salt"])
    return dealt.join(salted, on, "left").drop("_salt", "_entry_salt", "_list")


def _enrich_with_join(df, info, others, list_col, countries_out, languages_out, mode, unknown, pattern, rows_per_salt=ROWS_PER_SALT):
    """Same semantics when the lookup is too large to ship whole: a dictionary of the distinct
    lists (written to the shared scratch folder), joined back to the rows."""
    entries = parked(list_dictionary(df, info, list_col, mode, unknown, pattern), "list-dictionary")
    j = _join_dictionary(df, entries, list_col, rows_per_salt)
    if mode == "keep_all":
        return j.select(*others, F.col("_cleaned").alias(countries_out), F.col("_langs").alias(languages_out))
    unknown_list = F.array(F.lit(unknown))
    no_list = F.lit(None).cast("array<string>")
    rows = F.concat(
        F.filter(
            F.array(
                F.when(F.col("_own"), F.struct(F.col("_m").alias("_rc"), _none_if_empty(F.col("_langs")).alias("_rl"),
                                               F.lit(False).alias("_b"), F.lit(False).alias("_m"))),
                F.when(F.col("_unk"), F.struct(unknown_list.alias("_rc"), no_list.alias("_rl"),
                                               F.lit(True).alias("_b"), F.lit(False).alias("_m"))),
            ),
            lambda r: r.isNotNull(),
        ),
        F.transform("_routed", lambda lang: F.struct(no_list.alias("_rc"), F.array(lang).alias("_rl"),
                                                     F.lit(False).alias("_b"), F.lit(True).alias("_m"))),
    )
    pre = j.select(*others, F.explode(rows).alias("_r")).select(
        *[F.when(~F.col("_r._m"), F.col(c)).alias(c) for c in others], "_r.*"
    )
    return _finish_compat(pre, others, countries_out, languages_out)
