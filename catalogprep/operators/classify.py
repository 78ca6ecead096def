"""Row-level classification and typed parsing of unit strings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogprep.functions.strings import digits_only, remove_unit

MOVIE, SHOW = "Movie", "TV Show"


def reach_classification(
    df: DataFrame,
    *,
    type_col: str = "type",
    genre_col: str = "listed_in",
    marker: str = "International",
    kinds: tuple[tuple[str, str], ...] = ((MOVIE, "movie_type"), (SHOW, "show_type")),
    labels: tuple[str, str] = ("Global", "Local"),
) -> DataFrame:
    """For each (type value, output column): ``Global`` when the genre text
    contains ``marker``, else ``Local`` — and NULL for rows of another type."""
    hit, miss = labels
    return df.withColumns({
        out: F.when(
            F.col(type_col) == kind,
            F.when(F.col(genre_col).contains(marker), hit).otherwise(miss),
        )
        for kind, out in kinds
    })


def reach_type_matrix(
    df: DataFrame,
    *,
    type_col: str = "type",
    reach_cols: tuple[str, ...] = ("movie_type", "show_type"),
    types: tuple[str, ...] = (MOVIE, SHOW),
    names: tuple[str, ...] = ("n_movie", "n_tv_show"),
) -> DataFrame:
    """The 2x2 count matrix reach x type in one aggregate (rows with no
    reach label are left out, as pandas drops null keys)."""
    reach = F.coalesce(*[F.col(c) for c in reach_cols])
    return (
        df.where(reach.isNotNull())
        .groupBy(reach.alias("reach"))
        .agg(*[F.count_if(F.col(type_col) == t).alias(n) for t, n in zip(types, names)])
    )


def split_duration(
    df: DataFrame,
    *,
    type_col: str = "type",
    duration_col: str = "duration",
    minutes_col: str = "movie_duration",
    seasons_col: str = "seasons",
    drop: bool = True,
) -> DataFrame:
    """``'113 min'`` -> minutes for movies, ``'2 Seasons'`` -> seasons for
    shows; NULL for the other type or anything unparsable (``try_cast``)."""
    out = df.withColumns({
        minutes_col: F.when(F.col(type_col) == MOVIE, remove_unit(duration_col, " min").try_cast("int")),
        seasons_col: F.when(F.col(type_col) == SHOW, digits_only(duration_col).try_cast("int")),
    })
    return out.drop(duration_col) if drop else out
