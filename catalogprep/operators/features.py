"""Feature preparation: one-hot, multi-hot, standard scaling, TF-IDF,
calendar features.

Fit steps are small aggregates (label domains, mean/std, vocabulary with
document frequencies); transform steps are projections or joins against
those tables.  Wide indicator columns are for domains that fit a schema (pass
the values, or they are read from the data); the long ``(id, feature, value)``
forms take any domain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalogprep.functions.dates import date_int_parts
from catalogprep.functions.text import ENGLISH_STOP_WORDS, WORD_TOKEN, drop_stop_words, tokens
from catalogprep.operators import terms as T
from catalogprep.operators._common import MAX_WIDE, bounded_domain, parked
from catalogprep.operators.fitted import FeatureSpec, label_domains, label_entries


def one_hot(
    df: DataFrame,
    column: str,
    *,
    prefix: str | None = None,
    values=None,
    drop: bool = True,
    max_values: int | None = None,
) -> DataFrame:
    """``pd.get_dummies(columns=[c], prefix=c, dtype=int)``: one int column per
    value (sorted), NULL -> all zeros, no level dropped."""
    vals = list(values) if values is not None else bounded_domain(df, column, max_values)
    pre = prefix or column
    out = df.withColumns({
        f"{pre}_{v}": F.when(F.col(column) == F.lit(v), 1).otherwise(0) for v in vals
    })
    return out.drop(column) if drop else out


def one_hot_long(df: DataFrame, id_col: str, column: str, *, prefix: str | None = None) -> DataFrame:
    """Sparse one-hot ``(id, feature, value=1)`` — any cardinality."""
    pre = prefix or column
    return df.where(F.col(column).isNotNull()).select(
        id_col, F.concat(F.lit(f"{pre}_"), F.col(column).cast("string")).alias("feature"), F.lit(1).alias("value")
    )


def multi_hot(
    df: DataFrame,
    array_col: str,
    *,
    prefix: str | None = None,
    values=None,
    drop: bool = True,
    max_values: int | None = None,
) -> DataFrame:
    """``MultiLabelBinarizer``: one int column per label (labels sorted)."""
    if values is None:
        labels = df.select(F.explode(array_col).alias("_label"))
        vals = bounded_domain(labels, "_label", max_values)
    else:
        vals = list(values)
    pre = prefix or array_col
    out = df.withColumns({
        f"{pre}_{v}": F.coalesce(F.array_contains(F.col(array_col), F.lit(v)).cast("int"), F.lit(0)) for v in vals
    })
    return out.drop(array_col) if drop else out


def multi_hot_long(df: DataFrame, id_col: str, array_col: str, *, prefix: str | None = None) -> DataFrame:
    """Sparse multi-hot ``(id, feature, value=1)`` — any number of labels."""
    pre = prefix or array_col
    ex = df.select(id_col, F.explode(F.array_distinct(array_col)).alias("_label"))
    return ex.where(F.col("_label").isNotNull()).select(
        id_col, F.concat(F.lit(f"{pre}_"), F.col("_label")).alias("feature"), F.lit(1).alias("value")
    )


def wide_domains(df: DataFrame, categorical=(), lists=(), *, max_wide: int = MAX_WIDE) -> dict[str, list[str] | None]:
    """The sorted labels of each column, or None where there are more than ``max_wide``: one job
    over all columns, of which the driver reads ``max_wide`` + 1 labels a column at most."""
    found: dict[str, list[str] | None] = {c: [] for c in (*categorical, *lists)}
    if not found:
        return found
    counted = label_domains(df, FeatureSpec("", categorical=tuple(categorical), lists=tuple(lists)))
    place = F.row_number().over(Window.partitionBy("column").orderBy("label"))
    for r in counted.withColumn("_k", place).where(F.col("_k") <= max_wide + 1).orderBy("column", "_k").collect():
        found[r.column].append(r.label)
    return {c: None if len(v) > max_wide else v for c, v in found.items()}


def sparse_labels(df: DataFrame, id_col: str, column: str, *, is_list: bool = False) -> DataFrame:
    """``(id, <column>_idx)`` for ids with a label: the sorted places of the row's labels among
    all labels of the column, for domains too wide for columns.  The dictionary of labels
    is written to the shared scratch folder; joins are left to the planner."""
    spec = FeatureSpec(id_col, lists=(column,)) if is_list else FeatureSpec(id_col, categorical=(column,))
    place = (F.row_number().over(Window.partitionBy("column").orderBy("label")) - 1).cast("int")
    dictionary = parked(label_domains(df, spec).select("column", "label", place.alias("_i")), "labels")
    found = label_entries(df, spec, id_col).join(dictionary, ["column", "label"])
    return found.groupBy(id_col).agg(F.array_sort(F.collect_set("_i")).alias(f"{column}_idx"))


def _indicators(base: DataFrame, id_col: str, domains: dict[str, list | None], lists: tuple[str, ...] = ()) -> DataFrame:
    """``base`` with each column of ``domains`` as indicator columns, or, where its domain is None,
    as one column of places."""
    for c, values in domains.items():
        if values is not None:
            base = multi_hot(base, c, values=values) if c in lists else one_hot(base, c, values=values)
        else:
            base = base.drop(c).join(sparse_labels(base, id_col, c, is_list=c in lists), id_col, "left")
    return base


def standard_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """``StandardScaler``: ``(x - mean) / std`` with the **population** std,
    missing values ignored in the fit and kept missing; a zero std divides
    by 1.  The fit is one aggregate, read as scalar subqueries."""
    fit = df.agg(*[
        F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns
    ])
    out = {}
    for c in columns:
        m = fit.select(F.col(f"`{c}`.m")).scalar()
        s = fit.select(F.col(f"`{c}`.s")).scalar()
        scale = F.when(s > 0, s).otherwise(F.lit(1.0))
        out[c] = (F.col(c) - m) / scale
    return df.withColumns(out)


def calendar_features(df: DataFrame, date_col: str, *, prefix: str = "added_", drop: bool = True) -> DataFrame:
    """year / month / day / weekday (Monday = 0) as ints."""
    d = F.to_date(F.col(date_col))
    out = df.withColumns(date_int_parts(d, prefix))
    return out.drop(date_col) if drop else out


def tfidf(
    df: DataFrame,
    id_col: str,
    text_col: str,
    *,
    max_features: int | None = 5_000,
    stop_words=ENGLISH_STOP_WORDS,
    pattern: str = WORD_TOKEN,
    index_col: str | None = None,
) -> DataFrame:
    """TF-IDF in long form ``(id, term, weight)`` with scikit-learn's
    conventions: raw counts, ``idf = ln((1 + n) / (1 + df)) + 1``, the
    vocabulary limited to the ``max_features`` most frequent terms (ties by
    term), rows L2-normalised over the kept terms.

    Shuffles: term counts per (document, term) with a map-side partial
    aggregate; term statistics per term; the norm per document.  The
    vocabulary has a proven bound (``max_features`` rows) and is broadcast.
    ``index_col`` adds each term's 0-based position in the sorted vocabulary.

    ``stop_words`` is any list (Spark's English one by default; give another tool's list
    to leave out the words that it does), or a table with a column ``term``, e.g. of
    :func:`frequent_terms`, which is joined.
    """
    n_docs = df.agg(F.count(F.lit(1))).scalar()
    listed = () if isinstance(stop_words, DataFrame) else stop_words
    toks = drop_stop_words(tokens(text_col, pattern), listed)
    tf = (
        df.select(id_col, F.explode(toks).alias("term"))
        # the join below would add this filter to its branch only; with it in
        # both, the two uses of the counts are one plan and one shuffle
        .where(F.col("term").isNotNull())
        .groupBy(id_col, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    if isinstance(stop_words, DataFrame):
        tf = tf.join(stop_words.select("term").distinct(), "term", "left_anti")
    terms = tf.groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))
    if max_features is not None:
        terms = terms.orderBy(F.desc("total"), F.asc("term")).limit(max_features)
        terms = F.broadcast(terms)
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    vocab = terms.select("term", idf.alias("idf"))
    extra = []
    if index_col:
        if max_features is None:
            raise ValueError("a term index needs a bounded vocabulary (max_features)")
        # <= max_features rows: a global window here is bounded
        vocab = vocab.withColumn(index_col, (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))
        extra = [index_col]
    w = tf.join(vocab, "term").select(id_col, "term", *extra, (F.col("tf") * F.col("idf")).alias("raw"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term", *extra, (F.col("raw") / norm).alias("weight"))


def frequent_terms(df: DataFrame, id_col: str, text_col: str, share: float, *, pattern: str = WORD_TOKEN) -> DataFrame:
    """``(term, df)``: terms that stand in more than ``share`` of the rows, the stop words that a
    corpus has of its own, written to the shared scratch folder (at most ``terms a row / share``)."""
    n = df.agg(F.count(F.lit(1))).scalar()
    each = df.select(F.explode(F.array_distinct(tokens(text_col, pattern))).alias("term"))
    return parked(each.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > F.lit(share) * n), "frequent-terms")


def document_features(
    docs: DataFrame,
    labels: DataFrame | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    categorical: tuple[str, ...] = ("lang", "source"),
    numeric: tuple[str, ...] = ("n_chars",),
    max_features: int = 5_000,
    max_wide: int = MAX_WIDE,
) -> DataFrame:
    """The whole feature chain keyed by id (no row-position alignment):
    one-hot categoricals (places in ``<column>_idx`` where one has more than
    ``max_wide`` labels; one job finds the labels of all), standard-scaled numerics, optional label columns
    joined by key, and the sparse TF-IDF row as aligned ``tfidf_idx`` /
    ``tfidf_val`` arrays over the sorted vocabulary (<= ``max_features``
    entries per row)."""
    base = docs.select(id_col, *categorical, *[F.col(c).cast("double").alias(c) for c in numeric])
    base = _indicators(base, id_col, wide_domains(docs, categorical, max_wide=max_wide))
    base = standard_scale(base, list(numeric))
    if labels is not None:
        base = base.join(labels, id_col, "left")
    return base.join(sparse_text(docs, id_col, text_col, max_features), id_col, "left")


def sparse_text(df: DataFrame, id_col: str, text_col: str, max_features: int = 5_000) -> DataFrame:
    """One sparse TF-IDF row per id: ``tfidf_idx`` / ``tfidf_val``, aligned, in
    vocabulary order (at most ``max_features`` entries): the weights of :func:`tfidf`, made
    within the row, so that no row per id and term is shuffled.  The vocabulary passes through the driver."""
    toks = drop_stop_words(tokens(text_col, WORD_TOKEN))
    docs = T.documents(df.select(id_col, text_col), id_col)
    n_docs = df.agg(F.count(F.lit(1))).scalar()
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    best = T.term_statistics(docs, toks).orderBy(F.desc("total"), F.asc("term")).limit(max_features).select("term", idf.alias("idf"))
    found = sorted((r.term, r.idf) for r in best.collect())  # max_features at most
    rows = T.tfidf_rows(docs, toks, [t for t, _ in found], [w for _, w in found])
    kept = lambda c: F.when(F.size("idx") > 0, F.col(c))
    return rows.select(id_col, kept("idx").alias("tfidf_idx"), kept("val").alias("tfidf_val"))


def title_features(
    titles: DataFrame,
    *,
    categorical: dict[str, list | None],
    lists: dict[str, list | None],
    id_col: str = "show_id",
    numeric: tuple[str, ...] = ("movie_duration", "seasons", "release_year"),
    text_col: str = "description",
    date_col: str = "added_date",
    max_features: int = 5_000,
    max_wide: int = MAX_WIDE,
) -> DataFrame:
    """The feature chain over the clean titles table, keyed by ``id_col`` (one
    row per title): one-hot ``categorical`` and multi-hot ``lists`` columns for
    the values given (where None: those of the table, found in one job for all such
    columns; places in ``<column>_idx`` instead if there are more than ``max_wide``), scaled ``numeric`` columns, calendar parts of the date,
    and the sparse TF-IDF row of the text.  A NULL label or date gives zeros or
    NULL parts; titles without a kept term have NULL TF-IDF arrays."""
    base = titles.select(id_col, *categorical, *lists, date_col, *[F.col(c).cast("double").alias(c) for c in numeric])
    domains = {**categorical, **lists}
    domains |= wide_domains(titles, [c for c, v in categorical.items() if v is None], [c for c, v in lists.items() if v is None], max_wide=max_wide)
    base = _indicators(base, id_col, domains, tuple(lists))
    base = calendar_features(standard_scale(base, list(numeric)), date_col)
    # several steps read the texts; the cleaning before them is done once
    texts = parked(titles.select(id_col, text_col), "texts")
    return base.join(sparse_text(texts, id_col, text_col, max_features), id_col, "left")
