"""Pairs within buckets, without a bucket ever being one unit of work when it is large.

Rows carry a bucket key.  A bucket of more than ``cap`` rows is cut into chunks by a hash
of the row's id, and every two chunks of it (and every chunk with itself) become one unit;
units are dealt over the cluster and each is compared inside numpy, so that pairs are never
rows of a DataFrame: what leaves a unit is one row per member at most."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogprep.llm._common import saved, small_side

CAP = 1024


def to_units(rows: DataFrame, keys: list[str], id_col: str, cap: int = CAP) -> DataFrame:
    """``rows`` with ``chunk``, ``unit_a`` and ``unit_b`` (chunk is one of the two), dealt and
    sorted by key and unit.  Rows of buckets with more than ``cap`` rows are repeated once
    for each chunk of their bucket; no pair of a bucket is left out."""
    hot = saved(rows.groupBy(*keys).count().where(F.col("count") > cap), "hot-buckets")
    n = F.ceil(F.coalesce(F.col("count"), F.lit(1)) / cap)
    cut = (rows.join(small_side(hot), keys, "left")
           .withColumn("chunk", F.pmod(F.xxhash64(F.lit(7), id_col), n).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), (n - 1).cast("int")))))
    return (cut.withColumn("unit_a", F.least("chunk", "other")).withColumn("unit_b", F.greatest("chunk", "other"))
            .drop("count", "other").repartition(*keys, "unit_a", "unit_b")
            .sortWithinPartitions(*keys, "unit_a", "unit_b", "chunk", id_col))


def whole_units(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames that hold whole units only, with the row at which each row's unit ends."""
    cols, rest = [*keys, "unit_a", "unit_b"], None

    def cut(df: pd.DataFrame, last: bool):
        change = np.zeros(len(df), dtype=bool)
        for c in cols:
            v = df[c].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        starts = np.flatnonzero(np.r_[True, change[1:]]) if len(df) else np.zeros(0, dtype=int)
        upto = len(df) if last else (int(starts[-1]) if len(starts) else 0)
        starts = starts[starts < upto]
        ends = np.r_[starts[1:], upto] if len(starts) else starts
        return df.iloc[:upto], np.repeat(ends, np.diff(np.r_[starts, upto])) if upto else np.zeros(0, dtype=int), df.iloc[upto:]

    for b in batches:
        if len(b):
            done, ends, rest = cut(b if rest is None or not len(rest) else pd.concat([rest, b], ignore_index=True), False)
            if len(done):
                yield done, ends
    if rest is not None and len(rest):
        done, ends, _ = cut(rest.reset_index(drop=True), True)
        yield done, ends


def unit_pairs(df: pd.DataFrame, ends: np.ndarray, at_once: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (i, j), i < j, of rows in one unit; across the two chunks where a unit has two."""
    chunk = df["chunk"].to_numpy()
    two = df["unit_a"].to_numpy() != df["unit_b"].to_numpy()
    alive, d, held, n = np.arange(len(df)), 1, [], 0
    while True:
        alive = alive[alive + d < ends[alive]]
        if not len(alive):
            break
        i = alive[~two[alive] | (chunk[alive] != chunk[alive + d])]
        for k in range(0, len(i), at_once):
            part = i[k:k + at_once]
            held.append((part, part + d))
            n += len(part)
            if n >= at_once:
                yield tuple(np.concatenate(x) for x in zip(*held))
                held, n = [], 0
        d += 1
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def forest(n: int, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n rows the first row that it reaches by links."""
    root = np.arange(n)
    if not links:
        return root
    a, b = (np.concatenate(x) for x in zip(*links))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


Verify = Callable[[pd.DataFrame, np.ndarray, np.ndarray], np.ndarray]
