"""Periodic run detection by string synchronising sets.

A run is a stretch of consecutive words with smallest period q, at least two periods long,
that no neighbouring word extends.  The documents of a batch are laid end to end with
unique marks between them, longest first, and all steps are numpy operations over the batch:

1. Word numbers are hashed, and hashes of 2, 4, 8, ... words are made of two halves; they
   give the longest common extension of any two places by bisection.
2. Periods of up to ``DIRECT`` words, which are too short for a scale, are found by
   comparing the words with themselves shifted.
3. At every dyadic scale t a place belongs to the synchronising set if the smallest hash
   among the t-word windows that start in [i, i + t] is the first's or the last's, windows
   of period up to t / 3 left aside.  Whether a place belongs depends on its 2t words only,
   so both ends of a period are chosen alike: two places of the set with equal 2t words, 3t
   up to 6t apart, propose their distance as a period, which is extended to both sides.
4. Where the set has no place, the period's words are themselves highly periodic: two
   neighbouring runs of one shorter period p meet at a break.  The offsets that align the
   two, p apart from each other, are the remaining periods, and are proposed as well.

Proposals whose stretch is shorter than two periods, or that have a shorter period, go.
Texts are independent, so nothing is shuffled.  Memory grows with ``WORDS`` and the longest
text, by some 200 bytes a word.  Equal words have equal numbers; longer stretches are
compared by 64-bit hashes.

Defined results: null and empty texts have no words and no runs; rows repeated with one id
are judged each for itself; other columns do not matter, whatever their names; of equally
long runs the first by start, then by period, is the longest; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogprep.llm._common import read_table, text_of, words

LEAST = 12
DIRECT = 5
WORDS = 400_000
_NO_RUNS = hashlib.sha256(b"").hexdigest()
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=1 << 16)
def _primes(n: int) -> tuple[int, ...]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return (*found, n) if n > 1 else tuple(found)


class _Line:
    """Documents end to end, longest first, with the hashes of all dyadic stretches."""

    def __init__(self, documents: list[np.ndarray]):
        sizes = np.array([len(d) for d in documents], np.int64)
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes = sizes[self.order]
        self.begin = np.r_[0, np.cumsum(self.sizes + 1)[:-1]]
        parts = []
        for k, d in enumerate(self.order.tolist()):
            parts += [documents[d], np.array([-1 - k], np.int64)]
        self.codes = np.concatenate(parts)
        self.levels = [_mixed((self.codes.view(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))]
        k = 1
        while self.upto(1 << k):
            h, half = self.levels[-1], 1 << (k - 1)
            n = max(0, min(self.upto(1 << k), len(h) - half))
            self.levels.append(_mixed(h[:n] * np.uint64(0xD6E8FEB86659FD93) + (h[half:half + n] ^ np.uint64(k))))
            k += 1

    def upto(self, size: int) -> int:
        """Where the documents of at least ``size`` words end."""
        n = int(np.searchsorted(-self.sizes, -size, side="right"))
        return int(self.begin[n - 1] + self.sizes[n - 1] + 1) if n else 0

    def right(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Number of equal words from x and from y (x < y) on."""
        x, y, at = x.copy(), y.copy(), y
        for k in range(len(self.levels) - 1, -1, -1):
            step = self._equal(k, x, y).astype(np.int64) << k
            x += step
            y += step
        return y - at

    def left(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Number of equal words before x and before y (x < y)."""
        x, y, at = x.copy(), y.copy(), y
        for k in range(len(self.levels) - 1, -1, -1):
            step = self._equal(k, x - (1 << k), y - (1 << k)).astype(np.int64) << k
            x -= step
            y -= step
        return at - y

    def _equal(self, k: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        h = self.levels[k]
        inside = (x >= 0) & (y < len(h))
        return inside & (h[np.where(inside, x, 0)] == h[np.where(inside, y, 0)]) if len(h) else inside

    def smallest(self, start: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Whether stretches of two periods or more have no shorter period that divides theirs."""
        who, shorter = [], []
        for i, q in enumerate(period.tolist()):
            for r in _primes(q):
                who.append(i)
                shorter.append(q // r)
        ok = np.ones(len(start), bool)
        if who:
            w = np.array(who)
            ok[w[self.right(start[w], start[w] + np.array(shorter)) >= period[w]]] = False
        return ok

    def grown(self, x: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Runs (start, length, period) around places x that equal x + period; each once."""
        left, right = self.left(x, x + period), self.right(x, x + period)
        whole = left + right >= period
        rows = np.unique(np.column_stack([x - left, left + right + period, period])[whole], axis=0)
        return rows[self.smallest(rows[:, 0], rows[:, 2])]


def _direct(line: _Line, period: int) -> np.ndarray:
    """Runs of a very short period; also those that only matter as highly periodic regions."""
    at = np.flatnonzero(line.codes[:-period] == line.codes[period:])
    if not len(at):
        return np.zeros((0, 3), np.int64)
    first = np.flatnonzero(np.r_[True, np.diff(at) > 1])
    n = np.diff(np.r_[first, len(at)])
    rows = np.column_stack([at[first], n + period, np.full(len(n), period)])[n + period >= min(LEAST, max(4, 3 * period))]
    return rows[line.smallest(rows[:, 0], rows[:, 2])]


def _synchronised(line: _Line, t: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances, 3t up to 6t, that the synchronising set of scale t proposes."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    k = t.bit_length() - 1
    if len(line.levels) < k + 2:
        return none
    h = line.levels[k][:line.upto(6 * t)]
    if len(h) <= t:
        return none
    periodic = known[(known[:, 2] * 3 <= t) & (known[:, 1] >= t)]
    if len(periodic):
        cover = np.zeros(len(line.codes) + 1, np.int32)
        np.add.at(cover, periodic[:, 0], 1)
        np.add.at(cover, periodic[:, 0] + periodic[:, 1] - t + 1, -1)
        h = np.where(np.cumsum(cover[:len(h)]) > 0, _TOP, h)
    low, width = h, 1
    while width < t + 1:
        step = min(width, t + 1 - width)
        low, width = np.minimum(low[:-step], low[step:]), width + step
    around = line.levels[k + 1]
    n = min(len(low), len(around))
    low = low[:n]
    place = np.flatnonzero(((low == h[:n]) | (low == h[t:t + n])) & (low != _TOP))
    context = around[place]
    order = np.argsort(context)
    same = context[order][1:] == context[order][:-1]
    order = order[np.r_[same, False] | np.r_[False, same]] if len(order) else order
    place, context = place[order], context[order]
    order = np.lexsort((place, context))
    place, context = place[order], context[order]
    xs, ds, m = [], [], 1
    while m < len(place):
        d = place[m:] - place[:-m]
        near = (context[m:] == context[:-m]) & (d < 6 * t)
        if not near.any():
            break
        take = near & (d >= 3 * t)
        xs.append(place[:-m][take])
        ds.append(d[take])
        m += 1
    return (np.concatenate(xs), np.concatenate(ds)) if xs else none


def _at_breaks(line: _Line, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances proposed where two highly periodic runs of one period meet."""
    rows = known[known[:, 1] >= 9 * known[:, 2] - 1]
    rows = rows[np.lexsort((rows[:, 0], rows[:, 2]))]
    meets = np.flatnonzero((rows[1:, 2] == rows[:-1, 2]) & (rows[1:, 0] <= rows[:-1, 0] + rows[:-1, 1]))
    xs, ds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in meets.tolist():
        (b, n, p), (b2, n2, _) = rows[i].tolist(), rows[i + 1].tolist()
        x = b + n - p - np.arange(p)
        x = x[(x >= b) & (x < b2)]
        aligned = x[line.right(x, np.full(len(x), b2)) >= p]
        if len(aligned):
            q = np.arange((b2 - int(aligned[0])) % p, min(n, n2) + 1, p)
            q = q[q >= 9 * p]
            xs.append(np.maximum(b, b2 - q))
            ds.append(q)
    return np.concatenate(xs), np.concatenate(ds)


def find_runs(documents: list[np.ndarray], least: int = LEAST) -> np.ndarray:
    """Rows (document, start, length, period), in that order, of all runs of at least
    ``least`` words and two periods; documents are arrays of word numbers from 0 on."""
    if not documents or not max(map(len, documents)):
        return np.zeros((0, 4), np.int64)
    line = _Line(documents)
    with np.errstate(over="ignore"):
        known = np.concatenate([_direct(line, q) for q in range(1, min(DIRECT, len(line.codes) - 1) + 1)])
        t = 2
        while 6 * t <= line.sizes[0]:
            x, d = _synchronised(line, t, known)
            if len(x):
                known = np.concatenate([known, line.grown(x, d)])
            t *= 2
        x, d = _at_breaks(line, known)
        if len(x):
            known = np.concatenate([known, line.grown(x, d)])
    known = np.unique(known[known[:, 1] >= np.maximum(least, 2 * known[:, 2])], axis=0)
    nth = np.searchsorted(line.begin, known[:, 0], side="right") - 1
    rows = np.column_stack([line.order[nth], known[:, 0] - line.begin[nth], known[:, 1:]])
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _parts(texts: list[str | None]):
    """(first text, words of each text, their runs by text) of parts of about ``WORDS`` words."""
    part, held, first = [], 0, 0
    for i, t in enumerate(texts):
        part.append((t or "").encode().split())
        held += len(part[-1])
        if held >= WORDS or i + 1 == len(texts):
            numbers = _Numbers()
            rows = find_runs([np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in part])
            cuts = np.searchsorted(rows[:, 0], np.arange(len(part) + 1))
            yield first, part, [rows[a:b, 1:] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
            part, held, first = [], 0, i + 1


def _kept(word_list: list[bytes], found: np.ndarray) -> list[bytes]:
    """Words that no run holds after its first period."""
    if not len(found):
        return word_list
    cover = np.zeros(len(word_list) + 1, np.int64)
    np.add.at(cover, found[:, 0] + found[:, 2], 1)
    np.add.at(cover, found[:, 0] + found[:, 1], -1)
    return [word_list[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()]


def runs(docs: DataFrame) -> DataFrame:
    """doc_id, start, length, period of every run of every whole text (words from 0)."""
    @F.pandas_udf("array<struct<start:long,length:long,period:long>>")
    def found(texts: pd.Series) -> pd.Series:
        out = []
        for _, _, by_text in _parts(texts.tolist()):
            out += [[dict(zip(("start", "length", "period"), r)) for r in rows.tolist()] for rows in by_text]
        return pd.Series(out, dtype=object)

    return docs.select("doc_id", F.explode(found("text")).alias("run")).select("doc_id", "run.*")


def collapse(docs: DataFrame) -> DataFrame:
    """``docs`` with every run cut to its first period: kept words joined by one space where
    something went, the text as it was elsewhere."""
    @F.pandas_udf("string")
    def shorter(texts: pd.Series) -> pd.Series:
        out = texts.tolist()
        for first, part, by_text in _parts(texts.tolist()):
            for i, (w, rows) in enumerate(zip(part, by_text)):
                if len(rows):
                    out[first + i] = b" ".join(_kept(w, rows)).decode()
        return pd.Series(out, dtype=object)

    return docs.withColumn("text", shorter("text"))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run's start, length, period and exponent_milli (null
    without one), runs_sha256 of all runs as lines, collapsed_sha256 of the kept words."""
    fields = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    @F.pandas_udf("n_runs long, start long, length long, period long, exponent_milli long, "
                  "runs_sha256 string, collapsed_sha256 string")
    def digest(texts: pd.Series) -> pd.DataFrame:
        out = []
        for _, part, by_text in _parts(texts.tolist()):
            for w, rows in zip(part, by_text):
                listed, longest = _NO_RUNS, (None,) * 4
                if len(rows):
                    s, n, q = rows[np.lexsort((rows[:, 2], rows[:, 0], -rows[:, 1]))[0]].tolist()
                    longest = s, n, q, 1000 * n // q
                    lines = "".join(f"{a},{b},{c}\n" for a, b, c in rows.tolist())
                    listed = hashlib.sha256(lines.encode()).hexdigest()
                out.append((len(rows), *longest, listed, hashlib.sha256(b" ".join(_kept(w, rows))).hexdigest()))
        df = pd.DataFrame(out, columns=fields)
        return df.astype({c: "Int64" for c in fields[:5]} | {c: object for c in fields[5:]})

    return docs.select("doc_id", digest("text").alias("d")).select("doc_id", "d.*")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents, by the CRC-32 of their id, go on
    periodically from some word on; rows without an id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    rows = docs.select("doc_id", text_of().alias("text"), h.alias("h"), g.alias("g"))
    w = rows.select("doc_id", "text", "g", F.when(F.col("h") % 10 == 0, words(F.col("text"))).alias("w"))
    n = F.size("w")
    a = F.col("g") % n
    p = 1 + F.floor((n - a) / (3 + F.col("g") % 8))
    periodic = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(
        F.col("w"), F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    some = F.col("w").isNotNull() & (n > 0)
    w = w.withColumns({"a": F.when(some, a), "p": F.when(some, p)})
    return w.select("doc_id", F.when(some, F.array_join(periodic, " ")).otherwise(F.col("text")).alias("text"))


def query(spark, sf_dir: str) -> DataFrame:
    return digests(with_planted_runs(read_table(spark, sf_dir, "documents")))
