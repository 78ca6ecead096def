"""Substring de-duplication: words covered by a window that also stands somewhere else go.

Suffix automata of reference shards give matching statistics; a maximal span whose every
window of ``window`` words matches text at another place is removed.  As the reference is the corpus
itself and grows with it, the automata are not broadcast as a whole: a shard is routed to
the task that streams the text that can match it.

1. Every window has one seed: among its short word runs the one with the smallest hash.
   Equal windows have equal seeds, so a window can only repeat if its seed does.  Seeds are
   counted over the corpus, and only documents with repeated seeds go on.
2. The windows of one seed occurrence are consecutive; their words are its context.  Each
   window lies in one context only.  Equal contexts are one, with a count.
3. A seed's contexts are a reference shard: its automaton is built, the contexts are
   streamed through it, and wherever at least ``window`` words match, the count of the state
   tells whether the window starts at another place as well.  A seed with more than ``shard`` different
   contexts (text around a passage that very many documents share) is not put in one task:
   its windows are counted one by one in a grouped aggregate instead, which is exact too.
4. Spans go back to their documents, judged on the input.

Seeds, contexts and windows that very many places share are dealt over a salt in the joins.

Seeds are computed twice, for their counts and for the places of the repeated ones, rather
than written; texts are compressed before they are shuffled to their seeds and spans.

Defined results: null and empty texts have no words; rows repeated with one id and text
are two places, so their windows repeat; documents shorter than a window stay whole; an
empty table gives an empty result.  Extra columns are kept by ``remove`` and do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogprep.llm._common import read_table, salted_join, saved, small_side

WINDOW = 35
SEED_WORDS = 8
SHARD = 512


class SuffixAutomaton:
    """Suffix automaton of several sequences, with the number of places of each state."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.places = [-1], [0], [0]

    def _state(self, length: int, follow: dict, link: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        self.places.append(0)
        return len(self.next) - 1

    def _split(self, p: int, c, q: int) -> int:
        """The state for p's longest string plus c: q, or a copy of it that is as short."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, c) -> int:
        if c in self.next[last]:
            return self._split(last, c, self.next[last][c])
        cur, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p >= 0:
            self.link[cur] = self._split(p, c, self.next[p][c])
        return cur

    def add(self, sequence) -> None:
        last = 0
        for c in sequence:
            last = self._extend(last, c)

    def count(self, sequences, weights) -> None:
        """Places of every state, for sequences that were added, each ``weight`` times."""
        for sequence, weight in zip(sequences, weights):
            state = 0
            for c in sequence:
                state = self.next[state][c]
                self.places[state] += weight
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.places[self.link[s]] += self.places[s]

    def repeated(self, sequence, window: int) -> list[int]:
        """Starts of the windows of ``sequence`` that the automaton knows at two places or
        more, from the matching statistics (longest match that ends at each word)."""
        found, state, matched = [], 0, 0
        for i, c in enumerate(sequence):
            while state and c not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if c in self.next[state]:
                state, matched = self.next[state][c], matched + 1
            if matched >= window:
                s = state
                while self.length[self.link[s]] >= window:
                    s = self.link[s]
                if self.places[s] >= 2:
                    found.append(i - window + 1)
        return found


def seeds(words: list[bytes], window: int = WINDOW, run: int = SEED_WORDS):
    """Seed hash, first window and number of windows of every seed occurrence."""
    n = len(words) - window + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    m = len(words) - run + 1
    with np.errstate(over="ignore"):
        g = h[:m].copy()
        for j in range(1, run):
            g = g * np.uint64(0x9E3779B97F4A7C15) + h[j:m + j]
        g ^= g >> np.uint64(31)
        g *= np.uint64(0xBF58476D1CE4E5B9)
        g ^= g >> np.uint64(29)
    # position of the smallest hash in every window's runs, the first of equal ones
    at, width, span = np.arange(m), 1, window - run + 1
    while width < span:
        step = min(width, span - width)
        a, b = at[:len(at) - step], at[step:]
        at, width = np.where(g[b] < g[a], b, a), width + step
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return g[at[first]], first, np.diff(np.r_[first, n])


def _keyed(docs: DataFrame) -> DataFrame:
    """A document's key: its id and a hash of its text (equal rows share it)."""
    return docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))),
                             "__th": F.xxhash64("text")})


def _packed(c: str) -> Column:
    """Texts compressed for a shuffle; null stays null."""
    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        pack = zstandard.ZstdCompressor(level=1).compress
        return pd.Series([None if t is None else pack(t.encode()) for t in texts], dtype=object)

    return packed(c)


def _unpacked(packed: bytes | None) -> bytes:
    return b"" if packed is None else zstandard.ZstdDecompressor().decompress(packed)


def _seed_rows(docs: DataFrame, window: int) -> DataFrame:
    def run(batches):
        for b in batches:
            ids, ths, parts = [], [], []
            for i, th, text in zip(b["__id"], b["__th"], b["text"]):
                s = seeds((text or "").encode().split(), window)
                if len(s[0]):
                    ids.append(np.full(len(s[0]), i))
                    ths.append(np.full(len(s[0]), th))
                    parts.append(s)
            if parts:
                h, p, n = (np.concatenate(x) for x in zip(*parts))
                yield pd.DataFrame({"__id": np.concatenate(ids), "__th": np.concatenate(ths), "seed": h.view(np.int64),
                                    "start": p.astype(np.int32), "n": n.astype(np.int32)})

    return docs.select("__id", "__th", "text").mapInPandas(run, "__id long, __th long, seed long, start int, n int")


def _contexts(docs: DataFrame, window: int) -> DataFrame:
    """Contexts of the repeated seeds of each document (column ``at``)."""
    def run(batches):
        for b in batches:
            out = []
            for i, th, packed, at in zip(b["__id"], b["__th"], b["__text"], b["at"]):
                words = _unpacked(packed).split()
                for x in at:
                    start, n = x["start"], x["n"]
                    context = b" ".join(words[start:start + n + window - 1])
                    out.append((i, th, start, x["seed"], xxhash.xxh64_intdigest(context, 1) - (1 << 63), context.decode()))
            if out:
                yield pd.DataFrame(out, columns=["__id", "__th", "start", "seed", "cid", "context"]).astype({"context": object})

    return docs.select("__id", "__th", "__text", "at").mapInPandas(
        run, "__id long, __th long, start int, seed long, cid long, context string")


def _judged_by_automata(contexts: DataFrame, window: int) -> DataFrame:
    """(seed, cid, mask): bit i is set if the context's i-th window also stands elsewhere."""
    def shard(rows: list) -> list:
        sequences = [r[2].split(" ") for r in rows]
        if len(rows) == 1:
            n = len(sequences[0]) - window + 1
            return [(rows[0][0], rows[0][1], (1 << n) - 1)] if rows[0][3] > 1 else []
        automaton = SuffixAutomaton()
        for s in sequences:
            automaton.add(s)
        automaton.count(sequences, [r[3] for r in rows])
        masks = ((r, sum(1 << i for i in automaton.repeated(s, window))) for r, s in zip(rows, sequences))
        return [(r[0], r[1], mask) for r, mask in masks if mask]

    def run(batches):
        held: list = []
        for b in batches:
            out = []
            for row in zip(b["seed"].tolist(), b["cid"].tolist(), b["context"].tolist(), b["n"].tolist()):
                if held and held[0][0] != row[0]:
                    out += shard(held)
                    held = []
                held.append(row)
            yield pd.DataFrame(out, columns=["seed", "cid", "mask"]).astype("int64")
        if held:
            yield pd.DataFrame(shard(held), columns=["seed", "cid", "mask"]).astype("int64")

    return (contexts.select("seed", "cid", "context", "n").repartition("seed").sortWithinPartitions("seed", "cid")
            .mapInPandas(run, "seed long, cid long, mask long"))


def _judged_by_counts(contexts: DataFrame, window: int) -> DataFrame:
    """The same for seeds with very many contexts: every window is counted by itself."""
    w = F.split("context", " ")
    each = contexts.select("seed", "cid", "n", w.alias("w")).select(
        "seed", "cid", "n", F.explode(F.sequence(F.lit(0), F.size("w") - window)).alias("i"), "w").select(
        "seed", "cid", "n", "i", F.array_join(F.slice("w", F.col("i") + 1, window), " ").alias("words"))
    known = each.groupBy("seed", "words").agg(F.sum("n").alias("places"), F.count("*").alias("rows")).where("places > 1").drop("places")
    return (salted_join(each, saved(known, "windows"), ["seed", "words"], "rows", ["cid", "i"]).groupBy("seed", "cid")
            .agg(F.bit_or(F.expr("shiftleft(1L, i)")).alias("mask")))


def repeated_windows(docs: DataFrame, window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    """(__id, __th, __runs): for documents with repeated windows, structs (start, mask) whose
    mask's bit i stands for the window that starts i words after start."""
    docs = docs.select("__id", "__th", "text")
    found = _seed_rows(docs, window)
    again = saved(found.groupBy("seed").agg(F.count("*").alias("rows")).where("rows > 1"), "seeds")
    listed = (salted_join(found, again, ["seed"], "rows", ["__id", "__th", "start"]).groupBy("__id", "__th")
              .agg(F.collect_set(F.struct("start", "n", "seed")).alias("at")))
    texts = docs.select("__id", "__th", _packed("text").alias("__text"))
    occurrences = saved(_contexts(texts.join(listed, ["__id", "__th"]), window), "contexts")
    contexts = saved(occurrences.groupBy("seed", "cid", "context").agg(F.count("*").alias("n")), "shards")
    hot = saved(contexts.groupBy("seed").count().where(F.col("count") > shard).select("seed"), "hot-seeds")
    hot = small_side(hot)
    masks = (_judged_by_automata(contexts.join(hot, "seed", "left_anti"), window)
             .unionByName(_judged_by_counts(contexts.join(hot, "seed", "left_semi"), window)))
    masks = saved(masks.join(contexts.select("seed", "cid", "n"), ["seed", "cid"]), "masks")
    places = occurrences.select("__id", "__th", "start", "seed", "cid")
    return (salted_join(places, masks, ["seed", "cid"], "n", ["__id", "__th", "start"])
            .groupBy("__id", "__th").agg(F.collect_set(F.struct("start", "mask")).alias("__runs")))


def _kept(words: list[bytes], runs, window: int) -> list[bytes]:
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    for x in runs:
        mask, start = x["mask"], x["start"]
        i = 0
        while mask >> i:
            if mask >> i & 1:
                cover[start + i] += 1
                cover[start + i + window] -= 1
            i += 1
    stay = np.cumsum(cover[:-1]) == 0
    return [w for w, s in zip(words, stay.tolist()) if s]


def _with_runs(docs: DataFrame, window: int, shard: int) -> DataFrame:
    """``docs`` with ``__text`` (compressed) for ``text``, and ``__runs``."""
    keyed = _keyed(docs)
    runs = saved(repeated_windows(keyed, window, shard), "runs")
    packed = keyed.withColumn("__text", _packed("text")).drop("text")
    return packed.join(runs, ["__id", "__th"], "left")


def remove(docs: DataFrame, window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    """``docs`` with the repeated words gone from ``text``: kept words joined by one space
    where something was removed, the text as it was elsewhere.  Documents stay, even if empty."""
    @F.pandas_udf("string")
    def shortened(texts: pd.Series, runs: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else _unpacked(t).decode() if r is None
                          else b" ".join(_kept(_unpacked(t).split(), r, window)).decode()
                          for t, r in zip(texts, runs)], dtype=object)

    return _with_runs(docs, window, shard).withColumn("text", shortened("__text", "__runs")).select(docs.columns)


def digests(docs: DataFrame, window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row."""
    @F.pandas_udf("n_words long, n_removed long, kept_sha256 string")
    def digest(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
        out = []
        for text, r in zip(texts, runs):
            words = _unpacked(text).split()
            kept = words if r is None else _kept(words, r, window)
            out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256"]).astype({"kept_sha256": object})

    both = _with_runs(docs.select("doc_id", "text"), window, shard)
    return both.select("doc_id", digest("__text", "__runs").alias("d")).select("doc_id", "d.*")


def query(spark, sf_dir: str) -> DataFrame:
    return digests(read_table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS u, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT u, unnest(w) AS word, generate_subscripts(w, 1) AS pos, len(w) AS n FROM d),
k AS (
  SELECT *, CASE WHEN pos + {WINDOW - 1} <= n THEN string_agg(word, ' ') OVER (
    PARTITION BY u ORDER BY pos ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) END AS win FROM x),
again AS (SELECT win FROM k WHERE win IS NOT NULL GROUP BY win HAVING count(*) > 1),
c AS (
  SELECT u, pos, word, max(CASE WHEN win IN (SELECT win FROM again) THEN 1 ELSE 0 END) OVER (
    PARTITION BY u ORDER BY pos ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) AS gone FROM k),
r AS (SELECT u, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE gone = 0) AS kept FROM c GROUP BY u)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (u)
"""
