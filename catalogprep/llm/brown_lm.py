"""Brown class-based n-gram scoring.

Words are assigned to classes; a text's probability is the product of class transitions
and of each word's emission from its class.

* Counts of all words come from the training documents (all of them), as a grouped table.
* Every document is written once more as numbers: the text end, the ``frequent`` most
  frequent training words and at most ``resident`` others have numbers (a bounded table,
  broadcast); all other words stand beside the numbers as text.
* Units of the first clustering are the text end, the ``frequent`` words, and pools of all
  other words by a hash of their last characters.  Unit bigrams are counted over all
  training documents; their table is bounded by the square of the number of units.
* Exchange clustering, in one task over that bounded table: starting with classes dealt by
  frequency, every unit in turn goes to the class that gives the highest class-bigram
  likelihood, until a round moves nothing or ``ROUNDS`` have passed.
* Every other training word then leaves its pool for the class that gives the highest
  likelihood, by its own counts of the classes before and after it, with all other words as
  the first clustering left them.  These counts and classes are tables that grow with the
  vocabulary.  Words that no training document holds keep their pool's class.
* Class bigrams are counted again over all training documents with the final classes;
  classes of words without numbers are joined.
* Scoring is a pass over the documents with the classes and transitions, and
  adds up log10((c + 1) / (N_class + V_class + 1)) for emissions, c the word's count and N,
  V the training tokens and distinct words of its class, and
  log10((n(a, b) + alpha) / (n(a) + alpha * K)) for transitions.

Defined results: null and empty texts are one end token; with nothing to learn from, all
counts are 0; rows repeated with one id count and are scored each; a null id counts as the
text 'null' in the split; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from itertools import repeat
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogprep.llm._common import read_table, saved

END = "\n"  # no word holds white space
FREQUENT = 1000
POOLS = 256
CLASSES = 64
ROUNDS = 6
ALPHA = 0.1
RESIDENT = 200_000
NO_ID = -(1 << 63)
WORD_BYTES = 64  # longer words are joined, not resident


def held_out(doc_id: Column) -> Column:
    """The split: crc32 of the id as text, modulo 7, is 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % 7 == 2


def _byte_tokens(text: str | None) -> list[bytes]:
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    words.append(END.encode())
    return words


def tokens(text: str | None) -> list[str]:
    return [w.decode() for w in _byte_tokens(text)]


def pool_of(word: str, pools: int = POOLS) -> int:
    return crc32(word[-3:].encode()) % pools


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c, c_all): counts in the training documents and in all, per task first."""
    def run(batches):
        train: Counter = Counter()
        rest: Counter = Counter()

        def rows():
            words = list(train.keys() | rest.keys())
            c, other = (np.fromiter(map(x.get, words, repeat(0)), np.int64, len(words)) for x in (train, rest))
            out = pd.DataFrame({"word": pd.Series([w.decode() for w in words], dtype=object), "c": c, "c_all": c + other})
            train.clear()
            rest.clear()
            return out

        for b in batches:
            for text, out in zip(b["text"], b["held_out"]):
                (rest if out else train).update(_byte_tokens(text))
                if len(train) + len(rest) > 400_000:  # a task's memory is bounded
                    yield rows()
        yield rows()

    return (docs.select("text", "held_out").mapInPandas(run, "word string, c long, c_all long")
            .groupBy("word").agg(F.sum("c").alias("c"), F.sum("c_all").alias("c_all")))


def encode(docs: DataFrame, numbers: Broadcast, pools: int) -> DataFrame:
    """i, t, held_out, ids (int32, as bytes) and other (words without a number, by line
    ends).  A word without a number has that of its pool, after all numbers."""
    def run(batches):
        have = {w.encode(): j for w, j in numbers.value.items()}
        columns = ["i", "t", "held_out", "ids", "other"]
        for b in batches:
            out, held = [], 0
            for i, t, held_out, text in zip(b["i"], b["t"], b["held_out"], b["text"]):
                words = _byte_tokens(text)
                ids = np.fromiter(map(have.get, words, repeat(-1)), np.int32, len(words))
                far = np.flatnonzero(ids < 0)
                other = [words[j].decode() for j in far.tolist()]
                ids[far] = [len(have) + pool_of(w, pools) for w in other]
                out.append((i, t, held_out, ids.tobytes(), END.join(other)))
                held += len(ids)
                if held > 1 << 21:
                    yield pd.DataFrame(out, columns=columns)
                    out, held = [], 0
            yield pd.DataFrame(out, columns=columns)

    return docs.select("i", "t", "held_out", "text").mapInPandas(run, "i long, t long, held_out boolean, ids binary, other string")


def _runs(batch: pd.DataFrame, most: int = 1 << 18):
    """Documents of a batch by about ``most`` tokens: their rows, numbers (end to end; each
    text ends with 0, so what stands before a text is an end too), lengths and other words."""
    if not len(batch):
        return
    sizes = np.fromiter(map(len, batch["ids"]), np.int64, len(batch)) // 4
    edges = np.r_[0, np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1, len(batch)].tolist()
    for a, z in zip(edges, edges[1:]):
        ids = np.frombuffer(b"".join(batch["ids"].iloc[a:z]), np.int32).astype(np.int64)
        other = END.join(filter(None, batch["other"].iloc[a:z]))
        yield slice(a, z), ids, sizes[a:z], other.split(END) if other else []


def unit_bigrams(encoded: DataFrame, unit_of: Broadcast, n_units: int) -> DataFrame:
    """(a, b, n): how often unit b follows unit a in training documents; a text starts
    after an end."""
    def run(batches):
        held = np.zeros(n_units * n_units, np.int64)
        for b in batches:
            for _, ids, _, _ in _runs(b):
                units = unit_of.value[ids]
                held += np.bincount(np.r_[0, units[:-1]] * n_units + units, minlength=len(held))
        keys = np.flatnonzero(held)
        yield pd.DataFrame({"a": keys // n_units, "b": keys % n_units, "n": held[keys]})

    counted = encoded.where("not held_out").select("ids", "other").mapInPandas(run, "a long, b long, n long")
    return counted.groupBy("a", "b").agg(F.sum("n").alias("n"))


def exchange(counts: np.ndarray, classes: int, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each unit by exchange clustering of the unit bigram counts.

    Maximises sum n(a,b) log n(a,b) - sum left(a) log left(a) - sum right(b) log right(b)
    over class bigrams.  Units without counts stay where they are dealt."""
    n = len(counts)
    classes = min(classes, n)
    left, right = counts.sum(axis=1), counts.sum(axis=0)
    order = np.argsort(-(left + right), kind="stable")
    of = np.empty(n, dtype=np.int64)
    of[order] = np.arange(n) % classes
    member = np.eye(classes)[of]
    table = member.T @ counts @ member

    def h(x):
        return x * np.log(np.maximum(x, 1e-300))

    for _ in range(rounds):
        moved = 0
        for u in order:
            if left[u] + right[u] == 0:
                continue
            old, self_n = of[u], counts[u, u]
            out, into = np.bincount(of, counts[u], classes), np.bincount(of, counts[:, u], classes)
            out[old] -= self_n
            into[old] -= self_n
            # without u
            table[old] -= out
            table[:, old] -= into
            table[old, old] -= self_n
            ls, rs = table.sum(axis=1), table.sum(axis=0)
            # u into class k changes row k, column k and their crossing
            row = h(table + out[None, :]) - h(table)
            col = h(table + into[:, None]) - h(table)
            cross = np.diag(table)
            both = h(cross + out + into + self_n) - h(cross)
            gain = (row.sum(axis=1) - np.diag(row)) + (col.sum(axis=0) - np.diag(col)) + both
            gain -= h(ls + left[u]) - h(ls) + h(rs + right[u]) - h(rs)
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = old
            of[u] = new
            table[new] += out
            table[:, new] += into
            table[new, new] += self_n
            moved += new != old
        if not moved:
            break
    return of


def cluster(bigrams: DataFrame, n_units: int, classes: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Class of each unit, and class bigram counts."""
    def run(df: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((n_units, n_units))
        counts[df["a"], df["b"]] = df["n"]
        of = exchange(counts, classes, rounds)
        member = np.eye(classes)[of]
        table = (member.T @ counts @ member).astype(np.int64)
        return pd.DataFrame({"of": [of.tobytes()], "table": [table.tobytes()]})

    row = bigrams.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(run, "of binary, table binary").collect()
    if not row:
        return np.arange(n_units) % classes, np.zeros((classes, classes), np.int64)
    return np.frombuffer(row[0].of, np.int64), np.frombuffer(row[0].table, np.int64).reshape(classes, classes)


def contexts(encoded: DataFrame, class_of: Broadcast, size: int, first: int, classes: int) -> DataFrame:
    """id (-1 for a word without a number), word (empty for one with), counts: of every
    training word from number ``first`` on, how often a word of each class follows it, stands
    before it, and how often it follows itself, as int64 bytes n * (2 * classes + 1) + slot."""
    slots = 2 * classes + 1

    def run(batches):
        local: dict[str, int] = {}
        keys, n, pending = np.zeros(0, np.int64), np.zeros(0, np.int64), []

        def merge():
            nonlocal keys, n
            new = np.sort(np.concatenate(pending)) if pending else keys[:0]
            at = np.flatnonzero(_changes(new))
            every, counts = np.r_[keys, new[at]], np.r_[n, np.diff(np.r_[at, len(new)])]
            order = np.argsort(every, kind="stable")  # two sorted parts
            every, counts = every[order], counts[order]
            at = np.flatnonzero(_changes(every))
            keys, n = every[at], np.add.reduceat(counts, at) if len(at) else counts
            pending.clear()

        def rows():
            nonlocal keys, n
            names = list(local)
            word = keys // slots
            packed = n * slots + keys % slots
            at = np.flatnonzero(_changes(word))
            ends = np.r_[at[1:], len(word)]
            for k in range(0, len(at), 50_000):
                w = word[at[k:k + 50_000]].tolist()
                yield pd.DataFrame({
                    "id": [x if x < size else -1 for x in w],
                    "word": pd.Series(["" if x < size else names[x - size] for x in w], dtype=object),
                    "counts": [packed[a:z].tobytes() for a, z in zip(at[k:k + 50_000].tolist(), ends[k:k + 50_000].tolist())]})
            local.clear()
            keys, n = keys[:0], n[:0]

        for b in batches:
            for _, ids, _, other in _runs(b):
                k = class_of.value[ids]
                ids[ids >= size] = [local.setdefault(w, size + len(local)) for w in other]
                at = np.flatnonzero(ids >= first)  # never a text's last
                u, before, after = ids[at], np.r_[0, ids][at], ids[at + 1]
                pending.append(u * slots + np.where(after == u, 2 * classes, k[at + 1]))
                not_own = before != u
                pending.append(u[not_own] * slots + classes + np.r_[k[-1], k][at[not_own]])
                if sum(map(len, pending)) > 1 << 20:
                    merge()
                    if len(local) > 200_000 or len(keys) > 2_000_000:  # a task's memory is bounded
                        yield from rows()
        merge()
        yield from rows()

    parts = encoded.where("not held_out").select("ids", "other").mapInPandas(run, "id int, word string, counts binary")
    return parts.repartition("word", "id").sortWithinPartitions("word", "id")  # few rows a word from each task


def _changes(*sorted_columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it."""
    new = np.ones(len(sorted_columns[0]), bool)
    if len(new):
        new[1:] = np.any([x[1:] != x[:-1] for x in sorted_columns], axis=0)
    return new


def _whole_words(batches):
    """Frames of ``contexts`` that hold all rows of their words."""
    rest = None
    for b in batches:
        if len(b):
            b = b if rest is None else pd.concat([rest, b], ignore_index=True)
            last = int(np.flatnonzero(_changes(b["id"].to_numpy(), b["word"].to_numpy()))[-1])
            yield b.iloc[:last]
            rest = b.iloc[last:]
    if rest is not None:
        yield rest


def _h(x):
    return x * np.log(np.maximum(x, 1e-300))


def _added(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum over j of h(table[k, j] + x[u, j]) - h(table[k, j]) for each u and k."""
    out, base = np.zeros(x.shape), _h(table)
    for n in range(1, 9):  # most counts
        hit = x == n
        if hit.any():
            out += hit.astype(float) @ (_h(table + n) - base).T
    many = np.nonzero(x > 8)
    for a in range(0, len(many[0]), 1 << 14):
        u, j = (v[a:a + (1 << 14)] for v in many)
        part = _h(table.T[j] + x[u, j][:, None]) - base.T[j]
        at = np.flatnonzero(_changes(u))
        out[u[at]] += np.add.reduceat(part, at)
    return out


def best_class(table: np.ndarray, out: np.ndarray, into: np.ndarray, own: np.ndarray, old: np.ndarray) -> np.ndarray:
    """The class of each word that gives the highest class-bigram likelihood, all other words
    staying.  ``table``: class bigrams with the words in ``old``; out, into: by word, counts of
    the classes after and before it, without ``own``, how often it follows itself."""
    table = table.astype(float)
    every, ls, rs, diag = np.arange(len(old)), table.sum(axis=1), table.sum(axis=0), np.diag(table)
    left, right = out.sum(axis=1) + own, into.sum(axis=1) + own
    gain = _added(out, table) + _added(into, table.T)
    # a class's bigram with itself gets both sides
    u, k = np.nonzero(((out > 0) & (into > 0)) | (own > 0)[:, None])
    t, a, b = diag[k], out[u, k], into[u, k]
    gain[u, k] += _h(t + a + b + own[u]) - _h(t + a) - _h(t + b) + _h(t)
    # what the word has with another class is no longer in its old one
    for x, y, by in ((out, into, table), (into, out, table.T)):
        u, k = np.nonzero((y > 0) & (x[every, old] > 0)[:, None])
        t, a, b = by[k, old[u]], x[u, old[u]], y[u, k]
        gain[u, k] += _h(t - b + a) - _h(t - b) - _h(t + a) + _h(t)
    gain -= _h(ls + left[:, None]) - _h(ls) + _h(rs + right[:, None]) - _h(rs)
    t = diag[old]
    stay = _h(t) - _h(t - out[every, old] - into[every, old] - own)
    for x, by in ((out, table), (into, table.T)):
        u, k = np.nonzero(x)
        u, k = u[k != old[u]], k[k != old[u]]
        t = by[old[u], k]
        stay += np.bincount(u, _h(t) - _h(t - x[u, k]), len(old))
    gain[every, old] = stay - (_h(ls[old]) - _h(ls[old] - left) + _h(rs[old]) - _h(rs[old] - right))
    new = gain.argmax(axis=1)
    return np.where(gain[every, new] > gain[every, old] + 1e-9, new, old)


def assign(found: DataFrame, class_of: Broadcast, table: np.ndarray, size: int, pools: int) -> DataFrame:
    """id, word, k (class), c (count) of every word of ``found`` (see ``contexts``)."""
    classes = len(table)
    slots = 2 * classes + 1

    def run(batches):
        for b in _whole_words(batches):
            ids, words, counts = (b[c].to_numpy() for c in ("id", "word", "counts"))
            starts = np.flatnonzero(_changes(ids, words))
            held = np.fromiter(map(len, counts), np.int64, len(b)) // 8
            # at most 1,024 words at once, and about 1 << 18 counts
            part = np.maximum.accumulate((np.cumsum(held) >> 18)[starts] * len(b) + np.arange(len(starts)) // 1024)
            edges = [*np.flatnonzero(_changes(part)).tolist(), len(starts)]
            for a, z in zip(edges, edges[1:]):
                at = starts[a:z]
                rows = slice(at[0], starts[z] if z < len(starts) else len(b))
                owner = np.searchsorted(at, np.arange(rows.start, rows.stop), side="right") - 1
                owner = np.repeat(owner, held[rows])
                packed = np.frombuffer(b"".join(counts[rows]), np.int64)
                dense = np.bincount(owner * slots + packed % slots, packed // slots, len(at) * slots).reshape(len(at), slots)
                out, into, own = dense[:, :classes], dense[:, classes:-1], dense[:, -1]
                old = class_of.value[[i if i >= 0 else size + pool_of(w, pools) for i, w in zip(ids[at].tolist(), words[at])]]
                yield pd.DataFrame({"id": ids[at], "word": words[at], "k": best_class(table, out, into, own, old),
                                    "c": (into.sum(axis=1) + own).astype(np.int64)})

    return found.mapInPandas(run, "id int, word string, k int, c long")


def placed(encoded: DataFrame, class_of: Broadcast, size: int, classes: int) -> DataFrame:
    """With word: one row for each place of a word without a number: i, t, held_out, word,
    k (its pool's class), l and r (classes beside it, -1 if that word has no number either),
    next and next_k (the word after it, if that has no number).  Without word: n, how often r
    follows l in training documents, both of words with numbers."""
    columns = ["i", "t", "held_out", "word", "k", "l", "r", "next", "next_k", "n"]

    def run(batches):
        table = np.zeros(classes * classes, np.int64)
        for b in batches:
            for rows, ids, sizes, other in _runs(b):
                k, far = class_of.value[ids], ids >= size
                before, before_far = np.r_[k[-1], k[:-1]], np.r_[False, far[:-1]]
                train = np.repeat(~b["held_out"].to_numpy(bool)[rows], sizes)
                both = train & ~far & ~before_far
                table += np.bincount(before[both] * classes + k[both], minlength=classes * classes)
                at = np.flatnonzero(far)  # never a text's last
                if len(at):
                    doc = np.repeat(np.arange(rows.start, rows.stop), sizes)[at]
                    after = far[at + 1]
                    yield pd.DataFrame({
                        "i": b["i"].to_numpy()[doc], "t": b["t"].to_numpy()[doc], "held_out": ~train[at],
                        "word": pd.Series(other, dtype=object), "k": k[at], "l": np.where(before_far[at], -1, before[at]),
                        "r": np.where(after, -1, k[at + 1]),
                        "next": pd.Series([w if x else None for w, x in zip([*other[1:], None], after.tolist())], dtype=object),
                        "next_k": k[at + 1], "n": 1})[columns]
        at = np.flatnonzero(table)
        yield pd.DataFrame({"i": 0, "t": 0, "held_out": False, "word": pd.Series([None] * len(at), dtype=object), "k": -1,
                            "l": at // classes, "r": at % classes, "next": pd.Series([None] * len(at), dtype=object),
                            "next_k": -1, "n": table[at]})[columns]

    return encoded.mapInPandas(run, "i long, t long, held_out boolean, word string, k int, l int, r int, next string, next_k int, n long")


def score(docs: DataFrame, frequent: int = FREQUENT, pools: int = POOLS,
          classes: int = CLASSES, rounds: int = ROUNDS, alpha: float = ALPHA, resident: int = RESIDENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast
    docs = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    counts = saved(word_counts(docs), "word-counts")
    total, kinds, ends = counts.agg(F.sum("c"), F.sum((F.col("c") > 0).cast("long")), F.sum(F.when(F.col("word") == END, F.col("c")))).first()
    total, kinds = int(total or 0), int(kinds or 0)
    first = counts.where(F.col("c") > 0).where(F.col("word") != END).orderBy(F.desc("c"), "word").limit(frequent).select("word", "c").collect()
    count_of = {END: int(ends or 0)} | {r.word: r.c for r in first}
    n_first = len(count_of)
    top = _most_frequent(counts, resident).select("word", "c").toPandas()  # at most ``resident`` rows of bounded length
    count_of = count_of | dict(zip(top["word"], top["c"].astype(int).tolist()))
    size, n_units = len(count_of), n_first + pools
    c_of = np.fromiter(count_of.values(), np.int64, size)

    # a row's key is its id and a hash of its text; rows that share both have equal results
    keyed = docs.withColumns({"i": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "t": F.xxhash64("text")})
    encoded = saved(encode(keyed, shared({w: j for j, w in enumerate(count_of)}), pools), "encoded")
    unit_of = np.r_[np.arange(n_first), [n_first + pool_of(w, pools) for w in list(count_of)[n_first:]],
                    n_first + np.arange(pools)].astype(np.int64)
    of, table = cluster(saved(unit_bigrams(encoded, shared(unit_of), n_units), "bigrams"), n_units, classes, rounds)
    k_of = of[unit_of]
    pooled = shared(k_of)
    assigned = saved(assign(contexts(encoded, pooled, size, n_first, classes), pooled, table, size, pools), "word-classes")
    own = assigned.where("id >= 0").select("id", "k").toPandas()  # at most ``resident`` rows
    k_of = k_of.copy()
    k_of[own["id"].to_numpy(np.int64)] = own["k"].to_numpy(np.int64)
    model = shared((k_of, c_of))
    far_words = assigned.where("id < 0").select("word", F.col("k").alias("word_k"), "c")

    # places of words without numbers, with their classes
    places = saved(placed(encoded, shared(k_of), size, classes), "places")
    found = places.where("word is not null").join(far_words, "word", "left")
    single = saved(found.select("i", "t", "held_out", "l", F.coalesce("word_k", "k").alias("k"), "r",
                                F.coalesce("c", F.lit(0).cast("long")).alias("c"), "next", "next_k"), "places-classes")
    pairs = (single.where("next is not null").select("i", "t", "held_out", F.col("k").alias("l"), F.col("next").alias("word"), "next_k")
             .join(far_words.drop("c"), "word", "left")
             .select("i", "t", "held_out", "l", F.coalesce("word_k", "next_k").alias("k"), F.lit(-1).alias("r"), F.lit(-1).cast("long").alias("c")))
    far = single.drop("next", "next_k").unionByName(saved(pairs, "places-pairs"))  # c is -1 where only the transition counts

    sides = F.explode(F.array(F.struct(F.col("l").alias("a"), F.col("k").alias("b")), F.struct(F.col("k").alias("a"), F.col("r").alias("b"))))
    more = far.where("not held_out").select(sides.alias("s")).select("s.*").where("a >= 0 and b >= 0").select("a", "b", F.lit(1).cast("long").alias("n"))
    moves = places.where("word is null").select(F.col("l").alias("a"), F.col("r").alias("b"), "n").unionByName(more)
    table = np.zeros((classes, classes), np.int64)
    for r in moves.groupBy("a", "b").agg(F.sum("n").alias("n")).collect():  # one row per class bigram
        table[r.a, r.b] = r.n
    mass = far_words.groupBy("word_k").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    room = 1.0 + np.bincount(k_of[:size], c_of + (c_of > 0), classes)  # N + V + 1 by class
    for r in mass:  # one row per class
        room[r.word_k] += r.n + r.v
    step = np.log10((table + alpha) / (table.sum(axis=1, keepdims=True) + alpha * classes))
    pieces = shared((step, -np.log10(room)))
    base_room = -float(np.log10(total + kinds + 1))

    def run(batches):
        (by_id, c), (trans, emit) = model.value, pieces.value
        seen = np.r_[c, np.zeros(len(by_id) - len(c), np.int64)]
        for b in batches:
            for rows, ids, sizes, _ in _runs(b):
                k, near = by_id[ids], ids < len(c)
                before, before_near = np.r_[k[-1], k[:-1]], np.r_[True, near[:-1]]
                moved = np.where(near, emit[k] + np.where(before_near, trans[before, k], 0.0), 0.0)
                at = np.r_[0, np.cumsum(sizes)[:-1]]
                yield pd.DataFrame({"i": b["i"].to_numpy()[rows], "t": b["t"].to_numpy()[rows], "rows": 1, "n_tokens": sizes,
                                    "n_known": np.add.reduceat((seen[ids] > 0).astype(np.int64), at),
                                    "logs": np.add.reduceat(np.log10(seen[ids] + 1.0), at), "moved": np.add.reduceat(moved, at)})

    @F.pandas_udf("double")
    def moved_by(left: pd.Series, k: pd.Series, right: pd.Series, c: pd.Series) -> pd.Series:
        (trans, emit), (a, b, z) = pieces.value, (x.to_numpy() for x in (left, k, right))
        return pd.Series(np.where(a >= 0, trans[a, b], 0.0) + np.where(z >= 0, trans[b, z], 0.0) + np.where(c.to_numpy() >= 0, emit[b], 0.0))

    parts = encoded.drop("held_out").mapInPandas(run, "i long, t long, rows long, n_tokens long, n_known long, logs double, moved double")
    sums = [F.sum(c).alias(c) for c in ("rows", "n_tokens", "n_known", "logs", "moved")]
    rare = far.select("i", "t", F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("n_tokens"),
                      (F.col("c") > 0).cast("long").alias("n_known"),
                      F.log10(F.greatest(F.col("c"), F.lit(0)) + 1.0).alias("logs"), moved_by("l", "k", "r", "c").alias("moved"))
    whole = (parts.unionByName(rare).groupBy("i", "t").agg(*sums)
             # rows that share a key share the sums
             .withColumn("i", F.nullif("i", F.lit(NO_ID))).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))))
    each = {c: (F.col(c) / F.col("rows")) for c in ("n_tokens", "n_known", "logs", "moved")}
    out = whole.select(F.col("i").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
                       held_out(F.col("i")).alias("held_out"),
                       each["n_tokens"].cast("long").alias("n_tokens"), each["n_known"].cast("long").alias("n_known"),
                       F.lit(total).cast("long").alias("train_tokens"),
                       (each["logs"] + each["n_tokens"] * base_room).alias("base_score"),
                       (each["logs"] + each["moved"]).alias("score"))
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """At most ``most`` words of bounded length: all whose count reaches a step that a
    histogram of the counts (a few hundred steps) gives, so no task sorts or sends others."""
    step = F.floor(F.log2("c_all") * 16).cast("int")
    short = counts.where(F.octet_length("word") <= WORD_BYTES).withColumn("step", step)
    sizes = {r.step: r.n for r in short.groupBy("step").agg(F.count("*").alias("n")).collect()}
    at, held = max(sizes, default=0) + 1, 0
    for s in sorted(sizes, reverse=True):
        if held + sizes[s] > most:
            break
        at, held = s, held + sizes[s]
    return short.where(F.col("step") >= at)


def query(spark, sf_dir: str) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"))
