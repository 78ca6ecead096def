"""WARC archives, the Merkle manifest and periodic runs against brute force."""

import glob
import gzip
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogprep.llm import merkle, periodic, warc

SMALL = "/root/testdata/sf0.001"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def by_value(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


def from_sql(sql, table, path):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con.execute(sql).fetchall()


# --- 11: WARC

PAGE = "page_id long, url string, html string, payload_digest string, salt int"


@pytest.fixture(scope="module")
def page_rows():
    long, other = "é" * 600, "x" * 1000
    out = [(i, f"http://a/{i}", t, "clash", i) for i, t in enumerate(
        [None, "", "short", "short", long, long, long + "!", other, other[:-1], other[:-1], "a\r\n\r\nb\x00", "WARC/1.1\r\n\r\n" * 200])]
    out += [(100 + i, None, long, "clash", i) for i in range(40)]  # a very common payload
    return out + [(139, "http://a/again", long, "clash", 1), (None, "u\r\nv", long, None, None), (None, "w", "z" * 2000, None, None),
                  (None, "w", "z" * 2000, None, None), (200, "v", "y" * 200_000, None, None)]


def brute_pages(rows):
    digest = [hashlib.sha1((r[2] or "").encode()).hexdigest() for r in rows]
    size = [len((r[2] or "").encode()) for r in rows]
    out = []
    for r, d, n in zip(rows, digest, size):
        best = max((x[0] for x, e in zip(rows, digest) if e == d and x[0] is not None), default=None) if n >= warc.LEAST else None
        again = best is not None and r[0] != best
        out.append((r[0], n, d, "revisit" if again else "response", best if again else None))
    return out


@pytest.mark.parametrize("salted", [False, True])
def test_archives_read_back(spark, page_rows, tmp_dir, monkeypatch, salted):
    if salted:  # neither join may broadcast
        monkeypatch.setattr(warc.spread_join, "__defaults__", (-1,))
    pages = spark.createDataFrame(page_rows, PAGE).repartition(4)
    warc.write(pages, tmp_dir + "/w")
    listed = warc.index(spark, tmp_dir + "/w")
    records = warc.read(listed, tmp_dir + "/w").cache()
    got = warc.resolved(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert by_value(got.collect()) == by_value(brute_pages(page_rows))
    stored = {(r.page_id, bytes(r.payload)) for r in records.collect() if r.record_type == "response"}
    assert stored == {(r[0], (r[2] or "").encode()) for r, b in zip(page_rows, brute_pages(page_rows)) if b[3] == "response"}
    urls = by_value((r.page_id, r.url) for r in records.collect())
    assert urls == by_value((r[0], r[1] and re.sub("[\r\n]", " ", r[1])) for r in page_rows)


def test_archives_are_whole_gzip_members_at_the_index_offsets(spark, page_rows, tmp_dir):
    warc.write(spark.createDataFrame(page_rows, PAGE).repartition(2), tmp_dir + "/w")
    files = glob.glob(tmp_dir + "/w/archives/*.warc.gz")
    assert 1 <= len(files) <= 2
    text = b"".join(gzip.open(f).read() for f in files)  # any WARC reader sees a plain stream of records
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(page_rows)
    rows = warc.index(spark, tmp_dir + "/w").collect()
    for f in files:
        ends = 0
        for r in sorted((r for r in rows if f.endswith(r.file)), key=lambda r: r.offset):
            assert r.offset == ends
            ends = r.offset + r.length
        assert ends == len(open(f, "rb").read())


def test_a_selection_reads_only_its_ranges_and_damage_raises(spark, page_rows, tmp_dir):
    warc.write(spark.createDataFrame(page_rows, PAGE).coalesce(1), tmp_dir + "/w")
    listed = warc.index(spark, tmp_dir + "/w")
    some = warc.read(listed.where("page_id IN (6, 11)"), tmp_dir + "/w").collect()
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in some) == [(6, "é" * 600 + "!"), (11, "WARC/1.1\r\n\r\n" * 200)]
    (path,) = glob.glob(tmp_dir + "/w/archives/*.warc.gz")
    row = listed.where("page_id = 11").first()
    data = bytearray(open(path, "rb").read())
    bad = gzip.compress(gzip.decompress(data[row.offset:row.offset + row.length]).replace(b"\n\r\nWARC/1.1", b"\n\r\nwarc/1.1"))
    open(path, "wb").write(data[:row.offset] + bad)
    with pytest.raises(Exception, match="damaged|whole|CRC|incorrect"):
        warc.read(listed.where("page_id = 11").withColumn("length", F.lit(len(bad))), tmp_dir + "/w").collect()


def test_requests_coalesce():
    at, size = np.array([0, 10, 30, 500, 510]), np.array([10, 10, 10, 10, 90])
    assert warc.requests(at, size, gap=10, most=1000) == [(0, 3), (3, 5)]
    assert warc.requests(at, size, gap=0, most=1000) == [(0, 2), (2, 3), (3, 5)]
    assert warc.requests(at, size, gap=10, most=25) == [(0, 2), (2, 3), (3, 4), (4, 5)]
    assert warc.requests(at[:0], size[:0]) == []


def test_no_pages(spark, tmp_dir):
    spark.createDataFrame([], PAGE).write.parquet(tmp_dir + "/pages.parquet")
    assert warc.query(spark, tmp_dir).count() == 0


# --- 12: Merkle manifest

DOC = "doc_id long, text string, lang string, source string, n_chars long, tree string, idx int, block int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified by whole trees in memory."""
    def leaf(r, text):
        f = [None if x is None else str(x) for x in (r[0], r[3], r[2], r[4], text)]
        return h(*("-" if x is None else f"{len(x.encode())}:{x}" for x in f))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
        return levels

    def path(levels, i):
        out = []
        for nodes in levels[:-1]:
            a = i - i % 3
            out.append((nodes[a:i], nodes[i + 1:a + 3]))
            i //= 3
        return out

    groups = {}
    for r in rows:
        picked = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        found = leaf(r, r[1].replace("\n", "") if picked and r[1] is not None else r[1])
        groups.setdefault(r[3], []).append((r[0], leaf(r, r[1]), found))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append(tree([x[1] for x in groups[s]]))
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, (s, t) in enumerate(zip(order, trees)):
        for i, (doc_id, a, found) in enumerate(groups[s]):
            whole, node = path(t, i) + path(top, k), found
            for lo, hi in whole:
                node = h(*lo, node, *hi)
            proof = h(*(x for lo, hi in whole for x in (*lo, *hi)))
            out.append((doc_id, a, t[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


@pytest.fixture(scope="module")
def leaf_rows():
    rng = random.Random(4)
    out = [(i, None if i % 11 == 0 else "line\n" * (i % 4) + "é" * (i % 3), "en" if i % 5 else None,
            rng.choice([None, "", "hot", "hot", "hot", "é", "z", f"one{i}"]), None if i % 7 == 0 else i, "clash", i, 0) for i in range(90)]
    return out + [(5, "twice\n", "en", "hot", 1, "c", 1, 1)] * 3 + [(None, "no\nid", None, "hot", None, "c", 1, 1), (None, None, None, None, None, None, None, None)]


@pytest.mark.parametrize("depth", [1, 2, 7])
def test_manifest_against_whole_trees(spark, leaf_rows, tmp_dir, depth):
    spark.createDataFrame(leaf_rows, DOC).repartition(5).write.parquet(tmp_dir + "/documents.parquet")
    got = merkle.query(spark, tmp_dir, depth)
    assert by_value(got.collect()) == by_value(brute_manifest(leaf_rows))


def test_manifest_oracle_against_whole_trees(spark, leaf_rows, tmp_dir):
    spark.createDataFrame(leaf_rows, DOC).repartition(5).write.parquet(tmp_dir + "/documents.parquet")
    assert by_value(from_sql(merkle.ORACLE, "documents", tmp_dir + "/documents.parquet/*.parquet")) == by_value(brute_manifest(leaf_rows))


def test_manifest_of_one_leaf_and_of_none(spark, tmp_dir):
    one = [(7, "a\nb", "en", "s", 3, "c", 1, 1)]
    spark.createDataFrame(one, DOC).write.parquet(tmp_dir + "/one/documents.parquet")
    (r,) = merkle.query(spark, tmp_dir + "/one").collect()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == h() and tuple(r) == brute_manifest(one)[0]
    spark.createDataFrame([], DOC).write.parquet(tmp_dir + "/none/documents.parquet")
    assert merkle.query(spark, tmp_dir + "/none").count() == 0


# --- 13: periodic runs

def brute_runs(d, least=12):
    out = []
    for q in range(1, len(d) // 2 + 1):
        x = 0
        while x + q < len(d):
            y = x
            while y + q < len(d) and d[y] == d[y + q]:
                y += 1
            n, s = y - x + q, d[x:y + q]
            if y > x and n >= max(least, 2 * q) and not any(s[r:] == s[:n - r] for r in range(1, q)):
                out.append((x, n, q))
            x = max(y, x + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def odd_sequence(rng):
    kinds, n, mode = rng.choice([1, 2, 2, 3, 5, 30]), rng.randint(0, 160), rng.random()
    if mode < 0.3:
        return [rng.randrange(kinds) for _ in range(n)]
    if mode < 0.6:  # repeated blocks
        d = []
        while len(d) < n:
            d += [rng.randrange(kinds) for _ in range(rng.randint(1, 25))] * rng.randint(1, 6)
        return d
    if mode < 0.8:  # highly periodic regions that meet at breaks
        u = [0, 1] * rng.randint(3, 25) + [0] * rng.randint(0, 2)
        return [x for _ in range(rng.randint(1, 4)) for x in u[:rng.randint(len(u) - 3, len(u))]]
    a, b = [0], [rng.randint(0, 1), 1]
    for _ in range(rng.randint(3, 8)):
        a, b = b, b + a
    return b[:300]


def test_runs_against_brute_force():
    rng = random.Random(13)
    for _ in range(150):
        docs = [odd_sequence(rng) for _ in range(rng.randint(1, 12))]
        got = [tuple(r) for r in periodic.find_runs([np.array(d, np.int64) for d in docs]).tolist()]
        assert got == [(i, *r) for i, d in enumerate(docs) for r in brute_runs(d)]


def brute_digest(doc_id, text, planted=True):
    w = SPACED.findall(text or "")
    if planted and doc_id is not None and w:
        x = zlib.crc32(str(doc_id).encode())
        if x % 10 == 0:
            a, g = x // 10 % len(w), x // 10
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    found = brute_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(found), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            h("".join(f"{s},{n},{q}\n" for s, n, q in found)), h(kept))


@pytest.fixture(scope="module")
def run_rows():
    rng = random.Random(6)
    words = [["a", "b", "É", "dd\x85e", "　", "x"][rng.randrange(6)] for _ in range(600)]
    texts = [None, "", " \t\n", "a " * 400, "a b " * 300 + "a", " ".join(words), "\n".join(words * 2), "one", "a  b\tc\x0bd " * 5]
    texts += [" ".join("abc"[x % 3] for x in odd_sequence(rng)) for _ in range(60)]
    out = [(i, t, "clash", i, None) for i, t in enumerate(texts)]
    return out + [(3, "a " * 400, "c", 1, 1), (3, "b " * 13, "c", 1, 1), (None, "c " * 30, None, None, None), (None, None, None, None, None),
                  (1 << 60, "x y z " * 9, "c", 0, 0)]


RUN_DOC = "doc_id long, text string, start string, period int, w int"


def test_run_digests_against_brute_force(spark, run_rows, tmp_dir, monkeypatch):
    docs = spark.createDataFrame(run_rows, RUN_DOC).repartition(3)
    docs.write.parquet(tmp_dir + "/documents.parquet")
    got = by_value(periodic.query(spark, tmp_dir).collect())
    assert got == by_value(brute_digest(r[0], r[1]) for r in run_rows)
    assert sum(r[1] > 0 for r in got) > 20
    assert by_value(periodic.digests(docs).collect()) == by_value(brute_digest(r[0], r[1], False) for r in run_rows)


def test_runs_and_collapsed_texts(spark, run_rows):
    docs = spark.createDataFrame(run_rows, RUN_DOC).repartition(3)
    want = [(r[0], *x) for r in run_rows for x in brute_runs(SPACED.findall(r[1] or ""))]
    assert by_value(periodic.runs(docs).collect()) == by_value(want)
    short = periodic.collapse(docs)
    assert short.columns == docs.columns
    texts = {(r.doc_id, r.text) for r in short.collect()}
    assert {(3, "a"), (3, "b"), (7, "one"), (0, None), (2, " \t\n"), (8, "a b c d"), (1 << 60, "x y z")} <= texts


def test_long_texts_in_small_parts(run_rows, monkeypatch):
    texts = [r[1] for r in run_rows]
    whole = [x.tolist() for _, _, by_text in periodic._parts(texts) for x in by_text]
    monkeypatch.setattr(periodic, "WORDS", 50)
    assert [x.tolist() for _, _, by_text in periodic._parts(texts) for x in by_text] == whole


def test_documents_have_the_runs_of_brute_force(spark):
    short = spark.read.parquet(f"{SMALL}/documents.parquet").where(F.length("text") < 3000)
    got = periodic.digests(periodic.with_planted_runs(short)).collect()
    texts = short.select("doc_id", "text").collect()
    assert by_value(got) == by_value(brute_digest(r.doc_id, r.text) for r in texts)


def test_no_runs_in_no_documents(spark):
    empty = spark.createDataFrame([], RUN_DOC)
    assert periodic.digests(periodic.with_planted_runs(empty)).count() == 0
    assert periodic.runs(empty).count() == 0
