"""Token ids in compressed binary files.

Texts are encoded by the tokenizers library and written in ascending doc_id order as
records of blocks.  A record holds whole documents of about ``SEGMENT`` ids:

    magic "TIDS", version (1 byte), then little-endian 32-bit: documents, ids, ids per block,
    bytes of the classes;
    per document its id (64 bit) and number of ids (32 bit);
    per block its payload length and the CRC-32 of its ids as 32-bit integers (32 bit each);
    the order-0 class of each of the 65,536 ids in this record (a byte each, deflated);
    CRC-32 of all that (32 bit), then the payloads (see ``idcoder``).

Every block has a reset model and a checksum, so it can be decoded and verified alone with its
record's head.
Records are the rows of a Parquet folder (shard, seq, counts, record), which Spark's
committer writes: a lost task's records are written again, and readers see whole files.

The distinct words of many texts are encoded and remembered: the tokenizer drops white space and
cuts there, so a text's ids are its words' ids in order.  Where its settings say that it also lower-cases,
cuts between a letter and a punctuation mark and ends each piece with an id of its own kind, words
are taken apart in the same places, and the library is given many words of letters a call.

Defined results: null and empty texts are the end id only; rows repeated with one id stand
next to each other, ordered by text; rows without an id come first, with id null; an empty
table gives an empty store and an empty result.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator
from itertools import chain
from zlib import compress, crc32, decompress

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalogprep.llm import idcoder
from catalogprep.llm._common import fresh_path, read_table, small_side

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
BLOCK = 2048
SEGMENT = idcoder.LANES * BLOCK
CACHED = 400_000
PER_CALL = 32
CHUNK = 16 << 20
PIECES = {  # settings under which a letter and a punctuation mark never share a piece, nor two words
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
_STEM_TAIL = f"^(?P<stem>.*[{LETTERS}])(?P<tail>[.,;:!?]+)$"
_LETTERS_ONLY = re.compile(f"[{LETTERS}]+")
MAGIC = b"TIDS\x02"
NO_ID = -(1 << 63)
_RECORD = "shard int, seq int, n_docs long, n_ids long, record binary"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space; remembers words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        config = json.loads(self.tokenizer.to_str())
        end = config["model"].get("end_of_word_suffix")
        self.last = None  # of each id, whether it ends a piece
        if end and all(config[k] == v for k, v in PIECES.items()):
            vocab = self.tokenizer.get_vocab()
            self.last = np.zeros(max(vocab.values()) + 1, bool)
            self.last[[i for w, i in vocab.items() if w.endswith(end)]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}  # stem, tail or word to its place in the two arrays
        self.starts, self.ids = np.zeros(1, np.int64), np.zeros(0, "<u4")

    def _learn(self, words: list[str]) -> None:
        """Append the ids of these words, none of which is known."""
        plain = [w for w in words if _LETTERS_ONLY.fullmatch(w)] if self.last is not None else []
        several = [" ".join(plain[k:k + PER_CALL]) for k in range(0, len(plain), PER_CALL)]
        x, _ = self._call(several)
        sizes = np.diff(np.flatnonzero(self.last[x]), prepend=-1) if plain else np.zeros(0, np.int64)
        if len(sizes) != len(plain) or sizes.sum() != len(x):
            plain, x, sizes = [], x[:0], sizes[:0]
        taken = set(plain)
        alone = [w for w in words if w not in taken]
        y, more = self._call(alone)
        self.known.update(zip(plain + alone, range(len(self.known), len(self.known) + len(words))))
        self.ids = np.concatenate([self.ids, x, y])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate([sizes, more]))])

    def _call(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), "<u4", sizes.sum()), sizes

    def _places(self, pieces: pa.Array) -> np.ndarray:
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.known]
        if len(self.known) + len(new) > CACHED and self.known:
            self._forget()
            new = distinct
        if new:
            self._learn(new)
        return np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these texts one after the other, each with the end id, and how many each has."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        offsets = words.offsets.to_numpy() - words.offsets[0].as_py()
        coded = words.flatten().dictionary_encode()
        pieces, each = coded.dictionary, np.ones(len(coded.dictionary), np.int64)
        if self.last is not None:
            cut = pc.extract_regex(pieces, _STEM_TAIL)
            stems = pc.if_else(pc.is_valid(cut), pc.struct_field(cut, 0), pieces)
            stems = pc.if_else(pc.match_substring(stems, "<|"), stems, pc.ascii_lower(stems))  # added tokens keep case
            pieces, each = pa.concat_arrays([stems, pc.fill_null(pc.struct_field(cut, 1), "")]), each * 2
        places = self._places(pieces).reshape(-1, len(each)).T.ravel()
        ids, sizes = _gather(self.ids, self.starts, places)
        starts = np.cumsum(sizes)[np.cumsum(each) - 1] if len(each) else np.zeros(0, np.int64)
        # a text's end is one more word, of the one id after all others
        ids, starts = np.append(ids, np.uint32(end_id)), np.concatenate([[0], starts, [len(ids) + 1]])
        flat, sizes = _gather(ids, starts, np.insert(coded.indices.to_numpy(), offsets[1:], len(each)))
        before = np.concatenate([[0], np.cumsum(sizes)])
        return flat, np.diff(before[offsets + np.arange(len(offsets))])


def _gather(ids: np.ndarray, starts: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``ids`` from starts[p] to starts[p + 1] one after the other, and their sizes."""
    sizes = np.diff(starts)[places]
    before = np.cumsum(sizes) - sizes
    return ids[np.repeat(starts[places] - before, sizes) + np.arange(sizes.sum())], sizes


_LOADED: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _LOADED:
        _LOADED[path] = WordEncoder(path)
    return _LOADED[path]


def pack(doc_ids: list[int], ids: list[np.ndarray], block: int = BLOCK) -> bytes:
    """A record of these documents."""
    flat = np.concatenate(ids).astype("<u4") if ids else np.zeros(0, "<u4")
    kinds = idcoder.classes(flat)
    payloads, deflated = idcoder.encode(flat, block, kinds=kinds), compress(kinds.tobytes(), 9)
    head = MAGIC + struct.pack("<IIII", len(ids), len(flat), block, len(deflated))
    head += np.array(doc_ids, "<i8").tobytes() + np.array([len(x) for x in ids], "<u4").tobytes()
    sums = [crc32(flat[i * block:(i + 1) * block].tobytes()) for i in range(len(payloads))]
    head += np.array([[len(p), s] for p, s in zip(payloads, sums)], "<u4").tobytes() + deflated
    return head + struct.pack("<I", crc32(head)) + b"".join(payloads)


def unpack(record: bytes) -> tuple[np.ndarray, list[np.ndarray]]:
    """Document ids and each document's ids; raises where a checksum does not hold."""
    if record[:5] != MAGIC:
        raise ValueError("not a token record")
    n_docs, n_ids, block, deflated = struct.unpack_from("<IIII", record, 5)
    blocks, at = -(-n_ids // block), 21
    doc_ids = np.frombuffer(record, "<i8", n_docs, at)
    sizes = np.frombuffer(record, "<u4", n_docs, at + 8 * n_docs).astype(np.int64)
    table = np.frombuffer(record, "<u4", 2 * blocks, at + 12 * n_docs).reshape(-1, 2).astype(np.int64)
    at += 12 * n_docs + 8 * blocks + deflated
    if at + 4 > len(record) or struct.unpack_from("<I", record, at)[0] != crc32(record[:at]):
        raise ValueError("a record's header is damaged")
    kinds = np.frombuffer(decompress(record[at - deflated:at]), np.uint8)
    ends = at + 4 + np.cumsum(table[:, 0])
    lengths = np.minimum(block, n_ids - block * np.arange(blocks))
    flat = idcoder.decode([record[e - n:e] for e, n in zip(ends, table[:, 0])], lengths, kinds=kinds).astype("<u4")
    for i, s in enumerate(table[:, 1].tolist()):
        if crc32(flat[i * block:(i + 1) * block].tobytes()) != s:
            raise ValueError(f"block {i} of a record is damaged")
    return doc_ids, np.split(flat, np.cumsum(sizes)[:-1]) if n_docs else []


def _encoded(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int) -> Iterator[tuple[int, np.ndarray]]:
    """Document id and ids of every row, about ``CHUNK`` bytes of text encoded at a time."""
    for b in batches:
        texts = b.column("text")
        ahead = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = np.flatnonzero(np.diff(ahead // CHUNK)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]):
            flat, sizes = _encoder(tokenizer).encode(texts.slice(lo, hi - lo), end_id)
            yield from zip(b.column("i").slice(lo, hi - lo).to_pylist(), np.split(flat, np.cumsum(sizes)[:-1]))


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, segment: int = SEGMENT) -> None:
    """Encode every whole text and write the records to ``path``, in ascending doc_id order:
    shards are ranges of ids, records of a shard are in order of seq."""
    tokenizer = tokenizer or tokenizer_path()

    def record(shard, seq, doc_ids, ids, held):
        return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_docs": [len(ids)],
                                           "n_ids": [held], "record": pa.array([pack(doc_ids, ids)], pa.binary())})

    def run(batches):
        shard, seq, doc_ids, ids, held = TaskContext.get().partitionId(), 0, [], [], 0
        for i, x in _encoded(batches, tokenizer, end_id):
            if held and held + len(x) > segment:
                yield record(shard, seq, doc_ids, ids, held)
                seq, doc_ids, ids, held = seq + 1, [], [], 0
            doc_ids.append(i)
            ids.append(x)
            held += len(x)
        if ids:
            yield record(shard, seq, doc_ids, ids, held)

    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("i"), "text")
    # ranges are drawn from a sample of keys at the driver, so the key holds no whole texts
    (keyed.repartitionByRange("i", F.substring("text", 1, 32)).sortWithinPartitions("i", "text").mapInArrow(run, _RECORD)
     .write.option("compression", "none").parquet(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """shard, seq, nth (place in the record), before (ids of the record before it), doc_id,
    ids of every document of a store."""
    def run(batches):
        for b in batches:
            for shard, seq, record in zip(b["shard"], b["seq"], b["record"]):
                doc_ids, ids = unpack(record)
                sizes = np.array([len(x) for x in ids], np.int64)
                before = np.cumsum(sizes) - sizes
                for k in range(0, len(ids), 256):
                    yield pd.DataFrame({"shard": shard, "seq": seq, "nth": np.arange(k, min(k + 256, len(ids))),
                                        "before": before[k:k + 256], "doc_id": [None if i == NO_ID else int(i) for i in doc_ids[k:k + 256]],
                                        "ids": [x.astype(np.int64) for x in ids[k:k + 256]]})

    return _records(spark, path).mapInPandas(run, "shard int, seq int, nth long, before long, doc_id long, ids array<long>")


def _records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_RECORD).parquet(path)


def starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, seq, start): ids of all records before each one, from the counts beside them."""
    sizes = _records(spark, path).select("shard", "seq", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("all"))  # one row per written partition
    ahead = shards.select("shard", (F.sum("all").over(Window.orderBy("shard")) - F.col("all")).alias("ahead"))
    within = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("seq")) - F.col("n_ids")
    return sizes.withColumn("within", within).join(ahead, "shard").select("shard", "seq", (F.col("ahead") + F.col("within")).alias("start"))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""
    def run(batches):
        for b in batches:
            for shard, seq, record in zip(b["shard"], b["seq"], b["record"]):
                doc_ids, ids = unpack(record)
                sizes = np.array([len(x) for x in ids], np.int64)
                yield pd.DataFrame({"shard": shard, "seq": seq, "before": np.cumsum(sizes) - sizes,
                                    "doc_id": pd.array([None if i == NO_ID else int(i) for i in doc_ids], dtype="Int64"),
                                    "n_tokens": sizes, "ids_crc32": [crc32(x.tobytes()) for x in ids]})

    rows = _records(spark, path).mapInPandas(
        run, "shard int, seq int, before long, doc_id long, n_tokens long, ids_crc32 long")
    return (rows.join(small_side(starts(spark, path)), ["shard", "seq"])
            .select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))


def query(spark, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-store")
    write(read_table(spark, sf_dir, "documents"), path)
    return digests(spark, path)
