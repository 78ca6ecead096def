"""SentencePiece encoding and decoding in numpy batches.

A text becomes words that start with the space mark; no piece crosses from one word to the
next, so words are segmented by themselves, each distinct one once per batch.  Equal-length
words advance together: hashes of all their substrings are looked up in the sorted hashes
of the pieces.  Then,

* for a unigram model, a batched Viterbi: at each position one vectorised maximum over the
  piece lengths stores the highest sum of scores and the backpointer;
* for a merge model (its scores are merge ranks, whose sums mean nothing: the highest sum
  cuts "Hello" into " H", "el", "lo"), the model's merges: in every step one vectorised
  maximum over each word's neighbours picks the best-ranked merge, the leftmost of equals.

Either is what the library gives for such a model.  Characters that no piece covers are
their UTF-8 bytes' pieces.  Decoding joins the pieces' bytes.

Defined results: null and empty texts have no ids; any text decodes to itself (a literal
space mark U+2581 is encoded as bytes); rows are encoded each for itself; in the Viterbi
equal sums go to the longer last piece; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogprep.llm._common import read_table

MARK = "▁"
MODEL = "piece_bpe_32k.model"
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_BASE = np.uint64(0x100000001B3)
_SEEN = 22
LONG = 256
CACHED = 300_000


def model_path() -> str:
    """The public model file that the queries use."""
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class Pieces:
    """Pieces, scores and byte pieces of a model file; encodes and decodes."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.byte_ids = np.full(256, -1, dtype=np.int32)
        self.bytes_of: list[bytes] = []
        texts, ids, scores = [], [], []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.bytes_of.append(piece.replace(MARK, " ").encode())
                texts.append(piece)
                ids.append(i)
                scores.append(sp.get_score(i))
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no byte pieces, so it can't encode every text")
        self.longest = max(map(len, texts))
        keys = np.array([self._key(t) for t in texts], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(ids, dtype=np.int32)[order]
        self.scores = np.array(scores, dtype=np.float64)[order]
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two pieces share a hash")
        #: merge ranks are whole numbers below zero
        self.merges = bool(np.all(self.scores == np.floor(self.scores)) and len(np.unique(self.scores)) > len(texts) // 2)
        self.uncovered = self.scores.min() - 10.0
        self.piece_text = {i: t for i, t in zip(ids, texts)}
        #: which high bits of hashes occur at all, so that few substrings are searched for
        self.seen = np.zeros(1 << _SEEN, dtype=bool)
        self.seen[self.keys >> np.uint64(64 - _SEEN)] = True
        #: words' ids: those of the last batches, and those that were used before these
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def _key(text: str) -> np.uint64:
        return _substring_keys(np.array([[ord(c) for c in text]], dtype=np.uint64), len(text))[0, 0]

    def segment(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as little-endian 32-bit integers."""
        out: list = [None] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            step = max(1, (1 << 20) // int(n * min(n, self.longest)))
            for k in range(0, len(at), step):
                part = at[k:k + step]
                cut = [words[i] for i in part]
                hit = self._hits(cut, int(n))
                if self.merges and n <= LONG:
                    found = self._merge(cut, hit)
                else:
                    found = [self._ids(*x) for x in zip(cut, hit, self._merge_long(hit) if self.merges else self._viterbi(hit))]
                for i, ids in zip(part, found):
                    out[i] = ids
        return out

    def _hits(self, words: list[str], n: int) -> np.ndarray:
        """Place among the sorted keys of every substring, by word, start and length - 1; -1: no piece."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), n).astype(np.uint64)
        hit = np.full((len(words), n, min(n, self.longest)), -1, dtype=np.int32)
        for length in range(1, hit.shape[2] + 1):
            key = _substring_keys(codes, length)
            row, start = np.nonzero(self.seen[key >> np.uint64(64 - _SEEN)])
            key = key[row, start]
            place = np.searchsorted(self.keys, key)
            place[place == len(self.keys)] = 0
            hit[row, start, length - 1] = np.where(self.keys[place] == key, place, -1)
        return hit

    def _viterbi(self, hit: np.ndarray) -> list[list[int]]:
        """Bounds of the pieces with the highest sum of scores."""
        rows, n, longest = hit.shape
        best = np.full((rows, n + 1), -np.inf)
        best[:, 0] = 0.0
        back = np.zeros((rows, n + 1), dtype=np.int16)  # length of the last piece
        score = np.where(hit >= 0, self.scores[hit], -np.inf)
        score[:, :, 0] = np.where(hit[:, :, 0] >= 0, score[:, :, 0], self.uncovered)
        every = np.arange(rows)
        for end in range(1, n + 1):
            lens = np.arange(min(end, longest), 0, -1)
            options = best[:, end - lens] + score[:, end - lens, lens - 1]
            pick = options.argmax(axis=1)
            best[:, end] = options[every, pick]
            back[:, end] = lens[pick]
        out = []
        for steps in back.tolist():
            bounds = [n]
            while bounds[-1]:
                bounds.append(bounds[-1] - steps[bounds[-1]])
            out.append(bounds[::-1])
        return out

    def _merge(self, words: list[str], hit: np.ndarray) -> list[bytes]:
        """Ids after all merges; every step merges once in every word."""
        rows, n, longest = hit.shape
        score = np.where(hit >= 0, self.scores[hit], -np.inf)
        out: list = [None] * rows
        who, bound = np.arange(rows), np.tile(np.arange(n + 1), (rows, 1))
        while len(who):
            m = bound.shape[1]
            if m == 2:
                gone = np.ones(len(who), dtype=bool)
            else:
                start, length = bound[:, :-2], bound[:, 2:] - bound[:, :-2]
                options = np.where(length <= longest, score[who[:, None], start, np.minimum(length, longest) - 1], -np.inf)
                pick = options.argmax(axis=1)
                gone = np.isinf(options[np.arange(len(who)), pick])
            done, ends = who[gone], bound[gone]
            place = hit[done[:, None], ends[:, :-1], np.diff(ends, axis=1) - 1]
            ids = self.ids[place].astype("<i4").tobytes()
            width = 4 * (m - 1)
            for i, (r, covered) in enumerate(zip(done.tolist(), (place >= 0).all(axis=1).tolist())):
                out[r] = ids[i * width:(i + 1) * width] if covered else self._ids(words[r], hit[r], ends[i].tolist())
            if gone.all():
                break
            stay = ~gone
            who, kept = who[stay], np.arange(m - 1)[None, :]
            bound = np.take_along_axis(bound[stay], kept + (kept >= pick[stay][:, None] + 1), axis=1)
        return out

    def _merge_long(self, hit: np.ndarray) -> list[list[int]]:
        """The same for words of very many characters, by a queue of merges."""
        return [self._queue_merges(row) for row in hit]

    def _queue_merges(self, row: np.ndarray) -> list[int]:
        n, longest = row.shape
        after, before, live = list(range(1, n + 2)), list(range(-1, n)), [True] * n

        def offer(left: int) -> None:
            end = after[after[left]] if after[left] < n else n + 1
            if left >= 0 and end <= n and end - left <= longest and row[left, end - left - 1] >= 0:
                heapq.heappush(queue, (-self.scores[row[left, end - left - 1]], left, after[left], end))

        queue: list = []
        for i in range(n - 1):
            offer(i)
        while queue:
            _, left, mid, end = heapq.heappop(queue)
            if not (live[left] and mid < n and live[mid] and after[left] == mid and after[mid] == end):
                continue
            live[mid] = False
            after[left] = end
            if end < n:
                before[end] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        return [i for i in range(n) if live[i]] + [n]

    def _ids(self, word: str, row: np.ndarray, bounds: list[int]) -> bytes:
        ids: list[int] = []
        for a, b in zip(bounds, bounds[1:]):
            place = row[a, b - a - 1]
            if place >= 0:
                ids.append(self.ids[place])
            else:  # one character that no piece covers
                ids += self.byte_ids[list(word[a:b].encode())].tolist()
        return np.array(ids, dtype="<i4").tobytes()

    def _words(self, text: str) -> list[str | None]:
        """Words with the space mark; None stands for a literal mark."""
        if not text:
            return []
        out: list[str | None] = []
        for i, part in enumerate(text.split(MARK)):
            if i:
                out.append(None)
            out += _WORD.findall((MARK if not i else "") + part.replace(" ", MARK))
        return out

    def _known(self, words: set[str]) -> None:
        """See that ``cache`` holds these words; ones in use outlive those met once."""
        if len(self.cache) > CACHED:
            self.cache, self.older = {}, self.cache
        new = []
        for w in words:
            if w not in self.cache:
                if w in self.older:
                    self.cache[w] = self.older[w]
                else:
                    new.append(w)
        self.cache.update(zip(new, self.segment(new)))

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [self._words(t or "") for t in texts]
        self._known({w for words in split for w in words if w is not None})
        literal = self.byte_ids[list(MARK.encode())].astype("<i4").tobytes()
        known = self.cache
        return [np.frombuffer(b"".join([literal if w is None else known[w] for w in words]), "<i4") for words in split]

    def decode(self, ids: np.ndarray) -> str:
        """The text; the space mark put before its first word goes."""
        of = self.bytes_of
        return b"".join([of[i] for i in ids.tolist()])[1:].decode()


def _substring_keys(codes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all substrings of this length, by row."""
    with np.errstate(over="ignore"):
        m = codes.shape[1] - length + 1
        h = np.full((len(codes), m), np.uint64(length) * np.uint64(0x9E3779B97F4A7C15), dtype=np.uint64)
        for j in range(length):
            h = (h ^ codes[:, j:m + j]) * _BASE
            h ^= h >> np.uint64(29)
        return h


_LOADED: dict[str, Pieces] = {}


def load(path: str) -> Pieces:
    """The model, loaded once in each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def _encoded(path: str, texts: list[str | None], chars: int = 1 << 22):
    """Ids of each text, in parts of bounded text, as very long texts may stand together."""
    part, held = [], 0
    for t in texts:
        part.append(t)
        held += len(t or "")
        if held > chars:
            yield from load(path).encode_batch(part)
            part, held = [], 0
    yield from load(path).encode_batch(part)


def encode(docs: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with n_tokens and ids (array) of every whole text."""
    path = path or model_path()

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        found = list(_encoded(path, texts.to_pylist()))
        ends = np.cumsum([0, *map(len, found)])
        flat = np.concatenate(found) if found else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    return docs.select(*keep, ids("text").alias("ids")).select(*keep, F.size("ids").cast("long").alias("n_tokens"), "ids")


def decode(encoded: DataFrame, path: str | None = None, column: str = "ids") -> DataFrame:
    """``encoded`` with the text of each row's ids."""
    path = path or model_path()

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        return pd.Series([load(path).decode(np.asarray(x)) for x in ids], dtype=object)

    return encoded.withColumn("text", text(column))


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (ids as little-endian 32-bit integers), n_chars of the
    decoded text, and whether it is the text that was encoded, for every row."""
    path = path or model_path()

    @F.pandas_udf("n_tokens long, ids_crc32 long, n_decoded long, exact boolean")
    def trip(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t, ids in zip(texts, _encoded(path, texts.tolist())):
            back = load(path).decode(ids)
            out.append((len(ids), crc32(ids.astype("<i4").tobytes()), len(back), back == (t or "")))
        return pd.DataFrame(out, columns=["n_tokens", "ids_crc32", "n_decoded", "exact"])

    return docs.select("doc_id", trip("text").alias("t")).select("doc_id", "t.*")


def query(spark, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "documents"))
