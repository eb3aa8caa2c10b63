"""Operator 11, token ids as binary segments with Elias-Fano document boundaries.

Method. Documents are range-partitioned and sorted by id; each partition (a shard) is encoded in that order and
written as segments. A segment is one concatenated id array and the places where its documents start, coded after
Elias and Fano: of ``n`` increasing numbers up to ``u``, the lowest ``log2(u/n)`` bits of each are packed, the rest
is a bit vector in which number ``i`` sets bit ``(number >> low) + i``. ``select`` finds the i-th set bit from a
32-bit sample of every 256th one and the counts of a few words, so that an offset costs a few reads and about
``2.1 + log2(u/n)`` bits instead of 64. Ids of documents are coded the same way.

File format. A folder of Parquet files, a row a segment: ``shard``, ``segment`` (from 0), ``doc_start`` and ``start``
(documents and ids of the shard before it), ``n_docs``, ``n_ids``, ``width`` (bytes an id, little-endian unsigned: 2
for vocabularies below 65,536, else 4), ``ids``, ``bounds`` (n_docs + 1 places, the last one ``n_ids``), ``n_null``
(leading documents without id), ``first_id`` and ``doc_ids`` (of the others, less the first). Spark's writer commits
whole files, so a lost executor leaves no half-written segment, on any file system that Spark can write to.

Scale. Texts are shuffled once. A segment ends after ``SEGMENT_BYTES`` of ids or ``SEGMENT_DOCS`` documents. Rows
of one id are spread by a hash of the text, equal rows by their place in the input. Reading shuffles nothing: the
only table sent to the tasks has one row a shard.

Ids are those of the ``tokenizers`` library. Where the file's normaliser and splitting drop white space and never
look across it (checked in the file), each distinct word is encoded once and texts are put together from words;
other files go through the library text by text. Words of common scripts go through ``tiktoken`` with the same
merges, its end-of-word mark as one more byte. It merges two neighbours if their joined bytes are a token, the
library if the pair itself is in the list: the same if every token, encoded by itself, gives itself, because tokens
never shrink, so that within the bytes of a token nothing else can have happened than in the token alone. That is
checked for the whole list before a job; other words, and other files, go through the library.

Defined results. Null or empty text: the end id only. Null ids come first and stay null. Rows of one id come in the
order of their texts' 64-bit hash; repeated rows are written one by one. An empty table gives no rows. Texts of any
length are encoded whole; a document's ids must fit one row (2 GB).
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import NULL_ID, Stored, bounded_batches, doc_id, public_id, table, text_version

END_ID = 2
SEGMENT_BYTES = 4 << 20
SEGMENT_DOCS = 1 << 16
#: Ones from one select sample to the next; bytes of text whose words are looked up at once.
SAMPLE = 256
PIECE = 2 << 20
#: Words that a worker remembers, and bytes of the longest of them.
CACHE_WORDS = 100_000
CACHE_LENGTH = 64
FILE = ("shard int, segment int, doc_start long, start long, n_docs int, n_ids long, width int, ids binary, bounds binary, "
        "n_null int, first_id long, doc_ids binary")
_SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")
# Fixed value: the pattern of word-end BPE pre-tokenizers (matches are kept, white space between them is dropped).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class EliasFano:
    """Non-decreasing integers from 0 to ``universe`` (below 2**64) with constant-time access to each."""

    HEAD = struct.Struct("<QQB")

    def __init__(self, n: int, universe: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.universe, self.low_bits, self.low, self.high, self.samples = n, universe, low_bits, low, high, samples

    @classmethod
    def build(cls, values, universe: int) -> EliasFano:
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        low_bits = max(0, (universe // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        upper = (v >> np.uint64(low_bits)) if low_bits < 64 else np.zeros(n, np.uint64)
        ones = upper.astype(np.int64) + np.arange(n)
        bits = np.zeros(-(-(n + (universe >> low_bits) + 1) // 64) * 64, np.uint8)
        bits[ones] = 1
        high = np.packbits(bits, bitorder="little").view("<u8")
        return cls(n, universe, low_bits, low, high, ones[::SAMPLE].astype("<u4"))

    def tobytes(self) -> bytes:
        return self.HEAD.pack(self.n, self.universe, self.low_bits) + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def frombytes(cls, data: bytes) -> EliasFano:
        n, universe, low_bits = cls.HEAD.unpack_from(data)
        at = cls.HEAD.size
        sizes = (-(-n * low_bits // 8), -(-(n + (universe >> low_bits) + 1) // 64), -(-n // SAMPLE))
        low = np.frombuffer(data, np.uint8, sizes[0], at)
        high = np.frombuffer(data, "<u8", sizes[1], at + sizes[0])
        return cls(n, universe, low_bits, low, high, np.frombuffer(data, "<u4", sizes[2], at + sizes[0] + 8 * sizes[1]))

    def select(self, which) -> np.ndarray:
        """The numbers at the places ``which``, each found by itself."""
        i = np.asarray(which, dtype=np.int64)
        if not len(i):
            return np.zeros(0, np.uint64)
        at = self.samples[i // SAMPLE].astype(np.int64)
        left, word = i % SAMPLE, at >> 6
        bits = self.high[word] & (np.uint64(0xFFFFFFFFFFFFFFFF) << (at & 63).astype(np.uint64))
        while True:  # on to the word that holds the bit
            ones = np.bitwise_count(bits).astype(np.int64)
            on = np.flatnonzero(left >= ones)
            if not len(on):
                break
            left[on] -= ones[on]
            word[on] += 1
            bits[on] = self.high[word[on]]
        rank = np.cumsum(np.unpackbits(bits.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=1, dtype=np.int64)
        upper = (word << 6) + (rank == left[:, None] + 1).argmax(1) - i
        return (upper.astype(np.uint64) << np.uint64(self.low_bits)) | self._low(i)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low_bits
        padded = np.concatenate([self.low, np.zeros(9, np.uint8)])
        window = padded[(bit >> 3)[:, None] + np.arange(9)]
        shift = (bit & 7).astype(np.uint64)
        value = np.ascontiguousarray(window[:, :8]).view("<u8").ravel() >> shift
        # the ninth byte holds the last bits of a number that starts late in the first one
        value |= np.where(shift > 0, window[:, 8].astype(np.uint64) << (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0))
        return value & np.uint64((1 << self.low_bits) - 1)


def _classes() -> tuple[str, str, str]:
    """Characters whose treatment no library's tables change: all of them, the letters and the numbers, as class bodies."""
    stable = [chr(c) for c in (*range(0x21, 0x530), *range(0x2010, 0x205F))]
    stable = [c for c in stable if unicodedata.category(c)[0] not in "CMZ" and unicodedata.normalize("NFC", c) == c]
    stable = [c for c in stable if set(c.lower()) <= set(stable) and c != "\u03a3"]  # a final sigma depends on its place
    of = lambda kind: "".join(re.escape(c) for c in stable if unicodedata.category(c)[0] in kind)
    return of("LNPS"), of("L"), of("N")


_STABLE, _LETTERS, _NUMBERS = _classes()
_UNUSUAL = re.compile(f"[^{_STABLE}\n]")
_PRETOKEN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^ {_LETTERS}{_NUMBERS}]+")
END = "</w>"
#: Stands for the end-of-word mark: a byte that no word of common scripts holds.
MARK = b"\0"


def _steps(part, inner):
    return part[inner] if part and part["type"] == "Sequence" else [part] if part else []


def drops_space(spec: dict) -> bool:
    """Whether a text's ids are those of its words (stretches without ASCII white space), one after the other."""
    normal = all(s["type"] in ("NFC", "Lowercase") or (s["type"] == "Replace" and s["pattern"] == {"Regex": r"\s+"} and s["content"] == " ")
                 for s in _steps(spec["normalizer"], "normalizers"))
    split = _steps(spec["pre_tokenizer"], "pretokenizers")
    words = (len(split) == 2 and split[0]["type"] == "Split" and split[0]["pattern"] == {"Regex": WORD_PATTERN}
             and split[0]["behavior"] == "Removed" and split[0]["invert"]
             and split[1]["type"] == "ByteLevel" and not split[1]["add_prefix_space"] and not split[1]["use_regex"])
    return normal and words and spec["post_processor"] is None and all(t["special"] for t in spec["added_tokens"])


def byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """Token bytes (the mark for a word's end) -> id, if ids follow the merges and every token encodes to itself."""
    model = spec["model"]
    normal = {s["type"] for s in _steps(spec["normalizer"], "normalizers")}
    plain = (model["type"] == "BPE" and model.get("end_of_word_suffix") == END and not model.get("continuing_subword_prefix")
             and not model.get("dropout") and not model.get("ignore_merges") and "Lowercase" in normal)
    if not plain:
        return None
    vocab = model["vocab"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    rank = {pair: i for i, pair in enumerate(merges)}
    if any(vocab.get(a + b) != 512 + i for i, (a, b) in enumerate(merges)):
        return None
    # the byte-level alphabet: printable Latin-1 characters stand for themselves, the others follow from U+0100 on
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    if any(vocab.get(c, 512) >= 256 or not 256 <= vocab.get(c + END, 0) < 512 for c in byte_of):
        return None
    for a, b in merges:
        token = a + b
        body = token.removesuffix(END)
        parts = [*body[:-1], body[-1] + token[len(body):]]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: rank.get((parts[i], parts[i + 1]), len(rank)))
            if (parts[best], parts[best + 1]) not in rank:
                return None
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
    ids = {t: i for t, i in vocab.items() if i < 512 + len(merges)}
    return {bytes(byte_of[c] for c in t.removesuffix(END)) + (MARK if t.endswith(END) else b""): i for t, i in ids.items()}


class WordEncoder:
    """Texts -> ids as little-endian unsigned integers of ``width`` bytes, the end id behind each text."""

    def __init__(self, path: str, end_id: int, ranks: dict[bytes, int] | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.width = 2 if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        self.type = f"<u{self.width}"
        self.end = np.array([end_id], self.type).tobytes()
        self.by_word, self.merger = ranks is not None, None
        if ranks:
            import tiktoken
            self.merger = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00|\x00", mergeable_ranks=ranks, special_tokens={})
            self.gap = ranks[MARK]
        self.known: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.type).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _marked(self, words: str) -> list[bytes]:
        """Ids of words of common scripts: each part of a word ends with the mark, a single mark parts the words."""
        marked = _PRETOKEN.sub("\\g<0>\0", words.lower()).replace(" ", "\0")
        ids = self.merger.encode_to_numpy(marked)
        cut = np.flatnonzero(ids == self.gap) * self.width
        data = ids.astype(self.type).tobytes()
        return [data[a:b] for a, b in zip([0, *(cut + self.width).tolist()], [*cut.tolist(), len(data)])]

    def _words(self, words: list[bytes]) -> dict[bytes, bytes]:
        text = b"\n".join(words).decode()
        rest, end = [], -1
        for m in _UNUSUAL.finditer(text) if self.merger else ():  # words hold no white space
            if m.start() > end:
                end = text.find("\n", m.start())
                end = len(text) if end < 0 else end
                rest.append(text[text.rfind("\n", 0, m.start()) + 1:end])
        if not self.merger:
            rest = text.split("\n")
        out = dict(zip([w.encode() for w in rest], self._ids(rest))) if rest else {}
        usual = [w for w in words if w not in out] if rest else words
        if usual:
            out.update(zip(usual, self._marked(b" ".join(usual).decode() if rest else text.replace("\n", " "))))
        return out

    def _join(self, pieces: list[list[bytes]]) -> list[bytes]:
        """Ids of lists of words; words that are not known yet are encoded together."""
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        words = list(set().union(*pieces).difference(self.known))
        if words:
            self.known.update(self._words(words))
        joined = [b"".join(map(self.known.__getitem__, p)) for p in pieces]
        for word in words:
            if len(word) > CACHE_LENGTH:
                del self.known[word]
        return joined

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [ids + self.end for ids in self._ids(texts)]
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, bytes]] = []
        weight = 0

        def flush():
            nonlocal held, weight
            for (i, _), ids in zip(held, self._join([p.split() for _, p in held])):
                out[i].append(ids)
            held, weight = [], 0

        for i, text in enumerate(texts):
            data, at = text.encode(), 0
            while at < len(data):  # long texts piece by piece, cut at white space
                space = _SPACE.search(data, at + PIECE) if len(data) - at > PIECE else None
                to = space.start() if space else len(data)
                held.append((i, data[at:to]))
                at, weight = to, weight + to - at
                if weight >= PIECE:
                    flush()
        flush()
        return [b"".join(ids) + self.end for ids in out]


@lru_cache(2)
def token_bytes(path: str) -> dict[bytes, int] | None:
    """None: texts go through the library whole; empty: word by word; else the ranks for words of common scripts."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return (byte_ranks(spec) or {}) if drops_space(spec) else None


_encoders: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, end_id: int, ranks: dict[bytes, int] | None) -> WordEncoder:
    """One encoder a Python worker, kept from task to task."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = WordEncoder(path, end_id, ranks)
    return _encoders[path, end_id]


def _segments(path: str, end_id: int, segment_bytes: int, segment_docs: int):
    """Documents of one shard in order -> its segments."""
    ranks = token_bytes(path)
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, shard = encoder(path, end_id, ranks), TaskContext.get().partitionId()
        segment, doc_start, start, dids, ids, weight = 0, 0, 0, [], [], 0

        def row():
            nonlocal segment, doc_start, start, dids, ids, weight
            ends = np.cumsum([0] + [len(i) // enc.width for i in ids])
            n_null = sum(d == NULL_ID for d in dids)  # they sort first
            own = dids[n_null:]
            relative = [d - own[0] for d in own]  # up to 2**64, so Python integers
            made = (shard, segment, doc_start, start, len(ids), int(ends[-1]), enc.width, b"".join(ids), EliasFano.build(ends, int(ends[-1])).tobytes(),
                    n_null, own[0] if own else 0, EliasFano.build(relative, relative[-1] if own else 0).tobytes())
            segment, doc_start, start = segment + 1, doc_start + len(ids), start + int(ends[-1])
            dids, ids, weight = [], [], 0
            return pd.DataFrame([made], columns=[c.split()[0] for c in FILE.split(", ")])

        for f in frames:
            texts, at = f["text"].tolist(), 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and size < PIECE:
                    size, to = size + len(texts[to]), to + 1
                for did, encoded in zip(f["did"].iloc[at:to].tolist(), enc.encode(texts[at:to])):
                    dids.append(did)
                    ids.append(encoded)
                    weight += len(encoded)
                    if weight >= segment_bytes or len(ids) >= segment_docs:
                        yield row()
                at = to
        if ids:
            yield row()
    return run


def write_tokens(documents: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, segment_bytes: int = SEGMENT_BYTES,
                 segment_docs: int = SEGMENT_DOCS, mode: str = "errorifexists") -> None:
    """Encode every document and write the segments to the folder ``path``, in ascending order of ids."""
    segments(documents, tokenizer, end_id, segment_bytes, segment_docs).write.mode(mode).parquet(path)


def segments(documents: DataFrame, tokenizer: str, end_id: int = END_ID, segment_bytes: int = SEGMENT_BYTES,
             segment_docs: int = SEGMENT_DOCS) -> DataFrame:
    """The rows of the file: one a segment, shards in the order of document ids."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = bounded_batches(documents).select(doc_id().alias("did"), text_version(text).alias("tv"), F.monotonically_increasing_id().alias("place"), text.alias("text"))
    ordered = docs.repartitionByRange("did", "tv", "place").sortWithinPartitions("did", "tv")
    return ordered.select("did", "text").mapInPandas(_segments(tokenizer, end_id, segment_bytes, segment_docs), FILE)


def _documents(first: int, last: int | None):
    """Segments -> their documents with numbers from ``first`` to before ``last``, located by ``select``."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for s in f.itertuples(index=False):
                number = int(s.base_docs) + int(s.doc_start)
                lo, hi = max(0, first - number), s.n_docs if last is None else min(s.n_docs, last - number)
                if lo >= hi:
                    continue
                which = np.arange(lo, hi)
                bounds = EliasFano.frombytes(s.bounds).select(np.arange(lo, hi + 1)).astype(np.int64)
                ids = np.frombuffer(s.ids, f"<u{s.width}")
                named = which[which >= s.n_null]
                dids = [NULL_ID] * (len(which) - len(named))
                if len(named):
                    dids += [int(s.first_id) + int(d) for d in EliasFano.frombytes(s.doc_ids).select(named - s.n_null)]
                yield pd.DataFrame({"doc_id": dids, "number": number + which, "start": int(s.base) + int(s.start) + bounds[:-1], "n_tokens": np.diff(bounds),
                                    "ids": [ids[a:b].astype("<u4").tobytes() for a, b in zip(bounds, bounds[1:])]})
    return run


def read_tokens(spark: SparkSession, path: str, first: int = 0, last: int | None = None) -> DataFrame:
    """(doc_id, number, start, n_tokens, ids) of the documents numbered from ``first`` to before ``last`` in the file.

    ``start`` counts the ids of all documents before; ``ids`` are little-endian 32-bit. Segments outside the range
    are not decoded, and shards outside it not read.
    """
    files = spark.read.parquet(path)
    shards, base, docs = [], 0, 0
    # one row a shard: a shuffle partition of the writing job
    for r in files.groupBy("shard").agg(F.sum("n_ids").alias("ids"), F.sum("n_docs").alias("docs")).orderBy("shard").collect():
        if docs + r["docs"] > first and (last is None or docs < last):
            shards.append((r["shard"], base, docs))
        base, docs = base + r["ids"], docs + r["docs"]
    starts = spark.createDataFrame(shards, "shard int, base long, base_docs long")
    if first or last is not None:
        files = files.where(F.col("shard").isin([s[0] for s in shards]))
    rows = bounded_batches(files).join(F.broadcast(starts), "shard").mapInPandas(
        _documents(first, last), "doc_id long, number long, start long, n_tokens long, ids binary")
    return rows.withColumn("doc_id", public_id("doc_id"))


def query(spark, sf_dir) -> DataFrame:
    import public_tokenizers
    written = Stored(segments(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")), "token-ids")
    return read_tokens(spark, written.path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
