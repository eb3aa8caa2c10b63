"""Operator 5, packing: tokens of all documents into sequences of at most ``capacity`` with little padding.

Method. A document's tokens (its ids and one end id) are cut into full sequences; what is left is cut into
pieces of at most ``piece`` tokens, the last of them short (1 to ``tail`` tokens, in turn): short pieces are
what differencing evens out the windows with. Pieces of a group (about ``windows`` sequences of tokens, bounded) are
dealt to near-equal windows by Karmarkar-Karp multiway differencing: every piece starts as a partial
partition (its size, 0, 0 ...), and the two partitions with the largest spread are merged again and again,
the largest window of one with the smallest of the other, until one is left. If its largest window exceeds
the capacity, the number of windows rises by one and the group is dealt anew.

Every Spark task packs its own documents, so nothing is shuffled and no task holds more than one group.
Sequence ids are the partition number and a running number within it: a repeated task gives the same ids.

Ids are those of the ``tokenizers`` library for the given file. That library encodes about 2 MB a second and
core, so texts of common scripts go through ``tiktoken`` with the merges of the same file, which gives the
same ids four times as fast (tested on whole tables); other texts and other kinds of files go through
``tokenizers`` itself.

Defined results. Null or empty text: the end id only, one piece of length 1. Repeated rows are packed one by
one; a null doc_id stays null. An empty table gives no rows, columns beside ``doc_id`` and ``text`` are ignored.
A text of any length is encoded whole and cut into pieces after that.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import bounded_batches, doc_id, public_id

CAPACITY = 2048
END_ID = 1
#: Sequences that one group fills, tokens of a piece at most, and of a document's short last piece.
WINDOWS = 256
PIECE = 512
TAIL = 64
# Fixed value: the split pattern of byte-level BPE pre-tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Outside these blocks the Unicode tables of two libraries may call a character a letter or not.
_UNUSUAL = re.compile("[^\u0000-\u052f\u2000-\u206f]")


class Encoder:
    """Text -> ids as little-endian 32-bit bytes, exactly those of the tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.merger = self._same_merges(path)

    @staticmethod
    def _same_merges(path: str):
        """The same vocabulary as merge ranks, if the file is a plain byte-level BPE whose ids follow its merges."""
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = (model["type"] == "BPE" and not spec["normalizer"] and pre.get("type") == "ByteLevel" and not pre["add_prefix_space"]
                 and pre.get("use_regex", True) and not model.get("ignore_merges") and not model.get("dropout"))
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model.get("merges", [])]
        if not plain or any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
            return None
        # the byte-level alphabet: printable Latin-1 characters stand for themselves, the others follow from U+0100 on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if i < 256 + len(merges)}
        return tiktoken.Encoding("merges", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        if self.merger is not None:
            for i, text in enumerate(texts):
                if not _UNUSUAL.search(text):
                    out[i] = array("I", self.merger.encode_ordinary(text)).tobytes()
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = array("I", e.ids).tobytes()
        return out


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One encoder a Python worker, kept from task to task."""
    return Encoder(path)


def differencing(sizes: list[int], windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp: (window of each item, sum of each window)."""
    heap = []
    for i, size in enumerate(sizes):
        heap.append((-size, i, (i, None, None), None))
    heapq.heapify(heap)
    serial = len(sizes)

    def dense(spread, sums):
        if sums is None:  # a single piece
            sums = np.zeros(windows, np.int64)
            sums[0] = -spread
        return sums

    while len(heap) > 1:
        spread_a, _, a, sums_a = heapq.heappop(heap)
        spread_b, _, b, sums_b = heapq.heappop(heap)
        sums = dense(spread_a, sums_a) + dense(spread_b, sums_b)[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        sums -= sums[-1]  # only differences matter
        heapq.heappush(heap, (-int(sums[0]), serial, (a, b, order), sums))
        serial += 1
    window_of = np.zeros(len(sizes), np.int64)
    stack = [(heap[0][2], np.arange(windows))] if heap else []
    while stack:
        (a, b, order), names = stack.pop()
        if b is None:
            window_of[a] = names[0]
            continue
        unsorted = np.empty(windows, np.int64)
        unsorted[order] = names
        stack.append((a, unsorted))
        stack.append((b, unsorted[::-1]))
    return window_of, np.bincount(window_of, weights=sizes, minlength=windows).astype(np.int64)


def near_equal_windows(sizes: list[int], capacity: int) -> tuple[np.ndarray, int]:
    """The fewest windows, from the least possible count on, that differencing fills within the capacity."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        window_of, sums = differencing(sizes, windows)
        if sums.max(initial=0) <= capacity:
            return window_of, windows
        windows += 1


def _pack(path: str, capacity: int, windows: int, piece: int, tail: int, end_id: int):
    # a little less than what the windows hold: differencing ends within a few tokens of equal
    budget = windows * (capacity - max(1, capacity // 512))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of, end = encoder(path).encode, np.array([end_id], "<u4").tobytes()
        base, sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33, 0
        out, held, tokens, turn = [], [], 0, 0

        def deal():
            nonlocal held, tokens, sequence
            window_of, n = near_equal_windows([len(h[2]) // 4 for h in held], capacity)
            at = [0] * n
            for (did, start, ids, total), w in zip(held, window_of.tolist()):
                out.append((did, start, len(ids) // 4, ids, total, base + sequence + w, at[w]))
                at[w] += len(ids) // 4
            sequence += n
            held, tokens = [], 0

        def frame():
            nonlocal out
            made, out = out, []
            return pd.DataFrame(made, columns=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        def batches():
            for f in frames:
                rows, weight = [], 0
                for did, text in zip(f["doc_id"], f["text"]):
                    rows.append((did, text))
                    weight += len(text)
                    if weight > 1 << 20:
                        yield rows
                        rows, weight = [], 0
                if rows:
                    yield rows

        for rows in batches():
            for (did, _), ids in zip(rows, ids_of([t for _, t in rows])):
                ids += end
                total, at = len(ids) // 4, 0
                while total - at >= capacity:
                    out.append((did, at, capacity, ids[4 * at:4 * (at + capacity)], total, base + sequence, 0))
                    at, sequence = at + capacity, sequence + 1
                short = 0
                if total - at > 2 * tail:
                    turn, short = turn + 1, 1 + turn % tail
                while at < total:
                    rest = total - short - at if at < total - short else total - at
                    size = min(-(-rest // -(-rest // piece)), budget - tokens)
                    held.append((did, at, ids[4 * at:4 * (at + size)], total))
                    at, tokens = at + size, tokens + size
                    if tokens >= budget:
                        deal()
            if sum(o[2] for o in out) > 1 << 20:
                yield frame()
        if held:
            deal()
        if out:
            yield frame()
    return run


def pack(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, windows: int = WINDOWS, piece: int = PIECE,
         tail: int = TAIL, end_id: int = END_ID) -> DataFrame:
    """A row per piece: (doc_id, start, length, ids, doc_tokens, sequence_id, offset); ``ids`` little-endian 32-bit."""
    docs = bounded_batches(documents).select(doc_id().alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    packed = docs.mapInPandas(_pack(tokenizer, capacity, windows, piece, tail, end_id),
                              "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    return packed.withColumn("doc_id", public_id("doc_id"))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def query(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    from sluice.llm.common import table
    return digest(pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))
