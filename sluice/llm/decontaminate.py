"""Operator 2, benchmark decontamination by greedy string tiling.

Method. Words are compared folded: case ignored, punctuation around them left out. Documents are joined with
the benchmark on shared seeds, runs of ``seed`` words. A pair whose shared seeds could cover ``threshold`` of
the item's words is tiled: running Karp-Rabin hashes find the longest matches of unmarked words, these are
marked longest first without overlap, and the search length falls until no match of at least ``seed`` words is
left. Tiles may stand in any order, so reordered passages are caught. Pairs whose tiles cover at least
``threshold`` of the item are reported.

The benchmark is the query set: it is read in blocks of bounded size, each sent to the tasks that stream all
documents past it, so nothing is shuffled. A block costs one pass over the documents. A seed that many items share
costs a document that holds it one look at each of these items; only items of which enough seeds are there go on.

Defined results. Null or empty texts on either side: no match; texts of any length are compared whole. An item of fewer than ``seed`` words must be
found whole. Repeated benchmark rows count once, items of one id with different texts each; repeated
documents give repeated rows. Null ids stay null. Empty tables give no rows. Words are compared by 64-bit
hashes.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import U64, WordHash, chunks, doc_id, gram_hashes, public_id, texts
from sluice.llm.substring_dedup import words_of

SEED = 5
THRESHOLD = 0.5
#: Characters of benchmark texts in a block, about.
BLOCK_CHARS = 8 << 20
CHUNK_BYTES = 4 << 20
_FILTER_BITS = 22


class FoldedHash(WordHash):
    """Words folded to lower case without punctuation around them; 0 if nothing is left."""

    def __missing__(self, word: bytes) -> int:
        text = word.decode("utf-8", "replace").casefold()
        lo, hi = 0, len(text)
        while lo < hi and not text[lo].isalnum():
            lo += 1
        while hi > lo and not text[hi - 1].isalnum():
            hi -= 1
        value = self[word] = (xxhash.xxh3_64_intdigest(text[lo:hi]) or 1) if hi > lo else 0
        return value

    def folded(self, text: str) -> np.ndarray:
        words = self.array(words_of(text))
        return words[words != 0]


def greedy_tiles(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(place in item, place in doc, words) of the tiles, longest matches first."""
    marked_item, marked_doc = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    tiles: list[tuple[int, int, int]] = []
    length = max(least, min(len(item), 32))
    while True:
        matches = _matches(item, doc, marked_item, marked_doc, length)
        longest = max((n for _, _, n in matches), default=0)
        if longest > 2 * length:  # long matches first
            length = longest
            continue
        heap = [(-n, p, t) for p, t, n in matches]
        heapq.heapify(heap)
        while heap:
            n, p, t = heapq.heappop(heap)
            used = marked_item[p:p - n] | marked_doc[t:t - n]
            if not used.any():
                tiles.append((p, t, -n))
                marked_item[p:p - n] = marked_doc[t:t - n] = True
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[1], used, [1]])))  # what earlier tiles left over of it
            for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
                if hi - lo >= length:
                    heapq.heappush(heap, (lo - hi, p + lo, t + lo))
        if length <= least:
            return tiles
        length = max(least, length // 2)


def _matches(item, doc, marked_item, marked_doc, length):
    """Maximal matches of unmarked words of at least ``length``, found by their rolling hashes."""
    places: dict[int, list[int]] = {}
    for p, h in zip(*_free_grams(item, marked_item, length)):
        places.setdefault(h, []).append(p)
    if not places:
        return []
    at, hashes = _free_grams(doc, marked_doc, length, arrays=True)
    hit = np.isin(hashes, np.fromiter(places, U64, len(places)))
    out = []
    for t, h in zip(at[hit].tolist(), hashes[hit].tolist()):
        for p in places[h]:
            if p and t and item[p - 1] == doc[t - 1] and not marked_item[p - 1] and not marked_doc[t - 1]:
                continue  # not maximal: found one word earlier
            limit = min(len(item) - p, len(doc) - t)
            differ = (item[p:p + limit] != doc[t:t + limit]) | marked_item[p:p + limit] | marked_doc[t:t + limit]
            n = int(differ.argmax()) if differ.any() else limit
            if n >= length:
                out.append((p, t, n))
    return out


def _free_grams(words, marked, length, arrays=False):
    hashes = gram_hashes(words, length)
    blocked = np.concatenate([[0], np.cumsum(marked)])
    at = np.flatnonzero(blocked[length:] == blocked[:len(blocked) - length]) if len(hashes) else np.zeros(0, np.int64)
    return (at, hashes[at]) if arrays else (at.tolist(), hashes[at].tolist())


class Seeds:
    """All seeds of a block of items, sorted, with the places they stand in."""

    def __init__(self, items: list[tuple[int, np.ndarray]], seed: int):
        self.items, self.lengths = items, sorted({min(seed, len(w)) for _, w in items})
        self.words = np.array([len(w) for _, w in items])
        self.by_length = {}
        for size in self.lengths:
            rows = [(h, i, p) for i, (_, w) in enumerate(items) if min(seed, len(w)) == size
                    for p, h in enumerate(gram_hashes(w, size).tolist())]
            rows.sort()
            hashes = np.array([r[0] for r in rows], U64)
            quick = np.zeros(1 << _FILTER_BITS, bool)
            quick[hashes >> U64(64 - _FILTER_BITS)] = True
            self.by_length[size] = (hashes, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), quick)

    def candidates(self, doc_grams: dict[int, np.ndarray], threshold: float) -> list[int]:
        """Items that the seeds shared with a document could cover up to the threshold."""
        out = []
        for size, grams in doc_grams.items():
            hashes, owner, place, quick = self.by_length[size]
            found = np.unique(grams[quick[grams >> U64(64 - _FILTER_BITS)]])
            lo, hi = np.searchsorted(hashes, found, "left"), np.searchsorted(hashes, found, "right")
            n = hi - lo
            if not n.sum():
                continue
            rows = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            # an item needs enough seeds to cover its share of words: one that shares a common seed only is done here
            some, at = np.unique(owner[rows], return_inverse=True)
            enough = np.bincount(at) * size >= threshold * self.words[some]
            rows, at = rows[enough[at]], np.cumsum(enough)[at[enough[at]]] - 1
            some = some[enough]
            if not len(some):
                continue
            words = self.words[some]
            base = np.cumsum(words + 1) - words - 1
            covered = np.bincount(base[at] + place[rows], minlength=int(base[-1] + words[-1] + 1))
            covered -= np.bincount(base[at] + np.minimum(place[rows] + size, words[at]), minlength=len(covered))
            inside = np.cumsum(covered) > 0  # back to 0 at the end of each item
            out += some[np.add.reduceat(inside.astype(np.int64), base) >= threshold * words].tolist()
        return out


def _tile(seeds: Seeds, seed: int, threshold: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = FoldedHash()
        for rows in chunks(frames, CHUNK_BYTES):
            cache.trim()
            docs = [cache.folded(text) for *_, text in rows]
            bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
            joined = np.concatenate(docs)
            grams = {size: gram_hashes(joined, size) for size in seeds.lengths}
            # documents without any hash of the quick filter are passed over; grams across documents only add candidates
            hits = {size: np.concatenate([[0], np.cumsum(seeds.by_length[size][3][g >> U64(64 - _FILTER_BITS)])]) for size, g in grams.items()}
            out = []
            for (did, tv, _), doc, a, b in zip(rows, docs, bounds, bounds[1:]):
                own = {s: g[a:b - s + 1] for s, g in grams.items() if b - a >= s and hits[s][b - s + 1] > hits[s][a]}
                for i in seeds.candidates(own, threshold):
                    item_id, words = seeds.items[i]
                    tiles = greedy_tiles(words, doc, min(seed, len(words)))
                    covered = sum(n for _, _, n in tiles)
                    if covered >= threshold * len(words):
                        spans = [{"item_start": p, "doc_start": t, "n_words": n} for p, t, n in tiles]
                        out.append((did, tv, item_id, len(words), covered, covered / len(words), spans))
            if out:
                yield pd.DataFrame(out, columns=["doc_id", "tv", "item_id", "item_words", "covered", "coverage", "tiles"])
    return run


SCHEMA = "doc_id long, tv long, item_id long, item_words int, covered int, coverage double, tiles array<struct<item_start:int,doc_start:int,n_words:int>>"


def contaminated(documents: DataFrame, benchmark: DataFrame, seed: int = SEED, threshold: float = THRESHOLD,
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row per document and benchmark item that its tiles cover up to the threshold; tiles count folded words.

    ``tv`` is the text version of ``common.texts``: it tells documents of one id apart.
    """
    spark = documents.sparkSession
    items = benchmark.select(doc_id("item_id").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    docs = texts(documents).withColumnRenamed("did", "doc_id")
    out = spark.createDataFrame([], SCHEMA)
    for block in range(blocks):
        cache = FoldedHash()
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()  # bounded by block_chars
        held = [(r["item_id"], w) for r in rows if len(w := cache.folded(r["text"]))]
        if held:
            out = out.unionByName(docs.mapInPandas(_tile(Seeds(held, seed), seed, threshold), SCHEMA))
    return out.withColumns({"doc_id": public_id("doc_id"), "item_id": public_id("item_id")})


def query(spark, sf_dir) -> DataFrame:
    from sluice.llm.common import table
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_words", "covered", "coverage", F.size("tiles").alias("n_tiles"))
