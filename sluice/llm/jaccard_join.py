"""Operator 7, n-gram Jaccard join by MinHash banding, with all links verified on full n-gram sets.

Method. A document is its set of hashed five-word shingles (all its words, if fewer). Documents with equal
sets are one class. Each class has MinHash bands, whose row and band counts follow from the target recall at
the threshold; a shuffle on the band hashes links every class of a band to the least one in it, and the
components of these links are the candidate sets. In a candidate set, pairs are verified on full sets:

1. Every member is compared with one pivot, the least member. Jaccard distance is a metric, so pairs whose
   distances to the pivot sum to at most the limit are links, and pairs whose distances differ by more are
   none. These are counted from sums per distance level: a hot group of near copies costs its size, not
   its square.
2. The remaining pairs are compared in blocks of at most about ``block`` members a side.

Verified links, again by components, give the groups. The number of a document's links counts all other
documents with a similarity of at least the threshold, copies included; no pairs are written out.

Skew. Copies meet in a map-side aggregate; band hashes are aggregated before the join; joins on hot keys are
plain equi-joins that adaptive execution splits. No pair is dropped. Pairs that share no band and no
candidate set are the ones that recall refers to.

Defined results. Null or white-space text: no shingles, a class and group of its own, no links. Null doc_id:
the smallest id. Repeated rows are copies of each other. An empty table gives no rows, columns beside ``doc_id``
and ``text`` are ignored. Texts of any length give their whole set. Sets and classes are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import U64, Stored, WordHash, chunks, gram_hashes, mix, public_id, texts
from sluice.llm.components import components
from sluice.llm.substring_dedup import words_of

N = 5
THRESHOLD = (4, 5)
RECALL = 0.999
MAX_HASHES = 320
BLOCK = 256
#: Distances to a pivot are kept as whole steps of this size, rounded up and down.
LEVELS = 200
CHUNK_BYTES = 3 << 20


def band_plan(threshold: float, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band, so the fewest chance candidates, that reach the recall in ``max_hashes``."""
    best = None
    for rows in range(1, max_hashes + 1):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-threshold ** rows)))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("too few hashes for this recall")
    return best


def shingle_set(words: np.ndarray, n: int = N) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; of all words if there are fewer."""
    if not len(words):
        return np.zeros(0, U64)
    return np.unique(gram_hashes(words, min(n, len(words))) + U64(min(n, len(words))))


def _sets(rows, cache: WordHash, n: int) -> list[np.ndarray]:
    cache.trim()
    return [shingle_set(cache.array(words_of(r[-1])), n) for r in rows]


def _multipliers(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)


def _sign(n: int, bands: int, rows: int):
    factors = _multipliers(bands * rows)
    weights = _multipliers(bands * rows + rows)[-rows:]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHash()
        for part in chunks(frames, CHUNK_BYTES):
            sets = _sets(part, cache, n)
            sizes = np.array([len(s) for s in sets])
            some = np.flatnonzero(sizes)
            key, check = np.zeros(len(part), U64), np.zeros(len(part), U64)
            out = np.zeros((len(part), bands), U64)
            if len(some):
                joined = np.concatenate([sets[i] for i in some])
                head = np.cumsum(sizes[some]) - sizes[some]
                key[some] = mix(np.add.reduceat(mix(joined), head))
                check[some] = mix(np.add.reduceat(mix(joined ^ factors[0]), head))
                for b in range(bands):
                    total = np.full(len(some), U64(b + 1))
                    for r in range(rows):
                        total = total * factors[1] + np.minimum.reduceat(joined * factors[b * rows + r], head) * weights[r]
                    out[some, b] = mix(total)
            yield pd.DataFrame({"did": [r[0] for r in part], "tv": [r[1] for r in part], "cid": key.view(np.int64), "chk": check.view(np.int64),
                                "n": sizes.astype(np.int32), "bands": list(out.view(np.int64))})
    return run


def _set_rows(n: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHash()
        for part in chunks(frames, CHUNK_BYTES):
            sets = _sets(part, cache, n)
            yield pd.DataFrame({"comp": [r[0] for r in part], "cid": [r[1] for r in part], "copies": [r[2] for r in part],
                                "grams": [s.tobytes() for s in sets]})
    return run


def _to_pivot(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        up, down = [], []
        for a, p in zip(f["grams"], f["pivot"]):
            a, p = np.frombuffer(a, U64), np.frombuffer(p, U64)
            shared = len(np.intersect1d(a, p, assume_unique=True))
            union = len(a) + len(p) - shared
            up.append(-(-LEVELS * (union - shared) // union))
            down.append(LEVELS * (union - shared) // union)
        yield pd.DataFrame({"comp": f["comp"], "cid": f["cid"], "copies": f["copies"], "up": up, "down": down})


def _block(frame: pd.DataFrame) -> pd.DataFrame:
    """Members of one block as a single row."""
    return pd.DataFrame({"comp": [frame["comp"].iloc[0]], "up": [frame["up"].iloc[0]], "down": [frame["down"].iloc[0]], "part": [frame["part"].iloc[0]],
                         "cids": [frame["cid"].to_numpy(np.int64).tobytes()], "copies": [frame["copies"].to_numpy(np.int64).tobytes()],
                         "sizes": [np.array([len(g) // 8 for g in frame["grams"]], np.int64).tobytes()], "grams": [b"".join(frame["grams"])]})


def overlaps(a_sets: tuple[np.ndarray, np.ndarray], b_sets: tuple[np.ndarray, np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of two lists of sets, each given as (sizes, values one after the other)."""
    a_of, b_of = np.repeat(np.arange(len(a_sets[0])), a_sets[0]), np.repeat(np.arange(len(b_sets[0])), b_sets[0])
    common, ai, bi = np.unique(a_sets[1]), None, None
    common = common[np.isin(common, b_sets[1])]
    ai, bi = np.searchsorted(common, a_sets[1]), np.searchsorted(common, b_sets[1])
    out = np.zeros((len(a_sets[0]), len(b_sets[0])))
    if not len(common):
        return out.astype(np.int64)
    a_ok = common[np.minimum(ai, len(common) - 1)] == a_sets[1]
    b_ok = common[np.minimum(bi, len(common) - 1)] == b_sets[1]
    a_of, ai, b_of, bi = a_of[a_ok], ai[a_ok], b_of[b_ok], bi[b_ok]
    for lo in range(0, len(common), columns):
        left, right = np.zeros((out.shape[0], columns), np.float32), np.zeros((out.shape[1], columns), np.float32)
        x, y = (ai >= lo) & (ai < lo + columns), (bi >= lo) & (bi < lo + columns)
        left[a_of[x], ai[x] - lo] = 1
        right[b_of[y], bi[y] - lo] = 1
        out += left @ right.T
    return out.astype(np.int64)


def _verify(num: int, den: int):
    """Two blocks -> (cid, other, weight): weight of verified links per member; ``other`` a link that keeps it connected."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                same = (r.up, r.down, r.part) == (r.up2, r.down2, r.part2)
                a = [np.frombuffer(x, np.int64) for x in (r.cids, r.copies, r.sizes)]
                b = [np.frombuffer(x, np.int64) for x in (r.cids2, r.copies2, r.sizes2)]
                shared = overlaps((a[2], np.frombuffer(r.grams, U64)), (b[2], np.frombuffer(r.grams2, U64)))
                union = a[2][:, None] + b[2][None, :] - shared
                link = den * shared >= num * union
                if same:
                    np.fill_diagonal(link, False)
                made = _spanning(link, a[0], b[0])
                left = link @ b[1]
                rows = [(a[0][left > 0], left[left > 0])]
                if not same:
                    right = link.T @ a[1]
                    rows.append((b[0][right > 0], right[right > 0]))
                out = pd.DataFrame({"cid": np.concatenate([x for x, _ in rows]), "weight": np.concatenate([w for _, w in rows])})
                out["other"] = None
                edges = pd.DataFrame(made, columns=["cid", "other"])
                edges["weight"] = 0
                both = pd.concat([out, edges], ignore_index=True)
                if len(both):
                    yield both[["cid", "other", "weight"]].astype({"cid": "int64", "other": "Int64", "weight": "int64"})
    return run


def _spanning(link: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what ``link`` connects: each member with its first partner, and partners in common."""
    edges = set()
    if link.any():
        first_b = np.where(link.any(1), link.argmax(1), -1)
        first_a = np.where(link.any(0), link.argmax(0), -1)
        edges.update((int(a[i]), int(b[j])) for i, j in enumerate(first_b) if j >= 0)
        edges.update((int(a[i]), int(b[j])) for j, i in enumerate(first_a) if i >= 0)
        # members may be connected by later partners only: merge until every link is inside a component
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x
        for x, y in edges:
            root[find(x)] = find(y)
        while True:
            ra, rb = np.array([find(int(x)) for x in a]), np.array([find(int(x)) for x in b])
            i, j = np.nonzero(link & (ra[:, None] != rb[None, :]))
            if not len(i):
                break
            edges.add((int(a[i[0]]), int(b[j[0]])))
            root[find(int(a[i[0]]))] = find(int(b[j[0]]))
    return list(edges)


def similar_classes(docs: DataFrame, n: int = N, threshold: tuple[int, int] = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES,
                    block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(signatures of all documents, results per class): (did, tv, cid, n) and (cid, cdid, copies, links, gdid, gtv)."""
    num, den = threshold
    bands, rows = band_plan(num / den, recall, max_hashes)
    signed = Stored(docs.mapInPandas(_sign(n, bands, rows), "did long, tv long, cid long, chk long, n int, bands array<long>"), "signatures").df
    classes = Stored(signed.where("n > 0").groupBy("cid", "chk", "n").agg(
        F.min(F.struct("did", "tv")).alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"))
        .select("cid", "rep.did", "rep.tv", "copies", "bands"), "classes").df
    banded = classes.select("cid", F.explode("bands").alias("h"))
    buckets = banded.groupBy("h").agg(F.min("cid").alias("least"), F.count(F.lit(1)).alias("c")).where("c > 1")
    stars = banded.join(buckets, "h").where("cid <> least").select(F.col("cid").alias("a"), F.col("least").alias("b"))
    candidates = Stored(components(stars, "candidates").select(F.col("node").alias("cid"), F.col("label").alias("comp")), "candidate-sets").df
    wanted = classes.select("cid", "did", "tv", "copies").join(candidates, "cid").dropDuplicates(["cid"])
    held = [Stored(wanted.join(docs, ["did", "tv"]).dropDuplicates(["did", "tv"]).select("comp", "cid", "copies", "text")
                  .mapInPandas(_set_rows(n), "comp long, cid long, copies long, grams binary"), "candidate-shingles")]
    sets = held[0].df
    pivots = sets.where("cid = comp").select("comp", F.col("grams").alias("pivot"))
    held.append(Stored(sets.join(pivots, "comp").select("comp", "cid", "copies", "grams", "pivot")
                  .mapInPandas(_to_pivot, "comp long, cid long, copies long, up int, down int"), "pivot-distances"))
    dist = held[-1].df
    limit = LEVELS * (den - num) // den
    level = dist.groupBy("comp", "up", "down").agg(F.count(F.lit(1)).alias("members"), F.sum("copies").alias("weight"))
    held.append(Stored(level, "distance-levels"))
    level = held[-1].df
    other = level.select("comp", *[F.col(c).alias(f"{c}2") for c in ("up", "down", "members", "weight")])
    pairs = level.join(other, "comp").where((F.col("down") - F.col("up2") <= limit) & (F.col("down2") - F.col("up") <= limit))
    sure = F.col("up") + F.col("up2") <= limit
    certain = pairs.where(sure).groupBy("comp", "up", "down").agg(F.sum("weight2").alias("sum"))
    own = F.when(F.col("up") * 2 <= limit, F.col("copies")).otherwise(F.lit(0))
    by_pivot = dist.join(certain, ["comp", "up", "down"]).select("cid", F.lit(None).cast("bigint").alias("other"), (F.col("sum") - own).alias("weight"))
    near_pivot = dist.where((F.col("up") <= limit) & (F.col("cid") != F.col("comp"))).select("cid", F.col("comp").alias("other"), F.lit(0).cast("bigint").alias("weight"))
    # pairs that the pivot leaves open, once each; a level with one member has no pair of its own
    open_pairs = pairs.where(~sure & (F.struct("up", "down") <= F.struct("up2", "down2"))
                             & ((F.col("up") != F.col("up2")) | (F.col("down") != F.col("down2")) | (F.col("members") > 1)))
    parts = lambda c: F.ceil(F.col(c) / F.lit(float(block))).cast("int")
    held.append(Stored(open_pairs.select("comp", "up", "down", "members", "up2", "down2", "members2"), "open-levels"))
    todo = held[-1].df
    block_pairs = (todo.withColumn("part", F.explode(F.sequence(F.lit(0), parts("members") - 1)))
                   .withColumn("part2", F.explode(F.sequence(F.lit(0), parts("members2") - 1)))
                   .where((F.col("up") != F.col("up2")) | (F.col("down") != F.col("down2")) | (F.col("part") <= F.col("part2")))
                   .drop("members", "members2"))
    needed = (todo.select("comp", "up", "down", "members").unionByName(
        todo.select("comp", F.col("up2").alias("up"), F.col("down2").alias("down"), F.col("members2").alias("members"))).distinct())
    members = (dist.join(needed, ["comp", "up", "down"]).withColumn("part", F.pmod(F.xxhash64("cid"), parts("members")).cast("int"))
               .join(sets.select("cid", "grams"), "cid").select("comp", "up", "down", "part", "cid", "copies", "grams"))
    held.append(Stored(members.groupBy("comp", "up", "down", "part").applyInPandas(
        _block, "comp long, up int, down int, part int, cids binary, copies binary, sizes binary, grams binary"), "member-blocks"))
    blocks = held[-1].df
    key = ["comp", "up", "down", "part"]
    second = blocks.select(*[F.col(c) if c == "comp" else F.col(c).alias(f"{c}2") for c in blocks.columns])
    verified = (block_pairs.join(blocks, key).join(second, ["comp", "up2", "down2", "part2"])
                .mapInPandas(_verify(num, den), "cid long, other long, weight long"))
    found = Stored(by_pivot.unionByName(near_pivot).unionByName(verified), "links").df
    for used in held:
        used.drop()
    groups = components(found.where("other IS NOT NULL").select(F.col("cid").alias("a"), F.col("other").alias("b")), "groups")
    links = found.groupBy("cid").agg(F.sum("weight").alias("w"))
    result = classes.select("cid", F.col("did").alias("cdid"), F.col("tv").alias("ctv"), "copies").join(links, "cid", "left").join(
        groups.select(F.col("node").alias("cid"), F.col("label").alias("grp")), "cid", "left")
    result = result.select("cid", "cdid", "ctv", "copies", (F.coalesce("w", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("grp", "cid").alias("grp"))
    result = Stored(result, "class-links").df
    least = result.groupBy("grp").agg(F.min(F.struct("cdid", "ctv")).alias("g"))
    return signed.select("did", "tv", "cid", "n"), result.join(least, "grp").select(
        "cid", "cdid", "copies", "links", F.col("g.cdid").alias("gdid"), F.col("g.ctv").alias("gtv"))


def join_similar(documents: DataFrame, **settings) -> DataFrame:
    """(did, tv, class_id, n_links, group_id, group_tv) per document: least ids of the documents with the same set, and of
    those connected by links; the number of other documents with a similarity of at least the threshold."""
    signed, classes = similar_classes(texts(documents), **settings)
    joined = signed.withColumn("key", F.when(F.col("n") > 0, F.col("cid"))).drop("cid").join(
        classes.withColumnRenamed("cid", "key"), "key", "left")
    return joined.select("did", "tv", F.coalesce("cdid", "did").alias("class_id"), F.coalesce("links", F.lit(0)).alias("n_links"),
                         F.coalesce("gdid", "did").alias("group_id"), F.coalesce("gtv", "tv").alias("group_tv"))


def query(spark, sf_dir) -> DataFrame:
    from sluice.llm.common import table
    out = join_similar(table(spark, sf_dir, "documents"))
    return out.select(public_id("did").alias("doc_id"), public_id("class_id").alias("class_id"), "n_links", public_id("group_id").alias("group_id"))
