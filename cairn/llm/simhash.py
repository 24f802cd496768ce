"""SimHash near-duplicates by a distributed vantage-point tree.

Every text gets a 64-bit fingerprint. Equal fingerprints are one point. A tree of
vantage points, grown on a bounded sample, cuts the points by Hamming distance into
shards; every point is at home in one of them. A point also visits the shards beyond a
cut that the triangle inequality does not rule out: of two points that are linked
across a cut, the one on the far side visits the near one. Each shard goes on with the
same tree in memory and returns its links as a forest, a link or so a point, never all
pairs. Components over the forests' links follow.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize
from .components import components

#: Points at home in a shard, about; sampled points a shard that the tree is grown on; the most points sampled, in expectation.
SHARD, PER_SHARD, MOST_SAMPLED = 8192, 64, 1 << 22
#: Below so many points a shard compares all; so many hashes are counted at once.
LEAF, BLOCK = 256, 1 << 16


def hashes(text: str | None, words: int) -> np.ndarray:
    """The hashes of a text's shingles of `words` words, A-Z lower-cased, repeats included.

    Words are runs of anything but ASCII white space; a shorter text is one shingle,
    a text without words has none.
    """
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(w) < words:
        shingles = [b" ".join(w)] if w else []
    else:
        shingles = map(b" ".join, zip(*(w[i:] for i in range(words)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, 42) for s in shingles), np.uint64)


def fingerprint(text: str | None, words: int = 3) -> int:
    """The signed 64-bit SimHash of a text over its shingles, see `hashes`; a text without words has fingerprint zero."""
    return folded(hashes(text, words))


def folded(h: np.ndarray) -> int:
    """The signed 64-bit SimHash of hashes; zero of none."""
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), BLOCK):
        ones += np.unpackbits(h[i : i + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h)).view(">i8")[0])


def fingerprints(text: Column, words: int = 3) -> Column:
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return simhash(text)


def distance(x: np.ndarray, y) -> np.ndarray:
    return np.bitwise_count(x ^ y).astype(np.int16)


@dataclass
class Tree:
    """Inner nodes: vantage point, cut (near: distance <= cut), near and far child. A child below zero is shard ~child."""

    vantage: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    near: list[int] = field(default_factory=list)
    far: list[int] = field(default_factory=list)
    shards: int = 0


def best_cut(points: np.ndarray, radius: int, rng: np.random.Generator) -> tuple[np.uint64, int] | None:
    """Of a few vantage points, that whose median cut leaves the fewest points within `radius` of it; None if no cut divides the points."""
    best = None
    for v in rng.choice(points, min(6, len(points)), replace=False):
        d = distance(points, v)
        cut = min(int(np.median(d)), int(d.max()) - 1)
        if cut < 0:
            continue
        share = np.mean((d > cut - radius) & (d <= cut + radius)) + abs(np.mean(d <= cut) - 0.5)
        if best is None or share < best[0]:
            best = share, v, cut
    return None if best is None else best[1:]


def grow(sample: np.ndarray, leaf: int, radius: int, seed: int = 7) -> Tree:
    """A tree whose shards hold at most `leaf` points of the sample each, unless these are all equal."""
    tree, rng = Tree(), np.random.default_rng(seed)

    def child(points: np.ndarray) -> int:
        split = best_cut(points, radius, rng) if len(points) > leaf else None
        if split is None:
            tree.shards += 1
            return -tree.shards
        at = len(tree.vantage)
        tree.vantage.append(int(split[0])), tree.cut.append(split[1])
        tree.near.append(0), tree.far.append(0)
        d = distance(points, split[0])
        tree.near[at] = child(points[d <= split[1]])
        tree.far[at] = child(points[d > split[1]])
        return at

    if child(sample) < 0:
        tree.vantage = []
    return tree


def step(d: np.ndarray, cut: int, home: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which points go near, which go far, and which of the near ones are at home there."""
    near = np.where(home, d <= cut + radius, d - radius <= cut)
    far = np.where(home, d > cut, d + radius > cut)
    return near, far, home & (d <= cut)


def route(tree: Tree, points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, places in `points`, whether at home) for every shard that points reach."""
    todo = [(0 if tree.vantage else -1, np.arange(len(points)), np.ones(len(points), bool))]
    while todo:
        node, places, home = todo.pop()
        if not len(places):
            continue
        if node < 0:
            yield ~node, places, home
            continue
        d = distance(points[places], np.uint64(tree.vantage[node]))
        near, far, stays = step(d, tree.cut[node], home, radius)
        todo += [(tree.near[node], places[near], stays[near]), (tree.far[node], places[far], home[far])]


class Forest:
    """Union-find over places; the least place is the root."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, places: np.ndarray) -> np.ndarray:
        r = self.up[places]
        while True:
            above = self.up[r]
            if np.array_equal(above, r):
                self.up[places] = r
                return r
            r = above

    def join(self, places: np.ndarray) -> None:
        r = self.roots(places)
        self.up[r] = r.min()


def compared(points: np.ndarray, home: np.ndarray, radius: int, seed: int = 7) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places at home, places, whether within `radius`, a row for each of the first): together all pairs of a shard that are linked through a point at home."""
    rng = np.random.default_rng(seed)
    todo = [(np.arange(len(points)), home)]
    while todo:
        places, at_home = todo.pop()
        mine = places[at_home]
        if not len(mine) or len(places) < 2:
            continue
        split = best_cut(points[mine], radius, rng) if len(mine) > LEAF else None
        if split is not None:
            d = distance(points[places], split[0])
            near, far, stays = step(d, split[1], at_home, radius)
            if near.sum() + far.sum() < 1.7 * len(places):
                todo += [(places[near], stays[near]), (places[far], at_home[far])]
                continue
        theirs = points[places]
        for i in range(0, len(mine), 64):
            some = mine[i : i + 64]
            yield some, places, distance(points[some][:, None], theirs[None, :]) <= radius


def link_shard(points: np.ndarray, home: np.ndarray, radius: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Links (root, member) that connect what is linked within `radius` through a point at home in the shard."""
    forest = Forest(len(points))
    for _, places, linked in compared(points, home, radius, seed):
        for k in np.flatnonzero(linked.sum(axis=1) > 1):
            forest.join(places[linked[k]])
    roots = forest.roots(np.arange(len(points)))
    members = np.flatnonzero(roots != np.arange(len(points)))
    return points[roots[members]], points[members]


def grown(points: DataFrame, name: str, radius: int) -> tuple[Tree, np.ndarray, float]:
    """A tree over the points, with the sample it is grown on and how many points each of the sample stands for."""
    n = points.count()
    shards = max(1, -(-n // SHARD))
    share = min(1.0, 1.2 * min(shards * PER_SHARD, MOST_SAMPLED) / max(1, n))
    sampled = points.sample(fraction=share, seed=11).toPandas()[name].to_numpy(np.int64).view(np.uint64)
    return grow(np.sort(sampled), max(8, len(sampled) // shards), radius), sampled, n / max(1, len(sampled))


def links(points: DataFrame, name: str, radius: int) -> DataFrame:
    """(a, b): links that connect exactly the points, distinct longs, which chains of at most `radius` differing bits connect."""
    shared = points.sparkSession.sparkContext.broadcast(grown(points, name, radius)[0])

    def send(batches):
        for pdf in batches:
            p = pdf[name].to_numpy(np.int64)
            for shard, places, home in route(shared.value, p.view(np.uint64), radius):
                yield pd.DataFrame({"shard": np.full(len(places), shard, np.int32), "point": p[places], "home": home})

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf["point"].to_numpy(np.int64)
        order = np.argsort(p)
        a, b = link_shard(p[order].view(np.uint64), pdf["home"].to_numpy(bool)[order], radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    sent = points.mapInPandas(send, "shard int, point long, home boolean")
    return sent.groupBy("shard").applyInPandas(search, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str, text: str, words: int = 3, radius: int = 2) -> DataFrame:
    """(id_col, fingerprint long, component_id): each row's fingerprint and the least id that links reach from it.

    Two rows are linked if their fingerprints differ in `radius` bits or fewer. Null
    and empty texts have fingerprint zero and link like any other. Rows repeat
    independently; null ids belong to components as others do, and a component of null
    ids alone has a null id. An empty table gives an empty result; extra columns of any
    name are left out.
    """
    marked = materialize(df.select(F.col(id_col), fingerprints(F.col(text), words).alias("fingerprint")))
    classes = materialize(marked.groupBy("fingerprint").agg(F.min(id_col).alias("least")))
    found = components(links(classes.select(F.col("fingerprint").alias("point")), "point", radius), "a", "b")
    named = classes.join(found, F.col("fingerprint") == F.col("node"), "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select(F.col("fingerprint").alias("point"), "component_id")
    return marked.join(named, F.col("fingerprint") == F.col("point")).select(id_col, "fingerprint", "component_id")


def keep_one(df: DataFrame, id_col: str, text: str, words: int = 3, radius: int = 2) -> DataFrame:
    """The rows of `df` without near-duplicates: of each component the row of the least id stays.

    Of several rows with that id, one stays. If all ids of a component are null, one of
    its rows stays for each distinct fingerprint.
    """
    return kept(df, id_col, near_duplicates(df, id_col, text, words, radius), fingerprints(F.col(text), words))


def kept(df: DataFrame, id_col: str, found: DataFrame, mark_of: Column) -> DataFrame:
    """The rows of `df` whose id is the component_id of their component in `found` (id_col, component_id), one an id; of null ids one a value of `mark_of`."""
    key, n, mark = free_name(df, "kept_id"), free_name(df, "kept_rows"), free_name(df, "kept_mark")
    stay = found.where(F.col(id_col).eqNullSafe(F.col("component_id"))).groupBy(F.col(id_col).alias(key)).agg(F.count("*").alias(n))
    kept = df.join(stay, F.col(id_col).eqNullSafe(F.col(key)))
    alone = kept.where(F.col(n) == 1).select(*df.columns)
    # Rows that share an id are rare: only they are compared by text, one a mark, then one an id.
    again = kept.where(F.col(n) > 1).withColumn(mark, F.when(F.col(id_col).isNull(), mark_of))
    return alone.unionByName(again.dropDuplicates([id_col, mark]).select(*df.columns))
