"""The prefix tree of conversations, as a Patricia tree.

Conversations are sequences of turns, told apart by 128-bit digests. They are cut into segments
of at most SEGMENT turns; those of one level that share all turns before them form a tree of
their own under the node where these turns end, so no sort key grows with a conversation. The
segments are sorted over the whole cluster. Between neighbours the common prefix tells where
paths part: each task walks its run of the order with a stack and creates points only where
paths branch, end or stop, and along the one path that it shares with the run before or
after, whose points the runs then unite. A node's members lie side by side in the
order, so whatever is summed over them or over the nodes below is a difference of two prefix sums.
The nodes between two points have the lower one's members and come last, from the sums along the edge.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .common import join_hot, materialize, ranks

#: Turns of a segment; bytes of a turn's digest; hexadecimal digits of a node's key.
SEGMENT, WIDE, KEY = 256, 16, 32
#: Bytes of the pieces in which the ids of a node that spans tasks are handed on.
PIECE = 1 << 16
#: Turns whose numbers fall in one window are numbered together.
WINDOW = 64


def positions(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, pos, digest, n_bytes) of rows with a conversation: 0-based places by turn (null first), then digest; null role and text as empty."""
    said, who = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said).cast("binary"), 256), 1, 2 * WIDE))
    rows = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), digest.alias("digest"), F.octet_length(said).cast("long").alias("n_bytes")
    )
    rows = materialize(rows.withColumn("span", F.floor(F.col("turn") / WINDOW)))
    return ranks(rows, ["conv_id"], ["span"], [F.col("turn"), F.col("digest")], "pos").select("conv_id", "pos", "digest", "n_bytes")


def _kept(conv: Column) -> Column:
    """How many turns a conversation takes from the first of its family of five."""
    return F.crc32(conv.cast("string").cast("binary")) % 9


def rebuilt(turns: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """From (conv_id, pos, digest, n_bytes) the same of the rebuilt conversations, and (conv_id, length) of every one, turnless ones too.

    Conversation c starts with the first h turns of c - c % 5 (sign as in SQL), h = crc32(c) % 9, and goes on with its own after its first h.
    """
    family = F.col("conv_id") - F.col("conv_id") % 5
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    sizes = sizes.select("conv_id", "own", _kept(F.col("conv_id")).alias("h"), family.alias("base"))
    first = sizes.where("conv_id = base").select(F.col("conv_id").alias("b"), F.col("own").alias("b_own"))
    sizes = sizes.join(first, F.col("base") == F.col("b"), "left")
    taken = F.when(F.col("conv_id") == F.col("base"), F.least("h", "own")).otherwise(F.least("h", F.coalesce("b_own", F.lit(0))))
    sizes = materialize(sizes.select("conv_id", "own", "h", "base", taken.alias("taken")))
    lengths = sizes.select("conv_id", (F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("length"))

    side = sizes.select(F.col("conv_id").alias("c"), "own", "h", "taken")
    own = join_hot(turns, side, [("conv_id", "c")], "own", total).where("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "n_bytes")
    heads = turns.where("pos < 8").withColumnRenamed("conv_id", "b")  # of each family's first, 8 rows at most
    given = heads.join(sizes, F.col("b") == F.col("base")).where("pos < taken").select("conv_id", "pos", "digest", "n_bytes")
    return own.unionByName(given), lengths


def _key(level: Column, start: Column, digests: Column) -> Column:
    return F.substring(F.sha2(F.concat(F.concat_ws(":", level.cast("string"), start, F.lit("")).cast("binary"), digests), 256), 1, KEY)


def _plain_key(level: int, start: str, digests: bytes) -> str:
    return hashlib.sha256(f"{level}:{start}:".encode() + digests).hexdigest()[:KEY]


def segments(turns: DataFrame, lengths: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, level, start, next, digests, sizes, final): a row for each `segment` turns of a conversation, one for a turnless one.

    `start` names the turns before the segment, `next` those up to its end: sums of hashes of
    segments with their places, so that a conversation of any length adds up from its segments.
    """
    level = F.floor(F.col("pos") / segment).cast("int").alias("level")
    bits = F.sort_array(F.collect_list(F.struct("pos", "digest", "n_bytes")))  # `segment` at most
    cut = turns.groupBy("conv_id", level).agg(bits.alias("bits"), F.max("pos").alias("last"))
    joined = F.aggregate("bits", F.unhex(F.lit("")), lambda a, x: F.concat(a, x["digest"]))
    cut = cut.select("conv_id", "level", joined.alias("digests"), F.col("bits.n_bytes").alias("sizes"), "last")
    none = F.lit(None).cast("long")
    empty = lengths.where("length = 0").select("conv_id", F.lit(0).alias("level"), F.unhex(F.lit("")).alias("digests"), F.array().cast("array<long>").alias("sizes"), none.alias("last"))
    cut = cut.unionByName(empty)
    before = W.Window.partitionBy("conv_id").orderBy("level").rowsBetween(W.Window.unboundedPreceding, -1)
    up_to = before.rowsBetween(W.Window.unboundedPreceding, W.Window.currentRow)
    terms = [F.xxhash64(F.lit(seed), "level", "digests").cast("decimal(38,0)") for seed in (1, 2)]
    named = lambda w: F.concat_ws("_", *[F.coalesce(F.sum(t).over(w), F.lit(0)).cast("string") for t in terms])
    every = W.Window.partitionBy("conv_id")
    return cut.select("conv_id", "level", named(before).alias("start"), named(up_to).alias("next"), "digests", "sizes", (F.col("level") == F.max("level").over(every)).alias("final"))


def _common(a: bytes, b: bytes) -> int:
    """Digests that two paths share from their start."""
    if a == b:
        return len(a) // WIDE
    low, high = 0, min(len(a), len(b)) // WIDE
    while low < high:  # a prefix of the path is shared, or it isn't
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[: mid * WIDE] == b[: mid * WIDE] else (low, mid - 1)
    return low


POINT = "key string, parent string, depth long, lo long, hi long, conv_id long, edge array<long>, spans boolean"


class _Walk:
    """The open points of the path that a task stands on, each [depth, first place, least conversation, whether it may span tasks]."""

    def __init__(self, segment: int, level: int, start: str, after: str):
        self.segment, self.level, self.start, self.after = segment, level, start, after
        self.digests, self.sizes, self.open = b"", [], []
        self.out: list[tuple] = []

    def key(self, depth: int) -> str:
        if depth == self.segment:
            return _plain_key(self.level + 1, self.after, b"")
        return _plain_key(self.level, self.start, self.digests[: depth * WIDE])

    def close(self, depth: int, place: int, spans: bool = False) -> None:
        """Close what lies deeper than `depth`, which becomes a point; `place` is that of the last member."""
        while self.open[-1][0] > depth:
            own, lo, conv, wide = self.open.pop()
            if self.open[-1][0] < depth:
                self.open.append([depth, lo, conv, spans])
            up = self.open[-1]
            up[2], up[3] = min(up[2], conv), up[3] or spans
            sums, edge = 0, []
            for size in reversed(self.sizes[up[0] : own]):
                sums += size
                edge.append(sums)
            base = self.level * self.segment
            self.out.append((self.key(own), self.key(up[0]), base + own, lo, place, conv, edge[::-1], wide))

    def end(self, place: int) -> None:
        """Close all; the top one is a point only on the first level, elsewhere that of the level above."""
        self.close(0, place)
        _, lo, conv, wide = self.open.pop()
        if self.level == 0:
            self.out.append((self.key(0), None, 0, lo, place, conv, [], wide))


def points(order: DataFrame, shared: dict[int, tuple[int, int, int]], segment: int = SEGMENT) -> DataFrame:
    """The points of each task's run of the sorted segments (rows in order within their partition `part`).

    shared: for a run its first place, and how many turns its first and its last path share with the neighbours (-1: not even the
    tree). `edge` holds, for each node from below the parent down to the point, the bytes of the last texts from it on.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: _Walk | None = None
        place = left = right = 0

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [f.split()[0] for f in POINT.split(", ")])

        for b in batches:
            fields = [b.column(n).to_pylist() for n in ("part", "level", "start", "next", "digests", "sizes", "conv_id")]
            for part, level, start, after, digests, sizes, conv in zip(*fields, strict=True):
                if at is None:
                    place, left, right = shared[part]
                    at = _Walk(segment, level, start, after)
                    at.open = [[d, place, conv, True] for d in range(max(left, 0) + 1)]
                    at.open[0][3] = left >= 0
                elif (at.level, at.start) != (level, start):
                    at.end(place - 1)
                    done, at = at.out, _Walk(segment, level, start, after)
                    at.out, at.open = done, [[0, place, conv, False]]
                else:
                    at.close(_common(at.digests, digests), place - 1)
                at.digests, at.sizes, at.after = digests, sizes, after
                depth = len(digests) // WIDE
                if at.open[-1][0] < depth:
                    at.open.append([depth, place, conv, False])
                at.open[-1][2] = min(at.open[-1][2], conv)
                place += 1
                if len(at.out) >= 1000:
                    yield batch(at.out)
                    at.out = []
        if at is not None:
            for depth in range(right, -1, -1):
                at.close(depth, place - 1, spans=True)
                at.open[-1][3] = True
            at.end(place - 1)
            yield batch(at.out)

    return order.mapInArrow(walk, POINT)


def end_digests(ends: DataFrame) -> DataFrame:
    """From rows (key, conv_id) to (key, ends_sha256): the digest of the ids of each key, ascending, comma-joined.

    The ids are sorted over the cluster. A key that lies within one task is digested there; of one that may
    span tasks the joined ids are handed on in pieces, and one task reads them in order: SHA-256 can't be split, but
    it keeps no more than a batch.
    """
    order = ["key", "conv_id"]
    dealt = ends.repartitionByRange(*order).sortWithinPartitions(*order)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        key, ids, first, seq, out = None, [], True, 0, []

        def piece(last: bool) -> None:
            nonlocal seq, ids
            text = ",".join(map(str, ids))
            if first or last or seq:  # begun elsewhere, perhaps to go on elsewhere, or long
                out.append((key, part, seq, text, None))
            else:
                out.append((key, part, 0, None, hashlib.sha256(text.encode()).hexdigest()))
            seq, ids = seq + 1, []

        def batch() -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["key", "part", "seq", "text", "digest"])

        for b in batches:
            for k, conv in zip(b.column("key").to_pylist(), b.column("conv_id").to_pylist(), strict=True):
                if k != key:
                    if key is not None:
                        piece(False)
                        first = False
                    key, seq = k, 0
                elif len(ids) * 8 >= PIECE:
                    piece(True)
                ids.append(conv)
            if len(out) >= 1000:
                yield batch()
                out = []
        if key is not None:
            piece(True)
            yield batch()

    told = materialize(dealt.mapInArrow(local, "key string, part long, seq long, text string, digest string"))
    place = ["key", "part", "seq"]
    wide = told.where("text IS NOT NULL").select(*place, "text").repartition("key").sortWithinPartitions(*place)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for b in batches:
            done = []
            for k, text in zip(b.column("key").to_pylist(), b.column("text").to_pylist(), strict=True):
                if k == key:
                    state.update(b",")
                else:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                state.update(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done, strict=True)], ["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_pydict({"key": [key], "ends_sha256": [state.hexdigest()]})

    united = wide.mapInArrow(joined, "key string, ends_sha256 string")
    return materialize(told.where("digest IS NOT NULL").select("key", F.col("digest").alias("ends_sha256")).unionByName(united))


def _sorted(cut: DataFrame) -> tuple[DataFrame, dict[int, tuple[int, int, int]]]:
    """The segments sorted over all partitions, with their partition, and for each partition its first place and what it shares with its neighbours.

    Equal paths are in the order of their conversations, so that a hot one spreads over
    partitions. What the driver gets are three numbers a partition.
    """
    path = ["level", "start", "digests"]
    order = materialize(cut.repartitionByRange(*path, "conv_id").sortWithinPartitions(*path, "conv_id").withColumn("part", F.spark_partition_id()))
    key = F.struct(*path)
    rims = order.groupBy("part").agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count("*").alias("rows"))

    @F.arrow_udf("int")
    def shared(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([-1 if x is None or (x["level"], x["start"]) != (y["level"], y["start"]) else _common(x["digests"], y["digests"]) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.int32())

    before = F.lag("last").over(W.Window.orderBy("part"))  # a row a partition
    rows = rims.select("part", "rows", "first", before.alias("before")).select("part", "rows", shared("before", "first").alias("left")).orderBy("part").collect()
    out, place = {}, 0
    for i, r in enumerate(rows):
        out[r["part"]] = (place, r["left"], rows[i + 1]["left"] if i + 1 < len(rows) else -1)
        place += r["rows"]
    return order, out


def prefix_trie(turns: DataFrame, lengths: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The nodes of the prefix tree of conversations given as turns (conv_id, pos, digest, n_bytes) and all lengths.

    Per node: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    An empty table gives an empty result.
    """
    cut = segments(turns, lengths, segment)
    order, shared = _sorted(cut)
    found = materialize(points(order, shared, segment))
    least = [F.min(c).alias(c) for c in ("parent", "depth", "lo", "conv_id")]
    wide = found.where("spans").groupBy("key").agg(*least, F.max("hi").alias("hi"), F.any_value("edge").alias("edge"))
    tree = found.where("NOT spans").drop("spans").unionByName(wide).withColumn("n", F.col("hi") - F.col("lo") + 1)
    children = tree.where("parent IS NOT NULL").groupBy(F.col("parent").alias("up")).agg(F.count("*").alias("n_children"))
    tree = tree.join(children, F.col("key") == F.col("up"), "left").drop("up").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    # What the nodes of a point's edge save belongs to its least member; of a member's points, only the uppermost has others of another one above.
    saves = (F.col("n") - 1) * F.coalesce(F.get("edge", F.lit(0)), F.lit(0))
    down = W.Window.partitionBy("conv_id").orderBy("depth").rowsBetween(W.Window.unboundedPreceding, W.Window.currentRow)
    tree = materialize(tree.withColumn("saves", saves).withColumn("above", F.sum("saves").over(down)))

    per_conv = tree.groupBy(F.col("conv_id").alias("c")).agg(F.sum("saves").alias("w"), F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves"))
    first = turns.sparkSession.createDataFrame([(p, place) for p, (place, _, _) in shared.items()], "p int, first long")  # a row a partition
    ranked = order.select("part", "conv_id", "level", "start", "digests").withColumn("place", F.row_number().over(W.Window.partitionBy("part").orderBy("level", "start", "digests", "conv_id")) - 1)
    ranked = ranked.join(F.broadcast(first), F.col("part") == F.col("p")).select("part", "conv_id", (F.col("place") + F.col("first")).alias("place"))
    ranked = ranked.join(per_conv, F.col("conv_id") == F.col("c"), "left").na.fill(0, ["w", "leaves"]).select("part", "place", "w", "leaves")
    run = W.Window.partitionBy("part").orderBy("place").rowsBetween(W.Window.unboundedPreceding, -1)
    sums = materialize(ranked.select("part", "place", "w", "leaves", *[F.coalesce(F.sum(c).over(run), F.lit(0)).alias(f"{c}_before") for c in ("w", "leaves")]))
    totals = sums.groupBy("part").agg(F.sum("w").alias("w"), F.sum("leaves").alias("leaves"))
    earlier = W.Window.orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1)  # a row a partition
    offsets = totals.select(F.col("part").alias("p"), *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_offset") for c in ("w", "leaves")])
    sums = sums.join(F.broadcast(offsets), F.col("part") == F.col("p"))
    below = sums.select(F.col("place").alias("lo_place"), *[(F.col(f"{c}_before") + F.col(f"{c}_offset")).alias(f"{c}_lo") for c in ("w", "leaves")])
    up_to = sums.select(F.col("place").alias("hi_place"), *[(F.col(f"{c}_before") + F.col(f"{c}_offset") + F.col(c)).alias(f"{c}_hi") for c in ("w", "leaves")])
    tree = tree.join(below, F.col("lo") == F.col("lo_place")).join(up_to, F.col("hi") == F.col("hi_place"))
    last = F.coalesce(F.get("edge", F.size("edge") - 1), F.lit(0))
    tree = tree.select(
        "key", "parent", "depth", "conv_id", "n", "n_children", "edge", last.alias("last"), (F.col("leaves_hi") - F.col("leaves_lo")).alias("n_leaves"),
        ((F.col("n") - 1) * last + F.col("w_hi") - F.col("w_lo") - F.col("above")).alias("saved"),
    )

    full = F.octet_length("digests") == segment * WIDE
    end = F.when(full, _key(F.col("level") + 1, F.col("next"), F.unhex(F.lit("")))).otherwise(_key(F.col("level"), F.col("start"), F.col("digests")))
    digests = end_digests(order.where("final").select(end.alias("key"), "conv_id")).withColumnRenamed("key", "ended")
    tree = materialize(tree.join(digests, F.col("key") == F.col("ended"), "left").drop("ended"))

    ups = tree.select(F.col("key").alias("up"), F.col("conv_id").alias("up_conv"), "n_children").where("n_children > 0").withColumnRenamed("n_children", "times")
    rest = tree.where("parent IS NOT NULL")
    placed = join_hot(rest, ups, [("parent", "up")], "times", tree.count())
    placed = placed.select("*", F.posexplode("edge").alias("i", "sum"))
    lowest = F.col("i") == F.size("edge") - 1
    nodes = placed.select(
        "conv_id", (F.col("depth") - F.size("edge") + 1 + F.col("i")).alias("depth"), F.when(F.col("i") == 0, F.col("up_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(lowest, F.col("n_children")).otherwise(1).alias("n_children"), "n_leaves", (F.col("saved") + (F.col("n") - 1) * (F.col("sum") - F.col("last"))).alias("saved_tokens"), F.when(lowest, F.col("ends_sha256")).alias("ends_sha256"),
    )
    top = tree.where("parent IS NULL").select("conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")
    none = hashlib.sha256().hexdigest()
    longs = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    return top.unionByName(nodes).select(*[F.col(c).cast("long").alias(c) for c in longs], F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def conversation_trie(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT) -> DataFrame:
    """The prefix tree of the rebuilt conversations of a table of turns.

    Turns are ordered by number (null first), turns of one number by their content; repeated rows
    are turns of their own; null roles and texts are empty; rows without a conversation are left
    out; other columns are ignored. An empty table gives an empty result.
    """
    turns = materialize(positions(rows, conv, turn, role, text))
    return prefix_trie(*rebuilt(turns, turns.count()), segment)
