"""Conversation prefix trie: sorted sequences, their LCPs and a sparse table of range minima.

A conversation is the sequence of its turns' digests. All sequences are range-sorted; neighbours give
the array of longest common prefixes (LCP). A prefix of ``d`` turns is a node, and its members are the
rows around it between which no LCP is below ``d``: every candidate prefix binary-searches its left and its
right extent on its own over a sparse table of LCP minima. Sums and minima over the extents give the
node's counts.

The sorted rows are worked through in blocks of bounded size. A node that lies inside a block is done
there. Of a node that crosses a block's edge each block gives one piece; pieces are few (two paths a
block) and are summed by node. A conversation of more than ``SEGMENT`` turns is cut into segments; each
level of segments is sorted under the digest of all turns before it, from the last level to the first,
and hands what hangs below a node to the level above. So no task or row holds an unbounded conversation,
and copies of one conversation, however many, spread over blocks by their ids.

Rows without a conversation id take no part; null role or text is the empty text. Turns are ordered by
turn number, null first, then by the digest of role and text (so repeated rows count as often as they
stand there). Very long texts enter as digest and length only. An empty table has no nodes, not even a
root. Columns are picked by name, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.ordinal import running
from tidemark.session import checkpoint_root

#: Turns of a segment, and rows of a block.
SEGMENT, BLOCK = 256, 2048
#: Bytes of a turn's digest.
WIDTH = 16

_NODE = (
    "open boolean, block long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends string, node string, parent string, right boolean, start boolean, bytes long, first_end long"
)
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


# ---------------------------------------------------------------- sequences


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn digest, bytes of the text): pos counts a conversation's turns from 0."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    ordered = running(turns, ["conv_id", "turn", "digest"])
    first = ordered.groupBy("conv_id").agg(F.min("ordinal").alias("first"), F.count(F.lit(1)).alias("n_turns"))
    return ordered.join(first, "conv_id").select("conv_id", (F.col("ordinal") - F.col("first")).alias("pos"), "digest", "bytes", "n_turns")


def rebuilt(turns: DataFrame, base: Column, borrowed: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) of every rebuilt conversation, and its turns (conv_id, pos, digest, bytes).

    A conversation is the first ``borrowed`` (at most ``most``) turns of conversation ``base``, then its
    own turns after as many; both are expressions over ``conv_id``."""
    convs = turns.groupBy("conv_id").agg(F.max("n_turns").alias("n_turns")).select("conv_id", "n_turns", base.alias("base"), borrowed.alias("h"))
    heads = (
        turns.filter(F.col("pos") < most).join(convs.select(F.col("base").alias("conv_id")).distinct(), "conv_id", "left_semi")
        .groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "bytes"))).alias("head"))
    )
    none = F.array().cast("array<struct<pos:bigint,digest:string,bytes:bigint>>")
    convs = convs.join(heads, "base", "left").withColumn("head", F.coalesce(F.slice("head", F.lit(1), F.col("h").cast("int")), none))
    convs = convs.withColumn("length", F.size("head") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0)))
    borrowed_turns = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.pos", "t.digest", "t.bytes")
    own = turns.drop("n_turns").join(convs.select("conv_id", "h", F.size("head").alias("before")), "conv_id").filter("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("before")).alias("pos"), "digest", "bytes")
    return convs.select("conv_id", "length"), borrowed_turns.unionByName(own)


def segments(convs: DataFrame, turns: DataFrame, size: int) -> DataFrame:
    """(conv_id, segment, head, key, sizes, last): the digests and sizes of up to ``size`` turns, under
    the digest of all turns before them; one row without turns for a conversation that has none."""
    cut = (
        turns.groupBy("conv_id", F.floor(F.col("pos") / size).alias("segment"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "bytes"))).alias("turns"))
        .select("conv_id", "segment", F.unhex(F.array_join("turns.digest", "")).alias("key"), F.col("turns.bytes").alias("sizes"))
    )
    rows = convs.join(cut, "conv_id", "left").select(
        "conv_id", F.coalesce("segment", F.lit(0)).alias("segment"), F.coalesce("key", F.lit(b"")).alias("key"),
        F.coalesce("sizes", F.array().cast("array<bigint>")).alias("sizes"), "length",
    )
    rows = rows.withColumn("last", (F.col("segment") + 1) * size >= F.col("length"))
    # The digest before segment n + 1 is made of that before n and of segment n; only conversations of
    # several segments have any, one short text per segment.
    long = rows.filter(F.col("length") > size).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("segment", F.md5("key").alias("own")))).alias("parts"))
    chain = F.aggregate("parts", F.array(F.lit("")), lambda heads, p: F.concat(heads, F.array(F.md5(F.concat(F.element_at(heads, -1), p["own"]).cast("binary")))))
    heads = long.select("conv_id", F.posexplode(chain).alias("segment", "head"))
    return rows.join(heads, ["conv_id", "segment"], "left").withColumn("head", F.coalesce("head", F.lit(""))).drop("length")


# ---------------------------------------------------------------- blocks of sorted rows


class Rows:
    """Sorted rows of one block."""

    def __init__(self, batch: pa.RecordBatch):
        def numbers(name: str) -> np.ndarray:
            return batch.column(name).to_numpy(zero_copy_only=False)

        self.conv = numbers("conv_id")
        self.heads = batch.column("head").to_pylist()
        self.keys = batch.column("key").to_pylist()
        self.sizes = batch.column("sizes").flatten().to_numpy(zero_copy_only=False)
        self.last = numbers("last").astype(bool)
        self.more_children, self.more_leaves, self.more_saved = (numbers(c).astype(np.int64) for c in ("more_children", "more_leaves", "more_saved"))
        self.length = np.array([len(k) // WIDTH for k in self.keys], dtype=np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.length)])
        self.digests = np.frombuffer(b"".join(self.keys), dtype=[("a", "<u8"), ("b", "<u8")])

    def lcp(self) -> np.ndarray:
        """Turns that each row shares with the row before it in the block (the first row: 0)."""
        shorter = np.minimum(self.length[:-1], self.length[1:])
        same_head = np.array([a == b for a, b in zip(self.heads, self.heads[1:])], dtype=bool)
        shorter = np.where(same_head, shorter, 0)
        total = int(shorter.sum())
        pair = np.repeat(np.arange(len(shorter)), shorter)
        within = np.arange(total) - np.repeat(np.cumsum(shorter) - shorter, shorter)
        left, right = self.digests[self.offset[pair] + within], self.digests[self.offset[pair + 1] + within]
        shared = shorter.copy()
        differ = (left["a"] != right["a"]) | (left["b"] != right["b"])
        np.minimum.at(shared, pair[differ], within[differ])
        return np.concatenate([[0], shared])


def shared_turns(one: tuple[str, bytes] | None, other: tuple[str, bytes] | None) -> int:
    """LCP in turns of two (head, key); -1 where there is no row."""
    if one is None or other is None:
        return -1
    if one[0] != other[0]:
        return 0
    n = min(len(one[1]), len(other[1])) // WIDTH
    low, high = 0, n
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if one[1][: mid * WIDTH] == other[1][: mid * WIDTH] else (low, mid - 1)
    return low


class RangeMinimum:
    """Sparse table: minima over all runs whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 * (step := 1 << (len(self.levels) - 1)) <= len(values):
            self.levels.append(np.minimum(self.levels[-1][:-step], self.levels[-1][step:]))

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum of values[first..last], by the two runs that cover it."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), dtype=self.levels[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][first[at]], self.levels[k][last[at] - (1 << int(k)) + 1])
        return out

    def reach_right(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Last row such that no value after ``row`` up to it is below ``depth``."""
        at = row.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            mins = self.levels[k]
            start = at + 1
            fits = (start < len(mins)) & (mins[np.minimum(start, len(mins) - 1)] >= depth)
            at = np.where(fits, at + (1 << k), at)
        return at

    def reach_left(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """First row such that no value after it up to ``row`` is below ``depth``."""
        at = row.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            start = at - (1 << k) + 1
            fits = (start >= 1) & (self.levels[k][np.maximum(start, 0)] >= depth)
            at = np.where(fits, at - (1 << k), at)
        return at


def block_nodes(rows: Rows, before: int, after: int, level: int, segment: int, block: int) -> dict[str, list]:
    """All nodes of a block, whole ones and pieces, by name of column. ``before`` and ``after`` are the LCPs
    of its first and last row with their neighbours outside (-1: there is none)."""
    m, floor = len(rows.conv), 0 if level == 0 else 1
    inside = rows.lcp()
    lcp = np.append(inside, after)
    lcp[0] = before
    table = RangeMinimum(inside)
    # Candidates: each row's prefixes that the row before does not have; the first row's all.
    lowest = np.maximum(lcp[:m] + 1, floor)
    lowest[0] = floor
    count = np.maximum(rows.length - lowest + 1, 0)
    base = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(m), count)
    depth = np.arange(base[-1]) - base[row] + lowest[row]
    left, right = table.reach_left(row, depth), table.reach_right(row, depth)
    starts = depth > lcp[row]
    to_left, to_right = (left == 0) & (lcp[0] >= depth), (right == m - 1) & (after >= depth)
    is_open = to_left | to_right

    members = right - left + 1
    smallest = RangeMinimum(rows.conv).between(left, right)
    size = np.zeros(len(row), dtype=np.int64)
    if len(rows.sizes):
        at = rows.offset[row] + depth - 1
        size = np.where(depth > 0, rows.sizes[np.clip(at, 0, len(rows.sizes) - 1)], 0)
    # A row whose sequence no later row goes on with is a leaf, or has what the level below hangs there.
    final = lcp[1:] < rows.length
    goes_on = rows.more_children > 0
    leaves = np.concatenate([[0], np.cumsum(np.where(final, np.where(goes_on, rows.more_leaves, 1), 0))])
    below = np.concatenate([[0], np.cumsum(np.where(final & goes_on, rows.more_saved, 0))])
    own = np.where(is_open, 0, (members - 1) * size)
    sums = np.concatenate([[0], np.cumsum(own)])
    saved = sums[base[right + 1]] - sums[:-1] + below[right + 1] - below[left]

    # A node's parent is the candidate one turn shorter, of the same row or of the leftmost row that has it.
    parent = np.arange(len(row)) - 1
    new = np.flatnonzero((depth == lowest[row]) & (depth > floor) & (row > 0))
    at = table.reach_left(row[new], depth[new] - 1)
    parent[new] = base[at] + depth[new] - 1 - lowest[at]
    top = depth == floor
    children = np.bincount(parent[starts & ~top], minlength=len(row)) + np.where(starts & (depth == rows.length[row]), rows.more_children[row], 0)
    parent_open = np.where(top, False, is_open[np.maximum(parent, 0)])

    # Ids of the conversations that end in a node: those of the equal rows from its first row on.
    same = np.zeros(m, dtype=bool)
    same[1:] = (inside[1:] == rows.length[1:]) & (rows.length[1:] == rows.length[:-1]) & np.array([a == b for a, b in zip(rows.heads, rows.heads[1:])], dtype=bool)
    run = np.flatnonzero(~same)
    ends = [""] * len(row)
    first_end: list = [None] * len(row)
    for a, b in zip(run, np.append(run[1:], m)):
        ids = rows.conv[a:b][rows.last[a:b]]
        if len(ids):
            at = int(base[a] + rows.length[a] - lowest[a])
            ends[at], first_end[at] = ",".join(map(str, ids.tolist())), int(ids[0])
    none = hashlib.sha256(b"").hexdigest()
    ends = [t if o else hashlib.sha256(t.encode()).hexdigest() if t else none for t, o in zip(ends, is_open.tolist())]

    def name(k: int) -> str:
        return node_name(rows.heads[row[k]], rows.keys[row[k]][: int(depth[k]) * WIDTH])

    named = is_open | (depth == segment)
    names = [name(k) if n else None for k, n in enumerate(named.tolist())]
    parents = [None] * len(row)
    for k in np.flatnonzero(parent_open):
        parents[k] = names[parent[k]]
    if level:
        for k in np.flatnonzero(top):
            parents[k] = rows.heads[row[k]]
    known = ~(top | parent_open)
    return {
        "open": is_open, "block": [block] * len(row), "conv_id": smallest, "depth": depth + level * segment,
        "parent_conv_id": [p if k else None for p, k in zip(smallest[np.maximum(parent, 0)].tolist(), known.tolist())],
        "n_convs": members, "n_children": children, "n_leaves": leaves[right + 1] - leaves[left], "saved_tokens": saved, "ends": ends,
        "node": names, "parent": parents, "right": to_right, "start": starts, "bytes": size, "first_end": first_end,
    }


def node_name(head: str, key: bytes) -> str:
    """Digest of all turns of a prefix: those before its segment, then its own."""
    return hashlib.md5((head + hashlib.md5(key).hexdigest()).encode()).hexdigest()


def _work(batches: Iterable[pa.RecordBatch], level: int, segment: int, size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Blocks of one sorted partition, each with the row before it and the row after it."""
    held, before, count = None, None, 0

    def done(block: pa.RecordBatch, before: int, after: int) -> pa.RecordBatch:
        number = (block.column("pid")[0].as_py() << 32) + count
        columns = block_nodes(Rows(block), before, after, level, segment, number)
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)

    def key(block: pa.RecordBatch, at: int) -> tuple[str, bytes]:
        return block.column("head")[at].as_py(), block.column("key")[at].as_py()

    for batch in batches:
        for at in range(0, batch.num_rows, size):
            block = batch.slice(at, size)
            if held is not None:
                shared = shared_turns(key(held, held.num_rows - 1), key(block, 0))
                yield done(held, before, shared)
                before, count = shared, count + 1
            else:
                before = block.column("lcp_before")[0].as_py()
            held = block
    if held is not None:
        yield done(held, before, held.column("lcp_after")[0].as_py())


def _neighbours(ranged: DataFrame) -> DataFrame:
    """(pid, lcp_before, lcp_after) of each partition that has rows, from its first and last row."""
    ends = ranged.groupBy("pid").agg(F.min(F.struct("head", "key")).alias("low"), F.max(F.struct("head", "key")).alias("high"))
    after = Window.orderBy("pid")  # one row a partition
    pairs = ends.select("pid", "low", "high", F.lag("high").over(after).alias("prev"), F.lead("low").over(after).alias("next"))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            pair = lambda x: None if x is None else (x["head"], x["key"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["pid"] for r in rows], pa.int64()),
                    pa.array([shared_turns(pair(r["prev"]), pair(r["low"])) for r in rows], pa.int64()),
                    pa.array([shared_turns(pair(r["high"]), pair(r["next"])) for r in rows], pa.int64()),
                ],
                names=["pid", "lcp_before", "lcp_after"],
            )

    return pairs.mapInArrow(compare, "pid long, lcp_before long, lcp_after long")


def _hash_ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, sha256 of its joined ids) from texts sorted by node and first id; holds one text at a time."""
    node, state = None, None
    out: list[tuple[str, str]] = []
    for batch in batches:
        for at in range(batch.num_rows):
            name, text = batch.column("node")[at].as_py(), batch.column("ends")[at].as_py()
            if name != node:
                if state is not None:
                    out.append((node, state.hexdigest()))
                node, state = name, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out]), pa.array([x[1] for x in out])], names=["node", "ends_sha256"])
            out = []
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])


def level_nodes(rows: DataFrame, level: int, segment: int, block: int) -> DataFrame:
    """All nodes of one level of segments, with ``node`` (name, where a level below needs it) and
    ``parent`` (name of a parent in the level above)."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        rows.repartitionByRange(n, "head", "key", "conv_id").sortWithinPartitions("head", "key", "conv_id")
        .withColumn("pid", F.spark_partition_id().cast("long")).checkpoint()
    )
    columns = ["pid", "conv_id", "head", "key", "sizes", "last", "more_children", "more_leaves", "more_saved", "lcp_before", "lcp_after"]
    worked = ranged.join(F.broadcast(_neighbours(ranged)), "pid").select(*columns)
    schema = _arrow_schema(_NODE)
    nodes = worked.mapInArrow(lambda batches: _work(batches, level, segment, block, schema), _NODE).checkpoint()

    # Pieces of nodes that cross block edges: sums by node, then what their subtrees save.
    pieces = nodes.filter("open")
    whole = pieces.groupBy("node", "depth").agg(
        F.min("conv_id").alias("all_conv"), F.sum("n_convs").alias("all_convs"), F.max("bytes").alias("size"), F.max("parent").alias("above")
    )
    value = F.when(F.col("start"), (F.col("all_convs") - 1) * F.col("size")).otherwise(0)
    path = Window.partitionBy("block").orderBy(F.col("depth").desc(), "start").rowsBetween(Window.unboundedPreceding, 0)
    pieces = pieces.join(whole, ["node", "depth"]).withColumn("along", F.sum(F.when(F.col("right"), value).otherwise(0)).over(path)).withColumn(
        "saved", F.col("saved_tokens") + F.when(F.col("right"), F.col("along")).otherwise(0)
    ).checkpoint()
    hashed = (
        pieces.filter("ends != ''").select("node", "first_end", "ends").repartition("node").sortWithinPartitions("node", "first_end")
        .mapInArrow(_hash_ends, "node string, ends_sha256 string")
    )
    merged = pieces.groupBy("node", "depth").agg(
        F.first("all_conv").alias("conv_id"), F.first("all_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.first("above").alias("parent"),
    )
    parents = whole.select(F.col("node").alias("parent"), F.col("all_conv").alias("parent_conv_id"))
    merged = merged.join(parents, "parent", "left").join(hashed, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))

    closed = nodes.filter("NOT open").withColumnRenamed("ends", "ends_sha256")
    known = closed.filter("parent_conv_id IS NOT NULL OR parent IS NULL")
    above = pieces.groupBy("block", F.col("node").alias("parent")).agg(F.first("all_conv").alias("parent_conv_id"))
    waiting = closed.filter("parent_conv_id IS NULL AND parent IS NOT NULL").drop("parent_conv_id").join(above, ["block", "parent"], "left")
    names = [*OUT, "node", "parent"]
    return known.select(names).unionByName(waiting.select(names)).unionByName(merged.select(names))


def _arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(ddl))


def prefix_trie(
    conversations: DataFrame, base: Callable[[Column], Column], borrowed: Callable[[Column], Column], most: int, segment: int = SEGMENT, block: int = BLOCK
) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    Conversation ``c`` is rebuilt from the first ``borrowed(c)`` (at most ``most``) turns of conversation
    ``base(c)`` and its own turns after as many."""
    checkpoint_root(conversations.sparkSession)
    turns = turn_rows(conversations).checkpoint()
    convs, rows = rebuilt(turns, base(F.col("conv_id")), borrowed(F.col("conv_id")), most)
    cut = segments(convs, rows, segment).checkpoint()
    top = cut.agg(F.max("segment")).first()[0]
    out: list[DataFrame] = []
    below = None
    for level in range(-1 if top is None else int(top), -1, -1):
        here = cut.filter(F.col("segment") == level).drop("segment")
        if below is None:
            here = here.select("*", *[F.lit(0).cast("long").alias(c) for c in ("more_children", "more_leaves", "more_saved")])
        else:
            more = below.filter(F.col("depth") == (level + 1) * segment + 1).groupBy(F.col("parent").alias("whole")).agg(
                F.count(F.lit(1)).alias("more_children"), F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved")
            )
            here = here.withColumn("whole", F.md5(F.concat("head", F.md5("key")).cast("binary"))).join(more, "whole", "left").drop("whole").na.fill(0)
        nodes = level_nodes(here, level, segment, block).checkpoint()
        if below is not None:
            ends = nodes.filter(F.col("depth") == (level + 1) * segment).select(F.col("node").alias("parent"), F.col("conv_id").alias("of_parent"))
            out[-1] = below.join(ends, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "of_parent"))
        out.append(nodes)
        below = nodes
    if not out:
        return conversations.sparkSession.createDataFrame([], ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in OUT))
    result = out[0].select(OUT)
    for more in out[1:]:
        result = result.unionByName(more.select(OUT))
    return result
