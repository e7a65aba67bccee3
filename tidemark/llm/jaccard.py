"""Documents linked by the Jaccard similarity of their word shingles, and the groups that links form.

A document's set has the hashes of its distinct shingles of five words; a text of fewer words is one
shingle. Equal sets are one node of the graph, so exact copies meet at once. The links between
different sets come from count vectors (``count_tree``):

1. Points: one pass gives each document its node, its size and its group counts.
2. Cells: all hashes have one common order. Sets that reach the similarity share one of their first
   ``n - ceil(t n) + 1`` hashes, so each node goes to the cells of those, and similar nodes meet in
   a cell. The order puts hashes last that a sample of the documents shows often. That moves work,
   never results: any order finds every pair.
3. Stars: every node of a cell is paired with the cell's middle, the node with the most shared
   hashes; pairs that the overlap bound lets through are verified on the whole texts. This gathers
   large groups of near copies with one pair per node.
4. Trees: cells that still hold several components are searched with an R-tree over the counts of
   their nodes; pairs of different components that the bound lets through are verified too.

Links inside a component add nothing to it, so they need no check; every other link is found. Cells
of any size are cut into tiles of ``TILE`` nodes, pairs of one star into parts of ``PART`` nodes.

Null and empty texts have no shingles and link with nothing. Nodes are 64-bit hashes of whole sets. A
null id joins its group but never names it unless all ids there are null. Repeated rows are
copies. Texts of any length are read whole, a long one takes memory in proportion to its words. Columns
are picked by name, so others may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.llm.columns import fresh, text_of
from tidemark.llm.count_tree import likely_pairs, needed, overlap_bound, packed, unpacked
from tidemark.llm.graph import components
from tidemark.llm.memory import lean
from tidemark.session import checkpoint_root, remove, scratch_path

#: Words of a shingle and the similarity of a link in percent.
SHINGLE, PERCENT = 5, 75
#: One document in so many is looked at for frequent hashes, and at most so many hashes are put last.
SAMPLE, FREQUENT = 16, 1 << 16
TILE, PART = 1024, 512
#: Texts that one step of a worker holds as sets.
CHUNK = 256

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _spread(x: np.ndarray) -> np.ndarray:
    """Mixes the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = xxhash.xxh3_64_intdigest
    one = np.array([h(w) for w in words], np.uint64)
    n = len(one) - SHINGLE + 1
    with np.errstate(over="ignore"):
        return np.unique(_spread(sum(one[j : j + n] * f for j, f in enumerate(_FACTORS))))


def node_of(hashes: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).view(np.int64))


def prefix(n: int, percent: int = PERCENT) -> int:
    """How many first hashes of a set of ``n`` a similar set must share one of."""
    return n - -(-percent * n // 100) + 1


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _is_in(hashes: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(hashes), bool)
    return ordered[np.minimum(np.searchsorted(ordered, hashes), len(ordered) - 1)] == hashes


def _first(hashes: np.ndarray, frequent: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The first hashes in the common order, infrequent ones and frequent ones apart."""
    often = _is_in(hashes, frequent)
    m, rare = prefix(len(hashes), percent), hashes[~often]
    return rare[:m], hashes[often][: max(0, m - len(rare))]


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def frequent_hashes(rows: DataFrame, sample: int = SAMPLE, most: int = FREQUENT) -> np.ndarray:
    """At most ``most`` hashes that many documents of a sample have; affects only the order of hashes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter[int] = Counter()
            for text in batch.column(0).to_pylist():
                seen.update(_signed(shingle_set(text)).tolist())
            often = {h: c for h, c in seen.items() if c > 1}
            yield pa.RecordBatch.from_arrays([pa.array(often.keys(), pa.int64()), pa.array(often.values(), pa.int64())], names=["h", "c"])

    some = rows.filter(F.pmod(F.col("row_key"), F.lit(sample)) == 0).select("text").mapInArrow(lean(count), "h bigint, c bigint")
    often = some.groupBy("h").agg(F.sum("c").alias("c")).filter("c >= 4").orderBy(F.desc("c"), "h").limit(most)
    return np.sort(np.array([r.h for r in often.collect()], np.int64).view(np.uint64))


def _points(rows: DataFrame, shared, percent: int) -> DataFrame:
    """Per row: id, row_key, node, n, vector (packed counts), frequent first hashes, number of frequent hashes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                sets = [shingle_set(t) for t in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), batch.column(1),
                    pa.array([node_of(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([packed(s) for s in sets], pa.binary()),
                    pa.array([_signed(_first(s, shared.value, percent)[1]) for s in sets], pa.list_(pa.int64())),
                    pa.array([int(_is_in(s, shared.value).sum()) for s in sets], pa.int32()),
                ], names=["id", "row_key", "node", "n", "vector", "often", "n_often"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "row_key", "text").mapInArrow(lean(scan), f"id {id_type}, row_key bigint, node bigint, n bigint, vector binary, often array<bigint>, n_often int")


def _rare_postings(rows: DataFrame, shared, percent: int) -> DataFrame:
    """(h, node) of the infrequent first hashes; a batch gives each node once."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            seen: set[int] = set()
            for at in range(0, whole.num_rows, CHUNK):
                hashes, nodes = [], []
                for text in whole.slice(at, CHUNK).column(0).to_pylist():
                    s = shingle_set(text)
                    if len(s) and (node := node_of(s)) not in seen:
                        seen.add(node)
                        hashes.append(_signed(_first(s, shared.value, percent)[0]))
                        nodes.append(np.full(len(hashes[-1]), node, np.int64))
                if hashes:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hashes)), pa.array(np.concatenate(nodes))], names=["h", "node"])

    return rows.select("text").mapInArrow(lean(scan), "h bigint, node bigint")


def _bounded(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose summed minima of counts reach the overlap that the similarity needs."""
    with_a = pairs.join(nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("vector").alias("v_a")), "a")
    with_b = with_a.join(nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("vector").alias("v_b")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n_a, n_b, v_a, v_b = (c.to_pylist() for c in batch.columns)
            kept = [overlap_bound(unpacked(v_a[k]), unpacked(v_b[k])) >= needed(n_a[k], n_b[k], percent) for k in range(len(a))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))

    fits = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return with_b.filter(fits).select("a", "b", "n_a", "n_b", "v_a", "v_b").mapInArrow(lean(check), "a bigint, b bigint")


def _verified(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity.

    Each text travels once to the rows of its pairs, then to its hubs (b); a hub with many pairs is
    cut into parts, each with a copy of the hub's text.
    """
    pairs = pairs.checkpoint()
    hubs = pairs.groupBy(F.col("b").alias("hub")).agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")).checkpoint()
    members = pairs.select(F.col("a").alias("node"), F.col("b").alias("hub")).join(hubs, "hub").select(
        "node", "hub", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("member"))
    centres = hubs.select(F.col("hub").alias("node"), "hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("member"))
    # A hub of many parts has as many copies of its text, dealt over the parts, not gathered in one row.
    where = members.unionByName(centres).join(nodes.select("node", "row_key"), "node").checkpoint()
    texts = rows.select("row_key", "text").join(where, "row_key")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = texts.select("hub", "part", "member", "node", "text").repartition(n, "hub", "part").sortWithinPartitions("hub", "part", "member")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, centre = None, None
        for whole in batches:
            for first in range(0, whole.num_rows, CHUNK):
                a, b = [], []
                for hub, part, member, node, text in zip(*(c.to_pylist() for c in whole.slice(first, CHUNK).columns)):
                    if not member:
                        at, centre = (hub, part), shingle_set(text)
                    elif at == (hub, part) and similar(shingle_set(text), centre, percent):
                        a.append(node)
                        b.append(hub)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(lean(verify), "a bigint, b bigint").distinct().checkpoint()


def _after(point: np.ndarray, h: int, n_often: int, frequent: bool) -> np.ndarray:
    """The point of what a set can share with another one whose first common hash is ``h``.

    In the common order the infrequent hashes come first, then the frequent ones, each by value. So
    groups below that of ``h`` have nothing in common but, if ``h`` is infrequent, frequent hashes; their
    number stands in the first group. A similar pair passes in the cell of its first common hash;
    in later cells, where more groups are left out, most pairs do not pass again.
    """
    group = (h % (1 << 64)) >> (65 - len(point).bit_length())
    out = point.astype(np.uint32)
    if group:
        out[:group] = 0
        out[0] = 0 if frequent else n_often
    return out


def _tree_pairs(cells: DataFrame, nodes: DataFrame, shared, percent: int) -> DataFrame:
    """Pairs of different components that share a cell and pass the bound.

    ``cells`` has (h, node, component). A cell of m nodes is cut into ceil(m / TILE) tiles; each pair of
    tiles is one piece of work. The points join the pieces last, so they are shuffled once.
    """
    tiles = cells.groupBy("h").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")).checkpoint()
    laid = cells.join(tiles, "h").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    others = F.sequence(F.lit(0), F.col("tiles") - 1)
    laid = laid.select("h", "node", "component", "tile", F.explode(others).alias("other"))
    laid = laid.join(nodes.select("node", "n", "vector", "n_often"), "node")
    laid = laid.select("h", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "node", "component", "n", "vector", "n_often")
    n = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = laid.repartition(n, "h", "i", "j").sortWithinPartitions("h", "i", "j")

    def work(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        i, j = rows[0][1], rows[0][2]
        left = [r for r in rows if r[3] == i]
        right = left if i == j else [r for r in rows if r[3] == j]
        sizes = Counter(r[5] for r in rows)
        if len(sizes) < 2:
            return
        # Pairs inside the largest component need no look, so its nodes are only found, from the others.
        largest = max(sizes, key=lambda c: (sizes[c], c))
        h = rows[0][0]
        frequent = bool(_is_in(np.array([h], np.int64).view(np.uint64), shared.value)[0])
        points = [[(_after(unpacked(r[7]), h, r[8], frequent), r[6]) for r in some] for some in (left, right)]
        sides = [(left, right, *points)] if i == j else [(left, right, *points), (right, left, *points[::-1])]
        for mine, theirs, own, other in sides:
            for x, y in likely_pairs(own, other, percent, lambda r, mine=mine: mine[r][5] != largest):
                a, b = mine[x], theirs[y]
                if a[5] != b[5]:
                    yield max(a[4], b[4]), min(a[4], b[4])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece: list[tuple] = []
        found: set[tuple[int, int]] = set()

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([p[0] for p in found], pa.int64()), pa.array([p[1] for p in found], pa.int64())], names=["a", "b"])
            found.clear()
            return out

        for whole in batches:
            for row in zip(*(c.to_pylist() for c in whole.columns)):
                if piece and piece[0][:3] != row[:3]:
                    found.update(work(piece))
                    piece = []
                    if len(found) > 50_000:
                        yield batch()
                piece.append(row)
        if piece:
            found.update(work(piece))
        yield batch()

    return dealt.mapInArrow(lean(search), "a bigint, b bigint").distinct()


def _groups(docs: DataFrame, id_col: str, text_col: str, percent: int, sample: int) -> DataFrame:
    """Per row: id, row_key (hash of id and text), n, the smallest id of its group, and the row_key that
    stands for the group: of the rows with the smallest id the one with the smallest row_key."""
    spark = docs.sparkSession
    checkpoint_root(spark)
    text = text_of(docs, text_col)
    rows = docs.select(docs[id_col].alias("id"), F.xxhash64(docs[id_col], text).alias("row_key"), text.alias("text"))
    shared = spark.sparkContext.broadcast(frequent_hashes(rows, sample))  # at most FREQUENT numbers

    path = scratch_path(spark, "points")
    _points(rows, shared, percent).write.parquet(path)
    points = spark.read.parquet(path)
    nodes = (
        points.filter("n > 0").groupBy("node").agg(F.min(F.struct("row_key", "n", "vector", "n_often")).alias("p"))
        .select("node", "p.row_key", "p.n", "p.vector", "p.n_often").checkpoint()
    )

    # Cells of at least two nodes, as (h, node).
    cell = Window.partitionBy("h")
    rare = _rare_postings(rows, shared, percent).select("h", "node", F.min("node").over(cell).alias("low"), F.max("node").over(cell).alias("high"))
    often = points.select("node", F.explode("often").alias("h")).distinct()
    # One row per frequent hash, at most FREQUENT: a broadcast of bounded size.
    ends = often.groupBy("h").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    cells_path, placed_path = scratch_path(spark, "cells"), scratch_path(spark, "placed")
    rare.filter("low < high").select("h", "node", F.lit(False).alias("frequent")).unionByName(often.join(F.broadcast(ends), "h").select("h", "node", F.lit(True).alias("frequent"))).write.parquet(cells_path)
    cells = spark.read.parquet(cells_path)

    # A cell's star has the node with the most shared hashes in its middle: among near copies that is
    # one with few changes, which most others are similar to.
    weight = cells.groupBy("node").agg(F.count("*").alias("w")).checkpoint()
    middle = cells.join(weight, "node").groupBy("h").agg(F.max(F.struct("w", "node")).alias("m")).select("h", F.col("m.node").alias("centre")).checkpoint()
    stars = cells.join(middle, "h").filter("node != centre").groupBy(F.col("node").alias("a"), F.col("centre").alias("b")).agg(F.count("*")).select("a", "b")
    links = _verified(_bounded(stars, nodes, percent), nodes, rows, percent)
    first = components(links)

    # Cells that still hold several components.
    placed = cells.distinct().join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed.write.parquet(placed_path)
    placed = spark.read.parquet(placed_path)
    remove(spark, [cells_path])  # all that came of it is checkpointed
    # Cells of the same nodes (the hashes of one passage) are searched once, in the first of them by the
    # common order: only there is the first hash that a pair shares (``_after``).
    unsigned = F.col("h").bitwiseXOR(F.lit(-(1 << 63)))
    split = (
        placed.groupBy("h", "frequent").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("m"),
            F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
        .filter("low < high").groupBy("m", "x", "y").agg(F.min(F.struct("frequent", unsigned, "h")).alias("first")).select("first.h").checkpoint()
    )
    open_cells = placed.join(split, "h", "left_semi").select("h", "node", "component")
    more = _verified(_tree_pairs(open_cells, nodes, shared, percent), nodes, rows, percent)
    final = components(links.unionByName(more))
    remove(spark, [placed_path])

    grouped = points.filter("n > 0").join(final, "node", "left").select("id", "row_key", "n", F.coalesce("component", "node").alias("group"))
    # Null ids come last.
    smallest = grouped.groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row_key")).alias("s")).select("group", F.col("s.id").alias("smallest"), F.col("s.row_key").alias("kept_key")).checkpoint()
    named = grouped.join(smallest, "group").select("id", "row_key", "n", "smallest", "kept_key")
    alone = points.filter("n = 0").select("id", "row_key", "n", F.col("id").alias("smallest"), F.col("row_key").alias("kept_key"))
    return named.unionByName(alone)


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, sample: int = SAMPLE) -> DataFrame:
    """Per row: id, ``n_shingles`` and ``component_id``, the smallest id that links reach."""
    found = _groups(docs, id_col, text_col, percent, sample)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("smallest").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, sample: int = SAMPLE) -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns.

    Of different texts that share the smallest id, or have no id, the one with the smallest hash stays. Rows
    that share id and text are one document listed more than once and stay or go together.
    """
    key, gone_key = fresh(docs, "similar_key", "similar_gone")
    gone = _groups(docs, id_col, text_col, percent, sample).filter("row_key != kept_key").select(F.col("row_key").alias(gone_key)).distinct()
    keyed = docs.withColumn(key, F.xxhash64(docs[id_col], text_of(docs, text_col)))
    return keyed.join(gone, keyed[key] == gone[gone_key], "left_anti").drop(key)
