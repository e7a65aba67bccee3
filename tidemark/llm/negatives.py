"""Hard-negative mining: Fagin's threshold algorithm over blocks of integer vectors.

Vectors are cut into blocks of bounded size. A task holds one block with a sorted list of its rows per
dimension, and every anchor visits every block: a stated query set against all rows, in blocks. For an
anchor the lists are read from the end that its component's sign favours, some positions of all lists at
a time; rows met for the first time are scored in integers by random access; the sum of the anchor's
components times the values at the current positions bounds every row not met yet. A search ends once
that threshold lies strictly below the score that its last wanted place needs, so ties are never lost.

Two passes: the best rows of the anchor's own label (positives), then, for each positive, the best rows
of other labels inside the window of scores that the positive allows. Each block answers with its own
best rows and a ranking keeps the best over all blocks.

Rows with a null id, label or vector or with a null or non-finite component take no part. Vectors of
unequal length are padded with zeros. Rows that share an id are one item: the least by label, then by
components. Ties go to the smaller id. An empty table, or one without anchors, gives an empty result.
Scores are exact below 2^63. Columns are picked by name, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpoint_root

#: Components of a block at most, and rows of a block at least as long as there are tasks enough.
BLOCK_CELLS, SMALLEST = 1 << 21, 1024
#: The share of the lists that the first round reads; each round doubles it.
FIRST_ROUND = 1 / 32
_INEXACT = 2.0**53

_FOUND = "anchor_id long, id long, score long, window int"
_WINDOWS = "array<struct<low:bigint,high:bigint>>"


class Block:
    """Rows of one block with their sorted lists, for all rows and for the rows of each label."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.largest = np.abs(vectors).max(initial=0)
        self.floats = vectors.astype(np.float64)
        self._lists: dict[int | None, tuple[np.ndarray, np.ndarray]] = {}

    def lists(self, label: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(rows, their positions in ascending order for each dimension), of one label or of all rows."""
        if label not in self._lists:
            rows = np.arange(len(self.ids)) if label is None else np.flatnonzero(self.labels == label)
            order = np.argsort(self.vectors[rows], axis=0, kind="stable")
            self._lists[label] = rows, rows[order] if len(rows) else order
        return self._lists[label]

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Inner products; in doubles where every sum is exact in them."""
        if float(self.largest) * float(np.abs(anchor).max(initial=0)) * max(len(anchor), 1) < _INEXACT:
            return (self.floats[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ anchor

    def sorted_access(self, anchor: np.ndarray, label: int | None) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
        """(rows met first, their scores, threshold of the rows not met yet) round by round; the last threshold is None."""
        rows, order = self.lists(label)
        n, used = len(rows), np.flatnonzero(anchor)
        met, at, step = np.zeros(len(self.ids), dtype=bool), 0, max(1, int(n * FIRST_ROUND))
        if not len(used):  # no list tells anything: all scores are zero
            yield rows, np.zeros(n, dtype=np.int64), None
            return
        favoured = anchor[used] > 0
        while at < n:
            end = min(n, at + step)
            front = order[n - end : n - at][:, used[favoured]]
            back = order[at:end][:, used[~favoured]]
            seen = np.concatenate([front.ravel(), back.ravel()])
            fresh = np.zeros(len(self.ids), dtype=bool)
            fresh[seen] = True
            fresh &= ~met
            met |= fresh
            new = np.flatnonzero(fresh)
            threshold = None
            if end < n:
                last = np.where(favoured, order[n - end, used], order[end - 1, used])
                threshold = int((self.vectors[last, used] * anchor[used]).sum())
            yield new, self.scores(new, anchor), threshold
            at, step = end, end

    def positives(self, id: int, label: int, anchor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best other rows of the label."""
        ids, scores = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        for rows, found, threshold in self.sorted_access(anchor, label):
            other = self.ids[rows] != id
            ids, scores = best(np.append(ids, self.ids[rows[other]]), np.append(scores, found[other]), k)
            if threshold is not None and len(ids) == k and threshold < scores[-1]:
                break
        return ids, scores

    def negatives(self, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ``k`` best rows of other labels within each window of scores."""
        empty = np.empty(0, dtype=np.int64)
        kept = [(empty, empty) for _ in windows]
        if not windows:
            return kept
        for rows, found, threshold in self.sorted_access(anchor, None):
            other = self.labels[rows] != label
            ids, scores = self.ids[rows[other]], found[other]
            needed = []
            for w, (low, high) in enumerate(windows):
                fits = (scores >= low) & (scores <= high)
                if fits.any():
                    kept[w] = best(np.append(kept[w][0], ids[fits]), np.append(kept[w][1], scores[fits]), k)
                needed.append(kept[w][1][-1] if len(kept[w][0]) == k else low)
            if threshold is not None and threshold < min(needed):
                break
        return kept


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores, ties by smaller id, in that order."""
    if len(ids) > 4 * k:  # only rows that reach the kth score can be among them
        reach = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[reach], scores[reach]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """List values as rows of a matrix, padded with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), dims), dtype=np.int64)
    out[np.arange(dims)[None, :] < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _search(batches: Iterable[pa.RecordBatch], dims: int, k: int) -> Iterator[pa.RecordBatch]:
    """One partition: rows of its block first, then the anchors that visit it."""
    held: list[tuple] = []
    block = None
    for batch in batches:
        asks = batch.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        vectors = _matrix(batch.column("vec"), dims)
        if not asks.all():
            held.append((ids[~asks], labels[~asks], vectors[~asks]))
        if not asks.any():
            continue
        if block is None:
            if not held:
                return
            block, held = Block(*(np.concatenate(x) for x in zip(*held))), []
        out: list[tuple] = []
        windows = batch.column("windows")
        for at in np.flatnonzero(asks):
            asked = windows[int(at)].as_py()
            if asked is None:
                found = [block.positives(ids[at], labels[at], vectors[at], k)]
            else:
                found = block.negatives(labels[at], vectors[at], [(w["low"], w["high"]) for w in asked], k)
            out += [(ids[at], i, s, w) for w, pair in enumerate(found) for i, s in zip(*pair)]
        columns = list(zip(*out)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int32()))], names=["anchor_id", "id", "score", "window"]
        )


def _visit(items: DataFrame, anchors: DataFrame, blocks: int, dims: int, k: int) -> DataFrame:
    """What each block finds for each anchor: anchor_id, id, score, window (number in ``windows``)."""
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
    rows = items.select(block, F.lit(False).alias("asks"), "id", "label", "vec", F.lit(None).cast(_WINDOWS).alias("windows"))
    asking = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("asks"), "id", "label", "vec", "windows")
    dealt = rows.unionByName(asking).repartitionById(blocks, F.col("block")).sortWithinPartitions("asks")
    return dealt.drop("block").mapInArrow(lambda batches: _search(batches, dims, k), _FOUND)


def integer_vectors(vectors: DataFrame, id: str, label: Column, vector: str, scale: float) -> DataFrame:
    """(id, label, vec): components times ``scale`` rounded down, for the rows that take part."""
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.filter(F.col(id).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.col(id).cast("long").alias("id"), label.cast("long").alias("label"),
        F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale)).alias("vec"),
    )
    return rows.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("item")).select("id", "item.label", "item.vec")


def _hundredth(x: Column) -> Column:
    """``x / 100`` rounded down, exact for all whole numbers."""
    return F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100))


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256.0,
) -> DataFrame:
    """Hard negatives: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` is a condition on the long column ``id`` of the rows that take part. A negative of a
    positive has another label and ``low * positive_score <= 100 * negative_score <= high * positive_score``.
    """
    spark = vectors.sparkSession
    checkpoint_root(spark)
    items = integer_vectors(vectors, id, label, vector, scale).checkpoint()
    size = items.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dims")).first()
    dims = max(size.dims or 1, 1)
    largest = max(1, BLOCK_CELLS // dims)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-size.n // largest), min(tasks, size.n // SMALLEST))
    anchors = items.filter(is_anchor).withColumn("windows", F.lit(None).cast(_WINDOWS))

    def ranked(found: DataFrame, *by: str) -> Column:
        return F.row_number().over(Window.partitionBy(*by).orderBy(F.col("score").desc(), "id"))

    near = _visit(items, anchors, blocks, dims, positives)
    near = near.withColumn("place", ranked(near, "anchor_id")).filter(F.col("place") <= positives)
    # Lowest and highest score that a negative may have, in whole numbers.
    bounds = F.struct((-_hundredth(F.col("score") * -low)).alias("low"), _hundredth(F.col("score") * high).alias("high"))
    asked = (
        near.withColumn("bounds", bounds).filter("bounds.low <= bounds.high").groupBy("anchor_id")
        .agg(F.sort_array(F.collect_list(F.struct("place", "id", "score", "bounds"))).alias("asked")).checkpoint()
    )
    second = anchors.drop("windows").join(asked.select(F.col("anchor_id").alias("id"), F.col("asked.bounds").alias("windows")), "id")
    far = _visit(items, second, blocks, dims, negatives)
    far = far.withColumn("rank", ranked(far, "anchor_id", "window")).filter(F.col("rank") <= negatives)
    positive = asked.select("anchor_id", F.posexplode("asked").alias("window", "positive"))
    return far.join(positive, ["anchor_id", "window"]).select(
        "anchor_id", F.col("positive.id").alias("positive_id"), F.col("rank").cast("int"), F.col("id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"), F.col("score").alias("negative_score"),
    )
