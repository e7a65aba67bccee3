"""Toxicity: a convolutional text classifier trained in numpy inside tasks, with thresholds calibrated by language.

Words are embedded by hashing: a word's vector is the sum of the rows that its letters, its first
seven and its first four letters hash to. Filters of several widths run over the word vectors, each
keeps its maximum over the whole text, and a logistic layer joins them. ``train`` learns from every
labelled row: four fifths fit the model, by rounds in which each task goes through its own rows and the
tasks' models are averaged, an embedding row by how often each task moved it. The last fifth, which the
fit has not seen, gives each language its threshold: tasks count all its rows by language and raw score,
and scores are shifted so that every threshold lies at ``CUT``. The language is guessed from the function
words of the text itself; no column but the text enters a score.

The driver gets one model a round, and counts on a fixed grid of raw scores, whatever the number of rows.
A task holds a chunk of texts of ``CHUNK_CHARS`` characters, or one longer text.

Texts are scored whole, in any partition alone. Null and empty texts get the score of no words. Ids pass
through, null and repeated ones too, and every row of a labelled id is learnt from; an empty table gives an
empty result, and labels without both classes give a model that scores 0 everywhere.
"""

from __future__ import annotations

import copy
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import text_of
from tidemark.session import checkpoint_root, remove, scratch_path

ROWS, DIM, WIDTHS, FILTERS = 1 << 16, 16, (1, 2, 3), 16
#: Hashed parts of a word: all its letters, and its first seven and four.
PARTS = ((64, None), (7, 7), (4, 4))
EPOCHS, BATCH, RATE = 8, 32, 0.08
#: Rounds of training, times that a task goes through its rows in a round; together ``EPOCHS``.
ROUNDS, PASSES = 2, 4
#: One labelled row in so many calibrates.
CALIBRATE = 5
#: Characters of the texts that a task learns from together, and for which there is a task at least.
CHUNK_CHARS = 1 << 24
#: Embedding rows that are averaged together, and the number of the block of all other parameters.
BLOCK, DENSE = 1024, -1
#: Raw scores are counted in steps of 1 / ``GRID``, up to ``MOST`` on each side.
GRID, MOST = 1024, 64
#: Bits that tell which documents have no label before any text is shuffled.
BITS = 1 << 24
#: The score at which the calibrated thresholds lie.
CUT = 0.7
#: Positives that a language needs for a threshold of its own.
LEAST = 8
#: Frequent function words that tell the languages apart.
FUNCTION_WORDS = {
    "en": "the of and to in that is was for it with as on be at by this are from or an not have which but",
    "de": "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er",
    "fr": "le la les des et du une est dans que qui pour pas au sur par plus avec ce il sont aux ou son se",
    "es": "el los las del y que en por con una su para es al lo como más pero sus le ya o fue este ha",
}
_EDGES = "".join(chr(c) for c in range(0x80) if not chr(c).isalnum())
_PAD = max(WIDTHS) - 1
CHUNK = 1 << 15


def _language_of() -> dict[str, int]:
    owners: dict[str, list[int]] = {}
    for k, listed in enumerate(FUNCTION_WORDS.values()):
        for w in listed.split():
            owners.setdefault(w, []).append(k)
    return {w: ks[0] for w, ks in owners.items() if len(ks) == 1}


_LANGUAGE_OF = _language_of()


class Words:
    """The words of some texts: distinct ones, their hashed rows, and the texts as numbers."""

    def __init__(self, texts: Sequence[str]):
        number: defaultdict[str, int] = defaultdict(count().__next__)
        number[""]  # the blank is number 0
        self.texts = [np.array(list(map(number.__getitem__, t.lower().split())), np.int64) for t in texts]
        bare = [w.strip(_EDGES) for w in number]
        whole = [w.encode() for w in bare]
        self.rows = np.empty((len(bare), len(PARTS)), np.int64)
        for k, (n, end) in enumerate(PARTS):
            seed = crc32(str(n).encode())
            parts = whole if end is None else [x[:end] if len(x) == len(w) else w[:end].encode() for w, x in zip(bare, whole)]
            self.rows[:, k] = np.fromiter((crc32(x, seed) for x in parts), np.int64, len(parts)) % ROWS
        self.rows[[not w for w in bare]] = ROWS
        self.language = np.fromiter((_LANGUAGE_OF.get(w, -1) for w in bare), np.int64, len(bare))

    def guess(self) -> np.ndarray:
        """Number of the language with the most function words; as many as there are languages for none."""
        out = []
        for ids in self.texts:
            seen = self.language[ids]
            votes = np.bincount(seen[seen >= 0], minlength=len(FUNCTION_WORDS))
            out.append(int(votes.argmax()) if votes.any() else len(FUNCTION_WORDS))
        return np.array(out, np.int64)


def _padded(ids: np.ndarray) -> np.ndarray:
    """The numbers of a text's words with blanks behind, so that each word begins a window; no words are one blank."""
    return np.concatenate([ids, np.zeros(_PAD + (not len(ids)), np.int64)])


def _convolved(products: np.ndarray) -> np.ndarray:
    """What all filters give at each place, from ``Model.products`` of a text's words; ``WIDTHS`` grow."""
    n, at = len(products) - _PAD, FILTERS * len(WIDTHS)
    out = products[:n, :at].copy()
    for j in range(1, max(WIDTHS)):
        width = FILTERS * sum(w > j for w in WIDTHS)
        out[:, -width:] += products[j : j + n, at : at + width]
        at += width
    return out


@dataclass
class Model:
    embed: np.ndarray  # (ROWS + 1, DIM), the last row stays 0
    filters: list[np.ndarray]  # per width: (width, DIM, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    constant: float
    thresholds: np.ndarray  # a logit per language, then the one for none

    @classmethod
    def start(cls) -> Model:
        rng = np.random.default_rng(11)
        embed = rng.normal(0, 0.1, (ROWS + 1, DIM)).astype(np.float32)
        embed[ROWS] = 0
        filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        total = FILTERS * len(WIDTHS)
        return cls(embed, filters, np.zeros(total, np.float32), rng.normal(0, 0.3, total).astype(np.float32), 0.0, np.zeros(len(FUNCTION_WORDS) + 1))

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        """Word vectors: the sums of their hashed rows."""
        return sum(self.embed[rows[:, k]] for k in range(1, rows.shape[1])) + self.embed[rows[:, 0]]

    def products(self, vectors: np.ndarray) -> np.ndarray:
        """Products of word vectors with all filters: those of the filters' first places, then of the second ones, and so on."""
        return vectors @ np.concatenate([f[j] for j in range(max(WIDTHS)) for f in self.filters if j < len(f)], 1)

    def logits(self, words: Words) -> np.ndarray:
        """Raw scores: the products of distinct words with all filters are made once and gathered."""
        products = self.products(self.vectors(words.rows))
        pooled = np.empty((len(words.texts), FILTERS * len(WIDTHS)), np.float32)
        for k, ids in enumerate(words.texts):
            padded = _padded(ids)
            best = None
            for at in range(0, len(padded) - _PAD, CHUNK):
                top = _convolved(products[padded[at : at + CHUNK + _PAD]]).max(0)
                best = top if best is None else np.maximum(best, top)
            pooled[k] = best
        return np.maximum(pooled + self.bias, 0) @ self.out + self.constant

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        words = Words(texts)
        shifted = self.logits(words).astype(np.float64) - self.thresholds[words.guess()] + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(shifted, -40, 40)))


class Learner:
    """Filters, embeddings and output by Adagrad on the logistic loss."""

    def __init__(self, model: Model, seen: list[np.ndarray] | None = None):
        self.model = model
        self.params = [model.embed, *model.filters, model.bias, model.out]
        self.seen = [np.full_like(p, 1e-3) for p in self.params] if seen is None else seen[:-1]
        self.seen_constant = 1e-3 if seen is None else float(seen[-1][0])
        self.moved, self.rows = np.zeros(ROWS + 1, np.int64), 0

    @classmethod
    def resumed(cls, state: tuple[Model, list[np.ndarray]]) -> Learner:
        """One that goes on from ``state`` and leaves it as it is."""
        return cls(*copy.deepcopy(state))

    def state(self) -> tuple[Model, list[np.ndarray]]:
        return self.model, [*self.seen, np.array([self.seen_constant], np.float32)]

    def _step(self, k: int, grad: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        self.seen[k][rows] += grad * grad
        self.params[k][rows] -= RATE * grad / np.sqrt(self.seen[k][rows])

    def learn(self, words: Words, y: np.ndarray, weight: np.ndarray, passes: int, rng: np.random.Generator) -> None:
        self.rows += len(y)
        place = np.zeros(len(words.rows), np.int64)
        for _ in range(passes):
            order = rng.permutation(len(y))
            for first in range(0, len(y), BATCH):
                some = order[first : first + BATCH]
                self._learn_batch(words, some, y[some], weight[some], place)

    def _learn_batch(self, words: Words, some: np.ndarray, y: np.ndarray, weight: np.ndarray, place: np.ndarray) -> None:
        """One step. The batch's distinct words meet the filters once; ``place`` is scratch, 0 for every word before and after."""
        model = self.model
        padded = [_padded(words.texts[k]) for k in some]
        tokens = np.concatenate(padded)
        place[tokens] = 1
        distinct = np.flatnonzero(place)
        place[distinct] = np.arange(len(distinct))
        hashed = words.rows[distinct]
        vectors = model.vectors(hashed)
        products, tokens = model.products(vectors), place[tokens]
        place[distinct] = 0
        pooled = np.empty((len(some), FILTERS * len(WIDTHS)), np.float32)
        best = np.empty(pooled.shape, np.int64)  # the token where each filter is largest
        begin, columns = 0, np.arange(pooled.shape[1])
        for r, ids in enumerate(padded):
            conv = _convolved(products[tokens[begin : begin + len(ids)]])
            at = conv.argmax(0)
            pooled[r], best[r] = conv[at, columns], begin + at
            begin += len(ids)
        hidden = np.maximum(pooled + model.bias, 0)
        p = 1 / (1 + np.exp(-np.clip(hidden @ model.out + model.constant, -30, 30)))
        error = ((p - y) * weight / len(some)).astype(np.float32)
        back = (error[:, None] * model.out) * (hidden > 0)
        filter_grads, rows, grads = [np.zeros_like(f) for f in model.filters], [], []
        for f, filt in enumerate(model.filters):
            g, at = (x[:, f * FILTERS : (f + 1) * FILTERS] for x in (back, best))
            moved = g != 0
            for j in range(len(filt)):
                there = tokens[at + j]
                filter_grads[f][j] = np.einsum("bcd,bc->dc", vectors[there], g)
                rows.append(hashed[there[moved]])
                grads.append((filt[j].T * g[:, :, None])[moved])
        at_rows = np.concatenate(rows).ravel()
        if len(at_rows):
            by_row = np.argsort(at_rows, kind="stable")
            ordered = at_rows[by_row]
            starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
            touched = ordered[starts]
            total = np.add.reduceat(np.concatenate(grads)[by_row // len(PARTS)], starts, axis=0)
            total[touched == ROWS] = 0
            self._step(0, total, touched)
            self.moved[touched] += 1
        for f, g in enumerate(filter_grads):
            self._step(1 + f, g)
        self._step(len(self.params) - 2, back.sum(0))
        self._step(len(self.params) - 1, hidden.T @ error)
        self.seen_constant += float(error.sum()) ** 2
        model.constant -= RATE * float(error.sum()) / self.seen_constant**0.5

    def dense(self) -> tuple[np.ndarray, np.ndarray]:
        """All parameters but the embeddings in one row each: values and what Adagrad has seen of them."""
        ends = [np.array([self.model.constant]), np.array([self.seen_constant])]
        return tuple(np.concatenate([*[x.ravel() for x in some[1:]], end]).astype(np.float32) for some, end in zip((self.params, self.seen), ends))

    def blocks(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(block, places in it, their weights, values, seen) of what has moved."""
        value, seen = self.dense()
        yield DENSE, np.array([0]), np.array([self.rows]), value[None], seen[None]
        at = np.flatnonzero(self.moved[:ROWS])
        for block in np.unique(at // BLOCK):
            mine = at[at // BLOCK == block]
            yield int(block), mine - block * BLOCK, self.moved[mine], self.params[0][mine], self.seen[0][mine]

    def put(self, block: int, places: np.ndarray, value: np.ndarray, seen: np.ndarray) -> None:
        if block != DENSE:
            self.params[0][block * BLOCK + places], self.seen[0][block * BLOCK + places] = value, seen
            return
        for some, flat in ((self.params, value[0]), (self.seen, seen[0])):
            begin = 0
            for x in some[1:]:
                x[...] = flat[begin : begin + x.size].reshape(x.shape)
                begin += x.size
        self.model.constant, self.seen_constant = float(value[0, -1]), float(seen[0, -1])


def class_weights(clean: int, toxic: int) -> np.ndarray:
    """Weights of a row of either class, so that both classes weigh the same."""
    return np.array([(clean + toxic) / max(2 * clean, 1), (clean + toxic) / max(2 * toxic, 1)])


def fit(texts: Sequence[str], toxic: Sequence[int], epochs: int = EPOCHS) -> Model:
    """A model of these texts alone, in the calling process."""
    model, y = Model.start(), np.array(toxic, np.float32)
    weight = class_weights(int((1 - y).sum()), int(y.sum()))[y.astype(int)]
    Learner(model).learn(Words(texts), y, weight, epochs, np.random.default_rng(5))
    return model


def best_threshold(logits: np.ndarray, toxic: np.ndarray, times: np.ndarray | None = None) -> float:
    """The middle of the widest gap among the cuts with the best F1; a logit may stand for ``times`` rows, ``toxic`` of them toxic."""
    times = np.ones(len(logits), np.int64) if times is None else times
    order = np.argsort(-logits, kind="stable")
    x, y = logits[order], toxic[order]
    hits = np.cumsum(y)
    f1 = 2 * hits / (np.cumsum(times[order]) + y.sum())
    below = np.append(x[1:], x[-1] - 2)
    usable = np.flatnonzero((f1 >= f1[below < x].max() - 1e-9) & (below < x))
    k = usable[np.argmax((x - below)[usable])]
    return float((x[k] + below[k]) / 2)


def set_thresholds(model: Model, guess: np.ndarray, logits: np.ndarray, toxic: np.ndarray, times: np.ndarray) -> None:
    """A threshold for each language that has enough positives, the common one for the others."""
    if not toxic.sum():
        return
    model.thresholds[:] = best_threshold(logits, toxic, times)
    for k in range(len(FUNCTION_WORDS)):
        mine = guess == k
        if toxic[mine].sum() >= LEAST and (times - toxic)[mine].sum() >= LEAST:
            model.thresholds[k] = best_threshold(logits[mine], toxic[mine], times[mine])


def calibrate(model: Model, texts: Sequence[str], toxic: Sequence[int]) -> None:
    """Thresholds from these texts alone."""
    words, y = Words(texts), np.array(toxic)
    set_thresholds(model, words.guess(), model.logits(words), y, np.ones(len(y), np.int64))


def _labelled(docs: DataFrame, known: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, toxic) of every row of a labelled id, in partitions of about ``CHUNK_CHARS`` characters.

    A bitmap of the labels' hashed ids, of at most ``BITS`` bits, keeps most texts without a label out of the
    shuffle; the join after it is exact.
    """
    def place(c: str) -> Column:
        return F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(BITS))

    spread = known.select(place("key").alias("at")).withColumn("bucket", F.bitmap_bucket_number("at")).repartition("bucket")
    bits = spread.groupBy("bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    rows = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text")).withColumn("at", place("id"))
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.bitmap_bit_position("at") / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    bit = F.floor(byte / F.pow(F.lit(2), F.bitmap_bit_position("at") % 8)) % 2
    # At most BITS / 8 bytes are broadcast.
    likely = rows.withColumn("bucket", F.bitmap_bucket_number("at")).join(F.broadcast(bits), "bucket").filter(bit == 1).select("id", "text")
    chars = likely.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // CHUNK_CHARS))
    return likely.repartition(n, "id").join(known.repartition(n, "key"), F.col("id") == F.col("key")).select("id", "text", "toxic")


def _round(rows: DataFrame, learner: Learner, weights: np.ndarray, seed: int, passes: int) -> None:
    """Every task goes on from the learner with its own rows; the learner takes their mean."""
    shared = rows.sparkSession.sparkContext.broadcast(learner.state())  # of fixed size
    schema = "block int, part int, places binary, weight binary, value binary, seen binary"

    def fit_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, texts, toxic, chars = TaskContext.get().partitionId(), [], [], 0
        mine, rng = Learner.resumed(shared.value), np.random.default_rng([5, seed, part])

        def learn() -> None:
            y = np.array(toxic, np.float32)
            mine.learn(Words(texts), y, weights[y.astype(int)], passes, rng)
            texts.clear()
            toxic.clear()

        for batch in batches:
            for text, t in zip(batch.column(0), batch.column(1).to_pylist()):
                texts.append(text.as_py())
                toxic.append(t)
                chars += len(texts[-1])
                if chars >= CHUNK_CHARS:
                    learn()
                    chars = 0
        if texts:
            learn()
        if mine.rows:
            for block, places, weight, value, seen in mine.blocks():
                packed = [places.astype("<i4"), weight.astype("<f8"), value.astype("<f4"), seen.astype("<f4")]
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in packed]], names=["block", "part", "places", "weight", "value", "seen"])

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, None

        def out() -> pa.RecordBatch:
            places = np.flatnonzero(sums[0])
            values = [(x[places] / sums[0][places, None]).astype("<f4").tobytes() for x in sums[1:]]
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), *[pa.array([x], pa.binary()) for x in (places.astype("<i4").tobytes(), *values)]], names=["block", "places", "value", "seen"])

        for batch in batches:
            for block, _, *packed in zip(*(c.to_pylist() for c in batch.columns)):
                places, weight, value, seen = (np.frombuffer(x, t) for x, t in zip(packed, ("<i4", "<f8", "<f4", "<f4")))
                value, seen = value.reshape(len(places), -1), seen.reshape(len(places), -1)
                if block != now:
                    if now is not None:
                        yield out()
                    size = 1 if block == DENSE else BLOCK
                    now, sums = block, (np.zeros(size), np.zeros((size, value.shape[1])), np.zeros((size, value.shape[1])))
                sums[0][places] += weight
                sums[1][places] += weight[:, None] * value
                sums[2][places] += weight[:, None] * seen
        if now is not None:
            yield out()

    fitted = rows.select("text", "toxic").mapInArrow(fit_part, schema)
    n = min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), ROWS // BLOCK + 1)
    means = fitted.repartition(n, "block").sortWithinPartitions("block", "part").mapInArrow(mean, "block int, places binary, value binary, seen binary")
    for r in means.collect():  # at most one model
        places = np.frombuffer(r.places, "<i4")
        learner.put(r.block, places, *(np.frombuffer(x, "<f4").reshape(len(places), -1) for x in (r.value, r.seen)))


def _counted(rows: DataFrame, model: Model) -> list[tuple[int, int, int, int]]:
    """(language, raw score in grid steps, rows, toxic ones) over all ``rows``; bounded by languages and grid."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 1024):
                batch = whole.slice(first, 1024)
                words = Words(batch.column(0).to_pylist())
                cells = np.round(np.clip(shared.value.logits(words), -MOST, MOST) * GRID).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(words.guess()), pa.array(cells), batch.column(1).cast(pa.int64())], names=["language", "cell", "toxic"])

    cells = rows.select("text", "toxic").mapInArrow(cells_of, "language bigint, cell bigint, toxic bigint")
    return cells.groupBy("language", "cell").agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).orderBy("language", "cell").collect()


def train(
    docs: DataFrame, labels: DataFrame, may_learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    rounds: int = ROUNDS, passes: int = PASSES,
) -> Model | None:
    """A calibrated model from all labelled rows.

    ``may_learn`` limits the labels that are used. A document with several labels has the largest one.
    None where the rows to fit lack a class.
    """
    spark = docs.sparkSession
    checkpoint_root(spark)
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    if may_learn is not None:
        known = known.filter(may_learn)
    known = known.groupBy(id_col).agg(F.max(label_col).alias("toxic")).select(F.col(id_col).alias("key"), F.col("toxic").cast("int").alias("toxic"))
    draw = F.floor(F.crc32(F.col("id").cast("string").cast("binary")) / 3) % CALIBRATE
    path = scratch_path(spark, "toxicity")
    _labelled(docs, known, id_col, text_col).select("text", "toxic", (draw == 0).alias("held")).write.parquet(path)
    staged = spark.read.parquet(path)
    sizes = {(r.held, r.toxic): r["count"] for r in staged.groupBy("held", "toxic").count().collect()}
    clean, toxic = (sizes.get((False, t), 0) for t in (0, 1))
    if not clean or not toxic:
        remove(spark, [path])
        return None
    learner = Learner(Model.start())
    for k in range(rounds):
        _round(staged.filter("not held"), learner, class_weights(clean, toxic), k, passes)
    # Too few positives to calibrate apart: all rows do.
    held = staged if sizes.get((True, 1), 0) < LEAST else staged.filter("held")
    language, cell, n, hits = (np.array(c, np.int64) for c in zip(*_counted(held, learner.model)))
    set_thresholds(learner.model, language, cell / GRID, hits, n)
    remove(spark, [path])
    return learner.model


def score_documents(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``score``, from 0 to 1, higher where toxic is likelier; ``CUT`` parts the classes."""
    rows = docs.select(docs[id_col], text_of(docs, text_col).alias("text"))
    if model is None:
        return rows.select(id_col, F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: ROWS x DIM numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 1024):
                batch = whole.slice(first, 1024)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(batch.column(1).to_pylist()), pa.float64())], names=[id_col, "score"])

    return rows.mapInArrow(score, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, score double")
