"""Mixing sources to target weights along a time-varying curriculum.

Targets: the mix takes ``share`` of all words. Each source gets its weight's part, no more than ``cap``
times its size; the excess is shared again by weight until no source is above. In the order of
cap x size / weight the capped sources come first, so two running sums over the sources settle it.

Curriculum: a source's schedule says how strongly it is wanted at each moment of the training, from
0 to 1. Its integral, scaled to the target, is the cumulative demand for the source's words. The
documents of a source stand in an order given by a hash, one pass after another; each copy covers the
stretch from its first to its last word, and the moment when the demand reaches the middle of that
stretch is its training position. Copies end where the target ends, and the copy across the end counts
only as far as the target goes. Copies sorted by position are the training order: they are range-sorted and
staged, each with the words of the training before it, and what the mix takes is read from there.

Steps: the training is ``STEPS`` steps of equal length. In a step, every source gives the words that its
cumulative demand passes between the step's begin and its end; a copy gives those of its stretch that lie
there. What the mix takes of a document is the sum over its copies and the steps of the curriculum.

Word counts, ranks and running sums are taken over all rows: running sums go over range partitions of
(source, hash), so a source of any size is spread over many tasks, and only the row counts of
partitions are joined back. Null sources are one source, last in order; null texts have no words. Rows
that share id and text stand side by side in the order. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import fresh, let, text_of
from tidemark.operators.ordinal import running
from tidemark.session import checkpoint_root, remove, scratch_path

#: Fixed values of the mix: weights by rank of the source, repeating, share of all words, cap.
WEIGHTS, SHARE, CAP = (3, 1, 2), 1.5, 2
#: Relative weight at moments of the training, by rank of the source, repeating: fading, even, growing.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)))
SEED = "mix"
#: Steps of the training in which words are taken.
STEPS = 16


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text."""
    flat = F.btrim(F.translate(text, "\t\n\x0b\x0c\r", "     "), F.lit(" "))
    return F.when(flat == "", 0).otherwise(F.size(F.split(flat, " +"))).cast("long")


def _pick(values: Sequence, rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (rank % len(values) + 1).cast("int"))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Per source (``src_null``, ``src``): ``source_size``, ``rank``, ``before`` (words of sources of lower rank) and ``target``.

    ``sizes`` has src_null, src and size per document.
    """
    sources = sizes.groupBy("src_null", "src").agg(F.sum("size").alias("source_size"))
    ranked = running(sources, ["src_null", "src"], sums={"upto": F.col("source_size")}, ordinal="rank")
    ranked = ranked.withColumn("weight", _pick([float(w) for w in weights], F.col("rank"))).withColumn("full", F.col("source_size") * float(cap))
    ranked = ranked.withColumn("ratio", F.col("full") / F.col("weight"))
    poured = running(ranked, ["ratio", "rank"], sums={"full_upto": F.col("full"), "weight_upto": F.col("weight")}, ordinal=None).checkpoint()
    total = poured.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    words, all_weight = float(total.words or 0), float(total.weight or 0)
    level = (F.lit(share * words) - (F.col("full_upto") - F.col("full"))) / (F.lit(all_weight) - (F.col("weight_upto") - F.col("weight")))
    levelled = poured.withColumn("level", level)
    # The first source that its weight's part does not fill sets the level for all after it.
    free = levelled.filter("level <= ratio").orderBy("ratio", "rank").select("level", "ratio", "rank").first()
    if free is None:
        target = F.col("full")
    else:
        capped = (F.col("ratio") < free.ratio) | ((F.col("ratio") == free.ratio) & (F.col("rank") < free["rank"]))
        target = F.when(capped, F.col("full")).otherwise(F.lit(free.level) * F.col("weight"))
    return poured.select("src_null", "src", "source_size", "rank", (F.col("upto") - F.col("source_size")).alias("before"), target.alias("target")).checkpoint()


def demanded(at: float, schedule: Sequence[tuple[float, float]]) -> float:
    """The part (0 to 1) of the schedule's integral that lies before the moment ``at``; exactly 1 at its end."""
    whole = before = 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        whole += (t1 - t0) * (w0 + w1) / 2
        x = min(max(at - t0, 0.0), t1 - t0)
        before += x * w0 + x * x * (w1 - w0) / (t1 - t0) / 2
    return 1.0 if at >= schedule[-1][0] else before / whole


def moment(part: Column, schedule: Sequence[tuple[float, float]]) -> Column:
    """When the schedule's integral reaches ``part`` (0 to 1) of its whole: the inverse of the cumulative demand."""
    area = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:])]
    whole, done, out = sum(area), 0.0, None
    for (t0, w0), (t1, w1), piece in zip(schedule, schedule[1:], area):
        rest = F.greatest(part * whole - done, F.lit(0.0))
        slope = (w1 - w0) / (t1 - t0)
        # w0 x + slope x^2 / 2 = rest, in the form that also holds for slope 0.
        at = F.least(t0 + 2 * rest / (w0 + F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * rest, F.lit(0.0)))), F.lit(t1))
        done += piece
        out = F.when(part * whole <= done, at) if out is None else out.when(part * whole <= done, at)
    return out.otherwise(F.lit(schedule[-1][0]))


def placed(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """Per row: its number ``row``, ``id``, ``key`` (hash of id and text), ``size``, ``source_size``, ``target``, ``rank``, ``begin`` and ``copies``.

    ``rank`` is that of the source, ``begin`` the words of the source before the row, ``copies`` has (pass, taken,
    position) of each copy that the mix takes words from. The texts are read once; what is shuffled has a
    fixed width per row.
    """
    spark = docs.sparkSession
    checkpoint_root(spark)
    text, path = text_of(docs, text_col), scratch_path(spark, "mix")
    docs.select(
        docs[id_col].alias("id"),
        F.isnull(docs[source_col]).cast("int").alias("src_null"),
        F.coalesce(docs[source_col].cast("string"), F.lit("")).alias("src"),
        F.md5(F.concat_ws(":", F.lit(SEED), docs[id_col].cast("string"))).alias("h"),
        F.md5(text).alias("text_hash"),
        word_count(text).alias("size"),
    ).write.parquet(path)
    sizes = spark.read.parquet(path)
    by_source = targets(sizes, weights, share, cap)
    rows = sizes.join(by_source, ["src_null", "src"])
    rows = running(rows, ["rank", "h", "text_hash", "id", "size"], sums={"upto": F.col("size")}, ordinal="row")
    remove(spark, [path])  # the running sums stand on a checkpoint
    rows = rows.withColumn("begin", F.col("upto") - F.col("size") - F.col("before"))
    end = F.round("target").cast("long")
    schedule = (F.col("rank") % len(schedules)).cast("int")

    def position(middle: Column) -> Column:
        part = F.least(middle / F.greatest(F.col("target"), F.lit(1e-9)), F.lit(1.0))
        out = F.when(schedule == 0, moment(part, schedules[0]))
        for k, s in enumerate(schedules[1:], 1):
            out = out.when(schedule == k, moment(part, s))
        return out

    copies = []
    for k in range(int(-(-cap // 1))):
        first = F.col("begin") + k * F.col("source_size")
        words = F.greatest(F.least(end - first, F.col("size")), F.lit(0))
        copies.append(F.struct(F.lit(k).alias("pass"), words.alias("taken"), position(first + words / 2.0).alias("position")))
    return rows.select(
        "row", "id", F.concat("h", "text_hash").alias("key"), "size", "source_size", "target", "rank", "begin",
        F.filter(F.array(*copies), lambda c: c["taken"] > 0).alias("copies"),
    )


def training_sequence(plan: DataFrame) -> DataFrame:
    """The copies of ``placed`` in training order, staged: ``row``, ``key``, ``pass``, ``taken``, ``position``, ``since`` and what their steps rest on.

    ``since`` is the number of words that the training takes before the copy.
    """
    copies = plan.select("row", "key", "rank", "source_size", "target", "begin", F.explode("copies").alias("copy")).select("*", "copy.*").drop("copy")
    ordered = running(copies, ["position", "key", "pass", "row"], sums={"until": F.col("taken")}, ordinal=None)
    return ordered.withColumn("since", F.col("until") - F.col("taken")).drop("until").checkpoint()


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    steps: int = STEPS,
) -> DataFrame:
    """Per row: id, ``key`` (hash of id and text), ``size``, ``source_size``, ``target``, ``taken``, ``copies`` and ``by_step``.

    ``copies`` has (pass, taken, position, since) of each copy in the training sequence, ``by_step`` the words that
    each step of the training takes, and ``taken`` is their sum. All three are read from the staged sequence.
    """
    plan = placed(docs, weights, share, cap, schedules, id_col, text_col, source_col)
    sequence = training_sequence(plan)
    # The words that each source has given when a step ends; the last step ends with the whole target.
    parts = F.array(*[F.array(*[F.lit(demanded((k + 1) / steps * s[-1][0], s)) for k in range(steps)]) for s in schedules])
    given = F.transform(F.get(parts, (F.col("rank") % len(schedules)).cast("int")), lambda part: F.round(F.col("target") * part).cast("long"))
    first = F.col("begin") + F.col("pass") * F.col("source_size")

    def step(ends: Column) -> Column:
        def words(until: Column, k: Column) -> Column:
            before = F.coalesce(F.get(ends, k - 1), F.lit(0))
            return F.greatest(F.least(until, first + F.col("taken")) - F.greatest(before, first), F.lit(0)).cast("long")

        return F.transform(ends, words)

    of_row = sequence.withColumn("steps", let(given, step)).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("pass", "taken", "position", "since"))).alias("copies"),
        F.array(*[F.sum(F.get("steps", F.lit(k))) for k in range(steps)]).alias("by_step"),
    )
    by_step = F.coalesce("by_step", F.array_repeat(F.lit(0).cast("long"), steps))
    mixed = plan.drop("copies").join(of_row, "row", "left").withColumn("by_step", by_step)
    taken = F.aggregate("by_step", F.lit(0).cast("long"), lambda a, words: a + words)
    copies = F.coalesce("copies", F.array().cast(of_row.schema["copies"].dataType))
    return mixed.select(F.col("id").alias(id_col), "key", "size", "source_size", "target", taken.alias("taken"), copies.alias("copies"), "by_step")


def training_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, range-sorted by training position.

    Documents stay whole: a copy that the target cuts is in if the mix takes at least half of it.
    Rows that share id and text get the same copies.
    """
    spark = docs.sparkSession
    key, at, turn = fresh(docs, "mix_key", "mix_position", "mix_pass")
    plan = placed(docs, id_col=id_col, text_col=text_col, **options)
    copies = (
        plan.withColumn("copies", F.filter("copies", lambda c: 2 * c["taken"] >= F.col("size")))
        .groupBy("key").agg(F.max("copies").alias("copies"))
    )
    keyed = docs.withColumn(key, F.concat(F.md5(F.concat_ws(":", F.lit(SEED), docs[id_col].cast("string"))), F.md5(text_of(docs, text_col))))
    rows = keyed.join(copies.filter(F.size("copies") > 0).select(F.col("key").alias(key), F.col("copies").alias(at)), key)
    rows = rows.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(key), F.explode(at).alias(at))
    rows = rows.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(key), F.col(f"{at}.position").alias(at), F.col(f"{at}.pass").alias(turn))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(n, at, key, turn).sortWithinPartitions(at, key, turn).drop(key, at, turn)
