"""Keyed merge of a change batch into stored rows.

``latest_per_key`` keeps one change per key with a hash/sort aggregate (``max_by`` over an
ordering struct). The aggregate runs partially on the map side, so a key that holds a third of
a batch is reduced to one row per map task before the shuffle.

``merge_latest`` joins the stored rows once with the orderings of the batch: stored rows that the
batch does not beat stay, the keys of those are stale in the batch, and the other changes of the
batch are added unless they delete. When the batch is small (a checked size) its side is
broadcast and the stored rows are only streamed, never shuffled.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tidemark.spec import ARRIVAL, EVENT_ORDER, EVENT_TIME, OP_DELETE, UPSERT_THEN_DELETE

TOMBSTONE = "_deleted"
# Latest ordering of a key's changes in the batch, where the winning row is not the latest one.
BATCH_ORDER = "_batch_order"

# Rank of an operation when ordering values tie: a delete beats an update, an update beats an
# insert, an insert beats a snapshot row.
OP_RANK = {"D": 3, "U": 2, "I": 1, "R": 0}


def op_rank(op: Column | None = None) -> Column:
    op = F.col("op_type") if op is None else op
    e = F.lit(-1)
    for code, rank in OP_RANK.items():
        e = F.when(op == code, F.lit(rank)).otherwise(e)
    return e


def ordering_struct(
    ordering: Sequence[str], prefix: Sequence[Column] = (), tiebreak: Sequence[str] = (), last: Sequence[Column] = ()
) -> Column:
    parts = (
        list(prefix) + [F.col(f"`{c}`") for c in ordering] + [op_rank()] + [F.col(f"`{c}`") for c in tiebreak] + list(last)
    )
    return F.struct(*[p.alias(f"o{i}") for i, p in enumerate(parts)])


def _row_hash(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """A hash of the row's values: the last tie-break, so that equal ordering values still pick the
    same row on every recomputation (a retried task must not choose differently)."""
    hashable = [c for c in cols if "map<" not in df.schema[c].dataType.simpleString()]
    return [F.xxhash64(*[F.col(f"`{c}`") for c in hashable])] if hashable else []


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    ordering: Sequence[str] = ("current_ts", "op_ts"),
    deletes_win: bool = False,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the greatest ``(ordering..., op rank, tiebreak...)``.

    ``deletes_win`` puts "is a delete" in front of the ordering: any delete of the key in the batch
    beats every upsert (upsert-then-delete semantics).
    """
    keys = list(keys)
    ordering = [c for c in ordering if c in df.columns]
    payload = [c for c in df.columns if c not in keys]
    prefix = [(F.col("op_type") == OP_DELETE).cast("int")] if deletes_win else []
    order = ordering_struct(ordering, prefix, [t for t in tiebreak if t in df.columns], _row_hash(df, payload))
    cols = df.columns
    # Upserts that lose to a delete of the batch still say how late the batch is for the key.
    latest = [F.max(ordering_struct(ordering)).alias(BATCH_ORDER)] if deletes_win and ordering else []
    out = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in payload]), order).alias("_row"), *latest
    )
    return out.select(
        *[F.col(f"`{k}`") for k in keys], *[F.col("_row").getField(c).alias(c) for c in payload], *[BATCH_ORDER for _ in latest]
    ).select(*[f"`{c}`" for c in cols], *[BATCH_ORDER for _ in latest])


# Implicit widenings allowed when a batch brings a narrower type than the stored column.
_WIDEN: dict[type, tuple[type, ...]] = {
    LongType: (ByteType, ShortType, IntegerType),
    IntegerType: (ByteType, ShortType),
    ShortType: (ByteType,),
    DoubleType: (FloatType, ByteType, ShortType, IntegerType, LongType),
    TimestampType: (DateType, TimestampNTZType),
}
_WHOLE_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


def common_type(stored: DataType, incoming: DataType, name: str) -> DataType:
    """The stored type, with the fields that an incoming struct has more (also inside arrays and maps).

    Incoming atomic values must fit the stored type: narrower numbers, and decimals with as many whole and
    decimal places at most. Anything else is an error, since stored files are not rewritten."""
    if isinstance(stored, StructType) and isinstance(incoming, StructType):
        theirs = {f.name: f for f in incoming.fields}
        fields = [StructField(f.name, common_type(f.dataType, theirs[f.name].dataType, f"{name}.{f.name}") if f.name in theirs else f.dataType) for f in stored.fields]
        have = {f.name for f in stored.fields}
        return StructType(fields + [StructField(f.name, f.dataType) for f in incoming.fields if f.name not in have])
    if isinstance(stored, ArrayType) and isinstance(incoming, ArrayType):
        return ArrayType(common_type(stored.elementType, incoming.elementType, f"{name}[]"))
    if isinstance(stored, MapType) and isinstance(incoming, MapType):
        return MapType(common_type(stored.keyType, incoming.keyType, f"{name} key"), common_type(stored.valueType, incoming.valueType, f"{name} value"))
    if stored.simpleString() == incoming.simpleString() or isinstance(incoming, NullType) or type(incoming) in _WIDEN.get(type(stored), ()):
        return stored
    if isinstance(stored, DecimalType):
        whole, places = (incoming.precision - incoming.scale, incoming.scale) if isinstance(incoming, DecimalType) else (_WHOLE_DIGITS.get(type(incoming), 99), 0)
        if whole <= stored.precision - stored.scale and places <= stored.scale:
            return stored
    raise ValueError(f"column {name!r}: batch type {incoming.simpleString()} cannot be merged into stored type {stored.simpleString()}")


def as_type(c: Column, have: DataType, want: DataType) -> Column:
    """A value of one type as another that ``common_type`` allows; fields are matched by name."""
    if have.simpleString() == want.simpleString():
        return c
    if isinstance(want, StructType) and isinstance(have, StructType):
        mine = {f.name: f.dataType for f in have.fields}
        fields = [(as_type(c.getField(f.name), mine[f.name], f.dataType) if f.name in mine else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(want, ArrayType) and isinstance(have, ArrayType):
        return F.transform(c, lambda x: as_type(x, have.elementType, want.elementType))
    if isinstance(want, MapType) and isinstance(have, MapType):
        keyed = F.transform_keys(c, lambda k, v: as_type(k, have.keyType, want.keyType))
        return F.transform_values(keyed, lambda k, v: as_type(v, have.valueType, want.valueType))
    return c.cast(want)


def _as_types(df: DataFrame, types: dict[str, DataType]) -> DataFrame:
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[as_type(F.col(f"`{c}`"), t, types[c]).alias(c) if c in types else F.col(f"`{c}`") for c, t in have.items()])


def reconcile(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Batch columns as the types that stored and batch rows share; what does not fit is an error."""
    return _as_types(incoming, _common(stored, incoming))


def _common(stored: DataFrame, incoming: DataFrame) -> dict[str, DataType]:
    mine = {f.name: f.dataType for f in stored.schema.fields}
    return {f.name: common_type(mine[f.name], f.dataType, f.name) for f in incoming.schema.fields if f.name in mine}


def align(stored: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the types that they share: the batch's casts, the stored rows' new fields as null."""
    types = _common(stored, incoming)
    return _as_types(stored, types), _as_types(incoming, types)


# ---------------------------------------------------------------- a merge in steps, for stored tables


def joining(side: DataFrame, broadcast: bool) -> DataFrame:
    """A join side that is broadcast, or never: the planner takes the compressed files of a batch for its size in memory."""
    return F.broadcast(side) if broadcast else side.hint("merge")


def matched(stored: DataFrame, latest: DataFrame, keys: Sequence[str], ordering: Sequence[str], more: Sequence[str], broadcast: bool) -> DataFrame:
    """(keys, ``_stored_ord``, ``_batch_ord``, more) of the stored rows whose key the batch has; reads no other column."""
    ordering = [c for c in ordering if c in stored.columns]
    side = latest.select(*[F.col(f"`{k}`") for k in keys], _batch_order(latest, ordering).alias("_batch_ord"))
    mine = stored.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keys, *more])], ordering_or_null(stored, ordering).alias("_stored_ord"))
    return mine.join(joining(side, broadcast), list(keys))


def ordering_or_null(df: DataFrame, ordering: Sequence[str]) -> Column:
    return ordering_struct(ordering) if ordering and "op_type" in df.columns else F.lit(None).cast("struct<o0:bigint>")


def _batch_order(latest: DataFrame, ordering: Sequence[str]) -> Column:
    if BATCH_ORDER in latest.columns:
        return F.col(BATCH_ORDER)
    return ordering_or_null(latest, [c for c in ordering if c in latest.columns])


def winning(latest: DataFrame, met: DataFrame, keys: Sequence[str], late_policy: str, broadcast: bool) -> DataFrame:
    """The changes that the stored rows do not beat, given what ``matched`` found."""
    winners = latest.drop(BATCH_ORDER)
    if late_policy != EVENT_TIME:
        return winners
    stale = met.filter(F.col("_stored_ord") > F.col("_batch_ord")).select(*[F.col(f"`{k}`") for k in keys])
    return winners.join(joining(stale, broadcast), list(keys), "left_anti")


def added_rows(winners: DataFrame, keep_tombstones: bool) -> DataFrame:
    """The rows that winning changes leave in the table."""
    winners, is_delete = winners.drop(BATCH_ORDER), F.col("op_type") == OP_DELETE
    return winners.withColumn(TOMBSTONE, is_delete) if keep_tombstones else winners.filter(~is_delete)


def replace_rows(scope: DataFrame, winners: DataFrame, keys: Sequence[str], keep_tombstones: bool, broadcast: bool) -> DataFrame:
    """Stored rows without the keys of the winners, and the rows that these leave."""
    won = winners.select(*[F.col(f"`{k}`") for k in keys])
    kept = scope.join(joining(won, broadcast), list(keys), "left_anti")
    kept, added = align(kept, added_rows(winners, keep_tombstones))
    return kept.unionByName(added, allowMissingColumns=True)


# ---------------------------------------------------------------- a backlog of batches as one merge

BATCH_NO = "_batch_no"


def latest_per_batch(
    df: DataFrame, keys: Sequence[str], batch: str, ordering: Sequence[str] = ("current_ts", "op_ts"), deletes_win: bool = False
) -> DataFrame:
    """One row per key and batch, the batch's number as ``BATCH_NO``."""
    latest = latest_per_key(df, [*keys, batch], ordering, deletes_win)
    return latest.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{batch}`").cast("bigint").alias(BATCH_NO), *[F.col(f"`{c}`") for c in latest.columns if c not in (*keys, batch)])


def fold_batches(
    latest: DataFrame, stored: Optional[DataFrame], keys: Sequence[str], ordering: Sequence[str], late_policy: str, keep_tombstones: bool,
    more: Sequence[str] = (), tasks: Optional[int] = None,
) -> DataFrame:
    """(keys, ``_row``, ``_from``): the change of each key that merging its batches in turn would leave, null
    if that is the stored row, and what its stored rows have in the columns ``more``, if any are named.

    ``latest`` has one row per key and batch, so the list of a key's changes has at most as many items as
    the backlog has batches. They meet the ordering of the stored row in the one shuffle that brings
    them together. The state that a key passes through is the ordering of its row (none while it is absent)
    and the place of the change that made it: 0 is the stored row, -1 no row. A key that ends absent gives
    its last delete."""
    payload = [c for c in latest.columns if c not in (*keys, BATCH_NO)]
    named, packed = [F.col(f"`{k}`") for k in keys], lambda cols: F.struct(*[F.col(f"`{c}`") for c in cols])
    ordering = [c for c in ordering if c in latest.columns and (stored is None or c in stored.columns)]
    order = latest.select(ordering_or_null(latest, ordering).alias("o")).schema["o"].dataType
    nothing = F.lit(None).cast(order)
    rows = latest.select(*named, F.struct(F.col(BATCH_NO).alias("batch"), packed(payload).alias("row")).alias("_change"), nothing.alias("_stored_ord"), F.lit(False).alias("_stored"))
    if stored is not None:
        own_ord = ordering_struct(ordering) if ordering and "op_type" in stored.columns else nothing
        mine = stored.select(*named, own_ord.alias("_stored_ord"), F.lit(True).alias("_stored"), *([packed(more).alias("_more")] if more else []))
        rows = rows.unionByName(mine, allowMissingColumns=True)
    found = [F.collect_list("_change").alias("_changes"), F.max("_stored_ord").alias("_stored_ord"), F.max("_stored").alias("_stored")]
    if "_more" in rows.columns:
        found.append(F.collect_set("_more").alias("_from"))
    # A key has few rows by now, so they are shuffled as they are, and lists made only behind the shuffle.
    # A run that died between two partitions may have left a key twice: the later row counts.
    met = rows.repartition(*([tasks] if tasks else []), *named).groupBy(*named).agg(*found)
    by_batch = lambda a, b: F.signum(a["batch"] - b["batch"]).cast("int")
    known = met.filter(F.size("_changes") > 0).withColumn("_changes", F.array_sort("_changes", by_batch))
    state = lambda ord, at: F.struct(ord.cast(order).alias("ord"), at.cast("int").alias("at"))
    start = state(F.col("_stored_ord"), F.when(F.col("_stored"), 0).otherwise(-1))

    def own(row: Column) -> Column:
        if not ordering:
            return nothing
        parts = [*[row[c] for c in ordering], op_rank(row["op_type"])]
        return F.struct(*[p.alias(f"o{i}") for i, p in enumerate(parts)]).cast(order)

    def step(s: Column, c: Column) -> Column:
        batch_ord = c["row"][BATCH_ORDER] if BATCH_ORDER in payload else own(c["row"])
        stays = F.coalesce((s["at"] >= 0) & (s["ord"] > batch_ord), F.lit(False)) if late_policy == EVENT_TIME else F.lit(False)
        made = state(own(c["row"]), c["at"])
        if not keep_tombstones:
            made = F.when(c["row"]["op_type"] == OP_DELETE, state(F.lit(None), F.lit(-1))).otherwise(made)
        return F.when(stays, s).otherwise(made)

    numbered = F.transform("_changes", lambda c, i: F.struct((i + 1).alias("at"), c["row"].alias("row")))
    ended = known.withColumn("_end", F.aggregate(numbered, start, step)["at"])
    deletes = F.filter("_changes", lambda c: c["row"]["op_type"] == OP_DELETE)
    row = F.when(F.col("_end") > 0, F.element_at("_changes", F.greatest(F.col("_end"), F.lit(1)))["row"])
    row = row.when((F.col("_end") < 0) & F.col("_stored"), F.element_at(deletes, -1)["row"])
    return ended.select(*named, row.alias("_row"), *[c for c in ("_from",) if c in ended.columns])


def changed(folded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The winning changes that ``fold_batches`` found, as rows."""
    return folded.filter("_row IS NOT NULL").select(*[F.col(f"`{k}`") for k in keys], "_row.*")


def merge_backlog(
    current: Optional[DataFrame],
    changes: DataFrame,
    keys: Sequence[str],
    batch: str,
    ordering: Sequence[str] = ("current_ts", "op_ts"),
    merge_mode: str = EVENT_ORDER,
    late_policy: str = EVENT_TIME,
    keep_tombstones: bool = False,
) -> DataFrame:
    """What applying the batches that column ``batch`` numbers, one after the other, makes of ``current``."""
    clean = changes.filter(F.col("op_type").isNotNull()).dropna(subset=list(keys))
    latest = latest_per_batch(clean, keys, batch, ordering, merge_mode == UPSERT_THEN_DELETE)
    if current is not None:
        latest = reconcile(current, latest)
    winners = changed(fold_batches(latest, current, keys, ordering, late_policy, keep_tombstones), keys)
    return added_rows(winners, keep_tombstones) if current is None else replace_rows(current, winners, keys, keep_tombstones, False)


def merge_latest(
    current: Optional[DataFrame],
    latest: DataFrame,
    keys: Sequence[str],
    ordering: Sequence[str] = ("current_ts", "op_ts"),
    late_policy: str = EVENT_TIME,
    keep_tombstones: bool = False,
    broadcast_batch: bool = False,
) -> DataFrame:
    """Stored rows + one winning change per key -> new stored rows.

    ``event_time``: a change older than the stored row of its key is ignored (also a delete).
    ``arrival``: the batch always wins. Winners that are deletes remove the key, or stay as
    tombstone rows (``_deleted = true``) when ``keep_tombstones`` is set, so that an older change
    arriving later still loses.
    """
    keys = list(keys)
    is_delete = F.col("op_type") == OP_DELETE
    if keep_tombstones:
        latest = latest.withColumn(TOMBSTONE, is_delete)

    if current is None:
        winners = latest.drop(BATCH_ORDER)
        return winners if keep_tombstones else winners.filter(~is_delete)
    if late_policy not in (ARRIVAL, EVENT_TIME):
        raise ValueError(f"unknown late_policy {late_policy!r}")

    ordering = [c for c in ordering if c in current.columns and c in latest.columns]
    batch_order = F.col(BATCH_ORDER) if BATCH_ORDER in latest.columns else ordering_struct(ordering)
    latest = latest.withColumn("_batch_ord", batch_order).drop(BATCH_ORDER) if ordering else latest.withColumn("_batch_ord", F.lit(None))
    current, latest = align(current, latest)
    hint = F.broadcast if broadcast_batch else (lambda d: d)

    # One join of the stored rows with the batch's orderings decides for both sides: rows that the
    # batch does not beat stay, and their keys are stale in the batch.
    met = current.select("*", ordering_struct(ordering).alias("_stored_ord")) if ordering else current.withColumn("_stored_ord", F.lit(None))
    met = met.join(hint(latest.select(*keys, "_batch_ord", F.lit(True).alias("_in_batch"))), keys, "left")
    stale = F.coalesce(F.col("_stored_ord") > F.col("_batch_ord"), F.lit(False)) if late_policy == EVENT_TIME and ordering else F.lit(False)
    met = met.withColumn("_stale", F.col("_in_batch").isNotNull() & stale)
    kept = met.filter(F.col("_in_batch").isNull() | F.col("_stale")).select(*[F.col(f"`{c}`") for c in current.columns])
    winners = latest.drop("_batch_ord")
    if late_policy == EVENT_TIME and ordering:
        winners = winners.join(hint(met.filter("_stale").select(*keys)) if broadcast_batch else met.filter("_stale").select(*keys), keys, "left_anti")
    added = winners if keep_tombstones else winners.filter(~is_delete)
    return kept.unionByName(added, allowMissingColumns=True)


def apply_changes(
    current: Optional[DataFrame],
    changes: DataFrame,
    keys: Sequence[str],
    ordering: Sequence[str] = ("current_ts", "op_ts"),
    merge_mode: str = EVENT_ORDER,
    late_policy: str = EVENT_TIME,
    keep_tombstones: bool = False,
    broadcast_batch: bool = False,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Merge a flattened change batch (upserts and deletes, ``op_type`` column) into ``current``.

    ``event_order``: per key the last event over all operations decides; a delete followed by an
    insert leaves the row. ``upsert_then_delete``: all upserts are applied, then every key deleted
    in the batch goes.
    """
    if merge_mode not in (EVENT_ORDER, UPSERT_THEN_DELETE):
        raise ValueError(f"unknown merge_mode {merge_mode!r}")
    changes = changes.filter(F.col("op_type").isNotNull())
    for k in keys:
        changes = changes.filter(F.col(f"`{k}`").isNotNull())
    latest = latest_per_key(changes, keys, ordering, deletes_win=merge_mode == UPSERT_THEN_DELETE, tiebreak=tiebreak)
    return merge_latest(current, latest, keys, ordering, late_policy, keep_tombstones, broadcast_batch)


def live_rows(df: DataFrame) -> DataFrame:
    """Rows of a stored table without tombstones."""
    if TOMBSTONE in df.columns:
        # Rows from before tombstones were kept have no mark.
        return df.filter(~F.coalesce(F.col(TOMBSTONE), F.lit(False))).drop(TOMBSTONE)
    return df
