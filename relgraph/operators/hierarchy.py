"""Parent-pointer tables, link kinds and keys for new rows.

Closures return sets of keys, never ancestor-descendant pairs, so a chain or a
star of any size stays linear.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relgraph.functions.canonical import digest
from relgraph.operators.cascade import _union, part_closure
from relgraph.operators.deletion import ID, key_set, with_keys
from relgraph.plans.spec import AGGREGATION, ASSOCIATION, COMPOSITION
from relgraph.plans.staging import Staging, bounded


def descendants(df: DataFrame, roots: DataFrame, key: str = ID, parent: str = "parent_id") -> DataFrame:
    """All keys below the given roots, on every level.

    A root is part of the result only if it is below another root.
    """
    reached = part_closure(df, roots, parent, key)
    rows = df.select(F.col(key).alias(ID), F.col(parent).alias("_up")).where(F.col(ID) != F.col("_up"))
    return with_keys(rows, "_up", reached).select(ID)


def resolve_root(df: DataFrame, key: str = ID, parent: str = "parent_id", stop: int | None = None) -> DataFrame:
    """(id, root): follow the parent until an id up to ``stop``, a row without
    a parent, a row that is its own parent, or a parent that does not exist.

    Pointers double per round: log2(depth) rounds, and resolved rows no longer
    travel.  Rows on or below a cycle get a null root.
    """
    stage = Staging(df.sparkSession)
    tree = df.select(F.col(key).alias(ID), F.col(parent).alias("up"))
    exists = tree.select(F.col(ID).alias("up"), F.lit(True).alias("_found"))
    ends = F.col("up").isNull() | (F.col("up") == F.col(ID)) | F.col("_found").isNull()
    if stop is not None:
        ends = ends | (F.col(ID) <= stop)
    start = tree.join(exists, "up", "left").select(
        ID, F.when(ends, F.col(ID)).otherwise(F.col("up")).alias("up"), ends.alias("done")
    )
    current, total, done = stage.keep_counting(start, F.col("done"), "start")
    resolved, left = [current.where("done")], total - done
    while left and done:
        pending = current.where(~F.col("done"))
        onward = _union(resolved + [pending]).select(
            F.col(ID).alias("up"), F.col("up").alias("_next"), F.col("done").alias("_done")
        )
        # all pending rows are in either side, so their number bounds what may be broadcast
        moved = bounded(pending, left).join(onward, "up").select(ID, F.col("_next").alias("up"), F.col("_done").alias("done"))
        current, total, done = stage.keep_counting(moved, F.col("done"), "moved")
        resolved.append(current.where("done"))
        left = total - done
    roots = _union(resolved).select(ID, F.col("up").alias("root"))
    if left:
        lost = current.where(~F.col("done")).select(ID, F.lit(None).cast(current.schema["up"].dataType).alias("root"))
        roots = roots.unionByName(lost)
    return roots


def ancestor_flag(
    df: DataFrame, flag: str, eligible: str | None = None, key: str = ID, parent: str = "parent_id"
) -> DataFrame:
    """(id, flagged): the row is eligible and some proper ancestor is flagged."""
    stage = Staging(df.sparkSession)
    ok = F.col(eligible) if eligible else F.lit(True)
    tree = df.select(
        F.col(key).alias(ID),
        F.when(F.col(parent) != F.col(key), F.col(parent)).alias("up"),
        F.coalesce(F.col(flag), F.lit(False)).alias("_own"),
        F.coalesce(ok, F.lit(False)).alias("_ok"),
    )
    above = tree.select(F.col(ID).alias("up"), F.col("_own").alias("_above"))
    start = tree.join(above, "up", "left").select(
        ID, "up", "_ok", F.coalesce("_above", F.lit(False)).alias("flagged")
    )
    current, total, hits = stage.keep_counting(start, F.col("flagged"), "start")
    finished: list[DataFrame] = []
    open_rows = ~F.col("flagged") & F.col("up").isNotNull()
    while hits and hits < total:
        pending = current.where(open_rows)
        finished.append(current.where(~open_rows))
        onward = _union(finished + [pending]).select(
            F.col(ID).alias("up"), F.col("up").alias("_next"), F.col("flagged").alias("_hit")
        )
        moved = pending.drop("flagged").join(onward, "up", "left").select(
            ID, F.col("_next").alias("up"), "_ok", F.coalesce("_hit", F.lit(False)).alias("flagged")
        )
        current, total, hits = stage.keep_counting(moved, F.col("flagged"), "moved")
    return _union(finished + [current]).select(ID, (F.col("flagged") & F.col("_ok")).alias("flagged"))


def _kinds(facts: DataFrame) -> DataFrame:
    kind = F.when(F.max("is_composite") == 1, COMPOSITION).otherwise(AGGREGATION)
    name = F.lower("join_table_or_column_name").alias("_join")
    return facts.groupBy("child_id", "parent_id", name).agg(kind.alias("kind"))


def classify_links(
    links: DataFrame,
    facts: DataFrame,
    child_class: str = "child_class",
    parent_class: str = "parent_class",
    join_name: str = "join_name",
) -> DataFrame:
    """``links`` with their kind, by class pair and join name in any case.

    ``facts(child_id, parent_id, is_composite, join_table_or_column_name)``
    holds one row per relation of the class model.
    """
    known = _kinds(facts).select(
        F.col("child_id").alias("_c"), F.col("parent_id").alias("_p"), "_join", "kind"
    )
    joined = links.join(
        known,
        (links[child_class] == known["_c"])
        & (links[parent_class] == known["_p"])
        & (F.lower(links[join_name]) == known["_join"]),
        "left",
    )
    return joined.select(*[links[c] for c in links.columns], F.coalesce("kind", F.lit(ASSOCIATION)).alias("kind"))


def classify_table_links(
    links: DataFrame,
    facts: DataFrame,
    classes: DataFrame,
    child_table: str = "child_table",
    parent_table: str = "parent_table",
    join_name: str = "join_name",
) -> DataFrame:
    """As :func:`classify_links`, for links between tables that may hold several
    classes: the first fact in ascending (child, parent) class order decides."""
    table_of = classes.select(F.col("id"), F.lower("tablename").alias("_table"))
    named = (
        _kinds(facts)
        .join(table_of.select(F.col("id").alias("child_id"), F.col("_table").alias("_ct")), "child_id")
        .join(table_of.select(F.col("id").alias("parent_id"), F.col("_table").alias("_pt")), "parent_id")
        .groupBy("_ct", "_pt", "_join")
        .agg(F.min_by("kind", F.struct("child_id", "parent_id")).alias("kind"))
    )
    joined = links.join(
        named,
        (F.lower(links[child_table]) == named["_ct"])
        & (F.lower(links[parent_table]) == named["_pt"])
        & (F.lower(links[join_name]) == named["_join"]),
        "left",
    )
    return joined.select(*[links[c] for c in links.columns], F.coalesce("kind", F.lit(ASSOCIATION)).alias("kind"))


def conflicting_keys(batch: DataFrame, existing: DataFrame, key: str = ID) -> DataFrame:
    """Keys of a batch that exist already."""
    return with_keys(key_set(batch, key), ID, existing.select(F.col(key).alias(ID)))


class KeysInUse(ValueError):
    """Raised by :func:`assert_new_keys`; ``conflicts`` is the frame of all keys in conflict."""

    def __init__(self, message: str, conflicts: DataFrame):
        super().__init__(message)
        self.conflicts = conflicts


def assert_new_keys(batch: DataFrame, existing: DataFrame, key: str = ID, named: int = 10) -> None:
    """Refuse a batch with existing keys.

    The error says how many there are, names the first few and carries them all.
    """
    conflicts = conflicting_keys(batch, existing, key)
    total = conflicts.count()
    if total:
        first = [row[ID] for row in conflicts.orderBy(ID).limit(named).collect()]
        shown = f"first {len(first)} of {total}: " if total > len(first) else ""
        raise KeysInUse(f"{total} keys already in use: {shown}{', '.join(map(str, first))}", conflicts)


_ROW_BITS = 33


def surrogate_keys(df: DataFrame, order_by: Sequence[str] = (), after: int = 0, name: str = ID) -> DataFrame:
    """``df`` with dense keys ``after + 1, after + 2, ...`` in the given order.

    Rows are range partitioned and sorted, numbered inside their partition, and
    written once; then each partition gets the row count of those before it.
    No step sees more than one partition, and the offsets are one row per
    partition.  ``order_by`` should be unique: it also keeps the ranges even.
    """
    stage = Staging(df.sparkSession)
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    numbered, _ = stage.keep(df.withColumn("_n", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_n", _ROW_BITS).alias("_part")
    row = F.col("_n").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = numbered.groupBy(part).agg((F.max(row) + 1).alias("_size"))
    starts = sizes.selectExpr(
        "_part", "coalesce(sum(_size) over (order by _part rows between unbounded preceding and 1 preceding), 0) as _start"
    )
    # written so that its size is known: one row per partition, joined as a broadcast
    starts, _ = stage.keep(starts, "starts")
    joined = numbered.withColumn("_part", part).join(starts, "_part")
    return joined.select(*df.columns, (F.col("_start") + row + F.lit(after + 1)).cast("long").alias(name))


def _in_order(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Range partitioned and sorted, ties by the whole row; equal rows are dealt out in any order."""
    if not order_by:
        return df
    rest = [c for c in df.columns if c not in order_by]
    content = [F.xxhash64(digest(F.struct(*rest), df.select(F.struct(*rest)).schema[0].dataType))] if rest else []
    keys = [*order_by, *[f"_o{i}" for i in range(len(content))], "_equal"]
    for i, c in enumerate(content):
        df = df.withColumn(f"_o{i}", c)
    df = df.withColumn("_equal", F.monotonically_increasing_id())
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*keys[len(order_by) :])


def counted_flags(df: DataFrame, flags: Mapping[str, Column], order_by: Sequence[str] = ()) -> tuple[DataFrame, list[int]]:
    """``df`` with, for each flag, a dense count 1, 2, ... of the rows that meet it (null for others), and the totals.

    All flags are counted in one pass over rows in one order, which are written
    once; the counts of earlier partitions, one row a partition, are broadcast.
    """
    stage = Staging(df.sparkSession)
    columns, names = df.columns, list(flags)
    marked = df.select("*", *[F.coalesce(c, F.lit(False)).cast("bigint").alias(n) for n, c in flags.items()])
    rows = _in_order(marked, order_by).withColumn("_n", F.monotonically_increasing_id())
    rows = rows.withColumn("_part", F.shiftright("_n", _ROW_BITS))
    local = Window.partitionBy("_part").orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", *[F.sum(n).over(local).alias(f"_c{i}") for i, n in enumerate(names)])
    rows, _ = stage.keep(rows, "counted")
    sums = rows.groupBy("_part").agg(*[F.max(f"_c{i}").alias(f"_s{i}") for i in range(len(names))])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("_part").alias("_p"), *[f"_s{i}" for i in range(len(names))], *[
        F.coalesce(F.sum(f"_s{i}").over(before), F.lit(0)).alias(f"_b{i}") for i in range(len(names))
    ])
    starts, _ = stage.keep(starts, "starts")
    totals = starts.agg(*[F.coalesce(F.sum(f"_s{i}"), F.lit(0)) for i in range(len(names))]).first()
    joined = rows.join(F.broadcast(starts), F.col("_part") == F.col("_p"))
    counts = [F.when(F.col(n) == 1, F.col(f"_b{i}") + F.col(f"_c{i}")).cast("bigint").alias(n) for i, n in enumerate(names)]
    return joined.select(*columns, *counts), list(totals)


def highest_key(df: DataFrame, key: str = ID) -> int:
    """The largest key in use, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
