"""Which rows refer to which: impact reports over the foreign keys of a spec."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relgraph.operators.cascade import _union
from relgraph.operators.deletion import ID, key_set, with_keys
from relgraph.plans.spec import RelationSpec


def _referring(tables: Mapping[str, DataFrame], spec: RelationSpec, table: str, ids: DataFrame) -> DataFrame:
    keys = key_set(ids)
    frames = []
    for source, column in spec.referrers(table, include_self=True):
        if source in spec.keys:
            row_key = spec.keys[source]
        else:
            # a link row is named by its far side
            link = next(k for k in spec.links if k.table == source and column in (k.owner_column, k.member_column))
            row_key = link.member_column if column == link.owner_column else link.owner_column
        rows = tables[source].select(F.col(row_key).alias("row_key"), F.col(column).alias("target_key"))
        frames.append(
            with_keys(rows, "target_key", keys).select(
                F.lit(source).alias("table"),
                F.lit(column).alias("column"),
                F.lit(source == table).alias("is_self"),
                "row_key",
                "target_key",
            )
        )
    if not frames:
        raise ValueError(f"nothing refers to {table}")
    return _union(frames)


def referencing_rows(
    tables: Mapping[str, DataFrame], spec: RelationSpec, table: str, ids: DataFrame, ordered: bool = True
) -> DataFrame:
    """(table, column, is_self, row_key, target_key) of every row that points at
    one of the given keys of ``table``, ordered by table and column.

    The row keys are part of the sort, so one large table does not end up in
    one sort task.  ``ordered=False`` saves the sort of a bulk report.
    """
    found = _referring(tables, spec, table, ids)
    return found.orderBy("table", "column", "target_key", "row_key") if ordered else found


def referencing_counts(
    tables: Mapping[str, DataFrame], spec: RelationSpec, table: str, ids: DataFrame
) -> DataFrame:
    """(table, column, is_self, row_count): size of the impact per foreign key."""
    return (
        _referring(tables, spec, table, ids)
        .groupBy("table", "column", "is_self")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy("table", "column")
    )


def referenced_rows(df: DataFrame, references: Mapping[str, str], key: str = ID) -> DataFrame:
    """(id, ref_table, target_key, fk_columns): what each row points at.

    ``references`` maps foreign key columns, in column order, to tables.  The
    columns that lead to the same target are one comma list.  A table that the
    key column leads to is left out whole.  All keys of a row are on the row,
    so this is a projection without a shuffle.
    """
    by_table: dict[str, list[str]] = {}
    for column, target in references.items():
        by_table.setdefault(target, []).append(column)
    entries = [
        _entry(target, columns, place)
        for target, columns in sorted(by_table.items())
        if key.lower() not in [c.lower() for c in columns]
        for place in range(len(columns))
    ]
    if not entries:
        raise ValueError("no foreign key left after leaving out the shared key")
    return df.select(F.col(key).alias(ID), F.inline(F.array(*entries))).where(F.col("ref_table").isNotNull())


def _entry(target: str, columns: list[str], place: int) -> Column:
    """The target of one column, unless it is null or an earlier column has it."""
    value = F.col(columns[place]).cast("string")
    names = F.concat_ws(",", *[F.when(F.col(c).cast("string") == value, c) for c in columns[place:]])
    first = value.isNotNull()
    for c in columns[:place]:
        first = first & ~F.col(c).cast("string").eqNullSafe(value)
    entry = F.struct(F.lit(target).alias("ref_table"), value.alias("target_key"), names.alias("fk_columns"))
    return F.when(first, entry)


def shared_key(child: DataFrame, parent: DataFrame, key: str = ID) -> DataFrame:
    """(id, has_parent) per row of a sub or hook table."""
    known = parent.select(F.col(key).alias(ID), F.lit(True).alias("_known"))
    return (
        child.select(F.col(key).alias(ID))
        .join(known, ID, "left")
        .select(ID, F.coalesce("_known", F.lit(False)).alias("has_parent"))
    )


def missing_parent(child: DataFrame, parent: DataFrame, key: str = ID) -> DataFrame:
    """Keys of a sub or hook table without a row in the parent table."""
    return child.select(F.col(key).alias(ID)).join(parent.select(F.col(key).alias(ID)), ID, "left_anti")


def expand_link(link: DataFrame, near: str, far: str, ids: DataFrame) -> DataFrame:
    """Distinct (near, far) pairs of a link table for the given near keys."""
    return with_keys(link.select(near, far), near, key_set(ids)).distinct()
