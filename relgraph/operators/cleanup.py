"""Removal of rows nothing refers to."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relgraph.operators.cascade import Cascade, CascadeResult, cascade_delete
from relgraph.operators.deletion import ID, key_set, key_union, without_keys
from relgraph.plans.spec import RelationSpec


def unreferenced_keys(df: DataFrame, referrers: Iterable[tuple[DataFrame, str]], key: str = ID) -> DataFrame:
    """Keys of ``df`` that no (frame, column) of ``referrers`` contains.

    All referring columns are reduced to one distinct key set, so the table is
    shuffled once however many referrers it has.
    """
    referrers = list(referrers)
    if not referrers:
        raise ValueError("a table nothing can refer to has no unreferenced rows to clean up")
    used = key_union([key_set(frame, column) for frame, column in referrers])
    return without_keys(df.select(F.col(key).alias(ID)), ID, used)


def cleanup_unreferenced(tables: Mapping[str, DataFrame], spec: RelationSpec, table: str) -> CascadeResult:
    """Cascade from all rows of ``table`` that no foreign key leads to.

    Self references do not count as use.
    """
    referrers = [(tables[source], column) for source, column in spec.referrers(table)]
    orphans = unreferenced_keys(tables[table], referrers, spec.keys[table])
    return cascade_delete(tables, spec, {table: orphans})


def bridge_orphans(
    owners: DataFrame, bridge: DataFrame, fk: str, key: str = ID, parent: str | None = None
) -> DataFrame:
    """Keys of owners without a bridge row; with ``parent`` only global ones,
    which are those whose parent column is null."""
    if parent is not None:
        owners = owners.where(F.col(parent).isNull())
    return without_keys(owners.select(F.col(key).alias(ID)), ID, key_set(bridge, fk))


def cleanup_bridge(
    tables: Mapping[str, DataFrame],
    spec: RelationSpec,
    payload: str,
    parameter: tuple[str, str],
    owner: str,
    bridge: tuple[str, str],
    parent: str | None = None,
    cascade: bool = True,
) -> tuple[CascadeResult, CascadeResult]:
    """Payload rows without a parameter row go first; then owners whose bridge
    rows are all gone.  ``parameter`` and ``bridge`` are (table, column).

    ``cascade=False`` removes only the owner rows themselves.
    """
    unused = bridge_orphans(tables[payload], tables[parameter[0]], parameter[1], spec.keys[payload])
    run = Cascade(tables, spec)
    first = run.delete({payload: unused})
    owners, bridges = first.survivors(owner), first.survivors(bridge[0])
    empty = bridge_orphans(owners, bridges, bridge[1], spec.keys[owner], parent)
    if cascade:
        return first, run.delete({owner: empty})
    left = {name: first.survivors(name) for name in tables}
    return first, cascade_delete(left, RelationSpec({owner: spec.keys[owner]}), {owner: empty})
