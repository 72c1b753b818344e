"""Single delete steps.  Each takes frames and returns delta or survivor frames.

Key sets are one-column frames.  They are reduced to distinct non-null keys
before they are joined, so a key that repeats in a third of all rows is
collapsed map-side and never meets itself in one task.  No side is hinted as
broadcast; Spark decides from file sizes and, at run time, from shuffle sizes.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from relgraph.plans.spec import AGGREGATION, ASSOCIATION, COMPOSITION

ID = "id"


def key_set(df: DataFrame, column: str = ID, name: str = ID) -> DataFrame:
    """Distinct non-null values of one column, under one name."""
    return df.select(F.col(column).alias(name)).where(F.col(name).isNotNull()).distinct()


def key_union(sets: Sequence[DataFrame], name: str = ID) -> DataFrame:
    """Distinct union of key sets."""
    return reduce(DataFrame.unionByName, [key.select(name) for key in sets]).distinct()


def with_keys(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose column is in the key set."""
    return df.join(keys.select(F.col(ID).alias(column)), column, "left_semi")


def without_keys(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose column is null or not in the key set."""
    return df.join(keys.select(F.col(ID).alias(column)), column, "left_anti")


def needs_shuffle(keys: DataFrame) -> bool:
    """Whether a key set is too large, as far as its files tell, to be broadcast to the rows it meets."""
    state = keys.sparkSession._jsparkSession.sessionState()
    size = keys._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size) > state.conf().autoBroadcastJoinThreshold()


def tagged_keys(sets: Sequence[DataFrame], kind: DataType | str) -> DataFrame:
    """(tag, key): several key sets as one, the tag being the place of the set."""
    return reduce(DataFrame.union, [keys.select(F.lit(i).alias("_tag"), F.col(ID).cast(kind).alias("_key")) for i, keys in enumerate(sets)])


def key_hits(df: DataFrame, probes: Sequence[tuple[str, DataFrame]], name: str) -> DataFrame:
    """``df`` with a bit mask: bit i says that the column of probe i is in its key set.

    All probes are one join: the columns in long form meet the tagged union of
    the sets, hits are regrouped by the values of the columns, and the rows
    meet them once.  So wide rows are exchanged once however many keys they
    have.  A null is in no set.
    """
    sets: list[DataFrame] = []
    for _, keys in probes:
        if not any(keys is other for other in sets):
            sets.append(keys)
    tags = [next(i for i, other in enumerate(sets) if other is keys) for _, keys in probes]
    kinds = {df.schema[c].dataType for c, _ in probes} | {keys.schema[ID].dataType for keys in sets}
    kind = kinds.pop() if len(kinds) == 1 else "string"
    row = F.struct(*[F.col(c).alias(f"k{i}") for i, (c, _) in enumerate(probes)])
    long = df.select(row.alias("_row"), F.explode(F.array(*[
        F.struct(F.lit(1 << i).cast("bigint").alias("bit"), F.lit(tag).alias("tag"), F.col(c).cast(kind).alias("key"))
        for i, ((c, _), tag) in enumerate(zip(probes, tags, strict=True))
    ])).alias("_p")).select("_row", "_p.bit", F.col("_p.tag").alias("_tag"), F.col("_p.key").alias("_key"))
    long = long.where(F.col("_key").isNotNull())
    hits = long.join(tagged_keys(sets, kind), ["_tag", "_key"], "left_semi").groupBy("_row").agg(F.bit_or("bit").alias(name))
    joined = df.withColumn("_row", row).join(hits, "_row", "left")
    return joined.select(*[df[c] for c in df.columns], F.coalesce(name, F.lit(0).cast("bigint")).alias(name))


def delete_rows(df: DataFrame, ids: DataFrame, key: str = ID) -> tuple[DataFrame, DataFrame]:
    """(survivors, keys of the removed rows).  Null ids delete nothing."""
    keys = key_set(ids)
    return without_keys(df, key, keys), with_keys(df.select(F.col(key).alias(ID)), ID, keys)


def cascade_children(child: DataFrame, fk: str, ids: DataFrame, key: str = ID) -> DataFrame:
    """Keys of child rows whose foreign key points at a deleted row."""
    return with_keys(child.select(F.col(key).alias(ID), F.col(fk).alias("_fk")), "_fk", key_set(ids)).select(ID)


def set_null(df: DataFrame, fk: str, ids: DataFrame) -> DataFrame:
    """``df`` with the foreign key nulled where it points at a deleted row."""
    gone = key_set(ids).select(F.col(ID).alias("_gone"))
    joined = df.join(gone, df[fk] == gone["_gone"], "left")
    return joined.select(*[F.when(F.col("_gone").isNull(), df[c]).alias(c) if c == fk else df[c] for c in df.columns])


def detach_children(
    child: DataFrame, fk: str, ids: DataFrame, key: str = ID, multi_owner: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(children after the null-out, keys of the children that lost this owner).

    The foreign key is nulled only for children that several owners may share;
    the returned keys are the candidates for :func:`delete_unreferenced`.
    """
    lost = cascade_children(child, fk, ids, key)
    return (set_null(child, fk, ids) if multi_owner else child), lost


def unlink(link: DataFrame, owner_column: str, member_column: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept link rows, member keys of the removed link rows)."""
    keys = key_set(ids)
    removed = with_keys(link.select(owner_column, member_column), owner_column, keys)
    return without_keys(link, owner_column, keys), key_set(removed, member_column)


def unlink_only(link: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Kept link rows of a plain association; the far rows are not touched."""
    return without_keys(link, column, key_set(ids))


def delete_unreferenced(
    candidates: DataFrame,
    referrers: Iterable[tuple[DataFrame, str]],
    kind: str = AGGREGATION,
) -> DataFrame:
    """Candidate keys no row of any (surviving) referrer points at.

    Compositions skip the test.  The referring keys of all referrers are
    reduced to the candidates and to distinct keys first, then one anti join
    decides.
    """
    keys = key_set(candidates)
    if kind == ASSOCIATION:
        return keys.limit(0)
    return keys if kind == COMPOSITION else unreferenced_of(keys, list(referrers))


def unreferenced_of(keys: DataFrame, referrers: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Those of some distinct keys that no referrer contains."""
    if not referrers:
        return keys
    # a small key set is joined below the aggregation, as a broadcast; with a
    # large one the referring keys are distinct before they are shuffled
    used = [with_keys(key_set(df, column), ID, keys) for df, column in referrers]
    return without_keys(keys, ID, key_union(used))


def owners_all_null(df: DataFrame, candidates: DataFrame, owner_columns: Sequence[str], key: str = ID) -> DataFrame:
    """Candidates whose owner columns are all null; no test for a single owner."""
    keys = key_set(candidates)
    if len(owner_columns) < 2:
        return keys
    free = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in owner_columns])
    return with_keys(df.where(free).select(F.col(key).alias(ID)), ID, keys)


def owned_targets(deleted_rows: DataFrame, fk_columns: Sequence[str]) -> DataFrame:
    """Keys that the foreign keys of deleted rows lead to, all columns together."""
    return (
        deleted_rows.select(F.explode(F.array(*[F.col(c) for c in fk_columns])).alias(ID))
        .where(F.col(ID).isNotNull())
        .distinct()
    )


def owned_kind(kinds: Iterable[str]) -> str | None:
    """Kind of several foreign keys to one target; plain associations drop out."""
    owning = [k for k in kinds if k != ASSOCIATION]
    if not owning:
        return None
    return AGGREGATION if AGGREGATION in owning else COMPOSITION


#: Who started a delete: the user, the base table, or a sub table.
ENTRY, FROM_BASE, FROM_SUB = 0, 1, 2


def delete_base_rows(
    base: DataFrame, ids: DataFrame, key: str = ID, caller: int = ENTRY, hook: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Same ids in the base table, unless the base began it or this is a hook."""
    if caller == FROM_BASE or hook:
        return base, key_set(ids).limit(0)
    return delete_rows(base, ids, key)


def dispatch_subclasses(
    objects: DataFrame,
    ids: DataFrame,
    table_of_class: Mapping[int, str],
    class_column: str = "objectclass_id",
    key: str = ID,
    caller: int = ENTRY,
) -> DataFrame:
    """(table, id): where to continue a delete that began in the base table.

    The class map is a literal of a few hundred entries at most; classes that
    are not in it lead nowhere, and a call from a sub table leads nowhere.
    """
    routed = with_keys(objects.select(F.col(key).alias(ID), F.col(class_column)), ID, key_set(ids))
    if caller == FROM_SUB or not table_of_class:
        return routed.select(F.lit("").alias("table"), ID).limit(0)
    pairs = [F.lit(v) for item in sorted(table_of_class.items()) for v in item]
    names = F.create_map(*pairs)
    return routed.select(F.try_element_at(names, F.col(class_column)).alias("table"), ID).where(
        F.col("table").isNotNull()
    )


def delete_hook_rows(hook: DataFrame, ids: DataFrame, key: str = ID) -> tuple[DataFrame, DataFrame]:
    """Rows of a hook table share the id of their base row and go with it."""
    return delete_rows(hook, ids, key)


def select_by_lineage(
    objects: DataFrame,
    lineage: str,
    class_id=0,
    lineage_column: str = "lineage",
    class_column: str = "objectclass_id",
    key: str = ID,
) -> DataFrame:
    """Keys of the objects of one lineage, of one class unless that is 0."""
    rows = objects.where(F.col(lineage_column) == F.lit(lineage))
    if class_id != 0:
        rows = rows.where(F.col(class_column) == F.lit(class_id))
    return key_set(rows, key)


def extension_objects(
    objects: DataFrame,
    classes: DataFrame,
    extensions: DataFrame,
    extension: str,
    class_column: str = "objectclass_id",
    key: str = ID,
) -> DataFrame:
    """(id, class) of all objects whose class belongs to one extension.

    ``classes(id, extension_id)`` and ``extensions(id, name)`` are class
    registries of a few hundred rows; ``objects`` is scanned once.
    """
    picked = extensions.where(F.col("name") == F.lit(extension)).select(F.col("id").alias("_ext"))
    owned = classes.select(F.col("id").alias("_class"), F.col("extension_id").alias("_ext")).join(picked, "_ext")
    return (
        objects.select(F.col(key).alias(ID), F.col(class_column).alias("objectclass_id"))
        .join(owned.select(F.col("_class").alias("objectclass_id")), "objectclass_id", "left_semi")
        .select(ID, "objectclass_id")
    )
