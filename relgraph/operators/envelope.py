"""Envelopes: contributions to an object's box, and their roll-up.

A contribution is a frame (id, box).  Merging boxes is a minimum and maximum,
so every roll-up aggregates map-side first, and an object with very many
children costs one row per map task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relgraph.functions.boxes import (
    box_of_points,
    extent_agg,
    matrix,
    merge_agg,
    merge_box,
    place,
)
from relgraph.operators.deletion import ID, key_set, with_keys, without_keys
from relgraph.plans.spec import dependency_groups
from relgraph.plans.staging import Staging, bounded

BOX = "box"


def extent(df: DataFrame, key: str, x: str, y: str, z: str) -> DataFrame:
    """(id, box) around all vertices of each key."""
    return df.groupBy(F.col(key).alias(ID)).agg(extent_agg(x, y, z).alias(BOX)).where(F.col(ID).isNotNull())


def combine(*contributions: DataFrame) -> DataFrame:
    """One box per id from any number of contributions, whatever their table."""
    return (
        reduce(DataFrame.unionByName, [c.select(ID, BOX) for c in contributions])
        .groupBy(ID)
        .agg(merge_agg(BOX).alias(BOX))
    )


def inline_contribution(df: DataFrame, columns: Sequence[str], key: str = ID) -> DataFrame:
    """Boxes of the geometry columns stored with the object; no shuffle."""
    box = reduce(merge_box, [box_of_points(c) for c in columns])
    return df.select(F.col(key).alias(ID), box.alias(BOX)).where(F.col(BOX).isNotNull())


def root_boxes(surfaces: DataFrame, geometry: str = "geometry", root: str = "root_id") -> DataFrame:
    """(id, box) per surface tree, from its non-null geometries."""
    return (
        surfaces.select(F.col(root).alias(ID), box_of_points(geometry).alias(BOX))
        .where(F.col(ID).isNotNull() & F.col(BOX).isNotNull())
        .groupBy(ID)
        .agg(merge_agg(BOX).alias(BOX))
    )


def surface_contribution(
    df: DataFrame, fk: str, surfaces: DataFrame, key: str = ID, geometry: str = "geometry"
) -> DataFrame:
    """Boxes of the surface trees the objects refer to."""
    return parent_key_contribution(df, fk, root_boxes(surfaces, geometry), key)


def template_boxes(
    templates: DataFrame,
    surfaces: DataFrame,
    own: str = "relative_other_geom",
    brep: str = "relative_brep_id",
    geometry: str = "implicit_geometry",
    key: str = ID,
) -> DataFrame:
    """(id, box) per template: its own geometry and its surfaces, once each.

    The boxes are written, because every level of detail places them again, and
    so that Spark knows their size: when they are small enough to broadcast,
    the objects that use them are not shuffled at all.
    """
    roots = root_boxes(surfaces, geometry).select(F.col(ID).alias("_root"), F.col(BOX).alias("_surface"))
    joined = templates.select(F.col(key).alias(ID), box_of_points(own).alias("_own"), F.col(brep).alias("_root")).join(
        roots, "_root", "left"
    )
    boxes = joined.select(ID, merge_box("_own", "_surface").alias(BOX)).where(F.col(BOX).isNotNull())
    return Staging(templates.sparkSession).keep(boxes, "template-boxes")[0]


def implicit_contribution(
    df: DataFrame,
    rep: str,
    ref_point: str,
    transformation: str,
    boxes: DataFrame,
    key: str = ID,
    corners: int = 4,
) -> DataFrame:
    """Boxes of placed templates.  The template box is computed once; an object
    adds only the arithmetic of its own placement."""
    uses = df.where(F.col(rep).isNotNull()).select(
        F.col(key).alias(ID),
        F.col(rep).alias("_rep"),
        F.col(ref_point).alias("_ref"),
        matrix(transformation).alias("_m"),
    )
    joined = uses.join(boxes.select(F.col(ID).alias("_rep"), F.col(BOX).alias("_box")), "_rep")
    return joined.select(ID, place("_box", "_m", "_ref", corners).alias(BOX))


def parent_key_contribution(parent: DataFrame, fk: str, child_boxes: DataFrame, key: str = ID) -> DataFrame:
    """The parent holds the key of the child."""
    boxes = child_boxes.select(F.col(ID).alias("_fk"), BOX)
    return parent.select(F.col(key).alias(ID), F.col(fk).alias("_fk")).join(boxes, "_fk").select(ID, BOX)


def child_key_contribution(child: DataFrame, fk: str, child_boxes: DataFrame, key: str = ID) -> DataFrame:
    """The child holds the key of the parent."""
    rows = child.select(F.col(key).alias(ID), F.col(fk).alias("_fk")).where(F.col("_fk").isNotNull())
    return (
        rows.join(child_boxes.select(ID, BOX), ID)
        .groupBy(F.col("_fk").alias(ID))
        .agg(merge_agg(BOX).alias(BOX))
    )


def link_contribution(link: DataFrame, owner: str, member: str, child_boxes: DataFrame) -> DataFrame:
    """Parent and child meet in a link table; repeated pairs count once."""
    pairs = link.select(F.col(owner).alias(ID), F.col(member).alias("_m")).where(F.col(ID).isNotNull())
    boxes = child_boxes.select(F.col(ID).alias("_m"), BOX)
    return pairs.join(boxes, "_m").groupBy(ID).agg(merge_agg(BOX).alias(BOX))


@dataclass(frozen=True)
class Part:
    """How boxes of ``child`` reach ``parent``.

    ``via="parent"`` the parent's ``column`` holds the child key,
    ``via="child"``  the child's ``column`` holds the parent key,
    ``via="link"``   ``link`` holds both, in ``column`` and ``far``.
    """

    parent: str
    child: str
    column: str
    via: str = "child"
    link: str | None = None
    far: str | None = None


def roll_up(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, str],
    geometry: Mapping[str, DataFrame],
    parts: Sequence[Part],
    keep: bool = False,
) -> dict[str, DataFrame]:
    """(id, box) per table, each box around the object and all below it.

    ``geometry`` holds the own contributions of the tables that have some.
    Tables are taken bottom-up, one aggregation each; boxes that several
    parents need are written once, and with ``keep`` those of every table, for
    callers that use several levels.  Tables that contain each other, or
    themselves, are closed together (:func:`close_boxes`).
    """
    parts = list(dict.fromkeys(parts))
    below: dict[str, set[str]] = {t: set() for t in keys}
    for part in parts:
        below[part.child].add(part.parent)
    stage = Staging(next(iter(tables.values())).sparkSession)
    boxes: dict[str, DataFrame] = {}
    for group in dependency_groups(below):
        inner = [p for p in parts if p.parent in group and p.child in group]
        for table in group:
            below_it = [
                _contribution(tables, keys, part, boxes[part.child])
                for part in parts
                if part.parent == table and part.child not in group and part.child in boxes
            ]
            own = [geometry[table]] if table in geometry else []
            if len(below_it) == 1 and not own:
                # one contribution has one box per parent already
                boxes[table] = below_it[0]
            elif below_it or own:
                boxes[table] = combine(*below_it, *own)
        if inner:
            boxes.update(_settle(tables, keys, inner, {t: boxes[t] for t in group if t in boxes}, stage))
        else:
            table = group[0]
            if table in boxes and (keep or sum(p.child == table for p in parts) > 1):
                boxes[table], _ = stage.keep(boxes[table], f"{table}-boxes")
    return boxes


def _contribution(tables, keys, part: Part, child_boxes: DataFrame) -> DataFrame:
    if part.via == "parent":
        return parent_key_contribution(tables[part.parent], part.column, child_boxes, keys[part.parent])
    if part.via == "child":
        return child_key_contribution(tables[part.child], part.column, child_boxes, keys[part.child])
    if part.via == "link":
        return link_contribution(tables[part.link], part.column, part.far, child_boxes)
    raise ValueError(f"unknown way {part.via!r} from {part.child} to {part.parent}")


def _settle(tables, keys, parts: Sequence[Part], boxes: dict[str, DataFrame], stage: Staging) -> dict[str, DataFrame]:
    """Boxes of tables that contain each other, or themselves: their rows are the nodes of one graph."""
    names = sorted({t for part in parts for t in (part.parent, part.child)})
    kinds = {t: tables[t].schema[keys[t]].dataType for t in names}
    same = len(set(kinds.values())) == 1

    def node(table: str, column: str) -> Column:
        value = F.col(column) if same else F.col(column).cast("string")
        return F.when(F.col(column).isNotNull(), F.struct(F.lit(names.index(table)).alias("t"), value.alias("key")))

    edges = []
    for part in parts:
        if part.via == "parent":
            rows, child, parent = tables[part.parent], part.column, keys[part.parent]
        elif part.via == "child":
            rows, child, parent = tables[part.child], keys[part.child], part.column
        elif part.via == "link":
            rows, child, parent = tables[part.link], part.far, part.column
        else:
            raise ValueError(f"unknown way {part.via!r} from {part.child} to {part.parent}")
        edges.append(rows.select(node(part.child, child).alias(ID), node(part.parent, parent).alias("up")))
    own = [frame.select(node(t, ID).alias(ID), BOX) for t, frame in boxes.items()]
    if not own:
        return {}
    settled = close_boxes(reduce(DataFrame.union, edges), reduce(DataFrame.union, own), stage)
    settled, _ = stage.keep(settled.select(F.col(f"{ID}.t").alias("t"), F.col(f"{ID}.key").alias(ID), BOX), "settled")
    return {t: settled.where(F.col("t") == i).select(F.col(ID).cast(kinds[t]).alias(ID), BOX) for i, t in enumerate(names)}


def close_boxes(edges: DataFrame, boxes: DataFrame, stage: Staging) -> DataFrame:
    """(id, box) around each row and all rows below it, for any graph of ``edges`` (id, up).

    Rows with one parent, the usual case, are closed by doubling pointers:
    chains, trees and rings of n rows take about log2(n) rounds, and a round
    reads only rows whose chain still goes on.  A row with several parents is
    the end of the chains below it.  Between such rows the chains are links of
    a smaller graph, on which boxes that have grown travel until none grows;
    what they come to is then sent up their chains, again by doubling.
    """
    edges = edges.where(F.col(ID).isNotNull() & F.col("up").isNotNull() & (F.col(ID) != F.col("up")))
    parents = edges.groupBy(ID).agg(F.min("up").alias("up"), (F.min("up") != F.max("up")).alias("_fork"))
    parents, n_parents, any_fork = stage.keep_counting(parents, F.col("_fork"), "parents")
    steps = bounded(parents.where(~F.col("_fork")).select(ID, "up"), n_parents)
    base, n = stage.keep(combine(boxes.where(F.col(ID).isNotNull())), "boxes")
    current = combine(base, *_doubled(steps, bounded(base, n), stage))
    if not any_fork:
        return current

    from relgraph.operators.hierarchy import resolve_root  # which needs the cascade

    current, _ = stage.keep(current, "chains")
    forks, n = stage.keep(parents.where("_fork").select(ID), "forks")
    forks = bounded(forks, n)
    fork_edges, n = stage.keep(with_keys(edges, ID, forks).distinct(), "fork-edges")
    fork_edges = bounded(fork_edges, n)
    nodes = steps.select(ID).union(steps.select("up")).union(fork_edges.select("up")).distinct()
    ends = resolve_root(nodes.join(steps, ID, "left"), ID, "up").select(F.col(ID).alias("up"), F.col("root"))
    # rows on or below a ring have no end, and no fork above them
    skeleton = with_keys(fork_edges.join(ends, "up").select(ID, F.col("root")), "root", forks)
    skeleton, _ = stage.keep(skeleton.where(F.col(ID) != F.col("root")).distinct(), "skeleton")
    state, n = stage.keep(with_keys(current, ID, forks), "state")
    state = grown = bounded(state, n)
    while True:
        arrived = skeleton.join(grown, ID).groupBy(F.col("root").alias(ID)).agg(merge_agg(BOX).alias("_up"))
        met = arrived.join(state, ID, "left").select(ID, F.col(BOX).alias("_old"), merge_box(BOX, "_up").alias(BOX))
        grown, n = stage.keep(met.where(~F.col(BOX).eqNullSafe(F.col("_old"))).select(ID, BOX), "grown")
        if not n:
            break
        grown = bounded(grown, n)
        state, n = stage.keep(without_keys(state, ID, grown).union(grown), "state")
        state = bounded(state, n)
    sent = fork_edges.join(state, ID).groupBy(F.col("up").alias(ID)).agg(merge_agg(BOX).alias(BOX))
    base, n = stage.keep(combine(current, sent), "boxes")
    return combine(base, *_doubled(steps, bounded(base, n), stage))


def _doubled(steps: DataFrame, boxes: DataFrame, stage: Staging) -> list[DataFrame]:
    """What pointers (id, up) bring: frames (id, box) with the boxes of all rows below.

    Round k sends the box of each row, and of all less than 2**k below it, to
    the row 2**k above.  Rows whose chain ends sooner drop out.
    """
    rows, left = stage.keep(steps.join(boxes, ID, "left"), "steps")
    brought: list[DataFrame] = []
    while left:
        lifted = rows.where(F.col(BOX).isNotNull()).groupBy(F.col("up").alias(ID)).agg(merge_agg(BOX).alias(BOX))
        lifted, n = stage.keep(lifted, "lifted")
        brought.append(lifted)
        onward = bounded(rows.select(F.col(ID).alias("up"), F.col("up").alias("_next")), left)
        ups = bounded(lifted.select(ID, F.col(BOX).alias("_up")), n)
        met = rows.join(ups, ID, "left").join(onward, "up")
        met = met.select(ID, F.col("_next").alias("up"), merge_box(BOX, "_up").alias(BOX), F.col(BOX).alias("_old"))
        met = met.withColumn("_grown", ~F.col(BOX).eqNullSafe(F.col("_old"))).drop("_old")
        before = rows
        rows, left, grown = stage.keep_counting(met, F.col("_grown"), "steps")
        if left and not grown and rows.count() == before.count():
            break  # no chain ends any more and nothing grows: these are rings and what hangs below them
        rows = rows.drop("_grown")
    return brought


def roll_up_tree(tree: DataFrame, boxes: DataFrame, key: str = ID, parent: str = "parent_id") -> DataFrame:
    """Boxes of a self-referencing table around all levels below, rings included."""
    edges = tree.select(F.col(key).alias(ID), F.col(parent).alias("up"))
    return close_boxes(edges, boxes, Staging(tree.sparkSession))


def collection_envelope(
    objects: DataFrame,
    boxes: DataFrame,
    class_id=0,
    only_if_null: bool = True,
    key: str = ID,
    class_column: str = "objectclass_id",
    envelope: str = "envelope",
) -> DataFrame:
    """One row with the box around all chosen objects, null if there are none.

    By default objects that already have a stored envelope are left out, so the
    result is the box of the objects still to do, not of the collection.
    """
    rows = objects
    if only_if_null:
        rows = rows.where(F.col(envelope).isNull())
    if class_id != 0:
        rows = rows.where(F.col(class_column) == F.lit(class_id))
    ids = rows.select(F.col(key).alias(ID))
    return boxes.join(ids, ID, "left_semi").agg(merge_agg(BOX).alias(BOX))


def write_back(
    objects: DataFrame,
    boxes: DataFrame,
    targets: DataFrame | None = None,
    key: str = ID,
    envelope: str = "envelope",
) -> DataFrame:
    """``objects`` with the stored envelope of the targeted ids replaced.

    Without ``targets`` all objects with a box are meant.  A target without a
    box gets a null envelope; any other object keeps what it has.
    """
    news = boxes.select(F.col(ID).alias("_id"), F.col(BOX).alias("_box"))
    if targets is not None:
        wanted = key_set(targets).select(F.col(ID).alias("_id"))
        news = wanted.join(news, "_id", "left")
    joined = objects.join(news, objects[key] == news["_id"], "left")
    stored = F.when(F.col("_id").isNotNull(), F.col("_box")).otherwise(F.col(envelope))
    return joined.select(*[stored.alias(c) if c == envelope else objects[c] for c in objects.columns])


def targeted(boxes: DataFrame, ids: DataFrame) -> DataFrame:
    """Boxes of the given ids only."""
    return with_keys(boxes, ID, key_set(ids))
