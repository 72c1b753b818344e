"""Envelopes of all objects of a class model, from its shredded tables.

Every geometry of a class contributes, except a stored ``boundedBy`` box and
geometries of the model's root class; child objects contribute where they are
owned.  Tables of one inheritance tree share their ids, so their contributions
meet under the topmost class.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from relgraph.functions.boxes import box_of_points
from relgraph.operators.deletion import ID
from relgraph.operators.envelope import (
    BOX,
    Part,
    combine,
    implicit_contribution,
    inline_contribution,
    parent_key_contribution,
    roll_up,
    root_boxes,
    template_boxes,
)
from relgraph.plans import classes as C
from relgraph.plans.classes import Attribute, ClassModel
from relgraph.plans.model_relations import SURFACES, TEMPLATES, relation_kind
from relgraph.plans.spec import ASSOCIATION


#: Columns of templates that have a surface tree.
BREP, TEMPLATE_GEOMETRY = "relative_brep_id", "implicit_geometry"


def object_space(model: ClassModel, name: str) -> str:
    """The topmost table of a class: objects of its whole tree, and their hooks, have their id there."""
    if model[name].hook:
        return object_space(model, model[name].base)
    return model.table(model.lineage(name)[0].name)


def envelope_parts(model: ClassModel) -> list[Part]:
    """How boxes of owned objects reach their owners.

    A table with a foreign key links the two ids as a link table does.
    """
    parts = []
    for c in model.classes.values():
        for p in c.properties:
            if relation_kind(model, p) == ASSOCIATION:
                continue
            owner, target = object_space(model, c.name), object_space(model, p.target)
            where = model.storage(c.name, p)
            if where.way == C.OWN_KEY:
                parts.append(Part(owner, target, ID, "link", where.table, where.columns[0]))
            elif where.way == C.LINK_TABLE:
                parts.append(Part(owner, target, where.columns[0], "link", where.table, where.columns[1]))
            elif where.way != C.INLINE:
                parts.append(Part(owner, target, where.columns[0], "link", where.table, ID))
    return list(dict.fromkeys(parts))


def _contributions(
    df: DataFrame, a: Attribute, surfaces: DataFrame | None, templates: DataFrame | None
) -> list[DataFrame]:
    name, found = a.name.lower(), []
    if a.kind in (C.SURFACE, C.HYBRID):
        column = f"{name}_id" if a.kind == C.SURFACE else f"{name}_brep_id"
        found.append(parent_key_contribution(df, column, surfaces))
    if a.kind in (C.LINE, C.HYBRID):
        found.append(inline_contribution(df, [name if a.kind == C.LINE else f"{name}_other_geom"]))
    if a.kind == C.IMPLICIT:
        lod = f"lod{a.name[3]}_implicit"
        found.append(implicit_contribution(df, f"{lod}_rep_id", f"{lod}_ref_point", f"{lod}_transformation", templates))
    return found


def own_boxes(tables: Mapping[str, DataFrame], model: ClassModel, root: str | None = None) -> dict[str, DataFrame]:
    """(id, box) of the geometries stored with the objects, per object space."""
    surfaces = root_boxes(tables[SURFACES]) if SURFACES in tables else None
    templates = None
    if TEMPLATES in tables:
        known = tables[TEMPLATES]
        if BREP in known.columns and SURFACES in tables:
            # templates of surfaces are in the surface table, under a root of their own
            column = TEMPLATE_GEOMETRY if TEMPLATE_GEOMETRY in tables[SURFACES].columns else "geometry"
            templates = template_boxes(known, tables[SURFACES], brep=BREP, geometry=column)
        else:
            templates = known.select(ID, box_of_points("relative_other_geom").alias(BOX))
    found: dict[str, list[DataFrame]] = {}
    for c in model.classes.values():
        if c.name == root:
            continue
        for a in c.attributes:
            if a.name.lower() != "boundedby" and model.table(c.name) in tables:
                made = _contributions(tables[model.table(c.name)], a, surfaces, templates)
                found.setdefault(object_space(model, c.name), []).extend(made)
    return {space: combine(*frames) for space, frames in found.items() if frames}


def object_boxes(
    tables: Mapping[str, DataFrame], model: ClassModel, root: str | None = None, keep: bool = False
) -> dict[str, DataFrame]:
    """(id, box) of every object with all that belongs to it, per object space."""
    keys = {object_space(model, name): ID for name in model.classes}
    parts = [p for p in envelope_parts(model) if p.link in tables]
    return roll_up(tables, keys, own_boxes(tables, model, root), parts, keep)

