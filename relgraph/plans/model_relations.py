"""Relations between the tables of a class model.

What ``shred`` stores can be deleted and rolled up by the same model: this
derives the keys, ownership and delete policies that go with its tables.
"""

from __future__ import annotations

from relgraph.plans import classes as C
from relgraph.plans.classes import ClassModel, Property
from relgraph.plans.spec import (
    AGGREGATION,
    ASSOCIATION,
    COMPOSITION,
    Link,
    Reference,
    RelationSpec,
    SharedKey,
    on_delete,
)

SURFACES, TEMPLATES = "surface_geometry", "implicit_geometry"


def relation_kind(model: ClassModel, prop: Property) -> str:
    """Objects without an identity of their own always belong to their owner."""
    return COMPOSITION if model[prop.target].value else prop.kind


def _property(model: ClassModel, owner: str, prop: Property) -> list[Reference | Link]:
    where, kind = model.storage(owner, prop), relation_kind(model, prop)
    here, there = model.table(owner), model.table(prop.target)
    if where.way == C.OWN_KEY:
        return [Reference(here, where.columns[0], there, kind, "target", on_delete("1:1", kind))]
    if where.way == C.LINK_TABLE:
        return [Link(where.table, here, where.columns[0], there, where.columns[1], kind)]
    if where.way == C.MEMBER_KEY:
        # the key holds one owner of a member; the link of the other side holds all of them
        back = next(p for p in model[prop.target].properties if p.name == prop.reverse)
        link = model.storage(prop.target, back)
        policy = on_delete("1:N", kind, model[prop.target].value)
        return [
            Reference(where.table, where.columns[0], here, kind, "row", policy),
            Link(link.table, here, link.columns[1], there, link.columns[0], kind),
        ]
    if where.way in (C.CHILD_KEY, C.TREE_KEYS):
        policy = on_delete("1:N", kind, model[prop.target].value)
        return [Reference(where.table, column, here, kind, "row", policy) for column in where.columns]
    return []


def relation_spec(model: ClassModel) -> RelationSpec:
    """Keys, references, links and shared keys of the tables of a model.

    A row key that several owner columns may hold is marked as shared.  A
    many-to-many link that both of its sides describe is listed once.
    """
    keys = {model.table(c.name): "id" for c in model.classes.values()}
    references: list[Reference] = []
    links: dict[str, Link] = {}
    shared: dict[tuple[str, str], set[int | None]] = {}
    for c in model.classes.values():
        table = model.table(c.name)
        for p in c.properties:
            for relation in _property(model, c.name, p):
                if isinstance(relation, Link):
                    known = links.setdefault(relation.table, relation)
                    if known.kind == ASSOCIATION:
                        links[relation.table] = relation if relation.kind != ASSOCIATION else known
                else:
                    references.append(relation)
        for a in c.attributes:
            if a.kind in (C.SURFACE, C.HYBRID):
                column = f"{a.name.lower()}_brep_id" if a.kind == C.HYBRID else f"{a.name.lower()}_id"
                references.append(Reference(table, column, SURFACES, COMPOSITION, "target"))
                keys[SURFACES] = "root_id"
            if a.kind == C.IMPLICIT:
                column = f"lod{a.name[3]}_implicit_rep_id"
                references.append(Reference(table, column, TEMPLATES, AGGREGATION, "target"))
                keys[TEMPLATES] = "id"
        chain = model.lineage(c.name)
        for base, sub in zip(chain, chain[1:]):
            pair = model.table(sub.name), model.table(base.name)
            if pair[0] != pair[1]:
                shared.setdefault(pair, set()).add(c.class_id)
    owners: dict[str, list[str]] = {}
    for r in references:
        if r.owned == "row" and r.kind != ASSOCIATION and not r.is_self:
            owners.setdefault(r.table, []).append(r.column)
    spec = RelationSpec(
        keys,
        tuple(dict.fromkeys(references)),
        tuple(links.values()),
        # rows can only be told apart by class if every class has an id
        tuple(SharedKey(sub, base, () if None in ids else tuple(sorted(ids))) for (sub, base), ids in shared.items())
        + tuple(SharedKey(model.table(c.name), model.table(c.base), hook=True) for c in model.classes.values() if c.hook),
        class_column=C.CLASS_COLUMN,
    )
    return spec.with_multi_owner(owners)
