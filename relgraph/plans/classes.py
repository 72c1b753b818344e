"""A class model and the decision how each class and property is stored.

Decisions depend on the model only, never on data, and follow a fixed order:
value types that fold into their owner, then inheritance, then properties, so
that a property sees the tables left after merging.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from relgraph.plans.spec import ASSOCIATION, COMPOSITION

# Ways an attribute is stored.
SIMPLE, ENUM, UNKNOWN = "simple", "enum", "unknown"
VALUE, PERIOD, MEASURE_LIST = "value", "period", "measure_list"
SURFACE, LINE, HYBRID, IMPLICIT = "surface", "line", "hybrid", "implicit"

# Ways a property is stored.
INLINE, CHILD_KEY, TREE_KEYS, OWN_KEY, LINK_TABLE, MEMBER_KEY = (
    "inline",
    "child_key",
    "tree_keys",
    "own_key",
    "link_table",
    "member_key",
)

CLASS_COLUMN = "objectclass_id"


@dataclass(frozen=True)
class Attribute:
    name: str
    kind: str = SIMPLE
    type: str = "string"


@dataclass(frozen=True)
class Property:
    """A property whose value is an object.  ``max=None`` is unbounded; members
    of a choice are optional and single, whatever their own bounds say."""

    name: str
    target: str
    min: int = 0
    max: int | None = None
    kind: str = ASSOCIATION
    reverse: str | None = None
    choice: bool = False

    @property
    def many(self) -> bool:
        return not self.choice and (self.max is None or self.max > 1)

    @property
    def exactly_one(self) -> bool:
        return not self.choice and self.min == 1 and self.max == 1


@dataclass(frozen=True)
class ClassType:
    """``value`` marks a plain value type, which has no identity of its own;
    ``foreign`` a class that another model owns and stores.  A ``hook`` holds
    further attributes of objects of its base, under their ids in a table of
    its own; it adds to these objects and is no class of objects itself."""

    name: str
    attributes: tuple[Attribute, ...] = ()
    properties: tuple[Property, ...] = ()
    base: str | None = None
    abstract: bool = False
    foreign: bool = False
    value: bool = False
    class_id: int | None = None
    hook: bool = False


@dataclass(frozen=True)
class Storage:
    """Where a property goes: the way, the table that gets the columns, and the
    columns (owner side first for link tables)."""

    way: str
    table: str
    columns: tuple[str, ...] = ()


class ClassModel:
    """Classes by name, with their storage decisions.

    ``merge_into_concrete`` also lets a small class merge into a parent that is
    not abstract.
    """

    def __init__(self, classes: Iterable[ClassType], merge_into_concrete: bool = False):
        self.classes = {c.name: c for c in classes}
        self.merge_into_concrete = merge_into_concrete
        for c in self.classes.values():
            if c.base is not None and c.base not in self.classes:
                raise ValueError(f"{c.name} extends unknown class {c.base}")
            if c.hook and (c.base is None or self.classes[c.base].hook):
                raise ValueError(f"hook {c.name} needs a base that is no hook")
            for p in c.properties:
                if p.target not in self.classes:
                    raise ValueError(f"{c.name}.{p.name} leads to unknown class {p.target}")

    def __getitem__(self, name: str) -> ClassType:
        return self.classes[name]

    def lineage(self, name: str) -> list[ClassType]:
        """The class and its ancestors, topmost first; a hook stands alone."""
        chain = [self[name]]
        while chain[0].base is not None and not chain[0].hook:
            chain.insert(0, self[chain[0].base])
        return chain

    def merges(self, name: str) -> bool:
        """Whether a class shares the table of its parent."""
        child = self[name]
        if child.base is None or child.hook:
            return False
        parent = self[child.base]
        siblings = sum(c.base == parent.name and not c.hook for c in self.classes.values())
        small = not child.abstract and len(child.attributes) + len(child.properties) <= 1
        if parent.foreign:
            return False
        if parent.abstract:
            return small or siblings == 1
        return small and self.merge_into_concrete

    def table(self, name: str) -> str:
        """Table of a class: its own name in lower case, without "Abstract"."""
        if self.merges(name):
            return self.table(self[name].base)
        return name.replace("Abstract", "").lower()

    def merged_tables(self) -> set[str]:
        """Tables that hold several classes."""
        return {self.table(n) for n in self.classes if self.merges(n)}

    def class_tables(self) -> set[str]:
        """Tables with a class column: those of several classes, and those whose
        keys sub tables share, where the class says in which table a row goes on."""
        parents = {
            self.table(c.base)
            for c in self.classes.values()
            if c.base is not None and not c.hook and self.table(c.base) != self.table(c.name)
        }
        return self.merged_tables() | parents

    def folds(self, prop: Property) -> bool:
        """Whether the attributes of the target become columns of the owner."""
        target = self[prop.target]
        plain = not target.properties and all(a.kind in (SIMPLE, ENUM, UNKNOWN) for a in target.attributes)
        return prop.exactly_one and target.value and not target.foreign and not target.abstract and plain

    def _reverse(self, prop: Property) -> Property | None:
        for p in self[prop.target].properties:
            if p.name == prop.reverse:
                return p
        return None

    def _like(self, owner: str, prop: Property, way: str) -> list[tuple[str, Property]]:
        """The other properties that are stored in the same way in the same table."""
        here = self.table(owner)
        return [
            (c.name, p)
            for c in self.classes.values()
            for p in c.properties
            if self.table(c.name) == here and (c.name, p.name) != (owner, prop.name) and self._storage(c.name, p).way == way
        ]

    def inline_prefix(self, owner: str, prop: Property) -> str:
        """Start of the columns of an inlined value: its type, or the property if the type occurs again."""
        again = any(p.target == prop.target and p.name != prop.name for _, p in self._like(owner, prop, INLINE))
        return (prop.name if again else self[prop.target].name).lower()

    def storage(self, owner: str, prop: Property) -> Storage:
        """Where one property of a class is stored.

        Properties share a column or a link table only if they have one name
        and one target: others get the class or the property into the name.
        """
        where, target = self._storage(owner, prop), self.table(prop.target)
        if where.way == OWN_KEY:
            for _, p in self._like(owner, prop, OWN_KEY):
                if p.name.lower() == prop.name.lower() and self.table(p.target) != target:
                    return Storage(OWN_KEY, where.table, (f"{owner}_{prop.name}_id".lower(),))
        if where.way == LINK_TABLE:
            for c, p in self._like(owner, prop, LINK_TABLE):
                if self._storage(c, p).table == where.table and p.name != prop.name and p.name != prop.reverse:
                    name = f"{where.table.split('_to_')[0]}_{prop.name}_to_{target}".lower()
                    return Storage(LINK_TABLE, name, where.columns)
        return where

    def _storage(self, owner: str, prop: Property) -> Storage:
        here, there = self.table(owner), self.table(prop.target)
        if self.folds(prop):
            return Storage(INLINE, here)
        if not prop.many:
            return Storage(OWN_KEY, here, (f"{prop.name}_id".lower(),))
        back = self._reverse(prop)
        if back is not None and back.many:
            return self._many_to_many(owner, prop, back)
        if self[prop.target].foreign:
            return Storage(LINK_TABLE, f"{here}_to_{there}", (f"{here}_id", f"{there}_id"))
        if here == there and prop.kind == COMPOSITION:
            return Storage(TREE_KEYS, here, (f"{here}_parent_id", f"{here}_root_id"))
        return Storage(CHILD_KEY, there, (f"{here}_{prop.name}_id".lower(),))

    def _many_to_many(self, owner: str, prop: Property, back: Property) -> Storage:
        here, there = self.table(owner), self.table(prop.target)
        mine, theirs = f"{here}_{prop.name}_id".lower(), f"{there}_{back.name}_id".lower()
        if owner == prop.target:
            first, second = sorted([prop.name, back.name])
            return Storage(LINK_TABLE, f"{here}_{first}_{second}".lower(), (mine, theirs))
        if prop.kind != ASSOCIATION:
            # the owning side is a key on its members; its reverse is the link
            return Storage(MEMBER_KEY, there, (mine,))
        if back.kind != ASSOCIATION or self.classes[owner].name > prop.target:
            name = f"{there}_{back.name}_to_{here}_{prop.name}".lower()
        else:
            name = f"{here}_{prop.name}_to_{there}_{back.name}".lower()
        return Storage(LINK_TABLE, name, (mine, theirs))
