"""What the driver knows about a set of related tables: keys and ownership.

A spec is configuration of a few dozen entries.  Data never passes through it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

COMPOSITION = "COMPOSITION"
AGGREGATION = "AGGREGATION"
ASSOCIATION = "ASSOCIATION"
KINDS = (COMPOSITION, AGGREGATION, ASSOCIATION)

SET_NULL = "SET NULL"
CASCADE = "CASCADE"


@dataclass(frozen=True)
class Reference:
    """A foreign key ``table.column -> target.id`` and who owns whom.

    ``owned="row"``     the target owns the rows that point at it (1:N children)
    ``owned="target"``  the row owns the target it points at (shared or private
                        part, such as a geometry or a template)

    ``multi_owner`` says that several owners may share a row; a :class:`RelationSpec`
    settles None: shared if the table has two or more owning columns.
    """

    table: str
    column: str
    target: str
    kind: str = ASSOCIATION
    owned: str = "row"
    on_delete: str | None = None
    multi_owner: bool | None = None

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown relation kind {self.kind!r}")
        if self.owned not in ("row", "target"):
            raise ValueError("owned must be 'row' or 'target'")
        if self.on_delete not in (None, SET_NULL, CASCADE):
            raise ValueError(f"unknown ON DELETE policy {self.on_delete!r}")

    @property
    def is_self(self) -> bool:
        return self.table == self.target


@dataclass(frozen=True)
class Link:
    """An M:N table without a key of its own: owner column and member column."""

    table: str
    owner: str
    owner_column: str
    member: str
    member_column: str
    kind: str = ASSOCIATION

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown relation kind {self.kind!r}")


@dataclass(frozen=True)
class SharedKey:
    """``sub.id`` refers to ``base.id``: vertical inheritance, or a hook table.

    ``class_ids`` are the object classes whose rows a delete that starts in the
    base table routes to ``sub``.  A hook carries extra columns of ``base`` and
    is deleted with it, but never deletes it.
    """

    sub: str
    base: str
    class_ids: tuple[int, ...] = ()
    hook: bool = False


@dataclass(frozen=True)
class RelationSpec:
    """Tables, their key columns and the relations between them."""

    keys: Mapping[str, str]
    references: Sequence[Reference] = ()
    links: Sequence[Link] = ()
    shared_keys: Sequence[SharedKey] = ()
    class_column: str = "objectclass_id"
    class_table: str | None = None
    on: dict = field(default_factory=dict, compare=False, repr=False)

    def __post_init__(self):
        known = set(self.keys)
        for ref in self.references:
            if not {ref.table, ref.target} <= known:
                raise ValueError(f"reference {ref} names a table without a key")
        for link in self.links:
            if link.table in known:
                raise ValueError(f"link table {link.table} must not have a key")
            if not {link.owner, link.member} <= known:
                raise ValueError(f"link {link} names a table without a key")
        for shared in self.shared_keys:
            if not {shared.sub, shared.base} <= known:
                raise ValueError(f"shared key {shared} names a table without a key")
        owning: dict[str, set[str]] = {}
        for ref in self.references:
            if ref.owned == "row" and ref.kind != ASSOCIATION and not ref.is_self and ref.multi_owner is not False:
                owning.setdefault(ref.table, set()).add(ref.column)
        settled = tuple(
            ref
            if ref.multi_owner is not None
            else replace(ref, multi_owner=len(owning.get(ref.table, ())) > 1 and ref.column in owning[ref.table])
            for ref in self.references
        )
        object.__setattr__(self, "references", settled)
        owners: dict[str, set[str]] = {}
        for ref in self.references:
            if ref.owned == "row" and ref.multi_owner:
                owners.setdefault(ref.table, set()).add(ref.column)
        object.__setattr__(self, "on", owners)

    def owner_columns(self, table: str) -> list[str]:
        """Owner columns of a table that several owners may share."""
        return sorted(self.on.get(table, ()))

    def owners_of(self, table: str) -> list[tuple[str, str]]:
        """(table, column) pairs whose surviving rows keep a row of ``table``."""
        found = [
            (r.table, r.column)
            for r in self.references
            if r.target == table and r.owned == "target" and r.kind != ASSOCIATION
        ]
        found += [
            (k.table, k.member_column)
            for k in self.links
            if k.member == table and k.kind != ASSOCIATION
        ]
        return list(dict.fromkeys(found))

    def referrers(self, table: str, include_self: bool = False) -> list[tuple[str, str]]:
        """Every (table, column) that refers to ``table``, ordered by name."""
        found = {
            (r.table, r.column)
            for r in self.references
            if r.target == table and (include_self or not r.is_self)
        }
        for link in self.links:
            if link.owner == table:
                found.add((link.table, link.owner_column))
            if link.member == table:
                found.add((link.table, link.member_column))
        for shared in self.shared_keys:
            if shared.base == table:
                found.add((shared.sub, self.keys[shared.sub]))
        return sorted(found)

    def effects(self) -> dict[str, set[str]]:
        """table -> tables in which a delete may remove further rows."""
        out: dict[str, set[str]] = {t: set() for t in self.keys}
        for ref in self.references:
            if ref.kind == ASSOCIATION and not (ref.owned == "row" and ref.on_delete == CASCADE):
                continue
            source, sink = (ref.target, ref.table) if ref.owned == "row" else (ref.table, ref.target)
            out[source].add(sink)
        for link in self.links:
            if link.kind != ASSOCIATION:
                out[link.owner].add(link.member)
        for shared in self.shared_keys:
            out[shared.base].add(shared.sub)
            if not shared.hook:
                out[shared.sub].add(shared.base)
        return out

    def order(self) -> list[list[str]]:
        """Groups of mutually dependent tables, causes before effects.

        A group of one table without a self effect needs a single pass; every
        other group needs rounds.
        """
        return dependency_groups(self.effects())

    def with_multi_owner(self, columns: Mapping[str, Iterable[str]]) -> "RelationSpec":
        """A copy in which exactly the given owner columns of a table are shared.

        Tables that are not named keep what they have.  One owner column alone
        is not shared, so such a table stays unmarked.
        """
        refs = []
        for ref in self.references:
            if ref.owned == "row" and ref.table in columns:
                shared = [c.lower() for c in columns[ref.table]]
                ref = replace(ref, multi_owner=len(shared) > 1 and ref.column.lower() in shared)
            refs.append(ref)
        return replace(self, references=tuple(refs))


def reachable(effects: Mapping[str, set[str]]) -> dict[str, set[str]]:
    """All tables behind each table of a small table graph."""
    reach = {t: set(effects[t]) for t in effects}
    changed = True
    while changed:
        changed = False
        for t in reach:
            grown = reach[t].union(*(reach[s] for s in reach[t])) if reach[t] else reach[t]
            if grown != reach[t]:
                reach[t], changed = grown, True
    return reach


def dependency_groups(effects: Mapping[str, set[str]]) -> list[list[str]]:
    """Strongly connected groups of a small table graph in topological order."""
    reach = reachable(effects)
    groups: list[list[str]] = []
    for t in sorted(reach):
        if not any(t in g for g in groups):
            groups.append([t] + [s for s in sorted(reach) if s != t and s in reach[t] and t in reach[s]])
    # a group comes after all groups that reach it
    ordered: list[list[str]] = []
    pending = list(groups)
    while pending:
        for g in pending:
            if not any(h is not g and g[0] in reach[h[0]] for h in pending):
                ordered.append(g)
                pending.remove(g)
                break
    return ordered


def on_delete(
    multiplicity: str, kind: str, target_is_value: bool = False, target_is_foreign: bool = False
) -> str | None:
    """Delete policy of a foreign key by multiplicity ``1:1``, ``1:N`` or ``M:N``.

    1:1 keys, and 1:N keys that neither own nor hold a value type, are nulled.
    M:N keys cascade when the link owns nothing, or leads to a foreign class.
    Everything else has no policy: the cascade itself must remove the rows.
    """
    owns = kind in (COMPOSITION, AGGREGATION)
    if multiplicity == "1:1":
        return SET_NULL
    if multiplicity == "1:N":
        return None if owns or target_is_value else SET_NULL
    if multiplicity == "M:N":
        return CASCADE if not owns or target_is_foreign else None
    raise ValueError(f"unknown multiplicity {multiplicity!r}")


def shared_owner_columns(facts: Iterable[Mapping], table_of_class: Mapping[int, str]) -> dict[str, list[str]]:
    """Owner columns per table, read from relation facts.

    A fact counts when its upper bound is open (``max_occurs`` is None) and its
    join name ends in ID after at least one other character; the underscore of
    the original pattern matches any character.  Facts of unknown classes are
    left out.
    """
    found: dict[str, list[str]] = {}
    for fact in facts:
        name = fact["join_table_or_column_name"]
        table = table_of_class.get(fact["child_id"])
        if table and fact["max_occurs"] is None and re.fullmatch(r".+ID", name.upper(), re.S):
            columns = found.setdefault(table.lower(), [])
            if name.lower() not in columns:
                columns.append(name.lower())
    return found
