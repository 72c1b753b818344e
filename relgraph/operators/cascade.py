"""Cascading delete over a graph of related tables.

The result is the least fixpoint of the ownership rules: a row goes when the
rules force it, and shared rows go when no surviving owner is left.  Tables are
taken in dependency order, so an acyclic part of the graph needs one pass per
table; only tables that depend on each other are repeated in rounds.  Each
table's deleted keys are written once and reused; when they are empty, nothing
behind them is scanned.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType

from relgraph.operators.deletion import (
    ID,
    key_hits,
    key_set,
    key_union,
    needs_shuffle,
    select_by_lineage,
    set_null,
    unreferenced_of,
    with_keys,
    without_keys,
)
from relgraph.plans.spec import (
    AGGREGATION,
    ASSOCIATION,
    CASCADE,
    COMPOSITION,
    SET_NULL,
    Link,
    Reference,
    RelationSpec,
    SharedKey,
    reachable,
)
from relgraph.plans.staging import Staging
from relgraph.sources.tables import literal_rows

#: Levels of a self composition that are always followed from the deleted rows down before pointers are doubled.
WAVES = 3


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@dataclass
class CascadeResult:
    """Delta sets of one cascade, and what is left of every table.

    ``deleted_by_table`` holds a written key set per touched table.  All other
    frames are lazy, so a caller pays only for what it reads.
    """

    spec: RelationSpec
    tables: Mapping[str, DataFrame]
    deleted_by_table: dict[str, DataFrame] = field(default_factory=dict)
    #: What a cascade that this one goes on from had deleted already.
    earlier: dict[str, DataFrame] = field(default_factory=dict)
    _whole: dict[str, DataFrame] = field(default_factory=dict)

    def _gone(self, table: str) -> DataFrame | None:
        return self.deleted_by_table.get(table)

    def _all_gone(self, table: str) -> DataFrame | None:
        """Keys deleted here or before, always as the same frame."""
        if table not in self._whole:
            found = [s[table] for s in (self.deleted_by_table, self.earlier) if table in s]
            if found:
                self._whole[table] = _union(found)
        return self._whole.get(table)

    def _empty(self, columns: str) -> DataFrame:
        spark = next(iter(self.tables.values())).sparkSession
        return literal_rows(spark, columns, [])

    def _key(self, table: str, column: str = ID) -> Column:
        """A key of ``table`` for a frame over several tables: text if their key types differ."""
        types = {self.tables[t].schema[k].dataType for t, k in self.spec.keys.items() if t in self.tables}
        whole = all(isinstance(t, IntegralType) for t in types)
        return F.col(column).cast("string") if len(types) > 1 and not whole else F.col(column)

    @property
    def deleted(self) -> DataFrame:
        """(table, id) of every removed row with a key; ids are text if key types differ."""
        frames = [
            ids.select(F.lit(name).alias("table"), self._key(name).alias(ID))
            for name, ids in sorted(self.deleted_by_table.items())
        ]
        return _union(frames) if frames else self._empty("table string, id bigint")

    def _detach(self, ref: Reference) -> bool:
        return ref.on_delete == SET_NULL or (ref.owned == "row" and ref.kind == AGGREGATION and ref.multi_owner)

    def _orphans(self, chosen: Callable[[Reference], bool]) -> DataFrame:
        """(table, id, column): surviving rows that point at a target deleted here."""
        frames, by_table = [], {}
        for ref in self.spec.references:
            if self._gone(ref.target) is not None and chosen(ref):
                by_table.setdefault(ref.table, []).append(ref)
        for table, refs in by_table.items():
            # one scan of the table for all of its keys: their values in long form
            links = F.explode(F.array(*[
                F.struct(F.lit(ref.column).alias("column"), self._key(ref.target, ref.column).alias("fk")) for ref in refs
            ]))
            rows = self.tables[table].select(F.col(self.spec.keys[table]).alias(ID), links.alias("_p")).select(
                ID, F.col("_p.column").alias("column"), F.col("_p.fk").alias("_fk")
            )
            rows = rows.where(F.col("_fk").isNotNull())
            keys = _union([
                self._gone(ref.target).select(F.lit(ref.column).alias("column"), self._key(ref.target).alias("_fk")) for ref in refs
            ])
            rows = rows.join(keys, ["column", "_fk"], "left_semi")
            own = self._all_gone(table)
            rows = without_keys(rows, ID, own) if own is not None else rows
            frames.append(rows.select(F.lit(table).alias("table"), self._key(table).alias(ID), "column"))
        return _union(frames) if frames else self._empty("table string, id bigint, column string")

    @property
    def detached(self) -> DataFrame:
        """(table, id, column): surviving rows whose foreign key was nulled."""
        return self._orphans(self._detach)

    @property
    def blocked(self) -> DataFrame:
        """(table, id, column): surviving rows that still point at a deleted row
        although no policy nulls them.  A database would refuse this delete."""
        return self._orphans(lambda ref: not self._detach(ref))

    def _removed_links(self, link: Link) -> DataFrame | None:
        by_owner, by_member = self._gone(link.owner), self._gone(link.member)
        if by_owner is None and by_member is None:
            return None
        rows = self.tables[link.table].select(link.owner_column, link.member_column)
        for end, column in ((link.owner, link.owner_column), (link.member, link.member_column)):
            if end in self.earlier:
                rows = without_keys(rows, column, self.earlier[end])
        if by_owner is None:
            return with_keys(rows, link.member_column, by_member)
        removed = with_keys(rows, link.owner_column, by_owner)
        if by_member is not None:
            rest = without_keys(rows, link.owner_column, by_owner)
            removed = removed.unionByName(with_keys(rest, link.member_column, by_member))
        return removed

    @property
    def unlinked(self) -> DataFrame:
        """(link, id1, id2), one row per removed link row."""
        frames = []
        for link in self.spec.links:
            removed = self._removed_links(link)
            if removed is not None:
                frames.append(
                    removed.select(
                        F.lit(link.table).alias("link"),
                        self._key(link.owner, link.owner_column).alias("id1"),
                        self._key(link.member, link.member_column).alias("id2"),
                    )
                )
        return _union(frames) if frames else self._empty("link string, id1 bigint, id2 bigint")

    def survivors(self, table: str) -> DataFrame:
        """What is left of one table, foreign keys nulled where policy says so.

        Small key sets are broadcast to the rows; large ones meet them together
        (:func:`key_hits`), so the rows are exchanged once.
        """
        df, spec = self.tables[table], self.spec
        ends = [(link.owner_column, link.owner) for link in spec.links if link.table == table]
        ends += [(link.member_column, link.member) for link in spec.links if link.table == table]
        ends += [(spec.keys[table], table)] if table in spec.keys else []
        refs = [(ref.column, ref.target) for ref in spec.references if ref.table == table and self._detach(ref)]
        ends = [(c, keys) for c, t in ends if (keys := self._all_gone(t)) is not None]
        refs = [(c, keys) for c, t in refs if (keys := self._all_gone(t)) is not None]
        large = [probe for probe in ends + refs if needs_shuffle(probe[1])]
        if len(large) > 1:
            df = key_hits(df, large, "_hits")
            hit = lambda probe: F.col("_hits").bitwiseAND(F.lit(1 << large.index(probe)).cast("bigint")) != 0
            for probe in large:
                if any(probe is e for e in ends):
                    df = df.where(~hit(probe))
            for probe in large:
                if any(probe is r for r in refs):
                    df = df.withColumn(probe[0], F.when(~hit(probe), F.col(probe[0])))
        done = large if len(large) > 1 else []
        for column, keys in [e for e in ends if not any(e is d for d in done)]:
            df = without_keys(df, column, keys)
        for column, keys in [r for r in refs if not any(r is d for d in done)]:
            df = set_null(df, column, keys)
        return df.select(*self.tables[table].columns)


class Cascade:
    """A cascade that can go on: :meth:`delete` may be called again with further
    keys, and starts from the key sets that are written already."""

    def __init__(self, tables: Mapping[str, DataFrame], spec: RelationSpec):
        self.tables = tables
        self.spec = spec
        self.step = 0
        self.last_step: dict[str, int] = {}
        self.echoes: dict[str, set[str]] = {}
        self.taken: dict[tuple[str, str], int] = {}
        self.counts: dict[str, int] = {}
        self.stage = Staging(next(iter(tables.values())).sparkSession)

    def rows(self, table: str, *columns: str) -> DataFrame:
        key = self.spec.keys[table]
        return self.tables[table].select(F.col(key).alias(ID), *[F.col(c) for c in columns if c != key])

    def key_type(self, table: str) -> DataType:
        return self.tables[table].schema[self.spec.keys[table]].dataType

    def gone(self, table: str, after: int = 0) -> DataFrame | None:
        """Keys deleted in one table, in the steps after ``after``."""
        if self.last_step.get(table, 0) <= after:
            return None
        kind = self.key_type(table)
        return self.stage.keys(table, ID, kind, f"deleted-{kind.simpleString()}", after)

    def forced(self, table: str, news: Mapping[str, DataFrame]) -> list[DataFrame]:
        """Keys of ``table`` that the new deletes elsewhere remove outright."""
        spec, out = self.spec, []
        for ref in spec.references:
            cascades = ref.kind == COMPOSITION or (ref.owned == "row" and ref.on_delete == CASCADE)
            if not cascades:
                continue
            if ref.owned == "row" and ref.table == table and ref.target in news:
                rows = self.tables[table].select(
                    F.col(spec.keys[table]).alias(ID), F.col(ref.column).alias("_fk")
                )
                if ref.is_self:
                    rows = rows.where(F.col("_fk") != F.col(ID))
                out.append(with_keys(rows, "_fk", news[ref.target]).select(ID))
        for link in spec.links:
            if link.kind == COMPOSITION and link.member == table and link.owner in news:
                out.append(self._members(link, news[link.owner]))
        for source, refs in self._holders(table, COMPOSITION).items():
            if source in news:
                out.append(self._held(source, refs, news[source]))
        risen = [
            news[k.sub] for k in spec.shared_keys if k.base == table and not k.hook and k.sub in news
        ]
        if risen:
            # most of these came down from this table: when none is left, it is not scanned
            known, ids = self.gone(table), _union(risen)
            ids = ids if known is None else without_keys(ids, ID, known)
            out.append(with_keys(self.rows(table), ID, ids))
        for shared in spec.shared_keys:
            if shared.sub == table and shared.base in news:
                ids = news[shared.base]
                if not shared.hook and shared.class_ids:
                    ids = self._of_classes(ids, shared)
                out.append(with_keys(self.rows(table), ID, ids))
        return out

    def _of_classes(self, ids: DataFrame, shared: SharedKey) -> DataFrame:
        """The ids whose object class the base table routes to the sub table."""
        name = self.spec.class_table or shared.base
        objects = self.rows(name, self.spec.class_column)
        return with_keys(objects.where(F.col(self.spec.class_column).isin(*shared.class_ids)), ID, ids).select(ID)

    def _holders(self, target: str, kind: str) -> dict[str, list[Reference]]:
        """Owning foreign keys to one target, per table; mixed kinds aggregate."""
        groups: dict[str, list[Reference]] = {}
        for ref in self.spec.references:
            if ref.target == target and ref.owned == "target" and ref.kind != ASSOCIATION:
                groups.setdefault(ref.table, []).append(ref)
        return {
            table: refs
            for table, refs in groups.items()
            if (AGGREGATION if any(r.kind == AGGREGATION for r in refs) else COMPOSITION) == kind
        }

    def _held(self, source: str, refs: list[Reference], ids: DataFrame) -> DataFrame:
        rows = with_keys(self.rows(source, *[r.column for r in refs]), ID, ids)
        held = rows.select(F.explode(F.array(*[F.col(r.column) for r in refs])).alias(ID))
        return with_keys(self.rows(refs[0].target), ID, key_set(held))

    def _members(self, link: Link, ids: DataFrame) -> DataFrame:
        rows = self.tables[link.table].select(link.owner_column, link.member_column)
        removed = with_keys(rows, link.owner_column, ids)
        return with_keys(self.rows(link.member), ID, key_set(removed, link.member_column))

    def candidates(self, table: str, news: Mapping[str, DataFrame]) -> list[DataFrame]:
        """Keys of ``table`` that lost one of possibly several owners."""
        out = []
        for ref in self.spec.references:
            if (
                ref.owned == "row"
                and ref.kind == AGGREGATION
                and ref.on_delete != CASCADE
                and ref.table == table
                and ref.target in news
            ):
                rows = self.tables[table].select(
                    F.col(self.spec.keys[table]).alias(ID), F.col(ref.column).alias("_fk")
                )
                out.append(with_keys(rows, "_fk", news[ref.target]).select(ID))
        for link in self.spec.links:
            if link.kind == AGGREGATION and link.member == table and link.owner in news:
                out.append(self._members(link, news[link.owner]))
        for source, refs in self._holders(table, AGGREGATION).items():
            if source in news:
                out.append(self._held(source, refs, news[source]))
        return out

    def unowned(self, table: str, candidates: DataFrame) -> DataFrame:
        """Candidates without a surviving owner."""
        free = candidates
        owner_columns = self.spec.owner_columns(table)
        if len(owner_columns) > 1:
            # the candidates' rows are read once; their owner keys meet all deleted keys in long form
            refs = [r for r in self.spec.references if r.table == table and r.owned == "row" and r.column in owner_columns]
            rows = self.tables[table].select(F.col(self.spec.keys[table]).alias(ID), *[F.col(r.column).alias(f"_f{i}") for i, r in enumerate(refs)])
            rows = with_keys(rows, ID, candidates)
            kinds = {self.key_type(r.target) for r in refs}
            kind = kinds.pop() if len(kinds) == 1 else "string"
            links = F.explode(F.array(*[F.struct(F.lit(r.target).alias("t"), F.col(f"_f{i}").cast(kind).alias("k")) for i, r in enumerate(refs)]))
            rows = rows.select(ID, links.alias("_p")).select(ID, F.col("_p.t").alias("_target"), F.col("_p.k").alias("_fk"))
            rows = rows.where(F.col("_fk").isNotNull())
            gone = [g.select(F.lit(t).alias("_target"), F.col(ID).cast(kind).alias("_fk")) for t in sorted({r.target for r in refs}) if (g := self.gone(t)) is not None]
            held = [(rows.join(_union(gone), ["_target", "_fk"], "left_anti") if gone else rows).select(ID)]
            free = without_keys(free, ID, key_union(held))
        referrers = []
        for source, column in self.spec.owners_of(table):
            if source in self.spec.keys:
                rows = self.rows(source, column)
                gone, owner = self.gone(source), ID
                column = ID if column == self.spec.keys[source] else column
            else:
                link = next(k for k in self.spec.links if k.table == source and k.member_column == column)
                rows = self.tables[source].select(link.owner_column, column)
                gone, owner = self.gone(link.owner), link.owner_column
            if gone is not None:
                rows = without_keys(with_keys(rows, column, candidates), owner, gone)
            referrers.append((rows, column))
        return unreferenced_of(free, referrers)

    def keep(self, sets: dict[str, DataFrame], label: str) -> list[str]:
        """Write the key sets of one wave, one job per key type; the tables
        whose set is not empty."""
        by_type: dict[str, dict[str, DataFrame]] = {}
        for table, keys in sets.items():
            kind = self.key_type(table)
            keys = keys.where(F.col(ID).isNotNull()).select(F.col(ID).cast(kind).alias(ID))
            by_type.setdefault(kind.simpleString(), {})[table] = keys
        counts: dict[str, int] = {}
        for kind, group in by_type.items():
            counts.update(self.stage.append_keys(self.step, group, f"{label}-{kind}"))
        self.counts.update(counts)
        return [table for table, n in counts.items() if n]

    def lost_an_owner(self, table: str) -> DataFrame:
        """The candidates of the current step."""
        kind = self.key_type(table)
        return self.stage.keys(table, ID, kind, f"candidates-{kind.simpleString()}", self.step - 1)

    def advance(self, news: Mapping[str, Mapping[str, DataFrame]], seeds: Mapping[str, DataFrame]) -> list[str]:
        """Act in several tables at once on their news (table -> source -> new
        keys) and seeds; returns the tables that lost further rows."""
        self.step += 1
        lost = {t: c for t in news if (c := self.candidates(t, news[t]))}
        tested = self.keep({t: key_union(c) for t, c in lost.items()}, "candidates") if lost else []
        doomed = {}
        for table in news:
            forced = self.forced(table, news[table])
            if table in seeds:
                forced.append(seeds[table])
            if table in tested:
                forced.append(self.unowned(table, self.lost_an_owner(table)))
            if forced:
                keys, known = key_union(forced), self.gone(table)
                doomed[table] = keys if known is None else without_keys(keys, ID, known)
        changed = self.keep(doomed, "deleted") if doomed else []
        self.last_step.update(dict.fromkeys(changed, self.step))
        self.echoes = {t: self.came_down(t, news[t]) for t in changed if t not in seeds and t not in tested}
        before = self.step - 1
        for table in changed:
            own = [r.column for r in self.spec.references if r.table == table and r.is_self and r.owned == "row" and r.kind == COMPOSITION]
            if own and self.close(table, own, before) and self.only_contains_itself(table):
                self.echoes.setdefault(table, set()).add(table)
        return changed

    def only_contains_itself(self, table: str) -> bool:
        """Whether self composition is the only way in which deletes in a table reach the same table."""
        refs = [r for r in self.spec.references if r.is_self and r.table == table]
        return all(r.owned == "row" and r.kind == COMPOSITION for r in refs) and not any(
            k.owner == k.member == table for k in self.spec.links
        )

    def came_down(self, table: str, sources: Mapping[str, DataFrame]) -> set[str]:
        """Base tables that need not hear of the new deletes of a sub table, as
        all of these came down from there and nothing else leads back."""
        spec = self.spec
        bases = {k.base for k in spec.shared_keys if k.sub == table}
        if not sources or not set(sources) <= bases or len(sources) > 1:
            return set()
        (base,) = sources
        leads_back = any(
            (r.owned == "row" and (r.target, r.table) == (table, base))
            or (r.owned == "target" and (r.table, r.target) == (table, base))
            for r in spec.references
        ) or any((k.owner, k.member) == (table, base) for k in spec.links)
        from_base = any(r.owned == "row" and (r.target, r.table) == (base, table) for r in spec.references) or any(
            r.owned == "target" and (r.table, r.target) == (base, table) for r in spec.references
        )
        return set() if leads_back or from_base or any(k.member == table and k.owner == base for k in spec.links) else {base}

    def close(self, table: str, parents: list[str], before: int) -> bool:
        """Delete all parts below the rows deleted after the step ``before`` in a
        table that contains itself, on every level.

        The first levels are waves: the children of the last level's keys are
        looked up and written, so a delete in a large table costs what lies
        below it.  Waves go on while a level is twice or half as large as the
        one before, which a broad tree ends soon.  Else, after ``WAVES`` levels,
        the tree is taken to be deep and closed by doubling pointers, whose
        rounds are logarithmic but write the table.  Returns whether nothing
        below is left, as far as these columns go.
        """
        from relgraph.operators.hierarchy import ancestor_flag  # which needs this module

        key = self.spec.keys[table]
        levels = [self.counts[table]]
        while len(levels) <= WAVES or not levels[-2] < 2 * levels[-1] < 4 * levels[-2]:
            last, below = self.gone(table, before), []
            for parent in parents:
                rows = self.tables[table].select(F.col(key).alias(ID), F.col(parent).alias("_up")).where(F.col("_up") != F.col(ID))
                below.append(with_keys(rows, "_up", last).select(ID))
            keys = without_keys(key_union(below), ID, self.gone(table))
            before = self.step
            self.step += 1
            if not self.keep({table: keys}, "deleted"):
                return True
            self.last_step[table] = self.step
            levels.append(self.counts[table])
        for parent in parents:
            gone = self.gone(table)
            marked = gone.select(F.col(ID), F.lit(True).alias("_gone"))
            tree = self.rows(table, parent).where(F.col(ID).isNotNull()).distinct()
            flags = ancestor_flag(tree.join(marked, ID, "left"), "_gone", key=ID, parent=parent)
            self.step += 1
            if self.keep({table: without_keys(flags.where("flagged").select(ID), ID, gone)}, "deleted"):
                self.last_step[table] = self.step
        return len(parents) == 1

    def run(self, roots: Mapping[str, DataFrame]) -> None:
        """Go through the tables in waves, causes first.

        A table waits while a table outside its own group that can still reach
        it has work to do.  Tables of one wave share their jobs; a group of
        mutually dependent tables repeats until it has no news left.
        """
        effects = self.spec.effects()
        group_of = {t: tuple(g) for g in self.spec.order() for t in g}
        reach = reachable(effects)
        seeds = {t: with_keys(self.rows(t), ID, key_set(ids)) for t, ids in roots.items()}
        taken = self.taken
        waiting = set(seeds)
        while waiting:
            wave = sorted(
                t
                for t in waiting
                if not any(t in reach[p] for p in waiting if group_of[p] != group_of[t])
            )
            news: dict[str, dict[str, DataFrame]] = {}
            for table in wave:
                news[table] = {}
                for source in self.last_step:
                    if table in effects[source]:
                        fresh = self.gone(source, taken.get((source, table), 0))
                        if fresh is not None:
                            news[table][source] = fresh
                            taken[source, table] = self.last_step[source]
            changed = self.advance(news, {t: seeds.pop(t) for t in wave if t in seeds})
            waiting.difference_update(wave)
            for table in changed:
                quiet = self.echoes.get(table, set())
                waiting |= effects[table] - quiet
                taken.update({(table, other): self.last_step[table] for other in quiet})


    def delete(self, roots: Mapping[str, DataFrame]) -> CascadeResult:
        """Delete further keys and all that depends on them; the result is what this call has deleted."""
        begun = self.step
        earlier = {t: self.gone(t) for t in self.last_step}
        self.run(roots)
        news = {t: found for t in self.last_step if (found := self.gone(t, begun)) is not None}
        return CascadeResult(self.spec, self.tables, news, earlier)


def cascade_delete(
    tables: Mapping[str, DataFrame], spec: RelationSpec, roots: Mapping[str, DataFrame]
) -> CascadeResult:
    """Delete the given keys (``table -> frame with a column id``) and all that
    depends on them.  Null ids and ids without a row delete nothing."""
    return Cascade(tables, spec).delete(roots)


def part_closure(df: DataFrame, roots: DataFrame, fk: str, key: str = ID) -> DataFrame:
    """The roots and, over all levels, the rows whose self key leads to them.

    Self-loops are ignored and longer cycles end at rows already visited.
    """
    spec = RelationSpec({"part": key}, [Reference("part", fk, "part", COMPOSITION)])
    result = cascade_delete({"part": df}, spec, {"part": roots})
    return result.deleted.select(ID)


def delete_by_lineage(
    tables: Mapping[str, DataFrame],
    spec: RelationSpec,
    root: str,
    lineage: str,
    class_id=0,
    lineage_column: str = "lineage",
) -> tuple[DataFrame, CascadeResult]:
    """(selected keys, cascade) for all objects of a lineage [and class]."""
    picked = select_by_lineage(
        tables[root], lineage, class_id, lineage_column, spec.class_column, spec.keys[root]
    )
    return picked, cascade_delete(tables, spec, {root: picked})


def delete_extension(
    tables: Mapping[str, DataFrame],
    spec: RelationSpec,
    root: str,
    objects: DataFrame,
) -> CascadeResult:
    """Cascade from the objects found by ``extension_objects``."""
    return cascade_delete(tables, spec, {root: objects.select(ID)})
