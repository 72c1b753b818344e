"""Nested records to related tables.

``shred`` takes one frame per class (column ``id``, attribute columns, property
columns) and returns one frame per table.  A property column holds a key, an
array of keys, a struct, or an array of structs.  Nested structs become rows of
their own; they keep a field ``id`` if they have one and get a dense key
otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relgraph.functions.canonical import digest
from relgraph.functions.simple_types import bad_value, measure_list_columns, period_parts, simple_column, text_column, value_parts
from relgraph.operators.deletion import ID
from relgraph.operators.hierarchy import counted_flags, highest_key, resolve_root, surrogate_keys
from relgraph.plans import classes as C
from relgraph.plans.classes import Attribute, ClassModel, ClassType, Property, Storage
from relgraph.plans.staging import Staging

OWNER, TARGET, POSITION = "owner_id", "target_id", "position"
SURFACES, TEMPLATES = "surface_geometry", "implicit_geometry"


def explode_children(df: DataFrame, column: str, key: str = ID) -> DataFrame:
    """(owner_id, position, value) per element of an array column.

    Null and empty arrays, and null elements, have no child.  The position is
    the place in the array, so it does not depend on the order of rows.
    """
    return df.select(F.col(key).alias(OWNER), F.posexplode(column).alias(POSITION, "value")).where(
        F.col("value").isNotNull()
    )


def key_pairs(df: DataFrame, column: str, key: str = ID) -> DataFrame:
    """Distinct (owner_id, target_id) of a column with a key or an array of keys."""
    if isinstance(df.schema[column].dataType, T.ArrayType):
        pairs = explode_children(df, column, key).select(OWNER, F.col("value").alias(TARGET))
    else:
        pairs = df.select(F.col(key).alias(OWNER), F.col(column).alias(TARGET))
    return pairs.where(F.col(OWNER).isNotNull() & F.col(TARGET).isNotNull()).distinct()


def link_table(forward: Sequence[DataFrame], backward: Sequence[DataFrame], columns: tuple[str, str]) -> DataFrame:
    """Distinct pairs of both sides of a many-to-many property.

    ``backward`` pairs were read from the other side and are turned round.
    """
    sides = [p.select(F.col(OWNER).alias(columns[0]), F.col(TARGET).alias(columns[1])) for p in forward]
    sides += [p.select(F.col(TARGET).alias(columns[0]), F.col(OWNER).alias(columns[1])) for p in backward]
    return reduce(DataFrame.unionByName, sides).distinct()


def attach_key(df: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """``df`` with the owner of each row as a foreign key; the smallest owner
    if, against the model, a row has several (see :func:`lost_keys`)."""
    owners = pairs.groupBy(F.col(TARGET).alias(ID)).agg(F.min(OWNER).alias("_key"))
    return _with_key(df, owners, column)


def own_key(df: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """``df`` with the target of each row as a foreign key; the smallest if,
    against the model, a row has several."""
    targets = pairs.groupBy(F.col(OWNER).alias(ID)).agg(F.min(TARGET).alias("_key"))
    return _with_key(df, targets, column)


def _with_key(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    known = [F.col(column)] if column in df.columns else []
    return df.join(keys, ID, "left").withColumn(column, F.coalesce(*known, "_key")).drop("_key")


def lost_keys(pairs: DataFrame, table: str, column: str, of: str) -> DataFrame:
    """Violations: the keys that a single column cannot hold.

    ``of`` is OWNER if each owner has one target, TARGET if each target has one
    owner.  The smallest key is kept; one row per other key.
    """
    other = OWNER if of == TARGET else TARGET
    pairs = pairs.select(F.col(of).alias(ID), F.col(other).alias("_key")).distinct()
    kept = pairs.groupBy(ID).agg(F.min("_key").alias("_kept"))
    return pairs.join(kept, ID).where("_key <> _kept").select(*_violation(table, column, F.col("_key")))


def _violation(table: str, column: str, lost: Column) -> list[Column]:
    return [
        F.lit(table).alias("table"),
        F.col(ID).cast("string").alias(ID),
        F.lit(column).alias("column"),
        lost.cast("string").alias("lost_key"),
    ]


def tree_keys(df: DataFrame, pairs: DataFrame, parent: str, root: str) -> DataFrame:
    """``df`` with the parent and the root of each row in a self composition.

    A row without parent is its own root.
    """
    stage = Staging(df.sparkSession)
    linked, _ = stage.keep(attach_key(df, pairs, parent), "tree")
    roots = resolve_root(linked, ID, parent).withColumnRenamed("root", root)
    return linked.join(roots, ID, "left")


def fold_struct(column: str, cls: ClassType, schema: T.StructType, prefix: str | None = None) -> list[Column]:
    """Attributes of an inlined value type as ``<prefix>_<attribute>`` columns;
    the prefix is the type's name unless another is given."""
    prefix = prefix or cls.name.lower()
    fields = _matched(schema.names, [a.name for a in cls.attributes], f"value {column} of type {cls.name}")
    return [
        c
        for a in cls.attributes
        if a.name in fields
        for c in attribute_columns(F.col(column)[fields[a.name]], a, schema[fields[a.name]].dataType, f"{prefix}_{a.name}")
    ]


def folded_parts(column: str, cls: ClassType, schema: T.StructType, prefix: str | None = None) -> list[tuple[str, Column, str]]:
    """(column, raw value, simple type) of what is parsed of an inlined value type."""
    prefix = prefix or cls.name.lower()
    fields = {name.lower(): name for name in schema.names}
    return [
        part
        for a in cls.attributes
        if a.name.lower() in fields
        for part in parsed_parts(F.col(column)[fields[a.name.lower()]], a, f"{prefix}_{a.name}")
    ]


def _matched(given: Sequence[str], known: Sequence[str], where: str) -> dict[str, str]:
    """Known name -> given name, in any case; names that nothing knows are an error."""
    by_name: dict[str, str] = {}
    for name in given:
        if name.lower() in by_name:
            raise ValueError(f"{where} has {name!r} and {by_name[name.lower()]!r}, which differ in case only")
        by_name[name.lower()] = name
    unknown = sorted(set(by_name) - {k.lower() for k in known})
    if unknown:
        raise ValueError(f"{where} has columns the model does not know: {', '.join(by_name[u] for u in unknown)}")
    return {k: by_name[k.lower()] for k in known if k.lower() in by_name}


def parsed_parts(value: Column, attribute: Attribute, name: str) -> list[tuple[str, Column, str]]:
    """(column, raw value, simple type) of what is parsed of an attribute."""
    if attribute.kind == C.SIMPLE:
        return [(name, value, attribute.type)]
    if attribute.kind == C.VALUE:
        return value_parts(value, attribute.type, name)
    return period_parts(value, name) if attribute.kind == C.PERIOD else []


def attribute_columns(value: Column, attribute: Attribute, data_type: T.DataType, name: str) -> list[Column]:
    """Columns of one attribute that stays with its object."""
    if attribute.kind in (C.SIMPLE, C.VALUE, C.PERIOD):
        return [simple_column(raw, simple, column) for column, raw, simple in parsed_parts(value, attribute, name)]
    if attribute.kind == C.ENUM:
        return [value.cast("string").alias(name.lower())]
    if attribute.kind == C.UNKNOWN:
        return [text_column(value, data_type, name)]
    if attribute.kind == C.MEASURE_LIST:
        return measure_list_columns(value, name)
    if attribute.kind == C.LINE:
        return [value.alias(name.lower())]
    raise ValueError(f"attribute kind {attribute.kind!r} is not stored with its object")


def bad_values(df: DataFrame, table: str, parts: Sequence[tuple[str, Column, str]]) -> DataFrame:
    """(table, column, failed, example): how many values do not parse, one pass for all columns.

    The example is the smallest of them, as text.
    """
    counts = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(column.lower()).alias("column"),
            F.count_if(bad_value(raw, simple)).alias("failed"),
            F.min(F.when(bad_value(raw, simple), raw.cast("string"))).alias("example"),
        )
        for column, raw, simple in parts
    ]
    return df.agg(F.array(*counts).alias("_all")).select(F.explode("_all").alias("_one")).select("_one.*").where("failed > 0")


def merge_classes(frames: Mapping[int, DataFrame]) -> DataFrame:
    """Classes that share a table: their rows, with the class id, nulls where a
    class lacks a column."""
    parts = [df.withColumn(C.CLASS_COLUMN, F.lit(cid)) for cid, df in sorted(frames.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def split_inheritance(df: DataFrame, levels: Mapping[str, Sequence[str]], key: str = ID) -> dict[str, DataFrame]:
    """One frame per level of a class chain, all with the same key."""
    return {table: df.select(key, *columns) for table, columns in levels.items()}


def surface_keys(df: DataFrame, columns: Mapping[str, Column], after: int = 0, order_by: Sequence[str] = ()) -> tuple[DataFrame, int]:
    """``df`` with a root key for each column with an array of surfaces, and the last key given.

    ``columns`` maps the names of the keys to the arrays.  An object with at
    least one surface gets a root, whose key is its place among the rows plus
    the number of roots before: all attributes are numbered in one pass, and
    the table is not joined with itself.
    """
    numbered, totals = counted_flags(df, {name: F.size(surfaces) > 0 for name, surfaces in columns.items()}, order_by)
    for name, n in zip(columns, totals, strict=True):
        numbered = numbered.withColumn(name, F.col(name) + F.lit(after))
        after += n
    return numbered, after


def surface_rows(df: DataFrame, root: str, surfaces: Column) -> DataFrame:
    """(root_id, position, geometry) of the surfaces of the rows with a root."""
    rows = df.where(F.col(root).isNotNull()).select(F.col(root).alias("root_id"), F.posexplode(surfaces).alias(POSITION, "geometry"))
    return rows.where(F.col("geometry").isNotNull())


def template_rows(df: DataFrame, column: str, name: str, after: int = 0, ordered: bool = False) -> tuple[DataFrame, DataFrame, int]:
    """(``df`` with the key of each row's template as ``name``, templates, their number).

    Equal templates are one row, however many objects use them: they meet by
    their digest, so whole geometries go no further than the first aggregation.
    """
    stage = Staging(df.sparkSession)
    kind = df.select(column).schema[0].dataType
    marked = df.withColumn("_digest", F.when(F.col(column).isNotNull(), digest(F.col(column), kind)))
    used = marked.where(F.col("_digest").isNotNull()).groupBy("_digest").agg(F.first(column).alias("relative_other_geom"))
    numbered, n = stage.keep(surrogate_keys(used, ["relative_other_geom"] if ordered else [], after), "templates")
    keyed = marked.join(numbered.select("_digest", F.col(ID).alias(name)), "_digest", "left").drop("_digest")
    return keyed, numbered.select("relative_other_geom", ID), n


class _Shred:
    def __init__(self, model: ClassModel, frames: Mapping[str, DataFrame], ordered_keys: bool):
        self.model = model
        self.frames = frames
        self.ordered_keys = ordered_keys
        self.stage = Staging(next(iter(frames.values())).sparkSession)
        self.objects: dict[str, list[DataFrame]] = {}
        self.columns: dict[str, dict[str, list[str]]] = {}
        self.pairs: dict[tuple[str, str], list[DataFrame]] = {}
        self.extra: dict[str, list[DataFrame]] = {}
        self.last_key: dict[str, int] = {}
        self.violations: list[DataFrame] = []
        self.casts: list[tuple[DataFrame, str, list[tuple[str, Column, str]]]] = []
        self.frames = {name: self.named(name, df) for name, df in frames.items()}
        for name, df in self.frames.items():
            self.take(name, df)

    def named(self, name: str, df: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
        """The frame of one class with the names of the model."""
        lineage = self.model.lineage(name)
        known = [ID, *carried, *[x.name for c in lineage for x in (*c.attributes, *c.properties)]]
        found = _matched(df.columns, list(dict.fromkeys(known)), f"frame of class {name}")
        return df.select(*[F.col(f"`{given}`").alias(k) for k, given in found.items()])

    def nested_ids(self, name: str, df: DataFrame, space: str) -> list[DataFrame]:
        """Ids of nested objects in one key space, on every level of a frame."""
        out = []
        for p in (p for c in self.model.lineage(name) for p in c.properties):
            if p.name not in df.columns or self.model.folds(p):
                continue
            data_type = df.schema[p.name].dataType
            array = isinstance(data_type, T.ArrayType)
            if not isinstance(data_type.elementType if array else data_type, T.StructType):
                continue
            value = F.explode(p.name) if array else F.col(p.name)
            inner = self.named(p.target, df.select(value.alias("_v")).where("_v is not null").select("_v.*"))
            if ID in inner.columns and self.model.lineage(p.target)[0].name == space:
                out.append(inner.select(ID))
            out += self.nested_ids(p.target, inner, space)
        return out

    def used_keys(self, name: str) -> tuple[str, int]:
        """Key space of a class, which all classes of its hierarchy share, and
        the highest key given out in it."""
        top = self.model.lineage(name)[0].name
        if top not in self.last_key:
            given = [df.select(ID) for n, df in self.frames.items() if self.model.lineage(n)[0].name == top]
            for n, df in self.frames.items():
                given += self.nested_ids(n, df, top)
            self.last_key[top] = highest_key(reduce(DataFrame.union, given)) if given else 0
        return top, self.last_key[top]

    def store(self, name: str, table: str, columns: Sequence[str]) -> None:
        """Note that rows of a class keep these columns in this table."""
        known = self.columns.setdefault(name, {}).setdefault(table, [])
        known += [c for c in columns if c not in known]

    def take(self, name: str, df: DataFrame, carried: Sequence[str] = ()) -> None:
        """Move nested objects out of the rows of one class, level by level.

        ``carried`` are foreign keys the rows already have.
        """
        table = self.model.table(name)
        row = [F.col(ID), *[F.col(c) for c in carried]]
        self.store(name, table, carried)
        geometry = []
        casts: dict[str, list[tuple[str, Column, str]]] = {}
        for cls in self.model.lineage(name):
            here = self.model.table(cls.name)
            self.store(name, here, [])
            for a in cls.attributes:
                if a.name not in df.columns:
                    continue
                if a.kind in (C.SURFACE, C.HYBRID, C.IMPLICIT):
                    geometry.append((a, here))
                    row.append(F.col(a.name).alias(f"_{a.name}"))
                else:
                    made = attribute_columns(F.col(a.name), a, df.schema[a.name].dataType, a.name)
                    casts.setdefault(here, []).extend(parsed_parts(F.col(a.name), a, a.name))
                    self.store(name, here, df.select(*made).columns)
                    row += made
            for p in cls.properties:
                if p.name not in df.columns:
                    continue
                data_type = df.schema[p.name].dataType
                if self.model.folds(p):
                    prefix = self.model.inline_prefix(cls.name, p)
                    made = fold_struct(p.name, self.model[p.target], data_type, prefix)
                    casts.setdefault(here, []).extend(folded_parts(p.name, self.model[p.target], data_type, prefix))
                    self.store(name, here, df.select(*made).columns)
                    row += made
                    continue
                where = self.model.storage(cls.name, p)
                if where.way == C.OWN_KEY and (given := _given_key(p.name, data_type)) is not None:
                    # the row says what it refers to: a column, no join
                    self.store(name, here, where.columns)
                    row.append(given.alias(where.columns[0]))
                found = self.targets(cls, p, df)
                if found is not None:
                    self.pairs.setdefault((cls.name, p.name), []).append(found)
        self.casts += [(df, here, parts) for here, parts in casts.items() if parts]
        flat = df.select(*row)
        if geometry:
            flat = self.geometry(flat, name, geometry)
        self.objects.setdefault(name, []).append(flat)

    def targets(self, cls: ClassType, prop: Property, df: DataFrame) -> DataFrame | None:
        """(owner_id, target_id) of one property; nested targets are taken too.

        Nothing is returned where the key is stored already: with the owner, or
        with children that carry the owner's key, which needs no join.
        """
        where = self.model.storage(cls.name, prop)
        data_type = df.schema[prop.name].dataType
        array = isinstance(data_type, T.ArrayType)
        element = data_type.elementType if array else data_type
        if not isinstance(element, T.StructType):
            return None if where.way == C.OWN_KEY and not array else key_pairs(df, prop.name)
        if array:
            rows = explode_children(df, prop.name)
        else:
            rows = df.where(F.col(prop.name).isNotNull()).select(
                F.col(ID).alias(OWNER), F.lit(0).alias(POSITION), F.col(prop.name).alias("value")
            )
        rows = rows.select(OWNER, POSITION, "value.*")
        inner = self.named(prop.target, rows.drop(OWNER, POSITION).limit(0)).columns
        fields = _matched([c for c in rows.columns if c not in (OWNER, POSITION)], inner, prop.name)
        rows = rows.select(OWNER, POSITION, *[F.col(f"`{given}`").alias(k) for k, given in fields.items()])
        carried = where.columns if where.way == C.CHILD_KEY else ()
        single = where.way == C.OWN_KEY and not array
        if ID not in rows.columns:
            return self.new_objects(prop, rows, carried)
        # the same object may be nested in several owners, and some may have no id
        rows, _, unnamed = self.stage.keep_counting(rows, F.col(ID).isNull(), prop.name)
        named = rows.where(F.col(ID).isNotNull())
        table = self.model.table(prop.target)
        self.take(prop.target, self.one_of_each(named, carried, table), carried)
        pairs = None if carried or single else named.select(OWNER, F.col(ID).alias(TARGET))
        if unnamed:
            fresh = self.new_objects(prop, rows.where(F.col(ID).isNull()).drop(ID), carried)
            pairs = fresh if pairs is None else pairs.unionByName(fresh)
        return pairs

    def new_objects(self, prop: Property, rows: DataFrame, carried: Sequence[str]) -> DataFrame | None:
        """Take nested rows without ids under new keys; their pairs, unless they carry the owner's key."""
        space, last = self.used_keys(prop.target)
        order = [OWNER, POSITION] if self.ordered_keys else []
        rows, n = self.stage.keep(surrogate_keys(rows, order, last), prop.name)
        self.last_key[space] = last + n
        if carried:
            self.take(prop.target, rows.withColumnRenamed(OWNER, carried[0]).drop(POSITION), carried)
            return None
        self.take(prop.target, rows.drop(OWNER, POSITION))
        return rows.select(OWNER, F.col(ID).alias(TARGET))

    def one_of_each(self, rows: DataFrame, carried: Sequence[str], table: str) -> DataFrame:
        """One whole row per id and its smallest owner, the same in every run.

        Other owners, where there can be one only, and other contents of an id
        are violations.
        """
        fields = [c for c in rows.columns if c not in (ID, OWNER, POSITION)]
        owners = [F.min(OWNER).alias(c) for c in carried]
        for column in carried:
            self.violations.append(lost_keys(rows.select(OWNER, F.col(ID).alias(TARGET)), table, column, TARGET))
        if not fields:
            return rows.groupBy(ID).agg(*owners) if owners else rows.select(ID).distinct()
        whole = F.struct(*fields)
        marked = rows.withColumn("_digest", digest(whole, rows.select(whole).schema[0].dataType))
        contents = marked.groupBy(ID).agg((F.min("_digest") != F.max("_digest")).alias("_differ"))
        self.violations.append(contents.where("_differ").select(*_violation(table, "(content)", F.lit(None))))
        one = marked.groupBy(ID).agg(F.min_by(whole, "_digest").alias("_row"), *owners)
        return one.select(ID, "_row.*", *carried)

    def geometry(self, df: DataFrame, name: str, attributes: Sequence[tuple[Attribute, str]]) -> DataFrame:
        """Replace the geometry columns of a class by the columns they are stored in."""
        surfaces: dict[str, Column] = {}
        for a, _ in attributes:
            source = F.col(f"_{a.name}")
            if a.kind == C.SURFACE:
                surfaces[f"{a.name.lower()}_id"] = source
            elif a.kind == C.HYBRID:
                surfaces[f"{a.name.lower()}_brep_id"] = source["surfaces"]
        if surfaces:
            df, self.last_key[SURFACES] = surface_keys(df, surfaces, self.last_key.get(SURFACES, 0), [ID] if self.ordered_keys else [])
            self.extra.setdefault(SURFACES, []).extend(surface_rows(df, root, column) for root, column in surfaces.items())
        elif any(a.kind == C.IMPLICIT for a, _ in attributes):
            df, _ = self.stage.keep(df, "geometry")
        for a, here in attributes:
            source, column = F.col(f"_{a.name}"), a.name.lower()
            if a.kind == C.IMPLICIT:
                lod, last = f"lod{a.name[3]}_implicit", self.last_key.get(TEMPLATES, 0)
                df, rows, n = template_rows(df.withColumn("_t", source["template"]), "_t", f"{lod}_rep_id", last, self.ordered_keys)
                self.last_key[TEMPLATES] = last + n
                self.extra.setdefault(TEMPLATES, []).append(rows)
                df = df.withColumn(f"{lod}_ref_point", source["ref_point"]).withColumn(f"{lod}_transformation", source["transformation"]).drop("_t")
                made = [f"{lod}_rep_id", f"{lod}_ref_point", f"{lod}_transformation"]
            elif a.kind == C.HYBRID:
                df = df.withColumn(f"{column}_other_geom", source["points"])
                made = [f"{column}_brep_id", f"{column}_other_geom"]
            else:
                made = [f"{column}_id"]
            self.store(name, here, made)
        return df.drop(*[f"_{a.name}" for a, _ in attributes])

    def finish(self) -> dict[str, DataFrame]:
        model, merged = self.model, self.model.class_tables()
        by_table: dict[str, list[DataFrame]] = {}
        for name, parts in self.objects.items():
            rows = _union_by_name(parts)
            for table, frame in split_inheritance(rows, self.columns[name]).items():
                if table in merged:
                    frame = frame.withColumn(C.CLASS_COLUMN, F.lit(model[name].class_id).cast("int"))
                by_table.setdefault(table, []).append(frame)
        tables = {table: _union_by_name(parts) for table, parts in by_table.items()}
        links: dict[str, tuple[list[DataFrame], list[DataFrame], Storage]] = {}
        for (owner, prop_name), parts in self.pairs.items():
            prop = next(p for p in model[owner].properties if p.name == prop_name)
            where = model.storage(owner, prop)
            pairs = reduce(DataFrame.unionByName, parts)
            if where.way == C.LINK_TABLE:
                forward, backward, first = links.setdefault(where.table, ([], [], where))
                (forward if where.columns == first.columns else backward).append(pairs)
                continue
            if where.table not in tables:
                raise ValueError(f"{owner}.{prop_name} is stored in {where.table}, of which no rows were given")
            if where.way == C.MEMBER_KEY:
                # a member has one owner in its key; all pairs are in the link of the other side
                back = next(p for p in model[prop.target].properties if p.name == prop.reverse)
                other = model.storage(prop.target, back)
                links.setdefault(other.table, ([], [], other))[1].append(pairs)
            elif where.way != C.TREE_KEYS:
                of = OWNER if where.way == C.OWN_KEY else TARGET
                self.violations.append(lost_keys(pairs, where.table, where.columns[0], of))
            else:
                self.violations.append(lost_keys(pairs, where.table, where.columns[0], TARGET))
            if where.way == C.OWN_KEY:
                tables[where.table] = own_key(tables[where.table], pairs, where.columns[0])
            elif where.way == C.TREE_KEYS:
                tables[where.table] = tree_keys(tables[where.table], pairs, *where.columns)
            else:
                tables[where.table] = attach_key(tables[where.table], pairs, where.columns[0])
        for table, (forward, backward, where) in links.items():
            tables[table] = link_table(forward, backward, where.columns)
        for table, parts in self.extra.items():
            tables[table] = reduce(DataFrame.unionByName, parts)
        return tables


def _given_key(column: str, data_type: T.DataType) -> Column | None:
    """The key a single-valued property column holds, if it holds one."""
    if isinstance(data_type, T.StructType):
        return F.col(column)[ID] if ID in data_type.names else None
    return None if isinstance(data_type, T.ArrayType) else F.col(column)


def _union_by_name(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


class Tables(dict):
    """Table name -> frame, ``violations``: (table, id, column, lost_key) of
    everything the model leaves no room for, and ``bad_values``: (table, column,
    failed, example) of values that do not parse and are null therefore.

    ``lost_key`` is an owner or target beyond the one that is stored; for
    column ``(content)`` it is null, and the id was given with different
    contents, of which one is stored.
    """

    violations: DataFrame
    bad_values: DataFrame


def shred(frames: Mapping[str, DataFrame], model: ClassModel, ordered_keys: bool = False) -> Tables:
    """Tables of nested class frames, as the model stores them.

    Columns and fields match the model's names in any case; unknown ones are an
    error.  New keys lie above all keys given in frames or nested records and
    follow the order of the input splits, which needs no shuffle.
    ``ordered_keys`` sorts by owner and position instead, so that a repeated
    run gives the same keys.
    """
    run = _Shred(model, frames, ordered_keys)
    tables = Tables(run.finish())
    spark = next(iter(frames.values())).sparkSession
    none = spark.range(0).select(*_violation("", "", F.lit(None)))
    tables.violations = reduce(DataFrame.unionByName, run.violations, none).distinct()
    none = spark.range(0).selectExpr("'' as table", "'' as column", "id as failed", "'' as example")
    counts = reduce(DataFrame.unionByName, [bad_values(*cast) for cast in run.casts], none)
    tables.bad_values = counts.groupBy("table", "column").agg(F.sum("failed").cast("bigint").alias("failed"), F.min("example").alias("example"))
    return tables
