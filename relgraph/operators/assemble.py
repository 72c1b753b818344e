"""Tables back to nested records: the inverse of shredding, by the same model.

``assemble`` goes bottom-up.  Objects that a composition owns are nested in
their owner; any other property holds the keys of its targets.  Rows meet on
keys only, and the groups are those of one owner, as large as its record.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relgraph.functions.simple_types import VALUE_PARTS
from relgraph.operators.deletion import ID
from relgraph.operators.shred import POSITION, SURFACES, TEMPLATES
from relgraph.plans import classes as C
from relgraph.plans.classes import Attribute, ClassModel, Property
from relgraph.plans.spec import COMPOSITION


def _struct_or_null(fields: Mapping[str, Column]) -> Column:
    """A struct of the fields, null if all of them are."""
    whole = F.struct(*[c.alias(n) for n, c in fields.items()])
    return F.when(reduce(lambda a, b: a | b, [c.isNotNull() for c in fields.values()]), whole)


class _Assemble:
    def __init__(self, tables: Mapping[str, DataFrame], model: ClassModel):
        self.tables = tables
        self.model = model

    def objects(self, name: str, path: tuple[str, ...]) -> DataFrame:
        """(id, attributes, properties) of the objects of one class."""
        rows = self.rows(name)
        for cls in self.model.lineage(name):
            for a in cls.attributes:
                rows = self.attribute(rows, a)
            for p in cls.properties:
                rows = self.property(rows, cls.name, p, path)
        known = [x.name for cls in self.model.lineage(name) for x in (*cls.attributes, *cls.properties)]
        return rows.select(ID, *[F.col(f"_x_{n}").alias(n) for n in known if f"_x_{n}" in rows.columns])

    def rows(self, name: str) -> DataFrame:
        """The rows of one class: its own table joined with those of its bases, which share the keys."""
        model, out = self.model, None
        for table in dict.fromkeys(model.table(c.name) for c in reversed(model.lineage(name))):
            if table not in self.tables:
                continue
            df = self.tables[table]
            if table in model.class_tables() and table == model.table(name):
                df = df.where(F.col(C.CLASS_COLUMN) == F.lit(model[name].class_id))
            df = df.drop(C.CLASS_COLUMN)
            if out is None:
                out = df
            else:
                out = out.join(df.select(ID, *[c for c in df.columns if c not in out.columns]), ID, "left")
        if out is None:
            raise ValueError(f"no table holds rows of class {name}")
        return out

    def attribute(self, rows: DataFrame, a: Attribute) -> DataFrame:
        name, out, have = a.name.lower(), f"_x_{a.name}", rows.columns
        if a.kind in (C.SIMPLE, C.ENUM, C.UNKNOWN, C.LINE):
            return rows.withColumn(out, F.col(name)) if name in have else rows
        if a.kind == C.VALUE:
            fields = {part or "value": f"{name}_{part}".lower() if part else name for part, _ in VALUE_PARTS[a.type]}
            return rows.withColumn(out, _struct_or_null({f: F.col(c) for f, c in fields.items()})) if name in have else rows
        if a.kind == C.PERIOD:
            ends = {"begin": f"{name}_beginposition", "end": f"{name}_endposition"}
            return rows.withColumn(out, _struct_or_null({f: F.col(c) for f, c in ends.items()})) if ends["begin"] in have else rows
        if a.kind == C.MEASURE_LIST:
            if name not in have:
                return rows
            numbers = F.when(F.col(name) == "", F.array().cast("array<double>")).otherwise(F.split(name, " ").cast("array<double>"))
            return rows.withColumn(out, _struct_or_null({"values": numbers, "uom": F.col(f"{name}_uom")}))
        if a.kind == C.IMPLICIT:
            lod = f"lod{a.name[3]}_implicit"
            if f"{lod}_rep_id" not in have:
                return rows
            templates = self.tables[TEMPLATES].select(F.col(ID).alias(f"{lod}_rep_id"), F.col("relative_other_geom").alias("_template"))
            rows = rows.join(templates, f"{lod}_rep_id", "left")
            fields = {"template": F.col("_template"), "ref_point": F.col(f"{lod}_ref_point"), "transformation": F.col(f"{lod}_transformation")}
            return rows.withColumn(out, _struct_or_null(fields)).drop("_template")
        key = f"{name}_id" if a.kind == C.SURFACE else f"{name}_brep_id"
        if key not in have:
            return rows
        surfaces = self.tables[SURFACES].groupBy(F.col("root_id").alias(key)).agg(
            F.transform(F.array_sort(F.collect_list(F.struct(POSITION, "geometry"))), lambda s: s["geometry"]).alias("_surfaces")
        )
        rows = rows.join(surfaces, key, "left")
        value = F.col("_surfaces")
        if a.kind == C.HYBRID:
            value = _struct_or_null({"surfaces": value, "points": F.col(f"{name}_other_geom")})
        return rows.withColumn(out, value).drop("_surfaces")

    def nests(self, p: Property, path: tuple[str, ...]) -> bool:
        target = self.model[p.target]
        return p.kind == COMPOSITION and not target.foreign and not target.abstract and p.target not in path

    def targets(self, p: Property, path: tuple[str, ...]) -> DataFrame:
        """(id, value): whole objects where they are nested, else their keys."""
        whole = self.objects(p.target, (*path, p.target))
        return whole.select(ID, F.struct(*whole.columns).alias("value"))

    def property(self, rows: DataFrame, owner: str, p: Property, path: tuple[str, ...]) -> DataFrame:
        where, out = self.model.storage(owner, p), f"_x_{p.name}"
        if where.way == C.INLINE:
            prefix, target = self.model.inline_prefix(owner, p), self.model[p.target]
            fields = {a.name: f"{prefix}_{a.name}".lower() for a in target.attributes}
            fields = {n: F.col(c) for n, c in fields.items() if c in rows.columns}
            return rows.withColumn(out, _struct_or_null(fields)) if fields else rows
        if where.way == C.OWN_KEY:
            if where.columns[0] not in rows.columns:
                return rows
            if not self.nests(p, path):
                return rows.withColumn(out, F.col(where.columns[0]))
            targets = self.targets(p, path).select(F.col(ID).alias("_key"), F.col("value").alias(out))
            return rows.join(targets, F.col(where.columns[0]) == F.col("_key"), "left").drop("_key")
        pairs = self.pairs(owner, p)
        if pairs is None:
            return rows
        if self.nests(p, path):
            pairs = pairs.join(self.targets(p, path), pairs["_target"] == F.col(ID)).select("_owner", F.col(ID).alias("_target"), "value")
            found = F.transform(F.array_sort(F.collect_list(F.struct("_target", "value"))), lambda x: x["value"])
        else:
            found = F.array_sort(F.collect_list("_target"))
        grouped = pairs.groupBy("_owner").agg(found.alias(out))
        return rows.join(grouped, F.col(ID) == F.col("_owner"), "left").drop("_owner")

    def pairs(self, owner: str, p: Property) -> DataFrame | None:
        """(_owner, _target) of a property that is not stored with its owner."""
        where = self.model.storage(owner, p)
        if where.way == C.MEMBER_KEY:  # all pairs are in the link of the other side
            back = next(x for x in self.model[p.target].properties if x.name == p.reverse)
            other = self.model.storage(p.target, back)
            link = self.tables.get(other.table)
            return None if link is None else link.select(F.col(other.columns[1]).alias("_owner"), F.col(other.columns[0]).alias("_target"))
        table = self.tables.get(where.table)
        if table is None:
            return None
        if where.way == C.LINK_TABLE:
            first, second = where.columns
            return table.select(F.col(first).alias("_owner"), F.col(second).alias("_target"))
        column = where.columns[0]
        if column not in table.columns:
            return None
        return table.select(F.col(column).alias("_owner"), F.col(ID).alias("_target")).where(F.col("_owner").isNotNull())


def assemble(tables: Mapping[str, DataFrame], model: ClassModel, name: str) -> DataFrame:
    """The nested records of one class: ``id``, its attributes and properties.

    Composed objects are nested as structs, or arrays of structs in the order
    of their keys, on every level; a class does not nest in itself again, its
    parts are keys there.  Other properties are keys, arrays sorted.  A property
    without targets is null.  What the tables have no column for is left out.
    Values come back in the types they are stored in, so a text of a number is
    a number, and a list of measures is doubles.
    """
    return _Assemble(tables, model).objects(name, (name,))
