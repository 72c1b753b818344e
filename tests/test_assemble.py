"""Nested records from tables: the inverse of shredding."""

import random

import pytest

from relgraph.operators.assemble import assemble
from relgraph.operators.shred import shred
from relgraph.plans import classes as C
from relgraph.plans.classes import Attribute, ClassModel, ClassType, Property
from relgraph.plans.spec import AGGREGATION, ASSOCIATION, COMPOSITION

POINT = "struct<x:double,y:double,z:double>"


def plain(value):
    if hasattr(value, "asDict"):
        return {k: plain(v) for k, v in value.asDict().items()}
    return [plain(v) for v in value] if isinstance(value, list) else value


def records(df):
    return sorted((plain(r) for r in df.collect()), key=lambda r: r["id"])


def p(v):
    return {"x": float(v), "y": float(v), "z": float(v)}


def test_every_kind_of_column_and_key_comes_back(spark):
    model = ClassModel([
        ClassType("AbstractThing", (Attribute("name"), Attribute("rank", type="int")), abstract=True, class_id=1),
        ClassType("House", (
            Attribute("height", C.VALUE, "LengthType"), Attribute("used", C.PERIOD), Attribute("sizes", C.MEASURE_LIST),
            Attribute("shell", C.SURFACE), Attribute("route", C.LINE), Attribute("shape", C.HYBRID), Attribute("lod1Model", C.IMPLICIT),
        ), (
            Property("room", "Room", kind=COMPOSITION), Property("door", "Door", 0, 1, COMPOSITION), Property("address", "Address", 1, 1, COMPOSITION),
            Property("part", "House", kind=COMPOSITION), Property("near", "House", 0, 1), Property("owner", "Person"),
        ), base="AbstractThing", class_id=2),
        ClassType("Room", (Attribute("use", C.ENUM),), (Property("lamp", "Lamp", kind=COMPOSITION),)),
        ClassType("Lamp", (Attribute("watts", type="double"),)),
        ClassType("Door", (Attribute("colour"),)),
        ClassType("Address", (Attribute("street"), Attribute("number", type="int")), value=True),
        ClassType("Person", foreign=True),
    ])
    schema = (
        "id bigint, name string, rank bigint, height struct<value:double,uom:string>, sizes struct<values:array<double>,uom:string>, "
        f"shell array<array<{POINT}>>, route array<{POINT}>, shape struct<surfaces:array<array<{POINT}>>,points:array<{POINT}>>, "
        f"lod1Model struct<template:array<{POINT}>,ref_point:{POINT},transformation:string>, "
        "room array<struct<id:bigint,use:string,lamp:array<struct<id:bigint,watts:double>>>>, door struct<id:bigint,colour:string>, "
        "address struct<street:string,number:bigint>, part array<bigint>, near bigint, owner array<bigint>"
    )
    houses = [
        {"id": 1, "name": "a", "rank": 5, "height": {"value": 2.5, "uom": "m"}, "sizes": {"values": [1.0, 2.5], "uom": "m"},
         "shell": [[p(1), p(2)], [p(3)]], "route": [p(1)], "shape": {"surfaces": [[p(4)]], "points": None},
         "lod1Model": {"template": [p(7)], "ref_point": p(0), "transformation": "1 0"},
         "room": [{"id": 10, "use": "bed", "lamp": [{"id": 100, "watts": 3.0}, {"id": 101, "watts": None}]}, {"id": 11, "use": None, "lamp": None}],
         "door": {"id": 50, "colour": "red"}, "address": {"street": "s", "number": None}, "part": [2, 3], "near": 3, "owner": [7, 9]},
        {"id": 2, "name": None, "rank": None, "height": {"value": None, "uom": "m"}, "sizes": None, "shell": None, "route": None,
         "shape": {"surfaces": None, "points": [p(6)]}, "lod1Model": {"template": [p(7)], "ref_point": None, "transformation": None},
         "room": [{"id": 12, "use": "bath", "lamp": None}], "door": None, "address": {"street": None, "number": 4}, "part": None, "near": None, "owner": None},
        {"id": 3, "name": "", "rank": 0, "height": None, "sizes": None, "shell": [[p(9)]], "route": [], "shape": None, "lod1Model": None,
         "room": None, "door": {"id": 51, "colour": None}, "address": None, "part": [4], "near": 1, "owner": [7]},
        {"id": 4, "name": "d", "rank": 1, "height": None, "sizes": None, "shell": None, "route": None, "shape": None, "lod1Model": None,
         "room": None, "door": None, "address": None, "part": None, "near": 4, "owner": None},
    ]
    tables = shred({"House": spark.createDataFrame([tuple(h[c.split()[0]] for c in _columns(schema)) for h in houses], schema)}, model)
    assert tables.violations.count() == 0
    got = records(assemble(tables, model, "House"))
    assert got == [{k: h[k] for k in got[0]} for h in houses]
    assert records(assemble(tables, model, "Lamp")) == [{"id": 100, "watts": 3.0}, {"id": 101, "watts": None}]


def _columns(schema):
    out, depth, start = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            out.append(schema[start:i].strip())
            start = i + 1
    return [*out, schema[start:].strip()]


@pytest.mark.parametrize("seed", range(3))
def test_random_models_come_back(spark, seed):
    """Chains of classes, each nested in the one before or referred to, with random objects."""
    draw = random.Random(seed)
    depth = draw.randint(2, 4)
    kinds = [draw.choice([COMPOSITION, COMPOSITION, AGGREGATION, ASSOCIATION]) for _ in range(depth)]
    many = [draw.random() < 0.7 for _ in range(depth)]
    classes = []
    for i in range(depth + 1):
        properties = (Property(f"p{i}", f"K{i + 1}", 0, None if many[i] else 1, kinds[i]),) if i < depth else ()
        classes.append(ClassType(f"K{i}", (Attribute("label"), Attribute("n", type="long")), properties))
    model = ClassModel(classes)
    next_id = iter(range(1, 10**6))
    flat = {f"K{i}": [] for i in range(depth + 1)}

    def schema(i):
        own = "id bigint, label string, n bigint"
        if i == depth:
            return own
        inner = f"struct<{schema(i + 1).replace(' ', ':').replace(',:', ',')}>" if kinds[i] == COMPOSITION else "bigint"
        return f"{own}, p{i} {f'array<{inner}>' if many[i] else inner}"

    def build(i, top):
        row = {"id": next(next_id), "label": draw.choice([None, "", "x"]), "n": draw.choice([None, draw.randrange(9)])}
        if i < depth:
            found = [build(i + 1, kinds[i] != COMPOSITION) for _ in range(draw.choice([0, 1, 3]) if many[i] else draw.choice([0, 1]))]
            value = found if kinds[i] == COMPOSITION else [f["id"] for f in found]
            row[f"p{i}"] = (value or None) if many[i] else (value[0] if value else None)
        if top:
            flat[f"K{i}"].append(row)
        return row

    for _ in range(6):
        build(0, True)
    frames = {}
    for i in range(depth + 1):
        if flat[f"K{i}"]:
            names = ["id", "label", "n", *[f"p{i}"] * (i < depth)]
            frames[f"K{i}"] = spark.createDataFrame([tuple(r[n] for n in names) for r in flat[f"K{i}"]], schema(i))
    tables = shred(frames, model)
    assert tables.violations.count() == 0
    for name, want in flat.items():
        if want:
            got = records(assemble(tables, model, name))
            by_id = {r["id"]: r for r in got}
            for r in want:
                found = by_id[r["id"]]
                assert all(found.get(k) == v for k, v in r.items()), (r, found)
