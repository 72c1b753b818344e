"""One class model from nested rows to tables, deletes and boxes."""

from helpers import values

from relgraph.operators.cascade import cascade_delete
from relgraph.operators.object_boxes import object_boxes
from relgraph.operators.shred import shred
from relgraph.plans import classes as C
from relgraph.plans.classes import Attribute, ClassModel, ClassType, Property
from relgraph.plans.model_relations import relation_spec
from relgraph.plans.spec import AGGREGATION, COMPOSITION, SET_NULL

MODEL = ClassModel([
    ClassType("Site", (Attribute("name"),), (
        Property("house", "House", kind=COMPOSITION),
        Property("tree", "Plant", kind=AGGREGATION),
        Property("plan", "Plan", 0, 1, AGGREGATION),
    )),
    ClassType("House", (Attribute("shell", C.SURFACE),), (Property("part", "House", kind=COMPOSITION),)),
    ClassType("Plant", (Attribute("lod1Shape", C.IMPLICIT),)),
    ClassType("Garden", (), (Property("plant", "Plant", kind=AGGREGATION),)),
    ClassType("Plan", (Attribute("title"),)),
])

POINT = "struct<x:double,y:double,z:double>"


def p(v):
    return (float(v), float(v), float(v))


def nested(spark):
    shape = f"struct<template:array<{POINT}>,ref_point:{POINT},transformation:string>"
    sites = spark.createDataFrame(
        [
            (1, "a", [(10, [[p(0), p(2)]], [11])], [100, 101], 7),
            (2, "b", [(20, [[p(5), p(9)], [p(4)]], None)], [102], 7),
            (3, "c", None, None, 8),
        ],
        f"id bigint, name string, house array<struct<id:bigint,shell:array<array<{POINT}>>,part:array<bigint>>>, "
        "tree array<bigint>, plan bigint",
    )
    houses = spark.createDataFrame(
        [(11, [[p(7), p(8)]], [])], f"id bigint, shell array<array<{POINT}>>, part array<bigint>"
    )
    plants = spark.createDataFrame(
        [(100, ([p(1)], p(0), None)), (101, ([p(1)], p(0), None)), (102, ([p(2)], p(0), None))],
        f"id bigint, lod1Shape {shape}",
    )
    gardens = spark.createDataFrame([(50, [101])], "id bigint, plant array<bigint>")
    plans = spark.createDataFrame([(7, "shared"), (8, "own")], "id bigint, title string")
    return {"Site": sites, "House": houses, "Plant": plants, "Garden": gardens, "Plan": plans}


def test_relations_of_the_model():
    spec = relation_spec(MODEL)
    found = {(r.table, r.column): r for r in spec.references}
    assert found["house", "site_house_id"].kind == COMPOSITION
    assert found["house", "house_root_id"].is_self
    assert found["site", "plan_id"].on_delete == SET_NULL and found["site", "plan_id"].owned == "target"
    assert spec.owner_columns("plant") == ["garden_plant_id", "site_tree_id"]
    assert spec.keys["surface_geometry"] == "root_id"


def test_shredded_rows_are_deleted_and_rolled_up(spark):
    tables, spec = shred(nested(spark), MODEL, ordered_keys=True), relation_spec(MODEL)
    assert values(tables["house"], "id", "site_house_id", "house_parent_id", "house_root_id") == [
        (10, 1, None, 10), (11, None, 10, 10), (20, 2, None, 20)
    ]
    result = cascade_delete(tables, spec, {"site": spark.range(1, 2)})
    gone = {}
    for table, key in values(result.deleted):
        gone.setdefault(table, set()).add(key)
    assert gone["site"] == {1} and gone["house"] == {10, 11} and gone["plant"] == {100}
    # plan 7 is shared with site 2, the template of plant 100 with plant 101
    assert "plan" not in gone and "implicit_geometry" not in gone
    assert len(gone["surface_geometry"]) == 2
    assert values(result.survivors("plant"), "id", "site_tree_id", "garden_plant_id") == [(101, None, 50), (102, 2, None)]
    assert values(result.blocked) == []

    boxes = object_boxes(tables, MODEL)
    cube = ["id", "box.xmin", "box.zmax"]
    assert values(boxes["house"].selectExpr(*cube)) == [(10, 0.0, 8.0), (11, 7.0, 8.0), (20, 4.0, 9.0)]
    assert values(boxes["site"].selectExpr(*cube)) == [(1, 0.0, 8.0), (2, 2.0, 9.0)]
    assert values(boxes["garden"].selectExpr(*cube)) == [(50, 1.0, 1.0)]


def test_boxes_meet_over_inheritance_and_skip_root_and_stored_boxes(spark):
    model = ClassModel([
        ClassType("Thing", (Attribute("trace", C.LINE),), class_id=1),
        ClassType("House", (Attribute("path", C.LINE), Attribute("boundedBy", C.LINE)), base="Thing", class_id=2),
        ClassType("Town", (), (Property("house", "House", kind=COMPOSITION), Property("near", "House"))),
    ])
    line = f"cast(array(named_struct('x', {{0}}, 'y', {{0}}, 'z', {{0}})) as array<{POINT}>)"
    house = spark.sql(
        f"select 5L as id, {line.format(1)} as trace, {line.format(3)} as path, {line.format(99)} as boundedBy"
    )
    town = spark.sql("select 1L as id, array(5L) as house, array(6L) as near")
    tables = shred({"House": house, "Town": town}, model)
    cube = ["id", "box.xmin", "box.xmax"]
    boxes = object_boxes(tables, model)
    assert values(boxes["thing"].selectExpr(*cube)) == [(5, 1.0, 3.0)]
    assert values(boxes["town"].selectExpr(*cube)) == [(1, 1.0, 3.0)]
    assert values(object_boxes(tables, model, root="Thing", keep=True)["town"].selectExpr(*cube)) == [(1, 3.0, 3.0)]


def test_class_ids_of_shared_keys():
    model = ClassModel([
        ClassType("Base", (Attribute("a"),), class_id=1),
        ClassType("Mid", (Attribute("b"), Attribute("c")), base="Base", class_id=2),
        ClassType("Leaf", (Attribute("d"), Attribute("e")), base="Mid", class_id=3),
    ])
    shared = {(k.sub, k.base): k.class_ids for k in relation_spec(model).shared_keys}
    assert shared == {("mid", "base"): (2, 3), ("leaf", "mid"): (3,)}


def test_a_member_with_a_second_owner_stays(spark):
    model = ClassModel([
        ClassType("Supplier", (), (Property("serves", "Customer", kind=AGGREGATION, reverse="servedBy"),)),
        ClassType("Customer", (), (Property("servedBy", "Supplier", reverse="serves"),)),
    ])
    frames = {
        "Supplier": spark.createDataFrame([(1, [7, 8]), (2, [7])], "id bigint, serves array<bigint>"),
        "Customer": spark.createDataFrame([(7, None), (8, None)], "id bigint, servedBy array<bigint>"),
    }
    tables = shred(frames, model)
    result = cascade_delete(tables, relation_spec(model), {"supplier": spark.createDataFrame([(1,)], "id bigint")})
    assert values(result.deleted) == [("customer", 8), ("supplier", 1)]


def test_deletes_that_came_down_do_not_echo(spark):
    from relgraph.operators import cascade

    model = ClassModel([
        ClassType("Base", (Attribute("a"), Attribute("b")), class_id=1),
        ClassType("Sub", (Attribute("c"), Attribute("d")), base="Base", class_id=2),
        ClassType("Leaf", (Attribute("e"), Attribute("f")), base="Sub", class_id=3),
    ])
    row = "'a' as a, 'b' as b, 'c' as c, 'd' as d, 'e' as e, 'f' as f"
    tables = shred({"Leaf": spark.sql(f"select id, {row} from range(5)"), "Base": spark.sql("select id + 10 as id, 'a' as a, 'b' as b from range(5)")}, model)
    run = cascade.Cascade(tables, relation_spec(model))
    run.run({"base": spark.createDataFrame([(1,), (11,)], "id bigint")})
    assert {t: sorted(r.id for r in run.gone(t).collect()) for t in run.last_step} == {"base": [1, 11], "sub": [1], "leaf": [1]}
    assert run.step == 3
    run = cascade.Cascade(tables, relation_spec(model))
    run.run({"leaf": spark.createDataFrame([(2,)], "id bigint")})
    assert {t: [r.id for r in run.gone(t).collect()] for t in run.last_step} == {"base": [2], "sub": [2], "leaf": [2]}
