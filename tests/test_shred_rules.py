"""Storage decisions of the class model, and shredding on small rows."""

import pytest
from helpers import values

from relgraph.functions import simple_types
from relgraph.operators.shred import shred
from relgraph.plans import classes as C
from relgraph.plans.classes import Attribute, ClassModel, ClassType, Property, Storage
from relgraph.plans.spec import AGGREGATION, COMPOSITION


def family(parent_abstract, *child_properties, children=1, **flags):
    attributes = tuple(Attribute(f"a{i}") for i in range(child_properties[0]))
    types = [ClassType("Parent", abstract=parent_abstract)]
    types += [ClassType(f"Child{i}", attributes, base="Parent", class_id=10 + i) for i in range(children)]
    return ClassModel(types, **flags)


@pytest.mark.parametrize("abstract,properties,children,merged", [
    (True, 0, 2, True), (True, 1, 2, True), (True, 2, 2, False), (True, 2, 1, True),
    (False, 0, 2, False), (False, 1, 1, False),
])
def test_merging_into_an_abstract_parent(abstract, properties, children, merged):
    assert family(abstract, properties, children=children).merges("Child0") is merged


def test_merging_into_a_concrete_parent_is_a_choice():
    assert family(False, 1, merge_into_concrete=True).merges("Child0")
    assert not family(False, 2, merge_into_concrete=True).merges("Child0")


def test_abstract_child_and_foreign_parent_do_not_merge():
    model = ClassModel([
        ClassType("P", abstract=True), ClassType("Q", base="P", abstract=True), ClassType("R", base="P"),
        ClassType("F", abstract=True, foreign=True), ClassType("G", base="F"),
    ])
    assert not model.merges("Q") and model.merges("R") and not model.merges("G")


def test_table_names():
    model = ClassModel([ClassType("AbstractRoadSurface"), ClassType("MyAbstractThing")])
    assert model.table("AbstractRoadSurface") == "roadsurface"
    assert model.table("MyAbstractThing") == "mything"


def storage(prop, *types):
    model = ClassModel([ClassType("Owner", properties=(prop,)), *types])
    return model.storage("Owner", prop)


def test_property_storage():
    plain = ClassType("Item", (Attribute("x"),))
    value = ClassType("Item", (Attribute("x"),), value=True)
    one = Property("part", "Item", 1, 1)
    assert storage(one, value) == Storage(C.INLINE, "owner")
    assert storage(one, plain) == Storage(C.OWN_KEY, "owner", ("part_id",))
    assert storage(Property("part", "Item", 0, 1), value).way == C.OWN_KEY
    assert storage(Property("part", "Item", 1, 1, choice=True), value).way == C.OWN_KEY
    unit = ClassType("Item", (Attribute("x", C.VALUE, "LengthType"),), value=True)
    assert storage(one, unit).way == C.OWN_KEY
    assert storage(one, ClassType("Item", abstract=True, value=True)).way == C.OWN_KEY
    many = Property("part", "Item", kind=COMPOSITION)
    assert storage(many, plain) == Storage(C.CHILD_KEY, "item", ("owner_part_id",))
    assert storage(Property("part", "Item", max=5), plain).way == C.CHILD_KEY
    assert storage(many, ClassType("Item", foreign=True)) == Storage(C.LINK_TABLE, "owner_to_item", ("owner_id", "item_id"))
    own = Property("part", "Owner")
    assert storage(own) == Storage(C.CHILD_KEY, "owner", ("owner_part_id",))
    assert storage(Property("part", "Owner", kind=COMPOSITION)) == Storage(
        C.TREE_KEYS, "owner", ("owner_parent_id", "owner_root_id")
    )


def test_properties_see_merged_tables():
    prop = Property("part", "Small", kind=COMPOSITION)
    model = ClassModel([
        ClassType("Base", properties=(prop,), abstract=True), ClassType("Small", base="Base", class_id=2),
        ClassType("Other", base="Base", class_id=3),
    ])
    assert model.storage("Base", prop).way == C.TREE_KEYS


def test_many_to_many_storage():
    def model(kind_a, kind_b):
        a = Property("bs", "B", kind=kind_a, reverse="as")
        b = Property("as", "A", kind=kind_b, reverse="bs")
        return ClassModel([ClassType("A", properties=(a,)), ClassType("B", properties=(b,))]), a, b

    m, a, b = model("ASSOCIATION", "ASSOCIATION")
    assert m.storage("A", a) == Storage(C.LINK_TABLE, "a_bs_to_b_as", ("a_bs_id", "b_as_id"))
    assert m.storage("B", b).table == "a_bs_to_b_as"
    m, a, b = model(AGGREGATION, "ASSOCIATION")
    assert m.storage("A", a) == Storage(C.MEMBER_KEY, "b", ("a_bs_id",))
    assert m.storage("B", b) == Storage(C.LINK_TABLE, "a_bs_to_b_as", ("b_as_id", "a_bs_id"))


def test_models_are_checked():
    with pytest.raises(ValueError):
        ClassModel([ClassType("A", base="B")])
    with pytest.raises(ValueError):
        ClassModel([ClassType("A", properties=(Property("b", "B"),))])


def test_type_table():
    t = simple_types.spark_type
    assert [t(n) for n in ["token", "boolean", "decimal", "date", "gYear", "unsignedLong", "doubleList", "nosuch"]] == [
        "string", "boolean", "double", "timestamp_ntz", "date", "bigint", "string", "string"
    ]
    assert len(simple_types.VALUE_PARTS) == 12


def test_value_parts(spark):
    df = spark.sql("select 1 as id, named_struct('value', '3', 'unit', 'd', 'radix', '10', 'factor', 'bad') as t")
    model = ClassModel([ClassType("X", (Attribute("t", C.VALUE, "TimeIntervalLengthType"),))])
    out = shred({"X": df}, model)["x"].first().asDict()
    assert out == {"id": 1, "t_unit": "d", "t_radix": 10, "t_factor": None, "t": 3.0}


def test_nested_two_levels_nulls_and_empty_arrays(spark):
    model = ClassModel([
        ClassType("House", (Attribute("name"),), (Property("room", "Room", kind=COMPOSITION),)),
        ClassType("Room", (Attribute("name"),), (Property("door", "Door", kind=COMPOSITION),)),
        ClassType("Door", (Attribute("color", C.ENUM),)),
    ])
    schema = "id bigint, name string, room array<struct<name:string,door:array<struct<color:string>>>>"
    df = spark.createDataFrame(
        [
            (1, "h1", [("r1", [("red",), None, ("blue",)]), None, ("r2", [])]),
            (2, "h2", []),
            (3, "h3", None),
            (4, "h4", [("r1", None)]),
        ],
        schema,
    )
    t = shred({"House": df}, model)
    assert values(t["house"]) == [(1, "h1"), (2, "h2"), (3, "h3"), (4, "h4")]
    assert values(t["room"], "id", "house_room_id", "name") == [(1, 1, "r1"), (2, 1, "r2"), (3, 4, "r1")]
    assert values(t["door"], "id", "room_door_id", "color") == [(1, 1, "red"), (2, 1, "blue")]


def test_given_and_nested_rows_of_one_class_do_not_share_keys(spark):
    model = ClassModel([
        ClassType("A", (), (Property("first", "B", kind=COMPOSITION), Property("second", "B", kind=COMPOSITION))),
        ClassType("B", (Attribute("x"),)),
    ])
    a = spark.createDataFrame(
        [(1, [("p",)], [("q",), ("r",)])], "id bigint, first array<struct<x:string>>, second array<struct<x:string>>"
    )
    b = spark.createDataFrame([(41, "given")], "id bigint, x string")
    t = shred({"B": b, "A": a}, model)
    assert values(t["b"], "id", "x", "a_first_id", "a_second_id") == [
        (41, "given", None, None), (42, "p", 1, None), (43, "q", None, 1), (44, "r", None, 1)
    ]


def test_missing_target_rows_are_an_error(spark):
    model = ClassModel([ClassType("A", (), (Property("b", "B"),)), ClassType("B")])
    a = spark.sql("select 1L as id, array(5L) as b")
    with pytest.raises(ValueError, match="no rows were given"):
        shred({"A": a}, model)


def test_inheritance_with_three_levels(spark):
    model = ClassModel([
        ClassType("AbstractThing", (Attribute("a"),), abstract=True, class_id=1),
        ClassType("Mid", (Attribute("b"), Attribute("c")), base="AbstractThing", class_id=2),
        ClassType("Low", (Attribute("d"), Attribute("e")), base="Mid", class_id=3),
        ClassType("Tiny", (Attribute("t"),), base="AbstractThing", class_id=4),
    ])
    low = spark.sql("select 1L as id, 'a' as a, 'b' as b, 'c' as c, 'd' as d, 'e' as e")
    tiny = spark.sql("select 2L as id, 'z' as a, 't' as t")
    t = shred({"Low": low, "Tiny": tiny}, model)
    assert values(t["thing"], "id", "a", "t", "objectclass_id") == [(1, "a", None, 3), (2, "z", "t", 4)]
    assert values(t["mid"]) == [(1, "b", "c", 3)] and values(t["low"]) == [(1, "d", "e")]


@pytest.fixture
def frame(spark):
    return lambda schema, data: spark.createDataFrame(data, schema)


def test_null_ids_and_ids_beside_generated_keys(frame):
    model = ClassModel([
        ClassType("Order", (), (Property("buyer", "Person", 0, 1), Property("agent", "Person", 0, 1), Property("line", "Line", kind=COMPOSITION))),
        ClassType("Person", (Attribute("name"),)), ClassType("Line", (Attribute("text"),)),
    ])
    df = frame(
        "id bigint, buyer struct<id:bigint,name:string>, agent struct<name:string>, line array<struct<ID:bigint,text:string>>",
        [(7, (1, "ann"), ("bob",), [(5, "x"), (None, "y"), (None, "z")]), (8, (None, "cy"), None, None)],
    )
    t = shred({"Order": df}, model)
    people = dict(values(t["person"], "name", "id"))
    assert len(people) == 3 and len(set(people.values())) == 3 and people["ann"] == 1
    assert values(t["order"], "id", "buyer_id", "agent_id") == [(7, 1, people["bob"]), (8, people["cy"], None)]
    lines = {text: (i, owner) for i, text, owner in values(t["line"], "id", "text", "order_line_id")}
    assert lines["x"] == (5, 7) and lines["y"][1] == lines["z"][1] == 7 and len({i for i, _ in lines.values()}) == 3
    assert values(t.violations) == []


def test_what_cannot_be_stored_is_reported(frame):
    model = ClassModel([
        ClassType("A", (), (Property("kid", "K", kind=COMPOSITION), Property("one", "K", 0, 1))), ClassType("K", (Attribute("n"),)),
    ])
    a = frame("id bigint, kid array<struct<id:bigint,n:string>>, one array<bigint>", [(1, [(5, "p")], [5, 6]), (2, [(5, "q"), (6, "r")], [6])])
    t = shred({"A": a}, model)
    assert values(t["a"], "id", "one_id") == [(1, 5), (2, 6)]
    assert values(t["k"], "id", "a_kid_id") == [(5, 1), (6, 2)]
    assert sorted(values(t.violations), key=str) == sorted(
        [("a", "1", "one_id", "6"), ("k", "5", "a_kid_id", "2"), ("k", "5", "(content)", None)], key=str)
    assert [values(shred({"A": a}, model)["k"]) for _ in range(3)] == [values(t["k"])] * 3


def test_column_names_in_any_case_and_unknown_ones(frame):
    model = ClassModel([ClassType("A", (Attribute("name"),))])
    assert values(shred({"A": frame("ID bigint, Name string", [(1, "x")])}, model)["a"]) == [(1, "x")]
    with pytest.raises(ValueError, match="does not know: extra"):
        shred({"A": frame("id bigint, extra string", [(1, "x")])}, model)


def test_a_key_given_and_nested_is_one_column(frame):
    model = ClassModel([
        ClassType("Top", (), (Property("a", "A", kind=COMPOSITION),)), ClassType("A", (), (Property("plan", "Plan", 0, 1),)), ClassType("Plan", (Attribute("t"),)),
    ])
    top = frame("id bigint, a array<struct<id:bigint,plan:struct<t:string>>>", [(1, [(10, ("n",))])])
    t = shred({"Top": top, "A": frame("id bigint, plan bigint", [(11, 70)]), "Plan": frame("id bigint, t string", [(70, "given")])}, model)
    assert sorted(t["a"].columns) == ["id", "plan_id", "top_a_id"]
    assert values(t["a"], "id", "plan_id") == [(10, 71), (11, 70)]


def test_random_models_share_no_column_between_targets():
    import random

    draw = random.Random(4)
    for _ in range(60):
        names = [f"C{i}" for i in range(8)]
        types = []
        for i, n in enumerate(names):
            properties = {
                f"p{draw.randrange(3)}": draw.choice(names) for _ in range(draw.randint(0, 2))
            }
            types.append(ClassType(n, (), tuple(Property(p, t, 0, draw.choice([1, None])) for p, t in properties.items()),
                                   base=draw.choice([None, *names[:i]]) if i else None, abstract=draw.random() < 0.5, foreign=draw.random() < 0.2, class_id=i))
        model = ClassModel(types)
        seen = {}
        for c in types:
            for p in c.properties:
                where = model.storage(c.name, p)
                if where.way == C.OWN_KEY:
                    key, target = (where.table, where.columns[0]), model.table(p.target)
                elif where.way == C.LINK_TABLE:
                    key, target = where.table, (model.table(p.target), p.name)
                else:
                    continue
                assert seen.setdefault(key, target) == target


def test_the_canonical_text_tells_all_contents_apart(spark):
    from relgraph.functions.canonical import canonical

    cases = {
        "timestamp": ["timestamp'2020-01-01 00:00:00.000001'", "timestamp'2020-01-01 00:00:00.000002'", "timestamp'2020-01-01'"],
        "timestamp_ntz": ["timestamp_ntz'2020-01-01 00:00:00.000001'", "timestamp_ntz'2020-01-01'"],
        "double": ["0d", "-0d", "double('nan')", "double('inf')", "0.1d", "0.1d + 1e-16", "0.30000000000000004d", "0.3d"],
        "string": ["''", "'~'", "'null'", "'a;1:b'", "'a'"],
        "array<string>": ["array()", "array('')", "array('', '')", "array(null)", "array('a,1:b')", "array('a', 'b')", "array('~')"],
        "map<string,int>": ["map('a', 1)", "map('a', null)", "map()", "map('a', 1, 'b', 2)"],
        "struct<a:string,b:string>": ["struct('', null)", "struct(null, '')", "struct('a', 'b')", "struct('a;1:b', null)"],
        "binary": ["x''", "x'00'", "cast('0' as binary)"],
        "date": ["date'2020-01-01'", "date'0001-01-01'"],
        "decimal(10,2)": ["1.00", "1.10"],
        "boolean": ["true", "false"],
    }
    for kind, values_ in cases.items():
        df = spark.sql(" union all ".join(f"select cast({v} as {kind}) as v" for v in [*values_, "null"]))
        texts = [r[0] for r in df.select(canonical(df["v"], df.schema["v"].dataType)).collect()]
        assert None not in texts and len(set(texts)) == len(values_) + 1, (kind, texts)
    same = spark.sql("select map('a', 1, 'b', 2) as v union all select map('b', 2, 'a', 1)")
    assert len({r[0] for r in same.select(canonical(same["v"], same.schema["v"].dataType)).collect()}) == 1


def test_bad_values_of_all_levels_are_counted(spark, rows):
    model = ClassModel([
        ClassType("Order", (Attribute("n", type="int"), Attribute("w", C.VALUE, "LengthType"), Attribute("t", C.PERIOD)), (
            Property("line", "Line", kind=COMPOSITION), Property("note", "Note", 1, 1, COMPOSITION),
        )),
        ClassType("Line", (Attribute("share", type="double"),)),
        ClassType("Note", (Attribute("day", type="gDay"),), value=True),
    ])
    schema = "id bigint, n string, w struct<value:string,uom:string>, t struct<begin:string,end:string>, line array<struct<share:string>>, note struct<day:string>"
    data = [
        (1, "1", ("2.5", "m"), ("2020-01-01", "soon"), [("0.5",), ("half",)], ("2020-01-01",)),
        (2, "one", ("wide", None), (None, None), [("all",), (None,)], ("never",)),
        (3, None, None, None, None, None),
    ]
    tables = shred({"Order": spark.createDataFrame(data, schema)}, model)
    assert values(tables.bad_values) == [
        ("line", "share", 2, "all"), ("order", "n", 1, "one"), ("order", "note_day", 1, "never"),
        ("order", "t_endposition", 1, "soon"), ("order", "w", 1, "wide"),
    ]
    assert shred({"Order": rows("id bigint, n string", [(1, "5")])}, model).bad_values.count() == 0
