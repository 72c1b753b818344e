"""Envelope semantics on literal rows."""

import math
import random

import pytest
from helpers import values
from pyspark.sql import functions as F

from relgraph.functions import boxes as B
from relgraph.operators import envelope as E
from relgraph.plans.staging import Staging


def boxed(rows, data):
    """(id, box) rows from (id, low, high) cubes; None is a null box."""
    df = rows("id bigint, lo double, hi double", data)
    box = F.struct(*[F.col(c).alias(s) for c, s in zip(["lo"] * 3 + ["hi"] * 3, B.SIDES)])
    return df.select("id", F.when(F.col("lo").isNotNull(), box).alias("box"))


def cubes(df):
    return values(df.select("id", F.col("box.xmin").alias("lo"), F.col("box.zmax").alias("hi")))


def placed(spark, matrix, ref=(0.0, 0.0, 0.0), corners=4, low=0.0, high=1.0):
    box = F.struct(*[F.lit(v).alias(s) for v, s in zip([low] * 3 + [high] * 3, B.SIDES)])
    point = F.lit(None).cast(B.POINT_TYPE) if ref is None else B.point(*[F.lit(v) for v in ref])
    df = spark.range(1).select(F.lit(matrix).alias("m"), point.alias("r"), box.alias("b"))
    row = df.select(B.place("b", B.matrix("m"), "r", corners).alias("box")).first()["box"]
    return [round(v, 6) for v in row]


def test_merge_is_null_safe_and_merges_super_and_local(rows):
    a = boxed(rows, [(1, 0, 10), (2, None, None), (3, 1, 2), (4, None, None)])
    b = boxed(rows, [(1, 5, 6), (2, 5, 6), (3, None, None), (4, None, None)]).withColumnRenamed("box", "other")
    both = a.join(b, "id").select("id", B.merge_box("box", "other").alias("box"))
    assert cubes(both) == [(1, 0.0, 10.0), (2, 5.0, 6.0), (3, 1.0, 2.0), (4, None, None)]
    assert both.where("box is null").count() == 1
    assert cubes(E.combine(a, b.withColumnRenamed("other", "box"))) == cubes(both)


def test_extent_of_nothing_is_null(spark):
    df = spark.sql("select 1 as id, array() as g union all select 2, null")
    df = df.select("id", F.col("g").cast("array<struct<x:double,y:double,z:double>>").alias("g"))
    assert E.inline_contribution(df, ["g"]).count() == 0


def test_identity_and_reference_point(spark):
    assert placed(spark, None) == [0, 0, 0, 1, 1, 1]
    assert placed(spark, None, (1.0, 2.0, 3.0)) == [1, 2, 3, 2, 3, 4]
    assert placed(spark, "1 0 0 5 0 1 0 6 0 0 1 7", None) == [5, 6, 7, 6, 7, 8]
    assert placed(spark, " 1 0 0 5  0 1 0 6 0 0   1 7 0 0 0 1 ", (1.0, 1.0, 1.0)) == [6, 7, 8, 7, 8, 9]


def test_four_corners_differ_from_eight_about_x_only(spark):
    s = math.sqrt(0.5)
    about_x = f"1 0 0 0 0 {s} {-s} 0 0 {s} {s} 0"
    about_z = f"{s} {-s} 0 0 {s} {s} 0 0 0 0 1 0"
    assert placed(spark, about_x) == [0, 0, 0, 1, 0, 1.414214]
    assert placed(spark, about_x, corners=8) == [0, -0.707107, 0, 1, 0.707107, 1.414214]
    assert placed(spark, about_z) == placed(spark, about_z, corners=8) == [-0.707107, 0, 0, 0.707107, 1.414214, 1]


@pytest.mark.parametrize("matrix", ["1 0 0 5 0 1 0 6 0 0 1", "1 0 0 x 0 1 0 6 0 0 1 7"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_malformed_matrix_is_an_error(spark, matrix, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        malformed_matrix(spark, matrix)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def malformed_matrix(spark, matrix):
    with pytest.raises(Exception, match="at least 12 numbers"):
        placed(spark, matrix)


def test_ring_and_reference_system(spark):
    df = spark.sql("select 0 as srid union all select null union all select 4979")
    assert sorted(r[0] for r in df.select(B.ring_srid("srid", 25832)).collect()) == [4979, 25832, 25832]
    box = F.struct(*[F.lit(float(v)).alias(s) for v, s in zip(range(6), B.SIDES)])
    points = [tuple(p) for p in spark.range(1).select(B.ring(box)).first()[0]]
    assert points == [(0, 1, 2), (3, 1, 2), (3, 4, 5), (0, 4, 5), (0, 1, 2)]


def test_collection_skips_objects_with_an_envelope_by_default(rows):
    boxes = boxed(rows, [(1, 0, 1), (2, 5, 9), (3, 3, 4)])
    objects = rows("id bigint, objectclass_id int", [(1, 7), (2, 7), (3, 8)]).join(
        boxed(rows, [(2, 0, 0)]).withColumnRenamed("box", "envelope"), "id", "left"
    )

    def run(**kw):
        out = E.collection_envelope(objects, boxes, **kw).collect()
        assert len(out) == 1
        return out[0]["box"] and (out[0]["box"]["xmin"], out[0]["box"]["xmax"])

    assert run() == (0, 4)
    assert run(only_if_null=False) == (0, 9)
    assert run(class_id=7) == (0, 1)
    assert run(class_id=7, only_if_null=False) == (0, 9)
    assert run(class_id=99) is None


def test_write_back_touches_only_targets(rows):
    objects = boxed(rows, [(1, 0, 1), (2, 0, 1), (3, 0, 1)]).withColumnRenamed("box", "envelope")
    boxes = boxed(rows, [(1, 5, 6), (2, 5, 6)])
    done = E.write_back(objects, boxes, rows("id bigint", [(1,), (3,)])).withColumnRenamed("envelope", "box")
    assert cubes(done) == [(1, 5.0, 6.0), (2, 0.0, 1.0), (3, None, None)]
    # without targets an object without a new box keeps its envelope
    done = E.write_back(objects, boxes).withColumnRenamed("envelope", "box")
    assert cubes(done) == [(1, 5.0, 6.0), (2, 5.0, 6.0), (3, 0.0, 1.0)]


def test_template_with_surfaces_only_and_own_geometry_only(spark):
    geometry = "array(named_struct('x', {0}D, 'y', {0}D, 'z', {0}D))"
    templates = spark.sql(
        f"select 1 as id, {geometry.format(1)} as relative_other_geom, null as relative_brep_id "
        "union all select 2, null, 9 union all select 3, null, 77 "
        f"union all select 4, {geometry.format(4)}, 9"
    )
    surfaces = spark.sql(
        f"select 9 as root_id, {geometry.format(5)} as implicit_geometry union all select 9, {geometry.format(8)} "
        "union all select 9, null"
    )
    assert cubes(E.template_boxes(templates, surfaces)) == [(1, 1.0, 1.0), (2, 5.0, 8.0), (4, 4.0, 8.0)]


def brute_boxes(own, edges):
    """id -> (low, high) around all nodes reachable downwards."""
    below = {}
    for p, c in edges:
        below.setdefault(p, set()).add(c)
    out = {}
    for start in {i for e in edges for i in e} | set(own):
        seen, todo = set(), [start]
        while todo:
            n = todo.pop()
            if n not in seen:
                seen.add(n)
                todo += below.get(n, ())
        found = [own[n] for n in seen if n in own]
        if found:
            out[start] = (min(f[0] for f in found), max(f[1] for f in found))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_recursive_roll_up_of_trees_links_and_cycles(rows, seed):
    r = random.Random(seed)
    up = {i: r.choice([None, r.randrange(25)]) for i in range(25)}
    own = {i: (float(r.randrange(50)), float(r.randrange(50, 99))) for i in range(25) if r.random() < 0.7}
    tree = rows("id bigint, up bigint", list(up.items()))
    boxes = boxed(rows, [(i, *b) for i, b in own.items()])
    want = [(i, *b) for i, b in brute_boxes(own, [(p, c) for c, p in up.items() if p is not None]).items()]
    want = sorted(want, key=lambda t: str(t[0]))
    by_rounds = E.roll_up({"t": tree}, {"t": "id"}, {"t": boxes}, [E.Part("t", "t", "up")])["t"]
    assert sorted(cubes(by_rounds), key=lambda t: str(t[0])) == want
    by_doubling = E.roll_up_tree(tree, boxes, parent="up")
    assert sorted(cubes(by_doubling), key=lambda t: str(t[0])) == want
    links = [(r.randrange(25), r.randrange(25)) for _ in range(30)]
    link = rows("o bigint, m bigint", links)
    by_link = E.roll_up({"t": tree, "l": link}, {"t": "id"}, {"t": boxes}, [E.Part("t", "t", "o", "link", "l", "m")])["t"]
    want = sorted([(i, *b) for i, b in brute_boxes(own, links).items()], key=lambda t: str(t[0]))
    assert sorted(cubes(by_link), key=lambda t: str(t[0])) == want


def counted_steps(monkeypatch):
    from relgraph.plans.staging import Staging

    steps = []
    keep = Staging.keep_counting
    monkeypatch.setattr(Staging, "keep_counting", lambda self, *a, **b: (steps.append(1), keep(self, *a, **b))[1])
    return steps


@pytest.mark.parametrize("seed", range(4))
def test_any_graph_of_rows(spark, rows, seed):
    """Rows with no, one or several parents, in rings and out of them, also over two tables."""
    r = random.Random(100 + seed)
    n = 40
    edges = [(i, r.randrange(n)) for i in range(n) for _ in range(r.choice([0, 1, 1, 1, 2, 3] if seed % 2 else [0, 1, 1, 1, 1]))]
    own = {i: (float(r.randrange(50)), float(r.randrange(50, 99))) for i in range(n) if r.random() < 0.6}
    want = sorted((i, *b) for i, b in brute_boxes(own, [(p, c) for c, p in edges]).items())
    frame = E.close_boxes(rows("id bigint, up bigint", [*edges, (None, 3), (3, None)]), boxed(rows, [(i, *b) for i, b in own.items()]), Staging(spark))
    assert sorted(cubes(frame)) == want
    # the same rows dealt over two tables with keys of different types, the edges over all three ways
    odd = lambda i: i % 2 == 1
    a = rows("id bigint, box_up string", [(i, None) for i in range(n) if not odd(i)])
    b = rows("id string, a_id bigint", [(f"x{i}", None) for i in range(n) if odd(i)])
    tables, parts = {"a": a, "b": b}, []
    for oc, op in sorted({(odd(c), odd(p)) for c, p in edges}):
        name = f"l{oc:d}{op:d}"
        mine = [(c if not oc else f"x{c}", p if not op else f"x{p}") for c, p in edges if (odd(c), odd(p)) == (oc, op)]
        kinds = ["string" if o else "bigint" for o in (oc, op)]
        tables[name] = rows(f"c {kinds[0]}, p {kinds[1]}", mine)
        parts.append(E.Part("b" if op else "a", "b" if oc else "a", "p", "link", name, "c"))
    geometry = {
        "a": boxed(rows, [(i, *x) for i, x in own.items() if not odd(i)]),
        "b": boxed(rows, [(i, *x) for i, x in own.items() if odd(i)]).selectExpr("concat('x', id) as id", "box"),
    }
    out = E.roll_up(tables, {"a": "id", "b": "id"}, geometry, parts)
    got = [(i, lo, hi) for t in ("a", "b") if t in out for i, lo, hi in cubes(out[t])]
    assert sorted((int(str(i).lstrip("x")), lo, hi) for i, lo, hi in got) == want


def test_a_ring_and_a_deep_nesting_take_few_rounds(rows, monkeypatch):
    n = 1000
    ring = rows("id bigint, up bigint", [*[(i, (i + 1) % n) for i in range(n)], (n, 0), (n + 1, n)])
    boxes = boxed(rows, [(0, 5, 6), (500, 1, 2), (n + 1, 7, 8)])
    steps = counted_steps(monkeypatch)
    got = sorted(cubes(E.roll_up_tree(ring, boxes, parent="up")))
    assert got == [*[(i, 1.0, 8.0) for i in range(n)], (n, 7.0, 8.0), (n + 1, 7.0, 8.0)]
    assert len(steps) <= 28
    # a holds b holds a ..., 2 * n levels
    tables = {"a": rows("id bigint, b_id bigint", [(i, i - 1 if i else None) for i in range(n)]), "b": rows("id bigint, a_id bigint", [(i, i) for i in range(n)])}
    parts = [E.Part("b", "a", "b_id"), E.Part("a", "b", "a_id")]
    steps.clear()
    out = E.roll_up(tables, {"a": "id", "b": "id"}, {"b": boxed(rows, [(n - 1, 3, 4), (10, 1, 2)])}, parts)
    want = [(i, 1.0 if i <= 10 else 3.0, 4.0) for i in range(n)]
    assert sorted(cubes(out["a"])) == want == sorted(cubes(out["b"]))
    assert len(steps) <= 32


def test_rounds_read_only_what_still_moves(rows, monkeypatch):
    """One long chain beside many short ones: later rounds hold the rows of the long one only."""
    from relgraph.plans.staging import Staging

    sizes = []
    keep = Staging.keep_counting

    def noted(self, df, condition, label="step"):
        out = keep(self, df, condition, label)
        if label == "steps":
            sizes.append(out[1])
        return out

    monkeypatch.setattr(Staging, "keep_counting", noted)
    chain = [(i, i + 1) for i in range(64)]
    short = [(10_000 + 2 * i, 10_001 + 2 * i) for i in range(2000)]
    E.roll_up_tree(rows("id bigint, up bigint", chain + short), boxed(rows, [(0, 1, 2)]), parent="up")
    assert sizes[0] == 2064 and sizes[1:] == [63, 61, 57, 49, 33, 1, 0]


def test_rounds_broadcast_small_frames_only(spark, rows, monkeypatch):
    """Frames of more rows than the bound meet in shuffles: what goes to the driver does not grow with the table."""
    n, plans, keep = 120, [], Staging.keep_counting

    def noted(self, df, condition, label="step"):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return keep(self, df, condition, label)

    monkeypatch.setattr(Staging, "keep_counting", noted)
    edges = [(i, i - i % 8 + (i + 1) % 8) for i in range(n)] + [(i, i // 2) for i in range(0, n, 7)]
    own = {i: (i, i) for i in range(0, n, 3)}

    def closed():
        plans.clear()
        frame = E.close_boxes(rows("id bigint, up bigint", edges), boxed(rows, [(i, *b) for i, b in own.items()]), Staging(spark))
        return sorted(cubes(frame)), {label for label, plan in plans if "BroadcastHashJoin" in plan}

    got, some = closed()
    assert some >= {"grown", "state", "steps", "moved"}
    monkeypatch.setattr("relgraph.plans.staging.BROADCAST_ROWS", 0, raising=False)
    again, some = closed()
    assert some <= {"start"}  # one join before the rounds
    assert again == got == sorted((i, *map(float, b)) for i, b in brute_boxes(own, [(up, i) for i, up in edges]).items())


def test_parents_contain_their_children_and_repeated_parts_count_once(rows):
    tables = {"p": rows("id bigint, c_id bigint", [(1, 10), (2, None)]), "c": rows("id bigint, p_id bigint", [(10, 2), (11, 2)])}
    parts = [E.Part("p", "c", "p_id"), E.Part("p", "c", "p_id"), E.Part("p", "c", "c_id", "parent")]
    out = E.roll_up(tables, {"p": "id", "c": "id"}, {"c": boxed(rows, [(10, 0, 1), (11, 4, 6)])}, parts)
    assert cubes(out["p"]) == [(1, 0.0, 1.0), (2, 0.0, 6.0)]
