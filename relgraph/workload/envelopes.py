"""Envelope queries.  A line item is a point: quantity, price, discount."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relgraph.functions import boxes as B
from relgraph.operators import envelope as E
from relgraph.workload.tables import TREE_PARENT_SQL, event_tables, part_tree, table, trade_tables

POINT = ("l_quantity", "l_extendedprice", "l_discount")
KEYS = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "orders": "o_orderkey"}
PARTS = [
    E.Part("region", "nation", "n_regionkey"),
    E.Part("nation", "customer", "c_nationkey"),
    E.Part("customer", "orders", "o_custkey"),
]


def _flat(boxes: DataFrame) -> DataFrame:
    return boxes.select("id", *B.sides())


def _order_boxes(spark: SparkSession, folder: str) -> DataFrame:
    return E.extent(table(spark, folder, "lineitem"), "l_orderkey", *POINT)


def _levels(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    tables = trade_tables(spark, folder)
    return E.roll_up(tables, KEYS, {"orders": _order_boxes(spark, folder)}, PARTS)


def order_boxes(spark, folder):
    return _flat(_order_boxes(spark, folder))


def customer_boxes(spark, folder):
    return _flat(
        E.child_key_contribution(
            table(spark, folder, "orders"), "o_custkey", _order_boxes(spark, folder), "o_orderkey"
        )
    )


def nation_boxes(spark, folder):
    return _flat(_levels(spark, folder)["nation"])


def region_boxes(spark, folder):
    return _flat(_levels(spark, folder)["region"])


def merged_boxes(spark, folder):
    """Pairwise merge of the boxes of returned and of other lines, either of
    which may be missing."""
    line = table(spark, folder, "lineitem")
    a = E.extent(line.where("l_returnflag = 'R'"), "l_orderkey", *POINT)
    b = E.extent(line.where("l_returnflag <> 'R'"), "l_orderkey", *POINT)
    both = a.join(b.withColumnRenamed("box", "other"), "id", "full")
    return _flat(both.select("id", B.merge_box("box", "other").alias("box")))


def parent_key_boxes(spark, folder):
    """Orders as parents that hold the key of their customer's box."""
    customers = E.child_key_contribution(
        table(spark, folder, "orders"), "o_custkey", _order_boxes(spark, folder), "o_orderkey"
    )
    return _flat(E.parent_key_contribution(table(spark, folder, "orders"), "o_custkey", customers, "o_orderkey"))


def part_link_boxes(spark, folder):
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        B.box_of_point(B.point("p_size", "p_retailprice", F.col("p_partkey") % 10)).alias("box"),
    )
    return _flat(E.link_contribution(table(spark, folder, "lineitem"), "l_orderkey", "l_partkey", parts))


def collection_box(spark, folder):
    objects = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("objectclass_id")
    )
    return E.collection_envelope(objects, _order_boxes(spark, folder), "F", only_if_null=False).select(*B.sides())


def collection_box_if_null(spark, folder):
    """Only the orders without a stored envelope; urgent ones have one."""
    objects = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", B.box_of_point(B.point(F.lit(0), F.lit(0), F.lit(0)))).alias(
            "envelope"
        ),
    )
    return E.collection_envelope(objects, _order_boxes(spark, folder)).select(*B.sides())


def _points(*xyz) -> F.Column:
    return F.array(B.point(*xyz))


def inline_surface_boxes(spark, folder):
    """Orders with an inline point, and their lines as surfaces; both with
    missing geometries."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") != "P", _points("o_totalprice", F.lit(0), F.lit(0))).alias("centroid"),
        F.col("o_orderkey").alias("solid_id"),
    )
    surfaces = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("root_id"),
        F.when(F.col("l_returnflag") != "R", _points(*POINT)).alias("geometry"),
    )
    return _flat(
        E.combine(
            E.inline_contribution(orders, ["centroid"]),
            E.surface_contribution(orders, "solid_id", surfaces),
        )
    )


def box_ring(spark, folder):
    rings = _order_boxes(spark, folder).select("id", F.posexplode(B.ring("box")).alias("n", "p"))
    return rings.select(
        "id", "n", "p.x", "p.y", "p.z", B.ring_srid(F.when(F.col("n") > 0, F.lit(0)).otherwise(4979), 25832).alias("srid")
    )


def _templates(spark: SparkSession, folder: str) -> DataFrame:
    """One template per brand: an own geometry and a surface tree."""
    parts = table(spark, folder, "part")
    brand = F.expr("cast(substring(p_brand, 7) as int)")
    own = (
        parts.groupBy(brand.alias("id"))
        .agg(F.min("p_retailprice").alias("low"))
        .select("id", _points(F.lit(0), "low", F.lit(0)).alias("relative_other_geom"), F.col("id").alias("relative_brep_id"))
    )
    surfaces = parts.select(
        brand.alias("root_id"), _points("p_size", "p_retailprice", F.col("p_partkey") % 10).alias("implicit_geometry")
    )
    return E.template_boxes(own, surfaces)


def template_boxes(spark, folder):
    return _flat(_templates(spark, folder))


MATRIX = (
    "concat_ws(' ', s_suppkey % 3 + 1, s_suppkey % 5, 0, s_suppkey % 7, -(s_suppkey % 5), s_suppkey % 3 + 1, 0,"
    " s_suppkey % 11, 0, 0, 1, s_suppkey % 13, 0, 0, 0, 1)"
)


def placed_templates(spark, folder):
    """Each supplier places one template, some without matrix or point."""
    uses = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"),
        (F.col("s_suppkey") % 30).cast("int").alias("rep"),
        F.when(F.col("s_nationkey") != 3, B.point("s_acctbal", F.lit(0), F.lit(0))).alias("ref"),
        F.when(F.col("s_nationkey") != 5, F.expr(MATRIX)).alias("m"),
    )
    placed = E.implicit_contribution(uses, "rep", "ref", "m", _templates(spark, folder))
    return placed.select("id", *[F.round(c, 6).alias(s) for c, s in zip(B.sides(), B.SIDES)])


def inherited_boxes(spark, folder):
    """Base, sub and hook tables of the events each hold part of the box."""
    t = event_tables(spark, folder)
    base = t["object"].select("id", B.box_of_point(B.point("user_id", F.lit(0), F.lit(0))).alias("box"))
    subs = [
        t[name].select("id", B.box_of_point(B.point(F.lit(n), "value", F.lit(0))).alias("box"))
        for n, name in enumerate(["click", "view", "signup", "purchase"])
    ]
    hook = t["extra"].select("id", B.box_of_point(B.point(F.lit(0), F.lit(0), F.length("props"))).alias("box"))
    return _flat(E.combine(base, *subs, hook))


def write_back(spark, folder):
    """Envelopes of the customers outside one segment are replaced."""
    zero = B.box_of_point(B.point(F.lit(0), F.lit(0), F.lit(0)))
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), "c_mktsegment", zero.alias("envelope")
    )
    boxes = E.extent(table(spark, folder, "events"), "user_id", "value", "value", "event_id")
    out = E.write_back(customers, boxes, customers.where("c_mktsegment <> 'BUILDING'"))
    return out.select("id", "c_mktsegment", *B.sides("envelope"))


def _part_points(spark, folder) -> DataFrame:
    return part_tree(spark, folder).select(
        "id", B.box_of_point(B.point("p_size", F.lit(0), F.col("id"))).alias("box")
    )


def tree_boxes(spark, folder):
    """Boxes of the part tree by doubling pointers."""
    return _flat(E.roll_up_tree(part_tree(spark, folder), _part_points(spark, folder)))


def recursive_boxes(spark, folder):
    """The same tree as a table that contains itself, level by level."""
    tree = part_tree(spark, folder)
    rolled = E.roll_up({"part": tree}, {"part": "id"}, {"part": _part_points(spark, folder)}, [E.Part("part", "part", "parent_id")])
    return _flat(rolled["part"])


def cyclic_boxes(spark, folder):
    """Rings of 40 parts that hold each other; every seventh part also lies in another part."""
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("id"), "p_size")
    last = F.col("id") - F.col("id") % 40
    rings = parts.select("id", (last + (F.col("id") + 1) % 40).alias("ring_id"))
    also = parts.where("id % 7 = 0").select(F.col("id").alias("member_id"), F.expr("id div 2").alias("owner_id"))
    own = parts.where("id % 3 = 0").select("id", B.box_of_point(B.point("p_size", F.lit(0), F.col("id"))).alias("box"))
    ways = [E.Part("part", "part", "ring_id"), E.Part("part", "part", "owner_id", "link", "also", "member_id")]
    return _flat(E.roll_up({"part": rings, "also": also}, {"part": "id"}, {"part": own}, ways)["part"])


QUERIES = {
    f.__name__: f
    for f in [
        order_boxes,
        customer_boxes,
        nation_boxes,
        region_boxes,
        merged_boxes,
        parent_key_boxes,
        part_link_boxes,
        collection_box,
        collection_box_if_null,
        inline_surface_boxes,
        box_ring,
        template_boxes,
        placed_templates,
        inherited_boxes,
        write_back,
        tree_boxes,
        recursive_boxes,
        cyclic_boxes,
    ]
}


def _minmax(x: str, y: str, z: str) -> str:
    low = ", ".join(f"min({v})::double as {n}" for v, n in zip((x, y, z), B.LOW))
    high = ", ".join(f"max({v})::double as {n}" for v, n in zip((x, y, z), B.HIGH))
    return f"{low}, {high}"


_LINES = _minmax(*POINT)
_BRAND = "cast(substring(p_brand, 7) as int)"
_TEMPLATE_SQL = f"""
    select id, {_minmax('x', 'y', 'z')} from (
        select {_BRAND} as id, p_size::double as x, p_retailprice as y, (p_partkey % 10)::double as z from part
        union all select {_BRAND}, 0, min(p_retailprice), 0 from part group by 1)
    group by id"""
_TREE_SQL = f"""
    with recursive t as (select p_partkey as id, {TREE_PARENT_SQL} as parent_id, p_size from part),
    a as (select id, id as top from t union select a.id, t.parent_id from a join t on t.id = a.top where t.parent_id is not null)
    select a.top as id, {_minmax('t.p_size', '0', 't.id')} from a join t on t.id = a.id group by a.top"""

ORACLES = {
    "order_boxes": f"select l_orderkey as id, {_LINES} from lineitem group by 1",
    "customer_boxes": f"select o_custkey as id, {_LINES} from lineitem join orders on l_orderkey = o_orderkey group by 1",
    "nation_boxes": f"""
        select c_nationkey as id, {_LINES} from lineitem join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey group by 1""",
    "region_boxes": f"""
        select n_regionkey as id, {_LINES} from lineitem join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1""",
    "merged_boxes": f"select l_orderkey as id, {_LINES} from lineitem group by 1",
    "parent_key_boxes": f"""
        with c as (select o_custkey as k, {_LINES} from lineitem join orders on l_orderkey = o_orderkey group by 1)
        select o_orderkey as id, c.* exclude (k) from orders join c on o_custkey = k""",
    "part_link_boxes": f"""
        select l_orderkey as id, {_minmax('p_size', 'p_retailprice', 'p_partkey % 10')}
        from lineitem join part on l_partkey = p_partkey group by 1""",
    "collection_box": f"""
        select {_LINES} from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus = 'F'""",
    "collection_box_if_null": f"""
        select {_LINES} from lineitem join orders on l_orderkey = o_orderkey where o_orderpriority <> '1-URGENT'""",
    "inline_surface_boxes": f"""
        select id, {_minmax('x', 'y', 'z')} from (
            select o_orderkey as id, o_totalprice as x, 0.0 as y, 0.0 as z from orders where o_orderstatus <> 'P'
            union all select l_orderkey, {', '.join(POINT)} from lineitem where l_returnflag <> 'R')
        group by id""",
    "box_ring": f"""
        with b as (select l_orderkey as id, {_LINES} from lineitem group by 1)
        select id, n, case when n in (0, 3, 4) then xmin else xmax end as x,
               case when n in (0, 1, 4) then ymin else ymax end as y,
               case when n in (0, 1, 4) then zmin else zmax end as z,
               case when n = 0 then 4979 else 25832 end as srid
        from b, (select unnest([0, 1, 2, 3, 4])::int as n)""",
    "template_boxes": _TEMPLATE_SQL,
    "placed_templates": f"""
        with t as ({_TEMPLATE_SQL}),
        u as (select s_suppkey as id, s_suppkey % 30 as rep,
                     case when s_nationkey <> 3 then s_acctbal else 0 end as rx,
                     case when s_nationkey <> 5 then s_suppkey % 3 + 1 else 1 end as a,
                     case when s_nationkey <> 5 then s_suppkey % 5 else 0 end as b,
                     case when s_nationkey <> 5 then s_suppkey % 7 else 0 end as tx,
                     case when s_nationkey <> 5 then s_suppkey % 11 else 0 end as ty,
                     case when s_nationkey <> 5 then s_suppkey % 13 else 0 end as tz
              from supplier),
        c as (select u.*, unnest([xmin, xmax, xmax, xmin]) as x, unnest([ymin, ymin, ymax, ymax]) as y,
                     unnest([zmin, zmin, zmax, zmax]) as z from u join t on t.id = u.rep)
        select id, round(min(a * x + b * y + (tx + rx)), 6) as xmin, round(min(-b * x + a * y + ty), 6) as ymin,
               round(min(z + tz), 6) as zmin, round(max(a * x + b * y + (tx + rx)), 6) as xmax,
               round(max(-b * x + a * y + ty), 6) as ymax, round(max(z + tz), 6) as zmax
        from c group by id""",
    "inherited_boxes": f"""
        select event_id as id, {_minmax('x', 'y', 'z')} from (
            select event_id, user_id as x, 0.0 as y, 0 as z from events
            union all select event_id, case event_type when 'click' then 0 when 'view' then 1 when 'signup' then 2 else 3 end,
                             value, 0 from events where event_type <> 'error'
            union all select event_id, 0, 0.0, length(props) from events where value > 10)
        group by 1""",
    "write_back": f"""
        with b as (select user_id as k, {_minmax('value', 'value', 'event_id')} from events group by 1)
        select c_custkey as id, c_mktsegment, """
    + ", ".join(f"case when c_mktsegment = 'BUILDING' then 0.0::double else {s} end as {s}" for s in B.SIDES)
    + " from customer left join b on c_custkey = k",
    "tree_boxes": _TREE_SQL,
    "recursive_boxes": _TREE_SQL,
    "cyclic_boxes": f"""
        with recursive edges as (
            select p_partkey as id, p_partkey - p_partkey % 40 + (p_partkey + 1) % 40 as up from part
            union select p_partkey, p_partkey // 2 from part where p_partkey % 7 = 0),
        above as (
            select p_partkey as id, p_partkey as top from part where p_partkey % 3 = 0
            union select a.id, e.up from above a join edges e on e.id = a.top)
        select a.top as id, {_minmax('t.p_size', '0', 't.p_partkey')} from above a join part t on t.p_partkey = a.id group by a.top""",
}
