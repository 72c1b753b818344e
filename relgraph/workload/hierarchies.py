"""Queries on parent pointers, link kinds and keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from relgraph.operators import hierarchy as H
from relgraph.sources.tables import literal_rows
from relgraph.workload.tables import TREE_PARENT_SQL, part_tree, table


def part_closure(spark, folder):
    """Everything below the large parts."""
    parts = part_tree(spark, folder)
    return H.descendants(parts, parts.where("p_size > 45").select("id"))


def tree_root(spark, folder):
    return H.resolve_root(part_tree(spark, folder))


def base_class(spark, folder):
    """The walk ends early at the ids 1 to 3, and at 0."""
    return H.resolve_root(part_tree(spark, folder), stop=3)


def ancestor_flag(spark, folder):
    """Parts of one size range below a part larger than 40."""
    parts = part_tree(spark, folder).selectExpr("id", "parent_id", "p_size > 40 as big", "p_size < 30 as small")
    return H.ancestor_flag(parts, "big", "small")


#: Relation facts between the three line states and return flags.
FACTS = [
    (1, 10, 1, "L_ORDERKEY"),
    (1, 11, 0, "l_orderkey"),
    (2, 10, 0, "l_orderkey"),
    (2, 11, 1, "l_partkey"),
]
FACT_SCHEMA = "child_id int, parent_id int, is_composite int, join_table_or_column_name string"


def _typed_lines(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.expr("case l_returnflag when 'R' then 1 when 'A' then 2 else 3 end").alias("child_class"),
        F.expr("case l_linestatus when 'O' then 10 else 11 end").alias("parent_class"),
        F.lit("L_OrderKey").alias("join_name"),
    )


def link_kinds(spark, folder):
    links = H.classify_links(_typed_lines(spark, folder), literal_rows(spark, FACT_SCHEMA, FACTS))
    return links.groupBy("l_orderkey", "kind").agg(F.count(F.lit(1)).alias("links"))


def table_link_kinds(spark, folder):
    classes = literal_rows(
        spark, "id int, tablename string", [(1, "Line"), (2, "line"), (3, "note"), (10, "PARENT"), (11, "other")]
    )
    links = table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.expr("if(l_returnflag = 'N', 'NOTE', 'Line')").alias("child_table"),
        F.expr("if(l_linestatus = 'O', 'parent', 'OTHER')").alias("parent_table"),
        F.lit("l_orderkey").alias("join_name"),
    )
    kinds = H.classify_table_links(links, literal_rows(spark, FACT_SCHEMA, FACTS), classes)
    return kinds.groupBy("l_orderkey", "kind").agg(F.count(F.lit(1)).alias("links"))


def key_conflicts(spark, folder):
    """A batch of orders whose keys were shifted by half the customers."""
    orders = table(spark, folder, "orders")
    batch = orders.select((F.col("o_orderkey") + F.col("o_custkey")).alias("o_orderkey"))
    return H.conflicting_keys(batch, orders, "o_orderkey")


def surrogate_keys(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return H.surrogate_keys(orders, ["o_orderdate", "o_orderkey"], after=1000)


QUERIES = {
    f.__name__: f
    for f in [
        part_closure,
        tree_root,
        base_class,
        ancestor_flag,
        link_kinds,
        table_link_kinds,
        key_conflicts,
        surrogate_keys,
    ]
}

_TREE = f"t as (select p_partkey as id, {TREE_PARENT_SQL} as parent_id, p_size from part)"
_KIND = """case when f = 'R' and s = 'O' then 'COMPOSITION'
                when (f = 'R' and s <> 'O') or (f = 'A' and s = 'O') then 'AGGREGATION' else 'ASSOCIATION' end"""

ORACLES = {
    "part_closure": f"""
        with recursive {_TREE},
        d as (select t.id from t join t r on t.parent_id = r.id where r.p_size > 45
              union select t.id from t join d on t.parent_id = d.id)
        select id from d""",
    "tree_root": f"""
        with recursive {_TREE},
        w as (select id, id as root, parent_id from t
              union all select w.id, t.id, t.parent_id from w join t on t.id = w.parent_id)
        select id, root from w where parent_id is null""",
    "base_class": f"""
        with recursive {_TREE},
        w as (select id, id as root, parent_id from t
              union all select w.id, t.id, t.parent_id from w join t on t.id = w.parent_id where w.root > 3)
        select id, root from w where root <= 3""",
    "ancestor_flag": f"""
        with recursive {_TREE},
        d as (select t.id from t join t r on t.parent_id = r.id where r.p_size > 40
              union select t.id from t join d on t.parent_id = d.id)
        select id, id in (select id from d) and p_size < 30 as flagged from t""",
    "link_kinds": f"""
        select l_orderkey, {_KIND} as kind, count(*) as links
        from (select l_orderkey, l_returnflag as f, l_linestatus as s from lineitem) group by 1, 2""",
    "table_link_kinds": """
        select l_orderkey, case when l_returnflag = 'N' then 'ASSOCIATION'
               when l_linestatus = 'O' then 'COMPOSITION' else 'AGGREGATION' end as kind, count(*) as links
        from lineitem group by 1, 2""",
    "key_conflicts": """
        select distinct o_orderkey + o_custkey as id from orders
        where o_orderkey + o_custkey in (select o_orderkey from orders)""",
    "surrogate_keys": """
        select o_orderkey, o_orderdate, 1000 + row_number() over (order by o_orderdate, o_orderkey) as id from orders""",
}
