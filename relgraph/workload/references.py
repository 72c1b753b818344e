"""Reference queries over the trade tables and the split events."""

from __future__ import annotations

from pyspark.sql import functions as F

from relgraph.operators import references as K
from relgraph.plans.spec import Reference, RelationSpec
from relgraph.workload.tables import TREE_PARENT_SQL, event_tables, part_tree, table, trade_spec, trade_tables


def _part_use(spark, folder):
    """Parts as the target of lines and of their own tree."""
    tables = {"part": part_tree(spark, folder), "lineitem": table(spark, folder, "lineitem")}
    tables["orders"] = table(spark, folder, "orders")
    spec = trade_spec()
    spec = RelationSpec(
        keys={"part": "id", "orders": "o_orderkey"},
        references=[Reference("part", "parent_id", "part")],
        links=spec.links,
    )
    return tables, spec, tables["part"].where("p_size > 45").select("id")


def referencing_rows(spark, folder):
    tables, spec, ids = _part_use(spark, folder)
    rows = K.referencing_rows(tables, spec, "part", ids)
    return rows.withColumnsRenamed({"table": "tbl", "column": "col"})


def referencing_counts(spark, folder):
    nations = table(spark, folder, "nation").where("n_regionkey < 2").select(F.col("n_nationkey").alias("id"))
    rows = K.referencing_counts(trade_tables(spark, folder), trade_spec(), "nation", nations)
    return rows.withColumnsRenamed({"table": "tbl", "column": "col"})


def referenced_rows(spark, folder):
    """Lines refer to an order, a part and a supplier; a fourth key leads to a
    part again, often to the same one."""
    rows = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey as id", "l_partkey", "l_suppkey",
        "case when l_linenumber > 3 then l_partkey when l_linenumber > 1 then l_suppkey end as spare_id",
    )
    return K.referenced_rows(
        rows, {"id": "orders", "l_partkey": "part", "l_suppkey": "supplier", "spare_id": "part"}
    )


def shared_key(spark, folder):
    t = event_tables(spark, folder)
    return K.shared_key(t["extra"], t["interaction"])


def missing_parent(spark, folder):
    t = event_tables(spark, folder)
    return K.missing_parent(t["extra"], t["conversion"])


def expand_link(spark, folder):
    orders = table(spark, folder, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id"))
    return K.expand_link(table(spark, folder, "lineitem"), "l_orderkey", "l_partkey", orders)


QUERIES = {
    f.__name__: f
    for f in [referencing_rows, referencing_counts, referenced_rows, shared_key, missing_parent, expand_link]
}

ORACLES = {
    "referencing_rows": f"""
        with p as (select p_partkey as id from part where p_size > 45),
        t as (select p_partkey as id, {TREE_PARENT_SQL} as parent_id from part)
        select 'lineitem' as tbl, 'l_partkey' as col, false as is_self, l_orderkey as row_key, l_partkey as target_key
        from lineitem where l_partkey in (select id from p)
        union all select 'part', 'parent_id', true, id, parent_id from t where parent_id in (select id from p)""",
    "referencing_counts": """
        with n as (select n_nationkey as id from nation where n_regionkey < 2)
        select 'customer' as tbl, 'c_nationkey' as col, false as is_self, count(*) as row_count
        from customer where c_nationkey in (select id from n)
        union all select 'supplier', 's_nationkey', false, count(*) from supplier where s_nationkey in (select id from n)""",
    "referenced_rows": """
        with r as (select l_orderkey as id, l_partkey as p, l_suppkey as s,
                          case when l_linenumber > 3 then l_partkey when l_linenumber > 1 then l_suppkey end as x
                   from lineitem),
        e as (select id, 'part' as ref_table, p as k, case when x = p then 'l_partkey,spare_id' else 'l_partkey' end as c from r
              union all select id, 'part', x, 'spare_id' from r where x is not null and x <> p
              union all select id, 'supplier', s, 'l_suppkey' from r)
        select id, ref_table, k::varchar as target_key, c as fk_columns from e""",
    "shared_key": """
        select event_id as id, event_type in ('click', 'view') as has_parent from events where value > 10""",
    "missing_parent": """
        select event_id as id from events where value > 10 and event_type not in ('signup', 'purchase')""",
    "expand_link": """
        select distinct l_orderkey, l_partkey from lineitem
        where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'P')""",
}
