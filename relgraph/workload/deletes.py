"""Delete and cleanup queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relgraph.operators import cascade, cleanup, deletion
from relgraph.plans.spec import AGGREGATION, ASSOCIATION, CASCADE, COMPOSITION, Link, Reference, RelationSpec
from relgraph.sources.tables import literal_rows
from relgraph.workload.tables import (
    EVENT_CLASSES,
    TREE_PARENT_SQL,
    event_objects,
    event_spec,
    event_tables,
    part_tree,
    table,
    trade_spec,
    trade_tables,
)


def _customers_outside_nation_3(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").where("c_nationkey <> 3").select(F.col("c_custkey").alias("id"))


ROOTS_SQL = "c as (select c_custkey as id from customer where c_nationkey <> 3)"
CHAIN_SQL = f"""
with {ROOTS_SQL},
o as (select o_orderkey as id from orders where o_custkey in (select id from c)),
cand as (select distinct l_partkey as id from lineitem where l_orderkey in (select id from o)),
p as (select id from cand where not exists (
        select 1 from lineitem l where l.l_partkey = cand.id and l.l_orderkey not in (select id from o)))
"""


def delete_customer_rows(spark, folder):
    survivors, _ = deletion.delete_rows(
        table(spark, folder, "customer"), _customers_outside_nation_3(spark, folder), "c_custkey"
    )
    return survivors.select("c_custkey", "c_nationkey", "c_mktsegment")


def child_orders(spark, folder):
    return deletion.cascade_children(
        table(spark, folder, "orders"), "o_custkey", _customers_outside_nation_3(spark, folder), "o_orderkey"
    )


def unlinked_parts(spark, folder):
    orders = child_orders(spark, folder)
    kept, far = deletion.unlink(table(spark, folder, "lineitem"), "l_orderkey", "l_partkey", orders)
    return (
        kept.groupBy(F.col("l_partkey").alias("id"))
        .agg(F.count(F.lit(1)).alias("links"))
        .withColumn("side", F.lit("kept"))
        .unionByName(far.withColumn("links", F.lit(0).cast("long")).withColumn("side", F.lit("removed")))
    )


def unreferenced_parts(spark, folder):
    line = table(spark, folder, "lineitem")
    kept, candidates = deletion.unlink(line, "l_orderkey", "l_partkey", child_orders(spark, folder))
    return deletion.delete_unreferenced(candidates, [(kept, "l_partkey")])


def cascade_nation_delete(spark, folder):
    result = cascade.cascade_delete(
        trade_tables(spark, folder), trade_spec(), {"customer": _customers_outside_nation_3(spark, folder)}
    )
    return result.deleted.select(F.col("table").alias("tbl"), "id")


def cascade_survivors(spark, folder):
    result = cascade.cascade_delete(
        trade_tables(spark, folder), trade_spec(), {"customer": _customers_outside_nation_3(spark, folder)}
    )
    frames = [
        result.survivors(t).agg(F.count(F.lit(1)).alias("row_count"), F.sum(k).alias("key_sum")).withColumn("tbl", F.lit(t))
        for t, k in [
            ("customer", "c_custkey"),
            ("orders", "o_orderkey"),
            ("lineitem", "l_orderkey"),
            ("part", "p_partkey"),
            ("supplier", "s_suppkey"),
        ]
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def unlink_keep_parts(spark, folder):
    result = cascade.cascade_delete(
        trade_tables(spark, folder),
        trade_spec(ASSOCIATION),
        {"customer": _customers_outside_nation_3(spark, folder)},
    )
    links = result.survivors("lineitem").select(
        F.lit("lineitem").alias("tbl"), F.col("l_orderkey").alias("id1"), F.col("l_partkey").alias("id2")
    )
    parts = result.survivors("part").select(
        F.lit("part").alias("tbl"), F.col("p_partkey").alias("id1"), F.lit(None).cast("long").alias("id2")
    )
    return links.unionByName(parts)


def detach_supplier_nation(spark, folder):
    gone = table(spark, folder, "nation").where("n_nationkey < 5").select(F.col("n_nationkey").alias("id"))
    detached, _ = deletion.detach_children(
        table(spark, folder, "supplier"), "s_nationkey", gone, "s_suppkey", multi_owner=True
    )
    return detached.select("s_suppkey", "s_nationkey", "s_acctbal")


def detached_by_policy(spark, folder):
    gone = table(spark, folder, "nation").where("n_nationkey < 5").select(F.col("n_nationkey").alias("id"))
    result = cascade.cascade_delete(trade_tables(spark, folder), trade_spec(), {"nation": gone})
    return result.detached.select(F.col("table").alias("tbl"), "id", F.col("column").alias("col"))


def unlinked_rows(spark, folder):
    result = cascade.cascade_delete(
        trade_tables(spark, folder), trade_spec(), {"customer": _customers_outside_nation_3(spark, folder)}
    )
    return result.unlinked.groupBy("link", "id2").agg(F.count(F.lit(1)).alias("removed"))


_TWO_OWNERS = """
    select p_partkey as id,
           case when p_size > 40 then null else p_size // 2 end as a_id,
           case when p_retailprice > 950 then null else p_size % 5 end as b_id
    from part"""


def _two_owner_parts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.expr("case when p_size > 40 then null else cast(p_size div 2 as int) end").alias("a_id"),
        F.expr("case when p_retailprice > 950 then null else p_size % 5 end").alias("b_id"),
    )


def multi_owner_null_filter(spark, folder):
    parts = _two_owner_parts(spark, folder)
    return deletion.owners_all_null(parts, parts.select("id"), ["a_id", "b_id"])


def multi_owner_cascade(spark, folder):
    tables = {
        "item": _two_owner_parts(spark, folder),
        "a": table(spark, folder, "nation").select(F.col("n_nationkey").alias("id")),
        "b": table(spark, folder, "region").select(F.col("r_regionkey").alias("id")),
    }
    spec = RelationSpec(
        keys=dict.fromkeys(tables, "id"),
        references=[
            Reference("item", "a_id", "a", AGGREGATION, multi_owner=True),
            Reference("item", "b_id", "b", AGGREGATION, multi_owner=True),
        ],
    )
    result = cascade.cascade_delete(
        tables, spec, {"a": tables["a"].where("id < 15"), "b": tables["b"].where("id < 3")}
    )
    return result.survivors("item")


def owned_targets(spark, folder):
    """Parts and suppliers that the lines of the deleted orders lead to."""
    gone = child_orders(spark, folder).select(F.col("id").alias("l_orderkey"))
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    return deletion.owned_targets(rows.join(gone, "l_orderkey", "left_semi"), ["l_partkey", "l_suppkey"])


def owned_target_cascade(spark, folder):
    """Deleting customers also removes the supplier sheets only they hold:
    each customer owns, by key, a shared row it may not be the last owner of."""
    tables = {
        "holder": table(spark, folder, "customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_nationkey").alias("area"),
            F.expr("cast(c_acctbal as bigint) div 10").alias("left_id"),
            F.expr("cast(c_acctbal as bigint) div 20").alias("right_id"),
        ),
        "sheet": table(spark, folder, "part").select(F.col("p_partkey").alias("id")),
    }
    spec = RelationSpec(
        keys=dict.fromkeys(tables, "id"),
        references=[
            Reference("holder", "left_id", "sheet", AGGREGATION, owned="target"),
            Reference("holder", "right_id", "sheet", COMPOSITION, owned="target"),
        ],
    )
    result = cascade.cascade_delete(tables, spec, {"holder": tables["holder"].where("area <> 3").select("id")})
    return result.deleted.select(F.col("table").alias("tbl"), "id")


def part_tree_delete(spark, folder):
    parts = part_tree(spark, folder)
    return cascade.part_closure(parts, parts.where("p_size > 45").select("id"), "parent_id")


def subclass_dispatch(spark, folder):
    objects = event_objects(spark, folder)
    ids = objects.where("value > 20").select("id")
    # errors are stored in the base table itself, so no sub table is called
    classes = {c: t for t, c in EVENT_CLASSES.items() if t != "error"}
    return deletion.dispatch_subclasses(objects, ids, classes).select(F.col("table").alias("tbl"), "id")


def _event_cascade(spark, folder, root: str, ids: DataFrame) -> DataFrame:
    result = cascade.cascade_delete(event_tables(spark, folder), event_spec(), {root: ids})
    return result.deleted.select(F.col("table").alias("tbl"), "id")


def super_sub_delete(spark, folder):
    """From a leaf table upwards."""
    clicks = event_tables(spark, folder)["click"].where("value > 10").select("id")
    return _event_cascade(spark, folder, "click", clicks)


def base_delete(spark, folder):
    """From the base table down to every sub and hook table."""
    ids = event_objects(spark, folder).where("value > 20").select("id")
    return _event_cascade(spark, folder, "object", ids)


def hook_delete(spark, folder):
    tables = event_tables(spark, folder)
    kept, _ = deletion.delete_hook_rows(tables["extra"], tables["object"].where("objectclass_id = 10005"))
    return kept


def delete_by_lineage(spark, folder):
    objects = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("lineage"),
        F.col("o_orderstatus").alias("objectclass_id"),
    )
    return deletion.select_by_lineage(objects, "1-URGENT", "P")


def lineage_cascade(spark, folder):
    picked, result = cascade.delete_by_lineage(
        trade_tables(spark, folder), trade_spec(), "orders", "1-URGENT", lineage_column="o_orderpriority"
    )
    return result.deleted.select(F.col("table").alias("tbl"), "id")


def bridge_orphans(spark, folder):
    return cleanup.bridge_orphans(
        table(spark, folder, "orders"), table(spark, folder, "lineitem"), "l_orderkey", "o_orderkey"
    )


def bridge_orphans_global(spark, folder):
    owners = table(spark, folder, "orders").withColumn(
        "owner_id", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    )
    return cleanup.bridge_orphans(
        owners, table(spark, folder, "lineitem"), "l_orderkey", "o_orderkey", parent="owner_id"
    )


def bridge_cleanup(spark, folder):
    """Parts without a returned line go, and with them their links; then the
    orders that have no link left."""
    line = table(spark, folder, "lineitem")
    tables = {
        "payload": table(spark, folder, "part").select(F.col("p_partkey").alias("id")),
        "parameter": line.where("l_returnflag = 'R' and l_quantity > 40").select(F.col("l_partkey").alias("payload_id")),
        "owner": table(spark, folder, "orders").select(F.col("o_orderkey").alias("id")),
        "bridge": line.select("l_orderkey", "l_partkey"),
    }
    spec = RelationSpec(
        keys={"payload": "id", "owner": "id"},
        links=[Link("bridge", "owner", "l_orderkey", "payload", "l_partkey", ASSOCIATION)],
    )
    first, second = cleanup.cleanup_bridge(
        tables, spec, "payload", ("parameter", "payload_id"), "owner", ("bridge", "l_orderkey")
    )
    return first.deleted.unionByName(second.deleted).select(F.col("table").alias("tbl"), "id")


def extension_objects(spark, folder):
    """Objects of the extension that owns the view and purchase classes."""
    classes = literal_rows(
        spark, "id int, extension_id int", [(c, 7 if t in ("view", "purchase") else 8) for t, c in EVENT_CLASSES.items()]
    )
    extensions = literal_rows(spark, "id int, name string", [(7, "ext-a"), (8, "ext-b")])
    return deletion.extension_objects(event_objects(spark, folder), classes, extensions, "ext-a")


def extension_cascade(spark, folder):
    result = cascade.delete_extension(
        event_tables(spark, folder), event_spec(), "object", extension_objects(spark, folder)
    )
    return result.deleted.select(F.col("table").alias("tbl"), "id")


def cleanup_customers_without_events(spark, folder):
    return cleanup.unreferenced_keys(
        table(spark, folder, "customer"), [(table(spark, folder, "events"), "user_id")], "c_custkey"
    )


def cleanup_multi_referrer(spark, folder):
    line = table(spark, folder, "lineitem")
    return cleanup.unreferenced_keys(
        table(spark, folder, "orders"),
        [
            (line.where("l_returnflag = 'R'").select("l_orderkey"), "l_orderkey"),
            (line.where("l_quantity > 25").select("l_orderkey"), "l_orderkey"),
        ],
        "o_orderkey",
    )


def cleanup_cascade(spark, folder):
    """Customers no event refers to, and the sheets that only they hold."""
    customers = table(spark, folder, "customer").select("c_custkey", F.expr("c_custkey div 2").alias("sheet"))
    tables = {
        "customer": customers,
        "events": table(spark, folder, "events"),
        "sheet": customers.select(F.col("sheet").alias("id")).distinct(),
    }
    spec = RelationSpec(
        keys={"customer": "c_custkey", "events": "event_id", "sheet": "id"},
        references=[
            Reference("events", "user_id", "customer"),
            Reference("customer", "sheet", "sheet", AGGREGATION, owned="target"),
        ],
    )
    result = cleanup.cleanup_unreferenced(tables, spec, "customer")
    return result.deleted.select(F.col("table").alias("tbl"), "id")


def key_policy_cascade(spark, folder):
    """A key that owns nothing but whose policy is to delete: suppliers go with their nation."""
    tables = {name: table(spark, folder, name) for name in ("nation", "supplier")}
    spec = RelationSpec(
        keys={"nation": "n_nationkey", "supplier": "s_suppkey"},
        references=[Reference("supplier", "s_nationkey", "nation", ASSOCIATION, on_delete=CASCADE)],
    )
    gone = tables["nation"].where("n_nationkey < 10").select(F.col("n_nationkey").alias("id"))
    result = cascade.cascade_delete(tables, spec, {"nation": gone})
    return result.deleted.select(F.col("table").alias("tbl"), F.col("id").cast("bigint").alias("id"))


def shared_owners_by_default(spark, folder):
    """Two owning keys without a mark: a part goes when both owners are gone."""
    tables = {
        "item": _two_owner_parts(spark, folder),
        "a": table(spark, folder, "nation").select(F.col("n_nationkey").alias("id")),
        "b": table(spark, folder, "region").select(F.col("r_regionkey").alias("id")),
    }
    spec = RelationSpec(
        keys=dict.fromkeys(tables, "id"),
        references=[Reference("item", "a_id", "a", AGGREGATION), Reference("item", "b_id", "b", AGGREGATION)],
    )
    result = cascade.cascade_delete(
        tables, spec, {"a": tables["a"].where("id < 15"), "b": tables["b"].where("id < 3")}
    )
    return result.deleted.where("table = 'item'").select("id")


QUERIES = {
    f.__name__: f
    for f in [
        delete_customer_rows,
        child_orders,
        unlinked_parts,
        unreferenced_parts,
        cascade_nation_delete,
        cascade_survivors,
        unlink_keep_parts,
        detach_supplier_nation,
        detached_by_policy,
        unlinked_rows,
        multi_owner_null_filter,
        multi_owner_cascade,
        shared_owners_by_default,
        key_policy_cascade,
        owned_targets,
        owned_target_cascade,
        part_tree_delete,
        subclass_dispatch,
        super_sub_delete,
        base_delete,
        hook_delete,
        delete_by_lineage,
        lineage_cascade,
        bridge_orphans,
        bridge_orphans_global,
        bridge_cleanup,
        extension_objects,
        extension_cascade,
        cleanup_customers_without_events,
        cleanup_multi_referrer,
        cleanup_cascade,
    ]
}

_CLASS_SQL = "case event_type " + " ".join(f"when '{t}' then {c}" for t, c in EVENT_CLASSES.items()) + " end"
_EVENT_TABLES_SQL = """
    select 'object' as tbl, event_id as id from picked
    union all select 'interaction', event_id from picked where event_type in ('click', 'view')
    union all select 'conversion', event_id from picked where event_type in ('signup', 'purchase')
    union all select event_type, event_id from picked where event_type <> 'error'
    union all select 'extra', event_id from picked where value > 10"""

ORACLES = {
    "delete_customer_rows": "select c_custkey, c_nationkey, c_mktsegment from customer where not (c_nationkey <> 3)",
    "child_orders": "select o_orderkey as id from orders join customer on o_custkey = c_custkey where c_nationkey <> 3",
    "unlinked_parts": f"""
        with {ROOTS_SQL},
        l as (select l_partkey, o_custkey in (select id from c) as gone
              from lineitem join orders on l_orderkey = o_orderkey)
        select l_partkey as id, count(*) as links, 'kept' as side from l where not gone group by 1
        union all select distinct l_partkey, 0, 'removed' from l where gone""",
    "unreferenced_parts": CHAIN_SQL + "select id from p",
    "cascade_nation_delete": CHAIN_SQL
    + """select 'customer' as tbl, id from c union all select 'orders', id from o
         union all select 'part', id from p""",
    "cascade_survivors": CHAIN_SQL
    + """select 'customer' as tbl, count(*) as row_count, sum(c_custkey)::bigint as key_sum
           from customer where c_custkey not in (select id from c)
         union all select 'orders', count(*), sum(o_orderkey)::bigint from orders where o_orderkey not in (select id from o)
         union all select 'lineitem', count(*), sum(l_orderkey)::bigint from lineitem where l_orderkey not in (select id from o)
         union all select 'part', count(*), sum(p_partkey)::bigint from part where p_partkey not in (select id from p)
         union all select 'supplier', count(*), sum(s_suppkey)::bigint from supplier""",
    "unlink_keep_parts": CHAIN_SQL
    + """select 'lineitem' as tbl, l_orderkey as id1, l_partkey as id2 from lineitem
           where l_orderkey not in (select id from o)
         union all select 'part', p_partkey, null from part""",
    "detach_supplier_nation": """
        select s_suppkey, case when s_nationkey in (select n_nationkey from nation where n_nationkey < 5)
               then null else s_nationkey end as s_nationkey, s_acctbal from supplier""",
    "detached_by_policy": """
        select 'supplier' as tbl, s_suppkey as id, 's_nationkey' as col from supplier where s_nationkey < 5""",
    "unlinked_rows": CHAIN_SQL
    + """select 'lineitem' as link, l_partkey as id2, count(*) as removed from lineitem
         where l_orderkey in (select id from o) group by l_partkey""",
    "multi_owner_null_filter": f"select id from ({_TWO_OWNERS}) where a_id is null and b_id is null",
    "multi_owner_cascade": f"""
        with t as ({_TWO_OWNERS}),
        u as (select id, a_id < 15 as a_gone, b_id < 3 as b_gone,
                     case when a_id < 15 then null else a_id end as a_id,
                     case when b_id < 3 then null else b_id end as b_id from t)
        select id, a_id, b_id from u
        where not (a_id is null and b_id is null and (coalesce(a_gone, false) or coalesce(b_gone, false)))""",
    "owned_targets": CHAIN_SQL
    + """select l_partkey as id from lineitem where l_orderkey in (select id from o)
         union select l_suppkey from lineitem where l_orderkey in (select id from o)""",
    "owned_target_cascade": """
        with h as (select c_custkey as id, c_nationkey <> 3 as gone,
                          trunc(c_acctbal)::bigint as bal from customer),
        q as (select id, gone, case when bal < 0 then -(-bal // 10) else bal // 10 end as k from h union all
              select id, gone, case when bal < 0 then -(-bal // 20) else bal // 20 end from h)
        select 'holder' as tbl, id from h where gone
        union all
        select 'sheet', p_partkey from part
        where p_partkey in (select k from q where gone) and p_partkey not in (select k from q where not gone)""",
    "part_tree_delete": f"""
        with recursive t as (select p_partkey as id, {TREE_PARENT_SQL} as parent_id, p_size from part),
        d as (select id from t where p_size > 45 union select t.id from t join d on t.parent_id = d.id)
        select id from d""",
    "subclass_dispatch": "select event_type as tbl, event_id as id from events where value > 20 and event_type <> 'error'",
    "super_sub_delete": f"""
        with picked as (select * from events where event_type = 'click' and value > 10) {_EVENT_TABLES_SQL}""",
    "base_delete": f"with picked as (select * from events where value > 20) {_EVENT_TABLES_SQL}",
    "hook_delete": "select event_id as id, props from events where value > 10 and event_type <> 'error'",
    "delete_by_lineage": """
        select o_orderkey as id from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'P'""",
    "lineage_cascade": """
        with o as (select o_orderkey as id from orders where o_orderpriority = '1-URGENT')
        select 'orders' as tbl, id from o
        union all select 'part', p_partkey from part where p_partkey in
            (select l_partkey from lineitem where l_orderkey in (select id from o))
          and not exists (select 1 from lineitem where l_partkey = p_partkey and l_orderkey not in (select id from o))""",
    "bridge_orphans": """
        select o_orderkey as id from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)""",
    "bridge_orphans_global": """
        select o_orderkey as id from orders where o_orderstatus = 'P'
        and not exists (select 1 from lineitem where l_orderkey = o_orderkey)""",
    "bridge_cleanup": """
        with p as (select p_partkey as id from part where not exists (
                select 1 from lineitem where l_partkey = p_partkey and l_returnflag = 'R' and l_quantity > 40))
        select 'payload' as tbl, id from p
        union all select 'owner', o_orderkey from orders where not exists (
                select 1 from lineitem where l_orderkey = o_orderkey and l_partkey not in (select id from p))""",
    "extension_objects": f"""
        select event_id as id, {_CLASS_SQL} as objectclass_id from events where event_type in ('view', 'purchase')""",
    "extension_cascade": f"""
        with picked as (select * from events where event_type in ('view', 'purchase')) {_EVENT_TABLES_SQL}""",
    "cleanup_customers_without_events": """
        select c_custkey as id from customer where not exists (select 1 from events where user_id = c_custkey)""",
    "cleanup_multi_referrer": """
        select o_orderkey as id from orders
        where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')
          and not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_quantity > 25)""",
    "shared_owners_by_default": f"""
        with t as ({_TWO_OWNERS})
        select id from t where (a_id is null or a_id < 15) and (b_id is null or b_id < 3) and (a_id < 15 or b_id < 3)""",
    "key_policy_cascade": """
        select 'nation' as tbl, n_nationkey::bigint as id from nation where n_nationkey < 10
        union all select 'supplier', s_suppkey from supplier where s_nationkey < 10""",
    "cleanup_cascade": """
        with c as (select c_custkey as id, c_custkey // 2 as sheet,
                          not exists (select 1 from events where user_id = c_custkey) as gone from customer)
        select 'customer' as tbl, id from c where gone
        union all select 'sheet', sheet from c group by sheet having bool_and(gone)""",
}
