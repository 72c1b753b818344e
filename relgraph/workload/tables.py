"""The test tables in the roles the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relgraph.plans.spec import (
    AGGREGATION,
    ASSOCIATION,
    COMPOSITION,
    SET_NULL,
    Link,
    Reference,
    RelationSpec,
    SharedKey,
)
from relgraph.sources.tables import read_tables


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_tables(spark, folder, [name])[name]


def trade_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return read_tables(spark, folder, ["region", "nation", "customer", "supplier", "orders", "lineitem", "part"])


def trade_spec(line_kind: str = AGGREGATION) -> RelationSpec:
    """region > nation > customer > orders, suppliers shared by nation, and
    line items as the keyless link between orders and parts."""
    return RelationSpec(
        keys={
            "region": "r_regionkey",
            "nation": "n_nationkey",
            "customer": "c_custkey",
            "supplier": "s_suppkey",
            "orders": "o_orderkey",
            "part": "p_partkey",
        },
        references=[
            Reference("nation", "n_regionkey", "region", COMPOSITION),
            Reference("customer", "c_nationkey", "nation", COMPOSITION),
            Reference("supplier", "s_nationkey", "nation", ASSOCIATION, on_delete=SET_NULL),
            Reference("orders", "o_custkey", "customer", COMPOSITION),
        ],
        links=[Link("lineitem", "orders", "l_orderkey", "part", "l_partkey", line_kind)],
    )


#: Parent of a part in the test tree: four children per part, part 0 on top.
TREE_PARENT = "case when p_partkey = 0 then null else (p_partkey - 1) div 4 end"
TREE_PARENT_SQL = "case when p_partkey = 0 then null else (p_partkey - 1) // 4 end"


def part_tree(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), F.expr(TREE_PARENT).alias("parent_id"), "p_size", "p_brand"
    )


#: Class ids of the event types, and the two classes above them.
EVENT_CLASSES = {"click": 10001, "view": 10002, "signup": 10003, "purchase": 10004, "error": 10005}
INTERACTION, CONVERSION = 2, 3


def event_objects(spark: SparkSession, folder: str) -> DataFrame:
    classes = F.create_map(*[F.lit(v) for item in EVENT_CLASSES.items() for v in item])
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.element_at(classes, F.col("event_type")).alias("objectclass_id"),
        "user_id",
        "value",
        "props",
        "event_type",
    )


def event_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Events split by inheritance: a base table, two middle and four leaf
    tables that share the id, and a hook table.  Errors live in the base."""
    objects = event_objects(spark, folder)

    def of(*types: str) -> DataFrame:
        return objects.where(F.col("event_type").isin(*types))

    return {
        "object": objects.select("id", "objectclass_id", "user_id"),
        "interaction": of("click", "view").select("id", "objectclass_id"),
        "conversion": of("signup", "purchase").select("id", "objectclass_id"),
        "click": of("click").select("id", "value"),
        "view": of("view").select("id", "value"),
        "signup": of("signup").select("id", "value"),
        "purchase": of("purchase").select("id", "value"),
        "extra": objects.where(F.col("value") > 10).select("id", "props"),
    }


def event_spec() -> RelationSpec:
    names = ["object", "interaction", "conversion", "click", "view", "signup", "purchase", "extra"]
    c = EVENT_CLASSES
    return RelationSpec(
        keys=dict.fromkeys(names, "id"),
        shared_keys=[
            SharedKey("interaction", "object", (INTERACTION, c["click"], c["view"])),
            SharedKey("conversion", "object", (CONVERSION, c["signup"], c["purchase"])),
            SharedKey("click", "interaction", (c["click"],)),
            SharedKey("view", "interaction", (c["view"],)),
            SharedKey("signup", "conversion", (c["signup"],)),
            SharedKey("purchase", "conversion", (c["purchase"],)),
            SharedKey("extra", "object", hook=True),
        ],
        class_table="object",
    )
