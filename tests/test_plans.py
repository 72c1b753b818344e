"""Physical plans: what must and must not be in them, and skewed keys."""

import re

import pytest
from oracle import plan_of
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from relgraph.functions import boxes as B
from relgraph.operators import deletion, envelope
from relgraph.operators import references as K
from relgraph.operators.cleanup import unreferenced_keys
from relgraph.plans.staging import Staging, checkpoint_folder

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry_module.queries()


@pytest.fixture
def small_skew(settings):
    """Partitions of a few kilobytes count as skewed; nothing is broadcast."""
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="2KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="2KB",
        adaptive__coalescePartitions__parallelismFirst="false",
    )


@pytest.mark.parametrize(
    "name", ["cleanup_customers_without_events", "cleanup_multi_referrer", "bridge_orphans", "missing_parent"]
)
def test_missing_rows_are_anti_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert plan.count("LeftAnti") == 1 and "LeftOuter" not in plan


def test_scans_read_only_the_keys(spark, settings):
    settings(maxMetadataStringLength="1000")
    plan = plan_of(QUERIES["cleanup_customers_without_events"](spark, FOLDER))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert sorted(schemas) == ["struct<c_custkey:bigint>", "struct<user_id:bigint>"]
    plan = plan_of(QUERIES["delete_by_lineage"](spark, FOLDER))
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan and "EqualTo(o_orderstatus,P)" in plan


def test_projections_do_not_shuffle(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    refs = K.referenced_rows(lines, {"l_partkey": "part", "l_suppkey": "supplier"}, "l_orderkey")
    assert "Exchange" not in plan_of(refs)
    points = lines.select(F.col("l_orderkey").alias("id"), F.array(B.point("l_quantity", "l_tax", "l_tax")).alias("g"))
    assert "Exchange" not in plan_of(envelope.inline_contribution(points, ["g"]))


def test_roll_up_aggregates_before_each_shuffle(spark, settings):
    settings(autoBroadcastJoinThreshold="-1")
    plan = plan_of(QUERIES["region_boxes"](spark, FOLDER))
    for below in re.findall(r"Exchange hashpartitioning\(_fk[^\n]*\n[^\n]*", plan):
        assert "HashAggregate" in below and "partial_min" in below


def hot(spark, n=30000):
    """Rows of which two thirds share one key, and many have none."""
    return spark.range(n).selectExpr(
        "id", "case when id % 3 > 0 then 7 when id % 2 = 0 then null else id end as fk", "cast(id as string) as pad"
    )


def executed(df):
    rows = df.collect()
    return rows, plan_of(df)


def test_hot_parent_is_split_in_semi_and_anti_joins(spark, small_skew):
    df, ids = hot(spark), spark.range(0, 2000)
    rows, plan = executed(deletion.with_keys(df, "fk", deletion.key_set(ids)))
    assert "skew=true" in plan
    assert len(rows) == df.where("fk < 2000").count()
    rows, plan = executed(deletion.without_keys(df, "fk", deletion.key_set(ids)))
    assert "skew=true" in plan
    assert len(rows) == df.where("fk is null or fk >= 2000").count()


def test_hot_parent_is_split_when_keys_are_nulled(spark, small_skew):
    df = hot(spark)
    rows, plan = executed(deletion.set_null(df, "fk", spark.range(0, 2000)))
    assert "skew=true" in plan
    assert len(rows) == 30000 and sum(r["fk"] is None for r in rows) == df.where("fk is null or fk < 2000").count()


def test_hot_template_is_split(spark, small_skew):
    uses = hot(spark).select("id", "fk", F.lit(None).cast(B.POINT_TYPE).alias("ref"), F.lit(None).cast("string").alias("m"))
    boxes = spark.range(0, 3000).select("id", B.box_of_point(B.point("id", "id", "id")).alias("box"))
    rows, plan = executed(envelope.implicit_contribution(uses, "fk", "ref", "m", boxes))
    assert "skew=true" in plan
    assert len(rows) == uses.where("fk < 3000").count()


def test_hot_referrer_is_collapsed_before_the_shuffle(spark, small_skew):
    found = unreferenced_keys(spark.range(100), [(hot(spark), "fk")])
    rows, plan = executed(found)
    assert len(rows) == 100 - hot(spark).where("fk < 100").select("fk").distinct().count()
    # the referring side is aggregated below its exchange
    assert re.search(r"Exchange hashpartitioning\(id[^\n]*\n[^\n]*HashAggregate", plan)


def test_hot_parent_sends_one_box_per_task(spark, small_skew):
    df = hot(spark)
    boxes = df.select("id", B.box_of_point(B.point("id", "id", "id")).alias("box"))
    rows, _ = executed(envelope.child_key_contribution(df, "fk", boxes))
    assert {r["id"]: r["box"]["xmax"] for r in rows}[7] == df.where("fk = 7").agg(F.max("id")).first()[0]


def test_staging_uses_the_folder_of_the_session(spark):
    stage = Staging(spark)
    assert stage.folder.startswith(checkpoint_folder(spark))
    kept, n = stage.keep(spark.range(5).toDF("id"))
    assert n == 5 and kept.count() == 5 and stage.folder.split("relgraph-")[-1] in kept.inputFiles()[0]
    assert stage.keep(kept.where("id > 9"))[1] == 0
    assert stage.keep_counting(kept, F.col("id") > 2)[1:] == (5, 2)
    assert stage.keep_counting(kept.limit(0), F.col("id") > 2)[1:] == (0, 0)


def test_many_steps_of_a_key_set_are_one_scan(spark):
    stage = Staging(spark)
    for step in range(1, 6):
        sets = {"a": spark.range(step).toDF("id"), "b": spark.range(0).toDF("id")}
        assert stage.append_keys(step, sets) == {"a": step, "b": 0}
    kind = spark.range(1).schema["id"].dataType
    assert stage.keys("a", "id", kind).count() == 15
    assert stage.keys("a", "id", kind, after=3).count() == 9
    assert stage.keys("b", "id", kind).count() == 0
    plan = plan_of(stage.keys("a", "id", kind, after=3))
    # one scan that opens exactly the folders of the wanted steps
    assert plan.count("FileScan") == 1 and [p.split("_step=")[1][0] for p in stage.key_paths("a", after=3)] == ["4", "5"]


def test_wide_rows_with_three_large_keys_are_exchanged_once(rows, settings):
    from relgraph.operators.deletion import key_hits

    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    df = rows("id bigint, a bigint, b bigint, c bigint, payload string", [(i, i, i + 1, None, "x") for i in range(50)])
    sets = [rows("id bigint", [(i,) for i in range(k, 50, 7)]) for k in (0, 1)]
    hit = key_hits(df, [("a", sets[0]), ("b", sets[1]), ("c", sets[0])], "mask")
    text = hit._jdf.queryExecution().executedPlan().toString()
    with_payload = [line for line in text.splitlines() if "Exchange" in line]
    plan = hit._jdf.queryExecution().executedPlan()
    wide = 0
    todo = [plan]
    while todo:
        node = todo.pop()
        wide += "Exchange" in node.nodeName() and "payload" in node.output().toString()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert wide == 1 and with_payload
    assert {r.id: r.mask for r in hit.collect()} == {i: (i % 7 == 0) + 2 * ((i + 1) % 7 == 1 and i + 1 < 50) for i in range(50)}


def test_geometry_keys_need_no_join_of_the_table_with_itself(spark, settings):
    settings(autoBroadcastJoinThreshold="-1")
    df = QUERIES["shred_surfaces"](spark, FOLDER)
    assert "SortMergeJoin" not in plan_of(df) and "customer.parquet" not in plan_of(df)
    plan = plan_of(QUERIES["shred_geometry"](spark, FOLDER))
    # the one shuffled join is with the distinct templates
    assert plan.count("SortMergeJoin") <= 1 and plan.count("_digest") > 0 and "customer.parquet" not in plan
