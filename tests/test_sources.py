"""Reading and writing related tables."""

import tempfile

import pytest

from relgraph.operators.cascade import cascade_delete
from relgraph.sources.tables import literal_rows, read_tables, write_tables
from relgraph.workload.tables import trade_spec, trade_tables

FOLDER = "/root/testdata/sf0.001"


def test_survivors_are_written_and_read_again(spark):
    tables = trade_tables(spark, FOLDER)
    ids = tables["customer"].where("c_nationkey <> 3").selectExpr("c_custkey as id")
    result = cascade_delete(tables, trade_spec(), {"customer": ids})
    target = tempfile.mkdtemp(prefix="relgraph-test-")
    left = {t: result.survivors(t) for t in ["customer", "orders", "lineitem", "part"]}
    write_tables(left, f"{target}/out", fmt="orc")
    again = read_tables(spark, f"{target}/out", left, fmt="orc", suffix="")
    for name, df in left.items():
        assert again[name].columns == df.columns and again[name].count() == df.count()
    with pytest.raises(Exception, match="already exists"):
        write_tables(left, f"{target}/out", fmt="orc")


def test_literal_rows_keep_types_and_quotes(spark):
    df = literal_rows(spark, "id int, name string", [(1, "o'k \\ x"), (None, None)])
    assert [tuple(r) for r in df.collect()] == [(1, "o'k \\ x"), (None, None)]
    assert df.dtypes == [("id", "int"), ("name", "string")]
    assert literal_rows(spark, "id int", []).count() == 0


def test_scratch_removes_what_operators_have_written(spark, rows, tmp_path):
    import os

    from relgraph.operators.cascade import part_closure
    from relgraph.plans.staging import Staging, checkpoint_folder, scratch

    folder = checkpoint_folder(spark).removeprefix("file:")
    before, kept = set(os.listdir(folder)), Staging(spark)
    with scratch():
        gone = part_closure(rows("id bigint, up bigint", [(1, None), (2, 1), (3, 2)]), rows("id bigint", [(2,)]), "up")
        out, _ = kept.keep(gone)
        assert len(set(os.listdir(folder)) - before) > 1
    assert sorted(r.id for r in out.collect()) == [2, 3]
    assert set(os.listdir(folder)) - before == {os.path.basename(kept.folder)}
    kept.drop("step")
    assert not any(files for _, _, files in os.walk(kept.folder.removeprefix("file:")))
