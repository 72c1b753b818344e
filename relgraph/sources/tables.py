"""Reading related tables, and writing what an operator leaves of them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession


def read_tables(
    spark: SparkSession,
    base: str,
    names: Iterable[str],
    fmt: str = "parquet",
    suffix: str | None = None,
    options: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """One lazy frame per table below a folder."""
    suffix = f".{fmt}" if suffix is None else suffix
    return {
        name: spark.read.format(fmt).options(**(options or {})).load(f"{base.rstrip('/')}/{name}{suffix}")
        for name in names
    }


def read_database_tables(
    spark: SparkSession,
    options: Mapping[str, str],
    split_columns: Mapping[str, tuple[str, int, int, int]],
) -> dict[str, DataFrame]:
    """One lazy frame per database table over JDBC, read in parallel.

    ``split_columns`` maps a table to (key column, lowest key, highest key,
    number of reads); each read is one task and one key range.
    """
    return {
        name: spark.read.format("jdbc")
        .options(**options, dbtable=name)
        .option("partitionColumn", column)
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", reads)
        .load()
        for name, (column, low, high, reads) in split_columns.items()
    }


def write_tables(
    frames: Mapping[str, DataFrame], base: str, fmt: str = "parquet", mode: str = "errorifexists"
) -> dict[str, str]:
    """Write frames below a new folder and return their paths.

    Survivor frames still read their source tables, so the target must be a
    new place; the default mode refuses an existing one.
    """
    paths = {}
    for name, df in frames.items():
        paths[name] = f"{base.rstrip('/')}/{name}"
        df.write.format(fmt).mode(mode).save(paths[name])
    return paths


def literal_rows(spark: SparkSession, schema: str, rows: Iterable[tuple]) -> DataFrame:
    """A small frame of literal ints and strings, such as a class registry.

    It is a local relation of known size, so Spark may broadcast it.
    """
    def text(value) -> str:
        if value is None:
            return "null"
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return str(value)

    fields = [field.split() for field in schema.split(",")]
    values = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    names = ", ".join(name for name, _ in fields)
    casts = [f"cast({name} as {kind}) as {name}" for name, kind in fields]
    if not values:
        return spark.range(0).selectExpr(*[f"cast(null as {kind}) as {name}" for name, kind in fields])
    return spark.sql(f"select {', '.join(casts)} from values {values} as t({names})")
