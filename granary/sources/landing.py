"""Landing zone: relational extracts in, Parquet files out and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators.fills import AsOf, run_time
from granary.registry import SourceTable


def landing_path(root: str, table: SourceTable) -> str:
    return f"{root.rstrip('/')}/{table.schema}/{table.name}"


def extract_query(table: SourceTable) -> str:
    return table.extract_query or f"SELECT * FROM {table.schema}.{table.name}"


def jdbc_options(
    table: SourceTable,
    connection: Mapping[str, str],
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> dict[str, str]:
    """Reader options for one table: a single query, or ranges read in parallel."""
    options = {"fetchsize": "10000", **connection}
    if partition_column is None or bounds is None:
        return options | {"query": extract_query(table)}
    return options | {
        "dbtable": f"({extract_query(table)}) extract",
        "partitionColumn": partition_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
    }


def column_bounds(
    spark: SparkSession, table: SourceTable, connection: Mapping[str, str], column: str
) -> tuple[int, int] | None:
    """Lowest and highest value of a numeric column, asked of the database."""
    query = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table.schema}.{table.name}"
    row = spark.read.format("jdbc").options(**connection, query=query).load().first()
    return None if row is None or row[0] is None else (int(row[0]), int(row[1]))


def extract(
    spark: SparkSession,
    table: SourceTable,
    connection: Mapping[str, str],
    partition_column: str | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Read a whole table over JDBC, in parallel ranges where a column is named."""
    bounds = column_bounds(spark, table, connection, partition_column) if partition_column else None
    options = jdbc_options(table, connection, partition_column, bounds, partitions)
    return spark.read.format("jdbc").options(**options).load()


def boundary_query(table: SourceTable, keys: Sequence[str], partitions: int) -> str:
    """SQL for the keys that begin each of so many parts of equal size, but the first; in the database's own order.

    The database numbers its keys, which an index on them serves, and returns
    one row per part. Text keys are compared by its collation, whatever that
    is, so the parts neither overlap nor leave a row out.
    """
    names = ", ".join(keys)
    return (
        f"SELECT {names} FROM (SELECT {names}, ROW_NUMBER() OVER (ORDER BY {names}) AS place, "
        f"COUNT(*) OVER () AS total FROM {table.schema}.{table.name} WHERE {_all_there(keys)}) numbered "
        f"WHERE place > 1 AND (place - 1) * {partitions} % total < {partitions} ORDER BY {names}"
    )


def _all_there(keys: Sequence[str]) -> str:
    return " AND ".join(f"{k} IS NOT NULL" for k in keys)


def sql_literal(value: Any) -> str:
    """A key value as ANSI SQL."""
    if isinstance(value, bool):
        return "1" if value else "0"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, datetime):
        return f"CAST('{value.isoformat(sep=' ')}' AS TIMESTAMP)"
    if isinstance(value, date):
        return f"CAST('{value.isoformat()}' AS DATE)"
    return "'" + str(value).replace("'", "''") + "'"


def _from_on(keys: Sequence[str], values: Sequence[Any]) -> str:
    """TRUE for keys that are not below ``values``, compared part by part."""
    terms = []
    for n, (key, value) in enumerate(zip(keys, values)):
        same = [f"{k} = {sql_literal(v)}" for k, v in zip(keys[:n], values[:n])]
        last = ">=" if n == len(keys) - 1 else ">"
        terms.append(" AND ".join([*same, f"{key} {last} {sql_literal(value)}"]))
    return "(" + " OR ".join(f"({t})" for t in terms) + ")"


def range_predicates(keys: Sequence[str], starts: Sequence[Sequence[Any]]) -> list[str]:
    """One condition per part: each row meets exactly one, rows with a NULL in their key the last one.

    ``starts`` are the first keys of the second and later parts, in order.
    Keys that repeat begin one part.
    """
    cuts = [_from_on(keys, s) for s in dict.fromkeys(map(tuple, starts))]
    there = _all_there(keys)
    parts = [" AND ".join([there, *([low] if low else []), *([f"NOT {high}"] if high else [])])
             for low, high in zip([None, *cuts], [*cuts, None])]
    return [*parts, f"NOT ({there})"]


def extract_ranges(
    spark: SparkSession, table: SourceTable, connection: Mapping[str, str], partitions: int
) -> DataFrame:
    """Read a whole table over JDBC in parts of equal size along its key, of whatever type and number of columns.

    One task reads one part, so a text key, a composite or a sparse one is as
    parallel as a dense number. What is collected is one key per part.
    """
    query = boundary_query(table, table.keys, partitions)
    starts = spark.read.format("jdbc").options(**connection, query=query).load().collect()
    named = f"({extract_query(table)}) extract"
    options = {"fetchsize": "10000", **connection}
    return spark.read.jdbc(
        options.pop("url"), named, predicates=range_predicates(table.keys, starts), properties=options
    )


def write_landing(df: DataFrame, root: str, table: SourceTable) -> str:
    """Replace the landed files of a table with snappy Parquet."""
    path = landing_path(root, table)
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def read_landing(
    spark: SparkSession, root: str, table: SourceTable, as_of: AsOf = None, merge_schema: bool = False
) -> DataFrame:
    """The landed rows with their load time and the file each came from.

    One extract writes files of one schema, and reading a single footer is
    enough. ``merge_schema`` reads them all, for files that differ in columns.
    """
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    landed = reader.parquet(landing_path(root, table))
    return landed.select(
        "*",
        run_time(as_of).alias("_process_timestamp"),
        F.col("_metadata.file_path").alias("_input_file_name"),
    )
