"""Loading into relational databases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameWriter

from starloom.operators.merge import rows_not_in


def jdbc_writer(
    df: DataFrame, table: str, connection: Mapping[str, str], connections: int | None = None
) -> DataFrameWriter:
    """A JDBC writer; ``connections`` limits how many tasks write at the same time."""
    writer = df.write.format("jdbc").options(**connection).option("dbtable", table)
    return writer if connections is None else writer.option("numPartitions", connections)


def append_table(
    df: DataFrame, table: str, connection: Mapping[str, str], connections: int | None = None
) -> None:
    """Append all rows.

    Every task commits its own rows. If a task is repeated after it has committed, its rows
    are there twice; where that matters, load with ``append_new_rows`` into a table with a
    unique key, or overwrite.
    """
    jdbc_writer(df, table, connection, connections).mode("append").save()


def append_new_rows(
    df: DataFrame,
    existing: DataFrame,
    keys: Sequence[str],
    table: str,
    connection: Mapping[str, str],
    connections: int | None = None,
) -> None:
    """Append the rows whose natural key ``existing`` lacks, so a repeated load adds nothing."""
    append_table(rows_not_in(df, existing, keys), table, connection, connections)


def overwrite_table(
    df: DataFrame,
    table: str,
    connection: Mapping[str, str],
    keep_definition: bool = True,
    connections: int | None = None,
) -> None:
    """Replace all rows; ``keep_definition`` empties the table instead of dropping it."""
    writer = jdbc_writer(df, table, connection, connections).mode("overwrite")
    writer.option("truncate", keep_definition).save()
