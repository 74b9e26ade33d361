"""The life of a table of transactions (transaction_id, customer_id, purchase_date,
product_name, quantity): write, update, delete, merge.

Each step is a function from the table before to the table after; keeping versions is the
business of a table format, see ``write_table``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.names import literal
from starloom.operators.merge import (
    ACTION,
    DELETED,
    INSERTED,
    UPDATED,
    delete_where,
    merge,
    update_where,
)


def lifecycle(
    transactions: DataFrame, product: str, customer: int
) -> list[tuple[str, DataFrame, DataFrame]]:
    """(operation, table after it, its rows with their ``ACTION``) for each of four steps: all rows; one
    more of ``product``; without ``customer``; the original rows merged back, which sets the quantity
    of present rows to 0 and inserts the others."""
    written = transactions.withColumn(ACTION, F.lit(INSERTED))
    bought = f"product_name = {literal(product)}"
    updated = update_where(transactions, bought, {"quantity": "quantity + 1"}, marked=True)
    before_delete = updated.drop(ACTION)
    gone = f"customer_id = {customer}"
    deleted = delete_where(before_delete, gone, marked=True)
    after_delete = delete_where(before_delete, gone)
    merged = merge(
        after_delete, transactions, ["transaction_id"], update={"quantity": "0"}, marked=True
    )
    return [
        ("WRITE", transactions, written),
        ("UPDATE", before_delete, updated),
        ("DELETE", after_delete, deleted),
        ("MERGE", merged.drop(ACTION), merged),
    ]


def history(steps: list[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """version, operation, num_rows, inserted, updated and deleted of each step."""

    def summary(version: int, operation: str, marked: DataFrame) -> DataFrame:
        def number(action: str):
            return F.count_if(F.col(ACTION) == action)

        return marked.agg(
            (F.count("*") - number(DELETED)).alias("num_rows"),
            number(INSERTED).alias("inserted"),
            number(UPDATED).alias("updated"),
            number(DELETED).alias("deleted"),
        ).selectExpr(f"{version}L AS version", f"'{operation}' AS operation", "*")

    rows = [summary(n, operation, marked) for n, (operation, _, marked) in enumerate(steps)]
    everything = rows[0]
    for row in rows[1:]:
        everything = everything.unionByName(row)
    return everything
