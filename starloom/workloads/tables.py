"""Updates, deletes and merges of a table of transactions, and its states in between."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.hashing import row_hash
from starloom.operators.joins import detect_changes
from starloom.operators.merge import delete_where, merge, update_where
from starloom.operators.scd2 import OPEN_END, surrogate_sql
from starloom.operators.stored_merge import merge_into
from starloom.plans import transactions
from starloom.sinks.files import write_partitioned
from starloom.workloads.registry import query
from starloom.workloads.relations import SECOND_LOAD, Relations, with_relations
from starloom.workspace import new_folder

PRODUCT = "purchase"
CUSTOMER = 7


def _plain(df: DataFrame) -> DataFrame:
    return df.withColumn("purchase_date", F.col("purchase_date").cast("string"))


_COLUMNS = """transaction_id, customer_id, CAST(purchase_date AS VARCHAR) AS purchase_date,
       product_name"""
_UPDATED = f"""SELECT {_COLUMNS}, CASE WHEN product_name = '{PRODUCT}' THEN quantity + 1
       ELSE quantity END AS quantity FROM transactions"""
_DELETED = f"{_UPDATED} WHERE customer_id <> {CUSTOMER}"
_MERGED = f"""SELECT {_COLUMNS}, CASE WHEN customer_id <> {CUSTOMER} THEN 0
       ELSE quantity END AS quantity FROM transactions"""


def _updated(r: Relations) -> DataFrame:
    return update_where(
        r.transactions, f"product_name = '{PRODUCT}'", {"quantity": "quantity + 1"}
    )


@query("update_where", with_relations("transactions", _UPDATED))
def updated(r: Relations) -> DataFrame:
    return _plain(_updated(r))


@query("delete_where", with_relations("transactions", _DELETED))
def deleted(r: Relations) -> DataFrame:
    return _plain(delete_where(_updated(r), f"customer_id = {CUSTOMER}"))


@query("merge_upsert", with_relations("transactions", _MERGED))
def merge_upsert(r: Relations) -> DataFrame:
    """Matched rows get quantity 0, rows the target lacks are inserted."""
    target = delete_where(_updated(r), f"customer_id = {CUSTOMER}")
    return _plain(
        merge(target, r.transactions, ["transaction_id"], update={"quantity": "0"})
    )


@query(
    "merge_scd2",
    with_relations(
        "salesrep_dim",
        """SELECT salesrep_sk, salesrep_id, name, office,
       strftime(scd_start, '%Y-%m-%d %H:%M:%S') AS scd_start,
       strftime(scd_end, '%Y-%m-%d %H:%M:%S') AS scd_end, md5, current FROM salesrep_dim""",
    ),
)
def merge_scd2(r: Relations) -> DataFrame:
    """The dimension load in steps: find changes, list closing and opening rows, merge."""
    old = r.salesrep_dim_first
    source = r.salesreps_later.withColumn("md5", row_hash("name", "office"))
    changes = detect_changes(source, old.where("current"), "salesrep_id", "md5")
    run_at = f"timestamp'{SECOND_LOAD}'"
    opening = changes.selectExpr(
        f"{surrogate_sql('salesrep_id', run_at)} AS salesrep_sk",
        "salesrep_id",
        "name",
        "office",
        f"{run_at} AS scd_start",
        f"timestamp'{OPEN_END}' AS scd_end",
        "md5",
        "true AS current",
    )
    closing = changes.where("dwh_current IS NOT NULL").selectExpr(
        *[f"dwh_{c} AS {c}" for c in old.columns if c not in ("scd_end", "current")],
        f"{run_at} AS scd_end",
        "false AS current",
    )
    merged = merge(
        old,
        opening.unionByName(closing).distinct(),
        ["salesrep_id"],
        update={"scd_end": "source.scd_end", "current": "source.current"},
        target_matches="current",
        source_matches="NOT current",
    )
    return merged.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("scd_start", "scd_end")}
    )


#: A delivery of some days, with what the table lacks and amounts that were put right.
_DELIVERED = "purchase_date >= date '2024-01-18' AND purchase_date < date '2024-01-25'"


@query(
    "merge_partitions",
    with_relations(
        "transactions",
        f"""SELECT {_COLUMNS}, CASE WHEN {_DELIVERED} AND customer_id % 2 = 0 THEN quantity + 1
       ELSE quantity END AS quantity FROM transactions WHERE {_DELIVERED} OR product_name <> '{PRODUCT}'""",
    ),
)
def merge_partitions(r: Relations) -> DataFrame:
    """A table stored by day, and a delivery of a week merged into it: files of other days stay."""
    path = new_folder(r.spark, "transactions-by-day")
    table = r.transactions.where(f"product_name <> '{PRODUCT}'")
    write_partitioned(table, path, ["purchase_date"])
    delivered = r.transactions.where(_DELIVERED).withColumn(
        "quantity", F.expr("if(customer_id % 2 = 0, quantity + 1, quantity)")
    )
    merge_into(
        path,
        table.schema,
        delivered,
        ["transaction_id", "purchase_date"],
        ["purchase_date"],
        when="NOT (source.quantity <=> target.quantity)",
    )
    return _plain(r.spark.read.schema(table.schema).parquet(path))


def _lifecycle(r: Relations) -> list[tuple[str, DataFrame, DataFrame]]:
    return transactions.lifecycle(r.transactions, PRODUCT, CUSTOMER)


@query("transactions_latest", with_relations("transactions", _MERGED))
def transactions_latest(r: Relations) -> DataFrame:
    return _plain(_lifecycle(r)[-1][1])


@query(
    "time_travel",
    with_relations(
        "transactions",
        f"""SELECT 0 AS version, {_COLUMNS}, quantity FROM transactions
UNION ALL SELECT 1, * FROM ({_UPDATED})
UNION ALL SELECT 2, * FROM ({_DELETED})
UNION ALL SELECT 3, * FROM ({_MERGED})""",
    ),
)
def time_travel(r: Relations) -> DataFrame:
    """All four states of the table under their numbers."""
    versions = [
        state.select(F.lit(n).alias("version"), "*")
        for n, (_, state, _) in enumerate(_lifecycle(r))
    ]
    everything = versions[0]
    for version in versions[1:]:
        everything = everything.unionByName(version)
    return _plain(everything)


@query(
    "history",
    with_relations(
        "transactions",
        f"""SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, count(*) AS num_rows, count(*) AS inserted,
       0 AS updated, 0 AS deleted FROM transactions
UNION ALL SELECT 1, 'UPDATE', count(*), 0, count(*) FILTER (product_name = '{PRODUCT}'), 0
FROM transactions
UNION ALL SELECT 2, 'DELETE', count(*) FILTER (customer_id <> {CUSTOMER}), 0, 0,
       count(*) FILTER (customer_id = {CUSTOMER}) FROM transactions
UNION ALL SELECT 3, 'MERGE', count(*), count(*) FILTER (customer_id = {CUSTOMER}),
       count(*) FILTER (customer_id <> {CUSTOMER}), 0 FROM transactions""",
    ),
)
def history(r: Relations) -> DataFrame:
    return transactions.history(_lifecycle(r))


@query(
    "detail",
    """SELECT CAST(4 AS BIGINT) AS num_versions, CAST(3 AS BIGINT) AS latest_version,
       count(*) AS num_rows FROM events""",
)
def detail(r: Relations) -> DataFrame:
    """How many states there are, and the rows of the latest."""
    steps = _lifecycle(r)
    return steps[-1][1].agg(F.count("*").alias("num_rows")).selectExpr(
        f"{len(steps)}L AS num_versions", f"{len(steps) - 1}L AS latest_version", "num_rows"
    )
