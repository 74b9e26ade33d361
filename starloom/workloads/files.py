"""Files and tables written from the given tables and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.numbering import dense_numbers
from starloom.plans.employees import employees_per_postal_code
from starloom.sinks.files import (
    export_tables,
    stored_in,
    write_json,
    write_parquet,
    write_table,
    write_text,
)
from starloom.sources.files import (
    scan_csv,
    scan_csv_checked,
    scan_csv_strings,
    scan_parquet,
    scan_text,
)
from starloom.workloads.basics import postal_codes, staff
from starloom.workloads.registry import query
from starloom.workloads.relations import Relations
from starloom.workloads.rides import EDGES_VIA_LOCKS_SQL, edges_via_locks
from starloom.workspace import new_folder


def _customer_csv(r: Relations) -> str:
    folder = new_folder(r.spark, "customer-csv")
    r.table("customer").write.option("header", True).csv(folder)
    return folder


@query(
    "scan_csv_infer",
    """SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey AS BIGINT)
       AS c_nationkey, c_acctbal, c_mktsegment FROM customer""",
)
def scan_csv_infer(r: Relations) -> DataFrame:
    back = scan_csv(r.spark, _customer_csv(r))
    return back.withColumns({c: F.col(c).cast("long") for c in ("c_custkey", "c_nationkey")})


@query(
    "scan_csv_string",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer""",
)
def scan_csv_string(r: Relations) -> DataFrame:
    """All columns as text; doubles are written in many ways, so that one is made uniform."""
    back = scan_csv_strings(r.spark, _customer_csv(r))
    return back.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)").cast("string"))


@query(
    "scan_parquet",
    """SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity >= 25""",
)
def scan_parquet_pruned(r: Relations) -> DataFrame:
    return (
        r.table("lineitem")
        .where(F.col("l_quantity") >= 25)
        .select("l_orderkey", "l_partkey", "l_quantity")
    )


@query(
    "sink_text",
    """SELECT CAST(o_orderkey AS VARCHAR) || chr(9) || o_orderstatus || chr(9)
       || o_orderpriority AS value FROM orders""",
)
def sink_text(r: Relations) -> DataFrame:
    folder = new_folder(r.spark, "orders-text")
    write_text(r.table("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), folder)
    return scan_text(r.spark, folder)


@query(
    "sink_table",
    """SELECT c_nationkey + 1000 AS postal_code, count(*) AS employees FROM customer GROUP BY 1""",
)
def sink_table(r: Relations) -> DataFrame:
    """Employees per postal code, saved as a catalog table."""
    counts = employees_per_postal_code(staff(r), postal_codes(r))
    folder = new_folder(r.spark, "employees_per_postal_code")
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    write_table(counts, name, path=folder)
    return r.spark.table(name)


@query("sink_parquet", "SELECT p_partkey, p_name, p_type, p_size FROM part")
def sink_parquet(r: Relations) -> DataFrame:
    folder = new_folder(r.spark, "part-parquet")
    write_parquet(r.table("part").select("p_partkey", "p_name", "p_type", "p_size"), folder)
    return scan_parquet(r.spark, folder)


@query(
    "export_parquet",
    """SELECT 'orders' AS table_name, o_orderkey AS key FROM orders
UNION ALL SELECT 'part', p_partkey FROM part
UNION ALL SELECT 'supplier', s_suppkey FROM supplier""",
)
def export_parquet(r: Relations) -> DataFrame:
    keys = {"orders": "o_orderkey", "part": "p_partkey", "supplier": "s_suppkey"}
    folders = export_tables(keys, r.table, new_folder(r.spark, "export"))
    parts = [
        scan_parquet(r.spark, folder).select(
            F.lit(name).alias("table_name"), F.col(keys[name]).alias("key")
        )
        for name, folder in folders.items()
    ]
    return parts[0].union(parts[1]).union(parts[2])


@query("sink_json_edges", EDGES_VIA_LOCKS_SQL)
def sink_json_edges(r: Relations) -> DataFrame:
    """Graph edges exported as JSON lines and read back."""
    folder = new_folder(r.spark, "edges-json")
    edges = edges_via_locks(r).withColumn(
        "datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss")
    )
    write_json(edges, folder)
    return r.spark.read.schema(edges.schema).json(folder)


# Fields of a customer's line as they were sent: of some nations with a wrong amount, without a segment,
# with a field too many, without a key, with a comma inside quotes.
_SENT = """CASE c_nationkey WHEN 5 THEN concat('n/a ', c_custkey) ELSE {amount} END AS amount,
CASE c_nationkey WHEN 9 THEN concat(c_mktsegment, ',', c_name)
     WHEN 11 THEN replace('~A, ~~B~~~', '~', chr(34)) ELSE c_mktsegment END AS segment,
CASE c_nationkey WHEN 3 THEN '' ELSE CAST(c_custkey AS {text}) END AS id, c_nationkey"""
_SENT_SQL = _SENT.format(amount="CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS VARCHAR)", text="VARCHAR")


@query(
    "csv_checked",
    f"""WITH sent AS (SELECT {_SENT_SQL} FROM customer),
lines AS (SELECT *, id || ',' || amount || CASE c_nationkey WHEN 7 THEN '' ELSE ',' || segment END AS line
  FROM sent)
SELECT CAST(CASE WHEN c_nationkey NOT IN (3, 5, 7, 9) THEN id END AS BIGINT) AS id,
  CAST(CASE WHEN c_nationkey NOT IN (3, 5, 7, 9) THEN amount END AS DOUBLE) AS amount,
  CASE WHEN c_nationkey = 11 THEN 'A, "B"' WHEN c_nationkey NOT IN (3, 5, 7, 9) THEN segment END AS segment,
  CASE WHEN c_nationkey IN (3, 5, 7, 9) THEN line END AS line,
  CASE WHEN c_nationkey IN (7, 9) THEN 'not 3 fields' WHEN c_nationkey = 3 THEN 'id is missing'
       WHEN c_nationkey = 5 THEN 'amount is no double: ' || amount END AS reason
FROM lines""",
)
def csv_checked(r: Relations) -> DataFrame:
    """Customers from lines of which some are broken: good rows, and broken lines with a reason."""
    folder = new_folder(r.spark, "customer-lines")
    fields = _SENT.format(amount="cast(cast(c_acctbal AS decimal(18, 2)) AS string)", text="string")
    sent = r.spark.sql(f"SELECT {fields} FROM {{customer}}", customer=r.table("customer"))
    line = "concat(id, ',', amount, if(c_nationkey = 7, '', concat(',', segment))) AS line"
    write_text(sent.selectExpr(line), folder)
    good, bad = scan_csv_checked(r.spark, folder, "id bigint NOT NULL, amount double, segment string")
    return good.unionByName(bad, allowMissingColumns=True)


@query(
    "dense_keys",
    """SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS customer_sk
FROM customer""",
)
def dense_keys(r: Relations) -> DataFrame:
    """Customers numbered from 1 on, the richest first."""
    store = stored_in(new_folder(r.spark, "numbering"))
    customers = r.table("customer").select("c_custkey", "c_acctbal")
    order = [F.desc("c_acctbal"), F.asc("c_custkey")]
    return dense_numbers(customers, order, "customer_sk", store).drop("c_acctbal")


BUCKETS = 16


@query(
    "join_bucketed",
    """SELECT o_orderpriority, count(*) AS lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
)
def join_bucketed(r: Relations) -> DataFrame:
    """Orders and their lines stored in the same buckets of the order key, joined in place."""
    folder = new_folder(r.spark, "bucketed")
    names = {}
    for table, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
        names[table] = f"{table}_{folder.rsplit('-', 1)[1]}"
        write_table(
            r.table(table), names[table], f"{folder}/{table}", buckets=BUCKETS, bucket_by=[key]
        )
    lines, orders = r.spark.table(names["lineitem"]), r.spark.table(names["orders"])
    return (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .groupBy("o_orderpriority")
        .agg(
            F.count("*").alias("lines"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        )
    )
