"""Text, CSV and Parquet files, literal rows and generated dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starloom.functions.names import literal, quoted


def scan_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line in the column ``value``."""
    return spark.read.option("lineSep", "\n").text(path)


def scan_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """CSV with a header line. Without a schema the types are inferred, which reads it twice."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def scan_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line, every column a string."""
    return spark.read.option("header", True).csv(path)


def scan_csv_checked(
    spark: SparkSession, path: str, schema: StructType | str
) -> tuple[DataFrame, DataFrame]:
    """Rows of the CSV lines that fit the schema, and (line, reason) of those that do not.

    A line fits if it has as many fields as the schema, every field that is not empty can be read as its
    type, and none that must not be null is empty. The reason names the first field that does not
    fit. Lines that repeat the column names are headers and belong to neither; a quoted field may contain commas,
    but no line feed. Both results come from the same pass over the text; to read it once for
    both, store what ``checked_csv_lines`` gives.
    """
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    checked = checked_csv_lines(spark, path, kind)
    return checked.where("reason IS NULL").select("row.*"), checked.where(
        "reason IS NOT NULL"
    ).select("line", "reason")


def checked_csv_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """``line``, ``reason`` (null if the line fits) and ``row`` of every CSV line but headers."""
    broken = "__broken"
    texts = StructType([StructField(f.name, StringType()) for f in schema.fields])
    fields = texts.add(broken, StringType())
    parsed = scan_text(spark, path).select(
        F.regexp_replace("value", "\r$", "").alias("line")
    ).where(F.col("line") != ",".join(schema.names)).select(
        "line",
        F.from_csv(
            "line",
            ", ".join(f"{quoted(f.name)} string" for f in fields),
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken, "escape": '"'},
        ).alias("raw"),
    )
    reasons, values = [], []
    for field in schema.fields:
        raw, of = quoted("raw", field.name), field.dataType.simpleString()
        if not field.nullable:
            reasons.append(f"WHEN {raw} IS NULL THEN {literal(f'{field.name} is missing')}")
        told = literal(f"{field.name} is no {of}: ")
        reasons.append(
            f"WHEN {raw} IS NOT NULL AND try_cast({raw} AS {of}) IS NULL THEN concat({told}, {raw})"
        )
        values.append(f"try_cast({raw} AS {of}) AS {quoted(field.name)}")
    count = literal(f"not {len(schema.fields)} fields")
    return parsed.selectExpr(
        "line",
        f"CASE WHEN raw IS NULL OR raw.{broken} IS NOT NULL OR line = '' THEN {count} {' '.join(reasons)} END"
        " AS reason",
        f"struct({', '.join(values)}) AS row",
    )


def scan_parquet(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def rows_with_schema(
    spark: SparkSession, rows: Sequence[tuple], schema: StructType | str
) -> DataFrame:
    """A few literal rows with an explicit schema.

    They are part of the plan, so the planner knows how few they are; it takes rows from
    Python to be as large as can be and would shuffle a fact for them.
    """
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = [(quoted(f.name), f.dataType.simpleString()) for f in kind]

    def written(value: object, of: str) -> str:
        text = "NULL" if value is None else literal(value) if isinstance(value, str) else str(value)
        return f"cast({text} AS {of})"

    if not rows:
        return spark.range(0).selectExpr(*[f"cast(NULL AS {of}) AS {n}" for n, of in fields])
    lines = [
        "(" + ", ".join(written(v, of) for v, (_, of) in zip(row, fields)) + ")" for row in rows
    ]
    names = ", ".join(name for name, _ in fields)
    return spark.sql(f"SELECT * FROM VALUES {', '.join(lines)} AS literals({names})")


def generate_dates(spark: SparkSession, begin: str, end: str) -> DataFrame:
    """One row per day from ``begin`` to ``end``, both included, in the column ``day``."""
    return days_between(spark.range(1), f"date'{begin}'", f"date'{end}'")


def days_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row (``first_day``, ``day``) per day of every range in ``bounds``."""
    return bounds.selectExpr(
        f"{first} AS first_day", f"explode(sequence({first}, {last}, interval 1 day)) AS day"
    )
