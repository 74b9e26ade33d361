"""Questions about employees (employee_id, department, salary, hire_date), as DataFrame
operations, and the first one as SQL over the frame ``employees`` too."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNT_SQL = "SELECT count(employee_id) AS employees FROM {employees}"


def number_of_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("employees"))


def number_of_employees(employees: DataFrame) -> DataFrame:
    return employees.agg(F.count("employee_id").alias("employees"))


def mean_salary(employees: DataFrame) -> DataFrame:
    return employees.agg(F.avg("salary").alias("mean_salary"))


def highest_salary(employees: DataFrame) -> DataFrame:
    return employees.groupBy("department").agg(F.max("salary").alias("highest_salary"))


def salary_per_hire_year(employees: DataFrame) -> DataFrame:
    return employees.groupBy(F.year("hire_date").alias("year")).agg(
        F.sum("salary").alias("total_salary")
    )


def employees_per_postal_code(employees: DataFrame, postal_codes: DataFrame) -> DataFrame:
    placed = postal_codes.withColumnRenamed("emp_id", "employee_id").join(
        employees, "employee_id"
    )
    return placed.groupBy("postal_code").agg(F.count("*").alias("employees"))
