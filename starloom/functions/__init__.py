"""Column expressions. All of them run inside the JVM; there is no UDF.

Arguments are column names or other SQL expressions as text. Expressions are put together as
text too and parsed once, which is much faster than building them call by call.
"""
