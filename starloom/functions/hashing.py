"""Row hashes for change detection and stable surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit separator between fields, record separator in place of a null.
FIELD_SEPARATOR = r"\u001f"
NULL_MARKER = r"\u001e"


def row_hash_sql(*expressions: str) -> str:
    """md5 over all expressions, in order, as SQL text.

    A separator keeps ('ab', 'c') and ('a', 'bc') apart and a marker stands for null, so
    the hash itself is never null. Doubles should be cast to decimal by the caller: their
    text form is not stable between engines.
    """
    fields = [f"coalesce(cast({e} AS string), '{NULL_MARKER}')" for e in expressions]
    return f"md5(concat_ws('{FIELD_SEPARATOR}', {', '.join(fields)}))"


def row_hash(*expressions: str) -> Column:
    """``row_hash_sql`` as a column."""
    return F.expr(row_hash_sql(*expressions))
