"""Quoting of column names in SQL text."""

from __future__ import annotations


def quoted(*parts: str) -> str:
    """``quoted("old", "a b")`` is the column ``a b`` of the side ``old``."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def literal(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
