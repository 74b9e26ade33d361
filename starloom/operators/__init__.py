"""Joins, slowly changing dimensions, table changes and versions."""
