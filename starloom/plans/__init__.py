"""The pipelines a user calls, built from the functions and operators."""
