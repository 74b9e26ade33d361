"""All queries of this package by name, and their twins in SQL."""

from starloom.llm import (  # noqa: F401
    chat,
    clustering,
    decontaminate,
    exact_dedup,
    jaccard_join,
    lexical_search,
    license_scan,
    packing,
    personal_data,
    quality,
    substring_dedup,
    token_counts,
    toxicity,
)
from starloom.llm.common import ORACLES, QUERIES  # noqa: F401
