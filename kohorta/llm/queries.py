"""Registered queries of the text operators."""

from kohorta.llm import alignment, exact_dedup, html_text, lexical_search, licenses, mixing, near_dedup, packing, pii, quality, secrets, token_counts, toxicity  # noqa: F401
from kohorta.llm.common import ORACLES, QUERIES  # noqa: F401
