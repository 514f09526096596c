"""All queries of the text operators; importing this registers them."""

from spindle.llm import (  # noqa: F401
    collocations, conversations, decontaminate, hilbert, langid, near_dup, packing, quality_model,
    quality_rules, secrets, substring_dedup, toxicity, url_filter,
)
from spindle.llm.registry import ORACLE, QUERIES  # noqa: F401
