"""Scalar rules as native expressions, and vectorised user functions."""

from spindle.functions.scalar import (  # noqa: F401
    child_or_sex, default_if_null, missing, relabel, split_words, sum_flag,
)
from spindle.functions.udf import register_vectorized  # noqa: F401
