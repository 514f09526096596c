"""User functions by name, for SQL and DataFrame use.

Native expressions (``spindle.functions.scalar``) come first.  Where a user
brings code of their own it is registered as a vectorised pandas UDF (Arrow
batches), never row-at-a-time, with an explicit null policy.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def register_vectorized(spark: SparkSession, name: str, fn: Callable[..., pd.Series],
                        return_type: str, null_in_null_out: bool = True):
    """Register ``fn(*pd.Series) -> pd.Series`` under ``name``.

    With ``null_in_null_out`` a row with a null (or NaN, which pandas does not
    tell apart in a number column) argument gives null and never reaches
    ``fn``, so ``fn`` need not handle missing values.
    """

    def wrapped(*cols: pd.Series) -> pd.Series:
        if not (null_in_null_out and cols):
            return pd.Series(fn(*cols))
        present = cols[0].notna()
        for c in cols[1:]:
            present = present & c.notna()
        if present.all():
            return pd.Series(fn(*cols))
        # only rows without nulls reach ``fn``; an object column keeps large integers exact
        out = pd.Series([None] * len(present), dtype=object, index=present.index)
        if present.any():
            kept = [c[present].infer_objects() for c in cols]
            out[present] = pd.Series(fn(*kept)).to_numpy(dtype=object)
        return out

    udf = F.pandas_udf(wrapped, returnType=return_type)
    spark.udf.register(name, udf)
    return udf
