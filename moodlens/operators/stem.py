"""Stemming of token arrays: one Arrow-batched pandas UDF, narrow (no shuffle).

Inside each batch the distinct words are stemmed once and mapped back, so the Python cost grows
with the number of distinct words per batch, not with the number of tokens.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

_UDF = None


def _make():
    from ..functions.porter import stem

    @F.pandas_udf(ArrayType(StringType()))
    def stem_arrays(col: pd.Series) -> pd.Series:
        lengths = col.map(lambda a: 0 if a is None else len(a))
        flat = [w for a in col if a is not None for w in a]
        if not flat:
            return col
        uniq = pd.unique(np.asarray(flat, dtype=object))
        table = {w: (None if w is None else stem(w)) for w in uniq}
        out, pos = [], 0
        stems = [table[w] for w in flat]
        for a, n in zip(col, lengths):
            if a is None:
                out.append(None)
            else:
                out.append(stems[pos : pos + n])
                pos += n
        return pd.Series(out, index=col.index)

    return stem_arrays


def stem_tokens(tokens) -> Column:
    """Porter stems of an ``array<string>`` column (words are lower-cased first)."""
    global _UDF
    if _UDF is None:
        _UDF = _make()
    return _UDF(F.col(tokens) if isinstance(tokens, str) else tokens)
