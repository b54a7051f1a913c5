"""Number → text rendering with Python's format rules, for aggregated result rows.

Java's ``format_string`` rounds the shortest decimal text half-up (33.15 → "33.2"); the
reports being reproduced format with Python, which rounds the exact binary value with
ties to even (33.149999… → "33.1"). Display texts are made from already-aggregated rows
(one per test, five per summary), so an Arrow UDF applying ``str.format`` is cheap.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf


def py_format(template: str, *cols: Column) -> Column:
    """``template.format(*values)`` per row; null when any value is null."""

    @pandas_udf(T.StringType())
    def _render(rows: pd.DataFrame) -> pd.Series:
        out = []
        for vals in rows.itertuples(index=False, name=None):
            if any(v is None or (isinstance(v, float) and v != v) for v in vals):
                out.append(None)
            else:
                out.append(template.format(*[v.item() if hasattr(v, "item") else v for v in vals]))
        return pd.Series(out, dtype="object")

    return _render(F.struct(*[c.alias(f"v{i}") for i, c in enumerate(cols)]))
