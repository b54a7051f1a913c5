"""Size-checked broadcast.

A dimension is broadcast only when the optimizer's size estimate of the plan that
produces it is under the session's broadcast threshold; otherwise the join stays a
shuffle join (and AQE may still convert it at run time from measured sizes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_LIMIT = 10 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer estimate of the plan's output size in bytes (no job is run)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # Spark Connect or unavailable stats
        return None


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def parse_bytes(text: str | None, default: int = DEFAULT_LIMIT) -> int:
    """'10485760b', '10m', '1g', '-1' → bytes (≤ 0 means broadcasting is off)."""
    if not text:
        return default
    t = str(text).strip().lower()
    num = t.rstrip("bkmg")
    unit = t[len(num):]
    try:
        return int(float(num) * _UNITS.get(unit, 1))
    except ValueError:
        return default


def broadcast_limit(df: DataFrame) -> int:
    return parse_bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", str(DEFAULT_LIMIT)))


def small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``broadcast(df)`` when its estimated size is within ``limit``, else ``df`` unchanged."""
    limit = broadcast_limit(df) if limit is None else limit
    size = estimated_bytes(df)
    if size is not None and 0 < limit and size <= limit:
        return F.broadcast(df)
    return df
