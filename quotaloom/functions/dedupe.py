"""Keep-first duplicate removal as an aggregate.

``dropDuplicates`` keeps an arbitrary row; the reference keeps the first row in input
order. We carry an ordering column and keep, per key, the row with the least ordering
value via ``min(struct(order, payload))``. Being an aggregate it is planned as a partial
(map-side) plus final aggregation, so a key that holds a third of all rows collapses to
one row per map task before the shuffle instead of landing whole in one task as a
``row_number()`` window would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per ``keys`` (nulls form one key), the one with the least ``order``; ties: the least other columns.

    Columns named in ``order`` are carried once.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    named = [o for o in order if isinstance(o, str)] if all(isinstance(o, str) for o in order) else []
    payload = [c for c in df.columns if c not in keys and c not in named]
    q = lambda c: "`" + c.replace("`", "``") + "`"
    if named:
        # one SQL expression: far fewer driver↔JVM calls than building it column by column
        parts = [f"struct({', '.join(q(o) for o in named)}) AS _o", *[q(c) for c in payload]]
        best = F.expr(f"min(struct({', '.join(parts)})) AS _r")
    else:
        order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
        best = F.min(F.struct(F.struct(*order_cols).alias("_o"), *[F.col(c) for c in payload])).alias("_r")
    r = df.groupBy(*keys).agg(best)
    kept = [c for c in df.columns if c not in keys]
    return r.selectExpr(*[q(k) for k in keys], *[f"_r.{'_o.' * (c in named)}{q(c)} AS {q(c)}" for c in kept])


def ingest_sequence() -> Column:
    """File order of a file scan: (file, split start, row position within the split).

    Splits are packed into partitions by size, not by file order, so the partition
    index alone is not file order; within one split the monotonically increasing id
    follows row order. Deterministic on re-execution (same splits, same ids).
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
