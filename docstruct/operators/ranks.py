"""Global places of rows without a global window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows per range, about, and ranges at most.
ROWS, RANGES = 100_000, 1_000


def with_index(rows: DataFrame, order: str, out: str = "idx") -> DataFrame:
    """rows and their 0-based place in ascending order of a unique column.

    Rows are bucketed by comparison with boundary values from a sample (50 a range): counts per bucket give each bucket's
    offset, and windows number the rows inside a bucket.
    """
    total = rows.count()
    n = max(1, min(RANGES, total // ROWS))
    share = min(1.0, 50 * n / max(1, total))
    cuts = sorted({r[0] for r in rows.select(order).where(F.col(order).isNotNull()).sample(share, seed=1).collect()})[:: max(1, int(share * total / n))] if n > 1 else []
    known = F.array(*map(F.lit, cuts)) if cuts else None
    bucket = F.lit(0) if known is None else F.size(F.filter(known, lambda c: c <= F.col(order)))
    placed = rows.withColumn("_b", bucket)
    counts = {r["_b"]: r["count"] for r in placed.groupBy("_b").count().collect()}
    offset, offsets = 0, []
    for b in sorted(counts):
        offsets.append((b, offset))
        offset += counts[b]
    table = F.broadcast(rows.sparkSession.createDataFrame(offsets or [(0, 0)], "_b int, _o long"))  # a row per bucket
    inside = F.row_number().over(Window.partitionBy("_b").orderBy(order)) - 1
    return placed.join(table, "_b").withColumn(out, F.col("_o") + inside).drop("_b", "_o")
