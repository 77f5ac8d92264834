"""Places in a total order, without one task that holds all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweave.session import saved


def numbered(rows: DataFrame, order: Sequence[str], *, name: str = "place", partitions: int | None = None) -> DataFrame:
    """Adds the place of each row in the order, from one. Rows that are equal in the order are in any order among themselves.

    Rows are dealt by ranges and sorted within them; a row's place is that in its range, and what the ranges before it hold.
    Only the counts of the ranges, one number each, are added up in one place.
    """
    dealt = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    # Written, so that the number of a range stays what it is.
    placed = saved(dealt.sortWithinPartitions(*order).withColumns({"_range": F.spark_partition_id(), "_at": within}), "ranges")
    offsets, before = [], 0
    for r in sorted(placed.groupBy("_range").count().collect()):
        offsets.append((r["_range"], before))
        before += r["count"]
    starts = rows.sparkSession.createDataFrame(offsets, "_range int, _before long")
    return placed.join(F.broadcast(starts), "_range").withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_range", "_at", "_before")
