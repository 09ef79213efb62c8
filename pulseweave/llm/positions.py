"""Places of rows in the order of their group, whatever share of the rows a group holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseweave.llm.columns import written

#: ``monotonically_increasing_id`` keeps the row number of a partition in the low bits.
ROW_BITS = 33


def numbered(spark: SparkSession, rows: DataFrame, group: str, order: list[str],
             purpose: str) -> DataFrame:
    """Add ``position`` (from 0, by ``order`` within ``group``) and ``members``, the number
    of rows of the group.

    Rows are dealt by ranges of (group, order) and numbered inside their range; a range
    begins after the rows that earlier ranges have of the group.  Rows that are equal in
    all of these spread over ranges too, in any order.  ``group`` holds no nulls.
    """
    tie = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20)).alias("_tie")
    dealt = (rows.select("*", tie).repartitionByRange(group, *order, "_tie")
             .sortWithinPartitions(group, *order, "_tie")
             .select(*rows.columns, F.monotonically_increasing_id().alias("_at")))
    stored = written(spark, dealt, purpose)
    part, row = F.shiftright("_at", ROW_BITS), F.col("_at").bitwiseAND((1 << ROW_BITS) - 1)
    stored = stored.select(*rows.columns, part.alias("_part"), row.alias("_row"))
    # One row per range and group: ranges, and groups, of which most lie in one range.
    starts = stored.groupBy(group, "_part").agg(F.min("_row").alias("_first"),
                                                F.count("*").alias("_n"))
    starts = written(spark, starts, f"{purpose}-starts")
    size = starts.groupBy(group).agg(F.sum("_n").alias("members"))
    split = size.join(starts.groupBy(group).agg(F.count("*").alias("_parts")), group)
    # Only groups that lie in several ranges have a running sum.
    many = starts.join(split.filter("_parts > 1").select(group), group, "left_semi")
    earlier = many.selectExpr(
        f"`{group}`", "_part", "sum(_n) OVER (PARTITION BY `%s` ORDER BY _part) - _n AS _earlier"
        % group)
    starts = starts.join(earlier, [group, "_part"], "left").join(size, group)
    return (stored.join(starts, [group, "_part"])
            .select(*rows.columns, "members",
                    (F.col("_row") - F.col("_first") + F.coalesce("_earlier", F.lit(0)))
                    .alias("position")))
