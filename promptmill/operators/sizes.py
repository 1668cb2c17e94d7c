"""How many partitions rows need, so that what one task sorts stays bounded however many rows there are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: About what the rows of one partition take; rows cost this much besides their texts.
PART_BYTES = 32 << 20
ROW_BYTES = 64
#: Up to this number of partitions Spark writes a shuffle without holding the rows of a task; more
#: partitions are made only when they would get larger than ``MOST_PART_BYTES``.
UNBUFFERED_PARTS = 200
MOST_PART_BYTES = 256 << 20


def parts_for(*frames: DataFrame, part_bytes: int = PART_BYTES) -> int:
    """Partitions of about ``part_bytes`` (of more, where that would take over ``UNBUFFERED_PARTS`` of
    them, but of at most ``MOST_PART_BYTES``) that hold all rows of ``frames``.

    Texts count with their length, other columns with 8 bytes.  Each frame is read once, for one row
    of sums: hand in scans, written tables or something narrow above one.
    """
    total = 0
    for df in frames:
        size = F.lit(ROW_BYTES + 8 * len(df.columns)).cast("long")
        for name, kind in df.dtypes:
            if kind in ("string", "binary"):
                size = size + F.coalesce(F.octet_length(df[f"`{name}`"]), F.lit(0))
        total += df.agg(F.sum(size)).first()[0] or 0
    return max(1, min(-(-total // part_bytes), UNBUFFERED_PARTS), -(-total // max(part_bytes, MOST_PART_BYTES)))
