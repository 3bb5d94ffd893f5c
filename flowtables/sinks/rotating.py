"""Writing rotated files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rotate_write(
    df: DataFrame,
    path: str,
    line: str,
    key: str | Sequence[str],
    order: str | Sequence[str],
    file: str = "file_no",
    row_no: str | None = None,
    rows_per_part: int = 5_000_000,
    line_end: str = "\n",
    writer: Callable[[DataFrame, str], None] | None = None,
) -> None:
    """Write each file of a rotated table as the folder ``key=../file_no=..``.

    A file is a run of parts ``part=0``, ``part=1``, ... of at most
    ``rows_per_part`` rows, so a file that is never rotated does not become one
    task; its content is the parts in order.  This needs ``row_no``, the row's
    position in its file (:func:`flowtables.operators.rotation.rotate` adds it);
    without it a file is one part, for files of limited size.
    ``writer(rows, path)`` replaces the text writer; its rows arrive partitioned
    by file and part and sorted.
    """
    key = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    part = F.expr(f"int(({row_no} - 1) div {rows_per_part})") if row_no else F.lit(0)
    folders = [*key, file, "part"]
    rows = df.withColumn("part", part).repartition(*folders).sortWithinPartitions(*folders, *order)
    if writer is not None:
        writer(rows, path)
        return
    rows.select(*folders, F.col(line).cast("string").alias("value")).write.option(
        "lineSep", line_end
    ).partitionBy(*folders).text(path)
