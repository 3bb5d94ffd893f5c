"""CSV files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.functions import csv
from flowtables.functions.csv import DEFAULT, Dialect


def csv_write(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    dialect: Dialect = DEFAULT,
    always: bool = False,
    line_end: str = "\r\n",
    bom: bool = False,
    header: bool = False,
    encoding: str = "UTF-8",
) -> None:
    """Write ``columns`` as CSV files, one per task.  With ``bom`` each file
    starts with a byte order mark, with ``header`` with the column names."""
    if line_end not in ("\n", "\r\n", "\r"):
        raise ValueError("line_end must be LF, CRLF or CR")
    line = csv.format_record([F.col(c) for c in columns], dialect, always)
    prefix = "\ufeff" if bom else ""
    if header:
        names = csv.format_record([F.lit(c) for c in columns], dialect, always)
        prefix = F.concat(F.lit(prefix), names, F.lit(line_end))
    else:
        prefix = F.lit(prefix)
    # The lower bits of this id count the rows of a task, and a task writes one file.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    lines = df.select(F.when(first, F.concat(prefix, line)).otherwise(line).alias("value"))
    writer = lines.write.option("lineSep", line_end)
    if encoding.upper() != "UTF-8":
        writer = writer.option("encoding", encoding)
    writer.option("maxRecordsPerFile", 0).text(path)
