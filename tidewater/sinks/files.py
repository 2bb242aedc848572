"""One output per input file, lines in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_per_file_text(lines: DataFrame, path: str, name_col: str = "out_name",
                        order: tuple[str, ...] = ("section", "line_no"),
                        value_col: str = "line") -> None:
    """Write ``lines`` as text under ``path/<name_col>=<name>/``.

    Rows are range-partitioned on (name, order...) so one large output is
    spread over several ordered part files instead of one task; the part
    files of a folder, taken in name order, hold the lines in order.
    """
    key = [name_col, *order]
    # no explicit count: AQE may merge adjacent ranges, which keeps the order
    (lines.repartitionByRange(*key).sortWithinPartitions(*key)
     .select(F.col(value_col).alias("value"), name_col)
     .write.mode("overwrite").partitionBy(name_col).text(path))
