"""Folder combine: every CSV file followed by the lines of one text file.

Output ``combined_<file>`` holds the CSV's lines, then the text's lines.
The text is read once and fanned out to each CSV name with ``explode``
over the file list (the folder listing the driver already holds,
that every task gets as one literal), so a large text is not funnelled through one task and
the plan does not grow with the number of files.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.sinks.files import write_per_file_text
from tidewater.sources.files import CSV_GLOB, base_name, csv_files, read_text_lines

# Output name prefix and section numbers.
OUTPUT_PREFIX = "combined_"
CSV_SECTION, TEXT_SECTION = 0, 1


def combine_folder(spark: SparkSession, csv_folder: str, text_path: str,
                   out_dir: str | None = None) -> DataFrame:
    """``(out_name, section, line_no, line)``; written per file when ``out_dir`` is given."""
    names = [base_name(f) for f in csv_files(spark, csv_folder)]
    csv_lines = read_text_lines(spark, csv_folder, CSV_GLOB).select(
        "file_name", F.lit(CSV_SECTION).alias("section"), "line_no", "line")
    if names:
        # all names are one literal, whatever their number; every line is repeated for each
        files = F.from_json(F.lit(json.dumps(names)), "array<string>")
        text = read_text_lines(spark, text_path).select(
            F.explode(files).alias("file_name"), F.lit(TEXT_SECTION).alias("section"), "line_no", "line")
        lines = csv_lines.unionByName(text)
    else:
        lines = csv_lines
    out = lines.select(F.concat(F.lit(OUTPUT_PREFIX), "file_name").alias("out_name"),
                       "section", "line_no", "line")
    if out_dir:
        write_per_file_text(out, out_dir)
    return out
