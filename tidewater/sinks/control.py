"""The control table of high-water marks.

Rows ``(table_name, hwm_value, hwm_type, run_id, updated_at)``, one per
configured table. Each save writes the whole state as a new version
(``sinks.versioned``): a read touches one small version however many runs
came before, and a failed save leaves the previous state in place. The
state has one row per table, so it is handled as a small local list on
the driver. A missing, empty or corrupt control table reads as empty state;
any other failure (storage that cannot be reached, no permission) fails the
run, since saving over a state that was not read would lose its marks.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from tidewater.functions.marks import Mark
from tidewater.sinks.versioned import MAX_ATTEMPTS, CommitConflict, current_version, publish, read_current

CONTROL_SCHEMA = StructType([
    StructField("table_name", StringType(), False),
    StructField("hwm_value", StringType(), True),
    StructField("hwm_type", StringType(), True),
    StructField("run_id", StringType(), True),
    StructField("updated_at", TimestampType(), True),
])
STATE_COLUMNS = ("table_name", "hwm_value", "hwm_type")


def read_state(spark: SparkSession, path: str) -> dict[str, tuple]:
    """The current state as ``{table_name: row}`` (one row per table)."""
    return _state(spark, path)


# Spark's error conditions for files that are there but cannot be understood.
_CORRUPT = ("CANNOT_READ_FILE_FOOTER", "FAILED_READ_FILE.CANNOT_READ_FILE_FOOTER", "UNABLE_TO_INFER_SCHEMA",
            "UNRESOLVED_COLUMN.WITH_SUGGESTION", "UNRESOLVED_COLUMN.WITHOUT_SUGGESTION")
_CORRUPT_TEXT = ("is not a Parquet file", "Could not read footer", "CANNOT_READ_FILE_FOOTER")


def _is_corrupt(e: Exception) -> bool:
    condition = e.getCondition() if isinstance(e, PySparkException) else None
    return condition in _CORRUPT or any(t in str(e) for t in _CORRUPT_TEXT)


def _state(spark: SparkSession, path: str) -> dict[str, tuple]:
    rows = None
    try:
        rows = read_current(spark, path)
        if rows is None:
            return {}
        return {r["table_name"]: tuple(r[f.name] for f in CONTROL_SCHEMA.fields)
                for r in rows.select(*CONTROL_SCHEMA.fieldNames()).collect()}
    except Exception as e:  # noqa: BLE001 - told apart below
        if _is_corrupt(e):
            return {}
        raise


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """Current ``(table_name, hwm_value, hwm_type)`` per table."""
    rows = [v[:3] for v in _state(spark, path).values()]
    return spark.createDataFrame(rows, StructType(CONTROL_SCHEMA.fields[:3])).coalesce(1)


def append_control(marks: DataFrame, path: str, run_id: str,
                   base: dict[str, tuple] | None = None) -> None:
    """Save advanced marks ``(table_name, hwm_value, hwm_type)`` as a new state version.

    ``base`` is the state read at the start of the run; None reads it now. The marks are put into
    the state as it is at the commit, so runs that overlap keep each other's marks: a commit that another run
    has overtaken is made again from the state that run left. Where both have advanced the same table, the
    larger mark stays.
    """
    spark = marks.sparkSession
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    mine = [(r["table_name"], r["hwm_value"], r["hwm_type"], run_id, now)
            for r in marks.select(*STATE_COLUMNS).collect()]  # one row per advanced table
    for left in reversed(range(MAX_ATTEMPTS)):
        version = current_version(spark, path)
        state = _state(spark, path)
        known = state if base is None else base
        for row in mine:
            there = state.get(row[0])
            moved = there is not None and there[1:3] != (known.get(row[0]) or (None,) * 3)[1:3]
            state[row[0]] = _larger(spark, there, row) if moved else row
        try:
            publish(spark.createDataFrame(sorted(state.values()), CONTROL_SCHEMA).coalesce(1), path, base=version)
            return
        except CommitConflict:
            if not left:
                raise


def _larger(spark: SparkSession, a: tuple, b: tuple) -> tuple:
    """The row with the larger mark; marks of different types cannot be compared, and ``b`` is newer."""
    if a[2] != b[2] or a[1] is None:
        return b
    first = spark.range(1).select(Mark(a[1], a[2]).literal() > Mark(b[1], b[2]).literal()).first()[0]
    return a if first else b
