"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of text that one numpy or Python step works on at a time. It bounds
# memory only: every row and every byte of a batch is processed, and a single
# longer text forms a slice of its own.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of ``texts`` that hold about ``limit`` bytes each."""
    n = len(texts)
    if n == 0:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start, base = 0, 0
    while start < n:
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, stop
        start, base = stop, int(ends[stop - 1])


def text_list(texts: pa.Array, start: int, stop: int) -> list[str]:
    """Texts of a row range; a null text counts as empty."""
    return [t or "" for t in texts.slice(start, stop - start).to_pylist()]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def struct_udf(fn, schema: str):
    """Arrow UDF that returns a struct with the fields of ``schema``.

    Marked nondeterministic only so that the optimiser never evaluates it a
    second time for a filter on one of its fields.
    """
    fields = ",".join(f.replace(" ", ":", 1) for f in schema.split(", "))
    return F.arrow_udf(fn, f"struct<{fields}>").asNondeterministic()


def spread(aggregated: DataFrame, key: str) -> DataFrame:
    """``aggregated``, its long ``key`` recomputed so that a join on it deals both sides anew.

    A join takes an aggregate's partitions as they are, and then a hot key of
    the other side cannot be split over tasks; adaptive execution splits
    it where both sides come from the join's own shuffles.
    """
    return aggregated.withColumn(key, F.col(key).bitwiseXOR(F.lit(0).cast("long")))


def kept_by_worker(key: object, make: Callable[[], object]) -> object:
    """An object that a Python worker makes once and keeps between its tasks.

    Functions that travel by value have no lasting globals, so it hangs on a module of its own.
    """
    state = sys.modules.setdefault("_tidewater_worker_state", types.ModuleType("_tidewater_worker_state")).__dict__
    if key not in state:
        state[key] = make()
    return state[key]
