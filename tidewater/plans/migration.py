"""Incremental table migration, one table or many.

Per table: select the rows above the mark (pushed into the scan) -> rename
-> NaN to NULL -> user transforms -> pin the batch so the load and the new
mark cover the same rows (a mutable source is frozen once in the shared
checkpoint folder with its metrics observed on that pass; immutable files
are read bounded above by the observed maximum) -> upsert into the current target and count the
affected rows in one join -> commit a new version (or a manifest with the new files of a
bucketed table), again from the newer version if another writer came first. Any failure leaves the target and the
mark of that table untouched; other tables go on. A batch of nothing but keys is a
plain insert: any key that exists or repeats fails it as a whole.
"""

from __future__ import annotations

import logging
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidewater.functions.coerce import nan_to_null
from tidewater.functions.marks import Mark, encode_mark
from tidewater.functions.size import observed
from tidewater.operators.marks import batch_max, commit_gate, fold_mark
from tidewater.operators.reconcile import differing_ranges, in_ranges
from tidewater.operators.rename import rename_columns
from tidewater import paths
from tidewater.operators.upsert import (AFFECTED, DEFAULT_SEQUENTIAL_ROWS, NULL_ROWS, collapse_versions, insert_only,
                                        load_metrics, merge_counted)
from tidewater.session import checkpoint_root
from tidewater.sinks.bucketed import fit_layout, merge_bucketed, read_bucketed, upsert_bucketed, with_new_columns
from tidewater.sinks.control import append_control, read_state
from tidewater.sinks.jdbc import upsert_jdbc
from tidewater.sinks.versioned import MAX_ATTEMPTS, CommitConflict, commit, current_version, publish, read_current, stage
from tidewater.sources.tables import extract, path_exists, read_jdbc_chunks, read_table
from tidewater.spec import MigrationSpec, TableSpec

log = logging.getLogger(__name__)

# Run statuses.
OK, FAILED, SKIPPED, EMPTY = "ok", "failed", "skipped", "empty"

RUN_SCHEMA = StructType([
    StructField("table_name", StringType()), StructField("target", StringType()),
    StructField("status", StringType()), StructField("incremental_column", StringType()),
    StructField("rows", LongType()), StructField("affected", LongType()),
    StructField("failed", LongType()), StructField("old_mark", StringType()),
    StructField("new_mark", StringType()), StructField("hwm_type", StringType()),
])


@dataclass
class TableRun:
    table_name: str
    target: str | None
    status: str
    incremental_column: str | None
    rows: int = 0
    affected: int = 0
    failed: int = 0
    old_mark: str | None = None
    new_mark: str | None = None
    hwm_type: str | None = None


def source_frame(spark: SparkSession, spec: MigrationSpec, t: TableSpec) -> DataFrame:
    opts = dict(t.source_options)
    location = opts.pop("path", None)
    if location is None and t.source_format in ("jdbc", "table"):
        location = t.source                       # a table name, not a path
    if location is None:
        # <root>/<name>, or <root>/<name>.<format> when only that exists
        base = f"{spec.source_root.rstrip('/')}/{t.source}"
        with_suffix = f"{base}.{t.source_format}"
        location = with_suffix if not path_exists(spark, base) and path_exists(spark, with_suffix) else base
    if t.source_format == "jdbc":
        # chunk_size rows per range of the chunk column, each range a task of its own
        return read_jdbc_chunks(spark, {"dbtable": location, **opts}, t.chunk_column, t.chunk_size)
    return read_table(spark, location, t.source_format, opts)


def migrate_table(spark: SparkSession, spec: MigrationSpec, t: TableSpec,
                  mark: Mark | None, count_affected: bool = True) -> TableRun:
    inc = t.incremental_column
    run = TableRun(t.source, t.target, SKIPPED, inc, old_mark=mark.value if mark else None,
                   hwm_type=mark.type if mark else None)
    if not t.target:
        return run
    try:
        src = source_frame(spark, spec, t)
        if inc:
            inc = next((c for c in src.columns if c.lower() == inc.lower()), inc)
            run.incremental_column = inc
            run.hwm_type = src.schema[inc].dataType.simpleString()

        def prepared(df: DataFrame) -> DataFrame:
            out = nan_to_null(rename_columns(df, t.columns, t.only_mapped))
            for fn in t.transforms:
                out = out.transform(fn)
            return out

        late = _late_ranges(spark, spec, t, src, inc, mark, prepared) if inc and mark and t.reconcile else []
        delta = _picked(src, inc, mark, t, late)

        # Size and new mark (the larger of the old mark and this batch's maximum) are those of the extract,
        # before renames and transforms.
        read_metrics = [F.count(F.lit(1)).alias("rows")]
        if inc:
            dtype = src.schema[inc].dataType
            old = mark.literal().cast(dtype) if mark else F.lit(None).cast(dtype)
            raw_max = batch_max(delta, inc)
            read_metrics += [encode_mark(fold_mark(old, raw_max), dtype).alias("mx"),
                             encode_mark(raw_max, dtype).alias("batch_max")]
        if should_freeze(t):
            # Mutable source: read it once, freeze the batch in the shared
            # checkpoint folder and observe size and maximum mark on that same pass.
            read_obs = Observation(f"extract_{uuid.uuid4().hex[:8]}")
            checkpoint_root(spark)
            batch = prepared(delta.observe(read_obs, *read_metrics)).checkpoint(eager=True)
            m = read_obs.get
        else:
            # Immutable files: an aggregate over the mark column alone; the batch is then read bounded
            # above by that maximum, so rows landing meanwhile wait for the next run.
            m = delta.agg(*read_metrics).first().asDict()
            batch = prepared(_picked(src, inc, mark, t, late, Mark(m["batch_max"], run.hwm_type))
                             if inc and m["batch_max"] is not None else delta)
        run.rows = int(m["rows"])
        if inc:
            run.new_mark = m["mx"]
        if run.rows == 0 or not batch.columns:
            run.status = EMPTY
            return run
        keys = list(t.keys or batch.columns[:1])
        inc_out = rename_name(t, inc) if inc else None
        order = [inc_out] if inc_out in batch.columns else []
        # Versions of one key are applied in incremental-column order; the
        # remaining columns break ties deterministically.
        order += [c for c in batch.columns if c not in keys and c not in order]
        if t.sink == "jdbc":
            opts = dict(t.sink_options)
            run.affected = upsert_jdbc(batch, opts.pop("url"), t.target, keys, order_by=order,
                                       dialect=opts.pop("dialect", "mysql"), properties=opts)
        elif set(keys) >= set(batch.columns):
            run.affected = _insert_keys(spark, spec, t, batch, keys, run.rows)
        else:
            affected = _merge(spark, spec, t, batch, keys, order, run.rows)
            run.affected = affected if count_affected else 0
        run.status = OK
    except Exception as e:  # noqa: BLE001 - a failed table must not stop the others
        log.warning("table %s failed: %s: %s", t.source, type(e).__name__, _masked(str(e)))
        run.status = FAILED
        run.failed = run.rows
        run.affected = 0
        run.new_mark = None
    return run


def _picked(src: DataFrame, inc: str | None, mark: Mark | None, t: TableSpec, late: list, upper: Mark | None = None) -> DataFrame:
    """The rows of this run: above the mark, and at or below it in the ranges ``late``."""
    above = extract(src, inc, mark, upper=upper, lookback=t.lookback)
    if not late:
        return above
    c = F.col(f"`{inc}`")
    dtype = src.schema[inc].dataType
    chosen = (c > mark.literal().cast(dtype)) | in_ranges(c, late)
    return extract(src.where(chosen), inc, None, upper=upper).where(c.isNotNull())


def _late_ranges(spark: SparkSession, spec: MigrationSpec, t: TableSpec, src: DataFrame, inc: str, mark: Mark, prepared) -> list:
    """Mark ranges up to the mark in which source and target differ; none where there is nothing to compare."""
    inc_out = rename_name(t, inc)
    root = _target_root(spec, t)
    if t.sink == "jdbc":
        raise ValueError("reconcile needs a file target")
    target = read_bucketed(spark, root) if t.buckets else read_current(spark, root)
    below = prepared(src.where(F.col(f"`{inc}`") <= mark.literal().cast(src.schema[inc].dataType)))
    if target is None or inc_out not in below.columns or not set(below.columns) <= set(target.columns):
        return []
    return differing_ranges(below, target, inc_out, t.reconcile)


def _target_root(spec: MigrationSpec, t: TableSpec) -> str:
    return f"{spec.target_root.rstrip('/')}/{t.target}"


def _merge(spark: SparkSession, spec: MigrationSpec, t: TableSpec, batch: DataFrame, keys: list[str],
           order: list[str], rows: int) -> int:
    """Upsert a batch and count what it did, in one plan: batch and target are each read once and joined once.

    The counts are observed above the last shuffle of the job that writes, and nothing is published when a
    key is NULL. A load that another writer overtakes is made again from the version that writer left.
    """
    root = _target_root(spec, t)
    skew_safe = rows > DEFAULT_SEQUENTIAL_ROWS
    if t.buckets:
        batch = fit_layout(batch, root, keys, t.buckets)
        checkpoint_root(spark)
        # read for the look-up of files and for the merge
        changes = _collapsed(batch, None, keys, order, skew_safe).checkpoint(eager=True)
        return merge_bucketed(changes, root, keys, t.buckets, add_columns=t.add_columns).affected
    for left in reversed(range(MAX_ATTEMPTS)):
        base = current_version(spark, root)
        target = spark.read.parquet(base) if base else None
        if target is not None and t.add_columns:
            target = with_new_columns(target, batch)
        merged = merge_counted(target, _collapsed(batch, target, keys, order, skew_safe), keys)
        obs = Observation(f"load_{uuid.uuid4().hex[:8]}")
        path = stage(merged.observe(obs, *load_metrics()).drop(AFFECTED, NULL_ROWS), root, base)
        counts = observed(obs, "affected", "null_keys")
        if counts["null_keys"]:
            paths.remove(spark, path)
            raise ValueError(f"{counts['null_keys']} rows with a NULL key in {t.source}")
        try:
            commit(spark, path)
            return counts["affected"]
        except CommitConflict:
            if not left:
                raise
    raise AssertionError("unreachable")


def _collapsed(batch: DataFrame, target: DataFrame | None, keys: list[str], order: list[str], skew_safe: bool) -> DataFrame:
    rest = [c for c in batch.columns if c not in keys]
    missing = [c for c in rest if target is not None and c not in target.columns]
    if missing:
        raise ValueError(f"source columns not in target: {missing}")
    return collapse_versions(batch, keys, order, rest, skew_safe=skew_safe)


def _insert_keys(spark: SparkSession, spec: MigrationSpec, t: TableSpec, batch: DataFrame, keys: list[str], rows: int) -> int:
    """Nothing but keys: a plain insert, where any key that is there already or comes twice fails the batch as a whole."""
    root = _target_root(spec, t)
    null_key = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
    if batch.where(null_key).limit(1).count():
        raise ValueError(f"rows with a NULL key in {t.source}")
    if t.buckets:
        batch = fit_layout(batch, root, keys, t.buckets)
    version = None if t.buckets else current_version(spark, root)
    current = read_bucketed(spark, root) if t.buckets else spark.read.parquet(version) if version else None
    base = current if current is not None else batch.limit(0)
    new_rows, conflicts = insert_only(base, batch, keys)
    if conflicts.limit(1).count():
        raise ValueError(f"duplicate keys in {t.source}")
    if t.buckets:
        upsert_bucketed(new_rows, root, keys, t.buckets)
    else:
        publish(base.unionByName(new_rows), root, base=version)
    return rows


_SECRET = re.compile(r"(password|pwd|secret|token)=[^;&\s]*", re.IGNORECASE)


def _masked(text: str) -> str:
    """An error text with credential values hidden (they can appear in JDBC URLs)."""
    return _SECRET.sub(lambda m: f"{m.group(1)}=***", text)


def should_freeze(t: TableSpec) -> bool:
    """Freeze the batch (reliable checkpoint) unless the source is immutable files."""
    if t.freeze is not None:
        return t.freeze
    return t.source_format in ("jdbc", "table")


def rename_name(t: TableSpec, col: str) -> str:
    lower = {k.lower(): v for k, v in t.columns.items()}
    return lower.get(col.lower(), col)


def runs_frame(spark: SparkSession, runs: list[TableRun]) -> DataFrame:
    """Per-table metrics as a DataFrame (one row per configured table)."""
    return spark.createDataFrame([tuple(asdict(r).values()) for r in runs], RUN_SCHEMA).coalesce(1)


def migrate_all(spark: SparkSession, spec: MigrationSpec, run_id: str | None = None,
                count_affected: bool = True, parallel_tables: int = 4) -> DataFrame:
    """Migrate every routed table, then save the advanced marks once.

    Tables are independent, so up to ``parallel_tables`` of them run at once
    (their jobs share the cluster); a failure stays within its table.
    Returns the per-table run summary with the gated ``mark``.
    """
    run_id = run_id or uuid.uuid4().hex
    control = read_state(spark, spec.state_path)
    state = {name: Mark(row[1], row[2]) for name, row in control.items()}

    def one(t: TableSpec) -> TableRun:
        return migrate_table(spark, spec, t, state.get(t.source), count_affected)

    if parallel_tables > 1 and len(spec.tables) > 1:
        with ThreadPoolExecutor(max_workers=min(parallel_tables, len(spec.tables))) as pool:
            runs = list(pool.map(one, spec.tables))
    else:
        runs = [one(t) for t in spec.tables]
    gated = commit_gate(runs_frame(spark, runs))
    rows = gated.collect()  # one row per configured table
    advanced = [(r["table_name"], r["mark"], r["hwm_type"]) for r in rows if r["advanced"]]
    if advanced:
        append_control(spark.createDataFrame(advanced, "table_name string, hwm_value string, hwm_type string"),
                       spec.state_path, run_id, base=control)
    return spark.createDataFrame(rows, gated.schema)
