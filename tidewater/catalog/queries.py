"""Spark side of the query catalogue: ``name -> fn(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.functions.coerce import fill_missing, nan_to_null, try_number, try_timestamp
from tidewater.functions.marks import Mark, TS_NTZ_FORMAT, encode_mark
from tidewater.operators.dedup import keep_last
from tidewater.operators.enrich import enrich_left, enrich_stats, load_lookup
from tidewater.operators.marks import batch_max, commit_gate, fold_mark
from tidewater.operators.rename import rename_columns, select_mapped
from tidewater.operators.upsert import affected_rows, collapse_versions, insert_only_stats, upsert
from tidewater.operators.validate import validate_messages, validation_stats
from tidewater.plans.combine import combine_folder
from tidewater.plans.ingest import (SUMMARY, decode_messages, decode_stats, dedup_stats, dedup_valid,
                                   ingest_batch, load_batch, prepare_for_run)
from tidewater.plans.migration import migrate_all
from tidewater.session import apply_defaults, checkpoint_root, scratch_path
from tidewater.sinks.control import append_control, read_control, read_state
from tidewater.sinks.bucketed import merge_bucketed, read_bucketed
from tidewater.sinks.events import SINK_COLUMNS, append_daily
from tidewater.sinks.versioned import read_current
from tidewater.sources.files import (export_csv, export_csv_split, export_lines, export_text, read_csv_folder_raw,
                                     read_csv_folder_typed, read_text_whole)
from tidewater.sources.messages import bounded_batch, bounded_messages, messages_from_events
from tidewater.sources.ranges import range_stats
from tidewater.sources.tables import chunk_stats, extract, read_table
from tidewater.spec import IngestSpec, MigrationSpec, TableSpec
from tidewater.streaming.ingest_stream import ingest_stream, read_message_stream

Query = Callable[[SparkSession, str], DataFrame]

# Query parameters shared with the oracle statements.
ORDERS_MARK = "1998-01-01T00:00:00.000000"
FUTURE_MARK = "2100-01-01T00:00:00.000000"
EVENTS_SPLIT = "2024-01-15T00:00:00"
CHUNK_SIZE = 10000
MAX_MESSAGES = 1000
SUPPLIER_ROWS_PER_FILE = 50000
ORDERS_PER_FILE = 100_000
RENAME_MAP = {"C_CUSTKEY": "customer_id", "c_name": "customer_name", "c_acctbal": "balance",
              "c_missing": "never_used"}


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _ntz(c):
    return c.cast("timestamp_ntz")


# ---------------------------------------------------------------- extracts

def full_extract(spark, sf):
    # no incremental column: a supplied mark is ignored
    return extract(_t(spark, sf, "nation"), None, Mark("3", "int"))


def incremental_extract(spark, sf):
    return extract(_t(spark, sf, "orders"), "o_orderdate", Mark(ORDERS_MARK, "timestamp_ntz"))


def initial_extract(spark, sf):
    # incremental column but no mark yet: every row, NULL marks included
    return extract(_t(spark, sf, "orders"), "o_orderdate", None)


def q_chunk_stats(spark, sf):
    return chunk_stats(_t(spark, sf, "orders"), "o_orderkey", CHUNK_SIZE)


def range_balance(spark, sf):
    """Equi-depth read ranges of a sparse, skewed key: every row in one range, none much larger than asked for."""
    o = _t(spark, sf, "orders").withColumn("sparse", F.concat(F.lit("k"), F.lpad((F.col("o_orderkey") ** 3).cast("decimal(38,0)").cast(
        "string"), 30, "0")))
    per = o.count() // 12 + 1
    stats = range_stats(o, "sparse", per)
    return stats.agg(F.sum("rows").alias("rows"), (F.count(F.lit(1)) >= 10).alias("many_ranges"),
                     (F.max("rows") <= 2 * per).alias("none_twice_too_large"))


def table_rename(spark, sf):
    return rename_columns(_t(spark, sf, "customer"), RENAME_MAP)


def q_select_mapped(spark, sf):
    return select_mapped(_t(spark, sf, "customer"), RENAME_MAP)


# ---------------------------------------------------------------- marks

_MARK_TABLES = (("orders", "o_orderdate", ORDERS_MARK), ("lineitem", "l_shipdate", None),
                ("events", "ts", FUTURE_MARK))


def hwm_max(spark, sf):
    parts = []
    for name, col, old in _MARK_TABLES:
        df = _t(spark, sf, name)
        old_c = F.lit(old).cast("timestamp_ntz")
        parts.append(df.agg(batch_max(df, col).alias("batch_max")).select(
            F.lit(name).alias("table_name"), old_c.alias("old_mark"), "batch_max",
            fold_mark(old_c, F.col("batch_max")).alias("new_mark")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def hwm_numeric_coerce(spark, sf):
    o = _t(spark, sf, "orders")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.substring("o_orderpriority", 1, 1)) \
        .otherwise(F.col("o_orderpriority")).alias("mark_text")
    df = o.select("o_orderstatus", text)
    num = try_number("mark_text")
    return df.groupBy("o_orderstatus").agg(
        batch_max(df, "mark_text", numeric=True).alias("hwm"),
        F.count(num).alias("numeric_rows"),
        F.count_if(num.isNull()).alias("ignored_rows"))


def _mark_metrics(spark, sf, tables) -> DataFrame:
    """Per-table metrics of an incremental read above the old mark."""
    parts = []
    for name, col, old, key in tables:
        df = _t(spark, sf, name)
        if col is None:
            parts.append(df.agg(F.count(F.lit(1)).alias("rows"),
                                F.count_if(F.col(key).isNull()).alias("failed")).select(
                F.lit(name).alias("table_name"), F.lit(None).cast("string").alias("incremental_column"),
                F.lit(None).cast("string").alias("old_mark"), F.lit(None).cast("string").alias("new_mark"),
                F.lit(None).cast("string").alias("hwm_type"), "rows", "failed"))
            continue
        dtype = df.schema[col].dataType
        delta = extract(df, col, Mark(old, dtype.simpleString()) if old else None)
        old_c = F.lit(old).cast(dtype)
        parts.append(delta.agg(batch_max(delta, col).alias("mx"), F.count(F.lit(1)).alias("rows"),
                               F.count_if(F.col(key).isNull()).alias("failed")).select(
            F.lit(name).alias("table_name"), F.lit(col).alias("incremental_column"),
            F.lit(old).cast("string").alias("old_mark"),
            encode_mark(fold_mark(old_c, F.col("mx")), dtype).alias("new_mark"),
            F.lit(dtype.simpleString()).alias("hwm_type"), "rows", "failed"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_GATE_TABLES = (("orders", "o_orderdate", ORDERS_MARK, "o_orderkey"),
                ("lineitem", "l_shipdate", None, "l_orderkey"),
                ("events", "ts", FUTURE_MARK, "event_id"),
                ("customer", None, None, "c_custkey"))


def state_commit_gate(spark, sf):
    g = commit_gate(_mark_metrics(spark, sf, _GATE_TABLES))
    return g.select("table_name", "incremental_column", "old_mark", "new_mark", "rows", "failed",
                    "mark", "advanced")


def hwm_advance(spark, sf):
    """Seed a control table with old marks, gate this run's marks, append, read back."""
    state = scratch_path(spark, "control")
    seed = spark.createDataFrame([("orders", ORDERS_MARK, "timestamp_ntz"),
                                  ("events", FUTURE_MARK, "timestamp_ntz")],
                                 "table_name string, hwm_value string, hwm_type string")
    append_control(seed, state, "seed")
    old = {r["table_name"]: r["hwm_value"] for r in read_control(spark, state).collect()}
    tables = [(n, c, old.get(n), c) for n, c, _ in _MARK_TABLES]
    g = commit_gate(_mark_metrics(spark, sf, tables))
    advanced = g.where("advanced").select("table_name", F.col("mark").alias("hwm_value"), "hwm_type")
    append_control(advanced, state, "run-1")
    return read_control(spark, state)


# ---------------------------------------------------------------- coercions

def q_nan_to_null(spark, sf):
    li = _t(spark, sf, "lineitem")
    nan = F.lit(float("nan"))
    li = li.withColumn("l_discount", F.when(F.col("l_orderkey") % 5 == 0, nan).otherwise(F.col("l_discount"))) \
           .withColumn("l_tax", F.when(F.col("l_orderkey") % 7 == 0, nan).otherwise(F.col("l_tax")))
    return nan_to_null(li)


def type_coerce(spark, sf):
    ev = _t(spark, sf, "events")
    ts_text = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("bad "), F.col("event_id").cast("string"))) \
        .otherwise(F.date_format("ts", TS_NTZ_FORMAT))
    v_text = F.when(F.col("event_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    return ev.select("event_id", _ntz(try_timestamp(ts_text)).alias("ts_parsed"),
                     try_number(v_text).alias("value_num"))


def q_fill_missing(spark, sf):
    c = _t(spark, sf, "customer")
    c = c.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 5 == 0, F.lit(None)).otherwise(F.col("c_mktsegment"))) \
         .withColumn("c_acctbal", F.when(F.col("c_custkey") % 7 == 0, F.lit(None)).otherwise(F.col("c_acctbal")))
    return fill_missing(c, {"c_mktsegment": "UNKNOWN", "c_acctbal": 0.0})


# ---------------------------------------------------------------- loads

def _upsert_inputs(spark, sf):
    c = _t(spark, sf, "customer")
    target = c.where(F.col("c_custkey") % 2 == 0).withColumn("t_note", F.lit("kept"))
    source = c.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("c_name"),
        "c_nationkey",
        F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        "c_mktsegment")
    return target, source


def upsert_merge(spark, sf):
    target, source = _upsert_inputs(spark, sf)
    return upsert(target, source, ["c_custkey"], unique_keys=True)


def upsert_last_wins(spark, sf):
    return keep_last(_t(spark, sf, "events"), ["user_id"], ["ts", "event_id"])


def q_affected_rows(spark, sf):
    c = _t(spark, sf, "customer")
    target = c.where(F.col("c_custkey") % 2 == 0)
    v1 = c.select("c_custkey", "c_name", "c_nationkey",
                  F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal") + 100)
                  .otherwise(F.col("c_acctbal")).alias("c_acctbal"),
                  "c_mktsegment", F.lit(1).alias("ver"))
    v2 = v1.where(F.col("c_custkey") % 4 == 0).withColumn("c_mktsegment", F.lit("CHANGED")) \
        .withColumn("ver", F.lit(2))
    a = affected_rows(target, v1.unionByName(v2), ["c_custkey"], ["ver"])
    return a.groupBy("change").agg(F.count(F.lit(1)).alias("rows"),
                                   F.sum("affected").cast("bigint").alias("affected"))


def insert_only_conflicts(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey")
    return insert_only_stats(p.where(F.col("p_partkey") % 2 == 0), p, ["p_partkey"])


def incremental_two_runs(spark, sf, buckets: int | None = None):
    """Run 1 sees the events up to a split point, run 2 the whole table."""
    work = scratch_path(spark, "two_runs")
    events = _t(spark, sf, "events")
    events.where(F.col("ts") <= F.lit(EVENTS_SPLIT).cast("timestamp_ntz")) \
        .write.mode("overwrite").parquet(f"{work}/snapshot1")
    def spec(path):
        t = TableSpec(source="events", target="events_latest", incremental_column="ts",
                      keys=["user_id"], source_options={"path": path}, buckets=buckets)
        return MigrationSpec(tables=[t], source_root=sf, target_root=f"{work}/target",
                             state_path=f"{work}/control")
    r1 = migrate_all(spark, spec(f"{work}/snapshot1")).collect()
    r2 = migrate_all(spark, spec(f"{sf.rstrip('/')}/events.parquet")).collect()
    if r1[0]["status"] != "ok" or r2[0]["status"] != "ok":
        raise RuntimeError(f"migration failed: {r1} {r2}")
    if buckets:
        return read_bucketed(spark, f"{work}/target/events_latest")
    return read_current(spark, f"{work}/target/events_latest")


def incremental_two_runs_bucketed(spark, sf):
    """Same two runs into a key-bucketed target (only touched buckets rewritten)."""
    return incremental_two_runs(spark, sf, buckets=16)


LATE_SPLIT = "2000-01-01T00:00:00"


def late_rows_found(spark, sf):
    """Rows that arrive or change below the mark after the first run are found by the digests of their month."""
    work = scratch_path(spark, "late")
    o = _t(spark, sf, "orders")
    # first state of the source: one month is missing every tenth order, another has other prices
    month = F.date_format("o_orderdate", "yyyy-MM")
    first = o.where((F.col("o_orderdate") <= F.lit(LATE_SPLIT).cast("timestamp_ntz")) &
                    ~((month == "1997-03") & (F.col("o_orderkey") % 10 == 0)))
    first = first.withColumn("o_totalprice", F.when(month == "1998-07", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    first.write.parquet(f"{work}/first")

    def run(path):
        t = TableSpec(source="orders", target="orders_t", incremental_column="o_orderdate", reconcile="month",
                      source_options={"path": path})
        return migrate_all(spark, MigrationSpec(tables=[t], source_root=sf, target_root=f"{work}/target",
                                                state_path=f"{work}/control")).first()
    runs = [run(f"{work}/first"), run(f"{sf.rstrip('/')}/orders.parquet"), run(f"{sf.rstrip('/')}/orders.parquet")]
    if [r["status"] for r in runs] != ["ok", "ok", "empty"]:
        raise RuntimeError(f"migration failed: {runs}")
    return read_current(spark, f"{work}/target/orders_t").withColumn("second_run_rows", F.lit(runs[1]["rows"]))


def migrate_transforms(spark, sf):
    """The transform hook: two functions of the caller between rename and load."""
    work = scratch_path(spark, "transforms")
    rich = lambda df: df.where(F.col("balance") > 0)
    band = lambda df: df.withColumn("band", F.floor(F.col("balance") / 1000).cast("bigint"))
    t = TableSpec(source="customer", target="customer_t", columns={"c_custkey": "id", "c_acctbal": "balance"}, only_mapped=True,
                  transforms=(rich, band), source_options={"path": f"{sf.rstrip('/')}/customer.parquet"})
    run = migrate_all(spark, MigrationSpec(tables=[t], source_root=sf, target_root=f"{work}/target",
                                           state_path=f"{work}/control")).first()
    if run["status"] != "ok":
        raise RuntimeError(f"migration failed: {run}")
    return read_current(spark, f"{work}/target/customer_t")


def initial_extract_nan(spark, sf):
    """First load of a table whose mark column holds NaN and NULL."""
    work = scratch_path(spark, "nan_marks")
    k = F.col("p_partkey")
    mark = F.when(k % 4 == 0, F.lit(float("nan"))).when(k % 4 == 1, F.lit(None)).otherwise(F.col("p_retailprice"))
    _t(spark, sf, "part").select("p_partkey", mark.alias("mark")).write.parquet(f"{work}/part")
    t = TableSpec(source="part", target="part_t", incremental_column="mark", source_options={"path": f"{work}/part"})
    runs = migrate_all(spark, MigrationSpec(tables=[t], source_root=sf, target_root=f"{work}/target",
                                            state_path=f"{work}/control")).collect()
    if runs[0]["status"] != "ok":
        raise RuntimeError(f"migration failed: {runs}")
    return read_current(spark, f"{work}/target/part_t")


def migrate_key_only(spark, sf):
    """A table of nothing but its key: the first run inserts, reruns and repeats fail as a whole."""
    work = scratch_path(spark, "key_only")
    keys = _t(spark, sf, "part").select("p_partkey")
    keys.write.parquet(f"{work}/once")
    keys.union(keys).write.parquet(f"{work}/twice")
    out = []
    for run, source in enumerate(("once", "once", "once", "twice"), 1):
        t = TableSpec(source="part", target=f"{source}_t", source_options={"path": f"{work}/{source}"})
        r = migrate_all(spark, MigrationSpec(tables=[t], source_root=sf, target_root=f"{work}/target",
                                             state_path=f"{work}/control")).first()
        target = read_current(spark, f"{work}/target/{source}_t")
        out.append((run, r["status"], r["rows"], r["failed"], 0 if target is None else target.count()))
    return spark.createDataFrame(out, "run int, status string, rows long, failed long, target_rows long")


def _routing(sf: str, work: str, extra: tuple = ()) -> MigrationSpec:
    root = sf.rstrip("/")
    tables = [
        TableSpec(source="nation", target="nation_t", columns={"n_name": "nation_name"},
                  source_options={"path": f"{root}/nation.parquet"}),
        TableSpec(source="region", target="region_t", source_options={"path": f"{root}/region.parquet"}),
        TableSpec(source="orders", target="orders_t", incremental_column="o_orderdate",
                  columns={"o_orderkey": "order_id"}, source_options={"path": f"{root}/orders.parquet"}),
        TableSpec(source="broken", target="broken_t", incremental_column="updated_at",
                  source_options={"path": f"{root}/no_such_table.parquet"}),
        TableSpec(source="unrouted", target=None),
        *extra,
    ]
    return MigrationSpec(tables=tables, source_root=root, target_root=f"{work}/target",
                         state_path=f"{work}/control")


def q_migrate_all(spark, sf):
    work = scratch_path(spark, "migrate_all")
    spec = _routing(sf, work)
    cols = ["table_name", "status", "rows", "affected", "failed", "old_mark", "mark", "advanced"]
    r1 = migrate_all(spark, spec).select(F.lit(1).alias("run"), *cols)
    r2 = migrate_all(spark, spec).select(F.lit(2).alias("run"), *cols)
    return r1.unionByName(r2)


def run_summary(spark, sf):
    work = scratch_path(spark, "run_summary")
    seed = spark.createDataFrame([("orders_late", FUTURE_MARK, "timestamp_ntz")],
                                 "table_name string, hwm_value string, hwm_type string")
    append_control(seed, f"{work}/control", "seed")
    late = TableSpec(source="orders_late", target="orders_late_t", incremental_column="o_orderdate",
                     source_options={"path": f"{sf.rstrip('/')}/orders.parquet"})
    runs = migrate_all(spark, _routing(sf, work, (late,)))
    per = runs.select("table_name", "status", F.col("rows").alias("rows_processed"),
                      F.col("affected").alias("rows_affected"), F.col("failed").alias("rows_failed"))
    total = per.agg(F.lit("TOTAL").alias("table_name"), F.lit(None).cast("string").alias("status"),
                    F.sum("rows_processed").alias("rows_processed"),
                    F.sum("rows_affected").alias("rows_affected"), F.sum("rows_failed").alias("rows_failed"))
    return per.unionByName(total)


def _orders_delta(spark, sf):
    """All orders, then new keys, then changes; the latter two for one order in 97."""
    o = _t(spark, sf, "orders")
    hit = o.where(F.col("o_orderkey") % 97 == 5)
    return o, hit.withColumn("o_orderkey", -1 - F.col("o_orderkey")), hit.withColumn("o_totalprice", F.col("o_totalprice") + 1)


PRUNED_BUCKETS, PRUNED_FILES = 2, 100


def _pruned_loads(spark, sf):
    """The whole table, then new keys only, then changed keys: (target root, what each load did)."""
    root = scratch_path(spark, "pruned")
    loads, batches = [], _orders_delta(spark, sf)
    file_rows = batches[0].count() // PRUNED_FILES + 1
    for batch in batches:
        rest = [c for c in batch.columns if c != "o_orderkey"]
        changes = collapse_versions(batch, ["o_orderkey"], rest, rest).checkpoint(eager=True)
        loads.append(merge_bucketed(changes, root, ["o_orderkey"], PRUNED_BUCKETS, file_rows=file_rows))
    return root, loads


def upsert_pruned(spark, sf):
    """A bucketed target after a load of new keys and one of changed keys that rewrite only the files they have to."""
    checkpoint_root(spark)
    return read_bucketed(spark, _pruned_loads(spark, sf)[0])


def upsert_pruned_stats(spark, sf):
    """Affected rows of the three loads, and whether the load of new keys rewrote no file at all."""
    checkpoint_root(spark)
    out = [(i, load.affected, load.rewritten == 0) for i, load in enumerate(_pruned_loads(spark, sf)[1], 1)]
    return spark.createDataFrame(out, "load int, affected long, nothing_rewritten boolean")


def control_interleaved(spark, sf):
    """Two runs that both start from the same state: each keeps the other's marks, and the larger one of the same table."""
    state = scratch_path(spark, "interleaved")
    schema = "table_name string, hwm_value string, hwm_type string"
    append_control(spark.createDataFrame([("orders", ORDERS_MARK, "timestamp_ntz")], schema), state, "seed")
    start = read_state(spark, state)
    mark = lambda table, col, top: (_t(spark, sf, table).agg(top(col).alias("m"))
                                    .select(F.lit(table).alias("table_name"), F.date_format("m", TS_NTZ_FORMAT).alias("hwm_value"),
                                            F.lit("timestamp_ntz").alias("hwm_type")))
    first = mark("orders", "o_orderdate", F.max).unionByName(mark("events", "ts", F.max))
    second = mark("lineitem", "l_shipdate", F.max).unionByName(mark("orders", "o_orderdate", F.min))
    append_control(first, state, "run-1", base=start)
    append_control(second, state, "run-2", base=start)
    return read_control(spark, state)


# ---------------------------------------------------------------- events

def _messages(spark, sf):
    return messages_from_events(_t(spark, sf, "events"))


def _lookup(spark, sf):
    c = _t(spark, sf, "customer")
    n = _t(spark, sf, "nation")
    return (c.where(F.col("c_custkey") % 3 != 0).join(n, c.c_nationkey == n.n_nationkey)
            .select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("user_id"),
                    F.col("c_name").alias("user_name"), F.col("n_name").alias("user_location")))


def _validated(spark, sf):
    d = decode_messages(_messages(spark, sf))
    return validate_messages(d)


def json_decode_skip(spark, sf):
    d = decode_messages(_messages(spark, sf))
    return d.where(F.col("v").isNotNull()).select(F.col("offset").alias("seq"), "kind")


def q_decode_stats(spark, sf):
    return decode_stats(decode_messages(_messages(spark, sf)))


def schema_validate(spark, sf):
    return _validated(spark, sf).select(F.col("offset").alias("seq"), "reason", "event_id", "user_id")


def q_validation_stats(spark, sf):
    return validation_stats(_validated(spark, sf))


def dedup_first(spark, sf):
    u = dedup_valid(_validated(spark, sf))
    return u.select(F.col("offset").alias("seq"), "event_id", "user_id", "ts_text", "payload", "user_name")


def q_dedup_stats(spark, sf):
    return dedup_stats(_validated(spark, sf))


def _enriched(spark, sf, lookup=None):
    u = dedup_valid(_validated(spark, sf))
    return enrich_left(u, _lookup(spark, sf) if lookup is None else lookup)


def q_enrich_left(spark, sf):
    return _enriched(spark, sf).select(F.col("offset").alias("seq"), "event_id", "user_id",
                                       "user_name", "user_location", "matched")


def q_enrich_stats(spark, sf):
    return enrich_stats(_enriched(spark, sf))


def enrich_lookup_down(spark, sf):
    missing = f"{sf.rstrip('/')}/user_profiles_unreachable.parquet"
    dim, ok = load_lookup(spark, lambda: read_table(spark, missing), "user_id",
                          ["user_name", "user_location"])
    e = _enriched(spark, sf, dim)
    return e.select(F.col("offset").alias("seq"), "event_id", "user_id", "user_name", "user_location",
                    "matched", F.lit(ok).alias("lookup_available"))


def q_bounded_batch(spark, sf):
    d = decode_messages(_messages(spark, sf))
    return bounded_batch(d, MAX_MESSAGES).select(F.col("offset").alias("seq"), "kind")


def bounded_read(spark, sf):
    """The same messages, without decoding what lies behind the last of them."""
    kept = bounded_messages(_messages(spark, sf), MAX_MESSAGES, block=500)
    return decode_messages(kept).where(F.col("v").isNotNull()).select(F.col("offset").alias("seq"), "kind")


def _sink_view(rows: DataFrame) -> DataFrame:
    # the instant as its UTC wall-clock time, whatever the session time zone
    utc = F.to_utc_timestamp(F.col("timestamp"), F.current_timezone())
    return rows.select("event_id", "user_id", _ntz(utc).alias("timestamp"), "payload",
                       "user_name", "user_location", "event_date")


def event_ingest_e2e(spark, sf):
    r = ingest_batch(_messages(spark, sf), _lookup(spark, sf))
    return _sink_view(r.rows)


def daily_partition_append(spark, sf):
    out = scratch_path(spark, "daily_append")
    r = ingest_batch(_messages(spark, sf), _lookup(spark, sf))
    append_daily(r.rows, out)
    back = spark.read.parquet(out)
    return back.groupBy("event_date").agg(F.count(F.lit(1)).alias("rows"))


def event_ingest_clustered(spark, sf):
    """The day-partitioned sink with rows clustered by user inside the day."""
    out = scratch_path(spark, "clustered")
    append_daily(ingest_batch(_messages(spark, sf), _lookup(spark, sf)).rows, out, cluster_by=("user_id",))
    return _sink_view(spark.read.parquet(out).select(*SINK_COLUMNS, "event_date"))


def event_ingest_stream(spark, sf):
    work = scratch_path(spark, "stream")
    _messages(spark, sf).repartition(4).write.mode("overwrite").parquet(f"{work}/source")
    stream = read_message_stream(spark, "parquet", f"{work}/source")
    ingest_stream(stream, _lookup(spark, sf), f"{work}/sink", f"{work}/checkpoint")
    back = spark.read.parquet(f"{work}/sink")
    return _sink_view(back.select(*SINK_COLUMNS, "event_date"))


def event_ingest_stream_bounded(spark, sf):
    """Several micro-batches, each bounded at the source; messages of one event lie in one file."""
    work = scratch_path(spark, "stream_bounded")
    _messages(spark, sf).repartition(8, F.expr("offset div 3")).write.mode("overwrite").parquet(f"{work}/source")
    stream = read_message_stream(spark, "parquet", f"{work}/source", {"maxFilesPerTrigger": "3"})
    ingest_stream(stream, _lookup(spark, sf), f"{work}/sink", f"{work}/checkpoint")
    back = spark.read.parquet(f"{work}/sink")
    return _sink_view(back.select(*SINK_COLUMNS, "event_date"))


def event_ingest_stream_dedup(spark, sf):
    """Copies of an event come in different micro-batches, invalid ones first for some."""
    work = scratch_path(spark, "stream_dedup")
    messages, lookup = _messages(spark, sf), _lookup(spark, sf)
    spec = IngestSpec(cross_batch_delay="3650 days")
    for part in (0, 1):  # partitions 0 and 1, then 2 and 3
        messages.where(F.expr("partition div 2") == part).write.mode("append").parquet(f"{work}/source")
        ingest_stream(read_message_stream(spark, "parquet", f"{work}/source"), lookup, f"{work}/sink",
                      f"{work}/checkpoint", spec)
    back = spark.read.parquet(f"{work}/sink")
    return _sink_view(back.select(*SINK_COLUMNS, "event_date"))


def event_ingest_stream_invalid_first(spark, sf):
    """The first micro-batch holds nothing that can be loaded; the stream goes on after it."""
    work = scratch_path(spark, "stream_invalid")
    messages, lookup = _messages(spark, sf), _lookup(spark, sf)
    for part in (F.col("offset") % 20 <= 5, F.col("offset") % 20 > 5):
        messages.where(part).write.mode("append").parquet(f"{work}/source")
        ingest_stream(read_message_stream(spark, "parquet", f"{work}/source"), lookup, f"{work}/sink",
                      f"{work}/checkpoint")
    back = spark.read.parquet(f"{work}/sink")
    return _sink_view(back.select(*SINK_COLUMNS, "event_date"))


def ingest_no_rows(spark, sf):
    """Batches that load nothing: no message, invalid ones only, bad timestamps only."""
    work, spec = scratch_path(spark, "no_rows"), IngestSpec()
    messages, lookup = _messages(spark, sf), prepare_for_run(spark, lambda: _lookup(spark, sf), spec)
    kind = F.col("offset") % 20
    out = []
    for name, part in (("none", F.lit(False)), ("invalid", kind <= 5), ("bad_timestamp", kind == 6)):
        counts = load_batch(messages.where(part), lookup, f"{work}/{name}", spec)
        out.append((name, *counts.values()))
    return spark.createDataFrame(out, f"batch string, {SUMMARY}")


def _ingest_job(spark, sf):
    work = scratch_path(spark, "ingest_job")
    spec = IngestSpec()
    counts = load_batch(_messages(spark, sf), prepare_for_run(spark, lambda: _lookup(spark, sf), spec), f"{work}/sink",
                        spec, rejects_path=f"{work}/rejects")
    return work, counts


def ingest_summary(spark, sf):
    return spark.createDataFrame([tuple(_ingest_job(spark, sf)[1].values())], SUMMARY)


def ingest_rejects(spark, sf):
    work, _ = _ingest_job(spark, sf)
    return spark.read.parquet(f"{work}/rejects").select(F.col("offset").alias("seq"), "reason")


# ---------------------------------------------------------------- files

def _file_fixture(spark, sf) -> tuple[str, str]:
    """Export nation, region and supplier as CSV files, region and supplier names as text."""
    work = scratch_path(spark, "files")
    csv_dir, txt_dir = f"{work}/csv", f"{work}/txt"
    supplier = _t(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    export_csv(_t(spark, sf, "nation"), csv_dir, "nation.csv", ["n_nationkey"])
    export_csv(_t(spark, sf, "region"), csv_dir, "region.csv", ["r_regionkey"])
    export_csv_split(supplier, csv_dir, "supplier", "s_suppkey", SUPPLIER_ROWS_PER_FILE)
    export_csv(_t(spark, sf, "region"), csv_dir, "ignored.CSV", ["r_regionkey"])
    export_text(_t(spark, sf, "region").select("r_name", "r_regionkey"), txt_dir, "regions.txt",
                ["r_regionkey"])
    export_text(supplier.select("s_name", "s_suppkey"), txt_dir, "suppliers.txt", ["s_suppkey"])
    return csv_dir, txt_dir


def csv_folder_raw(spark, sf):
    csv_dir, _ = _file_fixture(spark, sf)
    return read_csv_folder_raw(spark, csv_dir)


def csv_file_counts(spark, sf):
    """Records per CSV file (header lines included, as the raw reader yields them)."""
    csv_dir, _ = _file_fixture(spark, sf)
    return read_csv_folder_raw(spark, csv_dir).groupBy("file_name").agg(
        F.count(F.lit(1)).alias("records"))


def csv_folder_typed(spark, sf):
    csv_dir, _ = _file_fixture(spark, sf)
    return read_csv_folder_typed(spark, csv_dir)


def csv_raw_quoting(spark, sf):
    """Quoted commas, doubled quotes, line ends inside fields, empty fields, rows of different width."""
    work = scratch_path(spark, "csv_odd")
    k = F.col("n_nationkey").cast("string")
    line = F.concat(k, F.lit(',"'), F.col("n_name"), F.lit(' ""q"", x",,"a\nb"'),
                    F.when(F.col("n_nationkey") % 3 == 0, ",tail").otherwise(""))
    export_text(_t(spark, sf, "nation").select(line.alias("line"), "n_nationkey"), work, "odd.csv", ["n_nationkey"])
    return read_csv_folder_raw(spark, work)


def csv_quoted_texts(spark, sf):
    """Documents as quoted CSV: commas, quotes and line ends inside the fields."""
    work = scratch_path(spark, "csv_texts")
    line = F.concat(F.col("doc_id").cast("string"), F.lit(',"'), F.replace(F.coalesce("text", F.lit("")), F.lit('"'), F.lit('""')),
                    F.lit('"'))
    export_lines(_t(spark, sf, "documents").select(line.alias("value")), work, "texts")
    return read_csv_folder_raw(spark, work, width=2).select("_c0", "_c1")


def csv_typed_lattice(spark, sf):
    """Files whose columns need a wider type together than each alone."""
    work = scratch_path(spark, "csv_lattice")
    o, key = _t(spark, sf, "orders"), F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    small = o.where(key % 2 == 0).select(key.cast("int").alias("id"), day.alias("at"), key.cast("int").alias("n"),
                                         F.lit("true").alias("flag"), F.lit(None).cast("string").alias("e"))
    large = o.where(key % 2 == 1).select(F.concat(day, F.lit(" 10:30:00")).alias("At"), (key + 10_000_000_000).alias("ID"),
                                         (key + F.lit(0.5)).alias("n"), F.when(key % 3 == 0, "false").alias("flag"),
                                         F.lit("x,y").alias("t"))
    for df, stem, number in ((small, "a", "id"), (large, "b", "ID")):
        # without rows there is no part; the header still counts
        export_csv_split(df, work, stem, number, ORDERS_PER_FILE) or export_csv(df, work, f"{stem}.csv")
    back = read_csv_folder_typed(spark, work)
    return back.select("id", F.col("at").cast("timestamp_ntz").alias("at"), "n", "flag", "e", "t",
                       *[F.lit(t).alias(f"{c}_type") for c, t in back.dtypes if c != "file_name"])


def csv_typed_conflict(spark, sf):
    """Two files that disagree on the type of a column."""
    work = scratch_path(spark, "csv_types")
    nation = _t(spark, sf, "nation")
    export_csv(nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("v")), work, "a.csv", ["id"])
    export_csv(nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"),
                             (F.col("n_regionkey") + 0.5).alias("w")), work, "b.csv", ["id"])
    return read_csv_folder_typed(spark, work)


def text_whole(spark, sf):
    _, txt_dir = _file_fixture(spark, sf)
    return read_text_whole(spark, txt_dir, "regions.txt").unionByName(
        read_text_whole(spark, txt_dir, "suppliers.txt")).unionByName(
        read_text_whole(spark, txt_dir, "missing.txt"))


def csv_text_combine(spark, sf):
    csv_dir, txt_dir = _file_fixture(spark, sf)
    out = scratch_path(spark, "combined")
    combine_folder(spark, csv_dir, f"{txt_dir}/suppliers.txt", out)
    back = spark.read.text(out)
    return back.select("out_name", F.col("value").alias("line"))


def csv_text_combine_order(spark, sf):
    csv_dir, txt_dir = _file_fixture(spark, sf)
    return combine_folder(spark, csv_dir, f"{txt_dir}/suppliers.txt")


_ALL: dict[str, Query] = {
    "full_extract": full_extract,
    "incremental_extract": incremental_extract,
    "initial_extract": initial_extract,
    "chunk_stats": q_chunk_stats,
    "table_rename": table_rename,
    "select_mapped": q_select_mapped,
    "hwm_max": hwm_max,
    "hwm_numeric_coerce": hwm_numeric_coerce,
    "hwm_advance": hwm_advance,
    "state_commit_gate": state_commit_gate,
    "nan_to_null": q_nan_to_null,
    "type_coerce": type_coerce,
    "fill_missing": q_fill_missing,
    "upsert_merge": upsert_merge,
    "upsert_last_wins": upsert_last_wins,
    "affected_rows": q_affected_rows,
    "insert_only_conflicts": insert_only_conflicts,
    "incremental_two_runs": incremental_two_runs,
    "incremental_two_runs_bucketed": incremental_two_runs_bucketed,
    "migrate_all": q_migrate_all,
    "run_summary": run_summary,
    "json_decode_skip": json_decode_skip,
    "decode_stats": q_decode_stats,
    "schema_validate": schema_validate,
    "validation_stats": q_validation_stats,
    "dedup_first": dedup_first,
    "dedup_stats": q_dedup_stats,
    "enrich_left": q_enrich_left,
    "enrich_stats": q_enrich_stats,
    "enrich_lookup_down": enrich_lookup_down,
    "bounded_batch": q_bounded_batch,
    "bounded_read": bounded_read,
    "range_balance": range_balance,
    "daily_partition_append": daily_partition_append,
    "event_ingest_e2e": event_ingest_e2e,
    "event_ingest_stream": event_ingest_stream,
    "event_ingest_stream_bounded": event_ingest_stream_bounded,
    "event_ingest_stream_dedup": event_ingest_stream_dedup,
    "event_ingest_stream_invalid_first": event_ingest_stream_invalid_first,
    "ingest_summary": ingest_summary,
    "ingest_no_rows": ingest_no_rows,
    "ingest_rejects": ingest_rejects,
    "late_rows_found": late_rows_found,
    "migrate_transforms": migrate_transforms,
    "event_ingest_clustered": event_ingest_clustered,
    "upsert_pruned": upsert_pruned,
    "upsert_pruned_stats": upsert_pruned_stats,
    "control_interleaved": control_interleaved,
    "initial_extract_nan": initial_extract_nan,
    "migrate_key_only": migrate_key_only,
    "csv_folder_raw": csv_folder_raw,
    "csv_file_counts": csv_file_counts,
    "csv_folder_typed": csv_folder_typed,
    "csv_raw_quoting": csv_raw_quoting,
    "csv_typed_conflict": csv_typed_conflict,
    "csv_quoted_texts": csv_quoted_texts,
    "csv_typed_lattice": csv_typed_lattice,
    "text_whole": text_whole,
    "csv_text_combine": csv_text_combine,
    "csv_text_combine_order": csv_text_combine_order,
}


def _with_defaults(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_defaults(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Query] = {k: _with_defaults(v) for k, v in _ALL.items()}
