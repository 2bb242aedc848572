"""Set-based upsert, insert-only load and exact affected-row accounting.

``upsert`` inserts new keys and overwrites every non-key source column of
existing keys (NULL overwrites too); target columns absent from the source
are left as they are. Two physical plans:

* small change set (rows and bytes measured and under their limits):
  the change set is broadcast, the target is streamed once in full and
  once for its key columns only, and is never shuffled;
* otherwise one full outer sort-merge join on the key.

``collapse_versions`` and ``merge_counted`` do the upsert and its accounting in one plan: the batch and the
target are each read and shuffled once, one full outer join gives the merged rows and what became of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.functions.order import sort_key
from tidewater.functions.size import fits_broadcast
from tidewater.operators.dedup import keep_last
from tidewater.session import checkpoint_root

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000

# Rows affected by INSERT ... ON DUPLICATE KEY UPDATE.
AFFECTED_INSERT, AFFECTED_UPDATE, AFFECTED_SAME = 1, 2, 0


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _check(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> list[str]:
    missing = [c for c in source.columns if c not in target.columns]
    if missing:
        raise ValueError(f"source columns not in target: {missing}")
    for k in keys:
        if k not in source.columns:
            raise ValueError(f"key {k!r} not in source")
    return [c for c in source.columns if c not in keys]


def upsert(target: DataFrame | None, source: DataFrame, keys: Sequence[str] | None = None, *,
           order_by: Sequence[str] | None = None, strategy: str = "auto",
           max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, unique_keys: bool = False) -> DataFrame:
    """The target table after applying ``source``.

    ``keys`` default to the first source column. Source rows sharing a key are
    first collapsed to the last one in ``order_by`` (last write wins), without it
    in the order of the non-key columns, so no key is ever applied twice;
    ``unique_keys`` (known to the caller) saves that step.
    """
    keys = list(keys or source.columns[:1])
    if not unique_keys:
        order_by = order_by or [c for c in source.columns if c not in keys]
        source = keep_last(source, keys, order_by) if order_by else source.dropDuplicates(keys)
    if target is None:  # first load
        return source
    upd = _check(target, source, keys)
    tcols = target.columns
    if strategy == "auto":
        strategy = "broadcast" if fits_broadcast(source, max_broadcast_rows) else "shuffle"
    s = source.select(*[_q(k) for k in keys], *[_q(c).alias(f"_s_{c}") for c in upd],
                      F.lit(True).alias("_s"))

    def merged(j: DataFrame) -> DataFrame:
        out = []
        for c in tcols:
            if c in keys:
                out.append(_q(c))
            elif c in upd:
                out.append(F.when(F.col("_s"), F.col(f"`_s_{c}`")).otherwise(_q(c)).alias(c))
            else:
                out.append(_q(c))
        return j.select(*out)

    if strategy == "shuffle":
        return merged(target.join(s, keys, "full_outer"))
    if strategy != "broadcast":
        raise ValueError(f"unknown strategy {strategy!r}")
    kept = merged(target.join(F.broadcast(s), keys, "left"))
    matched = target.select(*keys).join(F.broadcast(s.select(*keys)), keys, "inner")
    new = s.join(F.broadcast(matched), keys, "left_anti")
    new_rows = new.select(*[(_q(c) if c in keys else
                             F.col(f"`_s_{c}`") if c in upd else
                             F.lit(None).cast(target.schema[c].dataType)).alias(c) for c in tcols])
    return kept.unionByName(new_rows)


# Columns that ``merge_counted`` adds to the merged rows, for ``LOAD_METRICS``.
AFFECTED, NULL_ROWS = "_affected", "_null_rows"


def collapse_versions(source: DataFrame, keys: Sequence[str], order_by: Sequence[str], compared: Sequence[str], *,
                      skew_safe: bool = False, partitions: int | None = None) -> DataFrame:
    """One row per key of a batch: what an ordered upsert needs to know of the key's versions.

    The columns of the last version, ``_n`` (versions), ``_first`` (the first version's
    ``compared`` columns) and ``_steps`` (how often a version differs from the one before it). Versions meet by
    key in one shuffle, which the join of ``merge_counted`` then uses as it is. With ``skew_safe`` they are
    range-partitioned on (key, order) and frozen first: a key with very many versions lies in several
    ranges, each range comes down to one row per key, and the ranges of a key are put together in order.
    """
    cur = F.struct(*[sort_key(source, c).alias(c) for c in compared])
    order = [sort_key(source, c) for c in order_by]
    rank = F.struct(*order)
    row = F.struct(*[_q(c) for c in source.columns])
    by_key = [_q(k) for k in keys]
    parts = [] if not skew_safe else [F.col("_p")]
    rows = source
    if skew_safe:
        spark = source.sparkSession
        n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        checkpoint_root(spark)
        rows = source.repartitionByRange(n, *by_key, *order).withColumn("_p", F.spark_partition_id()).checkpoint(eager=True)
    before = F.lag(cur).over(Window.partitionBy(*parts, *by_key).orderBy(*order))
    stepped = rows.withColumn("_step", before.isNotNull() & ~cur.eqNullSafe(before))
    local = stepped.groupBy(*parts, *by_key).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("_step").alias("_steps"), F.min_by(cur, rank).alias("_first"),
        F.max_by(F.struct(row.alias("row"), cur.alias("cur")), rank).alias("_last"))
    if skew_safe:
        # at most one part per range and key
        local = (local.groupBy(*by_key)
                 .agg(F.collect_list(F.struct("_p", "_n", "_steps", "_first", "_last")).alias("_parts"))
                 .withColumn("_parts", F.expr("array_sort(_parts, (a, b) -> a._p - b._p)"))
                 .select(*by_key, F.expr("aggregate(_parts, 0L, (x, p) -> x + p._n)").alias("_n"),
                         F.expr("""aggregate(_parts, 0L, (x, p) -> x + p._steps) + size(filter(_parts, (p, i) ->
                                   i > 0 and not (p._first <=> _parts[greatest(i - 1, 0)]._last.cur)))""").alias("_steps"),
                         F.expr("_parts[0]._first").alias("_first"), F.expr("_parts[size(_parts) - 1]._last").alias("_last")))
    return local.select(*[F.col(f"_last.row.`{c}`").alias(c) if c not in keys else _q(c) for c in source.columns],
                        "_n", "_steps", "_first")


def merge_counted(target: DataFrame | None, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after ``changes`` (of ``collapse_versions``), with the accounting, from one join.

    Adds ``_affected`` (of a key's versions one after the other: 1 per insert, 2 per change, 0 for the same again; null for
    rows that the batch does not name) and ``_null_rows`` (source rows without a key), to be counted by
    ``LOAD_METRICS`` while the rows are written.
    """
    source = [c for c in changes.columns if c not in ("_n", "_steps", "_first")]
    null_key = reduce(lambda a, b: a | b, [_q(k).isNull() for k in keys])
    if target is None:
        return changes.select(*[_q(c) for c in source], (1 + 2 * F.col("_steps")).alias(AFFECTED),
                              F.when(null_key, F.col("_n")).alias(NULL_ROWS))
    upd = _check(target, changes.select(*[_q(c) for c in source]), keys)
    s = changes.select(*[_q(k) for k in keys], *[_q(c).alias(f"_s_{c}") for c in upd], "_n", "_steps", "_first",
                       F.lit(True).alias("_s"))
    j = target.withColumn("_t", F.lit(True)).join(s, list(keys), "full_outer")
    same = reduce(lambda a, b: a & b, [F.col(f"_first.`{c}`").eqNullSafe(sort_key(target, c)) for c in upd], F.lit(True))
    first = F.when(F.col("_t").isNull(), AFFECTED_INSERT).when(same, AFFECTED_SAME).otherwise(AFFECTED_UPDATE)
    merged = [F.when(F.col("_s"), F.col(f"`_s_{c}`")).otherwise(_q(c)).alias(c) if c in upd else _q(c) for c in target.columns]
    return j.select(*merged, F.when(F.col("_s"), first + 2 * F.col("_steps")).alias(AFFECTED),
                    F.when(F.col("_s") & null_key, F.col("_n")).alias(NULL_ROWS))


def load_metrics() -> list[Column]:
    """``affected`` and ``null_keys`` of rows from ``merge_counted``, for ``observe``."""
    zero = F.lit(0).cast("long")
    return [F.coalesce(F.sum(AFFECTED), zero).alias("affected"), F.coalesce(F.sum(NULL_ROWS), zero).alias("null_keys")]


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str] | None = None):
    """Plain INSERT of a key-only batch: ``(new_rows, conflicts)``.

    A key already in the target, or repeated within the batch, is a
    conflict; a batch with any conflict fails as a whole.
    """
    keys = list(keys or source.columns[:1])
    tk = target.select(*keys)
    dup_keys = source.groupBy(*keys).count().where(F.col("count") > 1).select(*keys)
    existing = source.join(tk, keys, "left_semi")
    conflicts = existing.select(*keys).unionByName(dup_keys).distinct()
    new_rows = source.join(tk, keys, "left_anti")
    return new_rows, conflicts


def insert_only_stats(target: DataFrame, source: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row: ``source_rows, new_keys, conflict_keys, failed_rows, inserted_rows``.

    Counted in one grouped pass (rows per key, and whether the key exists):
    ``new_keys`` counts source rows whose key is not in the target; a key in
    the target or repeated in the batch is a conflict, and any conflict
    fails the whole batch (every row failed, none inserted).
    """
    keys = list(keys or source.columns[:1])
    tk = target.select(*keys).distinct().withColumn("_in_t", F.lit(True))
    per_key = (source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
               .join(tk, keys, "left"))
    conflict = F.col("_in_t").isNotNull() | (F.col("_n") > 1)
    counts = per_key.agg(
        F.sum("_n").cast("bigint").alias("source_rows"),
        F.coalesce(F.sum(F.when(F.col("_in_t").isNull(), F.col("_n"))), F.lit(0)).cast("bigint")
        .alias("new_keys"),
        F.count_if(conflict).alias("conflict_keys"))
    failed = F.col("conflict_keys") > 0
    return counts.select(
        F.coalesce("source_rows", F.lit(0).cast("bigint")).alias("source_rows"), "new_keys",
        "conflict_keys",
        F.when(failed, F.col("source_rows")).otherwise(F.lit(0).cast("bigint")).alias("failed_rows"),
        F.when(failed, F.lit(0).cast("bigint")).otherwise(F.col("new_keys")).alias("inserted_rows"))


DEFAULT_SEQUENTIAL_ROWS = 1_000_000


def affected_rows(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
                  order_by: Sequence[str], partitions: int | None = None,
                  skew_safe: bool = True, unique_keys: bool = False,
                  small_batch: bool = False) -> DataFrame:
    """Classify each source row applied in ``order_by`` order within its key.

    Adds ``change`` (insert / update / same) and ``affected`` (1 / 2 / 0):
    a row is compared with the previous version of its key: the previous
    source row, or the target row for the first one. Order columns absent
    from the target only order the versions and are not compared; with no
    target yet (first load) every non-key column is row data and compared.

    The target rows of the batch's keys join the source rows as each key's
    version zero, so one ``lag`` over the versions gives every comparison.
    With ``skew_safe`` (the default) the versions are range-partitioned on
    (key, version order) and frozen once in the shared checkpoint folder; a
    key with many versions is then spread over several ranges. ``lag`` runs
    inside each (range, key) group, and the first row of a group takes its
    previous version from the last row of the preceding range (a table with
    one row per range, broadcast) when that row has the same key. Without
    ``skew_safe`` (for batches of a checked, small size) one window
    partitioned by key is used. With ``unique_keys`` (checked by the caller:
    each key at most once in the batch) the previous version is the target
    row, and one join on the key replaces the ordering. ``small_batch``
    (size checked by the caller) broadcasts the batch's keys into the target
    scan, so the target is never shuffled.
    """
    if target is None:  # first load: every non-key column is row data, compare them all
        upd = [c for c in source.columns if c not in keys]
    else:
        upd = _check(target, source.drop(*[c for c in order_by if c not in target.columns]), keys)
    cur = F.struct(*[sort_key(source, c).alias(c) for c in upd])
    kstruct = F.struct(*[_q(k) for k in keys])
    if unique_keys:
        j = source
        if target is None:
            j = j.withColumn("_before", F.lit(None).cast(source.select(cur.alias("c")).schema["c"].dataType))
        else:
            batch_keys = source.select(*keys)
            tgt = target.join(F.broadcast(batch_keys) if small_batch else batch_keys, keys, "left_semi")
            # at most one target row per batch key; AQE may broadcast it at run time
            prev = tgt.select(*keys, F.struct(*[sort_key(target, c).alias(c) for c in upd]).alias("_before"))
            j = j.join(prev, keys, "left")
        return _classify(j, source.columns, cur)
    versions = source.select(*[_q(c) for c in source.columns], F.lit(1).alias("_rank"))
    if target is not None:
        in_batch = source.select(*keys).distinct()
        zero = target.join(F.broadcast(in_batch) if small_batch else in_batch, keys, "left_semi").select(
            *[_q(c) if c in keys or c in upd else F.lit(None).cast(source.schema[c].dataType).alias(c)
              for c in source.columns], F.lit(0).alias("_rank"))
        versions = zero.unionByName(versions)
    sequence = [F.col("_rank"), *[sort_key(source, c) for c in order_by]]
    if skew_safe:
        spark = source.sparkSession
        n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                              spark.sparkContext.defaultParallelism)
        checkpoint_root(spark)
        ranged = (versions.repartitionByRange(n, *[_q(k) for k in keys], *sequence)
                  .withColumn("_p", F.spark_partition_id()).checkpoint(eager=True))
        w = Window.partitionBy("_p", *[_q(k) for k in keys]).orderBy(*sequence)
        local = ranged.select("*", F.lag(cur).over(w).alias("_prev"),
                              F.lag(F.lit(1)).over(w).isNull().alias("_first"))
        # last row of every non-empty range; each range gets the one before it
        # (the table has one row per range)
        last = ranged.groupBy("_p").agg(F.max_by(F.struct(kstruct.alias("k"), cur.alias("v")),
                                                 F.struct(kstruct, *sequence)).alias("_last"))
        carry = last.select("_p", F.lag("_last").over(Window.orderBy("_p")).alias("_carry"))
        j = local.join(F.broadcast(carry), "_p", "left")
        before = F.when(~F.col("_first"), F.col("_prev")) \
            .otherwise(F.when(F.col("_carry.k") == kstruct, F.col("_carry.v")))
    else:
        w = Window.partitionBy(*[_q(k) for k in keys]).orderBy(*sequence)
        j = versions
        before = F.lag(cur).over(w)
    j = j.select(*source.columns, "_rank", before.alias("_before")).where(F.col("_rank") == 1)
    return _classify(j, source.columns, cur)


def _classify(j: DataFrame, columns: Sequence[str], cur: Column) -> DataFrame:
    """Source columns plus change / affected from ``_before`` (the previous version)."""
    change = (F.when(F.col("_before").isNull(), F.lit("insert"))
              .when(~cur.eqNullSafe(F.col("_before")), F.lit("update"))
              .otherwise(F.lit("same")))
    affected = (F.when(change == "insert", AFFECTED_INSERT)
                .when(change == "update", AFFECTED_UPDATE).otherwise(AFFECTED_SAME))
    return j.select(*[_q(c) for c in columns], change.alias("change"), affected.alias("affected"))
