"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

The documents of a source, in an order that a hash of their identifiers gives,
form blocks. Time runs in slots of one block. A source of weight w releases its
j-th block (from 0) at slot floor(j / w), and the block is due before slot
ceil((j + 1) / w). In every slot the released block with the earliest deadline
goes out, so that after t slots each source is less than one block away from its
target of w t blocks. When a source has run out of blocks, the weights of the
others are scaled up to 1 and a new phase begins.

The timetable depends on nothing but the weights and the sources' numbers of blocks. It is
worked out for every block of a phase, from one row per source, and never repeated, so
that no rounding adds up: weights that are ratios of small numbers are taken as they are, others as
multiples of at most 1 / 2^50 that keep the error below a thousandth of a block up to 2^25 blocks. It
goes to the executors in runs of ``PERIOD`` blocks of a source, and every block finds its slot from
its number by a join with that table. Ranks within a source come from counts of hash chunks and ranks
within a chunk, so a source with a third of all rows is split over many tasks.

Defined results: a null source counts as the empty name. Rows that share
source and identifier share one place. Sources without a given weight take the
smallest given one; a weight of 0 comes after all others. A null text or
any other column is not looked at. An empty table gives an empty one.
"""

from __future__ import annotations

import heapq
import itertools
import json
import math
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions

BLOCK = 16         # documents of a block
PERIOD = 1024      # blocks of a source in one row of the timetable
FINEST = 1 << 50   # weights are multiples of 1 / FINEST or of a larger step
CHUNKS = 4096      # hash chunks of a source
MAX_SOURCES = 1000  # one row per source goes to the driver; more are refused, not cut off


def quotas(weights: dict[str, float], period: int) -> dict[str, int]:
    """Blocks of each source in a period: in proportion, at least one each, ``period`` in all."""
    period = max(period, len(weights))
    total = sum(weights.values())
    exact = {s: w / total * period for s, w in weights.items()}
    out = {s: max(1, math.floor(x)) for s, x in exact.items()}
    while sum(out.values()) != period:
        missing = sum(out.values()) < period
        s = max((s for s in out if missing or out[s] > 1), key=lambda s: ((exact[s] - out[s]) * (1 if missing else -1), s))
        out[s] += 1 if missing else -1
    return out


def shares(weights: dict[str, float], blocks: int) -> dict[str, int]:
    """Weights as integers in proportion: exact ones where their sum is small enough for 64-bit products with ``blocks``."""
    most = max(len(weights), min(FINEST, (1 << 62) // (blocks + 2)))
    exact = {s: Fraction(str(w)) for s, w in weights.items()}  # the decimal number as written
    unit = math.lcm(*(w.denominator for w in exact.values()))
    whole = {s: int(w * unit) for s, w in exact.items()}
    unit = math.gcd(*whole.values())
    whole = {s: w // unit for s, w in whole.items()}
    return whole if sum(whole.values()) <= most else quotas(weights, most)


def timetable(quota: dict[str, int], left: dict[str, int]) -> dict[str, list[int]]:
    """Earliest-deadline-first slots of each source's blocks until one source has sent all it has left."""
    period = sum(quota.values())
    waiting = [(0, s, 0) for s in sorted(quota)]     # release, source, block
    ready: list[tuple[int, str, int]] = []           # deadline, source, block
    heapq.heapify(waiting)
    slots: dict[str, list[int]] = {s: [] for s in quota}
    for slot in itertools.count():
        while waiting and waiting[0][0] <= slot:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * period // quota[s]), s, j))
        _, s, j = heapq.heappop(ready)
        slots[s].append(slot)
        if j + 1 == left[s]:
            return slots
        heapq.heappush(waiting, ((j + 1) * period // quota[s], s, j + 1))


def phases(blocks: dict[str, int], weights: dict[str, float], period: int = PERIOD) -> list[dict]:
    """Rows (source, first, last, base, share, whole, quota, period, slot0, slots): blocks first..last-1 of a source.

    ``slots`` has the slot of each of these blocks after slot0, the phase's first slot; base is the
    source's first block in the phase, share / whole its weight. A row holds at most
    ``period`` blocks, cut at multiples of it. quota / period is the weight again, with a quota of no fewer blocks.
    """
    left = {s: n for s, n in blocks.items() if n > 0}
    out, slot0 = [], 0
    while left:
        active = {s: weights[s] for s in left if weights[s] > 0} or dict.fromkeys(left, 1.0)
        quota = shares(active, sum(left.values()))
        slots = timetable(quota, left)
        size = sum(quota.values())
        for s in active:
            base, sent = blocks[s] - left[s], len(slots[s])
            first = base
            while first < base + sent:
                last = min(base + sent, (first // period + 1) * period)
                times = -(-(last - first) // quota[s])
                out.append({"source": s, "first": first, "last": last, "base": base, "share": quota[s], "whole": size,
                            "quota": quota[s] * times, "period": size * times, "slot0": slot0,
                            "slots": slots[s][first - base:last - base]})
                first = last
            left[s] -= sent
            if not left[s]:
                del left[s]
        slot0 += sum(map(len, slots.values()))
    return out


def default_weights(rows: dict[str, int]) -> dict[str, float]:
    """Square roots of the sources' sizes: large sources lead, small ones come up more often than by size."""
    return {s: math.sqrt(n) for s, n in rows.items()}


PHASES = "array<struct<source:string,first:long,last:long,base:long,share:long,whole:long,slot0:long,slots:array<long>>>"


def mix_places(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id",
               source_col: str = "source", block: int = BLOCK, period: int = PERIOD) -> DataFrame:
    """Per distinct (source, identifier): source, the identifier, block, release, deadline, slot, position."""
    spark = docs.sparkSession
    own = docs.select(F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
                      F.col(id_col).alias("_id")).distinct()
    own = own.withColumn("_h", F.xxhash64("_id")).withColumn("_chunk", F.pmod(F.shiftright("_h", 40), F.lit(CHUNKS)))
    chunks = own.groupBy("source", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    sizes = chunks.groupBy("source").agg(F.sum("_n").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows = {r["source"]: int(r["n"]) for r in sizes}
    if weights is None:
        weights = default_weights(rows)
    least = min((w for w in weights.values() if w > 0), default=1.0)
    table = phases({s: -(-n // block) for s, n in rows.items()}, {s: weights.get(s, least) for s in rows}, period)
    table = [{k: v for k, v in r.items() if k not in ("quota", "period")} for r in table]
    plan = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(table)), PHASES)).alias("p")).select(
        F.col("p.source").alias("_s"), F.expr(f"p.first div {period}").alias("_r"),
        *(F.col(f"p.{c}").alias(f"_{c}") for c in ("first", "last", "base", "share", "whole", "slot0", "slots")))
    before = Window.partitionBy("source").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.select("source", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("source", "_chunk").orderBy("_h", "_id")
    rank = F.col("_offset") + F.row_number().over(within) - 1
    ranked = own.join(offsets, ["source", "_chunk"]).withColumn("_rank", rank).withColumn(
        "block", F.floor(F.col("_rank") / F.lit(block)).cast("long"))
    placed = ranked.join(plan, (F.col("source") == F.col("_s")) & (F.expr(f"block div {period}") == F.col("_r")) &
                         (F.col("block") >= F.col("_first")) & (F.col("block") < F.col("_last")))
    slot = F.col("_slot0") + F.element_at("_slots", (F.col("block") - F.col("_first") + 1).cast("int"))
    return placed.select(
        "source", F.col("_id").alias(id_col), "block",
        F.expr("_slot0 + (block - _base) * _whole div _share").alias("release"),
        F.expr("_slot0 + ((block - _base + 1) * _whole + _share - 1) div _share").alias("deadline"),
        slot.alias("slot"), (slot * F.lit(block) + F.col("_rank") % F.lit(block)).alias("position"))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id",
                source_col: str = "source", **options) -> DataFrame:
    """All rows of ``docs``, their columns unchanged, in the order of the mix.

    Range partitions of the position, sorted: file by file the rows follow the timetable.
    """
    places = mix_places(docs, weights, id_col, source_col, **options)
    places = places.select(F.col("source").alias("_source"), F.col(id_col).alias("_place_id"), F.col("position").alias("_pos"))
    packed = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"),
                         F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("_own"))
    mixed = packed.join(places, F.col("_id").eqNullSafe(F.col("_place_id")) & (F.col("_own") == F.col("_source")))
    n = shuffle_partitions(docs.sparkSession)
    return mixed.repartitionByRange(n, "_pos").sortWithinPartitions("_pos").select("_row.*")
