"""Upsert into a relational target through JDBC.

The change set is collapsed to one row per key, written in parallel to a
staging table by Spark's JDBC writer (``batchsize`` rows per round trip,
one connection per task), and applied with a single server-side
statement in one transaction: MySQL ``INSERT ... SELECT ... ON DUPLICATE
KEY UPDATE`` (its affected-row count is 1 per insert, 2 per changed row,
0 per unchanged row) or an ANSI ``MERGE``. A key-only table gets a plain
``INSERT ... SELECT``, so an existing key fails the statement and nothing
is applied. Credentials travel in ``properties`` and are never logged.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tidewater.operators.dedup import keep_last

log = logging.getLogger(__name__)

# Identifier quoting per dialect.
QUOTES = {"mysql": ("`", "`"), "ansi": ('"', '"')}


def _q(name: str, dialect: str) -> str:
    left, right = QUOTES[dialect]
    return f"{left}{name}{right}"


def merge_statement(target: str, staging: str, columns: Sequence[str], keys: Sequence[str],
                    dialect: str = "mysql") -> str:
    """The statement applying ``staging`` to ``target``."""
    cols = ", ".join(_q(c, dialect) for c in columns)
    rest = [c for c in columns if c not in keys]
    t, s = _q(target, dialect), _q(staging, dialect)
    if dialect == "mysql":
        sql = f"INSERT INTO {t} ({cols}) SELECT {cols} FROM {s}"
        if rest:
            sets = ", ".join(f"{_q(c, dialect)} = VALUES({_q(c, dialect)})" for c in rest)
            sql += f" ON DUPLICATE KEY UPDATE {sets}"
        return sql
    if dialect != "ansi":
        raise ValueError(f"unknown dialect {dialect!r}")
    if not rest:
        return f"INSERT INTO {t} ({cols}) SELECT {cols} FROM {s}"
    on = " AND ".join(f"t.{_q(k, dialect)} = s.{_q(k, dialect)}" for k in keys)
    sets = ", ".join(f"{_q(c, dialect)} = s.{_q(c, dialect)}" for c in rest)
    vals = ", ".join(f"s.{_q(c, dialect)}" for c in columns)
    return (f"MERGE INTO {t} t USING {s} s ON ({on}) WHEN MATCHED THEN UPDATE SET {sets} "
            f"WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({vals})")


def execute(df_or_spark, url: str, statements: Sequence[str],
            properties: Mapping[str, str] | None = None) -> list[int]:
    """Run statements in one transaction on the driver; returns update counts."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, str(v))
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        conn.setAutoCommit(False)
        counts = []
        for sql in statements:
            st = conn.createStatement()
            try:
                counts.append(int(st.executeUpdate(sql)))
            finally:
                st.close()
        conn.commit()
        return counts
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()


def _write_staging(rows: DataFrame, url: str, staging: str, properties: Mapping[str, str]) -> None:
    rows.write.mode("overwrite").jdbc(url, staging, properties=dict(properties))


def upsert_jdbc(source: DataFrame, url: str, target: str, keys: Sequence[str] | None = None, *,
                order_by: Sequence[str] | None = None, staging: str | None = None,
                dialect: str = "mysql", properties: Mapping[str, str] | None = None,
                batchsize: int = 10000) -> int:
    """Apply ``source`` to the JDBC table ``target``; returns the server's affected-row count.

    A batch without rows touches nothing; a NULL key fails before anything is written. The
    staging table has a name of its own for every call and goes whether the merge works or not.
    """
    keys = list(keys or source.columns[:1])
    key_only = set(keys) >= set(source.columns)
    checks = source.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(_col(k).isNull()).alias(f"null_{i}")
                                                            for i, k in enumerate(keys)]).first()
    if not checks["rows"]:
        return 0
    nulls = sum(checks[f"null_{i}"] for i in range(len(keys)))
    if nulls:
        raise ValueError(f"{nulls} NULL key values for {target}")
    # rows of nothing but keys go as they are: a repeated key must fail the insert
    rows = source if key_only else keep_last(source, keys, order_by or [c for c in source.columns if c not in keys])
    staging = staging or f"{target}_stg_{uuid.uuid4().hex[:12]}"
    drop = f"DROP TABLE {_q(staging, dialect)}"
    try:
        _write_staging(rows, url, staging, {**(properties or {}), "batchsize": str(batchsize)})
        count = execute(source, url, [merge_statement(target, staging, rows.columns, keys, dialect)], properties)[0]
    except Exception:
        try:
            execute(source, url, [drop], properties)
        except Exception as e:  # noqa: BLE001 - the first error is the one to report
            log.warning("staging table %s is left behind: %s", staging, type(e).__name__)
        raise
    execute(source, url, [drop], properties)
    return count


def _col(name: str):
    return F.col(f"`{name}`")
