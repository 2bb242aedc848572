"""Job descriptions, given by the caller as plain immutable values.

``MigrationSpec.from_settings`` accepts the flat ``key -> value`` layout
of a ``[migration]`` settings section (``src = dst`` table routes,
``src.col = dst.col`` column routes, ``src.incremental_column = COL``,
plus ``chunk_size`` / ``state_file_path``) so existing settings can be
reused; the parsing of settings files itself is left to the caller.
"""

from __future__ import annotations

import configparser
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# Option names of the settings section that are not tables,
# and the reserved per-table suffix naming the incremental column.
NON_TABLE_OPTIONS = ("chunk_size", "state_file_path")
INCREMENTAL_SUFFIX = "incremental_column"
DEFAULT_CHUNK_SIZE = 10000


def settings_from_ini(path: str, section: str = "migration") -> dict[str, str]:
    """The options of one section of an INI settings file (keys lower-cased).

    A missing file raises ``FileNotFoundError``; a missing section gives {}.
    """
    parser = configparser.ConfigParser()
    if not parser.read(path):
        raise FileNotFoundError(path)
    return dict(parser.items(section)) if parser.has_section(section) else {}


@dataclass(frozen=True)
class TableSpec:
    source: str                                   # source table name
    target: str | None                            # target table name; None -> skipped
    columns: Mapping[str, str] = field(default_factory=dict)   # source col -> target col
    incremental_column: str | None = None
    keys: Sequence[str] | None = None             # target key columns; default: first column
    only_mapped: bool = False                     # keep only renamed columns
    chunk_size: int | None = DEFAULT_CHUNK_SIZE   # rows per read range; None -> one range
    transforms: Sequence[Callable[[DataFrame], DataFrame]] = ()
    source_format: str = "parquet"
    source_options: Mapping[str, str] = field(default_factory=dict)
    buckets: int | None = None                    # target in key buckets with key statistics per file; None -> versioned
    add_columns: bool = False                     # source columns that the target lacks extend it; False -> the load fails
    lookback: str | int | float | None = None     # re-read window below the mark for late rows
    reconcile: str | int | float | None = None    # find late rows by digests of mark ranges: a calendar unit or a width
    chunk_column: str | None = None               # numeric column of the read ranges; default: first key
    sink: str = "files"                           # "files" (versioned / bucketed) or "jdbc"
    sink_options: Mapping[str, str] = field(default_factory=dict)  # jdbc: url, dialect, user, password, ...
    freeze: bool | None = None                    # checkpoint the batch; None -> only mutable sources


@dataclass(frozen=True)
class MigrationSpec:
    tables: Sequence[TableSpec]
    source_root: str                              # folder (or JDBC url) holding sources
    target_root: str                              # folder holding published target tables
    state_path: str                               # control table location

    @staticmethod
    def from_settings(settings: Mapping[str, str], *, source_root: str, target_root: str,
                      state_path: str | None = None, source_format: str = "parquet",
                      source_options: Mapping[str, str] | None = None) -> MigrationSpec:
        """Build a spec from a flat ``[migration]`` section.

        Names are matched case-insensitively, as Spark resolves columns.
        """
        items = {str(k).strip().lower(): str(v).strip() for k, v in settings.items()}
        chunk = items.get("chunk_size")
        # an absent chunk_size means no chunking: one read range
        chunk_size = int(chunk) if chunk not in (None, "") and int(chunk) > 0 else None
        tables = []
        for key, target in items.items():
            if "." in key or key in NON_TABLE_OPTIONS:
                continue
            prefix = key + "."
            columns, inc = {}, None
            for k2, v2 in items.items():
                if not k2.startswith(prefix):
                    continue
                col = k2[len(prefix):]
                if col == INCREMENTAL_SUFFIX:
                    inc = v2
                else:
                    columns[col] = v2.split(".")[-1]
            tables.append(TableSpec(source=key, target=target or None, columns=columns,
                                    incremental_column=inc, chunk_size=chunk_size,
                                    source_format=source_format,
                                    source_options=dict(source_options or {})))
        return MigrationSpec(tables=tuple(tables), source_root=source_root,
                             target_root=target_root,
                             state_path=state_path or items.get("state_file_path")
                             or f"{target_root.rstrip('/')}/_control")


@dataclass(frozen=True)
class IngestSpec:
    lookup_key: str = "user_id"
    lookup_columns: Sequence[str] = ("user_name", "user_location")
    dedup_key: str = "event_id"
    max_messages: int | None = None               # batch job only; None -> whole batch
    max_broadcast_rows: int = 5_000_000           # lookup broadcast only below this
    strict_load: bool = False                     # True -> unparsable timestamp fails the batch
    cross_batch_delay: str | None = None          # stream only: also drop keys loaded by earlier
                                                  # micro-batches within this span of message time
