"""Atomic table publish by version folder, with optimistic commits.

Each load writes a complete new version ``root/v=<n>.<tag>`` and commits it by
creating ``root/_commits/<n>``, which names the folder. That file is created only if it is not there
(``paths.create_new``), so of two writers that started from the same version one commits and the
other gets ``CommitConflict``: it reads the new version, applies its change again and
tries once more. Readers take the highest committed version: a failed or lost job leaves a folder without a
commit, nothing half-written is ever read, and the version being read is never the one being written.

Tables written before commits were kept (versions with a ``_SUCCESS`` marker only) are taken over by the
first publish.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidewater import paths

DEFAULT_KEEP = 3
COMMITS = "_commits"
# Attempts of a load that meets other writers before it gives up.
MAX_ATTEMPTS = 10


class CommitConflict(RuntimeError):
    """Another writer has committed since the version this change was made from."""


def _number(folder: str) -> int | None:
    digits = folder[2:].split(".")[0]
    return int(digits) if folder.startswith("v=") and digits.isdigit() else None


def _folders(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    found = [(_number(name), name) for name, _, is_dir in paths.list_dir(spark, root) if is_dir]
    return sorted((n, name) for n, name in found if n is not None)


def _commits(spark: SparkSession, root: str) -> list[int] | None:
    """Committed version numbers; None for a table without commit files."""
    names = [name for name, _, _ in paths.list_dir(spark, f"{root.rstrip('/')}/{COMMITS}")]
    return sorted(int(n) for n in names if n.isdigit()) or None


def _commit_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{COMMITS}/{number:08d}"


def _versions(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Committed versions as sorted ``(number, folder name)``."""
    commits = _commits(spark, root)
    if commits is None:
        return [(n, name) for n, name in _folders(spark, root)
                if paths.exists(spark, f"{root.rstrip('/')}/{name}/_SUCCESS")]
    return [(n, paths.read_text(spark, _commit_path(root, n))) for n in commits]


def current_version(spark: SparkSession, root: str) -> str | None:
    commits = _commits(spark, root)
    if commits is not None:
        return f"{root.rstrip('/')}/{paths.read_text(spark, _commit_path(root, commits[-1]))}"
    v = _versions(spark, root)
    return f"{root.rstrip('/')}/{v[-1][1]}" if v else None


def version_paths(spark: SparkSession, root: str) -> list[str]:
    """Folders of all committed versions, oldest first."""
    return [f"{root.rstrip('/')}/{name}" for _, name in _versions(spark, root)]


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    path = current_version(spark, root)
    return spark.read.parquet(path) if path else None


def _base_number(base: str | None) -> int:
    return 0 if base is None else _number(base.rstrip("/").rsplit("/", 1)[1])


def stage(df: DataFrame, root: str, base: str | None, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as the version after ``base`` without committing it; returns its folder."""
    spark, root = df.sparkSession, root.rstrip("/")
    if _commits(spark, root) is None:
        for n, name in _versions(spark, root):  # a table without commit files: take its versions over
            paths.create_new(spark, _commit_path(root, n), name)
    path = f"{root}/v={_base_number(base) + 1:08d}.{uuid.uuid4().hex[:8]}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    # not a version yet, even for a reader that knows no commits: its marker comes with the commit
    w.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return path


def commit(spark: SparkSession, path: str, keep: int = DEFAULT_KEEP) -> str:
    """Make a staged version current, or raise ``CommitConflict`` and remove it."""
    root, name = path.rsplit("/", 1)
    number = _number(name)
    last = _commits(spark, root)
    # an expired number is free again, so a commit below the last one is a conflict, too
    if (last and last[-1] >= number) or not paths.create_new(spark, _commit_path(root, number), name):
        paths.remove(spark, path)
        raise CommitConflict(f"version {number} of {root} is taken")
    expire(spark, root, keep)
    return path


def publish(df: DataFrame, root: str, partition_by: list[str] | None = None, keep: int = DEFAULT_KEEP, *,
            base: str | None | bool = False) -> str:
    """Write ``df`` as the next version of the table at ``root``; returns its path.

    ``base`` is the version ``df`` was made from (None: there was no table): with it, a version that
    was committed meanwhile raises ``CommitConflict``. Without it ``df`` replaces whatever is there.
    After the commit, versions older than the newest ``keep`` are removed, so storage holds a bounded
    number of copies while readers that started on the previous version can still finish.
    """
    spark = df.sparkSession
    if base is not False:
        return commit(spark, stage(df, root, base, partition_by), keep)
    for left in reversed(range(MAX_ATTEMPTS)):
        try:
            return commit(spark, stage(df, root, current_version(spark, root), partition_by), keep)
        except CommitConflict:
            if not left:
                raise


def expire(spark: SparkSession, root: str, keep: int = DEFAULT_KEEP) -> list[str]:
    """Remove committed versions older than the newest ``keep``; returns their names."""
    if keep < 1:
        raise ValueError("keep at least the current version")
    old = _versions(spark, root)[:-keep]
    for number, name in old:
        paths.remove(spark, _commit_path(root, number))
        paths.remove(spark, f"{root.rstrip('/')}/{name}")
    return [name for _, name in old]
