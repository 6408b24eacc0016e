"""Stages that read named tables and replace named tables.

A table that a stage writes is a view over a version table of its own. A new version is written whole beside the
old one and the view is replaced by one catalog change, so a reader finds the old rows or the new ones at every
moment. The version before the last stays for readers that are still at it, and goes with the next replacement.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Frames = DataFrame | list[DataFrame]

#: Names of version tables, and the view properties that hold the names of the current and the previous one.
VERSION = re.compile(r"__v[0-9a-f]{12}$")
CURRENT, PREVIOUS = "grainmill.version", "grainmill.previous"


def table_stage(inputs: str | Sequence[str], outputs: str | Sequence[str] | None = None):
    """Turn `func(frames, **kw)` into `stage(spark, **kw)` over catalog tables.

    One input name gives one frame, a sequence gives a list. The function returns a dict whose
    "tables" maps table names to frames; everything else in it is passed on as the stage's result.
    `outputs` that the function does not write are dropped after it ran.

    A result may read a table that it or `outputs` replaces. If a frame can't be written, or a table can't be
    replaced, all tables stay as they were.
    """
    if inputs is None:
        raise ValueError("inputs cannot be None")
    drops = [outputs] if isinstance(outputs, str) else list(outputs or [])

    def decorate(func: Callable[..., dict]):
        @wraps(func)
        def stage(spark: SparkSession, **kwargs) -> dict:
            frames: Frames = spark.table(inputs) if isinstance(inputs, str) else [spark.table(t) for t in inputs]
            result = dict(func(frames, **kwargs) or {})
            replace_tables(spark, result.pop("tables", {}), drops)
            return result

        return stage

    return decorate


def replace_tables(spark: SparkSession, frames: dict[str, DataFrame], drops: Sequence[str] = ()) -> None:
    """Write every frame as the new version of its table, then change the tables over; `drops` go if not written.

    A plain table of a name becomes the previous version of its view. While it is renamed, this session is served
    by a temporary view; a reader of another session may miss it for that one moment, and never again.
    """
    staged: dict[str, str] = {}
    try:
        for name, df in frames.items():
            staged[name] = _version(name)
            df.write.saveAsTable(staged[name])
    except BaseException:
        _drop(spark, staged.values())
        raise
    undo: list[Callable[[], None]] = []
    stale: list[str] = []
    covers: list[str] = []
    try:
        for name, new in staged.items():
            _change(spark, name, new, undo, stale, covers)
    except BaseException:
        for step in reversed(undo):
            step()
        _uncover(spark, covers)
        _drop(spark, staged.values())
        raise
    _uncover(spark, covers)
    for name in drops:
        if name not in staged:
            stale += versions(spark, name)
            _run(spark, f"DROP {'VIEW' if _is_view(spark, name) else 'TABLE'} IF EXISTS {_whole(spark, name)}")
    _drop(spark, stale)


def _change(spark: SparkSession, name: str, new: str, undo: list, stale: list[str], covers: list[str]) -> None:
    """The view of a name on its new version; how to take that back goes to `undo`, versions to be dropped to `stale`."""
    whole = _whole(spark, name)
    if _is_view(spark, name):
        current, *older = versions(spark, name) or [None]
        if current is None:
            raise ValueError(f"{name} is a view that no stage wrote")
        before = older[0] if older else None
        _view(spark, whole, new, current)
        undo.append(lambda: _view(spark, whole, current, before))
        stale += older
        return
    old = None
    if spark.catalog.tableExists(whole):
        old = _version(name)
        if "." not in name:
            spark.table(_whole(spark, new)).createOrReplaceTempView(name)
            covers.append(name)
        _run(spark, f"ALTER TABLE {whole} RENAME TO {_whole(spark, old)}")
        undo.append(lambda: _run(spark, f"ALTER TABLE {_whole(spark, old)} RENAME TO {whole}"))
    _view(spark, whole, new, old)
    undo.append(lambda: _run(spark, f"DROP VIEW {whole}"))


def _uncover(spark: SparkSession, covers: Iterable[str]) -> None:
    for name in covers:
        spark.catalog.dropTempView(name)


def _view(spark: SparkSession, whole: str, version: str, previous: str | None) -> None:
    held = f"'{CURRENT}' = '{version}'" + (f", '{PREVIOUS}' = '{previous}'" if previous else "")
    _run(spark, f"CREATE OR REPLACE VIEW {whole} TBLPROPERTIES ({held}) AS SELECT * FROM {_whole(spark, version)}")


def _version(name: str) -> str:
    return f"{name}__v{uuid.uuid4().hex[:12]}"


def _whole(spark: SparkSession, name: str) -> str:
    """The name with its database, which no temporary view can stand in front of."""
    return name if "." in name else f"{spark.catalog.currentDatabase()}.{name}"


def _is_view(spark: SparkSession, name: str) -> bool:
    whole = _whole(spark, name)
    return spark.catalog.tableExists(whole) and spark.catalog.getTable(whole).tableType == "VIEW"


def versions(spark: SparkSession, name: str) -> list[str]:
    """The current and the previous version of a stage's table, as far as there are."""
    if not _is_view(spark, name):
        return []
    held = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_whole(spark, name)}").collect()}
    return [held[k] for k in (CURRENT, PREVIOUS) if k in held]


def _drop(spark: SparkSession, names: Iterable[str]) -> None:
    for name in names:
        _run(spark, f"DROP TABLE IF EXISTS {_whole(spark, name)}")


def _run(spark: SparkSession, statement: str) -> None:
    spark.sql(statement)


def run_stages(spark: SparkSession, stages: Sequence[Callable[..., dict]], **kwargs) -> list[dict]:
    """Run stages in order; each hands over through the tables it writes."""
    return [stage(spark, **kwargs) for stage in stages]
