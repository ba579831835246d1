"""Named tables, SQL text, plan text and cached re-planning."""

from __future__ import annotations

import contextlib
import io
import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession


def register(**views: DataFrame) -> None:
    """Register each DataFrame as a session temp view under its keyword."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def register_global(**views: DataFrame) -> None:
    """Register each DataFrame for every session of the application, as ``global_temp.<name>``."""
    for name, df in views.items():
        df.createOrReplaceGlobalTempView(name)


def run_sql(spark: SparkSession, text: str, args: Mapping | None = None, **frames: DataFrame) -> DataFrame:
    """Run SQL text; ``:name`` takes its value from ``args`` and ``{name}`` its table from ``frames``."""
    return spark.sql(text, args=dict(args) if args else None, **frames)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan that ``df.explain(mode)`` prints, as a string."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode=mode)
    return text.getvalue()


_STEP = re.compile(r"^\((\d+)\) (.+)$")
_DETAIL = re.compile(r"^([A-Z][A-Za-z ]*?)(?: \[\d+\])?: (.*)$")


def plan_facts(df: DataFrame) -> DataFrame:
    """``step, operator, fact, value`` of the plan that ``df`` has before it runs.

    A row for every detail that the formatted plan tells of a step (PushedFilters, ReadSchema, Arguments,
    Input, ...), and one with null fact and value for the step itself. Scans of a cache are steps named
    InMemoryTableScan, shuffles are steps named Exchange. A plan has a bounded number of steps.
    """
    rows, step = [], None
    for line in plan_text(df).splitlines():
        if found := _STEP.match(line.strip()):
            step = (int(found[1]), found[2].split(" [")[0])
            rows.append((*step, None, None))
        elif step and (found := _DETAIL.match(line.strip())):
            rows.append((*step, found[1], found[2]))
        elif not line.strip():
            step = None
    schema = "step int, operator string, fact string, value string"
    return df.sparkSession.createDataFrame(rows, schema)


def cached_and_rebuilt(
    parent: DataFrame, dependant: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """Cache ``parent`` and build its dependant again, so that the new plan reads the cache.

    A DataFrame planned before the cache call keeps its old plan; hence the builder function.
    """
    cached = parent.cache()
    return cached, dependant(cached)
