"""What a plan does: node names, and rows that came out of its scans."""

from __future__ import annotations

import re
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


@contextmanager
def settings(spark: SparkSession, **values):
    """Session settings for the length of a block; ``__`` stands for a dot."""
    names = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def plan_text(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def plan_nodes(df: DataFrame) -> list[str]:
    """Names of the physical nodes, top first, without adaptive re-planning."""
    with settings(df.sparkSession, spark__sql__adaptive__enabled="false"):
        text = df.select("*")._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"^[\s:+\-|]*(?:\*\(\d+\) )?([A-Z]\w+)", text, re.M)


def _of_scans(df: DataFrame, metric: str) -> int:
    """Run ``df`` and add up a metric of its file scans."""
    with settings(df.sparkSession, spark__sql__adaptive__enabled="false"):
        run = df.select("*")._jdf.queryExecution()
        run.toRdd().count()
    plans, found = [run.executedPlan()], 0
    while plans:
        node = plans.pop()
        if node.nodeName().startswith("Scan") and node.metrics().contains(metric):
            found += node.metrics().apply(metric).value()
        children = node.children()
        plans += [children.apply(i) for i in range(children.size())]
    return found


def rows_scanned(df: DataFrame) -> int:
    """Run ``df`` and add up the rows its file scans gave out.

    The plan's text shows filters even where they let every row group through;
    this count does not.
    """
    return _of_scans(df, "numOutputRows")


def files_scanned(df: DataFrame) -> int:
    """Run ``df`` and add up the files its scans were given to open."""
    return _of_scans(df, "numFiles")
