"""Spark jobs side by side: independent actions of one driver, each in a thread of its own."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

#: Actions that run at once; their tasks share the executors.
AT_ONCE = 4


def side_by_side(spark: SparkSession, work: Callable, items: Iterable, group: str, at_once: int = AT_ONCE) -> list:
    """``work(item)`` of every item, in order. Each item's jobs have a job group (``group`` and the item's place)
    and, with the FAIR scheduler, a pool of their own. If one fails, the others are finished and the first
    failure is raised."""
    sc = spark.sparkContext

    def one(numbered: tuple[int, object]):
        number, item = numbered
        sc.setJobGroup(f"{group}-{number}", f"{group}: {number}", interruptOnCancel=True)
        sc.setLocalProperty("spark.scheduler.pool", f"{group}-{number}")
        try:
            return work(item), None
        except Exception as error:  # noqa: BLE001  raised below
            return None, error
        finally:
            for name in ("spark.scheduler.pool", "spark.jobGroup.id", "spark.job.description"):
                sc.setLocalProperty(name, None)

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(one), enumerate(items)))
    for _, error in done:
        if error is not None:
            raise error
    return [result for result, _ in done]
