"""Run independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")


def together(
    spark: SparkSession, run: Callable[[Item], Result], items: Iterable[Item], parallelism: int = 4
) -> list[Result]:
    """``run`` of every item, in order, at most ``parallelism`` at a time.

    A fit is a chain of short jobs with a driver step between them; a few chains
    at once keep the executors busy.
    """
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(inheritable_thread_target(spark)(run), items))
