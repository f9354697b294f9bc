"""Independent jobs at the same time."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")


def together(
    spark: SparkSession, names: Iterable[str], job: Callable[[str], Result]
) -> dict[str, Result]:
    """Run the job for each name, all submitted at once, and return the results.

    While the last tasks of one job run, the cluster works on the others.
    """
    names = list(names)
    inheriting = inheritable_thread_target(spark)(job)
    with ThreadPoolExecutor(max_workers=max(1, len(names))) as pool:
        running = {name: pool.submit(inheriting, name) for name in names}
        return {name: result.result() for name, result in running.items()}
