"""Wall times of actions."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from statistics import median
from time import perf_counter
from typing import TypeVar

Result = TypeVar("Result")


def timed(action: Callable[[], Result]) -> tuple[Result, float]:
    """The result of the action and its wall time in seconds."""
    start = perf_counter()
    result = action()
    return result, perf_counter() - start


def compare(variants: Mapping[str, Callable[[], object]], repeats: int) -> dict[str, float]:
    """Median wall time of each variant.

    Every variant runs once to warm up. Then all run in turn, forwards and
    backwards, so that none always gains from what ran before it.
    """
    for action in variants.values():
        action()
    seconds: dict[str, list[float]] = {name: [] for name in variants}
    for turn in range(repeats):
        names = list(variants) if turn % 2 == 0 else list(reversed(variants))
        for name in names:
            seconds[name].append(timed(variants[name])[1])
    return {name: round(median(times), 3) for name, times in seconds.items()}
