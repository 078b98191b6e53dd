"""Independent model fits submitted to the cluster side by side, and sums over blocks of rows."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import TypeVar

from pyspark import RDD
from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

B, T = TypeVar("B"), TypeVar("T")

#: Tasks at most that add up counts or summaries; there is a key per node of a level or per leaf.
ADDING_TASKS = 16
#: Summaries that are merged one after the other; more are merged in groups of as many.
FAN_IN = 16


def fit_all(spark: SparkSession, fits: Sequence[Callable[[], T]], parallelism: int = 4) -> list[T]:
    """Run the fits from ``parallelism`` driver threads, results in order.

    The threads only wait for Spark jobs; a fit with few tasks leaves room for another.
    """
    with ThreadPoolExecutor(max_workers=min(parallelism, max(len(fits), 1))) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(fit)) for fit in fits]
        return [f.result() for f in futures]


def totals(blocks: RDD, of: Callable[[B], dict], add: Callable[[T, T], T], end: Callable[[Hashable, T], object]) -> dict:
    """What ``of`` gives for each block by key, added up in the order of the blocks where the shuffle puts the key.

    The driver gets ``end`` of each sum only, so what it receives does not depend on the number of blocks.
    """
    join = lambda a, b: {k: add(a[k], b[k]) if k in a and k in b else a.get(k, b.get(k)) for k in a.keys() | b.keys()}
    tasks = min(blocks.getNumPartitions(), ADDING_TASKS)

    def own(at: int, part: Iterator[B]) -> Iterator[tuple]:
        return ((k, (at, v)) for k, v in reduce(join, map(of, part), {}).items())

    def whole(pair: tuple) -> tuple:
        parts = [v for _, v in sorted(pair[1], key=lambda p: p[0])]
        while len(parts) > 1:
            parts = [reduce(add, parts[i : i + FAN_IN]) for i in range(0, len(parts), FAN_IN)]
        return pair[0], end(pair[0], parts[0])

    pairs = blocks.mapPartitionsWithIndex(own)
    return dict((pairs.groupByKey(tasks) if tasks > 1 else pairs.mapValues(lambda v: [v])).map(whole).collect())
