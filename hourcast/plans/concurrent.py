"""Submit independent Spark jobs from several driver threads.

Spark schedules jobs from different threads concurrently (FIFO by default, FAIR
when configured), so independent writes of one pipeline stage overlap instead
of queueing -- small jobs stop wasting idle executors.  Any failure is
re-raised after all jobs finished.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor


def run_all(*jobs: Callable[[], object], max_workers: int | None = None) -> list:
    if len(jobs) <= 1:
        return [j() for j in jobs]
    with ThreadPoolExecutor(max_workers=max_workers or len(jobs)) as pool:
        futures = [pool.submit(j) for j in jobs]
        errors, results = [], []
        for f in futures:
            try:
                results.append(f.result())
            except BaseException as e:  # noqa: BLE001 -- collect, re-raise first
                errors.append(e)
                results.append(None)
    if errors:
        raise errors[0]
    return results
