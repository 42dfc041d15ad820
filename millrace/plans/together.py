"""Submit jobs that do not depend on each other at the same time."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor


def together(*steps: Callable[[], object]) -> list:
    """Results in the order of the steps; all end before the first error is raised."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        running = [pool.submit(step) for step in steps]
    return [r.result() for r in running]
