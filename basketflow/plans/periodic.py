"""Jobs that repeat on a schedule."""

import re
import threading
from collections.abc import Callable

UNITS = {"second": 1, "minute": 60, "hour": 3600}


def seconds(interval: str) -> float:
    """``"20 seconds"``, ``"5 minutes"`` or ``"1 hour"`` as seconds."""
    parsed = re.fullmatch(r"\s*([0-9]+(?:[.][0-9]+)?)\s*(second|minute|hour)s?\s*", interval)
    if not parsed:
        raise ValueError(f"no interval: {interval}")
    return float(parsed[1]) * UNITS[parsed[2]]


def repeat(job: Callable[[], object], interval: str, stop: threading.Event | None = None, runs: int | None = None) -> None:
    """Run ``job`` every ``interval``, one run at a time, until ``stop`` is set.

    Intervals that pass during a run are not made up for. An error ends the loop: the job has
    noted it in its log, and whoever runs the loop decides whether to start it again.
    """
    stop = stop or threading.Event()
    every, done = seconds(interval), 0
    while not stop.is_set() and (runs is None or done < runs):
        job()
        done += 1
        if runs is None or done < runs:
            stop.wait(every)
