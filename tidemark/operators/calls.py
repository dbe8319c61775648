"""Calls of foreign services from within a task: several at once, results in order, an error for each row."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from threading import Lock


class Budget:
    """Lets calls begin at most ``rate`` a second, whichever thread they come from; None: at once."""

    def __init__(self, rate: float | None = None):
        self.gap, self.next, self.lock = 1 / rate if rate else 0.0, 0.0, Lock()

    def wait(self) -> None:
        if not self.gap:
            return
        with self.lock:
            at = max(self.next, time.monotonic())
            self.next = at + self.gap
        time.sleep(max(0.0, at - time.monotonic()))


def in_order[T, R](rows: Iterable[T], call: Callable[[T], R], width: int = 1, rate: float | None = None) -> Iterator[tuple[R | None, Exception | None]]:
    """(result, error) of ``call`` for each row, in the rows' order. ``width`` calls run at once, and no more rows are taken than twice as many, so memory follows the width; a slow call holds up only what is behind it."""
    budget = Budget(rate)

    def one(row: T) -> R:
        budget.wait()
        return call(row)

    def result(done: Future) -> tuple[R | None, Exception | None]:
        error = done.exception()
        if error is not None and not isinstance(error, Exception):
            raise error
        return (None, error) if error else (done.result(), None)

    waiting: deque[Future] = deque()
    with ThreadPoolExecutor(max(1, width)) as pool:
        for row in rows:
            waiting.append(pool.submit(one, row))
            if len(waiting) >= 2 * max(1, width):
                yield result(waiting.popleft())
        while waiting:
            yield result(waiting.popleft())


def in_groups[T, R](rows: list[T], call: Callable[[list[T]], list[R]], size: int, width: int = 1, rate: float | None = None) -> list[tuple[R | None, Exception | None]]:
    """(result, error) of each row, of calls for ``size`` rows each. A call that fails, or answers for another number of rows, is made again row by row, so that a bad row fails alone."""

    def checked(some: list[T]) -> list[R]:
        got = list(call(some))
        if len(got) != len(some):
            raise ValueError(f"{len(got)} answers for {len(some)} rows")
        return got

    groups = [rows[at : at + size] for at in range(0, len(rows), size)]
    out: list[tuple[R | None, Exception | None]] = []
    for some, (got, error) in zip(groups, in_order(groups, checked, width, rate), strict=True):
        if error is None:
            out += [(x, None) for x in got]
        elif len(some) == 1:
            out.append((None, error))
        else:
            out += [(None if x is None else x[0], e) for x, e in in_order([[r] for r in some], checked, width, rate)]
    return out
