"""Wall time of steps. Spark is lazy, so wrap actions, not transformations."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager


class Timings(dict):
    """Seconds per step name; repeated steps add up."""

    @contextmanager
    def timed(self, name: str) -> Iterator[None]:
        start = time.perf_counter()
        try:
            yield
        finally:
            self[name] = self.get(name, 0.0) + time.perf_counter() - start
