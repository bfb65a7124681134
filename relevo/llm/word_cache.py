"""What an operator that encodes texts keeps in a Python worker, and how much
text it takes at a time."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

#: Characters of text that are worked on at a time.
SLICE = 2_000_000


class Loaded:
    """Something built once in each Python worker from bytes that travel with
    the task; ``build`` is a function of a module."""

    def __init__(self, build: Callable, *args):
        self.packed, self.value = pickle.dumps((build, args)), None

    def __getstate__(self):
        return {"packed": self.packed, "value": None}

    def get(self):
        if self.value is None:
            build, args = pickle.loads(self.packed)
            self.value = build(*args)
        return self.value


def slices(lengths: list[int], size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` characters, or one row, from the
    lengths of all."""
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > size:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)
