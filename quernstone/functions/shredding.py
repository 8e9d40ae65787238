"""Columnar shredding of nested values, with repetition and definition levels for each leaf path.

A path is a list of steps (name, repeated).  Every repeated step adds two definition levels, one for the
slot in the array and one for a value in it, so that null elements keep their place; every other step
adds one.  A table of a repeated ancestor is rebuilt from the levels alone: repetition level 0 starts a
record, level k starts the next slot of the k-th repeated step.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

Step = tuple[str, bool]


@dataclass
class Column:
    """One leaf path's values and levels over a batch of records."""

    path: list[Step]
    repetition: list[int] = field(default_factory=list)
    definition: list[int] = field(default_factory=list)
    values: list = field(default_factory=list)

    def add(self, record) -> None:
        """Appends a record; None stands for one that can't be read."""
        self._walk(record, 0, 0, 0, 0)

    def _put(self, repetition: int, definition: int, value=None) -> None:
        self.repetition.append(repetition)
        self.definition.append(definition)
        self.values.append(value)

    def _walk(self, value, step: int, repetition: int, definition: int, depth: int) -> None:
        if step == len(self.path):
            return self._put(repetition, definition, value)
        name, repeated = self.path[step]
        inner = value.get(name) if isinstance(value, dict) else None
        if not repeated:
            if inner is None:
                return self._put(repetition, definition)
            return self._walk(inner, step + 1, repetition, definition + 1, depth)
        if isinstance(inner, dict):  # an object alone stands for an array of one
            inner = [inner]
        if not isinstance(inner, list) or not inner:
            return self._put(repetition, definition)
        for i, element in enumerate(inner):
            level = repetition if i == 0 else depth + 1
            if element is None:
                self._put(level, definition + 1)
            else:
                self._walk(element, step + 1, level, definition + 2, depth + 1)


def levels_of(path: list[Step], step: int) -> int:
    """The definition level from which the path's first ``step`` + 1 steps hold a value."""
    return sum(2 if repeated else 1 for _, repeated in path[: step + 1])


@dataclass
class Table:
    """Rows of a repeated ancestor (or of a single value): record, positions, and one value for each leaf."""

    record: np.ndarray
    positions: list[np.ndarray]
    leaves: list[np.ndarray]


def positions(repetition: np.ndarray, depth: int) -> list[np.ndarray]:
    """Place of each entry in each of ``depth`` nested arrays, from its repetition level."""
    places = []
    for k in range(1, depth + 1):
        opens = repetition < k  # starts the array anew
        steps = np.cumsum(repetition == k)
        base = np.maximum.accumulate(np.where(opens, np.arange(len(repetition)), 0))
        places.append(steps - steps[base])
    return places


def rebuild(columns: list[Column], step: int) -> Table:
    """The table of the paths' common ancestor at ``step``: one row for each value there.

    The columns share the path up to ``step`` and repeat no further, so their levels run in parallel.
    """
    path = columns[0].path
    repetition = np.array(columns[0].repetition, np.int64)
    definition = np.array(columns[0].definition, np.int64)
    depth = sum(repeated for _, repeated in path)
    here = np.flatnonzero(definition >= levels_of(path, step))
    record = np.cumsum(repetition == 0) - 1
    leaves = []
    for c in columns:
        values = np.empty(len(c.values), object)
        values[:] = c.values
        leaves.append(values[here])
    return Table(record[here], [p[here] for p in positions(repetition, depth)], leaves)
