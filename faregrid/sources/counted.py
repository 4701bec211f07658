"""Counts taken by the same pass that writes the rows.

A count observed on the way sees a row again when its task is repeated after a lost
executor and the first attempt had already reported. So it is only believed where it
agrees with what footers say: rows that came in with the rows of the source, rows that
went out with the rows of the stored table. Otherwise it is counted anew from the tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation


class Counted:
    """Rows with counts beside them; ``rows`` is what has to be written."""

    def __init__(self, df: DataFrame, name: str, counts: Mapping[str, Column]):
        self._names = list(counts)
        self._seen = Observation(f"{name}-{uuid.uuid4().hex}")
        self.rows = df.observe(self._seen, *[c.alias(n) for n, c in counts.items()])

    def values(self) -> dict[str, int]:
        """The counts, after the rows were written; a plan without any row counts nothing."""
        got = self._seen.get
        return {name: int(got.get(name) or 0) for name in self._names}


def believed(
    observed: Mapping[str, int], known: Mapping[str, int], recount: Callable[[], Mapping[str, int]]
) -> dict[str, int]:
    """``observed`` where it agrees with all ``known`` counts, else those of ``recount``."""
    if all(observed[name] == rows for name, rows in known.items()):
        return dict(observed)
    return dict(recount())
