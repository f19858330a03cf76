"""Column names that clash with nobody's."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spare(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores added until no frame has such a column in any case."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name
