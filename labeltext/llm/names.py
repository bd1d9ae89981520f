"""Names for an operator's own columns beside those of the caller."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name``, with as many more underscores in front as it takes to differ from ``taken`` (in any case of letters)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def quoted(name: str) -> Column:
    """The column of that very name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")
