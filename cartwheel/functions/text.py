"""Report line building."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pipe_line(*cols: Column) -> Column:
    """Join fields with `` | `` as the text reports do."""
    return F.concat_ws(" | ", *[c.cast("string") for c in cols])
