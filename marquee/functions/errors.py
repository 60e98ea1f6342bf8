"""Text of one response error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def error_text(error: str = "error") -> Column:
    """``extensions : locations : message``; the first two parts as JSON.

    A missing part reads ``null``, so the text always has three parts.
    """
    parts = [
        F.to_json(F.col(f"{error}.extensions")),
        F.to_json(F.col(f"{error}.locations")),
        F.col(f"{error}.message"),
    ]
    return F.concat_ws(" : ", *[F.coalesce(part, F.lit("null")) for part in parts])
