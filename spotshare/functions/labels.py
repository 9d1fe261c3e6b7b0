"""Yes/no labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def yes_no(flag: Column) -> Column:
    """1 is "si"; everything else, NULL included, is "no"."""
    return F.when(flag == 1, "si").otherwise("no")
