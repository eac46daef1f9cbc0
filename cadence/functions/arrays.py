"""Array helpers (all Catalyst built-ins, no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def weighted_checksum(arr: Column, digits: int = 4) -> Column:
    """Order-sensitive fingerprint of a numeric array: Σ round(x[i], digits)·(i+1).

    Terms are rounded first and summed as DECIMAL, so the result is exact and
    independent of summation order (it compares equal across engines).
    """
    dec = f"decimal(22,{digits})"
    terms = F.transform(arr, lambda x, i: F.round(x.cast("double"), digits).cast(dec) * (i + 1).cast("decimal(10,0)"))
    total = F.aggregate(terms, F.lit(0).cast(f"decimal(38,{digits})"), lambda acc, y: (acc + y).cast(f"decimal(38,{digits})"))
    return total.cast("double")


def pad_truncate(arr: Column, width: int = 32, fill: float = 0.0) -> Column:
    """Zero-pad on the right or cut to exactly ``width`` elements."""
    filler = F.array_repeat(F.lit(fill).cast("double"), width)
    return F.slice(F.concat(F.transform(arr, lambda x: x.cast("double")), filler), 1, width)
