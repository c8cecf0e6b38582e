"""Statistics that must degrade to NULL instead of failing under ANSI."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_safe_corr(a: str, b: str) -> Column:
    """Pearson correlation over pairs where both sides are non-NULL.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI for a constant column; this
    form returns NULL for fewer than two pairs or a constant side.  Each
    side is masked by the other's NULLs so all moments use the same pairs.
    """
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x = F.when(both, F.col(a).cast("double"))
    y = F.when(both, F.col(b).cast("double"))
    denom = F.stddev_pop(x) * F.stddev_pop(y)
    return F.covar_pop(x, y) / F.nullif(denom, F.lit(0.0))
