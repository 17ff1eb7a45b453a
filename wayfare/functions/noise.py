"""Repeatable randomness: a row's draw depends on its key only.

Draws do not depend on partitioning, so a retried task yields the same rows again.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SPAN = float(1 << 32)


def uniform(key: Column, seed: int, stream: str) -> Column:
    """A number in (0, 1) from the key; ``stream`` separates several draws per row."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(stream), key.cast("string")))
    whole = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return (whole + 0.5) / _SPAN
