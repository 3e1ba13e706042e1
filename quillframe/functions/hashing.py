"""Seeded choices that depend on a row's key alone.

``rand(seed)`` depends on how rows are spread over partitions, so a retried task or another
partition count would choose other rows. A digest of the key gives the same choice everywhere.
Build keys from integers and strings: engines print doubles differently.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_hex(key: Sequence[str | Column], seed: int, tag: str = "") -> Column:
    """32 hex digits, evenly spread, for a row key; ``tag`` separates independent choices."""
    parts = [F.col(k) if isinstance(k, str) else k for k in key]
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts], F.lit(tag), F.lit(str(seed))))


def hash_unit(key: Sequence[str | Column], seed: int, tag: str = "") -> Column:
    """The same choice as a number in [0, 1)."""
    digits = F.substring(hash_hex(key, seed, tag), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 32))


def hash_below(key: Sequence[str | Column], share: float, seed: int, tag: str = "") -> Column:
    """True for a ``share`` of rows: ``hash_unit(...) < share`` without parsing the digits."""
    threshold = math.ceil(share * (1 << 32))
    if threshold >= 1 << 32:
        return F.lit(True)
    return F.substring(hash_hex(key, seed, tag), 1, 8) < F.lit(f"{max(threshold, 0):08x}")


def hash_normal(key: Sequence[str | Column], seed: int, tag: str = "") -> Column:
    """A standard normal draw (Box-Muller on two independent choices)."""
    radius = F.sqrt(-2 * F.log(1 - hash_unit(key, seed, tag + "/radius")))
    return radius * F.cos(2 * math.pi * hash_unit(key, seed, tag + "/angle"))
