"""Row hashes that give the same value in any engine and any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 1 << 32


def key_hash(*cols: Column | str) -> Column:
    """First 32 bits of md5 over the '-'-joined key, as a long in [0, 2^32)."""
    text = F.concat_ws("-", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def seeded_uniform(key: Column | str, salt: str) -> Column:
    """Uniform in (0, 1), a pure function of (key, salt): independent of partitioning
    and safe to recompute after an executor is lost."""
    key = F.col(key) if isinstance(key, str) else key
    return (key_hash(key, F.lit(salt)) + F.lit(0.5)) / F.lit(float(HASH_RANGE))


def seeded_normal(key: Column | str, salt: str) -> Column:
    """Standard normal by Box-Muller over two seeded uniforms."""
    u, v = seeded_uniform(key, salt + "/r"), seeded_uniform(key, salt + "/a")
    return F.sqrt(F.lit(-2.0) * F.log(u)) * F.cos(F.lit(6.283185307179586) * v)
