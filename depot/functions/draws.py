"""Keyed uniform draws: u(seed, salt, key) in [0, 1).

A stateless function of its inputs (first 32 bits of an md5), so a draw does
not depend on partitioning, retries or execution order, and SQL engines can
reproduce it:  ``conv(substr(md5(concat_ws('|', seed, salt, key)), 1, 8), 16, 10) / 2^32``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyed_uniform(seed: int, salt: str, *keys: Column | str) -> Column:
    parts = [F.lit(str(seed)), F.lit(salt)] + [F.col(k) if isinstance(k, str) else k for k in keys]
    h = F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 8)
    return F.conv(h, 16, 10).cast("bigint") / F.lit(4294967296.0)


def keyed_uniform_sql(seed: int, salt: str, *keys: str) -> str:
    """The DuckDB twin of ``keyed_uniform``."""
    inner = ", ".join([f"'{seed}'", f"'{salt}'"] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return f"(('0x' || substr(md5(concat_ws('|', {inner})), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"
