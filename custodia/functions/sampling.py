"""Deterministic shares of traffic by hash, the same on every run and executor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_cut(share: float) -> str:
    """Upper bound for the first 8 hex digits of a digest that keeps ``share`` of all ids."""
    return format(int(share * 2**32), "08x")


def in_share(key: Column, share: float) -> Column:
    return F.substring(F.sha2(key.cast("string"), 256), 1, 8) < F.lit(hash_cut(share))


def canary(key: Column, share: float = 0.10) -> Column:
    return F.when(in_share(key, share), "green").otherwise("blue")
