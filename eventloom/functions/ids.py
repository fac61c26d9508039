"""Deterministic identifiers (the reference used a per-process salted hash)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EVENT_PREFIX = "event_"
CHUNK_INFIX = "_chunk_"


def event_id(title: Column) -> Column:
    """``event_`` + first 16 hex digits of SHA-256(title): stable across runs."""
    return F.concat(F.lit(EVENT_PREFIX), F.substring(F.sha2(title, 256), 1, 16))


def chunk_id(event: Column, index: Column) -> Column:
    return F.concat(event, F.lit(CHUNK_INFIX), index.cast("string"))


def event_key(response_id: Column, event_idx: Column) -> Column:
    """Text that sorts as ``(response_id, event_idx)`` does, for any 64-bit id and 32-bit index."""
    shifted = response_id.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
    return F.concat(F.lpad(shifted.cast("string"), 20, "0"), F.lit("-"), F.lpad(event_idx.cast("string"), 10, "0"))
