"""Recording keys and deterministic identifiers (column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridwave import constants as C


def pair_key(path: Column) -> Column:
    """Path without its last extension: ``/a b.v1/m0.cfg`` -> ``/a b.v1/m0``.

    Only the final ``.ext`` of the last path segment is removed, so dots in
    folder names keep distinct recordings apart.
    """
    return F.regexp_replace(path, r"\.[^./]+$", "")


def first_dot_key(path: Column) -> Column:
    """The reference's key: everything before the first dot of the whole path."""
    return F.element_at(F.split(path, r"\."), 1)


def base_name(path: Column) -> Column:
    """File name without folder or extension."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]+)?$", 1)


def short_id(key: Column, length: int = 12) -> Column:
    """Stable stand-in for a random suffix: same key -> same id, on every retry."""
    return F.substring(F.md5(key.cast("string")), 1, length)


def device_id(key: Column, modulus: int = C.DEVICE_ID_MODULUS) -> Column:
    """Stable device number in ``0 .. modulus-1`` derived from the key."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10)
                  .cast("bigint"), F.lit(modulus))


def label_by_pattern(path: Column, pattern: str = C.FAULT_PATH_PATTERN) -> Column:
    """1 when the path matches ``pattern`` (regex, case-sensitive), else 0."""
    return path.rlike(pattern).cast("int")
