"""Identifiers and path parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def element_uid(project_id, source_file, guid) -> Column:
    """A repeatable id per ingested element (replays give the same id, X3)."""
    return F.sha2(F.concat_ws("|", _as_col(project_id), _as_col(source_file), _as_col(guid)), 256)


def surrogate_key(*cols) -> Column:
    """Repeatable 64-bit surrogate of a natural key (instead of a sequence)."""
    return F.xxhash64(*[_as_col(c) for c in cols])


def url_bucket(url) -> Column:
    """Second-last path segment of an object URL; null without one."""
    return F.try_element_at(F.split(_as_col(url), "/"), F.lit(-2))


def url_object(url) -> Column:
    """Last path segment of an object URL."""
    return F.element_at(F.split(_as_col(url), "/"), -1)


def project_from_filename(file_name) -> Column:
    """``ifc_{stem}`` from a file name (extension removed)."""
    stem = F.regexp_extract(_as_col(file_name), r"([^/]*?)(\.[^./]*)?$", 1)
    return F.concat(F.lit("ifc_"), stem)


def default_project_name(ts) -> Column:
    """``IFC_Import_{yyyyMMdd_HHmmss}``."""
    return F.concat(F.lit("IFC_Import_"), F.date_format(_as_col(ts), "yyyyMMdd_HHmmss"))
