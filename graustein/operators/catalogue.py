"""Versioned material catalogue."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graustein.functions.numbers import to_number


class NoActiveVersion(ValueError):
    """A run without an active catalogue version is a hard error."""


def active_version_row(versions: DataFrame) -> DataFrame:
    """T1 as a one-row DataFrame: the active version with the latest release date
    (ties broken by the greater version string). Versions are a small table."""
    order = ([F.col("release_date").desc_nulls_last()] if "release_date" in versions.columns else []) + [F.col("version").desc()]
    return (versions.filter(F.col("is_active"))
            .orderBy(*order)
            .limit(1)
            .select("version"))


def active_version(versions: DataFrame) -> str:
    """The active version string; raises ``NoActiveVersion`` when none is active."""
    row = active_version_row(versions).first()
    if row is None:
        raise NoActiveVersion("No active KBOB version found in database")
    return row["version"]


def materials_of_version(materials: DataFrame, version: str) -> DataFrame:
    """J2 right side: catalogue rows of one version (the filter reaches the scan)."""
    return materials.filter(F.col("version") == F.lit(version))


def active_materials(materials: DataFrame, versions: DataFrame) -> DataFrame:
    """Catalogue rows whose version is the active one."""
    return materials.join(F.broadcast(active_version_row(versions)), "version", "inner")  # one row (limit 1)


def material_by_uuid(materials: DataFrame, versions: DataFrame, uuid: str,
                     version: str | None = None) -> DataFrame:
    """A material by uuid and version; ``version=None`` means the active one."""
    rows = materials.filter(F.col("uuid") == F.lit(uuid))
    if version is None:
        return active_materials(rows, versions)
    return rows.filter(F.col("version") == F.lit(version))


def versions_in_materials(materials: DataFrame) -> DataFrame:
    """Distinct catalogue versions."""
    return materials.select("version").distinct()


def latest_version(materials: DataFrame) -> DataFrame:
    """A4: the greatest version string (string order)."""
    return materials.agg(F.max("version").alias("latest_version"))


def missing_versions(materials: DataFrame, versions: DataFrame) -> DataFrame:
    """Versions used by materials but absent from the versions table."""
    return versions_in_materials(materials).join(versions.select("version"), "version", "left_anti")


def replace_version(materials: DataFrame, new_rows: DataFrame, version: str) -> DataFrame:
    """M4: drop every row of ``version`` and add the new rows (one version per load)."""
    return materials.filter(~F.col("version").eqNullSafe(F.lit(version))).unionByName(new_rows, allowMissingColumns=True)


class UnknownVersion(ValueError):
    pass


def set_active_version(versions: DataFrame, version: str) -> DataFrame:
    """M8: activate one version and deactivate the rest; unknown version -> error."""
    if versions.filter(F.col("version") == F.lit(version)).limit(1).count() == 0:
        raise UnknownVersion(f"KBOB version {version} not found")
    return versions.withColumn("is_active", F.col("version") == F.lit(version))


def repair_versions(materials: DataFrame, versions: DataFrame, today: _dt.date | None = None) -> DataFrame:
    """Add the newest material version when it is missing, and make it the active one.
    Without any material nothing changes."""
    latest = latest_version(materials).first()["latest_version"]  # one scalar
    if latest is None:
        return versions
    added = (versions.sparkSession.range(1)
             .select(F.lit(latest).alias("version"), F.lit(True).alias("is_active"),
                     F.lit(today or _dt.date.today()).cast("date").alias("release_date"),
                     F.lit(None).cast("string").alias("description"),
                     F.current_timestamp().alias("created_at"))
             .join(versions.select("version"), "version", "left_anti"))
    merged = versions.unionByName(added, allowMissingColumns=True)
    return merged.withColumn("is_active", F.col("version") == F.lit(latest))
