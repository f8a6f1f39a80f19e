"""From attachment rows to stored objects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.functions.paths import base_name, case_id_of_prefix, local_path, normalise_location
from attestry.schemas import MANIFEST, UNRESOLVED

# Fixed value: the label of files found by prefix.
UNKNOWN_TYPE = "unknown"


def normalise_locations(attachments: DataFrame, container: str) -> DataFrame:
    """Add the object name (``blob_path``) each location points to."""
    return attachments.withColumn("blob_path", normalise_location("file_location", container))


def locate(attachments: DataFrame, objects: DataFrame, container: str) -> DataFrame:
    """All attachments with the size of their object and why a row fails, if it does."""
    return with_objects(normalise_locations(attachments, container), objects)


def with_objects(normalised: DataFrame, objects: DataFrame) -> DataFrame:
    """``locate`` for attachments that have their ``blob_path`` already.

    Object names are unique, so the join keeps one row per attachment. Rows
    without a usable location or name stay out of it: they would all meet on
    one null key.
    """
    located = normalised.withColumn(
        "_wanted",
        F.when(F.coalesce(F.col("file_name"), F.lit("")) != "", F.col("blob_path")),
    )
    sizes = objects.select(F.col("name").alias("_wanted"), F.col("size").alias("size_bytes"))
    searched = located.where(F.col("_wanted").isNotNull()).join(sizes, "_wanted", "left")
    skipped = located.where(F.col("_wanted").isNull()).withColumn(
        "size_bytes", F.lit(None).cast("bigint")
    )
    reason = (
        F.when(F.col("blob_path").isNull(), "blank_location")
        .when(F.col("file_name").isNull(), "null_file_name")
        .when(F.col("file_name") == "", "empty_file_name")
        .when(F.col("size_bytes").isNull(), "object_not_found")
    )
    return searched.unionByName(skipped).withColumn("reason", reason).drop("_wanted")


def _as_manifest(rows: DataFrame) -> DataFrame:
    return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in MANIFEST.fields))


def direct_rows(located: DataFrame) -> DataFrame:
    """Manifest rows of the attachments whose location names an object."""
    found = located.where(F.col("reason").isNull())
    return _as_manifest(found.withColumn("local_path", local_path("ras_id", "file_name")))


def unresolved_rows(located: DataFrame) -> DataFrame:
    """Attachment rows without a manifest row, and why."""
    failed = located.where(F.col("reason").isNotNull())
    return failed.select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in UNRESOLVED.fields)
    )


def resolve_direct(attachments: DataFrame, objects: DataFrame, container: str) -> DataFrame:
    return direct_rows(locate(attachments, objects, container))


def unresolved(attachments: DataFrame, objects: DataFrame, container: str) -> DataFrame:
    return unresolved_rows(locate(attachments, objects, container))


def resolve_fallback(cases: DataFrame, direct: DataFrame, objects: DataFrame) -> DataFrame:
    """Manifest rows for the cases without any direct hit: all objects of the case.

    The prefix search is an equi-join on the case id read from the name. Few cases are
    without a hit, so Spark filters the objects by them before they are shuffled (a
    Bloom filter made at run time, or a broadcast where they are few enough).
    """
    hit = direct.select("ras_id").distinct()
    missing = (
        cases.select("ras_id")
        .distinct()
        .join(hit, "ras_id", "left_anti")
        .withColumn("_case", F.col("ras_id").cast("string"))
    )
    candidates = objects.select(
        F.col("name").alias("blob_path"),
        F.col("size").alias("size_bytes"),
        base_name("name").alias("file_name"),
        case_id_of_prefix("name").alias("_case"),
    ).where(F.col("_case").isNotNull() & (F.col("file_name") != ""))
    found = candidates.join(missing, "_case").withColumns(
        {
            "att_type": F.lit(UNKNOWN_TYPE),
            "supplier_id": F.lit(None),
            "local_path": local_path("ras_id", "file_name"),
            "att_id": F.lit(None),
            "uploaded_on": F.lit(None),
        }
    )
    return _as_manifest(found)


def mark_missing(manifest: DataFrame, objects: DataFrame) -> DataFrame:
    """Manifest rows with ``found``: is there an object behind ``blob_path``?"""
    present = objects.select(F.col("name").alias("blob_path"), F.lit(True).alias("_present"))
    joined = manifest.join(present, "blob_path", "left")
    return joined.withColumn("found", F.col("_present").isNotNull()).drop("_present")
