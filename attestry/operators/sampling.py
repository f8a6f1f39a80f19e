"""Choice of cases and the rows that belong to them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What makes a case a candidate, and how many are kept.
RECENT_MONTHS = 6
MIN_FILES = 3
MIN_SUPPLIERS = 2
TOP_CANDIDATES = 50
SAMPLE_SIZE = 5
NULL_LABEL = "NULL"


def _candidate_order() -> list[Column]:
    return [F.desc("num_suppliers"), F.desc("num_attachments"), F.asc("ras_id")]


def select_cases(
    attachments: DataFrame,
    as_of: datetime | Column,
    months: int = RECENT_MONTHS,
    min_files: int = MIN_FILES,
    min_suppliers: int = MIN_SUPPLIERS,
    top: int = TOP_CANDIDATES,
    min_doc_types: int = 0,
) -> DataFrame:
    """Recent cases with several files and suppliers, most suppliers first.

    Counts come first, over all cases; the list of labels is put together only
    for the few cases that are kept. A list in the first aggregation would take
    it off the hash path and sort every group.
    """
    upper = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    since = upper - F.expr(f"INTERVAL {int(months)} MONTH")
    recent = attachments.where(F.col("uploaded_on") >= since)
    counts = recent.groupBy("ras_id").agg(
        F.count("*").alias("num_attachments"),
        F.count_distinct("supplier_id").alias("num_suppliers"),
        F.count_distinct("att_type").alias("num_doc_types"),
        F.max("uploaded_on").alias("latest_upload"),
    )
    kept = (
        counts.where(
            (F.col("num_attachments") >= min_files)
            & (F.col("num_suppliers") >= min_suppliers)
            & (F.col("num_doc_types") >= min_doc_types)
        )
        .orderBy(*_candidate_order())
        .limit(top)
    )
    labels = (
        attachments_of_cases(recent, kept)
        .groupBy("ras_id", F.coalesce("att_type", F.lit(NULL_LABEL)).alias("_label"))
        .agg(F.count("*"))
        .groupBy("ras_id")
        .agg(F.array_join(F.array_sort(F.collect_list("_label")), ", ").alias("doc_types"))
    )
    columns = "ras_id num_attachments num_suppliers num_doc_types doc_types latest_upload".split()
    return kept.join(labels, "ras_id").select(*columns)


def pick_sample(candidates: DataFrame, size: int = SAMPLE_SIZE) -> DataFrame:
    """The first candidates, in the order of the ranking."""
    return candidates.orderBy(*_candidate_order()).limit(size)


def items_of_cases(items: DataFrame, cases: DataFrame) -> DataFrame:
    """Item rows of the given cases."""
    return items.join(cases.select("ras_id"), "ras_id", "left_semi")


def attachments_of_cases(attachments: DataFrame, cases: DataFrame) -> DataFrame:
    """Attachment rows of the given cases; sort by ``ATTACHMENT_ORDER`` to list them."""
    return attachments.join(cases.select("ras_id"), "ras_id", "left_semi")


# The order in which the files of a case are handled.
ATTACHMENT_ORDER = ("ras_id", "uploaded_on", "att_id")
