"""Profile of an object inventory ``(name, size)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestry.functions.amounts import format_size, percentage, round1, size_bucket
from attestry.functions.paths import case_id, extension_label
from attestry.operators.running import cut_in_chunks, with_totals_before
from attestry.schemas import SIZE_BUCKETS

TOP_EXTENSIONS = 15
TOP_CASES = 500
SAMPLE_PATHS = 20


def parse_paths(objects: DataFrame) -> DataFrame:
    """Case id and extension of every object."""
    return objects.select(
        "name",
        "size",
        case_id("name").alias("ras_id"),
        extension_label("name").alias("extension"),
    )


def inventory_summary(objects: DataFrame) -> DataFrame:
    """One row: files, bytes, distinct cases."""
    totals = objects.agg(
        F.count("*").alias("total_files"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("total_bytes"),
        F.count_distinct(case_id("name")).alias("distinct_cases"),
    )
    return totals.withColumn("total_size", format_size("total_bytes"))


def _one_row_total(groups: DataFrame, part: str) -> Column:
    """Sum of ``part`` over all groups, as a scalar subquery.

    The subquery keeps every column of the groups alive (inside a struct), so
    its plan equals the main one up to this point and the exchange is reused
    instead of reading the source again.
    """
    kept = [F.max(name).alias(name) for name in groups.columns if name != part]
    packed = groups.agg(F.struct(F.sum(part).alias(part), *kept).alias("t"))
    return packed.scalar().getField(part)


def file_types(objects: DataFrame, *extra: Column) -> DataFrame:
    """Files, share, total and mean size per extension, without an order.

    ``extra`` aggregates are added as they are.
    """
    groups = (
        objects.select(extension_label("name").alias("extension"), "name", "size")
        .groupBy("extension")
        .agg(F.count("*").alias("num_files"), F.sum("size").alias("total_bytes"), *extra)
    )
    total = _one_row_total(groups, "num_files")
    # Bound by a one-element explode: as a plain column it would be copied to every use.
    return (
        groups.withColumn("_total", F.explode(F.array(total)))
        .withColumn("avg_bytes", F.col("total_bytes") / F.col("num_files"))
        .withColumns(
            {
                "pct": percentage("num_files", "_total"),
                "total_size": format_size("total_bytes"),
                "avg_size": format_size("avg_bytes"),
            }
        )
        .drop("_total")
    )


def top_file_types(objects: DataFrame, top: int = TOP_EXTENSIONS) -> DataFrame:
    """The most frequent extensions; of equals, the one listed first."""
    types = file_types(objects, F.min("name").alias("first_name"))
    return types.orderBy(F.desc("num_files"), "first_name").limit(top)


def size_distribution(objects: DataFrame) -> DataFrame:
    """Files per size bucket in a fixed order; empty buckets stay.

    The domain has five rows, so the totals over it are no burden.
    """
    spark = objects.sparkSession
    domain = spark.createDataFrame(
        list(enumerate(SIZE_BUCKETS, start=1)), "position int, bucket string"
    )
    counts = objects.groupBy(size_bucket("size").alias("bucket")).agg(
        F.count("*").alias("num_files")
    )
    everything = Window.partitionBy(F.lit(0))
    filled = domain.join(counts, "bucket", "left").withColumn(
        "num_files", F.coalesce("num_files", F.lit(0))
    )
    total = F.sum("num_files").over(everything)
    return filled.select(
        "position",
        "bucket",
        "num_files",
        F.coalesce(percentage("num_files", total), F.lit(0.0)).alias("pct"),
    )


def _case_totals(objects: DataFrame) -> DataFrame:
    """Files and bytes per case and extension.

    A case with very many files collapses to one row per extension before the
    second, per-case aggregation.
    """
    return (
        parse_paths(objects)
        .where(F.col("ras_id").isNotNull())
        .groupBy("ras_id", "extension")
        .agg(F.count("*").alias("num_files"), F.sum("size").alias("total_bytes"))
    )


def case_coverage(objects: DataFrame, top: int | None = None) -> DataFrame:
    """Files, bytes and the extensions found for every case, or the ``top`` cases by files.

    Of equals, the case listed first comes first. Names of a case start with
    ``R_<id>_``, so comparing the ids with that underscore gives listing order.
    """
    cases = (
        _case_totals(objects)
        .groupBy("ras_id")
        .agg(
            F.sum("num_files").alias("num_files"),
            F.sum("total_bytes").alias("total_bytes"),
            F.array_join(F.array_sort(F.collect_list("extension")), ", ").alias("file_types"),
        )
    )
    listing_order = F.concat("ras_id", F.lit("_"))
    if top is not None:
        cases = cases.orderBy(F.desc("num_files"), listing_order).limit(top)
    return cases.select(
        "ras_id",
        "num_files",
        "total_bytes",
        format_size("total_bytes").alias("total_size"),
        "file_types",
    )


def case_file_types(objects: DataFrame, chunk_chars: int = 65_536) -> DataFrame:
    """(ras_id, chunk_no, text): the extensions of every case, joined by ", ", in chunks.

    The same text as ``file_types`` of ``case_coverage``, for cases of any number of
    extensions: places come from running totals over blocks of names that begin alike,
    so neither the extensions of a case nor their text meet in one value.
    """
    kinds = parse_paths(objects).where(F.col("ras_id").isNotNull()).select("ras_id", "extension").distinct()
    first_bytes = F.rpad(F.left(F.hex(F.col("extension").cast("binary")), F.lit(6)), 6, "0")
    separator = ", "
    placed = with_totals_before(
        kinds.withColumn("_head", F.conv(first_bytes, 16, 10).cast("bigint")),
        ["ras_id"],
        "_head",
        {
            "before": F.length("extension").cast("bigint") + len(separator),
            "place": F.lit(1).cast("bigint"),
        },
        ["extension"],
        block=1,
    )
    later = F.col("place") > 0
    own = F.when(later, F.concat(F.lit(separator), "extension")).otherwise(F.col("extension"))
    start = F.col("before") - F.when(later, len(separator)).otherwise(0)
    return cut_in_chunks(
        placed.select("ras_id", own.alias("own"), start.alias("start")), ["ras_id"], chunk_chars
    )


def files_per_case(objects: DataFrame) -> DataFrame:
    """One row: least, mean, upper median and most files of a case."""
    cases = (
        objects.select(case_id("name").alias("ras_id"))
        .where(F.col("ras_id").isNotNull())
        .groupBy("ras_id")
        .agg(F.count("*").alias("n"))
    )
    return cases.agg(
        F.min("n").alias("min_files"),
        round1(F.avg("n")).alias("avg_files"),
        F.expr("percentile_disc(0.5) within group (order by n desc)")
        .cast("bigint")
        .alias("median_files"),
        F.max("n").alias("max_files"),
        F.count("*").alias("num_cases"),
    )


def sample_paths(objects: DataFrame, rows: int = SAMPLE_PATHS) -> DataFrame:
    """The first objects in listing order."""
    first = objects.orderBy("name").limit(rows)
    return first.select(
        F.col("name").alias("path"),
        format_size("size").alias("size"),
        extension_label("name").alias("extension"),
    )
