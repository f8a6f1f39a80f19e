"""What stored files are made of: pieces for calls, and whole values where one is needed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestry.operators.calls import CHUNKS_PER_SHEET
from attestry.operators.sheets import CHUNK_CHARS, sheet_chunks, workbook_text
from attestry.schemas import CONTENT_PIECE


def _pieces(rows: DataFrame) -> DataFrame:
    return rows.select(
        *(
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in CONTENT_PIECE.fields
        )
    )


def page_pieces(pages: DataFrame) -> DataFrame:
    """One piece per page image, from ``(blob_path, page_no, content)``."""
    return _pieces(pages.withColumnRenamed("page_no", "piece_no"))


def image_pieces(objects: DataFrame) -> DataFrame:
    """Image files as they are, from ``(name, content)``."""
    named = objects.withColumnRenamed("name", "blob_path")
    return _pieces(named.withColumn("piece_no", F.lit(0)))


def workbook_pieces(sheet_rows: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One piece per chunk of a sheet, from rows whose ``file`` is the object name."""
    chunks = sheet_chunks(sheet_rows, chunk_chars=chunk_chars)
    number = F.col("sheet_no").cast("bigint") * CHUNKS_PER_SHEET + F.col("chunk_no")
    return _pieces(chunks.withColumnRenamed("file", "blob_path").withColumn("piece_no", number))


def page_contents(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """All page images of a file in one row, from ``(blob_path, page_no, content)``.

    For requests that carry their content; ``page_pieces`` has no such limit. With
    ``max_pages`` the first ones: that cap is applied on every map task before the
    shuffle, so later pages of a long file never travel.
    """
    first = pages.withColumn("_position", F.col("page_no"))
    if max_pages is not None:
        in_file = Window.partitionBy("blob_path").orderBy("page_no")
        first = pages.withColumn("_position", F.row_number().over(in_file)).where(
            F.col("_position") <= max_pages
        )
    ordered = F.array_sort(F.collect_list(F.struct("_position", "content")))
    return first.groupBy("blob_path").agg(
        F.transform(ordered, lambda page: page["content"]).alias("pages"),
        F.lit(None).cast("string").alias("text"),
    )


def workbook_contents(sheet_rows: DataFrame, max_chars: int | None = None) -> DataFrame:
    """The text of every workbook in one row, from rows whose ``file`` is the object name."""
    return workbook_text(sheet_chunks(sheet_rows), max_chars).select(
        F.col("file").alias("blob_path"), F.lit(None).cast("array<binary>").alias("pages"), "text"
    )


def image_contents(objects: DataFrame) -> DataFrame:
    """Image files as they are, from ``(name, content)``."""
    return objects.select(
        F.col("name").alias("blob_path"),
        F.array("content").alias("pages"),
        F.lit(None).cast("string").alias("text"),
    )
