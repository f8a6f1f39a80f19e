"""Which way a file goes, by its extension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attestry.functions.text import as_column

# Extensions of every route, and the media types of images.
PDF_EXTENSIONS = (".pdf",)
EXCEL_EXTENSIONS = (".xlsx", ".xls")
IMAGE_EXTENSIONS = (".png", ".jpg", ".jpeg", ".tiff", ".bmp")
UNCONVERTED_EXTENSIONS = (".doc", ".ppt", ".pptx", ".msg")
MEDIA_TYPES = {
    ".png": "image/png",
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".tiff": "image/tiff",
    ".bmp": "image/bmp",
}
DEFAULT_MEDIA_TYPE = "image/png"


def route(ext: Column | str) -> Column:
    """``pdf``, ``excel``, ``image`` or ``unsupported``."""
    ext = as_column(ext)
    return (
        F.when(ext.isin(*PDF_EXTENSIONS), "pdf")
        .when(ext.isin(*EXCEL_EXTENSIONS), "excel")
        .when(ext.isin(*IMAGE_EXTENSIONS), "image")
        .otherwise("unsupported")
    )


def unsupported_reason(ext: Column | str) -> Column:
    """Why a file is not routed: a known type without a converter, or an unknown one."""
    ext = as_column(ext)
    return F.when(ext.isin(*UNCONVERTED_EXTENSIONS), "known_unconverted").when(
        route(ext) == "unsupported", "unknown"
    )


def media_type(ext: Column | str) -> Column:
    ext = as_column(ext)
    label = F.when(F.lit(False), DEFAULT_MEDIA_TYPE)
    for suffix, media in MEDIA_TYPES.items():
        label = label.when(ext == suffix, media)
    return label.otherwise(DEFAULT_MEDIA_TYPE)
