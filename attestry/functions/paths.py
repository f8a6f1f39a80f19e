"""Expressions over object names and attachment locations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attestry.functions.text import as_column, strip

# How names carry a case id, and the label of a missing extension.
CASE_FOLDER = r"^R_(\d+)_\d{4}/"
CASE_PREFIX = r"^R_(\d+)_"
NO_EXTENSION = "(no extension)"

# The last dot of the last path part starts the extension, unless only dots precede it.
_SUFFIX = r"(?s)^\.*[^.].*(\.[^.]*)$"


def case_id(name: Column | str) -> Column:
    """Case id of an object stored under ``R_<id>_<year>/``, else null."""
    return F.nullif(F.regexp_extract(as_column(name), CASE_FOLDER, 1), F.lit(""))


def case_id_of_prefix(name: Column | str) -> Column:
    """Case id of any object whose name starts with ``R_<id>_``, else null."""
    return F.nullif(F.regexp_extract(as_column(name), CASE_PREFIX, 1), F.lit(""))


def base_name(name: Column | str) -> Column:
    return F.substring_index(as_column(name), "/", -1)


def extension(name: Column | str) -> Column:
    """Lower-cased extension with its dot; empty when there is none."""
    return F.lower(F.regexp_extract(base_name(name), _SUFFIX, 1))


def extension_label(name: Column | str) -> Column:
    ext = extension(name)
    return F.coalesce(F.nullif(ext, F.lit("")), F.lit(NO_EXTENSION))


def normalise_location(location: Column | str, container: str) -> Column:
    """Object name behind a stored location; null when the location is blank.

    Locations come with blanks around them, with a leading slash, with the
    container name in front, or with any mix of these.
    """
    stripped = F.nullif(strip(location), F.lit(""))
    return F.regexp_replace(stripped, rf"^/?(?:\Q{container}/\E)?", "")


def safe_name(file_name: Column | str) -> Column:
    """File name usable as one path part."""
    return F.translate(as_column(file_name), "/\\", "__")


def doc_key(ras_id: Column | str, file_name: Column | str) -> Column:
    """Key of a stored document; two files with one key replace each other."""
    return F.concat(
        F.lit("RAS_"), as_column(ras_id).cast("string"), F.lit("_"), safe_name(file_name)
    )


def local_path(ras_id: Column | str, file_name: Column | str) -> Column:
    return F.concat(
        F.lit("RAS_"), as_column(ras_id).cast("string"), F.lit("/"), as_column(file_name)
    )
