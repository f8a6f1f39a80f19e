"""Comparisons between an extracted document and database rows.

All of them are plain rules on two values. A missing value gives null ("not
checked"), never false.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attestry.functions.text import as_column, strip

# Tolerance of the price check, words that mark a useless item
# name, and the thresholds of the name comparison.
PRICE_TOLERANCE = 0.2
GARBAGE_WORDS = ("as per", "refer", "attached")
MINOR_RATIO = 1.5
SAME_DISTANCE = 10


def supplier_match(extracted: Column | str, stored: Column | str) -> Column:
    """Does one name contain the other, ignoring case?"""
    extracted, stored = as_column(extracted), as_column(stored)
    ours, theirs = F.lower(extracted), F.lower(stored)
    both = (extracted != "") & (stored != "")
    return F.when(both, F.contains(theirs, ours) | F.contains(ours, theirs))


def usable_price(price: Column | str) -> Column:
    """The price as a number, null where it is missing, zero, not a number or infinite."""
    value = as_column(price).try_cast("double")
    # NaN ranks above every number.
    return F.when((value != 0) & (value > float("-inf")) & (value < float("inf")), value)


def price_in_range(extracted: Column | str, original: Column | str) -> Column:
    """Is the extracted price less than a fifth away from the original price?"""
    extracted, original = usable_price(extracted), usable_price(original)
    usable = extracted.isNotNull() & (original > 0)
    return F.when(usable, F.abs(extracted - original) / original < PRICE_TOLERANCE)


def name_length(name: Column | str) -> Column:
    return F.coalesce(F.length(as_column(name)), F.lit(0))


def has_digit(name: Column | str) -> Column:
    return F.coalesce(as_column(name).rlike("[0-9]"), F.lit(False))


def is_garbage(name: Column | str) -> Column:
    """Null, blank, or a name that only points elsewhere."""
    name = as_column(name)
    lowered = F.lower(name)
    verdict = strip(name) == ""
    for word in GARBAGE_WORDS:
        verdict = verdict | F.contains(lowered, F.lit(word))
    return F.coalesce(verdict, F.lit(True))


def is_better(
    our_length: Column, our_digit: Column, stored_length: Column, stored_garbage: Column
) -> Column:
    return ((our_length > stored_length) & our_digit) | stored_garbage


def improvement(our_length: Column, stored_length: Column, stored_garbage: Column) -> Column:
    """Grade of our name against the stored one; a missing name has length 0."""
    return (
        F.when(stored_garbage & (our_length > 0), "MAJOR")
        .when(our_length > stored_length * F.lit(MINOR_RATIO), "MINOR")
        .when(F.abs(our_length - stored_length) < SAME_DISTANCE, "SAME")
        .otherwise("UNCLEAR")
    )
