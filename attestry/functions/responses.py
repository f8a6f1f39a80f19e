"""From a model's raw answer to a typed value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestry.functions.text import as_column, strip
from attestry.schemas import ANSWER

# The code fences dropped around an answer, in this order.
OPENING_FENCES = ("```json", "```")
CLOSING_FENCE = "```"

NOT_AN_OBJECT = "not_an_object"
NO_RESPONSE = "no_response"

# Where a sealed parse holds the text's own value.
SEALED = "$[0]"


def clean_response(raw: Column | str) -> Column:
    """Strip white space and code fences.

    Each opening fence is dropped once and in turn, so a ``json`` fence followed
    by a plain one loses both, and an upper-case ``JSON`` tag stays.
    """
    text = _strip_answer(raw)
    tagged, plain = OPENING_FENCES
    opening = (
        F.when(text.startswith(tagged + plain), len(tagged + plain))
        .when(text.startswith(tagged), len(tagged))
        .when(text.startswith(plain), len(plain))
        .otherwise(0)
    )
    closed = text.endswith(CLOSING_FENCE) & (F.length(text) >= opening + len(CLOSING_FENCE))
    closing = F.when(closed, len(CLOSING_FENCE)).otherwise(0)
    return _strip_answer(F.substring(text, opening + 1, F.length(text) - opening - closing))


def _strip_answer(text: Column | str) -> Column:
    """As ``strip``, which walks the whole text; most answers end in a brace or a fence already."""
    text = as_column(text)
    starts = text.startswith("{") | text.startswith("`")
    ends = text.endswith("}") | text.endswith("`")
    return F.when(starts & ends, text).otherwise(strip(text))


def sealed_variant(text: Column | str) -> Column:
    """Parse ``[text, seal]``, where the seal is a hash of the text.

    The JSON reader stops after the first complete value and ignores the rest,
    so a bare parse takes ``{} and more`` for valid. With the seal behind it the
    text is one whole JSON value exactly when the seal comes out as element 1
    and nothing follows it; a text cannot contain its own hash.
    """
    text = as_column(text)
    seal = F.xxhash64(text).cast("string")
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), seal, F.lit("]")))


def seal_holds(sealed: Column | str, text: Column | str) -> Column:
    """True exactly when ``text`` is one valid JSON value; never null."""
    sealed = as_column(sealed)
    intact = F.try_variant_get(sealed, "$[1]", "bigint") == F.xxhash64(as_column(text))
    beyond = F.try_variant_get(sealed, "$[2]", "string").isNotNull()
    return F.coalesce(intact & ~beyond, F.lit(False))


def judge_responses(responses: DataFrame, raw: str = "raw", error: str | None = None) -> DataFrame:
    """Add ``status``, ``error`` and ``sealed`` to a table of raw responses.

    ``status`` is ``success`` (one JSON object), ``json_error`` (not JSON) or
    ``error`` (JSON of another kind, a failed call, or no response at all).
    ``sealed`` holds the object under ``SEALED`` where the status is ``success``.

    Whether the parse holds is bound by a one-element explode. As a plain column it would
    be copied into every filter on the outcome, and the parse with it. The cleaned text
    and the parse lie below, where no filter on the outcome gets.
    """
    failed_call = F.col(error) if error else F.lit(None).cast("string")
    text = F.col("_text")
    is_object = text.startswith("{")
    outcome = (
        F.when(failed_call.isNotNull(), "error")
        .when(text.isNull(), "error")
        .when(~F.col("_valid"), "json_error")
        .when(~is_object, "error")
        .otherwise("success")
    )
    reason = (
        F.when(failed_call.isNotNull(), failed_call)
        .when(text.isNull(), NO_RESPONSE)
        .when(F.col("_valid") & ~is_object, NOT_AN_OBJECT)
    )
    return (
        responses.withColumn("_text", clean_response(raw))
        .withColumn("sealed", sealed_variant(text))
        .withColumn("_valid", F.explode(F.array(seal_holds("sealed", text))))
        .withColumns({"status": outcome, "error": reason})
        .drop("_text", "_valid")
    )


def parse_responses(responses: DataFrame, raw: str = "raw", error: str | None = None) -> DataFrame:
    """``judge_responses`` with ``answer`` instead of ``sealed``.

    ``answer`` is the object as a variant, null unless successful.
    """
    answer = F.try_variant_get("sealed", SEALED, "variant")
    return (
        judge_responses(responses, raw, error)
        .withColumn("answer", F.when(F.col("status") == "success", answer))
        .drop("sealed")
    )


def answer_field(answer: Column | str, path: str, kind: str = "string") -> Column:
    """One typed field of an answer; null when absent or of another type."""
    return F.try_variant_get(as_column(answer), f"$.{path}", kind)


def is_quotation(answer: Column | str) -> Column:
    return F.coalesce(answer_field(answer, "is_quotation", "boolean"), F.lit(False))


def numeric_text(text: Column | str) -> Column:
    """Plain numeric text as a double; anything else is null."""
    text = strip(text)
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))


def price_field(answer: Column | str, path: str) -> Column:
    """A price given as a number or as plain numeric text; anything else is null."""
    return numeric_text(answer_field(answer, path))


def typed_answer(
    answer: Column | str, schema: T.StructType = ANSWER, root: str = "$"
) -> dict[str, Column]:
    """The fields of an answer by a schema, one column per top-level field.

    Objects are cast as a whole, which walks the variant once. A member of the
    wrong type becomes null and leaves the others alone. Prices are read as text
    first, since a price may come as numeric text. ``root`` is where the answer lies.
    """
    columns = {
        member.name: F.try_variant_get(
            as_column(answer), f"{root}.{member.name}", _lenient(member.dataType).simpleString()
        )
        for member in schema.fields
    }
    if "is_quotation" in columns:
        columns["is_quotation"] = F.coalesce(columns["is_quotation"], F.lit(False))
    return columns


def with_typed_answer(rows: DataFrame, answer: str = "answer") -> DataFrame:
    """Add the typed fields of ``answer`` as columns."""
    return with_prices(rows.withColumns(typed_answer(answer)))


def with_prices(typed: DataFrame) -> DataFrame:
    """The prices of ``quotation_data`` as numbers, as far as it has them."""
    if "quotation_data" not in typed.columns:
        return typed
    quotation = F.col("quotation_data")
    for price in ("quoted_price", "unit_price"):
        if price in typed.schema["quotation_data"].dataType.names:
            quotation = quotation.withField(price, numeric_text(f"quotation_data.{price}"))
    return typed.withColumn("quotation_data", quotation)


def _lenient(kind: T.DataType) -> T.DataType:
    """The type with its doubles read as text."""
    if not isinstance(kind, T.StructType):
        return kind
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.dataType == T.DoubleType() else f.dataType)
            for f in kind.fields
        ]
    )
