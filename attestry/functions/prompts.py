"""Prompts and messages for the extraction model.

A template is data: pass another one to ask differently. Its version travels
with every request, so stored responses can be told apart.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestry.functions.text import as_column, shorten
from attestry.schemas import ANSWER, CONFIDENCES, CURRENCIES, DOCUMENT_TYPES

# Fixed value of the message format.
IMAGE_DETAIL = "high"

PARTS = "array<struct<type:string,text:string,url:string,detail:string>>"

_SLOT = re.compile(r"\{(file_name|att_type)\}")

_NOTES = {
    "verified_type": "one of " + ", ".join(DOCUMENT_TYPES),
    "confidence": " / ".join(CONFIDENCES),
    "currency": " / ".join(CURRENCIES),
    "att_type_from_db": "the stored label given above, unchanged",
    "att_type_matches_content": "does the stored label fit the content?",
    "classification_reason": "short justification",
    "canonical_item_name": "full item name with brand, model and leading specification",
    "technical_specifications": "name and value of every stated specification",
    "quoted_price": "total offered, digits only",
    "unit_price": "price of one unit, if stated apart from the total",
    "additional_items": "every further item",
    "raw_summary": "what the document says, in two or three sentences",
}


def _outline(schema: T.DataType, depth: int = 0) -> str:
    """The expected answer, one line per field, written from its schema."""
    if isinstance(schema, T.ArrayType):
        return _outline(schema.elementType, depth)
    lines = []
    for member in schema.fields:
        kind = member.dataType
        nested = kind.elementType if isinstance(kind, T.ArrayType) else kind
        label = "list of objects" if isinstance(kind, T.ArrayType) else kind.simpleString()
        if isinstance(nested, T.StructType):
            label = label if isinstance(kind, T.ArrayType) else "object"
        note = f" - {_NOTES[member.name]}" if member.name in _NOTES else ""
        lines.append(f"{'  ' * depth}{member.name}: {label}{note}")
        if isinstance(nested, T.StructType):
            lines.append(_outline(nested, depth + 1))
    return "\n".join(lines)


@dataclass(frozen=True)
class PromptTemplate:
    """System text plus a user text with ``{file_name}`` and ``{att_type}`` slots."""

    version: str
    system: str
    user: str
    text_header: str = "\n\nContent of the file:\n"

    def pieces(self) -> list[str]:
        """Literal pieces and slot names in turn, starting with a literal."""
        return _SLOT.split(self.user)


DEFAULT_TEMPLATE = PromptTemplate(
    version="1",
    system=(
        "You read purchasing documents and report what they contain. Answer with a single"
        " JSON object and nothing around it. Use null for whatever the document does not say."
    ),
    user=(
        "File: {file_name}\n"
        "Stored label, possibly wrong: {att_type}\n\n"
        "Decide what kind of document this is and fill in these fields:\n\n"
        + _outline(ANSWER)
        + "\n\nFor anything but a quotation, is_quotation is false and every field of"
        " quotation_data is null. With several items, the main one goes to quotation_data"
        " and the others to additional_items."
    ),
)


def render_prompt(
    template: PromptTemplate, file_name: Column | str, att_type: Column | str
) -> Column:
    """User text for one file; a missing label reads ``unknown``."""
    values = {
        "file_name": as_column(file_name),
        "att_type": F.coalesce(as_column(att_type), F.lit("unknown")),
    }
    pieces = template.pieces()
    columns = [F.lit(piece) for piece in pieces]
    columns[1::2] = [values[slot] for slot in pieces[1::2]]
    return F.concat(*columns)


def with_document_text(
    template: PromptTemplate, prompt: Column, text: Column | str, limit: int | None = None
) -> Column:
    """Prompt followed by the whole text of the document, or by its first ``limit`` characters."""
    return F.concat(prompt, F.lit(template.text_header), shorten(text, limit))


def base64_text(content: Column | str) -> Column:
    """Base64 on one line (``base64`` breaks its output into lines)."""
    return F.translate(F.base64(as_column(content)), "\r\n", "")


def data_url(media_type: Column | str, content: Column | str) -> Column:
    media = as_column(media_type)
    return F.concat(F.lit("data:"), media, F.lit(";base64,"), base64_text(content))


def message_parts(
    prompt: Column | str,
    media_type: Column | str,
    pages: Column | str,
    max_pages: int | None = None,
) -> Column:
    """One text part, then one image part per page, up to ``max_pages`` if given."""
    media = as_column(media_type)
    nothing = F.lit(None).cast("string")

    def part(kind: str, text: Column, url: Column, detail: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("type"), text.alias("text"), url.alias("url"), detail.alias("detail")
        )

    shown = F.coalesce(as_column(pages), F.array().cast("array<binary>"))
    if max_pages is not None:
        shown = F.slice(shown, 1, max_pages)
    images = F.transform(
        shown,
        lambda page: part("image_url", nothing, data_url(media, page), F.lit(IMAGE_DETAIL)),
    )
    opening = F.array(part("text", as_column(prompt), nothing, nothing))
    return F.concat(opening.cast(PARTS), images.cast(PARTS))
