"""Table schemas and closed value sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

# The vocabulary of the documents and reports.
DOCUMENT_TYPES = (
    "Quotation",
    "MPBP",
    "BER",
    "SOW",
    "20K_Form",
    "E_Auction",
    "RFQ",
    "Email",
    "PO",
    "Invoice",
    "Catalog",
    "Other",
)
CONFIDENCES = ("high", "medium", "low")
CURRENCIES = ("INR", "USD", "EUR")
STATUSES = ("not_found", "unsupported", "success", "json_error", "error")
IMPROVEMENTS = ("MAJOR", "MINOR", "SAME", "UNCLEAR")
SIZE_BUCKETS = ("< 1 MB", "1-10 MB", "10-50 MB", "50-100 MB", "> 100 MB")

# Column names of the source tables and the names used here.
ATTACHMENT_COLUMNS = {
    "PURCHASE_ID": "ras_id",
    "PURCHASE_DTL_ID": "dtl_id",
    "ATTACHMENT_ID": "att_id",
    "FILES_NAME": "file_name",
    "FILE_LOCATION": "file_location",
    "ATT_TYPE": "att_type",
    "SUPPLIER_ID": "supplier_id",
    "UPLOADED_ON": "uploaded_on",
}
ITEM_COLUMNS = {
    "PURCHASE_REQ_ID": "ras_id",
    "Item_Name": "item_name",
    "Purchase_Category": "category",
    "Sub_Category_Type": "sub_category",
    "Supplier": "supplier",
    "Original_Item_Value_INR": "original_inr",
    "Negotiated_Item_Value_INR": "negotiated_inr",
}


def _struct(*members: tuple[str, T.DataType]) -> T.StructType:
    """A schema from groups of names that share a type."""
    return T.StructType(
        [T.StructField(name, kind) for names, kind in members for name in names.split()]
    )


ATTACHMENT = _struct(
    ("ras_id dtl_id att_id", T.LongType()),
    ("file_name file_location att_type", T.StringType()),
    ("supplier_id", T.LongType()),
    ("uploaded_on", T.TimestampNTZType()),
)
ITEM = _struct(
    ("ras_id", T.LongType()),
    ("item_name category sub_category supplier", T.StringType()),
    ("original_inr negotiated_inr", T.DoubleType()),
)
OBJECT_INVENTORY = _struct(
    ("name", T.StringType()),
    ("size", T.LongType()),
)
# The last two columns order the rows of a case; both are null for files found by prefix.
MANIFEST = _struct(
    ("ras_id", T.LongType()),
    ("file_name att_type", T.StringType()),
    ("supplier_id", T.LongType()),
    ("local_path blob_path", T.StringType()),
    ("size_bytes att_id", T.LongType()),
    ("uploaded_on", T.TimestampNTZType()),
)
UNRESOLVED = _struct(
    ("ras_id att_id", T.LongType()),
    ("file_name blob_path reason", T.StringType()),
)
SHEET_ROW = _struct(
    ("file", T.StringType()),
    ("sheet_no", T.IntegerType()),
    ("sheet", T.StringType()),
    ("row_no", T.IntegerType()),
    ("row_text", T.StringType()),
)
# What stored files are made of: page images and chunks of text.
CONTENT_PIECE = _struct(
    ("blob_path", T.StringType()),
    ("piece_no", T.LongType()),
    ("content", T.BinaryType()),
    ("text", T.StringType()),
)
# A manifest row on its way through the model, and what came back. The manifest
# columns travel along, so nothing has to be joined to a response later.
REQUEST_KEYS = _struct(
    ("request_id", T.StringType()),
    ("ras_id", T.LongType()),
    ("file_name ext route att_type", T.StringType()),
    ("found", T.BooleanType()),
    ("supplier_id", T.LongType()),
    ("blob_path", T.StringType()),
    ("att_id", T.LongType()),
    ("uploaded_on", T.TimestampNTZType()),
)
RESPONSE = T.StructType(
    [
        *REQUEST_KEYS.fields,
        *_struct(
            ("prompt_version raw error", T.StringType()),
            ("attempts call_no max_tokens", T.IntegerType()),
            ("outcome", T.StringType()),
        ).fields,
    ]
)

DOCUMENT_CLASSIFICATION = _struct(
    ("verified_type confidence att_type_from_db", T.StringType()),
    ("att_type_matches_content", T.BooleanType()),
    ("classification_reason", T.StringType()),
)
QUOTATION_DATA = _struct(
    ("supplier_name canonical_item_name item_model", T.StringType()),
    ("technical_specifications", T.MapType(T.StringType(), T.StringType())),
    ("quoted_price", T.DoubleType()),
    ("currency", T.StringType()),
    ("unit_price", T.DoubleType()),
    ("quantity payment_terms delivery_terms warranty validity", T.StringType()),
    ("quotation_date quotation_reference", T.StringType()),
)
ADDITIONAL_ITEMS = T.ArrayType(_struct(
    ("item_name price specs", T.StringType()),
))
DOC_META = _struct(
    ("ras_id file_name file_extension att_type_from_db", T.StringType()),
    ("supplier_id_from_db", T.LongType()),
    ("extraction_timestamp", T.TimestampType()),
)
# What a model is asked to return.
ANSWER = (
    T.StructType()
    .add("document_classification", DOCUMENT_CLASSIFICATION)
    .add("is_quotation", T.BooleanType())
    .add("quotation_data", QUOTATION_DATA)
    .add("additional_items", ADDITIONAL_ITEMS)
    .add("raw_summary", T.StringType())
)
# An answer together with where it came from.
DOC = T.StructType(list(ANSWER.fields)).add("meta", DOC_META).add("json_file", T.StringType())

EXTRACTION_RESULT = _struct(
    ("ras_id", T.LongType()),
    ("file_name ext status verified_type att_type_from_db", T.StringType()),
    ("att_type_matches is_quotation", T.BooleanType()),
    ("canonical_item_name", T.StringType()),
    ("quoted_price", T.DoubleType()),
    ("supplier_name error", T.StringType()),
)


def members(schema: T.StructType, names: Sequence[str]) -> T.StructType:
    """The part of a schema that ``names`` ask for, in its order; ``a.b`` asks for one member of ``a``."""
    kept = []
    for field in schema.fields:
        inner = [n.partition(".")[2] for n in names if n.partition(".")[0] == field.name]
        if inner:
            part = field.dataType if "" in inner else members(field.dataType, inner)
            kept.append(T.StructField(field.name, part, field.nullable))
    unknown = {n.partition(".")[0] for n in names} - set(schema.names)
    if unknown:
        raise ValueError(f"no such members: {', '.join(sorted(unknown))}")
    return T.StructType(kept)
