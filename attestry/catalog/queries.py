"""The registered queries: every operator over the derived tables, as a whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.catalog import fixtures as fx
from attestry.functions import amounts, checks, prompts, responses, routing
from attestry.operators import calls, extract, inventory, resolve, sampling, sheets, validate
from attestry.operators.storage import shared_dir, stored
from attestry.plans import jobs
from attestry.schemas import ATTACHMENT_COLUMNS
from attestry.session import configure
from attestry.sources import files, objects, tables, writers

Query = Callable[[SparkSession, str], DataFrame]


# ---- shared inputs ----


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    return sampling.select_cases(fx.located(spark, d), fx.as_of(spark, d))


def _sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.pick_sample(_candidates(spark, d))


def _all_cases(spark: SparkSession, d: str) -> DataFrame:
    return fx.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("ras_id")).distinct()


def _routed(spark: SparkSession, d: str) -> DataFrame:
    """Named attachments with their route; every file counts as present."""
    named = fx.located(spark, d).where(F.col("file_name").isNotNull())
    return extract.route_files(named.withColumn("blob_path", F.col("path")))


def _responses(spark: SparkSession, d: str) -> DataFrame:
    """An answer for every named attachment, routed; every file counts as present."""
    return extract.route_files(fx.responses(spark, d))


def _documents(spark: SparkSession, d: str, columns: Sequence[str] | None = None) -> DataFrame:
    return extract.extracted_documents(_responses(spark, d), columns=columns)


def _results(spark: SparkSession, d: str) -> DataFrame:
    """Results with the files missing from the inventory among them."""
    marked = resolve.mark_missing(fx.responses(spark, d), fx.objects(spark, d))
    return extract.extraction_results(extract.route_files(marked))


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    return responses.parse_responses(_responses(spark, d))


# ---- inventory ----


def top_file_types(spark: SparkSession, d: str) -> DataFrame:
    return inventory.top_file_types(fx.objects(spark, d))


def format_size(spark: SparkSession, d: str) -> DataFrame:
    return fx.objects(spark, d).select(
        "name",
        "size",
        amounts.format_size("size").alias("size_text"),
        amounts.size_bucket("size").alias("bucket"),
    )


# ---- cases and resolution ----


def case_items(spark: SparkSession, d: str) -> DataFrame:
    return sampling.items_of_cases(fx.items(spark, d), _candidates(spark, d))


def doc_case_items(spark: SparkSession, d: str) -> DataFrame:
    return validate.rows_of_documents(fx.items(spark, d), _documents(spark, d))


def case_attachments(spark: SparkSession, d: str) -> DataFrame:
    rows = sampling.attachments_of_cases(fx.located(spark, d), _candidates(spark, d))
    columns = (
        "ras_id dtl_id att_id file_name file_location att_type supplier_id uploaded_on".split()
    )
    return rows.select(*columns).orderBy(*sampling.ATTACHMENT_ORDER)


def doc_case_attachments(spark: SparkSession, d: str) -> DataFrame:
    rows = validate.rows_of_documents(fx.located(spark, d), _documents(spark, d))
    return rows.select("ras_id", "att_id", "file_name", "att_type", "supplier_id")


def normalise_location(spark: SparkSession, d: str) -> DataFrame:
    rows = resolve.normalise_locations(fx.located(spark, d), fx.CONTAINER)
    return rows.select("att_id", "file_location", "blob_path")


def _direct(spark: SparkSession, d: str) -> DataFrame:
    return resolve.resolve_direct(fx.located(spark, d), fx.objects(spark, d), fx.CONTAINER)


def resolve_fallback(spark: SparkSession, d: str) -> DataFrame:
    return resolve.resolve_fallback(
        _all_cases(spark, d), _direct(spark, d), fx.objects(spark, d)
    )


def manifest(spark: SparkSession, d: str) -> DataFrame:
    rows, _ = jobs.build_manifest(
        fx.located(spark, d), fx.objects(spark, d), _all_cases(spark, d), fx.CONTAINER
    )
    return rows


def sample_manifest(spark: SparkSession, d: str) -> DataFrame:
    rows, _ = jobs.build_manifest(
        fx.located(spark, d), fx.objects(spark, d), _sample(spark, d), fx.CONTAINER
    )
    return rows


def unresolved(spark: SparkSession, d: str) -> DataFrame:
    return resolve.unresolved(fx.located(spark, d), fx.objects(spark, d), fx.CONTAINER)


def missing_files(spark: SparkSession, d: str) -> DataFrame:
    rows = resolve.normalise_locations(fx.located(spark, d), fx.CONTAINER)
    wanted = rows.where(F.col("blob_path").isNotNull())
    marked = resolve.mark_missing(wanted, fx.objects(spark, d))
    return marked.select("ras_id", "att_id", "blob_path", "found")


# Small pieces, so that most pages have several.
PIECE_BYTES = 1_000


def read_contents(spark: SparkSession, d: str) -> DataFrame:
    """Sizes and digests of a manifest of pages, by pieces: every third page was never stored."""
    pages = fx.table(spark, d, "pages")
    name = F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".html"))
    contents = pages.where("page_id % 3 <> 0").select(
        name.alias("blob_path"), F.encode("html", "utf-8").alias("content")
    )
    known = objects.piece_summary(objects.cut_pieces(contents, piece_bytes=PIECE_BYTES))
    marked = resolve.mark_missing(
        pages.select(name.alias("blob_path")), known.select(F.col("blob_path").alias("name"))
    )
    return marked.join(known.drop("found"), "blob_path", "left")


def piece_plan(spark: SparkSession, d: str) -> DataFrame:
    """Byte ranges of every file of the manifest, 64 MiB each."""
    located = resolve.locate(fx.located(spark, d), fx.objects(spark, d), fx.CONTAINER)
    sizes = resolve.direct_rows(located).select("blob_path", "size_bytes").distinct()
    return objects.plan_pieces(sizes, piece_bytes=64 * 2**20)


# ---- routing, prompts, requests ----


def route(spark: SparkSession, d: str) -> DataFrame:
    return _routed(spark, d).select("att_id", "file_name", "ext", "route", "reason")


def media_type(spark: SparkSession, d: str) -> DataFrame:
    routed = _routed(spark, d)
    return routed.select("att_id", "ext", routing.media_type("ext").alias("media_type"))


def render_prompt(spark: SparkSession, d: str) -> DataFrame:
    """The prompt of every routed file, and of every document as workbook text."""
    template = prompts.DEFAULT_TEMPLATE
    files = (
        _routed(spark, d)
        .where(F.col("route") != "unsupported")
        .select(
            F.concat(F.lit("att:"), F.col("att_id").cast("string")).alias("source"),
            prompts.render_prompt(template, "file_name", "att_type").alias("prompt"),
        )
    )
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".xlsx"))
    bare = prompts.render_prompt(template, name, F.lit(None).cast("string"))
    documents = fx.table(spark, d, "documents").select(
        F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("source"),
        prompts.with_document_text(template, bare, "text").alias("prompt"),
    )
    return files.unionByName(documents).select(
        "source",
        F.lit(template.version).alias("prompt_version"),
        F.length("prompt").cast("bigint").alias("prompt_chars"),
        F.md5("prompt").alias("prompt_md5"),
    )


def _sheet_rows(spark: SparkSession, d: str) -> DataFrame:
    """One workbook per language, one sheet per source, one row per document."""
    return fx.table(spark, d, "documents").select(
        F.coalesce("lang", F.lit("none")).alias("file"),
        (F.substring("source", 4, 10).cast("int") + 1).alias("sheet_no"),
        F.col("source").alias("sheet"),
        F.col("doc_id").alias("row_no"),
        sheets.bound_cell("text").alias("row_text"),
    )


# Small chunks, so that most sheets have several.
CHUNK_CHARS = 4_096
CELL_CHUNK_CHARS = 256
MAX_CELL_CHARS = 50


def sheet_text(spark: SparkSession, d: str) -> DataFrame:
    return sheets.sheet_chunks(_sheet_rows(spark, d), chunk_chars=CHUNK_CHARS)


def row_text(spark: SparkSession, d: str) -> DataFrame:
    return sheets.row_texts(fx.cells(spark, d), MAX_CELL_CHARS)


def cell_text(spark: SparkSession, d: str) -> DataFrame:
    return sheets.sheet_chunks(row_text(spark, d), chunk_chars=CELL_CHUNK_CHARS)


def message_parts(spark: SparkSession, d: str) -> DataFrame:
    """Message parts of image and PDF files; the name stands in for page bytes."""
    routed = _routed(spark, d).where(F.col("route").isin("pdf", "image"))
    page = F.to_binary(F.col("path"), F.lit("utf-8"))
    pages = F.when(F.col("route") == "image", F.array(page)).otherwise(
        F.array_repeat(page, (F.col("rn") % 8).cast("int"))
    )
    inputs = routed.withColumn("pages", pages).withColumn("text", F.lit(None).cast("string"))
    requests = extract.build_requests(inputs)
    parts = requests.select("request_id", F.posexplode("parts").alias("part_no", "part"))
    return parts.select(
        "request_id",
        "part_no",
        F.col("part.type").alias("type"),
        F.length("part.text").alias("text_chars"),
        F.col("part.url").alias("url"),
        F.col("part.detail").alias("detail"),
    )


# ---- responses ----

TERMS = (
    "quantity",
    "payment_terms",
    "delivery_terms",
    "warranty",
    "validity",
    "quotation_date",
    "quotation_reference",
)


def clean_response(spark: SparkSession, d: str) -> DataFrame:
    return _responses(spark, d).select(
        "request_id", responses.clean_response("raw").alias("cleaned")
    )


def parse_status(spark: SparkSession, d: str) -> DataFrame:
    return _parsed(spark, d).select("request_id", "status", "error")


def typed_fields(spark: SparkSession, d: str) -> DataFrame:
    rows = _parsed(spark, d).where(F.col("status") == "success")
    return responses.with_typed_answer(rows).select(
        "request_id",
        F.col("document_classification.verified_type").alias("verified_type"),
        F.col("document_classification.confidence").alias("confidence"),
        F.col("document_classification.att_type_matches_content").alias("matches"),
        "is_quotation",
        F.col("quotation_data.supplier_name").alias("supplier_name"),
        F.col("quotation_data.canonical_item_name").alias("canonical_item_name"),
        F.col("quotation_data.quoted_price").alias("quoted_price"),
        F.col("quotation_data.currency").alias("currency"),
        F.col("document_classification.classification_reason").alias("reason"),
        F.col("document_classification.att_type_from_db").alias("said_type"),
        F.col("quotation_data.unit_price").alias("unit_price"),
        F.col("quotation_data.item_model").alias("item_model"),
        F.col("quotation_data.technical_specifications")["power"].alias("power"),
        F.col("quotation_data.technical_specifications")["weight"].alias("weight"),
        F.concat_ws("; ", *(F.col(f"quotation_data.{c}") for c in TERMS)).alias("terms"),
        F.size("additional_items").alias("num_additional"),
        F.get("additional_items", F.lit(0))["item_name"].alias("additional_name"),
        F.get("additional_items", F.lit(0))["price"].alias("additional_price"),
        "raw_summary",
    )


def latest_docs(spark: SparkSession, d: str) -> DataFrame:
    """Of the answers stored under one key, the last one."""
    answers = _parsed(spark, d).where(F.col("status") == "success")
    kind = responses.answer_field("answer", "document_classification.verified_type")
    return extract.latest_per_key(extract.with_json_file(answers)).select(
        "json_file", "att_id", "uploaded_on", kind.alias("verified_type")
    )


def documents(spark: SparkSession, d: str) -> DataFrame:
    return _summary_columns(_documents(spark, d))


def _summary_columns(docs: DataFrame) -> DataFrame:
    return docs.select(
        "json_file",
        F.col("meta.ras_id").alias("ras_id"),
        F.col("meta.file_name").alias("file_name"),
        F.col("meta.file_extension").alias("file_extension"),
        F.col("meta.att_type_from_db").alias("att_type_from_db"),
        F.col("meta.supplier_id_from_db").alias("supplier_id_from_db"),
        "is_quotation",
        F.col("quotation_data.canonical_item_name").alias("canonical_item_name"),
        F.col("quotation_data.quoted_price").alias("quoted_price"),
    )


def document_lines(spark: SparkSession, d: str) -> DataFrame:
    docs, _ = files.parse_documents(fx.document_lines(spark, d))
    offer = F.col("quotation_data")
    return docs.select(
        "json_file",
        "is_quotation",
        offer["supplier_name"].alias("supplier_name"),
        offer["quoted_price"].alias("quoted_price"),
        offer["currency"].alias("currency"),
        offer["technical_specifications"]["k"].alias("k"),
        "raw_summary",
        F.col("meta.ras_id").alias("ras_id"),
        F.col("meta.supplier_id_from_db").alias("supplier_id"),
    )


def rejected_lines(spark: SparkSession, d: str) -> DataFrame:
    return files.parse_documents(fx.document_lines(spark, d))[1]


# ---- calls ----


def last_answers(spark: SparkSession, d: str) -> DataFrame:
    """Of all calls about a file, the one that counts."""
    return calls.last_answers(fx.calls(spark, d)).select(
        "request_id", "call_no", "max_tokens", "outcome", F.md5("raw").alias("raw_md5"), "error"
    )


def open_calls(spark: SparkSession, d: str) -> DataFrame:
    """What is asked next: never asked, failed, or cut below the limit of 8,000 tokens."""
    options = extract.ExtractOptions(token_limit=8_000)
    requests = extract.plan_requests(_routed(spark, d), options)
    asked = calls.open_calls(requests, fx.calls(spark, d), options)
    return asked.select("request_id", "call_no", "max_tokens")


def results_of_calls(spark: SparkSession, d: str) -> DataFrame:
    """Results where some calls failed, were cut or never made."""
    last = calls.last_answers(fx.calls(spark, d)).select("request_id", "raw", "error", "outcome")
    routed = _responses(spark, d).drop("raw", "error")
    return extract.extraction_results(routed.join(last, "request_id", "left"))


# ---- tables handed from one step to the next ----


def _path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def manifest_csv(spark: SparkSession, d: str) -> DataFrame:
    """The manifest written as CSV and read back."""
    path = _path(spark, "manifest")
    writers.write_table(manifest(spark, d), path, "csv", compression="gzip")
    return files.read_manifest(spark, path, "csv")


def documents_json(spark: SparkSession, d: str) -> DataFrame:
    """The documents written as JSON lines and read back."""
    path = _path(spark, "documents")
    writers.write_documents(_documents(spark, d), path, "json", compression="gzip")
    docs, _ = files.read_document_lines(spark, path)
    return _summary_columns(docs)


def upserted_documents(spark: SparkSession, d: str) -> DataFrame:
    """Two runs over one keyed table: the second one replaces and adds what it has."""
    path = _path(spark, "keyed")
    docs = stored(_documents(spark, d), "documents")
    first = docs.where("meta.supplier_id_from_db % 2 = 0").withColumn("raw_summary", F.lit("first"))
    second = docs.where("cast(meta.ras_id as bigint) % 3 = 0")
    writers.upsert_documents(first, path)
    writers.upsert_documents(second.withColumn("raw_summary", F.lit("second")), path)
    return files.read_documents(spark, path).select("json_file", "raw_summary")


def source_names(spark: SparkSession, d: str) -> DataFrame:
    """Attachments under the names and types of a source, taken over."""
    theirs = fx.located(spark, d).select(
        *(
            F.col(ours).cast("timestamp" if ours == "uploaded_on" else "string").alias(name)
            for name, ours in ATTACHMENT_COLUMNS.items()
        ),
        F.lit("x").alias("OTHER"),
    )
    return tables.attachments_from(theirs)


# ---- validation ----


def _report(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, d: build(_documents(spark, d), fx.items(spark, d))


def _stored_report(
    build: Callable[[DataFrame, DataFrame], DataFrame],
    members: Sequence[str],
    columns: Sequence[str],
) -> Query:
    """For reports that look at both sides many times: these are worked out once.

    ``members`` of the documents and ``columns`` of the items are all that the report reads.
    """

    def query(spark: SparkSession, d: str) -> DataFrame:
        docs = stored(_documents(spark, d, members), "documents")
        return build(docs, stored(fx.items(spark, d).select(*columns), "items"))

    return query


def doc_classification(spark: SparkSession, d: str) -> DataFrame:
    return validate.doc_classification(_documents(spark, d))


def supplier_match_values(spark: SparkSession, d: str) -> DataFrame:
    return validate.supplier_pairs(_documents(spark, d), fx.items(spark, d))


def item_name_features(spark: SparkSession, d: str) -> DataFrame:
    return fx.items(spark, d).select(
        "ras_id",
        "item_name",
        checks.name_length("item_name").alias("db_name_length"),
        checks.has_digit("item_name").alias("db_has_specs"),
        checks.is_garbage("item_name").alias("db_is_garbage"),
    )


def _over_objects(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: build(fx.objects(spark, d))


_QUERIES: dict[str, Query] = {
    "q01_inventory_summary": _over_objects(inventory.inventory_summary),
    "q02_file_type_stats": _over_objects(inventory.file_types),
    "q02b_top_file_types": top_file_types,
    "q03_size_buckets": _over_objects(inventory.size_distribution),
    "q04_case_coverage": _over_objects(inventory.case_coverage),
    "q04b_largest_cases": _over_objects(
        lambda objects: inventory.case_coverage(objects, inventory.TOP_CASES)
    ),
    "q04c_case_file_types": _over_objects(
        lambda objects: inventory.case_file_types(objects, chunk_chars=16)
    ),
    "q05_files_per_case_stats": _over_objects(inventory.files_per_case),
    "q06_sample_paths": _over_objects(inventory.sample_paths),
    "q07_path_parse": _over_objects(inventory.parse_paths),
    "q08_format_size": format_size,
    "q09_select_cases": _candidates,
    "q09b_pick_sample": _sample,
    "q10_case_items": case_items,
    "q10b_doc_case_items": doc_case_items,
    "q11_case_attachments": case_attachments,
    "q11b_doc_case_attachments": doc_case_attachments,
    "q12_normalise_location": normalise_location,
    "q13_resolve_direct": _direct,
    "q14_resolve_fallback": resolve_fallback,
    "q15_manifest": manifest,
    "q15b_sample_manifest": sample_manifest,
    "q15c_unresolved": unresolved,
    "q16_missing_files": missing_files,
    "q16b_read_contents": read_contents,
    "q16c_piece_plan": piece_plan,
    "q17_route": route,
    "q18_media_type": media_type,
    "q19_render_prompt": render_prompt,
    "q20_sheet_text": sheet_text,
    "q20b_sheet_sizes": lambda s, d: sheets.sheet_sizes(_sheet_rows(s, d)),
    "q20c_row_text": row_text,
    "q20d_cell_text": cell_text,
    "q21b_message_parts": message_parts,
    "q22_clean_response": clean_response,
    "q23_parse_status": parse_status,
    "q24_typed_fields": typed_fields,
    "q25_latest_docs": latest_docs,
    "q25b_documents": documents,
    "q25c_last_answers": last_answers,
    "q25d_open_calls": open_calls,
    "q25e_document_lines": document_lines,
    "q25f_rejected_lines": rejected_lines,
    "q26_extraction_results": _results,
    "q26b_results_of_calls": results_of_calls,
    "q27_extraction_summary": lambda s, d: extract.summarise_extraction(_results(s, d)),
    "q28_doc_classification": doc_classification,
    "q29_classification_counts": lambda s, d: validate.classification_counts(
        doc_classification(s, d)
    ),
    "q30_supplier_match": supplier_match_values,
    "q30b_supplier_links": _stored_report(
        validate.supplier_links, validate.LINK_MEMBERS, validate.LINK_COLUMNS
    ),
    "q31_price_check": _report(validate.price_check),
    "q32_price_summary": _stored_report(
        validate.price_summary, validate.SUMMARY_MEMBERS, validate.SUMMARY_COLUMNS
    ),
    "q32b_document_checks": _stored_report(
        validate.document_checks, validate.CHECK_MEMBERS, validate.CHECK_COLUMNS
    ),
    "q33_name_quality": _report(validate.name_quality),
    "q33b_item_name_features": item_name_features,
    "q34_name_summary": _report(validate.name_summary),
    "q35_mismatch_examples": lambda s, d: validate.mismatch_examples(doc_classification(s, d)),
    "q35b_improvement_examples": _report(validate.improvement_examples),
    "q36_manifest_csv": manifest_csv,
    "q36b_documents_json": documents_json,
    "q36c_upserted_documents": upserted_documents,
    "q36d_source_names": source_names,
}


def _configured(query: Query, numbered: bool) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        with fx.numbered(numbered):
            return query(configure(spark), d)

    return run


def queries() -> dict[str, Query]:
    return {name: _configured(query, name in fx.NUMBERED) for name, query in _QUERIES.items()}
