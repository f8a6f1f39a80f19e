"""The end-to-end jobs: pure functions from tables to tables.

A job runs queries only where it stores what several of its tables need, or model
responses, which cannot be had again alike.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.operators import calls, extract, inventory, resolve, sampling, validate
from attestry.operators.calls import ClientFactory, ContentStore
from attestry.operators.extract import ExtractOptions
from attestry.operators.storage import stored

# Columns of an attachment, its object name among them, that the manifest is made of.
MANIFEST_SOURCE = (
    "ras_id", "att_id", "file_name", "att_type", "supplier_id", "uploaded_on", "blob_path"
)

select_cases = sampling.select_cases
summarise_extraction = extract.summarise_extraction


def profile_inventory(objects: DataFrame) -> dict[str, DataFrame]:
    """Six tables on file types, sizes and files per case."""
    return {
        "summary": inventory.inventory_summary(objects),
        "file_types": inventory.file_types(objects),
        "size_distribution": inventory.size_distribution(objects),
        "case_coverage": inventory.case_coverage(objects),
        "files_per_case": inventory.files_per_case(objects),
        "sample_paths": inventory.sample_paths(objects),
    }


def build_manifest(
    attachments: DataFrame, objects: DataFrame, cases: DataFrame, container: str
) -> tuple[DataFrame, DataFrame]:
    """``(manifest, unresolved)`` of the given cases.

    A case is searched by prefix only when none of its attachments led to an object.
    Attachments meet objects once; direct rows, cases without a hit and reasons all
    come from that stored table, so the objects are read twice at most.
    """
    # Only what the two tables hold travels to the cases and on to the objects.
    needed = resolve.normalise_locations(attachments, container).select(*MANIFEST_SOURCE)
    wanted = sampling.attachments_of_cases(needed, cases)
    located = stored(resolve.with_objects(wanted, objects), "located")
    direct = resolve.direct_rows(located)
    fallback = resolve.resolve_fallback(cases, direct, objects)
    return direct.unionByName(fallback), resolve.unresolved_rows(located)


def attach_contents(manifest: DataFrame, contents: DataFrame) -> DataFrame:
    """Add ``found``, ``pages`` and ``text`` from a table ``(blob_path, pages, text)``.

    For small batches: content travels with the manifest from here on. For many or
    large files store it once (``calls.store_contents``) and use ``extract_stored``.
    """
    marked = contents.select("blob_path", "pages", "text", F.lit(True).alias("_present"))
    joined = manifest.join(marked, "blob_path", "left")
    return joined.withColumn("found", F.col("_present").isNotNull()).drop("_present")


def extract_documents(
    inputs: DataFrame,
    client_factory: ClientFactory,
    responses_path: str,
    options: ExtractOptions = ExtractOptions(),
    extracted_at: Column | datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(documents, results)`` for manifest rows with ``pages`` and ``text``.

    Runs the model on every file without a stored response, stores what it says
    at ``responses_path`` and derives both tables from there.
    """
    routed = extract.route_files(inputs)
    requests = extract.build_requests(routed, options)
    responses = extract.store_responses(requests, responses_path, client_factory, options)
    outcomes = extract.with_skipped(responses, routed)
    documents = extract.extracted_documents(responses, extracted_at)
    return documents, extract.extraction_results(outcomes)


def extract_stored(
    manifest: DataFrame,
    store: ContentStore,
    client_factory: ClientFactory,
    responses_path: str,
    options: ExtractOptions = ExtractOptions(),
    extracted_at: Column | datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(documents, results)`` for manifest rows whose contents lie in ``store``.

    Contents are read late, where they are stored: no exchange carries them, and all
    waves together read them once. A file is found if it has a piece there.
    """
    present = store.files(manifest.sparkSession).select("blob_path", F.lit(True).alias("_present"))
    marked = manifest.join(present, "blob_path", "left")
    marked = marked.withColumn("found", F.col("_present").isNotNull()).drop("_present")
    routed = extract.route_files(marked)
    requests = extract.plan_requests(routed, options)
    responses = calls.ask_stored(requests, store, responses_path, client_factory, options)
    outcomes = extract.with_skipped(responses, routed)
    documents = extract.extracted_documents(responses, extracted_at)
    return documents, extract.extraction_results(outcomes)


def validate_documents(docs: DataFrame, items: DataFrame) -> dict[str, DataFrame]:
    """The three reports on documents, one row per document, their totals and examples.

    Documents and the items of their cases are stored once; every report reads these.
    """
    docs = stored(docs, "documents")
    kept = stored(validate.rows_of_documents(items, docs), "items")
    labels = validate.doc_classification(docs)
    return {
        "doc_classification": labels,
        "price_validation": validate.price_check(docs, kept),
        "item_name_quality": validate.name_quality(docs, kept),
        "classification_counts": validate.classification_counts(labels),
        "document_checks": validate.document_checks(docs, kept),
        "price_summary": validate.price_summary(docs, kept),
        "name_summary": validate.name_summary(docs, kept),
        "mismatch_examples": validate.mismatch_examples(labels),
        "improvement_examples": validate.improvement_examples(docs, kept),
    }
