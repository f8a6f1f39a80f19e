"""Inventory, extraction and validation of business documents on Spark."""

from attestry.operators.calls import ContentStore, Reply, open_contents, store_contents
from attestry.operators.extract import ExtractOptions
from attestry.plans.jobs import (
    attach_contents,
    build_manifest,
    extract_documents,
    extract_stored,
    profile_inventory,
    select_cases,
    summarise_extraction,
    validate_documents,
)
from attestry.session import configure, local_session

__all__ = [
    "ContentStore",
    "ExtractOptions",
    "Reply",
    "attach_contents",
    "build_manifest",
    "configure",
    "extract_documents",
    "extract_stored",
    "local_session",
    "open_contents",
    "profile_inventory",
    "select_cases",
    "store_contents",
    "summarise_extraction",
    "validate_documents",
]
