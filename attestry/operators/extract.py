"""Batch inference over a manifest, and what becomes of its answers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestry.functions.paths import doc_key, extension
from attestry.functions.prompts import (
    DEFAULT_TEMPLATE,
    PromptTemplate,
    message_parts,
    render_prompt,
    with_document_text,
)
from attestry.functions.responses import (
    SEALED,
    answer_field,
    judge_responses,
    parse_responses,
    price_field,
    typed_answer,
    with_prices,
)
from attestry.functions.responses import is_quotation as is_quotation_of
from attestry.functions.routing import media_type, route, unsupported_reason
from attestry.operators.calls import (
    ASKED,
    CUT,
    ClientFactory,
    asker,
    last_answers,
    open_calls,
)
from attestry.schemas import ANSWER, DOC, EXTRACTION_RESULT, REQUEST_KEYS, RESPONSE, members

# How the model is called, and the least time between two calls.
TEMPERATURE = 0.1
MAX_TOKENS = 3000
MIN_INTERVAL_S = 2.0

# A cut answer is asked again with twice the bound, up to this many tokens.
TOKEN_LIMIT = 8 * MAX_TOKENS


@dataclass(frozen=True)
class ExtractOptions:
    """How requests are built and sent.

    ``partitions`` is the number of calls in flight, so ``partitions`` divided
    by ``min_interval_s`` bounds the request rate; with ``calls_per_second`` the
    interval follows from that rate and ``partitions``. ``waves`` cuts the work into
    parts whose responses are stored one after the other; a job that dies loses
    one wave at most. Pages and text are sent whole unless bounds are set. Answers
    that ``max_tokens`` cuts are asked again with twice the bound, up to
    ``token_limit``.
    """

    template: PromptTemplate = DEFAULT_TEMPLATE
    temperature: float = TEMPERATURE
    max_tokens: int = MAX_TOKENS
    token_limit: int = TOKEN_LIMIT
    calls_per_second: float | None = None
    min_interval_s: float = MIN_INTERVAL_S
    max_attempts: int = 1
    max_pages: int | None = None
    max_text_chars: int | None = None
    partitions: int | None = None
    waves: int = 4

    def interval(self) -> float:
        """Least seconds between two calls of one task."""
        if self.calls_per_second is None:
            return self.min_interval_s
        if not self.partitions:
            raise ValueError("a rate needs the number of partitions that share it")
        return self.partitions / self.calls_per_second


def request_id(att_id: Column | str = "att_id", blob_path: Column | str = "blob_path") -> Column:
    """Key of a manifest row: the attachment id, or the object for files found by prefix."""
    att = F.col(att_id) if isinstance(att_id, str) else att_id
    path = F.col(blob_path) if isinstance(blob_path, str) else blob_path
    return F.coalesce(att.cast("string"), path)


def route_files(manifest: DataFrame) -> DataFrame:
    """Add ``ext``, ``route``, ``reason`` and ``request_id`` to manifest rows.

    ``found`` marks rows whose object exists; without that column all do.
    """
    routed = manifest.withColumn("ext", extension("file_name")).withColumns(
        {
            "route": route("ext"),
            "reason": unsupported_reason("ext"),
            "request_id": request_id(),
        }
    )
    return routed if "found" in manifest.columns else routed.withColumn("found", F.lit(True))


def build_requests(inputs: DataFrame, options: ExtractOptions = ExtractOptions()) -> DataFrame:
    """One request per file that exists and can be read.

    ``inputs`` are routed manifest rows with ``pages`` (array<binary>: page
    images, or the image itself) and ``text`` (workbook text). Rows are filtered
    first, so no message is built for a file that is not sent.
    """
    sendable = inputs.where(is_sent())
    template = options.template
    prompt = render_prompt(template, "file_name", "att_type")
    excel = F.col("route") == "excel"
    text = F.coalesce("text", F.lit(""))
    shown = F.when(excel, with_document_text(template, prompt, text, options.max_text_chars))
    media = F.when(F.col("route") == "image", media_type("ext")).otherwise("image/png")
    return (
        sendable.withColumn("prompt", shown.otherwise(prompt))
        .withColumn("media_type", media)
        .withColumn("pages", F.when(~excel, F.col("pages")))
        .select(
            *REQUEST_KEYS.names,
            F.lit(template.version).alias("prompt_version"),
            F.lit(template.system).alias("system"),
            message_parts("prompt", "media_type", "pages", options.max_pages).alias("parts"),
        )
    )


def plan_requests(routed: DataFrame, options: ExtractOptions = ExtractOptions()) -> DataFrame:
    """One request per file that exists and can be read, without its content.

    The message is the prompt; pages or text are added where the call is made
    (``calls.ask_stored``).
    """
    template = options.template
    media = F.when(F.col("route") == "image", media_type("ext")).otherwise("image/png")
    return routed.where(is_sent()).select(
        *REQUEST_KEYS.names,
        F.lit(template.version).alias("prompt_version"),
        F.lit(template.system).alias("system"),
        render_prompt(template, "file_name", "att_type").alias("prompt"),
        media.alias("media_type"),
    )


def call_model(
    requests: DataFrame, client_factory: ClientFactory, options: ExtractOptions = ExtractOptions()
) -> DataFrame:
    """Send every request; a failed call becomes a row with ``error``, not a failed job.

    Each partition makes one client and works through its rows in turn, batch by
    batch. Batches are bounded in bytes by Spark, since pages may be large.
    """
    build, names = asker(client_factory, options), list(RESPONSE.names)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = build()
        for batch in batches:
            carried = batch.drop_columns(["system", "parts", "call_no", "max_tokens"])
            answers = [
                ask(*(value.as_py() for value in row))
                for row in zip(*(batch.column(n) for n in ("system", "parts", "max_tokens")))
            ]
            outcomes, raws, errors, attempts, bounds = zip(*answers) if answers else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    *carried.columns,
                    pa.array(raws, pa.string()),
                    pa.array(errors, pa.string()),
                    pa.array(attempts, pa.int32()),
                    batch.column("call_no"),
                    pa.array(bounds, pa.int32()),
                    pa.array(outcomes, pa.string()),
                ],
                names,
            )

    if "call_no" not in requests.columns:
        requests = requests.withColumns(
            {"call_no": F.lit(1), "max_tokens": F.lit(options.max_tokens)}
        )
    sent = requests.select(
        *REQUEST_KEYS.names, "prompt_version", "system", "parts", "call_no", "max_tokens"
    )
    if options.partitions:
        sent = sent.repartition(options.partitions, "request_id")
    return sent.mapInArrow(send, RESPONSE)


def store_responses(
    requests: DataFrame,
    path: str,
    client_factory: ClientFactory,
    options: ExtractOptions = ExtractOptions(),
) -> DataFrame:
    """Call the model for all requests without a stored answer; return one response for each.

    Responses are costly and cannot be had again alike, so they are written
    before anything is derived from them. A second run sends only what has no finished
    answer to this version of the prompt yet, so failed and cut calls are made again.
    The table at ``path`` may serve other batches: only responses to ``requests`` are
    returned, for each the last finished answer, or the last call where there is none.

    The requests hold their content, which the join with open calls moves. For many
    or large files use ``calls.ask_stored``.
    """
    spark = requests.sparkSession
    spark.createDataFrame([], RESPONSE).write.mode("ignore").parquet(path)
    asked = requests.select(*ASKED).distinct()
    for wave in range(options.waves):
        answers = spark.read.schema(RESPONSE).parquet(path)
        slot = F.pmod(F.xxhash64("request_id"), F.lit(options.waves)) == wave
        pending = open_calls(asked.where(slot), answers, options)
        call_model(requests.join(pending, list(ASKED)), client_factory, options).write.mode(
            "append"
        ).parquet(path)
    kept = spark.read.schema(RESPONSE).parquet(path).join(asked, list(ASKED), "left_semi")
    return last_answers(kept).select(*RESPONSE.names)


def is_sent() -> Column:
    return F.col("found") & (F.col("route") != "unsupported")


def with_skipped(responses: DataFrame, routed: DataFrame) -> DataFrame:
    """Responses together with the routed rows that were never sent."""
    skipped = routed.where(~is_sent()).select(*REQUEST_KEYS.names)
    return responses.unionByName(skipped, allowMissingColumns=True)


def _is_cut(responses: DataFrame) -> Column:
    """Whether the answer broke off; what is there of it never counts."""
    if "outcome" not in responses.columns:
        return F.lit(False)
    return F.coalesce(F.col("outcome") == CUT, F.lit(False))


def extraction_results(outcomes: DataFrame) -> DataFrame:
    """One row per manifest row: what happened to it, and the leading fields.

    ``outcomes`` are routed rows with ``raw`` and ``error``. Fields that do not
    belong to a status are null, so rows of all statuses share one schema. An
    answer that was cut is a ``json_error``, whatever its beginning looks like.
    """
    parsed = (
        outcomes.withColumn("_cut", _is_cut(outcomes))
        .withColumn("raw", F.when(is_sent() & ~F.col("_cut"), F.col("raw")))
        .transform(parse_responses, error="error")
        .withColumnsRenamed({"status": "_parsed", "error": "_error"})
    )
    status = (
        F.when(~F.col("found"), "not_found")
        .when(F.col("route") == "unsupported", "unsupported")
        .when(F.col("_cut"), "json_error")
        .otherwise(F.col("_parsed"))
    )
    ok = F.col("status") == "success"
    quoted = ok & is_quotation_of("answer")
    label = "document_classification"
    offer = "quotation_data"
    fields = {
        "ext": F.when(F.col("status").isin("success", "unsupported"), F.col("ext")),
        "verified_type": answer_field("answer", f"{label}.verified_type"),
        "att_type_from_db": F.when(ok, F.col("att_type")),
        "att_type_matches": answer_field("answer", f"{label}.att_type_matches_content", "boolean"),
        "is_quotation": F.when(ok, is_quotation_of("answer")),
        "canonical_item_name": F.when(
            quoted, answer_field("answer", f"{offer}.canonical_item_name")
        ),
        "quoted_price": F.when(quoted, price_field("answer", f"{offer}.quoted_price")),
        "supplier_name": F.when(quoted, answer_field("answer", f"{offer}.supplier_name")),
        "error": F.when(F.col("status") == "error", F.col("_error")),
    }
    return parsed.withColumn("status", status).withColumns(fields).select(*EXTRACTION_RESULT.names)


def extracted_documents(
    responses: DataFrame,
    extracted_at: Column | datetime | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Typed documents of all successful answers, one per stored key.

    Files of one case with the same safe name are stored under one key; the one
    handled last stays. ``columns`` names the members wanted, as ``json_file`` or
    ``meta.ras_id``; the rows are the same, and the other members are neither read nor moved.
    """
    if extracted_at is None:
        extracted_at = F.current_timestamp()
    elif not isinstance(extracted_at, Column):
        extracted_at = F.lit(extracted_at)
    schema = DOC if columns is None else members(DOC, columns)
    whole = responses.where(is_sent() & ~_is_cut(responses))
    answers = judge_responses(whole, error="error").where(F.col("status") == "success")
    found = {
        "ras_id": F.col("ras_id").cast("string"),
        "file_name": F.col("file_name"),
        "file_extension": F.col("ext"),
        "att_type_from_db": F.col("att_type"),
        "supplier_id_from_db": F.col("supplier_id").cast("bigint"),
        "extraction_timestamp": extracted_at.cast("timestamp"),
    }
    kinds = {field.name: field.dataType for field in schema.fields}
    answered = T.StructType([f for f in schema.fields if f.name in ANSWER.names])
    fields = typed_answer("sealed", answered, SEALED)
    keyed = with_json_file(answers)
    # A whole answer moves as it came and is typed once it is known to be the last one. Of
    # an answer of which little is wanted, only that moves.
    if columns is None:
        typed = latest_per_key(keyed).withColumns(fields)
    else:
        typed = latest_per_key(keyed.withColumns(fields))
    rows = with_prices(typed)
    if "meta" in kinds:
        meta = F.struct(*(found[name].alias(name) for name in kinds["meta"].names))
        rows = rows.withColumn("meta", meta)
    return rows.select(*schema.names)


def with_json_file(rows: DataFrame) -> DataFrame:
    """Add the key a document is stored under."""
    key = F.concat(doc_key("ras_id", "file_name"), F.lit(".json"))
    return rows.withColumn("json_file", key)


def latest_per_key(keyed: DataFrame) -> DataFrame:
    """Of the rows that share ``json_file``, the one handled last.

    Spark keeps only the first row of each key on every map task before the
    shuffle (a window group limit), so any number of copies sends one row each.
    """
    last_first = [F.desc(c) for c in ("uploaded_on", "att_id", "blob_path")]
    copies = Window.partitionBy("json_file").orderBy(*last_first)
    return (
        keyed.withColumn("_copy", F.row_number().over(copies))
        .where(F.col("_copy") == 1)
        .drop("_copy")
    )


def summarise_extraction(results: DataFrame) -> DataFrame:
    """One row: files, successes, quotations, label mismatches."""
    ok = F.col("status") == "success"
    return results.agg(
        F.count("*").alias("total"),
        F.count_if(ok).alias("success"),
        F.count_if(F.col("is_quotation")).alias("quotations"),
        F.count_if(ok & ~F.col("att_type_matches")).alias("att_type_mismatches"),
    )
