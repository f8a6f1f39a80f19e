"""Model calls: what is asked next, how an answer ends, and calls over stored contents.

A call ends in one of three outcomes. ``finished`` counts as the answer. ``cut`` holds
the beginning of an answer that met its bound; the request is asked again with
twice the bound, up to a limit, and a cut answer never counts as one. ``failed``
holds the reason; the request is asked again by the next run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attestry.functions.prompts import IMAGE_DETAIL
from attestry.operators.sheets import PART_SEPARATOR
from attestry.schemas import CONTENT_PIECE, REQUEST_KEYS, RESPONSE

FINISHED, CUT, FAILED = "finished", "cut", "failed"

# A response answers one version of the prompt.
ASKED = ("request_id", "prompt_version")
# A piece of a sheet is numbered by sheet and chunk.
CHUNKS_PER_SHEET = 2**32
# Requests to stored contents: the keys, and what the message is made of.
MESSAGE = ("prompt_version", "system", "prompt", "media_type")


class Reply(NamedTuple):
    """What a client may return instead of a plain text: the text, and whether it was cut."""

    text: str
    cut: bool = False


# A client has one method:
#     complete(system, parts, temperature, max_tokens) -> str | Reply
# A factory makes one; it is sent to the executors, so it must be picklable.
ClientFactory = Callable[[], object]


def asker(client_factory: ClientFactory, options):
    """A function to be built once per task: ``ask(system, parts, bound)``.

    It makes one client, keeps the least time between two calls, repeats failed
    calls up to ``max_attempts`` and cut ones up to ``token_limit``, and returns
    (outcome, text, error, attempts, bound of the last call).
    """
    temperature, limit = options.temperature, options.token_limit
    interval, allowed = options.interval(), max(1, options.max_attempts)

    def build():
        import time

        client, due = None, 0.0

        def ask(system, parts, bound):
            nonlocal client, due
            attempts = failures = 0
            while True:
                attempts += 1
                time.sleep(max(0.0, due - time.monotonic()))
                try:
                    client = client_factory() if client is None else client
                    reply = client.complete(system, parts, temperature, bound)
                    text, cut = (reply, False) if isinstance(reply, str) else tuple(reply)
                    error = None
                except Exception as failure:  # noqa: BLE001 - kept as the outcome of the row
                    text, cut, error = None, False, str(failure) or type(failure).__name__
                due = time.monotonic() + interval
                if error is not None:
                    failures += 1
                    if failures < allowed:
                        continue
                    return "failed", None, error, attempts, bound
                if not cut:
                    return "finished", text, None, attempts, bound
                if bound >= limit:
                    return "cut", text, None, attempts, bound
                bound = min(2 * bound, limit)

        return ask

    return build


def outcome_of(answers: DataFrame) -> Column:
    """The outcome of a stored call; a table from before outcomes were stored has text or none."""
    told = F.col("outcome") if "outcome" in answers.columns else F.lit(None).cast("string")
    return F.coalesce(told, F.when(F.col("raw").isNotNull(), FINISHED).otherwise(FAILED))


def open_calls(requests: DataFrame, answers: DataFrame, options) -> DataFrame:
    """Requests to be asked, with ``call_no`` and ``max_tokens``.

    Those without a finished answer to this version of the prompt, unless their
    last one was cut at the limit. Only keys of the answers are read.
    """
    outcome = outcome_of(answers)
    known = (
        answers.select(*ASKED, "call_no", "max_tokens", outcome.alias("outcome"))
        .groupBy(*ASKED)
        .agg(
            F.coalesce(F.max("call_no"), F.count("*").cast("int")).alias("_calls"),
            F.bool_or(F.col("outcome") == FINISHED).alias("_done"),
            F.max(F.when(F.col("outcome") == CUT, F.col("max_tokens"))).alias("_bound"),
        )
    )
    again = F.when(
        F.col("_bound").isNotNull(), F.least(F.col("_bound") * 2, F.lit(options.token_limit))
    )
    return (
        requests.join(known, list(ASKED), "left")
        .where(~F.coalesce("_done", F.lit(False)))
        .where(F.col("_bound").isNull() | (F.col("_bound") < options.token_limit))
        .withColumn("call_no", (F.coalesce("_calls", F.lit(0)) + 1).cast("int"))
        .withColumn("max_tokens", F.coalesce(again, F.lit(options.max_tokens)).cast("int"))
        .drop("_calls", "_done", "_bound")
    )


def last_answers(answers: DataFrame) -> DataFrame:
    """One call per request: the last finished one, else the last one there is."""
    ranked = answers.withColumn("outcome", outcome_of(answers)).withColumn(
        "call_no", F.coalesce("call_no", F.lit(0))
    )
    order = Window.partitionBy(*ASKED).orderBy(
        (F.col("outcome") == FINISHED).desc(),
        F.desc("call_no"),
        (F.col("outcome") == CUT).desc(),
        F.desc("attempts"),
        "raw",
        "error",
    )
    return (
        ranked.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")
    )


# ---- calls over stored contents ----


@dataclass(frozen=True)
class ContentStore:
    """A table of content pieces, parted into ``slots`` and bucketed by object name."""

    table: str
    buckets: int
    slots: int

    def pieces(self, spark: SparkSession, slots: list[int] | None = None) -> DataFrame:
        rows = spark.table(self.table)
        return rows if slots is None else rows.where(F.col("slot").isin(slots))

    def files(self, spark: SparkSession) -> DataFrame:
        """(blob_path, num_pieces, num_bytes), without an exchange: a file lies in one bucket."""
        size = F.coalesce(F.octet_length("content"), F.octet_length("text"), F.lit(0))
        return (
            self.pieces(spark)
            .groupBy("blob_path")
            .agg(F.count("*").alias("num_pieces"), F.sum(size.cast("bigint")).alias("num_bytes"))
        )


def slot_of(blob_path: Column | str, slots: int) -> Column:
    path = F.col(blob_path) if isinstance(blob_path, str) else blob_path
    return F.pmod(F.xxhash64(path), F.lit(slots)).cast("int")


def store_contents(
    pieces: DataFrame, table: str, path: str, buckets: int | None = None, slots: int = 16
) -> ContentStore:
    """Write ``(blob_path, piece_no, content, text)`` so that it never has to move again.

    The one shuffle of content in its life: a bucket holds all pieces of its
    objects in order. Buckets default to the number of shuffle partitions.
    """
    spark = pieces.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = pieces.select(*CONTENT_PIECE.names, slot_of("blob_path", slots).alias("slot"))
    (
        placed.repartition(buckets, "blob_path")
        .write.mode("overwrite")
        .format("parquet")
        .partitionBy("slot")
        .bucketBy(buckets, "blob_path")
        .sortBy("blob_path", "piece_no")
        .option("path", path)
        .saveAsTable(table)
    )
    return ContentStore(table, buckets, slots)


def open_contents(spark: SparkSession, store: ContentStore, path: str) -> ContentStore:
    """Name a table written by ``store_contents`` in a session that does not know it yet."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CONTENT_PIECE.fields)
    spark.sql(
        f"create table if not exists {store.table} ({columns}, slot int) using parquet"
        f" partitioned by (slot) clustered by (blob_path) sorted by (blob_path, piece_no)"
        f" into {store.buckets} buckets location '{path}'"
    )
    spark.sql(f"msck repair table {store.table}")
    return store


def calls_of_wave(
    requests: DataFrame, answers: DataFrame, store: ContentStore, slots: list[int], options
) -> DataFrame:
    """Open requests of some slots with their pieces, in order, where the pieces lie.

    Only keys and prompts are shuffled: the pending side goes to the buckets of the
    contents. Pieces of a request come one after the other.
    """
    pending = open_calls(requests.where(F.col("slot").isin(slots)).drop("slot"), answers, options)
    pieces = store.pieces(requests.sparkSession, slots).drop("slot")
    return (
        pending.hint("shuffle_hash")
        .join(pieces, "blob_path")
        .sortWithinPartitions(*ASKED, "piece_no")
    )


def ask_stored(
    requests: DataFrame,
    store: ContentStore,
    path: str,
    client_factory: ClientFactory,
    options,
) -> DataFrame:
    """Ask every open request about its stored contents; one response for each request.

    ``requests`` are rows without content: the request keys, ``prompt_version``,
    ``system``, ``prompt`` and ``media_type`` (null where the pieces are text). They are
    written once, by slot; a wave plans from its own slots, reads its own part of
    the contents and appends its responses, so all waves together read contents once.
    """
    spark = requests.sparkSession
    planned = f"{path.rstrip('/')}_requests/{uuid.uuid4().hex}"
    narrow = requests.select(*REQUEST_KEYS.names, *MESSAGE)
    narrow.withColumn("slot", slot_of("blob_path", store.slots)).write.partitionBy("slot").parquet(
        planned
    )
    known = spark.read.parquet(planned)
    spark.createDataFrame([], RESPONSE).write.mode("ignore").parquet(path)
    waves = max(1, min(options.waves, store.slots))
    for wave in range(waves):
        slots = list(range(wave, store.slots, waves))
        answers = spark.read.schema(RESPONSE).parquet(path)
        met = calls_of_wave(known, answers, store, slots, options)
        made = met.mapInArrow(_calling(client_factory, options), RESPONSE)
        made.write.mode("append").parquet(path)
    answers = spark.read.schema(RESPONSE).parquet(path)
    of_batch = answers.join(known.select(*ASKED).distinct(), list(ASKED), "left_semi")
    return last_answers(of_batch).select(*RESPONSE.names)


def _calling(client_factory: ClientFactory, options):
    """Pieces in, responses out: one request is held at a time."""
    build = asker(client_factory, options)
    keys, names = list(REQUEST_KEYS.names), list(RESPONSE.names)
    most_pages, most_chars = options.max_pages, options.max_text_chars
    header, detail, separator = options.template.text_header, IMAGE_DETAIL, PART_SEPARATOR
    per_sheet = CHUNKS_PER_SHEET

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64

        ask, request, pieces = build(), None, []

        def answer():
            texts = [(n, t) for n, _, t in pieces if t is not None]
            prompt = request["prompt"]
            if texts:
                parts = []
                for n, text in texts:
                    if parts and n % per_sheet == 0:
                        parts.append(separator)
                    parts.append(text)
                whole = "".join(parts)
                prompt += header + (whole if most_chars is None else whole[:most_chars])
            nothing = {"url": None, "detail": None}
            parts = [{"type": "text", "text": prompt, **nothing}]
            for _, content, _ in [p for p in pieces if p[1] is not None][:most_pages]:
                url = f"data:{request['media_type']};base64,{base64.b64encode(content).decode()}"
                parts.append({"type": "image_url", "text": None, "url": url, "detail": detail})
            outcome, raw, error, attempts, bound = ask(
                request["system"], parts, request["max_tokens"]
            )
            row = {name: request[name] for name in (*keys, "prompt_version", "call_no")}
            row |= {"raw": raw, "error": error, "attempts": attempts}
            return row | {"max_tokens": bound, "outcome": outcome}

        def made(rows, schema):
            columns = [
                pa.array([r[n] for r in rows], schema.field(n).type if n in known else None)
                for n in names
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        schema, known = None, ()
        fixed = {
            "raw": pa.string(), "error": pa.string(), "outcome": pa.string(),
            "attempts": pa.int32(), "max_tokens": pa.int32(),
        }
        for batch in batches:
            if schema is None:
                kept = [batch.schema.field(n) for n in (*keys, "prompt_version", "call_no")]
                schema = pa.schema([*kept, *(pa.field(n, t) for n, t in fixed.items())])
                known = tuple(schema.names)
            rows = []
            for row in batch.to_pylist():
                same = request is not None and (row["request_id"], row["prompt_version"]) == (
                    request["request_id"],
                    request["prompt_version"],
                )
                if not same:
                    if request is not None:
                        rows.append(answer())
                    request, pieces = row, []
                pieces.append((row["piece_no"], row["content"], row["text"]))
            if rows:
                yield made(rows, schema)
        if request is not None:
            yield made([answer()], schema)

    return call
