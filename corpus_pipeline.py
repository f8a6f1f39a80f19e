"""A training corpus from raw documents: known language, no near copies, mixed, tokenised.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. It is written and
read back as the next stage's documents, so every stage works on all that its
predecessor kept. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.llm import bpe, jaccard_join, language, mixing
from attestry.llm.common import stored, table
from attestry.llm.queries import MIX, vocabulary


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in which no language is recognised: no letters, or nothing shared.

    Every row is judged by itself and passes through whole, whatever its id; its text goes
    to the judge and back once.
    """
    profiles = language.learn_profiles(docs.where(~language.held_out("doc_id")))
    others = F.struct(*(c for c in docs.columns if c != "text"))
    judged = language.predict(
        docs.select(others.alias("_row"), "text"), profiles, key="_row", with_text=True
    )
    kept = judged.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") > 0))
    return kept.select(*("text" if c == "text" else f"_row.{c}" for c in docs.columns))


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id (null last).

    Of rows with that id in the group, the one with the smallest digest of its text
    stays, and of equal rows one. Rows that share an id but belong to no group stay.
    """
    found = jaccard_join.rooted(docs, "doc_id", "text", n=5, percent=80)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("digest"))
    chosen = found.where("root is not null").groupBy("root").agg(F.min(order).alias("_first"))
    def row(doc_id, digest):
        return F.concat_ws("/", F.hex(digest), F.coalesce(doc_id.cast("string"), F.lit("none")))

    kept = chosen.select(row(F.col("_first.doc_id"), F.col("_first.digest")).alias("_row"))
    own = jaccard_join.text_digest("text")
    marked = docs.withColumns({"_own": own, "_row": row(F.col("doc_id"), own)})
    grouped = marked.join(kept, "_row").dropDuplicates(["_row"])
    # Without words a text is in no group; the rows of such texts all stay.
    bare = found.where("root is null").select(F.col("digest").alias("_digest")).distinct()
    alone = marked.join(bare, marked["_own"] == bare["_digest"], "left_semi")
    return grouped.select(*docs.columns).unionByName(alone.select(*docs.columns))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated by source until the mix has its target weights; none is left out."""
    return mixing.realise(docs, mixing.mix(docs, MIX))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document's text, with digests of the ids and of what they decode to."""
    return bpe.encode_decode(
        docs,
        *vocabulary(),
        outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"),
        remember=0.25,  # the executors still hold what earlier stages left
    )


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard_join", no_near_copies),
    ("mix_sources", mixed),
    ("byte_bpe", tokenised),
]

# The language profiles, the exponent of the mix and the tokens are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


def queries() -> dict:
    return {"pipeline": run}
