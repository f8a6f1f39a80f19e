"""Registered queries of the subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.llm import (
    bpe,
    chat,
    collocations,
    edit_embedding,
    hard_negatives,
    jaccard_join,
    language,
    mixing,
    near_vectors,
    sharding,
    suffix_dedup,
    unigram,
    urls,
)
from attestry.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 16
# The rules of the query, as given.
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
PROBE = "</s>[INST] ok [/INST]"
# Shares at 97 % of the largest entropy, no source passed through more than twice.
MIX = mixing.Target(entropy=0.97, repeats=2.0)
RANKS = "byte_bpe_50k.tiktoken"


def vocabulary(name: str = RANKS) -> tuple[str, str]:
    """Path of a public vocabulary file, and the pattern that goes with it."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(PROBE).alias("text"),
    )
    made = chat.format_conversations(given.unionByName(probe))
    read = made.select(
        "conv_id",
        "formatted",
        chat.parse(F.col("formatted")).alias("turns"),
        chat.masked(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), MIX)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.count_tokens(table(spark, sf_dir, "documents"), *vocabulary())


def op8_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_embedding.edit_probe(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(
        table(spark, sf_dir, "documents"),
        *vocabulary(),
        outputs=("n_tokens", "ids_sha256", "decoded_sha256"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    given = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives.mine(given)


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


_QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join,
        op2_embedding_near_dedup,
        op3_url_filter,
        op4_sharding,
        op5_chat_formatting,
        op6_mix_sources,
        op7_token_counts,
        op8_edit_fingerprints,
        op9_language_id,
        op10_byte_bpe,
        op11_hard_negatives,
        op12_suffix_dedup,
        op13_collocations,
    )
}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# A conversation is escaped if a text or a name holds a control string or an escape.
_OP5 = r"""
with given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked as (
  select *,
    regexp_matches(text, '\[/?INST\]|</?s>|<</?SYS>>|<<ROLE |<</ROLE>>|>>|\\[lgocb]') as odd,
    regexp_replace(regexp_replace(regexp_replace(replace(text, '\', '\b'),
      '\[(/?INST\])', '\\o\1', 'g'),
      '<(<ROLE |</ROLE>>|</?SYS>>|/?s>)', '\\l\1', 'g'),
      '>(>)', '\\g\1', 'g') as escaped,
    case role when 'user' then 13 when 'assistant' then 7 when 'system' then 15 end as marks
  from given
), level as (
  select *, bool_or(odd) over (partition by conv_id) as escape from marked
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), ''))
    as loss_sha256,
  cast(sum(marks + length(case when escape then escaped else text end)) as bigint) as formatted_chars
from level group by conv_id
"""


_OP11 = """
with given as (
  select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
    list_inner_product(a.q, b.q)::bigint as score
  from given a join given b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0
), positive as (
  select anchor_id, other_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
), negative as (
  select p.*, s.other_id as negative_id, s.score as negative_score,
    row_number() over (partition by anchor_id, positive_id order by s.score desc, s.other_id) as rank
  from positive p join scored s using (anchor_id)
  where not s.same and 30 * positive_score <= 100 * s.score and 100 * s.score <= 90 * positive_score
)
select anchor_id, positive_id, rank::integer as rank, negative_id, positive_score, negative_score
from negative where rank <= 10
"""

_OP12 = """
with given as (
  select doc_id, hex(encode(coalesce(text, ''))) as h from documents
), doc as (
  select *, length(h) // 2 as n, row_number() over (order by doc_id nulls last, sha256(unhex(h))) as d from given
), parts as (
  select d, 1000 * b as since, substr(h, 2000 * b + 1, 2198) as part
  from (select d, h, unnest(range((n + 900) // 1000)) as b from doc where n >= 100)
), strings as (
  select d, since + j as i, substr(part, 2 * j + 1, 200) as string
  from (select *, unnest(range(least(1000, length(part) // 2 - 99))) as j from parts)
), repeated as (
  select d, i from (
    select d, i, row_number() over (partition by string order by d, i) as k from strings
  ) where k > 1
), marked as (
  select *, case when i - lag(i) over (partition by d order by i) <= 100 then 0 else 1 end as opens from repeated
), runs as (
  select d, i, sum(opens) over (partition by d order by i) as run from marked
), spans as (
  select d, run, min(i) as start, max(i) + 100 as stop from runs group by d, run
), gaps as (
  select d, start, stop, coalesce(lag(stop) over (partition by d order by start), 0) as since from spans
), kept as (
  select d, sum(stop - start) as n_removed, count(*) as n_spans, max(stop) as last,
    string_agg(substr(any_h, 2 * since + 1, 2 * (start - since)), '' order by start) as head
  from (select g.*, doc.h as any_h from gaps g join doc using (d)) group by d
)
select doc_id, n::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
  coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from doc left join kept using (d)
"""
_OP13 = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) as piece
  from documents where text is not null
), words as (
  select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') as w from pieces
), starts as (
  select lang, w, unnest(range(1, len(w) + 1)) as i from words
), counted as (
  select lang, k, array_to_string(w[i : i + k - 1], ' ') as phrase, count(*) as f
  from starts, (values (1), (2), (3), (4)) as sizes(k) where i + k - 1 <= len(w) group by all
), candidate as (
  select *, string_split(phrase, ' ') as w from counted where k >= 2 and f >= 30
), cuts as (
  select c.lang, c.phrase, c.f as a, x.f as l, y.f as r, cut, (2000000::hugeint * c.f) // (x.f + y.f) as score
  from (select *, unnest(range(1, k)) as cut from candidate) as c
  join counted x on x.lang = c.lang and x.phrase = array_to_string(c.w[1 : cut], ' ')
  join counted y on y.lang = c.lang and y.phrase = array_to_string(c.w[cut + 1 : ], ' ')
  qualify row_number() over (partition by c.lang, c.phrase order by score, cut) = 1
), inside as (
  select lang, array_to_string(w[s : s + m - 1], ' ') as phrase, max(f) as longer
  from (select *, unnest(range(2, k)) as m from candidate) join (values (1), (2), (3)) as places(s) on s + m - 1 <= k
  group by all
), ranked as (
  select c.lang, row_number() over (partition by c.lang order by score desc, a desc, c.phrase) as rank,
    c.phrase, a, l, r, score
  from cuts c left join inside i on i.lang = c.lang and i.phrase = c.phrase
  where longer is null or 100 * longer < 80 * a
), total as (
  select lang, sum(f)::bigint as n from counted where k = 1 group by lang
)
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join total using (lang) where rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_chat_formatting": _OP5,
        "op11_hard_negatives": _OP11,
        "op12_suffix_dedup": _OP12,
        "op13_collocations": _OP13,
    }
