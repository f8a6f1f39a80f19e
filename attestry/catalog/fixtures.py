"""Procurement-shaped tables derived from the test tables.

``lineitem`` rows become attachments and items, ``part`` and ``supplier`` name
them, ``documents`` are objects outside any case. The rules spread nulls, name
collisions, odd locations and malformed answers over the rows by their keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.operators.numbering import number_within

CONTAINER = "box"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

# Row order within a case; the leading column also cuts very large cases.
CASE_ORDER = (
    "l_shipdate l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax"
    " l_returnflag l_linestatus"
).split()

# Queries over attachments numbered by their place in the case.
NUMBERED = frozenset(
    """
    q01_inventory_summary q02_file_type_stats q02b_top_file_types q03_size_buckets
    q04_case_coverage q04b_largest_cases q05_files_per_case_stats q06_sample_paths
    q07_path_parse q08_format_size q11_case_attachments q11b_doc_case_attachments
    q12_normalise_location q13_resolve_direct q14_resolve_fallback q15_manifest
    q15b_sample_manifest q15c_unresolved q16_missing_files q17_route q18_media_type
    q19_render_prompt q21b_message_parts q22_clean_response q23_parse_status
    q25_latest_docs q25b_documents q26_extraction_results q27_extraction_summary
    q31_price_check q32_price_summary
    """.split()
)

_NUMBERED: ContextVar[bool] = ContextVar("numbered", default=False)


@contextmanager
def numbered(on: bool) -> Iterator[None]:
    """Within it, attachments are numbered by their place in the case, if ``on``."""
    token = _NUMBERED.set(on)
    try:
        yield
    finally:
        _NUMBERED.reset(token)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of a small table dealt to all cores; a large one has parts enough and stays put."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores, *keys) if rows.rdd.getNumPartitions() < cores else rows


def as_of(spark: SparkSession, sf_dir: str) -> Column:
    """Time of the last upload, as a scalar subquery."""
    return table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate")).scalar()


def attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attachment rows, with the columns their rules are made of.

    Numbered ones (see ``numbered``) have their place in the case as ``rn``, and an id of
    case and place. Of the others everything comes from the row itself: the id is a
    digest of it, ``rn`` a sum.
    """
    lines = table(spark, sf_dir, "lineitem")
    if _NUMBERED.get():
        rows = number_within(lines, "l_orderkey", CASE_ORDER)
        att_id = F.col("l_orderkey") * 100 + F.col("rn")
    else:
        rows = spread(lines, "l_orderkey", "l_linenumber").withColumn(
            "rn", F.col("l_partkey") * 3 + F.col("l_suppkey") * 5 + F.col("l_linenumber")
        )
        digest = F.expr(
            "md5(l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey || '|'"
            " || cast(l_shipdate as date) || '|' || l_returnflag || '|' || l_linestatus)"
        )
        att_id = F.conv(F.left(digest, F.lit(15)), 16, 10).cast("bigint")
    suffix = F.expr(
        "element_at(array('.pdf', '.PDF', '.xlsx', '.xls', '.png', '.jpeg', '.msg', '.docx', '',"
        " '.tiff'), cast((l_linenumber + l_partkey) % 10 as int) + 1)"
    )
    att_type = F.expr(
        "case l_partkey % 6 when 0 then 'Quotation' when 1 then 'MPBP' when 2 then 'BER'"
        " when 3 then 'Email' when 4 then 'PO' end"
    )
    named = rows.select(
        F.col("l_orderkey").alias("ras_id"),
        F.col("l_linenumber").cast("bigint").alias("dtl_id"),
        att_id.alias("att_id"),
        F.expr("case when l_partkey % 29 <> 0 then 'f' || (l_partkey % 7) end").alias("_stem"),
        suffix.alias("_suffix"),
        att_type.alias("att_type"),
        F.expr("case when l_partkey % 11 <> 0 then l_suppkey end").alias("supplier_id"),
        F.col("l_shipdate").alias("uploaded_on"),
        "rn",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
    )
    return (
        named.withColumn("file_name", F.concat("_stem", "_suffix"))
        .withColumn("path", F.expr("'R_' || ras_id || '_2025/' || file_name"))
        .drop("_stem", "_suffix")
    )


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attachments with a location in one of its spellings, or none."""
    location = F.expr(
        "case l_suppkey % 5 when 1 then '/' || path when 2 then 'box/' || path"
        " when 3 then '/box/' || path when 4 then '  ' || path || ' ' end"
    )
    return attachments(spark, sf_dir).withColumn("file_location", location)


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object inventory: most attachment files, and the documents."""
    factor = F.expr("element_at(array(1, 20, 400, 4000), cast(rn % 4 as int) + 1)")
    files = (
        attachments(spark, sf_dir)
        .where("path is not null and (ras_id + rn) % 13 <> 0")
        .select(
            F.col("path").alias("name"),
            F.floor(F.col("l_extendedprice") * factor).cast("bigint").alias("size"),
        )
    )
    texts = table(spark, sf_dir, "documents").select(
        F.expr("'misc/doc_' || doc_id || '.txt'").alias("name"), F.col("n_chars").alias("size")
    )
    return files.unionByName(texts).groupBy("name").agg(F.max("size").alias("size"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item rows of the cases."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        suppliers, F.col("l_suppkey") == F.col("s_suppkey")
    )
    return joined.select(
        F.col("l_orderkey").alias("ras_id"),
        F.expr(
            "case l_partkey % 9 when 0 then null when 1 then '  ' when 2 then 'As per attached'"
            " when 3 then 'Refer annexure' when 4 then p_brand when 5 then p_name"
            " else p_name || ' ' || p_brand end"
        ).alias("item_name"),
        F.col("p_type").alias("category"),
        F.expr(
            "case when l_suppkey % 8 = 0 then null"
            " when l_suppkey % 3 = 0 then upper(s_name) || ' LTD' else s_name end"
        ).alias("supplier"),
        F.expr(
            "case when l_partkey % 31 = 0 then null when l_partkey % 23 = 0 then 0D"
            " else l_extendedprice end"
        ).alias("original_inr"),
        F.expr("l_extendedprice * (1 - l_discount)").alias("negotiated_inr"),
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbook cells: one file per nation, one sheet per market segment, one row per customer.

    Some cells are missing, one column has no name, one holds line breaks and tabs.
    """
    placed = table(spark, sf_dir, "customer").select(
        F.expr("'nation_' || c_nationkey || '.xlsx'").alias("file"),
        F.expr(
            "case c_mktsegment when 'AUTOMOBILE' then 1 when 'BUILDING' then 2 when 'FURNITURE'"
            " then 3 when 'HOUSEHOLD' then 4 else 5 end"
        ).alias("sheet_no"),
        F.col("c_mktsegment").alias("sheet"),
        (F.col("c_custkey") + 2).alias("row_no"),
        "c_custkey",
        "c_name",
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("_balance"),
    )
    key = ["file", "sheet_no", "sheet", "row_no"]
    body = placed.select(
        *key,
        F.expr(
            """stack(4, 1, case when c_custkey % 5 <> 0 then c_name end,
                        2, case when c_custkey % 7 <> 3 then _balance end,
                        3, case when c_custkey % 3 = 0 then 'a\\n' || c_custkey % 11 || '\\tb' end,
                        5, case when c_custkey % 4 = 0 then c_name || ' ' || c_name || ' ' || c_name
                                else 'é' end) as (col_no, cell)"""
        ),
    ).where("cell is not null")
    header = (
        placed.select("file", "sheet_no", "sheet")
        .distinct()
        .select(
            "file",
            "sheet_no",
            "sheet",
            F.lit(1).cast("bigint").alias("row_no"),
            F.expr("stack(3, 1, 'customer', 2, 'account balance', 5, 'note') as (col_no, cell)"),
        )
    )
    return header.unionByName(body)


def _answer_body() -> Column:
    """The JSON answer for an attachment, before fences and noise."""
    return F.expr(
        """
        case when l_partkey % 19 = 0 then '[1]' when l_partkey % 37 = 0 then 'null' else
          '{"document_classification": {"verified_type": "'
          || case when l_suppkey % 4 = 0 then 'Invoice' else coalesce(att_type, 'Other') end
          || '", "confidence": "'
          || case l_suppkey % 3 when 0 then 'high' when 1 then 'medium' else 'low' end
          || '", "att_type_matches_content": '
          || case when l_suppkey % 7 = 0 then 'null'
                  when l_suppkey % 4 <> 0 and att_type is not null then 'true' else 'false' end
          || ', "att_type_from_db": "' || coalesce(att_type, 'unknown') || '", "classification_reason": '
          || case when l_suppkey % 5 = 0 then 'null' else '"part ' || l_partkey || ' is named"' end
          || '}, "is_quotation": ' || case when l_partkey % 2 = 0 then 'true' else 'false' end
          || ', "quotation_data": '
          || case when l_partkey % 2 = 1 or l_partkey % 41 = 0 then 'null' else
               '{"supplier_name": "Supplier#' || lpad(cast(l_suppkey as string), 9, '0')
               || '", "canonical_item_name": '
               || case when l_partkey % 13 = 0 then 'null'
                       else '"Item ' || l_partkey || ' model X"' end
               || ', "quoted_price": '
               || case when l_partkey % 43 = 0
                         then '"' || cast(l_extendedprice as decimal(18,2)) || '"'
                       when l_partkey % 47 = 0 then '"8,623"'
                       else cast(cast(l_extendedprice * case when rn % 3 = 0 then 1.5D else 1.1D end
                                      as decimal(18,0)) as string) end
               || case when l_suppkey % 6 = 0 then '' else
                    ', "currency": "' || element_at(array('INR', 'USD', 'EUR'), cast(l_suppkey % 3 as int) + 1)
                    || '", "unit_price": ' || l_suppkey || '.5, "item_model": "M-' || l_partkey % 100
                    || '", "technical_specifications": {"power": "' || l_partkey % 50 || ' kW", "weight": '
                    || l_suppkey || '}, "quantity": "' || l_partkey % 9 || ' pcs", "payment_terms": "'
                    || l_suppkey % 90 || ' days", "delivery_terms": "FOB", "warranty": null, "validity": "30 days"'
                    || ', "quotation_date": "2024-01-0' || (l_partkey % 9 + 1) || '", "quotation_reference": "Q-'
                    || l_partkey || '"' end
               || '}' end
          || ', "additional_items": '
          || case when l_partkey % 4 = 0
               then '[{"item_name": "Spare ' || l_partkey || '", "price": ' || l_suppkey
                    || ', "specs": null}, {"item_name": "Kit", "price": "on request"}]' else '[]' end
          || ', "raw_summary": ' || case when l_partkey % 3 = 0 then 'null' else '"About part ' || l_partkey || '."' end
          || '}' end
        """
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw answers for every named attachment, in all the shapes a model wraps them in."""
    fence = "```"
    # The body stands once in the expression: it is long.
    before = F.expr(
        f"case rn % 5 when 0 then '' when 1 then '{fence}json' || chr(10) when 2 then '{fence}'"
        f" when 3 then '  ' else '{fence}json' end"
    )
    behind = F.expr(
        f"case rn % 5 when 1 then chr(10) || '{fence}' when 2 then '{fence}' when 3 then chr(10) else '' end"
        f" || case when l_partkey % 17 = 0 then ' trailing prose' else '' end"
    )
    return (
        attachments(spark, sf_dir)
        .where("file_name is not null")
        .withColumn("body", _answer_body())
        .withColumns(
            {
                "raw": F.concat(before, F.col("body"), behind),
                "error": F.lit(None).cast("string"),
                "blob_path": F.col("path"),
            }
        )
        .drop("body")
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored model calls: finished, cut and failed ones, some asked again, some never asked."""
    given = responses(spark, sf_dir).where("l_partkey % 13 <> 5")
    first = given.withColumns(
        {
            "call_no": F.lit(1),
            "max_tokens": F.lit(3000),
            "outcome": F.expr(
                "case l_partkey % 5 when 0 then 'failed' when 1 then 'cut' else 'finished' end"
            ),
        }
    )
    second = first.where("outcome <> 'finished' and l_suppkey % 4 <> 0").withColumns(
        {
            "call_no": F.lit(2),
            "max_tokens": F.expr("case when outcome = 'cut' then 6000 else 3000 end"),
            "outcome": F.expr(
                "case when outcome = 'cut' and l_suppkey % 3 = 0 then 'cut'"
                " when l_suppkey % 3 = 1 then 'failed' else 'finished' end"
            ),
        }
    )
    return first.unionByName(second).select(
        F.col("att_id").cast("string").alias("request_id"),
        F.lit("1").alias("prompt_version"),
        "call_no",
        "max_tokens",
        "outcome",
        F.lit(1).alias("attempts"),
        F.expr(
            "case outcome when 'finished' then raw when 'cut' then left(raw, length(raw) div 2) end"
        ).alias("raw"),
        F.expr("case when outcome = 'failed' then 'timeout' end").alias("error"),
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON texts made from ``events`` and their own JSON member, some of them broken."""
    good = F.expr(
        """'{"json_file": ' || case when event_id % 17 = 0 then 'null' else '"e' || event_id || '"' end
           || ', "is_quotation": ' || case when user_id % 2 = 0 then 'true' else 'false' end
           || ', "quotation_data": {"supplier_name": "' || event_type || '", "quoted_price": '
           || case when event_id % 11 = 0 then '"n/a"' else cast(cast(value as decimal(18,2)) as string) end
           || ', "currency": "' || element_at(array('INR', 'USD', 'EUR'), cast(user_id % 3 as int) + 1)
           || '", "technical_specifications": ' || props || '}, "raw_summary": "user ' || user_id
           || '", "meta": {"ras_id": "' || user_id || '", "supplier_id_from_db": ' || user_id || '}}'"""
    )
    broken = F.expr(
        "case event_id % 10 when 3 then left(_good, length(_good) - 1) when 4 then '[' || props || ']'"
        " when 5 then _good || ' and more' when 6 then event_type else _good end"
    )
    rows = table(spark, sf_dir, "events").withColumn("_good", good)
    return rows.select(
        broken.alias("raw"), F.lit(None).cast("string").alias("json_file"), "event_id"
    )
