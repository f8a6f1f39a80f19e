"""Every registered query against its SQL, and the shape of the leading plans."""

from __future__ import annotations

import re

import compare
import pytest

import __spark_entry__ as entry_module
from attestry.catalog import oracle
from attestry.catalog import queries as catalog

QUERIES = catalog.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert compare.difference(QUERIES[name](spark, sf_dir), duck, SQL[name]) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_or_nested_loop_join(spark, sf_dir, name):
    plan = _plan(QUERIES[name](spark, sf_dir))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_scans_read_only_what_is_used(spark, sf_dir):
    plan = _plan(QUERIES["q33b_item_name_features"](spark, sf_dir))
    assert re.search(r"ReadSchema: struct<p_partkey:bigint,p_name:string,p_brand:string>", plan)
    assert "l_extendedprice" not in plan


def test_row_limits_are_applied_before_the_shuffle(spark, sf_dir):
    for name in ("q25_latest_docs",):
        plan = _plan(QUERIES[name](spark, sf_dir))
        exchange = plan.index("Exchange", plan.index("WindowGroupLimit"))
        assert "WindowGroupLimit" in plan[exchange:], name


def test_a_filter_on_the_outcome_does_not_parse_again(spark, sf_dir):
    plan = _plan(QUERIES["q24_typed_fields"](spark, sf_dir))
    assert plan.count("parseJson") + plan.count("try_parse_json") == 1


def test_a_hot_case_is_split_in_the_pair_join(spark, tmp_path):
    """With tiny thresholds the adaptive plan splits the partition of a hot case."""
    from pyspark.sql import functions as F

    from attestry.operators import validate

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    case = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("string")
    docs = spark.range(0, 12_000, 1, 8).select(
        F.struct(F.lit("Invoice").alias("verified_type")).alias("document_classification"),
        F.lit(True).alias("is_quotation"),
        F.struct(
            F.concat(F.lit("S"), F.col("id").cast("string")).alias("supplier_name"),
            F.col("id").cast("double").alias("quoted_price"),
            F.lit("INR").alias("currency"),
            F.lit("n").alias("canonical_item_name"),
        ).alias("quotation_data"),
        F.struct(case.alias("ras_id"), F.lit("f").alias("file_name")).alias("meta"),
    )
    items = spark.range(0, 3_000, 1, 8).select(
        F.col("id").alias("ras_id"),
        F.lit("s").alias("supplier"),
        F.lit(1.0).alias("original_inr"),
        F.lit(1.0).alias("negotiated_inr"),
    )
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        pairs = validate.price_check(docs, items)
        pairs.write.parquet(str(tmp_path / "pairs"))
        frame = spark.read.parquet(str(tmp_path / "pairs"))
        assert frame.where("ras_id = '1'").count() == 4_001
        checked = pairs.agg(F.bit_xor(F.xxhash64(*pairs.columns)))
        checked.collect()
        assert "skew=true" in _plan(checked)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_long_steps_stay_within_what_the_jvm_compiles(spark, sf_dir):
    """A longer compiled step would be interpreted; such steps run operator by operator."""
    QUERIES["q23_parse_status"](spark, sf_dir)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
