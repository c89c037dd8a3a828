"""Explicit schemas. Nothing is inferred on read."""

from pyspark.sql.types import (
    IntegerType, LongType, StringType, StructField, StructType,
)


def _s(*fields: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# A record log (Kafka-like): one row per record.
RECORD_LOG = _s(("topic", StringType(), False), ("partition", IntegerType(), False),
                ("offset", LongType(), False), ("key", StringType(), True),
                ("value", StringType(), True))

# Per-epoch count deltas as stored by the exactly-once sink (epoch is the partition column).
COUNT_DELTAS = _s(("word", StringType(), True), ("cnt", LongType(), False),
                  ("epoch", LongType(), False))

# E-commerce data model (reference-compatible column names and types; counts widened).
# Declared nullable: generated columns are expressions Spark cannot prove non-null.
USER_VISIT_ACTION = _s(
    ("date", StringType(), True), ("user_id", LongType(), True), ("session_id", StringType(), True),
    ("page_id", LongType(), True), ("action_time", StringType(), True),
    ("search_keyword", StringType(), True), ("click_category_id", LongType(), True),
    ("click_product_id", LongType(), True), ("order_category_ids", StringType(), True),
    ("order_product_ids", StringType(), True), ("pay_category_ids", StringType(), True),
    ("pay_product_ids", StringType(), True), ("city_id", LongType(), True))

USER_INFO = _s(("user_id", LongType(), True), ("username", StringType(), True),
               ("name", StringType(), True), ("age", IntegerType(), True),
               ("professional", StringType(), True), ("gender", StringType(), True))

PRODUCT_INFO = _s(("product_id", LongType(), True), ("product_name", StringType(), True),
                  ("extend_info", StringType(), True))

CITY_INFO = _s(("city_id", LongType(), True), ("city_name", StringType(), True),
               ("area", StringType(), True))

AD_CLICK = _s(("timestamp_ms", LongType(), True), ("area", StringType(), True),
              ("city", StringType(), True), ("user_id", IntegerType(), True),
              ("ad_id", IntegerType(), True))

# Input tables read by the registered queries, declared rather than inferred on read.
INPUT_TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}
