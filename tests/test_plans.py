"""Plan checks: built-in expressions only, partial aggregation, pruning, no hot-key shuffle."""

import contextlib
import io
import re

import pytest

from tests.conftest import SF_SMALL

from keytally.plans.queries import QUERIES


def queries():
    return QUERIES


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_in_plans(spark, name):
    text = plan_text(queries()[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                 "PythonUDF"):
        assert node not in text, f"{name} uses {node}"


def test_word_count_plan(spark):
    text = plan_text(queries()["word_count"](spark, SF_SMALL))
    # partial + final aggregation around exactly one shuffle
    assert len(re.findall(r"HashAggregate", text)) >= 2
    assert "partial_count" in text
    assert len(re.findall(r"Arguments: hashpartitioning\(", text)) == 1
    assert re.search(r"Arguments: hashpartitioning\(word#", text)
    # only the text column is read
    assert "ReadSchema: struct<text:string>" in text


def test_resume_filter_broadcasts_positions(spark):
    text = plan_text(queries()["resume_filter"](spark, SF_SMALL))
    # the log (left) streams through the join; only the positions are broadcast, so
    # the log is never shuffled on (topic, partition)
    assert "BroadcastHashJoin LeftOuter BuildRight" in text


def test_running_sum_plan(spark):
    text = plan_text(queries()["running_total"](spark, SF_SMALL))
    # the data is exchanged once by range number; the single-partition window runs only over the
    # table of range totals, which is then broadcast
    assert len(re.findall(r"Arguments: hashpartitioning\(_kt_range", text)) == 2
    assert text.count("SinglePartition") <= 1 and "BroadcastHashJoin" in text


def test_progress_lookup_filters_pushed(spark):
    from pyspark.sql import functions as F
    from keytally.operators.offsets import progress_lookup
    path_df = spark.createDataFrame([("g", "wc", 0, 5, 1)],
                                    "group_id string, topic string, partition int, until_offset bigint, epoch bigint")
    import tempfile
    path = tempfile.mkdtemp(prefix="keytally-pos-") + "/p"
    path_df.write.parquet(path)
    text = plan_text(progress_lookup(spark.read.parquet(path), "g", "wc"))
    assert re.search(r"PushedFilters: \[.*EqualTo\(group_id,g\).*EqualTo\(topic,wc\)", text) or \
        re.search(r"PushedFilters: \[.*EqualTo\(topic,wc\).*EqualTo\(group_id,g\)", text)
    assert F is not None


RUNNING_SUM_QUERIES = {"event_time_walk", "gen_user_visit_action", "running_total"}
PER_ROW_QUERIES = {"tokenize_counts", "token_positions", "record_projection", "to_records_unkeyed",
                   "to_records_keyed", "ad_line_encode", "ad_line_decode", "format_event_time",
                   "message_template", "random_letter", "uniform_int", "weighted_choice", "sample_ids",
                   "sample_ids_repeat", "session_expand", "action_dispatch", "gen_user_info",
                   "gen_product_info", "city_dim", "gen_ad_clicks"}


@pytest.mark.parametrize("name", sorted(queries()))
def test_single_partition_only_on_bounded_block_tables(spark, name):
    """No window without partitionBy over the data: a single-partition exchange appears only
    in the running sum, over its checkpointed block table."""
    text = plan_text(queries()[name](spark, SF_SMALL))
    singles = text.count("Arguments: SinglePartition")
    if name in RUNNING_SUM_QUERIES:
        assert singles <= 1
    else:
        assert singles == 0, name


@pytest.mark.parametrize("name", sorted(PER_ROW_QUERIES))
def test_per_row_queries_do_not_hash_shuffle(spark, name):
    """Generators and projections are per-row expressions: no hash exchange (the only
    exchange allowed is the round-robin spread of an under-split input)."""
    text = plan_text(queries()[name](spark, SF_SMALL))
    assert "Arguments: hashpartitioning(" not in text, name
