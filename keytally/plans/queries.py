"""The registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Every query reads the given parquet tables (whole tables, all rows) and derives its
work from them, so its cost grows with the data. Columns are aliased to the names
used by the matching oracle SQL in :mod:`keytally.plans.oracle`.

Shared views:

* **log view** — ``events`` as a record log: topic ``wc``, ``partition = event_id % 4``,
  ``offset = event_id div 4``, key null, value ``event_type``;
* **batched log** — the log view cut into batches of 500 offsets (``epoch = offset div 500``);
* **progress** — offset ranges of the batched log as committed by four consumer groups;
  of each partition's epochs group *i* (``bigdata2`` .. ``bigdata5``) has committed the first
  ``(i + 1) / 4``, rounded up, so its progress grows with the log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from keytally import fixed_values as fv
from keytally.functions import codecs, seeded
from keytally.functions.tokens import split_tokens, token_count
from keytally.operators import counting, generate, offset_sets, offsets, weighted
from keytally.operators.running_sum import running_sum
from keytally.schemas import INPUT_TABLES
from keytally.session import checkpoint_root
from keytally.sources import recordlog, sinks, tables

LOG_PARTITIONS = 4
LOG_BATCH_SIZE = 500
RESUME_GROUP = "bigdata4"
UNSAVED_PARTITION = 3  # resume_filter: this partition has no saved position (earliest)
SEED = seeded.DEFAULT_SEED
SAMPLE_RANGE, SAMPLE_AMOUNT = 10 ** 9, 10
#: Action that an event of each type stands for; other types have none.
ACTION_OF_EVENT = [("view", "search"), ("click", "click"), ("purchase", "order"), ("signup", "pay")]


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str, spread: bool = False) -> DataFrame:
    """A whole input table (only ``columns`` if given).

    ``spread=True`` is for queries whose per-row work is heavy relative to the bytes
    read (tokenising, many md5 draws per row, session expansion): an under-split
    input is then spread over the cluster first. Light projections read as is.
    """
    path = f"{sf_dir}/{name}.parquet"
    schema = INPUT_TABLES.get(name)
    if spread:
        return tables.read_table(spark, path, list(columns) or None, schema=schema)
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return df.select(*columns) if columns else df


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events", "event_id", "event_type")
    return recordlog.log_view(events, "event_id", "event_type", topic=fv.TOPIC, partitions=LOG_PARTITIONS)


def batched_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recordlog.with_batches(events_log(spark, sf_dir), LOG_BATCH_SIZE)


def committed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``epoch`` and ``n_epochs`` of their partition, once for each group that committed them."""
    groups = F.array(*[F.struct(F.lit(g).alias("group_id"), F.lit(i + 1).alias("quarters"))
                       for i, g in enumerate(fv.GROUPS)])
    return (rows.withColumn("_g", F.explode(groups))
            .filter(F.lit(len(fv.GROUPS)) * F.col("epoch") < F.col("_g.quarters") * F.col("n_epochs"))
            .withColumn("group_id", F.col("_g.group_id")))


def group_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress rows of the four groups."""
    ranges = offsets.offset_ranges(batched_log(spark, sf_dir))
    sized = ranges.withColumn("n_epochs", F.max("epoch").over(Window.partitionBy("topic", "partition")) + F.lit(1))
    return committed(sized).select("group_id", "topic", "partition", "from_offset", "until_offset", "n_records", "epoch")


# --- A: keyed counting ---------------------------------------------------------------------

def q_word_count(spark, sf_dir):
    return counting.word_count(table(spark, sf_dir, "documents", "text", spread=True), "text")


def q_tokenize_counts(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations", "conv_id", "turn", "text", spread=True)
    return conv.select("conv_id", "turn", token_count(F.col("text")).alias("n_tokens"))


def q_token_positions(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations", "conv_id", "turn", "text", spread=True)
    return conv.select("conv_id", "turn", F.posexplode(split_tokens(F.col("text"))).alias("pos", "token")) \
        .select("conv_id", "turn", (F.col("pos") + F.lit(1)).cast("bigint").alias("idx"), "token")


def q_value_count(spark, sf_dir):
    return counting.value_count(events_log(spark, sf_dir), "value")


def q_batch_counts(spark, sf_dir):
    return counting.batch_word_counts(batched_log(spark, sf_dir), "epoch", "value")


def q_accumulate_counts(spark, sf_dir):
    deltas = counting.batch_word_counts(batched_log(spark, sf_dir), "epoch", "value")
    return counting.accumulate_counts(deltas, ("word",))


def q_group_totals(spark, sf_dir):
    """Totals of every consumer group: the words of the batches that the group committed."""
    deltas = counting.batch_word_counts(batched_log(spark, sf_dir), "epoch", "value", keys=("topic", "partition"))
    ends = (offsets.offset_ranges(batched_log(spark, sf_dir)).groupBy("topic", "partition")
            .agg((F.max("epoch") + F.lit(1)).alias("n_epochs")))  # one row per partition
    sized = deltas.join(offsets.bounded_broadcast(ends), ["topic", "partition"])
    return counting.accumulate_counts(committed(sized).select("group_id", "word", "cnt"), ("group_id", "word"))


# --- B: record logs, offsets, progress -------------------------------------------------------

def q_record_projection(spark, sf_dir):
    return recordlog.project_records(events_log(spark, sf_dir))


def q_to_records_unkeyed(spark, sf_dir):
    return recordlog.to_records(table(spark, sf_dir, "events", "event_type"), "event_type", keyed=False)


def q_to_records_keyed(spark, sf_dir):
    return recordlog.to_records(table(spark, sf_dir, "events", "event_type"), "event_type", keyed=True)


def q_offset_ranges(spark, sf_dir):
    return offsets.offset_ranges(batched_log(spark, sf_dir))


def q_latest_offsets(spark, sf_dir):
    return offsets.latest_offsets(group_progress(spark, sf_dir))


def saved_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of the resuming group on topic ``wc``: ``(topic, partition, until_offset)``."""
    return offsets.progress_lookup(offsets.latest_offsets(group_progress(spark, sf_dir)),
                                   RESUME_GROUP, fv.TOPIC)


def q_progress_lookup(spark, sf_dir):
    return saved_positions(spark, sf_dir)


def q_starting_offsets(spark, sf_dir):
    return offsets.starting_offsets_frame(saved_positions(spark, sf_dir))


def q_resume_filter(spark, sf_dir):
    positions = saved_positions(spark, sf_dir).filter(F.col("partition") != F.lit(UNSAVED_PARTITION))
    return offsets.resume_filter(events_log(spark, sf_dir), positions)


def kept_log(spark, sf_dir):
    """The log as a topic without its errors has it: their offsets are holes."""
    return events_log(spark, sf_dir).filter(F.col("value") != F.lit("error"))


def q_offset_runs(spark, sf_dir):
    return offset_sets.offset_runs(offset_sets.offset_bitmaps(kept_log(spark, sf_dir)))


def q_offset_gaps(spark, sf_dir):
    return offset_sets.offset_gaps(offset_sets.offset_bitmaps(kept_log(spark, sf_dir)))


def q_offset_repeats(spark, sf_dir):
    """Offsets that come more than once when purchases are delivered again."""
    log = events_log(spark, sf_dir)
    delivered = log.unionByName(log.filter(F.col("value") == F.lit("purchase")))
    return offset_sets.repeated_offsets(delivered, offset_sets.offset_bitmaps(delivered))


def q_uncounted(spark, sf_dir):
    """Records outside a set of counted ranges: those of all clicks and views."""
    log = events_log(spark, sf_dir)
    counted = offset_sets.offset_runs(offset_sets.offset_bitmaps(log.filter(F.col("value").isin("click", "view"))))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    return offset_sets.without_ranges(log, counted.checkpoint())  # read several times


def q_keyed_log(spark, sf_dir):
    """Events as a log keyed by user, in event order."""
    events = table(spark, sf_dir, "events", "event_id", "user_id", "event_type")
    records = events.select(F.lit(fv.TOPIC).alias("topic"), F.col("user_id").cast("string").alias("key"), F.col("event_type").alias("value"), "event_id")
    return sinks.place_by_key(records, LOG_PARTITIONS, order_cols=("event_id",))


# --- P: line codec, time formats, messages ----------------------------------------------------

def _ad_clicks_of_events(spark, sf_dir):
    ev = table(spark, sf_dir, "events", "event_id", "ts", spread=True)
    return generate.ad_clicks(ev, "event_id", codecs.ntz_to_millis("ts"), SEED)


def q_ad_line_encode(spark, sf_dir):
    """Lines of the events' own columns; ``props`` holds a space, so odd events make corrupt lines."""
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    area = F.when(F.col("event_id") % 2 == 1, F.col("props")).otherwise(F.get_json_object("props", "$.k"))
    return ev.select("event_id", codecs.encode_ad_line(codecs.ntz_to_millis("ts"), area, "event_type", "user_id", "event_id")
                     .alias("line"))


def q_ad_line_decode(spark, sf_dir):
    lines = q_ad_line_encode(spark, sf_dir)
    return lines.select("event_id", codecs.decode_ad_line("line").alias("f")).select("event_id", "f.*")


def q_format_event_time(spark, sf_dir):
    ev = table(spark, sf_dir, "events", "event_id", "ts")
    return ev.select("event_id", codecs.format_date("ts").alias("date"),
                     codecs.format_datetime("ts").alias("action_time"))


def q_message_template(spark, sf_dir):
    orders = table(spark, sf_dir, "orders", "o_orderkey")
    message = codecs.message_text(F.col("o_orderkey") + F.lit(1))
    return orders.select("o_orderkey", F.lit(fv.TOPIC).alias("topic"),
                         F.lit(None).cast("string").alias("key"), message.alias("value"))


def q_random_letter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders", "o_orderkey")
    code = seeded.uniform_int(fv.LETTER_FROM, fv.LETTER_TO, SEED, "letter", "o_orderkey")
    value = codecs.letter(code)
    return orders.select("o_orderkey", F.lit(fv.TOPIC).alias("topic"), value.alias("key"),
                         value.alias("value"))


# --- G: seeded generators ---------------------------------------------------------------------

def q_uniform_int(spark, sf_dir):
    cust = table(spark, sf_dir, "customer", "c_custkey")
    return cust.select("c_custkey", seeded.uniform_int(fv.AGE_FROM, fv.AGE_TO, SEED, "age", "c_custkey")
                       .alias("age"))


def q_weighted_choice(spark, sf_dir):
    cust = table(spark, sf_dir, "customer", "c_custkey")
    return cust.select("c_custkey",
                       seeded.weighted_choice(fv.PROFESSIONS, SEED, "professional", "c_custkey")
                       .alias("professional"),
                       seeded.weighted_choice(fv.GENDERS, SEED, "gender", "c_custkey").alias("gender"))


def _sample_amount():
    return seeded.uniform_int(1, generate.MAX_IDS_PER_ACTION, SEED, "amount", "p_partkey")


def q_sample_ids(spark, sf_dir):
    part = table(spark, sf_dir, "part", "p_partkey", spread=True)
    ids = seeded.distinct_sample(1, fv.CATEGORY_NUM, _sample_amount(), SEED, "ids", "p_partkey")
    return part.select("p_partkey", _sample_amount().alias("amount"), seeded.join_ids(ids).alias("ids"))


def q_sample_ids_repeat(spark, sf_dir):
    part = table(spark, sf_dir, "part", "p_partkey", spread=True)
    ids = seeded.repeat_sample(1, fv.CATEGORY_NUM, _sample_amount(), SEED, "ids", "p_partkey")
    return part.select("p_partkey", _sample_amount().alias("amount"), seeded.join_ids(ids).alias("ids"))


def q_sample_range(spark, sf_dir):
    """Ten of a thousand million ids for each part."""
    part = table(spark, sf_dir, "part", "p_partkey", spread=True)
    ids = seeded.sample_of_range(1, SAMPLE_RANGE + 1, SAMPLE_AMOUNT, SEED, "range", "p_partkey")
    return part.select("p_partkey", seeded.join_ids(ids).alias("ids"))


def q_weighted_nation(spark, sf_dir):
    """A nation for each customer, by the number of orders that its market segment has from each nation."""
    customer = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders", "o_custkey")
    weights = (orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
               .groupBy("c_mktsegment", "c_nationkey").agg(F.count(F.lit(1)).alias("orders")))
    return weighted.weighted_choice_from(customer.select("c_custkey", "c_mktsegment"), weights, "c_mktsegment", "c_nationkey", "orders",
                                         "nation", SEED, "nation", "c_custkey")


def q_event_time_walk(spark, sf_dir):
    keys = table(spark, sf_dir, "orders", "o_orderkey")
    walked = generate.event_time_walk(keys, "o_orderkey", seed=SEED)
    return walked.select("o_orderkey", "step_ms", codecs.format_datetime("event_ts").alias("action_time"),
                         codecs.format_date("event_ts").alias("date"))


def q_running_total(spark, sf_dir):
    """Running total of order prices in cents, by date and key."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate", "o_totalprice")
    cents = orders.select("o_orderkey", "o_orderdate", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    return running_sum(cents, "cents", "o_orderdate", "running_cents", tie_cols=("o_orderkey",)) \
        .select("o_orderkey", codecs.format_date("o_orderdate").alias("date"), "cents", "running_cents")


def q_session_expand(spark, sf_dir):
    cust = table(spark, sf_dir, "customer", "c_custkey", spread=True)
    return generate.expand_sessions(cust, "c_custkey", SEED).select("c_custkey", "session_id", "action_index") \
        .withColumn("action_index", F.col("action_index").cast("bigint"))


def q_action_dispatch(spark, sf_dir):
    """Each event's action comes from its type; the action decides which columns are set."""
    ev = table(spark, sf_dir, "events", "event_id", "event_type", spread=True)
    action = F.when(F.lit(False), F.lit(""))
    for event_type, name in ACTION_OF_EVENT:
        action = action.when(F.col("event_type") == F.lit(event_type), F.lit(name))
    read = ev.withColumn("action", action)
    return read.select("event_id", "action", *generate.action_columns(F.col("action"), SEED, "event_id"))


def q_gen_user_info(spark, sf_dir):
    return generate.user_info(table(spark, sf_dir, "customer", "c_custkey"), "c_custkey", SEED)


def q_gen_product_info(spark, sf_dir):
    return generate.product_info(table(spark, sf_dir, "part", "p_partkey"), "p_partkey", SEED)


def q_city_dim(spark, sf_dir):
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    homes = cust.select("c_custkey", (F.col("c_nationkey").cast("bigint") + F.lit(1)).alias("city_id"))
    return generate.with_city(homes, "city_id")


def q_gen_ad_clicks(spark, sf_dir):
    clicks = _ad_clicks_of_events(spark, sf_dir)
    batch = F.call_function("div", F.col("event_id"), F.lit(fv.AD_BATCH_SIZE))
    return clicks.select(batch.alias("batch"), F.lit(fv.AD_TOPIC).alias("topic"),
                         F.lit(None).cast("string").alias("key"), generate.ad_line().alias("value"))


def q_gen_user_visit_action(spark, sf_dir):
    return generate.user_visit_actions(table(spark, sf_dir, "customer", "c_custkey", spread=True),
                                       "c_custkey", SEED)


# --- K: preview -----------------------------------------------------------------------------

def q_preview_100(spark, sf_dir):
    return tables.preview(table(spark, sf_dir, "orders"), 100, order_by=["o_orderkey"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)
}

FLAGSHIP = "word_count"
