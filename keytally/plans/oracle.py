"""DuckDB oracle SQL for every registered query (same output column names).

Independent formulations: unnest + GROUP BY instead of explode, window
``sum() OVER (ORDER BY ...)`` instead of the blocked running sum, ``row_number()``
over candidate rows instead of sorted arrays. Seeded draws use the same md5 bits,
rendered by :func:`draw` from the same parameters the Spark side uses.

DuckDB notes: ``sum(bigint)`` is HUGEINT, so sums are cast back to BIGINT;
``epoch_ms(timestamp)`` rounds, so millis are ``epoch_us(ts) // 1000`` (truncating,
like Spark).
"""

from __future__ import annotations

import math

from keytally import fixed_values as fv
from keytally.functions.seeded import DEFAULT_SEED, U_BITS, U_RANGE, max_geometric_length
from keytally.operators import generate
from keytally.plans import queries as q

SEED = DEFAULT_SEED


# --- SQL renderings of the seeded primitives -------------------------------------------------

def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def draw(salt: str, *keys: str) -> str:
    parts = ", ".join([_lit(str(SEED)), _lit(salt)] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return f"CAST('0x' || substr(md5(concat_ws('|', {parts})), 1, {U_BITS // 4}) AS BIGINT)"


def uniform(low: int, high: int, salt: str, *keys: str) -> str:
    return f"({low} + {draw(salt, *keys)} % {high - low + 1})"


def weighted(options, salt: str, *keys: str) -> str:
    total = sum(w for _, w in options)
    r = f"({draw(salt, *keys)} % {total})"
    arms, bound = [], 0
    for value, weight in options:
        if weight == 0:
            continue
        bound += weight
        v = _lit(value) if isinstance(value, str) else str(value)
        arms.append(f"WHEN {r} < {bound} THEN {v}")
    return "CASE " + " ".join(arms) + " END"


def uuid(salt: str, *keys: str) -> str:
    h = f"md5(concat_ws('|', {_lit(str(SEED))}, {_lit(salt)}, " + \
        ", ".join(f"CAST({k} AS VARCHAR)" for k in keys) + "))"
    return (f"concat_ws('-', substr({h}, 1, 8), substr({h}, 9, 4), substr({h}, 13, 4), "
            f"substr({h}, 17, 4), substr({h}, 21, 12))")


def geometric(p: float, salt: str, *keys: str) -> str:
    u = f"(CAST({draw(salt, *keys)} AS DOUBLE) / CAST('{float(U_RANGE)!r}' AS DOUBLE))"
    return f"CAST(floor(ln(1.0::DOUBLE - {u}) / CAST('{math.log(p)!r}' AS DOUBLE)) AS INTEGER)"


def tokens(text: str) -> str:
    return (f"CASE WHEN {text} <> '' AND rtrim({text}, ' ') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(rtrim({text}, ' '), ' ') END")


def id_list_cte(name: str, source: str, keys: list[str], salt: str) -> str:
    """Per key: 1..5 distinct ids from [1, CATEGORY_NUM), ascending, comma-joined."""
    k = ", ".join(keys)
    return f"""{name} AS (
  SELECT {k}, string_agg(CAST(x AS VARCHAR), ',' ORDER BY x) AS ids
  FROM (SELECT {k}, x,
               {uniform(1, generate.MAX_IDS_PER_ACTION, salt + '_n', *keys)} AS amount,
               row_number() OVER (PARTITION BY {k} ORDER BY {draw(salt, *keys, 'x')}, x) AS rn
        FROM {source}, range(1, {fv.CATEGORY_NUM}) t(x))
  WHERE rn <= amount
  GROUP BY {k})"""


def _day_ms(day: str) -> int:
    return generate._day_millis(day)


# --- shared views ---------------------------------------------------------------------------

LOG = f"""log AS (
  SELECT '{fv.TOPIC}' AS topic, CAST(event_id % {q.LOG_PARTITIONS} AS INTEGER) AS partition,
         event_id // {q.LOG_PARTITIONS} AS "offset", CAST(NULL AS VARCHAR) AS key,
         event_type AS value
  FROM events)"""

RANGES = f"""ranges AS (
  SELECT "offset" // {q.LOG_BATCH_SIZE} AS epoch, topic, partition, min("offset") AS from_offset,
         max("offset") + 1 AS until_offset, count(*) AS n_records
  FROM log GROUP BY ALL)"""

_N = len(fv.GROUPS)
_GROUP_VALUES = ", ".join(f"('{g}', {i + 1})" for i, g in enumerate(fv.GROUPS))
PROGRESS = f"""sized AS (
  SELECT *, max(epoch) OVER (PARTITION BY topic, partition) + 1 AS n_epochs FROM ranges),
progress AS (
  SELECT g.group_id, r.topic, r.partition, r.from_offset, r.until_offset, r.n_records, r.epoch
  FROM sized r JOIN (VALUES {_GROUP_VALUES}) g(group_id, quarters) ON {_N} * r.epoch < g.quarters * r.n_epochs)"""

POSITIONS = """positions AS (
  SELECT group_id, topic, partition, arg_max(until_offset, epoch) AS until_offset,
         max(epoch) AS epoch
  FROM progress GROUP BY group_id, topic, partition)"""

AD_CLICKS = f"""clicks AS (
  SELECT event_id, epoch_us(ts) // 1000 AS timestamp_ms,
         {weighted([(a, w) for _, a, w in fv.AD_CITIES], 'ad_city', 'event_id')} AS area,
         {weighted([(c, w) for c, _, w in fv.AD_CITIES], 'ad_city', 'event_id')} AS city,
         CAST({uniform(fv.AD_USER_FROM, fv.AD_USER_TO, 'ad_user', 'event_id')} AS INTEGER) AS user_id,
         CAST({uniform(fv.AD_ID_FROM, fv.AD_ID_TO, 'ad_id', 'event_id')} AS INTEGER) AS ad_id
  FROM events)"""

AD_LINE = ("concat_ws(' ', coalesce(CAST(timestamp_ms AS VARCHAR), 'null'), coalesce(area, 'null'), "
           "coalesce(city, 'null'), coalesce(CAST(user_id AS VARCHAR), 'null'), "
           "coalesce(CAST(ad_id AS VARCHAR), 'null'))")

EVENT_LINE = """concat_ws(' ', coalesce(CAST(epoch_us(ts) // 1000 AS VARCHAR), 'null'),
              coalesce(CASE WHEN event_id % 2 = 1 THEN props ELSE json_extract_string(props, '$.k') END, 'null'),
              coalesce(event_type, 'null'), coalesce(CAST(user_id AS VARCHAR), 'null'), CAST(event_id AS VARCHAR))"""

_MAX_STEP = generate.walk_max_step()
_START_MS = _day_ms(fv.WALK_START_DATE)
_P_CONTINUE = 1.0 - dict(fv.ACTIONS)["quit"] / sum(w for _, w in fv.ACTIONS)
_CITY_VALUES = ", ".join(f"({i}, {_lit(n)}, {_lit(a)})" for i, n, a in fv.CITIES)


def _action_columns(src_keys: list[str], action: str = "action") -> str:
    k = src_keys
    return f"""CASE WHEN {action} = 'search' THEN {weighted(fv.SEARCH_KEYWORDS, 'keyword', *k)} END AS search_keyword,
    CASE WHEN {action} = 'click' THEN {uniform(1, fv.CATEGORY_NUM, 'click_category', *k)} ELSE -1 END AS click_category_id,
    CASE WHEN {action} = 'click' THEN {uniform(1, fv.PRODUCT_NUM, 'click_product', *k)} ELSE -1 END AS click_product_id,
    CASE WHEN {action} = 'order' THEN oc.ids END AS order_category_ids,
    CASE WHEN {action} = 'order' THEN op.ids END AS order_product_ids,
    CASE WHEN {action} = 'pay' THEN pc.ids END AS pay_category_ids,
    CASE WHEN {action} = 'pay' THEN pp.ids END AS pay_product_ids"""


def _id_joins(base: str, keys: list[str]) -> str:
    on = lambda alias: " AND ".join(f"{alias}.{c} = {base}.{c}" for c in keys)
    return "\n".join(f"LEFT JOIN {t} {a} ON {on(a)}" for t, a in
                     [("ids_oc", "oc"), ("ids_op", "op"), ("ids_pc", "pc"), ("ids_pp", "pp")])


def _id_ctes(source_template: str, keys: list[str]) -> str:
    """Four id-list CTEs; ``source_template`` is formatted with the action name."""
    return ",\n".join([
        id_list_cte("ids_oc", source_template.format(action="order"), keys, "order_category"),
        id_list_cte("ids_op", source_template.format(action="order"), keys, "order_product"),
        id_list_cte("ids_pc", source_template.format(action="pay"), keys, "pay_category"),
        id_list_cte("ids_pp", source_template.format(action="pay"), keys, "pay_product"),
    ])


_NON_QUIT = generate.non_quit_actions()
_SAMPLE_AMOUNT = uniform(1, generate.MAX_IDS_PER_ACTION, "amount", "p_partkey")

_ACTION_ARMS = " ".join(f"WHEN {_lit(e)} THEN {_lit(a)}" for e, a in q.ACTION_OF_EVENT)

ORACLE_SQL: dict[str, str] = {
    # A: keyed counting
    "word_count": f"""
SELECT word, count(*) AS cnt
FROM (SELECT unnest({tokens('text')}) AS word FROM documents)
GROUP BY word""",

    "tokenize_counts": f"""
SELECT conv_id, turn, CAST(len({tokens('text')}) AS BIGINT) AS n_tokens FROM conversations""",

    "token_positions": f"""
WITH t AS (SELECT conv_id, turn, {tokens('text')} AS tok FROM conversations)
SELECT conv_id, turn, CAST(unnest(generate_series(1, len(tok))) AS BIGINT) AS idx, unnest(tok) AS token
FROM t""",

    "value_count": """
SELECT event_type AS value, count(*) AS cnt FROM events GROUP BY event_type""",

    "batch_counts": f"""
WITH {LOG}
SELECT "offset" // {q.LOG_BATCH_SIZE} AS epoch, word, count(*) AS cnt
FROM (SELECT "offset", unnest({tokens('value')}) AS word FROM log)
GROUP BY ALL""",

    "accumulate_counts": f"""
SELECT word, count(*) AS cnt
FROM (SELECT unnest({tokens('event_type')}) AS word FROM events)
GROUP BY word""",

    "group_totals": f"""
WITH {LOG}, {RANGES}, {PROGRESS}
SELECT p.group_id, w.word, count(*) AS cnt
FROM progress p JOIN (SELECT topic, partition, "offset", unnest({tokens('value')}) AS word FROM log) w
  ON w.topic = p.topic AND w.partition = p.partition AND w."offset" >= p.from_offset AND w."offset" < p.until_offset
GROUP BY ALL""",

    # B: record logs, offsets, progress
    "record_projection": f"""
WITH {LOG}
SELECT partition, "offset", key, value FROM log""",

    "to_records_unkeyed": f"""
SELECT '{fv.TOPIC}' AS topic, CAST(NULL AS VARCHAR) AS key, event_type AS value FROM events""",

    "to_records_keyed": f"""
SELECT '{fv.TOPIC}' AS topic, event_type AS key, event_type AS value FROM events""",

    "offset_ranges": f"""
WITH {LOG}, {RANGES}
SELECT * FROM ranges""",

    "latest_offsets": f"""
WITH {LOG}, {RANGES}, {PROGRESS}, {POSITIONS}
SELECT * FROM positions""",

    "progress_lookup": f"""
WITH {LOG}, {RANGES}, {PROGRESS}, {POSITIONS}
SELECT topic, partition, until_offset FROM positions
WHERE group_id = '{q.RESUME_GROUP}' AND topic = '{fv.TOPIC}'""",

    "starting_offsets": f"""
WITH {LOG}, {RANGES}, {PROGRESS}, {POSITIONS},
saved AS (SELECT topic, partition, until_offset FROM positions
          WHERE group_id = '{q.RESUME_GROUP}' AND topic = '{fv.TOPIC}')
SELECT topic, '{{"' || topic || '":{{' || string_agg('"' || CAST(partition AS VARCHAR) || '":'
       || CAST(until_offset AS VARCHAR), ',' ORDER BY partition) || '}}}}' AS starting_offsets
FROM saved GROUP BY topic""",

    "resume_filter": f"""
WITH {LOG}, {RANGES}, {PROGRESS}, {POSITIONS},
saved AS (SELECT topic, partition, until_offset FROM positions
          WHERE group_id = '{q.RESUME_GROUP}' AND topic = '{fv.TOPIC}' AND partition <> {q.UNSAVED_PARTITION})
SELECT log.topic, log.partition, log."offset", log.key, log.value
FROM log LEFT JOIN saved ON log.topic = saved.topic AND log.partition = saved.partition
WHERE log."offset" >= coalesce(saved.until_offset, 0)""",

    # P: codecs, formats, messages
    "ad_line_encode": f"""
SELECT event_id, {EVENT_LINE} AS line FROM events""",

    "ad_line_decode": f"""
WITH lines AS (SELECT event_id, {EVENT_LINE} AS line FROM events),
parts AS (SELECT event_id, line, string_split(line, ' ') AS p FROM lines),
typed AS (SELECT event_id, line, len(p) AS n, TRY_CAST(p[1] AS BIGINT) AS timestamp_ms, p[2] AS area,
                 p[3] AS city, TRY_CAST(p[4] AS INTEGER) AS user_id, TRY_CAST(p[5] AS INTEGER) AS ad_id
          FROM parts)
SELECT event_id, timestamp_ms, area, city, user_id, ad_id,
       CASE WHEN n <> 5 OR timestamp_ms IS NULL OR user_id IS NULL OR ad_id IS NULL OR line IS NULL
            THEN line END AS _corrupt
FROM typed""",

    "format_event_time": """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time
FROM events""",

    "message_template": f"""
SELECT o_orderkey, '{fv.TOPIC}' AS topic, CAST(NULL AS VARCHAR) AS key,
       printf('{fv.MESSAGE_TEMPLATE}', o_orderkey + 1, o_orderkey + 1) AS value
FROM orders""",

    "random_letter": f"""
WITH l AS (SELECT o_orderkey, chr(CAST({uniform(fv.LETTER_FROM, fv.LETTER_TO, 'letter', 'o_orderkey')} AS INTEGER)) AS v
           FROM orders)
SELECT o_orderkey, '{fv.TOPIC}' AS topic, v AS key, v AS value FROM l""",

    # G: seeded generators
    "uniform_int": f"""
SELECT c_custkey, {uniform(fv.AGE_FROM, fv.AGE_TO, 'age', 'c_custkey')} AS age FROM customer""",

    "weighted_choice": f"""
SELECT c_custkey, {weighted(fv.PROFESSIONS, 'professional', 'c_custkey')} AS professional,
       {weighted(fv.GENDERS, 'gender', 'c_custkey')} AS gender
FROM customer""",

    "sample_ids": f"""
WITH c AS (SELECT p_partkey, {_SAMPLE_AMOUNT} AS amount, x,
                  row_number() OVER (PARTITION BY p_partkey ORDER BY {draw('ids', 'p_partkey', 'x')}, x) AS rn
           FROM part, range(1, {fv.CATEGORY_NUM}) t(x))
SELECT p_partkey, amount, string_agg(CAST(x AS VARCHAR), ',' ORDER BY x) AS ids
FROM c WHERE rn <= amount GROUP BY p_partkey, amount""",

    "sample_ids_repeat": f"""
WITH c AS (SELECT p_partkey, {_SAMPLE_AMOUNT} AS amount, i FROM part, range(1, {generate.MAX_IDS_PER_ACTION + 1}) t(i))
SELECT p_partkey, amount,
       string_agg(CAST(1 + {draw('ids', 'p_partkey', 'i')} % {fv.CATEGORY_NUM - 1} AS VARCHAR), ',' ORDER BY i) AS ids
FROM c WHERE i <= amount GROUP BY p_partkey, amount""",

    "event_time_walk": f"""
WITH s AS (SELECT o_orderkey, {draw('step', 'o_orderkey')} % {_MAX_STEP} AS step_ms FROM orders),
w AS (SELECT o_orderkey, step_ms,
             epoch_ms(CAST({_START_MS} + sum(step_ms) OVER (ORDER BY o_orderkey
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)) AS ts
      FROM s)
SELECT o_orderkey, step_ms, strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time,
       strftime(ts, '%Y-%m-%d') AS date
FROM w""",

    "running_total": """
WITH c AS (SELECT o_orderkey, o_orderdate, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date, cents,
       CAST(sum(cents) OVER (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_cents
FROM c""",

    "session_expand": f"""
WITH s AS (SELECT c_custkey, {uuid('session', 'c_custkey')} AS session_id,
                  {geometric(_P_CONTINUE, 'length', 'c_custkey')} AS len
           FROM customer),
a AS (SELECT c_custkey, session_id, unnest(range(1, len + 1)) AS i FROM s)
SELECT c_custkey, session_id, CAST(i AS BIGINT) AS action_index FROM a""",

    "action_dispatch": f"""
WITH e AS (SELECT event_id, CASE event_type {_ACTION_ARMS} END AS action FROM events),
{_id_ctes("(SELECT event_id FROM e WHERE action = '{action}')", ['event_id'])}
SELECT e.event_id, e.action,
    {_action_columns(['e.event_id'])}
FROM e
{_id_joins('e', ['event_id'])}""",

    "gen_user_info": f"""
SELECT c_custkey + 1 AS user_id, '{fv.USERNAME_PREFIX}' || CAST(c_custkey + 1 AS VARCHAR) AS username,
       '{fv.NAME_PREFIX}' || CAST(c_custkey + 1 AS VARCHAR) AS name,
       CAST({uniform(fv.AGE_FROM, fv.AGE_TO, 'age', 'c_custkey')} AS INTEGER) AS age,
       {weighted(fv.PROFESSIONS, 'professional', 'c_custkey')} AS professional,
       {weighted(fv.GENDERS, 'gender', 'c_custkey')} AS gender
FROM customer""",

    "gen_product_info": f"""
SELECT p_partkey + 1 AS product_id, '{fv.PRODUCT_NAME_PREFIX}' || CAST(p_partkey + 1 AS VARCHAR) AS product_name,
       {weighted(fv.PRODUCT_EXTEND_INFO, 'extend_info', 'p_partkey')} AS extend_info
FROM part""",

    "city_dim": f"""
WITH h AS (SELECT c_custkey, CAST(c_nationkey AS BIGINT) + 1 AS city_id FROM customer)
SELECT h.city_id, h.c_custkey, d.city_name, d.area
FROM h LEFT JOIN (VALUES {_CITY_VALUES}) d(city_id, city_name, area) ON h.city_id = d.city_id""",

    "gen_ad_clicks": f"""
WITH {AD_CLICKS}
SELECT event_id // {fv.AD_BATCH_SIZE} AS batch, '{fv.AD_TOPIC}' AS topic, CAST(NULL AS VARCHAR) AS key,
       {AD_LINE} AS value
FROM clicks""",

    "gen_user_visit_action": f"""
WITH s AS (SELECT c_custkey, {uuid('session', 'c_custkey')} AS session_id,
                  {geometric(_P_CONTINUE, 'length', 'c_custkey')} AS len,
                  {uniform(1, fv.USER_NUM, 'user', 'c_custkey')} AS user_id
           FROM customer),
a AS (SELECT c_custkey, session_id, user_id, unnest(range(1, len + 1)) AS action_index FROM s),
w AS (SELECT *, {weighted(_NON_QUIT, 'action', 'c_custkey', 'action_index')} AS action,
             {draw('step', 'c_custkey', 'action_index')} % {_MAX_STEP} AS step_ms
      FROM a),
t AS (SELECT *, epoch_ms(CAST({_START_MS} + sum(step_ms) OVER (ORDER BY c_custkey, action_index
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)) AS ts
      FROM w),
{_id_ctes("(SELECT c_custkey, action_index FROM w WHERE action = '{action}')", ['c_custkey', 'action_index'])}
SELECT strftime(t.ts, '%Y-%m-%d') AS date, t.user_id, t.session_id,
    {uniform(1, fv.PAGE_NUM, 'page', 't.c_custkey', 't.action_index')} AS page_id,
    strftime(t.ts, '%Y-%m-%d %H:%M:%S') AS action_time,
    {_action_columns(['t.c_custkey', 't.action_index'])},
    {uniform(1, len(fv.CITIES), 'city', 't.c_custkey', 't.action_index')} AS city_id
FROM t
{_id_joins('t', ['c_custkey', 'action_index'])}""",

    # K: preview
    "preview_100": """
SELECT * FROM orders ORDER BY o_orderkey LIMIT 100""",
}

assert max_geometric_length(_P_CONTINUE) > 0


# --- offset sets, keyed placement, samples of large ranges, weights from a table ---------------------

_LOG = f"""(SELECT '{fv.TOPIC}' AS topic, CAST(event_id % {q.LOG_PARTITIONS} AS INTEGER) AS partition,
  event_id // {q.LOG_PARTITIONS} AS "offset", CAST(NULL AS VARCHAR) AS key, event_type AS value FROM events)"""

ORACLE_SQL["offset_runs"] = f"""
WITH k AS (SELECT *, "offset" - row_number() OVER (PARTITION BY topic, partition ORDER BY "offset") AS island
           FROM {_LOG} WHERE value <> 'error')
SELECT topic, partition, min("offset") AS from_offset, max("offset") + 1 AS until_offset FROM k GROUP BY topic, partition, island
"""

ORACLE_SQL["offset_gaps"] = f"""
WITH k AS (SELECT topic, partition, "offset" + 1 AS from_offset, lead("offset") OVER (PARTITION BY topic, partition ORDER BY "offset") AS until_offset
           FROM {_LOG} WHERE value <> 'error')
SELECT topic, partition, from_offset, until_offset, until_offset - from_offset AS n_missing FROM k WHERE until_offset > from_offset
"""

ORACLE_SQL["offset_repeats"] = f"""
SELECT topic, partition, "offset", count(*) AS n
FROM (SELECT * FROM {_LOG} UNION ALL SELECT * FROM {_LOG} WHERE value = 'purchase') GROUP BY topic, partition, "offset" HAVING count(*) > 1
"""

ORACLE_SQL["uncounted"] = f"""
SELECT topic, partition, "offset", key, value FROM {_LOG} WHERE value NOT IN ('click', 'view')
"""

ORACLE_SQL["keyed_log"] = f"""
WITH k AS (SELECT *, CAST(CAST('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 13) AS BIGINT) % {q.LOG_PARTITIONS} AS INTEGER) AS partition FROM events)
SELECT '{fv.TOPIC}' AS topic, partition, row_number() OVER (PARTITION BY partition ORDER BY event_id) - 1 AS "offset",
       CAST(user_id AS VARCHAR) AS key, event_type AS value FROM k
"""

ORACLE_SQL["sample_range"] = f"""
WITH RECURSIVE f AS (
  SELECT p_partkey, CAST({q.SAMPLE_RANGE - q.SAMPLE_AMOUNT} AS BIGINT) AS j, CAST([] AS BIGINT[]) AS s FROM part
  UNION ALL
  SELECT p_partkey, j + 1, list_append(s, CASE WHEN list_contains(s, t) THEN j ELSE t END)
  FROM (SELECT *, {draw('range', 'p_partkey', 'j')} % (j + 1) AS t FROM f WHERE j < {q.SAMPLE_RANGE})
)
SELECT p_partkey, array_to_string(list_sort(list_transform(s, lambda x: x + 1)), ',') AS ids FROM f WHERE j = {q.SAMPLE_RANGE}
"""

ORACLE_SQL["weighted_nation"] = f"""
WITH w AS (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
c AS (SELECT *, CAST(sum(n) OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey) AS BIGINT) AS high,
             CAST(sum(n) OVER (PARTITION BY c_mktsegment) AS BIGINT) AS total FROM w),
d AS (SELECT c_custkey, c_mktsegment, {draw('nation', 'c_custkey')} AS draw FROM customer)
SELECT c_custkey, d.c_mktsegment, c_nationkey AS nation
FROM d LEFT JOIN c ON d.c_mktsegment = c.c_mktsegment AND draw % total < high AND draw % total >= high - n
"""
