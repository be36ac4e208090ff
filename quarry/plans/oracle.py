"""DuckDB SQL oracles, one per registered query, over the test tables.

Each statement rebuilds the stand-in input in SQL and states the expected
result independently of the Spark code.
"""

from __future__ import annotations

SURVEY = """survey AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber) AS tucaseid,
         CAST(l_quantity AS DOUBLE) AS teage,
         CAST(l_linenumber AS DOUBLE) AS telfs,
         CAST(l_suppkey % 2 + 1 AS DOUBLE) AS tesex,
         l_quantity * 10 AS t010101,
         CAST(l_linenumber * 15 AS DOUBLE) AS t030101,
         CAST(l_suppkey % 60 AS DOUBLE) AS t180101,
         CAST(l_partkey % 480 AS DOUBLE) AS t050101,
         CAST(l_orderkey % 90 AS DOUBLE) AS t180501,
         CAST(l_orderkey % 120 AS DOUBLE) AS t020101,
         CAST(day(l_shipdate) * 10 AS DOUBLE) AS t120101,
         CAST(l_partkey % 30 AS DOUBLE) AS t180201
  FROM lineitem)"""

SUMMARY = SURVEY + """,
summary AS (
  SELECT CASE WHEN telfs >= 1 AND telfs < 3 THEN 'working' ELSE 'not working' END AS working,
         CASE WHEN tesex = 1 THEN 'male' ELSE 'female' END AS sex,
         CASE WHEN teage >= 15 AND teage <= 22 THEN 'young'
              WHEN teage >= 23 AND teage <= 55 THEN 'active' ELSE 'elder' END AS age,
         (t010101 + t030101 + t180101) / 60 AS primaryNeeds,
         (t050101 + t180501) / 60 AS work,
         (t020101 + t120101 + t180201) / 60 AS other
  FROM survey WHERE telfs <= 4)"""

GROUPED = "WITH " + SUMMARY + """
SELECT working, sex, age,
       round(avg(primaryNeeds), 1) AS "{n}",
       round(avg(work), 1) AS "{w}",
       round(avg(other), 1) AS "{o}"
FROM summary GROUP BY working, sex, age ORDER BY working, sex, age"""

TRADE_EVENTS = """trade_events AS (
  SELECT dense_rank() OVER (ORDER BY event_id // 4) - 1 AS trade_id,
         event_type AS product_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS "timestamp",
         CAST(value AS FLOAT) AS amount
  FROM events)"""

PERSONS = """persons AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
         CAST(18 + c_custkey % 42 AS INTEGER) AS age,
         CAST(floor(c_acctbal) * 15 AS INTEGER) AS earnings
  FROM customer)"""

ACCOUNTS = """accounts AS (
  SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS person_id,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'SAVINGS' WHEN '2-HIGH' THEN 'CHEQUING'
              WHEN '3-MEDIUM' THEN 'CREDIT' WHEN '4-NOT SPECIFIED' THEN 'BROKER'
              WHEN '5-LOW' THEN 'CHEQUING' END AS type,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN -CAST(floor(o_totalprice / 5) AS INTEGER)
              ELSE CAST(floor(o_totalprice / 5) AS INTEGER) END AS balance
  FROM orders)"""


def _type_aggs() -> str:
    parts = []
    for t in ("SAVINGS", "CHEQUING", "CREDIT", "BROKER"):
        lo = t.lower()
        parts.append(f"count(*) FILTER (WHERE type = '{t}') AS n_{lo}")
        parts.append(f"arg_min(balance, id) FILTER (WHERE type = '{t}') AS first_{lo}_balance")
    return ",\n         ".join(parts)


JOINED = PERSONS + ",\n" + ACCOUNTS + f""",
profile AS (
  SELECT person_id, count(*) AS n_accounts, CAST(sum(balance) AS BIGINT) AS total_balance,
         {_type_aggs()}
  FROM accounts GROUP BY person_id),
joined AS (
  SELECT p.*, pr.* EXCLUDE (person_id) FROM persons p JOIN profile pr ON p.id = pr.person_id)"""

MESSAGES = """msg AS (
  SELECT epoch_us(ts) // 1000 AS millis, event_id AS n,
         '192.168.2.' || CAST(user_id % 255 AS VARCHAR) AS ip
  FROM events)"""

TOPIC = MESSAGES + """,
topic AS (
  SELECT CAST(CAST(split_part(ip, '.', 4) AS INTEGER) % 8 AS INTEGER) AS partition,
         row_number() OVER (PARTITION BY CAST(split_part(ip, '.', 4) AS INTEGER) % 8 ORDER BY n) - 1 AS "offset",
         count(*) OVER (PARTITION BY CAST(split_part(ip, '.', 4) AS INTEGER) % 8) AS ends,
         ip AS "key", concat_ws(',', CAST(millis AS VARCHAR), CAST(n AS VARCHAR), 'www.example.com', ip) AS value
  FROM msg)"""

CHARS = """chars AS (
  SELECT unnest(string_split(text, '')) AS ch FROM documents WHERE length(text) > 0)"""

QUANTITY = "CAST(l_quantity AS INTEGER)"

ORACLE: dict[str, str] = {
    "time_usage_summary": "WITH " + SUMMARY + "\nSELECT * FROM summary",
    "time_usage_grouped": GROUPED.format(n="avg(primaryNeeds)", w="avg(work)", o="avg(other)"),
    "time_usage_grouped_sql": GROUPED.format(n="avg(primaryNeeds)", w="avg(work)", o="avg(other)"),
    "time_usage_grouped_typed": GROUPED.format(n="primaryNeeds", w="work", o="other"),
    "time_usage_grouped_custom": GROUPED.format(n="primaryNeeds", w="work", o="other"),
    "time_usage_csv_grouped": GROUPED.format(n="avg(primaryNeeds)", w="avg(work)", o="avg(other)"),
    "prefix_classified_sums": "WITH " + SURVEY + """
SELECT tucaseid, t010101 + t030101 + t180101 AS primaryNeeds_min,
       t050101 + t180501 AS work_min, t020101 + t120101 + t180201 AS other_min
FROM survey""",
    "bucket_size": """SELECT p_partkey + p_size AS place_plus_amount,
       CASE WHEN p_size < 25 THEN 'small' ELSE 'big' END AS size FROM part""",
    "named_column_sum": """SELECT p_partkey AS place, p_size AS amount, p_partkey + p_size AS sum_by_name,
       p_partkey + p_size AS sum_by_column, 2 AS n_columns FROM part""",
    "delimited_events": "WITH " + TRADE_EVENTS + "\nSELECT * FROM trade_events",
    "line_index": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS line_index FROM orders",
    "event_count": 'SELECT count(*) AS "count(1)" FROM events',
    "distinct_event_types": "SELECT DISTINCT event_type AS product_id FROM events ORDER BY 1",
    "amount_by_type": 'SELECT event_type AS product_id, sum(CAST(value AS FLOAT)) AS "sum(amount)" '
    "FROM events GROUP BY 1 ORDER BY 1",
    "events_ordered": "WITH " + TRADE_EVENTS + """
SELECT "timestamp", trade_id, product_id, amount FROM trade_events ORDER BY "timestamp", trade_id""",
    "min_amount_by_type": 'SELECT event_type AS product_id, min(CAST(value AS FLOAT)) AS "min(amount)" '
    "FROM events GROUP BY 1",
    "max_amount_by_type": 'SELECT event_type AS product_id, max(CAST(value AS FLOAT)) AS "max(amount)" '
    "FROM events GROUP BY 1",
    "product_summary_sql": """SELECT event_type AS product_id, count(*) AS n, sum(CAST(value AS FLOAT)) AS total,
       min(CAST(value AS FLOAT)) AS least, max(CAST(value AS FLOAT)) AS most
FROM events GROUP BY 1""",
    "saved_table": "WITH " + TRADE_EVENTS + "\nSELECT * FROM trade_events",
    "float_sum_by_flag": "SELECT l_returnflag, round(sum(CAST(l_extendedprice AS FLOAT)), 2) AS sum_price "
    "FROM lineitem GROUP BY 1",
    "accounts_by_person": "WITH " + ACCOUNTS + """
SELECT person_id, count(*) AS n, CAST(sum(balance) AS BIGINT) AS total, min(id) AS first_id, max(id) AS last_id,
       bool_or(type = 'CHEQUING') AS has_chequing, bool_and(type = 'CHEQUING') AS only_chequing,
       arg_min(balance, id) FILTER (WHERE type = 'CHEQUING') AS first_chequing
FROM accounts GROUP BY person_id""",
    "account_positions": "WITH " + ACCOUNTS + """
SELECT person_id, row_number() OVER (PARTITION BY person_id ORDER BY id) - 1 AS pos, id, type, balance
FROM accounts""",
    "person_accounts": "WITH " + JOINED + "\nSELECT id, name, age, earnings, n_accounts, total_balance FROM joined",
    "bucketed_person_accounts": "WITH " + JOINED + "\nSELECT id, name, age, earnings, n_accounts, total_balance FROM joined",
    "candidate_selections": "WITH " + JOINED + """
SELECT 'large_savings_high_earners' AS selection, id FROM joined
WHERE earnings > 50000 AND coalesce(first_savings_balance > 50000, false)
UNION ALL
SELECT 'broker_candidates', id FROM joined
WHERE earnings >= 50000 AND age BETWEEN 45 AND 55 AND coalesce(first_savings_balance > 10000, false) AND n_broker = 0
UNION ALL
SELECT 'credit_assistance_candidates', id FROM joined
WHERE earnings <= 40000 AND age BETWEEN 18 AND 30 AND coalesce(first_credit_balance <= -10000, false)""",
    "large_savings_high_earners": "WITH " + JOINED + """
SELECT id, name, age, earnings FROM joined
WHERE earnings > 50000 AND coalesce(first_savings_balance > 50000, false)""",
    "broker_candidates": "WITH " + JOINED + """
SELECT id, name, age, earnings FROM joined
WHERE earnings >= 50000 AND age >= 45 AND age <= 55
  AND coalesce(first_savings_balance > 10000, false) AND n_broker = 0""",
    "credit_assistance_candidates": "WITH " + JOINED + """
SELECT id, name, age, earnings FROM joined
WHERE earnings <= 40000 AND age >= 18 AND age <= 30
  AND coalesce(first_credit_balance <= -10000, false)""",
    "has_account_semi": "WITH " + PERSONS + ",\n" + ACCOUNTS + """
SELECT * FROM persons p
WHERE EXISTS (SELECT 1 FROM accounts a WHERE a.person_id = p.id AND a.type = 'BROKER')""",
    "has_no_account_anti": "WITH " + PERSONS + ",\n" + ACCOUNTS + """
SELECT * FROM persons p
WHERE NOT EXISTS (SELECT 1 FROM accounts a WHERE a.person_id = p.id AND a.type = 'BROKER')""",
    "only_accounts_of_type": "WITH " + JOINED + """
SELECT id, name, age, earnings FROM joined WHERE n_chequing = n_accounts""",
    "account_type_flags": "WITH " + JOINED + """
SELECT id, n_savings > 0 AS has_savings, n_savings = n_accounts AS only_savings,
       n_chequing > 0 AS has_chequing, n_chequing = n_accounts AS only_chequing,
       n_credit > 0 AS has_credit, n_credit = n_accounts AS only_credit,
       n_broker > 0 AS has_broker, n_broker = n_accounts AS only_broker
FROM joined""",
    "balance_comparators": "WITH " + JOINED + """
SELECT id,
       coalesce(first_broker_balance < 20000, false) AS lt,
       coalesce(first_broker_balance <= 20000, false) AS le,
       coalesce(first_broker_balance > 20000, false) AS gt,
       coalesce(first_broker_balance >= 20000, false) AS ge
FROM joined""",
    "age_bounds": "WITH " + PERSONS + """
SELECT id, age > 40 AS over_40, age >= 50 AS at_least_50, age <= 40 AS at_most_40,
       (age >= 18 AND age <= 30) AS age_18_to_30
FROM persons""",
    "sum_by_key_gathered": """SELECT l_suppkey AS "key", CAST(sum(l_linenumber) AS BIGINT) AS total
FROM lineitem GROUP BY 1 ORDER BY 1 LIMIT 10""",
    "sum_by_key_combined": """SELECT l_suppkey AS "key", CAST(sum(l_linenumber) AS BIGINT) AS total
FROM lineitem GROUP BY 1 ORDER BY 1 LIMIT 10""",
    "char_distribution": "WITH " + CHARS + "\nSELECT ch, count(*) AS n FROM chars GROUP BY ch",
    "char_occurrence_lists": """SELECT doc_id, ch, repeat('1', CAST(count(*) AS BIGINT)) AS ones FROM (
  SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents WHERE length(text) > 0)
GROUP BY doc_id, ch""",
    "char_occurrence_counts": "WITH " + CHARS + "\nSELECT ch, count(*) AS n FROM chars GROUP BY ch",
    "lenient_persons": "WITH " + PERSONS + """,
bad AS (
  SELECT *, CAST(id AS BIGINT) % 13 = 0 AS words, CAST(id AS BIGINT) % 11 = 0 AS cut FROM persons)
SELECT id, name, CASE WHEN NOT words THEN age END AS age, CASE WHEN NOT cut THEN earnings END AS earnings,
       CASE WHEN words OR cut THEN id || ' ,' || name || ',' || CASE WHEN words THEN 'old' ELSE CAST(age AS VARCHAR) END
            || CASE WHEN cut THEN '' ELSE ',' || CAST(earnings AS VARCHAR) END END AS reject
FROM bad""",
    "lenient_accounts": "WITH " + ACCOUNTS + """
SELECT id, person_id, CASE WHEN id % 11 <> 0 THEN type END AS type, balance,
       CASE WHEN id % 11 = 0 THEN concat_ws(',', CAST(id AS VARCHAR), person_id, 'GIFT', CAST(balance AS VARCHAR)) END AS reject
FROM accounts""",
    "char_totals": "WITH " + CHARS + "\nSELECT count(*) AS total_chars, count(*) AS total_chars_ones FROM chars",
    "lookup_with_default": f"""SELECT l_orderkey, l_linenumber, {QUANTITY} AS i, coalesce(n.n_regionkey, 0) AS m
FROM lineitem LEFT JOIN nation n ON n.n_nationkey = {QUANTITY}""",
    "lookup_penalty": f"""SELECT i, CAST(sum(v) AS BIGINT) AS total FROM (
  SELECT i, (i - m) * m AS v FROM (
    SELECT {QUANTITY} AS i, coalesce(p.p_size, 0) AS m
    FROM lineitem LEFT JOIN part p ON p.p_partkey = {QUANTITY})
  WHERE i > 2)
WHERE v < 0 GROUP BY i""",
    "running_metrics": """SELECT count(l_linenumber) AS n, CAST(sum(l_linenumber) AS BIGINT) AS total,
       avg(l_linenumber) AS mean FROM lineitem""",
    "csv_headed_roundtrip": """SELECT c_name, CAST(c_custkey AS DOUBLE) AS c_custkey,
       CAST(c_nationkey AS DOUBLE) AS c_nationkey, c_acctbal FROM customer""",
    "csv_positional_accounts": "WITH " + ACCOUNTS + "\nSELECT * FROM accounts",
    "csv_positional_persons": "WITH " + PERSONS + "\nSELECT * FROM persons",
    "message_format": "WITH " + MESSAGES + """
SELECT ip AS "key", concat_ws(',', CAST(millis AS VARCHAR), CAST(n AS VARCHAR), 'www.example.com', ip) AS value
FROM msg""",
    "message_parse": "WITH " + MESSAGES + """
SELECT ip AS "key", millis, n, 'www.example.com' AS host, ip FROM msg""",
    "stream_messages": "WITH " + MESSAGES + """
SELECT ip AS "key", millis, n, 'www.example.com' AS host, ip FROM msg""",
    "topic_messages": "WITH " + TOPIC + """
SELECT partition, "offset", "key", value FROM topic""",
    "topic_offset_range": "WITH " + TOPIC + """
SELECT partition, "offset", "key", value FROM topic WHERE "offset" >= ends // 3 AND "offset" < 2 * ends // 3""",
    "topic_stream": "WITH " + MESSAGES + """
SELECT ip AS "key", millis, n, 'www.example.com' AS host, ip FROM msg""",
    "topic_stream_restart": "WITH " + MESSAGES + """
SELECT ip AS "key", n, CAST(CASE WHEN n * 3 // (SELECT max(n) + 1 FROM msg) = 0 THEN 0 ELSE 1 END AS BIGINT) AS seen FROM msg""",
    "topic_copy": "WITH " + TOPIC + """
SELECT "key", value FROM topic""",
    "topic_effects": "WITH " + TOPIC + """
SELECT 'record.key: ' || "key" || ' record.value: ' || value AS line FROM topic""",
    "topic_key_totals": "WITH " + MESSAGES + """
SELECT ip AS "key", count(*) AS n, CAST(sum(n) AS BIGINT) AS total FROM msg GROUP BY ip""",
    "observed_write": """SELECT count(l_linenumber) AS n, CAST(sum(l_linenumber) AS BIGINT) AS total,
       avg(l_linenumber) AS mean FROM lineitem""",
    "observed_stream": "WITH " + MESSAGES + """
SELECT n * 3 // (SELECT max(n) + 1 FROM msg) AS part, count(*) AS n, CAST(sum(n) AS BIGINT) AS total FROM msg GROUP BY 1""",
}
