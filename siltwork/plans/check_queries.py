"""Registered queries of the single checks: each row's outcome under one check, with the SQL that tells the same."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.functions.checks import fails
from siltwork.operators import compare, dataset_checks
from siltwork.plans.queries import ORACLE_SQL, QUERIES, oracle, register
from siltwork.sources.entities import frame, query

#: Inputs of the row checks, in SQL that both engines run: id, and columns that are spoilt by arithmetic on keys.
INPUTS = {
    "orders": "SELECT o_orderkey AS id, order_id, customer_name, status, CAST(amount AS DOUBLE) AS amount, CASE WHEN o_orderkey % 41 = 0 THEN concat(' ', upper(status)) WHEN o_orderkey % 43 = 0 THEN '  ' ELSE status END AS raw FROM {spoilt}",
    "names": """SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN 'ALL UPPER' WHEN 1 THEN 'all lower' WHEN 2 THEN 'Title Case' WHEN 3 THEN 'Sentence case' END AS name FROM {orders}""",
    "lines": "SELECT l_orderkey * 10 + l_linenumber AS id, l_quantity AS quantity, l_discount AS discount, l_extendedprice AS price FROM {lineitem}",
    "dates": """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 29 = 0 THEN 'soon' WHEN o_orderkey % 31 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS day_text,
        CASE WHEN o_orderkey % 29 = 0 THEN '12:00' WHEN o_orderkey % 31 = 0 THEN NULL ELSE concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 10:11:12') END AS time_text FROM {orders}""",
    "ships": "SELECT l_orderkey * 10 + l_linenumber AS id, CAST(l_shipdate AS DATE) AS shipped, CAST(o_orderdate AS DATE) AS ordered FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey",
    "events": "SELECT event_id AS id, ts, props, CASE WHEN event_id % 11 = 0 THEN 'no json' WHEN event_id % 13 = 0 THEN '{{\"z\": 1}}' WHEN event_id % 17 = 0 THEN NULL ELSE props END AS doc FROM {events}",
    "nested": """SELECT event_id AS id, CASE event_id % 9 WHEN 0 THEN concat('{{"a": {{"b": ', CAST(user_id AS STRING), '}}, "c": [{{"d": 2.5}}, {{"d": 1, "e": "x"}}], "m": {{"k": true}}}}') WHEN 1 THEN '{{"a": {{"b": "x"}}, "c": []}}' WHEN 2 THEN '{{"a": {{}}, "c": []}}'
        WHEN 3 THEN '{{"a": {{"b": 1}}, "c": [{{"d": 1}}, {{"d": true}}]}}' WHEN 4 THEN '{{"a": {{"b": 1}}, "c": [{{"e": "no d"}}]}}' WHEN 5 THEN '{{"c": [{{"d": 0}}], "m": {{"k": 1}}}}' WHEN 6 THEN '{{"a": null, "c": [null], "more": [1, {{}}]}}' WHEN 7 THEN '{{"a": {{"b": 5000000000}}, "c": 7}}' ELSE concat('{{"c": [], "a": {{"b": ', CAST(event_id AS STRING)) END AS doc FROM {events}""",
    "places": """SELECT c_custkey AS id, concat(substr(r_name, 1, 2), '-', CASE WHEN c_custkey % 5 = 0 THEN 'ZZZ' WHEN c_custkey % 7 = 0 THEN lower(substr(n_name, 1, 3)) ELSE substr(n_name, 1, 3) END) AS subdivision, CASE WHEN c_custkey % 11 = 0 THEN 'QQ' WHEN c_custkey % 13 = 0 THEN NULL ELSE substr(r_name, 1, 2) END AS country,
        lpad(CAST(c_nationkey * 4 + c_custkey % 3 AS STRING), 3, '0') AS number FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "people": """SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN concat('user', CAST(c_custkey AS STRING), '@example.com') WHEN 1 THEN concat('user', CAST(c_custkey AS STRING), '.example.com') WHEN 2 THEN 'a@b' END AS email,
        CASE c_custkey % 3 WHEN 0 THEN concat('123e4567-e89b-12d3-a456-', lpad(CAST(c_custkey AS STRING), 12, '0')) WHEN 1 THEN concat('123e4567-e89b-92d3-c456-', lpad(CAST(c_custkey AS STRING), 12, '0')) ELSE 'none' END AS uuid,
        CASE c_custkey % 4 WHEN 0 THEN concat('123-45-', lpad(CAST(1 + c_custkey % 9999 AS STRING), 4, '0')) WHEN 1 THEN '000-12-3456' WHEN 2 THEN '12-345-6789' END AS ssn,
        CASE c_custkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'usd' WHEN 3 THEN 'QQQ' END AS currency, CASE c_custkey % 5 WHEN 0 THEN 'DE' WHEN 1 THEN 'FR' WHEN 2 THEN 'de' WHEN 3 THEN 'QQ' END AS country,
        CASE c_custkey % 5 WHEN 0 THEN 'de' WHEN 1 THEN 'fr' WHEN 2 THEN 'DE' WHEN 3 THEN 'qq' END AS language, CASE c_custkey % 5 WHEN 0 THEN 'DE-BY' WHEN 1 THEN 'FR-75' WHEN 2 THEN 'DE_BY' WHEN 3 THEN 'QQ-1' END AS subdivision,
        CASE c_custkey % 4 WHEN 0 THEN concat('10.0.', CAST(c_custkey % 300 AS STRING), '.7') WHEN 1 THEN concat('192.168.1.', CAST(c_custkey % 256 AS STRING)) WHEN 2 THEN '1.2.3' END AS ip,
        CASE c_custkey % 4 WHEN 0 THEN '2001:db8::1' WHEN 1 THEN 'fe80::1' WHEN 2 THEN '2001:db8:::1' END AS ip6 FROM {customer}""",
    "vectors": "SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN NULL ELSE label END AS label, vec_id FROM {embeddings}",
}
NOW = "2024-01-15 12:00:00"

#: (query, input, check's arguments, what fails in SQL); the check is the query's name up to a double underscore.
ROW: list[tuple[str, str, dict[str, Any], str]] = [
    ("is_not_null", "orders", {"column": "customer_name"}, "customer_name IS NULL"),
    ("is_null", "orders", {"column": "customer_name"}, "customer_name IS NOT NULL"),
    ("is_not_empty", "orders", {"column": "raw", "trim_strings": True}, "trim(raw) = ''"),
    ("is_empty", "orders", {"column": "customer_name"}, "customer_name <> ''"),
    ("is_not_null_and_not_empty", "orders", {"column": "customer_name"}, "customer_name IS NULL OR customer_name = ''"),
    ("is_null_or_empty", "orders", {"column": "customer_name"}, "customer_name IS NOT NULL AND customer_name <> ''"),
    ("is_in_list", "orders", {"column": "status", "allowed": ["'pending'", "'completed'"]}, "status NOT IN ('pending', 'completed')"),
    ("is_in_list__any_case", "orders", {"column": "raw", "allowed": ["'Pending'", "'completed'", "status"], "case_sensitive": False}, "lower(raw) NOT IN ('pending', 'completed', lower(status))"),
    ("is_not_in_list", "orders", {"column": "status", "forbidden": ["'shipped'"]}, "status IN ('shipped')"),
    ("is_not_null_and_is_in_list", "orders", {"column": "customer_name", "allowed": ["'Customer#000000001'", "''"]}, "customer_name IS NULL OR customer_name NOT IN ('Customer#000000001', '')"),
    ("has_valid_string_case", "names", {"column": "name", "case": "upper"}, "name <> upper(name)"),
    ("has_valid_string_case__lower", "names", {"column": "name", "case": "lower"}, "name <> lower(name)"),
    ("has_valid_string_case__title", "names", {"column": "name", "case": "title"}, "name <> 'Title Case'"),
    ("has_valid_string_case__sentence", "names", {"column": "name", "case": "sentence"}, "name <> concat(upper(substr(name, 1, 1)), lower(substr(name, 2)))"),
    ("sql_expression", "orders", {"expression": "amount IS NOT NULL AND amount > 0"}, "NOT (amount IS NOT NULL AND amount > 0)"),
    ("sql_expression__negate", "orders", {"expression": "amount < 1000 OR status = 'shipped'", "negate": True}, "amount < 1000 OR status = 'shipped'"),
    ("is_in_range", "lines", {"column": "quantity", "min_limit": 10, "max_limit": 40}, "NOT (quantity BETWEEN 10 AND 40)"),
    ("is_not_in_range", "lines", {"column": "quantity", "min_limit": 10, "max_limit": "price / 1000"}, "quantity BETWEEN 10 AND price / 1000"),
    ("is_not_less_than", "lines", {"column": "discount", "limit": 0.03}, "discount < 0.03"),
    ("is_not_greater_than", "lines", {"column": "discount", "limit": 0.07}, "discount > 0.07"),
    ("is_equal_to", "lines", {"column": "quantity", "value": 25}, "quantity <> 25"),
    ("is_equal_to__tolerance", "lines", {"column": "quantity", "value": 25, "abs_tolerance": 4.0}, "abs(quantity - 25) > 4"),
    ("is_not_equal_to", "lines", {"column": "quantity", "value": 25}, "quantity = 25"),
    ("is_valid_date", "dates", {"column": "day_text", "date_format": "yyyy-MM-dd"}, "day_text IS NOT NULL AND try_cast(day_text AS DATE) IS NULL"),
    ("is_valid_timestamp", "dates", {"column": "time_text", "timestamp_format": "yyyy-MM-dd HH:mm:ss"}, "time_text IS NOT NULL AND length(time_text) <> 19"),
    ("is_not_in_future", "events", {"column": "ts", "offset": 3600, "curr_timestamp": NOW}, f"ts > TIMESTAMP '{NOW}' + INTERVAL 1 HOUR"),
    ("is_not_in_near_future", "events", {"column": "ts", "offset": 86400, "curr_timestamp": NOW}, f"ts > TIMESTAMP '{NOW}' AND ts < TIMESTAMP '{NOW}' + INTERVAL 1 DAY"),
    ("is_older_than_n_days", "ships", {"column": "shipped", "days": 365, "curr_date": "1998-01-01"}, "NOT (shipped < DATE '1998-01-01' - INTERVAL 365 DAY)"),
    ("is_older_than_col2_for_n_days", "ships", {"column1": "ordered", "column2": "shipped", "days": 30}, "NOT (ordered < shipped - INTERVAL 30 DAY)"),
    ("is_data_fresh", "events", {"column": "ts", "max_age_minutes": 1440, "base_timestamp": NOW}, f"ts < TIMESTAMP '{NOW}' - INTERVAL 1 DAY"),
    ("regex_match", "orders", {"column": "order_id", "regex": "^ORD-[0-9]*[02468]$"}, "NOT regexp_matches(order_id, '^ORD-[0-9]*[02468]$')"),
    ("regex_match__negate", "orders", {"column": "order_id", "regex": "7", "negate": True}, "regexp_matches(order_id, '7')"),
    ("is_valid_email", "people", {"column": "email"}, "id % 4 <> 0 AND email IS NOT NULL"),
    ("is_valid_uuid", "people", {"column": "uuid"}, "uuid = 'none'"),
    ("is_valid_uuid__strict", "people", {"column": "uuid", "strict": True}, "id % 3 <> 0"),
    ("is_valid_national_id", "people", {"column": "ssn"}, "id % 4 <> 0 AND ssn IS NOT NULL"),
    ("is_valid_currency_code", "people", {"column": "currency"}, "currency NOT IN ('USD', 'EUR')"),
    ("is_valid_country_code", "people", {"column": "country", "case_sensitive": False}, "country NOT IN ('DE', 'FR', 'de')"),
    ("is_valid_language_code", "people", {"column": "language"}, "language NOT IN ('de', 'fr')"),
    ("is_valid_subdivision_code", "people", {"column": "subdivision", "country_column": "country"}, "subdivision NOT IN ('DE-BY', 'FR-75')"),
    ("is_valid_ipv4_address", "people", {"column": "ip"}, "ip = '1.2.3' OR (id % 4 = 0 AND id % 300 > 255)"),
    ("is_ipv4_address_in_cidr", "people", {"column": "ip", "cidr_block": "10.0.0.0/17"}, "ip IS NOT NULL AND NOT (id % 4 = 0 AND id % 300 < 128)"),
    ("is_valid_json", "events", {"column": "doc"}, "doc IS NOT NULL AND NOT json_valid(doc)"),
    ("has_json_keys", "events", {"column": "doc", "keys": ["k"]}, "doc IS NOT NULL AND NOT (json_valid(doc) AND doc <> '{{\"z\": 1}}')"),
    ("is_valid_ipv6_address", "people", {"column": "ip6"}, "id % 4 = 2"),
    ("is_ipv6_address_in_cidr", "people", {"column": "ip6", "cidr_block": "2001:db8::/32"}, "id % 4 IN (1, 2)"),
    ("has_valid_json_schema__nested", "nested", {"column": "doc", "schema": "a STRUCT<b: INT NOT NULL>, c ARRAY<STRUCT<d: DOUBLE NOT NULL, e: STRING>> NOT NULL, m MAP<STRING, BOOLEAN>"}, "id % 9 NOT IN (0, 6)"),
    ("has_valid_json_schema", "events", {"column": "doc", "schema": "k BIGINT NOT NULL"}, "doc IS NOT NULL AND NOT (json_valid(doc) AND doc <> '{{\"z\": 1}}')"),
]


def _row_check(name: str, source: str, arguments: dict[str, Any], sql: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(spark, sf_dir, INPUTS[source]).select("id", fails(name.split("__")[0], arguments).alias("failed"))

    QUERIES[name] = run
    ORACLE_SQL[name] = oracle(f"SELECT id, coalesce(({sql.replace('{{', '<<').replace('}}', '>>')}), false) AS failed FROM ({INPUTS[source].replace('{{', '<<').replace('}}', '>>')})").replace("<<", "{").replace(">>", "}")


for _name, _of, _arguments, _sql in ROW:
    _row_check(_name, _of, _arguments, _sql)


@register("is_not_null_and_not_empty_array", "SELECT vec_id AS id, vec_id % 7 = 0 OR vec_id % 5 = 0 AS failed FROM {embeddings}")
def is_not_null_and_not_empty_array(spark, sf_dir):
    e = F.col("embedding").cast("array<double>")
    spoilt = F.when(F.col("vec_id") % 7 == 0, None).when(F.col("vec_id") % 5 == 0, F.array().cast("array<double>")).otherwise(e)
    return frame(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), spoilt.alias("embedding")).select("id", fails("is_not_null_and_not_empty_array", {"column": "embedding"}).alias("failed"))


# --- checks over all rows ---------------------------------------------------------------------------------------


@register("is_unique", "SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS failed FROM {lineitem}")
def is_unique(spark, sf_dir):
    rows = dataset_checks.is_unique(frame(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "failed", ["l_orderkey", "l_linenumber"])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "failed")


@register("dup_over_partition", "SELECT o_orderkey, count(*) OVER (PARTITION BY customer_name, status) > 1 AS failed FROM {spoilt}")
def dup_over_partition(spark, sf_dir):
    return dataset_checks.dup_over_partition(frame(spark, sf_dir, "spoilt"), "failed", ["customer_name", "status"]).select("o_orderkey", "failed")


@register("foreign_key", "SELECT l_orderkey, l_linenumber, l_partkey, NOT EXISTS (SELECT 1 FROM {part} WHERE p_partkey = l_partkey AND p_partkey % 50 <> 0) AS failed FROM {lineitem}")
def foreign_key(spark, sf_dir):
    rows = frame(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return dataset_checks.foreign_key(rows, "failed", ["l_partkey"], frame(spark, sf_dir, "part").where("p_partkey % 50 <> 0"), ["p_partkey"])


@register("foreign_key__negate", "SELECT l_orderkey, l_linenumber, l_partkey, EXISTS (SELECT 1 FROM {part} WHERE p_partkey = l_partkey AND p_partkey % 50 = 0) AS failed FROM {lineitem}")
def foreign_key_negate(spark, sf_dir):
    rows = frame(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return dataset_checks.foreign_key(rows, "failed", ["l_partkey"], frame(spark, sf_dir, "part").where("p_partkey % 50 = 0"), ["p_partkey"], negate=True)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")


@register("is_aggr_not_greater_than", "SELECT event_id, (SELECT count(*) FROM {events} b WHERE b.user_id = a.user_id) > 70 AS failed FROM {events} a")
def is_aggr_not_greater_than(spark, sf_dir):
    return dataset_checks.is_aggr_not_greater_than(_events(spark, sf_dir), "failed", "*", 70, "count", ["user_id"]).select("event_id", "failed")


@register("is_aggr_not_less_than", "SELECT event_id, n < 1000 AS failed FROM {events}, (SELECT count(DISTINCT user_id) AS n FROM {events})")
def is_aggr_not_less_than(spark, sf_dir):
    return dataset_checks.is_aggr_not_less_than(_events(spark, sf_dir), "failed", "user_id", 1000, "count_distinct").select("event_id", "failed")


@register("is_aggr_equal", "SELECT event_id, n <> 66 AS failed FROM {events} JOIN (SELECT user_id AS u, count(*) AS n FROM {events} GROUP BY 1) ON user_id = u")
def is_aggr_equal(spark, sf_dir):
    return dataset_checks.is_aggr_equal(_events(spark, sf_dir), "failed", "event_id", 66, "count", ["user_id"]).select("event_id", "failed")


@register("is_aggr_not_equal", "SELECT event_id, abs(n - 66) <= 5 AS failed FROM {events} JOIN (SELECT user_id AS u, count(*) AS n FROM {events} GROUP BY 1) ON user_id = u")
def is_aggr_not_equal(spark, sf_dir):
    return dataset_checks.is_aggr_not_equal(_events(spark, sf_dir), "failed", "event_id", 66, "count", ["user_id"], abs_tolerance=5).select("event_id", "failed")


@register("is_aggr_not_greater_than__median", "SELECT event_id, m > 50 AS failed FROM {events} JOIN (SELECT user_id AS u, median(value) AS m FROM {events} GROUP BY 1) ON user_id = u")
def is_aggr_not_greater_than_median(spark, sf_dir):
    """Exact medians of groups by rank selection."""
    return dataset_checks.is_aggr_not_greater_than(frame(spark, sf_dir, "events").select("event_id", "user_id", "value"), "failed", "value", 50, "median", ["user_id"]).select("event_id", "failed")


@register("is_aggr_not_less_than__median", "SELECT l_orderkey, l_linenumber, l_partkey, m < 30000 AS failed FROM {lineitem}, (SELECT median(l_extendedprice) AS m FROM {lineitem})")
def is_aggr_not_less_than_median(spark, sf_dir):
    rows = frame(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return dataset_checks.is_aggr_not_less_than(rows, "failed", "l_extendedprice", 30000, "median").drop("l_extendedprice")


@register("aggr_matches_dataset__median", "SELECT coalesce(a.user_id, b.user_id) AS user_id, a.m AS value, b.m AS ref_value FROM (SELECT user_id, median(value) AS m FROM {events} GROUP BY 1) a FULL JOIN (SELECT user_id, median(value) AS m FROM {events} WHERE event_id % 7 <> 0 GROUP BY 1) b ON a.user_id = b.user_id WHERE a.m IS DISTINCT FROM b.m")
def aggr_matches_dataset_median(spark, sf_dir):
    rows = frame(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return compare.aggr_matches_dataset(rows, rows.where("event_id % 7 <> 0"), "value", aggr_type="median", group_by=["user_id"])


#: A code table: each nation's letters under its region's, and numbers.
CODES = "SELECT substr(r_name, 1, 2) AS country, concat(substr(r_name, 1, 2), '-', substr(n_name, 1, 3)) AS subdivision, lpad(CAST(n_nationkey * 4 AS STRING), 3, '0') AS number FROM {nation} JOIN {region} ON n_regionkey = r_regionkey"


@register("is_valid_code__subdivision", f"SELECT p.id, country IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ({CODES}) c WHERE c.subdivision = p.subdivision AND c.country = p.country) AS failed FROM ({INPUTS['places']}) p")
def is_valid_code_subdivision(spark, sf_dir):
    """Subdivisions by a code table, with the row's country."""
    rows = dataset_checks.is_valid_code(query(spark, sf_dir, INPUTS["places"]), "failed", "subdivision", query(spark, sf_dir, CODES), "subdivision", "country", "country")
    return rows.select("id", "failed")


@register("is_valid_code__numeric", f"SELECT p.id, p.number NOT IN (SELECT number FROM ({CODES})) AS failed FROM ({INPUTS['places']}) p")
def is_valid_code_numeric(spark, sf_dir):
    """Numeric codes by a code table."""
    return dataset_checks.is_valid_code(query(spark, sf_dir, INPUTS["places"]), "failed", "number", query(spark, sf_dir, CODES), "number").select("id", "failed")


@register("has_no_outliers", "SELECT l_orderkey, l_linenumber, l_partkey, 0.6745 * abs(l_extendedprice - m) / mad > 1.5 AS failed FROM {lineitem}, (SELECT m, median(abs(l_extendedprice - m)) AS mad FROM {lineitem}, (SELECT median(l_extendedprice) AS m FROM {lineitem}) GROUP BY m)")
def has_no_outliers(spark, sf_dir):
    return dataset_checks.has_no_outliers(frame(spark, sf_dir, "lineitem"), "failed", "l_extendedprice", 1.5).select("l_orderkey", "l_linenumber", "l_partkey", "failed")


@register("has_no_aggr_outliers", """SELECT event_id, b.bad AS failed FROM {events} JOIN (SELECT d, n >= 7 AND abs(v - mean) > 1.0 * sd AS bad FROM (SELECT d, v, avg(v) OVER w AS mean, stddev(v) OVER w AS sd, count(*) OVER w AS n
    FROM (SELECT date_trunc('day', ts) AS d, count(*) AS v FROM {events} GROUP BY 1) WINDOW w AS (ORDER BY d ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))) b ON date_trunc('day', ts) = b.d""")  # fmt: skip
def has_no_aggr_outliers(spark, sf_dir):
    return dataset_checks.has_no_aggr_outliers(_events(spark, sf_dir), "failed", "*", "ts", "count", sigma=1.0).select("event_id", "failed")


@register("is_data_fresh_per_time_window", """SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS window_start, count(event_id) AS n FROM (SELECT unnest(generate_series((SELECT date_trunc('hour', min(ts)) FROM {events}), (SELECT date_trunc('hour', max(ts)) FROM {events}), INTERVAL 1 HOUR)) AS h) s
    LEFT JOIN {events} ON date_trunc('hour', ts) = h GROUP BY 1 HAVING count(event_id) < 12""")  # fmt: skip
def is_data_fresh_per_time_window(spark, sf_dir):
    return dataset_checks.is_data_fresh_per_time_window(_events(spark, sf_dir), "ts", 60, 12).select(F.col("window_start").cast("string").alias("window_start"), "n")


@register("has_no_gaps_per_time_window", """SELECT event_type, user_id, CAST(count(*) AS BIGINT) AS gaps, CAST(sum(date_diff('day', w, n) - 1) AS BIGINT) AS empty_days FROM (SELECT event_type, user_id, w, coalesce(lead(w) OVER (PARTITION BY event_type, user_id ORDER BY w), TIMESTAMP '2024-01-31 00:00:00') AS n
    FROM (SELECT DISTINCT event_type, user_id, date_trunc('day', ts) AS w FROM {events})) WHERE date_diff('day', w, n) > 1 GROUP BY 1, 2""")  # fmt: skip
def has_no_gaps_per_time_window(spark, sf_dir):
    gaps = dataset_checks.has_no_gaps_per_time_window(_events(spark, sf_dir), "ts", 1440, ["event_type", "user_id"], trailing_gap_until="2024-01-31 00:00:00")
    return gaps.groupBy("event_type", "user_id").agg(F.count("*").alias("gaps"), F.sum("empty_windows").alias("empty_days"))


@register("has_valid_schema", "SELECT o_orderkey, true AS failed FROM {orders}")
def has_valid_schema(spark, sf_dir):
    rows = frame(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return dataset_checks.has_valid_schema(rows, "failed", "o_orderkey BIGINT, o_custkey STRING").select("o_orderkey", "failed")


@register("sql_query", "SELECT event_id, user_id IN (SELECT user_id FROM {events} GROUP BY user_id HAVING count(DISTINCT event_type) < 5 OR count(*) > 75) AS failed FROM {events}")
def sql_query(spark, sf_dir):
    text = "SELECT user_id, count(DISTINCT event_type) < 5 OR count(*) > 75 AS odd FROM {{ input_view }} GROUP BY user_id"
    return dataset_checks.sql_query(_events(spark, sf_dir), "failed", text, "odd", ["user_id"]).select("event_id", "failed")
