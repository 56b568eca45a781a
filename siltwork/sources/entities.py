"""Entity tables and change feeds derived from the star-schema tables, in SQL that Spark and other engines share."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Each text names the tables or entities that it reads in braces.
SQL: dict[str, str] = {
    "owner": "SELECT concat('OWN-', CAST(c_custkey AS STRING)) AS entity_master_owner_id, c_name AS owner_name, c_mktsegment AS owner_type FROM {customer}",
    "asset": """SELECT concat('AST-', CAST(p_partkey AS STRING)) AS entity_master_asset_id, p_name AS asset_name, p_type AS asset_type,
        CASE p_size % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS currency, CASE WHEN p_size % 5 = 0 THEN 'inactive' ELSE 'active' END AS status FROM {part}""",
    "position": """SELECT DISTINCT concat('POS-', CAST(o_custkey AS STRING), '-', CAST(l_partkey AS STRING)) AS entity_master_position_id,
        concat('OWN-', CAST(o_custkey AS STRING)) AS owner_id, concat('AST-', CAST(l_partkey AS STRING)) AS asset_id, 'open' AS status FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "txn": """SELECT concat('TXN-', lpad(CAST(l_orderkey AS STRING), 9, '0'), lpad(CAST(l_partkey AS STRING), 7, '0'), lpad(CAST(l_suppkey AS STRING), 6, '0'), CAST(l_linenumber AS STRING)) AS transaction_id,
        min(concat('POS-', CAST(o_custkey AS STRING), '-', CAST(l_partkey AS STRING))) AS position_id, min(CASE l_returnflag WHEN 'R' THEN 'SELL' WHEN 'A' THEN 'DIV' ELSE 'BUY' END) AS transaction_type,
        min(CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DOUBLE)) AS amount,
        min(CASE o_custkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END) AS currency, min(CAST(l_shipdate AS DATE)) AS trade_date
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber""",
    "ord_keyed": """SELECT concat('ORD-', lpad(CAST(o_orderkey AS STRING), 9, '0')) AS order_id, c_name AS customer_name,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'refunded' END AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderkey FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "ord": "SELECT order_id, customer_name, status, amount FROM {ord_keyed}",
    "feed": """SELECT order_id, customer_name, 'completed' AS status, CAST(amount + 10 AS DECIMAL(18,2)) AS amount, 'update_postimage' AS _change_type, CAST(1 AS BIGINT) AS _commit_version FROM {ord_keyed} WHERE o_orderkey % 7 = 0
        UNION ALL SELECT order_id, customer_name, status, amount, 'delete', CAST(2 AS BIGINT) FROM {ord_keyed} WHERE o_orderkey % 11 = 0
        UNION ALL SELECT order_id, customer_name, status, amount, 'update_postimage', CAST(2 AS BIGINT) FROM {ord_keyed} WHERE o_orderkey % 13 = 0 AND o_orderkey % 11 <> 0
        UNION ALL SELECT concat('NEW-', substr(order_id, 5)), customer_name, status, amount, 'insert', CAST(3 AS BIGINT) FROM {ord_keyed} WHERE o_orderkey % 17 = 0""",
    # Orders with what a source may get wrong.
    "spoilt": """SELECT CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE order_id END AS order_id, CASE WHEN o_orderkey % 19 = 0 THEN '' WHEN o_orderkey % 23 = 0 THEN NULL ELSE customer_name END AS customer_name,
        CASE WHEN o_orderkey % 29 = 0 THEN 'shipped' ELSE status END AS status, CASE WHEN o_orderkey % 37 = 0 THEN -amount ELSE amount END AS amount, o_orderkey FROM {ord_keyed}""",
    "fact": "SELECT event_id, user_id, event_type, CAST(round(CAST(value AS DECIMAL(18,4)), 2) AS DECIMAL(18,2)) AS value, ts, props FROM {events}",
}


def names_in(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An entity, or a table of the folder."""
    return query(spark, sf_dir, SQL[name]) if name in SQL else spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return spark.sql(text, **{n: frame(spark, sf_dir, n) for n in names_in(text)})


def plain_sql(text: str, parts: dict[str, str] | None = None) -> str:
    """The text as one statement over the tables, entities (and further named parts) as WITH parts."""
    known = SQL if parts is None else parts
    needed: dict[str, str] = {}
    named = lambda m: f"e_{m[1]}" if m[1] in known else m[1]

    def need(t: str) -> None:
        for n in names_in(t):
            if n in known and n not in needed:
                need(known[n])
                needed[n] = re.sub(r"\{(\w+)\}", named, known[n])

    need(text)
    body = re.sub(r"\{(\w+)\}", named, text).strip()
    return f"WITH {', '.join(f'e_{n} AS ({t})' for n, t in needed.items())} {body}" if needed else body
