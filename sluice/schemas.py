"""Named schemas: the lake's own record types and the tables the queries run on."""

from __future__ import annotations

from pyspark.sql.types import StructType

RECORDS = {
    "user": "user_id BIGINT NOT NULL, name STRING, email STRING, age INT, signup_date DATE, "
    "preferences MAP<STRING, STRING>, tags ARRAY<STRING>",
    "event": "event_id BIGINT NOT NULL, user_id BIGINT NOT NULL, event_type STRING NOT NULL, "
    "timestamp TIMESTAMP NOT NULL, value DOUBLE, properties MAP<STRING, STRING>",
    "order": "order_id BIGINT NOT NULL, user_id BIGINT NOT NULL, product_id BIGINT NOT NULL, "
    "amount DECIMAL(10,2) NOT NULL, order_date DATE NOT NULL, status STRING NOT NULL",
    "lake_event": "id BIGINT, timestamp TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "amount DOUBLE, category STRING",
    "stream_event": "timestamp STRING, user_id BIGINT, event_type STRING, value DOUBLE, "
    "session_id STRING, ip_address STRING, category STRING",
    "web_log": "timestamp TIMESTAMP, ip_address STRING, method STRING, path STRING, "
    "protocol STRING, status_code INT, response_size INT, referer STRING, user_agent STRING, "
    "log_type STRING",
    "app_log": "timestamp STRING, level STRING, message STRING, logger STRING, thread STRING, "
    "exception STRING, user_id STRING, request_id STRING",
}

TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}


def record_schema(name: str) -> StructType:
    if name not in RECORDS:
        raise ValueError(f"no schema named {name!r}; known: {', '.join(sorted(RECORDS))}")
    return StructType.fromDDL(RECORDS[name])
