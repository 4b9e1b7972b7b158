"""The derived tables of ``sluice.sources.tables`` written as SQL: name -> (needs, select)."""

VIEWS: dict[str, tuple[str, str]] = {
    "ev": (
        "",
        """
SELECT event_id, ts AS "timestamp", user_id, event_type, value AS amount, k, props,
  CASE k % 4 WHEN 0 THEN 'books' WHEN 1 THEN 'clothing' WHEN 2 THEN 'electronics' ELSE 'food' END AS category,
  's' || user_id || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
  '10.' || (user_id % 4) || '.' || (k % 16) || '.' || user_id AS ip_address,
  CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
  '/' || event_type AS path,
  CASE WHEN event_type = 'error' THEN 'application' WHEN k % 2 = 0 THEN 'apache_access'
       ELSE 'nginx_access' END AS log_type,
  CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'purchase' AND k % 20 = 7 THEN 500
       WHEN event_type = 'click' AND k % 10 = 0 THEN 404 WHEN event_type = 'view' AND k % 25 = 0 THEN 301
       WHEN event_type = 'signup' THEN 201 ELSE 200 END AS status_code,
  CAST(round(value * 100) AS INTEGER) AS response_size,
  CASE k % 4 WHEN 0 THEN 'DEBUG' WHEN 1 THEN 'INFO' WHEN 2 THEN 'WARN' ELSE 'ERROR' END AS level,
  'com.example.' || CASE k % 4 WHEN 0 THEN 'books' WHEN 1 THEN 'clothing' WHEN 2 THEN 'electronics'
       ELSE 'food' END AS logger,
  event_type || ' ' || (k % 5) AS message,
  CAST(value AS DECIMAL(18,2)) AS m
FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)""",
    ),
    "usr": (
        "",
        """
SELECT c_custkey AS user_id, c_name AS name,
  'u' || c_custkey || '@' || CASE c_custkey % 3 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'yahoo.com'
    ELSE 'hotmail.com' END AS email,
  CAST(15 + c_custkey % 60 AS INTEGER) AS age,
  CAST(DATE '1994-01-01' + CAST(c_custkey % 1500 AS INTEGER) AS DATE) AS signup_date,
  c_mktsegment AS segment, c_nationkey
FROM customer""",
    ),
    "ord": (
        "",
        """
SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
  CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status FROM orders""",
    ),
    "det": (
        "",
        """
SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product_id, l_quantity AS quantity
FROM lineitem""",
    ),
    "prod": (
        "",
        """
SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_retailprice AS price FROM part""",
    ),
    "sales": (
        "",
        """
SELECT c_mktsegment AS salesperson, r_name AS region, strftime(o_orderdate, '%Y-%m') AS month,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sales
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
    ),
    "stock": (
        "",
        """
SELECT event_type AS symbol, CAST(ts AS DATE) AS date,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS price
FROM events GROUP BY ALL""",
    ),
    "cdc": (
        "",
        """
SELECT o_orderdate + to_days(CAST(step AS INTEGER)) AS "timestamp", operation, o_orderkey * 3 + step AS transaction_id,
  o_orderkey AS key,
  CASE WHEN operation = 'INSERT' THEN NULL WHEN operation = 'UPDATE' THEN old_status ELSE new_status END AS before_status,
  CASE WHEN operation = 'INSERT' THEN NULL ELSE amount END AS before_amount,
  CASE WHEN operation = 'INSERT' THEN old_status WHEN operation = 'UPDATE' THEN new_status END AS after_status,
  CASE WHEN operation <> 'DELETE' THEN amount END AS after_amount
FROM (
  SELECT o_orderkey, o_orderdate, o_orderstatus AS old_status,
    CASE WHEN o_orderstatus = 'F' THEN 'X' ELSE o_orderstatus END AS new_status,
    CAST(o_totalprice AS DECIMAL(18,2)) AS amount, 0 AS step, 'INSERT' AS operation FROM orders
  UNION ALL
  SELECT o_orderkey, o_orderdate, o_orderstatus,
    CASE WHEN o_orderstatus = 'F' THEN 'X' ELSE o_orderstatus END,
    CAST(o_totalprice AS DECIMAL(18,2)), 1, 'UPDATE' FROM orders WHERE o_orderstatus IN ('F', 'P')
  UNION ALL
  SELECT o_orderkey, o_orderdate, o_orderstatus,
    CASE WHEN o_orderstatus = 'F' THEN 'X' ELSE o_orderstatus END,
    CAST(o_totalprice AS DECIMAL(18,2)), 2, 'DELETE' FROM orders WHERE o_orderkey % 50 = 0)""",
    ),
    "rec": (
        "ev",
        """
SELECT event_id, "timestamp" AS received_at,
  CASE event_id % 20 WHEN 16 THEN NULL WHEN 17 THEN 'invalid-time-format'
    ELSE strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END AS ts_text,
  CASE WHEN event_id % 20 IN (16, 17) THEN NULL ELSE "timestamp" END AS ts,
  CASE WHEN event_id % 20 = 18 THEN NULL ELSE event_type END AS event_type,
  CASE WHEN event_id % 20 = 19 THEN NULL ELSE user_id END AS user_id,
  CASE WHEN event_id % 20 = 19 THEN 'invalid_user_id' ELSE CAST(user_id AS VARCHAR) END AS user_text,
  event_id % 20 = 19 AS bad_user, event_id % 20 AS turn, event_id % 20 < 16 AS good, session_id, ip_address, log_type,
  amount AS value, m
FROM ev""",
    ),
    "web": (
        "ev",
        """
SELECT event_id, date_trunc('second', "timestamp") AS "timestamp", ip_address, method, path,
  'HTTP/1.1' AS protocol, status_code,
  CASE WHEN status_code = 301 THEN 0 ELSE response_size END AS response_size,
  status_code = 301 AS no_size,
  CASE WHEN event_type = 'click' THEN '/home' END AS referer, 'curl/7.68.0' AS user_agent, log_type
FROM ev WHERE log_type <> 'application'""",
    ),
    "app": (
        "ev",
        """
SELECT event_id,
  CASE WHEN event_id % 50 = 0 THEN NULL ELSE "timestamp" END AS "timestamp",
  CASE WHEN event_id % 50 = 0 OR level = 'INFO' THEN 'INFO' ELSE level END AS level,
  CASE WHEN event_id % 50 = 0 THEN 'plain text ' || message ELSE message END AS message,
  CASE WHEN event_id % 50 = 0 THEN NULL WHEN level = 'DEBUG' THEN 'unknown' ELSE logger END AS logger,
  CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
  CASE WHEN event_id % 50 = 0 THEN 'application_text' ELSE 'application' END AS log_type
FROM ev WHERE log_type = 'application'""",
    ),
}
