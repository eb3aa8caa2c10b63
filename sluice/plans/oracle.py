"""Independent SQL twins of the registered queries, in a dialect DuckDB runs.

The mapped lakehouse tables are CTEs over the raw driver tables; each oracle names
the CTEs it needs. Oracles are written from the operator's definition, not from the
Spark plan, so a match is evidence of correctness rather than of shared code.
"""

from __future__ import annotations

NL = "chr(10)"

CTES: dict[str, str] = {
    "dim_store": """
SELECT concat('S', lpad(CAST(s_suppkey AS VARCHAR), 5, '0')) AS store_id,
       concat('R', lpad(CAST(r_regionkey + 1 AS VARCHAR), 2, '0')) AS route_id,
       r_name AS route_name, s_name AS store_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "fact_sales": """
SELECT l_orderkey AS order_id, l_linenumber AS line_no,
       concat('S', lpad(CAST(l_suppkey AS VARCHAR), 5, '0')) AS store_id,
       concat(p_brand, ' ', p_name) AS sku,
       CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INT) AS quantity,
       CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
       CAST(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(18,2)) AS amount,
       l_linestatus = 'O' AS is_active, CAST(l_shipdate AS DATE) AS sale_date
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "gold_pricing": """
SELECT concat('N', lpad(CAST(n_nationkey AS VARCHAR), 2, '0')) AS route_id, n_name AS route_name,
       lower(r_name) AS region, p_partkey AS item_id,
       CAST(p_retailprice AS DECIMAL(18,2)) AS base_price,
       CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(1.05 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS adjusted_price
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
     JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "seasonal_baseline": """
SELECT p_type AS season, p_partkey AS item_id, CAST(p_retailprice AS DECIMAL(18,2)) AS base_price FROM part""",
    "pricing_baseline": """
SELECT p_partkey AS item_id, CAST(p_retailprice AS DECIMAL(18,2)) AS base_price FROM part""",
    "payload": """
SELECT event_id AS request_id, ts AS request_time, concat('u', CAST(user_id AS VARCHAR)) AS requester,
       event_type AS endpoint, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code,
       CAST(round(value * 100, 0) AS BIGINT) AS execution_duration_ms,
       props AS request, concat(event_type, ':', props) AS response
FROM events""",
    "runs": """
SELECT event_id AS run_id, event_type AS model_name,
       CASE user_id % 3 WHEN 0 THEN 'dev' WHEN 1 THEN 'staging' ELSE 'prod' END AS env,
       ts AS start_time, CASE WHEN event_id % 17 <> 0 THEN value END AS mae,
       CASE WHEN event_id % 5 = 0 THEN 105.0::DOUBLE ELSE 100.0::DOUBLE END AS max_acceptable_mae,
       CASE WHEN event_id % 13 <> 0 THEN CAST(50 + 25 * (event_id % 3) AS INT) END AS n_estimators, CAST(4 + event_id % 5 AS INT) AS max_depth,
       CASE WHEN event_id % 7 <> 0 THEN 'day_of_week,store_id' WHEN event_id % 2 = 0 THEN 'day_of_week' END AS features,
       CAST(json_extract_string(props, '$.k') AS INT) AS min_samples_leaf
FROM events""",
    "change_files": """
SELECT doc_id, change_id, path, text, kind,
       length(text) - length(replace(text, chr(10), '')) + 1 AS n_lines
FROM (SELECT doc_id, CAST(floor(doc_id / 5) AS BIGINT) AS change_id,
             concat('src/', source, '/d', CAST(doc_id AS VARCHAR),
                    CASE doc_id % 4 WHEN 0 THEN '.py' WHEN 1 THEN '.sql' WHEN 2 THEN '.yml' ELSE '.md' END) AS path,
             text || CASE doc_id % 13
               WHEN 0 THEN chr(10) || 'rows = df.collect()' WHEN 1 THEN chr(10) || 'SELECT * FROM sales'
               WHEN 2 THEN chr(10) || 'SELECT store FROM sales ORDER BY 2' WHEN 3 THEN chr(10) || 'source = mlops_prod.sales'
               WHEN 4 THEN chr(10) || 'CREATE TABLE dailySales (id INT)' WHEN 5 THEN chr(10) || 'catalog: "main_prod"'
               WHEN 6 THEN chr(10) || 'home = os.environ["HOME"]' WHEN 7 THEN repeat('SELECT * FROM sales' || chr(10), 60)
               WHEN 8 THEN repeat('-- note' || chr(10), 230) WHEN 9 THEN chr(10) || 'password = "correct-horse-battery"'
               ELSE '' END AS text,
             CASE WHEN doc_id % 6 = 1 THEN 'two' WHEN doc_id % 6 = 2 THEN 'rename' WHEN doc_id % 12 = 3 THEN 'binary' ELSE 'new' END AS kind
      FROM documents)""",
    "responses": r"""
SELECT l.doc_id AS response_id, CASE WHEN quality = 1 THEN 'APPROVE' ELSE 'BLOCK' END AS truth, l.doc_id % 9 AS shape, j,
       CASE l.doc_id % 9
         WHEN 0 THEN j WHEN 1 THEN concat('```json', chr(10), j, chr(10), '```')
         WHEN 2 THEN concat('Decision follows: ', j, ' done {') WHEN 3 THEN substring(j, 1, length(j) - 12)
         WHEN 4 THEN 'no json here' WHEN 5 THEN replace(j, '"decision": "', '"decision": "X')
         WHEN 6 THEN '{"decision": "BLOCK", ' || substring(j, 2)
         WHEN 7 THEN replace(j, '", "findings"', '\n", "findings"')
         ELSE substring(j, 1, length(j) - 2) || '\' END AS raw
FROM (SELECT doc_id, quality, concat('{"decision": "', CASE WHEN quality = 1 THEN 'approve' ELSE 'BLOCK' END,
        '", "findings": [{"rule_id": "ML-03", "severity": "blocker", "message": "doc ', CAST(doc_id AS VARCHAR),
        '"}], "justification": "generated text"}') AS j FROM labels) l""",
    "rule_docs": """
SELECT lang AS category, doc_id, concat('### [', upper(lang), '-', CAST(doc_id AS VARCHAR), '] Title ',
       CAST(doc_id AS VARCHAR), chr(10), '- **Severity:** ',
       CASE doc_id % 3 WHEN 0 THEN 'BLOCKER' WHEN 1 THEN 'SUGGESTION' ELSE 'STYLE' END,
       chr(10), '- **Citation:** Rules > ', lang, chr(10), chr(10), text) AS block
FROM documents""",
    "handbook": r"""
SELECT 'Items' AS category, item_id AS doc_id, text, item_id % 7 <> 6 AS titled, 'IT-' || CAST(item_id AS VARCHAR) AS rule_id,
       'Item ' || CAST(item_id AS VARCHAR) AS title,
       CASE WHEN item_id % 5 = 4 THEN 'SUGGESTION' WHEN item_id % 3 = 0 THEN 'BLOCKER' WHEN item_id % 3 = 1 THEN 'SUGGESTION' ELSE 'STYLE' END AS severity_hint,
       CASE WHEN item_id % 5 = 4 THEN 'Handbook › Items › IT-' || CAST(item_id AS VARCHAR) ELSE 'Items > ' || CAST(item_id AS VARCHAR) END AS citation
FROM benchmark""",
}


def with_ctes(names: list[str], body: str) -> str:
    """Prefix ``body`` with the named mapping CTEs (and any ad-hoc ones in ``body``)."""
    parts = [f"{n} AS ({CTES[n].strip()})" for n in names]
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
