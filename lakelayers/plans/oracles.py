"""The same results in DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

EVENT_TIME = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"
EVENT_JSON = (
    "to_json({'id': event_id, 'user_id': user_id, 'event_type': event_type, 'value': value, "
    f"'props': props, 'ts': {EVENT_TIME}}})"
)
# As landed: the id is kept as text there.
LANDED_JSON = (
    "to_json({'id': CAST(event_id AS VARCHAR), 'user_id': user_id, 'event_type': event_type, "
    f"'value': value, 'props': props, 'ts': {EVENT_TIME}}})"
)
INFERRED_JSON = (
    f"to_json({{'event_type': event_type, 'id': event_id, 'props': props, 'ts': {EVENT_TIME}, "
    "'user_id': user_id, 'value': value})"
)
AUDIT = ", '2024-05-06 07:08:09' AS processed_at"
LINE_JSON = (
    "to_json({'l_orderkey': l_orderkey, 'l_partkey': l_partkey, 'l_suppkey': l_suppkey, "
    "'l_linenumber': l_linenumber, 'l_quantity': l_quantity, 'l_extendedprice': l_extendedprice, "
    "'l_discount': l_discount, 'l_tax': l_tax, 'l_returnflag': l_returnflag, "
    "'l_linestatus': l_linestatus, 'l_shipdate': strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f')})"
)

BODIES = """
bodies AS (
  SELECT event_id, CASE event_id % 8
    WHEN 0 THEN printf('[{"id":%d,"user":%d},{"id":%d,"type":"%s"}]', event_id, user_id, event_id, event_type)
    WHEN 1 THEN printf('{"total":1,"data":[{"id":%d,"user":%d}]}', event_id, user_id)
    WHEN 2 THEN printf('{"id":%d,"type":"%s"}', event_id, event_type)
    WHEN 3 THEN CAST(event_id AS VARCHAR)
    WHEN 4 THEN '{"data":null}'
    WHEN 5 THEN printf('{"data":[{"id":%d,"user":%d}', event_id, user_id)
    WHEN 6 THEN printf('[{"id":%d,"user":%d},7,null]', event_id, user_id)
    ELSE '[]' END AS body
  FROM events
),
parsed AS (
  SELECT event_id, CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS j FROM bodies
),
records AS (
  SELECT event_id, unnest(CASE
    WHEN json_type(j) = 'ARRAY' THEN CAST(j AS JSON[])
    WHEN json_type(j) = 'OBJECT' AND NOT list_contains(json_keys(j), 'data') THEN [j]
    WHEN json_type(j) = 'OBJECT' AND json_type(j, '$.data') = 'ARRAY'
      THEN CAST(json_extract(j, '$.data') AS JSON[])
    ELSE CAST([] AS JSON[]) END) AS record
  FROM parsed
)
"""


DOCUMENT_FILES = """
WITH lines AS (
  SELECT doc_id, source, doc_id // 5000 AS block,
         CAST(to_json({'doc_id': doc_id, 'text': text, 'source': source}) AS VARCHAR) || chr(10) AS line
  FROM documents
)
SELECT source, block, CAST(sum(strlen(line)) AS BIGINT) AS size,
       sha256(string_agg(line, '' ORDER BY doc_id)) AS sha256
FROM lines GROUP BY source, block"""


LINE_BAGS = [
    "SELECT CASE WHEN l_linenumber <> 3 THEN l_returnflag END AS flag, l_linenumber AS number, l_partkey % 10 AS part FROM lineitem",
    "SELECT CASE WHEN l_linenumber <> 3 THEN l_returnflag END AS flag, l_linenumber AS number, l_suppkey % 10 AS part "
    "FROM lineitem WHERE l_orderkey % 3 <> 0",
]


def _sessions(key: str, minutes: int) -> str:
    """Gaps and islands."""
    return f"""
WITH gaps AS (
  SELECT {key}, ts, ts - lag(ts) OVER w > INTERVAL {minutes} MINUTE AS begins FROM events WINDOW w AS (PARTITION BY {key} ORDER BY ts)
),
islands AS (SELECT {key}, ts, count(*) FILTER (begins) OVER (PARTITION BY {key} ORDER BY ts) AS island FROM gaps)
SELECT {key}, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_end,
       count(*) AS events
FROM islands GROUP BY {key}, island"""


def _layered(expression: str, columns: str = "") -> str:
    return f"""
SELECT CAST(event_id AS VARCHAR) AS record_id, CAST({expression} AS VARCHAR) AS payload_json{columns}
FROM events"""


def _lower_contains(column: str, words: tuple[str, ...]) -> str:
    return " OR ".join(f"contains(lower({column}), '{word}')" for word in words)


def _layer_of(database: str, table: str, unknown: str) -> str:
    cases = " ".join(
        f"WHEN contains(lower({database}), '{layer}') OR contains(lower({table}), '{layer}') THEN '{layer}'"
        for layer in ("raw", "bronze", "silver", "gold")
    )
    return f"CASE {cases} ELSE '{unknown}' END"


ORACLES: dict[str, str] = {
    "json_scan": """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props FROM events""",
    "json_scan_permissive": """
SELECT CASE WHEN event_id % 100 <> 0 THEN event_id END AS event_id,
       CASE WHEN event_id % 100 <> 0 THEN user_id END AS user_id,
       CASE WHEN event_id % 100 <> 0 THEN event_type END AS event_type,
       CASE WHEN event_id % 100 <> 0 THEN value END AS value,
       CASE WHEN event_id % 100 = 0 THEN '{oops ' || event_id END AS bad_line
FROM events""",
    "csv_drop_ingest": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "csv_rejects": """
SELECT CASE WHEN c_custkey % 5 IN (0, 3) THEN c_custkey END AS k,
       CASE WHEN c_custkey % 5 IN (0, 3) THEN c_name END AS name,
       CASE c_custkey % 5 WHEN 1 THEN 'x,' || c_name WHEN 2 THEN c_custkey || ',' || c_name || ',extra'
            WHEN 4 THEN CAST(c_custkey AS VARCHAR) END AS line
FROM customer""",
    "table_scan_filtered": """
SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey = 3""",
    "external_table_scan": """
SELECT event_id, user_id, value, event_type FROM events WHERE event_type IN ('click', 'purchase')""",
    "partition_repair": """
SELECT o_orderstatus, count(*) FILTER (o_orderstatus = 'O') AS rows_before, count(*) AS rows_after
FROM orders GROUP BY o_orderstatus""",
    "partition_register": """
WITH landed AS (
  SELECT o_orderkey, o_orderpriority || '''' || 's 5%/é=' AS priority,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus
  FROM orders
)
SELECT *, (SELECT count(DISTINCT priority) FROM landed WHERE o_orderstatus = 'O') AS added_0,
       (SELECT count(DISTINCT (coalesce(o_orderstatus, ''), priority)) FROM landed WHERE coalesce(o_orderstatus, '') <> 'O') AS added_1
FROM landed""",
    "unnest_responses": f"""
WITH {BODIES}
SELECT event_id, CAST(record AS VARCHAR) AS record FROM records WHERE json_type(record) = 'OBJECT'""",
    "unreadable_responses": f"""
WITH {BODIES}
SELECT event_id, body FROM bodies JOIN parsed USING (event_id)
WHERE j IS NULL OR json_type(j) NOT IN ('ARRAY', 'OBJECT')
   OR (list_contains(json_keys(j), 'data') AND json_type(j, '$.data') <> 'ARRAY')""",
    "response_numbers": """
SELECT l_orderkey, l_linenumber,
       printf('{"amount":12345678901234567890.%010d1,"id":%d}', l_orderkey, l_orderkey) AS record
FROM lineitem""",
    "landing_rejects": f"""
WITH {BODIES}, bad AS (
  SELECT event_id, body FROM bodies JOIN parsed USING (event_id)
  WHERE j IS NULL OR json_type(j) NOT IN ('ARRAY', 'OBJECT')
     OR (list_contains(json_keys(j), 'data') AND json_type(j, '$.data') <> 'ARRAY')
)
SELECT event_id, body, (SELECT count(*) FROM bodies) AS bodies, (SELECT count(*) FROM bad) AS unreadable,
       (SELECT count(*) FROM records WHERE json_type(record) = 'OBJECT') AS records,
       (SELECT count(*) FROM records WHERE json_type(record) = 'OBJECT') AS landed
FROM bad""",
    "landing_empty": """
SELECT o_orderstatus, count(*) AS orders, CAST(0 AS BIGINT) AS landed, false AS folder_exists
FROM orders GROUP BY o_orderstatus""",
    "enrich_defaults": """
SELECT event_id, CASE event_id % 4
  WHEN 0 THEN printf('{"id":%d,"ingested_at":"2024-05-06T07:08:09Z","source":"shop","entity_type":"%s"}',
                     event_id, event_type)
  WHEN 1 THEN printf('{"id":%d,"source":null,"ingested_at":"2024-05-06T07:08:09Z","entity_type":"%s"}',
                     event_id, event_type)
  WHEN 2 THEN printf('{"source":"own","id":%d,"entity_type":"}","ingested_at":"2024-05-06T07:08:09Z"}',
                     event_id)
  ELSE printf('{"ingested_at":"2024-05-06T07:08:09Z","source":"shop","entity_type":"%s"}', event_type)
  END AS record
FROM events""",
    "landing_batch_ids": """
WITH numbered AS (
  SELECT event_id, event_type, row_number() OVER (ORDER BY event_id) - 1 AS i FROM events
)
SELECT event_id, event_type,
       printf('20240506_070809_%03d_%06d', i // 500 + 1, i % 500) AS record_id,
       printf('20240506_070809_batch_%03d', i // 500 + 1) AS batch_id,
       printf('shop_data_20240506_070809_batch_%03d.jsonl', i // 500 + 1) AS file_name
FROM numbered""",
    "global_ordinal": """
WITH numbered AS (
  SELECT l_returnflag, row_number() OVER (ORDER BY l_returnflag) - 1 AS i FROM lineitem
)
SELECT l_returnflag, min(i) AS first_ordinal, max(i) AS last_ordinal, count(i) AS ordinals,
       CAST(sum(i % 1000003) AS BIGINT) AS checksum
FROM numbered GROUP BY l_returnflag""",
    "file_ordinal": """
WITH numbered AS (SELECT row_number() OVER () - 1 AS i FROM lineitem)
SELECT min(i) AS first_ordinal, max(i) AS last_ordinal, count(i) AS ordinals,
       CAST(sum(i % 1000003) AS BIGINT) AS checksum
FROM numbered""",
    "landing_envelope": """
WITH numbered AS (
  SELECT event_id, user_id, event_type, row_number() OVER (ORDER BY event_id) - 1 AS i FROM events
)
SELECT event_id, user_id, event_type,
       '2024-05-06T07:08:09Z' AS request_timestamp,
       'https://example.com/events' AS request_url,
       CAST(CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS INTEGER) AS response_status_code,
       CAST(0 AS INTEGER) AS response_time_ms,
       '2024-05-06T07:08:09Z' AS ingestion_timestamp,
       'raw_events' AS ingestion_job,
       'shop' AS ingestion_source,
       'api_polling' AS ingestion_method,
       printf('20240506_070809_%03d_%06d', i // 500 + 1, i % 500) AS record_id,
       printf('20240506_070809_batch_%03d', i // 500 + 1) AS batch_id,
       printf('shop_data_20240506_070809_batch_%03d.jsonl', i // 500 + 1) AS file_name
FROM numbered""",
    "land_jsonl": """
WITH numbered AS (
  SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders
)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS o_orderdate,
       '2024-05-06T07:08:09Z' AS ingested_at, 'shop' AS source, 'orders' AS entity_type,
       printf('20240506_070809_%03d_%06d', i // 500 + 1, i % 500) AS record_id,
       printf('20240506_070809_batch_%03d', i // 500 + 1) AS batch_id,
       printf('shop_data_20240506_070809_batch_%03d.jsonl', i // 500 + 1) AS file_name,
       'raw_orders' AS ingestion_job, CAST(0 AS INTEGER) AS response_status_code
FROM numbered""",
    "land_jsonl_partitioned": "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders",
    "bronze_normalize": _layered(EVENT_JSON, AUDIT),
    "bronze_inferred": _layered(INFERRED_JSON),
    "bronze_text_payload": _layered(EVENT_JSON),
    "silver_standardize": """
WITH bronze AS (
  SELECT CASE WHEN doc_id % 10 <> 0 THEN CAST(doc_id AS VARCHAR) END AS record_id,
         CAST(to_json({'doc_id': doc_id, 'text': text, 'lang': lang}) AS VARCHAR) AS payload_json
  FROM documents
)
SELECT record_id, payload_json, CAST(length(payload_json) AS INTEGER) AS payload_size,
       sha256(payload_json) AS payload_hash
FROM bronze WHERE record_id IS NOT NULL""",
    "gold_count": "SELECT count(l_orderkey) AS records_total, 'lineitem' AS entity_type FROM lineitem",
    "bronze_quarantine": """
SELECT CASE WHEN event_id % 100 > 1 THEN CAST(event_id AS VARCHAR) END AS record_id,
       CASE WHEN event_id % 100 > 1
            THEN CAST(to_json({'id': CAST(event_id AS VARCHAR), 'user_id': user_id,
                               'event_type': event_type}) AS VARCHAR) END AS payload_json,
       CASE event_id % 100 WHEN 0 THEN '{"payload":{"id":"' || event_id
            WHEN 1 THEN '{"payload":{"id":"' || event_id || '","user_id":"none"}}' END AS line,
       CASE event_id % 100 WHEN 0 THEN false WHEN 1 THEN true END AS partly_read
FROM events""",
    "bronze_layer": _layered(LANDED_JSON, AUDIT),
    "silver_layer": _layered(
        LANDED_JSON,
        f"""{AUDIT}, '2024-05-06 07:08:09' AS standardized_at,
       CAST(length(CAST({LANDED_JSON} AS VARCHAR)) AS INTEGER) AS payload_size,
       sha256(CAST({LANDED_JSON} AS VARCHAR)) AS payload_hash""",
    ),
    "gold_layer": "SELECT count(event_id) AS records_total, 'events' AS entity_type, '2024-05-06 07:08:09' AS computed_at FROM events",
    "full_chain": f"""
WITH {BODIES}
SELECT count(json_extract(record, '$.id')) AS records_total, 'events' AS entity_type
FROM records WHERE json_type(record) = 'OBJECT'""",
    "chain_rerun": _layered(
        LANDED_JSON,
        f""",
       CAST(length(CAST({LANDED_JSON} AS VARCHAR)) AS INTEGER) AS payload_size,
       sha256(CAST({LANDED_JSON} AS VARCHAR)) AS payload_hash, '2024-05-06' AS load_id,
       (SELECT count(*) FROM events) AS records_total""",
    ),
    "landing_rerun": f"""
WITH {BODIES},
kept AS (SELECT event_id, json_extract_string(record, '$.id') AS record_id FROM records WHERE json_type(record) = 'OBJECT'),
totals AS (SELECT event_id % 2 AS odd, count(*) AS records FROM kept GROUP BY event_id % 2),
lost AS (SELECT event_id % 2 AS side, count(*) FILTER (event_id % 8 IN (3, 4, 5)) AS unreadable FROM events GROUP BY event_id % 2)
SELECT CASE odd WHEN 1 THEN 'a/b c' ELSE '2024-05-06' END AS load_id, record_id, records, unreadable
FROM kept JOIN totals ON event_id % 2 = odd JOIN lost ON side = odd""",
    "load_metrics": """
WITH bronze AS (SELECT event_id % 100 = 0 AS bad, event_id % 7 > 0 AS named FROM events),
counts AS (
  SELECT count(*) AS lines, count(*) FILTER (bad) AS bad, count(*) FILTER (NOT bad) AS good,
         count(*) FILTER (NOT bad AND named) AS named
  FROM bronze
)
SELECT '2024-05-06' AS run_id, step, metric, CAST(value AS BIGINT) AS value FROM (
  SELECT 'bronze' AS step, 'rows_in' AS metric, lines AS value FROM counts
  UNION ALL SELECT 'bronze', 'rows_out', good FROM counts
  UNION ALL SELECT 'bronze', 'rows_malformed', bad FROM counts
  UNION ALL SELECT 'silver', 'rows_in', good FROM counts
  UNION ALL SELECT 'silver', 'rows_out', named FROM counts
  UNION ALL SELECT 'silver', 'rows_malformed', 0 FROM counts
  UNION ALL SELECT 'gold', 'rows_in', named FROM counts
  UNION ALL SELECT 'gold', 'rows_out', 1 FROM counts
  UNION ALL SELECT 'gold', 'rows_malformed', 0 FROM counts
)""",
    "lineitem_silver": f"""
WITH bronze AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS record_id, CAST({LINE_JSON} AS VARCHAR) AS payload_json
  FROM lineitem
)
SELECT record_id, payload_json, CAST(length(payload_json) AS INTEGER) AS payload_size,
       sha256(payload_json) AS payload_hash
FROM bronze WHERE record_id IS NOT NULL""",
    "bronze_incremental": """
SELECT CAST(o_orderkey AS VARCHAR) AS record_id,
       CAST(to_json({'id': CAST(o_orderkey AS VARCHAR), 'o_orderstatus': o_orderstatus}) AS VARCHAR)
         AS payload_json
FROM orders""",
    "append_by_name": """
SELECT c_custkey AS party_key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""",
    "overwrite_partitions": """
SELECT o_orderkey, o_totalprice,
       CAST(CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS INTEGER) AS version, o_orderstatus
FROM orders""",
    "merge_upsert": """
WITH target AS (SELECT * FROM orders WHERE o_orderkey % 4 <> 3),
changes AS (
  SELECT CASE WHEN o_orderkey % 35 <> 0 THEN o_orderkey END AS o_orderkey, o_totalprice * 2 AS o_totalprice,
         CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus
  FROM orders WHERE o_orderkey % 5 = 0
)
SELECT t.o_orderkey, coalesce(c.o_totalprice, t.o_totalprice) AS o_totalprice, 1 AS version,
       coalesce(c.o_orderstatus, t.o_orderstatus) AS o_orderstatus
FROM target t LEFT JOIN changes c ON t.o_orderkey = c.o_orderkey
WHERE c.o_orderkey IS NULL OR c.o_orderkey % 10 <> 0
UNION ALL
SELECT o_orderkey, o_totalprice, NULL, o_orderstatus FROM changes
WHERE o_orderkey IS NULL OR (o_orderkey % 10 <> 0 AND o_orderkey % 4 = 3)""",
    "skip_empty_write": """
SELECT o_orderkey, o_totalprice, CAST(1 AS INTEGER) AS version, o_orderstatus, false AS written
FROM orders""",
    "create_external_json": "SELECT event_id, value, event_type FROM events",
    "create_managed": "SELECT p_partkey, p_name, p_size, p_brand FROM part",
    "content_sha256": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
    "file_manifest": DOCUMENT_FILES,
    "file_digest_stream": DOCUMENT_FILES,
    "list_files": f"SELECT source, block, size FROM ({DOCUMENT_FILES})",
    "manifest_diff": """
WITH previous AS (
  SELECT 'pages/' || page_id || '.html' AS path, sha256(html) AS h FROM pages
), current AS (
  SELECT CASE WHEN page_id % 7 = 0 THEN 'new/' || page_id ELSE 'pages/' || page_id || '.html' END AS path,
         sha256(CASE WHEN page_id % 5 = 0 THEN html || ' ' ELSE html END) AS h
  FROM pages
)
SELECT coalesce(p.path, c.path) AS path,
       CASE WHEN p.path IS NULL THEN 'new' WHEN c.path IS NULL THEN 'gone'
            WHEN p.h = c.h THEN 'same' ELSE 'changed' END AS status,
       p.h AS previous_sha256, c.h AS sha256
FROM previous p FULL OUTER JOIN current c ON p.path = c.path""",
    "mask_full": """
WITH prepared AS (
  SELECT c_custkey,
         CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN '' END AS api_token,
         CASE c_custkey % 2 WHEN 0 THEN 0 ELSE c_nationkey END AS secret_code,
         CASE c_custkey % 4 WHEN 0 THEN 'api_token' WHEN 1 THEN 'region' WHEN 2 THEN 'PASSWORD'
              ELSE 'note' END AS name,
         CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN c_mktsegment ELSE '' END AS value
  FROM customer
)
SELECT c_custkey,
       CASE WHEN api_token <> '' THEN '********' ELSE api_token END AS api_token,
       CASE WHEN secret_code <> 0 THEN '********' ELSE CAST(secret_code AS VARCHAR) END AS secret_code,
       name, value,
       CASE WHEN name IN ('api_token', 'PASSWORD') AND value <> '' THEN '********' ELSE value END
         AS masked_value,
       CASE WHEN name IN ('api_token', 'PASSWORD') AND c_custkey % 5 <> 0 THEN '********'
            ELSE CAST(c_custkey % 5 AS VARCHAR) END AS masked_number,
       CASE WHEN value <> '' THEN '********' ELSE value END AS masked_segment
FROM prepared""",
    "mask_partial": """
WITH prepared AS (
  SELECT c_custkey, c_mktsegment,
         CASE c_custkey % 5 WHEN 0 THEN c_name WHEN 1 THEN c_mktsegment WHEN 2 THEN ''
              WHEN 4 THEN '12345678' END AS value
  FROM customer
)
SELECT c_custkey,
       CASE WHEN value IS NULL OR value = '' THEN 'None' WHEN length(value) <= 8 THEN '***'
            ELSE value[:4] || '...' || value[-4:] END AS masked,
       CASE WHEN length(c_mktsegment) <= 8 THEN '***'
            ELSE c_mktsegment[:4] || '...' || c_mktsegment[-4:] END AS segment
FROM prepared""",
    "clip_text": """
SELECT page_id,
       CASE WHEN length(url) > 100 THEN url[:97] || '...' ELSE url END AS url,
       CASE WHEN length(html) > 100 THEN html[:97] || '...' ELSE html END AS html,
       CASE page_id % 4
         WHEN 0 THEN CASE WHEN length(url) > 100 THEN url[:97] || '...' ELSE url END
         WHEN 1 THEN CASE WHEN html = '' THEN '(empty)' ELSE '********' END
         WHEN 2 THEN CASE WHEN length(html) > 100 THEN html[:97] || '...' ELSE html END
         ELSE '(empty)' END AS preview
FROM pages""",
    "typed_parse": r"""
WITH tokens AS (
  SELECT event_id,
         ['true', '1', 'YES', 'on', 'off', 'no', '0', ' 5 ', '1e3', '5.0', '1_000', '-17', 'x', '', '.5',
          '9223372036854775808', 'nan', '-Infinity', 'inf', chr(160) || '7' || chr(8195), NULL
         ][event_id % 21 + 1] AS t
  FROM events
), stripped AS (
  SELECT event_id, replace(replace(t, chr(160), ''), chr(8195), '') AS t FROM tokens
), parsed AS (
  SELECT event_id, t,
         CASE WHEN lower(t) IN ('true', '1', 'yes') THEN true
              WHEN lower(t) IN ('false', '0', 'no') THEN false END AS as_bool,
         lower(t) IN ('true', '1', 'yes', 'on') AS as_lenient,
         CASE WHEN regexp_full_match(t, '\s*[+-]?\d+(_\d+)*\s*')
              THEN TRY_CAST(replace(trim(t), '_', '') AS BIGINT) END AS as_int,
         CASE WHEN t IN ('nan', '-Infinity', 'inf') THEN CAST(t AS DOUBLE)
              WHEN regexp_full_match(t, '\s*[+-]?((\d+(_\d+)*)(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*')
              THEN TRY_CAST(replace(trim(t), '_', '') AS DOUBLE) END AS as_float
  FROM stripped
)
SELECT event_id, as_bool, as_lenient, CASE WHEN t IS NULL THEN -1 ELSE as_int END AS as_int, as_float,
       concat_ws(',',
         CASE WHEN t IS NOT NULL AND as_bool IS NULL THEN 'as_bool' END,
         CASE WHEN t IS NOT NULL AND as_int IS NULL THEN 'as_int' END,
         CASE WHEN t IS NOT NULL AND as_float IS NULL THEN 'as_float' END) AS rejected_columns
FROM parsed""",
    "validate_rules": """
WITH prepared AS (
  SELECT c_custkey, c_mktsegment, c_acctbal,
         CASE c_custkey % 7 WHEN 1 THEN NULL WHEN 2 THEN '  ' WHEN 3 THEN lower(c_name) ELSE c_name END
           AS c_name
  FROM customer
)
SELECT c_custkey, trim(c_name) AS c_name, lower(c_mktsegment) AS c_mktsegment, c_acctbal,
       CASE WHEN c_name IS NULL THEN 'c_name_not_null'
            WHEN trim(c_name) = '' THEN 'c_name_not_blank'
            WHEN NOT starts_with(c_name, 'Customer#') THEN 'c_name_has_prefix'
            WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN 'c_mktsegment_one_of'
            WHEN NOT c_acctbal > 0 THEN 'c_acctbal_positive' END AS failed_rule,
       c_mktsegment || '/' AS segment_path
FROM prepared""",
    "quarantine": """
SELECT o_orderkey, o_orderstatus, o_totalprice,
       CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'o_orderstatus_one_of'
            WHEN o_totalprice NOT BETWEEN 1000 AND 400000 THEN 'o_totalprice_range' END AS failed_rule
FROM orders""",
    "survivorship_merge": """
WITH w AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'w' || c_name END AS name,
         CASE WHEN c_custkey % 5 = 0 THEN CAST(-1.0 AS DOUBLE) END AS balance
  FROM customer WHERE c_mktsegment = 'BUILDING'
), c AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 7 <> 0 THEN 'c' || c_name END AS name,
         CASE WHEN c_custkey % 11 = 0 THEN c_mktsegment END AS segment
  FROM customer WHERE c_acctbal > 0
), d AS (
  SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance,
         CASE WHEN c_custkey % 13 <> 0 THEN 'NONE' END AS segment
  FROM customer
)
SELECT d.k AS c_custkey,
       coalesce(w.name, c.name, d.name) AS name,
       CASE WHEN w.name IS NOT NULL THEN 'workflow' WHEN c.name IS NOT NULL THEN 'command'
            WHEN d.name IS NOT NULL THEN 'default' END AS name_source,
       coalesce(w.balance, d.balance) AS balance,
       CASE WHEN w.balance IS NOT NULL THEN 'workflow' WHEN d.balance IS NOT NULL THEN 'default' END
         AS balance_source,
       coalesce(c.segment, d.segment) AS segment,
       CASE WHEN c.segment IS NOT NULL THEN 'command' WHEN d.segment IS NOT NULL THEN 'default' END
         AS segment_source
FROM d LEFT JOIN w ON w.k = d.k LEFT JOIN c ON c.k = d.k
UNION ALL
SELECT NULL, 'nobody', 'workflow', NULL, NULL, NULL, NULL FROM customer WHERE c_custkey % 3 = 0""",
    "classify_messages": f"""
SELECT conv_id, turn,
       CASE WHEN {_lower_contains('text', ('ment',))} THEN 'first'
            WHEN {_lower_contains('text', ('ent', 'tion'))} THEN 'second'
            WHEN {_lower_contains('text', ('the', 'der'))} THEN 'third' ELSE 'other' END AS class
FROM conversations""",
    "classify_errors": """
SELECT event_id,
       event_type || ' failed: ' || ['Configuration of Spark is missing', 'INVALID value', 'Validation',
         'Spark job lost', 'bad SQL text', 'Glue access denied', 'no SECRET', 'disk full'
       ][event_id % 8 + 1] AS message,
       ['CONFIG_ERROR', 'VALIDATION_ERROR', 'VALIDATION_ERROR', 'SPARK_ERROR', 'SPARK_ERROR',
        'AWS_SERVICE_ERROR', 'AWS_SERVICE_ERROR', 'GENERIC_ERROR'][event_id % 8 + 1] AS error_code
FROM events""",
    "lineage_audit": f"""
WITH steps AS (
  SELECT p_partkey,
         ['raw_zone', 'Bronze_Zone', 'silver_zone', 'gold_zone', 'sales', ''][p_partkey % 6 + 1]
           AS source_database,
         lower(replace(p_type, ' ', '_'))
           || ['', '', '', '', '', '_withdrawals', '_gold'][p_partkey % 7 + 1] AS source_table,
         ['bronze_zone', 'silver_zone', 'GOLD_zone', 'raw_zone', 'mart'][p_partkey // 5 % 5 + 1]
           AS target_database,
         CASE WHEN p_partkey % 6 = 3 THEN '' ELSE lower(replace(p_type, ' ', '_')) END AS target_table
  FROM part
), layered AS (
  SELECT *, {_layer_of('source_database', 'source_table', 'raw')} AS source_layer,
         {_layer_of('target_database', 'target_table', 'bronze')} AS target_layer
  FROM steps
), judged AS (
  SELECT *, source_layer = target_layer
            OR (source_layer, target_layer) IN (('raw', 'bronze'), ('bronze', 'silver'), ('silver', 'gold'))
            AS legal
  FROM layered
)
SELECT p_partkey, source_database, source_table, target_database, target_table, source_layer, target_layer,
       CASE WHEN source_layer = 'raw' THEN 'spark_catalog.' ELSE 'glue_catalog.' END
         || source_database || '.' || source_table AS source_full_name,
       CASE WHEN target_layer = 'raw' THEN 'spark_catalog.' ELSE 'glue_catalog.' END
         || target_database || '.' || target_table AS target_full_name,
       source_layer <> target_layer AS is_cross_layer,
       CASE WHEN source_layer = target_layer THEN source_layer || '_processing'
            ELSE source_layer || '_to_' || target_layer END AS pipeline_type,
       legal AND target_table <> '' AND source_database <> '' AS is_valid,
       CASE WHEN source_database = '' THEN 'Database name cannot be empty'
            WHEN target_table = '' THEN 'Table name cannot be empty'
            WHEN NOT legal THEN 'Invalid pipeline: ' || source_layer || ' -> ' || target_layer
              || '. Valid transitions from ' || source_layer || ': '
              || CASE source_layer WHEN 'raw' THEN '[''bronze'']' WHEN 'bronze' THEN '[''silver'']'
                      WHEN 'silver' THEN '[''gold'']' ELSE '[]' END END AS message
FROM judged""",
    "run_metrics": """
WITH counts AS (
  SELECT count(*) AS rows_in, count(*) FILTER (l_quantity > 5) AS rows_out FROM lineitem
)
SELECT 'run-1' AS run_id, 'silver' AS step, 'rows_in' AS metric, rows_in AS value FROM counts
UNION ALL SELECT 'run-1', 'silver', 'rows_out', rows_out FROM counts
UNION ALL SELECT 'run-1', 'silver', 'rows_rejected', rows_in - rows_out FROM counts""",
    "stream_silver": """
WITH bounds AS (SELECT epoch_us(min(ts)) AS a, (epoch_us(max(ts)) - epoch_us(min(ts))) // 3 AS third FROM events),
owned AS (SELECT e.*, least((epoch_us(ts) - a) // third, 2) AS own FROM events e, bounds),
placed AS (SELECT *, own + CASE WHEN event_id % 50 = 1 AND own < 2 THEN 1 ELSE 0 END AS arrives FROM owned),
batches AS (
  SELECT event_id, event_type, ts, arrives AS batch FROM placed
  UNION ALL SELECT event_id, event_type, ts, least(arrives + 1, 2) FROM placed WHERE event_id % 10 = 0
),
marks AS (
  SELECT b.batch, (SELECT epoch_ms(max(ts)) - 3600000 FROM batches x WHERE x.batch < b.batch) AS mark
  FROM (SELECT DISTINCT batch FROM batches) b
),
judged AS (
  SELECT b.*, mark IS NOT NULL AND epoch_us(ts) <= mark * 1000 AS is_late
  FROM batches b JOIN marks ON b.batch = marks.batch
),
kept AS (
  SELECT DISTINCT event_id, event_type, ts, 'silver' AS part FROM judged WHERE NOT is_late
  UNION ALL SELECT event_id, event_type, ts, 'late' FROM judged WHERE is_late
),
shown AS (
  SELECT part, CAST(event_id AS VARCHAR) AS record_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time,
         CAST(to_json({'id': CAST(event_id AS VARCHAR), 'event_type': event_type,
                       'at': strftime(ts, '%Y-%m-%d %H:%M:%S.%f')}) AS VARCHAR) AS payload_json
  FROM kept
)
SELECT *, CAST(length(payload_json) AS INTEGER) AS payload_size, sha256(payload_json) AS payload_hash FROM shown""",
    "event_sessions": _sessions("user_id", 30),
    "type_sessions": _sessions("event_type", 20),
    "stream_sessions": _sessions("user_id", 30),
    "gold_cube": """
SELECT CAST(GROUPING(l_returnflag, l_linestatus, l_linenumber) AS INTEGER) AS "grouping", l_returnflag, l_linestatus,
       l_linenumber, count(*) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity,
       min(l_partkey) AS first_part, max(l_partkey) AS last_part
FROM (SELECT * REPLACE (CASE WHEN l_orderkey % 5 <> 0 THEN l_linestatus END AS l_linestatus) FROM lineitem)
GROUP BY CUBE (l_returnflag, l_linestatus, l_linenumber)""",
    "gold_rollup": """
SELECT CAST(GROUPING(o_orderstatus, o_orderpriority) AS INTEGER) AS "grouping", o_orderstatus, o_orderpriority,
       count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS price
FROM orders
GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), (), (o_orderpriority))""",
    "gold_sketches": """
SELECT coalesce(l_linestatus, 'all') AS status, count(*) AS lines, true AS distinct_kept, true AS median_kept, true AS high_kept
FROM lineitem GROUP BY ROLLUP (l_linestatus)""",
    "top_k_groups": """
SELECT * FROM (
  SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice,
         CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS INTEGER) AS rank
  FROM lineitem
) WHERE rank <= 10""",
    "top_k_overall": """
SELECT o_orderkey, o_totalprice, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank
FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
    "asof_join": """
WITH owned AS (
  SELECT event_id, ts, event_type, value,
         CASE WHEN event_id % 97 <> 0 THEN CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END END AS user_id
  FROM events
),
clicks AS (
  SELECT user_id, ts, max(event_id) AS click_id, arg_max(value, event_id) AS click_value
  FROM owned WHERE event_type = 'click' GROUP BY user_id, ts
)
SELECT o.event_id, o.user_id, strftime(o.ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, click_id, click_value
FROM (SELECT * FROM owned WHERE event_type IN ('purchase', 'signup')) o
ASOF LEFT JOIN clicks c ON o.user_id = c.user_id AND o.ts >= c.ts""",
    "except_all": f"SELECT * FROM ({LINE_BAGS[0]}) EXCEPT ALL SELECT * FROM ({LINE_BAGS[1]})",
    "intersect_all": f"SELECT * FROM ({LINE_BAGS[0]}) INTERSECT ALL SELECT * FROM ({LINE_BAGS[1]})",
}
