"""Oracle SQL (DuckDB dialect) for each catalog query, written independently of
the Spark plans: plain CASTs, CASEs, window functions and joins over the driver's
tables, which DuckDB sees as views of the same names."""

from __future__ import annotations

from strata.specs import SPECS

TS = "'%Y-%m-%d %H:%M:%S'"


def _money(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(18,2)) AS VARCHAR)"


def _strict_date(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL OR {c} IN ('', 'None') THEN NULL "
            f"ELSE CAST(strptime({c}, {TS}) AS DATE) END")


def _tolerant_date(c: str) -> str:
    return f"CAST(try_strptime({c}, {TS}) AS DATE)"


def _coerce(c: str) -> str:
    return f"CAST(trunc(coalesce(TRY_CAST({c} AS DOUBLE), 0)) AS BIGINT)"


def _blank0(c: str) -> str:
    return f"(CASE WHEN {c} IS NULL OR {c} = '' THEN '0' ELSE {c} END)"


RAW = {
    "customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
               lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
               c_mktsegment AS customer_city,
               CASE WHEN c_custkey % 13 <> 0 THEN 'N' || CAST(c_nationkey AS VARCHAR) END
                   AS customer_state
        FROM customer""",
    "geolocation": f"""
        SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
               {_money('c_acctbal')} AS geolocation_lat,
               CASE WHEN c_custkey % 17 <> 0 THEN '-' || CAST(c_custkey % 90 AS VARCHAR) END
                   AS geolocation_lng,
               c_mktsegment AS geolocation_city,
               'N' || CAST(c_nationkey AS VARCHAR) AS geolocation_state
        FROM customer""",
    "items": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(l_linenumber AS VARCHAR) AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id,
               CAST(l_suppkey AS VARCHAR) AS seller_id,
               CASE WHEN l_partkey % 50 = 0 THEN '' ELSE strftime(l_shipdate, {TS}) END
                   AS shipping_limit_date,
               {_money('l_extendedprice')} AS price,
               {_money('l_tax')} AS freight_value
        FROM lineitem""",
    "orders": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
               CAST(o_custkey AS VARCHAR) AS customer_id,
               o_orderstatus AS order_status,
               strftime(o_orderdate, {TS}) AS order_purchase_timestamp,
               CASE WHEN o_orderkey % 5 = 0 THEN ''
                    ELSE strftime(o_orderdate + INTERVAL 1 DAY, {TS}) END AS order_approved_at,
               CASE WHEN o_orderkey % 7 = 0 THEN 'None'
                    ELSE strftime(o_orderdate + INTERVAL 3 DAY, {TS}) END
                   AS order_delivered_carrier_date,
               CASE WHEN o_orderkey % 11 <> 0
                    THEN strftime(o_orderdate + INTERVAL 9 DAY + INTERVAL 5 HOUR, {TS}) END
                   AS order_delivered_customer_date,
               strftime(o_orderdate + INTERVAL 30 DAY, {TS}) AS order_estimated_delivery_date
        FROM orders""",
    "payments": f"""
        SELECT CAST(user_id AS VARCHAR) AS order_id,
               CAST(event_id AS VARCHAR) AS payment_sequential,
               event_type AS payment_type,
               CAST(event_id % 12 + 1 AS VARCHAR) AS payment_installments,
               {_money('value')} AS payment_value
        FROM events""",
    "products": f"""
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               p_type AS product_category_name,
               CASE WHEN p_partkey % 9 = 0 THEN '' WHEN p_partkey % 10 = 0 THEN 'n/a'
                    ELSE CAST(length(p_name) AS VARCHAR) END AS product_name_lenght,
               CAST(p_size * 10 AS VARCHAR) AS product_description_lenght,
               CASE WHEN p_partkey % 8 = 0 THEN '' ELSE CAST(p_size % 6 AS VARCHAR) END
                   AS product_photos_qty,
               {_money('p_retailprice')} AS product_weight_g,
               CAST(p_size AS VARCHAR) AS product_length_cm,
               CASE WHEN p_partkey % 12 = 0 THEN '' ELSE CAST(p_size + 1 AS VARCHAR) END
                   AS product_height_cm,
               CAST(p_size + 2 AS VARCHAR) AS product_width_cm
        FROM part""",
    "reviews": f"""
        SELECT CAST(doc_id AS VARCHAR) AS review_id, source AS order_id,
               CASE WHEN doc_id % 6 = 0 THEN 'abc' WHEN doc_id % 9 = 0 THEN '4.7'
                    ELSE CAST(n_chars % 5 + 1 AS VARCHAR) END AS review_score,
               lang AS review_comment_title, text AS review_comment_message,
               CASE WHEN doc_id % 10 = 0 THEN 'None' WHEN doc_id % 15 = 0 THEN source
                    ELSE strftime(TIMESTAMP '2018-01-01 00:00:00' + to_hours(doc_id), {TS}) END
                   AS review_creation_date,
               CASE WHEN doc_id % 7 = 0 THEN 'None'
                    ELSE strftime(TIMESTAMP '2018-01-01 00:00:00' + to_hours(doc_id + 31), {TS})
               END AS review_answer_timestamp
        FROM documents""",
    "sellers": """
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
               lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
               s_name AS seller_city, 'N' || CAST(s_nationkey AS VARCHAR) AS seller_state
        FROM supplier""",
}

# Refined rows of each stand-in: trusted casts then the typed projection.
TYPED_SELECT = {
    "customers": """
        SELECT customer_id, coalesce(customer_unique_id, '0') AS customer_unique_id,
               CAST(coalesce(customer_zip_code_prefix, '0') AS BIGINT) AS customer_zip_code_prefix,
               coalesce(customer_city, '0') AS customer_city,
               coalesce(customer_state, '0') AS customer_state
        FROM raw""",
    "geolocation": """
        SELECT CAST(geolocation_zip_code_prefix AS BIGINT) AS geolocation_zip_code_prefix,
               CAST(coalesce(geolocation_lat, '0') AS DOUBLE) AS geolocation_lat,
               CAST(coalesce(geolocation_lng, '0') AS DOUBLE) AS geolocation_lng,
               coalesce(geolocation_city, '0') AS geolocation_city,
               coalesce(geolocation_state, '0') AS geolocation_state
        FROM raw""",
    "items": f"""
        SELECT order_id, order_item_id, coalesce(product_id, '0') AS product_id,
               coalesce(seller_id, '0') AS seller_id,
               {_strict_date('shipping_limit_date')} AS shipping_limit_date,
               CAST(coalesce(price, '0') AS DOUBLE) AS price,
               CAST(coalesce(freight_value, '0') AS DOUBLE) AS freight_value
        FROM raw""",
    "orders": f"""
        SELECT order_id, coalesce(customer_id, '0') AS customer_id,
               coalesce(order_status, '0') AS order_status,
               {_strict_date('order_purchase_timestamp')} AS order_purchase_timestamp,
               {_strict_date('order_approved_at')} AS order_approved_at,
               {_strict_date('order_delivered_carrier_date')} AS order_delivered_carrier_date,
               {_strict_date('order_delivered_customer_date')} AS order_delivered_customer_date,
               {_strict_date('order_estimated_delivery_date')} AS order_estimated_delivery_date
        FROM raw""",
    "payments": """
        SELECT order_id, CAST(payment_sequential AS BIGINT) AS payment_sequential,
               coalesce(payment_type, '0') AS payment_type,
               CAST(coalesce(payment_installments, '0') AS BIGINT) AS payment_installments,
               CAST(coalesce(payment_value, '0') AS DOUBLE) AS payment_value
        FROM raw""",
    "products": f"""
        SELECT product_id, product_category_name,
               CAST({_coerce(_blank0('product_name_lenght'))} AS DOUBLE) AS product_name_lenght,
               CAST({_blank0('product_description_lenght')} AS DOUBLE)
                   AS product_description_lenght,
               CAST({_blank0('product_photos_qty')} AS BIGINT) AS product_photos_qty,
               CAST({_blank0('product_weight_g')} AS DOUBLE) AS product_weight_g,
               CAST({_blank0('product_length_cm')} AS DOUBLE) AS product_length_cm,
               CAST({_blank0('product_height_cm')} AS DOUBLE) AS product_height_cm,
               CAST({_blank0('product_width_cm')} AS DOUBLE) AS product_width_cm
        FROM raw""",
    "reviews": f"""
        SELECT review_id, order_id, {_coerce('review_score')} AS review_score,
               review_comment_title, review_comment_message,
               {_tolerant_date('review_creation_date')} AS review_creation_date,
               {_tolerant_date('review_answer_timestamp')} AS review_answer_timestamp
        FROM raw""",
    "sellers": """
        SELECT seller_id,
               CAST(coalesce(seller_zip_code_prefix, '0') AS BIGINT) AS seller_zip_code_prefix,
               coalesce(seller_city, '0') AS seller_city,
               coalesce(seller_state, '0') AS seller_state
        FROM raw""",
}


def typed(name: str) -> str:
    return f"WITH raw AS ({RAW[name]}) {TYPED_SELECT[name]}"


_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"]

_DROPS = """
    a AS (SELECT o_orderkey * 2 AS o_orderkey, o_custkey, o_orderstatus,
                 o_totalprice * 2 AS o_totalprice, o_orderdate, o_orderpriority, 1 AS seq
          FROM orders),
    b AS (SELECT o_orderkey * 3 AS o_orderkey, o_custkey, 'F' AS o_orderstatus,
                 o_totalprice, o_orderdate, o_orderpriority, 2 AS seq FROM orders)"""

UPSERT = f"""
WITH {_DROPS},
    latest AS (
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) AS rn
              FROM (SELECT * FROM a UNION ALL SELECT * FROM b)) WHERE rn = 1)
SELECT * FROM latest
UNION ALL
SELECT o.* FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.o_orderkey = o.o_orderkey)"""


def _layer_counts() -> str:
    counts = {
        "customers": "SELECT count(DISTINCT c_custkey) FROM customer",
        "items": "SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)",
        "orders": "SELECT count(DISTINCT o_orderkey) FROM orders",
        "payments": "SELECT count(*) FROM (SELECT DISTINCT user_id, event_id FROM events)",
        "products": "SELECT count(DISTINCT p_partkey) FROM part",
        "reviews": "SELECT count(DISTINCT doc_id) FROM documents",
        "sellers": "SELECT count(DISTINCT s_suppkey) FROM supplier",
    }
    parts = []
    for layer in ("raw", "trusted", "refined"):
        for t, q in counts.items():
            parts.append(f"SELECT '{layer}' AS layer, '{t}' AS table_name, 'ok' AS status, "
                         f"CAST(({q}) AS BIGINT) AS rows")
    parts.append("SELECT 'raw', 'geolocation', 'failed', CAST(NULL AS BIGINT)")
    parts.append("SELECT 'trusted', 'geolocation', 'skipped', CAST(NULL AS BIGINT)")
    parts.append("SELECT 'refined', 'geolocation', 'skipped', CAST(NULL AS BIGINT)")
    return "\nUNION ALL ".join(parts)


SQL: dict[str, str] = {
    "csv_scan": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "csv_parse_lines": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
                       "o_orderpriority FROM orders",
    "csv_ragged": """
        SELECT c_custkey, c_name, c_nationkey,
               CASE WHEN c_custkey % 5 = 0 THEN NULL
                    ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) END AS c_acctbal,
               CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
               (c_custkey % 5 = 0 OR c_custkey % 7 = 0) AS malformed
        FROM customer""",
    "union_rows": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM orders
        UNION ALL
        SELECT o_orderkey * 2, o_custkey, o_orderstatus, o_totalprice * 2, o_orderdate,
               o_orderpriority FROM orders""",
    "upsert_orders": UPSERT,
    "keep_last_by_order": f"""
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC NULLS LAST,
                {', '.join(c + ' DESC NULLS LAST' for c in _LI_REST)}) AS rn
            FROM lineitem) WHERE rn = 1""",
    "keep_last_by_item": f"""
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
                {', '.join(c + ' DESC NULLS LAST' for c in _LI_REST)}) AS rn
            FROM lineitem) WHERE rn = 1""",
    "first_per_key": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts ASC NULLS FIRST,
                event_id ASC NULLS FIRST, event_type ASC NULLS FIRST, value ASC NULLS FIRST,
                props ASC NULLS FIRST) AS rn
            FROM events) WHERE rn = 1""",
    "group_rows": """
        SELECT conv_id, CAST(floor(turn / 1024) AS BIGINT) AS block, count(*) AS n_turns,
               min(turn) AS first_turn, max(turn) AS last_turn,
               string_agg(role, ',' ORDER BY turn) AS roles,
               string_agg(text, chr(10) ORDER BY turn) AS transcript
        FROM conversations GROUP BY conv_id, CAST(floor(turn / 1024) AS BIGINT)""",
    "group_rows_repeated_order": """
        WITH e AS (SELECT event_type, event_id % 10 AS digit, event_id FROM events),
        p AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY event_type
                     ORDER BY digit, event_id) - 1) / 256) AS BIGINT) AS part FROM e)
        SELECT event_type, CAST(0 AS BIGINT) AS block, part, count(*) AS n_rows,
               arg_min(event_id, (digit, event_id)) AS first_event,
               arg_max(event_id, (digit, event_id)) AS last_event
        FROM p GROUP BY event_type, part""",
    "sort_rows": """
        SELECT *, row_number() OVER (ORDER BY p_name ASC NULLS LAST, p_partkey ASC NULLS FIRST,
            p_brand ASC NULLS FIRST, p_type ASC NULLS FIRST, p_size ASC NULLS FIRST,
            p_retailprice ASC NULLS FIRST) AS position
        FROM part""",
    "cast_strict": """
        SELECT c_custkey, CAST(lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS BIGINT) AS key_long,
               CAST(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS DOUBLE) AS balance,
               CAST(c_nationkey AS VARCHAR) AS nation_text,
               CAST(c_nationkey AS DOUBLE) AS nation_double,
               CAST(CASE c_custkey % 5 WHEN 0 THEN 1000 WHEN 1 THEN 'infinity'::DOUBLE WHEN 2 THEN 7
                    WHEN 3 THEN -0.5 ELSE 4 END AS DOUBLE) AS spelled,
               CAST(c_custkey AS BIGINT) AS spaced_long
        FROM customer""",
    "coerce_number": f"""
        WITH s AS (
            SELECT p_partkey,
                   CASE WHEN p_partkey % 6 = 0 THEN 'abc' WHEN p_partkey % 9 = 0 THEN '4.7'
                        WHEN p_partkey % 15 = 1 THEN '-2.9' WHEN p_partkey % 15 = 2 THEN '4d'
                        WHEN p_partkey % 15 = 4 THEN '4f' WHEN p_partkey % 15 = 5 THEN ' 7 '
                        WHEN p_partkey % 15 = 7 THEN '1e3' ELSE CAST(p_size AS VARCHAR) END
                       AS size_text
            FROM part)
        SELECT p_partkey, size_text,
               CASE WHEN size_text IN ('4d', '4f') THEN 0 ELSE {_coerce('size_text')} END AS size_num
        FROM s""",
    "fill_zero": """
        SELECT c_custkey, coalesce(c_name, '0') AS c_name,
               coalesce(CASE WHEN c_custkey % 7 <> 0 THEN c_nationkey END, 0) AS c_nationkey,
               coalesce(CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END, 0) AS c_acctbal,
               coalesce(CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END, '0') AS c_mktsegment
        FROM customer""",
    "replace_blank": """
        SELECT p_partkey, p_name,
               CASE WHEN p_partkey % 3 = 0 OR p_brand IS NULL OR p_brand = '' THEN '0'
                    ELSE p_brand END AS p_brand,
               CASE WHEN p_partkey % 4 = 0 OR p_type IS NULL OR p_type = '' THEN '0'
                    ELSE p_type END AS p_type
        FROM part""",
    "date_strict": f"""
        WITH raw AS ({RAW['orders']})
        SELECT order_id,
               {_strict_date('order_purchase_timestamp')} AS order_purchase_timestamp,
               {_strict_date('order_approved_at')} AS order_approved_at,
               {_strict_date('order_delivered_carrier_date')} AS order_delivered_carrier_date,
               {_strict_date('order_delivered_customer_date')} AS order_delivered_customer_date,
               {_strict_date('order_estimated_delivery_date')} AS order_estimated_delivery_date
        FROM raw""",
    "date_tolerant": f"""
        WITH raw AS ({RAW['reviews']})
        SELECT review_id,
               {_tolerant_date('review_creation_date')} AS review_creation_date,
               {_tolerant_date('review_answer_timestamp')} AS review_answer_timestamp
        FROM raw""",
    "render_rows": """
        SELECT doc_id,
               '"' || CAST(doc_id AS VARCHAR) || '","' || replace(text, '"', '""') || '","'
                   || replace(lang, '"', '""') || '","' || replace(source, '"', '""') || '","'
                   || CAST(n_chars AS VARCHAR) || '"' AS line,
               concat_ws(',', CAST(doc_id AS VARCHAR), coalesce(text, 'None'),
                         coalesce(lang, 'None'), coalesce(source, 'None'),
                         coalesce(CAST(n_chars AS VARCHAR), 'None')) AS bare
        FROM documents""",
    "split_key": """
        WITH b AS (
            SELECT doc_id, string_split(concat_ws(',', CAST(doc_id AS VARCHAR), text, lang,
                                                  source, CAST(n_chars AS VARCHAR)), ',') AS parts
            FROM documents)
        SELECT doc_id, parts[1] AS key, CAST(len(parts) - 1 AS BIGINT) AS n_rest,
               array_to_string(parts[2:], '|') AS rest
        FROM b""",
    "expand_lists": """
        WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS ln FROM documents)
        SELECT doc_id, CAST(len(string_split(ln, ' ')) AS BIGINT) AS n_words,
               CAST(doc_id AS VARCHAR) || ',' || array_to_string(string_split(ln, ' '), ',')
                   AS line
        FROM l""",
    "render_joins": """
        SELECT l_orderkey,
               concat_ws(',', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR),
                         CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS line
        FROM lineitem""",
    "append_twice": f"{typed('customers')} UNION ALL {TYPED_SELECT['customers']}",
    "overwrite_twice": typed("customers"),
    "layer_run": _layer_counts(),
    "layer_rerun": _layer_counts(),
    "incremental_load": UPSERT,
    "refined_orders": typed("orders"),
    "sales_by_category": """
        WITH lines AS (
            SELECT p.p_type, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month,
                   l.l_orderkey,
                   CAST(l.l_extendedprice AS DECIMAL(18,2))
                       * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS rev
            FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                            JOIN part p ON l.l_partkey = p.p_partkey),
        m AS (
            SELECT p_type, month, CAST(sum(rev) AS DOUBLE) AS revenue, count(*) AS n_lines,
                   count(DISTINCT l_orderkey) AS n_orders
            FROM lines GROUP BY p_type, month)
        SELECT *, lag(revenue) OVER (PARTITION BY p_type ORDER BY month) AS prev_revenue
        FROM m""",
    "customer_profile": """
        WITH pc AS (
            SELECT o_custkey, count(*) AS n_orders,
                   sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spend
            FROM orders GROUP BY o_custkey)
        SELECT n.n_name, count(*) AS n_customers, CAST(sum(pc.n_orders) AS BIGINT) AS n_orders,
               CAST(sum(CASE WHEN pc.n_orders > 1 THEN 1 ELSE 0 END) AS BIGINT)
                   AS repeat_customers,
               CAST(sum(pc.spend) AS DOUBLE) AS spend
        FROM pc JOIN customer c ON pc.o_custkey = c.c_custkey
                JOIN nation n ON c.c_nationkey = n.n_nationkey
        GROUP BY n.n_name""",
    "review_scores": """
        SELECT d.lang, d.source, count(*) AS n_docs, count(l.quality) AS n_labeled,
               CAST(sum(l.quality) AS BIGINT) AS n_quality, CAST(sum(l.toxic) AS BIGINT) AS n_toxic,
               CAST(sum(l.quality) AS DOUBLE) / count(l.quality) AS quality_rate
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
        GROUP BY d.lang, d.source""",
    "delivery_times": """
        WITH j AS (
            SELECT o.o_orderpriority,
                   datediff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS days,
                   CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(4,2))
                       AS freight
            FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
        SELECT o_orderpriority, count(*) AS n_lines, CAST(sum(days) AS BIGINT) AS total_days,
               min(days) AS min_days, max(days) AS max_days,
               CAST(sum(days) AS DOUBLE) / count(*) AS avg_days,
               CAST(sum(CASE WHEN days > 60 THEN 1 ELSE 0 END) AS BIGINT) AS late_lines,
               CAST(sum(freight) AS DOUBLE) AS freight
        FROM j GROUP BY o_orderpriority""",
}

for _name in RAW:
    SQL[f"typed_projection_{_name}"] = typed(_name)


# --- contents of the loads: two drops, the second wins; in a drop a key's last row wins ----

_COLUMNS = {name: list(spec.columns) for name, spec in SPECS.items()}


def _last(rows: str, columns: list[str], key: list[str], seq: str = "") -> str:
    """One row per key: the highest drop, then the one that the drop has last (the smallest)."""
    order = ", ".join(([f"{seq} DESC"] if seq else []) + [f"{c} ASC NULLS FIRST" for c in columns])
    return (f"SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER (PARTITION BY "
            f"{', '.join(key)} ORDER BY {order}) AS rn FROM ({rows})) WHERE rn = 1")


def loaded(name: str, key: list[str], mark: str) -> str:
    cols = _COLUMNS[name]
    again = ", ".join(f"CAST(CAST({c} AS BIGINT) * 2 AS VARCHAR) AS {c}" if c == cols[0]
                      else f"{c} || '*' AS {c}" if c == mark else c for c in cols)
    rows = f"SELECT *, 1 AS seq FROM feed UNION ALL SELECT {again}, 2 AS seq FROM feed"
    # rows of one cast key and drop have one raw key, except that the raw key text decides nothing
    return (f"WITH feed AS ({RAW[name]}), raw AS ({_last(rows, cols, key, 'seq')}) "
            f"{TYPED_SELECT[name]}")


_LOADED_KEYS = {
    "customers": (["customer_id"], "customer_city"),
    "geolocation": (["CAST(geolocation_zip_code_prefix AS BIGINT)"], "geolocation_city"),
    "items": (["order_id", "order_item_id"], "product_id"),
    "orders": (["order_id"], "order_status"),
    "payments": (["order_id", "CAST(payment_sequential AS BIGINT)"], "payment_type"),
    "products": (["product_id"], "product_category_name"),
    "reviews": (["review_id"], "review_comment_title"),
    "sellers": (["seller_id"], "seller_city"),
}
for _name, (_key, _mark) in _LOADED_KEYS.items():
    SQL[f"loaded_{_name}"] = loaded(_name, _key, _mark)
SQL["loaded_items_reference"] = loaded("items", ["order_id"], "product_id")
SQL["raw_in_file_last"] = (
    f"WITH feed AS ({RAW['items']}), f AS (SELECT * REPLACE (nullif(shipping_limit_date, '') "
    f"AS shipping_limit_date) FROM feed) " + _last("SELECT * FROM f", _COLUMNS["items"], ["order_id"]))
SQL["trusted_zip_variants"] = """
    SELECT CAST(c_custkey AS BIGINT) AS geolocation_zip_code_prefix,
           CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS geolocation_lat,
           CAST(1 AS DOUBLE) AS geolocation_lng, 'a ' || c_name AS geolocation_city,
           'S' AS geolocation_state
    FROM customer"""
SQL["stream_over_lake"] = SQL["loaded_sellers"]
SQL["refined_failed_overwrite"] = typed("orders")
SQL["loaded_in_buckets"] = SQL["loaded_customers"]
SQL["published_catalog_orders"] = f"""
    SELECT 'before' AS read, order_status, count(*) AS orders, CAST(sum(CAST(order_id AS BIGINT)) AS BIGINT) AS id_sum,
           max(order_purchase_timestamp) AS latest
    FROM ({typed("orders")}) GROUP BY order_status
    UNION ALL
    SELECT 'now', order_status || '*', count(*), CAST(2 * sum(CAST(order_id AS BIGINT)) AS BIGINT),
           max(order_purchase_timestamp)
    FROM ({typed("orders")}) GROUP BY order_status"""
SQL["csv_scan_splits"] = SQL["csv_scan"]
SQL["rejected_rows"] = f'''
    WITH f AS (SELECT *, CAST(customer_id AS BIGINT) AS k, coalesce(customer_state, '') AS state,
                      customer_id || ',' || customer_unique_id || ',' || customer_zip_code_prefix AS three
               FROM ({RAW["customers"]}))
    SELECT CASE WHEN k % 5 = 0 THEN 'short' WHEN k % 7 = 0 THEN 'long' ELSE 'loaded' END AS reason,
           CAST(1 AS BIGINT) AS load,
           CASE WHEN k % 5 = 0 THEN three
                WHEN k % 7 = 0 THEN three || ',"' || customer_city || ', ""x""",' || state || ',more, and more'
                ELSE concat_ws('|', customer_id, customer_unique_id, customer_zip_code_prefix,
                               customer_city || ', "x"', nullif(state, '')) END AS line
    FROM f'''
SQL["sorted_files_orders"] = "SELECT count(*) AS orders, CAST(0 AS BIGINT) AS files_that_meet FROM orders"
