"""The registered queries as plain SQL over the same tables.

Written independently of the operators: ordered windows where these use aggregates, one step after the other where
these rearrange. Shared steps are common table expressions, put in front of each statement in order of need.
"""

from __future__ import annotations

import re

FAR, NEAR = 180, 5
MONTH_US, HOUR_US, DAY_US = 2_592_000_000_000, 3_600_000_000, 86_400_000_000
TIME = "%Y-%m-%d %H:%M:%S"


def text(ts: str) -> str:
    return f"strftime({ts}, '{TIME}')"


def window(us: str, size: int) -> str:
    start = f"(({us}) // {size}) * {size}"
    return f"{text(f'make_timestamp({start})')} AS stt, {text(f'make_timestamp({start} + {size})')} AS edt"


def of_ms(ms: str, fmt: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), '{fmt}')"


FLAT = "event_id, mid, vc, ch, ar, is_new, page_id, last_page_id, item, during_time, ts"

STEPS = {
    "v_log": """
        SELECT event_id, cast(user_id AS varchar) AS mid, 'v' || (k % 3) AS vc, 'c' || (event_id % 4) AS ch,
               'a' || (user_id % 5) AS ar, CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS is_new,
               CASE event_type WHEN 'click' THEN 'good_detail' WHEN 'view' THEN 'good_list' ELSE event_type END AS page_id,
               CASE WHEN event_type IN ('view', 'signup') THEN NULL ELSE 'home' END AS last_page_id,
               cast(event_id % 1000 AS varchar) AS item, cast(round(value * 1000) AS bigint) AS during_time,
               event_type = 'signup' AS is_start, k % 3 AS n_displays, epoch_ms(ts) AS ts
        FROM (SELECT *, cast(regexp_extract(props, '[0-9]+') AS integer) AS k FROM events)""",
    "v_repaired": f"""
        SELECT * EXCLUDE (is_new, first_ts),
               CASE WHEN is_new = '1' AND {of_ms('first_ts', '%Y%m%d')} <> {of_ms('ts', '%Y%m%d')}
                    THEN '0' ELSE is_new END AS is_new
        FROM (SELECT *, min(ts) FILTER (WHERE is_new = '1')
                        OVER (PARTITION BY mid ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS first_ts
              FROM v_log)""",
    "v_page": "SELECT * FROM v_log WHERE NOT is_start",
    "v_page_fixed": "SELECT * FROM v_repaired WHERE NOT is_start",
    "v_display": """
        SELECT p.*, cast((event_id + i) % 1000 AS varchar) AS d_item,
               CASE WHEN (event_id + i) % 4 = 3 THEN 'activity_id' ELSE 'sku_id' END AS d_type
        FROM v_page p, (VALUES (0), (1)) AS t(i) WHERE i < n_displays""",
    "v_order": """
        SELECT o_orderkey AS id, cast(c_nationkey AS bigint) AS province_id, o_orderstatus AS order_status,
               o_custkey AS user_id, cast(o_totalprice AS decimal(18,2)) AS total_amount,
               cast(o_custkey % 100 AS decimal(18,2)) AS activity_reduce_amount,
               cast(o_orderkey % 50 AS decimal(18,2)) AS coupon_reduce_amount,
               cast(o_totalprice AS decimal(18,2)) AS original_total_amount,
               cast(o_custkey % 20 AS decimal(18,2)) AS feight_fee, o_orderdate AS create_ts
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "v_detail": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
               cast(l_extendedprice AS decimal(18,2)) AS order_price, cast(l_quantity AS bigint) AS sku_num,
               'line ' || l_linenumber AS sku_name, l_shipdate AS create_ts,
               cast(cast(l_extendedprice AS decimal(18,2)) * (1 - cast(l_discount AS decimal(3,2)))
                    AS decimal(18,2)) AS split_total_amount,
               cast(l_linenumber AS decimal(18,2)) AS split_activity_amount,
               cast(l_tax AS decimal(18,2)) AS split_coupon_amount
        FROM lineitem""",
    "v_payment": """
        SELECT o_orderkey + 1000000 AS id, o_orderkey AS order_id, o_custkey AS user_id,
               cast(o_totalprice AS decimal(18,2)) AS total_amount, o_orderpriority AS subject,
               CASE WHEN o_custkey % 2 = 0 THEN '1101' ELSE '1102' END AS payment_type, o_orderdate AS create_ts,
               o_orderdate + to_minutes(cast(o_orderkey % 60 AS bigint)) AS callback_ts
        FROM orders""",
    "d_user": """
        SELECT c_custkey AS id, date '1960-01-01' + cast(c_custkey % 15000 AS integer) AS birthday,
               CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender FROM customer""",
    "d_province": """
        SELECT cast(n_nationkey AS bigint) AS id, n_name AS name, 'CN-' || n_nationkey AS iso_3166_2,
               'ISO-' || n_nationkey AS iso_code, r_name AS area_code
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "d_sku": """
        SELECT p_partkey AS id, p_name AS sku_name, cast(p_retailprice AS decimal(18,2)) AS price,
               p_partkey // 10 AS spu_id, cast(p_size AS bigint) AS category3_id,
               cast(regexp_extract(p_brand, '[0-9]+') AS bigint) AS tm_id FROM part""",
    "d_spu": "SELECT p_partkey // 10 AS id, arg_min(p_name, p_partkey) AS spu_name FROM part GROUP BY 1",
    "d_category3": "SELECT DISTINCT cast(p_size AS bigint) AS id, 'cat-' || p_size AS name FROM part",
    "d_trademark": """
        SELECT DISTINCT cast(regexp_extract(p_brand, '[0-9]+') AS bigint) AS id, p_brand AS tm_name FROM part""",
    "pairs_near": f"""
        SELECT o.id AS order_id, d.id AS detail_id, o.* EXCLUDE (id), d.* EXCLUDE (id, order_id, create_ts)
        FROM v_order o JOIN v_detail d ON o.id = d.order_id
         AND d.create_ts BETWEEN o.create_ts - INTERVAL {NEAR} DAY AND o.create_ts + INTERVAL {NEAR} DAY""",
    "pairs_far": f"""
        SELECT o.id AS order_id, d.id AS detail_id, o.* EXCLUDE (id), d.* EXCLUDE (id, order_id, create_ts)
        FROM v_order o JOIN v_detail d ON o.id = d.order_id
         AND d.create_ts BETWEEN o.create_ts - INTERVAL {FAR} DAY AND o.create_ts + INTERVAL {FAR} DAY""",
    "wide_near": f"""
        SELECT detail_id, order_id, sku_id, order_price, sku_num,
               CASE WHEN s.id IS NOT NULL THEN s.sku_name ELSE p.sku_name END AS sku_name,
               province_id, order_status, user_id, total_amount, activity_reduce_amount, coupon_reduce_amount,
               original_total_amount, feight_fee, cast(NULL AS decimal(18,2)) AS split_feight_fee,
               split_activity_amount, split_coupon_amount, split_total_amount,
               cast(NULL AS varchar) AS expire_time, {text('create_ts')} AS create_time,
               cast(NULL AS varchar) AS operate_time, strftime(create_ts, '%Y-%m-%d') AS create_date,
               cast(NULL AS varchar) AS create_hour, r.name AS province_name, r.area_code AS province_area_code,
               r.iso_code AS province_iso_code, r.iso_3166_2 AS province_3166_2_code,
               cast(date_diff('day', u.birthday, date '2024-01-01') // 365 AS integer) AS user_age,
               u.gender AS user_gender, s.spu_id, s.tm_id, s.category3_id, q.spu_name, t.tm_name,
               c.name AS category3_name
        FROM pairs_near p LEFT JOIN d_user u ON u.id = user_id LEFT JOIN d_province r ON r.id = province_id
        LEFT JOIN d_sku s ON s.id = sku_id LEFT JOIN d_spu q ON q.id = s.spu_id
        LEFT JOIN d_category3 c ON c.id = s.category3_id LEFT JOIN d_trademark t ON t.id = s.tm_id""",
    "paid_near": f"""
        SELECT p.id AS payment_id, p.subject, p.payment_type, {text('p.create_ts')} AS payment_create_time,
               {text('p.callback_ts')} AS callback_time, w.create_time AS order_create_time, p.order_id, p.user_id,
               p.total_amount, w.* EXCLUDE (order_id, user_id, total_amount, create_time, create_date, create_hour,
                                            expire_time, operate_time)
        FROM v_payment p JOIN wide_near w ON p.order_id = w.order_id
         AND cast(w.create_time AS timestamp) BETWEEN p.callback_ts - INTERVAL 30 MINUTE AND p.callback_ts""",
    "paid_far": """
        SELECT p.order_id, w.sku_id, w.split_total_amount, p.create_ts
        FROM v_payment p JOIN pairs_far w ON p.order_id = w.order_id
         AND w.create_ts BETWEEN p.callback_ts - INTERVAL 30 MINUTE AND p.callback_ts""",
    "v_unique": f"""
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY mid, {of_ms('ts', '%Y-%m-%d')} ORDER BY ts, event_id) AS rn
            FROM v_page_fixed WHERE coalesce(last_page_id, '') = '') WHERE rn = 1""",
    "v_bounce": """
        SELECT * EXCLUDE (next_ts) FROM (
            SELECT *, lead(ts) OVER (PARTITION BY mid ORDER BY ts, event_id) AS next_ts FROM v_page_fixed)
        WHERE coalesce(last_page_id, '') = '' AND (next_ts IS NULL OR next_ts - ts >= 600000)""",
    "v_visitor_rows": """
        SELECT vc, ch, ar, is_new, 0 AS uv_ct, 1 AS pv_ct, 0 AS sv_ct, 0 AS uj_ct, during_time AS dur_sum, ts FROM v_page_fixed
        UNION ALL SELECT vc, ch, ar, is_new, 1, 0, 0, 0, 0, ts FROM v_unique
        UNION ALL SELECT vc, ch, ar, is_new, 0, 0, 1, 0, 0, ts FROM v_page_fixed WHERE coalesce(last_page_id, '') = ''
        UNION ALL SELECT vc, ch, ar, is_new, 0, 0, 0, 1, 0, ts FROM v_bounce""",
    "m_visitor": f"""
        SELECT {window('ts * 1000', HOUR_US)}, vc, ch, ar, is_new, cast(sum(uv_ct) AS bigint) AS uv_ct,
               cast(sum(pv_ct) AS bigint) AS pv_ct, cast(sum(sv_ct) AS bigint) AS sv_ct,
               cast(sum(uj_ct) AS bigint) AS uj_ct, cast(sum(dur_sum) AS bigint) AS dur_sum, min(ts) AS ts
        FROM v_visitor_rows GROUP BY ALL""",
    "by_new": """
        SELECT is_new, cast(sum(uv_ct) AS bigint) AS uv_ct, cast(sum(pv_ct) AS bigint) AS pv_ct,
               cast(sum(sv_ct) AS bigint) AS sv_ct, cast(sum(uj_ct) AS bigint) AS uj_ct,
               cast(sum(dur_sum) AS bigint) AS dur_sum
        FROM m_visitor WHERE substr(stt, 1, 10) = '2024-01-01' GROUP BY is_new""",
    "by_hour": """
        SELECT cast(substr(stt, 12, 2) AS integer) AS hr,
               cast(sum(CASE WHEN is_new = '1' THEN uv_ct ELSE 0 END) AS bigint) AS new_uv,
               cast(sum(uv_ct) AS bigint) AS uv_ct, cast(sum(pv_ct) AS bigint) AS pv_ct,
               cast(sum(uj_ct) AS bigint) AS uj_ct
        FROM m_visitor WHERE substr(stt, 1, 10) = '2024-01-01' GROUP BY 1""",
    "kpis": """
        SELECT *,
               CASE WHEN uv_ct = 0 OR sv_ct = 0 THEN 0 ELSE (uj_ct * 20000 + sv_ct) // (2 * sv_ct) END AS rate_units,
               CASE WHEN uv_ct = 0 OR sv_ct = 0 THEN 0
                    ELSE (2 * ((2 * dur_sum + sv_ct) // (2 * sv_ct)) * 10 + 1000) // 2000 END AS dur_units,
               CASE WHEN uv_ct = 0 OR sv_ct = 0 THEN 0 ELSE (pv_ct * 200 + sv_ct) // (2 * sv_ct) END AS page_units
        FROM by_new""",
    "p_page": """
        SELECT cast(item AS bigint) AS sku_id, 1 AS click_ct, 0 AS display_ct, ts FROM v_page WHERE page_id = 'good_detail'
        UNION ALL SELECT cast(d_item AS bigint), 0, 1, ts FROM v_display WHERE d_type = 'sku_id'""",
    "v_sku_event": """
        SELECT event_id % 1000 AS sku_id, event_type, date_trunc('second', ts) AS create_ts,
               cast(regexp_extract(props, '[0-9]+') AS integer) AS k FROM events""",
    "p_rows": """
        SELECT sku_id, ts * 1000 AS us, display_ct, click_ct, 0 AS favor_ct, 0 AS cart_ct, 0 AS order_sku_num,
               0::decimal(18,2) AS order_amount, 0::decimal(18,2) AS payment_amount, 0::decimal(18,2) AS refund_amount,
               0 AS comment_ct, 0 AS good_comment_ct, NULL AS order_id, NULL AS paid_id, NULL AS refund_id FROM p_page
        UNION ALL SELECT sku_id, epoch_us(create_ts), 0, 0, 0, 0, sku_num, split_total_amount, 0, 0, 0, 0, order_id, NULL, NULL FROM pairs_far
        UNION ALL SELECT sku_id, epoch_us(create_ts), 0, 0, 0, 0, 0, 0, split_total_amount, 0, 0, 0, NULL, order_id, NULL FROM paid_far
        UNION ALL SELECT l_partkey, epoch_us(l_shipdate), 0, 0, 0, 0, 0, 0, 0, cast(l_extendedprice AS decimal(18,2)), 0, 0, NULL, NULL, l_orderkey
                  FROM lineitem WHERE l_returnflag = 'R'
        UNION ALL SELECT sku_id, epoch_us(create_ts), 0, 0, 1, 0, 0, 0, 0, 0, 0, 0, NULL, NULL, NULL FROM v_sku_event WHERE event_type = 'signup'
        UNION ALL SELECT sku_id, epoch_us(create_ts), 0, 0, 0, 1, 0, 0, 0, 0, 0, 0, NULL, NULL, NULL FROM v_sku_event WHERE event_type = 'view'
        UNION ALL SELECT sku_id, epoch_us(create_ts), 0, 0, 0, 0, 0, 0, 0, 0, 1, CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END, NULL, NULL, NULL
                  FROM v_sku_event WHERE event_type = 'purchase'""",
    "p_sums": f"""
        SELECT {window('us', MONTH_US)}, sku_id, cast(sum(display_ct) AS bigint) AS display_ct,
               cast(sum(click_ct) AS bigint) AS click_ct, cast(sum(favor_ct) AS bigint) AS favor_ct,
               cast(sum(cart_ct) AS bigint) AS cart_ct, cast(sum(order_sku_num) AS bigint) AS order_sku_num,
               cast(sum(order_amount) AS decimal(28,2)) AS order_amount, count(DISTINCT order_id) AS order_ct,
               cast(sum(payment_amount) AS decimal(28,2)) AS payment_amount, count(DISTINCT paid_id) AS paid_order_ct,
               count(DISTINCT refund_id) AS refund_order_ct, cast(sum(refund_amount) AS decimal(28,2)) AS refund_amount,
               cast(sum(comment_ct) AS bigint) AS comment_ct, cast(sum(good_comment_ct) AS bigint) AS good_comment_ct
        FROM p_rows GROUP BY stt, edt, sku_id""",
    "m_product": """
        SELECT p.*, s.sku_name, s.price AS sku_price, s.spu_id, q.spu_name, s.tm_id, t.tm_name, s.category3_id,
               c.name AS category3_name
        FROM p_sums p LEFT JOIN d_sku s ON s.id = p.sku_id LEFT JOIN d_spu q ON q.id = s.spu_id
        LEFT JOIN d_category3 c ON c.id = s.category3_id LEFT JOIN d_trademark t ON t.id = s.tm_id""",
    "m_province": f"""
        SELECT {window('epoch_us(create_ts)', MONTH_US)}, province_id, name AS province_name, area_code, iso_code,
               iso_3166_2, count(DISTINCT order_id) AS order_count,
               cast(sum(split_total_amount) AS decimal(28,2)) AS order_amount
        FROM pairs_far LEFT JOIN d_province r ON r.id = province_id
        GROUP BY stt, edt, province_id, name, area_code, iso_code, iso_3166_2""",
    "v_search": f"""
        SELECT item AS fullword, {of_ms('ts', TIME)} AS rowtime, ts FROM v_page
        WHERE page_id = 'good_list' AND item IS NOT NULL""",
    "v_word": r"""
        SELECT unnest(regexp_extract_all(lower(fullword), '[\p{L}\p{N}]+')) AS keyword, rowtime, ts FROM v_search""",
    "m_search": f"""
        SELECT keyword, count(*) AS ct, 'SEARCH' AS source, {window('(ts // 1000) * 1000000', DAY_US)}
        FROM v_word GROUP BY ALL""",
    "product_source": """
        SELECT stt, edt, sku_id, spu_name, click_ct AS ct, 'CLICK' AS source FROM m_product WHERE click_ct > 0
        UNION ALL SELECT stt, edt, sku_id, spu_name, cart_ct, 'CART' FROM m_product WHERE cart_ct > 0
        UNION ALL SELECT stt, edt, sku_id, spu_name, order_ct, 'ORDER' FROM m_product WHERE order_ct > 0""",
    "m_keyword_product": r"""
        SELECT unnest(regexp_extract_all(lower(spu_name), '[\p{L}\p{N}]+')) AS keyword, ct, source, stt, edt
        FROM product_source""",
    "v_change": f"""
        SELECT 'customer' AS "table", cast(c_custkey AS varchar) AS key, c_custkey % 3 AS kind,
               [c_custkey::varchar, c_name, c_nationkey::varchar, c_mktsegment] AS vals,
               ['c_custkey', 'c_name', 'c_nationkey', 'c_mktsegment'] AS names FROM customer
        UNION ALL
        SELECT 'orders', cast(o_orderkey AS varchar), o_orderkey % 3,
               [o_orderkey::varchar, o_custkey::varchar, cast(cast(o_totalprice AS decimal(18,2)) AS varchar),
                {text('o_orderdate')}],
               ['o_orderkey', 'o_custkey', 'o_totalprice', 'o_orderdate'] FROM orders""",
    "v_routed": """
        SELECT "table", CASE WHEN kind = 2 THEN 'update' ELSE 'insert' END AS type, key,
               CASE WHEN "table" = 'customer' THEN 'hbase' WHEN kind = 2 THEN 'clickhouse' ELSE 'kafka' END AS sink_type,
               CASE WHEN "table" = 'customer' THEN 'dim_customer' WHEN kind = 2 THEN 'order_update'
                    ELSE 'dwd_order_insert' END AS sink_table,
               CASE WHEN "table" = 'customer' THEN 'c_custkey' ELSE 'o_orderkey' END AS sink_pk, vals, names
        FROM v_change""",
    "v_entry": """
        SELECT "table", type, sink_type, sink_table, key, unnest(names) AS name, unnest(vals) AS value FROM v_routed""",
    "v_kept": """SELECT * FROM v_entry WHERE "table" = 'orders' OR name IN ('c_custkey', 'c_name', 'c_nationkey')""",
}

TOP = """
    SELECT {keys}, cast(sum(order_amount) AS decimal(28,2)) AS order_amount {more} FROM m_product
    WHERE substr(stt, 1, 10) = '1998-05-04' GROUP BY {keys} HAVING sum(order_amount) > 0
    ORDER BY order_amount DESC, {keys} LIMIT 10"""

DIM_COLUMNS = """
    WITH c AS (
        SELECT c_custkey::varchar AS id, c_name AS name, NULL AS status, c_mktsegment AS label, -1 AS seq, false AS gone
        FROM customer
        UNION ALL
        SELECT o_custkey::varchar, NULL, o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END,
               o_orderkey, o_orderkey % 97 = 0 FROM orders),
    d AS (SELECT *, coalesce(max(CASE WHEN gone THEN seq END) OVER (PARTITION BY id), -2) AS last_gone FROM c)
    SELECT id, arg_max(name, seq) FILTER (WHERE name IS NOT NULL) AS name,
           arg_max(status, seq) FILTER (WHERE status IS NOT NULL) AS status,
           arg_max(label, seq) FILTER (WHERE label IS NOT NULL) AS label
    FROM d WHERE seq > last_gone GROUP BY id"""

STATEMENTS = {
    "json_parse_log": f"""
        SELECT {FLAT}, CASE WHEN is_start THEN 'icon' ELSE '' END AS start_entry, n_displays
        FROM v_log WHERE page_id <> 'error'""",
    "json_dead_letters": "SELECT event_id FROM v_log WHERE page_id = 'error'",
    "json_parse_order": f"""
        SELECT * EXCLUDE (create_ts), cast(NULL AS varchar) AS expire_time, {text('create_ts')} AS create_time,
               cast(NULL AS varchar) AS operate_time, strftime(create_ts, '%Y-%m-%d') AS create_date,
               cast(NULL AS varchar) AS create_hour FROM v_order""",
    "epoch_to_day": f"SELECT event_id, {of_ms('ts', '%Y-%m-%d')} AS day, {of_ms('ts', '%Y%m%d')} AS ymd FROM v_log",
    "text_to_epoch": "SELECT id, epoch_ms(create_ts) AS ms FROM v_order",
    "new_visitor_repair": "SELECT event_id, mid, is_new, ts FROM v_repaired",
    "log_split_start": f"SELECT {FLAT}, 'icon' AS start_entry FROM v_log WHERE is_start",
    "log_split_page": f"SELECT {FLAT} FROM v_page",
    "log_split_display": "SELECT d_item AS item, d_type AS item_type, page_id FROM v_display",
    "entry_pages": f"SELECT {FLAT} FROM v_page WHERE coalesce(last_page_id, '') = ''",
    "search_fullword": "SELECT fullword, rowtime FROM v_search",
    "tumbling_count": f"SELECT {window('ts * 1000', HOUR_US)}, page_id, count(*) AS ct FROM v_log GROUP BY ALL",
    "cdc_valid": """
        SELECT "table", CASE kind WHEN 0 THEN 'bootstrap-insert' WHEN 1 THEN 'insert' ELSE 'update' END AS type, key
        FROM v_change""",
    "cdc_route": """SELECT "table", type, sink_type, sink_table, sink_pk, key FROM v_routed""",
    "cdc_prune_columns": """SELECT "table", type, sink_table, key, name, value FROM v_kept""",
    "cdc_route_as_of": """
        SELECT "table", type, sink_type, key::bigint AS key,
               CASE WHEN sink_table = 'dwd_order_insert' AND key::bigint >= 1000 AND key::bigint < 4000 THEN 'dwd_order'
                    ELSE sink_table END AS sink_table,
               CASE WHEN "table" = 'customer' AND type = 'update' AND key::bigint >= 60 THEN 'c_custkey,c_mktsegment'
                    WHEN "table" = 'customer' THEN 'c_custkey,c_name,c_nationkey'
                    WHEN type = 'insert' AND key::bigint >= 1000 AND key::bigint < 4000 THEN 'o_custkey,o_orderkey'
                    ELSE 'o_custkey,o_orderdate,o_orderkey,o_totalprice' END AS columns
        FROM v_routed WHERE NOT ("table" = 'orders' AND type = 'update' AND key::bigint >= 2000)""",
    "cdc_split_dim": """
        SELECT "table", type, upper(sink_table) AS sink_table, key, name, value FROM v_kept WHERE sink_type = 'hbase'""",
    "cdc_split_fact": """
        SELECT "table", type, sink_table, key, name, value FROM v_kept WHERE sink_type = 'kafka'""",
    "dim_rows_from_config": """
        SELECT c_custkey::varchar AS c_custkey, c_name, c_nationkey::varchar AS c_nationkey,
               CASE WHEN c_custkey % 3 = 2 THEN 'update' ELSE 'insert' END AS type FROM customer""",
    "dim_upsert_latest": """
        SELECT id, status, label, "offset" FROM (
            SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, "offset" DESC) AS rn FROM (
                SELECT c_custkey AS id, 'NEW' AS status, c_mktsegment AS label, timestamp '1970-01-01' AS ts,
                       cast(-1 AS bigint) AS "offset" FROM customer
                UNION ALL
                SELECT o_custkey, o_orderstatus, o_orderpriority, o_orderdate, o_orderkey FROM orders)) WHERE rn = 1""",
    "dim_upsert_columns": DIM_COLUMNS,
    "dim_change_log": DIM_COLUMNS,
    "cdc_dead_letters": """
        SELECT 'not json ' || o_orderkey AS value, 'record' AS reason FROM orders WHERE o_orderkey % 50 = 0
        UNION ALL SELECT '[100' || o_orderkey || ']', 'data' FROM orders WHERE o_orderkey % 50 = 1""",
    "dim_lookup": """
        SELECT sku_id, cast(click_ct AS bigint) AS click_ct, cast(display_ct AS bigint) AS display_ct, sku_name,
               category3_id, spu_id, tm_id FROM p_page LEFT JOIN d_sku ON id = sku_id""",
    "dim_lookup_multi": """
        SELECT c_custkey, c_nationkey, c_mktsegment,
               first_value(c_name) OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS first_name
        FROM customer""",
    "dim_lookup_as_of": """
        WITH named AS (
            SELECT l_partkey AS k, l_shipdate AS valid_from, l_orderkey * 10 + l_linenumber AS return_id,
                   l_linestatus AS status, l_orderkey % 10 = 0 AS deleted
            FROM lineitem WHERE l_returnflag = 'R'
            QUALIFY row_number() OVER (
                PARTITION BY k, valid_from ORDER BY return_id DESC, status DESC, deleted DESC) = 1
        )
        SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS sku_id,
               CASE WHEN NOT deleted THEN return_id END AS return_id,
               CASE WHEN NOT deleted THEN status ELSE 'none' END AS status
        FROM (SELECT * FROM lineitem WHERE l_returnflag <> 'R') d
        ASOF LEFT JOIN named n ON n.k = d.l_partkey AND n.valid_from <= d.l_shipdate""",
    "order_interval_join": f"""
        SELECT order_id, detail_id, sku_id, {text('create_ts')} AS create_time, split_total_amount FROM pairs_near""",
    "order_wide_user": """
        SELECT o.id, user_id, cast(date_diff('day', birthday, date '2024-01-01') // 365 AS integer) AS user_age,
               gender AS user_gender FROM v_order o LEFT JOIN d_user u ON u.id = user_id""",
    "order_wide_province": """
        SELECT o.id, province_id, name AS province_name, area_code AS province_area_code,
               iso_code AS province_iso_code, iso_3166_2 AS province_3166_2_code
        FROM v_order o LEFT JOIN d_province r ON r.id = province_id""",
    "order_wide_sku": """
        SELECT d.id, sku_id, CASE WHEN s.id IS NOT NULL THEN s.sku_name ELSE d.sku_name END AS sku_name,
               category3_id, spu_id, tm_id FROM v_detail d LEFT JOIN d_sku s ON s.id = sku_id""",
    "order_wide": "SELECT * FROM wide_near",
    "to_json_order_wide": "SELECT * FROM wide_near",
    "order_wide_coalesce": f"""
        SELECT d.order_id, d.id AS detail_id, sku_id,
               CASE WHEN d.id % 2 = 1 THEN {text('d.create_ts')} ELSE {text('o.create_ts')} END AS create_time,
               o.order_status, o.user_id, split_total_amount
        FROM v_detail d LEFT JOIN v_order o ON o.id = d.order_id""",
    "payment_interval_join": """
        SELECT payment_id, order_id, detail_id, callback_time, order_create_time FROM paid_near""",
    "payment_wide": "SELECT * FROM paid_near",
    "unique_visit": "SELECT event_id, mid, ts FROM v_unique",
    "bounce": "SELECT event_id, mid, ts FROM v_bounce",
    "visitor_measures": """
        SELECT vc, ch, ar, is_new, 0::bigint AS uv_ct, 1::bigint AS pv_ct,
               CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END::bigint AS sv_ct, 0::bigint AS uj_ct,
               during_time AS dur_sum, ts FROM v_page
        UNION ALL SELECT l.vc, l.ch, l.ar, l.is_new, 1, 0, 0, 0, 0, l.ts FROM v_unique u JOIN v_log l USING (event_id)
        UNION ALL SELECT l.vc, l.ch, l.ar, l.is_new, 0, 0, 0, 1, 0, l.ts FROM v_bounce b JOIN v_log l USING (event_id)""",
    "visitor_stats": "SELECT * FROM m_visitor",
    "visitor_by_new": "SELECT * FROM by_new",
    "visitor_kpis": """
        SELECT * EXCLUDE (rate_units, dur_units, page_units), cast(rate_units / 100 AS decimal(20,2)) AS uj_rate,
               cast(dur_units / 10 AS decimal(20,1)) AS dur_per_sv, cast(page_units / 100 AS decimal(20,2)) AS pv_per_sv
        FROM kpis""",
    "visitor_by_hour": "SELECT * FROM by_hour",
    "visitor_hour_dense": """
        SELECT lpad(cast(h AS varchar), 2, '0') AS hr, coalesce(uv_ct, 0) AS uv_ct, coalesce(pv_ct, 0) AS pv_ct,
               coalesce(new_uv, 0) AS new_uv FROM range(24) AS t(h) LEFT JOIN by_hour ON hr = h""",
    "visitor_new_old_table": """
        WITH f AS (
            SELECT is_new = '1' AS fresh, 1 AS i, '用户数(人)' AS type, cast(uv_ct AS decimal(20,2)) AS v FROM kpis
            UNION ALL SELECT is_new = '1', 2, '总访问页面(次)', pv_ct FROM kpis
            UNION ALL SELECT is_new = '1', 3, '跳出率(%)', cast(rate_units AS decimal(20,2)) / 100 FROM kpis
            UNION ALL SELECT is_new = '1', 4, '平均在线时长(秒)', cast(dur_units AS decimal(20,2)) / 10 FROM kpis
            UNION ALL SELECT is_new = '1', 5, '平均访问人数(人次)', cast(page_units AS decimal(20,2)) / 100 FROM kpis)
        SELECT type, cast(coalesce(max(v) FILTER (WHERE fresh), 0) AS decimal(20,2)) AS "new",
               cast(coalesce(max(v) FILTER (WHERE NOT fresh), 0) AS decimal(20,2)) AS "old" FROM f GROUP BY type""",
    "product_measures_page": """
        SELECT sku_id, cast(click_ct AS bigint) AS click_ct, cast(display_ct AS bigint) AS display_ct, ts FROM p_page""",
    "product_measures_order": f"""
        SELECT sku_id, 'order' AS order_kind, order_id AS kind_order_id, sku_num AS order_sku_num,
               split_total_amount AS order_amount, {text('create_ts')} AS "at" FROM pairs_far""",
    "product_measures_favor_cart": f"""
        SELECT sku_id, CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END::bigint AS favor_ct,
               CASE WHEN event_type = 'view' THEN 1 ELSE 0 END::bigint AS cart_ct, {text('create_ts')} AS "at"
        FROM v_sku_event WHERE event_type IN ('signup', 'view')""",
    "product_measures_payment": f"""
        SELECT sku_id, 'paid' AS order_kind, order_id AS kind_order_id, split_total_amount AS payment_amount,
               {text('create_ts')} AS "at" FROM paid_far""",
    "product_measures_refund": f"""
        SELECT l_partkey AS sku_id, 'refund' AS order_kind, l_orderkey AS kind_order_id,
               cast(l_extendedprice AS decimal(18,2)) AS refund_amount, {text('l_shipdate')} AS "at"
        FROM lineitem WHERE l_returnflag = 'R'""",
    "product_measures_comment": f"""
        SELECT sku_id, 1::bigint AS comment_ct, CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END::bigint AS good_comment_ct,
               {text('create_ts')} AS "at" FROM v_sku_event WHERE event_type = 'purchase'""",
    "product_stats": "SELECT * FROM m_product",
    "gmv": """
        SELECT cast(coalesce(sum(order_amount), 0) AS decimal(28,2)) AS order_amount FROM m_product
        WHERE substr(stt, 1, 10) = '1998-05-04'""",
    "top_trademark": TOP.format(keys="tm_id, tm_name", more=""),
    "top_category3": TOP.format(keys="category3_id, category3_name", more=""),
    "top_spu": TOP.format(keys="spu_id, spu_name", more=", cast(sum(order_ct) AS bigint) AS order_ct"),
    "spu_orders_by_year": f"""
        SELECT substr(stt, 1, 4) AS year, spu_id, count(DISTINCT order_id) AS order_ct,
               count(DISTINCT paid_id) AS paid_order_ct, count(DISTINCT refund_id) AS refund_order_ct
        FROM (SELECT {window('us', MONTH_US)}, sku_id, order_id, paid_id, refund_id FROM p_rows
              WHERE order_id IS NOT NULL OR paid_id IS NOT NULL OR refund_id IS NOT NULL)
        JOIN d_sku s ON s.id = sku_id GROUP BY year, spu_id""",
    "trademark_series": f"""
        SELECT cast(row_number() OVER (ORDER BY order_amount DESC, tm_name) - 1 AS integer) AS pos, tm_name AS name,
               order_amount AS value FROM ({TOP.format(keys='tm_id, tm_name', more='')})""",
    "province_stats": "SELECT * FROM m_province",
    "province_amount": """
        SELECT province_name, cast(sum(order_amount) AS decimal(28,2)) AS order_amount FROM m_province
        WHERE substr(stt, 1, 10) = '1998-05-04' GROUP BY province_id, province_name""",
    "province_map": """
        SELECT province_name AS name, cast(sum(order_amount) AS decimal(28,2)) AS value FROM m_province
        WHERE substr(stt, 1, 10) = '1998-05-04' GROUP BY province_id, province_name""",
    "search_keywords": "SELECT keyword, rowtime FROM v_word",
    "tokenize_documents": r"""
        SELECT doc_id, keyword, count(*) AS ct FROM (
            SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS keyword FROM documents)
        GROUP BY doc_id, keyword""",
    "tokenize_dictionary": r"""
        WITH RECURSIVE han AS (
            SELECT doc_id, translate(lower(text), 'abcdefghijklmnopqrstuvwxyz',
                                     '天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余') AS t FROM documents),
        run_of AS (SELECT doc_id, unnest(regexp_extract_all(t, '\p{Han}+')) AS run FROM han),
        runs AS (SELECT DISTINCT run FROM run_of),
        known AS (SELECT run AS word FROM runs WHERE length(run) BETWEEN 2 AND 4),
        walk AS (
            SELECT run, 1 AS place, CAST(NULL AS varchar) AS piece FROM runs
            UNION ALL
            SELECT run, place + length(piece), piece FROM (
                SELECT run, place,
                       CASE WHEN substr(run, place, 4) IN (SELECT word FROM known) THEN substr(run, place, 4)
                            WHEN substr(run, place, 3) IN (SELECT word FROM known) THEN substr(run, place, 3)
                            WHEN substr(run, place, 2) IN (SELECT word FROM known) THEN substr(run, place, 2)
                            ELSE substr(run, place, 1) END AS piece
                FROM walk WHERE place <= length(run)))
        SELECT doc_id, keyword, count(*) AS ct FROM (
            SELECT doc_id, piece AS keyword FROM run_of JOIN walk USING (run) WHERE piece IS NOT NULL
            UNION ALL
            SELECT doc_id, unnest(regexp_extract_all(regexp_replace(t, '\p{Han}+', ' ', 'g'), '[\p{L}\p{N}]+'))
            FROM han)
        GROUP BY doc_id, keyword""",
    "tokenize_smart": r"""
        WITH RECURSIVE han AS (
            SELECT doc_id, translate(lower(text), 'abcdefghijklmnopqrstuvwxyz',
                                     '天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余') AS t FROM documents),
        run_of AS (SELECT doc_id, unnest(regexp_extract_all(t, '\p{Han}+')) AS run FROM han),
        runs AS (SELECT DISTINCT run FROM run_of),
        known AS (SELECT run AS word FROM runs WHERE length(run) BETWEEN 2 AND 4),
        -- the best covers up to a place and the three before: covered, - words, - squares, late words, last piece
        cover AS (
            SELECT run, 0 AS place, [[0, 0, 0, 0, 0]] AS best FROM runs
            UNION ALL
            SELECT run, place + 1, list_prepend(list_max(list_filter([
                       list_concat(best[1][1:4], [0]),
                       CASE WHEN w2 THEN [best[2][1] + 2, best[2][2] - 1, best[2][3] - 4, best[2][4] + 2 * (1 - best[2][2]), 2] END,
                       CASE WHEN w3 THEN [best[3][1] + 3, best[3][2] - 1, best[3][3] - 9, best[3][4] + 3 * (1 - best[3][2]), 3] END,
                       CASE WHEN w4 THEN [best[4][1] + 4, best[4][2] - 1, best[4][3] - 16, best[4][4] + 4 * (1 - best[4][2]), 4] END
                   ], lambda x: x IS NOT NULL)), best[1:3])
            FROM (
                SELECT *, place >= 1 AND substr(run, place, 2) IN (SELECT word FROM known) AS w2,
                       place >= 2 AND substr(run, place - 1, 3) IN (SELECT word FROM known) AS w3,
                       place >= 3 AND substr(run, place - 2, 4) IN (SELECT word FROM known) AS w4
                FROM cover WHERE place < length(run))),
        last AS (SELECT run, place, greatest(best[1][5], 1) AS size FROM cover),
        back AS (
            SELECT run, length(run) AS place, CAST(NULL AS varchar) AS piece FROM runs
            UNION ALL
            SELECT b.run, b.place - l.size, substr(b.run, (b.place - l.size + 1)::BIGINT, l.size::BIGINT)
            FROM back b JOIN last l ON b.run = l.run AND b.place = l.place WHERE b.place > 0)
        SELECT doc_id, keyword, count(*) AS ct FROM (
            SELECT doc_id, piece AS keyword FROM run_of JOIN back USING (run) WHERE piece IS NOT NULL
            UNION ALL
            SELECT doc_id, unnest(regexp_extract_all(regexp_replace(t, '\p{Han}+', ' ', 'g'), '[\p{L}\p{N}]+'))
            FROM han)
        GROUP BY doc_id, keyword""",
    "product_keywords": r"""
        SELECT id, unnest(regexp_extract_all(lower(spu_name), '[\p{L}\p{N}]+')) AS keyword FROM d_spu""",
    "product_keyword_sources": "SELECT stt, sku_id, ct, source FROM product_source",
    "keyword_stats_search": "SELECT * FROM m_search",
    "keyword_stats_product": "SELECT * FROM m_keyword_product",
    "keyword_score": """
        SELECT keyword, cast(score AS bigint) AS ct FROM (
            SELECT keyword, sum(ct * CASE source WHEN 'SEARCH' THEN 10 WHEN 'ORDER' THEN 3 WHEN 'CART' THEN 2
                                                 WHEN 'CLICK' THEN 1 ELSE 0 END) AS score, sum(ct) AS n
            FROM (SELECT keyword, ct, source, stt FROM m_search
                  UNION ALL SELECT keyword, ct, source, stt FROM m_keyword_product)
            WHERE substr(stt, 1, 10) = '2024-01-18' GROUP BY keyword ORDER BY n DESC, keyword LIMIT 20)""",
    "keyword_score_sources": """
        SELECT keyword, cast(score AS bigint) AS ct FROM (
            SELECT keyword, sum(ct * CASE source WHEN 'SEARCH' THEN 10 WHEN 'ORDER' THEN 3 WHEN 'CART' THEN 2
                                                 WHEN 'CLICK' THEN 1 ELSE 0 END) AS score
            FROM (SELECT keyword, ct, source, stt FROM m_search
                  UNION ALL SELECT keyword, ct, source, stt FROM m_keyword_product)
            WHERE substr(stt, 1, 10) = CASE source WHEN 'ORDER' THEN '1998-05-04' ELSE '2024-01-18' END
            GROUP BY keyword ORDER BY score DESC, keyword LIMIT 200)""",
}


def _needed(sql: str, seen: list[str]) -> list[str]:
    for name, body in STEPS.items():
        if name not in seen and re.search(rf"\b{name}\b", sql):
            _needed(body, seen)
            if name not in seen:
                seen.append(name)
    return seen


def statement(name: str) -> str:
    """The statement with the steps it needs in front, each after the ones it reads."""
    body = STATEMENTS[name].strip()
    steps = [f"{step} AS ({STEPS[step].strip()})" for step in _needed(body, [])]
    if not steps:
        return body
    if body.startswith("WITH "):
        return "WITH " + ",\n".join(steps) + ",\n" + body[len("WITH "):]
    return "WITH " + ",\n".join(steps) + "\n" + body
