"""The registered queries in plain SQL over the sample tables, written independently of the DataFrames."""

from __future__ import annotations

_LOGS = """
logs AS (
  SELECT 'mid_' || user_id AS mid, CAST(user_id AS VARCHAR) AS uid, CAST(user_id % 34 AS VARCHAR) AS ar,
         event_type AS ch, json_extract_string(props, '$.k') AS vc, epoch_us(ts) // 1000 AS ts,
         strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr, strftime(ts, '%M') AS mi,
         event_type IN ('signup', 'view') AS is_start
  FROM events),
dau AS (
  SELECT mid, uid, ar, ch, vc, dt, hr, mi, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, dt
                                 ORDER BY ts, uid NULLS FIRST, ar NULLS FIRST, ch NULLS FIRST, vc NULLS FIRST) AS rn
    FROM logs WHERE is_start)
  WHERE rn = 1)"""

_SKU = """
sku AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, CAST(('0x' || substr(md5(p_name), 1, 15))::BIGINT AS VARCHAR) AS spu_id,
         CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS price, p_name AS sku_name,
         split_part(p_brand, '#', 2) AS tm_id,
         CAST(('0x' || substr(md5(p_type), 1, 15))::BIGINT AS VARCHAR) AS category3_id, '2024-01-01' AS create_time,
         p_type AS category3_name, p_name AS spu_name, p_brand AS tm_name,
         p_partkey, CAST(round(p_retailprice * 100) AS BIGINT) AS price_cents
  FROM part)"""

_USERS = """
birthdays AS (
  SELECT *, DATE '2024-01-01' - CAST((c_custkey % 50 + 10) * 365 AS INTEGER) AS born FROM customer),
users AS (
  SELECT c_custkey AS user_id, CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS user_level,
         strftime(born, '%Y-%m-%d') AS birthday, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         CAST(date_diff('day', born, DATE '2024-01-01') // 365 AS INTEGER) AS user_age,
         CASE WHEN date_diff('day', born, DATE '2024-01-01') // 365 < 20 THEN '20岁及以下'
              WHEN date_diff('day', born, DATE '2024-01-01') // 365 > 30 THEN '30岁以上'
              ELSE '21岁到30岁' END AS age_group,
         CASE WHEN c_custkey % 2 = 0 THEN '男' ELSE '女' END AS gender_name
  FROM birthdays)"""

_LINES = (
    _SKU
    + """,
lines AS (
  SELECT l_linenumber * 100000000000000000 + l_partkey * 1000000
           + date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) * 100
           + row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_shipdate
                                ORDER BY l_suppkey, l_quantity, l_extendedprice) AS id,
         l_orderkey AS order_id, l_partkey AS sku_id, CAST(l_quantity AS BIGINT) AS sku_num, l_linenumber, l_returnflag,
         s.price_cents, s.price_cents * CAST(l_quantity AS BIGINT) AS amount, s.sku_name,
         CAST(s.spu_id AS BIGINT) AS spu_id, CAST(s.tm_id AS BIGINT) AS tm_id,
         CAST(s.category3_id AS BIGINT) AS category3_id, s.spu_name, s.tm_name, s.category3_name
  FROM lineitem LEFT JOIN sku s ON s.p_partkey = l_partkey)"""
)

_ORDER_TIMES = """
order_times AS (
  SELECT *, strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))
                                 + to_minutes(CAST(o_orderkey % 60 AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS create_time
  FROM orders)"""

_HEADS = (
    _LINES
    + ","
    + _USERS
    + ","
    + _ORDER_TIMES
    + """,
originals AS (SELECT order_id, CAST(sum(amount) AS BIGINT) AS original_cents FROM lines GROUP BY order_id),
heads AS (
  SELECT o.o_orderkey AS id, CAST(c.c_nationkey AS BIGINT) AS province_id, o.o_orderstatus AS order_status,
         o.o_custkey AS user_id, CAST(round(o.o_totalprice * 100) AS BIGINT) AS final_cents,
         t.original_cents, o.o_orderkey % 10 AS fee, o.create_time,
         substr(o.create_time, 1, 10) AS create_date, substr(o.create_time, 12, 2) AS create_hour,
         CASE WHEN row_number() OVER (PARTITION BY o.o_custkey ORDER BY o.create_time, o.o_orderkey) = 1
              THEN '1' ELSE '0' END AS if_first_order,
         n.n_name AS province_name, CAST(n.n_regionkey AS VARCHAR) AS province_area_code,
         'X-' || n.n_nationkey AS province_3166_2_code, u.age_group AS user_age_group, u.gender_name AS user_gender
  FROM order_times o
  LEFT JOIN originals t ON t.order_id = o.o_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN users u ON u.user_id = o.o_custkey)"""
)

_SHARES = (
    _HEADS
    + """,
wide AS (
  SELECT h.*, l.id AS order_detail_id, l.order_id, l.sku_id, l.sku_num, l.price_cents, l.amount, l.sku_name,
         l.spu_id, l.tm_id, l.category3_id, l.spu_name, l.tm_name, l.category3_name
  FROM heads h JOIN lines l ON l.order_id = h.id),
running AS (
  SELECT *,
         CASE WHEN coalesce(original_cents, 0) <= 0 THEN 0
              ELSE CAST((2 * CAST(final_cents AS HUGEINT) * amount + original_cents) // (2 * original_cents) AS BIGINT)
         END AS share,
         sum(amount) OVER up_to AS amount_so_far
  FROM wide
  WINDOW up_to AS (PARTITION BY order_id ORDER BY order_detail_id ROWS UNBOUNDED PRECEDING)),
split AS (
  SELECT *, CASE WHEN amount_so_far = original_cents
                 THEN final_cents - coalesce(sum(share) OVER (PARTITION BY order_id ORDER BY order_detail_id
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 ELSE share END AS paid_cents
  FROM running)"""
)

# Totals that miss a line or name one too many.
_PARTIAL = _SHARES.replace(
    "CAST(sum(amount) AS BIGINT) AS original_cents",
    """CAST(sum(amount) + CASE order_id % 3 WHEN 0 THEN 100 WHEN 1 THEN -arg_max(amount, id) ELSE 0 END AS BIGINT)
                AS original_cents""",
)

_STAT = (
    _SHARES
    + """,
stat AS (
  SELECT substr(stat_time, 1, 10) AS stat_date, stat_time, tm_id, tm_name, sum(paid_cents) AS cents
  FROM (SELECT strftime(make_timestamp((epoch(CAST(create_time AS TIMESTAMP))::BIGINT // 5 * 5) * 1000000),
                        '%Y-%m-%d %H:%M:%S') AS stat_time, CAST(tm_id AS VARCHAR) AS tm_id, tm_name, paid_cents
        FROM split)
  GROUP BY stat_time, tm_id, tm_name),
top AS (
  SELECT tm_id, tm_name, sum(cents) AS cents FROM stat GROUP BY tm_id, tm_name ORDER BY cents DESC, tm_id LIMIT 5)"""
)

_ARRIVALS = (
    _HEADS
    + """,
order_arrivals AS (SELECT *, (id * 7) % 2592000 AS at FROM heads),
sent AS (
  SELECT l.*, again.again FROM lines l
  JOIN (VALUES (0, FALSE), (5, TRUE)) AS again(again, returned_only)
    ON NOT again.returned_only OR l.l_returnflag = 'R')"""
)


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def _amount(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100"


def _hour_compare(hourly: str, zero: str) -> str:
    return f"""
, hourly AS ({hourly}),
spine AS (SELECT d.dt, lpad(CAST(h.h AS VARCHAR), 2, '0') AS hr
          FROM (SELECT DISTINCT dt FROM hourly) d CROSS JOIN range(24) AS h(h))
SELECT s.dt, s.hr, coalesce(t.value, {zero}) AS today, coalesce(y.value, {zero}) AS yesterday
FROM spine s
LEFT JOIN hourly t ON t.dt = s.dt AND t.hr = s.hr
LEFT JOIN hourly y ON y.dt = strftime(CAST(s.dt AS DATE) - 1, '%Y-%m-%d') AND y.hr = s.hr"""


_ORDER_WIDE_SELECT = """
SELECT order_detail_id, order_id, order_status, create_time, user_id, sku_id, CAST(price_cents AS DOUBLE) / 100 AS sku_price,
       sku_num, sku_name, CAST(0 AS DOUBLE) AS benefit_reduce_amount, CAST(fee AS DOUBLE) AS feight_fee,
       CAST(coalesce(original_cents, 0) AS DOUBLE) / 100 AS original_total_amount,
       CAST(final_cents AS DOUBLE) / 100 AS final_total_amount, CAST(0 AS DOUBLE) AS final_detail_amount,
       if_first_order, province_name, province_area_code, user_age_group, user_gender, create_date AS dt,
       spu_id, tm_id, category3_id, spu_name, tm_name, category3_name
FROM wide"""

_PAIR_SELECT = """
SELECT DISTINCT o.id AS order_id, s.id AS order_detail_id, o.user_id, s.sku_id, s.sku_num, o.create_date AS dt
FROM order_arrivals o JOIN sent s ON s.order_id = o.id"""

_RED = "list_contains(regexp_split_to_array(lower(sku_name), '\\W+'), 'red')"


def oracle_sql() -> dict[str, str]:
    sql = {}
    sql["app_log_route"] = _with(
        _LOGS,
        """SELECT CASE WHEN is_start THEN 'APP_START' ELSE 'APP_EVENT' END AS topic, dt, count(*) AS records
           FROM logs GROUP BY 1, 2""",
    )
    sql["raw_log_archive_counts"] = _with(_LOGS, "SELECT dt, count(*) AS records FROM logs GROUP BY dt")
    sql["dau_detail"] = _with(_LOGS, "SELECT * FROM dau")
    sql["dau_total"] = _with(_LOGS, "SELECT dt, count(*) AS total FROM dau GROUP BY dt")
    sql["dau_hour"] = _with(_LOGS, "SELECT dt, hr, count(*) AS total FROM dau GROUP BY dt, hr")
    sql["dau_hour_compare"] = _with(
        _LOGS, _hour_compare("SELECT dt, hr, count(*) AS value FROM dau GROUP BY dt, hr", "0")
    )
    sql["cdc_object_route"] = """
SELECT 'ODS_ORDER_INFO' AS topic, CAST(NULL AS VARCHAR) AS order_id, CAST(o_orderkey AS VARCHAR) AS id
FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT'
UNION ALL
SELECT 'ODS_ORDER_DETAIL', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR) FROM lineitem WHERE l_returnflag <> 'R'
UNION ALL SELECT 'ODS_SKU_INFO', NULL, CAST(p_partkey AS VARCHAR) FROM part
UNION ALL SELECT 'ODS_USER_INFO', NULL, CAST(c_custkey AS VARCHAR) FROM customer
UNION ALL SELECT 'ODS_BASE_PROVINCE', NULL, CAST(n_nationkey AS VARCHAR) FROM nation"""
    sql["cdc_array_route"] = """
SELECT 'ODS_ORDER_INFO' AS topic, CAST(NULL AS VARCHAR) AS order_id, CAST(o_orderkey AS VARCHAR) AS id
FROM orders WHERE o_orderstatus <> 'P'
UNION ALL
SELECT 'ODS_ORDER_DETAIL', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR) FROM lineitem WHERE l_returnflag <> 'R'
UNION ALL
SELECT 'ODS_ORDER_DETAIL', CAST(l_orderkey AS VARCHAR), CAST(-l_linenumber AS VARCHAR) FROM lineitem
WHERE l_returnflag <> 'R' AND l_linenumber % 2 = 0"""
    sql["dim_province"] = """
SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, CAST(n_regionkey AS VARCHAR) AS area_code,
       'N-' || n_nationkey AS iso_code, 'X-' || n_nationkey AS iso_3166_2 FROM nation"""
    sql["dim_category3"] = _with(
        _SKU, "SELECT DISTINCT category3_id AS id, category3_name AS name, '0' AS category2_id FROM sku"
    )
    sql["dim_trademark"] = _with(_SKU, "SELECT DISTINCT tm_id, tm_name FROM sku")
    sql["dim_spu"] = _with(_SKU, "SELECT DISTINCT spu_id AS id, spu_name FROM sku")
    sql["dim_user"] = _with(
        _USERS, "SELECT id, user_level, birthday, gender, age_group, gender_name FROM users"
    )
    sql["dim_sku"] = _with(
        _SKU,
        """SELECT id, spu_id, price, sku_name, tm_id, category3_id, create_time, category3_name, spu_name, tm_name
           FROM sku""",
    )
    sql["dim_upsert_latest"] = """
SELECT id, price_cents, change_id, change_line, source_id FROM (
  SELECT CAST(l_partkey AS VARCHAR) AS id, CAST(floor(l_extendedprice / l_quantity * 100 + 0.5) AS BIGINT) AS price_cents,
         l_orderkey AS change_id, l_linenumber AS change_line, l_suppkey AS source_id,
         row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC,
                            l_suppkey DESC, floor(l_extendedprice / l_quantity * 100 + 0.5) DESC) AS rn
  FROM lineitem) WHERE rn = 1"""
    prior = "substr(create_time, 1, 10) < '1996-01-01'"
    sql["order_first_flag"] = _with(
        _ORDER_TIMES,
        f"""SELECT o_orderkey AS id, o_custkey AS user_id, substr(create_time, 1, 10) AS create_date,
                   substr(create_time, 12, 2) AS create_hour,
                   CASE WHEN o_custkey NOT IN (SELECT o_custkey FROM order_times WHERE {prior})
                             AND row_number() OVER (PARTITION BY o_custkey ORDER BY create_time, o_orderkey) = 1
                        THEN '1' ELSE '0' END AS if_first_order
            FROM order_times WHERE NOT {prior}""",
    )
    sql["user_state_upsert"] = _with(
        _ORDER_TIMES,
        """SELECT CAST(o_custkey AS VARCHAR) AS user_id, '1' AS if_consumed, o_orderkey AS first_order_id
           FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY create_time, o_orderkey) AS rn
                 FROM order_times) WHERE rn = 1""",
    )
    sql["order_info_wide"] = _with(
        _HEADS,
        """SELECT id, province_id, order_status, user_id, CAST(final_cents AS DOUBLE) / 100 AS final_total_amount,
                  CAST(0 AS DOUBLE) AS benefit_reduce_amount, CAST(original_cents AS DOUBLE) / 100 AS original_total_amount,
                  CAST(fee AS DOUBLE) AS feight_fee, create_time, create_date, create_hour, if_first_order,
                  province_name, province_area_code, province_3166_2_code, user_age_group, user_gender
           FROM heads""",
    )
    sql["order_detail_wide"] = _with(
        _LINES,
        """SELECT id, order_id, sku_id, CAST(price_cents AS DOUBLE) / 100 AS order_price, sku_num, sku_name,
                  spu_id, tm_id, category3_id, spu_name, tm_name, category3_name FROM lines""",
    )
    sql["unmatched_users"] = """
SELECT count(*) AS unmatched FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"""
    sql["order_join_window"] = _with(
        _ARRIVALS,
        _PAIR_SELECT + "\nWHERE abs((o.at // 5) - ((o.at + s.l_linenumber * 4 + s.again) // 5)) <= 2",
    )
    sql["order_join_cache"] = _with(
        _ARRIVALS, _PAIR_SELECT + "\nWHERE s.l_linenumber * 140 + s.again < 600"
    )
    sql["order_wide"] = _with(_SHARES, _ORDER_WIDE_SELECT)
    sql["order_split"] = _with(
        _SHARES,
        f"""SELECT order_id, order_detail_id, {_amount('final_cents')} AS final_total_amount,
                   {_amount('original_cents')} AS original_total_amount, {_amount('paid_cents')} AS final_detail_amount
            FROM split""",
    )
    split = f"""SELECT order_id, order_detail_id, {_amount('original_cents')} AS original_total_amount,
                       {_amount('paid_cents')} AS final_detail_amount FROM split"""
    sql["order_split_partial"] = _with(_PARTIAL, split)
    sql["order_split_sliced"] = _with(_PARTIAL, split)
    sql["trademark_batch_stat"] = _with(
        _STAT, f"SELECT stat_date, stat_time, tm_id, tm_name, {_amount('cents')} AS amount FROM stat"
    )
    sql["trademark_topn"] = _with(_STAT, f"SELECT tm_id, tm_name, {_amount('cents')} AS amount FROM top")
    sql["datav_trademark"] = _with(_STAT, f"SELECT tm_name AS x, {_amount('cents')} AS y, '1' AS s FROM top")
    sql["order_total"] = _with(
        _SHARES, f"SELECT create_date AS dt, {_amount('sum(paid_cents)')} AS amount FROM split GROUP BY 1"
    )
    hourly = f"SELECT create_date AS dt, create_hour AS hr, {_amount('sum(paid_cents)')} AS %s FROM split GROUP BY 1, 2"
    sql["order_hour"] = _with(_SHARES, hourly % "amount")
    sql["order_hour_compare"] = _with(_SHARES, _hour_compare(hourly % "value", "0"))
    sql["dau_total_day"] = _with(_LOGS, "SELECT '2024-01-15' AS dt, count(*) AS total FROM dau WHERE dt = '2024-01-15'")
    sql["order_total_day"] = _with(
        _SHARES,
        f"""SELECT '1996-09-17' AS dt, coalesce({_amount('sum(paid_cents)')}, 0) AS amount
            FROM split WHERE create_date = '1996-09-17'""",
    )
    sql["order_hour_day"] = _with(
        _SHARES,
        f"""SELECT create_date AS dt, create_hour AS hr, {_amount('sum(paid_cents)')} AS amount
            FROM split WHERE create_date = '1996-09-17' GROUP BY 1, 2""",
    )
    sql["hour_compare_day"] = _with(
        _SHARES,
        f""", hourly AS ({hourly % "value"})
SELECT '1996-09-17' AS dt, lpad(CAST(h.h AS VARCHAR), 2, '0') AS hr, coalesce(t.value, 0) AS today,
       coalesce(y.value, 0) AS yesterday
FROM range(24) AS h(h)
LEFT JOIN hourly t ON t.dt = '1996-09-17' AND CAST(t.hr AS INTEGER) = h.h
LEFT JOIN hourly y ON y.dt = '1996-09-16' AND CAST(y.hr AS INTEGER) = h.h""",
    )
    sql["trademark_topn_range"] = _with(
        _STAT,
        f"""SELECT tm_id, tm_name, {_amount('sum(cents)')} AS amount FROM stat
            WHERE stat_date BETWEEN '1996-07-01' AND '1996-12-31'
            GROUP BY tm_id, tm_name ORDER BY sum(cents) DESC, tm_id LIMIT 5""",
    )
    sql["realtime_total"] = _with(
        _LOGS + "," + _SHARES,
        f""", days AS (
  SELECT dt, sum(dau) AS dau, sum(amount) AS amount FROM (
    SELECT dt, count(*) AS dau, CAST(0 AS DOUBLE) AS amount FROM dau GROUP BY dt
    UNION ALL SELECT create_date, 0, {_amount('sum(paid_cents)')} FROM split GROUP BY create_date)
  GROUP BY dt)
SELECT dt, 'dau' AS id, '新增日活' AS name, CAST(dau AS DOUBLE) AS value FROM days
UNION ALL SELECT dt, 'order_amount', '新增交易额', amount FROM days""",
    )
    sql["search_page"] = _with(
        _SKU,
        f"""SELECT p_partkey AS id, spu_id, CAST(price_cents AS DOUBLE) / 100 AS price, sku_name, tm_id, category3_id,
                   create_time, category3_name, spu_name, tm_name
            FROM sku WHERE {_RED} ORDER BY price_cents, p_partkey LIMIT 20 OFFSET 5""",
    )
    sql["sale_detail"] = _with(
        _SHARES,
        f"""SELECT w.order_detail_id, w.order_id, w.user_id, w.sku_id, w.user_gender, u.user_age, u.user_level,
                   CAST(w.price_cents AS DOUBLE) / 100 AS sku_price, w.sku_name, CAST(w.tm_id AS VARCHAR) AS sku_tm_id,
                   w.create_date AS dt
            FROM wide w LEFT JOIN users u ON u.user_id = w.user_id WHERE {_RED}
            ORDER BY w.create_date, w.order_id, w.order_detail_id LIMIT 20 OFFSET 20""",
    )
    sql["sale_detail_total"] = _with(_SHARES, f"SELECT count(*) AS total FROM wide WHERE {_RED}")
    sql["sale_detail_stats"] = _with(
        _SHARES,
        f""", groups AS (
  SELECT 'age' AS stat, user_age_group AS name, count(*) AS value FROM wide WHERE {_RED} GROUP BY 2
  UNION ALL SELECT 'gender', user_gender, count(*) FROM wide WHERE {_RED} GROUP BY 2)
SELECT stat, name, value,
       floor((value * 100) / CAST(sum(value) OVER (PARTITION BY stat) AS DOUBLE) * 10 + 0.5) / 10 AS share
FROM groups""",
    )
    sql["province_sales"] = _with(
        _SHARES, "SELECT province_name, CAST(sum(sku_num) AS BIGINT) AS sku_num FROM wide GROUP BY province_name"
    )
    # Stored tables give what the whole rows give.
    for stored, whole in {
        "dim_upsert_stored": "dim_upsert_latest",
        "user_state_stored": "user_state_upsert",
        "order_split_stored": "order_split_partial",
        "order_total_stored": "order_total_day",
        "order_hour_stored": "order_hour_day",
        "hour_compare_stored": "hour_compare_day",
        "trademark_range_stored": "trademark_topn_range",
        "dau_total_stored": "dau_total_day",
        "search_index": "search_page",
        "sale_detail_keyset": "sale_detail",
    }.items():
        sql[stored] = sql[whole]
    sql["brand_amount_sliding"] = _with(
        _SHARES
        + """,
moments AS (
  SELECT CAST(tm_id AS VARCHAR) AS tm_id, tm_name, paid_cents,
         1704067200 + (order_id * 7) % 2592000 + order_detail_id // 100000000000000000 * 4 AS second
  FROM split),
windows AS (SELECT tm_id, tm_name, paid_cents, second // 5 * 5 - 5 * k AS start FROM moments, range(3) AS back(k))""",
        f"""
SELECT strftime(make_timestamp(start * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(make_timestamp((start + 15) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end,
       tm_id, tm_name, {_amount("sum(paid_cents)")} AS amount
FROM windows GROUP BY start, tm_id, tm_name""",
    )
    return sql
