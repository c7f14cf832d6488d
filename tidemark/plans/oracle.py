"""For each registered query, SQL that computes the same from the test tables."""

from __future__ import annotations

SALES = """sales AS (
  SELECT event_id AS id, (user_id % 10)::INTEGER AS store_sk, user_id AS item_sk,
         value::DECIMAL(12,2) AS price, ts
  FROM events WHERE event_type = 'purchase')"""
RETURNS = SALES.replace("sales AS", "returns AS").replace("'purchase'", "'error'")

DAY = "time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01')"
_LOCAL_DAY = "time_bucket(INTERVAL 1 DAY, ts + INTERVAL 8 HOUR, TIMESTAMP '1970-01-01')"
_MINUTE = "time_bucket(INTERVAL 1 MINUTE, ts, TIMESTAMP '1970-01-01')"


def _half_up(cents: str, n: str) -> str:
    """Average of n amounts given their sum in cents, rounded half away from zero to cents."""
    return f"(sign({cents}) * ((2 * abs({cents}) + {n}) // (2 * {n})))::DOUBLE / 100"


def _sales_metrics(bucket: str, length: str, closed: str = "") -> str:
    return f"""WITH {SALES}, b AS (SELECT *, {bucket} AS w FROM sales)
    SELECT w AS window_start, w + INTERVAL {length} AS window_end, store_sk::BIGINT AS store_sk,
           count(*) AS total_sales, sum(price)::DOUBLE AS total_revenue,
           sum(price * 0.25::DECIMAL(3,2))::DOUBLE AS total_profit,
           {_half_up('(sum(price) * 100)::BIGINT', 'count(*)')} AS avg_order_value,
           arg_min(item_sk, (ts, id)) AS first_item_sk
    FROM b GROUP BY w, store_sk {closed}"""


def _late_rows() -> str:
    """Rows of store 3 come last: those whose window the others' newest event has closed are dropped."""
    others = "(SELECT max(ts) - INTERVAL 5 SECOND FROM sales WHERE store_sk <> 3)"
    return _sales_metrics(DAY, "1 DAY", f"HAVING w + INTERVAL 1 DAY <= {SALES_SEEN}").replace(
        "FROM b GROUP", f"FROM b WHERE store_sk <> 3 OR w + INTERVAL 1 DAY > {others} GROUP")


def _return_metrics() -> str:
    return f"""WITH {RETURNS}
      SELECT {DAY} AS window_start, {DAY} + INTERVAL 1 DAY AS window_end, store_sk::BIGINT AS store_sk,
        count(*) AS total_returns, sum(price)::DOUBLE AS total_return_amount,
        sum(price * 0.25::DECIMAL(3,2))::DOUBLE AS total_loss, count(*)::DOUBLE / 100 AS pseudo_return_rate
      FROM returns GROUP BY ALL"""


def _alerts(closed: str = "") -> str:
    return f"""WITH {RETURNS}, g AS (
      SELECT {DAY} AS w, store_sk, count(*) AS n FROM returns GROUP BY 1, 2 {closed}),
    r AS (SELECT *, CASE WHEN n > 10 THEN (n * 2000000)::DECIMAL(30,0) ELSE 0 END AS rate_e8 FROM g)
    SELECT w + INTERVAL 1 DAY AS alert_time, 'HIGH_RETURN_RATE' AS alert_type, store_sk::BIGINT AS store_sk,
           '商店 ' || store_sk || ' 退货率异常：' || (n * 2)::VARCHAR || '.00000000%' AS message,
           (n * 2)::DOUBLE AS value
    FROM r WHERE rate_e8 > 15000000"""


def trends(closed: str = "") -> str:
    return f"""WITH {SALES}, h AS (
      SELECT *, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') - k * INTERVAL 6 HOUR AS w
      FROM sales, range(4) t(k))
    SELECT w AS window_start, w + INTERVAL 1 DAY AS window_end, item_sk, count(*) AS sales_count,
           sum(price)::DOUBLE AS revenue,
           CASE WHEN count(*) > 10 THEN 'HOT' WHEN count(*) > 5 THEN 'NORMAL' ELSE 'COLD' END AS trend_direction
    FROM h GROUP BY w, item_sk HAVING count(*) > 1 {closed}"""


# A stream emits the windows that its watermark has passed: five seconds behind the newest event.
SALES_SEEN = "(SELECT max(ts) - INTERVAL 5 SECOND FROM sales)"
_RETURNS_SEEN = "(SELECT max(ts) - INTERVAL 5 SECOND FROM returns)"

_OP = "CASE WHEN l_returnflag = 'R' THEN '-D' WHEN l_linestatus = 'F' THEN '+U' ELSE '+I' END"
_ROW = ("l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity,"
        " l_extendedprice, l_tax, l_discount")
_ORDER = "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC"


def state(name: str = "state", source: str = "lineitem", keys: str = "l_orderkey, l_linenumber",
           order: str = _ORDER) -> str:
    return f"""{name} AS (SELECT * EXCLUDE (rn) FROM (
      SELECT *, {_OP} AS op, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn
      FROM {source}) WHERE rn = 1 AND op <> '-D')"""


CURRENT = f"WITH {state()} SELECT {_ROW} FROM state"
_OLD_NEW = f"""WITH past AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'),
  {state('old_rows', 'past')}, {state('new_rows')},
  both_rows AS (SELECT coalesce(o.l_orderkey, n.l_orderkey) AS l_orderkey,
      coalesce(o.l_linenumber, n.l_linenumber)::BIGINT AS l_linenumber,
      o.l_orderkey IS NOT NULL AS in_old, n.l_orderkey IS NOT NULL AS in_new,
      (o.l_shipdate, o.l_partkey, o.l_suppkey, o.l_quantity, o.l_extendedprice, o.l_tax, o.l_discount)
      IS NOT DISTINCT FROM
      (n.l_shipdate, n.l_partkey, n.l_suppkey, n.l_quantity, n.l_extendedprice, n.l_tax, n.l_discount) AS alike
    FROM old_rows o FULL JOIN new_rows n ON o.l_orderkey = n.l_orderkey AND o.l_linenumber = n.l_linenumber)"""

DIMS = """store AS (SELECT s_suppkey AS s_store_sk, s_name AS s_store_name, n_name AS s_state, r_name AS s_market_manager
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
  days AS (SELECT DISTINCT o_orderdate::DATE AS d_date FROM orders)"""
_TAXED = "(l_extendedprice::DECIMAL(12,2) * (1 + l_tax::DECIMAL(3,2)))"
_PROFIT = "(l_extendedprice::DECIMAL(12,2) * (0.05::DECIMAL(3,2) - l_discount::DECIMAL(3,2)))"


def view(rows: str) -> str:
    return f"""SELECT s_store_sk AS ss_store_sk, s_store_name, s_state, s_market_manager,
      d_date::VARCHAR AS sold_date_sk, sum({_TAXED})::DOUBLE AS total_sales_amount,
      sum({_PROFIT})::DOUBLE AS total_net_profit, sum(l_quantity)::BIGINT AS total_items_sold,
      count(l_orderkey) AS transaction_count
    FROM {rows} JOIN days ON l_shipdate::DATE = d_date JOIN store ON l_suppkey = s_store_sk
    GROUP BY s_store_sk, s_store_name, s_state, s_market_manager, d_date"""


CURRENT_VIEW = f"WITH {state()}, {DIMS} {view('state')}"

_WIDE = """l_orderkey * 10 + l_linenumber AS {id}, l_partkey AS {p}item_sk, {customer}
  l_suppkey AS {p}store_sk, l_orderkey AS {p}ticket_number, l_quantity::BIGINT AS {p}quantity,
  ((l_extendedprice::DECIMAL(12,2) * 0.10::DECIMAL(3,2))::DECIMAL(12,2))::DOUBLE AS {p}sales_price,
  l_extendedprice::DECIMAL(12,2)::DOUBLE AS {p}ext_sales_price,
  (l_extendedprice::DECIMAL(12,2) * 0.25::DECIMAL(3,2))::DOUBLE AS {p}net_profit"""
_WAREHOUSE = _WIDE.format(id="source_id", p="ss_", customer="l_orderkey AS ss_customer_sk,")
_STORE_SALES = """sales_rows AS (SELECT *, l_orderkey * 10 + l_linenumber AS source_id FROM {rows})"""

_OP_TS = "CASE WHEN l_linestatus = 'O' THEN TIMESTAMP '1970-01-01' ELSE l_shipdate END"

_TENTH = "(l_extendedprice::DECIMAL(12,2) * 0.10::DECIMAL(3,2))::DECIMAL(7,2)"


def _shares(**shares: str) -> str:
    return ", ".join(f"(({_TENTH}) * {share}::DECIMAL(3,2))::DECIMAL(7,2)::DOUBLE AS {name}" for name, share in shares.items())


_SALES_SHARES = _shares(
    ss_wholesale_cost="0.50", ss_list_price="1.00", ss_sales_price="0.90", ss_ext_discount_amt="0.10",
    ss_ext_sales_price="0.95", ss_ext_wholesale_cost="0.55", ss_ext_list_price="1.05", ss_ext_tax="0.08",
    ss_coupon_amt="0.01", ss_net_paid="0.94", ss_net_paid_inc_tax="1.02", ss_net_profit="0.39")
_RETURN_SHARES = _shares(
    sr_return_amt="0.90", sr_return_tax="0.07", sr_return_amt_inc_tax="0.97", sr_fee="0.01", sr_return_ship_cost="0.02",
    sr_refunded_cash="0.50", sr_reversed_charge="0.30", sr_store_credit="0.17", sr_net_loss="0.93")
_SCAN = """l_orderkey * 10 + l_linenumber AS {id}, strftime(l_shipdate, '%Y%m%d')::BIGINT AS {date},
  (l_quantity * 60)::BIGINT AS {time}, l_partkey AS {p}_item_sk, l_orderkey AS {p}_customer_sk,
  l_linenumber::BIGINT AS {p}_cdemo_sk, l_linenumber::BIGINT + 1 AS {p}_hdemo_sk, l_suppkey AS {p}_addr_sk,
  l_suppkey AS {p}_store_sk, l_linenumber::BIGINT * 2 AS {p}_{extra}_sk, l_orderkey AS {p}_ticket_number,
  l_quantity::BIGINT AS {quantity}, l_shipdate AS created_at, l_shipdate AS updated_at"""
_SCAN_META = "l_orderkey * 10 + l_linenumber AS seq, l_shipdate AS op_ts, 'business_db' AS db_name"
_SALES_SCAN = _SCAN.format(id="id", date="ss_sold_date_sk", time="ss_sold_time_sk", p="ss", extra="promo", quantity="ss_quantity")
_RETURN_SCAN = _SCAN.format(id="id", date="sr_returned_date_sk", time="sr_return_time_sk", p="sr", extra="reason",
                            quantity="sr_return_quantity")

_MONEY_IN = """m AS (SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_shipdate, l_partkey,
    {q} AS quantity, l_extendedprice::DECIMAL(12,2) AS list_price,
    (l_extendedprice::DECIMAL(12,2) * 0.60::DECIMAL(3,2))::DECIMAL(12,2) AS wholesale,
    (l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(3,2)))::DECIMAL(12,2) AS price,
    l_tax::DECIMAL(4,3) AS tax_rate, {coupon}::DECIMAL(7,2) AS coupon, l_quantity::BIGINT AS old_quantity,
    (CASE WHEN l_discount >= 0.05 THEN 12.50 ELSE 0 END)::DECIMAL(7,2) AS old_coupon FROM lineitem)"""


def _amounts(q: str, coupon: str, stale: bool = False) -> str:
    unpaid_q, unpaid_c = ("old_quantity", "old_coupon") if stale else ("quantity", "coupon")
    return f"""WITH {_MONEY_IN.format(q=q, coupon=coupon)}
    SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, quantity,
      ((list_price - price) * {unpaid_q})::DECIMAL(14,2)::DOUBLE AS ext_discount_amt,
      (price * quantity)::DECIMAL(14,2)::DOUBLE AS ext_sales_price,
      (wholesale * {unpaid_q})::DECIMAL(14,2)::DOUBLE AS ext_wholesale_cost,
      (list_price * {unpaid_q})::DECIMAL(14,2)::DOUBLE AS ext_list_price,
      (price * quantity * tax_rate)::DECIMAL(14,2)::DOUBLE AS ext_tax,
      (price * quantity - coupon)::DECIMAL(14,2)::DOUBLE AS net_paid,
      (price * quantity - coupon + price * quantity * tax_rate)::DECIMAL(14,2)::DOUBLE AS net_paid_inc_tax,
      (price * {unpaid_q} - {unpaid_c} - wholesale * {unpaid_q})::DECIMAL(14,2)::DOUBLE AS net_profit
    FROM m"""


_NOW_COUPON = "(CASE WHEN l_discount >= 0.05 THEN 12.50 ELSE 0 END)"
_KEY_JSON = """'{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber"""

ORACLE: dict[str, str] = {
    "sales_metrics_tumbling": _sales_metrics(DAY, "1 DAY"),
    "sales_metrics_by_minute": _sales_metrics(_MINUTE, "1 MINUTE"),
    "sales_metrics_stream": _sales_metrics(DAY, "1 DAY", f"HAVING w + INTERVAL 1 DAY <= {SALES_SEEN}"),
    "return_metrics_tumbling": _return_metrics(),
    "return_alerts": _alerts(),
    "return_alerts_stream": _alerts(f"HAVING {DAY} + INTERVAL 1 DAY <= {_RETURNS_SEEN}"),
    "item_trends_hopping": trends(),
    "item_trends_stream": trends(f"AND w + INTERVAL 1 DAY <= {SALES_SEEN}"),
    "top_item_per_window": f"""WITH {SALES}, c AS (
        SELECT {DAY} AS w, store_sk, item_sk, count(*) AS n FROM sales GROUP BY ALL)
      SELECT w AS window_start, w + INTERVAL 1 DAY AS window_end, store_sk::BIGINT AS store_sk,
        item_sk AS top_item_sk, n AS top_item_sales
      FROM c QUALIFY row_number() OVER (PARTITION BY w, store_sk ORDER BY n DESC, item_sk) = 1""",
    "true_return_rate": f"""WITH {SALES}, {RETURNS},
      s AS (SELECT {DAY} AS w, store_sk, count(*) AS n FROM sales GROUP BY ALL),
      r AS (SELECT {DAY} AS w, store_sk, count(*) AS n FROM returns GROUP BY ALL)
      SELECT coalesce(s.w, r.w) AS window_start, coalesce(s.w, r.w) + INTERVAL 1 DAY AS window_end,
        coalesce(s.store_sk, r.store_sk)::BIGINT AS store_sk, coalesce(s.n, 0) AS total_sales,
        coalesce(r.n, 0) AS total_returns,
        CASE WHEN s.n > 0 THEN coalesce(r.n, 0)::DOUBLE / s.n END AS return_rate
      FROM s FULL JOIN r ON s.w = r.w AND s.store_sk = r.store_sk""",
    "json_sales_stream": _sales_metrics(DAY, '1 DAY', f'HAVING w + INTERVAL 1 DAY <= {SALES_SEEN}'),
    "json_returns_stream": f"""SELECT * FROM ({_return_metrics()}) WHERE window_end <=
      (SELECT max(ts) - INTERVAL 5 SECOND FROM events WHERE event_type = 'error')""",
    "projection_stream": f"""SELECT {_OP} AS op_type, l_shipdate AS op_time, l_orderkey,
      l_linenumber::BIGINT AS l_linenumber, l_quantity AS quantity, l_extendedprice AS ext_sales_price FROM lineitem""",

    "lenient_json_decode": """SELECT event_id, (regexp_extract(props, '"k": (-?[0-9]+)', 1))::BIGINT AS k,
      TRUE AS missing_is_null FROM events WHERE event_type <> 'error'""",
    "json_event_feed": f"""WITH {SALES} SELECT store_sk::BIGINT AS store_sk, count(*) AS rows_read,
      sum(price)::DOUBLE AS revenue, min(ts) AS first_sale FROM sales GROUP BY 1""",
    "envelope_changes": f"""WITH l AS (SELECT *, {_OP} AS kind FROM lineitem), i AS (
        SELECT kind AS op, l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate FROM l
        UNION ALL SELECT '-U', l_orderkey, l_linenumber, l_quantity - 1, l_extendedprice, l_shipdate FROM l WHERE kind = '+U')
      SELECT epoch(l_shipdate)::BIGINT AS seq, l_shipdate AS op_ts, 'business' AS db_name, 'lineitem' AS table_name,
        op, l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity, l_extendedprice FROM i""",
    "sales_change_scan": f"""SELECT {_SCAN_META}, 'store_sales' AS table_name, {_OP} AS op, {_SALES_SCAN}, {_SALES_SHARES}
      FROM lineitem""",
    "returns_change_scan": f"""SELECT {_SCAN_META}, 'store_returns' AS table_name, '+I' AS op, {_RETURN_SCAN}, {_RETURN_SHARES}
      FROM lineitem WHERE l_returnflag = 'R'""",
    "envelope_signed_sums": f"""WITH l AS (SELECT *, {_OP} AS kind FROM lineitem), i AS (
        SELECT kind AS op, l_quantity FROM l UNION ALL SELECT '-U', l_quantity - 1 FROM l WHERE kind = '+U')
      SELECT op, sum(CASE WHEN op[1] = '+' THEN 1 ELSE -1 END)::BIGINT AS row_balance,
        sum(CASE WHEN op[1] = '+' THEN l_quantity ELSE -l_quantity END) AS quantity_balance FROM i GROUP BY op""",

    "cdc_latest_state": f"WITH {state()} SELECT op, {_ROW} FROM state",
    "ticket_key_state": f"""WITH {state(keys='l_orderkey', order=_ORDER + ', l_linenumber DESC')}
      SELECT op, {_ROW} FROM state""",
    "composite_key_state": f"""WITH {state(keys='l_shipdate, l_suppkey, l_partkey',
      order='l_quantity DESC, l_extendedprice DESC, l_orderkey DESC, l_linenumber DESC')} SELECT op, {_ROW} FROM state""",
    "cdc_upsert_stream": CURRENT,
    "snapshot_then_changes": CURRENT,
    "row_operations": CURRENT,
    "atomic_batches": CURRENT,
    "late_changes": CURRENT,
    "cdc_op_mix": f"SELECT {_OP} AS op, count(*) AS changes FROM lineitem GROUP BY 1",
    "cdc_signed_count": f"WITH {state()} SELECT count(*) AS row_count FROM state",
    "version_changes": f"""{_OLD_NEW} SELECT CASE WHEN NOT in_old THEN '+I' WHEN NOT in_new THEN '-D' ELSE '+U' END AS op,
      count(*) AS changes FROM both_rows WHERE NOT (in_old AND in_new AND alike) GROUP BY 1""",
    "keyed_topic": f"""WITH last_rows AS (SELECT *, {_OP} AS op FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER}) = 1)
      SELECT {_KEY_JSON} || '}}' AS key, CASE WHEN op = '-D' THEN 'tombstone' ELSE
        {_KEY_JSON} || ',"l_partkey":' || l_partkey || ',"price":' || l_extendedprice::DECIMAL(12,2)
        || ',"l_shipdate":"' || strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%f') || '"}}' END AS value,
        TRUE AS has_timestamp FROM last_rows""",
    "topic_compaction": f"""WITH {state()} SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_quantity,
      l_shipdate FROM state""",
    "row_kind_changes": f"""{_OLD_NEW}, updated AS (SELECT count(*) AS n FROM both_rows WHERE in_old AND in_new AND NOT alike)
      SELECT count(*) AS row_count, sum(l_partkey)::BIGINT AS part_keys, any_value(u.n) AS before_images,
        any_value(u.n) AS after_images FROM new_rows, updated u""",
    "keyed_topic_with_bad_records": f"""WITH {state()}, keys AS (SELECT count(DISTINCT (l_orderkey, l_linenumber)) AS n FROM lineitem)
      SELECT 'rows_kept' AS measure, count(*) AS value FROM state
      UNION ALL SELECT 'part_keys', sum(l_partkey)::BIGINT FROM state
      UNION ALL SELECT unnest(['bad_key', 'bad_value']), n FROM keys""",
    "second_checkpoint": CURRENT,
    "append_refused": f"SELECT {_OP} AS op, count(*) AS changes, TRUE AS refused, 0::BIGINT AS rows_written FROM lineitem GROUP BY 1",
    "lookup_by_key": """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_shipdate, l_extendedprice
      FROM lineitem WHERE l_orderkey = 7 AND l_linenumber = 1""",
    "target_lifecycle": """WITH n AS (SELECT count(*) AS n FROM orders)
      SELECT step, status, row_count FROM n, LATERAL (VALUES ('missing', 'NOT EXISTS', NULL), ('made', 'EXISTS', 0),
        ('filled', 'EXISTS', n), ('made again', 'EXISTS', n), ('recreated', 'EXISTS', 0), ('dropped', 'NOT EXISTS', NULL)
      ) t(step, status, row_count)""",
    "exact_amounts": f"""WITH {DIMS} SELECT l_suppkey AS ss_store_sk, d_date::VARCHAR AS sold_date_sk,
        sum({_TAXED}::DECIMAL(18,4))::DECIMAL(28,4)::VARCHAR AS total_sales_amount,
        sum({_PROFIT}::DECIMAL(18,4))::DECIMAL(28,4)::VARCHAR AS total_net_profit
      FROM lineitem JOIN days ON l_shipdate::DATE = d_date JOIN store ON l_suppkey = s_store_sk GROUP BY 1, 2""",
    "local_load_stamps": """SELECT count(*) AS stamped_rows, least(count(*), 1) AS stamps,
      'timestamp_ntz' AS stamp_type FROM lineitem WHERE l_returnflag = 'R'""",
    "restart_stream": _sales_metrics(DAY, "1 DAY", f"HAVING w + INTERVAL 1 DAY <= {SALES_SEEN}"),
    "late_rows_stream": _late_rows(),
    "two_domains_stream": f"""WITH {SALES}, {RETURNS}, s AS (SELECT *, {DAY} AS w FROM sales), r AS (SELECT *, {DAY} AS w FROM returns)
      SELECT 'sales' AS domain, w AS window_start, store_sk::BIGINT AS store_sk, count(*) AS events, sum(price)::DOUBLE AS amount
      FROM s GROUP BY w, store_sk HAVING w + INTERVAL 1 DAY <= {SALES_SEEN}
      UNION ALL SELECT 'returns', w, store_sk::BIGINT, count(*), sum(price)::DOUBLE
      FROM r GROUP BY w, store_sk HAVING w + INTERVAL 1 DAY <= {_RETURNS_SEEN}""",
    "running_count_stream": f"""WITH p AS (SELECT CASE WHEN {_OP} = '-D' THEN -1 ELSE 1 END AS s,
        least(greatest(coalesce(year(l_shipdate), 0) - 1997, 0), 3) AS part FROM lineitem)
      SELECT turn::BIGINT AS turn, coalesce(sum(s) FILTER (WHERE part <= turn), 0)::BIGINT AS row_count
      FROM p, range(4) t(turn) GROUP BY turn""",
    "processing_times": "SELECT count(*) AS stamped_rows, count(*) AS after_event FROM events",
    "sales_per_local_day": _sales_metrics(_LOCAL_DAY, "1 DAY"),
    "view_rebuild_in_between": CURRENT_VIEW,
    "peek_check": "SELECT least(5, count(*)) AS rows_found FROM lineitem",
    "append_inserts": f"SELECT {_ROW} FROM lineitem WHERE {_OP} = '+I'",
    "fanout_reconcile": f"""WITH {state()} SELECT 'same' AS status, count(*) AS keys, count(*) AS source_rows,
      count(*) AS target_rows FROM state""",

    "star_join": f"""WITH {DIMS} SELECT s_store_sk AS ss_store_sk, s_store_name, s_state, d_date::VARCHAR AS d_date,
      l_orderkey AS ss_ticket_number, l_quantity::BIGINT AS ss_quantity, {_TAXED}::DOUBLE AS ss_net_paid_inc_tax
      FROM lineitem JOIN days ON l_shipdate::DATE = d_date JOIN store ON l_suppkey = s_store_sk""",
    "daily_store_view": f"WITH {DIMS} {view('lineitem')}",
    "daily_store_view_ivm": CURRENT_VIEW,
    "daily_store_view_stream": CURRENT_VIEW,
    "star_join_stream": f"""WITH {DIMS} SELECT s_store_sk AS ss_store_sk, s_state, d_date::VARCHAR AS d_date,
      l_orderkey AS ss_ticket_number, l_quantity::BIGINT AS ss_quantity
      FROM lineitem JOIN days ON l_shipdate::DATE = d_date JOIN store ON l_suppkey = s_store_sk""",
    "view_from_row_images": CURRENT_VIEW,
    "view_rebuild": CURRENT_VIEW,

    "warehouse_projection": f"SELECT {_WAREHOUSE}, TIMESTAMP '2030-01-01' AS sync_timestamp FROM lineitem",
    "unkeyed_warehouse_projection": f"""SELECT * EXCLUDE (source_id) FROM (
      SELECT {_WAREHOUSE}, TIMESTAMP '2030-01-01' AS sync_timestamp FROM lineitem)""",
    "event_projection": f"""SELECT {_WIDE.format(id='sales_id', p='', customer='l_orderkey AS customer_sk,')},
      {_OP} AS event_type,
      CASE WHEN l_linestatus = 'O' THEN l_shipdate + INTERVAL 1 DAY ELSE l_shipdate END AS event_time,
      l_shipdate AS created_time, l_shipdate + INTERVAL 1 DAY AS updated_time,
      'CDC-TO-KAFKA-TIMESTAMP-FIXED' AS event_source FROM lineitem""",
    "cdc_monitor": f"""SELECT * EXCLUDE (store_sk) FROM (SELECT {_WIDE.format(id='id', p='', customer='l_orderkey AS customer_sk,')},
      {_OP} AS op_type, {_OP_TS} AS op_time FROM lineitem)""",
    "returns_monitor": f"""SELECT op_type, op_time, id, ticket_number, item_sk, customer_sk, quantity AS return_quantity,
      ext_sales_price AS return_amt, net_profit AS net_loss FROM (
        SELECT {_WIDE.format(id='id', p='', customer='l_orderkey AS customer_sk,')}, {_OP} AS op_type, {_OP_TS} AS op_time
        FROM lineitem) WHERE op_type = '-D'""",
    "not_null_enforced": """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_discount, l_tax FROM lineitem
      WHERE l_discount <> 0 AND l_tax <> 0""",
    "clone_and_copy": "SELECT * REPLACE (l_linenumber::BIGINT AS l_linenumber) FROM lineitem",
    "surrogate_key": """SELECT row_number() OVER (ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice,
        l_orderkey, l_linenumber) AS ss_id, l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_shipdate, l_partkey,
        l_suppkey, l_quantity, l_extendedprice FROM lineitem""",
    "point_lookup": """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_extendedprice FROM lineitem
      WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ("region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events")),
    "sync_profile": f"""WITH {_STORE_SALES.format(rows='lineitem')} SELECT count(*) AS row_count,
      min(l_shipdate) AS first_sync, max(l_shipdate) AS last_sync, count(DISTINCT l_partkey) AS distinct_items,
      sum(l_extendedprice::DECIMAL(12,2))::DOUBLE AS total_amount, min(source_id) AS min_key, max(source_id) AS max_key
      FROM sales_rows""",
    "recent_rows": f"""WITH {_STORE_SALES.format(rows='lineitem')} SELECT source_id, l_partkey AS ss_item_sk,
      l_orderkey AS ss_ticket_number, l_quantity::BIGINT AS ss_quantity,
      l_extendedprice::DECIMAL(12,2)::DOUBLE AS ss_ext_sales_price, l_shipdate AS sync_timestamp FROM sales_rows
      ORDER BY l_shipdate DESC, source_id DESC, l_partkey DESC, l_quantity DESC, l_extendedprice DESC LIMIT 5""",
    "returns_profile": f"""WITH r AS (SELECT {_RETURN_SCAN}, {_TENTH} AS tenth FROM lineitem WHERE l_returnflag = 'R')
      SELECT count(*) AS row_count, min(created_at) + INTERVAL 1 DAY AS first_sync, max(created_at) + INTERVAL 1 DAY AS last_sync,
      count(DISTINCT sr_item_sk) AS distinct_items, sum((tenth * 0.90::DECIMAL(3,2))::DECIMAL(7,2))::DOUBLE AS total_amount,
      min(id) AS min_key, max(id) AS max_key FROM r""",
    "recent_returns": f"""SELECT id AS source_id, sr_item_sk, sr_ticket_number, sr_return_quantity, sr_return_amt,
      created_at + INTERVAL 1 DAY AS sync_timestamp
      FROM (SELECT {_RETURN_SCAN}, {_RETURN_SHARES} FROM lineitem WHERE l_returnflag = 'R')
      ORDER BY created_at DESC, id DESC, sr_item_sk DESC, sr_return_quantity DESC, sr_return_amt DESC LIMIT 5""",
    "load_stamps": """SELECT count(*) AS stamped_rows, 1::BIGINT AS stamps, TRUE AS not_ahead FROM lineitem
      WHERE l_returnflag = 'R'""",
    "newest_row": "SELECT event_id, ts, event_type FROM events ORDER BY event_id DESC LIMIT 1",
    "key_uniqueness": f"""WITH {state()}, c AS (
        SELECT 'feed' AS table_name, count(*) AS row_count, count(DISTINCT l_orderkey * 10 + l_linenumber) AS unique_keys FROM lineitem
        UNION ALL SELECT 'state', count(*), count(DISTINCT l_orderkey * 10 + l_linenumber) FROM state)
      SELECT *, CASE WHEN row_count = unique_keys THEN '主键唯一' ELSE '存在重复主键' END AS key_status FROM c""",
    "source_target_diff": f"""{_OLD_NEW} SELECT l_orderkey, l_linenumber, in_new::BIGINT AS source_rows, in_old::BIGINT AS target_rows,
      CASE WHEN NOT in_old THEN 'missing' WHEN NOT in_new THEN 'extra' WHEN alike THEN 'same' ELSE 'different' END AS status
      FROM both_rows""",

    "tz_convert": "SELECT event_id, ts - INTERVAL 8 HOUR AS utc_time, ts + INTERVAL 8 HOUR AS local_time FROM events",
    "tz_offset_check": """SELECT CASE WHEN event_type = 'click' THEN 8 ELSE 0 END::BIGINT AS shift_hours, count(*) AS row_count,
      event_type = 'click' AS zone_suspect FROM events GROUP BY 1, 3""",
    "tz_offset_hours": "SELECT event_type, 8::BIGINT AS offset_hours, count(*) AS row_count FROM events GROUP BY 1",
    "date_keys": """SELECT event_id, strftime(ts, '%Y%m%d')::BIGINT AS compact_key,
      date_diff('day', DATE '1970-01-01', ts::DATE) + 2440588 AS julian_key,
      (hour(ts) * 3600 + minute(ts) * 60 + second(ts))::BIGINT AS time_key, ts::DATE::VARCHAR AS from_compact,
      ts::DATE::VARCHAR AS from_julian, date_diff('day', DATE '1970-01-01', ts::DATE) + 2440588 AS unified_key FROM events""",
    "scalar_functions": """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
      CASE WHEN l_quantity > 40 THEN 'LARGE' WHEN l_quantity > 20 THEN 'MEDIUM' ELSE 'SMALL' END || '-' || l_suppkey AS tag,
      coalesce(CASE WHEN l_returnflag = 'R' THEN l_linestatus END, 'none') AS returned_status,
      (l_extendedprice::DECIMAL(12,2) * 0.08::DECIMAL(3,2) + l_extendedprice::DECIMAL(12,2))::DOUBLE AS with_tax,
      ((2 * (l_extendedprice::DECIMAL(12,2) * 100)::BIGINT + 7) // 14)::DOUBLE / 100 AS seventh,
      floor(l_extendedprice / 1000)::BIGINT AS thousands, least(3, l_quantity::BIGINT) AS returnable,
      l_shipdate + INTERVAL 5 MINUTE AS plus_five FROM lineitem""",
    "sale_amounts": _amounts("l_quantity::BIGINT", _NOW_COUPON),
    "amount_recompute": _amounts("l_quantity::BIGINT * 2", "20.00"),
    "amount_recompute_paid_only": _amounts("l_quantity::BIGINT * 2", "20.00", stale=True),
    "return_amounts": """WITH a AS (SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_shipdate, l_partkey,
        l_extendedprice::DECIMAL(12,2) AS amt, (l_extendedprice::DECIMAL(12,2) * l_tax::DECIMAL(4,3))::DECIMAL(14,2) AS tax,
        (l_discount::DECIMAL(4,2) * 8)::DECIMAL(4,2) AS cash_share, (l_discount::DECIMAL(4,2) * 7)::DECIMAL(4,2) AS rev_share
        FROM lineitem),
      b AS (SELECT *, (amt + tax)::DECIMAL(14,2) AS total FROM a),
      c AS (SELECT *, (total * cash_share)::DECIMAL(14,2) AS cash FROM b),
      d AS (SELECT *, ((total - cash) * rev_share)::DECIMAL(14,2) AS rev FROM c)
      SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, amt::DOUBLE AS return_amt, tax::DOUBLE AS return_tax,
        total::DOUBLE AS return_amt_inc_tax, cash::DOUBLE AS refunded_cash, rev::DOUBLE AS reversed_charge,
        (total - cash - rev)::DOUBLE AS store_credit, (amt + 14.00)::DOUBLE AS net_loss FROM d""",
}
