"""The registered queries in SQL, over the same Parquet tables."""

from __future__ import annotations

from tillstream.plans.registry import (
    AS_OF,
    AS_OF_BUSY,
    AS_OF_UNALIGNED,
    FACT_UP_TO,
    REVENUE_BANDS,
    SLICE_SECONDS,
    SLOT_SECONDS,
)
from tillstream.sources.schemas import AGG_TABLE, FACT_TABLE, PAYMENT_TYPES, RAW_TABLE

COLS = "transaction_id, store_id, product_id, quantity, price, payment_type, transaction_ts"
REV = "quantity * price"
TEN = "INTERVAL 10 MINUTE"

SALES = """k_events AS (
  SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k FROM events
), sales AS (
  SELECT event_id,
         'tx_' || event_id AS transaction_id,
         'store_' || (user_id % 20 + 1) AS store_id,
         'product_' || (k % 100 + 1) AS product_id,
         CAST(k % 5 + 1 AS INTEGER) AS quantity,
         value AS price,
         CASE event_type WHEN 'click' THEN 'credit_card' WHEN 'view' THEN 'debit_card'
                         WHEN 'purchase' THEN 'cash' WHEN 'signup' THEN 'online' END AS payment_type,
         ts AS transaction_ts
  FROM k_events
)"""

DIRTY = (
    SALES
    + f""", sales_dirty AS (
  SELECT event_id, transaction_id,
         CASE WHEN event_id % 97 <> 0 THEN store_id END AS store_id,
         product_id, quantity, price,
         CASE WHEN event_id % 89 = 0 THEN 'MOBILE_PAY' ELSE payment_type END AS payment_type,
         CASE WHEN event_id % 61 = 0 THEN transaction_ts - INTERVAL 2 HOUR ELSE transaction_ts END AS transaction_ts
  FROM sales
  UNION ALL
  SELECT event_id, transaction_id, store_id, product_id, quantity, price, payment_type,
         transaction_ts + INTERVAL 3 MINUTE
  FROM sales WHERE event_id % 50 = 0
)"""
)


def _first(source: str) -> str:
    return (
        f"SELECT {COLS} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY transaction_id ORDER BY transaction_ts) AS n FROM {source}) WHERE n = 1"
    )


TARGET = DIRTY + f""", target AS (
  SELECT {COLS}, {REV} AS revenue FROM sales WHERE transaction_ts < TIMESTAMP '{FACT_UP_TO}'
), newest AS (SELECT max(transaction_ts) AS newest FROM target)"""

MERGED = TARGET + f""", arrived AS (
  SELECT * FROM sales_dirty WHERE transaction_ts > (SELECT newest - INTERVAL 1 HOUR FROM newest)
), updates AS (
  SELECT *, {REV} AS revenue FROM ({_first('arrived')})
), merged AS (
  SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM updates u WHERE u.transaction_id = t.transaction_id)
  UNION ALL SELECT * FROM updates
)"""

WINDOWS = f""", windows AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, transaction_ts) AS window_start,
         time_bucket(INTERVAL 5 MINUTE, transaction_ts) + INTERVAL 5 MINUTE AS window_end,
         store_id,
         round(sum({REV}), 2) AS total_revenue,
         CAST(sum(quantity) AS BIGINT) AS total_quantity
  FROM {{source}} GROUP BY 1, 2, 3
)"""

# Messages of the wire view: damaged, undecodable, and with a missing field.
SHORT, NOT_JSON, NO_STORE, NO_TIME = (f"event_id % {n} = 0" for n in (41, 43, 47, 53))

ACCEPTED = (
    SALES
    + f""", accepted AS (
  SELECT event_id, transaction_id, store_id, product_id, quantity,
         CAST(CAST(price AS REAL) AS DOUBLE) AS price, payment_type,
         date_trunc('second', transaction_ts) AS transaction_ts
  FROM sales WHERE NOT ({SHORT} OR {NOT_JSON} OR {NO_STORE} OR {NO_TIME})
)"""
)


def _closed_windows(source: str) -> str:
    """Windows an append-mode stream has emitted once all input is read."""
    return (
        WINDOWS.format(source=source)
        + f""" SELECT * FROM windows
  WHERE window_end <= (SELECT date_trunc('milliseconds', max(transaction_ts)) - {TEN} FROM {source})"""
    )


def _anomaly(kind: str, as_of: str, bounded: bool = False, zero_fill: bool = False) -> str:
    measure = "count(*)" if kind == "volume" else f"sum({REV})"
    value = "volume" if kind == "volume" else "revenue"
    places = 1 if kind == "volume" else 2
    at = f"TIMESTAMP '{as_of}'"
    upper = f" AND transaction_ts < {at}" if bounded else ""
    current = "x" if kind == "volume" else "round(x, 2)"
    hours = f"""hours AS (
  SELECT date_trunc('hour', transaction_ts) AS hr, {measure} AS x FROM sales
  WHERE transaction_ts >= {at} - INTERVAL 7 DAY AND transaction_ts < {at} - INTERVAL 1 HOUR GROUP BY 1
)"""
    if zero_fill:
        hours += f""", filled AS (
  SELECT g.hr, coalesce(h.x, 0) AS x
  FROM (SELECT unnest(generate_series(date_trunc('hour', {at} - INTERVAL 7 DAY),
                                      {at} - INTERVAL 1 HOUR - INTERVAL 1 MICROSECOND,
                                      INTERVAL 1 HOUR)) AS hr) g
  LEFT JOIN hours h ON h.hr = g.hr
)"""
    source = "filled" if zero_fill else "hours"
    return f"""{hours}, stats AS (SELECT avg(x) AS mu, stddev_samp(x) AS sigma FROM {source}),
now_hour AS (
  SELECT coalesce({measure}, 0) AS x FROM sales WHERE transaction_ts >= {at} - INTERVAL 1 HOUR{upper}
)
SELECT CASE WHEN sigma IS NULL OR sigma = 0 OR abs(x - mu) <= 3 * sigma THEN 'PASS' ELSE 'FAIL' END
         AS {kind}_anomaly_status,
       {current} AS current_hour_{value},
       round(mu, {places}) AS mean_{value},
       round(sigma, {places}) AS stddev_{value},
       CASE WHEN sigma > 0 THEN round((x - mu) / sigma, 2) ELSE 0.0 END AS z_score
FROM now_hour CROSS JOIN stats"""


def _text(value: str, scale: int) -> str:
    return rf"regexp_replace(CAST(CAST({value} AS DECIMAL(38,{scale})) AS VARCHAR), '(\.\d+?)0+$', '\1')"


def _report(source: str, as_of: str) -> str:
    at = f"TIMESTAMP '{as_of}'"

    def stats(name: str, measure: str) -> str:
        return f"""{name}_stats AS (
  SELECT avg(x) AS mu, stddev_samp(x) AS sigma FROM (
    SELECT {measure} AS x FROM {source}
    WHERE transaction_ts >= {at} - INTERVAL 7 DAY AND transaction_ts < {at} - INTERVAL 1 HOUR
    GROUP BY date_trunc('hour', transaction_ts))
), {name}_now AS (
  SELECT coalesce({measure}, 0) AS x FROM {source} WHERE transaction_ts >= {at} - INTERVAL 1 HOUR
)"""

    def row(position: int, name: str, scale: int) -> str:
        current = "CAST(x AS VARCHAR)" if scale == 1 else _text("x", 2)
        return f"""SELECT {position} AS position, '{name}_anomaly' AS check_name,
       CASE WHEN sigma IS NULL OR sigma = 0 OR abs(x - mu) <= 3 * sigma THEN 'PASS' ELSE 'FAIL' END AS status,
       '{name}_anomaly FAIL: current=' || {current} || ', mean=' || {_text(f'round(mu, {scale})', scale)}
         || ', sigma=' || {_text(f'round(sigma, {scale})', scale)} || ', z_score='
         || {_text('CASE WHEN sigma > 0 THEN round((x - mu) / sigma, 2) ELSE 0 END', 2)} AS text
FROM {name}_now CROSS JOIN {name}_stats"""

    return f"""{stats('volume', 'count(*)')}, {stats('revenue', f'sum({REV})')}, found AS (
SELECT 1 AS position, 'null_check' AS check_name, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
       'null_check FAIL: ' || count(*) || ' null rows' AS text
FROM {source} WHERE transaction_id IS NULL OR store_id IS NULL OR product_id IS NULL
  OR quantity IS NULL OR price IS NULL OR transaction_ts IS NULL
UNION ALL
SELECT 2, 'duplicate_check', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END,
       'duplicate_check FAIL: ' || count(*) || ' duplicate transaction_ids'
FROM (SELECT transaction_id FROM {source} GROUP BY 1 HAVING count(*) > 1)
UNION ALL {row(3, 'volume', 1)}
UNION ALL {row(4, 'revenue', 2)}
), report AS (
  SELECT position, check_name, status, CASE WHEN status = 'FAIL' THEN text END AS message FROM found
), summed AS (
  SELECT CASE WHEN count(message) = 0 THEN 'PASS'
              ELSE 'FAIL: ' || string_agg(message, ' | ' ORDER BY position) END AS summary FROM report
)"""


def _with(prefix: str, body: str) -> str:
    return f"WITH {prefix} {body}"


def _report_query(prefix: str, source: str, as_of: str, body: str) -> str:
    return f"WITH {prefix}, {_report(source, as_of)} {body}"


_NULLS = " OR ".join(
    f"{c} IS NULL" for c in ("transaction_id", "store_id", "product_id", "quantity", "price", "transaction_ts")
)
_ACCEPTED_LIST = ", ".join(f"'{v}'" for v in PAYMENT_TYPES)

_SLICES = f""", sliced AS (
  SELECT *, CAST(floor(epoch(arrived_at) / {SLICE_SECONDS}) AS BIGINT) AS slice FROM arrivals
), tops AS (SELECT slice, max(transaction_ts) AS top FROM sliced GROUP BY 1),
marks AS (
  SELECT slice,
         date_trunc('milliseconds', max(top) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
           - {TEN} AS watermark
  FROM tops
)"""

# The JSON text of an accepted message, field by field.
_BODY = """'{"transaction_id":"' || transaction_id || '"'
  || CASE WHEN event_id % 47 = 0 THEN '' ELSE ',"store_id":"' || store_id || '"' END
  || ',"product_id":"' || product_id || '","quantity":' || quantity || ',"price":' || CAST(price AS VARCHAR)
  || CASE WHEN payment_type IS NULL THEN '' ELSE ',"payment_type":"' || payment_type || '"' END
  || ',"transaction_ts":"' || CASE WHEN event_id % 53 = 0 THEN 'garbage'
       ELSE strftime(transaction_ts, '%Y-%m-%dT%H:%M:%SZ') END || '"}'"""

_WIRE_TIME = """CASE WHEN event_id % 53 = 0 THEN 'garbage' ELSE strftime(transaction_ts, '%Y-%m-%dT%H:%M:%SZ') END"""


def _status_row(name: str, source: str, time: str) -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS row_count, max({time}) AS newest FROM {source}"


def _suite_row(column: str, test: str, count: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, '{test}' AS test_name, ({count}) AS failures, "
        f"CASE WHEN ({count}) = 0 THEN 'PASS' ELSE 'FAIL' END AS status"
    )


def _fact_suite() -> str:
    rows = [
        _suite_row(c, "not_null", f"SELECT count(*) FROM fact WHERE {c} IS NULL")
        for c in ("transaction_id", "store_id", "product_id", "quantity", "price", "transaction_ts", "revenue")
    ]
    repeated = (
        "SELECT count(*) FROM (SELECT transaction_id FROM fact WHERE transaction_id IS NOT NULL "
        "GROUP BY 1 HAVING count(*) > 1)"
    )
    bad = f"SELECT count(DISTINCT payment_type) FROM fact WHERE payment_type NOT IN ({_ACCEPTED_LIST})"
    rows += [_suite_row("transaction_id", "unique", repeated), _suite_row("payment_type", "accepted_values", bad)]
    return f", fact AS (SELECT {COLS}, {REV} AS revenue FROM sales_dirty) " + " UNION ALL ".join(rows)


def oracle_sql() -> dict[str, str]:
    busy = f"TIMESTAMP '{AS_OF_BUSY}'"
    calm = f"TIMESTAMP '{AS_OF}'"
    unaligned = f"TIMESTAMP '{AS_OF_UNALIGNED}'"
    (low, low_cut), (mid, mid_cut) = REVENUE_BANDS
    history = (
        f"transaction_ts >= {unaligned} - INTERVAL 7 DAY AND transaction_ts < {unaligned} - INTERVAL 1 HOUR"
    )
    merged = "SELECT * REPLACE (round(revenue, 2) AS revenue) FROM merged"
    reconciled = _with(
        ACCEPTED,
        """, a AS (SELECT date_trunc('hour', transaction_ts) AS hr, count(*) AS n FROM sales GROUP BY 1),
b AS (SELECT date_trunc('hour', transaction_ts) AS hr, count(*) AS n FROM accepted GROUP BY 1)
SELECT hr, source_rows, sink_rows, round(share, 4) AS completeness,
   CASE WHEN share >= 0.999 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT coalesce(a.hr, b.hr) AS hr, coalesce(a.n, 0) AS source_rows, coalesce(b.n, 0) AS sink_rows,
         CASE WHEN a.n > 0 THEN coalesce(b.n, 0) / a.n ELSE 0.0 END AS share
  FROM a FULL JOIN b ON a.hr = b.hr)""",
    )
    return {
        # scans, projections and filters
        "scan_sales": _with(SALES, f"SELECT {COLS} FROM sales"),
        "sales_revenue": _with(SALES, f"SELECT transaction_id, round({REV}, 2) AS revenue FROM sales"),
        "filter_history_range": _with(SALES, f"SELECT {COLS} FROM sales WHERE {history}"),
        "recent_rows": _with(
            SALES,
            f"SELECT count(*) AS row_count, round(sum({REV}), 2) AS revenue FROM sales "
            f"WHERE transaction_ts >= {busy} - INTERVAL 1 HOUR",
        ),
        "null_rows": _with(DIRTY, f"SELECT {COLS} FROM sales_dirty WHERE {_NULLS}"),
        "incremental_rows": _with(
            TARGET, "SELECT * FROM sales_dirty WHERE transaction_ts > (SELECT newest FROM newest)"
        ),
        "incremental_lookback": _with(
            TARGET,
            "SELECT * FROM sales_dirty WHERE transaction_ts > (SELECT newest - INTERVAL 1 HOUR FROM newest)",
        ),
        "retention_filter": _with(
            SALES, f"SELECT {COLS} FROM sales WHERE transaction_ts >= {calm} - INTERVAL 20 DAY"
        ),
        "staging_sales": _with(
            DIRTY,
            "SELECT trim(transaction_id) AS transaction_id, trim(store_id) AS store_id, trim(product_id) AS "
            "product_id, quantity, price, lower(trim(payment_type)) AS payment_type, transaction_ts FROM sales_dirty",
        ),
        # aggregates
        "agg_store_5min": _with(SALES + WINDOWS.format(source="sales"), "SELECT * FROM windows"),
        "hourly_volume": _with(
            SALES, "SELECT date_trunc('hour', transaction_ts) AS hr, count(*) AS volume FROM sales GROUP BY 1"
        ),
        "hourly_revenue": _with(
            SALES,
            f"SELECT date_trunc('hour', transaction_ts) AS hr, round(sum({REV}), 2) AS revenue FROM sales GROUP BY 1",
        ),
        "hourly_stats": _with(
            SALES,
            f"""SELECT count(*) AS hours, round(avg(n), 4) AS mean_volume, round(stddev_samp(n), 4) AS stddev_volume,
       round(avg(r), 4) AS mean_revenue, round(stddev_samp(r), 4) AS stddev_revenue
FROM (SELECT count(*) AS n, sum({REV}) AS r FROM sales WHERE {history} GROUP BY date_trunc('hour', transaction_ts))""",
        ),
        "hourly_volume_recent": _with(
            SALES,
            f"SELECT date_trunc('hour', transaction_ts) AS hr, count(*) AS volume FROM sales "
            f"WHERE transaction_ts >= {calm} - INTERVAL 1 DAY GROUP BY 1 ORDER BY 1 DESC",
        ),
        "duplicate_ids": _with(
            DIRTY, "SELECT transaction_id, count(*) AS cnt FROM sales_dirty GROUP BY 1 HAVING count(*) > 1"
        ),
        "duplicate_sample": _with(
            DIRTY,
            "SELECT transaction_id, count(*) AS cnt FROM sales_dirty GROUP BY 1 HAVING count(*) > 1 "
            "ORDER BY transaction_id LIMIT 10",
        ),
        # reports
        "hourly_revenue_by_store": _with(
            SALES,
            f"SELECT date_trunc('hour', transaction_ts) AS hr, store_id, round(sum({REV}), 2) AS revenue "
            "FROM sales GROUP BY 1, 2",
        ),
        "top_products": _with(
            SALES,
            f"""SELECT product_id, round(sum({REV}), 2) AS revenue, CAST(sum(quantity) AS BIGINT) AS quantity
FROM sales GROUP BY 1 ORDER BY sum({REV}) DESC, product_id LIMIT 10""",
        ),
        "payment_split": _with(
            SALES,
            f"""SELECT payment_type, transactions, round(r, 2) AS revenue,
       round(transactions / sum(transactions) OVER (), 6) AS transaction_share,
       round(r / sum(r) OVER (), 6) AS revenue_share
FROM (SELECT payment_type, count(*) AS transactions, sum({REV}) AS r FROM sales GROUP BY 1)""",
        ),
        "table_status": _with(
            SALES + WINDOWS.format(source="sales"),
            " UNION ALL ".join(
                [
                    _status_row(RAW_TABLE, "sales", "transaction_ts"),
                    _status_row(AGG_TABLE, "windows", "window_start"),
                    _status_row(FACT_TABLE, "sales", "transaction_ts"),
                ]
            ),
        ),
        "agg_table_status": _with(
            SALES + WINDOWS.format(source="sales"), _status_row(AGG_TABLE, "windows", "window_start")
        ),
        "revenue_bands": _with(
            SALES,
            f"""SELECT {COLS}, round({REV}, 2) AS revenue,
       CASE WHEN {REV} < {low_cut} THEN '{low}' WHEN {REV} < {mid_cut} THEN '{mid}' WHEN {REV} IS NOT NULL
            THEN 'high' END AS revenue_band,
       {calm} AS ingested_at
FROM sales""",
        ),
        # decoding
        "decode_envelope": _with(
            SALES,
            f"SELECT event_id, CASE WHEN {SHORT} THEN '' WHEN {NOT_JSON} THEN 'not json' ELSE {_BODY} END AS payload "
            "FROM sales",
        ),
        "envelope_header": (
            f"SELECT event_id, NOT ({SHORT}) AS is_framed, CAST(CASE WHEN {SHORT} THEN -1 ELSE 1 END AS INTEGER) "
            "AS schema_id FROM events"
        ),
        "decode_payload": _with(
            SALES,
            f"""SELECT event_id, CASE WHEN ok THEN transaction_id END AS transaction_id,
       CASE WHEN ok THEN CAST(quantity AS DOUBLE) END AS quantity,
       CASE WHEN ok THEN CAST(CAST(price AS REAL) AS DOUBLE) END AS price,
       CASE WHEN ok THEN {_WIRE_TIME} END AS transaction_ts
FROM (SELECT *, NOT ({SHORT} OR {NOT_JSON}) AS ok FROM sales)""",
        ),
        "decode_filter_bad": f"SELECT event_id FROM events WHERE NOT ({SHORT} OR {NOT_JSON})",
        "parse_timestamp": (
            "SELECT event_id, CASE WHEN event_id % 37 <> 0 THEN date_trunc('second', ts) END AS parsed_ts FROM events"
        ),
        "parse_and_cast": _with(
            SALES,
            f"""SELECT event_id, transaction_id, CASE WHEN NOT ({NO_STORE}) THEN store_id END AS store_id, product_id,
       quantity, CAST(CAST(price AS REAL) AS DOUBLE) AS price, payment_type,
       CASE WHEN NOT ({NO_TIME}) THEN date_trunc('second', transaction_ts) END AS transaction_ts
FROM sales WHERE NOT ({SHORT} OR {NOT_JSON})""",
        ),
        "quarantine_rows": (
            f"""SELECT event_id, CASE WHEN {SHORT} THEN 'not_framed' WHEN {NOT_JSON} THEN 'undecodable' ELSE 'missing_required' END
         AS reject_reason
FROM events WHERE {SHORT} OR {NOT_JSON} OR {NO_STORE} OR {NO_TIME}"""
        ),
        "decode_versions": _with(
            SALES,
            """SELECT event_id, reason AS reject_reason,
       CASE WHEN reason IS NULL THEN transaction_id END AS transaction_id, CASE WHEN reason IS NULL THEN store_id END AS store_id,
       CASE WHEN reason IS NULL THEN product_id END AS product_id, CASE WHEN reason IS NULL THEN CAST(quantity AS DOUBLE) END AS quantity,
       CASE WHEN reason IS NULL THEN CAST(CAST(price AS REAL) AS DOUBLE) END AS price,
       CASE WHEN reason IS NULL THEN CASE WHEN event_id % 3 = 0 THEN 'online' ELSE payment_type END END AS payment_type,
       CASE WHEN reason IS NULL THEN date_trunc('second', transaction_ts) END AS transaction_ts
FROM (SELECT *, CASE WHEN event_id % 67 = 0 THEN 'unknown_schema' WHEN event_id % 71 = 0 THEN 'undecodable' END AS reason FROM sales)""",
        ),
        # fact table
        "fact_full": _with(DIRTY, f"SELECT *, round({REV}, 2) AS revenue FROM ({_first('sales_dirty')})"),
        "fact_first_occurrence": _with(DIRTY, _first("sales_dirty")),
        "fact_merge": _with(MERGED, merged),
        "fact_merge_idempotent": _with(MERGED, merged),
        "fact_table_merge": _with(MERGED, merged),
        "new_keys_anti": _with(
            TARGET,
            f"SELECT {COLS} FROM sales_dirty d WHERE NOT EXISTS "
            "(SELECT 1 FROM target t WHERE t.transaction_id = d.transaction_id)",
        ),
        # quality checks
        "dq_null": _with(
            DIRTY,
            f"SELECT CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS null_check_status, n AS null_count "
            f"FROM (SELECT count(*) FILTER (WHERE {_NULLS}) AS n FROM sales_dirty)",
        ),
        "dq_duplicate": _with(
            DIRTY,
            "SELECT CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS duplicate_check_status, n AS duplicate_count FROM "
            "(SELECT count(*) FILTER (WHERE c > 1) AS n FROM "
            "(SELECT count(*) AS c FROM sales_dirty GROUP BY transaction_id))",
        ),
        "dq_volume_anomaly": _with(SALES, ", " + _anomaly("volume", AS_OF)),
        "dq_volume_anomaly_fail": _with(SALES, ", " + _anomaly("volume", AS_OF_BUSY)),
        "dq_volume_anomaly_bounded": _with(SALES, ", " + _anomaly("volume", AS_OF_UNALIGNED, bounded=True)),
        "dq_revenue_anomaly": _with(SALES, ", " + _anomaly("revenue", AS_OF)),
        "dq_revenue_anomaly_fail": _with(SALES, ", " + _anomaly("revenue", AS_OF_BUSY)),
        "dq_revenue_anomaly_zero_fill": _with(SALES, ", " + _anomaly("revenue", AS_OF_UNALIGNED, zero_fill=True)),
        "dq_freshness": _with(
            SALES,
            "SELECT CASE WHEN n > 0 THEN 'PASS' ELSE 'WARN' END AS freshness_status, n AS recent_rows FROM "
            f"(SELECT count(*) AS n FROM sales WHERE transaction_ts >= {calm} - INTERVAL 15 MINUTE)",
        ),
        "dq_report": _report_query(DIRTY, "sales_dirty", AS_OF_BUSY, "SELECT * FROM report"),
        "dq_incremental": _report_query(DIRTY, "sales_dirty", AS_OF_BUSY, "SELECT * FROM report"),
        "dq_summary": _report_query(DIRTY, "sales_dirty", AS_OF_BUSY, "SELECT summary FROM summed"),
        "dq_summary_pass": _report_query(SALES, "sales", AS_OF, "SELECT summary FROM summed"),
        "dq_alerts": _report_query(
            DIRTY,
            "sales_dirty",
            AS_OF_BUSY,
            "SELECT CASE WHEN summary = 'PASS' THEN 'NO_ALERT' ELSE 'ALERT_SENT' END AS outcome, "
            "nullif(summary, 'PASS') AS alert FROM summed",
        ),
        "source_freshness": _with(
            SALES,
            f"""SELECT newest, CASE WHEN newest IS NULL OR newest < {calm} - INTERVAL 30 MINUTE THEN 'error'
            WHEN newest < {calm} - INTERVAL 15 MINUTE THEN 'warn' ELSE 'pass' END AS freshness_status
FROM (SELECT max(transaction_ts) AS newest FROM sales)""",
        ),
        # column tests
        "test_unique": _with(
            DIRTY, "SELECT transaction_id, count(*) AS cnt FROM sales_dirty GROUP BY 1 HAVING count(*) > 1"
        ),
        "test_not_null": _with(
            DIRTY,
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, count(*) - count({v}) AS failures FROM sales_dirty"
                for c, v in [
                    ("transaction_id", "transaction_id"),
                    ("store_id", "store_id"),
                    ("product_id", "product_id"),
                    ("quantity", "quantity"),
                    ("price", "price"),
                    ("transaction_ts", "transaction_ts"),
                    ("revenue", REV),
                ]
            ),
        ),
        "test_accepted_values": _with(
            DIRTY,
            "SELECT payment_type AS value, count(*) AS row_count FROM sales_dirty "
            f"WHERE payment_type NOT IN ({_ACCEPTED_LIST}) GROUP BY 1",
        ),
        "test_suite": _with(DIRTY, _fact_suite()),
        "test_relationships": _with(
            TARGET,
            f"SELECT transaction_id, transaction_ts FROM ({_first('sales_dirty')}) f "
            "WHERE transaction_id NOT IN (SELECT transaction_id FROM target)",
        ),
        "agg_not_null": _with(
            DIRTY + WINDOWS.format(source="sales_dirty"),
            " UNION ALL ".join(
                _suite_row(c, "not_null", f"SELECT count(*) FROM windows WHERE {c} IS NULL")
                for c in ("window_start", "window_end", "store_id", "total_revenue", "total_quantity")
            ),
        ),
        "agg_unique_key": _with(
            SALES + WINDOWS.format(source="sales"),
            "SELECT count(*) AS failures FROM (SELECT 1 FROM windows GROUP BY window_start, window_end, store_id "
            "HAVING count(*) > 1)",
        ),
        # arrival
        "late_rows": _with(
            SALES
            + f""", delayed AS (
  SELECT transaction_id, CAST(floor(epoch(transaction_ts) / {SLOT_SECONDS}) AS BIGINT) AS slot,
         transaction_ts - CASE WHEN event_id % 7 = 0 THEN INTERVAL 3 DAY ELSE INTERVAL 0 DAY END AS transaction_ts
  FROM sales
), tops AS (SELECT slot, max(transaction_ts) AS top FROM delayed GROUP BY 1),
marks AS (
  SELECT slot, date_trunc('milliseconds', max(top) OVER
           (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) - {TEN} AS watermark FROM tops
)""",
            "SELECT transaction_id, transaction_ts, watermark FROM delayed JOIN marks USING (slot) "
            "WHERE transaction_ts <= watermark",
        ),
        "reconcile_hourly": reconciled,
        # streams
        "stream_file_scan": _with(SALES, f"SELECT {COLS} FROM sales"),
        "stream_dedup": _with(SALES, f"SELECT {COLS} FROM sales"),
        "stream_dedup_within": _with(
            SALES
            + """, arrivals AS (
  SELECT event_id, transaction_id, transaction_ts, transaction_ts AS arrived_at, NULL AS first_ts FROM sales
  UNION ALL
  SELECT event_id, transaction_id, transaction_ts + INTERVAL 8 DAY, transaction_ts + INTERVAL 8 DAY, transaction_ts
  FROM sales WHERE event_id % 50 = 0
)"""
            + _SLICES,
            f"SELECT transaction_id, transaction_ts FROM sliced JOIN marks USING (slice) "
            f"WHERE first_ts IS NULL OR first_ts + {TEN} <= watermark",
        ),
        "stream_late_drop": _with(
            SALES
            + """, arrivals AS (
  SELECT transaction_id, transaction_ts AS arrived_at,
         transaction_ts - CASE WHEN event_id % 7 = 0 THEN INTERVAL 3 DAY ELSE INTERVAL 0 DAY END AS transaction_ts
  FROM sales
)"""
            + _SLICES,
            "SELECT transaction_id, transaction_ts FROM sliced JOIN marks USING (slice) "
            "WHERE watermark IS NULL OR transaction_ts > watermark",
        ),
        "stream_late_output": _with(
            SALES
            + """, arrivals AS (
  SELECT transaction_id, transaction_ts AS arrived_at,
         transaction_ts - CASE WHEN event_id % 7 = 0 THEN INTERVAL 3 DAY ELSE INTERVAL 0 DAY END AS transaction_ts
  FROM sales
)"""
            + _SLICES,
            "SELECT transaction_id, transaction_ts, coalesce(transaction_ts <= watermark, false) AS is_late "
            "FROM sliced JOIN marks USING (slice)",
        ),
        "stream_reconcile": reconciled,
        "stream_metrics": _with(
            SALES
            + """, arrivals AS (
  SELECT transaction_id, transaction_ts AS arrived_at,
         transaction_ts - CASE WHEN event_id % 7 = 0 THEN INTERVAL 3 DAY ELSE INTERVAL 0 DAY END AS transaction_ts
  FROM sales
)"""
            + _SLICES,
            "SELECT count(*) AS input_rows, count(*) FILTER (transaction_ts <= watermark) AS late_rows, CAST(0 AS BIGINT) AS errors "
            "FROM sliced JOIN marks USING (slice)",
        ),
        "stream_implausible": _with(ACCEPTED, f"SELECT {COLS} FROM accepted WHERE event_id % 59 <> 0 AND event_id % 61 <> 0"),
        "stream_agg_5min": _with(SALES, _closed_windows("sales")),
        "stream_raw_append": _with(ACCEPTED, f"SELECT {COLS} FROM accepted"),
        "stream_job_windows": _with(ACCEPTED, _closed_windows("accepted")),
        "dq_rejects": f"""
SELECT CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS reject_check_status, count(*) AS reject_count,
       count(*) FILTER ({SHORT}) AS not_framed, count(*) FILTER (NOT ({SHORT}) AND {NOT_JSON}) AS undecodable,
       count(*) FILTER (NOT ({SHORT}) AND NOT ({NOT_JSON})) AS missing_required,
       CAST(0 AS BIGINT) AS unknown_schema, CAST(0 AS BIGINT) AS implausible_time
FROM events WHERE {SHORT} OR {NOT_JSON} OR {NO_STORE} OR {NO_TIME}""",
        "stream_rejects": (
            f"""SELECT event_id, CASE WHEN {SHORT} THEN 'not_framed' WHEN {NOT_JSON} THEN 'undecodable' ELSE 'missing_required' END
         AS reject_reason
FROM events WHERE {SHORT} OR {NOT_JSON} OR {NO_STORE} OR {NO_TIME}"""
        ),
        "retention_table": _with(SALES, f"SELECT {COLS} FROM sales WHERE transaction_ts >= DATE '2024-01-11'"),
        "compacted_table": _with(SALES, f"SELECT {COLS} FROM sales"),
        "sink_upsert_agg": _with(SALES, _closed_windows("sales")),
        "sink_upsert_raw": _with(SALES, f"SELECT {COLS} FROM sales"),
    }
