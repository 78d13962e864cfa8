"""DuckDB SQL oracle for every registered query that SQL can express.

Each statement is self-contained over the pre-registered ``events`` view.
Rules that keep both engines bit-equal: double literals carry ``::DOUBLE``
(DuckDB literals are DECIMAL); money sums go through DECIMAL(30,12); the
medium-amount bound is 450*0.55 computed in doubles; integer sums are cast to
BIGINT (DuckDB widens them).
"""

from __future__ import annotations

_PMOD = "(((({x}) % {m}) + {m}) % {m})"


def _pmod(x: str, m: int) -> str:
    return _PMOD.format(x=x, m=m)


TRANSACTIONS = f"""
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
dims AS (
  SELECT *,
    CASE WHEN event_type = 'error' THEN 'FAILED'
         WHEN event_type = 'signup' THEN 'PENDING'
         WHEN event_type = 'click' THEN 'success'
         ELSE 'SUCCESS' END AS status,
    CASE WHEN k < 18 THEN 'grocery' WHEN k < 30 THEN 'travel' WHEN k < 43 THEN 'electronics'
         WHEN k < 61 THEN 'dining' WHEN k < 71 THEN 'fuel' WHEN k < 82 THEN 'entertainment'
         WHEN k < 92 THEN 'pharmacy' ELSE 'luxury' END AS merchant_category,
    CASE WHEN {_pmod('event_id * 7919 + 13', 100)} < 45 THEN 'mobile'
         WHEN {_pmod('event_id * 7919 + 13', 100)} < 73 THEN 'web'
         WHEN {_pmod('event_id * 7919 + 13', 100)} < 95 THEN 'pos' ELSE 'api' END AS channel,
    CASE WHEN {_pmod('event_id * 104729 + 7', 100)} < 72 THEN 'US'
         WHEN {_pmod('event_id * 104729 + 7', 100)} < 79 THEN 'CA'
         WHEN {_pmod('event_id * 104729 + 7', 100)} < 84 THEN 'GB'
         WHEN {_pmod('event_id * 104729 + 7', 100)} < 88 THEN 'DE'
         WHEN {_pmod('event_id * 104729 + 7', 100)} < 91 THEN 'FR'
         WHEN {_pmod('event_id * 104729 + 7', 100)} < 94 THEN 'JP'
         WHEN {_pmod('event_id * 104729 + 7', 100)} < 97 THEN 'BR' ELSE 'IN' END AS country,
    CASE {_pmod('user_id', 7)} WHEN 0 THEN 'USD' WHEN 1 THEN 'USD' WHEN 2 THEN 'USD'
         WHEN 3 THEN 'EUR' WHEN 4 THEN 'GBP' WHEN 5 THEN 'JPY' WHEN 6 THEN 'CAD' END AS currency
  FROM ev
),
mult AS (
  SELECT *,
    CASE merchant_category WHEN 'travel' THEN CAST('2.00' AS DECIMAL(4,2))
         WHEN 'electronics' THEN CAST('1.65' AS DECIMAL(4,2))
         WHEN 'luxury' THEN CAST('2.80' AS DECIMAL(4,2))
         WHEN 'fuel' THEN CAST('0.90' AS DECIMAL(4,2))
         WHEN 'pharmacy' THEN CAST('0.70' AS DECIMAL(4,2))
         ELSE CAST('1.00' AS DECIMAL(4,2)) END AS category_multiplier,
    CAST(value AS DECIMAL(18,2)) * 2 AS base_amount
  FROM dims
),
shaped AS (
  SELECT *,
    CASE WHEN base_amount IS NOT NULL THEN
      CAST(greatest(CAST('4.00' AS DECIMAL(6,2)),
                    least(CAST('4500.00' AS DECIMAL(6,2)), round(base_amount * category_multiplier, 2))) AS DOUBLE)
    END AS amount
  FROM mult
),
risk AS (
  SELECT *,
    CAST(greatest(50, least(4500, 120
      + CASE WHEN amount > 300::DOUBLE THEN 350 ELSE 0 END
      + CASE WHEN amount > 800::DOUBLE THEN 950 ELSE 0 END
      + CASE WHEN merchant_category IN ('electronics', 'luxury') THEN 350 ELSE 0 END
      + CASE WHEN channel IN ('web', 'api') THEN 250 ELSE 0 END
      + CASE WHEN country <> 'US' THEN 250 ELSE 0 END)) AS INTEGER) AS fraud_probability_units,
    {_pmod('event_id * 48271 + 11', 10000)} AS label_draw
  FROM shaped
),
keyed AS (
  SELECT event_id,
    printf('txn_%07d', event_id) AS transaction_id,
    printf('user_%05d', user_id) AS user_id,
    amount, currency, status, merchant_category, channel, country,
    ts AS event_time,
    CASE WHEN label_draw < fraud_probability_units THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_fraud,
    fraud_probability_units, label_draw
  FROM risk
),
transactions AS (
  SELECT transaction_id, user_id, amount, currency, status, merchant_category, channel,
         country, event_time, is_fraud
  FROM keyed
)"""

AMOUNT_RISK = """(CASE WHEN amount >= 450.0::DOUBLE THEN 0.2::DOUBLE
       WHEN amount >= 450.0::DOUBLE * 0.55::DOUBLE THEN 0.1::DOUBLE ELSE 0.02::DOUBLE END)"""
CATEGORY_RISK = "(CASE WHEN merchant_category IN ('electronics', 'luxury') THEN 0.11::DOUBLE ELSE 0.02::DOUBLE END)"
CHANNEL_RISK = "(CASE WHEN channel IN ('web', 'api') THEN 0.09::DOUBLE ELSE 0.025::DOUBLE END)"
BORDER_RISK = "(CASE WHEN country <> 'US' THEN 0.07::DOUBLE ELSE 0.015::DOUBLE END)"
LATENT = "(COALESCE(is_fraud, 0.0::DOUBLE) * 0.46::DOUBLE)"
SCORE = (
    f"least(1.0::DOUBLE, greatest(0.0::DOUBLE, 0.03::DOUBLE + {AMOUNT_RISK} + {CATEGORY_RISK}"
    f" + {CHANNEL_RISK} + {BORDER_RISK} + {LATENT}))"
)
DISCOUNT = """COALESCE(CASE merchant_category WHEN 'grocery' THEN 0.03::DOUBLE WHEN 'travel' THEN 0.05::DOUBLE
       WHEN 'electronics' THEN 0.08::DOUBLE WHEN 'dining' THEN 0.10::DOUBLE WHEN 'fuel' THEN 0.00::DOUBLE
       WHEN 'entertainment' THEN 0.06::DOUBLE WHEN 'pharmacy' THEN 0.02::DOUBLE
       WHEN 'luxury' THEN 0.04::DOUBLE END, 0.0::DOUBLE)"""

ENRICHED = f"""{TRANSACTIONS},
succ AS (
  SELECT transaction_id, user_id, amount, currency, upper(status) AS status, merchant_category,
         channel, country, event_time, is_fraud
  FROM transactions WHERE upper(status) = 'SUCCESS'
),
scored AS (
  SELECT *, CAST(amount AS DOUBLE) AS gross_amount, {DISCOUNT} AS discount_rate, {SCORE} AS fraud_score
  FROM succ
),
enriched AS (
  SELECT transaction_id, user_id, event_time, currency, country, merchant_category, channel, status,
         gross_amount, discount_rate, gross_amount * (1.0::DOUBLE - discount_rate) AS net_amount,
         is_fraud, fraud_score, fraud_score >= 0.65::DOUBLE AS is_flagged
  FROM scored
)"""


def _money(col: str, scale: int | None = None) -> str:
    s = f"sum(CAST({col} AS DECIMAL(30,12)))"
    if scale is not None:
        s = f"round({s}, {scale})"
    return f"CAST({s} AS DOUBLE)"


def _windows(interval: str) -> str:
    return f"""SELECT time_bucket(INTERVAL '{interval}', event_time) AS window_start,
       time_bucket(INTERVAL '{interval}', event_time) + INTERVAL '{interval}' AS window_end,
       count(*) AS event_count,
       {_money('gross_amount', 2)} AS gross_value,
       {_money('net_amount', 2)} AS net_value,
       CAST(sum(CAST(is_flagged AS INTEGER)) AS BIGINT) AS flagged_count,
       avg(CAST(is_flagged AS DOUBLE)) AS fraud_rate
FROM enriched WHERE event_time IS NOT NULL GROUP BY 1, 2"""


def _closed(interval: str, delay: str = "30 minutes") -> str:
    return f"""SELECT * FROM ({_windows(interval)}) w
WHERE window_end <= (SELECT date_trunc('millisecond', max(event_time)) FROM enriched) - INTERVAL '{delay}'"""


WITH_ENRICHED = f"WITH {ENRICHED}"
WITH_TX = f"WITH {TRANSACTIONS}"
WINDOWS_CTE = f"WITH {ENRICHED},\nemitted AS ({_closed('5 minutes')})"

ENRICHED_SUMMARY = f"""SELECT count(*) AS "rows",
       COALESCE(CAST(sum(CAST(is_flagged AS INTEGER)) AS BIGINT), 0) AS flagged,
       COALESCE({_money('gross_amount')}, 0.0::DOUBLE) AS gross,
       COALESCE({_money('net_amount')}, 0.0::DOUBLE) AS net,
       strftime(min(event_time), '%Y-%m-%dT%H:%M:%S') AS min_event_time,
       strftime(max(event_time), '%Y-%m-%dT%H:%M:%S') AS max_event_time
FROM enriched"""

LEGACY_ROWS = """SELECT transaction_id, user_id, amount, status,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp",
       amount * 0.9::DOUBLE AS discounted_amount
FROM transactions WHERE status = 'SUCCESS'"""

_TX_COLS = "transaction_id, user_id, amount, currency, status, merchant_category, channel, country, event_time, is_fraud"


def _json_text() -> str:
    return """'{"transaction_id":"' || transaction_id || '","user_id":"' || user_id
  || '","amount":' || CAST(amount AS VARCHAR) || ',"status":"' || status
  || '","timestamp":"' || "timestamp" || '","discounted_amount":' || CAST(discounted_amount AS VARCHAR) || '}'"""


HISTOGRAM = f"""{WITH_ENRICHED},
vals AS (
  SELECT 'gross' AS series, gross_amount AS x FROM enriched WHERE gross_amount IS NOT NULL AND NOT isnan(gross_amount)
  UNION ALL
  SELECT 'net' AS series, net_amount AS x FROM enriched WHERE net_amount IS NOT NULL AND NOT isnan(net_amount)
),
b0 AS (SELECT series, min(x) AS lo, max(x) AS hi FROM vals GROUP BY series),
b AS (
  SELECT series,
         CASE WHEN lo = hi THEN lo - 0.5::DOUBLE ELSE lo END AS lo,
         CASE WHEN lo = hi THEN hi + 0.5::DOUBLE ELSE hi END AS hi
  FROM b0
),
r0 AS (
  SELECT v.series, v.x, b.lo, b.hi, (b.hi - b.lo) / 34.0::DOUBLE AS step,
         least(CAST(floor((v.x - b.lo) * (34.0::DOUBLE / (b.hi - b.lo))) AS BIGINT), 33) AS i0
  FROM vals v JOIN b ON v.series = b.series
),
r1 AS (SELECT *, CASE WHEN x < (CASE WHEN i0 = 34 THEN hi ELSE i0 * step + lo END) THEN i0 - 1 ELSE i0 END AS i1 FROM r0),
r2 AS (
  SELECT series, CASE WHEN i1 <> 33 AND x >= (CASE WHEN i1 + 1 = 34 THEN hi ELSE (i1 + 1) * step + lo END)
                      THEN i1 + 1 ELSE i1 END AS bin
  FROM r1
),
counts AS (SELECT series, bin, count(*) AS c FROM r2 GROUP BY series, bin),
grid AS (SELECT b.series, b.lo, b.hi, (b.hi - b.lo) / 34.0::DOUBLE AS step, g.range AS bin FROM b, range(34) g)
SELECT grid.series, CAST(grid.bin AS INTEGER) AS bin,
       grid.bin * grid.step + grid.lo AS bin_start,
       CASE WHEN grid.bin + 1 = 34 THEN grid.hi ELSE (grid.bin + 1) * grid.step + grid.lo END AS bin_end,
       COALESCE(counts.c, 0) AS "count"
FROM grid LEFT JOIN counts ON grid.series = counts.series AND grid.bin = counts.bin"""

RUN_METRICS = f"""{WINDOWS_CTE},
s AS ({ENRICHED_SUMMARY}),
src AS (SELECT count(*) AS n, count(*) FILTER (WHERE transaction_id IS NULL) AS bad FROM transactions),
w AS (SELECT count(*) AS n, COALESCE(max(fraud_rate), 0.0::DOUBLE) AS mx FROM emitted),
m AS (
  SELECT src.n AS source_events, s."rows" AS enriched_events,
         greatest(src.n - s."rows", 0) AS filtered_count,
         s.flagged AS flagged_count, s.gross AS total_gross_value, s.net AS total_net_value,
         s.min_event_time, s.max_event_time, w.n AS window_count, w.mx AS max_window_fraud_rate,
         src.bad AS rows_unparsed
  FROM s, src, w
)
SELECT source_events, enriched_events, filtered_count,
       CASE WHEN source_events > 0 THEN CAST(filtered_count AS DOUBLE) / CAST(source_events AS DOUBLE) ELSE 0.0::DOUBLE END AS filtered_pct,
       window_count, flagged_count,
       CASE WHEN enriched_events > 0 THEN CAST(flagged_count AS DOUBLE) / CAST(enriched_events AS DOUBLE) ELSE 0.0::DOUBLE END AS flagged_rate,
       total_gross_value, total_net_value, total_gross_value - total_net_value AS discount_value,
       max_window_fraud_rate, min_event_time, max_event_time, rows_unparsed
FROM m"""

# The run over landed files: seven malformed lines more in the input.
RUN_METRICS_BROKEN_LINES = RUN_METRICS.replace(
    "src AS (SELECT count(*) AS n, count(*) FILTER (WHERE transaction_id IS NULL) AS bad FROM transactions)",
    "src AS (SELECT count(*) + 7 AS n, count(*) FILTER (WHERE transaction_id IS NULL) + 7 AS bad FROM transactions)",
)

METRICS_RECORD = f"""SELECT r.*, CAST(1 AS BIGINT) AS enriched_batches, CAST(1 AS BIGINT) AS windowed_batches,
       CAST(0 AS BIGINT) AS rows_dropped_by_watermark, 'table' AS source, '5 minutes' AS window_duration,
       '30 minutes' AS watermark_delay, 0.65::DOUBLE AS fraud_threshold, 0.08::DOUBLE AS fraud_alert_rate,
       (SELECT '[' || string_agg('{{"status":"' || status || '","count":' || n || '}}', ',' ORDER BY status) || ']'
        FROM (SELECT status, count(*) AS n FROM ({WITH_TX} SELECT status FROM transactions WHERE status IS NOT NULL) GROUP BY status)
       ) AS status_counts
FROM ({RUN_METRICS}) r"""

def _arrivals(late: int) -> str:
    """Rows arrive by eighths of the time range, with ``late`` an eighth of them one part late and
    an eighth ``late`` parts; batch numbers the parts that have rows."""
    later = f" + CASE {_pmod('e.event_id', 8)} WHEN 0 THEN 1 WHEN 4 THEN {late} ELSE 0 END" if late else ""
    return f"""span AS (SELECT CAST(floor(epoch(min(ts))) AS BIGINT) AS lo, CAST(floor(epoch(max(ts))) AS BIGINT) AS hi FROM events),
arrivals AS (
  SELECT transaction_id, part, dense_rank() OVER (ORDER BY part) - 1 AS batch
  FROM (SELECT printf('txn_%07d', e.event_id) AS transaction_id,
               COALESCE(least((((CAST(floor(epoch(e.ts)) AS BIGINT) - span.lo) * 8) // (span.hi - span.lo + 1)){later}, 7), 0) AS part
        FROM events e, span)
),
placed AS (SELECT s.*, a.part, a.batch FROM enriched s JOIN arrivals a ON s.transaction_id = a.transaction_id)"""


def _marks(back: int) -> str:
    """The watermark that a batch's rows are held against: of the rows up to ``back`` batches before."""
    return f"""tops AS (SELECT batch, max(event_time) AS top FROM placed GROUP BY batch),
marks AS (
  SELECT p.batch, (SELECT date_trunc('millisecond', max(top)) FROM tops t WHERE t.batch <= p.batch - {back}) - INTERVAL '30 minutes' AS mark
  FROM (SELECT DISTINCT batch FROM placed) p
),
marked AS (
  SELECT p.*, COALESCE(time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' <= m.mark, false) AS late
  FROM placed p JOIN marks m ON p.batch = m.batch
)"""


def _late_rows(late: int, back: int) -> str:
    return f"""WITH {ENRICHED},
{_arrivals(late)},
{_marks(back)},
kept AS (SELECT * FROM marked WHERE NOT late)
SELECT * FROM ({_windows('5 minutes').replace('FROM enriched', 'FROM kept')}) w
WHERE window_end <= (SELECT date_trunc('millisecond', max(event_time)) FROM enriched) - INTERVAL '30 minutes'"""


# Within a run rows are held against the watermark of the batch before, which knows the rows up to two batches back.
LATE_DROPS = f"""WITH {ENRICHED},
{_arrivals(3)},
{_marks(2)},
gone AS (SELECT batch, count(DISTINCT time_bucket(INTERVAL '5 minutes', event_time)) AS n FROM marked WHERE late GROUP BY batch),
came AS (SELECT batch, count(*) AS n FROM arrivals GROUP BY batch)
SELECT came.batch, came.n AS input_rows, COALESCE(gone.n, 0) AS windows_dropped
FROM came LEFT JOIN gone ON came.batch = gone.batch"""

OPEN_WINDOWS = f"""WITH {ENRICHED}
SELECT * FROM ({_windows('5 minutes')}) w
WHERE window_end > (SELECT date_trunc('millisecond', max(event_time)) FROM enriched) - INTERVAL '30 minutes'"""

_ENRICHED_COLS = (
    "transaction_id, user_id, event_time, currency, country, merchant_category, channel, status, gross_amount, discount_rate, "
    "net_amount, is_fraud, fraud_score, is_flagged"
)

COMMITTED = f"""WITH {ENRICHED},
{_arrivals(0)}
SELECT {_ENRICHED_COLS} FROM placed WHERE batch < (SELECT max(batch) FROM arrivals)"""

# The second half of the parts meets the new rule table.
RULE_JOIN = f"""WITH {ENRICHED},
{_arrivals(0)},
rated AS (
  SELECT * REPLACE (CASE WHEN part < 4 THEN discount_rate
    ELSE COALESCE(CASE merchant_category WHEN 'grocery' THEN 0.25::DOUBLE WHEN 'travel' THEN 0.05::DOUBLE
         WHEN 'electronics' THEN 0.5::DOUBLE WHEN 'dining' THEN 0.125::DOUBLE WHEN 'fuel' THEN 0.0625::DOUBLE
         WHEN 'pharmacy' THEN 0.02::DOUBLE WHEN 'luxury' THEN 0.04::DOUBLE END, 0.0::DOUBLE) END AS discount_rate)
  FROM placed
)
SELECT {_ENRICHED_COLS.replace('net_amount', 'gross_amount * (1.0::DOUBLE - discount_rate) AS net_amount')} FROM rated"""

BATCH_BOUND = f"""WITH files AS (SELECT greatest(20, CAST(ceil(count(*) / 250000) AS BIGINT)) AS n FROM events),
placed AS (SELECT {_pmod('event_id', 20).replace('20', 'files.n')} AS file FROM events, files),
batches AS (
  SELECT b.bound, dense_rank() OVER (PARTITION BY b.bound ORDER BY place // b.files) - 1 AS batch
  FROM (SELECT dense_rank() OVER (ORDER BY file) - 1 AS place FROM placed) p,
       (VALUES ('files', 4), ('bytes', 2)) AS b(bound, files)
)
SELECT bound, batch, count(*) AS input_rows FROM batches GROUP BY bound, batch"""

DEBUG_SINKS = f"""WITH {ENRICHED},
{_arrivals(0)},
output AS ({LEGACY_ROWS}),
seen AS (
  SELECT 'input' AS stream, transaction_id, user_id, amount, status,
         strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp", CAST(NULL AS DOUBLE) AS discounted_amount
  FROM transactions
  UNION ALL
  SELECT 'output', transaction_id, user_id, amount, status, "timestamp", discounted_amount FROM output
)
SELECT seen.*, a.batch FROM seen JOIN arrivals a ON seen.transaction_id = a.transaction_id
QUALIFY row_number() OVER (PARTITION BY stream, a.batch ORDER BY seen.transaction_id) <= 20"""

ORACLE: dict[str, str] = {
    "stream_failure_recovery": RULE_JOIN,
    "stream_failure_sibling": f"{WITH_ENRICHED}\n{_closed('5 minutes')}",
    "stream_continuous": f"{WITH_ENRICHED}\n{_closed('5 minutes')}",
    "stream_source_switch": f"{WITH_ENRICHED}\nSELECT enriched.*, s.source FROM enriched, (VALUES ('Folder'), ('TABLE')) AS s(source)",
    "stream_debug_sinks": DEBUG_SINKS,
    "stream_dual_sink_source": f"{WITH_ENRICHED}\n{_closed('5 minutes')}",
    "stream_dual_sink_chained": f"{WITH_ENRICHED}\n{_closed('5 minutes')}",
    "stream_late_rows": _late_rows(1, 1),
    "stream_late_rows_one_run": _late_rows(3, 2),
    "stream_late_drops": LATE_DROPS,
    "open_windows": OPEN_WINDOWS,
    "stream_replay_after_crash": f"{WITH_ENRICHED}\n{_closed('5 minutes')}",
    "stream_replay_after_crash_enriched": f"{WITH_ENRICHED}\nSELECT * FROM enriched",
    "committed_output": COMMITTED,
    "stream_rule_join": RULE_JOIN,
    "stream_batch_bound": BATCH_BOUND,
    "stream_observed_metrics": METRICS_RECORD,
    "run_metrics_no_full_copy": RUN_METRICS_BROKEN_LINES,
    "metrics_record": METRICS_RECORD,
    "kafka_payload_decode": f"{WITH_TX}\nSELECT {_TX_COLS} FROM transactions",
    "weighted_status": f"""SELECT event_id, CASE WHEN {_pmod('event_id * 15485863 + 3', 100)} < 88 THEN 'SUCCESS'
       WHEN {_pmod('event_id * 15485863 + 3', 100)} < 96 THEN 'FAILED' ELSE 'PENDING' END AS status FROM events""",
    "transactions_view": f"{WITH_TX}\nSELECT {_TX_COLS} FROM transactions",
    "json_payload_decode": f"{WITH_TX}\nSELECT {_TX_COLS} FROM transactions",
    "full_copy_roundtrip": f"{WITH_TX}\nSELECT {_TX_COLS} FROM transactions",
    "ndjson_landing_roundtrip": f"{WITH_TX}\nSELECT {_TX_COLS} FROM transactions",
    "enrich_transactions": f"{WITH_ENRICHED}\nSELECT * FROM enriched",
    "stream_enriched_sink": f"{WITH_ENRICHED}\nSELECT * FROM enriched",
    "stream_ndjson_source": f"{WITH_ENRICHED}\nSELECT * FROM enriched",
    "discount_lookup_join": f"{WITH_ENRICHED}\nSELECT * FROM enriched",
    "batch_windowed_5m": f"{WITH_ENRICHED}\n{_windows('5 minutes')}",
    "stream_windowed_5m": f"{WITH_ENRICHED}\n{_closed('5 minutes')}",
    "stream_windowed_1h": f"{WITH_ENRICHED}\n{_closed('1 hour')}",
    "stream_incremental_resume": f"{WITH_ENRICHED}\n{_closed('5 minutes')}",
    "stream_dual_sink": RUN_METRICS,
    "run_metrics": RUN_METRICS,
    "fraud_components": f"""{WITH_TX}
SELECT transaction_id, {AMOUNT_RISK} AS amount_risk, {CATEGORY_RISK} AS category_risk,
       {CHANNEL_RISK} AS channel_risk, {BORDER_RISK} AS cross_border_risk, {LATENT} AS latent_signal,
       {SCORE} AS fraud_score
FROM transactions""",
    "discount_lookup": f"{WITH_TX}\nSELECT transaction_id, merchant_category, {DISCOUNT} AS discount_rate FROM transactions",
    "flagged_transactions": f"""{WITH_ENRICHED}
SELECT transaction_id, event_time, merchant_category, channel, country, gross_amount, fraud_score
FROM enriched WHERE is_flagged""",
    "enriched_summary": f"{WITH_ENRICHED}\n{ENRICHED_SUMMARY}",
    "windowed_summary": f"""{WINDOWS_CTE}
SELECT count(*) AS "rows", COALESCE(max(fraud_rate), 0.0::DOUBLE) AS max_fraud_rate FROM emitted""",
    "status_counts": f'{WITH_TX}\nSELECT status, count(*) AS "count" FROM transactions GROUP BY status',
    "throughput_series": f"{WINDOWS_CTE}\nSELECT window_start, event_count FROM emitted",
    "flag_rate_series": f"""{WINDOWS_CTE}
SELECT window_start, fraud_rate, fraud_rate >= 0.08::DOUBLE AS is_alert FROM emitted""",
    "alert_windows": f"{WINDOWS_CTE}\nSELECT * FROM emitted WHERE fraud_rate >= 0.08::DOUBLE",
    "net_value_by_category": f"""{WITH_ENRICHED}
SELECT merchant_category, {_money('net_amount')} AS net_value FROM enriched GROUP BY merchant_category""",
    "flag_rate_by_channel": f"""{WITH_ENRICHED}
SELECT channel, avg(CAST(is_flagged AS DOUBLE)) AS flagged_rate,
       avg(CAST(is_flagged AS DOUBLE)) >= 0.08::DOUBLE AS is_alert
FROM enriched GROUP BY channel""",
    "status_breakdown": f"""{WITH_ENRICHED},
dom(position, status) AS (VALUES (0, 'SUCCESS'), (1, 'FAILED'), (2, 'PENDING')),
c AS (SELECT status, count(*) AS n FROM transactions GROUP BY status),
t AS (SELECT count(*) AS total FROM transactions),
e AS (SELECT count(*) AS ne FROM enriched)
SELECT CAST(dom.position AS INTEGER) AS position, dom.status, COALESCE(c.n, 0) AS "count",
       CASE WHEN t.total > 0 THEN CAST(t.total - e.ne AS DOUBLE) / CAST(t.total AS DOUBLE) ELSE 0.0::DOUBLE END AS filtered_share
FROM dom LEFT JOIN c ON dom.status = c.status, t, e""",
    "amount_histogram": HISTOGRAM,
    "sample_enriched_top8": f"""{WITH_ENRICHED}
SELECT transaction_id, event_time, merchant_category, channel, gross_amount, discount_rate,
       net_amount, fraud_score, is_flagged
FROM enriched ORDER BY event_time, transaction_id LIMIT 8""",
    "sample_windows_top12": f"{WINDOWS_CTE}\nSELECT * FROM emitted ORDER BY window_start LIMIT 12",
    "json_payload_encode": f"{WITH_TX},\nlg AS ({LEGACY_ROWS})\nSELECT {_json_text()} AS value FROM lg",
    "legacy_decode_discount": f"{WITH_TX}\n{LEGACY_ROWS}",
    "stream_legacy_job": f"{WITH_TX},\nlg AS ({LEGACY_ROWS})\nSELECT {_json_text()} AS value FROM lg",
    "weighted_assignment": f"""{WITH_TX}
SELECT event_id, k, status, merchant_category, channel, country, currency FROM dims""",
    "shape_amounts": f"""{WITH_TX}
SELECT event_id, merchant_category, CAST(base_amount AS DOUBLE) AS base_amount,
       CAST(category_multiplier AS DOUBLE) AS category_multiplier, amount
FROM shaped""",
    "risk_probability": f"""{WITH_TX}
SELECT transaction_id, amount, merchant_category, channel, country, fraud_probability_units,
       CAST(fraud_probability_units AS DOUBLE) / 10000.0::DOUBLE AS fraud_probability
FROM keyed""",
    "label_assignment": f"""{WITH_TX}
SELECT transaction_id, label_draw, fraud_probability_units, is_fraud FROM keyed""",
    "fraud_uplift": f"""{WITH_TX},
up AS (
  SELECT *, CAST('1.15' AS DECIMAL(6,5)) + CAST('0.00105' AS DECIMAL(6,5))
            * CAST({_pmod('event_id * 31 + 5', 1000)} AS DECIMAL(4,0)) AS factor
  FROM keyed
)
SELECT transaction_id, is_fraud, amount AS base_amount, CAST(factor AS DOUBLE) AS uplift_factor,
       CASE WHEN is_fraud = 1.0::DOUBLE
            THEN CAST(round(CAST(amount AS DECIMAL(18,2)) * factor, 2) AS DOUBLE) ELSE amount END AS amount
FROM up""",
}
