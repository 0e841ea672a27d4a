"""The registered queries once more in SQL, for comparison on the same tables."""

from __future__ import annotations

from checks.catalog import (
    CANDIDATES,
    FEATURE_DAYS,
    HISTORY_DAYS,
    INTERCEPT,
    OFFSET,
    SLOPE,
    WEIGHTS,
)
from clickloom.schemas import LONG_WINDOW_DAYS, MODEL_FEATURES

FEATURES = list(WEIGHTS)
_COUNTS = FEATURES[:4]
_RATES = FEATURES[4:]
_DAY = "CAST(date_diff('day', DATE '1970-01-01', CAST({} AS DATE)) AS BIGINT)"


def _r(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {alias}"


def _n(expr: str, alias: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {alias}"


def _gold(name: str, snaps: str, cart: str, seconds: bool) -> str:
    """Gold over the given snapshots, cart statistics and duration rule."""
    minutes = "whole_min" if seconds else "exact_min"
    return f"""
{name} AS (
  SELECT visitorid, snapshot_day,
    CAST(coalesce(sum(views) OVER w7, 0) AS BIGINT) AS user_views_7d,
    CAST(coalesce(sum(addtocarts) OVER w7, 0) AS BIGINT) AS user_addtocart_7d,
    CAST(coalesce(sum(transactions) OVER w30, 0) AS BIGINT) AS user_transactions_30d,
    CAST(coalesce(sum(sessions) OVER w30, 0) AS BIGINT) AS user_sessions_30d,
    coalesce(sum(duration) OVER w30 / nullif(sum(sessions) OVER w30, 0), 0.0)
      AS avg_session_duration_30d,
    coalesce(CAST(sum(pop) OVER w7 AS DOUBLE) / nullif(sum(cart_n) OVER w7, 0), 0.0)
      AS user_cart_items_avg_popularity_7d,
    coalesce(CAST(sum(top) OVER w7 AS DOUBLE) / nullif(sum(cart_n) OVER w7, 0), 0.0)
      AS user_cart_top_seller_ratio_7d
  FROM (
    SELECT n.visitorid, n.snapshot_day,
      coalesce(d.views, 0) AS views, coalesce(d.addtocarts, 0) AS addtocarts,
      coalesce(d.transactions, 0) AS transactions,
      coalesce(z.sessions, 0) AS sessions, coalesce(z.{minutes}, 0.0) AS duration,
      coalesce(c.pop, 0) AS pop, coalesce(c.cart_n, 0) AS cart_n, coalesce(c.top, 0) AS top
    FROM {snaps} n
    LEFT JOIN daily d ON d.visitorid = n.visitorid AND d.snapshot_day = n.snapshot_day
    LEFT JOIN sdaily z ON z.visitorid = n.visitorid AND z.snapshot_day = n.snapshot_day
    LEFT JOIN {cart} c ON c.visitorid = n.visitorid AND c.snapshot_day = n.snapshot_day)
  WINDOW w7 AS (PARTITION BY visitorid ORDER BY snapshot_day
                RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING),
         w30 AS (PARTITION BY visitorid ORDER BY snapshot_day
                RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING))"""


def _cart(name: str, flag: str) -> str:
    return f"""
{name} AS (
  SELECT visitorid, snapshot_day, sum(p) AS pop, count(*) AS cart_n, sum({flag}) AS top
  FROM carts GROUP BY visitorid, snapshot_day)"""


PRELUDE = "WITH RECURSIVE " + ",".join(
    [
        """
m AS (
  SELECT event_id, ts AS event_time, user_id AS visitorid,
    CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'addtocart'
      WHEN 'purchase' THEN 'transaction' ELSE event_type END AS event,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS itemid,
    CASE WHEN event_type = 'purchase' THEN event_id END AS transactionid
  FROM events)""",
        """
clean AS (
  SELECT event_time, visitorid, event, itemid, transactionid FROM m
  WHERE event IN ('view', 'addtocart', 'transaction'))""",
        f"""
s AS (SELECT *, {_DAY.format('event_time')} AS snapshot_day FROM clean)""",
        """
faulty AS (
  SELECT event_id,
    CASE WHEN event_id % 101 <> 0 THEN event_time END AS event_time,
    CASE WHEN event_id % 89 <> 0 THEN visitorid END AS visitorid,
    CASE WHEN event_id % 103 <> 0 THEN event END AS event,
    CASE WHEN event_id % 97 <> 0 THEN itemid END AS itemid,
    CASE WHEN event_id % 79 = 0 THEN event_id
      WHEN event_id % 83 <> 0 THEN transactionid END AS transactionid
  FROM m)""",
        """
dirty AS (
  SELECT event_time, visitorid, event, itemid, transactionid FROM faulty
  UNION ALL
  SELECT event_time, visitorid, event, itemid, transactionid FROM faulty
  WHERE event_id % 71 = 0)""",
        """
dq AS (
  SELECT event_time, visitorid, event, itemid, transactionid,
    CASE WHEN event IS NULL THEN 'null_event'
      WHEN event NOT IN ('view', 'addtocart', 'transaction') THEN 'not_accepted_event'
      WHEN visitorid IS NULL THEN 'null_visitor_id'
      WHEN itemid IS NULL THEN 'null_item_id'
      WHEN event = 'transaction' AND transactionid IS NULL THEN 'transaction_without_id'
      WHEN event <> 'transaction' AND transactionid IS NOT NULL
        THEN 'id_without_transaction_event'
      WHEN event_time IS NULL THEN 'null_timestamp'
      WHEN copy_no > 1 THEN 'duplicated_row' END AS _dq_error
  FROM (SELECT *, row_number() OVER (
          PARTITION BY event_time, visitorid, event, itemid, transactionid) AS copy_no
        FROM dirty))""",
        """
hist_days AS (SELECT DISTINCT visitorid, snapshot_day FROM s)""",
        """
snaps AS (
  SELECT visitorid, snapshot_day FROM hist_days
  UNION
  SELECT visitorid, (SELECT max(snapshot_day) + 1 FROM s) FROM s)""",
        """
daily AS (
  SELECT visitorid, snapshot_day,
    count(*) FILTER (event = 'view') AS views,
    count(*) FILTER (event = 'addtocart') AS addtocarts,
    count(*) FILTER (event = 'transaction') AS transactions
  FROM s GROUP BY visitorid, snapshot_day)""",
        """
lagged AS (
  SELECT *, lag(event_time) OVER (PARTITION BY visitorid ORDER BY event_time) AS prev FROM s)""",
        """
flagged AS (
  SELECT *, CASE WHEN prev IS NULL OR epoch_us(event_time) - epoch_us(prev) > 1800000000
    THEN 1 ELSE 0 END AS new_session FROM lagged)""",
        """
numbered AS (
  SELECT *, sum(new_session) OVER (PARTITION BY visitorid ORDER BY event_time
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_id FROM flagged)""",
        f"""
sess AS (
  SELECT *, {_DAY.format('session_start')} AS snapshot_day,
    (epoch_us(session_end) - epoch_us(session_start)) // 1000000 / 60.0 AS whole_min,
    (epoch_us(session_end) - epoch_us(session_start)) / 60000000.0 AS exact_min
  FROM (SELECT visitorid, session_id, min(event_time) AS session_start,
          max(event_time) AS session_end, count(*) AS events,
          count(*) FILTER (event = 'transaction') AS transactions
        FROM numbered GROUP BY visitorid, session_id))""",
        """
sdaily AS (
  SELECT visitorid, snapshot_day, sum(whole_min) AS whole_min, sum(exact_min) AS exact_min,
    count(*) AS sessions
  FROM sess GROUP BY visitorid, snapshot_day)""",
        """
sold AS (
  SELECT itemid, snapshot_day, count(*) AS transactions FROM s
  WHERE event = 'transaction' GROUP BY itemid, snapshot_day)""",
        """
grid AS (
  SELECT i.itemid, d.snapshot_day, coalesce(t.transactions, 0) AS transactions
  FROM (SELECT DISTINCT itemid FROM s) i
  CROSS JOIN (SELECT DISTINCT snapshot_day FROM s) d
  LEFT JOIN sold t ON t.itemid = i.itemid AND t.snapshot_day = d.snapshot_day)""",
        """
pop AS (
  SELECT itemid, snapshot_day,
    CAST(coalesce(sum(transactions) OVER (PARTITION BY itemid ORDER BY snapshot_day
      RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS p
  FROM grid)""",
        """
thr AS (
  SELECT snapshot_day, CAST(quantile_disc(p, 0.9) AS DOUBLE) AS t_disc,
    quantile_cont(CAST(p AS DOUBLE), 0.9) AS t_lin
  FROM pop GROUP BY snapshot_day)""",
        """
flags AS (
  SELECT pop.*, t_disc, t_lin, CASE WHEN p >= t_disc THEN 1 ELSE 0 END AS top_disc,
    CASE WHEN p >= t_lin THEN 1 ELSE 0 END AS top_lin
  FROM pop JOIN thr USING (snapshot_day))""",
        """
carts AS (
  SELECT s.visitorid, s.itemid, s.snapshot_day, f.p, f.top_disc, f.top_lin
  FROM s LEFT JOIN flags f ON f.itemid = s.itemid AND f.snapshot_day = s.snapshot_day
  WHERE s.event = 'addtocart')""",
        _cart("cdisc", "top_disc"),
        _cart("clin", "top_lin"),
        _gold("gold", "snaps", "cdisc", True),
        _gold("research", "hist_days", "clin", False),
        """
bought AS (
  SELECT DISTINCT visitorid, snapshot_day FROM s WHERE event = 'transaction')""",
        """
training AS (
  SELECT r.*, CASE WHEN EXISTS (SELECT 1 FROM bought b WHERE b.visitorid = r.visitorid
    AND b.snapshot_day BETWEEN r.snapshot_day AND r.snapshot_day + 6) THEN 1 ELSE 0 END
    AS purchase_next_7d
  FROM research r)""",
        """
active AS (
  SELECT * FROM training
  WHERE user_views_7d + user_addtocart_7d + user_transactions_30d >= 5)""",
        f"""
prepared AS (
  SELECT * FROM active
  WHERE snapshot_day >= (SELECT min(snapshot_day) FROM active) + {FEATURE_DAYS}
    AND snapshot_day <= (SELECT max(snapshot_day) FROM active) - 6)""",
        """
dates AS (
  SELECT snapshot_day, row_number() OVER (ORDER BY snapshot_day) - 1 AS i,
    count(*) OVER () AS n
  FROM (SELECT DISTINCT snapshot_day FROM prepared))""",
        """
parts AS (
  SELECT *, CASE
    WHEN snapshot_day < (SELECT snapshot_day FROM dates
      WHERE i = CAST(floor(n * CAST(0.6 AS DOUBLE)) AS BIGINT)) THEN 'train'
    WHEN snapshot_day < (SELECT snapshot_day FROM dates
      WHERE i = CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT)) THEN 'validation'
    ELSE 'test' END AS split
  FROM prepared)""",
        """
vis AS (
  SELECT visitorid, count(*) FILTER (event = 'view') AS view,
    count(*) FILTER (event = 'addtocart') AS addtocart,
    count(*) FILTER (event = 'transaction') AS transaction
  FROM clean GROUP BY visitorid)""",
        """
itm AS (
  SELECT itemid, count(*) FILTER (event = 'view') AS view,
    count(*) FILTER (event = 'addtocart') AS addtocart,
    count(*) FILTER (event = 'transaction') AS transaction
  FROM clean GROUP BY itemid)""",
        """
rec AS (
  SELECT visitorid,
    (max(epoch_us(event_time)) - (SELECT max(epoch_us(event_time)) FROM clean))
      / -3600000000.0 AS hours,
    count(*) FILTER (event = 'transaction') AS transaction
  FROM clean GROUP BY visitorid)""",
        """
prec AS (
  SELECT visitorid,
    ((SELECT max(epoch_us(event_time)) FROM clean) - max(epoch_us(event_time)))
      / 3600000000.0 AS hours
  FROM clean WHERE event = 'transaction' GROUP BY visitorid)""",
        """
binned_rec AS (
  SELECT *, CASE WHEN hours <= 1 THEN '<1h' WHEN hours <= 6 THEN '1-6h'
    WHEN hours <= 12 THEN '6-12h' WHEN hours <= 24 THEN '12-24h' WHEN hours <= 48 THEN '1-2d'
    WHEN hours <= 72 THEN '2-3d' WHEN hours <= 168 THEN '3-7d' WHEN hours <= 336 THEN '1-2w'
    WHEN hours <= 720 THEN '2-4w' ELSE '>30d' END AS bin
  FROM rec)""",
        """
props AS (
  SELECT epoch_us(CAST(DATE '2024-01-01' + CAST(p_partkey % 30 AS INTEGER) AS TIMESTAMP))
      AS timestamp,
    p_partkey AS itemid, property, value
  FROM (
    SELECT p_partkey, 'categoryid' AS property,
      p_size || ' ' || (50 + CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER)) AS value
    FROM part
    UNION ALL SELECT p_partkey, 'brand', p_brand FROM part
    UNION ALL SELECT p_partkey, 'type', p_type FROM part))""",
        """
tree AS (
  SELECT CAST(categoryid AS BIGINT) AS categoryid,
    CAST(CASE WHEN categoryid <= 50 THEN 51 + categoryid % 25
      WHEN categoryid <= 75 THEN 76 + categoryid % 5 END AS BIGINT) AS parentid
  FROM (SELECT p_size AS categoryid FROM part
        UNION SELECT 51 + p_size % 25 FROM part
        UNION SELECT 76 + p_size % 5 FROM part))""",
        """
walk AS (
  SELECT categoryid, parentid AS up, 0 AS depth FROM tree
  UNION ALL
  SELECT w.categoryid, t.parentid, w.depth + 1
  FROM walk w LEFT JOIN tree t ON t.categoryid = w.up
  WHERE w.up IS NOT NULL)""",
        """
depths AS (SELECT categoryid, max(depth) AS depth FROM walk GROUP BY categoryid)""",
        """
icat AS (
  SELECT itemid, unnest(string_split(value, ' ')) AS categoryid FROM props
  WHERE property = 'categoryid')""",
        """
cpur AS (
  SELECT i.categoryid, count(DISTINCT i.itemid) AS items,
    count(*) FILTER (c.event = 'view') AS views,
    count(*) FILTER (c.event = 'transaction') AS transactions
  FROM clean c JOIN icat i ON i.itemid = c.itemid GROUP BY i.categoryid)""",
        """
cpar AS (
  SELECT cpur.*, CAST(coalesce(tree.parentid, CASE WHEN tree.categoryid IS NOT NULL
    THEN -1 END) AS VARCHAR) AS parentid
  FROM cpur LEFT JOIN tree ON CAST(tree.categoryid AS VARCHAR) = cpur.categoryid)""",
        """
fine AS (
  SELECT doc_id AS id, CAST(toxic AS BIGINT) AS y,
    (doc_id * 7919 % 1000 + 0.5::DOUBLE) / 1000.0::DOUBLE AS p FROM labels)""",
        """
coarse AS (
  SELECT doc_id AS id, CAST(toxic AS BIGINT) AS y,
    (doc_id * 7919 % 20) / 20.0::DOUBLE AS p FROM labels)""",
        """
both_models AS (
  SELECT 'fine' AS model, * FROM fine UNION ALL SELECT 'coarse', * FROM coarse)""",
        """
curve AS (
  SELECT model, p, pos, neg,
    sum(pos) OVER (PARTITION BY model ORDER BY p DESC) AS tp,
    sum(neg) OVER (PARTITION BY model ORDER BY p DESC) AS fp,
    sum(pos) OVER (PARTITION BY model) AS np, sum(neg) OVER (PARTITION BY model) AS nn
  FROM (SELECT model, p, sum(y) AS pos, sum(1 - y) AS neg FROM both_models
        GROUP BY model, p))""",
    ]
)

_BRONZE = (
    "epoch_us(event_time) AS event_time, visitorid, event, itemid, transactionid"
)
_RAW = "epoch_us(event_time) AS timestamp, visitorid, event, itemid, transactionid"
_GOLD = ", ".join(
    ["visitorid", "snapshot_day", *[_n(c, c) for c in _COUNTS], *[_r(c, c) for c in _RATES]]
)
_GOLD_KEYLESS = _GOLD.replace("snapshot_day, ", "", 1)
_TRAIN = f"{_GOLD}, CAST(purchase_next_7d AS BIGINT) AS purchase_next_7d"
_KEY = "visitorid, snapshot_day"

_LINEAR = (
    " + ".join([f"CAST({INTERCEPT} AS DOUBLE)", *[f"CAST({w} AS DOUBLE) * {c}" for c, w in WEIGHTS.items()]])
)


def _sigmoid(x: str) -> str:
    return f"1.0::DOUBLE / (1.0::DOUBLE + exp(-({x})))"


def _logit(p: str) -> str:
    clipped = f"greatest(1e-6::DOUBLE, least(1.0::DOUBLE - 1e-6::DOUBLE, {p}))"
    return f"ln({clipped} / (1.0::DOUBLE - {clipped}))"


def _calibrated(p: str) -> str:
    return _sigmoid(f"CAST({SLOPE} AS DOUBLE) * {_logit(p)} + CAST({OFFSET} AS DOUBLE)")


_FIXED_P = _calibrated(_sigmoid(_LINEAR))


def _describe(name: str, source: str, column: str, probs: list[tuple[str, float]]) -> str:
    c = f"CAST({column} AS DOUBLE)"
    quantiles = ", ".join(_r(f"quantile_cont({c}, {q})", label) for label, q in probs)
    return f"""SELECT '{name}' AS "column", count({column}) AS "count", {_r(f'avg({c})', 'mean')},
  {_r(f'stddev_samp({c})', 'std')}, {_r(f'min({c})', '"min"')}, {quantiles},
  {_r(f'max({c})', '"max"')} FROM {source}"""


_QUARTILES = [("p25", 0.25), ("p50", 0.5), ("p75", 0.75)]
_TAIL = [("p50", 0.5), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99), ("p99_9", 0.999)]


def _histogram(source: str, value: str, bins: int) -> str:
    return f"""
SELECT CAST(bin AS BIGINT) AS bin, {_r('any_value(lo) + bin * any_value(w)', 'bin_start')},
  {_r('any_value(lo) + (bin + 1) * any_value(w)', 'bin_end')}, count(*) AS n
FROM (SELECT lo, w, least(floor((v - lo) / w), {bins - 1}) AS bin
      FROM (SELECT CAST({value} AS DOUBLE) AS v, min(CAST({value} AS DOUBLE)) OVER () AS lo,
              (max(CAST({value} AS DOUBLE)) OVER () - min(CAST({value} AS DOUBLE)) OVER ())
                / {bins}.0::DOUBLE AS w
            FROM {source}))
GROUP BY bin"""


def _conversion(part: str = "transactions", whole: str = "views") -> str:
    return _r(f"{part} * 100.0::DOUBLE / nullif({whole}, 0)", "conversion_rate")


_PURCHASES = f"categoryid, items, views, transactions, {_conversion()}"
_FUNNEL = """
SELECT CAST(1 AS BIGINT) AS stage_no, 'View' AS stage,
  count(*) FILTER (view > 0) AS visitors FROM vis
UNION ALL SELECT 2, 'Add to Cart', count(*) FILTER (addtocart > 0) FROM vis
UNION ALL SELECT 3, 'Transaction', count(*) FILTER (transaction > 0) FROM vis"""

_THRESHOLDS = "0.01, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9"
_SHARES = "0.001, 0.005, 0.01, 0.02, 0.05, 0.1"


def _prediction_window(source: str) -> str:
    return f"""
SELECT visitorid, {_r(_FIXED_P, 'purchase_probability')} FROM {source}
WHERE snapshot_day = (SELECT max(snapshot_day) FROM {source})
  AND user_views_7d + user_addtocart_7d + user_transactions_30d >= 5"""


def _inference_over_window() -> str:
    """End to end: the same gold over the rows of the ingestion window only."""
    windowed = PRELUDE.replace(
        "WHERE event IN ('view', 'addtocart', 'transaction'))",
        "WHERE event IN ('view', 'addtocart', 'transaction')\n"
        f"    AND CAST(event_time AS DATE) >= (SELECT CAST(max(ts) AS DATE) - {LONG_WINDOW_DAYS} "
        "FROM events))",
        1,
    )
    return windowed + _prediction_window("gold")


_EVALUATED = """
SELECT model, round(sum(neg * (tp - pos / 2.0::DOUBLE)) / max(np) / max(nn), 6) AS roc_auc,
  round(sum(pos * CAST(tp AS DOUBLE) / (tp + fp)) / max(np), 6) AS pr_auc,
  round(sum(pos * (p - 1) * (p - 1) + neg * p * p) / (max(np) + max(nn)), 6) AS brier_score
FROM {} GROUP BY model"""

_CURVE_OF_TWO = f"""
SELECT model, p, pos, neg, sum(pos) OVER (PARTITION BY model ORDER BY p DESC) AS tp,
  sum(neg) OVER (PARTITION BY model ORDER BY p DESC) AS fp,
  sum(pos) OVER (PARTITION BY model) AS np, sum(neg) OVER (PARTITION BY model) AS nn
FROM (SELECT model, p, sum(y) AS pos, sum(1 - y) AS neg
      FROM (SELECT 'Raw' AS model, y, p FROM fine
            UNION ALL SELECT 'Calibrated', y, {_calibrated('p')} FROM fine)
      GROUP BY model, p)"""


def _body() -> dict[str, str]:
    durations = [(1, "0-1"), (2, "1-2"), (5, "2-5"), (10, "5-10"), (20, "10-20"), (30, "20-30"),
                 (60, "30-60"), (120, "60-120")]
    duration_bin = "CASE " + " ".join(
        f"WHEN exact_min <= {edge} THEN '{label}'" for edge, label in durations
    ) + " ELSE '>120' END"
    q: dict[str, str] = {}

    q["i01_read_raw_events"] = f"SELECT {_RAW} FROM m"
    q["i02_read_layer"] = f"SELECT {_BRONZE} FROM dirty"
    q["i03_reference_date"] = f"""
SELECT {_DAY.format('event_time')} AS reference_day, count(*) AS events FROM m
WHERE CAST(event_time AS DATE) = (SELECT CAST(max(event_time) AS DATE) FROM m) GROUP BY 1"""
    q["i04_feature_window"] = f"""
SELECT {_RAW} FROM m WHERE CAST(event_time AS DATE)
  >= (SELECT CAST(max(event_time) AS DATE) - {HISTORY_DAYS} FROM m)"""
    q["i05_cast_to_bronze"] = f"SELECT {_BRONZE} FROM m"
    q["i06_write_gold"] = f"SELECT {_GOLD} FROM gold"
    q["i07_write_silver"] = f"SELECT {_BRONZE}, _dq_error FROM dq"
    q["i08_convert_events"] = """
SELECT epoch_us(event_time) // 1000 * 1000 AS timestamp, visitorid, event, itemid, transactionid,
  strftime(event_time, '%Y-%m') AS year_month FROM m"""
    q["i09_convert_item_properties"] = "SELECT * FROM props"
    q["i10_convert_category_tree"] = "SELECT * FROM tree"
    q["i11_read_many_files"] = f"SELECT {_RAW} FROM m"
    q["i12_training_frame_save_load"] = f"SELECT {_TRAIN} FROM training"
    q["i13_monthly_volume"] = """
SELECT strftime(event_time, '%Y-%m') AS year_month, CAST(sum(n) AS BIGINT) AS rows_before,
  count(*) AS rows_after
FROM (SELECT event_time, visitorid, event, itemid, transactionid, count(*) AS n FROM dirty
      GROUP BY ALL) GROUP BY 1"""

    q["q01_dq_classify"] = f"SELECT {_BRONZE}, _dq_error FROM dq"
    q["q02_silver_quarantine_split"] = f"""
SELECT {_BRONZE}, _dq_error,
  CASE WHEN _dq_error IS NULL THEN 'silver' ELSE 'quarantine' END AS layer FROM dq"""
    q["q03_quality_metrics"] = """
SELECT count(*) AS total_rows, count(*) FILTER (_dq_error IS NULL) AS valid_rows,
  count(*) FILTER (_dq_error IS NOT NULL) AS quarantined_rows FROM dq"""
    q["q03_error_counts"] = 'SELECT _dq_error, count(*) AS "rows" FROM dq GROUP BY _dq_error'
    q["q04_drop_duplicates"] = f"SELECT {_BRONZE} FROM (SELECT DISTINCT * FROM dirty)"
    q["q05_duplicate_listing"] = f"""
SELECT {_BRONZE} FROM (SELECT *, count(*) OVER (
  PARTITION BY event_time, visitorid, event, itemid, transactionid) AS n FROM dirty)
WHERE n > 1"""
    q["q06_duplicates_by_event"] = """
SELECT event, count(*) AS "count" FROM (SELECT *, count(*) OVER (
  PARTITION BY event_time, visitorid, event, itemid, transactionid) AS n FROM dirty)
WHERE n > 1 GROUP BY event"""
    q["q07_missing_summary"] = """
SELECT "column", n AS "null", e AS empty_string, n + e AS total_missing,
  round((n + e) * 100.0::DOUBLE / total, 6) AS percent
FROM (""" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n, "
        + (f"count(*) FILTER (trim({c}) = '')" if c == "event" else "CAST(0 AS BIGINT)")
        + " AS e, count(*) AS total FROM dirty"
        for c in ["event_time", "visitorid", "event", "itemid", "transactionid"]
    ) + ") WHERE n + e > 0"
    q["q07_missing_summary_tree"] = """
SELECT 'parentid' AS "column", n AS "null", CAST(0 AS BIGINT) AS empty_string,
  n AS total_missing, round(n * 100.0::DOUBLE / total, 6) AS percent
FROM (SELECT count(*) FILTER (parentid IS NULL) AS n, count(*) AS total FROM tree) WHERE n > 0"""
    q["q08_missing_by_category"] = """
SELECT 'event' AS "column", event AS category, count(*) AS total_rows,
  count(*) FILTER (transactionid IS NULL) AS missing_rows,
  round_even(count(*) FILTER (transactionid IS NULL) / count(*)::DOUBLE * 100, 2)
    AS missing_percent
FROM dirty GROUP BY event
HAVING count(*) FILTER (transactionid IS NULL) / count(*)::DOUBLE * 100 >= 0.995"""
    none = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in ["mean", "std", '"min"', "p25", "p50", "p75", '"max"'])
    q["q09_describe"] = " UNION ALL BY NAME ".join(
        [
            f'SELECT *, CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS top, '
            f"CAST(NULL AS BIGINT) AS freq FROM ({_describe(c, 'dirty', c, _QUARTILES)})"
            for c in ["visitorid", "itemid", "transactionid"]
        ]
        + [
            f"""SELECT 'event' AS "column", CAST(sum(n) AS BIGINT) AS "count", {none},
  count(*) AS "unique", first(event ORDER BY n DESC, event) AS top, max(n) AS freq
FROM (SELECT event, count(*) AS n FROM dirty WHERE event IS NOT NULL GROUP BY event)"""
        ]
    )
    q["q10_id_statistics"] = " UNION ALL ".join(
        f"SELECT *, (SELECT count(DISTINCT {c}) FROM dirty) AS distinct_values "
        f"FROM ({_describe(c, 'dirty', c, _QUARTILES)})"
        for c in ["visitorid", "itemid"]
    )
    q["q11_time_range"] = """
SELECT epoch_us(min(event_time)) AS first_time, epoch_us(max(event_time)) AS last_time
FROM dirty"""
    q["q11_rows_per_date"] = f"""
SELECT {_DAY.format('event_time')} AS date, count(*) AS "count" FROM dirty
WHERE event_time IS NOT NULL GROUP BY 1"""
    q["q12_value_distribution"] = """
SELECT event, count(*) AS "count",
  round(count(*) / (SELECT count(*) FROM dirty)::DOUBLE * 100, 6) AS percent
FROM dirty GROUP BY event"""
    q["q13_integrality"] = """
SELECT CAST(coalesce(bool_and(parentid % 1 = 0), true) AS BIGINT) AS all_whole FROM tree"""
    q["q14_normalise_tree"] = "SELECT categoryid, coalesce(parentid, -1) AS parentid FROM tree"
    q["q15_root_rows"] = "SELECT * FROM tree WHERE parentid IS NULL"

    q["f01_snapshot_day"] = f"SELECT {_BRONZE}, snapshot_day FROM s"
    q["f02_snapshot_dates"] = "SELECT * FROM snaps"
    q["f03_daily_event_counts"] = "SELECT * FROM daily"
    q["f04_user_behavior"] = f"SELECT {_KEY}, {', '.join(_COUNTS[:3])} FROM gold"
    q["f05_session_boundaries"] = f"""
SELECT {_BRONZE}, epoch_us(prev) AS previous_event_time,
  epoch_us(event_time) - epoch_us(prev) AS time_diff,
  CAST(new_session AS BIGINT) AS new_session FROM flagged"""
    q["f06_session_id"] = f"""
SELECT {_BRONZE}, CAST(new_session AS BIGINT) AS new_session,
  CAST(session_id AS BIGINT) AS session_id FROM numbered"""
    q["f07_create_sessions"] = f"""
SELECT {_BRONZE}, CAST(sum(CASE WHEN prev IS NULL
    OR epoch_us(event_time) - epoch_us(prev) > 2700000000 THEN 1 ELSE 0 END)
  OVER (PARTITION BY visitorid ORDER BY event_time
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_id
FROM lagged"""
    q["f08_aggregate_sessions"] = f"""
SELECT visitorid, CAST(session_id AS BIGINT) AS session_id,
  epoch_us(session_start) AS session_start, epoch_us(session_end) AS session_end,
  {_r('whole_min', 'session_duration_min')} FROM sess"""
    q["f09_daily_session_stats"] = f"""
SELECT {_KEY}, {_r('exact_min', 'total_duration')}, sessions FROM sdaily"""
    q["f10_aligned_session_stats"] = f"""
SELECT n.visitorid, n.snapshot_day, {_r('coalesce(whole_min, 0)', 'total_duration')},
  coalesce(sessions, 0) AS sessions
FROM snaps n LEFT JOIN sdaily z
  ON z.visitorid = n.visitorid AND z.snapshot_day = n.snapshot_day"""
    session_columns = f"""{_KEY}, user_sessions_30d,
  {_r('avg_session_duration_30d', 'avg_session_duration_30d')}"""
    q["f11_rolling_session_features"] = f"SELECT {session_columns} FROM research"
    q["f12_session_features"] = f"SELECT {session_columns} FROM gold"
    q["f13_item_daily_transactions"] = "SELECT * FROM sold"
    q["f14_item_day_grid"] = "SELECT * FROM grid"
    q["f15_item_popularity"] = """
SELECT itemid, snapshot_day, p AS item_transactions_30d, CAST(1 AS BIGINT) AS items
FROM pop WHERE p > 0 UNION ALL
SELECT NULL, snapshot_day, 0, count(*) FILTER (p = 0) FROM pop GROUP BY snapshot_day"""
    q["f16_top_seller_threshold"] = "SELECT snapshot_day, t_disc AS top_10_threshold FROM thr"
    q["f16_top_seller_threshold_linear"] = f"""
SELECT snapshot_day, {_r('t_lin', 'top_10_threshold')} FROM thr"""
    q["f17_top_sellers"] = """
SELECT itemid, snapshot_day, CAST(1 AS BIGINT) AS items, p AS item_transactions_30d,
  t_disc AS top_10_threshold, CAST(top_disc AS BIGINT) AS is_top_seller FROM flags WHERE p > 0
UNION ALL
SELECT NULL, snapshot_day, count(*) FILTER (p = 0), 0, max(t_disc),
  CAST(0 >= max(t_disc) AS BIGINT) FROM flags GROUP BY snapshot_day"""
    q["f18_cart_events"] = """
SELECT visitorid, itemid, snapshot_day, p AS item_transactions_30d,
  CAST(top_disc AS BIGINT) AS is_top_seller FROM carts"""
    q["f19_daily_cart_stats"] = f"""
SELECT n.visitorid, n.snapshot_day, {_n('coalesce(pop, 0)', 'cart_item_popularity_sum')},
  coalesce(cart_n, 0) AS cart_count, {_n('coalesce(top, 0)', 'top_seller_cart_count')}
FROM snaps n LEFT JOIN cdisc c
  ON c.visitorid = n.visitorid AND c.snapshot_day = n.snapshot_day"""
    cart_columns = f"{_KEY}, {', '.join(_r(c, c) for c in _RATES[1:])}"
    q["f20_cart_features_linear"] = f"SELECT {cart_columns} FROM research"
    q["f21_popularity_features"] = f"SELECT {cart_columns} FROM gold"
    q["f22_gold"] = q["f22_gold_by_parts"] = f"SELECT {_GOLD} FROM gold"
    q["f23_daily_purchases"] = "SELECT * FROM bought"
    q["f24_purchase_target"] = """
SELECT d.*, CAST(CASE WHEN EXISTS (SELECT 1 FROM bought b WHERE b.visitorid = d.visitorid
    AND b.snapshot_day BETWEEN d.snapshot_day AND d.snapshot_day + 1) THEN 1 ELSE 0 END
  AS BIGINT) AS purchase_next_2d FROM daily d"""
    q["f24_training_frame"] = f"SELECT {_TRAIN} FROM training"

    q["x01_visitor_events"] = "SELECT * FROM vis"
    q["x02_item_events"] = "SELECT * FROM itm"
    q["x03_heavy_tail_describe"] = " UNION ALL ".join(
        _describe(c, "vis", c, _TAIL) for c in ["view", "addtocart", "transaction"]
    )
    q["x04_event_ratios"] = """
SELECT round(t * 100.0::DOUBLE / v, 6) AS view_to_transaction_pct,
  round(a * 100.0::DOUBLE / v, 6) AS view_to_cart_pct,
  round(t * 100.0::DOUBLE / a, 6) AS cart_to_transaction_pct
FROM (SELECT count(*) FILTER (event = 'view') AS v, count(*) FILTER (event = 'addtocart') AS a,
        count(*) FILTER (event = 'transaction') AS t FROM clean)"""

    def pareto(source: str, entity: str, name: str) -> str:
        return f"""
SELECT {entity}, transaction, "rank", CAST(cum AS BIGINT) AS cum_transaction,
  round(cum / total::DOUBLE, 6) AS cum_transaction_pct,
  round("rank" / n::DOUBLE, 6) AS cum_{name}_pct
FROM (SELECT {entity}, transaction,
        row_number() OVER (ORDER BY transaction DESC, {entity}) AS "rank",
        sum(transaction) OVER (ORDER BY transaction DESC, {entity}
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
        sum(transaction) OVER () AS total, count(*) OVER () AS n FROM {source})"""

    q["x05_pareto_visitors"] = pareto("vis", "visitorid", "visitors")
    q["x05_pareto_point_items"] = f"""
SELECT cum_transaction_pct, cum_items_pct FROM ({pareto('itm', 'itemid', 'items')})
WHERE cum_transaction_pct >= 0.8 ORDER BY "rank" LIMIT 1"""
    q["x05_pareto_items"] = pareto("itm", "itemid", "items")
    q["x05_pareto_point_visitors"] = f"""
SELECT cum_transaction_pct, cum_visitors_pct FROM ({pareto('vis', 'visitorid', 'visitors')})
WHERE cum_transaction_pct >= 0.8 ORDER BY "rank" LIMIT 1"""
    q["x06_top_visitors"] = "SELECT * FROM vis ORDER BY transaction DESC, visitorid LIMIT 30"
    q["x06_top_items"] = "SELECT * FROM itm ORDER BY transaction DESC, itemid LIMIT 20"
    q["x07_monthly_events"] = """
SELECT strftime(event_time, '%Y-%m') AS month, event, count(*) AS "count" FROM clean
GROUP BY 1, 2"""
    q["x07_monthly_events_without_views"] = """
SELECT strftime(event_time, '%Y-%m') AS month, event, count(*) AS "count" FROM clean
WHERE event <> 'view' GROUP BY 1, 2"""
    q["x08_daily_transactions"] = f"""
SELECT {_DAY.format('event_time')} AS date, count(*) AS transactions FROM clean
WHERE event = 'transaction' GROUP BY 1"""
    q["x08_daily_transactions_before"] = f"""
SELECT {_DAY.format('event_time')} AS date, count(*) AS transactions FROM clean
WHERE event = 'transaction' AND event_time < DATE '2024-01-15' GROUP BY 1"""
    pivot = """count(*) FILTER (event = 'view') AS view,
  count(*) FILTER (event = 'addtocart') AS addtocart,
  count(*) FILTER (event = 'transaction') AS transaction"""
    q["x09_weekday_events"] = f"""
SELECT CAST(isodow(event_time) - 1 AS BIGINT) AS weekday_no, dayname(event_time) AS weekday,
  {pivot} FROM clean GROUP BY 1, 2"""
    q["x10_hourly_events"] = f"""
SELECT CAST(hour(event_time) AS BIGINT) AS "hour", {pivot} FROM clean GROUP BY 1"""
    q["x11_visitor_funnel"] = _FUNNEL
    q["x11_item_funnel"] = _FUNNEL.replace("visitors", "items").replace("FROM vis", "FROM itm")
    q["x12_property_as_of"] = """
SELECT itemid, property, timestamp, value FROM (
  SELECT *, row_number() OVER (PARTITION BY itemid, property
    ORDER BY timestamp DESC, value DESC) AS i
  FROM props WHERE timestamp < epoch_us(TIMESTAMP '2024-01-16')) WHERE i = 1"""
    q["x12_property_as_of_snapshots"] = """
SELECT a.itemid, a.snapshot_day, a.property, r.timestamp, r.value
FROM (SELECT DISTINCT itemid, CAST(snapshot_day AS BIGINT) AS snapshot_day, property,
        CAST(snapshot_day AS BIGINT) * 86400000000 AS day_start
      FROM s, (SELECT unnest(['categoryid', 'brand', 'type']) AS property)) a
ASOF LEFT JOIN props r
  ON a.itemid = r.itemid AND a.property = r.property AND a.day_start > r.timestamp"""
    q["x13_conversion_rates"] = """
SELECT transition, round(part * 100.0::DOUBLE / whole, 6) AS conversion_rate FROM (
  SELECT count(*) FILTER (view > 0) AS v, count(*) FILTER (addtocart > 0) AS a,
    count(*) FILTER (transaction > 0) AS t FROM vis) c,
LATERAL (VALUES ('View → Add to Cart', a, v), ('Add to Cart → Transaction', t, a),
  ('View → Transaction', t, v)) r(transition, part, whole)"""
    q["x13_item_conversion_rates"] = q["x13_conversion_rates"].replace("FROM vis", "FROM itm")
    q["x14_session_summary"] = f"""
SELECT visitorid, CAST(session_id AS BIGINT) AS session_id, epoch_us(session_start) AS start,
  epoch_us(session_end) AS "end", events, transactions, {_r('exact_min', 'duration_minutes')},
  CAST(transactions > 0 AS BIGINT) AS has_transaction FROM sess"""
    q["x15_session_conversion"] = f"""
SELECT bin, sessions, transactions,
  round_even(transactions / sessions::DOUBLE * 100, 2) AS conversion_rate_pct,
  round_even(sessions / (sum(sessions) OVER ())::DOUBLE * 100, 2) AS share_pct
FROM (SELECT {duration_bin} AS bin, count(*) AS sessions,
        count(*) FILTER (transactions > 0) AS transactions FROM sess GROUP BY 1)"""
    q["x16_recency"] = f"SELECT visitorid, {_r('hours', 'hours_since_last_event')} FROM rec"
    q["x17_purchase_recency"] = f"""
SELECT visitorid, {_r('hours', 'hours_since_last_purchase')} FROM prec"""
    q["x18_visitor_recency"] = f"""
SELECT visitorid, {_r('hours', 'hours_since_last_event')}, transaction,
  CAST(transaction > 0 AS BIGINT) AS has_transaction FROM rec"""
    q["x18_recency_conversion"] = """
SELECT bin, visitors, purchasers,
  round_even(purchasers / visitors::DOUBLE * 100, 2) AS conversion_rate_pct,
  round_even(visitors / (sum(visitors) OVER ())::DOUBLE * 100, 2) AS share_pct
FROM (SELECT bin, count(*) AS visitors, count(*) FILTER (transaction > 0) AS purchasers
      FROM binned_rec GROUP BY bin)"""
    q["x19_recency_transactions"] = """
SELECT bin, count(*) AS visitors, CAST(sum(transaction) AS BIGINT) AS transactions,
  round(sum(transaction) / count(*)::DOUBLE, 6) AS transactions_per_visitor
FROM binned_rec GROUP BY bin"""
    q["x20_histogram_purchase_recency"] = _histogram("prec", "hours", 50)
    q["x20_histogram_views"] = _histogram("vis", "view", 100)
    q["x20_histogram_carts"] = _histogram("vis", "addtocart", 50)
    q["x20_histogram_transactions"] = _histogram("vis", '"transaction"', 50)
    q["x20_histogram_session_length"] = _histogram("sess", "events", 20)
    q["x21_property_frequency"] = """
SELECT property, count(*) AS "count" FROM props GROUP BY property
ORDER BY "count" DESC, property LIMIT 30"""
    q["x22_property_history"] = 'SELECT itemid, count(*) AS records FROM props GROUP BY itemid'
    q["x22_describe_property_history"] = _describe(
        "records", "(SELECT count(*) AS records FROM props GROUP BY itemid)", "records", _QUARTILES
    )
    q["x23_root_and_child_counts"] = """
SELECT count(*) FILTER (parentid IS NULL) AS root_categories,
  count(*) FILTER (parentid IS NOT NULL) AS child_categories FROM tree"""
    q["x23_children_per_parent"] = """
SELECT coalesce(parentid, -1) AS parentid, count(*) AS "count" FROM tree GROUP BY 1
ORDER BY "count" DESC, parentid LIMIT 20"""
    q["x24_category_depth"] = "SELECT categoryid, CAST(depth AS BIGINT) AS depth FROM depths"
    q["x25_depth_distribution"] = """
SELECT CAST(depth AS BIGINT) AS depth, count(*) AS "count" FROM depths GROUP BY depth"""
    q["x26_item_categories"] = "SELECT * FROM icat"
    q["x27_category_events"] = """
SELECT i.itemid, epoch_us(event_time) AS event_time, visitorid, event, categoryid
FROM clean c JOIN icat i ON i.itemid = c.itemid"""
    q["x28_items_per_category"] = """
SELECT categoryid, count(DISTINCT itemid) AS items FROM icat GROUP BY categoryid"""
    q["x29_category_purchases"] = f"SELECT {_PURCHASES} FROM cpur"
    q["x30_best_converting_categories"] = f"""
SELECT {_PURCHASES} FROM cpur WHERE views >= 100
ORDER BY transactions * 100.0::DOUBLE / views DESC, categoryid LIMIT 20"""
    q["x31_category_parent_lookup"] = f"SELECT {_PURCHASES}, parentid FROM cpar"
    q["x32_parent_purchases"] = f"""
SELECT parentid, categories, items, views, transactions, {_conversion()} FROM (
  SELECT parentid, count(DISTINCT categoryid) AS categories, {_n('sum(items)', 'items')},
    {_n('sum(views)', 'views')}, {_n('sum(transactions)', 'transactions')}
  FROM cpar WHERE parentid IS NOT NULL GROUP BY parentid)"""

    q["m01_interaction_filter"] = f"SELECT {_TRAIN} FROM active"
    q["m02_temporal_boundaries"] = f"SELECT {_TRAIN} FROM prepared"
    q["m03_chronological_split"] = f"SELECT {_KEY}, split FROM parts"
    q["m04_split_report"] = f"""
SELECT split, min(snapshot_day) AS first_day, max(snapshot_day) AS last_day,
  count(*) AS "rows", {_n('sum(purchase_next_7d)', 'positives')},
  {_n('sum(1 - purchase_next_7d)', 'negatives')},
  {_r('avg(purchase_next_7d)', 'positive_rate')},
  {_r('avg(1 - purchase_next_7d)', 'negative_rate')} FROM parts GROUP BY split"""
    scaled = ", ".join(
        _r(
            f"(CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) / "
            f"CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) OVER () > 0 "
            f"THEN stddev_pop(CAST({c} AS DOUBLE)) OVER () ELSE 1.0 END",
            c,
        )
        for c in FEATURES
    )
    q["m05_standardise"] = f"SELECT {_KEY}, {scaled} FROM prepared"
    q["m06_class_weights"] = """
SELECT CAST(purchase_next_7d AS BIGINT) AS purchase_next_7d, count(*) AS "rows",
  round((SELECT count(*) FROM prepared) / (2.0::DOUBLE * count(*)), 6) AS weight
FROM prepared GROUP BY 1"""
    q["m10_expanding_folds"] = f"""
SELECT {_KEY}, CAST(greatest(3 - (n - i) // (n // 4), 0) AS BIGINT) AS fold
FROM (SELECT *, row_number() OVER (ORDER BY snapshot_day, visitorid) AS i,
        count(*) OVER () AS n FROM prepared)"""
    q["m13_development_set"] = f"""
SELECT {_KEY}, {_n('purchase_next_7d', 'purchase_next_7d')} FROM parts
WHERE split IN ('train', 'validation')"""
    terms = ", ".join(f"('slope {k}')" for k in range(len(MODEL_FEATURES)))
    q["m07_logistic_regression"] = f"""
SELECT term, (SELECT count(*) FROM parts WHERE split = 'train') AS "rows", 0.0::DOUBLE AS "left"
FROM (VALUES {terms}, ('intercept')) t(term)"""

    def both(*splits: str) -> str:
        """1 if the label has both values there, without which nothing can be learned."""
        listed = ", ".join(f"'{x}'" for x in splits)
        return (
            "(SELECT CAST(min(purchase_next_7d) < max(purchase_next_7d) AS BIGINT) FROM parts "
            f"WHERE split IN ({listed}))"
        )

    q["m08_random_forest"] = q["m09_boosted_trees"] = f"""
SELECT {_KEY}, {_n('purchase_next_7d', 'purchase_next_7d')}, CAST(1 AS BIGINT) AS inside,
  {both('train')} AS varies, {both('train')} AS learns
FROM parts WHERE split = 'validation'"""
    q["m11_randomised_search"] = """
SELECT i AS place, 'logistic' AS family, CAST(1 AS BIGINT) AS falls, CAST(15 AS BIGINT) AS different
FROM range(1, 16) r(i)"""
    names = ", ".join(f"('{name}')" for name in CANDIDATES)
    q["m12_compare_models"] = f"""
SELECT model, CAST(1 AS BIGINT) AS falls, CAST({len(CANDIDATES)} AS BIGINT) AS different,
  CAST(1 AS BIGINT) AS winner_is_first
FROM (VALUES {names}) t(model)"""
    developed = """(SELECT *, CAST(greatest(3 - (n - i) // (n // 4), 0) AS BIGINT) AS fold
  FROM (SELECT *, row_number() OVER (ORDER BY snapshot_day, visitorid) AS i,
          count(*) OVER () AS n FROM parts WHERE split IN ('train', 'validation')))"""
    q["m14_oof_predictions"] = f"""
SELECT {_KEY}, fold, {_n('purchase_next_7d', 'purchase_next_7d')}, CAST(1 AS BIGINT) AS inside,
  (SELECT CAST(min(purchase_next_7d) < max(purchase_next_7d) AS BIGINT) FROM {developed}
   WHERE fold < 3) AS varies
FROM {developed} WHERE fold > 0"""
    q["m16_platt_calibrator"] = f"""
SELECT term, (SELECT count(*) FROM {developed} WHERE fold > 0) AS "rows", 0.0::DOUBLE AS "left"
FROM (VALUES ('slope 0'), ('intercept')) t(term)"""
    q["m18_final_refit"] = q["m21_composite_scorer"] = f"""
SELECT {_KEY}, CAST(1 AS BIGINT) AS inside, {both('train', 'validation')} AS varies
FROM parts WHERE split = 'test'"""
    q["m19_permutation_importance"] = " UNION ALL ".join(
        f"""
SELECT CAST(k AS BIGINT) AS repeat, '{c}' AS feature, count({c}) AS "rows",
  {_r(f'sum(CAST({c} AS DOUBLE))', 'total')}, {_r(f'max(CAST({c} AS DOUBLE))', 'largest')},
  CAST(min({c}) < max({c}) AS BIGINT) AS moved
FROM parts, range(5) r(k) WHERE split = 'validation' GROUP BY k"""
        for c in MODEL_FEATURES
    )
    q["m11_search_equations"] = """
SELECT CAST(k AS BIGINT) AS draw, CAST(f AS BIGINT) AS fold, count(*) AS "rows",
  count(*) FILTER (purchase_next_7d = 1) AS positives, 0.0::DOUBLE AS "left"
FROM (SELECT *, greatest(3 - (n - i) // (n // 4), 0) AS own
      FROM (SELECT *, row_number() OVER (ORDER BY snapshot_day, visitorid) AS i,
              count(*) OVER () AS n FROM parts WHERE split = 'train')),
  range(15) d(k), range(1, 4) u(f)
WHERE own < f GROUP BY k, f"""
    q["m22_reload_equivalence"] = """
SELECT count(*) AS "rows", 0.0::DOUBLE AS max_difference, CAST(1 AS BIGINT) AS all_close
FROM parts WHERE split = 'test'"""
    q["m15_logit"] = f"SELECT id, y, {_r('p', 'p')}, {_r(_logit('p'), 'logit')} FROM fine"
    q["m17_calibrate_probability"] = f"""
SELECT id, {_r('p', 'p')}, {_r(_calibrated('p'), 'calibrated')} FROM fine"""
    q["m20_ranked_predictions_fixed"] = f"""
SELECT {_KEY}, {_r(_FIXED_P, 'purchase_probability')} FROM parts WHERE split = 'test'"""
    q["m23_features_and_label"] = f"SELECT {_TRAIN}, split FROM parts"

    evaluated = _EVALUATED.format("curve")
    q["e01_roc_auc"] = f"SELECT model, roc_auc FROM ({evaluated})"
    q["e02_average_precision"] = f"SELECT model, pr_auc FROM ({evaluated})"
    q["e03_brier_score"] = "SELECT round(avg((p - y) * (p - y)), 6) AS brier_score FROM fine"
    q["e04_threshold_analysis"] = f"""
SELECT round(t, 6) AS threshold,
  round(coalesce(hits / nullif(predicted, 0)::DOUBLE, 0.0), 6) AS precision,
  round(coalesce(hits / nullif(positives, 0)::DOUBLE, 0.0), 6) AS recall,
  round(predicted / n::DOUBLE, 6) AS predicted_positive_rate
FROM (SELECT t, count(*) FILTER (p >= t AND y = 1) AS hits, count(*) FILTER (p >= t) AS predicted,
        sum(y) AS positives, count(*) AS n
      FROM fine, (SELECT CAST(unnest([{_THRESHOLDS}]) AS DOUBLE) AS t) GROUP BY t)"""
    q["e05_ranking_analysis"] = f"""
SELECT round(k, 6) AS top_k, CAST("rank" AS BIGINT) AS n_users,
  round(hits / "rank"::DOUBLE, 6) AS precision_at_k,
  round(coalesce(hits / nullif(total, 0)::DOUBLE, 0.0), 6) AS recall_at_k,
  round(hits / "rank"::DOUBLE / nullif(total / n::DOUBLE, 0), 6) AS lift_at_k
FROM (SELECT row_number() OVER (ORDER BY p DESC, id) AS "rank",
        sum(y) OVER (ORDER BY p DESC, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
          AS hits, sum(y) OVER () AS total, count(*) OVER () AS n FROM coarse)
JOIN (SELECT CAST(unnest([{_SHARES}]) AS DOUBLE) AS k)
  ON "rank" = greatest(1, ceil(n * k))"""
    q["e06_roc_points"] = """
SELECT model, round(p, 6) AS threshold, round(fp / nn::DOUBLE, 6) AS fpr,
  round(tp / np::DOUBLE, 6) AS tpr
FROM (SELECT *, lag(p) OVER o IS NULL OR lead(p) OVER o IS NULL OR lead(pos) OVER o <> pos
        OR lead(neg) OVER o <> neg AS turns
      FROM curve WINDOW o AS (PARTITION BY model ORDER BY p DESC)) WHERE turns
UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE FROM curve"""
    q["e07_precision_recall_points"] = """
SELECT model, round(p, 6) AS threshold, round(tp / (tp + fp)::DOUBLE, 6) AS precision,
  round(tp / np::DOUBLE, 6) AS recall, round(np / (np + nn)::DOUBLE, 6) AS baseline FROM curve
UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 1.0::DOUBLE, 0.0::DOUBLE,
  round(np / (np + nn)::DOUBLE, 6) FROM curve"""
    inner = ", ".join(str(i / 10) for i in range(1, 10))
    q["e08_calibration_points"] = f"""
SELECT CAST(bin AS BIGINT) AS bin, round(avg(p), 6) AS mean_predicted,
  round(avg(y), 6) AS observed_rate, count(*) AS "rows"
FROM (SELECT y, p, len(list_filter(edges, lambda e: e < p)) AS bin
      FROM fine, (SELECT quantile_cont(p, [{inner}]) AS edges FROM fine)) GROUP BY bin"""
    q["e09_raw_vs_calibrated"] = _EVALUATED.format(f"({_CURVE_OF_TWO})")
    inference = """
WHERE snapshot_day = (SELECT max(snapshot_day) FROM gold)
  AND user_views_7d + user_addtocart_7d + user_transactions_30d >= 5"""
    q["p01_prepare_inference_data"] = f"SELECT {_GOLD_KEYLESS} FROM gold {inference}"
    q["p02_fix_types"] = f"SELECT {_GOLD} FROM gold"
    q["p03_predict_trained"] = f"SELECT visitorid, CAST(1 AS BIGINT) AS inside, {both('train', 'validation')} AS varies FROM gold {inference}"
    q["p03_predict_fixed"] = q["p04_write_predictions"] = _prediction_window("gold")
    return q


def build() -> dict[str, str]:
    sql = {name: f"{PRELUDE}\n{body}" for name, body in _body().items()}
    sql["p05_end_to_end"] = sql["p05_end_to_end_in_memory"] = _inference_over_window()
    return sql
