"""SQL counterparts of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from bidtide.plans import oracle_fit

_BASE = """
requests AS (
  SELECT CAST(event_id AS VARCHAR) AS request_id, epoch_us(ts) // 1000 AS timestamp_ts, 'u_' || user_id AS user_id,
         (['Windows','Linux','Android','ChromeOS'])[user_id % 4 + 1] AS os,
         (['Lifestyle','Tech','Music','Tech','Outdoors'])[event_id % 5 + 1] AS site_category,
         make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts
  FROM events),
wins AS (
  SELECT CAST(event_id AS VARCHAR) AS request_id, 'camp_' || (event_id % 7) AS campaign_id, value AS win_price,
         event_id, make_timestamp(((epoch_us(ts) // 1000) + event_id * 37 % 6000) * 1000) AS ts
  FROM events WHERE event_id % 10 < 6),
clicks AS (
  SELECT w.request_id, 'click' AS user_action, w.ts + to_milliseconds(w.event_id * 53 % 13000 + x.extra) AS ts
  FROM wins w JOIN (VALUES (0), (1)) AS x(extra)
    ON w.event_id % 3 = 0 AND (x.extra = 0 OR w.event_id % 30 = 0)),
matched AS (
  SELECT w.request_id, r.user_id, r.os, r.site_category, w.campaign_id, w.win_price, w.ts AS event_time
  FROM wins w JOIN requests r ON w.request_id = r.request_id AND w.ts BETWEEN r.ts AND r.ts + INTERVAL 5 SECOND),
impressions AS (
  SELECT m.request_id, m.user_id, m.os, m.site_category, m.campaign_id, m.win_price,
         CAST(CASE WHEN c.user_action IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS is_clicked, m.event_time
  FROM matched m LEFT JOIN clicks c
    ON m.request_id = c.request_id AND c.ts BETWEEN m.event_time AND m.event_time + INTERVAL 11 SECOND)
"""

_PROFILE_COLUMNS = """
  CAST({agg} AS BIGINT) AS total_views,
  CAST(SUM(CASE WHEN site_category = 'Tech' THEN 1 ELSE 0 END){over} AS BIGINT) AS tech_views,
  CAST(SUM(CASE WHEN site_category = 'Tech' THEN is_clicked ELSE 0 END){over} AS BIGINT) AS tech_clicks,
  CAST(SUM(CASE WHEN site_category = 'Lifestyle' THEN 1 ELSE 0 END){over} AS BIGINT) AS lifestyle_views,
  CAST(SUM(CASE WHEN site_category = 'Lifestyle' THEN is_clicked ELSE 0 END){over} AS BIGINT) AS lifestyle_clicks
"""

_CHANGELOG = (
    "changelog AS (SELECT DISTINCT user_id,"
    + _PROFILE_COLUMNS.format(agg="COUNT(*) OVER w", over=" OVER w")
    + ", event_time AS update_time FROM impressions WINDOW w AS (PARTITION BY user_id ORDER BY event_time"
    " RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"
)

_PROFILES = (
    "SELECT user_id,"
    + _PROFILE_COLUMNS.format(agg="COUNT(*)", over="")
    + ", MAX(event_time) AS update_time FROM impressions GROUP BY user_id"
)

_REQUEST_LOOKUP = """
request_lookup AS (
  SELECT r.request_id, r.user_id, r.os, r.site_category, r.ts, p.total_views, p.tech_views, p.lifestyle_views
  FROM requests r ASOF LEFT JOIN changelog p ON r.user_id = p.user_id AND r.ts >= p.update_time)
"""

_IMPRESSION_LOOKUP = """
SELECT i.request_id, i.user_id, i.os, i.site_category, i.is_clicked, i.event_time,
       p.total_views, p.tech_views, p.lifestyle_views
FROM impressions i ASOF LEFT JOIN changelog p ON i.user_id = p.user_id AND i.event_time {op} p.update_time
"""

_HISTORY = """
history AS (
  SELECT *, CAST(ROW_NUMBER() OVER w - 1 AS BIGINT) AS user_total_views,
         CAST(COALESCE(SUM(CASE WHEN site_category = 'Tech' THEN 1 ELSE 0 END) OVER b, 0) AS BIGINT) AS user_tech_views,
         CAST(COALESCE(SUM(CASE WHEN site_category = 'Lifestyle' THEN 1 ELSE 0 END) OVER b, 0) AS BIGINT)
           AS user_lifestyle_views
  FROM impressions
  WINDOW w AS (PARTITION BY user_id ORDER BY event_time, request_id),
         b AS (PARTITION BY user_id ORDER BY event_time, request_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
history_shares AS (
  SELECT *, CAST(user_tech_views AS DOUBLE) / CASE WHEN user_total_views = 0 THEN 1 ELSE user_total_views END AS frac_tech,
         CAST(user_lifestyle_views AS DOUBLE) / CASE WHEN user_total_views = 0 THEN 1 ELSE user_total_views END
           AS frac_lifestyle
  FROM history)
"""

_SERVING_SHARES = """
serving AS (
  SELECT *,
    CASE WHEN total_views IS NULL OR total_views = 0 THEN 0.0::DOUBLE
         ELSE CAST(tech_views AS DOUBLE) / CAST(total_views AS DOUBLE) END AS frac_tech,
    CASE WHEN total_views IS NULL OR total_views = 0 THEN 0.0::DOUBLE
         ELSE CAST(lifestyle_views AS DOUBLE) / CAST(total_views AS DOUBLE) END AS frac_lifestyle
  FROM request_lookup)
"""

_SCORE = """1.0::DOUBLE / (1.0::DOUBLE + exp(-(-1.25::DOUBLE + frac_tech * 1.5::DOUBLE + frac_lifestyle * -0.75::DOUBLE
  + CASE os WHEN 'ChromeOS' THEN 0.2::DOUBLE WHEN 'Linux' THEN -0.1::DOUBLE WHEN 'Windows' THEN 0.35::DOUBLE ELSE 0.0::DOUBLE END
  + CASE site_category WHEN 'Music' THEN -0.4::DOUBLE WHEN 'Outdoors' THEN 0.15::DOUBLE WHEN 'Tech' THEN 0.6::DOUBLE
    ELSE 0.0::DOUBLE END)))"""

_IN_TRAIN = "CAST('0x' || substr(md5(request_id || ':42'), 1, 8) AS BIGINT) % 10 < 7"

_SCORED_TEST = f"""
scored AS (SELECT is_clicked AS label, round({_SCORE}, 9) AS score FROM history_shares WHERE NOT ({_IN_TRAIN})),
predicted AS (SELECT *, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction FROM scored)
"""

_ONE_HOT = ", ".join(
    f"CASE WHEN {c} = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"{c}_{v}\""
    for c, v in [("os", "ChromeOS"), ("os", "Linux"), ("os", "Windows"),
                 ("site_category", "Music"), ("site_category", "Outdoors"), ("site_category", "Tech")]
)

_MESSAGES = """
messages AS (
  SELECT '{"ride_id":' || event_id || ',"pickup":"' || event_type || '"' ||
    CASE event_id % 50
      WHEN 0 THEN ',"fare":' || value
      WHEN 1 THEN ',"fare":null}'
      WHEN 2 THEN '}'
      WHEN 3 THEN ',"fare":"' || value || '"}'
      WHEN 4 THEN ',"fare":' || value || ',"note":{"k":[1,"x"]}}'
      ELSE ',"fare":' || value || '}' END AS value
  FROM events),
judged AS (
  SELECT value,
    CASE WHEN NOT json_valid(value) THEN 'not JSON'
         WHEN json_type(value) <> 'OBJECT' THEN 'not an object'
         WHEN json_type(value, '$.fare') IN ('VARCHAR') THEN 'fare is not a number' END AS reason
  FROM messages),
good AS (
  SELECT CAST(json_extract_string(value, '$.ride_id') AS BIGINT) AS ride_id,
         json_extract_string(value, '$.pickup') AS pickup,
         CAST(json_extract_string(value, '$.fare') AS DOUBLE) AS fare,
         json_extract_string(value, '$.note.k[1]') AS note_entry
  FROM judged WHERE reason IS NULL)
"""


def _category(fare: str) -> str:
    return f"CASE WHEN {fare} < 10 THEN 'cheap' WHEN {fare} < 15 THEN 'medium' ELSE 'expensive' END AS fare_category"


def _with(*ctes_and_query: str) -> str:
    *ctes, query = ctes_and_query
    return "WITH " + ",".join(ctes) + query


_UPSERTS = """
changes AS (
  SELECT 'u_' || user_id AS user_id, event_id AS total_views, event_id % 7 AS tech_views, event_id % 5 AS lifestyle_views,
         event_id % 12 = 9 AS deleted, make_timestamp((epoch_us(ts) // 1000) * 1000) AS update_time
  FROM events WHERE event_id % 3 = 0)
"""

_QUIET = """
SELECT m.request_id, m.user_id, m.os, m.site_category, m.campaign_id, m.win_price,
       CAST(CASE WHEN c.user_action IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS is_clicked, m.event_time
FROM (SELECT * FROM matched WHERE event_time < TIMESTAMP '2024-01-16') m
LEFT JOIN (SELECT * FROM clicks WHERE ts < TIMESTAMP '2024-01-24') c
  ON m.request_id = c.request_id AND c.ts BETWEEN m.event_time AND m.event_time + INTERVAL 11 SECOND
"""

_IMPRESSIONS = _with(_BASE, " SELECT * FROM impressions")
_FARE_TOTALS = "SELECT event_type AS pickup, round(SUM(value), 4) AS total FROM events GROUP BY event_type"
_USER_PROFILES = _with(_BASE, " " + _PROFILES)
_USER_CHANGELOG = _with(_BASE, _CHANGELOG, " SELECT * FROM changelog")
_SCORED_REQUESTS = _with(
    _BASE, _CHANGELOG, _REQUEST_LOOKUP, _SERVING_SHARES, f" SELECT request_id, round({_SCORE}, 9) AS ctr_score FROM serving"
)
_TOLERANT = _with(
    _MESSAGES, f" SELECT ride_id, pickup, fare, {_category('COALESCE(fare, 0)')}, note_entry FROM good"
)

_REPORT = """
, cells AS (
  SELECT CAST(COUNT(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) AS tp,
         CAST(COUNT(*) FILTER (label = 0 AND prediction = 1) AS DOUBLE) AS fp,
         CAST(COUNT(*) FILTER (label = 1 AND prediction = 0) AS DOUBLE) AS fn,
         CAST(COUNT(*) FILTER (label = 0 AND prediction = 0) AS DOUBLE) AS tn FROM predicted),
rates AS (
  SELECT *, tn + fp AS n0, tp + fn AS n1,
    CASE WHEN tn + fn = 0 THEN 0 ELSE tn / (tn + fn) END AS p0, CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END AS r0,
    CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p1, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS r1
  FROM cells),
scores AS (
  SELECT *, CASE WHEN p0 + r0 = 0 THEN 0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f0,
            CASE WHEN p1 + r1 = 0 THEN 0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1 FROM rates),
lines AS (
  SELECT '0' AS label, p0 AS precision, r0 AS recall, f0 AS f1_score, n0 AS support FROM scores
  UNION ALL SELECT '1', p1, r1, f1, n1 FROM scores
  UNION ALL SELECT 'accuracy', NULL, NULL, (tp + tn) / (n0 + n1), n0 + n1 FROM scores
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n0 + n1 FROM scores
  UNION ALL SELECT 'weighted avg', (p0 * n0 + p1 * n1) / (n0 + n1), (r0 * n0 + r1 * n1) / (n0 + n1),
                   (f0 * n0 + f1 * n1) / (n0 + n1), n0 + n1 FROM scores)
SELECT label, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1_score, 9) AS f1_score,
       CAST(support AS BIGINT) AS support FROM lines
"""

_AUC = """
, by_score AS (
  SELECT score, SUM(label) AS pos, COUNT(*) - SUM(label) AS neg FROM scored GROUP BY score),
ranked AS (
  SELECT *, COALESCE(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM by_score)
SELECT round(SUM(pos * (below + CAST(neg AS DOUBLE) / 2)) / (CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)), 9) AS roc_auc,
       CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives FROM ranked
"""

_LOOKUP = """
lookup AS (
  SELECT i.event_time, i.user_id, i.os, i.site_category, i.is_clicked,
    CASE WHEN COALESCE(p.total_views, 0) = 0 THEN 0.0::DOUBLE
         ELSE CAST(p.tech_views AS DOUBLE) / CAST(p.total_views AS DOUBLE) END AS frac_tech,
    CASE WHEN COALESCE(p.total_views, 0) = 0 THEN 0.0::DOUBLE
         ELSE CAST(p.lifestyle_views AS DOUBLE) / CAST(p.total_views AS DOUBLE) END AS frac_lifestyle
  FROM impressions i ASOF LEFT JOIN changelog p ON i.user_id = p.user_id AND i.event_time >= p.update_time)
"""

_ONE_HOT_NAMES = ["os_ChromeOS", "os_Linux", "os_Windows", "site_category_Music", "site_category_Outdoors", "site_category_Tech"]
_WITH_HISTORY = ["frac_tech", "frac_lifestyle", *_ONE_HOT_NAMES]
_EXAMPLES_PER_STEP = 1000
_EXAMPLE_ORDER = "event_time, user_id, os, site_category, frac_tech, frac_lifestyle, is_clicked"
_LEARNT = _with(
    _BASE, _CHANGELOG, _LOOKUP, oracle_fit.learner("lookup", _WITH_HISTORY, _EXAMPLE_ORDER, _EXAMPLES_PER_STEP, 1.0, 1e-4),
    " SELECT CAST(position AS INTEGER) AS position, feature, round(weight, 9) AS weight, examples FROM ("
    f" SELECT unnest(range({len(_WITH_HISTORY) + 1})) AS position, unnest({['(intercept)', *_WITH_HISTORY]}) AS feature,"
    f" unnest(w) AS weight, t * {_EXAMPLES_PER_STEP} AS examples FROM learnt, learn_last WHERE t = last AND last > 0)",
).replace("WITH", "WITH RECURSIVE", 1)


def _model(history: bool, *rest: str) -> str:
    source, names = ("history_shares", _WITH_HISTORY) if history else ("impressions", _ONE_HOT_NAMES)
    fit = oracle_fit.fitted(source, _IN_TRAIN, names)
    if rest[0] == "coefficients":
        parts = [fit, oracle_fit.coefficients(names, 5)]
    else:
        parts = [fit, oracle_fit.held_out(source, _IN_TRAIN, names), rest[1]]
    text = _with(_BASE, *([_HISTORY] if history else []), *parts)
    return text.replace("WITH", "WITH RECURSIVE", 1)


ORACLE = {
    "enriched_impressions": _IMPRESSIONS,
    "win_request_matches": _with(_BASE, " SELECT * FROM matched"),
    "win_click_matches": _with(
        _BASE,
        " SELECT w.request_id, w.campaign_id, w.ts AS event_time, c.user_action, c.ts AS click_time FROM wins w"
        " LEFT JOIN clicks c ON w.request_id = c.request_id AND c.ts BETWEEN w.ts AND w.ts + INTERVAL 11 SECOND",
    ),
    "impression_kpis": _with(
        _BASE,
        " SELECT COUNT(*) AS impressions, CAST(SUM(is_clicked) AS BIGINT) AS clicks,"
        " round(SUM(is_clicked) / COUNT(*), 6) AS ctr, round(AVG(win_price), 6) AS avg_cpm FROM impressions",
    ),
    "ctr_by_category": _with(
        _BASE,
        " SELECT site_category, round(SUM(is_clicked) / COUNT(*), 6) AS ctr FROM impressions"
        " GROUP BY site_category ORDER BY ctr DESC, site_category",
    ),
    "recent_impressions": _with(
        _BASE,
        " SELECT event_time, user_id, site_category, win_price, is_clicked FROM impressions"
        " ORDER BY event_time DESC, request_id, is_clicked DESC LIMIT 10",
    ),
    "impression_serving_rows": _with(
        _BASE,
        " SELECT request_id, user_id, os, site_category, campaign_id, win_price, is_clicked,"
        " strftime(event_time, '%Y-%m-%d %H:%M:%S.%g') AS event_time FROM impressions",
    ),
    "impression_messages": _with(
        _BASE,
        " SELECT request_id, user_id, campaign_id, CAST(is_clicked AS VARCHAR) AS is_clicked,"
        " strftime(event_time, '%Y-%m-%d %H:%M:%S.%g') AS event_time FROM impressions",
    ),
    "events_view_click_interval": (
        "SELECT v.event_id AS view_id, c.event_id AS click_id, v.user_id FROM events v JOIN events c"
        " ON v.user_id = c.user_id AND c.ts BETWEEN v.ts AND v.ts + INTERVAL 1 HOUR"
        " WHERE v.event_type = 'view' AND c.event_type = 'click'"
    ),
    "ride_fare_category": (
        f"SELECT CAST(event_id AS INTEGER) AS ride_id, event_type AS pickup, value AS fare, {_category('value')} FROM events"
    ),
    "ride_fare_category_strict": (
        f"SELECT event_id AS ride_id, event_type AS pickup, value AS fare, {_category('value')},"
        " CAST(NULL AS VARCHAR) AS note_entry FROM events"
    ),
    "ride_fare_category_tolerant": _TOLERANT,
    "ride_rejects": _with(_MESSAGES, " SELECT value, reason FROM judged WHERE reason IS NOT NULL"),
    "ride_bytes_outcomes": (
        "SELECT CASE event_id % 50 WHEN 0 THEN 'not JSON' WHEN 1 THEN 'cheap' WHEN 2 THEN 'cheap' WHEN 3 THEN 'fare is not a number'"
        " WHEN 5 THEN 'not text' ELSE CASE WHEN value < 10 THEN 'cheap' WHEN value < 15 THEN 'medium' ELSE 'expensive' END END AS outcome,"
        " COUNT(*) AS n FROM events GROUP BY outcome"
    ),
    "ride_serving_rows": _with(
        _MESSAGES,
        f" SELECT CAST(ride_id AS VARCHAR) AS ride_id, pickup, {_category('COALESCE(fare, 0)')}, fare,"
        " CAST(1704067200000 AS BIGINT) AS ingestion_time FROM good",
    ),
    "ride_sample": (
        "SELECT CAST(event_id AS INTEGER) AS ride_id, event_type AS pickup, value AS fare FROM events ORDER BY event_id LIMIT 5"
    ),
    "ride_category_counts": (
        f"SELECT fare_category, COUNT(*) AS n_rides FROM (SELECT {_category('value')} FROM events) GROUP BY fare_category"
    ),
    "fare_totals": _FARE_TOTALS,
    "fare_grand_totals": (
        "SELECT pickup, round(SUM(total), 4) AS grand_total FROM (SELECT event_type AS pickup, SUM(value) AS total"
        " FROM events GROUP BY event_type) GROUP BY pickup ORDER BY grand_total DESC, pickup"
    ),
    "user_profiles": _USER_PROFILES,
    "user_profile_changelog": _USER_CHANGELOG,
    "latest_profile_versions": _USER_PROFILES,
    "asof_requests_profiles": _with(_BASE, _CHANGELOG, _REQUEST_LOOKUP, " SELECT * FROM request_lookup"),
    "asof_impressions_profiles": _with(_BASE, _CHANGELOG, " " + _IMPRESSION_LOOKUP.format(op=">=")),
    "asof_impressions_profiles_before": _with(_BASE, _CHANGELOG, " " + _IMPRESSION_LOOKUP.format(op=">")),
    "user_history_features": _with(
        _BASE, _HISTORY,
        " SELECT request_id, user_id, event_time, is_clicked, user_total_views, user_tech_views, user_lifestyle_views,"
        " round(frac_tech, 9) AS frac_tech, round(frac_lifestyle, 9) AS frac_lifestyle FROM history_shares",
    ),
    "onehot_vocabulary": _with(
        _BASE,
        " SELECT column_name, value, CAST(ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY value) - 1 AS INTEGER) AS position"
        " FROM (SELECT DISTINCT 'os' AS column_name, os AS value FROM requests UNION ALL"
        " SELECT DISTINCT 'site_category', site_category FROM requests)",
    ),
    "onehot_features": _with(_BASE, f" SELECT request_id, is_clicked, {_ONE_HOT} FROM impressions"),
    "serving_features": _with(
        _BASE, _CHANGELOG, _REQUEST_LOOKUP, _SERVING_SHARES,
        " SELECT request_id, round(frac_tech, 9) AS frac_tech, round(frac_lifestyle, 9) AS frac_lifestyle,"
        f" {_ONE_HOT} FROM serving",
    ),
    "scored_requests_fixed_weights": _SCORED_REQUESTS,
    "roc_auc": _with(_BASE, _HISTORY, _SCORED_TEST, _AUC),
    "classification_report": _with(_BASE, _HISTORY, _SCORED_TEST, _REPORT),
    "training_guards": _with(
        _BASE,
        " SELECT COUNT(*) AS n_rows, CAST(SUM(is_clicked) AS BIGINT) AS clicks, round(AVG(is_clicked), 9) AS click_rate"
        " FROM impressions",
    ),
    "class_weights": _with(
        _BASE,
        " SELECT label, n_rows, round(CAST(SUM(n_rows) OVER () AS DOUBLE) / (COUNT(*) OVER () * n_rows), 9) AS class_weight"
        " FROM (SELECT is_clicked AS label, COUNT(*) AS n_rows FROM impressions GROUP BY is_clicked)",
    ),
    "split_counts": _with(
        _BASE,
        f" SELECT CASE WHEN {_IN_TRAIN} THEN 'train' ELSE 'test' END AS side, is_clicked, COUNT(*) AS n_rows"
        " FROM impressions GROUP BY ALL",
    ),
    "training_matrix_v1": _with(
        _BASE,
        f" SELECT {_IN_TRAIN} AS train, os, site_category, is_clicked AS label, COUNT(*) AS n FROM impressions GROUP BY ALL",
    ),
    "training_matrix_v2": _with(
        _BASE, _HISTORY,
        f", grouped AS (SELECT {_IN_TRAIN} AS train, os, site_category, frac_tech, frac_lifestyle, is_clicked AS label,"
        " COUNT(*) AS n FROM history_shares GROUP BY ALL) SELECT train, os, site_category,"
        " round(frac_tech, 9) AS frac_tech, round(frac_lifestyle, 9) AS frac_lifestyle, label, n FROM grouped",
    ),
    "model_feature_columns": _with(
        _BASE,
        " SELECT CAST(ROW_NUMBER() OVER (ORDER BY part, feature) - 1 AS INTEGER) AS position, feature FROM ("
        " SELECT 0 AS part, 'frac_tech' AS feature UNION ALL SELECT 1, 'frac_lifestyle' UNION ALL"
        " SELECT 2, 'os_' || os FROM (SELECT DISTINCT os FROM requests) WHERE os > (SELECT MIN(os) FROM requests) UNION ALL"
        " SELECT 3, 'site_category_' || site_category FROM (SELECT DISTINCT site_category FROM requests)"
        " WHERE site_category > (SELECT MIN(site_category) FROM requests))",
    ),
    "online_learner_status": _with(
        _BASE,
        f" SELECT 'Updated' AS status, COUNT(*) // {_EXAMPLES_PER_STEP} * {_EXAMPLES_PER_STEP} AS examples FROM impressions"
        f" HAVING COUNT(*) >= {_EXAMPLES_PER_STEP}",
    ),
    "online_model_weights": _LEARNT,
    "chain_learned_model": _LEARNT,
    "ctr_model_v1_coefficients": _model(False, "coefficients"),
    "ctr_model_v2_coefficients": _model(True, "coefficients"),
    "ctr_model_v1_report": _model(False, "scores", _REPORT),
    "ctr_model_v2_auc": _model(True, "scores", _AUC.replace(", 9) AS roc_auc", ", 4) AS roc_auc")),
    "serving_table_kpis": _with(
        _BASE,
        " SELECT COUNT(*) AS impressions, CAST(SUM(is_clicked) AS BIGINT) AS clicks,"
        " round(SUM(is_clicked) / COUNT(*), 6) AS ctr, round(AVG(win_price), 6) AS avg_cpm FROM impressions",
    ),
    "recovered_fare_totals": _FARE_TOTALS,
    "late_requests": _with(
        _BASE,
        " parts AS (SELECT request_id, ts, CAST(least((day(ts) - 1) // 8 + CASE WHEN CAST(request_id AS BIGINT) % 20 = 0 THEN 2 ELSE 0 END, 3)"
        " AS BIGINT) AS batch_id FROM requests),"
        " ends AS (SELECT batch_id, MAX(MAX(ts)) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS reached"
        " FROM parts GROUP BY batch_id)",
        " SELECT request_id, (epoch_us(reached) - epoch_us(ts)) // 1000 - 5000 AS late_ms, batch_id FROM parts JOIN ends USING (batch_id)"
        " WHERE (epoch_us(reached) - epoch_us(ts)) // 1000 >= 5000",
    ),
    "stream_enriched_impressions": _IMPRESSIONS,
    "topic_enriched_impressions": _IMPRESSIONS,
    "chain_scored_requests": _SCORED_REQUESTS,
    "quiet_inputs_impressions": _with(_BASE, _QUIET),
    "upsert_topic_profiles": _with(
        _BASE, _UPSERTS,
        " SELECT r.request_id, r.user_id, r.ts, CASE WHEN NOT c.deleted THEN c.total_views END AS total_views,"
        " CASE WHEN NOT c.deleted THEN c.tech_views END AS tech_views,"
        " CASE WHEN NOT c.deleted THEN c.lifestyle_views END AS lifestyle_views"
        " FROM requests r ASOF LEFT JOIN changes c ON r.user_id = c.user_id AND r.ts >= c.update_time",
    ),
    "upsert_topic_current": _with(
        _UPSERTS,
        " SELECT user_id, total_views, tech_views, lifestyle_views, update_time FROM changes"
        " WHERE NOT deleted QUALIFY update_time = MAX(update_time) OVER (PARTITION BY user_id)"
        " AND (user_id, update_time) IN (SELECT (user_id, MAX(update_time)) FROM changes GROUP BY user_id)",
    ),
    "stream_user_profiles": _USER_PROFILES,
    "stream_profile_changelog": _USER_CHANGELOG,
    "stream_fare_totals": _FARE_TOTALS,
    "stream_asof_scores": _SCORED_REQUESTS,
    "stream_ride_categories": _TOLERANT,
}
