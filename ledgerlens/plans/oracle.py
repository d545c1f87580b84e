"""The catalog's queries as SQL for an independent engine (DuckDB dialect)."""

from __future__ import annotations

from ledgerlens.functions import poisson1_thresholds
from ledgerlens.operators.scoring import SHIPPED, Coefficients
from ledgerlens.plans.derive import CANDIDATE, CHAMPION
from ledgerlens.plans.catalog import LATENCY_BOUNDS, REPLICATES, SALT, SCORE_BOUNDS
from ledgerlens.schemas import FEATURES, RAW

ORACLES: dict[str, str] = {}

LE = "[" + ", ".join([repr(b) for b in LATENCY_BOUNDS] + ["'inf'::DOUBLE"]) + "]"
STAMP = "'%Y-%m-%d %H:%M:%S'"
RAW_COLUMNS = ", ".join(RAW.fieldNames())
DEDUP_ORDER = (
    "tx_datetime NULLS FIRST, customer_id NULLS FIRST, terminal_id NULLS FIRST, tx_amount NULLS FIRST, "
    "tx_time_seconds NULLS FIRST, tx_time_days NULLS FIRST, tx_fraud NULLS FIRST, tx_fraud_scenario NULLS FIRST"
)


def probability(c: Coefficients) -> str:
    z = " + ".join(["0.0::double", *[f"{n} * ({w!r})::double" for n, w in zip(c.names, c.weights)]])
    return f"(1.0::double / (1.0::double + exp(-({z} + ({c.intercept!r})::double))))"


def poisson(hex8: str) -> str:
    arms = " ".join(f"WHEN {hex8} < '{t}' THEN {i}" for i, t in enumerate(poisson1_thresholds()))
    return f"(CASE {arms} ELSE {len(poisson1_thresholds())} END)"


# Named building blocks, each usable after those it mentions.
PARTS = {
    "ev": """
        SELECT event_id, ts, user_id, event_type, value,
               CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k
        FROM events""",
    "shifted": """
        SELECT ev.*, date_trunc('second', ts) + to_hours(c.copy) AS t, c.copy AS copy,
               CASE WHEN value > 100 AND k % 2 = 0 THEN 1 ELSE 0 END AS fraud
        FROM ev JOIN (SELECT unnest([0, 1]) AS copy) c ON c.copy = 0 OR event_id % 73 = 0""",
    "raw": """
        SELECT event_id AS tranaction_id,
               CASE WHEN event_id % 83 = 0 THEN strftime(t, '%Y-%m-%d') || ' 24:00:00'
                    ELSE strftime(t, '%Y-%m-%d %H:%M:%S') END AS tx_datetime,
               CASE WHEN event_id % 89 = 0 THEN -user_id - 1 ELSE user_id END AS customer_id,
               CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 'Err'
                    ELSE CAST(k AS VARCHAR) END AS terminal_id,
               CASE WHEN event_id % 79 = 0 THEN 0.0::double ELSE value END AS tx_amount,
               CAST(floor(epoch(t)) AS BIGINT) AS tx_time_seconds,
               CAST(floor(epoch(t) / 86400) AS BIGINT) AS tx_time_days,
               CAST(fraud AS INTEGER) AS tx_fraud,
               CAST(CASE WHEN fraud = 1 THEN event_id % 3 + 1 ELSE 0 END AS INTEGER) AS tx_fraud_scenario
        FROM shifted""",
    "valid": """
        SELECT * REPLACE (TRY_CAST(terminal_id AS INTEGER) AS terminal_id,
                          TRY_CAST(regexp_replace(tx_datetime, ' 24:00:00$', ' 00:00:00') AS TIMESTAMP) AS tx_datetime)
        FROM raw
        WHERE TRY_CAST(terminal_id AS INTEGER) IS NOT NULL AND customer_id >= 0 AND tx_amount > 0
          AND TRY_CAST(regexp_replace(tx_datetime, ' 24:00:00$', ' 00:00:00') AS TIMESTAMP) IS NOT NULL""",
    "clean": f"""
        SELECT {RAW_COLUMNS}
        FROM (SELECT *, row_number() OVER (PARTITION BY tranaction_id ORDER BY {DEDUP_ORDER}) AS rn FROM valid)
        WHERE rn = 1""",
    "feat": """
        SELECT *, hour(tx_datetime)::double AS hour_of_day,
               (dayofweek(tx_datetime) + 1)::double AS day_of_week,
               CASE WHEN dayofweek(tx_datetime) IN (0, 6) THEN 1.0::double ELSE 0.0::double END AS is_weekend,
               CASE WHEN hour(tx_datetime) BETWEEN 0 AND 6 THEN 1.0::double ELSE 0.0::double END AS is_night
        FROM clean""",
    "champ": f"""
        SELECT *, {probability(CHAMPION)} AS p,
               CAST(CASE WHEN {probability(CHAMPION)} > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS prediction
        FROM feat""",
    "manifest": """
        SELECT DISTINCT strftime(ts, '%Y-%m-%d.txt') AS file FROM ev WHERE day(ts) % 2 = 0""",
    "listing": "SELECT DISTINCT strftime(ts, '%Y-%m-%d.txt') AS file FROM ev",
    "stats": """
        SELECT user_id AS driver_id, date_trunc('hour', ts) AS at_,
               date_trunc('hour', ts) + to_hours(CAST(event_id % 7 AS INTEGER)) AS created,
               CAST(value / 500 AS REAL) AS conv_rate, CAST(k / 100 AS REAL) AS acc_rate, k AS avg_daily_trips
        FROM ev WHERE event_type = 'view'""",
    "stats1": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY driver_id, at_
                       ORDER BY created DESC, conv_rate DESC, acc_rate DESC, avg_daily_trips DESC) AS rn
            FROM stats) WHERE rn = 1""",
    "ent": """
        SELECT event_id AS request_id, user_id AS driver_id, date_trunc('hour', ts) AS at_,
               1 + (event_id % 5) / 10 AS surge_multiplier
        FROM ev WHERE event_type = 'purchase'""",
    "found": """
        SELECT e.request_id, e.driver_id, e.at_ AS entity_at, e.surge_multiplier, f.at_ AS feature_at,
               f.conv_rate, f.acc_rate, f.avg_daily_trips
        FROM ent e ASOF LEFT JOIN stats1 f ON e.driver_id = f.driver_id AND e.at_ >= f.at_""",
    "latest": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY driver_id ORDER BY at_ DESC, created DESC,
                       conv_rate DESC, acc_rate DESC, avg_daily_trips DESC) AS rn
            FROM stats1) WHERE rn = 1""",
    "sc": f"""
        SELECT tranaction_id, tx_fraud, {probability(CHAMPION)} AS champion_p, {probability(CANDIDATE)} AS candidate_p
        FROM feat""",
    "one": "SELECT 'champion' AS model, 0 AS replicate, tx_fraud AS y, champion_p AS p, 1 AS w FROM sc",
    "blocks": f"""
        SELECT sc.*, r.replicate, substr(md5(CAST(tranaction_id AS VARCHAR) || ':' || CAST(r.replicate // 4 AS VARCHAR)),
                                         CAST(8 * (r.replicate % 4) + 1 AS BIGINT), 8) AS hex8
        FROM sc CROSS JOIN (SELECT unnest(range({REPLICATES})) AS replicate) r""",
    "weighted": f"SELECT *, {poisson('hex8')} AS w FROM blocks",
    "resampled": """
        SELECT 'champion' AS model, replicate, tx_fraud AS y, champion_p AS p, w FROM weighted
        UNION ALL
        SELECT 'candidate', replicate, tx_fraud, candidate_p, w FROM weighted""",
}

# Metrics per (model, replicate) from a relation (model, replicate, y, p, w).
METRICS = """
        SELECT model, replicate, u / (pos * neg) AS auc,
               (pos * f1_1 + neg * f1_0) / (pos + neg) AS f1, (tp + neg - fp) / (pos + neg) AS accuracy,
               f1_1 AS fraud_f1, CAST(pos + neg AS BIGINT) AS rows
        FROM (SELECT *, 2 * tp / (2 * tp + fp + pos - tp) AS f1_1,
                     2 * (neg - fp) / (2 * (neg - fp) + pos - tp + fp) AS f1_0
              FROM (SELECT model, replicate, CAST(sum(wp) AS DOUBLE) AS pos, CAST(sum(wn) AS DOUBLE) AS neg,
                           CAST(sum(CASE WHEN p > 0.5 THEN wp ELSE 0 END) AS DOUBLE) AS tp,
                           CAST(sum(CASE WHEN p > 0.5 THEN wn ELSE 0 END) AS DOUBLE) AS fp,
                           sum(CAST(wp AS DOUBLE) * (upto - wn + wn / 2)) AS u
                    FROM (SELECT *, sum(wn) OVER (PARTITION BY model, replicate ORDER BY p
                                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
                          FROM (SELECT model, replicate, p, sum(CASE WHEN y = 1 THEN w ELSE 0 END) AS wp,
                                       sum(CASE WHEN y = 1 THEN 0 ELSE w END) AS wn
                                FROM {rows} GROUP BY ALL))
                    GROUP BY ALL))"""
PARTS["metrics1"] = METRICS.format(rows="one")
PARTS["metrics"] = METRICS.format(rows="resampled")
PARTS["welch"] = """
        SELECT avg(auc) FILTER (model = 'champion') AS auc_a, avg(auc) FILTER (model = 'candidate') AS auc_b,
               avg(f1) FILTER (model = 'champion') AS a, avg(f1) FILTER (model = 'candidate') AS b,
               var_samp(f1) FILTER (model = 'champion') AS va, var_samp(f1) FILTER (model = 'candidate') AS vb,
               count(*) FILTER (model = 'champion') AS na, count(*) FILTER (model = 'candidate') AS nb
        FROM metrics"""
# the two-sided normal tail, from the same all-positive series as ours
PARTS["tested"] = """
        SELECT *, (b - a) / sqrt(va / na + vb / nb) AS t,
               least(abs((b - a) / sqrt(va / na + vb / nb)) / sqrt(2.0), 6.0) AS x
        FROM welch"""
PARTS["tail"] = """
        SELECT 2 / sqrt(pi()) * exp(-any_value(x) * any_value(x)) * any_value(x)
               * (1 + sum(exp(n * ln(2 * x * x) - lnodd))) AS erf
        FROM tested, (SELECT n, sum(ln(2 * n + 1)) OVER (ORDER BY n) AS lnodd
                      FROM (SELECT unnest(range(1, 161)) AS n))"""

PARTS["msg"] = f"""
        SELECT CASE WHEN tranaction_id % 223 = 0 THEN 'text' WHEN tranaction_id % 211 = 0 THEN 'noid' ELSE 'ok' END AS kind,
               raw.*, to_timestamp(tx_time_seconds)::TIMESTAMP AS kafka_ts,
               CASE WHEN tx_datetime NOT LIKE '% 24:00:00' THEN CAST(tx_datetime AS TIMESTAMP) END AS tx_ts
        FROM raw"""
PARTS["mrow"] = """
        SELECT CASE WHEN kind = 'ok' THEN tranaction_id END AS tranaction_id,
               CASE WHEN kind <> 'text' THEN tx_datetime END AS tx_datetime,
               CASE WHEN kind <> 'text' THEN customer_id END AS customer_id,
               CASE WHEN kind <> 'text' THEN terminal_id END AS terminal_id,
               CASE WHEN kind <> 'text' THEN tx_amount END AS tx_amount,
               CASE WHEN kind <> 'text' THEN tx_time_seconds END AS tx_time_seconds,
               CASE WHEN kind <> 'text' THEN tx_time_days END AS tx_time_days,
               CASE WHEN kind <> 'text' THEN tx_fraud END AS tx_fraud,
               CASE WHEN kind <> 'text' THEN tx_fraud_scenario END AS tx_fraud_scenario,
               kafka_ts, CASE WHEN kind <> 'text' THEN tx_ts END AS tx_ts
        FROM msg"""
PARTS["mfeat"] = """
        SELECT *, hour(tx_ts)::double AS hour_of_day, (dayofweek(tx_ts) + 1)::double AS day_of_week,
               CASE WHEN dayofweek(tx_ts) IN (0, 6) THEN 1.0::double ELSE 0.0::double END AS is_weekend,
               CASE WHEN hour(tx_ts) BETWEEN 0 AND 6 THEN 1.0::double ELSE 0.0::double END AS is_night,
               tranaction_id IS NOT NULL AND tx_ts IS NOT NULL AND tx_amount IS NOT NULL AS complete
        FROM mrow"""

PARTS["samples"] = "SELECT user_id % 4 AS pod, ts, max(event_id % 500) AS value FROM ev GROUP BY ALL"
PARTS["grown"] = """
        SELECT *, CASE WHEN value < before THEN value ELSE value - before END AS increase
        FROM (SELECT *, lag(value) OVER (PARTITION BY pod ORDER BY ts) AS before FROM samples)"""
PARTS["hist"] = f"""
        SELECT date_trunc('hour', ts) AS w, le, count(*) FILTER (value <= le) AS n
        FROM ev, (SELECT unnest({LE}::DOUBLE[]) AS le)
        GROUP BY ALL"""
PARTS["bounds"] = f"""
        SELECT unnest({LE}::DOUBLE[]) AS le, unnest(range({len(LATENCY_BOUNDS) + 1})) AS i"""
PARTS["bsamples"] = f"""
        SELECT user_id % 4 AS pod, le, ts,
               max(CAST(floor(event_id * (i + 1) / {len(LATENCY_BOUNDS) + 1}) AS BIGINT)) AS value
        FROM ev, bounds GROUP BY ALL"""
PARTS["bgrown"] = """
        SELECT *, CASE WHEN value < before THEN value ELSE value - before END AS increase
        FROM (SELECT *, lag(value) OVER (PARTITION BY pod, le ORDER BY ts) AS before FROM bsamples)"""
PARTS["brates"] = """
        SELECT to_timestamp(CAST(floor(epoch(ts) / 21600) * 21600 AS BIGINT))::TIMESTAMP AS w, le,
               sum(increase) / 21600.0::double AS n
        FROM bgrown GROUP BY ALL"""
QUANTILE = """
        SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
               round(CASE WHEN hi = 'inf'::DOUBLE THEN lo
                    WHEN lo IS NULL AND hi <= 0 THEN hi
                    ELSE coalesce(lo, 0) + (hi - coalesce(lo, 0)) * (rank - below) / (upto - below) END, 6) AS quantile
        FROM (SELECT w, rank, min(hi) AS hi, first(lo ORDER BY hi) AS lo, min(upto) AS upto, min(below) AS below
              FROM (SELECT w, le AS hi, CAST(n AS DOUBLE) AS upto, lag(le) OVER o AS lo,
                           coalesce(CAST(lag(n) OVER o AS DOUBLE), 0) AS below,
                           0.95::double * last_value(n) OVER (PARTITION BY w ORDER BY le
                               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS rank
                    FROM {rows} WINDOW o AS (PARTITION BY w ORDER BY le))
              WHERE upto >= rank AND rank > 0 GROUP BY w, rank)"""
PARTS["steps"] = """
        SELECT to_timestamp(CAST(floor(epoch(ts) / 3600) * 3600 - 3600 * b AS BIGINT))::TIMESTAMP AS w, pod, increase
        FROM grown, (SELECT unnest(range(5)) AS b)"""
PARTS["limits"] = """
        SELECT user_id % 4 AS pod,
               (max(event_id) - min(event_id)) * 1.2::double / (floor(epoch(max(ts))) - floor(epoch(min(ts)))) AS lim
        FROM ev GROUP BY ALL"""
PARTS["usage"] = """
        SELECT w, pod, sum(increase) / 18000.0::double AS per_second, sum(increase) / 18000.0::double / any_value(lim) AS u
        FROM steps JOIN limits USING (pod) GROUP BY w, pod"""
PARTS["replicas"] = """
        SELECT date_trunc('hour', ts) AS w, arg_max(value, ts) AS value
        FROM (SELECT ts, max(CASE WHEN CAST(floor(epoch(ts) / 43200) AS BIGINT) % 2 = 0 THEN 6 ELSE 3 + event_id % 3 END) AS value
              FROM ev GROUP BY ts)
        GROUP BY ALL"""
PARTS["met"] = """
        SELECT w + INTERVAL 1 HOUR AS at_ FROM replicas
        WHERE value = 6 AND w + INTERVAL 1 HOUR IN (SELECT w + INTERVAL 5 HOUR FROM usage WHERE u > 0.8)"""
PARTS["runs"] = """
        SELECT min(at_) AS since, max(at_) AS until, count(*) AS steps
        FROM (SELECT at_, epoch(at_) / 3600 - row_number() OVER (ORDER BY at_) AS run FROM met)
        GROUP BY run"""

PARTS["r4"] = "SELECT tranaction_id, tx_fraud, tx_fraud = 1 AS fraud, round(champion_p, 4) AS p FROM sc"
PARTS["r2"] = "SELECT round(champion_p, 2) AS p, count(*) AS n, count(*) FILTER (tx_fraud = 1) AS f FROM sc GROUP BY 1"
PARTS["curve"] = """
        SELECT p AS score, count(*) FILTER (fraud) AS frauds, count(*) FILTER (NOT fraud) AS legitimate,
               CAST(sum(count(*) FILTER (fraud)) OVER w AS BIGINT) AS caught,
               CAST(sum(count(*) FILTER (NOT fraud)) OVER w AS BIGINT) AS false_alarms
        FROM r4 GROUP BY p WINDOW w AS (ORDER BY p DESC)"""
PARTS["rates"] = """
        SELECT *, caught / (SELECT max(caught) FROM curve) AS recall, caught / (caught + false_alarms) AS precision,
               false_alarms / (SELECT max(false_alarms) FROM curve) AS false_alarm_rate
        FROM curve"""
# the greatest of the least means over all stretches that hold a score: isotonic regression by its definition
PARTS["sums"] = """
        SELECT p, n, f, row_number() OVER (ORDER BY p) AS i, sum(n) OVER (ORDER BY p) AS un, sum(f) OVER (ORDER BY p) AS uf FROM r2"""
PARTS["fitted"] = """
        SELECT p, n, f, max(least_mean) AS fit
        FROM (SELECT x.p, x.n, x.f, a.i, min((b.uf - a.uf + a.f) / (b.un - a.un + a.n)) AS least_mean
              FROM sums x JOIN sums a ON a.i <= x.i JOIN sums b ON b.i >= x.i GROUP BY ALL)
        GROUP BY p, n, f"""


def _psi(relation: str, value: str, bounds) -> str:
    """The stability index per week against the first ten days."""
    arms = " ".join(f"WHEN {value} < {b!r} THEN {i}" for i, b in enumerate(bounds))
    return f"""
        SELECT strftime(period, {STAMP}) AS period, CAST(any_value(rows) AS BIGINT) AS rows, round(sum(
                   CASE WHEN n = 0 AND b = 0 THEN 0
                        ELSE (greatest(n, 0.5) / rows - greatest(b, 0.5) / total)
                             * ln((greatest(n, 0.5) / rows) / (greatest(b, 0.5) / total)) END), 6) AS psi
        FROM (SELECT period, bin, count(*) FILTER (own = bin)::DOUBLE AS n, count(*)::DOUBLE AS rows
              FROM (SELECT date_trunc('week', tx_datetime)::TIMESTAMP AS period, CASE {arms} ELSE {len(bounds)} END AS own FROM {relation}),
                   (SELECT unnest(range({len(bounds) + 1})) AS bin)
              GROUP BY ALL)
        JOIN (SELECT bin, count(*) FILTER (own = bin)::DOUBLE AS b, count(*)::DOUBLE AS total
              FROM (SELECT CASE {arms} ELSE {len(bounds)} END AS own FROM {relation} WHERE tx_datetime < '2024-01-11'),
                   (SELECT unnest(range({len(bounds) + 1})) AS bin)
              GROUP BY ALL) USING (bin)
        GROUP BY period"""


def _history(key: str) -> str:
    return f"""
        SELECT tranaction_id, {key}, count(*) OVER w AS week_n, round(avg(tx_amount) OVER w + 1e-9, 6) AS week_mean
        FROM clean WINDOW w AS (PARTITION BY {key} ORDER BY tx_datetime RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)"""


PARENTS = {
    "shifted": ["ev"], "raw": ["shifted"], "valid": ["raw"], "clean": ["valid"], "feat": ["clean"],
    "champ": ["feat"], "manifest": ["ev"], "listing": ["ev"], "stats": ["ev"], "stats1": ["stats"],
    "ent": ["ev"], "found": ["ent", "stats1"], "latest": ["stats1"], "sc": ["feat"], "one": ["sc"],
    "blocks": ["sc"], "weighted": ["blocks"], "resampled": ["weighted"], "metrics1": ["one"],
    "metrics": ["resampled"], "welch": ["metrics"], "tested": ["welch"], "tail": ["tested"],
    "msg": ["raw"], "mrow": ["msg"], "mfeat": ["mrow"], "samples": ["ev"], "grown": ["samples"],
    "hist": ["ev"], "bsamples": ["ev", "bounds"], "bgrown": ["bsamples"], "brates": ["bgrown"],
    "steps": ["grown"], "limits": ["ev"], "usage": ["steps", "limits"], "replicas": ["ev"],
    "met": ["replicas", "usage"], "runs": ["met"], "r4": ["sc"], "r2": ["sc"], "curve": ["r4"], "rates": ["curve"],
    "sums": ["r2"], "fitted": ["sums"],
}


def with_parts(*names: str) -> str:
    order: list[str] = []

    def need(name: str) -> None:
        for parent in PARENTS.get(name, []):
            need(parent)
        if name not in order:
            order.append(name)

    for name in names:
        need(name)
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n]})" for n in order)


def oracle(name: str, parts: str, body: str) -> None:
    ORACLES[name] = f"{with_parts(*parts.split())}\n{body}"


def _clean_rows(relation: str) -> str:
    return (
        f"SELECT {RAW_COLUMNS} FROM (SELECT * REPLACE (strftime(tx_datetime, {STAMP}) AS tx_datetime, "
        f"round(tx_amount, 6) AS tx_amount) FROM {relation})"
    )


oracle("fraud_by_time_of_week", "champ", """
    SELECT is_weekend, is_night, count(*) AS transactions, count(*) FILTER (prediction = 1) AS flagged,
           CAST(sum(tx_fraud) AS BIGINT) AS frauds, round(avg(p), 6) AS mean_probability
    FROM champ GROUP BY ALL""")

for _name in ("csv_scan_glob", "csv_scan_file_list"):
    oracle(_name, "raw", f"SELECT {RAW_COLUMNS} FROM raw")
oracle("parquet_round_trip", "clean", _clean_rows("clean"))
for _name in ("replay_messages", "replay_messages_sliced"):
    oracle(_name, "clean", f"""
        SELECT turn * total + row AS position, * EXCLUDE (row, total, turn)
               REPLACE (strftime(tx_datetime, {STAMP}) AS tx_datetime, CAST(terminal_id AS VARCHAR) AS terminal_id)
        FROM (SELECT *, row_number() OVER (ORDER BY tranaction_id) - 1 AS row, count(*) OVER () AS total FROM clean),
             (SELECT unnest([0, 1]) AS turn)
        WHERE turn * total + row < floor(total * 1.5::double)""")
oracle("new_files", "listing manifest", "SELECT file FROM listing WHERE file NOT IN (SELECT file FROM manifest)")
oracle("manifest_update", "listing", "SELECT file FROM listing")
oracle("run_log", "metrics1", """
    SELECT 'run-1' AS run_id, 'metric' AS kind, key, value
    FROM (SELECT unnest(['auc', 'f1', 'accuracy', 'rows']) AS key,
                 unnest([printf('%.4f', auc), printf('%.4f', f1), printf('%.4f', accuracy), CAST(rows AS VARCHAR)]) AS value
          FROM metrics1)""")

oracle("clean_transactions", "clean", _clean_rows("clean"))
oracle("clean_any_survivor_ids", "clean", "SELECT tranaction_id FROM clean")
oracle("time_features", "feat", """
    SELECT tranaction_id, round(tx_amount, 6) AS tx_amount, hour_of_day, day_of_week, is_weekend, is_night, tx_fraud FROM feat""")
oracle("hash_split_sides", "clean", """
    SELECT tranaction_id, CASE WHEN ('0x' || substr(md5('42:' || CAST(tranaction_id AS VARCHAR)), 1, 8))::UBIGINT / 4294967296.0::double < 0.8
                               THEN 'train' ELSE 'test' END AS side
    FROM clean""")

FAULTS = {
    "null_terminal": "terminal_id IS NULL",
    "non_numeric_terminal": "terminal_id IS NOT NULL AND TRY_CAST(terminal_id AS INTEGER) IS NULL",
    "negative_customer": "customer_id < 0",
    "invalid_date": "tx_datetime IS NOT NULL AND tx_datetime LIKE '% 24:00:00'",
    "zero_amount": "tx_amount = 0",
}
for _name, _test in FAULTS.items():
    oracle(f"{_name}_rows", "raw", f"SELECT {RAW_COLUMNS} FROM raw WHERE {_test}")
oracle("fault_counts", "raw", "SELECT 'total' AS fault, count(*) AS rows FROM raw" + "".join(
    f" UNION ALL SELECT '{n}', count(*) FROM raw WHERE {t}" for n, t in FAULTS.items()))
oracle("null_counts", "raw", " UNION ALL ".join(
    f'SELECT \'{c}\' AS "column", count(*) FILTER ({c} IS NULL) AS nulls FROM raw' for c in RAW.fieldNames()))


def _summary(f) -> str:
    c, text = f.name, f.dataType.simpleString() == "string"
    lo, hi = ("NULL::double", "NULL::double") if text else (f"round(min({c})::double, 3)", f"round(max({c})::double, 3)")
    lo_t, hi_t = (f"min({c})", f"max({c})") if text else ("NULL::varchar", "NULL::varchar")
    return (
        f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(avg(TRY_CAST({c} AS DOUBLE)), 3) AS mean, "
        f"round(stddev_samp(TRY_CAST({c} AS DOUBLE)), 3) AS stddev, {lo} AS min, {hi} AS max, "
        f"{lo_t} AS min_text, {hi_t} AS max_text FROM raw"
    )


oracle("column_summary", "raw", " UNION ALL ".join(_summary(f) for f in RAW.fields))
oracle("invalid_terminal_values", "raw", f"SELECT DISTINCT terminal_id FROM raw WHERE {FAULTS['non_numeric_terminal']}")
oracle("negative_customer_values", "raw", "SELECT DISTINCT customer_id FROM raw WHERE customer_id < 0")
oracle("duplicate_rows", "raw", f"""
    SELECT {RAW_COLUMNS}, dup_count FROM (SELECT *, count(*) OVER (PARTITION BY tranaction_id) AS dup_count FROM raw)
    WHERE dup_count > 1""")
oracle("repeated_customer_rows", "raw", """
    SELECT tranaction_id, tx_time_seconds, customer_id, dup_count
    FROM (SELECT *, count(*) OVER (PARTITION BY customer_id) AS dup_count FROM raw) WHERE dup_count > 1""")
oracle("fraud_distribution", "raw", "SELECT tx_fraud, count(*) AS rows FROM raw GROUP BY ALL")
oracle("scenario_distribution", "raw", "SELECT tx_fraud_scenario, count(*) AS rows FROM raw GROUP BY ALL")
oracle("preview_rows", "raw", f"SELECT {RAW_COLUMNS} FROM raw ORDER BY tranaction_id, tx_time_seconds LIMIT 20")

RATING = "(0.6::double * coalesce(conv_rate::double, 0) + 0.4::double * coalesce(acc_rate::double, 0))"
TRIPS = f"({RATING} * ln(1 + coalesce(avg_daily_trips::double, 0)))"
SCORES = (
    f"round({RATING}, 6) AS weighted_rating, round({TRIPS}, 6) AS trip_score, "
    f"round({TRIPS} * surge_multiplier, 6) AS surge_adjusted_score"
)
RATES = "round(conv_rate::double, 6) AS conv_rate, round(acc_rate::double, 6) AS acc_rate"
oracle("point_in_time_features", "found", f"""
    SELECT request_id, driver_id, strftime(entity_at, {STAMP}) AS event_timestamp, round(surge_multiplier, 6) AS surge_multiplier,
           {RATES}, avg_daily_trips, {SCORES}
    FROM found""")
for _name in ("point_in_time_with_expiry", "point_in_time_hot_keys"):
    oracle(_name, "found", f"""
        SELECT request_id, driver_id, strftime(entity_at, {STAMP}) AS event_timestamp, round(surge_multiplier, 6) AS surge_multiplier,
               CASE WHEN feature_at >= entity_at - INTERVAL 2 DAY THEN round(conv_rate::double, 6) END AS conv_rate,
               CASE WHEN feature_at >= entity_at - INTERVAL 2 DAY THEN round(acc_rate::double, 6) END AS acc_rate,
               CASE WHEN feature_at >= entity_at - INTERVAL 1 DAY THEN avg_daily_trips END AS avg_daily_trips
        FROM found""")
for _name in ("latest_feature_values", "incremental_feature_values"):
    oracle(_name, "latest", f"""
        SELECT driver_id, strftime(at_, {STAMP}) AS event_timestamp, strftime(created, {STAMP}) AS created, {RATES}, avg_daily_trips
        FROM latest""")
oracle("online_features", "ent latest", f"""
    SELECT request_id, driver_id, round(surge_multiplier, 6) AS surge_multiplier, {RATES}, avg_daily_trips, {SCORES}
    FROM (SELECT ent.*, conv_rate, acc_rate, avg_daily_trips
          FROM ent LEFT JOIN latest ON ent.driver_id = latest.driver_id AND latest.driver_id % 7 <> 0)""")

for _name, _c in (("score_from_coefficients", SHIPPED), ("score_from_coefficient_file", CHAMPION)):
    oracle(_name, "feat", f"""
        SELECT tranaction_id, round({probability(_c)}, 6) AS fraud_probability,
               CAST(CASE WHEN {probability(_c)} > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS prediction
        FROM feat""")
oracle("trained_model_agrees_with_its_coefficients", "feat", "SELECT count(*) AS rows, 0::BIGINT AS differing FROM feat")
ORACLES["exported_coefficient_rows"] = " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS pos, '{name}' AS name" for i, name in enumerate(FEATURES))

oracle("confusion_table", "champ", "SELECT tx_fraud, prediction, count(*) AS rows FROM champ GROUP BY ALL")
ROUNDED = "round(auc, 6) AS auc, round(f1, 6) AS f1, round(accuracy, 6) AS accuracy, round(fraud_f1, 6) AS fraud_f1, rows"
for _name in ("model_metrics", "model_metrics_sliced"):
    oracle(_name, "metrics1", f"SELECT {ROUNDED} FROM metrics1")
oracle("bootstrap_metrics", "metrics", f"SELECT model, CAST(replicate AS INTEGER) AS replicate, {ROUNDED} FROM metrics")
oracle("bootstrap_mean_metrics", "metrics", """
    SELECT model, round(avg(auc), 6) AS mean_auc, round(avg(f1), 6) AS mean_f1, round(avg(accuracy), 6) AS mean_accuracy
    FROM metrics GROUP BY model""")
oracle("champion_against_candidate", "tail", """
    SELECT round(auc_a, 5) AS champion_mean_auc, round(auc_b, 5) AS candidate_mean_auc, round(a, 5) AS champion_mean_f1,
           round(b, 5) AS candidate_mean_f1, round(b - a, 5) AS improvement, round(t, 5) AS t_statistic,
           round(1 - least(erf, 1.0), 5) AS p_value, round((b - a) / sqrt((va + vb) / 2), 5) AS cohens_d,
           1 - erf < 0.05 AS is_significant, 1 - erf < 0.05 AND b > a AS should_deploy
    FROM tested, tail""")
oracle("latest_two_versions", "ev", """
    SELECT model, CAST(max(v) FILTER (rn = 1) AS INTEGER) AS candidate_version, max(run_id) FILTER (rn = 1) AS candidate_run_id,
           CAST(max(v) FILTER (rn = 2) AS INTEGER) AS champion_version, max(run_id) FILTER (rn = 2) AS champion_run_id
    FROM (SELECT event_type AS model, event_id AS v, 'run-' || CAST(user_id AS VARCHAR) AS run_id,
                 row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS rn FROM ev)
    WHERE rn <= 2 GROUP BY model HAVING count(*) = 2""")

oracle("parsed_messages", "mfeat", f"""
    SELECT * EXCLUDE (tx_ts) REPLACE (strftime(kafka_ts, {STAMP}) AS kafka_ts, round(tx_amount, 6) AS tx_amount) FROM mfeat""")
oracle("stream_scored", "mfeat", f"""
    SELECT tranaction_id, customer_id, terminal_id, round(tx_amount, 6) AS tx_amount, tx_fraud AS ground_truth,
           CAST(CASE WHEN {probability(CHAMPION)} > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS prediction,
           strftime(kafka_ts, {STAMP}) AS event_time
    FROM mfeat WHERE complete""")
oracle("stream_rejects", "mfeat", f"SELECT {RAW_COLUMNS} FROM mfeat WHERE NOT complete")
oracle("stream_scored_by_fitted_model", "mfeat", """
    SELECT CASE WHEN complete THEN 'predictions' ELSE 'rejects' END AS topic, count(*) AS messages FROM mfeat GROUP BY ALL""")
oracle("stream_outcome_counts", "mfeat", f"""
    SELECT count(*) AS predictions_total, count(*) FILTER ({probability(CANDIDATE)} > 0.5) AS fraud_predictions_total
    FROM mfeat WHERE complete""")
HOURLY = f"""
    SELECT strftime(date_trunc('hour', ts), {STAMP}) AS window_start,
           strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, {STAMP}) AS window_end,
           {{by}} count(*) AS events, round(count(*) / 3600.0::double, 6) AS per_second
    FROM ev GROUP BY ALL"""
oracle("stream_event_rate", "ev", f"""
    SELECT * FROM ({HOURLY.format(by='')})
    WHERE window_end <= (SELECT strftime(max(ts) - INTERVAL 10 MINUTE, {STAMP}) FROM ev)""")
oracle("stream_sustained_alert", "replicas", f"""
    SELECT 'api' AS deployment, strftime(min(at_), {STAMP}) AS since, strftime(min(at_) + INTERVAL 5 HOUR, {STAMP}) AS fired_at
    FROM (SELECT at_, epoch(at_) / 3600 - row_number() OVER (ORDER BY at_) AS run
          FROM (SELECT w + INTERVAL 1 HOUR AS at_ FROM replicas WHERE value = 6)
          WHERE at_ <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM ev))
    GROUP BY run HAVING max(at_) - min(at_) >= INTERVAL 5 HOUR""")

oracle("stream_event_rate_to_the_end", "ev", HOURLY.format(by=""))
oracle("stream_ended_runs", "replicas", f"""
    SELECT 'api' AS deployment, strftime(min(at_), {STAMP}) AS since, strftime(max(at_), {STAMP}) AS until, count(*) AS steps
    FROM (SELECT at_, epoch(at_) / 3600 - row_number() OVER (ORDER BY at_) AS run
          FROM (SELECT w + INTERVAL 1 HOUR AS at_ FROM replicas WHERE value = 6))
    GROUP BY run HAVING max(at_) - min(at_) >= INTERVAL 5 HOUR""")

oracle("outcome_counts", "champ", """
    SELECT count(*) AS predictions_total, count(*) FILTER (prediction = 1) AS fraud_predictions_total FROM champ""")
oracle("event_rate", "ev", HOURLY.format(by=""))
oracle("event_rate_by_type", "ev", HOURLY.format(by="event_type,"))
oracle("sliding_event_rate", "ev", f"""
    SELECT strftime(w, {STAMP}) AS window_start, strftime(w + INTERVAL 4 HOUR, {STAMP}) AS window_end,
           count(*) AS events, round(count(*) / 14400.0::double, 6) AS per_second
    FROM (SELECT date_trunc('hour', ts) - to_hours(CAST(b AS INTEGER)) AS w FROM ev, (SELECT unnest(range(4)) AS b))
    GROUP BY w""")
for _name in ("counter_rate_by_pod", "counter_rate_by_pod_hot_series"):
    oracle(_name, "grown", f"""
        SELECT strftime(date_trunc('hour', ts), {STAMP}) AS window_start,
               strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, {STAMP}) AS window_end, pod,
               round(sum(increase) / 3600.0::double, 6) AS per_second
        FROM grown GROUP BY date_trunc('hour', ts), pod""")
oracle("latency_p95", "hist", QUANTILE.format(rows="hist"))
oracle("latency_p95_from_counters", "brates", QUANTILE.format(rows="brates"))
oracle("counter_totals", "samples", """
    SELECT CAST(sum(v) AS BIGINT) AS total FROM (SELECT pod, arg_max(value, ts) AS v FROM samples GROUP BY pod)""")
oracle("replica_gauge", "replicas", f"""
    SELECT strftime(w, {STAMP}) AS window_start, strftime(w + INTERVAL 1 HOUR, {STAMP}) AS window_end,
           'api' AS deployment, value FROM replicas""")
oracle("cpu_utilisation", "usage", f"""
    SELECT strftime(w, {STAMP}) AS window_start, strftime(w + INTERVAL 5 HOUR, {STAMP}) AS window_end, pod,
           round(per_second, 6) AS per_second, round(u, 6) AS utilisation FROM usage""")
oracle("overload_alert", "runs", f"""
    SELECT 'api' AS deployment, strftime(since, {STAMP}) AS since, strftime(until, {STAMP}) AS until, steps
    FROM runs WHERE until - since >= INTERVAL 5 HOUR""")


# ------------------------------------------------------------ thresholds, history, incremental work

oracle("incremental_cleaning", "clean", _clean_rows("clean"))
oracle("time_split_sides", "clean", """
    SELECT tranaction_id, CASE WHEN tx_datetime <= (SELECT quantile_disc(tx_datetime, 0.7) FROM clean) THEN 'train'
                               WHEN tx_datetime <= (SELECT quantile_disc(tx_datetime, 0.85) FROM clean) THEN 'valid' ELSE 'test' END AS side
    FROM clean""")
oracle("customer_history", "clean", _history("customer_id"))
oracle("terminal_history", "clean", _history("terminal_id"))
oracle("amount_drift", "clean", _psi("clean", "tx_amount", LATENCY_BOUNDS))
oracle("score_drift", "champ", _psi("champ", "p", SCORE_BOUNDS))
oracle("pseudonymous_customers", "clean", f"""
    SELECT sha256('{SALT}:' || CAST(customer_id AS VARCHAR)) AS customer, count(*) AS rows FROM clean GROUP BY customer_id""")
oracle("resampled_rows", "weighted", """
    SELECT tranaction_id, unnest(range(w)) AS copy FROM weighted WHERE replicate = 3 AND w > 0""")
oracle("decision_curve", "curve", "SELECT * FROM curve")
oracle("recall_at_five_percent", "rates", """
    SELECT score AS threshold, round(recall, 6) AS recall, round(false_alarm_rate, 6) AS false_alarm_rate
    FROM rates WHERE false_alarm_rate <= 0.05 ORDER BY caught DESC, score DESC LIMIT 1""")
oracle("average_precision", "rates", "SELECT round(sum(frauds * precision) / sum(frauds), 6) AS average_precision FROM rates")
oracle("best_threshold", "rates", """
    SELECT score AS threshold, value, round(recall, 6) AS recall, round(precision, 6) AS precision,
           round(false_alarm_rate, 6) AS false_alarm_rate, caught + false_alarms AS flagged
    FROM (SELECT *, caught * 100.0::DOUBLE - (caught + false_alarms) * 10 - false_alarms * 5 AS value FROM rates)
    WHERE false_alarm_rate <= 0.05 ORDER BY value DESC, score DESC LIMIT 1""")
oracle("brier_score", "sc", "SELECT count(*) AS rows, round(avg((champion_p - tx_fraud) ** 2), 6) AS brier FROM sc")
oracle("reliability_bins", "r4", """
    SELECT CAST(least(floor(p * 10), 9) AS INTEGER) AS bin, count(*) AS rows, round(avg(p), 6) AS mean_score,
           round(avg(tx_fraud), 6) AS fraud_rate
    FROM r4 GROUP BY 1""")
oracle("reliability_bands", "fitted", """
    SELECT min(p) AS low, max(p) AS high, CAST(sum(n) AS BIGINT) AS rows, round(sum(f) / sum(n), 6) AS fraud_rate FROM fitted GROUP BY fit""")
oracle("precision_at_100", "r4", """
    SELECT count(*) AS k, round(avg(tx_fraud), 6) AS precision FROM (SELECT * FROM r4 ORDER BY p DESC, tranaction_id LIMIT 100)""")
oracle("loss_report", "champ", f"""
    SELECT period, strftime(date_trunc(period, tx_datetime)::TIMESTAMP, {STAMP}) AS start, count(*) AS transactions,
           round(sum(CASE WHEN tx_fraud = 1 AND p < 0.5 THEN tx_amount ELSE 0 END), 4) AS lost,
           count(*) FILTER (tx_fraud = 1 AND p < 0.5) AS frauds_lost, count(*) FILTER (tx_fraud = 0 AND p >= 0.9) AS legitimate_declined,
           round(count(*) FILTER (tx_fraud = 0 AND p >= 0.9) / count(*) FILTER (tx_fraud = 0), 4) AS declined_share
    FROM champ, (SELECT unnest(['day', 'week', 'month']) AS period) GROUP BY ALL""")
oracle("routed_decisions", "champ", """
    SELECT CASE WHEN p >= 0.9 THEN 'decline' WHEN p >= 0.5 THEN 'review' ELSE 'approve' END AS decision, tx_fraud, count(*) AS rows
    FROM champ GROUP BY ALL""")
PARTS["asked"] = """
        SELECT CASE WHEN tranaction_id % 50 <> 0 THEN tranaction_id END AS transaction_id,
               CASE WHEN tranaction_id % 79 <> 0 THEN tx_amount END AS tx_amount, tx_datetime,
               TRY_CAST(tx_datetime AS TIMESTAMP) AS at_
        FROM raw"""
PARTS["asked_feat"] = """
        SELECT *, hour(at_)::double AS hour_of_day, (dayofweek(at_) + 1)::double AS day_of_week,
               CASE WHEN dayofweek(at_) IN (0, 6) THEN 1.0::double ELSE 0.0::double END AS is_weekend,
               CASE WHEN hour(at_) BETWEEN 0 AND 6 THEN 1.0::double ELSE 0.0::double END AS is_night
        FROM asked WHERE tx_amount IS NOT NULL AND tx_datetime NOT LIKE '% 24:%'"""
PARENTS |= {"asked": ["raw"], "asked_feat": ["asked"]}
oracle("request_responses", "asked_feat", f"""
    SELECT transaction_id, CAST(CASE WHEN {probability(SHIPPED)} > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS prediction,
           round({probability(SHIPPED)}, 6) AS fraud_probability
    FROM asked_feat""")
oracle("request_rejects", "asked", """
    SELECT transaction_id, round(tx_amount, 6) AS tx_amount, tx_datetime,
           CASE WHEN tx_amount IS NULL THEN 'no amount' ELSE 'unreadable time' END AS reason
    FROM asked WHERE tx_amount IS NULL OR tx_datetime LIKE '% 24:%'""")
ORACLES["point_in_time_from_files"] = (
    "SELECT * FROM (" + ORACLES["point_in_time_with_expiry"] + ") WHERE event_timestamp >= '2024-01-20'"
)
