"""SQL for another engine giving the same result as each query, over the same tables."""

from __future__ import annotations

from riskloom.schemas import FEATURE_COLUMNS

ADDR = """
addr AS (
  SELECT o_orderkey AS address, CAST(year(o_orderdate) AS INT) AS year,
    CAST(dayofyear(o_orderdate) AS INT) AS day,
    CAST(coalesce(max(l_linenumber), 0) AS BIGINT) AS length, coalesce(round(sum(l_discount), 6), 0) AS weight,
    count(l_orderkey) AS count, count(l_orderkey) - count(DISTINCT l_suppkey) AS looped,
    count(DISTINCT l_partkey) AS neighbors, max(o_totalprice) AS income,
    CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN o_orderpriority ELSE 'white' END AS label
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
  GROUP BY o_orderkey, o_orderdate, o_orderpriority
)"""

DIRTY = ADDR + """,
addr_dirty AS (
  SELECT address, CASE WHEN address % 97 = 0 THEN NULL ELSE year END AS year,
    CASE WHEN address % 89 = 0 THEN NULL ELSE day END AS day, length, weight, count,
    CASE WHEN address % 83 = 0 THEN -looped - 1 ELSE looped END AS looped,
    CASE WHEN address % 101 = 0 THEN -1 ELSE neighbors END AS neighbors,
    CASE WHEN address % 53 = 0 THEN -income WHEN address % 59 = 0 THEN NULL ELSE income END AS income,
    CASE WHEN address % 103 = 0 THEN NULL ELSE label END AS label
  FROM addr
)"""


def row_hash(key: str) -> str:
    return f"md5(concat(CAST({key} AS VARCHAR), ':42'))"


def filled(source: str) -> str:
    return f"""
filled AS (
  SELECT address, coalesce(year, 0) AS year, coalesce(day, 0) AS day, coalesce(length, 0) AS length,
    coalesce(weight, 0) AS weight, coalesce(count, 0) AS count, coalesce(looped, 0) AS looped,
    coalesce(neighbors, 0) AS neighbors, coalesce(income, 0) AS income, label
  FROM {source}
)"""


def balanced(source: str) -> str:
    return filled(source) + f""",
classed AS (
  SELECT * EXCLUDE (label), CASE WHEN label <> 'white' THEN 1 ELSE 0 END AS is_ransomware
  FROM filled WHERE label IS NOT NULL
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY is_ransomware ORDER BY {row_hash('address')}, address) AS rk,
    sum(is_ransomware) OVER () AS positives
  FROM classed
),
balanced AS (
  SELECT * EXCLUDE (rk, positives) FROM ranked WHERE is_ransomware = 1 OR rk <= positives
)"""


def clamped(column: str) -> str:
    return f"CASE WHEN {column} IS NULL OR {column} < 0 THEN 0.0::DOUBLE ELSE CAST({column} AS DOUBLE) END"


CLAMPS = ", ".join(f"{clamped(c)} AS {c}" for c in ("income", "weight", "count", "looped"))
LOGS = ", ".join(f"round(ln(1 + {c}), 6) AS log_{c}" for c in ("income", "weight", "count", "looped"))
RATIOS = """round((count + neighbors) / nullif(looped + 1, 0), 6) AS activity_index,
  round(weight / nullif(count + 1, 0), 6) AS weight_to_count,
  round(income / nullif(neighbors + 1, 0), 6) AS income_per_neighbor"""
CALENDAR = """CAST((year - 2009) * 365 + day AS INT) AS days_since_2009,
  round(sin(2 * pi() * day / 365), 6) AS sin_day, round(cos(2 * pi() * day / 365), 6) AS cos_day"""


def clamp_cte(source: str, name: str = "clamped") -> str:
    return f"""
{name} AS (
  SELECT * REPLACE ({CLAMPS}, coalesce(year, 2009) AS year, coalesce(day, 0) AS day) FROM {source}
)"""


def state(source: str) -> str:
    spread = "CASE WHEN coalesce(stddev_pop(income), 0) = 0 THEN 1.0 ELSE stddev_pop(income) END"
    return f"""
state AS (
  SELECT 'global' AS scope, CAST(NULL AS INT) AS year, avg(income) AS mean, {spread} AS std FROM {source}
  UNION ALL
  SELECT 'year', year, avg(income), {spread} FROM {source} GROUP BY year
)"""


def zscored(source: str) -> str:
    return f"""
zscored AS (
  SELECT r.*, (r.income - g.mean) / g.std AS income_z, (r.income - y.mean) / y.std AS income_z_by_year
  FROM {source} r
  JOIN (SELECT mean, std FROM state WHERE scope = 'global') g ON true
  LEFT JOIN (SELECT * FROM state WHERE scope = 'year') y ON r.year = y.year
)"""


def uniform(key: str, feature: str) -> str:
    return (
        f"CAST(concat('0x', substr(md5(concat(CAST({key} AS VARCHAR), ':{feature}:42')), 1, 8)) AS BIGINT)"
        " / 4294967296.0"
    )


def injected(source: str, key: str) -> str:
    columns = ", ".join(
        f"CASE WHEN {uniform(key, f)} >= 0.05 THEN {f} END AS {f}" for f in ("income", "neighbors", "weight")
    )
    return f"SELECT {key}, {columns} FROM {source}"


def drawn(source: str) -> str:
    return f"""
numbered AS (
  SELECT *, row_number() OVER (ORDER BY {row_hash('address')}, address) - 1 AS rk FROM {source}
),
draws AS (
  SELECT i AS draw,
    CAST(concat('0x', substr(md5(concat('draw:', CAST(i AS VARCHAR), ':42')), 1, 15)) AS BIGINT)
      % (SELECT count(*) FROM {source}) AS rk
  FROM range(1000) t(i)
),
drawn AS (SELECT draw, numbered.* EXCLUDE (rk) FROM draws JOIN numbered USING (rk))"""


def long_values(source: str, name: str, keep: str = "") -> str:
    parts = [
        f"SELECT {keep} '{f}' AS feature, CAST({f} AS DOUBLE) AS v FROM {source}"
        for f in ("income", "neighbors", "weight")
    ]
    return f"{name} AS ({' UNION ALL '.join(parts)})"


def profiled(source: str) -> str:
    """CTEs ref_values, ref_stats and ref_bins of a profile."""
    return f"""
{long_values(source, 'ref_values')},
ref_moments AS (
  SELECT feature, count(*) AS n_rows, count(v) AS n, avg(v) AS mean, stddev_samp(v) AS std,
    coalesce(skewness(v), 0) AS skew, min(v) AS vmin, max(v) AS vmax
  FROM ref_values GROUP BY feature
),
ref_stats AS (
  SELECT *, CASE WHEN vmin = vmax THEN vmin - 0.5 ELSE vmin END AS lo,
    CASE WHEN vmin = vmax THEN vmax + 0.5 ELSE vmax END AS hi,
    CASE WHEN n < 3 THEN 1 ELSE greatest(1, CAST(round_even(
      1 + log2(n) + log2(1 + abs(skew) / sqrt(6.0 * (n - 2) / ((n + 1.0) * (n + 3.0)))), 0) AS INT)) END AS num_bins
  FROM ref_moments
),
ref_edges AS (
  SELECT feature, CAST(bin AS INT) AS bin, bin = num_bins - 1 AS is_last,
    bin * ((hi - lo) / num_bins) + lo AS e_lo,
    CASE WHEN bin = num_bins - 1 THEN hi ELSE (bin + 1) * ((hi - lo) / num_bins) + lo END AS e_hi
  FROM (SELECT *, unnest(range(num_bins)) AS bin FROM ref_stats)
),
ref_bins AS (
  SELECT e.feature, e.bin, any_value(e.is_last) AS is_last, any_value(e.e_lo) AS e_lo, any_value(e.e_hi) AS e_hi,
    count(r.v) AS n
  FROM ref_edges e LEFT JOIN ref_values r
    ON r.feature = e.feature AND r.v >= e.e_lo AND (r.v < e.e_hi OR (e.is_last AND r.v = e.e_hi))
  GROUP BY e.feature, e.bin
)"""


def drifted(live: str) -> str:
    return f"""
{long_values(live, 'live_values')},
live_bins AS (
  SELECT e.feature, e.bin, any_value(e.n) AS ref_n, count(r.v) AS n
  FROM ref_bins e LEFT JOIN live_values r
    ON r.feature = e.feature AND r.v >= e.e_lo AND (r.v < e.e_hi OR (e.is_last AND r.v = e.e_hi))
  GROUP BY e.feature, e.bin
),
shares AS (
  SELECT feature, ref_n / sum(ref_n) OVER (PARTITION BY feature) + 1e-6 AS p,
    n / sum(n) OVER (PARTITION BY feature) + 1e-6 AS q
  FROM live_bins
),
psi AS (SELECT feature, sum((q - p) * ln(q / p)) AS psi FROM shares GROUP BY feature)
SELECT feature, round(avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_ratio,
  round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(any_value(psi), 6) AS psi,
  CAST(NULL AS VARCHAR) AS reason
FROM live_values JOIN psi USING (feature) GROUP BY feature"""


SCORED = ADDR + """,
scored AS (
  SELECT address AS id, CASE WHEN label <> 'white' THEN 1 ELSE 0 END AS y,
    (address * 7919 % 1000 + CASE WHEN label <> 'white' THEN 300 ELSE 0 END) / CAST(1300 AS DOUBLE) AS score
  FROM addr
),
predicted AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred FROM scored)"""

REPORT = """
cells AS (
  SELECT count(*) FILTER (y = 1 AND pred = 1) AS tp, count(*) FILTER (y = 0 AND pred = 1) AS fp,
    count(*) FILTER (y = 1 AND pred = 0) AS fn, count(*) FILTER (y = 0 AND pred = 0) AS tn FROM predicted
),
per_class AS (
  SELECT '0' AS class, tn AS hit, fn AS wrong, fp AS miss FROM cells
  UNION ALL SELECT '1', tp, fp, fn FROM cells
),
rated AS (
  SELECT class, coalesce(hit / nullif(hit + wrong, 0), 0) AS precision,
    coalesce(hit / nullif(hit + miss, 0), 0) AS recall,
    coalesce(2 * hit / nullif(2 * hit + wrong + miss, 0), 0) AS f1, hit + miss AS support
  FROM per_class WHERE hit + wrong + miss > 0
),
report AS (
  SELECT * FROM rated
  UNION ALL SELECT 'accuracy', (tp + tn) / (tp + fp + fn + tn), (tp + tn) / (tp + fp + fn + tn),
    (tp + tn) / (tp + fp + fn + tn), tp + fp + fn + tn FROM cells
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM rated
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) FROM rated
)"""

AUC = """
by_score AS (
  SELECT score, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM scored GROUP BY score
),
stacked AS (
  SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM by_score
),
auc AS (SELECT sum(pos * (below + neg / 2)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS roc_auc FROM stacked)"""

FOLDS = f"""
folded AS (
  SELECT *, ntile(3) OVER (PARTITION BY y ORDER BY {row_hash('id')}, id) - 1 AS fold FROM predicted
),
sided AS (
  SELECT y, pred, k AS fold, CASE WHEN fold = k THEN 'test' ELSE 'train' END AS split FROM folded, range(3) t(k)
),
fold_cells AS (
  SELECT fold, split, count(*) FILTER (y = 1 AND pred = 1) AS tp, count(*) FILTER (y = 0 AND pred = 1) AS fp,
    count(*) FILTER (y = 1 AND pred = 0) AS fn, count(*) FILTER (y = 0 AND pred = 0) AS tn
  FROM sided GROUP BY fold, split
),
fold_scores AS (
  SELECT fold, split, 'accuracy' AS metric, (tp + tn) / (tp + fp + fn + tn) AS value FROM fold_cells
  UNION ALL SELECT fold, split, 'precision', coalesce(tp / nullif(tp + fp, 0), 0) FROM fold_cells
  UNION ALL SELECT fold, split, 'recall', coalesce(tp / nullif(tp + fn, 0), 0) FROM fold_cells
  UNION ALL SELECT fold, split, 'f1', coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) FROM fold_cells
),
cv AS (SELECT split, metric, avg(value) AS mean, stddev_pop(value) AS std FROM fold_scores GROUP BY split, metric)"""

LOG = """
log AS (
  SELECT event_id, ts, user_id % 4 AS source, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_error,
    CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'purchase' THEN 'ransomware' ELSE 'clean' END AS prediction,
    value / 100 AS latency_seconds
  FROM events
)"""

BUCKETS = """
buckets(le, bound) AS (VALUES
  ('0.005', 0.005::DOUBLE), ('0.01', 0.01::DOUBLE), ('0.025', 0.025::DOUBLE), ('0.05', 0.05::DOUBLE),
  ('0.075', 0.075::DOUBLE), ('0.1', 0.1::DOUBLE), ('0.25', 0.25::DOUBLE), ('0.5', 0.5::DOUBLE),
  ('0.75', 0.75::DOUBLE), ('1.0', 1.0::DOUBLE), ('2.5', 2.5::DOUBLE), ('5.0', 5.0::DOUBLE),
  ('7.5', 7.5::DOUBLE), ('10.0', 10.0::DOUBLE), ('+Inf', 'infinity'::DOUBLE))"""

ALL: dict[str, str] = {}

ALL["csv_ingest"] = f"WITH {ADDR} SELECT * REPLACE (CAST(address AS VARCHAR) AS address) FROM addr"

ALL["live_json"] = f"""WITH {DIRTY}
SELECT CAST(make_date(coalesce(year, 2009), 1, 1) AS TIMESTAMP) AS timestamp, income,
  CAST(neighbors AS DOUBLE) AS neighbors, weight
FROM addr_dirty"""

ALL["live_json_array"] = ALL["live_json"]

ALL["clean_fill"] = f"WITH {DIRTY}, {filled('addr_dirty')} SELECT * EXCLUDE (address) FROM filled"

ALL["class_counts"] = f"""WITH {DIRTY}
SELECT CASE WHEN label IS NULL THEN NULL WHEN label <> 'white' THEN 1 ELSE 0 END AS is_ransomware, count(*) AS n
FROM addr_dirty GROUP BY 1"""

ALL["balanced_sample"] = f"WITH {DIRTY}, {balanced('addr_dirty')} SELECT * EXCLUDE (address) FROM balanced"

ALL["log_features"] = f"""WITH {DIRTY}, clamped AS (SELECT address, {CLAMPS} FROM addr_dirty)
SELECT address, round(income, 6) AS income, round(weight, 6) AS weight, count, looped, {LOGS} FROM clamped"""

ALL["ratio_features"] = f"""WITH {DIRTY}
SELECT address, income, weight, count, looped, neighbors, {RATIOS} FROM addr_dirty"""

ALL["temporal_features"] = f"""WITH {DIRTY},
dated AS (SELECT address, coalesce(year, 2009) AS year, coalesce(day, 0) AS day FROM addr_dirty)
SELECT *, {CALENDAR} FROM dated"""

ALL["stateless_features"] = f"""WITH {DIRTY}, {clamp_cte('addr_dirty')}
SELECT * EXCLUDE (label), {LOGS}, {RATIOS}, {CALENDAR} FROM clamped"""

ALL["zscore_state"] = f"""WITH {DIRTY}, {filled('addr_dirty')}, {clamp_cte('filled')}, {state('clamped')}
SELECT scope, year, round(mean, 6) AS mean, round(std, 6) AS std FROM state"""

ALL["zscore_state_merged"] = ALL["zscore_state"]

ALL["zscore_apply"] = f"""WITH {ADDR}, {state('addr')}, {zscored('addr')}
SELECT address, year, income, round(income_z, 6) AS income_z, round(income_z_by_year, 6) AS income_z_by_year
FROM zscored"""

ALL["zscore_apply_unseen_year"] = f"""WITH {ADDR},
past AS (SELECT * FROM addr WHERE year < (SELECT max(year) FROM addr)), {state('past')}, {zscored('addr')}
SELECT address, year, income, round(income_z, 6) AS income_z, round(income_z_by_year, 6) AS income_z_by_year
FROM zscored"""

ALL["feature_table"] = f"""WITH {ADDR}, {balanced('addr')}, {clamp_cte('balanced')}, {state('clamped')}, {zscored('clamped')}
SELECT is_ransomware, CAST(day AS DOUBLE) AS day, round(weight, 6) AS weight, count, looped,
  CAST(neighbors AS DOUBLE) AS neighbors, {LOGS}, {RATIOS},
  CAST((year - 2009) * 365 + day AS DOUBLE) AS days_since_2009,
  round(sin(2 * pi() * day / 365), 6) AS sin_day, round(cos(2 * pi() * day / 365), 6) AS cos_day,
  round(income_z, 6) AS income_z, round(income_z_by_year, 6) AS income_z_by_year
FROM zscored"""

# Some rows without a label, as the stages get them.
MASKED = ADDR + """,
masked AS (SELECT * REPLACE (CASE WHEN address % 13 <> 0 THEN label END AS label) FROM addr)"""
ALL["stage_features"] = ALL["feature_table"].replace(ADDR, MASKED).replace(balanced("addr"), balanced("masked"))
ALL["stage_rows"] = f"""WITH {MASKED},
counted AS (SELECT count(*) AS n, count(*) FILTER (label IS NULL) AS unlabelled, 2 * count(*) FILTER (label <> 'white') AS balanced FROM masked)
SELECT 'ingest' AS stage, n AS read, unlabelled, n AS kept FROM counted
UNION ALL SELECT 'preprocess', n, unlabelled, balanced FROM counted UNION ALL SELECT 'features', balanced, NULL, balanced FROM counted"""

# Three loads: rows of each class so far, and the places of the new ones among themselves.
LOADS = f"""
classed AS (SELECT address, address % 3 AS load, CASE WHEN label <> 'white' THEN 1 ELSE 0 END AS is_ransomware FROM addr),
loads AS (SELECT load, is_ransomware, count(*) AS own FROM classed GROUP BY 1, 2),
sofar AS (SELECT load, is_ransomware, CAST(sum(own) OVER (PARTITION BY is_ransomware ORDER BY load) AS BIGINT) AS n FROM loads),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY load, is_ransomware ORDER BY {row_hash('address')}, address) AS rk FROM classed
)"""
ALL["split_of_loads"] = f"""WITH {ADDR}, {LOADS},
sizes AS (SELECT *, CAST(sum(n) OVER (PARTITION BY load) AS BIGINT) AS total FROM sofar),
training AS (SELECT *, total - CAST(ceil(total * 0.2::DOUBLE) AS BIGINT) AS train FROM sizes),
shares AS (SELECT *, train * n // total AS whole, train * n % total AS rest FROM training),
granted AS (
  SELECT load, is_ransomware, n - whole - CASE WHEN row_number() OVER (PARTITION BY load ORDER BY rest DESC, is_ransomware)
    <= train - sum(whole) OVER (PARTITION BY load) THEN 1 ELSE 0 END AS n_test
  FROM shares
),
added AS (SELECT load, is_ransomware, n_test - coalesce(lag(n_test) OVER (PARTITION BY is_ransomware ORDER BY load), 0) AS n_test FROM granted)
SELECT address, is_ransomware, CASE WHEN rk <= n_test THEN 'test' ELSE 'train' END AS split
FROM placed JOIN added USING (load, is_ransomware)"""
ALL["folds_of_loads"] = f"""WITH {ADDR}, {LOADS},
folds AS (
  SELECT load, is_ransomware, fold, n // 3 + CASE WHEN fold < n % 3 THEN 1 ELSE 0 END AS size FROM sofar, range(3) f(fold)
),
added AS (SELECT *, size - coalesce(lag(size) OVER (PARTITION BY is_ransomware, fold ORDER BY load), 0) AS own FROM folds),
ends AS (SELECT *, sum(own) OVER (PARTITION BY load, is_ransomware ORDER BY fold) AS upto FROM added)
SELECT address, is_ransomware, CAST(fold AS INT) AS fold
FROM placed JOIN ends USING (load, is_ransomware) WHERE rk <= upto AND rk > upto - own"""

_ROLES = ", ".join(f"('{c}', {i})" for i, c in enumerate(FEATURE_COLUMNS))
ALL["feature_roles"] = f"""WITH {ADDR}, {balanced('addr')}
SELECT 'is_ransomware' AS column, 'target' AS role, CAST(NULL AS INT) AS place, count(*) AS values FROM balanced
UNION ALL SELECT c, 'input', CAST(p AS INT), n FROM (VALUES {_ROLES}) f(c, p), (SELECT count(*) AS n FROM balanced)"""

# Each load balanced by itself, then one state and one growing split over all of them.
_BALANCED_LOADS = balanced("addr").replace("PARTITION BY is_ransomware ORDER BY", "PARTITION BY address % 3, is_ransomware ORDER BY").replace(
    "sum(is_ransomware) OVER ()", "sum(is_ransomware) OVER (PARTITION BY address % 3)")
ALL["features_of_loads"] = f"""WITH {ADDR}, {_BALANCED_LOADS}, {clamp_cte('balanced')}, {state('clamped')}, {zscored('clamped')},
dealt AS ({ALL["split_of_loads"].replace(f"WITH {ADDR},", "WITH").replace("CASE WHEN label <> 'white' THEN 1 ELSE 0 END AS is_ransomware FROM addr", "is_ransomware FROM balanced")})
SELECT address, is_ransomware, round(ln(1 + income), 6) AS log_income, round((count + neighbors) / nullif(looped + 1, 0), 6) AS activity_index,
  round(income_z, 6) AS income_z, round(income_z_by_year, 6) AS income_z_by_year, split
FROM zscored JOIN dealt USING (address, is_ransomware)"""

ALL["stratified_split"] = f"""WITH {ADDR},
classed AS (SELECT address, CASE WHEN label <> 'white' THEN 1 ELSE 0 END AS is_ransomware FROM addr),
sizes AS (SELECT is_ransomware, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM classed GROUP BY 1),
training AS (SELECT *, total - CAST(ceil(total * 0.2::DOUBLE) AS BIGINT) AS train FROM sizes),
shares AS (SELECT *, train * n // total AS whole, train * n % total AS rest FROM training),
granted AS (
  SELECT is_ransomware, n - whole - CASE WHEN row_number() OVER (ORDER BY rest DESC, is_ransomware)
    <= train - sum(whole) OVER () THEN 1 ELSE 0 END AS n_test
  FROM shares
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY is_ransomware ORDER BY {row_hash('address')}, address) AS rk FROM classed
)
SELECT address, is_ransomware, CASE WHEN rk <= n_test THEN 'test' ELSE 'train' END AS split
FROM ranked JOIN granted USING (is_ransomware)"""

ALL["kfold_assignment"] = f"""WITH {ADDR},
classed AS (SELECT address, CASE WHEN label <> 'white' THEN 1 ELSE 0 END AS is_ransomware FROM addr)
SELECT *, CAST(ntile(3) OVER (PARTITION BY is_ransomware ORDER BY {row_hash('address')}, address) - 1 AS INT) AS fold
FROM classed"""

ALL["bootstrap_sample"] = f"""WITH {ADDR}, {drawn('addr')}
SELECT draw, address, income, neighbors, weight FROM drawn"""

ALL["inject_missing"] = f"WITH {ADDR} {injected('addr', 'address')}"

ALL["profile_summary"] = f"""WITH {DIRTY}, {profiled('addr_dirty')}
SELECT feature, n_rows AS rows, n, round((n_rows - n) / n_rows, 6) AS missing_ratio, round(mean, 6) AS mean,
  round(std, 6) AS std, round(skew, 6) AS skew, num_bins, round(lo, 6) AS lo, round(hi, 6) AS hi
FROM ref_stats"""

ALL["profile_summary_merged"] = ALL["profile_summary"]

ALL["profile_histogram"] = f"""WITH {DIRTY}, {profiled('addr_dirty')}
SELECT feature, bin, n, round(e_hi, 6) AS upper_edge FROM ref_bins"""

ALL["drift_psi"] = f"""WITH {ADDR},
early AS (SELECT * FROM addr WHERE year < 1999), late AS (SELECT * FROM addr WHERE year >= 1999),
live AS ({injected('late', 'address')}), {profiled('early')}, {drifted('live')}"""

ALL["drift_job"] = f"""WITH {DIRTY}, {balanced('addr')}, {profiled('balanced')}, {drifted('addr_dirty')}"""

ALL["confusion_report"] = f"""WITH {SCORED}, {REPORT}
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  CAST(support AS BIGINT) AS support FROM report"""

ALL["roc_auc"] = f"WITH {SCORED}, {AUC} SELECT round(roc_auc, 6) AS roc_auc FROM auc"

ALL["cv_summary"] = f"""WITH {SCORED}, {FOLDS}
SELECT split, metric, round(mean, 6) AS mean, round(std, 6) AS std FROM cv"""

ALL["test_summary"] = f"""WITH {SCORED}, {REPORT}, {AUC}, {FOLDS}
SELECT round((SELECT f1 FROM report WHERE class = 'accuracy'), 6) AS accuracy,
  round((SELECT roc_auc FROM auc), 6) AS roc_auc,
  round((SELECT f1 FROM report WHERE class = '1'), 6) AS f1_positive,
  round((SELECT mean FROM cv WHERE split = 'test' AND metric = 'f1'), 6) AS cv_test_f1_mean,
  round((SELECT std FROM cv WHERE split = 'test' AND metric = 'f1'), 6) AS cv_test_f1_std"""

ALL["request_counters"] = f"""WITH {LOG}
SELECT 'prediction_requests' AS metric, '' AS label, count(*) AS value FROM log
UNION ALL SELECT 'prediction_errors', '', count(*) FROM log WHERE is_error = 1
UNION ALL SELECT 'prediction_labels', 'ransomware', count(*) FROM log WHERE is_error = 0 AND prediction = 'ransomware'
UNION ALL SELECT 'prediction_labels', 'clean', count(*) FROM log WHERE is_error = 0 AND prediction = 'clean'"""

ALL["latency_histogram"] = f"""WITH {LOG}, {BUCKETS}
SELECT le, count(*) FILTER (latency_seconds <= bound) AS cumulative_count, count(latency_seconds) AS observations,
  round(sum(latency_seconds), 6) AS total_seconds
FROM log, buckets GROUP BY le"""

ALL["current_run"] = """WITH run_log AS (
  SELECT o_orderkey AS run_id, o_orderpriority AS run_name,
    CASE WHEN o_orderkey % 2300 = 7 THEN NULL ELSE o_orderdate END AS end_time
  FROM orders
),
latest AS (
  SELECT run_name, run_id FROM run_log WHERE end_time IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY run_name ORDER BY end_time DESC, run_id DESC) = 1
),
unfinished AS (
  SELECT run_name, count(*) FILTER (end_time IS NULL) AS unfinished, max(run_id) FILTER (end_time IS NULL) AS open_id
  FROM run_log GROUP BY run_name
)
SELECT run_name, CASE unfinished WHEN 1 THEN open_id WHEN 0 THEN run_id END AS run_id, unfinished,
  CASE WHEN unfinished > 1 THEN 'multiple_unfinished_runs' END AS reason
FROM unfinished LEFT JOIN latest USING (run_name)"""

_READ = ", ".join(
    f"CASE WHEN address % 31 <> 0 THEN CAST({c} AS {'INT' if c == 'year' else 'DOUBLE'}) END AS {c}"
    for c in ("year", "day", "length", "weight", "count", "looped", "neighbors")
)
ALL["request_validation"] = f"""WITH {ADDR}
SELECT address, {_READ},
  CASE WHEN address % 31 <> 0 AND address % 7 <> 0 AND address % 11 <> 0 THEN income END AS income,
  CASE WHEN address % 31 = 0 THEN NULL WHEN address % 7 = 0 THEN 'income' ELSE '' END AS missing_fields,
  CASE WHEN address % 31 = 0 THEN 'invalid_json' WHEN address % 7 = 0 THEN 'missing_fields' END AS reason
FROM addr"""

EPISODES = """
counted AS (
  SELECT source, date_trunc('hour', ts) AS w, count(*) AS requests, count(*) FILTER (is_error = 1) AS errors
  FROM log GROUP BY 1, 2
),
breaching AS (
  SELECT *, w - to_hours(row_number() OVER (PARTITION BY source ORDER BY w)) AS island
  FROM counted WHERE errors / requests > 0.25
),
episodes AS (
  SELECT source, min(w) AS started, max(w) + INTERVAL 1 HOUR AS ended, count(*) AS windows,
    CAST(sum(requests) AS BIGINT) AS requests, CAST(sum(errors) AS BIGINT) AS errors
  FROM breaching GROUP BY source, island HAVING count(*) >= 3
)"""

# Rows may come ten minutes late on the streams.
WATERMARK = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM log)"

ALL["error_rate_alert"] = f"WITH {LOG}, {EPISODES} SELECT * FROM episodes"

ALL["stream_error_alert"] = f"""WITH {LOG}, {EPISODES}
SELECT * FROM episodes WHERE ended + INTERVAL 1 HOUR + INTERVAL 1 MILLISECOND <= {WATERMARK}"""

ALL["stream_down_alert"] = f"""WITH {LOG},
healthy AS (
  SELECT source, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY source ORDER BY ts) + INTERVAL 10 MINUTE
    THEN 1 ELSE 0 END AS fresh
  FROM log WHERE is_error = 0
),
sessions AS (SELECT *, sum(fresh) OVER (PARTITION BY source ORDER BY ts) AS session FROM healthy)
SELECT source, min(ts) AS up_from, max(ts) AS down_from, count(*) AS samples
FROM sessions GROUP BY source, session HAVING max(ts) + INTERVAL 10 MINUTE <= {WATERMARK}"""

ALL["down_alert"] = f"""WITH {LOG},
marks AS (
  SELECT source, ts, 'closed' AS state, 1 AS rank FROM log WHERE is_error = 0
  UNION ALL SELECT source, min(ts), 'closed', 0 FROM log GROUP BY source
  UNION ALL SELECT source, (SELECT max(ts) FROM log), 'open', 2 FROM log GROUP BY source
),
gaps AS (SELECT source, lag(ts) OVER (PARTITION BY source ORDER BY ts, rank) AS down_from, ts AS down_until, state FROM marks)
SELECT source, down_from, down_until, state FROM gaps WHERE down_until >= down_from + INTERVAL 10 MINUTE"""

ALL["stream_down_states"] = ALL["down_alert"]

ALL["stream_error_states"] = f"""WITH {LOG}, {EPISODES}
SELECT *, CASE WHEN ended = (SELECT max(w) + INTERVAL 1 HOUR FROM counted) THEN 'open' ELSE 'closed' END AS state FROM episodes"""

ALL["stream_request_metrics"] = f"""WITH {LOG}
SELECT date_trunc('hour', ts) AS window_start, count(*) AS requests, count(*) FILTER (is_error = 1) AS errors,
  count(*) FILTER (is_error = 0 AND prediction = 'ransomware') AS ransomware,
  count(*) FILTER (is_error = 0 AND prediction = 'clean') AS clean
FROM log GROUP BY 1"""

ALL["stream_latency_histogram"] = f"""WITH {LOG}, {BUCKETS}
SELECT date_trunc('hour', ts) AS window_start, le, count(*) FILTER (latency_seconds <= bound) AS cumulative_count,
  count(latency_seconds) AS observations, round(sum(latency_seconds), 6) AS total_seconds
FROM log, buckets GROUP BY 1, 2"""

_WINDOW = "time_bucket(INTERVAL '90 days', ts, TIMESTAMP '1970-01-01') AS window_start,"
ALL["stream_drift"] = f"""WITH {ADDR}, {profiled('addr')},
dated AS (SELECT *, CAST(make_date(year, 1, 1) AS TIMESTAMP) + to_days(day - 1) AS ts FROM addr),
{long_values('dated', 'live_values', _WINDOW)},
totals AS (
  SELECT window_start, feature, avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END) AS missing_ratio, avg(v) AS mean,
    stddev_samp(v) AS std
  FROM live_values GROUP BY 1, 2
),
live_bins AS (
  SELECT t.window_start, e.feature, e.bin, any_value(e.n) AS ref_n, count(r.v) AS n
  FROM totals t JOIN ref_bins e ON e.feature = t.feature LEFT JOIN live_values r
    ON r.window_start = t.window_start AND r.feature = e.feature
    AND r.v >= e.e_lo AND (r.v < e.e_hi OR (e.is_last AND r.v = e.e_hi))
  GROUP BY 1, 2, 3
),
shares AS (
  SELECT window_start, feature, ref_n / sum(ref_n) OVER (PARTITION BY window_start, feature) + 1e-6 AS p,
    n / sum(n) OVER (PARTITION BY window_start, feature) + 1e-6 AS q
  FROM live_bins
),
psi AS (SELECT window_start, feature, sum((q - p) * ln(q / p)) AS psi FROM shares GROUP BY 1, 2)
SELECT window_start, feature, round(missing_ratio, 6) AS missing_ratio, round(mean, 6) AS mean, round(std, 6) AS std,
  round(psi, 6) AS psi, CAST(NULL AS VARCHAR) AS reason
FROM totals JOIN psi USING (window_start, feature)"""


ALL["stream_error_transitions"] = f"""WITH {LOG}, {EPISODES},
settled AS (SELECT *, w - to_hours(row_number() OVER (PARTITION BY source ORDER BY w)) AS island
  FROM counted WHERE errors / requests > 0.25 AND w + INTERVAL 1 HOUR <= {WATERMARK}),
sofar AS (
  SELECT source, min(w) OVER i AS started, w + INTERVAL 1 HOUR AS moment, count(*) OVER i AS windows,
    CAST(sum(requests) OVER i AS BIGINT) AS requests, CAST(sum(errors) OVER i AS BIGINT) AS errors,
    row_number() OVER (PARTITION BY source, island ORDER BY w DESC) AS place
  FROM settled WINDOW i AS (PARTITION BY source, island ORDER BY w)
)
SELECT source, 'open' AS transition, started, moment, windows, requests, errors FROM sofar WHERE windows = 3
UNION ALL SELECT source, 'closed', started, moment, windows, requests, errors FROM sofar
WHERE place = 1 AND windows >= 3 AND moment + INTERVAL 1 HOUR <= {WATERMARK}"""

ALL["stream_down_transitions"] = f"""WITH {LOG},
settled AS (SELECT * FROM log WHERE time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE <= {WATERMARK}),
marks AS (
  SELECT source, ts, 1 AS rank FROM settled WHERE is_error = 0
  UNION ALL SELECT source, min(ts), 0 FROM settled GROUP BY source
),
stretches AS (SELECT source, ts AS down_from, lead(ts) OVER (PARTITION BY source ORDER BY ts, rank) AS up FROM marks)
SELECT source, 'closed' AS transition, down_from, up AS moment FROM stretches WHERE up >= down_from + INTERVAL 10 MINUTE
UNION ALL SELECT source, 'open', down_from, down_from + INTERVAL 10 MINUTE FROM stretches
WHERE up >= down_from + INTERVAL 10 MINUTE
  OR (up IS NULL AND time_bucket(INTERVAL 10 MINUTE, down_from + INTERVAL 10 MINUTE) + INTERVAL 10 MINUTE <= {WATERMARK})"""

ALL["stream_late_counters"] = f"""WITH {LOG},
mark AS (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM log WHERE event_id % 2 = 0)
SELECT date_trunc('hour', ts) AS window_start, count(*) AS requests, count(*) FILTER (is_error = 1) AS errors,
  count(*) FILTER (is_error = 0 AND prediction = 'ransomware') AS ransomware,
  count(*) FILTER (is_error = 0 AND prediction = 'clean') AS clean,
  count(*) FILTER (event_id % 2 <> 0 AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark) AS late,
  count(latency_seconds) AS observations, round(sum(latency_seconds), 6) AS total_seconds
FROM log, mark GROUP BY 1"""

# The drift of one run: its reference rows and the live rows that came while it was current.
def _drift_of_run(reference: str, live: str) -> str:
    of_run = f"of_run AS (SELECT * FROM addr WHERE {reference}), {profiled('of_run')}"
    moved = ALL["stream_drift"].replace("round(mean, 6)", "round(mean + 1e-8, 6)").replace("round(std, 6)", "round(std + 1e-8, 6)")
    return moved.replace(f"WITH {ADDR},", "WITH").replace(profiled("addr"), of_run).replace("AS ts FROM addr)", f"AS ts FROM addr WHERE {live})")


ALL["stream_drift_runs"] = f"""WITH {ADDR},
run_1 AS ({_drift_of_run("true", "address % 3 <> 0")}),
run_2 AS ({_drift_of_run("address % 2 = 0", "address % 3 = 0")})
SELECT 'run-1' AS run_id, * FROM run_1 UNION ALL SELECT 'run-2', * FROM run_2"""


# A label that one feature decides: the forest's answers are that label.
SEPARABLE = ADDR + """,
separable AS (SELECT * EXCLUDE (label), CASE WHEN count >= 5 THEN 'many-lines' ELSE 'white' END AS label FROM addr)"""
_NAMED = "CASE WHEN count >= 5 THEN 'ransomware' ELSE 'clean' END AS prediction"

ALL["rf_scores"] = f"""WITH {SEPARABLE}, {balanced('separable')},
sizes AS (SELECT is_ransomware, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM balanced GROUP BY 1),
training AS (SELECT *, total - CAST(ceil(total * 0.2::DOUBLE) AS BIGINT) AS train FROM sizes),
shares AS (SELECT *, train * n // total AS whole, train * n % total AS rest FROM training),
granted AS (
  SELECT is_ransomware, n - whole - CASE WHEN row_number() OVER (ORDER BY rest DESC, is_ransomware)
    <= train - sum(whole) OVER () THEN 1 ELSE 0 END AS n_test
  FROM shares
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY is_ransomware ORDER BY {row_hash('address')}, address) AS rk FROM balanced
)
SELECT address, is_ransomware, is_ransomware AS pred, {_NAMED}
FROM placed JOIN granted USING (is_ransomware) WHERE rk <= n_test"""

ALL["rf_learned"] = """
SELECT metric, true AS learned, true AS below_noise FROM (VALUES ('accuracy'), ('precision'), ('recall'), ('f1')) m(metric)"""

ALL["rf_evaluation"] = f"""WITH held_out AS ({ALL["rf_scores"]}),
rows AS (
  SELECT CAST(is_ransomware AS VARCHAR) AS class, count(*) AS support FROM held_out GROUP BY 1
  UNION ALL SELECT name, (SELECT count(*) FROM held_out) FROM (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) n(name)
)
SELECT class, 1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1, support FROM rows
UNION ALL SELECT 'roc_auc', NULL, NULL, 1.0::DOUBLE, NULL"""

ALL["rf_cross_validate"] = """
SELECT CAST(fold AS INT) AS fold, split, metric, 1.0::DOUBLE AS value
FROM range(3) f(fold), (VALUES ('train'), ('test')) s(split), (VALUES ('accuracy'), ('precision'), ('recall'), ('f1')) m(metric)"""

ALL["stream_scores"] = f"""WITH {SEPARABLE}
SELECT address, CASE WHEN address % 31 <> 0 AND address % 7 <> 0 THEN prediction END AS prediction,
  CASE WHEN address % 31 = 0 THEN 'invalid_json' WHEN address % 7 = 0 THEN 'missing_fields' END AS reason
FROM (SELECT address, {_NAMED} FROM separable)"""
