"""SQL text per registered query."""

from __future__ import annotations

from oracle.sql import (
    DECAY,
    DIFF_NAMES, DIFF_SQL, DIFFS, DISTINCT, HABIT_COLUMNS, HABITS, LABELS, LOG, MEASURES,
    MONTH, ORDER, PREVIOUS, RUNNING, RUNNING_NAMES, RUNNING_SQL, SEASON_NAMES, SPAN, STATS,
    TOTALS, WINDOW_NAMES, feature_table, frame_elements, history_elements, pivot,
    round_all, rounded, season_frames, stats, wide, window_frames,
)

PRICE = f"* REPLACE ({rounded('price')} AS price)"
SCORES = """scores AS (SELECT c_custkey AS customer_id, (c_custkey * 7919) % 1000 / 1000.0::DOUBLE AS score,
  ((c_custkey * 31) % 7 < 2)::INT AS label, (c_custkey % 5)::INT AS fold FROM customer)"""
DETAILS = f"""SELECT log.*, n_name AS country, p_name AS description FROM log
  JOIN customer ON customer_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON product_id = p_partkey"""
GAPPY = LOG + """, gappy AS (SELECT * REPLACE (CASE WHEN (order_id * 7 + line_number) % 5 <> 0 THEN total END AS total) FROM log)"""
COLUMNS = (
    "customer_id", "order_id", "product_id", "order_date", "quantity", "price", "total",
    "line_number", "supplier_id", "discount", "tax", "ship_date", "return_flag", "line_status",
)
TYPES = {
    "line_number": "int", "order_date": "timestamp_ntz", "ship_date": "timestamp_ntz",
    "return_flag": "string", "line_status": "string", "country": "string",
    "description": "string", "year_month": "string", "customer_id": "bigint",
    "order_id": "bigint", "product_id": "bigint", "supplier_id": "bigint",
}


def per_column(columns, value: str, source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column, {value.format(c=c)} FROM {source}" for c in columns)


def series(source: str, names, chosen) -> str:
    unioned = " UNION ALL ".join(
        f"SELECT customer_id, '{m}' AS series, {m}::DOUBLE AS x, "
        f"row_number() OVER (PARTITION BY customer_id ORDER BY {ORDER}) AS rn FROM {source}"
        for m in names
    )
    return f"elements AS ({unioned}), {stats('elements', 'customer_id, series')} SELECT customer_id, series, {', '.join(chosen)} FROM stats"


def nulls_series() -> str:
    """Weighted means over a series with nulls, by the pairwise definition:
    each row's mean weighs every earlier value by its distance in rows."""
    w = "(1 - 1 / 10.5::DOUBLE)"
    return f"""WITH {GAPPY},
e AS (SELECT customer_id, total AS x, row_number() OVER (PARTITION BY customer_id ORDER BY {ORDER}) AS rn FROM gappy),
y AS (SELECT a.customer_id, a.rn, sum(b.x * pow({w}, a.rn - b.rn)) / sum(pow({w}, a.rn - b.rn)) AS y
  FROM e a JOIN e b ON a.customer_id = b.customer_id AND b.rn <= a.rn AND b.x IS NOT NULL GROUP BY ALL),
elements AS (SELECT customer_id, 'total' AS series, x, rn FROM e),
{stats('elements', 'customer_id, series')},
m AS (SELECT customer_id, avg(y) AS mean_ewm, arg_max(y, rn) AS last_ewm FROM y GROUP BY 1)
SELECT s.customer_id, series, max, min, sum, mean, count, std, skew, avg_diff,
  {rounded('m.mean_ewm')} AS mean_ewm, {rounded('m.last_ewm')} AS last_ewm
FROM stats s LEFT JOIN m USING (customer_id)"""


def running(key: str, column: str) -> str:
    sums = [(n, m) for n, m, c in RUNNING if c == column]
    cols = ", ".join(
        f"sum({m}) OVER (PARTITION BY {column} ORDER BY {ORDER} ROWS UNBOUNDED PRECEDING) AS {n}"
        for n, m in sums
    )
    names = ["price", *(n for n, _ in sums)]
    return f"""WITH {LOG}, r AS (SELECT *, {cols} FROM log)
SELECT {ORDER.replace('price, ', '')}, customer_id, {round_all(names)} FROM r"""


def habit(*names: str) -> str:
    return f"WITH {LOG}, {TOTALS}, {HABITS} SELECT customer_id, split, {round_all(names)} FROM habits"


def blend(n: int) -> str:
    p = " + ".join(f"(c_custkey * {k}) % 1000 / 1000.0::DOUBLE" for k in (7919, 104729, 1299709, 15485863)[:n])
    return f"SELECT c_custkey AS customer_id, {rounded(f'(({p}) / {n})')} AS probability FROM customer"


HABIT_SPLITS = f"""{LOG}, {TOTALS}, {LABELS}, {HABITS},
base AS (SELECT l.customer_id, l.split, l.year_month, l.label, """ + ", ".join(
    f"CASE WHEN l.customer_id % 11 <> 3 THEN h.{c} END AS {c}" for c in HABIT_COLUMNS
) + " FROM labels_ l JOIN habits h USING (customer_id, split))"


def imputed(fill: str) -> str:
    cols = ", ".join(f"coalesce({c}, {fill.format(c=c)}) AS {c}" for c in HABIT_COLUMNS)
    return f"""WITH {HABIT_SPLITS}, filled AS (SELECT * REPLACE ({cols}) FROM base)
SELECT customer_id, split, year_month, label, {round_all(HABIT_COLUMNS)} FROM filled"""


def scaled(formula: str) -> str:
    zero = ", ".join(f"coalesce({c}, 0) AS {c}" for c in HABIT_COLUMNS)
    cols = ", ".join(f"{formula.format(c=c)} AS {c}" for c in HABIT_COLUMNS)
    return f"""WITH {HABIT_SPLITS}, filled AS (SELECT * REPLACE ({zero}) FROM base),
done AS (SELECT * REPLACE ({cols}) FROM filled)
SELECT customer_id, split, year_month, label, {round_all(HABIT_COLUMNS)} FROM done"""


S = "OVER (PARTITION BY split)"
MINMAX = "CASE WHEN max({c}) {s} = min({c}) {s} THEN -1 ELSE ({c} - min({c}) {s}) / (max({c}) {s} - min({c}) {s}) * 2 - 1 END".replace("{s}", S)
TRAIN_LO = "(SELECT min({c}) FROM filled WHERE split = 'train')"
TRAIN_HI = "(SELECT max({c}) FROM filled WHERE split = 'train')"
MINMAX_TRAIN = f"({{c}} - {TRAIN_LO}) / coalesce(nullif({TRAIN_HI} - {TRAIN_LO}, 0), 1) * 2 - 1"
STANDARD = "({c} - avg({c}) {s}) / coalesce(nullif(stddev_pop({c}) {s}, 0), 1)".replace("{s}", S)
ROBUST = "({c} - quantile_cont({c}, 0.5) {s}) / coalesce(nullif(quantile_cont({c}, 0.75) {s} - quantile_cont({c}, 0.25) {s}, 0), 1)".replace("{s}", S)


def scale_quantile() -> str:
    zero = ", ".join(f"coalesce({c}, 0) AS {c}" for c in HABIT_COLUMNS)
    long = " UNION ALL ".join(
        f"SELECT customer_id, split, year_month, label, '{c}' AS name, {c}::DOUBLE AS x FROM filled" for c in HABIT_COLUMNS
    )
    cols = ", ".join(f"max(z) FILTER (WHERE name = '{c}') AS {c}" for c in HABIT_COLUMNS)
    return f"""WITH {HABIT_SPLITS}, filled AS (SELECT * REPLACE ({zero}) FROM base), long AS ({long}),
sorted AS (SELECT split, name, list_sort(list(x)) AS v, count(*) AS n, least(count(*), 1000) AS k FROM long GROUP BY ALL),
spots AS (SELECT split, name, v, n, k, unnest(range(k)) AS i FROM sorted),
knots AS (SELECT split, name, i, k, i / greatest(k - 1, 1)::DOUBLE AS p, (i * (n - 1)) % greatest(k - 1, 1) / greatest(k - 1, 1)::DOUBLE AS f,
  v[(i * (n - 1)) // greatest(k - 1, 1) + 1] AS a, v[least((i * (n - 1)) // greatest(k - 1, 1) + 2, n)] AS b FROM spots),
knot AS (SELECT split, name, p, a + (b - a) * f AS q FROM knots),
vals AS (SELECT DISTINCT split, name, x FROM long),
bounds AS (SELECT v.split, v.name, v.x,
  max(q) FILTER (WHERE q <= x) AS ql, max(p) FILTER (WHERE q <= x) AS pl,
  min(q) FILTER (WHERE q >= x) AS qh, min(p) FILTER (WHERE q >= x) AS ph,
  min(q) AS lo, max(q) AS hi
  FROM vals v JOIN knot USING (split, name) GROUP BY ALL),
placed AS (SELECT split, name, x, CASE WHEN x <= lo THEN 0 WHEN x >= hi THEN 1
  WHEN ql = qh THEN (pl + ph) / 2 ELSE pl + (ph - pl) * (x - ql) / (qh - ql) END AS z FROM bounds),
done AS (SELECT customer_id, split, year_month, label, {cols} FROM long JOIN placed USING (split, name, x) GROUP BY ALL)
SELECT customer_id, split, year_month, label, {round_all(HABIT_COLUMNS)} FROM done"""


# Band limits and names.
BANDS = (
    (0, "minus"), (20, "very low"), (40, "low"), (70, "middle-low"), (100, "middle"),
    (150, "middle-high"), (200, "almost"), (250, "high"), (270, "higgh"), (300, "hiigh"),
    (325, "veeery high"), (350, "very high"), (500, "very hiigh"), (1000, "super high"),
)
BAND_SQL = "CASE " + " ".join(f"WHEN a < {b} THEN '{n}'" for b, n in BANDS) + " ELSE 'epic high' END"
AUC = """SELECT {key} avg(auc) AS auc FROM (SELECT {key} (sum(r) FILTER (WHERE label = 1) - p * (p + 1) / 2.0) / (p * (n - p)::DOUBLE) AS auc
  FROM (SELECT *, rank() OVER ({part} ORDER BY score) + (count(*) OVER ({part2} score) - 1) / 2.0 AS r,
    sum(label) OVER ({part}) AS p, count(*) OVER ({part}) AS n FROM scores) GROUP BY {key} p, n)"""


ORACLES: dict[str, str] = {
    "feature_table": feature_table(),
    "retail_log": f"WITH {LOG} SELECT {PRICE} FROM ({DETAILS})",
    "log_csv": f"""WITH {LOG} SELECT order_id::VARCHAR AS order_id, product_id::VARCHAR AS product_id, description,
  quantity, order_date, {rounded('price')} AS price, customer_id, country, total, year_month FROM ({DETAILS})""",
    "feature_roundtrip": "SELECT * EXCLUDE (split, year_month) FROM ("
    + feature_table(windows=False, history=False) + ") WHERE split = 'train'",
    "score_export": "SELECT c_custkey AS customer_id, (c_custkey * 7919) % 1000 / 1000.0::DOUBLE AS probability FROM customer",
    "month_key": f"WITH {LOG} SELECT order_date, year_month, count(*) AS rows FROM log GROUP BY ALL",
    "month_windows": f"""WITH {LOG}, w AS (SELECT * FROM (VALUES {', '.join(str((s, x[1:], lo, hi)) for s, x, lo, hi in window_frames() + season_frames())}) t(split, name, first, last))
SELECT split, name, first, strftime((last || '-01')::DATE + INTERVAL 1 MONTH, '%Y-%m') AS until,
  count(*) AS rows, {rounded('sum(total)')} AS total FROM log JOIN w ON year_month BETWEEN first AND last GROUP BY split, name, first, last""",
    "history_before": f"WITH {LOG} SELECT {PRICE.replace('*', '* EXCLUDE (cut)', 1)} FROM log JOIN (VALUES ('train', '{PREVIOUS}'), ('test', '{MONTH}')) f(split, cut) ON year_month < cut",
    "first_customer_rows": f"WITH {LOG} SELECT {PRICE} FROM log WHERE customer_id = (SELECT min(customer_id) FROM log)",
    "alpha_codes": "SELECT DISTINCT code AS product_id FROM (SELECT CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE p_brand END AS code FROM part) WHERE regexp_full_match(code, '[A-Za-z]+')",
    "log_head": f"WITH {LOG} SELECT {PRICE} FROM (SELECT * FROM log ORDER BY {ORDER} LIMIT 5)",
    "column_info": f"WITH {LOG}, d AS ({DETAILS}) SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column, '{TYPES.get(c, 'double')}' AS type, count({c}) AS non_null FROM d"
        for c in (*COLUMNS, "country", "description", "year_month")
    ) + ")",
    "null_counts": f"WITH {GAPPY} " + per_column((*COLUMNS, "year_month"), "count(*) - count({c}) AS nulls", "gappy"),
    "null_ratio": f"WITH {GAPPY} " + per_column(
        (*COLUMNS, "year_month"), rounded("((count(*) - count({c})) / count(*)::DOUBLE)") + " AS null_ratio", "gappy"
    ),
    "describe_numeric": f"WITH {LOG} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS column, count({c}) AS count, {rounded(f'avg({c})')} AS mean, {rounded(f'stddev_samp({c})')} AS std,
  {rounded(f'min({c})')} AS min, {rounded(f'quantile_cont({c}, 0.25)')} AS "25%", {rounded(f'quantile_cont({c}, 0.5)')} AS "50%",
  {rounded(f'quantile_cont({c}, 0.75)')} AS "75%", {rounded(f'max({c})')} AS max FROM log""" for c in MEASURES
    ),
    "table_shape": "SELECT 'log' AS table, count(*) AS rows, 17 AS columns FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey JOIN nation ON c_nationkey = n_nationkey UNION ALL SELECT 'keys', count(*), 2 FROM customer",
    "key_coverage": f"WITH {LOG} SELECT count(*) AS keys_in_log FROM customer WHERE c_custkey IN (SELECT customer_id FROM log)",
    "date_range": f"WITH {LOG} SELECT min(order_date) AS first, max(order_date) AS last FROM log",
    "distinct_keys": f"WITH {LOG} SELECT 'customer_id' AS column, count(DISTINCT customer_id) AS distinct_values FROM log UNION ALL SELECT 'product_id', count(DISTINCT product_id) FROM log",
    "log_by_month": f"WITH {LOG} SELECT year_month, {rounded('sum(total)')} AS total FROM log GROUP BY year_month",
    "monthly_totals": f"WITH {LOG} SELECT year_month, {rounded('sum(total)')} AS total FROM log GROUP BY year_month",
    "price_histogram": f"""WITH {LOG}, b AS (SELECT min(price) AS lo, max(price) AS hi, count(*) AS n FROM log),
h AS (SELECT least(floor((price - lo) / ((hi - lo) / 500)), 499)::INT AS bin, count(*) AS c FROM log, b GROUP BY 1)
SELECT r.bin::INT AS bin, {rounded('(lo + r.bin * ((hi - lo) / 500))')} AS "left", coalesce(c, 0) AS count,
  {rounded('(coalesce(c, 0) / (n * ((hi - lo) / 500)))')} AS density FROM range(500) r(bin) CROSS JOIN b LEFT JOIN h ON h.bin = r.bin""",
    "label_month": f"WITH {LOG}, {TOTALS}, {LABELS} SELECT customer_id, split, year_month, {rounded('total')} AS total, label FROM labels_",
    "feature_csv": f"WITH {LOG}, {TOTALS}, {LABELS}, {HABITS} SELECT customer_id, split, l.year_month, label, {', '.join(f'coalesce({rounded(c)}, 0) AS {c}' for c in HABIT_COLUMNS)} FROM labels_ l LEFT JOIN habits h USING (customer_id, split)",
    "customer_month_totals": f"WITH {LOG}, {TOTALS} SELECT customer_id, year_month, {rounded('total')} AS total FROM totals",
    "months_over": habit("total_over_300"),
    "months_active": habit("count_using_shopping"),
    "months_over_ratio": habit("total_over_300_ratio"),
    "spend_per_month": habit("total_sum_per_count_using_shopping"),
    "habit_features": habit(*HABIT_COLUMNS),
    "spend_band": f"""WITH {LOG}, {TOTALS}, s AS (SELECT customer_id, sum(total / 500) / count(*) AS a FROM totals WHERE year_month < '{MONTH}' GROUP BY 1)
SELECT customer_id, {rounded('a')} AS total_sum_per_count_using_shopping, {BAND_SQL} AS total_sum_per_count_using_shopping_cat FROM s""",
    "recency_score": f"""WITH {LOG}, l AS (SELECT f.split, customer_id, max(year_month) AS m FROM log
  JOIN (VALUES ('train', '{PREVIOUS}'), ('test', '{MONTH}')) f(split, cut) ON year_month < f.cut GROUP BY ALL)
SELECT customer_id, split, (24 - datediff('month', (m || '-01')::DATE, DATE '{PREVIOUS}-01') % 12)::INT AS last_month_shopping FROM l""",
    "series_stats": f"WITH {LOG}, " + series("log", MEASURES, STATS[:7]),
    "series_ewm": f"WITH {LOG}, " + series("log", MEASURES, ("mean_ewm", "last_ewm")),
    "avg_diff": f"WITH {LOG}, " + series("log", MEASURES, ("avg_diff",)),
    "series_with_nulls": nulls_series(),
    "cumsum_customer": running("cust_id", "customer_id"),
    "cumsum_product": running("prod_id", "product_id"),
    "cumsum_order": running("order_id", "order_id"),
    "consecutive_diff": f"""WITH {LOG}, r AS (SELECT *, {DIFF_SQL} FROM log)
SELECT {ORDER.replace('price, ', '')}, customer_id, {round_all(['price', *(f'{c}_diff' for c in DIFFS)])} FROM r""",
    "window_stats": wide(frame_elements(window_frames()), WINDOW_NAMES),
    "season_stats_outer": wide(frame_elements(season_frames()), SEASON_NAMES),
    "season_stats": wide(
        frame_elements(season_frames()), SEASON_NAMES, "HAVING count(*) FILTER (WHERE suffix = '-season1') > 0"
    ),
    "cumsum_features": f"""WITH {LOG}, {history_elements([n for n, _ in RUNNING_NAMES], RUNNING_SQL)}, {stats('elements')}, {DISTINCT},
w AS (SELECT customer_id, split, {pivot(RUNNING_NAMES)} FROM stats GROUP BY ALL) SELECT * FROM w JOIN uniques USING (customer_id, split)""",
    "diff_features": f"""WITH {LOG}, {history_elements([n for n, _ in DIFF_NAMES], DIFF_SQL)}, {stats('elements')}, {SPAN},
w AS (SELECT customer_id, split, {pivot(DIFF_NAMES)} FROM stats GROUP BY ALL) SELECT w.*,
{rounded('"order_ts-first"')} AS "order_ts-first", {rounded('"order_ts-last"')} AS "order_ts-last" FROM w JOIN span USING (customer_id, split)""",
    "categorical_index": "SELECT c_custkey AS customer_id, c_mktsegment AS segment, dense_rank() OVER (ORDER BY c_mktsegment) AS segment_index FROM customer",
    "impute_zero": imputed("0"),
    "impute_mean": imputed("(SELECT avg({c}) FROM base WHERE split = 'train')"),
    "impute_median": imputed("(SELECT quantile_cont({c}, 0.5) FROM base WHERE split = 'train')"),
    "scale_minmax": scaled(MINMAX),
    "scale_minmax_train_fit": scaled(MINMAX_TRAIN),
    "scale_standard": scaled(STANDARD),
    "scale_robust": scaled(ROBUST),
    "scale_quantile": scale_quantile(),
    "stratified_folds": f"""WITH {SCORES} SELECT customer_id, score, label,
  ((row_number() OVER (PARTITION BY label ORDER BY md5(customer_id::VARCHAR || '-42'), customer_id) - 1) % 10)::INT AS fold FROM scores""",
    "auc_pooled": f"WITH {SCORES}, q AS ({AUC.format(key='', part='', part2='PARTITION BY')}) SELECT {rounded('auc')} AS auc FROM q",
    "auc_fold_mean": f"WITH {SCORES}, q AS ({AUC.format(key='fold,', part='PARTITION BY fold', part2='PARTITION BY fold,')} GROUP BY fold) SELECT {rounded('avg(auc)')} AS auc FROM q",
    "roc_curve": f"""WITH {SCORES}, c AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scores GROUP BY 1),
r AS (SELECT *, sum(pos) OVER d AS tp, sum(neg) OVER d AS fp, lead(pos) OVER d AS np, lead(neg) OVER d AS nn, row_number() OVER d AS i FROM c WINDOW d AS (ORDER BY score DESC)),
k AS (SELECT score AS threshold, fp / (SELECT sum(neg) FROM c)::DOUBLE AS fpr, tp / (SELECT sum(pos) FROM c)::DOUBLE AS tpr FROM r WHERE i = 1 OR np IS NULL OR np <> pos OR nn <> neg)
SELECT threshold, {round_all(['fpr', 'tpr'])} FROM k UNION ALL SELECT NULL, 0.0::DOUBLE, 0.0::DOUBLE""",
    "fold_average": blend(3),
    "top_trials": f"""SELECT c_custkey AS trial, {rounded('(0.03::DOUBLE + 0.04::DOUBLE * ((c_custkey * 13) % 101) / 100)')} AS learning_rate,
  {rounded('(0.5::DOUBLE + 0.5::DOUBLE * ((c_custkey * 17) % 103) / 102)')} AS subsample, {rounded('((c_custkey * 104729) % 997 / 997.0::DOUBLE)')} AS value
FROM customer ORDER BY (c_custkey * 104729) % 997 DESC, c_custkey LIMIT 30""",
    "blend_2": blend(2),
    "blend_3": blend(3),
    "blend_4": blend(4),
    "blend_files": blend(3),
}

_CONFUSION = """count(*) FILTER (WHERE score <= 0.5 AND label = 0) AS tn, count(*) FILTER (WHERE score > 0.5 AND label = 0) AS fp,
count(*) FILTER (WHERE score <= 0.5 AND label = 1) AS fn, count(*) FILTER (WHERE score > 0.5 AND label = 1) AS tp"""
_METRICS = f"""tn, fp, fn, tp, {rounded('coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0)')} AS precision, {rounded('coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0)')} AS recall,
{rounded('(tn / nullif(tn + fp, 0)::DOUBLE)')} AS true_negative_rate, {rounded('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0)')} AS f1"""
ORACLES |= {
    "confusion_matrix": f"WITH {SCORES} SELECT {_CONFUSION} FROM scores",
    "score_metrics": f"WITH {SCORES}, m AS (SELECT {_CONFUSION} FROM scores) SELECT {_METRICS} FROM m",
    "fold_metrics": f"WITH {SCORES}, m AS (SELECT fold, {_CONFUSION} FROM scores GROUP BY fold) SELECT fold, {_METRICS} FROM m",
}

# Month states, the feature table from a grown store, and tables joined by bucket.
_STATE = ("total", "mean", "variance", "skewness", "low", "high", "first", "last", "decayed")
ORACLES |= {
    "month_states": f"""WITH {LOG}, placed AS (SELECT *, row_number() OVER (PARTITION BY customer_id, year_month ORDER BY {ORDER}) AS rn,
  count(*) OVER (PARTITION BY customer_id, year_month) AS n FROM log),
elements AS ({" UNION ALL ".join(f"SELECT customer_id, year_month, rn, n, '{m}' AS measure, {m}::DOUBLE AS x FROM placed" for m in ("quantity", "price", "total"))}),
centred AS (SELECT *, avg(x) OVER (PARTITION BY customer_id, year_month, measure) AS mu FROM elements),
s AS (SELECT customer_id, year_month, measure, count(*) AS rows, sum(x) AS total, avg(x) AS mean, avg(pow(x - mu, 2)) AS variance,
  CASE WHEN min(x) = max(x) THEN 0 ELSE avg(pow(x - mu, 3)) / pow(avg(pow(x - mu, 2)), 1.5) END AS skewness, min(x) AS low, max(x) AS high,
  arg_min(x, rn) AS first, arg_max(x, rn) AS last, sum(x * pow({DECAY}, n - rn)) AS decayed FROM centred GROUP BY ALL)
SELECT customer_id, year_month, measure, rows, {round_all(_STATE)} FROM s""",
    "incremental_features": feature_table(),
    "bucketed_assembly": f"""WITH {LOG}, {TOTALS}, {LABELS}, t AS ({feature_table()}),
f AS (SELECT customer_id, total, label, ((row_number() OVER (PARTITION BY label ORDER BY md5(customer_id::VARCHAR || '-42'), customer_id) - 1) % 10)::INT AS fold
  FROM labels_ WHERE split = 'train')
SELECT t.* EXCLUDE (split, label), {rounded('f.total')} AS total, f.label, f.fold, {rounded('((c_custkey * 7919) % 1000 / 1000.0::DOUBLE)')} AS probability
FROM t LEFT JOIN f USING (customer_id) LEFT JOIN customer ON c_custkey = t.customer_id WHERE t.split = 'train'""",
}

# Optional blocks and label means of categories.
ORACLES |= {
    "optional_features": f"""WITH {LOG}, {TOTALS}, {LABELS}, {HABITS}, r AS (SELECT f.split, customer_id, max(year_month) AS m FROM log
  JOIN (VALUES ('train', '{PREVIOUS}'), ('test', '{MONTH}')) f(split, cut) ON year_month < f.cut GROUP BY ALL),
b AS (SELECT *, total_sum_per_count_using_shopping AS a FROM habits)
SELECT customer_id, split, l.year_month, label, {', '.join(f'coalesce({rounded(c)}, 0) AS {c}' for c in HABIT_COLUMNS)},
  {BAND_SQL} AS total_sum_per_count_using_shopping_cat, (24 - datediff('month', (m || '-01')::DATE, DATE '{PREVIOUS}-01') % 12)::INT AS last_month_shopping
FROM labels_ l LEFT JOIN b USING (customer_id, split) LEFT JOIN r USING (customer_id, split)""",
    "category_targets": f"""WITH {SCORES}, rows AS (SELECT customer_id, label, c_mktsegment AS segment FROM scores JOIN customer ON c_custkey = customer_id),
placed AS (SELECT *, row_number() OVER o - 1 AS n, sum(label) OVER o - label AS s FROM rows WHERE customer_id % 3 <> 0
  WINDOW o AS (PARTITION BY segment ORDER BY md5(customer_id::VARCHAR || '-42'), customer_id)),
means AS (SELECT segment, (sum(label) + 0.5) / (count(*) + 1) AS t FROM rows WHERE customer_id % 3 <> 0 GROUP BY 1)
SELECT customer_id, label, {rounded('((s + 0.5) / (n + 1))')} AS segment_target FROM placed
UNION ALL SELECT customer_id, label, {rounded('coalesce(t, 0.5)')} FROM rows LEFT JOIN means USING (segment) WHERE customer_id % 3 = 0""",
}
