"""Independent SQL for the registered queries.

Each text computes its result from the tables alone, by formulas other than the
library's where there is a choice (running weighted means instead of closed
weights, central sums instead of built-in skewness, sorted quantiles).
"""

from __future__ import annotations

MONTH = "2001-08"
PREVIOUS = "2001-07"
THRESHOLD = 100000
DECAY = f"(1 - 1 / 10.5::DOUBLE)"
STATS = ("max", "min", "sum", "mean", "count", "std", "skew", "mean_ewm", "last_ewm", "avg_diff")
MEASURES = ("quantity", "price", "total")
CUTS = {"train": PREVIOUS, "test": MONTH}


def rounded(x: str) -> str:
    """Seven significant digits (six decimals below 1), in text both engines
    read alike. The offset keeps sums of two-decimal values off the edges."""
    m = f"floor(log10(greatest(abs({x}), 1)))"
    up, down = f"pow(10, greatest(6 - {m}, 0))", f"pow(10, greatest({m} - 6, 0))"
    return f"(sign({x}) * floor(abs({x}) * {up} / {down} + 0.5858) * {down} / {up} + 0.0)"


def round_all(columns, prefix: str = "") -> str:
    return ", ".join(f'{rounded(f"{prefix}{c}")} AS {c}' for c in columns)


ORDER = (
    "order_date, order_id, line_number, product_id, supplier_id, quantity, total, "
    "price, discount, tax, ship_date, return_flag, line_status"
)
LOG_COLUMNS = """o_custkey AS customer_id, l_orderkey AS order_id, l_partkey AS product_id,
  o_orderdate AS order_date, l_quantity AS quantity, l_extendedprice / l_quantity AS price,
  l_extendedprice AS total, l_linenumber AS line_number, l_suppkey AS supplier_id,
  l_discount AS discount, l_tax AS tax, l_shipdate AS ship_date, l_returnflag AS return_flag,
  l_linestatus AS line_status, strftime(o_orderdate, '%Y-%m') AS year_month"""
LOG = f"log AS (SELECT {LOG_COLUMNS} FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
TOTALS = (
    "totals AS (SELECT customer_id, year_month, sum(total) AS total FROM log GROUP BY ALL)"
)


def _back(cut: str, months: int) -> str:
    n = int(cut[:4]) * 12 + int(cut[5:]) - 1 - months
    return f"{n // 12:04d}-{n % 12 + 1:02d}"


def window_frames() -> list[tuple[str, str, str, str]]:
    return [
        (s, f"-{i}", _back(cut, k), _back(cut, 1))
        for s, cut in CUTS.items()
        for i, k in enumerate((1, 2, 3, 5, 7, 12, 20, 23))
    ]


def season_frames() -> list[tuple[str, str, str, str]]:
    return [
        (s, f"-season{i}", _back(cut, k + 2), _back(cut, k))
        for s, cut in CUTS.items()
        for i, k in enumerate((1, 12))
    ]


def _unnested(names: list[str], source: str, extra: str) -> str:
    return " UNION ALL BY NAME ".join(
        f"SELECT {extra}, '{c}' AS name, {c}::DOUBLE AS x FROM {source}" for c in names
    )


def frame_elements(frames: list[tuple[str, str, str, str]]) -> str:
    values = ", ".join(f"('{s}', '{x}', '{lo}', '{hi}')" for s, x, lo, hi in frames)
    return f"""placed AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY {ORDER}) AS rn FROM log),
framed AS (SELECT p.*, f.split, f.suffix FROM placed p
  JOIN (VALUES {values}) f(split, suffix, lo, hi) ON p.year_month BETWEEN f.lo AND f.hi),
elements AS ({_unnested(list(MEASURES), 'framed', 'customer_id, split, suffix, rn')})"""


RUNNING = [
    (f"cumsum_{m}_by_{k}", m, c)
    for k, c in (("cust_id", "customer_id"), ("prod_id", "product_id"), ("order_id", "order_id"))
    for m in ("total", "quantity", "price")
]
DIFFS = ("order_ts", "quantity", "price", "total")
RUNNING_SQL = ", ".join(
    f"sum({m}) OVER (PARTITION BY {c} ORDER BY {ORDER} ROWS UNBOUNDED PRECEDING) AS {n}"
    for n, m, c in RUNNING
)
DIFF_SQL = ", ".join(
    f"{'epoch(order_date)' if c == 'order_ts' else c} - lag({'epoch(order_date)' if c == 'order_ts' else c}) "
    f"OVER (PARTITION BY customer_id ORDER BY {ORDER}) AS {c}_diff"
    for c in DIFFS
)


def history_elements(names: list[str], columns: str) -> str:
    return f"""placed AS (SELECT customer_id, year_month, {columns},
  row_number() OVER (PARTITION BY customer_id ORDER BY {ORDER}) AS rn FROM log),
framed AS (SELECT p.*, f.split, '' AS suffix FROM placed p
  JOIN (VALUES ('train', '{PREVIOUS}'), ('test', '{MONTH}')) f(split, cut) ON p.year_month < f.cut),
elements AS ({_unnested(names, 'framed', 'customer_id, split, suffix, rn')})"""


def stats(elements: str, keys: str = "customer_id, split, suffix, name", out: str = "stats") -> str:
    """CTEs from ``elements(keys, rn, x)`` to the ten statistics, rounded."""
    part = f"PARTITION BY {keys}"
    return f"""{out}_1 AS (SELECT *, count(x) OVER ({part} ORDER BY rn) AS j, avg(x) OVER ({part}) AS mu FROM {elements}),
{out}_2 AS (SELECT *, CASE WHEN x IS NOT NULL THEN
    sum(x * pow({DECAY}, -j)) OVER ({part} ORDER BY rn)
    / sum(CASE WHEN x IS NOT NULL THEN pow({DECAY}, -j) END) OVER ({part} ORDER BY rn) END AS y,
  x - lag(x) OVER ({part} ORDER BY rn) AS d FROM {out}_1),
{out}_3 AS (SELECT {keys}, max(x) AS max, min(x) AS min, coalesce(sum(x), 0) AS sum, avg(x) AS mean,
  count(x)::DOUBLE AS count, stddev_samp(x) AS std,
  CASE WHEN count(x) < 3 THEN NULL WHEN max(x) = min(x) THEN 0
    ELSE sum(pow(x - mu, 3)) / count(x) / pow(sum(pow(x - mu, 2)) / count(x), 1.5)
      * sqrt(count(x) * (count(x) - 1.0)) / (count(x) - 2) END AS skew,
  avg(y) AS mean_ewm, arg_max(y, rn) FILTER (WHERE y IS NOT NULL) AS last_ewm, avg(d) AS avg_diff
  FROM {out}_2 GROUP BY {keys}),
{out} AS (SELECT {keys}, {round_all(STATS)} FROM {out}_3)"""


def pivot(names: list[tuple[str, str]], source: str = "stats", fill: bool = False) -> str:
    """Wide columns ``{{name}}-{{stat}}{{suffix}}``."""
    cols = []
    for name, suffix in names:
        for s in STATS:
            e = f"max({s}) FILTER (WHERE name = '{name}' AND suffix = '{suffix}')"
            cols.append(f'{f"coalesce({e}, 0)" if fill else e} AS "{name}-{s}{suffix}"')
    return ", ".join(cols)


WINDOW_NAMES = [(m, f"-{i}") for i in range(8) for m in MEASURES]
SEASON_NAMES = [(m, f"-season{i}") for i in range(2) for m in MEASURES]
RUNNING_NAMES = [(n, "") for n, _, _ in RUNNING]
DIFF_NAMES = [(f"{c}_diff", "") for c in DIFFS]

DISTINCT = f"""uniques AS (SELECT f.split, customer_id,
  count(DISTINCT order_id)::DOUBLE AS "order_id-nunique", count(DISTINCT product_id)::DOUBLE AS "product_id-nunique"
  FROM log JOIN (VALUES ('train', '{PREVIOUS}'), ('test', '{MONTH}')) f(split, cut) ON year_month < f.cut GROUP BY ALL)"""
SPAN = f"""span AS (SELECT f.split, customer_id,
  min(epoch(order_date)) AS "order_ts-first", max(epoch(order_date)) AS "order_ts-last"
  FROM log JOIN (VALUES ('train', '{PREVIOUS}'), ('test', '{MONTH}')) f(split, cut) ON year_month < f.cut GROUP BY ALL)"""
HABITS = f"""habits AS (SELECT f.split, customer_id,
  (count(*) FILTER (WHERE total > {THRESHOLD}))::DOUBLE AS total_over_300,
  count(*)::DOUBLE AS count_using_shopping,
  sum(total) / count(*) AS total_sum_per_count_using_shopping,
  (count(*) FILTER (WHERE total > {THRESHOLD})) / count(*)::DOUBLE AS total_over_300_ratio
  FROM totals JOIN (VALUES ('train', '{PREVIOUS}'), ('test', '{MONTH}')) f(split, cut) ON year_month < f.cut GROUP BY ALL)"""
LABELS = f"""labels_ AS (SELECT f.split, f.cut AS year_month, c.customer_id,
  coalesce(t.total, 0) AS total, (coalesce(t.total, 0) > {THRESHOLD})::INT AS label
  FROM (SELECT customer_id, min(year_month) AS first FROM log GROUP BY 1) c
  JOIN (VALUES ('train', '{PREVIOUS}'), ('test', '{MONTH}')) f(split, cut) ON c.first < f.cut
  LEFT JOIN totals t ON t.customer_id = c.customer_id AND t.year_month = f.cut)"""
HABIT_COLUMNS = (
    "total_over_300", "count_using_shopping",
    "total_sum_per_count_using_shopping", "total_over_300_ratio",
)


def wide(elements: str, names, extra: str = "") -> str:
    return (
        f"WITH {LOG}, {elements}, {stats('elements')} "
        f"SELECT customer_id, split, {pivot(names)} FROM stats GROUP BY customer_id, split {extra}"
    )


def feature_table(windows=True, seasons=True, history=True, habits=True, keep_outer=False) -> str:
    ctes = [LOG, TOTALS, LABELS]
    parts, cols = [], []
    frames = (window_frames() if windows else []) + (season_frames() if seasons else [])
    if frames:
        names = (WINDOW_NAMES if windows else []) + (SEASON_NAMES if seasons else [])
        ctes += [
            frame_elements(frames).replace("placed AS", "placed_w AS").replace("FROM placed p", "FROM placed_w p")
            .replace("framed AS", "framed_w AS").replace("FROM framed", "FROM framed_w").replace("elements AS", "elements_w AS"),
            stats("elements_w", out="stats_w"),
            f"wide_w0 AS (SELECT customer_id, split, {pivot(names, 'stats_w')} FROM stats_w GROUP BY ALL)",
        ]
        lost = [f"{m}-{s}-season0" for m in MEASURES for s in STATS] if seasons and not keep_outer else []
        kept = ", ".join(f'CASE WHEN "total-sum-season1" IS NOT NULL THEN "{c}" END AS "{c}"' for c in lost)
        ctes.append(f"wide_w AS (SELECT * {f'REPLACE ({kept})' if lost else ''} FROM wide_w0)")
        parts.append("wide_w")
        cols += [f"{n}-{s}{x}" for n, x in names for s in STATS]
    if history:
        names = RUNNING_NAMES + DIFF_NAMES
        ctes += [
            history_elements([n for n, _ in names], f"{RUNNING_SQL}, {DIFF_SQL}"),
            stats("elements", out="stats_h"),
            f"wide_h AS (SELECT customer_id, split, {pivot(names, 'stats_h')} FROM stats_h GROUP BY ALL)",
            DISTINCT, SPAN,
        ]
        parts += ["wide_h", "uniques", "span"]
        cols += [f"{n}-{s}" for n, _ in names for s in STATS]
        cols += ["order_id-nunique", "product_id-nunique", "order_ts-first", "order_ts-last"]
    if habits:
        rounded_habits = round_all(HABIT_COLUMNS)
        ctes += [HABITS, f"habits_r AS (SELECT split, customer_id, {rounded_habits} FROM habits)"]
        parts.append("habits_r")
        cols += HABIT_COLUMNS
    joins = " ".join(f"LEFT JOIN {p} USING (customer_id, split)" for p in parts)
    selected = ", ".join(f'coalesce("{c}", 0) AS "{c}"' for c in cols)
    return (
        f"WITH {', '.join(ctes)} SELECT customer_id, split, labels_.year_month, label, {selected} "
        f"FROM labels_ {joins}"
    )
