"""Feature blocks at customer grain.

Month ranges (windows and seasons) merge month states, see states.py: a row is read
once for all ranges of both splits. Series over the whole history come from a customer
scan: each row is placed in its customer's history once, and then adds one element to
every series it belongs to; the ten statistics are ordinary aggregates over those
elements. Customers with nulls between values take the second way for ranges too.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from spendcast.functions.months import (
    SEASON_MONTHS,
    TRAILING_MONTHS,
    MonthRange,
    cutoffs,
    month_number,
    month_number_sql,
    seasons,
    shift_month,
    trailing_windows,
)
from spendcast.operators import histories
from spendcast.operators.scan import DEFAULT_LIMITS, HOT_ROWS, ScanLimits, hot_by_keys, hot_keys, scan
from spendcast.operators.series import STATS, summarise
from spendcast.operators.states import month_states, range_stats
from spendcast.session import cut_lineage
from spendcast.sources.log import MEASURES, ORDER, TIE_BREAKERS, month_range, row_order
from spendcast.sources.scratch import drop_folder, in_slices, slices_of, stored

SPLITS = ("train", "test")
PLACE = "__place"
ITEMS = 16  # room for the value columns of one frame
# Keys, measures and columns as they appear in feature names.
RUNNING_KEYS = {"cust_id": "customer_id", "prod_id": "product_id", "order_id": "order_id"}
RUNNING_MEASURES = ("total", "quantity", "price")
DIFF_COLUMNS = ("order_ts", "quantity", "price", "total")


@dataclass(frozen=True)
class Frame:
    """Value columns of one split over a month range. Frames of both splits
    that give the same features share a ``slot``."""

    slot: int
    split: str
    months: MonthRange
    values: tuple[str, ...]
    suffix: str = ""


def running_name(measure: str, key: str) -> str:
    return f"cumsum_{measure}_by_{key}"


RUNNING_VALUES = tuple(running_name(m, key) for key in RUNNING_KEYS for m in RUNNING_MEASURES)
DIFF_VALUES = tuple(f"{c}_diff" for c in DIFF_COLUMNS)


def window_frames(month: str) -> list[Frame]:
    return [
        Frame(i, split, months, MEASURES, f"-{months.name}")
        for split, cut in cutoffs(month).items()
        for i, months in enumerate(trailing_windows(cut))
    ]


def season_frames(month: str) -> list[Frame]:
    return [
        Frame(len(TRAILING_MONTHS) + i, split, months, MEASURES, f"-{months.name}")
        for split, cut in cutoffs(month).items()
        for i, months in enumerate(seasons(cut))
    ]


def history_frames(month: str, values: tuple[str, ...]) -> list[Frame]:
    slot = len(TRAILING_MONTHS) + len(SEASON_MONTHS)
    return [
        Frame(slot, split, MonthRange("all", None, cut), values)
        for split, cut in cutoffs(month).items()
    ]


def order_seconds(ts: Column) -> Column:
    """Whole seconds since 1970, by wall clock."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, ts.cast("timestamp_ntz")).cast("double")


def history_before(log: DataFrame, month: str) -> DataFrame:
    """Rows strictly before a month; rows without a customer or date never count."""
    return month_range(log, until=month).filter(F.col("customer_id").isNotNull())


def hot_by_key(rows: DataFrame, keys: Iterable[str], limits: ScanLimits) -> dict[str, DataFrame]:
    """The values of each key column that have too many rows for one task, in one pass."""
    return hot_by_keys(rows, {k: [k] for k in keys}, limits)


def prepared(log: DataFrame, first: str | None = None, until: str | None = None) -> DataFrame:
    """The rows and columns that features read, stored: a log that is a join or a
    scan of text is then read once, and afterwards as often as needed."""
    rows = month_range(log, first, until).filter(F.col("customer_id").isNotNull())
    return stored(rows.select("customer_id", "year_month", *dict.fromkeys([*row_order(log), *MEASURES])), "history", "order_id")


@dataclass(frozen=True)
class LogFacts:
    """What planning needs to know of a history: whether any measure is null, and
    the keys too large for one task."""

    nulls: bool
    hot: Mapping[str, DataFrame]

    @classmethod
    def of(
        cls, history: DataFrame, keys: Iterable[str] = ("customer_id",),
        limits: ScanLimits = DEFAULT_LIMITS,
    ) -> LogFacts:
        """One narrow pass for the nulls, one for the rows of all keys."""
        counted = history.agg(
            F.count(F.lit(1)).alias("rows"), *(F.count(m).alias(m) for m in MEASURES)
        ).first()
        return cls(any(counted[m] < counted["rows"] for m in MEASURES), hot_by_key(history, keys, limits))


def running_sums(
    log: DataFrame,
    keys: Iterable[str] = RUNNING_KEYS,
    *,
    limits: ScanLimits = DEFAULT_LIMITS,
    facts: LogFacts | None = None,
) -> DataFrame:
    """Running sums of the measures by customer, product and/or order.

    Rows whose key is null keep null sums.
    """
    order = row_order(log)
    keys = list(keys)
    hot = facts.hot if facts else hot_by_key(log, [RUNNING_KEYS[k] for k in keys], limits)
    for key in keys:
        column = RUNNING_KEYS[key]
        sums = {running_name(m, key): m for m in RUNNING_MEASURES}
        log = scan(log, [column], order, sums=sums, limits=limits, hot=hot.get(column))
        log = log.withColumns({n: F.when(F.col(column).isNotNull(), F.col(n)) for n in sums})
    return log


def consecutive_differences(log: DataFrame, *, limits: ScanLimits = DEFAULT_LIMITS) -> DataFrame:
    """Difference to the customer's previous row: time, quantity, price, total."""
    rows = log.withColumn("order_ts", order_seconds(F.col("order_date")))
    lags = {f"__lag_{c}": c for c in DIFF_COLUMNS}
    placed = scan(rows, ["customer_id"], row_order(log), lags=lags, limits=limits)
    return placed.withColumns(
        {f"{c}_diff": F.col(c) - F.col(f"__lag_{c}") for c in DIFF_COLUMNS}
    ).drop(*lags)


def frame_features(
    log: DataFrame, month: str, frames: Sequence[Frame], *, limits: ScanLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Wide statistics ``(customer_id, split, ...)`` of the given frames."""
    return wide_features(prepared(log, frames_start(frames), month), month, frames, limits)


def wide_features(log: DataFrame, month: str, frames: Sequence[Frame], limits: ScanLimits = DEFAULT_LIMITS) -> DataFrame:
    """``frame_features`` of a prepared log."""
    packed, columns = packed_features(log, month, frames, limits=limits)
    return packed.selectExpr(
        "customer_id", "split", *(f"{e} AS `{name}`" for name, e in columns.items())
    )


def frames_start(frames: Sequence[Frame]) -> str | None:
    """The first month any frame reads; None for all history."""
    firsts = [f.months.first for f in frames]
    return None if None in firsts else min(firsts)


def packed_features(
    log: DataFrame, month: str, frames: Sequence[Frame], *, limits: ScanLimits = DEFAULT_LIMITS
) -> tuple[DataFrame, dict[str, str]]:
    """``(customer_id, split, m)`` with all statistics in one map, and the SQL
    that reads each feature from it. Joins then move one column, not hundreds.

    The log is read several times, see ``prepared``. Whole histories alone come with a
    column per statistic instead of the map.
    """
    if not month_frames(frames):
        return history_stats(log, month, frames, limits)
    found = [stats(log, month, part, limits) for stats, part in ((row_stats, whole_frames(frames)), (monthly_stats, month_frames(frames))) if part]
    # At most one entry per series: the map is bounded by the feature list.
    wide = reduce(DataFrame.unionByName, found).groupBy("customer_id", "split").agg(F.expr(f"{STATS_MAP} AS m"))
    packed = wide.selectExpr("customer_id", "if(split = 0, '{}', '{}') AS split".format(*SPLITS), "m")
    return packed, feature_columns(frames, "m[{}]")


def history_stats(log: DataFrame, month: str, frames: Sequence[Frame], limits: ScanLimits = DEFAULT_LIMITS) -> tuple[DataFrame, dict[str, str]]:
    """``(customer_id, split, ...)`` with a column per statistic of whole histories, the
    distinct counts if they hold running sums, and the SQL of each feature.

    Most customers are taken in numpy, see histories.py. Those with gaps, with values
    that are not finite or with more rows than one task may hold are summed by Spark."""
    history = history_before(log, month)
    order, values = row_order(log), frames[0].values
    running, diffs = any(v in RUNNING_VALUES for v in values), any(v in DIFF_VALUES for v in values)
    facts = LogFacts.of(history, RUNNING_KEYS.values() if running else ("customer_id",), limits)
    keyed = " OR ".join(["false", *(f"{c} IS NULL" for c in RUNNING_KEYS.values() if running)])
    finite = " AND ".join(f"coalesce(abs(double({m})) < double('inf'), false)" for m in MEASURES)
    odd = history.filter(f"NOT ({finite}) OR {keyed}").select("customer_id").distinct()
    odd = cut_lineage(odd.unionByName(facts.hot["customer_id"].select("customer_id")).distinct())
    some = not odd.isEmpty()

    names = {f"x{i}_{s}": f"m[{frames[0].slot * ITEMS + i}].{s}" for i in range(len(values)) for s in STATS}
    uniques = DISTINCT_COLUMNS if running else {}
    columns = {f"{v}-{s}": f"x{i}_{s}" for i, v in enumerate(values) for s in STATS}
    age = F.expr(f"{month_number(month)} - {month_number_sql('year_month')}")
    rows = history.select("customer_id", age.alias("__age"), *dict.fromkeys([*order, *MEASURES]))
    slices, folder = slices_of(log), None
    if running:
        rows, order, folder = by_order_and_product(rows, order, limits, facts, slices)
    if diffs:
        rows = rows.withColumn("order_ts", order_seconds(F.col("order_date")))
    sums = {running_name(m, "cust_id"): m for m in RUNNING_MEASURES} if running else {}
    lags = {f"{c}_diff": c for c in DIFF_COLUMNS if f"{c}_diff" in values}
    plain = rows.join(odd, "customer_id", "left_anti") if some else rows
    read = dict.fromkeys([*sums.values(), *lags.values(), *(v for v in values if v not in sums and v not in lags)])
    schema = ", ".join([f"customer_id {dict(log.dtypes)['customer_id']}", "split string", *(f"`{c}` double" for c in [*names, *uniques])])
    splits = {f.split: month_age(f.months.until, month) for f in frames}
    work = histories.history_rows(values, sums, lags, splits, uniques, ["customer_id", "split", *names, *uniques])

    def whole(part: DataFrame, _) -> DataFrame:
        return part.repartition("customer_id").sortWithinPartitions("customer_id", *order).select(
            "customer_id", F.col("__age").cast("int"), *uniques.values(), *(F.col(c).cast("double").alias(c) for c in read)
        ).mapInArrow(work, schema)

    wide, _ = in_slices(plain, "customer_id", slices, whole, "histories")
    drop_folder(log.sparkSession, folder)
    if some:
        # Sums by product run over all customers, so these start from the same rows.
        rest = row_stats(log, month, frames, limits, only=odd).groupBy("customer_id", "split").agg(F.expr(f"{STATS_MAP} AS m"))
        rest = rest.selectExpr("customer_id", "if(split = 0, '{}', '{}') AS split".format(*SPLITS), *(f"{e} AS {n}" for n, e in names.items()))
        if uniques:
            counts = distinct_counts(log.join(odd, "customer_id", "left_semi"), month)
            rest = rest.join(counts, "customer_id", "left").withColumns(by_split(uniques))
        wide = wide.unionByName(rest.select(*wide.columns))
    return wide, columns


def by_order_and_product(
    rows: DataFrame, order: Sequence[str], limits: ScanLimits, facts: LogFacts, slices: int = 1
) -> tuple[DataFrame, list[str], str | None]:
    """Running sums by order and by product, and a shorter total order: a row's place
    in its order stands for all columns that break ties, which then go no further.
    With several slices both are stored, and the last folder is given back too."""
    ties = [c for c in TIE_BREAKERS if c not in ("product_id", *MEASURES)]

    def summed(key: str, order: Sequence[str], position: str | None = None):
        column = RUNNING_KEYS[key]
        sums = {running_name(m, key): m for m in RUNNING_MEASURES}

        def work(part: DataFrame, chosen: Column | None) -> DataFrame:
            hot = facts.hot.get(column)
            if chosen is not None and hot is not None:
                hot = hot.filter(chosen)
            part = scan(part, [column], order, position=position, sums=sums, limits=limits, hot=hot)
            return part.withColumns({n: F.when(F.col(column).isNotNull(), F.col(n)) for n in sums})

        return work

    rows, first = in_slices(rows, "order_id", slices, lambda part, chosen: summed("order_id", order, PLACE)(part, chosen).drop(*ties), "by-order")
    order = [*ORDER, PLACE]
    rows, folder = in_slices(rows, "product_id", slices, summed("prod_id", order), "by-product")
    drop_folder(rows.sparkSession, first)
    return rows, order, folder


STATS_MAP = f"map_from_entries(collect_list(struct(kind, struct({', '.join(STATS)}) AS s)))"


def month_frames(frames: Sequence[Frame]) -> list[Frame]:
    return [f for f in frames if f.months.first is not None]


def whole_frames(frames: Sequence[Frame]) -> list[Frame]:
    return [f for f in frames if f.months.first is None]


def feature_columns(frames: Sequence[Frame], entry: str) -> dict[str, str]:
    """Feature name -> SQL, ``entry`` being that of a series by its kind."""
    by_slot = {f.slot: f for f in frames}
    return {
        f"{value}-{s}{f.suffix}": f"{entry.format(slot * ITEMS + item)}.{s}"
        for slot, f in by_slot.items()
        for item, value in enumerate(f.values)
        for s in STATS
    }


def frame_ages(frames: Sequence[Frame], month: str) -> list[int]:
    """The ages of the months at which frames start or end."""
    return sorted({month_age(b, month) for f in frames for b in (f.months.first, f.months.until) if b})


def monthly_stats(log: DataFrame, month: str, frames: Sequence[Frame], limits: ScanLimits = DEFAULT_LIMITS) -> DataFrame:
    """Statistics ``(customer_id, split, kind, ...)`` of month ranges of the measures."""
    ages = frame_ages(frames, month)
    history = month_range(history_before(log, month), first=shift_month(month, -ages[-1]))
    null_check = " OR ".join(f"{m} IS NULL" for m in MEASURES)
    gaps = cut_lineage(history.filter(null_check).select("customer_id").distinct())
    some = not gaps.isEmpty()
    plain = history.join(gaps, "customer_id", "left_anti") if some else history
    hot = hot_keys(history, ["year_month", "customer_id"], limits)
    states = month_states(plain, row_order(log), hot=hot, limits=limits)
    age = f"{month_number(month)} - {month_number_sql('year_month')}"
    stats = range_stats(states, age, frames_by_age(frames, month, ages), ages, ITEMS)
    if some:
        stats = stats.unionByName(row_stats(history.join(gaps, "customer_id", "left_semi"), month, frames, limits))
    return stats


def row_stats(
    log: DataFrame, month: str, frames: Sequence[Frame], limits: ScanLimits = DEFAULT_LIMITS, only: DataFrame | None = None
) -> DataFrame:
    """Statistics ``(customer_id, split, kind, ...)`` of series of single rows, of any
    values and with nulls. ``only`` names the customers wanted, if not all are."""
    values = {v for f in frames for v in f.values}
    running = any(v in RUNNING_VALUES for v in values)
    diffs = any(v in DIFF_VALUES for v in values)
    ages = frame_ages(frames, month)
    oldest = ages[-1]
    whole = any(f.months.first is None for f in frames)

    history = history_before(log, month)
    if not whole:
        # Positions only matter inside the windows, so older rows can go.
        history = month_range(history, first=shift_month(month, -oldest))
    order = row_order(log)
    scanned = RUNNING_KEYS.values() if running else ("customer_id",)
    facts = LogFacts.of(history, scanned, limits)
    rows = history.select(
        "customer_id",
        F.expr(f"{month_number(month)} - {month_number_sql('year_month')}").alias("__age"),
        *dict.fromkeys([*order, *MEASURES]),
    )
    if running:
        # The customer scan comes last: the aggregates below then need no
        # further shuffle.
        rows, order, _ = by_order_and_product(rows, order, limits, facts, slices_of(log))
    if only is not None:
        rows = rows.join(only, "customer_id", "left_semi")
    if diffs:
        rows = rows.withColumn("order_ts", order_seconds(F.col("order_date")))

    # Rows of the customer older than each month a frame starts or ends at.
    older = {f"__older_{a}": F.expr(f"bigint(__age > {a})") for a in ages}
    null_check = " OR ".join(f"{m} IS NULL" for m in MEASURES)
    gaps = {"__nulls": F.expr(f"bigint({null_check})")} if facts.nulls else {}
    placed = scan(
        rows, ["customer_id"], order,
        position="__rn",
        sums={running_name(m, "cust_id"): m for m in RUNNING_MEASURES} if running else {},
        lags={f"__lag_{c}": c for c in DIFF_COLUMNS} if diffs else {},
        totals=older | gaps,
        hot=facts.hot.get("customer_id"),
        limits=limits,
    )

    in_frame = placed.selectExpr(
        "customer_id", "__rn", *gaps, *MEASURES,
        *(v for v in RUNNING_VALUES if v in values),
        *(f"{c} - __lag_{c} AS {c}_diff" for c in DIFF_COLUMNS if f"{c}_diff" in values),
        "array({}) AS older".format(", ".join(["0L", *older])),
        f"explode({frames_by_age(frames, month, ages)}[least(__age, {oldest + 1})]) AS f",
    )
    by_slot = {f.slot: f for f in frames}
    lists = list(dict.fromkeys(f.values for f in by_slot.values()))
    long = in_frame.selectExpr(
        "customer_id", "f.split", "f.slot", *gaps,
        "__rn - older[f.first] AS position", "older[f.until] - __rn AS r",
        "posexplode(CASE f.list {} END) AS (item, x)".format(
            " ".join(
                f"WHEN {i} THEN array({', '.join(f'double({v})' for v in vs)})"
                for i, vs in enumerate(lists)
            )
        ),
    )
    # A series of differences starts with one null, which holds no position.
    led = [
        f"(slot = {slot} AND item >= {f.values.index(DIFF_VALUES[0])})"
        for slot, f in by_slot.items()
        if DIFF_VALUES[0] in f.values
    ]
    long = long.selectExpr(
        "customer_id", "split", f"slot * {ITEMS} + item AS kind", *gaps, "x", "r",
        f"position - int({' OR '.join(led)}) AS j" if led else "position AS j",
    )
    return summarise(
        long, ["customer_id", "split", "kind"], gaps=F.col("__nulls") > 0 if gaps else None
    )


def month_age(earlier: str, month: str) -> int:
    return month_number(month) - month_number(earlier)


def frames_by_age(frames: Sequence[Frame], month: str, ages: Sequence[int]) -> str:
    """SQL constant: the frames holding a month, indexed by its age.

    The last entry stands for every older month. A constant keeps the generated
    code small however many frames there are.
    """
    at = {None: 0} | {a: i for i, a in enumerate(ages, 1)}
    lists = list(dict.fromkeys({f.slot: f for f in frames}[f.slot].values for f in frames))
    starts = [None if f.months.first is None else month_age(f.months.first, month) for f in frames]
    ends = [month_age(f.months.until, month) for f in frames]
    rows = []
    for age in range(ages[-1] + 2):
        inside = [
            f"struct({SPLITS.index(f.split)} AS split, {f.slot} AS slot, "
            f"{at[start]} AS first, {at[end]} AS until, {lists.index(f.values)} AS list)"
            for f, start, end in zip(frames, starts, ends)
            if age > end and (start is None or age <= start)
        ]
        rows.append(f"array({', '.join(inside)})" if inside else "null")
    return f"array({', '.join(rows)})"


def window_stats(log: DataFrame, month: str, **options) -> DataFrame:
    """Statistics of eight nested trailing windows. A customer appears when
    active in the widest one."""
    return frame_features(log, month, window_frames(month), **options)


def keep_seasons(columns: dict[str, str], keep: str) -> dict[str, str]:
    """``right``: values of the recent season count only for customers who were
    also active in the year-ago season. ``outer`` keeps them."""
    if keep not in ("right", "outer"):
        raise ValueError("keep must be 'right' or 'outer'")
    if keep == "outer":
        return columns
    active = f"{columns['total-sum-season1']} IS NOT NULL"
    return {
        name: f"if({active}, {e}, null)" if name.endswith("-season0") else e
        for name, e in columns.items()
    }


def season_stats(log: DataFrame, month: str, keep: str = "right", **options) -> DataFrame:
    """Statistics of the last three months and the same months a year before."""
    frames = season_frames(month)
    packed, columns = packed_features(prepared(log, frames_start(frames), month), month, frames, **options)
    kept = keep_seasons(columns, keep)
    if keep == "right":
        packed = packed.filter(f"{columns['total-sum-season1']} IS NOT NULL")
    return packed.selectExpr(
        "customer_id", "split", *(f"{e} AS `{name}`" for name, e in kept.items())
    )


def distinct_counts(log: DataFrame, month: str) -> DataFrame:
    """Distinct orders and products per customer, columns ``{split}_{column}``.

    Pairs are grouped before customers, so a large customer is spread over all
    tasks; a pair counts for a split when it was first seen before its cutoff.
    """
    pairs = (
        history_before(log, month)
        .selectExpr(
            "customer_id", f"{month_number_sql('year_month')} AS month",
            "inline(array(struct(order_id, null AS product_id), struct(null AS order_id, product_id)))",
        )
        .filter("order_id IS NOT NULL OR product_id IS NOT NULL")
        .groupBy("customer_id", "order_id", "product_id")
        .agg(F.min("month").alias("first_month"))  # a number, so it can hash-aggregate
    )
    return pairs.groupBy("customer_id").agg(
        *(
            F.expr(f"double(count_if({c} IS NOT NULL AND first_month < {month_number(cut)}))").alias(f"{split}_{c}")
            for split, cut in cutoffs(month).items()
            for c in ("order_id", "product_id")
        )
    )


def by_split(columns: dict[str, str]) -> dict[str, Column]:
    """Output -> ``{split}_{name}`` column of the row's own split."""
    return {
        out: F.expr(f"if(split = 'train', train_{name}, test_{name})") for out, name in columns.items()
    }


DISTINCT_COLUMNS = {"order_id-nunique": "order_id", "product_id-nunique": "product_id"}
SPAN_COLUMNS = {"order_ts-first": "first", "order_ts-last": "last"}


def cumsum_features(log: DataFrame, month: str, *, limits: ScanLimits = DEFAULT_LIMITS) -> DataFrame:
    """Statistics of the running sums, with distinct order and product counts."""
    log = prepared(log, until=month)
    packed, columns = packed_features(log, month, history_frames(month, RUNNING_VALUES), limits=limits)
    return packed.selectExpr(
        "customer_id", "split", *(f"{e} AS `{name}`" for name, e in columns.items()), *(f"`{c}`" for c in DISTINCT_COLUMNS)
    )


def order_span(log: DataFrame, month: str) -> DataFrame:
    """First and last order time per customer, columns ``{split}_first/last``.
    Time leads the row order, so first and last are minimum and maximum."""
    ts = order_seconds(F.col("order_date"))
    return (
        history_before(log, month)
        .groupBy("customer_id")
        .agg(
            *(
                f(F.when(F.col("year_month") < cut, ts)).alias(f"{split}_{name}")
                for split, cut in cutoffs(month).items()
                for name, f in (("first", F.min), ("last", F.max))
            )
        )
    )


def diff_features(log: DataFrame, month: str, *, limits: ScanLimits = DEFAULT_LIMITS) -> DataFrame:
    """First and last order time, and statistics of consecutive differences."""
    log = prepared(log, until=month)
    wide = wide_features(log, month, history_frames(month, DIFF_VALUES), limits)
    span = order_span(log, month)
    joined = wide.join(span, "customer_id", "left").withColumns(by_split(SPAN_COLUMNS))
    return joined.drop(*(c for c in span.columns if c != "customer_id"))
