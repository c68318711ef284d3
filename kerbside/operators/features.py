"""Lag and rolling features for next-hour demand.

Series are built over the hourly mart, so one series never has more rows than
there are hours in its range (times the services when they share a partition).
Trips of a hot zone are already merged by then, and the lags, means and label of
all series come from one exchange and one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from kerbside.functions.trips import month_index, parse_month
from kerbside.operators.insights import keep_members, top_zones
from kerbside.settings import END_MONTH, START_MONTH, TEST_START, TOP_ZONES, TRAIN_END

SERIES = {
    "service_zone": (["service_type", "zone_id"], ["ts_hour"]),
    "zone": (["zone_id"], ["ts_hour", "service_type"]),
}
LAGS = (1, 24, 168)
ROLLING = (24, 168)
CALENDAR = ("hour_of_day", "day_of_week", "month_num")
FEATURES = (
    *[f"lag_{n}" for n in LAGS],
    *[f"rolling_mean_{n}" for n in ROLLING],
    *CALENDAR,
)


def keep_top_zones(demand: DataFrame, n: int = TOP_ZONES) -> DataFrame:
    """Demand rows of the n busiest zones."""
    return keep_members(demand, top_zones(demand, n).select("zone_id"), "zone_id")


def series_window(partition: str) -> WindowSpec:
    keys, order = SERIES[partition]
    return Window.partitionBy(*keys).orderBy(*order)


def month_range(start: str = START_MONTH, end: str = END_MONTH) -> tuple[Column, Column]:
    """First and last hour of the months from start to end, both included."""
    (y, m), (ny, nm) = parse_month(start), parse_month(end)
    ny, nm = ny + nm // 12, nm % 12 + 1
    first, after = (F.make_timestamp(*[F.lit(v) for v in (y, m, 1, 0, 0, 0)]) for y, m in ((y, m), (ny, nm)))
    return first, after - F.expr("INTERVAL 1 HOUR")


def outside_hours(demand: DataFrame, months: tuple[str, str] = (START_MONTH, END_MONTH)) -> DataFrame:
    """Rows and pickups per series that hour filling leaves out as stray."""
    stray = demand.filter(~F.col("ts_hour").between(*month_range(*months)))
    return stray.groupBy("service_type", "zone_id").agg(
        F.count("*").alias("hours"), F.sum("pickups").alias("pickups")
    )


def fill_hours(demand: DataFrame, months: tuple[str, str] = (START_MONTH, END_MONTH)) -> DataFrame:
    """One row per service, zone and hour of the months; hours without trips get zero pickups.

    Rows outside the months are left out: trip files hold stray dates decades
    away, and the gaps to them would be filled. ``outside_hours`` reports them.
    Every row fills the gap up to its successor, so no spine is joined and the
    series keep the partitioning the lags need. A series without a row in the
    range stays absent.
    """
    first, last = month_range(*months)
    demand = demand.filter(F.col("ts_hour").between(first, last))
    by_hour = series_window("service_zone")
    hour = F.expr("INTERVAL 1 HOUR")
    start = F.when(F.lag("ts_hour").over(by_hour).isNull(), first).otherwise(F.col("ts_hour"))
    end = F.coalesce(F.lead("ts_hour").over(by_hour) - hour, last)
    spread = demand.select("*", start.alias("__from"), end.alias("__to")).select(
        "*", F.explode(F.sequence("__from", "__to", hour)).alias("__hour")
    )
    observed = F.col("__hour") == F.col("ts_hour")
    values = [c for c in demand.columns if c not in ("service_type", "zone_id", "ts_hour", "pickups")]
    return spread.select(
        "service_type",
        "zone_id",
        F.col("__hour").alias("ts_hour"),
        F.when(observed, F.col("pickups")).otherwise(F.lit(0)).alias("pickups"),
        *[F.when(observed, F.col(c)).alias(c) for c in values],
    )


def lag_columns(window: WindowSpec, lags: Sequence[int]) -> list[Column]:
    return [F.lag("pickups", n).over(window).alias(f"lag_{n}") for n in lags]


def with_rolling_means(rows: DataFrame, window: WindowSpec, sizes: Sequence[int]) -> DataFrame:
    """Adds means over the n rows before the current one, null for the first row of a series.

    Taken as differences of one running sum, so a row costs the same for any n
    (a sliding frame adds up its n rows again for every row). Pickups are whole
    numbers, which keeps the differences exact.
    """
    before = F.sum("pickups").over(window.rowsBetween(Window.unboundedPreceding, -1))
    summed = rows.select(
        "*", before.alias("__before"), (F.row_number().over(window) - 1).alias("__seen")
    )

    def mean(n: int) -> Column:
        total = F.col("__before") - F.coalesce(F.lag("__before", n).over(window), F.lit(0))
        count = F.nullif(F.least("__seen", F.lit(n)), F.lit(0))
        return (total / count).alias(f"rolling_mean_{n}")

    return summed.select("*", *[mean(n) for n in sizes]).drop("__before", "__seen")


def forecast_features(
    demand: DataFrame,
    top_n: int | None = TOP_ZONES,
    partition: str = "service_zone",
    densify: bool = False,
    lags: Sequence[int] = LAGS,
    rolling: Sequence[int] = ROLLING,
    months: tuple[str, str] = (START_MONTH, END_MONTH),
) -> DataFrame:
    """Model rows: the mart, lags, rolling means, calendar columns and the next row's pickups.

    Rows that miss any of these are dropped. ``partition="zone"`` runs the
    services of a zone through one series; ``densify`` makes rows equal the hours
    of ``months``.
    """
    if densify and partition != "service_zone":
        raise ValueError("densify works on service_zone series")
    rows = demand if top_n is None else keep_top_zones(demand, top_n)
    if densify:
        rows = fill_hours(rows, months)
    window = series_window(partition)
    lagged = rows.select(
        "*", *lag_columns(window, lags), F.lead("pickups", 1).over(window).alias("label")
    )
    return _finished(with_rolling_means(lagged, window, rolling), rows.columns, lags, rolling)


def _finished(built: DataFrame, columns: list[str], lags: Sequence[int], rolling: Sequence[int]) -> DataFrame:
    """Model rows from rows with lags, rolling means and label: calendar columns added, incomplete rows dropped."""
    computed = [*[f"lag_{n}" for n in lags], *[f"rolling_mean_{n}" for n in rolling]]
    rows = built.select(
        *columns,
        *computed,
        F.hour("ts_hour").alias("hour_of_day"),
        F.dayofweek("ts_hour").alias("day_of_week"),
        F.month("ts_hour").alias("month_num"),
        "label",
    )
    return rows.dropna(subset=[*computed, *CALENDAR, "label"]).select(
        "*", F.year("ts_hour").alias("feat_year"), F.month("ts_hour").alias("feat_month")
    )


def _hour_number(time: Column) -> Column:
    return F.floor(F.unix_timestamp(time) / 3600)


def clock_features(
    demand: DataFrame,
    top_n: int | None = TOP_ZONES,
    lags: Sequence[int] = LAGS,
    rolling: Sequence[int] = ROLLING,
    months: tuple[str, str] = (START_MONTH, END_MONTH),
) -> DataFrame:
    """The rows of ``forecast_features(densify=True)`` that the mart has, without a row for any empty hour.

    Frames run over hour numbers instead of rows, so an absent hour adds nothing to
    a sum, which is what zero pickups would add. Work and shuffle follow the hours
    with trips; a zone with ten of them a year costs ten rows. Rolling sums are
    differences of two sums that only ever grow, so a row costs the same for any
    window, and all frames share one exchange and one sort.
    """
    rows = demand if top_n is None else keep_top_zones(demand, top_n)
    first, last = month_range(*months)
    rows = rows.filter(F.col("ts_hour").between(first, last))
    hour = _hour_number(F.col("ts_hour")) - _hour_number(first)
    series = Window.partitionBy(*SERIES["service_zone"][0]).orderBy("__hour")

    def pickups(low: int, high: int) -> Column:
        """Pickups of the hours from ``low`` to ``high``, counted from the row's."""
        return F.coalesce(F.sum("pickups").over(series.rangeBetween(low, high)), F.lit(0))

    def mean(n: int) -> Column:
        total = pickups(Window.unboundedPreceding, -1) - pickups(Window.unboundedPreceding, -n - 1)
        return (total / F.nullif(F.least("__hour", F.lit(n)), F.lit(0))).alias(f"rolling_mean_{n}")

    built = rows.withColumn("__hour", hour).select(
        *rows.columns,
        *[F.when(F.col("__hour") >= n, pickups(-n, -n)).alias(f"lag_{n}") for n in lags],
        *[mean(n) for n in rolling],
        F.when(F.col("ts_hour") < last, pickups(1, 1)).alias("label"),
    )
    return _finished(built, rows.columns, lags, rolling)


def split_by_month(
    features: DataFrame, train_end: str = TRAIN_END, test_start: str = TEST_START
) -> tuple[DataFrame, DataFrame]:
    """Rows up to the last training month, and rows from the first test month on."""
    index = month_index("feat_year", "feat_month")
    last, first = (year * 12 + month - 1 for year, month in map(parse_month, (train_end, test_start)))
    return features.filter(index <= last), features.filter(index >= first)
