"""Accuracy of predicted against counted volumes, and peak summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segflow.operators.rank import exact_percentiles, percentile_cuts
from segflow.operators.tables import metric_rows, union_all
from segflow.schema import DAY_HOURS, EVENING_PEAK, MORNING_PEAK, PREDICTION, TARGET

# Error thresholds in percent of the full and the hold-out report.
THRESHOLDS = list(range(5, 76, 5))
HOLD_OUT_THRESHOLDS = list(range(5, 51, 5))


def _actual() -> Column:
    return F.col(TARGET)


def _predicted() -> Column:
    return F.col(PREDICTION)


def _is_zero(c: Column) -> Column:
    return c.eqNullSafe(F.lit(0))


def _either_zero() -> Column:
    return _is_zero(_actual()) | _is_zero(_predicted())


def _difference() -> Column:
    return F.abs(_predicted() - _actual())


def percent_difference() -> Column:
    """Absolute error in percent of the count; null for a count of zero."""
    return F.try_divide(_difference(), _actual()) * 100


def _measures() -> list[Column]:
    day = F.hour("measurement_tstamp").between(*DAY_HOURS)
    zero = _either_zero()
    percent = F.when(~zero, percent_difference())
    return [
        F.count_if(_is_zero(_actual())).alias("zeros_vol"),
        F.count_if(_is_zero(_predicted())).alias("zeros_predicted"),
        F.count_if(zero).alias("rows_with_zeros"),
        F.count_if(~zero).alias("rows_compared"),
        F.avg(F.when(zero, _difference())).alias("mean_abs_diff_zeros"),
        F.avg(percent).alias("percent_diff"),
        F.avg(F.when(day, percent)).alias("percent_diff_day"),
        F.avg(F.when(~day, percent)).alias("percent_diff_night"),
    ]


def _median_of_zeros(df: DataFrame) -> Column:
    return percentile_cuts(df.where(_either_zero()).select(_difference().alias("d")), "d", [0.5])[0]


def _worst() -> Column:
    """Key of the largest error, the smallest key on a tie; rows without an error never win."""
    key = F.struct((-_difference()).alias("neg"), F.col("tmc_code"), F.col("measurement_tstamp"))
    return F.min(F.when(_difference().isNotNull(), key))


def accuracy(df: DataFrame) -> DataFrame:
    """One row: zero counts, mean and median error of rows with a zero, and
    the mean percent error of the others, overall, by day and by night. A null
    is not a zero: such rows stay among the others, without an error."""
    return df.agg(*_measures()).withColumn("median_abs_diff_zeros", _median_of_zeros(df))


def within_thresholds(df: DataFrame, thresholds: list[int] = THRESHOLDS) -> DataFrame:
    """``(threshold, pct_within)``: share of rows without a zero whose error is
    at most the threshold, in percent. Rows without an error count as misses."""
    percent = percent_difference()
    hits = [F.count_if(percent <= t).alias(f"t{t}") for t in thresholds]
    counted = df.where(~_either_zero()).agg(F.count("*").alias("n"), *hits)
    rows = F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"t{t}").alias("k")) for t in thresholds])
    long = counted.select("n", F.explode(rows).alias("r"))
    return long.select("r.threshold", (F.try_divide(F.col("r.k"), F.col("n")) * 100).alias("pct_within"))


def error_values(df: DataFrame) -> DataFrame:
    """Percent error of every row without a zero."""
    return df.where(~_either_zero()).select(percent_difference().alias("percent_error"))


def zero_share(df: DataFrame, column: str) -> DataFrame:
    """``(tmc_code, pct_zero)`` for segments that have a zero in ``column``."""
    zeros = F.count_if(_is_zero(F.col(column)))
    shares = df.where("tmc_code is not null").groupBy("tmc_code").agg(
        zeros.alias("zeros"), F.count("*").alias("n")
    )
    return shares.where("zeros > 0").select("tmc_code", (F.col("zeros") / F.col("n") * 100).alias("pct_zero"))


def zero_share_summary(df: DataFrame, column: str) -> DataFrame:
    """Number of segments with a zero, the mean, least and largest share, and
    the segment of the largest (smallest code on a tie). Nulls without any."""
    shares = zero_share(df, column)
    top = F.min(F.struct((-F.col("pct_zero")).alias("neg"), "tmc_code"))["tmc_code"]
    return shares.agg(
        F.count("*").alias("segments"),
        F.avg("pct_zero").alias("avg_pct"),
        F.min("pct_zero").alias("min_pct"),
        F.max("pct_zero").alias("max_pct"),
        top.alias("max_tmc"),
    )


def worst_zero_rows(df: DataFrame, column: str = TARGET) -> DataFrame:
    """All rows of the segment with the largest share of zeros."""
    worst = zero_share_summary(df, column).select("max_tmc").scalar()
    return df.where(F.col("tmc_code") == worst)


def peaks(df: DataFrame) -> DataFrame:
    """One row for predictions without counts: hour and size of the largest
    prediction, and mean, median and sample deviation in the two peaks. The
    largest volume itself is reported, not a row label."""
    hour = F.hour("measurement_tstamp")
    morning, evening = hour.between(*MORNING_PEAK), hour.between(*EVENING_PEAK)
    top = F.min(F.struct((-_predicted()).alias("neg"), F.col("tmc_code"), F.col("measurement_tstamp")))
    peak = F.when(morning, F.lit("morning")).when(evening, F.lit("evening"))
    found = exact_percentiles(
        df.select(peak.alias("peak"), PREDICTION).where("peak is not null"), PREDICTION, [0.5], ["peak"]
    )
    medians = found.agg(F.map_from_entries(F.collect_list(F.struct("peak", "value")))).scalar()  # two entries

    out = df.where(_predicted().isNotNull()).agg(
        top.alias("top"),
        *[
            f(F.when(when, _predicted())).alias(f"{label}_{name}")
            for name, when in (("morning", morning), ("evening", evening))
            for label, f in (("avg", F.avg), ("std", F.stddev_samp))
        ],
    )
    return out.select(
        F.col("top.measurement_tstamp").alias("max_volume_time"),
        (-F.col("top.neg")).alias("max_volume"),
        "avg_morning", F.element_at(medians, "morning").alias("median_morning"), "std_morning",
        "avg_evening", F.element_at(medians, "evening").alias("median_evening"), "std_evening",
    )


def largest_error(df: DataFrame) -> DataFrame:
    """Segment, hour and size of the largest error (smallest key on a tie)."""
    rows = df.agg(_worst().alias("w")).where("w is not null")
    return rows.select("w.tmc_code", "w.measurement_tstamp", (-F.col("w.neg")).alias("abs_error"))


def hour_profile(df: DataFrame, values: list[str]) -> DataFrame:
    """Mean of the given columns by hour, with the direction as label."""
    hours = df.groupBy(F.hour("measurement_tstamp").alias("hour"))
    return hours.agg(F.min("DIR").alias("DIR"), *[F.avg(v).alias(v) for v in values])


def volume_quintile(df: DataFrame, value: str = "VOL") -> DataFrame:
    """Add ``quintile`` 1–5: the first fifth whose upper cut exceeds the value."""
    step = F.lit(1)
    for cut in percentile_cuts(df, value, [0.2, 0.4, 0.6, 0.8]):
        step = step + F.when(F.col(value) >= cut, 1).otherwise(0)
    return df.withColumn("quintile", F.when(F.col(value).isNotNull(), step))


def quality_measures(actual: str, predicted: str, share: float = 0.15) -> list[Column]:
    """R² and the percentage of all rows with a relative error under ``share``;
    a count of zero is a miss. Errors are taken unrounded."""
    y, p = F.col(actual), F.col(predicted)
    residual = F.sum((y - p) * (y - p))
    spread = F.var_pop(y) * F.count(y)
    near = F.count_if(F.try_divide(F.abs(y - p), y) < share)
    return [
        (1 - F.try_divide(residual, spread)).alias("r2"),
        (F.try_divide(near, F.count("*")) * 100).alias("pct_within"),
    ]


def loss_measure(actual: str, predicted: str, delta: float = 500.0) -> Column:
    """Mean Huber loss over rows."""
    e = F.abs(F.col(actual) - F.col(predicted))
    loss = F.when(e <= delta, 0.5 * e * e).otherwise(delta * (e - delta / 2))
    return F.avg(loss).alias("huber_loss")


def fit_quality(df: DataFrame, share: float = 0.15) -> DataFrame:
    """One row of :func:`quality_measures` for counted and predicted volume."""
    return df.agg(*quality_measures(TARGET, PREDICTION, share))


def huber_loss(df: DataFrame, delta: float = 500.0) -> DataFrame:
    return df.agg(loss_measure(TARGET, PREDICTION, delta))


def accuracy_table(df: DataFrame) -> DataFrame:
    """The accuracy report as display rows ``(Metric, Value)``."""
    summary = df.agg(*_measures(), _worst().alias("worst")).withColumn("median_abs_diff_zeros", _median_of_zeros(df))

    def percent(name: str) -> Column:
        return F.format_string("%.2f%%", F.col(name))

    # The labels of the report.
    return metric_rows(
        summary,
        {
            "Overall Percent Difference": percent("percent_diff"),
            "Daytime Percent Difference (7 AM - 7 PM)": percent("percent_diff_day"),
            "Nighttime Percent Difference (7 PM - 7 AM)": percent("percent_diff_night"),
            "Number of zeros in VOL": F.col("zeros_vol"),
            "Number of zeros in Predicted_VOL": F.col("zeros_predicted"),
            "Number of rows with zero in either VOL or Predicted_VOL": F.col("rows_with_zeros"),
            "Average Absolute Difference for zeros": F.format_string("%.2f", F.col("mean_abs_diff_zeros")),
            "Median Absolute Difference for zeros": F.format_string("%.2f", F.col("median_abs_diff_zeros")),
            "Time of Maximum Difference": F.date_format("worst.measurement_tstamp", "yyyy-MM-dd HH:mm:ss"),
            "TMC Code of Maximum Difference": F.col("worst.tmc_code"),
        },
    )


def peak_table(df: DataFrame) -> DataFrame:
    """The peak report as display rows ``(Metric, Value)``."""
    return metric_rows(
        peaks(df),
        {
            "Average Morning Peak (6 AM - 9 AM)": F.format_string("%.2f", F.col("avg_morning")),
            "Average Evening Peak (4 PM - 7 PM)": F.format_string("%.2f", F.col("avg_evening")),
        },
    )


def hold_out_table(df: DataFrame) -> DataFrame:
    """The report on predictions for stations never trained on, as display
    rows: zeros, their share per segment, percent differences, thresholds."""

    def two(name: str) -> Column:
        return F.format_string("%.2f", F.col(name))

    summary = df.agg(*_measures()).withColumn("median_abs_diff_zeros", _median_of_zeros(df))
    parts = [
        metric_rows(
            summary,
            {
                "Zeros in VOL": F.col("zeros_vol"),
                "Zeros in Predicted_VOL": F.col("zeros_predicted"),
                "Rows with a zero": F.col("rows_with_zeros"),
                "Average absolute difference, rows with a zero": two("mean_abs_diff_zeros"),
                "Median absolute difference, rows with a zero": two("median_abs_diff_zeros"),
                "Rows compared": F.col("rows_compared"),
                "Percent difference": two("percent_diff"),
                "Percent difference, day": two("percent_diff_day"),
                "Percent difference, night": two("percent_diff_night"),
            },
        )
    ]
    for column in (TARGET, PREDICTION):
        parts.append(
            metric_rows(
                zero_share_summary(df, column),
                {
                    f"Segments with zeros in {column}": F.col("segments"),
                    f"Average share of zeros in {column}": two("avg_pct"),
                    f"Least share of zeros in {column}": two("min_pct"),
                    f"Largest share of zeros in {column}": two("max_pct"),
                    f"Segment of the largest share in {column}": F.col("max_tmc"),
                },
            )
        )
    shares = within_thresholds(df, HOLD_OUT_THRESHOLDS)
    parts.append(
        shares.select(F.format_string("Within %d%%", "threshold").alias("Metric"), two("pct_within").alias("Value"))
    )
    return union_all(parts)
