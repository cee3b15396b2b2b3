"""From a joined dataset to the numeric table a model reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.functions.codes import category_index, encode_categories, segment_number, segment_variant
from segflow.functions.times import epoch_seconds, with_calendar
from segflow.operators.neighbours import with_neighbours
from segflow.operators.tables import complete_rows
from segflow.schema import BASE_FEATURES, DENSITY_COLUMNS, TARGET, feature_columns, shifted_columns

SERIES = ["tmc_code", "TMC_Value", "DIR"]
#: The column of :func:`feature_table` that carries the row of the dataset.
RAW = "_raw"

Step = Callable[[DataFrame], DataFrame]


def code_step(df: DataFrame) -> DataFrame:
    code = F.col("tmc_code")
    return df.withColumns({"TMC_Value": segment_variant(code), "tmc_code": segment_number(code)})


def start_date_step(df: DataFrame) -> DataFrame:
    """``active_start_date`` to epoch seconds (not part of the default chain)."""
    return df.withColumn("active_start_date", epoch_seconds(F.col("active_start_date")))


def density_step(index: DataFrame | None = None) -> Step:
    """Density categories to codes; the index is learned from the data itself
    unless a stored one is given."""

    def apply(df: DataFrame) -> DataFrame:
        known = category_index(df, DENSITY_COLUMNS) if index is None else index
        return encode_categories(df, DENSITY_COLUMNS, known)

    return apply


def neighbour_step(df: DataFrame) -> DataFrame:
    """Neighbour rows of every changing column. Rows of equal time (a segment
    with several stations) are ordered by volume to be repeatable."""
    ties = [F.col(TARGET)] if TARGET in df.columns else []
    plain = [c for c in df.columns if c != RAW]
    return with_neighbours(df, SERIES, "measurement_tstamp", shifted_columns(plain), ties)


def default_steps(index: DataFrame | None = None) -> dict[str, Step]:
    """The chain by name, in order. Callers may add or swap steps; neighbours
    belong at the end, they copy what the steps before them made."""
    return {
        "codes": code_step,
        "calendar": with_calendar,
        "density": density_step(index),
        "neighbours": neighbour_step,
    }


def feature_table(
    dataset: DataFrame, steps: dict[str, Step] | None = None, index: DataFrame | None = None, carry: bool = False
) -> DataFrame:
    """Prune, run the steps, keep the 48 features (and the target if the
    dataset has it) and drop rows with any null. With ``carry`` every row also brings
    the row of the dataset it was made from, in one column."""
    target = [TARGET] if TARGET in dataset.columns else []
    raw = [F.struct(*dataset.columns).alias(RAW)] if carry else []
    table = dataset.select(*BASE_FEATURES, *target, *raw)
    for step in (steps or default_steps(index)).values():
        table = step(table)
    wanted = [c for c in feature_columns() if c in table.columns]
    added = [c for c in table.columns if c not in [*wanted, *target, RAW]]
    return complete_rows(table.select(*wanted, *added, *target, *([RAW] if carry else [])), [*wanted, *added, *target])
