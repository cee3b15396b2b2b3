"""Values of the neighbouring rows of a time series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segflow.operators.rank import expand_copies
from segflow.session import stored

DAY = 86_400


def with_neighbours(
    df: DataFrame,
    keys: list[str],
    seconds: str,
    columns: list[str],
    ties: list[Column] | None = None,
    hot: int = 5_000_000,
    span: int = DAY,
) -> DataFrame:
    """Add ``<c>_before`` and ``<c>_after`` for each column.

    Mind the names: ``_before`` holds the *next* row in time and ``_after`` the
    *previous* one, as published models expect. Neighbours are rows, not hours:
    a gap in the series is not filled. A row with a null key is in no series: it
    has no neighbours. ``seconds`` is the time in epoch seconds
    and ``ties`` orders rows of equal time.

    A count over the keys comes first. Series of up to ``hot`` rows take one
    shuffle and one window. Longer ones, say a segment that owns a third of the
    table, are cut into spans of ``span`` seconds and spread over many tasks:
    only the outermost rows of a span look beyond it, in a second window over
    those rows alone. A span that is itself longer than ``hot`` can only come
    from copies: they are counted before the shuffle and put back at the end.
    """
    long = df.where(_named(keys)).groupBy(*keys).count().where(F.col("count") > hot).select(*keys)
    if long.isEmpty():
        return _in_one(df, keys, seconds, columns, ties)
    long = stored(long, "hot").select(*[F.col(k).alias(f"_hot_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    usual = _in_one(df.join(long, same, "left_anti"), keys, seconds, columns, ties)
    cut = df.join(long, same, "left_semi").withColumn("_span", F.floor(F.col(seconds) / span))
    sizes = cut.groupBy(*keys, "_span").count()
    if sizes.where(F.col("count") > hot).isEmpty():
        spread = _in_spans(cut, keys, seconds, columns, ties)
    else:
        spread = _with_copies(cut, keys, seconds, columns, ties)
    return usual.unionByName(spread.select(*usual.columns))


def _named(keys: list[str]) -> Column:
    """True where no key is null."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _in_one(df: DataFrame, keys: list[str], seconds: str, columns: list[str], ties) -> DataFrame:
    # rows without a key are many and need no neighbours: they are spread by their time
    apart = F.when(~_named(keys), F.hash(*keys, F.col(seconds)))
    series = Window.partitionBy(*keys, apart).orderBy(F.col(seconds), *(ties or []))
    values = {f"{c}_{side}": step(c).over(series) for c in columns for side, step in _sides().items()}
    return df.withColumns({name: F.when(_named(keys), value) for name, value in values.items()})


def _with_copies(cut: DataFrame, keys: list[str], seconds: str, columns: list[str], ties) -> DataFrame:
    counted = cut.groupBy(*cut.columns).agg(F.count("*").alias("_copies"))
    each = expand_copies(_in_spans(counted, keys, seconds, columns, ties), "_copies", "_nth")
    last = F.col("_nth") == F.col("_copies") - 1
    values = {f"{c}_before": F.when(last, F.col(f"{c}_before")).otherwise(F.col(c)) for c in columns}
    values |= {f"{c}_after": F.when(F.col("_nth") == 0, F.col(f"{c}_after")).otherwise(F.col(c)) for c in columns}
    return each.withColumns(values)


def _sides():
    return {"before": F.lead, "after": F.lag}


def _in_spans(cut: DataFrame, keys: list[str], seconds: str, columns: list[str], ties) -> DataFrame:
    order = [F.col(seconds), *(ties or [])]
    in_span = Window.partitionBy(*keys, "_span").orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    sides = _sides()
    near = cut.withColumns(
        {f"_has_{side}": step(F.lit(True)).over(in_span) for side, step in sides.items()}
        | {f"{c}_{side}": step(c).over(in_span) for c in columns for side, step in sides.items()}
    )
    inner = F.col("_has_before").isNotNull() & F.col("_has_after").isNotNull()
    edges = near.where(~inner).withColumns(
        {
            f"{c}_{side}": F.when(F.col(f"_has_{side}"), F.col(f"{c}_{side}")).otherwise(step(c).over(whole))
            for c in columns
            for side, step in sides.items()
        }
    )
    return near.where(inner).unionByName(edges)


def with_hour_neighbours(
    df: DataFrame, keys: list[str], seconds: str, columns: list[str], hour: int = 3_600, span: int = DAY
) -> DataFrame:
    """Add ``<c>_before`` and ``<c>_after`` for each column, named as by :func:`with_neighbours`,
    from the rows exactly one hour later and earlier: a gap gives null, not the next row.

    All series are cut into spans of ``span`` seconds, so a long one is spread over many tasks;
    rows within an hour of another span are copied there, only to be looked at. Of
    several rows of one hour the one with the smallest values counts. Rows without a key or a
    time have no neighbours.
    """
    own = F.floor(F.col(seconds) / span)
    reached = [F.floor((F.col(seconds) + shift) / span) for shift in (-hour, hour)]
    usable = _named([*keys, seconds])
    spans = F.when(usable, F.array_distinct(F.array(own, *reached))).otherwise(F.array(F.lit(None).cast("bigint")))
    dealt = df.withColumn("_span", F.explode(spans)).withColumn("_own", ~usable | (F.col("_span") == own))
    # rows in no series are spread by their values
    apart = F.when(~usable, F.hash(*df.columns))
    series = Window.partitionBy(*keys, "_span", apart).orderBy(F.col(seconds).cast("bigint"))
    row = F.min(F.struct(*columns))
    near = {side: F.when(usable, row.over(series.rangeBetween(shift, shift))) for side, shift in (("before", hour), ("after", -hour))}
    found = dealt.withColumns({f"_{side}": value for side, value in near.items()}).where("_own")
    return found.select(*df.columns, *[F.col(f"_{side}")[c].alias(f"{c}_{side}") for c in columns for side in near])
