"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segflow.session import bound_batches, ship

#: What separates words, and a word, in Java's and DuckDB's syntax.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the largest bit table that is broadcast, 16 MB.
MOST_BITS = 1 << 27


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """The table without columns that would clash, in any case, with ``names``."""
    taken = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def boxed(df: DataFrame) -> Column:
    """All columns in one, so that names of intermediate columns cannot meet theirs."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def unboxed(df: DataFrame, columns: list[str], new: list[str] | None = None, box: str = "_doc") -> DataFrame:
    """The ``columns`` that :func:`boxed` has put away, then the ``new`` ones, which replace
    those of the same name."""
    taken = {n.lower() for n in new or []}
    return df.select(*[F.col(box).getField(c).alias(c) for c in columns if c.lower() not in taken], *(new or []))


def with_python(df: DataFrame, inputs: list[str], fields: list[T.StructField], make: Callable[[], Callable], drop: Sequence[str] = ()) -> DataFrame:
    """Add columns computed in Python from Arrow batches; all others pass through, but
    for those in ``drop``, which do not come back from Python.

    ``make`` runs once in each task and gives a function from the lists of the
    input columns to the lists of the new ones; if that has a ``close``, the task ends
    with it. Columns with the names of new ones are replaced. Batches are bounded by
    bytes, as one row may be a long text.
    """
    ship(df.sparkSession)
    bound_batches(df.sparkSession)
    kept = without(df, [*[f.name for f in fields], *drop])
    schema = T.StructType([*kept.schema.fields, *fields])
    more = [c for c in inputs if c not in kept.columns]
    free = "_in"
    while any(c.lower().startswith(free) for c in kept.columns):
        free += "_"
    fed = df.select(*[F.col(f"`{c}`") for c in kept.columns], *[F.col(f"`{c}`").alias(f"{free}{i}") for i, c in enumerate(more)])
    width = len(kept.columns)
    places = [kept.columns.index(c) if c in kept.columns else width + more.index(c) for c in inputs]
    kinds = _arrow_kinds(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            made = work(*[batch.column(i).to_pylist() for i in places])
            new = [x if isinstance(x, pa.Array) else pa.array(x, kind) for x, kind in zip(made, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *new], names=schema.names)
        getattr(work, "close", lambda: None)()

    return fed.mapInArrow(run, schema)


def _arrow_kinds(fields: list[T.StructField]) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(f.dataType) for f in fields]


def group_key(column: Column) -> Column:
    """A string that is never null and differs for null and every value."""
    return F.when(column.isNull(), "n").otherwise(F.concat(F.lit("v"), column.cast("string")))


@dataclass
class Bits:
    """A table of bits over 64-bit hashes; its size is two to the power of ``width``."""

    table: np.ndarray
    width: int

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key, unsigned, may be in the table; what is in it always is."""
        place = keys >> np.uint64(64 - self.width)
        return (self.table[(place >> np.uint64(6)).view(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0


def bit_table(keys: DataFrame, key: Column, most_bits: int = MOST_BITS) -> Bits:
    """The table of all hashes ``key``, by their highest bits, of which it has 16 for each key and
    ``most_bits`` at most. It is put together in tasks; a row that comes to the
    driver is 64 bits of it. Keys may also be found that were not put in."""
    width = min(most_bits.bit_length() - 1, max(16, (16 * keys.count()).bit_length()))
    place = keys.select(F.shiftrightunsigned(key, 64 - width).alias("place"))
    one = F.expr("shiftleft(1L, cast(place & 63 as int))")
    found = place.groupBy(F.shiftright("place", 6).alias("at")).agg(F.bit_or(one).alias("bits")).toArrow()
    table = np.zeros(1 << (width - 6), np.uint64)
    table[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Bits(table, width)


def bucket_of(*columns: Column) -> Column:
    """One of 65,536 buckets, by hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit("bucket"), *columns), 48).cast("int")


def bucket_starts(df: DataFrame, group: str, value: Column) -> DataFrame:
    """For each (``group``, ``_bucket``): ``_start``, the total of ``value`` in the
    group's lower buckets.

    Two levels of 256 buckets, so that no window sees more than 256 rows of a
    group, however many rows the group has.
    """
    small = df.groupBy(group, "_bucket").agg(F.sum(value).alias("_sum"))
    small = small.withColumn("_upper", F.shiftright("_bucket", 8))
    upper = small.groupBy(group, "_upper").agg(F.sum("_sum").alias("_upper_sum"))
    before = Window.partitionBy(group).orderBy("_upper").rowsBetween(Window.unboundedPreceding, -1)
    upper = upper.withColumn("_upper_start", F.coalesce(F.sum("_upper_sum").over(before), F.lit(0).cast("long")))
    inner = Window.partitionBy(group, "_upper").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    small = small.withColumn("_inner", F.coalesce(F.sum("_sum").over(inner), F.lit(0).cast("long")))
    return small.join(upper, [group, "_upper"]).select(group, "_bucket", (F.col("_inner") + F.col("_upper_start")).alias("_start"))


def running_start(df: DataFrame, group: str, value: Column, order: list[Column], starts: DataFrame | None = None) -> DataFrame:
    """Add ``_before``: the total of ``value`` over the rows of the group that come
    earlier. The order is by ``_bucket``, which the table must have, then ``order``.
    ``starts`` may bring further columns by (``group``, ``_bucket``)."""
    starts = bucket_starts(df, group, value) if starts is None else starts
    inner = Window.partitionBy(group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = df.join(starts, [group, "_bucket"])
    before = F.coalesce(F.sum(value).over(inner), F.lit(0).cast("long"))
    return joined.withColumn("_before", before + F.col("_start")).drop("_start")
