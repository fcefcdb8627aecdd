"""Order-independent content hashes built from native expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SLICES = 4
_SLICE_DIGITS = 15  # 60 bits, always inside a signed BIGINT
_LIMBS, _LIMB_BITS = 3, 20
#: Columns of added slices.
SUMS = tuple(f"sum_{i}" for i in range(_SLICES))


def canonical_cell(column: Column, dtype: T.DataType) -> Column:
    """Type-tagged text of one value; equal texts mean equal values.

    Text carries its length so that no separator needs escaping. Doubles become sign and two
    integers (units of 2**-20 and the remainder in units of 2**-80), which makes -0.0 equal 0.0
    and keeps engine-specific float formatting out of the hash; the few that these integers do
    not hold exactly are written in their shortest distinguishing digits.
    """
    if isinstance(dtype, T.StringType):
        cell = F.concat(F.lit("s"), F.length(column).cast("string"), F.lit(":"), column)
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        value = column.cast("double")
        units = F.abs(value) * F.lit(2.0**20)
        whole = F.floor(units)
        rest = (units - whole.cast("double")) * F.lit(2.0**60)
        sign = F.when(value < 0, F.lit("d-")).otherwise(F.lit("d"))
        small = F.concat(sign, whole.cast("string"), F.lit("_"), F.floor(rest).cast("string"))
        held = (F.abs(value) < F.lit(1e12)) & (rest == F.floor(rest).cast("double"))
        cell = F.when(held, small).otherwise(F.concat(F.lit("x"), value.cast("string")))
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        cell = F.concat(F.lit("t"), column.cast("string"))
    elif isinstance(dtype, T.DateType):
        cell = F.concat(F.lit("c"), column.cast("string"))
    elif isinstance(dtype, T.BooleanType):
        cell = F.concat(F.lit("b"), column.cast("string"))
    elif isinstance(dtype, (T.IntegralType, T.DecimalType)):
        cell = F.concat(F.lit("i"), column.cast("string"))
    else:
        raise TypeError(f"no canonical form for {dtype.simpleString()}")
    return F.coalesce(cell, F.lit("n"))


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    cells = [canonical_cell(F.col(name), df.schema[name].dataType) for name in columns]
    return F.sha2(F.concat_ws("|", *cells), 256)


def multiset_sums(df: DataFrame, digest: Column, by: Sequence[str] = ()) -> DataFrame:
    """Sums of the slices of row digests: ``row_count`` and :data:`SUMS` per group.

    Digest slices are added (not XOR-ed, so duplicates count) in partial aggregates: each
    task ships one row per group, whatever the number or skew of its input rows. The sums of
    disjoint parts add up to those of the whole (:func:`united`).
    """
    # A slice has 60 bits; it is added as three BIGINT limbs of 20, which hold 2**43 rows, and
    # put together as a decimal once per group.
    rows = df.select(*by, digest.alias("__digest"))
    slices = [
        F.conv(F.substring(F.col("__digest"), 1 + i * _SLICE_DIGITS, _SLICE_DIGITS), 16, 10)
        .cast("bigint")
        .alias(f"__h{i}")
        for i in range(_SLICES)
    ]
    limbs = [
        F.sum(F.shiftright(f"__h{i}", _LIMB_BITS * j).bitwiseAND(F.lit((1 << _LIMB_BITS) - 1))).alias(f"__h{i}_{j}")
        for i in range(_SLICES)
        for j in range(_LIMBS)
    ]
    added = rows.select(*by, *slices).groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), *limbs)

    def together(i: int) -> Column:
        parts = [
            F.coalesce(f"__h{i}_{j}", F.lit(0)).cast("decimal(19,0)")
            * F.lit(1 << _LIMB_BITS * j).cast("decimal(13,0)")
            for j in range(_LIMBS)
        ]
        return (parts[0] + parts[1] + parts[2]).cast("decimal(38,0)")

    return added.select(*by, "row_count", *[together(i).alias(name) for i, name in enumerate(SUMS)])


def united(sums: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sums of parts put together."""
    added = [F.coalesce(F.sum(name), F.lit(0)).cast("decimal(38,0)").alias(name) for name in SUMS]
    rows = F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count")
    return sums.groupBy(*by).agg(rows, *added)


def sums_digest() -> Column:
    """The hash of a bag from its row count and sums."""
    return F.sha2(
        F.concat_ws(":", F.col("row_count").cast("string"), *[F.col(x).cast("string") for x in SUMS]),
        256,
    )


def multiset_digest(df: DataFrame, digest: Column, by: Sequence[str] = ()) -> DataFrame:
    """Hash of a bag of row digests: ``row_count`` and ``fingerprint_sha256``."""
    return multiset_sums(df, digest, by).select(
        *by, "row_count", sums_digest().alias("fingerprint_sha256")
    )
