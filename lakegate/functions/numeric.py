"""Rounding and aggregates whose result does not depend on how rows are partitioned."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scaled_round(column: Column, digits: int) -> Column:
    """Half-away-from-zero rounding of the scaled binary value."""
    scale = F.lit(10.0**digits)
    return F.round(column * scale, 0) / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def share(condition: Column) -> Column:
    """Share of rows meeting the condition; NULL conditions count as not met."""
    return ratio(F.count_if(condition), F.count(F.lit(1)))


# --- order-free sums -------------------------------------------------------------------
#
# Adding doubles gives other last bits under another partitioning, which would change rounded
# marts and fingerprints between two builds of the same data. A value is therefore written as a
# whole number of units, cut into limbs of 21 bits, and the limbs are added as BIGINT: integer
# sums do not depend on their order, and 2**42 rows fit. Which unit is meant depends on the
# value's class, 52 binary exponents each; class 0 holds what a table of amounts and measures
# normally holds (2**-28 up to 2**24, and 0), and all 40 or so classes together every double.

_LIMBS = 5
_LIMB_BITS = 21
_MASK = (1 << _LIMB_BITS) - 1
_CLASS_BITS = 52
#: Class 0: unit 2**-80, values from 2**-28 up to 2**24.
_UNIT_BITS = 80
_LOW_BITS, _HIGH_BITS = 28, 24
#: Bits of the two lower limbs.
_TAIL_BITS = 2 * _LIMB_BITS


@dataclass(frozen=True)
class Measure:
    """One output of :func:`exact_aggregate`.

    Kinds: ``rows``, ``sum``, ``mean``, ``share``, ``min``, ``max``. ``sum`` and ``mean`` are
    NULL without values; ``share`` is the share of rows that meet the condition, NULL counting as
    not met. ``finish`` is applied to the result.
    """

    name: str
    kind: str
    column: Column | None = None
    finish: Callable[[Column], Column] | None = None


def _class_sql(value: str) -> str:
    """The class of a finite double."""
    # A value on the border may fall into the class below, which has a bit to spare on top.
    return (
        f"CASE WHEN {value} = 0 OR abs({value}) >= power(2D, -{_LOW_BITS}) AND abs({value}) < power(2D, {_HIGH_BITS})"
        f" THEN 0 ELSE CAST(floor((log2(abs({value})) + {_LOW_BITS - 1e-9}D) / {_CLASS_BITS}D) AS INT) END"
    )


def _units_sql(value: str, class_: str) -> str:
    """A value in units of its class; in two factors, as 2**1172 is no double."""
    step = f"power(2D, {_UNIT_BITS // 2}D - {class_} * {_CLASS_BITS // 2}D)"
    return f"CASE WHEN {class_} = 0 THEN {value} * power(2D, {_UNIT_BITS}) ELSE {value} * {step} * {step} END"


def _limbs_sql(upper: str, lower: str) -> list[str]:
    """Five limbs of a value cut at bit 42; shifts round down, so only the last of a part is signed."""
    return [
        f"{lower} & {_MASK}",
        f"shiftright({lower}, {_LIMB_BITS})",
        f"{upper} & {_MASK}",
        f"shiftright({upper}, {_LIMB_BITS}) & {_MASK}",
        f"shiftright({upper}, {2 * _LIMB_BITS})",
    ]


def _nearest_sql(x: str) -> str:
    """The double nearest to the limbs of a struct with its class."""
    carried = f"({x}.l1 + shiftright({x}.l0, {_LIMB_BITS}))"
    tail = f"(shiftleft({carried} & {_MASK}, {_LIMB_BITS}) + ({x}.l0 & {_MASK}))"
    whole = (
        f"(CAST({x}.l4 AS DECIMAL(20,0)) * {2**_TAIL_BITS}BD + CAST({x}.l3 AS DECIMAL(20,0)) * {2**_LIMB_BITS}BD"
        f" + ({x}.l2 + shiftright({carried}, {_LIMB_BITS})))"
    )
    # Below 2**53 the whole part is a double and one addition rounds; above, the tail only
    # decides ties, so it is one bit below the last that counts.
    units = (
        f"CASE WHEN abs({whole}) < {2**53}BD THEN CAST({whole} AS DOUBLE) + {tail} * power(2D, -{_TAIL_BITS})"
        f" ELSE CAST({whole} * 4BD + IF({tail} = 0, 0BD, 1BD) AS DOUBLE) / 4D END"
    )
    step = f"power(2D, {x}.c * {_CLASS_BITS // 2}D)"
    return f"({units}) * power(2D, {_TAIL_BITS - _UNIT_BITS}) * {step} * {step}"


def _total_sql(parts: str) -> str:
    """Sum of (class, limbs) structs: exact inside a class, classes added from the highest down.

    As text, because it is parsed in one step; built from Python operators it took longer to build
    than to run.
    """
    added = ", ".join(f"'l{i}', a.l{i} + x.l{i}" for i in range(_LIMBS))
    zero = ", ".join(f"'l{i}', 0L" for i in range(_LIMBS))
    # A lone part, the usual case, needs no search for its class.
    by_class = (
        f"transform(reverse(array_sort(array_distinct({parts}.c))), k -> aggregate(filter({parts}, x -> x.c = k),"
        f" named_struct('c', k, {zero}), (a, x) -> named_struct('c', a.c, {added})))"
    )
    return f"aggregate(IF(size({parts}) < 2, {parts}, {by_class}), 0D, (t, y) -> t + {_nearest_sql('y')})"


class ExactMeasures:
    """Measures that no partitioning changes, in three steps that can be stored in between.

    ``partial`` adds rows per group and value classes (one combination, as long as all values are
    of class 0), with partial sums in every task. ``regrouped`` adds partial rows by fewer keys,
    so that a stored frame of them answers coarser questions. ``final`` puts the few rows of a
    group together.
    """

    def __init__(self, measures: Sequence[Measure]) -> None:
        self.measures = list(measures)
        #: Name of each summed column, by its text: columns used twice are added once.
        self.sums: dict[str, str] = {}
        self.inputs: dict[str, Column] = {}
        for measure in self.measures:
            if measure.kind in ("sum", "mean"):
                text = str(measure.column)
                if text not in self.sums:
                    self.sums[text] = measure.name
                    self.inputs[f"{measure.name}__v"] = measure.column.cast("double")
            elif measure.column is not None:
                self.inputs[f"{measure.name}__v"] = measure.column

    def _kind(self, *kinds: str) -> list[str]:
        return [m.name for m in self.measures if m.kind in kinds]

    @property
    def classes(self) -> list[str]:
        return [f"{name}__c" for name in self.sums.values()]

    def partial(self, df: DataFrame, keys: Mapping[str, Column | str]) -> DataFrame:
        """One row per group and combination of classes; ``{output: input}`` keys come first."""
        by = [(F.col(k) if isinstance(k, str) else k).alias(name) for name, k in keys.items()]
        rows = df.select(*by, *[column.alias(name) for name, column in self.inputs.items()])
        names = list(self.sums.values())
        # NaN and the infinities are added apart.
        finite = {n: f"NOT isnan(`{n}__v`) AND abs(`{n}__v`) < double('infinity')" for n in names}
        for step in (
            {"c": lambda n: f"CASE WHEN {finite[n]} THEN {_class_sql(f'`{n}__v`')} ELSE 0 END"},
            {"u": lambda n: f"CASE WHEN {finite[n]} THEN {_units_sql(f'`{n}__v`', f'`{n}__c`')} END"},
            {"upper": lambda n: f"CAST(`{n}__u` * power(2D, -{_TAIL_BITS}) AS BIGINT)"},
            {"lower": lambda n: f"CAST(`{n}__u` - `{n}__upper` * power(2D, {_TAIL_BITS}) AS BIGINT)"},
        ):
            rows = rows.withColumns(
                {f"{n}__{part}": F.expr(sql(n)) for part, sql in step.items() for n in names}
            )
        added = [F.count(F.lit(1)).alias("rows__n")]
        added += [F.count_if(F.col(f"{n}__v")).alias(f"{n}__met") for n in self._kind("share")]
        added += [F.min(f"{n}__v").alias(f"{n}__end") for n in self._kind("min")]
        added += [F.max(f"{n}__v").alias(f"{n}__end") for n in self._kind("max")]
        for n in names:
            added += [
                F.expr(f"coalesce(sum({limb}), 0L)").alias(f"{n}__{i}")
                for i, limb in enumerate(_limbs_sql(f"`{n}__upper`", f"`{n}__lower`"))
            ]
            added.append(F.count(f"{n}__v").alias(f"{n}__n"))
            added.append(F.expr(f"sum(CASE WHEN NOT ({finite[n]}) THEN `{n}__v` END)").alias(f"{n}__x"))
        return rows.groupBy(*keys, *self.classes).agg(*added)

    def _merging(self) -> list[Column]:
        counts = ["rows__n", *[f"{n}__met" for n in self._kind("share")]]
        counts += [f"{n}__n" for n in self.sums.values()]
        added = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts]
        added += [F.min(f"{n}__end").alias(f"{n}__end") for n in self._kind("min")]
        added += [F.max(f"{n}__end").alias(f"{n}__end") for n in self._kind("max")]
        return added + [F.sum(f"{n}__x").alias(f"{n}__x") for n in self.sums.values()]

    def regrouped(self, partials: DataFrame, keys: Mapping[str, Column | str]) -> DataFrame:
        """Partial rows by fewer or derived keys."""
        by = [(F.col(k) if isinstance(k, str) else k).alias(name) for name, k in keys.items()]
        limbs = [
            F.sum(f"{n}__{i}").alias(f"{n}__{i}") for n in self.sums.values() for i in range(_LIMBS)
        ]
        return partials.groupBy(*by, *self.classes).agg(*self._merging(), *limbs)

    def final(self, partials: DataFrame, keys: Sequence[str]) -> DataFrame:
        """One row per group; without keys one row, also for an empty frame."""
        parts = [
            F.expr(
                f"collect_list(named_struct('c', `{n}__c`, "
                + ", ".join(f"'l{i}', `{n}__{i}`" for i in range(_LIMBS))
                + "))"
            ).alias(f"{n}__p")
            for n in self.sums.values()
        ]
        merged = partials.groupBy(*keys).agg(*self._merging(), *parts)
        # The sums once, however many measures use them.
        merged = merged.withColumns(
            {
                f"{n}__s": F.expr(
                    f"CASE WHEN `{n}__n` > 0 THEN coalesce(`{n}__x`, {_total_sql(f'`{n}__p`')}) END"
                )
                for n in self.sums.values()
            }
        )
        return merged.select(*keys, *[self._result(measure) for measure in self.measures])

    def _result(self, measure: Measure) -> Column:
        if measure.kind == "rows":
            found = F.col("rows__n")
        elif measure.kind == "share":
            found = ratio(F.col(f"{measure.name}__met"), F.col("rows__n"))
        elif measure.kind in ("min", "max"):
            found = F.col(f"{measure.name}__end")
        else:
            name = self.sums[str(measure.column)]
            found = F.col(f"{name}__s")
            if measure.kind == "mean":
                found = ratio(found, F.col(f"{name}__n"))
        return (measure.finish(found) if measure.finish else found).alias(measure.name)


def exact_aggregate(
    df: DataFrame, keys: Mapping[str, Column | str], measures: Sequence[Measure]
) -> DataFrame:
    """Group by ``{output: input}`` and compute measures that no partitioning changes.

    Without keys there is one row, also for an empty frame. A sum is the double nearest to the
    exact sum of its values; where they spread over several classes, each class is exact and the
    classes are added in their order. An infinity or NaN among the values makes the sum infinite
    or NaN, as plain addition would.
    """
    exact = ExactMeasures(measures)
    return exact.final(exact.partial(df, keys), list(keys))


def exact_sum(df: DataFrame, column: str) -> Column:
    """Order-free sum of a double column as a scalar subquery; NULL without values."""
    return exact_aggregate(df, {}, [Measure("total", "sum", F.col(column))]).scalar()


