"""Row contracts: typing, ordered rules, first failing reason, quarantine split."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.functions import casting
from lakegate.operators import joins
from lakegate.sources.staging import stage_measured

REASON = "rejection_reason"
_SETTLED = "__first_failing"

SAFE_KINDS = ("key", "enum", "number", "timestamp")

Predicate = Callable[["RuleContext"], Column]


@dataclass(frozen=True)
class RuleContext:
    """Options that change how rules see a row."""

    reject_null_enum: bool = False
    counts: Mapping[str, str] | None = None


@dataclass(frozen=True)
class Field:
    """One contract column. Kinds: key, enum, number, timestamp (safe); any SQL type (strict)."""

    name: str
    kind: str


@dataclass(frozen=True)
class Rule:
    reason: str
    fails: Predicate


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    rules: tuple[Rule, ...]
    unique_keys: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [field.name for field in self.fields]


# --- rule vocabulary -------------------------------------------------------------------


def any_null(*names: str) -> Predicate:
    def predicate(_: RuleContext) -> Column:
        return _any(F.col(name).isNull() for name in names)

    return predicate


def not_after(later: str, earlier: str) -> Predicate:
    return lambda _: F.col(later) <= F.col(earlier)


def outside(name: str, allowed: Sequence[str]) -> Predicate:
    """Value not in the list. A NULL is undecided and passes unless ``reject_null_enum``."""

    def predicate(context: RuleContext) -> Column:
        unlisted = ~F.col(name).isin(list(allowed))
        return F.coalesce(unlisted, F.lit(True)) if context.reject_null_enum else unlisted

    return predicate


def not_positive_number(name: str) -> Predicate:
    return lambda _: (
        F.col(name).isNull() | ~casting.is_finite(F.col(name)) | (F.col(name) <= F.lit(0.0))
    )


def not_number(*names: str) -> Predicate:
    """Missing or non-finite. Missing is tested over all columns first."""

    def predicate(_: RuleContext) -> Column:
        missing = _any(F.col(name).isNull() for name in names)
        return missing | _any(~casting.is_finite(F.col(name)) for name in names)

    return predicate


def negative(*names: str) -> Predicate:
    return lambda _: _any(F.col(name) < F.lit(0.0) for name in names)


def unreconciled(total: str, base: str, minus: str, plus: str, tolerance: float) -> Predicate:
    return lambda _: reconciliation_gap(total, base, minus, plus) > F.lit(tolerance)


def repeated(key: str) -> Predicate:
    """Key occurs on more than one row of the feed (counted before any rule is applied)."""

    def predicate(context: RuleContext) -> Column:
        return F.col(context.counts[key]) > 1

    predicate.counted = True
    return predicate


def reconciliation_gap(total: str, base: str, minus: str, plus: str) -> Column:
    """Distance between a stated total and ``base - minus + plus``."""
    return F.abs(F.col(total) - ((F.col(base) - F.col(minus)) + F.col(plus)))


def _any(conditions) -> Column:
    result = None
    for condition in conditions:
        result = condition if result is None else result | condition
    return result


# --- operators -------------------------------------------------------------------------


def conform(
    df: DataFrame, fields: Sequence[Field], *, whole_date: bool = True, once: bool = True
) -> DataFrame:
    """Type the contract columns and keep every other column (provenance) as it is.

    Safe kinds turn bad values into NULL; every other kind is a SQL type cast strictly, so
    under ANSI mode a bad value stops the job. With ``once`` the parsed columns can be
    filtered without parsing them again; without it, unused ones are not parsed at all.
    """

    def typed(field: Field) -> Column:
        column = F.col(field.name)
        is_text = isinstance(df.schema[field.name].dataType, T.StringType)
        match field.kind:
            case "key":
                return casting.key_text(column)
            case "enum":
                return casting.enum_text(column)
            case "number":
                return casting.safe_number(column, is_text=is_text)
            case "timestamp":
                return casting.safe_timestamp(column, is_text=is_text, whole_date=whole_date)
            case sql_type:
                return column.cast(sql_type)

    names = {field.name for field in fields}
    rest = [name for name in df.columns if name not in names]
    result = df.select(*[typed(field).alias(field.name) for field in fields], *rest)
    safe = any(field.kind in SAFE_KINDS for field in fields)
    return evaluated_once(result) if safe and once else result


def evaluated_once(df: DataFrame) -> DataFrame:
    """Keep filters above the parsing of these columns.

    A filter on parsed columns would be pushed below the projection with every parsing
    expression copied into it, once per use: the trip contract then parses each timestamp
    several times per row. Predicates do not pass a generator, and this one stays inside the
    same generated code.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeated keys as (key_name, key_value, n): one scan and one partially aggregated
    shuffle for all keys together; NULL keys are left out."""
    pairs = [
        F.struct(F.lit(key).alias("key_name"), F.col(key).cast("string").alias("key_value"))
        for key in keys
    ]
    return (
        df.select(F.explode(F.array(*pairs)).alias("pair"))
        .select("pair.key_name", "pair.key_value")
        .where(F.col("key_value").isNotNull())
        .groupBy("key_name", "key_value")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def attach_key_counts(
    df: DataFrame,
    counts: Mapping[str, str],
    *,
    keys_only: DataFrame | None = None,
    limit: int = joins.BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Add, per key column, the number of rows sharing its value (NULL for a NULL key).

    This is a windowed count without the window: a window would sort every row of a hot key
    in one task. Only repeated keys are joined back. They are staged and measured; a small
    set is broadcast and the rows are not shuffled at all, a large one is joined with heavy
    keys dealt by their counts. ``keys_only`` may give the same keys by a cheaper route. A frame that
    was shuffled already should carry its scan's :data:`joins.ROW_ID`.
    """
    source = df if keys_only is None else keys_only
    repeats, size = stage_measured(key_counts(source, list(counts)), "key-counts")
    result = df if size <= limit else joins.with_row_id(df)
    for key, output in counts.items():
        of_key = repeats.where(F.col("key_name") == key).select(
            F.col("key_value").alias("__key_value"), F.col("n").alias("__n")
        )
        keyed, on = result, key
        if not isinstance(result.schema[key].dataType, T.StringType):
            keyed, on = result.withColumn("__key", F.col(key).cast("string")), "__key"
        if size <= limit:
            joined = keyed.join(F.broadcast(of_key), F.col(on) == F.col("__key_value"), "left")
        else:
            splits = joins.splits_from_counts(
                of_key, "__key_value", "__n", source.agg(F.count(F.lit(1))).scalar(), joins.tasks(df)
            )
            joined = joins.salted_left_join(keyed, of_key, on, "__key_value", splits)
        counted = F.when(F.col(key).isNotNull(), F.coalesce(F.col("__n"), F.lit(1)))
        result = joined.withColumn(output, counted).drop("__key", "__key_value", "__n")
    return result.drop(joins.ROW_ID)


def classify(df: DataFrame, contract: Contract, context: RuleContext | None = None) -> DataFrame:
    """Add the first failing rule's reason, NULL for an accepted row.

    Rules whose outcome :func:`settled` has added are not applied again.
    """
    context = context or RuleContext()
    reason = None
    for number, rule in enumerate(contract.rules):
        branch = F.when if reason is None else reason.when
        known = _SETTLED in df.columns and not _counted(rule)
        fails = F.col(_SETTLED) == number if known else rule.fails(context)
        reason = branch(fails, F.lit(rule.reason))
    return df.withColumn(REASON, reason).drop(_SETTLED)


def settled(df: DataFrame, contract: Contract, context: RuleContext) -> DataFrame:
    """Add the number of the first failing rule among those that need no key counts.

    Who wants the reasons alone then takes that number and the keys through the join with the
    counts, and no other field.
    """
    first = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(contract.rules))):
        if not _counted(rule):
            first = F.when(rule.fails(context), F.lit(number)).otherwise(first)
    return df.withColumn(_SETTLED, first)


def _counted(rule: Rule) -> bool:
    return getattr(rule.fails, "counted", False)


def apply_contract(
    raw: DataFrame,
    contract: Contract,
    *,
    reject_null_enum: bool = False,
    whole_date: bool = True,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Typed rows with their rejection reason; accepted and rejected rows together.

    ``keys_from`` may hold the unique keys of the same rows by a cheaper route.
    """
    typed = conform(raw, contract.fields, whole_date=whole_date)
    counts = {key: f"{key}_count" for key in contract.unique_keys}
    context = RuleContext(reject_null_enum=reject_null_enum, counts=counts)
    if counts:
        typed = settled(typed, contract, context)
        key_fields = [field for field in contract.fields if field.name in counts]
        source = raw if keys_from is None else keys_from
        keys = conform(source.select(*counts), key_fields, whole_date=whole_date, once=False)
        typed = attach_key_counts(typed, counts, keys_only=keys)
    return classify(typed, contract, context).drop(*counts.values())


def accepted(judged: DataFrame) -> DataFrame:
    return judged.where(F.col(REASON).isNull()).drop(REASON)


def rejected(judged: DataFrame) -> DataFrame:
    return judged.where(F.col(REASON).isNotNull())


def rejection_reasons(judged: DataFrame) -> DataFrame:
    return (
        rejected(judged).groupBy(REASON).agg(F.count(F.lit(1)).alias("rows"))
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """One row: how many key values occur more than once. NULL is a key value here."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("duplicate_keys"))
    )
