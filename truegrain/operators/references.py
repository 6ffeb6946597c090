"""Checks of a table against other tables: membership with a bitmap before the join, and rules that name what they need."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truegrain.functions import cells
from truegrain.functions.joins import join_on
from truegrain.functions.rules import Rule
from truegrain.operators import measures
from truegrain.operators.duplicates import deduplicate

BITS = 32768  # of one bitmap of Spark's
BITMAPS = 256  # 1 MB together, whatever the reference's size
#: Types whose equal values have equal hashes.
HASHED = (T.IntegralType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def _place(value: Column, bitmaps: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(bitmaps * BITS)) + 1


def bitmaps_of(reference: DataFrame, key: str, bitmaps: int = BITMAPS) -> DataFrame:
    """``bucket, bits``: at most ``bitmaps + 1`` rows of 4 KB, in which the hashes of all keys are marked."""
    place = _place(cells.column(key), bitmaps)
    known = reference.where(cells.column(key).isNotNull())
    return known.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )


def _marked(bits: Column, place: Column) -> Column:
    """Whether a bitmap has a place's bit."""
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, (at % 8).cast("int")) == 1


def with_possible(df: DataFrame, name: str, reference: DataFrame, key: str, flag: str, bitmaps: int = BITMAPS) -> DataFrame:
    """Add ``flag``: false where a value is certainly not in the reference, judged without a shuffle of the table.

    The bitmaps are broadcast: they are of fixed size. With many more keys than bits they tell less, and nothing else changes.
    """
    place = _place(cells.column(name), bitmaps)
    found = F.broadcast(bitmaps_of(reference, key, bitmaps).select(F.col("bucket").alias("__bucket"), F.col("bits").alias("__bits")))
    met = df.withColumn("__at", F.bitmap_bucket_number(place)).join(found, F.col("__at") == F.col("__bucket"), "left")
    possible = cells.column(name).isNotNull() & F.coalesce(_marked(F.col("__bits"), place), F.lit(False))
    return met.withColumn(flag, possible).drop("__at", "__bucket", "__bits")


def prefiltered_violations(
    df: DataFrame, name: str, reference: DataFrame, key: str, bitmaps: int = BITMAPS
) -> DataFrame:
    """As ``measures.reference_violations``, but values that the bitmaps rule out are counted where they are read.

    Only values that may be known are grouped, shuffled and joined. Without a common type that hashes alike there is no
    prefilter, and the answer is the same.
    """
    kind = df.schema[name].dataType
    if kind != reference.schema[key].dataType or not isinstance(kind, HASHED):
        return measures.reference_violations(df, name, reference, key)
    value = cells.column(name).alias("value")
    told = with_possible(df.select(value), "value", reference, key, "__possible", bitmaps)
    values = told.groupBy(F.when(F.col("__possible"), F.col("value")).alias("value")).agg(F.count("*").alias("n"))
    known = reference.select(cells.column(key).alias("known")).distinct()
    matched = values.join(known, F.col("value") == F.col("known"), "left")
    totals = matched.agg(
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("violations"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
    )
    return totals.select(
        F.lit(name).alias("column_name"), "violations", "checked",
        measures.share_passed(F.col("violations"), F.col("checked")).alias("accuracy"),
    )


@dataclass(frozen=True)
class Reference:
    """A table that rules look things up in: its rows by key, and the columns that rules read.

    ``on`` maps a column of the checked table, or one an earlier reference brought, to a key column. ``small`` tells that the
    reference is a list of fixed size, to be broadcast.
    """

    table: DataFrame
    on: Mapping[str, str]
    columns: Sequence[str] = ()
    small: bool = False


@dataclass(frozen=True)
class CrossRule:
    """A row rule, and the names of the references it reads: column ``c`` of reference ``r`` is ``r_c`` in a row.

    ``r_found`` is present where the reference has the row's key.
    """

    rule: Rule
    references: Sequence[str] = ()


def with_references(df: DataFrame, references: Mapping[str, Reference], rules: Mapping[str, CrossRule]) -> DataFrame:
    """The rows with what the rules read of other tables beside them; every row stays, once.

    A reference is joined once, whatever the number of rules that read it, and not at all if none does. Of several
    rows of a reference with the same key the least counts. Null keys find nothing.
    """
    unknown = {r for rule in rules.values() for r in rule.references} - set(references)
    if unknown:
        raise ValueError(f"rules name references that are not declared: {sorted(unknown)}")
    out = df
    for name, reference in references.items():
        if not any(name in rule.references for rule in rules.values()):
            continue
        keys = list(reference.on.values())
        columns = [c for c in reference.columns if c not in keys]
        rows = deduplicate(reference.table.select(*(cells.column(c) for c in (*keys, *columns))), keys)
        rows = rows.where(~measures.any_of([cells.column(k).isNull() for k in keys]))
        brought = rows.select(
            *(cells.column(k).alias(c) for c, k in reference.on.items()),
            *(cells.column(c).alias(f"{name}_{c}") for c in reference.columns),
            F.lit(True).alias(f"{name}_found"),
        )
        out = join_on(out, brought, list(reference.on), "left", broadcast=reference.small)
    return out


def cross_violations(
    df: DataFrame, references: Mapping[str, Reference], rules: Mapping[str, CrossRule], by: Sequence[str] = ()
) -> DataFrame:
    """Rows that break each rule, in the form of ``measures.violations``."""
    joined = with_references(df, references, rules)
    checks = measures.consistency_checks(joined, {name: rule.rule for name, rule in rules.items()})
    return measures.violations(joined, checks, by)
