"""Age bands and reference rates."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.functions.columns import add_columns, col, number
from grainmill.operators.joins import band_join

# Band edges and labels of the two rate sources. The last band is open.
SEVEN_BANDS = (
    (18, 24, "18–24"),
    (25, 34, "25–34"),
    (35, 44, "35–44"),
    (45, 54, "45–54"),
    (55, 64, "55–64"),
    (65, 74, "65–74"),
    (75, None, "75 years and over"),
)
FOUR_BANDS = (
    (18, 24, "18–24 years"),
    (25, 44, "25–44 years"),
    (45, 64, "45–64 years"),
    (65, None, "65 years and older"),
)

Band = tuple[int, int | None, str]

SEARCHED = 500  # bands of a table that may stand in the plan


def band_label(x: Column, bands: Sequence[Band]) -> Column:
    """Label of the closed band that holds the number; null below, between and outside the bands, and for NaN."""
    x = number(x)
    label = F.lit(None).cast("string")
    for low, high, text in reversed(bands):
        test = x >= F.lit(low)
        label = F.when(test if high is None else test & (x <= F.lit(high)), text).otherwise(label)
    return label


def rate_table(spark: SparkSession, bands: Sequence[Band], rates: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """`(lo, hi, group, rate)` from `{label: (male, female)}`; group 1 is male, 0 is female."""
    rows = []
    for low, high, label in bands:
        for group, rate in zip((1, 0), rates.get(label, (None, None))):
            rows.append({"lo": float(low), "hi": None if high is None else float(high), "group": group, "rate": rate})
    fields = [("lo", pa.float64()), ("hi", pa.float64()), ("group", pa.int32()), ("rate", pa.float64())]
    return spark.createDataFrame(pa.Table.from_pylist(rows, pa.schema(fields)))  # a local relation


def rates_by_label(spark: SparkSession, bands: Sequence[Band], found: DataFrame) -> DataFrame:
    """The same table from `(label, male_rate, female_rate)` rows read off a page."""
    edges = spark.createDataFrame([(float(lo), None if hi is None else float(hi), label) for lo, hi, label in bands], "lo double, hi double, label string")
    sexes = F.array(
        F.struct(F.lit(1).alias("group"), F.col("male_rate").alias("rate")),
        F.struct(F.lit(0).alias("group"), F.col("female_rate").alias("rate")),
    )
    return F.broadcast(edges).join(found, "label").select("lo", "hi", F.inline(sexes))


def sex_group(sex: Column) -> Column:
    """1 for male (value 1); anything else, null too, is 0."""
    return F.when(sex == 1, 1).otherwise(0)


def add_rate(df: DataFrame, rates: DataFrame, value: str, sex: str, out: str) -> DataFrame:
    """The rate of the row's band and sex, null where no band holds the value."""
    return add_rates(df, {out: rates}, value, sex)


def add_rates(df: DataFrame, tables: dict[str, DataFrame], value: str, sex: str) -> DataFrame:
    """The rates of the row's band and sex from several tables `(lo, hi, group, rate)` with bands of their own.

    The edges of all tables are swept into stretches on which no table's rate changes, and a row finds its stretch
    by binary search in the plan: no join. Tables of more than `SEARCHED` bands, or with bands that overlap, are
    joined one after the other.
    """
    read = {out: rates.select("lo", "hi", "group", "rate").limit(SEARCHED + 1).collect() for out, rates in tables.items()}
    stretches = refined({out: [tuple(r) for r in rows] for out, rows in read.items()}) if all(len(r) <= SEARCHED for r in read.values()) else None
    if stretches is None:
        for out, rates in tables.items():
            df = band_join(df, rates.withColumnRenamed("rate", out), col(value), sex_group(col(sex)))
        return df
    groups = sorted(stretches)
    if not groups:
        return add_columns(df, {out: F.lit(None).cast("double") for out in tables})
    steps = max(len(stretches[g]) for g in groups).bit_length()
    width = (1 << steps) - 1
    filled = {g: [s for s, _ in stretches[g]] + [math.nan] * (width - len(stretches[g])) for g in groups}  # NaN is above all
    starts = F.array(*[F.lit(x) for g in groups for x in filled[g]])
    base = F.array_position(F.array(*[F.lit(g) for g in groups]), sex_group(col(sex))) - 1
    placed = df.withColumns({"_x": number(col(value)), "_base": base, "_at": F.lit(0).cast("bigint")})
    for step in (1 << k for k in reversed(range(steps))):
        reached = F.col("_x") >= F.get(starts, F.col("_base") * width + F.col("_at") + (step - 1))
        placed = placed.withColumn("_at", F.col("_at") + F.when(reached, step).otherwise(0))
    known = F.col("_x").isNotNull() & (F.col("_base") >= 0) & (F.col("_at") > 0)
    for i, out in enumerate(tables):
        rates = [[r[i] for _, r in stretches[g]] + [None] * (width - len(stretches[g])) for g in groups]
        table = F.array(*[F.lit(x).cast("double") for of in rates for x in of])
        placed = placed.withColumn(out, F.when(known, F.get(table, F.col("_base") * width + F.col("_at") - 1)))
    return placed.drop("_x", "_base", "_at")


def refined(tables: dict[str, list[tuple]]) -> dict[int, list[tuple[float, list]]] | None:
    """`{group: [(start, rate of each table), …]}` in the order of starts, from rows `(lo, hi, group, rate)`.

    Bands are closed, so behind a band the next stretch starts at the next larger double; without `hi` a band has
    no end. Rates are None where a table has no band. None if bands of one table and group overlap.
    """
    events: dict[int, list[tuple[float, int, int, object]]] = {}
    for i, rows in enumerate(tables.values()):
        for low, high, group, rate in rows:
            if low is None or math.isnan(low) or group is None or (high is not None and not high >= low):
                continue
            events.setdefault(group, []).append((low, 1, i, rate))
            if high is not None and high < math.inf:
                events[group].append((math.nextafter(high, math.inf), 0, i, None))
    result: dict[int, list[tuple[float, list]]] = {}
    for group, found in events.items():
        rates, inside, stretches = [None] * len(tables), [0] * len(tables), []
        found.sort(key=lambda e: e[:3])  # ends before beginnings
        for start, same in groupby(found, key=lambda e: e[0]):
            for _, begins, i, rate in same:
                inside[i] += 1 if begins else -1
                rates[i] = rate
                if inside[i] > 1:
                    return None
            stretches.append((start, list(rates)))
        result[group] = stretches
    return result


def add_band_label(df: DataFrame, value: str, bands: Sequence[Band], out: str) -> DataFrame:
    return add_columns(df, {out: band_label(col(value), bands)})
