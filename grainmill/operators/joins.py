"""Joins with lookup tables and row-aligned frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.functions.columns import col, present

BROADCAST_ROWS = 100_000  # lookup rows that every executor may hold
BROADCAST_BYTES = 64 << 20  # and their size, as text
LOOPED_BANDS = 100  # bands that every row may be compared with


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """True if the frame has at most `rows` rows of `size` bytes in all; stops reading beyond that many rows."""
    wide = F.octet_length(F.to_json(F.struct(*[col(c) for c in df.columns]))) if df.columns else F.lit(0)
    n, held = df.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(wide), F.lit(0))).first()
    return n <= rows and held <= size


def lookup_side(df: DataFrame) -> DataFrame:
    """The frame with a broadcast hint where its checked size allows it, as it is otherwise."""
    return F.broadcast(df) if fits_broadcast(df) else df


def outer_with_lookup(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str) -> DataFrame:
    """Full outer equi-join that keeps both key columns; null keys match nothing.

    With a small lookup the big side is not shuffled, however hot its keys are: a broadcast left join, plus
    the lookup rows whose key does not occur (a second scan of the key column alone, one row per lookup key
    and task after the map side). A large lookup takes the ordinary full outer join. A side that is itself a
    small aggregate needs neither: `outer_small` reads it once.
    """
    if not fits_broadcast(lookup):
        return outer_small(df, lookup, key, lookup_key)
    matched = df.join(F.broadcast(lookup), col(key) == lookup[lookup_key], "left")
    wanted = F.broadcast(lookup.select(F.col(lookup_key).alias("_wanted")))
    occurring = df.select(col(key).alias("_key")).join(wanted, F.col("_key") == F.col("_wanted"), "left_semi").distinct()
    rest = lookup.join(F.broadcast(occurring), lookup[lookup_key] == F.col("_key"), "left_anti")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    return matched.unionAll(rest.select(*empty, *[col(c) for c in lookup.columns]))


def outer_small(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str) -> DataFrame:
    """The same result by one plain full outer join: for aggregates, which have a row per key."""
    return df.join(lookup, col(key) == lookup[lookup_key], "outer")


def concat_columns(left: DataFrame, right: DataFrame, *row_id: str) -> DataFrame:
    """Columns of both frames side by side, rows lined up by a carried row id.

    Rows of one side without a partner keep nulls for the other. An id that occurs twice on a side raises in
    the job that computes the result.
    """
    shared = (set(left.columns) & set(right.columns)) - set(row_id)
    if shared:
        raise ValueError(f"columns on both sides: {', '.join(sorted(shared))}")
    sides = []
    for side, mark in ((left, "_in_left"), (right, "_in_right")):
        once = F.count("*").over(Window.partitionBy(*[col(c) for c in row_id])) == 1
        checked = F.when(once, F.lit(True)).otherwise(F.raise_error(F.lit(f"a row id occurs twice: {', '.join(row_id)}")).cast("boolean"))
        sides.append(side.withColumn(mark, checked))
    joined = sides[0].join(sides[1], list(row_id), "outer")
    # The marks are read, so that the check is not pruned.
    return joined.filter(F.coalesce("_in_left", F.lit(False)) | F.coalesce("_in_right", F.lit(False))).drop("_in_left", "_in_right")


def is_unique(df: DataFrame, *key: str) -> bool:
    """True if no key value occurs twice."""
    repeated = df.groupBy(*[col(k) for k in key]).agg(F.count("*").alias("_n")).filter("_n > 1")
    return repeated.isEmpty()


def band_join(df: DataFrame, bands: DataFrame, value: Column, equal: Column | None = None) -> DataFrame:
    """Left join to the closed band `(lo, hi)` that holds `value`; an open band has a null `hi`.

    `bands` has `lo`, `hi`, other columns and, with `equal`, a column `group` compared with it.
    Up to a hundred bands of a checked small table are tried on every row. More are cut into value cells, so
    that the join is an equi-join on (group, cell): bands do not overlap, so a band is copied once per cell it
    touches, and cells are as wide as the group's own bands ask for. Rows that no band can hold (null, NaN,
    unknown group, outside the group's bands) stay out of that join.
    """
    keyed = df.withColumn("_x", value)
    keyed = keyed.withColumn("_x", present(keyed, "_x"))
    if equal is not None:
        keyed = keyed.withColumn("_group", equal)
    inside = (F.col("_x") >= F.col("lo")) & (F.col("hi").isNull() | (F.col("_x") <= F.col("hi")))
    if fits_broadcast(bands, LOOPED_BANDS):
        on = inside & (F.col("_group") == F.col("group")) if equal is not None else inside
        joined = keyed.join(F.broadcast(bands), on, "left")
    else:
        joined = _celled_band_join(keyed, bands, inside, equal is not None)
    return joined.drop("_x", "_group", "group", "lo", "hi")


def _celled_band_join(keyed: DataFrame, bands: DataFrame, inside: Column, grouped: bool) -> DataFrame:
    """The same by cells of a width that each group takes from its own bands."""
    columns = bands.columns
    of_group = ["group"] if grouped else []
    extent = bands.groupBy(*of_group).agg(
        F.min("lo").cast("double").alias("_first"),
        F.max(F.coalesce(F.col("hi"), F.col("lo"))).cast("double").alias("_end"),
        F.max(F.col("hi").isNull()).alias("_open"),
        F.count("*").alias("_n"),
    )
    extent = extent.withColumn("_width", F.greatest((F.col("_end") - F.col("_first")) / F.col("_n"), F.lit(1e-300)))

    def cell(x: Column) -> Column:
        """The number of the cell; the last one holds all beyond the end."""
        return F.floor((F.least(x.cast("double"), F.col("_end")) - F.col("_first")) / F.col("_width")).cast("bigint")

    sized = bands.join(lookup_side(extent), of_group) if grouped else bands.crossJoin(F.broadcast(extent))  # one row
    sized = sized.withColumn("_cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.coalesce(F.col("hi").cast("double"), F.col("_end"))))))
    cut = sized.select(*[col(c) for c in columns], F.col("_cell").alias("_band_cell"))

    extent = extent.withColumnRenamed("group", "_known") if grouped else extent
    able = (F.col("_x") >= F.col("_first")) & (F.col("_open") | (F.col("_x") <= F.col("_end")))
    placed = keyed.join(lookup_side(extent), F.col("_group") == F.col("_known"), "left") if grouped else keyed.crossJoin(F.broadcast(extent))
    placed = placed.withColumn("_cell", F.when(able, cell(F.col("_x"))))
    on = (F.col("_cell") == F.col("_band_cell")) & inside
    if grouped:
        on = on & (F.col("_group") == F.col("group"))
    helpers = ["_first", "_end", "_open", "_n", "_width", "_cell", "_known"]
    found = placed.filter(F.col("_cell").isNotNull()).drop(*[h for h in helpers if h != "_cell"])
    left_out = placed.filter(F.col("_cell").isNull()).drop(*helpers)
    joined = found.join(lookup_side(cut), on, "left").drop("_cell", "_band_cell")
    return joined.unionByName(left_out, allowMissingColumns=True)
