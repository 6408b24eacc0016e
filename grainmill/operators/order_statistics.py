"""Exact quantiles, ranks and modes that hold at any size.

`median`, `percentile` and `mode` as plain aggregates keep a map of all distinct values in the one
task that finishes a global aggregate. Here a fixed-size sketch proposes narrow intervals around the
wanted ranks, one counting scan makes them exact, and only the few values strictly inside an
interval are looked at one by one. No shuffle carries the values of a column. The scan finds the place
of a value among the splitters by binary search, so its code does not grow with splitters or columns.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.functions.columns import as_double, col, present

SKETCH_ACCURACY = 10_000
MARGIN = 2.0  # distance of a splitter from a wanted rank, in rank errors of the sketch
SPLITTERS = 2_000  # evenly spaced splitters where the wanted ranks are not known before the sketch
SMALL = 2_000  # rows of an interval that are read out without narrowing it first
MAX_VALUES = 100_000  # rows inside all intervals together that may be read out

Pair = tuple[float | None, float | None]


def value_counts(df: DataFrame, columns: Sequence[str], as_type: str | None = "double") -> DataFrame:
    """`(name, value, n)` over values that are neither null nor NaN: one scan, hot values combined map-side."""
    if as_type == "double":
        picked = df.select(*[as_double(df, c).alias(f"v{i}") for i, c in enumerate(columns)])
    else:
        picked = df.select(*[(present(df, c) if as_type is None else present(df, c).cast(as_type)).alias(f"v{i}") for i, c in enumerate(columns)])
    names = F.create_map(*[part for i, c in enumerate(columns) for part in (F.lit(f"v{i}"), F.lit(c))])
    return (
        picked.unpivot([], [f"v{i}" for i in range(len(columns))], "name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("name", "value")
        .agg(F.count("*").alias("n"))
        .select(names[F.col("name")].alias("name"), "value", "n")
    )


def distinct_estimates(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Approximate distinct counts of all columns in one scan, without a shuffle of the values."""
    row = df.agg(*[F.approx_count_distinct(col(c)).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    return dict(zip(columns, row))


# --- quantiles ----------------------------------------------------------------------------------


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], approx: bool = False) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation, nulls and NaN left out; `[None, …]` for an empty column.

    `approx=True` takes the sketch's answer (an actual value, no interpolation) in one scan.
    """
    columns, probabilities = list(columns), [float(p) for p in probabilities]
    if not columns or not probabilities:
        return {c: [] for c in columns}
    values = {c: as_double(df, c) for c in columns}
    around = [(p, p) if approx else _around(p) for p in probabilities]
    points = sorted({p for pair in around for p in pair})
    at, shares = {p: i for i, p in enumerate(points)}, _numbers(points, "double")
    row = df.agg(
        *[F.count(values[c]) for c in columns],
        *[F.percentile_approx(values[c], shares, SKETCH_ACCURACY) for c in columns],
    ).first()
    sizes = dict(zip(columns, row))
    sketched = {c: [(q[at[a]], q[at[b]]) for a, b in around] for c, q in zip(columns, row[len(columns) :]) if sizes[c]}
    if approx:
        return {c: [low for low, _ in sketched[c]] if sizes[c] else [None] * len(probabilities) for c in columns}

    places = {c: [p * (sizes[c] - 1) for p in probabilities] if sizes[c] else [] for c in columns}
    start = [_Interval(c, values[c], None, None, 0, sizes[c], {r for x in places[c] for r in (math.floor(x), math.ceil(x))}) for c in sketched]
    exact = _resolve(df, start, sketched)
    result: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    for c in sketched:
        ends = [(exact[c][math.floor(x)], exact[c][math.ceil(x)], x - math.floor(x)) for x in places[c]]
        result[c] = [low if low == high else low + (high - low) * part for low, high, part in ends]  # equal ends may be infinite
    return result


def medians(df: DataFrame, columns: Sequence[str], approx: bool = False) -> dict[str, float | None]:
    return {c: q[0] for c, q in quantiles(df, columns, [0.5], approx).items()}


def repaired_medians(df: DataFrame, ranges: dict[str, tuple[float | None, float | None]], approx: bool = False) -> dict[str, tuple[float | None, float | None]]:
    """Per column the median, and the median after all values outside the range have become the first one.

    Values in the range are a stretch of the sorted column, and the others are one value in the end, so the second
    median stands at ranks that the counts below and above the range give. One sketch with evenly spaced splitters
    and one counting scan find both medians of all columns; `approx=True` stops at the sketch.
    """
    if not ranges:
        return {}
    values = {c: as_double(df, c) for c in ranges}
    steps, asked = _numbers([i / SPLITTERS for i in range(SPLITTERS + 1)], "double"), []
    for c, (low, high) in ranges.items():
        under = values[c] < F.lit(low) if low is not None else F.lit(False)
        over = (values[c] > F.lit(high)) & ~under if high is not None else F.lit(False)
        asked += [F.count(values[c]), F.count_if(under), F.count_if(over), F.percentile_approx(values[c], steps, SKETCH_ACCURACY)]
    row = df.agg(*asked).first()
    counts = {c: (*row[4 * i : 4 * i + 3], row[4 * i + 3]) for i, c in enumerate(ranges)}
    start, sketched, middle = [], {}, {}
    for c, (n, under, over, grid) in counts.items():
        middle[c] = sorted({(n - 1) // 2, n // 2}) if n else []
        ranks = {r for k in middle[c] for r in (k, k + under, k - over) if 0 <= r < n}
        if n:
            start.append(_Interval(c, values[c], None, None, 0, n, ranks))
            sketched[c] = [_around_in(grid, (r + 0.5) / n) for r in sorted(ranks)]
    if approx:
        at = {i.name: {r: counts[i.name][3][round((r + 0.5) / i.inside * SPLITTERS)] for r in i.ranks} for i in start}
    else:
        at = _resolve(df, start, sketched)
    found: dict[str, tuple[float | None, float | None]] = {}
    for c, (n, under, over, _) in counts.items():
        if not n:
            found[c] = None, None
            continue
        first = _mean([at[c][k] for k in middle[c][:1] if approx] or [at[c][k] for k in middle[c]])
        outside, last = under + over, []
        for k in middle[c]:
            below = at[c][k + under] if k < n - outside else math.inf
            above = at[c][k - over] if k >= outside else -math.inf
            last.append(below if below < first else above if above > first else first)
        found[c] = first, _mean(last[:1] if approx else last)
    return found


def _mean(ends: Sequence[float]) -> float:
    return ends[0] if ends[0] == ends[-1] else ends[0] + (ends[-1] - ends[0]) * 0.5


def _around_in(grid: Sequence[float], share: float) -> Pair:
    """Splitters on both sides of a share, out of evenly spaced ones."""
    low, high = _around_at(share)
    return grid[low], grid[high]


def _around_at(share: float) -> tuple[int, int]:
    """Their numbers."""
    low, high = _around(share)
    return math.floor(low * SPLITTERS), math.ceil(high * SPLITTERS)


def iqr_bounds(df: DataFrame, columns: Sequence[str], factor: float = 1.5, approx: bool = False) -> dict[str, tuple[float, float]]:
    """`Q1 - factor*IQR` and `Q3 + factor*IQR` per column; a column without values is left out."""
    bounds = {}
    for c, (q1, q3) in quantiles(df, columns, [0.25, 0.75], approx).items():
        if q1 is not None:
            bounds[c] = (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    return bounds


# --- exact ranks --------------------------------------------------------------------------------


def ranked_values(df: DataFrame, wanted: dict[str, tuple[Column, Iterable[int]]]) -> dict[str, dict[int, float]]:
    """The value at each 0-based rank of each double expression, exactly; ranks outside the rows are left out."""
    sizes = df.agg(*[F.count(value) for value, _ in wanted.values()]).first()
    start = [_Interval(c, value, None, None, 0, n, {r for r in ranks if 0 <= r < n}) for (c, (value, ranks)), n in zip(wanted.items(), sizes)]
    return {c: {} for c in wanted} | _resolve(df, [i for i in start if i.ranks], {})


@dataclass
class _Interval:
    """An open interval of values, the rows below and inside it, and the ranks looked for in it."""

    name: str
    value: Column
    low: float | None
    high: float | None
    below: int
    inside: int
    ranks: set[int] = field(default_factory=set)

    def share(self, rank: int) -> float:
        """Where a rank lies among the rows inside."""
        return (rank - self.below + 0.5) / self.inside


def _around(share: float) -> tuple[float, float]:
    return max(0.0, share - MARGIN / SKETCH_ACCURACY), min(1.0, share + MARGIN / SKETCH_ACCURACY)


def _resolve(df: DataFrame, intervals: list[_Interval], sketched: dict[str, list[Pair]]) -> dict[str, dict[int, float]]:
    """Values at ranks. `sketched` holds pairs of splitters already at hand for whole columns.

    Each round counts the rows below and at every splitter. A rank falls on a splitter, which is the
    answer, or strictly between two. By the sketch's error bound only about `6 / SKETCH_ACCURACY` of
    an interval's rows lie strictly between a pair, however hot single values are: if these are few
    they are read out in the same scan, otherwise they are the interval of the next round.
    """
    found: dict[str, dict[int, float]] = {i.name: {} for i in intervals}
    while intervals:
        limit = MAX_VALUES // len(intervals)
        large = [i for i in intervals if i.inside > SMALL]
        pairs = {id(i): sketched[i.name] for i in large if i.name in sketched} if sketched else {}
        pairs |= _sketch(df, [i for i in large if id(i) not in pairs])
        sketched = {}
        scans: dict[str, _Scan] = {}
        for i in intervals:
            scan = scans.setdefault(i.name, _Scan(i.value))
            small = i.inside <= SMALL
            scan.splitters |= {e for e in (i.low, i.high) if e is not None}
            scan.splitters |= set() if small else {e for pair in pairs[id(i)] for e in pair}
            if small:
                scan.read.append((i.low, i.high))
            elif i.inside * 3 * MARGIN / SKETCH_ACCURACY <= limit / len(pairs[id(i)]):
                scan.read += pairs[id(i)]
        cells = _tally(df, scans)
        intervals = [part for i in intervals for part in _located(i, scans[i.name], cells[i.name], found[i.name])]
    return found


def _sketch(df: DataFrame, intervals: list[_Interval]) -> dict[int, list[Pair]]:
    """A pair of splitters around every rank of every interval: whole columns by a sketch each, parts of columns by groups."""
    whole = [i for i in intervals if i.low is None and i.high is None]
    parts = [i for i in intervals if not (i.low is None and i.high is None)]
    return _sketch_columns(df, whole) | _sketch_parts(df, parts)


def _sketch_columns(df: DataFrame, intervals: list[_Interval]) -> dict[int, list[Pair]]:
    if not intervals:
        return {}
    around = [[_around(i.share(r)) for r in sorted(i.ranks)] for i in intervals]
    asked = [F.percentile_approx(i.value, _numbers([e for pair in pairs for e in pair], "double"), SKETCH_ACCURACY) for i, pairs in zip(intervals, around)]
    return {id(i): list(zip(points[::2], points[1::2])) for i, points in zip(intervals, df.agg(*asked).first())}


def _sketch_parts(df: DataFrame, intervals: list[_Interval]) -> dict[int, list[Pair]]:
    """Sketches of disjoint parts of columns: a row is looked up once, whatever the number of parts, and feeds one sketch.

    All groups share evenly spaced splitters, of which those around an interval's ranks are kept.
    """
    if not intervals:
        return {}
    scans: dict[str, _Scan] = {}
    for i in intervals:
        scans.setdefault(i.name, _Scan(i.value)).splitters.update(e for e in (i.low, i.high) if e is not None)
    names, placed, width = _cells(df, scans)
    points = {c: scans[c].points() for c in names}
    at = {names.index(i.name) * width + 2 * (0 if i.low is None else bisect_right(points[i.name], i.low)): i for i in intervals}
    numbers = sorted(at)
    around = [[_around_at(at[n].share(r)) for r in sorted(at[n].ranks)] for n in numbers]
    number = F.col("column") * width + F.col("cell")
    kept = F.split(F.get(F.split(F.lit(";".join(",".join(str(e) for pair in pairs for e in pair) for pairs in around)), ";"), F.array_position(_numbers(numbers, "int"), F.col("number")).cast("int") - 1), ",")
    steps = _numbers([k / SPLITTERS for k in range(SPLITTERS + 1)], "double")
    inside = number.isin(numbers)  # no filter, which would move into the search and make its steps one expression
    grids = placed.select(F.when(inside, number).alias("number"), F.when(inside, F.col("x")).alias("x")).groupBy("number").agg(F.percentile_approx("x", steps, SKETCH_ACCURACY).alias("grid"))
    found = grids.select("number", F.transform(kept, lambda k: F.get(F.col("grid"), k.cast("int"))).alias("ends")).collect()  # one row an interval, and one of all other rows
    return {id(at[number]): list(zip(ends[::2], ends[1::2])) for number, ends in found if number is not None}


@dataclass
class _Scan:
    """What one column is counted by, and the intervals whose values are read out."""

    value: Column
    splitters: set[float] = field(default_factory=set)
    read: list[Pair] = field(default_factory=list)

    def points(self) -> list[float]:
        return sorted(self.splitters)

    def cells_read(self) -> list[int]:
        """Open cells (numbered 2k below splitter k) that lie in an interval to be read out."""
        points = self.points()
        at = {p: k for k, p in enumerate(points)}
        cells = set()
        for low, high in self.read:
            cells.update(range(0 if low is None else at[low] + 1, (len(points) if high is None else at[high]) + 1))
        return sorted(2 * k for k in cells)


def _numbers(values: Iterable[float | int], kind: str) -> Column:
    """A constant array from one text, so that thousands of values are one literal."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def _place(rows: DataFrame, points: Sequence[Sequence[float]]) -> DataFrame:
    """`rows(column, x)` with `cell`: twice the number of the column's sorted splitters below x, one more at a splitter.

    The columns' splitters stand one after the other in a constant array, each list filled up with NaN, which is
    above every number, to one less than a power of two. Each step of the search is a projection of its own that
    halves the list: as many steps as the longest list has binary digits, whatever the number of columns.
    """
    steps = max(len(p) for p in points).bit_length()
    width = (1 << steps) - 1
    if not width:
        return rows.withColumn("cell", F.lit(0))
    table = _numbers((x for p in points for x in [*p, *[math.nan] * (width - len(p))]), "double")
    start = F.col("column") * width
    rows = rows.withColumn("below", F.lit(0))
    for step in (1 << k for k in reversed(range(steps))):
        rows = rows.withColumn("below", F.col("below") + F.when(F.col("x") > F.get(table, start + F.col("below") + F.lit(step - 1)), step).otherwise(0))
    hit = (F.col("below") < width) & (F.col("x") == F.get(table, start + F.least(F.col("below"), F.lit(width - 1))))
    return rows.withColumn("cell", 2 * F.col("below") + hit.cast("int")).drop("below")


def _cells(df: DataFrame, scans: dict[str, _Scan]) -> tuple[list[str], DataFrame, int]:
    """The scanned columns, `(column, x, cell)` of their values, and a number above every cell."""
    names = list(scans)
    points = [scans[c].points() for c in names]
    values = df.select(F.posexplode(F.array(*[scans[c].value.cast("double") for c in names])).alias("column", "x")).filter("x IS NOT NULL")
    return names, _place(values, points), 2 * max(len(p) for p in points) + 1


def _tally(df: DataFrame, scans: dict[str, _Scan]) -> dict[str, dict[int, tuple[int, list]]]:
    """`{column: {cell: (rows, sorted (value, rows) pairs of a cell read out)}}` in one scan of the columns.

    Tasks combine their rows by cell; only values of cells to be read out keep their own rows, so the shuffle
    carries little else.
    """
    names, cells, width = _cells(df, scans)
    wanted = sorted(i * width + cell for i, c in enumerate(names) for cell in scans[c].cells_read())
    number = F.col("column") * width + F.col("cell")
    read = number.isin(wanted) if wanted else F.lit(False)
    placed = cells.select("column", "cell", F.when(read, F.col("x")).alias("value"))
    counted = placed.groupBy("column", "cell", "value").agg(F.count("*").alias("n"))
    result: dict[str, dict[int, tuple[int, list]]] = {c: {} for c in names}
    for column, cell, value, n in counted.collect():  # one row per cell, and the values read out
        held, inside = result[names[column]].get(cell, (0, []))
        if value is not None:
            inside.append((value, n))
        result[names[column]][cell] = (held + n, inside)
    return {c: {cell: (n, sorted(inside)) for cell, (n, inside) in cells.items()} for c, cells in result.items()}


def _located(interval: _Interval, scan: _Scan, cells: dict[int, tuple[int, list]], answers: dict[int, float]) -> list[_Interval]:
    """Answers for ranks on a splitter or in a cell read out; the others as narrower intervals."""
    points, readable = scan.points(), set(scan.cells_read())
    narrower: dict[int, _Interval] = {}
    ranks, below = sorted(interval.ranks), 0
    for cell, (n, inside) in sorted(cells.items()):
        k = cell // 2
        mine = ranks[bisect_left(ranks, below) : bisect_left(ranks, below + n)]
        if not mine:
            pass
        elif cell % 2:
            answers.update(dict.fromkeys(mine, points[k]))
        elif cell in readable:
            upto = list(accumulate((times for _, times in inside), initial=below))[1:]
            answers.update({r: inside[bisect_right(upto, r)][0] for r in mine})
        else:
            low, high = (points[k - 1] if k else None), (points[k] if k < len(points) else None)
            narrower[cell] = _Interval(interval.name, interval.value, low, high, below, n, set(mine))
        below += n
    return list(narrower.values())


# --- modes --------------------------------------------------------------------------------------


def mode_table(df: DataFrame, columns: Sequence[str], as_type: str | None = None) -> DataFrame:
    """`(name, value, n)`: most frequent non-null value per column, the lowest on a tie.

    The columns need one common type (or a cast through `as_type`). Counting is distributed by
    value; only the candidates' minimum is global, and it has a partial aggregate.
    """
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value"))).alias("best")
    return (
        value_counts(df, columns, as_type)
        .groupBy("name")
        .agg(best)
        .select("name", F.col("best.value").alias("value"), (-F.col("best.rank")).alias("n"))
    )


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """The mode of each column in its own type; None for a column without values."""
    by_type: dict[str, list[str]] = {}
    for c in columns:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    found: dict[str, object] = {c: None for c in columns}
    for same in by_type.values():
        found.update({r["name"]: r["value"] for r in mode_table(df, same).collect()})
    return found
