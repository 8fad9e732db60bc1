"""Column profile of a whole table, exact at any size.

An exact percentile is usually computed by gathering every distinct value in
one task. Here all columns are read together, a few times, by one aggregate each
that sends a single row: the first pass takes the ordinary statistics and a grid of
values of about equal rank from a mergeable sketch. The grid gives a bracket
around each wanted rank; the next pass counts the rows below and within it, so
a bracket that missed its rank is seen and widened. A rank that falls on a bracket's
end is settled; the others are in the list of what is inside, if that is short,
or in a bracket from a finer grid of it. Values are compared in their own type.
"""

import math
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

# The percentiles of a profile.
QUARTILES = (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))

ACCURACY = 10000
#: Parts of equal rank that a pass cuts a bracket into.
PARTS = 200
#: Rows of a bracket that are few enough to be listed.
FEW = 10_000


def _numeric(df):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _value(df, name):
    """Column in its own type; fractions as double, of which NaN counts as missing."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.FractionalType) and not isinstance(df.schema[name].dataType, T.DecimalType):
        number = column.cast("double")
        return F.when(~F.isnan(number), number)
    return column


def profile(df, exact=True, accuracy=ACCURACY):
    """One row per column: type, count, mean, std, min, quartiles, max.

    Quartiles interpolate linearly between neighbours. With ``exact=False``
    they come from the sketch of the first pass alone.
    """
    names = _numeric(df)
    values = df.select(*[_value(df, n).alias(n) for n in names])
    found = {}
    if names:
        points = QUARTILES if exact else ()
        sketched = () if exact else QUARTILES
        first = values.agg(*[_statistics(n, sketched, accuracy) for n in names], *_grids(names if exact else (), accuracy)).first()
        between = ranked(values, names, points, accuracy, first) if exact else {}
        for name in names:
            stats = first[f"stats {name}"].asDict()
            found[name] = stats | {p: _between(*between[name, p]) for p, _ in points}
    kinds = ("mean", "std", "min", *[n for n, _ in QUARTILES], "max")
    rows = []
    for i, f in enumerate(df.schema.fields):
        stats = found.get(f.name, {"count": 0})
        rows.append((i, f.name, f.dataType.simpleString(), stats["count"], *[_double(stats.get(k)) for k in kinds]))
    schema = "position int, column string, type string, count bigint, " + ", ".join(f"{k} double" for k in kinds)
    return df.sparkSession.createDataFrame(rows, schema)


def _double(value):
    return None if value is None else float(value)


def _between(lower, upper, weight):
    """Linear interpolation; equal neighbours stay as they are."""
    if lower is None or lower == upper:
        return lower
    return float(lower) + float(upper - lower) * weight


def _statistics(name, points, accuracy):
    value = F.col(f"`{name}`")
    double = value.cast("double")
    return F.struct(
        F.count(value).alias("count"),
        F.avg(double).alias("mean"),
        F.stddev_samp(double).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        *[F.percentile_approx(value, q, accuracy).alias(n) for n, q in points],
    ).alias(f"stats {name}")


def _grid(value, accuracy):
    """Values at equal steps of rank, the least and the largest included."""
    shares = F.expr(f"array({', '.join(f'{i / PARTS!r}D' for i in range(PARTS + 1))})")
    return F.percentile_approx(value, shares, max(accuracy, 4 * PARTS))


def _grids(names, accuracy):
    return [_grid(F.col(f"`{n}`").cast("double"), accuracy).alias(f"grid {n}") for n in names]


def _typed(number, kind):
    """A sketch's double as a value of the column's type, near enough to be counted against."""
    if isinstance(kind, T.DecimalType):
        return Decimal(repr(number)).quantize(Decimal(1).scaleb(-kind.scale))
    return math.floor(number) if isinstance(kind, T.IntegralType) else number


@dataclass
class _Bracket:
    """Values ``low`` to ``high`` of a column, which should hold the wanted ``ranks``."""

    name: str
    kind: T.DataType
    ranks: list  # wanted, not settled
    low: object
    high: object
    outer: tuple  # of the last pass: it does hold them
    settled: dict = field(default_factory=dict)
    step: str = "count"  # then "list" if few rows are inside, or "ends", "grid" and "count" again
    below: int = 0  # once counted: rows below the bracket
    n: int = 0  # and within it

    def wanted(self, column, accuracy):
        """What the next pass has to find out."""
        low, high = F.lit(self.low).cast(self.kind), F.lit(self.high).cast(self.kind)
        inside = column.between(low, high)
        if self.step == "list":
            return F.array_sort(F.collect_list(F.when(inside, column)))
        if self.step == "grid":
            return _grid(F.when(inside, self.shifted(column, low)), accuracy)
        if self.step == "count":
            return F.struct(F.count_if(column < low).alias("below"), F.count_if(inside).alias("n"))
        return F.struct(
            F.count_if(column == low).alias("at_low"),
            F.count_if(column == high).alias("at_high"),
            F.min(F.when(inside & (column > low), column)).alias("next"),
            F.max(F.when(inside & (column < high), column)).alias("last"),
        )

    def base(self):
        """Whole numbers are sketched as distances from here, which tells large ones apart."""
        return self.low if isinstance(self.low, int) and self.high - self.low < 2**63 else None

    def shifted(self, column, low):
        return column.cast("double") if self.base() is None else (column.cast("bigint") - low.cast("bigint")).cast("double")

    def learn(self, found):
        if self.step == "list":
            self.settled |= {r: found[r - self.below] for r in self.ranks}
            self.ranks = []
        elif self.step == "grid":
            self.narrow(found)
        elif self.step == "count":
            self.count(found)
        else:
            self.settle(found)

    def count(self, found):
        """Whether the bracket holds its ranks; if not, the sketch was off and an end too near."""
        below, above = found.below, found.below + found.n
        if self.ranks[0] < below or self.ranks[-1] >= above:
            self.low = self.outer[0] if self.ranks[0] < below else self.low
            self.high = self.outer[1] if self.ranks[-1] >= above else self.high
            return
        self.below, self.n = below, found.n
        if self.low == self.high:
            self.settled |= dict.fromkeys(self.ranks, self.low)
            self.ranks = []
        self.step = "list" if self.n <= FEW else "ends"

    def settle(self, found):
        """Settle ranks at the bracket's ends; the others lie strictly between these."""
        for r in self.ranks:
            if r < self.below + found.at_low:
                self.settled[r] = self.low
            elif r >= self.below + self.n - found.at_high:
                self.settled[r] = self.high
        self.ranks = [r for r in self.ranks if r not in self.settled]
        if self.ranks:
            self.low, self.high = found.next, found.last
            self.below, self.n = self.below + found.at_low, self.n - found.at_low - found.at_high
            self.step = "list" if self.n <= FEW else "grid"

    def narrow(self, grid):
        """Bring the ends nearer to the wanted ranks."""
        base, self.outer, self.step = self.base() or 0, (self.low, self.high), "count"
        grid = [base + _typed(g, self.kind) for g in grid] if base else [_typed(g, self.kind) for g in grid]
        first = math.floor((self.ranks[0] - self.below) / self.n * PARTS) - 1
        last = math.ceil((self.ranks[-1] - self.below + 1) / self.n * PARTS) + 1
        if first > 0:
            self.low = min(max(self.low, grid[first]), self.high)
        if last < PARTS:
            self.high = max(min(self.high, grid[last]), self.low)


def ranked(values, names, points, accuracy=ACCURACY, first=None):
    """For each column and point: the values at the ranks around it, and the weight of the upper one.

    ``first``, a row with the first pass's ``stats`` and ``grid`` of each column,
    is computed if it is not given. Values are in the column's own type.
    """
    if first is None:
        first = values.agg(*[_statistics(n, (), accuracy) for n in names], *_grids(names, accuracy)).first()
    kinds = {f.name: f.dataType for f in values.schema}
    out, brackets = {}, {}
    for name in names:
        stats, grid = first[f"stats {name}"], first[f"grid {name}"]
        for point, share in points:
            if not stats["count"]:
                out[name, point] = (None, None, 0.0)
                continue
            rank = (stats["count"] - 1) * share
            ranks = sorted({math.floor(rank), math.ceil(rank)})
            place = PARTS / stats["count"]
            ends = [math.floor(ranks[0] * place) - 1, math.ceil(ranks[-1] * place) + 1]
            kind, most = kinds[name], (stats["min"], stats["max"])
            low = max(most[0], _typed(grid[ends[0]], kind)) if ends[0] > 0 else most[0]
            high = min(most[1], _typed(grid[ends[1]], kind)) if ends[1] < PARTS else most[1]
            brackets[name, point] = _Bracket(name, kind, ranks, min(low, high), max(low, high), most), rank
    while todo := [(k, b) for k, (b, _) in brackets.items() if b.ranks]:
        found = values.agg(
            *[b.wanted(F.col(f"`{b.name}`"), accuracy).alias(str(i)) for i, (_, b) in enumerate(todo)]
        ).first()
        for i, (_, bracket) in enumerate(todo):
            bracket.learn(found[i])
    for key, (bracket, rank) in brackets.items():
        out[key] = (bracket.settled[math.floor(rank)], bracket.settled[math.ceil(rank)], rank - math.floor(rank))
    return out
