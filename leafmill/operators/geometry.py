"""Registration: affine fits by sums, robust refits, routing by residual."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAST_POINTS, GATE, APART = 8, 0.010, 2.0


def apply(m: str, x: Column, y: Column) -> tuple[Column, Column]:
    """The struct a, b, c, d, e, f maps (x, y) to (ax + by + c, dx + ey + f)."""
    return F.col(f"{m}.a") * x + F.col(f"{m}.b") * y + F.col(f"{m}.c"), F.col(f"{m}.d") * x + F.col(f"{m}.e") * y + F.col(f"{m}.f")


def inverse(m: str) -> Column:
    """The way back; null where the map is flat. From frame to page it is this that is wanted."""
    a, b, c, d, e, f = (F.col(f"{m}.{k}") for k in "abcdef")
    det = a * e - b * d
    parts = {"a": e, "b": -b, "c": b * f - c * e, "d": -d, "e": a, "f": c * d - a * f}
    return F.when(F.abs(det) > 1e-12, F.struct(*(F.try_divide(v, det).alias(k) for k, v in parts.items())))


def box_through(m: str, x: Column) -> Column:
    """The upright box around a box's four corners after the map."""
    ends = [apply(m, x[a], x[b]) for a in "lr" for b in "tb"]
    xs, ys = [e[0] for e in ends], [e[1] for e in ends]
    return F.when(x.isNotNull(), F.struct(F.least(*xs).alias("l"), F.least(*ys).alias("t"), F.greatest(*xs).alias("r"), F.greatest(*ys).alias("b")))


def _det(m: list[list[Column]]) -> Column:
    return m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1]) - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0]) + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0])


def fit(points: DataFrame, group: list[str]) -> DataFrame:
    """Least squares for each group of point pairs (x, y, u, v): n and fit (null where points lie on a line).

    Sums of products, so it is one aggregate with map-side combination; the 3x3 normal equations are solved by
    Cramer's rule around the group's first corner, which keeps the sums small.
    """
    x, y, u, v = (F.col(k) for k in "xyuv")
    sums = points.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * x).alias("sxx"), F.sum(x * y).alias("sxy"), F.sum(y * y).alias("syy"),
        *(F.sum(e).alias(n) for n, e in (("su", u), ("sxu", x * u), ("syu", y * u), ("sv", v), ("sxv", x * v), ("syv", y * v))),
    )
    c = F.col
    base = [[c("sxx"), c("sxy"), c("sx")], [c("sxy"), c("syy"), c("sy")], [c("sx"), c("sy"), c("n").cast("double")]]
    det = _det(base)

    def solve(r: list[Column]) -> list[Column]:
        return [F.try_divide(_det([[r[i] if j == k else base[i][j] for j in range(3)] for i in range(3)]), det) for k in range(3)]

    first, second = solve([c("sxu"), c("syu"), c("su")]), solve([c("sxv"), c("syv"), c("sv")])
    got = F.struct(*(e.alias(k) for k, e in zip("abcdef", first + second, strict=True)))
    return sums.select(*group, "n", F.when(F.abs(det) > 1e-9, got).alias("fit"))


def residuals(points: DataFrame, fits: DataFrame, group: list[str]) -> DataFrame:
    rows = points.join(fits.select(*group, "fit"), group)
    u, v = apply("fit", F.col("x"), F.col("y"))
    return rows.withColumn("residual", F.hypot(u - F.col("u"), v - F.col("v"))).drop("fit")


def robust_fit(points: DataFrame, group: list[str], least: int = LEAST_POINTS) -> DataFrame:
    """A fit, one trim at max(3 medians, 0.005), a refit; never on fewer than ``least`` pairs. Groups below it have no row."""
    first = fit(points, group).where((F.col("n") >= least) & F.col("fit").isNotNull())
    rest = residuals(points, first, group)
    cut = rest.groupBy(*group).agg(F.greatest(3 * F.median("residual"), F.lit(0.005)).alias("cut"))
    kept = rest.join(cut, group).where("residual <= cut").drop("residual", "cut")
    second = fit(kept, group).where((F.col("n") >= least) & F.col("fit").isNotNull()).select(*group, F.col("n").alias("n2"), F.col("fit").alias("fit2"))
    out = first.join(second, group, "left")
    return out.select(*group, F.coalesce("n2", "n").alias("n"), F.coalesce("fit2", "fit").alias("fit"))


def route(candidates: DataFrame, page: str, revision: str, residual: str, known: Column, gate: float = GATE, apart: float = APART) -> DataFrame:
    """The template of least residual. A known revision takes it; an unknown one only within ``gate`` and with the next
    at least ``apart`` times as far. A tie for a known revision takes the first by name."""
    w = Window.partitionBy(page).orderBy(residual, revision)
    rows = candidates.withColumn("_next", F.lead(residual).over(w)).withColumn("_n", F.row_number().over(w)).where("_n = 1")
    clear = (F.col(residual) <= gate) & (F.col("_next").isNull() | (F.col("_next") >= apart * F.col(residual)))
    taken = F.when(known | clear, F.col(revision))
    why = F.when(known, "known").when(clear, "assigned").when(F.col(residual) > gate, "no_fit").otherwise("abstain")
    return rows.select(page, taken.alias("template"), F.col(residual).alias("residual"), why.alias("outcome"))
