"""Order-dependent operators: outliers, trailing statistics, splits, folds, lags, sequences, slices."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidecast.functions.timekeys import col_of
from tidecast.operators.attach import attach, join_on
from tidecast.operators.position import Order, bucketed, filtered, framed, order_index, with_segment

SHORT_FRAME = 256


def _outlier_limit(p: float, side: str) -> float:
    if side == "both":
        return NormalDist().inv_cdf(1 - p / 2)
    if side == "low":
        return NormalDist().inv_cdf(p)
    raise ValueError("side is 'both' or 'low'")


def known_value(y: str) -> Column:
    """The value as a double; NaN and the infinities are unknown, as null is."""
    value = col_of(y).cast("double")
    return F.when(F.abs(value) < float("inf"), value)  # NaN counts as greater than any number


def trailing_stats(rows: DataFrame, order: Order, wanted: dict[str, str], n: int) -> DataFrame:
    """Add count, mean and sum of squared deviations of the known values of the last ``n`` rows of a block, for all columns
    of a width in the same windows; ``wanted`` maps a name to a column.

    Blocks are cut into chunks of n rows.  The last n rows are the tail of a chunk and the head of the next, whose
    statistics are running sums from the chunk's ends; so no value outside the frame ever enters a sum, and
    the cost does not grow with n.  Running sums are taken from the first known value of their side.
    """
    names = rows.columns
    ordered = Window.partitionBy(*order.keys, "_block").orderBy(*order.columns())
    known = {name: f"_known_{name}" for name in wanted}
    rows = rows.withColumns({**{known[name]: known_value(y) for name, y in wanted.items()}, "_at": F.row_number().over(ordered) - 1})
    rows = rows.withColumn("_chunk", F.floor(F.col("_at") / n))
    chunk = Window.partitionBy(*order.keys, "_block", "_chunk")
    for side, at in (("head", F.col("_at")), ("tail", F.col("_at").desc())):
        running = chunk.orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
        whole = chunk.orderBy(at).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        rows = rows.withColumns({f"_{side}_base_{x}": F.first(k, ignorenulls=True).over(whole) for x, k in known.items()})
        off = {x: F.col(k) - F.col(f"_{side}_base_{x}") for x, k in known.items()}
        rows = rows.withColumns({c: v for x, k in known.items() for c, v in (
            (f"_{side}_n_{x}", F.count(k).over(running)), (f"_{side}_s_{x}", F.sum(off[x]).over(running)),
            (f"_{side}_q_{x}", F.sum(off[x] * off[x]).over(running)))})
    inside = F.pmod(F.col("_at") + 1, F.lit(n)) != 0  # else the frame is a whole chunk
    rows = rows.withColumns({f"_before_{c}_{x}": F.when(inside, F.lag(f"_tail_{c}_{x}", n - 1).over(ordered))
                             for x in wanted for c in ("base", "n", "s", "q")})

    def of(side: str, x: str) -> tuple[Column, Column, Column]:
        count = F.coalesce(F.col(f"_{side}_n_{x}"), F.lit(0)).cast("double")
        some = F.when(count > 0, count)
        mean = F.coalesce(F.col(f"_{side}_base_{x}") + F.col(f"_{side}_s_{x}") / some, F.lit(0.0))
        squares = F.col(f"_{side}_q_{x}") - F.col(f"_{side}_s_{x}") * F.col(f"_{side}_s_{x}") / some
        return count, mean, F.coalesce(F.greatest(squares, F.lit(0.0)), F.lit(0.0))

    out = []
    for x in wanted:
        (n1, m1, q1), (n2, m2, q2) = of("before", x), of("head", x)
        count = F.when(n1 + n2 > 0, n1 + n2)
        apart = F.when((n1 > 0) & (n2 > 0), m2 - m1).otherwise(0.0)
        mean = F.when(n1 > 0, m1 + apart * n2 / count).otherwise(m2)
        out += [(n1 + n2).cast("long").alias(f"{x}_n"), F.when(count > 0, mean).alias(f"{x}_mean"),
                F.when(count > 0, q1 + q2 + apart * apart * n1 * n2 / count).alias(f"{x}_q")]
    return rows.select(*[col_of(c) for c in names], *out)


def _flag_frame(rows: DataFrame, window: WindowSpec, order: Order, y: str, half: int, p: float, side: str) -> DataFrame:
    """Flag rows against the mean and deviation of the 2*half+1 rows around them.

    A count of value changes tells a constant frame exactly (its deviation is zero).
    """
    names = rows.columns
    n = 2 * half + 1
    rows = trailing_stats(rows, order, {"_frame": y}, n)
    v = col_of(y).cast("double")
    rows = rows.withColumn("_chg", F.when(v != F.lag(v).over(window), 1).otherwise(0))
    rows = rows.withColumns({"_moves": F.sum("_chg").over(window.rowsBetween(Window.unboundedPreceding, 0)),
                             "_rn": F.row_number().over(window)})
    rows = rows.withColumns({
        "_mean": F.lead("_frame_mean", half).over(window), "_sq": F.lead("_frame_q", half).over(window) / n,
        "_varied": F.lead("_moves", half).over(window) > F.lag("_moves", half).over(window),
        "_full": (F.col("_rn") > half) & F.lead("_rn", half).over(window).isNotNull()})
    z = F.try_divide(v - F.col("_mean"), F.sqrt("_sq"))
    limit = _outlier_limit(p, side)
    beyond = F.abs(z) >= limit if side == "both" else z <= limit
    flag = F.coalesce(F.col("_full") & F.col("_varied") & beyond, F.lit(False))
    return rows.withColumn("is_outlier", flag).select(*[col_of(c) for c in names], "is_outlier")


def detect_outliers(df: DataFrame, y: str, order: Order, n: int = 1000, p: float = 0.001,
                    side: str = "both", block_rows: int | None = None) -> DataFrame:
    """Flag values that are unlikely under a normal fitted to the n+1 known rows around them.

    ``side='both'`` flags either tail beyond p/2; ``side='low'`` flags the low tail beyond p.  The first
    and last n/2 known rows and frames without spread are never flagged, nor are nulls and NaN.  An infinite value is
    flagged on its side wherever it stands, and enters no frame.
    """
    half, plain = n // 2, filtered(order)
    known = framed(df.filter(known_value(y).isNotNull()), plain, half + 1, half,
                   lambda rows, w, block: _flag_frame(rows, w, plain, y, half, p, side), block_rows)
    unknown = df.filter(known_value(y).isNull()).withColumn("is_outlier", _infinite(y, side))
    return known.unionByName(unknown)


def _infinite(y: str, side: str) -> Column:
    """Whether the value is infinite, on the low side or either."""
    value = col_of(y).cast("double")
    return F.coalesce(value.isin(float("-inf")) if side == "low" else value.isin(float("-inf"), float("inf")), F.lit(False))


def remove_outliers(df: DataFrame, columns: Sequence[str], order: Order, n: int = 1000, p: float = 0.001,
                    block_rows: int | None = None) -> DataFrame:
    """Replace flagged values by null in every given column, all columns in one pass over the long form.

    Only the flagged cells travel back to the wide table.
    """
    ids = [*order.keys, order.time, *order.ties]
    long = df.unpivot(ids, list(columns), "variable", "_y")
    by_variable = Order(order.time, (*order.keys, "variable"), order.ties, order.bucket_seconds)
    flagged = (detect_outliers(long, "_y", by_variable, n, p, "both", block_rows)
               .filter("is_outlier").groupBy(*ids).agg(F.collect_set("variable").alias("_flagged")))
    joined = join_on(df, flagged, ids, "left")
    cells = [F.when(~F.coalesce(F.array_contains("_flagged", c), F.lit(False)), col_of(c)).alias(c)
             if c in columns else col_of(c) for c in df.columns]
    return joined.select(*cells)


def trailing_columns(rows: DataFrame, order: Order, wanted: dict[str, tuple[str, int]], short: int = SHORT_FRAME
                     ) -> DataFrame:
    """Add means of the last w rows, null unless all w are there and known; ``wanted`` maps a name to (column, w).

    ``rows`` are halo blocks of ``order``; NaN and the infinities are unknown.  Frames up to ``short`` rows are averaged directly, longer
    ones by ``trailing_stats``, whose cost does not grow with w.  Either way only the rows of a frame decide.
    """
    names = rows.columns
    ordered = "PARTITION BY " + ", ".join(f"`{c}`" for c in (*order.keys, "_block"))
    ordered += " ORDER BY " + ", ".join(f"`{c}`" for c in (order.time, *order.ties))
    direct = {n: (y, w) for n, (y, w) in wanted.items() if w <= short}
    if direct:
        known, frame = "CASE WHEN abs(cast(`{0}` AS double)) < double('Infinity') THEN cast(`{0}` AS double) END", "OVER ({} ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"
        rows = rows.selectExpr("*", *[
            f"CASE WHEN count({known.format(y)}) {frame.format(ordered, w - 1)} = {w} THEN avg({known.format(y)}) {frame.format(ordered, w - 1)} END AS `{n}`"
            for n, (y, w) in direct.items()])
    for w in sorted({w for n, (_, w) in wanted.items() if n not in direct}):  # all columns of a width together
        wide = {n: y for n, (y, width) in wanted.items() if n not in direct and width == w}
        rows = trailing_stats(rows, order, {f"_long_{n}": y for n, y in wide.items()}, w)
        rows = rows.withColumns({n: F.when(F.col(f"_long_{n}_n") == w, F.col(f"_long_{n}_mean")) for n in wide})
    return rows.select(*[f"`{c}`" for c in (*names, *wanted)])


def trailing_mean(df: DataFrame, y: str, w: int, order: Order, name: str = "trailing_mean",
                  block_rows: int | None = None) -> DataFrame:
    """Mean of the last ``w`` rows including this one; null until the window is full of known values."""
    return framed(df, order, w, 0, lambda rows, win, block: trailing_columns(rows, order, {name: (y, w)}), block_rows)


def trailing_mse(df: DataFrame, y: str, w: int, order: Order, block_rows: int | None = None) -> DataFrame:
    """Trailing mean and, over the rows that have one, the trailing mean of its squared error."""
    rows, indexed = (df, order) if "_bucket" in df.columns else order_index(df, order)  # both means start from one sort
    smoothed = trailing_mean(rows, y, w, indexed, "trailing_mean", block_rows)
    known = smoothed.filter(F.col("trailing_mean").isNotNull()).withColumn(
        "_sq", F.pow(F.col("trailing_mean") - col_of(y), F.lit(2)))
    out = trailing_mean(known, "_sq", w, filtered(indexed), "trailing_mse", block_rows).drop("_sq")
    return out if "_bucket" in df.columns else out.drop("_bucket")


def constant_baseline(df: DataFrame, y: str, order: Order, w: int = 8760,
                      block_rows: int | None = None) -> DataFrame:
    """Last trailing mean and its last trailing squared error, one row per series."""
    last = F.struct(*order.columns())
    means = trailing_mse(df, y, w, order, block_rows)
    out = means.groupBy(*order.key_columns()).agg(
        F.max_by("trailing_mean", last).alias("point_forecast"),
        F.max_by("trailing_mse", last).alias("variance_forecast"),
        F.max(col_of(order.time)).alias("last_mean_time"))
    ends = df.groupBy(*order.key_columns()).agg(F.max(col_of(order.time)).alias("last_time"))
    joined = attach(ends, out, order.keys)
    known = F.col("last_mean_time") == F.col("last_time")
    return joined.select(*order.key_columns(), "last_time",
                         F.when(known, F.col("point_forecast")).alias("point_forecast"),
                         "variance_forecast")


def split_holdout(df: DataFrame, order: Order, fraction: float = 0.1, name: str = "is_holdout") -> DataFrame:
    """Mark the last ceil(fraction * rows) rows of every series."""
    marked = with_segment(df, order, lambda total: [total - F.ceil(total * F.lit(fraction))], "_part")
    return marked.withColumn(name, F.col("_part") == 1).drop("_part")


def split_at(df: DataFrame, time: str, cutoff, name: str = "is_holdout") -> DataFrame:
    """Mark the rows at or after a date."""
    return df.withColumn(name, col_of(time) >= F.lit(cutoff).cast("timestamp_ntz"))


def split_tail_samples(samples: DataFrame, order: Order, proportion: float, name: str = "is_validation") -> DataFrame:
    """Mark the last floor(proportion * samples) samples for early-stop validation."""
    marked = with_segment(samples, order, lambda total: [total - F.floor(total * F.lit(proportion))], "_part")
    return marked.withColumn(name, F.col("_part") == 1).drop("_part")


def expanding_folds(df: DataFrame, order: Order, k: int = 5, name: str = "segment") -> DataFrame:
    """Tag rows with the test block they fall in, 0 being the part no fold tests.

    The last k blocks hold rows div (k+1) rows each.  Fold f trains on segments below f and tests f.
    """
    def cuts(total: Column) -> list[Column]:
        size = F.floor(total / F.lit(k + 1))
        return [total - size * (k - i) for i in range(k)]

    return with_segment(df, order, cuts, name)


def tail(df: DataFrame, n: int, order: Order) -> DataFrame:
    """Last n rows of every series.

    Without keys this is a top-n.  With keys a cut by position finds them, so that no task sees the
    candidates of a long series from everywhere.
    """
    if not order.keys:
        return df.orderBy(*[c.desc() for c in order.columns()]).limit(n)
    cut = with_segment(df, order, lambda total: [F.greatest(total - n, F.lit(0))], "_part")
    return cut.filter("_part = 1").drop("_part")


def head(df: DataFrame, n: int, order: Order) -> DataFrame:
    """First n rows of every series."""
    if not order.keys:
        return df.orderBy(*order.columns()).limit(n)
    cut = with_segment(df, order, lambda total: [F.lit(n)], "_part")
    return cut.filter("_part = 0").drop("_part")


def sort_time(df: DataFrame, order: Order) -> DataFrame:
    """Global sort, for output only."""
    return df.orderBy(*order.key_columns(), *order.columns())


def with_lags(df: DataFrame, columns: Sequence[str], p: int, order: Order,
              block_rows: int | None = None) -> DataFrame:
    """Add ``column_lag1`` … ``column_lagp``: the values of the p rows before."""
    def build(rows: DataFrame, window: WindowSpec, block: WindowSpec) -> DataFrame:
        return rows.withColumns({f"{c}_lag{i}": F.lag(col_of(c), i).over(window)
                                 for c in columns for i in range(1, p + 1)})

    return framed(df, order, p, 0, build, block_rows)


def lag_context(df: DataFrame, columns: Sequence[str], p: int, order: Order) -> DataFrame:
    """The last p rows, which a forecast starts from."""
    return tail(df.select(*order.key_columns(), *order.columns(), *[col_of(c) for c in columns]), p, order)


def sequence_windows(df: DataFrame, columns: Sequence[str], target: str, length: int, horizon: int,
                     order: Order, block_rows: int | None = None) -> DataFrame:
    """One sample per row that ends a full window: the last ``length`` rows of the columns, oldest first,
    and the target ``horizon`` rows later.  A series of N rows gives N-(length+horizon-1) samples.
    """
    vector = F.array(*[col_of(c).cast("double") for c in columns])

    def build(rows: DataFrame, window: WindowSpec, block: WindowSpec) -> DataFrame:
        frame = window.rowsBetween(-(length - 1), 0)
        return rows.select(
            *order.key_columns(), *order.columns(), "_block", "_home",
            F.collect_list(vector).over(frame).alias("inputs"),
            F.lead(col_of(order.time), horizon).over(window).alias("target_time"),
            F.lead(col_of(target), horizon).over(window).alias("target"))

    out = framed(df, order, length - 1, horizon, build, block_rows)
    return out.filter((F.size("inputs") == length) & F.col("target_time").isNotNull())


def add_variance_trend(df: DataFrame, variance: str, step: str, slope: float | Column) -> DataFrame:
    """Let the variance grow by ``slope`` per step ahead."""
    rise = slope if isinstance(slope, Column) else F.lit(float(slope))
    return df.withColumn(variance, col_of(variance) + rise * col_of(step))


def backfill(df: DataFrame, columns: Sequence[str], order: Order) -> DataFrame:
    """Replace a null by the next known value of its series.

    Inside a bucket a window finds it; across buckets the first known value of each later bucket does.
    """
    time_key = F.struct(*order.columns())
    placed = bucketed(df, order)
    table = placed.groupBy(*order.key_columns(), "_bucket").agg(
        *[F.min_by(col_of(c), F.when(col_of(c).isNotNull(), time_key)).alias(f"_first_{i}")
          for i, c in enumerate(columns)])
    later = Window.partitionBy(*order.keys).orderBy("_bucket").rowsBetween(1, Window.unboundedFollowing)
    table = table.select(*order.keys, "_bucket", *[F.first(f"_first_{i}", ignorenulls=True).over(later)
                                                   .alias(f"_next_{i}") for i in range(len(columns))])
    ahead = (Window.partitionBy(*order.keys, "_bucket").orderBy(*[c.desc() for c in order.columns()])
             .rowsBetween(Window.unboundedPreceding, 0))
    filled = {c: F.coalesce(F.last(col_of(c), ignorenulls=True).over(ahead), F.col(f"_next_{i}")).alias(c)
              for i, c in enumerate(columns)}
    joined = join_on(placed, table, [*order.keys, "_bucket"])
    return joined.select(*[filled.get(c, col_of(c)) for c in df.columns])


def horizon_slice(df: DataFrame, days: int, step: str = "step") -> DataFrame:
    """The first ``days`` days of an hourly forecast, both ends of the axis included."""
    return df.filter(col_of(step) <= 24 * days + 1)
