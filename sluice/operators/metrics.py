"""Series of samples and functions over sliding ranges: rate, instant rate, latest, mean, extremes.

A range is half-open, ``[t - range, t)``, and evaluated at every step. Functions of an empty range
are NaN, the count too.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import unused
from .scans import last_value, running_sum

NAN = float("nan")
#: Report order of the functions.
FUNCTIONS = ("latest", "rate", "irate", "minimum", "maximum", "average")
MORE_FUNCTIONS = ("total", "count")


def _tick(ts: Column, every: int) -> Column:
    """The first scrape after a sample: the end of its interval."""
    return F.timestamp_seconds((F.floor(F.unix_micros(ts) / (every * 1_000_000)) + 1) * every)


def tick_grid(events: DataFrame, every: int) -> DataFrame:
    """(series, ts): each series' scrapes from its first to its last sample."""
    ends = events.groupBy("series").agg(F.min(_tick(F.col("ts"), every)).alias("a"), F.max(_tick(F.col("ts"), every)).alias("b"))
    return ends.select("series", F.explode(F.sequence("a", "b", F.expr(f"interval {every} seconds"))).alias("ts"))


#: Scrapes of a series that are scanned together.
SCRAPES = 1024


def _segment(every: int) -> Column:
    return F.floor(F.unix_micros("ts") / (every * 1_000_000 * SCRAPES))


def sample_counter(events: DataFrame, every: int) -> DataFrame:
    """A counter of events (series, ts) read once a scrape: (series, ts, value), never falling."""
    counted = events.groupBy("series", _tick(F.col("ts"), every).alias("ts")).agg(F.count(F.lit(1)).alias("n"))
    grid = tick_grid(events, every).join(counted, ["series", "ts"], "left")
    return running_sum(grid, "value", F.col("n"), ["series"], ["ts"], _segment(every)).select("series", "ts", F.col("value").cast("double").alias("value"))


def sample_gauge(events: DataFrame, every: int) -> DataFrame:
    """The latest value of (series, ts, value) at each scrape; a null value reads NaN."""
    latest = events.groupBy("series", _tick(F.col("ts"), every).alias("ts")).agg(F.max_by(F.coalesce("value", F.lit(NAN)), "ts").alias("v"))
    grid = tick_grid(events, every).join(latest, ["series", "ts"], "left")
    return last_value(grid, "value", F.col("v"), ["series"], ["ts"], _segment(every)).select("series", "ts", "value")


def range_select(samples: DataFrame, range_: int, step: int) -> DataFrame:
    """Each sample once for every evaluation time ``t`` whose range holds it (seconds)."""
    if step <= range_ and range_ % step == 0:
        w, name = F.window("ts", f"{range_} seconds", f"{step} seconds"), unused(samples, "_w")
        return samples.withColumn(name, w).withColumn("t", F.col(f"{name}.end")).drop(name)
    first = (F.floor(F.unix_micros("ts") / (step * 1_000_000)) + 1) * step
    # t - range <= ts < t
    last = F.floor((F.unix_micros("ts") + range_ * 1_000_000) / (step * 1_000_000)) * step
    times = F.when(last >= first, F.sequence(first, last, F.lit(step).cast("bigint")))
    return samples.withColumn("t", F.explode(times)).withColumn("t", F.timestamp_seconds("t"))


def _millis(ts: str = "ts") -> Column:
    return F.unix_millis(ts)


def range_functions(names=FUNCTIONS, pair: Column | None = None) -> list[Column]:
    """Aggregates of a range's samples (``ts``, ``value``); ``pair`` gives the last two as
    struct(a, u, b, v): times in milliseconds and values."""
    ms, value = _millis().cast("double"), F.col("value")
    if pair is None:
        two = F.slice(F.array_sort(F.collect_list(F.struct(_millis().alias("ms"), value.alias("v")))), -2, 2)
        pair = F.struct(F.get(two, 0)["ms"].alias("a"), F.get(two, 0)["v"].alias("u"), F.get(two, 1)["ms"].alias("b"), F.get(two, 1)["v"].alias("v"))
    step = (pair["b"] - pair["a"]) / 1000.0
    made = {
        "latest": F.max_by("value", "ts"),
        "rate": F.when(F.count("value") >= 2, F.regr_slope(value, ms) * 1000),
        "irate": F.when(step > 0, (pair["v"] - pair["u"]) / step),
        "minimum": F.min("value"), "maximum": F.max("value"), "average": F.avg("value"), "total": F.sum("value"),
        "count": F.when(F.count("value") > 0, F.count("value")).cast("double"),
    }
    unknown = set(names) - set(made)
    if unknown:
        raise ValueError(f"unknown functions {sorted(unknown)}")
    return [F.coalesce(made[n], F.lit(NAN)).alias(n) for n in names]


def evaluate(samples: DataFrame, range_: int, step: int, functions=FUNCTIONS, empty_steps: bool = True, keep: int | None = None, every: int | None = None) -> DataFrame:
    """(series, t, one column a function) at each step; empty ranges between a series' first and
    last evaluation are NaN rows unless ``empty_steps`` is off (always off for streams).

    ``keep`` samples ``every`` so many seconds bound the range, as the kept history does.
    """
    if range_ <= 0 or step <= 0:
        raise ValueError("range and step must be positive")
    if keep and every and range_ > keep * every:
        raise ValueError(f"Range interval cannot be greater than {keep * every * 1000} ms")
    unknown = set(functions) - set(FUNCTIONS) - set(MORE_FUNCTIONS)
    if unknown:
        raise ValueError(f"unknown functions {sorted(unknown)}")
    if samples.isStreaming:
        return range_select(samples, range_, step).groupBy("series", "t").agg(*range_functions(functions))
    return _over_panes(samples, range_, step, functions, empty_steps)


#: Panes of a series that are combined in one task, at least; a block spans some ranges.
BLOCK_PANES, BLOCK_RANGES = 256, 4


def panes(samples: DataFrame, width: int, functions=FUNCTIONS) -> DataFrame:
    """Partial aggregates of each series by panes of ``width`` seconds, which combine to those of any range of panes.

    series, pane (number), samples, n (values that aren't null), and as far as ``functions`` need
    them total, low, high, last (ts, ms, v), and the slope's moments about the pane's own means:
    mx (ms from its start), my, sxx, sxy. For ``irate`` pair: the last two samples of the pane.
    """
    start = F.col("pane") * (width * 1000)
    rows = samples.withColumn("pane", F.floor(F.unix_micros("ts") / (width * 1_000_000)))
    x, ms = (_millis() - start).cast("double"), _millis()
    made = {"samples": F.count(F.lit(1)), "n": F.count("value")}
    if {"total", "average"} & set(functions):
        made["total"] = F.sum("value")
    if "minimum" in functions:
        made["low"] = F.min("value")
    if "maximum" in functions:
        made["high"] = F.max("value")
    if "latest" in functions:
        made["last"] = F.max_by(F.struct(F.col("ts").alias("ts"), F.col("value").alias("v")), "ts")
    if "rate" in functions:
        made |= {"mx": F.regr_avgx("value", x), "my": F.regr_avgy("value", x), "sxx": F.regr_sxx("value", x), "sxy": F.regr_sxy("value", x)}
    if "irate" in functions:
        w = Window.partitionBy("series", "pane").orderBy("ts")  # a hot series is many panes
        rows = rows.withColumns({"a": F.lag(ms).over(w), "u": F.lag("value").over(w)})
        made["pair"] = F.max_by(F.struct(F.col("ts").alias("ts"), F.col("a"), F.col("u"), ms.alias("b"), F.col("value").alias("v")), F.struct("ts", F.col("a").isNotNull(), F.coalesce("a", F.lit(0))))
    return rows.groupBy("series", "pane").agg(*[c.alias(n) for n, c in made.items()])


def _over_panes(samples: DataFrame, range_: int, step: int, functions, empty_steps: bool) -> DataFrame:
    """Functions of sliding ranges from panes of the largest width that divides range and step.

    A series is cut into blocks of evaluations; a pane goes to the one or two blocks whose ranges
    hold it, so no series is one task and samples move once at most, most of them as panes.
    """
    width = math.gcd(range_, step)
    held, stride = range_ // width, step // width  # panes of a range and of a step
    block = max(BLOCK_RANGES * held, BLOCK_PANES)
    parts = panes(samples, width, functions)
    # Evaluation e is at e * width and holds the panes e - held to e - 1.
    first, last = F.ceil((F.col("pane") + 1) / stride) * stride, F.floor((F.col("pane") + held) / stride) * stride
    ends = parts.select("series", first.alias("first"), last.alias("last")).where("first <= last").groupBy("series").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    grid = ends.select("series", F.explode(F.sequence("first", "last", F.lit(stride).cast("long"))).alias("e"))
    asked = grid.select("series", F.floor(F.col("e") / block).alias("block"), (F.col("e") - 1).alias("pane"), F.lit(True).alias("asked"))
    blocks = F.array_distinct(F.array(F.floor((F.col("pane") + 1) / block), F.floor((F.col("pane") + held) / block)))
    dealt = parts.withColumn("block", F.explode(blocks))
    whole = Window.partitionBy("series", "block")
    if "irate" in functions:
        dealt = dealt.withColumn("before", F.lag("pair").over(whole.orderBy("pane")))
    both = dealt.withColumn("asked", F.lit(False)).unionByName(asked, allowMissingColumns=True)
    over = lambda c: c.over(whole.orderBy("pane").rangeBetween(-(held - 1), 0))
    n, t = over(F.sum("n")), (F.col("pane") + 1) * width
    made = {}
    if "latest" in functions:
        made["latest"] = over(F.max("last"))["v"]
    if "minimum" in functions:
        made["minimum"] = over(F.min("low"))
    if "maximum" in functions:
        made["maximum"] = over(F.max("high"))
    if "total" in functions:
        made["total"] = over(F.sum("total"))
    if "average" in functions:
        made["average"] = F.when(n > 0, over(F.sum("total")) / n)
    if "count" in functions:
        made["count"] = F.when(n > 0, n).cast("double")
    if "rate" in functions:
        # Places from the block's begin and values about the block's mean, so that little cancels.
        finite = F.when(~F.isnan("my") & (F.abs(F.col("my")) < float("inf")), F.col("my"))
        x = F.col("mx") + (F.col("pane") - F.col("block") * block) * float(width * 1000)
        both = both.withColumns({"x": x, "y": F.col("my") - F.coalesce(F.avg(finite).over(whole), F.lit(0.0))})
        xs, ys = over(F.sum(F.col("n") * F.col("x"))), over(F.sum(F.col("n") * F.col("y")))
        sxx = over(F.sum(F.col("sxx") + F.col("n") * F.col("x") * F.col("x"))) - xs * xs / n
        sxy = over(F.sum(F.col("sxy") + F.col("n") * F.col("x") * F.col("y"))) - xs * ys / n
        # Times are whole milliseconds: two different ones have moments of a half at least.
        made["rate"] = F.when((n >= 2) & (sxx > 0.25), sxy / F.when(sxx > 0.25, sxx) * 1000)
    if "irate" in functions:
        near = F.struct(F.col("pair.ts").alias("ts"), F.coalesce("pair.a", "before.b").alias("a"), F.when(F.col("pair.a").isNotNull(), F.col("pair.u")).otherwise(F.col("before.v")).alias("u"), F.col("pair.b").alias("b"), F.col("pair.v").alias("v"))
        pair = over(F.max(F.when(F.col("pair").isNotNull(), near)))
        apart = (pair["b"] - pair["a"]) / 1000.0
        made["irate"] = F.when((pair["a"] >= (t - range_) * 1000) & (apart > 0), (pair["v"] - pair["u"]) / F.when(apart > 0, apart))
    found = both.select("series", F.timestamp_seconds(t).alias("t"), "asked", over(F.sum("samples")).alias("samples"), *[F.coalesce(made[f], F.lit(NAN)).alias(f) for f in functions]).where("asked")
    return (found if empty_steps else found.where("samples > 0")).select("series", "t", *functions)


def settle_averages(evaluated: DataFrame, samples: DataFrame, range_: int, step: int, digits: int) -> DataFrame:
    """``evaluated`` (with minimum, maximum, average and count) as SQL rounds it: an average whose last of ``digits`` decimals
    hangs on the order of adding is that of the samples added one by one in order of time.

    Panes add doubles in another order. Two orders differ by a known bound, so only the ranges that lie as near to the
    middle between two decimals are added again; a sample moves once, and once for each of these ranges that holds it.
    """
    width = math.gcd(range_, step)
    pane = lambda ts: F.floor(F.unix_micros(ts) / (width * 1_000_000))
    bound = (F.col("count") + 4) * 2.0**-52 * F.greatest(F.abs("minimum"), F.abs("maximum")) * 10.0**digits
    near = evaluated.where(~F.isnan("average") & (F.abs(F.abs(F.col("average") * 10.0**digits) % 1 - 0.5) <= bound))
    asked = near.select("series", "t", F.explode(F.sequence(pane("t") - range_ // width, pane("t") - 1)).alias("pane"))
    held = samples.where("value is not null").select("series", "ts", "value", pane("ts").alias("pane")).join(asked, ["series", "pane"])
    so_far = Window.partitionBy("series", "t").orderBy("ts", "value").rowsBetween(Window.unboundedPreceding, 0)
    added = held.select("series", "t", F.struct(F.count("value").over(so_far).alias("n"), F.sum("value").over(so_far).alias("total")).alias("sum"))
    again = added.groupBy("series", "t").agg(F.max("sum").alias("sum")).select("series", "t", (F.col("sum.total") / F.col("sum.n")).alias("again"))
    return evaluated.join(again, ["series", "t"], "left").withColumn("average", F.coalesce("again", "average")).select(*evaluated.columns)


def evaluate_stream(samples: DataFrame, range_: int, step: int, lateness: str, functions=FUNCTIONS) -> DataFrame:
    """``evaluate`` over a stream: late samples count up to ``lateness``."""
    if range_ % step:
        raise ValueError("a stream's range must be a multiple of its step")
    out = samples.withWatermark("ts", lateness).groupBy("series", F.window("ts", f"{range_} seconds", f"{step} seconds").alias("w")).agg(*range_functions(functions))
    return out.select("series", F.col("w.end").alias("t"), *functions)


def keep_last(samples: DataFrame, n: int = 120) -> DataFrame:
    """The latest ``n`` samples of each series."""
    rank = F.row_number().over(Window.partitionBy("series").orderBy(F.col("ts").desc()))
    name = unused(samples, "_rank")
    return samples.withColumn(name, rank).where(F.col(name) <= n).drop(name)


def time_range(samples: DataFrame) -> DataFrame:
    """(series, oldest, newest)."""
    return samples.groupBy("series").agg(F.min("ts").alias("oldest"), F.max("ts").alias("newest"))


def format_metric(value: Column, precision: int = 2, unit: str = "", name: str | None = None, formatter: Callable[[Column], Column] | None = None) -> Column:
    """``1.23k unit``: thousands, millions and billions by letter, negative values as they are, NaN as ``n/a``.

    ``formatter`` is the user's own; ``name`` puts ``name=`` before.
    """
    def shown(x: Column, letter: str) -> Column:
        return F.concat(F.format_string(f"%.{precision}f", x), F.lit(letter + (f" {unit}" if unit else "")))

    text = formatter(value) if formatter else (
        F.when(F.isnan(value) | value.isNull(), "n/a").when(value >= 1e9, shown(value / 1e9, "G")).when(value >= 1e6, shown(value / 1e6, "M"))
        .when(value >= 1e3, shown(value / 1e3, "k")).otherwise(shown(value, "")))
    return F.concat(F.lit(f"{name}="), text) if name else text


def unscaled(precision: int = 2) -> Callable[[Column], Column]:
    """A formatter of plain decimals without letters: the double's own value rounded, ties to even, as SQL's ``printf`` does; NaN as ``n/a``.

    Spark's ``format_string`` rounds the shortest decimal that reads as the double, ties up.
    """
    shown = F.udf(lambda x: None if x is None else f"{x:.{precision}f}", "string", useArrow=True)
    return lambda value: F.when(F.isnan(value) | value.isNull(), "n/a").otherwise(shown(value))


def report(evaluated: DataFrame, range_: int, functions=FUNCTIONS, precision: int = 2, unit: str = "", formatter: Callable[[Column], Column] | None = None) -> DataFrame:
    """``series [30s]: latest=..., rate=...`` of each evaluation, functions in report order."""
    span = f"{range_ // 60}m" if range_ >= 60 else f"{range_}s"
    parts = [format_metric(F.col(n), precision, unit, n, formatter) for n in (*FUNCTIONS, *MORE_FUNCTIONS) if n in functions]
    return evaluated.select("series", "t", F.concat(F.col("series"), F.lit(f" [{span}]: "), F.concat_ws(", ", *parts)).alias("line"))


def record_rates(records: DataFrame, updates: DataFrame, every: int = 2, range_: int = 30, step: int = 30) -> DataFrame:
    """Rate and instant rate of received records and processed updates, over thirty seconds."""
    events = records.select(F.lit("received").alias("series"), F.col("timestamp").alias("ts")).unionByName(
        updates.select(F.lit("processed").alias("series"), F.col("timestamp").alias("ts")))
    return evaluate(sample_counter(events, every), range_, step, ("rate", "irate"))
