"""Row-frame windows over long series, without one task per symbol.

A plain ``Window.partitionBy(symbol)`` puts a whole symbol in one task, so five
symbols keep five cores busy however large the cluster is.  Here a series is
first numbered and then cut into chunks of a fixed number of rows:

1. every row falls in a time slice (a calendar span; the key is unique, so a
   slice of one symbol has at most span / bar-interval rows);
2. slice sizes, a small aggregate, are summed up per symbol, giving each slice
   the number of rows before it; row number = that offset + rank in the slice;
3. chunk = row number / chunk size.  Rows near a chunk edge are copied to the
   neighbour as a halo, so any frame of up to ``lookback`` rows back and
   ``lookahead`` rows ahead sees exactly the rows it would see in the full series.

All frames of a plan share one exchange and one sort on (symbol, chunk).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barloom.operators import ema as E

RN, CHUNK, CORE, BLOCK, SLICE = "_rn", "_chunk", "_core", "_block", "_slice"
HELPERS = (RN, CHUNK, CORE, BLOCK)

CHUNK_ROWS = 16_384
BLOCK_ROWS = 1_024
DAY_SECONDS = 86_400
SLICE_INTRADAY = 7 * DAY_SECONDS
SLICE_DAILY = 3_650 * DAY_SECONDS


def time_slice(ts: Column, seconds: int) -> Column:
    """Index of the span of ``seconds`` seconds that holds the date or timestamp ``ts``."""
    of_day = F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.second(ts)
    index = F.unix_date(F.to_date(ts)).cast("long") * DAY_SECONDS + of_day
    return F.floor(index / F.lit(seconds)).cast("long")


def slice_offsets(counts: DataFrame, symbol: str, n: str = "_n") -> DataFrame:
    """(symbol, slice, n) -> rows of the symbol that lie before the slice."""
    before = Window.partitionBy(symbol).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(symbol, SLICE, F.coalesce(F.sum(n).over(before), F.lit(0)).alias("_before"))


def index_series(df: DataFrame, symbol: str, ts: str, slice_seconds: int, ema: E.Ema | None = None) -> DataFrame:
    """Add ``_rn``, the 1-based position of each row in its symbol's series, and the averages of ``ema``.

    Averages are scanned in the slices and carried along the series by the small table that also numbers the rows.
    """
    keyed = df.withColumn(SLICE, time_slice(F.col(ts), slice_seconds))
    in_slice = Window.partitionBy(symbol, SLICE).orderBy(ts)
    ranked = keyed.withColumn("_r", F.row_number().over(in_slice))
    if ema is None:
        counts = keyed.groupBy(symbol, SLICE).agg(F.count(F.lit(1)).alias("_n"))
        placed = ranked.join(slice_offsets(counts, symbol), [symbol, SLICE])
    else:
        series = (symbol, SLICE)
        local = E.scanned(ranked, series, "_r", ema)
        states = E.carried(E.block_facts(local, series, "_r", ema), series, ema)
        placed = E.finished(local.join(states, list(series)), ema)
    return placed.withColumn(RN, F.col("_before") + F.col("_r")).drop("_r", "_before", SLICE)


def attach(df: DataFrame, small: DataFrame, by: str, spread: str, how: str = "inner", salts: int = 64) -> DataFrame:
    """Join a table with one row per ``by`` without gathering the rows of a key in one task.

    Rows are spread over ``salts`` parts of their key by a hash of ``spread``; the small side is repeated
    for each part.  Spark still broadcasts it when it finds it small.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [by, "_salt"], how).drop("_salt")


def open_chunks(
    df: DataFrame,
    symbol: str,
    ts: str,
    lookback: int,
    lookahead: int = 0,
    slice_seconds: int = SLICE_INTRADAY,
    chunk_rows: int = CHUNK_ROWS,
    ema: E.Ema | None = None,
) -> DataFrame:
    """Number the series and spread it over (symbol, chunk) groups with halos; the averages of ``ema`` need none.

    Follow with frames over :func:`chunk_window` and end with :func:`close_chunks`.
    """
    if max(lookback, lookahead) > chunk_rows or chunk_rows % BLOCK_ROWS:
        raise ValueError("halo must fit in a chunk and chunks must be whole blocks")
    indexed = index_series(df, symbol, ts, slice_seconds, ema)
    position = F.col(RN) - 1
    own = F.floor(position / F.lit(chunk_rows)).cast("long")
    within = position % F.lit(chunk_rows)
    first = F.when((within < lookahead) & (own > 0), own - 1).otherwise(own)
    last = F.when(within >= chunk_rows - lookback, own + 1).otherwise(own)
    spread = indexed.withColumn(CHUNK, F.explode(F.sequence(first, last))).repartition(symbol, CHUNK)
    # What follows from the row number is computed after the exchange, not sent through it.
    return spread.withColumns(
        {CORE: F.col(CHUNK) == own, BLOCK: F.floor(position / F.lit(BLOCK_ROWS)).cast("long")}
    )


def chunk_window(symbol: str) -> WindowSpec:
    """Series order inside a chunk; the block level lets every spec share one sort."""
    return Window.partitionBy(symbol, CHUNK).orderBy(BLOCK, RN)


def close_chunks(df: DataFrame, keep: Sequence[str] | None = None, keep_rn: bool = False) -> DataFrame:
    """Drop halo copies and helper columns."""
    core = df.where(F.col(CORE))
    if keep is not None:
        return core.select(*keep)
    return core.drop(*[c for c in HELPERS if not (keep_rn and c == RN)])


# --- frames ---------------------------------------------------------------


def previous(column: str, n: int, w: WindowSpec) -> Column:
    return F.lag(column, n).over(w)


def following(column: str, n: int, w: WindowSpec) -> Column:
    return F.lead(column, n).over(w)


def _trailing(w: WindowSpec, rows: int) -> WindowSpec:
    return w.rowsBetween(-(rows - 1), 0)


def rolling_mean(column: Column, rows: int, w: WindowSpec, warmup: str = "partial") -> Column:
    """Mean of the last ``rows`` rows.

    ``partial`` averages what there is from the first row on; ``strict`` is NULL
    until the frame holds ``rows`` values.
    """
    frame = _trailing(w, rows)
    mean = F.avg(column).over(frame)
    if warmup == "partial":
        return mean
    if warmup == "strict":
        return F.when(F.count(column).over(frame) == rows, mean)
    raise ValueError(f"warmup must be 'partial' or 'strict', not {warmup!r}")


def rolling_stddev(column: Column, rows: int, w: WindowSpec) -> Column:
    return F.stddev_samp(column).over(_trailing(w, rows))


def prior_high(column: str, rows: int, w: WindowSpec) -> Column:
    return F.max(column).over(w.rowsBetween(-rows, -1))


def prior_low(column: str, rows: int, w: WindowSpec) -> Column:
    return F.min(column).over(w.rowsBetween(-rows, -1))


def future_high(column: str, rows: int, w: WindowSpec) -> Column:
    return F.max(column).over(w.rowsBetween(1, rows))


def future_low(column: str, rows: int, w: WindowSpec) -> Column:
    return F.min(column).over(w.rowsBetween(1, rows))
