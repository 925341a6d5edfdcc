"""Turning scores into trades and an equity curve.

Trades last one label horizon and are counted one by one, also where they overlap.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.scan import running_equity

COST_PCT = 0.05


def equity_curve(
    df: DataFrame, score: str, threshold: float, cost_pct: float = COST_PCT, outcome: str = "future_return_1h_pct"
) -> DataFrame:
    """Net return per row (0 without a trade), running equity in percent, and drawdown."""
    entered = F.coalesce(F.col(score) > threshold, F.lit(False))
    rows = df.withColumns(
        {"traded": entered, "net_return_pct": F.when(entered, F.col(outcome) - cost_pct).otherwise(F.lit(0.0))}
    )
    return running_equity(rows, "symbol", "event_time", "net_return_pct").withColumn(
        "drawdown_pct", F.col("peak") - F.col("equity")
    )


def backtest_signals(
    df: DataFrame, score: str, threshold: float, cost_pct: float = COST_PCT, outcome: str = "future_return_1h_pct"
) -> DataFrame:
    """Per symbol: trades, win rate, average win and loss, return, drawdown, buy-and-hold."""
    net, traded = F.col("net_return_pct"), F.col("traded")
    won, lost = traded & (net > 0), traded & (net <= 0)
    first, last = F.min_by("close_price", "event_time"), F.max_by("close_price", "event_time")
    return equity_curve(df, score, threshold, cost_pct, outcome).groupBy("symbol").agg(
        F.count_if(traded).alias("trades"),
        F.try_divide(F.count_if(won).cast("double"), F.count_if(traded).cast("double")).alias("win_rate"),
        F.avg(F.when(won, net)).alias("avg_win_pct"),
        F.avg(F.when(lost, net)).alias("avg_loss_pct"),
        F.avg(F.when(traded, F.col("reward_risk_ratio"))).alias("avg_reward_risk"),
        F.sum(net).alias("total_return_pct"),
        F.max("drawdown_pct").alias("max_drawdown_pct"),
        (F.try_divide(last - first, first) * 100.0).alias("buy_and_hold_pct"),
    )
