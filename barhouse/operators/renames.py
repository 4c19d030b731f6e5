"""Tickers that may be old ones under a new name, by what their histories have in common."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barhouse.schemas import VALUE_COLS

#: A bar that more tickers than this share on one day tells nothing about a rename.
MOST_HOLDERS = 8
#: Common days, and the share of them with equal bars, that a candidate needs.
LEAST_DAYS = 3
LEAST_AGREEMENT = 0.7

_PRINT = ("date", *VALUE_COLS)

Materialise = Callable[[DataFrame], DataFrame]


def ticker_spans(bars: DataFrame) -> DataFrame:
    """The last day of every ticker."""
    return bars.groupBy("ticker").agg(F.max("date").alias("last"))


def rename_pairs(bars: DataFrame, dim: DataFrame, most_holders: int, once: Materialise) -> DataFrame:
    """(ticker, new_ticker, last, new_last): tickers that stopped and unknown ones that go on longer and share a rare bar.

    A bar's fingerprint is its day and its five values; bars that lack a value have none. Only bars of the two
    sides are indexed: those of tickers that end before the last day of all, and those of tickers that the
    dimension does not know. Fingerprints are counted with a combine before the shuffle; those that more than
    ``most_holders`` tickers have are dropped before any two tickers meet, so no group is larger than that.
    """
    spans = once(ticker_spans(bars))
    end = spans.agg(F.max("last")).first()[0]
    sides = (
        spans.join(dim.select("ticker", F.lit(True).alias("known")), "ticker", "left")
        .select("ticker", "last", F.col("known").isNull().alias("is_new"), (F.col("last") < F.lit(end)).alias("stopped"))
        .where("is_new or stopped")
    )
    complete = bars.dropna(subset=list(_PRINT)).select("ticker", *_PRINT)
    indexed = once(complete.join(sides, "ticker"))
    rare = indexed.groupBy(*_PRINT).agg(F.count("*").alias("n")).where(F.col("n").between(2, most_holders))
    holders = indexed.join(rare.select(*_PRINT), list(_PRINT)).groupBy(*_PRINT)
    old = F.col("old")
    new = F.col("new")
    found = (
        holders.agg(F.collect_list(F.struct("ticker", "last", "is_new", "stopped")).alias("held"))
        .select("held", F.explode("held").alias("old"))
        .where(old["stopped"])
        .select("old", F.explode("held").alias("new"))
        .where(new["is_new"] & (new["last"] > old["last"]))
    )
    return found.select(
        old["ticker"].alias("ticker"), new["ticker"].alias("new_ticker"), old["last"].alias("last"), new["last"].alias("new_last")
    ).distinct()


def compared(pairs: DataFrame, bars: DataFrame) -> DataFrame:
    """``pairs`` with the number of days on which both have a bar, and the share of these with equal bars.

    The days of a pair are bounded by the calendar.
    """
    mine = bars.select("ticker", "date", F.struct(*VALUE_COLS).alias("bar"))
    theirs = bars.select(F.col("ticker").alias("new_ticker"), "date", F.struct(*VALUE_COLS).alias("new_bar"))
    both = pairs.join(mine, "ticker").join(theirs, ["new_ticker", "date"])
    equal = F.count_if(F.col("bar").eqNullSafe(F.col("new_bar")))
    return both.groupBy(*pairs.columns).agg(
        F.count("*").alias("shared_days"), (equal / F.count("*")).cast("double").alias("agreement")
    )


def chains(successors: DataFrame, once: Materialise) -> DataFrame:
    """(ticker, current_ticker, steps) for links ticker -> new_ticker, each ticker with one link: A -> B -> C ends at C.

    Every round doubles the length that is followed. A link goes to a ticker that ends later, so there are no
    circles and the rounds are few.
    """
    at = once(successors.select("ticker", F.col("new_ticker").alias("current_ticker"), F.lit(1).alias("steps")))
    while True:
        onward = at.select(
            F.col("ticker").alias("current_ticker"), F.col("current_ticker").alias("end"), F.col("steps").alias("more")
        )
        moved = once(at.join(onward, "current_ticker", "left"))
        done = moved.where("end is not null").isEmpty()
        at = moved.select(
            "ticker",
            F.coalesce("end", "current_ticker").alias("current_ticker"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
        )
        if done:
            return at


def rename_candidates(
    bars: DataFrame,
    dim: DataFrame,
    once: Materialise,
    most_holders: int = MOST_HOLDERS,
    least_days: int = LEAST_DAYS,
    least_agreement: float = LEAST_AGREEMENT,
) -> DataFrame:
    """(ticker_id, ticker, new_ticker, shared_days, agreement, current_ticker, steps), for a person to confirm.

    A known ticker that stopped is matched with an unknown one that goes on longer and brings the old history
    along. Of several the one that stops first is the next name; ``current_ticker`` is the last name of the
    chain and ``steps`` how many renames lead to it, by way of names that the dimension need not know. Nothing
    is changed. ``bars`` has each ticker and day once and is read four times, with the columns of a bar only.
    """
    pairs = rename_pairs(bars, dim, most_holders, once)
    good = compared(pairs, bars).where((F.col("shared_days") >= least_days) & (F.col("agreement") >= least_agreement))
    order = F.struct("new_last", -F.col("agreement"), "new_ticker")
    link = F.min_by(F.struct("new_ticker", "shared_days", "agreement"), order).alias("next")
    successors = once(good.groupBy("ticker").agg(link).select("ticker", "next.*"))
    ends = chains(successors, once)
    known = successors.join(dim.select("ticker", "ticker_id"), "ticker")
    return known.join(ends, "ticker").select(
        "ticker_id", "ticker", "new_ticker", "shared_days", "agreement", "current_ticker", "steps"
    )
