"""Bars from a stream of ticks."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import windows as W


def windowed_bars(ticks: DataFrame, seconds: int, grace: str) -> DataFrame:
    """Bars of a stream (or a table) of ticks with a TIMESTAMP column ts: a bar is final once the watermark has passed it.

    Implausible rows are dropped; repeated (symbol, seq) count once.
    """
    sane = ticks.where("price > 0 and ts >= timestamp'2000-01-01'")
    sane = sane.withWatermark("ts", grace).dropDuplicatesWithinWatermark(["symbol", "seq"]) if ticks.isStreaming else sane.dropDuplicates(["symbol", "seq"])
    when = F.struct("ts", "seq")
    return sane.groupBy("symbol", F.window("ts", f"{seconds} seconds").alias("w")).agg(
        F.min_by("price", when).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", when).alias("close"), F.sum("amount").alias("volume"), F.count("price").alias("trades"),
    ).select("symbol", F.unix_seconds("w.start").alias("t"), "open", "high", "low", "close", "volume", "trades")


COUNTS = ("late", "duplicate", "gaps", "missing", "aggregated", "implausible")
STATE = "t long, open double, high double, low double, close double, volume double, trades long, bid double, ask double, last_seq long, started boolean, ahead string, " + ", ".join(f"{c} long" for c in COUNTS)
SHOWN = ("t", "open", "high", "low", "close", "volume", "trades", "bid", "ask", *COUNTS)
OUT = "symbol string, t long, open double, high double, low double, close double, volume double, trades long, bid double, ask double, " + ", ".join(f"{c} long" for c in COUNTS)
EARLIEST = 946_684_800  # 2000-01-01


class OpenBar:
    """The bar of one symbol that is being filled, and what must be remembered beyond it."""

    def __init__(self, seconds: int, discard_first: bool, most_empty: int, held: tuple | None):
        self.seconds, self.most_empty = seconds, most_empty
        names = [c.split()[0] for c in STATE.split(", ")]
        self.s = dict(zip(names, held, strict=True)) if held else dict.fromkeys(names)
        if not held:
            self.s |= {"volume": 0.0, "trades": 0, "started": not discard_first, "ahead": "{}", **dict.fromkeys(COUNTS, 0)}
        self.ahead = {int(t): x for t, x in json.loads(self.s["ahead"]).items()}
        self.closed: list[tuple] = []

    def state(self) -> tuple:
        self.s["ahead"] = json.dumps(self.ahead)
        return tuple(self.s.values())

    def close(self) -> None:
        """The bar ends; the next one is flat at its close until a trade comes. The first one may be a part only, and is then left out once."""
        s = self.s
        if s["started"]:
            self.closed.append(tuple(s[c] for c in SHOWN))
        s |= {"t": s["t"] + self.seconds, "open": s["close"], "high": s["close"], "low": s["close"], "volume": 0.0, "trades": 0, "started": True, **dict.fromkeys(COUNTS, 0)}
        self._look_ahead()

    def _look_ahead(self) -> None:
        for t in sorted(t for t in self.ahead if t <= self.s["t"]):
            self.s |= {k: v for k, v in zip(("bid", "ask"), self.ahead.pop(t), strict=True) if v is not None}

    def close_until(self, t: int) -> None:
        while self.s["t"] is not None and self.s["t"] < t:
            self.close()

    def trade(self, us: int, seq: int, price: float, amount: float) -> None:
        s, t = self.s, us // 1_000_000 // self.seconds * self.seconds
        too_far = s["t"] is not None and t - s["t"] > self.most_empty * self.seconds
        if us < EARLIEST * 1_000_000 or not price > 0 or too_far:
            s["implausible"] += 1
            return
        if s["last_seq"] is not None and seq <= s["last_seq"]:
            s["duplicate"] += 1
            return
        # What was left out before this trade belongs to the bar that is open.
        if s["last_seq"] is not None and seq > s["last_seq"] + 1:
            s["gaps"] += 1
            s["missing"] += seq - s["last_seq"] - 1
        s["last_seq"] = seq
        if s["t"] is None:
            s["t"] = t
            self._look_ahead()
        if t < s["t"]:
            s["late"] += 1
            return
        self.close_until(t)
        if not s["trades"]:
            s |= {"open": price, "high": price, "low": price}
        s |= {"high": max(s["high"], price), "low": min(s["low"], price), "close": price, "volume": s["volume"] + amount, "trades": s["trades"] + 1}

    def quote(self, us: int, bid: float | None, ask: float | None) -> None:
        """States of a later bar wait until it opens."""
        t = us // 1_000_000 // self.seconds * self.seconds
        if self.s["t"] is None or t > self.s["t"]:
            old = self.ahead.get(t, (None, None))
            self.ahead[t] = [b if b is not None else a for a, b in zip(old, (bid, ask), strict=True)]
        else:
            self.s |= {k: v for k, v in (("bid", bid), ("ask", ask)) if v is not None}


def gapless_bars(ticks: DataFrame, seconds: int, grace: int | None = None, discard_first: bool = False, most_empty: int = 10_000) -> DataFrame:
    """Bars without gaps from a stream of (symbol, us, seq, price, amount): empty ones are flat at the last close.

    A bar closes when a trade of a later one arrives; with a grace (seconds; ticks then needs a watermark on a column ts)
    also when the watermark has passed its end by that much. Sequence numbers must rise: a trade whose number does not
    counts as duplicate, numbers left out count as missing (and once as a gap) in the bar that is open, and a trade of a
    closed bar counts as late. Trades without a price, before 2000, or more than most_empty bars ahead are counted as
    implausible. discard_first: the first bar of a symbol is a part only and is left out.

    Rows may carry a `kind`: "trade" (or null), "aggregate" (counted, never applied) or "quote" (bid and ask, carried
    from bar to bar; those of a later bar wait until it opens). State is one open bar for each symbol.
    """
    has = set(ticks.columns)

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        bar = OpenBar(seconds, discard_first, most_empty, tuple(state.get) if state.exists else None)
        if state.hasTimedOut:
            bar.close_until(bar.s["t"] + seconds)
        else:
            rows = pd.concat(list(batches)).sort_values(["us", "seq"], kind="stable")
            kinds = rows["kind"] if "kind" in has else [None] * len(rows)
            sides = [rows[c] if c in has else [None] * len(rows) for c in ("bid", "ask")]
            known = lambda x: None if x is None or pd.isna(x) else float(x)
            for us, seq, price, amount, kind, bid, ask in zip(rows["us"], rows["seq"], rows["price"], rows["amount"], kinds, *sides, strict=True):
                if kind == "quote":
                    bar.quote(int(us), known(bid), known(ask))
                elif kind == "aggregate":
                    bar.s["aggregated"] += 1
                else:
                    bar.trade(int(us), int(seq), float(price), float(amount))
        state.update(bar.state())
        if grace is not None and bar.s["t"] is not None:
            state.setTimeoutTimestamp(max((bar.s["t"] + seconds + grace) * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([(key[0], *b) for b in bar.closed], columns=["symbol", *SHOWN])

    timeout = GroupStateTimeout.NoTimeout if grace is None else GroupStateTimeout.EventTimeTimeout
    return ticks.groupBy("symbol").applyInPandasWithState(run, OUT, STATE, "append", timeout)


def warmed_up(bars: DataFrame, least: int) -> DataFrame:
    """Bars from the one on with which at least so many of the symbol have been fed."""
    return bars.withColumn("__fed", F.count(F.lit(1)).over(W.so_far(W.series()))).where(F.col("__fed") >= least).drop("__fed")


def _numbered(spark, folder: str) -> list[int]:
    """The numbers of the batch=<n> folders in a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


def scored_batches(bars: DataFrame, score, sink: str, checkpoint: str, history: int = 1000):
    """Score a stream of final bars with batch code, which also sees the last `history` bars of each symbol.

    sink/bars and sink/scores get one folder for each micro-batch; a batch that is run again replaces its own folder.
    sink/history holds the last bars of each symbol after a batch, so a batch reads those after the batch before it and its own
    rows, however long the stream has run; folders older than that are deleted.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        mine = f"{sink}/bars/batch={number}"
        batch.write.mode("overwrite").parquet(mine)
        fresh = spark.read.schema(batch.schema).parquet(mine)
        before = [n for n in _numbered(spark, f"{sink}/history") if n < number]
        seen = spark.read.schema(batch.schema).parquet(f"{sink}/history/batch={before[-1]}").unionByName(fresh) if before else fresh
        scored = score(seen)
        scored.join(fresh.select("symbol", "t"), ["symbol", "t"], "left_semi").write.mode("overwrite").parquet(f"{sink}/scores/batch={number}")
        latest = Window.partitionBy("symbol").orderBy(F.desc("t"))
        seen.withColumn("__n", F.row_number().over(latest)).where(F.col("__n") <= history).drop("__n").write.mode("overwrite").parquet(f"{sink}/history/batch={number}")
        for old in before[:-1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{sink}/history/batch={old}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    return bars.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
