"""As-of joins in blocks, sided trades, settings, and rules that change while a stream runs."""

import datetime as dt
import os
import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.functions import settings
from tidemark.operators import asof, bars
from tidemark.plans import catalog
from tidemark.streaming import bars as live
from tidemark.streaming.live_stack import Stack, decided_batches


@pytest.mark.parametrize("block", [None, 1, 7, 100, 10_000])
def test_as_of_equals_brute_force_whatever_the_block(spark, block):
    rng = random.Random(5)
    left = [(rng.choice(["a", "b", "c", None]), rng.choice([None, *range(-50, 400)]), i) for i in range(120)]
    right = [(rng.choice(["a", "b"]), rng.randrange(-40, 300), rng.choice([None, rng.random()])) for _ in range(60)]
    lefts, rights = spark.createDataFrame(left, "k string, at long, i long").repartition(3), spark.createDataFrame(right, "k string, at long, x double").repartition(3)
    for within in (None, 20):
        got = {r["i"]: (r["r_at"], r["r_x"]) for r in asof.as_of(lefts, rights, "k", "at", "at", "r_", within, block).collect()}
        assert len(got) == len(left)
        for k, at, i in left:
            known = [(t, x) for s, t, x in right if s == k and at is not None and t <= at]
            want = max(known, key=lambda r: (r[0], r[1] is not None, r[1] or 0), default=(None, None))
            if within is not None and want[0] is not None and at - want[0] > within:
                want = (None, None)
            assert got[i] == want, (k, at, block)


def test_trades_without_a_side_take_the_quote_rule_or_none(spark):
    ticks = [("a", 10, 1, None, 5.0, 1.0), ("a", 20, 2, "BUY", 1.0, 1.0), ("a", 30, 3, None, 10.0, 2.0), ("a", 40, 4, None, 9.0, 3.0), ("a", 50, 5, None, 9.5, 4.0), ("a", 86_400_000_060, 6, None, 11.0, 5.0), ("b", 10, 7, None, 1.0, 1.0), ("a", 60, 8, None, 9.0, 1.0)]
    quotes = [("a", 25, 1, 9.0, 10.0), ("a", 55, 2, 0.0, None), ("a", 70, 3, 9.0, 10.0)]
    frame = spark.createDataFrame(ticks, "symbol string, us long, seq long, side string, price double, amount double")
    own = bars.sided(frame, spark.createDataFrame(quotes, "symbol string, us long, seq long, bid double, ask double"))
    assert {r["seq"]: (r["taker"], r["by"]) for r in own.collect()} == {1: (None, None), 2: ("buy", "flag"), 3: ("buy", "quote"), 4: ("sell", "quote"), 5: (None, None), 6: ("buy", "quote"), 7: (None, None), 8: (None, None)}
    got = {(r["symbol"], r["t"]): r for r in bars.taker_bars(own, 3600).collect()}
    r = got["a", 0]
    assert (r["trades"], r["unsided"], r["taker_buy_base"], r["taker_buy_quote"], r["any_flag"], r["any_quote_rule"]) == (6, 3, 3.0, 21.0, True, True)
    assert (got["b", 0]["unsided"], got["b", 0]["any_flag"], got["b", 0]["any_quote_rule"]) == (1, False, False)


def test_taker_bars_take_quotes_of_zero_as_their_sql_does(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    rows = [(1, at, 1, "a", 0.0, '{"k": 3}'), (4, at + dt.timedelta(seconds=5), 2, "a", 7.0, '{"k": 4}'), (12, at + dt.timedelta(seconds=9), 2, "a", 7.5, '{"k": 5}'), (16, at + dt.timedelta(seconds=10), 1, "b", 7.5, '{"k": 5}')]
    db = duckdb.connect()
    db.execute("CREATE TABLE events (event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR)")
    db.executemany("INSERT INTO events VALUES (?, ?, ?, ?, ?, ?)", rows)
    db.execute(f"COPY events TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    got = catalog.QUERIES["taker_bars"](spark, str(tmp_path))
    want = db.execute(catalog.ORACLES["taker_bars"])
    assert got.columns == [c[0] for c in want.description]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())
    assert sorted((r["symbol"], r["unsided"]) for r in got.collect()) == [("a", 0), ("b", 0)]


def test_settings_are_checked():
    assert settings.rolling_cutoffs({}) is None and settings.rolling_cutoffs({settings.MODE: "fixed"}) is None
    found = settings.rolling_cutoffs({settings.MODE: "rolling_quantile"})
    assert found.window_bars == 518_400 and found.levels
    column = sorted(found.levels)[0]
    assert settings.rolling_cutoffs({settings.MODE: "rolling_quantile", settings.BARS: 10, settings.LEVELS: {column: 0.3}}).levels[column] == (0.3,)
    for bad in (
        {settings.BARS: 5}, {settings.LEVELS: {}, settings.MODE: "fixed"}, {settings.MODE: "other"}, {settings.MODE: None}, *({settings.MODE: "rolling_quantile", settings.BARS: n} for n in (0, -1, 2.5, True, "7")),
        *({settings.MODE: "rolling_quantile", settings.LEVELS: x} for x in ([1], {"nothing": 0.5}, {column: 1}, {column: True}, {column: 0.0})),
    ):
        with pytest.raises(ValueError):
            settings.rolling_cutoffs(bad)


def test_windows_in_days(spark):
    frame = lambda rows: spark.createDataFrame(rows, "symbol string, t long")
    five = [("a", i * 5) for i in range(40)] + [("a", 5000), ("a", 5000)] + [("b", i * 3600) for i in range(9)]
    assert settings.window_days(frame(five), 518_400) == {"a": 30, "b": 21_600}
    for rows, n in ((five, 1000), ([("a", 7), ("a", 7)], 10), ([], 10), ([("a", None), ("a", 1), ("a", 2)], 10**9)):
        with pytest.raises(ValueError):
            settings.window_days(frame(rows), n)


BARS = "symbol string, t long, close double"


def put(spark, folder, rows):
    spark.createDataFrame(rows, BARS).coalesce(1).write.mode("append").parquet(folder)


def test_rules_are_read_again_when_their_file_changes(spark, tmp_path):
    rules, bars_in, out, at = tmp_path / "stack.csv", str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c")
    stack = Stack(f"file://{rules}", "regime string, threshold double")
    decide = lambda batch, now: batch.join(F.broadcast(now), F.col("close") > F.col("threshold"))
    reads = []
    rules.write_text("regime,threshold\n__comment,0\nhigh,5\n")

    def run():
        stream = spark.readStream.schema(BARS).parquet(bars_in)
        decided_batches(stream, stack, decide, out, at).awaitTermination()
        reads.append(stack.version)

    put(spark, bars_in, [("a", 1, 4.0), ("a", 2, 6.0)])
    run()
    put(spark, bars_in, [("a", 3, 4.0)])
    run()  # the same file: no row is over 5
    rules.write_text("regime,threshold\nlow,3\nmid,3.5\n")
    os.utime(rules, (time.time() + 10, time.time() + 10))
    put(spark, bars_in, [("a", 4, 4.0)])
    run()
    got = sorted((r["t"], r["regime"]) for r in spark.read.parquet(f"{out}/batch=0", f"{out}/batch=1", f"{out}/batch=2").collect())
    assert got == [(2, "high"), (4, "low"), (4, "mid")] and reads[0] == reads[1] < reads[2]
    rules.write_text("regime,threshold\nlow,not a number\n")
    os.utime(rules, (time.time() + 20, time.time() + 20))
    put(spark, bars_in, [("a", 5, 4.0)])
    with pytest.raises(Exception, match="MALFORMED|not a number|CSV"):
        run()


def test_a_batch_reads_a_bounded_history(spark, tmp_path):
    for i in range(6):
        put(spark, str(tmp_path / "in"), [("a", i, float(i)), ("b", i, -float(i))])
    seen = []

    def score(rows):
        seen.append(rows.count())
        return rows.groupBy("symbol", "t").agg(F.max("close").alias("s"))

    stream = spark.readStream.schema(BARS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    live.scored_batches(stream, score, str(tmp_path / "out"), str(tmp_path / "c"), history=2).awaitTermination()
    assert seen == [2, 4, 6, 6, 6, 6] and spark.read.parquet(str(tmp_path / "out" / "scores")).count() == 12
    assert len([d for d in os.listdir(tmp_path / "out" / "history") if d.startswith("batch=")]) == 2


@pytest.mark.parametrize("size, back", [(1, 1), (3, 2), (10, 10), (1000, 4)])
def test_blocks_change_nothing(spark, size, back):
    from tidemark.operators import windows as W

    rng = random.Random(1)
    rows = [(s, t * 3600 * rng.choice([1, 1, 30]) + t * 40 * 86_400 // 39, rng.random() if rng.random() > 0.1 else None) for s, n in (("a", 60), ("b", 1), (None, 7)) for t in range(n)]
    rows = list({(s, t): (s, t, x) for s, t, x in rows}.values())
    frame = spark.createDataFrame(rows, "symbol string, t long, x double").repartition(4)
    numbers = W.numbered(frame).collect()
    for s in ("a", "b", None):
        own = sorted((r for r in numbers if r["symbol"] == s), key=lambda r: r["t"])
        assert [r["__n"] for r in own] == list(range(len(own)))
    compute = lambda df, w: df.select("*", W.mean(F.col("x"), back + 1, w, 1).alias("m"), F.lag("x", back).over(w).alias("l"))
    key = lambda r: (str(r["symbol"]), r["t"])
    whole, dealt = (sorted(df.collect(), key=key) for df in (compute(frame, W.series()), W.in_blocks(frame, back, compute, size)))
    assert len(whole) == len(dealt) == len(rows)
    for a, b in zip(whole, dealt):
        assert (a["symbol"], a["t"], a["l"]) == (b["symbol"], b["t"], b["l"]) and (a["m"] == b["m"] or abs(a["m"] - b["m"]) < 1e-12)
    with pytest.raises(ValueError):
        W.in_blocks(frame, size + 1, compute, size)
