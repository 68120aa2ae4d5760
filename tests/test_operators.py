"""Rules that SQL comparison does not show: recurrences, look-ahead, errors, streams, empty input."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import names
from tidemark.operators import asof, bars, decisions, features, labels, pairs, predicates, sequential
from tidemark.operators import windows as W
from tidemark.streaming import bars as live


def series(spark, close, symbol="a"):
    rows = [(symbol, i * 60, c, c + 1.0, c - 1.0, c, 10.0 + i % 3) for i, c in enumerate(close)]
    return spark.createDataFrame(rows, "symbol string, t long, open double, high double, low double, close double, volume double")


TICKS = "symbol string, us long, seq long, side string, price double, amount double"


def test_recursive_indicators_follow_their_recurrence(spark):
    rng = np.random.default_rng(1)
    close = 100 + rng.standard_normal(80).cumsum()
    got = sequential.recursive_indicators(series(spark, close.tolist())).orderBy("t").toPandas()
    want, s = [math.nan] * 80, close[:12].mean()
    want[11] = s
    for i in range(12, 80):
        s = s + 2 / 13 * (close[i] - s)
        want[i] = s
    np.testing.assert_allclose(got["ema_12"].to_numpy(float), want, rtol=1e-12)
    step = np.diff(close)
    up, down = np.maximum(step, 0)[:14].mean(), np.maximum(-step, 0)[:14].mean()
    for i in range(14, 79):
        up, down = up + (max(step[i], 0) - up) / 14, down + (max(-step[i], 0) - down) / 14
    assert got["rsi"].iloc[-1] == pytest.approx(100 * up / (up + down))
    assert got["rsi"].iloc[:14].isna().all()


def test_positions_follow_the_score(spark):
    z = [0, 2.5, 1.0, 0.4, -2.2, -1, 5.0, 2.1, 2.2, 2.3]
    rows = spark.createDataFrame([("p", i, float(v)) for i, v in enumerate(z)], "symbol string, t long, z double")
    got = [r["position"] for r in sequential.positions_by_score(rows, longest=2).orderBy("t").collect()]
    assert got == [0, -1, -1, 0, 1, 1, 0, -1, -1, 0]


def test_kalman_hedge_uses_the_past_only(spark):
    x = np.linspace(1, 2, 60)
    frame = lambda y: spark.createDataFrame(pd.DataFrame({"symbol": "p", "t": range(60), "x": x, "y": y}))
    base = sequential.kalman_hedge(frame(3 * x)).orderBy("t").toPandas()["hedge"]
    later = 3 * x
    later[40:] = 0
    assert (sequential.kalman_hedge(frame(later)).orderBy("t").toPandas()["hedge"][:41] == base[:41]).all()
    assert base.iloc[-1] == pytest.approx(3, abs=0.05)


def test_features_do_not_look_ahead(spark):
    close = [100.0 + (i * 7) % 11 for i in range(60)]
    changed = close[:40] + [1.0] * 20
    for f in (features.price_features, features.indicators):
        a, b = (f(series(spark, c)).orderBy("t").toPandas().iloc[:40] for c in (close, changed))
        pd.testing.assert_frame_equal(a, b)


def test_constant_windows(spark):
    got = series(spark, [5.0] * 12).select(W.skew(F.col("close"), 10, W.series()).alias("s"), W.kurtosis(F.col("close"), 10, W.series()).alias("k"), W.correlation(F.col("close"), F.col("volume"), 10, W.series()).alias("c")).collect()[-1]
    assert (got["s"], got["k"], got["c"]) == (0.0, -3.0, None)


def test_bars_break_ties_by_sequence_and_fill_within_a_day(spark):
    rows = [("a", 0, 2, "buy", 5.0, 1.0), ("a", 0, 1, "sell", 4.0, 2.0), ("a", 86_400_000_000 * 2, 3, "b", 9.0, None)]
    got = {(r["t"]): r for r in bars.trade_bars(spark.createDataFrame(rows, TICKS), 3600).collect()}
    assert (got[0]["open"], got[0]["close"], got[0]["buy_volume"]) == (4.0, 5.0, 1.0)
    quotes = spark.createDataFrame([], "symbol string, us long, seq long, bid double, ask double, bid_size double, ask_size double")
    grid = bars.uniform_bars(spark.createDataFrame(rows, TICKS), quotes, 3600).orderBy("t").collect()
    assert len(grid) == 48 and grid[23]["close"] == 5.0 and grid[24]["close"] == 9.0
    assert bars.uniform_bars(spark.createDataFrame([], TICKS), quotes, 3600).count() == 0


def test_as_of_carries_whole_rows(spark):
    left = spark.createDataFrame([("a", 5), ("a", 9), ("b", 5)], "symbol string, t long")
    right = spark.createDataFrame([("a", 5, 1.0), ("a", 7, None)], "symbol string, at long, v double")
    got = {(r["symbol"], r["t"]): (r["r_at"], r["r_v"]) for r in asof.as_of(left, right, "symbol", "t", "at", "r_").collect()}
    assert got == {("a", 5): (5, 1.0), ("a", 9): (7, None), ("b", 5): (None, None)}
    near = asof.as_of(left, right, "symbol", "t", "at", "r_", within=1)
    assert {(r["t"], r["r_at"]) for r in near.where("symbol = 'a'").collect()} == {(5, 5), (9, None)}


def test_labels_at_the_edges(spark):
    one = spark.range(1).select(labels.rungs(F.lit(100.0), F.lit(97.9), 0.01, 4).alias("n"), labels.rungs(F.lit(100.0), F.lit(None).cast("double"), 0.01, 4).alias("none"), labels.short_rungs(F.lit(100.0), F.lit(150.0), 0.01, 4).alias("most")).first()
    assert (one["n"], one["none"], one["most"]) == (3, 1, 4)
    assert series(spark, [1.0, 2.0]).select(labels.forward_return(F.col("close"), 1, W.series()).alias("g")).collect()[1]["g"] is None


def test_predicates_parse_and_refuse(spark):
    df = features.price_features(series(spark, [100.0, 101.0, 99.0, 120.0])).withColumnsRenamed({"return_1": "mom", "volume_ratio": "vol_ratio"}).withColumn("4h_mom", F.lit(1.0))
    hold = lambda name, side="long", **more: df.where(predicates.predicate(name, side, df.columns, **more)).count()
    rising = df.where("mom > 0").count()
    assert hold("mom_positive_and_4h_mom_positive_or_low_volume") == rising == hold(["mom_positive", "&", "4h_mom_positive"]) == hold("c1", codes={"c1": "mom_positive"})
    assert hold("mom_positive_long") == rising and hold("mom_positive_short") == 0 and hold("mom_positive", "short") == df.where("mom < 0").count()
    assert hold(["mom_positive", "|", "__all"]) == 4
    with pytest.raises(ValueError, match="unknown"):
        hold("falling_stars")
    with pytest.raises(ValueError, match="no predicate"):
        hold("baseline")
    with pytest.raises(ValueError, match="needs the columns"):
        hold("1d_mom_positive")
    assert len(predicates.crossed(["mom_positive", "low_volume"], ["4h", "15m"])) == 8
    assert predicates.allowed_sides("rsi_oversold_and_low_vol") == ["long"] and predicates.allowed_sides("rsi_oversold_and_4h_rsi_overbought") == []
    assert predicates.with_side("long_liq_spike", "flow") == ("long_liq_spike", None) and predicates.with_side("4h_long_liq_spike_short", "flow") == ("4h_long_liq_spike", "short")
    assert predicates.stack_of(["__summary__", "rsi_overbought", "low_vol"]) == [("rsi_overbought", "short"), ("low_vol", "long"), ("low_vol", "short")]
    assert predicates.without_anchors([("btc_up_and_low_vol", "long"), ("low_vol", "long")], ["BTCUSDT"]) == [("low_vol", "long")]
    assert df.where(predicates.anchor_state([{"col": "mom", "op": ">", "val": 0.0}], df.columns)).count() == rising


def open_bar(*trades, **kwargs):
    bar = live.OpenBar(60, kwargs.get("discard_first", False), kwargs.get("most_empty", 100), None)
    for trade in trades:
        bar.trade(*trade)
    return bar


def test_open_bar_counts_and_flat_bars():
    at = lambda s: (1_700_000_040 + s) * 1_000_000
    bar = open_bar((at(0), 1, 10.0, 1.0), (at(1), 2, 12.0, 1.0), (at(2), 2, 99.0, 1.0), (at(61), 6, 11.0, 2.0), (at(3), 7, 50.0, 1.0), (at(250), 8, 9.0, 1.0), (at(251), 9, -1.0, 1.0), (at(99_999), 10, 5.0, 1.0))
    first, second, empty, *_ = [dict(zip(live.SHOWN, b, strict=True)) for b in bar.closed]
    # Numbers left out are charged to the bar that was open.
    assert (first["open"], first["high"], first["close"], first["trades"], first["duplicate"], first["missing"], first["gaps"]) == (10, 12, 12, 2, 1, 3, 1)
    assert (second["late"], second["trades"], second["volume"], second["missing"]) == (1, 1, 2.0, 0)
    assert (empty["open"], empty["close"], empty["volume"], empty["trades"]) == (11, 11, 0, 0)
    assert len(bar.closed) == 4 and bar.s["implausible"] == 2
    assert len(open_bar((at(0), 1, 10.0, 1.0), (at(61), 2, 1.0, 1.0), (at(130), 3, 1.0, 1.0), discard_first=True).closed) == 1
    held = open_bar((at(0), 1, 10.0, 1.0))
    held.quote(at(70), 5.0, None)
    held.quote(at(10), 4.0, 6.0)
    assert (held.s["bid"], held.s["ask"]) == (4.0, 6.0)
    again = type(held)(60, False, 100, held.state())
    again.trade(at(65), 2, 10.0, 1.0)
    assert (again.s["bid"], again.s["ask"]) == (5.0, 6.0) and again.closed[0][7] == 4.0


def test_lots_round_half_to_even(spark):
    q = spark.range(1).select(decisions.lots(F.lit(-0.25), F.lit(10.0), 0.1, 1.0).alias("a"), decisions.lots(F.lit(0.01), F.lit(10.0), 0.1, 5.0).alias("b"), decisions.lots(F.lit(0.0), F.lit(10.0), 0.1, 5.0).alias("c")).first()
    assert (round(q["a"], 9), round(q["b"], 9), q["c"]) == (-0.2, 0.5, 0.0)


def test_walk_forward_windows_cover_each_row(spark):
    rows = spark.range(0, 100).select(F.lit("a").alias("symbol"), F.col("id").alias("t"))
    got = pairs.walk_forward(rows, 20, 10)
    tests = got.where("test").groupBy("t").count().collect()
    assert len(tests) == 100 and all(r["count"] == 1 for r in tests)
    past = got.where("not test").groupBy("window").count().where("window between 20 and 100").collect()
    assert all(r["count"] == 20 for r in past)


def test_names():
    assert [names.seconds_of(f) for f in ("30s", "15m", "4h", "1d")] == [30, 900, 14_400, 86_400]
    for bad in ("0m", "h", "15", ""):
        with pytest.raises(ValueError):
            names.seconds_of(bad)
    with pytest.raises(ValueError):
        names.frames_in_order(["60m", "1h"])


def test_codes_keep_frames_and_suffixes(spark):
    df = spark.createDataFrame([(1, 2, 3)], "4h_close int, spread_roll60_mean int, other int")
    assert names.coded(df, {"close": "f001", "spread": "f002"}).columns == ["4h_f001", "f002_roll60_mean", "other"]


def test_streamed_bars_equal_batch_bars(spark, tmp_path):
    begin = 1_000_000_020  # a full minute in 2001
    rows = [("a", (begin + i * 20) * 1_000_000, i, "buy", 100.0 + i % 7, 1.0) for i in range(200) if not 40 <= i < 60]
    ticks = spark.createDataFrame(rows, TICKS)
    for part in range(5):  # files in the order of time, one for each micro-batch
        piece = ticks.where(f"seq div 40 = {part}").withColumn("ts", F.timestamp_micros("us"))
        piece.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run = live.windowed_bars(stream, 60, "1 minute").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    run.awaitTermination()
    got = {r["t"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r["t"]: r for r in live.windowed_bars(spark.read.parquet(str(tmp_path / "in")), 60, "1 minute").collect()}
    assert len(got) > len(want) // 2 and all(got[t] == want[t] for t in got)

    run = live.gapless_bars(stream.drop("ts", "side"), 60).writeStream.format("parquet").option("path", str(tmp_path / "out2")).option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    run.awaitTermination()
    flat = {r["t"]: r for r in spark.read.parquet(str(tmp_path / "out2")).collect()}
    assert sorted(flat) == list(range(begin, max(flat) + 60, 60))
    assert all(flat[t]["close"] == want[t]["close"] and flat[t]["trades"] == want[t]["trades"] for t in want if t in flat)
    empty = [t for t in flat if t not in want]
    assert empty and all(flat[t]["trades"] == 0 and flat[t]["open"] == flat[t]["close"] == flat[t - 60]["close"] for t in empty)
    assert sum(flat[t]["missing"] for t in flat) == 20


def test_moments_of_large_prices_with_small_moves(spark):
    values = [1e6 + v for v in (1.0, 2.0, 4.0, 4.0, 3.0, 3.0, 3.0, 3.0)]
    got = series(spark, values).select("t", W.skew(F.col("close"), 4, W.series()).alias("s"), W.kurtosis(F.col("close"), 4, W.series()).alias("k")).orderBy("t").collect()
    want = pd.Series([v - 1e6 for v in values]).rolling(4)
    assert [r["s"] for r in got[3:7]] == pytest.approx(want.skew()[3:7].tolist(), abs=1e-6)
    assert [r["k"] for r in got[3:7]] == pytest.approx(want.kurt()[3:7].tolist(), abs=1e-6) and (got[7]["s"], got[7]["k"]) == (0.0, -3.0)


def test_scored_batches_see_history_and_replace_their_folder(spark, tmp_path):
    rows = [("a", i * 60, float(i), float(i)) for i in range(8)]
    for part in range(4):
        spark.createDataFrame(rows[2 * part : 2 * part + 2], "symbol string, t long, close double, volume double").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("symbol string, t long, close double, volume double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    score = lambda bars: bars.withColumn("before", F.lag("close").over(W.series()))
    live.scored_batches(stream, score, str(tmp_path / "out"), str(tmp_path / "c"), history=2).awaitTermination()
    got = {r["t"]: r["before"] for r in spark.read.parquet(str(tmp_path / "out" / "scores")).collect()}
    assert len(got) == 8 and all(got[i * 60] == (i - 1 if i else None) for i in range(8))
    assert live.warmed_up(spark.read.parquet(str(tmp_path / "in")), 5).count() == 4


def test_archives_refuse_and_deal(spark, tmp_path):
    from tidemark.sources import archives

    day = spark.createDataFrame([("a", 1_704_067_200_000_000, 1, "buy", 1.0, 2.0)], "symbol string, us long, seq long, side string, price double, amount double")
    archives.write_stream(day, str(tmp_path / "t" / "trades"))
    found = archives.day(spark, str(tmp_path / "t"), "20240101", ("trades", "liquidations"))
    assert found["trades"].count() == 1 and found["liquidations"].count() == 0
    with pytest.raises(FileNotFoundError):
        archives.stream(spark, str(tmp_path / "t"), "liquidations", strict=True)
    rows = spark.createDataFrame([("a", 0, 1.0, 1.0, 1.0, 1.0, 1.0)], "symbol string, open_time_ms long, open double, high double, low double, close double, volume double")
    rows.write.partitionBy("symbol").parquet(str(tmp_path / "k"))
    assert archives.candle_tree(spark, str(tmp_path / "k"), ["a"]).count() == 1
    with pytest.raises(FileNotFoundError, match="b"):
        archives.candle_tree(spark, str(tmp_path / "k"), ["a", "b"])
    with pytest.raises(FileNotFoundError, match="4h"):
        archives.framed_candles(spark, str(tmp_path / "k"), ["4h"])
    with pytest.raises(ValueError, match="1d"):
        archives.narrowed(rows.withColumn("4h_x", F.lit(1)), ["4h", "1d"])
    archives.write_slices(rows.withColumns({"regime": F.lit("r"), "position": F.lit("long")}), str(tmp_path / "s"))
    kept = archives.slices(spark, str(tmp_path / "s"), ["r"], ("symbol", "open_time_ms"))
    assert kept.count() == 1 and "regime" in kept._jdf.queryExecution().toString().split("PartitionFilters")[1][:80]
