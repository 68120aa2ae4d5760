"""Code maps, column sets, and stacks over a ladder of frames."""

import pytest

from tidemark.functions import names
from tidemark.operators import predicates

CODES = names.Codes({"rsi": "f001", "close": "f002", "low_vol": "r001", "strong_trend": "r002", "goes_long": "r003"})


def test_columns_are_coded_and_decoded(spark):
    frame = spark.createDataFrame([(1, 2, 3, 4, 5)], "symbol long, rsi long, `4h_close` long, close_roll30_mean long, other long")
    coded = CODES.encoded(frame)
    assert coded.columns == ["symbol", "f001", "4h_f002", "f002_roll30_mean", "other"] and CODES.decoded(coded).columns == frame.columns
    both = CODES.with_aliases(frame)
    assert both.columns == [*frame.columns, "f001", "4h_f002", "f002_roll30_mean"] and CODES.with_aliases(both).columns == both.columns
    assert both.first()["f002_roll30_mean"] == 4 and names.coded(frame, CODES.codes).columns == coded.columns


def test_predicates_are_coded_and_decoded():
    name = "1d_strong_trend_and_low_vol_or_4h_low_vol_short"
    code = CODES.encoded_predicate(name)
    assert code == "1d_r002_and_r001_or_4h_r001_short" and CODES.decoded_predicate(code) == name
    assert CODES.encoded_predicate("goes_long") == "r003" and CODES.decoded_predicate("low_vol_and_r002", strict=False) == "low_vol_and_strong_trend"
    for bad, of in (("nothing", CODES.encoded_predicate), ("r009", CODES.decoded_predicate)):
        with pytest.raises(KeyError):
            of(bad)
    with pytest.raises(ValueError):
        names.Codes({"a": "x", "b": "x"})


def test_column_sets(spark):
    one, two = spark.createDataFrame([(1, 2)], "a long, b long"), spark.createDataFrame([(1, 2)], "b long, a long")
    assert names.same_columns({"one": one, "two": two}) == ["a", "b"]
    with pytest.raises(ValueError, match="three.*b"):
        names.same_columns({"one": one, "three": one.drop("b")})


def test_default_stack_of_a_ladder():
    stack = predicates.ladder_stack(["15m", "1h", "4h", "1d"])
    assert len(stack) == 332 and len(set(stack)) == 332
    assert stack[:2] == [("15m_strong_trend", "long"), ("15m_strong_trend", "short")]
    assert ("1d_strong_trend_and_4h_vol_breakout_and_1h_macd_bullish", "long") in stack and ("1d_strong_trend_and_4h_vol_breakout_and_1h_macd_bullish", "short") not in stack
    # The finest frame is no leg of a crossed name.
    assert not [n for n, _ in stack if "15m" in n and len({f[: f.index("_")] for f in n.split("_and_")}) > 1]
    other = predicates.ladder_stack(["1d", "5m", "30m", "2h"])
    assert [(n.replace("5m", "a").replace("30m", "b"), s) for n, s in other[:4]] == [(n.replace("15m", "a"), s) for n, s in stack[:4]] and len(other) == 332
    with pytest.raises(ValueError):
        predicates.ranked([(1, "low_vol", 0, "low_vol")], ["1d", "1h"])
    with pytest.raises(ValueError):
        predicates.ladder_stack(["1h", "4h"])


def test_time_frames_that_must_be_there(spark):
    frame = spark.createDataFrame([(1, 2)], "`1h_close` long, `4h_close` long")
    assert names.with_frames(frame, ["1h", "4h"]) is frame
    with pytest.raises(ValueError, match="1d"):
        names.with_frames(frame, ["1h", "1d"])
