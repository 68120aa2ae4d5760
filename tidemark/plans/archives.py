"""Queries that write the driver tables as archives and read them again."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import archives, driver_tables as tables
from . import oracles as sql
from .registry import HOUR, query, rounded

FIRST, LAST = "20240105", "20240107"
DATE = "strftime(make_timestamp(us - us % 86400000000), '%Y%m%d')"


def _date(us: str = "us"):
    return F.date_format(F.timestamp_seconds(F.floor(F.col(us) / 1_000_000)), "yyyyMMdd")


def tick_archive(spark, sf_dir, only: tuple[str, ...] = ("trades", "book_ticker", "derivative_ticker", "liquidations")) -> str:
    root = archives.scratch(spark, "ticks")
    made = {"trades": tables.ticks, "book_ticker": tables.quotes, "derivative_ticker": tables.tickers, "liquidations": tables.liquidations}
    for name in only:
        archives.write_stream(made[name](spark, sf_dir), f"{root}/{name}")
    return root


@query("tick_days", f"WITH {sql.TICKS} SELECT {DATE} AS date, symbol, count(*) AS ticks, round(sum(price * amount), 4) AS notional FROM ticks WHERE {DATE} IN ('{FIRST}', '{LAST}') GROUP BY 1, 2")
def tick_days(spark, sf_dir):
    rows = archives.stream(spark, tick_archive(spark, sf_dir, ("trades",)), "trades", [FIRST, LAST])
    return rows.groupBy("date", "symbol").agg(F.count(F.lit(1)).alias("ticks"), F.round(F.sum(F.col("price") * F.col("amount")), 4).alias("notional"))


@query("streams_of_a_day", f"WITH {sql.TICKS} SELECT 'book_snapshot' AS stream, CAST(0 AS BIGINT) AS events UNION ALL SELECT s, count(*) FILTER (s <> 'liquidations' OR amount >= 80) FROM ticks, (VALUES ('trades'), ('book_ticker'), ('derivative_ticker'), ('liquidations')) v(s) WHERE {DATE} = '{FIRST}' GROUP BY 1")
def streams_of_a_day(spark, sf_dir):
    found = archives.day(spark, tick_archive(spark, sf_dir), FIRST)
    parts = [df.agg(F.count(F.lit(1)).alias("events")).select(F.lit(name).alias("stream"), "events") for name, df in found.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("available_dates", f"WITH {sql.TICKS} SELECT strftime(d, '%Y%m%d') AS date, strftime(d, '%Y%m%d') IN (SELECT {DATE} FROM ticks) AS available FROM (SELECT unnest(generate_series(DATE '2023-12-25', DATE '2024-02-10', INTERVAL 1 DAY)) AS d)")
def available_dates(spark, sf_dir):
    return archives.available_dates(tables.ticks(spark, sf_dir).select(_date().alias("date")), "20231225", "20240210")


_CORRECTED = "SELECT symbol, t, open, CASE WHEN t % 345600 = 0 THEN close * 2 ELSE close END AS close, volume, CAST(trades AS DOUBLE) AS number_of_trades FROM candles"


@query("candle_tree_parquet", f"WITH {sql.CANDLES}, c AS ({_CORRECTED}) SELECT symbol, t, {sql.rounded('open close volume number_of_trades', 4)} FROM c WHERE symbol IN ('1-URGENT', '5-LOW')")
def candle_tree_parquet(spark, sf_dir):
    root = archives.scratch(spark, "tree")
    _write_generations(spark, sf_dir, root, "parquet")
    df = archives.candle_tree(spark, root, ["1-URGENT", "5-LOW"])
    return df.select("symbol", "t", *rounded(df, "open close volume number_of_trades", 4))


@query("candle_tree_csv", f"WITH {sql.CANDLES}, c AS ({_CORRECTED}) SELECT symbol, t, {sql.rounded('open close volume number_of_trades', 4)} FROM c")
def candle_tree_csv(spark, sf_dir):
    root = archives.scratch(spark, "tree")
    _write_generations(spark, sf_dir, root, "csv")
    df = archives.candle_tree(spark, root, form="csv", strict=False)
    return df.select("symbol", "t", *rounded(df, "open close volume number_of_trades", 4))


def _write_generations(spark, sf_dir, root: str, form: str) -> None:
    """All candles, and a later generation that has every fourth day again with other closes, as two files for each symbol."""
    rows = tables.candles(spark, sf_dir).select("symbol", (F.col("t") * 1000).alias("open_time_ms"), "open", "high", "low", "close", "volume", F.col("trades").alias("number_of_trades"))
    late = rows.where(F.col("open_time_ms") % (4 * 86_400_000) == 0).withColumn("close", F.col("close") * 2)
    for generation in (rows, late):
        stage = archives.scratch(spark, "generation")
        generation.repartition("symbol").sortWithinPartitions("symbol", "open_time_ms").write.partitionBy("symbol").option("header", True).format(form).save(stage)
        _move_files(spark, stage, root, "a" if generation is rows else "b")


def _move_files(spark, source: str, target: str, prefix: str) -> None:
    """Rename the files of a tree into another tree, names led by prefix (file order says which generation is later)."""
    jvm = spark._jvm.org.apache.hadoop.fs
    files = jvm.Path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in files.listStatus(jvm.Path(source)):
        if folder.isDirectory():
            to = jvm.Path(f"{target}/{folder.getPath().getName()}")
            files.mkdirs(to)
            for i, f in enumerate(files.listStatus(folder.getPath())):
                files.rename(f.getPath(), jvm.Path(to, f"{prefix}{i}-{f.getPath().getName()}"))


@query("framed_candles", f"WITH {sql.uniform(HOUR)}, b AS (SELECT symbol, t, close, volume, strftime(make_timestamp(day * 1000000), '%Y%m%d') AS date FROM bars), four AS (SELECT symbol, t // 14400 * 14400 AS t, arg_max(close, t) FILTER (close IS NOT NULL) AS close, sum(volume) AS volume, min(date) AS date FROM b GROUP BY ALL) SELECT tf, symbol, t, round(close, 6) + 0.0 AS close, round(volume, 6) + 0.0 AS volume FROM (SELECT '1h' AS tf, * FROM b UNION ALL SELECT '4h', * FROM four) WHERE date BETWEEN '{FIRST}' AND '{LAST}'")
def framed_candles(spark, sf_dir):
    from ..operators import bars
    from .catalog import hourly

    fine, root = hourly(spark, sf_dir).select("symbol", "t", "open", "high", "low", "close", "volume"), archives.scratch(spark, "framed")
    date = F.date_format(F.timestamp_seconds("t"), "yyyyMMdd")
    both = fine.withColumn("tf", F.lit("1h")).unionByName(bars.coarser(fine, 4 * HOUR).withColumn("tf", F.lit("4h"))).withColumn("date", date)
    archives.write_slices(both, root, ("tf", "date"))
    df = archives.framed_candles(spark, root, ["1h", "4h"], FIRST, LAST)
    return df.select("tf", "symbol", "t", *rounded(df, "close volume"))


_SLICES = "s AS (SELECT *, 'high_volume' AS regime, 'long' AS position FROM candles WHERE volume > 200 UNION ALL SELECT *, 'low_volume', 'short' FROM candles WHERE volume < 400)"


@query("slices_first_of_key", f"WITH {sql.CANDLES}, {_SLICES}, n AS (SELECT *, row_number() OVER (PARTITION BY symbol, t ORDER BY regime, position) AS n FROM s) SELECT symbol, t, regime, position, round(close, 6) AS close FROM n WHERE n = 1")
def slices_first_of_key(spark, sf_dir):
    rows, root = tables.candles(spark, sf_dir), archives.scratch(spark, "slices")
    both = rows.where("volume > 200").withColumns({"regime": F.lit("high_volume"), "position": F.lit("long")})
    both = both.unionByName(rows.where("volume < 400").withColumns({"regime": F.lit("low_volume"), "position": F.lit("short")}))
    archives.write_slices(both, root)
    df = archives.slices(spark, root)
    return df.select("symbol", "t", "regime", "position", F.round("close", 6).alias("close"))


@query("one_slice", f"WITH {sql.CANDLES}, {_SLICES} SELECT symbol, count(*) AS n, min(t) AS first_t FROM s WHERE regime = 'low_volume' GROUP BY 1")
def one_slice(spark, sf_dir):
    rows, root = tables.candles(spark, sf_dir), archives.scratch(spark, "slices")
    both = rows.where("volume > 200").withColumns({"regime": F.lit("high_volume"), "position": F.lit("long")})
    both = both.unionByName(rows.where("volume < 400").withColumns({"regime": F.lit("low_volume"), "position": F.lit("short")}))
    archives.write_slices(both, root)
    return archives.slices(spark, root, ["low_volume"]).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("first_t"))


@query("close_matrix", f"WITH {sql.CANDLES}, kept AS (SELECT * FROM candles WHERE t % 604800 <> 0 OR symbol <> '5-LOW'), f AS (SELECT s.symbol, x.t, k.close FROM (SELECT DISTINCT symbol FROM kept) s CROSS JOIN (SELECT DISTINCT t FROM kept) x LEFT JOIN kept k ON k.symbol = s.symbol AND k.t = x.t), g AS (SELECT symbol, t, last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY t ROWS 4 PRECEDING) AS close FROM f), e AS (SELECT symbol FROM g GROUP BY 1 HAVING 1 - count(close) / count(*) <= 0.05) SELECT symbol, t, round(close, 6) AS close FROM g JOIN e USING (symbol) WHERE close IS NOT NULL")
def close_matrix(spark, sf_dir):
    rows = tables.candles(spark, sf_dir).where("t % 604800 <> 0 or symbol <> '5-LOW'")
    return archives.close_matrix(rows).select("symbol", "t", F.round("close", 6).alias("close"))


@query("exchange_payload", f"WITH {sql.CANDLES} SELECT symbol, t, {sql.rounded('open high low close volume', 4)}, CAST(trades AS DOUBLE) AS number_of_trades FROM candles")
def exchange_payload(spark, sf_dir):
    rows = tables.candles(spark, sf_dir)
    cells = F.array((F.col("t") * 1000).cast("string"), *[F.col(c).cast("string") for c in ("open", "high", "low", "close", "volume")], ((F.col("t") + 86_400) * 1000).cast("string"), F.lit("0"), F.col("trades").cast("string"), F.lit("0"), F.lit("0"), F.lit("0"))
    sent = rows.select("symbol", F.to_json(F.array(cells)).alias("json"))
    df = sent.select("symbol", F.explode(archives.payload_rows(F.col("json"))).alias("k")).select("symbol", "k.*")
    return df.select("symbol", "t", *rounded(df, "open high low close volume", 4), "number_of_trades")


@query("pushed_candles", f"WITH {sql.CANDLES} SELECT symbol, t, {sql.rounded('open close volume', 4)}, trades AS number_of_trades, volume > 300 AS closed FROM candles")
def pushed_candles(spark, sf_dir):
    rows = tables.candles(spark, sf_dir)
    inner = F.struct((F.col("t") * 1000).alias("t"), *[F.col(c).cast("string").alias(a) for a, c in zip("ohlcv", ("open", "high", "low", "close", "volume"), strict=True)], F.lit("0").alias("q"), F.col("trades").alias("n"), (F.col("volume") > 300).alias("x"))
    df = rows.select("symbol", archives.pushed_row(F.to_json(F.struct(inner.alias("k")))).alias("k")).select("symbol", "k.*")
    return df.select("symbol", "t", *rounded(df, "open close volume", 4), "number_of_trades", "closed")


_BATCHES = """e AS (SELECT symbol, min(t) AS a, max(t) AS b FROM (SELECT symbol, t FROM bars) GROUP BY 1), b AS (SELECT 'after' AS batch, symbol, unnest([b + 3600, b + 7200]) AS t FROM e UNION ALL SELECT 'before', symbol, unnest([a - 7200, a - 3600]) FROM e UNION ALL SELECT 'gap', symbol, unnest([b + 3600, b + 10800]) FROM e UNION ALL SELECT 'off', symbol, unnest([b + 3600, b + 7201]) FROM e UNION ALL SELECT 'twice', symbol, unnest([b + 3600, b + 3600]) FROM e UNION ALL SELECT 'apart', symbol, unnest([b + 7200, b + 10800]) FROM e)"""


@query("backfill_verdicts", f"WITH {sql.uniform(HOUR)}, {_BATCHES} SELECT DISTINCT batch, symbol, CASE batch WHEN 'after' THEN 'append' WHEN 'before' THEN 'prepend' ELSE 'reject' END AS verdict FROM b")
def backfill_verdicts(spark, sf_dir):
    from .catalog import hourly

    stored = hourly(spark, sf_dir).select("symbol", "t")
    ends = stored.groupBy("symbol").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    shapes = {"after": ("b", 3600, 7200), "before": ("a", -7200, -3600), "gap": ("b", 3600, 10800), "off": ("b", 3600, 7201), "twice": ("b", 3600, 3600), "apart": ("b", 7200, 10800)}
    rows = ends.select("symbol", F.explode(F.array(*[F.struct(F.lit(n).alias("batch"), (F.col(c) + x).alias("t")) for n, (c, *xs) in shapes.items() for x in xs])).alias("r")).select("symbol", "r.*")
    return archives.backfill_verdicts(rows, stored, HOUR)


@query("narrowed_sink", f"WITH {sql.CANDLES} SELECT symbol, t, round(close, 6) AS close, round(close * 2, 6) AS \"4h_close\" FROM candles WHERE t < 820454400")
def narrowed_sink(spark, sf_dir):
    """D6, S18 to S21: rows before a limit, of allowed time frames, through a CSV sink."""
    rows = tables.candles(spark, sf_dir).select("symbol", "t", "close", (F.col("close") * 2).alias("4h_close"), (F.col("close") * 3).alias("1d_close")).where("t < 820454400")
    root = archives.scratch(spark, "narrowed")
    archives.write_csv(archives.narrowed(rows, ["4h"]), root)
    df = spark.read.schema("symbol STRING, t BIGINT, close DOUBLE, `4h_close` DOUBLE").option("header", True).csv(root)
    return df.select("symbol", "t", *rounded(df, "close 4h_close"))


@query("asset_folders", f"WITH {sql.CANDLES} SELECT symbol AS asset, count(*) AS n, CAST(sum(t) AS BIGINT) AS t_sum, round(sum(close), 2) AS closes FROM candles GROUP BY 1")
def asset_folders(spark, sf_dir):
    root = archives.scratch(spark, "assets")
    archives.write_slices(tables.candles(spark, sf_dir).withColumnRenamed("symbol", "asset"), root, ("asset",))
    return spark.read.parquet(root).groupBy("asset").agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("t_sum"), F.round(F.sum("close"), 2).alias("closes"))
