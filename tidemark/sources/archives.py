"""Archives of files: trees of candles, days of ticks, slices of panels; strict and tolerant scans, and sinks.

Paths are Hadoop paths: listing and tests for existence go through Spark's file systems, so any store works that Spark reads.
A tree is partitioned by folders (`symbol=...`, `tf=...`, `date=...`), and filters on these reach the file listing.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import windows as W

TRADES = "us BIGINT, seq BIGINT, side STRING, price DOUBLE, amount DOUBLE"
QUOTES = "us BIGINT, seq BIGINT, bid DOUBLE, ask DOUBLE, bid_size DOUBLE, ask_size DOUBLE"
TICKERS = "us BIGINT, seq BIGINT, mark_price DOUBLE, index_price DOUBLE, open_interest DOUBLE, funding_rate DOUBLE"
BOOKS = "us BIGINT, seq BIGINT, " + ", ".join(f"bids_{i}_qty DOUBLE, asks_{i}_qty DOUBLE" for i in range(5))
STREAMS = {"trades": TRADES, "book_ticker": QUOTES, "book_snapshot": BOOKS, "derivative_ticker": TICKERS, "liquidations": TRADES}
#: Columns of candle files, and the order of the fields in an exchange's payload.
REQUIRED = ("open", "high", "low", "close", "volume")
OPTIONAL = ("quote_volume", "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume")
PAYLOAD = ("open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume", "ignore")
FILE = re.compile(r"([^/]+)$")


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares; on one machine without such a folder, in a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Scans


def stream(spark: SparkSession, root: str, name: str, dates: Iterable[str] | None = None, strict: bool = False) -> DataFrame:
    """Ticks of one stream under root/<stream>/date=.../symbol=.../*.csv(.gz), with date and symbol.

    A stream that is not there is an empty table, or an error if strict. Broken lines fail the scan.
    """
    path, schema = f"{root}/{name}", STREAMS[name] + ", date STRING, symbol STRING"
    if not exists(spark, path):
        if strict:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    return rows if dates is None else rows.where(F.col("date").isin(*dates))


def day(spark: SparkSession, root: str, date: str, streams: Iterable[str] = tuple(STREAMS), strict: bool = False) -> dict[str, DataFrame]:
    """All streams of one day; only that day's folders are read."""
    return {name: stream(spark, root, name, [date], strict) for name in streams}


def available_dates(rows: DataFrame, first: str, last: str) -> DataFrame:
    """date, available for each day from first to last (YYYYMMDD)."""
    ends = [F.to_date(F.lit(x), "yyyyMMdd") for x in (first, last)]
    days = rows.sparkSession.range(1).select(F.explode(F.sequence(*ends)).alias("d")).select(F.date_format("d", "yyyyMMdd").alias("date"))
    there = rows.select("date").distinct().withColumn("available", F.lit(True))
    return days.join(there, "date", "left").select("date", F.coalesce("available", F.lit(False)).alias("available"))


def keep_one(rows: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], last: bool = True) -> DataFrame:
    """Of rows with equal keys the last (or first) by order."""
    by = [F.desc(c) if last else F.asc(c) for c in order]
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where("__n = 1").drop("__n")


def normal_candles(files: DataFrame) -> DataFrame:
    """symbol, t and the columns of candle files as doubles; of rows with one time the one in the later file, or further down, counts.

    Optional columns that the files lack are left out; required ones must be there.
    """
    missing = [c for c in ("open_time_ms", *REQUIRED) if c not in files.columns]
    if missing:
        raise ValueError(f"candle files lack the columns {missing}")
    kept = [c for c in (*REQUIRED, *OPTIONAL) if c in files.columns]
    ordered = files.select("symbol", F.floor(F.col("open_time_ms") / 1000).cast("long").alias("t"), *[F.col(c).cast("double").alias(c) for c in kept], F.col("_metadata.file_name").alias("__f"), F.monotonically_increasing_id().alias("__r"))
    return keep_one(ordered, ("symbol", "t"), ("__f", "__r")).drop("__f", "__r")


def candle_tree(spark: SparkSession, root: str, symbols: Iterable[str] | None = None, form: str = "parquet", strict: bool = True) -> DataFrame:
    """Candles under root/symbol=.../<files>. strict: each symbol asked for must be there and every file be read whole.

    Otherwise broken files and lines are passed over, and symbols without files are absent.
    """
    reader = spark.read
    if form == "csv":
        reader = reader.option("header", True).option("inferSchema", True).option("mode", "FAILFAST" if strict else "DROPMALFORMED")
    if not strict:
        reader = reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    files = reader.format(form).load(root).withColumn("symbol", F.col("symbol").cast("string"))
    if symbols is not None:
        asked = sorted(set(symbols))
        files = files.where(F.col("symbol").isin(*asked))
        if strict:
            there = {r["symbol"] for r in files.select("symbol").distinct().collect()}  # at most the symbols asked for
            if lost := [s for s in asked if s not in there]:
                raise FileNotFoundError(f"no candle files of {lost} under {root}")
    return normal_candles(files)


def framed_candles(spark: SparkSession, root: str, frames: Iterable[str], first: str | None = None, last: str | None = None) -> DataFrame:
    """Bars under root/tf=.../date=YYYYMMDD/, of the given time frames and of the days from first to last; each frame must be there."""
    if lost := [tf for tf in frames if not exists(spark, f"{root}/tf={tf}")]:
        raise FileNotFoundError(f"no bars of {lost} under {root}")
    rows = spark.read.option("basePath", root).parquet(*[f"{root}/tf={tf}" for tf in frames])
    rows = rows.withColumn("date", F.col("date").cast("string"))
    if first is not None:
        rows = rows.where(F.col("date") >= first)
    return rows if last is None else rows.where(F.col("date") <= last)


def slices(spark: SparkSession, root: str, names: Iterable[str] | None = None, keys: tuple[str, ...] = ("t", "symbol")) -> DataFrame:
    """Slices of a panel as written by `write_slices`, one row for each key: the first by regime and position."""
    rows = spark.read.parquet(root)
    rows = rows if names is None else rows.where(F.col("regime").isin(*names))
    return keep_one(rows, keys, ("regime", "position"), last=False)


def close_matrix(candles: DataFrame, limit: int = 4, most_missing: float = 0.05) -> DataFrame:
    """symbol, t, close on all times of any symbol: gaps of up to `limit` rows are filled, symbols that lack more are left out, and so are times without a close."""
    times = candles.select("t").distinct()
    symbols = candles.select("symbol").distinct()
    # As many rows as times and symbols have pairs: the matrix itself.
    full = times.join(symbols, F.lit(True)).join(candles.select("symbol", "t", "close"), ["symbol", "t"], "left")
    filled = full.withColumn("close", W.fill_forward(F.col("close"), W.series(), limit))
    enough = filled.groupBy("symbol").agg((1 - F.count("close") / F.count(F.lit(1))).alias("missing")).where(F.col("missing") <= most_missing).select("symbol")
    return filled.join(enough, "symbol", "left_semi").where("close is not null").select("symbol", "t", "close")


def payload_rows(json: Column) -> Column:
    """An exchange's array of candles, each an array of twelve fields as text, as an array of structs of the nine that matter."""
    cells = F.from_json(json, "array<array<string>>")
    of = {name: i for i, name in enumerate(PAYLOAD)}
    number = lambda row, name: F.get(row, F.lit(of[name])).cast("double").alias(name)
    return F.transform(cells, lambda row: F.struct(F.floor(F.get(row, F.lit(0)).cast("bigint") / 1000).cast("long").alias("t"), *[number(row, c) for c in ("open", "high", "low", "close", "volume", "quote_volume", "number_of_trades", "taker_buy_quote_volume")]))


def pushed_row(json: Column) -> Column:
    """A pushed candle ({"k": {t, o, h, l, c, v, q, n, Q, x}}) as one struct; closed says whether the bar has ended."""
    at = lambda field: F.get_json_object(json, f"$.k.{field}")  # noqa: E731  q and Q are two fields
    return F.struct(F.floor(at("t").cast("bigint") / 1000).cast("long").alias("t"), *[at(a).cast("double").alias(b) for a, b in zip("ohlcvq", ("open", "high", "low", "close", "volume", "quote_volume"), strict=True)], at("n").cast("bigint").alias("number_of_trades"), at("x").cast("boolean").alias("closed"))


def backfill_verdicts(batches: DataFrame, stored: DataFrame, seconds: int) -> DataFrame:
    """batch, symbol, verdict: append or prepend if a batch's bars lie on the grid without gaps or repeats and join the stored ones, else reject."""
    inside = batches.groupBy("batch", "symbol").agg(
        F.min("t").alias("a"), F.max("t").alias("b"), F.count(F.lit(1)).alias("n"), F.countDistinct("t").alias("d"), F.max(F.pmod("t", F.lit(seconds))).alias("off"),
    )
    ends = stored.groupBy("symbol").agg(F.min("t").alias("first"), F.max("t").alias("last"))
    whole = (F.col("off") == 0) & (F.col("n") == F.col("d")) & (F.col("b") - F.col("a") == (F.col("n") - 1) * seconds)
    verdict = F.when(whole & (F.col("last").isNull() | (F.col("a") == F.col("last") + seconds)), "append").when(whole & (F.col("b") == F.col("first") - seconds), "prepend").otherwise("reject")
    return inside.join(ends, "symbol", "left").select("batch", "symbol", verdict.alias("verdict"))


# Sinks


def write_slices(rows: DataFrame, path: str, by: tuple[str, ...] = ("regime", "position")) -> None:
    """One folder for each value of `by`, zstd, rows of a folder together in few files; the job commits all or nothing."""
    rows.repartition(*by).write.partitionBy(*by).option("compression", "zstd").mode("errorifexists").parquet(path)


def write_stream(ticks: DataFrame, path: str) -> None:
    """Ticks as gzipped CSV under date=.../symbol=.../."""
    date = F.date_format(F.timestamp_seconds(F.floor(F.col("us") / 1_000_000)), "yyyyMMdd")
    ticks.withColumn("date", date).repartition("date", "symbol").sortWithinPartitions("date", "symbol", "us", "seq").write.partitionBy("date", "symbol").option("header", True).option("compression", "gzip").csv(path)


def write_csv(rows: DataFrame, path: str, wanted: bool = True) -> bool:
    """A table as CSV with a header, if wanted."""
    if wanted:
        rows.write.option("header", True).mode("errorifexists").csv(path)
    return wanted


def narrowed(rows: DataFrame, frames: Iterable[str], protected: Iterable[str] = ("symbol", "t")) -> DataFrame:
    """Only columns without a time frame, those of the frames allowed, and the protected ones; a frame without columns is an error."""
    frames, protected = list(frames), set(protected)
    prefix = re.compile(r"^(\d+[smhd])_")
    found = {c: m[1] for c in rows.columns if (m := prefix.match(c))}
    if lost := [f for f in frames if f not in found.values()]:
        raise ValueError(f"no columns of the time frames {lost}")
    return rows.select(*[c for c in rows.columns if c in protected or found.get(c) is None or found[c] in frames])
