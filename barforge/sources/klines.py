"""Kline page ingest (landed exchange pages -> typed candle rows).

A page is a JSON array of 12-element positional arrays (numbers partly as
strings); an API error object ``{"code": .., "msg": ..}`` in place of a page
is an error.  Pages are landed as files under ``<root>/symbol=<SYM>/``; the
symbol comes from the partition directory.  The reader keeps rows in
``[start, end)`` and de-duplicates ``(symbol, open_time)`` keeping the row
of the latest page (file name order, then place in the file, then position inside the page).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.functions.intervals import ingest_step_ms
from barforge.operators.clean import dedup_last
from barforge.sources.files import string_symbols
from barforge.sources.schema import PAGE_FIELDS, RAW_COLUMNS

MAX_LIMIT = 1000  # rows per page of the kline endpoint

_PAGE_TYPE = "array<array<string>>"


def _typed(r) -> list:
    out = [F.upper(F.col("symbol")).alias("symbol")]
    for i, name in enumerate(PAGE_FIELDS):
        if name == "_ignore":
            continue
        e = r[i]
        if name in ("open_time", "close_time"):
            out.append(F.timestamp_millis(e.cast("long")).alias(name))
        elif name == "trades":
            out.append(e.cast("long").alias(name))
        else:
            out.append(e.cast("double").alias(name))
    return out


def read_kline_pages(spark: SparkSession, root: str, start=None, end=None,
                     whole_files: bool = True) -> DataFrame:
    """Typed candles from landed pages.  ``whole_files``: one page per file
    (as returned by the endpoint); otherwise one page per line."""
    reader = spark.read.option("wholetext", True) if whole_files else spark.read
    raw = string_symbols(reader.text(root), reader, lambda r: r.text(root)).withColumn("_file", F.col("_metadata.file_path"))
    if "symbol" not in raw.columns:
        raise ValueError("pages must be landed under symbol=<SYM>/ directories")
    # a file's splits come in the order of their starts, and the lines of a split are numbered upwards by the task that reads it
    raw = raw.withColumn("_line", F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("nth")))
    err = F.get_json_object(F.col("value"), "$.code")
    checked = raw.withColumn(
        "value", F.when(err.isNotNull(), F.raise_error(F.concat(F.lit("exchange error page: "), F.col("value"))))
        .otherwise(F.col("value")))
    page = F.from_json(F.col("value"), _PAGE_TYPE)
    broken = F.raise_error(F.concat(F.lit("page is not a JSON array of candles: "), F.col("_file")))
    page = F.when((F.trim("value") != "") & page.isNull(), broken.cast(_PAGE_TYPE)).otherwise(page)
    rows = checked.select("symbol", "_file", "_line", F.posexplode(page).alias("_pos", "r"))
    typed = rows.select(*_typed(F.col("r")), "_file", "_line", "_pos")
    if start is not None:
        typed = typed.filter(F.col("open_time") >= F.lit(start))
    if end is not None:
        typed = typed.filter(F.col("open_time") < F.lit(end))
    typed = typed.withColumn("_ingest_seq", F.struct("_file", "_line", "_pos"))
    out = dedup_last(typed, keys=("symbol", "open_time"), order=[F.col("_ingest_seq").desc()])
    return out.select(*RAW_COLUMNS)


def write_kline_pages(bars: DataFrame, root: str, interval: str = "1m", again: DataFrame | None = None) -> None:
    """Land candles as exchange-style pages (one page of at most
    ``MAX_LIMIT`` steps per line, partitioned by symbol, compressed).  Used to build
    ingest fixtures from the test tables.  ``again``: candles whose pages
    follow a symbol's other pages in the same file."""
    rows = bars.withColumn("_pass", F.lit(0))
    if again is not None:
        rows = rows.unionByName(again.withColumn("_pass", F.lit(1)))
    step_ms = ingest_step_ms(interval) if interval in ("1m", "3m", "5m", "15m", "30m", "1h") else None
    own = ["open_time", *(name for name in PAGE_FIELDS if name not in ("open_time", "_ignore"))]
    # a symbol's pages are one file: its candles are dealt once, as numbers, and become text where the pages are made
    rows = rows.select("symbol", "_pass", *own).repartition("symbol")
    ms = F.unix_millis(F.col("open_time").cast("timestamp"))
    page = F.floor(ms / F.lit((step_ms or 86_400_000) * MAX_LIMIT))

    def text(c: str) -> Column:
        return (F.unix_millis(F.col(c).cast("timestamp")) if c in ("open_time", "close_time") else F.col(c)).cast("string")

    arr = F.array(*[F.lit("0") if c == "_ignore" else text(c) for c in PAGE_FIELDS])
    pages = (rows.select("symbol", "_pass", page.alias("_page"), ms.alias("_ms"), arr.alias("_r"))
             .groupBy("symbol", "_pass", "_page")
             .agg(F.sort_array(F.collect_list(F.struct("_ms", "_r"))).alias("_rows"))
             .select("symbol", "_pass", "_page", F.to_json(F.transform("_rows", lambda s: s["_r"])).alias("value")))
    (pages.sortWithinPartitions("symbol", "_pass", "_page")
     .select("symbol", "value").write.mode("overwrite").option("compression", "gzip").partitionBy("symbol").text(root))
