"""Bar adapters over the driver's test tables (not reference operators).

``hourly_bars``: events -> one bar per (event_type, hour).
``supplier_bars``: lineitem -> one daily bar per (supplier, ship date).
The bar key spreads over time, so no symbol is a hot group here; only where no
supplier has many lines are they dealt by supplier alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HOUR = "1h"
DAY = "1d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hourly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    even = (F.col("user_id") % 2) == 0
    return (
        ev.groupBy(F.col("event_type").alias("symbol"),
                   F.date_trunc("hour", F.col("ts")).alias("open_time"))
        .agg(
            F.min_by("value", "ts").alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", "ts").alias("close"),
            F.count(F.lit(1)).cast("double").alias("volume"),
            F.sum("value").alias("quote_volume"),
            F.count(F.lit(1)).alias("trades"),
            F.count(F.when(even, 1)).cast("double").alias("taker_buy_base"),
            F.coalesce(F.sum(F.when(even, F.col("value"))), F.lit(0.0)).alias("taker_buy_quote"),
        )
        .withColumn("close_time", F.col("open_time") + F.expr("INTERVAL 3599.999 SECONDS"))
        .select("symbol", "open_time", "open", "high", "low", "close", "volume",
                "close_time", "quote_volume", "trades", "taker_buy_base", "taker_buy_quote")
    )


def _supplier() -> Column:
    return F.concat(F.lit("S"), F.lpad(F.col("l_suppkey").cast("string"), 5, "0"))


#: Lines of a task that makes the bars of whole suppliers: enough of them, and what none should exceed by far.
TASK_LINES, MOST_LINES = 1 << 17, 1 << 21


def _tasks(spark: SparkSession, lines: int) -> int:
    """Tasks to which ``lines`` are dealt.  Up to a limit of Spark's they are written as they come; beyond it they are sorted
    by task first, and spilled for that."""
    unsorted = int(spark.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    return max(spark.sparkContext.defaultParallelism, min(unsorted, -(-lines // TASK_LINES)), -(-lines // MOST_LINES))


def supplier_lines(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """The number of lines, and that of the supplier with most of them (none has more bars): a pass over one column."""
    counts = table(spark, sf_dir, "lineitem").groupBy(_supplier().alias("symbol")).agg(F.count(F.lit(1)).alias("n"))
    found = counts.agg(F.sum("n").alias("lines"), F.max("n").alias("most")).first()
    return found.lines or 0, found.most or 0


def supplier_bars(spark: SparkSession, sf_dir: str, lines: int | None = None) -> DataFrame:
    """``lines``: their number, to deal them by supplier alone, to as many tasks as they need: what works on series of
    few bars then has them where they lie."""
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    taker = F.col("l_returnflag") == "N"
    rows = li.select(_supplier().alias("symbol"), F.col("l_shipdate").alias("open_time"), "l_quantity", *order, taker.alias("taker"))
    # few lines share a supplier and a day: they are dealt as they are, which is less than the groups' first and last ones
    if lines is None:
        rows = rows.repartition("symbol", "open_time")
    else:
        rows = rows.repartition(_tasks(spark, lines), "symbol")
    # a bar's first and last lines are marked in sorted rows, so that its aggregates are plain numbers
    bar = Window.partitionBy("symbol", "open_time").orderBy(*order)
    rows = rows.select("symbol", "open_time", price.alias("price"), "taker", "l_quantity", "l_extendedprice",
                       (F.row_number().over(bar) == 1).alias("first"), F.lead(F.lit(1)).over(bar).isNull().alias("last"))
    return (
        rows.groupBy("symbol", "open_time")
        .agg(
            F.max(F.when(F.col("first"), F.col("price"))).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max(F.when(F.col("last"), F.col("price"))).alias("close"),
            F.sum("l_quantity").alias("volume"),
            F.sum("l_extendedprice").alias("quote_volume"),
            F.count(F.lit(1)).alias("trades"),
            F.coalesce(F.sum(F.when(F.col("taker"), F.col("l_quantity"))), F.lit(0.0)).alias("taker_buy_base"),
            F.coalesce(F.sum(F.when(F.col("taker"), F.col("l_extendedprice"))), F.lit(0.0)).alias("taker_buy_quote"),
        )
        .withColumn("close_time", F.col("open_time") + F.expr("INTERVAL 86399.999 SECONDS"))
        .select("symbol", "open_time", "open", "high", "low", "close", "volume",
                "close_time", "quote_volume", "trades", "taker_buy_base", "taker_buy_quote")
    )


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> one bar per ship date, of no symbol."""
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return (li.select(F.col("l_shipdate").alias("open_time"), price.alias("price"), "l_quantity").groupBy("open_time")
            .agg(F.min("price").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
                 F.max("price").alias("close"), F.sum("l_quantity").alias("volume"), F.count(F.lit(1)).alias("trades"))
            .withColumn("symbol", F.lit(None).cast("string"))
            .withColumn("close_time", F.col("open_time") + F.expr("INTERVAL 86399.999 SECONDS")))


def rising_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> one bar per return flag and ship date; the close is the
    quantity shipped up to then, after a first bar far above it: one fall, then none."""
    days = (table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("symbol"), F.col("l_shipdate").alias("open_time"))
            .agg(F.sum("l_quantity").alias("volume"), F.count(F.lit(1)).alias("trades")))
    order = Window.partitionBy("symbol").orderBy("open_time")
    first = F.when(F.row_number().over(order) == 1, F.lit(1e6)).otherwise(F.lit(0.0))
    close = F.sum("volume").over(order) + first
    bars = days.withColumn("close", close)
    return (bars.withColumns({c: F.col("close") for c in ("open", "high", "low")})
            .withColumn("close_time", F.col("open_time") + F.expr("INTERVAL 86399.999 SECONDS")))


# DuckDB text of the same adapters (used by the oracle SQL).
HOURLY_BARS_SQL = """
SELECT event_type AS symbol, date_trunc('hour', ts) AS open_time,
       arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
       arg_max(value, ts) AS close, count(*)::DOUBLE AS volume,
       date_trunc('hour', ts) + INTERVAL 3599999 MILLISECOND AS close_time,
       sum(value) AS quote_volume, count(*)::BIGINT AS trades,
       count(*) FILTER (WHERE user_id % 2 = 0)::DOUBLE AS taker_buy_base,
       coalesce(sum(value) FILTER (WHERE user_id % 2 = 0), 0.0) AS taker_buy_quote
FROM events GROUP BY 1, 2
"""

SUPPLIER_BARS_SQL = """
SELECT 'S' || lpad(l_suppkey::VARCHAR, 5, '0') AS symbol, l_shipdate AS open_time,
       arg_min(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS open,
       max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
       arg_max(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS close,
       sum(l_quantity) AS volume,
       l_shipdate + INTERVAL 86399999 MILLISECOND AS close_time,
       sum(l_extendedprice) AS quote_volume, count(*)::BIGINT AS trades,
       coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'N'), 0.0) AS taker_buy_base,
       coalesce(sum(l_extendedprice) FILTER (WHERE l_returnflag = 'N'), 0.0) AS taker_buy_quote
FROM lineitem GROUP BY 1, 2, l_shipdate
"""

DAILY_BARS_SQL = """
SELECT NULL::VARCHAR AS symbol, l_shipdate AS open_time, min(l_extendedprice / l_quantity) AS open,
       max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
       max(l_extendedprice / l_quantity) AS close, sum(l_quantity) AS volume,
       l_shipdate + INTERVAL 86399999 MILLISECOND AS close_time, NULL::DOUBLE AS quote_volume, count(*)::BIGINT AS trades,
       NULL::DOUBLE AS taker_buy_base, NULL::DOUBLE AS taker_buy_quote
FROM lineitem GROUP BY l_shipdate
"""

RISING_BARS_SQL = """
SELECT symbol, open_time, c AS open, c AS high, c AS low, c AS close, volume,
       open_time + INTERVAL 86399999 MILLISECOND AS close_time, NULL::DOUBLE AS quote_volume, trades,
       NULL::DOUBLE AS taker_buy_base, NULL::DOUBLE AS taker_buy_quote
FROM (SELECT *, sum(volume) OVER (PARTITION BY symbol ORDER BY open_time)
             + CASE WHEN row_number() OVER (PARTITION BY symbol ORDER BY open_time) = 1 THEN 1e6 ELSE 0.0 END AS c
      FROM (SELECT l_returnflag AS symbol, l_shipdate AS open_time, sum(l_quantity) AS volume, count(*)::BIGINT AS trades
            FROM lineitem GROUP BY 1, 2))
"""
