"""barforge: candlestick (OHLCV) cleaning, indicators, targets and ML
dataset assembly as Spark DataFrame jobs.

Every operator is a DataFrame -> DataFrame function (usable with
``DataFrame.transform``) or a column expression; nothing is computed on the
driver except small, size-bounded decisions (split cut
points).
"""

from barforge.config import WindowsConfig, Layout

__all__ = ["WindowsConfig", "Layout"]
