"""Raw candle schema (fixed column names and order)."""

# ---- fixed values: raw candle columns, in order ------------------------------
RAW_COLUMNS = [
    "symbol", "open_time", "open", "high", "low", "close", "volume",
    "close_time", "quote_volume", "trades", "taker_buy_base", "taker_buy_quote",
]
# ---- fixed values: kline page positions 0..11 (11 is ignored) ----------------
PAGE_FIELDS = [
    "open_time", "open", "high", "low", "close", "volume", "close_time",
    "quote_volume", "trades", "taker_buy_base", "taker_buy_quote", "_ignore",
]
# numeric columns coerced on load (trades is not among them)
NUMERIC_COLUMNS = ["open", "high", "low", "close", "volume", "quote_volume",
                   "taker_buy_base", "taker_buy_quote"]
