"""Places used when a query result is compared with the SQL oracle.

Values computed by different summation orders (sliding sums, the blocked
EWM scan, variance) differ in the last bits; the places below are chosen per
column family so that such noise is far below the rounding step for the
magnitudes of the test data.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

#: Binary places start here: BINARY + 12 stands for multiples of 2^-12.  A mean of decimal prices never lies
#: halfway between two of them, while it often does between two decimal steps, where the order of summation decides.
BINARY = 100

# ---- fixed values: rounding per column family (regex -> places) -----
RULES: list[tuple[str, int]] = [
    (r"^(ret_simple|ret_log|hl_spread|taker_buy_ratio|taker_buy_quote_ratio|target_ret_\d+)$", 8),
    (r"^(bb_percent_b|rsi_\d+|vol_logret_\d+)$", 6),
    (r"^(sma|bb_mid)_.*$", BINARY + 14),
    (r"^(ema|bb_up|bb_low|atr|macd)_.*$|^macd_hist$", 3),
    (r"^(vol_roll_std|trades_roll_std)_\d+$", 4),
    (r"^(vol_sma|vol_roll_mean|trades_roll_mean|dollar_vol_roll_mean)_\d+$", 6),
    (r"^(mean|scale)$", 3),
]
DEFAULT = 6
SCALED = 6


def digits(name: str, scaled: bool = False) -> int:
    if scaled:
        return SCALED
    for pat, d in RULES:
        if re.match(pat, name):
            return d
    return DEFAULT


def rnd_sql(expr: str, d: int) -> str:
    """Half-away-from-zero rounding, the same text in both engines, so equal
    doubles round equally (their ``round`` differs on exact decimal ties)."""
    # floor() is a BIGINT in Spark; doubles of 2^52 and more have no fraction
    scale = repr(float(10 ** d if d < BINARY else 2 ** (d - BINARY)))
    whole = f"sign({expr}) * floor(abs({expr}) * {scale} + 0.5) / {scale}"
    return f"(CASE WHEN abs({expr}) * {scale} < 4503599627370496.0 THEN {whole} ELSE {expr} END)"


def round_frame(df: DataFrame, scaled: set[str] | None = None) -> DataFrame:
    scaled = scaled or set()
    out = []
    for name, typ in df.dtypes:
        if typ == "double":
            out.append(f"{rnd_sql(f'`{name}`', digits(name, name in scaled))} AS `{name}`")
        else:
            out.append(f"`{name}`")
    return df.selectExpr(*out)


def round_sql(cols: list[str], doubles: set[str], scaled: set[str] | None = None) -> str:
    scaled = scaled or set()
    parts = []
    for c in cols:
        if c in doubles:
            parts.append(f"{rnd_sql(c, digits(c, c in scaled))} AS {c}")
        else:
            parts.append(c)
    return ", ".join(parts)
