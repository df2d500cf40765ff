"""String functions (F11–F16) and report labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from marketframe import config as C


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def raw_symbol(ticker) -> Column:
    """F11 concat('BINANCE:', ticker, 'USDT')."""
    return F.concat(F.lit(C.SYMBOL_PREFIX), _c(ticker), F.lit(C.SYMBOL_SUFFIX))


def ticker_of(raw) -> Column:
    """F12 regex capture of the ticker inside a raw feed symbol."""
    return F.regexp_extract(_c(raw), C.TICKER_PATTERN, 1)


def model_base_name(name, marker: str = "-ETH") -> Column:
    """F13 text before the marker; the whole name when the marker is absent."""
    return F.substring_index(_c(name), marker, 1)


def join_messages(*msgs) -> Column:
    """F16 '; '.join of the non-NULL messages, in argument order."""
    return F.concat_ws("; ", *[_c(m) for m in msgs])


def strategy_group(name) -> Column:
    """P14 dashboard grouping key."""
    return F.when(_c(name).startswith("Long"), F.lit("Long Only")).otherwise(F.lit("ML Strategies"))
