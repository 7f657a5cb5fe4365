"""Local-ticker symbols, driven by the rule table in ``constants.TICKER_RULES``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_ticker(ticker: Column, currency: Column, rules: dict, mode: str = "always"):
    """Return ``(symbol, base)`` columns for the currencies in ``rules``.

    ``always``: strip one suffix token at the end, then append the exchange
    code with one space (``BHPZZ`` -> ``BHP AU``, ``BHP`` -> ``BHP AU``).
    ``matched``: only a ticker that ends in a token is rewritten; others are
    left as they are (``BHP`` -> ``BHP``). Other currencies give the ticker.
    """
    if mode not in ("always", "matched"):
        raise ValueError(f"unknown ticker mode {mode!r}")
    base = symbol = None
    for cur, (pattern, code) in rules.items():
        is_cur = currency == F.lit(cur)
        stripped = F.regexp_replace(ticker, F.lit(pattern), F.lit(""))
        if mode == "always":
            b, s = stripped, F.concat(stripped, F.lit(code))
        else:
            hit = ticker.rlike(pattern)
            b = F.when(hit, stripped).otherwise(ticker)
            s = F.when(hit, F.concat(stripped, F.lit(code))).otherwise(ticker)
        base = F.when(is_cur, b) if base is None else base.when(is_cur, b)
        symbol = F.when(is_cur, s) if symbol is None else symbol.when(is_cur, s)
    return symbol.otherwise(ticker), base.otherwise(ticker)
