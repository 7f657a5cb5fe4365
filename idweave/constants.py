"""Fixed values the results depend on.

Fixed values: these must stay as written for the results to be right.
"""

# Allocation security types kept, and the status kept.
ALLOCATION_TYPES = ("ADR", "COM", "GDR", "MFC", "MFO", "PFD")
ALLOCATION_STATUS = "ACCT"

# Local-ticker rule per currency. The pattern is one suffix
# token anchored at the end of the ticker; it is removed and the exchange
# code appended.
TICKER_RULES = {
    "THB": ("/F$", " TB"),
    "AUD": ("(ZZ|BB|YY|XX\\*?|0A|0B|O|DA|-W)$", " AU"),
}

# Request prefixes of the symbol lookup.
PREFIX_SEDOL = "SED"
PREFIX_TICKER = "BTKR"

# Day bounds of a request window, and the snapshot date of a SQL
# relation that is given none.
DAY_START = "00:00"
DAY_END = "23:59"
DEFAULT_SNAPSHOT_DATE = "2025-01-01"

# Deduplication keys: the newest cut uses three, the earlier cuts two.
DEDUP_KEYS_3 = ("sec_id", "trade_date_est", "trade_date_local")
DEDUP_KEYS_2 = ("sec_id", "trade_date_est")

# Identifier columns taken from the security snapshot.
SECURITY_COLUMNS = ("ext_sec_id", "sedol", "cusip", "isin_no", "ticker", "sec_currency")

# Underlying identifiers taken from the equity / fund reference files:
# (reference column, output column).
UNDERLYING_COLUMNS = (
    ("parent_id_undr", "underlying_parent_id"),
    ("sedol_id", "underlying_sedol"),
    ("ticker", "underlying_ticker"),
    ("isin_id", "underlying_isin"),
)

# Identifiers whose absence is audited: rows that lack all of the first, or
# any of the second.
AUDIT_ALL = ("ext_sec_id", "sedol", "cusip", "isin_no", "ticker")
AUDIT_ANY = ("ext_sec_id", "sedol", "ticker")

# Schema of the equity / fund reference files when they arrive as CSV.
REFERENCE_SCHEMA = ("sec_id STRING, file_eff_dt INT, parent_id_undr STRING, sedol_id STRING, "
                    "ticker STRING, isin_id STRING")
