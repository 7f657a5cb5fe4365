"""DuckDB oracle text for each registered query, written from the semantics.

Each text carries the fixture views it needs as CTEs (``oracle_fixtures``)
and states the operator in plain SQL: correlated subqueries for as-of
lookups, ``ROW_NUMBER``/``DENSE_RANK`` windows for ids, ``QUALIFY``-free
dedup, and so on.
"""

from __future__ import annotations

import re

from .oracle_fixtures import with_views

ALLOC_COLS = ("order_id, line_no, acct_id, gross, sec_id, sec_typ_cd, status, "
              "trade_date_local, trade_date_est")

FILTERED = """
filtered AS (
  SELECT * FROM allocations
  WHERE sec_typ_cd IN ('ADR', 'COM', 'GDR', 'MFC', 'MFO', 'PFD') AND status = 'ACCT'
)"""


def _dedup(name: str, keys: str, tie: str) -> str:
    return f"""
{name} AS (
  SELECT {ALLOC_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {tie}) AS rn FROM filtered
  ) x WHERE rn = 1
)"""


DEDUP3 = _dedup("dedup", "sec_id, trade_date_est, trade_date_local", "order_id, line_no, acct_id, gross")
DEDUP2 = _dedup("dedup2", "sec_id, trade_date_est", "order_id, line_no, acct_id, gross")

IDED = """
ided AS (
  SELECT CAST(row_number() OVER (ORDER BY sec_id, trade_date_est, trade_date_local) AS BIGINT)
           AS DATA_ID, *
  FROM dedup
)"""

# ids given in two runs: the trades before 1998 in the first
IDED_RUNS = """
ided AS (
  SELECT CAST(row_number() OVER (ORDER BY trade_date_local >= DATE '1998-01-01', sec_id, trade_date_est,
                                          trade_date_local) AS BIGINT) AS DATA_ID, *
  FROM dedup
)"""

IDED2 = """
ided AS (
  SELECT CAST(row_number() OVER (ORDER BY sec_id, trade_date_est) AS BIGINT) AS DATA_ID, *
  FROM dedup2
)"""

PREV = """
prev_all AS (
  SELECT i.*, (SELECT max(s.datadate) FROM snapshot_dates s
               WHERE s.datadate < i.trade_date_est) AS snapshot_date
  FROM ided i
),
prev AS (SELECT * FROM prev_all WHERE snapshot_date IS NOT NULL)"""

PREV_BY_SEC = """
prev AS (
  SELECT * FROM (
    SELECT i.*, (SELECT max(s.datadate) FROM securities s
                 WHERE s.sec_id = CAST(i.sec_id AS VARCHAR)
                   AND s.datadate < i.trade_date_est) AS snapshot_date
    FROM ided i) x
  WHERE snapshot_date IS NOT NULL
)"""

SNAP = """
snap AS (
  SELECT p.*, s.ext_sec_id, s.sedol, s.cusip, s.isin_no, s.ticker, s.sec_currency
  FROM prev p
  LEFT JOIN securities s ON s.sec_id = CAST(p.sec_id AS VARCHAR) AND s.datadate = p.snapshot_date
)"""


def _ref(name: str, src: str, offset: int = 1) -> str:
    return f"""
{name} AS (
  SELECT sec_id, file_eff_dt, parent_id_undr, sedol_id, ticker, isin_id,
         CAST(try_strptime(CAST(file_eff_dt AS VARCHAR), '%Y%m%d') AS DATE) - ({offset})
           AS match_date
  FROM {src}
)"""


REFS = _ref("eq", "ref_equity") + "," + _ref("fu", "ref_fund")
REFS_PREV_DAY = _ref("eq", "ref_equity", -1) + "," + _ref("fu", "ref_fund", -1)


def _enrich(name: str, base: str, key: str, date: str, cols: str) -> str:
    return f"""
{name} AS (
  SELECT {cols},
         coalesce(e.parent_id_undr, f.parent_id_undr) AS underlying_parent_id,
         coalesce(e.sedol_id, f.sedol_id) AS underlying_sedol,
         coalesce(e.ticker, f.ticker) AS underlying_ticker,
         coalesce(e.isin_id, f.isin_id) AS underlying_isin,
         e.file_eff_dt AS equity_file_eff_dt, e.match_date AS equity_file_eff_dt_minus1,
         f.file_eff_dt AS fund_file_eff_dt, f.match_date AS fund_file_eff_dt_minus1
  FROM {base} n
  LEFT JOIN eq e ON e.sec_id = CAST(n.{key} AS VARCHAR) AND e.match_date = n.{date}
  LEFT JOIN fu f ON f.sec_id = CAST(n.{key} AS VARCHAR) AND f.match_date = n.{date}
)"""


ENRICHED = _enrich("enriched", "snap", "sec_id", "trade_date_est", "n.*")

SED_REQ = """
sed_req AS (
  SELECT DATA_ID, 'SED' AS prefix, sec_id, sec_currency AS currency, ticker, sedol,
         CAST(trade_date_local AS TIMESTAMP) AS order_start_date,
         CAST(trade_date_local AS TIMESTAMP) + INTERVAL '23 hours 59 minutes' AS order_end_date,
         trade_date_local AS sym_date, sedol AS SYMBOL_NAME,
         CAST(NULL AS VARCHAR) AS SYMBOL_NAME_BASE, 'historic' AS process_type
  FROM enriched
)"""

AUD_RE = "(ZZ|BB|YY|XX\\*?|0A|0B|O|DA|-W)$"


def _tick_req(name: str, mode: str) -> str:
    if mode == "always":
        base = (f"CASE WHEN sec_currency = 'THB' THEN regexp_replace(ticker, '/F$', '') "
                f"ELSE regexp_replace(ticker, '{AUD_RE}', '') END")
        sym = f"({base}) || CASE WHEN sec_currency = 'THB' THEN ' TB' ELSE ' AU' END"
    else:
        thb = "sec_currency = 'THB' AND regexp_matches(ticker, '/F$')"
        aud = f"sec_currency = 'AUD' AND regexp_matches(ticker, '{AUD_RE}')"
        base = (f"CASE WHEN {thb} THEN regexp_replace(ticker, '/F$', '') "
                f"WHEN {aud} THEN regexp_replace(ticker, '{AUD_RE}', '') ELSE ticker END")
        sym = (f"CASE WHEN {thb} THEN regexp_replace(ticker, '/F$', ' TB') "
               f"WHEN {aud} THEN regexp_replace(ticker, '{AUD_RE}', ' AU') ELSE ticker END")
    return f"""
{name} AS (
  SELECT DATA_ID, 'BTKR' AS prefix, sec_id, sec_currency AS currency, ticker, sedol,
         CAST(trade_date_local AS TIMESTAMP) AS order_start_date,
         CAST(trade_date_local AS TIMESTAMP) + INTERVAL '23 hours 59 minutes' AS order_end_date,
         trade_date_local AS sym_date, {sym} AS SYMBOL_NAME, {base} AS SYMBOL_NAME_BASE,
         'historic' AS process_type
  FROM enriched WHERE sec_currency IN ('THB', 'AUD')
)"""


TICK_REQ = _tick_req("tick_req", "always")
TICK_REQ_M = _tick_req("tick_req", "matched")

VALID = "SYMBOL_NAME IS NOT NULL AND SYMBOL_NAME <> ''"


def _resp(name: str, req: str) -> str:
    return f"""
{name} AS (
  SELECT r.DATA_ID, r.prefix, r.SYMBOL_NAME, y.resolved, y.valid_from, y.valid_to
  FROM {req} r
  JOIN symbology y ON y.prefix = r.prefix AND y.symbol = r.SYMBOL_NAME
   AND r.sym_date BETWEEN y.valid_from AND y.valid_to
  WHERE r.{VALID.replace(' AND ', ' AND r.')}
)"""


RESP = _resp("resp_sed", "sed_req") + "," + _resp("resp_tick", "tick_req") + """,
responses AS (SELECT * FROM resp_sed UNION ALL SELECT * FROM resp_tick)"""

RESULT = """
result AS (SELECT e.*, r.prefix, r.SYMBOL_NAME, r.resolved, r.valid_from, r.valid_to
           FROM enriched e JOIN responses r ON r.DATA_ID = e.DATA_ID)"""


def _chain(views: tuple[str, ...], *ctes: str) -> str:
    """The CTEs behind the views they need; those that several others read are stored once."""
    text = with_views(*views) + "," + ",".join(ctes)
    return re.sub(r"\b(securities|symbology|ided|enriched|sed_req|tick_req|responses) AS \(",
                  r"\1 AS MATERIALIZED (", text)


HIST_VIEWS = ("allocations", "snapshot_dates", "securities", "ref_equity", "ref_fund")
HIST = (FILTERED, DEDUP3, IDED, PREV, SNAP, REFS, ENRICHED)
LOOK = HIST_VIEWS + ("symbology",)

SAME_DAY_SNAP = """
same_day AS (
  SELECT d.*, s.ext_sec_id, s.sedol, s.cusip, s.isin_no, s.ticker, s.sec_currency
  FROM dedup2 d
  LEFT JOIN securities s ON s.sec_id = CAST(d.sec_id AS VARCHAR) AND s.datadate = d.trade_date_est
)"""

SAME_DAY_COLS = ", ".join(
    [f"n.{c} AS alloc_{c}" for c in ALLOC_COLS.split(", ")]
    + [f"n.{c} AS snap_{c}" for c in ("ext_sec_id", "sedol", "cusip", "isin_no", "ticker",
                                      "sec_currency")])

ORACLES: dict[str, str] = {
    "filter_allocations": _chain(("allocations",), FILTERED) + " SELECT * FROM filtered",
    "dedup_allocations": _chain(("allocations",), FILTERED, DEDUP3) + " SELECT * FROM dedup",
    "dedup_allocations_two_keys": _chain(("allocations",), FILTERED, DEDUP2)
    + " SELECT * FROM dedup2",
    "dedup_allocations_by_account": _chain(
        ("allocations",), FILTERED,
        _dedup("dedup_acct", "acct_id, trade_date_est, trade_date_local",
               "order_id, line_no, sec_id")) + " SELECT * FROM dedup_acct",
    "assign_ids": _chain(("allocations",), FILTERED, DEDUP3, IDED) + " SELECT * FROM ided",
    "previous_snapshot": _chain(("allocations", "snapshot_dates"), FILTERED, DEDUP3, IDED, PREV)
    + " SELECT * FROM prev",
    "previous_snapshot_left": _chain(("allocations", "snapshot_dates"), FILTERED, DEDUP3, IDED,
                                     PREV) + " SELECT * FROM prev_all",
    "previous_snapshot_by_key": _chain(("allocations", "securities"), FILTERED, DEDUP3, IDED) + """
      SELECT * FROM (
        SELECT i.*, (SELECT max(s.datadate) FROM securities s
                     WHERE s.sec_id = CAST(i.sec_id AS VARCHAR)
                       AND s.datadate < i.trade_date_est) AS snapshot_date
        FROM ided i) x
      WHERE snapshot_date IS NOT NULL""",
    "join_snapshot_same_day": _chain(("allocations", "securities"), FILTERED, DEDUP2,
                                     SAME_DAY_SNAP) + " SELECT * FROM same_day",
    "join_snapshot_previous": _chain(HIST_VIEWS, FILTERED, DEDUP3, IDED, PREV, SNAP)
    + " SELECT * FROM snap",
    "audit_missing_all": _chain(HIST_VIEWS, FILTERED, DEDUP3, IDED, PREV, SNAP)
    + """ SELECT * FROM snap WHERE ext_sec_id IS NULL AND sedol IS NULL AND cusip IS NULL
          AND isin_no IS NULL AND ticker IS NULL""",
    "audit_missing_any": _chain(HIST_VIEWS, FILTERED, DEDUP3, IDED, PREV, SNAP)
    + " SELECT * FROM snap WHERE ext_sec_id IS NULL OR sedol IS NULL OR ticker IS NULL",
    "join_reference": _chain(HIST_VIEWS, *HIST) + " SELECT * FROM enriched",
    "join_reference_previous_day": _chain(HIST_VIEWS, FILTERED, DEDUP3, IDED, PREV, SNAP,
                                          REFS_PREV_DAY, ENRICHED) + " SELECT * FROM enriched",
    "sedol_requests": _chain(HIST_VIEWS, *HIST, SED_REQ) + f" SELECT * FROM sed_req WHERE {VALID}",
    "ticker_requests": _chain(HIST_VIEWS, *HIST, TICK_REQ)
    + f" SELECT * FROM tick_req WHERE {VALID}",
    "ticker_requests_matched": _chain(HIST_VIEWS, *HIST, TICK_REQ_M)
    + f" SELECT * FROM tick_req WHERE {VALID}",
    "valid_requests": _chain(HIST_VIEWS, *HIST, SED_REQ, TICK_REQ)
    + f""" SELECT * FROM (SELECT * FROM sed_req UNION ALL SELECT * FROM tick_req) u
           WHERE {VALID}""",
    "batch_requests": _chain(HIST_VIEWS, *HIST, SED_REQ, TICK_REQ) + f"""
      SELECT *, CAST(floor((row_number() OVER (PARTITION BY prefix ORDER BY DATA_ID) - 1) / 500)
             AS BIGINT) AS batch_no
      FROM (SELECT * FROM sed_req UNION ALL SELECT * FROM tick_req) u WHERE {VALID}""",
    "export_request_batches": _chain(HIST_VIEWS, *HIST, SED_REQ, TICK_REQ) + f"""
      SELECT *, CAST(floor((row_number() OVER (PARTITION BY prefix ORDER BY DATA_ID) - 1) / 500)
             AS BIGINT) AS batch_no
      FROM (SELECT * FROM sed_req UNION ALL SELECT * FROM tick_req) u WHERE {VALID}""",
    "lookup_symbols_sedol": _chain(LOOK, *HIST, SED_REQ, TICK_REQ, RESP) + " SELECT * FROM resp_sed",
    "lookup_symbols_ticker": _chain(LOOK, *HIST, SED_REQ, TICK_REQ, RESP)
    + " SELECT * FROM resp_tick",
    "merge_responses": _chain(LOOK, *HIST, SED_REQ, TICK_REQ, RESP) + " SELECT * FROM responses",
    "attach_symbols": _chain(LOOK, *HIST, SED_REQ, TICK_REQ, RESP) + """
      SELECT e.*, r.prefix AS sym_prefix, r.SYMBOL_NAME AS sym_SYMBOL_NAME,
             r.resolved AS sym_resolved, r.valid_from AS sym_valid_from,
             r.valid_to AS sym_valid_to
      FROM enriched e JOIN responses r ON r.DATA_ID = e.DATA_ID""",
    "historic_identifiers": _chain(LOOK, *HIST, SED_REQ, TICK_REQ, RESP, RESULT)
    + " SELECT *, 'historic' AS process_type FROM result",
    "historic_identifiers_matched": _chain(LOOK, *HIST, SED_REQ, TICK_REQ_M, RESP, RESULT)
    + " SELECT * FROM result",
    "historic_identifiers_dated": _chain(LOOK, FILTERED, DEDUP2, IDED2, PREV, SNAP, REFS_PREV_DAY,
                                         ENRICHED, SED_REQ, TICK_REQ_M, RESP, RESULT)
    + " SELECT * FROM result",
    "historic_identifiers_by_security": _chain(LOOK, FILTERED, DEDUP3, IDED, PREV_BY_SEC, SNAP,
                                               REFS, ENRICHED, SED_REQ, TICK_REQ, RESP, RESULT)
    + " SELECT * FROM result",
    "same_day_identifiers": _chain(("allocations", "securities", "ref_equity", "ref_fund"),
                                   FILTERED, DEDUP2, SAME_DAY_SNAP, REFS,
                                   _enrich("same_day_enriched", "same_day", "sec_id",
                                           "trade_date_est", SAME_DAY_COLS))
    + " SELECT * FROM same_day_enriched",
    "stage_counts": _chain(LOOK, *HIST, SED_REQ, TICK_REQ, RESP, RESULT) + f"""
      SELECT 'allocations' AS stage, count(*) AS rows FROM allocations
      UNION ALL SELECT 'filtered', count(*) FROM filtered
      UNION ALL SELECT 'deduplicated', count(*) FROM ided
      UNION ALL SELECT 'previous_snapshot', count(*) FROM prev
      UNION ALL SELECT 'enriched', count(*) FROM enriched
      UNION ALL SELECT 'sedol_requests', count(*) FROM sed_req WHERE {VALID}
      UNION ALL SELECT 'ticker_requests', count(*) FROM tick_req WHERE {VALID}
      UNION ALL SELECT 'responses', count(*) FROM responses
      UNION ALL SELECT 'result', count(*) FROM result""",
    "duplicate_keys": with_views("allocations", "ref_equity", "ref_fund") + """
      SELECT order_id, line_no, count(*) AS rows, 'allocations' AS source
      FROM allocations GROUP BY order_id, line_no HAVING count(*) > 1
      UNION ALL
      SELECT CAST(sec_id AS BIGINT), file_eff_dt, count(*), 'ref_equity'
      FROM ref_equity GROUP BY sec_id, file_eff_dt HAVING count(*) > 1
      UNION ALL
      SELECT CAST(sec_id AS BIGINT), file_eff_dt, count(*), 'both files'
      FROM (SELECT sec_id, file_eff_dt FROM ref_equity UNION ALL SELECT sec_id, file_eff_dt FROM ref_fund) u
      GROUP BY sec_id, file_eff_dt HAVING count(*) > 1
      UNION ALL
      SELECT CAST(sec_id AS BIGINT), CAST(NULL AS INTEGER), count(*), 'ref_fund'
      FROM ref_fund GROUP BY sec_id HAVING count(*) > 1""",
    "date_texts": _chain(HIST_VIEWS, *HIST, SED_REQ, TICK_REQ) + f"""
      SELECT DATA_ID, prefix, strftime(sym_date, '%Y%m%d') AS sym_day,
             strftime(order_start_date, '%Y-%m-%d %H:%M:%S') AS start_text,
             strftime(order_end_date, '%Y-%m-%d %H:%M:%S') AS end_text
      FROM (SELECT * FROM sed_req UNION ALL SELECT * FROM tick_req) u WHERE {VALID}""",
    "lookup_symbols_many_ranges": _chain(LOOK, *HIST, SED_REQ, TICK_REQ) + f""",
      pieces AS (
        SELECT prefix, symbol, resolved, CAST(s AS DATE) AS valid_from,
               CAST(least(CAST(s AS DATE) + 29, valid_to) AS DATE) AS valid_to
        FROM (SELECT *, unnest(generate_series(CAST(valid_from AS TIMESTAMP), CAST(valid_to AS TIMESTAMP),
                                               INTERVAL 30 DAY)) AS s FROM symbology) x)
      SELECT r.DATA_ID, r.prefix, r.SYMBOL_NAME, y.resolved, y.valid_from, y.valid_to
      FROM (SELECT * FROM sed_req UNION ALL SELECT * FROM tick_req) r
      JOIN pieces y ON y.prefix = r.prefix AND y.symbol = r.SYMBOL_NAME
       AND r.sym_date BETWEEN y.valid_from AND y.valid_to
      WHERE {VALID}""",
    "join_reference_from_reordered_csv": _chain(HIST_VIEWS, *HIST) + " SELECT * FROM enriched",
    "published_identifiers": _chain(LOOK, *HIST, SED_REQ, TICK_REQ, RESP, RESULT)
    + " SELECT *, 'historic' AS process_type FROM result",
    "prefix_columns": with_views("securities") + """
      SELECT datadate AS snap_datadate, ext_sec_id AS snap_ext_sec_id, sedol AS snap_sedol,
             cusip AS snap_cusip, isin_no AS snap_isin_no, sec_currency AS snap_sec_currency,
             ticker AS snap_ticker
      FROM securities""",
    "tag": _chain(("allocations",), FILTERED)
    + " SELECT *, 'O' AS source, 'historic' AS process_type FROM filtered",
    "normalize_dates": with_views("ref_equity") + """
      SELECT sec_id,
             CAST(try_strptime(CAST(file_eff_dt AS VARCHAR), '%Y%m%d') AS DATE) AS file_eff_dt,
             CAST(try_strptime(CAST(file_eff_dt AS VARCHAR), '%Y%m%d') AS DATE) AS loaded,
             'file' AS kind
      FROM ref_equity
      UNION ALL
      SELECT CAST(l_orderkey AS VARCHAR), CAST(substr(CAST(l_shipdate AS VARCHAR), 1, 10) AS DATE),
             CAST(NULL AS DATE), 'ship'
      FROM lineitem""",
    "union_snapshots": with_views("securities") + """
      SELECT datadate, sec_id, ext_sec_id, sedol, cusip, isin_no,
             CASE WHEN datadate = (SELECT max(datadate) FROM securities) THEN sec_currency END
               AS sec_currency,
             ticker
      FROM securities""",
    "sql_relation": _chain(HIST_VIEWS, FILTERED, DEDUP3, IDED, PREV) + """
      SELECT a.DATA_ID, a.sec_id, a.trade_date_est, a.snapshot_date,
             s.ext_sec_id, s.sedol, s.ticker
      FROM prev a
      LEFT JOIN securities s
        ON s.sec_id = CAST(a.sec_id AS VARCHAR) AND s.datadate = a.snapshot_date
       AND s.datadate <= DATE '1996-06-30'
      WHERE a.trade_date_est <= DATE '1996-06-30'""",
    "snapshot_dates": with_views("snapshot_dates") + " SELECT datadate FROM snapshot_dates",
    "publish": _chain(("allocations",), FILTERED) + " SELECT * FROM filtered",
    "publish_versions": with_views("allocations")
    + " SELECT * FROM allocations WHERE status = 'ACCT' OR sec_typ_cd = 'COM'",
    "assign_ids_across_runs": _chain(("allocations",), FILTERED, DEDUP3, IDED_RUNS) + " SELECT * FROM ided",
    "join_snapshot_partitioned": _chain(HIST_VIEWS, FILTERED, DEDUP3, IDED, PREV, SNAP)
    + " SELECT * FROM snap WHERE year(trade_date_est) = 1996",
    "published_versions_of_identifiers": _chain(LOOK, FILTERED, DEDUP3, IDED_RUNS, PREV, SNAP, REFS, ENRICHED,
                                                SED_REQ, TICK_REQ, RESP, RESULT)
    + " SELECT *, 'historic' AS process_type FROM result",
    "compressed_snapshots": with_views("securities") + """,
      days AS (SELECT datadate, CAST(row_number() OVER (ORDER BY datadate) AS INTEGER) AS no FROM snapshot_dates),
      rows AS (SELECT s.*, no, concat_ws('|', ext_sec_id, coalesce(cusip, '-'), coalesce(isin_no, '-'), sec_currency,
                                         ticker) AS v
               FROM securities s JOIN days USING (datadate)),
      firsts AS (SELECT a.* FROM rows a WHERE NOT EXISTS (
        SELECT 1 FROM rows b WHERE b.sec_id = a.sec_id AND b.no = a.no - 1 AND b.v = a.v))
      SELECT f.sec_id, f.datadate AS valid_from, l.datadate AS valid_to, f.no AS first_no, l.no AS last_no,
             f.ext_sec_id, f.cusip, f.isin_no, f.sec_currency, f.ticker
      FROM firsts f JOIN rows l ON l.sec_id = f.sec_id AND l.no = (
        SELECT min(e.no) FROM rows e WHERE e.sec_id = f.sec_id AND e.no >= f.no AND NOT EXISTS (
          SELECT 1 FROM rows g WHERE g.sec_id = e.sec_id AND g.no = e.no + 1 AND g.v = e.v))""",
    "expanded_snapshots": with_views("securities") + " SELECT * FROM securities",
    "join_snapshot_intervals": _chain(HIST_VIEWS, FILTERED, DEDUP3, IDED, PREV, SNAP) + " SELECT * FROM snap",
    "daily_identifiers": _chain(LOOK, FILTERED, DEDUP3, IDED_RUNS, PREV, SNAP, REFS, ENRICHED,
                                SED_REQ, TICK_REQ, RESP, RESULT)
    + " SELECT *, 'historic' AS process_type FROM result",
    "scan_csv_with_rejects": with_views("ref_equity") + """
      SELECT CASE WHEN good THEN sec_id END AS sec_id, CASE WHEN good THEN file_eff_dt END AS file_eff_dt,
             CASE WHEN good THEN parent_id_undr END AS parent_id_undr,
             CASE WHEN good THEN sedol_id END AS sedol_id, CASE WHEN good THEN ticker END AS ticker,
             CASE WHEN good THEN isin_id END AS isin_id,
             CASE WHEN NOT good THEN concat_ws(',', sec_id, day, coalesce(parent_id_undr, ''), sedol_id, ticker)
               || CASE WHEN short THEN '' ELSE ',' || coalesce(isin_id, '') END END AS line,
             CASE WHEN short THEN 'not the 6 fields of the header'
                  WHEN NOT good THEN 'file_eff_dt: n/a is no int' END AS reason
      FROM (SELECT *, k % 70 = 2 AS short, k % 50 <> 1 AND k % 70 <> 2 AS good,
                   CASE WHEN k % 50 = 1 THEN 'n/a' ELSE CAST(file_eff_dt AS VARCHAR) END AS day
            FROM (SELECT *, CAST(sec_id AS BIGINT) AS k FROM ref_equity) x) y""",
    "lookup_symbols_resumed": _chain(HIST_VIEWS, *HIST, SED_REQ, TICK_REQ) + f""",
      asked AS (SELECT DATA_ID, prefix, SYMBOL_NAME, substr(prefix, 1, 1) || SYMBOL_NAME AS resolved
                FROM (SELECT * FROM sed_req UNION ALL SELECT * FROM tick_req) u WHERE {VALID})
      SELECT * FROM asked WHERE DATA_ID % 7 <> 0
      UNION ALL SELECT DATA_ID, prefix, SYMBOL_NAME, resolved || '+' FROM asked WHERE DATA_ID % 5 = 0""",
    "export_requests": _chain(HIST_VIEWS, *HIST, SED_REQ, TICK_REQ) + f"""
      SELECT * FROM (SELECT * FROM sed_req UNION ALL SELECT * FROM tick_req) u WHERE {VALID}""",
    "join_reference_from_csv": _chain(HIST_VIEWS, *HIST) + " SELECT * FROM enriched",
    "preview": _chain(HIST_VIEWS, *HIST) + " SELECT * FROM enriched ORDER BY DATA_ID LIMIT 100",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
