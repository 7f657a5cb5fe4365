"""DuckDB text of the fixture views (FIXTURES.md), used as CTEs by the oracles.

The Spark side builds the same views with the DataFrame API in
``idweave.fixtures``; the two are written separately so each checks the other.
"""

ALLOCATIONS = """
allocations AS (
  SELECT l_orderkey AS order_id,
         l_linenumber AS line_no,
         l_suppkey AS acct_id,
         l_extendedprice AS gross,
         l_partkey AS sec_id,
         CASE l_suppkey % 8 WHEN 0 THEN 'ADR' WHEN 1 THEN 'COM' WHEN 2 THEN 'GDR'
              WHEN 3 THEN 'MFC' WHEN 4 THEN 'MFO' WHEN 5 THEN 'PFD' WHEN 6 THEN 'BND'
              ELSE 'OPT' END AS sec_typ_cd,
         CASE WHEN l_returnflag = 'N' THEN 'CNCL' ELSE 'ACCT' END AS status,
         CAST(l_shipdate AS DATE) AS trade_date_local,
         CASE WHEN l_suppkey % 10 = 0 THEN CAST(CAST(l_shipdate AS DATE) - INTERVAL 1 DAY AS DATE)
              ELSE CAST(l_shipdate AS DATE) END AS trade_date_est
  FROM lineitem
)"""

SNAPSHOT_DATES = """
snapshot_dates AS (
  SELECT max(CAST(o_orderdate AS DATE)) AS datadate
  FROM orders
  GROUP BY year(o_orderdate), quarter(o_orderdate)
)"""

SECURITIES = """
securities AS (
  SELECT d.datadate,
         CAST(p.p_partkey AS VARCHAR) AS sec_id,
         'E' || CAST(p.p_partkey AS VARCHAR) AS ext_sec_id,
         CASE WHEN (p.p_partkey + day(d.datadate)) % 11 = 0 THEN NULL
              WHEN (p.p_partkey + day(d.datadate)) % 13 = 0 THEN ''
              ELSE 'S' || CAST(p.p_partkey * 7 + month(d.datadate) AS VARCHAR) END AS sedol,
         CASE WHEN p.p_partkey % 17 = 0 THEN NULL ELSE 'C' || CAST(p.p_partkey AS VARCHAR) END AS cusip,
         CASE WHEN p.p_partkey % 19 = 0 THEN NULL ELSE 'I' || CAST(p.p_partkey AS VARCHAR) END AS isin_no,
         CASE p.p_size % 4 WHEN 0 THEN 'THB' WHEN 1 THEN 'AUD' WHEN 2 THEN 'USD' ELSE 'CAD' END AS sec_currency,
         'T' || CAST(p.p_partkey AS VARCHAR) ||
         CASE p.p_partkey % 12 WHEN 0 THEN 'ZZ' WHEN 1 THEN 'BB' WHEN 2 THEN 'YY' WHEN 3 THEN 'XX'
              WHEN 4 THEN 'XX*' WHEN 5 THEN '0A' WHEN 6 THEN '0B' WHEN 7 THEN 'O' WHEN 8 THEN 'DA'
              WHEN 9 THEN '-W' WHEN 10 THEN '/F' ELSE '' END AS ticker
  FROM part p, snapshot_dates d
  WHERE (p.p_partkey + month(d.datadate)) % 23 <> 0
)"""


def _reference(name: str, lines: str, x: str) -> str:
    return f"""
{name}_src AS (
  SELECT DISTINCT l_partkey AS k, CAST(CAST(l_shipdate AS DATE) + INTERVAL 1 DAY AS DATE) AS d
  FROM lineitem WHERE l_linenumber IN ({lines})
),
{name} AS (
  SELECT CAST(k AS VARCHAR) AS sec_id,
         CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS file_eff_dt,
         CASE WHEN k % 5 = 0 THEN NULL ELSE '{x}V' || CAST(k AS VARCHAR) END AS parent_id_undr,
         '{x}S' || CAST(k AS VARCHAR) AS sedol_id,
         '{x}T' || CAST(k AS VARCHAR) AS ticker,
         CASE WHEN k % 7 = 0 THEN NULL ELSE '{x}I' || CAST(k AS VARCHAR) END AS isin_id
  FROM {name}_src
)"""


REF_EQUITY = _reference("ref_equity", "1, 2, 3", "Q")
REF_FUND = _reference("ref_fund", "3, 4", "F")

# The symbology view needs the ticker rule; it is spelled out here in SQL
# independently of the Spark rule table.
SYMBOLOGY = """
symbology AS (
  SELECT prefix, symbol, min(datadate) AS valid_from,
         CAST(max(datadate) + INTERVAL 120 DAY AS DATE) AS valid_to,
         min(resolved) AS resolved
  FROM (
    SELECT 'SED' AS prefix, sedol AS symbol, datadate, 'X' || sedol AS resolved
    FROM securities WHERE sedol IS NOT NULL AND sedol <> ''
    UNION ALL
    SELECT 'BTKR', sym, datadate, 'Y' || sym
    FROM (
      SELECT datadate,
             CASE WHEN sec_currency = 'THB'
                  THEN regexp_replace(ticker, '/F$', '') || ' TB'
                  ELSE regexp_replace(ticker, '(ZZ|BB|YY|XX\\*?|0A|0B|O|DA|-W)$', '') || ' AU' END AS sym
      FROM securities WHERE sec_currency IN ('THB', 'AUD')
    ) t
  ) u
  GROUP BY prefix, symbol
)"""

ALL_VIEWS = {
    "allocations": ALLOCATIONS,
    "snapshot_dates": SNAPSHOT_DATES,
    "securities": SECURITIES,
    "ref_equity": REF_EQUITY,
    "ref_fund": REF_FUND,
    "symbology": SYMBOLOGY,
}
# dependency order for a WITH list
ORDER = ["allocations", "snapshot_dates", "securities", "ref_equity", "ref_fund", "symbology"]
DEPENDS = {"securities": ["snapshot_dates"], "symbology": ["securities"]}


def with_views(*names: str) -> str:
    """WITH clause holding the named fixture views and what they need."""
    need: set[str] = set()

    def add(n: str) -> None:
        for d in DEPENDS.get(n, []):
            add(d)
        need.add(n)

    for n in names:
        add(n)
    return "WITH " + ",".join(ALL_VIEWS[n] for n in ORDER if n in need)
