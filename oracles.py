"""DuckDB SQL that states each registered query a second time.

Three layers: the ledger derived from the given tables, the section balances and sums,
and one body per query. Tests run the bodies on other ledgers by leaving the first layer out.
The SQL is written on its own, from the report definitions, not from the Spark plans:
it reads the journal line by line, joins totals through a membership table and builds
the year-over-year reports from a spine with a left join.
"""

from __future__ import annotations

COMPANY = 1
PL_YEAR = 1996
BS_YEAR = 1995
# 2000 is left out on purpose: 1999 is compared with 2001.
YEARS = (1995, 1996, 1997, 1998, 1999, 2001)

# Years of a first version, and those that the next one restates.
FIRST_LOAD = (1992, 1993, 1994, 1995, 1996)
RESTATED = (1996, 1997, 1998, 1999, 2000, 2001, None)


def _postings(line: str) -> str:
    return f"""  SELECT journal_entry_id, c * 100 + 1 + p % 13 AS account_id,
         CASE WHEN c = 1 AND p % 13 = 10 THEN NULL ELSE amount END AS debit,
         CAST(NULL AS DECIMAL(18, 2)) AS credit
  FROM {line} WHERE NOT (c = 2 AND p % 13 = 11)
  UNION ALL
  SELECT journal_entry_id, c * 100 + 51 + p % 3, amount, NULL FROM {line}
  UNION ALL
  SELECT journal_entry_id, c * 100 + 54 + s % 4, NULL, amount
  FROM {line} WHERE NOT (c = 5 AND n = 1)
"""


# Section captions by statement order come first.
LEDGER = f"""
caption(flag, ord, label) AS (
  VALUES (0, 1, 'REVENUE'), (0, 2, 'RETURNS'), (0, 3, 'REFUNDS'), (0, 4, 'OTHER REVENUE'),
         (0, 5, 'SUBSIDIES'), (0, 6, 'DISCOUNTS'), (0, 7, 'COST OF GOODS'),
         (0, 8, 'ADMIN EXPENSES'), (0, 9, 'SELLING EXPENSES'), (0, 10, 'OTHER EXPENSES'),
         (0, 11, 'OTHER INCOME'), (0, 12, 'INCOME TAX'), (0, 13, 'OTHER TAX'),
         (1, 1, 'CURRENT ASSETS'), (1, 2, 'FIXED ASSETS'), (1, 3, 'DEFERRED ASSETS'),
         (1, 4, 'CURRENT LIABILITIES'), (1, 5, 'LONG TERM LIABILITIES'),
         (1, 6, 'DEFERRED LIABILITIES'), (1, 7, 'EQUITY')
),
statement_section AS (
  SELECT CAST(c * 100 + flag * 50 + ord AS BIGINT) AS statement_section_id,
         CAST(flag AS TINYINT) AS is_balance_sheet_section, CAST(c AS INTEGER) AS company_id,
         ord AS statement_section_order, label AS statement_section
  FROM (SELECT DISTINCT 1 + s_suppkey // 2 AS c FROM supplier) AS companies, caption
  UNION ALL
  SELECT 0, CAST(0 AS TINYINT), 0, 0, 'UNASSIGNED'
),
account AS (
  SELECT statement_section_id AS account_id,
         statement_section_id * (1 - is_balance_sheet_section) AS profit_loss_section_id,
         statement_section_id * is_balance_sheet_section AS balance_sheet_section_id
  FROM statement_section WHERE statement_section_id <> 0
),
journal_entry AS (
  SELECT o_orderkey AS journal_entry_id, CAST(o_orderdate AS DATE) AS entry_date,
         CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS cancelled
  FROM orders
),
order_line AS (
  SELECT l_orderkey AS journal_entry_id, 1 + l_suppkey // 2 AS c, l_partkey AS p,
         l_suppkey AS s, l_linenumber AS n, CAST(l_extendedprice AS DECIMAL(18, 2)) AS amount
  FROM lineitem
),
journal_entry_line_item AS (
{_postings("order_line")}),
"""

# Signs, positions and captions of the lines.
LINES = """
pl_sign(statement_section_order, sign) AS (
  VALUES (1, 1), (4, 1), (5, 1), (11, 1), (2, -1), (3, -1), (6, -1), (7, -1), (8, -1),
         (9, -1), (10, -1), (12, -1), (13, -1)
),
pl_sub(line_order, line_label, last_order) AS (
  VALUES (CAST(9.5 AS DECIMAL(12, 2)), 'GROSS PROFIT', 9), (11.5, 'PROFIT BEFORE TAXES', 11)
),
bs_sub(line_order, line_label, first_order, last_order, sign) AS (
  VALUES (CAST(3.6 AS DECIMAL(12, 2)), 'TOTAL ASSETS', 1, 3, 1),
         (6.5, 'TOTAL LIABILITIES', 4, 6, -1),
         (7.5, 'TOTAL LIABILITIES AND SHAREHOLDERS EQUITY', 4, 7, -1)
),
bs_caption(line_order, line_label) AS (
  VALUES (CAST(0.1 AS DECIMAL(12, 2)), 'ASSETS'), (3.65, ''),
         (3.7, 'LIABILITIES AND SHAREHOLDERS EQUITY'), (6.6, 'SHAREHOLDERS EQUITY')
),
"""

MART = """
live_line AS (
  SELECT li.account_id, CAST(year(je.entry_date) AS INTEGER) AS year, li.debit, li.credit
  FROM journal_entry_line_item li JOIN journal_entry je
    ON je.journal_entry_id = li.journal_entry_id AND je.cancelled = 0
),
pl_sum AS (
  SELECT s.is_balance_sheet_section, s.company_id, l.year, s.statement_section_order,
         s.statement_section, COALESCE(SUM(l.debit), 0) AS debit
  FROM live_line l JOIN account a USING (account_id)
  JOIN statement_section s ON s.statement_section_id = a.profit_loss_section_id
  WHERE a.profit_loss_section_id <> 0
  GROUP BY ALL
),
pl_balance AS (
  SELECT is_balance_sheet_section, company_id, year, statement_section_order,
         statement_section, CAST(sign * debit AS DECIMAL(28, 2)) AS balance
  FROM pl_sum LEFT JOIN pl_sign USING (statement_section_order)
),
bs_balance AS (
  SELECT s.is_balance_sheet_section, s.company_id, l.year, s.statement_section_order,
         s.statement_section,
         CAST(SUM(COALESCE(l.debit, 0) - COALESCE(l.credit, 0)) AS DECIMAL(28, 2)) AS balance
  FROM live_line l JOIN account a USING (account_id)
  JOIN statement_section s ON s.statement_section_id = a.balance_sheet_section_id
  WHERE s.statement_section_order <> 0
  GROUP BY s.is_balance_sheet_section, s.company_id, l.year, s.statement_section_order,
           s.statement_section
),
mart AS (SELECT * FROM pl_balance UNION SELECT * FROM bs_balance),
pl AS (SELECT * FROM mart WHERE is_balance_sheet_section = 0),
bs AS (SELECT * FROM mart WHERE is_balance_sheet_section = 1),
pl_total AS (
  SELECT company_id, year, line_order, line_label,
         CAST(SUM(balance) AS DECIMAL(28, 2)) AS balance
  FROM pl JOIN pl_sub ON statement_section_order BETWEEN 1 AND last_order
  GROUP BY ALL
  UNION ALL
  SELECT company_id, year, 13.5, 'NET PROFIT', CAST(SUM(balance) AS DECIMAL(28, 2))
  FROM pl GROUP BY company_id, year
),
bs_total AS (
  SELECT company_id, year, line_order, line_label,
         CAST(SUM(sign * balance) AS DECIMAL(28, 2)) AS balance
  FROM bs JOIN bs_sub ON statement_section_order BETWEEN first_order AND last_order
  GROUP BY ALL
),
ratio AS (
  SELECT company_id, year, -CAST(cost AS DOUBLE) / NULLIF(CAST(income AS DOUBLE), 0) AS ratio
  FROM (SELECT company_id, year, SUM(balance) AS cost FROM pl
        WHERE statement_section_order = 7 GROUP BY company_id, year)
  JOIN (SELECT company_id, year, SUM(balance) AS income FROM pl
        WHERE statement_section_order = 1 GROUP BY company_id, year) USING (company_id, year)
),
pl_detail AS (
  SELECT company_id, year, CAST(statement_section_order AS DECIMAL(12, 2)) AS line_order,
         '  ' || statement_section AS line_label, balance
  FROM pl WHERE statement_section_order BETWEEN 1 AND 13
),
bs_detail AS (
  SELECT company_id, year, CAST(statement_section_order AS DECIMAL(12, 2)) AS line_order,
         '  ' || statement_section AS line_label,
         CASE WHEN statement_section_order > 3 THEN -balance ELSE balance END AS balance
  FROM bs WHERE statement_section_order BETWEEN 1 AND 7
),
pl_lines AS (
  SELECT * FROM pl_detail UNION ALL SELECT * FROM pl_total UNION ALL
  SELECT company_id, year, CAST(400 AS DECIMAL(12, 2)), 'Gross Margin Ratio %',
         CAST(ROUND(ratio, 2) AS DECIMAL(28, 2)) FROM ratio
),
sides AS (
  SELECT company_id, year, a.total AS total_assets, le.total AS total_liabilities_and_equity
  FROM (SELECT company_id, year, CAST(SUM(balance) AS DECIMAL(28, 2)) AS total FROM bs
        WHERE statement_section_order IN (1, 2, 3) GROUP BY company_id, year) a
  JOIN (SELECT company_id, year, CAST(-SUM(balance) AS DECIMAL(28, 2)) AS total FROM bs
        WHERE statement_section_order IN (4, 5, 6, 7) GROUP BY company_id, year) le
  USING (company_id, year)
),
pl_spine AS (
  SELECT company_id, CAST(statement_section_order AS DECIMAL(12, 2)) AS line_order,
         '  ' || statement_section AS line_label
  FROM statement_section WHERE is_balance_sheet_section = 0 AND company_id IS NOT NULL
  UNION
  SELECT company_id, line_order, line_label
  FROM statement_section,
       (SELECT line_order, line_label FROM pl_sub UNION SELECT 13.5, 'NET PROFIT')
  WHERE is_balance_sheet_section = 0 AND company_id IS NOT NULL
),
bs_spine AS (
  SELECT company_id, CAST(statement_section_order AS DECIMAL(12, 2)) AS line_order,
         '  ' || statement_section AS line_label
  FROM statement_section WHERE is_balance_sheet_section <> 0 AND company_id IS NOT NULL
  UNION
  SELECT company_id, line_order, line_label
  FROM statement_section,
       (SELECT line_order, line_label FROM bs_sub UNION ALL SELECT * FROM bs_caption)
  WHERE is_balance_sheet_section <> 0 AND company_id IS NOT NULL
)
"""

# What entries add to assets less liabilities and equity.
ENTRY_DIFFERENCES = """
WITH part AS (
  SELECT journal_entry_id, company_id, CAST(year(entry_date) AS INTEGER) AS year,
         COALESCE(debit, 0) - COALESCE(credit, 0) AS amount
  FROM journal_entry_line_item JOIN journal_entry USING (journal_entry_id)
  JOIN account USING (account_id)
  JOIN statement_section ON statement_section_id = balance_sheet_section_id
  WHERE cancelled = 0 AND is_balance_sheet_section = 1 AND statement_section_order BETWEEN 1 AND 7
  UNION ALL
  SELECT journal_entry_id, company_id, CAST(year(entry_date) AS INTEGER),
         sign * COALESCE(debit, 0)
  FROM journal_entry_line_item JOIN journal_entry USING (journal_entry_id)
  JOIN account USING (account_id)
  JOIN statement_section ON statement_section_id = profit_loss_section_id
  JOIN pl_sign USING (statement_section_order)
  WHERE cancelled = 0 AND is_balance_sheet_section = 1 AND profit_loss_section_id <> 0
    AND statement_section_order BETWEEN 1 AND 7
)
SELECT company_id, year, journal_entry_id, CAST(SUM(amount) AS DECIMAL(28, 2)) AS difference
FROM part WHERE company_id IS NOT NULL AND year IS NOT NULL
GROUP BY ALL HAVING SUM(amount) <> 0
"""

# Entries listed for a company-year.
WORST = 3

_KNOWN = "company_id IS NOT NULL AND year IS NOT NULL"


def _money_text(amount: str) -> str:
    return f"format('{{:,.2f}}', CAST({amount} AS DOUBLE))"


def _prefix(amount: str) -> str:
    text = _money_text(amount)
    return f"round_even(CAST(string_split({text}, ',')[1] AS DOUBLE), 0)"


def _statement(lines: str, where: str, text: bool = False) -> str:
    balance = f"{_money_text('balance')} AS balance" if text else "balance"
    return f"""
SELECT company_id, year, line_order, line_label, {balance}
FROM {lines} WHERE {where}
"""


def _captions(period: str, balance: str) -> str:
    return f"""UNION ALL
SELECT company_id, year, line_order, line_label, {balance}
FROM {period}, bs_caption
"""


def _year_over_year(statement: str, where: str, text: bool = False) -> str:
    """Per-line sums by year, left-joined to the spine."""
    sums = ", ".join(f"SUM(balance) FILTER (WHERE year = {y}) AS y{y}" for y in YEARS)
    cells = []
    for y in YEARS:
        value = f"COALESCE(y{y}, 0)"
        cell = _money_text(value) if text else f"CAST({value} AS DECIMAL(28, 2))"
        cells.append(f"{cell} AS b{y}")
    for a, b in zip(YEARS, YEARS[1:]):
        change = f"CAST(y{b} - y{a} AS DOUBLE) / NULLIF(CAST(y{a} AS DOUBLE), 0)"
        value = f"COALESCE({change}, 0)"
        if text:
            # Through a decimal, which has no negative zero.
            cell = _money_text(f"CAST(ROUND({value}, 2) AS DECIMAL(38, 2))")
        else:
            cell = f"CAST(ROUND({value}, 6) AS DECIMAL(38, 6))"
        cells.append(f"{cell} AS r{a % 100:02d}to{b % 100:02d}")
    # Balance-sheet lines are matched by position and label, P&L lines by label as text.
    same_label = "IS NOT DISTINCT FROM" if statement == "bs" else "="
    return f"""
SELECT s.company_id, s.line_order, s.line_label, {", ".join(cells)}
FROM {statement}_spine s LEFT JOIN (
  SELECT company_id, line_order, line_label, {sums}
  FROM (SELECT * FROM {statement}_detail UNION ALL SELECT * FROM {statement}_total)
  GROUP BY company_id, line_order, line_label
) v ON v.company_id = s.company_id AND v.line_order = s.line_order
   AND v.line_label {same_label} s.line_label
WHERE {where}
"""


def _compared(statement: str) -> str:
    """The year-over-year report with a row for each year."""
    whole = _year_over_year(statement, "TRUE")
    parts = []
    for before, y in zip([None, *YEARS], YEARS):
        change = "NULL" if before is None else f"r{before % 100:02d}to{y % 100:02d}"
        parts.append(f"""SELECT '{statement}_year_over_year', company_id, {y}, line_order, line_label,
  b{y}, {change} FROM ({whole})""")
    return " UNION ALL ".join(parts)


_ONE_PL = f"company_id = {COMPANY} AND year = {PL_YEAR}"
_ONE_BS = f"company_id = {COMPANY} AND year = {BS_YEAR}"
_ONE_BS_PERIOD = (
    f"(SELECT CAST({COMPANY} AS INTEGER) AS company_id, CAST({BS_YEAR} AS INTEGER) AS year)"
)
_BS_AMOUNTS = "(SELECT * FROM bs_detail UNION ALL SELECT * FROM bs_total)"
_ALL_BS_PERIODS = f"(SELECT DISTINCT company_id, year FROM bs WHERE {_KNOWN})"
_ONE_COMPANY = f"s.company_id = {COMPANY}"

BODIES = {
    "pl_section_balance": "SELECT * FROM pl_balance",
    "bs_section_balance": "SELECT * FROM bs_balance",
    "section_balance": "SELECT * FROM mart",
    "section_balance_stored": "SELECT * FROM mart",
    "section_balance_maintained": "SELECT * FROM mart",
    "section_balance_bucketed": "SELECT * FROM mart",
    "section_balance_clustered": "SELECT * FROM mart",
    "section_balance_published": f"""
SELECT CAST(1 AS INTEGER) AS version, * FROM mart
WHERE year BETWEEN {FIRST_LOAD[0]} AND {FIRST_LOAD[-1]}
UNION ALL
SELECT 2, * FROM mart WHERE year BETWEEN {FIRST_LOAD[0]} AND {RESTATED[-2]} OR year IS NULL
""",
    "pl_subtotals": "SELECT * FROM pl_total",
    "bs_totals": "SELECT * FROM bs_total",
    "gross_margin_ratio": """
SELECT company_id, year, CAST(ROUND(ratio, 6) AS DECIMAL(38, 6)) AS gross_margin_ratio
FROM ratio""",
    "pl_statement": _statement("pl_lines", _ONE_PL),
    "pl_statement_clustered": _statement("pl_lines", _ONE_PL),
    "pl_statement_all": _statement("pl_lines", _KNOWN),
    "pl_statement_formatted": _statement("pl_lines", _ONE_PL, text=True),
    "balance_sheet": _statement(_BS_AMOUNTS, _ONE_BS)
    + _captions(_ONE_BS_PERIOD, "CAST(NULL AS DECIMAL(28, 2))"),
    "balance_sheet_all": _statement(_BS_AMOUNTS, _KNOWN)
    + _captions(_ALL_BS_PERIODS, "CAST(NULL AS DECIMAL(28, 2))"),
    "balance_sheet_formatted": _statement(_BS_AMOUNTS, _ONE_BS, text=True)
    + _captions(_ONE_BS_PERIOD, "''"),
    "balance_check": """
SELECT *, CASE WHEN ROUND(total_assets, 0) = ROUND(total_liabilities_and_equity, 0)
               THEN 'A = L + E'
               WHEN ROUND(total_assets, 0) <> ROUND(total_liabilities_and_equity, 0)
               THEN 'A != L + E' END AS balance_check
FROM sides""",
    "balance_check_prefix": f"""
SELECT company_id, year, total_assets, total_liabilities_and_equity,
       CASE WHEN a = le THEN 'A = L + E' WHEN a <> le THEN 'A != L + E' END
         AS balance_check_prefix
FROM (SELECT *, {_prefix("total_assets")} AS a,
             {_prefix("total_liabilities_and_equity")} AS le FROM sides)""",
    "entry_differences": f"SELECT * FROM ({ENTRY_DIFFERENCES})",
    "largest_differences": f"""
SELECT company_id, year, CAST(place AS INTEGER) AS place, journal_entry_id, difference,
       total_difference, n_entries
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY company_id, year
                                   ORDER BY abs(difference) DESC, journal_entry_id) AS place,
             CAST(SUM(difference) OVER (PARTITION BY company_id, year) AS DECIMAL(28, 2))
               AS total_difference,
             COUNT(*) OVER (PARTITION BY company_id, year) AS n_entries
      FROM ({ENTRY_DIFFERENCES}))
WHERE place <= {WORST}""",
    "statement_spine_pl": "SELECT * FROM pl_spine",
    "statement_spine_bs": "SELECT * FROM bs_spine",
    "pl_year_over_year": _year_over_year("pl", _ONE_COMPANY),
    "pl_year_over_year_all": _year_over_year("pl", "TRUE"),
    "pl_year_over_year_formatted": _year_over_year("pl", _ONE_COMPANY, text=True),
    "bs_year_over_year": _year_over_year("bs", _ONE_COMPANY),
    "bs_year_over_year_all": _year_over_year("bs", "TRUE"),
    "bs_year_over_year_formatted": _year_over_year("bs", _ONE_COMPANY, text=True),
}

# Lines as they were: a cent more, twice, or not there.
BODIES["journal_reconciled"] = f""",
then_line AS (
  SELECT journal_entry_id, c, p, s, n,
         CASE WHEN p = 1 THEN CAST(amount + 0.01 AS DECIMAL(18, 2)) ELSE amount END AS amount
  FROM order_line WHERE p <> 3
  UNION ALL
  SELECT journal_entry_id, c, p, s, n, amount FROM order_line WHERE p = 2
),
then_item AS (
{_postings("then_line")}),
owner AS (
  SELECT account_id, company_id FROM account
  JOIN statement_section ON statement_section_id = profit_loss_section_id
  WHERE profit_loss_section_id <> 0
  UNION
  SELECT account_id, company_id FROM account
  JOIN statement_section ON statement_section_id = balance_sheet_section_id
  WHERE statement_section_order <> 0
),
counted AS (
  SELECT company_id, CAST(year(entry_date) AS INTEGER) AS year, journal_entry_id, account_id,
         debit, credit, SUM(was) AS was, SUM(now) AS now
  FROM (SELECT *, 1 AS was, 0 AS now FROM then_item UNION ALL
        SELECT *, 0, 1 FROM journal_entry_line_item)
  JOIN journal_entry USING (journal_entry_id) JOIN owner USING (account_id)
  WHERE cancelled = 0 GROUP BY ALL
)
SELECT company_id, year, CAST(SUM(was) AS BIGINT) AS n_stored, CAST(SUM(now) AS BIGINT) AS n_found,
       CASE WHEN SUM(was) = 0 THEN 'not stored' WHEN SUM(now) = 0 THEN 'not found'
            WHEN bool_and(was = now) THEN 'same' ELSE 'changed' END AS state
FROM counted GROUP BY company_id, year
"""

_IN_YEARS = f"{_KNOWN} AND year IN {YEARS}"
BODIES["all_reports"] = f"""
SELECT 'pl_statement' AS report, company_id, year, line_order, line_label, balance,
       CAST(NULL AS DECIMAL(38, 6)) AS change
FROM pl_lines WHERE {_IN_YEARS}
UNION ALL
SELECT 'balance_sheet', company_id, year, line_order, line_label, balance, NULL
FROM {_BS_AMOUNTS} WHERE {_IN_YEARS}
UNION ALL
SELECT 'balance_sheet', company_id, year, line_order, line_label, NULL, NULL
FROM (SELECT DISTINCT company_id, year FROM bs WHERE {_IN_YEARS}), bs_caption
UNION ALL
SELECT 'balance_check', company_id, year, NULL, balance_check,
       CAST(total_assets - total_liabilities_and_equity AS DECIMAL(28, 2)), NULL
FROM ({BODIES["balance_check"]}) WHERE {_IN_YEARS}
UNION ALL {_compared("pl")}
UNION ALL {_compared("bs")}
"""


def on_given_tables() -> dict[str, str]:
    """Oracle SQL over ``orders``, ``lineitem`` and ``supplier``."""
    return {key: f"WITH {LEDGER}{LINES}{MART}{body}" for key, body in BODIES.items()}


def on_ledger_tables(key: str) -> str:
    """The same query over the four ledger tables, for fixtures."""
    return f"WITH {LINES}{MART}{BODIES[key]}"
