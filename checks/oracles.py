"""The same results in DuckDB SQL over the same tables.

Written the long way round on purpose: forecasts by grid and lag, matrices by filtered sums,
differences by joins, none of which the Spark reports do.
"""

from __future__ import annotations

from ledgerloom.config import MONTH_LABELS

NUMBERED = list(enumerate(MONTH_LABELS, 1))
MONTHS = ", ".join(f'"{m}"' for m in MONTH_LABELS)
ROW_TOTAL = " + ".join(f'coalesce("{m}", 0)' for m in MONTH_LABELS)
MONEY = "DECIMAL(28,2)"


def label(column: str) -> str:
    return f"upper(rtrim({column}, ' '))"


def digits(column: str) -> str:
    """Absolute amount such as 1.234,56. DuckDB's format goes through double, exact here."""
    return f"translate(format('{{:,.2f}}', abs({column})::DOUBLE), ',.', '.,')"


def money(column: str, negative: str = "outer") -> str:
    sign = f"CASE WHEN {column} < 0 THEN '-' ELSE '' END"
    return (
        f"({sign} || 'R$ ' || {digits(column)})"
        if negative == "outer"
        else f"('R$ ' || {sign} || {digits(column)})"
    )


LEDGER = """ledger AS (
    SELECT CAST(o_orderdate AS DATE) AS entry_date, 'Revenue' AS kind, n_name AS account,
           o_orderpriority AS sub_code, CAST(o_totalprice AS DECIMAL(26,8)) AS amount,
           r_name AS unit
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey
    UNION ALL
    SELECT CAST(l_shipdate AS DATE), CASE WHEN l_returnflag = 'R' THEN 'EXPENSE' ELSE 'Open item' END,
           p_brand, p_type, CAST(l_extendedprice AS DECIMAL(26,8)), r_name
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
         JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


def item_ledger(account: str, amount: str) -> str:
    return f"""ledger AS (
    SELECT CAST(l_shipdate AS DATE) AS entry_date, 'Expense' AS kind, {account} AS account,
           l_returnflag AS sub_code, CAST({amount} AS DECIMAL(26,8)) AS amount
    FROM lineitem
)"""


LISTED = """listed(account, rank) AS (
    VALUES ('NATION_0', 1), ('NATION_1', 2), ('NATION_2', 3), ('NATION_3', 4), ('NATION_4', 5),
           ('NATION_5', 6), ('INVESTMENT', 7), ('NATION_6', 8)
)"""

EXPENSE_RANK = "CASE " + " ".join(
    f"WHEN {{0}} = 'BRAND#{i}' THEN {i}" for i in range(1, 13)
) + " ELSE 98 END"


def revenue_sums(keys: str) -> str:
    """CTE ``sums``: revenue per key, reclassified account and month of 2001."""
    return f"""sums AS (
    SELECT {keys} CASE WHEN account = 'NATION_6' AND sub_code = '5-LOW' THEN 'INVESTMENT'
                       ELSE account END AS account,
           CAST(date_trunc('month', entry_date) AS DATE) AS month,
           CAST(sum(amount) AS {MONEY}) AS amount
    FROM ledger WHERE year(entry_date) = 2001 AND upper(kind) = 'REVENUE'
    GROUP BY ALL
)"""


def dense_cells(key: str) -> str:
    """CTEs up to ``carried``; ``key`` is '' or 'unit'."""
    keys = f"{key}, " if key else ""
    entities = f"(SELECT DISTINCT {key} FROM sums)" if key else "(SELECT 1 AS one)"
    on_key = f"AND s.{key} = g.{key}" if key else ""
    grid_keys = f"g.{key}, " if key else ""
    return f"""{revenue_sums(keys)},
{LISTED},
grid AS (
    SELECT {keys} account, CAST(make_date(2001, i, 1) AS DATE) AS month
    FROM {entities} entities, listed, range(1, 13) months(i)
),
dense AS (
    SELECT {grid_keys} g.account, g.month, s.amount
    FROM grid g LEFT JOIN sums s ON s.account = g.account AND s.month = g.month {on_key}
),
lagged AS (
    SELECT *, lag(amount) OVER (PARTITION BY {keys} account ORDER BY month) AS previous FROM dense
),
flagged AS (
    SELECT *, amount IS NULL AND previous IS NOT NULL AND account <> 'NATION_4'
              AND strftime(month, '%Y%m')
                  = strftime(DATE '2001-09-15' - INTERVAL 1 MONTH, '%Y%m') AS is_forecast
    FROM lagged
),
carried AS (
    SELECT {keys} account, month,
           CASE WHEN amount IS NOT NULL THEN amount WHEN is_forecast THEN previous END AS amount,
           is_forecast
    FROM flagged
)"""


def filtered(aggregate: str, value: str, month: str = "month(month)") -> str:
    return ", ".join(f'{aggregate}({value}) FILTER ({month} = {i}) AS "{m}"' for i, m in NUMBERED)


def sum_months(month: str = "month(month)", value: str = "amount") -> str:
    return ", ".join(
        f'CAST(sum({value}) FILTER ({month} = {i}) AS {MONEY}) AS "{m}"' for i, m in NUMBERED
    )


def total_row(source: str, keys: str, group: str) -> str:
    sums = ", ".join(f'CAST(sum("{m}") AS {MONEY}) AS "{m}"' for m in [*MONTH_LABELS, "total"])
    return f"""SELECT {keys} 'total' AS row_type, 'TOTAL' AS label, 99 AS rank, {sums},
       CAST(NULL AS INTEGER) AS forecast_month
FROM {source} {group}"""


def revenue_ctes(key: str = "", ledger: str = LEDGER) -> str:
    """CTE ``revenue``: the numeric revenue matrix."""
    keys = f"{key}, " if key else ""
    if key:
        # Every entity with revenue in the year has a total row, listed accounts or not.
        totals = total_row(
            "(SELECT DISTINCT unit FROM sums) entities LEFT JOIN revenue_rows USING (unit)",
            keys, "GROUP BY unit",
        )
    else:
        totals = total_row("revenue_rows", "", "")
    return f"""{ledger},
{dense_cells(key)},
revenue_rows AS (
    SELECT *, CAST({ROW_TOTAL} AS {MONEY}) AS total FROM (
        SELECT {keys} account, {sum_months()},
               CAST(max(month(month)) FILTER (is_forecast) AS INTEGER) AS forecast_month
        FROM carried WHERE amount IS NOT NULL GROUP BY {keys} account
    )
),
revenue AS (
    SELECT {keys} 'detail' AS row_type, account AS label, rank, {MONTHS}, total, forecast_month
    FROM revenue_rows JOIN listed USING (account)
    UNION ALL
    {totals}
)"""


def expense_ctes(key: str = "") -> str:
    """CTE ``expense``: the numeric expense matrix."""
    keys = f"{key}, " if key else ""
    group = f"GROUP BY {key}" if key else ""
    return f"""expense_rows AS (
    SELECT *, CAST({ROW_TOTAL} AS {MONEY}) AS total FROM (
        SELECT {keys} upper(account) AS account, {sum_months("month(entry_date)")}
        FROM ledger WHERE year(entry_date) = 2001 AND upper(kind) = 'EXPENSE'
        GROUP BY {keys} upper(account)
    )
),
expense AS (
    SELECT {keys} 'detail' AS row_type, account AS label, {EXPENSE_RANK.format('account')} AS rank,
           {MONTHS}, total, CAST(NULL AS INTEGER) AS forecast_month
    FROM expense_rows
    UNION ALL
    {total_row("expense_rows", keys, group)}
)"""


def difference(label_: str, rank: int, excluded: str, source: str, keys: str) -> str:
    """One difference row per row of ``source``, which aliases r, e and x."""
    cells = ", ".join(
        f'CAST(r."{m}" {excluded.format(m)} - e."{m}" AS {MONEY}) AS "{m}"' for m in MONTH_LABELS
    )
    return f"""SELECT *, CAST({ROW_TOTAL} AS {MONEY}) AS total FROM (
    SELECT {keys} '{label_}' AS label, {rank} AS rank, {cells} FROM {source}
)"""


PLAIN = "SURPLUS"
REDUCED = "SURPLUS EXCLUDING INVESTMENT"


def surplus_ctes(key: str = "", account: str = "INVESTMENT", as_zero: bool = False) -> str:
    """CTE ``surplus``: both difference rows."""
    keys = f"coalesce(r.{key}, e.{key}) AS {key}, " if key else ""
    on = f"ON r.{key} = e.{key}" if key else "ON true"
    on_excluded = f"ON x.{key} = r.{key}" if key else "ON true"
    totals = f"""(SELECT * FROM revenue WHERE row_type = 'total') r
         FULL JOIN (SELECT * FROM expense WHERE row_type = 'total') e {on}
         LEFT JOIN (SELECT * FROM revenue WHERE row_type = 'detail' AND label = '{account}') x
         {on_excluded}"""
    excluded = '- coalesce(x."{0}", 0)' if as_zero else '- x."{0}"'
    return f"""surplus AS (
    {difference(PLAIN, 1, "", totals, keys)}
    UNION ALL
    {difference("SURPLUS EXCLUDING " + account, 2, excluded, totals, keys)}
)"""


def all_ctes(
    key: str = "", account: str = "INVESTMENT", as_zero: bool = False, ledger: str = LEDGER
) -> str:
    return ",\n".join(
        [revenue_ctes(key, ledger), expense_ctes(key), surplus_ctes(key, account, as_zero)]
    )


def text_months(negative: str = "outer", mark: bool = True) -> str:
    cells = []
    for i, m in NUMBERED:
        suffix = f" || CASE WHEN forecast_month = {i} THEN ' (P)' ELSE '' END" if mark else ""
        cells.append(f"""{money(f'"{m}"', negative)}{suffix} AS "{m}\"""")
    cells.append(f"""{money("total", negative)} AS total""")
    return ", ".join(cells)


def matrix_text(source: str) -> str:
    return f"SELECT row_type, label, rank, {text_months()} FROM {source}"


def bundle(key: str = "unit", ledger: str = LEDGER) -> str:
    keys = f"{key}, " if key else ""
    return f"""{all_ctes(key, ledger=ledger)},
bundle AS (
    SELECT {keys}'expense' AS section, row_type, label, rank, {MONTHS}, total, forecast_month
    FROM expense
    UNION ALL
    SELECT {keys}'revenue', row_type, label, rank, {MONTHS}, total, forecast_month FROM revenue
    UNION ALL
    SELECT {keys}'surplus', 'detail', label, rank, {MONTHS}, total, CAST(NULL AS INTEGER)
    FROM surplus
)"""


BUNDLE = bundle()


def html_lines(key: str = "unit") -> str:
    """CTE ``lines``: body rows and an opening line per section and unit."""
    keys = f"{key}, " if key else ""

    def cell(column: str) -> str:
        return (
            f"'<td>' || replace(replace(replace(coalesce({column}, ''), '&', '&amp;'), "
            f"'<', '&lt;'), '>', '&gt;') || '</td>'"
        )

    columns = ["label", *(f'"{m}"' for m in MONTH_LABELS), "total"]
    row = " || ".join(cell(c) for c in columns)
    heading = "".join(f"<th>{c}</th>" for c in ["label", *MONTH_LABELS, "total"])
    opening = f'<table border="1"><thead><tr align="center">{heading}</tr></thead><tbody>'
    return f"""texts AS (
    SELECT {keys}section, rank, label, {text_months()} FROM bundle WHERE section <> 'surplus'
    UNION ALL
    SELECT {keys}section, rank, label, {text_months("inner")} FROM bundle WHERE section = 'surplus'
),
lines AS (
    SELECT {keys}section, rank, label,
           '<tr>' || {row} || '</tr>'
           || CASE WHEN rank = max(rank) OVER (PARTITION BY {keys}section)
                    AND (rank = 99 OR section = 'surplus')
                   THEN '</tbody></table>' ELSE '' END AS html
    FROM texts
    UNION ALL
    SELECT DISTINCT {keys}section, 0, '', '{opening}' FROM bundle
)"""


SUB_CODE_MATRIX = f"""{LEDGER},
matrix AS (
    SELECT *, CAST({ROW_TOTAL} AS {MONEY}) AS total FROM (
        SELECT sub_code, {sum_months("month(entry_date)")}
        FROM ledger WHERE year(entry_date) = {{year}} AND kind = 'EXPENSE' GROUP BY sub_code
    )
)"""


def grand_total(year: int) -> str:
    sums = ", ".join(f'CAST(sum("{m}") AS {MONEY}) AS "{m}"' for m in [*MONTH_LABELS, "total"])
    return f"WITH {SUB_CODE_MATRIX.format(year=year)} SELECT {sums}, 'TOTAL' AS label FROM matrix"


PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"
NEGATIVE_PRICE = f"(-{PRICE})"

MONEY_TEXTS = f"""texts AS (
    SELECT o_orderkey, o_orderpriority,
           CASE o_orderpriority
                WHEN '1-URGENT' THEN {money(PRICE)} || ' (P)'
                WHEN '2-HIGH' THEN replace({money(PRICE)}, ' ', chr(160))
                WHEN '3-MEDIUM' THEN {money(NEGATIVE_PRICE, "inner")}
                WHEN '4-NOT SPECIFIED' THEN '(' || {money(PRICE)} || ')'
                ELSE 'n/a ' || o_orderstatus END AS price_text,
           CASE WHEN o_orderstatus = 'F' THEN {money(NEGATIVE_PRICE)}
                WHEN o_orderstatus = 'O' THEN {money(PRICE)}
                WHEN o_orderpriority <> '5-LOW' THEN '' END AS status_text
    FROM orders
)"""


def parsed(column: str) -> str:
    bare = rf"regexp_replace(regexp_replace({column}, '\(.*?\)', '', 'g'), '[R$\s\x{{00A0}}]', '', 'g')"
    return f"TRY_CAST(replace(replace({bare}, '.', ''), ',', '.') AS {MONEY})"


def rejects(column: str) -> str:
    bad = f"trim({column}) <> '' AND {parsed(column)} IS NULL"
    return f"""SELECT o_orderpriority, '{column}' AS column_name, count({column}) AS n_texts,
       count(*) FILTER ({bad}) AS n_rejects, min({column}) FILTER ({bad}) AS first_reject,
       max({column}) FILTER ({bad}) AS last_reject
FROM texts GROUP BY o_orderpriority"""


LINE_AMOUNT = """CASE WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(18,2))
                      WHEN l_returnflag <> 'N' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END"""

POINT_TEXT = """'R$ ' || CASE WHEN amount < 0 THEN '-' ELSE '' END
               || format('{:,.2f}', abs(amount)::DOUBLE)"""


def sign(column: str) -> str:
    return f"CASE WHEN {column} < 0 THEN 'neg' WHEN {column} >= 0 THEN 'pos' END"


def documents(key: str = "unit", ledger: str = LEDGER) -> str:
    keys = f"{key}, " if key else ""
    day = "strftime(DATE '2001-09-15', '%d/%m/%Y')"
    return f"""WITH {bundle(key, ledger)}, {html_lines(key)}
    SELECT {keys}section, rank AS part_rank, label AS part_label,
           CASE WHEN rank = 0 THEN CASE section WHEN 'expense' THEN 'Expense' WHEN 'revenue' THEN 'Revenue'
                ELSE 'Surplus' END || ' by month' END AS title,
           CASE WHEN rank = 0 THEN 'Budget preview - ' || {day} END AS subject,
           CASE WHEN rank = 0 THEN 'Expense and revenue as of ' || {day} END AS intro, html
    FROM lines"""


SUBCENT = item_ledger(
    "'Brand#' || (l_partkey % 20)",
    "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(12,2)))",
)
SUBCENT_MATRIX = f"""WITH {SUBCENT},
raw AS (
    SELECT *, {ROW_TOTAL} AS total FROM (
        SELECT upper(account) AS account, {filtered("sum", "amount", "month(entry_date)")}
        FROM ledger WHERE year(entry_date) = 2001 GROUP BY 1
    )
)
SELECT 'detail' AS row_type, account AS label, {EXPENSE_RANK.format('account')} AS rank,
       {", ".join(f'CAST("{m}" AS {MONEY}) AS "{m}"' for m in [*MONTH_LABELS, "total"])},
       CAST(NULL AS INTEGER) AS forecast_month
FROM raw
UNION ALL
{total_row("raw", "", "")}"""
LONG = item_ledger(
    "concat_ws('-', 'item', l_orderkey, l_linenumber, l_partkey, l_suppkey)", "l_extendedprice"
)

ORACLES: dict[str, str] = {
    "year_kind_filter": f"""WITH {LEDGER}
        SELECT entry_date, kind, account, sub_code, amount FROM ledger
        WHERE year(entry_date) = 2001 AND upper(kind) = 'EXPENSE'""",
    "reclassified_month_sum": f"""WITH {LEDGER}, {revenue_sums("")}
        SELECT account, strftime(month, '%Y-%m') AS month, amount FROM sums""",
    "month_account_grid": f"""WITH {LEDGER}, {dense_cells("unit")}
        SELECT unit, account, month, month AS month_again FROM grid""",
    "densified_cells": f"WITH {LEDGER}, {dense_cells('unit')} SELECT * FROM dense",
    "previous_month_value": f"WITH {LEDGER}, {dense_cells('unit')} SELECT * FROM lagged",
    "carried_cells": f"WITH {LEDGER}, {dense_cells('unit')} SELECT * FROM carried",
    "revenue_pivot": f"""WITH {LEDGER}, {dense_cells("unit")}
        SELECT unit, account, {sum_months()}
        FROM carried WHERE amount IS NOT NULL GROUP BY unit, account""",
    "forecast_text_pivot": f"""WITH {LEDGER}, {dense_cells("unit")}, texts AS (
            SELECT unit, account, month,
                   {money("amount")} || CASE WHEN is_forecast THEN ' (P)' ELSE '' END AS text
            FROM carried WHERE amount IS NOT NULL
        ) SELECT unit, account, {filtered("max", "text")} FROM texts GROUP BY unit, account""",
    "row_totals": f"""WITH {SUB_CODE_MATRIX.format(year=2001)}
        SELECT sub_code, total, coalesce({MONTHS}) IS NOT NULL AS any_value FROM matrix""",
    "grand_total_row": grand_total(2001),
    "empty_grand_total": grand_total(1990),
    "ranked_accounts": f"""WITH {LEDGER}, sums AS (
            SELECT upper(account) AS label, CAST(sum(amount) AS {MONEY}) AS amount
            FROM ledger WHERE kind = 'EXPENSE' GROUP BY 1
        ) SELECT label, amount, {EXPENSE_RANK.format("label")} AS rank FROM sums""",
    "month_labels": f"""WITH {LEDGER}, months AS (
            SELECT CAST(date_trunc('month', entry_date) AS DATE) AS month,
                   count(*) AS n_postings, max(entry_date) AS last_day
            FROM ledger GROUP BY 1
        ) SELECT month, CAST(year(month) AS INTEGER) AS year, strftime(month, '%Y-%m') AS month_key,
                 strftime(month, '%Y%m') AS month_number_text,
                 CASE month(month) {" ".join(f"WHEN {i} THEN '{m}'" for i, m in NUMBERED)} END
                     AS month_label,
                 CAST(month - INTERVAL 1 MONTH AS DATE) AS month_before,
                 strftime(last_day, '%d/%m/%Y') AS last_day_text, n_postings
        FROM months""",
    "revenue_matrix": f"WITH {revenue_ctes()} SELECT * FROM revenue",
    "revenue_matrix_text": f"WITH {revenue_ctes()} {matrix_text('revenue')}",
    "expense_matrix": f"WITH {LEDGER}, {expense_ctes()} SELECT * FROM expense",
    "expense_matrix_text": f"WITH {LEDGER}, {expense_ctes()} {matrix_text('expense')}",
    "surplus_row": f"WITH {all_ctes()} SELECT * FROM surplus WHERE rank = 1",
    "surplus_excluding_account": f"WITH {all_ctes()} SELECT * FROM surplus WHERE rank = 2",
    "surplus_excluding_missing_account":
        f"WITH {all_ctes(account='NO SUCH ACCOUNT')} SELECT * FROM surplus",
    "surplus_missing_as_zero": f"WITH {all_ctes(as_zero=True)} SELECT * FROM surplus",
    "surplus_table": f"WITH {all_ctes()} SELECT * FROM surplus",
    "surplus_table_text": f"""WITH {all_ctes()}
        SELECT label, rank, {text_months("inner", mark=False)} FROM surplus""",
    "keyed_revenue_matrix": f"WITH {revenue_ctes('unit')} SELECT * FROM revenue",
    "keyed_expense_matrix": f"WITH {LEDGER}, {expense_ctes('unit')} SELECT * FROM expense",
    "keyed_surplus": f"WITH {all_ctes('unit')} SELECT * FROM surplus",
    "report_bundle": f"WITH {BUNDLE} SELECT * FROM bundle",
    "document_lines": f"WITH {BUNDLE}, {html_lines()} SELECT * FROM lines",
    "report_documents": documents(),
    "delivered_documents": documents(),
    "long_section_documents": documents("", LONG),
    "subcent_expense_matrix": SUBCENT_MATRIX,
    "late_postings_bundle": f"WITH {BUNDLE} SELECT * FROM bundle",
    "streamed_postings_bundle": f"WITH {BUNDLE} SELECT * FROM bundle",
    "rebuilt_months_bundle": f"WITH {BUNDLE} SELECT * FROM bundle",
    "published_report": f"WITH {BUNDLE} SELECT * FROM bundle",
    "stored_ledger_bundle": f"WITH {BUNDLE} SELECT * FROM bundle",
    "stored_surplus": f"WITH {all_ctes('unit')} SELECT * FROM surplus",
    "sql_revenue_matrix_text": f"WITH {revenue_ctes()} SELECT label, rank, {text_months()} FROM revenue",
    "sql_keyed_revenue_text": f"WITH {revenue_ctes('unit')} SELECT unit, label, rank, {text_months()} FROM revenue",
    "sql_expense_matrix_text": f"WITH {LEDGER}, {expense_ctes()} SELECT label, rank, {text_months()} FROM expense",
    "sql_surplus_text": f"WITH {all_ctes()} SELECT label, rank, {text_months('inner', mark=False)} FROM surplus",
    "sql_keyed_surplus_text": f"WITH {all_ctes('unit')} SELECT unit, label, rank, {text_months('inner', mark=False)} FROM surplus",
    "month_cells": f"""WITH {LEDGER}
        SELECT unit, CAST(date_trunc('month', entry_date) AS DATE) AS entry_date, upper(kind) AS kind,
               upper(account) AS account, upper(sub_code) AS sub_code, CAST(sum(amount) AS {MONEY}) AS amount,
               count(*) AS n_postings
        FROM ledger GROUP BY ALL""",
    "left_out": f"""WITH {LEDGER}, {LISTED}, classed AS (
            SELECT amount, CASE WHEN entry_date IS NULL THEN 'no date'
                WHEN year(entry_date) <> 2001 THEN 'other year'
                WHEN upper(kind) NOT IN ('REVENUE', 'EXPENSE') THEN 'other kind'
                WHEN upper(kind) = 'REVENUE' AND NOT (account = 'NATION_6' AND sub_code = '5-LOW')
                     AND upper(account) NOT IN (SELECT account FROM listed) THEN 'unlisted revenue'
                ELSE 'reported' END AS reason
            FROM ledger
        )
        SELECT reason, count(*) FILTER (c.reason IS NOT NULL) AS n_postings, count(amount) AS n_amounts,
               CAST(coalesce(sum(amount), 0) AS DECIMAL(26,8)) AS amount
        FROM (VALUES ('no date'), ('other year'), ('other kind'), ('unlisted revenue'), ('reported')) reasons(reason)
             LEFT JOIN classed c USING (reason) GROUP BY reason""",
    "money_reject_samples": f"""WITH {MONEY_TEXTS}, rejected AS (
            SELECT o_orderpriority, 'price_text' AS column_name, price_text AS reject FROM texts
            WHERE trim(price_text) <> '' AND {parsed('price_text')} IS NULL
            UNION ALL
            SELECT o_orderpriority, 'status_text', status_text FROM texts
            WHERE trim(status_text) <> '' AND {parsed('status_text')} IS NULL
        )
        SELECT o_orderpriority, column_name, reject, count(*) AS n_rows,
               CAST(row_number() OVER (PARTITION BY o_orderpriority, column_name ORDER BY md5(reject)) AS INTEGER) AS sample
        FROM rejected GROUP BY o_orderpriority, column_name, reject QUALIFY sample <= 4""",
    "sql_functions": f"""
        SELECT o_orderkey, {money("amount")} AS outer_text, {money("negative", "inner")} AS inner_text,
               CAST(negative AS {MONEY}) AS parsed, CAST(NULL AS {MONEY}) AS rejected,
               CASE month(day) {" ".join(f"WHEN {i} THEN '{m}'" for i, m in NUMBERED)} END AS month_name,
               CAST(date_trunc('month', day) AS DATE) AS month, upper(o_orderstatus) AS label,
               CASE WHEN o_custkey % 9 <= 5 THEN o_custkey % 9 + 1 WHEN o_custkey % 9 = 6 THEN 8 ELSE 98 END::INTEGER AS revenue_rank,
               CASE WHEN o_custkey % 20 BETWEEN 1 AND 12 THEN o_custkey % 20 ELSE 98 END::INTEGER AS expense_rank,
               CASE WHEN o_custkey % 9 = 6 AND o_orderpriority = '5-LOW' THEN 'INVESTMENT' ELSE 'NATION_' || o_custkey % 9 END AS account,
               date_trunc('month', day) = DATE '2001-08-01' AND o_custkey % 9 <> 4 AS may_forecast
        FROM (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, -CAST(o_totalprice AS DECIMAL(18,2)) AS negative,
                     CAST(o_orderdate AS DATE) AS day FROM orders)""",
    "surplus_of_written_matrices": f"WITH {all_ctes()} SELECT * FROM surplus",
    "written_report_roundtrip": f"WITH {BUNDLE} SELECT * FROM bundle",
    "money_format": f"""WITH amounts AS (
            SELECT l_orderkey, l_linenumber, {LINE_AMOUNT} AS amount FROM lineitem
        ) SELECT l_orderkey, l_linenumber, {money("amount")} AS outer_text,
                 {money("amount", "inner")} AS inner_text, {POINT_TEXT} AS point_text
        FROM amounts""",
    "money_parse": f"""WITH {MONEY_TEXTS}
        SELECT o_orderkey, o_orderpriority, {parsed("price_text")} AS price_text,
               {parsed("status_text")} AS status_text FROM texts""",
    "money_parse_rejects":
        f"WITH {MONEY_TEXTS} {rejects('price_text')} UNION ALL {rejects('status_text')}",
    "sign_class": f"""WITH {all_ctes("unit")}
        SELECT unit, label, {", ".join(
            f'{sign(f"{chr(34)}{m}{chr(34)}")} AS "{m}"' for m in [*MONTH_LABELS, "total"]
        )} FROM surplus""",
    "case_insensitive_accounts": f"WITH {LEDGER}, {revenue_sums('')} SELECT * FROM sums",
    "named_query": f"""WITH {revenue_ctes()}
        SELECT label, {text_months()} FROM revenue""",
    "named_expense_query": f"""WITH {LEDGER}, {expense_ctes()}
        SELECT label, {text_months()} FROM expense""",
    "named_surplus_query": f"""WITH {all_ctes("unit")}
        SELECT unit, label, {text_months("inner", mark=False)} FROM surplus""",
    "named_sql_query": f"""WITH {LEDGER}
        SELECT sub_code, CAST(sum(amount) AS {MONEY}) AS amount
        FROM ledger WHERE year(entry_date) = 2001 AND kind = 'EXPENSE' GROUP BY sub_code""",
}
