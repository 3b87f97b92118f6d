"""The registered queries in ANSI SQL over the same tables, for cross-checking.

Written out independently of the Spark expressions: the lookup tables are joined
here, and the exact tests are integer inequalities.
"""

from __future__ import annotations

_TX = """tx AS (
  SELECT CAST(o.o_orderdate AS DATE) AS date,
    CASE WHEN l.l_linenumber = 7 AND l.l_suppkey % 10 = 3 THEN NULL
         WHEN l.l_suppkey % 7 = 0 THEN CAST(l.l_quantity * 10 AS DECIMAL(18,2))
         WHEN l.l_suppkey % 7 = 1 THEN CAST(p.p_retailprice AS DECIMAL(18,2))
         WHEN l.l_suppkey % 7 = 2 THEN CAST(p.p_retailprice + 500 AS DECIMAL(18,2))
         WHEN l.l_suppkey % 7 = 3 THEN CAST(p.p_retailprice + 2000 AS DECIMAL(18,2))
         WHEN l.l_suppkey % 7 = 4 THEN CAST(p.p_retailprice + 6000 AS DECIMAL(18,2))
         WHEN l.l_suppkey % 7 = 5 THEN CAST(p.p_retailprice + 15000 AS DECIMAL(18,2))
         ELSE CAST(l.l_extendedprice AS DECIMAL(18,2)) END AS amount,
    CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'payment01'
         WHEN o.o_orderpriority = '3-MEDIUM' THEN 'payment02'
         WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN 'payment03'
         WHEN l.l_linenumber <= 5 THEN 'payment04'
         WHEN l.l_linenumber = 6 THEN 'payment99' END AS payment_method,
    CASE WHEN o.o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN NULL
         WHEN l.l_returnflag = 'A' THEN 'type01'
         WHEN l.l_returnflag = 'R' THEN 'type02'
         WHEN l.l_linenumber <= 4 THEN 'type01' END AS card_type,
    CASE WHEN o.o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN NULL
         WHEN p.p_size % 6 <= 3 THEN 'brand0' || CAST(p.p_size % 6 + 1 AS VARCHAR)
         WHEN p.p_size % 6 = 4 THEN 'other' END AS card_brand,
    CASE WHEN c.c_nationkey % 5 IN (0, 1) THEN 'A029'
         WHEN c.c_nationkey % 5 = 4 THEN NULL
         ELSE 'A100' END AS card_country_issuer_code,
    CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL
         WHEN l.l_linenumber = 1 THEN 'b03'
         WHEN l.l_linenumber = 2 THEN 'b04'
         WHEN l.l_linenumber = 3 THEN 'b05'
         WHEN l.l_linenumber = 4 THEN 'b06'
         WHEN l.l_linenumber = 5 THEN 'b12'
         WHEN l.l_linenumber = 6 THEN 'b14'
         WHEN l.l_linenumber = 7 AND l.l_returnflag = 'A' THEN 'b15'
         WHEN l.l_returnflag = 'R' THEN 'b99' END AS backend_name,
    CASE WHEN l.l_suppkey % 8 <> 7 THEN CAST(l.l_suppkey % 31 AS INTEGER) END
      AS merchant_category_id
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

_MCC = """mcc AS (
  SELECT n_nationkey AS id,
    CASE WHEN n_nationkey % 9 <> 8
         THEN lpad(CAST(n_nationkey * 211 + 742 AS VARCHAR), 4, '0') END AS code
  FROM nation
)"""

_LARGE_MCC = """mcc AS (
  SELECT CASE WHEN p_partkey % 10 = 9 THEN p_partkey - 1 ELSE p_partkey END AS id,
    CASE WHEN p_partkey % 7 = 3 THEN '' WHEN p_partkey % 9 <> 8
         THEN lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0') END AS code
  FROM part
)"""

_DATED_MCC = """dated AS (
  SELECT CAST(p_partkey % 34 AS INTEGER) AS id,
    CASE WHEN p_partkey % 11 = 5 THEN '' WHEN p_partkey % 9 <> 8
         THEN lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0') END AS code,
    CASE WHEN p_partkey % 200 <> 7
         THEN DATE '1992-06-01' + CAST((p_partkey * 37) % 2200 AS INTEGER) END AS valid_from
  FROM part
),
versions AS (
  SELECT id, coalesce(valid_from, DATE '0001-01-01') AS starts, max(code) AS code
  FROM dated GROUP BY 1, 2
)"""

_FEES = """fee_periods AS (
  SELECT CAST(s_suppkey % 33 AS INTEGER) AS id,
    'fee' || CAST(s_suppkey % 7 AS VARCHAR) AS fee_code,
    CAST((s_suppkey % 50) / 1000 AS DECIMAL(6,4)) AS rate,
    CASE WHEN s_suppkey % 13 <> 0
         THEN DATE '1992-01-01' + CAST((s_suppkey * 53) % 2500 AS INTEGER) END AS starts,
    CASE WHEN s_suppkey % 11 <> 0
         THEN DATE '1992-01-01'
           + CAST((s_suppkey * 53) % 2500 + power(s_suppkey % 10, 3) - 1 AS INTEGER) END AS ends
  FROM supplier
)"""

_FEE_JOIN = """tx t JOIN fee_periods f ON t.merchant_category_id = f.id
  AND (f.starts IS NULL OR f.starts <= t.date) AND (f.ends IS NULL OR t.date < f.ends)
  AND (f.starts < f.ends OR f.starts IS NULL OR f.ends IS NULL)"""

# The code in force on the day of each transaction, by DuckDB's own as-of join.
_AS_OF = """SELECT t.date, t.amount, t.merchant_category_id, v.code
FROM tx t ASOF LEFT JOIN versions v
  ON t.merchant_category_id = v.id AND t.date >= v.starts"""

# Transactions with the keys of their order and customer.
_KEYED_TX = _TX.replace(
    "SELECT CAST(o.o_orderdate",
    "SELECT l.l_orderkey, l.l_suppkey, o.o_orderkey, o.o_custkey, CAST(o.o_orderdate",
)

# As the reader is to give them: malformed dates and amounts are null, ids as they stand.
_ROUGH_TX = """rough AS (
  SELECT l_suppkey, l_linenumber,
    l_linenumber = 6 AND l_suppkey % 3 = 0 AS bad_date,
    l_suppkey % 20 = 7 AS bad_amount,
    CASE WHEN NOT (l_linenumber = 6 AND l_suppkey % 3 = 0)
         THEN DATE '2018-12-01' + CAST(l_suppkey % 28 AS INTEGER) END AS date,
    CASE WHEN l_suppkey % 20 NOT IN (7, 8)
         THEN CAST(l_extendedprice * l_discount AS DECIMAL(28,6)) END AS amount,
    CASE l_linenumber
      WHEN 1 THEN CAST(l_suppkey + 3000000000 AS VARCHAR)
      WHEN 2 THEN CAST(l_suppkey + 3000000000 AS VARCHAR) || '.0'
      WHEN 3 THEN '000' || CAST(l_suppkey + 3000000000 AS VARCHAR)
      WHEN 4 THEN 'm' || CAST(l_suppkey AS VARCHAR)
      WHEN 5 THEN CAST(l_suppkey + 3000000000 AS VARCHAR) || '.5' END AS merchant_category_id
  FROM lineitem
)"""

_ROUGH_MCC = """rough_mcc AS (
  SELECT s_suppkey, s_suppkey % 2 = 0 AS by_number,
    CAST(s_suppkey + CASE WHEN s_suppkey % 2 = 0 THEN 3000000000 ELSE 9000000000 END AS VARCHAR)
      || '.00' AS number_id,
    lpad(CAST(s_suppkey % 10000 AS VARCHAR), 4, '0') AS number_code,
    'm' || CAST(s_suppkey AS VARCHAR) AS name_id,
    lpad(CAST((s_suppkey + 5000) % 10000 AS VARCHAR), 4, '0') AS name_code
  FROM supplier
)"""

# Prescribed by the report's rules, must not be changed.
_TABLES = """service_types(payment_method, service_system_type) AS (
  VALUES ('payment01', 'CPF'), ('payment02', 'OTH'), ('payment03', 'OTH'), ('payment04', 'OTH')
),
business_types(card_brand, merchant_business_type) AS (
  VALUES ('brand01', '30101'), ('brand02', '30102'), ('brand03', '30103'), ('brand04', '30104')
),
backends(backend_name, backend_code) AS (
  VALUES ('b03', '000004'), ('b04', '000004'), ('b05', '000004'), ('b06', '000004'),
         ('b12', '000001'), ('b14', '000002'), ('b15', '000003')
),
card_types(card_type_lkp, country_lkp, card_brand_lkp, transaction_type_code_lkp) AS (
  VALUES ('type01', 'Local', 'brand01', '010001'), ('type01', 'Local', 'brand02', '010002'),
         ('type01', 'Local', 'brand03', '010003'), ('type01', 'Local', 'other', '010004'),
         ('type01', 'Inter', 'brand01', '010011'), ('type01', 'Inter', 'brand02', '010012'),
         ('type01', 'Inter', 'brand03', '010013'), ('type01', 'Inter', 'other', '010014'),
         ('type02', 'Local', 'brand01', '010021'), ('type02', 'Local', 'brand02', '010022'),
         ('type02', 'Local', 'brand03', '010023'), ('type02', 'Local', 'other', '010024'),
         ('type02', 'Inter', 'brand01', '010031'), ('type02', 'Inter', 'brand02', '010032'),
         ('type02', 'Inter', 'brand03', '010033'), ('type02', 'Inter', 'other', '010034')
)"""

# Every transaction with every derived column, under both profiles.
_ENRICHED = """enriched AS (
  SELECT t.*,
    strftime(last_day(t.date), '%Y-%m-%d') AS month_end,
    coalesce(s.service_system_type, '') AS service_system_type,
    CASE WHEN s.service_system_type = 'CPF' THEN coalesce(b.merchant_business_type, '')
         ELSE '' END AS merchant_business_type,
    CASE WHEN m.code IS NULL AND s.service_system_type = 'CPF' THEN '9999'
         ELSE m.code END AS merchant_category_code,
    CASE WHEN nullif(m.code, '') IS NULL AND s.service_system_type = 'CPF' THEN '9999'
         ELSE nullif(m.code, '') END AS merchant_category_code_specified,
    CASE WHEN t.card_country_issuer_code = 'A029' THEN 'Local' ELSE 'Inter' END AS card_country,
    coalesce(k.backend_code, '099999') AS backend_transaction_type,
    coalesce(ci.transaction_type_code_lkp, '099999') AS transaction_type_implemented,
    CASE WHEN t.payment_method = 'payment01'
         THEN CASE WHEN t.card_country_issuer_code IS NULL THEN '099999'
                   ELSE coalesce(cs.transaction_type_code_lkp, '099999') END
         ELSE coalesce(k.backend_code, '099999') END AS transaction_type_specified
  FROM tx t
  LEFT JOIN service_types s ON t.payment_method = s.payment_method
  LEFT JOIN business_types b ON t.card_brand = b.card_brand
  LEFT JOIN backends k ON t.backend_name = k.backend_name
  LEFT JOIN mcc m ON t.merchant_category_id = m.id
  LEFT JOIN card_types ci
    ON t.card_type = ci.card_type_lkp AND t.card_brand = ci.card_brand_lkp
   AND CASE WHEN t.card_country_issuer_code = 'A029' THEN 'Local' ELSE 'Inter' END = ci.country_lkp
  LEFT JOIN card_types cs
    ON t.card_type = cs.card_type_lkp
   AND CASE WHEN t.card_brand IN ('brand01', 'brand02', 'brand03') THEN t.card_brand
            WHEN t.card_brand IS NOT NULL THEN 'other' END = cs.card_brand_lkp
   AND CASE WHEN t.card_country_issuer_code = 'A029' THEN 'Local' ELSE 'Inter' END = cs.country_lkp
)"""

_KEYS = (
    "date, service_system_type, transaction_type, merchant_business_type, merchant_category_code"
)

_CATEGORY = {
    "implemented": "merchant_category_code",
    "specified": "merchant_category_code_specified",
}

_COUNTED = {"implemented": "count(amount)", "specified": "count(*)"}

# Half-up average in cents, in whole numbers: floor((2*|cents| + n) / (2*n)).
_AVERAGE = """CAST(CASE WHEN number > 0 THEN
      sign(amount) * ((2 * CAST(abs(amount) * 100 AS HUGEINT) + number) // (2 * number)) END
    AS DECIMAL(20,0)) / 100"""


def _within(profile: str, bound: int) -> str:
    if profile == "implemented":
        return f"1000 * amount < {1000 * bound + 5} * number"
    return f"amount <= {bound} * number"


def _amount_range(profile: str) -> str:
    # The prescribed range codes.
    codes = {
        500: "94560000001",
        1000: "94560000002",
        2000: "94560000003",
        5000: "94560000004",
        10000: "94560000005",
        30000: "94560000006",
    }
    cases = " ".join(f"WHEN {_within(profile, b)} THEN '{code}'" for b, code in codes.items())
    return f"CASE WHEN amount IS NULL THEN NULL {cases} ELSE '94560000007' END"


def _grouped(profile: str) -> str:
    return f"""grouped AS (
  SELECT month_end AS date, service_system_type,
    transaction_type_{profile} AS transaction_type,
    merchant_business_type, {_CATEGORY[profile]} AS merchant_category_code,
    CAST(sum(amount) AS DECIMAL(34,2)) AS amount, {_COUNTED[profile]} AS number
  FROM enriched GROUP BY 1, 2, 3, 4, 5
)"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def _rows(columns: str, mcc: str = _MCC) -> str:
    return _with(_TX, mcc, _TABLES, _ENRICHED, select=f"SELECT {columns} FROM enriched")


def _report(profile: str, where: str = "", mcc: str = _MCC) -> str:
    return _with(
        _TX,
        mcc,
        _TABLES,
        _ENRICHED,
        _grouped(profile),
        select=f"""SELECT '42' AS fi_code, {_KEYS}, amount, number,
  {_amount_range(profile)} AS terminal_average_amount_range
FROM grouped {where}""",
    )


def _group_totals(profile: str) -> str:
    return _with(
        _TX,
        _MCC,
        _TABLES,
        _ENRICHED,
        _grouped(profile),
        select=f"""SELECT {_KEYS}, amount, number,
  CAST({_AVERAGE} AS DECIMAL(20,2)) AS average_amount
FROM grouped""",
    )


def _ranges(profile: str) -> str:
    return _with(
        _TX,
        f"""grouped AS (
  SELECT strftime(last_day(date), '%Y-%m-%d') AS date, merchant_category_id,
    CAST(sum(amount) AS DECIMAL(34,2)) AS amount, {_COUNTED[profile]} AS number
  FROM tx GROUP BY 1, 2
)""",
        select=f"""SELECT date, merchant_category_id, amount, number,
  {_amount_range(profile)} AS terminal_average_amount_range
FROM grouped""",
    )


def _read_back(profile: str) -> str:
    """The report as it reads from a file, where empty and null are the same."""
    return f"""SELECT fi_code, date,
  nullif(service_system_type, '') AS service_system_type,
  transaction_type,
  nullif(merchant_business_type, '') AS merchant_business_type,
  merchant_category_code, amount, number, terminal_average_amount_range
FROM ({_report(profile)}) AS report"""


_TX_COLUMNS = (
    "date, amount, payment_method, card_type, card_brand, card_country_issuer_code, "
    "backend_name, merchant_category_id"
)
_CARD_COLUMNS = "payment_method, card_type, card_brand, card_country_issuer_code, backend_name"


def _first_rows(table: str, source: str, columns: str) -> str:
    order = ", ".join(f"{name.strip()} ASC NULLS FIRST" for name in columns.split(","))
    return _with(source, select=f"SELECT {columns} FROM {table} ORDER BY {order} LIMIT 5")


def _reconciliation() -> str:
    keys = [key.strip() for key in _KEYS.split(",")]
    same = " AND ".join(f"a.{key} IS NOT DISTINCT FROM b.{key}" for key in keys)
    merged = ", ".join(f"CASE WHEN a.n IS NULL THEN b.{key} ELSE a.{key} END AS {key}" for key in keys)
    return f"""SELECT {merged}, coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows,
  a.amount AS left_amount, b.amount AS right_amount,
  coalesce(a.number, 0) AS left_number, coalesce(b.number, 0) AS right_number,
  CAST(coalesce(b.amount, 0) - coalesce(a.amount, 0) AS DECIMAL(34,2)) AS amount_difference,
  coalesce(b.number, 0) - coalesce(a.number, 0) AS number_difference,
  CASE WHEN b.n IS NULL THEN 'left only' WHEN a.n IS NULL THEN 'right only'
       WHEN a.amount IS NOT DISTINCT FROM b.amount AND a.number = b.number THEN 'equal'
       ELSE 'differs' END AS status
FROM (SELECT *, 1::BIGINT AS n FROM ({_report("implemented")})) AS a
FULL OUTER JOIN (SELECT *, 1::BIGINT AS n FROM ({_report("specified")})) AS b ON {same}"""


def _row_differences() -> str:
    left, right = _report("implemented"), _report("specified")
    sides = [
        f"""SELECT *, '{name}' AS side, count(*) AS times
FROM (SELECT * FROM ({a}) AS a EXCEPT ALL SELECT * FROM ({b}) AS b) AS more GROUP BY ALL"""
        for name, a, b in (("left", left, right), ("right", right, left))
    ]
    return " UNION ALL ".join(sides)


def _subtotals() -> str:
    return _with(
        _TX,
        _MCC,
        _TABLES,
        _ENRICHED,
        f"""grouped AS (
  SELECT month_end AS date, service_system_type, transaction_type_specified AS transaction_type,
    merchant_business_type, merchant_category_code,
    CAST(grouping(month_end, service_system_type, transaction_type_specified,
      merchant_business_type, merchant_category_code) AS BIGINT) AS level,
    CAST(sum(amount) AS DECIMAL(34,2)) AS amount, count(*) AS number
  FROM enriched GROUP BY ROLLUP (month_end, service_system_type, transaction_type_specified,
    merchant_business_type, merchant_category_code)
)""",
        select=f"""SELECT {_KEYS}, level, amount, number,
  CAST({_AVERAGE} AS DECIMAL(20,2)) AS average_amount FROM grouped""",
    )


# Calendar months are made from all months there are, by a plain join of months and keys.
_TRAILING_YEAR = _with(
    _TX,
    """totals AS (
  SELECT date_trunc('month', date) AS month, merchant_category_id, payment_method,
    sum(amount) AS amount, count(*) AS number
  FROM tx WHERE date IS NOT NULL GROUP BY 1, 2, 3
)""",
    """bounds AS (
  SELECT merchant_category_id, payment_method, min(month) AS low, max(month) AS high
  FROM totals GROUP BY 1, 2
)""",
    """months AS (
  SELECT b.merchant_category_id, b.payment_method,
    unnest(generate_series(CAST(b.low AS TIMESTAMP),
      CAST(b.high + INTERVAL 11 MONTH AS TIMESTAMP), INTERVAL 1 MONTH)) AS month
  FROM bounds b
)""",
    """filled AS (
  SELECT m.month, m.merchant_category_id, m.payment_method,
    coalesce(t.amount, 0) AS amount, coalesce(t.number, 0) AS number
  FROM months m LEFT JOIN totals t ON t.month = m.month
    AND t.merchant_category_id IS NOT DISTINCT FROM m.merchant_category_id
    AND t.payment_method IS NOT DISTINCT FROM m.payment_method
)""",
    select="""SELECT strftime(last_day(CAST(f.month AS DATE)), '%Y-%m-%d') AS date,
  f.merchant_category_id, f.payment_method,
  CAST(f.amount AS DECIMAL(34,2)) AS amount, CAST(f.number AS BIGINT) AS number,
  CAST(sum(f.amount) OVER year_back AS DECIMAL(34,2)) AS trailing_amount,
  CAST(sum(f.number) OVER year_back AS BIGINT) AS trailing_number
FROM filled f
WINDOW year_back AS (PARTITION BY merchant_category_id, payment_method ORDER BY month
  RANGE BETWEEN INTERVAL 11 MONTH PRECEDING AND CURRENT ROW)""",
)

_SERVICE_TYPE = """LEFT JOIN service_types s ON t.payment_method = s.payment_method"""


def _customers(until: str) -> str:
    return _with(
        _KEYED_TX,
        _TABLES,
        select=f"""SELECT strftime({until}, '%Y-%m-%d') AS date,
  coalesce(s.service_system_type, '') AS service_system_type,
  count(DISTINCT t.o_custkey) AS customers
FROM tx t {_SERVICE_TYPE} WHERE t.date IS NOT NULL GROUP BY 1, 2""",
    )


_QUARTER_END = "last_day(CAST(date_trunc('quarter', t.date) + INTERVAL 2 MONTH AS DATE))"

# Items as they come back: unreadable dates and amounts are null, orders without items one row.
_ITEMS = f"""items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS payment_id,
    CASE WHEN o_orderkey % 40 <> 3 THEN date END AS date,
    CASE WHEN l_suppkey % 20 <> 7 THEN CAST(amount AS DECIMAL(28,6)) END AS amount,
    payment_method, card_type, card_brand, card_country_issuer_code, backend_name,
    CAST(merchant_category_id AS VARCHAR) AS merchant_category_id,
    CASE WHEN o_orderkey % 40 = 3 THEN strftime(date, '%d/%m/%Y') END AS bad_date,
    CASE WHEN l_suppkey % 20 = 7 THEN CAST(amount AS VARCHAR) || 'x' END AS bad_amount
  FROM tx
)"""

_MONTHS = _with(
    _TX, select="SELECT DISTINCT strftime(last_day(date), '%Y-%m-%d') AS date FROM tx"
)

ORACLE_SQL: dict[str, str] = {
    "tx_scan": _with(_TX, select=f"SELECT {_TX_COLUMNS} FROM tx"),
    "mcc_scan": _with(_MCC, select="SELECT id, code FROM mcc"),
    # From files, amounts come in the reader's type and ids as text.
    "tx_csv_scan": _with(
        _TX,
        select="""SELECT date, CAST(amount AS DECIMAL(28,6)) AS amount, payment_method, card_type,
  card_brand, card_country_issuer_code, backend_name,
  CAST(merchant_category_id AS VARCHAR) AS merchant_category_id FROM tx""",
    ),
    "mcc_csv_scan": _with(_MCC, select="SELECT CAST(id AS VARCHAR) AS id, code FROM mcc"),
    "rough_tx_csv_scan": _with(
        _ROUGH_TX,
        select="""SELECT date, amount, 'payment01' AS payment_method, 'type01' AS card_type,
  'brand01' AS card_brand, 'A029' AS card_country_issuer_code,
  CAST(NULL AS VARCHAR) AS backend_name, merchant_category_id FROM rough""",
    ),
    "rough_mcc_csv_scan": _with(
        _ROUGH_MCC,
        select="""SELECT number_id AS id, number_code AS code FROM rough_mcc
UNION ALL SELECT name_id, name_code FROM rough_mcc""",
    ),
    "rejected_values": _with(
        _ROUGH_TX,
        select="""SELECT count(*) AS records,
  count(*) FILTER (WHERE bad_date OR bad_amount) AS rejected,
  count(*) FILTER (WHERE bad_date) AS without_date,
  count(*) FILTER (WHERE bad_amount OR (bad_date AND amount IS NULL)) AS without_amount
FROM rough""",
    ),
    "tx_type_lookup": _with(
        _TX,
        _TABLES,
        select="""SELECT c.card_type_lkp, c.country_lkp, c.card_brand_lkp,
  c.transaction_type_code_lkp, count(t.card_type) AS transactions
FROM card_types c
LEFT JOIN tx t ON t.card_type = c.card_type_lkp AND t.card_brand = c.card_brand_lkp
  AND CASE WHEN t.card_country_issuer_code = 'A029' THEN 'Local' ELSE 'Inter' END = c.country_lkp
GROUP BY 1, 2, 3, 4""",
    ),
    "fi_code": _with(_TX, select=f"SELECT '42' AS fi_code, {_TX_COLUMNS} FROM tx"),
    "month_end_date": _rows("date AS transaction_date, month_end AS date"),
    "service_system_type": _rows("payment_method, service_system_type"),
    "merchant_business_type": _rows("service_system_type, card_brand, merchant_business_type"),
    "card_country": _rows("card_country_issuer_code, card_country"),
    "backend_transaction_type": _rows("backend_name, backend_transaction_type"),
    "merchant_category_code": _rows(
        "merchant_category_id, service_system_type, merchant_category_code"
    ),
    "merchant_category_code_shuffled": _rows(
        "merchant_category_id, service_system_type, merchant_category_code", _LARGE_MCC
    ),
    "merchant_category_code_text_ids": _with(
        _ROUGH_TX,
        _ROUGH_MCC,
        select="""SELECT merchant_category_id, 'CPF' AS service_system_type,
  coalesce(CASE WHEN l_linenumber IN (1, 2, 3) AND by_number THEN number_code
                WHEN l_linenumber = 4 THEN name_code END, '9999') AS merchant_category_code
FROM rough LEFT JOIN rough_mcc ON l_suppkey = s_suppkey""",
    ),
    "transaction_type": _rows(
        f"{_CARD_COLUMNS}, transaction_type_implemented AS transaction_type"
    ),
    "transaction_type_as_specified": _rows(
        f"{_CARD_COLUMNS}, transaction_type_specified AS transaction_type"
    ),
    "mcc_duplicate_ids": _with(
        _LARGE_MCC,
        select="""SELECT CAST(id AS VARCHAR) AS id, count(*) AS occurrences FROM mcc
WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1""",
    ),
    "category_code_as_of": _with(_TX, _DATED_MCC, select=_AS_OF),
    "category_code_as_of_sorted": _with(_TX, _DATED_MCC, select=_AS_OF),
    # The versions' code in place of the category's; every other rule as in the report.
    "report_with_dated_categories": _report("specified", mcc=_DATED_MCC).replace(
        "LEFT JOIN mcc m ON t.merchant_category_id = m.id",
        """ASOF LEFT JOIN versions m
    ON t.merchant_category_id = m.id AND t.date >= m.starts""",
    ),
    "fee_period_join": _with(
        _TX,
        _FEES,
        select=f"""SELECT t.date, t.amount, t.merchant_category_id, f.fee_code, f.rate
FROM {_FEE_JOIN}""",
    ),
    "fee_period_join_shuffled": _with(
        _TX,
        _FEES,
        select=f"""SELECT t.date, t.amount, t.merchant_category_id, f.fee_code, f.rate
FROM {_FEE_JOIN}""",
    ),
    "fee_totals": _with(
        _TX,
        _FEES,
        select=f"""SELECT strftime(last_day(t.date), '%Y-%m-%d') AS date, f.fee_code,
  CAST(sum(round(t.amount * f.rate, 2)) AS DECIMAL(34,2)) AS fees, count(*) AS records
FROM {_FEE_JOIN} GROUP BY 1, 2""",
    ),
    "monthly_totals": _with(
        _TX,
        _TABLES,
        select="""SELECT strftime(last_day(t.date), '%Y-%m-%d') AS date,
  coalesce(s.service_system_type, '') AS service_system_type,
  CAST(sum(t.amount) AS DECIMAL(34,2)) AS amount, count(t.amount) AS number
FROM tx t LEFT JOIN service_types s ON t.payment_method = s.payment_method
GROUP BY 1, 2""",
    ),
    "group_totals": _group_totals("implemented"),
    "group_totals_as_specified": _group_totals("specified"),
    "terminal_average_amount_range": _ranges("implemented"),
    "terminal_average_amount_range_as_specified": _ranges("specified"),
    "report_as_implemented": _report("implemented"),
    "report_as_specified": _report("specified"),
    "report_with_large_categories": _report("specified", mcc=_LARGE_MCC),
    "report_months": _MONTHS,
    "report_for_month": _report("implemented", "WHERE date = '1998-12-31'"),
    "report_file_names": f"""SELECT date, 'ACME_' || replace(date, '-', '') || '.csv' AS file_name
FROM ({_MONTHS}) AS months""",
    "report_record_count": f"""SELECT count(*) AS reporting_records
FROM ({_report("implemented")}) AS report""",
    "input_counts": _with(
        _TX,
        _MCC,
        select="""SELECT 'transactions' AS input, count(*) AS records FROM tx
UNION ALL SELECT 'merchant_categories', count(*) FROM mcc""",
    ),
    "tx_preview": _first_rows("tx", _TX, _TX_COLUMNS),
    "mcc_preview": _first_rows("mcc", _MCC, "id, code"),
    "report_csv_roundtrip": _read_back("implemented"),
    "report_csv_roundtrip_as_specified": _read_back("specified"),
    "report_csv_plain_roundtrip": _read_back("implemented"),
    "report_streamed": _read_back("implemented"),
    "report_reconciliation": _reconciliation(),
    "report_row_differences": _row_differences(),
    "report_subtotals": _subtotals(),
    "trailing_year": _TRAILING_YEAR,
    "top_categories_of_month": _with(
        _TX,
        """totals AS (
  SELECT strftime(last_day(date), '%Y-%m-%d') AS date, merchant_category_id,
    CAST(sum(amount) AS DECIMAL(34,2)) AS amount, count(*) AS number
  FROM tx WHERE date IS NOT NULL GROUP BY 1, 2
)""",
        select="""SELECT date, merchant_category_id, amount, number, place FROM (
  SELECT *, CAST(rank() OVER (PARTITION BY date ORDER BY amount DESC NULLS LAST) AS INTEGER) AS place
  FROM totals) AS ranked WHERE place <= 3""",
    ),
    "customers_of_month": _customers("last_day(t.date)"),
    "customers_of_quarter": _customers(_QUARTER_END),
    "customers_of_quarter_from_sketches": f"""SELECT date, service_system_type, customers,
  true AS close, true AS bounded FROM ({_customers(_QUARTER_END)}) AS exact""",
    "unmatched_category_ids": _with(
        _TX,
        _MCC,
        select="""SELECT CAST(t.merchant_category_id AS VARCHAR) AS id,
  CASE WHEN t.merchant_category_id IS NULL THEN 'missing id'
       WHEN m.id IS NULL THEN 'unknown id' ELSE 'without code' END AS reason,
  count(*) AS records, CAST(sum(t.amount) AS DECIMAL(34,2)) AS amount
FROM tx t LEFT JOIN mcc m ON t.merchant_category_id = m.id
WHERE m.code IS NULL GROUP BY 1, 2""",
    ),
    "unused_merchant_categories": _with(
        _TX,
        _LARGE_MCC,
        select="""SELECT id, code FROM mcc
WHERE NOT EXISTS (SELECT 1 FROM tx WHERE tx.merchant_category_id = mcc.id)""",
    ),
    "nested_payment_items": _with(
        _KEYED_TX,
        _ITEMS,
        select=f"""SELECT payment_id, {_TX_COLUMNS} FROM items
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(o_orderdate AS DATE), NULL, NULL, NULL, NULL,
  NULL, NULL, NULL
FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
    ),
    "nested_rejected_items": _with(
        _KEYED_TX,
        _ITEMS,
        select="""SELECT payment_id, 'amount' AS field, bad_amount AS value FROM items
WHERE bad_amount IS NOT NULL
UNION ALL SELECT DISTINCT payment_id, 'date', bad_date FROM items WHERE bad_date IS NOT NULL""",
    ),
}
