"""DuckDB SQL that each registered query is compared with.

The views of `legalops.sources.star` are written out again as SQL; every query is
the same WITH prefix and its own final select.
"""

from __future__ import annotations

from legalops.model import MARKUP, TABLES

AS_OF = "DATE '2001-06-30'"

VIEWS = """
client AS (
  SELECT c_custkey AS id_client,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'PERSON'
              WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'ENTREPRENEUR' ELSE 'LEGAL' END AS client_type,
         CAST(DATE '1995-01-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP) AS created_at
  FROM customer
  UNION ALL
  SELECT -s_suppkey - 1, 'LEGAL', CAST(DATE '1995-01-01' + CAST(s_suppkey % 365 AS INTEGER) AS TIMESTAMP)
  FROM supplier
),
client_person AS (
  SELECT c_custkey AS id_client, c_name AS fio,
         CASE WHEN c_acctbal >= -900 THEN substr(lpad(CAST(c_custkey AS VARCHAR), 10, '0'), 1, 4) || ' '
           || substr(lpad(CAST(c_custkey AS VARCHAR), 10, '0'), 5, 6) END AS passport_data,
         lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS inn
  FROM customer WHERE c_mktsegment = 'HOUSEHOLD'
),
client_entrepreneur AS (
  SELECT c_custkey AS id_client, c_name AS fio,
         CASE WHEN c_acctbal < 9900 THEN lpad(CAST(c_custkey AS VARCHAR), CASE WHEN c_acctbal < 9800 THEN 12 ELSE 11 END, '0')
         END AS inn,
         CASE WHEN c_acctbal < 9000 THEN lpad(CAST(c_custkey AS VARCHAR), 14, '0')
           || CAST(CASE WHEN c_acctbal < 0 THEN (c_custkey % 13 % 10 + 1) % 10 ELSE c_custkey % 13 % 10 END AS VARCHAR)
         END AS ogrnip
  FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE')
),
client_legal AS (
  SELECT c_custkey AS id_client, c_name AS company_name, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS inn,
         lpad(CAST(c_custkey AS VARCHAR), 12, '0')
           || CAST(CASE WHEN c_acctbal < 0 THEN (c_custkey % 11 % 10 + 1) % 10 ELSE c_custkey % 11 % 10 END AS VARCHAR)
           AS ogrn,
         CASE WHEN c_acctbal >= -500 THEN 'Representative of ' || c_name END AS representative
  FROM customer WHERE c_mktsegment NOT IN ('HOUSEHOLD', 'BUILDING', 'FURNITURE')
  UNION ALL
  SELECT -s_suppkey - 1, s_name, '9' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0'), NULL,
         'Representative of ' || s_name
  FROM supplier
),
bank AS (
  SELECT '04' || lpad(CAST(n_nationkey AS VARCHAR), 7, '0') AS bik, n_name AS bank_name,
         CAST(NULL AS VARCHAR) AS bank_legal_address,
         '301' || lpad(CAST(n_nationkey AS VARCHAR), 17, '0') AS bank_cor_account
  FROM nation
),
job_position AS (
  SELECT CAST(r_regionkey AS INTEGER) AS id_job_position, r_name AS job_name FROM region
),
employee AS (
  SELECT s_suppkey AS employee_number, s_name AS fio, CAST(s_suppkey % 6 AS INTEGER) AS id_job_position,
         '407' || lpad(CAST(s_suppkey AS VARCHAR), 17, '0') AS account_no,
         '04' || lpad(CAST(s_nationkey AS VARCHAR), 7, '0') AS bik,
         CASE WHEN s_acctbal >= -500 THEN hired - 9131 END AS birth_date, hired AS hire_date,
         CASE WHEN s_acctbal < 0 THEN hired + 400 END AS fire_date,
         CAST(CASE WHEN s_acctbal >= 0 AND s_acctbal < 1000 THEN 12000
              ELSE 50000 + s_suppkey * 7919 % 130001 END AS BIGINT) AS salary,
         CASE WHEN s_acctbal >= 9000 THEN 'U' WHEN s_suppkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender
  FROM (SELECT *, DATE '1994-01-01' + CAST(s_suppkey * 37 % 2500 AS INTEGER) AS hired FROM supplier)
),
bank_account AS (
  SELECT account_no, bik FROM employee
  UNION ALL
  SELECT '408' || lpad(CAST(c_custkey * 3 + slot AS VARCHAR), 17, '0'),
         '04' || lpad(CAST(c_nationkey + CASE WHEN c_acctbal >= 9500 AND slot = 2 THEN 50 ELSE 0 END AS VARCHAR), 7, '0')
  FROM customer, (VALUES (0), (1), (2)) AS s(slot)
),
months AS (
  SELECT *, CAST(unnest(generate_series(CAST(date_trunc('month', hire_date) AS TIMESTAMP),
           CAST(date_trunc('month', least(coalesce(fire_date, {as_of}), {as_of})) AS TIMESTAMP),
           INTERVAL 1 MONTH)) AS DATE) AS month
  FROM employee WHERE account_no IS NOT NULL AND bik IS NOT NULL
),
planned AS (
  SELECT *, month + 24 AS payment_date, least(salary, 15000) AS amount, 'ADVANCE' AS payment_type FROM months
  UNION ALL
  SELECT *, CAST(month + INTERVAL 1 MONTH AS DATE) + 9, salary - 15000, 'PAYMENT'
  FROM months WHERE salary > 15000
),
workday1 AS (
  SELECT * REPLACE (payment_date - CAST(greatest(isodow(payment_date) - 5, 0) AS INTEGER) AS payment_date)
  FROM planned
),
workday2 AS (
  SELECT * REPLACE (CASE WHEN month(payment_date) = 1 AND day(payment_date) <= 14
           THEN payment_date - CAST(day(payment_date) AS INTEGER) ELSE payment_date END AS payment_date)
  FROM workday1
),
outgoing_pay_document AS (
  SELECT payment_date - CAST(greatest(isodow(payment_date) - 5, 0) AS INTEGER) AS payment_date,
         account_no, bik, employee_number, CAST(amount AS BIGINT) AS amount, payment_type,
         CASE WHEN {as_of} - month >= 60 OR employee_number % 3 = 0 THEN TRUE
              WHEN employee_number % 3 = 1 THEN FALSE END AS result
  FROM workday2
),
service AS (
  SELECT p_partkey AS id_service, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS name_service,
         p_type AS service_description, CAST(floor(p_retailprice * 25) AS BIGINT) AS price,
         p_brand AS required_documents
  FROM part
),
price_list AS (
  SELECT creation_date, CAST(0.2 AS DOUBLE) AS nds, CAST(quarter(creation_date) * 5 AS INTEGER) AS extra_charge,
         round(pow(CAST(1.02 AS DOUBLE), CAST(year(creation_date) - since AS DOUBLE)), 4) AS inflation_rate
  FROM (SELECT year(min(o_orderdate)) AS since, CAST(unnest(generate_series(
          CAST(date_trunc('quarter', min(o_orderdate)) AS TIMESTAMP),
          least(CAST(date_trunc('quarter', max(o_orderdate)) AS TIMESTAMP), TIMESTAMP '2001-04-01'),
          INTERVAL 3 MONTH)) AS DATE) AS creation_date FROM orders)
),
markup AS (
  SELECT * FROM (VALUES {markup}) AS m(client_type, factor)
),
price_list_service AS MATERIALIZED (
  SELECT id_service, creation_date,
         CAST(floor(price * inflation_rate * (CAST(1.0 AS DOUBLE) + nds) * factor) AS BIGINT) + extra_charge AS price,
         client_type
  FROM service, price_list, markup
),
cooperation_agreement AS (
  SELECT o_custkey AS id_client, o_orderkey AS cooperation_agreement_no, CAST(o_orderdate AS DATE) AS start_date,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE)
           + CASE WHEN o_totalprice < 50000 AND o_orderpriority = '5-LOW' THEN -1 ELSE 365 END END AS end_date,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderkey % 10 END AS manager_number,
         o_orderkey % 7 - CASE WHEN o_totalprice < 50000 AND o_orderpriority = '2-HIGH' THEN 1000 ELSE 0 END AS lawyer_number
  FROM orders
),
numbers AS (
  SELECT DISTINCT l_orderkey, CAST(l_linenumber AS BIGINT) AS n FROM lineitem
),
assignment_agreement AS (
  SELECT n AS assignment_agreement_no, l_orderkey AS cooperation_agreement_no, o_custkey AS id_client,
         CASE WHEN created < DATE '2001-07-01' THEN CAST(date_trunc('quarter', created) AS DATE) END
           AS creation_price_list_date,
         created AS created_at,
         CASE WHEN n % 3 <> 0 THEN created + 30 END AS completion_date,
         CASE WHEN n <> 6 THEN created + CASE WHEN n % 7 = 0 THEN 20 ELSE 90 END END AS deadline, n % 3 <> 0 AS result
  FROM (SELECT *, CAST(o_orderdate AS DATE) + CAST(n * 7 AS INTEGER) AS created
        FROM numbers LEFT JOIN orders ON o_orderkey = l_orderkey)
),
priced AS MATERIALIZED (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS id_service,
         CAST(l_linenumber AS BIGINT) AS assignment_agreement_no, l_orderkey AS cooperation_agreement_no,
         a.id_client, l_returnflag, coalesce(p.price, s.price) AS price
  FROM lineitem
  JOIN assignment_agreement a ON a.cooperation_agreement_no = l_orderkey AND a.assignment_agreement_no = l_linenumber
  LEFT JOIN client c ON c.id_client = a.id_client
  LEFT JOIN service s ON s.id_service = l_partkey
  LEFT JOIN price_list_service p ON p.id_service = l_partkey AND p.client_type = c.client_type
    AND p.creation_date = a.creation_price_list_date
),
contract_service AS (
  SELECT id, id_service, assignment_agreement_no, cooperation_agreement_no, id_client, price FROM priced
),
staged AS (
  SELECT id, id_service, assignment_agreement_no, cooperation_agreement_no, id_client,
         CAST(CASE l_returnflag WHEN 'R' THEN 10000 WHEN 'A' THEN price END AS BIGINT) AS price
  FROM priced
),
looked_up AS (
  SELECT l.*, c.client_type, p.price AS list_price
  FROM staged l
  JOIN assignment_agreement a USING (assignment_agreement_no, cooperation_agreement_no, id_client)
  JOIN client c USING (id_client)
  LEFT JOIN price_list_service p ON p.id_service = l.id_service AND p.client_type = c.client_type
    AND p.creation_date = a.creation_price_list_date
),
payment_document AS MATERIALIZED (
  SELECT cooperation_agreement_no * 10 + assignment_agreement_no AS id_payment_document,
         CAST(NULL AS BIGINT) AS id_payment_bundle, assignment_agreement_no, cooperation_agreement_no, id_client,
         CAST(sum(price) AS BIGINT) AS amount
  FROM contract_service GROUP BY assignment_agreement_no, cooperation_agreement_no, id_client
),
bundles AS (
  SELECT o_orderkey * 2 + part AS id_payment_bundle, o_orderkey AS parent_cooperation_agreement_no,
         o_custkey AS id_client, start_date, c_nationkey, part,
         CASE WHEN o_orderstatus = 'F' THEN total WHEN o_orderstatus = 'O' THEN 0
              WHEN part = 0 THEN total // 2 ELSE total // 4 END AS total_amount
  FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS total, CAST(o_orderdate AS DATE) AS start_date
        FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal >= 0)
  JOIN (VALUES (0), (1)) AS p(part) ON part = 0 OR o_orderstatus = 'P'
),
payment_bundle AS (
  SELECT id_payment_bundle, parent_cooperation_agreement_no, id_client, total_amount, start_date + 21 + 28 * part AS created_at
  FROM bundles
),
income_pay_document AS (
  SELECT id_payment_bundle AS id_income_pay_document,
         '408' || lpad(CAST(id_client * 3 + id_payment_bundle % 3 AS VARCHAR), 17, '0') AS account_no,
         '04' || lpad(CAST(c_nationkey AS VARCHAR), 7, '0') AS bik, total_amount AS amount,
         start_date + CAST(70 + id_payment_bundle % 6 AS INTEGER) AS payment_date
  FROM bundles WHERE total_amount > 0
),
income_payment_bundle AS (
  SELECT id_payment_bundle AS id_income_pay_document, id_payment_bundle FROM bundles WHERE total_amount > 0
),
names AS (
  SELECT c.id_client, c.created_at, coalesce(e.fio, l.company_name, p.fio) AS name
  FROM client c LEFT JOIN client_entrepreneur e USING (id_client) LEFT JOIN client_legal l USING (id_client)
  LEFT JOIN client_person p USING (id_client)
),
client_payments AS (
  SELECT b.id_client, i.*
  FROM payment_bundle b JOIN income_payment_bundle USING (id_payment_bundle)
  JOIN income_pay_document i USING (id_income_pay_document)
)
""".format(as_of=AS_OF, markup=", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in MARKUP.items()))


def _query(final: str, *views: str) -> str:
    return "WITH " + ",\n".join([VIEWS.strip(), *views]) + "\n" + final


MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
          "november", "december"]


def _client_statistics() -> str:
    # Per client one aggregate over its lines, one over its agreements, one over its payments.
    return _query(
        """
SELECT n.name, n.id_client, n.created_at, coalesce(a.signed, 0) AS agreements, coalesce(l.lines, 0) AS services,
       round(coalesce(coalesce(l.lines, 0) / nullif(coalesce(a.signed, 0) + coalesce(e.bare, 0), 0), 0), 0)
         AS avg_services_per_agreement,
       a.last_signed AS last_agreement_date, a.last_done AS last_completion_date, l.favourite AS top_service,
       list_aggregate(list_sort(list_distinct(m.used)), 'string_agg', ',') AS accounts
FROM names n
LEFT JOIN signed_by_client a ON a.id_client = n.id_client
LEFT JOIN lines_by_client l ON l.id_client = n.id_client
LEFT JOIN bare_by_client e ON e.id_client = n.id_client
LEFT JOIN (SELECT id_client, list(account_no) AS used FROM client_payments GROUP BY id_client) m
  ON m.id_client = n.id_client
""",
        """signed_by_client AS (
  SELECT id_client, count(*) AS signed, max(created_at) AS last_signed, max(completion_date) AS last_done
  FROM assignment_agreement GROUP BY id_client
), bare_by_client AS (
  SELECT id_client, count(*) AS bare FROM cooperation_agreement c
  WHERE NOT EXISTS (FROM assignment_agreement x
    WHERE x.id_client = c.id_client AND x.cooperation_agreement_no = c.cooperation_agreement_no)
  GROUP BY id_client
), lines_by_client AS (
  SELECT id_client, CAST(sum(uses) AS BIGINT) AS lines,
         arg_min(name_service, {'rank': -uses, 'name': name_service}) FILTER (name_service IS NOT NULL) AS favourite
  FROM (SELECT id_client, id_service, count(*) AS uses FROM contract_service GROUP BY ALL)
  LEFT JOIN service USING (id_service)
  GROUP BY id_client
)""",
    )


def _manager_monthly() -> str:
    # A manager's year as a map from month to count; the month before is the largest smaller key.
    def column(i: int, name: str) -> str:
        now = f"CAST(coalesce(year_of[{i}], 0) AS BIGINT)"
        before = f"CAST(year_of[list_max(list_filter(map_keys(year_of), lambda k: k < {i}))] AS BIGINT)"
        change = f"CASE WHEN year_of[{i}] IS NULL THEN 0 ELSE coalesce(({now} - {before}) // nullif({before}, 0) * 100, 0) END"
        return f"CAST({now} AS BIGINT) AS {name}_amount, CAST({change} AS BIGINT) AS {name}_relative"

    columns = ",\n".join(column(i, name) for i, name in enumerate(MONTHS, start=1))
    return _query(
        f"SELECT manager_number, {columns} FROM years",
        """years AS (
  SELECT manager_number, histogram(month(start_date)) AS year_of
  FROM cooperation_agreement WHERE year(start_date) = 2000 GROUP BY manager_number
)""",
    )


def _manager_monthly_calendar() -> str:
    months = [f"count(c.cooperation_agreement_no) FILTER (m = {i}) AS n{i}" for i in range(13)]
    columns = ",\n".join(
        f"n{i} AS {name}_amount, (n{i} - n{i - 1}) * CAST(100.0 AS DOUBLE) / nullif(n{i - 1}, 0) AS {name}_relative"
        for i, name in enumerate(MONTHS, start=1)
    )
    return _query(
        f"SELECT employee_number, fio, {columns} FROM counted",
        f"""counted AS (
  SELECT employee_number, fio, {", ".join(months)}
  FROM employee LEFT JOIN (
    SELECT *, date_diff('month', DATE '1999-12-01', start_date) AS m FROM cooperation_agreement) c
    ON c.manager_number = employee_number
  GROUP BY employee_number, fio
)""",
    )


def _debtors() -> str:
    return _query(
        """
SELECT name, id_client, coalesce(signed, 0) AS agreements, charged, coalesce(paid, 0) AS paid,
       last_agreement_date, newest.payment_date AS last_payment_date, newest.account_no AS last_payment_account,
       charged - coalesce(paid, 0) AS debt
FROM (SELECT id_client, CAST(sum(price) AS BIGINT) AS charged FROM contract_service GROUP BY ALL)
LEFT JOIN money USING (id_client) JOIN names USING (id_client)
LEFT JOIN (SELECT id_client, count(*) AS signed, max(created_at) AS last_agreement_date
           FROM assignment_agreement GROUP BY ALL) USING (id_client)
WHERE charged > coalesce(paid, 0)
""",
        """money AS (
  SELECT id_client, CAST(sum(amount) AS BIGINT) AS paid,
         max({'payment_date': payment_date, 'id': id_income_pay_document, 'account_no': account_no}) AS newest
  FROM client_payments GROUP BY id_client
)""",
    )


USAGE = """usage AS MATERIALIZED (
  SELECT id_service, count(*) AS agreements, round(avg(n), 0) AS avg_uses FROM (
    SELECT id_service, count(*) AS n FROM contract_service
    GROUP BY id_service, assignment_agreement_no, cooperation_agreement_no, id_client) GROUP BY id_service
)"""


def _service_popularity_wide() -> str:
    columns = ", ".join(
        f"{bound}(CASE WHEN client_type = '{kind}' THEN p.price END) AS {bound}_{kind.lower()}"
        for kind in MARKUP
        for bound in ("max", "min")
    )
    return _query(
        f"""SELECT name_service, agreements, avg_uses, {columns}
FROM service s JOIN usage USING (id_service) JOIN price_list_service p USING (id_service)
GROUP BY name_service, agreements, avg_uses""",
        USAGE,
    )


def _payroll_year(owed: str) -> str:
    return _query(f"""
SELECT employee_number, any_value(fio) AS fio, count(*) FILTER (payment_type = 'ADVANCE') AS advances,
       count(*) FILTER (payment_type = 'PAYMENT') AS salaries,
       CAST(coalesce(sum(amount) FILTER (result), 0) AS BIGINT) AS paid,
       CAST(coalesce(sum(amount) FILTER ({owed}), 0) AS BIGINT) AS owed,
       min(payment_date) FILTER ({owed}) AS oldest_unpaid_date
FROM outgoing_pay_document JOIN employee USING (employee_number)
WHERE year(payment_date) = 2001 AND payment_date < {AS_OF} GROUP BY employee_number""")


def _payroll_run(kind: str, pay_date: str, amount: str) -> str:
    return _query(f"""
SELECT DATE '{pay_date}' AS payment_date, account_no, bik, employee_number, CAST({amount} AS BIGINT) AS amount,
       '{kind}' AS payment_type, CAST(NULL AS BOOLEAN) AS result
FROM employee WHERE fire_date IS NULL""")


BILLS = """bill_amounts AS (
  SELECT a.*, a.cooperation_agreement_no * 10 + a.assignment_agreement_no AS id_payment_document,
         coalesce(s.amount, 0) AS amount
  FROM assignment_agreement a LEFT JOIN (
    SELECT assignment_agreement_no, cooperation_agreement_no, id_client, CAST(sum(price) AS BIGINT) AS amount
    FROM contract_service GROUP BY ALL) s USING (assignment_agreement_no, cooperation_agreement_no, id_client)
), bill_bundles AS (
  SELECT min(id_payment_document) AS id_payment_bundle,
         min(cooperation_agreement_no) AS parent_cooperation_agreement_no, id_client,
         CAST(sum(amount) AS BIGINT) AS total_amount, created_at
  FROM bill_amounts GROUP BY id_client, created_at
), bill_documents AS (
  SELECT id_payment_document, min(id_payment_document) OVER (PARTITION BY id_client, created_at) AS id_payment_bundle,
         assignment_agreement_no, cooperation_agreement_no, id_client, amount
  FROM bill_amounts
)"""

ALLOCATION = """owed AS (
  SELECT id_client, cooperation_agreement_no, id_payment_document AS id, amount,
         CAST(sum(amount) OVER (PARTITION BY id_client, cooperation_agreement_no ORDER BY id_payment_document
              ROWS UNBOUNDED PRECEDING) AS BIGINT) AS e
  FROM payment_document
), paid AS (
  SELECT id_client, parent_cooperation_agreement_no AS cooperation_agreement_no, id_payment_bundle AS id,
         total_amount AS amount,
         CAST(sum(total_amount) OVER (PARTITION BY id_client, parent_cooperation_agreement_no
              ORDER BY id_payment_bundle ROWS UNBOUNDED PRECEDING) AS BIGINT) AS e
  FROM payment_bundle
), allocated AS (
  SELECT id_client, cooperation_agreement_no, o.id AS id_payment_document, p.id AS id_payment_bundle,
         least(o.e, p.e) - greatest(o.e - o.amount, p.e - p.amount) AS allocated
  FROM owed o JOIN paid p USING (id_client, cooperation_agreement_no)
  WHERE least(o.e, p.e) > greatest(o.e - o.amount, p.e - p.amount)
)"""

# Payments reach as far as the documents there are: what is beyond is dropped.
ARRIVALS = """events AS (
  SELECT id_client, cooperation_agreement_no, 'DOCUMENT' AS kind, id_payment_document AS id, amount,
         created_at AS day
  FROM (SELECT d.*, a.created_at FROM payment_document d JOIN assignment_agreement a
        ON a.assignment_agreement_no = d.assignment_agreement_no
        AND a.cooperation_agreement_no = d.cooperation_agreement_no AND a.id_client IS NOT DISTINCT FROM d.id_client)
  UNION ALL
  SELECT id_client, parent_cooperation_agreement_no, 'PAYMENT', id_payment_bundle, total_amount, created_at
  FROM payment_bundle
), sums AS (
  SELECT *, sum(CASE WHEN kind = 'DOCUMENT' THEN amount ELSE 0 END) OVER w AS owed_to,
         sum(CASE WHEN kind = 'PAYMENT' THEN amount ELSE 0 END) OVER w AS paid_in
  FROM events
  WINDOW w AS (PARTITION BY id_client, cooperation_agreement_no ORDER BY day, kind, id ROWS UNBOUNDED PRECEDING)
), reach AS (
  SELECT *, paid_in + least(0, min(owed_to - paid_in) OVER (PARTITION BY id_client, cooperation_agreement_no
           ORDER BY day, kind, id ROWS UNBOUNDED PRECEDING)) AS paid_to
  FROM sums
), placed AS MATERIALIZED (
  SELECT id_client, cooperation_agreement_no, kind, id, amount,
         CASE WHEN id_client IS NULL THEN 0 WHEN kind = 'DOCUMENT' THEN owed_to - amount
              ELSE coalesce(lag(paid_to) OVER w, 0) END AS s,
         CASE WHEN id_client IS NULL THEN 0 WHEN kind = 'DOCUMENT' THEN owed_to ELSE paid_to END AS e
  FROM reach
  WINDOW w AS (PARTITION BY id_client, cooperation_agreement_no ORDER BY day, kind, id)
)"""


SIDES = """placed_documents AS MATERIALIZED (SELECT * FROM placed WHERE kind = 'DOCUMENT' AND e > s),
placed_payments AS MATERIALIZED (SELECT * FROM placed WHERE kind = 'PAYMENT' AND e > s)"""


# --- Audits: built from the model's own list of rules ---------------------------


def _text(columns: tuple[str, ...]) -> str:
    return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)


def _finding(table: str, rule: str, source: str, fails: str, rows: str, key: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, "
        f"CAST(coalesce(sum(CASE WHEN {fails} THEN {rows} END), 0) AS BIGINT) AS failing_rows, "
        f"min(CASE WHEN {fails} THEN {key} END) AS sample_key FROM {source}"
    )


def _audit_keys() -> str:
    parts = []
    for name, table in TABLES.items():
        rules = [(f"primary key ({', '.join(table.primary_key)})", table.primary_key)]
        rules += [(f"unique ({c})", (c,)) for c in table.unique]
        for rule, columns in rules:
            listed = ", ".join(columns)
            present = f"WHERE {listed} IS NOT NULL " if rule.startswith("unique") else ""
            source = f"(SELECT {_text(columns)} AS k, count(*) AS n FROM {name} {present}GROUP BY {listed})"
            parts.append(_finding(name, rule, source, "n > 1", "n", "k"))
    return _query("\nUNION ALL ".join(parts))


def _audit_nulls() -> str:
    return _query(
        "\nUNION ALL ".join(
            _finding(name, f"{c} is required", name, f"{c} IS NULL", "1", _text(table.primary_key))
            for name, table in TABLES.items()
            for c in table.required
        )
    )


def _audit_orphans() -> str:
    parts = []
    for name, table in TABLES.items():
        for fk in table.foreign_keys:
            on = " AND ".join(f"p.{p} = c.{c}" for p, c in zip(fk.parent_columns, fk.columns))
            present = " AND ".join(f"c.{c} IS NOT NULL" for c in fk.columns)
            source = f"(SELECT * FROM {name} c WHERE {present} AND NOT EXISTS (SELECT 1 FROM {fk.parent} p WHERE {on}))"
            rule = f"({', '.join(fk.columns)}) references {fk.parent}"
            parts.append(_finding(name, rule, source, "TRUE", "1", _text(fk.columns)))
    return _query("\nUNION ALL ".join(parts))


DUCK_CHECKS = {"bik_format": r"regexp_full_match(bik, '04\d{7}')"}

DUCK_FORMATS = {
    ("client_person", "passport_format"): r"regexp_full_match(passport_data, '\d{4} \d{6}')",
    ("client_person", "inn_format"): r"regexp_full_match(inn, '\d{12}')",
    ("client_entrepreneur", "inn_format"): r"regexp_full_match(inn, '\d{12}')",
    ("client_entrepreneur", "ogrnip_format"): r"regexp_full_match(ogrnip, '\d{15}')",
    ("client_entrepreneur", "ogrnip_check_digit"):
        "CAST(ogrnip[1:14] AS BIGINT) % 13 % 10 = CAST(ogrnip[15:15] AS BIGINT)",
    ("client_legal", "inn_format"): r"regexp_full_match(inn, '\d{10}')",
    ("client_legal", "ogrn_format"): r"regexp_full_match(ogrn, '\d{13}')",
    ("client_legal", "ogrn_check_digit"): "CAST(ogrn[1:12] AS BIGINT) % 11 % 10 = CAST(ogrn[13:13] AS BIGINT)",
    ("bank", "bank_cor_account_format"): r"regexp_full_match(bank_cor_account, '\d{20}')",
    ("bank_account", "account_format"): r"regexp_full_match(account_no, '\d{20}')",
}


def _audit_checks() -> str:
    parts = []
    for name, table in TABLES.items():
        rules = [(rule, DUCK_CHECKS.get(rule, sql)) for rule, sql in table.checks.items()]
        rules += [
            (f"{c} in domain", f"{c} IN ({', '.join(repr(v) for v in values)})")
            for c, values in table.domains.items()
        ]
        parts += [
            _finding(name, rule, name, f"NOT ({sql})", "1", _text(table.primary_key)) for rule, sql in rules
        ]
    return _query("\nUNION ALL ".join(parts))


def _audit_identifiers() -> str:
    return _query(
        "\nUNION ALL ".join(
            _finding(name, rule, name, f"NOT ({sql})", "1", _text(TABLES[name].primary_key))
            for (name, rule), sql in DUCK_FORMATS.items()
        )
    )


def _effects(*rows: tuple[str, str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{action}' AS action, count(*) AS rows FROM {source}"
        for name, action, source in rows
    )


def oracle_sql() -> dict[str, str]:
    # The window keeps the planner from moving the filter into the joins, where it
    # picks a join order that pairs all clients with all prices of their type.
    accepted = "FROM looked_up QUALIFY list_price IS NOT NULL AND count(*) OVER (PARTITION BY id) > 0"
    line = "id, id_service, assignment_agreement_no, cooperation_agreement_no, id_client"
    withdrawn = "(id_service IN (SELECT id_service FROM service WHERE service_description = 'ECONOMY'))"
    left = "(SELECT employee_number FROM employee WHERE fire_date IS NOT NULL)"
    idle = "(SELECT id_client FROM client WHERE client_type = 'ENTREPRENEUR')"
    return {
        "client_statistics": _client_statistics(),
        "manager_monthly": _manager_monthly(),
        "manager_monthly_calendar": _manager_monthly_calendar(),
        "manager_months": _query(
            """SELECT manager_number, m AS month, monthname(make_date(2000, CAST(m AS INTEGER), 1)) AS month_name, n AS amount,
CAST(coalesce((n - before) // nullif(before, 0) * 100, 0) AS BIGINT) AS relative
FROM (SELECT manager_number, CAST(month(start_date) AS INTEGER) AS m, count(*) AS n,
        lag(count(*)) OVER (PARTITION BY manager_number ORDER BY month(start_date)) AS before
      FROM cooperation_agreement WHERE start_date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'
      GROUP BY manager_number, month(start_date))"""
        ),
        "debtors": _debtors(),
        "service_popularity": _query(
            """SELECT name_service, agreements, avg_uses, client_type, max_price, min_price
FROM service JOIN usage USING (id_service) JOIN (
  SELECT id_service, client_type, max(price) AS max_price, min(price) AS min_price
  FROM price_list_service GROUP BY ALL) USING (id_service)""",
            USAGE,
        ),
        "service_popularity_wide": _service_popularity_wide(),
        "service_popularity_current": _query(
            """SELECT name_service, agreements, avg_uses, client_type, p.price AS current_price
FROM usage JOIN service USING (id_service) JOIN in_force p USING (id_service)""",
            USAGE,
            f"""in_force AS MATERIALIZED (
  SELECT * FROM price_list_service
  WHERE creation_date = (SELECT max(creation_date) FROM price_list WHERE creation_date <= {AS_OF})
)""",
        ),
        "payroll_year": _payroll_year("result = FALSE"),
        "payroll_year_null_owed": _payroll_year("result IS DISTINCT FROM TRUE"),
        "payroll_run_advance": _payroll_run("ADVANCE", "2001-09-15", "15000"),
        "payroll_run_payment": _payroll_run("PAYMENT", "2001-08-31", "greatest(salary - 15000, 0)"),
        "payroll_run_total": _query(
            """SELECT 'PAYMENT' AS payment_type, count(*) AS payments,
CAST(sum(greatest(salary - 15000, 0)) AS BIGINT) AS total_amount FROM employee WHERE fire_date IS NULL"""
        ),
        "payroll_schedule": _query("SELECT * FROM outgoing_pay_document"),
        "price_list_calendar": _query(
            """SELECT creation_date, CAST(0.2 AS DOUBLE) AS nds,
CAST(quarter(creation_date) * 5 AS INTEGER) AS extra_charge,
round(pow(CAST(1.02 AS DOUBLE), CAST(year(creation_date) - start_year AS DOUBLE)), 4) AS inflation_rate
FROM (SELECT year(min(o_orderdate)) AS start_year, CAST(unnest(generate_series(
  CAST(date_trunc('quarter', min(o_orderdate)) AS TIMESTAMP),
  CAST(date_trunc('quarter', max(o_orderdate)) AS TIMESTAMP), INTERVAL 3 MONTH)) AS DATE) AS creation_date FROM orders)"""
        ),
        "build_price_list": _query("SELECT * FROM price_list_service"),
        "fork_price_list": _query(
            """SELECT id_service, DATE '2001-04-02' AS creation_date,
CAST(round_even(price * (1 - CAST(12.5 AS DOUBLE) / 100), 0) AS BIGINT) AS price, client_type
FROM price_list_service WHERE creation_date = DATE '2001-04-01'"""
        ),
        "check_prices_accepted": _query(f"SELECT {line}, list_price AS price {accepted}"),
        "check_prices_rejected": _query(
            f"SELECT {line}, price, client_type FROM looked_up WHERE list_price IS NULL"
        ),
        "check_prices_changes": _query(
            f"SELECT {line}, price AS old_price, list_price AS new_price {accepted} "
            "AND price IS DISTINCT FROM list_price"
        ),
        "price_contract_lines": _query(f"SELECT {line}, list_price AS price {accepted}"),
        "unpriced_contract_lines": _query(
            f"SELECT {line}, client_type FROM looked_up WHERE list_price IS NULL"
        ),
        "bill_links": _query(
            "SELECT id_payment_bundle AS id_income_pay_document, id_payment_bundle FROM bill_bundles", BILLS
        ),
        "fork_price_list_header": _query(
            """SELECT * REPLACE (DATE '2001-04-02' AS creation_date) FROM price_list
WHERE creation_date = DATE '2001-04-01'"""
        ),
        "payroll_runs_stored": _payroll_run("ADVANCE", "2001-09-15", "15000")
        + "\nUNION ALL SELECT DATE '2001-09-30', account_no, bik, employee_number, "
        "CAST(greatest(salary - 15000, 0) AS BIGINT), 'PAYMENT', NULL FROM employee WHERE fire_date IS NULL",
        "payroll_runs_posted": _payroll_run("ADVANCE", "2001-09-15", "15000")
        + "\nUNION ALL SELECT DATE '2001-09-30', account_no, bik, employee_number, "
        "CAST(greatest(salary - 15000, 0) AS BIGINT), 'PAYMENT', NULL FROM employee WHERE fire_date IS NULL",
        "bundles_appended": _query("SELECT * FROM payment_bundle"),
        "bundles_reloaded": _query("SELECT * FROM payment_bundle WHERE total_amount > 0"),
        "contract_service_after_purge": _query(f"SELECT * FROM contract_service WHERE NOT {withdrawn}"),
        "stream_prices_changes": _query(
            f"SELECT {line}, price AS old_price, list_price AS new_price {accepted} "
            "AND price IS DISTINCT FROM list_price"
        ),
        "bill_documents": _query("SELECT * FROM bill_documents", BILLS),
        "bill_bundles": _query("SELECT * FROM bill_bundles", BILLS),
        "bill_incomes": _query(
            """SELECT id_payment_bundle AS id_income_pay_document,
'408' || lpad(CAST(id_client * 3 AS VARCHAR), 17, '0') AS account_no,
'04' || lpad(CAST(id_client % 25 AS VARCHAR), 7, '0') AS bik, total_amount AS amount, created_at + 12 AS payment_date
FROM bill_bundles""",
            BILLS,
        ),
        "allocations": _query("SELECT * FROM allocated", ALLOCATION),
        "documents_after": _query(
            """SELECT id_payment_document, id_payment_bundle, assignment_agreement_no, cooperation_agreement_no,
id_client, CAST(amount - coalesce(settled, 0) AS BIGINT) AS amount
FROM payment_document LEFT JOIN (
  SELECT id_payment_document, sum(allocated) AS settled FROM allocated GROUP BY 1) USING (id_payment_document)""",
            ALLOCATION,
        ),
        "leftovers": _query(
            """SELECT id_client, parent_cooperation_agreement_no AS cooperation_agreement_no, id_payment_bundle,
CAST(total_amount - coalesce(used, 0) AS BIGINT) AS leftover
FROM payment_bundle LEFT JOIN (
  SELECT id_payment_bundle, sum(allocated) AS used FROM allocated GROUP BY 1) USING (id_payment_bundle)
WHERE total_amount - coalesce(used, 0) > 0""",
            ALLOCATION,
        ),
        "stream_prices_accepted": _query(f"SELECT {line}, list_price AS price {accepted}"),
        "stream_prices_rejected": _query(
            f"SELECT {line}, price, client_type FROM looked_up WHERE list_price IS NULL"
        ),
        "arrival_allocations": _query(
            """SELECT id_client, cooperation_agreement_no, d.id AS id_payment_document, p.id AS id_payment_bundle,
CAST(least(d.e, p.e) - greatest(d.s, p.s) AS BIGINT) AS allocated
FROM placed_documents d JOIN placed_payments p USING (id_client, cooperation_agreement_no)
WHERE least(d.e, p.e) > greatest(d.s, p.s)""",
            ARRIVALS,
            SIDES,
        ),
        "late_allocations": _query(
            """SELECT id_client, cooperation_agreement_no, d.id AS id_payment_document, p.id AS id_payment_bundle,
CAST(least(d.e, p.e) - greatest(d.s, p.s) AS BIGINT) AS allocated
FROM placed_documents d JOIN placed_payments p USING (id_client, cooperation_agreement_no)
WHERE least(d.e, p.e) > greatest(d.s, p.s)""",
            ARRIVALS,
            SIDES,
        ),
        "stream_allocations": _query(
            """SELECT id_client, cooperation_agreement_no, d.id AS id_payment_document, p.id AS id_payment_bundle,
CAST(least(d.e, p.e) - greatest(d.s, p.s) AS BIGINT) AS allocated
FROM placed_documents d JOIN placed_payments p USING (id_client, cooperation_agreement_no)
WHERE least(d.e, p.e) > greatest(d.s, p.s)""",
            ARRIVALS,
            SIDES,
        ),
        "arrival_leftovers": _query(
            """SELECT id_client, cooperation_agreement_no, id AS id_payment_bundle,
CAST(amount - (e - s) AS BIGINT) AS leftover FROM placed WHERE kind = 'PAYMENT' AND amount > e - s""",
            ARRIVALS,
        ),
        "audit_keys": _audit_keys(),
        "audit_nulls": _audit_nulls(),
        "audit_orphans": _audit_orphans(),
        "audit_checks": _audit_checks(),
        "audit_identifiers": _audit_identifiers(),
        "cascade_purge": _query(
            _effects(
                ("service", "removed", f"service WHERE {withdrawn}"),
                ("price_list_service", "removed", f"price_list_service WHERE {withdrawn}"),
                ("contract_service", "removed", f"contract_service WHERE {withdrawn}"),
            )
        ),
        "cascade_purge_clients": _query(
            _effects(
                ("client", "removed", f"client WHERE id_client IN {idle}"),
                ("client_person", "removed", f"client_person WHERE id_client IN {idle}"),
                ("client_entrepreneur", "removed", f"client_entrepreneur WHERE id_client IN {idle}"),
                ("client_legal", "removed", f"client_legal WHERE id_client IN {idle}"),
                ("cooperation_agreement", "blocking", f"cooperation_agreement WHERE id_client IN {idle}"),
            )
        ),
        "cascade_purge_employees": _query(
            _effects(
                ("employee", "removed", f"employee WHERE employee_number IN {left}"),
                ("outgoing_pay_document", "emptied", f"outgoing_pay_document WHERE employee_number IN {left}"),
                (
                    "cooperation_agreement",
                    "blocking",
                    f"cooperation_agreement WHERE manager_number IN {left} OR lawyer_number IN {left}",
                ),
            )
        ),
        "incomes_updated_in_place": _query(
            """SELECT * REPLACE (CASE WHEN payment_date >= DATE '2001-04-01' THEN 2 * amount ELSE amount END AS amount)
FROM income_pay_document"""
        ),
        "lines_after_published_purge": _query(f"SELECT * FROM contract_service WHERE NOT {withdrawn}"),
        "incomes_audited_by_folder": _query(
            "\nUNION ALL ".join(
                [
                    _finding("income_pay_document", f"{c} is required", "cancelled", f"{c} IS NULL", "1", "CAST(id_income_pay_document AS VARCHAR)")
                    for c in TABLES["income_pay_document"].required
                ]
                + [_finding("income_pay_document", "amount_not_negative", "cancelled", "amount < 0", "1", "CAST(id_income_pay_document AS VARCHAR)")]
            ),
            """cancelled AS (
  SELECT * REPLACE (CASE WHEN payment_date >= DATE '2001-04-01' THEN -amount ELSE amount END AS amount,
                    CASE WHEN payment_date >= DATE '2001-01-01' OR amount >= 10000 THEN bik END AS bik)
  FROM income_pay_document
)""",
        ),
        "agreements_with_price_lists": _query(
            """SELECT c.id_client, c.cooperation_agreement_no, c.start_date, p.creation_date, p.extra_charge, p.inflation_rate
FROM cooperation_agreement c ASOF LEFT JOIN price_list p ON c.start_date >= p.creation_date"""
        ),
        "lines_priced_as_of": _query(
            """SELECT d.id, d.id_service, d.assignment_agreement_no, d.cooperation_agreement_no, d.id_client, d.created_at,
       d.client_type, p.creation_date, p.price
FROM dated d ASOF LEFT JOIN price_list_service p
  ON d.id_service = p.id_service AND d.client_type = p.client_type AND d.created_at >= p.creation_date""",
            """dated AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS id_service,
         CAST(l_linenumber AS BIGINT) AS assignment_agreement_no, l_orderkey AS cooperation_agreement_no,
         o_custkey AS id_client, CAST(o_orderdate AS DATE) + CAST(l_linenumber * 7 AS INTEGER) AS created_at, client_type
  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN client ON id_client = o_custkey
)""",
        ),
        "agreements_in_payroll_months": _query(
            """SELECT m.employee_number, m.month, c.id_client, c.cooperation_agreement_no,
       CAST(least(coalesce(c.end_date, m.month_end), m.month_end) - greatest(c.start_date, m.month) AS INTEGER) AS days
FROM cooperation_agreement c JOIN paid_months m ON c.lawyer_number = m.employee_number
WHERE c.start_date < m.month_end AND (c.end_date IS NULL OR c.end_date > greatest(m.month, c.start_date))""",
            """paid_months AS (
  SELECT DISTINCT employee_number, CAST(date_trunc('month', payment_date) AS DATE) AS month,
         CAST(date_trunc('month', payment_date) + INTERVAL 1 MONTH AS DATE) AS month_end
  FROM outgoing_pay_document
)""",
        ),
        "agreement_ledger": _query(
            """SELECT a.assignment_agreement_no, a.cooperation_agreement_no, a.id_client, c.manager_number, c.start_date,
       a.created_at, count(l.id) AS lines, CAST(coalesce(sum(l.price), 0) AS BIGINT) AS charged
FROM assignment_agreement a JOIN cooperation_agreement c USING (id_client, cooperation_agreement_no)
LEFT JOIN contract_service l ON l.assignment_agreement_no = a.assignment_agreement_no
  AND l.cooperation_agreement_no = a.cooperation_agreement_no AND l.id_client = a.id_client
GROUP BY ALL"""
        ),
        "agreement_balances": _query(
            """SELECT c.id_client, c.cooperation_agreement_no, c.manager_number,
  (SELECT count(*) FROM assignment_agreement x WHERE x.id_client = c.id_client
     AND x.cooperation_agreement_no = c.cooperation_agreement_no) AS assignments,
  (SELECT count(*) FROM contract_service x WHERE x.id_client = c.id_client
     AND x.cooperation_agreement_no = c.cooperation_agreement_no) AS lines,
  CAST(coalesce((SELECT sum(price) FROM contract_service x WHERE x.id_client = c.id_client
     AND x.cooperation_agreement_no = c.cooperation_agreement_no), 0) AS BIGINT) AS charged,
  CAST(coalesce((SELECT sum(amount) FROM payment_document x WHERE x.id_client = c.id_client
     AND x.cooperation_agreement_no = c.cooperation_agreement_no), 0) AS BIGINT) AS billed
FROM cooperation_agreement c"""
        ),
        "insert_ignore": _query(
            "SELECT account_no, bik FROM employee UNION SELECT account_no, bik FROM income_pay_document"
        ),
        "upsert_totals": _query(
            "SELECT * FROM bill_bundles", BILLS
        ),
    }
