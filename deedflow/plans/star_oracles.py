"""The queries on the star schema in plain SQL, for a second engine to compare with."""

from __future__ import annotations

_SALES = """
  SELECT l_orderkey AS transaction_ID, l_partkey AS property_ID, o_custkey AS client_ID,
         l_suppkey AS agent_ID, CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS review_process,
         CAST(o_orderdate AS DATE) AS date_transaction
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
_PROPERTIES = """
  SELECT p_partkey AS property_ID, p_type AS property_TYPE, p_brand || '/' || p_type AS city,
         CAST(p_retailprice AS DECIMAL(18,2)) AS listing_price
  FROM part
"""
_STATUS = """
  SELECT p.*, CASE WHEN EXISTS (
    SELECT 1 FROM sales s WHERE s.property_ID = p.property_ID
      AND date_transaction >= DATE '1995-01-01' AND date_transaction < DATE '1996-01-01'
  ) THEN 'Sold' ELSE 'For Sale' END AS prop_status
  FROM properties p
"""
_VIEWS = f"sales AS ({_SALES}), properties AS ({_PROPERTIES})"

_ROWS = """
  SELECT o_orderkey AS seq, o_custkey AS property_ID, CAST(o_orderdate AS DATE) AS day,
         o_orderstatus, o_orderpriority,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Yes' WHEN '4-NOT SPECIFIED' THEN NULL
              ELSE 'No' END AS exclusivity
  FROM orders
"""
_CUSTOMERS = """
  SELECT c_custkey AS property_ID,
         CASE WHEN c_acctbal < 0 THEN 'Sold' ELSE 'For Sale' END AS prop_status,
         CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'BUILDING') THEN 'House' ELSE 'Villa' END
           AS property_TYPE
  FROM customer
"""
_EVENTS = f"rows AS ({_ROWS}), customers AS ({_CUSTOMERS})"

_SOLD_GATE = f"""
  WITH {_EVENTS}, numbered AS (
    SELECT r.seq, r.property_ID, prop_status,
           row_number() OVER (PARTITION BY r.property_ID ORDER BY r.seq) AS n
    FROM rows r LEFT JOIN customers c ON r.property_ID = c.property_ID)
"""
_SOLD = "(prop_status = 'Sold' OR (prop_status IS NOT NULL AND n > 1))"


def _exclusive(stored: str, batch: str, scope: str) -> str:
    return f"""
  WITH {_EVENTS}, stored AS (SELECT *, year(day) AS year FROM rows WHERE {stored}),
  batch AS (SELECT *, year(day) AS year FROM rows WHERE {batch}),
  seen AS (
    SELECT {scope}, count(*) FILTER (WHERE exclusivity = 'Yes') AS yes,
           count(*) FILTER (WHERE exclusivity = 'No') AS no
    FROM stored GROUP BY {scope}),
  before AS (
    SELECT b.*, first_value(exclusivity IGNORE NULLS) OVER (
             PARTITION BY {scope} ORDER BY seq
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
    FROM batch b)
  SELECT seq, CASE
      WHEN {scope.split(",")[0]} IS NULL THEN 'accepted'
      WHEN coalesce(yes, 0) > 0 THEN 'exclusivity_clash'
      WHEN coalesce(no, 0) > 0 AND exclusivity = 'Yes' THEN 'exclusivity_clash'
      WHEN coalesce(no, 0) = 0 AND earlier = 'Yes' THEN 'exclusivity_clash'
      WHEN earlier = 'No' AND exclusivity = 'Yes' THEN 'exclusivity_clash'
      ELSE 'accepted' END AS outcome
  FROM before LEFT JOIN seen USING ({scope})
"""


def _units(first: str, last: str) -> tuple[str, str]:
    months = (
        f"((year({last}) - year({first})) * 12 + month({last}) - month({first})"
        f" - CASE WHEN day({last}) < day({first}) THEN 1 ELSE 0 END)"
    )
    return f"({months} // 12)", months


_YEARS, _MONTHS = _units("first", "last")
_SPANS = """
  SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
  FROM orders GROUP BY o_custkey
"""


def _lines(company: str) -> str:
    return f"""
  WITH {_VIEWS}
  SELECT s.transaction_ID AS "Transaction", s.property_ID AS "Property ID",
         p.property_TYPE AS "Type", CAST(p.listing_price AS DOUBLE) AS "Price",
         split_part(a.s_name, '#', 1) || ' ' || split_part(a.s_name, '#', 2) AS "Agent"
  FROM sales s JOIN properties p ON s.property_ID = p.property_ID
  JOIN supplier a ON s.agent_ID = a.s_suppkey
  JOIN (SELECT DISTINCT l_partkey, s_nationkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) co
    ON s.property_ID = co.l_partkey
  WHERE s.client_ID = 86
    AND co.s_nationkey = (SELECT n_nationkey FROM nation WHERE n_name = '{company}')
"""


ORACLES: dict[str, str] = {
    "q1_sales_between": f"""
  WITH {_VIEWS}
  SELECT split_part(c_name, '#', 1) AS customer_first_name,
         split_part(c_name, '#', 2) AS customer_last_name,
         date_transaction AS transaction_date, property_TYPE AS product_or_service
  FROM customer JOIN sales ON c_custkey = client_ID
  JOIN properties ON sales.property_ID = properties.property_ID
  WHERE date_transaction BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
""",
    "q2_top_customers": f"""
  WITH {_VIEWS}
  SELECT c_custkey AS client_ID, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         CAST(sum(listing_price) AS DOUBLE) AS total_spent
  FROM customer JOIN sales ON c_custkey = client_ID
  JOIN properties ON sales.property_ID = properties.property_ID
  GROUP BY c_custkey, c_name ORDER BY sum(listing_price) DESC, c_custkey LIMIT 3
""",
    "q3_period_summary": f"""
  WITH {_VIEWS}, whole AS (
    SELECT min(date_transaction) AS first, max(date_transaction) AS last,
           sum(listing_price) AS total
    FROM sales JOIN properties ON sales.property_ID = properties.property_ID
    WHERE date_transaction >= DATE '1996-01-01' AND date_transaction < DATE '1998-01-01')
  SELECT strftime(first, '%m/%Y') || ' – ' || strftime(last, '%m/%Y') AS "PeriodOfSales",
         CAST(total AS DOUBLE) AS "TotalSales",
         round(CAST(total AS DOUBLE) / ({_YEARS} + 1), 4) AS "YearlyAverage",
         round(CAST(total AS DOUBLE) / ({_MONTHS} + 1), 4) AS "MonthlyAverage"
  FROM whole
""",
    "q4_sales_by_city": f"""
  WITH {_VIEWS}
  SELECT city AS location, CAST(sum(listing_price) AS DOUBLE) AS total_sales
  FROM sales JOIN properties ON sales.property_ID = properties.property_ID GROUP BY city
""",
    "q5_reviewed_cities": f"""
  WITH {_VIEWS}
  SELECT DISTINCT city AS location
  FROM sales s JOIN properties p ON s.property_ID = p.property_ID
  JOIN (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase') r
    ON s.property_ID = r.user_id
  WHERE s.review_process IS NOT NULL
""",
    "v1_invoice_header": f"""
  WITH {_VIEWS}, marked AS ({_STATUS})
  SELECT n_name AS "Company", DATE '2024-01-01' AS "Date",
         ('0x' || substr(md5('NATION_19|86|2024-01-01'), 1, 8))::BIGINT % 100000 AS "Invoice Number",
         split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) AS "Customer Name",
         CAST(coalesce(sum(listing_price), 0) AS DOUBLE) AS "Total Sales"
  FROM nation
  JOIN (SELECT DISTINCT l_partkey, s_nationkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) co
    ON n_nationkey = co.s_nationkey
  JOIN marked p ON co.l_partkey = p.property_ID
  LEFT JOIN sales s ON p.property_ID = s.property_ID
  LEFT JOIN customer ON s.client_ID = c_custkey
  WHERE n_name = 'NATION_19' AND p.prop_status = 'Sold' AND c_custkey = 86
  GROUP BY n_name, c_name
""",
    "v2_invoice_lines": _lines("NATION_19"),
    "s7_view": _lines("NATION_3"),
    "g1_audit_log": """
  SELECT row_number() OVER (ORDER BY o_orderkey) AS "log_ID",
         CAST(o_orderdate AS DATE) AS event_date, o_orderkey AS transaction_id,
         'Transaction Inserted' AS event_type,
         'New transaction added: ' || CAST(o_orderkey AS VARCHAR) AS details
  FROM orders
""",
    "g2_mark_sold": f"""
  WITH {_VIEWS}, marked AS ({_STATUS}) SELECT property_ID AS "property_ID", prop_status FROM marked
""",
    "g3_sold_gate": f"""{_SOLD_GATE}
  SELECT seq, CASE WHEN {_SOLD} THEN 'already_sold' ELSE 'accepted' END AS outcome FROM numbered
""",
    "g8_reject_messages": f"""{_SOLD_GATE}
  SELECT seq, 'Cannot perform a transaction on Property ID: ' || CAST(property_ID AS VARCHAR)
           || ' that is already sold.' AS message
  FROM numbered WHERE {_SOLD}
""",
    "g3_reopen_epochs": f"""
  WITH {_EVENTS}, events_of AS (
    SELECT r.seq, r.property_ID, prop_status, property_TYPE, o_orderpriority = '1-URGENT' AS contract
    FROM rows r LEFT JOIN customers c ON r.property_ID = c.property_ID),
  epochs AS (
    SELECT *, sum(CASE WHEN contract AND property_TYPE = 'House' THEN 1 ELSE 0 END) OVER (
             PARTITION BY property_ID ORDER BY seq) AS epoch
    FROM events_of),
  sales AS (
    SELECT *, row_number() OVER (PARTITION BY property_ID, epoch ORDER BY seq) AS n
    FROM epochs WHERE NOT contract)
  SELECT seq, property_ID AS "property_ID",
         CASE WHEN prop_status IS NULL THEN 'accepted'
              WHEN n = 1 AND (epoch > 0 OR prop_status <> 'Sold') THEN 'accepted'
              ELSE 'already_sold' END AS outcome
  FROM sales
""",
    "g4_date_gate": """
  SELECT l_orderkey, l_linenumber, l_partkey,
         CASE WHEN l_shipdate <= (SELECT min(o_orderdate) FROM orders WHERE o_orderkey = l_orderkey)
              THEN 'appointment_before_contract' ELSE 'accepted' END AS outcome
  FROM lineitem
""",
    "g5_review_gate": f"""
  WITH {_EVENTS}, sale AS (
    SELECT property_ID, count(*) AS n, min(day) AS first FROM rows
    WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' GROUP BY property_ID)
  SELECT seq, CASE WHEN n > 1 THEN 'ambiguous_sale' WHEN day <= first THEN 'review_before_sale'
              ELSE 'accepted' END AS outcome
  FROM rows LEFT JOIN sale USING (property_ID)
""",
    "g6_reopen_type": f"""
  WITH {_VIEWS}, marked AS ({_STATUS})
  SELECT property_ID AS "property_ID", CASE WHEN property_TYPE = 'ECONOMY' AND EXISTS (
      SELECT 1 FROM lineitem WHERE l_partkey = property_ID
        AND l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1997-01-01')
    THEN 'For Sale' ELSE prop_status END AS prop_status
  FROM marked
""",
    "g6_final_status": f"""
  WITH {_EVENTS}, last AS (
    SELECT r.property_ID, arg_max(CASE WHEN o_orderpriority = '1-URGENT' THEN 'For Sale'
             ELSE 'Sold' END, seq) AS status
    FROM rows r JOIN customers c ON r.property_ID = c.property_ID
    WHERE o_orderpriority <> '1-URGENT' OR property_TYPE = 'House' GROUP BY r.property_ID)
  SELECT c.property_ID AS "property_ID", coalesce(status, prop_status) AS prop_status,
         property_TYPE AS "property_TYPE"
  FROM customers c LEFT JOIN last ON c.property_ID = last.property_ID
""",
    "g7_exclusive_gate": _exclusive("o_orderstatus = 'F'", "o_orderstatus <> 'F'", "day"),
    "g7_exclusive_gate_empty_store": _exclusive("false", "true", "day"),
    "g7_exclusive_gate_per_property": _exclusive(
        "o_orderstatus = 'F'", "o_orderstatus <> 'F'", "property_ID, year"
    ),
    "g8_appointment_messages": f"""
  WITH {_EVENTS}, first AS (
    SELECT property_ID, min(day) AS first FROM rows WHERE o_orderstatus = 'F' GROUP BY property_ID)
  SELECT seq, 'Date of appointment must be after the contract owner date for the property.' AS message
  FROM rows JOIN first USING (property_ID) WHERE o_orderstatus <> 'F' AND day <= first
""",
    "g8_review_messages": f"""
  WITH {_EVENTS}, sale AS (
    SELECT property_ID, count(*) AS n, min(day) AS first FROM rows
    WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' GROUP BY property_ID)
  SELECT seq, CASE WHEN n > 1 THEN 'The property has more than one transaction to compare with.'
              ELSE 'Review ID: ' || seq || ' - Review date must be after transaction date.' END AS message
  FROM rows JOIN sale USING (property_ID) WHERE n > 1 OR day <= first
""",
    "g8_exclusivity_messages": """
  SELECT seq, 'Cannot set exclusivity if contracts without exclusivity exist for the same date, '
    || 'or property with exclusivity by another company on the same date.' AS message
  FROM (""" + _exclusive("o_orderstatus = 'F'", "o_orderstatus <> 'F'", "day") + """) WHERE outcome <> 'accepted'
""",
    "g9_judge_sales": f"""
  WITH {_EVENTS}, local AS (
    SELECT r.seq, r.property_ID, c.prop_status,
           abs(r.seq) >= 1000000 AS long_key, abs(r.property_ID) >= 1000000 AS long_property,
           o_orderstatus = 'F' AS stored,
           r.property_ID IS NOT NULL AND NOT EXISTS (
             SELECT 1 FROM customer WHERE c_custkey = r.property_ID
               AND c_mktsegment <> 'MACHINERY') AS orphan
    FROM rows r LEFT JOIN customers c ON r.property_ID = c.property_ID),
  first AS (
    SELECT property_ID, min(seq) AS seq FROM local
    WHERE NOT stored AND NOT orphan AND NOT long_key AND NOT coalesce(long_property, false)
    GROUP BY property_ID)
  SELECT l.seq AS "transaction_ID", concat_ws(',',
      CASE WHEN prop_status = 'Sold' OR l.seq > f.seq THEN 'already_sold' END,
      CASE WHEN long_key THEN 'type:transaction_ID' END,
      CASE WHEN long_property THEN 'type:property_ID' END,
      CASE WHEN long_property THEN 'type:client_ID' END,
      CASE WHEN orphan THEN 'orphan:client_ID' END,
      CASE WHEN stored THEN 'duplicate:transaction_ID' END) AS reasons,
    reasons = '' AS accepted
  FROM local l LEFT JOIN first f ON l.property_ID = f.property_ID
""",
    "s6_bulk_load": """
  WITH held AS (
    SELECT p_partkey AS id FROM part
    WHERE p_type <> 'PROMO' AND p_partkey < 1000000
      AND p_size IN (SELECT s_suppkey FROM supplier WHERE s_suppkey < 1000000)),
  contract AS (
    SELECT *, first_value(exclusivity IGNORE NULLS) OVER (
             PARTITION BY day ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
    FROM (SELECT o_orderkey AS id, o_custkey AS property, o_orderdate AS day,
                 CASE o_orderpriority WHEN '1-URGENT' THEN 'Yes' WHEN '4-NOT SPECIFIED' THEN NULL
                      ELSE 'No' END AS exclusivity
          FROM orders LEFT JOIN held ON held.id = o_custkey
          WHERE o_orderstatus = 'P' AND o_orderkey < 1000000
            AND (o_custkey IS NULL OR held.id IS NOT NULL))),
  contracts AS (
    SELECT id, property, day FROM contract
    WHERE coalesce(earlier, '') <> 'Yes'
      AND NOT (coalesce(earlier, '') = 'No' AND coalesce(exclusivity, '') = 'Yes')),
  signed AS (SELECT property, min(day) AS day FROM contracts GROUP BY property),
  fitting AS (
    SELECT o_orderkey AS id, o_custkey AS property, o_orderdate AS day, o_orderstatus
    FROM orders LEFT JOIN held ON held.id = o_custkey LEFT JOIN customer ON c_custkey = o_custkey
    WHERE o_orderkey < 1000000
      AND (o_custkey IS NULL OR (held.id IS NOT NULL AND c_custkey < 1000000))),
  visited AS (SELECT * FROM fitting WHERE o_orderstatus = 'O'),
  appointments AS (
    SELECT v.id FROM visited v LEFT JOIN signed USING (property)
    WHERE signed.day IS NULL OR v.day > signed.day),
  sale AS (
    SELECT property, min(id) AS id, arg_min(day, id) AS day
    FROM fitting WHERE o_orderstatus = 'F' AND property IS NOT NULL GROUP BY property),
  sales AS (
    SELECT id FROM sale
    UNION ALL SELECT id FROM fitting WHERE o_orderstatus = 'F' AND property IS NULL),
  reviews AS (
    SELECT v.id FROM visited v LEFT JOIN sale USING (property)
    WHERE v.id < 100000 AND (sale.day IS NULL OR v.day > sale.day)),
  kept AS (
    SELECT 'companies' AS name, n_nationkey AS id FROM nation
    UNION ALL SELECT 'owners', s_suppkey FROM supplier WHERE s_suppkey < 1000000
    UNION ALL SELECT 'properties', id FROM held
    UNION ALL SELECT 'contracts_owner', id FROM contracts
    UNION ALL SELECT 'agents', s_suppkey FROM supplier WHERE s_suppkey < 1000000
    UNION ALL SELECT 'clients', c_custkey FROM customer WHERE c_custkey < 1000000
    UNION ALL SELECT 'appointments', id FROM appointments
    UNION ALL SELECT 'transactions', id FROM sales
    UNION ALL SELECT 'visits', id FROM appointments
    UNION ALL SELECT 'reviews', id FROM reviews
    UNION ALL SELECT 'log_transactions', id FROM sales
    UNION ALL SELECT 'sold properties', property FROM sale),
  given AS (
    SELECT 'companies' AS name, count(*) AS n FROM nation
    UNION ALL SELECT 'owners', count(*) FROM supplier
    UNION ALL SELECT 'properties', count(*) FROM part
    UNION ALL SELECT 'contracts_owner', count(*) FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'agents', count(*) FROM supplier
    UNION ALL SELECT 'clients', count(*) FROM customer
    UNION ALL SELECT 'appointments', count(*) FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'transactions', count(*) FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'visits', count(*) FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'reviews', count(*) FROM orders WHERE o_orderstatus = 'O')
  SELECT name AS table_name, count(*) AS stored, CAST(sum(id) AS BIGINT) AS key_sum,
         coalesce(any_value(n) - count(*), 0) AS rejected
  FROM kept LEFT JOIN given USING (name) GROUP BY name
""",
    "k1_pk_duplicates": """
  SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""",
    "k2_unique": "SELECT p_name, count(*) AS copies FROM part GROUP BY p_name HAVING count(*) > 1",
    "k3_null_profile": """
  SELECT count(*) - count(o_orderkey) AS o_orderkey_nulls, count(*) - count(o_custkey) AS o_custkey_nulls,
         count(*) FILTER (o_orderpriority IS NULL OR o_orderpriority = '4-NOT SPECIFIED') AS o_orderpriority_nulls,
         count(*) FILTER (o_totalprice IS NULL OR o_totalprice < 100000) AS o_totalprice_nulls
  FROM orders
""",
    "k4_check": "SELECT c_custkey, c_acctbal FROM customer WHERE NOT (c_acctbal > 0)",
    "k5_check_nullable": """
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS rating
  FROM lineitem WHERE l_quantity <> 1 AND l_quantity <= 10
""",
    "k6_domain": """
  SELECT o_orderkey, o_orderpriority FROM orders
  WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')
""",
    "k7_orphans": """
  SELECT o_custkey, count(*) AS child_rows FROM orders
  WHERE o_custkey IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)
  GROUP BY o_custkey
""",
    "k8_set_null": """
  SELECT c_custkey, CASE WHEN n_regionkey <> 0 THEN c_nationkey END AS c_nationkey
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""",
    "k8_delete_rows": """
  SELECT 'company' AS kind, CAST(n_nationkey AS BIGINT) AS id, CAST(NULL AS BIGINT) AS company FROM nation
  WHERE NOT (n_regionkey = 0 AND n_nationkey IN (SELECT c_nationkey FROM customer))
  UNION ALL
  SELECT 'agent', s_suppkey, CASE WHEN NOT (n_regionkey = 0 AND n_nationkey IN (SELECT c_nationkey FROM customer))
         THEN s_nationkey END
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
""",
    "k9_renumber_rows": """
  WITH moved AS (
    SELECT n_nationkey FROM nation WHERE n_regionkey = 1 AND n_nationkey IN (SELECT c_nationkey FROM customer))
  SELECT 'company' AS kind, CAST(n_nationkey + CASE WHEN n_nationkey IN (FROM moved) THEN 100 ELSE 0 END AS BIGINT) AS id,
         CAST(NULL AS BIGINT) AS company FROM nation
  UNION ALL
  SELECT 'agent', s_suppkey, s_nationkey + CASE WHEN s_nationkey IN (FROM moved) THEN 100 ELSE 0 END FROM supplier
""",
    "g9_judge_bad_seq": """
  WITH rows AS (
    SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 <= 2 THEN c_custkey - c_custkey % 10
             ELSE c_custkey END AS seq FROM customer)
  SELECT c_custkey AS "client_ID", reasons = '' AS accepted, reasons FROM (
    SELECT c_custkey, concat_ws(',',
        CASE WHEN c_custkey >= 1000000 THEN 'type:client_ID' END,
        CASE WHEN seq IS NULL THEN 'type:seq' END,
        CASE WHEN seq IS NOT NULL AND count(*) OVER (PARTITION BY seq) > 1 THEN 'duplicate:seq' END) AS reasons
    FROM rows)
""",
    "k1_k2_judge_repeats": """
  SELECT c_custkey * 3 + turn AS seq, c_custkey * 2 + CASE turn WHEN 0 THEN 0 ELSE 1 END AS "owner_ID",
         turn <> 1 AS accepted, CASE turn WHEN 1 THEN 'duplicate:contact' ELSE '' END AS reasons
  FROM customer, (VALUES (0), (1), (2)) t(turn)
""",
    "k9_cascade": """
  SELECT c_custkey, CASE WHEN n_regionkey = 1 THEN c_nationkey + 100 ELSE c_nationkey END
           AS c_nationkey
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""",
    "k10_restrict": """
  SELECT c_custkey FROM customer
  WHERE c_acctbal < 0 AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
""",
    "k11_conformity": "SELECT p_partkey, p_name FROM part WHERE length(p_name) > 10",
    "k11_precision": """
  WITH typed AS (
    SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders),
  checked AS (
    SELECT o_orderkey, price <> round(price, 0) OR abs(price) >= 100000000000 AS bad_price,
           abs(o_orderkey) >= 10000 AS bad_key
    FROM typed)
  SELECT * FROM checked WHERE bad_price OR bad_key
""",
    "k12_ids": """
  SELECT o_orderkey, 100 + row_number() OVER (ORDER BY o_orderkey) AS id
  FROM orders WHERE o_orderstatus = 'O'
""",
    "s1_full_read": "SELECT * FROM supplier",
    "s3_batch_append": """
  SELECT * FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'O'
""",
    "s4_subset_append": """
  SELECT n_nationkey, n_name, n_regionkey FROM nation
  UNION ALL SELECT n_nationkey, n_name, NULL FROM nation
""",
    "p4_distinct": "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem",
    "p6_in_list": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O')",
    "p7_between": """
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
  WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-06-30'
""",
    "p8_half_open": """
  SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS day FROM lineitem
  WHERE l_shipdate >= DATE '1997-03-01' AND l_shipdate < DATE '1997-07-01'
""",
    "p9_not_null": """
  SELECT l_orderkey AS "transaction_ID", l_partkey AS "property_ID", l_quantity AS review_process
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'N'
""",
    "p10_exists": """
  SELECT c_custkey, c_name FROM customer
  WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
""",
    "p11_scalar_lookup": """
  SELECT c_custkey FROM customer
  WHERE c_nationkey = (SELECT n_nationkey FROM nation WHERE n_name = 'NATION_19')
""",
    "p13_three_valued": f"""
  WITH rows AS ({_ROWS})
  SELECT seq FROM rows
  WHERE exclusivity = 'Yes' OR (NOT (exclusivity = 'Yes') AND o_orderstatus = 'P')
""",
    "j3_sold_and_reviewed": f"""
  WITH sales AS ({_SALES})
  SELECT s.property_ID AS "property_ID", s.n AS sales, r.n AS reviews
  FROM (SELECT property_ID, count(*) AS n FROM sales GROUP BY property_ID) s
  JOIN (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY user_id) r
    ON s.property_ID = r.user_id
""",
    "j6_status_lookup": f"""
  WITH {_EVENTS}
  SELECT seq, prop_status FROM rows r
  LEFT JOIN customers c ON r.property_ID = c.property_ID AND property_TYPE = 'House'
""",
    "a4_coalesce_sum": """
  SELECT o_custkey, CAST(coalesce(sum(CASE WHEN o_orderpriority = '1-URGENT'
           THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS urgent_total
  FROM orders GROUP BY o_custkey
""",
    "a5_conditional_count": f"""
  WITH rows AS ({_ROWS})
  SELECT day AS date_contract, count(*) FILTER (WHERE exclusivity = 'Yes') AS exclusive,
         count(*) FILTER (WHERE exclusivity = 'No') AS open
  FROM rows GROUP BY day
""",
    "a6_first_date": """
  SELECT l_partkey AS "property_ID", CAST(min(l_shipdate) AS DATE) AS first_contract
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_partkey
""",
    "o1_top_k": """
  SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3
""",
    "f1_concat": """
  SELECT 'New transaction added: ' || CAST(o_orderkey AS VARCHAR) AS text FROM orders
  UNION ALL SELECT replace(s_name, '#', ' ') FROM supplier
""",
    "f2_month_label": """
  SELECT strftime(o_orderdate, '%m/%Y') AS month, count(*) AS orders
  FROM orders GROUP BY strftime(o_orderdate, '%m/%Y')
""",
    "f3_whole_years": f"WITH spans AS ({_SPANS}) SELECT o_custkey, {_YEARS} AS years FROM spans",
    "f4_whole_months": f"WITH spans AS ({_SPANS}) SELECT o_custkey, {_MONTHS} AS months FROM spans",
    "f5_f6_invoice_heads": """
  SELECT c_custkey, current_date AS today,
         ('0x' || substr(md5('NATION_19|' || c_custkey || '|2024-01-01'), 1, 8))::BIGINT % 100000 AS number
  FROM customer
""",
    "f8_decimal_division": f"""
  WITH spans AS ({_SPANS})
  SELECT o_custkey, CAST(round(CAST(total * 10000 / ({_MONTHS} + 1) AS DECIMAL(30,6)), 0) AS DOUBLE)
           / 10000 AS monthly
  FROM spans
""",
    "f8_long_division": """
  WITH parts AS (
    SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS HUGEINT) AS cents, CAST(o_custkey + 101 AS HUGEINT) AS units
    FROM orders),
  scaled AS (
    SELECT o_orderkey, (cents * 200 + units) // (units * 2) AS q FROM parts)
  SELECT o_orderkey, CAST(q // 10000 AS VARCHAR) || '.' || lpad(CAST(q % 10000 AS VARCHAR), 4, '0') AS quotient FROM scaled
""",
    "f10_date_literal": """
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
  WHERE CAST(o_orderdate AS DATE) = '1997-05-28'
""",
    "f11_rounding": """
  SELECT event_id, CAST(CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(17,1)) AS DOUBLE) AS rounded
  FROM events
""",
}
