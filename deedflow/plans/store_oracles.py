"""The queries on stores in plain SQL."""

from __future__ import annotations

# Contracts and sales on customers as properties, and which of them are stored.
_MIXED = """
  properties AS (
    SELECT c_custkey AS property, CASE WHEN c_acctbal < 0 THEN 'Sold' ELSE 'For Sale' END AS status,
           c_mktsegment IN ('HOUSEHOLD', 'BUILDING') AS house, c_mktsegment <> 'MACHINERY' AS client FROM customer),
  events AS (
    SELECT o_orderkey AS seq, o_custkey AS property, CAST(o_orderdate AS DATE) AS day,
           o_orderpriority IN ('1-URGENT', '2-HIGH') AS contract,
           CASE WHEN o_orderkey % 7 <> 0 THEN CASE WHEN o_orderkey % 5 = 0 THEN 'Yes' ELSE 'No' END END AS exclusivity,
           status, coalesce(house, false) AS house, o_custkey IS NOT NULL AND status IS NULL AS no_property,
           o_custkey IS NOT NULL AND NOT coalesce(client, false) AS no_client
    FROM orders LEFT JOIN properties ON property = o_custkey),
  contracts AS (
    SELECT *, coalesce(earlier = 'Yes' OR (earlier = 'No' AND exclusivity = 'Yes'), false) AS clash FROM (
      SELECT *, first_value(CASE WHEN NOT no_property THEN exclusivity END IGNORE NULLS) OVER (
          PARTITION BY day ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
      FROM events WHERE contract)),
  openings AS (SELECT property, seq FROM contracts WHERE NOT clash AND NOT no_property AND house),
  dated AS (
    SELECT e.*, o.seq AS epoch FROM (SELECT * FROM events WHERE NOT contract) e
    ASOF LEFT JOIN openings o ON e.property = o.property AND e.seq > o.seq),
  sales AS (
    SELECT *, coalesce(status = 'Sold' AND epoch IS NULL, false) OR coalesce(seq > first, false) AS sold FROM (
      SELECT *, CASE WHEN status IS NOT NULL THEN min(CASE WHEN NOT no_property AND NOT no_client THEN seq END)
          OVER (PARTITION BY property, epoch) END AS first
      FROM dated))
"""

ORACLES: dict[str, str] = {
    "s5_reload": """
  WITH phases AS (
    SELECT 'loaded' AS step, 'owners' AS table_name, s_suppkey AS id FROM supplier
    UNION ALL SELECT 'loaded', 'clients', c_custkey FROM customer
    UNION ALL SELECT 'refused duplicate:client_ID', 'owners', s_suppkey FROM supplier
    UNION ALL SELECT 'refused duplicate:client_ID', 'clients', c_custkey FROM customer
    UNION ALL SELECT 'reloaded', 'owners', s_suppkey FROM supplier WHERE s_suppkey % 2 = 1
    UNION ALL SELECT 'reloaded', 'clients', c_custkey FROM customer WHERE c_custkey % 3 = 0)
  SELECT step, table_name, count(*) AS stored, CAST(sum(id) AS BIGINT) AS key_sum FROM phases GROUP BY step, table_name
""",
    "s2_literal_rows": """
  SELECT s_suppkey AS "agent_ID", r_name AS comp_name, CAST(NULL AS DECIMAL(2,1)) AS comission_rate
  FROM supplier JOIN region ON s_nationkey % 7 = r_regionkey
""",
    "g9_judge_mixed": f"""
  WITH {_MIXED}, judged AS (
    SELECT 'contracts_owner' AS table_name, seq AS id, concat_ws(',',
        CASE WHEN clash THEN 'exclusivity_clash' END, CASE WHEN no_property THEN 'orphan:property_ID' END) AS reasons
    FROM contracts
    UNION ALL
    SELECT 'transactions', seq, concat_ws(',', CASE WHEN sold THEN 'already_sold' END,
        CASE WHEN no_property THEN 'orphan:property_ID' END, CASE WHEN no_client THEN 'orphan:client_ID' END)
    FROM sales)
  SELECT table_name, id, reasons = '' AS accepted, reasons FROM judged
""",
    "g9_apply_mixed": """
  WITH parted AS (
    SELECT *, CASE WHEN day < DATE '1997-01-01' THEN 0 ELSE 1 END AS part
    FROM (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders)),
  properties AS (
    SELECT c_custkey AS property, c_mktsegment IN ('HOUSEHOLD', 'BUILDING') AS house, c_mktsegment <> 'MACHINERY' AS client,
           CASE WHEN c_acctbal < 0 THEN 'Sold' ELSE 'For Sale' END AS status FROM customer),
  contracts AS (
    SELECT part, o_orderkey AS seq, o_custkey AS property, day, house,
           CASE WHEN o_orderkey % 7 <> 0 THEN CASE WHEN o_orderkey % 5 = 0 THEN 'Yes' ELSE 'No' END END AS exclusivity
    FROM parted LEFT JOIN properties ON property = o_custkey
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND (o_custkey IS NULL OR property IS NOT NULL)),
  signed AS (
    SELECT * FROM (
      SELECT *, first_value(exclusivity IGNORE NULLS) OVER (
          PARTITION BY day ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier FROM contracts)
    WHERE NOT coalesce(earlier = 'Yes' OR (earlier = 'No' AND exclusivity = 'Yes'), false)),
  events AS (
    SELECT part, seq, property, 'For Sale' AS leaves, day FROM signed WHERE house
    UNION ALL
    SELECT part, o_orderkey, o_custkey, 'Sold', day FROM parted JOIN properties ON property = o_custkey
    WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') AND client),
  before AS (
    SELECT e.*, coalesce(lag(leaves) OVER (PARTITION BY property ORDER BY part, seq), p.status) AS status
    FROM events e JOIN properties p USING (property)),
  sold AS (SELECT property, day FROM before WHERE leaves = 'Sold' AND status <> 'Sold'),
  last AS (SELECT property, arg_max(leaves, (part, seq)) AS status FROM events GROUP BY property)
  SELECT p.property AS "property_ID", coalesce(l.status, p.status) AS prop_status, first_contract, sold_on,
         coalesce(sales, 0) AS sales, coalesce(sales, 0) AS logged
  FROM properties p LEFT JOIN last l USING (property)
    LEFT JOIN (SELECT property, min(day) AS first_contract FROM signed GROUP BY property) USING (property)
    LEFT JOIN (SELECT property, min(day) AS sold_on, count(*) AS sales FROM sold GROUP BY property) USING (property)
""",
    "a5_a6_kept_state": f"""
  WITH {_MIXED}
  SELECT day AS date_contract, count(*) AS stored, count(*) FILTER (WHERE exclusivity = 'Yes') AS exclusive,
         count(*) FILTER (WHERE exclusivity = 'No') AS open
  FROM contracts WHERE NOT clash AND NOT no_property GROUP BY day
""",
    "k1_k2_judge_chains": """
  SELECT c_custkey * 50 + step AS seq, c_custkey * 30 + (step + 1) // 2 AS "owner_ID", step % 2 = 0 AS accepted,
         CASE step % 2 WHEN 1 THEN 'duplicate:contact' ELSE '' END AS reasons
  FROM customer, range(50) t(step)
""",
    "k11_wide_ids": """
  SELECT c_custkey AS "client_ID", CAST(c_custkey AS VARCHAR) AS contact FROM customer WHERE c_custkey < 1000000
  UNION ALL SELECT c_custkey + 5000000000, CAST(c_custkey + 5000000000 AS VARCHAR) FROM customer
""",
}
