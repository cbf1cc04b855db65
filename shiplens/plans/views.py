"""Fixture views as SQL text (runs unchanged in Spark SQL and DuckDB).

Oracle queries are written as ``WITH <views> SELECT ...`` over the driver
tables; :func:`with_views` prepends the views a query body needs.
"""

from __future__ import annotations

import re

VIEW_SQL = {
    "shipments": """
SELECT l.l_orderkey, l.l_linenumber,
  CAST(l.l_shipdate AS DATE) AS ship_date,
  CAST(s.s_nationkey % 9 + 1 AS INT) AS origin_zone,
  CAST(c.c_nationkey % 9 + 1 AS INT) AS dest_zone,
  CASE CAST(l.l_suppkey % 7 AS INT) WHEN 0 THEN 'USPS' WHEN 1 THEN 'FedEx' WHEN 2 THEN 'UPS' WHEN 3 THEN 'DHL'
       WHEN 4 THEN 'Amazon_Logistics' WHEN 5 THEN 'OnTrac' ELSE 'LaserShip' END AS carrier,
  CASE substr(o.o_orderpriority,1,1) WHEN '1' THEN 'OVERNIGHT' WHEN '2' THEN 'EXPRESS' WHEN '3' THEN 'PRIORITY'
       WHEN '4' THEN 'STANDARD' ELSE 'ECONOMY' END AS service_level,
  l.l_quantity * 5e-1 AS package_weight_lbs,
  4e0 + p.p_size * 3e-1 AS package_length_in,
  3e0 + p.p_size * 2e-1 AS package_width_in,
  2e0 + p.p_size * 1e-1 AS package_height_in,
  (4e0 + p.p_size * 3e-1) * (3e0 + p.p_size * 2e-1) * (2e0 + p.p_size * 1e-1) AS package_volume_cubic_in,
  l.l_extendedprice / 5e1 AS insurance_value,
  greatest(8e-1, CASE substr(o.o_orderpriority,1,1) WHEN '1' THEN 1.3e0 WHEN '2' THEN 2.2e0 WHEN '3' THEN 3.4e0
       WHEN '4' THEN 5.7e0 ELSE 8.6e0 END + (c.c_nationkey % 9) * 1e-1 + (l.l_suppkey % 7) * 5e-2
       + (l.l_extendedprice / 1e5) * (l.l_extendedprice / 1e5) * 1e1 - 1e0 + CASE WHEN l.l_orderkey % 97 = 0 THEN 2e1 ELSE 0e0 END) AS transit_time_days,
  greatest(2.5e0, l.l_quantity * 3e-1 + o.o_totalprice / 2e4 + l.l_tax * 5e1 + CASE WHEN l.l_orderkey % 89 = 0 THEN 6e1 ELSE 0e0 END) AS shipping_cost_usd
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey""",
    "shipments_raw": """
SELECT *, CASE WHEN l_orderkey % 53 = 0 THEN CAST(NULL AS DOUBLE) ELSE transit_time_days END AS transit_time_raw,
 CASE WHEN l_orderkey % 101 = 0 THEN CAST(NULL AS DOUBLE) ELSE shipping_cost_usd END AS shipping_cost_raw FROM shipments""",
    "lanes": """
SELECT o.o_orderkey, lpad(CAST(c.c_custkey * 7919 % 100000 AS STRING), 5, '0') AS origin_zip,
 lpad(CAST((o.o_orderkey * 104729 + 31) % 100000 AS STRING), 5, '0') AS dest_zip FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "requests": """
SELECT l.l_orderkey AS request_id, l.l_linenumber,
 CASE WHEN l.l_orderkey % 101 = 0 THEN CAST(NULL AS DATE) ELSE CAST(l.l_shipdate AS DATE) END AS ship_date,
 CAST(l.l_suppkey % 11 AS INT) AS zone,
 CASE CAST(l.l_partkey % 9 AS INT) WHEN 0 THEN 'USPS' WHEN 1 THEN 'FedEx' WHEN 2 THEN 'UPS' WHEN 3 THEN 'DHL' WHEN 4 THEN 'Amazon_Logistics'
  WHEN 5 THEN 'OnTrac' WHEN 6 THEN 'LaserShip' WHEN 7 THEN 'Regional_Express' ELSE 'TNT' END AS carrier,
 CASE l.l_returnflag WHEN 'A' THEN 'Ground' WHEN 'N' THEN 'Express' ELSE (CASE l.l_linestatus WHEN 'O' THEN 'Priority' ELSE 'Overnight' END) END AS service_level,
 l.l_quantity * 1.5e0 AS package_weight_lbs, 4e0 + p.p_size * 3e-1 AS package_length_in, 3e0 + p.p_size * 2e-1 AS package_width_in,
 2e0 + p.p_size * 1e-1 AS package_height_in, l.l_extendedprice / 1e1 AS insurance_value
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "prediction_events": """
SELECT event_id AS request_id, ts, event_type <> 'error' AS success, value AS response_ms FROM events""",
}

# views that other views read
_DEPENDS = {"shipments_raw": ["shipments"]}


def with_views(body: str, *extra_ctes: tuple[str, str]) -> str:
    """Prefix ``body`` with the fixture views it references (plus extra CTEs).

    ``extra_ctes`` are (name, sql) pairs placed after the views, so they may
    read them.
    """
    text = body + " ".join(sql for _, sql in extra_ctes)
    need: list[str] = []

    def add(name):
        for dep in _DEPENDS.get(name, []):
            add(dep)
        if name not in need:
            need.append(name)

    for name in VIEW_SQL:
        if re.search(rf"\b{name}\b", text):
            add(name)
    ctes = [f"{n} AS ({VIEW_SQL[n]}\n)" for n in need] + [f"{n} AS ({sql}\n)" for n, sql in extra_ctes]
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        # merge the body's own CTE list after the views
        ctes.append(stripped[5:])
        return "WITH " + ",\n".join(ctes)
    if not ctes:
        return body
    return "WITH " + ",\n".join(ctes) + "\n" + body
