"""DuckDB SQL twins of the bindings and queries, for the correctness gate.

Each binding below mirrors ``panelspark.plans.bindings`` exactly. Queries are built as
``WITH <bindings> <body>``; only the bindings a body mentions are included.
"""

from __future__ import annotations

import re

BINDINGS: dict[str, str] = {
    "entities": """SELECT greatest(count(*) // 2, 1) AS ne FROM supplier""",
    "panel_raw": """
        SELECT gvkey, datadate, fyearq, fqtr, CAST(datadate + CAST(20 + k % 60 AS INTEGER) AS DATE) AS rdq,
               price / 1000 AS saleq,
               price / 1000 - 250 + CAST(k % 7 - 3 AS DOUBLE) * CAST(20 AS DOUBLE) AS ibq,
               CAST(1 + k % 50 AS DOUBLE) AS cshoq, price / 10000 AS prccq
        FROM (SELECT CAST(o_custkey // 5 AS VARCHAR) AS gvkey,
                     last_day(CAST(date_trunc('quarter', o_orderdate) AS DATE)
                              + to_months(CASE WHEN o_orderkey % 19 = 0 THEN -1 ELSE 2 END)) AS datadate,
                     CAST(year(o_orderdate) AS INTEGER) AS fyearq,
                     CAST(quarter(o_orderdate) AS INTEGER) AS fqtr,
                     min(o_orderkey) AS k, max(o_totalprice) AS price
              FROM orders GROUP BY 1, 2, 3, 4) o""",
    "links": """
        SELECT CAST(o_custkey // 5 AS VARCHAR) AS gvkey, CAST((o_custkey // 5) % ne AS INTEGER) AS lpermno,
               CASE o_orderstatus WHEN 'F' THEN 'LC' WHEN 'O' THEN 'LU' ELSE 'NR' END AS linktype,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'P'
                    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'C' ELSE 'J' END AS linkprim,
               CAST(o_orderdate AS DATE) AS linkdt,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL
                    ELSE CAST(CAST(o_orderdate AS DATE) + 120 AS DATE) END AS linkenddt
        FROM orders, entities""",
    "name_history": """
        SELECT CAST(p_partkey % ne AS INTEGER) AS permno,
               CAST(DATE '1995-01-01' + CAST((p_partkey // ne) * 2700 // ns AS INTEGER) AS DATE) AS namedt,
               CAST(DATE '1995-01-01' + CAST((p_partkey // ne + 1) * 2700 // ns AS INTEGER) - 1 AS DATE) AS nameenddt,
               CAST(100 + (p_partkey * 37) % 9900 AS INTEGER) AS siccd
        FROM part, entities, (SELECT max(p_partkey // ne) + 1 AS ns FROM part, entities) s""",
    "daily_returns": """
        SELECT CAST(l_suppkey % ne AS INTEGER) AS permno, CAST(date_trunc('week', l_shipdate) AS DATE) AS dlycaldt,
               avg(l_discount) - avg(l_tax) AS dlyret
        FROM lineitem, entities GROUP BY 1, 2""",
    "market_index": """
        SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS dlycaldt,
               sum(l_extendedprice * l_discount) / sum(l_extendedprice) - avg(l_tax) AS dlytotret
        FROM lineitem GROUP BY 1""",
    "event_keys": """
        SELECT DISTINCT CAST(o_custkey % ne AS INTEGER) AS permno, CAST(o_orderdate AS DATE) AS rdq
        FROM orders, entities""",
    "reg_panel": """
        SELECT l_orderkey AS obs_id, l_linenumber AS obs_line, l_partkey AS obs_part, l_suppkey AS obs_supp, CAST(l_suppkey AS INTEGER) AS permno,
               CAST(100 + (l_partkey * 37) % 9900 AS INTEGER) AS siccd,
               CAST(year(l_shipdate) AS INTEGER) AS fyearq,
               CAST(1 + l_partkey % 12 AS DOUBLE) AS ff12num,
               l_discount - 0.05 AS sue, CAST(l_linenumber % 2 AS INTEGER) AS same_sign,
               CAST(l_returnflag = 'R' AS INTEGER) AS loss, ln(l_extendedprice) AS log_mve,
               (l_tax - 0.04) + 0.5 * (l_discount - 0.05) * (1 + l_linenumber % 2)
                   + 0.001 * (l_quantity - 25) AS bhar
        FROM lineitem""",
    "user_returns": """
        SELECT user_id AS permno, CAST(ts AS DATE) AS dlycaldt, avg(value) / 1000 AS dlyret
        FROM events GROUP BY 1, 2""",
    "user_market": """
        SELECT CAST(ts AS DATE) AS dlycaldt, avg(value) / 1000 AS dlytotret FROM events GROUP BY 1""",
    "user_events": """
        SELECT DISTINCT user_id AS permno, CAST(ts AS DATE) AS rdq FROM events WHERE event_type = 'error'""",
    "user_calendar": """
        SELECT CAST(row_number() OVER (ORDER BY dlycaldt) AS INTEGER) AS td, dlycaldt AS date
        FROM (SELECT DISTINCT dlycaldt FROM user_returns)""",
    # derived roles
    "calendar": """
        SELECT CAST(row_number() OVER (ORDER BY dlycaldt) AS INTEGER) AS td, dlycaldt AS date
        FROM (SELECT DISTINCT dlycaldt FROM daily_returns)""",
}

# derived bindings depend on others
DEPENDS = {"calendar": ["daily_returns"]}


def with_bindings(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the CTEs it (transitively) mentions, in dependency order."""
    ctes = {**BINDINGS, **(extra or {})}
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in DEPENDS.get(name, []):
            visit(dep)
        text = ctes[name]
        for other in ctes:
            if other != name and re.search(rf"\b{other}\b", text):
                visit(other)
        order.append(name)

    for name in ctes:
        if re.search(rf"\b{name}\b", body):
            visit(name)
    if not order:
        return body
    parts = [f"{n} AS ({ctes[n]})" for n in order]
    stripped = body.lstrip()
    if stripped[:4].upper() == "WITH":
        return "WITH " + ",\n".join(parts) + ",\n" + stripped[4:]
    return "WITH " + ",\n".join(parts) + "\n" + body
