"""DuckDB SQL for the engine's own queries, over the parquet tables that the workbooks were written from."""

from __future__ import annotations

from ..fixtures import CELL_LIMIT
from .books import GAP, SERIALS, day_of
from .queries import SHARED, TABLES


def _read_back(column: str, kind: str) -> str:
    if kind == "d":
        return f"CAST({column} AS DOUBLE) AS {column}"
    if kind == "t":
        return f"CAST({column} AS DATE) AS {column}"
    return f"substr({column}, 1, {CELL_LIMIT}) AS {column}" if column in ("text", "html") else column


def _table(name: str) -> str:
    return f"SELECT {', '.join(_read_back(c, k) for c, k in TABLES[name].items())} FROM {name}"


def _with(sql: str, *names: str) -> str:
    for n in names:
        sql = sql.replace("{" + n + "}", f"({_table(n)})")
    return sql


def _semi(condition: str, kind: str) -> str:
    return _with(f"SELECT c_custkey, c_name FROM {{customer}} WHERE {kind} (SELECT 1 FROM orders o WHERE o.o_custkey = c_custkey{condition})", "customer")


def _nation(*extra: str) -> str:
    return f"SELECT {', '.join(extra)} FROM nation"


ORACLE_SQL: dict[str, str] = {
    **{f"scan_{t}": _table(t) for t in TABLES},
    **{name: _with(sql, *names) for name, (sql, names) in SHARED.items()},
    "asof_join": _with(
        "SELECT l.o_orderkey, r.o_orderdate AS asof_day FROM (SELECT * FROM {orders} WHERE o_orderstatus = 'O') AS l ASOF LEFT JOIN (SELECT * FROM {orders} WHERE o_orderstatus = 'F') AS r "
        "ON l.o_custkey = r.o_custkey AND l.o_orderdate >= r.o_orderdate",
        "orders",
    ),
    "scan_by_sheet_name": _table("region"),
    "scan_by_sheet_index": _table("region"),
    "scan_threads_1": _table("lineitem"),
    "scan_threads_8": _table("lineitem"),
    "scan_skip_rows": _table("nation"),
    "scan_skip_rows_deep": _table("nation"),
    "scan_mixed_row_places_1": _table("orders"),
    "scan_mixed_row_places_8": _table("orders"),
    "scan_no_header_generic_names": _nation('CAST(n_nationkey AS DOUBLE) AS "Numeric0"', 'n_name AS "String1"', 'CAST(n_regionkey AS DOUBLE) AS "Numeric2"'),
    "scan_all_string_no_header": "SELECT 'p_name' AS \"String0\", 'p_brand' AS \"String1\" UNION ALL SELECT p_name, p_brand FROM part",
    "scan_all_string_has_header": "SELECT p_name, p_brand FROM part",
    "scan_types_subset_coerce": "SELECT printf('%f', CAST(o_orderkey AS DOUBLE)) AS o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, o_orderstatus, "
    "printf('%f', o_totalprice) AS o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders",
    "scan_coerce_bool": "SELECT printf('%f', CAST(doc_id AS DOUBLE)) AS doc_id, CASE WHEN quality = 1 THEN 'TRUE' ELSE 'FALSE' END AS quality, toxic = 1 AS toxic FROM labels",
    "scan_force_types_nulls": _nation("CAST(NULL AS VARCHAR) AS n_nationkey", "n_name", "CAST(NULL AS DATE) AS n_regionkey"),
    "scan_coerce_inferred_only": _table("nation"),
    "scan_extra_types": _nation("CAST(n_nationkey AS DOUBLE) AS n_nationkey", "n_name", "CAST(n_regionkey AS DOUBLE) AS n_regionkey", 'CAST(NULL AS DATE) AS "Column 3"', 'CAST(NULL AS VARCHAR) AS "Column 4"'),
    "scan_mixed_column_nulls": "SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, c_name, CASE WHEN c_custkey % 7 <> 3 THEN c_acctbal END AS c_acctbal FROM customer",
    "scan_sparse_cells": "SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, "
    + ", ".join(f"CASE WHEN c_custkey % 5 <> 0 OR c_custkey <= 5 THEN {'CAST(' + c + ' AS DOUBLE)' if k == 'd' else c} END AS {c}" for c, k in TABLES["customer"].items() if c != "c_custkey")
    + " FROM customer",
    "scan_row_gaps": f"{_table('nation')} UNION ALL SELECT NULL, NULL, NULL FROM range({GAP}) UNION ALL SELECT -1, 'after the gap', -2",
    "scan_bool_column": "SELECT CAST(doc_id AS DOUBLE) AS doc_id, quality = 1 AS quality, toxic = 1 AS toxic FROM labels",
    "scan_pre1970_date": "SELECT CAST(k AS DOUBLE) AS k, CAST(d AS DATE) AS d FROM (VALUES " + ", ".join(f"({i}, '{day_of(v)}')" for i, v in enumerate(SERIALS)) + ") AS v(k, d)",
    "scan_inline_strings": _table("nation"),
    "scan_given_schema": _nation("CAST(n_nationkey AS DOUBLE) AS key", "n_name AS title", "CAST(NULL AS VARCHAR) AS area"),
    "udtf_scan_nation": _table("nation"),
    "view_using": "SELECT r_name, CAST(r_regionkey + 1 AS DOUBLE) AS next_key FROM region",
    "ctas_roundtrip": _with("SELECT * FROM {supplier} WHERE s_acctbal > 0", "supplier"),
    "count_star": "SELECT count(*) AS n FROM lineitem",
    "scan_columns": "SELECT CAST(o_orderdate AS DATE) AS o_orderdate, CAST(o_orderkey AS DOUBLE) AS o_orderkey FROM orders",
    "filters_of_every_kind": _with(
        "SELECT * FROM {orders} WHERE o_orderpriority LIKE '1%' AND o_orderstatus IN ('F', 'O', 'P') AND o_totalprice >= 1000 AND o_orderkey IS NOT NULL "
        "AND (o_custkey < 700 OR o_custkey <> 900) AND o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND contains(o_orderpriority, 'URG')",
        "orders",
    ),
    "filter_project": _with("SELECT l_orderkey, l_quantity * 2 AS double_quantity FROM {lineitem} WHERE l_quantity < 5 AND l_returnflag = 'R' AND l_shipdate >= DATE '1998-01-01'", "lineitem"),
    "limit_sorted": _with("SELECT o_orderkey, o_orderdate FROM {orders} ORDER BY o_orderkey DESC LIMIT 25", "orders"),
    "topk": _with("SELECT c_custkey, c_acctbal FROM {customer} ORDER BY c_acctbal DESC, c_custkey LIMIT 10", "customer"),
    "q1_pricing_summary": _with(
        "SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS sum_qty, CAST(round(sum(l_extendedprice) * 100) AS BIGINT) AS sum_price_cents, "
        "CAST(round(sum(l_discount) * 100) AS BIGINT) AS sum_disc_percent, count(*) AS n FROM {lineitem} WHERE l_shipdate <= DATE '2001-06-30' GROUP BY l_returnflag, l_linestatus",
        "lineitem",
    ),
    "join_orders_customer": _with(
        "SELECT c_mktsegment, count(*) AS n, CAST(round(sum(o_totalprice) * 100) AS BIGINT) AS total_cents FROM {orders} JOIN {customer} ON o_custkey = c_custkey GROUP BY c_mktsegment", "orders", "customer"
    ),
    "left_join_count": _with("SELECT c_custkey, count(o_orderkey) AS n FROM {customer} LEFT JOIN {orders} ON o_custkey = c_custkey GROUP BY c_custkey", "orders", "customer"),
    "semi_join": _semi(" AND o.o_totalprice > 200000", "EXISTS"),
    "anti_join": _semi(" AND o.o_totalprice > 400000 AND o.o_orderpriority = '1-URGENT'", "NOT EXISTS"),
    "rollup_segment": _with("SELECT c_mktsegment, c_nationkey, count(*) AS n FROM {customer} GROUP BY ROLLUP (c_mktsegment, c_nationkey)", "customer"),
    "distinct_agg": _with(
        "SELECT l_returnflag, count(DISTINCT l_suppkey) AS n_suppliers, min(l_shipdate) AS first_day, max(l_shipdate) AS last_day FROM {lineitem} GROUP BY l_returnflag", "lineitem"
    ),
    "window_rank": _with(
        "SELECT s_suppkey, s_nationkey, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS INTEGER) AS place, "
        "lag(s_suppkey) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS ahead FROM {supplier}",
        "supplier",
    ),
    "union_intersect_except": "SELECT CAST(k AS DOUBLE) AS k FROM ((SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier) INTERSECT SELECT n_nationkey FROM nation EXCEPT SELECT 3) q",
    "subquery_cte": _with(
        "WITH t AS (SELECT o_custkey, sum(o_totalprice) AS total FROM {orders} GROUP BY o_custkey) SELECT o_custkey, CAST(round(total * 100) AS BIGINT) AS total_cents FROM t WHERE total > 1.5 * (SELECT avg(total) FROM t)", "orders"
    ),
}
