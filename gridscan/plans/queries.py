"""The engine's own queries: scans of workbooks under every option, and relational algebra over scans."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import register
from . import books
from .books import book, table_book

Query = Callable[[SparkSession, str], DataFrame]
#: Column -> what it reads back as: d double, t date, s string.
TABLES = {
    "region": {"r_regionkey": "d", "r_name": "s"},
    "nation": {"n_nationkey": "d", "n_name": "s", "n_regionkey": "d"},
    "customer": {"c_custkey": "d", "c_name": "s", "c_nationkey": "d", "c_acctbal": "d", "c_mktsegment": "s"},
    "supplier": {"s_suppkey": "d", "s_name": "s", "s_nationkey": "d", "s_acctbal": "d"},
    "part": {"p_partkey": "d", "p_name": "s", "p_brand": "s", "p_type": "s", "p_size": "d", "p_retailprice": "d"},
    "orders": {"o_orderkey": "d", "o_custkey": "d", "o_orderstatus": "s", "o_totalprice": "d", "o_orderdate": "t", "o_orderpriority": "s"},
    "lineitem": dict.fromkeys("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax".split(), "d")
    | {"l_returnflag": "s", "l_linestatus": "s", "l_shipdate": "t"},
    "events": {"event_id": "d", "ts": "t", "user_id": "d", "event_type": "s", "value": "d", "props": "s"},
    "labels": {"doc_id": "d", "quality": "d", "toxic": "d"},
    "conversations": {"conv_id": "d", "turn": "d", "role": "s", "text": "s"},
    "benchmark": {"item_id": "d", "text": "s"},
    "documents": {"doc_id": "d", "text": "s", "lang": "s", "source": "s", "n_chars": "d"},
    "pages": {"page_id": "d", "url": "s", "html": "s"},
}


def scan(spark: SparkSession, path: str, **options) -> DataFrame:
    register(spark)
    reader = spark.read.format("gridscan")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def table(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    """A table by way of its workbook. All-text tables need has_header."""
    return scan(spark, table_book(spark, sf_dir, name), **options)


def _scans() -> dict[str, Query]:
    return {f"scan_{t}": (lambda spark, sf, t=t: table(spark, sf, t)) for t in TABLES}


def _variant(variant: str, tables: list[str], make, **options) -> Query:
    return lambda spark, sf: scan(spark, book(spark, sf, variant, tables, make), **options)


#: Amounts below this are summed as whole numbers and millionths, which no number of rows makes too large for a long.
_WHOLE = 1_000_000


def _exact(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Parts of amounts that sum exactly: sums of doubles depend on the order of rows, from some millions of rows on by whole cents.

    An amount of up to six decimals is a whole number and millionths. Others, and large ones, are decimals, which take several times as long.
    """
    own = [c for c in columns if c in df.columns]
    if not own:
        return df
    df = df.withColumns({f"{c}_millionths": F.when(F.abs(df[c]) < _WHOLE, F.rint(df[c] * 1e6).cast("bigint")) for c in own})
    df = df.withColumns({f"{c}_millionths": F.when(df[f"{c}_millionths"] / F.lit(1e6) == df[c], df[f"{c}_millionths"]) for c in own})
    return df.withColumns(
        {f"{c}_whole": F.floor(df[f"{c}_millionths"] / F.lit(1e6)) for c in own} | {f"{c}_other": F.when(df[f"{c}_millionths"].isNull(), df[c].cast("decimal(28,6)")) for c in own}
    )


def _total(c: str) -> str:
    """The sum of an amount from its parts."""
    return (
        f"CASE WHEN count({c}) > 0 THEN CAST(coalesce(CAST(sum({c}_whole) AS DECIMAL(28,6)), 0) + coalesce(CAST(sum({c}_millionths - {c}_whole * 1000000) AS DECIMAL(28,0)), 0) * CAST(0.000001 AS DECIMAL(6,6)) "
        f"+ coalesce(sum({c}_other), 0) AS DECIMAL(38,6)) END"
    )


def _sql(text: str, *names: str, exact: tuple[str, ...] = (), **options) -> Query:
    """Spark SQL over scans, each table as a view of its own name with a prefix; columns in ``exact`` are summed exactly."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        whole = text
        for c in exact:
            whole = whole.replace(f"sum({c})", f"({_total(c)})")
        return spark.sql(whole, **{n: _exact(table(spark, sf, n, **options), exact) for n in names})

    return run


def _udtf(spark: SparkSession, sf: str) -> DataFrame:
    register(spark)
    return spark.sql(f"SELECT * FROM read_sheet('{table_book(spark, sf, 'nation')}', threads => 2)")


def _view(spark: SparkSession, sf: str) -> DataFrame:
    register(spark)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW gridscan_region USING gridscan OPTIONS (path '{table_book(spark, sf, 'region')}')")
    return spark.sql("SELECT r_name, r_regionkey + 1 AS next_key FROM gridscan_region")


def _ctas(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "supplier").createOrReplaceTempView("gridscan_supplier")
    name = f"gridscan_ctas_{uuid.uuid4().hex}"  # a folder of an earlier session's table may still be there
    spark.sql(f"CREATE TABLE {name} USING parquet AS SELECT * FROM gridscan_supplier WHERE s_acctbal > 0")
    return spark.table(name)


#: Queries whose SQL Spark and DuckDB read alike: (SQL, tables).
SHARED: dict[str, tuple[str, tuple[str, ...]]] = {
    "right_join": ("SELECT s_suppkey, n_name FROM {supplier} RIGHT JOIN {nation} ON s_nationkey = n_nationkey AND s_acctbal > 5000", ("supplier", "nation")),
    "full_join": (
        "SELECT a.k AS supplier_key, b.k AS customer_key FROM (SELECT s_suppkey AS k FROM {supplier} WHERE s_acctbal > 0) AS a FULL JOIN (SELECT c_custkey AS k FROM {customer} WHERE c_custkey <= 150) AS b ON a.k = b.k",
        ("supplier", "customer"),
    ),
    "cross_join": ("SELECT r_name, n_name FROM {region} CROSS JOIN {nation}", ("region", "nation")),
    "theta_join": ("SELECT a.n_name AS low, b.n_name AS high FROM {nation} AS a JOIN {nation} AS b ON a.n_regionkey <> b.n_regionkey AND a.n_nationkey < b.n_nationkey", ("nation",)),
    "range_join": (
        "SELECT a.s_suppkey AS k, b.s_suppkey AS near_k FROM {supplier} AS a JOIN {supplier} AS b ON b.s_acctbal BETWEEN a.s_acctbal - 100 AND a.s_acctbal + 100 AND a.s_suppkey < b.s_suppkey WHERE a.s_nationkey < 12",
        ("supplier",),
    ),
    "self_join": ("SELECT a.o_custkey, count(*) AS n FROM {orders} AS a JOIN {orders} AS b ON a.o_custkey = b.o_custkey AND a.o_orderdate < b.o_orderdate GROUP BY a.o_custkey", ("orders",)),
    "in_subquery": ("SELECT c_custkey FROM {customer} WHERE c_nationkey IN (SELECT n_nationkey FROM {nation} WHERE n_regionkey = 1) AND c_custkey NOT IN (SELECT o_custkey FROM {orders} WHERE o_totalprice > 490000)", ("customer", "nation", "orders")),
    "correlated_subquery": (
        "SELECT o.o_orderkey FROM {orders} AS o WHERE o.o_totalprice > (SELECT 1.9 * avg(p.o_totalprice) FROM {orders} AS p WHERE p.o_custkey = o.o_custkey)",
        ("orders",),
    ),
    "group_having": ("SELECT o_custkey, count(*) AS n, max(o_orderdate) AS last_day FROM {orders} GROUP BY o_custkey HAVING count(*) > 12 AND min(o_totalprice) < 50000", ("orders",)),
    "grouping_sets": (
        "SELECT c_mktsegment, c_nationkey, CAST(grouping(c_nationkey) AS INT) AS all_nations, count(*) AS n FROM {customer} GROUP BY GROUPING SETS ((c_mktsegment, c_nationkey), (c_mktsegment), ())",
        ("customer",),
    ),
    "cube": ("SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(round(sum(o_totalprice) * 100) AS BIGINT) AS cents FROM {orders} GROUP BY CUBE (o_orderstatus, o_orderpriority)", ("orders",)),
    "filtered_aggregates": (
        "SELECT o_orderstatus, count(*) FILTER (WHERE o_totalprice > 250000) AS dear, count(DISTINCT o_custkey) AS customers, max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END) AS last_urgent, "
        "CAST(round(stddev_samp(o_totalprice)) AS BIGINT) AS deviation FROM {orders} GROUP BY o_orderstatus",
        ("orders",),
    ),
    "window_frames": (
        "SELECT o_orderkey, CAST(round(sum(o_totalprice) OVER w * 100) AS BIGINT) AS three_cents, first_value(o_orderkey) OVER w AS first_key, lead(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS later, "
        "count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderdate RANGE BETWEEN INTERVAL '90' DAY PRECEDING AND CURRENT ROW) AS in_90_days, CAST(ntile(4) OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS INT) AS quarter, "
        "CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS INT) AS level FROM {orders} WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)",
        ("orders",),
    ),
    "union_all": ("SELECT n_nationkey AS k FROM {nation} UNION ALL SELECT s_nationkey FROM {supplier}", ("nation", "supplier")),
    "intersect_all": ("SELECT c_nationkey AS k FROM {customer} INTERSECT ALL SELECT s_nationkey FROM {supplier}", ("customer", "supplier")),
    "except_all": ("SELECT c_nationkey AS k FROM {customer} EXCEPT ALL SELECT s_nationkey FROM {supplier}", ("customer", "supplier")),
    "string_functions": (
        "SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, substr(p_type, 2, 5) AS part, CAST(length(p_name) AS BIGINT) AS n, replace(p_brand, '#', '-') AS dashed, concat(p_brand, '/', p_type) AS both_names, "
        "lpad(p_brand, 12, '*') AS padded, trim(concat('  ', p_type, ' ')) AS trimmed, reverse(p_brand) AS turned, p_name LIKE '%a%' AS has_a, CAST(instr(p_name, 'e') AS BIGINT) AS first_e, split_part(p_type, ' ', 1) AS word FROM {part}",
        ("part",),
    ),
    "date_and_number_functions": (
        "SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m, CAST(quarter(o_orderdate) AS BIGINT) AS q, CAST(day(last_day(o_orderdate)) AS BIGINT) AS end_day, "
        "CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, CAST(o_orderdate + INTERVAL '40' DAY AS DATE) AS due, abs(o_totalprice - 250000) AS off, CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands, "
        "CAST(ceil(o_totalprice / 1000) AS BIGINT) AS up, greatest(o_totalprice, 100000) AS at_least, coalesce(nullif(o_orderstatus, 'F'), 'done') AS state, CASE WHEN o_totalprice < 1e5 THEN 'low' WHEN o_totalprice < 4e5 THEN 'mid' ELSE 'high' END AS band, "
        "CAST(mod(o_orderkey, 7) AS BIGINT) AS seventh, CAST(round(sqrt(o_totalprice)) AS BIGINT) AS root FROM {orders}",
        ("orders",),
    ),
}

ASOF = (
    "SELECT o_orderkey, asof_day FROM (SELECT o_orderkey, side, max(day) OVER (PARTITION BY k ORDER BY t, side) AS asof_day FROM ("
    "SELECT o_custkey AS k, o_orderdate AS t, o_orderkey, CAST(NULL AS DATE) AS day, 1 AS side FROM {orders} WHERE o_orderstatus = 'O' "
    "UNION ALL SELECT o_custkey, o_orderdate, NULL, o_orderdate, 0 FROM {orders} WHERE o_orderstatus = 'F')) WHERE side = 1"
)


#: Columns of the shared queries whose sums run over all rows.
SUMMED: dict[str, tuple[str, ...]] = {"cube": ("o_totalprice",)}


QUERIES: dict[str, Query] = {
    **_scans(),
    **{name: _sql(sql, *names, exact=SUMMED.get(name, ())) for name, (sql, names) in SHARED.items()},
    "asof_join": _sql(ASOF, "orders"),
    "scan_by_sheet_name": _variant("two_sheets", ["nation", "region"], books.two_sheets, sheet_name="Regions"),
    "scan_by_sheet_index": _variant("two_sheets", ["nation", "region"], books.two_sheets, sheet_index=2),
    "scan_threads_1": lambda spark, sf: table(spark, sf, "lineitem", threads=1),
    "scan_threads_8": lambda spark, sf: table(spark, sf, "lineitem", threads=8),
    "scan_skip_rows": _variant("preamble", ["nation"], books.preamble, skip_rows=3),
    "scan_skip_rows_deep": lambda spark, sf: _deep(spark, sf),
    "scan_mixed_row_places_1": _variant("bare_rows", ["orders"], books.bare_rows, threads=1),
    "scan_mixed_row_places_8": _variant("bare_rows", ["orders"], books.bare_rows, threads=8),
    "scan_no_header_generic_names": _variant("headerless", ["nation"], books.headerless),
    "scan_all_string_no_header": _variant("strings_only", ["part"], books.strings_only),
    "scan_all_string_has_header": _variant("strings_only", ["part"], books.strings_only, has_header="true"),
    "scan_types_subset_coerce": lambda spark, sf: table(spark, sf, "orders", types="VARCHAR,DOUBLE,VARCHAR,VARCHAR,VARCHAR,VARCHAR", coerce_to_string="true"),
    "scan_coerce_bool": _variant("flags", ["labels"], books.flags, types='["VARCHAR","VARCHAR","BOOLEAN"]', coerce_to_string="true"),
    "scan_force_types_nulls": lambda spark, sf: table(spark, sf, "nation", types="VARCHAR,VARCHAR,DATE", force_types="true"),
    "scan_coerce_inferred_only": lambda spark, sf: table(spark, sf, "nation", coerce_to_string="true"),
    "scan_extra_types": lambda spark, sf: table(spark, sf, "nation", types="double,text,float8,date,string"),
    "scan_mixed_column_nulls": _variant("mixed_cells", ["customer"], books.mixed),
    "scan_sparse_cells": _variant("sparse", ["customer"], books.sparse),
    "scan_row_gaps": _variant("gaps", ["nation"], books.gaps),
    "scan_bool_column": _variant("flags", ["labels"], books.flags),
    "scan_pre1970_date": _variant("old_dates", [], books.old_dates),
    "scan_inline_strings": _variant("inline", ["nation"], books.inline, inline_strings="read"),
    "scan_given_schema": lambda spark, sf: _given_schema(spark, sf),
    "udtf_scan_nation": _udtf,
    "view_using": _view,
    "ctas_roundtrip": _ctas,
    "count_star": lambda spark, sf: table(spark, sf, "lineitem", columns="l_linenumber").agg(F.count("*").alias("n")),
    "scan_columns": lambda spark, sf: table(spark, sf, "orders", columns="o_orderdate,O_ORDERKEY"),
    "filters_of_every_kind": _sql(
        "SELECT * FROM {orders} WHERE o_orderpriority LIKE '1%' AND o_orderstatus IN ('F', 'O', 'P') AND o_totalprice >= 1000.0D AND o_orderkey IS NOT NULL "
        "AND (o_custkey < 700 OR o_custkey <> 900) AND o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND contains(o_orderpriority, 'URG')",
        "orders",
    ),
    "filter_project": lambda spark, sf: spark.sql(
        "SELECT l_orderkey, l_quantity * 2 AS double_quantity FROM {lineitem} WHERE l_quantity < 5 AND l_returnflag = 'R' AND l_shipdate >= DATE '1998-01-01'",
        lineitem=table(spark, sf, "lineitem", columns="l_orderkey,l_quantity,l_returnflag,l_shipdate"),
    ),
    "limit_sorted": _sql("SELECT o_orderkey, o_orderdate FROM {orders} ORDER BY o_orderkey DESC LIMIT 25", "orders"),
    "topk": _sql("SELECT c_custkey, c_acctbal FROM {customer} ORDER BY c_acctbal DESC, c_custkey LIMIT 10", "customer"),
    "q1_pricing_summary": _sql(
        "SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS sum_qty, CAST(round(sum(l_extendedprice) * 100) AS BIGINT) AS sum_price_cents, "
        "CAST(round(sum(l_discount) * 100) AS BIGINT) AS sum_disc_percent, count(*) AS n FROM {lineitem} WHERE l_shipdate <= DATE '2001-06-30' GROUP BY l_returnflag, l_linestatus",
        "lineitem",
        exact=("l_quantity", "l_extendedprice", "l_discount"),
        columns="l_quantity,l_extendedprice,l_discount,l_returnflag,l_linestatus,l_shipdate",
    ),
    "join_orders_customer": _sql(
        "SELECT c_mktsegment, count(*) AS n, CAST(round(sum(o_totalprice) * 100) AS BIGINT) AS total_cents FROM {orders} JOIN {customer} ON o_custkey = c_custkey GROUP BY c_mktsegment", "orders", "customer", exact=("o_totalprice",)
    ),
    "left_join_count": _sql("SELECT c_custkey, count(o_orderkey) AS n FROM {customer} LEFT JOIN {orders} ON o_custkey = c_custkey GROUP BY c_custkey", "orders", "customer"),
    "semi_join": _sql("SELECT c_custkey, c_name FROM {customer} LEFT SEMI JOIN {orders} ON o_custkey = c_custkey AND o_totalprice > 200000", "orders", "customer"),
    "anti_join": _sql("SELECT c_custkey, c_name FROM {customer} LEFT ANTI JOIN {orders} ON o_custkey = c_custkey AND o_totalprice > 400000 AND o_orderpriority = '1-URGENT'", "orders", "customer"),
    "rollup_segment": _sql("SELECT c_mktsegment, c_nationkey, count(*) AS n FROM {customer} GROUP BY ROLLUP (c_mktsegment, c_nationkey)", "customer"),
    "distinct_agg": _sql("SELECT l_returnflag, count(DISTINCT l_suppkey) AS n_suppliers, min(l_shipdate) AS first_day, max(l_shipdate) AS last_day FROM {lineitem} GROUP BY l_returnflag", "lineitem", columns="l_returnflag,l_suppkey,l_shipdate"),
    "window_rank": _sql(
        "SELECT s_suppkey, s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS place, "
        "lag(s_suppkey) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS ahead FROM {supplier}",
        "supplier",
    ),
    "union_intersect_except": _sql(
        "(SELECT c_nationkey AS k FROM {customer} UNION SELECT s_nationkey FROM {supplier}) INTERSECT SELECT n_nationkey FROM {nation} EXCEPT SELECT 3.0D", "customer", "supplier", "nation"
    ),
    "subquery_cte": _sql(
        "WITH t AS (SELECT o_custkey, sum(o_totalprice) AS total FROM {orders} GROUP BY o_custkey) SELECT o_custkey, CAST(round(total * 100) AS BIGINT) AS total_cents FROM t WHERE total > 1.5D * (SELECT avg(total) FROM t)", "orders"
    ),
}


def _deep(spark: SparkSession, sf: str) -> DataFrame:
    skipped = spark.read.parquet(f"{sf}/lineitem.parquet").count() + 1
    return scan(spark, book(spark, sf, "deep_preamble", ["lineitem", "nation"], books.deep_preamble), skip_rows=skipped)


def _given_schema(spark: SparkSession, sf: str) -> DataFrame:
    register(spark)
    return spark.read.format("gridscan").schema("key double, title string, area string").load(table_book(spark, sf, "nation"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    return QUERIES["q1_pricing_summary"](spark, sf).withColumn("share", F.col("n") / F.sum("n").over(_whole()))


def _whole():
    from pyspark.sql import Window

    return Window.partitionBy("l_linestatus")
