"""Queries for whole profiles and analyses in tidy form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tableprofile as tp
from checks.describing import ORDERS_COLUMNS
from checks.query import Query, percent_sql, rounded_doubles, table, union_sql

ORDERS_TYPES = ("bigint", "bigint", "string", "double", "timestamp_ntz", "string")
ORDERS_NUMERIC = ("o_orderkey", "o_custkey", "o_totalprice")


def _cell(section: str, subject: str | None, metric: str, value: str, text: bool = False) -> str:
    name = f"'{subject}'" if subject else "cast(null as varchar)"
    number = "cast(null as double)" if text else f"round(cast({value} as double), 6)"
    string = value if text else "cast(null as varchar)"
    return (
        f"select '{section}' as section, {name} as subject, '{metric}' as metric,"
        f" {number} as num_value, {string} as str_value from orders"
    )


def _profile_sql() -> str:
    size = "count(*) * 32 + sum(strlen(o_orderstatus)) + sum(strlen(o_orderpriority))"
    cells = [
        _cell("basic_info", None, "num_rows", "count(*)"),
        _cell("basic_info", None, "num_columns", "any_value(6)"),
        _cell("basic_info", None, "numeric_columns", "any_value(3)"),
        _cell("basic_info", None, "other_columns", "any_value(3)"),
        _cell("basic_info", None, "size_bytes", size),
        _cell("basic_info", None, "size_mb", f"round(({size}) / 1048576e0, 2)"),
    ]
    for c, kind in zip(ORDERS_COLUMNS, ORDERS_TYPES):
        cells.append(_cell("basic_info", c, "data_type", f"any_value('{kind}')", text=True))
        missing = f"count(*) - count({c})"
        cells.append(_cell("missing_values", c, "missing_count", missing))
        cells.append(_cell("missing_values", c, "missing_pct", percent_sql(missing, "count(*)")))
        unique = f"count(distinct {c}) + max(case when {c} is null then 1 else 0 end)"
        cells.append(_cell("unique_values", c, "unique_count", unique))
        cells.append(_cell("unique_values", c, "unique_pct", percent_sql(unique, "count(*)")))
    missing = " + ".join(f"count(*) - count({c})" for c in ORDERS_COLUMNS)
    cells.append(_cell("missing_values", None, "total_missing", missing))
    cells.append(_cell("missing_values", None, "total_cells", "count(*) * 6"))
    cells.append(
        _cell("missing_values", None, "overall_missing_pct", percent_sql(missing, "count(*) * 6"))
    )
    for c in ORDERS_NUMERIC:
        for metric, function in (
            ("min", "min"),
            ("max", "max"),
            ("mean", "avg"),
            ("stddev", "stddev_samp"),
        ):
            cells.append(_cell("summary_stats", c, metric, f"{function}({c})"))
    return union_sql(cells)


def _counts_sql() -> str:
    return """select 'value_counts' as section, 'o_orderstatus' as subject, 'count' as metric,
       cast(count(*) as double) as num_value, o_orderstatus as str_value
from orders group by o_orderstatus"""


def _correlation_sql() -> str:
    pairs = [
        ("o_orderkey", "o_custkey"),
        ("o_orderkey", "o_totalprice"),
        ("o_custkey", "o_totalprice"),
    ]
    return union_sql(
        [_cell("correlation", f"{a} vs {b}", "correlation", f"round(corr({a}, {b}), 4)") for a, b in pairs]
    )


def _profile(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_doubles(tp.profile(table(spark, folder, "orders")))


def _profile_all(spark: SparkSession, folder: str) -> DataFrame:
    found = tp.profile(
        table(spark, folder, "orders"), tp.STATISTICS, value_count_columns=["o_orderstatus"]
    )
    return rounded_doubles(found)


def _analysis(spark: SparkSession, folder: str) -> DataFrame:
    """A table too narrow for two of the jobs: they report an error, the rest runs."""
    pages = table(spark, folder, "pages")
    return tp.analyze(
        pages,
        ["basic_info", "histogram", "value_counts"],
        ["linear_regression", "decision_tree"],
    )


def _analysis_unknown_column(spark: SparkSession, folder: str) -> DataFrame:
    """A statistic that cannot run gives an error row, the others go on."""
    found = tp.analyze(
        table(spark, folder, "region"), ["missing_values", "value_counts"], [],
        stat_params={"value_count_columns": ["absent"]},
    )
    return found.filter("metric in ('missing_count', 'error')")


ANALYSIS_SQL = """
select 'basic_info' as section, cast(null as varchar) as subject, 'num_rows' as metric,
       cast(count(*) as double) as num_value, cast(null as varchar) as str_value from pages
union all select 'basic_info', null, 'num_columns', 3, null
union all select 'basic_info', null, 'numeric_columns', 1, null
union all select 'basic_info', null, 'other_columns', 2, null
union all select 'basic_info', null, 'size_bytes',
                 count(*) * 8 + sum(strlen(url)) + sum(strlen(html)), null from pages
union all select 'basic_info', null, 'size_mb',
                 round((count(*) * 8 + sum(strlen(url)) + sum(strlen(html))) / 1048576e0, 2), null
          from pages
union all select 'basic_info', 'html', 'data_type', null, 'string'
union all select 'value_counts', null, 'message', null, 'No columns named for value counts'
union all select 'basic_info', 'page_id', 'data_type', null, 'bigint'
union all select 'basic_info', 'url', 'data_type', null, 'string'
union all select 'histogram', null, 'error', null, 'Unknown statistics type: histogram'
union all select 'linear_regression', null, 'error', null,
                 'Need at least 2 numeric columns for regression'
union all select 'decision_tree', null, 'error', null,
                 'Need at least 2 numeric columns for classification'"""

QUERIES = {
    "profile_orders": Query(_profile, _profile_sql()),
    "profile_orders_all_statistics": Query(
        _profile_all, union_sql([_profile_sql(), _correlation_sql(), _counts_sql()])
    ),
    "profile_lineitem_approx": Query(
        lambda s, d: tp.profile(table(s, d, "lineitem"), approx_unique=True)
    ),
    "analyze_narrow_table": Query(_analysis, ANALYSIS_SQL),
    "analyze_unknown_column": Query(
        _analysis_unknown_column,
        """select 'missing_values' as section, unnest(['r_regionkey', 'r_name']) as subject,
       'missing_count' as metric, 0e0 as num_value, cast(null as varchar) as str_value
union all select 'value_counts', null, 'error', null, 'Unknown columns: absent'""",
    ),
    "analyze_customer": Query(lambda s, d: tp.analyze(table(s, d, "customer"))),
}
