"""Queries for the descriptive statistics."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tableprofile as tp
from checks.query import (
    LINEITEM_COLUMNS,
    LINEITEM_NULLS_SQL,
    Query,
    lineitem_with_nulls,
    percent_sql,
    rounded_doubles,
    table,
    union_sql,
)
from tableprofile.functions.checkpoints import scratch_path
from tableprofile.operators.sketches import DISTINCT_ERROR, RANK_ERROR

LINEITEM_NUMERIC = LINEITEM_COLUMNS[:8]
ORDERS_COLUMNS = (
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderdate",
    "o_orderpriority",
)
EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


# Basic facts


def _basic(spark: SparkSession, folder: str, name: str) -> DataFrame:
    info = tp.basic_info(table(spark, folder, name))
    types = F.transform("column_names", lambda c: F.element_at("data_types", c))
    return info.select(
        F.col("num_rows"),
        F.col("num_columns"),
        F.col("numeric_columns"),
        F.col("other_columns"),
        F.col("size_bytes"),
        F.col("size_mb"),
        F.array_join("column_names", ",").alias("column_names"),
        F.array_join(types, ",").alias("data_types"),
    )


def _basic_sql(name: str, columns: list[tuple[str, str]], numeric: int, size: str) -> str:
    return f"""
select count(*) as num_rows,
       {len(columns)} as num_columns,
       {numeric} as numeric_columns,
       {len(columns) - numeric} as other_columns,
       cast({size} as bigint) as size_bytes,
       round(cast({size} as double) / 1048576e0, 2) as size_mb,
       '{",".join(c for c, _ in columns)}' as column_names,
       '{",".join(t for _, t in columns)}' as data_types
from {name}"""


BASIC = {
    "basic_info_lineitem": Query(
        lambda s, d: _basic(s, d, "lineitem"),
        _basic_sql(
            "lineitem",
            list(
                zip(
                    LINEITEM_COLUMNS,
                    ["bigint"] * 3 + ["int"] + ["double"] * 4 + ["string"] * 2 + ["timestamp_ntz"],
                )
            ),
            8,
            "count(*) * 68 + sum(strlen(l_returnflag)) + sum(strlen(l_linestatus))",
        ),
    ),
    "basic_info_documents": Query(
        lambda s, d: _basic(s, d, "documents"),
        _basic_sql(
            "documents",
            [
                ("doc_id", "bigint"),
                ("text", "string"),
                ("lang", "string"),
                ("source", "string"),
                ("n_chars", "bigint"),
            ],
            2,
            "count(*) * 16 + sum(strlen(text)) + sum(strlen(lang)) + sum(strlen(source))",
        ),
    ),
    "basic_info_embeddings": Query(
        lambda s, d: _basic(s, d, "embeddings"),
        _basic_sql(
            "embeddings",
            [("vec_id", "bigint"), ("embedding", "array<float>"), ("label", "int")],
            2,
            "count(*) * 12 + sum(4 * len(embedding))",
        ),
    ),
}


# Summary

# Fifteen numeric columns, some with NULLs.
WIDE_COLUMNS = tuple(f"w{i}" for i in range(15))
_WIDE = [
    f"nullif((l_orderkey * {i + 3} + l_partkey) % {17 + i} + 0e0, {float(i)})" if i % 2 else
    f"(l_quantity + {i}) * (l_suppkey % {i + 2}) + 0e0"
    for i in range(15)
]
WIDE_SQL = "select {} from lineitem".format(
    ", ".join(f"{e} as {c}" for e, c in zip(_WIDE, WIDE_COLUMNS))
)


def _wide(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(
        *[f"{e} as {c}" for e, c in zip(_WIDE, WIDE_COLUMNS)]
    )


def _summary_sql(source: str, columns: tuple[str, ...]) -> str:
    return union_sql(
        [
            f"""select '{c}' as "column", cast(min({c}) as double) as min,
       cast(max({c}) as double) as max, round(avg({c}), 6) as mean,
       round(stddev_samp({c}), 6) as stddev from ({source})"""
            for c in columns
        ]
    )


SUMMARY = {
    "summary_lineitem": Query(
        lambda s, d: rounded_doubles(tp.summary_statistics(table(s, d, "lineitem"))),
        _summary_sql("select * from lineitem", LINEITEM_NUMERIC),
    ),
    "summary_lineitem_nulls": Query(
        lambda s, d: rounded_doubles(tp.summary_statistics(lineitem_with_nulls(s, d))),
        _summary_sql(LINEITEM_NULLS_SQL, LINEITEM_NUMERIC),
    ),
    "summary_orders": Query(
        lambda s, d: rounded_doubles(tp.summary_statistics(table(s, d, "orders"))),
        _summary_sql("select * from orders", ("o_orderkey", "o_custkey", "o_totalprice")),
    ),
    "summary_customer_first_two": Query(
        lambda s, d: rounded_doubles(tp.summary_statistics(table(s, d, "customer"), max_cols=2)),
        _summary_sql("select * from customer", ("c_custkey", "c_nationkey")),
    ),
    "summary_wide": Query(
        lambda s, d: rounded_doubles(tp.summary_statistics(_wide(s, d))),
        _summary_sql(WIDE_SQL, WIDE_COLUMNS),
    ),
    "summary_no_numeric": Query(
        lambda s, d: tp.profile(table(s, d, "documents").select("text", "lang"), ["summary_stats"]),
        """select 'summary_stats' as section, cast(null as varchar) as subject,
       'message' as metric, cast(null as double) as num_value,
       'No numeric columns found in dataset' as str_value""",
    ),
}


# Missing values


def _missing_sql(source: str, columns: tuple[str, ...]) -> str:
    return union_sql(
        [
            f"""select '{c}' as "column", count(*) - count({c}) as missing_count,
       {percent_sql(f"count(*) - count({c})", "count(*)")} as missing_pct from ({source})"""
            for c in columns
        ]
    )


def _missing_overall_sql(source: str, columns: tuple[str, ...]) -> str:
    missing = " + ".join(f"count(*) - count({c})" for c in columns)
    cells = f"count(*) * {len(columns)}"
    return f"""select {missing} as total_missing, {cells} as total_cells,
       {percent_sql(missing, cells)} as overall_missing_pct from ({source})"""


MISSING = {
    "missing_lineitem_nulls": Query(
        lambda s, d: tp.missing_values(lineitem_with_nulls(s, d)),
        _missing_sql(LINEITEM_NULLS_SQL, LINEITEM_COLUMNS),
    ),
    "missing_orders": Query(
        lambda s, d: tp.missing_values(table(s, d, "orders")),
        _missing_sql("select * from orders", ORDERS_COLUMNS),
    ),
    "missing_overall_lineitem_nulls": Query(
        lambda s, d: tp.missing_overall(lineitem_with_nulls(s, d)),
        _missing_overall_sql(LINEITEM_NULLS_SQL, LINEITEM_COLUMNS),
    ),
}


# Unique values


def _unique_sql(source: str, columns: tuple[str, ...]) -> str:
    return union_sql(
        [
            f"""select '{c}' as "column", count(*) as unique_count,
       {percent_sql("count(*)", "sum(copies)::bigint")} as unique_pct
from (select {c}, count(*) as copies from ({source}) group by {c})"""
            for c in columns
        ]
    )


def _approx_unique_close(spark: SparkSession, folder: str) -> DataFrame:
    """Whether approximate distinct counts are within four deviations of the exact ones."""
    df = table(spark, folder, "lineitem")
    exact = tp.unique_values(df).select("column", F.col("unique_count").alias("exact"))
    near = F.abs(F.col("unique_count") - F.col("exact")) <= 0.2 * F.col("exact") + 1
    return tp.unique_values(df, approx=True).join(exact, "column").select(
        "column", near.alias("within"), F.col("exact").alias("unique_count")
    )


STRUCT_SQL = """select 'n a' as "column", count(*) as unique_count,
       round(count(*) * 100e0 / (select count(*) from part), 2) as unique_pct
from (select distinct p_brand, p_size from part)"""

UNIQUE = {
    "unique_lineitem": Query(
        lambda s, d: tp.unique_values(table(s, d, "lineitem")),
        _unique_sql("select * from lineitem", LINEITEM_COLUMNS),
    ),
    "unique_lineitem_nulls": Query(
        lambda s, d: tp.unique_values(lineitem_with_nulls(s, d)),
        _unique_sql(LINEITEM_NULLS_SQL, LINEITEM_COLUMNS),
    ),
    "unique_events": Query(
        lambda s, d: tp.unique_values(table(s, d, "events")),
        _unique_sql("select * from events", EVENT_COLUMNS),
    ),
    "unique_documents": Query(
        lambda s, d: tp.unique_values(table(s, d, "documents")),
        _unique_sql(
            "select * from documents", ("doc_id", "text", "lang", "source", "n_chars")
        ),
    ),
    "unique_embeddings": Query(
        lambda s, d: tp.unique_values(table(s, d, "embeddings")),
        _unique_sql("select * from embeddings", ("vec_id", "embedding", "label")),
    ),
    "unique_struct": Query(
        lambda s, d: tp.unique_values(
            table(s, d, "part").select(
                F.struct(F.col("p_brand").alias("a b"), F.col("p_size").alias("c`d")).alias("n a")
            )
        ),
        STRUCT_SQL,
    ),
    "unique_approx_close": Query(
        _approx_unique_close,
        "select \"column\", true as within, unique_count from ({})".format(
            _unique_sql("select * from lineitem", LINEITEM_COLUMNS)
        ),
    ),
    "unique_approx_lineitem": Query(
        lambda s, d: tp.unique_values(table(s, d, "lineitem"), approx=True)
    ),
}


# Correlation


def _correlation_sql(source: str, columns: tuple[str, ...]) -> str:
    return union_sql(
        [
            f"""select '{a} vs {b}' as pair, round(corr({a}, {b}), 4) as correlation
from ({source})"""
            for a, b in combinations(columns, 2)
        ]
    )


def _zero_filled_sql(columns: tuple[str, ...]) -> str:
    filled = ", ".join(f"coalesce({c}, 0) as {c}" for c in columns)
    return f"select {filled} from ({LINEITEM_NULLS_SQL})"


NULLABLE = ("l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")

CORRELATION = {
    "correlation_lineitem": Query(
        lambda s, d: tp.correlation(table(s, d, "lineitem"), max_cols=5),
        _correlation_sql("select * from lineitem", LINEITEM_NUMERIC[:5]),
    ),
    "correlation_lineitem_all_columns": Query(
        lambda s, d: tp.correlation(table(s, d, "lineitem")),
        _correlation_sql("select * from lineitem", LINEITEM_NUMERIC),
    ),
    "correlation_wide": Query(
        lambda s, d: tp.correlation(_wide(s, d)),
        _correlation_sql(WIDE_SQL, WIDE_COLUMNS),
    ),
    "correlation_empty_wide": Query(
        lambda s, d: tp.correlation(_wide(s, d).filter("w0 < 0")),
        _correlation_sql(f"select * from ({WIDE_SQL}) where w0 < 0", WIDE_COLUMNS),
    ),
    "correlation_pairwise_nulls": Query(
        lambda s, d: tp.correlation(lineitem_with_nulls(s, d), columns=NULLABLE),
        _correlation_sql(LINEITEM_NULLS_SQL, NULLABLE),
    ),
    "correlation_zero_filled_nulls": Query(
        lambda s, d: tp.correlation(lineitem_with_nulls(s, d), columns=NULLABLE, nulls="zero"),
        _correlation_sql(_zero_filled_sql(NULLABLE), NULLABLE),
    ),
    "correlation_part": Query(
        lambda s, d: tp.correlation(table(s, d, "part")),
        _correlation_sql("select * from part", ("p_partkey", "p_size", "p_retailprice")),
    ),
    "correlation_one_column": Query(
        lambda s, d: tp.profile(table(s, d, "pages"), ["correlation"]),
        """select 'correlation' as section, cast(null as varchar) as subject,
       'message' as metric, cast(null as double) as num_value,
       'Need at least 2 numeric columns for correlation' as str_value""",
    ),
}


# Value counts and medians


def _counts_sql(source: str, column: str, limit: str = "limit 10") -> str:
    return f"""select {column} as value, count(*) as count from ({source})
group by {column} order by count desc, value asc nulls first {limit}"""


def _median(spark: SparkSession, folder: str, name: str, column: str) -> DataFrame:
    value = tp.exact_median(table(spark, folder, name), column)
    return spark.createDataFrame([(column, float(value))], "column string, median double")


def _large_median(spark: SparkSession, folder: str) -> DataFrame:
    """Whole numbers beyond what a double holds."""
    large = table(spark, folder, "orders").select(
        (F.lit(9007199254740993) + F.col("o_orderkey") % 7).alias("v")
    )
    return spark.createDataFrame([(tp.exact_median(large, "v"),)], "median long")


def _approx_median_close(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the rank of the approximate median is within its error of the middle."""
    df = table(spark, folder, "lineitem")
    value = tp.approx_median(df, "l_extendedprice")
    below, upto, rows = (
        F.count_if(F.col("l_extendedprice") < value), F.count_if(F.col("l_extendedprice") <= value),
        F.count(F.lit(1)),
    )
    return df.agg(
        ((below <= rows * 0.511) & (upto >= rows * 0.489)).alias("within"), rows.alias("rows")
    )



def _approx_median(spark: SparkSession, folder: str, name: str, column: str) -> DataFrame:
    value = tp.approx_median(table(spark, folder, name), column)
    return spark.createDataFrame([(column, value)], "column string, median double")


def _median_sql(name: str, column: str) -> str:
    return f"""select '{column}' as "column",
       cast(quantile_disc({column}, 0.5) as double) as median from {name}"""


VALUES = {
    "value_counts_orderpriority": Query(
        lambda s, d: tp.value_counts(table(s, d, "orders"), "o_orderpriority"),
        _counts_sql("select * from orders", "o_orderpriority"),
    ),
    "value_counts_custkey_ties": Query(
        lambda s, d: tp.value_counts(table(s, d, "orders"), "o_custkey"),
        _counts_sql("select * from orders", "o_custkey"),
    ),
    "value_counts_returnflag_nulls": Query(
        lambda s, d: tp.value_counts(lineitem_with_nulls(s, d), "l_returnflag"),
        _counts_sql(LINEITEM_NULLS_SQL, "l_returnflag"),
    ),
    "value_counts_event_type_top_3": Query(
        lambda s, d: tp.value_counts(table(s, d, "events"), "event_type", top_n=3),
        _counts_sql("select * from events", "event_type", "limit 3"),
    ),
    "value_counts_conversation_role": Query(
        lambda s, d: tp.value_counts(table(s, d, "conversations"), "role", top_n=None),
        _counts_sql("select * from conversations", "role", ""),
    ),
    "median_extendedprice": Query(
        lambda s, d: _median(s, d, "lineitem", "l_extendedprice"),
        _median_sql("lineitem", "l_extendedprice"),
    ),
    "median_linenumber": Query(
        lambda s, d: _median(s, d, "lineitem", "l_linenumber"),
        _median_sql("lineitem", "l_linenumber"),
    ),
    "median_event_value": Query(
        lambda s, d: _median(s, d, "events", "value"), _median_sql("events", "value")
    ),
    "median_large_numbers": Query(
        _large_median,
        """select quantile_disc(9007199254740993::bigint + o_orderkey % 7, 0.5) as median
from orders""",
    ),
    "median_approx_close": Query(
        _approx_median_close, "select true as within, count(*) as rows from lineitem"
    ),
    "median_approx_extendedprice": Query(
        lambda s, d: _approx_median(s, d, "lineitem", "l_extendedprice")
    ),
}

def _top_values_sql(source: str, columns: Sequence[str], top_n: int = 10) -> str:
    return union_sql([
        f"""select * from (select '{c}' as "column", cast(row_number() over (
  order by n desc, v nulls first) as integer) as rank, cast(v as varchar) as value, n as count
  from (select {c} as v, count(*) as n from ({source}) group by 1)) where rank <= {top_n}"""
        for c in columns
    ])


def _month_states(spark: SparkSession, folder: str) -> DataFrame:
    df = lineitem_with_nulls(spark, folder)
    return tp.sketch_states(df.withColumn("month", F.trunc("l_shipdate", "month")), ["month"])


def _sketched_unique(spark: SparkSession, folder: str) -> DataFrame:
    """Months merged: rows and missing values exact, distinct values within three errors."""
    df = lineitem_with_nulls(spark, folder)
    merged = tp.merge_states(_month_states(spark, folder))
    exact = tp.unique_values(df).select("column", "unique_count")
    off = F.abs(F.col("unique_estimate") - F.col("unique_count"))
    within = off <= 3 * DISTINCT_ERROR * F.col("unique_count") + 0.5
    return tp.state_estimates(merged).join(exact, "column").select(
        "column", "rows", "missing", within.alias("within"))


def _sketched_median(spark: SparkSession, folder: str) -> DataFrame:
    """Months merged: the rank of the sketched median is within its error of the middle."""
    merged = tp.merge_states(_month_states(spark, folder).where("column = 'l_extendedprice'"))
    value = tp.state_estimates(merged).first()["quantiles"][0]
    price = F.col("l_extendedprice")
    share = lambda c: F.avg(c.cast("double"))
    return table(spark, folder, "lineitem").agg(
        ((share(price < value) <= 0.5 + RANK_ERROR) & (share(price <= value) >= 0.5 - RANK_ERROR))
        .alias("within"),
        F.count(F.lit(1)).alias("rows"))


def _stored_states(spark: SparkSession, folder: str) -> DataFrame:
    """Days of events stored one half after the other, the second half twice, then merged."""
    uri, by = scratch_path(spark, "states"), ["day"]
    df = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    late = F.dayofmonth("day") > 15
    for half in (~late, late, late):
        states = tp.sketch_states(df.where(half), by, ["event_type", "user_id", "value"])
        tp.save_states(states, uri, by)
    merged = tp.merge_states(tp.load_states(spark, uri, "day date"))
    return tp.state_estimates(merged, ranks=()).select(
        "column", "rows", "missing", F.when(F.col("column") == "event_type", F.col("unique_estimate"))
        .alias("types"))


SKETCHES = {
    "top_values_lineitem": Query(
        lambda s, d: tp.top_values(table(s, d, "lineitem")),
        _top_values_sql("select * from lineitem", LINEITEM_COLUMNS),
    ),
    "top_values_lineitem_nulls": Query(
        lambda s, d: tp.top_values(lineitem_with_nulls(s, d), top_n=3, buckets=64),
        _top_values_sql(LINEITEM_NULLS_SQL, LINEITEM_COLUMNS, 3),
    ),
    "top_values_documents": Query(
        lambda s, d: tp.top_values(table(s, d, "documents"), ["text", "lang", "source"]),
        _top_values_sql("select * from documents", ("text", "lang", "source")),
    ),
    "sketched_unique_lineitem": Query(
        _sketched_unique,
        union_sql([
            f"""select '{c}' as "column", count(*) as rows, count(*) - count({c}) as missing,
       true as within from ({LINEITEM_NULLS_SQL})"""
            for c in LINEITEM_COLUMNS
        ]),
    ),
    "sketched_median_lineitem": Query(
        _sketched_median, "select true as within, count(*) as rows from lineitem"
    ),
    "stored_states_events": Query(
        _stored_states,
        union_sql([
            f"""select '{c}' as "column", count(*) as rows, count(*) - count({c}) as missing,
       {"count(distinct event_type)" if c == "event_type" else "cast(null as bigint)"} as types
from events"""
            for c in ("event_type", "user_id", "value")
        ]),
    ),
}

QUERIES = {**BASIC, **SUMMARY, **MISSING, **UNIQUE, **CORRELATION, **VALUES, **SKETCHES}
