"""Queries for baskets, frequent itemsets and association rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tableprofile as tp
from checks.query import LINEITEM_COLUMNS, LINEITEM_NULLS_SQL, Query, lineitem_with_nulls, table

FLAGS = ("l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "l_tax")
ORDER_FLAGS = ("o_orderstatus", "o_orderpriority")


def _with_size(itemsets: tp.operators.patterns.Itemsets) -> DataFrame:
    return itemsets.frame.select(F.array_join("items", ", ").alias("items"), "freq")


def _flat_rules(rules: DataFrame) -> DataFrame:
    return rules.select(
        F.array_join("antecedent", ", ").alias("antecedent"),
        F.array_join("consequent", ", ").alias("consequent"),
        *[F.round(c, 6).alias(c) for c in ("confidence", "lift", "support")],
    )


def _itemsets_ctes(source: str, columns: Sequence[str], support: float) -> str:
    """Frequent itemsets by CUBE: an item carries its column, so a row has at
    most one item per column and every itemset is one group of the cube."""
    cells = [f"{c} as c{i}" for i, c in enumerate(columns)]
    items = [
        f"case when g{i} = 0 then '{c}_' || cast(c{i} as varchar) end as i{i}"
        for i, c in enumerate(columns)
    ]
    plain = [f"c{i}" for i in range(len(columns))]
    groupings = [f"grouping(c{i}) as g{i}" for i in range(len(columns))]
    nulls = " and ".join(f"not (g{i} = 0 and c{i} is null)" for i in range(len(columns)))
    used = " + ".join(f"(1 - g{i})" for i in range(len(columns)))
    some = " or ".join(f"{c} is not null" for c in plain)
    return f"""v as materialized (select {", ".join(cells)} from ({source})),
n as materialized (select count(*) as n from v where {some}),
g as materialized (select {", ".join(plain)}, {", ".join(groupings)}, count(*) as freq
      from v group by cube ({", ".join(plain)})),
itemsets as materialized (
  select list_sort(list_filter([{", ".join(f"i{i}" for i in range(len(columns)))}],
                               lambda x: x is not null)) as items, freq
  from (select {", ".join(items)}, freq, {used} as k from g
        where {nulls} and freq >= ceil({support}::double * (select n from n))) where k > 0
)"""


def _itemsets_sql(source: str, columns: Sequence[str], support: float) -> str:
    return f"""with {_itemsets_ctes(source, columns, support)}
select array_to_string(items, ', ') as items, freq from itemsets"""


def _rules_ctes(source: str, columns: Sequence[str], support: float, confidence: float) -> str:
    return f"""{_itemsets_ctes(source, columns, support)},
named as materialized (select array_to_string(items, ', ') as name, freq from itemsets),
parts as materialized (
  select list_filter(items, lambda x: x <> c) as antecedent, c as consequent, freq,
         array_to_string(list_filter(items, lambda x: x <> c), ', ') as name
  from (select items, freq, unnest(items) as c from itemsets where len(items) > 1)
), rules as materialized (
  select p.antecedent, p.consequent, p.freq * 1e0 / a.freq as confidence,
         (p.freq * 1e0 / a.freq) / (c.freq * 1e0 / (select n from n)) as lift,
         p.freq * 1e0 / (select n from n) as support
  from parts p join named a on a.name = p.name join named c on c.name = p.consequent
  where p.freq * 1e0 / a.freq >= {confidence}::double
)"""


def _rules_sql(source: str, columns: Sequence[str], support: float, confidence: float) -> str:
    return f"""with {_rules_ctes(source, columns, support, confidence)}
select array_to_string(antecedent, ', ') as antecedent, consequent,
       round(confidence, 6) as confidence, round(lift, 6) as lift, round(support, 6) as support
from rules"""


def _baskets(spark: SparkSession, folder: str) -> DataFrame:
    """Baskets of three columns with NULLs, by content."""
    columns = ["l_returnflag", "l_linenumber", "l_tax"]
    found = tp.baskets(lineitem_with_nulls(spark, folder), columns)
    joined = F.array_join("items", ", ").alias("items")
    return found.select(joined).groupBy("items").agg(F.count(F.lit(1)).alias("n"))


def _job_rows(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = table(spark, folder, "lineitem")
    return tp.run_model(
        lineitem, "fpgrowth", columns=FLAGS, min_support=0.1, min_confidence=0.2
    )


def _colliding(spark: SparkSession, folder: str) -> DataFrame:
    """Columns o and o_b, some of whose values spell the same item."""
    turn = F.col("o_orderkey") % 5
    return table(spark, folder, "orders").select(
        F.when(turn < 2, "b_x").when(turn == 2, "c").alias("o"),
        F.when((turn == 1) | (turn == 3), "x").when(turn == 4, "y").alias("o_b"),
    )


COLLIDING_SQL = """with v as materialized (
  select case when o_orderkey % 5 < 2 then 'o_b_x' when o_orderkey % 5 = 2 then 'o_c' end as a,
         case when o_orderkey % 5 in (1, 3) then 'o_b_x'
              when o_orderkey % 5 = 4 then 'o_b_y' end as b
  from orders
), items as materialized (
  select list_distinct(list_filter([a, b], lambda x: x is not null)) as items from v
), singles as (
  select unnest(items) as name, 1 as k from items
), pairs as (
  select array_to_string(list_sort(items), ', ') as name, 2 as k from items where len(items) = 2
)
select name as items, count(*) as freq from (select * from singles union all select * from pairs)
group by name having count(*) >= ceil(0.1::double * (select count(*) from orders))"""


def _trimmed(spark: SparkSession, folder: str) -> DataFrame:
    """Top rules with at most one item of each side in the text."""
    rules = tp.association_rules(tp.frequent_itemsets(table(spark, folder, "lineitem"), FLAGS, 0.02), 0.1)
    return tp.top_rules(rules, max_items=1)


LINEITEM = "select * from lineitem"
NULL_FLAGS = ("l_returnflag", "l_linenumber", "l_discount", "l_tax")

QUERIES = {
    "baskets_nulls": Query(
        _baskets,
        f"""select items, count(*) as n from (
  select concat_ws(', ', 'l_returnflag_' || l_returnflag,
                   'l_linenumber_' || cast(l_linenumber as varchar),
                   'l_tax_' || cast(l_tax as varchar)) as items
  from ({LINEITEM_NULLS_SQL})) where items <> '' group by items""",
    ),
    "frequent_itemsets_lineitem": Query(
        lambda s, d: _with_size(tp.frequent_itemsets(table(s, d, "lineitem"), FLAGS, 0.02)),
        _itemsets_sql(LINEITEM, FLAGS, 0.02),
    ),
    "frequent_itemsets_rare_support": Query(
        lambda s, d: _with_size(
            tp.frequent_itemsets(table(s, d, "orders"), ("o_custkey", *ORDER_FLAGS), 0.0005)
        ),
        _itemsets_sql("select * from orders", ("o_custkey", *ORDER_FLAGS), 0.0005),
    ),
    "frequent_itemsets_nulls": Query(
        lambda s, d: _with_size(
            tp.frequent_itemsets(lineitem_with_nulls(s, d), NULL_FLAGS, 0.05)
        ),
        _itemsets_sql(LINEITEM_NULLS_SQL, NULL_FLAGS, 0.05),
    ),
    "frequent_itemsets_fpgrowth": Query(
        lambda s, d: _with_size(
            tp.frequent_itemsets(lineitem_with_nulls(s, d), NULL_FLAGS, 0.01)
        ),
        _itemsets_sql(LINEITEM_NULLS_SQL, NULL_FLAGS, 0.01),
    ),
    "frequent_itemsets_first_columns": Query(
        lambda s, d: _with_size(
            tp.frequent_itemsets(table(s, d, "lineitem"), min_support=0.01, max_cols=5)
        ),
        _itemsets_sql(LINEITEM, LINEITEM_COLUMNS[:5], 0.01),
    ),
    "frequent_itemsets_colliding": Query(
        lambda s, d: _with_size(tp.frequent_itemsets(_colliding(s, d), min_support=0.1)),
        COLLIDING_SQL,
    ),
    "top_itemsets": Query(
        lambda s, d: tp.top_itemsets(tp.frequent_itemsets(table(s, d, "lineitem"), FLAGS, 0.02)),
        f"""with {_itemsets_ctes(LINEITEM, FLAGS, 0.02)}
select array_to_string(items, ', ') as items, freq from itemsets
order by freq desc, len(items), items limit 10""",
    ),
    "association_rules_lineitem": Query(
        lambda s, d: _flat_rules(
            tp.association_rules(tp.frequent_itemsets(table(s, d, "lineitem"), FLAGS, 0.02), 0.1)
        ),
        _rules_sql(LINEITEM, FLAGS, 0.02, 0.1),
    ),
    "association_rules_nulls": Query(
        lambda s, d: _flat_rules(
            tp.association_rules(
                tp.frequent_itemsets(lineitem_with_nulls(s, d), NULL_FLAGS, 0.01), 0.05
            )
        ),
        _rules_sql(LINEITEM_NULLS_SQL, NULL_FLAGS, 0.01, 0.05),
    ),
    "top_rules_trimmed": Query(
        _trimmed,
        f"""with {_rules_ctes(LINEITEM, FLAGS, 0.02, 0.1)}
select antecedent[1] as antecedent, consequent, round(confidence, 4) as confidence
from (select * from rules order by rules.confidence desc, antecedent, consequent limit 10)""",
    ),
    "top_rules": Query(
        lambda s, d: tp.top_rules(
            tp.association_rules(tp.frequent_itemsets(table(s, d, "lineitem"), FLAGS, 0.02), 0.1)
        ),
        f"""with {_rules_ctes(LINEITEM, FLAGS, 0.02, 0.1)}
select array_to_string(antecedent, ', ') as antecedent, consequent,
       round(confidence, 4) as confidence
from (select * from rules order by rules.confidence desc, antecedent, consequent limit 10)""",
    ),
    "fpgrowth_job": Query(
        _job_rows,
        f"""with {_rules_ctes(LINEITEM, FLAGS, 0.1, 0.2)}
select 'fpgrowth' as section, cast(null as varchar) as subject, 'min_support' as metric,
       0.1e0 as num_value, cast(null as varchar) as str_value
union all select 'fpgrowth', null, 'model', null, 'FP-Growth (Frequent Pattern Mining)'
union all select 'fpgrowth', null, 'min_confidence', 0.2e0, null
union all select 'fpgrowth', null, 'transactions', cast(n as double), null from n
union all select 'fpgrowth', null, 'frequent_itemsets', cast(count(*) as double), null
          from itemsets
union all select 'fpgrowth', array_to_string(items, ', '), 'frequency', cast(freq as double), null
          from (select * from itemsets order by freq desc, len(items), items limit 10)
union all select 'fpgrowth', array_to_string(antecedent, ', '), 'confidence',
                 round(confidence, 4), consequent
          from (select * from rules order by rules.confidence desc, antecedent, consequent
                limit 10)""",
    ),
}
