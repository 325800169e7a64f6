"""Queries for features, splits, models and their metrics."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from functools import reduce
from operator import and_

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tableprofile as tp
from checks.query import (
    LINEITEM_COLUMNS,
    LINEITEM_NULLS_SQL,
    Query,
    lineitem_with_nulls,
    md5_train_sql,
    rounded_doubles,
    table,
    union_sql,
)
from tableprofile.operators.clustering import cluster_sizes
from tableprofile.operators.features import FEATURES, choose_features, feature_stages
from tableprofile.operators.quantiles import exact_quantiles

# Features


def _filled(spark: SparkSession, folder: str) -> DataFrame:
    filled = tp.fill_missing(lineitem_with_nulls(spark, folder), ["l_tax", "l_linenumber"])
    return filled.groupBy("l_tax", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


def _assembled(spark: SparkSession, folder: str) -> DataFrame:
    """Sum and length of the feature vector of every row."""
    df = lineitem_with_nulls(spark, folder)
    stages = feature_stages(choose_features(df, "l_orderkey"))
    vectors = Pipeline(stages=stages).fit(df).transform(df)
    values = vector_to_array(FEATURES)
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return vectors.select(
        "l_orderkey", F.size(values).alias("dims"), F.round(total, 4).alias("total")
    )


def _binarised(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    threshold = tp.exact_median(orders, "o_totalprice")
    return tp.binarise(orders, "o_totalprice", threshold).select("o_orderkey", "label")


def _label_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Labels with NULLs: only the rows that have a value are left."""
    labelled = tp.binarise(lineitem_with_nulls(spark, folder), "l_tax", 0.04)
    return labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def _content_split(spark: SparkSession, folder: str) -> DataFrame:
    """Copies of a row are on one side, near four fifths train, and partitions do not matter."""
    df = table(spark, folder, "lineitem")
    # Two hashes of 64 bits stand for a row, so that whole rows are not shuffled to be grouped.
    # As in a join by all columns, a row with a NULL equals none.
    whole = reduce(and_, [F.col(c).isNotNull() for c in df.columns])
    hashes = [F.xxhash64(F.lit(i), *df.columns).alias(f"hash{i}") for i in (1, 2)]
    sides = [
        split.filter(whole).select(*hashes, F.when(F.col("is_train"), train).otherwise(test).alias("mark"))
        for split, train, test in (
            (tp.split_by_key(df), 1, 2), (tp.split_by_key(df.repartition(7)), 4, 8))
    ]
    marks = sides[0].unionAll(sides[1]).groupBy("hash1", "hash2").agg(F.bit_or("mark").alias("marks"))
    has = lambda mark: F.col("marks").bitwiseAND(mark) != 0
    least, again = ~has(2), ~has(8)
    share = F.count_if(least) / F.count(F.lit(1))
    return marks.filter((has(1) | has(2)) & (has(4) | has(8))).agg(
        F.count(F.lit(1)).alias("different_rows"),
        F.bool_and(~(has(1) & has(2))).alias("copies_together"),
        F.bool_and(least == again).alias("same_again"),
        F.abs(share - 0.8).between(0, 0.03).alias("near_ratio"),
    )


FEATURE_QUERIES = {
    "fill_missing": Query(
        _filled,
        f"""select coalesce(l_tax, 0) as l_tax, coalesce(l_linenumber, 0) as l_linenumber,
       count(*) as n from ({LINEITEM_NULLS_SQL}) group by 1, 2""",
    ),
    "assembled_features": Query(
        _assembled,
        f"""select l_orderkey, 7 as dims,
       round(cast(l_partkey as double) + l_suppkey + coalesce(l_linenumber, 0) + l_quantity
             + l_extendedprice + coalesce(l_discount, 0) + coalesce(l_tax, 0), 4) as total
from ({LINEITEM_NULLS_SQL})""",
    ),
    "binarise_at_median": Query(
        _binarised,
        """select o_orderkey, case when o_totalprice > m then 1e0 else 0e0 end as label
from orders, (select quantile_disc(o_totalprice, 0.5) as m from orders)""",
    ),
    "binarise_with_nulls": Query(
        _label_counts,
        f"""select case when l_tax > 0.04e0 then 1e0 else 0e0 end as label, count(*) as n
from ({LINEITEM_NULLS_SQL}) where l_tax is not null group by 1""",
    ),
    "split_by_key_orders": Query(
        lambda s, d: tp.split_by_key(table(s, d, "orders"), ["o_orderkey"]).select(
            "o_orderkey", "is_train"
        ),
        f"select o_orderkey, {md5_train_sql('o_orderkey')} as is_train from orders",
    ),
    "split_counts_events": Query(
        lambda s, d: tp.split_by_key(table(s, d, "events"), ["event_id"], 0.7, seed=7)
        .groupBy("is_train")
        .agg(F.count(F.lit(1)).alias("n")),
        f"""select {md5_train_sql("event_id", 7, 700)} as is_train, count(*) as n
from events group by 1""",
    ),
    "split_by_content_stable": Query(
        _content_split,
        """select count(*) as different_rows, true as copies_together, true as same_again,
       true as near_ratio from (select distinct * from lineitem)""",
    ),
    "split_by_content": Query(
        lambda s, d: tp.split_by_key(table(s, d, "lineitem"))
        .groupBy("is_train")
        .agg(F.count(F.lit(1)).alias("n"))
    ),
}


# Regression


def _numbers(facts: DataFrame, metrics: Sequence[str]) -> DataFrame:
    return facts.filter(F.col("metric").isin(*metrics)).select("subject", "metric", "num_value")


COUNTS = ("training_rows", "test_rows", "dropped_rows")
REGRESSION = (*COUNTS, "rmse", "r2", "intercept", "coefficient")


def _elastic_net(spark: SparkSession, folder: str) -> DataFrame:
    """One feature, default penalties, on prices that follow the part key."""
    fit = tp.fit_linear_regression(
        table(spark, folder, "part"),
        "p_retailprice",
        ["p_partkey"],
        key=["p_partkey"],
        digits=None,
    )
    return rounded_doubles(_numbers(fit.facts_frame(), REGRESSION))


def _default_regression(spark: SparkSession, folder: str) -> DataFrame:
    """The default fit: its metrics are those of its own predictions, by the portable split."""
    df = table(spark, folder, "lineitem")
    fit = tp.fit_linear_regression(df, key=["l_orderkey"], digits=None)
    test = tp.split_by_key(fit.predict(), ["l_orderkey"]).filter("not is_train")
    error = F.col("l_orderkey") - F.col("prediction")
    row = test.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), F.count(F.lit(1)).alias("n"),
        (1 - F.avg(error * error) / F.var_pop("l_orderkey")).alias("r2"),
    ).first()
    close = lambda a, b: abs(a - b) <= 1e-6 * (1 + abs(a))
    return spark.createDataFrame(
        [(row["n"], int(fit.fact("training_rows")), close(row["rmse"], fit.fact("rmse")),
          close(row["r2"], fit.fact("r2")))],
        "test_rows long, training_rows long, rmse_matches boolean, r2_matches boolean",
    )


def _default_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The default tree: its accuracy is that of its own predictions, depth and nodes fit."""
    df = table(spark, folder, "lineitem")
    fit = tp.fit_decision_tree(df, key=["l_orderkey"], digits=None)
    test = tp.split_by_key(fit.predict(), ["l_orderkey"]).filter("not is_train")
    actual = F.when(F.col("l_orderkey") > fit.fact("threshold"), 1.0).otherwise(0.0)
    row = test.agg(
        F.avg((actual == F.col("prediction")).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    depth, nodes = fit.fact("depth"), fit.fact("num_nodes")
    return spark.createDataFrame(
        [(float(fit.fact("threshold")), row["n"],
          abs(row["accuracy"] - fit.fact("accuracy")) <= 1e-9,
          depth <= 5 and nodes % 2 == 1 and 2 * depth + 1 <= nodes <= 2 ** (depth + 1) - 1)],
        "threshold double, test_rows long, accuracy_matches boolean, shape_fits boolean",
    )


def _least_squares(spark: SparkSession, folder: str) -> DataFrame:
    """Two features without penalty, split by order."""
    fit = tp.fit_linear_regression(
        table(spark, folder, "lineitem"),
        "l_extendedprice",
        ["l_quantity", "l_discount"],
        key=["l_orderkey"],
        reg_param=0.0,
        digits=None,
    )
    return rounded_doubles(_numbers(fit.facts_frame(), REGRESSION), 3)


def _least_squares_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """NULL labels are dropped and counted, NULL features read as 0."""
    fit = tp.fit_linear_regression(
        lineitem_with_nulls(spark, folder),
        "l_tax",
        ["l_linenumber", "l_discount"],
        key=["l_orderkey"],
        reg_param=0.0,
        digits=None,
    )
    return rounded_doubles(_numbers(fit.facts_frame(), REGRESSION), 5)


def _facts_sql(cells: list[tuple[str | None, str, str]], digits: int, source: str) -> str:
    branches = []
    for subject, metric, value in cells:
        name = f"'{subject}'" if subject else "cast(null as varchar)"
        branches.append(
            f"select {name} as subject, '{metric}' as metric,"
            f" round(cast({value} as double), {digits}) as num_value from {source}"
        )
    return "\nunion all\n".join(branches)


def _metrics_ctes(prediction: str) -> str:
    return f"""scored as (
  select y, {prediction} as yhat from usable, model where not is_train
), metrics as (
  select sqrt(avg((y - yhat) * (y - yhat))) as rmse,
         1 - avg((y - yhat) * (y - yhat)) / var_pop(y) as r2 from scored
), counts as (
  select count(*) filter (where y is not null and is_train) as training_rows,
         count(*) filter (where y is not null and not is_train) as test_rows,
         count(*) filter (where y is null) as dropped_rows from base
), facts as (select * from model, metrics, counts)
"""


def _regression_cells(features: Sequence[str]) -> list[tuple[str | None, str, str]]:
    cells: list[tuple[str | None, str, str]] = [(None, m, m) for m in COUNTS]
    cells += [(None, m, m) for m in ("rmse", "r2", "intercept")]
    return cells + [(f, "coefficient", f"b{i}") for i, f in enumerate(features)]


# Closed form for one standardised feature and penalty lam with mix a. The library
# standardises by population deviations.
ELASTIC_NET_SQL = f"""with base as materialized (
  select p_retailprice as y, cast(p_partkey as double) as x,
         {md5_train_sql("p_partkey")} as is_train from part
), usable as (select * from base where y is not null),
moments as (
  select avg(x) as mx, avg(y) as my, stddev_pop(x) as sx, stddev_pop(y) as sy,
         covar_pop(x, y) as cxy, var_pop(x) as vx from usable where is_train
), standard as (
  select *, 0.3e0 / sy as lam, 0.8e0 as a, cxy / (sx * sy) as rho, vx / (sx * sx) as v from moments
), slope as (
  select *, sign(rho) * greatest(abs(rho) - lam * a, 0) / (v + lam * (1 - a)) * sy / sx as b0
  from standard
), model as (select b0, my - b0 * mx as intercept from slope),
{_metrics_ctes("intercept + b0 * x")}
{_facts_sql(_regression_cells(["p_partkey"]), 6, "facts")}"""


def _least_squares_sql(
    source: str, label: str, features: Sequence[str], key: str, digits: int
) -> str:
    """Two features: solve the 2x2 normal equations from population moments."""
    u, v = features
    return f"""with base as materialized (
  select {label} as y, cast(coalesce({u}, 0) as double) as u,
         cast(coalesce({v}, 0) as double) as v, {md5_train_sql(key)} as is_train from ({source})
), usable as (select * from base where y is not null),
moments as (
  select avg(u) as mu, avg(v) as mv, avg(y) as my, var_pop(u) as uu, var_pop(v) as vv,
         covar_pop(u, v) as uv, covar_pop(u, y) as uy, covar_pop(v, y) as vy
  from usable where is_train
), slopes as (
  select *, (uy * vv - vy * uv) / (uu * vv - uv * uv) as b0,
         (vy * uu - uy * uv) / (uu * vv - uv * uv) as b1 from moments
), model as (select b0, b1, my - b0 * mu - b1 * mv as intercept from slopes),
{_metrics_ctes("intercept + b0 * u + b1 * v")}
{_facts_sql(_regression_cells(features), digits, "facts")}"""


# The default fit of lineitem: the first numeric column by the others.
LINEITEM_NUMERIC = LINEITEM_COLUMNS[:8]
DEFAULT_LABEL, *DEFAULT_FEATURES = LINEITEM_NUMERIC
# Steps of proximal gradient descent; on correlations like these, far more than it takes.
STEPS = 400


def _default_optimum(spark: SparkSession, folder: str) -> DataFrame:
    """The coefficients of the default fit, in standard deviations of label and feature."""
    df = table(spark, folder, "lineitem")
    fit = tp.fit_linear_regression(df, key=["l_orderkey"], digits=None)
    train = tp.split_by_key(df, ["l_orderkey"]).filter("is_train")
    spread = train.agg(*[F.stddev_pop(c).alias(c) for c in LINEITEM_NUMERIC])
    weights = {
        c: F.lit(fit.fact("coefficient", c)) * F.col(c) / F.col(DEFAULT_LABEL) for c in DEFAULT_FEATURES}
    cells = [
        F.struct(F.lit(c).alias("feature"), F.round(w, 5).alias("weight")) for c, w in weights.items()]
    return spread.select(F.inline(F.array(*cells)))


def _default_optimum_sql() -> str:
    """Minimise the penalised loss by proximal gradient steps on the correlations alone."""
    names = [f"cast({c} as double)" for c in DEFAULT_FEATURES]
    rows = ", ".join("[" + ", ".join(f"corr({a}, {b})" for b in names) + "]" for a in names)
    label = f"cast({DEFAULT_LABEL} as double)"
    sides = ", ".join(f"corr({a}, {label})" for a in names)
    count = len(names)
    return f"""with recursive base as materialized (
  select * from lineitem where {md5_train_sql("l_orderkey")}
), problem as materialized (
  select [{rows}] as g, [{sides}] as c, 0.3e0 / stddev_pop({label}) as lam, 0.8e0 as a from base
), scaled as materialized (
  select *, 1 / (lam + list_max(list_transform(g, lambda r: list_sum(list_transform(r, lambda x: abs(x)))))) as s
  from problem
), steps as (
  select 0 as step, list_transform(range({count}), lambda i: 0e0) as w
  union all
  select step + 1, list_transform(
    list_transform(range(1, {count + 1}), lambda i:
      w[i] + s * (c[i] - list_dot_product(g[i], w) - lam * (1 - a) * w[i])),
    lambda z: sign(z) * greatest(abs(z) - s * lam * a, 0))
  from steps, scaled where step < {STEPS}
)
select unnest({list(DEFAULT_FEATURES)}) as feature, round(unnest(w), 5) as weight
from steps where step = {STEPS}"""


def _regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of predictions by a fixed formula."""
    df = table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").alias("label"),
        (F.col("l_quantity") * 2000.0 + 1000.0).alias("prediction"),
    )
    return tp.regression_metrics(df, digits=4)


REGRESSION_QUERIES = {
    "linear_regression_elastic_net": Query(_elastic_net, ELASTIC_NET_SQL),
    "linear_regression_two_features": Query(
        _least_squares,
        _least_squares_sql(
            "select * from lineitem",
            "l_extendedprice",
            ["l_quantity", "l_discount"],
            "l_orderkey",
            3,
        ),
    ),
    "linear_regression_nulls": Query(
        _least_squares_nulls,
        _least_squares_sql(
            LINEITEM_NULLS_SQL, "l_tax", ["l_linenumber", "l_discount"], "l_orderkey", 5
        ),
    ),
    "linear_regression_default_metrics": Query(
        _default_regression,
        f"""select count(*) filter (where not t) as test_rows,
       count(*) filter (where t) as training_rows, true as rmse_matches, true as r2_matches
from (select {md5_train_sql("l_orderkey")} as t from lineitem)""",
    ),
    "linear_regression_default_optimum": Query(_default_optimum, _default_optimum_sql()),
    "linear_regression_trimmed": Query(
        lambda s, d: tp.run_model(table(s, d, "lineitem"), "linear_regression", top_n=2)
        .filter("metric in ('coefficient', 'feature')").groupBy("metric")
        .agg(F.count(F.lit(1)).alias("n")),
        "select 'coefficient' as metric, 2::bigint as n union all select 'feature', 7",
    ),
    "linear_regression_default": Query(
        lambda s, d: tp.run_model(table(s, d, "lineitem"), "linear_regression")
    ),
    "regression_metrics": Query(
        _regression_metrics,
        """select round(sqrt(avg(e * e)), 4) as rmse, round(1 - avg(e * e) / var_pop(y), 4) as r2
from (select l_extendedprice as y, l_extendedprice - (l_quantity * 2000 + 1000) as e
      from lineitem)""",
    ),
}


# Decision trees. The checked trees use columns of few values, where every value
# has its own bin and the splits are exact.

TREE_FEATURES = ("l_quantity", "l_discount", "l_linenumber")
TREE_METRICS = ("threshold", *COUNTS, "accuracy", "f1")


def _tree(spark: SparkSession, folder: str, depth: int):
    return tp.fit_decision_tree(
        table(spark, folder, "lineitem"),
        "l_extendedprice",
        TREE_FEATURES,
        key=["l_orderkey"],
        max_depth=depth,
        max_bins=64,
    )


def _tree_facts(spark: SparkSession, folder: str, depth: int) -> DataFrame:
    return _numbers(_tree(spark, folder, depth).facts_frame(), TREE_METRICS)


def _tree_predictions(spark: SparkSession, folder: str, depth: int) -> DataFrame:
    scored = _tree(spark, folder, depth).predict()
    return scored.groupBy(*TREE_FEATURES, "prediction").agg(F.count(F.lit(1)).alias("n"))


def _tree_ctes(depth: int) -> str:
    """Grow the tree level by level over the distinct feature combinations.

    A level takes, per node, the midpoint of adjacent values with the largest
    Gini gain, found by running sums; a node without any gain stays a leaf.
    """
    columns = [f"f{j}" for j in range(len(TREE_FEATURES))]
    picks = ", ".join(f"{f} as {c}" for f, c in zip(TREE_FEATURES, columns))
    keys = ", ".join(columns)
    ctes = [
        f"""middle as (select quantile_disc(l_extendedprice, 0.5) as threshold from lineitem),
base as materialized (
  select {picks}, case when l_extendedprice > threshold then 1 else 0 end as y,
         {md5_train_sql("l_orderkey")} as is_train from lineitem, middle
), level0 as materialized (
  select {keys}, is_train, count(*) as n, sum(y) as pos, 1 as node
  from base group by {keys}, is_train
)"""
    ]
    for level in range(depth):
        branches = [
            f"""select node, {j} as j, cast({c} as double) as v, sum(n) as n, sum(pos) as pos
  from level{level} where is_train group by node, {c}"""
            for j, c in enumerate(columns)
        ]
        went_left = " ".join(f"when {j} then {c} <= s.cut" for j, c in enumerate(columns))
        ctes.append(
            f"""values{level} as ({" union all ".join(branches)}),
running{level} as (
  select node, j, (v + lead(v) over w) / 2 as cut, sum(n) over w as ln, sum(pos) over w as lp,
         sum(n) over (partition by node, j) as n, sum(pos) over (partition by node, j) as p
  from values{level} window w as (partition by node, j order by v)
), gains{level} as (
  select node, j, cut,
         {_gini("n", "p")} - ln * 1e0 / n * {_gini("ln", "lp")}
           - (n - ln) * 1e0 / n * {_gini("(n - ln)", "(p - lp)")} as gain
  from running{level} where cut is not null
), split{level} as (
  select node, j, cut from gains{level} where gain > 0
  qualify row_number() over (partition by node order by gain desc, j, cut) = 1
), level{level + 1} as materialized (
  select {", ".join(f"l.{c}" for c in columns)}, l.is_train, l.n, l.pos,
         case when s.node is null then l.node * 2
              when case s.j {went_left} end then l.node * 2 else l.node * 2 + 1 end as node
  from level{level} l left join split{level} s on s.node = l.node
)"""
        )
    ctes.append(
        f"""leaves as (
  select node, case when 2 * sum(pos) > sum(n) then 1 else 0 end as label
  from level{depth} where is_train group by node
), scored as (
  select l.*, leaves.label from level{depth} l join leaves on leaves.node = l.node
)"""
    )
    return "with " + ",\n".join(ctes)


def _gini(n: str, pos: str) -> str:
    return f"(1 - ({pos} * 1e0 / {n}) ** 2 - (1 - {pos} * 1e0 / {n}) ** 2)"


def _tree_facts_sql(depth: int) -> str:
    cells = [(None, metric, metric) for metric in TREE_METRICS]
    return f"""{_tree_ctes(depth)},
confusion as (
  select sum(n) as total,
         sum(case when label = 1 then pos else 0 end) as tp,
         sum(case when label = 1 then n - pos else 0 end) as fp,
         sum(case when label = 0 then pos else 0 end) as fn,
         sum(case when label = 0 then n - pos else 0 end) as tn
  from scored where not is_train
), facts as (
  select threshold, (select count(*) from base where is_train) as training_rows,
         total as test_rows, 0 as dropped_rows,
         round((tp + tn) * 1e0 / total, 4) as accuracy,
         round(((tp + fn) * coalesce(2e0 * tp / nullif(2 * tp + fp + fn, 0), 0)
                + (tn + fp) * coalesce(2e0 * tn / nullif(2 * tn + fp + fn, 0), 0)) / total, 4) as f1
  from confusion, middle
)
{_facts_sql(cells, 4, "facts")}"""


def _tree_predictions_sql(depth: int) -> str:
    picks = ", ".join(f"f{j} as {name}" for j, name in enumerate(TREE_FEATURES))
    return f"""{_tree_ctes(depth)}
select {picks}, cast(label as double) as prediction, cast(sum(n) as bigint) as n
from scored group by all"""


HISTOGRAM_FEATURES = (
    "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
)


def _histogram_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The default tree, split by order: 32 bins a feature, five levels, pruned."""
    facts = tp.run_model(table(spark, folder, "lineitem"), "decision_tree", key=["l_orderkey"])
    return _numbers(facts, (*TREE_METRICS, "depth", "num_nodes"))


def _histogram_tree_sql(depth: int = 5, bins: int = 32) -> str:
    """Edges from running counts of values, then the levels over binned rows."""
    columns = [f"b{j}" for j in range(len(HISTOGRAM_FEATURES))]
    keys, steps = ", ".join(columns), bins - 1
    ctes = [
        f"""middle as (select quantile_disc(l_orderkey, 0.5) as threshold from lineitem),
base as materialized (
  select {", ".join(f"cast({f} as double) as f{j}" for j, f in enumerate(HISTOGRAM_FEATURES))},
         case when l_orderkey > threshold then 1 else 0 end as y,
         {md5_train_sql("l_orderkey")} as is_train from lineitem, middle
)"""
    ]
    for j in range(len(columns)):
        ctes.append(
            f"""running_{j} as (
  select x, n, sum(n) over (order by x) as upto, sum(n) over () as total,
         count(*) over () as different, max(x) over () as most
  from (select f{j} as x, count(*) as n from base where is_train group by 1)
), edges_{j} as materialized (
  select coalesce(list(distinct x), []) as edges from running_{j}, range({steps}) as s(i)
  where case when different <= {bins} then x < most
             else greatest(1, (i * total + {steps - 1}) // {steps}) between upto - n + 1 and upto end
)"""
        )
    placed = ", ".join(
        f"len([e for e in (select edges from edges_{j}) if e < f{j}]) as b{j}"
        for j in range(len(columns))
    )
    ctes.append(
        f"""binned as materialized (select {placed}, y, is_train from base),
level0 as materialized (
  select {keys}, is_train, count(*) as n, sum(y) as pos, 1 as node
  from binned group by {keys}, is_train
)"""
    )
    purity = lambda n, p: f"(1e0 * {p} * {p} + 1e0 * ({n} - {p}) * ({n} - {p})) / {n}"
    for level in range(depth):
        branches = union_sql([
            f"select node, {j} as j, {c} as b, sum(n) as n, sum(pos) as pos"
            f" from level{level} where is_train group by node, {c}"
            for j, c in enumerate(columns)
        ])
        went_left = " ".join(f"when {j} then {c} <= s.b" for j, c in enumerate(columns))
        ctes.append(
            f"""sums{level} as (
  select node, j, b, cast(sum(n) over w as bigint) as ln, cast(sum(pos) over w as bigint) as lp,
         cast(sum(n) over (partition by node, j) as bigint) as n,
         cast(sum(pos) over (partition by node, j) as bigint) as p
  from ({branches}) window w as (partition by node, j order by b)
), split{level} as materialized (
  select node, j, b from sums{level} where ln < n and lp * n <> p * ln
  qualify row_number() over (partition by node order by
    {purity("ln", "lp")} + {purity("(n - ln)", "(p - lp)")} desc, j, b) = 1
), level{level + 1} as materialized (
  select {", ".join(f"l.{c}" for c in columns)}, l.is_train, l.n, l.pos,
         case when s.node is null then l.node * 2
              when case s.j {went_left} end then l.node * 2 else l.node * 2 + 1 end as node
  from level{level} l left join split{level} s on s.node = l.node
)"""
        )
    divided = union_sql([
        f"select {level} as level from split{level} s join leaves on leaves.node // {2 ** (depth - level)} = s.node"
        f" group by s.node having min(label) <> max(label)"
        for level in range(depth)
    ])
    cells = [(None, metric, metric) for metric in (*TREE_METRICS, "depth", "num_nodes")]
    return f"""with {", ".join(ctes)},
leaves as materialized (
  select node, case when 2 * sum(pos) > sum(n) then 1 else 0 end as label
  from level{depth} where is_train group by node
), shape as (
  select coalesce(max(level) + 1, 0) as depth, 1 + 2 * count(*) as num_nodes from ({divided})
), confusion as (
  select sum(n) as total,
         sum(case when label = 1 then pos else 0 end) as tp,
         sum(case when label = 1 then n - pos else 0 end) as fp,
         sum(case when label = 0 then pos else 0 end) as fn,
         sum(case when label = 0 then n - pos else 0 end) as tn
  from level{depth} l join leaves on leaves.node = l.node where not is_train
), facts as (
  select threshold, (select count(*) from base where is_train) as training_rows,
         total as test_rows, 0 as dropped_rows, depth, num_nodes,
         round((tp + tn) * 1e0 / total, 4) as accuracy,
         round(((tp + fn) * coalesce(2e0 * tp / nullif(2 * tp + fp + fn, 0), 0)
                + (tn + fp) * coalesce(2e0 * tn / nullif(2 * tn + fp + fn, 0), 0)) / total, 4) as f1
  from confusion, middle, shape
)
{_facts_sql(cells, 4, "facts")}"""


def _quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Nine tenths of three columns, one of them with NULLs, from the same scans."""
    df = lineitem_with_nulls(spark, folder)
    names = ["l_extendedprice", "l_partkey", "l_tax"]
    found = exact_quantiles(df, names, [Fraction(i, 10) for i in range(1, 10)])
    rows = [(n, i + 1, x) for n in names for i, x in enumerate(found[n])]
    return spark.createDataFrame(rows, "column string, tenth int, value double")


QUANTILES_SQL = union_sql([
    f"""select '{c}' as "column", cast(i as int) as tenth, min(x) as value from (
  select cast({c} as double) as x, row_number() over (order by {c}) as place, count(*) over () as n
  from ({LINEITEM_NULLS_SQL}) where {c} is not null), range(1, 10) as s(i)
where place >= (i * n + 9) // 10 group by i"""
    for c in ("l_extendedprice", "l_partkey", "l_tax")
])


def _classification_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Three classes: the line number's remainder guessed from the quantity's."""
    df = table(spark, folder, "lineitem").select(
        (F.col("l_linenumber") % 3).alias("label"),
        (F.col("l_quantity").cast("int") % 4).alias("prediction"),
    )
    return tp.classification_metrics(df, digits=6)


TREE_QUERIES = {
    "decision_tree_stump": Query(lambda s, d: _tree_facts(s, d, 1), _tree_facts_sql(1)),
    "decision_tree_depth_2": Query(lambda s, d: _tree_facts(s, d, 2), _tree_facts_sql(2)),
    "decision_tree_predictions": Query(
        lambda s, d: _tree_predictions(s, d, 3), _tree_predictions_sql(3)
    ),
    "decision_tree_default_metrics": Query(
        _default_tree,
        f"""select (select cast(quantile_disc(l_orderkey, 0.5) as double) from lineitem) as threshold,
       count(*) as test_rows, true as accuracy_matches, true as shape_fits
from lineitem where not {md5_train_sql("l_orderkey")}""",
    ),
    "decision_tree_histogram": Query(_histogram_tree, _histogram_tree_sql()),
    "quantiles_lineitem_nulls": Query(_quantiles, QUANTILES_SQL),
    "decision_tree_default": Query(
        lambda s, d: tp.run_model(table(s, d, "lineitem"), "decision_tree")
    ),
    "classification_metrics": Query(
        _classification_metrics,
        """with p as (
  select l_linenumber % 3 as y, cast(l_quantity as integer) % 4 as g from lineitem
), classes as (
  select y as c, count(*) as actual, count(*) filter (where y = g) as hits,
         (select count(*) from p q where q.g = p.y) as predicted
  from p group by y
)
select round(sum(hits) * 1e0 / sum(actual), 6) as accuracy,
       round(sum(actual * (2e0 * hits / (actual + predicted))) / sum(actual), 6) as f1
from classes""",
    ),
}


# K-means

LLOYD_STEPS = 10
LLOYD_FEATURES = ("o_custkey", "o_totalprice")


def _lloyd(spark: SparkSession, folder: str):
    return tp.lloyd_kmeans(
        table(spark, folder, "orders"),
        LLOYD_FEATURES,
        key=["o_orderkey"],
        max_iter=LLOYD_STEPS,
        tol=0.0,
    )


def _lloyd_facts(spark: SparkSession, folder: str) -> DataFrame:
    """The cost is a sum of 10^13 and more, so it is compared per row."""
    found = _lloyd(spark, folder)
    per_row = F.round(F.col("num_value") / sum(found.sizes), 3)
    value = F.when(F.col("metric") == "cost", per_row).otherwise(F.round("num_value", 3))
    facts = found.facts_frame(digits=None).filter(F.col("num_value").isNotNull())
    return facts.select("subject", "metric", value.alias("num_value"))


def _lloyd_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_sizes(_lloyd(spark, folder).predict())


def _kmeans_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_sizes(tp.fit_kmeans(table(spark, folder, "customer")).predict())


def _spread(scored: DataFrame, centres, features) -> DataFrame:
    """Rows, total squared distance, and the mean of each feature by cluster."""
    table_ = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centres])
    own = F.element_at(table_, F.col("prediction") + 1)
    far = sum((F.col(f).cast("double") - own[i]) ** 2 for i, f in enumerate(features))
    return scored.groupBy("prediction").agg(
        F.count(F.lit(1)).alias("n"), F.sum(far).alias("cost"),
        *[F.avg(f).alias(f"m{i}") for i, f in enumerate(features)],
    )


def _lloyd_many(spark: SparkSession, folder: str) -> DataFrame:
    """Sixty clusters: every centre is near the mean of its rows, the cost their sum."""
    features = ("c_custkey", "c_acctbal")
    found = tp.lloyd_kmeans(table(spark, folder, "customer"), features, k=60, max_iter=40, tol=1e-9)
    rows = _spread(found.predict(), found.centres, features).collect()
    near = all(
        abs(r[f"m{i}"] - found.centres[r["prediction"]][i]) <= 0.05 * (1 + abs(r[f"m{i}"]))
        for r in rows for i in range(2)
    )
    cost = sum(r["cost"] for r in rows)
    return spark.createDataFrame(
        [(len(found.centres), sum(r["n"] for r in rows), near,
          abs(cost - found.cost) <= 1e-6 * cost)],
        "clusters int, rows long, close_to_mean boolean, cost_matches boolean",
    )


def _kmeans_fixed_point(spark: SparkSession, folder: str) -> DataFrame:
    """The default fit: its cost is the sum over its own predictions."""
    df = table(spark, folder, "customer")
    fit = tp.fit_kmeans(df, digits=None)
    features = [s for s, m, _ in fit.facts if m == "feature"]
    centres = [
        [fit.fact(f"centre of {name}", f"cluster {i}") for name in features] for i in range(3)
    ]
    rows = _spread(fit.predict(), centres, features).collect()
    cost = sum(r["cost"] for r in rows)
    return spark.createDataFrame(
        [(3, sum(r["n"] for r in rows), abs(cost - fit.fact("cost")) <= 1e-6 * cost)],
        "clusters int, rows long, cost_matches boolean",
    )


def _kmeans_trimmed(spark: SparkSession, folder: str) -> DataFrame:
    facts = tp.fit_kmeans(table(spark, folder, "customer"), max_dims=1).facts_frame()
    centres = facts.filter(F.col("metric").startswith("centre of"))
    return centres.groupBy("subject").agg(F.count(F.lit(1)).alias("centres"))


def _lloyd_ctes() -> str:
    """Lloyd steps one after the other; centres live in one row of six columns."""
    nearest = " ".join(
        f"when d{i} <= least(d0, d1, d2) then {i}" for i in range(2)
    )
    distances = ", ".join(
        f"(x - x{i}) ** 2 + (y - y{i}) ** 2 as d{i}" for i in range(3)
    )

    def assigned(step: int) -> str:
        return f"""a{step} as materialized (
  select x, y, case {nearest} else 2 end as c, least(d0, d1, d2) as d
  from (select x, y, {distances} from points, m{step})
)"""

    seeds = ", ".join(
        f"max(x) filter (where r = {i + 1}) as x{i}, max(y) filter (where r = {i + 1}) as y{i}"
        for i in range(3)
    )
    means = ", ".join(
        f"coalesce(avg(x) filter (where c = {i}), max(x{i})) as x{i},"
        f" coalesce(avg(y) filter (where c = {i}), max(y{i})) as y{i}"
        for i in range(3)
    )
    ctes = [
        f"""points as materialized (
  select cast(o_custkey as double) as x, o_totalprice as y,
         md5(cast(o_orderkey as varchar) || '|42') as h from orders
), firsts as (
  select x, y, row_number() over (order by min(h)) as r from points group by x, y
), m0 as materialized (select {seeds} from firsts)"""
    ]
    for step in range(LLOYD_STEPS):
        ctes.append(assigned(step))
        ctes.append(f"m{step + 1} as materialized (select {means} from a{step}, m{step})")
    ctes.append(assigned(LLOYD_STEPS))
    return "with " + ",\n".join(ctes)


def _lloyd_sql() -> str:
    last = f"a{LLOYD_STEPS}"
    branches = [
        "select cast(null as varchar) as subject, 'clusters' as metric, 3e0 as num_value",
        f"select null, 'rows', cast(count(*) as double) from {last}",
        f"select null, 'cost', round(sum(d) / count(*), 3) from {last}",
        f"select 'cluster ' || c, 'size', cast(count(*) as double) from {last} group by c",
    ]
    for i in range(3):
        for axis, name in zip("xy", LLOYD_FEATURES):
            branches.append(
                f"select 'cluster {i}', 'centre of {name}', round({axis}{i}, 3)"
                f" from m{LLOYD_STEPS}"
            )
    return _lloyd_ctes() + "\n" + "\nunion all\n".join(branches)


KMEANS_QUERIES = {
    "kmeans_lloyd": Query(_lloyd_facts, _lloyd_sql()),
    "kmeans_cluster_sizes": Query(
        _lloyd_sizes,
        f"""{_lloyd_ctes()}
select c as cluster, count(*) as size from a{LLOYD_STEPS} group by c""",
    ),
    "kmeans_lloyd_many": Query(
        _lloyd_many,
        "select 60 as clusters, count(*) as rows, true as close_to_mean, true as cost_matches"
        " from customer",
    ),
    "kmeans_default_fixed_point": Query(
        _kmeans_fixed_point,
        "select 3 as clusters, count(*) as rows, true as cost_matches from customer",
    ),
    "kmeans_trimmed": Query(
        _kmeans_trimmed,
        """select 'cluster ' || c as subject, 1::bigint as centres
from (select unnest([0, 1, 2]) as c)""",
    ),
    "kmeans_default": Query(lambda s, d: tp.run_model(table(s, d, "lineitem"), "kmeans")),
    "kmeans_default_sizes": Query(_kmeans_sizes),
}

QUERIES = {**FEATURE_QUERIES, **REGRESSION_QUERIES, **TREE_QUERIES, **KMEANS_QUERIES}
