"""Profiles and missing values."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import evaluation as EV
from plumbline.operators import explain as X
from plumbline.operators import impute as I
from plumbline.operators import profile as P
from plumbline.plans.catalog import frames
from plumbline.plans.catalog.registry import query, rounded

PROFILED = ("l_linestatus", *frames.LINE_NUMERIC, "y")
DOUBLES = frames.LINE_NUMERIC


def stats_sql(source: str, categorical: list[str], numeric: list[str], kinds: dict[str, str] | None = None) -> str:
    """CTE ``stats`` with the full profile of some columns."""
    kinds = kinds or {}
    parts = []
    for c in categorical:
        parts.append(
            f"""SELECT '{c}' AS "Variable", count({c}) AS "Non_Missing", count(*) - count({c}) AS "Missing",
  count(*) AS total_rows, round((count(*) - count({c})) * 100.0 / count(*), 6) AS missing_percent,
  NULL::DOUBLE AS "Mean", (SELECT {c} FROM (SELECT {c}, count(*) AS n FROM {source} GROUP BY {c})
    ORDER BY n DESC, {c} IS NULL, {c} LIMIT 1) AS "Mode", 'string' AS dtype_vars,
  count(DISTINCT {c}) AS distinct_values FROM {source}"""
        )
    for c in numeric:
        kind = kinds.get(c, "int" if c == "y" else "double")
        parts.append(
            f"""SELECT '{c}' AS "Variable", count({c}) AS "Non_Missing", count(*) - count({c}) AS "Missing",
  count(*) AS total_rows, round((count(*) - count({c})) * 100.0 / count(*), 6) AS missing_percent,
  round(avg({c}), 6) AS "Mean", NULL::VARCHAR AS "Mode", '{kind}' AS dtype_vars,
  NULL::BIGINT AS distinct_values FROM {source}"""
        )
    return "stats AS (" + " UNION ALL ".join(parts) + ")"


NULL_STATS = f"WITH {frames.NULLS}, {stats_sql('nulls', ['l_linestatus'], list(PROFILED[1:]))} "


@query("row_count", "SELECT count(*) AS total_rows FROM lineitem")
def _(spark, folder):
    return P.row_count(frames.table(spark, folder, "lineitem"))


def _describe_sql(source: str, texts: list[str], numbers: list[str]) -> str:
    parts = [
        f"""SELECT '{c}' AS "Variable", count({c}) AS count, NULL::DOUBLE AS mean, NULL::DOUBLE AS stddev,
  NULL::DOUBLE AS min, NULL::DOUBLE AS max, min({c}) AS min_text, max({c}) AS max_text FROM {source}"""
        for c in texts
    ]
    parts += [
        f"""SELECT '{c}', count({c}), round(avg({c}), 6), round(stddev_samp({c}), 6), min({c})::DOUBLE,
  max({c})::DOUBLE, NULL, NULL FROM {source}"""
        for c in numbers
    ]
    return " UNION ALL ".join(parts)


@query("describe_columns", f"WITH {frames.NULLS} {_describe_sql('nulls', ['l_linestatus'], list(PROFILED[1:]))}")
def _(spark, folder):
    rows = frames.returns_nulls(spark, folder).select(*PROFILED)
    return rounded(P.describe_columns(rows), "mean", "stddev")


@query(
    "missing_profile",
    NULL_STATS + 'SELECT "Variable", "Non_Missing", total_rows, "Missing", missing_percent FROM stats',
)
def _(spark, folder):
    return rounded(P.missing_profile(frames.returns_nulls(spark, folder).select(*PROFILED)), "missing_percent")


@query("mode_profile", NULL_STATS + """SELECT "Variable", "Mode" FROM stats WHERE dtype_vars = 'string' """)
def _(spark, folder):
    return P.mode_profile(frames.returns_nulls(spark, folder), ["l_linestatus"])


@query(
    "mode_profile_documents",
    """SELECT 'lang' AS "Variable", (SELECT lang FROM documents GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1) AS "Mode"
UNION ALL SELECT 'source', (SELECT source FROM documents GROUP BY source ORDER BY count(*) DESC, source LIMIT 1)
UNION ALL SELECT 'text', (SELECT text FROM documents GROUP BY text ORDER BY count(*) DESC, text LIMIT 1)""",
)
def _(spark, folder):
    return P.mode_profile(frames.table(spark, folder, "documents"), ["lang", "source", "text"], count_nulls=False)


@query("mean_profile", NULL_STATS + 'SELECT "Variable", "Mean" FROM stats')
def _(spark, folder):
    return rounded(P.mean_profile(frames.returns_nulls(spark, folder).select(*PROFILED)), "Mean")


@query("dtype_profile", NULL_STATS + 'SELECT "Variable", dtype_vars, total_rows FROM stats')
def _(spark, folder):
    return P.dtype_profile(frames.returns_nulls(spark, folder).select(*PROFILED))


@query(
    "distinct_profile",
    f"""WITH {frames.ORDER_STATUS} SELECT 'n_name' AS "Variable", count(DISTINCT n_name) AS distinct_values FROM order_status
UNION ALL SELECT 'c_mktsegment', count(DISTINCT c_mktsegment) FROM order_status
UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM order_status""",
)
def _(spark, folder):
    rows = frames.order_status(spark, folder)
    return P.distinct_profile(rows, ["n_name", "c_mktsegment", "o_orderpriority"])


@query("data_stats", NULL_STATS + "SELECT * FROM stats")
def _(spark, folder):
    stats = P.data_stats(frames.returns_nulls(spark, folder).select(*PROFILED))
    return rounded(stats, "missing_percent", "Mean")


@query(
    "group_sum_count",
    f"""WITH {frames.RETURNS} SELECT l_linestatus, count(*) AS count, sum(y)::BIGINT AS target,
  sum(1 - y)::BIGINT AS non_target FROM returns GROUP BY l_linestatus""",
)
def _(spark, folder):
    rows = EV.non_target_flag(frames.returns(spark, folder), "y")
    return EV.group_sum_count(rows, "l_linestatus", "y", "non_target")


@query(
    "crosstab_counts",
    f"""WITH {frames.SCORED} SELECT y, count(*) FILTER (prediction = 0) AS predicted_0,
  count(*) FILTER (prediction = 1) AS predicted_1 FROM scored GROUP BY y""",
)
def _(spark, folder):
    return EV.crosstab_counts(frames.returns_scored(spark, folder), "y", "prediction")


@query(
    "column_totals",
    f"WITH {frames.SCORED} SELECT sum(y)::BIGINT AS total_y, max(score) AS max_score FROM scored",
)
def _(spark, folder):
    return EV.column_totals(frames.returns_scored(spark, folder), ["y"], ["score"])


@query(
    "mean_abs",
    f"""WITH {frames.ATTRIBUTIONS} SELECT "Variable", round(avg(abs(shap_value)), 8) AS mean_abs
FROM attributions GROUP BY "Variable" """,
)
def _(spark, folder):
    return rounded(X.mean_abs(frames.attributions(spark, folder)), "mean_abs", digits=8)


@query(
    "corr_pair",
    f"""WITH {frames.ATTRIBUTIONS} SELECT "Variable",
  round(CASE WHEN min(feature_value) < max(feature_value) THEN corr(feature_value, shap_value) END, 8) AS corr
FROM attributions GROUP BY "Variable" """,
)
def _(spark, folder):
    return rounded(X.corr_pair(frames.attributions(spark, folder)), "corr", digits=8)


IMPUTED = ("l_orderkey", "l_linenumber", "l_discount", "l_linestatus")


@query(
    "impute_mode",
    """WITH flagged AS (SELECT l_orderkey, l_linenumber,
  CASE WHEN l_orderkey % 5 <> 0 THEN l_returnflag END AS l_returnflag FROM lineitem)
SELECT l_orderkey, l_linenumber, coalesce(l_returnflag, (SELECT l_returnflag FROM flagged GROUP BY l_returnflag
  ORDER BY count(*) DESC, l_returnflag IS NULL, l_returnflag LIMIT 1)) AS l_returnflag FROM flagged""",
)
def _(spark, folder):
    flag = F.when(F.col("l_orderkey") % 5 != 0, F.col("l_returnflag")).alias("l_returnflag")
    rows = frames.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", flag)
    return I.impute_mode(rows, I.modes(rows))


@query(
    "impute_mean",
    f"""WITH {frames.NULLS} SELECT l_orderkey, l_linenumber,
  round(coalesce(l_discount, (SELECT avg(l_discount) FROM nulls)), 6) AS l_discount FROM nulls""",
)
def _(spark, folder):
    rows = frames.returns_nulls(spark, folder).select("l_orderkey", "l_linenumber", "l_discount")
    return rounded(I.impute_mean(rows, I.means(rows.select("l_discount"))), "l_discount")


@query(
    "impute_mean_integer",
    """SELECT o_orderkey, round(coalesce(CASE WHEN o_custkey % 4 <> 0 THEN o_custkey END,
  (SELECT avg(o_custkey) FROM orders WHERE o_custkey % 4 <> 0))::DOUBLE, 6) AS o_custkey FROM orders""",
)
def _(spark, folder):
    customer = F.when(F.col("o_custkey") % 4 != 0, F.col("o_custkey")).alias("o_custkey")
    rows = frames.table(spark, folder, "orders").select("o_orderkey", customer)
    return rounded(I.impute_mean(rows, I.means(rows.select("o_custkey"))), "o_custkey")


@query(
    "impute_constant",
    f"""WITH {frames.NULLS} SELECT l_orderkey, l_linenumber, l_discount,
  coalesce(l_linestatus, 'Unknown_Value') AS l_linestatus FROM nulls""",
)
def _(spark, folder):
    rows = frames.returns_nulls(spark, folder).select(*IMPUTED)
    return I.impute_constant(I.impute_mode(rows, I.modes(rows)))


@query(
    "mixed_imputer",
    f"""WITH {frames.NULLS} SELECT l_orderkey, l_linenumber,
  round(coalesce(l_discount, (SELECT avg(l_discount) FROM nulls)), 6) AS l_discount,
  coalesce(l_linestatus, (SELECT l_linestatus FROM nulls WHERE l_linestatus IS NOT NULL GROUP BY l_linestatus
    ORDER BY count(*) DESC, l_linestatus LIMIT 1)) AS l_linestatus FROM nulls""",
)
def _(spark, folder):
    rows = frames.returns_nulls(spark, folder).select(*IMPUTED)
    model = I.MixedImputer(columns=["l_discount", "l_linestatus"]).fit(rows)
    return rounded(model.transform(rows), "l_discount")


@query(
    "mixed_imputer_null_mode",
    f"""WITH {frames.NULLS} SELECT l_orderkey, l_linenumber,
  round(coalesce(l_discount, (SELECT avg(l_discount) FROM nulls)), 6) AS l_discount,
  coalesce(l_linestatus, 'Unknown_Value') AS l_linestatus FROM nulls""",
)
def _(spark, folder):
    rows = frames.returns_nulls(spark, folder).select(*IMPUTED)
    model = I.MixedImputer(columns=["l_discount", "l_linestatus"], countNulls=True).fit(rows)
    return rounded(model.transform(rows), "l_discount")
