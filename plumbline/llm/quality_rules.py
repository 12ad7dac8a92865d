"""Text statistics and robust multivariate outliers, in DataFrame functions only.

Every text gets word and repetition counts. Rows that pass the base rules are measured
by four transformed statistics; per language and source a minimum-covariance-determinant
estimate (deterministic start from medians and median deviations, then concentration
steps, then one reweighting step) gives centre and covariance, and rows beyond a
chi-square limit of the squared Mahalanobis distance are rejected.

A concentration step needs the nearest half of a group, so that junk may fill nearly the
other half; the reweighting step takes all rows inside a quantile of the distance.
The distance that judges a row adds to the variances of the two repetition features what
the row's own number of lines and words leaves open (binomial error), so that one repeated
line among three counts for less than twenty among sixty. Rows are counted and
summed per (group, distance bucket) on the map side, so no group is ever collected and
only a few hundred buckets a group are shuffled; the subset is whole buckets, up to the
one that holds the wanted rank. Sums are exact (integers in decimals), so the result
does not depend on partitioning.

A group's estimate is averaged with that of its language, that with the one of the whole
table, and that with fixed spreads: a group of n rows counts n, what stands above it
``prior_rows``. So a small group leans on a larger one, and there is no size at which the
verdict jumps.

Null text: no words, fails the base rules. Null language or source: a group of its own.
Repeated rows are measured one by one, other columns are ignored, an empty table gives an
empty result, text length is not limited.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import materialise, texts, words

FEATURES = ("word_length", "symbols", "dup_lines", "repeats")
#: Standard deviation below which a feature is not resolved, in its transformed unit.
FLOORS = (0.05, 0.04, 0.06, 0.06)
#: What a share is counted over; the root of a share of n has a variance of 1 / 4n at most.
COUNTED = {"dup_lines": "n_lines", "repeats": "n_words"}
SCALE = 1 << 16
GRID = 1 << 8
#: Share of a group in a concentration step, and of a normal population in the reweighting step.
SUBSET, INSIDE = 0.5, 0.975
TAIL = 1e-7
STEPS = 4
#: Distance buckets per doubling.
FINE = 32
#: Rows that the estimate above a group counts for, and standard deviations above the whole table.
PRIOR_ROWS, PRIOR = 10, (0.15, 0.10, 0.15, 0.15)


def chi_square(x: float, degrees: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(degrees // 2))


def chi_square_quantile(p: float, degrees: int) -> float:
    low, high = 0.0, 1e4
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < p else (low, middle)
    return high


def text_statistics(df: DataFrame, key: str = "doc_id", text: str = "text", *extra: Column) -> DataFrame:
    """Rows (doc_id, extra columns, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words)."""
    rows = texts(df, key, text, *extra)
    kept = [c for c in rows.columns if c != "text"]
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    first = rows.select(
        *kept,
        words(F.col("text")).alias("words"),
        lines.alias("lines"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
    )
    window = F.transform(
        F.sequence(F.lit(0), F.size("words") - 3),
        lambda i: F.struct(
            F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("i")
        ),
    )
    second = first.select(
        *kept,
        "n_symbols",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.sort_array(F.when(F.size("words") >= 3, window).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))).alias("w"),
    )
    # Windows that are equal stand side by side; the nearest of them suffices.
    twice = F.filter(
        "w",
        lambda x, i: ((i > 0) & (x["h"] == F.get("w", i - 1)["h"])) | F.coalesce(x["h"] == F.get("w", i + 1)["h"], F.lit(False)),
    )
    third = second.withColumn("starts", F.array_sort(F.transform(twice, lambda x: x["i"]))).drop("w")
    # Each repeated window adds the words up to the next repeated one, three at most.
    covered = F.zip_with(
        "starts",
        F.slice("starts", 2, F.greatest(F.size("starts"), F.lit(1))),
        lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))),
    )
    counted = F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return third.select(
        *kept, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", counted.alias("n_repeat_words")
    )


def base_rules() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _features() -> list[Column]:
    n, chars, n_lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))

    def share(part: str, whole: Column) -> Column:
        return F.sqrt(F.least(F.lit(1.0), F.col(part) / whole))

    values = [
        F.log(chars / n),
        share("n_symbols", chars),
        share("n_dup_lines", n_lines),
        share("n_repeat_words", n),
    ]
    return [F.round(v * SCALE).cast("bigint").alias(f) for v, f in zip(values, FEATURES)]


def _middle(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Per group and feature the median, on a grid: rows are counted, not collected."""
    bins = F.explode(
        F.array(*[F.struct(F.lit(f).alias("f"), F.floor(v / (SCALE // GRID)).alias("b")) for f, v in values.items()])
    )
    counts = rows.select("lang", "cell", bins.alias("x")).groupBy("lang", "cell", "x.f", "x.b").count()
    by = Window.partitionBy("lang", "cell", "f")
    upto = F.sum("count").over(by.orderBy("b"))
    ranked = counts.select("lang", "cell", "f", "b", upto.alias("upto"), F.sum("count").over(by).alias("n"))
    found = ranked.filter(2 * F.col("upto") >= F.col("n")).groupBy("lang", "cell", "f").agg(F.min("b").alias("b"))
    return found.groupBy("lang", "cell").agg(
        *[F.max(F.when(F.col("f") == f, (F.col("b") + 0.5) / GRID)).alias(f"m_{f}") for f in FEATURES]
    )


def _distance() -> Column:
    """Squared distance by forward substitution through the triangular factor."""
    solved: list[Column] = []
    for i, f in enumerate(FEATURES):
        rest = F.col(f) / SCALE - F.col(f"m_{f}")
        for j in range(i):
            rest = rest - F.col(f"l_{i}{j}") * solved[j]
        solved.append(rest / F.col(f"l_{i}{i}"))
    return reduce(lambda a, b: a + b, [y * y for y in solved])


def _resolved(joined: DataFrame) -> DataFrame:
    """Rows joined with their model; the factor also holds the row's own binomial error.

    The two features that have one come last, so only the last corner of the factor changes.
    """
    lines, repeated = (0.25 / F.greatest(F.col(COUNTED[f]), F.lit(1)) for f in FEATURES[2:])
    whole = F.col("l_32") * F.col("l_32") + F.col("l_33") * F.col("l_33") + repeated
    frame = joined.withColumns({"whole": whole, "root": F.sqrt(F.col("l_22") * F.col("l_22") + lines)})
    frame = frame.withColumns({"l_32": F.col("l_32") * F.col("l_22") / F.col("root"), "l_22": F.col("root")})
    return frame.withColumn("l_33", F.sqrt(F.col("whole") - F.col("l_32") * F.col("l_32"))).drop("whole", "root")


def _with_factor(moments: DataFrame, correction: float) -> DataFrame:
    """Centre and Cholesky factor of the covariance from exact sums."""
    n = F.col("n").cast("double")
    frame = moments.withColumns({f"m_{f}": F.col(f"s_{i}").cast("double") / n / SCALE for i, f in enumerate(FEATURES)})
    for i in range(len(FEATURES)):
        for j in range(i + 1):
            mean = F.col(f"q_{i}{j}").cast("double") / n / SCALE / SCALE
            cov = (mean - F.col(f"m_{FEATURES[i]}") * F.col(f"m_{FEATURES[j]}")) * correction
            if i == j:
                cov = F.greatest(cov, F.lit(0.0)) + FLOORS[i] ** 2
            frame = frame.withColumn(f"c_{i}{j}", cov)
    return _factored(frame).select("lang", "cell", "n", *_model_columns())


def _factored(frame: DataFrame) -> DataFrame:
    """Adds the Cholesky factor of the covariance in the columns c_ij."""
    for i in range(len(FEATURES)):
        for j in range(i + 1):
            rest = F.col(f"c_{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l_{i}{k}") * F.col(f"l_{j}{k}")
            value = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l_{j}{j}")
            frame = frame.withColumn(f"l_{i}{j}", value)
    return frame


def _model_columns() -> list[str]:
    return [f"m_{f}" for f in FEATURES] + _corners("l")


def _corners(letter: str) -> list[str]:
    return [f"{letter}_{i}{j}" for i in range(len(FEATURES)) for j in range(i + 1)]


def leaning(models: DataFrame, prior_rows: float = PRIOR_ROWS) -> DataFrame:
    """Estimates of the groups, each averaged with what stands above it.

    ``models`` has rows (lang, "=source"), (lang, "*") and one of the whole table ("", "**");
    that one, fifteen numbers, is read on the driver.
    """
    size = range(len(FEATURES))
    means = [f"m_{f}" for f in FEATURES]
    whole = {
        f"c_{i}{j}": reduce(lambda a, b: a + b, [F.col(f"l_{i}{k}") * F.col(f"l_{j}{k}") for k in range(j + 1)])
        for i in size
        for j in range(i + 1)
    }
    plain = materialise(models.select("lang", "cell", "n", *means, *[c.alias(n) for n, c in whole.items()]), "mcd-levels")

    def averaged(above: dict[str, Column]) -> list[Column]:
        return [((F.col("n") * F.col(c) + prior_rows * above[c]) / (F.col("n") + prior_rows)).alias(c) for c in above]

    fixed = {c: F.lit(PRIOR[int(c[2])] ** 2 if c[2] == c[3] else 0.0) for c in whole}
    table = plain.filter("cell = '**'")
    top = table.select(*means, *averaged(fixed)).first()
    above = {c: F.lit(top[c] if top else None).cast("double") for c in [*means, *whole]}
    languages = plain.filter("cell = '*'")
    languages = languages.select("lang", *averaged(above))
    languages = languages.select("lang", *[F.col(c).alias(f"above_{c}") for c in above])
    groups = plain.filter(F.col("cell").startswith("=")).join(languages, "lang")
    groups = groups.select("lang", "cell", *averaged({c: F.col(f"above_{c}") for c in above}))
    return materialise(_factored(groups).select("lang", "cell", *_model_columns()), "mcd-leaning")


def _joined(rows: DataFrame, model: DataFrame, how: str = "inner") -> DataFrame:
    return rows.join(model.select("lang", "cell", *_model_columns()), ["lang", "cell"], how)


def _sums() -> list[Column]:
    """Exact sums of the features and of their products."""
    size = range(len(FEATURES))
    big = {f: F.col(f).cast("decimal(19,0)") for f in FEATURES}
    sums = [F.sum(big[f]).alias(f"s_{i}") for i, f in enumerate(FEATURES)]
    return sums + [
        F.sum((F.col(FEATURES[i]) * F.col(FEATURES[j])).cast("decimal(19,0)")).alias(f"q_{i}{j}")
        for i in size
        for j in range(i + 1)
    ]


def _consistency(limit: float) -> float:
    """What the covariance of a normal population cut at a squared distance is too small by."""
    return chi_square(limit, len(FEATURES)) / chi_square(limit, len(FEATURES) + 2)


def covariance_estimates(rows: DataFrame, steps: int = STEPS, subset: float = SUBSET) -> DataFrame:
    """Per (lang, cell) centre and triangular factor; ``rows`` holds integer features."""
    size = range(len(FEATURES))
    centre = materialise(_middle(rows, {f: F.col(f) for f in FEATURES}), "mcd-centre")
    away = {f: F.abs(F.col(f) - F.col(f"m_{f}") * SCALE) for f in FEATURES}
    spread = _middle(rows.join(centre, ["lang", "cell"]), away)
    spread = spread.select("lang", "cell", *[F.col(f"m_{f}").alias(f"d_{f}") for f in FEATURES])
    factor = [
        (F.greatest(1.4826 * F.col(f"d_{FEATURES[i]}"), F.lit(FLOORS[i])) if i == j else F.lit(0.0)).alias(f"l_{i}{j}")
        for i in size
        for j in range(i + 1)
    ]
    model = centre.join(spread, ["lang", "cell"]).select("lang", "cell", *[f"m_{f}" for f in FEATURES], *factor)
    correction = _consistency(chi_square_quantile(subset, len(FEATURES)))
    for step in range(steps):
        model = materialise(model, f"mcd-{step}")
        bucket = F.floor(F.log2(1 + _distance()) * FINE).cast("int").alias("bucket")
        parts = _joined(rows, model).select("lang", "cell", *FEATURES, bucket)
        parts = parts.groupBy("lang", "cell", "bucket").agg(F.count("*").alias("n"), *_sums())
        by = Window.partitionBy("lang", "cell")
        before = F.sum("n").over(by.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
        parts = parts.withColumns({"before": F.coalesce(before, F.lit(0)), "all": F.sum("n").over(by)})
        near = parts.filter(F.col("before") < F.ceil(F.col("all") * subset))
        names = ["n", *[f"s_{i}" for i in size], *[f"q_{i}{j}" for i in size for j in range(i + 1)]]
        moments = near.groupBy("lang", "cell").agg(*[F.sum(c).alias(c) for c in names])
        model = _with_factor(moments, correction)
    return materialise(model, "mcd-final")


def reweighted(rows: DataFrame, model: DataFrame, inside: float = INSIDE) -> DataFrame:
    """The estimate over all rows inside a quantile of the distance under ``model``.

    ``rows`` also holds what the features are counted over. No group is lost: the mean
    squared distance of its subset is at most the number of features, so rows of the subset
    lie inside.
    """
    limit = chi_square_quantile(inside, len(FEATURES))
    near = _resolved(_joined(rows, model)).filter(_distance() <= limit)
    moments = near.groupBy("lang", "cell").agg(F.count("*").alias("n"), *_sums())
    return materialise(_with_factor(moments, _consistency(limit)), "mcd-reweighted")


def quality_rules(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    prior_rows: float = PRIOR_ROWS,
    tail: float = TAIL,
) -> DataFrame:
    """Rows (doc_id, counts, base_failed, distance, kept) of every whole text.

    ``tail`` is the share of a normal population beyond the limit. ``distance`` is null
    where all of a group fail the base rules.
    """
    group = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]
    rows = text_statistics(df, key, text, *group).withColumn("base_failed", base_rules())
    rows = materialise(rows.select("*", *_features()), "quality")
    good = rows.filter(~F.col("base_failed"))
    own, any_ = F.concat(F.lit("="), F.col("source")), F.lit("*")
    levels = F.explode(
        F.array(
            F.struct("lang", own.alias("cell")),
            F.struct("lang", any_.alias("cell")),
            F.struct(F.lit("").alias("lang"), F.lit("**").alias("cell")),
        )
    )
    measured = good.select(levels.alias("level"), *FEATURES, *COUNTED.values())
    measured = measured.select("level.lang", "level.cell", *FEATURES, *COUNTED.values())
    model = leaning(reweighted(measured, covariance_estimates(measured)), prior_rows)
    limit = chi_square_quantile(1 - tail, len(FEATURES))
    judged = _resolved(_joined(rows.withColumn("cell", own), model, "left")).withColumn("distance", _distance())
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", kept.alias("kept"), "distance")
