"""Quality rules: exact base rules, then robust multivariate outliers per language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtide.llm.common import stored, words

SHARE = 0.5         # part of a group's rows that the covariance is fitted on: any minority of outliers is withstood
STEPS = 8           # concentration steps; the determinant falls with each, and later ones move a mean by under a thousandth
MIN_ROWS = 200      # smaller groups take the estimate over all rows
CUT = 150.0         # squared distance from which a document is rejected
UNIT = 1000         # statistics are whole thousandths, so sums are exact and reruns agree
FLOOR = (40, 60, 40, 60)  # least standard deviation of each statistic, in thousandths
# Makes the covariance of the inner half of a normal cloud in four dimensions that of the whole:
# 0.5 / P(chi2(6) <= q) with q the 0.5 quantile of chi2(4).
CONSISTENCY = 2.109
STATS = ("_f0", "_f1", "_f2", "_f3")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_columns(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed; a null text has none of each.

    All of it stays inside the row: 3-word windows are hashed with their places and sorted, equal neighbours
    are the windows that repeat, and a window covers up to three words not covered by the one before.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumn("_words", words(F.col(text)))
    lines = F.filter(F.split(body, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("_lines", lines).withColumn("n_words", F.size("_words").cast("long"))
    window = F.transform(
        F.slice("_words", F.lit(1), F.greatest(F.col("n_words") - 2, F.lit(0)).cast("int")),
        lambda w, i: F.struct(F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("i")),
    )
    rows = rows.withColumn("_windows", window)
    some = F.size(F.array_distinct("_windows.h")) < F.size("_windows")
    rows = rows.withColumn("_sorted", F.when(some, F.sort_array("_windows")))
    rest = F.slice("_sorted", F.lit(2), F.size("_sorted"))
    # Of each pair of neighbours in the sorted list: do they agree?
    same = F.zip_with(F.slice("_sorted", F.lit(1), F.size("_sorted") - 1), rest, lambda a, b: a["h"] == b["h"])
    rows = rows.withColumn("_same", same)
    flagged = F.zip_with(
        F.zip_with("_sorted", "_same", lambda s, n: F.struct(s["i"].alias("i"), F.coalesce(n, F.lit(False)).alias("n"))),
        F.concat(F.array(F.lit(False)), F.col("_same")),
        lambda s, p: F.when(s["n"] | p, s["i"]),
    )
    rows = rows.withColumn("_starts", F.sort_array(F.array_compact(flagged)))
    gaps = F.zip_with("_starts", F.slice("_starts", F.lit(2), F.greatest(F.size("_starts"), F.lit(1))),
                      lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
    repeated = F.coalesce(F.aggregate(gaps, F.lit(0), lambda s, g: s + g), F.lit(0)).cast("long")
    rows = rows.withColumns({
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.coalesce(F.regexp_count(F.col(text), F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": repeated, "_n_lines": F.size("_lines").cast("long"),
    })
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).drop("_words", "_lines", "_windows", "_sorted", "_same", "_starts")


def statistics() -> dict[str, Column]:
    """Transformed statistics as whole thousandths: log of the mean word length, log of symbols per word,
    share of repeated lines, share of repeated words."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    raw = (
        F.log1p(F.col("word_chars") / n), F.log1p(10 * F.col("n_symbols") / n),
        F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1)), F.col("n_repeat_words") / n,
    )
    return {name: F.round(value * UNIT).cast("long") for name, value in zip(STATS, raw)}


def _distance(at: str = "") -> Column:
    """Squared Mahalanobis distance through the triangular factor of the covariance."""
    z: list[Column] = []
    for i, name in enumerate(STATS):
        rest = F.col(name) - F.col(f"{at}m{i}")
        for j in range(i):
            rest = rest - F.col(f"{at}l{i}{j}") * z[j]
        z.append(rest / F.col(f"{at}l{i}{i}"))
    return z[0] * z[0] + z[1] * z[1] + z[2] * z[2] + z[3] * z[3]


def _moments(rows: DataFrame, by: list[str], factor: float) -> DataFrame:
    """Mean and triangular factor (m0.., l00..) of each group, one pass of exact sums."""
    exact = lambda c: F.sum(c.cast("decimal(28,0)")).cast("double")
    sums = [F.count(F.lit(1)).alias("n")] + [exact(F.col(s)).alias(f"s{i}") for i, s in enumerate(STATS)]
    sums += [exact(F.col(STATS[i]) * F.col(STATS[j])).alias(f"q{i}{j}") for i in range(4) for j in range(i + 1)]
    est = rows.groupBy(*by).agg(*sums)
    n = F.col("n")
    est = est.withColumns({f"m{i}": F.col(f"s{i}") / n for i in range(4)})
    cov = {(i, j): (F.col(f"q{i}{j}") / n - F.col(f"m{i}") * F.col(f"m{j}")) * factor for i in range(4) for j in range(i + 1)}
    for i in range(4):
        for j in range(i + 1):
            value = cov[i, j] + (float(FLOOR[i] ** 2) if i == j else 0.0)
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            est = est.withColumn(f"l{i}{j}", F.sqrt(F.greatest(value, F.lit(1.0))) if i == j else value / F.col(f"l{j}{j}"))
    return est.select(*by, *[f"m{i}" for i in range(4)], *[f"l{i}{j}" for i in range(4) for j in range(i + 1)])


def estimates(rows: DataFrame, by: list[str], share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """Minimum-covariance-determinant mean and factor of each group of ``by``.

    Starts at the medians and concentrates: the ``share`` of rows nearest by distance gives the next mean and
    covariance. Distances are compared by a fine logarithmic scale, whose quantile is exact and needs a
    bounded table per group, so a group of any size is only ever aggregated.
    """
    start = [F.percentile(s, F.lit(0.5)).alias(f"m{i}") for i, s in enumerate(STATS)]
    spread = rows.groupBy(*by).agg(*start)
    est = spread.select("*", *[F.lit(float(2 * FLOOR[i]) if i == j else 0.0).alias(f"l{i}{j}") for i in range(4) for j in range(i + 1)])
    for step in range(steps):
        est = stored(est, "mcd")
        at = rows.join(est, by).withColumn("_rank", F.floor(F.log1p(_distance()) * 64))
        at = at.select(*by, *STATS, "_rank")
        cut = at.groupBy(*by).agg(F.percentile("_rank", F.lit(share)).alias("_cut"))
        inner = at.join(cut, by).where("_rank <= _cut")
        est = _moments(inner, by, CONSISTENCY)
    return est


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", keys: tuple = ("doc_id",),
                  cut: float = CUT) -> DataFrame:
    """(keys, base columns, base_failed, distance, kept) for every row.

    Rows that fail the base rules take no part in the estimates and are not kept. The others are kept unless their
    squared robust distance in their (language, source) group is over ``cut``. A group of under MIN_ROWS such rows
    takes the estimate over all of them. Null language or source is a group of its own; null and empty texts
    have no words and fail; repeated rows count each; an empty table gives no rows. A statistic that hardly varies
    has the standard deviation FLOOR, so a covariance is never singular.
    """
    group = F.concat_ws("/", *[F.coalesce(F.concat(F.length(c), F.lit("="), F.col(c)), F.lit("none")) for c in (lang, source)])
    rows = base_columns(docs, text).withColumns(statistics())
    rows = stored(rows.select(*keys, *BASE, "base_failed", *STATS, group.alias("_group")), "quality")
    good = rows.where(~F.col("base_failed"))
    sizes = good.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"))
    large = stored(sizes.select("_group", F.when(F.col("_n") >= MIN_ROWS, F.col("_group")).otherwise("").alias("_fit")), "mcd-groups")
    own = good.join(large.where("_fit <> ''"), "_group").select(F.col("_group").alias("_fit"), *STATS)
    est = estimates(own.unionByName(good.select(F.lit("").alias("_fit"), *STATS)), ["_fit"])
    est = stored(est, "mcd")
    scored = rows.join(large, "_group", "left").join(est, "_fit", "left").withColumn("distance", _distance())
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cut, F.lit(True))
    return scored.select(*keys, *BASE, "base_failed", kept.alias("kept"), "distance")
