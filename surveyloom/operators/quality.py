"""Quality control, trends and process figures."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.operators.ranking import ranked, shuffle_order


def qa_sample(
    surveys: DataFrame, per_day: int, seed: str = "qa", day: str = "day", id_col: str = "survey_id"
) -> DataFrame:
    """`per_day` random surveys of each day, the same ones on every run with one seed.

    The rank test right after the window lets Spark keep the first `per_day` rows of each
    day in every task before it shuffles.
    """
    order = Window.partitionBy(day).orderBy("_order", id_col)
    drawn = surveys.withColumn("_order", shuffle_order(id_col, seed))
    return (
        drawn.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_day).drop("_order", "_n")
    )


def qa_sample_share(
    surveys: DataFrame,
    share: float,
    seed: str = "qa",
    strata: Sequence[str] = ("day", "route"),
    id_col: str = "survey_id",
) -> DataFrame:
    """The same share, rounded up, of each stratum, drawn reproducibly."""
    quota = surveys.groupBy(*[F.col(s).alias(f"_{s}") for s in strata]).agg(
        F.ceil(F.count("*") * share).alias("_quota")
    )
    numbered = ranked(surveys, list(strata), id_col, seed)
    same = reduce(lambda a, b: a & b, [numbered[s].eqNullSafe(quota[f"_{s}"]) for s in strata])
    drawn = numbered.join(quota, same).filter(F.col("rank") <= F.col("_quota"))
    return drawn.select(*surveys.columns)


def qa_sample_fixed(
    surveys: DataFrame,
    per_day: int,
    seed: str = "qa",
    strata: Sequence[str] = ("route", "category", "lang"),
    routes: Sequence[str] = ("auto_ticket", "archive"),
    day: str = "day",
    id_col: str = "survey_id",
) -> DataFrame:
    """Exactly `per_day` surveys of each day (all, if fewer) out of those that no human has seen, each stratum by its share.

    A stratum gets the whole part of its share; the places left go to the largest remainders, ties in the order of the
    strata. Within a stratum the draw is random, and the same on every run with one seed.
    """
    seen = surveys.filter(F.col("route").isin(*routes))
    keys = [day, *strata]
    of_day = Window.partitionBy(f"_{day}")
    counts = seen.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count("*").alias("_n"))
    whole = counts.withColumn("_all", F.sum("_n").over(of_day)).withColumn("_drawn", F.least(F.col("_all"), F.lit(per_day)) * F.col("_n"))
    parts = whole.withColumns({"_quota": F.expr("_drawn div _all"), "_rest": F.col("_drawn") % F.col("_all")})
    place = F.row_number().over(of_day.orderBy(F.desc("_rest"), *[f"_{k}" for k in strata]))
    open_ = F.least(F.col("_all"), F.lit(per_day)) - F.sum("_quota").over(of_day)
    quota = parts.withColumn("_quota", F.col("_quota") + (place <= open_).cast("long")).select(*[f"_{k}" for k in keys], "_quota")
    numbered = ranked(seen, keys, id_col, seed)
    same = reduce(lambda a, b: a & b, [numbered[k].eqNullSafe(quota[f"_{k}"]) for k in keys])
    return numbered.join(quota, same).filter(F.col("rank") <= F.col("_quota")).select(*surveys.columns)


def error_rate(reviews: DataFrame, *by: str, wrong: str = "is_wrong") -> DataFrame:
    """Reviewed rows, errors and their share, overall or by columns."""
    test = F.col(wrong).cast("int")
    return reviews.groupBy(*by).agg(
        F.count(test).alias("reviewed"),
        F.sum(test).alias("errors"),
        F.round(F.avg(test), 6).alias("error_rate"),
    )


def threshold_curve(
    labelled: DataFrame, thresholds: Sequence[float], confidence: str = "confidence", correct: str = "is_correct"
) -> DataFrame:
    """Coverage and precision if only rows at or above a confidence were automated.

    One pass: two conditional sums per threshold, then one row each.
    """
    above = lambda t: F.col(confidence) >= t
    right = F.col(correct).cast("boolean")
    sums = [F.count("*").alias("_rows")]
    for i, t in enumerate(thresholds):
        sums.append(F.count_if(above(t)).alias(f"_n{i}"))
        sums.append(F.count_if(above(t) & right).alias(f"_ok{i}"))
    lines = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("threshold"),
                F.col(f"_n{i}").alias("automated"),
                F.col(f"_ok{i}").alias("correct"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    rows = labelled.agg(*sums).select("_rows", F.explode(lines).alias("l")).select("_rows", "l.*")
    ratio = lambda a, b: F.round(F.col(a) / F.nullif(F.col(b), F.lit(0)), 6)
    return rows.withColumns(
        {"coverage": ratio("automated", "_rows"), "precision": ratio("correct", "automated")}
    ).drop("_rows")


def category_trend(rows: DataFrame, ts: str = "ts", category: str = "category") -> DataFrame:
    """Per day and category: count, share of the day, change to the category's day before.

    The windows run over the daily counts, not over the rows.
    """
    daily = rows.groupBy(F.to_date(ts).alias("day"), F.col(category).alias("category")).agg(
        F.count("*").alias("n")
    )
    total = F.sum("n").over(Window.partitionBy("day"))
    before = F.lag("n").over(Window.partitionBy("category").orderBy("day"))
    return daily.withColumns({"share": F.round(F.col("n") / total, 6), "change": F.col("n") - before})


def routed_trend(routed: DataFrame, day: str = "first_day") -> DataFrame:
    """Clusters and surveys per day, rules version and route."""
    return routed.groupBy(F.col(day).alias("day"), "rules_version", "route").agg(
        F.count("*").alias("clusters"), F.sum("volume").alias("surveys")
    )


def window_volume(rows: DataFrame, ts: str = "ts", width: str = "1 hour") -> DataFrame:
    """Rows and mean value per tumbling window and category; for batch and stream alike."""
    return (
        rows.groupBy(F.window(ts, width).alias("_w"), "category")
        .agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
        .select(F.col("_w.start").alias("window_start"), "category", "n", "total")
    )


def metrics(df: DataFrame, values: dict[tuple[str, str], Column]) -> DataFrame:
    """One row (family, metric, value) per named aggregate, out of one pass."""
    sums = [F.round(v, 6).cast("double").alias(f"_{i}") for i, v in enumerate(values.values())]
    rows = [
        F.struct(F.lit(family).alias("family"), F.lit(name).alias("metric"), F.col(f"_{i}").alias("value"))
        for i, (family, name) in enumerate(values)
    ]
    return df.agg(*sums).select(F.explode(F.array(*rows)).alias("m")).select("m.*")


def process_kpis(
    decided: DataFrame,
    reviews: DataFrame,
    tickets: DataFrame,
    cases: DataFrame,
    critical_bands: Sequence[str] = ("high",),
) -> DataFrame:
    """The process figures as rows (family, metric, value).

    `decided` are clusters as `apply_decisions` leaves them; `reviews` the quality sample;
    `tickets` have `status`; `cases` come from `sla_state`, and `critical_bands` are the
    bands of its rules that count as critical. The correction rate counts clusters that any
    decision corrected, whatever came after.
    """
    c = F.col
    share = lambda part, whole: F.sum(part) / F.nullif(F.sum(whole), F.lit(0))
    one = lambda test: F.when(test, 1).otherwise(0)
    by_hand = share(F.when(c("route") == "review", c("volume")).otherwise(0), c("volume"))
    seconds = c("decided_at").cast("timestamp").cast("double") - c("first_day").cast("timestamp").cast("double")
    critical = c("band").isin(*critical_bands)
    parts = [
        metrics(
            decided,
            {
                ("efficiency", "share to handle"): by_hand,
                ("efficiency", "share without a human"): 1 - by_hand,
                ("efficiency", "hours from cluster to ticket"): F.avg(
                    F.when(c("outcome") == "ticket", seconds / 3600)
                ),
                ("quality", "correction rate"): share(
                    one(c("corrected")), one(c("action").isNotNull())
                ),
            },
        ),
        metrics(reviews, {("quality", "sampled error rate"): F.avg(c("is_wrong").cast("int"))}),
        metrics(tickets, {("quality", "share of tickets worked"): F.avg(one(c("status") == "worked"))}),
        metrics(
            cases,
            {("coverage", "critical within deadline"): share(one(critical & ~c("breached")), one(critical))},
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def management_summary(rows: DataFrame, ts: str = "ts", category: str = "category") -> DataFrame:
    """Per month and category: count, share of the month, rank in the month."""
    monthly = rows.groupBy(
        F.trunc(F.to_date(ts), "month").alias("month"), F.col(category).alias("category")
    ).agg(F.count("*").alias("n"))
    month = Window.partitionBy("month")
    return monthly.withColumns(
        {
            "share": F.round(F.col("n") / F.sum("n").over(month), 6),
            "place": F.row_number().over(month.orderBy(F.desc("n"), "category")),
        }
    )
