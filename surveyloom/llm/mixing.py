"""Mixing of sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key, divided by its quality weight; in key order, the documents of a source form a
weighted sample without replacement. A source whose target exceeds its size is taken whole as often as it fits;
the rest of the target is the beginning of the key order. A task that sees a document needs only its source's
row: how many whole epochs, and the last key that the rest includes. So texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.chunks import written
from surveyloom.llm.extras import carried
from surveyloom.llm.prefix import running

WORD = r"[^\x20\x09-\x0D]+"
MARKS = "|#*%&$!<>{}[]^~=_\\"
WEIGHTS = (5, 2, 1)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def quality_weight(text: Column) -> Column:
    """From 0.01 to 1: the square of the share of characters that aren't marks. Empty texts weigh 0.01."""
    share = F.try_divide(F.length(F.translate(text, MARKS, "")), F.length(text))
    return F.greatest(F.lit(0.01), F.coalesce(share * share, F.lit(0.0)))


def sampling_key(doc_id: Column, weight: Column, seed: str) -> Column:
    """-ln(u) / weight, with u in (0, 1) from a digest of the id, so that reruns agree."""
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 12), 16, 10)
    return -F.log((digits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))) / weight


def given_weight(name: str) -> Column:
    """A column of weights, for example a classifier's scores: from 0.01 up; 0.01 for null, NaN and what is less."""
    given = F.col(f"`{name.replace('`', '``')}`").cast("double")
    return F.greatest(F.lit(0.01), F.when(F.isnan(given), 0.01).otherwise(F.coalesce(given, F.lit(0.01))))


def _key(seed: str, weight: str | None) -> Column:
    weights = quality_weight(F.col("text")) if weight is None else given_weight(weight)
    return sampling_key(F.col("doc_id"), weights, seed).alias("_key")


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """`sizes` (source, source_size) with each source's target.

    Sources by code point, null last, take the weights in turn. All share `share` times the total by weight; a target
    stops at `most` times its source's size, and the excess goes to the others. In the order of
    most * size / weight the sources that stop come first, so two running sums tell them.
    """
    if share > most:
        raise ValueError("the targets can't sum to more than `most` times the sources")
    ranked = running(sizes.withColumn("_one", F.lit(1).cast("long")), [F.col("source").asc_nulls_last()], {"_rank": "_one"}, label="sources")
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = ranked.select("source", "source_size", weight.alias("_weight"), (F.col("source_size") * most).alias("_cap"))
    total = ranked.agg(F.sum("source_size").alias("_total"), F.sum("_weight").alias("_weights"))
    filled = running(
        ranked, [(F.col("_cap") / F.col("_weight")).asc(), F.col("source").asc_nulls_last()], {"_caps": "_cap", "_before": "_weight"}, label="caps"
    ).crossJoin(F.broadcast(total))  # one row
    left = F.col("_total") * F.lit(share) - F.col("_caps")
    stops = left * F.col("_weight") >= F.col("_cap") * (F.col("_weights") - F.col("_before"))
    filled = written(filled.withColumn("_stops", stops), "targets")
    level = filled.agg(
        (
            (F.max("_total") * F.lit(share) - F.coalesce(F.sum(F.when(F.col("_stops"), F.col("_cap"))), F.lit(0)))
            / F.sum(F.when(~F.col("_stops"), F.col("_weight")))
        ).alias("_level")
    )
    target = F.when(F.col("_stops"), F.col("_cap").cast("double")).otherwise(F.col("_level") * F.col("_weight"))
    return filled.crossJoin(F.broadcast(level)).select("source", "source_size", target.alias("target"))  # one row


def plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: int = 2, seed: str = "mix", weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The documents' sizes and keys (doc_id, source, _size, _key), and the sources' plan. Sizes and keys are written first, so that
    the sampling of ranges doesn't read texts again.

    The plan has source, source_size, target, epochs and `cut`, the last (key, doc_id) that the rest of the target
    includes: the document at its end is in if at least half of it fits. Null if there is none.
    """
    slim = written(docs.select("doc_id", "source", n_words(F.col("text")).alias("_size"), _key(seed, weight)), "keys")
    slim = running(slim, [F.col("source").asc_nulls_last(), F.col("_key").asc(), F.col("doc_id").asc_nulls_last()], {"_before": "_size"}, "source", "mix")
    slim = written(slim, "mixed")
    sizes = slim.groupBy("source").agg(F.sum("_size").alias("source_size"))
    aims = targets(sizes, weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    aims = written(aims.withColumn("epochs", epochs).withColumn("_rest", F.col("target") - F.col("epochs") * F.col("source_size")), "aims")
    near = slim.join(aims.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    near = near.where((F.col("_before") + F.col("_size") / 2 <= F.col("_rest")) & (F.col("_rest") > 0))
    cuts = near.groupBy("_source").agg(F.max(F.struct("_key", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"))).alias("cut"))
    cuts = cuts.select(F.col("_source").alias("_cut_source"), "cut")
    out = aims.join(cuts, F.col("source").eqNullSafe(F.col("_cut_source")), "left").select("source", "source_size", "target", "epochs", "cut")
    return slim, written(out, "plan")


def _times(aims_source: str) -> Column:
    own = F.struct(F.col("_key"), F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("id"))
    return F.col("epochs") + F.when(own <= F.col("cut"), 1).otherwise(0)


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, taken (words, repeats counted) and times.

    Takes doc_id, text and source; other columns are ignored. Size is the number of words; a null text has none. A null
    source is a source of its own, the last; a null doc_id sorts last. Empty texts take no words. Rows that repeat a
    doc_id in one source with one weight are taken or left together. `weight` names a column of quality weights (see
    `given_weight`); without it, the text's own share of characters that aren't marks decides.
    """
    slim, aims = plan(docs, **options)
    joined = slim.join(aims.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    return joined.select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target", (_times("_source") * F.col("_size")).cast("long").alias("taken"), _times("_source").alias("times")
    )


def mix(docs: DataFrame, seed: str = "mix", weight: str | None = None, **options) -> DataFrame:
    """The mixed documents, each as often as it is taken, with the columns of `docs`, whatever their names."""
    _, aims = plan(docs, seed=seed, weight=weight, **options)
    aims = aims.withColumnRenamed("source", "_source")

    def repeated(slim: DataFrame) -> DataFrame:
        joined = slim.select("*", _key(seed, weight)).join(aims, F.col("source").eqNullSafe(F.col("_source")))
        return joined.withColumn("_times", _times("_source")).where("_times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))

    return carried(docs, ("doc_id", "text", "source", weight), repeated)
