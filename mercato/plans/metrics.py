"""How well scores and predictions fit their labels: exact AUC and a report per class (M5).

``exact_auc`` is the rank-sum form of the area under the ROC curve: rows are ranked
by score over all executors (``global_rank``, so a hot score is spread over many
buckets), equal scores share the mean of their ranks, and only whole numbers are
summed until the last division.  No curve is thinned out to bins.

``class_report`` starts from counts per (label, prediction), so what is left after
one partial aggregation is bounded by the number of classes.

Defined results: rows with a null label, a null or NaN score or a null prediction
take no part; with one class only, or without rows, the AUC is null; a class that is
never predicted has precision 0, one without rows recall 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.operators.ranking import global_rank

_WHOLE = "decimal(38,0)"


def exact_auc(scored: DataFrame, score: str, label: str, key: str, **kw) -> DataFrame:
    """One row: auc, positives (label 1) and negatives (other labels).

    ``key`` is unique and only orders rows of equal scores; ``kw`` goes to ``global_rank``.
    """
    rows = scored.select(F.col(score).cast("double").alias("_s"), (F.col(label) == 1).cast("long").alias("_p"), F.col(key).alias("_key")) \
        .where(F.col("_s").isNotNull() & ~F.isnan("_s") & F.col("_p").isNotNull())
    ranked, _ = global_rank(rows, [("_s", True), ("_key", True)], "_r", **kw)
    ties = ranked.groupBy("_s").agg((F.min("_r") + F.max("_r")).cast(_WHOLE).alias("twice_rank"), F.sum("_p").alias("p"),
                                    F.sum(1 - F.col("_p")).alias("n"))
    # a rank of 19 digits times a count of 19
    total = ties.agg(F.sum((F.col("p").cast("decimal(19,0)") * F.col("twice_rank").cast("decimal(19,0)")).cast(_WHOLE)).alias("ranks"),
                     F.coalesce(F.sum("p"), F.lit(0)).alias("positives"), F.coalesce(F.sum("n"), F.lit(0)).alias("negatives"))
    p, n = (F.col(c).cast("decimal(18,0)") for c in ("positives", "negatives"))
    above = (F.col("ranks") - p * (p + 1)).cast("double")
    return total.select((above / F.nullif((2 * p * n).cast("double"), F.lit(0.0))).alias("auc"), "positives", "negatives")


def class_report(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """kind, class, precision, recall, f1 and support of every class (kind ``class``) and of all
    (kind ``all``: accuracy, in the column f1; macro avg; weighted avg)."""
    kind = scored.schema[label].dataType
    cells = scored.select(F.col(label).alias("l"), F.col(prediction).cast(kind).alias("p")) \
        .where(F.col("l").isNotNull() & F.col("p").isNotNull()).groupBy("l", "p").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(0).cast("long")
    both = F.array(F.struct(F.col("l").alias("class"), F.col("n").alias("support"), none.alias("predicted"),
                            F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(none).alias("hit")),
                   F.struct(F.col("p").alias("class"), none.alias("support"), F.col("n").alias("predicted"), none.alias("hit")))
    per = cells.select(F.explode(both).alias("x")).select("x.*").groupBy("class") \
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hit")])

    def share(of, whole):
        return F.coalesce(of / F.nullif(whole, none), F.lit(0.0))

    per = per.select(F.col("class").cast("string").alias("class"), share(F.col("hit"), F.col("predicted")).alias("precision"),
                     share(F.col("hit"), F.col("support")).alias("recall"),
                     share(2 * F.col("hit"), F.col("support") + F.col("predicted")).alias("f1"), "support", "hit")
    # one row per class: added up in the order of their names
    whole = per.agg(F.array_sort(F.collect_list(F.struct("class", "precision", "recall", "f1", "support"))).alias("c"),
                    F.coalesce(F.sum("support"), none).alias("support"), F.sum("hit").alias("hit"))

    def mean(name: str, weighted: bool):
        total = F.aggregate("c", F.lit(0.0), lambda s, x: s + (x[name] * x["support"] if weighted else x[name]))
        return (total / F.nullif(F.col("support") if weighted else F.size("c"), F.lit(0))).alias(name)

    null = F.lit(None).cast("double")
    rows = [whole.select(F.lit("accuracy").alias("class"), null.alias("precision"), null.alias("recall"),
                         (F.col("hit") / F.nullif(F.col("support"), none)).alias("f1"), "support")]
    rows += [whole.select(F.lit(name).alias("class"), *[mean(c, weighted) for c in ("precision", "recall", "f1")], "support")
             for name, weighted in (("macro avg", False), ("weighted avg", True))]
    out = per.drop("hit").withColumn("kind", F.lit("class"))
    for r in rows:
        out = out.unionByName(r.withColumn("kind", F.lit("all")))
    return out.select("kind", "class", "precision", "recall", "f1", "support")
