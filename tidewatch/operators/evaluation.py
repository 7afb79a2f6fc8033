"""Judging scores against labels: thresholds, metrics, folds, ensembles, review budgets.

Input frames hold ``score`` and ``label`` (and ``log_id`` where rows are ranked), with further
grouping columns ``by``. Scores are reduced to counts before anything is ordered, and candidate
thresholds are compared by the number of thresholds a score reaches, so a grid of thresholds costs
one pass and no row is repeated per threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import ratio
from tidewatch.operators.order_stats import cut_scalar, fraction_cell, id_cell, quantiles, rank_cuts, ranked_counts

# Fixed values.
THRESHOLD_QUANTILES = [0.80, 0.84, 0.88, 0.90, 0.92, 0.94, 0.95, 0.96, 0.97, 0.98, 0.99]
LINEAR_THRESHOLDS = 25
ENSEMBLE_ALPHAS = [0.6, 0.7, 0.8, 0.9]
ENSEMBLE_THRESHOLDS = [0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70, 0.75]
REVIEW_BUDGETS = [0.01, 0.02, 0.05, 0.10]
MIN_RELIABLE_ANOMALIES = 20


def normalise_scores(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(score - min) / (max - min + 1e-9), over all rows or per group."""
    ends = scores.groupBy(*by).agg(F.min("score").alias("_low"), F.max("score").alias("_high"))
    if by:
        rows = scores.join(ends, list(by))
    else:
        rows = scores.withColumn("_ends", ends.select(F.struct("_low", "_high")).scalar()).select("*", "_ends.*").drop("_ends")
    scaled = (F.col("score") - F.col("_low")) / (F.col("_high") - F.col("_low") + 1e-9)
    return rows.withColumn("score", scaled).drop("_low", "_high")


def threshold_candidates(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., thresholds): the score quantiles and 25 even steps from minimum to maximum, ascending."""
    found = quantiles(scores, "score", THRESHOLD_QUANTILES, by=by, cell=fraction_cell)
    listed = found.groupBy(*by).agg(F.collect_list("quantile").alias("_q"))
    steps = LINEAR_THRESHOLDS - 1
    ends = scores.groupBy(*by).agg(F.min("score").alias("_low"), F.max("score").alias("_high"))
    even = F.transform(
        F.sequence(F.lit(0), F.lit(steps)),
        lambda i: F.when(i == steps, F.col("_high")).otherwise(
            F.col("_low") + i * ((F.col("_high") - F.col("_low")) / steps)
        ),
    )
    if by:
        both = listed.join(ends, list(by))
    else:
        both = ends.withColumn("_q", listed.scalar())
    return both.select(*by, F.array_sort(F.concat("_q", even)).alias("thresholds"))


def fixed_thresholds(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in sorted(values)])


def rates(hits: Column, predicted: Column, positives: Column) -> dict[str, Column]:
    """precision, recall and F1, each 0 where undefined."""
    return {
        "precision": ratio(hits, predicted),
        "recall": ratio(hits, positives),
        "f1_score": ratio(2 * hits, predicted + positives),
    }


def threshold_metrics(scores: DataFrame, thresholds: DataFrame | Column, by: Sequence[str] = ()) -> DataFrame:
    """(by..., threshold, precision, recall, f1_score, predicted, hits) for every candidate.

    ``thresholds`` is a short ascending array: one for all groups (a column) or one per group.
    """
    if isinstance(thresholds, Column):
        rows = scores.withColumn("thresholds", thresholds)
    elif by:
        rows = scores.join(thresholds, list(by))
    else:
        rows = scores.withColumn("thresholds", thresholds.select("thresholds").scalar())
    reached = F.size(F.filter("thresholds", lambda t: t <= F.col("score")))
    counts = rows.groupBy(*by, "thresholds", reached.alias("reached")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("positive")
    )
    # At most one more row per group than there are thresholds.
    grouped = counts.groupBy(*by, "thresholds").agg(
        F.collect_list(F.struct("reached", "n", "positive")).alias("steps"), F.sum("positive").alias("positives")
    )

    def total(field: str, position: Column) -> Column:
        return F.aggregate(
            F.filter("steps", lambda s: s["reached"] > position),
            F.lit(0).cast("bigint"),
            lambda total, s: total + s[field],
        )

    hits, predicted = total("positive", F.col("position")), total("n", F.col("position"))
    return (
        grouped.select(*by, "steps", "positives", F.posexplode("thresholds").alias("position", "threshold"))
        .withColumns({"hits": hits, "predicted": predicted})
        .withColumns(rates(F.col("hits"), F.col("predicted"), F.col("positives")))
        .select(*by, "threshold", "precision", "recall", "f1_score", "predicted", "hits")
    )


def best_threshold(scores: DataFrame, thresholds: DataFrame | Column, by: Sequence[str] = ()) -> DataFrame:
    """The candidate with the best (F1, precision, recall), the lowest one among equals."""
    metrics = threshold_metrics(scores, thresholds, by)
    order = F.struct("f1_score", "precision", "recall", (-F.col("threshold")).alias("low"))
    kept = F.struct("threshold", "precision", "recall", "f1_score")
    return metrics.groupBy(*by).agg(F.max_by(kept, order).alias("best")).select(*by, "best.*")


def roc_auc(scores: DataFrame, by: Sequence[str] = (), cell=fraction_cell) -> DataFrame:
    """(by..., roc_auc): share of (positive, negative) pairs in the right order, ties half; 0.5 if undefined."""
    counts = scores.groupBy(*by, F.col("score").alias("value")).agg(
        F.sum(1 - F.col("label")).alias("n"), F.sum("label").alias("positive")
    )
    ranked = ranked_counts(counts, cell(F.col("value")), by)
    right = F.sum(F.col("positive") * (F.col("before") + F.col("n") / 2.0))
    pairs = F.sum("positive").cast("double") * F.sum("n")
    return ranked.groupBy(*by).agg(F.coalesce(F.try_divide(right, pairs), F.lit(0.5)).alias("roc_auc"))


def evaluate(scores: DataFrame, threshold: Column, by: Sequence[str] = (), cell=fraction_cell) -> DataFrame:
    """Confusion counts and metrics at a threshold (a literal, a scalar or a column of ``scores``)."""
    hit = (F.col("score") >= threshold).cast("int")
    label = F.col("label")
    counts = scores.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(label).alias("positives"),
        F.sum(hit).alias("predicted_positives"),
        F.sum(hit * label).alias("tp"),
    )
    auc = roc_auc(scores, by, cell)
    joined = counts.join(auc, list(by)) if by else counts.withColumn("roc_auc", auc.scalar())
    tp, predicted, positives = F.col("tp"), F.col("predicted_positives"), F.col("positives")
    return (
        joined.withColumns({"fp": predicted - tp, "fn": positives - tp})
        .withColumn("tn", F.col("rows") - tp - F.col("fp") - F.col("fn"))
        .withColumns({**rates(tp, predicted, positives), "accuracy": ratio(tp + F.col("tn"), F.col("rows"))})
        .select(*by, "precision", "recall", "f1_score", "roc_auc", "accuracy", "positives", "predicted_positives", "tn", "fp", "fn", "tp")
    )


def fold_results(scores: DataFrame, thresholds: Column | None = None) -> DataFrame:
    """Per (config, fold): the threshold chosen on validation, and the metrics of both parts at it.

    ``scores`` holds config, fold, split ('validation' or 'test'), score, label. Without a fixed grid
    the candidates are taken from the validation scores themselves.
    """
    by = ["config", "fold"]
    validation = scores.filter(F.col("split") == "validation")
    grid = threshold_candidates(validation, by) if thresholds is None else thresholds
    chosen = best_threshold(validation, grid, by).select(*by, "threshold")
    hit = (F.col("score") >= F.col("threshold")).cast("int")
    counted = (
        scores.filter(F.col("split").isin("validation", "test"))
        .join(chosen, by)
        .groupBy(*by, "threshold", "split")
        .agg(F.sum("label").alias("positives"), F.sum(hit).alias("predicted"), F.sum(hit * F.col("label")).alias("hits"))
        .withColumns(rates(F.col("hits"), F.col("predicted"), F.col("positives")))
    )
    return counted.groupBy(*by, "threshold").agg(*[
        F.max(F.when(F.col("split") == part, F.col(metric))).alias(f"{part}_{short}")
        for part in ("validation", "test")
        for metric, short in (("f1_score", "f1"), ("precision", "precision"), ("recall", "recall"))
    ])


# The metrics a configuration is chosen by, first to last.
ISOLATION_ORDER = ["validation_f1", "test_f1", "validation_precision", "validation_recall"]
FOREST_ORDER = ["validation_f1", "validation_precision", "validation_recall", "test_f1"]
ENSEMBLE_ORDER = ISOLATION_ORDER
NOVELTY_ORDER = ["validation_f1", "test_f1", "test_precision", "test_recall"]
NOVELTY_ORDER_BY_TEST = ["test_f1", "validation_f1", "test_precision", "test_recall"]


def config_averages(results: DataFrame) -> DataFrame:
    metrics = [c for c in results.columns if c not in ("config", "fold")]
    return results.groupBy("config").agg(*[F.avg(m).alias(m) for m in metrics])


def best_config(results: DataFrame, order: Sequence[str]) -> DataFrame:
    """The configuration with the best average metrics over its folds (name order among equals)."""
    return config_averages(results).orderBy(*[F.desc(F.round(m, 12)) for m in order], "config").limit(1)


def ensemble_scores(forest: DataFrame, isolation: DataFrame, alphas: Sequence[float] = tuple(ENSEMBLE_ALPHAS)) -> DataFrame:
    """Weighted scores for every weight: alpha * forest + (1 - alpha) * isolation (min-max per fold and part).

    Both frames hold fold, split, log_id, label, score; ``config`` of the result names the weight.
    """
    scaled = normalise_scores(isolation, ["fold", "split"]).select(
        "fold", "split", "log_id", F.col("score").alias("_isolation")
    )
    weights = F.explode(F.array(*[F.lit(float(a)) for a in alphas]))
    return (
        forest.join(scaled, ["fold", "split", "log_id"])
        .withColumn("alpha", weights)
        .withColumn("score", F.col("alpha") * F.col("score") + (1 - F.col("alpha")) * F.col("_isolation"))
        .withColumn("config", F.format_string("alpha_%.2f", "alpha"))
        .drop("_isolation")
    )


def select_ensemble(forest: DataFrame, isolation: DataFrame) -> DataFrame:
    results = fold_results(ensemble_scores(forest, isolation), fixed_thresholds(ENSEMBLE_THRESHOLDS))
    return best_config(results, ENSEMBLE_ORDER)


def review_budget(scores: DataFrame, budgets: Sequence[float] = tuple(REVIEW_BUDGETS)) -> DataFrame:
    """Hits among the highest scores when only a share of all rows can be reviewed.

    Ties are taken by ascending log_id. The last row of each budget is looked up, then every row
    only compares itself with it; no global ranking is built.
    """
    names = {f"top_{b * 100:g}pct": b for b in budgets}

    def size(budget: float, total: Column) -> Column:
        return F.greatest(F.lit(1), F.floor(total * F.lit(float(budget)))).cast("bigint")

    high_first = F.lit(0.0) - F.col("score")
    cuts = rank_cuts(
        scores, high_first, F.col("log_id"),
        {name: size(b, F.col("total")) - 1 for name, b in names.items()},
        major_cell=fraction_cell, minor_cell=id_cell,
    )
    at = F.struct(high_first.alias("major"), F.col("log_id").cast("bigint").alias("minor"))
    rows = scores.withColumn("_at", at).withColumn("_cuts", cut_scalar(cuts))
    hits = [
        F.sum(F.when(F.col("_at") <= F.try_element_at("_cuts", F.lit(n)), F.col("label")).otherwise(0)).alias(n) for n in names
    ]
    totals = rows.agg(*hits, F.count(F.lit(1)).alias("total"), F.sum("label").alias("anomalies"))
    lines = F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(float(b)).alias("budget"), size(b, F.col("total")).alias("top_k"), F.col(f"`{n}`").alias("hits"))
        for n, b in names.items()
    ])
    return (
        totals.select("anomalies", F.inline(lines))
        .withColumn("precision_at_k", ratio(F.col("hits"), F.col("top_k")))
        .withColumn("recall_at_k", ratio(F.col("hits"), F.col("anomalies")))
        .drop("anomalies")
    )


def isolation_only(predictions: DataFrame) -> DataFrame:
    """Rows (isolation_pred, forest_pred, label) only the isolation forest would show."""
    alone = (F.col("isolation_pred") == 1) & (F.col("forest_pred") == 0)
    return predictions.agg(
        F.count_if(alone).alias("reviewed"),
        F.coalesce(F.sum(F.when(alone, F.col("label"))), F.lit(0)).alias("hits"),
        F.sum("label").alias("_positives"),
    ).select(
        "reviewed",
        "hits",
        ratio(F.col("hits"), F.col("reviewed")).alias("precision"),
        ratio(F.col("hits"), F.col("_positives")).alias("anomaly_coverage"),
    )


def promotion(test: DataFrame, minimum: int = MIN_RELIABLE_ANOMALIES) -> DataFrame:
    """Whether the test part holds enough anomalies for its metrics to count."""
    return test.agg(F.coalesce(F.sum("label"), F.lit(0)).alias("test_positives")).withColumn(
        "promoted", F.col("test_positives") >= minimum
    )
