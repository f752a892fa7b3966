"""Score submissions against hidden answers.

A metric is a function from aligned pairs ``actual, predicted`` to a one-row table with the
column ``score``; new ones are added with :func:`register_metric`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packwright.operators.package import placeholder
from packwright.operators.rank import weighted_rank

Metric = Callable[[DataFrame], DataFrame]
_METRICS: dict[str, Metric] = {}
#: Metrics that are one aggregate over two columns, so that many of them share a pass.
_AGGREGATES: dict[str, Callable[[Column, Column], Column]] = {}
#: Metrics of numbers: text that is none fails the submission.
_NUMERIC: set[str] = set()

OK, FAILED = "ok", "failed"
CLIP = 1e-15


def register_metric(name: str, metric: Metric | None = None):
    """Register a metric under a name; usable as a decorator."""
    if metric is None:
        return lambda function: register_metric(name, function)
    _METRICS[name] = metric
    return metric


def register_aggregate(
    name: str, aggregate: Callable[[Column, Column], Column], numeric: bool = True
) -> None:
    """Register a metric that is one aggregate of ``actual`` and ``predicted``."""
    _AGGREGATES[name] = aggregate
    if numeric:
        _NUMERIC.add(name)
    register_metric(name, lambda pairs: pairs.agg(aggregate(F.col("actual"), F.col("predicted")).alias("score")))


def metric_names() -> list[str]:
    """Registered metrics."""
    return sorted(_METRICS)


# --- regression ------------------------------------------------------------------------


def _number(column: Column) -> Column:
    """The value as a double; null for text that is none."""
    return column.try_cast("double")


def _square(actual: Column, predicted: Column) -> Column:
    error = _number(actual) - _number(predicted)
    return error * error


def _r2(actual: Column, predicted: Column) -> Column:
    known = F.when(_square(actual, predicted).isNotNull(), _number(actual))
    residual = F.sum(_square(actual, predicted))
    return F.lit(1.0) - F.try_divide(residual, F.var_pop(known) * F.count(known))


def _log_loss(actual: Column, predicted: Column) -> Column:
    share = F.least(F.greatest(_number(predicted), F.lit(CLIP)), F.lit(1 - CLIP))
    positive = _number(actual)
    return -F.avg(positive * F.ln(share) + (1 - positive) * F.ln(1 - share))


register_aggregate("mse", lambda a, p: F.avg(_square(a, p)))
register_aggregate("rmse", lambda a, p: F.sqrt(F.avg(_square(a, p))))
register_aggregate("mae", lambda a, p: F.avg(F.abs(_number(a) - _number(p))))
register_aggregate("r2", _r2)
register_aggregate("logloss", _log_loss)


def regression_metrics(pairs: DataFrame) -> DataFrame:
    """RMSE, MAE and R² in one pass."""
    pair = F.col("actual"), F.col("predicted")
    return pairs.agg(*[_AGGREGATES[m](*pair).alias(m) for m in ("rmse", "mae", "r2")])


@register_metric("auc")
def auc(pairs: DataFrame) -> DataFrame:
    """Area under the ROC curve of 0/1 labels; ties count one half.

    Equal predictions are counted first; the counts are ordered by range, not in one task.
    """
    positive = _number(F.col("actual")) > 0
    counts = pairs.groupBy(_number(F.col("predicted")).alias("predicted")).agg(
        F.count_if(positive).alias("positives"), F.count_if(~positive).alias("negatives")
    )
    placed = weighted_rank(counts, ["predicted"], "below", "negatives")
    wins = F.sum(F.col("positives") * (F.col("below") + F.col("negatives") / 2))
    return placed.agg(F.try_divide(wins, F.sum("positives") * F.sum("negatives")).alias("score"))


_NUMERIC.add("auc")


# --- classification --------------------------------------------------------------------


def confusion(pairs: DataFrame) -> DataFrame:
    """Rows ``actual, predicted, n``."""
    return pairs.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("n"))


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def per_class_metrics(pairs: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class; 0/0 counts as 0.

    Works on the confusion table, so its second step sees one row per pair of classes.
    """
    hit = F.col("actual") == F.col("predicted")
    zero = F.lit(0).cast("bigint")
    as_actual = F.struct(
        F.col("actual").alias("label"),
        F.when(hit, F.col("n")).otherwise(zero).alias("tp"),
        zero.alias("predicted_n"),
        F.col("n").alias("support"),
    )
    as_predicted = F.struct(
        F.col("predicted").alias("label"),
        zero.alias("tp"),
        F.col("n").alias("predicted_n"),
        zero.alias("support"),
    )
    totals = (
        confusion(pairs)
        .select(F.inline(F.array(as_actual, as_predicted)))
        .groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "predicted_n", "support")])
    )
    precision = _ratio(F.col("tp"), F.col("predicted_n"))
    recall = _ratio(F.col("tp"), F.col("support"))
    return totals.select(
        "label",
        "support",
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(2 * F.col("tp"), F.col("predicted_n") + F.col("support")).alias("f1"),
    )


def _macro(name: str) -> Metric:
    return lambda pairs: per_class_metrics(pairs).agg(F.avg(name).alias("score"))


def _accuracy(actual: Column, predicted: Column) -> Column:
    hit = actual.cast("string") == predicted.cast("string")
    return F.avg(F.when(actual.isNotNull(), F.coalesce(hit.cast("double"), F.lit(0.0))))


register_aggregate("accuracy", _accuracy, numeric=False)
register_metric("precision_macro", _macro("precision"))
register_metric("recall_macro", _macro("recall"))
register_metric("f1_macro", _macro("f1"))


def classification_metrics(pairs: DataFrame) -> DataFrame:
    """Accuracy and macro precision, recall and F1 from one confusion table."""
    per_class = per_class_metrics(pairs).withColumn("hits", F.col("recall") * F.col("support"))
    return per_class.agg(
        F.try_divide(F.sum("hits"), F.sum("support")).alias("accuracy"),
        *[F.avg(c).alias(f"{c}_macro") for c in ("precision", "recall", "f1")],
    )


# --- the score contract ----------------------------------------------------------------


def align(
    solution: DataFrame,
    submission: DataFrame,
    id_col: str = "Id",
    target: str = "target",
    prediction: str | None = None,
) -> DataFrame:
    """Full outer alignment: ``id, actual, predicted, in_solution, copies, answers``.

    Both sides are reduced to one row per id first, so a repeated id cannot multiply rows;
    ``copies`` tells how often it was submitted, ``answers`` how often the solution has it.
    """
    once = submission.groupBy(F.col(id_col).alias("id")).agg(
        F.min(prediction or target).alias("predicted"), F.count(F.lit(1)).alias("copies")
    )
    answers = solution.groupBy(F.col(id_col).alias("id")).agg(
        F.min(target).alias("actual"), F.count(F.lit(1)).alias("answers")
    )
    return answers.join(once, "id", "full_outer").select(
        "id",
        "actual",
        "predicted",
        F.col("answers").isNotNull().alias("in_solution"),
        F.coalesce("copies", F.lit(0)).alias("copies"),
        F.coalesce("answers", F.lit(0)).alias("answers"),
    )


def _coverage_columns() -> dict[str, Column]:
    submitted, known = F.col("copies") > 0, F.col("in_solution")
    return {
        "n_solution": F.count_if(known),
        "n_missing": F.count_if(known & ~submitted),
        "n_unknown": F.count_if(~known),
        "n_repeated": F.count_if(F.col("copies") > 1),
        "n_empty": F.count_if(known & submitted & F.col("predicted").isNull()),
    }


def coverage(aligned: DataFrame) -> DataFrame:
    """One row: ids scored, missing, unknown and repeated, and empty predictions."""
    return aligned.agg(*[c.alias(n) for n, c in _coverage_columns().items()])


def scores(
    solution: DataFrame,
    submission: DataFrame,
    metrics: Sequence[str],
    id_col: str = "Id",
    target: str = "target",
    prediction: str | None = None,
) -> DataFrame:
    """A row ``metric, score, status, reason`` plus the coverage counts for every metric.

    The two tables are aligned once; coverage and all metrics that are plain aggregates come
    from one pass over the pairs. A submission that misses, repeats or invents ids, leaves
    predictions empty or has text where numbers are asked for fails and gets no score. So do a
    solution that repeats ids, an unknown metric, and a score that is not a number.
    """
    aligned = align(solution, submission, id_col, target, prediction)
    scored = F.col("in_solution") & (F.col("copies") > 0)
    actual, predicted = F.when(scored, F.col("actual")), F.when(scored, F.col("predicted"))
    counts = _coverage_columns()
    bad = [c.isNotNull() & _number(c).isNull() for c in (actual, predicted)]
    row = aligned.agg(
        *[c.alias(n) for n, c in counts.items()],
        F.count_if(F.col("answers") > 1).alias("__twice"),
        F.count_if(bad[0] | bad[1]).alias("__text"),
        *[_AGGREGATES[m](actual, predicted).alias(f"__{m}") for m in metrics if m in _AGGREGATES],
    )
    for metric in metrics:
        if metric in _METRICS and metric not in _AGGREGATES:
            own = _METRICS[metric](aligned.filter(scored)).select(F.col("score").alias(f"__{metric}"))
            row = row.unionByName(own, allowMissingColumns=True)
    row = row.agg(*[F.max(c).alias(c) for c in row.columns])
    judged = []
    for metric in metrics:
        raw = F.col(f"__{metric}") if metric in _METRICS else F.lit(None)
        reason = (
            F.when(F.lit(metric not in _METRICS), "unknown metric")
            .when(F.col("n_solution") == 0, "empty solution")
            .when(F.col("__twice") > 0, "repeated solution ids")
            .when(F.col("n_missing") > 0, "missing ids")
            .when(F.col("n_unknown") > 0, "unknown ids")
            .when(F.col("n_repeated") > 0, "repeated ids")
            .when(F.col("n_empty") > 0, "empty predictions")
            .when(F.lit(metric in _NUMERIC) & (F.col("__text") > 0), "text in place of numbers")
            .when(raw.isNull() | F.isnan(raw.cast("double")), "score is not a number")
        )
        judged.append(
            F.struct(
                F.lit(metric).alias("metric"),
                F.when(reason.isNull(), raw.cast("double")).alias("score"),
                F.when(reason.isNull(), OK).otherwise(FAILED).alias("status"),
                reason.alias("reason"),
                *counts,
            )
        )
    return row.select(F.inline(F.array(*judged)))


def score(
    solution: DataFrame,
    submission: DataFrame,
    metric: str,
    id_col: str = "Id",
    target: str = "target",
    prediction: str | None = None,
) -> DataFrame:
    """:func:`scores` for a single metric."""
    return scores(solution, submission, [metric], id_col, target, prediction)


def chance_baseline(
    train: DataFrame, answer: DataFrame, metric: str, id_col: str = "Id", target: str = "target"
) -> DataFrame:
    """Score of the constant guess learned from ``train``."""
    guess = answer.select(id_col, F.lit(placeholder(train, target)).alias("guess"))
    return score(answer, guess, metric, id_col, target, "guess")
