"""Checks of packages, proposals and replies; every check yields rows of findings.

Findings have the columns ``package, stage, check, severity, message``. A problem is a row,
never an exception.
"""

from __future__ import annotations

import ast
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packwright.functions.jsontext import is_strict_json, key_differences
from packwright.functions.text import verdict
from packwright.operators.joins import join_unique
from packwright.operators.rank import weighted_rank
from packwright.sources.checkpoints import checkpointed
from packwright.sources.shipping import ship

# Layout of a package, its interface, proposal keys and task types.
REQUIRED_DIRECTORIES = ("data", "data/raw", "data/public", "data/private")
REQUIRED_FILES = (
    "prepare.py",
    "metric.py",
    "description.txt",
    "data/public/train.csv",
    "data/public/test.csv",
    "data/public/sample_submission.csv",
    "data/private/test_answer.csv",
)
PREPARE_FUNCTION, PREPARE_ARGUMENTS = "prepare", 3
METRIC_BASE = "BaseMetric"
PROPOSAL_REQUIRED = (
    "prediction_target",
    "evaluation_metric",
    "data_utilization",
    "justification",
)
PROPOSAL_OPTIONAL = ("difficulty", "tags", "feature_columns", "task_type")
PROPOSAL_SCHEMA = (
    "prediction_target string, evaluation_metric string, data_utilization string, "
    "justification string, difficulty string, tags array<string>, "
    "feature_columns array<string>, task_type string"
)
TASK_TYPES = ("regression", "classification", "回归", "分类")
DEFAULT_DIFFICULTY, DEFAULT_TASK_TYPE = "中等", "回归"
REGRESSION_METRICS = ("rmse", "mse", "mae", "r2")
CLASSIFICATION_METRICS = ("accuracy", "f1", "precision", "recall", "auc", "logloss")
IMBALANCE_SHARE = 0.8

ERROR, WARNING = "error", "warning"
STAGES = (1, 2, 3)


def _finding(stage: int, check: Column | str, severity: Column | str, message: Column) -> list[Column]:
    as_column = lambda v: F.lit(v) if isinstance(v, str) else v
    return [
        F.lit(stage).alias("stage"),
        as_column(check).alias("check"),
        as_column(severity).alias("severity"),
        message.alias("message"),
    ]


# --- stage 1: layout and interfaces ----------------------------------------------------


def _missing(
    manifest: DataFrame,
    required: dict[str, Column],
    check: str,
    text: str,
    packages: DataFrame | None,
) -> DataFrame:
    """Findings for required paths no manifest row provides; one flag per path and package.

    With ``packages``, one without any manifest row lacks every path.
    """
    paths = list(required)
    flags = manifest.groupBy("package").agg(
        *[F.bool_or(F.coalesce(required[p], F.lit(False))).alias(f"f{i}") for i, p in enumerate(paths)]
    )
    if packages is not None:
        flags = packages.select("package").distinct().join(flags, "package", "left")
    provided = [F.coalesce(F.col(f"f{i}"), F.lit(False)) for i in range(len(paths))]
    absent = F.array(*[F.when(~found, F.lit(p)) for found, p in zip(provided, paths)])
    rows = flags.select("package", F.explode(F.array_compact(absent)).alias("path"))
    return rows.select(
        "package", *_finding(1, check, ERROR, F.concat(F.lit(text), F.col("path")))
    )


def layout_findings(manifest: DataFrame, packages: DataFrame | None = None) -> DataFrame:
    """Missing directories. A directory exists if it is listed or a file lies below it."""
    path, is_dir = F.col("rel_path"), F.col("is_dir")
    required = {
        d: (is_dir & (path == d)) | F.startswith(path, F.lit(d + "/"))
        for d in REQUIRED_DIRECTORIES
    }
    return _missing(manifest, required, "layout", "missing directory ", packages)


def file_findings(manifest: DataFrame, packages: DataFrame | None = None) -> DataFrame:
    """Missing files."""
    path, is_file = F.col("rel_path"), ~F.col("is_dir")
    required = {f: is_file & (path == f) for f in REQUIRED_FILES}
    return _missing(manifest, required, "files", "missing file ", packages)


def _prepare_problem(tree: ast.AST) -> str | None:
    for node in ast.walk(tree):
        if isinstance(node, ast.FunctionDef) and node.name == PREPARE_FUNCTION:
            found = len(node.args.args)
            if found == PREPARE_ARGUMENTS:
                return None
            return f"{PREPARE_FUNCTION} takes {found} arguments, not {PREPARE_ARGUMENTS}"
    return f"no function {PREPARE_FUNCTION}"


def _metric_problem(tree: ast.AST) -> str | None:
    classes = (n for n in ast.walk(tree) if isinstance(n, ast.ClassDef))
    bases = (b for c in classes for b in c.bases)
    if any(isinstance(b, ast.Name) and b.id == METRIC_BASE for b in bases):
        return None
    return f"no class based on {METRIC_BASE}"


_INTERFACES = {"prepare.py": _prepare_problem, "metric.py": _metric_problem}


def interface_problem(path: str, source: str | None) -> str | None:
    """What is wrong with one source file, by parsing it; it is never run."""
    check = _INTERFACES.get(path)
    if check is None or source is None:
        return None
    try:
        return check(ast.parse(source))
    except (SyntaxError, ValueError, RecursionError, MemoryError) as error:
        return f"cannot parse: {type(error).__name__}"


@F.pandas_udf(T.StringType())
def _interface_problems(paths: pd.Series, sources: pd.Series) -> pd.Series:
    return pd.Series([interface_problem(p, s) for p, s in zip(paths, sources)], dtype=object)


def interface_findings(sources: DataFrame) -> DataFrame:
    """Interface errors in rows ``package, rel_path, source``; other files are not parsed."""
    ship(sources.sparkSession)
    relevant = sources.filter(F.col("rel_path").isin(*_INTERFACES))
    problem = _interface_problems("rel_path", "source")
    return (
        relevant.withColumn("problem", problem)
        .filter(F.col("problem").isNotNull())
        .select(
            "package",
            *_finding(
                1, F.concat(F.lit("interface "), F.col("rel_path")), ERROR, F.col("problem")
            ),
        )
    )


def assertion_findings(
    manifest: DataFrame, sources: DataFrame, packages: DataFrame | None = None
) -> DataFrame:
    """All findings of the first stage: directories, files and interfaces."""
    return (
        layout_findings(manifest, packages)
        .unionByName(file_findings(manifest, packages))
        .unionByName(interface_findings(sources))
    )


# --- proposals -------------------------------------------------------------------------


def proposal_shape(proposals: DataFrame, text: str = "proposal", batch: str | None = None) -> DataFrame:
    """Add ``missing_keys, unknown_keys, accepted``.

    With ``batch`` one bad proposal rejects every proposal of its batch; otherwise, and without
    a value of ``batch``, each is judged alone.
    """
    missing, unknown = key_differences(F.col(text), PROPOSAL_REQUIRED, PROPOSAL_OPTIONAL)
    valid = is_strict_json(F.col(text))
    judged = proposals.withColumns(
        {
            "missing_keys": F.when(valid, missing),
            "unknown_keys": F.when(valid, unknown),
            "accepted": F.coalesce(
                valid & (F.size(missing) == 0) & (F.size(unknown) == 0), F.lit(False)
            ),
        }
    )
    if batch is None:
        return judged
    bad = judged.filter(F.col(batch).isNotNull()).groupBy(batch)
    bad = bad.agg(F.bool_and("accepted").alias("__batch_ok"))
    return (
        join_unique(judged, bad, [batch], "left")
        .withColumn("accepted", F.coalesce("__batch_ok", "accepted"))
        .select(*judged.columns)
    )


def with_proposal_defaults(proposal: Column) -> Column:
    """A parsed proposal with the defaults of the fields that may be left out."""
    defaults = {
        "difficulty": F.lit(DEFAULT_DIFFICULTY),
        "task_type": F.lit(DEFAULT_TASK_TYPE),
        "tags": F.array().cast("array<string>"),
        "feature_columns": F.array().cast("array<string>"),
    }
    fields = [*PROPOSAL_REQUIRED, *PROPOSAL_OPTIONAL]
    filled = [F.coalesce(proposal[f], defaults[f]) if f in defaults else proposal[f] for f in fields]
    return F.struct(*[value.alias(name) for value, name in zip(filled, fields)])


def proposal_problems(proposal: Column, columns: Sequence[str]) -> Column:
    """Sorted array of problems of a parsed proposal, against the columns of its table."""
    known = F.array(*[F.lit(c) for c in columns])
    target = F.concat(F.lit("target is not a column: "), proposal["prediction_target"])
    unknown = F.array_except(
        F.coalesce(proposal["feature_columns"], F.array().cast("array<string>")), known
    )
    features = F.transform(unknown, lambda c: F.concat(F.lit("feature is not a column: "), c))
    kind = F.concat(F.lit("unknown task type: "), proposal["task_type"])
    single = F.array(
        F.when(~F.array_contains(known, proposal["prediction_target"]), target),
        F.when(~proposal["task_type"].isin(*TASK_TYPES), kind),
        F.when(proposal["prediction_target"].isNull(), "no target"),
        F.when(proposal["task_type"].isNull(), "no task type"),
    )
    return F.array_sort(F.concat(F.array_compact(single), features))


# --- stage 2: reviews, leakage and metrics ---------------------------------------------


def review_findings(replies: DataFrame, text: str = "reply", check: str = "check") -> DataFrame:
    """Errors and warnings of reviewers' replies; other replies pass."""
    severity = verdict(F.col(text))
    return (
        replies.withColumn("severity", severity)
        .filter(F.col("severity") != "pass")
        .select("package", *_finding(2, F.col(check), F.col("severity"), F.col(text)))
    )


def feature_relation(df: DataFrame, target: str, features: Sequence[str] | None = None) -> DataFrame:
    """Per feature: is it equal to the target in every row, and its correlation with it.

    One pass for all features. Correlation is null for text or constant columns; rows with a
    null or NaN on either side do not count for it.
    """
    names = list(features) if features is not None else [c for c in df.columns if c != target]
    numeric_target = isinstance(df.schema[target].dataType, T.NumericType)

    def correlation(name: str) -> Column:
        if numeric_target and isinstance(df.schema[name].dataType, T.NumericType):
            # corr() raises on a constant column in ANSI mode.
            values = [F.col(c).cast("double") for c in (name, target)]
            known = [v.isNotNull() & ~F.isnan(v) for v in values]
            pair = [F.when(known[0] & known[1], v) for v in values]
            spread = F.stddev_pop(pair[0]) * F.stddev_pop(pair[1])
            return F.try_divide(F.covar_pop(*pair), spread)
        return F.lit(None).cast("double")

    def equality(name: str) -> Column:
        same_kind = df.schema[name].dataType == df.schema[target].dataType or (
            numeric_target and isinstance(df.schema[name].dataType, T.NumericType)
        )
        if not same_kind:
            return F.lit(False)
        return F.bool_and(F.col(name).eqNullSafe(F.col(target)))

    row = df.agg(
        *[
            F.struct(
                F.lit(n).alias("feature"),
                equality(n).alias("is_target"),
                correlation(n).alias("correlation"),
            ).alias(f"r{i}")
            for i, n in enumerate(names)
        ]
    )
    return row.select(F.inline(F.array(*[F.col(f"r{i}") for i in range(len(names))])))


def leakage_findings(
    df: DataFrame,
    target: str,
    features: Sequence[str] | None = None,
    threshold: float = 0.95,
    package: str = "",
) -> DataFrame:
    """A feature equal to the target is an error, a strongly correlated one a warning."""
    relation = feature_relation(df, target, features)
    strong = (F.abs("correlation") > threshold) & ~F.isnan("correlation")
    severity = F.when(F.col("is_target"), ERROR).when(strong, WARNING)
    return (
        relation.withColumn("severity", severity)
        .filter(F.col("severity").isNotNull())
        .select(
            F.lit(package).alias("package"), *_finding(2, "leakage", F.col("severity"), F.col("feature"))
        )
    )


def _known(df: DataFrame, column: str) -> Column:
    """Whether a value is neither null nor NaN."""
    known = F.col(f"`{column}`").isNotNull()
    return known & ~F.isnan(F.col(f"`{column}`")) if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)) else known


def _centred_ranks(pairs: DataFrame, column: str, rows: int) -> DataFrame:
    """Values of a column with their rank, ties averaged, less the mean rank."""
    counts = checkpointed(pairs.groupBy(column).agg(F.sum("w").alias("w")))
    placed = weighted_rank(counts, [column], "before", "w")
    # Whole halves, exact in doubles: the mean of all ranks is (rows + 1) / 2.
    return placed.select(column, (F.col("before") + F.col("w") / 2 - F.lit(rows / 2)).alias(f"{column}_rank"))


def rank_correlation(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """``(feature, n, rank_correlation)``: how monotone each feature and the target are in each other.

    Rank correlation with ties averaged, over rows where both are known; null where one of them
    is constant. Rows are reduced to counts of pairs of values first; the order of the values is
    found without a task that holds them all. The target is ranked once for all features that
    leave out none of its known rows.
    """
    targets = checkpointed(df.where(_known(df, target)).groupBy(F.col(f"`{target}`").alias("t")).agg(F.count(F.lit(1)).alias("w")))
    target_rows = targets.agg(F.sum("w")).first()[0] or 0
    target_ranks = None
    found = []
    for name in features:
        known = df.where(_known(df, name) & _known(df, target))
        pairs = checkpointed(known.groupBy(F.col(f"`{name}`").alias("f"), F.col(f"`{target}`").alias("t")).agg(F.count(F.lit(1)).alias("w")))
        rows = pairs.agg(F.sum("w")).first()[0] or 0
        if rows == target_rows:
            # The same rows: the pairs hold every known target value as often as the table does.
            if target_ranks is None:
                target_ranks = checkpointed(_centred_ranks(targets, "t", rows))
            t_ranks = target_ranks
        else:
            t_ranks = _centred_ranks(pairs, "t", rows)
        ranked = join_unique(pairs, _centred_ranks(pairs, "f", rows), ["f"])
        ranked = join_unique(ranked, t_ranks, ["t"])
        a, b, w = F.col("f_rank"), F.col("t_rank"), F.col("w")
        spread = F.sqrt(F.sum(w * a * a)) * F.sqrt(F.sum(w * b * b))
        correlation = F.try_divide(F.sum(w * a * b), spread)
        found.append(ranked.agg(correlation.alias("rank_correlation")).select(F.lit(name).alias("feature"), F.lit(rows).cast("bigint").alias("n"), "rank_correlation"))
    return reduce(DataFrame.unionByName, found)


def target_dependence(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """``(feature, n, n_values, n_determined, determined_share)``: does a feature's value fix the target?

    Over rows where both are known: the values of the feature, those that come with one target
    only, and the share of rows that have such a value. One job for all features; values combine
    before the shuffle, so a frequent one is no burden.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(name).alias("feature"),
                F.when(_known(df, name) & _known(df, target), F.col(f"`{name}`").cast("string")).alias("value"),
                F.col(f"`{target}`").alias("target"),
            )
            for name in features
        ]
    )
    laid = df.select(F.inline(cells)).where("value is not null")
    values = laid.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("rows"), (F.min("target") == F.max("target")).alias("fixed"))
    share = F.sum(F.when(F.col("fixed"), F.col("rows")).otherwise(0)) / F.sum("rows")
    return values.groupBy("feature").agg(
        F.sum("rows").alias("n"), F.count(F.lit(1)).alias("n_values"), F.count_if("fixed").alias("n_determined"), share.alias("determined_share")
    )


def nonlinear_leakage_findings(
    df: DataFrame,
    target: str,
    features: Sequence[str],
    threshold: float = 0.95,
    repeats: float = 2.0,
    package: str = "",
) -> DataFrame:
    """Warnings about features that follow the target's order or determine it.

    A rank correlation beyond the threshold, or a value that fixes the target in more than that
    share of rows. A feature whose values come fewer than ``repeats`` times on average, a key for
    instance, determines everything and says nothing, and so does one with a constant target.
    """
    numeric = [f for f in features if isinstance(df.schema[f].dataType, T.NumericType)]
    warnings = []
    if numeric and isinstance(df.schema[target].dataType, T.NumericType):
        monotone = rank_correlation(df, target, numeric)
        warnings.append(monotone.where(F.abs("rank_correlation") > threshold).select("feature", F.lit("leakage_monotone").alias("check")))
    ends = df.where(_known(df, target)).agg(F.min(F.col(f"`{target}`")).alias("a"), F.max(F.col(f"`{target}`")).alias("b")).first()
    if features and ends["a"] != ends["b"]:
        fixed = target_dependence(df, target, features)
        fixed = fixed.where((F.col("determined_share") > threshold) & (F.col("n") >= repeats * F.col("n_values")))
        warnings.append(fixed.select("feature", F.lit("leakage_determined").alias("check")))
    if not warnings:
        return df.sparkSession.createDataFrame([], "package string, stage int, check string, severity string, message string")
    found = reduce(DataFrame.unionByName, warnings)
    return found.select(F.lit(package).alias("package"), *_finding(2, F.col("check"), F.lit(WARNING), F.col("feature")))


def label_share(labels: DataFrame, label: str, by: str = "package") -> DataFrame:
    """Share of the most frequent label per package."""
    counts = labels.groupBy(by, label).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(by).agg((F.max("n") / F.sum("n")).alias("top_share"))


def metric_findings(
    tasks: DataFrame, shares: DataFrame, imbalance: float = IMBALANCE_SHARE
) -> DataFrame:
    """Metrics that do not fit: of the other task type, or accuracy on unbalanced labels.

    ``tasks`` has ``package, task_type, metric``; ``shares`` comes from :func:`label_share`.
    """
    metric = F.lower("metric")
    kind = F.lower("task_type")
    classification = kind.isin("classification", "分类")
    regression = kind.isin("regression", "回归")
    wrong = (classification & metric.isin(*REGRESSION_METRICS)) | (
        regression & metric.isin(*CLASSIFICATION_METRICS)
    )
    unbalanced = classification & (metric == "accuracy") & (F.col("top_share") >= imbalance)
    severity = F.when(wrong, ERROR).when(unbalanced, WARNING)
    message = F.when(
        wrong, F.concat(metric, F.lit(" does not fit "), kind)
    ).otherwise("accuracy on unbalanced labels")
    return (
        join_unique(tasks, shares, ["package"], "left")
        .withColumn("__severity", severity)
        .filter(F.col("__severity").isNotNull())
        .select("package", *_finding(2, "metric", F.col("__severity"), message))
    )


# --- stage 3 and the gate --------------------------------------------------------------


def score_findings(scores: DataFrame) -> DataFrame:
    """Failed runs and NaN scores of rows ``package, status, score`` are errors.

    Failure is told by ``status``, so that a legal score of -1 is no error.
    """
    failed = F.coalesce(F.col("status") != "ok", F.lit(True))
    not_a_number = F.col("score").isNull() | F.isnan("score")
    message = F.when(failed, "run failed").when(not_a_number, "score is not a number")
    return (
        scores.withColumn("__message", message)
        .filter(F.col("__message").isNotNull())
        .select("package", *_finding(3, "execution", ERROR, F.col("__message")))
    )


def gate(
    findings: DataFrame, packages: DataFrame, runs: DataFrame | None = None
) -> DataFrame:
    """One row per package and stage: was it reached, did it pass, and its findings.

    A stage passes if it was reached and has no error; warnings do not count. It is reached
    only if every earlier stage passed and, where ``runs`` lists ``package, stage`` of the
    stages that ran, only if it ran.
    """
    errors = [
        F.count_if((F.col("stage") == s) & (F.col("severity") == ERROR)).alias(f"e{s}")
        for s in STAGES
    ]
    warnings = [
        F.count_if((F.col("stage") == s) & (F.col("severity") == WARNING)).alias(f"w{s}")
        for s in STAGES
    ]
    counted = findings.groupBy("package").agg(*errors, *warnings)
    joined = packages.select("package").distinct().join(counted, "package", "left")
    if runs is not None:
        ran = [F.bool_or(F.col("stage") == s).alias(f"r{s}") for s in STAGES]
        joined = joined.join(runs.groupBy("package").agg(*ran), "package", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    rows, reached = [], F.lit(True)
    for stage in STAGES:
        clean = zero(F.col(f"e{stage}")) == 0
        if runs is not None:
            reached = reached & F.coalesce(F.col(f"r{stage}"), F.lit(False))
        rows.append(
            F.struct(
                F.lit(stage).alias("stage"),
                reached.alias("reached"),
                (reached & clean).alias("passed"),
                zero(F.col(f"e{stage}")).alias("errors"),
                zero(F.col(f"w{stage}")).alias("warnings"),
            )
        )
        reached = reached & clean
    return joined.select("package", F.inline(F.array(*rows)))
