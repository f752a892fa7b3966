"""A plain model that shows a package can be solved."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    FeatureHasher,
    Imputer,
    IndexToString,
    OneHotEncoder,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns of the hashed text features.
HASHED_FEATURES = 4_096
MISSING = "(missing)"
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _as_number(field: T.StructField) -> Column:
    """A number as it is, a date or time as seconds."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, _TIMES):
        column = F.unix_micros(column.cast("timestamp")) / 1e6
    return column.cast("double")


def fit_predict(
    train: DataFrame,
    test: DataFrame,
    target: str,
    id_col: str = "Id",
    task_type: str = "regression",
    one_hot: Sequence[str] = (),
) -> DataFrame:
    """Fit on ``train`` and return ``id_col, prediction`` for every row of ``test``.

    Numbers, dates and times are imputed. Text is hashed, so no column's values are gathered;
    the columns named in ``one_hot``, whose values the caller knows to be few, are encoded
    exactly.
    """
    classify = task_type == "classification"
    fields = [f for f in train.schema if f.name not in {target, id_col}]
    plain = {f.name: f for f in fields if isinstance(f.dataType, (T.NumericType, *_TIMES))}
    numeric = list(plain)
    text = [f.name for f in fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]
    few, many = [c for c in text if c in one_hot], [c for c in text if c not in one_hot]

    def prepared(df: DataFrame) -> DataFrame:
        casts = {c: _as_number(plain[c]) for c in numeric}
        casts |= {c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING)) for c in text}
        return df.withColumns(casts) if casts else df

    stages, inputs = [], []
    if numeric:
        filled = [f"{c}__filled" for c in numeric]
        stages.append(Imputer(inputCols=numeric, outputCols=filled))
        inputs += filled
    if few:
        indexed, encoded = [f"{c}__index" for c in few], [f"{c}__onehot" for c in few]
        stages.append(StringIndexer(inputCols=few, outputCols=indexed, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"))
        inputs += encoded
    if many:
        stages.append(
            FeatureHasher(inputCols=many, outputCol="__hashed", numFeatures=HASHED_FEATURES)
        )
        inputs.append("__hashed")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="__features", handleInvalid="keep"))

    rows = prepared(train.filter(F.col(target).isNotNull()))
    if classify:
        label = StringIndexer(inputCol=target, outputCol="__label").fit(
            rows.withColumn(target, F.col(target).cast("string"))
        )
        rows = label.transform(rows.withColumn(target, F.col(target).cast("string")))
        model = LogisticRegression(featuresCol="__features", labelCol="__label", maxIter=20)
    else:
        rows = rows.withColumn("__label", F.col(target).cast("double"))
        model = LinearRegression(featuresCol="__features", labelCol="__label", regParam=1e-6)
    fitted = Pipeline(stages=[*stages, model]).fit(rows)
    predicted = fitted.transform(prepared(test))
    if classify:
        back = IndexToString(inputCol="prediction", outputCol="__text", labels=label.labels)
        return back.transform(predicted).select(id_col, F.col("__text").alias("prediction"))
    return predicted.select(id_col, "prediction")
