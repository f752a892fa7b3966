"""Ask an injected text provider about every row of a table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packwright.operators.joins import join_unique
from packwright.sources.checkpoints import checkpointed
from packwright.sources.shipping import ship

Provider = Callable[[str, str], str]

_ANSWER = "__digest string, answer string, status string, reason string"


def _digest(prompt: str, context: str):
    """Digest of a (prompt, context) pair; the prompt's length keeps pairs apart."""
    p, c = (F.coalesce(F.col(x), F.lit("")) for x in (prompt, context))
    return F.sha2(F.concat(F.length(p).cast("string"), F.lit(":"), p, c), 256)


def _asked(requests: DataFrame, provider: Provider) -> DataFrame:
    """Answers of the provider, which runs in the tasks; its errors are answers of their own."""
    ship(requests.sparkSession)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for digest, p, c in zip(batch["__digest"], batch["__prompt"], batch["__context"]):
                try:
                    rows.append((digest, provider(p, c), "ok", None))
                except Exception as error:  # the provider is foreign code
                    rows.append((digest, None, "error", f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(rows, columns=["__digest", "answer", "status", "reason"], dtype=object)

    return requests.mapInPandas(ask, _ANSWER)


def _requests(df: DataFrame, prompt: str, context: str, partitions: int | None) -> DataFrame:
    requests = df.select(
        _digest(prompt, context).alias("__digest"),
        F.coalesce(F.col(prompt), F.lit("")).alias("__prompt"),
        F.coalesce(F.col(context), F.lit("")).alias("__context"),
    ).distinct()
    return requests.repartition(partitions, "__digest") if partitions else requests


def infer_batch(
    df: DataFrame, prompt: str, context: str, provider: Provider, partitions: int | None = None
) -> DataFrame:
    """Add ``answer, status, reason``; equal requests are asked once.

    The provider runs in the tasks. A provider error becomes ``status = 'error'`` for its
    rows. Answers are checkpointed before they are joined back, so a lost executor does not
    make the provider answer again.
    """
    answers = checkpointed(_asked(_requests(df, prompt, context, partitions), provider))
    keyed = df.withColumn("__digest", _digest(prompt, context))
    joined = join_unique(keyed, answers, ["__digest"], "left")
    return joined.select(*df.columns, "answer", "status", "reason")


def stored_answers(spark: SparkSession, store: str) -> DataFrame:
    """One row per request ever asked with this store: the last answer, and how often it was asked.

    An answer counts before an error. Only batches that were written whole are read.
    """
    batches = [b for b in _batches(spark, store) if b[1]]
    if not batches:
        return spark.createDataFrame([], f"{_ANSWER}, attempts bigint")
    asked = spark.read.schema(f"{_ANSWER}, batch bigint").parquet(*[path for path, _ in batches])
    best = F.struct((F.col("status") == "ok").alias("ok"), "batch", "answer", "status", "reason")
    kept = asked.groupBy("__digest").agg(F.max(best).alias("best"), F.count(F.lit(1)).alias("attempts"))
    return kept.select("__digest", "best.answer", "best.status", "best.reason", "attempts")


def _batches(spark: SparkSession, store: str) -> list[tuple[str, bool]]:
    """Folders of the store's batches and whether each was written whole."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    folders = [f.getPath() for f in files.listStatus(path) if f.getPath().getName().startswith("batch-")]
    return [(f.toString(), files.exists(f.suffix("/_SUCCESS"))) for f in folders]


def infer_resumed(
    df: DataFrame,
    prompt: str,
    context: str,
    provider: Provider,
    store: str,
    batches: int = 10,
    attempts: int = 3,
    partitions: int | None = None,
) -> DataFrame:
    """:func:`infer_batch` whose answers outlive the application: add ``answer, status, reason, attempts``.

    Requests are dealt into ``batches`` by their digest, and each batch's answers are written to
    the folder ``store`` before the next one begins. A run that follows, of this application or
    another, asks only what has no answer there: requests of batches that were not reached, and
    errors that were asked fewer than ``attempts`` times. A batch that is not written whole counts
    as not asked. Batches are few; what the driver lists is their folders.
    """
    spark = df.sparkSession
    requests = checkpointed(_requests(df, prompt, context, None))
    for part in range(batches):
        known = stored_answers(spark, store)
        settled = known.where((F.col("status") == "ok") | (F.col("attempts") >= attempts)).select("__digest")
        mine = requests.where(F.pmod(F.xxhash64("__digest"), F.lit(batches)) == part)
        todo = mine.join(settled, "__digest", "left_anti")
        todo = checkpointed(todo.repartition(partitions, "__digest") if partitions else todo)
        if todo.isEmpty():
            continue
        number = len(_batches(spark, store))
        answers = _asked(todo, provider).withColumn("batch", F.lit(number).cast("bigint"))
        answers.write.parquet(f"{store.rstrip('/')}/batch-{number:09d}-{uuid.uuid4().hex}")
    keyed = df.withColumn("__digest", _digest(prompt, context))
    joined = join_unique(keyed, stored_answers(spark, store), ["__digest"], "left")
    return joined.select(*df.columns, "answer", "status", "reason", "attempts")
