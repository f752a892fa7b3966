"""Writers. All write in parallel, one file per task; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packwright.operators.package import hide_target, sample_submission

TRAIN_PATH = "public/train"
TEST_PATH = "public/test"
SAMPLE_PATH = "public/sample_submission"
ANSWER_PATH = "private/test_answer"


def write_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    """CSV or TSV with a header and no index column; quotes are doubled."""
    df.write.mode(mode).option("header", True).option("sep", sep).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet."""
    df.write.mode(mode).parquet(path)


def write_json_records(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON record per line, UTF-8, non-ASCII text as it is, nulls kept as fields."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_text(df: DataFrame, text: Column, path: str, mode: str = "errorifexists") -> None:
    """One text per row, for reports and requirement lists."""
    df.select(text.alias("value")).write.mode(mode).text(path)


def write_labelled_split(
    manifest: DataFrame, path: str, label: str = "label", mode: str = "errorifexists"
) -> None:
    """A split manifest as ``split=.../label=...`` folders.

    Rows are rebalanced by folder: adaptive execution cuts a frequent label into as many tasks
    as its size asks for, and a rare one does not leave a file per task.
    """
    gathered = manifest.hint("rebalance", "split", label)
    gathered.write.mode(mode).partitionBy("split", label).parquet(path)


def write_package(
    split: DataFrame, root: str, id_col: str, target: str, mode: str = "errorifexists"
) -> None:
    """Public train, test and sample submission, and the private answers.

    The split compares each row with fixed cut values, so every output sees the same sides;
    each scan reads only the columns it writes. Nothing below ``public`` holds a test target.
    """
    train, test, answer = hide_target(split, id_col, target)
    write_delimited(train, f"{root}/{TRAIN_PATH}", mode=mode)
    write_delimited(test, f"{root}/{TEST_PATH}", mode=mode)
    sample = sample_submission(test, train, id_col, target)
    write_delimited(sample, f"{root}/{SAMPLE_PATH}", mode=mode)
    write_delimited(answer, f"{root}/{ANSWER_PATH}", mode=mode)


def write_split(split: DataFrame, root: str, fmt: str, mode: str = "errorifexists") -> None:
    """Both sides of a split as ``train`` and ``test`` in the format of its source."""
    for side in ("train", "test"):
        part = split.filter(F.col("split") == side).drop("split")
        if fmt == ".parquet":
            write_parquet(part, f"{root}/{side}", mode)
        elif fmt in (".csv", ".tsv"):
            write_delimited(part, f"{root}/{side}", "\t" if fmt == ".tsv" else ",", mode)
        else:
            raise ValueError(f"unsupported format: {fmt}")
