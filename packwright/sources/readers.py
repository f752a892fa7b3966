"""Readers. Each returns a lazily planned DataFrame unless it has to find a schema."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packwright.functions.jsontext import recover_object
from packwright.functions.text import WHITESPACE, extension, strip
from packwright.operators.joins import join_unique
from packwright.operators.package import TASK_SCHEMA
from packwright.sources.checkpoints import checkpointed
from packwright.sources.pieces import read_pieces
from packwright.sources.shipping import ship

# Texts that are a number; a plain cast would also take suffixes such as 3D.
NUMBER = r"(?i)^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity)$"

# Texts a table reader takes for a missing value.
MISSING_TEXTS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """One URL per line, stripped; blank lines are dropped."""
    return spark.read.text(path).select(strip(F.col("value")).alias("url")).filter("url <> ''")


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    schema: T.StructType | str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """CSV or TSV with a header. Without a schema the types are inferred by a second read.

    Line breaks inside quotes are taken, and many tasks may read one file (see
    :mod:`packwright.sources.pieces`). Files that are known to hold a record per line need one
    pass less with ``multi_line=False``.
    """
    if multi_line:
        return read_pieces(spark, path, sep, schema)
    reader = spark.read.option("header", True).option("sep", sep).option("escape", '"')
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet; filters and column choice reach the scan."""
    return spark.read.parquet(path)


def read_task_definitions(spark: SparkSession, path: str) -> DataFrame:
    """Task definitions, one JSON document per file: ``path, task, status, reason, json_text``.

    Files that are not strict JSON are kept with ``status = 'quarantined'`` and their text.
    """
    files = spark.read.text(path, wholetext=True)
    named = files.select(F.col("_metadata.file_path").alias("path"), "value")
    whole = named.select("path", strip(F.col("value")).alias("document"))
    # A document is the whole file, so text around the object has to be an error.
    bounded = F.startswith("document", F.lit("{")) & F.endswith("document", F.lit("}"))
    checked = whole.withColumn("candidate", F.when(bounded, F.col("document")))
    return recover_object(checked, "candidate", TASK_SCHEMA).select(
        "path",
        F.col("value").alias("task"),
        "status",
        "reason",
        F.col("document").alias("json_text"),
    )



#: Stores whose folders tasks can list; others are listed by the driver.
_LISTED_IN_TASKS = ("file", "hdfs", "s3", "gs", "abfs", "abfss")
_LISTING = "path string, length bigint, modified timestamp, is_dir boolean"


def _list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of every folder of a column of paths, names of any kind and empty files too."""
    for batch in batches:
        rows = []
        for folder in batch.column("path").to_pylist():
            store, inside = fs.FileSystem.from_uri(folder)
            for entry in store.get_file_info(fs.FileSelector(inside)):
                is_dir = entry.type == fs.FileType.Directory
                path = f"{folder.rstrip('/')}/{entry.base_name}"
                rows.append((path, None if is_dir else entry.size, entry.mtime, is_dir))
        kinds = (pa.string(), pa.int64(), pa.timestamp("us", tz="UTC"), pa.bool_())
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["path", "length", "modified", "is_dir"])


def _listed_by_driver(spark: SparkSession, root: str) -> DataFrame:
    jvm, rows = spark.sparkContext._jvm, []
    path = jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    while files.hasNext():
        entry = files.next()
        rows.append((entry.getPath().toString(), entry.getLen(), entry.getModificationTime()))
    listed = spark.createDataFrame(rows, "path string, length bigint, millis bigint")
    return listed.select("path", "length", F.timestamp_millis("millis").alias("modified"))


def scan_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root``: ``path, rel_path, label, ext, length, modified``.

    File contents are never read. ``label`` is the name of the parent directory. The tree is
    listed level by level in the tasks; hidden and empty files are files like any other.
    """
    scheme = root.split(":", 1)[0] if ":" in root else "file"
    top = root.rstrip("/")
    if scheme in _LISTED_IN_TASKS:
        ship(spark)
        folders, levels = spark.createDataFrame([(top,)], "path string"), []
        while not folders.isEmpty():
            listed = checkpointed(folders.mapInArrow(_list_folders, _LISTING))
            levels.append(listed.filter("not is_dir").drop("is_dir"))
            folders = listed.filter("is_dir").select("path").repartition("path")
        files = reduce(DataFrame.unionByName, levels)
    else:
        files = _listed_by_driver(spark, root)
    relative = F.substr("path", F.instr("path", f"{top}/") + F.lit(len(top) + 1))
    return files.select(
        "path",
        relative.alias("rel_path"),
        F.substring_index(F.substring_index("path", "/", -2), "/", 1).alias("label"),
        extension(F.col("path")).alias("ext"),
        "length",
        "modified",
    )


# --- whitespace-delimited text ---------------------------------------------------------


def _fields(line: Column) -> Column:
    """Fields of a line; a field that starts with a quote may hold blanks."""
    tokens = F.regexp_extract_all(line, F.lit(r'("[^"]*"\S*|\S+)'), F.lit(1))
    return F.transform(
        tokens, lambda t: F.when(F.startswith(t, F.lit('"')), F.trim(t, F.lit('"'))).otherwise(t)
    )


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("at"),
        F.trim("value", F.lit(WHITESPACE)).alias("line"),
    )
    return lines.filter("line <> ''").select("file", "at", _fields(F.col("line")).alias("fields"))


#: Kinds of cells and columns, each of which can hold those before it.
KINDS = ("bigint", "double", "string")


def _cell(field: Column) -> Column:
    """A field's text, null where it stands for a missing value."""
    return F.when(~field.isin(*MISSING_TEXTS), field)


def _kind(cell: Column) -> Column:
    """Place of a cell in ``KINDS``; a missing value needs a column of doubles."""
    # Integer text only: a cast to bigint would also take '1.5' and drop the fraction.
    whole = F.rlike(cell, F.lit(r"^[+-]?[0-9]+$")) & cell.try_cast("bigint").isNotNull()
    return F.when(cell.isNull(), 1).when(whole, 0).when(F.rlike(cell, F.lit(NUMBER)), 1).otherwise(2)


def _with_kinds(lines: DataFrame) -> DataFrame:
    """Per file: ``width`` (fields of its first data line), ``widest``, ``accepted`` and ``kinds``.

    One read: an aggregate per file and column, combined before the shuffle, whose rows are then
    few. ``kinds`` has the kind of each column; one that short lines lack has missing values.
    """
    cells = lines.select("file", "at", F.size("fields").alias("n"), F.posexplode("fields").alias("pos", "field"))
    columns = cells.groupBy("file", "pos").agg(
        F.max(_kind(_cell(F.col("field")))).alias("kind"),
        F.count(F.lit(1)).alias("present"),
        F.min_by("n", "at").alias("first"),
        F.max("n").alias("widest"),
    )
    # Every line has a first field, which therefore stands for the lines.
    files = columns.groupBy("file").agg(
        F.max(F.when(F.col("pos") == 0, F.col("present"))).alias("lines"),
        F.max(F.when(F.col("pos") == 0, F.col("first"))).alias("width"),
        F.max("widest").alias("widest"),
        F.sort_array(F.collect_list(F.struct("pos", "kind", "present"))).alias("columns"),
    )
    kinds = F.transform("columns", lambda c: F.when(c["present"] < F.col("lines"), F.greatest(c["kind"], F.lit(1))).otherwise(c["kind"]))
    return files.select("file", "width", "widest", (F.col("widest") <= F.col("width")).alias("accepted"), kinds.alias("kinds"))


def ws_files(spark: SparkSession, path: str) -> DataFrame:
    """Per file: ``width`` (fields of its first data line), ``widest``, ``accepted`` and ``kinds``.

    A file with a line wider than its first one is rejected. The first line is the smallest
    (block start, line) pair, so large files may be read in blocks.
    """
    return _with_kinds(_numbered_lines(spark, path))


def read_ws_table(spark: SparkSession, path: str, typed: bool = True, per_file: bool = False) -> DataFrame:
    """Headerless text with whitespace between fields, as columns ``file, col_0, col_1, ...``.

    Blank lines are skipped, short lines padded with null, and rejected files left out (see
    :func:`ws_files`). With ``typed`` a column whose every value is a number becomes
    ``bigint`` or ``double``; with ``per_file`` every file has types of its own, and cells are
    variants. The text is read once for the types and once for the table.
    """
    files = checkpointed(ws_files(spark, path)).filter("accepted")
    width = files.agg(F.max("width")).first()[0] or 0
    names = [f"col_{i}" for i in range(width)]
    facts = files.select("file", "kinds") if per_file else files.select("file")
    kept = join_unique(_numbered_lines(spark, path), facts, ["file"], "inner" if per_file else "left_semi")
    cells = {n: _cell(F.get("fields", F.lit(i))) for i, n in enumerate(names)}
    if per_file:
        def variant(i: int, cell: Column) -> Column:
            kind = F.get("kinds", F.lit(i))
            casts = [cell.cast(k).cast("variant") for k in KINDS]
            return F.when(kind == 0, casts[0]).when(kind == 1, casts[1]).otherwise(casts[2])

        return kept.select("file", *[variant(i, cell).alias(n) for i, (n, cell) in enumerate(cells.items())])
    table = kept.select("file", *[cell.alias(n) for n, cell in cells.items()])
    if not typed or not names:
        return table
    highest = [F.max(F.coalesce(F.get("kinds", F.lit(i)), F.lit(1))) for i in range(len(names))]
    kinds = files.agg(*[h.alias(n) for h, n in zip(highest, names)]).first()
    return table.select("file", *[F.col(n).cast(KINDS[kinds[n]]).alias(n) for n in names])
