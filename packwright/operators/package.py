"""Assemble benchmark packages: merged tables, hidden targets, records and reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packwright.functions.text import indent_lines
from packwright.operators.split import TEST, TRAIN

# The task definition a model returns, section by section.
TASK_SECTIONS = {
    "source_paper": ("title", "url"),
    "scientific_summary": (
        "background",
        "hypothesis_or_goal",
        "methodology_summary",
        "key_results",
    ),
    "ml_task": ("task_type", "problem_statement", "input_description", "output_description"),
    "evaluation_criteria": ("primary_metric", "secondary_metrics", "reported_performance"),
    "data_details": ("format", "structure_description", "target_column_or_logic"),
    "model_details": ("architecture_family", "key_libraries_mentioned"),
    "data_profile": ("file_formats", "primary_format", "file_count"),
    "data_sources": ("raw_data_path", "original_links", "local_setup_log"),
}
LIST_FIELDS = ("secondary_metrics", "key_libraries_mentioned", "original_links", "local_setup_log")
NOT_AVAILABLE = "N/A"
UNKNOWN_FORMAT = "unknown"

# Libraries every project needs, those a data format needs, and name rules.
BASE_LIBRARIES = ("joblib", "pandas", "scikit-learn", "tqdm")
FORMAT_LIBRARIES = {
    ".nc": ("xarray", "netCDF4"),
    ".h5": ("h5py",),
    ".hdf5": ("h5py",),
    ".parquet": ("pyarrow",),
    ".grib": ("cfgrib", "eccodes"),
    ".grib2": ("cfgrib", "eccodes"),
}


def _field_type(name: str) -> T.DataType:
    if name in LIST_FIELDS:
        return T.ArrayType(T.StringType())
    if name == "file_formats":
        return T.MapType(T.StringType(), T.LongType())
    return T.LongType() if name == "file_count" else T.StringType()


TASK_SCHEMA = T.StructType(
    [
        T.StructField(section, T.StructType([T.StructField(f, _field_type(f)) for f in fields]))
        for section, fields in TASK_SECTIONS.items()
    ]
)


# --- tables ----------------------------------------------------------------------------


def merge_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    """Append tables by column name; missing columns become null.

    A column that is numeric everywhere but of different types becomes a double.
    """
    types: dict[str, list[T.DataType]] = {}
    for table in tables:
        for field in table.schema:
            types.setdefault(field.name, []).append(field.dataType)

    def aligned(table: DataFrame) -> DataFrame:
        columns = []
        for field in table.schema:
            mixed = len(set(types[field.name])) > 1
            numeric = all(isinstance(t, T.NumericType) for t in types[field.name])
            column = F.col(f"`{field.name}`")
            if mixed:
                column = column.cast("double" if numeric else "string").alias(field.name)
            columns.append(column)
        return table.select(*columns)

    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [aligned(t) for t in tables]
    )


def hide_target(
    split: DataFrame, id_col: str, target: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, test, answer) of a split table: only train and answer show the target."""
    train = split.filter(F.col("split") == TRAIN).drop("split")
    held_out = split.filter(F.col("split") == TEST).drop("split")
    return train, held_out.drop(target), held_out.select(id_col, target)


def placeholder(train: DataFrame, target: str) -> float | str | None:
    """Constant guess: mean of a numeric target, else its most frequent value."""
    if isinstance(train.schema[target].dataType, T.NumericType):
        return train.agg(F.avg(target)).first()[0]
    return majority(train, target)


def majority(train: DataFrame, target: str):
    """Most frequent value, the smallest on a tie."""
    counts = train.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.min_by(target, F.struct(-F.col("n"), F.col(target)))).first()[0]


def sample_submission(test: DataFrame, train: DataFrame, id_col: str, target: str) -> DataFrame:
    """Ids of the test rows with a constant in place of the target."""
    return test.select(id_col, F.lit(placeholder(train, target)).alias(target))


# --- records, requirements and reports -------------------------------------------------


def fill_defaults(task: str | Column = "task") -> Column:
    """The task definition with every absent field set to its default."""
    task = F.col(task) if isinstance(task, str) else task

    def filled(section: str, name: str) -> Column:
        value = task[section][name]
        if name in LIST_FIELDS:
            default = F.array().cast("array<string>")
        elif name == "file_formats":
            default = F.create_map().cast("map<string,bigint>")
        elif name == "file_count":
            default = F.lit(0).cast("bigint")
        else:
            default = F.lit(UNKNOWN_FORMAT if name == "primary_format" else NOT_AVAILABLE)
        return F.coalesce(value, default).alias(name)

    return F.struct(
        *[
            F.struct(*[filled(section, f) for f in fields]).alias(section)
            for section, fields in TASK_SECTIONS.items()
        ]
    )


def task_record(
    title: Column, url: Column, definition: Column, profile: Column, sources: Column
) -> Column:
    """Final task record as JSON text: source, the model's sections, profile and sources."""
    sections = [definition[s].alias(s) for s in TASK_SECTIONS if s not in _ASSEMBLED]
    return F.to_json(
        F.struct(
            F.struct(title.alias("title"), url.alias("url")).alias("source_paper"),
            *sections,
            profile.alias("data_profile"),
            sources.alias("data_sources"),
        )
    )


_ASSEMBLED = ("source_paper", "data_profile", "data_sources")


def with_extra_keys(record: Column, reply: Column) -> Column:
    """A JSON object with the keys of another one that it does not have, values untouched."""
    extra = F.map_filter(
        F.from_json(reply, "map<string,variant>"),
        lambda key, _: ~key.isin(*TASK_SECTIONS, *_ASSEMBLED),
    )
    more = F.concat(F.expr("','"), F.substr(F.to_json(extra), F.lit(2)))
    merged = F.concat(F.substr(record, F.lit(1), F.length(record) - 1), more)
    return F.when(F.size(extra) > 0, merged).otherwise(record)


def library_names(library: Column) -> Column:
    """Installable names for a library mentioned in a paper."""
    name = F.lower(library)

    def names(*items: str) -> Column:
        return F.array(*[F.lit(i) for i in items])

    return (
        F.when(F.contains(name, F.lit("torch")), names("torch", "torchvision"))
        .when(
            F.contains(name, F.lit("tensorflow")) | F.contains(name, F.lit("keras")),
            names("tensorflow"),
        )
        .when(F.contains(name, F.lit("hugging")), names("transformers", "datasets"))
        .otherwise(F.array(name))
    )


def requirements(formats: Column, libraries: Column) -> Column:
    """Sorted distinct libraries for a set of data formats and a list of mentioned libraries.

    The format table is a small constant, so the lookup happens inside the row.
    """
    base = F.array(*[F.lit(b) for b in BASE_LIBRARIES])
    lookup = F.create_map(
        *[
            item
            for fmt, libs in FORMAT_LIBRARIES.items()
            for item in (F.lit(fmt), F.array(*[F.lit(x) for x in libs]))
        ]
    )
    nothing = F.array().cast("array<string>")
    for_formats = F.transform(
        F.coalesce(formats, nothing), lambda f: F.coalesce(F.try_element_at(lookup, f), nothing)
    )
    for_libraries = F.transform(F.coalesce(libraries, nothing), library_names)
    return F.array_sort(
        F.array_distinct(F.concat(base, F.flatten(for_formats), F.flatten(for_libraries)))
    )


def report_text(task: Column) -> Column:
    """Readable description of a task definition (with defaults filled)."""
    def line(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"- {label}: "), value)

    summary, ml, profile = task["scientific_summary"], task["ml_task"], task["data_profile"]
    parts = [
        F.lit("# Benchmark task"),
        F.lit("## Source"),
        line("Title", task["source_paper"]["title"]),
        line("URL", task["source_paper"]["url"]),
        F.lit("## Background"),
        summary["background"],
        F.lit("## Goal"),
        summary["hypothesis_or_goal"],
        F.lit("## Methods"),
        F.concat(F.lit("  "), indent_lines(summary["methodology_summary"])),
        F.lit("## Results"),
        F.concat(F.lit("  "), indent_lines(summary["key_results"])),
        F.lit("## Task"),
        line("Type", ml["task_type"]),
        line("Problem", ml["problem_statement"]),
        line("Metric", task["evaluation_criteria"]["primary_metric"]),
        F.lit("## Data"),
        line("Raw data", task["data_sources"]["raw_data_path"]),
        line("Primary format", profile["primary_format"]),
        line("Formats", F.to_json(profile["file_formats"])),
    ]
    return F.concat_ws("\n", *parts)
