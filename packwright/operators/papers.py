"""From paper pages to task records, a whole batch at a time.

A paper that fails stays in the batch with a reason; it never stops the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packwright.functions.jsontext import OK, recover_object
from packwright.functions.text import prompt_context, route_link, slug
from packwright.operators.assets import page_record
from packwright.operators.inference import Provider, infer_batch
from packwright.operators.joins import join_unique
from packwright.operators.package import TASK_SCHEMA, fill_defaults, task_record, with_extra_keys
from packwright.operators.profile import UNKNOWN_FORMAT
from packwright.sources.checkpoints import checkpointed

# Lengths of folder names.
PAPER_FOLDER_CHARACTERS = 80
PROJECT_FOLDER_CHARACTERS = 50


def paper_tasks(
    pages: DataFrame, instructions: str, provider: Provider, html: str = "html"
) -> DataFrame:
    """Page record, reply and task definition of each page.

    Adds ``folder, task, reply, status, reason`` to the page record; ``reply`` is the JSON text
    of the answer. An answer with an ``error`` key is a failed request, whatever else it holds.
    The provider is asked once per distinct context. Page records are checkpointed, so that
    each page is parsed once.
    """
    papers = checkpointed(
        page_record(pages, html).withColumnsRenamed({"status": "__page", "reason": "__page_reason"})
    )
    context = prompt_context(
        *[F.col(c) for c in ("title", "abstract", "methods", "results", "captions")]
    )
    asked = infer_batch(
        papers.withColumns({"__prompt": F.lit(instructions), "__context": context}),
        "__prompt",
        "__context",
        provider,
    ).withColumnsRenamed({"status": "__asked", "reason": "__error"})
    recovered = recover_object(asked, "answer", TASK_SCHEMA, fenced=True)
    told = F.when(F.col("status") == OK, F.get_json_object("json_text", "$.error"))
    unread = F.col("__page") != OK
    failed = unread | (F.col("__asked") != "ok") | told.isNotNull()
    folder = F.concat(F.lit("paper_"), slug(F.col("title"), PAPER_FOLDER_CHARACTERS))
    return recovered.select(
        *[c for c in papers.columns if not c.startswith("__")],
        folder.alias("folder"),
        F.when(~failed, F.col("value")).alias("task"),
        F.when(~failed, F.col("json_text")).alias("reply"),
        F.when(failed, "error").otherwise(F.col("status")).alias("status"),
        F.when(failed, F.coalesce("__page_reason", "__error", told)).otherwise(F.col("reason")).alias("reason"),
    )


def setup_log(links: Column) -> Column:
    """What has to happen for each link of a paper, in link order."""
    return F.transform(links, lambda link: F.concat(route_link(link), F.lit(": "), link))


def final_records(tasks: DataFrame, profiles: DataFrame, url: str = "url") -> DataFrame:
    """Task records as JSON for the papers that succeeded: ``folder, record``.

    ``profiles`` comes from ``dataset_profile`` with the paper's folder as its dataset; a
    paper without data has an empty profile. Keys of the reply beyond the known sections are
    kept as they are.
    """
    done = tasks.filter(F.col("status") == "ok").withColumn("dataset", F.col("folder"))
    joined = join_unique(done, profiles, ["dataset"], "left")
    no_formats = F.create_map().cast("map<string,bigint>")
    profile = F.struct(
        F.coalesce("file_formats", no_formats).alias("file_formats"),
        F.coalesce("primary_format", F.lit(UNKNOWN_FORMAT)).alias("primary_format"),
        F.coalesce("file_count", F.lit(0)).alias("file_count"),
    )
    sources = F.struct(
        F.concat(F.col("folder"), F.lit("/data")).alias("raw_data_path"),
        F.col("availability_links").alias("original_links"),
        setup_log(F.col("availability_links")).alias("local_setup_log"),
    )
    record = task_record(F.col("title"), F.col(url), fill_defaults("task"), profile, sources)
    record = with_extra_keys(record, F.col("reply"))
    return joined.select("folder", record.alias("record"))


def project_folder(title: Column) -> Column:
    """Folder of the benchmark project made from a task."""
    return F.concat(F.lit("benchmark_"), slug(title, PROJECT_FOLDER_CHARACTERS))
