"""Rows for the parts of a document: pages, tables, figures, code and repository files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from packwright.functions import html as H
from packwright.functions import text as X
from packwright.functions.jsontext import OK, QUARANTINED, is_strict_json, recover_list
from packwright.operators.joins import triage_join
from packwright.sources.shipping import ship

# The record a repository returns for one deposit.
RECORD_SCHEMA = (
    "files array<struct<key: string, size: bigint, links: struct<self: string>>>"
)

# Directory names that mark a ready-made split, in order of preference.
TRAIN_DIRECTORIES = ("train", "training")
TEST_DIRECTORIES = ("test", "testing", "validation", "val")


def page_record(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add title, abstract, methods, results, captions and repository links of each page.

    ``status`` is ``ok``, or ``quarantined`` with a ``reason`` for a page that cannot be parsed.
    """
    ship(pages.sparkSession)
    sections = H.page_sections(F.col(html))
    links = H.repository_links(F.col(html))
    return (
        pages.withColumn("__sections", sections)
        .withColumn("title", H.page_title(F.col(html)))
        .withColumn("availability_links", links)
        .select(
            *[c for c in pages.columns if c != html],
            "title",
            F.col("__sections.abstract").alias("abstract"),
            F.col("__sections.methods").alias("methods"),
            F.col("__sections.results").alias("results"),
            F.col("__sections.captions").alias("captions"),
            "availability_links",
            F.col("__sections.status").alias("status"),
            F.col("__sections.reason").alias("reason"),
        )
    )


def link_rows(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """One row per distinct repository link of each page."""
    return pages.select(key, F.explode(H.repository_links(F.col(html))).alias("link"))


def caption_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per numbered caption, with its 0-based ordinal in the document."""
    captions = X.numbered_captions(F.col(text))
    return docs.select(key, F.posexplode(captions).alias("ordinal", "c")).select(
        key, F.col("ordinal").cast("bigint").alias("ordinal"), "c.number", "c.caption"
    )


def pair_images(docs: DataFrame, key: str, images: str, text: str) -> DataFrame:
    """One row per image with the caption at the same position of the document.

    Images and text of a document arrive in one row, so the pairing needs no join: image
    ``i`` takes caption ``i``, and images beyond the captions take the default text.
    """
    return (
        docs.select(key, images, X.numbered_captions(F.col(text)).alias("__captions"))
        .select(key, "__captions", F.posexplode(images).alias("ordinal", "image"))
        .select(
            key,
            F.col("ordinal").cast("bigint").alias("ordinal"),
            "image",
            X.caption_context(F.col("__captions"), F.col("ordinal")).alias("context"),
        )
    )


def pair_image_rows(images: DataFrame, captions: DataFrame, key: str) -> DataFrame:
    """The same pairing for images and captions that are tables keyed by ``(key, ordinal)``."""
    context = F.concat(F.lit("Fig. "), F.col("number"), F.lit(": "), F.col("caption"))
    return (
        images.join(captions, [key, "ordinal"], "left")
        .withColumn("context", F.coalesce(context, F.lit(X.NO_CAPTION)))
        .drop("number", "caption")
    )


def snippet_rows(snippets: DataFrame, key: str, items: str = "value") -> DataFrame:
    """One row per code snippet with its file name; names count from 1."""
    exploded = snippets.select(key, F.posexplode(items).alias("position", "s"))
    name = F.concat(
        F.format_string("code_snippet_%d", F.col("position") + 1),
        X.snippet_extension(F.col("s.description")),
    )
    return exploded.select(key, name.alias("file_name"), "s.code", "s.description")


def rows_to_cells(tables: DataFrame, keys: Sequence[str], rows: str = "rows") -> DataFrame:
    """Cells of ragged tables: row 0 is the header, tables of one row are left out.

    One row per cell ``(keys, row, position, name, value)``. Repeated header names are fine,
    since a cell is addressed by position.
    """
    header = F.get(F.col(rows), F.lit(0))
    body = F.slice(F.col(rows), 2, F.greatest(F.size(rows) - 1, F.lit(0)))
    return (
        tables.filter(F.size(rows) > 1)
        .select(*keys, header.alias("__header"), F.posexplode(body).alias("row", "__cells"))
        .select(*keys, "__header", "row", F.posexplode("__cells").alias("position", "value"))
        .select(*keys, "row", "position", F.get("__header", F.col("position")).alias("name"), "value")
    )


def table_batch(
    verdicts: DataFrame, cleaned: DataFrame, key: str = "doc_id", reply: str = "reply"
) -> DataFrame:
    """Rows of the chosen tables of many documents, each table numbered by ``Id`` from 0.

    ``verdicts`` has ``key, table_index, suggested_filename``; ``cleaned`` has ``key,
    table_index`` and the reply with the table as a JSON list of objects. The result has
    ``key, table_index, suggested_filename, status, reason, Id, values``; a verdict without its
    table, or a reply without a list, is one quarantined row. A reply is unfolded where it is.
    """
    joined = triage_join(verdicts, cleaned, key).withColumnRenamed("status", "__found")
    parsed = recover_list(joined, reply, "map<string,string>")
    missing = F.col("__found") == QUARANTINED
    status = F.when(missing, QUARANTINED).otherwise(F.col("status"))
    reason = F.when(missing, "no such table").otherwise(F.col("reason"))
    kept = (key, "table_index", "suggested_filename")
    return parsed.select(
        *kept,
        status.alias("status"),
        reason.alias("reason"),
        F.posexplode_outer(F.when(status == OK, F.col("value"))).alias("Id", "values"),
    )


def table_profiles(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per column of every table: values, numbers among them, and their mean, minimum, maximum.

    ``cells`` comes from :func:`rows_to_cells`; all tables are profiled in one aggregation that
    combines before its shuffle.
    """
    number = F.col("value").try_cast("double")
    number = F.when(~F.isnan(number), number)
    return cells.groupBy(*keys, "position", "name").agg(
        F.count("value").alias("non_null"),
        F.count(number).alias("numbers"),
        F.avg(number).alias("mean"),
        F.min(number).alias("min"),
        F.max(number).alias("max"),
        (F.max("row") + 1).alias("rows"),
    )


def table_reports(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One exploration text per table: columns, size, and a line for every column."""

    def shown(column: str) -> Column:
        return F.coalesce(F.col(column).cast("decimal(38,2)").cast("string"), F.lit("-"))

    facts = ["non_null", "numbers", "mean", "min", "max"]
    texts = [F.col(c).cast("string") if c in ("non_null", "numbers") else shown(c) for c in facts]
    labelled = [t for c, x in zip(facts, texts) for t in (F.lit(f" {c} "), x)]
    line = F.concat(F.lit("- "), F.coalesce("name", F.lit("?")), F.lit(":"), *labelled)
    gathered = table_profiles(cells, keys).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("position", "name", line.alias("line")))).alias("c"),
        F.max("rows").alias("rows"),
    )
    names = F.array_join(F.col("c.name"), ", ", "?")
    size = F.concat(F.col("rows").cast("string"), F.lit(" rows, "), F.size("c").cast("string"), F.lit(" columns"))
    report = F.concat_ws("\n", F.concat(F.lit("Columns: "), names), size, F.array_join(F.col("c.line"), "\n"))
    return gathered.select(*keys, report.alias("report"))


def table_preview(rows: DataFrame, key: str, order: str, line: Column, limit: int = 5) -> DataFrame:
    """First ``limit`` lines of each table as one text.

    The row number is limited before the shuffle, so a large table sends ``limit`` rows per
    task.
    """
    window = Window.partitionBy(key).orderBy(order)
    return (
        rows.select(key, order, line.alias("line"))
        .withColumn("rn", F.row_number().over(window))
        .filter(F.col("rn") <= limit)
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct("rn", "line"))).alias("lines"))
        .select(key, F.array_join(F.col("lines.line"), "\n").alias("preview"))
    )


def head_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int = 5) -> DataFrame:
    """First ``limit`` rows of each table."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn("rn", F.row_number().over(window))
        .filter(F.col("rn") <= limit)
        .drop("rn")
    )


def first_item(rows: DataFrame, key: str, position: str) -> DataFrame:
    """The row with the smallest position of each group."""
    others = [c for c in rows.columns if c != key]
    first = F.min_by(F.struct(*others), F.col(position))
    return rows.groupBy(key).agg(first.alias("first")).select(key, "first.*")


def record_files(records: DataFrame, keys: Sequence[str], json: str) -> DataFrame:
    """One row per file of each repository record.

    Records that give none are kept aside by :func:`unreadable_records`.
    """
    text = F.col(json)
    parsed = F.when(is_strict_json(text), F.from_json(text, RECORD_SCHEMA))
    files = F.posexplode(parsed["files"]).alias("position", "f")
    return records.select(*keys, files).select(
        *keys,
        "position",
        F.col("f.key").alias("key"),
        F.col("f.size").alias("size"),
        F.col("f.links.self").alias("link"),
        X.sanitize(F.col("f.key")).alias("local_name"),
    )


def unreadable_records(records: DataFrame, keys: Sequence[str], json: str) -> DataFrame:
    """Repository records without files that can be read: ``keys, reason, json_text``.

    The reason is ``missing`` for null or blank text, ``not json``, ``not an object``, ``wrong
    type`` where the list or its entries are something else, or ``no files``.
    """
    text = F.col(json)
    valid = is_strict_json(text)
    variant = F.when(valid, F.try_parse_json(text))
    files = F.schema_of_variant(F.variant_get(variant, "$.files", "variant"))
    parsed = F.when(valid, F.from_json(text, RECORD_SCHEMA))["files"]
    reason = (
        F.when(text.isNull() | (F.trim(text) == ""), "missing")
        .when(~F.coalesce(valid, F.lit(False)), "not json")
        .when(~F.startswith(F.ltrim(text), F.lit("{")), "not an object")
        .when(files.isNull() | files.isin("VOID", "ARRAY<VOID>"), "no files")
        .when(parsed.isNull() | ~F.startswith(files, F.lit("ARRAY<OBJECT")), "wrong type")
    )
    return records.select(*keys, reason.alias("reason"), text.alias("json_text")).where("reason is not null")


def first_zip(files: DataFrame, record: str) -> DataFrame:
    """First file of each record whose name ends in ``.zip``."""
    zips = files.filter(F.endswith("key", F.lit(".zip")))
    return first_item(zips, record, "position")


def _preferred(directory: Column, names: Sequence[str]) -> Column:
    rank = F.array_position(F.array(*[F.lit(n) for n in names]), directory)
    return F.min_by(F.when(rank > 0, directory), F.when(rank > 0, rank))


def detect_presplit(manifest: DataFrame, by: str = "dataset", rel_path: str = "rel_path") -> DataFrame:
    """Per dataset: the preferred train and test directory, and whether both exist."""
    top = F.when(
        F.contains(rel_path, F.lit("/")), F.substring_index(F.col(rel_path), "/", 1)
    )
    return (
        manifest.select(by, top.alias("top"))
        .groupBy(by)
        .agg(
            _preferred(F.col("top"), TRAIN_DIRECTORIES).alias("train_dir"),
            _preferred(F.col("top"), TEST_DIRECTORIES).alias("test_dir"),
        )
        .withColumn("presplit", F.col("train_dir").isNotNull() & F.col("test_dir").isNotNull())
    )


def explode_proposals(tables: DataFrame, key: str, table_index: str, proposals: str) -> DataFrame:
    """One row per proposal of each table, with the package names (indexes count from 1)."""
    number = (F.col("position") + 1).alias("proposal_index")
    return (
        tables.select(key, table_index, F.posexplode(proposals).alias("position", "p"))
        .select(key, table_index, number, "p.*")
        .withColumn(
            "package",
            X.competition_package(F.col(table_index), F.col("proposal_index"), F.col("prediction_target")),
        )
        .withColumn(
            "work_name", X.proposal_package(F.col(table_index), F.col("proposal_index"))
        )
    )
