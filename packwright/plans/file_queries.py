"""Queries on files, packages and joins between listings; readers and writers."""

from __future__ import annotations

from pyspark.sql import functions as F

from packwright.operators import profile, split, verify
from packwright.operators.assets import rows_to_cells
from packwright.operators.inference import infer_batch as infer
from packwright.operators.inference import infer_resumed as infer_stored
from packwright.operators.joins import listed_files as mark_listed
from packwright.operators.joins import skip_processed as skip
from packwright.operators.joins import triage_join as triage
from packwright.operators.package import TASK_SCHEMA
from packwright.operators.papers import final_records, paper_tasks
from packwright.plans.registry import query
from packwright.plans.table_queries import _RANDOM_ORDERS
from packwright.plans.templates import table, template, with_template
from packwright.sources import publish, readers, writers
from packwright.sources.checkpoints import checkpointed, scratch_folder

# --- file collections ------------------------------------------------------------------

_HISTOGRAM = "SELECT dataset, lower(ext) AS ext, count(*) AS n FROM t GROUP BY 1, 2"
_DATA = "['.csv','.nc','.h5','.hdf5','.jsonl','.json','.parquet','.tsv','.dat','.grib','.grib2']"
_PRIMARY = f"""coalesce(arg_min(ext, (-n, list_position({_DATA}, ext))) FILTER (list_position({_DATA}, ext) > 0), 'unknown')"""


@query(with_template("manifest", _HISTOGRAM))
def format_histogram(spark, sf_dir):
    return profile.format_histogram(template(spark, sf_dir, "manifest"))


@query(with_template("manifest", f"SELECT dataset, {_PRIMARY} AS primary_format FROM ({_HISTOGRAM}) h GROUP BY 1"))
def primary_format(spark, sf_dir):
    return profile.primary_format(template(spark, sf_dir, "manifest"))


@query(with_template("manifest", f"""SELECT dataset, cast(sum(n) AS BIGINT) AS file_count,
  coalesce(string_agg(ext || '=' || n, ',' ORDER BY ext) FILTER (ext <> ''), '') AS file_formats, {_PRIMARY} AS primary_format FROM ({_HISTOGRAM}) h GROUP BY 1"""))
def dataset_profile(spark, sf_dir):
    found = profile.dataset_profile(template(spark, sf_dir, "manifest"))
    entries = F.transform(
        F.sort_array(F.map_entries("file_formats")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return found.withColumn("file_formats", F.array_join(entries, ","))


# --- joins between listings ------------------------------------------------------------


@query("""WITH v AS (SELECT doc_id, doc_id % 4 AS table_index, 'reason ' || lang AS justification FROM documents),
t AS (SELECT doc_id, i AS table_index, source || i AS name FROM documents, (VALUES (1), (2)) x(i))
SELECT doc_id, table_index, justification, name, CASE WHEN name IS NULL THEN 'quarantined' ELSE 'ok' END AS status
FROM v LEFT JOIN t USING (doc_id, table_index)""")
def triage_join(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    verdicts = documents.select(
        "doc_id",
        (F.col("doc_id") % 4).alias("table_index"),
        F.concat(F.lit("reason "), F.col("lang")).alias("justification"),
    )
    index = F.explode(F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint"))).alias("table_index")
    tables = documents.select("doc_id", "source", index)
    named = tables.withColumn("name", F.concat("source", F.col("table_index").cast("string")))
    return triage(verdicts, named.drop("source"))


@query(with_template("manifest", """
, l AS (SELECT path FROM t UNION ALL SELECT path || '.bak' FROM t WHERE length % 3 = 0)
SELECT path, EXISTS (SELECT 1 FROM t WHERE t.path = l.path) AS present FROM l"""))
def listed_files(spark, sf_dir):
    files = template(spark, sf_dir, "manifest").select("path", "length")
    spare = files.filter("length % 3 = 0").select(F.concat("path", F.lit(".bak")).alias("path"))
    return mark_listed(files.select("path").union(spare), files, ["path"])


@query(with_template("links", """
, done AS (SELECT link FROM t WHERE doc_id % 5 = 0)
SELECT doc_id, link FROM t WHERE link NOT IN (SELECT link FROM done)"""))
def skip_processed(spark, sf_dir):
    links = template(spark, sf_dir, "links")
    return skip(links, links.filter("doc_id % 5 = 0"), ["link"])


# --- package checks --------------------------------------------------------------------

_PATHS = "(VALUES {}) r(path)"
_DIRECTORY_VALUES = ", ".join(f"('{d}')" for d in verify.REQUIRED_DIRECTORIES)
_FILE_VALUES = ", ".join(f"('{f}')" for f in verify.REQUIRED_FILES)
_FINDINGS = "SELECT package, 1 AS stage, '{}' AS \"check\", 'error' AS severity, '{} ' || path AS message"
_LAYOUT = with_template("package", f"""
, p AS (SELECT DISTINCT package FROM t),
x AS (SELECT DISTINCT package, path FROM t JOIN {_PATHS.format(_DIRECTORY_VALUES)} ON (is_dir AND rel_path = path) OR starts_with(rel_path, path || '/'))
{_FINDINGS.format('layout', 'missing directory')} FROM (SELECT package, path FROM p, {_PATHS.format(_DIRECTORY_VALUES)} EXCEPT SELECT * FROM x) m""")
_FILES = with_template("package", f"""
, p AS (SELECT DISTINCT package FROM t), x AS (SELECT package, rel_path FROM t WHERE NOT is_dir)
{_FINDINGS.format('files', 'missing file')} FROM (SELECT package, path FROM p, {_PATHS.format(_FILE_VALUES)} EXCEPT SELECT * FROM x) m""")


@query(_LAYOUT)
def layout_check(spark, sf_dir):
    return verify.layout_findings(template(spark, sf_dir, "package"))


@query(_FILES)
def missing_files(spark, sf_dir):
    return verify.file_findings(template(spark, sf_dir, "package"))


@query(with_template("source", """
SELECT 'd' || doc_id AS package, CASE doc_id % 6 WHEN 2 THEN 'prepare takes 2 arguments, not 3' WHEN 4 THEN 'no function prepare'
  WHEN 3 THEN 'no class based on BaseMetric' ELSE 'cannot parse: SyntaxError' END AS message FROM documents WHERE doc_id % 6 > 1"""))
def code_interface(spark, sf_dir):
    found = verify.interface_findings(template(spark, sf_dir, "source"))
    return found.select("package", "message")


def _reviews(spark, sf_dir):
    replies = template(spark, sf_dir, "code")
    return replies.select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("package"),
        F.when(F.col("turn") % 2 == 0, "description").otherwise("metric").alias("check"),
        F.col("verdict").alias("reply"),
    )


_REVIEWS = with_template("code", """
SELECT 'c' || conv_id AS package, 2 AS stage, CASE WHEN turn % 2 = 0 THEN 'description' ELSE 'metric' END AS "check",
  CASE WHEN starts_with(upper(trim(verdict)), 'FAIL') THEN 'error' ELSE 'warning' END AS severity, verdict AS message
FROM t WHERE upper(trim(verdict)) LIKE 'FAIL%' OR upper(trim(verdict)) LIKE 'WARN%'""")


@query(_REVIEWS)
def review_findings(spark, sf_dir):
    return verify.review_findings(_reviews(spark, sf_dir))


@query(f"""WITH f AS (SELECT * FROM ({_LAYOUT}) a UNION ALL SELECT * FROM ({_FILES}) b UNION ALL SELECT * FROM ({_REVIEWS}) c),
p AS (SELECT 'c' || c_custkey AS package FROM customer),
n AS (SELECT p.package, count(*) FILTER (stage = 1 AND severity = 'error') AS e1, count(*) FILTER (stage = 2 AND severity = 'error') AS e2,
  count(*) FILTER (stage = 2 AND severity = 'warning') AS w2 FROM p LEFT JOIN f USING (package) GROUP BY 1)
SELECT package, 1 AS stage, true AS reached, e1 = 0 AS passed, e1 AS errors, cast(0 AS BIGINT) AS warnings FROM n
UNION ALL SELECT package, 2, e1 = 0, e1 = 0 AND e2 = 0, e2, w2 FROM n
UNION ALL SELECT package, 3, e1 = 0 AND e2 = 0, e1 = 0 AND e2 = 0, 0, 0 FROM n""")
def stage_gate(spark, sf_dir):
    listing = template(spark, sf_dir, "package")
    findings = (
        verify.layout_findings(listing)
        .unionByName(verify.file_findings(listing))
        .unionByName(verify.review_findings(_reviews(spark, sf_dir)))
    )
    return verify.gate(findings, listing)


@query("""WITH s AS (SELECT 's' || source AS package, lang, count(*) AS n FROM documents GROUP BY 1, 2),
h AS (SELECT package, max(n) / sum(n) AS top_share FROM s GROUP BY 1),
t AS (SELECT 's' || source AS package, CASE WHEN doc_id % 2 = 0 THEN 'classification' ELSE 'regression' END AS task_type,
  CASE doc_id % 3 WHEN 0 THEN 'RMSE' WHEN 1 THEN 'Accuracy' ELSE 'F1' END AS metric FROM documents),
j AS (SELECT package, task_type, lower(metric) AS metric, top_share FROM t JOIN h USING (package))
SELECT package, CASE WHEN wrong THEN 'error' ELSE 'warning' END AS severity,
  CASE WHEN wrong THEN metric || ' does not fit ' || task_type ELSE 'accuracy on unbalanced labels' END AS message FROM (
  SELECT *, (task_type = 'classification' AND metric = 'rmse') OR (task_type = 'regression' AND metric <> 'rmse') AS wrong FROM j) w
WHERE wrong OR (task_type = 'classification' AND metric = 'accuracy' AND top_share >= 0.4)""")
def metric_fit(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.concat(F.lit("s"), F.col("source")).alias("package")
    )
    kind = F.when(F.col("doc_id") % 2 == 0, "classification").otherwise("regression")
    third = F.col("doc_id") % 3
    metric = F.when(third == 0, "RMSE").when(third == 1, "Accuracy").otherwise("F1")
    tasks = documents.select("package", kind.alias("task_type"), metric.alias("metric"))
    shares = verify.label_share(documents, "lang")
    found = verify.metric_findings(tasks, shares, imbalance=0.4)
    return found.select("package", "severity", "message")


# --- readers and writers ---------------------------------------------------------------


@query("SELECT url, count(*) AS n FROM pages GROUP BY url")
def url_list(spark, sf_dir):
    folder = scratch_folder(spark)
    pages = table(spark, sf_dir, "pages")
    padded = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("  "), "url", F.lit("\t\n \n"))).otherwise(F.col("url"))
    writers.write_text(pages, padded, folder)
    return readers.read_url_list(spark, folder).groupBy("url").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT 'csv' AS kind, s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
UNION ALL SELECT 'tsv', s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
UNION ALL SELECT 'parquet', s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""")
def delimited_roundtrip(spark, sf_dir):
    folder = scratch_folder(spark)
    supplier = table(spark, sf_dir, "supplier")
    writers.write_delimited(supplier, f"{folder}/csv")
    writers.write_delimited(supplier, f"{folder}/tsv", sep="\t")
    writers.write_parquet(supplier, f"{folder}/parquet")
    parts = {
        "csv": readers.read_delimited(spark, f"{folder}/csv", schema=supplier.schema),
        "tsv": readers.read_delimited(spark, f"{folder}/tsv", "\t", supplier.schema),
        "parquet": readers.read_parquet(spark, f"{folder}/parquet"),
    }
    named = [part.withColumn("kind", F.lit(kind)) for kind, part in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_pieces(spark, sf_dir):
    # A session of its own with small blocks, so that each file is read by many tasks at any scale.
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(256 << 10))
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    # One file per task of the scan: the table passes through no single task.
    folder, documents = scratch_folder(spark), table(spark, sf_dir, "documents")
    writers.write_delimited(documents, folder)
    return readers.read_delimited(session, folder, schema=documents.schema)


@query("""SELECT c_custkey AS col_0, c_acctbal AS col_1, c_mktsegment AS col_2, CASE WHEN c_custkey % 4 <> 0 THEN c_nationkey::DOUBLE END AS col_3 FROM customer""")
def ws_table(spark, sf_dir):
    folder = scratch_folder(spark)
    key = F.col("c_custkey").cast("string")
    short = F.col("c_custkey") % 4 == 0
    last = F.when(~short, F.concat(F.lit(" "), F.col("c_nationkey").cast("string"))).otherwise("")
    line = F.concat(F.lit(" "), key, F.lit("  "), F.col("c_acctbal").cast("string"), F.lit("\t"), F.col("c_mktsegment"), last)
    # A file's first line fixes its width, so full lines go first.
    customers = table(spark, sf_dir, "customer").sortWithinPartitions(short)
    writers.write_text(customers, line, folder)
    return readers.read_ws_table(spark, folder).drop("file")


@query("""SELECT c_custkey AS id, c_custkey % 3 AS part, CASE c_custkey % 3 WHEN 2 THEN 'STRING' WHEN 1 THEN 'DOUBLE' ELSE 'BIGINT' END AS kind,
  CASE c_custkey % 3 WHEN 2 THEN '"n' || c_nationkey || '"' WHEN 1 THEN (c_nationkey + 0.5)::VARCHAR ELSE c_nationkey::VARCHAR END AS cell FROM customer""")
def ws_table_types_per_file(spark, sf_dir):
    folder, part = scratch_folder(spark), F.col("c_custkey") % 3
    nation = F.col("c_nationkey")
    cell = F.when(part == 2, F.concat(F.lit("n"), nation)).when(part == 1, F.concat(nation, F.lit(".5"))).otherwise(nation.cast("string"))
    customers = table(spark, sf_dir, "customer").select(part.alias("part"), F.concat_ws(" ", "c_custkey", cell).alias("value"))
    customers.repartition("part").write.partitionBy("part").text(folder)
    found = readers.read_ws_table(spark, folder, per_file=True)
    part = F.regexp_extract("file", "part=([0-9])", 1).cast("bigint")
    kind = F.schema_of_variant("col_1")
    return found.select(F.col("col_0").cast("bigint").alias("id"), part.alias("part"), kind.alias("kind"), F.to_json("col_1").alias("cell"))


@query("""WITH d AS (SELECT s_nationkey, count(*) AS n, string_agg(s_name, ',' ORDER BY s_name) AS libraries FROM supplier GROUP BY 1)
SELECT CASE WHEN s_nationkey % 4 <> 0 THEN 'nation ' || s_nationkey END AS title, CASE WHEN s_nationkey % 4 <> 0 THEN libraries END AS libraries,
  CASE WHEN s_nationkey % 4 <> 0 THEN 'ok' ELSE 'quarantined' END AS status FROM d""")
def task_definitions(spark, sf_dir):
    folder = scratch_folder(spark)
    names = F.sort_array(F.collect_list("s_name")).alias("key_libraries_mentioned")
    grouped = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(names)
    title = F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("title")
    record = F.to_json(
        F.struct(
            F.struct(title).alias("source_paper"),
            F.struct("key_libraries_mentioned").alias("model_details"),
        )
    )
    cut = F.when(F.col("s_nationkey") % 4 == 0, F.concat(record, F.lit(" and more"))).otherwise(record)
    grouped.select("s_nationkey", cut.alias("value")).repartition("s_nationkey").write.partitionBy(
        "s_nationkey"
    ).text(folder)
    read = readers.read_task_definitions(spark, f"{folder}/*")
    libraries = F.array_join("task.model_details.key_libraries_mentioned", ",")
    return read.select(F.col("task.source_paper.title").alias("title"), libraries.alias("libraries"), "status")


@query(with_template("captions", """
SELECT doc_id, r AS "row", p AS position, CASE p WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'a' END AS name,
  CASE p WHEN 0 THEN lang WHEN 1 THEN source ELSE cast(doc_id AS VARCHAR) END || CASE WHEN p < 2 THEN cast(r AS VARCHAR) ELSE '' END AS value
FROM documents, (VALUES (0), (1)) x(r), (VALUES (0), (1), (2)) y(p) WHERE doc_id % 3 > r AND NOT (r = 1 AND p = 2)"""))
def row_arrays(spark, sf_dir):
    def row(number: int, *extra):
        text = F.lit(str(number))
        return F.array(F.concat("lang", text), F.concat("source", text), *extra)

    header = F.array(F.lit("a"), F.lit("b"), F.lit("a"))
    first = row(0, F.col("doc_id").cast("string"))
    size = F.col("doc_id") % 3
    rows = F.when(size == 0, F.array(header)).when(size == 1, F.array(header, first))
    tables = table(spark, sf_dir, "documents").select(
        "doc_id", rows.otherwise(F.array(header, first, row(1))).alias("rows")
    )
    return rows_to_cells(tables, ["doc_id"])


@query(f"""WITH s AS ({_RANDOM_ORDERS})
SELECT 'public/train' AS part, o_orderkey, o_custkey, o_totalprice FROM s WHERE split = 'train'
UNION ALL SELECT 'public/test', o_orderkey, o_custkey, NULL FROM s WHERE split = 'test'
UNION ALL SELECT 'public/sample_submission', o_orderkey, NULL, (SELECT round(avg(o_totalprice), 4) FROM s WHERE split = 'train') FROM s WHERE split = 'test'
UNION ALL SELECT 'private/test_answer', o_orderkey, NULL, o_totalprice FROM s WHERE split = 'test'""")
def package_roundtrip(spark, sf_dir):
    folder = scratch_folder(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    parts = split.random_split(orders, "o_orderkey")
    writers.write_package(parts, folder, "o_orderkey", "o_totalprice")
    key, customer, price = "o_orderkey bigint", "o_custkey bigint", "o_totalprice double"
    layout = {
        writers.TRAIN_PATH: [key, customer, price],
        writers.TEST_PATH: [key, customer],
        writers.SAMPLE_PATH: [key, price],
        writers.ANSWER_PATH: [key, price],
    }
    read = [
        readers.read_delimited(spark, f"{folder}/{path}", schema=", ".join(columns)).withColumn("part", F.lit(path))
        for path, columns in layout.items()
    ]
    whole = read[0]
    for part in read[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    is_sample = F.col("part") == writers.SAMPLE_PATH
    price = F.when(is_sample, F.round("o_totalprice", 4)).otherwise(F.col("o_totalprice"))
    return whole.withColumn("o_totalprice", price)


@query("""SELECT lang AS label, CASE WHEN split = 'test' THEN 'test' ELSE 'train' END AS split, count(*) AS n FROM (
  SELECT lang, CASE WHEN row_number() OVER (ORDER BY md5('42:' || cast(doc_id AS VARCHAR))) <= (count(*) OVER () + 4) // 5 THEN 'test' ELSE 'train' END AS split FROM documents) s GROUP BY 1, 2""")
def labelled_split_roundtrip(spark, sf_dir):
    folder = scratch_folder(spark)
    files = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"))
    writers.write_labelled_split(split.random_split(files, "doc_id"), folder)
    return spark.read.parquet(folder).groupBy("label", "split").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, text, lang FROM documents")
def json_roundtrip(spark, sf_dir):
    folder = scratch_folder(spark)
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    writers.write_json_records(documents, folder)
    return spark.read.schema(documents.schema).json(folder)


@query("""SELECT source AS label, '.json' AS ext, sum(length('{"doc_id":' || doc_id || ',"lang":"' || lang || '"}') + 1)::BIGINT AS bytes, true AS marker
FROM documents GROUP BY 1""")
def manifest_scan(spark, sf_dir):
    folder = scratch_folder(spark)
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", F.concat(F.lit("l-"), "source").alias("label"))
    documents.repartition("label").write.partitionBy("label").json(folder)
    files = readers.scan_manifest(spark, folder)
    # The writer leaves an empty file with a name that a file scan would skip.
    marker = F.lit(not files.filter("rel_path = '_SUCCESS' and length = 0").isEmpty())
    label = F.replace(F.substring_index("label", "=", -1), F.lit("l-"), F.lit(""))
    data = files.filter((F.col("ext") == ".json") & ~F.contains("rel_path", F.lit("/.")))
    return data.groupBy(label.alias("label"), "ext").agg(F.sum("length").alias("bytes")).withColumn("marker", marker)


# --- papers ----------------------------------------------------------------------------


def offline_author(prompt: str, context: str) -> str:
    """Stand-in for a model that defines a task from a paper's context."""
    title = context.split("\n", 1)[0].removeprefix("Title: ")
    if title.endswith("7"):
        return "I cannot define a task."
    return f'```json\n{{"ml_task": {{"task_type": "{prompt}", "problem_statement": "{title}"}}}}\n```'


_AUTHOR = "define"


def _paper_tasks(spark, sf_dir):
    pages = template(spark, sf_dir, "html")
    url = F.concat(F.lit("http://p/"), F.col("doc_id").cast("string"))
    return paper_tasks(pages.withColumn("url", url), _AUTHOR, offline_author)


@query("""SELECT doc_id, 'paper_paper_' || doc_id AS folder, CASE WHEN doc_id % 10 = 7 THEN NULL ELSE 'Paper ' || doc_id END AS problem,
  CASE WHEN doc_id % 10 = 7 THEN 'quarantined' ELSE 'ok' END AS status FROM documents""")
def paper_batch(spark, sf_dir):
    problem = F.col("task.ml_task.problem_statement").alias("problem")
    return _paper_tasks(spark, sf_dir).select("doc_id", "folder", problem, "status")


@query("""SELECT 'paper_paper_' || doc_id AS folder, 'Paper ' || doc_id AS title, 'http://p/' || doc_id AS url, 'define' AS task_type,
  CASE WHEN doc_id % 2 = 0 THEN '.csv' ELSE 'unknown' END AS primary_format,
  'clone: https://github.com/org/' || source || '; record: https://zenodo.org/records/' || doc_id AS setup FROM documents WHERE doc_id % 10 <> 7""")
def paper_records(spark, sf_dir):
    tasks = _paper_tasks(spark, sf_dir)
    files = table(spark, sf_dir, "documents").filter("doc_id % 2 = 0").select(
        F.concat(F.lit("paper_paper_"), F.col("doc_id").cast("string")).alias("dataset"),
        F.lit("data/table.csv").alias("path"),
    )
    records = final_records(tasks, profile.dataset_profile(files))
    parsed = records.select("folder", F.from_json("record", TASK_SCHEMA).alias("r"))
    return parsed.select(
        "folder",
        "r.source_paper.title",
        "r.source_paper.url",
        "r.ml_task.task_type",
        "r.data_profile.primary_format",
        F.array_join("r.data_sources.local_setup_log", "; ").alias("setup"),
    )


# --- inference -------------------------------------------------------------------------


def offline_provider(prompt: str, context: str) -> str:
    """Stand-in for a model: answers from the request alone, and refuses one kind of it."""
    if prompt == "system":
        raise ValueError("no answer for system turns")
    return f"{prompt}:{len(context)}"


@query("""SELECT conv_id, turn, CASE WHEN role = 'system' THEN NULL ELSE role || ':' || length(text) END AS answer,
  CASE WHEN role = 'system' THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN role = 'system' THEN 'ValueError: no answer for system turns' END AS reason FROM conversations""")
def infer_batch(spark, sf_dir):
    answers = infer(table(spark, sf_dir, "conversations"), "role", "text", offline_provider)
    return answers.select("conv_id", "turn", "answer", "status", "reason")


def _second_provider(prompt: str, context: str) -> str:
    return f"second {offline_provider(prompt, context)}"


@query("""WITH asked AS (SELECT DISTINCT role, text FROM conversations WHERE turn % 2 = 0)
SELECT conv_id, turn, CASE WHEN c.role = 'system' THEN NULL WHEN a.role IS NULL THEN 'second ' || c.role || ':' || length(c.text) ELSE c.role || ':' || length(c.text) END AS answer,
  CASE WHEN c.role = 'system' THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN c.role = 'system' AND a.role IS NOT NULL THEN 2 ELSE 1 END AS attempts
FROM conversations c LEFT JOIN asked a ON a.role = c.role AND a.text = c.text""")
def infer_resumed(spark, sf_dir):
    # The first run reaches half of the rows; the second asks only what has no answer yet.
    store, turns = scratch_folder(spark), table(spark, sf_dir, "conversations")
    infer_stored(turns.where("turn % 2 = 0"), "role", "text", offline_provider, store, batches=2)
    found = infer_stored(turns, "role", "text", _second_provider, store, batches=2)
    return found.select("conv_id", "turn", "answer", "status", "attempts")


@query(f"""WITH s AS ({_RANDOM_ORDERS}), n AS (SELECT count(*) AS total, count(*) FILTER (split = 'test') AS test FROM s)
SELECT 'whole' AS package, 'public/train' AS output, 'ok' AS status, total - test AS records FROM n UNION ALL SELECT 'whole', 'public/test', 'ok', test FROM n
UNION ALL SELECT 'whole', 'public/sample_submission', 'ok', test FROM n UNION ALL SELECT 'whole', 'private/test_answer', 'ok', test FROM n
UNION ALL SELECT 'changed', 'public/train', 'ok', total - test FROM n UNION ALL SELECT 'changed', 'public/test', 'changed', test FROM n
UNION ALL SELECT 'changed', 'public/sample_submission', 'ok', test FROM n UNION ALL SELECT 'changed', 'private/test_answer', 'missing', NULL FROM n""")
def package_commit(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    parts = checkpointed(split.random_split(orders, "o_orderkey"))
    checks = []
    for name in ("whole", "changed"):
        folder = scratch_folder(spark)
        publish.publish_package(parts, folder, "o_orderkey", "o_totalprice")
        if name == "changed":
            # One output is rewritten with the same number of records, one is lost.
            test = parts.filter("split = 'test'").select("o_orderkey", (F.col("o_custkey") + 1).alias("o_custkey"))
            writers.write_delimited(test, f"{folder}/{writers.TEST_PATH}", mode="overwrite")
            publish.discard(spark, f"{folder}/{writers.ANSWER_PATH}")
        files = [f"{folder}/{o}" for o in publish.PACKAGE_OUTPUTS if publish.exists(spark, f"{folder}/{o}")]
        heads = spark.read.text(files).select(F.col("_metadata.file_path").alias("file")).distinct()
        output = F.regexp_extract("file", "/((public|private)/[a-z_]+)/[^/]*$", 1)
        heads = heads.groupBy(output.alias("output")).agg(F.count(F.lit(1)).alias("heads"))
        found = publish.check_package(spark, folder).join(heads, "output", "left")
        checks.append(found.select(F.lit(name).alias("package"), "output", "status", (F.col("lines") - F.col("heads")).alias("records")))
    return checks[0].unionByName(checks[1])
