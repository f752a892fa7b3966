"""Queries on text: JSON recovery, code, sections, captions, pages, links and records."""

from __future__ import annotations

from pyspark.sql import functions as F

from packwright.functions import html as H
from packwright.functions import jsontext as J
from packwright.functions import text as X
from packwright.operators import assets, package, verify
from packwright.operators.profile import asset_summary as summarise_assets
from packwright.operators.profile import status_counts
from packwright.operators.rank import group_rank
from packwright.plans.registry import query
from packwright.plans.templates import table, template, with_template

_ITEM = "doc_id bigint, lang string"
_LIST_RE, _OBJECT_RE = r"(?s)\[.*\]", r"(?s)\{.*\}"
_FENCE_RE = r"(?s)```(json)?\s*(\{.*?\})\s*```"

# --- JSON recovery ---------------------------------------------------------------------


@query(with_template("reply", f"""
, j AS (SELECT doc_id, nullif(regexp_extract(reply, '{_LIST_RE}', 0), '') AS j FROM t),
v AS (SELECT doc_id, j FROM j WHERE json_valid(j)),
i AS (SELECT doc_id, unnest(from_json(j, '[{{"doc_id":"BIGINT","lang":"VARCHAR"}}]')) AS x, generate_subscripts(from_json(j, '[{{"doc_id":"BIGINT","lang":"VARCHAR"}}]'), 1) AS p FROM v)
SELECT doc_id, p - 1 AS position, x.doc_id AS item_id, x.lang AS lang FROM i""").replace(") \n,", ")\n,").replace(") ,", "),"))
def json_list(spark, sf_dir):
    recovered = J.recover_list(template(spark, sf_dir, "reply"), "reply", f"struct<{_ITEM.replace(' bigint', ':bigint').replace(' string', ':string')}>")
    rows = J.good_rows(recovered).select("doc_id", F.posexplode("value").alias("position", "item"))
    return rows.select(
        "doc_id",
        F.col("position").cast("bigint").alias("position"),
        F.col("item.doc_id").alias("item_id"),
        F.col("item.lang").alias("lang"),
    )


def _object_sql(extract: str) -> str:
    return with_template("reply", f"""
, j AS (SELECT doc_id, {extract} AS j FROM t),
v AS (SELECT doc_id, j, coalesce(json_valid(j), false) AND starts_with(ltrim(coalesce(j, '')), '{{') AS ok FROM j)
SELECT doc_id, CASE WHEN ok THEN 'ok' ELSE 'quarantined' END AS status,
  CASE WHEN ok THEN cast(json_extract_string(CASE WHEN ok THEN j ELSE '{{}}' END, '$.doc_id') AS BIGINT) END AS item_id,
  CASE WHEN ok THEN json_extract_string(CASE WHEN ok THEN j ELSE '{{}}' END, '$.lang') END AS lang FROM v""")


def _object_rows(recovered):
    return recovered.select(
        "doc_id", "status", F.col("value.doc_id").alias("item_id"), F.col("value.lang").alias("lang")
    )


@query(_object_sql(f"nullif(regexp_extract(reply, '{_OBJECT_RE}', 0), '')"))
def json_object(spark, sf_dir):
    return _object_rows(J.recover_object(template(spark, sf_dir, "reply"), "reply", _ITEM))


@query(_object_sql(
    f"coalesce(nullif(regexp_extract(reply, '{_FENCE_RE}', 2), ''), nullif(regexp_extract(reply, '{_OBJECT_RE}', 0), ''), reply)"
))
def json_fenced(spark, sf_dir):
    replies = template(spark, sf_dir, "reply")
    return _object_rows(J.recover_object(replies, "reply", _ITEM, fenced=True))


@query(with_template("reply", f"""
, j AS (SELECT doc_id, coalesce(nullif(regexp_extract(reply, '{_FENCE_RE}', 2), ''), nullif(regexp_extract(reply, '{_OBJECT_RE}', 0), ''), reply) AS j FROM t)
SELECT doc_id, j AS json_text, 'invalid json' AS reason FROM j WHERE NOT json_valid(j)"""))
def json_quarantine(spark, sf_dir):
    replies = template(spark, sf_dir, "reply")
    kept = J.quarantine(J.recover_object(replies, "reply", _ITEM, fenced=True))
    return kept.select("doc_id", "json_text", "reason")


@query("SELECT event_id, cast(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def event_props(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "props")
    recovered = J.recover_object(events, "props", "k bigint")
    return recovered.select("event_id", F.col("value.k").alias("k"))


@query(with_template("reply", f"""
, j AS (SELECT coalesce(nullif(regexp_extract(reply, '{_OBJECT_RE}', 0), ''), '') AS j FROM t)
SELECT CASE WHEN json_valid(j) THEN 'ok' ELSE 'quarantined' END AS status, count(*) AS n FROM j GROUP BY 1"""))
def batch_status(spark, sf_dir):
    recovered = J.recover_object(template(spark, sf_dir, "reply"), "reply", _ITEM)
    return status_counts(recovered)


# --- proposals -------------------------------------------------------------------------

_SHAPE_SQL = """SELECT p_partkey,
  CASE WHEN shape = 1 THEN 'justification' ELSE '' END AS missing_keys,
  CASE WHEN shape = 2 THEN 'extra' ELSE '' END AS unknown_keys, shape NOT IN (1, 2) AS accepted FROM ("""


@query(with_template("proposal", """
, k AS (SELECT p_partkey, json_keys(proposal) AS keys FROM t),
d AS (SELECT p_partkey,
  list_sort(list_filter(['prediction_target','evaluation_metric','data_utilization','justification'], lambda x: NOT list_contains(keys, x))) AS missing,
  list_sort(list_filter(keys, lambda x: NOT list_contains(['prediction_target','evaluation_metric','data_utilization','justification','difficulty','tags','feature_columns','task_type'], x))) AS extra FROM k)
SELECT p_partkey, array_to_string(missing, ',') AS missing_keys, array_to_string(extra, ',') AS unknown_keys,
  len(missing) = 0 AND len(extra) = 0 AS accepted FROM d"""))
def proposal_shape(spark, sf_dir):
    judged = verify.proposal_shape(template(spark, sf_dir, "proposal"))
    keys = [F.array_join(c, ",").alias(c) for c in ("missing_keys", "unknown_keys")]
    return judged.select("p_partkey", *keys, "accepted")


@query(with_template("proposal", """
, b AS (SELECT p_partkey // 10 AS batch, bool_and(shape NOT IN (1, 2)) AS ok FROM t GROUP BY 1)
SELECT p_partkey, ok AS accepted FROM t JOIN b ON b.batch = p_partkey // 10"""))
def proposal_batches(spark, sf_dir):
    proposals = template(spark, sf_dir, "proposal").withColumn("batch", F.expr("p_partkey div 10"))
    judged = verify.proposal_shape(proposals, batch="batch")
    return judged.select("p_partkey", "accepted")


@query(with_template("proposal", """
SELECT p_partkey, CASE shape WHEN 3 THEN 'target is not a column: ' || json_extract_string(proposal, '$.prediction_target')
  WHEN 4 THEN 'unknown task type: ' || json_extract_string(proposal, '$.task_type') ELSE '' END AS problems FROM t"""))
def proposal_columns(spark, sf_dir):
    columns = table(spark, sf_dir, "part").columns
    proposals = template(spark, sf_dir, "proposal")
    recovered = J.recover_object(proposals, "proposal", verify.PROPOSAL_SCHEMA)
    problems = verify.proposal_problems(F.col("value"), columns)
    return recovered.select("p_partkey", F.array_join(problems, "; ").alias("problems"))


_PROPOSAL_LIST = """SELECT doc_id, doc_id % 3 + 1 AS table_index,
  '[{"prediction_target": "' || upper(lang) || '", "justification": "a"}, {"prediction_target": "' || source || '", "justification": "b"}' ||
  CASE WHEN doc_id % 4 = 0 THEN '' ELSE ']' END AS reply FROM documents"""
_PROPOSAL_ITEM = "struct<prediction_target:string,justification:string>"


def _proposal_lists(spark, sf_dir):
    table(spark, sf_dir, "documents").createOrReplaceTempView("documents")
    return J.good_rows(J.recover_list(spark.sql(_PROPOSAL_LIST), "reply", _PROPOSAL_ITEM))


@query("""SELECT d.doc_id, d.doc_id % 3 + 1 AS table_index, i + 1 AS proposal_index,
  'comp_t' || (d.doc_id % 3 + 1) || '_p' || (i + 1) || '_' || lower(CASE i WHEN 0 THEN lang ELSE source END) AS package,
  'table_' || (d.doc_id % 3 + 1) || '_proposal_' || (i + 1) AS work_name
FROM documents d, (VALUES (0), (1)) v(i) WHERE d.doc_id % 4 <> 0""")
def explode_proposals(spark, sf_dir):
    rows = assets.explode_proposals(_proposal_lists(spark, sf_dir), "doc_id", "table_index", "value")
    return rows.select("doc_id", "table_index", "proposal_index", "package", "work_name")


@query("SELECT doc_id, upper(lang) AS prediction_target FROM documents WHERE doc_id % 4 <> 0")
def first_proposal(spark, sf_dir):
    rows = _proposal_lists(spark, sf_dir).select(
        "doc_id", F.posexplode("value").alias("position", "p")
    )
    flat = rows.select("doc_id", "position", "p.prediction_target")
    return assets.first_item(flat, "doc_id", "position").drop("position")


# --- code and verdicts -----------------------------------------------------------------

_WS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"


@query(with_template("code", f"""
SELECT conv_id, turn, trim(CASE WHEN regexp_matches(reply, '(?s)```python(.*?)```') THEN regexp_extract(reply, '(?s)```python(.*?)```', 1)
  WHEN regexp_matches(reply, '(?s)```(.*?)```') THEN regexp_extract(reply, '(?s)```(.*?)```', 1) ELSE reply END, {_WS}) AS code FROM t"""))
def code_block(spark, sf_dir):
    replies = template(spark, sf_dir, "code")
    return replies.select("conv_id", "turn", X.code_block(F.col("reply")).alias("code"))


@query(with_template("code", f"""
, s AS (SELECT conv_id, turn, trim(reply, {_WS}) AS r FROM t),
o AS (SELECT conv_id, turn, CASE WHEN starts_with(r, '```python') THEN trim(substr(r, 10), {_WS}) ELSE r END AS r FROM s)
SELECT conv_id, turn, CASE WHEN ends_with(r, '```') THEN trim(left(r, length(r) - 3), {_WS}) ELSE r END AS code FROM o"""))
def fence_trim(spark, sf_dir):
    replies = template(spark, sf_dir, "code")
    return replies.select("conv_id", "turn", X.trim_fence(F.col("reply")).alias("code"))


_SNIPPETS = """SELECT doc_id, '[{"code": "x = ' || cast(n_chars as string) || '", "description": "A Python line in ' || lang || '"}, {"code": "ls", "description": "shell ' || source || '"}]' AS reply
FROM documents"""


@query("""SELECT doc_id, 'code_snippet_1.py' AS file_name, 'x = ' || n_chars AS code FROM documents
UNION ALL SELECT doc_id, 'code_snippet_2.txt', 'ls' FROM documents""")
def snippet_ext(spark, sf_dir):
    table(spark, sf_dir, "documents").createOrReplaceTempView("documents")
    recovered = J.recover_list(
        spark.sql(_SNIPPETS), "reply", "struct<code:string,description:string>"
    )
    rows = assets.snippet_rows(J.good_rows(recovered), "doc_id")
    return rows.select("doc_id", "file_name", "code")


@query(with_template("code", f"""
SELECT conv_id, turn, CASE WHEN starts_with(upper(trim(verdict, {_WS})), 'FAIL') THEN 'error'
  WHEN starts_with(upper(trim(verdict, {_WS})), 'WARN') THEN 'warning' ELSE 'pass' END AS severity FROM t"""))
def verdict_parse(spark, sf_dir):
    replies = template(spark, sf_dir, "code")
    return replies.select("conv_id", "turn", X.verdict(F.col("verdict")).alias("severity"))


# --- sections and captions -------------------------------------------------------------

_CUT = "trim(regexp_replace(trim({}), '^link keyboard_arrow_up', ''))"


def _section_sql(start: str, end: str) -> str:
    pattern = f"(?s)^.*?{start}(.*?){end}"
    return (
        f"CASE WHEN regexp_matches(page_text, '{pattern}') THEN "
        + _CUT.format(f"regexp_extract(page_text, '{pattern}', 1)")
        + f" ELSE 'Could not find markers to slice ''{start}''.' END"
    )


@query(with_template("sections", f"""
SELECT doc_id, {_section_sql('Description', 'Background')} AS description, {_section_sql('Background', 'Evaluation')} AS background,
  {_section_sql('Evaluation', '(?:Timeline|Prizes & Awards|Code|Data|$)')} AS evaluation FROM t"""))
def marker_slice(spark, sf_dir):
    pages = template(spark, sf_dir, "sections")
    sections = X.competition_sections(F.col("page_text"))
    return pages.select("doc_id", *[c.alias(n) for n, c in sections.items()])


_CAPTION_RE = r"(Fig\.|Figure)\s(\d+)\s*\|([^\n]*)"


@query(with_template("captions", f"""
, n AS (SELECT doc_id, regexp_extract_all(full_text, '{_CAPTION_RE}', 2) AS nums, regexp_extract_all(full_text, '{_CAPTION_RE}', 3) AS caps FROM t),
u AS (SELECT doc_id, unnest(nums) AS number, unnest(caps) AS caption, generate_subscripts(nums, 1) - 1 AS ordinal FROM n)
SELECT doc_id, ordinal, number, trim(caption) AS caption FROM u"""))
def caption_numbers(spark, sf_dir):
    docs = template(spark, sf_dir, "captions")
    return assets.caption_rows(docs, "doc_id", "full_text")


_PAIRS_SQL = with_template("captions", f"""
, n AS (SELECT doc_id, n_images, regexp_extract_all(full_text, '{_CAPTION_RE}', 2) AS nums, regexp_extract_all(full_text, '{_CAPTION_RE}', 3) AS caps FROM t),
i AS (SELECT *, unnest(range(n_images)) AS ordinal FROM n)
SELECT doc_id, ordinal, coalesce('Fig. ' || nums[ordinal + 1] || ': ' || trim(caps[ordinal + 1]), '{X.NO_CAPTION}') AS context FROM i""")


@query(_PAIRS_SQL)
def image_caption_pairs(spark, sf_dir):
    images = F.when(F.col("n_images") > 0, F.sequence(F.lit(1), F.col("n_images")))
    docs = template(spark, sf_dir, "captions").withColumn("images", images)
    return assets.pair_images(docs, "doc_id", "images", "full_text").drop("image")


@query(_PAIRS_SQL)
def image_caption_join(spark, sf_dir):
    docs = template(spark, sf_dir, "captions")
    pages = F.explode(F.sequence(F.lit(1), F.col("n_images"))).alias("page_number")
    images = docs.filter("n_images > 0").select("doc_id", pages)
    numbered = group_rank(images, ["doc_id"], ["page_number"])
    captions = assets.caption_rows(docs, "doc_id", "full_text")
    return assets.pair_image_rows(numbered, captions, "doc_id").drop("page_number")


# --- pages -----------------------------------------------------------------------------

_DECODED = "replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"


@query(f"""WITH m AS (SELECT page_id, regexp_replace(html, '(?is)<!--.*?-->|<script\\b[^>]*>.*?</script>|<style\\b[^>]*>.*?</style>', '', 'g') AS html FROM pages)
SELECT page_id, CASE WHEN regexp_matches(html, '(?is)<h1[^>]*>(.*?)</h1>') THEN
  trim({_DECODED.format("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")}) ELSE 'Untitled Paper' END AS title FROM m""")
def page_title(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return pages.select("page_id", H.page_title(F.col("html")).alias("title"))


@query(with_template("html", r"""
, h AS (SELECT doc_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS link FROM t)
SELECT DISTINCT doc_id, link FROM h WHERE regexp_matches(link, '^https?://(github\.com|gitlab\.com|figshare\.com|zenodo\.org|doi\.org)[\w./%-]+')"""))
def page_links(spark, sf_dir):
    return assets.link_rows(template(spark, sf_dir, "html"), "doc_id")


@query(r"""WITH h AS (SELECT page_id, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) AS hrefs FROM pages)
SELECT page_id, len(hrefs) AS n_links, array_to_string(hrefs, ' ') AS hrefs FROM h""")
def page_hrefs(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    hrefs = H.page_hrefs(F.col("html"))
    return pages.select(
        "page_id",
        F.size(hrefs).cast("bigint").alias("n_links"),
        F.array_join(hrefs, " ").alias("hrefs"),
    )


@query(with_template("html", """
, d AS (SELECT doc_id, regexp_extract(html, 'M1 [a-z]+', 0) AS m, regexp_extract(html, '<p>(R [0-9]+)</p>', 1) AS r, regexp_extract(html, '<figcaption>([^<]*)', 1) AS c FROM t)
SELECT doc_id, m || chr(10) || 'M2' AS methods, r || chr(10) || c || chr(10) || 'c' || chr(10) || 'c' || chr(10) || 'd' || chr(10) || 'n' || chr(10) || 'r' AS results FROM d"""))
def section_by_heading(spark, sf_dir):
    pages = template(spark, sf_dir, "html")
    return pages.select(
        "doc_id",
        H.flat_section(F.col("html"), H.METHODS_HEADING).alias("methods"),
        H.flat_section(F.col("html"), H.RESULTS_HEADING).alias("results"),
    )


@query(with_template("html", "SELECT doc_id, 0 AS ordinal, regexp_extract(html, '<figcaption>([^<]*)', 1) AS caption FROM t"))
def figure_captions(spark, sf_dir):
    captions = H.flat_figure_captions(F.col("html"))
    return template(spark, sf_dir, "html").select("doc_id", F.posexplode(captions).alias("ordinal", "caption"))


@query(with_template("html", """
SELECT doc_id, 'Paper ' || doc_id AS title, regexp_extract(html, 'About [a-z0-9]+', 0) AS abstract,
  regexp_extract(html, 'M1 [a-z]+', 0) || chr(10) || 'M2' AS methods,
  regexp_extract(html, '<p>(R [0-9]+)</p>', 1) || chr(10) || regexp_extract(html, '<figcaption>([^<]*)', 1) || chr(10) || 'c' || chr(10) || 'c' || chr(10) || 'd' || chr(10) || 'n' || chr(10) || 'r' AS results,
  regexp_extract(html, '<figcaption>([^<]*)', 1) AS captions,
  regexp_extract(html, 'https://github[^"]*', 0) || ' ' || regexp_extract(html, 'https://zenodo[^"]*', 0) AS availability_links FROM t"""))
def page_record(spark, sf_dir):
    records = assets.page_record(template(spark, sf_dir, "html"))
    return records.withColumn("availability_links", F.array_join("availability_links", " ")).drop("status", "reason")


# --- links, paths and names ------------------------------------------------------------


@query(with_template("links", """
SELECT doc_id, CASE WHEN contains(link, 'zenodo.org') OR contains(link, 'doi.org/10.5281/zenodo') THEN 'repository'
  WHEN starts_with(link, 'http') THEN 'unsupported_url' WHEN ends_with(lower(link), '.pdf') THEN 'pdf' ELSE 'unsupported' END AS route FROM t"""))
def route_source(spark, sf_dir):
    links = template(spark, sf_dir, "links")
    return links.select("doc_id", X.route_source(F.col("link")).alias("route"))


@query(with_template("links", """
SELECT doc_id, CASE WHEN contains(link, 'github.com') THEN 'clone' WHEN contains(link, 'zenodo') THEN 'record' ELSE 'manual' END AS route FROM t"""))
def route_link(spark, sf_dir):
    links = template(spark, sf_dir, "links")
    return links.select("doc_id", X.route_link(F.col("link")).alias("route"))


@query(with_template("links", "SELECT doc_id, nullif(regexp_extract(link, '([0-9]+)$', 1), '') AS record_id, split_part(link, '/', -1) AS last_part FROM t"))
def record_id(spark, sf_dir):
    link = F.col("link")
    return template(spark, sf_dir, "links").select(
        "doc_id", X.record_id(link).alias("record_id"), X.last_segment(link).alias("last_part")
    )


@query(with_template("links", "SELECT doc_id, replace(split_part(link, '/', -1), '.git', '') AS repo FROM t"))
def repo_name(spark, sf_dir):
    links = template(spark, sf_dir, "links")
    return links.select("doc_id", X.repo_name(F.col("link")).alias("repo"))


@query(r"SELECT doc_id, left(regexp_replace(lower(text), '[\s:/\\\x{85}\x{a0}\x{2028}]+', '_', 'g'), 80) AS folder, left(regexp_replace(lower(text), '[\s:/\\\x{85}\x{a0}\x{2028}]+', '_', 'g'), 50) AS project FROM documents")
def slug(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    title = F.col("text")
    return documents.select(
        "doc_id", X.slug(title, 80).alias("folder"), X.slug(title, 50).alias("project")
    )


@query(r"SELECT page_id, replace(replace(url, '/', '_'), '\', '_') AS name, contains(url, '/') OR contains(url, '\') AS changed FROM pages")
def sanitize(spark, sf_dir):
    name = X.sanitize(F.col("url"))
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", name.alias("name"), (name != F.col("url")).alias("changed"))


@query(with_template("manifest", """
SELECT path, lower(ext) AS extension, CASE WHEN lower(ext) IN ('.csv','.json','.txt','') THEN 'data' WHEN lower(ext) IN ('.py','.ipynb') THEN 'code' ELSE 'ignored' END AS kind FROM t"""))
def classify_files(spark, sf_dir):
    files = template(spark, sf_dir, "manifest")
    path = F.col("path")
    return files.select("path", X.extension(path).alias("extension"), X.classify_file(path).alias("kind"))


# --- repository records ----------------------------------------------------------------


@query(with_template("record", """
SELECT doc_id, position, key, size, replace(key, '/', '_') AS local_name FROM (
  SELECT doc_id, 0 AS position, json_extract_string(record, '$.files[0].key') AS key, cast(json_extract(record, '$.files[0].size') AS BIGINT) AS size FROM t WHERE json_valid(record)
  UNION ALL SELECT doc_id, 1, json_extract_string(record, '$.files[1].key'), cast(json_extract(record, '$.files[1].size') AS BIGINT) FROM t WHERE json_valid(record)
  UNION ALL SELECT doc_id, 2, json_extract_string(record, '$.files[2].key'), cast(json_extract(record, '$.files[2].size') AS BIGINT) FROM t WHERE json_valid(record)) u"""))
def record_files(spark, sf_dir):
    files = assets.record_files(template(spark, sf_dir, "record"), ["doc_id"], "record")
    return files.drop("link")


@query(with_template("record", """, r AS (SELECT doc_id, CASE doc_id % 11 WHEN 3 THEN '{"files": []}' WHEN 5 THEN '[1]' WHEN 7 THEN '{"title": "t"}' WHEN 9 THEN '{"files": "none"}' ELSE record END AS record FROM t)
SELECT doc_id, CASE doc_id % 11 WHEN 3 THEN 'no files' WHEN 5 THEN 'not an object' WHEN 7 THEN 'no files' WHEN 9 THEN 'wrong type' ELSE 'not json' END AS reason, record AS json_text
FROM r WHERE doc_id % 11 IN (3, 5, 7, 9) OR NOT json_valid(record)"""))
def record_quarantine(spark, sf_dir):
    other = F.when(F.col("doc_id") % 11 == 3, '{"files": []}').when(F.col("doc_id") % 11 == 5, "[1]")
    other = other.when(F.col("doc_id") % 11 == 7, '{"title": "t"}').when(F.col("doc_id") % 11 == 9, '{"files": "none"}')
    records = template(spark, sf_dir, "record").withColumn("record", F.coalesce(other, "record"))
    return assets.unreadable_records(records, ["doc_id"], "record")


@query(with_template("record", """
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'a' || doc_id || '.zip' ELSE 'b.zip' END AS key, CASE WHEN doc_id % 3 = 0 THEN 7 ELSE 8 END AS size
FROM t WHERE json_valid(record)"""))
def first_zip(spark, sf_dir):
    files = assets.record_files(template(spark, sf_dir, "record"), ["doc_id"], "record")
    zips = assets.first_zip(files.select("doc_id", "position", "key", "size"), "doc_id")
    return zips.select("doc_id", "key", F.col("size").cast("int").alias("size"))


# --- text from fields ------------------------------------------------------------------


@query("""SELECT doc_id, 'Title: ' || source || chr(10) || 'Abstract: ' || lang || chr(10) || 'Methods Section Summary: ' || left(text, 4000) || chr(10) ||
  'Results Section Summary: ' || left(text, 4000) || chr(10) || 'Figure/Table Captions: ' AS context FROM documents""")
def prompt_context(spark, sf_dir):
    text = F.col("text")
    context = X.prompt_context(F.col("source"), F.col("lang"), text, text, F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", context.alias("context"))


_TASKS = """SELECT n_nationkey AS id, '{"source_paper": {"title": "' || n_name || '"}, "ml_task": {"task_type": "regression"}, "scientific_summary": {"key_results": "one\\u000atwo"}, "data_profile": {"file_formats": {".csv": ' || cast(n_nationkey as string) || '}}, "model_details": {"key_libraries_mentioned": ["PyTorch", "' || n_name || '"]}}' AS reply
FROM nation UNION ALL SELECT s_suppkey + 1000, '{"source_paper": {"title": "' || s_name || '"}}' FROM supplier"""


def _tasks(spark, sf_dir):
    for name in ("nation", "supplier"):
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    replies = spark.sql(_TASKS.replace("\\u000a", "\\\\u000a"))
    recovered = J.recover_object(replies, "reply", package.TASK_SCHEMA)
    return recovered.withColumn("task", package.fill_defaults("value")).select("id", "task")


_TASK_FIELDS = """SELECT n_nationkey AS id, n_name AS title, 'regression' AS task_type, 'one' || chr(10) || 'two' AS key_results, 'N/A' AS url, 'unknown' AS primary_format, cast(0 AS BIGINT) AS file_count, 'PyTorch,' || n_name AS libraries, '{".csv":' || n_nationkey || '}' AS formats FROM nation
UNION ALL SELECT s_suppkey + 1000, s_name, 'N/A', 'N/A', 'N/A', 'unknown', 0, '', '{}' FROM supplier"""


@query(_TASK_FIELDS)
def default_fill(spark, sf_dir):
    t = F.col("task")
    return _tasks(spark, sf_dir).select(
        "id",
        t.source_paper.title.alias("title"),
        t.ml_task.task_type.alias("task_type"),
        t.scientific_summary.key_results.alias("key_results"),
        t.source_paper.url.alias("url"),
        t.data_profile.primary_format.alias("primary_format"),
        t.data_profile.file_count.alias("file_count"),
        F.array_join(t.model_details.key_libraries_mentioned, ",").alias("libraries"),
        F.to_json(t.data_profile.file_formats).alias("formats"),
    )


@query(f"""WITH f AS ({_TASK_FIELDS})
SELECT id, title, 'http://p/' || id AS url, task_type, 'data/' || id AS raw_data_path, 'a' || id AS first_link FROM f""")
def task_record(spark, sf_dir):
    key = F.col("id").cast("string")
    sources = F.struct(
        F.concat(F.lit("data/"), key).alias("raw_data_path"),
        F.array(F.concat(F.lit("a"), key)).alias("original_links"),
        F.array(F.lit("ok")).alias("local_setup_log"),
    )
    record = package.task_record(
        F.col("task.source_paper.title"),
        F.concat(F.lit("http://p/"), key),
        F.col("task"),
        F.col("task.data_profile"),
        sources,
    )
    records = _tasks(spark, sf_dir).select("id", F.from_json(record, package.TASK_SCHEMA).alias("r"))
    return records.select(
        "id",
        "r.source_paper.title",
        "r.source_paper.url",
        "r.ml_task.task_type",
        "r.data_sources.raw_data_path",
        F.get("r.data_sources.original_links", F.lit(0)).alias("first_link"),
    )


_NL = " || chr(10) || "


@query(f"WITH f AS ({_TASK_FIELDS}) SELECT id, " + _NL.join([
    "'# Benchmark task'", "'## Source'", "'- Title: ' || title", "'- URL: ' || url", "'## Background'", "'N/A'", "'## Goal'", "'N/A'",
    "'## Methods'", "'  N/A'", "'## Results'", "'  ' || replace(key_results, chr(10), chr(10) || '  ')", "'## Task'",
    "'- Type: ' || task_type", "'- Problem: N/A'", "'- Metric: N/A'", "'## Data'", "'- Raw data: N/A'",
    "'- Primary format: ' || primary_format", "'- Formats: ' || formats",
]) + " AS report FROM f")
def report_text(spark, sf_dir):
    return _tasks(spark, sf_dir).select("id", package.report_text(F.col("task")).alias("report"))


@query("""WITH f AS (SELECT doc_id, lower(CASE lang WHEN 'en' THEN 'PyTorch' WHEN 'fr' THEN 'Keras' WHEN 'de' THEN 'HuggingFace' ELSE 'XGBoost' END) AS lib,
  CASE doc_id % 4 WHEN 0 THEN '.nc' WHEN 1 THEN '.parquet' WHEN 2 THEN '.grib' ELSE '.csv' END AS fmt FROM documents),
l AS (SELECT doc_id, unnest(list_concat(list_concat(['joblib','pandas','scikit-learn','tqdm'],
    CASE fmt WHEN '.nc' THEN ['xarray','netCDF4'] WHEN '.parquet' THEN ['pyarrow'] WHEN '.grib' THEN ['cfgrib','eccodes'] ELSE [] END),
    CASE WHEN contains(lib, 'torch') THEN ['torch','torchvision'] WHEN contains(lib, 'keras') THEN ['tensorflow'] WHEN contains(lib, 'hugging') THEN ['transformers','datasets'] ELSE [lib] END)) AS r FROM f)
SELECT doc_id, string_agg(r, chr(10) ORDER BY r) AS requirements FROM (SELECT DISTINCT doc_id, r FROM l) d GROUP BY doc_id""")
def requirements(spark, sf_dir):
    key, lang = F.col("doc_id") % 4, F.col("lang")
    fmt = F.when(key == 0, ".nc").when(key == 1, ".parquet").when(key == 2, ".grib").otherwise(".csv")
    lib = (
        F.when(lang == "en", "PyTorch")
        .when(lang == "fr", "Keras")
        .when(lang == "de", "HuggingFace")
        .otherwise("XGBoost")
    )
    needed = package.requirements(F.array(fmt), F.array(lib))
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", F.array_join(needed, "\n").alias("requirements"))


@query("""SELECT n_regionkey, string_agg(n_nationkey || ': ' || n_name, chr(10) ORDER BY n_nationkey) AS preview FROM (
  SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS rn FROM nation) n WHERE rn <= 5 GROUP BY 1""")
def table_preview(spark, sf_dir):
    line = F.concat(F.col("n_nationkey").cast("string"), F.lit(": "), F.col("n_name"))
    nation = table(spark, sf_dir, "nation")
    return assets.table_preview(nation, "n_regionkey", "n_nationkey", line)


@query("""SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) o WHERE rn <= 5""")
def head_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return assets.head_rows(orders, ["o_custkey"], ["o_orderkey"])


@query("""SELECT doc_id, count(*) FILTER (k = 0) AS n_table, count(*) FILTER (k = 1) AS n_chart, count(*) FILTER (k = 2) AS n_code,
  count(*) FILTER (k < 3) = 0 AS is_empty FROM (SELECT conv_id AS doc_id, turn % 4 AS k FROM conversations) c GROUP BY 1""")
def asset_summary(spark, sf_dir):
    kind = F.col("turn") % 4
    asset_type = F.when(kind == 0, "table").when(kind == 1, "chart").when(kind == 2, "code").otherwise("none")
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"), asset_type.alias("asset_type")
    )
    return summarise_assets(rows)
