"""Queries on cases the given tables lack: nulls, hot keys, wrong types, failures."""

from __future__ import annotations

from pyspark.sql import functions as F

from packwright.functions import jsontext as J
from packwright.operators import assets, package, papers, score, split, verify
from packwright.operators.baseline import fit_predict
from packwright.operators.joins import join_unique
from packwright.operators.rank import group_rank
from packwright.plans.registry import query
from packwright.plans.templates import table, template, with_template

# --- ranks and joins -------------------------------------------------------------------


@query("""SELECT o_orderkey, row_number() OVER (PARTITION BY CASE WHEN o_custkey % 7 <> 0 THEN o_custkey END ORDER BY o_orderkey) - 1 AS ordinal FROM orders""")
def group_rank_null_groups(spark, sf_dir):
    customer = F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", customer.alias("customer"))
    return group_rank(orders, ["customer"], ["o_orderkey"]).select("o_orderkey", "ordinal")


@query("SELECT l_partkey, count(*) AS n, sum(p_size) AS sizes FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1")
def join_many_hot_keys(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_partkey")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size")
    joined = join_unique(lines, parts, ["l_partkey"], "left", hot_rows=5)
    return joined.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("sizes"))


@query("""WITH g AS (SELECT CASE WHEN o_custkey % 7 <> 0 THEN o_custkey END AS customer, o_orderkey FROM orders),
p AS (SELECT o_orderkey, row_number() OVER (PARTITION BY customer ORDER BY o_orderkey) - 1 AS place, count(*) OVER (PARTITION BY customer) AS n FROM g)
SELECT o_orderkey, CASE WHEN place >= n * 4 // 5 THEN 'test' ELSE 'train' END AS split FROM p""")
def split_ordered_null_groups(spark, sf_dir):
    customer = F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", customer.alias("customer"))
    return split.ordered_split_within(orders, "customer", ["o_orderkey"]).select("o_orderkey", "split")


@query("""WITH r AS (SELECT l_returnflag AS label, md5('42:' || l_orderkey) AS h FROM lineitem),
c AS (SELECT label, count(*) AS n FROM r GROUP BY 1), t AS (SELECT sum(n)::BIGINT AS total, (sum(n)::BIGINT + 4) // 5 AS wanted FROM c),
q AS (SELECT label, n * wanted // total AS base, n * wanted % total AS remainder, wanted FROM c, t),
z AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY remainder DESC, label) <= wanted - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM q),
k AS (SELECT label, h, row_number() OVER (PARTITION BY label ORDER BY h) AS place FROM r),
x AS (SELECT label, h AS last FROM k JOIN z USING (label) WHERE place = quota)
SELECT label, count(*) FILTER (h <= last) AS n_test, count(*) FILTER (h > last) AS n_train FROM r JOIN x USING (label) GROUP BY 1""")
def split_stratified_repeated_keys(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("label"))
    sides = split.stratified_split(lines, "l_orderkey", "label")
    return sides.groupBy("label").agg(
        F.count_if(F.col("split") == "test").alias("n_test"), F.count_if(F.col("split") == "train").alias("n_train")
    )


@query("""WITH r AS (SELECT l_orderkey * 8 + l_linenumber AS line, CASE WHEN l_orderkey % 10 < 9 THEN 'hot' ELSE l_shipmode END AS label FROM (SELECT *, 'mode' || (l_orderkey % 50) AS l_shipmode FROM lineitem)),
h AS (SELECT *, md5('42:' || line) AS h FROM r),
c AS (SELECT label, count(*) AS n FROM h GROUP BY 1), t AS (SELECT sum(n)::BIGINT AS total, (sum(n)::BIGINT + 4) // 5 AS wanted FROM c),
q AS (SELECT label, n * wanted // total AS base, n * wanted % total AS remainder, wanted FROM c, t),
z AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY remainder DESC, label) <= wanted - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM q),
k AS (SELECT label, h, row_number() OVER (PARTITION BY label ORDER BY h) AS place FROM h),
x AS (SELECT label, h AS last FROM k JOIN z USING (label) WHERE place = quota)
SELECT h.line, h.label, CASE WHEN h.h <= x.last THEN 'test' ELSE 'train' END AS split FROM h LEFT JOIN x USING (label)""")
def split_stratified_hot_label(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    label = F.when(F.col("l_orderkey") % 10 < 9, "hot").otherwise(F.concat(F.lit("mode"), F.col("l_orderkey") % 50))
    lines = lines.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line"), label.alias("label"))
    return split.stratified_split(lines, "line", "label")


_SIDES_BY_NATION = """SELECT c_nationkey, CASE WHEN row_number() OVER (ORDER BY md5('42:' || c_nationkey)) <= (count(*) OVER () + 4) // 5 THEN 'test' ELSE 'train' END AS side
  FROM (SELECT DISTINCT c_nationkey FROM customer) n"""


@query(f"""WITH s AS (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS place, count(*) OVER () AS n FROM (SELECT DISTINCT ts FROM events) d), g AS ({_SIDES_BY_NATION})
SELECT 'events' AS name, CASE WHEN place < n * 4 // 5 THEN 'train' ELSE 'test' END AS split, count(*) AS n FROM events JOIN s USING (ts) GROUP BY ALL
UNION ALL SELECT 'one step', side, count(*) FROM customer JOIN g USING (c_nationkey) GROUP BY ALL
UNION ALL SELECT 'no time', side, count(*) FROM customer JOIN g USING (c_nationkey) GROUP BY ALL""")
def time_or_dimension(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    one_step = customers.withColumn("ts", F.lit("2020-01-01").cast("timestamp_ntz"))
    sides = {
        "events": split.time_or_dimension_split(table(spark, sf_dir, "events"), "ts", "user_id"),
        "one step": split.time_or_dimension_split(one_step, "ts", "c_nationkey"),
        "no time": split.time_or_dimension_split(customers, "ts", "c_nationkey"),
    }
    counts = [df.groupBy("split").count().select(F.lit(n).alias("name"), "split", F.col("count").alias("n")) for n, df in sides.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


# --- JSON and replies ------------------------------------------------------------------

_TYPED = """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '{"n": ' || n_chars || ', "tags": ["' || lang || '"]}'
  WHEN 1 THEN '{"n": "' || lang || '", "tags": []}' WHEN 2 THEN '{"n": 1, "tags": "' || source || '"}' ELSE '{"n": null}' END AS reply FROM documents"""


@query(f"""SELECT doc_id, CASE WHEN doc_id % 4 IN (1, 2) THEN 'quarantined' ELSE 'ok' END AS status, CASE WHEN doc_id % 4 IN (1, 2) THEN 'wrong type' END AS reason,
  CASE WHEN doc_id % 4 = 0 THEN json_extract(reply, '$.n')::BIGINT END AS n, CASE WHEN doc_id % 4 = 0 THEN json_extract_string(reply, '$.tags[0]') END AS tag FROM ({_TYPED}) t""")
def json_wrong_types(spark, sf_dir):
    table(spark, sf_dir, "documents").createOrReplaceTempView("documents")
    found = J.recover_object(spark.sql(_TYPED), "reply", "n bigint, tags array<string>")
    return found.select("doc_id", "status", "reason", "value.n", F.get("value.tags", F.lit(0)).alias("tag"))


def failing_author(prompt: str, context: str) -> str:
    """Stand-in for a model whose provider fails for some papers and adds keys of its own."""
    title = context.split("\n", 1)[0].removeprefix("Title: ")
    if title.endswith("3"):
        return '{"error": "API call failed"}'
    return f'{{"ml_task": {{"task_type": "{prompt}"}}, "confidence": 0.5, "notes": {{"title": "{title}"}}}}'


def _failing_tasks(spark, sf_dir):
    pages = template(spark, sf_dir, "html")
    url = F.concat(F.lit("http://p/"), F.col("doc_id").cast("string"))
    return papers.paper_tasks(pages.withColumn("url", url), "define", failing_author)


@query("""SELECT doc_id, CASE WHEN doc_id % 10 = 3 THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN doc_id % 10 = 3 THEN 'API call failed' END AS reason, doc_id % 10 <> 3 AS has_task FROM documents""")
def paper_error_replies(spark, sf_dir):
    tasks = _failing_tasks(spark, sf_dir)
    return tasks.select("doc_id", "status", "reason", F.col("task").isNotNull().alias("has_task"))


@query("""SELECT 'paper_paper_' || doc_id AS folder, 'define' AS task_type, '0.5' AS confidence, 'Paper ' || doc_id AS note FROM documents WHERE doc_id % 10 <> 3""")
def task_record_extra_keys(spark, sf_dir):
    no_files = table(spark, sf_dir, "documents").limit(0).select(F.lit("").alias("dataset"), F.lit("").alias("path"))
    from packwright.operators.profile import dataset_profile

    records = papers.final_records(_failing_tasks(spark, sf_dir), dataset_profile(no_files))
    field = {"task_type": "$.ml_task.task_type", "confidence": "$.confidence", "note": "$.notes.title"}
    return records.select("folder", *[F.get_json_object("record", path).alias(name) for name, path in field.items()])


@query(with_template("proposal", """
SELECT p_partkey, '中等' AS difficulty, CASE WHEN p_partkey % 2 = 0 THEN '回归' ELSE json_extract_string(proposal, '$.task_type') END AS task_type, 0 AS n_tags FROM t"""))
def proposal_defaults(spark, sf_dir):
    proposals = template(spark, sf_dir, "proposal")
    # Every second proposal does without its task type.
    cut = F.regexp_replace("proposal", r'"task_type": "[a-z]+", ', "")
    proposals = proposals.withColumn("proposal", F.when(F.col("p_partkey") % 2 == 0, cut).otherwise(F.col("proposal")))
    found = J.recover_object(proposals, "proposal", verify.PROPOSAL_SCHEMA)
    filled = found.select("p_partkey", verify.with_proposal_defaults(F.col("value")).alias("p"))
    return filled.select("p_partkey", "p.difficulty", "p.task_type", F.size("p.tags").alias("n_tags"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'wrong type' END AS reason FROM part""")
def proposal_text_features(spark, sf_dir):
    features = F.when(F.col("p_partkey") % 3 == 0, '"p_size"').otherwise('["p_size"]')
    text = F.concat(F.lit('{"prediction_target": "p_retailprice", "feature_columns": '), features, F.lit("}"))
    rows = table(spark, sf_dir, "part").select("p_partkey", text.alias("proposal"))
    return J.recover_object(rows, "proposal", verify.PROPOSAL_SCHEMA).select("p_partkey", "reason")


@query(with_template("proposal", """
, b AS (SELECT p_partkey // 10 AS batch, bool_and(shape NOT IN (1, 2)) AS ok FROM t GROUP BY 1)
SELECT p_partkey, CASE WHEN batch % 2 = 0 THEN ok ELSE shape NOT IN (1, 2) END AS accepted FROM t JOIN b ON b.batch = p_partkey // 10"""))
def proposal_null_batches(spark, sf_dir):
    batch = F.expr("p_partkey div 10")
    batch = F.when(batch % 2 == 0, batch)
    proposals = template(spark, sf_dir, "proposal").withColumn("batch", batch)
    return verify.proposal_shape(proposals, batch="batch").select("p_partkey", "accepted")


# --- gate, leakage and models ----------------------------------------------------------


@query("""SELECT 'c' || c_custkey AS package, CASE WHEN c_custkey % 2 = 0 THEN 4 ELSE 0 END AS directories, CASE WHEN c_custkey % 2 = 0 THEN 7 ELSE 0 END AS files FROM customer""")
def gate_absent_package(spark, sf_dir):
    packages = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("c"), F.col("c_custkey")).alias("package"))
    paths = F.array(*[F.lit(p) for p in verify.REQUIRED_FILES])
    listing = packages.filter("c_custkey % 2 <> 0").select("package", F.explode(paths).alias("rel_path"), F.lit(False).alias("is_dir"))
    # Half of the packages have no row in the listing at all; the others miss only data/raw.
    raw = listing.select("package").distinct().select("package", F.lit("data/raw").alias("rel_path"), F.lit(True).alias("is_dir"))
    listing = listing.unionByName(raw)
    found = verify.layout_findings(listing, packages).unionByName(verify.file_findings(listing, packages))
    counts = found.groupBy("package").agg(
        F.count_if(F.col("check") == "layout").alias("directories"), F.count_if(F.col("check") == "files").alias("files")
    )
    joined = packages.select("package").join(counts, "package", "left")
    return joined.select("package", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("directories", "files")])


@query("""SELECT 'c' || c_custkey AS package, s AS stage, s <= c_custkey % 4 AS reached, s <= c_custkey % 4 AS passed FROM customer, (VALUES (1), (2), (3)) v(s)""")
def gate_unrun_stage(spark, sf_dir):
    packages = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("c"), F.col("c_custkey")).alias("package"))
    ran = packages.filter("c_custkey % 4 > 0").select("package", F.explode(F.expr("sequence(1, int(c_custkey % 4))")).alias("stage"))
    no_findings = ran.limit(0).select("package", "stage", F.lit("").alias("check"), F.lit("").alias("severity"), F.lit("").alias("message"))
    return verify.gate(no_findings, packages, ran).select("package", "stage", "reached", "passed")


@query("""SELECT 'l_quantity' AS feature, false AS is_target, round(corr(l_quantity, l_extendedprice), 6) AS correlation FROM lineitem WHERE l_linenumber <> 3""")
def leakage_with_nan(spark, sf_dir):
    quantity = F.when(F.col("l_linenumber") == 3, F.lit(float("nan"))).otherwise(F.col("l_quantity"))
    lines = table(spark, sf_dir, "lineitem").withColumn("l_quantity", quantity)
    relation = verify.feature_relation(lines, "l_extendedprice", ["l_quantity"])
    return relation.withColumn("correlation", F.round("correlation", 6))


@query("SELECT o_orderkey, cast(3 * o_custkey + date_diff('day', DATE '1970-01-01', o_orderdate::DATE) AS BIGINT) AS prediction FROM orders WHERE o_orderkey % 5 = 0")
def baseline_linear_target(spark, sf_dir):
    """A target that is a linear function of a number and a date is predicted to the unit."""
    day = F.col("o_orderdate").cast("date")
    target = 3 * F.col("o_custkey") + F.datediff(day, F.lit("1970-01-01").cast("date"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", day.alias("day"), target.cast("double").alias("y"))
    held = F.col("o_orderkey") % 5 == 0
    predicted = fit_predict(orders.filter(~held), orders.filter(held).drop("y"), "y", "o_orderkey")
    return predicted.select("o_orderkey", F.round("prediction").cast("bigint").alias("prediction"))


def _sent_orders(spark, sf_dir, value):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("Id"), F.col("o_totalprice").alias("target"))
    return orders, orders.withColumn("target", value)


@query("""SELECT unnest(['rmse', 'accuracy']) AS metric, unnest(['failed', 'ok']) AS status, unnest(['text in place of numbers', NULL]) AS reason""")
def score_bad_text(spark, sf_dir):
    text = F.when(F.col("Id") % 100 == 0, "none").otherwise(F.col("target").cast("string"))
    answers, sent = _sent_orders(spark, sf_dir, text)
    return score.scores(answers, sent, ["rmse", "accuracy"]).select("metric", "status", "reason")


@query("""SELECT 'rmse' AS metric, 'failed' AS status, 'repeated solution ids' AS reason, count(*) AS n_solution FROM orders""")
def score_repeated_answers(spark, sf_dir):
    answers, sent = _sent_orders(spark, sf_dir, F.col("target"))
    twice = answers.unionByName(answers.filter("Id % 3 = 0"))
    return score.scores(twice, sent, ["rmse"]).select("metric", "status", "reason", "n_solution")


@query("""WITH e AS (SELECT CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END AS a, (user_id % 97 + 1) / 100 AS p FROM events),
c AS (SELECT p, sum(a) AS pos, sum(1 - a) AS neg FROM e GROUP BY 1),
w AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c)
SELECT 'auc' AS metric, round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 6) AS score FROM w
UNION ALL SELECT 'logloss', round(-avg(a * ln(p) + (1 - a) * ln(1 - p)), 6) FROM e
UNION ALL SELECT 'mse', round(avg((a - p) * (a - p)), 6) FROM e""")
def score_probabilities(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("Id"),
        F.when(F.col("event_type") == "error", 1.0).otherwise(0.0).alias("target"),
        ((F.col("user_id") % 97 + 1) / 100).alias("share"),
    )
    found = score.scores(events, events, ["auc", "logloss", "mse"], prediction="share")
    return found.select("metric", F.round("score", 6).alias("score"))


# --- merge, split and write ------------------------------------------------------------


@query("""SELECT split, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM (SELECT o_orderkey,
  CASE WHEN row_number() OVER (ORDER BY md5('42:' || o_orderkey)) <= (count(*) OVER () + 4) // 5 THEN 'test' ELSE 'train' END AS split FROM orders) t GROUP BY 1""")
def merge_split_write(spark, sf_dir):
    """Two tables with different columns are merged by name, split, written and read again."""
    from packwright.sources.checkpoints import scratch_folder
    from packwright.sources.writers import write_split

    orders, folder = table(spark, sf_dir, "orders"), scratch_folder(spark)
    parts = [orders.filter("o_orderkey % 2 = 0").drop("o_orderpriority"), orders.filter("o_orderkey % 2 <> 0").drop("o_orderstatus")]
    merged = package.merge_by_name(parts)
    write_split(split.random_split(merged, "o_orderkey"), folder, ".parquet")
    sides = [spark.read.parquet(f"{folder}/{s}").select(F.lit(s).alias("split"), "o_orderkey") for s in ("train", "test")]
    return sides[0].unionByName(sides[1]).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


# --- pages -----------------------------------------------------------------------------

_DECODED = "replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"


@query(f"""WITH m AS (SELECT page_id, url, regexp_replace(html, '(?is)<!--.*?-->|<script\\b[^>]*>.*?</script>|<style\\b[^>]*>.*?</style>', '', 'g') AS html FROM pages)
SELECT page_id, url, trim({_DECODED.format("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")}) AS title,
  'No abstract found' AS abstract, '' AS methods, '' AS results, '' AS captions, '' AS availability_links,
  'ok' AS status, cast(NULL AS VARCHAR) AS reason FROM m""")
def page_record_pages(spark, sf_dir):
    records = assets.page_record(table(spark, sf_dir, "pages"))
    return records.withColumn("availability_links", F.array_join("availability_links", " "))


@query("""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'quarantined' ELSE 'ok' END AS status, CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'caf' || chr(233) || ' ' || lang ELSE '' END AS methods
FROM documents""")
def page_broken_markup(spark, sf_dir):
    """A page that the parser rejects is kept aside; deep nesting and odd ends are no reason."""
    broken = F.concat(F.lit("<h2>Methods</h2><![foo "), "source", F.lit(" ]><p>x"))
    named = F.concat(F.lit("</i></b><h2>Methods</h2><p>caf&eacute; "), "lang", F.lit("</p></div>"))
    deep = F.concat(F.repeat(F.lit("<div>"), F.lit(2000)), F.lit("<h3>Other</h3>"))
    markup = F.when(F.col("doc_id") % 3 == 0, broken).when(F.col("doc_id") % 3 == 1, named).otherwise(deep)
    pages = table(spark, sf_dir, "documents").select("doc_id", markup.alias("html"))
    return assets.page_record(pages).select("doc_id", "status", "methods")


# --- many tables at once ---------------------------------------------------------------


@query("""SELECT l_returnflag AS name, 'Columns: quantity, mode' || chr(10) || count(*) || ' rows, 2 columns' || chr(10) ||
  '- quantity: non_null ' || count(*) || ' numbers ' || count(*) || ' mean ' || cast(avg(l_quantity) AS DECIMAL(20,2)) || ' min ' || cast(min(l_quantity) AS DECIMAL(20,2)) || ' max ' || cast(max(l_quantity) AS DECIMAL(20,2)) || chr(10) ||
  '- mode: non_null ' || count(*) || ' numbers 0 mean - min - max -' AS report FROM lineitem GROUP BY 1""")
def table_reports(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    rows = group_rank(lines.select("l_returnflag", "l_quantity", "l_linestatus", F.xxhash64(*lines.columns).alias("h")), ["l_returnflag"], ["h"], "row")
    cells = rows.select(
        F.col("l_returnflag").alias("name_"), "row",
        F.posexplode(F.array(F.col("l_quantity").cast("string"), F.col("l_linestatus"))).alias("position", "value"),
    )
    cells = cells.withColumn("name", F.when(F.col("position") == 0, "quantity").otherwise("mode"))
    return assets.table_reports(cells, ["name_"]).withColumnRenamed("name_", "name")


@query("""SELECT doc_id, v.t AS table_index, 't' || v.t || '.csv' AS suggested_filename,
  CASE WHEN v.t = 3 THEN 'no such table' WHEN v.t = 2 AND doc_id % 5 = 0 THEN 'invalid json' END AS reason,
  CASE WHEN v.t = 3 OR (v.t = 2 AND doc_id % 5 = 0) THEN NULL ELSE i END AS "Id",
  CASE WHEN v.t = 3 OR (v.t = 2 AND doc_id % 5 = 0) THEN NULL WHEN i = 0 THEN lang ELSE source END AS a
FROM documents, (VALUES (1), (2), (3)) v(t), (VALUES (0), (1)) w(i) WHERE i = 0 OR NOT (v.t = 3 OR (v.t = 2 AND doc_id % 5 = 0))""")
def table_batch(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    index = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))
    verdicts = documents.select("doc_id", index.alias("table_index"))
    verdicts = verdicts.withColumn("suggested_filename", F.concat(F.lit("t"), "table_index", F.lit(".csv")))
    cells = F.concat(F.lit('Cleaned: [{"a": "'), "lang", F.lit('"}, {"a": "'), "source", F.lit('"}'))
    end = F.when((F.col("table_index") == 2) & (F.col("doc_id") % 5 == 0), "}]").otherwise("] done")
    cleaned = documents.select("doc_id", cells.alias("cells"), index.alias("table_index")).filter("table_index < 3")
    cleaned = cleaned.select("doc_id", "table_index", F.concat("cells", end).alias("reply"))
    rows = assets.table_batch(verdicts, cleaned)
    return rows.select("doc_id", "table_index", "suggested_filename", "reason", "Id", F.try_element_at("values", F.lit("a")).alias("a"))
