"""Queries on tables: profiles, splits, packages and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from packwright.operators import package, profile, score, split
from packwright.operators.baseline import fit_predict
from packwright.operators.rank import global_rank, with_id
from packwright.operators.verify import feature_relation, leakage_findings, nonlinear_leakage_findings, rank_correlation, score_findings, target_dependence
from packwright.plans.registry import query
from packwright.plans.templates import table, template, with_template

# --- profiles --------------------------------------------------------------------------

LINEITEM_NUMBERS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
)


def _summary_sql(source: str, column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count({column}) AS n, round(avg({column}), 4) AS mean,
  round(stddev_samp({column}), 4) AS std, cast(min({column}) AS DOUBLE) AS min_value,
  round(quantile_cont(cast({column} AS DOUBLE), 0.25), 4) AS p25,
  round(quantile_cont(cast({column} AS DOUBLE), 0.5), 4) AS p50,
  round(quantile_cont(cast({column} AS DOUBLE), 0.75), 4) AS p75,
  cast(max({column}) AS DOUBLE) AS max_value FROM {source}"""


@query(" UNION ALL ".join(_summary_sql("lineitem", c) for c in LINEITEM_NUMBERS))
def profile_lineitem(spark, sf_dir):
    summary = profile.numeric_summary(table(spark, sf_dir, "lineitem"), LINEITEM_NUMBERS)
    rounded = [F.round(c, 4).alias(c) for c in ("mean", "std", "p25", "p50", "p75")]
    return summary.select(
        F.col("column").alias("column_name"),
        F.col("count").alias("n"),
        *rounded,
        F.col("min").alias("min_value"),
        F.col("max").alias("max_value"),
    )


@query(
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{name}' AS column_name, '{kind}' AS column_type, count({name}) AS non_null FROM orders"
        for i, (name, kind) in enumerate(
            [
                ("o_orderkey", "bigint"),
                ("o_custkey", "bigint"),
                ("o_orderstatus", "string"),
                ("o_totalprice", "double"),
                ("o_orderdate", "timestamp_ntz"),
                ("o_orderpriority", "string"),
            ]
        )
    )
)
def column_info_orders(spark, sf_dir):
    info = profile.column_info(table(spark, sf_dir, "orders"))
    return info.withColumnsRenamed({"column": "column_name", "type": "column_type"})


@query("SELECT count(*) AS n_rows, cast(6 AS BIGINT) AS n_columns, 'p_partkey,p_name,p_brand,p_type,p_size,p_retailprice' AS columns FROM part")
def shape_part(spark, sf_dir):
    found = profile.shape(table(spark, sf_dir, "part"))
    return found.withColumn("columns", F.array_join("columns", ","))


def _category_sql(source: str, column: str) -> str:
    return f"""SELECT '{column}' AS column_name, sum(freq) AS n, count(*) AS n_unique,
  arg_min(value, (-freq, value)) AS top, max(freq) AS freq
  FROM (SELECT {column} AS value, count(*) AS freq FROM {source} GROUP BY 1) c"""


@query(
    "SELECT column_name, cast(n AS BIGINT) AS n, n_unique, top, freq FROM ("
    + " UNION ALL ".join(_category_sql("events", c) for c in ("event_type", "props"))
    + ") u"
)
def categorical_summary_events(spark, sf_dir):
    summary = profile.categorical_summary(table(spark, sf_dir, "events"))
    return summary.withColumnsRenamed({"column": "column_name", "count": "n", "unique": "n_unique"})


HIGH_CARDINALITY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")


def _most_frequent_sql(column: str, source: str = "lineitem") -> str:
    return f"""(SELECT '{column}' AS column_name, sum(n)::BIGINT AS n, min(value) FILTER (rank = 1) AS top, max(n) AS freq FROM (
  SELECT value, n, rank() OVER (ORDER BY n DESC) AS rank FROM (
    SELECT {column}::VARCHAR AS value, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY 1)))"""


@query(" UNION ALL ".join(_most_frequent_sql(c) for c in HIGH_CARDINALITY))
def categorical_high_cardinality(spark, sf_dir):
    return profile.most_frequent(table(spark, sf_dir, "lineitem"), HIGH_CARDINALITY).withColumnsRenamed({"column": "column_name", "count": "n"})


# --- order and ids ---------------------------------------------------------------------


@query("SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS \"Id\" FROM orders")
def surrogate_id_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return with_id(orders, ["o_totalprice", "o_orderkey"])


@query("""SELECT l_returnflag, l_linestatus, l_linenumber,
  row_number() OVER (ORDER BY l_returnflag, l_linestatus, l_linenumber) - 1 AS "rank" FROM lineitem""")
def rank_of_repeated_rows(spark, sf_dir):
    columns = ["l_returnflag", "l_linestatus", "l_linenumber"]
    rows = table(spark, sf_dir, "lineitem").select(*columns)
    return global_rank(rows, columns, unique=False)


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice,
  row_number() OVER (ORDER BY l_extendedprice, l_orderkey, l_linenumber) - 1 AS place FROM lineitem""")
def rank_two_levels(spark, sf_dir):
    # Ranges of a few rows, so that both levels of the index are used at any scale.
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return global_rank(lines, ["l_extendedprice", "l_orderkey", "l_linenumber"], "place", rows_per_range=25)


@query("SELECT url, row_number() OVER (ORDER BY url) - 1 AS place FROM pages")
def sorted_pages(spark, sf_dir):
    return global_rank(table(spark, sf_dir, "pages").select("url"), ["url"], "place")


# --- splits ----------------------------------------------------------------------------

_RANDOM_ORDERS = """SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('42:' || cast(o_orderkey AS VARCHAR)), o_orderkey)
  <= (count(*) OVER () + 4) // 5 THEN 'test' ELSE 'train' END AS split FROM orders"""


@query(f"SELECT o_orderkey, split FROM ({_RANDOM_ORDERS}) s")
def split_random_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return split.random_split(orders, "o_orderkey")


@query("""WITH d AS (SELECT DISTINCT o_custkey FROM orders),
s AS (SELECT o_custkey, CASE WHEN row_number() OVER (ORDER BY md5('42:' || cast(o_custkey AS VARCHAR)))
  <= (count(*) OVER () + 4) // 5 THEN 'test' ELSE 'train' END AS split FROM d)
SELECT o_orderkey, o_custkey, split FROM orders JOIN s USING (o_custkey)""")
def split_random_dim_customer(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return split.dimension_split(orders, "o_custkey")


_LABELLED = "SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)"
_STRATIFIED = f"""WITH d AS ({_LABELLED}),
c AS (SELECT lang, count(*) AS n_c, (SELECT count(*) FROM d) AS n FROM d GROUP BY lang),
q AS (SELECT lang, n_c, n, (n + 4) // 5 AS t, n_c * ((n + 4) // 5) // n AS base, n_c * ((n + 4) // 5) % n AS rest FROM c),
p AS (SELECT lang, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, lang) <= t - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM q),
s AS (SELECT d.doc_id, d.lang, CASE WHEN row_number() OVER (PARTITION BY d.lang ORDER BY md5('42:' || cast(d.doc_id AS VARCHAR)))
  <= p.quota THEN 'test' ELSE 'train' END AS split FROM d JOIN p USING (lang))"""


def _labelled(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id")


@query(f"{_STRATIFIED} SELECT doc_id, lang, split FROM s")
def split_stratified_labels(spark, sf_dir):
    labelled = _labelled(spark, sf_dir).select("doc_id", "lang")
    return split.stratified_split(labelled, "doc_id", "lang")


@query(f"""{_STRATIFIED}, o AS (SELECT count(*) AS n, count(*) FILTER (split = 'test') AS n_test FROM s)
SELECT lang, count(*) AS n, count(*) FILTER (split = 'test') AS n_test,
  round(count(*) FILTER (split = 'test') / count(*), 6) AS test_share,
  round(count(*) FILTER (split = 'test') / count(*) - (SELECT n_test / n FROM o), 6) AS drift FROM s GROUP BY lang""")
def split_label_drift(spark, sf_dir):
    labelled = split.stratified_split(_labelled(spark, sf_dir).select("doc_id", "lang"), "doc_id", "lang")
    drift = split.label_drift(labelled, "lang")
    return drift.select("lang", "n", "n_test", F.round("test_share", 6).alias("test_share"), F.round("drift", 6).alias("drift"))


@query("""SELECT page_id, url, CASE WHEN row_number() OVER (ORDER BY url) <= count(*) OVER () * 4 // 5
  THEN 'train' ELSE 'test' END AS split FROM pages""")
def split_ordered_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return split.ordered_split(pages, ["url"])


@query("""WITH t AS (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS place, count(*) OVER () AS n FROM (SELECT DISTINCT ts FROM events) x),
c AS (SELECT ts AS cut FROM t WHERE place = n * 4 // 5)
SELECT event_id, CASE WHEN ts < (SELECT cut FROM c) THEN 'train' ELSE 'test' END AS split FROM events""")
def split_time_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return split.time_split(events, "ts").select("event_id", "split")


@query("""WITH t AS (SELECT o_orderdate, row_number() OVER (ORDER BY o_orderdate) - 1 AS place, count(*) OVER () AS n FROM (SELECT DISTINCT o_orderdate FROM orders) x),
c AS (SELECT o_orderdate AS cut FROM t WHERE place = n * 4 // 5)
SELECT CASE WHEN o_orderdate < (SELECT cut FROM c) THEN 'train' ELSE 'test' END AS split, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2""")
def split_time_sides(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderstatus")
    train, test = split.time_sides(orders, "o_orderdate")
    sides = [side.withColumn("split", F.lit(n)) for side, n in ((train, "train"), (test, "test"))]
    return package.merge_by_name(sides).groupBy("split", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT count(*) AS n, count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'test') AS n_test,
  round(count(*) FILTER (split = 'test') / count(*), 6) AS test_share, cast(0 AS BIGINT) AS shared_keys
FROM ({_RANDOM_ORDERS}) s""")
def split_audit(spark, sf_dir):
    parts = split.random_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")
    audit = split.audit_split(parts, "o_orderkey")
    return audit.withColumn("test_share", F.round("test_share", 6))


_MANIFEST_PROFILE = """, e AS (SELECT *, lower(ext) AS x FROM t),
h AS (SELECT dataset, x, count(*) AS n FROM e GROUP BY 1, 2),
r AS (SELECT dataset, x, n, list_position(['.csv','.nc','.h5','.hdf5','.jsonl','.json','.parquet','.tsv','.dat','.grib','.grib2','.jpg','.jpeg','.png','.bmp'], x) AS pref FROM h),
p AS (SELECT dataset, coalesce(arg_min(x, (-n, pref)) FILTER (pref > 0), 'unknown') AS primary_format FROM r GROUP BY 1),
d AS (SELECT dataset, bool_or(dir IN ('train','training')) AND bool_or(dir IN ('test','testing','validation','val')) AS presplit FROM t GROUP BY 1),
m AS (SELECT p.dataset, p.primary_format, d.presplit, coalesce(h.n, 0) AS matching_files
  FROM p JOIN d USING (dataset) LEFT JOIN h ON h.dataset = p.dataset AND h.x = p.primary_format)"""


@query(with_template("manifest", "").rstrip() + _MANIFEST_PROFILE + """
SELECT dataset, primary_format, presplit, matching_files,
  CASE WHEN presplit THEN 'copy_presplit' WHEN matching_files = 0 THEN 'none' WHEN matching_files > 50 THEN 'ordered_files'
    WHEN primary_format IN ('.csv','.parquet','.tsv') THEN 'merge_random' WHEN primary_format = '.nc' THEN 'time_or_dimension'
    WHEN primary_format IN ('.jpg','.jpeg','.png','.bmp') THEN 'stratified_images' ELSE 'none' END AS strategy FROM m""")
def split_strategy(spark, sf_dir):
    from packwright.operators.assets import detect_presplit

    files = template(spark, sf_dir, "manifest")
    formats = profile.dataset_profile(files, formats=profile.PRIMARY_EXTENSIONS)
    inside = F.substr("path", F.length("dataset") + F.lit(2))
    presplit = detect_presplit(files.withColumn("rel_path", inside))
    matching = F.coalesce(F.try_element_at("file_formats", F.col("primary_format")), F.lit(0))
    facts = formats.join(presplit, "dataset").select(
        "dataset",
        F.lit(True).alias("has_source"),
        "presplit",
        "primary_format",
        matching.alias("matching_files"),
    )
    return split.choose_strategy(facts).drop("has_source")


@query(with_template("manifest", """SELECT dataset,
  coalesce(max('train') FILTER (dir = 'train'), max('training') FILTER (dir = 'training')) AS train_dir,
  coalesce(max('test') FILTER (dir = 'test'), max('testing') FILTER (dir = 'testing'), max('validation') FILTER (dir = 'validation'), max('val') FILTER (dir = 'val')) AS test_dir,
  bool_or(dir IN ('train','training')) AND bool_or(dir IN ('test','testing','validation','val')) AS presplit
FROM t GROUP BY dataset"""))
def presplit_directories(spark, sf_dir):
    from packwright.operators.assets import detect_presplit

    files = template(spark, sf_dir, "manifest")
    inside = F.substr("path", F.length("dataset") + F.lit(2))
    return detect_presplit(files.withColumn("rel_path", inside))


@query(with_template("manifest", "").rstrip() + _MANIFEST_PROFILE + """,
s AS (SELECT *, CASE WHEN presplit THEN 'copy_presplit' WHEN matching_files = 0 THEN 'none' WHEN matching_files > 50 THEN 'ordered_files'
    WHEN primary_format IN ('.csv','.parquet','.tsv') THEN 'merge_random' WHEN primary_format = '.nc' THEN 'time_or_dimension'
    WHEN primary_format = '.jpg' THEN 'stratified_images' ELSE 'none' END AS strategy FROM m),
i AS (SELECT e.dataset, path, strategy, CASE WHEN row_number() OVER (PARTITION BY e.dataset ORDER BY md5('42:' || path)) <= (count(*) OVER (PARTITION BY e.dataset) + 4) // 5 THEN 'test' ELSE 'train' END AS part
  FROM e JOIN s ON e.dataset = s.dataset AND x = '.jpg' WHERE strategy = 'stratified_images'),
o AS (SELECT e.dataset, path, strategy, CASE WHEN row_number() OVER (PARTITION BY e.dataset ORDER BY path) <= count(*) OVER (PARTITION BY e.dataset) * 4 // 5 THEN 'train' ELSE 'test' END AS part
  FROM e JOIN s ON e.dataset = s.dataset AND x = primary_format WHERE strategy = 'ordered_files'),
g AS (SELECT e.dataset, path, strategy, row_number() OVER (PARTITION BY e.dataset ORDER BY length DESC, path) AS place
  FROM e JOIN s ON e.dataset = s.dataset AND x = primary_format WHERE strategy IN ('merge_random', 'time_or_dimension'))
SELECT e.dataset, path, strategy, CASE dir WHEN 'train' THEN 'train' WHEN 'val' THEN 'test' END AS part FROM e JOIN s USING (dataset) WHERE strategy = 'copy_presplit' AND dir IN ('train', 'val')
UNION ALL SELECT * FROM o UNION ALL SELECT * FROM i UNION ALL SELECT dataset, path, strategy, 'merge' FROM g WHERE place <= 10""")
def split_manifest_files(spark, sf_dir):
    from packwright.operators.assets import detect_presplit

    inside = F.substr("path", F.length("dataset") + F.lit(2))
    files = template(spark, sf_dir, "manifest").withColumn("rel_path", inside)
    formats = profile.dataset_profile(files, formats=profile.PRIMARY_EXTENSIONS)
    matching = F.coalesce(F.try_element_at("file_formats", F.col("primary_format")), F.lit(0))
    facts = formats.join(detect_presplit(files), "dataset").withColumns(
        {"has_source": F.lit(True), "matching_files": matching}
    )
    return split.split_manifest(files, split.choose_strategy(facts))


@query("""WITH n AS (SELECT (SELECT count(*) FROM customer) + 2 * (SELECT count(*) FROM supplier) AS n)
SELECT 'test' AS split, (n + 4) // 5 AS n FROM n UNION ALL SELECT 'train', n - (n + 4) // 5 FROM n""")
def split_merged_rows(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"))
    merged = package.merge_by_name([customer, supplier, supplier])
    parts = split.random_row_split(merged)
    return parts.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


# --- packages --------------------------------------------------------------------------


@query(f"""WITH s AS ({_RANDOM_ORDERS})
SELECT 'train' AS part, o_orderkey, o_custkey, o_totalprice FROM s WHERE split = 'train'
UNION ALL SELECT 'test', o_orderkey, o_custkey, NULL FROM s WHERE split = 'test'
UNION ALL SELECT 'answer', o_orderkey, NULL, o_totalprice FROM s WHERE split = 'test'""")
def target_hiding(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    parts = package.hide_target(split.random_split(orders, "o_orderkey"), "o_orderkey", "o_totalprice")
    named = [p.withColumn("part", F.lit(n)) for p, n in zip(parts, ("train", "test", "answer"))]
    return package.merge_by_name(named)


@query(f"""WITH s AS ({_RANDOM_ORDERS})
SELECT o_orderkey, (SELECT round(avg(o_totalprice), 4) FROM s WHERE split = 'train') AS o_totalprice FROM s WHERE split = 'test'""")
def sample_submission(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    train, test, _ = package.hide_target(
        split.random_split(orders, "o_orderkey"), "o_orderkey", "o_totalprice"
    )
    sample = package.sample_submission(test, train, "o_orderkey", "o_totalprice")
    return sample.withColumn("o_totalprice", F.round("o_totalprice", 4))


@query(f"""WITH s AS ({_RANDOM_ORDERS}),
c AS (SELECT o_orderstatus, count(*) AS n FROM s WHERE split = 'train' GROUP BY 1)
SELECT o_orderkey, (SELECT arg_min(o_orderstatus, (-n, o_orderstatus)) FROM c) AS o_orderstatus FROM s WHERE split = 'test'""")
def sample_submission_class(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    train, test, _ = package.hide_target(
        split.random_split(orders, "o_orderkey"), "o_orderkey", "o_orderstatus"
    )
    return package.sample_submission(test, train, "o_orderkey", "o_orderstatus")


@query("""SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment, cast(c_custkey AS DOUBLE) AS size, NULL AS brand FROM customer
UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL, cast(s_suppkey AS DOUBLE), NULL FROM supplier
UNION ALL SELECT p_name, NULL, p_retailprice, NULL, cast(p_size AS DOUBLE), p_brand FROM part""")
def merge_tables(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_custkey").alias("size"),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("size"),
        F.col("s_acctbal").alias("balance"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
    )
    part = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("balance"),
        F.col("p_size").alias("size"),
        F.col("p_brand").alias("brand"),
    )
    return package.merge_by_name([customer, supplier, part])


@query(with_template("manifest", "SELECT dataset, path, length FROM t ORDER BY length DESC, path LIMIT 10"))
def top_files(spark, sf_dir):
    files = template(spark, sf_dir, "manifest").select("dataset", "path", "length")
    return split.top_files(files)


@query(with_template("manifest", """SELECT dataset, path, length, place FROM (SELECT *,
  row_number() OVER (PARTITION BY dataset ORDER BY length DESC, path) AS place FROM t) x WHERE place <= 10"""))
def top_files_per_dataset(spark, sf_dir):
    files = template(spark, sf_dir, "manifest").select("dataset", "path", "length")
    return split.top_files(files, by="dataset").withColumn("place", F.col("place").cast("bigint"))


# --- scores ----------------------------------------------------------------------------

_GUESS = "o_totalprice * 0.9 + o_custkey"


@query(f"""WITH e AS (SELECT o_totalprice AS a, {_GUESS} AS p FROM orders),
n AS (SELECT count(*) AS n_solution, sqrt(avg((a - p) * (a - p))) AS rmse, avg(abs(a - p)) AS mae,
  1 - sum((a - p) * (a - p)) / (var_pop(a) * count(*)) AS r2 FROM e)
SELECT metric, round(score, 4) AS score, 'ok' AS status, n_solution FROM (
  SELECT 'rmse' AS metric, rmse AS score, n_solution FROM n
  UNION ALL SELECT 'mae', mae, n_solution FROM n UNION ALL SELECT 'r2', r2, n_solution FROM n) u""")
def score_regression(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").alias("Id")
    answers = orders.select(key, F.col("o_totalprice").alias("target"))
    guesses = orders.select(key, F.expr(_GUESS).alias("target"))
    rows = score.scores(answers, guesses, ["rmse", "mae", "r2"])
    return rows.select("metric", F.round("score", 4).alias("score"), "status", "n_solution")


@query("""WITH e AS (SELECT l_extendedprice AS a, l_extendedprice * 0.9 + l_quantity * 10 AS p FROM lineitem)
SELECT round(sqrt(avg((a - p) * (a - p))), 4) AS rmse, round(avg(abs(a - p)), 4) AS mae,
  round(1 - sum((a - p) * (a - p)) / (var_pop(a) * count(*)), 4) AS r2 FROM e""")
def regression_metrics_lineitem(spark, sf_dir):
    guess = F.expr("l_extendedprice * 0.9 + l_quantity * 10").alias("predicted")
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("actual"), guess)
    metrics = score.regression_metrics(pairs)
    return metrics.select(*[F.round(c, 4).alias(c) for c in metrics.columns])


@query("""WITH e AS (SELECT quality AS a, CASE WHEN doc_id % 3 = 0 THEN 1 - quality ELSE quality END AS p FROM labels),
l AS (SELECT DISTINCT a AS label FROM e UNION SELECT DISTINCT p FROM e),
m AS (SELECT label, (SELECT count(*) FROM e WHERE a = label) AS support, (SELECT count(*) FROM e WHERE p = label) AS predicted,
  (SELECT count(*) FROM e WHERE a = label AND p = label) AS tp FROM l)
SELECT label, support, round(coalesce(tp / nullif(predicted, 0), 0), 6) AS "precision",
  round(coalesce(tp / nullif(support, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(predicted + support, 0), 0), 6) AS f1 FROM m""")
def score_classification(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    guess = F.when(F.col("doc_id") % 3 == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    pairs = labels.select(F.col("quality").alias("actual"), guess.alias("predicted"))
    per_class = score.per_class_metrics(pairs)
    rounded = [F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")]
    return per_class.select("label", "support", *rounded)


@query("""WITH e AS (SELECT event_type AS a, CASE WHEN event_id % 4 = 0 THEN 'click' ELSE event_type END AS p FROM events),
l AS (SELECT DISTINCT a AS label FROM e UNION SELECT DISTINCT p FROM e),
s AS (SELECT a AS label, count(*) AS support, count(*) FILTER (a = p) AS tp FROM e GROUP BY 1),
g AS (SELECT p AS label, count(*) AS predicted FROM e GROUP BY 1),
m AS (SELECT label, coalesce(tp, 0) AS tp, coalesce(support, 0) AS support, coalesce(predicted, 0) AS predicted
  FROM l LEFT JOIN s USING (label) LEFT JOIN g USING (label))
SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(avg(coalesce(tp / nullif(predicted, 0), 0)), 6) AS precision_macro,
  round(avg(coalesce(tp / nullif(support, 0), 0)), 6) AS recall_macro,
  round(avg(coalesce(2 * tp / nullif(predicted + support, 0), 0)), 6) AS f1_macro FROM m""")
def score_macro_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    guess = F.when(F.col("event_id") % 4 == 0, "click").otherwise(F.col("event_type"))
    pairs = events.select(F.col("event_type").alias("actual"), guess.alias("predicted"))
    metrics = score.classification_metrics(pairs)
    return metrics.select(*[F.round(c, 6).alias(c) for c in metrics.columns])


@query(f"""WITH s AS ({_RANDOM_ORDERS}),
g AS (SELECT avg(o_totalprice) AS m FROM s WHERE split = 'train'),
c AS (SELECT o_orderstatus, count(*) AS n FROM s WHERE split = 'train' GROUP BY 1),
b AS (SELECT arg_min(o_orderstatus, (-n, o_orderstatus)) AS m FROM c)
SELECT 'rmse' AS metric, round(sqrt(avg((o_totalprice - (SELECT m FROM g)) * (o_totalprice - (SELECT m FROM g)))), 4) AS score, 'ok' AS status FROM s WHERE split = 'test'
UNION ALL SELECT 'accuracy', round(avg(CASE WHEN o_orderstatus = (SELECT m FROM b) THEN 1.0 ELSE 0.0 END), 4), 'ok' FROM s WHERE split = 'test'""")
def chance_baseline(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    parts = split.random_split(orders, "o_orderkey")

    def scored(target, metric):
        train, _, answer = package.hide_target(parts, "o_orderkey", target)
        return score.chance_baseline(train, answer, metric, "o_orderkey", target)

    both = scored("o_totalprice", "rmse").union(scored("o_orderstatus", "accuracy"))
    return both.select("metric", F.round("score", 4).alias("score"), "status")


@query("""WITH s AS (SELECT o_orderkey AS id, o_totalprice AS p FROM orders WHERE o_orderkey % 10 <> 0
  UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 10 = 1
  UNION ALL SELECT -o_orderkey - 1, o_totalprice FROM orders WHERE o_orderkey % 50 = 0),
u AS (SELECT id, count(*) AS copies FROM s GROUP BY 1)
SELECT count(o_orderkey) AS n_solution, count(*) FILTER (o_orderkey IS NOT NULL AND id IS NULL) AS n_missing,
  count(*) FILTER (o_orderkey IS NULL) AS n_unknown, count(*) FILTER (copies > 1) AS n_repeated, cast(0 AS BIGINT) AS n_empty,
  'failed' AS status, 'missing ids' AS reason FROM orders FULL JOIN u ON o_orderkey = id""")
def score_coverage(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Id"), F.col("o_totalprice").alias("target")
    )
    unknown = orders.filter("Id % 50 = 0").withColumn("Id", -F.col("Id") - 1)
    sent = orders.filter("Id % 10 <> 0").union(orders.filter("Id % 10 = 1")).union(unknown)
    return score.score(orders, sent, "rmse").drop("metric", "score")


@query("""SELECT 'u' || cast(event_id AS VARCHAR) AS package, CASE WHEN event_type = 'error' THEN 'run failed' ELSE 'score is not a number' END AS message
FROM events WHERE event_type = 'error' OR user_id % 7 = 0""")
def score_validity(spark, sf_dir):
    value = F.when(F.col("user_id") % 7 == 0, F.lit(float("nan"))).otherwise(-F.col("value"))
    runs = table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), F.col("event_id").cast("string")).alias("package"),
        F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("status"),
        value.alias("score"),
    )
    return score_findings(runs).select("package", "message")


@query(f"SELECT o_orderkey, true AS predicted FROM ({_RANDOM_ORDERS}) s WHERE split = 'test'")
def baseline_model(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    train, test, _ = package.hide_target(
        split.random_split(orders, "o_orderkey"), "o_orderkey", "o_totalprice"
    )
    predicted = fit_predict(train, test, "o_totalprice", "o_orderkey")
    return predicted.select("o_orderkey", F.col("prediction").isNotNull().alias("predicted"))


@query(f"SELECT o_orderkey, true AS predicted FROM ({_RANDOM_ORDERS}) s WHERE split = 'test'")
def baseline_classifier(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    train, test, _ = package.hide_target(
        split.random_split(orders, "o_orderkey"), "o_orderkey", "o_orderstatus"
    )
    predicted = fit_predict(train, test, "o_orderstatus", "o_orderkey", "classification")
    known = F.col("prediction").isin("F", "O", "P")
    return predicted.select("o_orderkey", known.alias("predicted"))


# --- leakage ---------------------------------------------------------------------------

_LINE_FEATURES = ("l_quantity", "l_discount", "l_tax", "net", "copy")
_LINES = "SELECT *, l_extendedprice * (1 - l_discount) AS net, l_extendedprice AS copy FROM lineitem"


def _lines(spark, sf_dir):
    price = F.col("l_extendedprice")
    return (
        table(spark, sf_dir, "lineitem")
        .withColumn("net", price * (1 - F.col("l_discount")))
        .withColumn("copy", price)
    )


@query(f"WITH l AS ({_LINES}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, bool_and({c} IS NOT DISTINCT FROM l_extendedprice) AS is_target, round(corr({c}, l_extendedprice), 6) AS correlation FROM l"
    for c in _LINE_FEATURES
))
def feature_relations(spark, sf_dir):
    relation = feature_relation(_lines(spark, sf_dir), "l_extendedprice", _LINE_FEATURES)
    return relation.withColumn("correlation", F.round("correlation", 6))


@query(f"WITH l AS ({_LINES}), r AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, bool_and({c} IS NOT DISTINCT FROM l_extendedprice) AS is_target, corr({c}, l_extendedprice) AS c FROM l"
    for c in _LINE_FEATURES
) + """) SELECT 'lines' AS package, 2 AS stage, 'leakage' AS "check", CASE WHEN is_target THEN 'error' ELSE 'warning' END AS severity,
feature AS message FROM r WHERE is_target OR abs(c) > 0.95""")
def leakage_audit(spark, sf_dir):
    return leakage_findings(
        _lines(spark, sf_dir), "l_extendedprice", _LINE_FEATURES, package="lines"
    )


_MONOTONE = ("l_quantity", "l_discount", "inverse", "l_linenumber")


@query("WITH l AS (SELECT *, 1000 / l_extendedprice AS inverse FROM lineitem) " + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count(*) AS n, round(corr(a, b), 6) AS rank_correlation FROM (
  SELECT rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS a,
    rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS b FROM l)"""
    for c in _MONOTONE
))
def leakage_monotone(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("inverse", 1000 / F.col("l_extendedprice"))
    found = rank_correlation(lines, "l_extendedprice", _MONOTONE)
    return found.withColumn("rank_correlation", F.round("rank_correlation", 6))


_NATIONS = "SELECT c.*, n_regionkey, c_custkey % 4 AS quarter FROM customer c JOIN nation ON c_nationkey = n_nationkey"
_DETERMINING = ("c_nationkey", "c_mktsegment", "c_custkey", "quarter")


def _customers_by_region(spark, sf_dir):
    nations = F.broadcast(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"))
    return table(spark, sf_dir, "customer").join(nations, "c_nationkey").withColumn("quarter", F.col("c_custkey") % 4)


@query(f"WITH l AS ({_NATIONS}) " + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, sum(n)::BIGINT AS n, count(*) AS n_values, count(*) FILTER (fixed) AS n_determined,
  round(coalesce(sum(n) FILTER (fixed), 0) / sum(n), 6) AS determined_share
FROM (SELECT {c}, count(*) AS n, count(DISTINCT n_regionkey) = 1 AS fixed FROM l GROUP BY 1)"""
    for c in _DETERMINING
))
def leakage_determined(spark, sf_dir):
    found = target_dependence(_customers_by_region(spark, sf_dir), "n_regionkey", _DETERMINING)
    return found.withColumn("determined_share", F.round("determined_share", 6))


@query("""SELECT 'regions' AS package, 2 AS stage, 'leakage_determined' AS "check", 'warning' AS severity, 'c_nationkey' AS message WHERE EXISTS (SELECT 1 FROM customer)""")
def leakage_nonlinear_audit(spark, sf_dir):
    return nonlinear_leakage_findings(_customers_by_region(spark, sf_dir), "n_regionkey", _DETERMINING, package="regions")
