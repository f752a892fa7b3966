"""Inputs the tables do not hold, derived from their rows by SQL.

Each template runs unchanged in Spark SQL and in the SQL engine of the correctness check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TEMPLATES = {
    # Model replies: fenced object, object in prose, list, cut-off, none, single quotes, and
    # braces in the prose before the object.
    "reply": """
SELECT doc_id, doc_id % 7 AS shape,
  CASE doc_id % 7
    WHEN 0 THEN 'Sure:' || chr(10) || repeat(chr(96),3) || 'json' || chr(10) || '{"doc_id": ' || cast(doc_id as string) || ', "lang": "' || lang || '"}' || chr(10) || repeat(chr(96),3) || chr(10) || 'Done.'
    WHEN 1 THEN 'Result {"doc_id": ' || cast(doc_id as string) || ', "lang": "' || lang || '"} end'
    WHEN 2 THEN 'List: [{"doc_id": ' || cast(doc_id as string) || ', "lang": "' || lang || '"}, {"doc_id": -1, "lang": "xx"}] end'
    WHEN 3 THEN 'Cut {"doc_id": ' || cast(doc_id as string) || ', "lang": "' || lang || '"'
    WHEN 4 THEN 'I cannot answer.'
    WHEN 5 THEN '{' || chr(39) || 'doc_id' || chr(39) || ': ' || cast(doc_id as string) || '}'
    ELSE 'see {note} {"doc_id": ' || cast(doc_id as string) || '}'
  END AS reply
FROM documents
""",
    # Code replies and review verdicts: Python fence, plain fence, none, unclosed Python
    # fence after a plain one, and an empty Python fence.
    "code": """
SELECT conv_id, turn, (conv_id + turn) % 5 AS shape,
  CASE (conv_id + turn) % 5
    WHEN 0 THEN 'Use Python:' || chr(10) || repeat(chr(96),3) || 'python' || chr(10) || 'x = ' || cast(turn as string) || chr(10) || repeat(chr(96),3) || ' ok'
    WHEN 1 THEN 'Run ' || repeat(chr(96),3) || ' ls -' || cast(turn as string) || ' ' || repeat(chr(96),3)
    WHEN 2 THEN ' plain ' || cast(conv_id as string) || ' '
    WHEN 3 THEN repeat(chr(96),3) || 'a' || cast(turn as string) || repeat(chr(96),3) || ' then ' || repeat(chr(96),3) || 'python b'
    ELSE 'none ' || repeat(chr(96),3) || 'python' || repeat(chr(96),3)
  END AS reply,
  CASE conv_id % 4 WHEN 0 THEN ' ok' WHEN 1 THEN 'warn: weak metric' WHEN 2 THEN ' FAIL: leak' ELSE 'Unclear' END AS verdict
FROM conversations
""",
    # Page text with section markers; every fourth page lacks one marker.
    "sections": """
SELECT doc_id, doc_id % 4 AS shape,
  'Overview Description link keyboard_arrow_up about ' || source ||
  CASE WHEN doc_id % 4 = 3 THEN '' ELSE ' Background link keyboard_arrow_up lang ' || lang END ||
  ' Evaluation score ' || cast(n_chars as string) ||
  CASE doc_id % 4 WHEN 0 THEN ' Timeline soon' WHEN 1 THEN ' Code here Data there' ELSE '' END AS page_text
FROM documents
""",
    # Text with numbered captions, and a number of images that may exceed them.
    "captions": """
SELECT doc_id, doc_id % 4 AS n_images,
  'Intro' || chr(10) ||
  CASE WHEN doc_id % 3 >= 1 THEN 'Fig. 1 | Plot of ' || source || chr(10) ELSE '' END ||
  CASE WHEN doc_id % 3 = 2 THEN 'text Figure 2|  Bars for ' || lang || chr(10) ELSE '' END || 'End' AS full_text
FROM documents
""",
    # A paper page with headings, a figure and repository links.
    "html": """
SELECT doc_id,
  '<html><body><h1> Paper ' || cast(doc_id as string) || ' </h1><section aria-labelledby="Abs1"><p>About ' || source ||
  '</p></section><h2>Methods</h2><p>M1 ' || lang || '</p><p>M2</p><h3>Detail</h3><p>skip</p><h2>Results and use</h2><p>R ' ||
  cast(n_chars as string) || '</p><figure><img src="a.png"><figcaption>Cap ' || source || '</figcaption></figure>' ||
  '<a href="https://github.com/org/' || source || '">c</a><a href="https://github.com/org/' || source || '">c</a>' ||
  '<a href="https://zenodo.org/records/' || cast(doc_id as string) || '">d</a><a href="https://www.github.com/x">n</a><a href="/rel">r</a></body></html>' AS html
FROM documents
""",
    # Links and sources to route.
    "links": """
SELECT doc_id,
  CASE doc_id % 6
    WHEN 0 THEN 'https://github.com/org/' || source || '.git'
    WHEN 1 THEN 'https://zenodo.org/records/' || cast(doc_id as string)
    WHEN 2 THEN 'https://doi.org/10.5281/zenodo.' || cast(doc_id as string)
    WHEN 3 THEN 'https://figshare.com/articles/' || source || '/v'
    WHEN 4 THEN 'local/' || source || '.PDF'
    ELSE 'local/' || source || '.docx'
  END AS link
FROM documents
""",
    # File listing of datasets: four of one format with many files, and small mixed ones.
    "manifest": """
SELECT dataset, dataset || '/' || dir || '/f ' || cast(doc_id as string) || ext AS path, dir, ext, n_chars AS length
FROM (
  SELECT doc_id, n_chars,
    CASE WHEN doc_id < 500 THEN 'ds' || cast(doc_id % 4 as string) ELSE source END AS dataset,
    CASE WHEN doc_id >= 500 AND source IN ('src1','src2') THEN CASE doc_id % 3 WHEN 0 THEN 'training' WHEN 1 THEN 'val' ELSE 'train' END ELSE 'raw' END AS dir,
    CASE WHEN doc_id < 500 THEN CASE doc_id % 4 WHEN 0 THEN '.csv' WHEN 1 THEN '.nc' WHEN 2 THEN '.parquet' ELSE '.jpg' END
         ELSE CASE (doc_id + n_chars) % 6 WHEN 0 THEN '.csv' WHEN 1 THEN '.CSV' WHEN 2 THEN '.tsv' WHEN 3 THEN '.py' WHEN 4 THEN '.pkl' ELSE '' END END AS ext
  FROM documents) t
""",
    # Task proposals: valid, missing key, unknown key, unknown target, bad task type.
    "proposal": """
SELECT p_partkey, p_partkey % 5 AS shape,
  '{"prediction_target": "' || CASE WHEN p_partkey % 5 = 3 THEN 'no_such' ELSE 'p_retailprice' END ||
  '", "evaluation_metric": "RMSE", "task_type": "' || CASE WHEN p_partkey % 5 = 4 THEN 'ranking' ELSE 'regression' END ||
  '", "feature_columns": ["p_size", "p_type"], "data_utilization": "all"' ||
  CASE WHEN p_partkey % 5 = 1 THEN '' ELSE ', "justification": "' || p_brand || '"' END ||
  CASE WHEN p_partkey % 5 = 2 THEN ', "extra": 1' ELSE '' END || '}' AS proposal
FROM part
""",
    # Repository records with three files each; every fifth record is cut off.
    "record": """
SELECT doc_id,
  '{"files": [{"key": "' || source || '/d' || cast(doc_id as string) || '.csv", "size": ' || cast(n_chars as string) ||
  ', "links": {"self": "https://zenodo.org/f/' || cast(doc_id as string) || '"}}, {"key": "a' || cast(doc_id as string) ||
  CASE WHEN doc_id % 3 = 0 THEN '.zip' ELSE '.txt' END || '", "size": 7, "links": {"self": "https://zenodo.org/g"}}, {"key": "b.zip", "size": 8, "links": {"self": "https://zenodo.org/h"}}' ||
  CASE WHEN doc_id % 5 = 4 THEN '' ELSE ']}' END AS record
FROM documents
""",
    # Package listings: one package per customer, with a path left out by key.
    "package": """
SELECT 'c' || cast(c_custkey as string) AS package, rel_path, is_dir
FROM (
  SELECT c_custkey, 0 AS slot, 'data' AS rel_path, true AS is_dir FROM customer
  UNION ALL SELECT c_custkey, 1, 'data/raw', true FROM customer
  UNION ALL SELECT c_custkey, 2, 'prepare.py', false FROM customer
  UNION ALL SELECT c_custkey, 3, 'metric.py', false FROM customer
  UNION ALL SELECT c_custkey, 4, 'description.txt', false FROM customer
  UNION ALL SELECT c_custkey, 5, 'data/public/train.csv', false FROM customer
  UNION ALL SELECT c_custkey, 6, 'data/public/test.csv', false FROM customer
  UNION ALL SELECT c_custkey, 7, 'data/public/sample_submission.csv', false FROM customer
  UNION ALL SELECT c_custkey, 8, 'data/private/test_answer.csv', false FROM customer
) t WHERE c_custkey % 11 <> slot
""",
    # Source files of packages: right and wrong interfaces, and broken syntax.
    "source": """
SELECT 'd' || cast(doc_id as string) AS package,
  CASE WHEN doc_id % 2 = 0 THEN 'prepare.py' ELSE 'metric.py' END AS rel_path,
  CASE doc_id % 6
    WHEN 0 THEN 'def prepare(raw, public, private):' || chr(10) || '    return ' || cast(n_chars as string)
    WHEN 2 THEN 'def prepare(raw, public):' || chr(10) || '    return ' || cast(n_chars as string)
    WHEN 4 THEN 'def ready(a, b, c):' || chr(10) || '    return ' || cast(n_chars as string)
    WHEN 1 THEN 'class Score(BaseMetric):' || chr(10) || '    weight = ' || cast(n_chars as string)
    WHEN 3 THEN 'class Score(object):' || chr(10) || '    weight = ' || cast(n_chars as string)
    ELSE 'class Score(:' || cast(n_chars as string)
  END AS source
FROM documents
""",
}

# Tables each template reads.
READS = {
    "reply": ("documents",),
    "code": ("conversations",),
    "sections": ("documents",),
    "captions": ("documents",),
    "html": ("documents",),
    "links": ("documents",),
    "manifest": ("documents",),
    "proposal": ("part",),
    "record": ("documents",),
    "package": ("customer",),
    "source": ("documents",),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def template(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows of a template."""
    for source in READS[name]:
        table(spark, sf_dir, source).createOrReplaceTempView(source)
    return spark.sql(TEMPLATES[name])


def with_template(name: str, query: str) -> str:
    """SQL of the check: ``query`` over the template as ``t``."""
    return f"WITH t AS ({TEMPLATES[name].strip()}) {query.strip()}"
