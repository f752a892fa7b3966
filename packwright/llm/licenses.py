"""License scan by a positional index of rare words, with SQL functions only.

Every template of a license notice is indexed by its rarest words and their places in it. How rare
a word is comes from counts over all files. A file's words that are among these look up the
postings; a template is found where enough of its rare words stand in the file at one relative
position, and counts only if the file also holds all key phrases that the license demands. Besides,
fixed base phrases are counted wherever their words stand consecutively.

A word is a run of characters other than the ASCII ones that are no letters or digits; A-Z count as
a-z. Null and empty texts have no words, places or labels, and score 0. Repeated rows give repeated
results, rows with a null id too. The templates and phrases are of fixed size and may be broadcast;
nothing else is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packwright.llm.components import stored

# Base phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# License notices as label, text, and key phrases that have to be there.
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction", ("permission is hereby granted free of charge", "without restriction")),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "licensed under the gnu affero general public license", ("affero general public license",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license", "2 0")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "conditions are met")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee")),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("cc0-1.0", "released under cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
    ("proprietary", "proprietary and confidential unauthorized copying of this file via any medium is strictly prohibited", ("proprietary and confidential", "strictly prohibited")),
)
# Words too common to point at a license.
STOP = frozenset("a and any are at by for form forms from in into is it of on or over that the this to use v was with without".split())

#: Rare words that index a template, and the share of them that has to agree.
ANCHORS, AGREE = 6, 0.75
#: Licence words a file needs before it is looked up.
FEWEST = 2

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def vocabulary() -> list[str]:
    """All words of the templates but the common ones."""
    return sorted({w for _, text, _ in TEMPLATES for w in text.split()} - STOP)


def spaced(text: Column) -> Column:
    """The words of a text, two spaces between them: each then has a space of its own on both sides."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _UPPER.lower())
    return F.trim(F.regexp_replace(lower, _GAP, "  "))


def _words(part: Column) -> Column:
    """Number of words of a part of a spaced text."""
    part = F.trim(part)
    return F.when(part == "", F.lit(0)).otherwise(F.octet_length(part) - F.octet_length(F.replace(part, F.lit("  "), F.lit(" "))) + 1).cast("bigint")


def _padded(phrase: str) -> str:
    return " " + "  ".join(phrase.split()) + " "


def _base(words: str = "words", total: str = "n_words") -> list[Column]:
    """Counts, first and last place of every base phrase in a padded text."""
    columns = []
    for i, (phrase, _) in enumerate(PHRASES):
        mark = _padded(phrase)
        count = ((F.octet_length(words) - F.octet_length(F.replace(F.col(words), F.lit(mark), F.lit("")))) / len(mark)).cast("bigint")
        there = F.contains(F.col(words), F.lit(mark))
        columns += [
            F.when(there, count).otherwise(F.lit(0).cast("bigint")).alias(f"count_{i}"),
            F.when(there, _words(F.substring_index(words, mark, 1))).alias(f"first_{i}"),
            F.when(there, F.col(total) - _words(F.substring_index(words, mark, -1)) - len(phrase.split())).alias(f"last_{i}"),
        ]
    return columns


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_words, n_base, first_word, last_word, base_labels, labels, score)`` of every row.

    ``score`` is the largest share of a found template's rare words that agree in position, and at
    least one half with a base phrase.
    """
    spark = df.sparkSession
    known = F.array(*[F.lit(w) for w in vocabulary()])
    texts = df.select(F.col(id_col).alias("id"), spaced(F.col(text_col)).alias("words"))
    texts = texts.select("id", F.xxhash64("words").alias("mark"), F.concat(F.lit(" "), "words", F.lit(" ")).alias("words"), _words(F.col("words")).alias("n_words"))
    found = F.array_intersect(F.split(F.trim("words"), "  "), known)
    rows = texts.select("id", "mark", "n_words", "words", found.alias("found"), *_base())
    keep = F.when(F.size("found") >= FEWEST, F.col("words"))
    rows = stored(rows.withColumn("words", keep))

    # Document frequencies of licence words, over all files; rarer is better, then earlier.
    counts = rows.select(F.explode("found").alias("word")).groupBy("word").agg(F.count("*").alias("files"))
    template = spark.createDataFrame(
        [(i, label, text.split(), [_padded(k) for k in keys]) for i, (label, text, keys) in enumerate(TEMPLATES)],
        "template int, label string, tokens array<string>, keys array<string>",
    )
    places = template.select("template", F.posexplode("tokens").alias("place", "word")).where(F.col("word").isin(vocabulary()))
    rarity = Window.partitionBy("template").orderBy(F.coalesce("files", F.lit(0)), "place")
    postings = places.join(counts, "word", "left").withColumn("rank", F.row_number().over(rarity)).where(F.col("rank") <= ANCHORS)
    postings = postings.select("template", "place", "word")
    needed = postings.groupBy("template").agg(F.count("*").alias("anchors"))
    template = template.join(needed, "template")

    files = rows.where("words is not null").dropDuplicates(["id", "mark"])
    tokens = files.select("id", "mark", F.posexplode(F.split(F.trim("words"), "  ")).alias("at", "word"))
    hits = tokens.join(F.broadcast(postings), "word").groupBy("id", "mark", "template", (F.col("at") - F.col("place")).alias("shift")).agg(F.count("*").alias("agree"))
    best = hits.groupBy("id", "mark", "template").agg(F.max("agree").alias("agree"))
    best = best.join(F.broadcast(template), "template").where(F.col("agree") >= F.col("anchors") * AGREE)
    same = [F.col("f.id").eqNullSafe(F.col("b.id")), F.col("f.mark") == F.col("b.mark")]
    proven = files.alias("f").join(best.alias("b"), same).where(F.forall("keys", lambda k: F.contains(F.col("words"), k)))
    evidence = proven.groupBy("b.id", "b.mark").agg(F.collect_set("label").alias("found_labels"), F.max(F.col("agree") / F.col("anchors")).alias("share"))

    base = F.array_compact(F.array(*[F.when(F.col(f"count_{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(PHRASES)]))
    n_base = sum((F.col(f"count_{i}") for i in range(1, len(PHRASES))), F.col("count_0"))
    same = [F.col("r.id").eqNullSafe(F.col("e.id")), F.col("r.mark") == F.col("e.mark")]
    joined = rows.drop("words", "found").alias("r").join(evidence.alias("e"), same, "left")
    return joined.select(
        F.col("r.id").alias(id_col),
        "n_words",
        n_base.alias("n_base"),
        F.least(*[f"first_{i}" for i in range(len(PHRASES))]).alias("first_word"),
        F.greatest(*[f"last_{i}" for i in range(len(PHRASES))]).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("found_labels", F.array().cast("array<string>")))), ",").alias("labels"),
        F.greatest(F.coalesce("share", F.lit(0.0)), F.when(n_base > 0, F.lit(0.5)).otherwise(F.lit(0.0))).alias("score"),
    )


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def sql() -> str:
    """DuckDB SQL for :func:`scan` over ``documents``."""
    phrases = ", ".join(f"({_list(p.split())}, '{label}')" for p, label in PHRASES)
    templates = ", ".join(f"({i}, '{label}', {_list(t.split())}, {_list(_padded(k) for k in keys)})" for i, (label, t, keys) in enumerate(TEMPLATES))
    return rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
phrases(words, label) AS (VALUES {phrases}),
templates(template, label, tokens, keys) AS (VALUES {templates}),
spots AS (SELECT doc_id, w, len(w) AS n, unnest(range(1, len(w) + 1)) AS i FROM docs),
base AS (
  SELECT doc_id, count(*) AS n_base, min(i - 1) AS first_word, max(i - 1) AS last_word, list_sort(list(DISTINCT label)) AS labels
  FROM spots JOIN phrases ON w[i] = words[1] AND list_slice(w, i, i + len(words) - 1) = words GROUP BY doc_id),
places AS (
  SELECT template, place - 1 AS place, tokens[place] AS word FROM (SELECT template, tokens, unnest(range(1, len(tokens) + 1)) AS place FROM templates)
  WHERE tokens[place] NOT IN ({", ".join(f"'{s}'" for s in sorted(STOP))})),
hits AS (SELECT doc_id, n, i - 1 AS i, w[i] AS word FROM spots WHERE w[i] IN (SELECT word FROM places)),
files AS (SELECT word, count(DISTINCT doc_id) AS files FROM hits GROUP BY word),
postings AS (
  SELECT template, place, word FROM places LEFT JOIN files USING (word)
  QUALIFY row_number() OVER (PARTITION BY template ORDER BY coalesce(files, 0), place) <= {ANCHORS}),
anchors AS (SELECT template, count(*) AS anchors FROM postings GROUP BY template),
enough AS (SELECT doc_id FROM hits GROUP BY doc_id HAVING count(DISTINCT word) >= {FEWEST}),
shifts AS (
  SELECT doc_id, template, i - place AS shift, count(*) AS agree FROM hits JOIN postings USING (word) JOIN enough USING (doc_id) GROUP BY ALL),
best AS (
  SELECT doc_id, template, label, keys, agree, anchors FROM (SELECT doc_id, template, max(agree) AS agree FROM shifts GROUP BY ALL)
  JOIN anchors USING (template) JOIN templates USING (template) WHERE agree >= anchors * {AGREE}),
proven AS (
  SELECT doc_id, list(DISTINCT label) AS labels, max(agree / anchors) AS share FROM best JOIN docs USING (doc_id)
  WHERE len(list_filter(keys, lambda k: NOT contains(' ' || array_to_string(w, '  ') || ' ', k))) = 0 GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(b.labels, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(p.labels, [])))), ','), '') AS labels,
  greatest(coalesce(share, 0.0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0.0 END)::DOUBLE AS score
FROM docs d LEFT JOIN base b USING (doc_id) LEFT JOIN proven p USING (doc_id)"""
