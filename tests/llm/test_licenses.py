import random
import re

from packwright.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def places(text):
    words = WORD.findall((text or "").translate(LOWER))
    found = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in found]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def test_base_columns_equal_brute_force(spark):
    r = random.Random(1)
    bits = ["cc", "by", "CC BY", "-", " ", "  ", "general", "PUBLIC", "license", "General-Public License", "all rights reserved", "All", "rights", "reserved", "é", "x\x7fy", "ÇC BY", "\n", ".", "9"]
    texts = [None, "", " .-", "cc by", "cc by cc by", "CC-BY."] + [r.choice(["", " "]).join(r.choice(bits) + " " for _ in range(r.randint(1, 30))) for _ in range(200)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, mark string")
    for row in licenses.scan(df).collect():
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == places(texts[row["doc_id"]]), texts[row["doc_id"]]


def test_notices_need_positions_and_key_phrases(spark):
    texts = [
        "Intro text. Licensed under the Apache License, Version 2.0.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Version of a license that Apache once licensed",
        "Licensed under CC BY-NC 4.0.",
        "the mit released a license under review",
        "nothing",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (0, texts[0])]
    found = [(r["doc_id"], r["labels"], r["score"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()]
    labels = {i: x for i, x, _ in found}
    assert labels == {0: "apache-2.0", 1: "gpl,gpl-3.0", 2: "", 3: "cc-by,cc-by-nc-4.0", 4: "", 5: "", None: "apache-2.0"}
    assert len(found) == 8 and all(0 <= s <= 1 for _, _, s in found) and sum(s == 0 for _, _, s in found) == 3


def test_empty_table_and_no_python_in_the_plan(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    found = licenses.scan(df)
    assert found.count() == 0
    assert "Python" not in found._jdf.queryExecution().toString() and "Arrow" not in found._jdf.queryExecution().toString()
