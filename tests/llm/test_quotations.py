import duckdb

from packwright.llm import quotations

TALK = [
    (1, 0, "user", "Hello there, how are\nyou today?\n\nSecond paragraph, about a river."),
    (1, 1, "assistant", "I am fine.\n\nThank you."),
    (1, 2, "user", "On Monday A wrote:\n> hello THERE how are\n> you today?\nWell then."),
    (1, 3, "assistant", "> > Second paragraph, about a river.\n> I am fine.\n\nGood to hear."),
    (1, 4, "user", "> words nobody said\nSo it goes."),
    (1, 5, "user", "no quotes > here"),
    (2, 0, None, None),
    (2, 1, "user", "> \n>\n"),
    (2, 7, "user", "after a gap"),
    (None, 3, "user", "lost"),
    (3, None, "user", "lost too"),
]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def as_set(rows):
    return {(r["conv_id"], r["turn"]): (r["reply_to"], r["thread"], r["position"], r["n_quotes"], r["text"]) for r in rows}


def test_links_threads_and_text(spark):
    found = as_set(quotations.conversations(spark.createDataFrame(TALK, SCHEMA)).collect())
    assert found[1, 0] == (None, 0, 0, 0, TALK[0][3])
    assert found[1, 1] == (0, 0, 1, 0, "I am fine.\n\nThank you.")
    assert found[1, 2] == (0, 2, 0, 1, "Well then.")
    assert found[1, 3] == (1, 0, 2, 2, "Good to hear.")
    assert found[1, 4] == (3, 0, 3, 0, "So it goes.")
    assert found[1, 5] == (4, 0, 4, 0, "no quotes > here")
    assert found[2, 1] == (0, 0, 1, 0, "") and found[2, 7] == (None, 7, 0, 0, "after a gap")
    assert found[None, 3] == (None, 3, 0, 0, "lost") and found[3, None] == (None, None, 0, 0, "lost too")


def test_equals_its_sql(spark):
    talk = [r for r in TALK if r[0] is not None and r[1] is not None]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", talk)
    result = con.execute(quotations.SQL)
    names = [d[0] for d in result.description]
    df = quotations.conversations(spark.createDataFrame(talk, SCHEMA)).select(*names)
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, result.fetchall()))


def test_long_chain_repeated_rows_and_empty_table(spark):
    talk = [(1, i, "user", f"message {i}") for i in range(70)] + [(1, 5, "user", "message 5")]
    rows = quotations.conversations(spark.createDataFrame(talk, SCHEMA)).collect()
    assert len(rows) == 71 and all(r["thread"] == 0 and r["position"] == r["turn"] for r in rows)
    assert quotations.conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_passage_quoted_by_many_links_once_each(spark):
    talk = [(1, 0, "user", "the common passage")] + [(1, i, "user", "> the common passage\nreply") for i in range(1, 60)]
    rows = quotations.conversations(spark.createDataFrame(talk, SCHEMA)).collect()
    assert all(r["reply_to"] == 0 and r["n_quotes"] == 1 for r in rows if r["turn"])
    assert "Python" not in quotations.conversations(spark.createDataFrame(talk, SCHEMA))._jdf.queryExecution().toString()


def test_repeated_rows_keep_their_quotations(spark):
    talk = [(1, 0, "user", "hello there"), (1, 1, "assistant", "other words"), (1, 2, "user", "> hello there\nyes")]
    once = as_set(quotations.conversations(spark.createDataFrame(talk, SCHEMA)).collect())
    assert once[1, 2][0] == 0 and once[1, 2][3] == 1
    for again in ([talk[0]], [talk[2]], talk):
        rows = quotations.conversations(spark.createDataFrame(talk + again, SCHEMA)).collect()
        assert len(rows) == len(talk + again) and as_set(rows) == once
