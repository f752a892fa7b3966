import json

from pyspark.sql import functions as F

from packwright.functions import jsontext as J


def python_valid(text):
    def unique(pairs):
        keys = [k for k, _ in pairs]
        if len(set(keys)) != len(keys):
            raise ValueError("repeated key")
        return dict(pairs)

    def no_constant(name):
        raise ValueError(name)

    try:
        json.loads(text, object_pairs_hook=unique, parse_constant=no_constant)
        return True
    except ValueError:
        return False


def test_strict_validity_matches_python(many):
    texts = [
        '{"a": 1}',
        "{'a': 1}",
        '{"a": 1}, {"a": 2}',
        '{"a": 1} x',
        '{"a": 1',
        '[1, 2]',
        '[1, 2',
        "",
        " ",
        "3",
        '"s"',
        "null",
        '{"a": 1}] [{"a": 2}',
        '{"a": 1}} {"v": {"a": 2}',
        '{"a": NaN}',
        '{"a": 1, "a": 2}',
        '{"a": 1,}',
        ' {"a": [{"b": null}]} ',
        '1, 2',
        '{"a": "\\u00e9"}',
    ]
    assert many(J.is_strict_json, texts) == [python_valid(t) for t in texts]


def test_lists_and_quarantine(spark):
    replies = [
        (0, 'x [{"a": 1}, {"a": 2, "b": "y"}] z'),
        (1, "none"),
        (2, '[{"a": 1}] and [1]'),
        (3, "[]"),
        (4, None),
    ]
    df = spark.createDataFrame(replies, "id int, reply string")
    recovered = J.recover_list(df, "reply", "struct<a:int,b:string>")
    items = {(r.id, r.position, r.a, r.b) for r in J.explode_items(recovered, ["id"]).collect()}
    assert items == {(0, 0, 1, None), (0, 1, 2, "y")}
    kept = {r.id: r.reason for r in J.quarantine(recovered).collect()}
    assert kept == {1: "no json found", 2: "invalid json", 4: "no json found"}


def test_fenced_object_first(spark):
    fence = "```"
    replies = [
        (0, f'{{"no": 1}} {fence}json\n{{"a": 5}}\n{fence}'),
        (1, f'{fence}\n{{"a": 6}}{fence}'),
        (2, 'text {"a": 7} text'),
        (3, "7"),
        (4, "[1]"),
    ]
    df = spark.createDataFrame(replies, "id int, reply string")
    rows = J.recover_object(df, "reply", "a int", fenced=True).orderBy("id").collect()
    assert [r.value.a if r.value else None for r in rows] == [5, 6, 7, None, None]
    assert [r.reason for r in rows][3:] == ["not an object", "not an object"]


def test_key_differences(spark):
    rows = [('{"a": null, "x": 1}',), ('{"a": 1, "b": 2}',), ("[1]",)]
    df = spark.createDataFrame(rows, "j string")
    missing, unknown = J.key_differences(F.col("j"), ["a", "b"], ["c"])
    found = [tuple(r) for r in df.select(missing, unknown).collect()]
    assert found == [(["b"], ["x"]), ([], []), (["a", "b"], [])]
