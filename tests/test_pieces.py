"""Delimited files cut into small blocks against a read of the whole file by one task."""

import random

import pytest

from packwright.sources import pieces, readers, writers

SCHEMA = "a int, b string, c string"


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    kept = [spark.conf.get(n) for n in names]
    for name, value in zip(names, ("600", "0"), strict=True):
        spark.conf.set(name, value)
    yield
    for name, value in zip(names, kept, strict=True):
        spark.conf.set(name, value)


def whole(spark, path, sep=",", schema=SCHEMA):
    reader = spark.read.options(header=True, sep=sep, escape='"', multiLine=True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def odd_texts(seed: int, n: int):
    pick = random.Random(seed)
    parts = ["plain", "x,y", "\n", '"', "\n\n", ' "q" ', "é中", "\t", "''", "tail\n", '",\n"', "\r\n"]
    return [(i, "".join(pick.choices(parts, k=pick.randrange(9))) or None, pick.choice(parts)) for i in range(n)]


@pytest.mark.parametrize("sep", [",", "\t"])
def test_equals_the_read_of_whole_files(spark, tmp_path, small_blocks, sep):
    df = spark.createDataFrame(odd_texts(1, 600), SCHEMA)
    writers.write_delimited(df.repartition(3), str(tmp_path / "t"), sep)
    found = readers.read_delimited(spark, str(tmp_path / "t"), sep, SCHEMA)
    assert rows(found) == rows(whole(spark, str(tmp_path / "t"), sep))
    assert found.rdd.getNumPartitions() > 20


def test_inferred_types_and_names(spark, tmp_path, small_blocks):
    text = 'id,,name,"two\nlines",name\n' + "".join(f'{i},1.5,n{i},"a\nb {i}",2020-01-0{i % 9 + 1}\n' for i in range(200))
    (tmp_path / "t.csv").write_text(text)
    found = readers.read_delimited(spark, str(tmp_path))
    expected = whole(spark, str(tmp_path), schema=None)
    assert found.dtypes == expected.dtypes
    assert rows(found) == rows(expected)


def test_record_longer_than_many_blocks(spark, tmp_path, small_blocks):
    long = "line of text\n" * 1000
    (tmp_path / "t.csv").write_text(f'a,b,c\n1,"{long}",x\n2,y,z\n3,"{long}","{long}"\n4,,\n')
    found = readers.read_delimited(spark, str(tmp_path), schema=SCHEMA)
    assert rows(found) == rows(whole(spark, str(tmp_path)))
    assert found.count() == 4


@pytest.mark.parametrize(
    "text",
    [
        "",
        "a,b,c\n",
        "\n\na,b,c\n1,x,y\n",
        "a,b,c\n1,x\n2,x,y,z\n\n3,,\n",
        'a,b,c\n1,it"s,"say ""hi"""\n2,"a"b,c\n3,"","',
        'a,b,c\r\n1,"x\ny",z\r\n2,p,q\r\n',
        'a,b,c\n1,"never closed,x\n2,y,z\n3,y,z',
        '"a","b\nb",c\n1,x,y\n',
    ],
)
def test_odd_files(spark, tmp_path, text):
    (tmp_path / "t.csv").write_bytes(text.encode())
    (tmp_path / "u.csv").write_bytes(b'a,b,c\n9,"n\nn",o')
    assert rows(readers.read_delimited(spark, str(tmp_path), schema=SCHEMA)) == rows(whole(spark, str(tmp_path)))


def test_carriage_returns_inside_quotes_stay(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes(b'a,b,c\r\n1,"x\r\ny",z\r\n')
    assert rows(readers.read_delimited(spark, str(tmp_path), schema=SCHEMA)) == [(1, "x\r\ny", "z")]


def test_blocks_without_the_list_of_beginnings(spark, tmp_path, small_blocks, monkeypatch):
    monkeypatch.setattr(pieces, "SENT_BLOCKS", 0)
    df = spark.createDataFrame(odd_texts(2, 300), SCHEMA)
    writers.write_delimited(df.coalesce(1), str(tmp_path / "t"))
    assert rows(readers.read_delimited(spark, str(tmp_path / "t"), schema=SCHEMA)) == rows(whole(spark, str(tmp_path / "t")))


def test_ends_inside():
    cases = {
        ("", False): False,
        ("", True): True,
        ('a,"b', False): True,
        ('a"b,c', False): False,
        ('x",y', True): False,
        ('x"",y', True): True,
        ('x"y"z,"', True): True,
        ('"a""', False): True,
        ('"a"x"b,c', False): False,
    }
    for (line, inside), expected in cases.items():
        assert pieces.ends_inside(line, inside, ",") is expected, line
