from packwright.plans import file_queries
from packwright.sources import writers


def test_csv_pieces_writes_no_table_in_one_task(spark, tmp_path, monkeypatch):
    docs = spark.sql(
        "select id as doc_id, concat('a,\"b\"\\n', id) as text, 'en' as lang, 's' as source, id as n_chars from range(400)"
    )
    docs.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    tasks = []
    write = writers.write_delimited

    def counted(df, path, *args, **kwargs):
        tasks.append(df.rdd.getNumPartitions())
        write(df, path, *args, **kwargs)

    monkeypatch.setattr(writers, "write_delimited", counted)
    found = file_queries.csv_pieces(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, docs.collect()))
    assert tasks and min(tasks) > 1
