from inkstone.streaming.incremental import chunk_stream


def test_repeated_documents_are_chunked_once(spark, tmp_path):
    schema, source, out = "doc_id long, text string", str(tmp_path / "in"), str(tmp_path / "out")
    for rows in ([(1, "a\nb"), (2, "c"), (2, "c")], [(2, "c"), (3, "d")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        chunk_stream(spark.readStream.schema(schema).parquet(source), out, str(tmp_path / "state")).awaitTermination(120)
    assert sorted(r["doc_id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]
