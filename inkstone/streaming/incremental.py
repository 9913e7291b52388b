"""Incremental ingestion: new documents become chunks once, however often a batch is repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from inkstone.operators.corpus import chunks, insert_absent
from inkstone.operators.rows import first_rows


def chunk_stream(docs: DataFrame, folder: str, checkpoint: str, target: int = 1800, overlap: int = 200, available_now: bool = True) -> StreamingQuery:
    """Chunks of a stream of (doc_id, text) documents, appended to a Parquet table by batch. A batch writes its own
    partition and overwrites it when it is repeated; documents that earlier batches have are left out."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = _done(spark, folder, batch_id)
        fresh = insert_absent(done, batch.select("doc_id", "text"), ["doc_id"]) if done is not None else first_rows(batch, ["doc_id"])
        chunks(fresh, target, overlap).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    writer = docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _done(spark: SparkSession, folder: str, batch_id: int) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path) or not any(s.getPath().getName().startswith("batch=") for s in files.listStatus(path)):
        return None
    return spark.read.schema("doc_id long, batch int").option("basePath", folder).parquet(folder).filter(f"batch < {batch_id}").select("doc_id").distinct()
