"""The same pull and merge as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.types import quote
from ..operators.cdc import BEFORE_UPDATE, DELETE, IS_DELETED, ChangeLog
from ..operators import merge
from ..operators.incremental import newest_per_key
from ..sinks.buckets import BucketedTable
from ..sinks.columnar import remove


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet", files_per_batch: int | None = None):
    """New parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def table_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """The parquet files of a table as a stream, whether the table is a folder or a single file."""
    store_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if store_path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(store_path).isDirectory():
        return file_stream(spark, path, schema, files_per_batch=files_per_batch)
    folder, name = path.rstrip("/").rsplit("/", 1)
    return file_stream(spark, folder, schema, name, files_per_batch)


def pull_new(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Everything that has arrived since the checkpoint, once each, then the query ends."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def apply_changes(stream: DataFrame, log: ChangeLog, path: str, checkpoint: str) -> StreamingQuery:
    """Nets each micro-batch and keeps the result under the batch's number.

    A batch that is replayed overwrites its own folder, so it counts once. Deletes are kept as rows, as
    an older update may still arrive in a later batch; ``current_rows`` hides them.
    """

    def keep_net(batch: DataFrame, batch_id: int) -> None:
        netted = net_of_batch(ChangeLog(batch, log.keys, log.lsn, log.op, log.time, log.sequence))
        netted.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(keep_net)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
#: Keeps state on disk and in the checkpoint, so that it may be larger than memory.
ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def newest_images(stream: DataFrame, log: ChangeLog) -> DataFrame:
    """The newest image of every key over all that has arrived, deleted keys included, as a stream of its updates.

    The state holds an image a key. A change that comes late does not replace a newer one, and a delete is kept, so that an
    older row that comes after it does not bring the key back.
    """
    op = F.col(quote(log.op))
    images = stream.where(op != BEFORE_UPDATE).withColumn(IS_DELETED, F.when(op == DELETE, 1).otherwise(0))
    return newest_per_key(images.select(*(F.col(quote(c)) for c in kept_columns(log))), log.keys, [log.lsn, *log.sequence])


def keep_current(stream: DataFrame, log: ChangeLog, target: BucketedTable, checkpoint: str) -> StreamingQuery:
    """Keeps a bucketed table at the state of a change stream.

    Each micro-batch emits the keys it has changed, which are stored once beside the table and merged into the buckets they
    fall into, so readers of the table net nothing. A batch that is replayed finds its number in the table's index and is not
    merged again.
    """
    spark = target.spark
    shown = [F.col(quote(c)) for c in [*log.payload, IS_DELETED]]

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        changed = f"{target.path}/changed/batch={batch_id}"
        batch.select(*shown).write.mode("overwrite").parquet(changed)
        target.merge(spark.read.schema(batch.select(*shown).schema).parquet(changed), run=batch_id + 1)
        remove(spark, changed)

    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ON_DISK)
    try:
        return (
            newest_images(stream, log)
            .writeStream.outputMode("update")
            .foreachBatch(merge_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(STATE_STORE, before) if before is not None else spark.conf.unset(STATE_STORE)


def net_of_batch(log: ChangeLog) -> DataFrame:
    """Last image per key with its position and delete flag. Unlike in a closed range, a key that was
    inserted and deleted stays as a deleted one: another batch may hold older changes of it."""
    op = F.col(quote(log.op))
    flagged = log.df.where(op != BEFORE_UPDATE).withColumn(IS_DELETED, F.when(op == DELETE, 1).otherwise(0))
    return latest_images(flagged, log)


def latest_images(kept: DataFrame, log: ChangeLog) -> DataFrame:
    """Newest image per key, deleted keys included."""
    images = kept.select(*(F.col(quote(c)) for c in kept_columns(log)))
    return newest_per_key(images, log.keys, [log.lsn, *log.sequence])


def current_rows(kept: DataFrame, log: ChangeLog, base: DataFrame | None = None) -> DataFrame:
    """A target's present rows: the newest image of every key that is not deleted, and the rows of
    ``base`` no change has touched."""
    newest = latest_images(kept, log)
    if base is None:
        return newest.where(F.col(IS_DELETED) == 0).select(*(F.col(quote(c)) for c in log.payload))
    net = newest.select(*(F.col(quote(c)) for c in [*log.payload, IS_DELETED]))
    return merge.apply_changes(base, net, log.keys)


def compact(kept: DataFrame, log: ChangeLog, path: str) -> None:
    """The kept images of many batches as one per key, in a new folder. Deleted keys stay."""
    latest_images(kept, log).write.mode("overwrite").parquet(path)



def kept_columns(log: ChangeLog) -> list[str]:
    """Columns of the kept images."""
    return [*log.payload, log.lsn, *log.sequence, IS_DELETED]
