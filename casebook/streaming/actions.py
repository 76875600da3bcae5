"""Applying a stream of operator actions to the stored state, one micro-batch at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from casebook import schema
from casebook.plans.updates import submit_actions
from casebook.sources.state import StateStore


def read_action_files(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Actions dropped as JSON files, one object per line, each with its line: ``unread`` holds the text of a line that is no
    object or has a value of the wrong kind."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    fields = T.StructType([*schema.ACTIONS.fields, T.StructField("unread", T.StringType())])
    parsed = F.from_json("value", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "unread"})
    no_object = ~F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False))
    read = lines.filter(F.trim("value") != "").select("value", no_object.alias("_no_object"), parsed.alias("a")).select("value", "_no_object", "a.*")
    unread = F.when(F.col("_no_object") | F.col("unread").isNotNull(), F.col("value"))
    return read.withColumn("unread", unread).drop("value", "_no_object")


def start(store: StateStore, stream: DataFrame, checkpoint: str, name: str = "actions", rejects: str | None = None) -> StreamingQuery:
    """Start applying ``stream``.

    Rejected actions are kept in ``rejects`` (by default the folder ``<checkpoint>-rejected``), one folder ``batch=<id>`` for each
    batch; lines that are no actions are kept as they are, in the folder of the same name with ``-unread``.

    The published version records the last batch of ``name`` it contains, so a batch that is
    delivered again after a failure is skipped.
    """

    kept = (rejects or f"{checkpoint.rstrip('/')}-rejected").rstrip("/")

    def apply(batch: DataFrame, batch_id: int) -> None:
        if store.content().get("batches", {}).get(name, -1) >= batch_id:
            return
        if "unread" in batch.columns:
            batch.filter("unread is not null").select("unread").write.mode("overwrite").parquet(f"{kept}-unread/batch={batch_id}")
            batch = batch.filter("unread is null").drop("unread")
        submit_actions(store, batch, batch_id=(name, batch_id), rejects=f"{kept}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .trigger(availableNow=True)
        .start()
    )
