"""Scoring of feature rows as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ebbtide.operators.scoring import DecisionParameters, score_customers


def read_feature_stream(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None
) -> DataFrame:
    """Feature rows from Parquet files dropped into a folder; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def start_scoring(
    model: PipelineModel,
    stream: DataFrame,
    sink_path: str,
    checkpoint_path: str,
    parameters: DecisionParameters = DecisionParameters(),
    available_now: bool = False,
    id_col: str = "customer_id",
) -> StreamingQuery:
    """Append scored rows to Parquet; the scoring has no state, so a restart resumes from the checkpoint.

    ``available_now`` works through the present backlog and stops.
    """
    writer = (
        score_customers(model, stream, parameters, id_col)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint_path)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(sink_path)


def write_scored_batch(
    model: PipelineModel,
    rows: DataFrame,
    batch: int,
    sink_path: str,
    parameters: DecisionParameters,
    id_col: str = "customer_id",
) -> None:
    """Scored rows of one micro-batch as the folder ``batch=<number>`` of the sink, with the parameters that decided.

    A batch that is repeated after a failure replaces its folder, so the sink holds every row once.
    """
    decided = score_customers(model, rows, parameters, id_col).select(
        "*",
        *[F.lit(float(v)).alias(k) for k, v in (
            ("threshold", parameters.threshold),
            ("retention_cost", parameters.retention_cost),
            ("churn_loss", parameters.churn_loss),
        )],
    )
    decided.write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/batch={batch}")


def start_reloading(
    model: PipelineModel,
    stream: DataFrame,
    sink_path: str,
    checkpoint_path: str,
    load_parameters: Callable[[], DecisionParameters],
    available_now: bool = False,
    id_col: str = "customer_id",
) -> StreamingQuery:
    """As ``start_scoring`` with parameters that are read again for every micro-batch.

    ``load_parameters`` is called by the driver, once a batch; with ``load_decision_parameters`` over the folders of the
    reports a running stream follows a report that is written anew.
    """

    def score(rows: DataFrame, batch: int) -> None:
        write_scored_batch(model, rows, batch, sink_path, load_parameters(), id_col)

    writer = stream.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint_path)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
