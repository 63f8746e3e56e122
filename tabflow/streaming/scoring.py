"""M21 on arriving files: the saved scoring pipeline applied by Structured
Streaming.

Every stage of a frozen scoring pipeline is row-wise (literal lookups,
stream-static joins for large dictionaries, vector assembly, model
predict), so the same ``PipelineModel`` that scores a batch table scores a
stream of new files.  ``availableNow`` processes everything present and
stops, so a scheduler can run it like a batch job that only touches new
files; progress and exactly-once output live in the checkpoint folder, which
must be shared storage (by default under the session's
``spark.checkpoint.dir``).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabflow.functions.columns import q
from tabflow.session import scratch_path
from tabflow.sources.scan import normalize_missing


def score_stream(spark: SparkSession, model_path: str, source_dir: str, schema: StructType, sink_dir: str,
                 id_col: str, target: str, checkpoint: str | None = None, fmt: str = "parquet",
                 sink_fmt: str = "csv", max_files_per_trigger: int | None = None):
    """Start the scoring stream; returns the ``StreamingQuery``."""
    model = PipelineModel.load(model_path)
    for st in model.stages:
        if hasattr(st, "getOrDefault") and st.hasParam("frozen") and not st.getOrDefault("frozen"):
            raise ValueError("per-batch statistics need a whole batch; stream only frozen pipelines")
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    scored = model.transform(normalize_missing(r.load(source_dir))).select(
        q(id_col), F.col("prediction").alias(target))
    w = (scored.writeStream.format(sink_fmt).outputMode("append")
         .option("path", sink_dir)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "scoring-stream")))
    if sink_fmt == "csv":
        w = w.option("header", True)
    return w.trigger(availableNow=True).start()
