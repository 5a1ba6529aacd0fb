"""The same frontends over a stream of rows.

Parsing is stateless, so it runs on the stream itself; passes need windows over an episode
and run inside each micro-batch, where every record is whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftline.functions import text as X
from weftline.model import Trajectories
from weftline.operators import passes
from weftline.sources import files, frontends


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    """JSON lines as they arrive; micro-batches number them (see ``run``)."""
    return spark.readStream.text(folder).select(X.strip(F.col("value")).alias("raw")).where("raw <> ''")


def run(
    stream: DataFrame, frontend: str, sink: Callable[[Trajectories, DataFrame, int], None],
    pass_names: str | list[str] = "minimal", checkpoint: str | None = None
) -> StreamingQuery:
    """Parse and pass each micro-batch and hand it, with its quarantine, to ``sink``; ends when the source is drained.

    rid is the number of the micro-batch, times 2 ** 40, plus the index of the line in it, so
    equal lines are records of their own and a batch that runs again gets the same numbers.
    """
    passes.validated(pass_names)

    def batch(df: DataFrame, n: int) -> None:
        rows = files.numbered(df.select("raw")).withColumn("rid", F.lit(n).cast("bigint") * (1 << 40) + F.col("rid"))
        t, bad = frontends.convert(rows, frontend, stage="stream")
        sink(passes.run_passes(t, pass_names), bad, n)

    writer = stream.writeStream.foreachBatch(batch).trigger(availableNow=True)
    return (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()
