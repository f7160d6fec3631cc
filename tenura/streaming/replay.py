"""Replays a table as deliveries, in any order of event times, through a stream with one checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.session import fresh_path, materialise

Transform = Callable[[DataFrame], DataFrame]


def replay(rows: DataFrame, delivery: Column, transform: Transform, label: str = "replay") -> DataFrame:
    """Rows that ``transform`` of the stream has given after the last delivery.

    ``delivery`` numbers the rows; equal numbers arrive together, smaller ones earlier, rows without a number never.
    A delivery is any number of files. The stream reads it to its end, stops, and the next run goes on from the
    checkpoint with the state and the watermark it left, so that what is late does not depend on the timing of runs
    or on how files are cut. The output is appended, as parquet.
    """
    spark = rows.sparkSession
    numbered = materialise(rows.withColumn("_delivery", delivery), f"{label}-numbered")
    numbers = [r[0] for r in numbered.select("_delivery").dropna().distinct().orderBy("_delivery").collect()]
    place = fresh_path(spark, label)
    source, data = f"{place}/source", f"{place}/data"
    numbered.where(F.lit(False)).drop("_delivery").write.parquet(source)
    stream = transform(spark.readStream.schema(rows.schema).parquet(source))
    for number in numbers:
        numbered.where(F.col("_delivery") == number).drop("_delivery").write.mode("append").parquet(source)
        run = (
            stream.writeStream.format("parquet").outputMode("append").option("path", data)
            .option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).start()
        )
        run.awaitTermination()
    if not numbers:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(data)
