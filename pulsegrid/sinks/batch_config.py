"""Write batch definitions back, one JSON file each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.schemas import BATCH_DEFINITION_KEYS
from pulsegrid.sources.batch_config import definition_text


def write_definitions(definitions: DataFrame, path: str) -> None:
    """One folder per batch with its definition as pretty-printed JSON.

    Do not write over the folder the definitions are being read from.
    """
    texts = definitions.select(
        F.col("batchName").alias("batch"),
        definition_text({k: F.col(k) for k in BATCH_DEFINITION_KEYS}).alias("value"),
    )
    texts.repartition("batch").write.mode("overwrite").partitionBy("batch").text(path)
