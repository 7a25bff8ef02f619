"""JSON datasets in, answer reports out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.sources.json_records import json_objects

BAD_RECORD = "_corrupt"
PREFERENCES = T.StructType(
    [
        T.StructField("pair_id", T.StringType()),
        T.StructField("prompt", T.StringType()),
        T.StructField("chosen", T.StringType()),
        T.StructField("rejected", T.StringType()),
    ]
)


def read_json_dataset(
    spark: SparkSession,
    path: str,
    schema: T.StructType = PREFERENCES,
    multi_line: bool = False,
) -> DataFrame:
    """A JSON dataset with a declared schema; bad records are kept in ``_corrupt``.

    The default is one record per line, which Spark splits at any size.
    ``multi_line`` reads files in any layout, such as one JSON array: many tasks
    share a file (see ``json_records``). Array elements that are no objects are
    bad records.
    """
    schema = T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}
    if multi_line:
        record = F.from_json("value", schema, options).alias("record")
        return json_objects(spark, path).select(record).select("record.*")
    return spark.read.schema(schema).options(**options).json(path)


def write_report(answered: DataFrame, path: str) -> DataFrame:
    """Write answers and timings once, and read them back: generation is not run again."""
    answered.write.parquet(path)
    return answered.sparkSession.read.schema(answered.schema).parquet(path)
