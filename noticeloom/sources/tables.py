"""Reading the tables of a data folder."""

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table `name` of `folder`; columns and filters are pruned by the scan."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def create(spark: SparkSession, folder: str, schemas: dict[str, str]) -> None:
    """Empty tables with their schemas in `folder`, where none is yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for name, schema in schemas.items():
        place = hadoop.Path(f"{folder.rstrip('/')}/{name}.parquet")
        if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            spark.createDataFrame([], schema).write.parquet(place.toString())
