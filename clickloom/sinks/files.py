"""The few file-system calls Spark's writers do not cover."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _resolve(spark, path)
    return file_system.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    file_system, hadoop_path = _resolve(spark, path)
    file_system.delete(hadoop_path, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder, in order."""
    file_system, hadoop_path = _resolve(spark, path)
    return sorted(status.getPath().getName() for status in file_system.listStatus(hadoop_path))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file written from the driver; an existing one is replaced."""
    file_system, hadoop_path = _resolve(spark, path)
    out = file_system.create(hadoop_path, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def write_csv(df: DataFrame, path: str, columns, mode: str = "errorifexists") -> None:
    """Headered CSV in the given column order; NULL and "" both come out blank.

    Quotes in a field are doubled, as standard readers expect.
    """
    (
        df.select(*columns)
        .write.mode(mode)
        .option("header", True)
        .option("emptyValue", "")
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
