"""Session and catalog settings."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get(app: str, conf: dict[str, str] | None = None) -> SparkSession:
    """A session in UTC; everything else comes from the cluster or ``conf``."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Put a session somebody else made into UTC, which every date below assumes."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def catalog_conf(name: str, warehouse: str, mode: str = "local") -> dict[str, str]:
    """Settings for an Iceberg catalog; its jar must be on the cluster's classpath."""
    prefix = f"spark.sql.catalog.{name}"
    conf = {
        # Class names of the public Iceberg runtime.
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.warehouse": warehouse,
    }
    if mode == "local":
        conf[f"{prefix}.type"] = "hadoop"
    elif mode == "glue":
        conf[f"{prefix}.catalog-impl"] = "org.apache.iceberg.aws.glue.GlueCatalog"
        conf[f"{prefix}.io-impl"] = "org.apache.iceberg.aws.s3.S3FileIO"
    else:
        raise ValueError(f"catalog mode must be local or glue, not {mode!r}")
    return conf
