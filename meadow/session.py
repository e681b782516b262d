"""Session helper for local use; on a cluster pass your own session."""

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str = "8", app: str = "meadow", **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    conf.setdefault("spark__checkpoint__dir", tempfile.mkdtemp(prefix="meadow-"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
