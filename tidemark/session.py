"""The session that tests and the bench use; on a cluster, the caller brings its own."""

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "tidemark") -> SparkSession:
    """A local session: UTC, AQE on, as many shuffle partitions as cores."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
