"""Session settings the results depend on."""

from pyspark.sql import SparkSession

# Dates and times are compared in UTC; casts must fail, not turn bad values into NULL;
# decimal division must round to six places where the exact result needs more digits.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.decimalOperations.allowPrecisionLoss": "true",
    "spark.sql.adaptive.enabled": "true",
}


def local_session(cores: int | str = 8, memory: str = "12g", **more: str) -> SparkSession:
    """Session on this machine, for tests and measurements.  On a cluster, submit with
    SETTINGS and a partition count of two to three per core."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("ebbtide")
    local = {
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": str(cores),
        # the tables of one run need more generated classes than the default cache holds
        "spark.sql.codegen.cache.maxEntries": "1000",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**SETTINGS, **local, **more}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
