"""Session settings the jobs expect.

The jobs themselves never create or look up a session; these helpers are for
callers that start one, and for queries that run in a session made elsewhere.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings: safe to apply to a session that already exists.
RUNTIME_CONF = {
    # Re-plan from measured sizes: coalesce small partitions, split skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A response may name a key twice; the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # The JVM compiles no method beyond 8,000 bytes of bytecode. The columns of an answer make
    # longer ones, which would be interpreted row by row; such steps run operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cpus: int = 8,
    shuffle_partitions: int | None = None,
    memory: str = "8g",
    name: str = "attestry",
) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.session.timeZone", "UTC")
    )
    return configure(builder.getOrCreate())
