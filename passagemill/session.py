"""Session settings that the engine's results rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Results depend on these: time zone of rendered times, later-wins maps, no blind replays of responders.
PINNED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def pin(spark: SparkSession) -> SparkSession:
    """Set the pinned settings on a session that someone else has made."""
    for key, value in PINNED.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("passagemill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in PINNED.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
