"""The engine's tables as seen through the driver's: frames, speakers, shots and vectors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Frames in DuckDB: users are videos, their events frames.
FRAMES_SQL = """fr AS (SELECT user_id AS video, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INTEGER) AS frame,
  event_id, value, event_type AS kind, epoch_us(ts) // 1000 AS ms, CAST(count(*) OVER (PARTITION BY user_id) AS INTEGER) AS total FROM events)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """video, frame, event_id, value, kind, ms, total."""
    ms = F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    w = Window.partitionBy("video")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("video"), "event_id", "value", F.col("event_type").alias("kind"), ms.alias("ms"))
    return rows.withColumns({"frame": (F.row_number().over(w.orderBy("event_id")) - 1).cast("int"), "total": F.count(F.lit(1)).over(w).cast("int")})


def query(name: str, sql: str | None = None):
    """Registers a query and, if there is one, its SQL. `{fr}` stands for the frames' common table expression."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql.replace("{fr}", FRAMES_SQL)
        return f

    return add
