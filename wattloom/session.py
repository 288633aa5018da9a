"""The Spark session this library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that the operators rely on. All else is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def session(master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("wattloom").config(map=SETTINGS | settings)
    return (builder.master(master) if master else builder).getOrCreate()
