"""Following a stream of manifests: a client's copy of a catalog kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

CHANGE = "sequence long, op string, id string, digest string"


def read_changes(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of change rows (CHANGE) from Parquet files as they appear."""
    return spark.readStream.schema(CHANGE).option("maxFilesPerTrigger", 16).parquet(folder)


def apply_changes(state: DataFrame, changes: DataFrame) -> DataFrame:
    """The state (id, sequence, digest, gone) after changes; of each id the change of the highest sequence holds.

    Changes may come late, repeated or out of order: what was removed stays as a mark, so an
    older upsert that comes after it does not bring it back.
    """
    new = changes.select("id", "sequence", F.when(F.col("op") != "remove", F.col("digest")).alias("digest"), (F.col("op") == "remove").alias("gone"))
    return state.unionByName(new).groupBy("id").agg(F.max_by(F.struct("sequence", "digest", "gone"), F.struct("sequence", "gone", "digest")).alias("_s")).select("id", "_s.*")


#: Parts of the state, by a hash of the id.
PARTS = 64


def read_state(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The state as its parts stand: of each part the newest version, or the newest up to one."""
    parts = spark.read.option("recursiveFileLookup", False).schema(STATE).parquet(folder)
    if version is not None:
        parts = parts.where(F.col("version") <= version)
    last = parts.select("part", "version").distinct().groupBy("part").agg(F.max("version").alias("version"))
    return parts.join(F.broadcast(last), ["part", "version"]).select("id", "sequence", "digest", "gone", "part")


STATE = "id string, sequence long, digest string, gone boolean, part int, version long"


def follow(changes: DataFrame, state_folder: str, checkpoint: str, parts: int = PARTS) -> StreamingQuery:
    """Applies each batch of changes to the state table, which is parted by a hash of the id.

    A batch writes new versions of the parts that its changes touch, and no other. A batch that
    runs again after a failure starts from the versions before it and writes its own over, so
    every change counts once. Older versions may be removed when no reader needs them.
    """
    spark = changes.sparkSession

    def batch(rows: DataFrame, number: int) -> None:
        rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
        touched = sorted(r.part for r in rows.select("part").distinct().collect())
        if not touched:
            return
        empty = spark.createDataFrame([], "id string, sequence long, digest string, gone boolean")
        before = read_state(spark, state_folder, number - 1).where(F.col("part").isin(touched)).drop("part") if number and _exists(spark, state_folder) else empty
        after = apply_changes(before, rows).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).withColumn("version", F.lit(number).cast("long"))
        writer = after.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("part", "version").parquet(state_folder)

    return changes.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _exists(spark: SparkSession, folder: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
