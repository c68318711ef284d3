"""Exact dedup: a stream over arrivals whose keyed state remembers every text ever seen.

The state is a RocksDB store below the checkpoint folder, without watermark or
expiry: per digest the largest identifier, the locator of that row's content
(file and row number) and the number of rows. Partial aggregation runs before
the shuffle, so a text that a third of all rows share costs one entry a task.
A digest only nominates: every hit is compared with the full bytes behind the
state's locator, and rows that merely share a digest are grouped by their text.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.common import fresh_name, session_conf, text_or_empty
from kerbside.session import Workspace

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Hits compared with one copy of the kept text in one join key.
HITS_PER_KEY = 512


def sha256_digest(text: Column) -> Column:
    return F.sha2(text, 256)


def with_locator(docs: DataFrame, work: Workspace) -> tuple[DataFrame, str]:
    """The rows with a struct (file, row) that finds their content again, and its column name.

    Rows read from files keep their place there; a frame that does not come from
    files is written first.
    """
    name = fresh_name(docs, "locator")
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    if "_metadata" not in {c.lower() for c in docs.columns}:
        try:
            return docs.select("*", place.alias(name)), name
        except AnalysisException:
            pass
    renamed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    stored = work.store(renamed, "contents").select("*", place.alias("locator"))
    return stored.toDF(*docs.columns, name), name


class SeenTexts:
    """The stream's log of arrivals and its state, in one folder.

    ``ingest`` may be called again as documents arrive, also by a later session
    given the same folder: the state goes on from where it stood.
    """

    def __init__(self, spark: SparkSession, folder: str, batch_bytes: int = 64 << 30) -> None:
        self.spark = spark
        self.arrivals = f"{folder}/arrivals"
        self.checkpoint = f"{folder}/state"
        self.batch_bytes = batch_bytes

    def ingest(self, arrivals: DataFrame) -> None:
        """Log rows of (digest, id, locator) and run the stream until the log is drained."""
        arrivals.write.mode("append").parquet(self.arrivals)
        with session_conf(
            self.spark,
            spark__sql__streaming__stateStore__providerClass=STATE_STORE,
            spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled="true",
            # A partition's log would take megabytes ahead of use, many times what a small state holds.
            spark__sql__streaming__stateStore__rocksdb__allowFAllocate="false",
        ):
            log = self.spark.readStream.schema(arrivals.schema).option("maxBytesPerTrigger", str(self.batch_bytes))
            latest = (
                log.parquet(self.arrivals)
                .groupBy("digest")
                .agg(F.max(F.struct("id", "locator")).alias("latest"), F.count("*").alias("n"))
            )
            sink = latest.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
            query = sink.option("checkpointLocation", self.checkpoint).start()
            query.awaitTermination()

    def state(self) -> DataFrame:
        """digest, keep_id, keep_locator, group_size: the state as it stands."""
        stored = self.spark.read.format("statestore").load(self.checkpoint)
        return stored.select(
            F.col("key.digest").alias("digest"),
            F.col("value.max.id").alias("keep_id"),
            F.col("value.max.locator").alias("keep_locator"),
            F.col("value.count").alias("group_size"),
        )


def exact_groups(
    docs: DataFrame,
    work: Workspace,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest=sha256_digest,
) -> tuple[DataFrame, DataFrame, str]:
    """(verdicts, located documents, locator column).

    Verdicts hold one row per input row: id, digest, keep_id, group_size, kept,
    and the locator. A null text is an empty text. Of equal texts the row with
    the largest id stays; null ids come last, and among equal ids the one with
    the largest locator. Repeated rows are members like any other. An empty
    table gives no rows. Other columns, whatever their names, only travel along
    in the located documents.
    """
    spark = docs.sparkSession
    located, locator = with_locator(docs, work)
    text = text_or_empty(text_col)
    rows = located.select(
        F.col(f"`{id_col}`").alias("id"), F.col(locator).alias("locator"), digest(text).alias("digest")
    )
    seen = SeenTexts(spark, work.path("seen"))
    seen.ingest(rows)
    marked = work.store(
        rows.join(seen.state(), "digest").withColumn("kept", F.col("locator") == F.col("keep_locator")), "marked"
    )
    collisions = work.store(_failed_checks(marked, located.select(locator, text.alias("text")), locator), "unequal")
    verdicts = marked if collisions.isEmpty() else _regrouped(marked, collisions)
    return verdicts.select("id", "digest", "keep_id", "group_size", "kept", "locator"), located, locator


def _failed_checks(marked: DataFrame, texts: DataFrame, locator: str) -> DataFrame:
    """Hits whose bytes differ from the bytes at the kept locator.

    Contents are fetched by locator, which is unique; the comparison is keyed by
    digest and a salt that grows with the group, so no task holds a large group.
    """
    several = marked.filter("group_size > 1")
    contents = several.join(texts, several["locator"] == texts[locator]).drop(texts[locator])
    keys = F.ceil(F.col("group_size") / HITS_PER_KEY).cast("int")
    kept = contents.filter("kept").select(
        "digest", F.explode(F.sequence(F.lit(0), keys - 1)).alias("salt"), F.col("text").alias("kept_text")
    )
    hits = contents.filter("NOT kept").withColumn("salt", F.pmod(F.xxhash64("locator"), keys).cast("int"))
    return (
        hits.join(kept, ["digest", "salt"])
        .filter(F.col("text") != F.col("kept_text"))
        .select("locator", "digest", "id", "text")
    )


def _regrouped(marked: DataFrame, collisions: DataFrame) -> DataFrame:
    """Rows that share a digest but not the text form groups of their own."""
    own = collisions.groupBy("digest", "text").agg(
        F.max(F.struct("id", "locator")).alias("latest"), F.count("*").alias("own_size")
    )
    moved = collisions.join(own, ["digest", "text"]).select(
        "locator", F.col("latest.id").alias("own_id"), F.col("latest.locator").alias("own_locator"), "own_size"
    )
    fewer = collisions.groupBy("digest").agg(F.count("*").alias("left_out"))
    is_moved = F.col("own_size").isNotNull()
    return (
        marked.join(moved, "locator", "left")
        .join(fewer, "digest", "left")
        .withColumns(
            {
                "keep_id": F.when(is_moved, F.col("own_id")).otherwise(F.col("keep_id")),
                "kept": F.when(is_moved, F.col("locator") == F.col("own_locator")).otherwise(F.col("kept")),
                "group_size": F.coalesce(
                    F.col("own_size"), F.col("group_size") - F.coalesce(F.col("left_out"), F.lit(0))
                ),
            }
        )
    )


def drop_copies(docs: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without their exact copies, all columns as they were."""
    verdicts, located, locator = exact_groups(docs, work, id_col, text_col)
    dropped = verdicts.filter("NOT kept").select(F.col("locator").alias(locator))
    return located.join(dropped, locator, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
