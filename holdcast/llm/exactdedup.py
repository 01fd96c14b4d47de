"""Exact dedup by stateful streaming.

Documents enter as a stream of slim rows (digest, stable identifier, content
locator). A streaming aggregation keeps one state row per digest in RocksDB, on
disk and without expiry: how many rows had the digest, and the greatest
(doc_id, locator), which is the row that stays. Partial aggregation runs before
the shuffle, so a text that makes up a third of the corpus costs one row per
task. State, offsets and commits live in the stream's checkpoint folder, so a
lost executor or a restarted driver goes on where the last commit was, and
documents that arrive later only meet the state.

Digest hits are checked on full bytes: the texts of digests that came more than
once are grouped by digest and whole text (each distinct text is shuffled once
per task), and where a digest turns out to stand for several texts, the
byte-level groups replace the state's group. Rows of other digests are left out
by a bitmap of FILTER_BITS bits (8 MB, broadcast), which may let a few of them
through, at no harm. Beyond tens of millions of repeated texts it lets most rows
through, and the check then costs a grouping of all texts.

Defined cases: NULL text counts as empty; texts are equal only if all their
bytes are; of rows with the same text and the same doc_id the one with the
greatest content locator stays, so exactly one row of a group is kept; a NULL
doc_id is less than any other. An empty table gives an empty result. Only
doc_id and text are read.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdcast.llm.common import located, prepare, stash, text_bytes
from holdcast.session import checkpoint_dir

STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Else every state partition reserves 4 MB for a list of files that takes 1 KB.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
FILTER_BITS = 1 << 26
#: What identifies a row and says where its content is.
SLIM = T.StructType([
    T.StructField("digest", T.StringType()),
    T.StructField("row", T.StructType([
        T.StructField("doc_id", T.LongType()),
        T.StructField("file", T.StringType()),
        T.StructField("position", T.LongType()),
    ])),
])


def sha256_of(text: Column) -> Column:
    return F.sha2(text, 256)


class DedupStream:
    """A deduplicating stream whose folder holds what came in and the state.

    ``add`` appends documents, ``advance`` runs all that is new through the
    state, ``groups`` reads the current state of every digest that was seen.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def add(self, slim: DataFrame) -> None:
        slim.select(*SLIM.fieldNames()).write.mode("append").parquet(f"{self.folder}/arrived")

    def advance(self) -> None:
        for key, value in STATE.items():
            self.spark.conf.set(key, value)
        arrived = self.spark.readStream.schema(SLIM).parquet(f"{self.folder}/arrived")
        state = arrived.groupBy("digest").agg(F.count("*").alias("n"), F.max("row").alias("stays"))
        out = f"{self.folder}/changed"

        def write(changed: DataFrame, batch: int) -> None:
            # Named by the batch, so a batch that runs again replaces itself.
            changed.write.mode("overwrite").parquet(f"{out}/batch={batch}")

        (state.writeStream.outputMode("update").option("checkpointLocation", f"{self.folder}/state")
         .trigger(availableNow=True).foreachBatch(write).start().awaitTermination())

    def groups(self) -> DataFrame:
        """(digest, n, stays): both only grow, so the latest state is the maximum."""
        try:
            changed = self.spark.read.parquet(f"{self.folder}/changed")
        except AnalysisException:      # nothing has arrived yet
            return self.spark.createDataFrame([], T.StructType(
                [SLIM["digest"], T.StructField("n", T.LongType()), T.StructField("stays", SLIM["row"].dataType)]))
        return changed.groupBy("digest").agg(F.max("n").alias("n"), F.max("stays").alias("stays"))


def _rows(places: DataFrame, digest) -> DataFrame:
    """digest, row (what SLIM holds), text of located documents."""
    text = text_bytes("row.text")
    return places.select(
        digest(text).alias("digest"),
        F.struct(F.col("row.doc_id").cast("bigint").alias("doc_id"), "file", "position").alias("row"),
        text.alias("text"))


def possible_hits(rows: DataFrame, digests: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` whose digest is one of ``digests``, and the few others that share its bit."""
    place = F.pmod(F.xxhash64("digest"), F.lit(bits))
    set_bits = digests.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("set_bits"))
    # At most ``bits`` / 32,768 rows of 4 KB.
    placed = rows.withColumn("place", place).withColumn("bucket", F.bitmap_bucket_number("place")).withColumn(
        "bit", F.bitmap_bit_position("place"))
    byte = "cast(conv(hex(substring(set_bits, cast(bit div 8 as int) + 1, 1)), 16, 10) as int)"
    return placed.join(F.broadcast(set_bits), "bucket").filter(
        F.expr(f"getbit({byte}, cast(bit % 8 as int)) = 1")).select(*rows.columns)


def exact_duplicates(docs: DataFrame, digest=sha256_of, folder: str | None = None) -> DataFrame:
    """One row per row of ``docs``: row, digest, n (rows of its text), stays (the row that stays).

    ``digest`` maps a text column to its state key; any function gives right
    groups, since equal digests are checked on full bytes.
    """
    prepare(docs.sparkSession)
    return _groups_of(located(docs.select("doc_id", "text")), digest, folder)


def _groups_of(places: DataFrame, digest=sha256_of, folder: str | None = None) -> DataFrame:
    spark = places.sparkSession
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/exactdedup-{uuid.uuid4().hex}"
    rows = _rows(places, digest)
    stream = DedupStream(spark, folder)
    slim = stash(rows.select("digest", "row"), "exactdedup-slim")
    stream.add(slim)
    stream.advance()
    # Written first, so that the join deals both sides and may split a frequent digest.
    groups = stash(stream.groups(), "exactdedup-groups")
    texts = possible_hits(rows, groups.filter("n > 1")).groupBy("digest", "text").count()
    clashes = stash(texts.groupBy("digest").agg(F.count("*").alias("texts")).filter("texts > 1"), "exactdedup-clash")
    found = slim.join(groups, "digest")
    if clashes.isEmpty():
        return found
    apart = rows.join(clashes, "digest", "left_semi")
    exact = apart.groupBy("digest", "text").agg(F.count("*").alias("n"), F.max("row").alias("stays"))
    return (found.join(clashes, "digest", "left_anti")
            .unionByName(apart.join(exact, ["digest", "text"]).drop("text")))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every text, all columns as they were."""
    prepare(docs.sparkSession)
    places = located(docs)
    kept = _groups_of(places).filter(F.col("row") == F.col("stays")).select("row.file", "row.position")
    return places.join(kept, ["file", "position"], "left_semi").select("row.*")


def op6_exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256."""
    return exact_duplicates(docs).select(
        "row.doc_id", F.col("stays.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("stays")).alias("kept"), F.col("digest").alias("text_sha256"))


OP6_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""
