"""Sharding by a two-pass external shuffle. DataFrame functions only.

Pass 1 scatters records by seeded hashes into buckets that fit in memory: the shard comes from the record's
id and the number of shards alone (``key`` law: the shard whose seeded hash with the id is highest, so that one more
shard only takes records into itself), the bucket inside the shard from a seeded hash of the record. The number of
buckets follows from the counted records and bytes. Pass 2 shuffles each bucket by Fisher-Yates (Spark's
``shuffle`` of an array, seeded) and deals slots: a bucket begins where the ones before it in its shard end.
``write`` stores the result, a folder for each shard, each in slot order.

Buckets are gathered in memory, so their size is bounded: ``rows_each`` records and ``bytes_each`` bytes on
average; hashes spread copies of one text (other ids), and records of one id (other texts), over the buckets of a
shard. Only records equal in both share a bucket. A single record is never split. With one hot id, its shard is as large as the id asks for, but still made of bounded buckets.

Defined cases: a null text has size 1 and the crc32 of the empty text; null ids count as one id; exact copies of a row
are records of their own; an empty table gives none. All columns are carried in ``rest`` and cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvest.llm._text import rest_of

SEED = 20_25


def shard_of(doc_id: Column, shards: int, seed: int = SEED) -> Column:
    """The shard whose hash with the id is the highest (ties: the lowest shard)."""
    hashes = F.array(*[F.xxhash64(F.lit(seed), doc_id, F.lit(i)) for i in range(shards)])
    return (F.array_position(hashes, F.array_max(hashes)) - 1).cast("int")


def shuffled(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text", seed: int = SEED,
             rows_each: int = 2048, bytes_each: int = 4 << 20) -> DataFrame:
    """rest (all columns), size, shard, grown_shard, bucket and slot: a row for each row of ``docs``."""
    size = F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long") + 1
    total = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    buckets = max(1, -(-total["n"] // (rows_each * shards)), -(-(total["b"] or 0) // (bytes_each * shards)))
    records = docs.select(rest_of(docs), size.alias("size"), shard_of(F.col(doc_id), shards, seed).alias("shard"),
                          shard_of(F.col(doc_id), shards + 1, seed).alias("grown_shard"), F.xxhash64(F.lit(seed + 1), F.col(doc_id), F.col(text)).alias("key"))
    records = records.withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("int"))
    counts = records.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)     # over buckets, not records
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first"))
    # pass 2: Spark draws from the seed and the task, so shards and buckets are the same in each run, but the order
    # inside a bucket only with the same partitions. A bucket is always dealt by one task, also if that is repeated.
    gathered = (records.repartition("shard", "bucket").groupBy("shard", "bucket")
                .agg(F.array_sort(F.collect_list(F.struct("key", "size", "grown_shard", "rest"))).alias("records")))
    dealt = gathered.join(offsets, ["shard", "bucket"]).select("shard", "bucket", "first", F.posexplode(F.expr(f"shuffle(records, {seed})")).alias("at", "r"))
    return dealt.select("r.rest", "r.size", "shard", "r.grown_shard", "bucket", (F.col("first") + F.col("at")).alias("slot"))


def write(docs: DataFrame, path: str, shards: int = 8, **options) -> None:
    """Write the shuffled shards under ``path``, a folder ``shard=N`` each; files of a shard are in slot order."""
    out = shuffled(docs, shards, **options).select("rest.*", F.col("shard"), F.col("bucket").alias("_bucket"), F.col("slot").alias("_slot"))
    out.repartition("shard", "_bucket").sortWithinPartitions("shard", "_bucket", "_slot").write.partitionBy("shard").parquet(path)


def digest(found: DataFrame) -> DataFrame:
    return found.select("rest.doc_id", "size", F.crc32(F.coalesce(F.col("rest.text"), F.lit("")).cast("binary")).alias("text_crc32"),
                        F.lit("key").alias("law"), "shard", "slot", "grown_shard")
