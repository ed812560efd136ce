"""Two-pass external shuffle of records into shards of equal row counts.

Pass one scatters the records uniformly, by a seeded hash of their place in the stored table, into
buckets that fit in a task's memory. Pass two permutes every bucket with Spark's seeded ``shuffle``
function (an inside-out Fisher-Yates) and writes it. The buckets one after another are a
random order of the whole table; shards are equal slices of it, so law ``rows`` holds: row counts
differ by at most one. Everything is DataFrame functions.

Defined results: a null text has size 1 and CRC-32 zero; repeated rows are separate records and spread
over the buckets; an empty table gives no rows; the other columns travel in ``record``, so their names
can't clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from campaignlens.llm.common import Workspace, row_hash_bucket

SEED = 42
SHARDS = 8
BUCKET_BYTES = 24 << 20
BUCKET_ROWS = 65536
_SUMMED_BUCKETS = 1024


def shuffled_records(
    docs: DataFrame,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    bucket_rows: int = BUCKET_ROWS,
    workspace: Workspace | None = None,
) -> tuple[DataFrame, int]:
    """A stored table ``(bucket, pos, record)`` in shuffled order, and its number of rows.

    The bucket count follows the table's bytes and rows, so a bucket stays memory-sized at any scale.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(128)
    rows, weight = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    buckets = max(1, -(-weight // bucket_bytes), -(-rows // bucket_rows))
    scattered = docs.select(
        row_hash_bucket(buckets, seed).cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("row"),
        F.struct(*[docs[c] for c in docs.columns]).alias("record"),
    ).repartitionById(buckets, F.col("bucket"))
    # One bucket is one partition here: the group needs no further exchange, and the seed of the
    # permutation differs by bucket because it is offset by the partition.
    gathered = scattered.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("row", "record"))).alias("held"))
    permuted = gathered.select("bucket", F.shuffle("held", F.lit(seed)).alias("held"))
    shuffled = permuted.select("bucket", F.posexplode("held").alias("pos", "held")).select(
        "bucket", "pos", F.col("held.record").alias("record")
    )
    return workspace.table(shuffled, "buckets"), rows


def assign_shards(shuffled: DataFrame, rows: int, shards: int = SHARDS) -> DataFrame:
    """Adds ``shard`` and ``slot``: equal slices of the buckets' concatenation.

    Offsets are summed in two levels, over blocks of buckets and within a block.
    """
    counts = shuffled.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("block", F.floor(F.col("bucket") / _SUMMED_BUCKETS))
    blocks = counts.groupBy("block").agg(F.sum("n").alias("block_n"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", F.coalesce(F.sum("block_n").over(before), F.lit(0)).alias("block_start"))
    inside = Window.partitionBy("block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(blocks, "block")
    offsets = offsets.select("bucket", (F.col("block_start") + F.col("inside")).alias("first"))
    shard = F.expr(f"((first + pos + 1) * {shards}L - 1L) div {max(rows, 1)}L")
    placed = shuffled.join(offsets, "bucket").withColumn("shard", shard.cast("int"))
    slot = F.col("first") + F.col("pos") - F.expr(f"(cast(shard as bigint) * {rows}L) div {shards}L")
    return placed.withColumn("slot", slot).drop("first", "bucket", "pos")


def write_shards(assigned: DataFrame, location: str) -> None:
    """Writes one folder per shard, its records in slot order within and across files."""
    ordered = assigned.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.select("record.*", "shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(location)
