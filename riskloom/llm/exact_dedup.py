"""Exact duplicates through an extendible-hash index on shared files.

Texts are equal when they are the same without the characters ``[\\x20\\x09-\\x0D]``. The index has one entry per distinct
text: hash, digest, the row that stays and the number of copies. Its directory starts with one bucket and doubles,
splitting the buckets with more distinct hashes than ``capacity``, until all fit or ``MAX_DEPTH`` is reached. A bucket is a
range of hashes with one owner task, which sorts it, chains the entries of equal hash and writes one file. Hashes of
one row alone enter as they are. For all others the texts are read again and compared byte by byte, copies merged
before the shuffle, so a text takes part in one entry however many rows have it. Every row then looks up
its entry in the index; entries with more than one of ``HOT_SHARE`` of all rows, fewer than that in number, are looked up by broadcast.

Defined results: null counts as empty; empty texts are copies of each other; a null id comes after all others;
whole repeated rows count one by one, and each of those that share the id that stays is ``kept``. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import at_rest, broadcast_if_small, new_path

MAX_DEPTH = 16
#: A bucket holds at least this many hashes, and as many as make four buckets a core.
LEAST_CAPACITY = 1_000
CAPACITY = None
HOT_SHARE = 1_000
BLANKS = "[ \\t-\\r]+"


def normalised(text: str = "text"):
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), BLANKS, "")


def entries(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One short row per document: what looks up the index, without the text."""
    bare = docs.select(F.col(key).alias("doc_id"), normalised(text).alias("norm"), F.length(F.coalesce(F.col(text), F.lit(""))).alias("n"))
    return bare.select("doc_id", F.xxhash64("norm").alias("hash"), F.sha2("norm", 256).alias("sha"), "n")


def directory(counts: dict[int, int], capacity: int, depth: int = MAX_DEPTH) -> list[tuple[int, int]]:
    """(bucket, local depth) for each of the ``2 ** global depth`` slots.

    ``counts``: distinct hashes by the leading ``depth`` bits. A full bucket is split by its next bit; when its
    local depth is the global one, the directory doubles first.
    """
    below = [0, *accumulate(counts.get(p, 0) for p in range(1 << depth))]
    slots, over = [(0, 0)], [(0, 0)] if below[-1] > capacity and depth else []
    while over:
        full = []
        for prefix, local in over:
            if 1 << local == len(slots):
                slots = [b for b in slots for _ in (0, 1)]
            span, level = len(slots) >> local, local + 1
            for half in (2 * prefix, 2 * prefix + 1):
                first = half * span // 2
                slots[first : first + span // 2] = [(half, level)] * (span // 2)
                held = below[(half + 1) << (depth - level)] - below[half << (depth - level)]
                if held > capacity and level < depth:
                    full.append((half, level))
        over = full
    return slots


def leading(bits: int):
    """The leading bits of the hash, as an unsigned number."""
    return F.shiftrightunsigned("hash", 64 - bits).cast("int") if bits else F.lit(0)


def bucket_of(slots: list[tuple[int, int]]):
    """The bucket of a hash, named by its first slot, as a column."""
    firsts: dict[tuple[int, int], int] = {}
    for i, bucket in enumerate(slots):
        firsts.setdefault(bucket, i)
    numbers = F.split(F.lit(",".join(str(firsts[b]) for b in slots)), ",").cast("array<int>")
    return F.element_at(numbers, leading(len(slots).bit_length() - 1) + 1)


def stays():
    """The row that stays among the copies of a text: most code points, then the smallest id, null ids last."""
    return F.min(F.struct((-F.col("n")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id"))


def compared(docs: DataFrame, repeated: DataFrame, key: str, text: str) -> DataFrame:
    """An entry for each distinct text among those whose hash occurs more than once, told apart by their bytes."""
    texts = docs.select(F.col(key).alias("doc_id"), normalised(text).alias("norm"), F.length(F.coalesce(F.col(text), F.lit(""))).alias("n"))
    texts = texts.withColumn("hash", F.xxhash64("norm"))
    same = texts.join(broadcast_if_small(repeated, repeated.count()), "hash", "left_semi").groupBy("hash", "norm").agg(stays().alias("best"), F.count("*").alias("group_size"))
    return same.select("hash", F.sha2("norm", 256).alias("sha"), F.col("best.doc_id").alias("keep_id"), "group_size")


def build_index(docs: DataFrame, rows: DataFrame, key: str = "doc_id", text: str = "text", capacity: int | None = CAPACITY) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The index, a folder and a file per bucket under the shared folder, and its directory.

    bucket, hash, sha, keep_id, group_size, and ``place``: the entry's place in the chain of its hash, from 1.
    """
    spark = docs.sparkSession
    heads = rows.groupBy("hash").agg(F.count("*").alias("group_size"), F.min("sha").alias("sha"), stays().alias("best"))
    heads = at_rest(heads.select("hash", "sha", F.col("best.doc_id").alias("keep_id"), "group_size"), "heads")
    counts = {r["p"]: r["count"] for r in heads.groupBy(leading(MAX_DEPTH).alias("p")).count().collect()}
    if capacity is None:
        capacity = max(LEAST_CAPACITY, sum(counts.values()) // (4 * spark.sparkContext.defaultParallelism))
    slots = directory(counts, capacity)
    held = heads.where("group_size = 1").unionByName(compared(docs, heads.where("group_size > 1").select("hash"), key, text))
    owned = held.withColumn("bucket", bucket_of(slots)).repartition(len(set(slots)), "bucket")
    chain = Window.partitionBy("bucket", "hash").orderBy("sha")
    chained = owned.withColumn("place", F.row_number().over(chain))
    path = new_path(spark, "hash-index")
    chained.write.partitionBy("bucket").parquet(path)
    return spark.read.schema(chained.schema).parquet(path), slots


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int | None = CAPACITY) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row, dropped ones too."""
    return decide(docs, key, text, capacity).drop("hash")


def decide(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int | None = CAPACITY) -> DataFrame:
    """The groups, with the hash that each row has in the index.

    Of equal texts the row with the most code points stays, then the smallest id.
    """
    rows = at_rest(entries(docs, key, text), "entries")
    index, slots = build_index(docs, rows, key, text, capacity)
    looking = rows.withColumn("bucket", bucket_of(slots)).drop("n")
    on, most = ["bucket", "hash", "sha"], rows.count() // HOT_SHARE
    hot = F.col("group_size") > most
    many = F.broadcast(index.where(hot).select(*on, "keep_id", "group_size"))
    found = looking.join(many, on).unionByName(looking.join(many, on, "left_anti").join(index.where(~hot).select(*on, "keep_id", "group_size"), on))
    return found.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), F.col("sha").alias("text_sha256"), "hash",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows that stay, with their columns; of repeated rows, one (the longest, then the first by text)."""
    decided = decide(docs).where("kept").groupBy(F.col("doc_id").alias("kept_id"), F.col("hash").alias("kept_hash")).count()
    decided = at_rest(decided, "kept")
    text_hash, place = (name + "_" * sum(map(len, docs.columns)) for name in ("_text_hash", "_place"))
    hashed = docs.withColumn(text_hash, F.xxhash64(normalised()))
    same = hashed["doc_id"].eqNullSafe(decided["kept_id"]) & (hashed[text_hash] == decided["kept_hash"])
    out = hashed.join(decided.where(decided["count"] == 1), same, "left_semi")
    repeated = decided.where(decided["count"] > 1)
    if not repeated.isEmpty():
        first = F.row_number().over(Window.partitionBy("doc_id", text_hash).orderBy(F.length("text").desc(), "text"))
        more = hashed.join(repeated, same, "left_semi").withColumn(place, first).where(F.col(place) == 1)
        out = out.union(more.drop(place))
    return out.drop(text_hash)
