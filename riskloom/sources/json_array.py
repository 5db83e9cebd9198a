"""One JSON array, read by many tasks.

A file that is a single array of objects has no line a reader could be split at. Here it is split at every closing brace:
the text reader cuts such chunks out of byte ranges of the file, one task a range. Where in the document a chunk begins
is then found by a prefix scan. A chunk knows two things without its neighbours: whether it holds an odd number of quotes, so
that it turns "outside a string" into "inside" and back, and by how much it moves the bracket depth in either case. Both
combine from left to right. They are first combined inside each byte range, then over the ranges of a file (one short row
each), and the results go back to the chunks. A record ends with the chunk that returns to depth 1 outside any string.

Nearly all records are one chunk and are parsed where they were read; only those that hold further braces, or begin at
the start of a range, are put together by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import at_rest, broadcast_if_small

# On a chunk of which only quotes and brackets are left: strings, and those with what is left of the one that the chunk begins in.
_STRINGS = r'"[^"]*("|$)'
_STRINGS_FROM_INSIDE = r'^[^"]*("|$)|"[^"]*("|$)'
BLOCK = ["file", "block"]


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _depth(bare: Column) -> Column:
    """By how much brackets outside any string move the depth."""
    opened, closed = F.translate(bare, "{[", ""), F.translate(bare, "}]", "")
    return F.length(closed) - F.length(opened)


def chunks(spark: SparkSession, path: str) -> DataFrame:
    """text, file, block (the range's first byte), place in it, and the two things a chunk knows by itself.

    ``odd``: whether it changes between outside and inside. ``moves[s]``: the change of depth, its closing brace included,
    where it begins outside (0) or inside (1) a string.
    """
    read = spark.read.option("lineSep", "}").text(path).select(
        F.col("value").alias("text"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    # One pass over the text; the rest is found on the few quotes and brackets. A chunk ends with a brace, so no escape reaches past its end.
    text = F.col("text")
    unescaped = F.when(text.contains("\\"), F.regexp_replace(text, r"\\.", "")).otherwise(text)
    read = read.withColumn("marks", F.regexp_replace(unescaped, r'[^"{}\[\]]+', ""))
    read = read.withColumns({"odd": (_count(F.col("marks"), '"') % 2).cast("long"), "bare0": F.regexp_replace("marks", _STRINGS, ""), "bare1": F.regexp_replace("marks", _STRINGS_FROM_INSIDE, "")})
    closes = lambda begins: F.when((begins + F.col("odd")) % 2 == 0, 1).otherwise(0)
    moves = F.array(*[(_depth(F.col(f"bare{s}")) - closes(F.lit(s))).cast("long") for s in (0, 1)])
    return read.withColumn("moves", moves).drop("marks", "bare0", "bare1")


def _before(value: Column, *by: str, order: str) -> Column:
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0).cast("long"))


def scanned(read: DataFrame) -> DataFrame:
    """The chunks with ``ends`` (whether a record ends with it) and ``follows`` (whether one ended right before it in its range)."""
    in_block = read.withColumn("turns", _before(F.col("odd"), *BLOCK, order="place") % 2)
    # The change of depth if the whole range begins outside a string, and if it begins inside one.
    in_block = in_block.withColumns({f"move{s}": F.get("moves", ((F.col("turns") + s) % 2).cast("int")) for s in (0, 1)})
    in_block = at_rest(in_block, "json-chunks")
    ranges = in_block.groupBy(*BLOCK).agg(F.sum("odd").alias("odd"), F.sum("move0").alias("move0"), F.sum("move1").alias("move1"))
    begun = ranges.withColumn("begins", _before(F.col("odd"), "file", order="block") % 2)
    begun = begun.withColumn("depth", _before(F.when(F.col("begins") == 0, F.col("move0")).otherwise(F.col("move1")), "file", order="block"))
    begun = at_rest(begun.select(*BLOCK, "begins", "depth"), "json-ranges")
    placed = in_block.join(broadcast_if_small(begun, begun.count()), BLOCK)
    upto = Window.partitionBy(*BLOCK).orderBy("place")
    move = F.when(F.col("begins") == 0, F.col("move0")).otherwise(F.col("move1"))
    outside = (F.col("begins") + F.col("turns") + F.col("odd")) % 2 == 0
    deep = placed.withColumn("ends", outside & (F.col("depth") + F.sum(move).over(upto) == 1))
    return deep.select("text", *BLOCK, "place", "ends", F.coalesce(F.lag("ends").over(upto), F.lit(False)).alias("follows"))


def record_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the arrays under ``path``: its JSON text."""
    found = at_rest(scanned(chunks(spark, path)), "json-scanned")
    alone = found.where("ends AND follows").select(F.concat(F.regexp_replace("text", r"^[\s,]+", ""), F.lit("}")).alias("record"))
    # What is left: the pieces of longer records, numbered by the records that end before them.
    ended = found.groupBy(*BLOCK).agg(F.count_if("ends").alias("ended"))
    earlier = at_rest(ended.withColumn("earlier", _before(F.col("ended"), "file", order="block")).drop("ended"), "json-ended")
    counted = found.withColumn("number", _before(F.col("ends").cast("long"), *BLOCK, order="place")).where("NOT (ends AND follows)")
    counted = counted.join(broadcast_if_small(earlier, earlier.count()), BLOCK).withColumn("number", F.col("number") + F.col("earlier"))
    joined = counted.groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("block", "place", "text"))).alias("parts"), F.max("ends").alias("whole")).where("whole")
    text = F.concat(F.array_join(F.transform("parts", lambda p: p["text"]), "}"), F.lit("}"))
    return alone.union(joined.select(F.regexp_replace(text, r"^[\s,\[]+", "").alias("record")))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The records of files that are one JSON array each, under ``schema``; fields that are not there are null."""
    return record_texts(spark, path).select(F.from_json("record", schema).alias("r")).select("r.*")


def write_json_array(df: DataFrame, path: str, key: str, files: int = 1) -> None:
    """Rows as so many files of one JSON array each, dealt by a hash of ``key``; missing values are explicit nulls."""
    text = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    rows = df.select(F.pmod(F.xxhash64(key), F.lit(files)).alias("file"), F.lit(1).alias("rank"), text.alias("line"))
    ends = df.sparkSession.range(files).select(F.col("id").alias("file"), F.inline(F.array(*[F.struct(F.lit(r).alias("rank"), F.lit(t).alias("line")) for r, t in ((0, "["), (2, "]"))])))
    # Records need no order among themselves: one shuffle, and a file's rows are sorted by rank alone. The first record is its second row.
    place = F.row_number().over(Window.partitionBy("file").orderBy("rank"))
    comma = F.when((F.col("rank") == 1) & (place > 2), ",").otherwise("")
    rows.unionByName(ends).select(F.concat(comma, F.col("line")).alias("value"), "file").write.partitionBy("file").text(path)
