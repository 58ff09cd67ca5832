"""Delimited records with line breaks inside quotes, and arrays of JSON records, read by many tasks.

Delimited files: a line end separates records only outside quotes, and whether a line begins inside them depends on all
quotes before it. So lines are read in blocks as any text is; every block counts its quotes, the blocks'
parities are added up in file order (chunks of a block likewise, so that no task holds a block), and each line then knows whether it begins a record: if the quotes
before it are even. Lines are put together by the number of record starts before them, which may cross
blocks, and every record is parsed on its own.

Arrays: text is cut behind every closing brace, wherever that stands. A piece turns the state (inside a string
or not) if its quotes are odd, and changes the depth of brackets by an amount that depends on the state it begins
in. Both are added up within chunks of blocks, then over chunks, one row each. A piece that returns to the array's own depth
ends a record.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Lines or pieces of a block that are counted together: 2 to this power at most.
CHUNK_BITS = 14
# A window over them is this many rows at most; a chunk's place is unique in its block.
PART = ["file", "block", "chunk"]


def _chunk(place: str) -> Column:
    return F.shiftright(place, CHUNK_BITS).alias("chunk")


def _quotes(line: Column, quote: str) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(quote), F.lit("")))


def lines_in_order(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line, value): every line with its place. Lines of a block ascend, blocks begin at their byte."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value",
    )


def records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """(file, number, record): the records of each file, numbered from 0; blank lines between records are none.

    Chunks of blocks are counted twice from the text and never gathered: what a chunk passes on is one row, its number
    of quotes and of record starts for either state it may begin in.
    """
    lines = lines_in_order(spark, path).select("*", _chunk("line"), _quotes(F.col("value"), quote).alias("quotes"))
    in_block = Window.partitionBy(*PART).orderBy("line")
    before = F.sum("quotes").over(in_block.rowsBetween(Window.unboundedPreceding, -1))
    placed = lines.withColumn("odd", F.coalesce(before, F.lit(0)) % 2)
    filled = F.trim(F.col("value"), F.lit("\r")) != ""
    begins = [((F.col("odd") == state) & filled).cast("bigint") for state in (0, 1)]
    placed = placed.withColumns({f"starts{state}": F.sum(b).over(in_block) for state, b in enumerate(begins)})
    blocks = placed.groupBy(*PART).agg(
        (F.sum("quotes") % 2).alias("turns"), F.max("starts0").alias("all0"), F.max("starts1").alias("all1")
    )
    # One row a chunk from here on.
    by_file = Window.partitionBy("file").orderBy("block", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("inside", F.coalesce(F.sum("turns").over(by_file), F.lit(0)) % 2)
    own = F.when(F.col("inside") == 0, F.col("all0")).otherwise(F.col("all1"))
    blocks = blocks.withColumn("first", F.coalesce(F.sum(own).over(by_file), F.lit(0))).select(*PART, "inside", "first")
    numbered = placed.join(blocks, PART).withColumn(
        "number", F.col("first") + F.when(F.col("inside") == 0, F.col("starts0")).otherwise(F.col("starts1")) - 1
    )
    # A blank line outside quotes belongs to no record; inside them it does.
    outside = F.col("odd") == F.col("inside")
    kept = numbered.filter(~outside | filled)
    joined = kept.groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("lines"))
    text = F.concat_ws("\n", F.col("lines.value"))
    return joined.select("file", "number", F.regexp_replace(text, "\r$", "").alias("record"))


def read_broken_csv(spark: SparkSession, path: str, quote: str = '"', **options: str) -> DataFrame:
    """CSV files with a header and line breaks inside quotes as text columns; the rows that one task would read
    whole (``multiLine``), from as many tasks as there are blocks. The header is that of the first file; repeated and
    empty names are told apart by their place."""
    found = records(spark, path, quote)
    settings = {"escape": quote, "quote": quote, **options}
    first = found.filter("number = 0").orderBy("file").limit(1).select("record").first()
    if first is None:
        return spark.createDataFrame([], "_c0 string")
    names = next(csv.reader(io.StringIO(first["record"]), quotechar=quote, delimiter=settings.get("sep", ",")))
    seen = [n.lower() for n in names]
    names = [n if n and seen.count(n.lower()) == 1 else f"{n or '_c'}{i}" for i, n in enumerate(names)]
    fields = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    parsed = found.filter("number > 0").select(F.from_csv("record", fields, settings).alias("row"))
    return parsed.select("row.*")


def pieces_in_order(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, piece, value): text cut behind its closing braces (left out of ``value``), with places as lines have."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("piece"), "value",
    )


def _depth(value: Column, inside: bool) -> Column:
    """How much a piece, its final brace included, deepens the nesting, if it begins inside a string or not."""
    text = F.concat(F.lit('"'), value) if inside else value
    closed = F.regexp_replace(text, '"[^"]*"', "")
    outside = F.regexp_replace(closed, '".*', "")  # what an unclosed string leaves
    ends_inside = F.contains(closed, F.lit('"'))
    opened = F.length(F.regexp_replace(outside, r"[^\[{]", ""))
    shut = F.length(F.regexp_replace(outside, r"[^\]]", "")) + F.when(ends_inside, 0).otherwise(1)
    return (opened - shut).cast("bigint")


def array_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, number, record): the records of files that hold one JSON array each, as lines of text, numbered from 0.

    Line breaks outside strings become blanks; inside strings JSON allows none. An empty array has no records.
    Elements other than objects, a file cut short, and text behind the array stay in ``record`` marked so that no
    parser takes them.
    """
    pieces = pieces_in_order(spark, path)
    # Escaped characters and line breaks decide nothing below.
    bare = F.regexp_replace("value", r"\\[\s\S]|[\r\n]", "")
    counted = pieces.select("*", _chunk("piece"), _quotes(bare, '"').alias("quotes"), *[_depth(bare, bool(i)).alias(f"depth{i}") for i in (0, 1)])
    in_block = Window.partitionBy(*PART).orderBy("piece")
    before = F.coalesce(F.sum("quotes").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    counted = counted.withColumn("odd", before)
    # Depth inside the chunk, if the chunk begins outside (0) or inside (1) a string.
    begun = [F.when(F.col("odd") == i, F.col("depth0")).otherwise(F.col("depth1")) for i in (0, 1)]
    placed = counted.withColumns({f"level{i}": F.sum(b).over(in_block) for i, b in enumerate(begun)})
    last = [F.max_by(f"level{i}", "piece").alias(f"all{i}") for i in (0, 1)]
    blocks = placed.groupBy(*PART).agg((F.sum("quotes") % 2).alias("turns"), F.max("piece").alias("end"), *last)
    by_file = Window.partitionBy("file").orderBy("block", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("inside", F.coalesce(F.sum("turns").over(by_file), F.lit(0)) % 2)
    own = F.when(F.col("inside") == 0, F.col("all0")).otherwise(F.col("all1"))
    blocks = blocks.withColumn("start", F.coalesce(F.sum(own).over(by_file), F.lit(0)))
    # No brace follows a file's last piece.
    following = F.lead("block").over(Window.partitionBy("file").orderBy("block", "chunk"))
    blocks = blocks.withColumn("end", F.when(following.isNull(), F.col("end"))).select(*PART, "inside", "start", "end")
    level = F.col("start") + F.when(F.col("inside") == 0, F.col("level0")).otherwise(F.col("level1"))
    outside = (F.col("odd") + F.col("inside") + F.col("quotes")) % 2 == 0
    known = placed.join(blocks, PART).select(
        *PART, "piece", "value",
        (outside & (level == 1) & ~F.col("end").eqNullSafe(F.col("piece"))).cast("bigint").alias("ends"),
    )
    # A second sum, of the records that ended before.
    known = known.withColumn("past", F.coalesce(F.sum("ends").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ended = known.groupBy(*PART).agg(F.sum("ends").alias("ends"))
    ended = ended.select(*PART, F.coalesce(F.sum("ends").over(by_file), F.lit(0)).alias("first"))
    numbered = known.join(ended, PART).withColumn("number", F.col("first") + F.col("past"))
    joined = numbered.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("block", "piece", "value"))).alias("pieces"), F.max("ends").alias("whole")
    )
    text = F.concat(F.concat_ws("}", F.col("pieces.value")), F.when(F.col("whole") == 1, "}").otherwise(""))
    text = F.trim(F.translate(text, "\r\n\t", "   "))
    start = F.when(F.col("number") == 0, F.rlike(text, F.lit(r"^\[ *\{"))).otherwise(F.rlike(text, F.lit(r"^, *\{")))
    record = F.when(start & (F.col("whole") == 1), F.regexp_replace(text, r"^[\[,] *", "")).otherwise(F.concat(F.lit("!"), text))
    rest = (F.col("whole") == 0) & F.when(F.col("number") == 0, F.rlike(text, F.lit(r"^\[ *\]$"))).otherwise(text == "]")
    return joined.filter(~rest).select("file", "number", record.alias("record"))
