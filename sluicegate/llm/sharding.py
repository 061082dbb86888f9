"""Sharding by extendible hashing, in DataFrame expressions alone.

A row's hash is a string of 60 bits. The directory is indexed by the first ``depth`` of them. A bucket
above the byte limit splits on its next bit; buckets that fit stay as they are, so that shards have
prefixes of different lengths.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicegate.llm.common import Scratch

HASH_BITS = 60
# The directory is taken this many bits deeper than shards of equal size would need.
SPARE_BITS = 4
# Bits by which the directory is doubled again below entries that are still too large.
DEEPER_BITS = 8
# Pages, and rows, that one task numbers.
PART_PAGES, PART_ROWS = 64, 1 << 20


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the MD5 of a key's text; a null key is hashed as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(depth: Column | int) -> Column:
    bits = F.lit(HASH_BITS) - depth
    return F.call_function("shiftright", F.col("hash"), bits.cast("int"))


def _directory(rows: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """Entries of ``high`` bits with the depth, from ``low`` on, at which their bucket fits.

    ``depth`` is null where even the entry is too large. Rows are added up to entries first; only
    entries are repeated for every depth.
    """
    entries = rows.groupBy(_prefix(high).alias("entry")).agg(F.sum("bytes").alias("bytes"))
    levels = entries.select(
        "entry", "bytes", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")
    ).withColumn("prefix", F.expr(f"shiftright(entry, {high} - depth)"))
    buckets = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bucket_bytes"))
    return (
        levels.join(buckets, ["depth", "prefix"])
        .groupBy("entry")
        .agg(F.min(F.when(F.col("bucket_bytes") <= limit, F.col("depth"))).alias("depth"))
    )


class _Directory(NamedTuple):
    """One round: entries of ``bits`` bits with the depth of their bucket, null where the entry is too large."""

    bits: int
    entries: DataFrame


def _directories(rows: DataFrame, max_bytes: int, scratch: Scratch) -> list[_Directory]:
    """Rounds over ``hash`` and ``n_bytes`` until every entry fits, or all bits are used."""
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    low, high = 0, min(HASH_BITS, max(1, math.ceil(math.log2(max(1, total / max_bytes)))) + SPARE_BITS)
    rounds: list[_Directory] = []
    while True:
        entries = scratch.table(
            _directory(rows.select("hash", F.col("n_bytes").alias("bytes")), low, high, max_bytes), f"directory_{high}"
        )
        rounds.append(_Directory(high, entries))
        if high == HASH_BITS or entries.where("depth IS NULL").isEmpty():
            return rounds
        rows = _looked_up(rows, rounds[-1]).where("depth IS NULL").drop("depth")
        low, high = high + 1, min(HASH_BITS, high + DEEPER_BITS)


def _looked_up(rows: DataFrame, directory: _Directory) -> DataFrame:
    return rows.withColumn("entry", _prefix(directory.bits)).join(directory.entries, "entry").drop("entry")


def _placed(rows: DataFrame, rounds: list[_Directory], max_bytes: int) -> DataFrame:
    """Rows with ``depth`` and ``page``; ``place`` tells rows of one hash apart."""
    placed = []
    for directory in rounds:
        found = _looked_up(rows, directory)
        placed.append(found.where("depth IS NOT NULL").withColumn("page", F.lit(0).cast("long")))
        rows = found.where("depth IS NULL").drop("depth")
    if rounds[-1].bits == HASH_BITS:
        placed.append(_overflow(rows, max_bytes).withColumn("depth", F.lit(HASH_BITS)))
    return reduce(DataFrame.unionByName, placed)


def _overflow(rows: DataFrame, max_bytes: int) -> DataFrame:
    """Rows of buckets that no further bit can split, put on pages that fit.

    The rows of a hash are dealt to parts, which number their pages on their own, from one pass over the rows. Texts of at most half the
    limit fill a page until half of the limit is passed, so that the last one fits as well; a longer text is a
    page of its own.
    """
    half = F.lit(max_bytes / 2)
    parts = rows.groupBy("hash").agg(
        F.ceil(F.greatest(F.sum("n_bytes") / (PART_PAGES * max_bytes), F.count("*") / PART_ROWS)).alias("parts")
    )
    dealt = rows.join(parts, "hash").withColumn("part", F.pmod(F.xxhash64("place"), F.greatest("parts", F.lit(1))))
    small = F.col("n_bytes") <= half
    size = F.when(small, F.col("n_bytes")).otherwise(0)
    before = Window.partitionBy("hash", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("hash", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    numbered = dealt.withColumns(
        {
            "shared": F.floor(F.coalesce(F.sum(size).over(before), F.lit(0)) / half),
            "alone": F.sum(F.when(small, 0).otherwise(1)).over(upto),
        }
    )
    # Numbers of one part are those that leave its own number as the rest, so parts need not know of each other.
    whole = Window.partitionBy("hash", "part")
    n_shared = F.coalesce(F.max(F.when(small, F.col("shared"))).over(whole) + 1, F.lit(0))
    own = F.when(small, F.col("shared")).otherwise(n_shared + F.col("alone") - 1)
    page = own * F.greatest("parts", F.lit(1)) + F.col("part")
    return numbered.withColumn("page", page.cast("long")).select(*rows.columns, "page")


def _bits() -> Column:
    named = F.lpad(F.bin(_prefix(F.col("depth"))), F.col("depth"), F.lit("0"))
    return F.when(F.col("depth") == 0, "").otherwise(named)


def shard(
    df: DataFrame, max_bytes: int = 32 << 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The shard of every row: ``doc_id``, ``n_bytes`` of its text, ``shard``, ``depth``, ``page``.

    ``shard`` holds the ``depth`` hash bits that name the bucket ('' if all rows fit into one). Rows
    of one shard have at most ``max_bytes`` bytes of text. A bucket whose rows share all 60 bits,
    many rows of one key, cannot split further; its rows are put on overflow pages (``page`` from 0;
    0 elsewhere), none of which has more than ``max_bytes`` unless a single text has: that is a page or
    shard of its own as far as its key allows.

    Bytes are summed in the map tasks, per directory entry; entries number some 16 times the shards.
    Only rows below entries that are still too large take part in a further round of 8 bits. Texts
    are read once, for their lengths; ids, lengths and hashes are kept as a table on shared storage.
    A hot key is paged in parts of at most 64 pages or a million rows each.
    The driver sees the sum of bytes and whether a round is needed.

    Null texts have 0 bytes, null keys hash as the empty text, repeated rows of a key share a shard,
    other columns are not read, and an empty table gives an empty result.
    """
    scratch = Scratch(df.sparkSession)
    rows = scratch.table(_measured(df, id_col, text_col).select(df[id_col].alias("doc_id"), "hash", "n_bytes"), "rows")
    rounds = _directories(rows, max_bytes, scratch)
    placed = _placed(rows.withColumn("place", F.monotonically_increasing_id()), rounds, max_bytes)
    return placed.select("doc_id", "n_bytes", _bits().alias("shard"), F.col("depth").cast("int").alias("depth"), "page")


def _measured(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A frame with ``hash`` and ``n_bytes`` beside its columns."""
    n_bytes = F.coalesce(F.octet_length(df[text_col]), F.lit(0)).cast("long")
    return df.select("*", hash_bits(df[id_col]).alias("hash"), n_bytes.alias("n_bytes"))


def write_shards(
    df: DataFrame,
    path: str,
    max_bytes: int = 32 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_format: str = "parquet",
) -> None:
    """Write whole rows in one folder per shard and page: ``shard_bits=b<bits>/page=<number>``.

    No folder, and so no file, holds more than ``max_bytes`` bytes of text, except for a single longer
    text. Rows find their folder by their hash; nothing is joined by key, so a hot key is no one
    task's work. Columns named ``shard_bits`` or ``page`` are refused.
    """
    taken = {"shard_bits", "page"} & {c.lower() for c in df.columns}
    if taken:
        raise ValueError(f"the columns {', '.join(sorted(taken))} would be overwritten")
    scratch = Scratch(df.sparkSession)
    rounds = _directories(scratch.table(_measured(df, id_col, text_col).select("hash", "n_bytes"), "rows"), max_bytes, scratch)
    # Columns of any name travel in a struct; equal rows need no place of their own, but an order.
    row = F.struct(*[df[c] for c in df.columns]).alias("row")
    rows = _measured(df, id_col, text_col).select(row, "hash", "n_bytes").withColumn("place", F.monotonically_increasing_id())
    placed = _placed(rows, rounds, max_bytes)
    named = placed.select("row.*", F.concat(F.lit("b"), _bits()).alias("shard_bits"), "page")
    named.hint("rebalance", "shard_bits", "page").write.format(file_format).partitionBy("shard_bits", "page").save(path)


# Limit of the registered query: small enough that the smallest table of the tests splits too.
QUERY_BYTES = 256 << 10

SHARD_SQL = f"""
WITH hashed AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash
  FROM documents
), levels AS (
  SELECT doc_id, n_bytes, hash, depth, hash >> ({HASH_BITS} - depth) AS prefix
  FROM hashed, (SELECT unnest(range(0, 25))::INT AS depth)
), buckets AS (
  SELECT depth, prefix, sum(n_bytes) AS bytes FROM levels GROUP BY ALL
), leaves AS (
  SELECT doc_id, any_value(n_bytes) AS n_bytes, any_value(hash) AS hash, min(depth) AS depth
  FROM levels JOIN buckets USING (depth, prefix) WHERE bytes <= {QUERY_BYTES} GROUP BY doc_id
)
SELECT doc_id, n_bytes,
       CASE WHEN depth = 0 THEN '' ELSE lpad(bin(hash >> ({HASH_BITS} - depth)), depth, '0') END AS shard,
       depth, 0::BIGINT AS page
FROM leaves
"""
