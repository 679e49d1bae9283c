"""Exact deduplication through an extendible-hash index on shared files.

Texts are equal when they agree after their blanks are deleted. The index holds one narrow
entry (key, digest, length, id) a document, never the text:

1. every entry's 64-bit key falls under a directory prefix; prefix counts are aggregated;
2. the directory doubles until no bucket that more prefix bits can split is overfull;
3. entries are written as bucket files, each task owning a range of buckets, so that a
   bucket's entries lie together for every later reader;
4. keys with two or more entries form chains: the texts of those keys alone are compared
   byte by byte, by grouping on the key and the text itself. Equal copies merge on the map
   side, so a text that a third of all rows share costs one row a task.

Only DataFrame functions are used. Null texts count as empty. A null id sorts after all
others. Of repeated equal rows (same id, same text) one stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamline.llm.shared import BLANKS, packed, text_or_empty, unpacked, written

#: Bits of the key that a directory may use, and entries of a bucket before it splits.
MAX_DEPTH = 20
BUCKET_ENTRIES = 50_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, BLANKS + "+", "")


def _key(norm: Column, key_bits: int) -> Column:
    """The leading bits of the hash; ``key_bits`` under 64 makes collisions, for tests."""
    return F.shiftright(F.xxhash64(norm), 64 - key_bits)


def directory(entries: DataFrame, key_bits: int = 64, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """(prefix, depth, bucket): the extendible directory over the entries' keys.

    The directory doubles one bit at a time, as long as a bucket is overfull. A bucket keeps
    the least depth at which it holds at most ``bucket_entries``; one whose entries share a
    single key cannot split and becomes an overflow chain. Only the prefix counts, at most
    2 ** MAX_DEPTH rows, are read again.
    """
    depth = min(MAX_DEPTH, key_bits)
    prefix = F.shiftright("key", key_bits - depth)
    cells = written(
        entries.groupBy(prefix.alias("prefix"))
        .agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")),
        "cells",
    )
    pieces, open_cells = [], cells
    for bits in range(depth + 1):
        held = W.partitionBy(F.shiftright("prefix", depth - bits))
        fits = (F.sum("n").over(held) <= bucket_entries) | (
            F.min("low").over(held) == F.max("high").over(held)
        )
        marked = written(open_cells.withColumn("fits", fits | F.lit(bits == depth)), "doubling")
        low = F.expr(f"shiftleft(shiftright(prefix, {depth - bits}), {depth - bits})")
        pieces.append(marked.where("fits").select("prefix", F.lit(bits).alias("depth"), low.alias("bucket")))
        open_cells = marked.where("not fits").drop("fits")
        if not open_cells.limit(1).count():
            break
    return reduce(DataFrame.unionByName, pieces)


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    key_bits: int = 64, bucket_entries: int = BUCKET_ENTRIES,
) -> DataFrame:
    """Bucket files of entries (id, n_chars, key, sha256, bucket), read back from the shared folder."""
    text = text_or_empty(text_col)
    norm = normalised(text)
    entries = written(
        docs.select(
            F.col(id_col).alias("id"), F.length(text).cast("long").alias("n_chars"), norm.alias("norm")
        ).select(
            "id", "n_chars", _key(F.col("norm"), key_bits).alias("key"),
            F.sha2(F.col("norm"), 256).alias("sha256"),
        ).withColumn("entry", F.monotonically_increasing_id()),
        "entries",
    )
    depth = min(MAX_DEPTH, key_bits)
    owned = entries.withColumn("prefix", F.shiftright("key", key_bits - depth)).join(
        directory(entries, key_bits, bucket_entries).select("prefix", "bucket"), "prefix"
    )
    # The entry number keeps one key's chain from falling into a single range.
    return written(
        owned.drop("prefix").repartitionByRange("bucket", "key", "entry")
        .sortWithinPartitions("bucket", "key"),
        "buckets",
    )


def _best(size: str) -> Column:
    """Order in which rows stay: most code points, then smallest id, null last, then entry."""
    return F.struct((-F.col(size)).alias("short"), F.col("id").isNull().alias("no_id"), "id", "entry")


def chains(docs: DataFrame, index: DataFrame, text_col: str, key_bits: int) -> DataFrame:
    """(key, sha256, copies) of each distinct text under keys with two or more entries.

    Grouping by the text compares bytes. Two texts with one digest under one key are
    refused with an error instead of merged.
    """
    several = written(index.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "chains")
    texts = docs.select(normalised(text_or_empty(text_col)).alias("norm")).select(
        _key(F.col("norm"), key_bits).alias("key"), "norm"
    )
    same = (
        texts.join(several, "key", "left_semi").groupBy("key", "norm").agg(F.count("*").alias("copies"))
        .select("key", F.sha2("norm", 256).alias("sha256"), "copies")
    )
    merged = same.groupBy("key", "sha256").agg(
        F.sum("copies").alias("copies"), F.count("*").alias("texts")
    )
    checked = F.when(F.col("texts") == 1, F.col("copies")).otherwise(
        F.raise_error(F.lit("two texts share a digest")).cast("long")
    )
    return merged.select("key", "sha256", checked.alias("copies"))


def duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    key_bits: int = 64, bucket_entries: int = BUCKET_ENTRIES,
) -> DataFrame:
    """One row a document: id, n_chars, text_sha256, keep_id, group_size, kept, repeats.

    ``repeats`` numbers the rows that equal the row that stays in id and length.
    An empty input gives an empty result.
    """
    index = build_index(docs, id_col, text_col, key_bits, bucket_entries)
    compared = chains(docs, index, text_col, key_bits)
    stays = index.groupBy("key", "sha256").agg(F.min(_best("n_chars")).alias("best")).select(
        "key", "sha256", "best.id", "best.entry", (-F.col("best.short")).alias("chars")
    )
    groups = written(
        stays.join(compared, ["key", "sha256"], "left").select(
            "key", "sha256", F.col("id").alias("keep_id"), F.col("entry").alias("keep_entry"),
            F.col("chars").alias("keep_chars"), F.coalesce("copies", F.lit(1)).alias("group_size"),
        ),
        "groups",
    )
    same = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
    return index.join(groups, ["key", "sha256"]).select(
        "id", "n_chars", F.col("sha256").alias("text_sha256"), "keep_id", "group_size",
        (F.col("entry") == F.col("keep_entry")).alias("kept"), same.alias("repeats"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    Rows meet the decisions by (id, digest, length), which no group of copies shares, so a
    hot text does not gather in one task. Repeated equal rows lose all but one.
    """
    wanted = written(
        duplicates(docs, id_col, text_col).where("repeats")
        .groupBy("id", "text_sha256", "n_chars").agg(F.count("*").alias("n")),
        "stays",
    )
    text = text_or_empty(text_col)
    marked = packed(
        docs, id=F.col(id_col), digest=F.sha2(normalised(text), 256), size=F.length(text).cast("long")
    )
    side = wanted.select(
        F.col("id").alias("kept_id"), F.col("text_sha256").alias("kept_digest"),
        F.col("n_chars").alias("kept_size"), F.col("n").alias("rows"),
    )
    on = (
        marked["id"].eqNullSafe(side["kept_id"]) & (marked["digest"] == side["kept_digest"])
        & (marked["size"] == side["kept_size"])
    )
    found = marked.join(side, on).drop("kept_id", "kept_digest", "kept_size")
    once = found.where("rows = 1").select("doc")
    again = found.where("rows > 1").dropDuplicates(["id", "digest", "size"]).select("doc")
    return unpacked(once.unionByName(again))
