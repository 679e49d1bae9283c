"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Documents get a fixed pseudo-random place ``u``; a source's documents with the same
   leading bits of ``u`` form a block, so block order is a random permutation.
2. A source's target, in words, becomes a quota: whole passes over its blocks, the blocks
   before a cut, and the few documents of the cut's cell that still fit. The cut is found
   by radix descent on summed sizes: 4,096 sums a source and round, no sort of documents.
   The places beyond the cell are gone through the same way for the room that is left, over
   the documents that still fit, until none does.
3. The quotas (one slot a block to draw) go down a binary tree of output shards. Each node
   hands a random half of its slots to either child, which is a multivariate hypergeometric
   draw of its quota vector; a leaf knows how many blocks of each source it gets.
4. Each shard draws the next disjoint run of every source's permuted blocks, and its rows
   are shuffled locally by a random key.

Only DataFrame functions are used. Null texts have size 0. Null is a source of its own,
after all others. Documents without id take their place from their text; repeated rows take
the same place and are taken together. Reruns give the same mix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamline.llm.shared import free_name, packed, text_or_empty, word_count, written
from loamline.operators.rank import global_position

PLACE_BITS = 60
RADIX_BITS = 12
#: Documents of a cut cell that are tried one by one.
CELL_DOCS = 512
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SHARDS = 16
#: Words of a shard that one task shuffles.
PIECE_WORDS = 4_000_000
#: Blocks of all sources together; each source has at least one.
BLOCKS = 32_768


def place(id_col: Column, text: Column, seed: int) -> Column:
    """60 pseudo-random bits from the id, or from the text where there is no id."""
    label = F.concat(F.lit(f"{seed}|"), F.coalesce(id_col.cast("string"), F.md5(text)))
    return F.conv(F.substring(F.md5(label), 1, PLACE_BITS // 4), 16, 10).cast("long")


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, docs, words, target) of each source.

    Sources, in code point order with null last, take the weights in turn and share
    ``share`` times all words. A target above ``most`` times its source stops there and the
    excess goes to the others by weight, until none is above (or all have stopped).
    """
    per_source = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("words"))
    ranked = global_position(per_source, [F.asc_nulls_last("source")], "n")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("n") % len(weights) + 1).cast("int"))
    table = written(ranked.withColumn("weight", weight).drop("n"), "sources")
    top = F.col("words") * F.lit(most)
    total = table.agg(F.sum("words")).first()[0] or 0
    left, level = share * total, 0.0
    stopped = F.lit(False)
    # Each round stops at least one more source; the level only rises.
    while True:
        row = table.agg(
            F.sum(F.when(stopped, top).otherwise(0.0)).alias("used"),
            F.sum(F.when(stopped, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.sum(F.when(stopped, 1).otherwise(0)).alias("n"),
        ).first()
        if not row["open"]:
            break
        level = (left - row["used"]) / row["open"]
        above = stopped | (F.col("weight") * F.lit(level) > top)
        if table.where(above).count() == row["n"]:
            break
        stopped = above
    target = F.when(stopped, top).otherwise(F.col("weight") * F.lit(level))
    return table.select("source", "docs", "words", target.cast("double").alias("target"))


def _cuts(sizes: DataFrame, quotas: DataFrame, radix_bits: int, cell_docs: int) -> DataFrame:
    """(source, cut, wide, room): places below ``cut`` are drawn, those in
    [cut, cut + wide) compete for the ``room`` words that are left."""
    state = written(
        quotas.select(
            "source", F.lit(0).cast("long").alias("cut"),
            F.lit(1 << PLACE_BITS).cast("long").alias("wide"), F.col("part").alias("room"), "docs",
        ),
        "cut",
    )
    for bits in range(PLACE_BITS - radix_bits, 0, -radix_bits):
        if not state.where(F.col("docs") > cell_docs).limit(1).count():
            break
        step = 1 << bits
        old = state.select(F.col("source").alias("s"), "cut", "wide", "room", F.col("docs").alias("cell_docs"))
        inside = sizes.join(old, sizes["source"].eqNullSafe(F.col("s"))).where(
            (F.col("cell_docs") > cell_docs) & (F.col("u") >= F.col("cut")) & (F.col("u") < F.col("cut") + F.col("wide"))
        )
        sums = inside.groupBy("source", "room", F.shiftright("u", bits).alias("cell")).agg(
            F.sum("size").alias("words"), F.count("*").alias("docs")
        )
        before = W.partitionBy("source").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
        cells = sums.withColumn("below", F.coalesce(F.sum("words").over(before), F.lit(0)))
        # The cut's cell is the last that begins within the room.
        chosen = (
            cells.where(F.col("below") <= F.col("room")).groupBy("source")
            .agg(F.max("cell").alias("cell"), F.max_by("below", "cell").alias("below"), F.max_by("docs", "cell").alias("docs"))
            .select(
                "source", (F.col("cell") * F.lit(step)).alias("cut"), F.lit(step).cast("long").alias("wide"),
                F.col("below"), "docs",
            )
        )
        kept = state.where(F.col("docs") <= cell_docs)
        rooms = state.select(F.col("source").alias("s"), "room")
        state = written(
            kept.unionByName(
                chosen.join(rooms, chosen["source"].eqNullSafe(F.col("s")))
                .select("source", "cut", "wide", (F.col("room") - F.col("below")).alias("room"), "docs")
            ),
            "cut",
        )
    return state


def _fitting(sizes: DataFrame, cuts: DataFrame) -> DataFrame:
    """(source, fits, left): places in the cut's cell whose documents fit, first come first
    served, and the words that are left.

    A cell holds at most ``CELL_DOCS`` documents, but for rows with the very same place,
    which are added up first, so the list is bounded.
    """
    side = cuts.select(F.col("source").alias("s"), "cut", "wide", "room")
    near = (
        sizes.join(side, sizes["source"].eqNullSafe(F.col("s")))
        .where((F.col("u") >= F.col("cut")) & (F.col("u") < F.col("cut") + F.col("wide")))
        .groupBy("source", "u").agg(F.sum("size").alias("size"), F.max("room").alias("room"))
    )
    listed = near.groupBy("source").agg(
        F.sort_array(F.collect_list(F.struct("u", "size"))).alias("docs"), F.max("room").alias("room")
    )
    fits = F.expr(
        """aggregate(docs, named_struct('room', room, 'fits', array(bigint(-1))),
             (a, d) -> if(d.size <= a.room,
               named_struct('room', a.room - d.size, 'fits', concat(a.fits, array(d.u))), a))"""
    )
    return listed.withColumn("got", fits).select("source", "got.fits", F.col("got.room").alias("left"))


def _further(sizes: DataFrame, cuts: DataFrame, fits: DataFrame, radix_bits: int, cell_docs: int) -> DataFrame | None:
    """(source, u) of the places beyond the cut's cell that are drawn as well; None without any.

    Each round looks only at documents no larger than the room; rows of one place count together.
    """
    rest, taken = sizes, None
    while True:
        done = fits.select(F.col("source").alias("s"), "left")
        state = cuts.join(done, cuts["source"].eqNullSafe(F.col("s"))).where("left > 0").select(
            F.col("source").alias("s"), (F.col("cut") + F.col("wide")).alias("start"), "left"
        )
        rest = written(
            rest.join(state, rest["source"].eqNullSafe(F.col("s")))
            .where((F.col("u") >= F.col("start")) & (F.col("size") > 0) & (F.col("size") <= F.col("left")))
            .groupBy("source", "u").agg(F.sum("size").alias("size"), F.max("left").alias("left"))
            .where(F.col("size") <= F.col("left")),
            "rest",
        )
        if not rest.limit(1).count():
            return taken
        rooms = rest.groupBy("source").agg(F.max("left").alias("part"), F.count("*").alias("docs"))
        rest = rest.drop("left")
        cuts = _cuts(rest, rooms, radix_bits, cell_docs)
        fits = written(_fitting(rest, cuts), "fits")
        below = cuts.select(F.col("source").alias("s"), "cut")
        before = rest.join(below, rest["source"].eqNullSafe(F.col("s"))).where(F.col("u") < F.col("cut"))
        listed = fits.select("source", F.explode("fits").alias("u")).where("u >= 0")
        new = written(before.select("source", "u").unionByName(listed), "further")
        taken = new if taken is None else taken.unionByName(new)


def _split(slots: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source, shard, quota): the splitting tree over one slot a block to draw."""
    levels = max(0, (shards - 1).bit_length())
    node = slots.withColumn("node", F.lit(0))
    for level in range(levels):
        chance = F.xxhash64(F.lit(seed), F.lit(level), "source", F.col("source").isNull(), "slot")
        order = W.partitionBy("node").orderBy(chance, "source", "slot")
        turn = F.row_number().over(order) * 2 > F.count("*").over(W.partitionBy("node"))
        node = node.withColumn("node", F.col("node") * 2 + turn.cast("int"))
    return node.groupBy("source", F.col("node").alias("shard")).agg(F.count("*").alias("quota"))


def _blocks(quotas: DataFrame, cuts: DataFrame, further: DataFrame | None) -> DataFrame:
    """Adds ``bits`` (of a source's block numbers), ``per_pass`` and ``quota`` (blocks to draw).

    Blocks go to the sources by their documents. The partial pass takes the blocks up to the
    one in which the cut's cell ends, or the one of the last place drawn beyond it.
    """
    side = cuts.select(F.col("source").alias("s"), "cut", "wide", (F.col("cut") + F.col("wide") - 1).alias("end"))
    if further is not None:
        most = further.groupBy("source").agg(F.max("u").alias("most")).withColumnRenamed("source", "f")
        side = side.join(most, side["s"].eqNullSafe(F.col("f")), "left").select(
            "s", "cut", "wide", F.greatest("end", "most").alias("end")
        )
    per = quotas.join(side, quotas["source"].eqNullSafe(F.col("s"))).drop("s")
    total = per.agg(F.sum("docs")).first()[0] or 1
    rich = F.greatest(F.lit(1.0), F.col("docs") * F.lit(BLOCKS / total))
    last = F.expr(f"shiftright(end, {PLACE_BITS} - bits)") + 1
    return (
        per.withColumn("bits", F.floor(F.log2(rich)).cast("int"))
        .withColumn("per_pass", F.expr("shiftleft(bigint(1), bits)"))
        .withColumn("quota", F.col("per_pass") * F.col("passes") + F.when(F.col("part") > 0, last).otherwise(0))
        .drop("end")
    )


def _draws(blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source, block, pass, shard): each shard takes the next run of a source's permuted
    blocks, as long as its share of the quota."""
    slots = blocks.where("quota > 0").select(
        "source", F.explode(F.expr("sequence(bigint(0), quota - 1)")).alias("slot")
    )
    shares = _split(slots, shards, seed)
    earlier = W.partitionBy("source").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    runs = shares.withColumn("first", F.coalesce(F.sum("quota").over(earlier), F.lit(0)))
    named = blocks.select(F.col("source").alias("s"), "per_pass")
    drawn = runs.join(named, runs["source"].eqNullSafe(F.col("s"))).select(
        "source", "shard", "per_pass", F.explode(F.expr("sequence(first, first + quota - 1)")).alias("slot")
    )
    return drawn.select(
        "source", "shard", (F.col("slot") % F.col("per_pass")).alias("block"),
        F.floor(F.col("slot") / F.col("per_pass")).cast("int").alias("pass"),
    )


def plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    shards: int = SHARDS, seed: int = 7, radix_bits: int = RADIX_BITS, cell_docs: int = CELL_DOCS,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """(sizes, quotas, draws, further).

    sizes: id, source, size and place of each document. quotas: one row a source with words,
    target, passes, cut, fits and bits. draws: one row a drawn block, with pass and shard.
    """
    text = text_or_empty(text_col)
    sizes = written(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"),
            word_count(text).cast("long").alias("size"), place(F.col(id_col), text, seed).alias("u"),
        ),
        "sizes",
    )
    passes = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0).cast("long")
    quotas = written(
        targets(sizes).withColumn("passes", passes)
        .withColumn("part", F.round(F.col("target") - F.col("passes") * F.col("words")).cast("long")),
        "quotas",
    )
    cuts = _cuts(sizes, quotas, radix_bits, cell_docs)
    fits = written(_fitting(sizes, cuts), "fits")
    further = _further(sizes, cuts, fits, radix_bits, cell_docs)
    blocks = written(_blocks(quotas, cuts, further), "blocks")
    fits = fits.drop("left").withColumnRenamed("source", "f")
    full = blocks.join(fits, blocks["source"].eqNullSafe(F.col("f")), "left").drop("f")
    return sizes, written(full, "plan"), written(_draws(blocks, shards, seed), "draws"), further


def _drawn(
    rows: DataFrame, quotas: DataFrame, draws: DataFrame, further: DataFrame | None, source: str, u: str
) -> DataFrame:
    """The rows with ``__draws``: (pass, shard) of each draw that takes the row, maybe none.

    A whole pass takes all of a block; the partial pass takes places below the cut, those in
    the list that fits and the further ones.
    """
    names = quotas.select(
        F.col("source").alias("__s"), F.col("target").alias("__target"), F.col("words").alias("__words"),
        F.col("passes").alias("__passes"), F.col("cut").alias("__cut"), F.col("fits").alias("__fits"),
        F.col("bits").alias("__bits"),
    )
    blocks = draws.groupBy("source", "block").agg(
        F.collect_list(F.struct("pass", "shard")).alias("__all")
    ).select(F.col("source").alias("__t"), F.col("block").alias("__block"), "__all")
    placed = rows.join(names, rows[source].eqNullSafe(F.col("__s"))).withColumn(
        "__own", F.expr(f"shiftright(`{u}`, {PLACE_BITS} - __bits)")
    )
    met = placed.join(
        blocks, placed[source].eqNullSafe(F.col("__t")) & (F.col("__own") == F.col("__block")), "left"
    )
    if further is None:
        met = met.withColumn("__more", F.lit(False))
    else:
        more = further.select(F.col("source").alias("__f"), F.col("u").alias("__at"), F.lit(True).alias("__more"))
        met = met.join(more, met[source].eqNullSafe(F.col("__f")) & (F.col(u) == F.col("__at")), "left")
    taken = F.expr(
        f"""filter(coalesce(__all, array()), d -> d.pass < __passes or `{u}` < __cut or coalesce(__more, false)
              or array_contains(coalesce(__fits, array()), `{u}`))"""
    )
    return met.withColumn("__draws", taken)


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """One row a document: id, size, source_size, target, taken (words, repeats counted)."""
    sizes, quotas, draws, further = plan(docs, **options)
    return _drawn(sizes, quotas, draws, further, "source", "u").select(
        "id", "size", F.col("__words").alias("source_size"), F.col("__target").alias("target"),
        (F.col("size") * F.size("__draws")).alias("taken"),
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    shards: int = SHARDS, seed: int = 7,
) -> DataFrame:
    """The mix itself: every draw of a document is a row, with its columns and a shard number
    (``shard``, or with underscores before it where the table has such a column).

    Rows of a shard lie together, shuffled by a random key. Texts move once, to their shard.
    """
    _, quotas, draws, further = plan(docs, id_col, text_col, source_col, shards, seed)
    shard = free_name(docs, "shard")
    rows = packed(docs, source=F.col(source_col), u=place(F.col(id_col), text_or_empty(text_col), seed))
    met = _drawn(rows, quotas, draws, further, "source", "u").select("doc", "u", F.explode("__draws").alias("draw"))
    words = quotas.agg(F.sum("target")).first()[0] or 0
    # The place splits a shard over more tasks the more words it gets, so no task holds a whole one.
    pieces = max(8, math.ceil(words / shards / PIECE_WORDS))
    return (
        met.select("doc", "u", F.col("draw.shard").alias("to"), F.xxhash64(F.lit(seed), "u", "draw.pass").alias("turn"))
        .repartition(F.col("to"), F.col("u") % pieces).sortWithinPartitions("to", "turn")
        .select("doc.*", F.col("to").alias(shard))
    )
