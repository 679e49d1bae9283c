"""Near-duplicate groups by MinHash, banding, verification and star-contracted components.

1. A document's set holds the hashes of its distinct five-word shingles. Documents with one
   and the same set are folded into one node at once, by grouping on the set's digest.
2. Each node gets ``HASHES`` minima of universal hash functions a x + b (mod 2^64). Runs of
   ``ROWS`` of the first ``BANDED`` minima make band keys; a pair at the threshold shares no
   band with a probability under 1e-4 at 0.8, 1e-6 at 0.85. The others sharpen the signature.
3. Nodes of a bucket are held against the bucket's first node only. A pair goes on if its
   sizes and signatures allow the threshold (the bound is more than four standard
   deviations below it), and becomes a link if the full sets confirm it.
4. Alternating large-star and small-star rounds contract the links to components.
5. What a bucket's first node did not settle: nodes of a bucket that are still in different
   components are held against each other, block by block inside a task. The likeliest
   partners are confirmed first and components contracted again; the last round takes all
   pairs that still lie in different components. Pairs inside a component are never formed.

Texts meet only for pairs that passed the signatures. Null or blank texts have no set, link
with nothing and are kept. Rows are told apart by a number of their own, so repeated and null
ids are allowed; the component id is the smallest id in the component (null if it has none).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.shared import packed, text_or_empty, unpacked, written
from loamline.llm.token_store import slices

SHINGLE = 5
HASHES, BANDED, ROWS = 384, 192, 6
#: A pair is confirmed on the full sets if its share of equal minima is at most so much under
#: the threshold, four to five standard deviations.
SLACK = 0.085
THRESHOLD = 85
#: Rows of a bucket that are held against each other at once, and the partners a node tries in
#: each round before the last.
BLOCK = 500
NEAREST = (2,)

_rng = np.random.Generator(np.random.PCG64(20_240_607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _rng.integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_A = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(1, 2**63, HASHES, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = _BYTE[_LOWER]
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
#: Bytes that are hashed at once, and characters of a list of texts.
CHUNK = 1 << 18
SLICE = 200_000


def _powers(base: int) -> np.ndarray:
    """Powers of an odd base modulo 2^64."""
    step = np.full(CHUNK + 1, base, np.uint64)
    step[0] = 1
    return np.cumprod(step, dtype=np.uint64)


_POWER, _INVERSE = _powers(_BASE), _powers(pow(_BASE, -1, 2**64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and hash of every word of the bytes; A-Z count as a-z.

    Words are hashed by differences of running sums over a chunk of bytes at a time; a word
    that a chunk's end cuts is carried on, so memory is bounded by the number of words.
    """
    places, sums, sizes = [], [], []
    held = None  # place, sum and size of a word that goes on
    for at in range(0, len(data), CHUNK):
        piece = data[at : at + CHUNK]
        sign = ~_BLANK[piece]
        run = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(np.where(sign, _VALUE[piece] * _POWER[: len(piece)], np.uint64(0)), out=run[1:])
        first = np.flatnonzero(sign & ~np.concatenate([[False], sign[:-1]]))
        last = np.flatnonzero(sign & ~np.concatenate([sign[1:], [False]])) + 1
        total, size = (run[last] - run[first]) * _INVERSE[first], last - first
        place = first + at
        if held is not None:
            if len(first) and first[0] == 0:
                total[0] = np.uint64((held[1] + int(total[0]) * pow(_BASE, held[2], 2**64)) % 2**64)
                size[0] += held[2]
                place[0] = held[0]
            else:
                places.append(np.array([held[0]]))
                sums.append(np.array([held[1]], np.uint64))
                sizes.append(np.array([held[2]]))
            held = None
        if len(last) and last[-1] == len(piece):
            held = int(place[-1]), int(total[-1]), int(size[-1])
            place, total, size = place[:-1], total[:-1], size[:-1]
        places.append(place)
        sums.append(total)
        sizes.append(size)
    if held is not None:
        places.append(np.array([held[0]]))
        sums.append(np.array([held[1]], np.uint64))
        sizes.append(np.array([held[2]]))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(places), _mixed(np.concatenate(sums) + np.concatenate(sizes).astype(np.uint64))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; A-Z count as a-z."""
    bodies = [t.encode() for t in texts]
    data = np.frombuffer(b" ".join(bodies) + b" ", np.uint8)
    ends = np.cumsum([len(b) + 1 for b in bodies])
    first, words = word_hashes(data)
    starts = np.searchsorted(first, np.concatenate([[0], ends[:-1]]))
    stops = np.searchsorted(first, ends)
    wide = len(words) - SHINGLE + 1
    if wide > 0:
        rolled = words[:wide] * _PLACE[0]
        for k in range(1, SHINGLE):
            rolled += words[k : k + wide] * _PLACE[k]
        rolled = _mixed(rolled)
    out = []
    for start, stop in zip(starts.tolist(), stops.tolist()):
        if stop - start >= SHINGLE:
            out.append(np.unique(rolled[start : stop - SHINGLE + 1]))
        elif stop > start:
            whole = (words[start:stop] * _PLACE[: stop - start]).sum(keepdims=True) + np.uint64(stop - start)
            out.append(_mixed(whole))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minima(hashes: np.ndarray) -> np.ndarray:
    best = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 128):
        block = _A[:, None] * hashes[None, at : at + 128] + _B[:, None]
        np.minimum(best, block.min(axis=1), out=best)
    return best


def band_keys(mins: np.ndarray) -> np.ndarray:
    """One 64-bit key a band, for rows of minima."""
    bands = mins[:, :BANDED].reshape(len(mins), BANDED // ROWS, ROWS)
    keys = np.broadcast_to(_A[: BANDED // ROWS], bands.shape[:2]).copy()
    for k in range(ROWS):
        keys = _mixed(keys + bands[:, :, k])
    return keys.view(np.int64)


_SIGNED = "id long, text_key string, n long, set_key binary, bands array<long>, sketch binary"


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column(2).to_pylist()
        at = 0
        for ids, texts in slices(iter([batch]), SLICE):
            sets = shingle_sets(texts)
            mins = np.stack([minima(s) for s in sets])
            bands = band_keys(mins)
            flat = pa.array(bands.reshape(-1))
            offsets = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * bands.shape[1])
            low = np.ascontiguousarray(mins.astype(np.uint8))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(keys[at : at + len(ids)], pa.string()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(offsets, flat), pa.array([r.tobytes() for r in low], pa.binary()),
                ],
                names=["id", "text_key", "n", "set_key", "bands", "sketch"],
            )
            at += len(ids)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a document with its number ``row``, set size, set key, band keys and sketch."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("body"), F.md5(text).alias("text_key"))
    return written(
        rows.mapInArrow(_signed, _SIGNED).withColumn("row", F.monotonically_increasing_id()), "signatures"
    )


def _sizes_allow(a: str, b: str, threshold: int) -> F.Column:
    return 100 * F.least(a, b) >= threshold * F.greatest(a, b)


def _least_agreeing(threshold: int) -> float:
    return (threshold / 100 - SLACK) * HASHES


def _sketches_allow(pairs: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) whose sketches allow the threshold."""
    least = _least_agreeing(threshold)

    def compare(batches):
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, HASHES) for i in (2, 3)
            )
            enough = (left == right).sum(axis=1) >= least
            keep = pa.array(enough)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    left = nodes.select(F.col("row").alias("a"), F.col("sketch").alias("left"))
    right = nodes.select(F.col("row").alias("b"), F.col("sketch").alias("right"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return joined.mapInArrow(compare, "a long, b long")


def _texts(docs: DataFrame, signed: DataFrame, shared: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, body) of the nodes that share a bucket.

    A text is fetched by its digest and the id of one document that has it, so that the copies
    of a text do not meet anywhere; rows alike in both are read as one."""
    rows = shared.select("row").distinct()
    wanted = written(signed.join(rows, "row", "left_semi").select("row", "text_key", "id"), "wanted")
    name = F.concat_ws(":", "text_key", F.col("id").cast("string"))
    keys = written(wanted.groupBy("text_key").agg(F.min_by("id", "row").alias("id")).select("text_key", name.alias("name")), "keys")
    text = text_or_empty(text_col)
    found = docs.select(F.col(id_col).cast("long").alias("id"), F.md5(text).alias("text_key"), text.alias("body")).select(
        name.alias("name"), "body"
    )
    # Merged at any size, so that the cost grows with the input alone.
    once = found.join(keys.select("name").hint("merge"), "name", "left_semi").dropDuplicates(["name"])
    named = wanted.join(keys, "text_key").select("row", "name")
    return written(named.join(once, "name").select("row", "body"), "texts")


def _confirmed(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold.

    Rows come in the order of ``b``, so the set of a node that many others are held against
    is made once.
    """

    def confirm(batches):
        known, known_set = None, None
        for batch in batches:
            keep, new = [], []
            lefts, rights = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(lefts), 256):
                span = range(at, min(at + 256, len(lefts)))
                sets = shingle_sets([batch.column(2)[i].as_py() for i in span])
                for i, one in zip(span, sets):
                    if rights[i] != known:
                        known, known_set = rights[i], shingle_sets([batch.column(3)[i].as_py()])[0]
                    both = len(np.intersect1d(one, known_set, assume_unique=True))
                    if 100 * both >= threshold * (len(one) + len(known_set) - both):
                        keep.append(lefts[i])
                        new.append(rights[i])
            yield pa.RecordBatch.from_arrays([pa.array(keep, pa.int64()), pa.array(new, pa.int64())], names=["a", "b"])

    left = texts.select(F.col("row").alias("a"), F.col("body").alias("left"))
    right = texts.select(F.col("row").alias("b"), F.col("body").alias("right"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return met.mapInArrow(confirm, "a long, b long")


def links(likely: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """The pairs that full sets confirm."""
    return written(_confirmed(written(likely, "likely"), texts, threshold), "links")


def components(edges: DataFrame) -> DataFrame:
    """(row, root) of every node with a link, root being the least node of its component.

    Alternates large-star and small-star; every round is a grouping and a join on the node,
    and ends when a round changes nothing.
    """
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "star")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = written(
            both.where("v > u").join(written(least, "least"), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "star",
        )
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        hung = large.join(least, "u")
        small = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        now = written(small.distinct(), "star")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.select(F.col("u").alias("row"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("row"), F.col("v").alias("root")).distinct()
            )
        mark = seen


def grouped(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD
) -> DataFrame:
    """One row a document: id, n_shingles, component_id, kept, text_key (md5 of the text), row.

    Exactly one row of a component is kept: the first with its smallest id.
    """
    signed = signatures(docs, id_col, text_col)
    sets = written(
        signed.where("n > 0").groupBy("set_key", "n").agg(F.min("row").alias("node"), F.count("*").alias("copies")),
        "sets",
    )
    nodes = written(
        signed.join(sets.select(F.col("node").alias("row")), "row", "left_semi").select("row", "n", "text_key", "bands", "sketch"),
        "nodes",
    )
    members = nodes.select("row", "n", F.explode("bands").alias("bucket"))
    firsts = written(
        members.groupBy("bucket").agg(F.min("row").alias("first"), F.min_by("n", "row").alias("first_n"), F.count("*").alias("held"))
        .where("held > 1").select("bucket", "first", "first_n"),
        "buckets",
    )
    shared = written(members.join(firsts, "bucket"), "members")
    pairs = shared.where((F.col("row") != F.col("first")) & _sizes_allow("n", "first_n", threshold)).select(
        F.col("row").alias("a"), F.col("first").alias("b")
    ).distinct()
    texts = _texts(docs, signed, shared, id_col, text_col)
    found = links(_sketches_allow(pairs, nodes, threshold), texts, threshold)
    roots = written(components(found), "roots")
    # The likeliest partners first: they join most of a large group, whose other pairs are
    # then never formed. The last round leaves out nothing.
    for most in (*NEAREST, None):
        found = found.unionByName(links(_unsettled(shared, roots, nodes, threshold, most), texts, threshold))
        roots = written(components(found), "roots")

    # A set's node stands for all its documents; the hot sides are narrow and splittable.
    rooted = written(
        sets.join(roots.withColumnRenamed("row", "node"), "node", "left")
        .select("set_key", "n", F.coalesce("root", "node").alias("root")),
        "rooted",
    )
    placed = written(
        signed.select("id", "row", "n", "set_key", "text_key").join(rooted, ["set_key", "n"], "left")
        .select("id", "row", "n", "text_key", F.coalesce("root", "row").alias("root")),
        "placed",
    )
    best = written(placed.groupBy("root").agg(F.min("id").alias("component_id")), "best")
    first = placed.join(best, "root").where(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min("row").alias("keep_row")
    )
    named = written(best.join(first, "root"), "named")
    return placed.join(named, "root").select(
        "id", F.col("n").alias("n_shingles"), "component_id", (F.col("row") == F.col("keep_row")).alias("kept"),
        "text_key", "row",
    )


def _unsettled(
    shared: DataFrame, roots: DataFrame, nodes: DataFrame, threshold: int, most: int | None = None
) -> DataFrame:
    """Pairs of a bucket in different components, none of them the bucket's first node, that
    sizes and sketches allow; with ``most``, only so many likeliest partners of a node.

    A bucket with strays (nodes outside its first node's component) is cut into blocks of
    about ``BLOCK`` rows; each pair of blocks is one group, held against each other as
    arrays, so only the pairs that pass are ever rows, each from the first band it shares.
    (Where one of the two is the first node of that band's bucket, the pair has been tried.)
    """
    of = roots.select("row", "root")
    rooted = shared.where("row <> first").join(of, "row", "left").withColumn("root", F.coalesce("root", "row"))
    firsts = of.select(F.col("row").alias("first"), F.col("root").alias("first_root"))
    rooted = rooted.join(firsts, "first", "left").withColumn(
        "stray", F.col("root") != F.coalesce("first_root", "first")
    )
    rooted = written(rooted.select("bucket", "row", "n", "root", "stray"), "rooted")
    # Pairs need two nodes beside the first, one of them a stray.
    open_buckets = written(
        rooted.groupBy("bucket").agg(F.count("*").alias("held"), F.max("stray").alias("strays"))
        .where("held > 1 and strays")
        .select("bucket", F.ceil(F.col("held") / BLOCK).cast("int").alias("blocks")),
        "open",
    )
    own = F.pmod(F.xxhash64("row", "bucket"), F.col("blocks")).cast("int")
    dealt = (
        rooted.join(open_buckets, "bucket").withColumn("own", own)
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select(
            "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            "own", "row", "n", "root", "stray",
        )
        .join(nodes.select("row", "sketch", "bands"), "row")
    )
    least = _least_agreeing(threshold)

    def compare(rows: list[pa.Table]) -> tuple[np.ndarray, np.ndarray]:
        table = pa.concat_tables(rows).combine_chunks()
        own, row, n, root, stray = (table.column(c).to_numpy() for c in ("own", "row", "n", "root", "stray"))
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, HASHES)
        bands = np.stack(table.column("bands").to_numpy())
        bucket, low, high = (table.column(c)[0].as_py() for c in ("bucket", "low", "high"))
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        found_a, found_b = [], []
        for i in left.tolist():
            j = right if low != high else right[row[right] < row[i]]
            fits = (root[j] != root[i]) & (stray[i] | stray[j])
            fits &= 100 * np.minimum(n[j], n[i]) >= threshold * np.maximum(n[j], n[i])
            j = j[fits]
            agree = (sketch[j] == sketch[i]).sum(axis=1)
            enough = agree >= least
            j, agree = j[enough], agree[enough]
            # In the first band the two share, which need not be this one's.
            common = bands[j] == bands[i]
            here = bands[i, common.argmax(axis=1)] == bucket
            j, agree = j[here], agree[here]
            if most and len(j) > most:
                j = j[np.argpartition(-agree, most)[:most]]
            found_a += [row[i]] * len(j)
            found_b += row[j].tolist()
        return np.array(found_a, np.int64), np.array(found_b, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group = [], None

        def done():
            a, b = compare(held)
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if start == stop:
                    continue
                key = tuple(keys[:, start].tolist())
                if group is not None and key != group:
                    yield done()
                    held.clear()
                group = key
                held.append(pa.Table.from_batches([batch.slice(start, stop - start)]))
        if held:
            yield done()

    grouped_rows = dealt.select("bucket", "low", "high", "own", "row", "n", "root", "stray", "sketch", "bands").repartition(
        "bucket", "low", "high"
    ).sortWithinPartitions("bucket", "low", "high")
    return grouped_rows.mapInArrow(run, "a long, b long").distinct()


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One document of each component, with all its columns.

    Decisions meet the rows by (id, text); repeated equal rows that stay lose all but one.
    """
    rows = grouped(docs, id_col, text_col, threshold)
    stays = written(
        rows.groupBy("id", "text_key").agg(F.sum(F.col("kept").cast("long")).alias("stay"), F.count("*").alias("held"))
        .where("stay > 0").select("id", "text_key", (F.col("stay") < F.col("held")).alias("again")),
        "stays",
    )
    marked = packed(docs, id=F.col(id_col).cast("long"), key=F.md5(text_or_empty(text_col)))
    side = stays.select(F.col("id").alias("kept_id"), F.col("text_key").alias("kept_key"), "again")
    on = marked["id"].eqNullSafe(side["kept_id"]) & (marked["key"] == side["kept_key"])
    met = marked.join(side, on).drop("kept_id", "kept_key")
    again = met.where("again").dropDuplicates(["id", "key"]).select("doc")
    return unpacked(met.where("not again").select("doc").unionByName(again))
