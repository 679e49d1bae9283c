"""Importance resampling towards a target: hashed n-gram features, gains, top-k with Gumbel noise.

A document's features are its runs of one to ``grams`` words. Every feature falls into a bucket
by its crc32; a bucket's gain compares its share in the target texts with its share in the
corpus. A document scores the sum of its features' gains plus noise that depends on its id
alone, and the highest scores are drawn.

N-grams are interned batch by batch in an open-addressed NumPy table: the xxhash64 of an
n-gram's bytes gives its slot, an occupied slot is compared by hash, length and bytes, and what
differs goes on to the next slot, so two n-grams never share one. The table's slots hold the
bucket and the number of occurrences; every occurrence keeps its slot's number. So crc32 is
taken once an n-gram of a batch, counts are sums over slots, and a document's weight gathers the
slots' gains by its occurrences.

Counting sends at most one number a bucket from each task, over whole texts; gains (one a
bucket) are all that reaches the driver and goes back to the tasks. Scores are ranked by a range
partitioning of (score, id), never in one task. Texts are read piece by piece, cut between words
with the last words carried over, so memory does not grow with a text.

Defined results: null and empty texts have no features, weight 0, and are not drawn while fewer
than ``least_words`` words are asked for. A null id has the noise of the text ``null`` and
comes after all others. Equal scores and ids are ordered by weight and number of features; rows
that are alike in all of these may change places, which does not change the result. An empty
corpus gives an empty result; an empty target gives gains from the corpus alone.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.shared import written
from loamline.operators.rank import global_position

GRAMS, BUCKETS, SEED = 1, 10_000, 2024
LEAST_WORDS, DRAW_PERCENT = 20, 10
#: Bytes of text that are worked on at once.
SLICE_BYTES = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_BETWEEN = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_LAST_WORD = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")
# The five primes of the hash function.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


class Bytes:
    """A buffer that can be read eight bytes at a time from any place."""

    def __init__(self, data: np.ndarray):
        self.data = np.concatenate([data, np.zeros(8, np.uint8)])
        self.eights = np.ndarray((len(data) + 1,), "<u8", self.data, 0, (1,))

    def hashes(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """xxhash64 (seed 0) of each run; runs of 32 bytes and more go through the library."""
        h = _P5 + size.astype(np.uint64)
        at, left = start.copy(), size.copy()
        long = size >= 32
        left[long] = 0
        for _ in range(3):
            on = np.flatnonzero(left >= 8)
            if not len(on):
                break
            lane = _turned(self.eights[at[on]] * _P2, 31) * _P1
            h[on] = _turned(h[on] ^ lane, 27) * _P1 + _P4
            at[on] += 8
            left[on] -= 8
        on = np.flatnonzero(left >= 4)
        lane = self.eights[at[on]] & np.uint64(0xFFFFFFFF)
        h[on] = _turned(h[on] ^ (lane * _P1), 23) * _P2 + _P3
        at[on] += 4
        left[on] -= 4
        for _ in range(3):
            on = np.flatnonzero(left > 0)
            h[on] = _turned(h[on] ^ (self.data[at[on]].astype(np.uint64) * _P5), 11) * _P1
            at[on] += 1
            left[on] -= 1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        h ^= h >> np.uint64(32)
        for i in np.flatnonzero(long).tolist():
            h[i] = xxhash.xxh64_intdigest(memoryview(self.data)[start[i] : start[i] + size[i]])
        return h

    def equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the runs at a and b, of one size, hold the same bytes."""
        same = np.ones(len(a), bool)
        on, done = np.arange(len(a)), 0
        while len(on):
            left = np.minimum(size[on] - done, 8).astype(np.uint64)
            # Bytes past the run are shifted out.
            out = (np.uint64(8) - left) * np.uint64(8)
            alike = (self.eights[a[on] + done] ^ self.eights[b[on] + done]) << out == 0
            same[on[~alike]] = False
            done += 8
            on = on[alike & (size[on] > done)]
        return same


class Interned:
    """Open-addressed table of a batch's n-grams, given as runs of one buffer."""

    def __init__(self, text: Bytes, start: np.ndarray, size: np.ndarray, keys: np.ndarray | None = None):
        keys = text.hashes(start, size) if keys is None else keys
        room = 1 << max(4, (2 * len(start)).bit_length())
        #: The first occurrence held by each slot, -1 where it is free.
        self.first = np.full(room, -1, np.int64)
        #: Slot of each occurrence.
        self.slot = np.zeros(len(start), np.int64)
        last = np.uint64(room - 1)
        waiting, spot = np.arange(len(start)), (keys & last).astype(np.int64)
        while len(waiting):
            free = self.first[spot] < 0
            self.first[spot[free]] = waiting[free]
            held = self.first[spot]
            same = held == waiting
            check = np.flatnonzero(~same & (keys[held] == keys[waiting]) & (size[held] == size[waiting]))
            same[check] = text.equal(start[held[check]], start[waiting[check]], size[held[check]])
            self.slot[waiting[same]] = spot[same]
            waiting, spot = waiting[~same], (spot[~same] + 1) & (room - 1)
        self.used = np.flatnonzero(self.first >= 0)
        holders = self.first[self.used]
        whole = memoryview(text.data)
        self.crc = np.array(
            [zlib.crc32(whole[s:e]) for s, e in zip(start[holders].tolist(), (start[holders] + size[holders]).tolist())],
            np.int64,
        )

    def slots(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and number of occurrences of each slot; free slots have neither."""
        bucket = np.zeros(len(self.first), np.int64)
        bucket[self.used] = self.crc % buckets
        return bucket, np.bincount(self.slot, minlength=len(self.first))


def pieces(texts: list[bytes], carried: int, limit: int = SLICE_BYTES) -> Iterator[list[tuple[int, bytes, int]]]:
    """Lists of (text number, bytes, words carried over) of about ``limit`` bytes.

    A longer text is cut between words; a piece repeats the last ``carried`` words before it.
    """
    held, size = [], 0
    for number, text in enumerate(texts):
        at, before = 0, []
        while True:
            cut = _BETWEEN.search(text, at + limit) if len(text) - at > limit else None
            stop = cut.end() if cut else len(text)
            body = b" ".join([*before, text[at:stop]]) if before else text[at:stop]
            if held and size + len(body) > limit:
                yield held
                held, size = [], 0
            held.append((number, body, len(before)))
            size += len(body)
            if stop == len(text):
                break
            if carried:
                # The last words stand in the tail; a tail that holds too few is widened.
                back = 64 * carried
                while len(found := _LAST_WORD.findall(body, max(0, len(body) - back))) <= carried and back < len(body):
                    back *= 4
                before = found[-carried:]
            at = stop
    if held:
        yield held


def _features(held: list[tuple[int, bytes, int]], grams: int) -> tuple[Interned, np.ndarray, np.ndarray]:
    """Interned n-grams of the pieces, the piece of each occurrence, and words a piece."""
    data = np.frombuffer(b"\n".join(body for _, body, _ in held) + b"\n", np.uint8)
    sign = _WORD[data]
    after = np.concatenate([[False], sign[:-1]])
    # Words as they are, with one blank after each.
    keep = sign | after
    text = Bytes(np.where(sign, _LOWER[data], np.uint8(32))[keep])
    first = np.flatnonzero((sign & ~after))
    place = np.cumsum(keep) - 1
    start = place[first]
    stop = place[np.flatnonzero(~sign & after)]
    ends = np.cumsum([len(body) + 1 for _, body, _ in held])
    piece = np.searchsorted(ends, first, side="right")
    words = np.bincount(piece, minlength=len(held))
    skip = np.array([carried for *_, carried in held])
    rank = np.arange(len(first)) - (np.cumsum(words) - words)[piece]
    starts, sizes, owners = [], [], []
    for n in range(1, grams + 1):
        last = np.arange(n - 1, len(first))
        # Inside one piece, and not counted in the piece before.
        last = last[(rank[last] >= n - 1) & (rank[last] >= skip[piece[last]])]
        starts.append(start[last - n + 1])
        sizes.append(stop[last] - start[last - n + 1])
        owners.append(piece[last])
    return Interned(text, np.concatenate(starts), np.concatenate(sizes)), np.concatenate(owners), words - skip


def _bytes(column: pa.Array) -> list[bytes]:
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def bucket_counts(texts: DataFrame, text_col: str = "text", grams: int = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences of features in each bucket, over the whole texts of all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for held in pieces(_bytes(batch.column(0)), grams - 1):
                table, _, _ = _features(held, grams)
                bucket, times = table.slots(buckets)
                np.add.at(total, bucket[table.used], times[table.used])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    rows = texts.select(F.col(text_col)).toDF("text").mapInArrow(count, "bucket long, n long")
    total = np.zeros(buckets, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row a bucket
        total[row["bucket"]] = row["n"]
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths of a nat, add-one smoothed, floored."""
    s_all, t_all = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(corpus.tolist(), target.tolist())],
        np.int64,
    )


def weights(
    docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", grams: int = GRAMS
) -> DataFrame:
    """(id, n_words, n_features, weight) of each document; weight sums its features' gains."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros((3, batch.num_rows), np.int64)
            for held in pieces(_bytes(batch.column(1)), grams - 1):
                table, owner, words = _features(held, grams)
                of_slot = gain[table.slots(len(gain))[0]]
                number = np.array([n for n, *_ in held])
                np.add.at(found[0], number, words)
                np.add.at(found[1], number, np.bincount(owner, minlength=len(held)))
                sums = np.zeros(len(held), np.int64)
                np.add.at(sums, owner, of_slot[table.slot])
                np.add.at(found[2], number, sums)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, found)], names=["id", "n_words", "n_features", "weight"]
            )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).toDF("id", "text").mapInArrow(
        weigh, "id long, n_words long, n_features long, weight long"
    )


def noise(id_col: str = "id", seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the id alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resampled(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    grams: int = GRAMS, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
    draw_percent: int = DRAW_PERCENT, seed: int = SEED,
) -> DataFrame:
    """One row a document: id, n_words, n_features, weight, score, rank (null if not drawn)."""
    gain = gains(bucket_counts(docs, text_col, grams, buckets), bucket_counts(target, target_col, grams, buckets))
    scored = written(
        weights(docs, gain, id_col, text_col, grams).withColumn("score", F.col("weight") + noise("id", seed)), "scores"
    )
    able = scored.where(F.col("n_words") >= least_words)
    drawn = draw_percent * able.count() // 100
    order = [F.desc("score"), F.asc_nulls_last("id"), F.desc("weight"), F.desc("n_features")]
    place = F.col("place") + 1
    ranked = global_position(able, order, "place").withColumn("rank", F.when(place <= drawn, place)).drop("place")
    others = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others)
