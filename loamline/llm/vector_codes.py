"""Product codes of vectors: integer codebooks, nearest entries found by Orchard's search.

Each component x becomes floor(256 x); a vector is cut into equal consecutive parts, and each
part position has a codebook of its own. A round of training assigns every part to its nearest
entry and moves each entry to the floored mean of its parts.

Orchard's search keeps, for every entry, all entries in the order of their distance from it.
A part starts at some entry and walks that entry's list. When an entry of the list is nearer to
the part, the walk jumps to that entry's list; entries met before are marked and skipped. The
walk ends where the list goes beyond twice the distance to the best entry: by the triangle
inequality nothing after it can be as near, so the result is exact, ties included. All parts of
a batch walk side by side.

Training moves only sums by entry between tasks, so each task sends at most (parts x entries x
components of a part) numbers whatever its rows; the codebooks, of the same size, are all that
passes the driver. Assignments are made anew in each round from the vectors themselves, so
nothing is cached and a lost executor costs its tasks alone.

Defined results: rows whose vector is null, empty or holds a null or non-finite component are
dropped, as are vectors of another length than that of the smallest id. Lengths that the number
of parts does not divide are filled up with zeros. Integers beyond +-2^24 count as that bound.
Null ids come last; rows with one id are ordered by their vectors. With fewer vectors than
entries the codebooks are shorter; an empty table has empty codebooks and no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamline.llm.shared import written

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256.0
#: Bound of the integers, so that squared distances stay exact in 64 bits.
MOST = 2**24
#: Numbers of a batch that are worked on at once.
SLICE_CELLS = 1 << 20


def usable(vectors: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector has components, all of them finite numbers."""
    # A NaN is above every number, and a null component makes the condition null.
    finite = F.forall(vector_col, lambda x: (x > float("-inf")) & (x < float("inf")))
    return vectors.where((F.size(vector_col) > 0) & finite)


def integers(column: pa.Array, parts: int) -> np.ndarray:
    """(rows, parts, components of a part) of a list column whose lists are equally long."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.clip(np.floor(SCALE * flat), -MOST, MOST).astype(np.int64).reshape(len(column), -1)
    width = -(-whole.shape[1] // parts)
    return np.pad(whole, ((0, 0), (0, width * parts - whole.shape[1]))).reshape(len(column), parts, width)


def _squares(difference: np.ndarray) -> np.ndarray:
    return (difference * difference).sum(axis=-1)


class Orchard:
    """Nearest entry of one codebook, by neighbour lists sorted by distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        between = _squares(entries[:, None, :] - entries[None, :, :])
        self.order = np.argsort(between, axis=1, kind="stable")
        # The last place ends every walk.
        self.beyond = np.pad(
            np.take_along_axis(between, self.order, axis=1), ((0, 0), (0, 1)), constant_values=np.iinfo(np.int64).max
        )
        #: A walk starts at the entry next in the first component.
        self.by_first = np.argsort(entries[:, 0], kind="stable")
        self.firsts = entries[self.by_first, 0]

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, ties to the lower index, and the squared distance."""
        spot = np.searchsorted(self.firsts, rows[:, 0]).clip(0, len(self.entries) - 1)
        best = self.by_first[spot]
        near = _squares(rows - self.entries[best])
        met = np.zeros((len(rows), len(self.entries)), bool)
        met[np.arange(len(rows)), best] = True
        place = np.zeros(len(rows), np.int64)
        live = np.arange(len(rows))
        while True:
            # Distances are squared: beyond twice the distance is beyond four times the square.
            live = live[self.beyond[best[live], place[live]] <= 4 * near[live]]
            if not len(live):
                return best, near
            other = self.order[best[live], place[live]]
            place[live] += 1
            new = ~met[live, other]
            row, other = live[new], other[new]
            met[row, other] = True
            far = _squares(rows[row] - self.entries[other])
            better = (far < near[row]) | ((far == near[row]) & (other < best[row]))
            row = row[better]
            best[row], near[row], place[row] = other[better], far[better], 0


def _slices(column: pa.Array, parts: int) -> Iterator[np.ndarray]:
    longest = len(column.flatten()) // max(1, len(column))
    step = max(1, SLICE_CELLS // max(1, longest))
    for at in range(0, len(column), step):
        yield integers(column.slice(at, step), parts)


def _first_codebooks(rows: DataFrame, order: list, parts: int, entries: int) -> tuple[int, np.ndarray]:
    """Length of the vectors, and (parts, entries, components) of the smallest ids."""
    first = rows.orderBy(*order).limit(1).collect()
    if not first:
        return 0, np.zeros((parts, 0, 0), np.int64)
    length = len(first[0]["vector"])
    start = rows.where(F.size("vector") == length).orderBy(*order).limit(entries).collect()
    found = integers(pa.array([r["vector"] for r in start], pa.list_(pa.float64())), parts)
    return length, found.transpose(1, 0, 2).copy()


def _moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after a round: floored means; entries without parts stay."""
    parts, entries, width = books.shape
    cells = width + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Orchard(b) for b in books]
        total = np.zeros((parts, entries, cells), np.int64)
        for batch in batches:
            for whole in _slices(batch.column(0), parts):
                for part, search in enumerate(searches):
                    best, _ = search.nearest(whole[:, part])
                    total[part, :, 0] += np.bincount(best, minlength=entries)
                    np.add.at(total[part, :, 1:], best, whole[:, part])
        flat = total.reshape(-1)
        used = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(flat[used])], names=["cell", "amount"])

    summed = rows.select("vector").mapInArrow(sums, "cell long, amount long").groupBy("cell").agg(
        F.sum("amount").alias("amount")
    )
    total = np.zeros(parts * entries * cells, np.int64)
    for row in summed.collect():  # at most a number for each component of an entry
        total[row["cell"]] = row["amount"]
    total = total.reshape(parts, entries, cells)
    count = total[:, :, :1]
    return np.where(count > 0, total[:, :, 1:] // np.maximum(count, 1), books)


def train(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[int, np.ndarray]:
    """Length of the vectors, and codebooks (parts, entries, components)."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte a part")
    rows = usable(vectors, vector_col).select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    length, books = _first_codebooks(rows, [F.asc_nulls_last("id"), F.asc("vector")], parts, entries)
    for _ in range(rounds if length else 0):
        books = _moved(rows.where(F.size("vector") == length), books)
    return length, books


def encode(
    vectors: DataFrame, length: int, books: np.ndarray, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(id, label, code, error): code in hex by part, error the summed squared distance."""
    kinds = [vectors.schema[id_col].dataType, vectors.schema[label_col].dataType, T.StringType(), T.LongType()]
    out = T.StructType([T.StructField(n, k) for n, k in zip(("id", "label", "code", "error"), kinds)])
    rows = usable(vectors, vector_col).where(F.size(vector_col) == length)
    parts = len(books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Orchard(b) for b in books] if length else []
        for batch in batches:
            codes, errors = [], []
            for whole in _slices(batch.column(2), parts):
                found = [search.nearest(whole[:, part]) for part, search in enumerate(searches)]
                digits = np.stack([best for best, _ in found], axis=1).astype(np.uint8).tobytes().hex()
                codes += [digits[at : at + 2 * parts] for at in range(0, len(digits), 2 * parts)]
                errors.append(sum(near for _, near in found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()),
                 pa.array(np.concatenate(errors) if errors else [], pa.int64())],
                names=["id", "label", "code", "error"],
            )

    return rows.select(F.col(id_col), F.col(label_col), F.col(vector_col)).toDF("id", "label", "vector").mapInArrow(assign, out)


def decode(codes: list[str], books: np.ndarray) -> np.ndarray:
    """The vectors that codes stand for, in components of the integers' scale."""
    digits = np.frombuffer(bytes.fromhex("".join(codes)), np.uint8).reshape(-1, len(books))
    return np.concatenate([book[digits[:, part]] for part, book in enumerate(books)], axis=1) / SCALE


def digest(books: np.ndarray) -> str:
    """Hash of all entries' components by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compressed(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **sizes: int
) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) of each kept vector."""
    length, books = train(vectors, id_col, vector_col, **sizes)
    coded = written(encode(vectors, length, books, id_col, vector_col, label_col), "codes")
    # One row a label and task leaves each task; the joined side is as narrow.
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).drop("of").withColumn(
        "codebooks_sha256", F.lit(digest(books))
    )
