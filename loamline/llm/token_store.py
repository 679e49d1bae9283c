"""Token ids in directly addressable codes.

A file holds the ids of consecutive documents. Each id is cut into chunks of ``CHUNK_BITS``
bits, lowest first. Level k stores the k-th chunk of every id that has one, and a bitmap that
says which of them go on to level k + 1. A rank directory (ones before each run of
``RANK_BITS`` bits) gives the place on the next level, so the id at any position is found
by a few reads of a byte and of one bitmap run, without decoding a block.

Layout, all little endian:

    magic 8 bytes | header length uint32 | header JSON | doc ids int64 | doc flags uint8
    | doc ends int64 (ids up to the document's end) | for each level: chunks, bitmap, ranks

The header names the byte offset and length of every part. ``doc flags`` is 1 for a null id.

Documents are range-partitioned by id and sorted inside each partition; a task encodes its
documents and writes files of bounded size. Null texts are empty and hold the end id only.
Null ids come first; rows with equal ids are ordered by a hash of their texts.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.shared import Remembered, dealt, filesystem, new_file, scratch_uri, text_or_empty, written
from loamline.operators.rank import running_total

MAGIC = b"DACTOK01"
CHUNK_BITS = 8
RANK_BITS = 512
#: Ids after which a file is closed (at a document's end), code points taken from a batch at once,
#: and those encoded at once.
FILE_IDS = 6_000_000
SLICE_CHARS = 1_000_000
ENCODED_CHARS = 2_000_000
#: Encoded pieces that a Python worker remembers.
CACHED_PIECES = 450_000
LONG_PIECE = 64
#: Pieces that the tokenizer gets in one go, so that what it holds meanwhile stays small.
JOINED = 16_000

# A blank may be a cut if a sign other than white space stands before it: pre-tokenization
# then begins anew at the blank, whatever comes before.
_PLAIN = "!-~¡-ᙿ"
_CUT = f"([{_PLAIN}]) "
# So may a line feed between two such signs, and a comma or full stop behind a letter or digit
# and before white space: each is a pre-token of its own. What follows such a cut is marked,
# since no blank stands before it.
_MARK = "\x01"
_LETTER = "0-9A-Za-zªµºÀ-ÖØ-öø-ʯ"
_WHOLE = f"[^{_PLAIN}][ \n]|\n[^{_PLAIN}]|[^{_LETTER}][.,][ \n]"
# Stands for the blank of a cut where other blanks are kept. A text with one of the two signs
# of its own is one piece.
_SPLIT = "\x02"
_OWN = f"[{_MARK}{_SPLIT}]"
_STARTS = frozenset(map(chr, [*range(0x21, 0x7F), *range(0xA1, 0x1680)]))


class Encoder:
    """Ids of whole texts as the tokenizer gives them, with equal pieces encoded once."""

    def __init__(self, path: str):
        # A task has one core.
        os.environ.update(TOKENIZERS_PARALLELISM="false", RAYON_NUM_THREADS="1")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        blank = self.tokenizer.encode(" ", add_special_tokens=False).tokens[0]
        #: Whether a token's text begins with a blank.
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith(blank) for i in range(size)])
        self.tails = Remembered(self._after_blank, CACHED_PIECES, LONG_PIECE)

    def _alone(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _after_blank(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece behind a blank, or, where it is marked, of the piece alone."""
        plain = [p for p in pieces if p[:1] in _STARTS and " " not in p]
        known: dict[str, bytes] = {}
        for start in range(0, len(plain), JOINED):
            some = plain[start : start + JOINED]
            known.update(zip(some, self._behind_blank(some)))
        marked = [p for p in pieces if p[:1] == _MARK]
        known.update(zip(marked, self._alone([p[1:] for p in marked])))
        rest = [p for p in pieces if p not in known]
        known.update(zip(rest, self._alone([" " + p for p in rest])))
        return list(map(known.__getitem__, pieces))

    def _behind_blank(self, plain: list[str]) -> list[bytes]:
        """Pieces without a blank of their own are encoded in one go: each of them begins with
        the only token that opens with a blank."""
        joined = self.tokenizer.encode_batch_fast([" " + " ".join(plain)], add_special_tokens=False)[0]
        ids = np.array(joined.ids, "<u4")
        starts = np.flatnonzero(self.opens[ids]).tolist()
        if len(starts) != len(plain):
            return self._alone([" " + p for p in plain])
        body, ends = ids.tobytes(), [*starts[1:], len(ids)]
        return [body[4 * s : 4 * e] for s, e in zip(starts, ends)]

    @staticmethod
    def _cut(texts: pa.Array) -> tuple[pa.ListArray, np.ndarray]:
        """Lists of pieces, and the place of each list's text. The first piece of a text is
        marked too, since no blank stands before it."""
        own = pc.match_substring_regex(texts, _OWN).to_numpy(zero_copy_only=False)
        whole = pc.match_substring_regex(texts, _WHOLE).to_numpy(zero_copy_only=False) & ~own
        mark, nothing = pa.scalar(_MARK, texts.type), pa.scalar("", texts.type)
        heads, kinds = pc.binary_join_element_wise(mark, texts, nothing), (~own & ~whole, whole, own)
        plain, unsure, single = (heads.filter(pa.array(kind)) for kind in kinds)
        for signs in ("\n", ", ", ". "):
            plain = pc.replace_substring(plain, signs, f" {_MARK}{signs}")
        lists = [
            pc.split_pattern(plain, " "),
            pc.split_pattern(pc.replace_substring_regex(unsure, _CUT, rf"\1{_SPLIT}"), _SPLIT),
            pa.ListArray.from_arrays(pa.array(np.arange(len(single) + 1, dtype="<i4")), single),
        ]
        return pa.concat_arrays(lists), np.concatenate([np.flatnonzero(kind) for kind in kinds])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, four bytes an id. Each different piece of the list is looked up once."""
        cut, places = self._cut(pa.array(texts, pa.large_string()))
        pieces = cut.flatten().dictionary_encode()
        known = self.tails.of_different(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        ends = np.cumsum(np.fromiter(chain([0], map(len, known)), "<i8")) // 4
        ids = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(known), "<u4")))
        found = ids.take(pieces.indices)
        body, edges = found.flatten().to_numpy().tobytes(), found.offsets.to_numpy()[cut.offsets.to_numpy()].tolist()
        out = [b""] * len(texts)
        for place, start, end in zip(places.tolist(), edges, edges[1:]):
            out[place] = body[4 * start : 4 * end]
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pack(ids: np.ndarray, docs: list[tuple[int | None, int]]) -> bytes:
    """File bytes of the ids; ``docs`` lists (doc id, number of ids) in order."""
    parts: list[tuple[str, bytes]] = [
        ("ids", np.array([d or 0 for d, _ in docs], "<i8").tobytes()),
        ("nulls", np.array([d is None for d, _ in docs], "u1").tobytes()),
        ("ends", np.cumsum([n for _, n in docs], dtype="<i8").tobytes()),
    ]
    rest, levels = ids.astype("<u4"), 0
    while levels == 0 or len(rest):
        high = rest >> CHUNK_BITS
        more = high > 0
        bits = np.packbits(more, bitorder="little")
        ones = np.concatenate([[0], np.cumsum(np.add.reduceat(more, np.arange(0, len(more), RANK_BITS), dtype=np.int64))]) if len(more) else np.zeros(1)
        parts += [
            (f"chunks{levels}", rest.astype("u1").tobytes()), (f"more{levels}", bits.tobytes()),
            (f"ranks{levels}", ones.astype("<u8").tobytes()),
        ]
        rest = high[more]
        levels += 1
    at, places = 0, {}
    for name, body in parts:
        places[name] = (at, len(body))
        at += len(body)
    header = json.dumps({"ids": len(ids), "docs": len(docs), "levels": levels, "parts": places}).encode()
    return b"".join([MAGIC, len(header).to_bytes(4, "little"), header, *(body for _, body in parts)])


class TokenFile:
    """Random access to a file's ids through a seekable stream."""

    def __init__(self, stream):
        self.stream = stream
        if stream.read(8) != MAGIC:
            raise ValueError("not a token file")
        size = int.from_bytes(stream.read(4), "little")
        self.header = json.loads(stream.read(size))
        self.base = 12 + size
        self.levels = self.header["levels"]

    def _read(self, part: str, start: int, size: int) -> bytes:
        self.stream.seek(self.base + self.header["parts"][part][0] + start)
        return self.stream.read(size)

    def _part(self, part: str, kind: str) -> np.ndarray:
        return np.frombuffer(self._read(part, 0, self.header["parts"][part][1]), kind)

    def _rank(self, level: int, place: int) -> int:
        """Ones of the level's bitmap before ``place``: one directory entry, one partial run."""
        run = place // RANK_BITS
        known = int.from_bytes(self._read(f"ranks{level}", run * 8, 8), "little")
        start, bits = run * RANK_BITS // 8, place % RANK_BITS
        word = int.from_bytes(self._read(f"more{level}", start, (bits + 7) // 8), "little")
        return known + (word & ((1 << bits) - 1)).bit_count()

    def id_at(self, place: int) -> int:
        """The id at a position of the file."""
        if not 0 <= place < self.header["ids"]:
            raise IndexError(place)
        value = 0
        for level in range(self.levels):
            value |= self._read(f"chunks{level}", place, 1)[0] << (CHUNK_BITS * level)
            if not self._read(f"more{level}", place // 8, 1)[0] >> (place % 8) & 1:
                break
            place = self._rank(level, place)
        return value

    def range(self, start: int, stop: int) -> np.ndarray:
        """Ids of positions [start, stop): on each level one run of chunks and bits."""
        if start >= stop:
            return np.zeros(0, "<u4")
        lows, mores = [], []
        for level in range(self.levels):
            lows.append(np.frombuffer(self._read(f"chunks{level}", start, stop - start), "u1"))
            first = start // 8
            bits = np.frombuffer(self._read(f"more{level}", first, (stop + 7) // 8 - first), "u1")
            mores.append(np.unpackbits(bits, bitorder="little")[start - first * 8:][: stop - start].astype(bool))
            if not mores[-1].any():
                break
            start = self._rank(level, start)
            stop = start + int(mores[-1].sum())
        value = np.zeros(0, "<u4")
        for low, more in zip(reversed(lows), reversed(mores)):
            whole = low.astype("<u4")
            whole[more] |= value << CHUNK_BITS
            value = whole
        return value

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc id, position of its first id, ids) of each document; the levels are read once."""
        ids, nulls, ends = self._part("ids", "<i8"), self._part("nulls", "u1"), self._part("ends", "<i8")
        start, whole = 0, self.range(0, self.header["ids"])
        for doc, null, end in zip(ids.tolist(), nulls.tolist(), ends.tolist()):
            yield (None if null else doc), start, whole[start:end]
            start = end


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_CHARS) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of bounded size; a longer text comes alone."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            value = text.as_py()
            if texts and size + len(value) > limit:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc)
            texts.append(value)
            size += len(value)
        if texts:
            yield ids, texts


def write_store(
    docs: DataFrame, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    file_ids: int = FILE_IDS,
) -> tuple[DataFrame, str]:
    """(manifest, folder): writes the token files; one manifest row (file, part, seq, n_ids,
    before) a file, ``before`` being the number of ids in all files before it."""
    folder = scratch_uri(docs.sparkSession, "tokens")
    end = end_id.to_bytes(4, "little")

    def write(batches):
        part, coder = TaskContext.get().partitionId(), encoder(path)
        held: list[bytes] = []
        listed: list[tuple[int | None, int]] = []
        rows = []

        def flush():
            ids = np.frombuffer(b"".join(held), "<u4")
            name, stream = new_file(folder, f"part-{part:06d}-{len(rows):04d}", ".dac")
            with stream:
                stream.write(pack(ids, listed))
            rows.append((name, part, len(rows), len(ids)))
            held.clear()
            listed.clear()

        count = 0
        for ids, texts in slices(batches, ENCODED_CHARS):
            for doc, body in zip(ids, coder.encode(texts)):
                held.append(body + end)
                listed.append((doc, len(body) // 4 + 1))
                count += len(body) // 4 + 1
                if count >= file_ids:
                    flush()
                    count = 0
        if held:
            flush()
        columns = list(zip(*rows)) if rows else [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int32(), pa.int64()))],
            names=["file", "part", "seq", "n_ids"],
        )

    text = text_or_empty(text_col)
    ordered = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("body"), F.xxhash64(text).alias("tie"))
    files = written(
        ordered.repartitionByRange(F.asc_nulls_first("id"), F.asc("tie"))
        .sortWithinPartitions(F.asc_nulls_first("id"), F.asc("tie")).select("id", "body")
        .mapInArrow(write, "file string, part int, seq int, n_ids long"),
        "token-files",
    )
    manifest = running_total(files, ["part", "seq"], "n_ids", "upto")
    return manifest.select("*", (F.col("upto") - F.col("n_ids")).alias("before")).drop("upto"), folder


def read_store(manifest: DataFrame, folder: str) -> DataFrame:
    """(id, start, n_tokens, ids) of each document, read back; ids as little-endian bytes."""

    def read(batches):
        for batch in batches:
            for name, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, path = filesystem(f"{folder}/{name}")
                with system.open_input_file(path) as stream:
                    rows = []
                    for doc, start, ids in TokenFile(stream).documents():
                        rows.append((doc, before + start, len(ids), ids.astype("<u4").tobytes()))
                        if len(rows) >= 256:
                            yield _doc_batch(rows)
                            rows = []
                    if rows:
                        yield _doc_batch(rows)

    return dealt(manifest.select("file", "before"), "file").mapInArrow(
        read, "id long, start long, n_tokens long, ids binary"
    )


def _doc_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["id", "start", "n_tokens", "ids"]
    )


def stored_documents(docs: DataFrame, path: str, **options) -> DataFrame:
    """Writes the store and reads it back: (id, start, n_tokens, ids)."""
    manifest, folder = write_store(docs, path, **options)
    return read_store(manifest, folder)


def crc32_of(ids: bytes) -> int:
    return zlib.crc32(ids)
