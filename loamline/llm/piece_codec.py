"""SentencePiece BPE encoding through a merge-type prefix table, and decoding.

For every prefix of a text the encoding ends in exactly one token, and that token is the only
one that (a) ends there, (b) is what its own text encodes to, and (c) may follow the last
token of the prefix before it: encoding the two tokens' joined text gives the same two
tokens back. So the table of last tokens is filled from left to right with the matches of an
Aho-Corasick automaton over the pieces and a remembered pair test, and the ids are then
recovered backwards, each token leading to the prefix before it.

Characters that no piece holds match nothing; they begin the table anew and become byte
tokens. No piece has a blank sign behind another character, so a text may be cut before each
run of blank signs; equal cuts are encoded once a worker.

Null texts count as empty. The decoding is the library's own.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.shared import Remembered, text_or_empty
from loamline.llm.token_store import LONG_PIECE, slices

BLANK = "▁"
#: Cuts and tested pairs that a Python worker remembers, and the characters tabled at once.
CACHED_CUTS = 450_000
CACHED_PAIRS = 600_000
TABLE_CHARS = 400_000
# Piece types of the model file (fixed values of its format).
NORMAL, UNKNOWN, USER_DEFINED, BYTE = 1, 2, 4, 6


class PieceCodec:
    """Encoder of one BPE model with byte fallback and plain (identity) normalisation."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        normal, trainer = model.normalizer_spec, model.trainer_spec
        kinds = {p.type for p in model.pieces}
        if (
            trainer.model_type != 2 or not trainer.byte_fallback or normal.precompiled_charsmap
            or not normal.add_dummy_prefix or normal.remove_extra_whitespaces
            or not normal.escape_whitespaces or USER_DEFINED in kinds
        ):
            raise ValueError("the model needs BPE, byte fallback and identity normalisation")
        self.library = SentencePieceProcessor(model_file=path)
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        self.pieces = [p.piece for p in model.pieces]
        self.size = [len(p) for p in self.pieces]
        self.rank: dict[str, tuple[float, int]] = {}
        self.bytes = {}
        for number, p in enumerate(model.pieces):
            if p.type == NORMAL:
                self.rank[p.piece] = (p.score, number)
            elif p.type == BYTE:
                self.bytes[int(p.piece[3:5], 16)] = number
        signs = {c for p in self.rank for c in p}
        if not signs <= self.rank.keys() or any(BLANK in p.lstrip(BLANK) for p in self.rank):
            raise ValueError("every character of a piece must be a piece; blanks may only lead")
        self.automaton = ahocorasick.Automaton()
        for piece, (_, number) in self.rank.items():
            if self.merged(piece) == [piece]:  # (b); others are never a token of a text
                self.automaton.add_word(piece, (number, len(piece)))
        self.automaton.make_automaton()
        self.shift = len(self.pieces).bit_length()
        self.pairs: dict[int, bool] = {}
        self.words = Remembered(self._learn, CACHED_CUTS, LONG_PIECE)
        self.cut = re.compile(f"{BLANK}+[^{BLANK}]*").findall

    def merged(self, text: str) -> list[str]:
        """The encoding of a short text by its definition: best merge first, leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.rank.get(parts[i] + parts[i + 1])
                if found and (best is None or found[0] > best):
                    best, at = found[0], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, left: int, right: int) -> bool:
        """Whether token ``right`` may follow ``left`` (0: begins a text)."""
        want = [self.pieces[right]] if not left else [self.pieces[left], self.pieces[right]]
        return self.merged("".join(want)) == want

    def table(self, text: str) -> list[int]:
        """Last token of every prefix; 0 where the prefix ends in a character without a piece."""
        last = [0] * (len(text) + 1)
        pairs, shift = self.pairs, self.shift
        known = pairs.get
        for end, (token, size) in self.automaton.iter(text):
            end += 1
            if last[end]:
                continue
            pair = last[end - size] << shift | token
            fits = known(pair)
            if fits is None:
                if len(pairs) >= CACHED_PAIRS:
                    pairs.clear()
                fits = pairs[pair] = self.follows(pair >> shift, token)
            if fits:
                last[end] = token
        return last

    def _recover(self, text: str, last: list[int], start: int, end: int) -> bytes:
        ids, size = [], self.size
        while end > start:
            token = last[end]
            if token:
                ids.append(token)
                end -= size[token]
            else:
                ids.extend(self.bytes[b] for b in reversed(text[end - 1].encode()))
                end -= 1
        ids.reverse()
        return array("I", ids).tobytes()

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of each word behind its blank sign (words that bring their own keep it)."""
        cuts = [w if w[:1] == BLANK else BLANK + w for w in words]
        out, at = [], 0
        while at < len(cuts):
            group, size = [], 0
            while at < len(cuts) and (not group or size + len(cuts[at]) <= TABLE_CHARS):
                group.append(cuts[at])
                size += len(cuts[at]) + 1
                at += 1
            # Line feeds are in no piece, so the cuts between them do not touch.
            text = "\n".join(group)
            last, start = self.table(text), 0
            for cut in group:
                out.append(self._recover(text, last, start, start + len(cut)))
                start += len(cut) + 1
        return out

    def _words(self, text: str) -> list[str]:
        """Cuts of the text before its runs of blanks, a single blank sign left off."""
        if not text:
            return []
        if "  " not in text and BLANK not in text and text[0] != " ":
            return text.split(" ")
        found = self.cut(BLANK + text.replace(" ", BLANK))
        return [c if c[1:2] == BLANK else c[1:] for c in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text with begin and end ids, four bytes an id."""
        first, final = array("I", [self.begin]).tobytes(), array("I", [self.end]).tobytes()
        return [first + b"".join(ids) + final for ids in self.words.values([self._words(t) for t in texts])]

    def decode(self, ids: list[bytes]) -> list[str]:
        return self.library.decode([np.frombuffer(i, "<u4").tolist() for i in ids])


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def _columns(coder: PieceCodec, texts: list[str], row: Callable) -> list[pa.Array]:
    """The columns that ``row`` makes of each text's ids; equal texts of the list are coded once."""
    places = {text: i for i, text in enumerate(dict.fromkeys(texts))}
    at = pa.array([places[t] for t in texts], pa.int32())
    return [pa.array(c).take(at) for c in row(coder, coder.encode(list(places)))]


def _mapped(docs: DataFrame, path: str, schema: str, row: Callable, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for keys, texts in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), *_columns(coder, texts, row)],
                names=[f.split()[0] for f in schema.split(", ")],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("body"))
    return rows.mapInArrow(run, schema)


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, decoded): ids as little-endian 32-bit bytes, and the text they decode to."""

    def row(coder, ids):
        return [len(i) // 4 for i in ids], ids, coder.decode(ids)

    return _mapped(docs, path, "id long, n_tokens long, ids binary, decoded string", row, id_col, text_col)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of each text, without moving the ids."""

    def digest(body: bytes) -> str:
        return hashlib.sha256(body).hexdigest()

    def row(coder, ids):
        texts = [digest(t.encode()) for t in coder.decode(ids)]
        return [len(i) // 4 for i in ids], [digest(i) for i in ids], texts

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _mapped(docs, path, schema, row, id_col, text_col)
