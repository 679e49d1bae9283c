"""Token files, piece encoding: round trips and the libraries' own results."""

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from loamline.llm import piece_codec, shared, token_store

ODD = [
    "", " ", "   ", "a", " a", "a ", "a  b", "a \n b", "\t\tx\x0b", "the" * 3000, "▁x ▁▁ y", "中文 字", "ſK ß\x00\x1c\u0085é",
    "<|endoftext|> <s></s><unk><0x0A>", "🙂 🙂🙂", "don't we'll I'm", *[" " * k + "the" for k in range(1, 40)],
]


def texts():
    rng = random.Random(5)
    signs = " \n\tabehtxé▁  '中,.sß0189🙂"
    plain = ["word", "B", "é", "12", "don't", "x!", "%%", ", ", ". ", ".", ",", "\n", " ", " ", ".\n", ",\n", "\x01"]
    mixed = ["".join(rng.choice(plain[: rng.choice((10, 13, 16, 17))]) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    lines = ["".join(rng.choice(("foo ", "bar, ", "Baz. ", "x\n", "y.\n", "z,\n", "q ")) for _ in range(60)) + "end" for _ in range(200)]
    return ODD + mixed + lines + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 50))) for _ in range(500)]


def numbers(ids):
    return np.frombuffer(ids, "<u4").tolist()


def test_encoder_equals_library(monkeypatch):
    monkeypatch.setattr(token_store, "CACHED_PIECES", 50)
    coder = token_store.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    found = [i for t in range(0, len(texts()), 40) for i in coder.encode(texts()[t : t + 40])]
    want = coder.tokenizer.encode_batch(texts(), add_special_tokens=False)
    assert [numbers(i) for i in found] == [e.ids for e in want]


def test_encoder_keeps_signs_of_cuts():
    coder = token_store.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [
        " lead\n\nx  y", "\n\n a b\u3000 c d", "\x02", "a\x02 b", "a \x02b\n\nc d", "\x01 a b", "x, \x01y", "\x02\x01\n a", ", a. b\nc", "",
        "\n", " ", "no cut " * 40 + "\n\nx", "w" * 500 + " " + "v" * 200, "a\x00 b\x00, c", "é, ß. ſ, K\u1680 x", "<|endoftext|> a <|endoftext|>\nb",
    ]
    want = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in rows]
    assert [numbers(i) for i in coder.encode(rows)] == want
    assert [numbers(coder.encode([t])[0]) for t in rows] == want
    assert coder.encode([]) == [] and numbers(coder.encode(rows[::-1] * 3)[-1]) == want[0]


def test_encoder_looks_up_a_piece_once(monkeypatch):
    """The cost of a word is that of its first copy in the texts encoded together."""
    looked = []

    def counted(method):
        def count(self, given):
            looked.extend(s for x in given for s in ([x] if isinstance(x, str) else x))
            return method(self, given)
        return count

    for name in {"values", "of_different"} & vars(shared.Remembered).keys():
        monkeypatch.setattr(shared.Remembered, name, counted(vars(shared.Remembered)[name]))
    coder = token_store.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [f"Start of {k}, the text and the end. So the text is the same" for k in range(50)]
    assert [numbers(i) for i in coder.encode(rows)] == [coder.tokenizer.encode(t).ids for t in rows]
    assert len(looked) == len(set(looked)) < 80


def test_remembered_different_strings():
    learned = []

    def learn(strings):
        learned.extend(strings)
        return [s.encode() * 2 for s in strings]

    kept = shared.Remembered(learn, 3, 4)
    for strings in (["a", "b", "long one"], ["c", "a"], ["a", "d"], ["e", "f", "b"], [], ["long one", "a", "", "g"]):
        assert kept.of_different(strings) == [s.encode() * 2 for s in strings]
    assert learned == ["a", "b", "long one", "c", "d", "e", "f", "long one", "", "g"]
    assert set(kept.young) | set(kept.old) == {*"abdefg", ""}


def test_piece_codec_equals_library(monkeypatch):
    monkeypatch.setattr(piece_codec, "CACHED_CUTS", 50)
    monkeypatch.setattr(piece_codec, "CACHED_PAIRS", 100)
    coder = piece_codec.PieceCodec(public_tokenizers.path("piece_bpe_32k.model"))
    found = [i for t in range(0, len(texts()), 40) for i in coder.encode(texts()[t : t + 40])]
    assert [numbers(i) for i in found] == [[1, *i, 2] for i in coder.library.encode(texts(), num_threads=1)]
    assert coder.decode(found) == coder.library.decode([numbers(i) for i in found])


def test_equal_texts_are_coded_once():
    class Counting:
        def __init__(self):
            self.coded = []

        def encode(self, texts):
            self.coded += texts
            return [t.encode() for t in texts]

    coder, given = Counting(), ["b", "", "a", "b", "B", "", "b"]
    ids, sizes = piece_codec._columns(coder, given, lambda _, found: (found, [len(i) for i in found]))
    assert coder.coded == ["b", "", "a", "B"]
    assert ids.to_pylist() == [t.encode() for t in given] and sizes.to_pylist() == [len(t) for t in given]


@pytest.mark.parametrize("size", [0, 1, 511, 512, 513, 5000])
def test_random_access(size):
    rng = np.random.default_rng(size)
    ids = (rng.integers(0, 2**32, size) >> rng.integers(0, 32, size)).astype("<u4")
    docs = [(7, size // 3), (None, 0), (-3, size - size // 3)]
    file = token_store.TokenFile(io.BytesIO(token_store.pack(ids, docs)))
    assert [file.id_at(i) for i in range(0, size, 7)] == ids[::7].tolist()
    for _ in range(20):
        a, b = sorted(rng.integers(0, size + 1, 2).tolist())
        assert file.range(a, b).tolist() == ids[a:b].tolist()
    assert [(d, s, len(i)) for d, s, i in file.documents()] == [(7, 0, size // 3), (None, size // 3, 0), (-3, size // 3, size - size // 3)]
    with pytest.raises(IndexError):
        file.id_at(size)


def docs_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, id string, start long, body string")


def test_store(spark):
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(ODD)] + [(None, None, None, None, None), (3, "again", None, 0, "")]
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = token_store.stored_documents(docs_frame(spark, rows), path, file_ids=200).collect()
    library = token_store.encoder(path).tokenizer
    want = sorted([*library.encode(t or "", add_special_tokens=False).ids, 0] for _, t, *_ in rows)
    assert sorted(numbers(r["ids"]) for r in got) == want
    placed = sorted(got, key=lambda r: r["start"])
    assert [r["id"] is None for r in placed][0] and [r["id"] for r in placed][1:] == sorted(r[0] for r in rows if r[0] is not None)
    assert [r["start"] for r in placed] == np.cumsum([0, *[r["n_tokens"] for r in placed]])[:-1].tolist()
    assert all(r["n_tokens"] == len(r["ids"]) // 4 for r in got) and zlib.crc32(b"")  == 0


def test_empty_tables(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert token_store.stored_documents(docs_frame(spark, []), path).count() == 0
    assert piece_codec.digests(docs_frame(spark, []), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_piece_frames(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(ODD)] + [(None, None, None, None, None)]
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = {r["id"]: r for r in piece_codec.encoded(docs_frame(spark, rows), path).collect()}
    library = piece_codec.codec(path).library
    for i, t, *_ in rows:
        ids = [1, *library.encode(t or ""), 2]
        assert numbers(got[i]["ids"]) == ids and got[i]["decoded"] == library.decode(ids) and got[i]["n_tokens"] == len(ids)
