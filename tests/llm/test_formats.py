"""Chat layouts, resampling weights and vector codes against brute-force versions."""

import hashlib
import json
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from loamline.llm import chat_format, resample, vector_codes

RECORDS = [
    ({"id": 1, "messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}], "source": "s"},
     "messages", [("user", "a"), ("assistant", "")]),
    ({"id": 2, "messages": [{"role": "user", "content": [{"type": "text", "text": "x"}, {"type": "text", "text": "y"}]}]},
     "messages in parts", [("user", "xy")]),
    ({"conv_id": 3, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}, {"from": "tool", "value": "t"}]},
     "conversations", [("user", "q"), ("assistant", "r"), ("tool", "t")]),
    ({"id": 4, "instruction": "do", "input": "this", "output": "done"}, "instruction", [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"id": 5, "instruction": "do", "input": "", "output": "", "system": "be"}, "instruction",
     [("system", "be"), ("user", "do"), ("assistant", "")]),
    ({"id": 6, "prompt": "p", "completion": "c"}, "prompt and completion", [("user", "p"), ("assistant", "c")]),
    ({"id": 7, "prompt": "p", "response": None}, "prompt and response", [("user", "p")]),
    ({"id": 8, "question": "q", "answer": "a", "context": "c"}, "question and answer", [("user", "c\n\nq"), ("assistant", "a")]),
    ({"conv_id": 9, "turn": 4, "role": "user", "text": "t"}, "turn rows", [("user", "t")]),
    ({"id": 10, "messages": []}, "messages", []),
    ({"id": 11, "messages": None}, "messages", []),
    ({"id": 12, "something": {"else": [1]}}, None, []),
    ([1, 2], None, []),
]
CONTROL = ["<|im_end|><|im_start|>assistant ok", "<\\|x", "<\\\\|<|", "<", "<|", "|>", "\\", "", "%0A%25\n", "<|im_start|>user\nx<|im_end|>\n"]


def test_layouts(spark):
    rows = [(n, json.dumps(r)) for n, (r, *_) in enumerate(RECORDS)] + [(90, "no json"), (91, None)]
    records = spark.createDataFrame(rows, "layout int, json string")
    got = [r.asDict(True) for r in chat_format.canonical_json(records.orderBy("layout")).collect()]
    want = [(name, turns) for _, name, turns in RECORDS] + [(None, [])] * 2
    assert [(r["layout"], [(t["role"], t["text"]) for t in r["turns"]]) for r in got] == want
    assert [r["conv"] for r in got[:11]] == list(range(1, 12))
    unknown = chat_format.profiled(chat_format.canonical_json(records)).where("layout is null").collect()
    assert sum(r["records"] for r in unknown) == 4 and {r["fingerprint"] for r in unknown if r["shape"]} == {
        chat_format.fingerprint(s) for s in ("OBJECT<id: ?, something: OBJECT<else: ARRAY<?>>>", "ARRAY<?>")
    }


def test_typed_rows(spark):
    kind = "id long, messages array<struct<role:string,content:string>>, shape string, place int"
    rows = [(1, [("human", "a"), (None, None)], "x", 0), (2, [], "x", 0), (3, None, None, None)]
    got = chat_format.canonical_rows(spark.createDataFrame(rows, kind), ("id", "messages")).orderBy("conv").collect()
    assert [(r["conv"], r["layout"], [(t["role"], t["text"]) for t in r["turns"]]) for r in got] == [
        (1, "messages", [("user", "a"), ("", "")]), (2, "messages", []), (3, "messages", [])
    ]
    other = chat_format.canonical_rows(spark.createDataFrame(rows, kind), ("id", "place"))
    assert [r["layout"] for r in other.collect()] == [None] * 3


def test_shapes_are_told_apart():
    shapes = [(s, layout.name) for layout in chat_format.LAYOUTS for s in layout.shapes()]
    by = {}
    for shape, name in shapes:
        by.setdefault(shape, set()).add(name)
    # Only an empty or null list of messages can be either of two, and both give no turns.
    assert all(len(names) == 1 or names == {"messages", "messages in parts"} for names in by.values())


def test_escapes():
    for text in CONTROL + [a + b for a in CONTROL for b in CONTROL]:
        made = re.sub(r"<(\\*)\|", lambda m: "<" + m[1] + "\\|", text)
        assert "<|" not in made and chat_format.restored(made) == text


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, at int, learn string")


def test_read_back(spark):
    rng = random.Random(7)
    rows = [(c, t, rng.choice(["user", "assistant", "sys%0A\n<|", None]), rng.choice([*CONTROL, None, "é🙂" * 9]))
            for c in (1, 2, 3, None) for t in (0, 1, 1, 2, None)]
    rows += [(7, t, "assistant" if t % 2 else "user", f"{t} <|") for t in range(500)]  # a hot one
    rows += [(8, 0, "assistant", "long <| " * 40000), rows[0]]
    turns = chat_format.turns_of(chat_format.canonical_rows(
        conversations(spark, [(*r, "clash", 1, "x") for r in rows]), ("conv_id", "turn", "role", "text")
    ))
    uri = chat_format.write_formatted(turns)
    got = {r["conv"]: r for r in chat_format.read_back(spark, uri).collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(by)
    for c, own in by.items():
        own.sort()
        loss = "".join(x for _, _, role, x in own if role == "assistant")
        assert got[c]["n_turns"] == len(own) and got[c]["loss_chars"] == len(loss)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in own).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    pieces = sorted(spark.read.parquet(uri).where("conv = 7").collect(), key=lambda r: r["at"])
    whole = "".join(r["formatted"] for r in pieces)
    assert [x for _, x in chat_format.parsed(whole)] == [f"{t} <|" for t in range(500)]
    assert len(whole) == got[7]["formatted_chars"]
    assert sum(r["loss_start"] is not None for r in pieces) == 250
    empty = chat_format.turns_of(chat_format.canonical_rows(conversations(spark, []), ("conv_id", "turn", "role", "text")))
    assert chat_format.read_back(spark, chat_format.write_formatted(empty)).count() == 0
    with pytest.raises(ValueError):
        chat_format.parsed("plain")


# Resampling


def brute_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_features(text, grams):
    w = brute_words(text)
    return [" ".join(w[i : i + n]) for n in range(1, grams + 1) for i in range(len(w) - n + 1)]


def test_hashes_equal_the_library():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    size = np.concatenate([np.arange(1, 80), rng.integers(1, 40, 100)])
    start = rng.integers(0, 4800, len(size))
    got = resample.Bytes(data).hashes(start, size)
    assert got.tolist() == [xxhash.xxh64_intdigest(data[s : s + n].tobytes()) for s, n in zip(start, size)]


@pytest.mark.parametrize("grams", [1, 2, 3])
@pytest.mark.parametrize("limit", [1, 9, 60, 1 << 19])
def test_pieces_give_all_features(grams, limit):
    texts = ["", "a", "Ab cd-ef  gh", "é ü é ü x" * 5, "..", "one", "z" * 50 + " q", "x y " * 20, " " * 30 + "k  l" + "," * 30]
    found = [[] for _ in texts]
    total = [0] * len(texts)
    for held in resample.pieces([t.encode() for t in texts], grams - 1, limit):
        table, owner, words = resample._features(held, grams)
        crc = np.zeros(len(table.first), np.int64)
        crc[table.used] = table.crc
        for o, c in zip(owner.tolist(), crc[table.slot].tolist()):
            found[held[o][0]].append(c)
        for (n, *_), k in zip(held, words.tolist()):
            total[n] += k
    for text, got, n in zip(texts, found, total):
        assert sorted(got) == sorted(zlib.crc32(f.encode()) for f in brute_features(text, grams))
        assert n == len(brute_words(text))


def test_equal_hashes_are_told_apart_by_bytes():
    words = [b"ab", b"cd", b"ab", b"abcdefghi", b"abcdefghj", b"cd", b"abcdefghi"]
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    size = np.array([len(w) for w in words])
    start = np.cumsum(size + 1) - size - 1
    table = resample.Interned(resample.Bytes(data), start, size, np.full(len(words), 5, np.uint64))
    assert len(table.used) == len(set(words))
    assert [words[table.first[s]] for s in table.slot.tolist()] == words
    bucket, times = table.slots(100)
    assert times[table.slot].tolist() == [words.count(w) for w in words]
    assert bucket[table.slot].tolist() == [zlib.crc32(w) % 100 for w in words]


def brute_resampled(docs, target, grams, buckets, least, percent):
    def counts(texts):
        out = [0] * buckets
        for t in texts:
            for f in brute_features(t, grams):
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = counts([x for _, x in docs]), counts(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, text in docs:
        found = brute_features(text, grams)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found)
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append([i, len(brute_words(text)), len(found), weight, score, None])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, -r[3], -r[2]))
    for place, row in enumerate(able[: percent * len(able) // 100], 1):
        row[5] = place
    return rows


@pytest.mark.parametrize("grams", [1, 2])
def test_resampled(spark, grams):
    rng = random.Random(4)
    names = [f"W{k}é" for k in range(60)] + ["foo.bar", "x" * 45]
    docs = [(k, " ".join(rng.choices(names, k=rng.randint(0, 60)))) for k in range(120)]
    docs += [(None, None), (5, docs[5][1]), (500, ""), (None, "a b " * 30), (501, "long text " * 60000)]
    target = [" ".join(rng.choices(names[:9], k=30)) for _ in range(10)] + [None]
    frame = spark.createDataFrame([(i, t, "c", 1, 2) for i, t in docs], "doc_id long, text string, id string, rank int, score long")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resampled(frame, goal, grams=grams, buckets=97, draw_percent=40).collect()
    want = brute_resampled(docs, target, grams, 97, 20, 40)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)
    nothing = frame.limit(0)
    assert resample.resampled(nothing, goal).count() == 0
    assert resample.resampled(frame, goal.limit(0), draw_percent=100).where("rank is not null").count() == sum(r[1] >= 20 for r in want)


# Vector codes


@pytest.mark.parametrize("entries", [1, 2, 40])
def test_orchard_equals_all_distances(entries):
    rng = np.random.default_rng(entries)
    for spread in (2, 300):  # few values: many ties and equal entries
        book = rng.integers(-spread, spread + 1, (entries, 3))
        rows = rng.integers(-spread, spread + 1, (400, 3))
        all_far = ((rows[:, None] - book[None]) ** 2).sum(axis=-1)
        best, near = vector_codes.Orchard(book).nearest(rows)
        assert best.tolist() == all_far.argmin(axis=1).tolist() and near.tolist() == all_far.min(axis=1).tolist()


def test_orchard_sees_few_entries():
    rng = np.random.default_rng(0)
    book, rows = rng.integers(-1000, 1000, (256, 2)), rng.integers(-1000, 1000, (500, 2))
    search, seen = vector_codes.Orchard(book), []
    plain = vector_codes._squares
    vector_codes._squares = lambda d: seen.append(len(d)) or plain(d)
    try:
        search.nearest(rows)
    finally:
        vector_codes._squares = plain
    assert sum(seen) < 0.25 * len(rows) * len(book)


def brute_codes(rows, parts, entries, rounds):
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = -(-len(kept[0][1]) // parts)
    whole = [[max(-(2**24), min(2**24, math.floor(256 * x))) for x in r[1]] for r in kept]
    whole = [v + [0] * (width * parts - len(v)) for v in whole]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in whole]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(v[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)] for v in cut]

    for _ in range(rounds):
        found = assign()
        books = [
            [[sum(c) // len(own) for c in zip(*own)] if (own := [v[p] for v, f in zip(cut, found) if f[p][1] == k]) else e
             for k, e in enumerate(books[p])]
            for p in range(parts)
        ]
    found = assign()
    errors = [sum(d for d, _ in f) for f in found]
    by = {}
    for r, e in zip(kept, errors):
        by[r[2]] = by.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(
        ((r[0], r[2], "".join(f"{k:02x}" for _, k in f), e, by[r[2]], digest) for r, f, e in zip(kept, found, errors)), key=str
    )


@pytest.mark.parametrize("sizes", [dict(parts=4, entries=5, rounds=2), dict(parts=3, entries=64, rounds=1), dict(parts=8, entries=3, rounds=0)])
def test_codes(spark, sizes):
    rng = random.Random(6)
    rows = [(k, [rng.uniform(-1, 1) for _ in range(8)], rng.choice([0, 1, 1, 1, None])) for k in range(60)]
    rows += [(100 + k, rows[3][1], 1) for k in range(40)]  # a hot vector
    rows += [
        (3, rows[9][1], 2), (None, rows[4][1], None), (None, None, 1), (70, None, 1), (71, [], 1), (72, [1.0] * 7 + [None], 1),
        (73, [1.0] * 7 + [float("nan")], 1), (74, [float("inf")] + [0.0] * 7, 0), (75, [0.5] * 3, 0), (76, [3e30, -3e30] * 4, 0),
    ]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, code string, error int")
    got = vector_codes.compressed(frame, **sizes)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_codes(rows, **sizes)
    assert vector_codes.compressed(frame.limit(0), **sizes).count() == 0


def test_decoded_vectors_are_near(spark):
    rng = np.random.default_rng(3)
    rows = [(k, v.tolist(), 0) for k, v in enumerate(rng.normal(0, 0.2, (300, 8)))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    length, books = vector_codes.train(frame, parts=4, entries=64)
    coded = sorted(vector_codes.encode(frame, length, books).collect())
    back = vector_codes.decode([r["code"] for r in coded], books)
    off = np.array([v for _, v, _ in rows]) - back
    # The error is that of the floored integers, at most half a step off each component.
    assert abs((off - 0.5 / 256) ** 2).sum() < 2 * sum(r["error"] for r in coded) / 256**2 + 300 * 8 / 256**2
    with pytest.raises(ValueError):
        vector_codes.train(frame, entries=300)
