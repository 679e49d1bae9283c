"""The corpus pipeline against a brute-force version of its stages, and its stages on edge tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from loamline.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def passes_base(text):
    """Texts here are too short for the distances, so the base rule decides."""
    w = split(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = {g for g, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, g in enumerate(windows) if g in often for k in range(3)}
    return len(w) >= 50 and 100 * len(covered) <= 50 * len(w)


def shingles(text):
    w = split(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def components(docs):
    sets = {i: shingles(t) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in docs:
        for b in docs:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i for i in docs if find(i) == i}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(17)
    names = [f"{a}{b}" for a in "bcdfgklm" for b in ("a", "e", "io", "u")] + ["Ab", "é", "x1"]
    out = []
    for i in range(60):
        out.append((i, " ".join(rng.choices(names, k=rng.randint(40, 90))), "en", rng.choice(["a", "a", "a", "b", None]), i))
    for i in range(60, 75):  # exact copies but for blanks
        out.append((i, out[i - 60][1].replace(" ", "\n", 3), "en", "b", i))
    for i in range(75, 95):  # near copies
        w = out[i - 75][1].split(" ")
        w[rng.randrange(len(w))] = "zz"
        out.append((i, " ".join(w), "de", "c", i))
    out += [(200, None, None, None, None), (201, "", "en", "a", 0), (202, "one two three " * 40, "en", "a", 0)]
    return out


def test_rows_equal_brute_force(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = [r.asDict() for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    kept = {i: t for i, t, *_ in rows if passes_base(t)}
    groups = {}
    for i, t in kept.items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append(i)
    once = {min(g, key=lambda i: (-len(kept[i]), i)) for g in groups.values()}
    stay = components({i: kept[i] for i in once})
    # The mix takes whole documents: as often as its own sizes say, on the brute-force survivors.
    by_id = {r[0]: r for r in rows}
    sizes = mixing.mixed_sizes(spark.createDataFrame([by_id[i] for i in sorted(stay)], SCHEMA)).collect()
    want = Counter({r["id"]: r["taken"] // r["size"] for r in sizes if r["taken"]})
    assert Counter(r["doc_id"] for r in got) == want and sum(want.values()) == len(got)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.PIECES))
    for r in got:
        ids = [1, *library.encode(kept[r["doc_id"]]), 2]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_draws_of_a_text_are_coded_together(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    drawn = docs.unionByName(docs).unionByName(docs.where("doc_id < 20")).repartition(5)
    lying = corpus_pipeline.texts_together(drawn).withColumn("part", F.spark_partition_id()).collect()
    assert Counter((r["doc_id"], r["text"]) for r in lying) == Counter((r["doc_id"], r["text"]) for r in drawn.collect())
    order = [(r["part"], r["text"]) for r in lying]
    changes = 1 + sum(a != b for a, b in zip(order, order[1:]))
    assert changes == len({r[1] for r in rows}) == len(set(order))


def test_stages_on_edge_tables(spark, rows):
    """Empty tables, and columns beyond those of documents: all but the last stage keep them."""
    more = spark.createDataFrame([(*r, "x", r[0]) for r in rows], SCHEMA + ", place string, shard long")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, more, "")
        assert stage(spark, more.limit(0), "").count() == 0
        if stage is not corpus_pipeline.piece_encoding:
            assert out.columns == more.columns and out.count() > 0
