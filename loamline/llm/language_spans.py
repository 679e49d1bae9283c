"""Language identification of spans in mixed text.

Training, on labelled documents only: for each language the frequencies of character
trigrams (word edges included, hashed to ``BUCKETS``) and of scripts. The sample is bounded:
about ``TRAIN_DOCS`` documents a language, taken by a hash of the document.

Prediction: each run of letters is a word. The script of its first letter narrows the
languages to those that use it; each gets the word's summed log-probabilities. A Viterbi pass
over the words, in which a change of language costs ``SWITCH``, labels spans. All documents
of a slice go through it in step, word by word, as array operations.

The predicted language is the one with the most letters and the score its share of all
letters. Null texts and texts without letters are ``und`` with score 0, as is everything if no
document is labelled. An empty table has no rows; only id, text and language are read, whatever the
other columns are called. Rows that repeat are labelled alike. A text is worked on as a whole: a
worker needs about 100 bytes a character with four languages, more with each further one, and the
model, one row a language, is held by every worker.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.shared import text_or_empty
from loamline.llm.token_store import slices

BUCKETS = 1 << 15
TRAIN_DOCS = 2_000
#: Cost of a change of language, greatest lead of one word, and additive smoothing.
SWITCH, LEAD, SMOOTH = 8.0, 10.0, 0.05
#: Share of a language's letters from which on it uses a script, and the cost outside it.
USES_SCRIPT, NO_SCRIPT = 0.01, 25.0
UNDETERMINED = "und"

# First and last code points of the scripts that narrow candidates (fixed values).
SCRIPTS = [
    (0x0041, 0x024F, "latin"), (0x0370, 0x03FF, "greek"), (0x0400, 0x052F, "cyrillic"),
    (0x0530, 0x058F, "armenian"), (0x0590, 0x05FF, "hebrew"), (0x0600, 0x077F, "arabic"),
    (0x0900, 0x097F, "devanagari"), (0x0980, 0x09FF, "bengali"), (0x0E00, 0x0E7F, "thai"),
    (0x10A0, 0x10FF, "georgian"), (0x1E00, 0x1EFF, "latin"), (0x1F00, 0x1FFF, "greek"),
    (0x3040, 0x309F, "hiragana"), (0x30A0, 0x30FF, "katakana"), (0x3400, 0x9FFF, "han"),
    (0xAC00, 0xD7AF, "hangul"),
]
SCRIPT_NAMES = ["other", *dict.fromkeys(name for *_, name in SCRIPTS)]


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: is a letter, its lower case (if one sign), its script."""
    signs = [chr(i) for i in range(0x110000)]
    letter = np.array([s.isalpha() for s in signs])
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in np.flatnonzero(letter):
        small = signs[i].lower()
        if len(small) == 1:
            lower[i] = ord(small)
    script = np.zeros(0x110000, np.uint8)
    for first, last, name in SCRIPTS:
        script[first : last + 1] = SCRIPT_NAMES.index(name)
    return letter, lower, script


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


class Words:
    """Words of several texts: first and end positions, document, and hashed trigrams."""

    def __init__(self, texts: list[str]):
        letter, lower, script = _tables()
        sizes = np.array([len(t) for t in texts])
        self.offset = np.concatenate([[0], np.cumsum(sizes + 1)])
        codes = _codes("\n".join(texts) + "\n")
        is_letter = letter[codes]
        before = np.concatenate([[False], is_letter[:-1]])
        after = np.concatenate([is_letter[1:], [False]])
        self.first = np.flatnonzero(is_letter & ~before)
        self.end = np.flatnonzero(is_letter & ~after) + 1
        self.doc = np.searchsorted(self.offset, self.first, side="right") - 1
        self.script = script[codes[self.first]]
        # Trigrams end at every letter and at the sign after a word, which counts as an edge.
        small = np.where(is_letter, lower[codes], 0).astype(np.uint64)
        one = np.concatenate([[0], small[:-1]]).astype(np.uint64)
        two = np.where(one > 0, np.concatenate([[0, 0], small[:-2]]), 0).astype(np.uint64)
        mix = small * np.uint64(0x9E3779B97F4A7C15) + one * np.uint64(0xC2B2AE3D27D4EB4F) + two * np.uint64(0x165667B19E3779F9)
        self.bucket = ((mix ^ (mix >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(49)).astype(np.int64)


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, feature, n): trigram buckets, then scripts; summed for each slice."""
    for langs, texts in slices(batches):
        for lang in dict.fromkeys(langs):
            words = Words([t for l, t in zip(langs, texts) if l == lang])
            marks = np.zeros(len(words.bucket) + 1, np.int64)
            np.add.at(marks, words.first, 1)
            np.add.at(marks, np.minimum(words.end + 1, len(words.bucket)), -1)
            grams = np.bincount(words.bucket[np.cumsum(marks[:-1]) > 0], minlength=BUCKETS)
            letters = np.bincount(words.script, weights=words.end - words.first, minlength=len(SCRIPT_NAMES))
            counts = np.concatenate([grams, letters.astype(np.int64)])
            held = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(held), pa.string()), pa.array(held, pa.int32()), pa.array(counts[held], pa.int64())],
                names=["lang", "feature", "n"],
            )


class Model:
    """Log-probabilities (languages by features) and which scripts a language uses."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        grams, letters = counts[:, :BUCKETS], counts[:, BUCKETS:]
        smooth = grams + SMOOTH
        # The mean of the languages is taken off, which changes no comparison.
        scores = np.log(smooth / smooth.sum(axis=1, keepdims=True))
        self.scores = (scores - scores.mean(axis=0)).T.astype(np.float32).copy() if langs else np.zeros((BUCKETS, 0), np.float32)
        share = letters / np.maximum(letters.sum(axis=1, keepdims=True), 1)
        self.uses = (share >= USES_SCRIPT).T.copy()

    def word_scores(self, words: Words) -> np.ndarray:
        """Score of each word for each language, at most ``LEAD`` below the best."""
        sums = np.concatenate([np.zeros((1, len(self.langs)), np.float64), np.cumsum(self.scores[words.bucket], axis=0, dtype=np.float64)])
        stop = np.minimum(words.end + 1, len(words.bucket))
        scores = sums[stop] - sums[words.first]
        uses = self.uses[words.script]
        known = uses.any(axis=1, keepdims=True)
        scores = np.where(known, scores - NO_SCRIPT * ~uses, 0.0)
        return np.maximum(scores - scores.max(axis=1, keepdims=True), -LEAD - NO_SCRIPT * (known & ~uses)).astype(np.float32)

    def labels(self, words: Words, n_docs: int) -> np.ndarray:
        """The language number of each word on its document's best path."""
        scores = self.word_scores(words)
        counts = np.bincount(words.doc, minlength=n_docs)
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        order = np.argsort(-counts, kind="stable")
        order = order[counts[order] > 0]
        begin, size = starts[order], counts[order]
        out = np.zeros(len(scores), np.int16)
        if not len(order):
            return out
        steps = int(size[0])
        active = len(size) - np.searchsorted(size[::-1], np.arange(steps), side="right")
        best = scores[begin].copy()
        from_best = np.zeros((len(scores), len(self.langs)), bool)
        came = np.zeros(len(scores), np.int16)
        for t in range(1, steps):
            k = active[t]
            at = begin[:k] + t
            now = best[:k]
            top = now.argmax(axis=1)
            change = now[np.arange(k), top][:, None] - SWITCH
            switched = change > now
            best[:k] = np.where(switched, change, now) + scores[at]
            from_best[at], came[at] = switched, top
        state = best.argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            k = active[t]
            at = begin[:k] + t
            out[at] = state[:k]
            state[:k] = np.where(from_best[at, state[:k]], came[at], state[:k])
        return out

    def spans(self, texts: list[str]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
        """(language, score, spans of (start, end, language)) of each text."""
        words = Words(texts)
        if not self.langs:
            return [(UNDETERMINED, 0.0, []) for _ in texts]
        labels = self.labels(words, len(texts))
        letters = np.zeros((len(texts), len(self.langs)))
        np.add.at(letters, (words.doc, labels), words.end - words.first)
        total, top = letters.sum(axis=1), letters.argmax(axis=1)
        listed: list[list] = [[] for _ in texts]
        if len(labels):
            new = np.concatenate([[True], (labels[1:] != labels[:-1]) | (words.doc[1:] != words.doc[:-1])])
            first = np.flatnonzero(new)
            last = np.concatenate([first[1:], [len(labels)]]) - 1
            for f, l in zip(first.tolist(), last.tolist()):
                doc = int(words.doc[f])
                base = int(words.offset[doc])
                listed[doc].append((int(words.first[f]) - base, int(words.end[l]) - base, self.langs[labels[f]]))
        return [
            (self.langs[top[i]], float(letters[i, top[i]] / total[i]), listed[i]) if total[i] else (UNDETERMINED, 0.0, [])
            for i in range(len(texts))
        ]


def train(
    docs: DataFrame, teach: Column, text_col: str = "text", lang_col: str = "lang",
    train_docs: int = TRAIN_DOCS,
) -> Model:
    """Model of the labelled documents that ``teach`` selects.

    The sample takes a document when a hash of its text falls under ``train_docs`` over the
    language's number of documents, so its size is bounded in expectation.
    """
    lang = F.col(lang_col).cast("string")
    labelled = docs.where(teach & lang.isNotNull()).select(lang.alias("lang"), text_or_empty(text_col).alias("body"))
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("docs")).select("lang", (F.lit(float(train_docs)) / F.col("docs")).alias("share"))
    chance = F.pmod(F.xxhash64("body"), F.lit(1 << 30)) / float(1 << 30)
    # One row a language, fewer than the model itself has.
    sample = labelled.join(F.broadcast(sizes), "lang").where(chance < F.col("share")).select("lang", "body")
    counts = sample.mapInArrow(_feature_counts, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    rows = counts.groupBy("lang").agg(F.collect_list("feature").alias("features"), F.collect_list("n").alias("counts")).orderBy("lang").collect()
    table = np.zeros((len(rows), BUCKETS + len(SCRIPT_NAMES)))
    for i, r in enumerate(rows):
        table[i, r["features"]] = r["counts"]
    return Model([r["lang"] for r in rows], table)


_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, spans) of each document; the model is broadcast, its size being
    bounded by the number of languages."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for ids, texts in slices(batches):
            found = shared.value.spans(texts)
            spans = [[{"start": a, "stop": b, "lang": l} for a, b, l in s] for _, _, s in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array([l for l, _, _ in found], pa.string()),
                    pa.array([s for _, s, _ in found], pa.float64()), pa.array(spans, pa.list_(_SPAN)),
                ],
                names=["id", "lang_pred", "score", "spans"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("body"))
    return rows.mapInArrow(run, "id long, lang_pred string, score double, spans array<struct<start:long,stop:long,lang:string>>")
