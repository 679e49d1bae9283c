"""Quality rules: base counts, and distribution divergence from language references.

The references are learnt from all documents: for each language the shares of character
classes, and of its common words (each at least ``COMMON`` of the language's words). A
document is compared with the reference of its language by the Jensen-Shannon distance of
either histogram, where it is long enough for one. A language that under ``LEAST_LANGUAGE`` of
the documents have has a reference too if they hold ``LEAST_REFERENCE`` words, and else its
documents get no verdict from distances. Documents without a language are compared with the
reference of all.

At most 100 languages have that share, with 250 words each, so their references may pass
through the driver; the others stay a table. Everything about one document is worked
out in its own row: no document is shuffled. Only DataFrame and SQL functions are used.

Null texts have no words and fail the base rule, as do short texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.shared import BLANKS, packed, text_or_empty, unpacked, written

COMMON = 0.004
LEAST_LANGUAGE = 0.01
#: Words a rarer language must have for a reference, and rarer languages that are broadcast.
LEAST_REFERENCE = 10_000
BROADCAST_LANGUAGES = 2_000
#: Fewest words and signs for which a histogram is compared.
LEAST_WORDS = 100
LEAST_SIGNS = 400
#: Greatest Jensen-Shannon distances (base 2, 0 to 1) of a kept document.
MOST_WORD_DISTANCE = 0.42
MOST_SIGN_DISTANCE = 0.28

BASE_WORDS = 50
CLASSES = ("lower", "upper", "digit", "wide", "symbol", "point")


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds words (``__w``), their hashes (``__h``), base counts and class counts.

    Signs are taken off class by class, so each pass reads what the one before has left.
    """
    taken = [BLANKS + "+", "[a-z]+", "[A-Z]+", "[0-9]+", r"[^\x00-\x7F]+", "[#*$%&|<>]+"]
    df = docs.withColumn("__t", text_or_empty(text_col))
    df = df.withColumn("__w", _words(F.col("__t")))
    df = df.withColumn("__h", _hashes(F.col("__w")))
    lines = F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("__lines", lines)
    rest = "__t"
    for i, signs in enumerate(taken):
        df = df.withColumn(f"__rest{i}", F.regexp_replace(rest, signs, ""))
        rest = f"__rest{i}"
        df = df.withColumn(f"__n{i}", F.length(rest).cast("long"))
    classes = [F.col(f"__n{i}") - F.col(f"__n{i + 1}") for i in range(5)] + [F.col("__n5")]
    df = df.withColumn("__classes", F.array(*[c.cast("double") for c in classes]))
    return df.select(
        *docs.columns, "__w", "__h", F.size("__w").cast("long").alias("__words"),
        F.col("__n0").alias("__signs"), "__classes", (F.col("__n4") - F.col("__n5")).alias("__symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("__dup_lines"),
    )


def with_repeats(df: DataFrame) -> DataFrame:
    """Adds ``__repeats``: words in three-word windows that the text holds twice or more.

    Windows become longs, a hash above and the position below, and are sorted as plain
    numbers; neighbours with one hash are compared word by word, each pair once. No element
    may be null, or the numbers would be sorted as objects.
    """
    df = df.withColumn("__bits", F.expr("coalesce(cast(ceil(log2(__words + 2)) as int), 0)"))
    keys = F.expr(
        """if(__words >= 3, transform(slice(__h, 1, int(__words) - 2), (x, i) ->
             shiftleft(xxhash64(x, __h[i + 1], __h[i + 2]), __bits) | bigint(i)), array())"""
    )
    df = df.withColumn("__keys", F.sort_array(keys)).withColumn(
        "__mask", F.expr("shiftleft(bigint(1), __bits) - 1")
    )
    words = " and ".join(
        f"__w[int(__keys[i] & __mask) + {k}] = __w[int(__keys[i + 1] & __mask) + {k}]" for k in range(3)
    )
    hits = F.expr(
        f"""if(size(__keys) < 2, array(), filter(sequence(0, size(__keys) - 2), i ->
              shiftright(__keys[i] ^ __keys[i + 1], __bits) = 0 and {words}))"""
    )
    pairs = "flatten(transform(__hits, i -> slice(__keys, i + 1, 2)))"
    covered = F.expr(f"flatten(transform({pairs}, x -> array(x & __mask, (x & __mask) + 1, (x & __mask) + 2)))")
    return df.withColumn("__hits", hits).withColumn(
        "__repeats", F.size(F.array_distinct(covered)).cast("long")
    ).drop("__keys", "__hits", "__bits", "__mask")


_REFERENCE = "__key string, __q_signs array<double>, __q_ids array<bigint>, __q_words array<double>"


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[tuple], DataFrame]:
    """(key, class shares, word hashes, word shares) of each language that
    ``LEAST_LANGUAGE`` of the documents have (key ``=`` and its name), and of all (key empty);
    the same of each rarer language with enough words, as a table."""
    lang = F.col(lang_col).cast("string")
    narrow = docs.select(lang.alias("lang"), F.col(text_col).alias("text"))
    sums = measured(narrow).groupBy("lang").agg(
        F.count("*").alias("docs"), *[F.sum(F.col("__classes")[i]).alias(c) for i, c in enumerate(CLASSES)]
    )
    sums = written(sums, "classes")
    total = sums.agg(F.sum("docs").alias("docs"), *[F.sum(c).alias(c) for c in CLASSES]).first()
    held = sums.where(F.col("lang").isNotNull() & (F.col("docs") >= LEAST_LANGUAGE * (total["docs"] or 0)))
    signs = {f"={r['lang']}": [r[c] or 0.0 for c in CLASSES] for r in held.collect()}
    signs[""] = [total[c] or 0.0 for c in CLASSES]

    # Hashed behind the explode, where the hash is compiled code.
    listed = narrow.select(_key(F.col("lang")).alias("key"), F.explode(_words(text_or_empty("text"))).alias("word"))
    hashed = listed.select("key", F.xxhash64("word").alias("word"))
    counts = written(hashed.groupBy("key", "word").agg(F.count("*").alias("n")), "words")
    totals = written(counts.groupBy("key").agg(F.sum("n").alias("n")), "totals")
    words = {r["key"]: r["n"] for r in totals.where(F.col("key").isin([k for k in signs if k])).collect()}
    all_words = totals.agg(F.sum("n")).first()[0] or 0
    least = F.lit(None)
    for k in signs:
        if k:
            least = F.when(F.col("key") == k, COMMON * words.get(k, 0)).otherwise(least)
    own = counts.where(F.col("n") >= least)
    every = counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON * all_words)
    common: dict[str, list] = {k: [] for k in signs}
    for r in own.unionByName(every.withColumn("key", F.lit(""))).collect():
        common[r["key"]].append((r["word"], r["n"] / (words[r["key"]] if r["key"] else all_words)))
    out = []
    for k, counted in signs.items():
        whole = sum(counted) or 1.0
        listed = sorted(common[k])
        out.append((k, [c / whole for c in counted], [w for w, _ in listed], [q for _, q in listed]))
    return out, _rare(sums, counts, totals, [k for k in signs])


def _rare(sums: DataFrame, counts: DataFrame, totals: DataFrame, held: list[str]) -> DataFrame:
    rare = totals.where(~F.col("key").isin(held) & (F.col("n") >= LEAST_REFERENCE)).select("key", F.col("n").alias("all"))
    common = counts.join(rare, "key").where(F.col("n") >= COMMON * F.col("all")).groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("word", (F.col("n") / F.col("all")).alias("q")))).alias("common")
    )
    whole = sum((F.col(c) for c in CLASSES[1:]), F.col(CLASSES[0]))
    classes = sums.select(_key(F.col("lang")).alias("key"), F.array(*[F.col(c) / whole for c in CLASSES]).alias("signs"))
    none = F.array().cast("array<struct<word:bigint,q:double>>")
    table = rare.join(classes, "key").join(common, "key", "left").withColumn("common", F.coalesce("common", none))
    return written(
        table.select(
            F.col("key").alias("__key"), F.col("signs").alias("__q_signs"),
            F.col("common.word").alias("__q_ids"), F.col("common.q").alias("__q_words"),
        ),
        "rare",
    )


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS + "+"), "")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _key(lang: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), lang), F.lit(""))


def _divergence(p: str, q: str) -> str:
    """One bin's part of the Jensen-Shannon divergence, base 2."""
    def half(x: str) -> str:
        return f"if({x} > 0, 0.5D * {x} * log2(2 * {x} / ({p} + {q})), 0D)"

    return f"({half(p)} + {half(q)})"


def _distance(total: str) -> Column:
    return F.expr(f"sqrt(greatest({total}, 0D))")


def judged(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents with ``__words``, ``__signs``, ``__symbols``, ``__dup_lines``,
    ``__repeats``, ``__base_failed``, ``__word_distance``, ``__sign_distance`` (null where the
    text is too short for one) and ``__kept``."""
    refs, rare = references(docs, text_col, lang_col)
    table = docs.sparkSession.createDataFrame(refs, _REFERENCE)
    df = with_repeats(measured(docs, text_col))
    df = df.withColumn("__key", _key(F.col(lang_col).cast("string")))
    n_rare = rare.count()
    if n_rare <= BROADCAST_LANGUAGES:
        df = df.join(F.broadcast(table.unionByName(rare)), "__key", "left")
    else:
        df = df.join(table.unionByName(rare), "__key", "left")
    every = sorted({w for r in refs for w in r[2]})
    common = F.filter("__h", lambda h: h.isin(every)) if every else F.array().cast("array<bigint>")
    if n_rare:
        common = F.when(F.col("__key").isin([r[0] for r in refs]), common).otherwise(F.col("__h"))
    df = df.withColumn("__common", F.sort_array(F.filter(common, lambda h: F.array_contains("__q_ids", h))))
    df = df.withColumn(
        "__ends",
        F.expr(
            """if(size(__common) = 0, array(), filter(sequence(1, size(__common)),
                 i -> i = size(__common) or __common[i] <> __common[i - 1]))"""
        ),
    )
    shares = F.expr("transform(__ends, (e, j) -> (e - if(j = 0, 0, __ends[j - 1])) / cast(__words as double))")
    expected = F.expr("transform(__ends, e -> __q_words[int(array_position(__q_ids, __common[e - 1])) - 1])")
    df = df.withColumns({"__p": shares, "__q": expected})
    df = df.withColumns({
        "__q_all": F.expr("aggregate(__q_words, 0D, (a, x) -> a + x)"),
        "__p_other": F.expr("greatest(aggregate(__p, 1D, (a, x) -> a - x), 0D)"),
    }).withColumn("__q_other", F.expr("greatest(1 - __q_all, 0D)"))
    met = f"aggregate(zip_with(__p, __q, (p, q) -> {_divergence('p', 'q')} - 0.5D * q), 0.5D * __q_all, (a, x) -> a + x)"
    words = f"{met} + {_divergence('__p_other', '__q_other')}"
    signs = (
        "aggregate(zip_with(transform(__classes, c -> c / __signs), __q_signs, "
        f"(p, q) -> {_divergence('p', 'q')}), 0D, (a, x) -> a + x)"
    )
    df = df.withColumns({
        "__word_distance": F.when(F.col("__q_ids").isNotNull() & (F.col("__words") >= LEAST_WORDS), _distance(words)),
        "__sign_distance": F.when(F.col("__q_ids").isNotNull() & (F.col("__signs") >= LEAST_SIGNS), _distance(signs)),
        "__base_failed": (F.col("__words") < BASE_WORDS) | (100 * F.col("__repeats") > 50 * F.col("__words")),
    })
    far = (F.coalesce("__word_distance", F.lit(0.0)) > MOST_WORD_DISTANCE) | (
        F.coalesce("__sign_distance", F.lit(0.0)) > MOST_SIGN_DISTANCE
    )
    return df.withColumn("__kept", ~F.col("__base_failed") & ~far)


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row a document: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, word_distance, sign_distance."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    return judged(narrow, "text", "lang").select(
        "id", F.col("__words").alias("n_words"), F.col("__signs").alias("word_chars"),
        F.col("__symbols").alias("n_symbols"), F.col("__dup_lines").alias("n_dup_lines"),
        F.col("__repeats").alias("n_repeat_words"), F.col("__base_failed").alias("base_failed"),
        F.col("__kept").alias("kept"), F.col("__word_distance").alias("word_distance"),
        F.col("__sign_distance").alias("sign_distance"),
    )


def good_documents(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that are kept, with all their columns."""
    # Pushed below the measurements, the filter would repeat all of them inside itself; it is
    # not pushed below a row number.
    rows = packed(docs, text=F.col(text_col), lang=F.col(lang_col))
    rows = judged(rows).withColumn("__row", F.monotonically_increasing_id())
    return unpacked(rows.where("__kept and __row >= 0"))
