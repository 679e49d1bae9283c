"""Edge rows and brute-force versions of the document operators."""

import hashlib
import random
import re

import pytest

from loamline.llm import (
    arc_to_warc, exact_dedup, language_spans, main_text, mixing, near_dedup, quality, secret_spans,
)
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, shard int, place string, id long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, None, None, None, None, None)[:7] for r in rows], SCHEMA)


def words(rng, n, names=400):
    return [f"w{rng.randint(0, names)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "One TWO"), (6, "one  two"), (None, "one two"), (4, "one two")]
    base = words(rng, 300)
    for i in range(10, 60):
        text = list(base)
        for _ in range(rng.randint(0, 14)):
            text[rng.randrange(300)] = f"x{rng.randint(0, 9)}"
        rows.append((i, " ".join(text)))
    rows += [(i, " ".join(words(rng, rng.randint(1, 200)))) for i in range(100, 140)]
    rows += [(200, "a" * 20000), (201, "b " * 5000)]
    return [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None])) for i, t in rows]


def test_exact(spark, corpus):
    docs = frame(spark, corpus)
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t, *_ in corpus]
    for bits in (64, 3):  # three bits: every key is a chain of collisions
        got = exact_dedup.duplicates(docs, key_bits=bits, bucket_entries=4).collect()
        assert len(got) == len(corpus) and sum(r["kept"] for r in got) == len(set(norm))
        want = {}
        for (i, t, *_), n in zip(corpus, norm):
            want.setdefault(n, []).append((-len(t or ""), i is None, i))
        keep = {hashlib.sha256(n.encode()).hexdigest(): (min(v, key=lambda x: (x[0], x[1], x[2] or 0))[2], len(v)) for n, v in want.items()}
        assert all((r["keep_id"], r["group_size"]) == keep[r["text_sha256"]] for r in got)
    assert exact_dedup.deduplicate(docs).count() == len(set(norm))
    assert exact_dedup.duplicates(frame(spark, [])).count() == 0 == exact_dedup.deduplicate(frame(spark, [])).count()


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_near(spark, corpus):
    sets = [shingles(t) for _, t, *_ in corpus]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= 85 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    members = {}
    for i in range(len(sets)):
        members.setdefault(find(i), []).append(corpus[i][0])
    docs = frame(spark, corpus)
    got = near_dedup.grouped(docs).collect()
    assert len(got) == len(corpus) and sum(r["kept"] for r in got) == len(members)
    least = sorted(min((x for x in m if x is not None), default=None) for m in members.values())
    assert sorted(r["component_id"] for r in got if r["kept"]) == least
    lengths = sorted(len(s) for s in sets)
    assert sorted(r["n_shingles"] for r in got) == lengths
    assert near_dedup.deduplicate(docs).count() == len(members)
    assert near_dedup.grouped(frame(spark, [])).count() == 0


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 102), (101, 102)], "a long, b long")
    got = {r["row"]: r["root"] for r in near_dedup.components(edges).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100}


def test_mix(spark, corpus):
    docs = frame(spark, corpus)
    got = mixing.mixed_sizes(docs, radix_bits=3, cell_docs=4).collect()
    again = mixing.mixed_sizes(docs, radix_bits=3, cell_docs=4).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(corpus)
    size = {}
    for _, t, _, s in corpus:
        size[s] = size.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, stopped = {}, set()
    while True:
        rest = 1.5 * sum(size.values()) - sum(2 * size[s] for s in stopped)
        free = sum(weight[s] for s in names if s not in stopped)
        target = {s: 2.0 * size[s] if s in stopped else weight[s] * rest / free for s in names}
        above = {s for s in names if target[s] > 2 * size[s] + 1e-9}
        if not above:
            break
        stopped |= above
    assert {round(r["target"], 4) for r in got} == {round(t, 4) for t in target.values()}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
    for s in names:
        taken = sum(r["taken"] for r in got if r["source_size"] == size[s])
        same = sum(target[x] for x in names if size[x] == size[s])
        # Whole documents are taken, so the largest one of the source bounds what is left.
        assert abs(taken - same) <= max(r["size"] for r in got if r["source_size"] == size[s])
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "_shard"] and mixed.count() > 0
    assert mixing.mixed_sizes(frame(spark, [])).count() == 0 == mixing.mix(frame(spark, [])).count()


def test_mix_goes_on_after_a_long_document(spark):
    """A document larger than the room left does not end the partial pass."""
    rows = [(i, "w " * (4000 if i % 150 == 0 else 5 + i % 3), None, "a") for i in range(1500)]
    docs = frame(spark, rows)
    got = mixing.mixed_sizes(docs, radix_bits=4, cell_docs=16).collect()
    part = round(got[0]["target"] - got[0]["source_size"])
    again = {r["id"]: r["taken"] - r["size"] for r in got}
    places = sorted((int(hashlib.md5(f"7|{r['id']}".encode()).hexdigest()[:15], 16), r["id"], r["size"]) for r in got)
    room, wanted = part, {}
    for _, i, n in places:
        wanted[i] = n if n <= room else 0
        room -= wanted[i]
    assert again == wanted and any(n == 0 for n in wanted.values())
    assert mixing.mix(docs).count() == 1500 + sum(n > 0 for n in wanted.values())


def test_splitting_tree_is_exact(spark):
    slots = spark.createDataFrame([(s, i) for s, n in (("a", 37), (None, 5), ("b", 90)) for i in range(n)], "source string, slot long")
    rows = mixing._split(slots, 8, 1).collect()
    total = {}
    for r in rows:
        total[r["source"]] = total.get(r["source"], 0) + r["quota"]
    per = [sum(r["quota"] for r in rows if r["shard"] == k) for k in range(8)]
    assert total == {"a": 37, None: 5, "b": 90} and max(per) - min(per) <= 1


def test_quality(spark, corpus):
    rng = random.Random(9)
    extra = [(300, "a b c " * 40, "en", "a"), (301, "x\nx\n\nx y\n#*$", "en", "a")]
    rows = corpus[:8] + extra + [(400 + i, " ".join(words(rng, 120, 30)), "en", "a") for i in range(20)]
    rows.append((500, " ".join(f"{w}###$$$%%%&&&" for w in words(rng, 200)), "en", "a"))
    got = {}
    for r in quality.scored(frame(spark, rows)).collect():
        got.setdefault(r["id"], r)
    assert got[300]["base_failed"] and got[300]["n_repeat_words"] == 120
    assert (got[301]["n_dup_lines"], got[301]["n_symbols"], got[301]["n_words"]) == (1, 3, 5)
    assert (got[1]["n_words"], got[1]["kept"]) == (0, False) and not got[500]["kept"] and got[400]["kept"]
    assert quality.scored(frame(spark, [])).count() == 0 == quality.good_documents(frame(spark, [])).count()
    kept = {r["doc_id"] for r in quality.good_documents(frame(spark, rows)).collect()}
    assert 500 not in kept and 400 in kept


def test_repeated_windows_equal_brute_force(spark):
    rng = random.Random(31)
    texts = [" ".join(rng.choices("abc"[: 1 + i % 3] + "dé", k=i % 23)) for i in range(200)] + [None, " \n", "a b\ta b a b"]
    df = quality.measured(frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]).select("doc_id", "text"))
    got = {r["doc_id"]: r["__repeats"] for r in quality.with_repeats(df).select("doc_id", "__repeats").collect()}
    for i, t in enumerate(texts):
        w = (t or "").split()
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        assert got[i] == len({k + j for k, g in enumerate(windows) if windows.count(g) > 1 for j in range(3)})


def test_quality_of_rare_languages(spark):
    """Clean documents of a language under 1% are held against their own language, or not at all."""
    rng = random.Random(12)
    def say(letters, n):
        common = [letters[k % 10] + letters[k // 10] for k in range(30)]
        return " ".join(rng.choice(common) if rng.random() < 0.5 else "".join(rng.choices(letters, k=8)) for _ in range(n))
    rows = [(i, say("abcdefghij", 60), "en", "a") for i in range(1600)]
    rows += [(5000 + i, say("αβγδεζηθικ", 1200), "el", "a") for i in range(12)]
    rows += [(6000, say("жзийклмноп", 300), "ru", "a")]
    rows += [(7000, " ".join("#$%&" for _ in range(300)) + " " + say("αβγδεζηθικ", 300), "el", "a")]
    got = {r["id"]: r for r in quality.scored(frame(spark, rows)).where("id >= 5000").collect()}
    clean = [got[5000 + i] for i in range(12)]
    assert not any(r["base_failed"] for r in got.values() if r["id"] != 7000)
    assert all(r["kept"] and r["sign_distance"] is not None and r["word_distance"] is not None for r in clean)
    assert got[6000]["kept"] and got[6000]["sign_distance"] is None and got[6000]["word_distance"] is None
    assert got[7000]["sign_distance"] > quality.MOST_SIGN_DISTANCE and not got[7000]["kept"]
    assert not any(r["kept"] for r in quality.scored(frame(spark, [(1, None, "el"), (2, "a b", "ru")])).collect())


def test_secrets(spark):
    rng = random.Random(4)
    key = "".join(rng.choice(secret_spans.ALPHABETS["base62"]) for _ in range(40))
    texts = [
        None, "", "password: hunter22 token=abc", "é API_KEY = 'Zz9+/x-1' AKIA" + "A1" * 8 + " AKIA123",
        "deadbeef" * 3 + " " + "0" * 23, f"see {key} there", "a1" * 30 + " " + "abc1" * 15,
    ]
    rows = {r["id"]: r for r in secret_spans.secrets(frame(spark, list(enumerate(texts)))).collect()}
    assert [(rows[i]["n_assign"], rows[i]["n_access"], rows[i]["n_hex"]) for i in range(5)] == [(0, 0, 0), (0, 0, 0), (1, 0, 0), (1, 1, 0), (0, 0, 1)]
    assert rows[2]["base_spans"] == "assign:0:18" and rows[3]["base_spans"].startswith("assign:2:21,access:23:43")
    assert rows[5]["spans"] == "random:4:44" and rows[6]["spans"] == rows[6]["base_spans"]
    assert secret_spans.secrets(frame(spark, [])).count() == 0


def test_secrets_after_names_and_paths(spark):
    rng = random.Random(8)
    def key(alphabet, n=40):
        return "".join(rng.choice(secret_spans.ALPHABETS[alphabet]) for _ in range(n))
    plain, url, wide = key("base62"), key("base64url", 60), key("base64", 60)
    cases = [
        (f"DB_PASS={plain}", plain), (f"sig={plain}&x=1", plain), (f"client={plain}==", plain), (f"my_app/{plain}", plain),
        (f"a+b/{url}", url), (f"a_b-{wide}", wide), (f"{plain}=={plain}", plain), (f"my_longapplication/name/{plain}", plain),
    ]
    rows = {r["id"]: r for r in secret_spans.secrets(frame(spark, [(i, c[0]) for i, c in enumerate(cases)])).collect()}
    for i, (text, secret) in enumerate(cases):
        covered = set()
        for kind, start, end in (s.split(":") for s in rows[i]["spans"].split(",")):
            covered |= set(range(int(start), int(end)))
        at = text.index(secret)
        assert covered >= set(range(at + 2, at + len(secret) - 2)) and rows[i]["n_random"] >= 1, text
    assert [rows[i]["spans"] for i in (0, 2)] == ["random:8:48", "random:7:47"]
    assert rows[6]["spans"] == "random:0:40,random:42:82"


def test_languages(spark):
    rng = random.Random(2)
    syllables = {"xx": "ka lo mi tu", "yy": "sch pfe rau gen", "zz": "жа ло ми ту"}
    def say(lang, n):
        return " ".join("".join(rng.choice(syllables[lang].split()) for _ in range(3)) for _ in range(n))
    rows = [(i, say(l, 60), l) for i, l in enumerate(sorted(syllables) * 20)]
    mixed = say("xx", 30) + " " + say("yy", 10)
    probe = [(1000, mixed), (1001, None), (1002, "123 ..."), (1003, say("zz", 5)), (None, say("yy", 5))]
    model = language_spans.train(frame(spark, rows), F.lit(True))
    got = {r["id"]: r for r in language_spans.identify(frame(spark, probe), model).collect()}
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, None)] == ["xx", "und", "und", "zz", "yy"]
    assert [s["lang"] for s in got[1000]["spans"]] == ["xx", "yy"] and 0.5 < got[1000]["score"] < 1
    empty = language_spans.train(frame(spark, []), F.lit(True))
    assert language_spans.identify(frame(spark, probe), empty).where("lang_pred <> 'und'").count() == 0


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, file string, host string")


def test_main_text(spark):
    nav = "<nav><ul><li>Home<li>About</ul></nav><div class='side-bar ad'>buy <div>now</div></div>"
    chrome = "one two three four five six seven eight nine ten"
    rows = [
        (1, "http://h/1", f"<title>t</title>{nav}<article><h1>A &amp; B</h1><p>x <b>y</b>\n z<br>w<p>last</article><footer>f", None, "q"),
        (2, "http://h/2", f"<body><p>{chrome}</p><p>unique text</p>", None, None),
        (3, "http://h/3", f"<body><p>{chrome}</p><p>other words</p><script>var a='</p>'</script>", None, None),
        (4, None, None, None, None), (4, None, None, None, None),
    ]
    got = {r["page_id"]: r["text"] for r in main_text.extract(pages(spark, rows)).collect()}
    assert got == {1: "A & B\n\nx y z w\n\nlast", 2: "unique text", 3: "other words", 4: ""}
    assert main_text.extract(pages(spark, [])).count() == 0


def test_main_text_over_groups(spark):
    """Boilerplate on two pages of a host goes, whatever groups the pages fall into."""
    rng = random.Random(5)
    chrome, notice = (" ".join(f"{c}{i}" for i in range(12)) for c in "cn")
    own = {i: " ".join(f"p{i}x{rng.randint(0, 10**6)}" for _ in range(9)) for i in range(300)}
    rows = [
        (i, f"http://big/{i}", f"<p>{chrome if i in (7, 250) else ''}</p><p>{own[i]}</p>", None, None) for i in range(290)
    ]
    rows += [(290, "http://big/290", f"<nav>{notice}</nav><p>{own[290]}</p>", None, None)]
    rows += [(291, "http://big/291", f"<article><p>{notice}</p><p>{own[291]}</p></article>", None, None)]
    for group_pages in (256, 8, 1000):
        got = {r["page_id"]: r["text"] for r in main_text.extract(pages(spark, rows), group_pages=group_pages).collect()}
        assert got == {i: own[i] for i in range(292)}


def test_main_text_keeps_copies(spark):
    """Copies and near copies under one host keep their text, and pages without a host share none."""
    text = " ".join(f"word{i}" for i in range(60))
    other, third = (" ".join(f"{c}{i}" for i in range(60)) for c in "yz")
    near = text.replace("word30 ", "changed ")
    notice = " ".join(f"n{i}" for i in range(10))
    rows = [
        (1, "http://h/1", f"<p>{text}</p>", None, None), (1, "http://h/1", f"<p>{text}</p>", None, None),
        (2, "http://h/2", f"<p>{near}</p>", None, None),
        (3, "http://h/3", f"<p>{notice}</p><p>{other}</p>", None, None),
        (4, "http://h/4", f"<p>{notice}</p><p>{other}</p>", None, None),
        (5, "http://h/5", f"<p>{notice}</p><p>{third}</p>", None, None),
        (6, None, f"<p>{text}</p>", None, None), (7, "h/7", f"<p>{near}</p>", None, None),
    ]
    for group_pages in (256, 1):
        got = {(r["page_id"], r["text"]) for r in main_text.extract(pages(spark, rows), group_pages=group_pages).collect()}
        assert got == {(1, text), (2, near), (3, other), (4, other), (5, third), (6, text), (7, near)}


@pytest.mark.parametrize("page, text", [
    ("<div class='wrapper has-sidebar'><article><p>a</p></article></div>", "a"),
    ("<main class='with-sidebar'><p>a</p></main>", "a"),
    ("<main class='sidebar'><p>a</p></main>", "a"),
    ("<article class='post has-comments'>a</article>", "a"),
    ("<div class=banner><nav>m</nav><p>x</p><div class='alert'><article>a</article></div></div>", "a"),
    ("<div class=sidebar>m</div><main><article>a</article><section class=comments><article>c</article></section>b</main>", "a\n\nb"),
    ("<article>a<article class=comment>c</article>b</article>", "a\n\nb"),
    ("<article><p class='promo'>x<p>a<p>b</article><p>y", "a\n\nb"),
    ("<article><p class='promo'>x</article><article><p>a</article>", "a"),
    ("<article><ul><li class='ad'>x<ul><li>y</ul>z<li>a</ul><p>b</p></article>", "a\n\nb"),
    ("<article><ul><li class='ad'><div>x</div>y</ul>a</article>", "a"),
    ("<article><table><tr><td class=ad>x<td>a<tr><td>b</table></article>", "a\n\nb"),
    ("<article><dl><dt class=ad>x<dd>a</dl></article>", "a"),
    ("<article><div class='cookie-banner'>x<div>y</div>z</div>a</article>", "a"),
    ("<head><meta charset=utf-8><article>a</article>", "a"),
])
def test_main_text_marks(page, text):
    assert main_text.main_texts([page]) == [text]


def test_archives(spark):
    rows = [
        (1, "http://a b/", "same", "x", None), (2, None, "same", None, None), (2, "u", "same", None, None),
        (3, "u", None, None, None), (None, "u", "", None, None), (4, "u", "é\r\n\r\nWARC/1.1 \n" * 900, None, None),
    ]
    got = arc_to_warc.archived(pages(spark, rows)).collect()
    seen = sorted((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"] or 0) for r in got)
    assert seen == [(0, 0, "revisit", 3), (1, 4, "revisit", 2), (2, 4, "response", 0), (2, 4, "revisit", 2), (3, 0, "response", 0), (4, 900 * 16, "response", 0)]
    digest = arc_to_warc.sha1_base32(b"same")
    assert [r["payload_digest"] for r in got if r["payload_bytes"] == 4] == [digest] * 3
    assert {r["record_type"] for r in arc_to_warc.archived(pages(spark, rows), least_bytes=10**6).collect()} == {"response"}
    assert arc_to_warc.archived(pages(spark, [])).count() == 0


def test_archives_keep_pages_named_like_the_version_block(spark):
    rows = [(1, "filedesc://x", "a", None, None), (2, "u", "b", None, None)]
    assert {r["page_id"] for r in arc_to_warc.archived(pages(spark, rows)).collect()} == {1, 2}


CLASHING = (
    "doc id key name row rows again digest size u to turn draw shard place text_key kept_id kept_key __w __t __h __key __row __words "
    "__id __sha __n __s __cut __draws __order __draw __own __kept"
).split()


@pytest.mark.parametrize("stage", [
    quality.good_documents, exact_dedup.deduplicate, near_dedup.deduplicate,
    lambda docs: mixing.mix(docs, shards=2).select(*docs.columns),
])
def test_columns_of_any_name_pass_unchanged(spark, stage):
    rng = random.Random(11)
    rows = [(i, " ".join(words(rng, 80)), "en", rng.choice("ab"), *[f"{c} {i}" for c in CLASHING]) for i in range(40)]
    rows += [(100, rows[0][1], "en", "a", *[None] * len(CLASHING)), (None, None, None, None, *[""] * len(CLASHING))]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    docs = spark.createDataFrame(rows, schema)
    got = stage(docs)
    assert got.columns == docs.columns
    found = [tuple(r) for r in got.collect()]
    assert found and set(found) <= set(rows)
    assert stage(docs.limit(0)).count() == 0


def test_a_text_of_many_documents_is_read_once(spark):
    """Copies of one text, some with one id or none, beside near copies of it."""
    rng = random.Random(12)
    base = words(rng, 200)
    near = [" ".join([*base[:k], "other", *base[k + 1 :]]) for k in (3, 90, 180)]
    rows = [(i % 30 if i % 7 else None, " ".join(base)) for i in range(90)] + [(200 + k, t) for k, t in enumerate(near)]
    got = near_dedup.grouped(frame(spark, rows)).collect()
    assert len(got) == 93 and {r["component_id"] for r in got} == {min(i for i, _ in rows if i is not None)} and sum(r["kept"] for r in got) == 1
