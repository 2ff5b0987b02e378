"""The operators against plain versions, on a small table with every awkward row."""

import collections
import hashlib
import math
import os
import random
import subprocess
import sys
import time
import zlib
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rangeloom.llm import (
    decontaminate,
    html_text,
    jaccard_join,
    language_id,
    mixing,
    order_minhash,
    quality,
    regions,
    substring_dedup,
    token_binary,
    warc_fixity,
)
from rangeloom.llm.common import connected_components
from rangeloom.llm.queries import TOKENIZER
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n int, s bigint, size string, score int"


def make_rows():
    rng = random.Random(5)
    words = [a + b for a in ("ka", "to", "Mi", "é", "zu9") for b in ("ra", "lo.", "ne", "x")]
    passage = " ".join(rng.choices(words, k=40))
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 90))) for _ in range(60)]
    base = " ".join(rng.choices(words, k=120)).split(" ")
    for k in range(30):  # near copies of one text
        own = list(base)
        for _ in range(k % 6):
            own[rng.randrange(len(own))] = f"new{rng.random():.4f}"
        texts.append(" ".join(own))
    texts += [texts[3]] * 5 + [f"{texts[k]} {passage}\n{texts[k + 1]}" for k in range(25)]
    texts += ["", " \n\t", None, "one two", "ONE  two", "1234 !!", "w", "x" * 3000, ("long " + passage + " ") * 400]
    rows = [
        (k, t, rng.choice(["xx", "yy", None]), rng.choice(["b", "a", "a", "a", None]), len(t or ""), 7, 7, "size", 7)
        for k, t in enumerate(texts)
    ]
    rows += [rows[3], rows[3], (None, texts[5], None, None, None, None, None, None, None), (2000, texts[0], None, None, None, 0, 0, "", 0)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def key(row):
    return tuple((x is None, x) if not isinstance(x, bool) else (False, x) for x in row)


def same(df, columns, expected):
    found = sorted((tuple(r) for r in df.select(*columns).collect()), key=key)
    assert found == sorted(expected, key=key)


# 1


def test_token_store_round_trip(spark, docs, rows, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    special = docs.unionByName(docs.limit(1).withColumn("text", F.lit("a <|endoftext|>B. c,d 'S it's, é. É. x..")).withColumn("doc_id", F.lit(900).cast("long")))
    target = str(tmp_path / "store")
    token_binary.write_tokens(special, target, TOKENIZER)
    ids = {r["doc_id"]: r for r in token_binary.read_tokens(spark, target).collect()}
    start = 0
    texts = sorted(((r["doc_id"], r["text"]) for r in special.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    digests = collections.Counter(map(tuple, token_binary.token_digests(spark, target).select("doc_id", "start", "n_tokens", "ids_crc32").collect()))
    for doc, text in texts:
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        if doc != 3:
            assert list(ids[doc]["ids"]) == want
        assert digests[doc, start, len(want), zlib.crc32(np.array(want, "<u4").tobytes())] == 1
        start += len(want)
    assert sum(digests.values()) == len(texts)
    few = token_binary.read_tokens(spark, target, [5, 900]).collect()
    assert sorted(r["doc_id"] for r in few) == [5, 900]


def test_encoder_gives_the_tokenizers_ids():
    from tokenizers import Tokenizer

    rng = random.Random(2)
    letters = "abcxyz éàçñøßÉÅ.,;'!?-0123 \n\té\u0301ﬁ漢字🙂"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(3000)] + _LATIN
    encoder, tokenizer = token_binary.Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    assert encoder.plain
    found = list(encoder.encode([t.encode() for t in texts]))
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert found == want


_LATIN = [a + b for a in map(chr, range(0xA0, 0x180)) for b in ("", "a", "'s", ".", "é")]


def test_token_store_of_nothing(spark, nothing, tmp_path):
    token_binary.write_tokens(nothing, str(tmp_path / "store"), TOKENIZER)
    assert token_binary.token_digests(spark, str(tmp_path / "store")).count() == 0


# 2


@pytest.mark.parametrize("shard_words", [1 << 20, 50])
def test_decontaminate(spark, docs, rows, nothing, shard_words):
    texts = [r[1] for r in rows]
    items = [(k, " ".join((texts[k] or "").split()[2:2 + n])) for k, n in ((1, 30), (7, 9), (8, 3), (70, 14), (71, 50))]
    items += [(90, None), (91, ""), (92, "nowhere to be found"), (93, "..."), (1, texts[9])]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.decontaminate(docs, benchmark, shard_words=shard_words).select(
        "doc_id", "n_words", "n_hit", F.size("items").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
    same(found, found.columns, brute.leaks([r[:2] for r in rows], items))
    assert decontaminate.decontaminate(nothing, benchmark).count() == 0
    assert decontaminate.decontaminate(docs, benchmark.limit(0)).where("n_hit > 0").count() == 0
    hit = {r[0] for r in brute.leaks([r[:2] for r in rows], items) if r[5]}
    kept = decontaminate.remove_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert collections.Counter(r["doc_id"] for r in kept.collect()) == collections.Counter(r[0] for r in rows if r[0] not in hit)


def test_spans_cut_the_phrase_out(spark):
    docs = spark.createDataFrame([(1, "É é. A b c d e f g h i J k. Ende ü")], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id bigint, text string")
    row = decontaminate.decontaminate(docs, benchmark).first()
    assert decontaminate.excise(docs.first()["text"], row["spans"]) == "É é. . Ende ü"


# 3


def test_language_id(spark, nothing):
    rng = random.Random(1)
    syllables = {"aa": ["ba", "lo", "mi"], "bb": ["struk", "æn", "dig"]}
    rows = []
    for k in range(200):
        lang = rng.choice(["aa", "bb"])
        text = " ".join("".join(rng.choices(syllables[lang], k=rng.randint(1, 4))) for _ in range(20))
        rows.append((k, text, lang, k))
    rows += [(300, None, "aa", 0), (301, "12 ²  !", "bb", 0), (302, "", None, 0), (303, "漢字", None, 0), (None, "balo", "aa", 0), (0, rows[0][1], "aa", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int")
    found = language_id.identify(docs).collect()
    assert len(found) == len(rows)
    named = {r["doc_id"]: r for r in found}
    for doc, text, lang, _ in rows:
        r = named[doc]
        assert r["held_out"] == (doc is not None and zlib.crc32(str(doc).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        if text is None or not any(c.isalpha() for c in text):
            assert r["lang_pred"] == "und"
        elif lang:
            assert r["lang_pred"] == lang
    assert named[303]["lang_pred"] in syllables
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns
    assert not {300, 301, 302} & {r["doc_id"] for r in kept.collect()} and kept.count() >= 202
    assert language_id.identify(nothing).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_long_words_are_words(spark):
    """Two languages told apart by words of 60 letters alone, made of the same letters and n-grams."""
    words = {"a": "ab" * 15 + "ba" * 15, "b": "ba" * 15 + "ab" * 15}
    rows = [(k, words[x], x) for k in range(40) for x in "ab"]
    docs = spark.createDataFrame([(k, t, x) for k, (_, t, x) in enumerate(rows)], "doc_id bigint, text string, lang string")
    found = language_id.identify(docs).join(docs, "doc_id").collect()
    assert all(r["lang_pred"] == r["lang"] and r["score"] > 0.6 for r in found)


def test_workers_need_no_installed_package(tmp_path):
    """The functions reach workers that cannot import the package."""
    script = f"""
import sys
sys.path.insert(0, {os.getcwd()!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry
settings = {{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4"}}
spark = SparkSession.builder.master("local[4]").config(map=settings).getOrCreate()
for name in ("op2_decontaminate", "op3_language_id", "op4_co_training", "op11_hard_negatives", "op13_prefix_trie"):
    print(name, entry.queries()[name](spark, "/root/testdata/sf0.001").count())
"""
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=400)
    assert "op3_language_id 200" in done.stdout and "op4_co_training 200" in done.stdout and "op13_prefix_trie" in done.stdout, done.stderr[-2000:]


def test_unseen_words_back_off():
    model = language_id.Model(["a", "b"], {
        0: language_id.Model.table([("a", "word", 9)], ["a", "b"], {"a": 9, "b": 0}),
        **{k: language_id.Model.table([], ["a", "b"], {}) for k in (5, 4, 2, 1)},
        3: language_id.Model.table([("b", "xyz", 5), ("a", "abc", 5)], ["a", "b"], {"a": 5, "b": 5}),
    })
    codes = language_id._codes("word xyz qq")
    scores = model.word_scores(codes, *language_id._runs(codes))
    assert scores[0, 0] > scores[0, 1] and scores[1, 1] > scores[1, 0] and not scores[2].any()


def test_model_counts_everything(spark, monkeypatch):
    long = "qx" * 30
    texts = [("a", "ux uy uz uw zim zim zim zim"), ("b", "u1 om om om ib ib ib ec ec ec zim vykk " + long)]
    texts += [("a", long)]
    docs = spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(texts)], "doc_id bigint, text string, lang string")
    model = language_id.train(docs, model_words=3)
    counts = {x: collections.Counter() for x in "ab"}
    for lang, text in texts:
        for word in "".join(c if c.isalpha() else " " for c in text).split():
            counts[lang].update([(0, word)])
            for k in range(1, 6):
                counts[lang].update((k, f" {word} "[i : i + k]) for i in range(len(word) + 3 - k))
    totals = {(x, k): sum(n for (size, _), n in counts[x].items() if size == k) for x in "ab" for k in range(6)}

    def logs(length, text):
        codes = language_id._codes(text)
        hit, found = model.look_up(length, language_id._run_hashes(codes, np.array([0]), np.array([len(codes)])))
        return found[0] if hit[0] else None

    # Words: ties at the bound are settled, and b's count of a word that only a chose is there.
    known = [w for w in ("zim", "ux", "uy", "uz", "uw", "om", "ib", "ec", "u", "vykk") if logs(0, w) is not None]
    assert len(known) == len(model.tables[0][0]) == 6 and {"zim", "om", "ib", "ec"} <= set(known)
    for k, text in [(0, "zim"), (3, "ykk"), (4, "xqxq"), (5, "vykk "), (1, "x")]:
        entries = len(model.tables[k][0])
        want = [math.log((counts[x][k, text] + 0.5) / (totals[x, k] + 0.5 * (entries + 1))) for x in "ab"]
        assert np.allclose(logs(k, text), want, atol=1e-5), (k, text)


# 4


def test_most_frequent_has_a_short_plan(spark):
    """Bounds are written, not planned again in every branch."""
    counts = spark.range(400).selectExpr("IF(id % 2 = 0, 'a', 'b') AS lang", "0 AS length", "concat('t', id) AS text", "id % 5 AS n")
    found = language_id._most_frequent(counts, 7)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 0
    assert sorted((r["lang"], r["n"]) for r in found.collect()) == [("a", 4)] * 7 + [("b", 4)] * 7


def test_co_training(spark, docs, nothing):
    rng = random.Random(3)
    rows = []
    for k in range(400):
        good = rng.random() < 0.7
        text = " ".join(rng.choice(["alpha", "beta", "gamma"]) + ("" if good else "%%%") for _ in range(30))
        rows.append((k, text, "xx", "s1" if good ^ (rng.random() < 0.1) else "s2", len(text), int(good)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, good int")
    labels = table.where("doc_id % 2 = 0").selectExpr("doc_id", "good AS quality", "0 AS toxic")
    scored = quality.score_quality(table, labels).join(table, "doc_id").where("doc_id % 2 = 1").collect()
    assert np.mean([(r["score"] > 0.5) == r["good"] for r in scored]) > 0.97
    assert all(0 <= r[c] <= 1 for r in scored for c in ("score", "text_score", "metadata_score"))
    odd = quality.score_quality(docs, labels.limit(0)).collect()
    assert len(odd) == docs.count() and all(math.isclose(r["score"], 0.5) for r in odd)
    assert quality.score_quality(nothing, labels).count() == 0


def test_co_training_joins_labels_once(spark, docs, monkeypatch):
    """The rounds read features marked by their labels: no round shuffles them, and null labels count as labels."""
    labels = spark.createDataFrame([(1, None), (2, 1), (2, 0), (3, 1), (None, 1)], "doc_id bigint, quality int")
    table = spark.range(60).selectExpr("IF(id < 50, id, NULL) AS doc_id", "concat('a ', id) AS text", "'x' AS lang", "'s' AS source", "id AS n_chars")
    marked = quality.features(table.unionAll(table.where("doc_id = 2")), labels)
    assert marked.where("named").count() == 4 and marked.count() == 61
    pools = []
    monkeypatch.setattr(quality, "_surest", lambda pool, *rest: pools.append(pool) or [{}, {}])
    quality.co_train(marked, labels)
    assert "Join" not in pools[0]._jdf.queryExecution().optimizedPlan().toString() and pools[0].count() == 57


# 5


PAGES = [
    ("<article><h1>T  i</h1><p>one &amp; <b>two</b><p>three<br>four</article>", "T i\n\none & two\n\nthree four"),
    ("<nav><ul><li>Home<li>Shop</ul></nav><div id=main><p>A long paragraph of the text of this page.</p><p>Ok.</p></div>"
     "<div class='comments'><p>A reader's long comment on the text of this page.</p></div><footer>c</footer>",
     "A long paragraph of the text of this page.\n\nOk."),
    ("<article>x<script>var a='</p>'</script> y<style>p{}</style><form>name</form></article><aside>z</aside>", "x y"),
    ("plain &eacute; text", "plain é text"), ("<article><p>cut off <b", "cut off"), ("", ""), (None, ""), ("<p> </p>", ""),
]


def test_html_text(spark):
    pages = spark.createDataFrame([(k, None, h, k) for k, (h, _) in enumerate(PAGES)] * 2, "page_id bigint, url string, html string, text int")
    found = html_text.extract_text(pages).collect()
    assert len(found) == 2 * len(PAGES)
    assert all(r["text"] == PAGES[r["page_id"]][1] and r["n_chars"] == len(r["text"]) for r in found)
    assert html_text.extract_text(pages.limit(0)).count() == 0


LINE = "A usual line of some twenty words of plain text that stands in its section of a page, no more than that."
SECTIONS = [f"<section><h2>Part {k}</h2><p>{LINE} {k}</p><ul><li>item {k} a</li><li>item {k} b</li></ul></section>" for k in range(12)]
SECTIONS[5] += f"<div><p>{LINE * 300}</p></div>"
LINKS = "<div>" + "".join(f"<div><a href='/{k}'>Another page {k}</a></div>" for k in range(8)) + "</div>"


@pytest.mark.parametrize("around", ["{}", "<div>{}</div>", "<main>{}</main>"])
def test_one_long_line_hides_no_section(around):
    body = "".join(SECTIONS) + "<table><tr><td>x</td><td>1</td></tr></table>"
    found = html_text.main_text(f"<body>{LINKS}{around.format(body)}{LINKS}</body>").split("\n\n")
    assert found[0] == "Part 0" and found[-2:] == ["x", "1"]
    for k in range(12):
        assert {f"Part {k}", f"{LINE} {k}", f"item {k} a", f"item {k} b"} <= set(found)
    assert LINE * 300 in found and not any("Another page" in line for line in found)


def test_every_article_counts():
    found = html_text.main_text(f"<article><p>{LINE * 200}</article><article><h2>Short</h2><p>A few words.</article>")
    assert found.split("\n\n")[1:] == ["Short", "A few words."]


def test_marks_alone_drop_nothing_of_an_article():
    kept = ["The title", f"{LINE} 1", "Searching", f"{LINE} 2", f"{LINE} 3", f"{LINE} 4", "Discussion", f"{LINE} 5"]
    page = (
        "<article><div class='article-header'><h1>The title</h1><span>By one</span></div><p>{1}</p>"
        "<section id='search'><h2>Searching</h2><p>{3}</p></section><p class='notice'>{4}</p>"
        "<div class='share'><a href='x'>Share this page with everybody you know</a></div>"
        "<div class='related'><h3>More</h3><ul><li><a href='y'>Another page of this site, at length</a></li></ul></div>"
        "<section id='social-impact'><p>{5}</p></section><section id='discussion'><h2>Discussion</h2><p>{7}</p></section>"
        "<div class='comments'><p>A reader's long comment on the text of this page.</p></div></article>"
    ).format(*kept)
    assert html_text.main_text(page).split("\n\n") == kept


GOOD = [f"An ordinary sentence number {k} of an article, long enough to be a paragraph of a page by itself." for k in range(6)]
TEXT = "".join(f"<p>{line}</p>" for line in GOOD)
ALL = "\n\n".join(GOOD)
KEPT = [
    "<form id='aspnetForm'><div>{}</div></form>", "<form><article>{}</article></form>", "<div class='page-header-layout widget'>{}</div>",
    "<div id='social-science'>{}</div>", "<div class='related'>{}</div>", "<div class='notice'>{}</div>",
    "<article><section class='comment'>{}</section></article>", "<article><div class='comment-on-law'>{}</div></article>",
    "<div class='sidebar-left-layout'><article>{}</article></div>", "<article><div class='adventure'>{}</div></article>",
    "<div class='no-sidebar with-banner'>{}</div>", "<div class='newsletter'><article>{}</article></div>",
]
GONE = [
    "<div class='ad'>{}</div>", "<div class='newsletter'><p>{}</p></div>", "<div class='cookie-notice'>{}</div>", "<div class='ad-slot advert'>{}</div>",
    "<div class='user-reviews'><p>{}</p><p>{}</p></div>", "<div class='comments'><p>{}</p></div>",
    "<ul><li class='comment'>{}</li><li class='comment'>{}</li></ul>", "<div class='related'><a href='x'>{}</a></div>",
    "<form>Name <input> Mail <input> <button>Send</button></form>", "<div class='share'><a href='y'>Share</a> <a href='z'>Print</a></div>",
]
OUTSIDE = "An aside of some length that is no part of the article, however much it may look like a part of it."


@pytest.mark.parametrize("around", KEPT)
def test_names_do_not_empty_a_page(around):
    assert html_text.main_text(f"<body><nav><a href='/'>Home</a></nav>{around.format(TEXT)}<footer>f</footer></body>") == ALL


@pytest.mark.parametrize("inside", [True, False])
@pytest.mark.parametrize("part", GONE)
def test_what_is_no_article_goes(part, inside):
    part = part.format(*[OUTSIDE] * part.count("{}"))
    page = f"<article>{TEXT}{part}</article>" if inside else f"{part}<article>{TEXT}</article>{part}"
    assert html_text.main_text(page) == ALL


def test_one_code_comment_and_formulas_stay():
    found = html_text.main_text(f"<article>{TEXT}<p class='code-comment'>{OUTSIDE}</p><p>so <math><mi>x</mi> = 1</math> holds</p></article>")
    assert found == ALL + f"\n\n{OUTSIDE}\n\nso x = 1 holds"


@pytest.mark.parametrize("page", ["<div>x " * 100_000, "<span>" * 150_000 + "x", "<div><span>a<b>" * 60_000, "<ul><li><a href=x>" * 50_000, "</div>" * 200_000])
def test_deep_pages_take_linear_time(page):
    start = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - start < 8


def test_a_plain_extractor_agrees_on_well_formed_pages():
    rng = random.Random(3)
    for _ in range(60):
        tree, expected = brute.page(rng)
        assert html_text.main_text(tree) == expected


# 6


@pytest.mark.parametrize("range_rows", [5000, 4])
def test_mixing(docs, rows, nothing, range_rows):
    found = mixing.taken_words(docs, range_rows=range_rows).collect()
    assert len(found) == len(rows)
    taken = {}
    for r in found:
        assert r["taken"] % max(1, r["size"]) == 0 and 0 <= r["taken"] <= 3 * r["size"]
        taken.setdefault((r["source_size"], r["target"]), []).append((r["taken"], r["size"]))
    total = sum(s for x in taken.values() for _, s in x)
    assert math.isclose(sum(t for _, t in taken), total)
    assert sum(t for x in taken.values() for t, _ in x) <= total
    for (size, target), own in taken.items():
        assert target <= 3 * size + 1e-9
        assert abs(sum(t for t, _ in own) - target) <= 2 * max(s for _, s in own)
    again = mixing.taken_words(docs.repartition(5), range_rows=7).collect()
    assert sorted(map(tuple, found), key=key) == sorted(map(tuple, again), key=key)
    mixed = mixing.mix_sources(docs, range_rows=range_rows)
    assert mixed.columns == docs.columns
    words = mixed.select(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert words == sum(r["taken"] for r in found)
    assert mixing.taken_words(nothing).count() == 0 and mixing.mix_sources(nothing).count() == 0


# 7


@pytest.mark.parametrize("small", [16, 2])
def test_jaccard_join(docs, rows, nothing, monkeypatch, small):
    monkeypatch.setattr(jaccard_join, "FREQUENT", small)
    monkeypatch.setattr(regions, "BLOCK", 8 * small)
    found = jaccard_join.near_duplicates(docs)
    same(found, found.columns, brute.near([r[:2] for r in rows]))
    assert jaccard_join.near_duplicates(nothing).count() == 0
    kept = jaccard_join.keep_one_of_each(docs)
    own = {d for d, _, c in brute.near([r[:2] for r in rows]) if d == c}
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(own - {None})


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 360)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    parent = {x: x for link in links for x in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = sorted((root(a), root(b)))
        parent[rb] = ra
    assert found == {x: root(x) for link in links if link[0] != link[1] for x in link}


# 8


def test_order_minhash(docs, rows, nothing):
    found = order_minhash.edit_report(docs).collect()
    assert len(found) == len(rows)
    ordered = sorted((r[:2] for r in rows if r[0] not in (3, None)), key=lambda r: -r[0])
    nexts = {doc: nxt for (doc, _), (_, nxt) in zip(ordered, ordered[1:], strict=False)}
    prints = collections.defaultdict(set)
    texts = dict(r[:2] for r in rows)
    for r in found:
        text = texts[r["doc_id"]] or ""
        prints[text].add(r["fingerprint"])
        assert r["n_chars"] == len(text)
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if r["doc_id"] in nexts and r["doc_id"] not in (4, 3):
            third = len(text) // 3
            edited = text[: len(text) - third] + (nexts[r["doc_id"]] or "")[:third]
            assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert all(len(p) == 1 for p in prints.values())
    assert order_minhash.edit_report(nothing).count() == 0


def test_order_minhash_sees_order(spark):
    rng = random.Random(4)
    words = [f"w{rng.random()}" for _ in range(300)]
    swapped = words[150:] + words[:150]
    texts = [words, words[:290] + ["new"] * 10, swapped, [f"v{k}" for k in range(300)]]
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "k int, text string")
    signed = frame.select("k", order_minhash.signature(F.col("text")).alias("sig"))
    first = signed.where("k = 0").selectExpr("sig AS other")
    near = dict(map(tuple, signed.crossJoin(first).select("k", order_minhash.likeness(F.col("sig"), F.col("other"))).collect()))
    assert near[0] == 1 and near[1] > near[2] > near[3] == 0


def likenesses(spark, texts):
    """Likeness of each text to the first one."""
    frame = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    signed = frame.select("k", order_minhash.signature(F.col("text")).alias("sig"))
    first = signed.where("k = 0").selectExpr("sig AS other")
    near = signed.crossJoin(first).select("k", order_minhash.likeness(F.col("sig"), F.col("other"))).collect()
    return [value for _, value in sorted(map(tuple, near))]


@pytest.mark.parametrize("size", [20, 40, 60, 75])
def test_short_texts_see_order(spark, size):
    rng = random.Random(size)
    words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    half = size // 2
    edited = [*words[:half], "new", *words[half + 1 :]]
    near = likenesses(spark, [" ".join(w) for w in (words, edited, words[half:] + words[:half], [f"v{k}" for k in range(size)])])
    assert near[0] == 1 and near[1] > near[2] + 0.05 and near[2] < 0.85 and near[3] < 0.3


def test_an_edit_of_unspaced_text_moves_nothing_else(spark):
    rng = random.Random(1)
    text = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(2400))
    near = likenesses(spark, [text, "x" + text, text[:1000] + text[1003:], text[1200:] + text[:1200], text[::-1]])
    assert near[1] > 0.8 and near[2] > 0.8 and near[3] < near[2] and near[4] < 0.3


def test_likeness_is_that_of_a_plain_order_minhash(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(40)}" for _ in range(120)]
    others = [base]
    for edits in (1, 5, 15, 40):
        own = list(base)
        for _ in range(edits):
            own[rng.randrange(len(own))] = f"n{rng.randrange(10**6)}"
        others.append(own)
    others += [base[60:] + base[:60], base[:60], base + base]
    found = likenesses(spark, [" ".join(w) for w in others])
    for value, own in zip(found, others, strict=True):
        assert abs(value - brute.order_likeness(base, own, picked=order_minhash.PICKED)) < 0.2


@pytest.mark.parametrize("size", [1, 3, 7])
def test_neighbours_over_ranges(spark, monkeypatch, size):
    """Ranges of few rows, an id with a third of all rows, and many rows without an id."""
    monkeypatch.setattr(order_minhash, "RANGE_ROWS", size)
    rows = [(k * 7 % 40, f"t{k}") for k in range(40)] + [(20, f"hot {k}") for k in range(40)] + [(None, f"none {k}") for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    line = [r["text"] for r in sorted(hashed, key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), r["h"]))]
    found = order_minhash.with_next(docs, lambda d: d, ["text"]).collect()
    assert {r["text"]: r["next_text"] for r in found} == dict(zip(line, [*line[1:], line[0]], strict=True))


# 9


@pytest.mark.parametrize("group, part", [(4 << 20, 8 << 20), (2_000, 1_500), (1, 8 << 20)])
def test_substring_dedup(docs, rows, nothing, monkeypatch, group, part):
    monkeypatch.setattr(substring_dedup, "GROUP_BYTES", group)
    monkeypatch.setattr(substring_dedup, "PART_BYTES", part)
    found = substring_dedup.remove_repeats(docs)
    expected = brute.repeats([r[:2] for r in rows])
    same(found, ["doc_id", "n_words", "n_removed", "kept_sha256"], expected)
    assert sum(r[2] for r in expected) > 1000
    assert substring_dedup.remove_repeats(nothing).count() == 0


def test_groups_of_texts_are_small_in_files(spark, monkeypatch):
    """However many groups a task writes, a reader takes in a few of them at once."""
    steps, write = [], substring_dedup.write_once
    monkeypatch.setattr(substring_dedup, "write_once", lambda *a, **b: steps.append(write(*a, **b)) or steps[-1])
    text = F.repeat(F.concat(F.lpad(F.col("id").cast("string"), 300, "x"), F.lit(" ")), 3_000)
    docs = spark.range(0, 40, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"))
    found = substring_dedup.remove_repeats(docs).collect()
    assert {(r["n_words"], r["n_removed"]) for r in found} == {(3_000, 0)} and len(found) == 40
    files = Path(steps[0].step_path.removeprefix("file:")).glob("*.parquet")
    runs = [f.row_group(k).total_byte_size for f in map(pq.read_metadata, files) for k in range(f.num_row_groups)]
    assert sum(runs) > 35e6 and max(runs) < 5 * substring_dedup.GROUP_BYTES


def test_cover_has_every_difference():
    cover = substring_dedup.COVER
    assert {(a - b) % substring_dedup.PERIOD for a in cover for b in cover} == set(range(substring_dedup.PERIOD))


# 10


def test_warc_fixity(spark, tmp_path):
    rows = [(k, f"http://h/{k}\r\nx", f"<p>{'ö' * (k * 7 % 300)} {k}") for k in range(400)]
    rows += [(400, None, None), (None, "u", ""), (7, "again", "<p>" + "y" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(2)
    warc_fixity.write_archive(pages, str(tmp_path / "a"), "trial")
    hurt = F.when(F.col("page_id").isin(5, 333), F.concat(F.lit("#"), F.col("html").substr(F.lit(2), F.lit(10**6))))
    warc_fixity.write_archive(pages, str(tmp_path / "b"), "trial", stored=hurt)
    a, b = (warc_fixity.read_archive(spark, str(tmp_path / x)) for x in "ab")
    read = a.collect()
    assert len(read) == len(rows) and all(r["payload"] == r["stated"] for r in read)
    want = collections.Counter(hashlib.sha256((h or "").encode()).hexdigest() for _, _, h in rows)
    assert collections.Counter(r["payload"] for r in read) == want
    found = warc_fixity.audit(a, b).collect()
    assert sorted(r["page_id"] for r in found) == [5, 333]
    assert all(r["status"] == "differs" and r["ours_sound"] and not r["theirs_sound"] for r in found)
    assert warc_fixity.audit(a, a).count() == 0
    short = b.where("page_id <> 17 OR page_id IS NULL")
    assert {(r["page_id"], r["status"]) for r in warc_fixity.audit(a, short).collect()} == {(5, "differs"), (333, "differs"), (17, "missing")}
    none = a.where("false")
    assert warc_fixity.audit(none, none).count() == 0
    assert {r["status"] for r in warc_fixity.audit(none, a).collect()} == {"extra"}


def test_pages_that_quote_archives(spark, tmp_path):
    quote = "WARC/1.1\r\nWARC-Filename: trial.warc\r\nWARC-Type: response\r\n\r\n"
    pages = spark.createDataFrame([(1, "u", quote + "x" + quote), (2, "u", "y")], "page_id bigint, url string, html string").coalesce(1)
    warc_fixity.write_archive(pages, str(tmp_path / "a"), "trial")
    about = spark.read.text(str(tmp_path / "a" / "warcinfo")).collect()
    first = spark.read.option("lineSep", "\x00").text(str(tmp_path / "a" / "records")).first()[0]
    assert any("warcinfo" in r.value for r in about)
    # Even a page that holds the name of another archive.
    again = spark.createDataFrame([(3, first, first), (4, "u", "y")], "page_id bigint, url string, html string").coalesce(1)
    warc_fixity.write_archive(again, str(tmp_path / "b"), "trial")
    for name, n in (("a", 2), ("b", 2)):
        read = warc_fixity.read_archive(spark, str(tmp_path / name)).collect()
        assert len(read) == n and all(r["payload"] == r["stated"] for r in read)


def test_extra_columns_of_pages_are_left_out(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "h", 5, "f", 7)], "page_id bigint, url string, html string, offset int, file string, record int")
    warc_fixity.write_archive(pages, str(tmp_path / "a"), "trial")
    read = warc_fixity.read_archive(spark, str(tmp_path / "a"))
    assert [(r["page_id"], r["offset"]) for r in read.collect()] == [(1, 0)]


def test_audit_after_shifts(spark, tmp_path):
    rows = [(k, None, f"<p>{'y' * (k * 37 % 900)} {k}") for k in range(1200)] + [(50, None, "<p>twice")] * 3
    columns = "page_id bigint, url string, html string"
    pages = spark.createDataFrame(rows, columns).coalesce(1)
    shorter = F.when(F.col("page_id") == 20, F.lit("<p>")).when(F.col("page_id") == 700, F.concat("html", F.lit("more")))
    added = spark.createDataFrame([(5000, None, "new")], columns)
    lost = pages.where("page_id <> 300").union(added).coalesce(1)
    turned = spark.createDataFrame([rows[1], rows[0], *rows[2:]], columns).coalesce(1)
    read = {}
    for name, frame, stored in (("a", pages, None), ("b", lost, shorter), ("c", turned, None), ("d", pages.limit(1202), None)):
        warc_fixity.write_archive(frame, str(tmp_path / name), "trial", stored=stored)
        read[name] = warc_fixity.read_archive(spark, str(tmp_path / name))
    found = warc_fixity.audit(read["a"], read["b"]).collect()
    assert sorted((r["page_id"], r["status"]) for r in found) == [(20, "differs"), (300, "missing"), (700, "differs"), (5000, "extra")]
    assert all(not r["theirs_sound"] and r["ours_sound"] for r in found if r["status"] == "differs")
    found = warc_fixity.audit(read["a"], read["c"]).collect()
    assert {(r["page_id"], r["status"]) for r in found} == {(0, "moved"), (1, "moved")}
    assert [(r["page_id"], r["status"]) for r in warc_fixity.audit(read["a"], read["d"]).collect()] == [(50, "missing")]
