"""Words, quality rules, language identification and HTML extraction."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm.cases import SYLLABLES, corpus, text
from hypothesis import given, settings
from hypothesis import strategies as st

from wattline.llm import html, langid, quality
from wattline.llm import text as X

TEXTS = st.lists(st.text(alphabet=" \t\n\x0b\x0c\rabcABÉé日\x00\xa0 ", max_size=40), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    buf, off = X.utf8(pa.array(texts, pa.string()))
    s, e, row, h, chars = X.words(buf, off)
    raw = buf.tobytes()
    got = [(int(r), raw[a:b].decode()) for a, b, r in zip(s, e, row, strict=True)]
    want = [(i, w) for i, t in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0D]+", t)]
    assert got == want
    assert chars.tolist() == [len(w) for _, w in want]
    same = {}
    for (_, w), v in zip(want, h.tolist(), strict=True):
        assert same.setdefault(w, v) == v
    assert len(set(same.values())) == len(same)
    assert X.count_words(buf, off).tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts]


def test_words_across_chunks(monkeypatch):
    monkeypatch.setattr(X, "CHUNK", 64)
    t = [x or "" for _, x in corpus(seed=4, n=8) if len(x or "") < 9000]
    buf, off = X.utf8(pa.array(t))
    monkeypatch.undo()
    whole = X.words(buf, off, lower=True)
    monkeypatch.setattr(X, "CHUNK", 64)
    for a, b in zip(X.words(buf, off, lower=True), whole, strict=True):
        assert (a == b).all()


def brute_quality(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    where = {}
    for i in range(len(words) - 7):
        where.setdefault(tuple(words[i:i + 8]), []).append(i)
    cover = {i + j for at in where.values() if len(at) > 1 for i in at for j in range(8)}
    lines, seen, dup = (t or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(cover) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(cover), failed)


def test_quality_figures_equal_brute_force(frame):
    rows = corpus(seed=9) + [(9001, "a | b # $ % & * < >"), (9002, "x\r\nx\r\nx\nx"), (9003, "\n\n \n \n")]
    got = quality.repetition_rules(frame(rows).repartition(3)).collect()
    have = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got), key=repr)
    assert have == sorted(((k, *brute_quality(t)) for k, t in rows), key=repr)
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_quality_verdict(frame):
    import random
    rng = random.Random(1)
    clean = text(rng, 300)
    lines = "\n".join(["the very same line of seven words"] * 4 + [text(rng, 60)])
    shout = " ".join(w + "%%%" for w in text(rng, 80).split())
    got = {r["doc_id"]: r["kept"] for r in quality.repetition_rules(frame([(1, clean), (2, lines), (3, shout), (4, None), (5, "")])).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_quality_verdict_does_not_hang_on_length(frame):
    import random
    rng = random.Random(3)
    few = ["".join(rng.choices(SYLLABLES, k=3)) for _ in range(20)]
    passage = text(rng, 3000)
    rows = [(1, text(rng, 400_000)),                                           # clean
            (2, " ".join(rng.choices(few, k=50_000))),                         # few words all along
            (3, "\n".join([passage, text(rng, 3000), passage])),               # a copy further on than a window
            (4, text(rng, 9000) + " " + " ".join(rng.choices(few, k=9000)))]   # half clean
    got = {r["doc_id"]: (r["kept"], r["dup_gram_share"][0]) for r in quality.repetition_rules(frame(rows)).collect()}
    assert {k: kept for k, (kept, _) in got.items()} == {1: True, 2: False, 3: False, 4: False}
    assert got[1][1] < 0.1 and got[2][1] > 0.5


def test_quality_windows_start_with_the_row():
    import random
    rng = random.Random(4)
    texts = [text(rng, n) for n in (700, 5200, 1, 3100)]
    share = lambda t: [s.tolist() for s in quality.measure(*X.utf8(pa.array(t)))["dup_gram_share"]]
    assert share(texts) == [[x for t in texts for x in share([t])[i]] for i in range(len(quality.REPEATED_GRAMS))]


def test_quality_keeps_labelled_good_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1"), "doc_id")
    got = quality.repetition_rules(docs).where("not base_failed").selectExpr("avg(cast(kept as int)) as share").first()["share"]
    assert got > 0.99


def lang_rows(n=400):
    import random
    rng = random.Random(2)
    marks = {"aa": SYLLABLES[:7], "bb": SYLLABLES[7:13], "cc": [*SYLLABLES[13:], "zu", "ya"]}
    rows = []
    for i in range(n):
        lang = sorted(marks)[i % 3]
        words = ["".join(rng.choices(marks[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(8, 120))]
        rows.append((i, " ".join(words), lang))
    return rows


def test_language_held_out_accuracy(frame):
    rows = lang_rows()
    docs = frame(rows)
    model = langid.fit(docs.where(~langid.held_out()), dictionary_bytes=20_000)
    got = {r["doc_id"]: r for r in langid.classify(docs, model).collect()}
    held = [(k, lang) for k, _, lang in rows if zlib.crc32(str(k).encode()) % 3 == 1]
    assert len(held) > 80
    assert np.mean([got[k]["lang_pred"] == lang for k, lang in held]) > 0.97
    assert all(0.0 <= r["score"] <= 1.0 for r in got.values())
    assert np.mean([r["accepted"] for r in got.values()]) > 0.97


def test_language_on_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = langid.held_out()
    got = langid.classify(docs.withColumn("held", held), langid.fit(docs.where(~held)), keep=("held", "lang"))
    share = got.where("held").selectExpr("avg(cast(lang = lang_pred as int)) as a").first()["a"]
    assert share > 0.95


def test_language_sizes_equal_zstandard(frame):
    import zstandard
    rows = lang_rows(120) + [(900, "kalo", None), (901, "k", None), (902, "toterkalo " * 400, None)]
    docs = frame(rows)
    model = langid.fit(docs.where("doc_id < 900"), dictionary_bytes=8000)
    want = {}
    for key, t, _ in rows:
        data = re.sub(r"[\W\d_]+", " ", t.lower()).strip().encode()
        size = {}
        for lang, raw in model.items():
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            c = zstandard.ZstdCompressor(level=9, dict_data=d, write_content_size=False, write_checksum=False)
            size[lang] = sum(len(c.compress(data[i:i + 1024])) for i in range(0, len(data), 1024))
        low, second = sorted(size.values())[:2]
        want[key] = (next(x for x in model if size[x] == low), 1 - low / second, 1 - low / second >= 0.01)
    got = {r["doc_id"]: (r["lang_pred"], r["score"], r["accepted"]) for r in langid.classify(docs, model).collect()}
    assert got == want and {True, False} == {x[2] for x in want.values()}


def test_language_ties_go_to_the_more_frequent_and_are_rejected():
    model = langid.Classifier({"often": b"one two three", "seldom": b"one two three"})
    assert model.predict(b"one two") == ("often", 0.0, False) and model.predict(b"zzz " * 2000) == ("often", 0.0, False)


def test_language_edge_cases(frame, spark):
    rows = lang_rows(60)
    model = langid.fit(frame(rows), dictionary_bytes=5000)
    odd = [(1000, None, None), (1001, "", None), (1002, "123 !?  ", None), (None, rows[0][1], None), (1003, rows[0][1] * 300, None)]
    got = {r["doc_id"]: (r["lang_pred"], r["accepted"]) for r in langid.classify(frame(odd), model).collect()}
    assert got[1000] == got[1001] == got[1002] == ("und", False)
    assert got[None][0] == got[1003][0] == rows[0][2]
    empty = frame(rows).where("false")
    assert langid.fit(empty) == {} and langid.classify(empty, {}).count() == 0
    assert langid.classify(frame(rows), {}).where("lang_pred <> 'und'").count() == 0
    unlabelled = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert langid.fit(unlabelled) == {}


BODY = "It was a long day on the river and the boats came home late in the rain. " * 3
PAGES = [
    (f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li><a href=x>Menu</a></li></ul></nav>"
     f"<article><h1>Head &amp;amp; line</h1><p>{BODY}<br>Short.</p><p>End&nbsp;\n of it</p></article><footer>&copy; foot</footer>",
     f"Head &amp; line {BODY.strip()} Short. End of it"),
    (f"<body class='page no-ads'><div class='sidebar'>side</div><div id=content><p>{BODY}</p>\n<p>{BODY}</p></div>"
     "<div class='reader comments'><p>first!</p></div><form><p>mail</p></form><div class='cookie-notice'>ok?</div>",
     f"{BODY.strip()} {BODY.strip()}"),
    (f"<script>var a = '<p>no</p>';</script><p>{BODY}<p>unclosed <b>bold<p>next<aside>x<p>y</aside> tail", f"{BODY.strip()} unclosed bold next tail"),
    (f"<main><p>{BODY}</p><div class='ad'>Buy</div><p>After.</p></main><p>{BODY}</p>", f"{BODY.strip()} After."),
    ("plain text only", "plain text only"),
    ("<!-- a --><!-- b", ""), ("", ""), (None, ""), ("<div><p></p></div>", ""), ("a < b & c", "a < b & c"),
    ("<nav>only furniture here</nav>", "only furniture here"),
]


@pytest.mark.parametrize("page,want", PAGES)
def test_html_main_text(page, want):
    assert html.main_text(page) == want


@pytest.mark.parametrize("page,want", [
    (f"<div><h1>Title</h1></div><div><p>{BODY}</p></div>", f"Title {BODY.strip()}"),
    (f"<div><div><div><h2>Head</h2></div></div></div><div><div><p>{BODY}</p></div></div><div><div><p>End.</p></div></div>",
     f"Head {BODY.strip()} End."),
    (f"<div><p>{BODY}</p></div><div><p>One.</p></div><div><p>Two.</p></div><div><p>{BODY}</p></div>",
     f"{BODY.strip()} One. Two. {BODY.strip()}"),
    (f"<div><table><tbody><tr><td>a</td><td>1</td></tr>\n<tr><td><p>b</p></td><td>2</td></tr></tbody></table></div><div><div><p>{BODY}</p></div></div>",
     f"a 1 b 2 {BODY.strip()}"),
    (f"<div><p>{BODY}</p></div><nav><ul><li>m</li><li>n</li></ul></nav><div><p>Between.</p></div><form><p>mail</p></form><div><p>{BODY}</p></div>",
     f"{BODY.strip()} Between. {BODY.strip()}"),
])
def test_html_short_blocks_without_a_container(page, want):
    assert html.main_text(page) == want


LONG = f"<div><p>{BODY}</p><p>{BODY}</p></div>"
TWICE = f"{BODY.strip()} {BODY.strip()}"


@pytest.mark.parametrize("page,want", [
    (f"<article>Teaser</article>{LONG}", TWICE),                                       # a container that is no main text
    (f"{LONG}<article><a href=x>One more</a></article><article><a href=y>And more</a></article>", TWICE),
    (f'<div class="content no-sidebar">{BODY}</div><p>small</p>', f"{BODY.strip()} small"),
    (f"<div class='ad-free'>{BODY}</div><div class='ad-slot-2'>{BODY}</div><div class='page_footer'>{BODY}</div>", BODY.strip()),
    (f"<div>Home News Sport</div><div>About us</div><h1>Title</h1>{LONG}<div>© 2024 Someone. All rights reserved.</div>", f"Title {TWICE}"),
    (f"<div><a href=/>Home</a> <a href=/n>News and much more text than that, all of it in links to other pages of this site</a></div>{LONG}", TWICE),
    (f"<article><h1>A</h1><p>{BODY}</p></article><p>By the way.</p><article><h1>B</h1><p>{BODY}</p></article>", f"A {BODY.strip()} B {BODY.strip()}"),
    (f"<main><article><p>{BODY}</p></article><article>Short.</article></main>", f"{BODY.strip()} Short."),
    (f"<article><p>{BODY}</p></article><article><h3>Next</h3></article>", BODY.strip()),
    ("<article>Be.</article><p>Nothing much.</p>", "Be."),
    (f"<article>A word.</article>{LONG * 3}", f"{TWICE} {TWICE} {TWICE}"),
    (f"<p>Short start.</p><p>And on.</p><p>Then.</p><p>Now.</p>{LONG}<p>So.</p><p>It.</p><p>Was.</p><p>Done.</p>",
     f"Short start. And on. Then. Now. {TWICE} So. It. Was. Done."),
    (f"<p>Lead.</p><aside>x</aside><p>{BODY}</p><div class=ad>y</div><p>Tail.</p>", f"Lead. {BODY.strip()} Tail."),
    (f"<p><a href=x>{BODY}</a></p>", BODY.strip()),
])
def test_html_surge_and_dive_decide(page, want):
    assert html.main_text(page) == want


def test_html_names_of_furniture():
    yes = "ad ad-slot ad_banner cookie-notice site-header sidebar-left comment-list related_posts nav-2".split()
    no = "no-sidebar ad-free header-less content main-content shared-ideas adverb post page-1 with-comments-off".split()
    assert [n for n in yes if not html.names_furniture(n)] == [] and [n for n in no if html.names_furniture(n)] == []


def test_html_table(spark):
    rows = [(i, f"http://h/{i}", p) for i, (p, _) in enumerate(PAGES)] + [(None, None, "<p>x</p>"), (0, "http://h/0", PAGES[0][0])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' as text", "1 as n_chars")
    got = html.extract(df.repartition(2)).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert sorted(r["text"] for r in got) == sorted([w for _, w in PAGES] + ["x", PAGES[0][1]])
    assert html.extract(df.where("false")).count() == 0


def test_html_on_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in html.extract(pages, keep=("page_id", "html")).collect():
        body = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        import html as H
        body = re.sub(r"</?b>", "", body)
        assert r["text"] == " ".join(H.unescape(re.sub(r"<[^>]*>", " ", body)).split())


def test_html_odd_markup_ends(spark):
    assert html.main_text("<p>" * 20000 + "x") == "x"
    assert html.main_text("<a title=\"" * 2000) is not None
    assert html.main_text("<script>" + "x" * 100000) == ""


def test_line_blocks():
    lengths = np.array([0, 0, 30, 90, 0, 0, 0, 0, 5, 0, 0, 0])
    assert html.blocks(lengths) == [(2, 4, 120), (8, 9, 5)]
