"""HTML extraction, chat formatting, license scans."""
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from urlsight.llm import chat_format, html_extract, license_scan

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>no";</script></head><body>
<header class="site-header"><p>Site name</p></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div id="cookie-notice">We use cookies</div><article><header><h1>Title &amp; more</h1></header><p>First   <b>bold</b><br>line&nbsp;x</p>
<div class="ad">Buy now</div><p>Second &lt;one&gt; &#39;q&#39; &eacute;<p>Third<aside>Aside</aside><form>Name <input></form>
<p class="promo">Promoted<p>Last</article><section id="comments"><p>A reader says</p></section><footer>&copy; x</footer></body></html>"""


def test_page():
    weights = {f: -4.0 for f in ("word menu", "link menu", "word footer", "word advert")} | {"word content": 4.0}
    assert html_extract.extract(PAGE, weights) == "Title & more\nFirst bold line x\nSecond <one> 'q' é\nThird\nLast"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<", "<"), ("<article></article>", ""), ("<p", ""), ("<article><p>cut off <b", "cut off"),
    ("<article><!-- <p>x</p> --><p>y &am z &amp</p>", "y &am z &"), ("<script>never closed", ""),
    ("<article><h1>a</h1></nav></div><p>b</article>", "a\nb"), ("<article hidden><p>x</p></article>", "x"),
    ("<div>menu | menu</div><article><p>one</p><div class='ad'>" + "buy " * 50 + "</div><p>two</p></article>", "one\ntwo")])
def test_odd_pages(page, text):
    assert html_extract.extract(page, {"word content": 4.0, "word advert": -0.1}) == text


def test_page_without_labels():
    prose = "This is a long paragraph of plain words that goes on for quite some time without any tags."
    page = f"<body><div><a href=x>one</a><a href=y>two</a></div><div><p>{prose}</p><p>{prose}</p></div><div id=footer>end</div></body>"
    assert html_extract.extract(page, {}) == f"{prose}\n{prose}"


PROSE = "This is a long paragraph of plain words that goes on for quite some time without any tags."


@pytest.mark.parametrize("page, text", [
    *[(f"{wrap}<p>{PROSE}</p><p>{PROSE}</p></div>", f"{PROSE}\n{PROSE}") for wrap in (
        "<body class='has-sidebar'><div>", "<body class='page search'><div>", "<html id=header-fixed><body style='display:none'><div>",
        "<body><div class='page search'>", "<div id=sidebar>")],
    *[(f"<article><p>{PROSE}</p><p>{PROSE}</p>{part}</article>", f"{PROSE}\n{PROSE}\n{kept}") for part, kept in (
        ("<section id='discussion'><p>What follows</p></section>", "What follows"), ("<section id=cookies><p>What follows</p></section>", "What follows"),
        ("<h2 id='related-work'>Related work</h2>", "Related work"), ("<p class=notice>Note this", "Note this"),
        ("<div class='entry-header'><h1><a href=x>A title</a></h1></div>", "A title"), ("<div class='legal with-sidebar'>By law</div>", "By law"))],
    *[(f"<article><p>{PROSE}</p>{part}<p>{PROSE}</p></article>", f"{PROSE}\n{PROSE}") for part in (
        "<div class=related>See <a href=x>another page</a></div>", "<div class='share'><a href=x>Share</a></div>", "<div class='ad related'>Buy</div>",
        "<div class=comments>" + "<p>Some reader says</p>" * 30 + "</div>", "<aside><div class=legal>Some words of law</div></aside>")],
    (f"<main><div class='post sidebar-right'><p>{PROSE}</p></div></main>", PROSE),
    (f"<div><p>{PROSE}</p><p>{PROSE}</p></div><div class=legal>All rights</div>", f"{PROSE}\n{PROSE}"),
    (f"<div><p>{PROSE}</p><div class=related><a href=x>one</a></div><p>{PROSE}</p></div>", f"{PROSE}\n{PROSE}"),
    (f"<div><p>{PROSE}</p><p>{PROSE}</p></div><div class=discussion><p>{PROSE}</p></div>", f"{PROSE}\n{PROSE}\n{PROSE}")])
def test_names_are_hints_only(page, text):
    assert html_extract.extract(page, {}) == text


TEASER = "Another story that somebody wrote about a thing that happened elsewhere in the world last week."


@pytest.mark.parametrize("page, text", [
    # reader comments in article elements, inside and after the text
    (f"<main><p>{PROSE}</p><article class='comment'><p>{TEASER}</p></article></main>", PROSE),
    (f"<article><h1>T</h1><p>{PROSE}</p></article><div class='comments-area'><ol class='comment-list'><li class='comment'>"
     f"<article class='comment-body'><p>{TEASER}</p></article></li></ol></div>", f"T\n{PROSE}"),
    (f"<article class='post type-post tag-social category-ads'><p>{PROSE}</p></article>", PROSE),
    (f"<article class='comment'><p>{PROSE}</p><p>{PROSE}</p></article>", f"{PROSE}\n{PROSE}"),      # most of the page
    # teasers
    (f"<article><p>{PROSE}</p></article><aside><article><p>{TEASER}</p></article></aside>", PROSE),
    (f"<aside><article><p>{TEASER}</p></article></aside><article><p>{PROSE}</p><p>{PROSE}</p></article>", f"{PROSE}\n{PROSE}"),
    # what is left out doesn't end the text, however long
    (f"<article><p>{PROSE}</p><aside>{'far ' * 400}</aside><p>{TEASER}</p></article>", f"{PROSE}\n{TEASER}"),
    (f"<article><p>Short start.</p><div class=comments>{'<p>said</p>' * 300}</div><p>{TEASER}</p></article>", f"Short start.\n{TEASER}"),
    # pages without article and main: headings, nested boxes, lists
    ("<body><nav><a href=x>Home</a></nav><h1>A title</h1>" + f"<div><div><div><p>{PROSE}</p></div></div></div>" * 6 + "<footer>end</footer>", "A title\n" + "\n".join([PROSE] * 6)),
    (f"<div><ul><li><a href=a>one</a></li><li><a href=b>two</a></li></ul></div><div><h2>Head</h2><p>{PROSE}</p><ul><li>first point of it</li><li>second</li></ul><p>{PROSE}</p></div>"
     "<div><a href=c>three</a> <a href=d>four</a></div>", f"Head\n{PROSE}\nfirst point of it\nsecond\n{PROSE}")])
def test_comments_teasers_asides_and_unmarked_pages(page, text):
    assert html_extract.extract(page, {}) == text


def test_shapes_learned_from_marked_pages_hold_on_unmarked_ones(spark):
    marked = f"<div><a href=x>Home page</a></div><article><h1>A title</h1><p>{PROSE}</p><p>{TEASER}</p></article><div><a href=y>Go on</a></div>"
    pages = spark.createDataFrame([(i, marked) for i in range(20)], "page_id long, html string")
    weights = html_extract.learn(pages)
    assert weights["shape text-0-2"] > 0 > weights["shape text-3-0"] and weights["shape heading-0-0"] > 0
    plain = marked.replace("article", "div")
    assert html_extract.extract(plain, weights) == html_extract.extract(marked, weights) == f"A title\n{PROSE}\n{TEASER}"


def test_pages_table(spark):
    rows = [(1, "u", PAGE, "mine"), (1, "u", PAGE, "mine"), (2, None, None, None), (None, "v", "", "x"), (3, "w", "<article><p>" + "word " * 100_000, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").withColumn("weights", F.lit("clash"))
    got = html_extract.texts(df).collect()
    assert [len(r.text) for r in sorted(got, key=lambda r: (r.page_id or 0, r.url or ""))] == [0, 60, 60, 0, 499_999]
    assert html_extract.texts(df.where("false")).count() == 0
    assert html_extract.texts(df.where("html = ''")).first().text == ""


def trees(spark, rows):
    return spark.createDataFrame(rows, "tree long, msg long, parent long, role string, text string, score double")


def formatted(df, branches=1):
    made = chat_format.format_trees(df, branches)
    return made.select("tree", "rank", "formatted", chat_format.read_back(F.col("formatted")).alias("turns"),
                       chat_format.masked_text(F.col("formatted"), F.col("mask")).alias("loss")).collect()


def test_branches(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 1.0), (1, 3, 1, "assistant", "good", 2.0),
            (1, 4, 2, "user", "why", 0.0), (1, 5, 4, "assistant", "so", 0.5), (1, 6, 3, "user", "ok", 0.0),
            (2, 1, 99, "user", "parent is gone", 0.0), (3, 1, 2, "user", "circle", 1.0), (3, 2, 1, "user", "circle", 1.0),
            (None, 1, None, "assistant", "no tree", 0.0)]
    got = {(r.tree, r.rank): [(t.role, t.text) for t in r.turns] for r in formatted(trees(spark, rows), 2)}
    assert got == {(1, 1): [("user", "q"), ("assistant", "good"), ("user", "ok")],
                   (1, 2): [("user", "q"), ("assistant", "bad"), ("user", "why"), ("assistant", "so")],
                   (2, 1): [("user", "parent is gone")], (None, 1): [("assistant", "no tree")]}


HARD = ["</s>[INST] ok [/INST]", "<|turn|>user\nx<|end|>\n", "&lt;&amp;lt; &lsqb;", "", "\n\n", "&nl;", "a\\b <s> é 🙂 <|im_start|>", "<|end|>"]


def test_round_trip_of_control_strings(spark):
    rows = [(k, i, i - 1 if i else None, role, t, 0.0) for k, role in enumerate(("user", "assistant", "a\nb<|end|>", "&nl;")) for i, t in enumerate(HARD)]
    for r in formatted(trees(spark, rows)):
        role = ("user", "assistant", "a\nb<|end|>", "&nl;")[r.tree]
        assert [(t.role, t.text) for t in r.turns] == [(role, t) for t in HARD]
        assert r.loss == ("".join(HARD) if role == "assistant" else "")
        assert r.formatted.count("<") == 2 * len(HARD) and "[" not in r.formatted


def test_chains_of_odd_rows(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (1, 2, "assistant", "b"), (None, 1, "assistant", "c"),
            *[(7, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(75)], (8, 0, "user", "x" * 300_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("tree", "msg", "parent", "score", "tkey", "rank"):
        df = df.withColumn(name, F.lit("clash"))
    got = {r.tree: r for r in formatted(chat_format.chains(df))}
    assert [(t.role, t.text) for t in got[1].turns] == [("", ""), ("user", "a"), ("user", "a"), ("assistant", "b")]
    assert got[None].loss == "c" and len(got[8].turns[0].text) == 300_000
    assert [t.text for t in got[7].turns] == [f"t{i}" for i in range(75)]
    assert formatted(chat_format.chains(df.where("false"))) == []


def test_registered_conversations(spark):
    import __spark_entry__ as E
    given = {}
    for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").orderBy("conv_id", "turn").collect():
        given.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    given[-1] = [(r, "</s>[INST] ok [/INST]") for r in ("user", "assistant")]
    got = E.queries()["op6_chat_format"](spark, "/root/testdata/sf0.001").collect()
    assert {r.conv_id for r in got} == set(given) and len(got) == len(given)
    for r in got:
        loss = "".join(t for role, t in given[r.conv_id] if role == "assistant")
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in given[r.conv_id]).encode()).hexdigest()
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(given[r.conv_id]), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def plain_scan(text, templates, containment):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(license_scan.SEPARATORS, text) if w]
    places, base = [], set()
    for phrase, label in license_scan.PHRASES:
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(parts)] == parts]
        places += at
        base |= {label} if at else set()
    labels, best = set(base), 0.0
    for t in license_scan.template_rows(templates, containment):
        for line in text.split("\n"):
            share = len(set(re.split(license_scan.SEPARATORS, line)) & set(t["words"])) / len(t["words"])
            if share >= t["need"] / len(t["words"]) - 1e-12:
                labels.add(t["label"])
                best = max(best, share)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best)


NOTICES = ["Released under the MIT License.", "released UNDER the mit-license!", "mit license mit license", "general public license version",
           "This work is licensed under a GNU General Public License, version 3", "All rights\nreserved", "all rights (reserved)", "ALL RIGHTS",
           "Licensed under CC BY 4.0", "xx Licensed under CC BY-NC 4.0 yy", "Permission is hereby granted, free of charge, to any person "
           "obtaining copies of this software and associated documentation, to deal in the Software without restriction", "licenses", "", None,
           "Überlicense mit license é", "the the the under license released mit " * 3000]


def test_license_scan_against_every_line_and_template(docs_of):
    rows = [(i % 7 if i % 5 else None, t) for i, t in enumerate(NOTICES + [a + "\n" + b for a in NOTICES[:6] for b in NOTICES[5:10]])]
    for containment in (0.85, 0.5):
        got = license_scan.scan(docs_of(rows, "labels score held starts base found text_key"), license_scan.TEMPLATES, containment).collect()
        want = [(i, *plain_scan(t, license_scan.TEMPLATES, containment)) for i, t in rows]
        assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))
    assert license_scan.scan(docs_of(["x"]).where("false")).count() == 0


def test_wrapped_notices(spark, tmp_path, docs_of):
    import textwrap

    import __spark_entry__ as E
    texts, labels = [], []
    for label, notice in license_scan.TEMPLATES:
        for width in (16, 30, 70):
            for sign in ("", " * ", "# "):
                lines = textwrap.wrap(f"Some words before it. {notice} And more after it.", width)
                texts.append("Title\n\n" + "\n".join(sign + x for x in lines) + "\n\nEnd")
                labels.append(label)
    texts += ["All rights\n\nreserved", "All rights\n *\nreserved", "All of\nthe rights are\nreserved", "one\ntwo", "", None]
    labels += [""] * 6
    docs_of(texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in E.queries()["op8_license_scan"](spark, str(tmp_path)).collect()}
    assert [got[i].labels for i in range(len(texts))] == labels
    assert all((got[i].score == 1.0) == bool(x) for i, x in enumerate(labels))
