"""Token counts, chat formatting and text extraction against plain versions."""

import hashlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keelson.llm import chat, counts, html
from keelson.llm.queries import PIECES, vocabulary
from tests.llm import plain
from tests.llm.conftest import random_texts


@pytest.fixture(scope="module")
def pieces():
    return counts.load_pieces(vocabulary(PIECES))


def test_trie_counts_equal_the_full_table(docs, pieces):
    scores = counts.log_probabilities(pieces)
    trie = counts.Trie(counts.piece_ends(scores))
    words = {w for r in docs.select("text").collect() for w in plain.words(r.text) if len(w) < 100}
    words |= {w for t in random_texts(200, "abcdehinorst 你é😀-", 30) for w in plain.words(t)}
    for w in sorted(words):
        want = plain.viterbi(counts.MARK + w, scores, trie.spelled)
        assert trie.insert(counts.MARK + w) == want[1], w
    assert len(trie.best) < sum(len(w) + 1 for w in words)  # prefixes are shared


@pytest.mark.parametrize("nodes", [50, 300_000])
def test_documents_sum_their_words(docs, pieces, nodes):
    scores = counts.log_probabilities(pieces)
    trie = counts.Trie(counts.piece_ends(scores))
    few = docs.where("length(text) < 3000 or text is null")
    want = sorted((str(r.doc_id), len(ws := plain.words(r.text)), sum(trie.insert(counts.MARK + w) for w in ws)) for r in few.collect())
    got = sorted((str(r.doc_id), r.n_words, r.n_tokens) for r in counts.count_tokens(few, pieces, max_nodes=nodes).collect())
    assert got == want


def test_counts_of_an_empty_table(none, pieces):
    assert counts.count_tokens(none, pieces).isEmpty()


TEXTS = ["", None, "plain", "\\", "\\\\<|", "<|im_end|>", "<|im_start|>user\nx", "</s>[INST] ok [/INST]", "a\nb", "é😀<s>", "<", "|", "<<SYS>> <</SYS>>", "<start_of_turn>"]


def test_assembly_round_trip():
    texts = TEXTS + random_texts(600, "<|>\\sINST[]/im_endé😀\n ", 30)
    roles = [["user", "assistant", "system", None, "a\nb\\<|", ""][i % 6] for i in range(len(texts))]
    made, start, end = chat.assemble(pa.array(roles), pa.array(texts))
    for role, text, line, a, b in zip(roles, texts, made.to_pylist(), start, end, strict=True):
        raw = line.encode()
        assert chat.read_turn(raw) == ((role or "").encode(), (text or "").encode())
        assert chat.unescape(raw[a:b]) == (text or "").encode()
        assert not any(c in raw[a:b] for c in chat.CONTROLS)
    sliced, _, _ = chat.assemble(pa.array(roles).slice(3, 5), pa.array(texts).slice(3, 5))
    assert sliced.to_pylist() == made.to_pylist()[3:8]
    assert chat.assemble(pa.array([], pa.string()), pa.array([], pa.string()))[0].to_pylist() == []


def test_conversations_read_back(spark):
    rows = [(i % 7 if i % 11 else None, 100 - i if i % 5 else None, ["user", "assistant", None][i % 3], TEXTS[i % len(TEXTS)]) for i in range(200)]
    rows += [(500, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(3000)] + [(3, 4, "user", "tie b"), (3, 4, "user", "tie a")] * 2
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5).withColumn("formatted", F.lit("own"))
    out = {r.conv_id: r for r in chat.digests(chat.format_turns(df)).collect()}
    by: dict = {}
    for c, t, role, text in rows:
        line, _, _ = chat.assemble(pa.array([role], pa.string()), pa.array([text], pa.string()))
        by.setdefault(c, []).append(((t is not None, t or 0), line[0].as_py(), role or "", text or ""))
    assert set(out) == set(by)
    for c, turns in by.items():
        turns.sort(key=lambda x: (x[0], x[1].encode()))
        r = out[c]
        loss = "".join(x[3] for x in turns if x[2] == "assistant")
        assert r.n_turns == len(turns) and r.turns_sha256 == plain.sha("".join(f"{x[2]}\n{x[3]}\n" for x in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == sum(len(x[1]) for x in turns)


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_turns(df)).isEmpty()


ARTICLE = "".join(f"<p>Paragraph {i} has <b>bold</b> and <a href='/x'>linked</a> words, enough of them to be dense &amp; long.</p>" for i in range(6))
SHELL = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/a>Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><div id="wrap"><aside>Side</aside><div class="post"><h2>Title</h2>{0}</div>
<section class="comments"><p>Nice one, a reader writes with many many words to look like running text of an article.</p></section></div>
<form><p>Search</p><input></form><script>var x = "<p>no</p>";</script><footer>&copy; us</footer></body></html>"""
LINES = ["Title"] + [f"Paragraph {i} has bold and linked words, enough of them to be dense & long." for i in range(6)]


def test_article_without_its_surroundings():
    assert html.extract(SHELL.format(ARTICLE)).split("\n") == LINES
    assert html.extract(SHELL.format(ARTICLE.replace("<p>", "<P>\n").replace("</p>", "")).replace("<p>", "<p> ")).split("\n") == LINES


def test_link_lists_have_low_density():
    links = "".join(f"<li><a href='/{i}'>Some linked headline number {i} with words</a></li>" for i in range(40))
    page = f"<body><div><ul>{links}</ul></div><div>{ARTICLE}</div></body>"
    assert html.extract(page).split("\n") == LINES[1:]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("just text &lt;here&gt;", "just text <here>"),
        ("<p>a  b\n c<br>d</p><p></p><p>e</p>", "a b c d\ne"),
        ("<article><h1>T</h1><p>x &amp; y &#233; &nbsp;z</p><p>cut off &am", "T\nx & y é z\ncut off &am"),
        ("<div class='ad'><div>in</div>ad</div><p>text of it</p>", "text of it"),
        ("<nav><p>menu</nav></p><p>body text</p>", "body text"),
        ("<script>if (a < b) { '</p>' }</script><p>kept text</p>", "kept text"),
        ("<table><tr><td>one<td>two<tr><td>three</table>", "one\ntwo\nthree"),
    ],
)
def test_odd_pages(page, text):
    assert html.extract(page) == text


def test_deep_pages_and_tables(spark):
    deep = "<div>" * 3000 + "<p>deep text</p>" + "</div>" * 3000
    rows = [(1, "u", SHELL.format(ARTICLE)), (2, None, None), (None, "u", deep), (3, "u", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("own"))
    out = {r.page_id: r for r in html.extract_pages(df).collect()}
    assert out[1].text == "\n".join(LINES) and out[1].n_chars == len(out[1].text) and out[2].text == "" and out[2].n_chars == 0
    assert out[None].text == "deep text" and html.extract_pages(df.where("false")).isEmpty()


def test_given_pages(spark):
    """Articles of the given pages hold exactly their own blocks."""
    import re
    from html import unescape

    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        blocks = re.sub(r"</?(?:p|h1)>", "\0", inner.replace("<br>", " "))
        want = [" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks.split("\0")]
        assert html.extract(r.html) == "\n".join(filter(None, want))


WORDS = [f"Sentence {i} of this text has some more words in it, so that it runs on for a good while." for i in range(10)]
TEN = [f"<p>{w}</p>" for w in WORDS]
MENU = "<div><ul>" + "".join(f"<li><a href='/{i}'>Linked words {i}</a></li>" for i in range(9)) + "</ul></div>"


@pytest.mark.parametrize("outer", ["article", "main", "div"])
def test_articles_are_taken_whole(outer):
    pages = [
        f"<h1>A short title</h1><div>{''.join(TEN)}</div>",
        f"<h1>A short title</h1><section>{''.join(TEN[:6])}</section><section>{''.join(TEN[6:])}</section>",
        f"<h1>A short title</h1><section>{''.join(TEN[:9])}</section><section><div>{TEN[9]}</div></section>",
    ]
    for inner in pages:
        want = ["A short title", *WORDS]
        assert html.extract(f"<body>{MENU}<{outer}>{inner}</{outer}></body>").split("\n") == want
        assert html.extract(f"<body><{outer}>{inner}</{outer}></body>").split("\n") == want


def test_split_articles_and_titles_beside_lists():
    split = f"<body>{MENU}<main><div><article>{''.join(TEN[:9])}</article></div><div><article>{TEN[9]}</article></div></main></body>"
    assert html.extract(split).split("\n") == WORDS
    assert html.extract(f"<body><h1>A short title</h1>{MENU}<div>{''.join(TEN)}</div></body>").split("\n") == ["A short title", *WORDS]


@pytest.mark.parametrize(
    "page",
    [
        "<body><div class='site has-sidebar'><article>{0}</article></div></body>",
        "<body class='no-sidebar'><div class=layout-no-sidebar><article>{0}</article></div></body>",
        "<body><div class='content with-menu'><div>{0}</div></div></body>",
        "<body><div class='post comments-open'><div>{0}</div></div></body>",
        "<body><div class=menu><article>{0}</article></div></body>",
        "<body><form><div class='page sidebar'><main>{0}</main></div></form></body>",
        "<html><head><title>t</title><body><article>{0}</article></body></html>",
        "<html><head><title>t</title><article>{0}</article></html>",
        "<head><meta charset=utf-8><script>var a = '<p>';</script><noscript><p>no</p></noscript><div>{0}</div>",
        "<body><p class=notice>A notice<div>{0}</div></body>",
        "<body><div><ul><li class=notice>A notice</ul>{0}</div></body>",
        "<body><div><div><nav>Menu</div>{0}</div></body>",
        "<body><div><span class=share>Share <span>it</span> now</span>{0}</div></body>",
        "<body><div><p><svg><path d=x><div>{0}</div></body>",
    ],
)
def test_marks_and_open_ends_lose_no_article(page):
    assert html.extract(page.format("".join(TEN))).split("\n") == WORDS


def test_items_after_a_marked_one_stay():
    table = "<table><tr><td class=ad>An advert<td>one<tr><td>two<dl></table><dl><dt class=promo>A<dd>three</dl><ul><li class=notice>B<li>four</ul>"
    assert html.extract(table) == "one\ntwo\nthree\nfour"


def test_comments_and_teasers_are_left_out_though_they_are_articles():
    for mark in ("comments", "related", "sidebar", "post-comments", "cookie-notice"):
        page = f"<body><article>{''.join(TEN)}</article><div class={mark}><article><p>{WORDS[0]}</p></article></div></body>"
        assert html.extract(page).split("\n") == WORDS


def test_density_decides_on_pages_without_semantic_tags(spark):
    """The given pages with every telling tag and class taken away: most articles come out
    exactly, by density alone, and hardly anything of one is lost."""
    import re

    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    exact = whole = 0
    for h in pages:
        want = html.extract(h).split("\n")
        bare = re.sub(r' class="[^"]*"', "", re.sub(r"<(/?)(article|footer|nav|header|aside|main)\b", r"<\1div", h))
        got = html.extract(bare).split("\n")
        exact += got == want
        whole += set(want) <= set(got)
    print(f"without semantic tags: {exact} of {len(pages)} articles exact, {whole} whole")
    assert exact >= 0.7 * len(pages) and whole >= 0.97 * len(pages)


@pytest.mark.parametrize("shell", ["<article>{}</article>", "<main><div>{}</div></main>", "<div>{}</div>"])
def test_class_words_alone_drop_nothing_of_an_article(shell):
    parts = ["<div class='paywall-content'>" + "".join(TEN[:6]) + "</div>", "<section class='menu-recipe'>" + TEN[6] + "</section>", f"<p id='social-history'>{WORDS[7]}</p>", *TEN[8:]]
    assert html.extract(f"<body>{MENU}{shell.format(''.join(parts))}</body>").split("\n") == WORDS


@pytest.mark.parametrize("noise", [
    "<section class='reader-discussion'><p>First! What a fine text this is, I say.</p><p>Not so fine at all, say I.</p></section>",
    "<div class=copyright>All rights reserved by the owner of this page.</div>",
    "<div class='ad-slot-2'>Buy this at once, it is very cheap today.</div>",
    "<div><h3>About</h3><p>We write.</p><p>A lot.</p><p>Of texts.</p></div>",
    "<div>&copy; the owner</div>",
])
@pytest.mark.parametrize("place", ["<body><div class=wrap>{menu}<div>{text}</div>{noise}</div></body>", "<body>{menu}<article>{text}</article>{noise}</body>"])
def test_what_is_no_article_goes(noise, place):
    assert html.extract(place.format(menu=MENU, text="".join(TEN), noise=noise)).split("\n") == WORDS


def test_marked_parts_of_an_article_go_unless_they_are_most_of_it():
    less = f"<article><h1>Title</h1>{''.join(TEN)}<div class=comments><p>{'A reader wrote this here. ' * 12}</p></div></article>"
    assert html.extract(less).split("\n") == ["Title", *WORDS]
    most = f"<article><div class=social><h1>Title</h1>{''.join(TEN)}</div><p>Out of the box.</p></article>"
    assert html.extract(most).split("\n") == ["Title", *WORDS, "Out of the box."]


def plain_weights(node, ratio):
    """Characters, tags, link characters, link tags and density of a kept node, by recursion."""
    from math import e, log

    kept = [c for c in node.items if isinstance(c, html.Node) and not c.skip]
    below = [plain_weights(c, ratio) for c in kept]
    own = [len("".join("".join(x for x in node.items if isinstance(x, str)).split())), 0, node.own_link[0], node.own_link[1]]
    c, t, lc, lt = (own[i] + sum(b[i] + (i == 1) for b in below) for i in range(4))
    if not c:
        return 0, t, lc, lt, 0.0, 0.0
    base = log((c / max(c - lc, 1)) * lc + ratio * c + e)
    many = max(t + lt, 1)
    if base > 1 and c > 1 and log(base) > 0:
        density = max(0.0, c / many * log((c / max(lc, 1)) * (many / max(lt, 1))) / log(base))
    else:
        density = c / many
    return c, t, lc, lt, density, sum(b[4] for b in below)


def test_densities_equal_a_plain_recursion():
    import random

    rnd = random.Random(5)

    def block(depth):
        if depth == 0 or rnd.random() < 0.3:
            words = "word " * rnd.randrange(30)
            return f"<p>{words}{'<a href=x>link text</a>' * rnd.randrange(3)}</p>"
        return f"<{(t := rnd.choice(['div', 'section', 'ul', 'td']))}>{''.join(block(depth - 1) for _ in range(rnd.randrange(5)))}</{t}>"

    for _ in range(60):
        b = html.TreeBuilder()
        b.feed(block(5))
        b.close()
        nodes = html.in_order(b.root)
        for n in nodes:
            html.Node.own_link = property(lambda self: own[id(self)])
        own = {id(n): (n.link_chars, n.link_tags) for n in nodes}
        total = [sum(n.chars for n in nodes), sum(n.link_chars for n in nodes)]
        ratio = total[1] / max(total[0], 1)
        want = {id(n): plain_weights(n, ratio) for n in nodes}
        html.weigh(nodes)
        for n in nodes:
            c, t, lc, lt, density, kids = want[id(n)]
            assert (n.chars, n.tags, n.link_chars, n.link_tags) == (c, t, lc, lt)
            assert n.density == pytest.approx(density) and n.total == pytest.approx(kids)
        del html.Node.own_link
        best = html.densest(nodes)
        assert want[id(best)][5] == pytest.approx(max(w[5] for w in want.values()))


def test_long_words_take_a_rolling_window(docs, pieces):
    scores = counts.log_probabilities(pieces)
    trie = counts.Trie(counts.piece_ends(scores))
    words = [w for w in {w for r in docs.limit(30).collect() for w in plain.words(r.text)} if len(w) < 400][:600]
    words += ["x" * 900, "ab😀" * 300, "é" * 777, "the" * 500]
    for w in words:
        assert trie.rolled(counts.MARK + w) == trie.insert(counts.MARK + w), w[:40]
    nodes = len(trie.best)
    assert trie.rolled(counts.MARK + "base64/" * 200_000) > 0 and len(trie.best) == nodes


def test_a_text_of_one_huge_word_is_counted(spark, pieces, monkeypatch):
    df = spark.createDataFrame([(1, "aGVsbG8" * 150_000), (2, "short words here")], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in counts.count_tokens(df, pieces).collect()}
    trie = counts.Trie(counts.piece_ends(counts.log_probabilities(pieces)))
    assert got[1] == trie.rolled(counts.MARK + "aGVsbG8" * 150_000)
