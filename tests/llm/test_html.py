"""Main text of pages: given pages against their marked article, and hand-made ones for each rule."""

import html as decode
import random
import re
from collections import Counter
from html.parser import HTMLParser

import pytest

from carelens.llm import html as rules
from carelens.llm.html import blocks, extract
from carelens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
GOOD = "The end of the story is that all of the people in the town had to be there when it was cold and they were not."


def article(page):
    """The given pages keep all their text in one article element."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    body = re.sub(r"</?b>", "", body)
    return " ".join(decode.unescape(re.sub(r"<[^>]*>", " ", body)).split())


def test_given_pages(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in QUERIES["op3_main_text"](spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        want = article(r.html)
        assert got[r.page_id, r.url] == (want, len(want))


def test_what_is_dropped():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><nav>the menu of the site</nav>
    <script>var x = "<p>{GOOD}</p>";</script><!-- <p>{GOOD}</p> --><div class="cookie-notice"><p>{GOOD}</p></div><main><h2>Head</h2><p>{GOOD}</p>
    <form><p>{GOOD}</p><input value="x"></form><aside>{GOOD}</aside><p>Short.</p><div class="ad">{GOOD}</div><p>A <b>b</b>old&nbsp;w&eacute;rd &lt;p&gt;</p></main>
    <section id="comments"><p>{GOOD}</p></section><footer>{GOOD}</footer></body></html>"""
    assert extract(page) == f"Head {GOOD} Short. A bold wérd <p>"


def test_pages_that_mark_no_article():
    links = "".join(f'<li><a href="/{i}">entry {i}</a></li>' for i in range(8))
    page = f"<body><ul>{links}</ul><h1>Title</h1><p>{GOOD}</p><p>One.</p><p>{GOOD}</p><ul>{links}</ul><p>x y</p></body>"
    assert extract(page) == f"Title {GOOD} One. {GOOD}"


def test_block_rules():
    noise = "zq " * 60
    assert extract(f"<div>{noise}</div><div>{GOOD}</div>") == GOOD  # no stop words
    assert extract(f"<article><p>{noise}</p></article>") == noise.strip()  # an article's own words stay
    assert extract(f'<article><p>{GOOD}</p><p><a href="x">See the list</a></p></article>') == f"{GOOD} See the list"
    assert extract("<article><p>x</p></article>") == "x"
    assert extract("<p>x</p>") == ""


def test_post_header_belongs_to_the_article():
    assert extract(f'<article><div class="post-header"><h1>A title</h1></div><p>{GOOD}</p></article>') == f"A title {GOOD}"


def test_elements_named_like_an_article():
    noise = "zq " * 60
    page = f'<body><div>{GOOD}</div><div class="entry-content"><p>{noise}</p><div id="ad3">{GOOD}</div><ol class="commentlist"><li>{GOOD}</li></ol></div></body>'
    assert extract(page) == noise.strip()
    assert extract(f'<div class="content"><div>{GOOD}</div><main><p>x</p></main></div>') == "x"
    assert extract(f'<div role="main"><p>{noise}</p></div><p>{GOOD}</p>') == noise.strip()
    assert extract(f'<article><div class="siteHeader">{GOOD}</div><p>x</p><div class="AdBox">{GOOD}</div></article>') == "x"


def test_broken_markup():
    assert extract(None) == extract("") == extract("<") == extract("<p") == ""
    assert extract(f"<article><p>{GOOD}<p>{GOOD}<br>more</article><p>{GOOD}") == f"{GOOD} {GOOD} more"
    assert extract(f'<article><p title="a > b">{GOOD}</p></article>') == GOOD
    assert extract(f'<article><p title="open>{GOOD}</p></article>') == GOOD
    assert extract(f"<article><p>{GOOD} 1 < 2 &amp; 3 > 2</p></div></b></article>") == f"{GOOD} 1 < 2 & 3 > 2"
    assert extract(f"<article><p>{GOOD}</p><script>never closed") == GOOD
    assert extract(f"<article><p>{GOOD}</p><!-- never closed") == GOOD
    assert extract(f"<nav><ul><li>the a of<article><p>{GOOD}</p></article>") == GOOD  # a menu that nothing ends holds the article
    deep = "<div>" * 50_000 + GOOD
    assert extract(deep) == GOOD
    long = f"<article><p>{GOOD * 20_000}</p></article>"
    assert extract(long) == GOOD * 20_000


def test_edges(spark):
    from carelens.llm.html import pages_text

    shape = "page_id long, url string, html string, text string, n_chars int"
    rows = [(1, "u", None, "t", 1), (1, "u", None, "t", 1), (None, None, "", "t", 1), (2, None, f"<article>{GOOD} \U0001f600</article>", "t", 1)]
    pages = spark.createDataFrame(rows, shape)
    got = sorted((repr(r.page_id), r.text, r.n_chars) for r in pages_text(pages).collect())
    assert got == sorted([("1", "", 0), ("1", "", 0), ("None", "", 0), ("2", GOOD + " \U0001f600", len(GOOD) + 2)])
    assert pages_text(pages.where("false")).count() == 0


def test_embedded_elements_do_not_cut_the_page():
    for name in ("svg", "math"):
        assert extract(f'<article><p>{GOOD}</p><{name} class="x"/><p>{GOOD}</p><{name}/>more</article>') == f"{GOOD} {GOOD} more"
        assert extract(f'<article><{name}><title>t</title><style/><path d="x"/>gone</{name}><p>{GOOD}</p></article>') == GOOD
        assert extract(f"<article><{name}><g>gone<p>{GOOD}</p><{name}>gone</{name}><p>{GOOD}</p></article>") == f"{GOOD} {GOOD}"
    for name in ("svg", "object", "template", "video", "audio", "canvas", "math"):
        assert extract(f"<article><{name}>gone<{name}>gone</{name}>gone</{name}><p>{GOOD}</p></article>") == GOOD
        assert extract(f'<article><p>{GOOD}</p><{name} src="a"><p>{GOOD}</p></article>') == f"{GOOD} {GOOD}"
        assert extract(f"<article><p><{name}>gone</{name}>{GOOD}</p><{name.upper()}>gone</{name.upper()} ></article>") == GOOD
    assert extract(f"<article><div><p><video src=a></p><p>{GOOD}</p><video>gone</video></div></article>") == GOOD
    assert extract(f"<article><div><template></div><p>gone</p></template><p>{GOOD}</p></div></article>") == GOOD
    assert extract(f"<article><svg width=1/>gone</svg><p>{GOOD}</p></article>") == GOOD  # the slash is the value's
    assert extract("<svg><video><object>" * 30_000 + f"<p>{GOOD}</p>") == GOOD


#: Paragraphs with few stop words of the list, or none: Polish, Finnish, Japanese, Russian, names, code, a table's row.
OTHERS = [
    "Wszystkie stare domy przy rynku spłonęły zimą, lecz mieszkańcy odbudowali je przed nadejściem kolejnej wiosny, bez niczyjej pomocy.",
    "Vanhassa kaupungissa asui kauan sitten kalastaja, jonka vene katosi myrskyssä eikä kukaan enää nähnyt sitä missään rannalla.",
    "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。何でも薄暗いじめじめした所でニャーニャー泣いていた事だけは記憶している。吾輩はここで始めて人間というものを見た。",
    "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему, говорил когда-то один писатель.",
    "Anna Schmidt, Peter Novak, Maria Rossi, John Smith, Olga Petrova, Luis Gomez, Chen Wei, Fatima Hassan, Ingrid Larsen, Paul Dupont",
    "def area(width, height): result = width * height; print(result); return result # computes rectangles quickly without checking input",
    "Berlin 3645000 891.7 Hamburg 1841000 755.2 München 1472000 310.7 Köln 1086000 405.0 Frankfurt 753000 248.3 Stuttgart 635000 207.4",
]


def test_paragraphs_with_few_stop_words_on_pages_of_divs():
    links = "<div>" + "".join(f'<a href="/{i}">entry number {i}</a> ' for i in range(8)) + "</div>"
    for text in OTHERS:
        assert extract(f"<body>{links}<div>{text}</div><div>{text}</div>{links}</body>") == f"{text} {text}"
        assert extract(f"<body>{links}<div>{text}</div><div>{GOOD}</div>{links}</body>") == f"{text} {GOOD}"
        assert extract(f"<body>{links}<div>{GOOD}</div><div>{text}</div><div>{GOOD}</div>{links}</body>") == f"{GOOD} {text} {GOOD}"
        # A notice in a language of the list does not take the place of the text.
        assert extract(f"<body><div>{GOOD}</div>{links}<div>{text}</div><div>{text}</div>{links}</body>") == f"{GOOD} {text} {text}"
        # Where the page has more that is surely text, what stands between links only goes.
        assert extract(f"<body><div>{GOOD}</div><div>{GOOD}</div>{links}<div>{text}</div>{links}</body>") == f"{GOOD} {GOOD}"
    assert extract(f"<div>{'=' * 100}</div><div>{GOOD}</div>") == GOOD


def test_given_pages_without_their_article_elements(spark):
    """Every paragraph of 80 characters or more, in four languages, stays on the page made of divs."""
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        got = extract(re.sub(r"(</?)article>", r"\1div>", r.html))
        assert all(b.text in got for b in blocks(body) if len(b.text) >= 80)


NOTE = "All of the comments by readers are to be read with care, and they have not been the opinion of this site."


@pytest.mark.parametrize(
    "page",
    [
        "<div class='overflow-hidden'><article><p>{}</p></article></div>",
        "<div class='wrap has-sidebar'><main><p>{}</p></main></div>",
        "<div id='page' class='site no-sidebar'><article><p>{}</p></article></div>",
        "<form action='x'><input name='state'><div><main><p>{}</p></main></div></form>",
        "<nav><ul><li><a href='a'>one</a><article><p>{}</p></article>",
        "<div class='comments-open'><article><p>{}</p></article></div>",
        "<article><div class='overflow-hidden'><p>{}</p></div></article>",
        "<article><p>{}</p><div class='article-comments'><p>" + NOTE + "</p></div></article>",
        "<article><p>{}</p><div class='comment-body'><p>" + NOTE + "</p></div></article>",
        "<main><p>{}</p><section class='post-comments'><p>" + NOTE + "</p></section></main>",
        "<main><p>{}</p><section><article><p>" + NOTE[:100] + "</p></article></section></main>",
        "<main><article><p>{}</p><article>" + NOTE[:100] + "</article></article></main>",
        "<main><p>{}</p></main><div class='comments'><article><p>" + NOTE * 5 + "</p></article></div>",
    ],
)
def test_marks_that_hold_the_article_do_not_count_and_comments_always_do(page):
    assert extract(f"<html><body>{page.format(GOOD)}</body></html>") == GOOD


def test_wrappers_on_pages_of_divs():
    links = "<div>" + "".join(f'<a href="/{i}">entry number {i}</a> ' for i in range(8)) + "</div>"
    for mark in ("class='has-sidebar'", "id='content-menu'", "class='overflow-hidden'"):
        assert extract(f"<body><div {mark}>{links}<div>{GOOD}</div><div>{GOOD}</div><div class='cookie-bar'>{NOTE}</div></div></body>") == f"{GOOD} {GOOD}"
    assert extract(f"<body><form>{links}<p>{GOOD}</p><p>{GOOD}</p></form><div>&copy; 2020 {NOTE}</div></body>") == f"{GOOD} {GOOD}"
    assert extract(f"<body>{links}<footer>{GOOD}</footer></body>") == ""  # a whole footer stays one
    assert extract(f"<body><div class='ad'>{GOOD}</div><div class='sidebar'>{GOOD}</div><div>{GOOD}</div></body>") == GOOD
    story = f"<main><p>{GOOD}</p><article><p>{GOOD}</p><p>{GOOD}</p></article></main>"
    assert extract(story) == f"{GOOD} {GOOD} {GOOD}"  # an article larger than what stands before it is no comment


def test_stop_words_decide(monkeypatch):
    links = f"<div><a href='a'>{GOOD}</a></div>"
    pages = [f"{links}<p>It was as it is.</p><div>{GOOD}</div>", f"<div>{GOOD}</div><div>{GOOD}</div>{links}<div>{OTHERS[0]}</div>{links}"]
    before = [extract(p) for p in pages]
    monkeypatch.setattr(rules, "STOP", frozenset())
    assert all(a != extract(p) for a, p in zip(before, pages, strict=True))


def bare(page):
    """A given page without a mark: article, menu, footer and advert are all div elements."""
    return re.sub(r"(</?)(article|nav|footer)>", r"\1div>", page).replace('<div class="ad">', "<div>")


def test_given_pages_without_any_mark(spark):
    """Recall of the article's characters above 99 %, and less than 6 % of the characters around it come along."""
    got = size = along = around = 0
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)
        kept = Counter(b.text for b in rules.decide(*rules.parse(bare(r.html))))
        rest = bare(r.html[: body.start()] + "<hr>" + r.html[body.end() :])
        for text, inside in [(b.text, True) for b in blocks(body[1])] + [(b.text, False) for b in blocks(rest)]:
            found = len(text) if kept[text] else 0
            kept[text] -= found > 0
            got, size, along, around = (got + found, size + len(text), along, around) if inside else (got, size, along + found, around + len(text))
    assert got > 0.99 * size and along < 0.06 * around


class Tree(HTMLParser):
    """A second reading of well-formed pages: blocks with the chain of elements around them."""

    def __init__(self):
        super().__init__()
        self.chain, self.found, self.text, self.linked = [], [], "", 0

    def flush(self):
        if self.text.split():
            self.found.append((" ".join(self.text.split()), self.linked, list(self.chain)))
        self.text, self.linked = "", 0

    def handle_starttag(self, tag, attrs):
        if tag != "a":
            self.flush()
        self.chain.append((len(self.found), id(attrs), tag, dict(attrs).get("class", "")))

    def handle_endtag(self, tag):
        if tag != "a":
            self.flush()
        self.chain.pop()

    def handle_data(self, data):
        self.text += data
        if any(c[2] == "a" for c in self.chain):
            self.linked += len(data.strip())


def second(page):
    """The rules for pages without article elements and with marks of adverts and comments only, said plainly."""
    tree = Tree()
    tree.feed(page)
    tree.flush()
    found = []
    for text, linked, chain in tree.found:
        words = re.findall(r"\w+", text.lower())
        share = sum(w in rules.STOP for w in words) / max(1, len(words))
        tags = [c[2] for c in chain]
        p, heading, marked = "p" in tags, "h2" in tags, any(c[3] in ("ad", "comments") for c in chain)
        if linked > 0.4 * len(text) or marked or text.startswith("©") and not p:
            label = "bad"
        elif len(text) < 80 or heading:
            label = "open"
        elif share >= 0.2:
            label = "good"
        else:
            label = "long" if len(set(words)) > 1 or len(words) == 1 else "bad"
        found.append([text, label, p, heading, share, next((c[:2] for c in chain if c[3]), None)])
    size = {x: sum(len(f[0]) for f in found if f[1] == x) for x in ("good", "long")}
    plain = [f for f in found if f[5] is None]
    for i, f in enumerate(plain):
        if f[1] == "long":
            before = next((g[1] for g in plain[:i][::-1] if g[1] in ("good", "bad")), None)
            after = next((g[1] for g in plain[i + 1 :] if g[1] in ("good", "bad")), None)
            f.append("good" if size["long"] >= size["good"] or {before, after} - {None} != {"bad"} else "bad")
    for f in found:
        if f[1] == "long":
            f[1] = f.pop()
    for i, f in enumerate(found):
        if f[1] == "open" and f[2]:
            a, b = i, i
            while a > 0 and found[a - 1][2] and found[a - 1][5] == f[5]:
                a -= 1
            while b + 1 < len(found) and found[b + 1][2] and found[b + 1][5] == f[5]:
                b += 1
            run = {g[1] for g in found[a : b + 1]}
            if "good" in run and "bad" not in run:
                f.append("run")
    for f in found:
        if f[-1] == "run":
            f[1] = "good"
    kept = []
    for i, f in enumerate(found):
        label = f[1]
        if label == "open":
            before = next(((i - j, found[j][1]) for j in range(i - 1, -1, -1) if found[j][1] != "open"), (i + 1, "bad"))
            after = next(((j - i, found[j][1]) for j in range(i + 1, len(found)) if found[j][1] != "open"), (len(found) - i, "bad"))
            if f[3]:
                label = after[1]
            elif before[0] == after[0] and before[1] != after[1]:
                label = "good" if f[2] and f[4] >= 0.2 else "bad"
            else:
                label = min(before, after)[1]
        if label == "good":
            kept.append(f[0])
    return " ".join(kept)


def test_random_pages_against_a_second_reading():
    rng = random.Random(8)
    texts = [GOOD, NOTE, *OTHERS, "Short one.", "It is as it was.", "x", "© 2020 the site", "Name", "zq " * 50]
    for _ in range(400):
        page, depth = "", 0
        for _ in range(rng.randint(1, 14)):
            kind, text = rng.choice(["div", "p", "h2", "links", "ad", "open", "close"]), rng.choice(texts)
            if kind == "links":
                page += "<div>" + "".join(f"<a>{t}</a> " for t in rng.sample(texts, 3)) + "</div>"
            elif kind == "ad":
                page += f"<div class='{rng.choice(['ad', 'comments'])}'><p>{text}</p></div>"
            elif kind == "open":
                page, depth = page + "<section>", depth + 1
            elif kind == "close" and depth:
                page, depth = page + "</section>", depth - 1
            elif kind != "close":
                page += f"<{kind}>{text}</{kind}>"
        page = f"<div>{GOOD}</div>{page}" + "</section>" * depth
        assert extract(page) == second(page), page
