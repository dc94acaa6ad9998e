"""Main text: pages that are easy to get wrong, and the scoring against a version without shortcuts."""

import random
import time

import pytest

from seiche.llm import html
from seiche.llm.html import main_text

P = "<p>One long paragraph, with commas, words, and quite enough of them to be read as prose by anyone.</p>"
T = "One long paragraph, with commas, words, and quite enough of them to be read as prose by anyone."


@pytest.mark.parametrize(
    "page, text",
    [
        # names say what an element is by their last word
        (f'<div id="content" class="with-sidebar">{P}{P}</div>', f"{T}\n{T}"),
        (f'<div class="layout-no-sidebar">{P}</div>', T),
        (f'<main><h1>Title</h1>{P}<section id="discussion"><h2>Discussion</h2>{P}</section><section id="related-work">{P}</section></main>', f"Title\n{T}\nDiscussion\n{T}\n{T}"),
        (f'<div class="post">{P}{P}<div class="post-comments"><p>Nice, very nice, really.</p></div><div class="entry-share">Tell, all, friends</div><div class="article-sidebar"><p>Other, things.</p></div><div class="comment entry"><p>Me, too.</p></div></div>', f"{T}\n{T}"),
        (f'<article>{P}</article><article class="comment"><p>A reader, with, many, many, commas.</p></article>', T),
        (f'<div class="postContent">{P}<div class="relatedPosts"><p>Read, also, this.</p></div></div>', T),
        # a name is no veto
        (f'<div class="widget">{P}{P}{P}</div><div>short</div>', f"{T}\n{T}\n{T}"),
        (f"<form id=aspnetForm><div>{P}{P}</div></form>", f"{T}\n{T}"),
        (f"<article>{P}<form><p>Your name, please</p></form></article>", T),
        ('<div class="sidebar"><p>all there is</p></div>', "all there is"),
        # comments hold most of the page's text
        (f"<article><h1>T</h1><p>Short.</p></article><section id=comments>{P * 9}</section>", "T\nShort."),
        # nothing of the article is dropped for being short or elsewhere
        (f"<div id=a>{P}{P}</div><p>The end.</p>", f"{T}\n{T}\nThe end."),
        (f"<div><div>{P}{P}</div><ul><li>one<li>two</ul>bare text</div>", f"{T}\n{T}\none\ntwo\nbare text"),
        (f"<body><div><div class=a>{P}{P}</div></div><div><div class=b>{P}{P}</div></div></body>", "\n".join([T] * 4)),
        (f"<main><div>{P}</div><div>tail</div></main>", f"{T}\ntail"),
        # headers
        (f"<header><h1>Site, name</h1></header><article><header><h1>Title</h1><p>By me</p></header>{P}<footer>notes</footer></article>", f"Title\nBy me\n{T}"),
        # quotes
        (f'<article><p class="x>Hello</p><p class="y">World, all</p>{P}</article>', f"World, all\n{T}"),
        (f"<article><p class=\"x>Hello, there</p>{P}</article>", f"Hello, there\n{T}"),
        (f"<article><a href=/it's>link</a><p>isn't, it</p>{P}</article>", f"link\nisn't, it\n{T}"),
        (f"<article><p title='a > b'>gt, it is</p>{P}</article>", f"gt, it is\n{T}"),
        (f"<article><p =x y= z>odd</p>{P}</article>", f"odd\n{T}"),
        # references, white space, raw text, comments, sections of data
        ("<article><p>a &lt; b &amp;&#233;&nbsp;c &notit;\n\t d<!-- x > y --><!--> e<![CDATA[ <f> ]]></p><textarea><p>no</p></textarea></article>", "a < b &é c ¬it; d e <f>"),
        ("<article><p>a<script>if (x < 3) '</p>'</script>b</p></article>", "ab"),
        ("<p>never closed <b>bold <i>both</b> end", "never closed bold both end"),
        ("<table><tr><td>a, one<td>b, two<tr><td>c, three</table>", "a, one\nb, two\nc, three"),
        ("<article><p hidden>no</p><p aria-hidden=true>no</p><p style='display: none'>no</p><p>yes</p></article>", "yes"),
        ("1 < 2 and <3", "1 < 2 and <3"),
        ("", ""),
        ("<nav>x</nav>", ""),
        ("<!-- never closed <p>a</p>", ""),
        ("<script>never closed <p>a</p>", ""),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


def test_ties_between_containers_go_to_the_first():
    assert main_text(f"<body><div><div><div>{P}</div></div></div><section><ul><li><a href=x>{T}</a></ul></section></body>") == T
    root = html.parse(f"<div id=a>{P}</div><div id=b>{P}</div>")
    a, b = html.scored(html.blocks_of(root))[:2]
    assert a.score == b.score and max((a, b), key=lambda x: x.score) is a


@pytest.mark.parametrize("unit", ["<span>", "<div>", "<p><b>", "<li><table><span>", "<a href='", '<p class="x', "<!", "</p>", "<b></i>", "</div><ul><li>"])
def test_time_in_proportion_to_the_page(unit):
    def took(n):
        began = time.process_time()
        main_text(unit * n + P)
        return time.process_time() - began

    took(1000)
    assert took(40_000) < 24 * took(4_000) + 0.5


def tree(r, depth):
    tag = r.choice(["div", "section", "article", "ul", "p", "p", "p", "h2", "span"])
    if tag in ("p", "h2", "span") or depth > 6:
        return f"<{tag}>" + " ".join(r.choice(["a,", "word", "<a href=x>link</a>", "b"]) for _ in range(r.randint(0, 30))) + f"</{tag}>"
    return f"<{tag}>" + "".join(tree(r, depth + 1) for _ in range(r.randint(0, 4))) + f"</{tag}>"


def test_scores_of_random_trees():
    for seed in range(60):
        r = random.Random(seed)
        root = html.parse("<body>" + "".join(tree(r, 0) for _ in range(4)) + "</body>")
        blocks = html.blocks_of(root)
        got = html.scored(blocks)

        def every(node):
            yield node
            for c in node.children:
                if isinstance(c, html.Node):
                    yield from every(c)

        for x in every(root):
            points, chars, links = 0.0, 0, 0
            for node, text, linked in blocks:
                path, up = [], node
                while up is not None:
                    path.append(up)
                    up = up.parent
                if x in path:
                    chars, links = chars + len(text), links + linked
                    place = path.index(x) - (node.tag in ("p", "h2", "li"))
                    if 0 <= place < 6:
                        worth = 1 + text.count(",") + min(len(text) / 100, 3)
                        points += worth * (1 - linked / len(text)) * (1 if node.tag in ("p", "div", "section", "article", "body") else 0.25) * [1, 0.5, 0.3, 0.2, 0.15, 0.1][place]
            if any(x is y for y in got):
                assert x.points == pytest.approx(points) and (x.chars, x.linked) == (chars, links)
                assert x.score == pytest.approx((points + {"article": 6, "div": 1, "section": 0.6, "ul": -0.6}.get(x.tag, 0)) * (1 - links / chars))
            else:
                assert points == 0 or x.tag == "#root"


def test_empty_table(spark):
    assert html.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
