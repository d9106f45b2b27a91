"""Main text of pages without a marked article, of odd names and of broken markup, against the blocks they are made of."""

from __future__ import annotations

import random
import time

from ledgerloom.llm import line_blocks

LONG = ["The river rose in the night and by morning the lower town was under water, " * n for n in (1, 2, 4)]
SHORT = ["Nobody was hurt.", "A short note", "Water fell on Friday"]
CHROME = [
    "<nav><ul><li><a href='/'>Home page</a></li><li>News from all over the place</li></ul></nav>",
    '<div class="ad-slot">Buy two boats now and get the third one for nothing, only this week and only here!</div>',
    '<ul id="main-menu"><li>All stories of the last seven days in one place</li><li>Weather, sport, money and travel</li></ul>',
    '<aside><p>Ten bridges that you have to see before you are old, with a map for each of them.</p></aside>',
    '<div class="related-posts"><p>More on this</p></div>',
    "<form><label>Your name</label><input name=a></form>",
    "<script>if (1 < 2) { go(); }</script>",
    '<section class="comment-list"><p>I do not believe a word of this, the water was never that high.</p></section>',
]


def article(draw):
    blocks = [("h1", "Floods"), ("p", draw.choice(SHORT))]
    blocks += [("p", draw.choice(LONG).strip()) for _ in range(draw.randint(2, 6))]
    blocks += [("h2", "After"), ("p", draw.choice(LONG).strip()), ("p", draw.choice(SHORT))]
    return blocks


def page(draw, open_, close):
    blocks, parts = article(draw), draw.choices(CHROME, k=draw.randint(2, 4))
    for tag, text in blocks:
        parts.append(f"<{tag}>{text}</{tag}>")
        if draw.random() < 0.4:
            parts += draw.choices(CHROME, k=draw.randint(1, 4))
    parts += draw.choices(CHROME, k=2)
    html = "<html><head><title>t</title></head><body>" + open_ + "\n".join(parts) + close + "<footer>(c)</footer></body></html>"
    return html, "\n".join(text for _, text in blocks)


def test_pages_without_a_marked_article():
    draw = random.Random(6)
    for _ in range(300):
        html, text = page(draw, "", "")
        assert line_blocks.main_text(html) == text


def test_names_of_an_article():
    draw = random.Random(7)
    for name in ("side-by-side", "post social-study", "legal-news", "content", "shareholders", "social", "navigator story", "notice", "widget"):
        for open_, close in ((f'<div class="{name}">', "</div>"), (f"<div id='{name}'><article>", "</article></div>"), (f"<div class='legal'><div class='{name}'>", "</div></div>")):
            html, text = page(draw, open_, close)
            assert line_blocks.main_text(html) == text, name


def test_names_of_page_parts():
    for name in ("ad", "ads", "site-footer", "cookie-notice", "sidebar-left", "relatedPosts", "comment_list", "comments", "share-buttons", "nav", "main_menu2"):
        html = f'<div class="x {name}"><p>{LONG[0]}</p></div><p>{LONG[2]}</p>'
        assert line_blocks.main_text(html) == LONG[2].strip(), name


def test_broken_quotes():
    first, last = LONG[1].strip(), LONG[2].strip()
    for tag in ("<p class=it's>", '<p title="unclosed>', "<p title='unclosed>", '<p title="a > b" id=c>', '<p a="b"c="d">', "<p =>", '<p a= "b>c" >'):
        html = f'{tag}{first}</p><p>It\'s "so" and <a href="x" title=\'y\'>so</a>.</p><p class="z">{last}</p>'
        assert line_blocks.main_text(html) == f'{first}\nIt\'s "so" and so.\n{last}', tag
    start = time.monotonic()
    for odd in ('<p a="' * 20_000, "<p" + ' a="b"c' * 20_000, "<a =" * 20_000, "<p a='x' " * 20_000):
        line_blocks.main_text(odd)
    assert time.monotonic() - start < 20


def test_a_page_of_comments_only():
    assert line_blocks.main_text(f'<div class="comments"><p>{LONG[2]}</p></div>') == ""
