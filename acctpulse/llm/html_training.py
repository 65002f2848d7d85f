"""Labelled pages for the HTML extractor.

Each page is put together from the parts below: a shell with head and title,
page furniture in varying markup, and one article in varying markup whose
blocks carry ``data-main``.  Parts are chosen by a seeded generator, and texts
are made of random syllables, so that only structure and form can be learned."""

from __future__ import annotations

import random

#: Fixed values.  {w}: one to three words, {s}: a sentence, {p}: a paragraph, {links}: list items with links.
FURNITURE_BEFORE = [
    '<header class="site-header"><a href="/">{w}</a><p>{s}</p></header>',
    '<header><h2>{w}</h2><p class="tagline">{s}</p></header>',
    '<div id="header" class="masthead"><div class="logo">{w}</div><p>{s}</p></div>',
    '<nav><ul>{links}</ul></nav>',
    '<nav class="menu"><a href="/a">{w}</a> <a href="/b">{w}</a> <a href="/c">{w}</a></nav>',
    '<div class="navbar" id="navigation"><ul>{links}</ul></div>',
    '<ul class="menu">{links}</ul>',
    '<div class="breadcrumb"><a href="/">{w}</a> &gt; <a href="/x">{w}</a></div>',
    '<div class="cookie-notice"><p>{s}</p><button>{w}</button></div>',
    '<div class="notice">{s}</div>',
    '<div class="cookie-banner consent" role="dialog">{p}<button>{w}</button></div>',
    '<div class="alert banner"><p>{s}</p></div>',
    '<div class="ad">{s}</div>',
    '<div class="advert"><p>{s}</p></div>',
    '<div class="ads sponsored"><a href="/buy">{s}</a></div>',
    '<form action="/search"><label>{w}</label><input name="q"><button>{w}</button></form>',
    '<div class="search"><form><p>{s}</p><select><option>{w}</option><option>{w}</option></select></form></div>',
]
FURNITURE_AFTER = [
    '<aside><h3>{w}</h3><ul>{links}</ul></aside>',
    '<aside class="sidebar"><p>{s}</p><p>{p}</p></aside>',
    '<div class="sidebar widget"><h3>{w}</h3><p>{s}</p></div>',
    '<div class="related"><h3>{w}</h3><ul>{links}</ul></div>',
    '<div class="share social"><a href="/t">{w}</a><a href="/f">{w}</a></div>',
    '<div class="ad">{s}</div>',
    '<div class="promo sponsored"><p>{s}</p></div>',
    '<aside class="advertisement"><p>{p}</p></aside>',
    '<section class="comments" id="comments"><h2>{w}</h2><div class="comment"><p class="author">{w}</p><p>{p}</p></div><div class="comment"><p>{s}</p></div></section>',
    '<div id="comments"><ol class="commentlist"><li class="comment">{p}</li><li class="comment">{s}</li></ol></div>',
    '<div class="user-comments"><article class="comment"><p>{p}</p></article><article class="comment"><p>{s}</p></article></div>',
    '<form class="newsletter subscribe"><p>{s}</p><input type="email"><button>{w}</button></form>',
    '<form id="comment-form"><label>{w}</label><textarea>{w}</textarea><button>{w}</button></form>',
    '<div class="notice legal"><p>{s}</p></div>',
]
FOOTERS = [
    '<footer>&copy; {w} &middot; {s}</footer>',
    '<footer class="site-footer"><p>{s}</p><ul>{links}</ul></footer>',
    '<div id="footer" class="copyright"><p>&copy; {w}</p><p>{s}</p></div>',
    '',
]
INSIDE = [
    '<div class="ad">{s}</div>',
    '<aside class="promo"><p>{s}</p></aside>',
    '<div class="share"><a href="/t">{w}</a></div>',
    '<form><p>{s}</p><button>{w}</button></form>',
    '<div class="advert"><p>{p}</p></div>',
    '<nav class="toc"><ul>{links}</ul></nav>',
    '<div class="notice"><p>{s}</p></div>',
    '<div class="comments"><p>{p}</p><p>{s}</p></div>',
]
CONTAINERS = [
    ("<article>", "</article>"), ("<article>", "</article>"), ('<article class="post">', "</article>"), ("<main>", "</main>"),
    ("<main><article>", "</article></main>"), ('<div class="content">', "</div>"), ('<div id="content" class="main">', "</div>"),
    ('<div class="post-body entry-content">', "</div>"), ('<section class="article-body">', "</section>"), ("<div>", "</div>"),
    ('<div class="page"><div class="text">', "</div></div>"),
]
BLOCKS = [
    "<p data-main>{p}</p>", "<p data-main>{p}</p>", "<p data-main>{p}</p>", "<p data-main><b>{p}<br>", "<p data-main>{s}</p>", "<p data-main>{w}.</p>",
    "<h2 data-main>{w}</h2>", "<h3 data-main>{s}</h3>", "<blockquote data-main><p>{p}</p></blockquote>", "<ul data-main><li>{s}</li><li>{w}</li></ul>",
    "<ol data-main><li>{s}</li><li>{s}</li></ol>", "<div data-main>{p}</div>", "<pre data-main>{s}</pre>", '<p data-main>{s} <a href="/r">{w}</a> {s}</p>',
    "<table data-main><tr><td>{w}</td><td>{w}</td></tr></table>", "<figure data-main><figcaption>{s}</figcaption></figure>",
]
TITLES = ["<h1 data-main>{t}</h1>", "<h1 data-main>{t}</h1>", '<h1 data-main class="title">{t}</h1>', ""]


def labelled_pages(n: int = 600, seed: int = 3) -> list[str]:
    rng = random.Random(seed)
    syllable = lambda: "".join(rng.choice(s) for s in ("bcdfghlmnprstvéñß", "aeiouèü", rng.choice(["", "nrst"]) or " ")).strip()
    word = lambda: "".join(syllable() for _ in range(rng.randint(1, 4)))

    def sentence(low: int, high: int) -> str:
        own = [word() + rng.choice(["", "", "", "", ","]) for _ in range(rng.randint(low, high))]
        return " ".join(own).strip(",").capitalize() + rng.choice([".", ".", ".", "", "!"])

    def fill(part: str) -> str:
        out = []
        for piece in part.replace("{", "\0{").replace("}", "}\0").split("\0"):
            if piece == "{w}":
                piece = sentence(1, 3).strip(".")
            elif piece == "{s}":
                piece = sentence(4, 16)
            elif piece == "{t}":
                piece = sentence(3, 12)
            elif piece == "{p}":
                piece = " ".join(sentence(2, 20) for _ in range(rng.randint(1, 8)))
            elif piece == "{links}":
                piece = "".join(f'<li><a href="/{word()}">{sentence(1, 2)}</a></li>' for _ in range(rng.randint(2, 8)))
            out.append(piece)
        return "".join(out)

    pages = []
    for _ in range(n):
        before = [rng.choice(FURNITURE_BEFORE) for _ in range(rng.randint(0, 5))]
        after = [rng.choice(FURNITURE_AFTER) for _ in range(rng.randint(0, 4))]
        body = [rng.choice(TITLES), *(rng.choice(BLOCKS) for _ in range(rng.randint(1, 14)))]
        for _ in range(rng.choice([0, 0, 0, 1, 2])):
            body.insert(rng.randint(1, len(body)), rng.choice(INSIDE))
        opened, closed = rng.choice(CONTAINERS)
        tail = rng.choice(["</body></html>", "</body></html>", ""])
        pages.append(fill("<!DOCTYPE html><html><head><title>{t}</title><style>p{}</style></head><body>".replace("{}", "{ }") + "".join(before) + opened + "".join(body) + closed + "".join(after) + rng.choice(FOOTERS) + tail))
    return pages
