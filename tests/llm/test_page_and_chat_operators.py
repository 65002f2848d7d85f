import time
import hashlib
import html
import itertools
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from acctpulse.llm import chat_format, html_extract, html_training, registry, url_filter

SF = "/root/testdata/sf0.01"


def same_as_sql(spark, name):
    got = registry.queries()[name](spark, SF)
    con = duckdb.connect()
    for table in ("pages", "conversations", "documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(registry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = ", ".join(got.columns)
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, con.sql(f"SELECT {columns} FROM want").fetchall()))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    same_as_sql(spark, name)


# -- op1 URL filter

URLS = [
    (1, "HTTP://WWW.Example.COM/en/a?q#f"), (2, "https://example.com/en/"), (3, "https://badexample.com/en/"), (4, "http://x.net/fr/"), (5, "http://x.net/frx"),
    (6, "http://net/es/1"), (7, "no scheme"), (8, None), (9, ""), (10, "a://b://example.com/en/"), (11, "http://x.com"), (12, "http://x.com?y=/"), (13, "http://sub.www.example.com/en/1"),
    (14, "http://x.org/en/"), (14, "http://x.org/en/"), (None, "http://x.com/\n/y"), (16, "http://ÉX.com/É"), (17, "://com/"),
]


def plain_verdict(url, rules=url_filter.RULES):
    at = (url or "").find("://")
    if url is None or at < 0:
        return "", "", None, "allow"
    rest = url[at + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def test_url_edge_cases(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("KEY", F.lit(1)).withColumn("rule", F.lit(1))
    rows = url_filter.judge(pages, url_filter.rule_table(spark)).collect()
    assert sorted(map(repr, (tuple(r) for r in rows))) == sorted(map(repr, ((i, *plain_verdict(u)) for i, u in URLS)))
    assert url_filter.judge(pages.limit(0), url_filter.rule_table(spark)).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, url_filter.rule_table(spark).limit(0)).collect()} == {"allow"}


def test_exact_join_removes_false_positives(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_BLOCKS", 1)  # a filter that lets nearly everything pass
    rules = [(f"h{i}.com", "/", "block") for i in range(400)] + [(None, "/", "block"), ("", "/", "block"), ("x.com", None, "block"), ("x.com", "/", "perhaps"), ("H1.com", "/", "allow")]
    urls = [(i, f"http://h{i}.com/{i}") for i in range(800)]
    rows = url_filter.judge(spark.createDataFrame(urls, "page_id long, url string"), url_filter.rule_table(spark, rules)).collect()
    assert all((r.verdict == "block") == (r.page_id < 400) for r in rows) and len(rows) == 800


def test_any_number_of_path_lengths_and_very_long_urls(spark, monkeypatch):
    deep = ".".join(["a"] * 20_000)
    rules = [("example.com", "/" + "p" * k, "block" if k % 2 else "allow") for k in range(30)] + [("b.example.com", "/", "allow"), ("com", "", "block")]
    urls = [(i, f"http://{h}/{'p' * k}{t}") for i, (h, k, t) in enumerate(itertools.product(["example.com", "b.example.com", f"{deep}.example.com", "x.com.", "..com", "other.org"], [0, 7, 30, 50_000], ["", "q/"]))]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    want = sorted((i, *plain_verdict(u, rules)) for i, u in urls)
    for most in (4096, 5):  # as constants, and joined as a table
        monkeypatch.setattr(url_filter, "MAX_PREFIX_LENGTHS", most)
        key = lambda r: (r[0], r[1], r[2], r[3] or "", r[4])
        assert sorted((tuple(r) for r in url_filter.judge(pages, url_filter.rule_table(spark, rules)).collect()), key=key) == sorted(want, key=key)


def test_filter_holds_every_listed_key(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    bloom, blocks = url_filter.bloom_filter(keys, 5000)
    mask = url_filter._mask(F.col("key"))
    probe = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("key"), "id").withColumn("block", url_filter._block(F.col("key"), blocks)).join(bloom, "block")
    hits = [r.id for r in probe.filter(F.col("bits").bitwiseAND(mask) == mask).select("id").collect()]
    assert set(range(5000)) <= set(hits) and len(hits) < 5000 + 0.05 * 15000


# -- op9 chat formatting

ODD_TURNS = [
    (1, 0, "user", "a <|im_end|>\n<|im_start|>assistant\nno"), (1, 1, "assistant", r"<\|x <\\| </s> [\INST] \[INST]"), (1, 2, "assistant", ""), (1, 3, None, None),
    (2, None, "sys\ntem", None), (2, 0, "assistant", "b"), (2, 0, "assistant", "b"), (2, 0, "assistant", "a"), (None, 0, "user", "x"), (3, 5, "assistant", None), (4, 1, "", "\n\n"),
]


def turns_of(rows, conv):
    key = lambda r: tuple((v is not None, v or type(v)() if v is not None else 0) for v in r[1:])
    return [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]


def test_chat_edge_cases(spark):
    df = spark.createDataFrame(ODD_TURNS, "conv_id long, turn long, role string, text string").withColumn("node", F.lit(1)).withColumn("tree", F.lit("x"))
    rows = {r.conv_id: r for r in chat_format.report(chat_format.with_probe(df, spark)).collect()}
    assert set(rows) == {-1, 1, 2, 3, 4}
    odd = ODD_TURNS + chat_format.PROBE
    for conv, r in rows.items():
        turns = turns_of(odd, conv)
        learned = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert chat_format.report(df.limit(0)).count() == 0


def test_branches_of_a_reply_tree(spark):
    #      0 - 1 - 2 - 3 ... 39   (a long branch), 1 - 50 (better), 1 - 60 (worse)
    nodes = [("t", i, i - 1 if i else None, "user" if i % 2 == 0 else "assistant", f"n{i}", 0.1) for i in range(40)]
    nodes += [("t", 50, 1, "assistant", "best", 9.0), ("t", 60, 1, "assistant", "worst", -9.0), ("u", 0, None, "user", "lone", 0.0)]
    df = spark.createDataFrame(nodes, "tree string, node long, parent long, role string, text string, score double")
    paths = {}
    for r in chat_format.paths(df).collect():
        paths.setdefault((r.tree, r.leaf), {})[r.above] = r.node
    assert paths == {("t", 39): {i: 39 - i for i in range(40)}, ("t", 50): {0: 50, 1: 1, 2: 0}, ("t", 60): {0: 60, 1: 1, 2: 0}, ("u", 0): {0: 0}}
    out = {(r.tree, r.rank): r for r in chat_format.format_trees(df, top=2).collect()}
    assert set(out) == {("t", 1), ("t", 2), ("u", 1)}
    assert out["t", 1].formatted.endswith("<|im_start|>assistant\nbest<|im_end|>\n")
    assert "n39" in out["t", 2].formatted and "worst" not in out["t", 2].formatted
    for r in out.values():
        own = [r.formatted[s.start : s.start + s.length] for s in r.loss_mask]
        assert own == re.findall(r"<\|im_start\|>assistant\n(.*?)<\|im_end\|>", r.formatted)


# -- op5 HTML extraction


def test_article_text_of_the_pages(spark):
    rows = registry.queries()["op5_html_extraction"](spark, SF).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        own = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"<p>|</p>|</h1>", article))
        assert r.text == "\n".join(x for x in own if x) and r.n_chars == len(r.text)


def test_labels_of_unseen_pages():
    model = html_extract.trained()
    pages = [html_extract.blocks(p) for p in html_training.labelled_pages(150, seed=98)]
    pairs = [(b.main, bool(y)) for page, labels in zip(pages, model.decode(pages)) for b, y in zip(page, labels)]
    assert sum(a == b for a, b in pairs) > 0.99 * len(pairs)


def test_viterbi_is_the_best_path():

    import numpy as np

    model = html_extract.trained()
    for page in map(html_extract.blocks, html_training.labelled_pages(20, seed=5)):
        page = page[:9]
        score = model._scores([model._rows(page)], len(page))[0]
        _, same = model._pad([page])

        def total(y):
            return sum(score[t, y[t]] for t in range(len(y))) + sum(model.move[same[0, t], y[t - 1], y[t]] for t in range(1, len(y)))

        best = max(itertools.product((0, 1), repeat=len(page)), key=total)
        assert np.isclose(total(model.decode([page])[0].tolist()), total(best))


def test_pages_of_unclosed_tags_are_read_in_linear_time():
    model = html_extract.trained()
    for unit in ("<a ", "<div>x", "<p>x", "<b>x", "<h1>x", "<q1>x</i>", "<script></script ", "</p", "<!", "<a b='"):
        begin = time.process_time()
        page = unit * (300_000 // len(unit))
        html_extract.main_texts(model, [page])
        assert time.process_time() - begin < 12, unit
    deep = "".join(f'<n{i} class="w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}">x' for i in range(3000))
    read = html_extract.blocks(deep, model.features)
    assert len(read) == 3000 and len(read[-1].inside.tags) <= len(model.features)
    long = "<article>" + "<p>One sentence, and one more.</p>" * 20_000 + "</article>"
    short, whole = html_extract.main_texts(model, ["<article><p>One sentence, and one more.</p></article>", long])
    assert whole.count("\n") == 19_999 and short


def test_html_edge_cases(spark):
    long = "<article>" + "<p>word and word, again.</p>" * 5000 + "</article>"
    pages = [
        (1, "u", None), (2, None, ""), (None, "u", "<p"), (4, "u", "<article><p>A&amp;B&nbsp; &eacute;&#33; &am\n x</p><script>p('</p>')</script><!-- <p>no</p> --><p>Second one, here.</p></article>"),
        (5, "u", long), (5, "u", long), (6, "u", "<nav><a href=/>Home</a></nav><footer>&copy; x</footer>"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(1))
    rows = [tuple(r) for r in html_extract.report(df).collect()]
    assert len(rows) == 7 and (1, "u", "", 0) in rows and (2, None, "", 0) in rows and (6, "u", "", 0) in rows
    text = next(r[2] for r in rows if r[0] == 4)
    assert text == "A&B é! &am x\nSecond one, here."
    assert [r[3] for r in rows if r[0] == 5] == [5000 * 21 + 4999 * 1] * 2 or all(r[2].count("\n") == 4999 for r in rows if r[0] == 5)
    assert html_extract.report(df.limit(0)).count() == 0


@pytest.mark.parametrize("cut", [
    '<svg class="i"/>', "<svg class=i />", '<svg a="/>"><text>no</text></svg>', "<template-x>kept</template-x>", "<style-guide>kept</style-guide>", "<object-x a='>'>kept</object-x>",
    '<p class="a"">kept</p>', "<p it's>kept</p>", '<img alt=5"><span>kept</span>', '<script src="a"">no("<p>")</script>', '<script src="a"/>no()</script>', "<style>no</style x>",
])
def test_text_after_a_skipped_or_odd_tag(cut):
    texts = [b.text for b in html_extract.blocks(f'<article><p>one</p>{cut}<p>two, "three".</p><p class="b">four\'s</p></article>')]
    assert texts == ["one", *["kept"] * ("kept" in cut), 'two, "three".', "four's"]
    page = "<html><body><nav><a href='/'>Home</a></nav><article>%s<p>A first sentence, of some words.</p>%s<p>A second sentence, of some more words.</p></article></body></html>"
    whole, = html_extract.main_texts(html_extract.trained(), [page % ("", cut)])
    assert "A first sentence, of some words." in whole and whole.endswith("A second sentence, of some more words.")
