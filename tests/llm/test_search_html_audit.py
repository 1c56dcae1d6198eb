"""Ranked search, HTML extraction and filter audit against brute force, and on awkward rows."""

import collections
import html
import itertools
import math
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from shardweave.llm import queries
from shardweave.llm.filter_audit import Diagram, adjacent_swaps, audit_filters, audit_part
from shardweave.llm.html_extract import extract, fit, label_counts, main_text, scan, weights_of
from shardweave.llm.lexical_search import Best, Block, search

DIR = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(name):
    return pq.read_table(f"{DIR}/{name}.parquet").to_pylist()


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute_search(docs, items, k=10):
    bags = [(i, collections.Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    wanted = collections.defaultdict(set)
    for item, text in items:
        wanted[item] |= set(terms(text))
    for item, query in wanted.items():
        scored = []
        for i, b in bags:
            m = 10 + 90 * sum(b.values()) * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m))
                    for t in query if t in b)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()], key=repr)


@pytest.mark.parametrize("block_pairs", [200_000, 100])
def test_search_matches_brute_force(spark, block_pairs):
    """Whether the items go in one pass over the documents or in many."""
    docs, items = rows_of("documents"), rows_of("benchmark")
    items += [{"item_id": 7000, "text": "the THE of " + docs[3]["text"][:300]}, {"item_id": 7001, "text": "?!"}]
    bench = spark.createDataFrame([(r["item_id"], r["text"]) for r in items], "item_id long, text string")
    got = search(spark.read.parquet(f"{DIR}/documents.parquet"), bench, block_pairs=block_pairs)
    assert found(got) == brute_search([(r["doc_id"], r["text"]) for r in docs],
                                      [(r["item_id"], r["text"]) for r in items])


def test_search_on_awkward_rows(spark):
    docs = [(5, "Alpha beta"), (5, "alpha beta"), (2, "alpha BETA"), (None, "alpha beta"), (9, "été naïve alpha"), (3, None),
            (4, ""), (6, "..."), (7, "word " * 60_000 + "beta"), (8, "Été"), (1, "gamma gamma")]
    items = [(1, "alpha"), (1, "beta"), (None, "été"), (2, None), (3, ""), (4, "nowhere"), (5, "word")]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in docs], "doc_id long, text string, n long, score long, term string")
    bench = spark.createDataFrame([(*r, 0) for r in items], "item_id long, text string, doc_id long")
    assert found(search(df, bench)) == brute_search(docs, items)
    assert found(search(df, bench, k=2)) == brute_search(docs, items, 2)
    assert found(search(df.limit(0), bench)) == found(search(df, bench.limit(0))) == []


def test_masks_stop_early_and_lose_nothing():
    rng = np.random.default_rng(1)
    rows, vocabulary = 3000, 40
    has = rng.random((rows, vocabulary)) < 1 / np.arange(1, vocabulary + 1)
    bounds = np.append(0, np.cumsum(has.sum(1)))
    place = np.nonzero(has)[1]
    weights = np.arange(vocabulary) * 100
    block = Block(np.full(rows, 50), bounds, place, rng.integers(1, 4, len(place)), weights, rows, rows * 50)
    query = np.array([0, 1, 5, 11, 30, 39])
    best = Best(10)
    evaluated = block.rank(query, best, np.arange(rows), np.zeros(rows, bool))
    chosen = np.where(np.isin(place, query), block.adds, 0)
    scores = np.array([chosen[a:b].sum() for a, b in itertools.pairwise(bounds)])
    want = np.lexsort((np.arange(rows), -scores))[:10]
    assert best.ids.tolist() == want.tolist() and best.scores.tolist() == scores[want].tolist()
    assert evaluated < rows / 4
    strong = Best(10)
    strong.add(np.full(10, block.caps[np.isin(block.present, query)].sum() + 1), np.arange(10), np.zeros(10, bool))
    assert block.rank(query, strong, np.arange(rows), np.zeros(rows, bool)) == 0  # nothing here can enter


def brute_text(page):
    """Text between the article's tags, for the plain layout of the test pages."""
    lines = []
    inner = re.search(r"<article>(.*?)(</article>|<footer|$)", page, re.S)[1]
    for block in re.split(r"</?(?:p|h1)>", inner):
        line = " ".join(html.unescape(re.sub("<br>", " ", block).replace("<b>", "")).split())
        lines += [line] * bool(line)
    return "\n".join(lines)


def test_pages_match_brute_force(spark):
    pages = {r["page_id"]: r for r in rows_of("pages")}
    got = queries.QUERIES["op12_html_text"](spark, DIR).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id]["url"], brute_text(pages[r.page_id]["html"]), len(r.text))


ARTICLE = "<h1>T &amp; U</h1><p>One <a href='?a>b'>two</a>\tthree<br>four.</p><ul><li>item 1<li>item&nbsp;2</ul><p>End.</p>"
TEXT = "T & U\nOne two three four.\nitem 1\nitem 2\nEnd."


@pytest.mark.parametrize("around", [
    "{}", "<html><body>{}", "<body><header><h1>Site</h1></header><nav><ul><li><a>x</a></ul></nav><div id='content'>{}</div>"
    "<footer>words</footer>", "<main>{}</main><aside><p>one two three four five six</aside>",
    "<div class='cookie-notice'>We use cookies on this page</div><article>{}</article>",
    "<article>{}<div class='reader-comments'><p>I say so</div></article><article class='comment'><p>So do I</article>",
    "<form action=x><input name=q><article>{}<div class=ad>Buy now</div></article></form>", "<script>if (a<b) '<p>'</script>{}",
    "<style>p{{}}</style><!-- <p>not this --><section class='main with-sidebar'>{}</section><div class=sidebar>menu words</div>",
    "<article>{}<script>never closed", "<article>{}</article><p>Some words beside the article, more than it has itself."])
def test_layouts(around):
    page = around.format(ARTICLE)
    assert main_text(page, {}) == TEXT
    labelled = label_counts(f"<nav>menu</nav><article><p>{'word ' * 50}</article><p>beside")
    assert main_text(page, weights_of(labelled)) == TEXT


def test_weights_of_labelled_pages():
    counts = label_counts("<body><p>beside it</p><article><p>some words here</p></article></body>")
    assert counts["article/#", True] == 3 and counts["outer/#", False] == 2 and counts["p", True] == 2
    weights = weights_of(counts)
    assert weights["article/#"] > 0 > weights["outer/#"] and weights["outer/article"] < weights["article/p"] < 0
    assert label_counts("<p>x") is None and label_counts("<article>a</article><article>b</article>") is None


def test_broken_pages():
    assert [t for k, _, t in scan("a < b <3 </> <!x> <!--><b c") if k == "text"] == ["a ", "<", " b ", "<", "3 ", " ", " "]
    for page in ("<", "<a", "<!--", "</", "<p class='x>y", "<script>", "&#xD800;", "<title>", "</p></div>"):
        assert main_text(page, {}) in ("", "<", "�", "</", "y")
    deep = "<div>" * 20_000 + "deep" + "</p>" * 20_000
    assert main_text(deep, {}) == "deep"
    assert main_text("<p>" + "long " * 200_000, {}) == "long " * 199_999 + "long"


def test_pages_awkward_rows(spark):
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (None, None, None), (2, "v", "")]
    df = spark.createDataFrame([(*r, "t", 5) for r in rows], "page_id long, url string, html string, text string, hash long")
    want = [(1, "u", "a", 1), (1, "u", "a", 1), (2, "v", "", 0), (None, None, "", 0)]
    assert sorted(map(tuple, extract(df).collect()), key=repr) == want
    assert extract(df.limit(0)).count() == 0 and fit(df) == {}


def brute_audit(docs, labels):
    """Rows of the audit, one document and one order at a time."""
    good = {r[0] for r in labels if r[1] == 1}
    toxic = {r[0] for r in labels if r[2] == 1}
    fails, parts = [], set()
    for doc_id, text, lang in docs:
        t = text or ""
        w = re.findall("[^\x20\x09-\x0D]+", t)
        out = {"A"} if len(w) < 100 else set()
        out |= {"B"} if 100 * len(set(w)) < 80 * len(w) else set()
        out |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t) else set()
        out |= {"D"} if re.search("[#$%&*|]", t) else set()
        smaller = doc_id is not None and any(i is not None and i < doc_id and (x or "") == t for i, x, _ in docs)
        fails.append((lang or "", out | ({"E"} if smaller else set()), doc_id))
        parts.add(lang or "")
    rows, share = [], collections.Counter()
    for part in parts:
        for order in itertools.permutations("ABCDE"):
            left = [f for f in fails if f[0] == part]
            for step, letter in enumerate(order, 1):
                gone = [f for f in left if letter in f[1]]
                left = [f for f in left if letter not in f[1]]
                share[part, letter] += len(gone)
                rows.append((part, "".join(order), step, len(left), len(gone),
                             sum(f[0] == part and letter in f[1] for f in fails) - len(gone),
                             sum(f[0] == part and f[1] == {letter} for f in fails),
                             sum(f[2] is not None and f[2] in good for f in gone),
                             sum(f[2] is not None and f[2] in toxic for f in gone)))
    return sorted((*r, share[r[0], r[1][r[2] - 1]]) for r in rows)


def audited(df):
    return sorted(map(tuple, df.collect()))


def test_audit_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in rows_of("documents")]
    labels = [(r["doc_id"], r["quality"], r["toxic"]) for r in rows_of("labels")]
    assert audited(queries.QUERIES["op13_filter_audit"](spark, DIR)) == brute_audit(docs, labels)


def test_audit_awkward_rows(spark):
    long = " ".join(f"w{i}" for i in range(150))
    docs = [(1, long, "en"), (2, long, "de"), (2, long, "en"), (1, long, None), (1, long, "en"), (None, long, "en"), (3, None, None),
            (4, "", ""), (5, "UPPER # words", "en"), (5, "UPPER # words", "en"), (None, "", "en"), (6, "a b " * 90_000, "fr")]
    labels = [(1, 1, 0), (1, 0, 1), (2, None, 1), (None, 1, 1), (5, 1, 1), (77, 1, 1)]
    df = spark.createDataFrame([(*r, 1, "x", b"y") for r in docs],
                               "doc_id long, text string, lang string, mask int, part string, digest binary")
    marks = spark.createDataFrame([(*r, "z") for r in labels], "doc_id long, quality int, toxic int, text string")
    assert audited(audit_filters(df, marks)) == brute_audit(docs, labels)
    assert audited(audit_filters(df, marks.limit(0))) == brute_audit(docs, [])
    assert audited(audit_filters(df.limit(0), marks)) == []


def test_diagram_swaps_keep_the_function():
    rng = np.random.default_rng(3)
    weights = {m: (int(n), int(n) // 2, 0) for m, n in zip(range(16), rng.integers(0, 4, 16))}
    diagram, seen = Diagram(weights, "abcd"), {"abcd"}
    for place in adjacent_swaps(4):
        diagram.swap(place)
        seen.add("".join(diagram.order))
        for mask in range(16):
            at = diagram.root
            for letter in diagram.order:
                at = (diagram.high if mask >> "abcd".index(letter) & 1 else diagram.low)[at]
            assert diagram.weight[at] == weights[mask]
        assert all(len(level) <= 1 << i for i, level in enumerate(diagram.levels))
    assert len(seen) == 24
    assert len(audit_part("", {0: (1, 0, 0)}, "abc")) == 18 and list(adjacent_swaps(1)) == []
