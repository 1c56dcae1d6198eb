"""The ten operators against brute force, and on awkward rows."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shardweave.llm import queries
from shardweave.llm.decontaminate import contamination, drop_contaminated
from shardweave.llm.languages import languages
from shardweave.llm.licenses import scan_licenses
from shardweave.llm.mixture import even_weights, mix
from shardweave.llm.near_dedup import near_duplicates
from shardweave.llm.quality import quality
from shardweave.llm.suffix_dedup import remove_repeats
from shardweave.llm.suffix_tree import score
from shardweave.llm.topk import top_k
from shardweave.llm.url_filter import filter_urls

DIR = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(name):
    return pq.read_table(f"{DIR}/{name}.parquet").to_pylist()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_top_k_matches_brute_force(spark):
    rows = rows_of("embeddings")
    ids = np.array([r["vec_id"] for r in rows])
    vectors = np.floor(1024 * np.array([r["embedding"] for r in rows], float)).astype(int)
    want = set()
    for i in np.flatnonzero(ids % 100 == 0):
        scores = vectors @ vectors[i]
        order = [j for j in np.lexsort((ids, -scores)) if j != i][:10]
        want |= {(int(ids[i]), k, int(ids[j]), int(scores[j])) for k, j in enumerate(order, 1)}
    got = queries.QUERIES["op1_top_k"](spark, DIR).collect()
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want and len(got) == len(want)


def test_top_k_leaves_out_bad_vectors_and_orders_ties(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [None, 1.0]),
            (5, [float("nan"), 0.0]), (6, [float("inf"), 0.0]), (7, []), (None, [1.0, 1.0])]
    got = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(0, 1, 1), (0, 2, 2)]


def test_top_k_rows_that_share_an_id(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (7, [1.0, 0.5]), (100, [0.5, 0.5])]
    got = top_k(spark.createDataFrame([(*r, 1, "x") for r in rows],
                                      "vec_id long, embedding array<double>, score int, query_key string")).collect()
    lists = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        lists[r.query_id, r.query_key].append((r["rank"], r.vec_id, r.score >> 18))
    assert sorted((q, v) for (q, _), v in lists.items()) == [
        (0, [(1, 7, 2), (2, 100, 2), (3, 0, 0)]), (0, [(1, 7, 4), (2, 100, 2), (3, 0, 0)]),
        (100, [(1, 7, 3), (2, 0, 2), (3, 0, 2)])]
    assert top_k(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_near_duplicates_matches_brute_force(spark):
    rows = rows_of("documents")
    sets = {}
    for r in rows:
        w = re.findall("[^\x20\x09-\x0D]+", (r["text"] or "").translate(LOW))
        sets[r["doc_id"]] = ({tuple(w[i:i + 4]) for i in range(len(w) - 3)} or ({tuple(w)} if w else set()))
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = by_id(queries.QUERIES["op2_near_duplicates"](spark, DIR))
    assert {i: (len(s), find(i), find(i) == i) for i, s in sets.items()} == {
        i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()}


def test_decontamination_matches_brute_force(spark):
    def words(s):
        return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (s or "").translate(LOW))

    docs, items = rows_of("documents"), rows_of("benchmark")
    items.append({"item_id": 900_000, "text": " ".join(words(docs[5]["text"])[3:7])})  # a short item
    items.append({"item_id": 900_001, "text": "..."})
    bench = spark.createDataFrame([(r["item_id"], r["text"]) for r in items], "item_id long, text string")
    grams = collections.defaultdict(set)
    for r in items:
        w = words(r["text"])
        width = min(10, len(w))
        for i in range(len(w) - width + 1 if w else 0):
            grams[tuple(w[i:i + width])].add(str(r["item_id"]))
    table = spark.read.parquet(f"{DIR}/documents.parquet")
    got = by_id(contamination(table, bench))
    assert len(got) == len(docs)
    assert by_id(contamination(table, bench, broadcast_rows=0)) == got
    for r in docs:
        w, hit, found = words(r["text"]), set(), set()
        for i in range(len(w)):
            for width in {len(g) for g in grams}:
                gram = tuple(w[i:i + width])
                if len(gram) == width and gram in grams:
                    hit |= set(range(i, i + width))
                    found |= grams[gram]
        x = got[r["doc_id"]]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert (x.n_words, x.n_hit, x.n_items, x.items_sha256, x.contaminated) == (
            len(w), len(hit), len(found), digest, bool(hit))


def brute_repeats(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            gram = raw[p:p + 100]
            if gram in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(gram)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[doc_id] = (len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def check_repeats(spark, rows):
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    assert {r.doc.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute_repeats(rows)


def test_suffix_dedup_matches_brute_force(spark):
    check_repeats(spark, [(r["doc_id"], r["text"]) for r in rows_of("documents")])


def test_suffix_dedup_periodic_and_short_texts(spark):
    passage = "".join(chr(97 + i * i % 23) for i in range(130))
    check_repeats(spark, [(1, "a" * 500), (2, "b" + "a" * 99), (3, "ab" * 300), (4, ""), (5, "x" * 99),
                          (6, "x" * 100), (7, "y" + "x" * 101), (8, passage + "Z" + passage), (9, "ß" * 80 + passage)])


def test_mixture_spends_the_budget_by_weight(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    got = mix(docs, even_weights(docs)).collect()
    lengths = {r["doc_id"]: len(r["text"].split()) for r in rows_of("documents")}
    spent = collections.Counter()
    for r in got:
        assert 0 < r.take_tokens <= r.n_tokens == lengths[r.doc_id]
        spent[r.domain] += r.take_tokens
    assert len({(r.doc_id, r.epoch) for r in got}) == len(got)
    total = sum(lengths.values()) // 2
    assert total - 80 <= sum(spent.values()) <= total  # each leaf rounds down


def test_mixture_gives_shortages_to_siblings_first(spark):
    docs = spark.createDataFrame(
        [(i, "w " * 10, "en", "a" if i < 1 else "b" if i < 21 else "c") for i in range(41)],
        "doc_id long, text string, lang string, source string")
    weights = spark.createDataFrame([("a", "x", 1.0, 1.0, 1.0), ("b", "x", 1.0, 1.0, 1.0), ("c", "y", 1.0, 1.0, 1.0)],
                                    "source string, domain string, weight_domain double, weight_lang double, "
                                    "weight_source double")
    spent = collections.Counter()
    for r in mix(docs, weights, 0.5, 1).collect():
        spent[r.source] += r.take_tokens
    assert spent == {"a": 10, "b": 92, "c": 102}


def test_mixture_leaves_without_weight_supply_nothing(spark):
    lots = {"a": 2, "z": 36, "n": 1, "c": 40, "q": 1}
    docs = spark.createDataFrame([(i, "w " * 10, "en", s) for s, n in lots.items() for i in range(n)],
                                 "doc_id long, text string, lang string, source string")
    one, none = 1.0, 0.0
    weights = spark.createDataFrame(
        [("a", "x", one, one, one), ("z", "x", one, one, none), ("n", "x", one, one, -1.0),
         ("q", "x", float("nan"), one, one), ("c", "y", one, one, None)],
        "source string, domain string, weight_domain double, weight_lang double, weight_source double")
    spent = collections.Counter()
    for r in mix(docs, weights, 0.5, 1).collect():
        spent[r.source] += r.take_tokens
    assert spent == {"a": 20, "c": 380}


def test_licenses_of_lines_without_licence_words(spark):
    grant = "Permission is hereby granted, free of charge, to any person obtaining a copy"
    rows = [(1, "grant of the permission, free of charge, to any person obtaining copies\n" + "prose\n" * 99, "a/x"),
            (2, f"{grant}\n{grant}\nother words", "b/LICENSE"), (3, "plain words", "b/c/x"),
            (4, "Released under the MIT License\n" + "prose\n" * 50, "c/x"), (5, "any person may copy this", "d/x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, path string")
    got = by_id(scan_licenses(df, df.path))
    assert {i: r.own_license for i, r in got.items()} == {1: "MIT", 2: "MIT", 3: None, 4: "MIT", 5: None}
    assert {i: r.is_license_file for i, r in got.items()} == {1: False, 2: True, 3: False, 4: False, 5: False}
    assert (got[2].own_score, got[3].license, got[3].inherited_from) == (1.0, "MIT", "b")


@pytest.mark.parametrize("common", [None, (1, 4)])
def test_licenses_match_brute_force_and_carry_no_lines_per_word(spark, monkeypatch, common):
    from shardweave.llm import licenses as module

    rng = np.random.default_rng(3)
    words = [w for _, body in module.TEMPLATES for w in re.findall("[a-z0-9]+", body.lower())]
    prose = [f"w{i}" for i in range(40)]
    lines = []
    for i in range(400):  # words of several templates, parts of one template, and prose among them
        body = re.findall("[a-z0-9]+", module.TEMPLATES[i % 10][1].lower())
        own = rng.choice(words, 6) if i % 2 else body[:rng.integers(1, len(body) + 1)]
        lines.append(" ".join([*own, *rng.choice(prose, rng.integers(0, 30))]))
    speak = [x for x in lines if re.search(module.SPEAKS, x)]

    def terms(x):
        return collections.Counter(re.findall("[a-z0-9]+", x.lower()))

    df = collections.Counter(t for x in speak for t in terms(x))

    def vector(x):
        v = {t: n * (math.log((len(speak) + 1) / (df[t] + 1)) + 1) for t, n in terms(x).items()}
        norm = math.sqrt(sum(a * a for a in v.values()))
        return {t: a / norm for t, a in v.items()}

    def best(x):
        v = vector(x)
        s = [(-round(sum(a * vector(body).get(t, 0) for t, a in v.items()), 6), name) for name, body in module.TEMPLATES]
        return min(s)[::-1] if -min(s)[0] >= module.LEAST else (None, 0)

    made, plans, stage = {}, [], module.stage

    def record(d, label):
        plans.append(d._jdf.queryExecution().optimizedPlan().toString())
        made[label] = stage(d, label)
        return made[label]

    monkeypatch.setattr(module, "stage", record)
    if common:
        monkeypatch.setattr(module, "COMMON", common)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = by_id(scan_licenses(docs, F.col("doc_id").cast("string")))
    want = [best(x) for x in lines]
    assert [got[i].own_license for i in range(400)] == [name for name, _ in want]
    assert [got[i].own_score or 0 for i in range(400)] == pytest.approx([-s for _, s in want], abs=2e-6)
    assert not [p for p in plans if re.search(r"Aggregate \[line#\d+[^\]]*term#", p)]
    silent = [w for x, w in zip(lines, want) if x not in speak]
    assert 0 < sum(w[0] is not None for w in silent) <= made["silent"].count() < len(silent) / 2


def test_licenses_own_and_inherited(spark):
    rows = [(1, "p/LICENSE", "Released under the MIT License."), (2, "p/q/a", "some words"), (3, "z/a", "some words"),
            (4, "p/q/b", "words\n" * 9 + "Licensed under the Apache License, Version 2.0."), (5, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = by_id(scan_licenses(df, df.path))
    assert {i: r.license for i, r in got.items()} == {1: "MIT", 2: "MIT", 3: None, 4: "Apache-2.0", 5: None}
    assert got[2].inherited_from == "p"


def test_languages_on_held_out_documents(spark):
    lang = {r["doc_id"]: r["lang"] for r in rows_of("documents")}
    got = queries.QUERIES["op7_languages"](spark, DIR).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_suffix_tree_counts_and_gain(spark):
    def tokens(r):
        return [*re.findall("[^\x20\x09-\x0D]+", (r["text"] or "").translate(LOW)), "\0"]

    docs = rows_of("documents")
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2 for r in docs}
    c = collections.Counter(t for r in docs if not held[r["doc_id"]] for t in tokens(r))
    n, v = sum(c.values()), len(c)
    got = by_id(queries.QUERIES["op8_suffix_tree"](spark, DIR))
    for r in docs:
        t, x = tokens(r), got[r["doc_id"]]
        assert (x.held_out, x.n_tokens, x.n_known, x.train_tokens) == (
            held[r["doc_id"]], len(t), sum(w in c for w in t), n)
        assert x.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t))
    print(sum(x.score - x.base_score for x in got.values() if x.held_out))
    assert sum(x.score - x.base_score for x in got.values()) > 0


def test_quality_counts_all_trusted_text(spark, monkeypatch):
    from shardweave.llm import quality as module

    seen, fit = [], module.fit
    monkeypatch.setattr(module, "fit", lambda trusted: seen.append(trusted.count()) or fit(trusted))
    docs = spark.range(4200).selectExpr("id AS doc_id", "'en' AS lang", "concat('plain words ', id) AS text")
    labels = spark.range(4200).selectExpr("id AS doc_id", "1 AS quality", "if(id < 100, 1, 0) AS toxic")
    quality(docs, labels)
    assert seen == [4100]


def test_quality_rejects_junk_and_keeps_the_rest(spark):
    base = "/root/testdata/sf0.01"
    got = by_id(queries.QUERIES["op9_quality"](spark, base))
    seen = collections.Counter((r["quality"], got[r["doc_id"]].kept) for r in pq.read_table(
        f"{base}/labels.parquet").to_pylist())
    assert seen[0, False] > 0.8 * (seen[0, True] + seen[0, False])
    assert seen[1, True] > 0.98 * (seen[1, True] + seen[1, False])


def test_url_parts_and_rules(spark):
    urls = [("http://A.COM/x?q", "a.com", "/x", "com/"), ("https://www.example.com/en/1#a", "www.example.com", "/en/1",
            "www.example.com/en/"), ("h://m.example.com/en/", "m.example.com", "/en/", "example.com/en/"),
            ("h://b.net/fr/1", "b.net", "/fr/1", "net/fr/"), ("nothing", "", "", None), (None, "", "", None),
            ("h://x.com?y", "x.com", "", None), ("h://icom/a", "icom", "/a", None)]
    df = spark.createDataFrame([(i, u[0]) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: r for r in filter_urls(df).collect()}
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(len(urls))] == [u[1:] for u in urls]
    assert {r.verdict for r in got.values()} <= {"allow", "block"}


AWKWARD = [(1, "Hello world", "en", "a", 1), (1, "Hello world", "en", "a", 1), (2, None, None, None, None),
           (3, "", "en", "a", 0), (None, "some text here", None, "b", 2), (4, "word " * 30_000, "en", "a", 9)]
SCHEMA = ("doc_id long, text string, lang string, source string, n long, key long, _key long, marks string, "
          "tokens string, words string, bits double, component string, id long")


@pytest.mark.parametrize("count", [6, 0])
def test_awkward_rows(spark, count):
    rows = [(*r, 0, 0, "m", "t", "w", 0.5, "c", 7) for r in AWKWARD][:count]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "hello World"), (2, None)], "item_id long, text string")
    for made in (near_duplicates(docs), contamination(docs, bench), contamination(docs, bench.limit(0)),
                 contamination(docs, bench, broadcast_rows=0),
                 remove_repeats(docs), languages(docs), score(docs), quality(docs, labels), quality(docs, labels.limit(0)),
                 scan_licenses(docs, docs.source)):
        assert made.count() == count
    assert drop_contaminated(docs, bench).count() == max(0, count - 2)
    assert drop_contaminated(docs, bench).columns == docs.columns
    mix(docs, even_weights(docs)).collect()
