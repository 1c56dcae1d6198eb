"""The quality model of words against brute force."""

import collections
import math
import re

import pyarrow.parquet as pq
import pytest

from shardweave.llm import quality as module
from shardweave.llm.quality import ALL, PRIOR, quality

DIR = "/root/testdata/sf0.001"


def discounts(counts):
    n = [max(1, sum(c == i for c in counts)) for i in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1])
    d = [i - (i + 1) * y * n[i] / n[i - 1] for i in (1, 2, 3)]
    return [0.0, *[min(max(x, 0.1), i - 0.05) for i, x in enumerate(d, 1)]]


def events(items, width):
    """(context, next) of each item, contexts of ``width`` items; the first ones begin with None."""
    items = [*[None] * width, *items]
    return [(tuple(items[i:i + width]), x) for i, x in enumerate(items[width:])]


class Level:
    """Counts (context, next) of one order, less one occurrence where asked."""

    def __init__(self, counts, off):
        self.counts, self.off = counts, off
        self.total, self.mass = collections.Counter(), collections.Counter()
        for (context, _), n in counts.items():
            self.total[context] += n
            self.mass[context] += off[min(n, 3)]

    def p(self, context, x, lower, less=0):
        n, off = self.counts[context, x], self.off
        total = self.total[context] - less
        if total <= 0:
            return lower
        mass = self.mass[context] - (off[min(n, 3)] - off[min(n - 1, 3)] if less else 0)
        return (max(n - less - off[min(n - less, 3)], 0) + mass * lower) / total


class Model:
    """Items after ``width`` items, over kinds of items after fewer, over ``base``."""

    def __init__(self, texts, width, base, offs=None):
        counts = [collections.Counter(e for t in texts for e in events(t, width))]
        for _ in range(width):
            counts.insert(0, collections.Counter((c[1:], x) for c, x in counts[0]))
        offs = offs or [discounts(c.values()) for c in counts]
        self.levels, self.base, self.width = [Level(c, o) for c, o in zip(counts, offs)], base, width

    def bits(self, items, own=False):
        out = 0.0
        for context, x in events(items, self.width):
            less, gone = [], own
            for k in range(self.width, -1, -1):
                less.insert(0, int(gone))
                gone = gone and self.levels[k].counts[context[self.width - k:], x] == 1
            p = self.base(x)
            for k, level in enumerate(self.levels):
                p = level.p(context[self.width - k:], x, p, less[k])
            out -= math.log2(p)
        return out


def brute_force(rows, good):
    """Bits per byte, by row."""
    words = [re.findall(b"[^\x20\x09-\x0D]+", (r["text"] or "").encode()) for r in rows]
    words = [[*w, b""] if w else [] for w in words]
    trusted = [good.get(r["doc_id"]) == {(1, 0)} for r in rows]
    langs = [r["lang"] or ALL for r in rows]
    spelt = Model([list(w + b" ") for ws, t in zip(words, trusted) if t for w in ws], 2, lambda x: 1 / 256)
    # A word begins after two spaces, which a model of bytes has for its two None.
    known = {}

    def spell(w):
        if w not in known:
            known[w] = 2 ** -spelt.bits(list(w + b" "))
        return known[w]

    texts = collections.defaultdict(list)
    for ws, t, lang in zip(words, trusted, langs):
        if t and ws:
            texts[ALL].append(ws)
            if lang != ALL:
                texts[lang].append(ws)
    used = {lang if lang in texts else ALL for lang in langs}
    plain = {lang: Model(texts[lang], 1, spell) for lang in used}
    offs = [discounts([n for m in plain.values() for n in m.levels[k].counts.values()]) for k in range(2)]
    models = {lang: Model(texts[lang], 1, spell, offs) for lang in used}
    mine = [lang if lang in texts else ALL for lang in langs]
    sums = [models[m].bits(ws, t) for m, ws, t in zip(mine, words, trusted)]
    size = [sum(len(w) + 1 for w in ws[:-1]) for ws in words]
    mean = {}
    for m in {*mine, ALL}:
        chosen = [i for i, t in enumerate(trusted) if t and m in (mine[i], ALL)]
        mean[m] = sum(sums[i] for i in chosen) / sum(size[i] for i in chosen)
    return [(sums[i] + PRIOR * mean[mine[i]]) / (size[i] + PRIOR) for i in range(len(rows))]


def check(spark, rows, labels):
    good = collections.defaultdict(set)
    for r in labels:
        good[r["doc_id"]].add((r["quality"], r["toxic"]))
    docs = spark.createDataFrame([(i, r["doc_id"], r["text"], r["lang"]) for i, r in enumerate(rows)],
                                 "n long, doc_id long, text string, lang string")
    got = quality(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    want = brute_force(rows, good)
    assert len(got) == len(rows)
    for r, bits in zip(rows, want):
        found = [g.bits for g in got if g.doc_id == r["doc_id"] and g.lang == (r["lang"] or ALL)
                 and g.n_bytes == len((r["text"] or "").encode())]
        assert found and any(b == pytest.approx(bits, rel=1e-5) for b in found), (r["doc_id"], bits, found)


def small_rows():
    rows = [{k: r[k] for k in ("doc_id", "text", "lang")} for r in pq.read_table(f"{DIR}/documents.parquet").to_pylist()]
    return [{**r, "text": r["text"][:1500]} for r in rows[:120]], pq.read_table(f"{DIR}/labels.parquet").to_pylist()


@pytest.mark.parametrize("hot_keys", [0, 400, 1 << 18])
def test_word_model_matches_brute_force(spark, monkeypatch, hot_keys):
    """Whatever is broadcast. A language without trusted text, a null one, empty texts, repeated rows."""
    monkeypatch.setattr(module, "HOT_KEYS", hot_keys)
    rows, labels = small_rows()
    rows += [{"doc_id": 9001, "text": rows[0]["text"], "lang": None}, {"doc_id": 9002, "text": rows[1]["text"], "lang": "xx"},
             {"doc_id": 9003, "text": "", "lang": "en"}, {"doc_id": 9004, "text": None, "lang": "en"},
             {"doc_id": 9005, "text": " \n ", "lang": "en"}, rows[2], rows[3], {**rows[4], "lang": None},
             {"doc_id": 9006, "text": "слово 漢字 \x00 é", "lang": "en"}]
    check(spark, rows, labels)


def test_every_byte_and_every_language_counts(spark):
    """Characters beyond ASCII are told apart, a language of one document has a model of its own."""
    langs = [f"l{i}" for i in range(40)]
    rows = [{"doc_id": i, "lang": lang, "text": f"{chr(0x430 + i % 30)}{chr(0x4E00 + i)} слово{i} и{i} слово"}
            for i, lang in enumerate(langs)]
    labels = [{"doc_id": i, "quality": 1, "toxic": 0} for i in range(40)]
    extra = [{"doc_id": 100 + i, "lang": lang, "text": rows[i if same else (i + 1) % 40]["text"]}
             for i, lang in enumerate(langs) for same in (True,)]
    swapped = [{"doc_id": 200 + i, "lang": lang, "text": rows[(i + 7) % 40]["text"]} for i, lang in enumerate(langs)]
    check(spark, rows + extra + swapped, labels)


def test_pairs_in_parts_give_the_same(spark, monkeypatch):
    """Parts bound what is on disk at a time; all pairs are counted and no score depends on them."""
    counted, stage = [], module.stage

    def record(df, label):
        out = stage(df, label)
        if label == "pairs":
            counted.append(out.agg({"n": "sum"}).first()[0])
        return out

    rows, labels = small_rows()
    good = {r["doc_id"] for r in labels if (r["quality"], r["toxic"]) == (1, 0)}
    monkeypatch.setattr(module, "stage", record)
    monkeypatch.setattr(module, "PART_WORDS", 1)
    check(spark, rows, labels)
    words = [len(re.findall("[^\x20\x09-\x0D]+", r["text"])) + 1 for r in rows if r["doc_id"] in good]
    assert len(counted) == module.PARTS and sum(counted) == sum(words)
