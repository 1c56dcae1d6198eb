"""Byte-pair results equal the public tokenizers package; characters round-trip."""

import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, decoders, models, pre_tokenizers, processors, trainers

from shardweave.functions import bytelevel
from shardweave.operators import bpe_encode, bpe_merge, bpe_train, char_vocab
from shardweave.operators.tokenizers import register_sql, tokenizer
from shardweave.plans import catalog
from shardweave.session import SETTINGS
from shardweave.sources import artifacts


def library(texts, size):
    tok = Tokenizer(models.BPE(unk_token="[UNK]"))
    tok.pre_tokenizer = pre_tokenizers.ByteLevel()
    tok.decoder = decoders.ByteLevel()
    tok.train_from_iterator(texts, trainers.BpeTrainer(
        vocab_size=size, special_tokens=bytelevel.SPECIALS, show_progress=False))
    model = json.loads(tok.to_str())["model"]
    tokens = sorted(model["vocab"], key=model["vocab"].get)
    return tok, tokens, [tuple(m) for m in model["merges"]]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(4)


@pytest.fixture(scope="module")
def learnt(spark, texts):
    vocab = bpe_train.learn(bpe_train.word_counts(frame(spark, texts)), 500)
    return vocab, library(texts, 500)


def test_vocabulary_and_merges(learnt):
    vocab, (_, tokens, merges) = learnt
    assert vocab.tokens == tokens
    assert vocab.merges == merges


def test_a_vocabulary_of_full_size(spark):
    """8,000 tokens from 1,000 documents, through rounds of many merges each."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    _, tokens, merges = library([r.text for r in docs.collect()], 8000)
    vocab = bpe_train.learn(bpe_train.word_counts(docs))
    assert len(tokens) == 8000 and (vocab.tokens, vocab.merges) == (tokens, merges)


@pytest.mark.parametrize("seed", range(4))
def test_ties_and_small_bounds(spark, monkeypatch, seed):
    """Tiny alphabets are full of ties; tiny bounds force every way out of a round."""
    rng = random.Random(seed)
    texts = [" ".join("".join(rng.choice("ab" if seed % 2 else "abcde")
                              for _ in range(rng.randint(1, 9))) for _ in range(8))
             for _ in range(12)]
    monkeypatch.setattr(bpe_train, "MAX_PIECES", [4, 12, 50_000, 3][seed])
    monkeypatch.setattr(bpe_train, "MAX_HOT_PAIRS", [8, 4096, 16, 2][seed])
    _, tokens, merges = library(texts, 32)
    vocab = bpe_train.learn(bpe_train.word_counts(frame(spark, texts)), 32, hot_pairs=4)
    assert (vocab.tokens, vocab.merges) == (tokens, merges)


@pytest.mark.parametrize("seed", range(300))
def test_replay_on_random_words(seed):
    """The driver-side replay alone, on many corpora, until no pair is left."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("ab" if seed % 3 else "abcd") for _ in range(rng.randint(1, 12)))
             for _ in range(rng.randint(1, 12))]
    tok = Tokenizer(models.BPE())
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    tok.train_from_iterator(words, trainers.BpeTrainer(vocab_size=60, show_progress=False))
    model = json.loads(tok.to_str())["model"]
    ids = {c: i for i, c in enumerate(sorted(set("".join(words))))}
    merges, pieces = [], [(list(w), 1) for w in words]
    while len(ids) < 60:
        found = bpe_train._replay([(list(s), n) for s, n in pieces], ids, 0, 60)
        if not found:
            break
        merges += found
        for pair in found:
            pieces = [(bpe_train._merge_once(s, pair), n) for s, n in pieces]
    assert merges == [tuple(m) for m in model["merges"]]
    assert sorted(ids, key=ids.get) == sorted(model["vocab"], key=model["vocab"].get)


@pytest.mark.parametrize("size", [1, 2, 40, 500])
def test_long_words_merge_like_short_ones(size):
    rng = random.Random(size)
    syms = [rng.choice("abc") for _ in range(size)]
    pairs = [("a", "b"), ("b", "c"), ("a", "a"), ("ab", "c"), ("aa", "aa"), ("c", "c"), ("ab", "ab")]
    ranks = {p: i for i, p in enumerate(pairs)}
    want = syms
    for pair in pairs:
        want = bpe_train._merge_once(want, pair)
    assert bpe_train._merge_long(syms, ranks) == want


ODD = ["", " ", "  lead", "[UNK]", "a[EOS]b  c[BOS]", "[EOS][EOS] [BOS", "日本 😀 don't x y",
       "\n\n a\t\tb ", "it's we'll I'M 12 3٣", "the" * 400 + " " + "Xy" * 300, "tail   ", "a\x85b"]


def test_encode_and_decode(spark, learnt, texts):
    vocab, (tok, _, _) = learnt
    cases = texts + ODD
    df = frame(spark, cases).select(
        "i", bpe_encode.encode(F.col("text"), vocab).alias("ids"),
        bpe_encode.encode(F.col("text"), vocab, add_specials=True).alias("full"))
    rows = df.withColumn("back", bpe_encode.decode(F.col("ids"), vocab)).collect()
    plain = {r.i: (r.ids, r.back) for r in rows}
    for i, text in enumerate(cases):
        ids = tok.encode(text, add_special_tokens=False).ids
        assert plain[i] == (ids, tok.decode(ids)), text
    tok.post_processor = processors.TemplateProcessing(
        single="[BOS] $A [EOS]", special_tokens=[("[BOS]", 1), ("[EOS]", 2)])
    assert {r.i: r.full for r in rows} == {i: tok.encode(t).ids for i, t in enumerate(cases)}
    tok.post_processor = None


def test_specials_as_plain_text(spark, learnt):
    """Escaped literals are text: brackets are unknown here, the letters are not."""
    vocab, _ = learnt
    ids = bpe_encode.encode(F.col("text"), vocab, specials_in_text="escape").alias("ids")
    row = frame(spark, ["x[EOS]y"]).select(ids).withColumn(
        "t", bpe_encode.decode(F.col("ids"), vocab)).first()
    assert row.ids.count(0) == 2 and 2 not in row.ids
    assert row.t == " xEOSy"
    with pytest.raises(ValueError, match="policy"):
        bpe_encode.encode(F.col("text"), vocab, specials_in_text="drop")


def test_null_texts_stay_null(spark, learnt):
    vocab, _ = learnt
    df = spark.createDataFrame([(None,), ("a",)], "text string")
    found = [r[0] for r in df.select(bpe_encode.encode(F.col("text"), vocab)).collect()]
    assert found[0] is None and found[1]


def test_vocabulary_round_trip(spark, learnt, tmp_path):
    vocab, _ = learnt
    artifacts.save_vocabulary(vocab, spark, str(tmp_path / "v"))
    assert artifacts.load_vocabulary(spark, str(tmp_path / "v")) == vocab


def test_width_guard():
    assert bpe_encode.check_width(65_535) == 65_535
    with pytest.raises(ValueError):
        bpe_encode.check_width(65_536)
    with pytest.raises(ValueError, match="not defined"):
        bpe_train.Vocabulary(["a"], []).id_of("[EOS]")


def test_pretrained_import(spark, learnt, tmp_path):
    """The two published files are read; no leading space is added."""
    _, (tok, tokens, merges) = learnt
    tok.model.save(str(tmp_path))
    pre = tokenizer("hf_auto", spark=spark, folder=str(tmp_path))
    assert pre.fit(None).vocab_size == len(tokens)
    plain = Tokenizer.from_str(tok.to_str())
    plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    cases = ["Hello there", " x", "a\n\nb"]
    rows = frame(spark, cases).select("i", pre.encode(F.col("text")).alias("ids")).collect()
    assert {r.i: r.ids for r in rows} == {i: plain.encode(t).ids for i, t in enumerate(cases)}


def test_characters(spark, tmp_path):
    cases = ["héllo", "日本😀", "", "a\nb"]
    df = frame(spark, cases)
    tok = tokenizer("char").fit(df)
    assert tok.chars == sorted(set("".join(cases)))
    assert tok.eos_id == tok.vocab_size == len(tok.chars)
    coded = df.withColumn("ids", tok.encode(F.col("text")))
    for r in coded.withColumn("back", tok.decode(F.col("ids"))).collect():
        assert r.ids == [tok.chars.index(c) for c in r.text] and r.back == r.text
    tok.save(spark, str(tmp_path))
    assert tokenizer("char").load(spark, str(tmp_path)).chars == tok.chars
    with pytest.raises(Exception, match="not in the vocabulary"):
        frame(spark, ["z"]).select(tok.encode(F.col("text"))).collect()
    with pytest.raises(ValueError, match="not fitted"):
        tokenizer("char").encode(F.col("text"))


def test_names(spark):
    assert tokenizer("bpe").kind == "bpe"
    with pytest.raises(ValueError, match="unknown"):
        tokenizer("other")


def test_sql_functions(spark, learnt):
    vocab, (tok, _, _) = learnt
    bpe = tokenizer("bpe")
    bpe.vocab = vocab
    register_sql(spark, bpe)
    frame(spark, ["the hand", "", "it's"]).createOrReplaceTempView("some_texts")
    rows = spark.sql("SELECT text, tokenize(text) AS ids, detokenize(tokenize(text)) AS back "
                     "FROM some_texts").collect()
    for r in rows:
        assert r.ids == tok.encode(r.text, add_special_tokens=False).ids
        assert r.back == tok.decode(r.ids)


def test_sql_functions_equal_the_column_functions(spark, learnt):
    """Literal specials included; table functions work with LATERAL."""
    vocab, _ = learnt
    bpe = tokenizer("bpe")
    bpe.vocab = vocab
    register_sql(spark, bpe)
    frame(spark, [*ODD, None]).createOrReplaceTempView("odd_texts")
    wanted = {r.i: r.ids for r in spark.table("odd_texts").select("i", bpe.encode(F.col("text")).alias("ids")).collect()}
    assert {r.i: r.ids for r in spark.sql("SELECT i, tokenize(text) AS ids FROM odd_texts").collect()} == wanted
    rows = spark.sql("SELECT i, pos, id FROM odd_texts, LATERAL tokens_of(text)").collect()
    found = {i: [] for i in wanted}
    for r in sorted(rows):
        assert r.pos == len(found[r.i])
        found[r.i].append(r.id)
    assert found == {i: ids or [] for i, ids in wanted.items()}
    rows = spark.sql("SELECT i, w.* FROM (SELECT i, tokenize(text) AS ids FROM odd_texts), LATERAL token_windows(ids, 3) w").collect()
    assert {(r.i, r.start): (r.x, r.y) for r in rows} == {
        (i, s): (ids[s:s + 3], ids[s + 1:s + 4]) for i, ids in wanted.items() for s in range(len(ids or []) - 3)}
    with pytest.raises(Exception, match="positive"):
        spark.sql("SELECT * FROM odd_texts, LATERAL token_windows(array(1, 2), 0)").collect()


@pytest.mark.parametrize("seed", range(3))
def test_merging_many_words_equals_one_by_one(seed):
    rng = random.Random(seed)
    words = [[rng.choice("abc") for _ in range(rng.randint(0, 12))] for _ in range(200)] + [["a"] * 301]
    merges = [("a", "a"), ("b", "c"), ("aa", "a"), ("bc", "aa"), ("aa", "aa"), ("a", "a")]
    names = sorted({t for a, b in merges for t in (a, b, a + b)} | set("abc"))
    number = {t: i for i, t in enumerate(names)}
    table = bpe_merge.MergeTable(*[[number[t] for t in part] for part in zip(*[(a, b, a + b) for a, b in merges])])
    syms, own = table.merge(np.array([number[t] for w in words for t in w]),
                            np.repeat(np.arange(len(words)), [len(w) for w in words]))
    ranks = {}
    for rank, pair in enumerate(merges):
        ranks.setdefault(pair, rank)
    assert [[names[i] for i in syms[own == j]] for j in range(len(words))] == [
        bpe_train.merge_symbols(w, ranks) for w in words]
    none = np.zeros(0, np.int64)
    assert not len(table.merge(none, none)[0])
    assert bpe_merge.MergeTable([], [], []).merge(syms, own)[0] is syms


def test_word_blocks_hold_the_pair_counts(spark):
    counts = spark.createDataFrame([("aab", 3), ("b", 5), ("", 2), ("é" * 40_000, 2), ("ab", 1)], "word string, n long")
    blocks = bpe_train.word_blocks(counts)
    assert {bpe_train._BYTE_CHARS[b] for r in blocks.collect() for b in r.seen} == {
        bytelevel.BYTE_TO_CHAR[b] for b in "abé".encode()}
    names = bytelevel.SPECIALS + bpe_train._BYTE_CHARS
    got = {(names[r.pair >> 32], names[r.pair & 0xFFFFFFFF]): r.n for r in bpe_train.block_pairs(blocks).collect()}
    spelt = counts.select(bpe_train.spelled(F.col("word")).alias("word"), "n")
    assert got == {(r.left, r.right): r.n for r in bpe_train.pair_counts(spelt).collect()}
    assert sum(len(r.sizes) for r in blocks.collect()) == 3


def test_learning_from_nothing(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert bpe_train.learn(empty, 50).tokens == bytelevel.SPECIALS


def test_characters_in_bounded_runs(monkeypatch):
    monkeypatch.setattr(char_vocab, "RUN_CHARS", 5)
    texts = pa.array(["x", "ab", None, "", "abcabcab", "c", "\U0001f600b", "ba"])[1:]
    chars = ["a", "b", "c", "\U0001f600"]
    ids = char_vocab.encoder(chars).func(texts)
    assert ids.to_pylist() == [[0, 1], None, [], [0, 1, 2, 0, 1, 2, 0, 1], [2], [3, 1], [1, 0]]
    assert char_vocab.decoder(chars).func(ids).to_pylist() == texts.to_pylist()
    assert char_vocab.encoder(chars).func(texts[:0]).to_pylist() == []
    for bad in ("az", "a\U0010ffff", "!"):
        with pytest.raises(ValueError, match="not in the vocabulary"):
            char_vocab.encoder(chars).func(pa.array(["ab", bad]))


def test_words_in_bounded_runs(monkeypatch):
    monkeypatch.setattr(bpe_encode, "RUN_WORDS", 3)
    vocab = bpe_train.Vocabulary(["[UNK]", "a", "b", "ab"], [("a", "b")], ["[UNK]"])
    lists = pa.array([["q"], ["ab", "a", "b", "ab"], None, [], ["ba"], ["ab"]])[1:]
    ids = bpe_encode.word_lookup(vocab)(lists)
    assert ids.to_pylist() == [[3, 1, 2, 3], None, [], [2, 1], [3]]
    spelled = bpe_encode.text_decoder(vocab, skip_specials=True).func(pa.array([[3, 0, 1], None, [], [9, -1, 2]]))
    assert spelled.to_pylist() == ["aba", None, "", "b"]


def test_queries_set_the_batches_they_rely_on(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "10000")
    catalog.QUERIES["char_encode"](spark, "/root/testdata/sf0.001")
    assert spark.conf.get(key) == before == SETTINGS[key]
