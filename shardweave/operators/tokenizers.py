"""One interface over the vocabularies: learn from a table, encode and decode columns."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardweave.functions.bytelevel import EOS, WORD_PATTERN, literals, parts_pattern
from shardweave.operators import bpe_encode, bpe_train, char_vocab
from shardweave.sources import artifacts


class Tokenizer(Protocol):
    kind: str

    def fit(self, texts: DataFrame) -> "Tokenizer": ...
    def encode(self, text: Column, add_specials: bool = False) -> Column: ...
    def decode(self, ids: Column) -> Column: ...
    def save(self, spark: SparkSession, path: str) -> None: ...
    def load(self, spark: SparkSession, path: str) -> "Tokenizer": ...

    @property
    def vocab_size(self) -> int: ...

    @property
    def eos_id(self) -> int: ...


class CharTokenizer:
    kind = "char"

    def __init__(self) -> None:
        self.chars: list[str] = []

    def _fitted(self) -> list[str]:
        if not self.chars:
            raise ValueError("tokenizer is not fitted")
        return self.chars

    def fit(self, texts: DataFrame) -> CharTokenizer:
        self.chars = char_vocab.characters(char_vocab.learn(texts))
        return self

    def encode(self, text: Column, add_specials: bool = False) -> Column:
        return char_vocab.encode(text, self._fitted())

    def decode(self, ids: Column) -> Column:
        return char_vocab.decode(ids, self._fitted())

    def save(self, spark: SparkSession, path: str) -> None:
        rows = list(enumerate(self._fitted()))
        artifacts.save_characters(
            spark.createDataFrame([(c, i) for i, c in rows], "ch string, id int"), path)

    def load(self, spark: SparkSession, path: str) -> CharTokenizer:
        self.chars = artifacts.load_characters(spark, path)
        return self

    @property
    def vocab_size(self) -> int:
        return len(self.chars)

    @property
    def eos_id(self) -> int:
        """One past the last character."""
        return len(self._fitted())


class BpeTokenizer:
    kind = "bpe"
    skip_specials = True

    def __init__(self, vocab_size: int = bpe_train.VOCAB_SIZE) -> None:
        self.wanted = vocab_size
        self.vocab: bpe_train.Vocabulary | None = None

    def _fitted(self) -> bpe_train.Vocabulary:
        if self.vocab is None:
            raise ValueError("tokenizer is not fitted")
        return self.vocab

    def fit(self, texts: DataFrame) -> BpeTokenizer:
        self.vocab = bpe_train.learn(bpe_train.word_counts(texts), self.wanted)
        return self

    def encode(self, text: Column, add_specials: bool = False) -> Column:
        return bpe_encode.encode(text, self._fitted(), add_specials)

    def decode(self, ids: Column) -> Column:
        return bpe_encode.decode(ids, self._fitted(), self.skip_specials)

    def save(self, spark: SparkSession, path: str) -> None:
        artifacts.save_vocabulary(self._fitted(), spark, path)

    def load(self, spark: SparkSession, path: str) -> BpeTokenizer:
        self.vocab = artifacts.load_vocabulary(spark, path)
        return self

    @property
    def vocab_size(self) -> int:
        return len(self._fitted().tokens)

    @property
    def eos_id(self) -> int:
        return self._fitted().id_of(EOS)


class PretrainedTokenizer(BpeTokenizer):
    """A published vocabulary read from ``vocab.json`` and ``merges.txt``."""

    kind = "pretrained"
    skip_specials = False

    def __init__(self, spark: SparkSession | None = None, folder: str | None = None) -> None:
        super().__init__()
        if folder:
            self.vocab = artifacts.import_pretrained(
                spark, f"{folder}/vocab.json", f"{folder}/merges.txt")

    def fit(self, texts: DataFrame) -> PretrainedTokenizer:
        return self

    @property
    def eos_id(self) -> int:
        return self._fitted().id_of(self._fitted().specials[0])


KINDS = {
    "char": CharTokenizer, "CharTokenizer": CharTokenizer,
    "bpe": BpeTokenizer, "BPETokenizer": BpeTokenizer,
    "hf_auto": PretrainedTokenizer, "HFAutoTokenizer": PretrainedTokenizer,
    "pretrained": PretrainedTokenizer,
}


def tokenizer(kind: str = "char", **options) -> Tokenizer:
    """A tokenizer by name."""
    if kind not in KINDS:
        raise ValueError(f"unknown tokenizer: {kind}")
    return KINDS[kind](**options)


def _quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _words_sql(text: str, vocab: bpe_train.Vocabulary) -> str:
    """SQL twin of ``bytelevel.words``."""
    source = f"if(startswith({text}, ' '), {text}, concat(' ', {text}))" if vocab.prefix_space else text
    return (f"if({text} = '', cast(array() AS array<string>), "
            f"regexp_extract_all({source}, {_quoted(WORD_PATTERN)}, 0))")


def _cut_sql(text: str, vocab: bpe_train.Vocabulary) -> str:
    """SQL twin of ``bytelevel.words_with_specials``."""
    if not vocab.specials:
        return _words_sql(text, vocab)
    literal = literals(vocab.specials)
    parts = f"regexp_extract_all({text}, {_quoted(parts_pattern(vocab.specials))}, 0)"
    listed = ", ".join(map(_quoted, vocab.specials))
    return (f"if({text} rlike {_quoted(literal)}, flatten(transform({parts}, p -> "
            f"if(p IN ({listed}), array(p), {_words_sql('p', vocab)}))), {_words_sql(text, vocab)})")


def register_sql(spark: SparkSession, tok: Tokenizer) -> None:
    """SQL functions for one tokenizer.

    ``tokenize(text)`` and ``detokenize(ids)`` equal the column functions, literal specials in the text
    included. Table functions, for use with LATERAL: ``tokens_of(text)`` has a row ``(pos, id)`` per token,
    ``token_windows(ids, block)`` a row ``(start, x, y)`` per next-token window.
    """
    if isinstance(tok, CharTokenizer):
        spark.udf.register("tokenize", char_vocab.encoder(tok.chars))
        spark.udf.register("detokenize", char_vocab.decoder(tok.chars))
    else:
        vocab = tok._fitted()
        spark.udf.register("encode_words", F.arrow_udf(
            bpe_encode.word_lookup(vocab), T.ArrayType(T.IntegerType())))
        spark.sql(f"""
            CREATE OR REPLACE TEMPORARY FUNCTION tokenize(t STRING) RETURNS ARRAY<INT>
            RETURN encode_words({_cut_sql('t', vocab)})""")
        spark.udf.register("detokenize", bpe_encode.text_decoder(vocab, tok.skip_specials))
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION tokens_of(t STRING) RETURNS TABLE (pos INT, id INT)
        RETURN SELECT pos, id FROM (SELECT tokenize(t) AS ids) LATERAL VIEW posexplode(ids) AS pos, id""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION token_windows(ids ARRAY<INT>, block INT)
        RETURNS TABLE (start INT, x ARRAY<INT>, y ARRAY<INT>)
        RETURN SELECT start, slice(ids, start + 1, block), slice(ids, start + 2, block)
        FROM (SELECT if(block <= 0, raise_error('block must be positive'), if(size(ids) > block,
              sequence(0, size(ids) - block - 1), cast(array() AS array<int>))) AS starts)
        LATERAL VIEW explode(starts) AS start""")
