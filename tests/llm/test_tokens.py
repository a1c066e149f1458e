"""BPE codec and token counts against the libraries."""

from __future__ import annotations

import hashlib

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventflow.llm import bpe_codec, token_counts
from eventflow.llm.queries import QUERIES

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


def codec():
    with open(WORDS, "rb") as f:
        return bpe_codec.Codec(f.read())


def ids_of(own, texts):
    values, stops = own.encode(texts)
    return [values[a:b].tolist() for a, b in zip(stops, stops[1:])]


def test_encoding_of_every_character():
    library = Tokenizer.from_file(WORDS)
    texts = ["a" + chr(c) + "b" for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids_of(codec(), texts) == expected


def test_encoding_of_random_texts(chance):
    library = Tokenizer.from_file(WORDS)
    alphabet = "aabbcc'sthe1 2éÉΣß!?<|\n\t\x1c\x85"
    texts = ["".join(chance.choices(alphabet, k=chance.randint(0, 30))) for _ in range(4000)]
    texts += [f"{t}<|endoftext|>{t}" for t in texts[:200]] + ["ab" * 50_000]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids_of(codec(), texts) == expected


def test_both_kinds_of_exact_merge_agree(chance):
    vocabulary = codec().vocabulary
    words = ["".join(chance.choices("abcdetino", k=chance.randint(1, 14))) for _ in range(2000)]
    assert vocabulary.merge_all(words) == [vocabulary.merge(w) for w in words]


def test_some_guesses_hold_and_some_fail(chance):
    vocabulary = codec().vocabulary
    words = sorted({"".join(chance.choices("aeinrst", k=8)) for _ in range(500)})
    flat, owner = vocabulary.greedy(words)
    guesses = [flat[owner == i].tolist() for i in range(len(words))]
    right = sum(g == vocabulary.merge(w) for g, w in zip(guesses, words))
    assert 0 < right < len(words)
    assert list(vocabulary.encode_words(words).values()) == [vocabulary.merge(w) for w in words]


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe_codec, "CACHE_WORDS", 5)
    texts = ["one two three four five six", "one two seven", "eight nine one"]
    assert [ids_of(own, [t])[0] for own in [codec()] for t in texts] == ids_of(codec(), texts)


def test_odd_rows_round_trip(odd, odd_rows):
    library = Tokenizer.from_file(WORDS)
    encoded = bpe_codec.encode(odd, WORDS)
    decoded = bpe_codec.decode(encoded, WORDS)
    rows = {(r.doc_id, r.text): r for r in decoded.collect()}
    assert decoded.count() == len(odd_rows)
    for doc_id, text, *_ in odd_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert rows[doc_id, text].ids == ids
        assert rows[doc_id, text].decoded == library.decode(ids, skip_special_tokens=False)


def test_codec_of_no_rows(nothing):
    assert bpe_codec.decode(bpe_codec.encode(nothing, WORDS), WORDS).collect() == []


def test_codec_query(spark):
    library = Tokenizer.from_file(WORDS)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op1_bpe_codec"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_counts_of_random_texts(chance):
    processor = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    with open(PIECES, "rb") as f:
        counter = token_counts.Counter(f.read(), "", b"")
    texts = [chr(c) + "a" + chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(chance.choices("aabb the1 2éβ\n\t▁  \x00", k=chance.randint(0, 30))) for _ in range(4000)]
    assert counter.count(texts) == [len(i) for i in processor.encode(texts)]


def test_counts_of_odd_rows(odd, odd_rows):
    processor = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = token_counts.token_counts(odd, PIECES)
    assert [c for c in got.columns if c.lower() == "n_tokens"] == ["n_tokens"]
    counts = {(r.doc_id, r.text): r.n_tokens for r in got.collect()}
    assert counts == {(i, t): len(processor.encode(t or "")) for i, t, *_ in odd_rows}


def test_counts_of_no_rows(nothing):
    assert token_counts.token_counts(nothing, PIECES).collect() == []


def test_frequent_pre_tokens_are_the_corpus_most_frequent(spark):
    df = spark.createDataFrame([("the cat the dog the",)] * 50 + [(f"x{i}",) for i in range(300)], "text string")
    assert token_counts.frequent_pre_tokens(df, "text", 1) == [" the"]


def test_count_query(spark):
    processor = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op2_token_counts"](spark, SF).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(got) == docs.count()
    for r in got:
        n = len(processor.encode(r.text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(r.text.encode()), n, n > 4096)
    assert docs.where(F.col("text").isNull()).count() == 0
