import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shelfwise.llm import bpe, token_count
from shelfwise.llm.queries import QUERIES
from shelfwise.llm.shared import table
from tests.llm.support import SF_DIR, awkward, rows_of

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "ab", "the", "'", "'s", "'ll", " ", "  ", "\n", "\t", "é", "日本語", "😀", "1", "123", "!!", "<s>", "<0x0A>", "▁", "\0", "<|endoftext|>", "<|", "x" * 30, "9" * 25, " " * 20, "-" * 17, "​", "é", "Ⅷ", " "]


def random_texts(n, seed=4):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_counts_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = {r.doc_id: r.text or "" for r in table(spark, SF_DIR, "documents").collect()}
    found = QUERIES["op6_token_count"](spark, SF_DIR).collect()
    assert len(found) == len(texts)
    for r in found:
        n = len(library.encode(texts[r.doc_id]))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(texts[r.doc_id].encode()), n > 4096)


def test_odd_texts_equal_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    count = token_count.vocabulary(PIECES).count
    for text in random_texts(3000):
        assert count(text) == len(library.encode(text)), text


def test_kept_counts_are_bounded(monkeypatch):
    monkeypatch.setattr(token_count, "KEPT_SEGMENTS", 10)
    kept = token_count._Kept(len)
    assert [kept[str(k)] for k in range(100)] == [len(str(k)) for k in range(100)]
    assert len(kept) <= 10


def test_pieces_with_inner_blanks_are_refused():
    with pytest.raises(ValueError):
        token_count.Vocabulary({"a b": -1.0})


def test_count_awkward_rows(spark):
    rows = awkward(spark)
    found = {r.doc_id: r for r in token_count.count_tokens(rows, PIECES).collect()}
    assert (found[1].n_tokens, found[1].n_bytes, found[2].n_tokens) == (0, 0, 0)
    assert found[6].over_limit
    assert token_count.count_tokens(rows, PIECES).count() == rows.count()
    assert token_count.count_tokens(rows.limit(0), PIECES).count() == 0


def test_encoding_equals_the_library(spark):
    library = Tokenizer.from_file(BYTES)
    texts = {r.doc_id: r.text or "" for r in table(spark, SF_DIR, "documents").collect()}
    for r in QUERIES["op8_bpe"](spark, SF_DIR).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False)))


@pytest.mark.parametrize("leaf", [4, 8, 50])
def test_tree_of_odd_texts_equals_the_library(leaf):
    codec = bpe.codec(BYTES)
    texts = random_texts(1500, seed=leaf)
    wanted = [e.ids for e in codec.library.encode_batch(texts, add_special_tokens=False)]
    assert codec.encode(texts, leaf) == wanted
    assert [codec.decode(ids) for ids in wanted] == texts


@pytest.mark.parametrize("run", ["ab" * 6000, "a" * 9000, " " * 7000 + "x", "漢" * 4000, "'" * 5000 + "s", "\n" * 6001])
def test_long_runs_without_a_border(run):
    codec = bpe.codec(BYTES)
    rng = random.Random(1)
    mixed = "".join(rng.choice(run[:2] + run[-1]) for _ in range(5000))
    for text in (run, mixed):
        assert codec.encode([text], 700)[0] == codec.library.encode(text, add_special_tokens=False).ids


def test_encode_awkward_rows(spark):
    rows = awkward(spark)
    empty = hashlib.sha256(b"").hexdigest()
    found = {r.doc_id: r for r in bpe.encode_decode(rows, BYTES).collect()}
    assert tuple(found[1])[1:] == tuple(found[2])[1:] == (0, empty, empty)
    assert bpe.encode_decode(rows.limit(0), BYTES).count() == 0
    coded = bpe.with_tokens(rows, BYTES)
    assert coded.columns == [c for c in rows.columns if c != "token_ids"] + ["token_ids"]
    assert sorted(len(r.token_ids) for r in coded.collect()) == sorted(r.n_tokens for r in bpe.encode_decode(rows, BYTES).collect())
    assert rows_of(bpe.with_tokens(rows.limit(0), BYTES)) == []


def test_a_repeated_word_is_encoded_once(monkeypatch):
    codec = bpe.Codec(BYTES)
    encoded = []
    plain = codec.encode_words
    monkeypatch.setattr(codec, "encode_words", lambda texts, leaf: encoded.extend(texts) or plain(texts, leaf))
    text = "so sagt der Mann und so sagt der Hund" + " und so sagt der Mann" * 500
    wanted = codec.library.encode(text, add_special_tokens=False).ids
    assert [codec.encode([text, text]), codec.encode([text])] == [[wanted, wanted], [wanted]]
    assert sum(map(len, encoded)) < 40


def test_words_at_every_white_space_and_special_string_equal_the_library(monkeypatch):
    codec = bpe.Codec(BYTES)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 50)
    marks = [chr(k) for k in [*range(33), 0x7F, 0x85, 0xA0, 0xAD, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]]
    texts = [f"a{m}b {m} {m}{m}c{m} \n{m}'s  {m}<|endoftext|>{m} {m}x " for m in marks]
    rng = random.Random(5)
    pieces = [*marks, " ", "  ", "<|endoftext|>", "a", "'s", "x" * 70, " " * 90, "é", "漢字", "!!"]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    assert codec.encode(texts) == [e.ids for e in codec.library.encode_batch(texts, add_special_tokens=False)]
    assert len(codec._kept) <= 50
