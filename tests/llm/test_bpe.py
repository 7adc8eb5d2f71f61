import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfscan.llm.bpe import Decoder, Encoder, Transducer, encode_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def run(text):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        return ids, tokenizer.decode(ids, skip_special_tokens=False)

    return run


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH)


def ours(encoder, text):
    ids = [i for part in encoder.encode(text.encode()) for i in part]
    decoder = Decoder(encoder.vocabulary)
    return ids, decoder.feed(ids) + decoder.close()


def test_random_texts_equal_the_library(encoder, library):
    rng = random.Random(11)
    alphabet = "aabcdehilnorstu  '’.,!?#ñéß漢字한가İΣσς́ \t\n\x1c\x85 019ﬁǅ"
    for _ in range(1500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        if rng.random() < 0.2:
            text += rng.choice(["<|endoftext|>", "it's we're I'LL 'stuff", "<|startoftext|>x", "<|END"]) + text
        assert ours(encoder, text) == library(text)


def test_long_words_equal_the_library(encoder, library):
    rng = random.Random(12)
    for alphabet in ("ab", "theinaer", "aaaab", "abcdefghijklmnopqrstuvwxyz"):
        text = "".join(rng.choice(alphabet) for _ in range(9000))
        assert ours(encoder, text + " " + text[:70_000]) == library(text + " " + text[:70_000])


def test_transducer_emits_only_stable_tokens_from_a_small_buffer(encoder):
    vocabulary, rng = encoder.vocabulary, random.Random(13)
    assert vocabulary.is_proper and 0 < encoder.lookahead < 2000
    for _ in range(60):
        word = "".join(rng.choice("thinanereonedsti") for _ in range(rng.randint(1, 2500))).encode()
        symbols = vocabulary.inner[list(word[:-1])].tolist() + [int(vocabulary.final[word[-1]])]
        stream, out = Transducer(vocabulary, encoder.lookahead, block=8), []
        for symbol in symbols:
            out += stream.feed([symbol])
            assert len(stream.held) <= encoder.lookahead + 8 + 64
        assert out + list(stream.close()) == vocabulary.merge(symbols)


def test_slices_do_not_change_ids(encoder, library, monkeypatch):
    monkeypatch.setattr("shelfscan.llm.bpe.SLICE", 50)
    text = "It's a text\nwith  many   words, and" + "averyveryverylong" * 9 + " word, Ünïcödé 漢字 " * 5
    assert ours(encoder, text) == library(text)


def test_incremental_text_decoder(encoder):
    text = "the 漢字 of ünïcödé , end"
    decoder = Decoder(encoder.vocabulary, plain=True)
    parts = [decoder.feed([i]) for i in ours(encoder, text)[0]]
    assert ("".join(parts) + decoder.close()).split() == text.split()
    assert "�" not in "".join(parts)


def test_awkward_rows(awkward, nothing, library):
    expected = []
    for r in awkward.collect():
        ids, text = library(r["text"])
        numbers = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        expected.append((r["doc_id"], len(ids), numbers, hashlib.sha256(text.encode()).hexdigest(), ids))
    got = [tuple(r) for r in encode_rows(awkward, keep_ids=True).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert encode_rows(nothing).collect() == []
