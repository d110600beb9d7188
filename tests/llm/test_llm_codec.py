from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from llm_brute import awkward_texts, documents, empty_documents
from tokenizers import Tokenizer

from wardflow.llm.bpe_codec import BpeParams, Codec, encode_documents
from wardflow.llm.token_counts import (TokenCountParams, count_long, count_tokens, counter_for,
                                       stable, tokenizer_for)

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [*"abehinorst  \n\t'sld.,0123!-éüñÀ中文🙂", "<|endoftext|>", " the", "'re", "      ",
          "aaaaaaaa", "̀", "\x1c", "\x85", " ", "\n\n"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return Codec(open(PATH, encoding="utf-8").read())


def ids(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_encoder_equals_library_and_round_trips(library, codec):
    pick = random.Random(11)
    for _ in range(4000):
        text = "".join(pick.choice(PIECES) for _ in range(pick.randint(0, 40)))
        packed = codec.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == ids(library, text)
        assert codec.decode(packed) == text.encode()


@pytest.mark.parametrize("text", ["a" * 30_000, " " * 20_000, "ab" * 9000, "the" * 5000,
                                  "=" * 7777, "\n" * 999 + "x", "hahahah" * 2000])
def test_long_pieces_stay_linear_and_exact(library, codec, text):
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == ids(library, text)


def test_broken_bytes_decode_as_the_library_does(library, codec):
    for token_ids in ([241], [0, 255, 128, 50256], [162, 102], []):
        packed = np.array(token_ids, "<u4").tobytes()
        assert codec.decode(packed).decode() == library.decode(token_ids,
                                                               skip_special_tokens=False)


def test_encode_documents(spark, library):
    rows = awkward_texts()
    got = encode_documents(documents(spark), BpeParams(PATH, with_ids=True, with_text=True))
    want = sorted(
        (str(i), len(t), hashlib.sha256(np.array(t, "<u4").tobytes()).hexdigest(),
         hashlib.sha256(x.encode()).hexdigest())
        for i, x in ((i, x or "") for i, x in rows) for t in [ids(library, x)])
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256)
                  for r in got.collect()) == want
    assert all(len(r.ids) == r.n_tokens for r in got.collect())
    assert encode_documents(empty_documents(spark), BpeParams(PATH)).count() == 0


def test_spliced_counts_equal_whole_counts(library):
    tokenizer = tokenizer_for(open(PATH, encoding="utf-8").read())
    pick = random.Random(3)
    for _ in range(700):
        text = "".join(pick.choice(PIECES) for _ in range(pick.randint(0, 300)))
        for chunk, overlap in ((50, 8), (20, 3), (101, 20)):
            assert count_long(tokenizer, text, chunk, overlap) == len(ids(library, text))
    for text in ("a" * 20_000, " " * 20_000, "a b" * 9000, "a" * 20_000 + " b" * 5000):
        assert count_long(tokenizer, text, 4096, 64) == len(ids(library, text))


def test_only_word_ends_are_stable():
    text = "ab cd\n e"
    assert [i for i in range(len(text) + 1) if stable(text, i)] == [2, 5]


def test_count_tokens(spark, library):
    rows = awkward_texts()
    got = count_tokens(documents(spark), TokenCountParams(PATH, limit=100, chunk=5000)).collect()
    want = sorted((str(i), len((t or "").encode()), len(ids(library, t or "")),
                   len(ids(library, t or "")) > 100) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    assert count_tokens(empty_documents(spark), TokenCountParams(PATH)).count() == 0


def test_counter_equals_library_for_every_character(library):
    counter = counter_for(open(PATH, encoding="utf-8").read())
    chars = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    for before, after in (("a", "a"), ("1", " x"), (" ", "!")):
        texts = ["".join(before + c + after for c in chars[i:i + 256])
                 for i in range(0, len(chars), 256)]
        want = [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [counter.count(t) for t in texts] == want
    pick = random.Random(21)
    for _ in range(3000):
        text = "".join(pick.choice(PIECES) for _ in range(pick.randint(0, 60)))
        assert counter.count(text) == len(ids(library, text))
