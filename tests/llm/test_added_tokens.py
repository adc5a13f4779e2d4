"""Texts that contain the vocabulary's added tokens literally."""

import numpy as np
import pytest

from tessera.llm import token_blocks

P = pytest.importorskip("public_tokenizers")


def test_added_tokens_equal_the_library():
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    library, words = Tokenizer.from_file(path), token_blocks.Words(path)
    for text in ("foo <|endoftext|> bar", "a<|startoftext|>b. C", "Foo <|EndOfText|> bar", "<|endoftext|>", "foo | endoftext bar.", ""):
        assert np.frombuffer(words.encode(text.encode()), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_runs_of_many_texts_are_learned_together():
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    library, words = Tokenizer.from_file(path), token_blocks.Words(path, memory=300)
    texts = [f"Qu{'abcdefghij'[i % 10]}rtz{'klmnopqrst'[i // 10]}x  Straße{i}, don't É{i} tōkyō ıstanbul x İ ² ǅ é <|endoftext|>"[: None if i % 7 == 0 else 45] for i in range(100)]
    texts += ["", " \t\x0b ", "\x1c", "##", "plain words only", "ᾳ ŉ ﬁ", "a\x00b"]
    calls, learn = [], words._learn
    words._learn = lambda new: (calls.append(len(new)), learn(new))
    for _ in range(2):  # the second time some have gone to the older ones
        for text, ids in zip(texts, words.encode_all([x.encode() for x in texts]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert len(calls) <= 2
    assert words.encode_all([]) == []
