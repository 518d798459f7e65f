"""A worker that serves one stage after the other remembers the words of one of them."""

from murmuro.llm import token_files, toxicity, words
from murmuro.llm.catalog import tokenizer_path


def test_words_of_the_operator_before_are_forgotten():
    before = toxicity.features("Some words of a text")
    assert len(toxicity._PLACES) == 5
    words.word_hashes("other words")
    assert not len(toxicity._PLACES) and len(words._HASHES) == 2
    first = token_files._encoder(tokenizer_path())
    assert not words._HASHES and token_files._encoder(tokenizer_path()) is first
    again = toxicity.features("Some words of a text")
    assert not token_files._ENCODERS
    assert all((a == b).all() for a, b in zip(before, again, strict=True))
