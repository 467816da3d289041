"""In a column of many pieces, a word with a mark behind it is the word and the mark, not a piece of its own that is looked up, learned and kept."""

import pytest

from ticketmill.llm import bitpack
from ticketmill.llm.queries import tokenizer_path

TEXTS = ["the and. thing, thon! the", "\nand.\nand, the.", "don't, can't.", "é. É, ß! ÿ? ×. ÷. 日. 12. a1.", "and.. bar!. and.  ", " a", "x' y' .", "<|endoftext|> a. <|endoftext|>.", "", None, "."]


@pytest.fixture()
def encoder(monkeypatch):
    pytest.importorskip("tokenizers")
    monkeypatch.setattr(bitpack, "MANY_PIECES", 0)
    return bitpack.Encoder(tokenizer_path("byte_bpe_50k.json"))


def test_words_with_marks_have_the_library_s_ids(encoder):
    want = [e.ids for e in encoder.library.encode_batch_fast([t or "" for t in TEXTS], add_special_tokens=False)]
    assert [ids.tolist() for ids in encoder.encode(TEXTS)] == want
    assert [ids.tolist() for t in TEXTS for ids in encoder.encode([t])] == want
    assert encoder.encode([]) == []


def test_only_the_word_is_kept(encoder):
    encoder.encode(["x thing thing. thing, thing! thing)"])
    assert encoder.known.keys() - {"x"} == {"thing"}
