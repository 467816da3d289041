"""Texts are cut at single line feeds too, so a line's end and the next line's start are not one piece to encode."""

import pytest

from ticketmill.llm import bitpack
from ticketmill.llm.queries import tokenizer_path


def test_a_line_feed_between_words_opens_a_piece():
    tokenizers = pytest.importorskip("tokenizers")
    path = tokenizer_path("byte_bpe_50k.json")
    library, own = tokenizers.Tokenizer.from_file(path), bitpack.Encoder(path)
    texts = ["one two.\nThree four.\nThree", "two.\nThree", "a\n\nb \nc\r\nd", "\nfirst\n", "\n", "", "x\n!y<|endoftext|>\nz", "é\nÉ.\n中"]
    for _ in range(2):
        assert [ids.tolist() for ids in own.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    known = own.encode(["one two.\nThree"]) and own.known
    assert "\nThree" in known and "two." in known
    assert not any("\n" in piece[1:] for piece in known if piece.startswith(("one", "two", "Three", "\nThree")))
