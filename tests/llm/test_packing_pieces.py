"""Texts cut into pieces for the encoder's cache."""

import random

from replyloom.llm import packing

PARTS = [" ", "  ", "\n", "\n\n", " \n", "'", "'s", "it's", ".", "...", ".'", "!", "word", "Wörd", "日本", "1", "a1", "_x", "\t", " ", " ", "é", "💡", "\x00", "<|endoftext|>", "[", "~", "\r\n", "\x85"]


def test_pieces_give_the_tokenizers_ids():
    enc = packing.Encoder(packing.default_tokenizer())
    rnd = random.Random(5)
    texts = ["".join(rnd.choices(PARTS, k=rnd.randint(0, 12))) for _ in range(4000)] + [None, "", "\n", "end\n"]
    assert enc.batch(texts) == [b"" if not t else enc._encode([t])[0] for t in texts]


def test_a_word_is_encoded_once_whatever_follows():
    enc = packing.Encoder(packing.default_tokenizer())
    text = "the beta. beta, beta; beta\nbeta! beta"
    assert enc.batch([text]) == enc._encode([text])
    assert {p for p in enc.known if "beta" in p} == {" beta", "beta"}
