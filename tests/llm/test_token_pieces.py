"""The longer pieces that token files give to the tokenizers library change no id."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, decoders, models, normalizers, pre_tokenizers

from subtide.llm import bpe, token_files
from tests.llm.samples import prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
SIGNS = [*"aest rvmld  ,,..;:!?'’-\"()\n\n\t\r12éÉßüñ中я…“”½Ⅷ_ª™® ​́\U0001f600\x85\x1c\x00"]
PARTS = ["'s", "'re", "n't", " the", " of", ", ", ". ", ".\n", "word", "Été", token_files.PIECES, "<|endoftext|>"]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


def test_words_in_a_row_are_one_piece():
    pieces = token_files.library(PATH).pre_tokenizer.pre_tokenize_str("One word, and others. More;\nthe end " * 8)
    assert len(pieces) == 2


def test_ids_equal_those_of_the_plain_library(plain):
    rng = random.Random(5)
    tokens = [plain.decoder.decode([token]) for token in sorted(plain.get_vocab(with_added_tokens=False))]
    coder = token_files.library(PATH)
    texts = ["", " ", "word " * 300, prose(1, 500)]
    for _ in range(1500):
        texts.append("".join(rng.choices(SIGNS + PARTS, k=rng.randrange(1, 60))))
        texts.append("".join(rng.choice(tokens) + rng.choice(["", " ", ", ", ".\n"]) for _ in range(rng.randrange(1, 80))))
    for text in texts:
        assert coder.encode_batch_fast([text], add_special_tokens=False)[0].ids == ids_of(plain, text), text


@pytest.mark.parametrize("token, longer", [("ab", True), ("aĠ", False), ("a,", False), (".Ċ", False), ("Ċa", False), ("©Ġ", False)])
def test_a_token_over_a_boundary_keeps_the_plain_pieces(token, longer):
    letters = [*bpe.byte_letters()]
    vocabulary = {letter: n for n, letter in enumerate([*letters, token])}

    coder, plain = (Tokenizer(models.BPE(vocabulary, [tuple(token)])) for _ in range(2))
    for tokenizer in (coder, plain):
        tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
        tokenizer.decoder = decoders.ByteLevel()
    assert token_files.long_pieces(coder) == longer
    for text in ("aba ba, a,b a.\na.b\n\nab é a é, a", "a b", "a,b a, b"):
        assert ids_of(coder, text) == ids_of(plain, text)


def test_other_tokenizers_stay_as_they_are():
    other = Tokenizer.from_file(PATH)
    other.normalizer = normalizers.Lowercase()
    assert not token_files.long_pieces(other)
    other = Tokenizer.from_file(PATH)
    other.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    assert not token_files.long_pieces(other)
