import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from limnospark.llm.encoding import Encoder
from tokenizers import AddedToken, Tokenizer

ENCODER = Encoder(public_tokenizers.path("byte_bpe_50k.json"), remember=500)
ODD = st.sampled_from([*" \t\n\r\x0b\x1c\x85\xa0 ᠎ ​  　﻿\x00'!.,*$a1_é²日😀́", "'s", " the", "<|endoftext|>", "  ", "Don't!!", "l'eau."])


@settings(max_examples=1500, deadline=None)
@given(st.lists(ODD, max_size=16).map("".join) | st.text(max_size=60))
def test_pieces_give_the_ids_of_the_whole_text(text):
    whole = ENCODER._tokenizer.encode(text, add_special_tokens=False).ids
    assert ENCODER.encode(text).tolist() == whole


def test_sentence_ends():
    ends = ENCODER.ends_sentence()
    assert [bool(ends[i]) for i in ENCODER.encode("one. two\n")] == [False, True, False, True]


FRESH = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))  # the library's default, unchanged
MARKED = st.lists(ODD | st.just("<|endoftext|>") | st.sampled_from(["<|endoftext|", "|>", "<|", "  <|endoftext|>  ", "\n"]), max_size=12).map("".join)


@settings(max_examples=1000, deadline=None)
@given(MARKED)
def test_added_tokens_as_the_library_has_them(text):
    assert ENCODER.encode(text).tolist() == FRESH.encode(text, add_special_tokens=False).ids


def test_end_of_text_is_one_id():
    assert ENCODER.encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]


@pytest.mark.parametrize("flags", [{"lstrip": True}, {"rstrip": True}, {"single_word": True}, {}])
def test_other_added_tokens(tmp_path, flags):
    path = str(tmp_path / "v.json")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.add_tokens([AddedToken("<|end", **flags), AddedToken("<mark>", **flags)])
    tokenizer.save(path)
    own, fresh = Encoder(path), Tokenizer.from_file(path)
    for text in ("a <|endoftext|> b", "a <mark> b", "a<mark>b <|end c", "<|end", "a <|end\n\n<mark><mark>"):
        assert own.encode(text).tolist() == fresh.encode(text, add_special_tokens=False).ids
