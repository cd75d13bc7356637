import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripwright.llm.tokenizer_files import BYTE_LEVEL, WORD_LEVEL
from tripwright.llm.tokens import SpaceEncoder, WordEncoder

CASES = [
    "", " ", " a", "a ", "  a   b  ", "it's don't 'sun I'll\n\n x", "a \n b", "a\n \nb", "\t a\t b \n", "x\x1cy z", "\n", "   \n  x",
    "<|endoftext|> a<|endoftext|>b", "a <|endoftext|> b", "x <|startoftext|>  y", "<|endof text|>", "123 4567 a1b2", "日本 語 텍스트 é", "ΑΣ ΣΑΣ İ ß", "a\r\nb \r\n c", "a  b\u0085 c", "　   x",
    "Straße. Über, naïve; cœur!", "a" * 3000,
]
PAIRS = [(WordEncoder, WORD_LEVEL), (SpaceEncoder, BYTE_LEVEL)]


def library(path):
    """The file's tokenizer, unchanged."""
    return Tokenizer.from_file(path)


@pytest.mark.parametrize("kind,path", PAIRS)
def test_ids_are_those_of_the_library(kind, path):
    encode, t = kind(path), library(path)
    for text in CASES:
        assert np.frombuffer(encode(text.encode()), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("kind,path", PAIRS)
def test_ids_of_any_text(kind, path):
    encode, t = kind(path), library(path)

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=st.sampled_from(" \n\t .,'sabÀé́9") | st.characters(codec="utf-8"), max_size=40))
    def same(text):
        assert np.frombuffer(encode(text.encode()), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids

    same()
