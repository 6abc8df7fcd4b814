import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.fixtures import SCHEMA, frame, key_sorted, mixed_rows
from tripstar.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def direct(tokenizer, rows):
    out = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        out.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return key_sorted(out)


def test_words_encode_alone_as_in_their_text(tokenizer):
    vocabulary = bpe.Vocabulary(open(PATH, encoding="utf-8").read())
    pick = random.Random(1)
    bits = [" ", "  ", "\n", "\t", "\xa0", " ", " ", "​", "\x85", "\x1c", "a", "é", "ß", "'s", "don't", "12", "!",
            "<|endoftext|>", "<|end", "漢", "😀", "\r\n", "_", "²", "́"]
    for _ in range(5000):
        text = "".join(pick.choices(bits, k=pick.randint(0, 14)))
        ws = bpe.words(text, vocabulary.specials)
        assert "".join(ws) == text
        ids = [i for w in ws for i in tokenizer.encode(w, add_special_tokens=False).ids]
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
        assert vocabulary.decode(np.array(ids, "<u4")) == tokenizer.decode(ids, skip_special_tokens=False)


def test_round_trip_matches_the_tokenizer(spark, tokenizer):
    rows = mixed_rows() + [(7, "one <|endoftext|>  two\n\n\nthree "), (8, "x" * 30_000), (9, " \n\t "), (10, "żółć 漢字 😀")]
    got = key_sorted(bpe.digest(bpe.tokenize(frame(spark, rows), PATH)).collect())
    assert got == direct(tokenizer, rows)


def test_real_outputs(spark, tokenizer):
    row = bpe.tokenize(frame(spark, [(1, "a real text, two words")]), PATH).first()
    assert np.frombuffer(row.ids, "<u4").tolist() == tokenizer.encode("a real text, two words").ids
    assert row.decoded == "a real text, two words"
    assert bpe.tokenize(spark.createDataFrame([], SCHEMA), PATH).count() == 0
