import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from greenlake.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def enc():
    return bpe.encoding(PATH, PATTERN)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab1'st é\n\t  .-日_"), max_size=200), st.integers(1, 12))
def test_cut_texts_give_the_same_ids(text, size):
    enc = bpe.encoding(PATH, PATTERN)
    assert "".join(bpe.pieces(text, size)) == text
    assert [t for p in bpe.pieces(text, size) for t in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_rows(frame, enc):
    texts = ["Hello world", None, "", "<|endoftext|>", "naïve 日本\n\n x" * 20000, "a" * 3000, "Hello world"]
    docs = frame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    rows = bpe.encode_documents(docs, PATH, PATTERN).orderBy("doc_id").collect()
    assert len(rows) == len(texts)
    for r, t in zip(rows, texts):
        ids = enc.encode_ordinary(t or "")
        assert r["token_ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encode_documents(docs.where("false"), PATH, PATTERN).count() == 0


@pytest.mark.parametrize("run", [" ", "\n", " \t\u3000", "\r\n"])
def test_long_runs_of_white_space(enc, run):
    for n in (2000, 5000, 30_000):
        for text in (run * n, f"a{run * n}b", f"a.{run * n}", f"{run * n}'s {run * n}9"):
            assert bpe.encode_text(text, enc) == enc.encode_ordinary(text)
    for text in (run * 1_000_000, f"a{run * 1_000_000}b"):
        assert enc.decode_bytes(bpe.encode_text(text, enc)) == text.encode()


@pytest.mark.parametrize("text", ["." * 1_000_000, "漢字" * 300_000, "a" * 1_000_000, "é1" * 300_000])
def test_long_runs_without_a_cut(enc, text):
    ids = bpe.encode_text(text, enc)
    assert ids == enc.encode_ordinary(text) and enc.decode_bytes(ids) == text.encode()
