"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame

from greenlake.llm.common import map_batches

#: Longer texts are cut before encoding, at places where every match of the split pattern ends.
PIECE_CHARS = 1 << 16
_BOUNDARY = re.compile(r"[A-Za-z0-9](?=[ \n])")
#: Runs of Unicode white space on which the pattern's look-ahead would have to go back too far.
_LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")
_LOADED: dict = {}


def encoding(ranks: str | bytes, pattern: str):
    """The tiktoken encoding of a rank file's path or bytes, loaded once in each Python worker."""
    import tiktoken

    if isinstance(ranks, str):
        with open(ranks, "rb") as f:
            ranks = f.read()
    key = hashlib.sha256(ranks).digest(), pattern
    if key not in _LOADED:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
        _LOADED[key] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _LOADED[key]


def _whole(enc):
    """The same vocabulary with a pattern that takes any text as one match."""
    import tiktoken

    if id(enc) not in _LOADED:
        _LOADED[id(enc)] = tiktoken.Encoding("whole", pat_str=r"(?s:.+)", mergeable_ranks=enc._mergeable_ranks, special_tokens={})
    return _LOADED[id(enc)]


def pieces(text: str, size: int = PIECE_CHARS):
    """Cut a text after a letter or digit that a space or line end follows.

    No alternative of the pattern runs from such a character into white space, and none looks back, so
    the pieces' matches are the whole text's matches. A text without such a place stays whole.
    """
    start = 0
    while len(text) - start > size:
        m = _BOUNDARY.search(text, start + size - 1)
        if not m:
            break
        yield text[start : m.end()]
        start = m.end()
    yield text[start:]


def encode_text(text: str, enc) -> list[int]:
    """Token ids of a text of any length.

    Of a very long run of white space the pattern takes all but the last character as one match, as that one
    belongs to what follows; the run is cut out there and encoded whole.
    """
    if len(text) < 4096:
        return enc.encode_ordinary(text)
    out, at = [], 0
    for m in _LONG_SPACE.finditer(text):
        end = m.end() - (m.end() < len(text))
        for p in pieces(text[at : m.start()]):
            out += enc.encode_ordinary(p)
        out += _whole(enc).encode_ordinary(text[m.start() : end])
        at = end
    for p in pieces(text[at:]):
        out += enc.encode_ordinary(p)
    return out


def encode_documents(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """Encode every text, decode the ids again to bytes, and report both.

    Returns id, n_tokens, ids_sha256 (of the decimal ids joined by one space), decoded_sha256 (of the
    decoded bytes) and, with ``with_ids``, token_ids. A null or empty text has no tokens and the digests
    of the empty string. Rows are independent: repeated rows and null ids keep one output row each, and
    other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    with open(rank_file, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary's ranks

    def make():
        enc = encoding(sent.value, pattern)
        names = [str(i) for i in range(enc.n_vocab + 1)]
        vocabulary = np.array(names, dtype=object)

        def fn(ids, texts):
            n, sha, back, tokens = [], [], [], []
            for text in texts:
                got = encode_text(text or "", enc)
                n.append(len(got))
                joined = " ".join(vocabulary[got].tolist()) if got else ""
                sha.append(hashlib.sha256(joined.encode()).hexdigest())
                back.append(hashlib.sha256(enc.decode_bytes(got)).hexdigest())
                if with_ids:
                    tokens.append(got)
            return [ids, n, sha, back] + [tokens] * with_ids

        return fn

    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_batches(docs.select(id_col, text_col), make, schema + ", token_ids array<int>" * with_ids)
