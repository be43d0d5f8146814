from __future__ import annotations

import base64
import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from netpulse.llm import bpe
from netpulse.llm.queries import VOCABULARY, op7_bpe

from .conftest import SMALL

PATH = public_tokenizers.path(VOCABULARY)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def packed(ids) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def test_query_against_tiktoken(spark, tables, reference):
    found = {r.doc_id: r for r in op7_bpe(spark, SMALL).collect()}
    for d in tables("documents").collect():
        ids = reference.encode_ordinary(d.text or "")
        r = found[d.doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(packed(ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


@pytest.mark.parametrize("alphabet", ["ab", "aab", "aeiouthns", "abcdeéà中文字ñ  \n123!?thein", "=", "-_", "0123456789", "中文字", "the in"])
def test_any_text(reference, alphabet):
    rng = random.Random(alphabet)
    pattern, words = bpe._compiled(public_tokenizers.PATTERN), bpe.vocabulary(PATH)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, n))) for n in (5, 30, 200, 300, 3000) for _ in range(12)]
    texts += [t.replace(" ", "") for t in texts]
    found = words.encode(texts, pattern)
    assert found == [packed(reference.encode_ordinary(t)) for t in texts]
    assert [words.decode(f) for f in found] == [t.encode() for t in texts]


def test_small_limits_change_nothing(reference, tables, monkeypatch):
    for name, value in (("CELLS", 64), ("CHUNK", 500), ("SLICE", 7), ("REMEMBERED", 20), ("WIDEST", 4)):
        monkeypatch.setattr(bpe, name, value)
    texts = [r.text for r in tables("documents").limit(30).collect()]
    found = bpe.Vocabulary(PATH).encode(texts, bpe._compiled(public_tokenizers.PATTERN))
    assert found == [packed(reference.encode_ordinary(t)) for t in texts]


def test_odd_rows(odd, reference):
    apart = bpe.decoded(bpe.encoded(odd, PATH, public_tokenizers.PATTERN), PATH)
    for both in (apart, bpe.encoded_and_decoded(odd, PATH, public_tokenizers.PATTERN)):
        assert sorted(both.columns) == sorted([*odd.columns, "decoded"])
        for r in both.collect():
            assert bytes(r.ids) == packed(reference.encode_ordinary(r.text or ""))
            assert bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encoded(odd.limit(0), PATH, public_tokenizers.PATTERN).collect() == []
