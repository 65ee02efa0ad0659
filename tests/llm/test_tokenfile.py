import random
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from seqloom.llm import tokenfile, tokens
from seqloom.plans.recovery import fresh_path

FILES = [public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")]
HARD = ["", " ", "a", " a", "a ", "a  b", "a\nb c", "a \n b", "é ü", "e ́x", "x y z", "it's I'll 'tis", "A B\tC", "<|endoftext|> x", "ΟΔΟΣ ΣΑΣ", "a  b", "1234 56,7", "﻿ a​ b", "a" * 300 + " b", "\U0001f600 \U0001f601 x"]


@pytest.mark.parametrize("path", FILES)
def test_encoder_equals_the_library(path, both):
    texts = [r.text or "" for r in both.select("text").collect()] + HARD
    plain = Tokenizer.from_file(path)
    enc = tokens.Encoder(path, limit=500)
    for _ in range(2):
        got = [np.frombuffer(x, dtype=enc.dtype).tolist() for at in range(0, len(texts), 37) for x in enc.encode(texts[at : at + 37])]
        assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("path", FILES)
def test_every_character_before_every_stop(path):
    plain = Tokenizer.from_file(path)
    enc = tokens.Encoder(path)
    chars = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) not in ("Cs", "Co", "Cn")]
    for at in range(0, len(chars), 4096):
        texts = [" ".join([f"e{c}{stop}" for stop in tokens.STOPS] + [f"{c}.", f"a{c}i,"]) for c in chars[at : at + 4096]]
        want = [e.ids for e in plain.encode_batch_fast(texts, add_special_tokens=False)]
        for c, x, ids in zip(chars[at : at + 4096], enc.encode(texts), want, strict=True):
            assert np.frombuffer(x, dtype=enc.dtype).tolist() == ids, hex(ord(c))


@pytest.mark.parametrize("path", FILES)
def test_odd_letters_in_texts(path):
    rng = random.Random(3)
    plain = Tokenizer.from_file(path)
    enc = tokens.Encoder(path, limit=2000)
    letters = "ab\u0130\u0131\u0958\u1e9e\u03a3\u0345\u0307\u1100\u1161\u11a8\u01c5\ufb01\u2126\u0e01\u0e33'" + tokens.STOPS + "\n 1"
    texts = ["gel AL\u0130, bak", "gel AL\u0130. Bak"] + ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(20000)]
    want = [e.ids for e in plain.encode_batch_fast(texts, add_special_tokens=False)]
    got = [np.frombuffer(x, dtype=enc.dtype).tolist() for at in range(0, len(texts), 500) for x in enc.encode(texts[at : at + 500])]
    assert [t for t, a, b in zip(texts, got, want, strict=True) if a != b] == []


def test_round_trip(spark, both):
    plain = Tokenizer.from_file(FILES[0])
    path = fresh_path(spark, "tokens")
    got = tokenfile.query(both, path, FILES[0]).collect()
    rows = both.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    start, ids = 0, []
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
        ids.append(r.doc_id)
    known = [i for i in ids if i is not None]
    assert known == sorted(known) and ids[: len(ids) - len(known)] == [None] * (len(ids) - len(known))
    want = sorted((str(r.doc_id), len(t := [*plain.encode(r.text or "", add_special_tokens=False).ids, 0]), zlib.crc32(np.array(t, "<u4").tobytes())) for r in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want


def test_empty(spark, empty):
    assert tokenfile.query(empty, fresh_path(spark, "tokens"), FILES[0]).collect() == []
