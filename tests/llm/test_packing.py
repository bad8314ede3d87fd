"""Packing: an exact round trip, the limits, little padding."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import documents
from tokenizers import Tokenizer

from encore.llm import packing, queries


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.tokenizer_path())


def check(rows, texts, tokenizer, length=4096, segments=4096, loss=None):
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append(r)
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    assert set(pieces) == set(texts)
    for i, found in pieces.items():
        at = 0
        for start, n in sorted(found):
            assert start == at
            at += n
        assert at == len(ids[i])
    padding = 0
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length and len(found) <= segments
        padding += 0 if at & (at - 1) == 0 and len(found) < segments else length - at
        if loss:
            assert sum(r.length for r in found if r.bears_loss) <= loss
    return padding, sum(map(len, ids.values()))


def test_query(spark, sf, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    padding, tokens = check(queries.QUERIES["op6_packing"](spark, sf).collect(), texts, tokenizer)
    assert padding <= 0.01 * tokens


def test_cases(spark, tokenizer):
    texts = [None, "", "a", "a", "Ünï çödé ÇA ŒUVRE İstanbul ΣΑΣ", "0 10 2024 00", "it's we'll don't", "<|endoftext|> x", "x </s> <s> <|endoftext|>", "a<|startoftext|>B<|endoftext|><|ENDOFTEXT|> <|endof text|>Σ", "漢字 テスト", "é a b c\x0bd",
             "word" * 30_000, "the quick brown. " * 5_000, "...!!! ###a# 'tis", "x" * 7 + "\t\r\n y"]
    df = documents(spark, texts, "length sequence_id bears_loss")
    padding, _ = check(packing.pack(df).collect(), dict(enumerate(texts)), tokenizer)
    assert padding == 0
    assert packing.pack(df.limit(0)).count() == 0


def test_short_documents_leave_little_padding(spark, tokenizer):
    """Pieces of a few tokens fill sequences, however many of them that takes; a limit on pieces counts as padding."""
    texts = {i: f"the cat {i % 7} sat" for i in range(20_000)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    padding, tokens = check(packing.pack(df).collect(), texts, tokenizer)
    assert padding <= 0.01 * tokens
    padding, _ = check(packing.pack(df, segments=128).collect(), texts, tokenizer, segments=128)
    assert padding > 0.01 * tokens


def test_limits_hold_together(spark, sf, tokenizer):
    turns = spark.read.parquet(f"{sf}/conversations.parquet").selectExpr("conv_id * 1000 + turn AS row", "text", "role = 'assistant' AS l").dropDuplicates(["row"])
    texts = {r.row: r.text for r in turns.collect()}
    rows = packing.pack(turns, "row", loss="l", length=512, segments=6, loss_tokens=200, window=32).collect()
    check(rows, texts, tokenizer, 512, 6, 200)


def test_the_direct_way_is_the_tokenizers(spark, sf, tokenizer):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    encoder = packing.Encoder(packing.tokenizer_path())
    assert encoder.direct
    for t, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_a_text_is_one_pass_over_chunks_that_are_made_once(spark, sf, tokenizer, monkeypatch):
    """What is remembered is bounded after each text, and forgetting changes no ids."""
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(40).collect()] + [None, "", "a<|endoftext|>B a a"]
    encoder = packing.Encoder(packing.tokenizer_path())
    made = []
    chunk = encoder.known.make
    encoder.known.make = lambda c: made.append(c) or chunk(c)
    first = list(encoder.encode(texts))
    assert len(made) == len(set(made)) == len(encoder.known) - 1
    most = max(len(set((t or "").split())) for t in texts)
    monkeypatch.setattr(packing, "CACHED", 10)
    for t, ids, again in zip(texts, first, encoder.encode(texts), strict=True):
        assert ids == again == np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()
        assert len(encoder.known) + len(encoder.words) <= 4 * most + 12
