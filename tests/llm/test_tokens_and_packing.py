import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakeops.llm import packing
from lakeops.llm.bpe import TextEncoder, WordEncoder
from lakeops.llm.tokens import count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("words", [WordEncoder, packing.FastWords])
def test_encoder_agrees_with_the_library(library, words):
    rng = random.Random(1)
    signs = list("ab  \n\t'sdtlvrem12!.é\x1c\x1d\x85 　ñ漢\U0001F600́²½")
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(2000)]
    texts += ["a" * 5000, " " * 100, "x <|endoftext|> y <|endoftext|>", "ab" * 3000, "", "\n \n", "<|endoftext|>",
              "".join(rng.choices("abcdefghij", k=20_000)), "don't they'll " * 50]
    encoder = TextEncoder(words(PATH))
    for _ in range(2):  # the second time from memory
        got = encoder.encode(texts)
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [ids_of(library, t) for t in texts]


def test_text_beyond_the_block_size(library, monkeypatch):
    monkeypatch.setattr("lakeops.llm.bpe.AT_ONCE", 1000)
    text = "some words, and  more\n" * 300
    got = TextEncoder(WordEncoder(PATH)).encode([text])[0]
    assert np.frombuffer(got, "<u4").tolist() == ids_of(library, text)


def test_memory_of_words_is_bounded(library, monkeypatch):
    monkeypatch.setattr("lakeops.llm.bpe.REMEMBERED", 10)
    encoder = TextEncoder(WordEncoder(PATH))
    for i in range(20):
        encoder.encode([f"word{i} other{i} third{i}"])
    assert len(encoder.parts) < 20


def test_counts_of_awkward_rows(library, awkward, no_documents):
    rows = count_tokens(awkward, PATH, 512).collect()
    texts = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    want = [(i, len((t or "").encode()), len(ids_of(library, t)), len(ids_of(library, t)) > 512) for i, t in texts]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    assert count_tokens(no_documents, PATH, 512).collect() == []


def test_pieces_of_awkward_rows(library, awkward, no_documents):
    frame = packing.pack(awkward, PATH, group_pieces=40)
    assert frame.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = frame.collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(int)
    for r in awkward.select("doc_id", "text").collect():
        ids, start = np.array(ids_of(library, r.text) + [1], "<u4"), 0
        while start < len(ids):
            size = 2048 if len(ids) - start >= 2048 else min(512, len(ids) - start)
            want[r.doc_id, start, size, zlib.crc32(ids[start:start + size].tobytes()), len(ids)] += 1
            start += size
    assert {k: len(v) for k, v in pieces.items()} == want
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(no_documents, PATH).collect() == []


def test_differencing_is_near_equal_and_within_capacity():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 512, 1500)
    chosen = packing.balance(sizes)
    sums = np.bincount(chosen, weights=sizes)
    assert sums.max() <= 2048 and sums.max() - sums.min() < 64
    assert len(sums) <= -(-sizes.sum() // 2048) + 2
    assert packing.balance(np.array([2000, 2000, 2000])).tolist() in ([0, 1, 2], [0, 2, 1], [1, 0, 2], [1, 2, 0],
                                                                      [2, 0, 1], [2, 1, 0])
    assert packing.balance(np.array([5])).tolist() == [0]


def test_window_count_rises_when_capacity_is_exceeded():
    sizes = np.array([1500, 1500, 1000, 90])  # 4090 tokens would need two windows, but no two large ones fit
    chosen = packing.balance(sizes)
    assert np.bincount(chosen, weights=sizes).max() <= 2048 and chosen.max() == 2
