"""The table of chunks (op2, op9, the pipeline's last stage): its size, equal hashes, words met again."""

import tracemalloc

import numpy as np
import public_tokenizers
from graustein.llm import bpe, chunks
from tests.llm import brute


def lengths(cs):
    return [len(c).to_bytes(4, "little") for c in cs]


def test_a_chunk_takes_few_bytes():
    own = chunks.Encoded(lengths, limit=200_000)
    texts = [" ".join(f"w{k}x{i}" for i in range(500)) for k in range(100)]
    tracemalloc.start()
    try:
        for i in range(0, 100, 10):
            own.texts(texts[i:i + 10])
        held, _ = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert len(own.known) + len(own.older) == 50_000
    assert held < 60 * 50_000


def test_equal_hashes_and_long_chunks(monkeypatch):
    monkeypatch.setattr(chunks, "span_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64) % np.uint64(3))
    own = chunks.Encoded(lengths, limit=40)
    texts = ["", "a bb", "bb aa cc", f"{'x' * 5000} y", "漢字 é", " ".join(f"q{i}" for i in range(30))]
    for _ in range(3):
        got = own.texts(texts)
        want = [b"".join(lengths([c for c in [first, *(" " + p for p in rest)] if c])) for first, rest in map(chunks.cut, texts)]
        assert got == want


def test_words_that_the_table_holds_are_not_contracted_again(monkeypatch):
    own = bpe.Coder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    seen, contract = [], own.contract
    monkeypatch.setattr(own, "contract", lambda words: (seen.extend(words), contract(words))[1])
    texts = ["x zqvorp yy", "x zqvorp, zqvorp; (zqvorp zqvorpel", "zqvorp's zqvorp"]
    for t in texts:
        assert own.encoded.texts([t]) == [brute.token_bytes(t)]
    assert seen.count(b" zqvorp") == 1 and b" zqvorpel" in seen


def test_words_are_contracted_by_length_in_bounded_sets(monkeypatch):
    own = bpe.Coder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    sets, contract = [], own.contract
    monkeypatch.setattr(own, "contract", lambda words: (sets.append(words), contract(words))[1])
    monkeypatch.setattr(bpe, "ROWS_AT_ONCE", 2000)
    pick = np.random.default_rng(5)
    text = " ".join("".join(pick.choice(list("qzxvkw"), n)) for n in pick.integers(5, 60, 80))
    assert own.encoded.texts([text]) == [brute.token_bytes(text)]
    lens = [len(w) for s in sets for w in s]
    assert lens == sorted(lens) and len(sets) > 5 and max(sum(len(w) ** 2 for w in s) for s in sets) <= 2 * 2000 + 60 ** 2


def test_texts_are_decoded_in_sets(monkeypatch):
    own = bpe.Coder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    monkeypatch.setattr(bpe, "IDS_AT_ONCE", 7)
    texts = ["", "one two three", "", "é" * 40, "a", "", "b c d e f g h i j k l", ""]
    sizes, decode = [], own._decode
    monkeypatch.setattr(own, "_decode", lambda ids: (sizes.append(len(ids)), decode(ids))[1])
    assert own.decode(own.encoded.texts(texts)) == [t.encode() for t in texts]
    assert sum(sizes) == len(texts) and len(sizes) == 3
    assert own.decode([]) == []
