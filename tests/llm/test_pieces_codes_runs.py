"""SentencePiece, vector codes and periodic runs against the library, brute force and awkward tables."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from graustein.llm import periodic_runs, piece_bpe, registry, vector_codes
from graustein.llm.base import stored
from tests.llm.test_llm import SMALL, awkward, documents, none  # noqa: F401

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------------ SentencePiece

def test_pieces_query_matches_the_library(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in registry.QUERIES["op11_sentencepiece"](spark, SMALL).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in documents(spark).select("doc_id", "text").collect()}
    ids = {i: LIBRARY.encode(t, num_threads=1) for i, t in texts.items()}
    assert got == {i: (len(x), sha(",".join(map(str, x))), sha(LIBRARY.decode(x))) for i, x in ids.items()}


def test_pieces_of_odd_texts(spark):
    pick = random.Random(11)
    texts = ["", " ", "  two  spaces ", "a▁b ▁▁c", "\x00\t\n x", "ﬁ ½ é é", "漢字<s></s><unk><0x0A>", " " * 4000 + "x" + " " * 37, "ab" * 4000,
             "".join(pick.choice("abcdefghij") for _ in range(20_000)), "\U0001f600é​ \xa0 x"]
    texts += ["".join(pick.choice(" ▁ab ehtsinro\n😀漢.1") for _ in range(pick.randint(0, 60))) for _ in range(3000)]
    texts += [" " * pick.randint(0, 40) + pick.choice(["the", "  x", ""]) + " " * pick.randint(0, 40) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    coded = piece_bpe.encode_decode(rows, MODEL)
    for r in coded.collect():
        ids = LIBRARY.encode(texts[r["id"]], num_threads=1)
        assert r["ids"] == ids and r["decoded"] == LIBRARY.decode(ids), texts[r["id"]][:80]


def test_pieces_of_awkward_rows(spark, awkward, none):  # noqa: F811
    rows = awkward.select("doc_id", "text").collect()
    want = sorted((repr(r["doc_id"]), tuple(LIBRARY.encode(r["text"] or "")), LIBRARY.decode(LIBRARY.encode(r["text"] or ""))) for r in rows)
    assert sorted((repr(r["id"]), tuple(r["ids"]), r["decoded"]) for r in piece_bpe.encode_decode(awkward, MODEL).collect()) == want
    assert piece_bpe.encode_decode(none, MODEL).collect() == []


def test_any_ids_decode_as_the_library_does(spark):
    pick = random.Random(3)
    lists = [[pick.randrange(32_000) if pick.random() < 0.5 else pick.randrange(259) for _ in range(pick.randint(0, 20))] for _ in range(300)] + [None, []]
    rows = spark.createDataFrame(list(enumerate(lists)), "id long, ids array<int>")
    for r in piece_bpe.decode(rows, MODEL).collect():
        assert r["text"] == LIBRARY.decode(lists[r["id"]] or [])


def test_merging_everywhere_is_merging_one_by_one():
    own, pick = piece_bpe.pieces(MODEL), random.Random(7)
    for _ in range(300):
        text = " " + "".join(pick.choice("abcdehinorst") for _ in range(pick.randint(1, 40)))
        symbols = own.symbol[[ord(c) if c != " " else ord(piece_bpe.SPACE) for c in text]]
        assert own.contract(symbols.copy(), np.zeros(len(symbols), np.int64))[0].tolist() == own.one_by_one(symbols.tolist())


# ------------------------------------------------------------------ vector codes

def brute_codes(rows, parts=16, entries=64, rounds=2):
    """{id: (code, error, label_error)} and the codebooks' digest, every part against every entry."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    width = len(first[0][1]) // parts
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    nearest = lambda q, book: min((sum((a - b) ** 2 for a, b in zip(q, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            of = {}
            for _, v, _ in kept:
                of.setdefault(nearest(cut(v, p), books[p])[1], []).append(cut(v, p))
            for k, vs in of.items():
                books[p][k] = [sum(x) // len(vs) for x in zip(*vs)]
    coded = []
    for i, v, lab in kept:
        best = [nearest(cut(v, p), books[p]) for p in range(parts)]
        coded.append((i, lab, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)))
    total = {}
    for _, lab, _, e in coded:
        total[lab] = total.get(lab, 0) + e
    return sorted(((i, c, e, total[lab]) for i, lab, c, e in coded), key=repr), sha(",".join(str(x) for b in books for e in b for x in e))


def coded_rows(df):
    coded, books = vector_codes.compressed(df)
    return sorted(((r["id"], r["code"].hex(), r["error"], r["label_error"]) for r in coded.collect()), key=repr), books.digest()


def test_codes_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").limit(150).collect()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    assert coded_rows(df) == brute_codes(rows)


def test_codes_of_awkward_rows(spark):
    pick = random.Random(2)
    rows = [(i // 2, [pick.choice([-0.5, 0.0, 0.25, 1.0, -1e-9]) for _ in range(32)], pick.choice([None, 1, 2])) for i in range(120)]
    rows += [(None, [0.1] * 32, None), (None, [0.1] * 32, None), (0, rows[0][1], 1), (0, rows[0][1], 1)]  # repeated rows, ties everywhere
    bad = [(500, None, 1), (501, [None] * 32, 1), (502, [float("nan")] * 32, 1), (503, [float("inf")] + [0.0] * 31, None)]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows + bad], "vec_id long, embedding array<double>, label int, code string, id int").repartition(3)
    assert coded_rows(df) == brute_codes(rows)
    coded, books = vector_codes.compressed(df.filter("vec_id >= 500"))
    assert coded.collect() == [] and books.digest() == sha("")


def test_codes_with_few_rows_and_other_lengths(spark):
    rows = [(3, [1.0] * 16, 7), (1, [0.0] * 16, 7), (2, [5.0] * 8, 8), (4, [], 8)]
    coded, books = vector_codes.compressed(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    got = {r["id"]: (r["code"] and r["code"].hex(), r["error"], r["label_error"]) for r in coded.collect()}
    assert got == {1: ("00" * 16, 0, 0), 3: ("01" * 16, 0, 0), 2: (None, None, None), 4: (None, None, None)}
    assert len(books.entries) == 2
    with pytest.raises(Exception, match="scaled components"):
        vector_codes.compressed(spark.createDataFrame([(1, [1e300] * 16, 1)], "vec_id long, embedding array<double>, label int"))[0].collect()


def test_orchard_finds_the_nearest_of_the_lowest_index():
    pick = np.random.default_rng(5)
    for size, spread in ((1, 5), (7, 2), (64, 3), (64, 1000)):
        book, queries = pick.integers(-spread, spread, (size, 4)), pick.integers(-spread, spread, (2000, 4))
        books = vector_codes.Codebooks(np.tile(book, (1, 1)), 1)
        at, d = vector_codes.orchard(queries, book, books.lists[0], books.apart[0])
        every = ((queries[:, None, :] - book[None]) ** 2).sum(axis=2)
        assert (at == every.argmin(axis=1)).all() and (d == every.min(axis=1)).all()


# ------------------------------------------------------------------ periodic runs

def brute_runs(w):
    """Every maximal stretch for every period; of one stretch the smallest period."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(i + 1, j)
    runs = sorted((s, n, q) for (s, n), q in found.items())
    dropped = {k for s, n, q in runs for k in range(s + q, s + n)}
    return runs, " ".join(x for k, x in enumerate(w) if k not in dropped)


def words_of(text):
    return [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]


def test_runs_against_brute_force(spark):
    pick, texts = random.Random(13), []
    for _ in range(1500):
        letters, w = pick.choice(["a", "ab", "abc", "abcdefgh"]), []
        while len(w) < 70 and pick.random() < 0.9:
            r = [pick.choice(letters) for _ in range(pick.randint(1, 8))]
            w += (r * pick.randint(1, 9))[:pick.randint(1, 50)]
        texts.append(" ".join(w))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    some = 0
    for r in periodic_runs.collapsed(rows).collect():
        runs, kept = brute_runs(texts[r["id"]].split())
        assert [tuple(x) for x in r["runs"]] == runs and r["collapsed"] == kept
        some += bool(runs)
    assert some > 300


def test_runs_of_long_texts(spark):
    texts = {1: "x " * 300_000, 2: " ".join(str(i % 777) for i in range(300_000)), 3: " ".join(str(i) for i in range(100_000))}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["id"]: [tuple(x) for x in r["runs"]] for r in periodic_runs.collapsed(rows).collect()}
    assert got == {1: [(0, 300_000, 1)], 2: [(0, 300_000, 777)], 3: []}


def test_runs_of_awkward_rows(spark, awkward, none):  # noqa: F811
    rows = awkward.select("doc_id", "text").collect()
    want = sorted((repr(r["doc_id"]), *map(str, brute_runs(words_of(r["text"]))))
                  for r in rows if len(r["text"] or "") < 100_000)
    got = periodic_runs.collapsed(awkward).collect()
    assert sorted((repr(r["id"]), str([tuple(x) for x in r["runs"]]), r["collapsed"]) for r in got if r["n_words"] < 10_000) == want
    long = [r for r in got if r["n_words"] > 10_000]
    assert len(long) == 2 and all([tuple(x) for x in r["runs"]] == [(0, 27_000, 9)] for r in long)
    assert periodic_runs.collapsed(none).collect() == []
    assert periodic_runs.with_planted_runs(none).columns == none.columns


def test_runs_query_against_brute_force(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in registry.QUERIES["op13_periodic_runs"](spark, SMALL).collect()}
    texts = {r["doc_id"]: r["text"] for r in documents(spark).select("doc_id", "text").collect()}
    planted = 0
    for i, text in texts.items():
        w = words_of(text)
        h, n = zlib.crc32(str(i).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (k - a) % p] for k in range(a, n)]
            planted += 1
        if n > 3000:
            continue  # the brute force is quadratic; the oracle SQL covers these
        runs, kept = brute_runs(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        want = (len(runs), *(best if best else (None,) * 3), 1000 * best[1] // best[2] if best else None,
                sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(kept))
        assert got[i] == want
    assert planted > 5


def test_the_greatest_run(spark):
    row = spark.range(1).select(F.expr("array(named_struct('start', 9L, 'length', 6L, 'period', 1L), named_struct('start', 2L, 'length', 6L, 'period', 1L),"
                                       "named_struct('start', 0L, 'length', 5L, 'period', 1L))").alias("r"))
    assert row.select(periodic_runs.greatest(F.col("r")).alias("b")).select("b.start").first()[0] == 2
    assert stored(row, "greatest").select(periodic_runs.greatest(F.slice("r", 1, 0)).alias("b")).first()[0] is None
