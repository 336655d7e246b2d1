"""The training-data operators against brute force, and on awkward tables."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from graustein.llm import bpe, chat_format, decontaminate, exact_dedup, licenses, near_dedup, pii, registry, suffix_dedup, token_planes, toxicity
from graustein.llm.base import keep_rows, scratch, stored, text_hash
from graustein.llm.chunks import cut
from graustein.llm.components import components
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
#: nulls, empty and blank texts, a long one, repeated rows, equal ids, columns whose names the operators use themselves
CLASHES = "doc_id long, text string, id string, uid long, th long, n int, cls string, label string, _text_hash string, digest string"
LONG = "Tall trees shade the old mill by the river, " * 3000
WORDS = "the quick brown fox jumps over the lazy dog while seven wizards brew a bitter potion near the quiet harbour at dawn"
ROWS = [
    (1, None), (2, ""), (3, "  \t\n"), (4, LONG), (5, LONG), (6, "one two"), (6, "one two"), (6, "other words here"), (None, "one two"),
    (None, None), (7, WORDS), (8, WORDS + " indeed"), (9, "write to a.b@mail.example.com or +1 (988) 555-2485, not 300.1.1.1"),
    (10, "x" * 5000), (11, "漢字 é́ <|endoftext|> \x00 's"), (12, WORDS.upper()),
]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, t, "a", 1, 2, 3, "c", "l", "h", "d") for i, t in ROWS]
    return stored(spark.createDataFrame(rows, CLASHES).repartition(3), "awkward")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], CLASHES)


def key(row):
    return tuple((x is None, "" if x is None else x) for x in row)


def collected(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=key)


def documents(spark, sf_dir=SMALL):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_every_operator_is_registered_once():
    assert sorted(int(q[2:].split("_")[0]) for q in registry.QUERIES) == list(range(1, 14))


# ------------------------------------------------------------------ exact dedup

def test_exact_groups(awkward, none):
    got = collected(exact_dedup.groups(awkward, bits=1 << 15), "id", "keep_id", "group_size", "kept")
    by_text = {}
    for i, t in ROWS:
        by_text.setdefault(t or "", []).append(i)
    biggest = {t: max((i for i in ids if i is not None), default=None) for t, ids in by_text.items()}
    assert [(g[0], g[1], g[2]) for g in got] == sorted(((i, biggest[t or ""], len(by_text[t or ""])) for i, t in ROWS), key=key)
    assert sum(g[3] for g in got) == len(by_text)  # exactly one row of each text, repeated rows too
    assert exact_dedup.groups(none).count() == 0


def test_exact_full_filter_is_still_right(spark):
    """A filter with far too few bits only makes more rows shuffle."""
    docs = documents(spark)
    assert collected(exact_dedup.groups(docs, bits=1 << 12), "id", "keep_id", "group_size") == collected(
        exact_dedup.groups(docs), "id", "keep_id", "group_size")


def test_exact_keep_one_keeps_columns(awkward, none):
    out = exact_dedup.keep_one(awkward)
    assert out.columns == awkward.columns
    assert sorted(t or "" for t, in out.select("text").collect()) == sorted({t or "" for _, t in ROWS})
    assert exact_dedup.keep_one(none).count() == 0


# ------------------------------------------------------------------- near dedup

def test_near_groups_awkward(awkward, none):
    got = collected(near_dedup.near_groups(awkward, 85), "id", "n_shingles", "component_id")
    parts = brute.near_components([t for _, t in ROWS], 85)
    least = {p: min((ROWS[k][0] for k in range(len(ROWS)) if parts[k] == p and ROWS[k][0] is not None), default=None) for p in parts}
    want = sorted(((i, len(brute.shingle_set(t)), least[parts[k]] if brute.shingle_set(t) else i) for k, (i, t) in enumerate(ROWS)), key=key)
    assert got == want
    kept = near_dedup.keep_one(awkward, 85)
    assert kept.columns == awkward.columns
    assert kept.count() == len({(parts[k] if brute.shingle_set(t) else -k - 1) for k, (_, t) in enumerate(ROWS)})
    assert near_dedup.near_groups(none).count() == 0


@pytest.mark.parametrize("percent", [80, 85])
def test_near_variants(spark, percent):
    """Variants of one text at similarities around the limit, small sets, chains of links."""
    random.seed(percent)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for n in range(120):
        words = list(base)
        for _ in range(random.choice([0, 1, 1, 2, 3])):
            words[random.randrange(60)] = f"x{random.randrange(10**6)}"
        texts.append(" ".join(words[:random.choice([60, 60, 55, 7, 3])]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = collected(near_dedup.near_groups(df, percent), "id", "component_id")
    assert got == list(enumerate(brute.near_components(texts, percent)))


def set_components(sets: list[set], percent: int) -> list[int]:
    """The least number that can be reached from every set, by comparing all of them."""
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if label[i] != label[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                lo, hi = sorted((label[i], label[j]))
                label = [lo if x == hi else x for x in label]
    return label


@pytest.mark.parametrize("percent, small", [(85, 16), (85, 2), (80, 3)])
def test_links_of_sets_that_lack_parts_of_one(spark, monkeypatch, percent, small):
    """Sets made of one by leaving out shingles (families leave out much the same ones) and putting in
    some: nearly all shingles are shared by all, so links show in the deviations alone."""
    monkeypatch.setattr(near_dedup, "SMALL", small)
    random.seed(percent + small)
    base, sets = list(range(200)), []
    for family in range(30):
        out = random.sample(base, random.choice([4, 20, 30, 45]))
        for n in range(random.choice([1, 4, 12])):
            gone = set(random.sample(out, len(out) - random.choice([0, 1, 3]))) | set(random.sample(base, random.choice([0, 2, 8, 14])))
            sets.append(set(base) - gone | {1000 + random.randrange(40) for _ in range(random.choice([0, 0, 1, 3]))}
                        | {10**6 + 100 * len(sets) + i for i in range(random.choice([0, 3, 9]))})
    df = spark.createDataFrame([(i, len(x), sorted(x)) for i, x in enumerate(sets)], "uid long, n long, h array<long>").repartition(4)
    labels = near_dedup._links(near_dedup.rare_shingles(df, percent), df, percent)
    got = list(range(len(sets)))
    for node, label in labels.collect():
        got[node] = label
    want = set_components(sets, percent)
    assert got == want and 1 < len(set(want)) < len(sets)


@pytest.mark.parametrize("changed, per_member", [(23, 2), (40, 1)])
def test_variants_below_the_limit_list_no_pairs(spark, changed, per_member):
    """2,000 variants that each changed places of their own (similarity about 0.79 and 0.67): candidates
    stay in proportion to the group, though nearly all of them share nearly all shingles."""
    random.seed(changed)
    base, members = list(range(400)), 2000
    sets = [set(base) - set(random.sample(base, changed)) | {1000 * (i + 1) + j for j in range(changed)} for i in range(members)]
    df = spark.createDataFrame([(i, len(x), sorted(x)) for i, x in enumerate(sets)] + [(members, 400, base)], "uid long, n long, h array<long>").repartition(8)
    each = df.filter(F.col("uid") != members).select(F.lit(members).cast("long").alias("center"), "uid", "n", F.col("uid").alias("label"))
    deviations = near_dedup._deviations(each, df, 85)
    assert deviations.filter("not far").count() == (members if changed <= 32 else 0)
    assert near_dedup._deviating_pairs(deviations, 85).count() <= per_member * members


def test_near_keep_one_keeps_rows_without_words(spark):
    rows = [(None, None, "a"), (None, None, "b"), (1, "", "c"), (1, "", "d"), (1, " ", "e"), (2, WORDS, "f"), (2, WORDS, "g"), (3, WORDS, "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, more string")
    left = collected(near_dedup.keep_one(docs, 80), "doc_id", "text", "more")
    assert sorted(r[2] for r in left if r[0] != 2) == ["a", "b", "c", "d", "e"] and len([r for r in left if r[0] == 2]) == 1


def test_keep_rows_counts_the_kept(spark):
    docs = spark.createDataFrame([(1, "x", i) for i in range(4)] + [(2, "y", 4), (2, "y", 5), (3, "z", 6)], "doc_id long, text string, _text_hash int")
    kept = {(1, "x"): [True, True, False, True], (2, "y"): [False, True], (3, "z"): [False]}
    decided = spark.createDataFrame([(i, t, k) for (i, t), ks in kept.items() for k in ks], "id long, text string, kept boolean")
    decided = decided.select("id", text_hash(F.col("text")).alias("th"), "kept")
    left = collected(keep_rows(docs, decided, "doc_id", "text"), "doc_id")
    assert left == [(1,), (1,), (1,), (2,)]
    assert keep_rows(docs, decided, "doc_id", "text").columns == docs.columns


def test_sketches_agree_with_similarity():
    """Every coordinate fills, also for one shingle, and equal coordinates estimate the similarity."""
    random.seed(5)
    ids = np.array(random.sample(range(1 << 62), 700), np.uint64)
    pair = [np.sort(ids[:500]), np.sort(ids[100:600]), ids[:1]]
    doc = np.repeat(np.arange(3), [len(p) for p in pair])
    got = near_dedup.sketch(doc, np.concatenate(pair), np.array([500, 500, 1]))
    assert (got != np.uint64(2**64 - 1)).all()
    assert abs((got[0] == got[1]).mean() - 400 / 600) < 0.15


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 9), (5, 5), (20, 3), (30, 31), (31, 32), (32, 33)], "a long, b long")
    got = dict(map(tuple, components(links).collect()))
    assert {k: v for k, v in got.items() if k != 5} == {1: 1, 2: 1, 3: 1, 20: 1, 8: 8, 9: 8, 30: 30, 31: 30, 32: 30, 33: 30}
    assert components(links.limit(0)).count() == 0


# ------------------------------------------------------------- repeated strings

@pytest.mark.parametrize("group", [4, suffix_dedup.GROUP])
def test_repeats(spark, group):
    random.seed(group)
    shared = "".join(random.choices("abcd ef\n", k=1500))
    texts = []
    for _ in range(50):
        t = "".join(random.choices("abcdefgh ", k=random.randint(0, 400)))
        for _ in range(random.randint(0, 3)):
            a = random.randint(0, 1300)
            t += shared[a:a + random.randint(100, 400)] + "".join(random.choices("xyz", k=random.randint(0, 50)))
        texts.append(t)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = collected(suffix_dedup.repeats_removed(df, group=group), "id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == [(i, *r) for i, r in enumerate(brute.repeats(texts))]


def test_repeats_awkward(awkward, none):
    got = collected(suffix_dedup.repeats_removed(awkward), "id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(((i, *r) for (i, _), r in zip(ROWS, brute.repeats([t for _, t in ROWS]))), key=key)
    assert suffix_dedup.repeats_removed(none).count() == 0


def test_long_texts_are_cut_into_overlapping_blocks(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 300)
    text = "".join(random.choices("abc", k=2000))
    seen = []
    for rows, shift, data, offsets in suffix_dedup.blocks(pa.array([text])):
        _, at, lo, hi, _ = suffix_dedup.anchors(data, offsets)
        assert ((lo <= at) & (at + suffix_dedup.GRAM <= hi + suffix_dedup.LENGTH)).all()
        seen += [w for a, b in zip(lo + shift[0], hi + shift[0]) for w in range(a, b + 1)]
    assert sorted(seen) == list(range(2000 - suffix_dedup.LENGTH + 1))


# ------------------------------------------------------------------------ tokens

PATH, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


def test_bpe(awkward, none, spark):
    for docs, rows in ((awkward, ROWS), (documents(spark), [tuple(r) for r in documents(spark).select("doc_id", "text").collect()])):
        got = collected(bpe.encode_decode(docs, PATH, public_tokenizers.PATTERN), "id", "ids", "decoded")
        assert [(i, bytes(a), bytes(b)) for i, a, b in got] == sorted(((i, brute.token_bytes(t), (t or "").encode()) for i, t in rows), key=key)
    assert bpe.encode_decode(none, PATH, public_tokenizers.PATTERN).count() == 0


def test_bpe_odd_spaces_and_long_words():
    random.seed(3)
    bits = ["a", "the", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "'s", "'ll", "é", "漢字", "23", "!", "...", "😀", "　", "ab" * 200]
    texts = ["".join(random.choices(bits, k=random.randint(0, 40))) for _ in range(500)] + ["", " ", " a", "a ", " " * 300]
    own = bpe.coder(PATH, public_tokenizers.PATTERN)
    assert own.encoded.texts(texts) == [brute.token_bytes(t) for t in texts]
    assert token_planes.encoder(JSON).texts(texts) == [brute.token_bytes(t) for t in texts]
    assert all("".join([a, *(" " + x for x in b)]) == t for t in texts for a, b in [cut(t)])
    words = [bytes(random.choices(b"abcdethingr ", k=random.randint(1, 200))) for _ in range(100)]
    assert own.contract(words) == [own.contract_long(w) for w in words]


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    for n in (0, 1, token_planes.BLOCK, 10_000):
        ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
        assert (token_planes.from_planes(token_planes.to_planes(ids, kind), n, kind) == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_token_files(spark, awkward, none, kind):
    out = scratch(spark, "token_test")
    token_planes.write(awkward, out, JSON, kind)
    got = token_planes.read(spark, out).orderBy("start").collect()
    assert sorted(((r["id"], bytes(r["ids"])) for r in got), key=key) == sorted(((i, brute.token_bytes(t) + bytes(4)) for i, t in ROWS), key=key)
    assert [r["id"] for r in got] == sorted((i for i, _ in ROWS), key=lambda i: (i is not None, i or 0))
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
    empty = scratch(spark, "token_test")
    token_planes.write(none, empty, JSON)
    assert token_planes.read(spark, empty).count() == 0


def test_op2_digest(spark):
    got = {r.doc_id: r for r in registry.op2_token_planes(spark, SMALL).collect()}
    start = 0
    for i, t in sorted(map(tuple, documents(spark).select("doc_id", "text").collect())):
        n = len(brute.token_bytes(t)) // 4 + 1
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, n, brute.crc(t))
        start += n


# ----------------------------------------------------------------- personal data

def test_pii_base_spans(spark, awkward, none):
    random.seed(1)
    bits = ["a.b@c.de", "_x@y", "@", ".", "1.2.3.4", "256.1.1.1", "+1 (988) 555-2485", "+", "4111 1111 1111 1111", "4", "-", " ", "é", "a", "99",
            "mail ", "(at)", "[dot]", "DE89 3704 0044 0532 0130 00", "(988) 555-2485", "123-45-6789", "\n", "x1"]
    rows = [*ROWS, *((100 + i, "".join(random.choices(bits, k=random.randint(0, 30)))) for i in range(400)),
            (900, "1.2.3.4 " * 600), (901, "7" * 3000), (902, "+1" + "(" * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = pii.spans(df).collect()
    texts = [(r["id"], [(s["start"], s["kind"], s["end"]) for s in r["base"]]) for r in got]
    assert sorted(texts, key=key) == sorted(((i, brute.personal(t)) for i, t in rows), key=key)
    assert all(set(r["base"]) <= set(r["all"]) for r in got)
    more = [s for r in got for s in r["all"] if s["kind"] >= len(pii.BASE)]
    assert more
    assert pii.spans(none).count() == 0
    assert pii.spans(awkward.filter("doc_id = 6")).select("all").first()["all"] == []


def test_pii_em_finds_the_reliable_labelers(spark):
    """Votes drawn from known reliabilities: the posteriors rank the patterns as they should."""
    random.seed(2)
    rates = [(0.9, 0.1), (0.85, 0.2), (0.8, 0.3), (0.7, 0.4), (0.5, 0.5), (0.6, 0.4)]
    rows = []
    for _ in range(4000):
        y = random.random() < 0.5
        rows.append((0, [int(random.random() < (a if y else b)) for a, b in rates], 1, 1, y))
    df = spark.createDataFrame(rows, "kind int, votes array<int>, size int, many int, y boolean")
    counted = df.groupBy("kind", "votes", "size", "many").agg(F.count(F.lit(1)).cast("double").alias("n"))
    p = pii.posteriors(counted).select("votes", "p")
    right = df.join(p, "votes").agg(F.avg(((F.col("p") > 0.5) == F.col("y")).cast("double"))).first()[0]
    assert right > 0.88


# ---------------------------------------------------------------------- toxicity

def test_toxicity_held_out(spark):
    docs, labels = documents(spark, "/root/testdata/sf0.01"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.train(docs, labels.filter("doc_id % 2 = 0"))
    held = toxicity.scored(docs, model).join(labels.filter("doc_id % 2 = 1"), F.col("id") == F.col("doc_id"))
    rates = held.groupBy("toxic").agg(F.avg(F.col("rejected").cast("double")).alias("r")).collect()
    rates = {r["toxic"]: r["r"] for r in rates}
    assert rates[0] <= 0.02 and rates[1] >= 0.5  # part of the labels is noise: such texts hold no toxic word
    known, weights, theta = model
    for r in toxicity.scored(docs, model).join(docs, F.col("id") == docs["doc_id"]).limit(50).collect():
        count = {}
        for _, _, _, h in toxicity.words(__import__("pyarrow").array([r["text"]])):
            for w in h[np.isin(h, known)]:
                count[int(w)] = count.get(int(w), 0) + 1
        score = sum(weights[np.searchsorted(known, w)] * np.log1p(c) for w, c in count.items())
        assert abs(r["severity"] - sum(1 / (1 + np.exp(t - score)) for t in theta)) < 1e-6


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 4, 3000).astype(float)
    grade = np.clip(np.round(x / 1.5 + rng.normal(0, 0.3, 3000)), 0, 2).astype(int)
    w, theta = toxicity.fit(grade, np.arange(3000), np.zeros(3000, int), x, 1)
    assert w[0] > 1 and theta[0] < theta[1]


def test_toxicity_awkward(spark, awkward, none):
    labels = spark.createDataFrame([(4, 0, 1), (4, 1, 0), (7, 1, 0), (99, 1, 1), (None, 1, 1), (8, 1, None)], "doc_id long, quality int, toxic int")
    for docs, n in ((awkward, len(ROWS)), (none, 0)):
        for given in (labels, labels.limit(0)):
            model = toxicity.train(docs, given)
            assert toxicity.scored(docs, model).count() == n
            kept = toxicity.kept(docs, model)
            assert kept.schema == docs.schema
            if given is not labels:
                assert kept.count() == n


def test_toxicity_few_labels(spark):
    """Twelve labels of either class, or four toxic ones, tell a word that all toxic texts hold."""
    rng = random.Random(3)
    plain = lambda: " ".join(rng.choice(WORDS.split()) for _ in range(8))
    rows = [(i, f"{plain()} {'vile' if i % 2 else 'kind'} {plain()}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for ids in (range(24), [1, 3, 5, 7, *range(0, 24, 2)]):
        labels = spark.createDataFrame([(i, 0, i % 2) for i in ids], "doc_id long, quality int, toxic int")
        got = toxicity.scored(docs, toxicity.train(docs, labels)).collect()
        assert sum(r["rejected"] for r in got if r["id"] % 2) >= 28
        assert sum(r["rejected"] for r in got if r["id"] % 2 == 0) <= 2


# --------------------------------------------------------------- decontamination

def test_decontamination(spark, none):
    a = "A train leaves Zurich at 45 km per hour and the driver Anna buys 12 apples for 30 dollars at the market."
    b = "Yes! a train leaves Geneva at 70 km per hour and the driver Bob Lee buys 9 apples for 8 dollars at the market. ok"
    mixed = "a train leaves Geneva at 45 km. The driver Anna buys 12 apples at the market, and then she sleeps until noon"
    rows = [(1, b, "x"), (2, mixed, "y"), (None, a, "z"), (4, None, ""), (5, "nothing to see here at all my friend of old times", ""),
            (6, "short tiny thing", ""), (6, "short tiny thing", ""), (7, a.upper(), "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item string")
    items = spark.createDataFrame([(10, a), (11, a), (12, None), (13, "short tiny thing"), (14, "12 13")], "item_id long, text string")
    got = collected(decontaminate.marked(docs, items), "id", "contaminated", "items", "reparameterised")
    assert got == sorted([(1, True, [10, 11], True), (2, False, [], False), (None, True, [10, 11], False), (4, False, [], False), (5, False, [], False),
                          (6, True, [13], False), (6, True, [13], False), (7, True, [10, 11], False)], key=key)
    assert collected(decontaminate.clean(docs, items), "doc_id") == [(2,), (4,), (5,)]
    assert decontaminate.clean(docs, items.limit(0)).count() == len(rows)
    assert decontaminate.marked(none, items).count() == 0


def test_decontamination_slots_must_be_consistent(spark):
    item = "take 5 apples then give 5 apples back and add 7 pears to what the 5 friends have left over in total"
    good, bad = item.replace("5", "8").replace("7", "3"), item.replace("5", "8", 1).replace("5", "6", 1).replace("5", "4", 1)
    docs = spark.createDataFrame([(1, good), (2, bad)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert collected(decontaminate.marked(docs, items), "id", "contaminated") == [(1, True), (2, False)]


def test_decontamination_finds_whole_passages(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet")
    plain = lambda t: " " + " ".join(__import__("re").findall(r"\w+", t.lower())) + " "
    asked = {r["item_id"]: plain(r["text"]) for r in items.collect()}
    want = {r["doc_id"]: {i for i, t in asked.items() if t in plain(r["text"])} for r in docs.collect()}
    got = {r["id"]: set(r["items"]) for r in decontaminate.marked(docs, items).collect()}
    assert all(want[i] <= got[i] for i in want) and not any(got[i] and not want[i] for i in want)


def test_decontamination_finds_items_dense_in_values(spark):
    sums, listed = "Evaluate 3, 5, 7, 9, 11, 13 and 15", "Evaluate the sum of these many numbers now: " + ", ".join(str(i * i) for i in range(40))
    names = "Who met Anna, 5, Bob, 6, Carl, 7, Dora, 8?"
    rows = [(1, f"Some words. {sums}. More words."), (2, "Some words. Evaluate 3, 5, 8, 9, 11, 13 and 15. More words."), (3, f"First. {listed}. Last"),
            (4, "First. Evaluate the sum of these many numbers now: 8, 9"), (5, "Numbers: " + ", ".join(str(i * i) for i in range(15))), (6, f"Yes. {names} No.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, sums), (2, listed), (3, names)], "item_id long, text string")
    got = collected(decontaminate.marked(docs, items), "id", "items", "reparameterised")
    assert got == [(1, [1], False), (2, [], False), (3, [2], False), (4, [2], True), (5, [], False), (6, [3], False)]


def test_decontamination_finds_copies_in_other_case(spark):
    short, long = "What is the capital of France?", "The old keeper of the lamp in Bergen told Ida Holm that the ships would not return before spring."
    texts = [f'He asked, "{short}"', f"1) {short}", f"Q - {short}", long.title(), f"so {long}", long, long.replace("Bergen", "Oslo").replace("Ida Holm", "Ada"),
             "He asked what the capital of anything might be"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame([(1, short), (2, long), (3, long.lower())], "item_id long, text string")
    got = collected(decontaminate.marked(docs, items), "id", "items", "reparameterised")
    assert [g[1][:2] for g in got] == [[1], [1], [1], [2, 3], [2, 3], [2, 3], [2], []]
    assert [g[2] for g in got][:6] == [False] * 6
    other = decontaminate.marked(docs.filter("doc_id = 6"), items.filter("item_id = 2")).first()
    assert other["contaminated"] and other["reparameterised"]


def test_decontamination_short_items_stand_alone(spark):
    texts = ["We know what is 5 and what is 12 of 5 parts", "What is 12 + 6?", "Quiz.\nWhat is 12 + 5?\nThen more", 'He asked "what is 12 + 5" and left', "1) What is 12 + 5?",
             "I went to the market and saw the sea", "To the sea!", "he said 'to the sea' and 'so on'", "Really: to the sea", "the sea's end, to the sea's end"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "What is 12 + 5?"), (2, "the"), (3, "to the sea")], "item_id long, text string")
    got = [r[1] for r in collected(decontaminate.marked(docs, items), "id", "items")]
    assert got == [[], [], [1], [1], [1], [], [3], [3], [3], []]


# --------------------------------------------------------------------- licences

def test_licenses(spark, awkward, none):
    mit = "\n".join(f"{licenses.SENTENCES[k]}" for k in ("mit.grant", "mit.notice", "mit.warranty", "mit.liability"))
    wrapped = mit.replace(" copy, modify", " copy,\nmodify").replace("substantial portions", "substantial\nportions")
    rows = [(1, f"Some text\nReleased under the MIT License.\n{mit}"), (2, "intro\n\n" + wrapped), (3, "Released under no license."), (4, None), (None, "Licensed under CC BY-NC 4.0."),
            (5, licenses.SENTENCES["mit.grant"]), (6, " ".join(licenses.SENTENCES[k] for k in ("gpl.free3", "gpl.warranty", "gpl.see")))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["id"], r["license"]): (r["score"], r["n_full"]) for r in licenses.scan(docs).collect()}
    assert got[1, "MIT"] == (1.0, 2) and got[2, "MIT"] == (1.0, 1) and got[None, "CC-BY-NC-4.0"] == (1.0, 1)
    assert (3, "MIT") not in got and not any(k[0] in (4, 5) for k in got)
    assert got[6, "GPL-3.0-or-later"][0] >= 0.6 and got[6, "GPL-3.0-or-later"][1] == 0
    assert licenses.scan(none).count() == 0 and licenses.scan(awkward).count() == 0


def test_license_gate_is_in_every_sentence():
    import re
    gate = re.compile(f"(?i){licenses.GATE}")
    parts = [p for s in licenses.SENTENCES.values() for p in re.split(r"(?<=[.!?;:])[ \t]+", s) if re.search("[A-Za-z]", p)]
    assert [p for p in parts if not gate.search(p) and not gate.search(licenses.normal(p))] == []
    assert {i for _, ids in licenses.RULES for i in ids} <= set(licenses.SENTENCES)


def test_license_lines_of_the_documents_are_found(spark):
    """Lines found in the texts by words of their own, not by the operator's sentences."""
    import re
    line = re.compile(r"(?im)^((licensed|released|this work is licensed) under .{3,90}|all rights reserved)[.]$")
    docs = documents(spark, "/root/testdata/sf0.01")
    held = {r["doc_id"] for r in docs.collect() if line.search(r["text"] or "")}
    found = {(r["id"], r["license"]) for r in licenses.scan(docs).collect()}
    assert len(held) > 30 and held <= {i for i, _ in found}
    reserved = {r["doc_id"] for r in docs.filter("text LIKE '%All rights reserved.%'").collect()}
    assert reserved and reserved <= {i for i, name in found if name == "Proprietary"}


def test_license_references(spark):
    said = [("Proprietary", "Copyright 2020 A. Body. All rights reserved."), ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
            ("AGPL-3.0", "This project is licensed under the GNU Affero General Public License, version 3."), ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
            ("CC0-1.0", "Released under CC0 1.0."), ("MIT", "Released under the MIT License.")]
    docs = spark.createDataFrame([(i, f"some text\n{line}\n") for i, (_, line) in enumerate(said)], "doc_id long, text string")
    assert collected(licenses.scan(docs), "id", "license", "score", "n_full") == [(i, name, 1.0, 1) for i, (name, _) in enumerate(said)]


# ------------------------------------------------------------------------- chat

def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "<\\s>\\\\<<SYS>>", "a<", "[", "", None, "é😀\n", "<s", "<</SYS>> [\\/INST]", "&amp;&#10;"]
    rows = [(c, t, r, x) for c in range(3) for t, x in enumerate(texts) for r in [("user", "assistant", "sys\ntem & <s>", None)[(t + c) % 4]]]
    rows += [(5, 0, "user", "tie b"), (5, 0, "user", "tie a"), (5, None, "user", "first"), (None, 3, "assistant", "x")]
    rows += [(7, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(-600, 700)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    messages = chat_format.chains(df)
    chunks = stored(chat_format.formatted(messages, chat_format.best_paths(messages)), "chunks")
    assert chunks.filter("n_turns > 256").isEmpty() and chunks.filter("tree = 7").count() > 1
    turns, loss = {}, {}
    for r in chat_format.read_back(chunks).orderBy("chunk").collect():
        turns.setdefault(r["tree"], []).extend((t["role"], t["text"]) for t in r["turns"])
        loss.setdefault(r["tree"], []).extend(r["loss"])
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert turns[c] == [(r[2] or "", r[3] or "") for r in own]
        assert loss[c] == [r[3] or "" for r in own if r[2] == "assistant"]
    digest = {r["tree"]: r for r in chat_format.digests(chunks).collect()}
    whole = {r["tree"]: r["formatted"] for r in chat_format.whole(chunks).collect()}
    assert all(digest[c]["formatted_chars"] == len(whole[c]) for c in digest)
    assert digest[7]["turns_sha256"] == brute.sha("".join(f"{a}\n{b}\n" for a, b in turns[7]))
    assert chat_format.digests(chat_format.formatted(chat_format.chains(df.limit(0)), chat_format.best_paths(chat_format.chains(df.limit(0))))).count() == 0


def test_chat_trees(spark):
    """Branches are ranked by the scores on their path; cycles have no path; a lost parent starts one."""
    rows = [(1, 1, None, 0.0), (1, 2, 1, 5.0), (1, 3, 1, 1.0), (1, 4, 3, 9.0), (1, 5, 2, 1.0), (2, 1, 2, 1.0), (2, 2, 1, 1.0), (2, 9, 2, 1.0), (3, 7, 99, None), (3, 8, 7, 1.0)]
    df = spark.createDataFrame([(t, m, p, "user", f"m{m}", s) for t, m, p, s in rows], "tree long, msg long, parent long, role string, text string, score double")
    got = collected(chat_format.best_paths(df, top=1), "tree", "path", "place", "msg")
    assert got == [(1, 4, 0, 1), (1, 4, 1, 3), (1, 4, 2, 4), (3, 8, 0, 7), (3, 8, 1, 8)]
    both = collected(chat_format.best_paths(df.filter("tree = 1"), top=5), "path", "place", "msg")
    assert both == [(4, 0, 1), (4, 1, 3), (4, 2, 4), (5, 0, 1), (5, 1, 2), (5, 2, 5)]
