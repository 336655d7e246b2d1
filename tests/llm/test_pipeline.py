"""The pipeline against a brute-force version, stage by stage and as a whole."""

import re

from pyspark.sql import functions as F

import corpus_pipeline
from graustein.llm import toxicity
from graustein.llm.base import stored
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    schema, left = docs.schema, {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    model = toxicity.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    rejected = {r["id"] for r in toxicity.scored(docs, model).filter("rejected").collect()}
    plain = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "

    def exact(rows):
        last = {}
        for i in sorted(rows):
            last[rows[i]] = i
        return set(last.values())

    def near(rows):
        ids = sorted(rows)
        return {ids[k] for k in set(brute.near_components([rows[i] for i in ids], 80))}

    keep = {
        "toxicity": lambda rows: set(rows) - rejected, "exact_dedup": exact, "near_dedup": near,
        "decontamination": lambda rows: {i for i, t in rows.items() if not any(plain(x) in plain(t) for x in items)}}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SMALL), name)
        assert docs.schema == schema
        stays = keep[name](left)
        left = {i: t for i, t in left.items() if i in stays}
        assert sorted(r["doc_id"] for r in docs.select("doc_id").collect()) == sorted(left), name
    rows = corpus_pipeline.run(spark, SMALL).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, rows)) == sorted(
        (i, len(brute.token_bytes(t)) // 4, brute.sha(brute.token_bytes(t)), brute.sha(t or "")) for i, t in left.items())


def test_stages_on_awkward_rows(spark):
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "", "en", "s", 0), (None, "a text without an id", "en", "s", 1), (4, "same", "en", "s", 1),
            (4, "same", "en", "t", 1), (5, "z " * 20000, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for start, n in ((docs, 4), (docs.limit(0), 0)):
        left = start
        for name, stage in corpus_pipeline.STAGES:
            left = stored(stage(spark, left, SMALL), name)
        assert left.count() == n
    assert corpus_pipeline.without_copies(spark, docs, SMALL).filter(F.col("text") == "same").count() == 1
