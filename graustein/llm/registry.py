"""The registered queries of the subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F

from graustein.llm import (
    bpe, chat_format, decontaminate, exact_dedup, licenses, near_dedup, periodic_runs, piece_bpe, pii, suffix_dedup, token_planes, toxicity, vector_codes,
)
from graustein.llm.base import scratch, table

QUERIES, ORACLE = {}, {}


def query(name, oracle=None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return register


@query("op10_exact_dedup", """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op10_exact_dedup(spark, sf_dir):
    """Every document with its group of equal texts."""
    return exact_dedup.groups(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op5_minhash_near_dedup", """
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  WITH RECURSIVE r(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN both_ways e ON e.a = r.other)
  SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN reach USING (doc_id)""")
def op5_minhash_near_dedup(spark, sf_dir):
    """Every document with its near-duplicate component."""
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), 85).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def _escaped(text):
    """DuckDB: ``text`` with the control strings escaped."""
    for opening, rest in (("<", "/?s>"), ("\\[", "/?INST\\]"), ("<<", "/?SYS>>")):
        text = f"regexp_replace({text}, '({opening})(\\\\*{rest})', '\\1\\\\\\2', 'g')"
    return text


@query("op1_chat_format", f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
turns AS (
  SELECT *, length({_escaped("replace(replace(role, '&', '&amp;'), chr(10), '&#10;')")}) + length({_escaped("text")}) + 8
         + CASE WHEN role = 'assistant' THEN 0 ELSE 15 END AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id""")
def op1_chat_format(spark, sf_dir):
    """All conversations and one whose texts hold control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    messages = chat_format.chains(rows.unionByName(control))
    chunks = chat_format.formatted(messages, chat_format.best_paths(messages, top=1))
    return chat_format.digests(chunks).withColumnRenamed("tree", "conv_id").drop("path")


@query("op9_byte_bpe")
def op9_byte_bpe(spark, sf_dir):
    """Every document encoded by the ranks file and decoded from its ids."""
    import public_tokenizers
    coded = bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.digests(coded).withColumnRenamed("id", "doc_id")


@query("op2_token_planes")
def op2_token_planes(spark, sf_dir):
    """Every document's ids, written in the plane format and read back from the files."""
    import public_tokenizers
    out = scratch(spark, "token_planes")
    token_planes.write(table(spark, sf_dir, "documents"), out, public_tokenizers.path("byte_bpe_50k.json"))
    return token_planes.read(spark, out, F.crc32("ids").alias("ids_crc32")).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@query("op7_suffix_dedup")
def op7_suffix_dedup(spark, sf_dir):
    """Every document without the bytes that a repeated 200-byte string covers."""
    return suffix_dedup.repeats_removed(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op4_pii")
def op4_pii(spark, sf_dir):
    """The personal data in every document."""
    found = pii.spans(table(spark, sf_dir, "documents"))
    counts = (pii.count(F.col("base"), i).alias(f"n_{k}") for i, k in enumerate(pii.BASE))
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("all")).alias("spans"),
                        F.size("all").cast("long").alias("n_spans"))


@query("op6_toxicity")
def op6_toxicity(spark, sf_dir):
    """Every document with its expected severity; the model is trained on the labels."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).withColumnRenamed("id", "doc_id")


@query("op8_decontaminate")
def op8_decontaminate(spark, sf_dir):
    """Every document with the benchmark items that contaminate it."""
    return decontaminate.marked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


def _license_sql() -> str:
    """DuckDB: the same scan, written with its own tables."""
    import re
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = []
    for rule, (name, ids) in enumerate(licenses.RULES):
        parts = [p for i in ids for p in map(licenses.normal, re.split(r"(?<=[.!?;:])[ \t]+", licenses.SENTENCES[i])) if re.search("[a-z]", p)]
        rows += [f"({quote(p)}, {rule}, {quote(name)}, {step}, {len(parts)})" for step, p in enumerate(parts)]
    clean = ("list_filter(list_transform({}, lambda p: trim(regexp_replace(translate(p, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             "'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'))), lambda p: regexp_matches(p, '[a-z]'))")
    lines = clean.format("string_split(regexp_replace(text, '([.!?;:])[ \\t]+', '\\1' || chr(10), 'g'), chr(10))")
    wrapped = clean.format("string_split(regexp_replace(translate(regexp_replace(text, '\\n[ \\t\\r]*\\n', chr(1), 'g'), chr(10), ' '), "
                           "'([.!?;:])[ \\t]+', '\\1' || chr(1), 'g'), chr(1))")
    return f"""
WITH rules(sentence, rule, license, step, size) AS (VALUES {', '.join(rows)}),
cut AS (SELECT doc_id, 0 AS form, {lines} AS s FROM documents UNION ALL SELECT doc_id, 1, {wrapped} FROM documents),
lines AS (SELECT doc_id, form, unnest(s) AS sentence, generate_subscripts(s, 1) AS line FROM cut),
units AS (  -- the sequence of the known sentences of a document
  SELECT doc_id, form, sentence, row_number() OVER (PARTITION BY doc_id, form ORDER BY line) AS place
  FROM lines WHERE sentence IN (SELECT sentence FROM rules)),
runs AS (
  SELECT doc_id, form, rule, license, count(DISTINCT step)::DOUBLE / size AS score
  FROM units JOIN rules USING (sentence) GROUP BY doc_id, form, rule, license, size, place - step),
forms AS (
  SELECT doc_id, form, license, max(score) AS score, count(*) FILTER (score = 1) AS n_full
  FROM runs WHERE score >= 0.6 GROUP BY ALL)
SELECT doc_id, license, max(score) AS score, max(n_full) AS n_full FROM forms GROUP BY doc_id, license"""


@query("op3_license_scan", _license_sql())
def op3_license_scan(spark, sf_dir):
    """The licences that the sentences of every document name."""
    return licenses.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op11_sentencepiece")
def op11_sentencepiece(spark, sf_dir):
    """Every document encoded by the SentencePiece model and decoded from its ids."""
    import public_tokenizers
    coded = piece_bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def _codes_sql() -> str:
    """DuckDB: codebooks and codes by comparing every part with every entry."""
    rounds = ""
    for i in range(vector_codes.ROUNDS + 1):
        rounds += f""",
near{i} AS (
  SELECT r, p, min(struct_pack(d := list_inner_product(part, part) - 2 * list_inner_product(part, e) + list_inner_product(e, e), entry := entry)) AS best
  FROM parts JOIN book{i} USING (p) GROUP BY r, p)"""
        if i < vector_codes.ROUNDS:
            rounds += f""",
sums{i} AS (
  SELECT p, entry, place, sum(x)::BIGINT AS t, count(*) AS n
  FROM (SELECT p, best.entry AS entry, unnest(part)::BIGINT AS x, generate_subscripts(part, 1) AS place FROM near{i} JOIN parts USING (r, p))
  GROUP BY p, entry, place),
moved{i} AS (SELECT p, entry, list(((t - ((t % n) + n) % n) // n)::DOUBLE ORDER BY place) AS e FROM sums{i} GROUP BY p, entry),
book{i + 1} AS (SELECT p, entry, coalesce(m.e, b.e) AS e FROM book{i} b LEFT JOIN moved{i} m USING (p, entry))"""
    last, parts = vector_codes.ROUNDS, vector_codes.PARTS
    return f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r,
         list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT r, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS part FROM kept, range({parts}) t(p)),
book0 AS (SELECT p, r - 1 AS entry, part AS e FROM parts WHERE r <= {vector_codes.ENTRIES}){rounds},
coded AS (SELECT r, string_agg(format('{{:02x}}', best.entry), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near{last} GROUP BY r),
entries AS (SELECT p, entry, unnest(e)::BIGINT AS x, generate_subscripts(e, 1) AS place FROM book{last})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, entry, place)) FROM entries) AS codebooks_sha256
FROM kept JOIN coded USING (r)"""


@query("op12_vector_codes", _codes_sql())
def op12_vector_codes(spark, sf_dir):
    """Every embedding's code, its error and that of its label, and the codebooks' digest."""
    coded, books = vector_codes.compressed(table(spark, sf_dir, "embeddings"))
    return coded.select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


@query("op13_periodic_runs", """
WITH split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ord(substr(doc_id::VARCHAR, i::BIGINT, 1))::BIGINT) AS digits FROM documents),
hashed AS (
  SELECT doc_id, w, xor(list_reduce(list_prepend(4294967295, digits), lambda c, d: list_reduce(list_prepend(xor(c, d), range(8)),
         lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) AS h FROM split),
place AS (
  SELECT doc_id, w, h % 10 = 0 AND len(w) > 0 AS planted, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, 3 + (h // 10) % 8 AS d, len(w) AS n FROM hashed),
texts AS (
  SELECT doc_id, n, CASE WHEN planted THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // d) + 1] END)
         ELSE w END AS w FROM place),
words AS (SELECT doc_id, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM texts),
same AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same),
long AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM long GROUP BY doc_id, start, length),
listed AS (
  SELECT doc_id, count(*) AS n_runs, arg_max(struct_pack(s := start, l := length, p := period), struct_pack(l := length, s := -start, p := -period)) AS best,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS text FROM runs GROUP BY doc_id),
edges AS (SELECT doc_id, start + period AS i, 1 AS e FROM runs UNION ALL SELECT doc_id, start + length, -1 FROM runs),
marked AS (SELECT doc_id, i, sum(e) AS e FROM edges GROUP BY doc_id, i),
covered AS (
  SELECT doc_id, i, word, sum(coalesce(e, 0)) OVER (PARTITION BY doc_id ORDER BY i) AS c
  FROM words LEFT JOIN marked USING (doc_id, i)),
stay AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM covered WHERE c = 0 GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period, 1000 * best.l // best.p AS exponent_milli,
       sha256(coalesce(listed.text, '')) AS runs_sha256, sha256(coalesce(stay.text, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (doc_id) LEFT JOIN stay USING (doc_id)""")
def op13_periodic_runs(spark, sf_dir):
    """The periodic runs of words in every document, some of which are made periodic first."""
    docs = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.collapsed(docs).withColumn("best", periodic_runs.greatest(F.col("runs")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
