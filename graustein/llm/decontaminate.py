"""Benchmark decontamination by template canonicalisation.

Texts become sequences of tokens (runs of letters and digits, lower case) in which numbers,
names (capitalised words inside a sentence; neighbouring ones count as one) and units (after a
number) are typed placeholders. Windows of 8 template tokens of documents and benchmark items
are hash-joined: with at least half of them literal whatever the slots hold, else (numbers or
names in a row) only with equal slot values; a filter of fixed size (8 MB) made of the
benchmark's windows keeps all other windows of the documents from being moved. A match
stands on an alignment (place in the document less place in the item). Along an alignment the
slots must be consistent: equal values of the item face equal values of the document, for at
least ``CONSISTENT`` of the item's values. A document is contaminated by an item when the
windows of consistent alignments cover ``COVERED`` of the item's windows, or the template windows
among them that share of its template windows. With other values
than the item's it is marked as re-parameterised.

Items and documents are compared in two forms, with names as slots and as plain words, each with
its own kind; the second finds copies whose words are capitalised in another way than the item's
(inside a sentence, in a title, all in lower or upper case). An item with fewer than 8 tokens is one window of its own length; with
fewer than 4 literals it is only found with equal slot values and between ends of sentences, lines,
brackets or quotations. Items with equal templates
are matched as one and reported each.

Defined cases: null texts and items count as empty and match nothing; a null document id stays
null; rows that agree in id and text get the same result; items without a token
match nothing; no documents give no rows; no items leave all documents clean.
Only ids and texts are read; texts are processed whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graustein.llm import base
from graustein.llm.base import map_arrow, mix, seed, stored, text_hash
from graustein.llm.toxicity import APART

WINDOW = 8
COVERED, CONSISTENT = 0.3, 0.8

# Units of measure and currency, as they follow a number.
UNITS = ("kg g mg t lb lbs oz km m cm mm mi mile miles ft feet foot inch inches in yd yard yards l ml liter liters litre litres gallon gallons "
         "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years percent pct "
         "usd eur dollar dollars euro euros cent cents pound pounds meter meters metre metres gram grams kilogram kilograms kilometer kilometers").split()
LITERAL, NUMBER, NAME, UNIT = range(4)

DIGIT, UPPER, LETTER, STOP, EDGE = (np.zeros(256, bool) for _ in range(5))
DIGIT[ord("0"):ord("9") + 1] = True
UPPER[ord("A"):ord("Z") + 1] = True
LETTER[ord("a"):ord("z") + 1] = LETTER[128:] = True
STOP[[ord(c) for c in ".!?:\n"]] = True
EDGE[[ord(c) for c in ".!?:\n;\r\t\"()[]{}|<>*#"]] = True


def _hash_words(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return np.sort(base.span_hashes(data, ends - [len(w) for w in words], ends))


UNIT_HASHES = _hash_words(UNITS)


def folded(data: np.ndarray) -> np.ndarray:
    """Lower case for A-Z and the accented letters of Latin-1 (two bytes in UTF-8)."""
    out = base.LOWER[data]
    accented = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    out[1:][accented] += 32
    return out


def template(data: np.ndarray, offsets: np.ndarray, names: bool = True):
    """(text number, key, value, literal, whole, opens, closes) of the template tokens: ``key`` is what must agree, the
    hash of a literal or of a placeholder's type; ``value`` the hash of what filled a slot, or 0;
    ``whole`` the hash of the token as it stands, with all words of a name; ``opens`` and ``closes``
    tell whether a sentence, a line, a bracket or a quotation may begin before or end after it."""
    if not len(data):
        z = np.zeros(0, np.uint64)
        return np.zeros(0, np.int64), z, z, np.zeros(0, bool), z, np.zeros(0, bool), np.zeros(0, bool)
    point = ((data == ord(".")) | (data == ord(",")))
    point[1:-1] &= DIGIT[data[:-2]] & DIGIT[data[2:]]
    point[[0, -1]] = False
    inner = offsets[1:-1]
    point[inner[inner < len(data)]] = False
    point[inner[inner > 0] - 1] = False
    starts, ends, doc = base.mask_spans(~APART[data] | point, offsets)
    h = base.span_hashes(folded(data), starts, ends)
    if not len(h):
        return doc, h, h, np.zeros(0, bool), h, np.zeros(0, bool), np.zeros(0, bool)
    first = np.ones(len(h), bool)
    first[1:] = doc[1:] != doc[:-1]
    stops = np.concatenate([[0], np.cumsum(STOP[data])])
    opens = first.copy()
    opens[1:] |= stops[starts[1:]] > stops[ends[:-1]]
    kind = np.full(len(h), LITERAL, np.int8)
    second, third = (data[np.minimum(starts + i, ends - 1)] for i in (1, 2))
    capital = UPPER[data[starts]] & LETTER[second] & (ends - starts > 1)
    capital |= (data[starts] == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (LETTER[third] | (ends - starts == 2))
    if names:
        kind[capital & ~opens] = NAME
    kind[DIGIT[data[starts]]] = NUMBER
    unit = np.zeros(len(h), bool)
    unit[1:] = (kind[:-1] == NUMBER) & ~first[1:] & (starts[1:] - ends[:-1] <= 1)
    at = np.minimum(np.searchsorted(UNIT_HASHES, h), len(UNIT_HASHES) - 1)
    kind[unit & (UNIT_HASHES[at] == h)] = UNIT
    more = np.zeros(len(h), bool)  # a further word of the same name
    more[1:] = (kind[1:] == NAME) & (kind[:-1] == NAME) & ~first[1:]
    at = np.flatnonzero(~more)
    nth = np.arange(len(h)) - np.repeat(at, np.diff(np.append(at, len(h))))
    edge = EDGE[data]
    quote = data == ord("'")  # not within a word
    quote[1:-1] &= APART[data[:-2]] | APART[data[2:]]
    edges = np.concatenate([[0], np.cumsum(edge | quote)])
    begins = first.copy()
    begins[1:] |= edges[starts[1:]] > edges[ends[:-1]]
    closes = np.append(begins[1:], True)[np.append(at[1:], len(h)) - 1]
    whole = np.add.reduceat(h * base.powers(int(nth.max()) + 1)[nth], at)
    doc, h, kind = doc[~more], h[~more], kind[~more]
    literal = kind == LITERAL
    types = np.array([seed(200 + k) for k in range(4)], np.uint64)
    return doc, np.where(literal, h, types[kind]), np.where(literal, np.uint64(0), h), literal, whole, begins[at], closes


def template_windows(tokens, length: int, form: int):
    """(text number, place, hash, exact, slot values (n, length)) of the windows of ``length`` of the
    ``template`` tokens of a form; the hashes of the forms differ. A window of too few literals is exact: its hash holds its slot values,
    and one shorter than ``WINDOW`` (a whole item) must stand between ends of sentences or lines.
    Places count the text's windows from 0."""
    doc, key, value, literal, whole, opens, closes = tokens
    h, at = base.windows(key, doc, length)
    same, _ = base.windows(whole, doc, length)
    enough = np.concatenate([[0], np.cumsum(literal)])
    exact = enough[at + length] - enough[at] < WINDOW // 2 if len(at) else np.zeros(0, bool)
    if length < WINDOW and len(at):
        ok = ~exact | (opens[at] & closes[at + length - 1])
        h, same, at, exact = h[ok], same[ok], at[ok], exact[ok]
    of = doc[at]
    place = at - np.searchsorted(doc, of, "left")
    return of, place, mix(np.where(exact, same + seed(210), h) + seed(220 + form) + np.uint64(length)), exact, lambda which: value[at[which][:, None] + np.arange(length)]


ITEM = "item {id}, form int, place int, exact boolean, total int, loose int, length int, h long, slots array<long>"


def _item_windows(batches):
    """The windows of every item, with names as slots (form 1) and as words (form 0)."""
    for batch in batches:
        for i, j, data, offsets in base.slices(batch.column(1)):
            for form in (1, 0):
                asked = template(data, offsets, bool(form))
                tokens = np.bincount(asked[0], minlength=j - i)
                for length in sorted(set(np.minimum(tokens, WINDOW).tolist()) - {0}):
                    of, place, h, exact, slots = template_windows(asked, length, form)
                    own = np.minimum(tokens[of], WINDOW) == length
                    of, place, h, exact, values = of[own], place[own], h[own], exact[own], slots(np.flatnonzero(own))
                    total, loose = np.bincount(of, minlength=j - i), np.bincount(of[~exact], minlength=j - i)
                    n = len(of)
                    yield pa.record_batch([
                        batch.column(0).slice(i, j - i).take(pa.array(of)), pa.array(np.full(n, form, np.int32)), pa.array(place.astype(np.int32)), pa.array(exact),
                        pa.array(total[of].astype(np.int32)), pa.array(loose[of].astype(np.int32)), pa.array(np.full(n, length, np.int32)), pa.array(h.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array((np.arange(n + 1) * length).astype(np.int32)), pa.array(values.ravel().view(np.int64)))],
                        ["item", "form", "place", "exact", "total", "loose", "length", "h", "slots"])


def _hits(shared, lengths: list[int]):
    """(id, th, place, h, slots) of the windows whose hash may be one of the benchmark's."""
    def run(batches):
        for batch in batches:
            for i, j, data, offsets in base.slices(batch.column(2)):
                for form, length in ((form, length) for form in (1, 0) for length in lengths):
                    if length == lengths[0]:
                        tokens = template(data, offsets, bool(form))
                    of, place, h, _, slots = template_windows(tokens, length, form)
                    hit = np.flatnonzero(base.in_bitmap(shared.value, (h & np.uint64(base.FILTER_BITS - 1)).astype(np.int64) + 1))
                    if not len(hit):
                        continue
                    take = pa.array(i + of[hit])
                    yield pa.record_batch([
                        batch.column(0).take(take), batch.column(1).take(take), pa.array(place[hit].astype(np.int32)), pa.array(h[hit].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array((np.arange(len(hit) + 1) * length).astype(np.int32)), pa.array(slots(hit).ravel().view(np.int64)))],
                        ["id", "th", "place", "h", "slots"])
    return run


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
          covered: float = COVERED, consistent: float = CONSISTENT) -> DataFrame:
    """(id, th, item, coverage, reparameterised): one row per contaminated document and item.
    ``th`` is xxhash64 of the text (null: empty), which tells apart rows with equal ids."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).alias("item"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("text"))
    windows = stored(map_arrow(asked, _item_windows, ITEM.format(id=asked.schema["item"].dataType.simpleString())), "item_windows")
    # items (in either form) with equal windows and slots in the same order are one class
    shapes = stored(windows.groupBy("item", "form").agg(F.xxhash64(F.array_sort(F.collect_list(F.struct("place", "h", "slots")))).alias("class")), "shapes")
    first = shapes.groupBy("class").agg(F.min(F.struct("item", "form")).alias("f")).select("class", F.col("f.item").alias("item"), F.col("f.form").alias("form"))
    distinct = stored(windows.join(first, ["item", "form"]).drop("item", "form"), "class_windows")
    lengths = [r["length"] for r in distinct.select("length").distinct().collect()]  # at most WINDOW numbers
    bitmap = spark.sparkContext.broadcast(base.bitmap_at(distinct.select((F.expr(f"h & {base.FILTER_BITS - 1}L") + 1).alias("p"))))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    hits = map_arrow(texts, _hits(bitmap, sorted(lengths)), f"id {texts.schema['id'].dataType.simpleString()}, th long, place int, h long, slots array<long>")
    theirs = distinct.select("h", "class", "total", "loose", "exact", F.col("place").alias("at"), F.col("slots").alias("asked"))
    met = stored(hits.join(theirs, "h").select("id", "th", "class", "total", "loose", "exact", "at", (F.col("place") - F.col("at")).alias("shift"),
                                               F.arrays_zip("asked", "slots").alias("slots")).distinct(), "met")
    line = ["id", "th", "class", "shift", "exact"]  # exact windows agree by themselves: what template windows hold is judged without them
    filled = met.select(*line, F.explode("slots").alias("s")).filter("s.asked != 0").select(*line, "s.asked", "s.slots").distinct()
    kept = filled.groupBy(*line, "asked").agg(F.count(F.lit(1)).alias("n"), F.min((F.col("asked") == F.col("slots")).cast("int")).alias("same"))
    slots = kept.groupBy(*line).agg(F.avg((F.col("n") == 1).cast("double")).alias("ok"), F.min("same").alias("same"))
    runs = met.groupBy(*line, "total", "loose").agg(F.collect_set("at").alias("places"))
    same_line = (runs["class"] == slots["class"]) & (runs["exact"] == slots["exact"]) & (runs["th"] == slots["th"]) & (runs["shift"] == slots["shift"]) & runs["id"].eqNullSafe(slots["id"])
    good = (runs.join(slots, same_line, "left").filter(F.coalesce("ok", F.lit(1.0)) >= consistent)
            .select(runs["id"], runs["th"], runs["class"], "total", "loose", runs["exact"], "places", F.coalesce("same", F.lit(1)).alias("same")))
    n_places = lambda which: F.size(F.array_distinct(F.flatten(F.collect_list(F.when(which, F.col("places"))))))
    # by the template windows alone, as other values change all exact ones, or by all windows
    found = good.groupBy("id", "th", "class", "total", "loose").agg(
        n_places(~F.col("exact")).alias("n"), n_places(F.lit(True)).alias("n_all"), F.coalesce(F.max(F.when(~F.col("exact"), F.col("same"))), F.lit(1)).alias("same"))
    part = F.greatest(F.when(F.col("loose") > 0, F.col("n") / F.col("loose")).otherwise(0.0), F.col("n_all") / F.col("total"))
    # of the two forms the one that covers more tells of other values: a changed name leaves form 0 fewer windows
    best = F.max(F.struct("part", "same"))
    return found.withColumn("part", part).filter(F.col("part") >= covered).join(shapes, "class").groupBy("id", "th", "item").agg(
        best["part"].alias("coverage"), (best["same"] == 0).alias("reparameterised"))


def marked(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, contaminated, items, coverage, reparameterised) of every row."""
    found = leaks(docs, items, id_col, text_col, **options)
    per = stored(found.groupBy(F.col("id").alias("fid"), F.col("th").alias("fth")).agg(
        F.array_sort(F.collect_set("item")).alias("items"), F.max("coverage").alias("coverage"), F.max("reparameterised").alias("reparameterised")), "leaks")
    rows = docs.select(F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("th"))
    return rows.join(per, (rows["th"] == per["fth"]) & rows["id"].eqNullSafe(per["fid"]), "left").select(
        "id", F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", F.array().cast(per.schema["items"].dataType)).alias("items"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"), F.coalesce("reparameterised", F.lit(False)).alias("reparameterised"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""
    found = stored(leaks(docs, items, id_col, text_col, **options).select("id", "th").distinct(), "leaks")
    th = text_hash(docs[text_col])
    return docs.join(found, docs[id_col].eqNullSafe(found["id"]) & (th == found["th"]), "left_anti")
