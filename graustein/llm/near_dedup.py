"""Near-duplicate groups by fast similarity sketches, banding and exact verification.

1. One pass over the texts makes, for each, the set of its distinct 5-word shingles (64-bit
   hashes), a 128-bit signature of the whole set, and a sketch of 128 coordinates. The
   sketch is filled by rounds: round i puts every shingle into one hashed coordinate with the
   value (i, hash) and the least value stays; from round 128 on, round i sends all shingles
   to coordinate i - 128, so that at most 256 rounds fill every coordinate, and most sets are
   done after a few.
2. Rows with equal signatures form a class; one row of each class goes on.
3. Coordinates are banded by four: two sets of similarity 0.85 share none of the 32 bands with
   probability 6e-11 (0.8: 5e-8).
4. Classes with a common band are candidates. Of these, the full sets are built again and
   pairs are narrowed without loss: ordered from the rarest shingle (counted over all
   candidates) on, two linked sets share one of their first n - ceil(0.85 n) + 1 shingles,
   and what follows the first common one must suffice for the similarity. Variants that each
   changed too much drop out here, however many there are.
5. Links are confirmed on the full sets. Every bucket of classes with a common rare shingle has
   a centre, the member with the fewest rarer shingles; the others are compared with it, and
   links join components. What is left in buckets of up to ``SMALL`` members is compared.
6. In larger buckets a set is replaced by its deviations, the shingles that it or its centre has
   and the other has not. Two sets x and y of a centre differ in |x|' + |y|' shingles less twice
   the deviations they share, so two linked ones either are both linked with the centre or
   share a known least number of deviations. They are met by the rarest of them (counted in the
   group of the centre), again without loss. Variants of a text that differ from it in
   places of their own share nearly all shingles but hardly a deviation, so pairs of them aren't
   listed however large their group is.

Full sets are built again only for the classes in shared buckets: a filter of fixed size
(8 MB) on their ids skips the other texts.

Defined cases: words are separated by space and the ASCII characters 9 to 13, A-Z count as
a-z; a text with fewer than five words has its word sequence as its one shingle; an empty,
blank or null text has none and is linked with nothing. A null id counts as the largest.
Of rows with equal ids in a group one is kept. Only the id and the text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graustein.llm import base
from graustein.llm.base import keep_rows, map_arrow, mix, seed, stored, text_hash
from graustein.llm.components import components

SKETCH, ROWS = 128, 4
WORDS = 5
SMALL = 16
SEEDS = np.array([seed(1000 + i) for i in range(2 * SKETCH)], np.uint64)


def text_shingles(data: np.ndarray, offsets: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct shingles, sorted by both."""
    starts, ends, doc = base.word_spans(data, offsets)
    return base.shingles(base.span_hashes(base.LOWER[data], starts, ends), doc, len(offsets) - 1, k)


def signatures(doc: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(texts, 2): two 64-bit sums over each set."""
    out = np.zeros((len(n), 2), np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        first = np.searchsorted(doc, some)
        for j in range(2):
            out[some, j] = mix(np.add.reduceat(mix(h + seed(50 + j)), first) + n[some].astype(np.uint64))
    return out


def sketch(doc: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(texts, SKETCH) least (round, hash) of every coordinate; texts without shingles keep the maximum."""
    top = np.uint64(2**64 - 1)
    flat = np.full(len(n) * SKETCH, top, np.uint64)
    open_docs = np.zeros(len(n), bool)
    open_docs[n > 0] = True
    for i in range(2 * SKETCH):
        if not len(h):
            break
        v = mix(h ^ SEEDS[i])
        coordinate = (v & np.uint64(SKETCH - 1)).astype(np.int64) if i < SKETCH else i - SKETCH
        np.minimum.at(flat, doc * SKETCH + coordinate, (v >> np.uint64(8)) | (np.uint64(i) << np.uint64(56)))
        here = np.flatnonzero(open_docs)
        full = (flat.reshape(-1, SKETCH)[here] != top).all(axis=1)
        if full.any():
            open_docs[here[full]] = False
            left = open_docs[doc]
            doc, h = doc[left], h[left]
    return flat.reshape(-1, SKETCH)


def bands(sketches: np.ndarray) -> np.ndarray:
    """(texts, SKETCH // ROWS) hashes of the bands; the band's number is part of its hash."""
    parts = sketches.reshape(len(sketches), SKETCH // ROWS, ROWS)
    out = np.broadcast_to(np.arange(SKETCH // ROWS, dtype=np.uint64) + np.uint64(1), parts.shape[:2]).copy()
    for j in range(ROWS):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return out


def _sketch_rows(batches):
    for batch in batches:
        for i, j, data, offsets in base.slices(batch.column(3)):
            doc, h = text_shingles(data, offsets)
            n = np.bincount(doc, minlength=j - i)
            some = np.flatnonzero(n)
            sig = signatures(doc, h, n)
            band = bands(sketch(doc, h, n)[some]).view(np.int64)
            lists = np.zeros(j - i + 1, np.int32)
            lists[1:] = np.cumsum((n > 0) * band.shape[1])
            yield pa.record_batch([
                *(c.slice(i, j - i) for c in batch.columns[:3]), pa.array(n.astype(np.int64)),
                pa.array([x.tobytes() for x in sig], pa.binary()),
                pa.ListArray.from_arrays(pa.array(lists), pa.array(band.ravel())),
            ], ["uid", "id", "th", "n", "cls", "bands"])


def _candidate_sets(shared):
    def run(batches):
        for batch in batches:
            hit = base.in_bitmap(shared.value, batch.column(0).to_numpy())
            batch = batch.filter(pa.array(hit))
            for i, j, data, offsets in base.slices(batch.column(1)):
                doc, h = text_shingles(data, offsets)
                n = np.bincount(doc, minlength=j - i)
                cut = np.zeros(len(n) + 1, np.int64)
                np.cumsum(n, out=cut[1:])
                sig = signatures(doc, h, n)
                yield pa.record_batch([pa.array([x.tobytes() for x in sig], pa.binary()),
                                       pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(h.view(np.int64)))], ["cls", "h"])
    return run


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (v.values.to_numpy().view(np.uint64) for v in (x, y))
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.record_batch([*batch.columns[:2], pa.array(keep, pa.bool_())], ["a", "b", "linked"])
    return run


def rare_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """(token, uid, n, rest) of the shingles at which two linked sets can meet first: ``sets``
    (uid, n, h); ``rest`` counts the set's shingles from this one on, rarest first."""
    each = sets.select("uid", "n", F.explode("h").alias("token"))
    count = each.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    common = each.join(count, "token").groupBy("uid", "n").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("common"))
    needed = F.ceil(F.col("n") * percent / 100).cast("long")
    own = F.col("n") - F.size("common")  # shingles of no other set come first
    first = F.greatest(F.lit(0), F.col("n") - needed + 1 - own).cast("int")
    return common.select("uid", "n", own.alias("own"), F.posexplode(F.slice("common", F.lit(1), first)).alias("at", "c")).select(
        F.col("c.token").alias("token"), "uid", "n", (F.col("n") - F.col("own") - F.col("at")).alias("rest"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked ones of ``pairs`` (a, b), by their full sets."""
    x = sets.select(F.col("uid").alias("a"), F.col("h").alias("ha"))
    y = sets.select(F.col("uid").alias("b"), F.col("h").alias("hb"))
    each = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    done = map_arrow(each.join(x, "a").join(y, "b").select("a", "b", "ha", "hb"), _verify(percent), "a long, b long, linked boolean")
    return stored(done.filter("linked").select("a", "b"), "verified")


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` (uid, ..) with the label of the uid's component, the uid itself without links."""
    if labels is None:
        return rows.withColumn("label", F.col("uid"))
    return rows.join(labels.withColumnRenamed("node", "uid"), "uid", "left").select(*rows.columns, F.coalesce("label", "uid").alias("label"))


def _deviations(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``members`` (center, uid, n, label) with size, the number of deviations d from the centre, and
    excess: x and y are linked when excess(x) + excess(y) <= 2 * (100 + percent) * shared deviations.
    far: not linked with the centre, whose own excess is the least there can be."""
    x = sets.select("uid", "h")
    c = sets.select(F.col("uid").alias("center"), F.col("n").alias("center_n"), F.col("h").alias("center_h"))
    d = F.concat(F.array_except("h", "center_h"), F.array_except("center_h", "h"))
    both = members.join(x, "uid").join(c, "center").select("center", "uid", "n", "label", "center_n", d.alias("d"))
    excess = (100 + percent) * F.size("d").cast("long") - (100 - percent) * F.col("n")
    return both.select("center", "uid", "label", "d", F.size("d").cast("long").alias("size"), excess.alias("excess"),
                       (excess > (100 - percent) * F.col("center_n")).alias("far"))


def _deviating_pairs(deviations: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the members of a centre that can be linked though one of them is far from it.

    Of a pair the member with the larger excess is far. The other needs a shared deviation among those
    that it shares first with any far member, the far one among those first shared with any member."""
    unit = 2 * (100 + percent)
    bounds = deviations.groupBy("center").agg(F.min("excess").alias("least"), F.min(F.when(F.col("far"), F.col("excess"))).alias("least_far"))
    each = deviations.join(bounds.filter("least_far is not null"), "center")
    feature = each.select("center", "uid", F.explode("d").alias("f"))
    count = feature.groupBy("center", "f").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    common = feature.join(count, ["center", "f"]).groupBy("center", "uid").agg(F.array_sort(F.collect_list(F.struct("df", "f"))).alias("common"))

    def first(least):
        """How many common deviations a partner of this excess or more can be met at first; the uncommon ones come before them."""
        needed = F.greatest(F.lit(1), F.ceil((F.col("excess") + least) / unit).cast("long"))
        return F.greatest(F.lit(0), F.size("common") - needed + 1).cast("int")
    placed = (each.drop("d").join(common, ["center", "uid"])
              .withColumn("as_near", first(F.greatest("excess", "least_far")))
              .withColumn("as_far", F.when(F.col("far"), first(F.col("least"))).otherwise(0)))
    met = stored(placed.select("center", "uid", "label", "excess", "as_near", "as_far", F.size("common").alias("all"),
                               F.posexplode(F.slice("common", F.lit(1), F.greatest("as_near", "as_far"))).alias("at", "c"))
                 .select("center", F.col("c.f").alias("f"), "uid", "label", "excess", (F.col("all") - F.col("at")).alias("rest"),
                         (F.col("at") < F.col("as_near")).alias("near"), (F.col("at") < F.col("as_far")).alias("far")), "deviating")
    x, y = met.filter("near").alias("x"), met.filter("far").alias("y")
    return x.join(y, (F.col("x.center") == F.col("y.center")) & (F.col("x.f") == F.col("y.f")) & (F.col("x.label") != F.col("y.label"))
                  & (F.struct("x.excess", "x.uid") < F.struct("y.excess", "y.uid"))
                  & (F.least("x.rest", "y.rest") * unit >= F.col("x.excess") + F.col("y.excess"))
                  ).select(F.col("x.uid").alias("a"), F.col("y.uid").alias("b"))


def _links(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """(node, label) of the classes that have links, None without links; ``buckets`` (token, uid,
    n, rest), ``sets`` (uid, n, h)."""
    def feasible(n, rest):
        return F.least("rest", rest) * (100 + percent) >= (F.col("n") + F.col(n)) * percent
    centers = stored(buckets.groupBy("token").agg(F.min(F.struct((F.col("n") - F.col("rest")).alias("before"), "uid", "n", "rest")).alias("c"),
                                                  F.count(F.lit(1)).alias("members")).filter("members > 1")
                     .select("token", F.col("c.uid").alias("center"), F.col("c.n").alias("center_n"), F.col("c.rest").alias("center_rest")), "centers")
    others = stored(buckets.join(centers, "token").filter("uid != center"), "others")
    links = _verified(others.filter(feasible("center_n", "center_rest")).select(F.col("uid").alias("a"), F.col("center").alias("b")), sets, percent)
    labels = None if links.isEmpty() else components(links)
    # a centre has met every member of its bucket; what is left may hold links between the others
    here = _labelled(others.select("token", "center", "uid", "n", "rest"), labels)
    mixed = (here.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("members"))
             .filter("lo < hi").select("token", "members"))
    here = stored(here.join(mixed, "token"), "mixed")
    if here.isEmpty():
        return labels
    x = here.filter(F.col("members") <= SMALL)
    y = x.select("token", F.col("uid").alias("other"), F.col("label").alias("other_label"), F.col("n").alias("other_n"), F.col("rest").alias("other_rest"))
    small = x.join(y, (x["token"] == y["token"]) & (F.col("uid") < F.col("other")) & (F.col("label") != F.col("other_label"))
                   & feasible("other_n", "other_rest")).select(F.col("uid").alias("a"), F.col("other").alias("b"))
    members = here.filter(F.col("members") > SMALL).select("center", "uid", "n", "label").distinct()
    deviations = stored(_deviations(members, sets, percent), "deviations")
    pairs = small.unionByName(_deviating_pairs(deviations, percent))
    links = (links.unionByName(deviations.filter("not far").select(F.col("uid").alias("a"), F.col("center").alias("b")))
             .unionByName(_verified(pairs, sets, percent)))
    return labels if links.isEmpty() else components(links)


def near_groups(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: uid, id, th, n_shingles, component_id, kept.

    Two rows are linked when the intersection of their shingle sets is at least ``percent``
    hundredths of the union; component_id is the smallest id that can be reached."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = stored(map_arrow(
        texts.select(F.monotonically_increasing_id().alias("uid"), "id", text_hash(F.col("text")).alias("th"), "text"), _sketch_rows,
        f"uid long, id {texts.schema['id'].dataType.simpleString()}, th long, n long, cls binary, bands array<long>"), "sketches")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("uid"))
    classes = stored(rows.filter("n > 0").groupBy("cls", "n").agg(F.min(order).alias("first"))
                     .select("cls", "n", F.col("first.uid").alias("uid"), F.col("first.id").alias("id")), "classes")
    reps = rows.select("uid", "bands").join(classes.select("uid"), "uid")
    each = reps.select("uid", F.explode("bands").alias("band"))
    shared = each.groupBy("band").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("band")
    candidates = each.join(shared, "band").select("uid").distinct()
    wanted = stored(classes.join(candidates, "uid"), "wanted")
    bitmap = docs.sparkSession.sparkContext.broadcast(base.bitmap_of(wanted, "id"))
    again = map_arrow(texts.select(base.filter_position("id").alias("p"), "text"), _candidate_sets(bitmap), "cls binary, h array<long>")
    sets = stored(again.join(wanted.select("cls", "uid", "n"), "cls").groupBy("uid", "n").agg(F.any_value("h").alias("h")), "sets")
    labels = _links(stored(rare_shingles(sets, percent), "rare"), sets, percent)
    labelled = classes.withColumn("label", F.col("uid"))
    if labels is not None:
        labelled = classes.join(labels.withColumnRenamed("node", "uid"), "uid", "left").withColumn("label", F.coalesce("label", "uid"))
    heads = labelled.groupBy("label").agg(F.min(order).alias("head"))
    of_class = stored(labelled.join(heads, "label").select("cls", F.col("head.id").alias("head_id"), F.col("head.uid").alias("head_uid")), "heads")
    return rows.join(of_class, "cls", "left").select(
        "uid", "id", "th", F.col("n").alias("n_shingles"),
        F.when(F.col("head_uid").isNull(), F.col("id")).otherwise(F.col("head_id")).alias("component_id"),
        (F.coalesce("head_uid", "uid") == F.col("uid")).alias("kept"))


def keep_one(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group (the one with the smallest id), all columns kept."""
    return keep_rows(docs, near_groups(docs, percent, id_col, text_col).select("id", "th", "kept"), id_col, text_col)
