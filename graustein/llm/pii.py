"""Personal data by weak supervision, with DataFrame and SQL functions only.

1. One pass over the texts finds candidates: the base kinds (email, ip, card, phone) by their
   patterns, and five further kinds (national phone numbers, identity numbers, IBANs, masked
   mail addresses, secrets such as keys and tokens). Splitting at a pattern gives the pieces between the
   matches, whose lengths give the places and whose ends the context (up to the neighbouring matches of
   the kind, which count in full); nothing leaves the JVM.
2. Six labelers vote on every candidate or abstain: two by form (regex, checksum), one by
   gazetteers, three by context.
3. Expectation-maximisation (Dawid-Skene, two classes) estimates from the counts of vote
   patterns how often each labeler is right and how common each kind is. There are at most
   kinds x 3**6 patterns, whatever the corpus; the iterations are one fold over that array.
4. A logistic regression is trained on the patterns and their posteriors, with features of
   the span that no labeler saw; it decides on the further kinds. Base spans that pass their
   checks always stay; a further span that overlaps one of them is dropped.

Whatever runs over the spans of one text (places, overlaps) is a running sum, maximum or minimum taken
in blocks, so a text with very many spans costs little more than their number.

Defined cases: null text counts as empty; a null id stays null; equal rows each get their
result; with no candidates at all nothing is trained; no rows give no rows. Places are code
points, ends exclusive. Only the id and the text are read; texts are processed whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graustein.llm.base import stored

# The base patterns. \G and the lookbehinds start a match only where a run of its
# first characters starts, which is where the leftmost match starts anyway, and the possessive
# quantifiers give nothing back that could match: long runs take linear time.
MAIL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{MAIL}]))[{MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
DOT = r"(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]{1,63})"
MORE = {
    "local": r"(?<![0-9A-Za-z+.,-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
    "ident": r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "masked": rf"(?<![{MAIL}])[{MAIL}]{{1,64}} ?(?:\(at\)|\[at\]|\{{at\}}) ?[A-Za-z0-9-]{{1,63}}{DOT}{{1,5}}",
}
# Names that secrets are assigned to, and beginnings of keys that services issue.
NAMED = "api[_-]?key|access[_-]?key|secret[_-]?key|client[_-]?secret|secret|token|passwo?r?d|pwd"
ISSUED = r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,255}|sk_(?:live|test)_[A-Za-z0-9]{10,99}|xox[abprs]-[A-Za-z0-9-]{10,99}|eyJ[A-Za-z0-9_-]{10,999}\.[A-Za-z0-9_-]{10,999}\.[A-Za-z0-9_-]{10,999}"
MORE["secret"] = (rf"(?<![0-9A-Za-z])(?:(?i:{NAMED})[\x20]{{0,2}}[:=][\x20]{{0,2}}[\"']?[A-Za-z0-9_+/=.~-]{{8,999}}|{ISSUED}|"
                  r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----)")
KINDS = [*BASE, *MORE]
# what a text must hold for a pattern to match at all
GATE = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]",
        "local": r"[0-9]{3}[ .-][0-9]{4}", "ident": r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "iban": r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}", "masked": r"[(\[{]at[)\]}]",
        "secret": rf"(?i:{NAMED})[\x20]{{0,2}}[:=]|AKIA|gh[pousr]_|sk_(?:live|test)_|xox[abprs]-|eyJ|PRIVATE KEY"}
# Words near personal data and words near other numbers, domain ends, IBAN countries.
NEAR = ("mail|contact|kontakt|contacto|write to|reach|tel|phone|call|fon|appel|llam|mobile|handy|fax|sms|whatsapp|ip|host|addr|adress|server|login|from|"
        "card|karte|carte|tarjeta|visa|master|amex|credit|kredit|iban|konto|account|compte|cuenta|ssn|social|passport|pass|name|nombre|nom")
FAR = "version|isbn|issn|doi|order|invoice|section|chapter|page|figure|table|serial|model|part no|release|build|article|price|total"
DOMAINS = ["com", "org", "net", "edu", "gov", "info", "io", "eu", "de", "fr", "es", "uk", "ch", "at", "it", "nl", "us", "ca"]
COUNTRIES = ["AT", "BE", "CH", "CZ", "DE", "DK", "ES", "FI", "FR", "GB", "IE", "IT", "LU", "NL", "NO", "PL", "PT", "SE"]

LABELERS = 6
STEPS = 30
BLOCK = 64
BEFORE, AFTER = 30, 10  # code points of context that labelers see

SPAN = "array<struct<start:int,end:int,match:string,before:string,after:string>>"


def running(values: Column, zero: Column, step) -> Column:
    """For every entry of the array ``values``: ``step`` folded over it and all entries before it, from
    ``zero`` on (``step`` must be associative). In blocks: appending to one array would cost the square."""
    # the array of one list stands for a name: its lambda sees it computed once
    named = lambda x, body: F.element_at(F.transform(F.array(x), body), 1)
    cut = lambda v: F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")), lambda b: F.slice(v, b * BLOCK + 1, F.lit(BLOCK)))
    grown = lambda block, start: F.aggregate(block, F.array(start), lambda s, x: F.concat(s, F.array(step(F.element_at(s, -1), x))))

    def whole(blocks):
        starts = grown(F.transform(blocks, lambda b: F.aggregate(b, zero, lambda s, x: step(s, x))), zero)
        return F.flatten(F.zip_with(F.slice(starts, F.lit(1), F.size(blocks)), blocks, lambda at, b: F.slice(grown(b, at), F.lit(2), F.size(b))))

    return F.when(F.size(values) > 0, named(values, lambda v: named(cut(v), whole)))


def places(pieces: Column, matches: Column) -> Column:
    """(start, end, match, before, after) of every match, from the pieces between them."""
    n = F.size(matches)
    last = F.concat(F.array(F.lit("")), matches)  # the match before
    both = F.arrays_zip(F.slice(pieces, F.lit(1), n).alias("gap"), matches.alias("match"), F.slice(last, F.lit(1), n).alias("last"),
                        F.slice(pieces, F.lit(2), n).alias("next"), F.slice(F.concat(matches, F.array(F.lit(""))), F.lit(2), n).alias("then"))
    seen = F.transform(both, lambda x: F.struct(
        (F.length(x["gap"]) + F.length(x["match"])).alias("step"), F.length(x["match"]).alias("size"), x["match"].alias("match"),
        F.right(F.concat(F.right(x["last"], F.lit(BEFORE)), F.right(x["gap"], F.lit(BEFORE))), F.lit(BEFORE)).alias("before"),
        F.left(F.concat(F.left(x["next"], F.lit(AFTER)), F.left(x["then"], F.lit(AFTER))), F.lit(AFTER)).alias("after")))
    # the array of one list stands for a name: its lambda sees it computed once
    spans = F.flatten(F.transform(F.array(seen), lambda list_: F.zip_with(
        list_, running(F.transform(list_, lambda x: x["step"]), F.lit(0), lambda s, x: s + x),
        lambda x, end: F.struct((end - x["size"]).alias("start"), end.alias("end"), x["match"].alias("match"), x["before"].alias("before"), x["after"].alias("after")))))
    return F.when(n > 0, spans).otherwise(F.array().cast(SPAN))


def without_overlaps(base: Column, more: Column) -> Column:
    """All spans (start, kind, end), ordered: those of ``base``, and of ``more`` what overlaps none of them."""
    own = lambda s: s["kind"] < len(BASE)
    reach = lambda list_: running(F.transform(list_, lambda s: F.when(own(s), s["end"]).otherwise(0)), F.lit(0), lambda s, x: F.greatest(s, x))
    far = 2**31 - 1
    ahead = lambda list_: F.reverse(running(F.reverse(F.transform(list_, lambda s: F.when(own(s), s["start"]).otherwise(far))), F.lit(far), lambda s, x: F.least(s, x)))
    # of a span: how far base spans up to it reach, and where the next one from it on begins
    free = F.flatten(F.transform(F.array(F.array_sort(F.concat(base, more))), lambda list_: F.transform(F.filter(
        F.arrays_zip(list_.alias("s"), reach(list_).alias("reach"), ahead(list_).alias("ahead")),
        lambda x: own(x["s"]) | ((x["reach"] <= x["s"]["start"]) & (x["ahead"] >= x["s"]["end"]))), lambda x: x["s"])))
    return F.when(F.size(more) > 0, free).otherwise(base)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    back = F.split(F.reverse(number), "")
    doubled = lambda x: F.when(x > 4, 2 * x - 9).otherwise(2 * x)
    total = F.aggregate(F.transform(back, lambda d, i: F.when(i % 2 == 1, doubled(d.try_cast("int"))).otherwise(d.try_cast("int"))),
                        F.lit(0), lambda s, d: s + F.coalesce(d, F.lit(0)))
    return total % 10 == 0


def octets(ip: Column) -> Column:
    return F.forall(F.split(ip, r"\."), lambda x: F.coalesce(x.try_cast("int") <= 255, F.lit(False)))


def passes(kind: Column, match: Column) -> Column:
    """Whether a match of a base kind passes its check."""
    n = F.length(digits(match))
    return (F.when(kind == 0, F.lit(True)).when(kind == 1, octets(match))
            .when(kind == 2, n.between(14, 19) & luhn(digits(match))).when(kind == 3, n.between(10, 15)).otherwise(F.lit(False)))


def votes(kind: Column, m: Column, before: Column, after: Column) -> Column:
    """The votes of the labelers: 1 personal, 0 not, -1 abstains."""
    yes, no, none = F.lit(1), F.lit(0), F.lit(-1)
    number = digits(m)
    n = F.length(number)
    form = (F.when(kind == 0, F.when(m.rlike(r"^[A-Za-z0-9].*[A-Za-z0-9]@[^@]{4,}$"), yes).otherwise(none))
            .when(kind == 1, F.when(m.rlike(r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$"), yes).otherwise(no))
            .when(kind == 2, F.when(m.rlike(r"^(?:[0-9]{4}[ -]){3}[0-9]{2,4}$|^[0-9]{14,16}$"), yes).when(n < 14, no).otherwise(none))
            .when(kind == 3, F.when(n.between(10, 13), yes).when(n < 8, no).otherwise(none))
            .when(kind == 4, F.when(m.rlike(r"^\([0-9]{3}\) |^[2-9][0-9]{2}-[2-9][0-9]{2}-"), yes).otherwise(none))
            .when(kind == 5, F.when(m.rlike("^(?:000|666|9)|-00-|0000$"), no).otherwise(yes))
            .when(kind == 8, F.when(m.rlike("(?i)example|change_?me|your|xxxx|\\.\\.\\.|placeholder"), no).when(m.rlike("[0-9]") & m.rlike("[A-Za-z]"), yes).otherwise(none))
            .when(kind == 7, yes).otherwise(none))
    check = (F.when(kind == 1, F.when(octets(m), yes).otherwise(no))
             .when(kind == 2, F.when(n.between(14, 19) & luhn(number), yes).otherwise(no))
             .when(kind == 3, F.when(n.between(10, 15), yes).otherwise(no))
             .when(kind == 8, F.when(F.size(F.array_distinct(F.split(F.regexp_replace(m, "^[^:=]*[:=]", ""), ""))) >= 10, yes).otherwise(no))
             .when(kind == 6, F.when(F.length(F.replace(m, F.lit(" "), F.lit(""))).between(15, 34), yes).otherwise(no)).otherwise(none))
    known = (F.when(kind.isin(0, 7), F.when(F.lower(F.regexp_extract(m, "([A-Za-z]+)$", 1)).isin(DOMAINS), yes).otherwise(no))
             .when(kind == 1, F.when(m.rlike(r"^(?:0|127|255|1\.2\.3|1\.1\.1\.1|2\.5|3\.)"), no).otherwise(yes))
             .when(kind == 2, F.when(number.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"), yes).otherwise(no))
             .when(kind == 3, F.when(m.rlike(r"^\+(?:1|3[0-469]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"), yes).otherwise(no))
             .when(kind == 8, F.when(m.rlike(ISSUED + "|PRIVATE KEY|[0-9a-f]{32}"), yes).otherwise(none))
             .when(kind == 6, F.when(F.substr(m, F.lit(1), F.lit(2)).isin(COUNTRIES), yes).otherwise(no)).otherwise(none))
    near = F.lower(before)
    word = F.when(near.rlike(rf"(?:^|[^a-z])(?:{FAR})\W*\w{{0,3}}\W*$"), no).when(near.rlike(rf"(?:{NEAR})"), yes).otherwise(none)
    edge = F.when(before.rlike("[A-Za-z0-9_/=]$") | after.rlike("^[A-Za-z0-9_=]"), no).otherwise(none)
    dull = F.when((n >= 8) & number.rlike(r"^([0-9])\1+$|^0?123456|^([0-9]{2,4})\2\2"), no).when(n >= 8, yes).otherwise(none)
    return F.array(form, check, known, word, edge, dull)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, found) of every row; found: kind, start, end, passes, votes, size and number of its kind."""
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    cut = texts
    for k, pattern in {**BASE, **MORE}.items():
        has = F.contains("text", F.lit("@")) if k == "email" else F.col("text").rlike(GATE[k])
        cut = cut.withColumn(f"m_{k}", F.when(has, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    for k, pattern in {**BASE, **MORE}.items():
        cut = cut.withColumn(f"p_{k}", F.when(F.size(f"m_{k}") > 0, F.split("text", pattern, -1)).otherwise(F.array().cast("array<string>")))
    spans = cut.select("id", *(places(F.col(f"p_{k}"), F.col(f"m_{k}")).alias(k) for k in KINDS))

    def judged(i, k):
        kind = F.lit(i)
        return F.transform(k, lambda c: F.struct(
            kind.alias("kind"), c["start"].alias("start"), c["end"].alias("end"), passes(kind, c["match"]).alias("passes"),
            votes(kind, c["match"], c["before"], c["after"]).alias("votes"),
            F.least(F.floor(F.length(c["match"]) / 8), F.lit(3)).cast("int").alias("size"), F.least(F.size(k), F.lit(3)).alias("many")))
    return spans.select("id", F.concat(*(judged(i, k) for i, k in enumerate(KINDS))).alias("found"))


def patterns(found: DataFrame) -> DataFrame:
    """How often each combination of kind, votes and features occurs (a bounded number of rows)."""
    each = found.select(F.explode("found").alias("c"))
    return each.groupBy("c.kind", "c.votes", "c.size", "c.many").agg(F.count(F.lit(1)).cast("double").alias("n"))


def posteriors(counted: DataFrame, steps: int = STEPS) -> DataFrame:
    """``counted`` with p, the probability of each pattern to be personal data, by EM. The rows
    (their number is bounded) are folded as one array; a step reads nothing else."""
    rows = F.col("rows")
    one = lambda x, v, a: F.when(v == 1, a).when(v == 0, 1 - a).otherwise(F.lit(1.0))

    def post(x, q):
        p1 = reduce(lambda s, j: s * one(x, x["votes"][j], q["a"][j]), range(LABELERS), q["prior"][x["kind"]])
        p0 = reduce(lambda s, j: s * one(x, x["votes"][j], q["b"][j]), range(LABELERS), 1 - q["prior"][x["kind"]])
        return p1 / (p1 + p0)

    def total(pairs, value):
        return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + value(x))

    def learn(p):
        pairs = F.zip_with(rows, p, lambda x, y: F.struct(x["kind"].alias("kind"), x["votes"].alias("votes"), (x["n"] * y).alias("one"), (x["n"] * (1 - y)).alias("zero")))

        def rate(pairs, j, side, first):
            hit = total(pairs, lambda x: F.when(x["votes"][j] == 1, x[side]).otherwise(0.0))
            all_ = total(pairs, lambda x: F.when(x["votes"][j] >= 0, x[side]).otherwise(0.0))
            return (hit + 10 * first) / (all_ + 10)
        # the array of one pair list stands for a name: its lambda sees it computed once
        return F.transform(F.array(pairs), lambda ps: F.struct(
            F.array(*((total(ps, lambda x, k=k: F.when(x["kind"] == k, x["one"]).otherwise(0.0)) + 5)
                      / (total(ps, lambda x, k=k: F.when(x["kind"] == k, x["one"] + x["zero"]).otherwise(0.0)) + 10) for k in range(len(KINDS)))).alias("prior"),
            F.array(*(rate(ps, j, "one", 0.8) for j in range(LABELERS))).alias("a"),
            F.array(*(rate(ps, j, "zero", 0.2) for j in range(LABELERS))).alias("b")))

    start = F.struct(F.array(*[F.lit(0.5)] * len(KINDS)).alias("prior"), F.array(*[F.lit(0.8)] * LABELERS).alias("a"), F.array(*[F.lit(0.2)] * LABELERS).alias("b"))
    expect = lambda q: F.flatten(F.transform(q, lambda t: F.transform(rows, lambda x: post(x, t))))
    p = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), expect(F.array(start)), lambda s, _: expect(learn(s)))
    whole = counted.agg(F.array_sort(F.collect_list(F.struct("kind", "votes", "size", "many", "n"))).alias("rows"))
    return whole.select(F.explode(F.arrays_zip(rows.alias("rows"), p.alias("p"))).alias("z")).select("z.rows.*", "z.p")


def features(c: Column) -> dict[str, Column]:
    """What the classifier sees of a span."""
    out = {f"kind{k}": (c["kind"] == k).cast("double") for k in range(len(KINDS))}
    for j in range(LABELERS):
        v = c["votes"][j]
        out[f"vote{j}"] = F.when(v == 1, 1.0).when(v == 0, -1.0).otherwise(0.0)
    out["size"], out["many"] = c["size"].cast("double"), c["many"].cast("double")
    return out


def train(found: DataFrame) -> tuple[list[float], float]:
    """(weights, intercept) of the span classifier."""
    labelled = stored(posteriors(patterns(found)).coalesce(1), "posteriors")
    if labelled.isEmpty():
        return [0.0] * (len(KINDS) + LABELERS + 2), -1.0
    rows = labelled.select(F.struct("*").alias("c"))
    named = features(F.col("c"))
    both = rows.select(*(v.alias(k) for k, v in named.items()), F.col("c.n").alias("n"), F.col("c.p").alias("p"))
    both = both.withColumn("y", F.explode(F.array(F.lit(1.0), F.lit(0.0)))).withColumn(
        "weight", F.col("n") * F.when(F.col("y") == 1, F.col("p")).otherwise(1 - F.col("p")) + 1e-6)
    data = VectorAssembler(inputCols=list(named), outputCol="x").transform(both).coalesce(1)
    model = LogisticRegression(featuresCol="x", labelCol="y", weightCol="weight", regParam=1e-3, maxIter=50, standardization=False).fit(data)
    return model.coefficients.toArray().tolist(), float(model.intercept)


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(id, base, all) of every row: arrays of (start, kind, end), ordered; kind indexes ``KINDS``."""
    found = stored(candidates(docs, id_col, text_col), "candidates")
    weights, intercept = train(found)

    def personal(c):
        z = reduce(lambda s, wf: s + wf[0] * wf[1], zip(weights, features(c).values()), F.lit(intercept))
        return 1 / (1 + F.exp(-z)) > threshold

    span = lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))
    base = F.array_sort(F.transform(F.filter("found", lambda c: c["passes"]), span))
    more = F.transform(F.filter("found", lambda c: (c["kind"] >= len(BASE)) & personal(c)), span)
    picked = found.select("id", base.alias("base"), more.alias("more"))
    return picked.select("id", "base", without_overlaps(F.col("base"), F.col("more")).alias("all"))


def count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")
