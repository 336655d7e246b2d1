"""Benchmark decontamination against a version on plain strings, without hashes, filters or joins."""

import collections
import random
import re

from graustein.llm import decontaminate

SMALL = "/root/testdata/sf0.001"
TOKEN = re.compile("(?:[0-9A-Za-z\x80-\xff]|(?<=[0-9])[.,](?=[0-9]))+")
CAPITAL = re.compile("[A-Z][a-z\x80-\xff]|\xc3[\x80-\x9e](?:$|[a-z\x80-\xff])")
APART = re.compile("[^0-9A-Za-z\x80-\xff]")


def lower(word: str) -> str:
    """Words are UTF-8 bytes read as Latin-1."""
    word = re.sub("[A-Z]", lambda m: m[0].lower(), word)
    return re.sub("\xc3([\x80-\x96\x98-\x9e])", lambda m: "\xc3" + chr(ord(m[1]) + 32), word)


def has_edge(text: str, start: int, end: int) -> bool:
    return any(c in ".!?:\n;\r\t\"()[]{}|<>*#" or (c == "'" and (
        i in (0, len(text) - 1) or APART.match(text[i - 1]) or APART.match(text[i + 1]))) for i, c in enumerate(text[start:end], start))


def tokens(text: str | None, names: bool) -> list[dict]:
    text = (text or "").encode().decode("latin-1")
    out, last, kind = [], 0, None
    for n, m in enumerate(TOKEN.finditer(text)):
        word, before = lower(m[0]), kind
        opens = n == 0 or any(c in ".!?:\n" for c in text[last:m.start()])
        kind = "name" if names and CAPITAL.match(m[0]) and not opens else "literal"
        if m[0][0].isascii() and m[0][0].isdigit():
            kind = "number"
        elif n and before == "number" and m.start() - last <= 1 and word in decontaminate.UNITS:
            kind = "unit"
        begins = n == 0 or has_edge(text, last, m.start())
        if out:
            out[-1]["closes"] = begins
        if kind == before == "name":
            out[-1]["whole"] += (word,)
        else:
            out.append({"kind": kind, "value": word, "whole": (word,), "opens": begins, "closes": True})
        last = m.end()
    if out:
        out[-1]["closes"] = True
    return out


def windows(toks: list[dict], length: int):
    """(place, key, exact, slots) of a text's windows of ``length``."""
    for at in range(len(toks) - length + 1):
        w = toks[at:at + length]
        exact = sum(t["kind"] == "literal" for t in w) < 4
        if exact and length < 8 and not (w[0]["opens"] and w[-1]["closes"]):
            continue
        key = tuple(t["whole"] if exact else t["value"] if t["kind"] == "literal" else (t["kind"],) for t in w)
        yield at, (exact, key), exact, tuple(None if t["kind"] == "literal" else t["value"] for t in w)


def leaks(docs: dict, items: dict) -> dict:
    """{(document, item): (coverage, reparameterised)}."""
    asked, total, index = {}, {}, collections.defaultdict(list)
    for item, text in items.items():
        for names in (True, False):
            toks = tokens(text, names)
            length = min(len(toks), 8)
            asked[item, names] = list(windows(toks, length)) if length else []
            total[item, names] = len(asked[item, names]), sum(not w[2] for w in asked[item, names])
            for at, key, exact, slots in asked[item, names]:
                index[names, length, key].append((item, at, exact, slots))
    lengths = sorted({length for _, length, _ in index})
    found = {}
    for doc, text in docs.items():
        lines = collections.defaultdict(list)
        for names in (True, False):
            toks = tokens(text, names)
            for length in lengths:
                for place, key, _, theirs in windows(toks, length):
                    for item, at, exact, slots in index.get((names, length, key), ()):
                        lines[item, names, place - at, exact].append((at, slots, theirs))
        good = collections.defaultdict(list)
        for (item, names, _, exact), met in lines.items():
            values = collections.defaultdict(set)
            for _, slots, theirs in met:
                for a, b in zip(slots, theirs):
                    if a is not None:
                        values[a].add(b)
            if not values or sum(len(v) == 1 for v in values.values()) >= 0.8 * len(values):
                good[item, names].append((exact, {at for at, _, _ in met}, all(v == {a} for a, v in values.items())))
        for (item, names), runs in good.items():
            n, loose = total[item, names]
            template = set().union(*(p for exact, p, _ in runs if not exact))
            part = max(len(template) / loose if loose else 0.0, len(set().union(*(p for _, p, _ in runs))) / n)
            same = max((s for exact, _, s in runs if not exact), default=True)
            if part >= 0.3:
                found[doc, item] = max(found.get((doc, item), (0.0, False)), (part, same))
    return {k: (part, not same) for k, (part, same) in found.items()}


def compared(spark, docs: dict, items: dict) -> dict:
    """What ``leaks`` of the library finds, after comparing it with the plain version."""
    got = decontaminate.leaks(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3),
                              spark.createDataFrame(list(items.items()), "item_id long, text string"))
    got = {(r["id"], r["item"]): (round(r["coverage"], 9), r["reparameterised"]) for r in got.collect()}
    assert got == {k: (round(part, 9), other) for k, (part, other) in leaks(docs, items).items()}
    return got


def changed(rng, text: str) -> str:
    """A copy with other numbers, names or case, cut, or with words put in."""
    words = text.split(" ")
    at = rng.randrange(len(words))
    return rng.choice([
        lambda: text, text.lower, text.upper, text.title, lambda: re.sub("[0-9]+", lambda m: str(rng.randrange(1000)), text),
        lambda: re.sub("(?<= )[A-Z][a-z]+", lambda m: rng.choice(["Oslo", "Ada Holm", "Émile"]), text),
        lambda: " ".join(words[:at + 1]), lambda: " ".join(words[at:]), lambda: " ".join([*words[:at], "and", "so", *words[at:]]),
        lambda: text.replace(" ", "  "), lambda: text.replace(" ", "\n", 3)])()


def test_random_texts_agree_with_plain_version(spark):
    rng = random.Random(5)
    vocabulary = "the a of what how many does it take if buys and costs then Anna Bob Émile Oslo 5 12 3.5 1,000 7 kg km hours Élan it's 'so' don't (or) is".split()
    sentence = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" "] * 8 + [". ", "? ", ", ", "\n", ": "]) for _ in range(n))
    items = {i: sentence(rng.choice([1, 2, 4, 7, 8, 9, 12, 20, 30])) for i in range(120)}
    items |= {120: None, 121: "", 122: " .,!", 123: items[7], 124: "12 13 14 15 16 17 18 19 20", 125: "'", 126: "Ë"}
    docs = {}
    for i in range(300):
        held = [changed(rng, items[rng.randrange(120)]) for _ in range(rng.randrange(3))]
        docs[i] = rng.choice(["", "\n", ". ", " "]).join(x for h in held for x in (sentence(rng.randrange(15)), h)) + sentence(rng.randrange(10))
    docs |= {300: None, 301: "", 302: "'", 303: " \x00 ", 304: docs[1], 305: items[124]}
    got = compared(spark, docs, items)
    assert len(got) > 200 and len({other for _, other in got.values()}) == 2
    assert any(part < 1 for part, _ in got.values())


def test_given_tables_agree_with_plain_version(spark):
    rng = random.Random(6)
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    docs |= {10**6 + n: f"Some words before. {changed(rng, text)} And some after." for n, text in enumerate(items.values())}
    assert len(compared(spark, docs, items)) >= len(items) // 2
