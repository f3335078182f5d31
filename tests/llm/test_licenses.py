"""License scan against counting every block of every text."""

import random
import re
from fractions import Fraction

import numpy as np
import pytest

from orrery.llm import licenses

R = random.Random(13)
MIT = dict(licenses.TEMPLATES)["mit"]


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(doc_id, text, phrases, templates, least):
    w = split(text)
    base = [(i, label) for label, p in phrases for i in range(len(w)) if w[i:i + len(split(p))] == split(p)]
    labels, best = {x for _, x in base}, Fraction(0)
    for label, body in templates:
        t = split(body)
        win = 1
        while win < 2 * len(t):
            win *= 2
        for at in range(0, max(len(w), 1), win // 2):
            share = Fraction(len(set(w[at:at + win]) & set(t)), len(set(t)))
            if share >= Fraction(str(least)):
                labels.add(label)
                best = max(best, share)
    at = [i for i, _ in base]
    return (doc_id, len(w), len(base), min(at, default=None), max(at, default=None), sorted({x for _, x in base}),
            sorted(labels), 1.0 if base else float(best))


def key(row):
    return tuple((v is None, v) for v in row)


def worn(text, share):
    """The text without some of its words, with others between."""
    out = []
    for w in text.split():
        if R.random() < share:
            out.append(w)
        if R.random() < .15:
            out.append(R.choice(["filler", "the", "any", "ß"]))
    return " ".join(out)


def rows():
    out = [(1, None), (2, ""), (3, " ,;\n"), (4, "MIT-License; the mit\tlicense."), (5, "mit licensed"), (6, "mitlicense mit  LICENSE"),
           (7, MIT), (7, MIT), (None, "Apache License mit license"), (8, "ÉMIT LICENSE"), (9, "word " * 300_000 + MIT),
           (10, "apache license " * 9), (11, "GNU General Public License, version 3"), (12, "licensed under CC BY 4.0")]
    for k in range(120):
        body = R.choice(licenses.TEMPLATES)[1]
        lead = " ".join(R.choice(["lorem", "of", "the", "software", "Ipsum"]) for _ in range(R.randrange(90)))
        out.append((100 + k, lead + " " + worn(body, R.choice([.7, .8, .85, .95])) + " " + lead))
    return out


@pytest.mark.parametrize("least", [0.8, 0.5])
def test_scan_matches_plain_counting(spark, least):
    data = rows()
    docs = spark.createDataFrame([(i, t, "x") for i, t in data], "doc_id long, text string, word string").repartition(3)
    got = licenses.scan(docs, least=least)
    want = sorted((plain(i, t, licenses.PHRASES, licenses.TEMPLATES, least) for i, t in data), key=key)
    assert sorted(map(tuple, got.drop("matches").collect()), key=key) == want
    hit = {tuple(r.labels) for r in got.where("n_base = 0").collect()}
    assert ("mit",) in hit and () in hit
    assert licenses.scan(docs.limit(0)).collect() == []


def test_matches_say_where(spark):
    text = "one two three " + MIT + " four"
    m = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().matches
    assert m and all(x.label == "mit" and x.start >= 3 and x.end <= len(split(text)) - 2 for x in m)
    assert max(x.share for x in m) == 1.0


def test_filters_lose_no_block():
    ready = licenses.prepare([("a", "k l m n o p q r s t"), ("b", "a b c d k l")], 0.6)
    known = sorted({w for t in ready for w in t.words})
    for _ in range(400):
        n = R.randrange(1, 90)
        text = [R.choice(known + [b"-"] * 12) for _ in range(n)]
        index = licenses.Index(ready, known, {k: R.randrange(9) for k in range(len(known))})
        place = np.array([i for i, w in enumerate(text) if w != b"-"], np.int64)
        word = np.array([known.index(w) for w in text if w != b"-"], np.int64)
        got = sorted((m[0], m[3]) for m in index.matches(place, word))
        want = []
        for t in ready:
            for at in range(0, n, t.window // 2):
                have = len(set(text[at:at + t.window]) & t.words)
                if have >= t.need:
                    want.append((t.label, have / len(t.words)))
        assert got == sorted(want)


def test_pieces_keep_words_and_places(spark, monkeypatch):
    monkeypatch.setattr(licenses, "CUT", 5)
    assert [w for part in licenses.words("Aé-b 12c,,d efghijkl m".encode()) for w in part] == [
        "aé".encode(), b"b", b"12c", b"d", b"efghijkl", b"m"]


def test_templates_have_words():
    with pytest.raises(ValueError):
        licenses.prepare([("none", " - ")])
    with pytest.raises(ValueError):
        licenses.prepare([("big", " ".join(f"w{k}" for k in range(licenses.MOST_WORDS + 1)))])
