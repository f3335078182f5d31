"""Source divergence against plain counting, with colliding digests too."""

import random
import re
from collections import Counter, defaultdict

import pytest

from orrery.llm import divergence

R = random.Random(11)
VOCAB = ["alpha", "Beta", "ÉTÉ", "été", "漢字", "x", "don't", "naïve", "Straße", "zz9z", *(f"w{chr(97 + i)}" for i in range(26))]


def prose(n):
    return " ".join(R.choice(VOCAB) for _ in range(n))


ROWS = [(i, prose(R.randrange(60)), R.choice(["en", "de", None]), R.choice(["a", "b", "ç", None]), 1, 2) for i in range(80)]
ROWS += [ROWS[3]] * 4 + [(None, None, "en", "silent", 1, 2), (900, "", "none", "only", 1, 2), (901, "unique " * 5, "few", "one", 0, 0),
         (902, "12 34 --", "few", "two", 0, 0), (903, "alpha " * 3000 + "Ω" * 3000, "de", "long", 0, 0)]
SCHEMA = "doc_id long, text string, lang string, source string, d long, gid long"


def plain(rows, least, most):
    docs = [(lang or "", src or "", [w.translate({c: c + 32 for c in range(65, 91)}) for w in
                                     re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")])
            for _, text, lang, src, *_ in rows]
    df, n, groups = defaultdict(Counter), defaultdict(Counter), sorted({d[:2] for d in docs})
    for lang, src, words in docs:
        df[lang].update(set(words))
        n[lang, src].update(words)
    out = []
    for lang, src in groups:
        kept = [t for t, c in df[lang].items() if c >= least]
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(n[g])

        def p(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        mine, all_p = p(n[lang, src]), p(whole)
        part = [(sum((mine[t] - q) ** 2 // q for t, q in p(n[lang, o]).items()), o)
                for g, o in groups if g == lang and o != src]
        part2 = [((mine[t] - all_p[t]) ** 2 // all_p[t], t) for t in kept if n[lang, src][t] and mine[t] > all_p[t]]
        for name, found, top in (("pair", part, None), ("term", part2, most)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, src, name, item, v, k + 1) for k, (v, item) in enumerate(found[:top])]
    return sorted(out)


@pytest.mark.parametrize("bits, tile, cells, held", [(64, 64, 100_000, 200_000), (4, 2, 30, 20)])
def test_report_matches_plain_counting(spark, monkeypatch, bits, tile, cells, held):
    for name, value in (("TILE", tile), ("CELLS", cells), ("HELD", held), ("PIECE", 100 if bits == 4 else 1 << 22)):
        monkeypatch.setattr(divergence, name, value)
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = divergence.report(divergence.audit(docs, 3, bits=bits), most=7)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain(ROWS, 3, 7)


def test_ties_reach_the_last_rank_by_text(spark):
    rows = [(i, "common " + f"t{chr(97 + i % 9)}x", "l", "ab"[i % 2], 0, 0) for i in range(90)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = divergence.report(divergence.audit(docs, 3), most=2)
    assert sorted(map(tuple, got.collect())) == plain(rows, 3, 2)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert divergence.report(divergence.audit(docs)).collect() == []


def test_counts_beyond_64_bits_of_product(spark):
    # 10^9 * count passes 2^63 from about 9.2e9 occurrences on
    got = spark.sql(f"SELECT {divergence._p('n', 't')} AS p FROM VALUES (20000000000L, 60000000000L, 5L) AS x(n, t, kinds)")
    assert got.first().p == 1 + 10**9 * (20_000_000_001) // (60_000_000_005)


def test_terms_of_a_piece_end_at_a_blank(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 3)
    assert divergence._count("Ab,Ab;abab ç".encode()) == Counter({b"ab": 2, b"abab": 1, "ç".encode(): 1})


def test_terms_come_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 10)
    text = ("Some words, in-a long TEXT 12 " * 20 + "x" * 50).encode()
    parts = list(divergence._parts(text))
    assert len(parts) > 10 and all(len(b" ".join(p)) < 60 for p in parts)
    assert [t for p in parts for t in p] == [b"some", b"words", b"in", b"a", b"long", b"text"] * 20 + [b"x" * 50]
    assert list(divergence._parts(b"")) == [] and divergence._count(text)[b"long"] == 20
