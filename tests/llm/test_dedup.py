"""SimHash, suffix dedup and decontamination against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from orrery.llm import bytehash, decontaminate, simhash, suffixdedup
from orrery.llm.common import components

random.seed(5)
WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "Eta", "théta", "iota", "kappa", "漢字", "mu-nu", "xi"]


def prose(n, seed=None):
    r = random.Random(seed) if seed is not None else random
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


BASE = prose(400, 1)
TEXTS = [None, "", " \t\n", "one", "two words", "Two words", BASE, BASE, BASE + " tail", "head " + BASE, prose(60, 2),
         prose(60, 2)[:200] + prose(50, 3), "ha " * 400, "ha " * 390, "é" * 300, "x" + "é" * 300, prose(9000, 4),
         prose(30, 6) + " " + prose(80, 7)[:230] + prose(20, 8), prose(80, 7), "ÀB" * 5]
ROWS = [(i, t, "en", "s", 7) for i, t in enumerate(TEXTS)] + [(6, BASE, "en", "s", 7), (None, BASE, None, None, None),
                                                            (None, "lonely text here " * 3, None, None, None)]
SCHEMA = "doc_id long, text string, id string, th string, kept int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(4)


# -- SimHash

def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps, ids, bits):
    root = list(range(len(fps)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(fps))]


def test_fingerprints_match_the_definition():
    for t in TEXTS:
        assert simhash.fingerprint((t or "").encode()) == plain_fingerprint(t)


@pytest.mark.parametrize("crowd", [32, 1])
def test_near_duplicates(spark, docs, crowd):
    got = simhash.near_duplicates(docs, crowd=crowd).collect()
    fps = [plain_fingerprint(r[1]) for r in ROWS]
    want = plain_components(fps, [r[0] for r in ROWS], 2)
    assert Counter(map(tuple, got)) == Counter((r[0], f"{f:016x}", c) for r, f, c in zip(ROWS, fps, want))


@pytest.mark.parametrize("bits,crowd", [(2, 3), (2, 1000), (1, 3), (0, 3)])
def test_links_keep_every_component(spark, bits, crowd):
    rng = random.Random(bits * 10 + crowd)
    center = rng.getrandbits(64)
    fps = {center}
    for _ in range(60):
        f = rng.choice(sorted(fps))
        for _ in range(rng.choice([1, 2, 3])):
            f ^= 1 << rng.randrange(64)
        fps.add(f)
    fps = sorted(fps | {rng.getrandbits(64) for _ in range(20)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    got = {r.node: r.root for r in components(simhash.links(df, bits, crowd)).collect()}
    want = plain_components(fps, signed, bits)
    assert [got.get(s, s) for s in signed] == want


def test_variants_are_not_broadcast(spark, monkeypatch):
    """Spark sizes the 64 rows that an explode makes of one as one row."""
    plans, cut = [], simhash.cut_lineage
    monkeypatch.setattr(simhash, "cut_lineage", lambda df, name: (plans.append(df), cut(df, name))[1])
    rows = [(int(f),) for f in np.random.default_rng(3).integers(0, 1 << 62, 50)]
    plans.append(simhash.links(spark.createDataFrame([*rows, (rows[0][0] ^ 3,)], "fp long")))
    assert plans[-1].count() == 1
    said = [df._jdf.queryExecution().sparkPlan().toString() for df in plans]
    assert ["SortMergeJoin" in x for x in said] == [True, True] and not any("BroadcastHashJoin" in x for x in said)


def test_one_row_of_each_group_stays(spark, docs):
    got = simhash.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    comp = plain_components([plain_fingerprint(r[1]) for r in ROWS], [r[0] for r in ROWS], 2)
    stay = Counter(r.doc_id for r in got.collect())
    assert stay == Counter({c: 1 for c in set(comp)})


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.drop_near_duplicates(none).count() == 0
    assert suffixdedup.remove_repeats(none).count() == 0
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.inspect(none, items).count() == 0


# -- suffix dedup

def plain_removed(rows, length):
    data = [(t or "").encode() for t in rows]
    seen = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for x in bytes(gone).split(b"\0") if x)
        out.append((len(b), sum(gone), runs, kept))
    return out


@pytest.mark.parametrize("length,crowd", [(200, 2000), (200, 1), (48, 2000), (48, 1)])
def test_repeats_match_brute_force(spark, docs, length, crowd):
    got = suffixdedup.remove_repeats(docs, length, crowd)
    assert got.columns == [c for c in docs.columns if c != "kept"] + ["n_bytes", "n_removed", "n_spans", "kept"]
    want = plain_removed([r[1] for r in ROWS], length)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()) == Counter(
        (r[0], *w) for r, w in zip(ROWS, want))


def test_copies_share_one_list_of_ranges(spark):
    # repeats that end inside the texts, so that the copies' spans are also wanted for sorting
    rows = [(3, BASE)] * 30 + [(None, BASE)] * 30 + [(4, "other " + BASE[100:1500] + prose(40, 11))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    lists, _ = suffixdedup.repeats(df)
    assert all(len(r.found) == len({(x.lo, x.hi) for x in r.found}) for r in lists.collect())
    keys = suffixdedup.keyed(df, "doc_id", "text")
    wanted = keys.selectExpr("k1", "k2", "1L AS cls", "2L AS span", "0L AS at", "false AS single", "false AS crowded")
    assert suffixdedup._contexts(keys, wanted, 200).count() == 3
    got = suffixdedup.remove_repeats(df).collect()
    want = plain_removed([t for _, t in rows], 200)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == Counter(
        (i, *w) for (i, _), w in zip(rows, want))


def test_long_text_is_cut_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "PIECE", 700)
    rows = [t.encode() for t in (BASE, "xyz" + BASE, prose(300, 9) + BASE[500:1500] + prose(40, 10))]
    spans = []
    for buf, first, last, row, base in suffixdedup.pieces(rows, 200):
        p, lo, hi, part, cls, span = suffixdedup.windows_by_anchor(buf, first, last, 200)
        assert (hi - lo < suffixdedup.V * 64).all() and (p >= lo).all() and (p <= hi + 200).all()
        spans += [(int(row[k]), int(a - first[k] + base[k]), int(b - first[k] + base[k]))
                  for k, a, b in zip(part, lo, hi)]
    for r, t in enumerate(rows):  # every window is in one span
        assert sorted(w for k, a, b in spans if k == r for w in range(a, b + 1)) == list(range(len(t) - 199))


def test_difference_cover():
    d = suffixdedup.COVER.tolist()
    assert {(a - b) % suffixdedup.V for a in d for b in d} == set(range(suffixdedup.V))


def test_sample_ranks_are_those_of_sorted_suffixes():
    rng = np.random.default_rng(0)
    buf = np.r_[rng.integers(97, 99, 3000), np.tile([97, 98], 300)].astype(np.uint8)
    buf = np.r_[buf, np.zeros(600, np.uint8)]
    member = np.isin(np.arange(len(buf) - 64) % suffixdedup.V, suffixdedup.COVER)
    places = np.flatnonzero(member)
    rank = suffixdedup.sample_ranks(buf, places, 256)
    data = buf.tobytes()
    some = rng.choice(len(places) - 60, 200)
    for a, b in zip(some[:-1], some[1:]):
        x, y = (data[places[k]:places[k] + 256] for k in (a, b))
        assert (x < y) == (rank[a] < rank[b]) and (x == y) == (rank[a] == rank[b])


# -- decontamination

ITEMS = [(1, prose(14, 20)), (2, "short item"), (2, "short item"), (3, ""), (4, None), (10, prose(60, 2)[:150]),
         (None, prose(12, 21)), (5, prose(14, 20))]
SUSPECTS = [None, "", prose(14, 20), "x " + prose(14, 20).upper() + " y", "a short, item!", prose(9, 20), prose(60, 2),
            prose(12, 21) + " " + prose(12, 21), prose(30, 22), "short\nitem short item"]


def plain_words(t):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())


def plain_inspect(text, items, window):
    w = plain_words(text)
    hit, names = set(), set()
    for item, t in items:
        q = plain_words(t)
        n = min(window, len(q))
        wins = {tuple(q[i:i + n]) for i in range(len(q) - n + 1)} if q else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in wins:
                hit.update(range(i, i + n))
                names.add("null" if item is None else str(item))
    return len(w), len(hit), sorted(names)


@pytest.mark.parametrize("window,block", [(10, 1 << 22), (10, 64), (3, 64)])
def test_windows_match_brute_force(spark, monkeypatch, window, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame([(i, t, -1) for i, t in enumerate(SUSPECTS)], "doc_id long, text string, n_hit int")
    got = {r.doc_id: r for r in decontaminate.inspect(docs, items, window).collect()}
    for i, t in enumerate(SUSPECTS):
        assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == plain_inspect(t, ITEMS, window), t
        for m in got[i].matches:  # each match is verbatim, and can't be continued
            q = plain_words(next(x for k, x in ITEMS if ("null" if k is None else str(k)) == m["item"]))
            w = plain_words(t)
            a, b, n = m["item_word"], m["doc_word"], m["words"]
            assert q[a:a + n] == w[b:b + n] and n >= min(window, len(q))
            assert a + n == len(q) or b + n == len(w) or q[a + n] != w[b + n]
    left = decontaminate.clean(docs.drop("n_hit"), items, window)
    assert left.columns == ["doc_id", "text"]
    assert {r.doc_id for r in left.collect()} == {i for i, t in enumerate(SUSPECTS) if not plain_inspect(t, ITEMS, window)[1]}


def test_word_hashes_do_not_depend_on_the_chunk(monkeypatch):
    data = np.frombuffer((prose(500, 30) + " " + "y" * 300 + " z").encode(), np.uint8)
    whole = bytehash.words(data, decontaminate.FOLD, decontaminate.MEMBER)
    monkeypatch.setattr(bytehash, "CHUNK", 100)
    for a, b in zip(whole, bytehash.words(data, decontaminate.FOLD, decontaminate.MEMBER)):
        assert (a == b).all()
    assert hashlib.sha256(b"1,2").hexdigest() == decontaminate.digest(["1", "2"])


# -- long words, clashing names, tables kept in workers

def thue_morse(n):
    return bytes(97 + bin(i).count("1") % 2 for i in range(n))


@pytest.mark.parametrize("n", [1024, 4096, 70_000])
def test_long_words_of_equal_sums_are_told_apart(spark, n):
    a = thue_morse(n)
    b = bytes(195 - c for c in a)  # the same with a and b exchanged
    flat = np.frombuffer(a + b" " + b, np.uint8)
    member = np.zeros(256, bool)
    member[97:123] = True
    assert len(set(bytehash.words(flat, np.arange(256, dtype=np.uint8), member)[2].tolist())) == 2
    docs = spark.createDataFrame([(1, a.decode()), (2, "x " + b.decode() + " y")], "doc_id long, text string")
    items = spark.createDataFrame([("i", b.decode())], "item_id string, text string")
    assert {r.doc_id: r.n_hit for r in decontaminate.inspect(docs, items, 10).collect()} == {1: 0, 2: 1}


def test_filters_keep_columns_of_any_name(spark):
    from orrery.llm import langid
    rows = [(1, "the cat sat on the mat and the dog", "en", 0.5, "m", "i", 3), (2, "42 --", "en", 0.5, "m", "i", 4),
            (3, "le chat et le chien sont sur la table", "fr", 0.1, "m", "i", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, mixture string, items string, N_hit int")
    model = langid.train(docs.where("doc_id <> 2"))
    known = langid.keep_known(docs, model)
    assert known.columns == docs.columns and sorted(map(tuple, known.collect())) == [rows[0], rows[2]]
    items = spark.createDataFrame([("i", "sat on the mat")], "item_id string, text string")
    left = decontaminate.clean(docs, items, 10)
    assert left.columns == docs.columns and sorted(map(tuple, left.collect())) == rows[1:]


def test_workers_let_go_of_other_tables():
    from orrery.llm import common
    mine, other = common.kept("a", {1: 2}), common.kept("b", {3: 4})
    common.let_go("a")
    assert mine == {1: 2} and other == {}
