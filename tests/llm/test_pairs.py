"""SimHash near-duplicates, components and fingerprints."""

import hashlib
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tidewell.llm import components, fingerprints, simhash


def plain_simhash(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in words.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    return label


def words(rng, n):
    return " ".join(rng.choice(["tide", "well", "salt", "rope", "keel", "mast", "sail", "oar", "fog", "reef"]) + str(rng.randrange(40)) for _ in range(n))


def test_simhash_of_edge_texts(edges):
    for _, text in edges:
        if text is None or len(text) < 1000:
            assert simhash.simhash((text or "").encode()) == plain_simhash(text)


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = words(random.Random(1), 500).encode()
    whole = simhash.simhash(text)
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(simhash, "PIECE", size)
        assert simhash.simhash(text) == whole == plain_simhash(text.decode())
        assert simhash.simhash(b"a  b") == plain_simhash("a  b")


def test_components_against_brute_force(spark, make):
    rng, rows = random.Random(2), []
    for k in range(60):
        text = words(rng, 120)
        rows.append((len(rows), text))
        for _ in range(k % 4):
            parts = text.split()
            parts[rng.randrange(len(parts))] = "changed"
            rows.append((len(rows), " ".join(parts)))
    rows += [(len(rows) + i, t) for i, t in enumerate((None, "", " ", "x", "x"))]
    rng.shuffle(rows)
    prints = [plain_simhash(t) for _, t in rows]
    label = plain_components(prints)
    least = {c: min(i for (i, _), x in zip(rows, label) if x == c) for c in set(label)}
    want = sorted((i, f"{p:016x}", least[c]) for (i, _), p, c in zip(rows, prints, label))
    assert sorted(map(tuple, simhash.components(make(rows)).collect())) == want


def test_components_of_edges(spark, make, edges):
    got = simhash.components(make(edges)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i is None, i or 0) for i, _ in edges)
    by_id = {r.doc_id: r for r in got if r.doc_id}
    assert by_id[2].fingerprint == "0" * 16
    assert (by_id[5].component_id, by_id[4].component_id, by_id[3].component_id) == (4, 4, 1)
    assert simhash.components(make([])).collect() == []


def test_heavy_blocks_give_the_same_components(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 1 << 62))
    near = {centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in range(300)}
    far = {int(x) for x in rng.integers(0, 1 << 63, 200, np.uint64)}
    prints = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in near | far], "bits long")
    roots = lambda: {tuple(r) for r in components.star_forest(simhash.links(prints)).collect()}
    light = roots()
    monkeypatch.setattr(simhash, "HEAVY", 20)
    for tile, dealt in ((16, 16), (8, 64)):
        monkeypatch.setattr(simhash, "TILE", tile)
        monkeypatch.setattr(simhash, "DEALT", dealt)
        assert roots() == light
    assert len(light) == len(near) - 1


def test_tiles_against_all_pairs():
    rng = np.random.default_rng(4)
    bits = rng.integers(0, 1 << 10, 700, np.uint64)
    bits = bits[np.argsort(np.bitwise_count(bits), kind="stable")]
    for split in (None, 300):
        left, right = (bits, None) if split is None else (bits[:split], bits[split:])
        u, v = simhash.tile_links(left, right, 1)
        assert (np.bitwise_count(bits[u] ^ bits[v]) <= 64).all()
        a, b = np.nonzero(np.bitwise_count(bits[:, None] ^ bits[None]) <= 1)
        if split is not None:
            keep = (a < split) & (b >= split)
            a, b = a[keep], b[keep]
        tied = lambda x, y: dict(zip(*map(np.ndarray.tolist, simhash.forest(x, y, len(bits)))))
        assert tied(u, v) == tied(a, b)


def test_forest_of_a_long_path(spark):
    n = 200
    order = list(range(n))
    random.Random(5).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])) + [(500, 501), (7, 7)], "u long, v long")
    got = {r.u: r.v for r in components.star_forest(edges).collect()}
    assert got == {k: 0 for k in range(1, n)} | {501: 500}
    assert components.star_forest(edges.limit(0)).count() == 0


def test_one_of_each(spark, make):
    rows = [(3, "a b c d"), (1, "a b c d"), (2, "other words stand here"), (1, "a b c d"), (None, "lonely text of its own")]
    got = simhash.one_of_each(make(rows))
    assert got.columns == make(rows).columns
    assert sorted((r.doc_id or -1, r.text) for r in got.collect()) == [(-1, "lonely text of its own"), (1, "a b c d"), (2, "other words stand here")]


def test_rows_of_equal_ids_are_judged_by_their_texts(spark, make):
    rng = random.Random(12)
    t, u = words(rng, 60), words(rng, 60)
    for rows in ([(1, t), (5, t), (5, u)], [(5, u), (5, t), (1, t)]):
        assert sorted((r.doc_id, r.text) for r in simhash.one_of_each(make(rows)).collect()) == [(1, t), (5, u)]
    got = simhash.one_of_each(make([(None, None), (42, t), (None, t), (None, u), (None, ""), (7, " ")])).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted([(7, " "), (42, t), (None, u)], key=repr)
    clash = make([(2, t), (1, t)]).withColumn("first", F.lit(1)).withColumn("rank", F.lit(2)).withColumn("KEPT", F.lit(3)).withColumn("__own", F.lit(4))
    got = simhash.one_of_each(clash)
    assert got.columns == clash.columns and [r.doc_id for r in got.collect()] == [1]
    assert simhash.one_of_each(make([])).collect() == []


# --- fingerprints


def plain_edits(rows):
    hashed = lambda t: (x := xxhash.xxh64_intdigest((t or "").encode(), 42)) - (x >> 63 << 64)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -hashed(r[1])))
    out = []
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        out.append((i, len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, *r[1:])


def test_edited_texts(spark, make, edges):
    for rows in (edges, [(1, "alone here")], [(None, f"text {k}") for k in range(70)] + [(4, f"of equal id {k}") for k in range(70)], [(k * 7 % 101, f"text {k} " * (k % 5)) for k in range(100)]):
        got = fingerprints.edited_fingerprints(make(rows)).collect()
        assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=key) == sorted(plain_edits(rows), key=key)
    assert fingerprints.edited_fingerprints(make([])).collect() == []


def test_fingerprints_follow_the_texts(spark, make):
    rng = random.Random(6)
    rows = [(k, words(rng, 60)) for k in range(80)]
    rows += [(100 + k, t) for k, t in rows[:10]]
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(make(rows)).collect()}
    assert all(got[k].fingerprint == got[100 + k].fingerprint for k in range(10))
    assert len({r.fingerprint for r in got.values()}) == 80
    assert all(0 <= x <= 1 for r in got.values() for x in (r.near_edited, r.near_next))
    mean = lambda name: sum(r[name] for r in got.values()) / len(got)
    assert mean("near_edited") > mean("near_next")


def test_likeness(spark):
    df = spark.createDataFrame([(["a", "-", "c"], ["a", "-", "d"]), (["-"], ["-"]), (["a", "-"], ["-", "-"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(fingerprints.likeness(df.a, df.b)).collect()] == [0.5, 1.0, 0.0]


def test_the_lexicon_is_the_band(spark, make):
    rows = [(k, "everywhere " + ("often " if k % 8 == 0 else "") + f"only{k}") for k in range(40)]
    docs = make(rows)
    held = fingerprints.lexicon(docs)
    kept = docs.select("doc_id", fingerprints.in_lexicon(docs.text, held).alias("k")).collect()
    assert {len(r.k) for r in kept if r.doc_id % 8} == {1}
    assert {len(r.k) for r in kept if r.doc_id % 8 == 0} == {2}


def test_null_and_empty_texts_have_empty_parts(spark, make):
    got = fingerprints.fingerprints(make([(1, None), (2, ""), (3, "!!"), (4, "some words")])).select("doc_id", "subsets").collect()
    assert {tuple(set(r.subsets)) for r in got if r.doc_id < 4} == {(fingerprints.NONE,)}
    assert len({len(r.subsets) for r in got}) == 1


def test_copies_do_not_move_the_band(spark, make):
    rng = random.Random(7)
    rows = [(k, words(rng, 30)) for k in range(60)]
    plain = fingerprints.fingerprints(make(rows)).select("doc_id", "subsets")
    copied = make(rows + [(100 + k, rows[0][1]) for k in range(40)])
    want, got = ({r.doc_id: r.subsets for r in df.collect()} for df in (plain, fingerprints.fingerprints(copied).select("doc_id", "subsets")))
    assert {k: got[k] for k in want} == want
    assert all(got[100 + k] == want[0] for k in range(40))


def test_texts_without_band_terms_differ(spark, make):
    rows = [(k, f"tide well only{k}") for k in range(40)]
    held = fingerprints.lexicon(make(rows))
    others = make([(1, "salt rope keel"), (2, "mast sail oar"), (3, "salt rope keel"), (4, None), (5, "tide well")])
    got = {r.doc_id: r.subsets for r in fingerprints.fingerprints(others, lexicon_=held).collect()}
    assert got[1] == got[3] and set(got[4]) == {fingerprints.NONE}
    assert len({tuple(got[k]) for k in (1, 2, 4, 5)}) == 4
    df = spark.createDataFrame([(got[1], got[2]), (got[1], got[4]), (got[1], got[3])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(fingerprints.likeness(df.a, df.b)).collect()] == [0.0, 0.0, 1.0]
