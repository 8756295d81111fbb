"""Language, quality, mixing, token stores, archives and the pipeline."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewell.llm import language, mixing, quality, queries, tokens, warc

# --- language


def plain_path(scores, switch):
    value, back = scores[0].astype(float), []
    for row in scores[1:]:
        ways = value[:, None] - switch * (1 - np.eye(len(value)))
        back.append(ways.argmax(axis=0))
        value = ways.max(axis=0) + row
    return value.max()


def path_score(scores, path, switch):
    return sum(scores[t, k] for t, k in enumerate(path)) - switch * int((np.diff(path) != 0).sum())


@pytest.mark.parametrize("states", [1, 2, 5])
def test_paths_are_best(states):
    rng = np.random.default_rng(1)
    lengths = np.array([0, 1, 63, 64, 65, 128, 300, 0, 5])
    scores = rng.normal(0, 3, (lengths.sum(), states)).astype(np.float32)
    path, at = language.best_paths(scores, lengths, 2.0), 0
    for n in lengths:
        if n:
            own = scores[at : at + n].astype(float)
            assert abs(plain_path(own, 2.0) - path_score(own, path[at : at + n], 2.0)) < 1e-3
        at += n


def test_many_languages_and_long_texts(monkeypatch):
    rng = np.random.default_rng(3)
    scores = np.zeros((40, 300), np.float32)
    scores[:, 299] = 5
    assert language.best_paths(scores, np.array([40]), 2.0).tolist() == [299] * 40
    lengths = np.array([70, 1, 0, 400, 63])
    for states in (1, 3, 9, 300):
        scores = rng.normal(0, 3, (lengths.sum(), states)).astype(np.float32)
        whole = language.best_paths(scores, lengths, 2.0)
        for size in (1, 1 << 14, 1 << 20):
            monkeypatch.setattr(language, "TABLE_BYTES", size)
            path, at = language.best_paths(scores, lengths, 2.0), 0
            for n in lengths:
                own = scores[at : at + n].astype(float)
                assert not n or abs(path_score(own, path[at : at + n], 2.0) - path_score(own, whole[at : at + n], 2.0)) < 1e-3
                at += n
        monkeypatch.undo()


SAID = {
    "en": "the and of to in that is was for with thing there would about people",
    "de": "der die und das ist nicht mit für über schön Straße zwischen werden",
    "ru": "и в не на что это как по его она был человек время",
    "el": "και το να είναι στο για με που από άνθρωπος",
}


def spoken(rng, lang, n):
    return " ".join(rng.choice(SAID[lang].split()) for _ in range(n))


def language_rows():
    rng = random.Random(2)
    return [(k, spoken(rng, lang, 30), lang, None) for k, lang in enumerate(list(SAID) * 30)]


def test_held_out_languages(spark, make):
    rows = language_rows()
    got = {r.doc_id: r for r in language.cross_fitted(make(rows)).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in rows)
    right = [got[i].lang_pred == lang for i, _, lang, _ in rows if got[i].held_out]
    assert right and sum(right) / len(right) > 0.98


def test_spans_of_mixed_texts(spark, make):
    rng = random.Random(3)
    parts = [spoken(rng, "en", 25), spoken(rng, "ru", 25), spoken(rng, "de", 25)]
    text = " ".join(parts)
    model = language.fit(make(language_rows()))
    row = language.identify(make([(1, text)]), model).head()
    assert [s.lang for s in row.spans] == ["en", "ru", "de"]
    assert abs(row.spans[0].end - len(parts[0])) <= 12
    assert (row.spans[0].start, row.spans[-1].end) == (0, len(text))
    assert 0.25 < row.score < 0.55


def test_languages_of_edges(spark, make, edges):
    rows = [(i, t) for i, t in edges] + [(40, "½ ² 123 _"), (41, "İSTANBUL ǅ")]
    got = language.identify(make(rows), language.fit(make(language_rows()))).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id}
    assert all((by[i].lang_pred, by[i].score, by[i].spans) == ("und", 0.0, []) for i in (1, 2, 3, 8, 40))
    assert all(0 < by[i].score <= 1 for i in (4, 6, 7, 41))
    assert {r.lang_pred for r in language.identify(make(rows), None).collect()} == {"und"}
    assert language.cross_fitted(make([])).collect() == []
    assert language.fit(make([(1, "text"), (2, None, "en", None)])) is None


def test_a_single_word_of_one_letter(spark, make):
    """It has no n-gram of four characters, alone or among others, whether a text is fitted on or scored."""
    among, alone = (language.ngrams(w) for w in (["b", "a", "cd"], ["a"]))
    assert sorted(alone[0]) == sorted(among[0][among[1] == 1])
    model = language.fit(make([*language_rows(), (1000, "a", "en"), (1001, "ø", "de")]))
    assert np.array_equal(model.score(["a"]), model.score(["b", "a", "cd"])[1:2])
    got = language.identify(make([(1, "x")]), model).collect()
    assert [(r.doc_id, r.score, [tuple(s)[:2] for s in r.spans]) for r in got] == [(1, 1.0, [(0, 1)])]


def test_untaught_scripts_are_no_language(spark, make):
    rng = random.Random(5)
    foreign = " ".join("".join(chr(0x0905 + rng.randrange(30)) for _ in range(5)) for _ in range(30))
    rows = [(2000, foreign), (2001, foreign + " " + spoken(rng, "de", 60)), (2002, spoken(rng, "en", 30))]
    got = {r.doc_id: r for r in language.identify(make(rows), language.fit(make(language_rows()))).collect()}
    assert got[2000].score == 0 and got[2001].lang_pred == "de" and 0.4 < got[2001].score < 0.9 and got[2002].score == 1
    kept = language.known_documents(make(language_rows() + rows)).filter("doc_id >= 2000").collect()
    assert sorted(r.doc_id for r in kept) == [2001, 2002]


def test_known_documents_of_edges(spark, make, edges):
    rows = [(k + 1000, *r) for k, *r in language_rows()] + edges + edges
    got = Counter(r.doc_id for r in language.known_documents(make(rows)).collect() if r.doc_id is None or r.doc_id < 1000)
    assert not got.keys() & {1, 2, 3, 8} and got[None] == 2
    assert language.known_documents(make([])).collect() == []
    assert language.known_documents(make([(1, "no label here"), (2, None)])).collect() == []


def test_known_documents_keep_their_columns(spark, make):
    rows = language_rows() + [(1000, None), (1001, "123 !!")]
    got = language.known_documents(make(rows))
    assert got.columns == make(rows).columns
    assert sorted(r.doc_id for r in got.collect()) == [r[0] for r in rows[:-2]]


# --- quality


def quality_rows():
    rng, rows = random.Random(4), []
    word = lambda: "".join(rng.choice(["tide", "well", "er", "an", "is", "o", "ra", "men", "ti", "sol", "ka", "lun"]) for _ in range(rng.randrange(1, 4)))
    for k in range(240):
        words = [rng.choice([word(), word(), word(), word(), word(), rng.choice(["the", "of", "and", "is"])]) for _ in range(60)]
        if k % 6 == 0:
            rows.append((k, " ".join(w + rng.choice(["***", "###", "$$"]) for w in words), 0))
        elif k % 6 == 1:
            rows.append((k, " ".join([words[0]] * 60), 0))
        else:
            rows.append((k, ". ".join(" ".join(words[i : i + 8]).capitalize() for i in range(0, 60, 8)) + ".", 1))
    return rows


def test_weak_labels_find_the_junk(spark, make):
    rows = quality_rows()
    got = {r.doc_id: r for r in quality.classify(make([r[:2] for r in rows])).collect()}
    assert sum(got[i].keep == bool(q) for i, _, q in rows) / len(rows) > 0.97
    assert sum((got[i].weak_label > 0.5) == bool(q) for i, _, q in rows) / len(rows) > 0.97


def test_quality_of_edges(spark, make, edges):
    rows = edges + [(50 + k, f"You utter scoundrel, the tide is of the sea {k}.") for k in range(9)] + [(70 + k, f"The tide is of the sea {k}.") for k in range(9)]
    labels = spark.createDataFrame([(50 + k, 1) for k in range(9)] + [(70 + k, 0) for k in range(9)] + [(None, 1), (4, None)], "doc_id long, toxic int")
    assert not any(r.toxic for r in quality.classify(make(rows)).collect())
    got = quality.classify(make(rows), labels=labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id}
    assert all((by[i].quality, by[i].keep) == (0.0, False) for i in (1, 2, 3))
    assert by[50].toxic and not by[50].keep
    assert quality.classify(make([])).collect() == []


def test_toxic_terms_are_learned_and_measured_by_share(spark, make):
    rng = random.Random(8)
    plain = lambda n: [rng.choice(["mer", "quai", "phare", "port", "sel", "voile"]) + str(rng.randrange(90)) for _ in range(n)]
    rows = [(k, " ".join(plain(40) + ["vilain" + rng.choice("abcdefgh") for _ in range(4 * (k % 3 == 0))])) for k in range(120)]
    rows += [(500, " ".join(plain(40) + ["vilainz"] * 4)), (501, " ".join(plain(2000) + ["trash"])), (502, "")]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(120)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in quality.classify(make(rows), labels=labels).collect()}
    assert all(got[k].toxic == (k % 3 == 0) for k in range(120))
    assert got[500].toxic and not got[501].toxic and not got[502].toxic


def test_the_scorer_agrees_with_the_labels(spark, sample):
    docs, labels = (spark.read.parquet(f"{sample}/{n}.parquet") for n in ("documents", "labels"))
    got = quality.classify(docs, labels=labels).join(labels.select("doc_id", F.col("quality").alias("good")), "doc_id").collect()
    assert len(got) > 50 and sum((r.quality >= quality.KEEP_SCORE) == bool(r.good) for r in got) / len(got) > 0.97


def test_posteriors_are_bayes():
    rng = np.random.default_rng(6)
    seen, table = rng.integers(0, 3, (50, 4)), rng.uniform(0.05, 0.95, (4, 2, 2))
    for row, got in zip(seen, quality.posterior(seen, 0.6, table)):
        like = [np.prod([table[j, c, v] for j, v in enumerate(row) if v < 2]) for c in (0, 1)]
        assert abs(got - 0.6 * like[1] / (0.6 * like[1] + 0.4 * like[0])) < 1e-9


def test_estimates_of_known_labellers():
    rng = np.random.default_rng(5)
    truth, right = rng.random(4000) < 0.7, (0.95, 0.8, 0.7, 0.9)
    seen = np.stack([np.where(rng.random(4000) < 0.2, quality.NONE, np.where(rng.random(4000) < p, truth, ~truth)) for p in right], axis=1).astype(int)
    patterns, place, counts = np.unique(seen, axis=0, return_inverse=True, return_counts=True)
    share, table, post = quality.estimate(patterns, counts.astype(float))
    assert abs(share - 0.7) < 0.06
    assert all(abs(table[j, c, c] - p) < 0.06 for j, p in enumerate(right) for c in (0, 1))
    assert ((post[place] > 0.5) == truth).mean() > 0.93


# --- mixing


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        over = sum(weight[s] for s in free)
        given = {s: (total - sum(fixed.values())) * weight[s] / over for s in free} if over else {}
        above = [s for s in free if given[s] > most * sizes[s]]
        if not above:
            return fixed | given
        fixed |= {s: most * sizes[s] for s in above}


def mixed_rows():
    rng = random.Random(6)
    rows = [(k, "w " * rng.randrange(1, 40), None, rng.choice(["b", "b", "b", "b", "é", "a", "Z", None])) for k in range(400)]
    return rows + [(400, None, None, "b"), (401, " \t", None, "empty"), (402, "tiny", None, "tiny"), (5, "w w", None, "a")]


def test_mix(spark, make):
    rows = mixed_rows()
    got = mixing.mix(make(rows)).collect()
    size = lambda t: len((t or "").split())
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += size(t)
    want = plain_targets(dict(sizes))
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, size(t)) for i, t, _, _ in rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6
        assert (r.copies - 1) * r["size"] < r.taken <= r.copies * r["size"] <= 3 * r["size"] or r.taken == r.copies == 0
        taken[r.source] += r.taken
    assert all(want[s] - 1 < taken[s] <= want[s] + 1e-6 for s in sizes)
    assert sum(taken.values()) <= sum(sizes.values())
    again = mixing.mix(make(rows[::-1]).repartition(7)).collect()
    plain = lambda x: sorted(map(repr, ((r.doc_id, r.source, r["size"], r.taken) for r in x)))
    assert plain(again) == plain(got)
    assert mixing.mix(make([])).collect() == []


def test_the_order_is_by_finish_time(spark, make):
    rows = mixed_rows()
    got = {(r.doc_id, r.source): r for r in mixing.mix(make(rows)).collect()}
    place = {r.doc_id: r.h for r in make(rows).select("doc_id", F.xxhash64(F.col("doc_id").cast("string"), F.lit(17)).alias("h")).collect()}
    for source in {r[3] for r in rows}:
        own = sorted((place[i], i, len((t or "").split())) for i, t, _, s in rows if s == source)
        target, queue, at = got[own[0][1], source].target, Counter(), 0
        first = {}
        for _, i, n in own * 3:
            if n and at < target - 1e-6:
                first.setdefault(i, min(at + n, int(target + 1e-6)) / target)
                queue[i] += max(0, min(n, int(target - at + 1e-6)))
            at += n
        for _, i, _ in own:
            assert got[i, source].taken == queue[i]
            assert not queue[i] or abs(got[i, source].first_finish - first[i]) < 1e-6


def test_mixed_documents(spark, make):
    rows = mixed_rows()
    docs = make(rows)
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[(r.doc_id, r.source)] += r.copies
    assert Counter((r.doc_id, r.source) for r in got.collect()) == +want
    words = Counter()
    for r in got.collect():
        words[r.source] += len(r.text.split())
    taken = Counter()
    for r in mixing.mix(docs).collect():
        taken[r.source] += r.taken
    assert words == +taken
    same = [(1, "a b c", None, "s")] * 5 + [(2, "x " * 30, None, "t")]
    assert Counter(r.doc_id for r in mixing.mixed_documents(make(same)).collect())[1] == sum(r.copies for r in mixing.mix(make(same)).collect() if r.doc_id == 1)


def test_mixed_documents_of_edges(spark, make, edges):
    docs = make(edges)
    for name in ("__id", "rows", "CUT", "hash", "__copies", "copy", "due"):
        docs = docs.withColumn(name, F.lit(1))
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} <= {None, 4, 5, 6, 7, 8}
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in got.collect()) == +want
    assert mixing.mixed_documents(make([])).collect() == []
    df = spark.createDataFrame([("  a b\t c  d \n", 3), ("a b", 1), ("ab", 1)], "text string, n int")
    assert [r[0] for r in df.select(mixing.first_words(df.text, df.n)).collect()] == ["  a b\t c", "a", "ab"]


# --- tokens

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def plain_tokens(rows):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]


def test_encoder_is_the_library():
    rng, encoder, library = random.Random(7), tokens.Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    letters = "abzABZ019 \t\n\r.,'!?<|>-_éÉßÿ×÷µªº½²–漢́\x00\x85\xa0İΣ\U0001f600"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(3000)]
    texts += ["it's we'll I'd 'tis ''s they'RE", "<|endoftext|> <|startoftext|>x", "a" * 3000, "é" * 500, "x'sy'll"]
    texts += ["".join(rng.choice("abcÉß'st re ll.9!") for _ in range(rng.randrange(40))) for _ in range(3000)]
    for text in texts:
        assert np.frombuffer(encoder.ids(text), "<u2").tolist() == [*library.encode(text, add_special_tokens=False).ids, 1], repr(text)


def test_other_tokenizers_are_left_to_the_library(tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, library = tokens.Encoder(path), Tokenizer.from_file(path)
    assert not encoder.by_word and tokens.Encoder(TOKENIZER).by_word
    for text in ("Hello World, it is 42!", "plain words here", "", "x\u00e9 <|endoftext|>  y"):
        assert np.frombuffer(encoder.ids(text), "<u2").tolist() == [*library.encode(text, add_special_tokens=False).ids, 1]


def test_vocabularies_beyond_two_bytes(spark, make, tmp_path):
    from tokenizers.models import WordLevel
    from tokenizers.pre_tokenizers import Whitespace

    wide = Tokenizer(WordLevel({f"w{k}": k for k in range(70_000)} | {"[UNK]": 70_000}, unk_token="[UNK]"))
    wide.pre_tokenizer = Whitespace()
    wide.save(path := str(tmp_path / "wide.json"))
    rng = random.Random(12)
    rows = [(k, " ".join(f"w{rng.randrange(71_000)}" for _ in range(400))) for k in range(20)]
    tokens.write_store(make(rows), path, folder := f"file://{tmp_path}/store")
    got = tokens.read_store(spark, folder, with_ids=True).orderBy("doc_id").collect()
    assert [r.ids for r in got] == [[*wide.encode(t, add_special_tokens=False).ids, 1] for _, t in rows]
    assert max(max(r.ids) for r in got) > 1 << 16


def test_words_that_are_kept_are_bounded(monkeypatch):
    library = Tokenizer.from_file(TOKENIZER)
    monkeypatch.setattr(tokens, "KEPT_WORDS", 50)
    encoder = tokens.Encoder(TOKENIZER)
    text = " ".join(f"word{k}" for k in range(300)) + " " + "long" * 500
    assert np.frombuffer(encoder.ids(text), "<u2").tolist() == [*library.encode(text, add_special_tokens=False).ids, 1]
    assert len(encoder.words) <= 50 and max(map(len, encoder.words)) <= tokens.KEPT_LETTERS


def test_token_store(spark, make, edges):
    rng = random.Random(8)
    shared = " ".join(f"passage{rng.randrange(999)}" for _ in range(3000))
    rows = edges + [(50, shared), (51, shared), (52, "before " + shared), (53, shared + " after")]
    got = tokens.round_trip(make(rows), TOKENIZER).collect()
    at, want = 0, []
    order = sorted(plain_tokens(rows), key=lambda x: (x[0] is not None, x[0] or 0, len(x[1])))
    for i, ids in order:
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert tokens.round_trip(make([]), TOKENIZER).collect() == []


def test_equal_passages_are_stored_once(spark, make, tmp_path):
    rng = random.Random(9)
    shared = " ".join(f"passage{rng.randrange(9999)}" for _ in range(6000))
    folder = f"file://{tmp_path}/store"
    docs = make([(k, f"intro {k} " * k + shared) for k in range(8)]).repartition(4)
    tokens.write_store(docs, TOKENIZER, folder)
    chunks = spark.read.parquet(f"{folder}/chunks")
    n = sum(len(r.addresses) for r in spark.read.parquet(f"{folder}/recipes").collect())
    assert chunks.count() == chunks.select("address").distinct().count() < n / 3
    assert len(tokens.store_root(spark.read.parquet(f"{folder}/manifest"))) == 64
    read = tokens.read_store(spark, folder, with_ids=True).orderBy("start").collect()
    assert [r.ids for r in read] == [ids for _, ids in plain_tokens([(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()])]


def test_damage_is_found(spark, make, tmp_path):
    folder = f"file://{tmp_path}/store"
    tokens.write_store(make([(1, "some text of a document " * 20)]), TOKENIZER, folder)
    recipes = spark.read.parquet(f"{folder}/recipes").collect()
    other = spark.createDataFrame(recipes, spark.read.parquet(f"{folder}/recipes").schema).withColumn("root", F.unhex(F.lit("00" * 32)))
    other.write.mode("overwrite").parquet(f"{folder}/recipes")
    with pytest.raises(ValueError, match="roots"):
        tokens.read_store(spark, folder)


def test_cuts_depend_on_the_stream_alone():
    rng = np.random.default_rng(10)
    streams = [rng.integers(0, 49000, n).astype("<u2") for n in (1, 5, 16, 17, 18, 5000, 20000, 1)]
    streams.append(np.zeros(20000, "<u2"))
    whole = tokens.cuts(np.concatenate(streams), [len(s) for s in streams]).tolist()
    at, want = 0, []
    for s in streams:
        want += [at + c for c in tokens.cuts(s, [len(s)]).tolist()]
        at += len(s)
    assert whole == want
    assert max(np.diff([0, *whole])) <= tokens.MOST


def test_short_documents_share_a_passage():
    rng = np.random.default_rng(9)
    passages = rng.integers(2, 40_000, (20, 300))
    streams = [np.concatenate([rng.integers(2, 40_000, 60), passages[k % 20], rng.integers(2, 40_000, 60), [tokens.END]]) for k in range(120)]
    ids = np.concatenate(streams)
    chunks = [c.tobytes() for c in np.split(ids, tokens.cuts(ids, [len(s) for s in streams])[:-1])]
    assert sum(map(len, set(chunks))) < 0.9 * sum(map(len, chunks))


def test_merkle():
    leaves = [bytes([k]) * 32 for k in range(7)]
    assert len({tokens.merkle(leaves[:n]) for n in range(8)}) == 8
    assert tokens.merkle(leaves[::-1]) != tokens.merkle(leaves)

    def plain(nodes):
        while len(nodes) > 1:
            nodes = [hashlib.sha256(b"\1" + b"".join(p)).digest() if len(p) == 2 else p[0] for p in (nodes[k : k + 2] for k in range(0, len(nodes), 2))]
        return nodes[0] if nodes else hashlib.sha256(b"").digest()

    for n in range(40):
        assert tokens.merkle(own := [bytes([k]) * 32 for k in range(n)]) == plain(own)


# --- archives


def page_rows():
    body = "<p>" + "same payload, more than a hundred bytes of it " * 4
    return [(3, "https://www.A.example:80/x?q#f", body), (1, "http://a.example/x?q", body), (2, None, body), (4, "u", "short"), (5, "u", "short"), (6, "http://u@b.example", None), (7, "odd\nurl é", "漢字 é " * 50), (8, "", ""), (9, "z", "x" * 100), (10, "z", "x" * 100), (9, "z", "x" * 100), (None, "z", body), (11, "http://a.example/x?q", "WARC/1.1\r\n\r\n" * 20)]


def test_warc_round_trip(spark):
    rows = page_rows()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x")).withColumn("run", F.lit("x")).repartition(3)
    got = warc.round_trip(pages).collect()
    first = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 100 and i is not None:
            first[raw] = min(i, first.get(raw, i))
    want = []
    for i, url, html in rows:
        raw = (html or "").encode()
        refers = first[raw] if raw in first and first[raw] != i else None
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if refers is None else "revisit", refers))
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    assert {r.urlkey for r in got if r.page_id in (1, 3)} == {"example,a)/x?q"}
    order = [(r.urlkey.encode(), r.captured, r.page_id is not None, r.page_id or 0) for r in got]
    assert order == sorted(order)
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_loser_tree():
    rng = random.Random(11)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(rng.randrange(50) for _ in range(rng.choice((0, 1, 7, 30)))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_merging_many_runs(spark, monkeypatch):
    rng = random.Random(14)
    rows = [(rng.choice([None, k, k, k]), f"http://{'hot' if k % 3 else rng.choice('abc')}.example/{'x' * (k % 2)}", f"page {k % 50} " * 20) for k in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(13)
    want = sorted(map(repr, (tuple(r)[:8] for r in warc.round_trip(pages).collect())))
    monkeypatch.setattr(warc, "BLOCK_ROWS", 5)
    monkeypatch.setattr(warc, "FAN_IN", 2)
    got = warc.round_trip(pages).collect()
    assert sorted(map(repr, (tuple(r)[:8] for r in got))) == want and len(got) == 400
    order = [(r.urlkey.encode(), r.captured, r.page_id is not None, r.page_id or 0) for r in got]
    assert order == sorted(order)


def test_record_ids_are_unique(spark, tmp_path):
    pages = spark.createDataFrame([(9, "u", "same " * 40), (9, "u", "same " * 40), (None, "v", "x"), (None, "v", "x"), (10, "w", "same " * 40)], "page_id long, url string, html string")
    files = warc.archive(pages, f"file://{tmp_path}").collect()
    found = [warc.parse(raw) for f in files for _, raw in warc.records(f.file)]
    assert len({r["WARC-Record-ID"] for r in found}) == len(found) == 5 + len(files)
    (revisit,) = [r for r in found if r["WARC-Type"] == "revisit"]
    assert (revisit["X-Refers-To-Page-ID"], revisit["WARC-Refers-To-Target-URI"], revisit["WARC-Refers-To-Date"]) == ("9", "u", "2024-01-01T00:00:09Z")


def test_damaged_payloads_are_found(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x" * 500)], "page_id long, url string, html string")
    files = warc.archive(pages, f"file://{tmp_path}")
    name = files.head().file[7:]
    at = max(offset for offset, _ in warc.records(name if name.startswith("file:") else f"file://{name}"))
    raw = open(name, "rb").read()
    body = zlib.decompress(raw[at:], 31).replace(b"xxx", b"xyx", 1)
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    with open(name, "wb") as file:
        file.write(raw[:at] + packer.compress(body) + packer.flush())
    with pytest.raises(Exception, match="doesn't have its digest"):
        warc.histories(files, f"file://{tmp_path}/index").collect()
    with open(name, "wb") as file:
        file.write(raw[:-9])
    with pytest.raises(Exception, match="cut off"):
        warc.histories(files, f"file://{tmp_path}/index").collect()


# --- the queries and the pipeline


def test_names():
    assert [q.split("_")[0] for q in queries.queries()] == [f"op{n}" for n in range(1, 11)]
    assert set(queries.oracle_sql()) <= set(queries.queries())


def test_pipeline(spark, sample):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mixing", "tokens"]
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sample)
        assert docs.columns == columns
        assert 0 < docs.count() <= 3 * n
    kept = docs.orderBy("doc_id").collect()
    got = corpus_pipeline.run(spark, sample).orderBy("start").collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in kept]
    assert sum(r.n_tokens for r in got) == sum(len(ids) for _, ids in plain_tokens([(r.doc_id, r.text) for r in kept]))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_against_sql(spark, sample, name):
    import duckdb

    with duckdb.connect() as con:
        for table in ("documents", "benchmark", "pages"):
            con.execute(f"create view {table} as select * from read_parquet('{sample}/{table}.parquet')")
        got = queries.queries()[name](spark, sample)
        columns = ", ".join(sorted(got.columns))
        want = con.execute(f"select {columns} from ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.select(*sorted(got.columns)).collect()))) == sorted(map(repr, want))
