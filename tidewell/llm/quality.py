"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document. The counts of all vote patterns, a table of
bounded size, go to the driver, where expectation-maximisation estimates each labeller's accuracy on good and on bad
documents and the share of good ones. The posteriors by that table label a bounded sample of documents, on which a linear
scorer over hashed token features is trained in numpy. The scorer judges all documents.

Toxic terms, words and beginnings of words, are learned from a bounded sample of labelled documents, whatever their language:
those that take a far larger share of toxic documents' words. A document is toxic by the share of its words that are such.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.arrow import pieces, text_strings
from tidewell.llm.common import written

BUCKETS = 1 << 14
#: Documents that the scorer is fitted on, about: the documented bound of its sample.
FIT_DOCS = 6000
STEPS, RATE, DECAY = 150, 0.5, 1e-4
KEEP_SCORE = 0.4
#: Labelled documents that toxic terms are learned from, about: the documented bound of that sample. One labelled id in four,
#: by its hash, is never among them: recall is measured on these.
LABELLED, HELD_OUT = 6000, 4
#: A toxic term begins a word by so many letters, or is a word; it stands in so many toxic documents, and takes this many times
#: the share of toxic documents' words that it takes of others'.
STARTS, TERM_DOCS, TERM_RATIO = (4, 5, 6, 7), 5, 8.0
#: Bytes of text that are read at once: each takes some 100 bytes of working memory.
PIECE_BYTES = 3 << 20

# Frequent short words of four languages.
STOP_WORDS = frozenset(
    "a an and are as at be by for from in is it of on or that the this to was with "
    "der die das und ist in den von zu mit auf für ein eine sich im dem nicht "
    "le la les de des du et en un une est que qui dans pour sur au ce avec "
    "el los las y que se por con para una del al es lo como su".split()
)

#: Votes.
BAD, GOOD, NONE = 0, 1, 2
#: Code points beyond are taken as letters without case.
_KNOWN = 0x3100
_SPACE, _LETTER, _CAPITAL, _DIGIT, _SYMBOL, _END, _BAR = (1 << k for k in range(7))


def _flags_of(c: str) -> int:
    tests = (c.isspace(), c.isalpha(), c.isupper(), c.isdigit(), c in "#$%&*{}<>~^\\=_@+|", c in ".!?…", c in "|»•·")
    return sum(1 << k for k, x in enumerate(tests) if x)


_POINTS = [chr(c) for c in range(_KNOWN)]
_FLAGS = np.array([_flags_of(c) for c in _POINTS] + [_LETTER], np.uint8)
_LOWER = np.array([ord(x) if len(x := c.lower()) == 1 else ord(c) for c in _POINTS] + [0], np.uint32)
_POWERS = np.cumprod(np.full(64, 0x100000001B3, np.uint64), dtype=np.uint64) | np.uint64(1)


class Tokens:
    """The tokens of some texts, runs of characters that are not white space: the text, signs and hashes of each.

    All characters are handled side by side; no Python runs for a token. `word` hashes a token's letters and digits in
    lower case, `shape` the runs of capitals, letters, digits and signs in it; `starts`, if asked for, the first letters and
    digits, as many as STARTS says each, 0 for a token with fewer.
    """

    def __init__(self, texts: list[str], starts: bool = False) -> None:
        self.n = len(texts)
        points = np.frombuffer((" ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), "<u4")
        known = np.minimum(points, _KNOWN)
        flags = _FLAGS[known]
        space = flags & _SPACE != 0
        edge = np.diff(np.concatenate(([True], space, [True])).view(np.int8))  # -1 where a token begins, 1 behind its end
        first, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.empty(0, int)
        self.doc, self.size = np.searchsorted(ends, first, "right"), stop - first
        count = lambda x: np.add.reduceat(x, first, dtype=np.int32) if len(first) else np.empty(0, np.int32)
        letter, digit = flags & _LETTER != 0, flags & _DIGIT != 0
        alike = letter | digit
        sign = ~alike & ~space
        self.letters, self.capitals, self.symbols = count(letter), count(flags & _CAPITAL != 0), count(flags & _SYMBOL != 0)
        last = stop - 1
        self.decorated = sign[last] & sign[np.maximum(last - 1, first)] & (self.size > 1)
        self.plain = (self.letters == self.size) | ((self.letters == self.size - 1) & sign[last])
        self.ends, self.bar = flags[last] & _END != 0, (flags[first] & _BAR != 0) & (self.size == 1)
        kind = np.where(flags & _CAPITAL != 0, 1, np.where(letter, 2, np.where(digit, 3, known + np.uint32(4)))).astype(np.uint32)
        new = ~space
        new[1:] &= (kind[1:] != kind[:-1]) | space[:-1]
        lower = np.where(known < _KNOWN, _LOWER[known], points)
        token = np.cumsum(edge[:-1] == -1, dtype=np.int32) - 1 if len(first) else np.empty(0, np.int32)
        self.word, *self.starts = self._hash(lower, alike, first, token, STARTS if starts else ())
        (self.shape,) = self._hash(kind, new, first, token)

    @staticmethod
    def _hash(value: np.ndarray, own: np.ndarray, first: np.ndarray, token: np.ndarray, starts: tuple[int, ...] = ()) -> list[np.ndarray]:
        """A hash of each token's own values in their order, and of so many first ones; token: the token of each character."""
        if not len(first):
            return [np.empty(0, np.uint64)] * (1 + len(starts))
        at = np.flatnonzero(own)
        before = np.cumsum(own, dtype=np.int32)[first] - own[first]  # number of own values before each token
        mixed = (value[at].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * _POWERS[(np.arange(len(at), dtype=np.int32) - before[token[at]]) & 63]
        mixed ^= mixed >> np.uint64(29)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)))
        ended = np.concatenate((before[1:], [len(at)]))

        def spread(x: np.ndarray) -> np.ndarray:
            return (x := x * np.uint64(0xFF51AFD7ED558CCD)) ^ (x >> np.uint64(32))

        enough = lambda k: ended - before >= k
        return [spread(total[ended] - total[before])] + [np.where(enough(k), spread(total[np.minimum(before + k, ended)] - total[before] + np.uint64(k)), np.uint64(0)) for k in starts]

    def total(self, values: np.ndarray) -> np.ndarray:
        """Sums by text."""
        return np.bincount(self.doc, values, self.n)


_STOP_HASHES = np.sort(Tokens([" ".join(sorted(STOP_WORDS))]).word)
#: Without labels nothing is toxic.
_NO_TERMS = (np.empty(0, np.uint64), float("inf"))


def _said(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    return words[np.minimum(np.searchsorted(words, hashes), len(words) - 1)] == hashes if len(words) else np.zeros(len(hashes), bool)


def toxic_shares(found: Tokens, terms: np.ndarray) -> np.ndarray:
    """The share of each text's words that are, or begin with, one of the sorted terms."""
    hit = np.logical_or.reduce([_said(h, terms) for h in (found.word, *found.starts)])
    return found.total(hit) / np.maximum(np.bincount(found.doc, minlength=found.n), 1)


def votes(texts: list[str], tokens_: Tokens | None = None) -> np.ndarray:
    """Votes of the labellers on each text (texts x labellers)."""
    found = tokens_ or Tokens(texts)
    n, doc = len(texts), found.doc
    tokens = np.bincount(doc, minlength=n).astype(float)
    some = np.maximum(tokens, 1)
    chars, letters, capitals, symbols, decorated, plain, ends, bars = map(found.total, (found.size, found.letters, found.capitals, found.symbols, found.decorated, found.plain, found.ends, found.bar))
    stops = found.total(_said(found.word, _STOP_HASHES))
    key, count = np.unique((doc.astype(np.uint64) << np.uint64(40)) | (found.word >> np.uint64(24)), return_counts=True)
    step, place = np.uint64(1 << 40), found.word
    owner = (key // step).astype(np.int64)
    different = np.bincount(owner, minlength=n).astype(float)
    top = np.zeros(n)
    np.maximum.at(top, owner, count)

    def repeats(by: int) -> np.ndarray:
        return np.bincount(doc[by:][(place[by:] == place[:-by]) & (doc[by:] == doc[:-by])], minlength=n) / some

    lines = [[x for x in t.split("\n") if x.strip()] for t in texts]
    line_count = np.array([len(x) for x in lines])
    same_lines = np.array([1 - len(set(x)) / len(x) if x else 0.0 for x in lines])
    sizes = np.array([(len(raw), len(zlib.compress(raw, 1))) for raw in (t.encode("utf-8", "replace") for t in texts)], float).reshape(-1, 2)
    packed = sizes[:, 1] / np.maximum(sizes[:, 0], 1)
    variety = different / np.minimum(some, 40 + np.sqrt(some) * 8)  # longer texts repeat words more

    def vote(bad: np.ndarray, good: np.ndarray, able: np.ndarray = tokens > 0) -> np.ndarray:
        return np.where(able & bad, BAD, np.where(able & good, GOOD, NONE))

    symbol, capital, mean = symbols / np.maximum(chars, 1), capitals / np.maximum(letters, 1), chars / some
    once, twice, long = repeats(1), repeats(1) + repeats(2) + repeats(3), tokens >= 20
    columns = [
        vote(symbol > 0.02, symbol < 0.005),
        vote(decorated / some > 0.15, decorated / some < 0.02),
        vote(plain / some < 0.7, plain / some > 0.9, tokens >= 10),
        vote(capital > 0.4, capital < 0.15),
        vote(bars / some > 0.05, bars == 0),
        vote(variety < 0.3, variety > 0.5, long),
        vote(top / some > 0.2, top / some < 0.12, long),
        vote(once > 0.15, once < 0.03, long),
        vote(twice > 0.3, twice < 0.08, long),
        vote(packed < 0.25, packed > 0.35, sizes[:, 0] >= 200),
        vote(same_lines > 0.3, same_lines == 0, line_count >= 3),
        vote(stops / some < 0.04, stops / some > 0.12, long),
        vote((mean < 3) | (mean > 12), (mean >= 4) & (mean <= 9)),
        vote(ends / some < 0.005, (ends / some > 0.02) & (ends / some < 0.5), long),
    ]
    return np.stack(columns, axis=1)


def features(texts: list[str], tokens_: Tokens | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of the texts: document, bucket, and value, the square root of its share of the document's features."""
    found = tokens_ or Tokens(texts)
    doc, parts = found.doc, []
    for hashes in (found.word, found.shape):
        parts.append(doc * BUCKETS + (hashes >> np.uint64(40)).astype(np.int64) % BUCKETS)
    for by in (1, 2):
        again = (found.word[by:] == found.word[:-by]) & (doc[by:] == doc[:-by])
        parts.append(doc[by:] * BUCKETS + np.where(again, 2 * by, 2 * by + 1))
    key, count = np.unique(np.concatenate(parts), return_counts=True)
    own = key // BUCKETS
    whole = np.bincount(own, count, found.n)
    return own, key % BUCKETS, np.sqrt(count / np.maximum(whole[own], 1))


def posterior(patterns: np.ndarray, share: float, table: np.ndarray) -> np.ndarray:
    """Of each row of votes, the probability of good."""
    log = np.log(table)
    good = ((patterns == BAD) @ (log[:, 1, 0] - log[:, 0, 0])) + ((patterns == GOOD) @ (log[:, 1, 1] - log[:, 0, 1])) + np.log(share / (1 - share))
    return 1 / (1 + np.exp(-np.clip(good, -50, 50)))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, prior: float = 0.02) -> tuple[float, np.ndarray, np.ndarray]:
    """Share of good documents, P(vote | class) as labellers x classes x (bad, good), and each pattern's posterior of good.

    It begins at the majority's view. A labeller that doesn't vote says nothing. Labellers are presumed to be right in four
    cases of five, as if so seen on a share prior of all documents, so that the classes can't change places.
    """
    bad, good = patterns == BAD, patterns == GOOD
    post = 1 / (1 + np.exp(-np.clip(good.sum(axis=1) - 3.0 * bad.sum(axis=1), -8, 8)))
    presumed = prior * max(counts.sum(), 1) * np.array([[0.8, 0.2], [0.2, 0.8]]) + 0.1
    share, table = 0.5, None
    for _ in range(rounds):
        weight = np.stack((counts * (1 - post), counts * post))
        table = np.stack((weight @ bad, weight @ good), axis=2).transpose(1, 0, 2) + presumed
        table /= table.sum(axis=2, keepdims=True)
        share = float((weight[1].sum() + 1) / (counts.sum() + 2))
        new = posterior(patterns, share, table)
        moved, post = float(np.abs(new - post).max(initial=0)), new
        if moved < 1e-7:
            break
    return share, table, post


class Scorer:
    """A logistic scorer over hashed features."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights.astype(np.float32), bias

    def scores(self, n: int, own: np.ndarray, bucket: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Of n texts with the given features, between 0 and 1; 0 for a text without a token."""
        z = np.bincount(own, value * self.weights[bucket], n) + self.bias
        return np.where(np.bincount(own, minlength=n) > 0, 1 / (1 + np.exp(-np.clip(z, -50, 50))), 0.0)


def fit(own: np.ndarray, bucket: np.ndarray, value: np.ndarray, label: np.ndarray) -> Scorer:
    """Gradient descent with per-weight steps on the cross-entropy to soft labels."""
    weights, bias, n = np.zeros(BUCKETS), 0.0, max(1, len(label))
    seen, seen_bias = np.full(BUCKETS, 1e-8), 1e-8
    balance = np.where(label > 0.5, 0.5 / max(label.mean(), 1e-6), 0.5 / max(1 - label.mean(), 1e-6)) if len(label) else label
    for _ in range(STEPS):
        z = np.bincount(own, value * weights[bucket], n)[: len(label)] + bias
        wrong = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - label) * balance
        step = np.bincount(bucket, value * wrong[own], BUCKETS) / n + DECAY * weights
        seen += step**2
        seen_bias += wrong.mean() ** 2
        weights -= RATE * step / np.sqrt(seen)
        bias -= RATE * wrong.mean() / np.sqrt(seen_bias)
    return Scorer(weights, bias)


def _vote_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's votes as a number of base 3, and how often it stands in the batch."""
    for batch in batches:
        for piece in pieces(batch, text=0, limit=PIECE_BYTES):
            found = votes(text_strings(piece.column(0)))
            code, n = np.unique(found @ 3 ** np.arange(found.shape[1], dtype=np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["pattern", "n"])


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, text=0, limit=PIECE_BYTES):
            texts = text_strings(piece.column(0))
            read = Tokens(texts)
            found = votes(texts, read)
            own, bucket, value = features(texts, read)
            cuts = np.searchsorted(own, np.arange(1, len(texts)))
            yield pa.RecordBatch.from_arrays([pa.array(list(found.astype(np.int8)), pa.list_(pa.int8())), pa.array(np.split(bucket.astype(np.int32), cuts), pa.list_(pa.int32())), pa.array(np.split(value.astype(np.float32), cuts), pa.list_(pa.float32()))], ["votes", "buckets", "values"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_docs: int = FIT_DOCS) -> tuple[Scorer, float, np.ndarray] | None:
    """The scorer, the share of good documents and the labellers' P(vote | class); None without a row.

    Patterns are counted over all documents; their table, two numbers a pattern, has 3 ** labellers rows at most (77 MB), and
    only those that occur. The scorer is fitted on about fit_docs rows, chosen by a hash of id and text, rows alike in both as one.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"))
    counted = rows.select("text").mapInArrow(_vote_batches, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").toArrow()
    code, counts = (counted.column(k).to_numpy() for k in range(2))
    if not len(code):
        return None
    labellers = votes([""]).shape[1]
    patterns = np.stack([(code // 3**k % 3).astype(np.int8) for k in range(labellers)], axis=1)
    share, table, _ = estimate(patterns, counts.astype(float))
    some = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20)) < (1 << 20) * min(1.0, fit_docs / int(counts.sum()))
    found = rows.filter(some).distinct().select("text").mapInArrow(_feature_batches, "votes array<byte>, buckets array<int>, values array<float>")
    own, bucket, value, seen = [], [], [], []
    for voted, buckets, values in found.toLocalIterator():
        own.append(np.full(len(buckets), len(seen)))
        bucket.append(np.array(buckets, np.int64))
        value.append(np.array(values))
        seen.append(voted)
    joined = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (own, bucket, value)]
    return fit(*joined, posterior(np.array(seen, np.int8).reshape(-1, labellers), share, table)), share, table


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of toxic and text: each text's terms, each with its share of the text's words."""
    for batch in batches:
        for piece in pieces(batch, limit=PIECE_BYTES):
            read, bad = Tokens(text_strings(piece.column(1)), True), piece.column(0).to_numpy(zero_copy_only=False)
            size = np.bincount(read.doc, minlength=read.n)
            for hashes in (read.word, *read.starts):
                own, order = hashes != 0, np.lexsort((hashes, read.doc))
                order = order[own[order]]
                doc, term = read.doc[order], hashes[order]
                new = np.flatnonzero(np.concatenate((np.ones(min(1, len(doc)), bool), (doc[1:] != doc[:-1]) | (term[1:] != term[:-1]))))
                count = np.diff(np.append(new, len(doc)))
                yield pa.RecordBatch.from_arrays([pa.array(term[new].view(np.int64)), pa.array(bad[doc[new]], pa.bool_()), pa.array(count / size[doc[new]], pa.float64())], ["term", "toxic", "share"])


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """toxic, text: about LABELLED distinct texts with a label, by hash of their ids, none of them held out."""
    known = labels.filter("toxic is not null").groupBy(F.col("doc_id").cast("string").alias("id")).agg((F.max("toxic") > 0).alias("toxic"))
    spread = F.pmod(F.xxhash64("id"), F.lit(HELD_OUT << 20))
    known = known.filter((spread % HELD_OUT != 0) & (spread < (HELD_OUT << 20) * min(1.0, LABELLED / max(1, labels.count()))))
    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.join(F.broadcast(known), "id").groupBy("text").agg(F.max("toxic").alias("toxic")).select("toxic", "text")


def toxic_terms(docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, float]:
    """Hashes of the toxic terms, sorted, and the least share of them among a toxic text's words.

    Without labels, or with fewer than TERM_DOCS toxic ones, there are none, and no text is toxic.
    """
    if labels is None:
        return _NO_TERMS
    sample = written(labelled_sample(docs, labels, id_col, text_col), "quality-labelled")
    n = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if n.get(True, 0) < TERM_DOCS or not n.get(False):
        return _NO_TERMS
    bad, clean = F.col("toxic"), ~F.col("toxic")
    seen = sample.mapInArrow(_term_batches, "term long, toxic boolean, share double").groupBy("term")
    seen = seen.agg(F.count_if(bad).alias("bad"), F.count_if(clean).alias("clean"), F.sum(F.when(bad, F.col("share")).otherwise(0.0)).alias("in_bad"), F.sum(F.when(clean, F.col("share")).otherwise(0.0)).alias("in_clean"))
    often = F.col("in_bad") / n[True] > TERM_RATIO * (F.col("in_clean") + 1e-3) / n[False]
    often &= F.col("bad") / n[True] > 3 * F.col("clean") / n[False]
    found = seen.filter((F.col("bad") >= TERM_DOCS) & often).select("term").collect()
    terms = np.sort(np.array([r[0] for r in found], np.int64).view(np.uint64))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, limit=PIECE_BYTES):
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(toxic_shares(Tokens(text_strings(piece.column(1)), True), terms))], ["toxic", "share"])

    pairs = sample.mapInArrow(measure, "toxic boolean, share double").collect()
    toxic, share = np.array([r[0] for r in pairs]), np.array([r[1] for r in pairs])
    steps = np.unique(share[share > 0])
    if not len(steps):
        return _NO_TERMS
    right = len(toxic) - np.searchsorted(np.sort(share), steps), toxic.sum() - np.searchsorted(np.sort(share[toxic]), steps)
    return terms, float(steps[np.argmax(2 * right[1] / (right[0] + toxic.sum()))])


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_docs: int = FIT_DOCS, labels: DataFrame | None = None) -> DataFrame:
    """doc_id, quality (0 to 1), pattern (the labellers' votes), weak_label (their posterior), toxic, keep: a row a row.

    toxic: toxic terms, learned from labels (doc_id, toxic), take the share of its words that toxic_terms() says; false without
    labels. keep: quality of KEEP_SCORE or more, and not toxic. Null and empty texts have quality 0 and aren't kept. Repeated rows
    each give a row. An empty table gives none.
    """
    model = train(docs, id_col, text_col, fit_docs) or (None, 0.5, None)
    held = docs.sparkSession.sparkContext.broadcast((model, *toxic_terms(docs, labels, id_col, text_col)))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (scorer, share, table), terms, least = held.value
        for batch in batches:
            for piece in pieces(batch, limit=PIECE_BYTES):
                texts = text_strings(piece.column(1))
                read = Tokens(texts, True)
                found, toxic = votes(texts, read), toxic_shares(read, terms) >= least
                words, scores = ["".join(map(str, v)) for v in found.tolist()], scorer.scores(len(texts), *features(texts, read))
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(scores), pa.array(words, pa.string()), pa.array(posterior(found, share, table)), pa.array(toxic, pa.bool_()), pa.array((scores >= KEEP_SCORE) & ~toxic)], ["doc_id", "quality", "pattern", "weak_label", "toxic", "keep"])

    return rows.mapInArrow(judge, f"doc_id {dict(rows.dtypes)['doc_id']}, quality double, pattern string, weak_label double, toxic boolean, keep boolean")
