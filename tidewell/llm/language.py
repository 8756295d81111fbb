"""Language identification: scripts narrow the candidates, words are scored, and Viterbi labels spans.

A word's scores are sums of log odds of its hashed character n-grams and of the word itself. A path of languages over a
text's words pays SWITCH for every change; the best path splits a mixed text into spans. The path is exact for texts of
any length: blocks of words are reduced to their best scores from each first to each last state, blocks are chained, and
each block's inside is then traced. All texts of a batch advance together in numpy.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.arrow import claim, pieces, text_strings

BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
#: Labelled documents of each language that the model is fitted on, about: the documented bound of its sample.
FIT_DOCS = 1500
#: Neighbouring n-grams say much the same; their log odds count this much.
DAMP = 0.4
SWITCH = 8.0
#: Score of a language that is not written in a word's script.
NOT_IN_SCRIPT = -40.0
#: Score of all languages for a word in a script that none is written in; it changes no path, and its letters are no language's.
FOREIGN = -4096.0
#: Share of a language's letters in a script from which the language is a candidate for words in it.
SCRIPT_SHARE = 0.005
BLOCK = 64
#: Bytes of the blocks' tables of texts that are read side by side.
TABLE_BYTES = 256 << 20
#: Bytes of words' scores that a worker keeps.
KEPT_BYTES = 64 << 20
#: Words whose n-grams, and bytes of text whose words, are held at once.
WORDS, PIECE_BYTES = 16_384, 3 << 20
UNKNOWN = "und"

# First code points of Unicode blocks, and the script that holds from there on.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"),
    (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x30000, "other"),
)
_FIRST = np.array([x for x, _ in SCRIPTS])
_NAMES = sorted({x for _, x in SCRIPTS})
_SCRIPT = np.array([_NAMES.index(x) for _, x in SCRIPTS])

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words' n-grams, the word of each, sorted by word; the letters' scripts and the words of these."""
    points = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    space = points == 32
    word = np.cumsum(space) - 1  # a word's leading space belongs to it
    buckets, owners = [], []
    for n in ORDERS:
        if n > len(points):  # a single word of one letter
            continue
        value = np.full(len(points) - n + 1, n, np.uint64)
        for k in range(n):
            value = (value * np.uint64(0x100000001B3)) ^ points[k : len(points) - n + 1 + k]
        inside = np.convolve(space, np.ones(n, int), "valid")
        own = (inside == 0) | ((inside == 1) & (space[: len(value)] | space[n - 1 :])) if n > 1 else inside == 0
        buckets.append(_mix(value[own]))
        owners.append(word[: len(value)][own])
    buckets.append(np.array([zlib.crc32(w.encode()) % BUCKETS for w in words], np.int64))
    owners.append(np.arange(len(words)))
    owner, bucket = np.concatenate(owners), np.concatenate(buckets)
    order = np.argsort(owner, kind="stable")
    letters = ~space
    return bucket[order], owner[order], _SCRIPT[np.searchsorted(_FIRST, points[letters], "right") - 1], word[letters]


def _mix(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return (value >> np.uint64(40)).astype(np.int64) % BUCKETS


class Model:
    """Log odds of n-gram buckets for each language, and the languages written in each script."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray) -> None:
        """counts: BUCKETS x languages; scripts: scripts x languages, numbers of letters."""
        self.languages = languages
        self.key = uuid.uuid4().hex
        share = counts / np.maximum(counts.sum(axis=0), 1) * 1e6
        odds = np.log(share + 0.5)
        self.odds = (DAMP * (odds - odds.mean(axis=1, keepdims=True))).astype(np.float32)
        written_in = scripts / np.maximum(scripts.sum(axis=0), 1) >= SCRIPT_SHARE
        self.barred = np.where(written_in, 0, NOT_IN_SCRIPT).astype(np.float32)
        self.barred[~written_in.any(axis=1)] = FOREIGN

    def score(self, words: list[str]) -> np.ndarray:
        """words x languages."""
        if not words:
            return np.empty((0, len(self.languages)), np.float32)
        bucket, owner, script, holder = ngrams(words)
        first = np.searchsorted(owner, np.arange(len(words)))
        scores = np.add.reduceat(self.odds[bucket], first, axis=0)
        most = np.zeros((len(words), len(_NAMES)), np.int32)
        np.add.at(most, (holder, script), 1)
        return scores + self.barred[most.argmax(axis=1)]


def best_paths(scores: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best state of each word: scores (words x states) of texts of the given lengths, one after the other.

    Texts are read side by side, as many as keep the blocks' tables within TABLE_BYTES; one text that alone needs more,
    as states are many or words very many, is read word by word.
    """
    states, ends = scores.shape[1], np.cumsum(lengths)
    size = -(-lengths // BLOCK) * (states * states * 4 + BLOCK * states * 8)
    out, at = [], 0
    while at < len(lengths):
        to = max(at + 1, int(np.searchsorted(np.cumsum(size[at:]), TABLE_BYTES, "right")) + at)
        own = scores[ends[at] - lengths[at] : ends[to - 1]]
        alone = to == at + 1 and size[at] > TABLE_BYTES and states > 1
        out.append(_word_by_word(own, switch) if alone else _side_by_side(own, lengths[at:to], switch))
        at = to
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _word_by_word(scores: np.ndarray, switch: float) -> np.ndarray:
    """The best path of one text. A step keeps the best state before it and a bit a state: whether it stays or comes from there."""
    total, states = scores.shape
    value, tops = scores[0].astype(np.float64), np.zeros(total, np.int64)
    stays = np.empty((total, -(-states // 8)), np.uint8)
    for t in range(1, total):
        tops[t] = top = value.argmax()
        jump = value[top] - switch
        stays[t] = np.packbits(value >= jump)
        value = np.maximum(value, jump) + scores[t]
    path, state = np.empty(total, np.int64), int(value.argmax())
    for t in range(total - 1, -1, -1):
        path[t] = state
        if not stays[t, state >> 3] >> (7 - (state & 7)) & 1:
            state = int(tops[t])
    return path


def _side_by_side(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    total, states = scores.shape
    out = np.zeros(total, np.int64)
    lengths = lengths[lengths > 0]
    if states == 1 or not total:
        return out
    blocks = -(-lengths // BLOCK)
    first = np.concatenate(([0], np.cumsum(blocks)[:-1]))  # first block of each text
    begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    at = np.arange(total) - np.repeat(begin, lengths)
    block, place = np.repeat(first, lengths) + at // BLOCK, at % BLOCK
    grid = np.zeros((BLOCK, int(blocks.sum()), states), np.float32)
    grid[place, block] = scores

    # Best score of each block from a state before it to a state at its end; filling after a text's end scores nothing.
    stay = np.where(np.eye(states, dtype=bool), 0, -switch).astype(np.float32)
    through = stay[None] + grid[0][:, None, :]
    for t in range(1, BLOCK):
        through = np.maximum(through, through.max(axis=2, keepdims=True) - switch) + grid[t][:, None, :]

    # Chain the blocks of each text; texts with more blocks go on longer.
    order = np.argsort(-blocks, kind="stable")
    ahead = np.zeros((len(lengths), states), np.float64)
    before = np.zeros((int(blocks.sum()), states), np.float64)
    for k in range(int(blocks.max())):
        live = order[: np.searchsorted(-blocks[order], -k, "left")]
        own = first[live] + k
        before[own] = ahead[live]
        ahead[live] = (ahead[live][:, :, None] + through[own]).max(axis=1)
    last = ahead.argmax(axis=1)
    start, end = np.zeros(len(before), np.int64), np.zeros(len(before), np.int64)
    for k in range(int(blocks.max()) - 1, -1, -1):
        live = order[: np.searchsorted(-blocks[order], -k, "left")]
        own = first[live] + k
        end[own] = last[live]
        last[live] = (before[own] + through[own, :, end[own]]).argmax(axis=1)
        start[own] = last[live]

    # Trace inside the blocks, from the state before to the state at the end.
    value, small = stay[start] + grid[0], np.min_scalar_type(states - 1)
    from_ = np.empty((BLOCK, len(before), states), small)
    own_state = np.arange(states, dtype=small)[None]
    for t in range(1, BLOCK):
        best = value.argmax(axis=1)
        jump = value.max(axis=1, keepdims=True) - switch
        from_[t] = np.where(value >= jump, own_state, best[:, None].astype(small))
        value = np.maximum(value, jump) + grid[t]
    path, state, every = np.empty((BLOCK, len(before)), np.int64), end, np.arange(len(before))
    for t in range(BLOCK - 1, -1, -1):
        path[t] = state
        if t:
            state = from_[t][every, state].astype(np.int64)
    return path[place, block]


def _count_batches(languages: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, scripts = np.zeros((len(languages), BUCKETS), np.int64), np.zeros((len(languages), len(_NAMES)), np.int64)
        for batch in batches:
            for piece in pieces(batch, limit=PIECE_BYTES):
                for lang, text in zip(piece.column(0).to_pylist(), text_strings(piece.column(1))):
                    words, k = words_of(text), languages.index(lang)
                    for at in range(0, len(words), WORDS):
                        bucket, _, script, _ = ngrams(words[at : at + WORDS])
                        counts[k] += np.bincount(bucket, minlength=BUCKETS)
                        scripts[k] += np.bincount(script, minlength=len(_NAMES))
        for kind, table in (("n", counts), ("s", scripts)):
            k, cell = np.nonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(k)), pa.array(k), pa.array(cell), pa.array(table[k, cell])], ["kind", "lang", "cell", "n"])

    return run


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_docs: int = FIT_DOCS) -> Model | None:
    """The model of labelled rows; None if no row has a text and a label.

    About fit_docs documents of each language are read, chosen by a hash of id and text (all, if there are fewer), rows
    alike in both as one: each gives all of its text. Their n-grams are counted on the cluster, and a table of fixed size comes to the driver.
    """
    rows = labelled.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text")).filter("lang is not null and text is not null")
    sizes = dict(rows.groupBy("lang").count().collect())
    languages = sorted(sizes)
    if not languages:
        return None
    share = F.element_at(F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, fit_docs / sizes[lang]))]), F.col("lang"))
    sample = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20)) < share * (1 << 20)).distinct().select("lang", "text")
    cells = sample.mapInArrow(_count_batches(languages), "kind string, lang long, cell long, n long").groupBy("kind", "lang", "cell").agg(F.sum("n").alias("n"))
    counts, scripts = np.zeros((BUCKETS, len(languages))), np.zeros((len(_NAMES), len(languages)))
    for kind, lang, cell, n in cells.toLocalIterator():
        (counts if kind == "n" else scripts)[cell, lang] = n
    return Model(languages, counts, scripts)


_words: dict[str, int] = {}
_rows: list[np.ndarray] = []
_owner: list[str] = []


def _forget() -> None:
    _words.clear()
    _rows.clear()
    _owner.clear()


def _scores(words: list[str], model: Model) -> np.ndarray:
    """Scores of words, kept by the worker in a table that grows by doubling, up to KEPT_BYTES and one batch more."""
    claim("language", _forget)
    if _owner != [model.key] or len(_words) * 4 * len(model.languages) > KEPT_BYTES:
        _forget()
        _rows.append(np.empty((1 << 12, len(model.languages)), np.float32))
        _owner.append(model.key)
    get = _words.get
    places = [get(w, -1) for w in words]
    if -1 in places:
        new = list(dict.fromkeys(w for w, p in zip(words, places) if p < 0))
        at = len(_words)
        _words.update(zip(new, range(at, at + len(new))))
        if len(_words) > len(_rows[0]):
            wider = np.empty((max(2 * len(_rows[0]), len(_words)), len(model.languages)), np.float32)
            wider[:at] = _rows[0][:at]
            _rows[0] = wider
        for k in range(0, len(new), WORDS):
            _rows[0][at + k : at + k + len(new[k : k + WORDS])] = model.score(new[k : k + WORDS])
        places = [p if p >= 0 else get(w) for w, p in zip(words, places)]
    return _rows[0][np.array(places, np.int64)]


def label(texts: list[str], model: Model) -> list[tuple[str, float, list[dict]]]:
    """Language, share of letters in its spans, but in foreign scripts, and spans (code points, end exclusive) of each text."""
    words = [found if "".join(found := words_of(t)).isalpha() else [w for w in found if any(map(str.isalpha, w))] for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    flat = [w for ws in words for w in ws]
    scores = _scores(flat, model) if flat else np.empty((0, len(model.languages)), np.float32)
    path = best_paths(scores, lengths)
    letters = np.fromiter(map(len, flat), np.int64, len(flat))
    text = np.repeat(np.arange(len(texts)), lengths)
    every = np.bincount(text, letters, len(texts))
    own_letters = np.where(scores[:, 0] < FOREIGN / 2, 0, letters) if model.languages else letters
    held = np.bincount(text * len(model.languages) + path, own_letters, len(texts) * len(model.languages)).reshape(len(texts), -1)
    ends, out = np.cumsum(lengths), []
    for i, own in enumerate(held):
        if not lengths[i]:
            out.append((UNKNOWN, 0.0, []))
            continue
        states = path[ends[i] - lengths[i] : ends[i]]
        if (states == states[0]).all():
            spans = [{"start": 0, "end": len(texts[i]), "lang": model.languages[states[0]]}]
        else:
            spans = _spans(texts[i], states, model.languages)
        out.append((model.languages[own.argmax()], float(own.max() / every[i]), spans))
    return out


def _spans(text: str, states: np.ndarray, languages: list[str]) -> list[dict]:
    found = [m for m in _WORD.finditer(text) if any(map(str.isalpha, m.group()))]
    if len(found) != len(states):  # lower-casing changed what is a word
        return []
    cuts = [0, *(np.flatnonzero(np.diff(states)) + 1).tolist(), len(states)]
    edges = [0, *(found[c].start() for c in cuts[1:-1]), len(text)]
    return [{"start": a, "end": b, "lang": languages[states[c]]} for a, b, c in zip(edges, edges[1:], cuts)]


HELD_OUT = 2


def held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))), F.lit(4)) == HELD_OUT


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])
_SCHEMA = "lang_pred string, score double, spans array<struct<start: long, end: long, lang: string>>"


def _labels(texts: list[str], held: Broadcast | None) -> list[pa.Array]:
    out = label(texts, held.value) if held else [(UNKNOWN, 0.0, [])] * len(texts)
    return [pa.array(x, k) for x, k in zip(zip(*out) if out else [[]] * 3, (pa.string(), pa.float64(), pa.list_(_SPAN)))]


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, spans: a row for each row of docs.

    A null text, or one without a letter, is `und` with score 0 and no span; so is every text without a model. The score
    is the share of the text's letters that lie in spans of its language; letters in a script that no learned language is
    written in lie in none. Repeated rows each give a row; an empty table gives none.
    """
    held = docs.sparkSession.sparkContext.broadcast(model) if model else None
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, limit=PIECE_BYTES):
                yield pa.RecordBatch.from_arrays([piece.column(0), *_labels(text_strings(piece.column(1)), held)], ["doc_id", "lang_pred", "score", "spans"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, {_SCHEMA}")


def cross_fitted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """identify() with a model of the labelled rows that aren't held out, and column held_out."""
    model = fit(docs.filter(~held_out(F.col(f"`{id_col}`"))), id_col, text_col, lang_col)
    return identify(docs, model, id_col, text_col).withColumn("held_out", held_out(F.col("doc_id")))


#: A text whose language has a smaller share of its letters is of no one language.
LEAST_SHARE = 0.4


def known_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: float = LEAST_SHARE) -> DataFrame:
    """The rows of docs in one known language, with their columns.

    A row goes if its text is null or has no letter, or if less than `least` of its letters are in spans of one language:
    texts of several languages, and texts in scripts that no learned language is written in. Rows with null ids or null
    labels are judged like any other, and each repeated row stays or goes alike. Without any label all rows go; an empty
    table gives none.
    """
    model = fit(docs.filter(~held_out(F.col(f"`{id_col}`"))), id_col, text_col, lang_col)
    held, place = (docs.sparkSession.sparkContext.broadcast(model) if model else None), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, place, PIECE_BYTES):
                lang, score, _ = _labels(text_strings(piece.column(place)), held)
                yield piece.filter(pa.array([x != UNKNOWN and s >= least for x, s in zip(lang.to_pylist(), score.to_pylist())], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
