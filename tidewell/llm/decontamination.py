"""Benchmark decontamination: one Aho-Corasick automaton over the words of all benchmark items scans each text once.

Texts and items are normalised alike: A-Z lower-cased, words are runs of ASCII letters, digits and all characters beyond
ASCII. A window is 13 consecutive words of an item, or a whole item of fewer words. Words of the benchmark are numbered, and
the automaton reads numbers. Its keys are an item's anchors, the seven words at every seventh place, and whole shorter
items: a window always holds an anchor, and takes one node a benchmark word instead of 13. Where an anchor occurs, the match
is extended to both sides; from 13 words on, all its words are hit. Places of words give offsets of the original text.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.arrow import by_batch, claim, text_bytes
from tidewell.llm.common import unused, written

WINDOW = 13
#: Words of an anchor: any WINDOW consecutive words hold a whole one.
ANCHOR = (WINDOW + 1) // 2
#: A document is contaminated when at least one word in 20 is hit.
SHARE = 20
#: Words of benchmark items in one automaton, about: each takes some 100 bytes of memory in each Python worker.
AUTOMATON_WORDS = 4 << 20

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass
class Items:
    """Some of the benchmark: the words of different items, one after the other, and the ids of each."""

    key: str
    words: list[bytes]
    sizes: list[int]
    ids: list[tuple[str, ...]]


class Matcher:
    """The automaton over the anchors of items, and the items' words as numbers; 0 is any other word."""

    def __init__(self, items: Items) -> None:
        self.number = {w: k for k, w in enumerate(dict.fromkeys(items.words), 1)}
        self.ids = items.ids
        flat = [self.number[w] for w in items.words]
        self.own, at, keys = [], 0, {}
        for k, n in enumerate(items.sizes):
            own, at = flat[at : at + n], at + n
            self.own.append(own)
            if n < WINDOW:
                keys.setdefault(tuple(own), []).append((k, -1))
            else:
                for i in range(0, n - ANCHOR + 1, ANCHOR):
                    keys.setdefault(tuple(own[i : i + ANCHOR]), []).append((k, i))
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, places in keys.items():
            self.machine.add_word(key, (len(key), places))
        self.machine.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Places of the hit words, and the ids of the items whose windows occur."""
        get = self.number.get
        read = tuple([get(w, 0) for w in words])
        if not any(read) or not self.own:
            return np.empty(0, np.int64), set()
        edges, found, done = np.zeros(len(words) + 1, np.int64), set(), {}
        for end, (n, places) in self.machine.iter(read):
            start = end - n + 1
            for k, i in places:
                if i < 0:  # a whole item
                    a, b = start, end + 1
                else:
                    own, shift = self.own[k], start - i  # the text's place of the item's first word
                    if done.get((k, shift), -1) > start:
                        continue  # an earlier anchor's match goes on over this one
                    a, b = start, end + 1
                    while a > 0 and a > shift and read[a - 1] == own[a - 1 - shift]:
                        a -= 1
                    last = min(len(read), shift + len(own))
                    while b < last and read[b] == own[b - shift]:
                        b += 1
                    done[k, shift] = b
                    if b - a < WINDOW:
                        continue
                edges[a] += 1
                edges[b] -= 1
                found.add(k)
        return np.flatnonzero(np.cumsum(edges[:-1]) > 0), {x for k in found for x in self.ids[k]}


@functools.lru_cache(maxsize=1)
def _matcher(key: str, held: Broadcast) -> Matcher:
    """The matcher of broadcast items; kept by a worker for its later tasks."""
    return Matcher(held.value)


def word_offsets(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Code-point offsets of the words in the original text: starts, ends (exclusive)."""
    raw = np.frombuffer(text, np.uint8)
    word = np.frombuffer(text.translate(_FOLD), np.uint8) != 32
    edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return points[np.flatnonzero(edge == 1)], points[np.flatnonzero(edge == -1)]


def items_of(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Items]:
    """The benchmark's items in lists of some AUTOMATON_WORDS words; at least one. A null id counts as an empty one.

    Items are read one at a time, so that the driver holds one list. Items of the same words are one with several ids.
    """
    rows = benchmark.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.col(f"`{text_col}`")).filter(F.col(f"`{text_col}`").isNotNull())
    found: dict[tuple[bytes, ...], set[str]] = {}
    held = given = 0

    def done() -> Items:
        return Items(uuid.uuid4().hex, [w for own in found for w in own], [len(own) for own in found], [tuple(sorted(x)) for x in found.values()])

    for item, text in rows.toLocalIterator():
        words = words_of(text.encode())
        # A long item is cut into parts that have all its windows.
        for at in range(0, max(1, len(words) - WINDOW + 1) if words else 0, AUTOMATON_WORDS):
            own = tuple(words[at : at + AUTOMATON_WORDS + WINDOW - 1])
            held += 0 if own in found else len(own)
            found.setdefault(own, set()).add(item)
            if held > AUTOMATON_WORDS:
                yield done()
                found, held, given = {}, 0, given + 1
    if found or not given:
        yield done()


def _spans(text: bytes, hit: np.ndarray) -> list[dict]:
    if not len(hit):
        return []
    starts, ends = word_offsets(text)
    cut = np.flatnonzero(np.diff(hit) > 1)
    return [{"start": int(starts[a]), "end": int(ends[b])} for a, b in zip(hit[np.concatenate(([0], cut + 1))], hit[np.concatenate((cut, [len(hit) - 1]))])]


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_MARKS = (("words", pa.int64(), "long"), ("hits", pa.list_(pa.int64()), "array<long>"), ("items", pa.list_(pa.string()), "array<string>"), ("spans", pa.list_(_SPAN), "array<struct<start: long, end: long>>"))


def _marks(text: bytes, hit: np.ndarray, items: set[str], n: int) -> tuple:
    return n, hit, sorted(items), _spans(text, hit)


def marked(docs: DataFrame, benchmark: DataFrame, names: list[str], text_col: str = "text") -> DataFrame:
    """docs and the columns of _MARKS by the given names: number of words, places of hit words, items, runs of hit words as offsets.

    A benchmark within AUTOMATON_WORDS takes one pass. For a larger one, the rows are written once with a number; a pass
    for each list of items gives the numbers, places and items of the rows that are hit, and these are brought together by
    number before one last pass. A worker never holds more than one automaton.
    """
    spark, place = docs.sparkSession, docs.columns.index(text_col)
    marks = ", ".join(f"`{n}` {kind}" for n, (_, _, kind) in zip(names, _MARKS))
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(marks).fields])
    lists = items_of(benchmark)
    first, second = next(lists), next(lists, None)

    def scanned(items: Items):
        held = spark.sparkContext.broadcast(items)
        return lambda words: (claim("decontamination", _matcher.cache_clear), _matcher(held.value.key, held).scan(words))[1]

    def with_marks(batch: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
        own = [pa.array(x, kind) for x, (_, kind, _) in zip(zip(*found), _MARKS)] if found else [pa.array([], kind) for _, kind, _ in _MARKS]
        return pa.RecordBatch.from_arrays([*batch.columns[: len(schema) - len(own)], *own], schema.names)

    if second is None:
        scan = scanned(first)

        def mark(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = []
            for text in text_bytes(batch.column(place)):
                words = words_of(text)
                found.append(_marks(text, *scan(words), len(words)))
            return with_marks(batch, found)

        return docs.mapInArrow(by_batch(mark, place), schema)

    row, hits, items = unused(docs, "row", "hits", "items")
    docs = written(docs.withColumn(row, F.monotonically_increasing_id()), "decontamination")
    parts = None
    for own in (x for group in ((first, second), lists) for x in group):
        scan = scanned(own)

        def hit_rows(batch: pa.RecordBatch, scan=scan) -> pa.RecordBatch:
            found = [(k, *f) for k, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))) if len((f := scan(words_of(text)))[0])]
            return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.int64())), pa.array([sorted(f[2]) for f in found], pa.list_(pa.string()))], [row, hits, items])

        part = written(docs.select(row, f"`{text_col}`").mapInArrow(by_batch(hit_rows), f"`{row}` long, `{hits}` array<long>, `{items}` array<string>"), "decontamination-hits")
        parts = part if parts is None else parts.union(part)
    joined = parts.groupBy(row).agg(F.array_distinct(F.flatten(F.collect_list(hits))).alias(hits), F.array_distinct(F.flatten(F.collect_list(items))).alias(items))

    def bring(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for text, own, names_ in zip(text_bytes(batch.column(place)), batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
            found.append(_marks(text, np.array(sorted(own or ()), np.int64), set(names_ or ()), len(words_of(text))))
        return with_marks(batch, found)

    rows = docs.join(joined, row, "left").select(*[f"`{f.name}`" for f in schema.fields[: len(schema) - len(_MARKS)]], hits, items)
    return rows.mapInArrow(by_batch(bring, place), schema)


def _contaminated(words: str, hits: str) -> str:
    return f"size(`{hits}`) > 0 and {SHARE} * size(`{hits}`) >= `{words}`"


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hit_spans.

    hit_spans are runs of hit words as code-point offsets of the original text, end exclusive. Null and empty texts have
    no words and are not contaminated. An empty benchmark hits nothing. Repeated rows each give a row.
    """
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    names = [n for n, _, _ in _MARKS]
    sha = F.sha2(F.concat_ws(",", F.array_sort("items")), 256)
    return marked(own, benchmark, names).select("doc_id", F.col("words").alias("n_words"), F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), sha.alias("items_sha256"), F.expr(_contaminated("words", "hits")).alias("contaminated"), F.col("spans").alias("hit_spans"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs that are not contaminated, with their columns.

    Null and empty texts stay, as they have no words; with an empty benchmark all rows stay. Each repeated row is judged
    alike. An empty table gives none. Columns may have any names.
    """
    names = unused(docs, *[n for n, _, _ in _MARKS])
    return marked(docs, benchmark, names, text_col).filter(f"not ({_contaminated(names[0], names[1])})").select(*[f"`{c}`" for c in docs.columns])
