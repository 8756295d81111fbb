"""I-Match document fingerprints, in DataFrame operations only.

Terms are lower-cased runs of letters and digits. The lexicon holds the terms whose inverse document frequency, over
distinct texts, lies in a band; it is split into randomised subsets of several sizes. For each subset, a document's distinct
terms in it are sorted and hashed. A document with terms, but none in the band, goes by all its terms. A fingerprint joins
these hashes; the likeness of two is the share of subsets, of those where either document has a term, in which they agree.
"""

from __future__ import annotations

import json
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.common import partitions

#: Band of document frequency, as shares of the distinct texts: inverse frequencies from ln 5 to ln 1000.
MOST, LEAST = 0.2, 0.001
#: Lists that the lexicon is held in; a term is looked up in one of them.
SLOTS = 1 << 15
#: Randomised subsets: a modulus of term hashes, and of how many residues there is a subset. The first is the lexicon.
#: Small subsets hold a term or two of a document, so that an edited half still leaves some of them alike.
SUBSETS = ((1, 1), (16, 4), (64, 16), (256, 32), (1024, 32))
#: Written for a subset in which a document has no term.
NONE = "-"
#: Ranges of ids for each shuffle partition, and edges of ranges that are read one after the other.
RANGES, CUT = 3, 32


def terms(text: Column) -> Column:
    """Hashes of the distinct terms of a text; null has none."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")
    return F.array_distinct(F.transform(words, lambda t: F.xxhash64(t)))


def lexicon(docs: DataFrame, text_col: str = "text") -> Column:
    """SLOTS lists of the hashes of the terms in the band, as one constant.

    A term counts once for each distinct text that has it: copies, however many, count as one text. Of all (text, term)
    pairs, a term in the band has at least LEAST times the number of texts: there are at most (mean number of distinct
    terms of a text) / LEAST such terms, whatever the number of texts. That bound, some 16 bytes a term, is what goes to
    the driver and executors. Texts are shuffled once, each task's copies as one; the total is counted by 96-bit hashes.
    """
    spark, text = docs.sparkSession, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    total = docs.select(F.xxhash64(text).alias("a"), F.hash(text).alias("b")).distinct().count()
    counts = docs.select(text).distinct().select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    band = counts.filter((F.col("n") >= LEAST * total) & (F.col("n") <= max(1.0, MOST * total)))
    slots = band.groupBy(F.pmod("term", F.lit(SLOTS)).alias("slot")).agg(F.array_sort(F.collect_list("term")).alias("held"))
    every = spark.range(SLOTS).join(slots, F.col("id") == F.col("slot"), "left").select("id", F.coalesce("held", F.array().cast("array<bigint>")).alias("held"))
    row = every.agg(F.array_sort(F.collect_list(F.struct("id", "held"))).alias("x")).select(F.to_json(F.transform("x", lambda s: s["held"])))
    return F.from_json(F.lit(row.head()[0]), "array<array<bigint>>")


def _held(terms_: Column, lexicon: Column) -> Column:
    return F.array_sort(F.filter(terms_, lambda h: F.array_contains(F.get(lexicon, F.pmod(h, F.lit(SLOTS)).cast("int")), h)))


def in_lexicon(text: Column, lexicon: Column) -> Column:
    """The text's distinct terms in the lexicon, sorted."""
    return _held(terms(text), lexicon)


def _residue(modulus: int) -> str:
    return f"cast(pmod(shiftright(h, 24), {modulus}) as int)"


def with_subset_hashes(rows: DataFrame, kept: str, out: str) -> DataFrame:
    """rows, with a hash for each subset of the lexicon, of the sorted terms of column kept in it; NONE where there is none."""
    # The terms of all subsets of a modulus are picked first; each subset is then picked from these few.
    rows = rows.withColumns({f"_of_{m}": F.expr(f"filter(`{kept}`, h -> {_residue(m)} < {n})") for m, n in SUBSETS})
    parts = []
    for modulus, n in SUBSETS:
        for r in range(n):
            parts.append(F.expr(f"filter(_of_{modulus}, h -> {_residue(modulus)} = {r})") if n > 1 else F.col(f"_of_{modulus}"))
    hashed = F.transform(F.array(*parts), lambda own: F.when(F.size(own) == 0, F.lit(NONE)).otherwise(F.right(F.lpad(F.hex(F.xxhash64(own)), 16, "0"), F.lit(6))))
    return rows.withColumn(out, hashed).drop(*[f"_of_{m}" for m, _ in SUBSETS])


def likeness(a: Column, b: Column) -> Column:
    """Share of subsets, of those where either has a term, in which two fingerprints agree; 1 for two without any term."""
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
    some = F.filter(pairs, lambda p: (p["a"] != NONE) | (p["b"] != NONE))
    same = F.filter(some, lambda p: p["a"] == p["b"])
    return F.when(F.size(some) == 0, F.lit(1.0)).otherwise(F.size(same) / F.size(some))


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "subsets", lexicon_: Column | None = None) -> DataFrame:
    """docs with column out: the fingerprint's parts. The lexicon is that of docs, if none is given.

    A text with terms, but none in the lexicon, goes by all its terms; it agrees with no text that has some in the lexicon.
    """
    held = lexicon(docs, text_col) if lexicon_ is None else lexicon_
    rows = docs.withColumn("_terms", terms(F.col(f"`{text_col}`"))).withColumn("_held", _held(F.col("_terms"), held))
    rows = rows.withColumn("_kept", F.when(F.size("_held") == 0, F.array_sort("_terms")).otherwise(F.col("_held")))
    return with_subset_hashes(rows, "_kept", out).drop("_terms", "_held", "_kept")


def _edges(docs: DataFrame, key: Column, n: int) -> list[tuple[int, int, int]]:
    """Lower edges of some n ranges of (has an id, id, hash of text), ascending.

    Ids' quantiles are edges; an id that is several of them, and the null id by its share, is cut evenly by the hash.
    """
    ids, all_, none = docs.agg(F.percentile_approx(key, [k / n for k in range(1, n)], 20 * n), F.count("*"), F.count_if(key.isNull())).head()
    often = Counter(ids or [])
    parts = [(0, 0, max(1, -(-n * none // max(1, all_))))] + [(1, i, m) for i, m in sorted(often.items())]
    return [(has, i, -(1 << 63) + (j << 64) // m) for has, i, m in parts for j in range(m)]


_RANK = "struct<has: int, id: bigint, hash: bigint>"


def _ranks(own: list) -> Column:
    named = lambda e: dict(zip(("has", "id", "hash"), e)) if e else None
    deep = bool(own) and isinstance(own[0], list)
    return F.from_json(F.lit(json.dumps([[named(e) for e in g] for g in own] if deep else [named(e) for e in own])), f"array<array<{_RANK}>>" if deep else f"array<{_RANK}>")


def _place(edges: list[tuple[int, int, int]], rank: Column) -> Column:
    """Number of the last edge that is not above a row's rank: a list of every CUTth edge is read, then the CUT after the one found."""
    below = lambda own: F.size(F.filter(own, lambda x: x <= rank))
    groups = [edges[k : k + CUT] for k in range(0, len(edges), CUT)]
    group = below(_ranks([g[0] for g in groups])) - 1
    return group * CUT + below(F.get(_ranks(groups), group)) - 1


def with_next(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    """docs with columns next_<c> for c in carry: those of the next row by descending id; the last row's next is the first.

    Rows are dealt to ranges of ids, equal and null ids also by hashes of their texts, each range a window of its own; a
    range also gets the first row of the next one. The ranges' edges and first rows' keys, a few for each shuffle
    partition, go through the driver. Nulls come last; equal ids go by the hashes of their texts.
    """
    key = F.col(id_col)
    edges = _edges(docs, key, RANGES * partitions(docs.sparkSession))
    rank = F.struct(key.isNotNull().cast("int").alias("has"), F.coalesce(key, F.lit(0).cast("long")).alias("id"), F.xxhash64(text_col).alias("hash"))
    placed = docs.withColumn("_rank", rank).withColumn("_range", _place(edges, F.col("_rank")))
    first = {r[0]: tuple(r[1]) for r in placed.groupBy("_range").agg(F.max("_rank")).collect()}
    order = sorted(first, reverse=True)
    before = {b: a for a, b in zip(order, order[1:])} | ({order[0]: order[-1]} if order else {})
    firsts = F.get(_ranks([first.get(k) for k in range(len(edges))]), F.col("_range"))
    to = F.get(F.lit([before.get(k, 0) for k in range(len(edges))]).cast("array<int>"), F.col("_range"))
    own = F.struct(F.col("_range").cast("int").alias("range"), F.lit(0).alias("copy"))
    rows = placed.withColumn("_at", F.explode(F.when(F.col("_rank") == firsts, F.array(own, F.struct(to.alias("range"), F.lit(1).alias("copy")))).otherwise(F.array(own))))
    rows = rows.withColumns({"_range": F.col("_at.range"), "_copy": F.col("_at.copy")}).drop("_at")
    window = Window.partitionBy("_range").orderBy("_copy", F.col("_rank").desc(), *[F.col(c) for c in carry])
    return rows.withColumns({f"next_{c}": F.lead(c).over(window) for c in carry}).filter("_copy = 0").drop("_range", "_copy", "_rank")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: a row for each row of docs.

    The edited text has the text's last floor(n_chars / 2) code points replaced by the first as many of the next document
    by descending id, and of equal ids by descending hash of text. Null counts as empty; texts without any term have a fingerprint of empty parts, and two such are
    alike (1). Texts with terms, but none in the band, go by all their terms. A table of one row is its own next. An empty table gives none.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    held = lexicon(rows)
    rows = with_next(fingerprints(rows, "text", "subsets", held), "doc_id", "text", ["text", "subsets"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half))).drop("text", "next_text")
    rows = fingerprints(rows, "edited", "edited_subsets", held)
    joined = lambda c: F.concat_ws(".", c)
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), joined("subsets").alias("fingerprint"), joined("edited_subsets").alias("edited_fingerprint"), likeness(F.col("subsets"), F.col("edited_subsets")).alias("near_edited"), likeness(F.col("subsets"), F.col("next_subsets")).alias("near_next"))
