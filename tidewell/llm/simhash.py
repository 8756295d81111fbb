"""SimHash near-duplicates: exact search for fingerprints within a Hamming radius, by tiles.

Equal fingerprints are joined first. Two fingerprints that differ in at most RADIUS bits agree in one of RADIUS + 1 bands
of bits, so the distinct fingerprints are blocked by band value; inside a block, tiles sorted by population count are
compared with exclusive-or and bit counts, and pairs of tiles whose counts differ by more than the radius are skipped. A
block of more than HEAVY fingerprints is dealt out to tasks by pairs of larger tiles, which are cut again there. A tile pair yields the tree of its links
instead of all of them, so no group's links grow with its square, and connected components follow on the cluster.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.arrow import by_batch, text_bytes
from tidewell.llm.common import unused, written
from tidewell.llm.components import star_forest

RADIUS = 3
SHINGLE = 3
SEED = 42
BANDS, BAND_BITS = RADIUS + 1, 16
#: Rows of a tile, of a block that one task compares alone, and of the larger tiles that a heavier block is dealt out in.
TILE, HEAVY, DEALT = 1024, 16384, 32768
#: Bytes of a text whose shingles are hashed at once, about.
PIECE = 1 << 21

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of the text in turn, some PIECE bytes at a time: a very long text's words are never held at once."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + PIECE) if at + PIECE < len(text) else None
        end = cut.end() if cut else len(text)
        yield text[at:end].split()
        at = end


def simhash(text: bytes) -> int:
    """The 64-bit fingerprint of a UTF-8 text: a bit is set if it is set in over half the shingles' hashes."""
    held, n, counts, digest = [], 0, np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for words in _pieces(text.translate(_LOWER)):
        held += words
        if len(held) < SHINGLE:
            continue
        flat = b" ".join(held)
        ends = np.cumsum(np.fromiter(map(len, held), np.int64, len(held)) + 1)
        starts = np.concatenate(([0], ends[:-SHINGLE])).tolist()
        hashes = np.array([digest(flat[a:b], SEED) for a, b in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist())], np.dtype("<u8"))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
        held = held[1 - SHINGLE :]
    if not n:
        return digest(b" ".join(held), SEED) if held else 0
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def _hash_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    prints = np.array([simhash(t) for t in text_bytes(batch.column(1))], np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], ["doc_id", "bits"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, bits (the fingerprint as a signed long), a row for each row of docs."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(by_batch(_hash_batch), f"doc_id {dict(rows.dtypes)['doc_id']}, bits long")


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes that aren't their component's smallest, and that smallest, of links a-b between nodes 0 to n - 1."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        new = np.minimum(new, new[label])
        if np.array_equal(new, label):
            break
        label = new
    tied = np.flatnonzero(label != np.arange(n))
    return tied, label[tied]


def tile_links(left: np.ndarray, right: np.ndarray | None = None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Places of linked fingerprints in left and right (left with itself if None); both sorted by population count.

    The tiles' own trees stand for all links. With right, its places follow left's.
    """
    rows = left if right is None else np.concatenate((left, right))
    counts = np.bitwise_count(rows)
    edge = len(left)
    cuts = [*range(0, edge, TILE), *([] if right is None else range(edge, len(rows), TILE)), len(rows)]
    tiles = list(zip(cuts, cuts[1:]))
    us, vs = [], []
    for i, (a, b) in enumerate(tiles):
        for c, d in tiles[i:]:
            if right is not None and (c < edge or a >= edge):
                continue
            if int(counts[c:d].min()) - int(counts[a:b].max()) > radius or int(counts[a:b].min()) - int(counts[c:d].max()) > radius:
                continue
            x, y = np.nonzero(np.bitwise_count(rows[a:b, None] ^ rows[None, c:d]) <= radius)
            u, v = forest(x, y + (b - a if c != a else 0), b - a + (d - c if c != a else 0))
            place = np.concatenate((np.arange(a, b), np.arange(c, d) if c != a else np.empty(0, int)))
            us.append(place[u])
            vs.append(place[v])
    return (np.concatenate(us), np.concatenate(vs)) if us else (np.empty(0, int), np.empty(0, int))


def _block_links(key: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked fingerprints of whole blocks; rows sorted by key and population count."""
    us, vs = [], []
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.concatenate((start, [len(key)])))
    for s, n in zip(start[size > 32], size[size > 32]):
        u, v = tile_links(bits[s : s + n])
        us.append(bits[s + u])
        vs.append(bits[s + v])
    small = np.repeat(size <= 32, size)  # many blocks of a few rows: a tile is slid along itself
    key, bits, most = key[small], bits[small], size[size <= 32].max(initial=0)
    for k in range(1, most):
        hit = (key[k:] == key[:-k]) & (np.bitwise_count(bits[k:] ^ bits[:-k]) <= RADIUS)
        us.append(bits[k:][hit])
        vs.append(bits[:-k][hit])
    return (np.concatenate(us), np.concatenate(vs)) if us else (np.empty(0, np.uint64), np.empty(0, np.uint64))


def _edges(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.uint64).view(np.int64)) for x in (u, v)], ["u", "v"])


def _light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares blocks as they come, sorted; a block that goes on in the next batch waits for it."""
    key, bits = np.empty(0, np.int64), np.empty(0, np.uint64)
    for batch in batches:
        key = np.concatenate((key, batch.column(0).to_numpy(zero_copy_only=False)))
        bits = np.concatenate((bits, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
        cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
        if cut:
            yield _edges(*_block_links(key[:cut], bits[:cut]))
            key, bits = key[cut:], bits[cut:]
    if len(key):
        yield _edges(*_block_links(key, bits))


def _heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares the two tiles of each cell; rows come sorted by cell, side and population count."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    last = None

    def cell() -> Iterator[pa.RecordBatch]:
        side, bits = (np.concatenate(x) for x in zip(*held))
        left, right = bits[side == 0], bits[side == 1]
        u, v = tile_links(left, right if len(right) else None) if last[1] else tile_links(left)
        rows = np.concatenate((left, right))
        yield _edges(rows[u], rows[v])

    for batch in batches:
        cells, pair, side, bits = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        bits = bits.view(np.uint64)
        start = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
        for s, e in zip(start, [*start[1:], len(cells)]):
            if last is not None and cells[s] != last[0]:
                yield from cell()
                held.clear()
            last = (cells[s], bool(pair[s]))
            held.append((side[s:e], bits[s:e]))
    if held:
        yield from cell()


def links(prints: DataFrame) -> DataFrame:
    """u, v: trees of links between the distinct fingerprints (column bits) within RADIUS; every linked pair is connected."""
    mask = (1 << BAND_BITS) - 1
    keys = F.array(*[F.expr(f"(shiftrightunsigned(bits, {b * BAND_BITS}) & {mask}) * {BANDS} + {b}") for b in range(BANDS)])
    rows = prints.select("bits", F.bit_count("bits").alias("ones"), F.explode(keys).alias("key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).filter(f"n > {HEAVY}")
    sizes = written(sizes, "simhash-heavy")
    if sizes.isEmpty():
        light = rows
        heavy_links = None
    else:
        light = rows.join(sizes, "key", "left_anti")
        # Tiles of a heavy block: its fingerprints of one population count, in as many slots as keep a dealt tile within DEALT rows.
        rows = written(rows.join(sizes.select("key"), "key"), "simhash-heavy-rows")
        slots = rows.groupBy("key", "ones").agg(F.ceil(F.count("*") / DEALT).cast("int").alias("slots"))
        near = slots.select("key", F.explode(F.sequence(F.col("ones") - RADIUS, F.col("ones") + RADIUS)).alias("ones"), F.struct(F.col("ones").alias("p"), "slots").alias("tile"))
        near = near.join(slots, ["key", "ones"]).groupBy("key", "ones").agg(F.collect_list("tile").alias("tiles"), F.first("slots").alias("slots"))
        near = written(near, "simhash-tiles")
        dealt = rows.join(near, ["key", "ones"]).withColumn("slot", F.expr("cast(pmod(xxhash64(bits), slots) as int)"))
        dealt = dealt.withColumn("other", F.explode(F.expr("flatten(transform(tiles, t -> transform(sequence(0, t.slots - 1), s -> struct(t.p as p, s as s))))")))
        own, other = F.struct(F.col("ones").alias("p"), F.col("slot").alias("s")), F.col("other")
        dealt = dealt.select(F.xxhash64("key", F.least(own, other), F.greatest(own, other)).alias("cell"), (own != other).alias("pair"), F.when(own <= other, 0).otherwise(1).alias("side"), "bits", "ones")
        heavy_links = dealt.repartition("cell").sortWithinPartitions("cell", "side", "ones").drop("ones").mapInArrow(_heavy, "u long, v long")
    found = light.repartition("key").sortWithinPartitions("key", "ones").select("key", "bits").mapInArrow(_light, "u long, v long")
    return found if heavy_links is None else found.union(heavy_links)


def _classes(prints: DataFrame, least: Column) -> DataFrame:
    """bits, first: for each fingerprint of prints the smallest value of least in its component."""
    distinct = written(prints.groupBy("bits").agg(F.min(least).alias("least")), "simhash-distinct")
    roots = star_forest(links(distinct.select("bits"))).toDF("bits", "root")
    rooted = written(distinct.join(roots, "bits", "left").withColumn("root", F.coalesce("root", "bits")), "simhash-roots")
    first = written(rooted.groupBy("root").agg(F.min("least").alias("first")), "simhash-components")
    return written(rooted.join(first, "root").select("bits", "first"), "simhash-classes")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links), a row for each row.

    Null and empty texts and texts without words have fingerprint zero, linked like any other. Repeated rows each give
    a row of the same component. Null ids are kept and don't count for the smallest id. An empty table gives none.
    """
    prints = written(fingerprints(docs, id_col, text_col), "simhash")
    classes = _classes(prints, F.col("doc_id")).withColumnRenamed("first", "component_id")
    return prints.join(classes, "bits").select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay when each component keeps one row, with their columns: that of its smallest id.

    Null ids come last. Of a component's rows with that id, the one with the smallest hash of its text stays, and of rows
    alike in both, one. Null and empty texts are one component. An empty table gives none.
    """
    text = F.col(f"`{text_col}`")
    # Equal ids and texts have equal fingerprints, so that the pair names rows of one component.
    own = F.struct(F.col(f"`{id_col}`").isNull().alias("last"), F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("hash"))
    prints = written(fingerprints(docs.select(own.alias("own"), text.alias("text")), "own", "text").withColumnRenamed("doc_id", "own"), "simhash")
    first, rank, kept = unused(docs, "first", "rank", "kept")
    chosen = _classes(prints, F.col("own")).select(F.col("first").alias(kept)).distinct()
    plain = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    place = F.row_number().over(Window.partitionBy(first).orderBy(F.xxhash64(*plain)))
    # Repeated rows go before texts are shuffled, once, to where both the window and the join need them.
    single = docs.withColumn(first, own).withColumn(rank, place).filter(F.col(rank) == 1)
    return single.join(chosen, F.col(first) == F.col(kept), "left_semi").select(*[f"`{c}`" for c in docs.columns])
