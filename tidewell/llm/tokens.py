"""Token-ID output: a content-addressed store of chunks of id streams.

A task encodes its texts and appends END to each. A rolling hash over the ids cuts a document's stream into chunks, so
that equal passages give equal chunks; a chunk is addressed by the SHA-256 of its bytes. Tasks write the chunks that they
meet first to raw packs. One owner is chosen for each address on the cluster, and each raw pack is rewritten with the
chunks that it owns: a unique chunk is stored once, and only addresses and places are shuffled. A recipe has a document's
addresses in order and their Merkle root; recipes lie in ascending order of id, each with the number of ids before it,
and the manifest has a Merkle root for each part of the recipes, which together give the store's. Reading checks all of these.

Format. A pack is a row of blocks, each a zstd frame of chunks one after the other; a chunk is its ids as little-endian
unsigned integers, of 2 bytes, or of 4 where the vocabulary has ids beyond 65,535. `chunks` (Parquet) has address, pack, block
offset and length, place in the unpacked block and number of ids; pack P is the file P.pack, in hex. `recipes` (Parquet) has doc_id, start, n_tokens, root, the
addresses and the part, of PART ids each by start. `manifest` has each part's root and the width.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewell.llm.arrow import claim, pieces, text_strings
from tidewell.llm.common import partitions, prefix_sum, shared_path, written
from tidewell.llm.storage import create, open_input, remove

#: The id that ends a document.
END = 1
#: Ids of a part of the recipes, about; parts under one node of the store's tree.
PART, PARTS = 1 << 18, 1 << 14
#: Documents that begin with chunks of one place are read by one task if they lie within so many ids.
NEAR = 1 << 15
#: The rolling hash covers this many ids; a chunk ends where MASK_BITS of its bits are zero, or at MOST ids. Chunks of 128 ids
#: on average lie well below a usual document of some 600, so that documents share passages, not just whole texts.
ROLL, MASK_BITS, MOST = 16, 7, 2048
#: Unpacked bytes of a block, about. A pack goes on in a new file beyond PACK_BYTES.
BLOCK_BYTES, PACK_BYTES = 1 << 17, 1 << 28
LEVEL = 1
#: Words of up to KEPT_LETTERS characters, and blocks, that a worker keeps.
KEPT_WORDS, KEPT_LETTERS, KEPT_BLOCKS = 700_000, 48, 64

# Letters and digits of ASCII and Latin-1 as the tokenizer's pattern has them, in lower case.
_LETTER = "a-zß-öø-ÿ"
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^\\s{_LETTER}0-9]+")
#: Texts of these characters only are cut by _PIECE just as by the tokenizer itself; others are left to it as a whole.
_PLAIN = bytes(c for c in range(256) if c in b"\t\n\r" or 0x20 <= c <= 0x7E or c >= 0xC0 and c not in (0xD7, 0xF7))


def _plain(text: str) -> bool:
    try:
        return not text.encode("latin-1").translate(None, _PLAIN)
    except UnicodeEncodeError:
        return False


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(rest)}


class _Kept(dict):
    """Ids of words, found by the given function when a word is first asked for; long words aren't kept, nor more than most."""

    def __init__(self, find: Callable[[str], bytes], most: int) -> None:
        super().__init__()
        self.find, self.most = find, most

    def __missing__(self, word: str) -> bytes:
        ids = self.find(word)
        if len(word) <= KEPT_LETTERS:
            if len(self) >= self.most:
                self.clear()
            self[word] = ids
        return ids


# The steps of the tokenizer whose words are cut here. Texts of other tokenizers go to the library as a whole.
_STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


class Encoder:
    """Encodes texts by the tokenizers library. Of the tokenizer of _STEPS, a plain text's words are found once, and kept."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize  # each `.model` makes a new object
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        added = [x["content"] for x in parts.get("added_tokens") or []]
        self.by_word = all(parts.get(k) == v for k, v in _STEPS.items()) and not parts["model"].get("dropout") and all(x.startswith("<|") for x in added)
        self.letters, self.words, self.signs = _byte_letters(), _Kept(self._word, KEPT_WORDS), _Kept(self._piece, KEPT_WORDS // 8)
        self.width = width_of(self.tokenizer)
        self.end = self._packed([END])
        self.packed = [i.to_bytes(self.width, "little") for i in range(1 + max(self.tokenizer.get_vocab(with_added_tokens=True).values()))]

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, f"<u{self.width}").tobytes()

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        packed = self.packed
        return b"".join([packed[t.id] for t in self.tokenize(shown)])

    def _word(self, word: str) -> bytes:
        if word.isalpha():
            return self._piece(word)
        return b"".join([self.words[p] if p.isalpha() else self.signs[p] for p in _PIECE.findall(word)])

    def ids(self, text: str) -> bytes:
        """The text's ids and END, as little-endian unsigned integers of width bytes."""
        if not self.by_word or "<|" in text or not _plain(text):
            return self._packed([*self.tokenizer.encode(text, add_special_tokens=False).ids, END])
        return b"".join(map(self.words.__getitem__, text.lower().split())) + self.end


def width_of(tokenizer: Tokenizer) -> int:
    """Bytes of an id: 2 where all ids of the vocabulary fit, else 4."""
    return 2 if max(END, *tokenizer.get_vocab(with_added_tokens=True).values()) < 1 << 16 else 4


@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


_GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 1 << 16, np.uint32)


def cuts(ids: np.ndarray, lengths: list[int]) -> np.ndarray:
    """Ends of the chunks of streams of ids that follow each other; each stream's end is one.

    The rolling hash is the sum over the last ROLL ids of a random number for each pair of neighbours. A stream's first
    ROLL ids make no cut, so that a cut depends on the ids of its own stream alone, and but for the limit MOST on the ROLL
    ids before it.
    """
    ends = np.cumsum(lengths)
    gear = _GEAR[ids & 0xFFFF] ^ _GEAR[ids >> 16] if ids.dtype.itemsize > 2 else _GEAR[ids]
    pairs = gear.copy()
    pairs[1:] += gear[:-1] << np.uint32(1)
    total = np.cumsum(pairs, dtype=np.uint32)
    rolled = total[ROLL:] - total[:-ROLL]
    found = np.flatnonzero(rolled >> np.uint32(32 - MASK_BITS) == 0) + ROLL + 1
    own = np.searchsorted(ends, found, "left")  # a cut after the last id of a stream is its end
    found = found[found - (ends - lengths)[np.minimum(own, len(ends) - 1)] > ROLL + 1]
    found = np.union1d(found, ends)
    gaps = np.diff(found, prepend=0)
    wide = gaps > MOST
    if not wide.any():
        return found
    return np.union1d(found, np.concatenate([np.arange(e - g + MOST, e, MOST) for e, g in zip(found[wide], gaps[wide])]))


class Tree:
    """A binary hash tree over leaves as they come; an odd node goes up as it is. It holds one node of each full height."""

    def __init__(self) -> None:
        self.n, self.nodes = 0, []

    def add(self, leaf: bytes) -> None:
        self.n += 1
        k = self.n
        while not k & 1:
            leaf, k = _above(self.nodes.pop(), leaf), k >> 1
        self.nodes.append(leaf)

    def root(self) -> bytes:
        """No leaves: the hash of nothing."""
        return functools.reduce(lambda right, left: _above(left, right), reversed(self.nodes)) if self.nodes else hashlib.sha256(b"").digest()


def _above(left: bytes, right: bytes) -> bytes:
    return hashlib.sha256(b"\1" + left + right).digest()


def merkle(leaves: list[bytes]) -> bytes:
    """The root of leaves that are at hand, level by level."""
    if not leaves:
        return hashlib.sha256(b"").digest()
    digest = hashlib.sha256
    while (n := len(leaves)) > 1:
        leaves = [digest(b"\1" + a + b).digest() for a, b in zip(leaves[::2], leaves[1::2])] + leaves[n & ~1 :]
    return leaves[0]


_PLACE = "address: binary, pack: long, block: long, length: long, place: long, n: long"
_PLACE_KINDS = (("address", pa.binary()), ("pack", pa.int64()), ("block", pa.int64()), ("length", pa.int64()), ("place", pa.int64()), ("n", pa.int64()))


def pack_file(folder: str, pack: int) -> str:
    return f"{folder}/{pack:016x}.pack"


class _PackWriter:
    """Writes chunks to blocks of packs; a chunk's place is known when its block is full."""

    def __init__(self, folder: str, width: int) -> None:
        self.folder, self.width, self.out = folder, width, None
        self.pack, self.at, self.held, self.waiting = 0, 0, [], []
        self.places: list[list] = [[] for _ in _PLACE_KINDS]
        self.size, self.packer = 0, zstandard.ZstdCompressor(level=LEVEL)

    def add(self, address: bytes, data: bytes) -> None:
        self.waiting.append((address, self.size, len(data) // self.width))
        self.held.append(data)
        self.size += len(data)
        if self.size >= BLOCK_BYTES:
            self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        if self.out is None:
            self.pack, self.at = uuid.uuid4().int >> 65, 0
            self.out = create(pack_file(self.folder, self.pack))
        raw = self.packer.compress(b"".join(self.held))
        self.out.write(raw)
        addresses, places, sizes = zip(*self.waiting)
        n = len(addresses)
        for held, new in zip(self.places, (addresses, [self.pack] * n, [self.at] * n, [len(raw)] * n, places, sizes)):
            held += new
        self.at, self.held, self.waiting, self.size = self.at + len(raw), [], [], 0
        if self.at > PACK_BYTES:
            self.close()

    def close(self) -> None:
        self.flush()
        if self.out:
            self.out.close()
        self.out = None

    def taken(self) -> list[pa.Array]:
        """The places of chunks written since the last call, by column."""
        found, self.places = self.places, [[] for _ in _PLACE_KINDS]
        return [pa.array(x, kind) for x, (_, kind) in zip(found, _PLACE_KINDS)]


_ENCODED = f"doc_id long, n_tokens long, root binary, addresses array<binary>, places array<struct<{_PLACE}>>"


def _lists(sizes: list[int], values: pa.Array) -> pa.Array:
    """A list array of consecutive values, so many in each list."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), values)


def _encode(path: str, folder: str):
    names = ["doc_id", "n_tokens", "root", "addresses", "places"]

    def rows(docs: pa.Array, lengths: list[int], roots: list, addresses: list, sizes: list[int], places: list[pa.Array]) -> pa.RecordBatch:
        """The places that are known by now go with the last row."""
        held = pa.StructArray.from_arrays(places, [n for n, _ in _PLACE_KINDS])
        return pa.RecordBatch.from_arrays([docs, pa.array(lengths, pa.int64()), pa.array(roots, pa.binary()), _lists(sizes, pa.array(addresses, pa.binary())), _lists([0] * (len(lengths) - 1) + [len(held)], held)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("tokens", _encoder.cache_clear)
        encoder = _encoder(path)
        width, packs, met, digest = encoder.width, _PackWriter(folder, encoder.width), set(), hashlib.sha256
        for batch in batches:
            for piece in pieces(batch):
                streams = [encoder.ids(t) for t in text_strings(piece.column(1))]
                lengths = [len(x) // width for x in streams]
                data, at = b"".join(streams), 0
                ends = cuts(np.frombuffer(data, f"<u{width}"), lengths)
                addresses = []
                for end in (ends * width).tolist():
                    chunk, at = data[at:end], end
                    addresses.append(address := digest(chunk).digest())
                    if address not in met:
                        met.add(address)
                        packs.add(address, chunk)
                last = np.searchsorted(ends, np.cumsum(lengths)) + 1
                sizes = np.diff(last, prepend=0).tolist()
                roots = [addresses[b - 1] if n == 1 else merkle(addresses[b - n : b]) for b, n in zip(last.tolist(), sizes)]
                if len(met) > 1 << 20:  # a later copy is written again, and one of both is chosen as the owner
                    met.clear()
                yield rows(piece.column(0), lengths, roots, addresses, sizes, packs.taken())
        packs.close()
        if len((found := packs.taken())[0]):  # no document: the places that were left
            yield rows(pa.array([None], pa.int64()), [None], [None], [], [0], found)

    return run


class _Blocks:
    """Unpacked blocks, the last used ones kept; the files of the last used packs stay open."""

    def __init__(self, folder: str) -> None:
        self.folder = folder
        self.kept: dict[tuple, bytes] = {}
        self.files: dict[int, object] = {}
        self.unpacker = zstandard.ZstdDecompressor()
        self.last, self.data = None, b""

    def get(self, pack: int, block: int, length: int) -> bytes:
        key = (pack, block)
        if key == self.last:
            return self.data
        data = self.kept.pop(key, None)
        if data is None:
            file = self.files.pop(pack, None) or open_input(pack_file(self.folder, pack))
            self.files[pack] = file
            if len(self.files) > KEPT_BLOCKS:
                self.files.pop(next(iter(self.files))).close()
            file.seek(block)
            data = self.unpacker.decompress(file.read(length))
            if len(self.kept) >= KEPT_BLOCKS:
                del self.kept[next(iter(self.kept))]
        self.kept[key] = self.data = data
        self.last = key
        return data

    def close(self) -> None:
        for file in self.files.values():
            file.close()


def _compact(raw: str, folder: str, width: int):
    """Owned chunks, sorted by raw pack and place, to final packs; their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs, blocks, names = _PackWriter(folder, width), _Blocks(raw), [n for n, _ in _PLACE_KINDS]
        for batch in batches:
            numbers = [batch.column(c).to_numpy().tolist() for c in names[1:]]
            for address, pack, block, length, place, n in zip(batch.column(0).to_pylist(), *numbers):
                packs.add(address, blocks.get(pack, block, length)[place : place + n * width])
            yield pa.RecordBatch.from_arrays(packs.taken(), names)
        packs.close()
        blocks.close()
        yield pa.RecordBatch.from_arrays(packs.taken(), names)

    return run


def _remove(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack in batch.column(0).to_pylist():
                try:
                    remove(pack_file(folder, pack))
                except FileNotFoundError:  # an earlier attempt of this task has done it
                    pass
            yield batch

    return run


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts and roots in order, to the number of roots of each part and their Merkle root."""
    part, tree, out = None, Tree(), []
    for batch in batches:
        for own, root in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if own != part:
                if part is not None:
                    out.append((part, tree.n, tree.root()))
                part, tree = own, Tree()
            tree.add(root)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))], ["part", "n", "root"])
            out = []
    if part is not None:
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([tree.n], pa.int64()), pa.array([tree.root()], pa.binary())], ["part", "n", "root"])


def part_roots(rows: DataFrame, part: str = "part", order: str = "start") -> DataFrame:
    """part, n, root: a row for each part of rows with a root each, in the given order."""
    dealt = rows.repartition(part).sortWithinPartitions(part, order).select(F.col(part).cast("long").alias("part"), "root")
    return dealt.mapInArrow(_roots, "part long, n long, root binary")


def write_store(docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the store of all rows of docs to folder; tokenizer is the path of its file, the same on all machines.

    Null counts as empty: END alone. Rows with equal ids are separate documents, in order of their numbers of tokens and
    roots; null ids come first. An empty table gives an empty store.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    encoded = written(rows.mapInArrow(_encode(tokenizer, f"{folder}/raw"), _ENCODED), "tokens-encoded")

    places = encoded.select(F.explode("places").alias("p")).select("p.*")
    owned = places.groupBy("address").agg(F.min(F.struct("pack", "block", "length", "place", "n")).alias("p")).select("address", "p.*")
    owned = owned.repartition("pack").sortWithinPartitions("pack", "block", "place")
    width = width_of(Tokenizer.from_file(tokenizer))
    owned.mapInArrow(_compact(f"{folder}/raw", f"{folder}/packs", width), _PLACE.replace(":", "")).write.parquet(f"{folder}/chunks")
    places.select("pack").distinct().mapInArrow(_remove(f"{folder}/raw"), "pack long").write.parquet(f"{folder}/removed")

    order = [F.col("doc_id").asc_nulls_first(), F.col("n_tokens"), F.col("root")]
    recipes = prefix_sum(encoded.filter("root is not null").drop("places"), order, "n_tokens", "start", "tokens-recipes")
    ranged = recipes.repartitionByRange(partitions(spark), "start").sortWithinPartitions("start")
    ranged.withColumn("part", F.floor(F.col("start") / PART)).write.parquet(f"{folder}/recipes")
    part_roots(spark.read.parquet(f"{folder}/recipes")).withColumn("width", F.lit(width)).write.parquet(f"{folder}/manifest")


def store_root(manifest: DataFrame) -> str:
    """The Merkle root of the store as hex: that of the roots of PARTS parts each, which are found on the cluster."""
    groups = part_roots(manifest.withColumn("group", F.floor(F.col("part") / PARTS)), "group", "part")
    return merkle([bytes(r[0]) for r in groups.orderBy("part").select("root").collect()]).hex()


_READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _assemble(folder: str, width: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, digest = _Blocks(folder), hashlib.sha256
        for batch in batches:
            refs, crcs, streams, at = batch.column(batch.schema.get_field_index("refs")), [], [], 0
            flat, ends = refs.flatten(), (refs.offsets.to_numpy()[1:] - refs.offsets[0].as_py()).tolist()
            found = list(zip(*(flat.field(n).to_numpy().tolist() for n in ("pack", "block", "length", "place", "n"))))
            docs, starts, sizes, roots = (batch.column(k).to_pylist() for k in range(4))
            for doc, start, n, root, end in zip(docs, starts, sizes, roots, ends):
                chunks = [blocks.get(pack, block, length)[place : place + size * width] for pack, block, length, place, size in found[at:end]]
                at, data = end, b"".join(chunks)
                if merkle([digest(c).digest() for c in chunks]) != root or len(data) != n * width:
                    raise ValueError(f"document {doc} at {start}: its chunks don't have its recipe's root")
                wide = np.frombuffer(data, f"<u{width}").astype("<u4")
                crcs.append(zlib.crc32(wide))
                if with_ids:
                    streams.append(wide)
            if crcs:
                ids = [_lists(sizes, pa.array(np.concatenate(streams), pa.int64()))] if with_ids else []
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crcs, pa.int64()), *ids], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + with_ids])
        blocks.close()

    return run


def read_store(spark, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked for, ids of each document, read from the store and checked.

    Documents are read near the pack that has their first chunk, those far apart in order by different tasks, so that a chunk
    that begins very many documents brings them to no one task; other chunks come from their own packs' blocks.
    """
    recipes, chunks = spark.read.parquet(f"{folder}/recipes"), spark.read.parquet(f"{folder}/chunks")
    said, found = spark.read.parquet(f"{folder}/manifest"), part_roots(recipes)
    wrong = said.join(found.toDF("part", "n_", "root_"), "part", "full_outer").filter("not (n <=> n_ and root <=> root_)")
    width = said.agg(F.max("width")).head()[0] or 2
    if not wrong.isEmpty():
        raise ValueError(f"{folder}: the recipes don't have the manifest's roots")
    # A document's own columns go with its first chunk; start names the document, as each has an id at least.
    refs = recipes.select("start", "doc_id", "n_tokens", "root", F.posexplode("addresses").alias("seq", "address"))
    refs = refs.select("start", "seq", "address", *[F.when(F.col("seq") == 0, F.col(c)).alias(c) for c in ("doc_id", "n_tokens", "root")])
    refs = refs.join(chunks, "address").select("start", "doc_id", "n_tokens", "root", F.struct("seq", "pack", "block", "length", "place", "n").alias("ref"))
    own = [F.max(c).alias(c) for c in ("doc_id", "n_tokens", "root")]
    whole = refs.groupBy("start").agg(*own, F.array_sort(F.collect_list("ref")).alias("refs")).select("doc_id", "start", "n_tokens", "root", "refs")
    home, area = F.col("refs")[0]["pack"], F.floor(F.col("refs")[0]["block"] / (8 << 20))
    near = whole.withColumns({"_pack": home, "_area": area, "_block": F.col("refs")[0]["block"], "_part": F.floor(F.col("start") / NEAR)}).repartition("_pack", "_area", "_part").sortWithinPartitions("_pack", "_block", "start")
    return near.drop("_pack", "_area", "_block", "_part").mapInArrow(_assemble(f"{folder}/packs", width, with_ids), _READ + ", ids array<long>" * with_ids)


def round_trip(docs: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """read_store() of write_store()."""
    folder = folder or shared_path(docs.sparkSession, "tokens")
    write_store(docs, tokenizer, folder, id_col, text_col)
    return read_store(docs.sparkSession, folder)
