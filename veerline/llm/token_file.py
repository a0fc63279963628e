"""Token ids in a static rANS file format: one frequency table, independent interleaved blocks, checksums."""

from __future__ import annotations

import codecs
import json
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, store

# Fixed values of the format: magic, bits of the frequency sum, lanes of a block, ids of a full block, ids between
# checkpoints, end id.
MAGIC, BITS, LANES, BLOCK, STEP, END = b"RNS2", 20, 2048, 1 << 19, 1 << 17, 0
LOW = np.uint64(1 << 31)
#: Pieces of text whose ids a task remembers; the library encodes all others.
MEMO = 1 << 20
#: Bytes of the longest of them, so that their number bounds the memory; longer ones seldom come again.
LONGEST = 64
#: Bytes of text that are encoded at once; a longer text alone.
CHUNK = 1 << 22
#: How a byte-level tokenizer cuts a text into pieces before it merges bytes (fixed value).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a sum of 2**BITS; every id that occurs keeps at least 1."""
    seen = counts > 0
    if not seen.any():
        return np.zeros(len(counts), "uint32")
    room = (1 << BITS) - int(seen.sum())
    if room <= 0:
        raise ValueError("more distinct ids than the frequencies can tell apart")
    scaled = np.floor(counts * (room / counts.sum())).astype("int64") + seen
    scaled[int(np.argmax(counts))] += (1 << BITS) - int(scaled.sum())
    return scaled.astype("uint32")


def encode_block(ids: np.ndarray, freq: np.ndarray) -> bytes:
    """Header (ids, lanes, words, checkpoints), the checkpoints, then the words of all lanes in turn.

    A checkpoint stands before every ``STEP``-th id: the place of the next word, the crc32 of the ids up to the
    next checkpoint, and the states of all lanes, so that a reader can start there.
    """
    lanes = min(LANES, max(1, len(ids)))
    start = np.concatenate([[0], np.cumsum(freq, dtype="uint64")[:-1]]).astype("uint64")
    freq = freq.astype("uint64")
    f, g, s = freq[ids], (np.uint64(1 << BITS) - freq)[ids], start[ids]
    state, words, points, sent = np.full(lanes, LOW, "uint64"), [], [], 0
    # A checkpoint stands before a full row of lanes.
    step = max(1, STEP // lanes) * lanes
    for at in range((max(0, len(ids) - 1) // lanes) * lanes, -1, -lanes):
        fi, gi, si = f[at : at + lanes], g[at : at + lanes], s[at : at + lanes]
        x = state[: len(fi)]
        full = x >= (fi << np.uint64(63 - BITS))
        words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4")[::-1])
        sent += len(words[-1])
        x = np.where(full, x >> np.uint64(32), x)
        # The same as (x // fi << BITS) + x % fi + si, with one division.
        state[: len(fi)] = x + x // fi * gi + si
        if at % step == 0:
            crc = zlib.crc32(ids[at : at + step].astype("<u4").tobytes())
            points.append((sent, crc, state.astype("<u8").tobytes()))
    out = np.concatenate(words)[::-1].astype("<u4") if words else np.zeros(0, "<u4")
    head = MAGIC + struct.pack("<IIII", len(ids), lanes, len(out), len(points))
    return head + b"".join(struct.pack("<II", len(out) - n, crc) + x for n, crc, x in reversed(points)) + out.tobytes()


def decode_block(data: bytes, freq: np.ndarray, symbols: np.ndarray, point: int | None = None) -> np.ndarray:
    """The ids of a block, or only those from a checkpoint up to the next."""
    if data[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    n, lanes, size, points = struct.unpack_from("<IIII", data, 4)
    wide, each = 8 + 8 * lanes, max(1, STEP // lanes) * lanes
    words = np.frombuffer(data, "<u4", size, 20 + points * wide).astype("uint64")
    start = np.concatenate([[0], np.cumsum(freq, dtype="uint64")[:-1]]).astype("uint64")
    freq = freq.astype("uint64")
    parts = []
    for k in range(points) if point is None else (point,):
        at, crc = struct.unpack_from("<II", data, 20 + k * wide)
        state = np.frombuffer(data, "<u8", lanes, 28 + k * wide).astype("uint64")
        ids = np.empty(max(0, min(n, (k + 1) * each) - k * each), "uint32")
        for first in range(0, len(ids), lanes):
            x = state[: min(lanes, len(ids) - first)]
            slot = x & np.uint64((1 << BITS) - 1)
            got = symbols[slot]
            ids[first : first + len(x)] = got
            x = freq[got] * (x >> np.uint64(BITS)) + slot - start[got]
            low = x < LOW
            more = int(low.sum())
            x[low] = (x[low] << np.uint64(32)) | words[at : at + more]
            at += more
            state[: len(x)] = x
        if zlib.crc32(ids.tobytes()) != crc:
            raise ValueError("checksum of a block of token ids")
        parts.append(ids)
    return np.concatenate(parts) if parts else np.zeros(0, "uint32")


def byte_letters() -> str:
    """The letters that stand for the bytes 0 to 255 in a byte-level vocabulary: printable ones for themselves."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(others)) for b in range(256))


#: Classes of bytes.
LETTER, DIGIT, MARK, QUOTE, SPACE, BREAK, WIDE = range(1, 8)


def byte_classes() -> np.ndarray:
    """The class of each byte: an ASCII letter, digit, mark, apostrophe, space or line break, else 0, above ASCII ``WIDE``."""
    classes = np.zeros(256, "uint8")
    for b in range(128):
        c = chr(b)
        kinds = [(c.isalpha(), LETTER), (c.isdigit(), DIGIT), (c == "'", QUOTE), (c == " ", SPACE), (c in "\t\n\v\f\r", BREAK), (33 <= b < 127, MARK)]
        classes[b] = next((kind for holds, kind in kinds if holds), 0)
    classes[128:] = WIDE
    return classes


CLASSES = byte_classes()
#: Whether a piece always ends between two bytes of these classes (first * 8 + second).
ENDS = np.array([
    a in (LETTER, DIGIT, MARK, QUOTE) and LETTER <= b <= BREAK and a != b and {a, b} != {MARK, QUOTE} and (a, b) != (QUOTE, LETTER)
    for a in range(8) for b in range(8)
])
#: White space above ASCII, by the UTF-8 bytes as numbers; none has four.
WIDE_SPACES = [int.from_bytes(chr(c).encode()) for c in range(128, 1 << 16) if chr(c).isspace()]


def cut_units(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Offsets of the units of texts, whose UTF-8 bytes stand one after the other; ``offsets`` are those of the texts.

    A unit is one piece or several, in whatever text it stands. A piece always ends where the class of ASCII
    characters changes, except after an apostrophe (``'s`` is a piece) and after white space, whose last character
    may belong to the next piece; before a space that something other than white space follows; and after a single
    line break.
    """
    cut = np.zeros(len(data) + 1, bool)
    kind = CLASSES[data]
    cut[1:-1] = ENDS[kind[:-1] << 3 | kind[1:]]
    followed = (kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != BREAK) & (kind[1:] != 0)
    at = np.flatnonzero(followed & (kind[1:] == WIDE))
    first, second, third = (data[np.minimum(at + k, len(data) - 1)].astype("int64") for k in (1, 2, 3))
    two = first << 8 | second
    followed[at[np.isin(two, WIDE_SPACES) | np.isin(two << 8 | third, WIDE_SPACES)]] = False
    # The last space of a text is followed by nothing.
    ends = offsets[1:][(offsets[1:] > 0) & (offsets[1:] < len(data))]
    followed[ends - 1] = False
    cut[:-2] |= followed
    word = (kind >= LETTER) & (kind <= QUOTE)
    cut[2:-1] |= word[:-2] & (kind[1:-1] == BREAK) & word[2:]
    cut[offsets] = True
    return np.flatnonzero(cut)


class Encoder:
    """Ids of whole texts by the tokenizers library, which encodes each distinct piece of text once.

    A byte-level tokenizer cuts a text into pieces by a pattern and encodes each on its own, so the ids of a text are
    those of its pieces. Many texts are first cut into units of whole pieces (``cut_units``) and the distinct units
    among them looked up; their ids are remembered, and only a unit that is not is cut into its pieces, as is the
    first unit of each text. A text is left to the library whole if it names a special token or holds a character
    that the library puts into another class than the pattern here does, and so are all texts of any other tokenizer.
    A full memory is no limit: what is not in it is encoded again.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        how = json.loads(self.library.to_str())
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        cut = how["pre_tokenizer"] or {}
        bare = all(how.get(k) is None for k in ("normalizer", "truncation", "padding"))
        self.by_piece = bare and all(cut.get(k) == v for k, v in plain.items())
        self.special = [t["content"].encode() for t in how["added_tokens"]]
        self.pattern, self.number = regex.compile(PIECES), regex.compile(r"\p{N}")
        self.letter, self.space = regex.compile(r"\p{L}"), regex.compile(r"\s")
        self.agreed: set[str] = set()
        self.differing: set[str] = set()
        #: Ids are kept as bytes, which are small and quickly joined.
        self.kind = "H" if self.size() <= 1 << 16 else "I"
        self.model = Tokenizer.from_file(path).model
        if how["model"]["type"] == "BPE":
            # It is only asked for what is not remembered, which its own cache seldom holds.
            self.model._resize_cache(0)
        self.letters = byte_letters()
        # Units and pieces, with the space before them.
        self.memo: dict[bytes, bytes] = {}

    def size(self) -> int:
        return self.library.get_vocab_size(with_added_tokens=True)

    def _agrees(self, c: str) -> bool:
        """Whether the library and the pattern put a character into the same class: letter, number, space or other."""
        alone = [len(self.library.pre_tokenizer.pre_tokenize_str(x + c)) == 1 for x in "a1!"]
        mine, space = [bool(self.letter.match(c)), bool(self.number.match(c))], bool(self.space.match(c))
        # Units are cut, and known to be one piece, by Python's classes.
        return alone == [*mine, not any(mine) and not space] and c.isalpha() == mine[0] and c.isspace() >= space

    def _same(self, text: bytes) -> bool:
        # Without the agreed ASCII characters, what is left of a text is UTF-8 as well.
        known = "".join(c for c in self.agreed if c.isascii()).encode()
        new = set(text.translate(None, known).decode()) - self.agreed
        if new:
            if new & self.differing:
                return False
            for c in new:
                (self.agreed if self._agrees(c) else self.differing).add(c)
        return not new & self.differing and not any(t in text for t in self.special)

    def _bytes(self, ids: list[int]) -> bytes:
        return array(self.kind, ids).tobytes()

    def _keep(self, name: bytes, ids: bytes) -> bytes:
        if len(self.memo) < MEMO and len(name) <= LONGEST:
            self.memo[name] = ids
        return ids

    def _library(self, piece: bytes) -> bytes:
        spelt, _ = codecs.charmap_decode(piece, "strict", self.letters)
        return self._bytes([t.id for t in self.model.tokenize(spelt)])

    def _piece(self, piece: str) -> bytes:
        name = piece.encode()
        found = self.memo.get(name)
        return self._keep(name, self._library(name)) if found is None else found

    def _pieces(self, text: str) -> bytes:
        return b"".join(map(self._piece, self.pattern.findall(text)))

    def _unit(self, unit: bytes) -> bytes:
        """The ids of a unit that is not remembered."""
        text = unit.decode()
        return self._keep(unit, self._library(unit) if text.removeprefix(" ").isalpha() else self._pieces(text))

    def _units(self, texts: pa.Array) -> pa.Array:
        """The ids of texts that are cut as the library cuts them."""
        offsets = np.frombuffer(texts.buffers()[1], "int32", len(texts) + 1, 4 * texts.offset)
        if not len(texts) or offsets[0] == offsets[-1]:
            return pa.array([b""] * len(texts), pa.binary())
        values, low = texts.buffers()[2], int(offsets[0])
        offsets = offsets - low
        places = cut_units(np.frombuffer(values, "uint8", int(offsets[-1]), low), offsets)
        units = pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer((places + low).astype("int32")), values])
        bounds = np.searchsorted(places, offsets)
        first = bounds[:-1][bounds[:-1] < bounds[1:]]
        later = np.ones(len(units), bool)
        later[first] = False
        rest = units.filter(pa.array(later)).dictionary_encode()
        names = rest.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.memo.get, names))
        for i in [i for i, ids in enumerate(found) if ids is None]:
            found[i] = self._unit(names[i])
        which = np.empty(len(units), "int64")
        which[later] = rest.indices.to_numpy()
        which[first] = np.arange(len(found), len(found) + len(first))
        found += [self._pieces(unit.decode()) for unit in units.take(pa.array(first)).to_pylist()]
        ids = pa.array(found, pa.binary()).take(pa.array(which))
        ends = np.frombuffer(ids.buffers()[1], "int32", len(ids) + 1, 4 * ids.offset)[bounds]
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends), ids.buffers()[2] or pa.py_buffer(b"")])

    def encode_all(self, texts: pa.Array) -> pa.Array:
        """The ids of each text as unsigned integers of ``kind``; a null is an empty text."""
        texts = texts.fill_null("").cast(pa.binary())
        if self.by_piece and self._same(b"".join(texts.to_numpy(zero_copy_only=False))):
            return self._units(texts)
        whole = np.array([not (self.by_piece and self._same(t)) for t in texts.to_pylist()], bool)
        left = [self.library.encode(t.decode(), add_special_tokens=False).ids for t in texts.filter(pa.array(whole)).to_pylist()]
        ids = pa.concat_arrays([self._units(texts.filter(pa.array(~whole))), pa.array(map(self._bytes, left), pa.binary())])
        return ids.take(pa.array(np.argsort(np.argsort(whole, kind="stable"))))

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_all(pa.array([text], pa.string()))[0].as_py(), self.kind).astype("int32")


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _tokenise(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    encoder = _encoder(path)
    end, wide = encoder._bytes([END]), np.dtype(encoder.kind).itemsize
    part, row, seen = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False), dtype="int64")
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + CHUNK, "right"))
            cut = batch.slice(at, max(1, upto - at))
            ids = pc.binary_join_element_wise(encoder.encode_all(cut.column(1)), end, b"")
            n = pc.binary_length(ids).to_numpy().astype("int64") // wide
            ends = seen + np.cumsum(n)
            k = len(ids)
            yield pa.RecordBatch.from_arrays(
                [cut.column(0), ids, pa.array(n), pa.array(np.full(k, part, "int32")),
                 pa.array(np.arange(row, row + k, dtype="int64")), pa.array(ends - n)],
                ["doc_id", "ids", "n_tokens", "part", "row", "before"],
            )
            at, row, seen = at + k, row + k, int(ends[-1])


def _tally(batches: Iterator[pa.RecordBatch], size: int, kind: str) -> Iterator[pa.RecordBatch]:
    total = np.zeros(size, "int64")
    for batch in batches:
        total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind), minlength=size)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])


def _write(batches: Iterator[pa.RecordBatch], freq: np.ndarray, kind: str) -> Iterator[pa.RecordBatch]:
    """Blocks of whole documents; a document above the block size fills several blocks of its own."""
    docs: list = []
    ids: list[np.ndarray] = []
    size, part = 0, None

    def block() -> pa.RecordBatch:
        flat = np.concatenate(ids)
        parts = [encode_block(flat[i : i + BLOCK], freq) for i in range(0, len(flat), BLOCK)]
        names = ["part", "first_row", "doc_ids", "before", "lengths", "blocks"]
        kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary())]
        key, rows, starts, sizes = zip(*docs)
        values = [part, rows[0], list(key), list(starts), list(sizes), parts]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    for batch in batches:
        values = batch.column(1)
        for i in range(batch.num_rows):
            one = np.frombuffer(values[i].as_buffer(), kind)
            home = batch.column(3)[i].as_py()
            if docs and (size + len(one) > BLOCK or home != part):
                yield block()
                docs, ids, size = [], [], 0
            part = home
            docs.append((batch.column(0)[i].as_py(), batch.column(4)[i].as_py(), batch.column(5)[i].as_py(), len(one)))
            ids.append(one)
            size += len(one)
    if docs:
        yield block()


def _read(batches: Iterator[pa.RecordBatch], freq: np.ndarray) -> Iterator[pa.RecordBatch]:
    symbols = np.repeat(np.arange(len(freq), dtype="uint32"), freq)
    for batch in batches:
        for row in batch.to_pylist():
            flat = np.concatenate([decode_block(b, freq, symbols) for b in row["blocks"]]).astype("<u4")
            ends = np.cumsum(row["lengths"])
            crc = [zlib.crc32(flat[e - n : e].tobytes()) for e, n in zip(ends, row["lengths"])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array([row["part"]] * len(crc), pa.int32()),
                 pa.array(row["before"], pa.int64()), pa.array(row["lengths"], pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "part", "before", "n_tokens", "ids_crc32"],
            )


def write_tokens(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The files: a table of blocks with all ids in ascending key order, and the shared table of frequencies.

    Both are stored, and nothing else is needed to read them. Null texts are empty and hold the end id only; null
    keys come first; rows with one key stand in the order of a hash of their texts, so that reruns agree, and equal
    rows are kept; an empty table gives no block. Documents are range-partitioned by key and hash; a partition's ids
    before each document are counted as they stream by. The frequencies have one row per id of the tokenizer.
    """
    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    ranged = narrow.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    schema = "doc_id long, ids binary, n_tokens long, part int, row long, before long"
    tokens = store(ranged.mapInArrow(partial(_tokenise, path=tokenizer), schema), "token-ids")
    size, kind = _encoder(tokenizer).size(), _encoder(tokenizer).kind
    counts = np.zeros(size, "int64")
    tally = tokens.select("ids").mapInArrow(partial(_tally, size=size, kind=kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    for row in tally.collect():
        counts[row["id"]] = row["n"]
    freq = frequencies(counts)
    rows = [(i, int(n), zlib.crc32(freq.tobytes())) for i, n in enumerate(freq)]
    table = store(docs.sparkSession.createDataFrame(rows, "id int, freq long, crc long").coalesce(1), "token-frequencies")
    columns = "part int, first_row long, doc_ids array<long>, before array<long>, lengths array<long>, blocks array<binary>"
    return store(tokens.mapInArrow(partial(_write, freq=freq, kind=kind), columns), "token-file"), table


def load_frequencies(table: DataFrame) -> np.ndarray:
    """The stored frequencies, one row per id of the tokenizer; damage is an error."""
    rows = table.orderBy("id").collect()
    freq = np.array([r["freq"] for r in rows], "uint32")
    if {r["crc"] for r in rows} - {zlib.crc32(freq.tobytes())} or [r["id"] for r in rows] != list(range(len(rows))):
        raise ValueError("checksum of the table of frequencies")
    return freq


def read_tokens(file: DataFrame, table: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, ``start``, ``n_tokens`` and ``ids_crc32``, blocks decoded in parallel.

    Null keys, repeated rows and rows with one key come back as they were written; files without blocks give no rows.
    """
    freq = load_frequencies(table)
    schema = "doc_id long, part int, before long, n_tokens long, ids_crc32 long"
    read = file.select("part", "doc_ids", "before", "lengths", "blocks").mapInArrow(partial(_read, freq=freq), schema)
    sums = file.select("part", F.expr("aggregate(lengths, 0L, (a, x) -> a + x)").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    parts = sums.groupBy("part").agg(F.sum("n").alias("n"))
    offset = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    joined = read.join(F.broadcast(offset), "part")
    return joined.select("doc_id", (F.col("before") + F.col("_offset")).alias("start"), "n_tokens", "ids_crc32")
