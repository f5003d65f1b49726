"""Token ids in files coded by a static range asymmetric numeral system.

One frequency table, counted over all ids, serves every file. A file image holds whole documents: a head, the documents' ids and lengths, a directory of
blocks, and the blocks' words. Blocks are independent. The ids of a block are dealt in turn to `LANES` interleaved coders that share one stream of 32-bit words; the directory has,
for each block, where its words start, the coders' states there (the checkpoint from which it decodes) and the checksum of its ids. So any block can be decoded
by itself, and all blocks of an image at once.

Images are rows of a table that Spark's writer commits, so a lost executor leaves no half-written file and any file system serves.

Image, little-endian: magic, version, bits, lanes, block size (u32 each); ids, documents, blocks, bytes of the document part (u64 each); checksums of the frequency table and of the
document part (u32); the document part, deflated: doc_id (i64), 1 if it isn't null (u8), length (u32) of each; for each block: first word (u64), words (u32), ids (u32), checksum (u32), states (u64 a lane); all words (u32).

Defined cases: null texts are empty, and an empty text has the end id alone; documents come in ascending doc_id, nulls first, ties by length and ids; an empty table gives
no image and an empty table; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm.common import cut, drop_scratch, portions, scratch_path

MAGIC, VERSION = 0x534E5251, 1
BITS, LANES, BLOCK = 18, 128, 1 << 15
#: Ids in an image, about.
IMAGE = 1 << 20
#: Words and other chunks between spaces of which a worker keeps the ids; those that come later are encoded each time.
CACHE = 700_000
#: Characters among which one is looked for that can stand between chunks.
SYMBOLS = range(0x2600, 0x27C0)
_HEAD = struct.Struct("<5I4Q2I")
_LEAST = np.uint64(1 << 31)


class Table:
    """Frequencies that sum to 2**bits; each id that occurs has one at least."""

    def __init__(self, counts: np.ndarray, bits: int = BITS) -> None:
        self.bits = bits
        used = np.flatnonzero(counts)
        if len(used) > 1 << bits:
            raise ValueError("more ids than the table has room for")
        freq = np.zeros(max(1, len(counts)), np.int64)
        if len(used):
            total = int(counts.sum())
            freq[used] = np.maximum(1, counts[used].astype(object) * (1 << bits) // total).astype(np.int64)
            rest = (1 << bits) - int(freq.sum())
            order = used[np.argsort(-freq[used], kind="stable")]
            while rest < 0:  # ids raised to one take from the frequent ones
                spare = np.minimum(freq[order] - 1, np.maximum(1, freq[order] * -rest // (1 << bits)))
                take = np.minimum(spare, np.maximum(0, -rest - (np.cumsum(spare) - spare)))
                freq[order] -= take
                rest += int(take.sum())
            freq[order[0]] += rest
        self.freq = freq.astype(np.uint64)
        self.cum = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
        self.crc = zlib.crc32(self.freq.astype("<u4").tobytes())


def encode_blocks(ids: np.ndarray, table: Table, lanes: int = LANES, block: int = BLOCK) -> tuple[list[int], np.ndarray, list[np.ndarray]]:
    """Ids in each block, states (blocks, lanes) and words of each block. All full blocks go through the coder side by side, then the last one."""
    full = len(ids) // block
    sizes, states, words = [block] * full, [], []
    if full:
        x, w = _coded(ids[: full * block].reshape(full, block // lanes, lanes), block, table)
        states.append(x)
        words += w
    if rest := len(ids) - full * block:
        grid = np.zeros(-(-rest // lanes) * lanes, np.int64)
        grid[:rest] = ids[full * block :]
        x, w = _coded(grid.reshape(1, -1, lanes), rest, table)
        states.append(x)
        words += w
        sizes.append(rest)
    return sizes, np.concatenate(states) if states else np.empty((0, lanes), np.uint64), words


def _coded(grid: np.ndarray, size: int, table: Table) -> tuple[np.ndarray, list[np.ndarray]]:
    k, steps, lanes = grid.shape
    x = np.full((k, lanes), _LEAST, np.uint64)
    words, owners = [], []
    bits, top, half = np.uint64(table.bits), np.uint64(63 - table.bits), np.uint64(32)
    for t in range(steps - 1, -1, -1):
        n = min(lanes, size - t * lanes)  # coders with an id in this step
        own, y = grid[:, t, :n], x[:, :n]
        f = table.freq[own]
        out = y >= f << top
        i, j = np.nonzero(out[:, ::-1])
        words.append((y[:, ::-1][i, j] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        owners.append(i)
        y = np.where(out, y >> half, y)
        q = y // f
        x[:, :n] = (q << bits) + (y - q * f) + table.cum[own]
    words, owners = np.concatenate(words)[::-1], np.concatenate(owners)[::-1]
    order = np.argsort(owners, kind="stable")
    return x, np.split(words[order], np.cumsum(np.bincount(owners, minlength=k))[:-1])


def decode_blocks(sizes: np.ndarray, states: np.ndarray, first: np.ndarray, words: np.ndarray, table: Table) -> list[np.ndarray]:
    """The ids of each block; first: where each block's words start."""
    out = {}
    for size in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == size)
        out |= zip(own.tolist(), _decoded(size, states[own], first[own], words, table), strict=True)
    return [out[i] for i in range(len(sizes))]


def _decoded(size: int, states: np.ndarray, first: np.ndarray, words: np.ndarray, table: Table) -> list[np.ndarray]:
    k, lanes = states.shape
    steps = -(-size // lanes)
    x, at = states.copy(), first.astype(np.int64)
    out = np.zeros((k, steps, lanes), np.uint32)
    mask, bits, half = np.uint64((1 << table.bits) - 1), np.uint64(table.bits), np.uint64(32)
    for t in range(steps):
        n = min(lanes, size - t * lanes)
        slot = x[:, :n] & mask
        s = table.symbol[slot]
        out[:, t, :n] = s
        y = table.freq[s] * (x[:, :n] >> bits) + slot - table.cum[s]
        i, j = np.nonzero(y < _LEAST)
        count = np.bincount(i, minlength=k)
        place = np.arange(len(i)) + np.repeat(at - (np.cumsum(count) - count), count)
        y[i, j] = (y[i, j] << half) | words[place].astype(np.uint64)
        x[:, :n] = y
        at = at + count
    return [out[i].ravel()[:size] for i in range(k)]


def write_image(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, table: Table) -> bytes:
    if len(ids) and (int(ids.max()) >= len(table.freq) or not table.freq[ids].all()):
        raise ValueError("an id that the frequency table lacks")
    sizes, states, words = encode_blocks(ids, table)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    docs = zlib.compress(np.array([d or 0 for d in doc_ids], "<i8").tobytes() + known.tobytes() + np.array(lengths, "<u4").tobytes(), 1)
    head = _HEAD.pack(MAGIC, VERSION, table.bits, LANES, BLOCK, len(ids), len(doc_ids), len(sizes), len(docs), table.crc, zlib.crc32(docs))
    parts, first = [head, docs], 0
    for i, n in enumerate(sizes):
        parts.append(struct.pack("<QIII", first, len(words[i]), n, zlib.crc32(ids[i * BLOCK : i * BLOCK + n].astype("<u4").tobytes())) + states[i].astype("<u8").tobytes())
        first += len(words[i])
    return b"".join([*parts, *[w.astype("<u4").tobytes() for w in words]])


def read_image(image: bytes, table: Table) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, lengths and ids of an image; raises ValueError if a checksum is wrong."""
    magic, version, bits, lanes, _, n, docs, blocks, size, table_crc, docs_crc = _HEAD.unpack_from(image)
    if magic != MAGIC or version != VERSION or bits != table.bits:
        raise ValueError("not an image of this format")
    at = _HEAD.size
    part = image[at : at + size]
    if table_crc != table.crc or docs_crc != zlib.crc32(part):
        raise ValueError("wrong checksum of the frequency table or the documents")
    part, at = zlib.decompress(part), at + size
    known = np.frombuffer(part, np.uint8, docs, 8 * docs)
    doc_ids = [d if k else None for d, k in zip(np.frombuffer(part, "<i8", docs).tolist(), known.tolist(), strict=True)]
    lengths = np.frombuffer(part, "<u4", docs, 9 * docs)
    if not blocks:
        return doc_ids, lengths, np.empty(0, np.uint32)
    kind = np.dtype([("first", "<u8"), ("words", "<u4"), ("ids", "<u4"), ("crc", "<u4"), ("states", "<u8", (lanes,))])
    index = np.frombuffer(image, kind, blocks, at)
    words = np.frombuffer(image, "<u4", offset=at + kind.itemsize * blocks)
    try:
        own = decode_blocks(index["ids"].astype(np.int64), index["states"].astype(np.uint64), index["first"], words, table)
    except IndexError as e:  # changed words can ask for more than there are
        raise ValueError("wrong checksum of a block") from e
    for got, crc in zip(own, index["crc"].tolist(), strict=True):
        if zlib.crc32(got.astype("<u4").tobytes()) != crc:
            raise ValueError("wrong checksum of a block")
    return doc_ids, lengths, np.concatenate(own)


class Chunks:
    """Ids of the chunks between spaces. The tokenizer drops white space and joins nothing across it, so a text's ids are those of its chunks.

    Chunks of letters, with a full stop or comma behind or not, are looked up by their lower-cased letters: these are one word to the tokenizer, whose
    last piece is marked as a word's end, so many new words are encoded as one text and cut apart again. Other new chunks are cut apart at a character between them that is one id and that none of them holds.
    A tokenizer of another kind encodes whole texts.
    """

    def __init__(self, path: str, kind: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind, self.by_chunk = kind, by_chunk(path)
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.mark, self.mark_id = self._mark()
        self.words: dict[str, int] = {}
        self.others: dict[str, int] = {}
        #: Ids of all entries, one after the other; where each entry's start, and how many it has.
        self.flat, self.start, self.count, self.n, self.used = np.empty(1 << 16, kind), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0, 0
        self.tail = [self._add(np.array([], kind), np.array([0])), self._one("."), self._one(",")]

    def _mark(self) -> tuple[str, int]:
        """A symbol that is one id by itself, of several the last one of the vocabulary; or none."""
        found = [("", -1)]
        for c in map(chr, SYMBOLS) if self.by_chunk else ():
            ids = self._ids(f"a {c} a")[1:-1].tolist()
            if len(ids) == 1 and self.ends[ids[0]] and unicodedata.normalize("NFC", c) == c:
                found.append((c, ids[0]))
        return max(found, key=lambda x: x[1])

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> int:
        """Number of the first of the entries added."""
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.empty_like(self.flat)))
        while self.n + len(sizes) > len(self.start):
            self.start, self.count = (np.concatenate((x, np.zeros_like(x))) for x in (self.start, self.count))
        own = slice(self.n, self.n + len(sizes))
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[own], self.count[own] = self.used + np.cumsum(sizes) - sizes, sizes
        self.n, self.used = self.n + len(sizes), self.used + len(ids)
        return own.start

    def _one(self, text: str) -> int:
        ids = self._ids(text)
        return self._add(ids, np.array([len(ids)]))

    def _entries(self, chunks: list[str], known: dict[str, int], add, keep: bool) -> np.ndarray:
        got = list(map(known.get, chunks))
        new = [c for c, k in zip(chunks, got, strict=True) if k is None]
        if new:
            at = self.n
            for lo in range(0, len(new), 2000):
                add(new[lo : lo + 2000])
            own = dict(zip(new, range(at, at + len(new)), strict=True))
            if keep:
                known.update(own)
            got = [own[c] if k is None else k for c, k in zip(chunks, got, strict=True)]
        return np.array(got, np.int64)

    def _add_words(self, words: list[str]) -> None:
        """Words of letters, in lower case."""
        ids = self._ids(" ".join(words))
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) == len(words) and cuts[-1] == len(ids):
            self._add(ids, np.diff(cuts, prepend=0))
        else:
            for w in words:
                self._one(w)

    def _add_others(self, chunks: list[str]) -> None:
        if self.mark and not any(self.mark in c for c in chunks):
            ids = self._ids("".join([f"{c} {self.mark} " for c in chunks]))
            cuts = np.flatnonzero(ids == self.mark_id)
            if len(cuts) == len(chunks):
                self._add(ids[ids != self.mark_id], np.diff(cuts, prepend=-1) - 1)
                return
        for c in chunks:
            self._one(c)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, where each text's ids end, and how often each id occurs."""
        texts = pc.fill_null(texts, "")
        if not self.by_chunk:
            each = [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            ids = np.concatenate([np.array([], self.kind), *each])
            return ids, np.cumsum(np.array(list(map(len, each)), np.int64)), np.bincount(ids, minlength=self.size).astype(np.int64)
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        own = split.values.dictionary_encode()
        at, chunks = own.indices.to_numpy(), own.dictionary
        simple = pc.match_substring_regex(chunks, _SIMPLE)
        plain = chunks.filter(simple)
        stems = pc.utf8_lower(pc.utf8_rtrim(plain, ".,")).dictionary_encode()
        keep, n, used = self.n < CACHE, self.n, self.used
        # each chunk is a word or something else, and a tail, which may be empty
        mask = simple.to_numpy(zero_copy_only=False)
        pairs = np.full((len(mask), 2), self.tail[0])
        pairs[mask, 0] = self._entries(stems.dictionary.to_pylist(), self.words, self._add_words, keep)[stems.indices.to_numpy()]
        pairs[~mask, 0] = self._entries(chunks.filter(pc.invert(simple)).to_pylist(), self.others, self._add_others, keep)
        pairs[mask, 1] = np.array(self.tail)[pc.ends_with(plain, ".").to_numpy(zero_copy_only=False) + 2 * pc.ends_with(plain, ",").to_numpy(zero_copy_only=False)]
        flat, ends = _gathered(self.flat, self.start, self.count, pairs.ravel())
        if not keep:
            self.n, self.used = n, used
        size = np.diff(ends[1::2], prepend=0)
        often = np.bincount(flat, np.repeat(np.bincount(at, minlength=len(size)), size), self.size).astype(np.int64)
        ids, ends = _gathered(flat, np.cumsum(size) - size, size, at)
        return ids, np.concatenate(([0], ends))[split.offsets.to_numpy()[1:] - split.offsets[0].as_py()], often


def by_chunk(path: str) -> bool:
    """Whether the tokenizer lower-cases, drops white space before it looks for pieces, keeps words of letters whole, and marks each word's last piece."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)

    def steps(part: dict | None, name: str) -> list[dict]:
        return [] if part is None else part[name] if part["type"] == "Sequence" else [part]

    normal, split, model = steps(spec["normalizer"], "normalizers"), steps(spec["pre_tokenizer"], "pretokenizers"), spec["model"]
    regex = split[0].get("pattern", {}).get("Regex", "") if split and split[0]["type"] == "Split" else ""
    return bool(
        [x["type"] for x in normal] == ["NFC", "Replace", "Lowercase"] and normal[1]["pattern"] == {"Regex": "\\s+"} and normal[1]["content"] == " "
        and "[\\p{L}]+|" in regex and regex.endswith("[^\\s\\p{L}\\p{N}]+") and split[0]["behavior"] == "Removed" and split[0]["invert"]
        and [x["type"] for x in split[1:]] == ["ByteLevel"] and not split[1]["add_prefix_space"] and not split[1]["use_regex"]
        and model["type"] == "BPE" and model.get("end_of_word_suffix") == "</w>" and not model.get("dropout")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or set(" \n") & set(t["content"]) for t in spec.get("added_tokens") or [])
    )


def _gathered(flat: np.ndarray, start: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of flat with the given starts and sizes in the order of at, joined, and where each ends."""
    each = size[at]
    ends = np.cumsum(each)
    return flat[np.repeat(start[at] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)], ends


_SIMPLE = "^[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]?$"


@cache
def chunks_of(path: str, kind: str) -> Chunks:
    """One table of chunks for each worker process; the tasks that it runs share it. (A function of the module, for workers get copies of the globals that inner functions name.)"""
    return Chunks(path, kind)


def _tokens(path: str, end: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = chunks_of(path, kind)
        width = np.dtype(kind).itemsize
        count = np.zeros(max(chunks.size, end + 1), np.int64)
        for b in batches:
            for part in portions(b, 1, b.num_rows, 8_000_000):
                flat, ends, often = chunks.encode(part.column(1))
                count[: chunks.size] += often
                count[end] += len(ends)
                flat = np.insert(flat, ends, end)
                ends = ends + np.arange(1, len(ends) + 1)
                ids = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.append(0, ends * width).astype(np.int32)), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(ends, prepend=0)), ids, pa.nulls(len(ends), pa.binary())], ["doc_id", "n", "ids", "counts"])
        # the task's counts are a row of their own
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([count.tobytes()], pa.binary())], ["doc_id", "n", "ids", "counts"])

    return run


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for x in b.column(0):
            total = np.frombuffer(x.as_py(), np.int64)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])


def _images(kind: str, table: Table, size: int = IMAGE):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list = []
        lengths: list[int] = []
        parts: list[bytes] = []
        held, start, own = 0, 0, TaskContext.get().partitionId()

        def image() -> pa.RecordBatch:
            made = write_image(docs, lengths, np.frombuffer(b"".join(parts), kind).astype(np.int64), table)
            return pa.RecordBatch.from_arrays([pa.array([own], pa.int32()), pa.array([start], pa.int64()), pa.array([held], pa.int64()), pa.array([made], pa.binary())], ["part", "start", "n", "image"])

        for b in batches:
            for d, n, x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                docs.append(d)
                lengths.append(n)
                parts.append(x)
                held += n
                if held >= size:
                    yield image()
                    start += held
                    docs, lengths, parts, held = [], [], [], 0
        if docs:
            yield image()

    return run


def _read(table: Table, starts: dict[int, int], with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                part, start, _, image = (c[k].as_py() for c in b.columns)
                docs, lengths, ids = read_image(image, table)
                ends = np.cumsum(lengths.astype(np.int64))
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                cols = [pa.array(docs, pa.int64()), pa.array(starts[part] + start + ends - lengths, pa.int64()), pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(cols, [f"c{i}" for i in range(len(cols))])

    return run


def tokenize(df: DataFrame, path: str, end: int, text: str = "text", doc_id: str = "doc_id", wide: bool = False) -> DataFrame:
    """(doc_id, n, ids, counts): each text's ids and the end id, as little-endian bytes of two a piece (wide: four), and a row of counts from each task."""
    return df.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(_tokens(path, end, "<u4" if wide else "<u2"), "doc_id long, n long, ids binary, counts binary")


def write(tokens: DataFrame, path: str, wide: bool = False) -> Table:
    """Writes tokenize()'s rows as images at path and returns the frequency table. wide: as in tokenize(), for ids above 65535."""
    rows = cut(tokens, "tokens")
    counted = rows.select("counts").where("counts IS NOT NULL").mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()  # as many rows as the vocabulary has ids
    counts = np.zeros(int(counted["id"].max()) + 1 if len(counted) else 1, np.int64)
    counts[counted["id"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    table = Table(counts)
    placed = rows.where("ids IS NOT NULL").select("doc_id", "n", "ids").repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "n", "ids")
    placed.mapInArrow(_images("<u4" if wide else "<u2", table), "part int, start long, n long, image binary").write.option("compression", "uncompressed").parquet(path)
    drop_scratch(rows)
    return table


def read(spark: SparkSession, path: str, table: Table, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) from the images at path."""
    images = spark.read.schema("part int, start long, n long, image binary").parquet(path)
    starts, upto = {}, 0
    for r in sorted(images.groupBy("part").agg(F.sum("n").alias("n")).collect()):  # one row for each partition written
        starts[r["part"]], upto = upto, upto + r["n"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return images.mapInArrow(_read(table, starts, with_ids), schema)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def round_trip(df: DataFrame, path: str, end: int = 1, with_ids: bool = False) -> DataFrame:
    """df's documents through files in the shared folder and back."""
    where = scratch_path(df.sparkSession, "images")
    return read(df.sparkSession, where, write(tokenize(df, path, end), where), with_ids)
