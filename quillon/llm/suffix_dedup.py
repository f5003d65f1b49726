"""Removal of repeated passages: a radix sort of all suffixes, most significant digits first, that stops at the threshold length.

A text's suffixes of `length` bytes or more are the windows of that many bytes that start at each place; windows that are equal to the
end of the sort are the repeated ones. A radix sort may read a key's digits in any order that is the same for equal keys, and this one reads first what the window says of
itself: where its least hash of `WORD` bytes is, and that hash. Neighbouring windows share this first digit, so a run of them is one row, and the first pass deals
runs instead of windows. In a bucket, runs whose whole text is equal are repeated at once, one stands for all, and runs alone in their bucket leave. The windows of
the others are sorted by the following digits, of a quarter of the length each; a group leaves as soon as it has one window.

Buckets with more than a thousandth of all runs aren't dealt to a task: their equal runs are counted by Spark's aggregation. Buckets of more than `WIDE` different runs aren't sorted in one task: their windows are dealt by all digits at once.

Digits after the first are 64-bit fingerprints of their bytes. Defined cases: null texts are empty; texts shorter than the length lose nothing; rows of one doc_id with the same text
count as two documents, as do rows without an id; no ties can arise, for all copies lose their bytes; an empty table gives an empty table; other columns pass through, whatever their names, unless they are named as a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import MAP_IDS, bit_map, cut, drop_scratch, in_map, name, packed, portions, split_join, unpacked, with_fields
from quillon.llm.ngram_join import mix

#: Bytes of the substrings whose least hash is the first digit.
WORD = 32
#: Digits after the first.
DIGITS = 4
#: Longer texts are looked at in portions that overlap by a window; a power of two.
PORTION = 1 << 18
#: Different runs in a bucket beyond which its windows are dealt to many tasks.
WIDE = 20_000
#: Runs in a bucket, at least, beyond which it may count as hot.
HOT = 100_000
_LOW = np.uint64(PORTION * 2 - 1)


class Prints:
    """Fingerprints of substrings by sums over prefixes, modulo 2**64."""

    def __init__(self, seed: int, size: int) -> None:
        rng = np.random.default_rng(seed)
        self.of = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(1, 1 << 61)) * 8 + 5
        self.up, self.down = self._powers(base, size), self._powers(pow(base, -1, 1 << 64), size)

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        x = np.full(size, base, np.uint64)
        x[0] = 1
        return np.multiply.accumulate(x)

    def sums(self, b: np.ndarray) -> np.ndarray:
        s = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(self.of[b] * self.up[: len(b)], out=s[1:])
        return s

    def at(self, sums: np.ndarray, lo: np.ndarray | slice, hi: np.ndarray | slice) -> np.ndarray:
        return (sums[hi] - sums[lo]) * self.down[lo]


def runs(b: np.ndarray, length: int, first: Prints, whole: Prints) -> tuple[np.ndarray, ...]:
    """Runs of windows with one first digit: (digit, fingerprint, first window, windows, place of the digit in the first window)."""
    n, w = len(b), length - WORD + 1
    s1, s2 = first.sums(b), whole.sums(b)
    k = n - WORD + 1
    h = mix(first.at(s1, slice(0, k), slice(WORD, n + 1)))
    key = (h & ~_LOW) | np.arange(k, dtype=np.uint64)
    pad = np.full(-(-k // w) * w, np.iinfo(np.uint64).max, np.uint64)
    pad[:k] = key
    blocks = pad.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - length + 1
    least = (np.minimum(right[:m], left[w - 1 : w - 1 + m]) & _LOW).astype(np.int64)
    lo = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    count = np.diff(np.append(lo, m))
    p = least[lo]
    full = mix(whole.at(s2, lo, lo + count + length - 1) + count.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return h[p].view(np.int64), full.view(np.int64), lo, count, p - lo


def _bytes(t: str | None) -> bytes:
    return (t or "").encode("utf-8", "surrogatepass")


def _find(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, whole = Prints(1, PORTION + length + 1), Prints(2, PORTION + length + 1)
        for batch in batches:
            for part in portions(batch, 2, 500):
                cols: list[list[np.ndarray]] = [[] for _ in range(7)]
                for d, h, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    b = np.frombuffer(_bytes(t), np.uint8)
                    for lo in range(0, max(0, len(b) - length + 1), PORTION):
                        got = runs(b[lo : lo + PORTION + length - 1], length, first, whole)
                        one = np.ones(len(got[0]), np.int64)
                        for c, x in zip(cols, (got[0], got[1], one * d, one * h, got[2] + lo, got[3], got[4]), strict=True):
                            c.append(x)
                if cols[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)).cast(k) for c, k in zip(cols, _RUN_TYPES, strict=True)], list(_RUN))

    return run


_RUN = {"a": "long", "f": "long", "d": "long", "t": "long", "lo": "int", "c": "int", "o": "int"}
_RUN_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
_RUN_SCHEMA = ", ".join(f"{k} {v}" for k, v in _RUN.items())


def _first_pass(most: int = 1 << 18):
    """Of runs sorted by (a, f): all that occur twice (kind 0), and one of each different run of buckets with several (kind 1, or 2 if it occurs twice). A task holds at most the rows of a batch and `most` more, whatever the size of a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[np.ndarray] | None = None
        wide: int | None = None  # a bucket that is known to have several runs

        def told(x: list[np.ndarray]) -> pa.RecordBatch:
            a, f = x[0], x[1]
            new_a = np.concatenate(([True], a[1:] != a[:-1]))
            new = new_a | np.concatenate(([True], f[1:] != f[:-1]))
            group, bucket = np.cumsum(new) - 1, np.cumsum(new_a) - 1
            twice = np.bincount(group)[group] > 1
            several = np.bincount(bucket[new])[bucket] > 1
            if wide is not None:
                several |= a == wide
            rows = np.concatenate((np.flatnonzero(twice), np.flatnonzero(new & several)))
            kind = np.concatenate((np.zeros(int(twice.sum()), np.int32), np.where(twice[new & several], 2, 1).astype(np.int32)))
            return pa.RecordBatch.from_arrays([pa.array(c[rows]) for c in x] + [pa.array(kind)], [*_RUN, "kind"])

        for batch in batches:
            own = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(own[0]):
                continue
            cols = own if cols is None else [np.concatenate(x) for x in zip(cols, own, strict=True)]
            last = int(np.searchsorted(cols[0], cols[0][-1]))
            if last:
                yield told([c[:last] for c in cols])
                cols = [c[last:] for c in cols]
            if len(cols[0]) > most:
                last = int(np.searchsorted(cols[1], cols[1][-1]))
                if last:  # several runs, and all of them but the last are complete
                    wide = int(cols[0][0])
                    yield told([c[:last] for c in cols])
                    cols = [c[last:] for c in cols]
                if len(cols[0]) > 2:  # one run that occurs often: two rows of it stay in mind
                    yield pa.RecordBatch.from_arrays([pa.array(c[2:]) for c in cols] + [pa.array(np.zeros(len(cols[0]) - 2, np.int32))], [*_RUN, "kind"])
                    cols = [c[:2] for c in cols]
        if cols is not None and len(cols[0]):
            yield told(cols)

    return run


def _marked(at: int, bits, marked: bool = True):
    """The rows whose id may be in the map, or the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([in_map(bits.value, d) == marked for d in batch.column(at).to_pylist()], pa.bool_()))

    return run


def _texts(length: int):
    """Rows (a, d, t, lo, c, o, kind, own): the bytes of the runs listed beside each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 2, 200):
                out = []
                for d, h, t, found in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    b = _bytes(t)
                    out += [(r["a"], d, h, r["lo"], r["c"], r["o"], r["kind"], b[r["lo"] : r["lo"] + r["c"] + length - 1]) for r in found]
                for lo in range(0, len(out), 5000):
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out[lo : lo + 5000], strict=True), _TEXT_TYPES, strict=True)], list(_TEXT))

    return run


_TEXT = {"a": "long", "d": "long", "t": "long", "lo": "int", "c": "int", "o": "int", "kind": "int", "own": "binary"}
_TEXT_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
_TEXT_SCHEMA = ", ".join(f"{k} {v}" for k, v in _TEXT.items())


def _windows(rows: list[tuple], length: int, prints: Prints) -> tuple[np.ndarray, ...]:
    """Of all windows of the runs: row, number in the run, group by the first digit, and the start of each in the joined bytes with their sums."""
    c = np.array([r[4] for r in rows])
    row = np.repeat(np.arange(len(rows)), c)
    starts = np.cumsum([0, *[len(r[7]) for r in rows[:-1]]])
    j = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
    sums = prints.sums(np.frombuffer(b"".join([r[7] for r in rows]), np.uint8))
    a = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    o = np.array([r[5] for r in rows])
    group = mix(a[row] * np.uint64(0x9E3779B97F4A7C15) + (o[row] - j).astype(np.uint64))
    return row, j, group, starts[row] + j, sums


def _digit_passes(length: int, size: int = 1 << 19):
    """Sorts the windows of the runs of whole buckets by one digit after the other; gives the bytes (d, t, s, e) that repeated windows cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = [Prints(3, 1), None]

        def sort(rows: list[tuple]) -> pa.RecordBatch | None:
            total = sum(len(r[7]) for r in rows)
            if len(prints[0].up) <= total:
                prints[0] = Prints(3, max(2 * size, total + 1))
            row, j, group, at, sums = _windows(rows, length, prints[0])
            live = np.arange(len(row))
            for x in range(DIGITS + 1):
                if x:
                    lo, hi = length * (x - 1) // DIGITS, length * x // DIGITS
                    group = mix(group[live] ^ mix(prints[0].at(sums, at[live] + lo, at[live] + hi)))
                    whole = np.zeros(len(row), np.uint64)
                    whole[live] = group
                    group = whole
                own = group[live]
                order = np.argsort(own, kind="stable")
                same = own[order][1:] == own[order][:-1]
                twice = np.zeros(len(order), bool)
                twice[order[1:]] |= same
                twice[order[:-1]] |= same
                live = live[twice]
                if not len(live):
                    return None
            kind = np.array([r[6] for r in rows])
            live = live[kind[row[live]] == 1]  # runs that occur twice as a whole are covered by now
            if not len(live):
                return None
            new = np.concatenate(([True], (np.diff(row[live]) != 0) | (np.diff(j[live]) > length)))
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(live)) - 1
            r, s = row[live[first]], j[live[first]]
            base = np.array([x[3] for x in rows])[r]
            pick = [rows[k] for k in r]
            return pa.RecordBatch.from_arrays([pa.array([x[1] for x in pick], pa.int64()), pa.array([x[2] for x in pick], pa.int64()), pa.array((base + s).astype(np.int32)), pa.array((base + j[live[last]] + length).astype(np.int32))], ["d", "t", "s", "e"])

        held: list[tuple] = []
        total = 0
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if total > size and r[0] != held[-1][0]:
                    out = sort(held)
                    if out is not None:
                        yield out
                    held, total = [], 0
                held.append(r)
                total += len(r[7])
        if held and (out := sort(held)) is not None:
            yield out

    return run


def _wide_windows(length: int):
    """Rows (x, y, z, d, t, s, kind): each window with its place in the sort, for buckets too wide for one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                rows = list(zip(*(c.to_pylist() for c in batch.slice(lo, 500).columns), strict=True))
                p = Prints(3, sum(len(r[7]) for r in rows) + 1)
                row, j, group, at, sums = _windows(rows, length, p)
                half = length // 2
                x, y = (p.at(sums, at, at + half), p.at(sums, at + half, at + length))
                d, t, base, kind = (np.array([r[k] for r in rows]) for k in (1, 2, 3, 6))
                yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)) for v in (group, x, y)] + [pa.array(d[row]), pa.array(t[row]), pa.array((base[row] + j).astype(np.int32)), pa.array(kind[row].astype(np.int32))], ["x", "y", "z", "d", "t", "s", "kind"])

    return run


def _result(keep_bytes: bool, spans_at: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 1, 500):
                cols: list[list] = [[] for _ in range(5)]
                for t, spans in zip(part.column(1).to_pylist(), part.column(spans_at).to_pylist() if spans_at else [()] * part.num_rows, strict=True):
                    b, merged = _bytes(t), []
                    for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
                        if merged and s <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], e)
                        else:
                            merged.append([s, e])
                    edges = [0, *[x for m in merged for x in m], len(b)]
                    left = b"".join([b[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2)])
                    for c, x in zip(cols, (len(b), len(b) - len(left), len(merged), hashlib.sha256(left).hexdigest(), left if keep_bytes else None), strict=True):
                        c.append(x)
                made = [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *made[: 4 + keep_bytes]], names=["_row", *MADE[: 4 + keep_bytes]])

    return run


MADE = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
_SPAN = "d long, t long, s int, e int"


def _key(doc_id: str, text: str) -> dict[str, Column]:
    """What tells texts apart: the id and a hash of the text; of rows without an id another hash."""
    t = F.col(name(text)).cast("string")
    return {"d": F.coalesce(F.col(name(doc_id)).cast("long"), F.xxhash64(F.lit(7), t)), "t": F.xxhash64(t), "text": t}


def repeated_bytes(df: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 400, wide: int = WIDE, hot: int = HOT) -> DataFrame:
    """(d, t, s, e): bytes s to e, exclusive, of the text with this key that windows repeated elsewhere cover; they may overlap."""
    spark = df.sparkSession
    docs = df.select(*[c.alias(n) for n, c in _key(doc_id, text).items()])
    found = cut(docs.mapInArrow(_find(length), _RUN_SCHEMA), "found")
    # buckets of more than a thousandth of all runs, fewer than 1000, count as such with several: their runs are aggregated, not dealt to a task
    total = found.count()
    large = [r["a"] for r in found.groupBy("a").agg(F.count("*").alias("n")).where(F.col("n") > max(hot, total / 1000)).collect()]
    rest = found.where(~F.col("a").isin(large)) if large else found
    sifted = rest.repartition("a").sortWithinPartitions("a", "f").mapInArrow(_first_pass(), f"{_RUN_SCHEMA}, kind int")
    if large:
        held = found.where(F.col("a").isin(large))
        groups = held.groupBy("a", "f").agg(F.min(F.struct(*list(_RUN)[2:])).alias("x"), F.count("*").alias("n"))
        twice = split_join(held, groups.where("n > 1").select("a", "f", "n"), ["a", "f"], "n", total).select(*_RUN, F.lit(0).alias("kind"))
        sifted = sifted.union(twice).union(groups.select("a", "f", "x.*", F.when(F.col("n") > 1, 2).otherwise(1).alias("kind")))
    sifted = cut(sifted, "runs")
    drop_scratch(found)
    spans = sifted.where("kind = 0").select("d", "t", F.col("lo").alias("s"), (F.col("lo") + F.col("c") + length - 1).alias("e"))
    unsure = sifted.where("kind > 0")
    wide_ones = cut(unsure.groupBy("a").agg(F.count("*").alias("n")).where(F.col("n") > wide).select("a"), "wide")
    by_doc = cut(unsure.groupBy("d", "t").agg(F.collect_list(F.struct("a", "lo", "c", "o", "kind")).alias("found")), "unsure")
    if by_doc.count() <= MAP_IDS:
        docs = docs.mapInArrow(_marked(0, spark.sparkContext.broadcast(bit_map(by_doc, "d"))), docs.schema)
    texts = docs.join(by_doc, ["d", "t"]).select("d", "t", "text", "found").mapInArrow(_texts(length), _TEXT_SCHEMA)
    if wide_ones.isEmpty():
        return spans.union(texts.repartition("a").sortWithinPartitions("a").mapInArrow(_digit_passes(length), _SPAN))
    texts = cut(texts, "texts")
    narrow = texts.join(wide_ones, "a", "left_anti").repartition("a").sortWithinPartitions("a")
    windows = cut(texts.join(wide_ones, "a", "left_semi").mapInArrow(_wide_windows(length), "x long, y long, z long, d long, t long, s int, kind int"), "windows")
    twice = windows.groupBy("x", "y", "z").agg(F.count("*").alias("n")).where("n > 1")
    more = split_join(windows, twice, ["x", "y", "z"], "n", windows.count(), "left_semi").where("kind = 1").select("d", "t", "s", (F.col("s") + length).alias("e"))
    return spans.union(narrow.mapInArrow(_digit_passes(length), _SPAN)).union(more)


def remove_repeats(df: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 400, keep_bytes: bool = True, drop_text: bool = False, wide: int = WIDE, hot: int = HOT) -> DataFrame:
    """df with n_bytes, n_removed, n_spans, kept_sha256 and, unless keep_bytes is false, kept: the bytes that are left of text. Texts without repeats aren't shuffled."""
    made = list(MADE[: 4 + keep_bytes])
    spans = cut(repeated_bytes(df, text, doc_id, length, wide, hot).distinct().groupBy("d", "t").agg(F.collect_list(F.struct("s", "e")).alias("_spans")), "spans")
    key = _key(doc_id, text)
    rows, kept = packed(df, made, (text,) if drop_text else (), _text=key["text"], d=key["d"], t=key["t"])
    out = with_fields(rows, "_row", "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes)
    touched, done = rows, None
    if spans.count() <= MAP_IDS:
        bits = df.sparkSession.sparkContext.broadcast(bit_map(spans, "d"))
        touched = rows.mapInArrow(_marked(2, bits), rows.schema)
        done = rows.mapInArrow(_marked(2, bits, False), rows.schema).mapInArrow(_result(keep_bytes, None), out)
    touched = touched.join(spans, ["d", "t"], "left").select("_row", "_text", "_spans").mapInArrow(_result(keep_bytes, 2), out)
    return unpacked(done.union(touched) if done else touched, kept, *made)
