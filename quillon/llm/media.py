"""Chroma fingerprints of audio columns, and the search for recordings that align.

Audio is resampled to `RATE`, cut into overlapping frames, and each frame's spectrum is folded into twelve pitch classes. Over the image of pitch classes and frames an integral image
gives the sums of rectangles. Each of 16 filters compares two areas at each frame; the log ratio falls into one of four ranges, coded by two Gray bits. So a frame has an integer of 32 bits.

Recordings with one fingerprint form a class, and one member stands for it. The integers are the keys of the index, which has all classes. Those that a query shares with a class vote for
an offset, runs of equal integers with as many votes as they share frames; wherever `VOTES` or more agree, bits that differ are counted over the frames that overlap, and a share of `ERRORS` or less is a match.

Defined cases: null audio has a null fingerprint and matches nothing; audio shorter than a filter's frames has an empty one and matches nothing; silence has a fingerprint as other sound, but doesn't vote; recordings without an id
are left out of classes; of several recordings of one id the one with the longest fingerprint counts, of these the one with the least hash; audio of any length; of offsets with the same share of wrong bits the least counts; an empty table gives an empty table; other columns pass through `fingerprints`, whatever their names, unless they are named as its result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.llm.common import cut, name, portions, split_join, unpacked, with_fields
from quillon.llm.common import packed as in_rows

RATE, FRAME, HOP, SPAN = 4000, 1024, 256, 16
VOTES, ERRORS, OVERLAP = 2, 0.1, 32
#: Tasks to which the runs of a frequent integer are dealt.
SALT = 32
#: Ranges of a filter's log ratio.
EDGES = (-0.35, 0.0, 0.35)
#: What a filter compares: lower and upper half of its pitch classes, first and second half of its frames, opposite quarters, middle and outer frames.
SHAPES = ("pitch", "time", "quarters", "middle")


def filters() -> list[tuple[str, int, int]]:
    """(shape, first pitch class, pitch classes) of the 16 filters: each shape at four places a fifth apart."""
    return [(SHAPES[i % 4], 7 * (i // 4 + i % 4) % 12, 4 if i % 4 == 2 else 6) for i in range(16)]


def _fold(n: int) -> np.ndarray:
    """Weights of a frame's frequencies for the pitch classes, from 100 to 1800 Hz."""
    hz = np.fft.rfftfreq(n, 1 / RATE)
    out = np.zeros((len(hz), 12))
    use = (hz >= 100) & (hz <= 1800)
    out[np.flatnonzero(use), np.round(12 * np.log2(hz[use] / 440.0)).astype(int) % 12] = 1
    return out


_FOLD, _SHAPE = _fold(FRAME), np.hanning(FRAME)


def chroma(sound: np.ndarray, rate: int) -> np.ndarray:
    """Frames by twelve pitch classes, each frame with sum 1 (silence: all alike)."""
    x = sound.astype(np.float64)
    if rate != RATE and len(x):
        x = np.interp(np.arange(int(len(x) * RATE / rate)) * rate / RATE, np.arange(len(x)), x)
    if len(x) < FRAME:
        return np.empty((0, 12))
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    out = np.concatenate([np.abs(np.fft.rfft(frames[i : i + 512] * _SHAPE)) ** 2 @ _FOLD for i in range(0, len(frames), 512)])
    total = out.sum(1, keepdims=True)
    return np.where(total > 1e-9, out / np.maximum(total, 1e-9), 1 / 12)


def packed(image: np.ndarray) -> np.ndarray:
    """The integers of an image of frames by pitch classes."""
    n = len(image) - SPAN + 1
    if n <= 0:
        return np.empty(0, np.int32)
    whole = np.zeros((len(image) + 1, 25))
    whole[1:, 1:] = np.cumsum(np.cumsum(np.concatenate((image, image), 1), 0), 1)  # pitch classes twice, so that rectangles may go round
    at, out = np.arange(n), np.zeros(n, np.uint32)

    def area(t0: int, t1: int, p0: int, p1: int) -> np.ndarray:
        return whole[at + t1, p1] - whole[at + t0, p1] - whole[at + t1, p0] + whole[at + t0, p0]

    for k, (shape, p, h) in enumerate(filters()):
        half, mid, q = SPAN // 2, p + h // 2, SPAN // 4
        if shape == "pitch":
            a, b = area(0, SPAN, p, mid), area(0, SPAN, mid, p + h)
        elif shape == "time":
            a, b = area(0, half, p, p + h), area(half, SPAN, p, p + h)
        elif shape == "quarters":
            a, b = area(0, half, p, mid) + area(half, SPAN, mid, p + h), area(0, half, mid, p + h) + area(half, SPAN, p, mid)
        else:
            a, b = area(q, SPAN - q, p, p + h), area(0, q, p, p + h) + area(SPAN - q, SPAN, p, p + h)
        level = np.searchsorted(EDGES, np.log((a + 0.2) / (b + 0.2)))
        out |= (level ^ (level >> 1)).astype(np.uint32) << np.uint32(2 * k)
    return out.view(np.int32)


def fingerprint(audio: bytes | None, rate: int) -> np.ndarray | None:
    """Integers of 16-bit little-endian mono PCM."""
    return None if audio is None else packed(chroma(np.frombuffer(audio[: len(audio) // 2 * 2], "<i2"), rate))


def _fingerprints(fixed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in portions(b, 1, 500, 32_000_000):
                got = [fingerprint(x, r or fixed) for x, r in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([None if g is None else g.tolist() for g in got], pa.list_(pa.int32()))], names=["_row", "fingerprint"])

    return run


def fingerprints(df: DataFrame, audio: str = "audio", rate: str | int = RATE, drop_audio: bool = True) -> DataFrame:
    """df with fingerprint array<int>; rate: a column or a number."""
    own = F.col(name(rate)) if isinstance(rate, str) else F.lit(None)
    rows, kept = in_rows(df, ["fingerprint"], (audio,) if drop_audio else (), _audio=F.col(name(audio)), _rate=own.cast("int"))
    return unpacked(rows.mapInArrow(_fingerprints(RATE if isinstance(rate, str) else rate), with_fields(rows, "_row", "fingerprint array<int>")), kept, "fingerprint")


def classes(prints: DataFrame, key: str = "id") -> DataFrame:
    """(id, class_id, fingerprint): class_id is the least id with the same fingerprint."""
    known = prints.select(F.col(name(key)).alias("id"), "fingerprint").where("id IS NOT NULL").withColumns({"h": F.xxhash64("fingerprint"), "n": F.size("fingerprint")})
    if not known.groupBy("id").agg(F.count("*").alias("c")).where("c > 1").isEmpty():
        # rows of one id go to sums by task before they meet, so an id with many recordings is a row for each task
        known = known.groupBy("id").agg(F.max_by(F.struct("fingerprint", "h", "n"), F.struct("n", -F.col("h"))).alias("x")).select("id", "x.*")
    least = known.where("n > 0").groupBy("h", "n").agg(F.min("id").alias("class_id"), F.count("*").alias("c"))
    return split_join(known, least, ["h", "n"], "c", known.count()).select("id", "class_id", "fingerprint").unionByName(known.where("n <= 0 OR n IS NULL").select("id", F.col("id").alias("class_id"), "fingerprint"))


def silence() -> int:
    """The integer of frames without sound."""
    return int(packed(np.full((SPAN, 12), 1 / 12))[0])


def _keys(df: DataFrame, name: str, place: str) -> DataFrame:
    """Runs of equal frames of each class by their integers, with their first and last frames; none of silence, which tells no recording from another."""
    each = F.transform("fingerprint", lambda x, i: F.struct(i.alias("i"), x.alias("key"), F.get("fingerprint", i - 1).alias("before"), F.get("fingerprint", i + 1).alias("after")))
    starts, ends = F.filter(each, lambda s: s["before"].isNull() | (s["before"] != s["key"])), F.filter(each, lambda s: s["after"].isNull() | (s["after"] != s["key"]))
    runs = F.zip_with(starts, ends, lambda a, z: F.struct(a["i"].alias(f"{place}1"), z["i"].alias(f"{place}2"), a["key"].alias("key")))
    return df.select(F.col("class_id").alias(name), F.explode(F.filter(runs, lambda s: s["key"] != silence())).alias("s")).select(name, "s.*")


def align(found: DataFrame, is_query: Column) -> DataFrame:
    """(query_class, class_id, offset, n_bits, n_errors) of classes()'s rows: matches of the queries' classes. offset: frame of the query minus frame of the match."""
    reps = found.where("id = class_id AND size(fingerprint) > 0")
    asked = found.where(is_query & (F.size("fingerprint") > 0)).select("class_id").distinct()
    queries = reps.join(asked, "class_id", "left_semi")
    asked_for, held = _keys(queries, "query_class", "i"), cut(_keys(reps, "class_id", "j"), "keys")
    # integers of more than a thousandth of all runs, fewer than 1000: their runs are dealt to many tasks, each with all queries' runs of that integer
    hot = F.broadcast(held.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > held.count() / 1000).select("key", F.lit(True).alias("hot")))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("class_id"), F.lit(SALT))).otherwise(0).alias("salt")
    held = held.join(hot, "key", "left").select("key", "class_id", "j1", "j2", salt)
    asked_for = asked_for.join(hot, "key", "left").select("key", "query_class", "i1", "i2", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))).alias("salt"))
    votes = asked_for.join(held.withColumn("salt", F.col("salt").cast("long")), ["key", "salt"]).where("query_class <> class_id")
    # two runs vote with the frames they share where their first frames meet, and where their last ones do
    votes = votes.withColumn("n", F.least(F.col("i2") - F.col("i1"), F.col("j2") - F.col("j1")) + 1)
    votes = votes.select("query_class", "class_id", "n", F.explode(F.array_distinct(F.array(F.col("i1") - F.col("j1"), F.col("i2") - F.col("j2")))).alias("offset"))
    few = votes.groupBy("query_class", "class_id", "offset").agg(F.sum("n").alias("votes")).where(f"votes >= {VOTES}")
    # of two recordings apart by a part of a frame, neighbouring offsets are as good
    few = few.select("query_class", "class_id", F.explode(F.array(*[F.col("offset") + d for d in (-1, 0, 1)])).alias("offset")).distinct()
    both = few.join(queries.select(F.col("class_id").alias("query_class"), F.col("fingerprint").alias("x")), "query_class").join(reps.select("class_id", F.col("fingerprint").alias("y")), "class_id")
    start, other = F.greatest(F.col("offset"), F.lit(0)), F.greatest(-F.col("offset"), F.lit(0))
    n = F.least(F.size("x") - start, F.size("y") - other)
    wrong = F.aggregate(F.zip_with(F.slice("x", start + 1, n), F.slice("y", other + 1, n), lambda a, b: F.bit_count(a.bitwiseXOR(b).cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), F.lit(0).cast("long"), lambda s, v: s + v)
    both = both.where(n >= OVERLAP).select("query_class", "class_id", "offset", (32 * n).cast("long").alias("n_bits"), wrong.alias("n_errors")).where(F.col("n_errors") <= ERRORS * F.col("n_bits"))
    least = W.partitionBy("query_class", "class_id").orderBy(F.col("n_errors") / F.col("n_bits"), "offset")
    return both.withColumn("_r", F.row_number().over(least)).where("_r = 1").drop("_r")


def melody(values, note: int = 512) -> bytes:
    """PCM of a vector as a melody: a note for each value, of a pitch that follows it. The tables have no audio, and this makes some."""
    v = np.asarray(values, float)
    pitch = 440.0 * 2 ** (np.round(12 * np.tanh(4 * np.nan_to_num(v))) / 12)
    turn = 2 * np.pi * np.repeat(pitch, note) / RATE
    return (12000 * np.sin(np.cumsum(turn))).astype("<i2").tobytes()


def second_take(sound: bytes) -> bytes:
    """The same melody recorded once more: it begins later, within a frame, is softer, and has noise. It follows from the sound alone, so equal sounds have equal second takes."""
    x = np.frombuffer(sound, "<i2").astype(float)
    x = x[len(x) // 6 + HOP // 3 :]
    noise = np.random.default_rng(zlib.crc32(sound)).normal(0, 60, len(x))
    return (0.7 * x + noise).astype("<i2").tobytes()


def _melodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, 100):
            part = b.slice(lo, 100)
            first = [None if v is None else melody(v) for v in part.column(1).to_pylist()]
            ids = [None if i is None else 2 * i for i in part.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([*ids, *[None if i is None else i + 1 for i in ids]], pa.int64()), pa.array([*first, *[None if x is None else second_take(x) for x in first]], pa.binary())], ["id", "audio"])


def rendered(vectors: DataFrame, key: str = "vec_id", values: str = "embedding") -> DataFrame:
    """(id, audio): two recordings of each vector as a melody, 2 * key and 2 * key + 1; the second is a later and noisy take of the first."""
    return vectors.select(F.col(key).cast("long"), F.col(values).cast("array<double>")).mapInArrow(_melodies, "id long, audio binary")
