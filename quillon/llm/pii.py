"""Personal data: patterns, and terms that disclose them by corpus co-occurrence.

The values of the patterns' spans are the protected entities. Terms within `WINDOW` words of a span co-occur with its entity. With N documents, of which n(e) hold entity e,
n(t) term t and n(t, e) both near each other, t tells ln(n(t, e) N / (n(t) n(e))) of the ln(N / n(e)) nats that e carries. Terms whose share of them, the disclosure, is at
least `GENERALISE` are generalised wherever they occur, and removed from `REMOVE` on. A pair counts if it is found in `SUPPORT` different texts.

Counts cover all documents. Tasks count the terms of their documents and pass on those near entities and, for the others, lower bounds of the frequent ones, which rule
out common words. What may still disclose goes into a bit map of fixed size. A second scan counts and places the terms it lets through; the exact counts come from a join.

Defined cases: null texts are empty; rows count as documents each, repeated ones too; spans of the terms never overlap pattern spans; a term that discloses several entities has the largest disclosure; spans with one start come in the order of their kinds; an
empty table gives an empty table; other columns pass through `find`, whatever their names, unless they are named as a result.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import WORD, cut, drop_scratch, name, packed, portions, unpacked, with_fields

WINDOW, SUPPORT, GENERALISE, REMOVE = 8, 3, 0.9, 0.95
#: Fixed values of the contract: kinds in their order, patterns, and what a match must meet.
KINDS = ("email", "ip", "card", "phone", "term")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Frequent terms of which a task tells the counts, terms it keeps in mind, and bits of the map of terms that may disclose.
FREQUENT, MIND, BITS = 20_000, 600_000, 1 << 23
#: Letters of a term that is kept as it is.
LONG = 256
_WORD = re.compile(WORD)
_EDGE = ".,;:!?()[]{}\"'«»"


def emails(t: str) -> Iterator[tuple[int, int]]:
    """Matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, in time linear in the text."""
    done, at = 0, t.find("@")
    while at >= 0:
        s = at
        while s > done and t[s - 1] in LOCAL:
            s -= 1
        if s < at and (m := DOMAIN.match(t, at + 1)):
            yield s, m.end()
            done = m.end()
        else:
            done = at + 1
        at = t.find("@", done)


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns, sorted."""
    out = [(s, 0, e) for s, e in emails(t)] if "@" in t else []
    if re.search("[0-9]", t):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(len(x) <= 3 and int(x or 0) <= 255 for x in (x.lstrip("0") for x in m[0].split(".")))]
        for m in CARD.finditer(t):
            d = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in t:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def entity(kind: int, value: str) -> int:
    value = value.lower() if kind == 0 else value if kind == 1 else re.sub("[^0-9]", "", value)
    return xxhash.xxh64_intdigest(f"{KINDS[kind]}:{value}") - (1 << 63)


def near(t: str, spans: list[tuple[int, int, int]]) -> set[tuple[int, str]]:
    """(entity, term) of the `WINDOW` words on each side of the spans, however long they are; of a word that a span touches, the part outside."""
    out = set()
    words = [m.span() for m in _WORD.finditer(t)]
    starts, ends = [a for a, _ in words], [z for _, z in words]
    for s, k, e in spans:
        e_id = entity(k, t[s:e])
        i, j = bisect_left(starts, s), bisect_right(ends, e)
        for w in [*(t[a : min(z, s)] for a, z in words[max(0, i - WINDOW) : i]), *(t[max(a, e) : z] for a, z in words[j : j + WINDOW])]:
            if "@" not in w and (x := term(w)):
                out.add((e_id, x))
    return out


def term(word: str) -> str:
    """The word without edges in lower case; if it is long, a blank and its hash, so that counts of long words stay small."""
    x = word.strip(_EDGE).lower()
    return x if len(x) <= LONG else f" {xxhash.xxh3_128_hexdigest(x.encode('utf-8', 'surrogatepass'))}"


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (e, t, th, n): term t near entity e in a text; an entity alone (t null); and n documents with a frequent term (e null)."""
    often: Counter[str] = Counter()
    for b in (part for b in batches for part in portions(b, 0, 10_000)):
        e, t, th = [], [], []
        for x in b.column(0).to_pylist():
            x = x or ""
            often.update(set(map(term, _WORD.findall(x))))
            if len(often) > MIND:  # counts stay lower bounds
                often = Counter({k: v for k, v in often.items() if v > 1})
                if len(often) > MIND // 2:
                    often = Counter(dict(often.most_common(FREQUENT)))
            if spans := base_spans(x):
                own = xxhash.xxh64_intdigest(x) - (1 << 63)
                got = near(x, spans)
                for e_id, w in [*got, *((i, None) for i in {entity(k, x[s:z]) for s, k, z in spans})]:
                    e.append(e_id)
                    t.append(w)
                    th.append(own)
        if e:
            yield pa.RecordBatch.from_arrays([pa.array(e, pa.int64()), pa.array(t, pa.string()), pa.array(th, pa.int64()), pa.array([1] * len(e), pa.int64())], ["e", "t", "th", "n"])
    top = [(k, v) for k, v in often.most_common(FREQUENT) if v > 1]
    if top:
        yield pa.RecordBatch.from_arrays([pa.array([None] * len(top), pa.int64()), pa.array([k for k, _ in top]), pa.array([None] * len(top), pa.int64()), pa.array([v for _, v in top], pa.int64())], ["e", "t", "th", "n"])


def _bit(t: str) -> int:
    return zlib.crc32(t.encode("utf-8", "surrogatepass")) % BITS


class Maybe(dict):
    """By term: whether the bit map lets it through."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    def __missing__(self, word: str) -> str | None:
        if len(self) > MIND:
            self.clear()
        t = term(word)
        k = _bit(t)
        got = self[word] = t if t and self.bits[k >> 3] >> (k & 7) & 1 else None
        return got


def _spans(bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = Maybe(np.frombuffer(bits.value, np.uint8))
        for b in batches:
            for part in portions(b, 1, 500):
                base, hits = [], []
                for x in part.column(1).to_pylist():
                    x = x or ""
                    spans = base_spans(x)
                    own = []
                    if any([maybe[w] for w in set(_WORD.findall(x))]):
                        starts, ends = [s for s, _, _ in spans], list(accumulate((e for _, _, e in spans), max))
                        for m in _WORD.finditer(x):
                            if t := maybe[m[0]]:
                                s = m.start() + len(m[0]) - len(m[0].lstrip(_EDGE))
                                e = m.end() - len(m[0]) + len(m[0].rstrip(_EDGE))
                                before = bisect_left(starts, e)  # spans that start before the word ends
                                if not before or ends[before - 1] <= s:
                                    own.append({"t": t, "s": s, "e": e})
                    base.append([{"s": s, "k": k, "e": e} for s, k, e in spans])
                    hits.append(own)
                span = pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())])
                hit = pa.struct([("t", pa.string()), ("s", pa.int32()), ("e", pa.int32())])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(base, pa.list_(span)), pa.array(hits, pa.list_(hit))], names=["_row", "base", "hits"])

    return run


def _disclosure(both: str, t: str, e: str, n: int) -> str:
    return f"ln({both} * {float(n)}D / ({t} * {e})) / ln({float(n)}D / {e})"


def find(df: DataFrame, text: str = "text", drop_text: bool = False) -> DataFrame:
    """df with base and all_spans: arrays of (s, k, e, d) sorted by start and kind; k is the number in KINDS, d a term's disclosure."""
    spark = df.sparkSession
    rows, kept = packed(df, ["base", "all_spans"], (text,) if drop_text else (), _text=F.col(name(text)).cast("string"))
    seen = cut(rows.select("_text").mapInArrow(_pairs, "e long, t string, th long, n long"), "pairs")
    n = rows.count()
    alone = seen.where("e IS NOT NULL AND t IS NULL").groupBy("e").agg(F.sum("n").alias("ne"))
    both = seen.where("e IS NOT NULL AND t IS NOT NULL").groupBy("e", "t").agg(F.sum("n").alias("nb"), F.count_distinct("th").alias("texts")).where(f"texts >= {SUPPORT}")
    low = seen.where("e IS NULL").groupBy("t").agg(F.sum("n").alias("low"))
    pairs = cut(both.join(alone, "e").join(low, "t", "left").withColumn("nt", F.greatest("nb", F.coalesce("low", F.lit(0)))).where(f"ne < {n} AND {_disclosure('nb', 'nt', 'ne', n)} >= {GENERALISE}").select("e", "t", "nb", "ne"), "pairs")
    # one byte of the map for each group: at most BITS / 8 rows, whatever the number of terms
    marks = pairs.select((F.crc32("t") % BITS).alias("k")).groupBy(F.expr("k div 8").alias("i")).agg(F.bit_or(F.expr("shiftleft(1, int(k % 8))")).alias("v")).toArrow()
    bits = np.zeros(BITS // 8, np.uint8)
    bits[marks.column("i").to_numpy()] = marks.column("v").to_numpy()
    placed = rows.mapInArrow(_spans(spark.sparkContext.broadcast(bits.tobytes())), with_fields(rows, "_row", "base array<struct<s:int,k:int,e:int>>, hits array<struct<t:string,s:int,e:int>>"))
    placed = cut(placed.withColumn("_uid", F.monotonically_increasing_id()), "placed")
    hits = placed.where(F.size("hits") > 0).select("_uid", F.explode("hits").alias("h")).select("_uid", "h.*")
    count = hits.select("_uid", "t").distinct().groupBy("t").agg(F.count("*").alias("nt"))
    known = pairs.join(count, "t").withColumn("d", F.expr(_disclosure("nb", "greatest(nt, nb)", "ne", n))).groupBy("t").agg(F.max("d").alias("d")).where(F.col("d") >= GENERALISE)
    terms = hits.join(known, "t").groupBy("_uid").agg(F.collect_list(F.struct("s", F.lit(4).alias("k"), "e", "d")).alias("_terms"))
    base = F.transform("base", lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), F.lit(None).cast("double").alias("d")))
    drop_scratch(seen)
    both = placed.join(terms, "_uid", "left").select("_row", base.alias("_b"), "_terms")
    return unpacked(both, kept, F.col("_b").alias("base"), F.sort_array(F.concat("_b", F.coalesce("_terms", F.array().cast("array<struct<s:int,k:int,e:int,d:double>>")))).alias("all_spans"))


def listed(spans: str):
    """kind:start:end of the spans, joined by commas."""
    kind = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kind, x["k"]), x["s"], x["e"])), ",")


def _redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in (part for b in batches for part in portions(b, 1)):
        out = []
        for t, own in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            parts, done = [], 0
            for x in own or ():
                if x["s"] >= done:
                    parts += [(t or "")[done : x["s"]], "" if x["d"] is not None and x["d"] >= REMOVE else f"[{KINDS[x['k']].upper()}]"]
                done = max(done, x["e"])
            out.append(None if t is None else "".join([*parts, t[done:]]))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["_row", "sanitised"])


def sanitise(df: DataFrame, text: str = "text") -> DataFrame:
    """find()'s rows with sanitised: the text with kinds for pattern spans and weaker terms, and without the strongest terms."""
    found, kept = packed(find(df, text), ["sanitised"], _text=F.col(name(text)).cast("string"), _all=F.col("all_spans"))
    return unpacked(found.mapInArrow(_redacted, with_fields(found, "_row", "sanitised string")), kept, "sanitised")
