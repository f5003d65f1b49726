"""Similarity join of n-gram sets by vertical partitioning.

A text's set holds the 64-bit hashes of its word n-grams, and their order is the global n-gram order. The order is cut into
fragments, and sets are compared fragment by fragment:

* Candidates. Sets of at most M n-grams with a Jaccard similarity of t or more differ in at most D = 2M(1-t)/(1+t) n-grams, so
  of more than D fragments at least one is the same in both, of whatever n-grams they are made. The frequent n-grams, the last of the order, are left out of the fragments. Fragments may be empty in both; E more
  fragments pay for that, and a set with more than E empty ones also shows fragments of all its n-grams. Equal fragments put sets in one bucket; sizes come in levels
  that overlap as far as similar sizes can differ.
* Overlaps. A candidate pair's sets are cut into `PARTS` fragments; the overlap of each is counted by itself, and the counts are summed per pair.

Equal sets form a class, and one member stands for it. Every document is first compared with one or two others: the first document of most of its wide buckets, and of most of its small ones. Buckets whose documents
lie in one component by then are settled. In small buckets with several components, the pairs of different components are looked at, a few of each document before the rest, but for those that signatures rule out. In wide ones, all documents are
compared with one, that which most of them have been compared with; sets that may be similar must then share n-grams in which they differ from it, and pairs that do are compared. So no link between components is missed, and a
group of copies costs about as many comparisons as it has members.

Defined cases: null and empty texts, or texts of white space, have empty sets, which link with nothing; texts shorter than n words have their whole
sequence as the one n-gram; rows of one doc_id are one document, of which the row with the largest set counts (ties by the set's fingerprints) and all are returned, each with its own n_shingles; rows with a null doc_id are returned with a null component; an empty table gives an empty table; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillon.llm.common import MAP_IDS, bit_map, components, cut, drop_scratch, in_map, name, portions, release, split_join

#: Fragments whose overlaps are counted separately.
PARTS = 8
#: Distinct words of which a task keeps the hashes before it starts anew.
CACHE = 200_000
#: Members of a bucket up to which its pairs are looked at one by one.
SMALL = 32
#: Pairs of a document that the second round compares before the others.
SOME = 2
#: N-grams at the end of the order, at most, and documents that hold each, at least.
FREQUENT, OFTEN = 200_000, 20
#: N-grams of which a task sees at once which are frequent.
PORTION = 3_000_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _times(i: int, odd: np.uint64) -> np.uint64:
    return np.uint64(i * int(odd) & 0xFFFFFFFFFFFFFFFF)


class Hashes(dict):
    """64-bit hashes of words, by word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def ngrams(text: str | None, n: int, hashes: Hashes) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; A-Z count as a-z."""
    found = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    m = min(n, len(h))
    x = np.full(len(h) - m + 1, m, np.uint64)
    for i in range(m):
        x = mix(x * _ODD[0] + h[i : len(h) - m + 1 + i])
    return np.unique(x)


class Levels:
    """Size levels and their fragments for a similarity of at least pct / 100."""

    def __init__(self, pct: int) -> None:
        self.pct, self.tops, self.parts = pct, [1], {}

    def level(self, n: int) -> list[int]:
        """The levels in which a set of n shows its fragments: its own, and the next one if a similar set may be there."""
        while self.tops[-1] <= 100 * n // self.pct:
            self.tops.append(max(self.tops[-1] + 1, int(self.tops[-1] * (100 / self.pct) ** 3)))
        i = int(np.searchsorted(self.tops, n))
        return [i, i + 1] if 100 * n // self.pct > self.tops[i] else [i]

    def fragments(self, i: int) -> tuple[int, int]:
        """Number of fragments, and of those that may be empty."""
        if i not in self.parts:
            top, low = self.tops[i], (self.tops[i - 1] if i else 0) + 1
            apart = 2 * top * (100 - self.pct) // (100 + self.pct)
            spare, n = 0, apart + 1
            for _ in range(4):
                mean = n * np.exp(-low * self.pct / 100 / n)
                spare = int(mean + 4 * np.sqrt(mean))
                n = apart + 1 + spare
            self.parts[i] = n, spare
        return self.parts[i]

    @staticmethod
    def _fragments_of(x: np.ndarray, n: int, i: int, tag: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and numbers of the fragments of x that aren't empty."""
        if not len(x):
            return x, x
        f = ((x >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate(([True], f[1:] != f[:-1])))
        at = f[starts]
        return mix(np.add.reduceat(mix(x + _ODD[1]), starts) + at * _ODD[2] + _times(2 * i + tag, _ODD[3])), at

    def keys(self, x: np.ndarray, frequent: np.ndarray) -> np.ndarray:
        """Keys of the fragments that a set shows. frequent: sorted n-grams at the end of the order, of which fragments are left out as far as others suffice."""
        out = []
        rare = x[frequent[np.minimum(np.searchsorted(frequent, x), len(frequent) - 1)] != x] if len(frequent) else x
        for i in self.level(len(x)):
            n, spare = self.fragments(i)
            keys, at = self._fragments_of(rare, n, i, 0)
            out.append(keys)
            if n - len(at) > spare:  # two such sets may have none but empty fragments in common, so they show those of all n-grams too
                keys, at = self._fragments_of(x, n, i, 1)
                out.append(keys)
                if n - len(at) > spare:
                    out.append(mix(np.setdiff1d(np.arange(n, dtype=np.uint64), at) * _ODD[4] + _times(i, _ODD[5])))
        return np.concatenate(out) if out else np.empty(0, np.uint64)


def signature(x: np.ndarray) -> np.ndarray:
    """Parities of the n-grams by their last bits, two bits or more for each n-gram: two signatures differ in at most as many bits as the sets in n-grams."""
    words = min(256, max(4, 1 << (max(1, len(x) - 1) // 32).bit_length()))
    odd = np.bincount((x & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _list(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    flat = np.concatenate(parts).view(np.int64) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _prints(x: np.ndarray) -> tuple[int, int]:
    """Two fingerprints of a set."""
    return int(mix(x ^ _ODD[6]).sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(mix(x ^ _ODD[7])).view(np.int64)) if len(x) else 0


def _scan(n: int):
    """Rows (doc, size, s1, s2) of the texts' sets, and rows (gram, many): n-grams that many texts of a task hold, and of how many it knows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, count = Hashes(), np.empty(0, np.uint64), np.empty(0, np.int64)

        def add(own: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            grams, c = np.unique(np.concatenate(own), return_counts=True)
            new, back = np.unique(np.concatenate((held, grams[c > 2])), return_inverse=True)
            total = np.bincount(back, np.concatenate((count, c[c > 2])), len(new)).astype(np.int64)
            if len(new) > 2 * FREQUENT:
                top = np.sort(np.argpartition(-total, FREQUENT)[:FREQUENT])
                new, total = new[top], total[top]
            return new, total

        own, size = [], 0
        for b in batches:
            for part in portions(b, 1):
                sets = [ngrams(t, n, hashes) for t in part.column(1).to_pylist()]
                s1, s2 = zip(*map(_prints, sets), strict=True)
                none = pa.nulls(len(sets), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(map(len, sets)), pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), none, none], list(_SCAN))
                own += sets
                size += sum(map(len, sets))
                if size > PORTION:
                    held, count = add(own)
                    own, size = [], 0
        if own:
            held, count = add(own)
        none = pa.nulls(len(held), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(held.view(np.int64)), pa.array(count)], list(_SCAN))

    return run


_SCAN = ("doc", "n", "s1", "s2", "gram", "many")


def frequent(seen: DataFrame) -> np.ndarray:
    """Sorted: at most FREQUENT n-grams that at least OFTEN documents hold, the most frequent first. They go to the end of the order; which they are changes no result."""
    found = seen.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("many").alias("many")).where(F.col("many") >= OFTEN)
    rows = found.orderBy(F.desc("many"), "gram").limit(FREQUENT).select("gram").toArrow()
    return np.sort(rows.column("gram").to_numpy().view(np.uint64))


def _keys(n: int, pct: int, often, marks, marked: bool):
    """Rows (doc, s1, s2, keys) of the marked documents, or (doc, keys) of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, levels, last, bits = Hashes(), Levels(pct), often.value, marks.value if marks else None
        for b in batches:
            for part in portions(b, 1):
                docs, keys, prints = [], [], []
                for d, t in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    if d is None or (bits is None or in_map(bits, d)) != marked:
                        continue
                    x = ngrams(t.as_py(), n, hashes)
                    if len(x):
                        docs.append(d)
                        keys.append(levels.keys(x, last))
                        if marked:
                            prints.append(_prints(x))
                if docs:
                    more = [pa.array([p[k] for p in prints], pa.int64()) for k in (0, 1)] if marked else []
                    yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), *more, _list(keys)], ["doc", *["s1", "s2"][: len(more)], "keys"])

    return run


def _parts(n: int, marks):
    """Rows (doc, s1, s2, g, n, own) of the marked documents: their n-grams by fragment, and the size of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bits = Hashes(), marks.value if marks else None
        for b in batches:
            for part in portions(b, 1, 200, 1_000_000):
                rows = [[], [], [], [], []]
                for d, t in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    if d is None or bits is not None and not in_map(bits, d):
                        continue
                    x = ngrams(t.as_py(), n, hashes)
                    edges = np.searchsorted(x, np.arange(1, PARTS, dtype=np.uint64) << np.uint64(61))
                    for c, v in zip(rows, ([d] * PARTS, [_prints(x)] * PARTS, range(PARTS), [len(x)] * PARTS, np.split(x, edges)), strict=True):
                        c.extend(v)
                if rows[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), *[pa.array([p[k] for p in rows[1]], pa.int64()) for k in (0, 1)], pa.array(rows[2], pa.int32()), pa.array(rows[3], pa.int64()), _list(rows[4])], list(_PARTS))

    return run


_PARTS = {"doc": "long", "s1": "long", "s2": "long", "g": "int", "n": "long", "own": "array<long>"}


def _signatures(n: int, marks):
    """Rows (doc, s1, s2, n, sig) of the marked documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bits = Hashes(), marks.value if marks else None
        for b in batches:
            for part in portions(b, 1):
                docs, sets = [], []
                for d, t in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    if d is not None and (bits is None or in_map(bits, d)):
                        docs.append(d)
                        sets.append(ngrams(t.as_py(), n, hashes))
                if docs:
                    s1, s2 = zip(*map(_prints, sets), strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(list(map(len, sets)), pa.int64()), _list(list(map(signature, sets)))], ["doc", "s1", "s2", "n", "sig"])

    return run


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, lead, doc) of keys with two documents or more, from rows sorted by key and doc; only a key's first document is kept in mind."""
    key0 = lead0 = doc0 = None
    told = False
    for b in batches:
        key, doc = (c.to_numpy(zero_copy_only=False) for c in b.columns)
        again = np.concatenate(([key0 is not None and (key[0], doc[0]) == (key0, doc0)], (key[1:] == key[:-1]) & (doc[1:] == doc[:-1]))) if len(key) else np.empty(0, bool)
        key, doc = key[~again], doc[~again]
        if not len(key):
            continue
        new = np.concatenate(([key0 is None or key[0] != key0], key[1:] != key[:-1]))
        starts = np.flatnonzero(new)
        group = np.cumsum(new) - 1  # -1: goes on from the batch before
        leads = np.concatenate((doc[starts], [lead0 if lead0 is not None else 0]))
        lead = leads[group]
        single = np.bincount(group + 1, minlength=len(starts) + 1)
        more = single[group + 1] > 1
        more |= group == -1
        out = [key[more], lead[more], doc[more]]
        if group[0] == -1 and not told:
            out = [np.concatenate(([v], o)) for v, o in zip((key0, lead0, lead0), out, strict=True)]
            told = True
        if len(starts):
            i = starts[-1]
            key0, lead0, told = key[i], doc[i], bool(more[i])
        doc0 = doc[-1]
        if len(out[0]):
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in out], ["key", "lead", "doc"])


def _plausible(pairs: DataFrame, sigs: DataFrame, pct: int) -> DataFrame:
    """The pairs (a, b) whose sizes and then signatures allow the similarity. A longer signature is folded to the length of the shorter."""
    size = lambda c: sigs.select(F.col("doc").alias(c), F.col("n").alias(f"n{c}"))
    both = pairs.join(size("a"), "a").join(size("b"), "b").where(100 * F.least("na", "nb") >= pct * F.greatest("na", "nb"))
    both = both.join(sigs.select(F.col("doc").alias("a"), F.col("sig").alias("x")), "a").join(sigs.select(F.col("doc").alias("b"), F.col("sig").alias("y")), "b")

    def folded(x: str, y: str) -> Column:
        n = F.size(y)
        return F.when(F.size(x) > n, F.zip_with(F.slice(x, F.lit(1), n), F.slice(x, n + 1, n), lambda p, q: p.bitwiseXOR(q))).otherwise(F.col(x))

    apart = F.aggregate(F.zip_with(folded("x", "y"), folded("y", "x"), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)
    return both.where(apart * (100 + pct) <= (F.col("na") + F.col("nb")) * (100 - pct)).select("a", "b")


def _met(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs (a, b) by fragment, with the fragment's n-grams of both."""
    left = parts.select(F.col("doc").alias("a"), "g", F.col("own").alias("x"))
    right = parts.select(F.col("doc").alias("b"), "g", F.col("own").alias("y"))
    return pairs.join(left, "a").join(right, ["b", "g"])


def _scored(pairs: DataFrame, parts: DataFrame, pct: int) -> DataFrame:
    """(a, b, o, na, nb, linked): partial overlaps by fragment, summed, and whether the pair is similar enough."""
    size = parts.where("g = 0")
    met = _met(pairs, parts).groupBy("a", "b").agg(F.sum(F.size(F.array_intersect("x", "y")).cast("long")).alias("o"))
    met = met.join(size.select(F.col("doc").alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col("doc").alias("b"), F.col("n").alias("nb")), "b")
    return met.withColumn("linked", 100 * F.col("o") >= pct * (F.col("na") + F.col("nb") - F.col("o")))


def _rest(scored: DataFrame, comp: DataFrame, parts: DataFrame, pct: int) -> DataFrame:
    """(a, b): pairs of different components that one first document has both been compared with, and that may be similar.

    A set's difference from the first document's set is small. Two sets that differ in at most D n-grams have differences that share all but
    a few: with sizes d <= e, (d + e - D) / 2 at least. So the rarest n-grams of the smaller difference, as many as may be missing and one more, have one of the
    rarest of the larger. A small difference may need no common n-gram; such sets meet those not linked to the first document under one key of its own.
    """
    of = comp.select(F.col("id").alias("_id"), "component")
    placed = scored.join(of.withColumnsRenamed({"_id": "b", "component": "cb"}), "b", "left").join(of.withColumnsRenamed({"_id": "a", "component": "ca"}), "a", "left")
    placed = placed.withColumns({"ca": F.coalesce("ca", "a"), "cb": F.coalesce("cb", "b")})
    open_ = placed.groupBy("a").agg(F.min(F.least("ca", "cb")).alias("lo"), F.max(F.greatest("ca", "cb")).alias("hi"), F.count("*").alias("c")).where("lo < hi AND c > 1").select("a")
    placed = placed.join(open_, "a", "left_semi").select("a", "b", "na", "nb", "linked", "cb", (F.col("na") + F.col("nb") - 2 * F.col("o")).alias("d"))
    apart = _met(placed.select("a", "b"), parts).select("a", "b", F.explode(F.concat(F.array_except("x", "y"), F.array_except("y", "x"))).alias("tok"))
    apart = cut(apart, "apart")
    # n-grams that no other set of the group has match nothing: they only count, as the first of the order
    often = apart.groupBy("a", "tok").agg(F.count("*").alias("c")).where("c > 1")
    sets = apart.join(often, ["a", "tok"]).groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("c", "tok"))).alias("toks"))
    sets = placed.join(sets, ["a", "b"], "left").withColumn("toks", F.coalesce("toks", F.array().cast("array<struct<c:bigint,tok:bigint>>")))
    most = F.floor(F.col("nb") * (100 - pct) / pct)  # n-grams in which a similar set differs at most
    least = F.floor(F.col("na") * (100 - pct) / 100) + 1  # size of the difference of a set that isn't linked to the first document
    share = F.ceil((F.when(F.col("linked"), F.greatest("d", least)).otherwise(F.col("d")) + F.col("d") - most) / 2)
    share_large = F.ceil((F.col("d") + F.greatest(F.col("d") - most, F.lit(0)) - most) / 2)
    none = F.struct(F.lit(None).cast("long").alias("tok"), F.lit(0).alias("i"))
    empty = F.array().cast("array<struct<tok:bigint,i:int>>")

    def first(share: Column) -> Column:
        """The rarest n-grams with their places; toks has those that other sets of the group have too, behind `alone` others."""
        alone = (F.col("d") - F.size("toks")).cast("int")
        own = F.slice("toks", F.lit(1), F.greatest(F.lit(0), F.least(F.col("d"), F.col("d") - F.greatest(share, F.lit(1)) + 1).cast("int") - alone))
        return F.transform(own, lambda t, i: F.struct(t["tok"].alias("tok"), (i + alone).alias("i")))

    small = F.concat(first(share), F.when(F.col("linked") & (share <= 0), F.array(none)).otherwise(empty))
    large = F.concat(first(share_large), F.when(~F.col("linked") & (F.col("d") <= most), F.array(none)).otherwise(empty))
    sets = cut(sets.select("a", "b", "nb", "cb", "d", most.alias("most"), "linked", small.alias("small"), large.alias("large")), "differences")

    def shown(what: str, mark: str) -> DataFrame:
        rows = sets.where(F.size(what) > 0).select("a", F.explode(what).alias("t"), *[F.col(c).alias(f"{c}{mark}") for c in ("b", "nb", "cb", "d", "most", "linked")])
        return rows.withColumns({"tok": F.coalesce("t.tok", F.lit(0)), "any": F.col("t.tok").isNull(), f"i{mark}": F.col("t.i")}).drop("t")

    one, two = shown("small", "1"), shown("large", "2")
    met = one.join(two, ["a", "tok", "any"]).where("cb1 <> cb2 AND NOT (linked1 AND linked2) AND (d1 < d2 OR d1 = d2 AND b1 < b2) AND d2 - d1 <= least(most1, most2)")
    # from the first n-gram that two sets share on, they must have enough left to share
    met = met.where("any AND d1 + d2 <= least(most1, most2) OR NOT any AND 2 * least(d1 - i1, d2 - i2) >= d1 + d2 - least(most1, most2)")
    met = met.where(f"100 * nb1 >= {pct} * nb2 AND 100 * nb2 >= {pct} * nb1")
    return met.select(F.least("b1", "b2").alias("a"), F.greatest("b1", "b2").alias("b")).distinct()


def _apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """The pairs (a, b) of different components."""
    a, b = (comp.select(F.col("id").alias(c), F.col("component").alias(f"c{c}")) for c in "ab")
    return pairs.join(a, "a", "left").join(b, "b", "left").where("coalesce(ca, a) <> coalesce(cb, b)").select("a", "b")


def _placed(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """rows (key, doc, other columns) with c, the document's component."""
    return rows.join(comp.select(F.col("id").alias("doc"), "component"), "doc", "left").withColumn("c", F.coalesce("component", "doc")).drop("component")


def _open(placed: DataFrame) -> DataFrame:
    """(key, k) of buckets with several components; k: how many documents they have."""
    return placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("k")).where("lo < hi").select("key", "k")


def _most(rows: DataFrame, by: str, what: str) -> DataFrame:
    """Of each `by` the `what` that most rows have; of several, the least."""
    return rows.groupBy(by, what).agg(F.count("*").alias("_m")).groupBy(by).agg(F.max_by(what, F.struct("_m", -F.col(what))).alias(what))


class _Sets:
    """The n-gram sets of documents asked for. Their texts are found by a bit map of fixed size, so texts aren't shuffled; if there are too many documents for it, texts are joined."""

    def __init__(self, docs: DataFrame, n: int, reps: DataFrame, twice: bool) -> None:
        self.docs, self.n, self.reps, self.twice, self.spark = docs, n, reps, twice, docs.sparkSession

    def of(self, ids: DataFrame, made, schema: str, what: str) -> DataFrame:
        """ids: one column doc."""
        if ids.count() <= MAP_IDS:
            out = self.docs.mapInArrow(made(self.n, self.spark.sparkContext.broadcast(bit_map(ids, "doc"))), schema)
        else:
            out = self.docs.join(ids, "doc", "left_semi").mapInArrow(made(self.n, None), schema)
        if self.twice:  # ids with several rows: one row of the text that counts
            out = out.join(self.reps.select("doc", "s1", "s2"), ["doc", "s1", "s2"], "left_semi").dropDuplicates([c for c in ("doc", "g") if c in out.columns])
        return cut(out.drop("s1", "s2"), what)


def similar_groups(df: DataFrame, text: str = "text", doc_id: str = "doc_id", n: int = 5, pct: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row: groups linked by Jaccard similarities of pct / 100 or more of word n-gram sets."""
    spark = df.sparkSession
    docs = df.select(F.col(name(doc_id)).cast("long").alias("doc"), F.col(name(text)).cast("string").alias("text"))
    seen = cut(docs.mapInArrow(_scan(n), "doc long, n long, s1 long, s2 long, gram long, many long"), "sets")
    often = spark.sparkContext.broadcast(frequent(seen))  # at most 8 * FREQUENT bytes
    bare = seen.where("gram IS NULL").select("doc", "n", "s1", "s2")
    # of several rows of an id the largest set counts, ties by its fingerprints
    each = cut(bare.where("doc IS NOT NULL").groupBy("doc").agg(F.max(F.struct("n", "s1", "s2")).alias("x"), F.count("*").alias("c")).where("x.n > 0").select("doc", "x.*", "c"), "sizes")
    classes = each.groupBy("n", "s1", "s2").agg(F.min("doc").alias("rep"), F.count("*").alias("k")).where("k > 1")
    copies = cut(split_join(each, classes, ["n", "s1", "s2"], "k", each.count()).where("doc <> rep").select("doc", "rep"), "copies")
    reps = each.join(copies.select("doc"), "doc", "left_anti")
    twice = not each.where("c > 1").isEmpty()
    marked = cut(copies.select("doc").union(each.where("c > 1").select("doc")).distinct(), "marked")
    shown, many = None, marked.count()
    marks = spark.sparkContext.broadcast(bit_map(marked, "doc")) if many <= MAP_IDS else None
    if many:  # documents that may be copies: only one of each class shows its fragments
        shown = docs.mapInArrow(_keys(n, pct, often, marks, True), "doc long, s1 long, s2 long, keys array<long>").join(reps.select("doc", "s1", "s2"), ["doc", "s1", "s2"], "left_semi").select(F.explode("keys").alias("key"), "doc")
    if marks:
        rest = docs.mapInArrow(_keys(n, pct, often, marks, False), "doc long, keys array<long>").select(F.explode("keys").alias("key"), "doc")
        shown = shown.union(rest) if shown else rest
    shown = shown.repartition("key").sortWithinPartitions("key", "doc")
    shared = cut(shown.mapInArrow(_stars, "key long, lead long, doc long"), "shared")
    del shown
    release(spark)
    sets = _Sets(docs, n, reps, twice)
    sigs = sets.of(shared.select("doc").distinct(), _signatures, "doc long, s1 long, s2 long, n long, sig array<long>", "signatures")
    buckets = shared.groupBy("key").agg(F.count("*").alias("c"))
    # of a wide bucket, the document that most wide buckets hold comes first: it is close to most of a group, and most of the group's buckets have it
    wide = cut(shared.join(buckets.where(F.col("c") > SMALL), "key", "left_semi").select("key", "doc"), "wide")
    few = cut(shared.join(buckets.where(F.col("c") <= SMALL), "key", "left_semi").select("key", "lead", "doc"), "few")
    held = wide.withColumn("m", F.count("*").over(W.partitionBy("doc")))  # as many rows a document as it has fragments
    leads = held.groupBy("key").agg(F.max_by("doc", F.struct("m", -F.col("doc"))).alias("lead"), F.count("*").alias("k"))
    in_all = wide.count()
    # first each document is compared with one document: the first one of most of its wide buckets, and of most of its small ones
    pick = cut(_most(split_join(wide, leads, ["key"], "k", in_all).where("lead <> doc").select("doc", "lead"), "doc", "lead"), "first")
    near = _plausible(_most(few.where("lead <> doc").select("doc", "lead"), "doc", "lead").select(F.col("lead").alias("a"), F.col("doc").alias("b")), sigs, pct)
    first = cut(pick.select(F.col("lead").alias("a"), F.col("doc").alias("b")).union(near).distinct(), "pairs")
    both = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    schema = ", ".join(f"{k} {v}" for k, v in _PARTS.items())
    asked = cut(both(first), "asked")
    parts = sets.of(asked, _parts, schema, "parts")
    scored = cut(_scored(first, parts, pct), "scored")
    links = scored.where("linked").select("a", "b")
    comp = cut(components(links), "comp")
    # small buckets with several components: the pairs of these
    placed = _placed(few.select("key", "doc"), comp)
    placed = placed.join(_open(placed), "key", "left_semi")
    left, right = placed.select("key", F.col("doc").alias("a"), F.col("c").alias("ca")), placed.select("key", F.col("doc").alias("b"), F.col("c").alias("cb"))
    pairs = left.join(right, "key").where("a < b AND ca <> cb").select("a", "b").distinct()
    done = scored.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = cut(_plausible(pairs.join(done, ["a", "b"], "left_anti"), sigs, pct), "pairs")
    # wide buckets with several components: what all their documents are compared with is the one that most of them have been compared with
    placed = _placed(wide, comp)
    placed = cut(split_join(placed, _open(placed), ["key"], "k", in_all).join(pick, "doc", "left").select("key", "doc", "lead"), "open")
    refs = _most(placed.where("lead IS NOT NULL").select("key", "lead"), "key", "lead").withColumnRenamed("lead", "a").join(placed.groupBy("key").agg(F.count("*").alias("k")), "key")
    group = cut(split_join(placed, refs, ["key"], "k", in_all).where("doc <> a").select("a", F.col("doc").alias("b")).distinct(), "group")
    extra = cut(group.join(scored.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    new = cut(both(pairs.union(extra)).join(asked, "doc", "left_anti"), "asked")
    if not new.isEmpty():
        parts = parts.union(sets.of(new, _parts, schema, "parts"))
    if not extra.isEmpty():
        more = cut(_scored(extra, parts, pct), "scored")
        scored = scored.union(more)
        links = cut(links.union(more.where("linked").select("a", "b")), "links")
        comp = cut(components(links), "comp")
    second = _apart(pairs, comp)
    if not group.isEmpty():
        rest = _rest(scored.join(group, ["a", "b"], "left_semi"), comp, parts, pct)
        second = second.union(_plausible(rest, sigs, pct))
    second = cut(second.distinct(), "pairs")
    # some pairs of each document first: those that link settle most of the others
    nth = lambda c, o: F.row_number().over(W.partitionBy(c).orderBy(F.xxhash64(o)))
    some = cut(second.withColumns({"i": nth("a", "b"), "j": nth("b", "a")}).where(F.least("i", "j") <= SOME).select("a", "b"), "pairs")
    if not some.isEmpty():
        links = cut(links.union(_scored(some, parts, pct).where("linked").select("a", "b")), "links")
        comp = cut(components(links), "comp")
        last = cut(_apart(second.join(some, ["a", "b"], "left_anti"), comp), "pairs")
        if not last.isEmpty():
            links = links.union(_scored(last, parts, pct).where("linked").select("a", "b"))
    comp = cut(components(links.union(copies.select(F.col("rep").alias("a"), F.col("doc").alias("b")))).withColumnRenamed("id", "doc"), "comp")
    for table in (shared, parts, wide, few):
        drop_scratch(table)
    return bare.join(comp, "doc", "left").select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))


def near_copy_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: the document with the smallest doc_id of each group stays."""
    groups = similar_groups(docs, n=5, pct=80)
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*map(name, docs.columns))
