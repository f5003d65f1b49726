"""Groups of spelling variants: a self-join of the vocabulary's trie with sets of active nodes.

Two words are near if one insertion, deletion or replacement of a character makes one of them the other. A word's form is the near word that
occurs most, if it occurs at least twice as often; its root is where the forms lead.

* Words come with their counts from each task, and are summed by word: a word that a third of all texts hold is a row for each task.
* The trie is cut by prefixes. The place of an edit is the length of the words' common prefix. For words of m characters and those of m + 1, the places are
  cut into blocks, two or more; an edit in a block leaves what is before it and behind it alike, so the block's words meet in one subtree, that of their common prefix, on condition of
  their common rest. Each pair of near words meets in one subtree only. A subtree with more than `MOST` words has its block halved until it is small, so no prefix is hot.
* In a subtree, pairs of active nodes go down level by level: a node has itself at distance 0, and with each two children a pair at distance 1 begins
  (replacement), as with a child and a grandchild (insertion). Pairs at distance 1 go down along equal characters only, and pairs of words' ends come out.
* Forms lead to words at least twice as frequent, so there is no ring; roots are found by doubling the step.

Defined cases: null and empty texts have no words; a null doc_id stands as nothing in front of the colon; repeated rows count each; words of any length take part (a long one
is in as many subtrees as it has blocks of 64 places); an empty table gives an empty table; other columns are ignored, whatever their names.
The work at a node grows with the square of its children, of which there are no more than letters.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import cut, drop_scratch, name, portions

#: Words of a subtree above which its block is halved, and places of a block at most.
MOST, WIDTH = 4096, 64
#: Words that a task counts before it hands its counts on, and rows of subtrees that it joins at once.
HELD, ROWS = 400_000, 20_000
#: Stands behind each word's last character, so that an edit may be there.
END = "\x01"
LETTERS = r"[a-zÀ-ÿ]+"


def slipped(run: str, h: int) -> str:
    """The run without its character h % length."""
    i = h % len(run)
    return run[:i] + run[i + 1 :]


def _count(letters: str, slips: int):
    """Rows (word, n): the words of the texts and how many there are. slips: where the checksum of id and word is divisible by it, a character is left out; 0: nowhere."""
    find = re.compile(letters).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for part in portions(b, 1):
                for d, t in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    runs = find((t.as_py() or "").encode().lower().decode())  # of bytes, only A-Z become small
                    if not slips:
                        total.update(runs)
                        continue
                    own, head = Counter(runs), zlib.crc32(f"{'' if d is None else d}:".encode())
                    for w, n in own.items():
                        h = zlib.crc32(w.encode(), head)
                        total[slipped(w, h) if h % slips == 0 else w] += n
                if len(total) > HELD:
                    yield out()
                    total.clear()
        yield out()

    return run


def vocabulary(df: DataFrame, text: str = "text", doc_id: str = "doc_id", letters: str = LETTERS, least: int = 5, often: int = 3, slips: int = 0) -> DataFrame:
    """(word, n): words of `least` characters or more that occur `often` times or more, in small letters."""
    found = df.select(F.col(name(doc_id)).cast("long"), F.col(name(text)).cast("string")).mapInArrow(_count(letters, slips), "word string, n long")
    return found.where(F.length("word") >= least).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= often)


def _blocks(m: int) -> list[int]:
    """Where the blocks of places 0 to m begin, and the end."""
    n = max(2, -(-(m + 1) // WIDTH))
    return [(m + 1) * j // n for j in range(n + 1)]


_ROW = {"k1": pa.int64(), "k2": pa.int64(), "far": pa.bool_(), "id": pa.int64(), "mid": pa.string()}
_ROW_SCHEMA = "k1 long, k2 long, far boolean, id long, mid string"


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ROW.values(), strict=True)], list(_ROW))


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _parts(word: str, m: int, far: int) -> Iterator[tuple[int, int, str]]:
    """(k1, k2, mid) of a word of m (far: m + 1) characters in each block of words of m: hashes of what is before and behind the block, and what is in it."""
    w, edges = word + END, _blocks(m)
    before, heads = xxhash.xxh3_64(), []
    for j, a in enumerate(edges[:-1]):
        before.update(w[edges[j - 1] if j else 0 : a].encode())
        heads.append(xxhash.xxh3_64_intdigest(f"{m} {a} {before.intdigest()}"))
    behind, tails = xxhash.xxh3_64(), []
    for j in range(len(edges) - 1, 0, -1):
        behind.update(w[edges[j] + far : (edges[j + 1] if j + 1 < len(edges) else m + 1) + far][::-1].encode())
        tails.append(behind.intdigest())
    for j, (h, t) in enumerate(zip(heads, reversed(tails), strict=True)):
        yield _signed(h), _signed(t), w[edges[j] : edges[j + 1] + far]


def _dealt(least: int):
    """Rows (k1, k2, far, id, mid) of words (id, word): as a word of m characters, and as the longer one beside words of m - 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in portions(b, 1, 5000):
                rows, size = [], 0
                for i, w in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    for far in (0, 1) if len(w) > least else (0,):
                        for k1, k2, mid in _parts(w, len(w) - far, far):
                            rows.append((k1, k2, bool(far), i, mid))
                            size += 1
                        if size > 50_000:
                            yield _table(rows)
                            rows, size = [], 0
                if rows:
                    yield _table(rows)

    return run


def _halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row in the two halves of its block."""
    for b in batches:
        rows = []
        for k1, k2, far, i, mid in zip(*(c.to_pylist() for c in b.columns), strict=True):
            h = (len(mid) - far) // 2
            rows.append((_signed(xxhash.xxh3_64_intdigest(f"{k1} first")), _signed(xxhash.xxh3_64_intdigest(f"{k2} {mid[h + far :]}")), far, i, mid[: h + far]))
            rows.append((_signed(xxhash.xxh3_64_intdigest(f"{k1} second {mid[:h]}")), k2, far, i, mid[h:]))
        if rows:
            yield _table(rows)


class Level:
    """The edges of a trie from nodes at depth d to those at d + 1, and the words that end at depth d."""

    def __init__(self, trie: Trie, d: int) -> None:
        inside = trie.length > d
        rows = np.flatnonzero(inside & trie.new[:, d + 1]) if d < trie.codes.shape[1] else np.empty(0, np.int64)
        self.parent, self.child, self.char = (trie.node[rows, d], trie.node[rows, d + 1], trie.codes[rows, d].astype(np.int64)) if len(rows) else (np.empty(0, np.int64),) * 3
        self.key = (self.parent.astype(np.int64) << 21) + self.char
        n = int(trie.node[-1, d + 1]) + 1 if len(rows) else 0
        below = lambda which: np.bincount(trie.node[inside & which, d + 1], minlength=n)[self.child] > 0 if n else np.empty(0, bool)
        self.near, self.far = below(~trie.far), below(trie.far)
        at = trie.length == d
        self.ends = {}
        for far in (False, True):
            rows = np.flatnonzero(at & (trie.far == far))
            self.ends[far] = trie.node[rows, d], trie.id[rows]

    def follow(self, node: np.ndarray, char: np.ndarray, far: bool) -> np.ndarray:
        """Edges from nodes along characters that lead to words of that kind; -1: none."""
        if not len(self.key):
            return np.full(len(node), -1)
        want = (node.astype(np.int64) << 21) + char
        i = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where((self.key[i] == want) & (self.far if far else self.near)[i], i, -1)

    def children(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which, edge): the edges from each node."""
        lo, hi = np.searchsorted(self.parent, node), np.searchsorted(self.parent, node, "right")
        n = hi - lo
        which = np.repeat(np.arange(len(node)), n)
        return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)

    def end(self, node: np.ndarray, far: bool) -> np.ndarray:
        """Words of that kind that end at the nodes; -1: none."""
        nodes, ids = self.ends[far]
        if not len(nodes):
            return np.full(len(node), -1)
        i = np.minimum(np.searchsorted(nodes, node), len(nodes) - 1)
        return np.where(nodes[i] == node, ids[i], -1)


class Trie:
    """Subtrees of sorted rows; group numbers the subtree of each."""

    def __init__(self, group: np.ndarray, mids: list[str], far: np.ndarray, ids: np.ndarray) -> None:
        self.length, self.far, self.id = np.fromiter(map(len, mids), np.int64, len(mids)), far, ids
        width = int(self.length.max())
        self.codes = np.array(mids, f"<U{width}").view(np.uint32).reshape(len(mids), width)
        self.new = np.ones((len(mids), width + 1), bool)
        self.new[1:, 0] = group[1:] != group[:-1]
        self.new[1:, 1:] = self.codes[1:] != self.codes[:-1]
        np.logical_or.accumulate(self.new, axis=1, out=self.new)
        self.node = np.cumsum(self.new, axis=0, dtype=np.int64) - 1

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at distance one: of one length, and of a shorter and a longer word."""
        none = np.empty(0, np.int64)
        out, like, longer, now = [], (none, none), (none, none), Level(self, 0)
        for d in range(self.codes.shape[1] + 1):
            below = Level(self, d + 1) if d < self.codes.shape[1] else None
            for (p, q), level, far in ((like, now, False), (longer, below, True)):
                if len(p) and level:
                    a, b = now.end(p, False), level.end(q, far)
                    out.append((a[met := (a >= 0) & (b >= 0)], b[met]))
            if below is None or not len(now.key):
                break
            # nodes at distance 1 that go on along equal characters
            p, q = like
            which, e = now.children(p)
            f = now.follow(q[which], now.char[e], False)
            ok = (f >= 0) & now.near[e]
            like = now.child[e[ok]], now.child[f[ok]]
            p, q = longer
            which, e = below.children(q)
            f = now.follow(p[which], below.char[e], False)
            ok = (f >= 0) & below.far[e]
            longer = now.child[f[ok]], below.child[e[ok]]
            # a replacement: two children of a node
            near = np.flatnonzero(now.near)
            rest = np.searchsorted(now.parent[near], now.parent[near], "right") - np.arange(len(near)) - 1
            one = np.repeat(np.arange(len(near)), rest)
            two = one + 1 + np.arange(len(one)) - np.repeat(np.cumsum(rest) - rest, rest)
            like = np.concatenate((like[0], now.child[near[one]])), np.concatenate((like[1], now.child[near[two]]))
            # an insertion: a child, and a grandchild by the same character under another child
            if len(below.key):
                up = np.searchsorted(now.child, below.parent)  # the edge to each grandchild's parent
                f = now.follow(now.parent[up], below.char, False)
                ok = (f >= 0) & below.far & (now.char[up] != below.char)
                longer = np.concatenate((longer[0], now.child[f[ok]])), np.concatenate((longer[1], below.child[ok]))
            now = below
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (none, none)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b): pairs of near words of each subtree, from rows sorted by subtree and characters."""
    held: list[pa.RecordBatch] = []

    def join(table: pa.Table) -> pa.RecordBatch:
        k1, k2 = (table.column(i).to_numpy() for i in (0, 1))
        group = np.concatenate(([0], np.cumsum((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))))
        a, b = Trie(group, table.column(4).to_pylist(), table.column(2).to_numpy(), table.column(3).to_numpy()).pairs()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        if sum(x.num_rows for x in held) >= ROWS:
            table = pa.Table.from_batches(held)
            k1, k2 = (table.column(i).to_numpy() for i in (0, 1))
            last = np.flatnonzero((k1 != k1[-1]) | (k2 != k2[-1]))  # the last subtree may go on
            whole = int(last[-1]) + 1 if len(last) else 0
            if whole:
                yield join(table.slice(0, whole))
            held = table.slice(whole).to_batches()
    if held:
        yield join(pa.Table.from_batches(held))


def near_pairs(words: DataFrame, least: int = 1, most: int = MOST) -> DataFrame:
    """(a, b), once each: ids of the words (id, word) that are near. least: the words' characters at least."""
    rows, done = cut(words.select("id", "word").mapInArrow(_dealt(least), _ROW_SCHEMA), "subtrees"), []
    while True:
        wide = F.max(F.length("mid") - F.col("far").cast("int"))
        hot = cut(rows.groupBy("k1", "k2").agg(F.count("*").alias("_n"), wide.alias("_w")).where((F.col("_n") > most) & (F.col("_w") > 1)).select("k1", "k2"), "hot")
        if hot.isEmpty():
            break
        done.append(rows.join(hot, ["k1", "k2"], "left_anti"))
        rows = cut(rows.join(hot, ["k1", "k2"], "left_semi").select(*_ROW).mapInArrow(_halved, _ROW_SCHEMA), "subtrees")
    for more in done:
        rows = rows.union(more.select(*_ROW))
    return rows.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "mid").mapInArrow(_joined, "a long, b long")


def variants(words: DataFrame, ratio: int = 2, least: int = 1, most: int = MOST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words (word, n), all different."""
    known = cut(words.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    pairs = cut(near_pairs(known, least, most), "near")
    both = pairs.union(pairs.select("b", "a"))
    own, other = known.select(F.col("id").alias("a"), F.col("word").alias("v"), F.col("n").alias("m")), known.select(F.col("id").alias("b"), "word", "n")
    both = both.join(own, "a").join(other, "b").where("levenshtein(v, word, 1) = 1")  # subtrees are told apart by hashes
    best = both.groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("n"), "word", F.col("b").alias("id"))).alias("x"), F.first("m").alias("m"))
    form = (-F.col("x.n")) >= ratio * F.col("m")
    best = cut(best.select(F.col("a").alias("id"), "n_near", *[F.when(form, F.col(f"x.{c}")).alias(f"form_{c}") for c in ("id", "word", "n")]), "forms")
    step = best.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("to"))
    while True:  # twice as many forms in each round, and their number grows with the logarithm of n only
        on = step.select(F.col("id").alias("to"), F.col("to").alias("next"))
        step = cut(step.join(on, "to", "left").select("id", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "roots")
        if step.where("moved").isEmpty():
            break
        step = step.select("id", "to")
    roots = step.select("id", "to").join(known.select(F.col("id").alias("to"), F.col("word").alias("root")), "to").select("id", "root")
    out = known.join(best, "id", "left").join(roots, "id", "left")
    return out.select("word", F.col("form_word").alias("form"), F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), (-F.col("form_n")).alias("form_n"))


def group_variants(df: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = 5, often: int = 3, slips: int = 0, ratio: int = 2) -> DataFrame:
    """variants() of the words of df's texts."""
    words = cut(vocabulary(df, text, doc_id, least=least, often=often, slips=slips), "vocabulary")
    out = variants(words, ratio, least)
    drop_scratch(words)
    return out
