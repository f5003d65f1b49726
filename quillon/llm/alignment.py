"""Alignment of two tokenizers' tokens over the same bytes, by a transducer of dangling suffixes.

Of two token sequences over one text, one side leads by some bytes that the other hasn't reached, the dangling suffix. The next token comes from the side behind; it
shortens the suffix, or takes the lead with a suffix of its own. Side, suffix and token determine what follows, so transitions are kept once made. Where the suffix is empty, both sides end a token, and a group closes.

Tokens link where they end together. The counts of linked pairs of ids over all texts come with the first pass, summed in each task; there are at most a
few for each byte of both vocabularies, for of two tokens that end together one is a suffix of the other, so the table of counts is bounded whatever the texts are. A second pass, over the links that the first
one wrote, looks each link's count up.

Where both tokenizers split in front of a space behind a character that isn't white space (checked when they are loaded), a text is aligned chunk by chunk, and a chunk seen before comes from a table of bounded size.
Other tokenizers take whole texts as one chunk.

Defined cases: null and empty texts, and those of which one side's bytes aren't a space and the text, have no tokens, and zeros; a chunk may be of any length; strings of special tokens are plain text;
repeated rows and null ids come out each, alike, and count each; an empty table gives an empty table; other columns are ignored, whatever their names. Ties between counts all count as best.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import cut, name, portions

#: Bytes of chunks that a task keeps, about, and transitions, before it starts anew; chunks of a line that are encoded together.
CACHE, STEPS, LINE = 35_000_000, 400_000, 500
SPACE = "▁"
RESULT = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def byte_alphabet() -> dict[str, int]:
    """The character for each byte in byte-level vocabularies: printable Latin-1 stands for itself, the others for characters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """Where two token sequences end together. A state: which side leads (1: the first, -1: the second, 0: none) and the bytes by which it does.

    States and transitions have numbers. Many pairs of sequences go on step by step together, and a step looks all their transitions up at once; only new ones are made one by one.
    """

    LONG = 64  # tokens of a sequence from which on it goes by itself

    def __init__(self, first: list[bytes], second: list[bytes]) -> None:
        self.first, self.second, self.width = first, second, max(len(first), len(second), 1)
        self.clear()

    def clear(self) -> None:
        self.states, self.number, self.lead = [(0, b"")], {(0, b""): 0}, np.zeros(1, np.int8)
        self.keys, self.values = np.empty(0, np.int64), np.empty(0, np.int64)
        self.recent: dict[int, int] = {}

    def step(self, state: int, token: int) -> int:
        """The state after the next token of the side behind; -1: the bytes differ."""
        key = state * self.width + token
        if (to := self.recent.get(key)) is None:
            lead, rest = self.states[state]
            new = self.second[token] if lead > 0 else self.first[token]
            if rest.startswith(new):
                left = rest[len(new) :]
                to = self._number((lead if left else 0), left)
            elif new.startswith(rest):
                to = self._number((-1 if lead > 0 else 1), new[len(rest) :])
            else:
                to = -1
            self.recent[key] = to
        return to

    def _number(self, lead: int, rest: bytes) -> int:
        if (lead, rest) not in self.number:
            self.number[lead, rest] = len(self.states)
            self.states.append((lead, rest))
        return self.number[lead, rest]

    def steps(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        key = state * self.width + token
        i = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        known = self.keys[i] == key if len(self.keys) else np.zeros(len(key), bool)
        to = np.where(known, self.values[i], -1) if len(self.keys) else np.full(len(key), -1)
        if not known.all():
            rest, back = np.unique(key[~known], return_inverse=True)
            to[~known] = np.array([self.step(*divmod(k, self.width)) for k in rest.tolist()])[back]
            self.lead = np.array([x for x, _ in self.states], np.int8) if len(self.states) > len(self.lead) else self.lead
            if len(self.recent) > 4096:
                keys, values = np.concatenate((self.keys, np.fromiter(self.recent, np.int64))), np.concatenate((self.values, np.fromiter(self.recent.values(), np.int64)))
                self.keys, at = np.unique(keys, return_index=True)
                self.values = values[at]
                self.recent.clear()
        return to

    def ends(self, a: list[int], b: list[int]) -> list[tuple[int, int]] | None:
        """How many tokens of each side each group's end has behind it; None if the bytes differ."""
        i = j = state = 0
        out = []
        while i < len(a) or j < len(b):
            if self.states[state][0] > 0:
                if j == len(b):
                    return None
                state = self.step(state, b[j])
                j += 1
            else:
                if i == len(a):
                    return None
                state = self.step(state, a[i])
                i += 1
            if state < 0:
                return None
            if not state:
                out.append((i, j))
        return None if state else out

    def ends_of(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of sequences one after the other: (pair, end in a, end in b) of each group, in order, and which pairs have the same bytes."""
        if len(self.keys) + len(self.recent) > STEPS:
            self.clear()
        end_a, end_b = np.cumsum(n_a), np.cumsum(n_b)
        i, j, state, good = end_a - n_a, end_b - n_b, np.zeros(len(n_a), np.int64), np.ones(len(n_a), bool)
        out, live = [], np.flatnonzero(n_a + n_b < self.LONG)
        for k in np.flatnonzero(n_a + n_b >= self.LONG).tolist():
            found = self.ends(a[i[k] : end_a[k]].tolist(), b[j[k] : end_b[k]].tolist())
            good[k] = found is not None
            if found:
                one, two = np.array(found).T
                out.append((np.full(len(one), k), i[k] + one, j[k] + two))
        self.lead = np.array([x for x, _ in self.states], np.int8)
        while True:
            second = self.lead[state[live]] > 0
            over = np.where(second, j[live] == end_b[live], i[live] == end_a[live])
            good[live[over]] = (state[live[over]] == 0) & (j[live[over]] == end_b[live[over]])
            live, second = live[~over], second[~over]
            if not len(live):
                break
            token = np.empty(len(live), np.int64)
            token[second], token[~second] = b[j[live[second]]], a[i[live[~second]]]
            state[live] = self.steps(state[live], token)
            j[live[second]] += 1
            i[live[~second]] += 1
            good[live[state[live] < 0]] = False
            live = live[state[live] >= 0]
            shut = live[state[live] == 0]
            out.append((shut, i[shut], j[shut]))
        pair, one, two = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, np.int64),) * 3
        keep = good[pair]
        order = np.lexsort((one[keep], pair[keep]))
        return pair[keep][order], one[keep][order], two[keep][order], good


class Aligner:
    """Two tokenizers, and chunks that were aligned before."""

    _CUT, _ODD = re.compile(r"(?<=\S)(?= )"), re.compile(r"\s ")

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        with open(a_path, encoding="utf-8") as f:
            plain = json.load(f)
        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        first = [b""] * self.a.get_vocab_size()
        for t, i in self.a.get_vocab().items():
            first[i] = bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode()
        for t in plain["added_tokens"]:
            first[t["id"]] = t["content"].encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        second = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.steps, self.base = Transducer(first, second), len(pieces)
        self.len_a, self.len_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (first, second))
        self.bytes_a = pa.array(first, pa.binary())
        self.names_a, self.names_b = (pa.array([str(i) for i in range(len(x))], pa.string()) for x in (first, second))
        before = plain.get("pre_tokenizer") or {}
        self.chunked = (
            (before.get("type"), before.get("use_regex"), before.get("add_prefix_space"), plain.get("normalizer")) == ("ByteLevel", True, False, None)
            and not any(SPACE in p.lstrip(SPACE) for p in pieces)
            and self.b.normalize("a  ﬁ Ａ①").replace(SPACE, " ").strip() == "a  ﬁ Ａ①"
        )
        self.wide = len(first) * self.base >= 1 << 31
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.text: list[str] = []
        self.size = 0
        self.n_a = self.n_b = self.n_groups = self.good = self.start = np.empty(0, np.int64)
        self.links = self.bytes = np.empty(0, np.int64)

    def split(self, text: str) -> list[str]:
        """The chunks of a space and the text, without the space that each begins with."""
        if not self.chunked:
            return [text]
        out = text.split(" ") if not self._ODD.search(text) and text[:1] != " " else [c[1:] for c in self._CUT.split(" " + text)]
        if len(out) > 1 and not out[-1]:  # a space at the end stays with what is before it
            out[-2:] = [out[-2] + " "]
        return out

    def _first_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the first side, one chunk after the other, and how many each has. Chunks that end in no white space are encoded in a line, and told apart by the bytes of their tokens."""
        if not self.chunked:
            ids = [x.ids for x in self.a.encode_batch_fast([f" {c}" for c in chunks], add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(ids), np.int64), np.fromiter(map(len, ids), np.int64, len(ids))
        alone = np.array([not c or c[-1].isspace() for c in chunks])
        size = np.fromiter((len(c.encode()) + 1 for c in chunks), np.int64, len(chunks))
        n, line = np.zeros(len(chunks), np.int64), []
        inline = np.flatnonzero(~alone)
        for lo in range(0, len(inline), LINE):
            own = inline[lo : lo + LINE]
            ids = np.array(self.a.encode_batch_fast(["".join([f" {chunks[k]}" for k in own.tolist()])], add_special_tokens=False)[0].ids, np.int64)
            ends, due = np.cumsum(self.len_a[ids]), np.cumsum(size[own])
            at = np.searchsorted(ends, due)
            if at[-1] >= len(ends) or not (ends[at] == due).all():  # bytes are missing: each by itself
                alone[own] = True
                continue
            n[own] = np.diff(at + 1, prepend=0)
            line.append(ids)
        rest = np.flatnonzero(alone).tolist()
        others = [x.ids for x in self.a.encode_batch_fast([f" {chunks[k]}" for k in rest], add_special_tokens=False)]
        n[rest] = list(map(len, others))
        out, by_itself = np.empty(int(n.sum()), np.int64), np.repeat(alone, n)
        out[~by_itself] = np.concatenate(line) if line else 0
        out[by_itself] = np.fromiter(chain.from_iterable(others), np.int64)
        return out, n

    def _whole(self, a: np.ndarray, n_a: np.ndarray, chunks: list[str]) -> np.ndarray:
        """Whether the tokens' bytes are a space and the chunk."""
        raw = [f" {c}".encode() for c in chunks]
        want = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(np.concatenate(([0], self.len_a[a])))
        at = np.concatenate(([0], np.cumsum(n_a)))
        out = np.diff(ends[at]) == want
        if out.all():
            got = self.bytes_a.take(pa.array(a))
            same = np.frombuffer(got.buffers()[2], np.uint8, int(ends[-1])) == np.frombuffer(b"".join(raw), np.uint8)
            return np.logical_and.reduceat(same, np.cumsum(want) - want)
        for k in np.flatnonzero(out).tolist():
            out[k] = b"".join([self.steps.first[x] for x in a[at[k] : at[k + 1]].tolist()]) == raw[k]
        return out

    def add(self, chunks: list[str]) -> None:
        a, n_a = self._first_ids(chunks)
        seconds = self.b.encode(chunks, num_threads=1)
        b, n_b = np.fromiter(chain.from_iterable(seconds), np.int64), np.fromiter(map(len, seconds), np.int64, len(seconds))
        whole = self._whole(a, n_a, chunks)
        pair, one, two, good = self.steps.ends_of(a, n_a, b, n_b)
        keep = whole[pair]
        pair, one, two, good = pair[keep], one[keep], two[keep], good & whole
        n_groups = np.bincount(pair, minlength=len(chunks))

        def joined(ids: np.ndarray, n: np.ndarray, end: np.ndarray, names: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
            """Each group's ids as text, and the ids of good chunks with the groups' ends among them."""
            kept = np.repeat(good, n)
            ends = np.cumsum(kept)[end - 1] if len(end) else end
            texts = names.take(pa.array(ids[kept]))
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), texts), ","), ids[kept], ends

        text_a, _, _ = joined(a, n_a, one, self.names_a)
        text_b, ids_b, ends_b = joined(b, n_b, two, self.names_b)
        each = pc.binary_join_element_wise(text_a, text_b, "|")
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n_groups))), pa.int32()), each)
        upto = np.cumsum(self.len_b[ids_b])
        sizes = np.diff(upto[ends_b - 1], prepend=0) if len(ends_b) else ends_b
        self.at.update(zip(chunks, range(len(self.text), len(self.text) + len(chunks)), strict=True))
        self.text += pc.binary_join(lists, ";").to_pylist()
        self.size += sum(map(len, chunks)) + len(a) * 6 + len(chunks) * 200
        at = len(self.links) + np.cumsum(n_groups) - n_groups
        links = a[one - 1] * self.base + b[two - 1] if len(one) else one
        for what, new in (("n_a", n_a), ("n_b", n_b), ("n_groups", n_groups), ("good", good.astype(np.int64)), ("start", at), ("links", links), ("bytes", sizes)):
            setattr(self, what, np.concatenate((getattr(self, what), new.astype(np.int64))))

    def links_of(self, chunks: np.ndarray) -> np.ndarray:
        """Places in links of the groups of these chunks, one after the other."""
        n = self.n_groups[chunks]
        return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.start[chunks], n)


_KEPT: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """The worker's aligner, which it keeps from task to task."""
    if (a_path, b_path) not in _KEPT:
        _KEPT.clear()
        _KEPT[a_path, b_path] = Aligner(a_path, b_path)
    return _KEPT[a_path, b_path]


class _Pairs:
    """Counts of linked pairs; one number each, so bounded as the pairs are."""

    def __init__(self) -> None:
        self.pair = self.n = np.empty(0, np.int64)

    def add(self, pair: np.ndarray, n: np.ndarray) -> None:
        self.pair, back = np.unique(np.concatenate((self.pair, pair)), return_inverse=True)
        self.n = np.bincount(back, np.concatenate((self.n, n)), len(self.pair)).astype(np.int64)


def _aligned(a_path: str, b_path: str, with_groups: bool):
    """A row for each document, with its links, and rows (pair, n) of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, total, held = aligner(a_path, b_path), _Pairs(), np.zeros(0, np.int64)
        kind = pa.int64() if one.wide else pa.int32()
        names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links", "pair", "n", *["groups", "ends"] * with_groups]
        types = [pa.int64(), *[pa.int64()] * 3, pa.string(), pa.list_(kind), pa.int64(), pa.int64(), *[pa.string(), pa.list_(pa.int64())] * with_groups]

        def fold() -> None:
            chunks = np.flatnonzero(held)
            total.add(one.links[one.links_of(chunks)], np.repeat(held[chunks], one.n_groups[chunks]))

        for b in batches:
            for part in portions(b, 1, 400, 1_000_000):
                if one.size > CACHE:
                    fold()
                    one.clear()
                    held = np.zeros(0, np.int64)
                texts = part.column(1).to_pylist()
                each = [one.split(t) if t else [] for t in texts]
                new = list(set(chain.from_iterable(each)) - one.at.keys())
                for lo in range(0, len(new), 10_000):
                    one.add(new[lo : lo + 10_000])
                get, rows = one.at.__getitem__, []
                used, flat = [], []
                for chunks in each:
                    own = np.fromiter(map(get, chunks), np.int64, len(chunks))
                    if not len(own) or not one.good[own].all():
                        rows.append((0, 0, 0, "", 0) + ("",) * with_groups)
                        used.append(own[:0])
                        continue
                    said = ";".join([one.text[i] for i in own.tolist()])
                    rows.append((int(one.n_a[own].sum()), int(one.n_b[own].sum()), int(n := one.n_groups[own].sum()), hashlib.sha256(said.encode()).hexdigest(), int(n)) + (said,) * with_groups)
                    used.append(own)
                flat = np.concatenate(used) if used else np.empty(0, np.int64)
                held = np.concatenate((held, np.zeros(len(one.text) - len(held), np.int64))) + np.bincount(flat, minlength=len(one.text))
                at = one.links_of(flat)
                n_a, n_b, n_groups, sha, sizes, *said = zip(*rows, strict=True)
                where = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                cols = [part.column(0), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), pa.array(n_groups, pa.int64()), pa.array(sha), pa.ListArray.from_arrays(pa.array(where), pa.array(one.links[at].astype(np.int64 if one.wide else np.int32))), *[pa.nulls(len(rows), pa.int64())] * 2]
                if with_groups:
                    upto = np.cumsum(one.bytes[at])
                    back = np.repeat(np.concatenate(([0], upto))[where[:-1]], sizes)
                    cols += [pa.array(said[0]), pa.ListArray.from_arrays(pa.array(where), pa.array(upto - back))]
                yield pa.RecordBatch.from_arrays(cols, names)
        fold()
        none = [pa.nulls(len(total.pair), t) for t in types]
        none[6:8] = pa.array(total.pair), pa.array(total.n)
        yield pa.RecordBatch.from_arrays(none, names)

    return run


def _looked_up(pair: np.ndarray, n: np.ndarray, best: np.ndarray, kept: int):
    """Rows' links replaced by their number, how many of them are best, and the sum of their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _KEPT.clear()  # the first pass is over
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                links = part.column(kept)
                ends = np.concatenate(([0], np.cumsum(np.nan_to_num(links.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64))))
                at = np.searchsorted(pair, links.flatten().to_numpy())
                sums = [np.concatenate(([0], np.cumsum(x[at]))) for x in (best.astype(np.int64), n)] if len(pair) else [np.zeros(1, np.int64)] * 2
                cols = [np.diff(ends), *(x[ends[1:]] - x[ends[:-1]] for x in sums)]
                yield pa.RecordBatch.from_arrays([*part.columns[:kept], *map(pa.array, cols)], [*part.schema.names[:kept], "n_links", "n_best", "count_sum"])

    return run


def a_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def b_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def align(df: DataFrame, a: str, b: str, text: str = "text", doc_id: str = "doc_id", with_groups: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups_sha256, n_links, n_best, count_sum) of each row; with_groups: also the groups' ids, and the bytes of a space and the text before each group's end.

    a: a byte-level vocabulary of the tokenizers library; b: a sentencepiece model.
    """
    both = aligner(a, b)
    more = ", groups string, ends array<long>" if with_groups else ""
    schema = f"doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links array<{'long' if both.wide else 'int'}>, pair long, n long{more}"
    base = both.base
    rows = cut(df.select(F.col(name(doc_id)).cast("long"), F.col(name(text)).cast("string")).mapInArrow(_aligned(a, b, with_groups), schema), "links")
    counts = rows.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("n")).orderBy("pair").toArrow()  # a few rows for each byte of the vocabularies at most
    pair, n = (counts.column(c).to_numpy() for c in ("pair", "n"))
    most = np.zeros(base, np.int64)
    np.maximum.at(most, pair % base, n)
    own = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", *["groups", "ends"] * with_groups]
    shape = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in own)
    return rows.where("pair IS NULL").select(*own, "links").mapInArrow(_looked_up(pair, n, n == most[pair % base], len(own)), f"{shape}, n_links long, n_best long, count_sum long")
