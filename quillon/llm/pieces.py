"""SentencePiece encoding and decoding with the N best segmentations.

The lattice of a text has an edge for every piece that occurs at a place, with the piece's score. Forward Viterbi gives the best score of every prefix; these
are exact heuristics for an A-star search from the end of the text, which so pops segmentations in the order of their scores.
No piece crosses a boundary in front of a run of spaces or at a line break (checked when a model is loaded), so lattices are those of chunks, and
a text's N best segmentations combine the N best of its N - 1 chunks whose second segmentation costs least. All N are given whole, as ids, and each of them is decoded and held against the text. Viterbi runs over all new chunks of a
batch at once; chunks seen before come from a table of bounded size. A batch's texts are cut up, their ids put together and all segmentations decoded as arrays.

Characters without a piece become byte pieces, at a score below every piece's.

Defined cases: null and empty texts have no pieces, score 0 and one segmentation; U+2581 in a text is a space, as in the library; a chunk without spaces may be of any length;
ties go to the longer last piece within a chunk, and to changes in earlier chunks within a text; an empty table gives an empty table; repeated rows come out each, alike;
other columns pass through, whatever their names, unless they are named as a result.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import name, packed, portions, unpacked, with_fields

SPACE = "▁"
#: Chunks of which a task keeps the segmentations before it starts anew.
CACHE = 500_000
RESULT = "ids array<int>, n_pieces long, score double, scores array<double>, nbest array<array<int>>, round_trip boolean"
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Lattice:
    def __init__(self, model: str, nbest: int = 4) -> None:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=model)
        ids = [i for i in range(p.get_piece_size()) if not (p.is_byte(i) or p.is_unknown(i) or p.is_control(i) or p.is_unused(i))]
        self.pieces = {p.id_to_piece(i): (p.get_score(i), i) for i in ids}
        self.bytes_of = [b""] * p.get_piece_size()
        self.byte_id = {}
        for i in range(p.get_piece_size()):
            if p.is_byte(i):
                self.byte_id[b := int(p.id_to_piece(i)[3:-1], 16)] = i
                self.bytes_of[i] = bytes([b])
        for s, (_, i) in self.pieces.items():
            self.bytes_of[i] = s.encode()
        self.plain_of = pa.array([b.replace(SPACE.encode(), b" ") for b in self.bytes_of], pa.large_binary())
        if any(SPACE in s.lstrip(SPACE) or "\n" in s and len(s) > 1 for s in self.pieces):
            raise ValueError("pieces cross chunks")
        self.longest, self.nbest = max(map(len, self.pieces)), nbest
        self.floor = min(s for s, _ in self.pieces.values()) - 10.0
        self.powers = np.ones(1, np.uint64)
        keys = np.array([self._hash(s) for s in self.pieces], np.uint64)
        order = np.argsort(keys)
        self.keys, (self.score, self.id) = keys[order], np.array(list(self.pieces.values()))[order].T
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(self.keys >> np.uint64(42)).astype(np.int64)] = True
        self.first = np.searchsorted(self.keys >> np.uint64(44), np.arange(1 << 20, dtype=np.uint64)).astype(np.int32)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces have one hash")
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.ids: list[bytes] = []
        self.best, self.gap = np.empty(0), np.empty(0)
        self.lists: dict[str, list[tuple[float, list[int]]]] = {}
        self.rest: dict[str, list[tuple[float, bytes]]] = {}

    def _hash(self, s: str) -> int:
        h = 0
        for c in s:
            h = (h * int(_BASE) + (ord(c) + 1) * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF
        return h

    def _lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores (minus infinity where there is no piece) and numbers of pieces by hash. A bit map turns most strings down before the search."""
        score, at = np.full(h.size, -np.inf), np.zeros(h.size, np.int64)
        may = np.flatnonzero(self.seen[(h >> np.uint64(42)).view(np.int64)])
        own = h.ravel()[may]
        i = np.minimum(self.first[(own >> np.uint64(44)).view(np.int64)], len(self.keys) - 1)
        hit = self.keys[i] == own
        if len(late := np.flatnonzero(~hit)):  # not the first key with these leading bits
            i[late] = np.minimum(np.searchsorted(self.keys, own[late]), len(self.keys) - 1)
            hit[late] = self.keys[i[late]] == own[late]
        score[may], at[may] = np.where(hit, self.score[i], -np.inf), i
        return score.reshape(h.shape), at.reshape(h.shape)

    def viterbi(self, chunks: list[str]) -> None:
        """Adds chunks to the table: ids and score of the best segmentation, and what the second costs more."""
        by_size: dict[int, list[int]] = {}
        for k, c in enumerate(chunks):
            by_size.setdefault(len(c), []).append(k)
        ids: list[bytes] = [b""] * len(chunks)
        best, gap = np.zeros(len(chunks)), np.full(len(chunks), np.inf)
        for size, own in by_size.items():
            for lo in range(0, len(own), 1 << 16):
                self._same_size(size, own[lo : lo + (1 << 16)], chunks, ids, best, gap)
        start = len(self.ids)
        self.at.update(zip(chunks, range(start, start + len(chunks)), strict=True))
        self.ids += ids
        self.best, self.gap = np.concatenate((self.best, best)), np.concatenate((self.gap, gap))

    def _same_size(self, size: int, own: list[int], chunks: list[str], ids: list[bytes], best: np.ndarray, gap: np.ndarray) -> None:
        n = len(own)
        code = np.frombuffer("".join([chunks[k] for k in own]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, size).astype(np.uint64)
        code = (code + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        alpha, step, piece, second = np.full((n, size + 1), -np.inf), np.zeros((n, size + 1), np.int32), np.full((n, size + 1), -1, np.int64), np.full((n, size + 1), np.inf)
        alpha[:, 0] = 0
        width = min(self.longest, size)
        rolled = np.zeros((n, width + 1), np.uint64)  # hashes of the strings of each length that end here
        for j in range(1, size + 1):
            m = min(width, j)
            rolled[:, 1 : m + 1] = rolled[:, 0:m] * _BASE + code[:, j - 1, None]
            rolled[:, 0] = 0
            score, at = self._lookup(rolled[:, 1 : m + 1])
            score[:, 0] = np.where(score[:, 0] == -np.inf, self.floor, score[:, 0])
            total = score + alpha[:, j - m : j][:, ::-1]
            total, at = total[:, ::-1], at[:, ::-1]  # longest piece first: it wins ties
            pick = np.argmax(total, 1)
            rows = np.arange(n)
            top = total[rows, pick]
            alpha[:, j], step[:, j] = top, m - pick
            known = (m - pick > 1) | (self.keys[at[rows, pick]] == rolled[:, 1])
            piece[:, j] = np.where(known, self.id[at[rows, pick]], -1)
            if m > 1:
                total[rows, pick] = -np.inf
                second[:, j] = top - total.max(1)
        best[own] = alpha[:, size]
        pos, rows, low, back = np.full(n, size), np.arange(n), np.full(n, np.inf), []
        while pos.any():
            on = pos > 0
            back.append(np.where(on, piece[rows, pos], -2))
            low = np.where(on, np.minimum(low, second[rows, pos]), low)
            pos = np.where(on, pos - step[rows, pos], 0)
        gap[own] = low
        path = np.stack(back[::-1], 1).astype("<i4")
        used = path >= 0
        flat, ends = path[used].tobytes(), (4 * np.cumsum(used.sum(1))).tolist()
        for k, lo, hi in zip(own, [0, *ends], ends, strict=False):
            ids[k] = flat[lo:hi]
        for r in np.flatnonzero((path == -1).any(1)).tolist():
            ids[own[r]] = self._with_bytes(chunks[own[r]], step[r])

    def _with_bytes(self, chunk: str, step: np.ndarray) -> bytes:
        out, j = [], len(chunk)
        while j:
            out.append(self._ids(chunk[j - step[j] : j])[::-1])
            j -= int(step[j])
        return np.array([x for part in out for x in part][::-1], "<i4").tobytes()

    def _ids(self, s: str) -> list[int]:
        return [self.pieces[s][1]] if s in self.pieces else [self.byte_id[b] for b in s.encode("utf-8", "surrogatepass")]

    def search(self, chunk: str) -> list[tuple[float, list[int]]]:
        """Up to nbest segmentations (score, ids), best first: A-star from the end, with the forward scores as heuristics. Of equal ones the latest pushed comes first, so that a path is followed to its end before others like it are."""
        if chunk in self.lists:
            return self.lists[chunk]
        n = len(chunk)
        into: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        alpha = [0.0] + [-np.inf] * n
        for j in range(1, n + 1):
            for i in range(max(0, j - self.longest), j):
                s = self.pieces.get(chunk[i:j], (self.floor if j - i == 1 else None,))[0]
                if s is not None:
                    into[j].append((i, s))
                    alpha[j] = max(alpha[j], alpha[i] + s)
        heap, found, tie = [(-alpha[n], 0, n, 0.0, None)], [], 0
        while heap and len(found) < self.nbest:
            _, _, at, behind, path = heapq.heappop(heap)
            if not at:
                cuts, node = [], path
                while node:
                    cuts.append(chunk[node[0] : node[1]])
                    node = node[2]
                found.append((behind, [x for s in cuts for x in self._ids(s)]))
                continue
            for i, s in reversed(into[at]):
                tie -= 1
                heapq.heappush(heap, (-(alpha[i] + s + behind), tie, i, s + behind, (i, at, path)))
        if len(self.lists) > CACHE // 10:
            self.lists.clear()
        self.lists[chunk] = found
        return found

    @staticmethod
    def chunks(text: str) -> list[str]:
        return re.findall(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+", SPACE + text.replace(" ", SPACE)) if text else []

    @staticmethod
    def cut_up(texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
        """chunks() of all texts as one array, with plain spaces, and where those of each text begin; the last number is their end."""
        rows = [f" {t.replace(SPACE, ' ')}".encode() if t else b"" for t in texts]
        whole, begin = b"".join(rows), np.cumsum([0, *map(len, rows)])
        codes = np.frombuffer(whole, np.uint8)
        space, line = codes == 32, codes == 10
        first = line.copy()
        first[1:] |= line[:-1] | space[1:] & ~space[:-1]
        first[begin[:-1][begin[:-1] < begin[1:]]] = True
        starts = np.flatnonzero(first)
        at = np.append(starts, len(whole)).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(whole)), np.searchsorted(starts, begin)

    def learn(self, texts: list[list[str]]) -> None:
        self.places(list(dict.fromkeys(c for t in texts for c in t)))

    def places(self, chunks: list[str]) -> np.ndarray:
        """Where chunks, each given once, are in the table; new ones are added."""
        if len(self.at) > CACHE:
            self.clear()
        at = np.fromiter(map(self.at.get, chunks, repeat(-1)), np.int64, len(chunks))
        if len(new := np.flatnonzero(at < 0)):
            at[new] = np.arange(len(new)) + len(self.ids)
            self.viterbi([chunks[k] for k in new.tolist()])
        return at

    def read(self, texts: list[str]) -> Iterator[list[tuple[float, bytes]]]:
        """segmentations() of each text's chunks."""
        chunks, begin = self.cut_up(texts)
        coded = chunks.dictionary_encode()
        names = pc.replace_substring(coded.dictionary, " ", SPACE).to_numpy(zero_copy_only=False).tolist()
        known, of = self.places(names), coded.indices.to_numpy()
        ids = pa.array([self.ids[k] for k in known.tolist()], pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[: len(of) + 1] if len(of) else np.zeros(1, np.int64)
        data, best, gap = ids.buffers()[2], self.best[known][of], self.gap[known][of]
        for lo, hi in zip(begin.tolist(), begin[1:].tolist(), strict=False):
            own = data[ends[lo] : ends[hi]].to_pybytes() if lo < hi else b""
            yield self._ways(best[lo:hi], gap[lo:hi], own, ends[lo : hi + 1] - ends[lo], lambda k, of=of[lo:hi]: names[of[k]])

    def segmentations(self, chunks: list[str]) -> list[tuple[float, bytes]]:
        """Up to nbest segmentations of a text (score, ids as little-endian 32-bit integers), best first; learn() has seen the chunks."""
        at = np.array([self.at[c] for c in chunks], np.int64)
        ids = [self.ids[k] for k in at.tolist()]
        return self._ways(self.best[at], self.gap[at], b"".join(ids), np.cumsum([0, *map(len, ids)]), chunks.__getitem__)

    def _ways(self, best: np.ndarray, gap: np.ndarray, ids: bytes, ends: np.ndarray, chunk: Callable[[int], str]) -> list[tuple[float, bytes]]:
        """segmentations() from the best ones of the chunks: their scores, what the second costs more, and all their ids, which end at these bytes."""
        if not len(gap):
            return [(0.0, b"")]
        score, few = float(best.sum()), min(self.nbest - 1, len(gap))
        near = np.flatnonzero(gap <= np.partition(gap, few - 1)[few - 1]) if few else np.arange(0)
        near = near[np.argsort(gap[near], kind="stable")][:few]
        ways: list[tuple[float, dict[int, bytes]]] = [(0.0, {})]  # what a combination costs more, and the chunks in which it differs
        for k in near[gap[near] < np.inf].tolist():
            own = self.others(chunk(k), ids[ends[k] : ends[k + 1]])
            ways = sorted((w for c, d in ways for w in ((c, d), *((c + x, d | {k: o}) for x, o in own))), key=lambda w: w[0])[: self.nbest]
        out = []
        for cost, changed in ways:
            parts, upto = [], 0
            for k in sorted(changed):
                parts += [ids[upto : ends[k]], changed[k]]
                upto = ends[k + 1]
            out.append((score - cost, b"".join([*parts, ids[upto:]])))
        return out

    def others(self, chunk: str, best: bytes) -> list[tuple[float, bytes]]:
        """Of a chunk's nbest segmentations those but the best: what each costs more, and its ids."""
        if chunk not in self.rest:
            found = [(s, np.array(i, "<i4").tobytes()) for s, i in self.search(chunk)]
            if len(self.rest) > CACHE // 10:
                self.rest.clear()
            self.rest[chunk] = [(found[0][0] - s, i) for s, i in found if i != best][: self.nbest - 1]
        return self.rest[chunk]

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, float, list[float]]:
        """ids and score of the best segmentation, and the nbest scores."""
        found = self.segmentations(chunks)
        return np.frombuffer(found[0][1], "<i4"), found[0][0], [s for s, _ in found]

    def decode(self, ids: np.ndarray) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "surrogatepass").replace(SPACE, " ")[1:]

    def same(self, texts: list[str], found: list[list[bytes]]) -> list[bool]:
        """Whether all of a text's segmentations decode to it."""
        each = [i for own in found for i in own]
        made = self.plain_of.take(pa.array(np.frombuffer(b"".join(each), "<i4")))
        ends = np.frombuffer(made.buffers()[1], np.int64)[np.cumsum([0, *map(len, each)]) // 4].tolist() if len(made) else [0] * (len(each) + 1)
        data, out, k = made.buffers()[2], [], 0
        for t, own in zip(texts, found, strict=True):
            want = f" {t.replace(SPACE, ' ')}".encode() if t else b""
            out.append(all(b - a == len(want) and (a == b or data[a:b].to_pybytes() == want) for a, b in zip(ends[k:], ends[k + 1 : k + 1 + len(own)], strict=False)))
            k += len(own)
        return out


def _listed(parts: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def _encode(model: str, nbest: int, out: list[str], ids: Callable[[list[bytes]], pa.Array]):
    def whole(lattice: Lattice, part: pa.RecordBatch, texts: list[str], found: list[list[tuple[float, bytes]]]) -> pa.RecordBatch:
        same = lattice.same(texts, [[i for _, i in own] for own in found])
        best = [own[0][1] for own in found]
        ends = pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32))
        more = pa.ListArray.from_arrays(ends, ids([i for own in found for _, i in own]))
        scores = pa.ListArray.from_arrays(ends, pa.array([s for own in found for s, _ in own], pa.float64()))
        cols = [part.column(0), ids(best), pa.array([len(i) // 4 for i in best], pa.int64()), pa.array([own[0][0] for own in found], pa.float64()), scores, more, pa.array(same)]
        return pa.RecordBatch.from_arrays(cols, names=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(model, nbest)
        for b in batches:
            for part in portions(b, 1):
                texts = [t or "" for t in part.column(1).to_pylist()]
                found, at = lattice.read(texts), 0
                for few in portions(part, 1, 100, 500_000):  # a row's segmentations are several times its text
                    own = texts[at : (at := at + few.num_rows)]
                    yield whole(lattice, few, own, list(islice(found, len(own))))

    return run


def encode(df: DataFrame, model: str, text: str = "text", nbest: int = 4, with_ids: bool = True, drop_text: bool = False, as_bytes: bool = False) -> DataFrame:
    """df with ids and score of the best segmentation, n_pieces, nbest (ids of each of the nbest segmentations, best first), their scores, and round_trip: whether all of them decode to the text.

    as_bytes: ids are little-endian 32-bit integers in a binary. Without ids: ids_crc32 and nbest_crc32 instead, of these bytes.
    """
    made, ids = RESULT, _listed
    if not with_ids:
        made, ids = made.replace("ids array<int>", "ids_crc32 long").replace("nbest array<array<int>>", "nbest_crc32 array<long>"), lambda parts: pa.array(list(map(zlib.crc32, parts)), pa.int64())
    elif as_bytes:
        made, ids = made.replace("array<int>", "binary"), lambda parts: pa.array(parts, pa.binary())
    names = [x.split()[0] for x in made.split(", ")]
    rows, kept = packed(df, names, (text,) if drop_text else (), _text=F.col(name(text)).cast("string"))
    return unpacked(rows.mapInArrow(_encode(model, nbest, ["_row", *names], ids), with_fields(rows, "_row", made)), kept, *names)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def pieces_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's last stage: the documents as piece ids, those of all nbest segmentations, without their texts."""
    return encode(docs, model_path(), drop_text=True)
