"""Alignment of tokenizers against whole texts, offset by offset."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from quillon.llm import alignment


@pytest.fixture(scope="module")
def plain():
    """Token ids and ends of both sides of a whole text, or None, with the libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    a, b = Tokenizer.from_file(alignment.a_path()), sentencepiece.SentencePieceProcessor(model_file=alignment.b_path())
    a.encode_special_tokens = True
    alphabet = {}
    n = 0
    for x in range(256):
        own = 33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255
        alphabet[chr(x) if own else chr(256 + n)] = x
        n += not own
    assert decoders.ByteLevel().decode([next(c for c, x in alphabet.items() if x == 32)]) == " "

    def sides(t):
        if not t:
            return None
        x, y = a.encode(" " + t, add_special_tokens=False), b.encode(t)
        left = [bytes(alphabet[c] for c in s) for s in x.tokens]
        right = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if not b"".join(left) == b"".join(right) == (" " + t).encode():
            return None
        ends = []
        for tokens, ids in ((left, x.ids), (right, y)):
            at, own = 0, []
            for s, i in zip(tokens, ids, strict=True):
                at += len(s)
                own.append((at, i))
            ends.append(own)
        return ends

    return sides


def wanted(rows, sides):
    found, count = [], Counter()
    for d, t in rows:
        both = sides(t)
        if both is None:
            found.append((d, None))
            continue
        a, b = map(dict, both)
        shared = sorted(a.keys() & b.keys())
        links = [(a[e], b[e]) for e in shared]
        count.update(links)
        said, lo = [], 0
        for e in shared:
            said.append("|".join(",".join(str(i) for at, i in own if lo < at <= e) for own in both))
            lo = e
        found.append((d, (len(both[0]), len(both[1]), links, ";".join(said), shared)))
    top = Counter()
    for (_, y), c in count.items():
        top[y] = max(top[y], c)
    out = []
    for d, x in found:
        if x is None:
            out.append((d, 0, 0, 0, 0, 0, 0, "", "", ()))
        else:
            n_a, n_b, links, said, ends = x
            out.append((d, n_a, n_b, len(links), len(links), sum(count[p] == top[p[1]] for p in links), sum(count[p] for p in links), hashlib.sha256(said.encode()).hexdigest(), said, tuple(ends)))
    return Counter(out)


WORDS = ["the", "naïve", "12345", "don't", "<|endoftext|>", "<s>", "<0x41>", "▁", "日本語テキスト", "\U0001f600!", "é", "x\x00y", "\t", "\n", "\n\n ", " ", "  ", " ", " ", "\x1c", "...", "Ｆｕｌｌ", "ﬁ", "antidisestablishmentarianism", "?!", "İ", "'s", "a_b", "\r\n"]


def test_whole_texts(spark, plain):
    rng = random.Random(4)
    rows = [(i, rng.choice(["", " "]).join(rng.choice([*WORDS, *WORDS[:4] * 6]) + rng.choice(["", " "]) for _ in range(rng.randint(1, 40)))) for i in range(300)]
    rows += [rows[0], (None, "the end"), (None, None), (1, None), (2, ""), (3, " "), (4, "  "), (5, " the"), (6, "the "), (7, "x" * 20_000), (8, "ab" * 9000 + " the"), (9, "▁"), (10, "a ▁b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS links", "1 AS pair", "2 AS n")
    want = wanted(rows, plain)
    got = alignment.align(docs, alignment.a_path(), alignment.b_path(), with_groups=True).collect()
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256, r.groups, tuple(r.ends)) for r in got) == want
    assert sum(not x[1] for x in want) > 10 and sum(x[1] > 0 for x in want) > 150


def test_small_tables_of_chunks(spark, docs, texts, plain, monkeypatch):
    """With a table that is emptied at each turn, and transitions too."""
    want = wanted([(r[0], r[1]) for r in texts], plain)
    for cache, steps in ((0, 3), (alignment.CACHE, alignment.STEPS)):
        monkeypatch.setattr(alignment, "CACHE", cache)
        monkeypatch.setattr(alignment, "STEPS", steps)
        run = alignment._aligned(alignment.a_path(), alignment.b_path(), False)
        import pyarrow as pa

        batches = [pa.RecordBatch.from_arrays([pa.array([r[0]]), pa.array([r[1]])], ["d", "t"]) for r in texts]
        out = [r for b in run(iter(batches)) for r in b.to_pylist()]
        assert {(r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["groups_sha256"]) for r in out if r["pair"] is None} == {(*x[:4], x[7]) for x in want}
        count = Counter(p for r in out if r["pair"] is None for p in r["links"])
        assert {r["pair"]: r["n"] for r in out if r["pair"] is not None} == dict(count)
    alignment._KEPT.clear()
    got = alignment.align(docs, alignment.a_path(), alignment.b_path()).collect()
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got) == Counter({x[:8]: c for x, c in want.items()})


def test_transducer():
    t = alignment.Transducer([b"ab", b"c", b"abc", b""], [b"a", b"bc", b"abcabc", b"x"])
    assert t.ends([0, 1], [0, 1]) == [(2, 2)] and t.ends([2, 2], [2]) == [(2, 1)] and t.ends([2, 0, 1], [0, 1, 0, 1]) == [(1, 2), (3, 4)]
    assert t.ends([0], [0]) is None and t.ends([0], [3]) is None and t.ends([], [0]) is None and t.ends([], []) == []
    cases = [([0, 1], [0, 1]), ([2, 2], [2]), ([0], [0]), ([2, 0, 1], [0, 1, 0, 1]), ([0], [3]), ([], [0]), ([], []), ([2] * 40, [2] * 20), ([2] * 200, [0, 1] * 200), ([2] * 99, [2] * 50)]
    for long in (4, 1000):  # by themselves, or all together
        t.LONG = long
        a, b = (np.array([x for c in cases for x in c[k]], np.int64) for k in (0, 1))
        n_a, n_b = (np.array([len(c[k]) for c in cases]) for k in (0, 1))
        pair, one, two, good = t.ends_of(a, n_a, b, n_b)
        want = [t.ends(*c) for c in cases]
        assert good.tolist() == [w is not None for w in want]
        off_a, off_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        assert list(zip(pair.tolist(), one.tolist(), two.tolist(), strict=True)) == [(k, i + off_a[k], j + off_b[k]) for k, w in enumerate(want) for i, j in w or ()]


def test_odd_rows(odd, none):
    got = alignment.align(odd, alignment.a_path(), alignment.b_path()).collect()
    assert len(got) == odd.count() and all((r.n_a > 0) == (r.groups_sha256 != "") for r in got)
    assert alignment.align(none, alignment.a_path(), alignment.b_path()).count() == 0
