"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quillon.llm import spelling


def apart(a, b):
    """Whether one insertion, deletion or replacement makes a of b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def counted(rows, slips, least, often):
    total = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if slips and h % slips == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= least and n >= often}


def grouped(n):
    """(word, form, root, n, n_near, form_n) by looking at every pair."""
    near = {w: [v for v in n if apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def some_words(rng, many, letters="abé", low=5, high=9):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(many)]


def test_subtrees_give_each_pair_once():
    rng = random.Random(3)
    words = sorted({*some_words(rng, 400, high=8), *(w + "abab" * 40 for w in some_words(rng, 60)), *("ba" * 70 + w for w in some_words(rng, 60)), "abcde", "abcdef", "abcdeff"})
    rows = [(k1, k2, bool(far), i, mid) for i, w in enumerate(words) for far in ((0, 1) if len(w) > 5 else (0,)) for k1, k2, mid in spelling._parts(w, len(w) - far, far)]
    rows.sort(key=lambda r: (r[0], r[1], r[4]))
    keys = np.array([r[:2] for r in rows])
    group = np.concatenate(([0], np.cumsum((keys[1:] != keys[:-1]).any(1))))
    a, b = spelling.Trie(group, [r[4] for r in rows], np.array([r[2] for r in rows]), np.array([r[3] for r in rows])).pairs()
    got = Counter(frozenset((words[i], words[j])) for i, j in zip(a.tolist(), b.tolist(), strict=True))
    want = {frozenset((v, w)) for v in words for w in words if v < w and apart(v, w)}
    assert len(want) > 400 and set(got) == want and set(got.values()) == {1}


@pytest.mark.parametrize("most", [spelling.MOST, 6])
def test_variants_by_all_pairs(spark, most):
    """With small subtrees, blocks are halved down to single places."""
    rng = random.Random(5)
    n = {w: rng.choice([3, 4, 6, 9, 20, 50]) for w in some_words(rng, 250)}
    n |= {"x" * 300 + w: 5 * k + 3 for k, w in enumerate(some_words(rng, 12))} | {"y" * 500: 9, "y" * 501: 90, "y" * 502: 900}
    got = spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long"), least=5, most=most).collect()
    assert len(got) == len(n) and {tuple(r) for r in got} == grouped(n)


def test_words_of_texts(spark):
    rng = random.Random(8)
    pool = [w.capitalize() if i % 3 == 0 else w for i, w in enumerate(some_words(rng, 60, "abcdÀ×÷ÿ", 3, 7))]
    rows = [(i, " ".join(rng.choice(pool) + rng.choice(["", ",", "1", "Ā", "É"]) for _ in range(40))) for i in range(60)]
    rows += [rows[0], (None, rows[1][1]), (7, None), (8, ""), (9, " \n"), (None, None), (10, "q" * 70_000), (11, "q" * 70_000), (12, "q" * 69_999 + " " + "q" * 70_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for slips in (0, 7, 97):
        n = counted(rows, slips, 5, 3)
        assert "q" * 70_000 in n or slips
        got = spelling.group_variants(docs.selectExpr("*", "1 AS word", "2 AS n", "3 AS id"), slips=slips).collect()
        assert len(got) == len(n) > 50 and {tuple(r) for r in got} == grouped(n)


def test_odd_rows(odd, none):
    got = spelling.group_variants(odd, often=1).collect()
    assert {r.word for r in got} >= {"another", "x" * 3000} and all(r.n_near == 0 and r.root == r.word for r in got)
    assert spelling.group_variants(none).count() == 0
    assert spelling.group_variants(odd, often=10**6).count() == 0
