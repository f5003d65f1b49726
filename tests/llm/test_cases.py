"""Names that clash, long texts, parts of the operators against plain Python."""

import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillon.llm import common, line_dedup, media, mixing, ngram_join, pieces, pii, quality_rules, queries, suffix_dedup, token_store, toxicity

SF = "/root/testdata/sf0.001"
#: Columns that the operators might have names for themselves.
CLASH = ["_row", "_text", "_d", "_t", "_s", "_r", "_k", "_l", "_f", "_b", "_spans", "hits", "_uid", "_terms", "d", "t", "s", "e", "a", "c", "k", "y", "key", "doc", "id", "line", "rank", "a`b", "x.y"]
NONE = (np.empty(0, np.int32), np.empty(0), 0.0)
PASSING = {
    "mixing": mixing.mix,
    "suffix_dedup": lambda df: suffix_dedup.remove_repeats(df, length=40),
    "pieces": lambda df: pieces.encode(df, pieces.model_path()),
    "pii": pii.sanitise,
    "toxicity": lambda df: toxicity.score(df, NONE),
    "media": lambda df: media.fingerprints(df.withColumn("audio", F.lit(b"12" * 9000))),
    "line_dedup": lambda df: line_dedup.dedup_lines(df, min_words=3),
    "quality_rules": quality_rules.apply_rules,
}


@pytest.fixture(scope="module")
def clash(odd):
    return odd.select("*", *[F.concat(F.lit(f"{c} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in CLASH])


@pytest.mark.parametrize("name", sorted(PASSING))
def test_clashing_names_pass(clash, name):
    got = PASSING[name](clash).collect()
    ids = Counter(r["doc_id"] for r in clash.collect())
    assert {r["doc_id"] for r in got} == set(ids) and (name == "mixing" or Counter(r["doc_id"] for r in got) == ids)
    assert all(r[c] == f"{c} {'-' if r['doc_id'] is None else r['doc_id']}" for r in got for c in CLASH)


def test_clashing_names_are_ignored(clash, odd):
    for f in (lambda df: ngram_join.similar_groups(df, n=3, pct=90), lambda df: token_store.round_trip(df, token_store.model_path())):
        assert Counter(f(clash).collect()) == Counter(f(odd).collect())
    labels = odd.select("doc_id", F.lit(1).alias("toxic"), F.lit("x").alias("y"), F.lit("x").alias("d"))
    assert toxicity.sample(clash, labels).count() == toxicity.sample(odd, labels).count()


# long texts


@pytest.fixture(scope="module")
def long_rows():
    """Two copies of a text of 5 MB but for a passage that lies across a portion's end, and a short text with it."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(5000)]
    lines = [" ".join(rng.choice(vocabulary) for _ in range(12)) for _ in range(68_000)]
    text = "\n".join(lines)
    passage = text[suffix_dedup.PORTION - 300 : suffix_dedup.PORTION + 300]
    return [(1, text + " mail me@site.example.org", "s"), (2, f"start {passage} end", "s"), (3, "another text", "t")]


@pytest.fixture(scope="module")
def long_docs(spark, long_rows):
    return spark.createDataFrame(long_rows, "doc_id long, text string, source string")


def test_long_texts_lose_passages(long_docs, long_rows):
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(long_docs, length=400, drop_text=True).collect()}
    assert [got[i].n_removed for i in (1, 2, 3)] == [600, 600, 0] and got[1].n_spans == 1
    t = long_rows[0][1]
    left = t[: suffix_dedup.PORTION - 300] + t[suffix_dedup.PORTION + 300 :]
    assert got[1].kept_sha256 == hashlib.sha256(left.encode()).hexdigest() and bytes(got[1].kept) == left.encode()


def test_long_texts_elsewhere(spark, long_docs, long_rows):
    from tokenizers import Tokenizer

    t = long_rows[0][1]
    words = t.split()
    found = pii.find(long_docs, drop_text=True).where("doc_id = 1").first()
    assert [(x.s, x.e) for x in found.base] == [(t.index("me@"), len(t))]
    plain = Tokenizer.from_file(token_store.model_path()).encode(t, add_special_tokens=False).ids
    stored = token_store.round_trip(long_docs, token_store.model_path(), with_ids=True).where("doc_id = 1").first()
    assert stored.ids == [*plain, 1]
    pair = long_docs.union(long_docs.where("doc_id = 1").select(F.lit(9), F.concat("text", F.lit(" more")), "source"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_groups(pair).collect()}
    assert got[1] == (len({tuple(words[i : i + 5]) for i in range(len(words) - 4)}), 1) and got[9][1] == 1 and got[2][1] == 2
    rules = quality_rules.measures(long_docs).where("doc_id = 1").first()
    assert (rules.n_words, rules.word_chars) == (len(words), sum(map(len, words)))
    same = pair.select("doc_id", F.when(F.col("doc_id") == 9, F.concat(F.lit("own line\n"), "text")).otherwise(F.col("text")).alias("text"))
    gone = {r.doc_id: r.n_deleted for r in line_dedup.dedup_lines(same).collect()}
    assert gone[1] == 0 and gone[9] == t.count("\n")  # all but the last line, which has a word more
    pieced = pieces.encode(long_docs, pieces.model_path(), with_ids=False, drop_text=True).where("doc_id = 1").first()
    assert pieced.round_trip
    assert mixing.mix(long_docs).where("doc_id = 1").count() == 1


def test_slots_across_portions():
    rng = random.Random(4)
    t = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz é") for _ in range(toxicity.PORTION + 5000))
    raw = f" {t} ".encode()
    want = Counter()
    for n in toxicity.SIZES:
        v = np.zeros(len(raw) - n + 1, np.uint64)
        for i in range(n):
            v |= np.frombuffer(raw, np.uint8)[i : len(raw) - n + 1 + i].astype(np.uint64) << np.uint64(8 * i)
        want.update(((v + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - toxicity.SLOTS)).tolist())
    got = Counter()
    for x in toxicity.slots(t):
        got.update(x.tolist())
    assert got == want


# plain Python beside the operators


def test_fit_is_a_plain_classifier():
    """Log-count ratios, evidence and gradient steps written out, feature by feature."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(60)]
    texts, y = [], []
    for i in range(60):
        own = [rng.choice(words) for _ in range(12)] + (["zork"] if i % 3 == 0 else []) + (["calm"] if i % 3 == 1 else [])
        texts.append(" ".join(own))
        y.append(int(i % 3 == 0))
    held = [{int(v) for x in toxicity.slots(t) for v in x} for t in texts]
    count = {k: Counter(v for h, c in zip(held, y, strict=True) if c == k for v in h) for k in (0, 1)}
    docs = {k: y.count(k) + 2.0 for k in (0, 1)}
    r, z = {}, {}
    for v in set(count[0]) | set(count[1]):
        a, b = ((count[k][v] + 1) / docs[k] for k in (0, 1))
        both = (count[0][v] + count[1][v] + 2) / (docs[0] + docs[1])
        r[v] = math.log(b / a)
        z[v] = abs(b - a) / math.sqrt(both * max(1 - both, 1e-6) * (1 / docs[0] + 1 / docs[1])) if count[0][v] + count[1][v] + 2 >= 5 else 0
    pick = sorted(v for v in z if z[v] >= toxicity.LEAST_Z)
    assert pick
    load = [len(y) / (2 * y.count(k)) for k in y]
    w, vel, b, vb = dict.fromkeys(pick, 0.0), dict.fromkeys(pick, 0.0), 0.0, 0.0
    curve = {v: sum(r[v] ** 2 * q for h, q in zip(held, load, strict=True) if v in h) / 4 + 10.0 for v in pick}
    for _ in range(300):
        err = [(1 / (1 + math.exp(-(sum(r[v] * w[v] for v in pick if v in h) + b))) - k) * q for h, k, q in zip(held, y, load, strict=True)]
        g = {v: sum(r[v] * e for h, e in zip(held, err, strict=True) if v in h) + 10.0 * w[v] for v in pick}
        for v in pick:
            vel[v] = 0.9 * vel[v] - 0.02 * g[v] / curve[v]
            w[v] += vel[v]
        vb = 0.9 * vb - 0.02 * 4 * sum(err) / len(err)
        b += vb
    slots, weights, intercept = toxicity.fit(texts, np.array(y))
    assert slots.tolist() == pick and np.allclose(weights, [w[v] * r[v] for v in pick]) and abs(intercept - b) < 1e-9
    place = np.full(1 << toxicity.SLOTS, -1, np.int32)
    place[slots] = np.arange(len(slots))
    got = toxicity.margins(texts, slots, weights, intercept, place)
    assert np.allclose(got, [b + sum(w[v] * r[v] for v in pick if v in h) for h in held])


def test_disclosure_by_counting(spark):
    """Every term and entity counted over all texts."""
    rng = random.Random(9)
    entities = ["bob@mail.example.com", "10.1.2.3", "+1 202 555 0143", "ann@site.example.org"]
    near = {e: [f"near{i}a", f"near{i}b"] for i, e in enumerate(entities)}
    rows = []
    for i in range(300):
        own = [f"w{rng.randrange(60)}" for _ in range(rng.randint(5, 30))]
        if i % 3 == 0:
            e = rng.choice(entities)
            at = rng.randrange(len(own))
            own[at:at] = [rng.choice(near[e]), *[f"w{rng.randrange(60)}"] * rng.randint(0, 2), e, rng.choice(near[e]) + ","]
        if i % 17 == 0:
            own.insert(0, rng.choice(rng.choice(list(near.values()))).upper())
        rows.append((i, " ".join(own)))
    rows += rows[:20]  # repeated texts count once as support
    n, holds, terms, both, texts = len(rows), Counter(), Counter(), Counter(), defaultdict(set)
    for _, t in rows:
        spans = pii.base_spans(t)
        holds.update({pii.entity(k, t[s:e]) for s, k, e in spans})
        terms.update({pii.term(w) for w in t.split()})
        for pair in pii.near(t, spans):
            both[pair] += 1
            texts[pair].add(t)
    told = {}
    for (e, t), c in both.items():
        d = math.log(c * n / (terms[t] * holds[e])) / math.log(n / holds[e])
        if len(texts[e, t]) >= pii.SUPPORT and d >= pii.GENERALISE:
            told[t] = max(d, told.get(t, 0))
    assert len(told) >= 4
    got = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in got:
        want = [(m.start(), m.start() + len(pii.term(m[0]))) for m in re.finditer(r"[^ ]+", r.text) if pii.term(m[0]) in told and not any(s < m.end() and m.start() < e for s, _, e in pii.base_spans(r.text))]
        assert [(x.s, x.e) for x in r.all_spans if x.k == 4] == want
        assert all(abs(x.d - told[pii.term(r.text[x.s : x.e])]) < 1e-9 for x in r.all_spans if x.k == 4)


def bits(x, y, o):
    a, b = x[max(o, 0) :], y[max(-o, 0) :]
    n = min(len(a), len(b))
    return n, int(np.unpackbits((a[:n] ^ b[:n]).view(np.uint8)).sum())


def test_matches_by_all_offsets(spark):
    """Classes, offsets and bits against every offset of every pair, with integers that a third of the recordings hold."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(40):
        base = rng.integers(-(1 << 31), 1 << 31, 120).astype(np.int32)
        if i % 3 == 0:
            base[20:60] = 12345  # a tone that many hold
        rows.append((4 * i, base))
        lost = int(rng.integers(0, 50))
        near = base[lost:].copy()
        for k in rng.choice(len(near), len(near) // 3, replace=False):
            near[k] ^= np.int32(1 << int(rng.integers(0, 31)))
        rows += [(4 * i + 1, near), (4 * i + 2, base), (4 * i + 3, near[:0])]
    prints = spark.createDataFrame([(i, x.tolist()) for i, x in rows], "id long, fingerprint array<int>")
    found = media.classes(prints)
    least = {}
    for i, x in rows:
        least.setdefault(x.tobytes(), i) if len(x) else None
    assert {r.id: r.class_id for r in found.collect()} == {i: least.get(x.tobytes(), i) for i, x in rows}
    sets = {i: x for i, x in rows if least.get(x.tobytes()) == i}
    got = {(r.query_class, r.class_id): (r.offset, r.n_bits, r.n_errors) for r in media.align(found, F.col("id") % 8 == 0).collect()}
    asked = {least[x.tobytes()] for i, x in rows if i % 8 == 0}
    want = {}
    for q in asked:
        for c, y in sets.items():
            if c != q:
                tried = [(e / (32 * n), o, 32 * n, e) for o in range(-len(y) + 1, len(sets[q])) for n, e in [bits(sets[q], y, o)] if n >= media.OVERLAP and e <= media.ERRORS * 32 * n]
                if tried:
                    want[q, c] = min(tried)[1:]
    assert want and got == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_recall_on_the_query_s_table(spark):
    rows = queries.op8_media(spark, SF).collect()
    classes = {r.id: r.class_id for r in rows if r.kind == "member"}
    prints = {r.id: np.array(r.fingerprint, np.int32) for r in media.fingerprints(media.rendered(spark.read.parquet(f"{SF}/embeddings.parquet"))).collect() if r.fingerprint}
    got = {(r.id, r.class_id) for r in rows if r.kind == "match"}
    reps = [i for i in prints if classes[i] == i]
    want = set()
    for q in {classes[i] for i in prints if i % 100 == 0}:
        for c in reps:
            if c != q and any(n >= media.OVERLAP and e <= media.ERRORS * 32 * n for o in range(-len(prints[c]) + 1, len(prints[q])) for n, e in [bits(prints[q], prints[c], o)]):
                want.add((q, c))
    assert len(want) >= 8 and any(c == q + 1 for q, c in want)
    assert got <= want and len(got) >= 0.9 * len(want)


def test_recordings_without_or_with_one_id(spark):
    rows = [(1, [1, 2, 3]), (None, [1, 2, 3]), (4, [7, 8]), (4, [1, 2, 3]), (4, None), (5, []), (6, None), (6, None), (9, [7, 8])]
    got = sorted(map(tuple, media.classes(spark.createDataFrame(rows, "id long, fingerprint array<int>")).select("id", "class_id", F.size("fingerprint")).collect()))
    assert got == [(1, 1, 3), (4, 1, 3), (5, 5, 0), (6, 6, None), (9, 9, 2)]


def test_first_pass_in_any_portions():
    """Buckets and runs larger than what a task holds give what whole buckets give."""
    rng = np.random.default_rng(6)
    a = np.sort(np.concatenate((rng.integers(0, 40, 300), np.full(400, 17), np.full(90, 23))))
    f = np.concatenate([np.sort(rng.integers(0, [3, 60, 10**6][int(v) % 3], int((a == v).sum()))) if v != 23 else np.full(int((a == v).sum()), 5) for v in np.unique(a)])
    cols = [a, f, np.arange(len(a)), np.arange(len(a)), *[np.arange(len(a), dtype=np.int32)] * 3]

    def rows(size, **how):
        batches = [pa.RecordBatch.from_arrays([pa.array(c[i : i + size]) for c in cols], list(suffix_dedup._RUN)) for i in range(0, len(a), size)]
        out = [r for b in suffix_dedup._first_pass(**how)(iter(batches)) for r in b.to_pylist()]
        twice = {r["d"] for r in out if r["kind"] == 0}
        return twice, Counter((r["a"], r["f"], r["kind"]) for r in out if r["kind"])

    whole = rows(len(a))
    assert whole[0] == {i for i, p in enumerate(zip(a.tolist(), f.tolist(), strict=True)) if Counter(zip(a.tolist(), f.tolist(), strict=True))[p] > 1}
    for size, most in ((7, 20), (50, 5), (1, 3)):
        assert rows(size, most=most) == whole


def test_hot_buckets_are_dealt(spark):
    from tests.llm.test_free import removed

    rng = random.Random(13)
    licence = "this text is under the licence of all texts and may be copied by all"
    rows = [(i, "".join(rng.choice("abcdefghij ") for _ in range(40)) + licence * (i % 4 > 0) + "".join(rng.choice("abcdefghij ") for _ in range(rng.randint(0, 60)))) for i in range(150)]
    rows += [(None, rows[1][1]), (None, rows[2][1]), (None, "x" * 99), (900, "0" * 300), (901, "0" * 170 + "end")]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=60, keep_bytes=False, drop_text=True, hot=20)
    assert sorted(map(tuple, got.collect()), key=str) == removed(rows, 60)


def test_more_documents_than_the_bit_map_takes(spark, monkeypatch):
    """The joins that stand in for the map of ids give the same spans."""
    from tests.llm.test_free import removed

    rng = random.Random(21)
    shared = ["".join(rng.choice("abcdefgh ") for _ in range(90)) for _ in range(3)]
    rows = [(i, "".join(rng.choice("abcdefghij ") for _ in range(50)) + rng.choice([*shared, ""]) + "".join(rng.choice("abcdefghij ") for _ in range(20))) for i in range(60)]
    rows += [(3, rows[3][1]), (None, rows[4][1]), (None, None), (70, "")]
    monkeypatch.setattr(suffix_dedup, "MAP_IDS", 0)
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=60, keep_bytes=False, drop_text=True, hot=15)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(removed(rows, 60), key=str)


def test_helpers(spark):
    left = spark.createDataFrame([(i % 7 if i % 2 else 99, i) for i in range(5000)], "k int, v int")
    right = left.groupBy("k").agg(F.count("*").alias("c")).where("k <> 3")
    want = Counter(map(tuple, left.join(right, "k").collect()))
    assert Counter(map(tuple, common.split_join(left, right, ["k"], "c", 5000).collect())) == want == Counter(map(tuple, common.split_join(left, right, ["k"], "c", 10**7).collect()))
    ids = [-5, 0, 7, 1 << 62, *random.Random(1).sample(range(10**12), 500)]
    found = common.bit_map(spark.createDataFrame([(i,) for i in ids], "x long"), "x")
    assert all(common.in_map(found, i) for i in ids) and sum(common.in_map(found, i) for i in range(10**6, 10**6 + 2000)) < 20
    assert len(found) == common.MAP_BITS // 8


def test_scratch_tables_are_listed(spark, docs):
    with common.listing() as made:
        table = common.cut(docs, "mine")
        other = common.cut(docs, "other")
    assert len(made) == 2 and set(made) <= set(common._LISTS[0])
    common.drop_scratch(table)
    assert made[0] not in common._LISTS[0] and other.count() == docs.count()
    common.delete(spark, made[1:])
    assert not set(made) & set(common._LISTS[0])
