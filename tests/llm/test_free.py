"""The other operators against brute force, round trips and held-out labels, and the defined cases."""

import hashlib
import random
import re
import struct
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillon.llm import media, ngram_join, pieces, pii, queries, suffix_dedup, token_store, toxicity


# suffix dedup


def removed(rows, length):
    seen = Counter(b[i : i + length] for _, t in rows for b in [(t or "").encode()] for i in range(len(b) - length + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        mark = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        left = bytes(x for x, y in zip(b, mark, strict=True) if not y)
        out.append((d, len(b), len(b) - len(left), len(re.findall(b"\1+", bytes(mark))), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("wide", [20_000, 2])
def test_suffix_dedup(spark, wide):
    rng = random.Random(3)
    parts = ["".join(rng.choice("abcd ") for _ in range(rng.randint(1, 90))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) + ("a" * 150 if i % 7 == 0 else "")) for i in range(80)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=60, keep_bytes=False, drop_text=True, wide=wide)
    assert sorted(map(tuple, got.collect()), key=str) == removed(rows, 60)


def test_suffix_dedup_on_odd_rows(odd, none):
    got = suffix_dedup.remove_repeats(odd.withColumn("kept", F.lit("clash")), length=40, keep_bytes=False, drop_text=True)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()), key=str) == removed([(r.doc_id, r.text) for r in odd.collect()], 40)
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_long_texts_in_portions(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PORTION", 1 << 10)
    rng = np.random.default_rng(0)
    b = rng.integers(97, 101, 5000, dtype=np.uint8)
    first, whole = suffix_dedup.Prints(1, 6000), suffix_dedup.Prints(2, 6000)
    one = suffix_dedup.runs(b, 60, first, whole)
    assert one[3].sum() == 5000 - 60 + 1


# n-gram join


def groups(rows, n, pct):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = list(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= pct * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


@pytest.mark.parametrize(("n", "pct", "small", "often", "room"), [(3, 90, 32, 20, 1 << 22), (2, 80, 4, 3, 1 << 22), (1, 70, 32, 3, 0)])
def test_ngram_join(spark, monkeypatch, n, pct, small, often, room):
    """room 0: too many documents for the bit map. Some rows have an id that has another row with a larger set."""
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "MAP_IDS", room)
    monkeypatch.setattr(ngram_join, "OFTEN", often)
    rng = random.Random(n)
    words, rows = [f"w{i}" for i in range(3000)], []
    for g in range(8):
        base = [rng.choice(words) for _ in range(rng.randint(8, 120))]
        for _ in range(rng.choice([3, 30, 50])):
            own = list(base)
            for _ in range(rng.randint(0, 1 + len(own) // 7)):
                k = rng.randrange(len(own))
                own[k : k + rng.randint(0, 1)] = [rng.choice(words)] * rng.randint(0, 1) or own[k : k + 1]
            base = own if rng.random() < 0.3 else base
            rows.append((rng.randrange(10**9), " ".join(own)))
    rows += [(d, t.replace(" ", "\t").upper()) for d, t in rows[::9]]  # the same set again, under the same id or another
    rows += [(d + 1, t) for d, t in rows[::11]]
    want = groups(rows, n, pct)
    less = [(d, " ".join(t.split()[:-2])) for d, t in rows[::7]]
    got = ngram_join.similar_groups(spark.createDataFrame(rows + less, "doc_id long, text string").repartition(5), n=n, pct=pct).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted([(d, want[d][0], want[d][1]) for d, _ in rows] + [(d, groups([(d, t)], n, pct)[d][0], want[d][1]) for d, t in less])


def test_ngram_join_on_odd_rows(odd, none):
    got = ngram_join.similar_groups(odd.withColumn("component_id", F.lit("clash")), n=3, pct=90).collect()
    assert len(got) == odd.count() and {r.n_shingles for r in got if r.doc_id in (2, 3, 4)} == {0}
    assert all(r.component_id == r.doc_id for r in got)
    assert ngram_join.similar_groups(none).count() == 0


# pieces


def test_pieces_against_all_segmentations():
    lattice, rng = pieces.Lattice(pieces.model_path(), 5), random.Random(1)

    def best(text):
        s = pieces.SPACE + text.replace(" ", pieces.SPACE)
        out = [[0.0]] + [[] for _ in s]
        for j in range(1, len(s) + 1):
            for i in range(max(0, j - 16), j):
                score = lattice.pieces.get(s[i:j], (lattice.floor if j - i == 1 else None,))[0]
                out[j] += [a + score for a in out[i]] if score is not None else []
            out[j] = sorted(out[j], reverse=True)[:5]
        return out[-1]

    for _ in range(150):
        t = "".join(rng.choice("aeth on.\né一\U0001f600 ") for _ in range(rng.randint(1, 25)))
        c = lattice.chunks(t)
        lattice.learn([c])
        ids, score, scores = lattice.encode(c)
        want = best(t)
        assert len(scores) == len(want) and all(abs(a - b) < 1e-6 for a, b in zip(scores, want, strict=True))
        assert lattice.decode(ids) == t
        for chunk in c:
            found = lattice.search(chunk)
            assert abs(found[0][0] - lattice.best[lattice.at[chunk]]) < 1e-6 and [s for s, _ in found] == sorted((s for s, _ in found), reverse=True)


def test_pieces_on_odd_rows(odd, none):
    got = pieces.encode(odd.withColumn("score", F.lit("clash")), pieces.model_path()).collect()
    assert len(got) == odd.count() and all(r.round_trip for r in got)
    assert next(r for r in got if r.doc_id == 2).ids == [] and pieces.encode(none, pieces.model_path()).count() == 0


def test_each_of_the_best_segmentations_is_whole():
    lattice, rng = pieces.Lattice(pieces.model_path(), 5), random.Random(2)
    score = {i: s for s, i in lattice.pieces.values()} | {i: 0.0 if 0x80 <= b < 0xC0 else lattice.floor for b, i in lattice.byte_id.items()}
    for _ in range(150):
        t = "".join(rng.choice("aeth on.\n一 ") for _ in range(rng.randint(1, 60)))
        c = lattice.chunks(t)
        lattice.learn([c])
        found = [(s, np.frombuffer(i, "<i4")) for s, i in lattice.segmentations(c)]
        assert [s for s, _ in found] == lattice.encode(c)[2] and len({i.tobytes() for _, i in found}) == len(found)
        assert found[0][1].tobytes() == lattice.encode(c)[0].tobytes()
        for s, ids in found:
            assert lattice.decode(ids) == t
            assert s == sum(score[i] for i in ids.tolist())


def test_search_follows_one_of_many_equal_paths(monkeypatch):
    lattice, pops = pieces.Lattice(pieces.model_path(), 4), []
    pop = pieces.heapq.heappop
    monkeypatch.setattr(pieces.heapq, "heappop", lambda heap: pops.append(1) or pop(heap))
    chunk = pieces.SPACE + "x" * 300
    assert len(lattice.search(chunk)) == 4 and len(pops) <= 4 * (len(chunk) + 1)


def test_a_batch_of_texts_is_segmented_as_each_alone():
    lattice, rng = pieces.Lattice(pieces.model_path(), 4), random.Random(3)
    texts = ["", " ", "\n", "\u2581", "a", " a  b \n\n c\n ", "a \u2581b", "一\U0001f600\x00"] + ["".join(rng.choice("aeth on.\né一\U0001f600\u2581\u00a0 ") for _ in range(rng.randint(1, 80))) for _ in range(300)]
    chunks, begin = lattice.cut_up(texts)
    split = [[c.replace(" ", pieces.SPACE) for c in chunks.to_pylist()[lo:hi]] for lo, hi in zip(begin, begin[1:], strict=False)]
    assert split == [lattice.chunks(t) for t in texts]
    found = list(lattice.read(texts))
    alone = pieces.Lattice(pieces.model_path(), 4)
    alone.learn(split)
    assert found == [alone.segmentations(c) for c in split] and list(lattice.read([])) == [] and list(lattice.read([""])) == [[(0.0, b"")]]
    ids = [[i for _, i in own] for own in found]
    assert all(lattice.same(texts, ids)) and lattice.same([], []) == [] and lattice.same(["", "a"], [[b""], [b""]]) == [True, False]
    for k, own in enumerate(ids):  # one wrong segmentation of one text shows there only
        if own[-1]:
            wrong = ids[:k] + [[*own[:-1], own[-1][4:]]] + ids[k + 1 :]
            assert [i for i, x in enumerate(lattice.same(texts, wrong)) if not x] == [k]


def test_known_chunks_cost_little():
    rng = random.Random(4)
    words = ["".join(rng.choice("aethonsi") for _ in range(6)) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=2000)) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(texts)], names=["_row", "_text"])
    encoded = pieces._encode(pieces.model_path(), 4, [str(k) for k in range(7)], lambda parts: pa.array(parts, pa.binary()))

    def cost(f, *args):
        start = time.process_time()
        return list(f(*args)) and time.process_time() - start

    once = min(cost(encoded, iter([batch])) for _ in range(3))
    more = min(cost(encoded, iter([batch] * 4)) for _ in range(3))
    cut = min(cost(map, pieces.Lattice.chunks, texts) for _ in range(3))
    assert (more - once) / 3 < 3 * cut


def test_pieces_query_has_all_segmentations(spark, docs, odd, tmp_path):
    docs.union(odd).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op3_pieces(spark, str(tmp_path)).collect()
    whole = pieces.encode(docs.union(odd), pieces.model_path(), nbest=4).collect()
    packed = lambda ids: zlib.crc32(struct.pack(f"<{len(ids)}i", *ids))
    want = [(r.doc_id, len(r.ids), packed(r.ids), len(r.nbest), ",".join(str(packed(i)) for i in r.nbest)) for r in whole]
    assert sorted(((r.doc_id, r.n_pieces, r.ids_crc32, r.n_best, r.nbest_crc32) for r in got), key=str) == sorted(want, key=str)
    assert all(r.round_trip and r.nbest_scores.count(",") == r.n_best - 1 for r in got)
    assert all(r.ids == r.nbest[0] and len({tuple(i) for i in r.nbest}) == len(r.scores) for r in whole) and max(r.n_best for r in got) == 4
    short = pieces.encode(docs.union(odd), pieces.model_path(), with_ids=False).collect()
    assert sorted(((r.doc_id, r.n_pieces, r.ids_crc32, r.nbest_crc32) for r in short), key=str) == sorted(((d, n, c, [int(x) for x in m.split(",")]) for d, n, c, _, m in want), key=str)


# personal data

BASE = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def naive(t):
    out = []
    for k, p in enumerate(BASE):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1])) % 10 == 0
            if (k == 0, all(int(x) <= 255 for x in m[0].split(".")) if k == 1 else False, k == 2 and 12 <= len(d) <= 19 and luhn, k == 3 and 9 <= len(d) <= 15)[k]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        t = "".join(rng.choice("a@.b-1023 +()9_%é@.") for _ in range(rng.randint(1, 45)))
        assert naive(t) == pii.base_spans(t)


def test_disclosing_terms(spark):
    rows = [(i, f"the zebrafinch {'x' * (i % 3)} wrote from bob@mail.example.com the {i}") for i in range(6)] + [(100 + i, f"the plain text number {i} of the rest") for i in range(200)]
    got = {r.doc_id: r for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "zebrafinch" not in got[1].sanitised and "[EMAIL]" in got[1].sanitised and got[1].sanitised.startswith("the ")
    assert got[150].sanitised == got[150].text
    assert [tuple(x)[:3] for x in got[1].base] == naive(got[1].text)


def test_terms_with_other_white_space(spark):
    """Words end at ASCII white space only: a term may hold any other, and its parts are no terms."""
    rows = [(i, f"the zebra\u00a0finch\u3000 and bird{' x' * (i % 3)} wrote from bob@mail.example.com the {i}") for i in range(6)]
    rows += [(50, "only zebra\u00a0finch\u3000 here"), (51, "only bird here")]
    rows += [(100 + i, f"the plain text number {i} and bird\u0085x of the rest") for i in range(200)]
    got = {r.doc_id: [(r.text[x.s : x.e], x.k) for x in r.all_spans] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[50] == [("zebra\u00a0finch\u3000", 4)] and got[51] == [("bird", 4)] and got[150] == []
    assert all(("bird", 4) in got[i] and ("zebra\u00a0finch\u3000", 4) in got[i] for i in range(6))


def test_words_near_spans():
    """Against slices of the text, with words of any length."""
    rng = random.Random(8)
    for _ in range(2000):
        t = "".join(rng.choice(["a@b.co", "1.2.3.4", "+1 234 567 890", "w" * rng.choice([1, 3, 70, 700]), "Ab.", "(", "\u00a0", " ", " ", "\n"]) for _ in range(rng.randint(0, 40)))
        spans, want = pii.base_spans(t), set()
        for s, k, e in spans:
            for w in [*re.findall(pii.WORD, t[:s])[-8:], *re.findall(pii.WORD, t[e:])[:8]]:
                if (x := pii.term(w)) and "@" not in w:
                    want.add((pii.entity(k, t[s:e]), x))
        assert pii.near(t, spans) == want
    far = pii.near(f"first {'x' * 600} a@b.co {'y' * 600} last", [(607, 0, 613)])
    assert {"first", "last", pii.term("x" * 600), pii.term("y" * 600)} == {x for _, x in far}
    assert len(pii.term("x" * 600)) < 40 and pii.term("x" * 600) != pii.term("x" * 601)


def test_pii_on_odd_rows(odd, none):
    got = pii.find(odd.withColumn("base", F.lit("clash"))).collect()
    assert len(got) == odd.count()
    assert [x.k for x in next(r for r in got if r.doc_id == 6).base] == [0, 3] and pii.find(none).count() == 0


# toxicity


def test_toxicity(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    rows = []
    for i in range(400):
        own = [rng.choice(words) for _ in range(rng.randint(20, 60))]
        if i % 4 == 0:
            own.insert(rng.randrange(len(own)), rng.choice(["zorkling", "zorkly", "zorkous"]))
        rows.append((i, " ".join(own), int(i % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(df.select("doc_id", "text"), df.where("doc_id % 3 <> 1").select("doc_id", "toxic"))
    got = toxicity.score(df, model).where("doc_id % 3 = 1").collect()
    assert sum((r.predicted == r.toxic) for r in got) / len(got) > 0.97


def test_toxicity_on_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (3, 0), (7, None), (None, 1), (99, 1), (3, 0)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    got = toxicity.score(odd.withColumn("score", F.lit("clash")), model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(none, toxicity.train(none, labels)).count() == 0


# token files


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 40_000, 100_000])
def test_images(n):
    ids = np.random.default_rng(n).zipf(1.3, n) % 5000
    table = token_store.Table(np.bincount(ids, minlength=5000) if n else np.zeros(3, int))
    image = token_store.write_image([None, 7], [n, 0], ids, table)
    docs, lengths, got = token_store.read_image(image, table)
    assert docs == [None, 7] and lengths.tolist() == [n, 0] and (got == ids).all()
    if n > 1000:
        broken = bytearray(image)
        broken[-9] ^= 1
        with pytest.raises(ValueError, match="checksum"):
            token_store.read_image(bytes(broken), table)


@pytest.mark.parametrize("most", [token_store.CACHE, 5])
def test_chunks_are_the_tokenizers(monkeypatch, texts, most):
    """Against a tokenizer read anew, for whole texts; with room for few chunks all come out alike, and again when they are known."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_store, "CACHE", most)
    path, rng = token_store.model_path(), random.Random(5)
    plain, chunks = Tokenizer.from_file(path), token_store.Chunks(path, "<u2")
    assert chunks.by_chunk and chunks.mark
    letters = ["́", "a", "E", "'s", "'", "‍", " ", "　", "\x1c", "É", "İ", "ß", "1", ".", "!", "中", "😀", "\n", ",", "Σ", "<|endoftext|>", "×", chunks.mark, "J̌", "각"]
    own = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(1500)] + [t for _, t, *_ in texts] + [None, "", "x" * 5000, "word., Word,. ..."]
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in own]
    for _ in range(2):
        ids, ends, often = chunks.encode(pa.array(own))
        assert ids.tolist() == [i for w in want for i in w] and ends.tolist() == np.cumsum([len(w) for w in want]).tolist()
        assert often.tolist() == np.bincount(ids, minlength=chunks.size).tolist()


def test_a_tokenizer_of_another_kind(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_store, "by_chunk", lambda path: False)
    path, own = token_store.model_path(), ["a <|endoftext|> b", None, "", "Two words."]
    ids, ends, often = token_store.Chunks(path, "<u2").encode(pa.array(own))
    want = [Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids for t in own]
    assert ids.tolist() == [i for w in want for i in w] and ends.tolist() == np.cumsum([len(w) for w in want]).tolist() and often.sum() == len(ids)


def test_special_strings_as_the_tokenizer_has_them():
    import pyarrow as pa
    from tokenizers import Tokenizer

    path, rng = token_store.model_path(), random.Random(6)
    plain, chunks = Tokenizer.from_file(path), token_store.Chunks(path, "<u2")
    letters = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "a", "é", "\u0301", ".", ",", " ", "\n", "\u3000", "1"]
    texts = ["a <|endoftext|> b", *["".join(rng.choice(letters) for _ in range(rng.randint(0, 9))) for _ in range(1500)]]
    ids, ends, _ = chunks.encode(pa.array(texts))
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [320, 49407, 321]
    assert ids.tolist() == [i for w in want for i in w] and ends.tolist() == np.cumsum([len(w) for w in want]).tolist()


def test_token_round_trip(odd, none):
    path = token_store.model_path()
    got = token_store.round_trip(odd, path, end=1, with_ids=True).collect()
    assert len(got) == odd.count()
    got.sort(key=lambda r: r.start)
    assert [r.doc_id is None for r in got] == sorted((r.doc_id is None for r in got), reverse=True) and [r.doc_id for r in got if r.doc_id] == sorted(r.doc_id for r in got if r.doc_id)
    upto = 0
    for r in got:
        assert r.start == upto and r.ids[-1] == 1 and zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids)) == r.ids_crc32
        upto += r.n_tokens
    assert token_store.round_trip(none, path).count() == 0


# media


def test_alignment(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(4):
        b = np.frombuffer(media.melody(rng.normal(0, 0.2, 120)), "<i2")
        noise = b[media.HOP * 20 :] + rng.normal(0, 600, len(b) - media.HOP * 20)
        up = np.interp(np.arange(len(b) * 2) / 2, np.arange(len(b)), b)
        rows += [(i * 50, b.tobytes(), 4000), (i * 50 + 1, noise.clip(-32000, 32000).astype("<i2").tobytes(), 4000), (i * 50 + 2, up.astype("<i2").tobytes(), 8000), (i * 50 + 3, b.tobytes(), None)]
    rows += [(9001, None, 4000), (9002, b"", 4000), (9003, bytes(9000), 4000), (None, b"", None)]
    df = spark.createDataFrame(rows, "id long, audio binary, rate int")
    prints = media.fingerprints(df.withColumn("fingerprint", F.lit("clash")), rate="rate").cache()
    found = media.classes(prints)
    same = {r.id: r.class_id for r in found.collect()}
    assert all(same[i * 50 + k] == i * 50 for i in range(4) for k in (0, 2, 3)) and len(same) == len(rows) - 1
    got = {(r.query_class, r.class_id): r for r in media.align(found, F.col("id") % 50 == 0).collect()}
    assert set(got) == {(i * 50, i * 50 + 1) for i in range(4)} and all(r.offset == 20 for r in got.values())
    assert media.fingerprints(df.limit(0), rate="rate").count() == 0


def test_recall_of_alignment(spark):
    """Against every offset of pairs of recordings, one of them shifted by any number of samples and with noise: those whose bits differ in a tenth or less."""
    rng = np.random.default_rng(1)
    ones = lambda x: int(np.unpackbits(x.view(np.uint8)).sum())
    rows, want = [], set()
    for i in range(60):
        b = np.frombuffer(media.melody(rng.normal(0, 0.2, 80)), "<i2").astype(float)
        c = b[int(rng.integers(0, 5000)) :]
        c = (c + rng.normal(0, rng.choice([0, 500, 1500, 3000, 6000]), len(c))).clip(-32000, 32000)
        rows += [(2 * i, b.astype("<i2").tobytes()), (2 * i + 1, c.astype("<i2").tobytes())]
    prints = {i: media.fingerprint(a, media.RATE) for i, a in rows}
    for q in range(0, len(rows), 2):
        for r in (q + 1, (q + 3) % len(rows)):
            x, y = prints[q], prints[r]
            rate = min(ones(x[max(o, 0) :][: len(y) - max(-o, 0)] ^ y[max(-o, 0) :][: len(x) - max(o, 0)]) / (32 * min(len(y) - max(-o, 0), len(x) - max(o, 0))) for o in range(-60, 61))
            want |= {(q, r)} if rate <= media.ERRORS else set()
    found = media.classes(media.fingerprints(spark.createDataFrame(rows, "id long, audio binary")))
    got = {(r.query_class, r.class_id) for r in media.align(found, F.col("id") % 2 == 0).collect()}
    assert len(want) > 40 and len(got & want) >= 0.9 * len(want)


def test_held_tones_align(spark):
    """One tone, held for different times: a single run of one integer."""
    rows = [(0, 0, [77] * 100), (1, 1, [77] * 130), (2, 2, [-9] * 100)]
    got = media.align(spark.createDataFrame(rows, "id long, class_id long, fingerprint array<int>"), F.col("id") == 0).collect()
    assert [(r.query_class, r.class_id, r.n_errors) for r in got] == [(0, 1, 0)]


def test_every_offset_with_votes_is_tried(spark):
    """Two frames agree at the right offset, three at each of four others."""
    rng = np.random.default_rng(3)
    x = rng.integers(-(1 << 31), 1 << 31, 300)
    y = x ^ (1 << rng.integers(0, 31, 300))
    y[[7, 200]] = x[[7, 200]]
    for k, o in enumerate((-40, -20, 20, 40)):
        at = 60 + 10 * k + np.arange(3)
        y[at] = x[at + o]
    rows = [(0, 0, x.tolist()), (1, 1, y.tolist())]
    got = media.align(spark.createDataFrame(rows, "id long, class_id long, fingerprint array<int>"), F.col("id") == 0).collect()
    assert [(r.query_class, r.class_id, r.offset) for r in got] == [(0, 1, 0)]
