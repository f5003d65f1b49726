"""Archives against the pages they were made of, and damaged ones."""

import base64
import gzip
import hashlib
import io
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quillon.llm import common, warc


def wanted(rows):
    same = defaultdict(list)
    for p, _, h in rows:
        same[h or ""].append(p)
    out = []
    for p, _, h in rows:
        raw = (h or "").encode()
        ids = [x for x in same[h or ""] if x is not None]
        top = max(ids, default=None)
        other = len(same[h or ""]) > 1 and ids and p != top
        out.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if other else "response", top if other else None, None))
    return Counter(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = [(i, f"http://a.example/{i}?é <x>", "".join(rng.choice("abc\r\n0é") for _ in range(rng.choice([0, 1, 63, 64, 65, 500, 3000])))) for i in range(80)]
    out += [(100 + i, None, out[i % 7][2]) for i in range(40)] + [(200 + i, "x", "the same page") for i in range(60)]
    out += [(1, "again", "own"), (1, "again", "own"), (2, "y", "own"), (None, "n", "no id"), (None, "n", "no id"), (None, None, None), (5, "", None), (300, "z", "x" * 300_000), (None, "", "the same page")]
    return out


@pytest.mark.parametrize("segment,chunk,file", [(64, 16, 2000), (1, 5, 1 << 20), (100_000, 100_000, 1 << 20), (warc.SEGMENT, warc.CHUNK, warc.FILE)])
def test_pages_come_back(spark, rows, segment, chunk, file):
    own = [r for r in rows if segment > 1 or len(r[2] or "") < 200]
    pages = spark.createDataFrame(own, "page_id long, url string, html string").selectExpr("*", "1 AS key", "2 AS kind", "3 AS top").repartition(3)
    got = warc.round_trip(pages, segment=segment, chunk=chunk, file=file)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"]
    assert Counter(map(tuple, got.collect())) == wanted(own)


def test_small_payloads_are_no_revisits(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r.page_id, r.payload_digest): r for r in warc.round_trip(pages, least=14).collect()}
    assert all(r.record_type == "response" and r.refers_to is None for r in got.values() if r.payload_bytes < 14) and any(r.record_type == "revisit" for r in got.values())


def test_nothing(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.fixture(scope="module")
def archive(spark):
    """Records of a page in many segments and one in one, in no order."""
    long = "<p>" + "word " * 100
    parts = [list(warc.page_members(7, "u", long, None, None, 100, 30)), list(warc.page_members(8, "u", "short", None, None, 1000, 30)), list(warc.page_members(9, "u", None, 7, "u", 1000, 30))]
    found = [r for p in parts for m in p for r in warc.records(io.BytesIO(gzip.decompress(m)))]
    random.Random(1).shuffle(found)
    return found


def assembled(spark, found, **how):
    return {r.page_id: r for r in warc.assemble(spark.createDataFrame([(k, i, h, bytearray(c)) for k, i, h, c in found], warc.RECORD), **how).collect()}


def test_segments_in_any_order(spark, archive):
    got = assembled(spark, archive, with_payload=True)
    assert bytes(got[7].payload).decode() == "<p>" + "word " * 100 and got[7].problem is None and bytes(got[8].payload) == b"short" and got[9].refers_to == 7


def test_damage_is_told(spark, archive):
    at = next(i for i, r in enumerate(archive) if r[2].get("warc-segment-number") == "3")
    last = next(i for i, r in enumerate(archive) if "warc-segment-total-length" in r[2])
    first = next(i for i, r in enumerate(archive) if r[2].get("warc-segment-number") == "1")
    short = next(i for i, r in enumerate(archive) if r[2].get("x-page-id") == "8")

    def changed(i, headers=(), content=None):
        k, rid, h, c = archive[i]
        return [*archive[:i], (k, rid, h | dict(headers), c if content is None else content), *archive[i + 1 :]]

    without = lambda i: [r for j, r in enumerate(archive) if j != i]
    body = archive[short][3]
    for found, page, what in (
        (without(at), 7, "segments"), ([*archive, archive[at]], 7, "segments"), (without(last), 7, "length"), (changed(last, {"warc-segment-total-length": "9"}), 7, "length"),
        (changed(short, content=body.replace(b"5\r\nshort", b"6\r\nshort")), 8, "framing"), (changed(short, content=body.replace(b"short", b"shirt")), 8, "digest"), (changed(short, content=b"x"), 8, "HTTP"), (changed(short, content=body[:-4]), 8, "framing"),
    ):
        got = assembled(spark, found)
        assert what in got[page].problem and got[page].payload_bytes is None and all(got[p].problem is None for p in {7, 8, 9} - {page})
    lone = assembled(spark, without(first))
    assert "segments" in lone[None].problem and 7 not in lone
    orphan = warc.resolved(warc.assemble(spark.createDataFrame([(k, i, h, bytearray(c)) for k, i, h, c in without(at)], warc.RECORD))).where("page_id = 9").first()
    assert orphan.problem == "no response" and orphan.payload_bytes is None


def test_framing():
    rng = random.Random(2)
    for n in (0, 1, 15, 16, 17, 400):
        raw = bytes(rng.randrange(256) for _ in range(n))
        assert all(warc.unframed(warc.framed(raw, k)) == raw for k in (1, 16, 1000))
    assert warc.unframed(b"3;name=x\r\nabc\r\n 2 \r\nde\r\n00\r\nTrailer: y\r\n\r\n") == b"abcde"
    assert all(warc.unframed(x) is None for x in (b"", b"0", b"0\r\n", b"3\r\nabcd\r\n0\r\n\r\n", b"-3\r\nabc\r\n0\r\n\r\n", b"g\r\n", b"3\r\nab"))


def test_only_committed_files_count(spark, rows, tmp_path):
    """What a lost task left isn't read; another folder's archives are, and files that aren't packed."""
    own = str(tmp_path / "a")
    pages = spark.createDataFrame([r for r in rows if r[0] is not None][:50], "page_id long, url string, html string")
    warc.write(pages, own)
    n = warc.read(spark, own).count()
    (tmp_path / "a" / "pages-lost.warc.gz").write_bytes(b"".join(warc.page_members(999, "u", "lost", None, None, 10, 10)))
    assert warc.read(spark, own).count() == n
    warc.write(pages.select("page_id", "url", F.concat("html", F.lit("!")).alias("html")), own)
    assert warc.read(spark, own).count() == 2 * n
    plain = tmp_path / "b.warc"
    plain.write_bytes(b"".join(gzip.decompress(m) for m in warc.page_members(1, "u", "text " * 50, None, None, 100, 10)).replace(b"WARC-Date: ", b"X-Folded: a\r\n\t b\r\nWARC-Date: "))
    found = warc.read(spark, f"file://{plain}")
    assert assembled(spark, [tuple(r) for r in found.collect()])[1].payload_bytes == 250 and found.first().headers["x-folded"] == "a b"
    plain.write_bytes(plain.read_bytes()[:-60])
    with pytest.raises(Exception, match="ends within a record"):
        warc.read(spark, f"file://{plain}").count()


def test_archives_go_with_the_driver(spark, rows):
    with common.listing() as made:
        warc.round_trip(spark.createDataFrame(rows[:5], "page_id long, url string, html string")).collect()
    assert any(re.search("archives-", p) for p in made) and set(made) <= set(common._LISTS[0])
