import hashlib
import zlib

import pytest
from corpus import awkward, frame
from pyspark.sql import functions as F

from snapgrid.llm import lz_fingerprint as lz
from snapgrid.llm.minimax_shards import minimax_plan, sharded


def slow_phrases(text):
    seen, out, start = set(), [], 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in seen:
            seen.add(text[start:end])
            out.append(text[start:end])
            start = end
    return out


def test_phrases_and_continuation():
    for text in ["", "a", "aaaa", "abababab", "the cat the cat the hat", "ñandú ñandú", "\U0001f600" * 9]:
        assert lz.phrases(text) == slow_phrases(text)
        for cut in range(len(text) + 1):
            new = text[:cut] + "zab the"
            assert lz.phrases(new, lz.beginning(lz.phrases(text), cut)) == slow_phrases(new)


def test_every_row_against_its_neighbour(spark):
    rows = awkward()
    found = lz.fingerprints(frame(spark, rows, clashing=True)).collect()
    order = sorted(((r[0] is not None, r[0] or 0, r[1] or ""), r[0], r[1] or "") for r in rows)
    want = []
    for i, (_, doc, text) in enumerate(order):
        following = order[(i + 1) % len(order)][2]
        new = lz.edited(text, following)
        signs = lz.signatures([slow_phrases(t) for t in (text, new, following)])
        digest = hashlib.sha256(new.encode()).hexdigest()
        near = lz.likeness(signs[0], signs[1]), lz.likeness(signs[0], signs[2])
        want.append((doc, len(text), digest, lz.written(signs[0]), lz.written(signs[1]), *near))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)
    by_text = {}
    for doc, text, row in ((r[0], r[1], None) for r in rows):
        by_text.setdefault(text or "", set()).add(doc)
    prints = {r.doc_id: r.fingerprint for r in found if r.doc_id is not None}
    assert prints[1] == prints[2] and prints[5] == prints[6] == ""


@pytest.mark.parametrize("rows", [[], [(4, "only one", None, None, None)]])
def test_none_or_one_document(spark, rows):
    found = lz.fingerprints(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    if rows:
        assert found[0].near_next == 1.0


def least_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, used, room = (low + high) // 2, 1, (low + high) // 2
        for s in sizes:
            if s > room:
                used, room = used + 1, mid
            room -= s
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


@pytest.mark.parametrize("shards", [1, 3, 8])
@pytest.mark.parametrize("kind", ["even", "hot", "few"])
def test_smallest_capacity(spark, shards, kind):
    sizes = {"even": [7 + i * i % 31 for i in range(200)], "hot": [5] * 50 + [4_000] + [9] * 50, "few": [3, 8]}[kind]
    rows = [(hashlib.md5(str(i).encode()).hexdigest(), s) for i, s in enumerate(sizes)]
    plan = minimax_plan(spark.createDataFrame(rows, "digest string, size long"), shards)
    ordered = [s for _, s in sorted(rows)]
    assert plan.capacity == least_capacity(ordered, shards)
    assert len(plan.last_digests) < shards


def test_shards_of_awkward_rows(spark):
    rows = awkward()
    out = sharded(frame(spark, rows, clashing=True), 4).collect()
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in out) == sorted(
        (r[0] or 0, len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows
    )
    shards, slots = {}, {}
    for r in out:
        shards.setdefault(r.digest, set()).add(r.shard)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(len(s) == 1 for s in shards.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = {}
    for r in out:
        groups[r.digest] = groups.get(r.digest, 0) + r.size
    largest = max(sum(r.size for r in out if r.shard == s) for s in slots)
    assert largest == least_capacity([groups[d] for d in sorted(groups)], 4)


def test_sharding_is_native_and_empty_input_is_empty(spark):
    assert sharded(frame(spark, [])).collect() == []
    plan = sharded(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


def test_even_shards(spark):
    rows = [(i, f"text {i} " * (i % 13 + 1), None, None, None) for i in range(500)]
    sizes = [r.s for r in sharded(frame(spark, rows)).groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) < 8 * 200
