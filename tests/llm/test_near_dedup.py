import itertools
import random

import numpy as np
import pytest
from corpus import BASE, awkward, changed, frame

from snapgrid.llm.near_dedup import Settings, index_keys, near_duplicates


def shingles(text, width=5):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def expected(rows, percent):
    """Component of every id by comparing all pairs."""
    ids = sorted({r[0] for r in rows if r[0] is not None})
    sets = {r[0]: shingles(r[1]) for r in rows}
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(ids, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: root(i) for i in ids}, {i: len(sets[i]) for i in ids}


def check(rows, found, percent):
    component, size = expected(rows, percent)
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (size[r.doc_id], component[r.doc_id], r.doc_id == component[r.doc_id])


@pytest.mark.parametrize("percent", [80, 85])
def test_awkward_rows(spark, percent):
    check(awkward(), near_duplicates(frame(spark, clashing=True), Settings(percent=percent)).collect(), percent)


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).collect() == []


def test_near_group_in_many_blocks_equals_all_pairs(spark):
    """A group whose members are similar in chains only, compared in blocks of four rows."""
    rng = random.Random(5)
    rows = []
    for i in range(70):
        words = BASE.split()
        for at in rng.sample(range(60), rng.choice([1, 2, 3])):
            words[at] = f"new{rng.randint(0, 3)}"
        rows.append((i, " ".join(words), None, None, None))
    found = near_duplicates(frame(spark, rows), Settings(percent=80, block=4)).collect()
    check(rows, found, 80)
    assert 1 < len({r.component_id for r in found}) < 70


def test_differing_texts_of_one_id_are_linked(spark):
    rows = [(1, "a b c d e f", None, None, None), (1, "g h i j k l", None, None, None), (2, "g h i j k l", None, None, None)]
    assert {r.component_id for r in near_duplicates(frame(spark, rows)).collect()} == {1}


def test_near_copies_of_every_text_of_an_id_are_linked(spark):
    other = " ".join(f"else{i}" for i in range(60))
    third = " ".join(f"third{i}" for i in range(60))
    texts = [(5, BASE), (5, other), (5, third), (5, None), (5, ""), (7, changed(0)), (8, changed(0, other)), (9, changed(59, third)), (3, "lone words")]
    for rows in (texts, texts[::-1]):
        found = near_duplicates(frame(spark, [(i, t, None, None, None) for i, t in rows])).collect()
        assert {r.doc_id: r.component_id for r in found} == {5: 5, 7: 5, 8: 5, 9: 5, 3: 3}


def test_stage_keeps_different_texts_of_an_id(spark):
    import corpus_pipeline

    other = " ".join(f"else{i}" for i in range(60))
    rows = [(5, BASE), (5, BASE), (5, changed(0)), (5, other), (6, changed(59, other)), (7, "alone here"), (None, BASE)]
    docs = frame(spark, [(i, t, None, None, None) for i, t in rows], clashing=True)
    out = corpus_pipeline.near_dedup_stage(spark, docs, "")
    left = [r.text for r in out.select("text", "doc_id").collect() if r.doc_id is not None]
    assert out.columns == docs.columns and len(left) == 3
    assert sum(t.startswith("alone") for t in left) == 1 and sum("else5" in t.split() for t in left) == 1


def test_signatures_within_reach_share_a_key(spark):
    settings = Settings()
    rng = np.random.default_rng(3)
    rows = []
    for i in range(40):
        x = rng.integers(0, 1 << 16, settings.symbols).astype(np.uint16)
        y = x.copy()
        at = rng.choice(settings.symbols, settings.reach, replace=False)
        y[at] ^= 1
        rows += [(2 * i, x.tobytes()), (2 * i + 1, y.tobytes())]
    keys = index_keys(spark.createDataFrame(rows, "node long, signature binary"), settings).collect()
    by_node = {}
    for k in keys:
        by_node.setdefault(k.node, set()).add(k.key)
    assert all(len(v) == len(settings.slots) for v in by_node.values())
    assert all(by_node[2 * i] & by_node[2 * i + 1] for i in range(40))


def test_borderline_pairs(spark):
    """Chains of single changes: exact at the threshold."""
    rows = [(i, changed(0 if i % 2 else 30, BASE + f" tail{i // 2}"), None, None, None) for i in range(12)]
    check(rows, near_duplicates(frame(spark, rows), Settings(percent=85)).collect(), 85)
