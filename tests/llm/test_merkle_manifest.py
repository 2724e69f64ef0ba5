import hashlib
import random
import zlib
from collections import Counter

import pytest
from corpus import awkward, frame
from pyspark.sql import functions as F

from snapgrid.llm import queries
from snapgrid.llm.merkle_manifest import FIELDS, folded, hex_of, leaf_digest, manifest, proofs, siblings


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*fields):
    return digest(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def tree(leaves):
    """The root of a list of digests and each leaf's path: (siblings before, siblings behind) per level."""
    paths, at = [[] for _ in leaves], list(range(len(leaves)))
    while len(leaves) > 1:
        for path, i in zip(paths, at):
            run = i // 3 * 3
            path.append((leaves[run:i], leaves[i + 1 : run + 3]))
        at = [i // 3 for i in at]
        leaves = [digest(*leaves[i : i + 3]) for i in range(0, len(leaves), 3)]
    return leaves[0], paths


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded root) of every row, fields in table order."""
    by_source = {}
    for doc_id, text, lang, source, n_chars in rows:
        even = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        shown = text.replace("\n", "") if even and text is not None else text
        by_source.setdefault(source, []).append(
            (doc_id is not None, doc_id or 0, leaf(doc_id, source, lang, n_chars, text), leaf(doc_id, source, lang, n_chars, shown), doc_id)
        )
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        members = sorted(by_source[name], key=lambda m: m[:3])
        trees[name] = (members, *tree([m[2] for m in members]))
    root, tops = tree([trees[name][1] for name in names])
    out = Counter()
    for name, top in zip(names, tops):
        members, subroot, paths = trees[name]
        for (_, _, own, shown, doc_id), path in zip(members, paths):
            whole = path + top
            at = shown
            for before, behind in whole:
                at = digest(*before, at, *behind)
            out[doc_id, own, subroot, root, digest(*[d for b, c in whole for d in b + c]), at] += 1
    return out


def many():
    rng = random.Random(4)
    rows = awkward()
    for s, n in [("a", 30), ("ä", 1), ("Z", 2), ("", 3), (None, 4), ("z" * 30, 28), ("b", 9), ("c", 10), ("d", 81)]:
        rows += [(rng.randint(0, 10**6), f"t{i}\nx\r\n" if i % 3 else "plain", None, s, i) for i in range(n)]
    return rows + [rows[-1]] * 11


@pytest.mark.parametrize("rows", [many(), awkward()[:1], awkward()[:5], [(1, "a\n", None, None, None)] * 7], ids=["many", "one", "few", "copies"])
def test_query_equals_brute_force(spark, tmp_path, rows):
    frame(spark, rows, clashing=True).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op12_merkle_manifest"](spark, str(tmp_path)).collect()
    want = brute(rows)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
    assert Counter(tuple(r[n] for n in names) for r in got) == want
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in got)


def _leaves(spark, rows):
    return frame(spark, rows).select("source", "doc_id", leaf_digest([F.col(c) for c in FIELDS]).alias("leaf"))


def test_some_leaves_alone(spark):
    """A request for some leaves gives the same paths, and opens no node that leads to none of them."""
    m = manifest(_leaves(spark, many()))
    every = {(r["tree"], r["rank"]): r["path"] for r in proofs(m).collect()}
    some = m.leaves.filter("tree % 2 = 0 and rank % 7 = 3")
    got = {(r["tree"], r["rank"]): r["path"] for r in proofs(m, some).collect()}
    assert got == {k: p for k, p in every.items() if k[0] % 2 == 0 and k[1] % 7 == 3} and got


def test_a_changed_leaf_does_not_fold_to_the_root(spark):
    found = proofs(manifest(_leaves(spark, many())))
    own = folded(hex_of(F.col("leaf")), F.col("path"))
    other = folded(F.sha2("leaf", 256), F.col("path"))
    checked = found.select((own == hex_of(F.col("root"))).alias("own"), (other == hex_of(F.col("root"))).alias("other"), siblings(F.col("path")))
    assert {(r["own"], r["other"]) for r in checked.collect()} == {(True, False)}


def test_empty_dataset(spark):
    m = manifest(_leaves(spark, []))
    assert proofs(m).count() == 0 and m.root.count() == 0


def test_records_are_addressed_by_content(spark):
    m = manifest(_leaves(spark, many()))
    assert [len(m.nodes), len(m.tops)] == [5, 2]
    for r in [r for level in [*m.nodes, *m.tops] for r in level.collect()]:
        assert hashlib.sha256(r["children"].hex().encode()).digest() == r["digest"]
