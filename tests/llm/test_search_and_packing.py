import random
import re
import zlib

import pyarrow as pa
import pytest
from corpus import BASE, CLASHING, awkward, frame

from snapgrid.llm import window_packing as wp
from snapgrid.llm.wu_manber import decontaminated, find_items

ITEM = "item_id long, text string"


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text, items, window=10):
    w = words(text)
    hit, ids = set(), set()
    for item, body in items:
        p = words(body)
        m = min(window, len(p))
        if not m:
            continue
        wins = {tuple(p[i : i + m]) for i in range(len(p) - m + 1)}
        for i in range(len(w) - m + 1):
            if tuple(w[i : i + m]) in wins:
                hit.update(range(i, i + m))
                if item is not None:
                    ids.add(str(item))
    return len(w), len(hit), sorted(ids)


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_occurrences_equal_brute_force(spark, block_bytes):
    rng = random.Random(2)
    vocabulary = ["a", "b", "cé", "d1"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 4, 9, 10, 11, 14]))) for i in range(3, 30)]
    items += [(None, "x y z"), (100, None), (101, " .,; "), (102, "solo"), items[3], (10, BASE), (9, BASE)]
    items = [(i, t) for i, t in items if t is None or len(words(t)) != 1 or words(t)[0] == "solo"]
    rows = awkward() + [(100 + i, text(rng.randint(0, 400)) + (" X, y-Z solo" if i % 3 else ""), None, None, None) for i in range(40)]
    found = find_items(frame(spark, rows, clashing=True), spark.createDataFrame(items, ITEM), block_bytes=block_bytes)
    n = found.names
    got = [(r["doc_id"], r["text"], r[n["n_words"]], r[n["n_hit"]], r[n["items"]], r[n["hits"]]) for r in found.rows.collect()]
    assert len(got) == len(rows)
    for _, t, n_words, n_hit, ids, hits in got:
        assert (n_words, n_hit, ids) == brute(t, items)
        assert (hits is not None) == (n_hit > 0)
        assert sum(bin(b).count("1") for b in hits or b"") == n_hit
    assert set(CLASHING) <= set(found.rows.columns)


def test_decontaminated_keeps_clean_rows_and_columns(spark):
    docs = frame(spark, clashing=True)
    out = decontaminated(docs, spark.createDataFrame([(1, changed_item())], ITEM))
    assert out.columns == docs.columns
    want = [r[0] for r in awkward() if brute(r[1], [(1, changed_item())])[1] == 0]
    key = lambda x: (x is not None, x)
    assert sorted((r.doc_id for r in out.collect()), key=key) == sorted(want, key=key)
    assert decontaminated(docs, spark.createDataFrame([], ITEM)).count() == docs.count()
    assert decontaminated(frame(spark, []), spark.createDataFrame([(1, "a b")], ITEM)).count() == 0


def changed_item():
    return "lead " + " ".join(BASE.split()[20:31]) + " end"


# ---------------------------------------------------------------- packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def reference_ids(texts):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = True
    return [x.ids for x in own.encode_batch([t or "" for t in texts], add_special_tokens=False)]


ODD = [
    "it's 'the dog''s!! İ! €! naïve café x y a\x00b a\x1fb 12a3 ²x ½ <|endoftext|> ﬁ 한국어 नमस्ते! ẞ ΑΣ.",
    None, "", "  \n", "'", "''s", "I'LL DON'T we've", "﻿abc", "a‍b", "Á'S", "İ̇.", "日本語。テスト!", "٣٤5", "..a..", "a" * 5000,
]


@pytest.mark.parametrize("remember", [3, 40, 1_000_000])
def test_ids_equal_the_library(remember):
    """Also when the store is emptied within a text or between texts that share words."""
    own = wp.WordEncoder(PATH, remember)
    every = ODD + [r[1] for r in awkward()]
    for texts in (every, every[::2], every[1:], [BASE + " new words", BASE, "one more"], every):
        ids, borders = own.encode(pa.array(texts, pa.string()))
        got = [ids[a:b].tolist() for a, b in zip(borders[:-1], borders[1:])]
        assert got == reference_ids(texts)


def test_pieces_tile_documents_and_sequences(spark):
    rows = awkward() + [(1000 + i, " ".join(["alpha beta"] * (i * 7 % 300)), None, None, None) for i in range(300)]
    settings = wp.Settings(PATH, size=256, open_windows=4, merged=2)
    out = wp.packed(frame(spark, rows, clashing=True).repartition(5), settings).collect()
    ids = {}
    for r, own in zip(rows, reference_ids([r[1] for r in rows])):
        ids.setdefault(r[0], []).append([*own, 1])
    pieces, sequences = {}, {}
    for p in out:
        pieces.setdefault(p.doc_id, []).append(p)
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert set(pieces) == set(ids)
    for doc, copies in ids.items():
        assert sum(p.length for p in pieces[doc]) == sum(len(c) for c in copies)
        for p in pieces[doc]:
            raw = [c[p.start : p.start + p.length] for c in copies if len(c) == p.doc_tokens]
            assert p.ids_crc32 in [zlib.crc32(b"".join(i.to_bytes(4, "little") for i in x)) for x in raw]
    fills = []
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
        fills.append(at)
    assert sum(fills) / (256 * len(fills)) > 0.9


def test_packing_of_nothing(spark):
    assert wp.packed(frame(spark, []), wp.Settings(PATH)).collect() == []


def test_open_windows_are_bounded_and_best_fit():
    windows = wp.OpenWindows(10, 2)
    assert windows.place(("a",), 6) is None and windows.place(("b",), 7) is None
    assert windows.place(("c",), 3) == [("b",), ("c",)]
    assert windows.place(("d",), 8) is None
    assert windows.place(("e",), 5) == [("d",)]
    assert len(windows.gaps) == 2
