import re
from collections import Counter

import pytest
from corpus import BASE, CLASHING, DATA, HAVE, awkward, changed, frame

from snapgrid.llm import secret_crf as sc
from snapgrid.llm.license_bands import Settings, found_licenses, license_summary, parts

needs_data = pytest.mark.skipif(not HAVE, reason="driver tables are absent")


def brute(text, settings):
    """Licenses all of whose parts have enough shingles in some window."""
    words = [w for w in re.split(r"[^a-z0-9]+", (text or "").lower()) if w]
    have, need = set(), {}
    for number, p in enumerate(parts(settings)):
        need.setdefault((p.license_id, p.template), []).append(number)
        wanted = set(p.shingles(settings.words))
        for start in range(0, max(1, len(words)), p.class_words):
            window = words[start : start + 2 * p.class_words]
            n = max(1, len(window) - settings.words + 1)
            got = {" ".join(window[i : i + settings.words]) for i in range(n)} if window else set()
            if len(wanted & got) >= settings.containment * len(wanted):
                have.add(number)
    return sorted({k[0] for k, own in need.items() if set(own) <= have})


def test_licenses_equal_brute_force(spark):
    settings = Settings()
    notices = [t for texts in settings.templates.values() for t in texts]
    filler = "lorem ipsum dolor sit amet under the license version software "
    rows = awkward()
    for i, notice in enumerate(notices):
        cut = " ".join(notice.split()[: len(notice.split()) // 2])
        for j, body in enumerate([notice, filler * j_words(i) + notice.upper() + "\n" + filler, filler + cut, notice.replace(" ", " \n ")]):
            rows.append((1000 + 10 * i + j, body, None, None, None))
    out = license_summary(frame(spark, rows, clashing=True), settings).collect()
    assert len(out) == len(rows)
    want = {r[0]: brute(r[1], settings) for r in rows if r[0] is not None}
    for r in out:
        if r.doc_id is not None:
            assert r.licenses == ",".join(want[r.doc_id])
            assert r.n_licenses == len(want[r.doc_id]) and (r.containment is None) == (not want[r.doc_id])
    assert all(settings.templates[k] for k in {x for v in want.values() for x in v})


def j_words(i):
    return i % 4 + 1


def test_license_scan_is_native(spark):
    found = found_licenses(frame(spark))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
    assert license_summary(frame(spark, [])).collect() == []


def test_wordings_and_versions(spark):
    gpl = "This program is free software{} you can redistribute it and/or modify it under the terms of the GNU {}General Public "
    gpl += "License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
    want = {
        "Licensed under the MIT License": "mit",
        "distributed under the terms of the MIT licence.": "mit",
        "Licensed under CC BY-SA 4.0": "cc-by-sa-4.0",
        "This work is licensed under the GNU General Public License, version 2.": "gpl-2.0",
        "This work is licensed under the GNU Lesser General Public License, version 3.": "lgpl-3.0",
        gpl.format(";", "", 2): "gpl,gpl-2.0",
        gpl.format(":", "", 3): "gpl,gpl-3.0",
        gpl.format(":", "Affero ", 3): "agpl-3.0",
        gpl.format(":", "Lesser ", "2.1"): "lgpl-2.1",
        "Released under the ISC License": "isc",
        "made available under the Eclipse Public License 2.0": "epl-2.0",
        "This is free and unencumbered software released into the public domain.": "unlicense",
        "Licensed under the Apache License, Version 1.1.": "",
        "GNU General Public License " + "word " * 2000 + "either version 3 of the License": "",
    }
    rows = [(i, text, None, None, None) for i, text in enumerate(want)]
    assert {rows[r.doc_id][1]: r.licenses for r in license_summary(frame(spark, rows)).collect()} == want


# ---------------------------------------------------------------- pipeline


def write(spark, folder, rows, labels, items):
    docs = frame(spark, rows, clashing=True).drop("row")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    import corpus_pipeline

    rows, labels = awkward(), []
    for i in range(200, 320):
        words = [f"w{(i * 7 + j * j) % 90}" for j in range(30)] + [f"id{i}"]
        bad = i % 5 == 0
        if bad:
            words[3] = "vile"
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(bad)))
    rows += [(400, "w1 w2 w4 " + " ".join(BASE.split()[5:40]) + " w5", "en", "s", 1), (401, changed(7) + " w1 w2", "en", "s", 1)]
    good = " ".join(f"w{(7 * 402 + j * j) % 90}" for j in range(30))
    rows.append((402, good + ' token = "0123456789abcdef0123456789abcdef" w3 w8 id402', "en", "s", 1))
    item = " ".join(BASE.split()[44:56])
    folder = write(spark, tmp_path_factory.mktemp("pipeline"), rows, labels, [(1, item), (2, None)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "rows")
        stage(spark, out[-1][1], folder).write.parquet(path)
        out.append((name, spark.read.parquet(path)))
    return dict(out)


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda x: (x is not None, x))


def test_stage_order_and_columns(stages):
    names = list(stages)
    assert names == ["documents", "quality", "near_dedup", "decontamination", "secrets", "packing"]
    for a, b in zip(names[:-2], names[1:-1]):
        assert stages[a].dtypes == stages[b].dtypes
    assert set(CLASHING) - {"row"} <= set(stages["secrets"].columns)


def test_quality_rejects_bad_and_keeps_good(stages):
    kept = ids(stages["quality"])
    assert all((i in kept) == (i % 5 != 0) for i in range(200, 320))
    assert not {5, 6, 7} & set(kept)


def test_one_of_each_group_stays(stages):
    before, after = stages["quality"].collect(), ids(stages["near_dedup"])
    sets = {}
    for r in before:
        w = (r.text or "").lower().split()
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    known = [i for i in after if i is not None]
    assert len(known) == len(set(known))
    alike = lambda a, b: 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])
    assert not any(alike(a, b) for a in known for b in known if a < b)
    assert all(any(alike(i, k) for k in known) for i in sets if i is not None)
    assert after.count(None) == ids(stages["quality"]).count(None)


def test_contaminated_go_and_secrets_are_marked(stages):
    texts = {r.doc_id: r for r in stages["secrets"].collect()}
    item = " ".join(BASE.split()[44:56])
    assert not any(item in (r.text or "") for r in texts.values())
    assert 400 in texts
    assert "0123456789abcdef" not in texts[402].text and "[SECRET]" in texts[402].text
    assert texts[402].text.endswith("w3 w8 id402") and texts[402].n_chars == len(texts[402].text)
    assert not any(sc.pattern_spans(r.text or "") for r in texts.values())


def test_packing_covers_what_is_left(stages):
    assert set(ids(stages["packing"])) == set(ids(stages["secrets"]))


def test_empty_tables(spark, tmp_path):
    import corpus_pipeline

    folder = write(spark, tmp_path / "none", [], [], [])
    assert corpus_pipeline.run(spark, folder).collect() == []


@needs_data
def test_run_equals_its_stages(spark, tmp_path):
    import corpus_pipeline

    rows = spark.read.parquet(f"{DATA}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, rows, DATA).write.parquet(path)
        rows = spark.read.parquet(path)
    out = corpus_pipeline.run(spark, DATA)
    pieces = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert Counter(out.select(*pieces).collect()) == Counter(rows.select(*pieces).collect())
    # Whole documents, piece after piece, and windows that are full or end with their last piece.
    held = {}
    for r in sorted(out.collect(), key=lambda r: (r.doc_id, r.start)):
        assert r.start == held.get(r.doc_id, 0)
        held[r.doc_id] = r.start + r.length
    assert all(held[r.doc_id] == r.doc_tokens for r in rows.collect()) and len(held) > 50
    assert corpus_pipeline.ORACLE_SQL is None
