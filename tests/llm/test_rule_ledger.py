import random
import re
import unicodedata
from collections import Counter

from corpus import BASE, CLASHING, awkward, frame
from pyspark.sql import functions as F

from snapgrid.llm.rule_ledger import BASE as BASE_POLICY
from snapgrid.llm.rule_ledger import MEASURES, POLICIES, RULES, Policy, ablation, group_patterns, latest, ledger, mask_of, verdicts

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words, lines = WORD.findall(text), [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    twice = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    kind = [unicodedata.category(c) for c in text]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(twice),
        "n_letter_words": sum(any(unicodedata.category(c)[0] == "L" for c in w) for w in words),
        "n_letters": sum(k[0] == "L" for k in kind),
        "n_capitals": sum(k == "Lu" for k in kind),
    }


def failed(m):
    checks = [
        m["n_words"] < 10,
        100 * m["n_repeat_words"] > 20 * m["n_words"],
        100 * m["n_symbols"] > 10 * m["n_words"],
        100 * m["n_dup_lines"] > 50 * m["n_lines"],
        m["word_chars"] < 2 * m["n_words"],
        m["word_chars"] > 15 * m["n_words"],
        100 * m["n_letter_words"] < 80 * m["n_words"],
        m["n_letters"] >= 40 and 100 * m["n_capitals"] > 50 * m["n_letters"],
    ]
    return sum(1 << i for i, bad in enumerate(checks) if bad)


def texts():
    rng = random.Random(5)
    pieces = ["a", "bé", "Cc", "#", "12", "a b c d e", "\n", " \n", "x|y", " ", "😀", "a\nb", "\x0b", "ÄÖ"]
    rows = [(100 + i, "".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randint(0, 90))), None, f"s{i % 3}", 1) for i in range(150)]
    # Windows that overlap, touch and lie apart.
    shaped = ["a b c d e a b c d e", "a a a a a a", "1 2 3 4 5 x 1 2 3 4 5 y 2 3 4 5 x", BASE.upper(), "same line\n" * 9]
    return awkward() + rows + [(300 + i, text, "en", None, 1) for i, text in enumerate(shaped)]


def test_measurements_and_bits_equal_brute_force(spark):
    rows = texts()
    marked, name = ledger(frame(spark, rows, clashing=True).withColumn("ledger", F.lit("own")))
    assert name == "ledger_" and marked.columns == [*frame(spark).columns, *CLASHING, "ledger", "ledger_"]
    got = marked.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r[0], r[1]) for r in rows)
    for r in got:
        want = brute(r["text"])
        assert {m: r[name][m] for m in MEASURES} == want, r["text"]
        assert r[name]["bits"] == failed(want)


def test_a_readers_filter_measures_once(spark):
    """Pushed below the ledger, a filter would repeat every measurement inside itself."""
    rows, name = ledger(frame(spark))
    plan = rows.filter(F.col(f"{name}.bits") == 0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")
    assert {r["doc_id"] for r in rows.filter(F.col(f"{name}.n_words") >= 60).collect()} >= {1, 2, 3, 4}


def test_policies_are_masks(spark):
    assert latest("web").version == 2 and latest("web").mask == (1 << len(RULES)) - 1
    rows = spark.createDataFrame([(b,) for b in range(16)], "bits long")
    policies = [BASE_POLICY, Policy("p", 1, mask_of(["symbols", "few_words"])), Policy("q", 3, 0b1111, allowed=1)]
    for r in verdicts(rows, F.col("bits"), policies).collect():
        for p in policies:
            assert r[p.label] == ((r["bits"] & p.mask).bit_count() <= p.allowed)


def test_ablation_equals_counting(spark):
    rng = random.Random(1)
    masks = [rng.choice([0, 0, rng.randrange(256)]) for _ in range(500)]
    rows = spark.createDataFrame([(b, i % 2) for i, b in enumerate(masks)], "bits long, g long")
    got = {(r["policy"], r["rule"]): r for r in ablation(rows, F.col("bits"), POLICIES).collect()}
    assert len(got) == sum(p.mask.bit_count() for p in POLICIES)
    for p in POLICIES:
        gone = [b for b in masks if (b & p.mask).bit_count() > p.allowed]
        for i, rule in enumerate(RULES):
            if not p.mask >> i & 1:
                continue
            r = got[p.label, rule]
            assert (r["documents"], r["rejected"], r["failed"]) == (500, len(gone), sum(b >> i & 1 for b in masks))
            assert r["sole"] == sum(b & p.mask == 1 << i for b in gone)
            assert r["kept_without"] == sum((b & p.mask & ~(1 << i)).bit_count() <= p.allowed for b in gone)
    for r in group_patterns(rows, F.col("bits"), "g").collect():
        mine = [b for i, b in enumerate(masks) if i % 2 == r["g"]]
        every = mine[0]
        some = 0
        for b in mine:
            every, some = every & b, some | b
        assert (r["documents"], r["any_failed"], r["all_failed"]) == (len(mine), some, every)


def test_empty_table(spark):
    rows, name = ledger(frame(spark, []))
    assert rows.count() == 0
    assert ablation(rows, F.col(f"{name}.bits"), POLICIES).count() == 0
