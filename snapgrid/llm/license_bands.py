"""License scan: MinHash bands over overlapping text windows retrieve templates, shingle containment verifies them.

A template is cut into parts of at most a class length of words; its words in square brackets (names and versions,
``license_texts``) are parts of their own that count word for word. All parts have to stand near each other. Windows of twice that length, every class
length, contain any stretch of a class length whole. A window and a part that hold at least ``containment`` of the
part's shingles have a known least Jaccard similarity, and the number of one-row bands is chosen so that such a
pair collides in some band with at least ``retrieval`` probability. Retrieved pairs are verified on their sets.

Only DataFrame operations. At scale: parts and bands are a fixed small table (its size is that of the templates
given). Every part has anchor words without which too few of its shingles could occur; texts and then windows
without any anchor are passed over, which loses nothing. Documents are scanned once and not shuffled; only
findings are grouped.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapgrid.llm.license_texts import TEMPLATES

_WORD = r"[^a-z0-9]+"


@dataclass(frozen=True)
class Settings:
    """A match holds ``containment`` of a part's shingles of ``words`` words; classes are part lengths in words."""

    words: int = 3
    containment: float = 0.8
    retrieval: float = 0.999999
    classes: tuple[int, ...] = (4, 8, 16)
    templates: dict[str, list[str]] = field(default_factory=lambda: TEMPLATES)


@dataclass(frozen=True)
class Part:
    license_id: str
    template: int
    class_words: int
    words: tuple[str, ...]

    def shingles(self, width: int) -> list[str]:
        n = max(1, len(self.words) - width + 1)
        return list(dict.fromkeys(" ".join(self.words[i : i + width]) for i in range(n)))

    def anchors(self, width: int, containment: float, preferred: frozenset[str] | set[str] = frozenset()) -> list[str]:
        """Preferred and longest words first, until a part of enough shingles must contain one of them."""
        chosen: list[str] = []
        shingles = self.shingles(width)
        for word in sorted(set(self.words), key=lambda w: (w not in preferred, -len(w), w)):
            free = [s for s in shingles if not set(s.split()) & set(chosen)]
            if len(free) < containment * len(shingles):
                break
            chosen.append(word)
        return chosen


def _words(text: str) -> list[str]:
    return [w for w in re.split(_WORD, text.lower()) if w]


def parts(settings: Settings) -> list[Part]:
    """Every template's stretches, and its bracketed words in overlapping parts of two shingles, both needed."""
    out = []
    longest, exact = settings.classes[-1], settings.words + 1

    def add(license_id: str, number: int, own: list[str]) -> None:
        fit = next(c for c in settings.classes if len(own) <= c)
        out.append(Part(license_id, number, fit, tuple(own)))

    for license_id, texts in settings.templates.items():
        for number, text in enumerate(texts):
            marked = re.findall(r"\[([^\]]*)\]", text)
            if _words(re.sub(r"\[[^\]]*\]", " ", text)):
                words = _words(text)
                size = math.ceil(len(words) / max(1, math.ceil(len(words) / longest)))
                for at in range(0, len(words), size):
                    add(license_id, number, words[at : at + size])
            for own in map(_words, marked):
                last = max(0, len(own) - exact)
                for at in sorted({*range(0, last, exact - settings.words + 1), last}):
                    add(license_id, number, own[at : at + exact])
    return out


def bands_for(part: Part, settings: Settings) -> int:
    """Bands of one row each that let a window with enough of the part's shingles collide as often as wanted."""
    n = len(part.shingles(settings.words))
    least = math.ceil(settings.containment * n)
    window = max(1, 2 * part.class_words - settings.words + 1)
    jaccard = least / (window + n - least)
    return math.ceil(math.log(1 - settings.retrieval) / math.log(1 - jaccard)) if jaccard < 1 else 1


def shingle_hashes(words: Column, width: int) -> Column:
    """Distinct hashes of every run of ``width`` words; of the whole sequence if it is shorter; none of no word."""
    last = F.greatest(F.size(words) - width, F.lit(0))
    runs = F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.array_join(F.slice(words, i, width), " ")))
    return F.when(F.size(words) == 0, F.array().cast("array<long>")).otherwise(F.array_distinct(runs))


def minima(hashes: Column, class_words: Column, bands: Column) -> Column:
    """For every band the smallest hash under its own seed, as one number together with the class and the band."""
    least = lambda b: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, b)))
    return F.transform(F.sequence(F.lit(1), bands), lambda b: F.xxhash64(class_words, b, least(b)))


def found_licenses(
    documents: DataFrame, settings: Settings | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``license_id``, ``template``, ``containment``, ``word_start``: one row for each template found.

    Words are runs of ASCII letters and digits of the lower-cased text. ``containment`` is the lowest over a
    template's parts, all of which must be found near each other (the greatest of several places); ``word_start`` is
    the first window of the first place. Null and
    empty texts have none. Repeated rows of an id are one document.
    """
    settings = settings or Settings()
    known = parts(settings)
    spark = documents.sparkSession
    by_class = {c: [p for p in known if p.class_words == c] for c in sorted({p.class_words for p in known})}
    bands = {c: max(bands_for(p, settings) for p in own) for c, own in by_class.items()}
    preferred: set[str] = {"license"}
    of_part = []
    for p in known:
        of_part.append(p.anchors(settings.words, settings.containment, preferred))
        preferred.update(of_part[-1])
    anchors = {c: sorted({a for p, own in zip(known, of_part) if p.class_words == c for a in own}) for c in by_class}
    # A template needs all of its parts, so the anchors of any one of them decide whether a text can have it.
    least: dict[tuple[str, int], set[str]] = {}
    for p, own in zip(known, of_part):
        key = (p.license_id, p.template)
        least[key] = min(least.get(key, set(own)), set(own), key=lambda a: (len(a - {"license"}), sorted(a)))
    rows = [(i, p.license_id, p.template, p.class_words, bands[p.class_words], list(p.words)) for i, p in enumerate(known)]
    table = spark.createDataFrame(rows, "part int, license_id string, template int, class int, bands int, words array<string>")
    table = table.withColumn("wanted", shingle_hashes(F.col("words"), settings.words))
    table = table.withColumn("band", F.explode(minima(F.col("wanted"), F.col("class"), F.col("bands"))))
    table = table.drop("words", "class", "bands")
    lowered = F.lower(F.col(text).cast("string"))
    possible = [lowered.contains(a) for a in sorted({a for own in least.values() for a in own})]
    worded = documents.where(reduce(or_, possible)).select(
        F.col(doc_id).cast("long").alias("doc_id"), F.filter(F.split(lowered, _WORD), lambda w: w != "").alias("words")
    )
    each = F.array(
        *[
            F.struct(F.lit(c).alias("class"), F.lit(bands[c]).alias("bands"), F.array(*map(F.lit, anchors[c])).alias("anchors"))
            for c in by_class
        ]
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("words"), F.lit(1)), F.col("c.class"))
    windows = worded.select("doc_id", "words", F.explode(each).alias("c"))
    windows = windows.select("doc_id", "words", "c", F.explode(starts).alias("word_start"))
    windows = windows.withColumn("words", F.slice("words", F.col("word_start"), F.col("c.class") * 2))
    windows = windows.where(F.arrays_overlap("words", "c.anchors"))
    windows = windows.select("doc_id", "word_start", "c", shingle_hashes(F.col("words"), settings.words).alias("hashes"))
    banded = windows.select(
        "doc_id", "word_start", "hashes", F.explode(minima(F.col("hashes"), F.col("c.class"), F.col("c.bands"))).alias("band")
    )
    # The table holds the given templates alone.
    pairs = banded.join(F.broadcast(table), "band")
    share = F.size(F.array_intersect("wanted", "hashes")) / F.size("wanted")
    matched = pairs.withColumn("containment", share).where(F.col("containment") >= settings.containment)
    needed: dict[tuple[str, int], int] = {}
    reach: dict[tuple[str, int], int] = {}
    for p in known:
        key = (p.license_id, p.template)
        needed[key] = needed.get(key, 0) + 1
        reach[key] = reach.get(key, 4 * settings.classes[-1]) + len(p.words)
    wanted = spark.createDataFrame(
        [(*k, n, reach[k]) for k, n in needed.items()], "license_id string, template int, needed int, reach int"
    )
    # Matches less than a reach apart share one of the places, each of two reaches.
    place = F.floor(F.col("word_start") / F.col("reach"))
    placed = matched.join(F.broadcast(wanted), ["license_id", "template"])
    placed = placed.withColumn("place", F.explode(F.array(place - 1, place)))
    every = placed.groupBy("doc_id", "license_id", "template", "needed", "place", "part").agg(
        F.max("containment").alias("containment"), F.min("word_start").alias("word_start")
    )
    whole = every.groupBy("doc_id", "license_id", "template", "needed", "place").agg(
        F.count("*").alias("parts"), F.min("containment").alias("containment"), F.min("word_start").alias("word_start")
    )
    whole = whole.where("parts = needed").groupBy("doc_id", "license_id", "template").agg(
        F.max("containment").alias("containment"), F.min("word_start").alias("word_start")
    )
    return whole.select("doc_id", "license_id", "template", "containment", (F.col("word_start") - 1).alias("word_start"))


def license_summary(documents: DataFrame, settings: Settings | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: ``doc_id``, ``licenses`` (sorted, joined by commas), ``n_licenses``, ``containment``.

    A document without any, a null or empty text too, has an empty string, 0 and null. A null id stands for all documents
    without an id, rows of one id are one document. Texts of any length are searched whole; all licenses found
    count; an empty table gives no rows; other columns are not read.
    """
    matches = found_licenses(documents, settings, doc_id, text)
    by_doc = matches.groupBy(F.col("doc_id").alias("found_id")).agg(
        F.sort_array(F.collect_set("license_id")).alias("ids"), F.max("containment").alias("containment")
    )
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"))
    joined = rows.join(by_doc, F.col("doc_id").eqNullSafe(F.col("found_id")), "left")
    return joined.select(
        "doc_id",
        F.coalesce(F.array_join("ids", ","), F.lit("")).alias("licenses"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_licenses"),
        "containment",
    )
