"""Secret scans: pattern spans, and a linear-chain conditional random field that adds what patterns miss.

Tokens are runs of letters, digits and the signs of keys. The field tags each as begin, inside or outside of a
secret from its shape, the words before it, the shapes beside it, what separates them, and features of the whole
text; Viterbi finds the best tags. It is fitted on a bounded sample whose pattern spans serve as labels, and on copies of
these texts in which keyword and value are replaced by random ones, so that shapes and surroundings have to do: it finds
secrets that no pattern names.

Decoding is exact but short: a token whose lead for "outside" exceeds anything the transitions could pay
back is outside on the best path whatever its neighbours are, so only the stretches between such tokens are
decoded, thousands side by side.

At scale: one pass over all texts without a shuffle; the model is a few tables of fixed size.
"""

from __future__ import annotations

import pickle
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapgrid.llm import textkit as tk
from snapgrid.llm.frames import bounded_sample, fresh_name, list_array, tidy

# The pattern spans, in the order in which equal starts are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "crf")

#: Documents that a fit reads, about: half at random, half with a keyword or access key.
SAMPLE = 1_500
#: Random documents that are searched for one with a keyword.
SEARCHED = 64
#: Text bytes whose features are in memory at one time.
SLICE_BYTES = 1 << 20
#: Stretches of tokens that a fit uses at most, those with a secret first.
CHUNKS = 6_000
CHUNK = 32


def pattern_spans(text: str) -> list[tuple[int, int, int, int]]:
    """Start, kind, end and start of the secret itself, of all pattern spans of a text, by start and kind."""
    found = []
    lowered = text.lower()
    if any(k in lowered for k in KEYWORDS):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


# ---------------------------------------------------------------- features

_LOWER = tk.members((0x61, 0x7A))
_UPPER = tk.members((0x41, 0x5A))
_DIGIT = tk.members((0x30, 0x39))
_HEXES = tk.members((0x30, 0x39), (0x61, 0x66), (0x41, 0x46))
_WIDE = tk.members((0x80, 0xFF))
_SIGN = tk.members((0x2B, 0x2B), (0x2D, 0x2F), (0x5F, 0x5F))
_TOKEN = _LOWER | _UPPER | _DIGIT | _WIDE | _SIGN
_GAPS = [
    tk.members((0x3D, 0x3D), (0x3A, 0x3A)),  # = :
    tk.members((0x22, 0x22), (0x27, 0x27), (0x60, 0x60)),  # quotes
    tk.members((0x0A, 0x0D)),
    tk.members((0x20, 0x20), (0x09, 0x09)),
]
_LENGTHS = np.array([2, 4, 8, 12, 16, 24, 40])
_WORDS = 1 << 12
_SHAPES = 32 * 8
#: Sizes of the feature blocks: own shape, own make-up, shapes beside, gaps beside, two words before, text.
_BLOCKS = [_SHAPES, 64, _SHAPES, _SHAPES, 32, 32, _WORDS, _WORDS, 20]
_STARTS = np.concatenate([[0], np.cumsum(_BLOCKS)])
O, B, I = 0, 1, 2  # noqa: E741


@dataclass
class Tokens:
    """Byte spans of the tokens, each text's first token, and a feature of every block for each token."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    features: np.ndarray


def tokens(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    starts, ends, first = tk.runs(data, offsets, _TOKEN)
    n = len(starts)
    out = np.zeros((len(_BLOCKS), n), np.int32)
    if not n:
        return Tokens(starts, ends, first, out)

    def count(member: np.ndarray, low=starts, high=ends) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.int32)
        np.cumsum(member, out=total[1:])
        return total[high] - total[low]

    length = ends - starts
    is_digit = _DIGIT[data]
    lower, upper, digit = count(_LOWER[data]), count(_UPPER[data]), count(is_digit)
    sign, wide, hexes = count(_SIGN[data]), count(_WIDE[data]), count(_HEXES[data])
    turns = np.zeros(len(data), bool)
    turns[1:] = is_digit[1:] != is_digit[:-1]
    turned = count(turns, np.minimum(starts + 1, ends))
    kinds = [lower > 0, upper > 0, digit > 0, sign > 0, wide > 0]
    shape = sum(k.astype(np.int32) << i for i, k in enumerate(kinds)) * 8 + np.searchsorted(_LENGTHS, length, "right")
    makeup = np.searchsorted([1, 3, 7], turned, "right") * 16 + np.searchsorted([1, 3, 6], digit, "right") * 4
    makeup += (hexes == length) * 2 + (upper + digit == length)
    text = tk.groups(first)
    begins, closes = np.zeros(n, bool), np.zeros(n, bool)
    full = np.diff(first) > 0
    begins[first[:-1][full]] = True
    closes[first[1:][full] - 1] = True

    def earlier(values: np.ndarray, edge: int) -> np.ndarray:
        moved = np.concatenate([[edge], values[:-1]])
        return np.where(begins, edge, moved)

    gap_low = np.where(begins, offsets[text], np.concatenate([[0], ends[:-1]]))
    gap = sum((count(g[data], gap_low, starts) > 0).astype(np.int32) << i for i, g in enumerate(_GAPS)) + 16 * begins
    gap_high = np.where(closes, offsets[text + 1], np.concatenate([starts[1:], [len(data)]]))
    after = sum((count(g[data], ends, gap_high) > 0).astype(np.int32) << i for i, g in enumerate(_GAPS)) + 16 * closes
    word = (tk.run_hashes(tk.LOWER[data], starts, ends) % np.uint64(_WORDS - 1)).astype(np.int32) + 1
    before = earlier(word, 0)
    size = np.diff(offsets)
    total = np.concatenate([[0], np.cumsum(_DIGIT[data] | _SIGN[data])])
    dense = (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(size, 1)
    file = np.searchsorted([0.02, 0.05, 0.1, 0.2], dense, "right") * 4 + np.searchsorted([200, 1000, 5000], size, "right")
    blocks = [
        shape,
        makeup,
        earlier(shape, 0),
        np.where(closes, 0, np.concatenate([shape[1:], [0]])),
        gap,
        after,
        before,
        earlier(before, 0),
        file[text],
    ]
    for i, block in enumerate(blocks):
        out[i] = block + _STARTS[i]
    return Tokens(starts, ends, first, out)


# ---------------------------------------------------------------- the field


@dataclass
class Model:
    """Weights by feature and tag, transitions, and scores of a text's first tag."""

    weights: np.ndarray
    moves: np.ndarray
    first: np.ndarray

    def unary(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((features.shape[1], 3), np.float32)
        for block in features:
            out += self.weights[block]
        return out

    def tags(self, found: Tokens) -> np.ndarray:
        """The best tags of all tokens."""
        n = len(found.starts)
        out = np.zeros(n, np.int8)
        if not n:
            return out
        scores = self.unary(found.features)
        most = max(self.moves.max(), self.first.max())
        least = min(self.moves.min(), self.first.min())
        free = scores[:, 1:].max(1) + 2 * (most - least) >= scores[:, O]
        if not free.any():
            return out
        begins = np.zeros(n, bool)
        begins[found.first[:-1][np.diff(found.first) > 0]] = True
        ends_text = np.concatenate([begins[1:], [True]])
        opens = free & (begins | ~np.concatenate([[False], free[:-1]]))
        low = np.flatnonzero(opens)
        closes = free & (ends_text | ~np.concatenate([free[1:], [False]]))
        high = np.flatnonzero(closes) + 1
        order = np.argsort(low - high, kind="stable")  # longest first
        low, size = low[order], (high - low)[order]
        entry = np.where(begins[low][:, None], self.first, self.moves[O])
        leave = np.where(ends_text[low + size - 1][:, None], 0.0, self.moves[:, O])
        best = entry + scores[low]
        back = np.zeros((n, 3), np.int8)
        for k in range(1, int(size[0])):
            live = int(np.searchsorted(-size, -k, "left"))
            ways = best[:live, :, None] + self.moves
            back[low[:live] + k] = ways.argmax(1)
            best[:live] = ways.max(1) + scores[low[:live] + k]
        tag = (best + leave).argmax(1).astype(np.int8)
        at = size - 1
        for k in range(int(size[0]) - 1, -1, -1):
            live = at >= k
            out[low[live] + k] = tag[live]
            tag[live] = back[low[live] + k, tag[live]]
        return out


def labels(texts: list[str], data: np.ndarray, offsets: np.ndarray, found: Tokens, places: list | None = None) -> np.ndarray:
    """Tags from the places of secrets, or else from the pattern spans: tokens that the secret itself covers."""
    out = np.zeros(len(found.starts), np.int8)
    for i, text in enumerate(texts):
        known = places[i] if places else None
        for secret, end in [(a, b) for _, _, b, a in pattern_spans(text)] if known is None else known:
            a = offsets[i] + len(text[:secret].encode())
            b = offsets[i] + len(text[:end].encode())
            x, y = np.searchsorted(found.ends, a, "right"), np.searchsorted(found.starts, b, "left")
            if y > x and not out[x:y].any():
                out[x] = B
                out[x + 1 : y] = I
    return out


# ---------------------------------------------------------------- hidden forms

_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_ALPHABETS = [
    _LETTERS + _LETTERS.upper() + "0123456789",
    "0123456789ABCDEF",
    "0123456789abcdef",
    _LETTERS + "0123456789",
    _LETTERS + _LETTERS.upper() + "0123456789+/",
    _LETTERS + _LETTERS.upper() + "0123456789_-",
]
#: Code points of text kept on either side of a secret in a copy that hides it.
AROUND = 300
#: Such copies for each text with a secret.
COPIES = 8


def _made_up(rng: random.Random) -> str:
    """A string of random signs as keys are, some with a short prefix; no pattern finds it by itself."""
    signs = rng.choice(_ALPHABETS)
    size = rng.randint(12, 23) if set(signs) <= set("0123456789abcdef") else rng.randint(12, 44)
    found = "".join(rng.choice(signs) for _ in range(size))
    if not any(c.isdigit() for c in found):
        found = found[:-2] + rng.choice("0123456789") + found[-1]
    if rng.random() < 0.3:
        found = "".join(rng.choice(_LETTERS) for _ in range(rng.randint(2, 4))) + rng.choice("_-") + found
    return found + rng.choice(["", "", "", "="] if "+" in signs else [""])


def _word(rng: random.Random) -> str:
    return "".join(rng.choice(_LETTERS) for _ in range(rng.randint(3, 10)))


def hidden(text: str, rng: random.Random) -> tuple[str, list[tuple[int, int]]] | None:
    """The surroundings of a text's first secret with keyword and value replaced, and where the secret is now.

    The keyword becomes a random word, or nothing; the value a random string. So the field has to learn from shapes and
    surroundings what the patterns know by name.
    """
    found = pattern_spans(text)
    if not found:
        return None
    start, _, end, _ = found[0]
    # The quotes around the old value go with it.
    before, after = text[max(0, start - AROUND) : start].rstrip("\"'`"), text[end : end + AROUND].lstrip("\"'`")
    quote = rng.choice(["", "", '"', "'"])
    lead = rng.choice(["", "", "", f"{_word(rng)} ", f"{_word(rng)}=", f"{_word(rng)}: ", f"{_word(rng)} = ", f"{_word(rng).title()} ", f"{_word(rng)}_{_word(rng)}: "])
    if before and not before[-1].isspace():
        before += " "
    before += lead + quote
    value = _made_up(rng)
    whole = before + value + quote + (after if after[:1].isspace() else " " + after)
    spans = [(a, b) for _, _, b, a in pattern_spans(whole)]
    at = (len(before), len(before) + len(value))
    return whole, sorted([*[(a, b) for a, b in spans if b <= at[0] or a >= at[1]], at])


def decoy(text: str, rng: random.Random) -> str:
    """A piece of the text with something in it that looks odd and is no secret."""
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    made = rng.choice(
        [
            f"https://www.{_word(rng)}.com/{_word(rng)}/{_word(rng)}-{digits(2)}/{_word(rng)}.html",
            f"{_word(rng)}.{_word(rng)}{digits(2)}@{_word(rng)}.org",
            f"20{digits(2)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}",
            f"{_word(rng)}_{_word(rng)}_{_word(rng)}{rng.randint(0, 9)}",
            f"{_word(rng)}{_word(rng).title()}{_word(rng).title()}",
            f"/{_word(rng)}/{_word(rng)}/{_word(rng)}_{digits(1)}.txt",
            f"+{digits(2)} {digits(3)} {digits(7)}",
            f"v{digits(1)}.{digits(2)}.{digits(1)}-{_word(rng)}",
            digits(rng.randint(5, 12)),
            _word(rng) + _word(rng) + _word(rng),
            f"{_word(rng).upper()}-{digits(4)}",
            f"{_word(rng)}={_word(rng)}&{_word(rng)}={digits(2)}",
        ]
    )
    at = rng.randrange(len(text) + 1)
    return f"{text[max(0, at - AROUND) : at]} {made} {text[at : at + AROUND]}"


def with_copies(texts: list[str], seed: int = 7) -> tuple[list[str], list[list[tuple[int, int]] | None]]:
    """The texts, copies that hide their secrets and copies with decoys; and for copies with a hidden secret all secrets'
    places (None: the patterns say)."""
    rng = random.Random(seed)
    out, places = list(texts), [None] * len(texts)
    for text in texts:
        for copy in filter(None, (hidden(text, rng) for _ in range(COPIES))):
            out.append(copy[0])
            places.append(copy[1])
        out.append(decoy(text, rng))
        places.append(None)
    return out, places


def fit(texts: list[str], steps: int = 80, ridge: float = 5e-5, rate: float = 0.15) -> Model | None:
    """Weights that maximise the likelihood of the tags, by Adam; none if no text has a pattern span.

    Pattern spans are secrets, and so are the values in copies of their surroundings that no pattern finds.
    """
    texts, places = with_copies(texts)
    parts, tagged, done = [], [], 0
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])
    for part in tk.slices(batch, "text", SLICE_BYTES):
        data, offsets = tk.texts(part.column("text"))
        parts.append(tokens(data, offsets))
        held = part.column("text").to_pylist()
        tagged.append(labels(held, data, offsets, parts[-1], places[done : done + len(held)]))
        done += len(held)
    if not parts:
        return None
    tags = np.concatenate(tagged)
    features = np.concatenate([p.features for p in parts], axis=1)
    borders = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p.first) for p in parts]))])
    if not tags.any():
        return None
    chunks, begins = [], set(borders[:-1].tolist())
    for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
        chunks += [(x, min(x + CHUNK, b)) for x in range(a, b, CHUNK)]
    totals = np.concatenate([[0], np.cumsum(tags > 0)])
    chunks = sorted(chunks, key=lambda c: (totals[c[1]] == totals[c[0]], c[0] * 2654435761 % 4294967296))[:CHUNKS]
    at = np.array([a for a, _ in chunks])[:, None] + np.arange(CHUNK)
    inside = at < np.array([b for _, b in chunks])[:, None]
    at = np.minimum(at, len(tags) - 1)
    starts_text = np.array([a in begins for a, _ in chunks])
    gold = np.where(inside, tags[at], 0)
    feats = features[:, at[inside]]
    del features, parts
    where = np.cumsum(inside.ravel()).reshape(inside.shape) - 1
    n_features = int(_STARTS[-1])
    model = Model(np.zeros((n_features, 3)), np.zeros((3, 3)), np.zeros(3))
    states = [np.zeros_like(p) for p in (model.weights, model.moves, model.first) for _ in (0, 1)]
    count = len(chunks)
    for step in range(1, steps + 1):
        scores = np.zeros((feats.shape[1], 3))
        for block in feats:
            scores += model.weights[block]
        u = np.where(inside[:, :, None], scores[np.maximum(where, 0)], 0.0)
        alpha = np.zeros((CHUNK, count, 3))
        alpha[0] = u[:, 0] + np.where(starts_text[:, None], model.first, 0.0)
        for k in range(1, CHUNK):
            step_in = np.logaddexp.reduce(alpha[k - 1][:, :, None] + model.moves, axis=1) + u[:, k]
            alpha[k] = np.where(inside[:, k, None], step_in, alpha[k - 1])
        beta = np.zeros((count, 3))
        norm = np.logaddexp.reduce(alpha[-1], axis=1)
        node = np.zeros((CHUNK, count, 3))
        moves = np.zeros((3, 3))
        for k in range(CHUNK - 1, -1, -1):
            node[k] = np.exp(alpha[k] + beta - norm[:, None]) * inside[:, k, None]
            if k:
                pair = alpha[k - 1][:, :, None] + model.moves + (u[:, k] + beta)[:, None, :] - norm[:, None, None]
                live = inside[:, k]
                moves += np.exp(pair[live]).sum(0)
                moves -= np.bincount(gold[live, k - 1] * 3 + gold[live, k], minlength=9).reshape(3, 3)
                new = np.logaddexp.reduce(model.moves + (u[:, k] + beta)[:, None, :], axis=2)
                beta = np.where(live[:, None], new, beta)
        slope = node.transpose(1, 0, 2)[inside]
        slope[np.arange(len(slope)), gold[inside]] -= 1
        weights = np.stack(
            [sum(np.bincount(block, slope[:, t], n_features) for block in feats) for t in range(3)], axis=1
        )
        first = node[0][starts_text].sum(0) - np.bincount(gold[starts_text, 0], minlength=3)
        gradients = [weights / count + ridge * model.weights, moves / count + ridge * model.moves, first / count]
        for i, (p, g) in enumerate(zip((model.weights, model.moves, model.first), gradients)):
            states[2 * i] = 0.9 * states[2 * i] + 0.1 * g
            states[2 * i + 1] = 0.99 * states[2 * i + 1] + 0.01 * g * g
            p -= rate * (states[2 * i] / (1 - 0.9**step)) / (np.sqrt(states[2 * i + 1] / (1 - 0.99**step)) + 1e-8)
    return Model(model.weights.astype(np.float32), model.moves, model.first)


def train(documents: DataFrame, text: str = "text", sample: int = SAMPLE) -> Model | None:
    """Fit on about ``sample`` texts at most: half of them at random, the rest those with a keyword or access key
    among ``SEARCHED`` times as many. None without any text that has a pattern span.
    """
    keys = [F.col(f"`{c}`") for c in documents.columns if c in ("doc_id", text)]
    half = sample // 2
    lowered = F.lower("text")
    likely = F.col("text").contains("AKIA")
    for word in KEYWORDS:
        likely = likely | lowered.contains(word)
    named = [F.xxhash64(*keys).alias("place"), F.col(f"`{text}`").cast("string").alias("text")]
    rows = documents.select(*named)
    # The searched rows are filtered where they stand; what leaves a task is a few of them.
    total = rows.count()
    low = F.pmod("place", F.lit(1 << 40))
    searched = rows.where(low < int((1 << 40) * min(1.0, SEARCHED * half / max(total, 1))))
    # The least hashes of all marked rows: neither files nor their order decide.
    marked = searched.where(likely).orderBy("place").limit(sample).select("text")
    plain = bounded_sample(rows, half, ["place"]).where("text is not null").select("text")
    chosen = marked.unionAll(plain).repartition(1)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = sorted({t for batch in batches for t in batch.column("text").to_pylist() if t})
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(texts))], pa.binary())], ["model"])

    found = chosen.mapInArrow(tidy(learn), "model binary").collect()
    return pickle.loads(found[0].model) if found else None


# ---------------------------------------------------------------- spans


def all_spans(column: pa.Array, model: Model | None) -> list[list[tuple[int, int, int]]]:
    """Start, kind and end (in code points) of every text's spans, by start and kind.

    Spans of the field that touch a pattern span are left out: that one stays as it is.
    """
    texts = [t or "" for t in column.to_pylist()]
    spans = [[(a, kind, b) for a, kind, b, _ in pattern_spans(t)] for t in texts]
    if model is None:
        return spans
    data, offsets = tk.texts(column)
    found = tokens(data, offsets)
    tags = model.tags(found)
    marked = np.flatnonzero(tags)
    if not len(marked):
        return spans
    text = np.searchsorted(found.first, marked, "right") - 1
    opens = np.ones(len(marked), bool)
    opens[1:] = (tags[marked[1:]] == B) | (marked[1:] != marked[:-1] + 1) | (text[1:] != text[:-1])
    low = np.flatnonzero(opens)
    high = np.concatenate([low[1:], [len(marked)]]) - 1
    for i, a, b in zip(text[low].tolist(), found.starts[marked[low]].tolist(), found.ends[marked[high]].tolist()):
        raw = data[offsets[i] : offsets[i + 1]]
        start = len(raw[: a - offsets[i]].tobytes().decode())
        end = start + len(raw[a - offsets[i] : b - offsets[i]].tobytes().decode())
        if all(end <= x or y <= start for x, _, y in spans[i]):
            spans[i].append((start, 3, end))
    return [sorted(own) for own in spans]


SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
)


def with_spans(documents: DataFrame, model: Model | None, text: str = "text") -> tuple[DataFrame, str]:
    """All columns of ``documents`` with ``spans``, an array of (kind, start, end); and that column's name.

    Offsets count code points, ends are exclusive. Null and empty texts have none. The added column takes
    underscores where its name is taken. Repeated rows get equal results, of equally good tags the first in the order
    outside, begin, inside. Texts of any length are scanned whole; an empty table stays empty.
    """
    name = fresh_name("spans", documents.columns)
    schema = T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in documents.schema.fields]
        + [T.StructField(name, T.ArrayType(SPAN), True)]
    )
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tk.slices(batch, text, SLICE_BYTES):
                found = all_spans(part.column(text), shared.value)
                flat = [s for own in found for s in own]
                borders = np.concatenate([[0], np.cumsum([len(own) for own in found], dtype=np.int64)])
                values = pa.StructArray.from_arrays(
                    [
                        pa.array([KINDS[k] for _, k, _ in flat], pa.string()),
                        pa.array([a for a, _, _ in flat], pa.int64()),
                        pa.array([b for _, _, b in flat], pa.int64()),
                    ],
                    ["kind", "start", "end"],
                )
                yield pa.RecordBatch.from_arrays([*part.columns, list_array(values, borders)], [*part.schema.names, name])

    return documents.mapInArrow(tidy(scan), schema), name


def redacted(documents: DataFrame, model: Model | None, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span of their texts replaced by ``mark``; overlapping spans become one."""
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in documents.schema.fields])
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def clean(value: str, spans: list[tuple[int, int, int]]) -> str:
        pieces, at = [], 0
        for start, _, end in spans:
            if start >= at:
                pieces += [value[at:start], mark]
            at = max(at, end)
        return "".join([*pieces, value[at:]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tk.slices(batch, text, SLICE_BYTES):
                column = part.column(text)
                found = all_spans(column, shared.value)
                if any(found):
                    texts = [clean(t, s) if s else t for t, s in zip(column.to_pylist(), found)]
                    part = part.set_column(part.schema.names.index(text), text, pa.array(texts, column.type))
                yield part

    return documents.mapInArrow(tidy(scan), schema)
