"""Registered queries of the corpus operators, each next to its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapgrid.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship_package(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_near_dedup",
    r"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN w ELSE list_slice(w, i, i + 4) END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 85 * (a.n + b.n - k)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, e.y FROM reach JOIN e ON e.x = reach.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT documents.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, documents.doc_id = component_id AS kept
FROM documents JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)""",
)
def _near_dedup(spark, sf_dir):
    from snapgrid.llm.near_dedup import Settings, near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), Settings(percent=85))


@query("op2_lz_fingerprint")
def _lz_fingerprint(spark, sf_dir):
    from snapgrid.llm.lz_fingerprint import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


def _span_list(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op3_secret_scan")
def _secret_scan(spark, sf_dir):
    from snapgrid.llm.secret_crf import train, with_spans

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows, _ = with_spans(documents, train(documents))
    kinds = ["assign", "access", "hex"]

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in kinds]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return rows.select(
        "doc_id", *counts, F.sha2(_span_list(base), 256).alias("base_sha256"), _span_list(F.col("spans")).alias("spans")
    )


@query("op5_sharding")
def _sharding(spark, sf_dir):
    from snapgrid.llm.minimax_shards import sharded

    placed = sharded(table(spark, sf_dir, "documents"), 8)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@query("op6_quality")
def _quality(spark, sf_dir):
    from snapgrid.llm.ordinal_quality import graded, rated, train

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(documents, rated(table(spark, sf_dir, "labels")))
    rows, _ = graded(documents, model)
    return rows.select("doc_id", "expected_grade", "tail", (F.col("tail") >= 0.5).alias("kept"))


@query(
    "op7_decontamination",
    r"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, list_slice(w, i, i + least(len(w), 10) - 1) AS win
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
s AS (SELECT doc_id, m, i, list_slice(w, i, i + m - 1) AS win
      FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
            FROM d, (SELECT DISTINCT m FROM p) WHERE len(w) >= m)),
o AS (SELECT s.doc_id, s.i, p.m, p.item_id FROM s JOIN p ON s.m = p.m AND s.win = p.win),
h AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS pos FROM o) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
      FROM (SELECT DISTINCT doc_id, item_id FROM o) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.ids, '')) AS items_sha256, h.n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""",
)
def _decontamination(spark, sf_dir):
    from snapgrid.llm.wu_manber import find_items

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = find_items(documents, table(spark, sf_dir, "benchmark")).rows
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        F.col("hits").isNotNull().alias("contaminated"),
    )


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op8_packing")
def _packing(spark, sf_dir):
    from snapgrid.llm.window_packing import Settings, packed

    return packed(table(spark, sf_dir, "documents"), Settings(_tokenizer()))


@query("op9_language_id")
def _language_id(spark, sf_dir):
    from snapgrid.llm.ppm_language import predictions, train

    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    found = predictions(documents, train(documents.where(fold != 1)))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits")


@query("op10_license_scan")
def _license_scan(spark, sf_dir):
    from snapgrid.llm.license_bands import license_summary

    return license_summary(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op4_html_extraction")
def _html_extraction(spark, sf_dir):
    from snapgrid.llm.html_region import extracted, train

    pages = table(spark, sf_dir, "pages")
    return extracted(pages, train(pages))


@query(
    "op11_quality_rules",
    r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
           FROM documents),
n AS (SELECT row_number() OVER () AS r, * FROM d),
v AS (SELECT r, i, list_slice(w, i, i + 4) AS win FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM n)),
two AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM v) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT pos) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 5)) AS pos FROM two) GROUP BY r),
m AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
             len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS n_letter_words,
             length(regexp_replace(t, '\P{L}', '', 'g')) AS n_letters, length(regexp_replace(t, '\P{Lu}', '', 'g')) AS n_capitals
      FROM n LEFT JOIN rep USING (r)),
b AS (SELECT *, CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
             + CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
             + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END
             + CASE WHEN 100 * n_letter_words < 80 * n_words THEN 64 ELSE 0 END
             + CASE WHEN n_letters >= 40 AND 100 * n_capitals > 50 * n_letters THEN 128 ELSE 0 END AS bits FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       bits & 3 > 0 AS base_failed, bits = 0 AS kept, CAST(bits AS BIGINT) AS failed_rules, 'web-v2' AS policy
FROM b""",
)
def _quality_rules(spark, sf_dir):
    from snapgrid.llm.rule_ledger import BASE, latest, ledger

    policy = latest("web")
    rows, name = ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    bits = F.col(f"{name}.bits")
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select(
        "doc_id",
        *[f"{name}.{m}" for m in measures],
        (~BASE.keeps(bits)).alias("base_failed"),
        (BASE.keeps(bits) & policy.keeps(bits)).alias("kept"),
        bits.alias("failed_rules"),
        F.lit(policy.label).alias("policy"),
    )


def _crc_table() -> str:
    """The 256 values of the byte-wise checksum, as a list in a table ``t``."""
    step = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"
    inner = "(SELECT n, CAST(n AS BIGINT) AS v0 FROM range(256) s(n))"
    for i in range(1, 8):
        inner = f"(SELECT n, {step.format(f'v{i - 1}')} AS v{i} FROM {inner})"
    return f"t AS (SELECT list(v8 ORDER BY n) AS tab FROM (SELECT n, {step.format('v7')} AS v8 FROM {inner}))"


_CRC_TABLE = _crc_table()


def _crc(text: str) -> str:
    """The checksum of an ASCII text, where the table ``t`` is at hand."""
    signs = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {signs}), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295)"


def _manifest_sql(levels: int = 12, fan: int = 3) -> str:
    """The tree of every source, then the tree over the sources, level by level, for up to 3 ** levels rows each."""

    def grown(name: str, leaves: str, key: str) -> str:
        parts = [f"{name}0 AS ({leaves})"]
        for i in range(levels):
            # A tree with one node stays; the others are combined in runs.
            parts.append(
                f"{name}run{i} AS (SELECT {key}, r // {fan} AS up, list(h ORDER BY r) AS hs FROM {name}{i} GROUP BY ALL)"
            )
            parts.append(
                f"{name}{i + 1} AS (SELECT {key}, up AS r, CASE WHEN count(*) OVER (PARTITION BY {key}) = 1 AND len(hs) = 1 "
                f"THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {name}run{i})"
            )
        return ",\n".join(parts)

    def climbed(name: str, start: str, key: str) -> str:
        parts = [f"{name}up0 AS ({start})"]
        for i in range(levels):
            step = f"(x.r % {fan})"
            parts.append(
                f"{name}up{i + 1} AS (SELECT x.* REPLACE (x.r // {fan} AS r, "
                f"CASE WHEN len(hs) = 1 AND one THEN x.f ELSE sha256(array_to_string(hs[:{step}], '') || x.f || array_to_string(hs[{step} + 2:], '')) END AS f, "
                f"x.p || array_to_string(hs[:{step}], '') || array_to_string(hs[{step} + 2:], '') AS p) "
                f"FROM {name}up{i} x JOIN (SELECT *, count(*) OVER (PARTITION BY {key}) = 1 AS one FROM {name}run{i}) y "
                f"ON x.{key} = y.{key} AND x.r // {fan} = y.up)"
            )
        return ",\n".join(parts)

    def leaf(text: str) -> str:
        columns = ["doc_id", "source", "lang", "n_chars", text]
        return "sha256(" + " || ".join(
            f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c} END" for c in columns
        ) + ")"

    return f"""WITH {_CRC_TABLE},
crc AS (SELECT doc_id, {_crc("CAST(doc_id AS VARCHAR)")} AS c FROM (SELECT DISTINCT doc_id FROM documents), t),
d AS (SELECT documents.*, replace(text, chr(10), '') AS cut, c FROM documents LEFT JOIN crc USING (doc_id)),
e AS (SELECT doc_id, source, {leaf("text")} AS h, CASE WHEN c % 2 = 0 THEN {leaf("cut")} ELSE {leaf("text")} END AS f FROM d),
l AS (SELECT *, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS s,
             row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS r FROM e),
{grown("a", "SELECT s, r, h FROM l", "s")},
{grown("b", f"SELECT 0 AS k, s AS r, h FROM a{levels}", "k")},
{climbed("a", "SELECT l.*, '' AS p FROM l", "s")},
{climbed("b", f"SELECT s AS r, f, p, 0 AS k, doc_id, h AS leaf, (SELECT h FROM a{levels} z WHERE z.s = q.s) AS subroot FROM aup{levels} q", "k")}
SELECT doc_id, leaf, subroot, (SELECT h FROM b{levels}) AS root, sha256(p) AS proof_sha256, f AS folded_root,
       f = (SELECT h FROM b{levels}) AS verified FROM bup{levels}"""


@query("op12_merkle_manifest", _manifest_sql())
def _merkle_manifest(spark, sf_dir):
    from snapgrid.llm.merkle_manifest import FIELDS, folded, hex_of, leaf_digest, manifest, proofs, siblings

    documents = table(spark, sf_dir, "documents")
    fields = [F.col(f) for f in FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    changed = F.when(tampered, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = documents.select(
        "source", "doc_id", leaf_digest(fields).alias("leaf"), F.unhex(leaf_digest([*fields[:-1], changed])).alias("shown")
    )
    found = proofs(manifest(rows))
    out = found.select(
        "doc_id",
        *[hex_of(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        folded(hex_of(F.col("shown")), F.col("path")).alias("folded_root"),
    )
    return out.select("*", (F.col("folded_root") == F.col("root")).alias("verified"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage, and those it drops, marked by ``dropped``."""
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(":") for c in ("conv_id", ":", "turn")])
    marked = conversations.select("conv_id", "turn", "role", "text", (F.crc32(key) % 20).alias("fault"))
    fault, text = F.col("fault"), F.col("text")
    times = F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1)))
    changed = F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(fault == 4, F.lit("user")).otherwise(F.col("role"))
    return marked.select(
        "conv_id", "turn", role.alias("role"), changed.alias("text"), (fault == 0).alias("dropped"), times.alias("_copy")
    ).drop("_copy")


def _repair_sql() -> str:
    """Cheapest edits by recursion over a conversation's rows: for each way the repaired part can end (0 empty, 1 system,
    2 user, 3 assistant) the least (cost, audit), and the turns made so far."""
    after, names = {0: 2, 1: 2, 2: 3, 3: 2}, {2: "user", 3: "assistant"}
    keeps = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    base = [(w, "D", "-", w, 2, None) for w in range(4)] + [(w, "R", "-", after[w], 1, names[after[w]]) for w in range(4)]
    base += [(w, "K", initial, to, 0, "") for (w, initial), to in keeps.items()]
    moves, starts = [], []
    for w, edit, initial, to, cost, role in base:
        added = []
        for k in range(3):
            turns = "[" + ", ".join(f"'{a}'" for a in added) + "]::VARCHAR[]"
            own = "NULL" if role is None else f"'{role}'"
            moves.append(f"({w}, '{edit}', '{initial}', {to}, {cost + 5 * k}, '{edit + 'I' * k}', {own}, {turns})")
            if w == 0 and edit == "D":
                starts.append(f"SELECT conv_id, 0, {to}, {5 * k}, '{'I' * k}', {turns} FROM (SELECT DISTINCT conv_id FROM r)")
            to = after[to]
            added.append(f"{names[to]}:")
    return rf"""WITH RECURSIVE {_CRC_TABLE},
k AS (SELECT *, {_crc("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS f FROM conversations, t),
d AS (SELECT conv_id, turn, coalesce(CASE WHEN f = 4 THEN 'user' ELSE role END, ' ') AS role,
             coalesce(CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END, ' ') AS text,
             unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy FROM k WHERE f <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
q AS (SELECT *, left(role, 1) AS c, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
             regexp_matches(text, '[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z') AS cut FROM o),
r AS (SELECT *, blank OR again AS gone, NOT blank AND NOT again AND cut AS stump,
             lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS pair FROM q),
m(w, edit, c, too, price, audit, own, added) AS (VALUES {", ".join(moves)}),
st(conv_id, i, w, best) AS (
  SELECT conv_id, 0, w, struct_pack(cost := cost, audit := audit, turns := turns)
  FROM ({" UNION ALL ".join(starts)}) AS s(conv_id, i0, w, cost, audit, turns)
  UNION ALL
  SELECT conv_id, i, w, min(best) FROM (
    SELECT r.conv_id, r.i, m.too AS w, struct_pack(cost := st.best.cost + m.price + CASE WHEN m.edit <> 'D' AND r.stump THEN 5 ELSE 0 END,
           audit := st.best.audit || m.audit,
           turns := list_concat(st.best.turns, CASE WHEN m.own IS NULL THEN []::VARCHAR[]
             WHEN m.own = '' THEN [r.role || ':' || r.text] ELSE [m.own || ':' || r.text] END, m.added)) AS best
    FROM st JOIN r ON r.conv_id IS NOT DISTINCT FROM st.conv_id AND r.i = st.i + 1
    JOIN m ON m.w = st.w AND (m.c = '-' OR m.c = r.c) AND (m.edit = 'D' OR NOT r.gone)) AS options
  GROUP BY conv_id, i, w),
n AS (SELECT conv_id, count(*) AS n, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
             count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate, count(*) FILTER (stump) AS truncated,
             count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
e AS (SELECT st.conv_id, min(best) AS best FROM st JOIN n ON n.conv_id IS NOT DISTINCT FROM st.conv_id AND st.i = n.n WHERE w IN (0, 3) GROUP BY st.conv_id)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(n.blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit,
       sha256(coalesce(array_to_string(best.turns, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM a.conv_id"""


@query("op13_conversation_repair", _repair_sql())
def _conversation_repair(spark, sf_dir):
    from snapgrid.llm.turn_repair import repairs

    return repairs(damaged(table(spark, sf_dir, "conversations")), absent=F.col("dropped"))
