"""Thin queries over whole tables, and their DuckDB equivalents where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, exact_dedup, jaccard, line_dedup, mixing, packing, quality, secrets, spelling, suffix_dedup, suffix_tree, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
        F.array_join("near_items", ",").alias("near_items"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"),
    )


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(_table(spark, sf_dir, "documents"), keep="max")
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    log = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.read_back(chat.format_conversations(log.withColumnRenamed("turn", "seq")))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, sf_dir, "documents"), every=True)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, sf_dir, "documents"))

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*[r.kind for r in secrets.BASE_RULES]))
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def op11_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.scored(_table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_pack": op2_pack,
    "op3_quality": op3_quality,
    "op4_mix": op4_mix,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_chat": op7_chat,
    "op8_line_dedup": op8_line_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_secret_scan": op10_secret_scan,
    "op11_suffix_tree": op11_suffix_tree,
    "op12_spelling": op12_spelling,
    "op13_whitening": op13_whitening,
}

#: A-Z to a-z only.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Proximity in SQL: five starts around each place of a window's rarest word, kept if each word stands within two places of its own.
_OP1 = rf"""
WITH docs AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS MATERIALIZED (
  SELECT row_number() OVER () AS q, len(k) AS n, k, ids FROM (
    SELECT k, list(DISTINCT CAST(item_id AS VARCHAR)) AS ids
    FROM (SELECT item_id, w[i : i + least(10, len(w)) - 1] AS k FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM items WHERE len(w) > 0)) GROUP BY k)),
terms AS MATERIALIZED (SELECT q, unnest(k) AS t, unnest(generate_series(0, n - 1)) AS o FROM windows),
places AS MATERIALIZED (SELECT r, p, t FROM (SELECT r, unnest(w) AS t, unnest(generate_series(1, len(w))) AS p FROM docs) WHERE t IN (SELECT t FROM terms)),
often AS (SELECT t, count(*) AS c FROM places GROUP BY t),
rare AS (SELECT q, arg_min(t, (c, o)) AS t, arg_min(o, (c, o)) AS o FROM terms JOIN often USING (t) GROUP BY q),
starts AS MATERIALIZED (SELECT DISTINCT q, r, p - o + d AS s FROM rare JOIN places USING (t), (SELECT unnest([-2, -1, 0, 1, 2]) AS d)),
kept AS MATERIALIZED (
  SELECT s.q, s.r, s.s, count(DISTINCT x.o) AS near, count(DISTINCT x.o) FILTER (y.p = s.s + x.o) AS exact
  FROM starts s JOIN terms x ON x.q = s.q JOIN places y ON y.r = s.r AND y.t = x.t AND y.p BETWEEN s.s + x.o - 2 AND s.s + x.o + 2 GROUP BY ALL),
hits AS MATERIALIZED (SELECT r, s, n, ids FROM kept JOIN windows USING (q) WHERE exact = n),
marked AS MATERIALIZED (SELECT DISTINCT r, unnest(generate_series(s, s + n - 1)) AS p FROM hits),
spans AS (SELECT r, string_agg(a || ':' || b, ',' ORDER BY a) AS spans FROM (SELECT r, min(p) - 1 AS a, max(p) AS b FROM (SELECT r, p, p - row_number() OVER (PARTITION BY r ORDER BY p) AS g FROM marked) GROUP BY r, g) GROUP BY r),
words AS (SELECT r, count(*) AS n_hit FROM marked GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, unnest(ids) AS id FROM hits) GROUP BY r),
beside AS (SELECT r, count(*) AS n_near, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, unnest(ids) AS id FROM kept JOIN windows USING (q) WHERE near = n) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(found.ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  CAST(coalesce(n_near, 0) AS BIGINT) AS n_near_items, coalesce(beside.ids, '') AS near_items, coalesce(spans.spans, '') AS spans
FROM docs d LEFT JOIN words USING (r) LEFT JOIN found USING (r) LEFT JOIN beside USING (r) LEFT JOIN spans USING (r)"""

_OP5 = f"""
WITH t AS (SELECT doc_id, {_LOWER} AS x FROM documents),
g AS (SELECT doc_id, x, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size FROM t)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(x) AS text_sha256 FROM g"""

_OP7 = r"""
WITH log AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
g AS (
  SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    CAST(sum(14 + length(regexp_replace(role, '([\\#<:])', '\\\1', 'g')) + length(regexp_replace(text, '([\\#<])', '\\\1', 'g'))) AS BIGINT) AS formatted_chars
  FROM log GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g"""

_OP9 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.doc_id),
least_of AS (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_of l ON l.doc_id = d.doc_id"""

_ANY_CASE = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "(password|passwd|secret|token|api_?key)")
_ASSIGN = _ANY_CASE + r"""[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)"""
_KINDS = [
    ("assign", _ASSIGN, 12, 2),
    ("access", "AKIA[A-Z0-9]+", 18, 0),
    ("hex", "[0-9a-f]+", 16, 0),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("forge", "gh[opsu]_[A-Za-z0-9]+", 40, 0),
    ("bearer", "[Bb]earer [A-Za-z0-9._~+/-]+", 27, 0),
]
_OP10_PART = """
  SELECT doc_id, {k} AS k, '{kind}' AS kind, a, a + length(m) AS b FROM (
    SELECT doc_id, m, length(regexp_extract(m, '{pattern}', {group})) AS size,
      sum(length(p)) OVER (PARTITION BY doc_id ORDER BY i) + coalesce(sum(length(m)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
    FROM (SELECT doc_id, unnest(ms) AS m, unnest(ps[1 : len(ms)]) AS p, unnest(generate_series(1, len(ms))) AS i
      FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS ps FROM t) WHERE len(ms) > 0))
  WHERE size >= {least}"""
_OP10 = (
    "WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),\ns AS ("
    + " UNION ALL ".join(_OP10_PART.format(k=k, kind=kind, pattern=p, least=n, group=g) for k, (kind, p, n, g) in enumerate(_KINDS))
    + """),
g AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT), ',' ORDER BY a, k) FILTER (k < 3) AS base,
    string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT), ',' ORDER BY a, k) AS spans FROM s GROUP BY doc_id)
SELECT t.doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN g ON t.doc_id = g.doc_id"""
)

#: The checksum is made byte by byte from its table; words with one place left out meet as texts.
_OP12 = r"""
WITH RECURSIVE slots AS (SELECT CAST(i AS BIGINT) AS i FROM range(256) t(i)),
crc_table AS (SELECT list(list_reduce([i] || range(8)::BIGINT[], lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) ORDER BY i) AS t FROM slots),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), 'null') AS doc, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents) GROUP BY ALL),
bytes AS (
  SELECT doc, run, n, flatten(list_transform(string_split(doc || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END)) AS b FROM runs),
sums AS (
  SELECT doc, run, n, xor(list_reduce([4294967295::BIGINT] || b, lambda a, x: xor(a // 256, t[(xor(a, x) % 256) + 1])), 4294967295) AS h FROM bytes, crc_table),
said AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM sums),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM said WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT word, n, i, left(word, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM words)),
pairs AS (
  SELECT x.word, y.word AS other, y.n AS m FROM cut x JOIN cut y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, w.word, w.n FROM cut x JOIN words w ON x.a || x.b = w.word
  UNION SELECT w.word, x.word, x.n FROM cut x JOIN words w ON x.a || x.b = w.word),
best AS (SELECT word, count(*) AS n_near, min({'m': -m, 'w': encode(other)}) AS b FROM pairs GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.m >= 5 * w.n THEN decode(b.w) END AS form, CASE WHEN -b.m >= 5 * w.n THEN -b.m END AS form_n
  FROM words w LEFT JOIN best ON w.word = best.word),
led AS (SELECT word, form AS at FROM formed WHERE form IS NOT NULL UNION ALL SELECT l.word, f.form FROM led l JOIN formed f ON f.word = l.at WHERE f.form IS NOT NULL),
ends AS (SELECT l.word, l.at FROM led l JOIN formed f ON f.word = l.at WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(e.at, f.word) AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n FROM formed f LEFT JOIN ends e ON e.word = f.word"""

SQL: dict[str, str] = {"op1_decontaminate": _OP1, "op5_exact_dedup": _OP5, "op7_chat": _OP7, "op9_jaccard_join": _OP9, "op10_secret_scan": _OP10, "op12_spelling": _OP12}
