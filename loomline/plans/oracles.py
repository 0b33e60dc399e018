"""DuckDB equivalents of the engine's queries."""

from __future__ import annotations

from ..functions.vocabulary import META_VERBS, POLICY_KEYWORDS
from ..operators import representations

_KEY = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"
_COLLAPSE = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"

_SEGMENTS = """seg AS (SELECT conv_id, turn, text, role, turn * 10.0 AS s, turn * 10.0 + 10.0 AS e, length(text) + 1 AS c,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations WHERE regexp_matches(text, '\\S'))"""
#: Budget packing: state is the first member of the open chunk and its sum; the overlap is the last two members, or the last one of two.
_CHUNKS = f"""WITH RECURSIVE {_SEGMENTS},
scan AS (
  SELECT conv_id, i, CAST(1 AS BIGINT) AS first, CAST(c AS BIGINT) AS sum, CAST(0 AS BIGINT) AS chunk, CAST(NULL AS BIGINT) AS closed_first FROM seg WHERE i = 1
  UNION ALL
  SELECT n.conv_id, n.i,
    CASE WHEN s.sum + n.c > 1800 THEN n.i - CASE WHEN s.i - s.first + 1 > 2 THEN 2 ELSE 1 END ELSE s.first END,
    CASE WHEN s.sum + n.c > 1800 THEN n.c + p.c + CASE WHEN s.i - s.first + 1 > 2 THEN q.c ELSE 0 END ELSE s.sum + n.c END,
    CASE WHEN s.sum + n.c > 1800 THEN s.chunk + 1 ELSE s.chunk END, CASE WHEN s.sum + n.c > 1800 THEN s.first END
  FROM scan s JOIN seg n ON n.conv_id = s.conv_id AND n.i = s.i + 1 JOIN seg p ON p.conv_id = s.conv_id AND p.i = s.i LEFT JOIN seg q ON q.conv_id = s.conv_id AND q.i = s.i - 1),
cuts AS (SELECT conv_id, chunk, max(first) AS a, max(i) AS b FROM scan GROUP BY conv_id, chunk),
members AS (SELECT c.conv_id, c.chunk, g.* EXCLUDE (conv_id) FROM cuts c JOIN seg g ON g.conv_id = c.conv_id AND g.i BETWEEN c.a AND c.b),
spk AS (SELECT conv_id, chunk, string_agg(role, ',' ORDER BY f) AS speakers, count(*) AS n FROM (SELECT conv_id, chunk, role, min(i) AS f FROM members GROUP BY ALL) GROUP BY ALL)"""
_CLOCK = "printf('%02d:%02d:%02d', CAST(floor({0} / 3600) AS BIGINT), CAST(floor(({0} % 3600) / 60) AS BIGINT), CAST(floor({0}) AS BIGINT) % 60)"

SQL: dict[str, str] = {}

SQL["leaf_chunks"] = f"""{_CHUNKS}
SELECT CAST(m.conv_id AS VARCHAR) AS episode_id, m.chunk, CAST(min(s) AS DOUBLE) AS start_time, CAST(max(e) AS DOUBLE) AS end_time, CASE WHEN max(n) = 1 THEN max(speakers) ELSE '' END AS speaker,
  CASE WHEN max(n) = 1 THEN 'single' ELSE 'multi' END AS speaker_scope, count(*) AS segment_count,
  string_agg('[' || role || ' ' || {_CLOCK.format("s")} || '-' || {_CLOCK.format("e")} || '] ' || text, chr(10) ORDER BY i) AS page_content
FROM members m JOIN spk k ON k.conv_id = m.conv_id AND k.chunk = m.chunk GROUP BY m.conv_id, m.chunk"""
SQL["leaf_chunk_evidence"] = f"""{_CHUNKS}
SELECT CAST(m.conv_id AS VARCHAR) AS episode_id, m.chunk, string_agg(m.conv_id || ':segment:' || turn, ',' ORDER BY i) AS segment_ids, max(speakers) AS speakers, CAST(20260101 AS BIGINT) AS episode_sort_key
FROM members m JOIN spk k ON k.conv_id = m.conv_id AND k.chunk = m.chunk GROUP BY m.conv_id, m.chunk"""
SQL["chunk_sizes"] = f"{_CHUNKS} SELECT b - a + 1 AS segment_count, count(*) AS chunks FROM cuts GROUP BY 1"
SQL["rollup_headers"] = f"""{_CHUNKS}
SELECT 'leaf-' || m.conv_id || '-' || m.chunk AS node_id, '[node_id=leaf-' || m.conv_id || '-' || m.chunk || ' | type=leaf_chunk | level=leaf | episode_date=2026-01-01 | speaker_scope=' || CASE WHEN max(n) = 1 THEN 'single' ELSE 'multi' END ||
  ' | speakers=' || replace(max(speakers), ',', ', ') || ' | time=' || {_CLOCK.format("min(s)")} || '-' || {_CLOCK.format("max(e)")} || ']' AS header
FROM members m JOIN spk k ON k.conv_id = m.conv_id AND k.chunk = m.chunk GROUP BY m.conv_id, m.chunk"""
#: Leaves of ten conversations an episode, in one run of time.
_LEAVES = _CHUNKS.replace(_SEGMENTS, """seg AS (SELECT 'e' || (conv_id // 10) AS conv_id, turn, text, role, (conv_id * 1000 + turn) * 10.0 AS s, (conv_id * 1000 + turn) * 10.0 + 10.0 AS e, length(text) + 1 AS c,
    row_number() OVER (PARTITION BY conv_id // 10 ORDER BY conv_id * 1000 + turn) AS i FROM conversations WHERE regexp_matches(text, '\\S'))""")
_LEAVES += """,
leaves AS (SELECT m.conv_id AS episode_id, m.chunk, CAST(min(s) AS DOUBLE) AS s, CAST(max(e) AS DOUBLE) AS e, CASE WHEN max(n) = 1 THEN max(speakers) ELSE '' END AS speaker
  FROM members m JOIN spk k ON k.conv_id = m.conv_id AND k.chunk = m.chunk GROUP BY ALL)"""
SQL["hierarchy_groups"] = f"""{_LEAVES}
SELECT episode_id, grp, count(*) AS nodes, min(s) AS start_time, max(e) AS end_time FROM (SELECT *, (row_number() OVER (PARTITION BY episode_id ORDER BY s) - 1) // 6 AS grp FROM leaves) GROUP BY episode_id, grp"""
SQL["speaker_first_groups"] = f"""{_LEAVES}, parts AS (SELECT *, (row_number() OVER (PARTITION BY episode_id, speaker ORDER BY s) - 1) // 6 AS part FROM leaves)
SELECT episode_id, grp, count(*) AS nodes, max(speaker) AS speaker FROM (SELECT *, dense_rank() OVER (PARTITION BY episode_id ORDER BY speaker, part) - 1 AS grp FROM parts) GROUP BY episode_id, grp"""
SQL["speaker_scope"] = """
WITH f AS (SELECT conv_id, role, min(turn) AS t FROM conversations GROUP BY ALL)
SELECT conv_id, string_agg(role, ',' ORDER BY t) AS speakers, CASE WHEN count(*) = 1 THEN max(role) ELSE '' END AS speaker, CASE WHEN count(*) = 1 THEN 'single' ELSE 'multi' END AS speaker_scope FROM f GROUP BY conv_id"""
SQL["primary_speaker"] = """
WITH w AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'SPEAKER_1' ELSE role END AS s FROM conversations),
c AS (SELECT conv_id, s, count(*) AS n, min(turn) AS f FROM w GROUP BY ALL)
SELECT conv_id, s AS primary_speaker FROM c QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY (s LIKE 'SPEAKER%'), n DESC, f) = 1"""
SQL["fixed_groups"] = """
WITH g AS (SELECT *, (row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1) // 6 AS grp FROM conversations)
SELECT role, grp, count(*) AS members, min(conv_id) AS first_conv, CAST(sum(length(text)) AS BIGINT) AS chars FROM g GROUP BY role, grp"""
_SHORT = "CASE WHEN length({c}) <= {n} THEN {c} ELSE substr({c}, 1, {n} - 3) || '...' END"
SQL["position_batches"] = f"""
WITH RECURSIVE d AS (SELECT source, doc_id, length({_SHORT.format(c=_COLLAPSE.format("text"), n=900)}) + 1 AS c, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents WHERE lang = 'fr'),
scan AS (SELECT source, i, CAST(c AS BIGINT) AS sum, CAST(0 AS BIGINT) AS batch, c FROM d WHERE i = 1
  UNION ALL SELECT n.source, n.i, CASE WHEN s.sum + n.c > 8000 THEN n.c ELSE s.sum + n.c END, CASE WHEN s.sum + n.c > 8000 THEN s.batch + 1 ELSE s.batch END, n.c FROM scan s JOIN d n ON n.source = s.source AND n.i = s.i + 1)
SELECT source AS podcast_id, batch, count(*) AS members, CAST(sum(c) AS BIGINT) AS chars FROM scan GROUP BY source, batch"""
SQL["overview_prefix"] = """
SELECT conv_id, turn, upto FROM (SELECT conv_id, turn, CAST(sum(length(text) + 1) OVER (PARTITION BY conv_id ORDER BY turn) + 32 AS BIGINT) AS upto FROM conversations) WHERE upto <= 3200"""
SQL["keep_first_dedupe"] = f"""
SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source, {_KEY.format("text")} ORDER BY doc_id) = 1"""
SQL["keep_first_claims"] = f"SELECT role, count(DISTINCT lower({_COLLAPSE.format('text')})) AS claims FROM conversations GROUP BY role"
SQL["duplicate_rate"] = f"""
SELECT source, count(*) AS rows, count(DISTINCT {_KEY.format("text")}) AS distinct_keys, 1 - count(DISTINCT {_KEY.format("text")}) / count(*) AS duplicate_rate FROM documents GROUP BY source"""
_TAGSTOP = "'about','after','against','because','before','being','could','every','going','host','maybe','other','really','should','their','there','these','thing','those','under','where','which','would'"
_TAGS = f"""WITH tw AS (SELECT doc_id, unnest(l) AS raw, unnest(generate_series(1, len(l))) AS pos FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-z][A-Za-z0-9_-]{{3,}}') AS l FROM documents)),
tc AS (SELECT doc_id, regexp_replace(lower(raw), '^[_-]+|[_-]+$', '', 'g') AS tag, pos FROM tw),
tg AS (SELECT doc_id, tag, count(*) AS n, min(pos) AS f FROM tc WHERE tag NOT IN ({_TAGSTOP}) GROUP BY doc_id, tag),
tr AS (SELECT doc_id, tag, n, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f) AS rank FROM tg)"""
SQL["topic_tags"] = f"{_TAGS} SELECT doc_id, tag, n, rank FROM tr WHERE rank <= 8"
SQL["offline_summary"] = f"""{_TAGS}, s AS (SELECT doc_id, string_agg('- Fake summary ' || rank || ': ' || tag, chr(10) ORDER BY rank) AS summary FROM tr WHERE rank <= 5 GROUP BY doc_id)
SELECT d.doc_id, coalesce(summary, '- Fake summary 1: transcript') AS summary FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id"""
SQL["summary_bullets"] = """
WITH l AS (SELECT doc_id, unnest(list_transform(string_split_regex(regexp_replace(text, '\\n([A-M])', '\n- \\1', 'g'), '\\r?\\n'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g'))) AS line,
    unnest(generate_series(1, len(string_split_regex(regexp_replace(text, '\\n([A-M])', '\n- \\1', 'g'), '\\r?\\n')))) AS i FROM documents),
g AS (SELECT *, regexp_matches(line, '^[-*]\\s+') AS starts, count(*) FILTER (regexp_matches(line, '^[-*]\\s+')) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM l WHERE line <> ''),
b AS (SELECT doc_id, min(i) AS i, CASE WHEN k = 0 THEN '- ' || min(line) ELSE string_agg(CASE WHEN starts THEN regexp_replace(line, '^[-*]\\s+', '- ') ELSE line END, ' ' ORDER BY i) END AS bullet FROM g GROUP BY doc_id, k, CASE WHEN k = 0 THEN i END),
n AS (SELECT doc_id, count(*) AS bullets, string_agg(bullet, chr(10) ORDER BY i) AS joined FROM b GROUP BY doc_id)
SELECT d.doc_id, coalesce(bullets, 0) AS bullets, md5(coalesce(joined, '')) AS bullets_md5 FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id"""
_MISSING = """(((contains(t, 'please provide') OR contains(t, 'please share') OR contains(t, 'send me')) AND (contains(t, 'transcript') OR contains(t, 'source text') OR contains(t, 'source material') OR contains(t, 'podcast text') OR contains(t, 'material')))
  OR contains(t, 'once shared') OR contains(t, 'once you share') OR contains(t, 'when you provide'))"""
SQL["text_measures"] = f"""
SELECT doc_id, length({_COLLAPSE.format("text")}) >= 40 AS substantive, {_MISSING} AS missing_context, CAST(length(text) // 4 + 1 AS BIGINT) AS tokens, md5({_KEY.format("text")}) AS key_md5 FROM (SELECT *, lower(text) AS t FROM documents)"""
SQL["missing_context"] = f"""
SELECT doc_id, {_MISSING} AS missing_context FROM (SELECT doc_id, lower('Please ' || CASE WHEN doc_id % 2 = 0 THEN 'provide' ELSE 'see' END || ' the ' || CASE WHEN doc_id % 3 = 0 THEN 'transcript' ELSE 'notes' END || CASE WHEN doc_id % 7 = 0 THEN ' once shared' ELSE '' END) AS t FROM documents)"""
SQL["short_texts"] = f"""
WITH d AS (SELECT doc_id, {_COLLAPSE.format("text")} AS t FROM documents),
h AS (SELECT doc_id, t, CASE WHEN regexp_matches(substr(t, 1, 360), '[.;,] ') THEN length(regexp_extract(substr(t, 1, 360), '^(.*)[.;,] ', 1)) ELSE -1 END AS b FROM d)
SELECT doc_id, {_SHORT.format(c="t", n=280)} AS short, CASE WHEN length(t) <= 360 THEN t ELSE regexp_replace(substr(t, 1, CASE WHEN b < 198 THEN 360 ELSE b END), '[ .,;:]+$', '') || '...' END AS clipped FROM h"""
SQL["title_cases"] = f"""
SELECT doc_id, array_to_string(list_transform(regexp_extract_all(k, '[a-z]+|[^a-z]+'), lambda x: upper(substr(x, 1, 1)) || substr(x, 2)), '') AS title,
  coalesce(nullif(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'topic') AS slug FROM (SELECT *, {_KEY.format("text")} AS k FROM documents)"""
SQL["episode_dates"] = """
WITH r AS (SELECT o_orderkey, o_orderdate AS d, o_totalprice AS p, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y%m%d') WHEN 1 THEN 'show_' || strftime(o_orderdate, '%Y_%m_%d') || '.json' WHEN 2 THEN 'soon' END AS raw FROM orders),
e AS (SELECT *, CASE WHEN regexp_full_match(raw, '\\d{8}') THEN substr(raw, 1, 4) || '-' || substr(raw, 5, 2) || '-' || substr(raw, 7, 2)
    WHEN regexp_matches(raw, '20\\d{2}[-_/]?\\d{2}[-_/]?\\d{2}') THEN regexp_replace(regexp_extract(raw, '20\\d{2}[-_/]?\\d{2}[-_/]?\\d{2}'), '^(\\d{4})[-_/]?(\\d{2})[-_/]?(\\d{2})$', '\\1-\\2-\\3') ELSE raw END AS ed FROM r)
SELECT o_orderkey, ed AS episode_date, CASE WHEN regexp_matches(ed, '20\\d{2}-\\d{2}-\\d{2}') THEN replace(ed, '-', '') END AS compact, CASE WHEN regexp_matches(ed, '20\\d{2}-\\d{2}-\\d{2}') THEN CAST(replace(ed, '-', '') AS BIGINT) END AS sort_key,
  CAST(date_diff('day', CAST(d AS DATE), CAST(d + INTERVAL 9 YEAR AS DATE)) AS BIGINT) AS days, printf('%02d:%02d:%02d', CAST(floor(p / 3600) AS BIGINT), CAST(floor(p) AS BIGINT) % 3600 // 60, CAST(floor(p) AS BIGINT) % 60) AS clock FROM e"""
_KIND = "CASE lang WHEN 'en' THEN 'position_card' WHEN 'fr' THEN 'cluster_summary' WHEN 'de' THEN 'episode_thesis' ELSE 'leaf_chunk' END"
SQL["stable_ids"] = f"""
SELECT CAST(doc_id AS VARCHAR) AS node_id, substr(sha1('fp-' || source || '|' || {_KIND} || '|' || doc_id || '|' || {_COLLAPSE.format("text")}), 1, 24) AS stable_id, substr(sha1(source), 1, 16) AS episode_id FROM documents"""
SQL["text_fingerprints"] = f"SELECT conv_id, sha1(string_agg({_COLLAPSE.format('text')}, chr(10) ORDER BY turn)) AS fingerprint FROM conversations GROUP BY conv_id"
SQL["number_coercion"] = """
SELECT event_id, CAST(CASE WHEN event_id % 3 = 0 THEN CAST(value AS DECIMAL(12, 2)) END AS DOUBLE) AS parsed,
  CASE event_id % 3 WHEN 0 THEN CAST(CAST(value AS DECIMAL(12, 2)) AS VARCHAR) WHEN 1 THEN 'n/a' ELSE event_type END AS first_present FROM events"""
_NODES = f"""{_TAGS.removeprefix("WITH ")},
tags AS (SELECT doc_id, list(tag ORDER BY rank) AS tags FROM tr WHERE rank <= 8 GROUP BY doc_id),
n AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS node_id, source, upper(source) AS podcast_name, source || '-' || doc_id // 100 AS episode_key, 'Episode ' || doc_id // 100 AS episode_title,
    '2026-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') AS day, {_KIND} AS kind, coalesce(tags, CAST([] AS VARCHAR[])) AS tags, 'Host ' || doc_id % 3 AS speaker, text FROM documents LEFT JOIN tags USING (doc_id))"""
_HEADER = """'Podcast: ' || podcast_name || chr(10) || 'Episode: ' || episode_title || chr(10) || 'Date: ' || day || chr(10) || 'Speaker: ' || speaker || chr(10) || 'Document type: ' || kind || chr(10) || 'Hierarchy: leaf' ||
    CASE WHEN len(tags) > 0 THEN chr(10) || 'Topic hints: ' || array_to_string(tags, ', ') ELSE '' END"""
SQL["context_headers"] = f"""
WITH {_NODES}, h AS (SELECT *, {_HEADER} AS h FROM n),
c AS (SELECT *, CASE WHEN length(h) > 90 THEN regexp_replace(regexp_extract(substr(h, 1, 90), '(?s)^(.*) [^ ]*$', 1), '[ ,:;-]+$', '') ELSE h END AS header FROM h)
SELECT node_id, header, md5(h || chr(10) || chr(10) || regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS text_md5 FROM c"""
SQL["lexical_texts"] = f"""
WITH {_NODES} SELECT node_id, {_COLLAPSE.format("concat_ws(' ', text, podcast_name, episode_title, day, '20260101', speaker, speaker, nullif(array_to_string(tags, ' '), ''), nullif(array_to_string(tags[1:2], ' '), ''))")} AS lexical_text FROM n"""
_FIELDS = "'fp-' || source || chr(31) || node_id || chr(31) || kind || chr(31) || 'doc-' || doc_id"
_MADE = f"'{representations.BUILDER}' || chr(31) || '{representations.manifest()['config_fingerprint']}' || chr(31)"
SQL["representation_fingerprints"] = f"""WITH lex AS ({SQL["lexical_texts"]}), n AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS node_id, source, {_KIND} AS kind, text FROM documents)
SELECT n.node_id, 'doc-' || doc_id AS stable_document_id, sha256({_MADE} || '{representations.manifest()['display_text']}' || chr(31) || {_FIELDS} || chr(31) || text) AS display_fp,
  sha256({_MADE} || '{representations.manifest()['lexical_text']}' || chr(31) || {_FIELDS.replace("node_id", "n.node_id")} || chr(31) || lexical_text) AS lexical_fp FROM n JOIN lex ON lex.node_id = n.node_id"""
SQL["representation_fingerprints"] = SQL["representation_fingerprints"].replace("chr(31) || node_id ||", "chr(31) || n.node_id ||")
SQL["dense_export"] = """
SELECT source AS cache_id, 'doc-' || doc_id AS stable_document_id, md5(CASE WHEN doc_id % 2 = 0 THEN text ELSE 'dense ' || text END) AS text_md5 FROM documents WHERE source NOT IN ('src1', 'src2')"""
_ALIASES = "MAP {'artificial intelligence': 'ai', 'federal reserve': 'fed', 'fed reserve': 'fed', 'federal reserve inflation': 'fed', 'russia ukraine': 'ukraine war', 'russia ukraine war': 'ukraine war', 'ukraine': 'ukraine war', 'us': 'u.s.', 'u s': 'u.s.'}"


def _verdict(source: str) -> str:
    """CTEs from a table `source` with a column l: `judged` has key, display and reason besides."""
    from ..functions.vocabulary import GENERIC_LABELS, TOPIC_STOPWORDS

    def quoted(words: list[str]) -> str:
        return ", ".join(f"'{w}'" for w in words)

    return f"""raws AS (SELECT *, {_COLLAPSE.format("regexp_replace(l, '[_/]+', ' ', 'g')")} AS raw FROM {source}),
keyed AS (SELECT *, coalesce(({_ALIASES})[k0], k0) AS key FROM (SELECT *, regexp_replace({_COLLAPSE.format("regexp_replace(lower(raw), '[^a-z0-9\\s&.-]', ' ', 'g')")}, '^[ .-]+|[ .-]+$', '', 'g') AS k0 FROM raws)),
toks AS (SELECT *, list_filter(string_split(key, ' '), lambda t: t <> '') AS tk FROM keyed),
judged AS (SELECT *, CASE WHEN raw = '' OR key = '' THEN 'empty' WHEN regexp_full_match(key, 'speaker\\s+\\d+|speaker[_\\s-]*[a-z0-9]+') THEN 'speaker_placeholder'
    WHEN len(tk) = 1 AND (tk[1] IN ({quoted(TOPIC_STOPWORDS)}) OR (length(tk[1]) < 3 AND tk[1] NOT IN ('ai', 'uk', 'us'))) THEN 'stopword_or_too_short'
    WHEN len(tk) = 1 AND (tk[1] IN ({quoted(GENERIC_LABELS)}) OR (tk[1] LIKE '%s' AND left(tk[1], -1) IN ({quoted(GENERIC_LABELS)}))) THEN 'generic_reporting_verb'
    WHEN len(tk) <= 2 AND list_contains(tk, 'speaker') THEN 'speaker_placeholder'
    WHEN len(list_filter(tk, lambda t: t NOT IN ({quoted(TOPIC_STOPWORDS)}))) = 0 THEN 'all_stopwords' END AS reason,
  CASE WHEN key = 'ai' THEN 'AI' WHEN key = 'u.s.' THEN 'U.S.' WHEN upper(raw) = raw AND lower(raw) <> raw AND length(raw) <= 8 THEN raw
    ELSE array_to_string(list_transform(regexp_extract_all(key, '[a-z]+|[^a-z]+'), lambda x: upper(substr(x, 1, 1)) || substr(x, 2)), '') END AS shown FROM toks)"""


_HITS = f"""WITH {_NODES},
labels0 AS (SELECT *, list_concat(tags, tags[1:2]) AS ls FROM n WHERE kind <> 'leaf_chunk'),
hits0 AS (SELECT * EXCLUDE (ls), unnest(ls) AS l, unnest(generate_series(0, len(ls) - 1)) AS pos FROM labels0),
{_verdict("hits0")}"""
SQL["topic_verdicts"] = f"""{_HITS}
SELECT node_id, pos AS label_pos, l AS raw_label, CASE WHEN reason IS NULL THEN key END AS normalized_label, CASE WHEN reason IS NULL THEN shown END AS display, reason FROM judged"""
SQL["label_verdicts"] = f"""
WITH base AS (SELECT doc_id, (['Speaker 02', 'using', 'Advocates', 'federal_reserve', 'US', 'AI', 'low-maintenance', 'NATO', 'the', 'a', '', 'ukraine', 'speaker x', 'Tax/Policy', 'the show', 'u s'])[doc_id % 16 + 1] AS l FROM documents),
{_verdict("base")}
SELECT doc_id, CASE WHEN reason IS NULL THEN key END AS normalized, CASE WHEN reason IS NULL THEN shown END AS display, reason FROM judged"""
SQL["filtered_labels"] = f"""{_HITS}, b AS (SELECT key, l, row_number() OVER (PARTITION BY key ORDER BY source, episode_key, doc_id, pos) AS r FROM judged WHERE reason IS NOT NULL)
SELECT key AS normalized_label, count(*) AS n, string_agg(l, ',' ORDER BY r) FILTER (r <= 3) AS examples FROM b GROUP BY key"""
_CONTRIB = f"""{_HITS},
good AS (SELECT *, CASE kind WHEN 'position_card' THEN 3.0 WHEN 'episode_thesis' THEN 2.0 ELSE 1.0 END AS w, {_SHORT.format(c=_COLLAPSE.format("text"), n=320)} AS excerpt FROM judged WHERE reason IS NULL),
c AS (SELECT source, episode_key, key, max(podcast_name) AS podcast_name, max(episode_title) AS episode_title, max(day) AS day, CAST(sum(w) AS DOUBLE) AS score, count(*) AS document_count,
    count(*) FILTER (kind = 'position_card') AS position_count, count(*) FILTER (kind = 'cluster_summary') AS cluster_summary_count, count(*) FILTER (kind = 'episode_thesis') AS episode_thesis_count FROM good GROUP BY ALL),
al AS (SELECT source, episode_key, key, string_agg(shown, '|' ORDER BY n DESC, d, p) AS aliases, arg_min(shown, (-n, d, p)) AS label FROM (SELECT source, episode_key, key, shown, count(*) AS n, min((doc_id, pos)).doc_id AS d, min((doc_id, pos)).pos AS p FROM (SELECT source, episode_key, key, shown, doc_id, pos FROM good) GROUP BY ALL) GROUP BY ALL)"""
_CONTRIB = _CONTRIB.replace("min((doc_id, pos)).doc_id AS d, min((doc_id, pos)).pos AS p", "min(doc_id) AS d, min(doc_id * 10 + pos) AS p")
_SPK = """sp AS (SELECT source, episode_key, key, string_agg(speaker, '|' ORDER BY n DESC, p) AS top_speakers FROM (
    SELECT *, row_number() OVER (PARTITION BY source, episode_key, key ORDER BY n DESC, p) AS r FROM (SELECT source, episode_key, key, speaker, count(*) AS n, min(doc_id * 10 + pos) AS p FROM good GROUP BY ALL)) WHERE r <= 4 GROUP BY ALL),
ev AS (SELECT source, episode_key, key, string_agg(node_id, ',' ORDER BY r) AS evidence_ids FROM (SELECT *, row_number() OVER (PARTITION BY source, episode_key, key ORDER BY w DESC, length(excerpt) DESC, doc_id, pos) AS r FROM good) WHERE r <= 6 GROUP BY ALL)"""
SQL["topic_contributions"] = f"""{_CONTRIB}, {_SPK},
kwv AS (SELECT doc_id, i, max(shown) AS shown FROM (SELECT doc_id, pos AS i, shown FROM judged WHERE reason IS NULL AND pos < 2) GROUP BY ALL),
kw AS (SELECT source, episode_key, key, string_agg(shown, '|' ORDER BY n DESC, p) AS top_keywords FROM (SELECT *, row_number() OVER (PARTITION BY source, episode_key, key ORDER BY n DESC, p) AS r FROM (
    SELECT g.source, g.episode_key, g.key, k.shown, count(*) AS n, min(g.doc_id * 100 + g.pos * 10 + k.i) AS p FROM good g JOIN kwv k ON k.doc_id = g.doc_id GROUP BY ALL)) WHERE r <= 6 GROUP BY ALL)
SELECT c.source AS podcast_id, c.episode_key, c.key AS normalized_label, coalesce(nullif(regexp_replace(regexp_replace(c.key, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'topic') AS topic_key, label, score, document_count, position_count,
  cluster_summary_count, episode_thesis_count, aliases, top_speakers, coalesce(top_keywords, '') AS top_keywords, evidence_ids
FROM c JOIN al USING (source, episode_key, key) JOIN sp USING (source, episode_key, key) JOIN ev USING (source, episode_key, key) LEFT JOIN kw USING (source, episode_key, key)"""
_TOTALS = """t AS (SELECT source, key, count(DISTINCT episode_key) AS episode_count, CAST(sum(document_count) AS BIGINT) AS document_count, CAST(sum(position_count) AS BIGINT) AS position_count,
    CAST(sum(cluster_summary_count) AS BIGINT) AS cluster_summary_count, CAST(sum(episode_thesis_count) AS BIGINT) AS episode_thesis_count, min(day) AS first_day, max(day) AS last_day FROM c GROUP BY source, key),
t2 AS (SELECT *, CAST(date_diff('day', CAST(first_day AS DATE), CAST(last_day AS DATE)) AS BIGINT) AS days FROM t),
depth AS (SELECT *, 0.35 * (episode_count / max(episode_count) OVER ()) + 0.30 * (document_count / max(document_count) OVER ()) + 0.20 * (days / max(days) OVER ()) + 0.15 * (position_count / max(position_count) OVER ()) AS d FROM t2)"""
_META = ", ".join(f"'{w}'" for verbs in META_VERBS.values() for w in verbs)
_POLICY = ", ".join(f"'{w}'" for w in POLICY_KEYWORDS)


def _listed(name: str, value: str, source: str, place: str, episode: int, topic: int, joint: str) -> str:
    """CTEs: the most frequent values of each label in an episode, then of these over all episodes, ties by first place."""
    return f"""{name}1 AS (SELECT source, episode_key, key, {value} AS x, row_number() OVER (PARTITION BY source, episode_key, key ORDER BY n DESC, p) AS r FROM (SELECT g.source, g.episode_key, g.key, {value}, count(*) AS n, min({place}) AS p FROM {source} GROUP BY ALL)),
{name}2 AS (SELECT source, key, x, count(*) AS n, min(episode_key || chr(1) || lpad(CAST(r AS VARCHAR), 6, '0')) AS f FROM {name}1 WHERE r <= {episode} GROUP BY ALL),
{name} AS (SELECT source, key, string_agg(x, '{joint}' ORDER BY n DESC, f) AS {name}, arg_min(x, (-n, f)) AS first_{name}, bool_or(lower(x) IN ({_POLICY})) AS policy_{name}
  FROM (SELECT * FROM {name}2 QUALIFY row_number() OVER (PARTITION BY source, key ORDER BY n DESC, f) <= {topic}) GROUP BY ALL)"""


_INDEX = f"""{_CONTRIB}, {_TOTALS},
kwv AS (SELECT doc_id, i, max(shown) AS word FROM (SELECT doc_id, pos AS i, shown FROM judged WHERE reason IS NULL AND pos < 2) GROUP BY ALL),
{_listed("names", "shown", "good g", "doc_id * 10 + pos", 10**9, 10**9, "|")},
{_listed("hosts", "speaker", "good g", "doc_id * 10 + pos", 4, 5, "|")},
{_listed("words", "word", "good g JOIN kwv k ON k.doc_id = g.doc_id", "g.doc_id * 100 + g.pos * 10 + k.i", 6, 8, ", ")},
idx AS (SELECT depth.*, first_names AS label, hosts, words, CASE WHEN regexp_extract(lower(first_names), '[\\p{{L}}\\p{{N}}]+') IN ({_META}) THEN 'meta_pattern' WHEN policy_words THEN 'policy_theme' ELSE 'subject' END AS topic_kind
  FROM depth JOIN names USING (source, key) JOIN hosts USING (source, key) LEFT JOIN words USING (source, key))"""
SQL["topic_index"] = f"""{_INDEX}
SELECT source AS podcast_id, key AS normalized_label, label, topic_kind, round(d, 4) AS depth_score, CASE WHEN d >= 0.66 THEN 'High' WHEN d >= 0.33 THEN 'Medium' ELSE 'Low' END AS depth_label, episode_count, document_count, position_count,
  cluster_summary_count, episode_thesis_count, first_day AS first_episode_date, last_day AS latest_episode_date, days AS timespan_days, hosts AS top_speakers,
  'Covered in ' || episode_count || ' episode(s) across ' || document_count || ' supporting document(s) from ' || first_day || ' to ' || last_day || ', with recurring emphasis on ' || coalesce(words, 'mixed cues') || '.' AS summary FROM idx"""
SQL["topic_order"] = f"""{_INDEX}
SELECT source AS podcast_id, key AS normalized_label, round(d, 4) AS depth_score FROM idx ORDER BY round(d, 4) DESC, episode_count DESC, lower(label), source, key LIMIT 10"""
SQL["review_candidates"] = f"""{_CONTRIB}
SELECT key AS normalized_label, count(DISTINCT source || chr(1) || episode_key) AS episode_count, CAST(sum(document_count) AS BIGINT) AS document_count FROM c JOIN al USING (source, episode_key, key)
WHERE len(list_filter(string_split(key, ' '), lambda t: t <> '')) = 1 OR (len(list_filter(string_split(key, ' '), lambda t: t <> '')) = 2 AND len(list_filter(string_split(key, ' '), lambda t: length(t) > 5)) = 0)
  OR regexp_extract(lower(label), '[\\p{{L}}\\p{{N}}]+') IN ({_META}) GROUP BY key"""
SQL["podcast_rollup"] = f"""{_CONTRIB}, {_TOTALS}
SELECT e.source AS podcast_id, podcast_name, episode_count, coalesce(topic_count, 0) AS topic_count FROM (SELECT source, max(podcast_name) AS podcast_name, count(DISTINCT episode_key) AS episode_count FROM c GROUP BY source) e
LEFT JOIN (SELECT source, count(*) AS topic_count FROM t GROUP BY source) q ON q.source = e.source"""
SQL["curated_labels"] = f"""{_CONTRIB}, {_TOTALS}
SELECT source AS podcast_id, count(*) AS topics, CAST(sum(document_count) AS BIGINT) AS documents FROM t WHERE NOT (length(key) <= 5 AND key >= 'm') GROUP BY source"""
SQL["topic_depth"] = f"""{_CONTRIB}, {_TOTALS}
SELECT source AS podcast_id, key AS normalized_label, round(d, 4) AS depth_score, CASE WHEN d >= 0.66 THEN 'High' WHEN d >= 0.33 THEN 'Medium' ELSE 'Low' END AS depth_label, episode_count, document_count, position_count,
  cluster_summary_count, episode_thesis_count, first_day AS first_episode_date, last_day AS latest_episode_date, days AS timespan_days FROM depth"""
SQL["best_cache"] = """
WITH f AS (SELECT '/data/' || source || ' ep' || doc_id // 40 || (['_speaker_transcript', '_cleaned_speaker_transcript', '_cleaned_host_only', ''])[doc_id % 4 + 1] || '.json' AS source_path, source || ' ep' || doc_id // 40 AS episode_key, ([2, 3, 1, 0])[doc_id % 4 + 1] AS priority, doc_id % 17 AS mtime FROM documents)
SELECT episode_key, CAST(priority AS BIGINT) AS priority, mtime, source_path FROM f QUALIFY row_number() OVER (PARTITION BY episode_key ORDER BY priority DESC, mtime DESC, source_path) = 1"""
SQL["podcast_names"] = "SELECT doc_id, 'Show ' || source AS podcast_name, 'show-' || source AS podcast_id FROM documents"
SQL["near_dup_pairs"] = f"""
WITH t AS (SELECT doc_id, list_distinct(list_filter(string_split({_KEY.format("text")}, ' '), lambda x: x <> '')) AS s FROM documents),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, len(list_intersect(x.s, y.s)) AS i, len(x.s) AS n, len(y.s) AS m FROM t x JOIN t y ON x.doc_id < y.doc_id AND len(x.s) > 0 AND len(x.s) >= 0.92 * len(y.s) - 1e-9 AND len(y.s) >= 0.92 * len(x.s) - 1e-9)
SELECT a, b, round(i / (n + m - i), 6) AS similarity FROM p WHERE i / (n + m - i) >= 0.92"""
SQL["position_sources"] = """
WITH n AS (SELECT doc_id, source, lang, doc_id % 2 <> 0 AS multi, CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id AS DOUBLE) END AS s, length(text) AS l FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY multi, s NULLS LAST, l, CAST(doc_id AS VARCHAR)) AS place FROM n WHERE lang = 'fr')
SELECT source AS episode_id, CAST(doc_id AS VARCHAR) AS node_id, place FROM o WHERE place <= 40
UNION ALL SELECT source, CAST(doc_id AS VARCHAR), 1 FROM n WHERE lang = 'de' AND source NOT IN (SELECT source FROM o)"""
SQL["position_quarantine"] = """
WITH p AS (SELECT doc_id, source, CASE WHEN doc_id % 7 = 0 THEN '' ELSE text END AS claim FROM documents WHERE lang = 'en'),
e AS (SELECT p.doc_id, string_agg(CAST(d.doc_id AS VARCHAR), ',' ORDER BY d.doc_id <> p.doc_id) AS ids FROM p JOIN documents d ON d.source = p.source AND (d.doc_id = p.doc_id OR (p.doc_id % 3 <> 0 AND d.doc_id = p.doc_id - 20)) GROUP BY p.doc_id)
SELECT CAST(p.doc_id AS VARCHAR) AS position_id, CASE WHEN p.doc_id % 5 = 0 THEN 'ambiguous_speaker' WHEN trim(claim) = '' THEN 'empty_claim' ELSE 'card' END AS outcome, ids AS evidence_ids FROM p JOIN e ON e.doc_id = p.doc_id"""

_KNN = """WITH q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings WHERE vec_id % 100 = 0),
s AS (SELECT query_id, v.vec_id AS document_id, v.label = q.label AS same, list_dot_product(q.e, CAST(v.embedding AS DOUBLE[])) / sqrt(list_dot_product(q.e, q.e)) / sqrt(list_dot_product(CAST(v.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[]))) AS score FROM q JOIN embeddings v ON v.vec_id <> query_id),
r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, document_id) AS rank, CASE WHEN same THEN document_id % 3 + 1 ELSE 0 END AS grade FROM s) WHERE rank <= 20),
j AS (SELECT query_id, document_id, document_id % 3 + 1 AS grade, row_number() OVER (PARTITION BY query_id ORDER BY document_id % 3 DESC, document_id) AS place FROM s WHERE same),
ideal AS (SELECT query_id, count(*) AS relevant, sum(grade) AS graded, sum((power(2, grade) - 1) / log2(place + 1)) FILTER (place <= 10) AS ideal FROM j GROUP BY query_id),
m AS (SELECT query_id, count(*) FILTER (grade > 0 AND rank <= 5) AS h5, count(*) FILTER (grade > 0 AND rank <= 10) AS h10, count(*) FILTER (grade > 0) AS h20, min(rank) FILTER (grade > 0 AND rank <= 10) AS f,
  coalesce(sum((power(2, grade) - 1) / log2(rank + 1)) FILTER (grade > 0 AND rank <= 10), 0) AS dcg, coalesce(sum(grade) FILTER (rank <= 10), 0) AS covered, count(*) AS result_count FROM r GROUP BY query_id),
scored AS (SELECT m.query_id, h5 / relevant AS recall_at_5, h10 / relevant AS recall_at_10, h20 / relevant AS recall_at_20, h5 / 5 AS precision_at_5, h10 / 10 AS precision_at_10, h20 / 20 AS precision_at_20, coalesce(1.0 / f, 0) AS mrr_at_10,
  dcg / ideal AS ndcg_at_10, CAST(covered AS DOUBLE) / CAST(graded AS DOUBLE) AS evidence_coverage_at_10, result_count FROM m JOIN ideal USING (query_id))"""
SQL["nearest_results"] = f"{_KNN} SELECT query_id, rank, document_id FROM r"
SQL["retrieval_metrics"] = f"{_KNN} SELECT * REPLACE (CAST(mrr_at_10 AS DOUBLE) AS mrr_at_10) FROM scored"
SQL["metrics_by_category"] = f"""{_KNN}
SELECT coalesce(category, 'all') AS category, count(*) AS queries, avg(recall_at_10) AS recall_at_10, avg(ndcg_at_10) AS ndcg_at_10, avg(CAST(mrr_at_10 AS DOUBLE)) AS mrr_at_10 FROM (SELECT *, 'c' || query_id % 3 AS category FROM scored) GROUP BY ROLLUP (category)"""
SQL["node_outcomes"] = f"""{_KNN}
SELECT query_id, CASE WHEN document_id % 2 = 0 THEN 'leaf_chunk' ELSE 'position_card' END AS node_type, count(*) FILTER (rank <= 10) AS returned, count(*) FILTER (rank <= 10 AND grade > 0) AS relevant, CAST(coalesce(sum(grade) FILTER (rank <= 10), 0) AS BIGINT) AS grade,
  CASE WHEN sum(grade) > 0 THEN CAST(coalesce(sum(grade) FILTER (rank <= 10), 0) AS DOUBLE) / CAST(sum(grade) AS DOUBLE) ELSE 0.0 END AS grade_recall FROM r GROUP BY ALL HAVING count(*) FILTER (rank <= 10) > 0 OR sum(r.grade) > 0"""
SQL["result_diversity"] = f"""{_KNN}
SELECT query_id, count(DISTINCT document_id % 7) AS source_count_at_10, count(DISTINCT document_id % 7) / count(*) AS source_diversity_at_10, 1 - count(DISTINCT document_id % 50) / count(*) AS duplicate_rate_at_10 FROM r WHERE rank <= 10 GROUP BY query_id"""
SQL["constraint_metrics"] = f"""{_KNN}
SELECT query_id, CASE WHEN query_id % 2 = 0 THEN avg(CASE WHEN document_id % 3 = 1 THEN 1.0 ELSE 0.0 END) END AS speaker_constraint_accuracy_at_10,
  CASE WHEN query_id % 5 = 0 THEN avg(CASE WHEN document_id % 4 <> 0 AND document_id % 28 + 1 BETWEEN 5 AND 20 THEN 1.0 ELSE 0.0 END) END AS date_constraint_accuracy_at_10,
  CASE WHEN query_id % 3 = 0 THEN avg(CASE WHEN document_id % 2 = 0 THEN 1.0 ELSE 0.0 END) END AS node_constraint_accuracy_at_10 FROM r WHERE rank <= 10 GROUP BY query_id"""
SQL["abstention"] = "SELECT count(*) AS unanswerable, avg(CASE WHEN toxic = 1 THEN 1.0 ELSE 0.0 END) AS abstention_accuracy FROM labels WHERE doc_id % 3 <> 0 AND quality <> 1"

_GRAPH = """WITH nodes AS (
  SELECT 'r' || r_regionkey AS id, 'episode_thesis' AS kind, CAST(NULL AS VARCHAR) AS parent FROM region UNION ALL SELECT 'n' || n_nationkey, 'cluster_summary', 'r' || n_regionkey FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'cluster_summary', 'n' || c_nationkey FROM customer
  UNION ALL SELECT 'o' || o_orderkey, 'leaf_chunk', CASE WHEN o_orderkey % 89 = 0 THEN 'c-none' WHEN o_orderkey % 83 = 0 THEN 'c' || (o_custkey + 1) ELSE 'c' || o_custkey END FROM orders WHERE o_orderkey % 101 <> 0),
edges AS (SELECT x.id, x.child FROM (SELECT 'r' || n_regionkey AS id, 'n' || n_nationkey AS child FROM nation UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer
  UNION ALL SELECT 'c' || o_custkey, 'o' || o_orderkey FROM orders WHERE o_orderkey % 97 <> 0) x JOIN nodes n ON n.id = x.id)"""
SQL["missing_children"] = f"{_GRAPH} SELECT id AS node_id, child AS child_id FROM edges WHERE child NOT IN (SELECT id FROM nodes)"
SQL["missing_parents"] = f"{_GRAPH} SELECT id AS node_id, parent AS parent_id FROM nodes WHERE parent IS NOT NULL AND parent NOT IN (SELECT id FROM nodes)"
SQL["inconsistent_parents"] = f"{_GRAPH} SELECT e.id AS node_id, e.child AS child_id FROM edges e JOIN nodes n ON n.id = e.child WHERE n.parent IS DISTINCT FROM e.id"
SQL["evidence_closure"] = _GRAPH.replace("WITH nodes", "WITH RECURSIVE nodes") + """, reach AS (SELECT id, child FROM edges UNION SELECT r.id, e.child FROM reach r JOIN edges e ON e.id = r.child)
SELECT r.id AS node_id, count(DISTINCT r.child) AS leaves FROM reach r JOIN nodes n ON n.id = r.child AND n.kind = 'leaf_chunk' GROUP BY r.id"""
SQL["required_fields"] = """
WITH v AS (SELECT source, doc_id, lang, doc_id % 9 = 0 AS no_level, doc_id % 11 = 0 AS no_type, doc_id % 2 <> 0 AS multi, doc_id % 4 <> 0 AS no_claim FROM documents)
SELECT source AS cache_id, rule, severity, count(*) AS n FROM (
  SELECT source, 'missing_field' AS rule, 'error' AS severity FROM v WHERE no_level UNION ALL SELECT source, 'missing_field', 'error' FROM v WHERE no_type
  UNION ALL SELECT source, 'card_without_single_speaker', 'error' FROM v WHERE lang = 'en' AND multi UNION ALL SELECT source, 'card_without_claim', 'error' FROM v WHERE lang = 'en' AND no_claim
  UNION ALL SELECT source, 'card_without_evidence', 'warning' FROM v WHERE lang = 'en' UNION ALL SELECT DISTINCT source, 'missing_node_type', 'error' FROM v
  UNION ALL SELECT source, 'missing_node_type', 'error' FROM v GROUP BY source HAVING count(*) FILTER (lang <> 'en') = 0) GROUP BY ALL"""
SQL["cache_inspect_counts"] = f"SELECT source AS podcast_id, {_KIND} AS node_type, count(*) AS nodes FROM documents GROUP BY ALL"
SQL["envelope_violations"] = """
WITH c AS (SELECT CAST(doc_id AS VARCHAR) AS cache_id, CASE WHEN doc_id % 30 = 0 THEN '1.0' WHEN doc_id % 20 = 0 THEN '2.1' ELSE '2.0' END AS v, doc_id FROM documents)
SELECT cache_id, 'unsupported_schema_version' AS rule, v AS detail FROM c WHERE v = '1.0' UNION ALL SELECT cache_id, 'missing_representation', 'dense_text' FROM c WHERE v = '2.1' AND doc_id % 40 <> 0
UNION ALL SELECT cache_id, 'missing_representation', 'lexical_text' FROM c WHERE v = '2.1'"""
_DELTA = """WITH o AS (SELECT o_orderkey AS doc, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(14, 2)) AS p FROM orders),
s AS (SELECT *, CASE WHEN doc % 10 = 3 THEN 'added' WHEN doc % 10 = 7 THEN 'removed' WHEN doc % 5 = 0 THEN 'changed' ELSE 'unchanged' END AS status FROM o)"""
SQL["plan_delta"] = f"{_DELTA} SELECT doc, status FROM s"
SQL["apply_delta"] = f"{_DELTA} SELECT doc, CAST(CASE WHEN doc % 5 = 0 THEN p + 1 ELSE p END AS DOUBLE) AS price FROM s WHERE status <> 'removed'"
SQL["delta_invalidated"] = f"""{_DELTA} SELECT DISTINCT 'ancestors' AS kind, CAST(o_custkey AS VARCHAR) AS value FROM s WHERE status IN ('changed', 'removed') UNION ALL SELECT DISTINCT 'topics', o_orderstatus FROM s WHERE status IN ('changed', 'removed')"""
_FIXES = """WITH s AS (SELECT conv_id || '-' || turn AS span_id, conv_id, turn, role, text FROM conversations),
c AS (SELECT span_id, conv_id, CASE WHEN conv_id % 2 = 0 THEN 'speaker' ELSE 'text' END AS field, conv_id % 3 <> 0 AS ok FROM s WHERE turn % 2 = 0 AND conv_id % 5 <> 0)"""
SQL["corrections_guard"] = f"{_FIXES} SELECT span_id, field, ok FROM c"
SQL["corrections_applied"] = f"""{_FIXES} SELECT s.span_id, CASE WHEN c.ok AND field = 'speaker' THEN 'new ' || s.span_id ELSE role END AS speaker, md5(CASE WHEN c.ok AND field = 'text' THEN 'new ' || s.span_id ELSE text END) AS text_md5
FROM s LEFT JOIN c ON c.span_id = s.span_id"""
SQL["correction_sets"] = f"{_FIXES} SELECT DISTINCT 'span' AS kind, span_id AS value FROM c UNION ALL SELECT DISTINCT 'episode', CAST(conv_id AS VARCHAR) FROM c"
SQL["notification_status"] = "SELECT event_id AS notification_id, CASE WHEN event_id % 5 = 0 THEN 'invalid' WHEN user_id % 50 < 30 THEN 'ready' ELSE 'downstream_pending' END AS state FROM events"
SQL["perf_rollup"] = """
SELECT event_type, count(*) AS requests, count(*) FILTER (value < 5) AS failures, round(sum(value), 4) AS total, round(avg(value), 6) AS mean, max(value) AS greatest, arg_max(event_id, (value, -event_id)) AS greatest_at FROM events GROUP BY event_type"""
SQL["run_stats"] = "SELECT count(*) AS files, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'view') AS view, count(*) FILTER (event_type = 'purchase') AS purchase FROM events"
SQL["rolling_300s"] = """
WITH e AS (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS t, CAST(round(value * 100) AS BIGINT) AS cents FROM events)
SELECT event_id, count(*) OVER w AS window_count, CAST(sum(cents) OVER w AS BIGINT) AS window_cents, avg(cents) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS recent_mean_cents
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t RANGE BETWEEN 300 PRECEDING AND CURRENT ROW)"""
SQL["latest_status"] = "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"
SQL["pending_files"] = "SELECT event_id AS fingerprint FROM events WHERE event_id % 10 = 0 OR NOT (event_id % 2 = 0 AND event_id % 3 <> 0)"
SQL["ext_tumbling"] = "SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS start_s, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL"
SQL["ext_sessions"] = """
WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM g)
SELECT user_id, CAST(floor(epoch(min(ts))) AS BIGINT) AS start_s, count(*) AS events, round(sum(value), 4) AS total FROM s GROUP BY user_id, k"""

_WORDS = f"""words AS (SELECT doc_id, unnest(string_split({_KEY.format("coalesce(text, '')")}, ' ')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS n FROM words WHERE term <> '' GROUP BY ALL),
sizes AS (SELECT d.doc_id, coalesce(sum(n), 0) AS size FROM documents d LEFT JOIN tf USING (doc_id) GROUP BY ALL)"""
_LEXICAL = f"""{_TAGS}, {_WORDS},
asked AS (SELECT DISTINCT doc_id AS q, unnest(string_split({_KEY.format("tag")}, ' ')) AS term FROM tr WHERE rank <= 8 AND doc_id % 100 = 0),
idf AS (SELECT term, ln(1 + ((SELECT count(*) FROM sizes) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf GROUP BY term),
bm AS (
  SELECT q, t.doc_id, sum(idf * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * size / (SELECT avg(size) FROM sizes)))) AS score
  FROM asked a JOIN tf t ON t.term = a.term JOIN idf i ON i.term = a.term JOIN sizes z ON z.doc_id = t.doc_id WHERE a.term <> '' AND q <> t.doc_id GROUP BY ALL),
lexical AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY round(score, 9) DESC, doc_id) AS rank FROM bm QUALIFY rank <= 50)"""
_DENSE = """features AS (SELECT doc_id, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 65536 AS f, sum(n) AS n FROM tf GROUP BY ALL),
rare AS (SELECT f, ln((1 + (SELECT count(*) FROM sizes)) / (1 + count(*))) + 1 AS idf FROM features GROUP BY f),
dims AS (SELECT doc_id, f % 256 AS d, sum((1 - 2 * ((f // 256) % 2)) * (1 + ln(n)) * idf) AS w FROM features JOIN rare USING (f) GROUP BY ALL),
norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM dims GROUP BY ALL),
units AS (SELECT doc_id, d, CASE WHEN norm > 0 THEN w / norm ELSE 0 END AS w FROM dims JOIN norms USING (doc_id)),
cos AS (SELECT x.doc_id AS q, y.doc_id, sum(x.w * y.w) AS score FROM units x JOIN units y ON x.d = y.d WHERE x.doc_id % 100 = 0 AND x.doc_id <> y.doc_id GROUP BY ALL),
every AS (SELECT a.doc_id AS q, b.doc_id, coalesce(score, 0.0) AS score FROM sizes a JOIN sizes b ON a.doc_id % 100 = 0 AND a.doc_id <> b.doc_id LEFT JOIN cos c ON c.q = a.doc_id AND c.doc_id = b.doc_id),
dense AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY round(score, 9) DESC, doc_id) AS rank FROM every QUALIFY rank <= 50)"""
SQL["lexical_results"] = f"{_LEXICAL} SELECT q AS query_id, rank, doc_id AS document_id, round(score, 5) AS score FROM lexical"
SQL["dense_results"] = f"WITH {_WORDS}, {_DENSE} SELECT q AS query_id, rank, doc_id AS document_id, round(score, 5) AS score FROM dense"
SQL["fused_results"] = f"""{_LEXICAL}, {_DENSE},
merged AS (SELECT coalesce(x.q, y.q) AS q, coalesce(x.doc_id, y.doc_id) AS doc_id, x.rank AS dense_rank, y.rank AS lexical_rank FROM dense x FULL JOIN lexical y ON x.q = y.q AND x.doc_id = y.doc_id),
summed AS (SELECT *, coalesce(1.0::DOUBLE / (60 + dense_rank), 0) + coalesce(1.0::DOUBLE / (60 + lexical_rank), 0) AS score FROM merged)
SELECT q AS query_id, row_number() OVER (PARTITION BY q ORDER BY round(score, 12) DESC, doc_id) AS rank, doc_id AS document_id, round(score, 9) AS score, dense_rank, lexical_rank FROM summed QUALIFY rank <= 40"""
SQL["topic_refresh"] = f"SELECT podcast_id, normalized_label, depth_score, episode_count, document_count, first_episode_date, latest_episode_date FROM ({SQL['topic_depth']})"
