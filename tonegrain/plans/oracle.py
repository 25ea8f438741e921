"""ANSI-style SQL that states the expected result of each registered query.

Written for DuckDB and on purpose with other means than the Spark side: tokens are rows,
neighbours come from window functions, the walk runs over every token, line numbers are
plain ``row_number()``.  Only the fixed values are shared.
"""

from __future__ import annotations

from tonegrain.lexicon import CHUNK_SIZES, DEFAULT_LEXICON as LEX, LARGEST_CHUNK_SIZE
from tonegrain.plans import tables

W = r"\p{L}\p{N}_"
S = r"\x09-\x0d\x1c-\x20\x{85}\p{Z}"
B, E = rf"(?:^|[^{W}])", rf"(?:$|[^{W}])"
D = r"\p{Nd}"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(values) -> str:
    return "(" + ", ".join(q(v) for v in sorted(values)) + ")"


def listed(values) -> str:
    return "[" + ", ".join("NULL" if v is None else q(v) for v in values) + "]"


def lookup(value: str, weights: dict[str, float]) -> str:
    return "CASE " + " ".join(f"WHEN {value} = {q(w)} THEN {v}" for w, v in weights.items()) + " ELSE 0 END"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^[{S}]+', ''), '[{S}]+$', '')"


PATTERNS = {
    "email": rf"(?:{B}[A-Za-z0-9_]|[{W}][.%+\-])[A-Za-z0-9._%+\-]*@[A-Za-z0-9.\-]+\.[A-Za-z]{{2,}}{E}",
    "url": rf"(?i)https?://[^{S}]+",
    "phone": rf"{B}{D}[{D}\-{S}().]{{7,14}}{D}{E}",
    "date": rf"{B}{D}{{1,2}}[/-]{D}{{1,2}}[/-]{D}{{2,4}}{E}",
    "currency": rf"\$[{D},]+(?:\.{D}{{2}})?|{B}{D}+(?:\.{D}{{2}})?[{S}]*(?i:USD|EUR|GBP|INR){E}",
    "percentage": rf"{B}{D}+(?:\.{D}+)?%",
    "hashtag": rf"#[{W}]+",
    "mention": rf"@[{W}]+",
    "number": rf"{B}{D}+(?:,{D}{{3}})*(?:\.{D}+)?{E}",
    "question": r"\?",
    "exclamation": "!",
    "all_caps_word": rf"{B}[A-Za-z]{{2,}}{E}",
}


def pattern_list(text: str) -> str:
    cases = ", ".join(
        f"CASE WHEN regexp_matches({text}, {q(rx)}) THEN {q(key)} END" for key, rx in PATTERNS.items()
    )
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


def tag_list(text: str) -> str:
    cases = ", ".join(
        "CASE WHEN " + " OR ".join(f"contains(lower({text}), {q(k)})" for k in keywords) + f" THEN {q(d)} END"
        for d, keywords in LEX.domains.items()
    )
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


def chunk_size(n: str) -> str:
    return "CASE " + " ".join(f"WHEN {n} < {b} THEN {s}" for b, s in CHUNK_SIZES) + f" ELSE {LARGEST_CHUNK_SIZE} END"


# ------------------------------------------------------------- derived tables
def _pick(values, divisor: int) -> str:
    return f"({listed(values)})[(event_id // {divisor}) % {len(values)} + 1]"


FEEDBACK = f"""feedback AS (
  SELECT event_id, event_type, 'feed_' || event_type || '.log' AS file_name,
         'b' || (user_id % 4)::VARCHAR AS batch_id, ts,
         concat_ws(' ', {", ".join(_pick(v, d) for v, d in tables.PHRASE_PARTS)}) AS line
  FROM events)"""

FEEDBACK_NUMBERED = f"""{FEEDBACK},
feedback_numbered AS (
  SELECT *, row_number() OVER (PARTITION BY batch_id, file_name ORDER BY event_id) - 1 AS line_no,
         count(*) OVER (PARTITION BY batch_id, file_name) AS total_lines
  FROM feedback)"""

DOCUMENT_FILE = "'doc_' || lpad(doc_id::VARCHAR, 10, '0') || '.txt'"

DOCUMENT_LINES = f"""document_pieces AS (
  SELECT doc_id, source, unnest(p) AS piece, generate_subscripts(p, 1) AS piece_no
  FROM (SELECT doc_id, source, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS p FROM documents)),
document_lines AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY doc_id ORDER BY piece_no) - 1 AS line_no,
         count(*) OVER (PARTITION BY doc_id) AS total_lines, line
  FROM (SELECT *, {strip("piece")} AS line FROM document_pieces) WHERE line <> '')"""

# Each base gives rows(batch_id, file_name, chunk_index, text, processed_at).
BASES = {
    "lines": f"""{FEEDBACK},
rows AS (SELECT batch_id, file_name, event_id AS chunk_index, line AS text, ts AS processed_at FROM feedback)""",
    "chunks": f"""{FEEDBACK_NUMBERED},
rows AS (
  SELECT batch_id, file_name, line_no // ({chunk_size("total_lines")}) AS chunk_index,
         string_agg(line, ' ' ORDER BY line_no) AS text, max(ts) AS processed_at
  FROM feedback_numbered GROUP BY 1, 2, 3)""",
    "documents": f"""{DOCUMENT_LINES},
rows AS (
  SELECT source AS batch_id, {DOCUMENT_FILE} AS file_name,
         line_no // ({chunk_size("total_lines")}) AS chunk_index,
         string_agg(line, ' ' ORDER BY line_no) AS text,
         TIMESTAMP '2024-01-01' + to_days((doc_id % 60)::INTEGER) AS processed_at
  FROM document_lines GROUP BY source, doc_id, chunk_index)""",
    "whole_documents": """rows AS (
  SELECT source AS batch_id, '' AS file_name, doc_id AS chunk_index, text, TIMESTAMP '2024-01-01' AS processed_at FROM documents)""",
    "conversations": """rows AS (
  SELECT conv_id::VARCHAR AS batch_id, role AS file_name, turn AS chunk_index, coalesce(text, '') AS text,
         TIMESTAMP '2024-01-01' AS processed_at FROM conversations)""",
    "pages": f"""page_pieces AS (
  SELECT page_id, unnest(p) AS piece, generate_subscripts(p, 1) AS k FROM (
    SELECT page_id, string_split(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'),
      '[{S}]+', ' ', 'g'), '([.!?]) ', '\\1' || chr(1), 'g'), chr(1)) AS p FROM pages)),
rows AS (
  SELECT 'pages' AS batch_id, 'page_' || lpad(page_id::VARCHAR, 10, '0') || '.html' AS file_name,
         row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS chunk_index, text, TIMESTAMP '2024-01-01' AS processed_at
  FROM (SELECT page_id, k, {strip("piece")} AS text FROM page_pieces) WHERE length(text) > 10)""",
}

TOKENS = rf"""numbered AS (
  SELECT *, row_number() OVER (ORDER BY processed_at, batch_id, file_name, chunk_index) AS rid FROM rows),
token_lists AS (
  SELECT rid, list_transform(regexp_extract_all(text, '[{W}]+(?:''[{W}]+)?'), lambda x: lower(x)) AS tk FROM numbered),
tokens AS (SELECT rid, unnest(tk) AS t, generate_subscripts(tk, 1) AS i FROM token_lists),
neighbours AS (
  SELECT rid, i, t, lead(t) OVER o AS after,
         list(t) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS before
  FROM tokens WINDOW o AS (PARTITION BY rid ORDER BY i))"""

_MODIFIER = (
    "CASE " + " ".join(f"WHEN t || ' ' || coalesce(after, '') = {q(p)} THEN {v}" for p, v in LEX.two_word_diminishers.items())
    + f" ELSE {lookup('t', LEX.modifiers)} END"
)

FOLD = f"""{TOKENS},
weights AS (
  SELECT word, weight FROM (VALUES {", ".join(f"({q(w)}, {v})" for w, v in LEX.sentiment.items())}) AS v(word, weight)),
described AS (
  SELECT n.rid, n.i, n.t, coalesce(w.weight, 0)::DOUBLE AS w,
         CASE WHEN list_has_any(coalesce(before, []), {listed(sorted(LEX.negations))}) THEN -1 ELSE 1 END AS g,
         ({_MODIFIER})::DOUBLE AS m,
         CASE WHEN t || ' ' || coalesce(after, '') IN {words(LEX.two_word_diminishers)} THEN 2
              WHEN t IN {words(LEX.modifiers)} THEN 1 ELSE 0 END AS k
  FROM neighbours n LEFT JOIN weights w ON n.t = w.word),
walked AS (
  SELECT rid, count(*) AS wc, list_reduce(
    list({{'i': i, 'w': w, 'g': g, 'm': m, 'k': k, 'sc': 0::DOUBLE, 'skip': 0, 'pm': 1::DOUBLE, 'hits': []::BIGINT[]}} ORDER BY i),
    lambda a, e: {{'i': e.i, 'w': e.w, 'g': e.g, 'm': e.m, 'k': e.k,
      'sc': a.sc + CASE WHEN a.skip > 1 THEN 0 WHEN a.skip = 1 THEN e.w * a.pm * e.g WHEN e.k = 0 THEN e.w * e.g ELSE 0 END,
      'skip': CASE WHEN a.skip > 0 THEN a.skip - 1 ELSE e.k END,
      'pm': CASE WHEN a.skip > 0 THEN a.pm ELSE e.m END,
      'hits': CASE WHEN e.w <> 0 AND (a.skip = 1 OR (a.skip = 0 AND e.k = 0)) THEN list_append(a.hits, e.i) ELSE a.hits END}},
    {{'i': 0::BIGINT, 'w': 0::DOUBLE, 'g': 1, 'm': 1::DOUBLE, 'k': 0, 'sc': 0::DOUBLE, 'skip': 0, 'pm': 1::DOUBLE, 'hits': []::BIGINT[]}}) AS r
  FROM described GROUP BY rid),
hit_words AS (
  SELECT rid,
         string_agg(DISTINCT t, ',' ORDER BY t) FILTER (WHERE w * g > 0) AS pos,
         string_agg(DISTINCT t, ',' ORDER BY t) FILTER (WHERE w * g < 0) AS neg,
         string_agg(DISTINCT t, ',' ORDER BY t) FILTER (WHERE g < 0) AS negated
  FROM (SELECT rid, unnest(r.hits) AS i FROM walked) JOIN described USING (rid, i) GROUP BY rid),
scored AS (
  SELECT n.*, coalesce(r.sc, 0) AS raw, coalesce(wc, 0) AS word_count,
         CASE WHEN wc IS NULL THEN 0 ELSE tanh(r.sc / (sqrt(wc) + 1)) END AS score,
         coalesce(pos, '') AS positive_words, coalesce(neg, '') AS negative_words,
         coalesce(negated, '') AS negated_words
  FROM numbered n LEFT JOIN walked USING (rid) LEFT JOIN hit_words USING (rid)),
records AS (
  SELECT batch_id, file_name, chunk_index, text AS chunk_text, processed_at,
         round(raw, 4) AS raw_score, round(score, 4) AS sentiment_score,
         CASE WHEN score > 0.15 THEN 'positive' WHEN score < -0.15 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
         positive_words, negative_words, negated_words,
         {tag_list("text")} AS tag_list, {pattern_list("text")} AS pattern_list,
         word_count, length(text) AS char_count
  FROM scored)"""


def over(base: str, select: str) -> str:
    """A query over the scored records of a base table."""
    return f"WITH {BASES[base]},\n{FOLD}\n{select}"


def rows_of(base: str, select: str) -> str:
    """A query over the unscored rows of a base table."""
    return f"WITH {BASES[base]}\n{select}"


TS = "strftime(processed_at, '%Y-%m-%d %H:%M:%S.%f') AS processed_at"
KEY_DESC = "processed_at DESC, batch_id DESC, file_name DESC, chunk_index DESC"
RECORD = f"""batch_id, file_name, chunk_index, md5(chunk_text) AS text_md5, sentiment_score, sentiment_label,
  positive_words, negative_words, negated_words, raw_score,
  array_to_string(tag_list, ',') AS tags, array_to_string(pattern_list, ',') AS pattern_matches,
  word_count, char_count, {TS}"""
EXPORT = f"""batch_id, file_name AS file_path, file_name, chunk_index, chunk_text, sentiment_score, sentiment_label,
  replace(positive_words, ',', ', ') AS positive_words, replace(negative_words, ',', ', ') AS negative_words,
  array_to_string(tag_list, ', ') AS tags, array_to_string(pattern_list, ', ') AS pattern_matches,
  word_count, char_count, {TS}"""
HIT = f"batch_id, file_name, chunk_index, sentiment_score, sentiment_label, {TS}"

MEAN = "round(sum(round(sentiment_score * 10000)::BIGINT)::DOUBLE / count(*)) / 10000"

STATS = f"""count(*) AS total_chunks, {MEAN} AS avg_score,
  max(sentiment_score) AS max_score, min(sentiment_score) AS min_score,
  coalesce(sum(word_count), 0)::BIGINT AS total_words,
  sum(CASE WHEN sentiment_label = 'positive' THEN 1 ELSE 0 END)::BIGINT AS positive_count,
  sum(CASE WHEN sentiment_label = 'negative' THEN 1 ELSE 0 END)::BIGINT AS negative_count,
  sum(CASE WHEN sentiment_label = 'neutral' THEN 1 ELSE 0 END)::BIGINT AS neutral_count,
  count(*) AS total_lines"""


def _word_counts(column: str) -> str:
    return (
        f"SELECT word, count(*) AS n FROM (SELECT unnest(string_split({column}, ',')) AS word FROM records) "
        "WHERE word <> '' GROUP BY word"
    )


def _list_counts(column: str, name: str) -> str:
    return f"SELECT {name}, count(*) AS n FROM (SELECT unnest({column}) AS {name} FROM records) GROUP BY {name}"


def _keyword_counts(base: str) -> str:
    runs = "unnest(regexp_extract_all(lower(text), '[A-Za-z0-9_]+'))"
    return rows_of(base, f"""SELECT word, count(*) AS n FROM (SELECT {runs} AS word FROM rows)
WHERE regexp_full_match(word, '[a-z]{{3,}}') AND word NOT IN {words(LEX.stopwords)} GROUP BY word""")


def _fold_ascii(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


#: Queries that answer another one's question by other means, from what was stored or kept.
SAME_RESULT = {
    "q_kept_statistics": "q_stats_by_batch", "q_kept_top_positive": "q_top_positive", "q_kept_keyword_counts": "q_keyword_counts",
    "q_completions": "q_suggest", "q_search_indexed": "q_search_keyword", "q_dedup_in_place": "q_dedup_chunks", "q_archive_in_place": "q_archive_moved",
}


def oracle_sql() -> dict[str, str]:
    found = _own_sql()
    return found | {name: found[like] for name, like in SAME_RESULT.items()}


def _own_sql() -> dict[str, str]:
    labels = "(VALUES (0, 'positive'), (1, 'negative'), (2, 'neutral')) AS l(o, sentiment_label)"
    buckets = ("(VALUES (0, '< -0.6'), (1, '-0.6 to -0.3'), (2, '-0.3 to 0'), (3, '0 to 0.3'), "
               "(4, '0.3 to 0.6'), (5, '> 0.6')) AS b(position, bucket)")
    bucket_no = ("CASE WHEN sentiment_score < -0.6 THEN 0 WHEN sentiment_score < -0.3 THEN 1 "
                 "WHEN sentiment_score < 0 THEN 2 WHEN sentiment_score < 0.3 THEN 3 "
                 "WHEN sentiment_score <= 0.6 THEN 4 ELSE 5 END")
    page = f"""SELECT row_number() OVER (ORDER BY {KEY_DESC}) AS result_no, * FROM records"""
    escaped = ("replace(replace(replace(replace(line, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')")
    return {
        # lines
        "q_lines_documents": f"WITH {DOCUMENT_LINES} SELECT doc_id, line_no, line FROM document_lines",
        "q_line_count": r"""SELECT source, sum(len(string_split(t, chr(10))) - CASE WHEN ends_with(t, chr(10)) THEN 1 ELSE 0 END)::BIGINT AS n_lines
FROM (SELECT source, replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS t FROM documents) GROUP BY source""",
        "q_row_to_line_csv": """SELECT c_custkey,
  c_custkey::VARCHAR || ' ' || c_name || ', "retail"' || ' ' || c_mktsegment AS line FROM customer""",
        "q_row_to_line_sheet": """SELECT p_partkey,
  trim(concat_ws(' ', p_partkey, p_name, p_brand, p_type, CASE WHEN p_size > 10 THEN p_size END)) AS line FROM part""",
        "q_csv_files": f"""SELECT line, count(*) AS n FROM (
  SELECT concat_ws(' ', conv_id::VARCHAR, turn::VARCHAR, nullif({strip("role")}, ''), nullif({strip("text")}, '')) AS line FROM conversations)
WHERE line <> '' GROUP BY line""",
        "q_json_files": f"""SELECT line, count(*) AS n FROM (SELECT {strip("joined")} AS line FROM (
  SELECT concat_ws(' ', CASE WHEN doc_id <> 0 THEN doc_id::VARCHAR END, nullif(text, ''), nullif(lang, ''), nullif(source, ''),
    CASE WHEN n_chars <> 0 THEN n_chars::VARCHAR END) AS joined FROM documents)) WHERE line <> '' GROUP BY line""",
        "q_json_values_line": """SELECT event_id, CASE WHEN json_extract_string(props, '$.k') = '0' THEN '' ELSE json_extract_string(props, '$.k') END AS props_line,
  event_type || CASE WHEN event_id % 3 = 0 THEN '' ELSE ' ' || (event_id % 3)::VARCHAR END
    || CASE WHEN event_id % 2 = 0 THEN ' True' ELSE '' END || ' 0' || CASE WHEN event_id = 0 THEN '' ELSE ' ' || event_id::VARCHAR END AS row_line FROM events""",
        "q_html_sentences": rf"""SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS sentence_no, sentence FROM (
  SELECT page_id, k, {strip("piece")} AS sentence FROM (
    SELECT page_id, unnest(p) AS piece, generate_subscripts(p, 1) AS k FROM (
      SELECT page_id, string_split(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'),
        '[{S}]+', ' ', 'g'), '([.!?]) ', '\1' || chr(1), 'g'), chr(1)) AS p FROM pages)))
WHERE length(sentence) > 10""",
        # chunks
        "q_chunk_size": f"""WITH {DOCUMENT_LINES}, {FEEDBACK_NUMBERED}
SELECT {DOCUMENT_FILE} AS file_name, source AS batch_id, max(total_lines) AS total_lines, max({chunk_size("total_lines")})::INTEGER AS chunk_size
FROM document_lines GROUP BY doc_id, source
UNION ALL SELECT file_name, batch_id, max(total_lines), max({chunk_size("total_lines")})::INTEGER FROM feedback_numbered GROUP BY file_name, batch_id""",
        "q_chunk_index": f"""WITH {FEEDBACK_NUMBERED}
SELECT event_id, batch_id, file_name, line_no, line_no // ({chunk_size("total_lines")}) AS chunk_index FROM feedback_numbered""",
        "q_chunk_text": rows_of("documents", "SELECT file_name, chunk_index, text AS chunk_text FROM rows"),
        # scoring
        "q_tokens": rf"""SELECT token, count(*) AS n FROM (
  SELECT unnest(list_transform(regexp_extract_all(text, '[{W}]+(?:''[{W}]+)?'), lambda x: lower(x))) AS token FROM documents) GROUP BY token""",
        "q_counts": f"""SELECT doc_id, len(regexp_extract_all(text, '[{W}]+(?:''[{W}]+)?'))::INTEGER AS word_count,
  CASE WHEN {strip("text")} = '' THEN 0 ELSE length(text) END::INTEGER AS char_count FROM documents""",
        "q_modifiers": f"""WITH {BASES["lines"]}, {TOKENS}
SELECT chunk_index AS event_id, (i - 1)::INTEGER AS position, t AS word, ({_MODIFIER})::DOUBLE AS factor,
  CASE WHEN t || ' ' || coalesce(after, '') IN {words(LEX.two_word_diminishers)} THEN 2 ELSE 1 END AS n_words
FROM neighbours JOIN numbered USING (rid)
WHERE t || ' ' || coalesce(after, '') IN {words(LEX.two_word_diminishers)} OR t IN {words(LEX.modifiers)}""",
        "q_negation": f"""WITH {BASES["lines"]}, {TOKENS}
SELECT chunk_index AS event_id, (i - 1)::INTEGER AS position, t AS word,
  list_has_any(coalesce(before, []), {listed(sorted(LEX.negations))}) AS negated
FROM neighbours JOIN numbered USING (rid) WHERE t IN {words(LEX.sentiment)}""",
        "q_lexicon_hits": f"""WITH {BASES["documents"]}, {TOKENS}
SELECT t AS word, CASE WHEN t IN {words(LEX.positive)} THEN 'positive' WHEN t IN {words(LEX.negative)} THEN 'negative' ELSE 'negation' END AS kind,
  count(*) AS n FROM tokens WHERE t IN {words({*LEX.sentiment, *LEX.negations})} GROUP BY 1, 2""",
        "q_lexicon_join": f"""WITH {BASES["documents"]}, {TOKENS},
lexicon AS (SELECT DISTINCT lower(w) AS word, CASE WHEN length(lower(w)) > 6 THEN 1.0 ELSE -0.5 END::DOUBLE AS weight
  FROM (SELECT unnest(regexp_extract_all(text, '[{W}]+(?:''[{W}]+)?')) AS w FROM benchmark))
SELECT file_name, chunk_index, coalesce(sum(weight), 0)::DOUBLE AS weight
FROM numbered LEFT JOIN tokens USING (rid) LEFT JOIN lexicon ON t = word GROUP BY file_name, chunk_index""",
        "q_own_patterns": rows_of("lines", rf"""SELECT chunk_index AS event_id, unnest(list_filter([
  CASE WHEN regexp_matches(text, '(?i)#[{W}]*refund') THEN 'ticket' END, CASE WHEN regexp_matches(text, {q(PATTERNS["all_caps_word"])}) THEN 'caps' END,
  CASE WHEN regexp_matches(text, '(^|[^{W}]){D}{{1,2}}:{D}{{2}}([^{W}]|$)') THEN 'clock' END,
  CASE WHEN contains(lower(text), 'ops@') THEN 'ops' END], lambda x: x IS NOT NULL)) AS pattern FROM rows"""),
        "q_chunk_preview": rows_of("documents", "SELECT file_name, chunk_index, md5(left(text, 5000)) AS preview_md5 FROM rows"),
        "q_conversation_stats": over("conversations", f"SELECT batch_id, {STATS} FROM records GROUP BY batch_id"),
        "q_page_sentiment": over("pages", "SELECT file_name, chunk_index, sentiment_score, sentiment_label, word_count FROM records"),
        "q_scored_labels": over("whole_documents", f"""SELECT quality, toxic, sentiment_label, count(*) AS n, {MEAN} AS avg_score
FROM records JOIN labels ON doc_id = chunk_index GROUP BY ALL"""),
        "q_stored_batches": over("lines", f"""SELECT '00' || batch_id[2:] AS batch_id, count(*) AS total_chunks, sum(word_count)::BIGINT AS total_words, {MEAN} AS avg_score
FROM records WHERE batch_id <> 'b3' AND (batch_id <> 'b2' OR sentiment_label = 'negative') GROUP BY batch_id"""),
        "q_raw_score": over("lines", "SELECT chunk_index AS event_id, raw_score FROM records"),
        "q_word_lists": over("lines", "SELECT chunk_index AS event_id, positive_words, negative_words, negated_words FROM records"),
        "q_score_label": over("lines", "SELECT chunk_index AS event_id, sentiment_score, sentiment_label FROM records"),
        "q_score_label_documents": over("documents", "SELECT file_name, chunk_index, sentiment_score, sentiment_label FROM records"),
        "q_patterns": rows_of("lines", f"SELECT chunk_index AS event_id, unnest({pattern_list('text')}) AS pattern FROM rows"),
        "q_patterns_documents": rows_of("documents", f"SELECT file_name, chunk_index, unnest({pattern_list('text')}) AS pattern FROM rows"),
        "q_tags": rows_of("lines", f"SELECT chunk_index AS event_id, array_to_string({tag_list('text')}, ',') AS tags FROM rows"),
        "q_tags_documents": rows_of("documents", f"SELECT file_name, chunk_index, array_to_string({tag_list('text')}, ',') AS tags FROM rows"),
        "q_tags_by_keyword_table": rows_of("documents", f"SELECT file_name, chunk_index, unnest({tag_list('text')}) AS domain FROM rows"),
        "q_line_records": over("lines", f"SELECT {RECORD} FROM records"),
        "q_chunk_records": over("documents", f"SELECT {RECORD} FROM records"),
        "q_sentiment_by_lexicon_table": over("documents", """SELECT file_name, chunk_index, raw_score, sentiment_score, sentiment_label,
  positive_words, negative_words, negated_words, word_count FROM records"""),
        "q_feedback_chunk_records": over("chunks", f"SELECT {RECORD} FROM records"),
        # statistics
        "q_stats": over("documents", f"SELECT {STATS} FROM records"),
        "q_stats_one_batch": over("lines", f"SELECT {STATS} FROM records WHERE batch_id = 'b1'"),
        "q_stats_by_batch": over("lines", f"SELECT batch_id, {STATS} FROM records GROUP BY batch_id"),
        "q_stats_by_file": over("chunks", f"SELECT file_name, {STATS} FROM records GROUP BY file_name"),
        "q_summary": over("lines", f"""SELECT count(*) AS total_chunks, {MEAN} AS avg_score,
  max(sentiment_score) AS max_score, min(sentiment_score) AS min_score,
  count(*) FILTER (WHERE sentiment_label = 'positive') AS positive_count,
  count(*) FILTER (WHERE sentiment_label = 'negative') AS negative_count,
  count(*) FILTER (WHERE sentiment_label = 'neutral') AS neutral_count,
  round(100.0::DOUBLE * count(*) FILTER (WHERE sentiment_label = 'positive') / count(*), 1) AS positive_pct,
  round(100.0::DOUBLE * count(*) FILTER (WHERE sentiment_label = 'negative') / count(*), 1) AS negative_pct,
  round(100.0::DOUBLE * count(*) FILTER (WHERE sentiment_label = 'neutral') / count(*), 1) AS neutral_pct FROM records"""),
        "q_pattern_freq": over("lines", _list_counts("pattern_list", "pattern")),
        "q_top_positive": over("lines", _word_counts("positive_words") + " ORDER BY n DESC, word LIMIT 10"),
        "q_top_negative": over("documents", _word_counts("negative_words") + " ORDER BY n DESC, word LIMIT 10"),
        "q_top_domains": over("lines", _list_counts("tag_list", "domain") + " ORDER BY n DESC, domain LIMIT 5"),
        "q_keyword_counts": _keyword_counts("documents"),
        "q_keywords": _keyword_counts("documents") + " ORDER BY n DESC, word LIMIT 80",
        "q_keyword_chips": _keyword_counts("lines") + " ORDER BY n DESC, word LIMIT 16",
        "q_pattern_bars": over("lines", f"""SELECT pattern, n, round(n::DOUBLE / max(n) OVER () * 100, 1) AS width_pct
FROM ({_list_counts("pattern_list", "pattern")} ORDER BY n DESC, pattern LIMIT 8)"""),
        "q_word_panel": over("lines", f"""SELECT 'positive' AS polarity, word, n, row_number() OVER (ORDER BY n DESC, word)::INTEGER AS rank
FROM ({_word_counts("positive_words")}) QUALIFY rank <= 8
UNION ALL SELECT 'negative', word, n, row_number() OVER (ORDER BY n DESC, word)::INTEGER AS rank
FROM ({_word_counts("negative_words")}) QUALIFY rank <= 8"""),
        # dashboard
        "q_label_distribution": over("lines", f"""SELECT l.sentiment_label, count(batch_id) AS n,
  round(count(batch_id)::DOUBLE / sum(count(batch_id)) OVER () * 100, 1) AS pct
FROM {labels} LEFT JOIN records r USING (sentiment_label) GROUP BY l.sentiment_label"""),
        "q_score_histogram": over("lines", f"""SELECT position, bucket, count(batch_id) AS n
FROM {buckets} LEFT JOIN records ON position = {bucket_no} GROUP BY position, bucket"""),
        "q_score_trend": over("lines", f"""SELECT batch_id, point::INTEGER AS point, min(r) AS first_chunk, count(*) AS n, {MEAN} AS avg_score FROM (
  SELECT *, floor(r / ceil(c / 20.0)) AS point FROM (
    SELECT *, row_number() OVER (PARTITION BY batch_id, file_name ORDER BY chunk_index) - 1 AS r, count(*) OVER (PARTITION BY batch_id, file_name) AS c FROM records))
GROUP BY batch_id, point"""),
        "q_domain_freq": over("documents", f"""SELECT d.domain, count(x) AS n FROM (SELECT unnest({listed(LEX.domains)}) AS domain) d
LEFT JOIN (SELECT unnest(tag_list) AS x FROM records) ON x = d.domain GROUP BY d.domain"""),
        "q_score_format": over("lines", """SELECT chunk_index AS event_id,
  CASE WHEN sentiment_score >= 0 THEN '+' ELSE '' END || printf('%.3f', sentiment_score + CASE WHEN (sentiment_score * 16) % 1 = 0 THEN sign(sentiment_score) * 1e-7 ELSE 0 END) AS score_text,
  printf('%.1f', g + CASE WHEN (g * 4) % 1 = 0 THEN 1e-5 ELSE 0 END)::DOUBLE AS gauge_pct
FROM (SELECT *, (sentiment_score + 1) / 2 * 100 AS g FROM records)"""),
        # search
        "q_search_keyword": over("lines", f"SELECT {HIT} FROM records WHERE contains({_fold_ascii('chunk_text')}, 'not very')"),
        "q_search_wildcard": rows_of("documents", f"""SELECT file_name, chunk_index, text AS chunk_text FROM rows
WHERE {_fold_ascii('text')} LIKE '%ou_n%er the%'"""),
        "q_search_score_range": over("lines", f"SELECT {HIT} FROM records WHERE sentiment_score BETWEEN 0 AND 0.3"),
        "q_search_label": over("documents", f"SELECT {HIT} FROM records WHERE sentiment_label = 'negative'"),
        "q_search_batch": over("lines", f"SELECT {HIT} FROM records WHERE batch_id = 'b2'"),
        "q_search_date": over("lines", f"""SELECT {HIT} FROM records
WHERE processed_at >= TIMESTAMP '2024-01-05' AND processed_at <= TIMESTAMP '2024-01-09'"""),
        "q_search_combined": over("lines", f"""SELECT {HIT} FROM records WHERE contains({_fold_ascii('chunk_text')}, 'doctor')
AND sentiment_score >= -0.9 AND sentiment_label = 'negative' AND batch_id = 'b3' AND processed_at >= TIMESTAMP '2024-01-03'"""),
        "q_search_total": rows_of("documents", f"SELECT count(*) AS total FROM rows WHERE contains({_fold_ascii('text')}, 'tion')"),
        "q_search_page": over("lines", f"""SELECT result_no::INTEGER AS result_no, {HIT}, array_to_string(tag_list[1:2], ', ') AS tags_preview
FROM (SELECT row_number() OVER (ORDER BY {KEY_DESC}) AS result_no, * FROM records WHERE contains({_fold_ascii('chunk_text')}, 'bank'))
WHERE result_no BETWEEN 51 AND 100"""),
        "q_page_after": over("lines", f"""SELECT {HIT}, array_to_string(tag_list[1:2], ', ') AS tags_preview FROM records
WHERE (processed_at, batch_id, file_name, chunk_index) < (TIMESTAMP '2024-01-20', 'b2', 'feed_click.log', 5) ORDER BY {KEY_DESC} LIMIT 50"""),
        "q_suggest": f"SELECT * FROM ({_keyword_counts('documents')}) WHERE starts_with(word, 'th') ORDER BY n DESC, word LIMIT 8",
        "q_highlight": f"WITH {FEEDBACK} SELECT event_id, regexp_replace({escaped}, '(?i)(re)', '<mark class=\"highlight\">\\1</mark>', 'g') AS html FROM feedback",
        "q_page_count": over("lines", "SELECT batch_id, count(*) AS total, greatest(ceil(count(*) / 50.0), 1)::BIGINT AS pages FROM records GROUP BY batch_id"),
        # export and jobs
        "q_all_chunks": over("chunks", f"SELECT {RECORD} FROM records WHERE batch_id = 'b0'"),
        "q_export_rows": over("lines", f"SELECT {EXPORT} FROM records"),
        "q_export_search": over("lines", f"SELECT {EXPORT} FROM records WHERE contains({_fold_ascii('chunk_text')}, 'excellent')"),
        "q_batch_summary": rows_of("chunks", """SELECT batch_id, file_name, count(*) AS total_chunks,
  strftime(min(processed_at), '%Y-%m-%d %H:%M:%S.%f') AS started_at, strftime(max(processed_at), '%Y-%m-%d %H:%M:%S.%f') AS completed_at,
  'completed' AS status, NULL::VARCHAR AS error_message FROM rows GROUP BY batch_id, file_name
UNION ALL SELECT DISTINCT batch_id, 'feed_blank.log', 0, NULL, NULL, 'error', 'File produced 0 chunks' FROM feedback"""),
        "q_batch_progress": f"""WITH {DOCUMENT_LINES}, per_file AS (
  SELECT source AS batch_id, doc_id, max(total_lines) AS n, max(total_lines) + CASE WHEN starts_with(source, 'src1') THEN 700 ELSE 0 END AS total_lines
  FROM document_lines GROUP BY source, doc_id),
chunks AS (
  SELECT batch_id, ceil(total_lines::DOUBLE / {chunk_size("total_lines")})::BIGINT AS expected, ceil(n::DOUBLE / {chunk_size("n")})::BIGINT AS done FROM per_file)
SELECT batch_id, expected_chunks, completed_chunks, floor(completed_chunks::DOUBLE / expected_chunks * 100)::BIGINT AS percent,
  CASE WHEN completed_chunks >= expected_chunks THEN 'completed' ELSE 'processing' END AS status
FROM (SELECT batch_id, sum(expected)::BIGINT AS expected_chunks, sum(done)::BIGINT AS completed_chunks FROM chunks GROUP BY batch_id)
UNION ALL SELECT 'blank', 0, 0, 0, 'error'""",
        "q_batch_report": over("lines", f"""SELECT 'b1' AS batch_id, 'Batch ID: b1' || chr(10) || 'Total Chunks: ' || count(*) || chr(10)
  || 'Average Sentiment Score: ' || printf('%.4f', {MEAN}) || chr(10)
  || 'Positive: ' || count(*) FILTER (WHERE sentiment_label = 'positive') || chr(10)
  || 'Negative: ' || count(*) FILTER (WHERE sentiment_label = 'negative') || chr(10)
  || 'Neutral: ' || count(*) FILTER (WHERE sentiment_label = 'neutral') AS report FROM records WHERE batch_id = 'b1'"""),
        # maintenance
        "q_dedup": """SELECT doc_id, source, text FROM documents QUALIFY row_number() OVER (PARTITION BY source, text ORDER BY doc_id) = 1""",
        "q_dedup_chunks": over("lines", f"""SELECT {HIT} FROM records
QUALIFY row_number() OVER (PARTITION BY file_name, chunk_text ORDER BY processed_at, batch_id, file_name, chunk_index) = 1"""),
        "q_archive_moved": over("lines", f"SELECT {HIT} FROM records WHERE processed_at < TIMESTAMP '2024-01-16'"),
        "q_archive_kept": over("lines", f"SELECT {HIT} FROM records WHERE processed_at >= TIMESTAMP '2024-01-16'"),
        "q_archive_union": over("lines", f"SELECT {HIT} FROM records"),
        # time
        "q_sentiment_by_day": over("lines", f"""SELECT strftime(date_trunc('day', processed_at), '%Y-%m-%d') AS day, file_name, count(*) AS n,
  {MEAN} AS avg_score FROM records GROUP BY 1, 2"""),
    }
