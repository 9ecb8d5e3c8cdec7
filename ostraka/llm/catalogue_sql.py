"""SQL for the queries of this subpackage, where SQL can say them."""

from __future__ import annotations

from ostraka.functions.languages import CODES
from ostraka.llm.tokens import VOCABULARY
from ostraka.plans.texts import edition_language_sql

_BLANKS = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def _tokens_sql(rows: str) -> str:
    """CTEs up to tokens(key, tokens) of rows(key, text): the merges of byte pairs in SQL, over the same vocabulary file."""
    return rf"""
WITH RECURSIVE rows AS ({rows}),
vocabulary AS MATERIALIZED (SELECT hex(from_base64(split_part(line, ' ', 1))) AS h, split_part(line, ' ', 2)::BIGINT AS rank
  FROM read_csv('{VOCABULARY}', delim='\x01', header=false, quote='', escape='', columns={{'line': 'VARCHAR'}})),
parts AS (SELECT key, unnest(string_split(regexp_replace(text, '([{_SPACE}]+)([{_SPACE}])([^{_SPACE}])', '\1' || chr(57344) || '\2\3', 'g'), chr(57344))) AS part FROM rows WHERE text <> ''),
pieces AS MATERIALIZED (SELECT key, unnest(regexp_extract_all(part, '''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+')) AS piece FROM parts),
words AS MATERIALIZED (SELECT piece, hex(encode(piece)) AS h FROM (SELECT DISTINCT piece FROM pieces)),
merging AS (
  SELECT piece, [h[2 * i + 1:2 * i + 2] FOR i IN range(0, (length(h) / 2)::BIGINT)] AS b FROM words WHERE h NOT IN (SELECT h FROM vocabulary)
  UNION ALL
  SELECT piece, list_concat(list_concat(b[1:i - 1], [b[i] || b[i + 1]]), b[i + 2:])
  FROM (SELECT piece, any_value(b) AS b, arg_min(i, rank * 100000 + i) AS i FROM (SELECT piece, b, unnest(range(1, len(b))) AS i FROM merging) JOIN vocabulary ON h = b[i] || b[i + 1] GROUP BY piece)),
counts AS (SELECT piece, 1 AS n FROM words WHERE h IN (SELECT h FROM vocabulary) UNION ALL SELECT piece, min(len(b)) AS n FROM merging GROUP BY piece),
tokens AS (SELECT key, coalesce(sum(n), 0)::BIGINT AS tokens FROM rows LEFT JOIN pieces USING (key) LEFT JOIN counts USING (piece) GROUP BY key)"""


_TAG = f"CASE WHEN type = 'translation' THEN language ELSE {edition_language_sql('xml_content')} END"
_CODE = f"CASE split_part(replace(lower(trim({_TAG})), '_', '-'), '-', 1) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CODES.items()) + " END"
_SLICED = f"SELECT transcription_id, type, text, lemma_text, split_part(source_path, '/', 1) AS source, coalesce({_CODE}, 'unknown') AS language FROM transcriptions"
_CUBE = "SELECT (4 * grouping(source) + 2 * grouping(language) + grouping(type))::INTEGER AS level, source, language, type, count(*) AS documents, sum(tokens)::BIGINT AS tokens FROM {} GROUP BY CUBE (source, language, type)"
_MEASURED = _tokens_sql("SELECT transcription_id AS key, text FROM transcriptions") + f", s AS (SELECT transcription_id, source, language, type, sha256(text) AS content_hash, tokens FROM ({_SLICED}) JOIN tokens ON key = transcription_id)"
_FIRST = "CASE WHEN type = 'translation' THEN text ELSE lemma_text END"
_STATES = (
    _tokens_sql(f"SELECT transcription_id::VARCHAR || ' before' AS key, {_FIRST} AS text FROM transcriptions UNION ALL SELECT transcription_id::VARCHAR || ' after', text FROM transcriptions")
    + f""", d AS ({_SLICED}),
before AS (SELECT d.*, tokens, {_FIRST} AS content FROM d JOIN tokens ON key = transcription_id::VARCHAR || ' before' WHERE {_FIRST} IS NOT NULL),
after AS (SELECT d.*, tokens, text AS content FROM d JOIN tokens ON key = transcription_id::VARCHAR || ' after' WHERE transcription_id IN (SELECT min(transcription_id) FROM transcriptions GROUP BY text))"""
)
SQL: dict[str, str] = {
    "p2_tokens": _MEASURED
    + f" SELECT NULL::INTEGER AS level, transcription_id, source, language, type, 1::BIGINT AS documents, tokens FROM s UNION ALL SELECT level, NULL, source, language, type, documents, tokens FROM ({_CUBE.format('s')})",
    "p2_token_counts": _MEASURED + " SELECT * FROM s",
    "p2_token_budget": f"{_MEASURED} {_CUBE.format('s')}",
    "p2_token_refresh": f"{_STATES} {_CUBE.format('after')}",
    "p2_token_delta": _STATES
    + """
SELECT change, source, language, type, sum(documents)::BIGINT AS documents, sum(tokens)::BIGINT AS tokens FROM (
  SELECT CASE WHEN a.transcription_id IS NULL THEN 'removed' ELSE 'changed' END AS change, b.source, b.language, b.type, -1 AS documents, -b.tokens AS tokens FROM before b LEFT JOIN after a USING (transcription_id) WHERE a.content IS DISTINCT FROM b.content
  UNION ALL
  SELECT CASE WHEN b.transcription_id IS NULL THEN 'added' ELSE 'changed' END, a.source, a.language, a.type, 1, a.tokens FROM after a LEFT JOIN before b USING (transcription_id) WHERE a.content IS DISTINCT FROM b.content)
GROUP BY ALL""",
    "p8_limits": _tokens_sql("SELECT doc_id AS key, text FROM documents")
    + """ SELECT run_name, sum(greatest(1, ceil(tokens / capacity_tokens::DOUBLE)))::BIGINT AS pieces, sum(tokens)::BIGINT AS tokens, count(*) FILTER (tokens > capacity_tokens) AS cut, true AS held, true AS items_bind
FROM tokens CROSS JOIN pack_runs GROUP BY run_name""",
    "p9_held": "SELECT mix_name, source, target_share, max_repeats, true AS reached, true AS kept FROM mix_targets",
    "p4_found": """
WITH e AS (SELECT model_name, xml_id, chunk_index, min(embedding)::DOUBLE[] AS v FROM (SELECT model_name, xml_id, chunk_index, embedding FROM transcription_embeddings UNION ALL SELECT model_name, xml_id, chunk_index, embedding FROM translation_embeddings)
  GROUP BY ALL HAVING list_aggregate([abs(x) FOR x IN min(embedding)], 'max') > 0),
s AS (SELECT a.model_name, a.xml_id AS ax, a.chunk_index AS ac, b.xml_id AS bx, b.chunk_index AS bc, list_cosine_similarity(a.v, b.v) AS sim FROM e a JOIN e b ON a.model_name = b.model_name AND (a.xml_id, a.chunk_index) <> (b.xml_id, b.chunk_index)),
r AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY model_name, ax, ac ORDER BY sim DESC, bx, bc) <= 10)
SELECT DISTINCT model_name, CASE WHEN (ax, ac) < (bx, bc) THEN ax ELSE bx END AS xml_id_a, CASE WHEN (ax, ac) < (bx, bc) THEN ac ELSE bc END AS chunk_index_a,
  CASE WHEN (ax, ac) < (bx, bc) THEN bx ELSE ax END AS xml_id_b, CASE WHEN (ax, ac) < (bx, bc) THEN bc ELSE ac END AS chunk_index_b FROM r WHERE sim >= 0.9""",
    "p4_nearest": """
WITH e AS (SELECT model_name, xml_id, chunk_index, min(embedding)::DOUBLE[] AS v FROM (SELECT model_name, xml_id, chunk_index, embedding FROM transcription_embeddings UNION ALL SELECT model_name, xml_id, chunk_index, embedding FROM translation_embeddings)
  GROUP BY ALL HAVING list_aggregate([abs(x) FOR x IN min(embedding)], 'max') > 0)
SELECT a.model_name, a.xml_id, a.chunk_index, b.xml_id AS near_xml_id, b.chunk_index AS near_chunk_index, round(list_cosine_similarity(a.v, b.v), 4) AS similarity FROM e a JOIN e b ON a.model_name = b.model_name AND (a.xml_id, a.chunk_index) <> (b.xml_id, b.chunk_index)
WHERE a.xml_id % 50 = 0 QUALIFY row_number() OVER (PARTITION BY a.model_name, a.xml_id, a.chunk_index ORDER BY list_cosine_similarity(a.v, b.v) DESC, b.xml_id, b.chunk_index) <= 10""",
    "p5_restored": f"""SELECT xml_id, model_name, chunk_index, len(w)::INTEGER AS words, sha256(array_to_string(w, ' ')) AS content_hash, true AS kept FROM
  (SELECT DISTINCT xml_id, model_name, chunk_index, list_filter(regexp_split_to_array(document_text, '{_BLANKS}'), lambda w: w <> '') AS w FROM transcription_embeddings) WHERE len(w) > 500""",
    "p5_found": f"SELECT DISTINCT xml_id, model_name, chunk_index FROM transcription_embeddings WHERE len(list_filter(regexp_split_to_array(document_text, '{_BLANKS}'), lambda w: w <> '')) > 500",
}
