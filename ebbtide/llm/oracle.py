"""DuckDB SQL of the numbered queries that SQL can express."""

from ebbtide.llm.chat import BUDGET, END, HISTORY, START
from ebbtide.llm.decontamination import WINDOW

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w, least({WINDOW}, len(w)) AS n FROM benchmark),
win AS (SELECT item, n, list_slice(w, s, s + n - 1) AS g
        FROM (SELECT item, n, w, unnest(generate_series(1, len(w) - n + 1)) AS s FROM b WHERE n > 0)),
pos AS (SELECT doc_id, n, s, list_slice(w, s, s + n - 1) AS g
        FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
              FROM d, (SELECT DISTINCT n FROM win))),
hit AS (SELECT DISTINCT doc_id, n, s, item FROM pos JOIN win USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT i) AS n_hit
          FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS i FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
          FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


def _escaped(column: str) -> str:
    return f"replace(replace({column}, '%', '%25'), '<|', '%3C|')"


CHAT = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{END}{START}assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '{END}{START}assistant ok'),
a AS (SELECT *, row_number() OVER o AS place, sum(tokens) OVER o - tokens AS ahead
      FROM (SELECT *, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) + 4 AS tokens FROM t)
      WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
s AS (SELECT *, dense_rank() OVER (PARTITION BY conv_id ORDER BY ahead // {BUDGET // 2}) AS span,
        place = 1 AND role = 'system' AS opens,
        length({_escaped("role")}) + length(regexp_replace(role, '[^\\n]', '', 'g')) * 2 + length({_escaped("text")})
          + {len(START) + len(END) + 2} AS chars FROM a),
u AS (SELECT *, max(span) OVER (PARTITION BY conv_id) AS spans,
        max(ahead + tokens) OVER (PARTITION BY conv_id, span) - ahead <= {HISTORY} AS near FROM s)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars * CASE WHEN opens THEN spans WHEN near AND span < spans THEN 2 ELSE 1 END) AS BIGINT) AS formatted_chars
FROM u GROUP BY conv_id"""

_LETTERS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((('0x' || substr(h, {5 * g + 1}, 5))::BIGINT >> {s}) & 31 AS INT) + 1, 1)"
    for g in range(8) for s in (15, 10, 5, 0)
)
WARC = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS h FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS holder FROM p)
SELECT page_id, octet_length(payload) AS payload_bytes, {_LETTERS} AS payload_digest,
  if(page_id = holder, 'response', 'revisit') AS record_type, CASE WHEN page_id <> holder THEN holder END AS refers_to
FROM r"""
