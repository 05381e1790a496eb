"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from panora.llm import mixing as M

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


def _case(level: str) -> str:
    listed = M.WEIGHTS.get(level, {})
    return "CASE " + " ".join(f"WHEN {level} = '{k}' THEN {v}" for k, v in listed.items()) + " ELSE 1 END"


def _share(name: str, source: str, keys: str, parent: str) -> str:
    by = f"PARTITION BY {parent}" if parent else ""
    split = f"PARTITION BY {parent + ', ' if parent else ''}filled"
    return f"""{name}_a AS (SELECT *, budget - coalesce(sum(cap) OVER ({by} ORDER BY CAST(cap AS DOUBLE) / w, {keys}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft, sum(w) OVER ({by} ORDER BY CAST(cap AS DOUBLE) / w, {keys}
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM {source}),
  {name}_b AS (SELECT *, cap * ws <= w * lft AS filled FROM {name}_a),
  {name}_c AS (SELECT * EXCLUDE (lft, ws), first_value(lft) OVER ({split} ORDER BY CAST(cap AS DOUBLE) / w, {keys}) AS lft,
      first_value(ws) OVER ({split} ORDER BY CAST(cap AS DOUBLE) / w, {keys}) AS ws,
      row_number() OVER ({split} ORDER BY CAST(cap AS DOUBLE) / w, {keys}) AS place FROM {name}_b),
  {name}_d AS (SELECT *, CASE WHEN filled THEN cap ELSE w * lft // ws END AS part FROM {name}_c),
  {name} AS (SELECT * EXCLUDE (budget), part + CASE WHEN NOT filled AND place <= lft - sum(part) OVER ({split})
      THEN 1 ELSE 0 END AS budget FROM {name}_d)"""


def mixing() -> str:
    domains = ", ".join(f"'{d}'" for d in M.DOMAINS)
    return f"""WITH rows_ AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
      CAST({WORDS} AS HUGEINT) AS tokens, md5(coalesce(text, '')) AS text_md5 FROM documents),
  named AS (SELECT *, coalesce([{domains}][CAST(floor(CASE WHEN regexp_extract(source, '([0-9]{{1,6}})$', 1) = '' THEN 0
      ELSE CAST(regexp_extract(source, '([0-9]{{1,6}})$', 1) AS INTEGER) END / {M.SOURCES_PER_DOMAIN}) AS INTEGER) + 1],
      '{M.DOMAINS[0]}') AS domain FROM rows_),
  entries AS (SELECT doc_id, domain, lang, source, tokens, text_md5, CAST(count(*) AS HUGEINT) AS copies FROM named GROUP BY ALL),
  tree AS (SELECT domain, lang, source, sum(tokens * copies) AS total, sum(tokens * copies) * {M.MAX_EPOCHS} AS cap
      FROM entries GROUP BY ALL),
  l1 AS (SELECT domain, sum(cap) AS cap, {_case('domain')} AS w, (SELECT sum(total) FROM tree) AS budget FROM tree GROUP BY domain),
  {_share('s1', 'l1', 'domain', '')},
  l2 AS (SELECT t.*, {_case('lang')} AS w, s1.budget FROM (SELECT domain, lang, sum(cap) AS cap FROM tree GROUP BY ALL) t
      JOIN s1 USING (domain)),
  {_share('s2', 'l2', 'lang', 'domain')},
  l3 AS (SELECT t.*, {_case('source')} AS w, s2.budget FROM tree t JOIN s2 USING (domain, lang)),
  {_share('s3', 'l3', 'source', 'domain, lang')},
  placed AS (SELECT e.*, s3.budget // s3.total AS epochs, s3.budget % s3.total AS rest
      FROM entries e JOIN s3 USING (domain, lang, source) WHERE e.tokens > 0 AND s3.total > 0),
  hashed AS (SELECT *, md5('{M.SEED}:' || CAST(epochs AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), '') || ':'
      || text_md5) AS h FROM placed),
  at_ AS (SELECT *, greatest(rest - coalesce(sum(tokens * copies) OVER (PARTITION BY domain, lang, source ORDER BY h, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS open FROM hashed),
  counted AS (SELECT *, least(copies, (open + tokens - 1) // tokens) AS more FROM at_)
SELECT doc_id, domain, lang, source, CAST(tokens AS BIGINT) AS tokens, CAST(copies AS BIGINT) AS copies,
  CAST(epochs * copies + more AS BIGINT) AS times,
  CAST(CASE WHEN more > 0 AND more * tokens > open THEN open - (more - 1) * tokens ELSE tokens END AS BIGINT) AS last_take
FROM counted WHERE epochs * copies + more > 0"""


TOPK = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
  r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""


def url_filter(rules: list[tuple[str, str, str]]) -> str:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    return f"""WITH r(host, path, verdict) AS (VALUES {values}),
  a AS (SELECT row_number() OVER () AS n, page_id,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
  b AS (SELECT n, page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM a),
  p AS (SELECT n, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b),
  m AS (SELECT p.n, r.host || r.path AS rule, r.verdict, row_number() OVER (PARTITION BY p.n
      ORDER BY length(r.host || r.path) DESC, length(r.host) DESC, r.verdict DESC) AS k
    FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON m.n = p.n AND m.k = 1"""


_TERMS = """list_filter(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda t: t <> '')"""

LEXICAL = f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row_, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
  held AS (SELECT row_, doc_id, terms, len(terms) AS n FROM d WHERE len(terms) > 0),
  whole AS (SELECT CAST(count(*) AS HUGEINT) AS docs, CAST(sum(n) AS HUGEINT) AS total FROM held),
  normal AS (SELECT row_, doc_id, CAST(10 + (90 * n * docs) // total AS BIGINT) AS m FROM held, whole),
  i AS (SELECT row_number() OVER () AS item_row, item_id, list_distinct({_TERMS}) AS terms FROM benchmark WHERE text IS NOT NULL),
  asked AS (SELECT item_row, item_id, unnest(terms) AS term FROM i),
  postings AS MATERIALIZED (SELECT row_, term, count(*) AS tf FROM (SELECT row_, unnest(terms) AS term FROM held)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
  weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), whole),
  scored AS (SELECT item_row, item_id, row_, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN normal USING (row_) GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY item_row ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10"""
