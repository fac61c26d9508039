"""DuckDB SQL oracles for the registered queries.

Each oracle restates the operator's rules in plain SQL over the raw tables
(views ``documents``, ``labels``, ``pages``, ``events``, ``conversations``).
It never goes through the wrapped answers: expected events come straight
from ``documents``. Regexes are RE2 there, Java in Spark; the inputs are LF
only and ASCII-spaced, where the two agree (Unicode edge cases are covered by
pytest against a plain-Python statement of the rules).

Similarity oracles score every (probe, history) pair by brute force.
"""

from __future__ import annotations

from eventloom.sources import fixtures

RUN_TS = "2024-01-15 00:00:00"
DIM = 256
NL = "chr(10)"




def event_key(response_id: str, event_idx: str) -> str:
    return (f"lpad(CAST({response_id}::HUGEINT + 9223372036854775808 AS VARCHAR), 20, '0') || '-' || "
            f"lpad(CAST({event_idx} AS VARCHAR), 10, '0')")


# --------------------------------------------------------------------------- text rules

def trim(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def strip_reasoning(x: str) -> str:
    out = trim(f"string_split({x}, '</think>')[-1]")
    out = trim(f"regexp_replace({out}, '^```json', '')")
    out = trim(f"regexp_replace({out}, '^```', '')")
    return trim(f"regexp_replace({out}, '```$', '')")


def strip_citations(x: str) -> str:
    out = rf"regexp_replace({x}, '\[\d+\]', '', 'g')"
    return rf"regexp_replace({out}, '\[[A-Za-z][^\]]+\]', '', 'g')"


def strip_markdown(x: str) -> str:
    out = x
    for rule in (r"^#{1,6}\s*", r"^\s*[-*+]\s+", r"^\s*\d+\.\s+", r"^(?:-{3,}|\*{3,})$"):
        out = f"regexp_replace({out}, '(?m){rule}', '', 'g')"
    return f"regexp_replace({out}, '[*_]', '', 'g')"


def clean(x: str, citations: bool = True, markdown: bool = False) -> str:
    out = strip_reasoning(x)
    if citations:
        out = strip_citations(out)
    if markdown:
        out = strip_markdown(out)
    return trim(out)


def words(x: str) -> str:
    return rf"list_filter(string_split_regex({x}, '\s+'), lambda w: w <> '')"


def decorated(id_: str, text: str) -> str:
    marked = (
        f"CASE {id_} % 7 "
        f"WHEN 0 THEN '# ' || replace({text}, {NL}, {NL} || '## ') "
        f"WHEN 1 THEN '- ' || replace({text}, {NL}, {NL} || '* ') "
        f"WHEN 2 THEN '1. ' || replace({text}, {NL}, {NL} || '2. ') "
        f"WHEN 3 THEN '**' || {text} || '**' || {NL} || '---' "
        f"WHEN 4 THEN replace({text}, '. ', ' [1]. ') "
        f"WHEN 5 THEN {text} || ' [Reuters]' "
        f"ELSE {text} || {NL} || '***' || {NL} || '_end_' END"
    )
    return (
        f"CASE {id_} % 3 WHEN 1 THEN '<think>plan the answer</think>' || {NL} || ({marked}) "
        f"WHEN 2 THEN '```json' || {NL} || ({marked}) || {NL} || '```' ELSE ({marked}) END"
    )


# --------------------------------------------------------------------------- fixtures

def title_of(text: str) -> str:
    return f"split_part({text}, {NL}, 1)"


def raw_summary(doc_id: str, text: str) -> str:
    body = f"substr({text}, length({title_of(text)}) + 2)"
    cited = (
        f"CASE WHEN {doc_id} % 3 = 1 THEN {body} || ' [' || CAST({doc_id} % 9 + 1 AS VARCHAR) || ']' "
        f"WHEN {doc_id} % 3 = 2 THEN {body} || ' [Reuters]' ELSE {body} END"
    )
    return f"CASE WHEN {doc_id} % 4 = 3 THEN '## ' || ({cited}) ELSE ({cited}) END"


DOC_EV = f"""doc_ev AS (
  SELECT doc_id, doc_id // 5 AS response_id,
         row_number() OVER (PARTITION BY doc_id // 5 ORDER BY doc_id) - 1 AS event_idx,
         {title_of('text')} AS title,
         {raw_summary('doc_id', 'text')} AS summary_raw,
         (doc_id // 5) % 10 AS style,
         CASE WHEN (doc_id // 5) % 11 = 0 THEN 500 ELSE 200 END AS status
  FROM documents)"""

DECODED = """decoded AS (
  SELECT response_id, event_idx, title,
         CASE WHEN style = 5 AND doc_id % 5 = 0 THEN NULL ELSE summary_raw END AS summary
  FROM doc_ev WHERE status = 200 AND style IN (0, 1, 2, 3, 4, 5, 7))"""

BUILT = f"""built AS (
  SELECT 'event_' || substr(sha256(title), 1, 16) AS event_id, title,
         {clean('summary_raw', True, True)} AS summary,
         response_id, event_idx, {event_key('response_id', 'event_idx')} AS ord
  FROM doc_ev)"""

SEED = f"""seed AS (
  SELECT 'event_' || substr(sha256(title), 1, 16) AS event_id, title,
         {clean('summary_raw', True, True)} AS summary, {event_key('doc_id', '0')} AS ord
  FROM (SELECT doc_id, {title_of('text')} AS title, {raw_summary('doc_id', 'text')} AS summary_raw
        FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)))"""

CORPUS = rf"""corpus AS (
  SELECT page_id, url, to_timestamp(page_id * 600 + 1704067200 + 13 * 86400) AT TIME ZONE 'UTC' AS ts,
         array_to_string(list_transform(regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1),
                                        lambda p: regexp_replace(p, '<[^>]*>', ' ', 'g')), ' ') AS content
  FROM pages)"""


def emb(name: str, src: str) -> str:
    """Sparse L2-normalised bigram hash vectors ``{name}(id, dim_index, value)``; src has (id, text)."""
    return f"""{name}_tok AS (SELECT id, {words('lower(text)')} AS t FROM {src}),
{name}_term AS (
  SELECT id, unnest(CASE WHEN len(t) >= 2 THEN list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])
                         ELSE t END) AS term
  FROM {name}_tok),
{name}_code AS (SELECT id, ('0x' || substr(md5(term), 1, 8))::BIGINT AS code FROM {name}_term),
{name}_cell AS (
  SELECT id, (code >> 4) % {DIM} AS dim_index, sum(1 - 2 * (code & 1))::DOUBLE AS w
  FROM {name}_code GROUP BY ALL),
{name}_norm AS (SELECT id, sqrt(sum(w * w)) AS nrm FROM {name}_cell GROUP BY id),
{name} AS (
  SELECT c.id, c.dim_index, c.w / n.nrm AS value
  FROM {name}_cell c JOIN {name}_norm n USING (id) WHERE c.w <> 0)"""


def bm25(queries: str, where: str = "true") -> str:
    """``results(event_id, rank, page_id, url, content, score)``; queries has (event_id, query)."""
    return f"""{CORPUS},
ptok AS (SELECT page_id, {words('lower(content)')} AS t FROM corpus WHERE {where}),
plen AS (SELECT page_id, len(t) AS dl FROM ptok),
pstats AS (SELECT count(*) AS n, sum(dl)::DOUBLE / count(*) AS avgdl FROM plen),
ptf AS (SELECT page_id, term, count(*) AS tf FROM (SELECT page_id, unnest(t) AS term FROM ptok) GROUP BY ALL),
pdf AS (SELECT term, count(*) AS df FROM ptf GROUP BY term),
qterm AS (SELECT event_id, unnest(list_distinct({words('lower(query)')})) AS term FROM {queries}),
scored AS (
  SELECT q.event_id, f.page_id,
         sum(ln(1 + (s.n - d.df + 0.5) / (d.df + 0.5)) * f.tf * 2.2
             / (f.tf + 1.2 * (0.25 + 0.75 * l.dl / s.avgdl))) AS score
  FROM qterm q JOIN ptf f USING (term) JOIN pdf d USING (term) JOIN plen l USING (page_id), pstats s
  GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY round(score, 6) DESC, page_id) AS rank
  FROM scored),
results AS (
  SELECT r.event_id, r.rank, r.page_id, c.url, c.content, r.score
  FROM ranked r JOIN corpus c USING (page_id) WHERE r.rank <= 15)"""


def excerpt_agg(max_chars: int | None) -> str:
    whole = f"""coalesce(string_agg(content, {NL} || {NL} ORDER BY rank)
                         FILTER (WHERE content IS NOT NULL AND content <> ''), '')"""
    return whole if max_chars is None else f"substr({whole}, 1, {max_chars})"


AGG = f"""src_first AS (
  SELECT event_id, url, min(rank) AS r FROM results WHERE url IS NOT NULL AND url <> '' GROUP BY ALL),
src AS (SELECT event_id, string_agg(url, ' ' ORDER BY r) AS sources, count(*) AS n_sources
        FROM src_first GROUP BY event_id),
exc AS (
  SELECT event_id,
         {excerpt_agg(8000)} AS excerpts,
         count(*) AS n_results
  FROM results GROUP BY event_id)"""


def enriched(events: str) -> str:
    """``enriched``: events (event_id, ...) with story and sources text."""
    return f"""{AGG},
enriched AS (
  SELECT e.*, CASE WHEN x.n_results > 0 THEN {trim('x.excerpts')} ELSE '' END AS story,
         CASE WHEN x.n_results > 0 THEN coalesce(s.sources, '') ELSE '' END AS sources
  FROM {events} e LEFT JOIN exc x USING (event_id) LEFT JOIN src s USING (event_id))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


QUERIES_FROM_BUILT = "qsrc AS (SELECT event_id, min(title) AS query FROM built GROUP BY event_id)"

LABEL_SPLIT = """lab AS (SELECT DISTINCT doc_id FROM labels)"""


def _doc_pairs() -> str:
    """All (unlabelled probe, labelled history) pairs with exact cosine."""
    return f"""{LABEL_SPLIT},
dsrc AS (SELECT doc_id AS id, text FROM documents),
{emb('dv', 'dsrc')},
hv AS (SELECT * FROM dv WHERE id IN (SELECT doc_id FROM lab)),
pv AS (SELECT * FROM dv WHERE id NOT IN (SELECT doc_id FROM lab)),
dots AS (SELECT p.id AS probe_id, h.id AS match_id, sum(p.value * h.value) AS dot
         FROM pv p JOIN hv h USING (dim_index) GROUP BY ALL),
pids AS (SELECT DISTINCT id FROM pv),
hids AS (SELECT DISTINCT id FROM hv),
pairs AS (
  SELECT pids.id AS probe_id, hids.id AS match_id, coalesce(dots.dot, 0.0) AS score
  FROM pids CROSS JOIN hids
  LEFT JOIN dots ON dots.probe_id = pids.id AND dots.match_id = hids.id),
ranked_pairs AS (
  SELECT *, row_number() OVER (PARTITION BY probe_id ORDER BY round(score, 9) DESC, match_id) AS rank
  FROM pairs)"""


#: Vectors of the run's events and of the seed's latest-wins view (one per event id, highest ord).
RUN_VECTORS = (
    "bsrc AS (SELECT ord AS id, title || ' ' || summary AS text FROM built)",
    emb("bv", "bsrc"),
    "ssrc AS (SELECT ord AS id, title || ' ' || summary AS text FROM seed)",
    emb("sv", "ssrc"),
    "seed_latest AS (SELECT event_id, max(ord) AS ord FROM seed GROUP BY event_id)",
    "svl AS (SELECT * FROM sv WHERE id IN (SELECT ord FROM seed_latest))",
)

SURVIVORS = (
    """bdots AS (SELECT b.id, sum(b.value * s.value) AS dot
                 FROM bv b JOIN svl s USING (dim_index) GROUP BY b.id, s.id)""",
    "dups AS (SELECT DISTINCT id FROM bdots WHERE dot >= 0.8)",
    "survivors AS (SELECT * FROM built WHERE ord NOT IN (SELECT id FROM dups))",
)

RUN_QUERIES = "qsrc AS (SELECT event_id, min(title) AS query FROM survivors GROUP BY event_id)"

#: The queries that a caller supplies: the titles of events of an even index, under a line of their own.
SUPPLIED = """even AS (SELECT event_id, min(title) AS title FROM built WHERE event_idx % 2 = 0 GROUP BY event_id),
qsrc AS (SELECT v.event_id, min(coalesce(regexp_replace('news on ' || e.title, '\\s+$', ''), v.title)) AS query
         FROM survivors v LEFT JOIN even e USING (event_id) GROUP BY v.event_id)"""


def _pipeline_articles(queries: str = RUN_QUERIES, where: str = "true", survivors: tuple[str, ...] = SURVIVORS) -> str:
    """Articles of one run: events of the answers vs the labelled seed, survivors enriched."""
    return _with(DOC_EV, DECODED, BUILT, SEED, *RUN_VECTORS, *survivors, queries, bm25("qsrc", where), enriched("survivors"))


def _micro_batches(parts: int) -> tuple[str, ...]:
    """``survivors`` of a run in ``parts`` batches: each is held against the seed and the survivors before it,
    of which the latest per event id counts."""
    near = "sum(a.value * b.value) >= 0.8"
    ctes = [
        "rng AS (SELECT min(doc_id // 5) AS f, max(doc_id // 5) AS l FROM documents)",
        f"part AS (SELECT built.*, (response_id - f) * {parts} // (l - f + 1) AS part FROM built, rng)",
        f"near_seed AS (SELECT a.id AS ord, b.id AS other FROM bv a JOIN sv b USING (dim_index) GROUP BY ALL HAVING {near})",
        f"""near_run AS (SELECT a.id AS ord, b.id AS other FROM bv a JOIN bv b USING (dim_index)
            JOIN part x ON x.ord = a.id JOIN part y ON y.ord = b.id AND y.part < x.part GROUP BY ALL HAVING {near})""",
    ]
    stored = "SELECT event_id, ord, 0 AS version, true AS seeded FROM seed"
    for i in range(parts):
        ctes.append(f"""h{i} AS (SELECT * FROM ({stored})
            QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY version DESC, ord DESC) = 1)""")
        ctes.append(f"""s{i} AS (SELECT * FROM part WHERE part = {i}
            AND ord NOT IN (SELECT n.ord FROM near_seed n JOIN h{i} h ON h.seeded AND h.ord = n.other)
            AND ord NOT IN (SELECT n.ord FROM near_run n JOIN h{i} h ON NOT h.seeded AND h.ord = n.other))""")
        stored += f" UNION ALL SELECT event_id, ord, {i + 1}, false FROM s{i}"
    ctes.append("survivors AS (" + " UNION ALL ".join(f"SELECT *, CAST({i + 1} AS BIGINT) AS batch_id FROM s{i}" for i in range(parts)) + ")")
    return tuple(ctes)


def _json_text(x: str) -> str:
    return f"CAST(to_json({x}) AS VARCHAR)"


def _answer() -> str:
    """The answer text of each response, in the style of its id."""
    items = (
        "string_agg(CASE WHEN style = 5 AND doc_id % 5 = 0 THEN '{\"title\":' || " + _json_text("title") + " || '}' "
        "ELSE '{\"title\":' || " + _json_text("title") + " || ',\"summary\":' || " + _json_text("summary_raw") + " || '}' END, ',' ORDER BY doc_id)"
    )
    text = lambda t: "'" + t.replace("'", "''").replace("\n", f"' || {NL} || '") + "'"
    obj = "'{\"events\":[' || items || ']}'"
    return f"""answer AS (
  SELECT response_id, status, CASE style
           WHEN 1 THEN {text(chr(96) * 3 + "json" + chr(10))} || {obj} || {text(chr(10) + chr(96) * 3)}
           WHEN 2 THEN {text(fixtures.THINK_TEXT + chr(96) * 3 + "json" + chr(10))} || {obj} || {text(chr(10) + chr(96) * 3)}
           WHEN 3 THEN {text(fixtures.PROSE_BEFORE)} || {obj} || {text(fixtures.PROSE_AFTER)}
           WHEN 4 THEN '[' || items || ']'
           WHEN 6 THEN {text(fixtures.NO_JSON_TEXT)}
           WHEN 7 THEN {text(fixtures.FENCE_LEAD)} || {obj} || {text(fixtures.FENCE_TAIL)}
           WHEN 8 THEN '{{"events":"none"}}'
           WHEN 9 THEN '{{"results":[' || items || ']}}'
           ELSE {obj} END AS content
  FROM (SELECT response_id, min(status) AS status, min(style) AS style, {items} AS items FROM doc_ev GROUP BY response_id))"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    q["read_responses"] = _with(DOC_EV, _answer()) + """
SELECT response_id, CAST(status AS BIGINT) AS status, content,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST(response_id * 997 AS DOUBLE)), '%Y-%m-%d %H:%M:%S') AS ts
FROM answer"""

    q["split_by_status"] = """
SELECT DISTINCT doc_id // 5 AS response_id, (doc_id // 5) % 11 <> 0 AS accepted,
       CASE WHEN (doc_id // 5) % 11 = 0 THEN 'status_500' END AS reason
FROM documents"""

    q["day_window"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value
FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'"""

    dec = f"(SELECT doc_id, source, {decorated('doc_id', 'text')} AS text FROM documents)"
    q["strip_reasoning"] = f"SELECT doc_id, {strip_reasoning('text')} AS text FROM {dec}"
    q["strip_citations"] = f"SELECT doc_id, {strip_citations('text')} AS text FROM {dec}"
    q["strip_markdown"] = f"SELECT doc_id, {strip_markdown('text')} AS text FROM {dec}"
    q["clean_table"] = f"""
SELECT conv_id, turn, role, {clean('text', True, True)} AS text
FROM (SELECT conv_id, turn, role, {decorated('(conv_id * 1000 + turn)', 'text')} AS text FROM conversations)"""
    q["cleaning_report"] = f"""
SELECT source, count(*) AS n_rows, count_if(raw <> clean) AS n_changed,
       sum(length(raw) - length(clean)) AS chars_removed
FROM (SELECT source, text AS raw, {clean('text', True, True)} AS clean FROM {dec})
GROUP BY source"""

    q["extract_events"] = _with(DOC_EV, DECODED) + "SELECT response_id, event_idx, title, summary FROM decoded"
    q["extract_quarantine"] = _with(DOC_EV) + """
SELECT DISTINCT response_id, CASE style WHEN 6 THEN 'no_json' ELSE 'events_not_array' END AS reason
FROM doc_ev WHERE status = 200 AND style IN (6, 8)"""
    q["contract_split"] = _with(DOC_EV, DECODED) + """
SELECT response_id, event_idx, summary IS NOT NULL AS accepted,
       CASE WHEN summary IS NULL THEN 'missing_summary' END AS reason
FROM decoded"""
    q["contract_report"] = _with(DOC_EV, DECODED) + """
SELECT response_id, count(*) AS n_events, greatest(count(*) - 5, 0) AS n_over_requested,
       count_if(length(title) > 90) AS n_long_titles, count_if(length(summary) > 500) AS n_long_summaries,
       count_if(summary IS NULL OR title IS NULL) AS n_incomplete
FROM decoded GROUP BY response_id"""
    q["build_events"] = _with(DOC_EV, DECODED, BUILT) + f"""
SELECT event_id, '{RUN_TS}' AS date, title, summary, '' AS story, CAST(0 AS BIGINT) AS n_sources,
       response_id, event_idx
FROM built"""

    q["overview_text"] = _with(DOC_EV, DECODED, BUILT) + """
SELECT response_id, event_idx, title || ' ' || summary AS overview FROM built"""
    q["embed_table"] = _with("dsrc AS (SELECT doc_id AS id, text FROM documents)", emb("dv", "dsrc")) + """
SELECT id AS doc_id, CAST(dim_index AS BIGINT) AS dim_index, round(value, 6) AS value FROM dv"""

    q["similarity_topk"] = _with(_doc_pairs()) + """
SELECT probe_id, match_id, round(score, 6) AS score, rank FROM ranked_pairs WHERE rank <= 5"""
    q["similarity_topk_grid"] = q["similarity_topk"]
    q["similarity_join_lsh"] = _with(_doc_pairs()) + """
SELECT probe_id, match_id, round(score, 6) AS score FROM pairs WHERE score >= 0.8"""
    q["join_embeddings"] = """
SELECT d.doc_id, CAST(len(e.embedding) AS BIGINT) AS n,
       round(list_sum(list_transform(e.embedding, lambda x, i: x::DOUBLE * i)), 6) AS weight
FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id"""
    q["flag_duplicates"] = _with(_doc_pairs()) + """
SELECT d.doc_id AS probe_id, coalesce(r.score >= 0.8, false) AS is_duplicate,
       round(r.score, 6) AS best_score, r.match_id AS best_match_id
FROM documents d LEFT JOIN ranked_pairs r ON r.probe_id = d.doc_id AND r.rank = 1
WHERE d.doc_id NOT IN (SELECT doc_id FROM lab)"""
    q["semantic_anti_join"] = _with(_doc_pairs()) + """
SELECT doc_id FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM lab)
  AND doc_id NOT IN (SELECT probe_id FROM pairs WHERE score >= 0.8)"""
    q["semantic_anti_join_batch"] = _with(
        _doc_pairs(),
        """self_dots AS (SELECT a.id AS probe_id, b.id AS earlier_id, sum(a.value * b.value) AS dot
                     FROM pv a JOIN pv b ON a.dim_index = b.dim_index AND b.id < a.id GROUP BY ALL)""",
    ) + """
SELECT doc_id FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM lab)
  AND doc_id NOT IN (SELECT probe_id FROM pairs WHERE score >= 0.8)
  AND doc_id NOT IN (SELECT probe_id FROM self_dots WHERE dot >= 0.8)"""

    q["build_queries"] = _with(DOC_EV, DECODED, BUILT) + """
SELECT event_id, min(title) AS query, length(min(title)) > 250 AS query_too_long FROM built GROUP BY event_id"""
    retrieval = _with(DOC_EV, DECODED, BUILT, QUERIES_FROM_BUILT, bm25("qsrc"))
    q["retrieve_topk"] = retrieval + "SELECT event_id, rank, page_id, round(score, 6) AS score FROM results"
    q["retrieve_topk_shuffle"] = q["retrieve_topk"]
    q["retrieve_topk_day"] = _with(DOC_EV, DECODED, BUILT, QUERIES_FROM_BUILT, bm25(
        "qsrc", "ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'"
    )) + "SELECT event_id, rank, page_id, round(score, 6) AS score FROM results"
    q["build_queries_supplied"] = _with(DOC_EV, DECODED, BUILT) + """
, even AS (SELECT event_id, min(title) AS title FROM built WHERE event_idx % 2 = 0 GROUP BY event_id),
src AS (SELECT b.event_id, coalesce(regexp_replace('news on ' || e.title, '\\s+$', ''), b.title) AS query
        FROM built b LEFT JOIN even e USING (event_id))
SELECT event_id, min(query) AS query, length(min(query)) > 250 AS query_too_long FROM src GROUP BY event_id"""
    q["collect_excerpts_full"] = retrieval + f""", exc_full AS (
  SELECT event_id, {excerpt_agg(None)} AS excerpts FROM results GROUP BY event_id)
SELECT event_id, excerpts FROM exc_full"""
    q["collect_sources"] = _with(DOC_EV, DECODED, BUILT, QUERIES_FROM_BUILT, bm25("qsrc"), AGG) + """
SELECT e.event_id, coalesce(s.sources, '') AS sources, coalesce(s.n_sources, 0) AS n_sources
FROM (SELECT DISTINCT event_id FROM results) e LEFT JOIN src s USING (event_id)"""
    q["collect_excerpts"] = _with(DOC_EV, DECODED, BUILT, QUERIES_FROM_BUILT, bm25("qsrc"), AGG) + """
SELECT event_id, excerpts FROM exc"""
    enrich = _with(DOC_EV, DECODED, BUILT, QUERIES_FROM_BUILT, bm25("qsrc"), enriched("built"))
    q["enrich_events"] = enrich + "SELECT event_id, response_id, event_idx, story, sources FROM enriched"

    q["enrich_events_articles"] = enrich.rstrip() + f""",
odd AS (SELECT event_id, min(summary) || ' [3] [Reuters]' AS article FROM built WHERE event_idx % 2 = 1 GROUP BY event_id),
cleaned AS (SELECT event_id, {clean('article', True, False)} AS article FROM odd)
SELECT e.event_id, e.response_id, e.event_idx,
       CASE WHEN x.event_id IS NULL THEN e.story ELSE coalesce({trim('c.article')}, e.story) END AS story, e.sources
FROM enriched e LEFT JOIN cleaned c USING (event_id) LEFT JOIN exc x USING (event_id)"""

    q["chunk_table"] = f"""
WITH w AS (SELECT doc_id, {words('text')} AS ws FROM documents),
c AS (SELECT doc_id, ws, unnest(range(0, CAST(ceil(len(ws) / 300.0) AS BIGINT))) AS chunk_index FROM w)
SELECT doc_id, chunk_index, array_to_string(ws[chunk_index * 300 + 1 : chunk_index * 300 + 300], ' ') AS chunk
FROM c"""
    q["overview_vectors"] = _with(
        DOC_EV, DECODED, BUILT,
        "bsrc AS (SELECT ord AS id, title || ' ' || summary AS text FROM built)", emb("bv", "bsrc"),
    ) + """
SELECT 'deduplication' AS namespace, b.event_id AS id, b.event_id, b.title, b.summary,
       (SELECT count(*) FROM bv WHERE bv.id = b.ord) AS nnz,
       round(coalesce((SELECT sum(value * (dim_index + 1)) FROM bv WHERE bv.id = b.ord), 0.0), 6) AS weight, b.ord
FROM built b"""
    q["chunk_vectors"] = _with(
        DOC_EV, DECODED, BUILT, QUERIES_FROM_BUILT, bm25("qsrc"), enriched("built"),
        f"""ch AS (
  SELECT event_id, title, sources, ord, ws, unnest(range(0, CAST(ceil(len(ws) / 300.0) AS BIGINT))) AS chunk_index
  FROM (SELECT event_id, title, sources, ord, {words('story')} AS ws FROM enriched WHERE story <> ''))""",
        """chunks AS (SELECT event_id, title, sources, ord, chunk_index,
                   array_to_string(ws[chunk_index * 300 + 1 : chunk_index * 300 + 300], ' ') AS text FROM ch)""",
        "csrc AS (SELECT ord || '/' || chunk_index AS id, text FROM chunks)", emb("cv", "csrc"),
        "cnnz AS (SELECT id, count(*) AS nnz, sum(value * (dim_index + 1)) AS weight FROM cv GROUP BY id)",
    ) + """
SELECT 'research' AS namespace, c.event_id || '_chunk_' || CAST(c.chunk_index AS VARCHAR) AS id, c.event_id,
       c.title, c.chunk_index, c.text, c.sources, coalesce(n.nnz, 0) AS nnz, round(coalesce(n.weight, 0.0), 6) AS weight, c.ord
FROM chunks c LEFT JOIN cnnz n ON n.id = c.ord || '/' || c.chunk_index"""

    upsert = _with(
        DOC_EV, DECODED, BUILT, SEED,
        """log AS (
  SELECT 'deduplication' AS namespace, event_id AS id, 0 AS version, title, summary, ord FROM seed
  UNION ALL
  SELECT 'deduplication', event_id, 1, title, summary, ord FROM built)""",
        """newest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY namespace, id ORDER BY version DESC, ord DESC) AS rn FROM log)
  WHERE rn = 1)""",
        "nsrc AS (SELECT id, title || ' ' || summary AS text FROM newest)", emb("nv", "nsrc"),
        "nw AS (SELECT id, count(*) AS nnz, sum(value * (dim_index + 1)) AS weight FROM nv GROUP BY id)",
    ) + """
SELECT namespace, n.id, CAST(version AS BIGINT) AS version, title, summary, coalesce(nnz, 0) AS nnz,
       round(coalesce(weight, 0.0), 6) AS weight, ord
FROM newest n LEFT JOIN nw ON nw.id = n.id"""
    q["upsert_vectors"] = upsert
    q["compact_vectors"] = upsert
    q["append_articles"] = enrich + """
SELECT event_id, CAST(1 AS BIGINT) AS batch_id, title, story, sources, ord FROM enriched"""

    doc_chunks = f"""w AS (SELECT doc_id, {words('text')} AS ws FROM documents WHERE text <> ''),
c AS (SELECT doc_id, ws, unnest(range(0, CAST(ceil(len(ws) / 300.0) AS BIGINT))) AS chunk_index FROM w),
ch AS (SELECT doc_id, chunk_index, 'event_' || doc_id || '_chunk_' || chunk_index AS id,
              array_to_string(ws[chunk_index * 300 + 1 : chunk_index * 300 + 300], ' ') AS text FROM c)"""
    q["prune_stale"] = _with(doc_chunks) + """
SELECT id, 'event_' || doc_id AS event_id, chunk_index, text, CAST(1 AS BIGINT) AS version FROM ch WHERE doc_id % 2 = 0"""
    q["research_search"] = _with(
        doc_chunks, "csrc AS (SELECT id, text FROM ch)", emb("cv", "csrc"),
        "psrc AS (SELECT doc_id AS id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))", emb("qv", "psrc"),
        """hits AS (SELECT q.id AS doc_id, c.id AS chunk, sum(q.value * c.value) AS score
                 FROM qv q JOIN cv c USING (dim_index) GROUP BY ALL)""",
        """pid AS (SELECT DISTINCT id AS doc_id FROM qv)""", """cid AS (SELECT DISTINCT id AS chunk FROM cv)""",
        """allp AS (SELECT pid.doc_id, cid.chunk, coalesce(h.score, 0.0) AS score
                 FROM pid CROSS JOIN cid LEFT JOIN hits h ON h.doc_id = pid.doc_id AND h.chunk = cid.chunk)""",
        """rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, chunk) AS rank FROM allp)""",
    ) + "SELECT doc_id, chunk, round(score, 6) AS score, rank FROM rk WHERE rank <= 3"
    q["run_quarantine"] = _with(DOC_EV, DECODED) + """
SELECT DISTINCT response_id, CAST(NULL AS BIGINT) AS event_idx,
       CASE WHEN status <> 200 THEN 'status_500' WHEN style = 6 THEN 'no_json' ELSE 'events_not_array' END AS reason
FROM doc_ev WHERE status <> 200 OR style IN (6, 8)
UNION ALL
SELECT response_id, event_idx, 'missing_summary' FROM decoded WHERE summary IS NULL"""

    q["run_quarantine_lines"] = _with(DOC_EV, DECODED) + """
SELECT DISTINCT response_id, CAST(NULL AS BIGINT) AS event_idx,
       CASE WHEN status <> 200 THEN 'status_500' WHEN style = 6 THEN 'no_json' ELSE 'events_not_array' END AS reason
FROM doc_ev WHERE (status <> 200 OR style IN (6, 8)) AND response_id % 13 <> 4
UNION ALL
SELECT response_id, event_idx, 'missing_summary' FROM decoded WHERE summary IS NULL AND response_id % 13 <> 4
UNION ALL
SELECT NULL, NULL, 'malformed_line' FROM (SELECT DISTINCT response_id FROM doc_ev WHERE response_id % 13 = 4)"""

    out = "SELECT event_id, title, summary, story, sources, ord FROM enriched"
    q["run_pipeline"] = _pipeline_articles() + out
    q["stream_pipeline"] = q["run_pipeline"]
    q["run_pipeline_day"] = _pipeline_articles(where="ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'") + out
    q["run_pipeline_supplied"] = _pipeline_articles(SUPPLIED).rstrip() + f""",
odd AS (SELECT event_id, min(summary) || ' [3] [Reuters]' AS article FROM built WHERE event_idx % 2 = 1 GROUP BY event_id),
cleaned AS (SELECT event_id, {clean('article', True, False)} AS article FROM odd)
SELECT e.event_id, e.title, e.summary,
       CASE WHEN x.event_id IS NULL THEN e.story ELSE coalesce({trim('c.article')}, e.story) END AS story, e.sources, e.ord
FROM enriched e LEFT JOIN cleaned c USING (event_id) LEFT JOIN exc x USING (event_id)"""
    q["stream_micro_batches"] = _pipeline_articles(survivors=_micro_batches(3)) + "SELECT event_id, title, summary, story, sources, ord, batch_id FROM enriched"
    q["pipeline_stats"] = _with(DOC_EV, DECODED, BUILT, SEED, *RUN_VECTORS, *SURVIVORS) + """
SELECT count(*) AS total, count(*) FILTER (WHERE ord IN (SELECT id FROM dups)) AS duplicates,
       count(*) FILTER (WHERE ord NOT IN (SELECT id FROM dups)) AS stored, CAST(0 AS BIGINT) AS rejected
FROM built"""
    return q
