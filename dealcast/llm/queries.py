"""The registered queries of the operators, and their DuckDB SQL.

``REGISTRY``: name -> (builder, SQL or None). Each builder takes
``(spark, sf_dir)``, applies its operator to its whole table and returns the
contract's columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from dealcast.llm.common import table

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# A-Z to lower case, nothing else
_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


# ---------------------------------------------------------------- 1 decontamination

@query("op1_decontamination", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(""" + _LOWER.format("text") + r""", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(""" + _LOWER.format("text") + r""", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item, least(13, len(w)) AS l, array_to_string(w[k:k + 12], ' ') AS g
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT l FROM win),
spots AS (SELECT doc_id, l, s, array_to_string(w[s:s + l - 1], ' ') AS g
          FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM d, lens WHERE len(w) >= l)),
hit AS (SELECT doc_id, s, spots.l AS l, item FROM spots JOIN win ON spots.g = win.g AND spots.l = win.l),
cover AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(cover.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(cover.n, 0) > 0 AND 20 * coalesce(cover.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op1(spark, d):
    from dealcast.llm import decontaminate as op
    return op.digest(op.decontaminate(table(spark, d, "documents"), table(spark, d, "benchmark")))


# ---------------------------------------------------------------- 2 near duplicates

@query("op2_near_duplicates", r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(""" + _LOWER.format("text") + r""", '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' ')) ELSE w END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 80 * (p.n + q.n - k)),
both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id, doc_id AS r FROM n UNION SELECT reach.doc_id, both_ways.y FROM reach JOIN both_ways ON reach.r = both_ways.x),
low AS (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(low.r, doc_id) AS component_id, doc_id = coalesce(low.r, doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)""")
def op2(spark, d):
    from dealcast.llm.neardup import near_duplicates
    return near_duplicates(table(spark, d, "documents"), size=2, percent=80)


# ---------------------------------------------------------------- 3 toxicity, 5 quality: trained, so no SQL

@query("op3_toxicity")
def op3(spark, d):
    from dealcast.llm.toxicity import toxicity
    return toxicity(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op5_quality")
def op5(spark, d):
    from dealcast.llm.quality import quality
    return quality(table(spark, d, "documents"), table(spark, d, "labels"))


# ---------------------------------------------------------------- 7 packing: a search, so no SQL

@query("op7_packing")
def op7(spark, d):
    from dealcast.llm.packing import packed_pieces
    return packed_pieces(table(spark, d, "documents"))


# ---------------------------------------------------------------- the pipeline

@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, d):
    return corpus_pipeline.run(spark, d)


# ---------------------------------------------------------------- 10 token files: a tokenizer, so no SQL

@query("op10_token_files")
def op10(spark, d):
    from dealcast.llm.tokenfiles import round_trip
    return round_trip(table(spark, d, "documents"))


# ---------------------------------------------------------------- 6 language: trained, so no SQL

@query("op6_language")
def op6(spark, d):
    from dealcast.llm.language import language
    return language(table(spark, d, "documents"))


# ---------------------------------------------------------------- 4 neighbours: approximate, so no SQL

@query("op4_neighbours")
def op4(spark, d):
    from dealcast.llm.neighbours import nearest
    return nearest(table(spark, d, "embeddings"), query_every=50, top=5)


# ---------------------------------------------------------------- 8 archive revisits

@query("op8_revisits", r"""
WITH p AS (SELECT page_id AS p, url, md5(coalesce(html, '')) AS dig, 1700000000 + ((page_id * 7919) % 100000) * 60 AS ts FROM pages),
c AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM p),
s AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '')
        || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS front,
        list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*\?(.*)$', 1), '&'),
                  lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS args FROM c),
k AS (SELECT p, ts, dig, front || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END AS site FROM s),
resp AS (SELECT p * 4 AS rid, site, ts, dig FROM k),
rev AS (
  SELECT p * 4 + 1 AS rid, site, ts + 3600 AS vts, '"' || dig || '"' AS etag, NULL AS modified, 'max-age=60' AS cc, NULL AS ex FROM k WHERE p % 2 = 0
  UNION ALL SELECT p * 4 + 2, site, ts + 7200 + (p % 7) * 3600, NULL, CAST(ts - 86400 AS VARCHAR), NULL, '0' FROM k WHERE p % 3 = 0 AND p % 9 <> 0
  UNION ALL SELECT p * 4 + 2, site, ts + 7200 + (p % 7) * 3600, '"other"', NULL, NULL, NULL FROM k WHERE p % 9 = 0
  UNION ALL SELECT p * 4 + 3, site, ts - 1800, NULL, NULL, NULL, NULL FROM k WHERE p % 5 = 0),
last AS (SELECT v.rid, max(r.ts) AS lts FROM rev v JOIN resp r ON r.site = v.site AND r.ts < v.vts GROUP BY v.rid),
pick AS (SELECT l.rid, max(r.rid) AS ref FROM last l JOIN rev v ON v.rid = l.rid JOIN resp r ON r.site = v.site AND r.ts = l.lts GROUP BY l.rid),
j AS (SELECT v.*, r.rid AS ref, r.ts AS rts, r.dig AS rdig,
        CASE WHEN r.rid IS NULL THEN 'orphan'
             WHEN v.etag IS NOT NULL THEN CASE WHEN v.etag = '"' || r.dig || '"' THEN 'resolved' ELSE 'mismatch' END
             WHEN v.modified IS NOT NULL THEN CASE WHEN v.modified = CAST(r.ts - 86400 AS VARCHAR) THEN 'resolved' ELSE 'mismatch' END
             ELSE 'unverified' END AS outcome
      FROM rev v LEFT JOIN pick USING (rid) LEFT JOIN resp r ON r.rid = pick.ref)
SELECT rid AS record_id, site, vts AS ts, ref AS refers_to, outcome,
  CASE WHEN outcome IN ('resolved', 'unverified') THEN
    coalesce('cache-control: ' || cc || chr(10), '') || 'content-type: text/html' || chr(10) || 'date: ' || vts || chr(10)
    || 'etag: ' || CASE WHEN etag IS NOT NULL THEN 'W/' || etag ELSE '"' || rdig || '"' END || chr(10)
    || coalesce('expires: ' || ex || chr(10), '') || 'last-modified: ' || (rts - 86400) || chr(10) || 'server: a' END AS headers,
  CASE WHEN outcome IN ('resolved', 'unverified') THEN rdig END AS payload_digest
FROM j""")
def op8(spark, d):
    from dealcast.llm import revisits as op
    return op.digest(op.resolve_revisits(op.crawl_of_pages(table(spark, d, "pages"))))


# ---------------------------------------------------------------- 9 perspectives

@query("op9_perspectives", r"""
WITH t AS (SELECT conv_id, replace(coalesce(role, 'unknown'), '<|', '< |') AS r, replace(coalesce(text, ''), '<|', '< |') AS x,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, replace(coalesce(role, 'unknown'), '<|', '< |'),
                                replace(coalesce(text, ''), '<|', '< |')) - 1 AS pos FROM conversations),
v AS (SELECT DISTINCT conv_id AS c, r AS perspective FROM t WHERE r <> 'system'),
seg AS (SELECT conv_id, perspective, pos, pos // 256 AS block, r, length(head) AS lead, head || x || '<|end|>' || chr(10) AS s
        FROM (SELECT t.*, v.perspective, CASE WHEN r = perspective THEN '<|assistant|>' || chr(10) WHEN r = 'system' THEN '<|system|>' || chr(10)
                ELSE '<|user name=' || r || '|>' || chr(10) END AS head FROM t JOIN v ON t.conv_id IS NOT DISTINCT FROM v.c)),
pos AS (SELECT *, sum(length(s)) OVER (PARTITION BY conv_id, perspective, block ORDER BY pos) - length(s) AS p FROM seg)
SELECT conv_id, perspective, CAST(block AS BIGINT) AS block, count(*) AS n_turns, string_agg(s, '' ORDER BY pos) AS rendered,
  coalesce(string_agg(CASE WHEN r = perspective THEN CAST(p + lead AS BIGINT) || '-' || CAST(p + length(s) - 1 AS BIGINT) END, ',' ORDER BY pos), '') AS mask
FROM pos GROUP BY conv_id, perspective, block""")
def op9(spark, d):
    from dealcast.llm import perspectives as op
    return op.digest(op.perspectives(table(spark, d, "conversations")))


# ---------------------------------------------------------------- 11 vector packing: a tokenizer, so no SQL

@query("op11_vector_packing")
def op11(spark, d):
    from dealcast.llm.vectorpack import pack_examples
    return pack_examples(table(spark, d, "documents"), keep_ids=False)


# ---------------------------------------------------------------- 12 Merkle manifest

def _field(x: str) -> str:
    return f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"


@query("op12_merkle_manifest", r"""
WITH RECURSIVE d AS (SELECT doc_id, lang, sha256(""" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", "text"))) + """) AS leaf,
  sha256(""" + " || ".join(map(_field, ("doc_id", "source", "lang", "(n_chars + 1)", "text"))) + """) AS changed FROM documents),
crc AS (SELECT doc_id, doc_id IS NOT NULL AND xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
          lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda z, k: xor(z >> 1, CASE WHEN z & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 7 = 0 AS hit
        FROM (SELECT DISTINCT doc_id FROM documents)),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n,
        dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM d),
up AS (SELECT g, 0 AS lv, pos, n, leaf AS dig FROM p
       UNION ALL SELECT g, any_value(lv) + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(dig, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY g, pos // 2),
sub AS (SELECT g, dig, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS lv, g AS pos, n, dig FROM sub
        UNION ALL SELECT any_value(lv) + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(dig, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY pos // 2),
way AS (SELECT p.doc_id, p.leaf, p.g, p.pos AS own, u.lv AS lv, (p.pos >> u.lv) & 1 AS side, s.dig AS sib
        FROM p JOIN (SELECT DISTINCT g, lv, n FROM up WHERE n > 1) u ON u.g = p.g
        LEFT JOIN up s ON s.g = p.g AND s.lv = u.lv AND s.pos = xor(p.pos >> u.lv, 1)
        UNION ALL
        SELECT p.doc_id, p.leaf, p.g, p.pos, 1000 + t.lv, (p.g >> t.lv) & 1, s.dig
        FROM p CROSS JOIN (SELECT DISTINCT lv, n FROM top WHERE n > 1) t LEFT JOIN top s ON s.lv = t.lv AND s.pos = xor(p.g >> t.lv, 1)),
steps AS (SELECT g, own, string_agg(coalesce(sib, ''), '' ORDER BY lv) AS proof, list(side ORDER BY lv) AS sides, list(coalesce(sib, '') ORDER BY lv) AS sibs
          FROM way GROUP BY g, own),
start AS (SELECT p.g, p.pos, p.doc_id, p.leaf, coalesce(steps.proof, '') AS proof, coalesce(steps.sides, []) AS sides, coalesce(steps.sibs, []) AS sibs,
            CASE WHEN crc.hit THEN coalesce(p.changed, p.leaf) ELSE p.leaf END AS cur
          FROM p LEFT JOIN steps ON steps.g = p.g AND steps.own = p.pos JOIN crc ON crc.doc_id IS NOT DISTINCT FROM p.doc_id),
folding AS (SELECT g, pos, 0 AS k, cur, sides, sibs FROM start
            UNION ALL SELECT g, pos, k + 1, sha256(CASE WHEN sides[k + 1] = 1 THEN sibs[k + 1] || cur ELSE cur || sibs[k + 1] END), sides, sibs
            FROM folding WHERE k < len(sides)),
root AS (SELECT dig FROM top WHERE n = 1)
SELECT start.doc_id, start.leaf, sub.dig AS subroot, (SELECT dig FROM root) AS root, sha256(start.proof) AS proof_sha256,
  f.cur AS folded_root, f.cur = (SELECT dig FROM root) AS verified
FROM start JOIN sub ON sub.g = start.g JOIN folding f ON f.g = start.g AND f.pos = start.pos AND f.k = len(f.sides)""")
def op12(spark, d):
    from dealcast.llm import merkle as op
    return op.manifest(op.tampered_documents(table(spark, d, "documents")), check="check").drop("lang")


# ---------------------------------------------------------------- 13 ranked search

_TERMS = "regexp_extract_all(" + _LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query("op13_ranked_search", r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, """ + _TERMS + """ AS w FROM documents),
nn AS (SELECT r, doc_id, len(w) AS n FROM d WHERE len(w) > 0),
st AS (SELECT count(*) AS docs, sum(n) AS words FROM nn),
q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest(""" + _TERMS + """) AS t FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
wt AS (SELECT t, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w
       FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), st),
s AS (SELECT q.item_id, tf.r, nn.doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words)))) AS BIGINT) AS score
      FROM q JOIN tf USING (t) JOIN wt USING (t) JOIN nn USING (r) CROSS JOIN st GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10""")
def op13(spark, d):
    from dealcast.llm.ranking import ranked
    return ranked(table(spark, d, "documents"), table(spark, d, "benchmark"))
