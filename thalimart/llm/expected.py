"""DuckDB SQL for the operators whose results SQL can express, over the raw tables."""

from __future__ import annotations

import string

from . import license_scan as licenses
from . import url_templates as urls

ARC_TO_WARC = """
WITH page AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
holder AS (SELECT body, max(page_id) AS held FROM page WHERE strlen(body) >= 1000 GROUP BY body)
SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest,
  CASE WHEN held <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN held <> page_id THEN held END AS refers_to
FROM page LEFT JOIN holder USING (body)"""

RANKED = f"""
WITH params AS (SELECT '{string.ascii_uppercase}' AS big, '{string.ascii_lowercase}' AS small, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+' AS word),
item AS (SELECT row_number() OVER () AS q, item_id, unnest(regexp_extract_all(translate(text, big, small), word)) AS term FROM benchmark, params),
asked AS (SELECT q, any_value(item_id) AS item_id, term, count(*) AS repeats FROM item GROUP BY q, term),
doc AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(text, big, small), word) AS terms FROM documents, params WHERE text IS NOT NULL),
total AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS words FROM doc WHERE len(terms) > 0),
posting AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(terms) AS term FROM doc) WHERE term IN (SELECT term FROM asked) GROUP BY id, term),
weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM posting, total GROUP BY term, docs),
norm AS (SELECT id, doc_id, 75 + (25 * len(terms) * docs) // words AS m FROM doc, total WHERE len(terms) > 0),
scored AS (SELECT q, any_value(item_id) AS item_id, id, any_value(doc_id) AS doc_id,
  CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN posting USING (term) JOIN weight USING (term) JOIN norm USING (id) GROUP BY q, id)
SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
WINDOW best AS (PARTITION BY q ORDER BY score DESC, doc_id) QUALIFY row_number() OVER best <= 20"""


def url_templates(rules: list[urls.Rule]) -> str:
    """Host, path and longest rule; the tree level by level; neighbours of a family
    compared in the order of their rates; smoothed shares."""
    listed = ", ".join(f"('{r.verdict}', '{r.text}', '{r.host}', '{r.path}')" for r in rules)
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    levels, source = [], "level_0"
    for i in range(urls.DEPTH + 1):
        levels.append(f"""branch_{i} AS (
  SELECT host, t, segs[{i + 1}] AS s, CASE WHEN count(*) OVER family <= {urls.FEW}
    OR count(*) >= CAST({urls.KEEP} AS DOUBLE) * sum(count(*)) OVER family THEN segs[{i + 1}] ELSE '*' END AS name
  FROM {source} WHERE len(segs) > {i} GROUP BY host, t, segs[{i + 1}] WINDOW family AS (PARTITION BY host, t)),
level_{i + 1} AS (
  SELECT l.* REPLACE (CASE WHEN b.name IS NULL THEN l.t ELSE l.t || '/' || b.name END AS t)
  FROM {source} l LEFT JOIN branch_{i} b ON b.host = l.host AND b.t = l.t AND b.s = l.segs[{i + 1}])""")
        source = f"level_{i + 1}"
    return f"""
WITH rule(verdict, rule, rule_host, rule_path) AS (VALUES {listed}),
cut AS (SELECT row_number() OVER () AS id, page_id, substr(url, nullif(instr(url, '://'), 0) + 3) AS rest FROM pages),
parsed AS (SELECT id, page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}'), '') AS host,
  coalesce(regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*'), '') AS path FROM cut),
fitting AS (SELECT id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS decided
  FROM parsed JOIN rule ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY id),
typed AS (SELECT *, CASE WHEN path <> '' THEN string_split(regexp_replace(regexp_replace(regexp_replace(path, '[0-9a-f]{{16,}}', '<x>', 'g'),
    '[0-9]+', '<n>', 'g'), '^/', ''), '/') ELSE [] END AS parts FROM parsed LEFT JOIN fitting USING (id)),
level_0 AS (SELECT id, page_id, host, path, rule, decided, '' AS t,
  CASE WHEN len(parts) > {urls.DEPTH} THEN list_append(parts[1:{urls.DEPTH}], '**') ELSE parts END AS segs FROM typed),
{", ".join(levels)},
leaf AS (SELECT host, t, regexp_replace(t, '/[^/]*$', '') AS parent, count(decided) AS labelled,
  count(*) FILTER (decided = 'block') AS blocked FROM {source} GROUP BY host, t),
step AS (SELECT *, blocked / CAST(labelled AS DOUBLE) AS rate, lag(blocked) OVER family AS b0, lag(labelled) OVER family AS l0
  FROM leaf WHERE labelled > 0 WINDOW family AS (PARTITION BY host, parent ORDER BY blocked / CAST(labelled AS DOUBLE), t)),
gap AS (SELECT *, CASE WHEN l0 IS NULL OR rate - b0 / CAST(l0 AS DOUBLE) > {urls.Z} * sqrt((blocked + b0) / CAST(labelled + l0 AS DOUBLE)
    * (1 - (blocked + b0) / CAST(labelled + l0 AS DOUBLE)) * (1 / CAST(labelled AS DOUBLE) + 1 / CAST(l0 AS DOUBLE))) THEN 1 ELSE 0 END AS new FROM step),
grouped AS (SELECT *, sum(new) OVER (PARTITION BY host, parent ORDER BY rate, t) AS grp FROM gap),
merged AS (SELECT host, t, sum(blocked) OVER g AS b, sum(labelled) OVER g AS l FROM grouped WINDOW g AS (PARTITION BY host, parent, grp)),
base AS (SELECT (sum(blocked) + 1) / CAST(sum(labelled) + 2 AS DOUBLE) AS p FROM leaf),
site AS (SELECT host, (sum(blocked) + {urls.PRIOR} * any_value(p)) / CAST(sum(labelled) + {urls.PRIOR} AS DOUBLE) AS p FROM leaf, base GROUP BY host),
share AS (SELECT leaf.host, leaf.t, (coalesce(b, 0) + {urls.PRIOR} * site.p) / (coalesce(l, 0) + {urls.PRIOR}) AS p
  FROM leaf JOIN site USING (host) LEFT JOIN merged USING (host, t))
SELECT page_id, host, path, rule, coalesce(decided, CASE WHEN p > {urls.REJECT} THEN 'block' ELSE 'allow' END) AS verdict
FROM {source} JOIN share USING (host, t)"""


def license_scan() -> str:
    """Every place where a run of a notice begins is tried: the share of the
    notice's runs in the words that a copy from there can reach."""
    n = licenses.SHINGLE
    rows = ", ".join(f"('{name}', {k}, {words!r})" for name, k, words in licenses.template_rows())
    return f"""
WITH notice(license, number, words) AS (VALUES {rows}),
wanted AS (SELECT DISTINCT license, number, len(words) AS size, array_to_string(words[i:i + {n - 1}], ' ') AS run
  FROM notice, unnest(generate_series(1, len(words) - {n - 1})) AS place(i)),
texts AS (SELECT row_number() OVER () AS id, doc_id,
  list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS words FROM documents WHERE text IS NOT NULL),
runs AS (SELECT id, doc_id, i AS pos, array_to_string(words[i:i + {n - 1}], ' ') AS run
  FROM texts, unnest(generate_series(1, len(words) - {n - 1})) AS place(i)),
hit AS (SELECT id, doc_id, pos, license, number, size, run FROM runs JOIN wanted USING (run)),
scored AS (SELECT a.doc_id, a.license, a.number, a.id, a.pos, count(DISTINCT b.run) AS have FROM hit a JOIN hit b
  ON b.id = a.id AND b.license = a.license AND b.number = a.number AND b.pos BETWEEN a.pos AND a.pos + a.size + {licenses.ROOM - 1}
  GROUP BY ALL),
total AS (SELECT license, number, count(*) AS all_runs FROM wanted GROUP BY ALL)
SELECT doc_id, license, max(have / CAST(all_runs AS DOUBLE)) AS containment FROM scored JOIN total USING (license, number)
GROUP BY doc_id, license HAVING max(have / CAST(all_runs AS DOUBLE)) >= {licenses.CONTAINMENT}"""
