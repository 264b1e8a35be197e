"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from demandops.llm import quality_rules as QR
from demandops.llm.queries import LISTED_HOST_PARTS, URL_RULES
from demandops.llm.url_filter import TRACKING

# RE2 classes of the word definitions
_SEP = r"[\x20\x09-\x0D]+"
_WORDS7 = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _op3() -> str:
    rules = sorted(URL_RULES, key=lambda r: -(len(r[1]) + len(r[2])))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, act)
            for act, h, p in rules]
    rule = " ".join(f"WHEN {c} THEN '{n}'" for c, n, _ in fits)
    act = " ".join(f"WHEN {c} THEN '{a}'" for c, _, a in fits)
    return f"""
WITH r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (SELECT page_id, rest,
  coalesce({_ASCII_LOWER.format("regexp_extract(rest, '^[^/?#]*', 0)")}, '') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM r),
q AS (SELECT *, regexp_replace(regexp_replace(regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1),
    '(^|&)({TRACKING})=[^&]*', '', 'g'), '^&+', '') AS query FROM p),
c AS (SELECT *, CASE WHEN rest IS NOT NULL THEN
    regexp_replace(regexp_replace(host, ':[0-9]*$', ''), '^www[.]', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS canonical FROM q),
l AS (SELECT DISTINCT canonical FROM c WHERE regexp_matches(host, '{LISTED_HOST_PARTS}') AND canonical IS NOT NULL),
f AS (SELECT c.*, l.canonical IS NOT NULL AS listed FROM c LEFT JOIN l ON c.canonical = l.canonical)
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {act} WHEN listed THEN 'block' ELSE 'allow' END AS verdict, canonical, listed FROM f"""


def _op6(alpha: float = 0.02, delta: float = 0.05) -> str:
    risk = alpha / len(QR.GRIDS)
    m = sum(len(g) for g in QR.GRIDS.values())
    ratio = {"symbol_ratio": "CASE WHEN word_chars > 0 THEN n_symbols::DOUBLE / word_chars ELSE 0 END",
             "dup_line_ratio": "CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END",
             "repeat_ratio": "CASE WHEN n_words > 0 THEN n_repeat_words::DOUBLE / n_words ELSE 0 END",
             "mean_word_chars": "CASE WHEN n_words > 0 THEN word_chars::DOUBLE / n_words ELSE 0 END"}
    grid = " UNION ALL ".join(
        f"SELECT '{r}' AS rule, unnest([{', '.join(repr(float(c)) for c in g)}]::DOUBLE[]) AS cutoff"
        for r, g in QR.GRIDS.items())
    value = " ".join(f"WHEN '{r}' THEN {r}" for r in QR.GRIDS)
    return f"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{_SEP}'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
g AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
d AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n >= 2),
c AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM d) GROUP BY rid),
s AS (SELECT w.rid, doc_id, stratum, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(lines) AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN c USING (rid)),
x AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
    {', '.join(f'{sql} AS {r}' for r, sql in ratio.items())} FROM s),
good AS (SELECT * FROM x WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
grid AS ({grid}),
n AS (SELECT stratum, count(*) AS n FROM good GROUP BY stratum),
k AS (SELECT good.stratum, rule, cutoff, sum((CASE rule {value} END > cutoff)::INT)::BIGINT AS k
  FROM good CROSS JOIN grid GROUP BY ALL),
p AS (SELECT k.stratum, rule, cutoff, CASE WHEN k >= n * {risk} THEN 1 ELSE
    list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
      + j * ln({risk}) + (n - j) * ln(1 - {risk})))) END AS tail FROM k JOIN n USING (stratum)),
cut AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM p
  WHERE tail <= {delta} / greatest(1, (SELECT count(*) FROM n) * {m}) GROUP BY ALL),
bad AS (SELECT DISTINCT x.rid FROM x JOIN cut USING (stratum) WHERE CASE rule {value} END > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND rid NOT IN (SELECT rid FROM bad)) AS kept FROM x"""


def _op7() -> str:
    lower = _ASCII_LOWER.format("coalesce(text, '')")
    words = f"list_filter(regexp_split_to_array({lower}, '{_WORDS7}'), lambda x: x <> '')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
b AS (SELECT DISTINCT item_id, {words} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT item_id, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i, w FROM b WHERE len(w) > 0),
bg AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM bw),
dw AS (SELECT rid, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bg) WHERE len(w) >= n),
h AS (SELECT rid, i, n, gram FROM (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM dw)
  WHERE (n, gram) IN (SELECT (n, gram) FROM bg)),
p AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM h) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM h JOIN bg USING (n, gram)) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (rid) LEFT JOIN it USING (rid)"""


def _op10() -> str:
    norm = r"trim(regexp_replace(lower(body), '\s+', ' ', 'g'))"
    return rf"""
WITH RECURSIVE m AS (SELECT row_number() OVER () AS rid, *, string_split(coalesce(text, ''), chr(10)) AS ls FROM conversations),
l AS (SELECT rid, conv_id, turn, i, ls[i] AS line FROM (SELECT rid, conv_id, turn, ls, unnest(range(1, len(ls) + 1)) AS i FROM m)),
q AS (SELECT *, length(regexp_replace(regexp_extract(line, '^(\s*>)*', 0), '[^>]', '', 'g')) AS level,
  regexp_replace(line, '^(\s*>)+ ?', '') AS body FROM l),
o AS (SELECT *, lead(level) OVER (PARTITION BY rid ORDER BY i) AS next_level FROM q),
t AS (SELECT rid, trim(coalesce(string_agg(body, chr(10) ORDER BY i) FILTER (level = 0 AND NOT (
    regexp_matches(body, '(wrote|writes|schrieb|a écrit|escribió)\s*:\s*$') AND coalesce(next_level, 0) > 0)), ''), ' ') AS own,
    count(*) FILTER (level > 0) AS n_quoted FROM o GROUP BY rid),
n AS (SELECT DISTINCT conv_id, turn, level, {norm} AS norm FROM q WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND {norm} <> ''),
f AS (SELECT conv_id, norm, min(turn) AS source FROM n WHERE level = 0 GROUP BY ALL),
v AS (SELECT n.conv_id, n.turn, level, source, count(*) AS c FROM n JOIN f USING (conv_id, norm)
  WHERE level > 0 AND source < n.turn GROUP BY ALL),
p AS (SELECT conv_id, turn, arg_max(source, (-level, c, source)) AS parent FROM v GROUP BY ALL),
r AS (SELECT conv_id, turn, parent AS root, 1 AS depth FROM p
  UNION ALL SELECT r.conv_id, r.turn, p.parent, r.depth + 1 FROM r JOIN p ON p.conv_id = r.conv_id AND p.turn = r.root),
x AS (SELECT conv_id, turn, arg_max(root, depth) AS root, max(depth) AS depth FROM r GROUP BY ALL),
z AS (SELECT m.conv_id, m.turn, role, parent AS reply_to, coalesce(x.root, m.turn) AS root_turn,
  coalesce(x.depth, 0)::BIGINT AS depth, n_quoted, own
  FROM m JOIN t USING (rid) LEFT JOIN p ON p.conv_id = m.conv_id AND p.turn = m.turn
  LEFT JOIN x ON x.conv_id = m.conv_id AND x.turn = m.turn)
SELECT conv_id, turn, role, reply_to, root_turn, depth,
  (row_number() OVER (PARTITION BY conv_id ORDER BY root_turn NULLS FIRST, depth, turn NULLS FIRST, role NULLS FIRST, own) - 1)::BIGINT AS position,
  n_quoted::BIGINT AS n_quoted, own AS text FROM z"""


def _op11() -> str:
    def field(c: str) -> str:
        return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"

    def leaf(chars: str) -> str:
        return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", chars, "text"))) + ")"
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    crc = f"""xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''),
      lambda x: ord(x)::BIGINT)), lambda s, b: list_reduce(list_prepend(xor(s, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda c, z: {step})))"""

    def climb(name: str, base: str) -> str:
        return f"""{name} AS ({base}
  UNION ALL SELECT tree, level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}) WHERE n > 1 GROUP BY tree, level, idx // 2)"""

    def path(name: str, nodes: str, base: str) -> str:
        return f"""{name} AS ({base}
  UNION ALL SELECT f.rid, f.tree, f.level + 1, f.idx // 2, sha256(CASE WHEN s.h IS NULL THEN f.cur
      WHEN f.idx % 2 = 1 THEN s.h || f.cur ELSE f.cur || s.h END), f.proof || coalesce(s.h, '')
  FROM {name} f JOIN (SELECT tree, max(level) AS top FROM {nodes} GROUP BY tree) t ON t.tree = f.tree AND f.level < t.top
  LEFT JOIN {nodes} s ON s.tree = f.tree AND s.level = f.level AND s.idx = f.idx + 1 - 2 * (f.idx % 2))"""
    return f"""
WITH RECURSIVE l AS (SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS tree, {leaf('n_chars')} AS leaf,
  CASE WHEN {crc} % 7 = 0 THEN {leaf('(n_chars + 1)')} END AS seen FROM documents),
d AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
{climb('nodes', 'SELECT tree, 0 AS level, pos AS idx, leaf AS h FROM d')},
subs AS (SELECT tree, arg_max(h, level) AS subroot FROM nodes GROUP BY tree),
named AS (SELECT tree AS name, subroot, row_number() OVER (ORDER BY tree) - 1 AS idx FROM subs),
{climb('tops', "SELECT '' AS tree, 0 AS level, idx, subroot AS h FROM named")},
{path('low', 'nodes', "SELECT rid, tree, 0 AS level, pos AS idx, coalesce(seen, leaf) AS cur, '' AS proof FROM d")},
mid AS (SELECT rid, tree, arg_max(cur, level) AS cur, arg_max(proof, level) AS proof FROM low GROUP BY rid, tree),
{path('high', 'tops', "SELECT rid, '' AS tree, 0 AS level, idx, cur, proof FROM mid JOIN named ON named.name = mid.tree")},
done AS (SELECT rid, arg_max(cur, level) AS cur, arg_max(proof, level) AS proof FROM high GROUP BY rid),
root AS (SELECT arg_max(h, level) AS root FROM tops)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM d JOIN subs USING (tree) JOIN done USING (rid) CROSS JOIN root"""


def _op13() -> str:
    lower = _ASCII_LOWER.format("coalesce(text, '')")
    words = rf"list_filter(regexp_split_to_array({lower}, '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
q AS (SELECT DISTINCT item_id, unnest({words}) AS term FROM benchmark),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS length FROM d WHERE len(w) > 0),
c AS (SELECT rid, term, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
t AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM c GROUP BY term) CROSS JOIN s),
m AS (SELECT rid, doc_id, 10 + (90 * len(d.w)::BIGINT * n_docs) // length AS m FROM d CROSS JOIN s),
r AS (SELECT item_id, rid, doc_id, sum(t.w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN t USING (term) JOIN c USING (term) JOIN m USING (rid) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM r WHERE score > 0)
WHERE rank <= 10"""


ORACLE: dict[str, str] = {
    "op3_url_filter": _op3(),
    "op6_quality_rules": _op6(),
    "op7_decontamination": _op7(),
    "op10_chat_format": _op10(),
    "op11_merkle_manifest": _op11(),
    "op13_lexical_search": _op13(),
}
