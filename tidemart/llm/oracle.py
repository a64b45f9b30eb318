"""The corpus queries that SQL can express, as DuckDB SQL over the same tables."""

from __future__ import annotations

from tidemart.llm.chat import CLOSE, CONTROL, END, LEARNED, OPEN
from tidemart.llm.sharding import DIGITS, SHARDS
from tidemart.llm.url_reputation import DEVIATIONS, LIMIT, PRIOR, RULES, STRONGEST, WEAKEST

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MIXING = r"""
WITH d AS (
  SELECT doc_id, coalesce('+' || source, '') AS flow, sha256(coalesce(doc_id::VARCHAR, '')) AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
),
s AS (SELECT flow, sum(size)::BIGINT AS source_size FROM d GROUP BY flow),
w AS (
  SELECT *, source_size * 2::DOUBLE AS most,
         CASE (row_number() OVER (ORDER BY flow = '', flow) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS weight,
         (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget
  FROM s
),
r AS (SELECT *, most / weight AS ratio FROM w),
l AS (
  SELECT *,
    (budget - coalesce(sum(most) OVER (ORDER BY ratio, flow ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY ratio, flow ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM r
),
f AS (SELECT (SELECT level FROM l WHERE level <= ratio ORDER BY ratio, flow LIMIT 1) AS level),
t AS (
  SELECT flow, source_size, CASE WHEN f.level < ratio THEN f.level * weight ELSE most END AS target FROM l CROSS JOIN f
),
p AS (
  SELECT doc_id, size, flow,
    coalesce(sum(size) OVER (PARTITION BY flow ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d
)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(before + size, floor(target)::BIGINT) - before)
   + greatest(0, least(source_size + before + size, floor(target)::BIGINT) - source_size - before))::BIGINT AS taken
FROM p JOIN t USING (flow)
"""

EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM d WINDOW same AS (PARTITION BY t)
"""


def _escaped(column: str) -> str:
    out = rf"replace({column}, '\', '\\')"
    for c in CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


CHAT = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
),
c AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = '{LEARNED}'), '') AS loss,
    sum(length({_escaped("role")}) + length({_escaped("text")}) + {len(OPEN) + len(CLOSE) + len(END)})::BIGINT AS formatted_chars
  FROM t GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM c
"""


def _rule(column: str) -> str:
    """The longest rule that fits: rules sorted from long to short, the first that fits."""
    whens = []
    for kind, host, path in sorted(RULES, key=lambda r: (len(r[1] + r[2]), r), reverse=True):
        value = host + path if column == "rule" else kind
        whens.append(
            f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN '{value}'"
        )
    return "CASE " + " ".join(whens) + " END"


def _strength(table: str) -> str:
    """Agreement of a level's members with their parents, by the method of moments."""
    spread = "mean * (1 - mean)"
    return f"""
  SELECT least(greatest(coalesce(CASE WHEN excess > 0 THEN scale / excess - 1 END, {STRONGEST}), {WEAKEST}), {STRONGEST})::DOUBLE AS s
  FROM (
    SELECT sum(n * power(bad / n::DOUBLE - mean, 2) - {spread}) AS excess, sum((n - 1) * {spread}) AS scale
    FROM {table} WHERE n > 1
  )"""


def _others(table: str, key: str) -> str:
    """A level's counts and its parents' posterior without them."""
    known = "(a - bad + b - n + bad)"
    return f"SELECT {key}, bad, n, {known}::DOUBLE AS known, (a - bad)::DOUBLE / {known} AS mean FROM {table}"


def _posterior(table: str, key: str) -> str:
    return f"SELECT {key}, least(s, known) * mean + bad AS a, least(s, known) * (1 - mean) + n - bad AS b FROM {table}"


URLS = rf"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM (SELECT page_id, coalesce(url, '') AS url FROM pages)
),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM u
),
o AS (
  SELECT doc_id AS page_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE (toxic = 1 OR quality = 0) IS NOT NULL GROUP BY doc_id
),
h AS (
  SELECT host, regexp_extract(host, '([^.]*\.)?[^.]*$') AS domain, regexp_extract(host, '[^.]*$') AS suffix,
         coalesce(sum(bad), 0)::BIGINT AS bad, count(bad) AS n
  FROM p LEFT JOIN o USING (page_id) GROUP BY host
),
d AS (SELECT domain, suffix, sum(bad) AS bad, sum(n) AS n FROM h GROUP BY domain, suffix),
x0 AS (SELECT suffix, sum(bad) AS bad, sum(n) AS n FROM d GROUP BY suffix),
x1 AS (SELECT {PRIOR} + coalesce(sum(bad), 0) AS a, {PRIOR} + coalesce(sum(n) - sum(bad), 0) AS b FROM x0),
x AS ({_others("x0, x1", "suffix")}),
xs AS ({_strength("x")}),
xp AS ({_posterior("x, xs", "suffix")}),
dc AS ({_others("d JOIN xp USING (suffix)", "domain")}),
ds AS ({_strength("dc")}),
dp AS ({_posterior("dc, ds", "domain")}),
hc AS ({_others("h JOIN dp USING (domain)", "host")}),
hs AS ({_strength("hc")}),
hp AS (SELECT host, a / (a + b) AS m, a + b AS k FROM ({_posterior("hc, hs", "host")})),
low AS (SELECT host, m - {DEVIATIONS} * sqrt(m * (1 - m) / (k + 1)) AS low FROM hp)
SELECT page_id, host, path, {_rule("rule")} AS rule,
       coalesce({_rule("verdict")}, CASE WHEN low > {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN low USING (host)
"""

# CRC-32 over half bytes, low half first; the table holds the remainders of the 16 half bytes
CRC_TABLE = """
  SELECT list_transform(range(16), lambda n: list_reduce(list_prepend(n, range(4)),
    lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))) AS halves"""


def _crc32(digits: str) -> str:
    """``digits`` is a column of the text's hexadecimal digits; needs the table's column ``halves``."""
    nibble = f"instr('0123456789ABCDEF', substr({digits}, xor(i, 1)::BIGINT + 1, 1)) - 1"
    nibbles = f"list_transform(range(length({digits})), lambda i: {nibble})"
    return (
        f"xor(4294967295, list_reduce(list_prepend(4294967295, {nibbles}), "
        "lambda c, x: xor(c >> 4, halves[(xor(c, x) & 15) + 1])))"
    )


DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents
),
t AS (
  SELECT n, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'UPPER', 'LOWER') AS term
  FROM d
),
k AS (SELECT lang, term, count(*)::HUGEINT AS total FROM t GROUP BY lang, term HAVING count(DISTINCT n) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
gs AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS of FROM g LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source),
ls AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS of FROM k GROUP BY lang),
p AS (
  SELECT lang, gs.source, k.term, coalesce(c.n, 0) AS n, total, ls.of AS lang_of, v,
         1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (gs.of + v) AS p
  FROM gs JOIN ls USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)
),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce((SELECT sum(((x.p - y.p) * (x.p - y.p)) // y.p)
                   FROM p x JOIN p y USING (lang, term)
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
),
told AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
  FROM (SELECT *, 1 + (1000000000 * (total + 1)) // (lang_of + v) AS q FROM p)
  WHERE n > 0 AND p > q
),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM told)
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 200
""".replace("UPPER", UPPER).replace("LOWER", LOWER)


def _field(column: str) -> str:
    text = f"{column}::VARCHAR"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


def _tree(name: str, leaves: str) -> str:
    """All levels of the trees of ``leaves`` (``tree``, ``nodes``), from level 0 to the one with a single node."""
    return f"""
{name} AS (
  SELECT tree, 0 AS level, nodes FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, list_transform(range((len(nodes) + 1) // 2),
    lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
  FROM {name} WHERE len(nodes) > 1
)"""


def _steps(rows: str, levels: str) -> str:
    """The siblings on the way up, with their side."""
    other = "nodes[xor(place >> level, 1) + 1]"
    return f"""
  SELECT {rows}.tree, place,
    list(CASE WHEN (place >> level) & 1 = 1 THEN 'L' ELSE 'R' END || coalesce({other}, '') ORDER BY level) AS path
  FROM {rows} JOIN {levels} ON {rows}.tree = {levels}.tree AND len(nodes) > 1
  GROUP BY {rows}.tree, place"""


MANIFEST = f"""
WITH RECURSIVE h AS ({CRC_TABLE}),
d AS (
  SELECT doc_id, coalesce('+' || lang, '') AS tree, {_leaf('n_chars')} AS leaf,
         CASE WHEN {_crc32("digits")} % 7 = 0 THEN {_leaf('(n_chars + 1)')} END AS changed
  FROM (SELECT *, hex(encode(doc_id::VARCHAR)) AS digits FROM documents), h
),
l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM d),
below AS (SELECT tree, list(leaf ORDER BY place) AS nodes FROM l GROUP BY tree),
{_tree("levels", "below")},
s AS (
  SELECT '' AS tree, tree AS name, nodes[1] AS node, row_number() OVER (ORDER BY tree) - 1 AS place
  FROM levels WHERE len(nodes) = 1
),
top AS (SELECT '' AS tree, list(node ORDER BY place) AS nodes FROM s),
{_tree("upper_levels", "top")},
inner_steps AS ({_steps("l", "levels")}),
outer_steps AS ({_steps("s", "upper_levels")}),
proofs AS (
  SELECT l.doc_id, l.leaf, s.node AS subroot, (SELECT nodes[1] FROM upper_levels WHERE len(nodes) = 1) AS root,
         list_concat(coalesce(i.path, []), coalesce(o.path, [])) AS path, coalesce(l.changed, l.leaf) AS start
  FROM l JOIN s ON l.tree = s.name
  LEFT JOIN inner_steps i ON i.tree = l.tree AND i.place = l.place
  LEFT JOIN outer_steps o ON o.place = s.place
),
folded AS (
  SELECT *, list_reduce(list_prepend(start, path), lambda node, step:
    sha256(CASE WHEN step[1] = 'L' THEN step[2:] || node ELSE node || step[2:] END)) AS folded_root
  FROM proofs
)
SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_prepend('', list_transform(path, lambda s: s[2:])), 'string_agg', '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded
"""


def _lot(shard: int) -> str:
    number = f"('0x' || substr(sha256(coalesce(doc_id::VARCHAR, '') || ':{shard}'), 1, {DIGITS}))::BIGINT"
    return f"{{'lot': -ln(({number} + 0.5::DOUBLE) / {16**DIGITS}::DOUBLE), 'shard': {shard}}}"


def _winner(shards: int) -> str:
    return f"list_min([{', '.join(map(_lot, range(shards)))}]).shard"


SHARDING = f"""
WITH h AS ({CRC_TABLE}),
d AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size, {_crc32("digits")} AS text_crc32,
         {_winner(SHARDS)} AS shard, {_winner(SHARDS + 1)} AS grown_shard
  FROM (SELECT *, hex(encode(coalesce(text, ''))) AS digits FROM documents), h
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST) - 1 AS slot
FROM d
"""

ORACLE_SQL = {
    "op3_mixing": MIXING, "op6_chat": CHAT, "op7_exact_dedup": EXACT_DEDUP, "op9_urls": URLS,
    "op11_divergence": DIVERGENCE, "op12_manifest": MANIFEST, "op13_sharding": SHARDING,
}
