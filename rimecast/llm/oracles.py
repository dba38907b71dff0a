"""DuckDB SQL for the operators that SQL can express, over the same tables."""

from __future__ import annotations

#: A line as operators compare it: lower case, runs of blanks as one space, none at the ends.
_LINE = r"lower(trim(regexp_replace(l, '[\x20\x09\x0B-\x0D]+', ' ', 'g')))"
_LINES = f"""
raw AS (SELECT doc_id, coalesce(source, '') AS site, coalesce(text, '') AS t FROM documents),
lines AS (SELECT doc_id, site, u.l AS l, u.i AS pos, {_LINE.replace('(l,', '(u.l,')} AS k
  FROM raw, LATERAL (SELECT unnest(string_split(t, chr(10))) AS l, unnest(range(1, len(string_split(t, chr(10))) + 1)) AS i) u)"""


def line_dedup(min_sites: int) -> str:
    return f"""WITH {_LINES},
common AS (SELECT k, min(doc_id) AS first_doc FROM lines WHERE k <> '' GROUP BY k HAVING count(DISTINCT site) >= {min_sites}),
marked AS (SELECT lines.*, common.k IS NOT NULL AND doc_id <> first_doc AS gone FROM lines LEFT JOIN common USING (k))
SELECT raw.doc_id, CASE WHEN any_value(t) = '' THEN 0 ELSE count(*) END AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_removed,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM raw JOIN marked USING (doc_id) GROUP BY raw.doc_id"""


def quality_rules(max_docs: int, max_share: float, max_removed: float) -> str:
    return rf"""WITH {_LINES},
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM raw),
tok AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM w),
gram AS (SELECT doc_id, i, x AS a, lead(x, 1) OVER o AS b, lead(x, 2) OVER o AS c FROM tok WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
tri AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS c FROM gram WHERE c IS NOT NULL),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM tri, (VALUES (0), (1), (2)) v(k) WHERE c >= 2 GROUP BY doc_id),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines WHERE k <> '' GROUP BY doc_id),
hot AS (SELECT site, k FROM (SELECT site, k, count(DISTINCT doc_id) AS n FROM lines WHERE k <> '' GROUP BY site, k) JOIN (SELECT site, count(DISTINCT doc_id) AS docs FROM raw GROUP BY site) USING (site)
  WHERE n > {max_docs} AND n > docs * {max_share}),
lost AS (SELECT doc_id, sum(len(regexp_extract_all(l, '[^\x20\x09-\x0D]+'))) AS n FROM lines JOIN hot USING (site, k) GROUP BY doc_id),
f AS (SELECT doc_id, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    coalesce(dup.n, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words, coalesce(lost.n, 0) AS n_removed_words
  FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN lost USING (doc_id)),
g AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, n_removed_words > n_words * {max_removed} AS depleted FROM f)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND NOT depleted AS kept, CAST(n_removed_words AS BIGINT) AS n_removed_words, depleted FROM g"""


def _case(name: str, weights: dict[str, int]) -> str:
    return "CASE " + " ".join(f"WHEN {name} = '{k}' THEN {v}" for k, v in sorted(weights.items())) + " ELSE 1 END" if weights else "1"


def mixing(documents: str, weights: dict[str, dict[str, int]], share: tuple[int, int], max_epochs: int, seed: int) -> str:
    """``documents``: the name of the table or CTE to select from."""
    levels, parts = ("domain", "lang", "source"), []
    for d, name in enumerate(levels):
        keys, parent = ", ".join(levels[: d + 1]), ", ".join(levels[:d])
        over = f"PARTITION BY {parent}" if d else ""
        given = f"JOIN b{d - 1} USING ({parent})" if d else "CROSS JOIN top"
        parts.append(f"""
n{d} AS (SELECT {keys}, sum(cap)::HUGEINT AS cap, {_case(name, weights.get(name, {}))}::HUGEINT AS w FROM leaf GROUP BY {keys}),
o{d} AS (SELECT n{d}.*, given, row_number() OVER ({over} ORDER BY cap::DOUBLE / w::DOUBLE, {name}) AS rk FROM n{d} {given}),
l{d} AS (SELECT *, given - coalesce(sum(cap) OVER ({over} ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remain,
  sum(w) OVER ({over} ORDER BY rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM o{d}),
s{d} AS (SELECT *, min(CASE WHEN cap * ws <= w * remain THEN 1 ELSE 0 END) OVER ({over} ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 0 AS open FROM l{d}),
p{d} AS (SELECT *, max(CASE WHEN open THEN remain END) OVER ({over}) AS pool, max(CASE WHEN open THEN ws END) OVER ({over}) AS pw FROM s{d}),
b{d} AS (SELECT {keys}, (CASE WHEN open THEN least(cap, (w * pool) // pw) ELSE cap END)::HUGEINT AS given FROM p{d})""")
    return rf"""
src AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) AS num,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens FROM {documents}),
tok AS (SELECT doc_id, CASE WHEN num = '' THEN 'web' ELSE ['web', 'books', 'code', 'news'][(num::HUGEINT % 4)::INT + 1] END AS domain, lang, source, n_tokens FROM src WHERE n_tokens > 0),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * {max_epochs} AS cap FROM tok GROUP BY ALL),
top AS (SELECT least(sum(tokens) * {share[0]} // {share[1]}, sum(cap))::HUGEINT AS given FROM leaf),{",".join(parts)},
budget AS (SELECT domain, lang, source, (given // tokens)::INT AS epochs, (given % tokens)::BIGINT AS rest FROM leaf JOIN b2 USING (domain, lang, source)),
placed AS (SELECT tok.*, epochs, rest, md5(concat_ws(':', '{seed}', epochs::VARCHAR, coalesce(doc_id::VARCHAR, ''))) AS place FROM tok JOIN budget USING (domain, lang, source)),
run AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place) AS sofar FROM placed),
mixed AS (SELECT doc_id, domain, lang, source, n_tokens, unnest(range(0, epochs))::INT AS epoch FROM placed
  UNION ALL SELECT doc_id, domain, lang, source, n_tokens, epochs AS epoch FROM run WHERE sofar <= rest)"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def near_duplicates(k: int, percent: int) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x20\x09-\x0D]+')"
    return f"""WITH RECURSIVE w AS (SELECT doc_id, {words} AS ws FROM documents),
g AS (SELECT doc_id, array_to_string(ws[u.i : u.i + {k - 1}], ' ') AS s FROM w, LATERAL (SELECT unnest(range(1, len(ws) - {k - 2})) AS i) u WHERE len(ws) >= {k}
  UNION SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND {k - 1}),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= {percent} * (x.n + y.n - i)),
sym AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT a, b FROM sym UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(r.low, w.doc_id)) AS component_id, w.doc_id = least(w.doc_id, coalesce(r.low, w.doc_id)) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a) r USING (doc_id)"""


def repeats(k: int) -> str:
    return f"""WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, u.i AS i, array_to_string(ws[u.i : u.i + {k - 1}], ' ') AS s FROM w, LATERAL (SELECT unnest(range(1, len(ws) - {k - 2})) AS i) u WHERE len(ws) >= {k}),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS rn FROM win) WHERE rn > 1),
gone AS (SELECT DISTINCT doc_id, i + d AS i FROM late, (SELECT unnest(range(0, {k})) AS d)),
tok AS (SELECT doc_id, u.i AS i, ws[u.i] AS x FROM w, LATERAL (SELECT unnest(range(1, len(ws) + 1)) AS i) u),
kept AS (SELECT tok.doc_id, string_agg(x, ' ' ORDER BY tok.i) AS t, count(*) AS n FROM tok ANTI JOIN gone USING (doc_id, i) GROUP BY tok.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""


def contamination(shingle: int, overlap: float) -> str:
    """Verified overlaps over whole documents; the retrieval before it must not lose any of them."""
    words = lambda x: rf"regexp_extract_all(lower(coalesce({x}, '')), '[\pL\pM\pN]+')"
    mark = r"(?:(?:^|\n)\s*(?:answer|a|antwort|réponse|respuesta)\s*[:.)]\s*|\?\s+)"
    size = f"least({shingle}, greatest(1, len(ws)))"
    return rf"""WITH i0 AS (SELECT item_id, text AS t, regexp_matches(text, '(?i){mark}') AS m FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
i1 AS (SELECT *, CASE WHEN m THEN regexp_extract(t, '(?is)^(.*){mark}(.*)$', 1) ELSE regexp_extract(t, '(?s)^(.*)[.!?]\s+(\S.*)$', 1) END AS head,
  CASE WHEN m THEN regexp_extract(t, '(?is)^(.*){mark}(.*)$', 2) ELSE regexp_extract(t, '(?s)^(.*)[.!?]\s+(\S.*)$', 2) END AS tail FROM i0),
i2 AS (SELECT item_id, t, CASE WHEN trim(head, E' \t\n\r') <> '' AND trim(tail, E' \t\n\r') <> '' THEN tail END AS a FROM i1),
i3 AS (SELECT item_id, {words("left(t, length(t) - length(coalesce(a, '')))")} AS q, {words("coalesce(a, t)")} AS a, {words("t")} AS w FROM i2),
role AS (SELECT item_id, r, CASE WHEN len(w) < {shingle} THEN w WHEN len(x) > 0 THEN x ELSE z END AS ws FROM (SELECT item_id, w, 'q' AS r, q AS x, a AS z FROM i3 UNION ALL SELECT item_id, w, 'a', a, q FROM i3) WHERE len(w) > 0),
want AS (SELECT DISTINCT item_id, r, {size} AS k, array_to_string(ws[u.i : u.i + {size} - 1], ' ') AS s FROM role, LATERAL (SELECT unnest(range(1, len(ws) - {size} + 2)) AS i) u),
total AS (SELECT item_id, r, count(*) AS n FROM want GROUP BY item_id, r),
d AS (SELECT doc_id, {words("text")} AS ws FROM documents),
have AS (SELECT DISTINCT doc_id, z.k AS k, array_to_string(ws[u.i : u.i + z.k - 1], ' ') AS s FROM d, (SELECT DISTINCT k FROM want) z, LATERAL (SELECT unnest(range(1, len(ws) - z.k + 2)) AS i) u),
hit AS (SELECT doc_id, item_id, r, count(*) AS n FROM have JOIN want USING (k, s) GROUP BY doc_id, item_id, r),
pair AS (SELECT doc_id, item_id, min(hit.n / total.n) AS o FROM hit JOIN total USING (item_id, r) GROUP BY doc_id, item_id HAVING count(*) = 2 AND min(hit.n / total.n) >= {overlap})
SELECT d.doc_id, count(item_id) AS n_items, coalesce(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id), '') AS items, round(coalesce(max(o), 0.0), 6) AS overlap, count(item_id) > 0 AS contaminated, count(item_id) = 0 AS kept
FROM d LEFT JOIN pair USING (doc_id) GROUP BY d.doc_id"""


def filter_audit() -> str:
    words = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
    order = "a.l || b.l || c.l || d.l || e.l"
    return rf"""WITH raw AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
lab AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT raw.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, len({words}) < 100 AS A, 100 * len(list_distinct({words})) < 80 * len({words}) AS B,
  100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) AS C, regexp_matches(t, '[#$%&*|]') AS D, coalesce(raw.doc_id > min(raw.doc_id) OVER (PARTITION BY t), false) AS E FROM raw LEFT JOIN lab USING (doc_id)),
cell AS (SELECT part, good, toxic, CASE WHEN A THEN 'A' ELSE '' END || CASE WHEN B THEN 'B' ELSE '' END || CASE WHEN C THEN 'C' ELSE '' END || CASE WHEN D THEN 'D' ELSE '' END || CASE WHEN E THEN 'E' ELSE '' END AS m, count(*) AS n FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
o AS (SELECT {order} AS filter_order FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
s AS (SELECT part, filter_order, step, substr(filter_order, step, 1) AS l, n, good, toxic, m, contains(m, substr(filter_order, step, 1)) AS fails,
  step > 1 AND len(translate(m, substr(filter_order, 1, step - 1), '')) < len(m) AS gone FROM cell, o, (SELECT unnest(range(1, 6))::INT AS step)),
g AS (SELECT part, filter_order, step, l, sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN fails AND gone THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN m = l THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN fails AND NOT gone AND good = 1 THEN n ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN fails AND NOT gone AND toxic = 1 THEN n ELSE 0 END)::BIGINT AS toxic_lost FROM s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, l))::BIGINT AS shapley FROM g"""


#: Remainders of the bytes 0 to 255 for the reversed CRC-32 polynomial, and a CRC by them.
_CRC_TABLE = "(SELECT list(c ORDER BY b) FROM (SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) AS c FROM (SELECT unnest(range(256)) AS b)))"


def _crc32(text: str) -> str:
    """SQL for the CRC-32 of an ASCII text, given a column ``crc`` with ``_CRC_TABLE``."""
    codes = f"list_transform(string_split({text}, ''), lambda x: unicode(x)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda c, b: xor(c // 256, crc[(xor(c, b) % 256) + 1]), 4294967295), 4294967295)"


def conversation_repair() -> str:
    """The same edits by dynamic programming, row after row of all conversations, with the best (cost, audit) of each grammar state."""
    far = "{'c': 1000000000, 'a': ''}"
    plus = lambda s, price, edit: f"{{'c': {s}.c + {price}, 'a': {s}.a || '{edit}'}}"
    least = lambda *xs: f"list_min([{', '.join(xs)}])"
    when = lambda cond, x: f"CASE WHEN {cond} THEN {x} ELSE {far} END"
    closed = f"""p0 AS q0, p1 AS q1, {least("p2", *[plus(p, 2, "I") for p in ("p0", "p1", "p3")])} AS q2, {least("p3", plus("p2", 2, "I"), plus("p0", 4, "II"), plus("p1", 4, "II"))} AS q3"""
    u, r = [f"q{k}" for k in (0, 1, 3)], "NOT must"
    return rf"""WITH RECURSIVE t AS (SELECT {_CRC_TABLE} AS crc),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS act FROM conversations, t),
dam AS (SELECT conv_id, turn, CASE WHEN act = 4 THEN 'user' ELSE role END AS role, CASE WHEN act = 1 THEN '' WHEN act = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE WHEN act = 3 THEN [1, 2] ELSE [1] END) AS copy FROM src WHERE act <> 0),
ord AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, substr(sha256(length(role) || ':' || role || text), 1, 32)) AS i FROM dam),
flag AS (SELECT *, substr(role, 1, 1) AS ini, NOT regexp_matches(text, '[^ 	-
]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
  NOT regexp_matches(text, '[.!?][ 	-
]*\z') AS cut, lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM ord),
rows AS (SELECT *, blank OR again AS must, CASE WHEN cut AND NOT blank AND NOT again THEN 1 ELSE 0 END AS more FROM flag),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again AND NOT blank) AS duplicate, sum(more) AS truncated,
  count(*) FILTER (WHERE i > 1 AND (substr(before, 1, 1) || ini) NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM rows GROUP BY conv_id),
dp AS (SELECT conv_id, 0::BIGINT AS i, n, {{'c': 0, 'a': ''}} AS p0, {far} AS p1, {far} AS p2, {far} AS p3 FROM sums
  UNION ALL SELECT conv_id, i, n, {plus("q0", 3, "D")}, {least(plus("q1", 3, "D"), when(f"{r} AND ini = 's'", plus("q0", "more", "K")))},
    {least(plus("q2", 3, "D"), *[when(f"{r} AND ini = 'u'", plus(q, "more", "K")) for q in u], *[when(r, plus(q, "2 + more", "R")) for q in u])},
    {least(plus("q3", 3, "D"), when(f"{r} AND ini = 'a'", plus("q2", "more", "K")), when(r, plus("q2", "2 + more", "R")))}
    FROM (SELECT dp.conv_id, rows.i, n, ini, must, more::INT AS more, {closed} FROM dp JOIN rows ON dp.conv_id IS NOT DISTINCT FROM rows.conv_id AND rows.i = dp.i + 1)),
fin AS (SELECT conv_id, {least("q0", "q3")} AS best FROM (SELECT conv_id, {closed} FROM dp WHERE i = n)),
let AS (SELECT conv_id, u.p AS p, substr(best.a, u.p::INT, 1) AS edit FROM fin, LATERAL (SELECT unnest(range(1, length(best.a) + 1)) AS p) u),
pos AS (SELECT *, sum(CASE WHEN edit = 'I' THEN 0 ELSE 1 END) OVER w AS i, sum(CASE WHEN edit = 'D' THEN 0 ELSE 1 END) OVER w AS j FROM let WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
old AS (SELECT pos.*, role, text, max(CASE WHEN edit = 'K' AND ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY pos.conv_id) AS s FROM pos LEFT JOIN rows ON pos.conv_id IS NOT DISTINCT FROM rows.conv_id AND pos.i = rows.i),
line AS (SELECT conv_id, p, CASE WHEN edit = 'K' THEN role WHEN (j - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END AS l FROM old WHERE edit <> 'D'),
rep AS (SELECT conv_id, string_agg(l, chr(10) ORDER BY p) AS t FROM line GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(rep.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sums ON c.conv_id IS NOT DISTINCT FROM sums.conv_id LEFT JOIN fin ON c.conv_id IS NOT DISTINCT FROM fin.conv_id LEFT JOIN rep ON c.conv_id IS NOT DISTINCT FROM rep.conv_id"""
