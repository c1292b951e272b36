"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from bidtide.llm import urls

_LINK = r"""href\s*=\s*["'']?(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#"''\s>]+)"""


def url_filter(damping: float = 0.85, steps: int = 20, share: float = 0.5) -> str:
    """Rules by a cross-free CASE, propagation as one CTE for each step."""
    low = lambda x: f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ordered = sorted(urls.RULES, key=lambda r: -len(r[0] + r[1]))
    case = lambda i: "CASE " + " ".join(f"WHEN (host = '{r[0]}' OR ends_with(host, '.{r[0]}')) AND starts_with(path, '{r[1]}') THEN '{(r[0] + r[1], r[2])[i]}'" for r in ordered) + " END"
    parts = [
        f"p AS (SELECT page_id, {low(r'''regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')''')} AS host, regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path, html FROM pages)",
        f"j AS (SELECT page_id, host, path, {case(0)} AS rule, {case(1)} AS fit FROM p)",
        "seed AS (SELECT CASE fit WHEN 'allow' THEN 't' ELSE 'd' END AS kind, host, count(*) / sum(count(*)) OVER (PARTITION BY fit) AS seed FROM j WHERE fit IS NOT NULL GROUP BY fit, host)",
        f"l AS (SELECT host AS src, {low('dst')} AS dst, count(*) AS n FROM (SELECT host, unnest(regexp_extract_all(html, '{_LINK}', 1, 'i')) AS dst FROM p) WHERE host <> '' AND dst <> '' AND host <> {low('dst')} GROUP BY ALL)",
        "e AS (SELECT 't' AS kind, src, dst, n / sum(n) OVER (PARTITION BY src) AS share FROM l UNION ALL SELECT 'd', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM l)",
        "s0 AS (SELECT kind, host, seed AS score FROM seed)",
    ]
    for k in range(steps):
        parts.append(f"c{k} AS MATERIALIZED (SELECT e.kind, e.dst AS host, {damping} * sum(score * share) AS score FROM s{k} JOIN e ON e.kind = s{k}.kind AND e.src = s{k}.host GROUP BY ALL)")
        parts.append(f"s{k + 1} AS MATERIALIZED (SELECT kind, host, sum(score) AS score FROM (FROM c{k} UNION ALL SELECT kind, host, seed * (1 - coalesce((SELECT sum(score) FROM c{k} WHERE c{k}.kind = seed.kind), 0)) FROM seed) GROUP BY ALL)")
    parts.append(f"f AS (SELECT host, coalesce(sum(score) FILTER (kind = 't'), 0) AS t, coalesce(sum(score) FILTER (kind = 'd'), 0) AS d FROM s{steps} GROUP BY host)")
    return "WITH " + ", ".join(parts) + f" SELECT page_id, j.host, path, rule, coalesce(fit, CASE WHEN coalesce(d, 0) * (1 - 1e-9) > {share} * (d + t) THEN 'block' ELSE 'allow' END) AS verdict FROM j LEFT JOIN f ON f.host = j.host"


_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_IP = r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"
_CARD = r"[0-9](?:[\x20-]?[0-9])+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_DIGITS = "regexp_replace(h, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN reverse({_DIGITS})[i]::int ELSE (reverse({_DIGITS})[i]::int * 2) // 10 + (reverse({_DIGITS})[i]::int * 2) % 10 END)) % 10 = 0"
_CHECKS = [
    ("email", _EMAIL, "true"), ("ip", _IP, "list_max(list_transform(string_split(h, '.'), lambda x: x::hugeint)) <= 255"),
    ("card", _CARD, f"length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}"), ("phone", _PHONE, f"length({_DIGITS}) BETWEEN 9 AND 15"),
]
_IBAN = r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b"
_SSN = r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"
_TURNED = "list_reduce(list_transform(string_split(substr(replace(h, ' ', ''), 5) || substr(replace(h, ' ', ''), 1, 4), ''), lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE c::int END), lambda a, c: (a * CASE WHEN c > 9 THEN 100 ELSE 10 END + c) % 97, 0)"
_MORE = [
    ("iban", _IBAN, f"{_TURNED} = 1"),
    ("ssn", _SSN, r"NOT regexp_matches(h, '^(000|666|9)|-00-|-0000$') AND regexp_matches(lower(substr(text, greatest(s - 40, 0) + 1, 80 + length(h))), '\b(ssn|social security|tax id)\b')"),
]


def personal_data() -> str:
    parts = []
    for order, (kind, pattern, check) in enumerate(_CHECKS + _MORE):
        cut = f"SELECT doc_id, text, regexp_extract_all(text, '{pattern}') AS hs, regexp_split_to_array(text, '{pattern}') AS gs FROM d"
        each = f"SELECT doc_id, text, unnest(range(1, len(hs) + 1)) AS i, hs, gs FROM ({cut})"
        placed = f"SELECT doc_id, text, hs[i] AS h, length(array_to_string(gs[1:i], '')) + length(array_to_string(hs[1:i - 1], '')) AS s FROM ({each})"
        parts.append(f"SELECT doc_id, {order} AS k, s, '{kind}:' || s || ':' || (s + length(h)) AS span FROM ({placed}) WHERE {check}")
    base = "coalesce(string_agg(span, ',' ORDER BY k, s) FILTER (k < 4), '')"
    counts = ", ".join(f"count(*) FILTER (k = {i}) AS n_{kind}" for i, (kind, *_) in enumerate(_CHECKS))
    return f"WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), f AS ({' UNION ALL '.join(parts)}) SELECT d.doc_id, {counts}, sha256({base}) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY k, s), '') AS spans FROM d LEFT JOIN f ON f.doc_id = d.doc_id GROUP BY d.doc_id"


def line_dedup(percent: int = 80, min_tokens: int = 1) -> str:
    """Prefix filter on exact frequencies, then the exact test on common tokens."""
    words = r"list_distinct(regexp_extract_all(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))"
    return f"""WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
l AS (SELECT doc_id, i - 1 AS line, {words} AS w FROM (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS l FROM s)),
k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id, line) AS r, doc_id, line, list_sort(w) AS w, len(w) AS n FROM l WHERE len(w) >= {min_tokens}),
c AS MATERIALIZED (SELECT min(r) AS r, w, any_value(n) AS n FROM k GROUP BY w),
t AS (SELECT r, n, unnest(w) AS t FROM c), f AS (SELECT t, count(*) AS df FROM t GROUP BY t),
p AS MATERIALIZED (SELECT r, n, t FROM (SELECT r, n, t, row_number() OVER (PARTITION BY r ORDER BY df, t) AS pos FROM t JOIN f USING (t)) WHERE pos <= n - ceil(n * {percent} / 100) + 1),
q AS (SELECT DISTINCT a.r AS a, b.r AS b FROM p a JOIN p b ON a.t = b.t AND a.r < b.r AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * {percent}),
m AS (SELECT DISTINCT b FROM q JOIN c x ON x.r = a JOIN c y ON y.r = b WHERE 100 * len(list_intersect(x.w, y.w)) >= {percent} * (x.n + y.n - len(list_intersect(x.w, y.w)))),
g AS (SELECT doc_id, line FROM k WHERE r NOT IN (SELECT r FROM c WHERE r NOT IN (SELECT b FROM m)))
SELECT doc_id, count(*) AS n_removed, string_agg(line::varchar, ',' ORDER BY line) AS removed_lines FROM g GROUP BY doc_id"""

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def ranked_search(top: int = 50) -> str:
    words = f"regexp_extract_all({_LOW.format('text')}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""WITH i AS (SELECT item_id, list_distinct(flatten(list({words}))) AS ts FROM benchmark WHERE text IS NOT NULL GROUP BY item_id),
q AS MATERIALIZED (SELECT item_id, unnest(ts) AS t FROM i), qs AS (SELECT DISTINCT t FROM q),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, ws, len(ws) AS n FROM (SELECT doc_id, {words} AS ws FROM documents WHERE text IS NOT NULL)),
g AS MATERIALIZED (SELECT count(*)::bigint AS nd, sum(n)::bigint AS l FROM d WHERE n > 0),
p AS MATERIALIZED (SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(ws) AS t FROM d) SEMI JOIN qs USING (t) GROUP BY r, doc_id, n, t),
w AS MATERIALIZED (SELECT t, floor(1000 * ln((2 * nd + 2)::double / (2 * count(*) + 1)))::bigint AS w FROM p, g GROUP BY t, nd),
c AS MATERIALIZED (SELECT r, doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nd) // l))) AS c FROM p JOIN w USING (t), g),
s AS (SELECT item_id, doc_id, sum(c)::bigint AS score FROM q JOIN c USING (t) GROUP BY item_id, r, doc_id HAVING sum(c) > 0),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::int AS rank, doc_id, score FROM s)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= {top}"""


def merkle_audit(arity: int = 16, levels: int = 12) -> str:
    """Levels as one CTE each; a node's siblings and its sibling-fold are carried up by every leaf."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::varchar) || ':' || {c} END"
    leaf = lambda text: "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    crc = "xor(list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint), lambda a, b: list_reduce([0::bigint, 1, 2, 3, 4, 5, 6, 7], lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END), xor(a, b)), 4294967295::bigint), 4294967295)"
    parts = [
        f"d AS MATERIALIZED (SELECT *, {leaf('text')} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {_LOW.format('text')} ELSE text END AS shown FROM documents)",
        f"l AS MATERIALIZED (SELECT row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS r, doc_id, coalesce('=' || source, '') AS tree, leaf, {leaf('shown')} AS folded FROM d)",
        "a0 AS MATERIALIZED (SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY r) - 1 AS i, leaf AS h FROM l)",
        "p0 AS MATERIALIZED (SELECT r, doc_id, leaf, tree, row_number() OVER (PARTITION BY tree ORDER BY r) - 1 AS i, '' AS proof, folded FROM l)",
    ]

    def climb(name: str, path: str) -> None:
        for k in range(levels):
            group = f"SELECT tree, i // {arity} AS i, list(h ORDER BY i) AS hs FROM {name}{k} WHERE tree IN (SELECT tree FROM {name}{k} WHERE i > 0) GROUP BY tree, i // {arity}"
            parts.append(f"g{name}{k} AS MATERIALIZED ({group})")
            parts.append(f"{name}{k + 1} AS MATERIALIZED (SELECT tree, i, sha256(array_to_string(hs, '')) AS h FROM g{name}{k} UNION ALL SELECT tree, i, h FROM {name}{k} WHERE tree NOT IN (SELECT tree FROM g{name}{k}))")
            at, left, right = f"p.i % {arity}", f"array_to_string(g.hs[1:p.i % {arity}], '')", f"array_to_string(g.hs[p.i % {arity} + 2:], '')"
            parts.append(f"{path}{k + 1} AS MATERIALIZED (SELECT p.r, p.doc_id, p.leaf, p.tree, p.i // {arity} AS i, CASE WHEN g.hs IS NULL THEN p.proof ELSE p.proof || {left} || {right} END AS proof, CASE WHEN g.hs IS NULL THEN p.folded ELSE sha256({left} || p.folded || {right}) END AS folded FROM {path}{k} p LEFT JOIN g{name}{k} g ON g.tree = p.tree AND g.i = p.i // {arity})")

    climb("a", "p")
    parts.append(f"b0 AS MATERIALIZED (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, h, tree AS named FROM a{levels})")
    parts.append(f"q0 AS MATERIALIZED (SELECT p.r, p.doc_id, p.leaf, '' AS tree, b.i, p.proof, p.folded, b.h AS subroot FROM p{levels} p JOIN b0 b ON b.named = p.tree)")
    climb("b", "q")
    return f"WITH {', '.join(parts)} SELECT q.doc_id, q.leaf, q0.subroot, t.h AS root, sha256(q.proof) AS proof_sha256, q.folded AS folded_root, q.folded = t.h AS verified FROM q{levels} q JOIN q0 ON q0.r = q.r, b{levels} t"
