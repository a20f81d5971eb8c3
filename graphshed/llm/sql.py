"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

# A-Z become lower case and nothing else does; all else that is no word becomes a space.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

JACCARD = rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS MATERIALIZED (SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b USING (sh) JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
    WHERE 100 * least(na.n, nb.n) >= 90 * greatest(na.n, nb.n) GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 90 * (na.n + nb.n - count(*))),
r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.least, d.doc_id) AS component_id FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS least FROM r GROUP BY x) c USING (doc_id)
"""

_UP_TO_255 = "0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"(list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN ({_DIGITS})[-i]::INT WHEN ({_DIGITS})[-i]::INT > 4 THEN 2 * ({_DIGITS})[-i]::INT - 9 ELSE 2 * ({_DIGITS})[-i]::INT END)) % 10 = 0)"
_PLAIN = "regexp_replace(m, '[^A-Z0-9]', '', 'g')"
_MOD97 = f"(list_reduce(list_transform(range(1, length({_PLAIN}) + 1), lambda i: strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', (substr({_PLAIN}, 5) || {_PLAIN}[1:4])[i]) - 1), lambda a, c: CASE WHEN c > 9 THEN (a * 100 + c) % 97 ELSE (a * 10 + c) % 97 END) = 1)"
#: kind, pattern, test, checksum's score, words that speak for it (none: always kept).
_KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true", 0, None),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", rf"regexp_full_match(m, '{_UP_TO_255}(\.{_UP_TO_255}){{3}}')", 0, None),
    ("card", r"[0-9]([\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}", 0, None),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15", 0, None),
    ("iban", r"[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]{4}){2,7}(\x20?[A-Z0-9]{1,3})?", f"length(replace(m, ' ', '')) BETWEEN 15 AND 34 AND {_MOD97} AND NOT regexp_matches(CASE WHEN a > 0 THEN t[a] ELSE '' END || ' ' || substr(t, a + 1 + length(m), 1), '[A-Za-z0-9]')", 0.4, "iban|account|bank|konto|cuenta|compte"),
    ("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "NOT regexp_matches(m, '^(000|666|9)|-00-|0000$')", 0, "ssn|social security|national id|seguridad social"),
    ("passport", r"\b[A-Z]{1,2}[0-9]{6,8}\b", "true", 0, "passport|reisepass|pasaporte|passeport|ausweis"),
    ("birth", r"\b((19|20)[0-9]{2}-(0?[1-9]|1[0-2])-(0?[1-9]|[12][0-9]|3[01])|(0?[1-9]|[12][0-9]|3[01])[./](0?[1-9]|1[0-2])[./](19|20)[0-9]{2})\b", "true", 0, "born|birth|geboren|geburt|nacid|nacimiento|naissance"),
]


def _scored(test: str, checksum: float, words: str | None) -> str:
    if words is None:
        return test
    said = f"CASE WHEN regexp_matches(lower(pre), '{words}') THEN 0.4 ELSE 0 END - CASE WHEN regexp_matches(lower(pre), 'example|sample|dummy|fake|beispiel|muster|ejemplo|exemple') THEN 0.3 ELSE 0 END"
    return f"{test} AND 0.4 + {checksum} + {said} >= 0.8"


def _spans(kinds: list[tuple[str, str, str]]) -> str:
    """(row, k, kind, a, b, m) of the matches that pass their kind's test. What stands between matches gives their places."""
    return " UNION ALL ".join(
        f"""SELECT row, {k} AS k, '{kind}' AS kind, a, a + length(m) AS b, m FROM (SELECT row, t, m[i] AS m, right(g[i], 40) AS pre,
            (list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS a
            FROM (SELECT row, t, g, m, unnest(range(1, len(m) + 1)) AS i FROM (SELECT row, t, string_split_regex(t, '{pattern}') AS g, regexp_extract_all(t, '{pattern}') AS m FROM d) x) y) z WHERE {test}"""
        for k, (kind, pattern, test) in enumerate(kinds)
    )


_COUNTS = ", ".join(f"count(*) FILTER (WHERE kind = '{kind}') AS n_{kind}" for kind, *_ in _KINDS[:4])
_ZEROES = ", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind, *_ in _KINDS[:4])

PII = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents), f AS ({_spans([(kind, pattern, _scored(test, checksum, words)) for kind, pattern, test, checksum, words in _KINDS])}),
g AS (SELECT row, {_COUNTS}, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY k, a) FILTER (WHERE k < 4) AS base, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY k, a) AS spans FROM f GROUP BY row)
SELECT d.doc_id, {_ZEROES}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (row)
"""

_NAME = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = rf"""({_NAME})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_SECRET_KINDS = [("assign", _ASSIGN, f"length(regexp_extract(m, '{_ASSIGN}', 2)) >= 6"), ("access", "AKIA[A-Z0-9]+", "length(m) >= 20"), ("hex", "[0-9a-f]+", "length(m) >= 24")]
_TOKEN = "[A-Za-z0-9+/_-]{20,}={0,2}"
_LETTERS = "etaoinsrhldcumfpgwybvkxjzq"
#: encoding, alphabet, characters, fit, whether letters are turned to lower or upper case.
_ENCODINGS = [
    ("hex", "eadcfb0123456789", "0-9a-f", "regexp_full_match(x, '[0-9a-f]+|[0-9A-F]+')", "lower"),
    ("letters", _LETTERS, "a-z", "regexp_full_match(x, '[a-z]+|[A-Z]+')", "lower"),
    ("base32", _LETTERS.upper() + "234567", "A-Z2-7", "regexp_full_match(x, '[A-Z2-7]+')", "upper"),
    ("base36", _LETTERS + "0123456789", "0-9a-z", "regexp_full_match(x, '[0-9a-z]+|[0-9A-Z]+')", "lower"),
    ("base52", _LETTERS + _LETTERS.upper(), "A-Za-z", "regexp_full_match(x, '[A-Za-z]+')", ""),
    ("base64", _LETTERS + _LETTERS.upper() + "0123456789+/", "A-Za-z0-9+/", "true", ""),
]


def _case(of: str, value) -> str:
    return f"CASE {of} " + " ".join(f"WHEN '{e[0]}' THEN {value(e)}" for e in _ENCODINGS) + " END"


def _cased(text: str):
    return lambda e: {"lower": f"translate({text}, '{UPPER}', '{LOWER}')", "upper": f"translate({text}, '{LOWER}', '{UPPER}')", "": text}[e[4]]


def _erfc(x: str) -> str:
    """erfc for x >= 0 by its rational polynomial, good to 1.2e-7 of its value."""
    t, power = f"(1 / (1 + ({x}) / 2))", "0.17087277::DOUBLE"
    for c in ("-0.82215223", "1.48851587", "-1.13520398", "0.27886807", "-0.18628806", "0.09678418", "0.37409196", "1.00002368", "-1.26551223"):
        power = f"({power} * {t} + ({c})::DOUBLE)"
    return f"({t} * exp({power} - ({x}) * ({x})))"


def _upper(z: str) -> str:
    x = f"(abs({z}) / sqrt(2.0::DOUBLE))"
    return f"(CASE WHEN {z} >= 0 THEN {_erfc(x)} / 2 ELSE 1 - {_erfc(x)} / 2 END)"


SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents), f AS ({_spans(_SECRET_KINDS)}),
e AS (SELECT row, a, b, replace(translate(m, '-_', '+/'), '=', '') AS x FROM ({_spans([("random", _TOKEN, "true")])}) y WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.row = y.row AND f.a < y.b AND y.a < f.b)),
e2 AS (SELECT *, CASE {" ".join(f"WHEN {fits} THEN '{name}'" for name, _, _, fits, _ in _ENCODINGS)} END AS enc, floor(log2(length(x)))::INT AS class FROM e),
own AS (SELECT row, a, b, enc, class, {_case("enc", _cased("x"))} AS w, 1 AS own FROM e2),
rest AS (SELECT row, enc, class, n, array_to_string(list_transform(regexp_extract_all(regexp_replace(t, '{_TOKEN}', ' ', 'g'), '[A-Za-z]+'), lambda x: upper(x[1]) || lower(x[2:]) || length(x) % 10), '') AS r FROM (SELECT row, enc, class, min(length(w)) AS n FROM own GROUP BY row, enc, class) x JOIN d USING (row)),
ring AS (SELECT row, enc, class, n, {_case("enc", lambda e: f"regexp_replace({_cased('r')(e)}, '[^{e[2]}]', '', 'g')")} AS ring FROM rest),
decoy AS (SELECT row, NULL::BIGINT AS a, NULL::BIGINT AS b, enc, class, substr(ring || repeat(ring, n // length(ring) + 1), (j * length(ring)) // 20 + 1, n) AS w, 0 AS own FROM (SELECT *, unnest(range(0, 20)) AS j FROM ring WHERE ring <> '') x),
s AS (SELECT *, {_case("enc", lambda e: f"'{e[1]}'")} AS alphabet FROM (SELECT * FROM own UNION ALL SELECT * FROM decoy) x),
r AS (SELECT *, length(alphabet) AS z, length(w) AS n, list_transform(regexp_extract_all(w, '.'), lambda c: strpos(alphabet, c) - 1) AS ranks FROM s),
h AS (SELECT *, least(z, greatest(2, n // 5)) AS cells FROM r),
c AS (SELECT *, greatest(list_sum(list_transform(range(0, cells), lambda i: pow(len(list_filter(ranks, lambda x: x * cells // z = i))::DOUBLE, 2) * z / (n * (ceil((i + 1) * z / cells) - ceil(i * z / cells))))) - n, 0) AS chi, 2::DOUBLE / (9 * (cells - 1)) AS spread,
    list_sum(list_transform(range(1, n::INT), lambda i: ((ranks[i] * 2 >= z) <> (ranks[i + 1] * 2 >= z))::INT)) AS changes,
    list_sum(list_transform(range(1, n::INT), lambda i: (ranks[i] - (z - 1) / 2) * (ranks[i + 1] - (z - 1) / 2))) AS serial FROM h),
v AS (SELECT *, (pow(chi / (cells - 1), 1.0::DOUBLE / 3) - (1 - spread)) / sqrt(spread) AS z1, abs(changes - (n - 1) / 2) / sqrt((n - 1) / 4) AS z2, abs(serial) / ((z * z - 1) / 12) / sqrt(n - 1) AS z3 FROM c),
q AS (SELECT row, a, b, enc, class, own, least(3000, floor(-log10(greatest(least(1.0, 3 * least({_upper("z1")}, 2 * {_upper("z2")}, 2 * {_upper("z3")})), 1e-300)) * 10))::INT AS step FROM v),
k AS (SELECT enc, class, step, sum(own) AS own, sum(1 - own) AS decoy FROM q GROUP BY enc, class, step),
o AS (SELECT *, sum(own) OVER w AS mine, sum(decoy) OVER w AS like_it, sum(own) OVER (PARTITION BY enc, class) AS every, sum(decoy) OVER (PARTITION BY enc, class) AS decoys FROM k WINDOW w AS (PARTITION BY enc, class ORDER BY step)),
l AS (SELECT enc, class, max(step) AS most FROM o WHERE (1 + like_it)::DOUBLE / (1 + decoys) * every / mine <= 0.05::DOUBLE GROUP BY enc, class),
u AS (SELECT row, k, kind, a, b FROM f UNION ALL SELECT row, 3, 'random', a, b FROM q JOIN l USING (enc, class) WHERE own = 1 AND step <= most),
g AS (SELECT row, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k) FILTER (WHERE k < 3) AS base, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k) AS spans FROM u GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (row)
"""

_WORDS = rf"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

DECONTAMINATION = f"""
WITH i AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
k AS (SELECT DISTINCT item_id, least(13, len(words)) AS width, array_to_string(words[p:p + least(13, len(words)) - 1], ' ') AS key FROM (SELECT item_id, words, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS p FROM i WHERE len(words) > 0) x),
d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS words FROM documents),
h AS (SELECT row, p, width, item_id FROM (SELECT row, p, width, array_to_string(words[p:p + width - 1], ' ') AS key FROM (SELECT row, words, width, unnest(range(1, len(words) - width + 2)) AS p FROM d, (SELECT DISTINCT width FROM k) w WHERE len(words) >= width) x) y JOIN k USING (width, key)),
n AS (SELECT row, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM h GROUP BY row),
u AS (SELECT row, count(DISTINCT q) AS n_hit FROM (SELECT row, unnest(range(p, p + width)) AS q FROM h) x GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated FROM d LEFT JOIN n USING (row) LEFT JOIN u USING (row)
"""

# Five hex digits at a time are four letters of base 32.
_HEX5 = "list_reduce(list_transform(range(5 * c + 1, 5 * c + 6), lambda i: strpos('0123456789abcdef', h[i]) - 1), lambda a, x: a * 16 + x)"
_BASE32 = f"list_reduce(list_transform(range(0, 8), lambda c: list_reduce(list_transform([15, 10, 5, 0], lambda s: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(({_HEX5}) >> s) % 32 + 1]), lambda a, x: a || x)), lambda a, x: a || x)"

WARC = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages), f AS (SELECT payload, min(page_id) AS first FROM p GROUP BY payload),
q AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS h, first FROM p JOIN f USING (payload))
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM q
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_ngram_jaccard_join": JACCARD, "op4_pii": PII, "op5_benchmark_decontamination": DECONTAMINATION, "op7_secret_scans": SECRETS, "op8_warc": WARC}
