"""DuckDB SQL for the queries that SQL can express."""


def _collocations() -> str:
    """Phrases by lists of words; cuts and containment by joins on the phrase."""
    grams = "\n    UNION ALL ".join(
        f"SELECT lang, {m} AS m, unnest(list_transform(range(1, len(w) - {m - 2}), lambda i: array_to_string(w[i:i + {m - 1}], ' '))) AS phrase FROM pieces WHERE len(w) >= {m}"
        for m in range(1, 6))
    return rf"""
WITH parts AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL),
pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]'), lambda x: x <> '') AS w FROM parts),
grams AS ({grams}),
counts AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE m > 1 AND a >= 100),
cuts AS (
    SELECT lang, phrase, m, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
    FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates)),
scores AS (
    SELECT c.lang, c.phrase, c.m, c.a, c.k, f.a AS l, s.a AS r, t.n,
           ((1000::HUGEINT * c.a * t.n) // (f.a::HUGEINT * s.a))::BIGINT AS score
    FROM cuts c JOIN counts f ON f.lang = c.lang AND f.phrase = c.first AND f.m = c.k
    JOIN counts s ON s.lang = c.lang AND s.phrase = c.rest AND s.m = c.m - c.k JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
    SELECT * FROM best b WHERE NOT EXISTS (
        SELECT 1 FROM candidates c WHERE c.lang = b.lang AND c.m > b.m AND 100 * c.a >= 100 * b.a
        AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000
"""


def _clusters() -> str:
    """Three rounds of assignment and floored means as a chain of views; distances in long."""
    floor_mean = "((total - ((total % n) + n) % n) // n)::BIGINT"

    def assigned(k: int) -> str:
        return f"""
a{k} AS MATERIALIZED (
    SELECT row, vec_id, v, arg_min(cluster, (d, cluster)) AS cluster, min(d)::BIGINT AS distance FROM (
        SELECT x.row, x.vec_id, x.v, c.cluster, list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
        FROM vectors x, c{k} c) GROUP BY row, vec_id, v)"""

    def moved(k: int) -> str:
        return f"""
m{k} AS (
    SELECT cluster, list({floor_mean} ORDER BY place) AS v FROM (
        SELECT cluster, place, sum(x)::HUGEINT AS total, count(*)::HUGEINT AS n
        FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, 65)) AS place FROM a{k}) GROUP BY cluster, place) GROUP BY cluster),
c{k + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{k} c LEFT JOIN m{k} m USING (cluster))"""

    chain = ",".join(f"{assigned(k)},{moved(k)}" for k in range(3)) + "," + assigned(3)
    return f"""
WITH vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
    SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1)::INTEGER AS cluster, v FROM vectors WHERE vec_id IS NOT NULL
    QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id), v) <= 16),{chain}
SELECT a.vec_id, a.cluster, a.distance, sum(a.distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia,
       sum(a.distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a3 a JOIN c3 c USING (cluster)
"""


#: Lower-casing of A-Z alone, and words between white space.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quality() -> str:
    """Counts of the base rules; quartiles of bucket counts, and the fences that stand in for small groups."""
    from tidewatch.llm.quality import FENCE_RANGES, LEAST_DOCUMENTS, LEAST_WORDS, SIGNALS

    values = {"symbols": "n_symbols * 1000 // greatest(word_chars, 1)", "same_lines": "n_dup_lines * 1000 // greatest(n_lines, 1)",
              "repeats": "n_repeat_words * 1000 // greatest(n_words, 1)", "word_length": "word_chars * 100 // greatest(n_words, 1)"}
    sketch = "\n    UNION ALL ".join(f"SELECT lang, source, '{name}' AS signal, {name} AS v FROM good" for name, _, _ in SIGNALS)
    reach = "CASE signal " + " ".join(f"WHEN '{name}' THEN greatest((q3 - q1) * {FENCE_RANGES}, {least})" for name, least, _ in SIGNALS) + " END"

    def fences(name: str, keys: list[str]) -> str:
        part = ", ".join([*keys, "signal"])
        columns = "".join(f"{k}, " for k in keys)
        return f"""
{name}_b AS (SELECT {columns}signal, bucket, sum(n) AS n FROM sketch GROUP BY ALL),
{name}_r AS (SELECT *, sum(n) OVER (PARTITION BY {part} ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {part}) AS total FROM {name}_b),
{name} AS (SELECT *, q3 + {reach} AS high, q1 - {reach} AS low FROM (
    SELECT {columns}signal, max(total) AS docs, min(bucket) FILTER (upto * 4 >= total) AS q1, min(bucket) FILTER (upto * 4 >= total * 3) AS q3
    FROM {name}_r GROUP BY ALL))"""

    def fence(name: str, end: str) -> str:
        return (f"(CASE WHEN (SELECT max(docs) FROM narrow x WHERE x.lang IS NOT DISTINCT FROM m.lang AND x.source IS NOT DISTINCT FROM m.source) >= {LEAST_DOCUMENTS} "
                f"THEN (SELECT {end} FROM narrow x WHERE signal = '{name}' AND x.lang IS NOT DISTINCT FROM m.lang AND x.source IS NOT DISTINCT FROM m.source) "
                f"WHEN (SELECT max(docs) FROM by_lang x WHERE x.lang IS NOT DISTINCT FROM m.lang) >= {LEAST_DOCUMENTS} "
                f"THEN (SELECT {end} FROM by_lang x WHERE signal = '{name}' AND x.lang IS NOT DISTINCT FROM m.lang) "
                f"ELSE (SELECT {end} FROM overall WHERE signal = '{name}') END)")

    limits = ", ".join([f"{fence(name, 'high')} AS {name}_high" for name, _, _ in SIGNALS] + [f"{fence(name, 'low')} AS {name}_low" for name, _, low in SIGNALS if low])
    tests = " AND ".join([f"coalesce({name} <= {name}_high, true)" for name, _, _ in SIGNALS] + [f"coalesce({name} >= {name}_low, true)" for name, _, low in SIGNALS if low])
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
grams AS (SELECT row, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS g FROM d WHERE len(w) > 2),
twice AS (SELECT row, i FROM (SELECT *, count(*) OVER (PARTITION BY row, g) AS n FROM grams) WHERE n > 1),
repeated AS (SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY row),
lines AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
base AS (
    SELECT row, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
           coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines
    FROM lines LEFT JOIN repeated r USING (row)),
m AS MATERIALIZED (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed, {', '.join(f'{v} AS {k}' for k, v in values.items())} FROM base),
good AS (SELECT * FROM m WHERE NOT base_failed),
signals AS ({sketch}),
sketch AS MATERIALIZED (SELECT lang, source, signal, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS bucket, count(*) AS n FROM signals GROUP BY ALL),
{fences('narrow', ['lang', 'source'])},{fences('by_lang', ['lang'])},{fences('overall', [])},
judged AS (SELECT m.*, {limits} FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {tests} AS kept FROM judged
"""


def _contamination() -> str:
    """Windows of the items' sizes in documents, met with those of the items."""
    from tidewatch.llm.wumanber import WINDOW

    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({_LOWER}, '{pattern}') AS w FROM documents),
items AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER}, '{pattern}') AS w FROM benchmark WHERE text IS NOT NULL),
sized AS (SELECT item, w, least({WINDOW}, len(w)) AS m FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS g FROM sized),
sizes AS (SELECT DISTINCT m FROM windows),
grams AS (SELECT row, m, unnest(range(1, len(w) - m + 2)) AS i, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS g FROM d, sizes WHERE len(w) >= m),
met AS MATERIALIZED (SELECT row, grams.m, i, item FROM grams JOIN windows USING (m, g)),
hits AS (SELECT row, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT row, unnest(range(i, i + m)) AS p FROM met) GROUP BY row),
found AS (SELECT row, list_sort(list(DISTINCT item) FILTER (item IS NOT NULL)) AS names FROM met GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(names), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(names, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (row) LEFT JOIN found USING (row)
"""


def _chats() -> str:
    """Digests from the turns themselves; the formatted length by the template's marks and the number of escapes."""
    from tidewatch.llm.chat import OTHER, OTHER_END, ROLE_END, TEMPLATE

    def escapes(column: str) -> str:
        control = r"<\\*(?:<SYS>>|</SYS>>|s>|/s>)|\[\\*(?:INST\]|/INST\]|ROLE\]|/ROLE\]|END\])"
        return f"len(regexp_extract_all({column}, '{control}'))"

    marks = " ".join(f"WHEN '{role}' THEN {len(before) + len(after)}" for role, (before, after, _) in TEMPLATE.items())
    order = "ORDER BY turn NULLS FIRST, role, text"
    return rf"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' {order}) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(text) + {escapes('text')} + CASE role {marks} ELSE {len(OTHER) + len(ROLE_END) + len(OTHER_END)} + length(role) + {escapes('role')} END)::BIGINT AS formatted_chars,
       regexp_matches(string_agg(role, chr(10) {order}), '^(system\n)?(user\nassistant\n)*user\nassistant$') AS valid
FROM t GROUP BY conv_id
"""


def _archives() -> str:
    """SHA-1 in base 32 by five hexadecimal digits, four letters, at a time."""
    letters = ", ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 5 * g + 1, 5))::INTEGER >> {shift}) & 31), 1)" for shift in (15, 10, 5, 0))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
r AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, array_to_string(flatten(list_transform(range(8), lambda g: [{letters}])), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM r
"""


def _repeats() -> str:
    """Windows of 13 words as texts, and the smallest document of each."""
    from tidewatch.llm.substrings import WINDOW

    return rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
grams AS MATERIALIZED (SELECT row, doc_id, unnest(range(1, len(w) - {WINDOW - 2})) AS i,
    unnest(list_transform(range(1, len(w) - {WINDOW - 2}), lambda i: array_to_string(w[i:i + {WINDOW - 1}], ' '))) AS g FROM d WHERE len(w) >= {WINDOW}),
least_of AS (SELECT g, min(doc_id) AS first FROM grams GROUP BY g HAVING count(*) > 1),
hit AS (SELECT row, i FROM grams JOIN least_of USING (g) WHERE first < doc_id),
gone AS (SELECT DISTINCT row, unnest(range(i, i + {WINDOW})) AS p FROM hit),
gone_of AS (SELECT row, list(p) AS places FROM gone GROUP BY row),
kept AS (SELECT doc_id, w, coalesce(places, []) AS places,
    CASE WHEN places IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(places, i)) END AS left_words FROM d LEFT JOIN gone_of USING (row))
SELECT doc_id, len(w)::BIGINT AS n_words, len(places)::BIGINT AS n_removed, sha256(array_to_string(left_words, ' ')) AS kept_sha256 FROM kept
"""


ORACLES: dict[str, str] = {
    "op1_quality_rules": _quality(),
    "op5_decontamination": _contamination(),
    "op8_chat_format": _chats(),
    "op9_warc_normaliser": _archives(),
    "op10_substring_dedup": _repeats(),
    "op11_phrase_collocations": _collocations(),
    "op12_centroid_clusters": _clusters(),
}
