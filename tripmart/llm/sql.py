"""DuckDB SQL for the queries that SQL can express."""

ORACLES: dict[str, str] = {}

WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

ORACLES["op8_source_mix"] = f"""
WITH sized AS (
    SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
           CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS key
    FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no
    FROM sized GROUP BY source),
rated AS (
    SELECT *, [5, 2, 1][no % 3 + 1] AS weight, source_size * 2 AS most FROM sources),
ordered AS (SELECT *, most / weight AS ratio FROM rated),
leveled AS (
    SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
               - coalesce(sum(most) OVER (ORDER BY ratio, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY ratio, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM ordered),
common AS (SELECT arg_min(level, (ratio, no)) AS level FROM leveled WHERE level <= ratio),
targets AS (
    SELECT source, source_size, least(CAST(most AS DOUBLE), weight * coalesce(common.level, 'inf'::DOUBLE)) AS target
    FROM leveled, common),
queued AS (
    SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS goal,
           CAST(coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       greatest(0, least(goal - ahead, size)) + greatest(0, least(goal - ahead - source_size, size)) AS taken
FROM queued
"""

ORACLES["op1_substring_dedup"] = f"""
WITH docs AS (SELECT doc_id, {WORDS} AS words FROM documents),
windows AS (
    SELECT doc_id, start, sha256(array_to_string(words[start:start + 12], ' ')) AS gram
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS start FROM docs)),
firsts AS (SELECT gram, min(doc_id) AS low FROM windows GROUP BY gram HAVING min(doc_id) < max(doc_id)),
cuts AS (
    SELECT doc_id, list(start) AS starts
    FROM windows JOIN firsts USING (gram) WHERE low < doc_id GROUP BY doc_id),
covered AS (
    SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS place FROM (SELECT doc_id, unnest(starts) AS s FROM cuts)),
lists AS (SELECT doc_id, list(place) AS places FROM covered GROUP BY doc_id),
kept AS (
    SELECT doc_id, words, coalesce(len(places), 0) AS n_removed,
           CASE WHEN places IS NULL THEN words
                ELSE [words[i] FOR i IN range(1, len(words) + 1) IF NOT list_contains(places, i)] END AS rest
    FROM docs LEFT JOIN lists USING (doc_id))
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(rest, ' '), '')) AS kept_sha256
FROM kept
"""

ORACLES["op5_lm_score"] = f"""
WITH docs AS (SELECT doc_id, {WORDS} AS words FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM docs),
tokens AS (
    SELECT doc_id, i, words[i] AS w, CASE WHEN i > 1 THEN words[i - 1] END AS v FROM places),
own1 AS (SELECT doc_id, w, count(*) AS n FROM tokens GROUP BY ALL),
own2 AS (SELECT doc_id, v, w, count(*) AS n FROM tokens WHERE i > 1 GROUP BY ALL),
all1 AS (SELECT w, sum(n) AS n FROM own1 GROUP BY w),
all2 AS (SELECT v, w, sum(n) AS n FROM own2 GROUP BY ALL),
total AS (SELECT sum(n) AS n FROM all1),
lengths AS (SELECT doc_id, len(words) AS n_words FROM docs),
joined AS (
    SELECT t.doc_id, t.i, greatest(total.n - l.n_words, 1) AS others,
           a.n - o.n AS word, b.n - p.n AS pair, c.n - q.n AS history
    FROM tokens t
    JOIN lengths l ON t.doc_id = l.doc_id
    CROSS JOIN total
    JOIN all1 a ON a.w = t.w
    JOIN own1 o ON o.doc_id = t.doc_id AND o.w = t.w
    LEFT JOIN all2 b ON b.v = t.v AND b.w = t.w
    LEFT JOIN own2 p ON p.doc_id = t.doc_id AND p.v = t.v AND p.w = t.w
    LEFT JOIN all1 c ON c.w = t.v
    LEFT JOIN own1 q ON q.doc_id = t.doc_id AND q.w = t.v),
scored AS (
    SELECT doc_id,
           CASE WHEN i > 1 AND pair > 0 THEN ln(pair / history)
                WHEN word > 0 THEN ln(word / others) + CASE WHEN i > 1 THEN ln(0.4) ELSE 0 END
                ELSE -ln(others + 1) + CASE WHEN i > 1 THEN 2 ELSE 1 END * ln(0.4) END AS term,
           CASE WHEN (i > 1 AND pair > 0) OR (i = 1 AND word > 0) THEN 0 ELSE 1 END AS backed
    FROM joined)
SELECT l.doc_id, CAST(l.n_words AS BIGINT) AS n_words, CAST(coalesce(sum(backed), 0) AS BIGINT) AS n_backoff,
       round(avg(term), 6) AS log_score
FROM lengths l LEFT JOIN scored s ON l.doc_id = s.doc_id
GROUP BY l.doc_id, l.n_words
"""


def crc32_of(text: str) -> str:
    """Unsigned crc32 of an ASCII text, bit by bit."""
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(range(1, len({text}) + 1), lambda i: CAST(ascii({text}[i]) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, b: {bits}), 4294967295)"


# ---- digest trees: sixteen nodes become one, level by level


def _field(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _levels(name: str, first: str, levels: int) -> tuple[str, str]:
    """CTEs of all levels over ``first`` (s, i, n, d), and of what stands left and right of each node."""
    tables = [f"{name}0 AS ({first})"]
    for k in range(levels):
        tables.append(
            f"""{name}{k + 1} AS (
    SELECT s, i // 16 AS i, (any_value(n) + 15) // 16 AS n,
           CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d
    FROM {name}{k} GROUP BY s, i // 16)"""
        )
    run = "string_agg(d, '') OVER (PARTITION BY s, i // 16 ORDER BY i ROWS BETWEEN"
    sides = [
        f"""{name}_sides{k} AS (
    SELECT s, i, n, coalesce({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
           coalesce({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM {name}{k})"""
        for k in range(levels)
    ]
    return ", ".join(tables), ", ".join(sides)


def _climb(name: str, first: str, tree: str, place: str, levels: int) -> str:
    """CTEs that carry ``proof`` and ``folded`` of every row up all levels."""
    steps = []
    for k in range(levels):
        before = first if k == 0 else f"{name}_up{k}"
        steps.append(
            f"""{name}_up{k + 1} AS (
    SELECT u.* REPLACE (u.proof || w.l || w.r AS proof,
                        CASE WHEN w.n > 1 THEN sha256(w.l || u.folded || w.r) ELSE u.folded END AS folded)
    FROM {before} u JOIN {name}_sides{k} w ON w.s = u.{tree} AND w.i = u.{place} // {16**k})"""
        )
    return ", ".join(steps)


_ROW_LEVELS, _GROUP_LEVELS = 7, 4  # enough for 268 million rows of a source, and 65,536 sources
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
_ROW = ("doc_id", "source", "lang", "n_chars", "text")
_ROW_TREE, _ROW_SIDES = _levels("node", "SELECT s, i, n, leaf AS d FROM placed", _ROW_LEVELS)
_TOP_TREE, _TOP_SIDES = _levels(
    "top",
    "SELECT '' AS s, row_number() OVER (ORDER BY s) - 1 AS i, count(*) OVER () AS n, d "
    f"FROM node{_ROW_LEVELS}",
    _GROUP_LEVELS,
)

ORACLES["op12_merkle_manifest"] = f"""
WITH digests AS (
    SELECT doc_id, coalesce('=' || source, '') AS s, sha256({" || ".join(map(_field, _ROW))}) AS leaf,
           CASE WHEN {crc32_of("CAST(doc_id AS VARCHAR)")} % 5 = 0
                THEN sha256({" || ".join(_field(_LOWER(c) if c == "text" else c) for c in _ROW)})
                END AS changed
    FROM documents),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
           count(*) OVER (PARTITION BY s) AS n
    FROM digests),
{_ROW_TREE}, {_ROW_SIDES}, {_TOP_TREE}, {_TOP_SIDES},
groups AS (SELECT s, d AS subroot, row_number() OVER (ORDER BY s) - 1 AS g, '' AS whole FROM node{_ROW_LEVELS}),
start AS (
    SELECT p.*, subroot, g, whole, '' AS proof, coalesce(changed, leaf) AS folded
    FROM placed p JOIN groups ON groups.s = p.s),
{_climb("node", "start", "s", "i", _ROW_LEVELS)},
{_climb("top", f"node_up{_ROW_LEVELS}", "whole", "g", _GROUP_LEVELS)}
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = d AS verified
FROM top_up{_GROUP_LEVELS}, (SELECT d FROM top{_GROUP_LEVELS})
"""


# ---- periodic runs: equal stretches of five words at a distance of one period

ORACLES["op13_periodic_runs"] = f"""
WITH given AS (
    SELECT doc_id, {WORDS} AS words, {crc32_of("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
split AS (SELECT *, len(words) AS n, h // 10 AS g FROM given),
cut AS (
    SELECT *, h % 10 = 0 AND n > 0 AS repeats, CASE WHEN n > 0 THEN g % n END AS a,
           CASE WHEN n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p
    FROM split),
docs AS (
    SELECT doc_id, n, CASE WHEN repeats
        THEN [words[1 + CASE WHEN k < a THEN k ELSE a + (k - a) % p END] FOR k IN range(n)] ELSE words END AS words
    FROM cut),
places AS (
    SELECT doc_id, n, i, array_to_string(words[i + 1:i + 5], ' ') AS five
    FROM (SELECT doc_id, n, words, unnest(range(n - 4)) AS i FROM docs WHERE n >= 6)),
pairs AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q FROM places x
    JOIN places y ON x.doc_id = y.doc_id AND x.five = y.five AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (
    SELECT doc_id, q, min(i) AS start, max(i) - min(i) + 5 + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs)
    GROUP BY doc_id, q, island),
long AS (SELECT * FROM stretches WHERE length >= greatest(6, 4 * q)),
runs AS (
    SELECT doc_id, start, length, q AS period FROM long a
    WHERE NOT EXISTS (
        SELECT 1 FROM long b WHERE b.doc_id = a.doc_id AND b.q < a.q
        AND b.start <= a.start AND b.start + b.length >= a.start + a.length)),
listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS text,
           arg_max(struct_pack(a := start, b := length, c := period), (length, -start, -period)) AS best
    FROM runs GROUP BY doc_id),
dropped AS (
    SELECT doc_id, list(DISTINCT place) AS places
    FROM (SELECT doc_id, unnest(range(start + period, start + length)) AS place FROM runs) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.a AS BIGINT) AS start, CAST(best.b AS BIGINT) AS length,
       CAST(best.c AS BIGINT) AS period, CAST(1000 * best.b // best.c AS BIGINT) AS exponent_milli,
       sha256(coalesce(l.text, '')) AS runs_sha256,
       sha256(coalesce(array_to_string(CASE WHEN places IS NULL THEN words
           ELSE [words[k + 1] FOR k IN range(n) IF NOT list_contains(places, k)] END, ' '), '')) AS collapsed_sha256
FROM docs d LEFT JOIN listed l ON l.doc_id = d.doc_id LEFT JOIN dropped x ON x.doc_id = d.doc_id
"""
