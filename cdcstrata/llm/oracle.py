"""SQL for the operators whose results SQL can express.

The two joins go by all pairs and closure, the manifest level by level, repairs by a table of best endings from the last row
back, lines by grouping. CRC-32 is worked out bit by bit.
"""

from __future__ import annotations

NEAR_VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
usable AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len([x for x in e if x <> 0]) > 0
    AND len([x for x in e if x IS NULL OR isnan(x) OR isinf(x)]) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_of AS (SELECT a, MIN(b) AS least FROM reach GROUP BY a),
counted AS (SELECT a, COUNT(*) AS n FROM links GROUP BY a)
SELECT vec_id, COALESCE(n, 0) AS n_links, LEAST(vec_id, COALESCE(least, vec_id)) AS component_id,
  vec_id <= COALESCE(least, vec_id) AS kept
FROM v LEFT JOIN counted ON counted.a = vec_id LEFT JOIN least_of ON least_of.a = vec_id
"""

JACCARD_JOIN = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, [x for x in string_split_regex(lower(COALESCE(text, '')), '\s+') if x <> ''] AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, UNNEST(CASE WHEN len(w) >= 5
    THEN [array_to_string(list_slice(w, i, i + 4), ' ') for i in range(1, len(w) - 3)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT a, b, c = p.n AND c = q.n AS same FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 10 * c >= 8 * (p.n + q.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_of AS (SELECT a, MIN(b) AS least FROM reach GROUP BY a),
counted AS (SELECT a, COUNT(*) AS n, MIN(CASE WHEN same THEN b END) AS copy FROM links GROUP BY a)
SELECT doc_id, LEAST(doc_id, COALESCE(least, doc_id)) AS class_id, LEAST(doc_id, COALESCE(copy, doc_id)) AS copy_id,
  COALESCE(n, 0) AS n_links
FROM documents LEFT JOIN counted ON counted.a = doc_id LEFT JOIN least_of ON least_of.a = doc_id
"""


#: The table of CRC-32, from its polynomial, and the checksum of a text of single-byte characters.
CRC = """
bits AS (
  SELECT i, list_reduce([i] || list_transform(range(8), lambda k: CAST(0 AS BIGINT)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(i)),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM bits)"""


def crc32(text: str) -> str:
    step = "xor(crc_table.t[CAST(xor(c, x) % 256 AS INTEGER) + 1], c >> 8)"
    signs = f"list_transform(string_split({text}, ''), lambda s: CAST(ascii(s) AS BIGINT))"
    return f"xor(list_reduce([CAST(4294967295 AS BIGINT)] || {signs}, lambda c, x: {step}), 4294967295)"


#: Levels of runs of 16 that the SQL climbs in a source, and among sources.
LEVELS = 6


def _encoded(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || {value} END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_encoded(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _climb(name: str, keys: str, order: str) -> tuple[str, str]:
    """Tables ``name``0 to ``name``LEVELS of nodes (keys, r, n, h) up from ``name``0, and the joins that give each leaf its siblings."""
    at = "" if not keys else f"PARTITION BY {keys}"
    on = " AND ".join(f"{{a}}.{k} IS NOT DISTINCT FROM {{b}}.{k}" for k in keys.split(", ")) if keys else "TRUE"
    tables, joins = [], []
    for k in range(LEVELS):
        up, g = f"{name}{k + 1}", ", ".join(x for x in (keys, "n", "r // 16") if x)
        tables.append(
            f"{up} AS (SELECT {keys + ',' if keys else ''} r // 16 AS r, CAST(ceil(n / 16.0) AS BIGINT) AS n, "
            f"CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY r)) ELSE min(h) END AS h FROM {name}{k} GROUP BY {g})"
        )
        tables.append(
            f"{name}s{k} AS (SELECT {keys + ',' if keys else ''} r, n, h, list(h) OVER w AS l, row_number() OVER (PARTITION BY "
            f"{', '.join(x for x in (keys, 'r // 16') if x)} ORDER BY r) AS i FROM {name}{k} "
            f"WINDOW w AS (PARTITION BY {', '.join(x for x in (keys, 'r // 16') if x)} ORDER BY r "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"
        )
        joins.append(f"JOIN {name}s{k} ON {on.format(a=f'{name}s{k}', b='x')} AND {name}s{k}.r = x.{name}r // {16**k}")
    return ", ".join(tables), " ".join(joins)


def _merkle() -> str:
    low, low_joins = _climb("a", "source", "doc_id")
    high, high_joins = _climb("b", "", "source")
    sides = []
    for s in (*[f"as{k}" for k in range(LEVELS)], *[f"bs{k}" for k in range(LEVELS)]):
        left = f"COALESCE(array_to_string({s}.l[1:{s}.i - 1], ''), '')"
        right = f"COALESCE(array_to_string({s}.l[{s}.i + 1:], ''), '')"
        sides.append(f"{{'use': {s}.n > 1, 'p': CASE WHEN {s}.n > 1 THEN {left} ELSE '' END, 'q': CASE WHEN {s}.n > 1 THEN {right} ELSE '' END}}")
    fold = "x.leaf2"
    tables = []
    for k in range(2 * LEVELS):
        tables.append(f"f{k} AS (SELECT * REPLACE (CASE WHEN steps[{k + 1}].use THEN sha256(steps[{k + 1}].p || fold || steps[{k + 1}].q) ELSE fold END AS fold) FROM {f'f{k - 1}' if k else 'paths'})")
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH {CRC.strip()},
leaves AS (
  SELECT doc_id, source, {_leaf('text')} AS h, COALESCE({crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0, FALSE) AS hit,
    {_leaf(lowered)} AS lowered FROM documents, crc_table),
a0 AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS r, COUNT(*) OVER (PARTITION BY source) AS n
  FROM leaves),
{low},
b0 AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r, COUNT(*) OVER () AS n FROM a{LEVELS}),
{high},
x AS (
  SELECT l.doc_id, l.source, l.h AS leaf, CASE WHEN l.hit THEN l.lowered ELSE l.h END AS leaf2, l.r AS ar, b0.r AS br, b0.h AS subroot
  FROM a0 l JOIN b0 ON b0.source IS NOT DISTINCT FROM l.source),
paths AS (
  SELECT x.doc_id, x.leaf, x.subroot, b{LEVELS}.h AS root, {fold} AS fold, [{', '.join(sides)}] AS steps
  FROM x {low_joins} {high_joins} CROSS JOIN b{LEVELS}),
{', '.join(tables)}
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s.p || s.q), '')) AS proof_sha256,
  fold AS folded_root, fold = root AS verified
FROM f{2 * LEVELS - 1}
"""


LINES = r"""
WITH l AS (
  SELECT doc_id, UNNEST(string_split(COALESCE(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(COALESCE(text, ''), chr(10)), 1) AS i, text FROM documents),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
common AS (
  SELECT key, MAX(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING COUNT(DISTINCT doc_id) >= 5)
SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (keeper IS NOT NULL AND doc_id <> keeper) AS n_dropped,
  sha256(COALESCE(string_agg(line, chr(10) ORDER BY i) FILTER (keeper IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM k LEFT JOIN common USING (key) GROUP BY doc_id
"""


def _repairs() -> str:
    """Best endings (cost, audit, repaired rows) of each state (nothing, s, u, a last), from the last row of a conversation back.

    ``b`` holds them after a row, ``i`` with the inserts before the next one: two at most, as three would come back to a state.
    """
    user, assistant = 3, 4
    to = {1: user, 2: user, 3: assistant, 4: user}
    name = {user: "user", assistant: "assistant"}

    def put(q: int, best: str, cost: str, initial: str, line: str | None) -> str:
        rest = f"{best}[{q}]"
        lines = f"{rest}.r" if line is None else f"[{line}] || {rest}.r"
        return f"{{'c': {rest}.c + {cost}, 'a': '{initial}' || {rest}.a, 'r': {lines}}}"

    def inserted(best: str) -> str:
        """Endings with any number of inserts first."""
        once = [f"list_min([{best}[{q}], {put(to[q], best, '2', 'I', chr(39) + name[to[q]] + ':' + chr(39))}])" for q in to]
        return "[" + ", ".join(once) + "]"

    kept = {1: {"s": 2, "u": user}, 2: {"u": user}, 3: {"a": assistant}, 4: {"u": user}}
    after = []
    for q in to:
        ways = [put(q, "e.i", "3", "D", None)]
        line = f"'{name[to[q]]}:' || d.text"
        ways.append(f"CASE WHEN d.fault IN ('', 'T') THEN {put(to[q], 'e.i', '2 + d.late', 'R', line)} END")
        for letter, p in kept[q].items():
            own = put(p, "e.i", "d.late", "K", "d.role || ':' || d.text")
            ways.append(f"CASE WHEN d.fault IN ('', 'T') AND d.letter = '{letter}' THEN {own} END")
        after.append(f"list_min([{', '.join(ways)}])")
    none = "{'c': 1000000000, 'a': '', 'r': CAST([] AS VARCHAR[])}"
    good = "{'c': 0, 'a': '', 'r': CAST([] AS VARCHAR[])}"
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    key = "COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' ')"
    return f"""
WITH RECURSIVE {CRC.strip()},
kinds AS (SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text, {crc32(key)} % 20 AS kind
  FROM conversations, crc_table),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    UNNEST(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM kinds WHERE kind <> 0),
numbered AS (
  SELECT *, trim(text, {blanks}) AS bare, substr(role, 1, 1) AS letter,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    COUNT(*) OVER (PARTITION BY conv_id) AS n FROM hurt),
d AS (
  SELECT *, CASE WHEN bare = '' THEN 'B' WHEN i > MIN(i) OVER (PARTITION BY conv_id, role, text) THEN 'D'
      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'T' ELSE '' END AS fault,
    CASE WHEN bare <> '' AND right(bare, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS late,
    CASE WHEN i > 1 AND lag(letter) OVER (PARTITION BY conv_id ORDER BY i) || letter NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END AS ill
  FROM numbered),
faults AS (
  SELECT conv_id, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps, COUNT(*) FILTER (fault = 'B') AS blank,
    COUNT(*) FILTER (fault = 'D') AS duplicate, COUNT(*) FILTER (fault = 'T') AS truncated, SUM(ill) AS illegal
  FROM d GROUP BY conv_id),
steps AS (
  SELECT conv_id, n + 1 AS i, [{good}, {none}, {none}, {good}] AS b FROM (SELECT DISTINCT conv_id, n FROM d)
  UNION ALL
  SELECT e.conv_id, d.i, [{', '.join(after)}] AS b
  FROM (SELECT conv_id, pos, {inserted('p.b')} AS i FROM (SELECT conv_id, i AS pos, {inserted('o.b')} AS b FROM steps o) p) e
    JOIN d ON d.conv_id IS NOT DISTINCT FROM e.conv_id AND d.i = e.pos - 1),
best AS (SELECT conv_id, b FROM steps WHERE i = 1),
once AS (SELECT conv_id, {inserted('b')} AS b FROM best),
twice AS (SELECT conv_id, {inserted('b')} AS b FROM once)
SELECT c.conv_id, COALESCE(gaps, 0) AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate,
  COALESCE(truncated, 0) AS truncated, COALESCE(illegal, 0) AS illegal, COALESCE(twice.b[1].c, 0) AS cost,
  COALESCE(twice.b[1].a, '') AS audit, sha256(COALESCE(array_to_string(twice.b[1].r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN twice ON twice.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_jaccard_join": JACCARD_JOIN,
        "op6_near_vectors": NEAR_VECTORS,
        "op11_merkle": _merkle(),
        "op12_conversations": _repairs(),
        "op13_line_dedup": LINES,
    }
