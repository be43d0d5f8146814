"""DuckDB SQL with the results of operators 11 to 13."""

from __future__ import annotations

from netpulse.llm import credentials, repair, variants


def _crc32(text: str, table: str = "crc_table") -> str:
    """CRC-32 of a text's UTF-8 bytes; ``table`` is a list column of 256 entries, see CRC_TABLE."""
    digits = f"hex(encode({text}))"
    digit = "(instr('0123456789ABCDEF', substr({0}, {1}, 1)) - 1)"
    octets = (
        f"list_transform(range(1, length({digits}), 2), "
        f"lambda i: {digit.format(digits, 'i')} * 16 + {digit.format(digits, 'i + 1')})"
    )
    step = f"xor(c >> 8, {table}[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({octets}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


#: 256 entries by the rule of the reflected polynomial 0xEDB88320.
CRC_TABLE = """
    SELECT list(c ORDER BY n) AS crc_table FROM (
        SELECT n, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, n) AS c
        FROM range(256) AS t(n)
    )
"""

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _repair() -> str:
    """The edits by a recursion over the turns from the last; a row carries the cost and audit of each grammar state."""
    best = "least({})"

    def option(cost: str, letter: str, rest: str) -> str:
        return f"{{'cost': {cost} + {rest}.cost, 'audit': '{letter}' || {rest}.audit}}"

    def plain(state: str, initial: dict[str, str], changed: str) -> str:
        go = option("4", "D", f"b.{state}")
        keep = " ".join(
            f"WHEN w.letter = '{letter}' THEN {best.format(', '.join([go, option('3 + w.extra', 'R', f'b.{changed}'), option('w.extra', 'K', f'b.{to}')]))}"
            for letter, to in initial.items()
        )
        other = best.format(f"{go}, {option('3 + w.extra', 'R', f'b.{changed}')}")
        return f"CASE WHEN w.must_go THEN {go} {keep} ELSE {other} END"

    return f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
hashed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % {repair.DAMAGE_KINDS} AS kind
    FROM conversations, crc
), damaged AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM hashed, unnest(CASE kind WHEN 0 THEN []::INT[] WHEN 3 THEN [0, 1] ELSE [0] END) AS copies(copy)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS place,
        rtrim(text, {_SPACE}) AS trimmed, substr(role, 1, 1) AS initial
    FROM damaged
), compared AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS seen FROM placed
), marked AS (
    SELECT *, CASE WHEN trimmed = '' THEN 'blank' WHEN seen THEN 'duplicate'
            WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair
    FROM compared
), counted AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id
), turns AS (
    SELECT conv_id, place, initial AS letter, fault IN ('blank', 'duplicate') AS must_go,
        CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS extra
    FROM marked
), behind(conv_id, place, z, s, u, a) AS (
    SELECT conv_id, n + 1, {{'cost': 0, 'audit': ''}}, {{'cost': 6, 'audit': 'II'}}, {{'cost': 3, 'audit': 'I'}},
        {{'cost': 0, 'audit': ''}}
    FROM counted
    UNION ALL
    SELECT conv_id, place, least(z, {option('3', 'I', 'u')}), least(s, {option('3', 'I', 'u')}), u, a
    FROM (
        SELECT conv_id, place, z, s, least(u, {option('3', 'I', 'a')}) AS u, least(a, {option('3', 'I', 'u')}) AS a
        FROM (
            SELECT w.conv_id, w.place, {plain('z', {'s': 's', 'u': 'u'}, 'u')} AS z, {plain('s', {'u': 'u'}, 'u')} AS s,
                {plain('u', {'a': 'a'}, 'a')} AS u, {plain('a', {'u': 'u'}, 'u')} AS a
            FROM behind AS b JOIN turns AS w ON w.conv_id IS NOT DISTINCT FROM b.conv_id AND w.place = b.place - 1
        )
    )
), audits AS (
    SELECT conv_id, z.cost AS cost, z.audit AS audit FROM behind WHERE place = 1
), edits AS (
    SELECT conv_id, pos, substr(audit, pos, 1) AS edit,
        count(*) FILTER (substr(audit, pos, 1) <> 'I') OVER (PARTITION BY conv_id ORDER BY pos) AS place
    FROM audits, unnest(range(1, length(audit) + 1)) AS t(pos)
), written AS (
    -- the grammar says the role of a changed or inserted turn: after the system turn, users have odd places
    SELECT e.conv_id, e.pos, e.edit, p.role, p.text,
        sum(CASE WHEN e.edit = 'D' OR (e.edit = 'K' AND p.initial = 's') THEN 0 ELSE 1 END)
            OVER (PARTITION BY e.conv_id ORDER BY e.pos) AS said
    FROM edits AS e LEFT JOIN marked AS p
        ON p.conv_id IS NOT DISTINCT FROM e.conv_id AND p.place = e.place AND e.edit <> 'I'
), told AS (
    SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN said % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY pos) AS story
    FROM written WHERE edit <> 'D' GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
    coalesce(audit, '') AS audit, sha256(coalesce(story, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o
LEFT JOIN counted AS c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN audits AS d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN told AS t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _secrets() -> str:
    """Spans by running lengths of the text between matches; parts meet by a range join inside their block."""
    numbered = {kind: number for number, kind in enumerate(credentials.KINDS)} | {"end of block": -1}
    patterns = credentials.PATTERNS | {"end of block": credentials.BLOCK_END}
    found = "\nUNION ALL\n".join(
        f"""SELECT rid, {numbered[kind]} AS kind, start, start + length(match) AS "end" FROM (
    SELECT rid, match, sum(length(gap) + length(match)) OVER (PARTITION BY rid ORDER BY pos) - length(match) AS start FROM (
        SELECT rid, unnest(regexp_extract_all(text, {_quoted(p)})) AS match,
            unnest(string_split_regex(text, {_quoted(p)})[:-2]) AS gap,
            unnest(range(len(regexp_extract_all(text, {_quoted(p)})))) AS pos
        FROM texts WHERE regexp_matches(text, {_quoted(p)})
    )
) {f"WHERE length(regexp_extract(match, {_quoted('^' + p + '$')}, 2)) >= {credentials.LEAST_ASSIGNED}" if kind == "assign" else ""}"""
        for kind, p in patterns.items()
    )
    number = credentials.KINDS.index
    who, what, where = (tuple(number(k) for k in credentials.PARTS[part]) for part in ("who", "what", "where"))
    strong = tuple(number(k) for k in credentials.BASE)

    def any_of(kinds: tuple[int, ...]) -> str:
        return f"bool_or(o.kind IN ({', '.join(map(str, kinds))}))"

    def both(part: tuple[int, ...]) -> str:
        return f"({any_of(part)} AND ({any_of(tuple(k for k in part if k in strong))} OR {any_of(where)}))"

    base = ", ".join(map(str, strong))
    listed = "coalesce(string_agg({0} || ':' || start || ':' || \"end\", ',' ORDER BY start, kind) {1}, '')"
    name = "['" + "', '".join(credentials.KINDS) + "'][kind + 1]"
    return f"""
WITH texts AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), found AS (
{found}
), placed AS (
    SELECT *, count(*) FILTER (kind = -1) OVER (PARTITION BY rid ORDER BY start, kind ROWS UNBOUNDED PRECEDING) AS block
    FROM found
), added AS (
    SELECT w.rid, w.kind, w.start, w."end" FROM placed AS w JOIN placed AS o
        ON o.rid = w.rid AND o.block = w.block AND o.start BETWEEN w.start - {credentials.REACH} AND w.start + {credentials.REACH}
    WHERE w.kind >= {len(strong)} AND o.kind >= 0
    GROUP BY w.rid, w.kind, w.start, w."end"
    HAVING CASE w.kind WHEN {number("login")} THEN {both(what)} WHEN {number("proof")} THEN {both(who)}
        ELSE {any_of(who)} AND {any_of(what)} END
), kept AS (
    SELECT rid, kind, start, "end" FROM found WHERE kind IN ({base}) UNION ALL SELECT * FROM added
), told AS (
    SELECT rid, {", ".join(f"count(*) FILTER (kind = {number(kind)}) AS n_{kind}" for kind in credentials.BASE)},
        {listed.format(name, f"FILTER (kind IN ({base}))")} AS base, {listed.format(name, "")} AS spans
    FROM kept GROUP BY rid
)
SELECT doc_id, {", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in credentials.BASE)},
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN told USING (rid)
"""


def _variants() -> str:
    """Near words by their forms without one code point, which words one edit apart share."""
    h = _crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")
    return f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
runs AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[a-zÀ-ÿ]+')) AS run FROM documents
    ) WHERE length(run) >= {variants.LEAST_LENGTH} GROUP BY doc_id, run
), hashed AS (
    SELECT run, n, {h} AS h FROM runs, crc
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT CASE WHEN h % {variants.DAMAGED_PART} = 0
            THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
        FROM hashed
    ) WHERE length(word) >= {variants.LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {variants.LEAST_COUNT}
), shorter AS (
    SELECT word, pos, substr(word, 1, pos) || substr(word, pos + 2) AS rest FROM words, unnest(range(length(word))) AS t(pos)
), pairs AS (
    SELECT a.word, b.word AS other FROM shorter AS a JOIN shorter AS b ON a.rest = b.rest AND a.pos = b.pos AND a.word <> b.word
    UNION SELECT s.word, w.word FROM shorter AS s JOIN words AS w ON s.rest = w.word
    UNION SELECT w.word, s.word FROM shorter AS s JOIN words AS w ON s.rest = w.word
), near AS (
    SELECT p.word, count(*) AS n_near, first(p.other ORDER BY w.n DESC, encode(p.other)) AS best, max(w.n) AS best_n
    FROM pairs AS p JOIN words AS w ON w.word = p.other GROUP BY p.word
), formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= {variants.FORM_RATIO} * n THEN best END AS form,
        CASE WHEN best_n >= {variants.FORM_RATIO} * n THEN best_n END AS form_n
    FROM words LEFT JOIN near USING (word)
), steps AS (
    SELECT word, word AS root, form AS next FROM formed
    UNION ALL SELECT s.word, f.word, f.form FROM steps AS s JOIN formed AS f ON f.word = s.next
)
SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n FROM formed AS f JOIN steps AS s ON s.word = f.word AND s.next IS NULL
"""


ORACLES = {"op11_repair": _repair(), "op12_secrets": _secrets(), "op13_variants": _variants()}
