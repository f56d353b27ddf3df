"""DuckDB statements of the queries that SQL can express, written apart from the operators."""

from __future__ import annotations


def crc32(text: str) -> str:
    """The unsigned crc32 of an ASCII string."""
    bits = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END"
    eight = f"list_reduce(list_prepend(xor(crc, byte), [0,0,0,0,0,0,0,0]::UBIGINT[]), LAMBDA c, _: {bits})"
    codes = f"list_transform(range(1, length({text}) + 1), LAMBDA i: ord(substr({text}, i, 1))::UBIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), LAMBDA crc, byte: {eight}), 4294967295::UBIGINT)"


def chat_format(control: str) -> str:
    """op11: the digests straight from the rows, and the length of the template with its escapes."""
    role = r"replace(replace(role, '%', '%25'), '>', '%3E')"
    text = r"regexp_replace(text, '<(\\*/?turn)', '<\\\1', 'g')"
    return f"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{control}' UNION ALL SELECT -7, 1, 'assistant', '{control}'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(text))) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, md5(text)) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    sum(length('<turn ' || {role} || '>' || {text} || '</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM said GROUP BY conv_id"""


def conversation_repair() -> str:
    """op12: dynamic programming from the last row on; a way is its cost in eight digits, its audit, chr(1) and its repaired rows."""
    def way(after: str, cost: str, initial: str, row: str | None = None) -> str:
        price = f"printf('%08d', substr({after}, 1, 8)::INTEGER + {cost})"
        if row is None:
            return f"({price} || '{initial}' || substr({after}, 9))"
        rest = f"substr({after}, strpos({after}, chr(1)) + 1)"
        joined = f"CASE WHEN {rest} = '' THEN {row} ELSE {row} || chr(10) || {rest} END"
        return f"({price} || '{initial}' || substr({after}, 9, strpos({after}, chr(1)) - 9) || chr(1) || {joined})"

    keep = {"nothing": {"s": "system", "u": "after_user"}, "system": {"u": "after_user"},
            "after_user": {"a": "after_assistant"}, "after_assistant": {"u": "after_user"}}
    made = {"nothing": ("after_user", "user"), "system": ("after_user", "user"), "after_user": ("after_assistant", "assistant"),
            "after_assistant": ("after_user", "user")}

    def edits(state: str) -> str:
        ways = [way(f"w.{state}", "3", "D")]
        for initial, to in keep[state].items():
            ways.append(f"CASE WHEN stays AND initial = '{initial}' THEN {way(f'w.{to}', 'cut', 'K', 'said')} END")
        to, role = made[state]
        renamed = f"'{role}:' || text"
        ways.append(f"CASE WHEN stays THEN {way(f'w.{to}', '2 + cut', 'R', f'({renamed})')} END")
        return f"least({', '.join(ways)}) AS {state}"

    def inserted(state: str, role: str) -> str:
        return way(state, "2", "I", f"'{role}:'")

    key = "(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))"
    blank = r"'^[\x20\x09-\x0D]*$'"
    return f"""
WITH RECURSIVE marked AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32(key)} % 20 AS fault FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM marked WHERE fault != 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS place,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS repeated,
        regexp_matches(text, {blank}) AS blank,
        NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS open
    FROM damaged
), coded AS (
    SELECT conv_id, turn, place, text, role || ':' || text AS said, substr(role, 1, 1) AS initial, blank,
        repeated AND NOT blank AS repeated, open AND NOT blank AND NOT repeated AS truncated,
        NOT blank AND NOT repeated AS stays, (open AND NOT blank AND NOT repeated)::INTEGER AS cut,
        lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before
    FROM placed
), ways AS (
    SELECT conv_id, max(place) AS place, '00000000' || chr(1) AS nothing, '00000004II' || chr(1) || 'user:' || chr(10) || 'assistant:' AS system,
        '00000002I' || chr(1) || 'assistant:' AS after_user, '00000000' || chr(1) AS after_assistant
    FROM coded GROUP BY conv_id
    UNION ALL
    SELECT conv_id, place - 1, least(nothing, {inserted("user", "user")}), least(system, {inserted("user", "user")}), "user", assistant
    FROM (
        SELECT conv_id, place, nothing, system, least(after_user, {inserted("after_assistant", "assistant")}) AS "user",
            least(after_assistant, {inserted("after_user", "user")}) AS assistant
        FROM (
            SELECT c.conv_id, c.place, {edits("nothing")}, {edits("system")}, {edits("after_user")}, {edits("after_assistant")}
            FROM ways w JOIN coded c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.place = w.place
        )
    )
), best AS (
    SELECT conv_id, nothing AS way, strpos(nothing, chr(1)) AS mark FROM ways WHERE place = 0
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (WHERE blank) AS blank,
        count(*) FILTER (WHERE repeated) AS duplicate, count(*) FILTER (WHERE truncated) AS truncated,
        count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM coded GROUP BY conv_id
)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(substr(way, 1, 8)::BIGINT, 0) AS cost,
    coalesce(substr(way, 9, mark - 9), '') AS audit, sha256(coalesce(substr(way, mark + 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM a.conv_id"""


def merkle_manifest(levels: int = 8) -> str:
    """op13: trees of up to 16 ** ``levels`` leaves, a source's and the one over the sources, node by node."""
    def field(name: str) -> str:
        return f"coalesce(strlen({name}::VARCHAR) || ':' || {name}::VARCHAR, '-')"

    def tree(name: str, leaves: str) -> str:
        """CTEs of a tree: level k as (grp, i, h, n), n being the nodes of the group's level."""
        parts = [f"{name}0 AS ({leaves})"]
        for k in range(1, levels + 1):
            parts.append(f"""{name}{k} AS (
    SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM (
        SELECT grp, i // 16 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {name}{k - 1} WHERE n > 1 GROUP BY grp, i // 16))""")
        return ",\n".join(parts)

    def path(name: str) -> str:
        """CTEs that lead from every leaf (grp, i) up: its siblings left and right on each level."""
        runs = " UNION ALL ".join(
            f"SELECT {k} AS level, grp, i // 16 AS run, list(h ORDER BY i) AS hs FROM {name}{k} WHERE n > 1 GROUP BY grp, i // 16"
            for k in range(levels))
        return f"""{name}runs AS ({runs}),
{name}steps AS (
    SELECT l.grp, l.i, list({{'l': array_to_string(r.hs[:(l.i // (16 ** r.level)::BIGINT) % 16], ''),
        'r': array_to_string(r.hs[(l.i // (16 ** r.level)::BIGINT) % 16 + 2:], '')}} ORDER BY r.level) AS steps
    FROM {name}0 l JOIN {name}runs r ON r.grp = l.grp AND r.run = l.i // (16 ** (r.level + 1))::BIGINT GROUP BY l.grp, l.i)"""

    tops = " UNION ALL ".join(f"SELECT grp, h FROM a{k} WHERE n = 1" for k in range(levels + 1))
    ends = " UNION ALL ".join(f"SELECT h FROM b{k} WHERE n = 1" for k in range(levels + 1))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    plain = " || ".join(field(name) for name in ("doc_id", "source", "lang", "n_chars"))
    fold = "list_reduce(list_prepend({'l': x, 'r': ''}, steps), LAMBDA node, step: {'l': sha256(step.l || node.l || step.r), 'r': ''}).l"
    return f"""
WITH hashed AS (
    SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS grp, sha256({plain} || {field("text")}) AS h,
        CASE WHEN {crc32("doc_id::VARCHAR")} % 5 = 0 THEN sha256({plain} || {field(lowered)}) END AS altered
    FROM documents
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY grp) AS n FROM hashed
),
{tree("a", "SELECT grp, i, h, n FROM leaves")},
{path("a")},
tops AS ({tops}),
{tree("b", "SELECT 0 AS grp, row_number() OVER (ORDER BY grp) - 1 AS i, h, count(*) OVER () AS n, grp AS source FROM tops")},
{path("b")},
ends AS ({ends}),
whole AS (
    SELECT l.doc_id, l.h AS leaf, t.h AS subroot, e.h AS root, coalesce(l.altered, l.h) AS x,
        list_concat(coalesce(s.steps, []), coalesce(u.steps, [])) AS steps
    FROM leaves l JOIN tops t ON t.grp = l.grp JOIN b0 o ON o.source = l.grp CROSS JOIN ends e
    LEFT JOIN asteps s ON s.grp = l.grp AND s.i = l.i LEFT JOIN bsteps u ON u.i = o.i
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, LAMBDA s: s.l || s.r), '')) AS proof_sha256,
    {fold} AS folded_root, {fold} = root AS verified
FROM whole"""
