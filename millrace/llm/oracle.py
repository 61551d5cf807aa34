"""The text queries in plain SQL for another engine, where SQL can express them."""

from __future__ import annotations

from millrace.llm import line_dedup, quality_rules

EXACT_DEDUP = """
WITH d AS (SELECT doc_id, coalesce("text", '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size,
       d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)"""

WARC = """
WITH p AS (SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, url, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first
            THEN first END AS refers_to
FROM q"""

# Chunks of several lines, the shortest runs with enough words from and up to each line (found
# without chunks), and all of equal content but the first.
LINE_DEDUP = f"""
WITH d AS (SELECT DISTINCT doc_id, "text" AS t FROM documents WHERE "text" IS NOT NULL),
n AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, t) AS row_no, doc_id, t,
             string_split(t, chr(10)) AS ls FROM d),
l AS (SELECT row_no, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS i FROM n),
w AS (SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words,
             CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h FROM l),
k AS (SELECT *, (h + {line_dedup.MULTIPLIER} * coalesce(lag(h) OVER o, 0))
                % {line_dedup.MODULUS} AS r,
             sum(words) OVER o AS up_to, sum(words) OVER o - words AS before
      FROM w WHERE words > 0 WINDOW o AS (PARTITION BY row_no ORDER BY i)),
m AS (SELECT *, lag(r, 2) OVER o AS a, lag(r) OVER o AS b, lead(r) OVER o AS c,
             lead(r, 2) OVER o AS e, lead(words) OVER o AS next_words
      FROM k WINDOW o AS (PARTITION BY row_no ORDER BY i)),
x AS (SELECT *, coalesce(r <= a AND r <= b, FALSE) OR coalesce(r <= b AND r < c, FALSE)
                OR coalesce(r < c AND r < e, FALSE) OR words >= {line_dedup.LINE_WORDS}
                OR coalesce(next_words >= {line_dedup.LINE_WORDS}, FALSE) AS ends FROM m),
y AS (SELECT *, coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY row_no ORDER BY i
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM x),
s AS (SELECT row_no, min(i) AS a, max(i) + 1 AS b FROM y GROUP BY row_no, chunk
      HAVING count(*) >= {line_dedup.LEAST_LINES}
      UNION
      SELECT p.row_no, p.i, q.i + 1 FROM k p ASOF JOIN k q
        ON p.row_no = q.row_no AND p.before + {line_dedup.PASSAGE_WORDS} < q.up_to
      UNION
      SELECT q.row_no, p.i, q.i + 1 FROM k q ASOF JOIN k p
        ON p.row_no = q.row_no AND q.up_to - {line_dedup.PASSAGE_WORDS} > p.before),
z AS (SELECT s.row_no, s.a, s.b, n.doc_id, array_to_string(n.ls[s.a + 1:s.b], chr(10)) AS content
      FROM s JOIN n USING (row_no)),
f AS (SELECT row_no, a, b, first_value(row_no) OVER o AS first_row, first_value(b) OVER o AS first_b
      FROM z WINDOW o AS (PARTITION BY content ORDER BY doc_id NULLS FIRST, row_no, a, b)),
g AS (SELECT DISTINCT l.row_no, l.i FROM l JOIN f
        ON l.row_no = f.row_no AND l.i >= f.a AND l.i < f.b
      WHERE NOT (f.row_no = f.first_row AND f.a < f.first_b)),
v AS (SELECT row_no, i, i - row_number() OVER (PARTITION BY row_no ORDER BY i) AS island FROM g),
c AS (SELECT row_no, min(i) AS a, max(i) + 1 AS b FROM v GROUP BY row_no, island),
t AS (SELECT row_no, string_agg(a || '-' || b, ',' ORDER BY a) AS removed FROM c GROUP BY row_no),
u AS (SELECT l.row_no, string_agg(l.line, chr(10) ORDER BY l.i) AS kept, count(*) AS kept_lines
      FROM l LEFT JOIN g ON l.row_no = g.row_no AND l.i = g.i WHERE g.i IS NULL GROUP BY l.row_no)
SELECT o.doc_id, CASE WHEN o."text" IS NULL THEN NULL ELSE coalesce(u.kept, '') END AS "text",
       CAST(coalesce(len(string_split(o."text", chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(u.kept_lines, 0) AS BIGINT) AS kept_lines, coalesce(t.removed, '') AS removed
FROM documents o LEFT JOIN n ON o.doc_id IS NOT DISTINCT FROM n.doc_id AND o."text" = n.t
LEFT JOIN u ON u.row_no = n.row_no LEFT JOIN t ON t.row_no = n.row_no"""


def minhash(words: int, percent: int) -> str:
    """All pairs of documents by their shared shingles, and what can be reached from each."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce("text", ''), '{upper}', '{upper.lower()}'),
                            '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT r, unnest(CASE
        WHEN len(ws) = 0 THEN []
        WHEN len(ws) < {words} THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - {words - 2}),
                            lambda i : array_to_string(ws[i:i + {words - 1}], ' ')) END) AS sh
      FROM d),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS x, b.r AS y, count(*) AS shared FROM s a JOIN s b ON a.sh = b.sh AND a.r < b.r
      GROUP BY a.r, b.r),
k AS (SELECT x, y FROM p JOIN n a ON a.r = x JOIN n b ON b.r = y
      WHERE 100 * shared >= {percent} * (a.n + b.n - shared)),
e AS (SELECT x, y FROM k UNION ALL SELECT y, x FROM k),
reach AS (SELECT r AS x, r AS y FROM d
          UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x),
c AS (SELECT x, min(doc_id) AS component_id FROM reach JOIN d ON d.r = reach.y GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id,
       d.doc_id IS NOT DISTINCT FROM c.component_id AS kept
FROM d JOIN c ON c.x = d.r LEFT JOIN n ON n.r = d.r"""


def quality() -> str:
    """The same histograms, divergences and counts, document by document."""
    q = quality_rules
    space, steps, rest = r"[\x20\x09-\x0D]", [], "t"
    for i, pattern in enumerate(q.CHAR_CLASSES):
        pattern = pattern.replace("'", "''")
        steps.append(f"regexp_replace({rest}, '{pattern}', '', 'g') AS r{i}")
        rest = f"r{i}"
    chain = ", ".join(steps)
    names = ["t", *(f"r{i}" for i in range(len(q.CHAR_CLASSES)))]
    counts = [f"length({a}) - length({b})" for a, b in zip(names, names[1:], strict=False)]
    chars = "[" + ", ".join([*counts, f"length({names[-1]})"]) + "]"
    listed = "[" + ", ".join(f"'{word}'" for word in q.WORDS) + "]"
    sizes = {"chars": len(q.CHAR_CLASSES) + 1, "words": len(q.WORDS) + 1}
    sums = {
        name: "[" + ", ".join(f"sum({name}[{i + 1}])" for i in range(n)) + "]"
        for name, n in sizes.items()
    }

    def informed(x: str) -> str:
        return f"CASE WHEN {x} > 0 THEN {x} * log2({x}) ELSE 0.0 END"

    def shares(of: str) -> str:
        return f"list_transform({of}, lambda x : x / greatest(list_sum({of}), 1)::DOUBLE)"

    def distance(name: str) -> str:
        own, other = (
            f"list_sum(list_transform({side}.{name}_s, lambda x : {informed('x')}))"
            for side in ("h", "f")
        )
        means = (
            f"list_sum(list_transform(list_zip(h.{name}_s, f.{name}_s), lambda z : "
            f"{informed('((z[1] + z[2]) / 2)')}))"
        )
        return f"round(sqrt(greatest(({own} + {other}) / 2 - {means}, 0.0)), 6)"

    return f"""
WITH b AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce("text", '') AS t
           FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
             list_filter(regexp_split_to_array(lower(t), '[^\\p{{L}}]+'), lambda x : x <> '') AS lw,
             list_filter(string_split(t, chr(10)),
                         lambda x : regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls,
             {chain} FROM b),
c AS (SELECT r, doc_id, lang, len(ws) AS n_words,
             length(regexp_replace(t, '{space}+', '', 'g')) AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, ws, {chars} AS chars,
             list_append(list_transform({listed}, lambda x : len(list_filter(lw, lambda y : y = x))),
                         len(list_filter(lw, lambda y : NOT list_contains({listed}, y)))) AS words
      FROM w),
x AS (SELECT r, unnest(range(1, len(ws) - {q.WINDOW - 2})) AS i,
             unnest(list_transform(range(1, len(ws) - {q.WINDOW - 2}),
               lambda i : array_to_string(ws[i:i + {q.WINDOW - 1}], ' '))) AS v
      FROM c WHERE len(ws) >= {q.WINDOW}),
y AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, v) AS n FROM x) WHERE n > 1),
z AS (SELECT r, sum(least({q.WINDOW}, coalesce(e - i, {q.WINDOW}))) AS n_repeat_words
      FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS e FROM y) GROUP BY r),
g AS (SELECT lang, {sums['chars']} AS chars, {sums['words']} AS words FROM c
      WHERE list_sum(chars) >= {q.GUARD_CHARS}
        AND 100 * chars[{q.SYMBOLS + 1}] <= {q.MOST_SYMBOLS} * list_sum(chars)
        AND 100 * chars[{q.CAPITALS + 1}] <= {q.MOST_CAPITALS} * list_sum(chars)
      GROUP BY lang),
f AS (SELECT {shares('chars')} AS chars_s, {shares('words')} AS words_s FROM g
      WHERE lang IS NOT NULL OR NOT EXISTS (SELECT 1 FROM g WHERE lang IS NOT NULL)),
h AS (SELECT *, {shares('chars')} AS chars_s, {shares('words')} AS words_s,
             list_sum(chars) AS all_chars, list_sum(words) AS all_words FROM c),
m AS (SELECT r, min({distance('chars')}) AS char_distance, min({distance('words')}) AS word_distance
      FROM h, f GROUP BY r),
v AS (SELECT h.doc_id, n_words, word_chars, n_symbols, n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             coalesce(char_distance, 0.0) AS char_distance,
             coalesce(word_distance, 0.0) AS word_distance, all_chars, all_words
      FROM h LEFT JOIN m USING (r) LEFT JOIN z USING (r)),
j AS (SELECT *, n_words < {q.LEAST_WORDS}
             OR 100 * n_repeat_words > {q.REPEATED_PERCENT} * n_words AS base_failed FROM v)
SELECT doc_id, n_words, word_chars, n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       n_repeat_words, base_failed,
       NOT base_failed
       AND char_distance <= {q.CHAR_DISTANCE} * sqrt(greatest(
             {q.FULL_CHARS}::DOUBLE / greatest(all_chars, 1), 1.0))
       AND word_distance <= {q.WORD_DISTANCE} * sqrt(greatest(
             {q.FULL_WORDS}::DOUBLE / greatest(all_words, 1), 1.0)) AS kept,
       char_distance, word_distance
FROM j"""


# Tokens by a pattern, draws from the hash of the id, parts as joined tokens.
FILL_MIDDLE = r"""
WITH d AS (SELECT doc_id, coalesce("text", '') AS t,
                  sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
k AS (SELECT *, regexp_extract_all(t,
               '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
             CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
             CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
             CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
             greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                       OR h3 % 100 >= 50 THEN 'plain'
                  WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (SELECT *, array_to_string(units[1:a], '') AS prefix,
             array_to_string(units[a + 1:b], '') AS middle,
             array_to_string(units[b + 1:], '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END)
         AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""

# Damage, faults, and for each row and state the least (cost, audit) of all ways to get there.
# best holds for the states (nothing, system, user, assistant) the cost, the audit and the roles
# so far; a row is deleted, kept or given another role, after no or one inserted message.
CONVERSATIONS = r"""
WITH RECURSIVE steps AS (
  SELECT list_transform(range(256), lambda c: list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crcs),
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce("text", ' ') AS t,
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':'
                 || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
drawn AS (SELECT raw.*, xor(list_reduce(
            list_concat([4294967295], list_transform(string_split(key, ''), lambda c: ord(c))),
            lambda x, c: xor(crcs[(xor(x, c) & 255) + 1], x >> 8)), 4294967295) % 20 AS draw
          FROM raw, steps),
damaged AS (SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
                   CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(t, '.!?', '') ELSE t END AS t,
                   unnest(range(CASE WHEN draw = 3 THEN 2 ELSE 1 END)) AS copy
            FROM drawn WHERE draw <> 0),
trimmed AS (SELECT *, sha256(t) AS digest, substr(role, 1, 1) AS initial,
                   rtrim(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
            FROM damaged),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id
                     ORDER BY turn NULLS FIRST, role, digest) AS place,
                   count(*) OVER (PARTITION BY conv_id) AS n FROM trimmed),
repeats AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, t ORDER BY place) AS again
            FROM ordered),
faults AS (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN again > 1 THEN 'duplicate'
                          WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated'
                          ELSE 'none' END AS fault,
                  lag(initial) OVER (PARTITION BY conv_id ORDER BY place) AS before FROM repeats),
counted AS (SELECT conv_id,
                   coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank,
                   count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (place > 1 AND before || initial NOT IN ('su', 'ua', 'au'))
                     AS illegal FROM faults GROUP BY conv_id),
states(state, next, wants, name) AS (
  VALUES (0, 2, 'u', 'user'), (1, 2, 'u', 'user'), (2, 3, 'a', 'assistant'), (3, 2, 'u', 'user')),
walk AS (
  SELECT conv_id, 0 AS place, max(n) AS n, 0 AS state, 0 AS cost, '' AS audit,
         CAST([] AS VARCHAR[]) AS lines FROM faults GROUP BY conv_id
  UNION ALL
  SELECT conv_id, place + 1, any_value(n), state, min(cost), arg_min(audit, (cost, audit)),
         arg_min(lines, (cost, audit)) FROM (
    WITH opened AS (
      SELECT conv_id, place, n, state, cost, audit, lines FROM walk
      UNION ALL
      SELECT conv_id, place, n, s.next, cost + 5, audit || 'I', list_append(lines, s.name || ':')
      FROM walk JOIN states s USING (state)),
    ready AS (SELECT o.*, f.role, f.t, f.initial, f.fault, s.next, s.wants, s.name,
                     CASE WHEN f.fault = 'truncated' THEN 5 ELSE 0 END AS cut
              FROM opened o JOIN states s USING (state)
              JOIN faults f ON f.conv_id IS NOT DISTINCT FROM o.conv_id AND f.place = o.place + 1)
    SELECT conv_id, place, n, state, cost + 2 AS cost, audit || 'D' AS audit, lines FROM ready
    UNION ALL
    SELECT conv_id, place, n, CASE WHEN initial = 's' THEN 1 ELSE next END, cost + cut,
           audit || 'K', list_append(lines, role || ':' || t) FROM ready
    WHERE fault NOT IN ('blank', 'duplicate')
      AND (initial = wants OR (initial = 's' AND state = 0))
    UNION ALL
    SELECT conv_id, place, n, next, cost + 1 + cut, audit || 'R',
           list_append(lines, name || ':' || t) FROM ready
    WHERE fault NOT IN ('blank', 'duplicate') AND initial <> wants) AS x
  GROUP BY conv_id, place, state),
ends AS (SELECT conv_id, cost, audit, lines FROM walk WHERE place = n AND state IN (0, 3)
         UNION ALL
         SELECT conv_id, cost + 5, audit || 'I', list_append(lines, 'assistant:')
         FROM walk WHERE place = n AND state = 2
         UNION ALL
         SELECT conv_id, cost + 10, audit || 'II', lines || ['user:', 'assistant:']
         FROM walk WHERE place = n AND state = 1),
best AS (SELECT conv_id, arg_min((cost, audit, lines), (cost, audit)) AS b FROM ends
         GROUP BY conv_id)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank,
       coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
       coalesce(c.illegal, 0) AS illegal, CAST(coalesce(b[1], 0) AS BIGINT) AS cost,
       coalesce(b[2], '') AS audit,
       sha256(coalesce(array_to_string(b[3], chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id"""
