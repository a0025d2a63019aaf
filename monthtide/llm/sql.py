"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from monthtide.llm import url_filter
from monthtide.llm.license_scan import RULES, SENTENCES
from monthtide.llm.spelling_variants import MIN_COUNT, MIN_LETTERS, RATIO, RUN, SLIP

WORD = r"[^\x20\x09-\x0D]+"

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP10 = f"""
WITH n AS (SELECT doc_id, {_LOWER} AS t FROM documents),
g AS (
  SELECT doc_id, t,
         max(doc_id) OVER (PARTITION BY t) AS keep_id,
         count(*) OVER (PARTITION BY t) AS group_size,
         row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) AS place
  FROM n
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM g
"""


_CONTROL = (
    "<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<bos>", "<eos>", "<pad>", "<unk>",
    "<start_of_turn>", "<end_of_turn>", "[INST]", "[/INST]",
)


def _escaped(column: str) -> str:
    """The length of an escaped text: a backslash more for each backslash and control string."""
    more = " + ".join(
        f"(length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}" for c in _CONTROL
    )
    return f"(length({column}) + (length({column}) - length(replace({column}, chr(92), ''))) + {more})"


OP9 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS nth,
         len(regexp_extract_all(text, '{WORD}')) + 4 AS tokens,
         {len("<|turn|><|text|><|end|>")} + {_escaped("role")} + {_escaped("text")} AS chars
  FROM t
),
h AS (SELECT *, nth = 1 AND role = 'system' AND tokens <= 256 AS head FROM n),
b AS (
  SELECT *, 384 - coalesce(max(CASE WHEN head THEN tokens END) OVER (PARTITION BY conv_id), 0) AS stride,
         sum(CASE WHEN head THEN 0 ELSE tokens END) OVER (PARTITION BY conv_id ORDER BY nth)
            - CASE WHEN head THEN 0 ELSE tokens END AS begins
  FROM h
),
w AS (SELECT *, begins // stride AS win, begins % stride >= stride - 128 AND NOT head AS late FROM b),
own AS (SELECT DISTINCT conv_id, win FROM w),
heads AS (
  SELECT w.conv_id, sum(w.chars) AS chars
  FROM w JOIN own ON w.head AND w.conv_id IS NOT DISTINCT FROM own.conv_id GROUP BY w.conv_id
),
late AS (
  SELECT w.conv_id, sum(w.chars) AS chars
  FROM w JOIN own ON w.late AND w.conv_id IS NOT DISTINCT FROM own.conv_id AND own.win = w.win + 1
  GROUP BY w.conv_id
),
c AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
         coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS loss_chars,
         sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256,
         coalesce(sum(chars) FILTER (NOT head), 0) AS chars
  FROM w GROUP BY conv_id
)
SELECT c.conv_id, n_turns, turns_sha256, CAST(loss_chars AS BIGINT) AS loss_chars, loss_sha256,
       CAST(c.chars + coalesce(heads.chars, 0) + coalesce(late.chars, 0) AS BIGINT) AS formatted_chars
FROM c LEFT JOIN heads ON c.conv_id IS NOT DISTINCT FROM heads.conv_id
LEFT JOIN late ON c.conv_id IS NOT DISTINCT FROM late.conv_id
"""


def _rewritten(sequence: str) -> str:
    for name, steps in RULES:
        sequence = f"replace({sequence}, '{''.join(f'<{i}>' for i in steps)}', '#{name};')"
    return sequence


_BLANK = r"[ \t\n\x0b\f\r]"
_LONGEST = max(map(len, SENTENCES.values()))

OP6 = rf"""
WITH RECURSIVE known(id, sentence) AS MATERIALIZED (
  VALUES {", ".join(f"('{i}', '{x}')" for i, x in SENTENCES.items())}
),
t AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, lower(coalesce(text, '')) AS low
  FROM documents
),
pieces AS (
  SELECT r, unnest(regexp_split_to_array(
    regexp_replace(text, '([.!?:;]){_BLANK}+', '\1' || chr(10), 'g'), '[\r\n]+')) AS piece FROM t
),
counted AS (
  SELECT r, count(*) FILTER (regexp_matches(piece, '[\p{{L}}\p{{N}}]')) AS n_sentences FROM pieces GROUP BY r
),
runs AS (
  SELECT r, regexp_extract_all(low, '[\p{{L}}\p{{N}}]+') AS words,
         regexp_extract_all(low, '[^\p{{L}}\p{{N}}]+') AS gaps,
         CAST(regexp_matches(low, '^[^\p{{L}}\p{{N}}]') AS INTEGER) AS shift
  FROM t
),
-- each word with the gap before it: a hard cut, a soft one, or none
cut_words AS (
  SELECT r, i, words[i] AS word,
         CASE WHEN i = 1 OR regexp_matches(gap, '^[^\r\n]*[.!?]{_BLANK}')
                OR regexp_matches(replace(gap, chr(13) || chr(10), chr(10)), '^[^\r\n]*[\r\n][^\r\n]*[\r\n]') THEN 2
              WHEN regexp_matches(gap, '[\r\n]|[:;]{_BLANK}') THEN 1 ELSE 0 END AS cut
  FROM (SELECT r, i, words, gaps[i - 1 + shift] AS gap FROM runs, unnest(range(1, len(words) + 1)) AS u(i))
),
numbered AS (
  SELECT r, i, word, cut, sum(CAST(cut > 0 AS INTEGER)) OVER (PARTITION BY r ORDER BY i) AS part
  FROM cut_words
),
parts AS MATERIALIZED (
  SELECT r, part, string_agg(word, ' ' ORDER BY i) AS words, max(cut) = 2 AS hard
  FROM numbered GROUP BY r, part
),
-- parts in a row, across soft cuts, as long as a known sentence begins with them
spans(r, first, last, words) AS (
  SELECT r, part, part, words FROM parts
  WHERE length(words) <= {_LONGEST} AND EXISTS (SELECT 1 FROM known WHERE starts_with(sentence, words))
  UNION ALL
  SELECT s.r, s.first, p.part, s.words || ' ' || p.words
  FROM spans s JOIN parts p ON p.r = s.r AND p.part = s.last + 1 AND NOT p.hard
  WHERE length(s.words) + length(p.words) < {_LONGEST}
    AND EXISTS (SELECT 1 FROM known WHERE starts_with(sentence, s.words || ' ' || p.words))
),
longest AS MATERIALIZED (
  SELECT r, first, max(last) AS last, max_by(id, last) AS id
  FROM spans JOIN known ON words = sentence GROUP BY r, first
),
-- from the left, each taking its parts
taken(r, nth, last, id) AS (
  SELECT r, 1, min_by(last, first), min_by(id, first) FROM longest GROUP BY r
  UNION ALL
  SELECT x.r, any_value(x.nth) + 1, min_by(l.last, l.first), min_by(l.id, l.first)
  FROM taken x JOIN longest l ON l.r = x.r AND l.first > x.last GROUP BY x.r
),
g AS (
  SELECT r, string_agg('<' || id || '>', '' ORDER BY nth) AS recognised FROM taken GROUP BY r
),
f AS (
  SELECT r, doc_id, n_sentences, coalesce(recognised, '') AS recognised,
         regexp_extract_all({_rewritten("coalesce(recognised, '')")}, '#([^;]+);', 1) AS found
  FROM t JOIN counted USING (r) LEFT JOIN g USING (r)
),
e AS (SELECT r, unnest(found) AS name, generate_subscripts(found, 1) AS nth FROM f),
d AS (SELECT r, name, min(nth) AS nth FROM e GROUP BY r, name),
l AS (SELECT r, string_agg(name, ',' ORDER BY nth) AS licenses FROM d GROUP BY r)
SELECT doc_id, n_sentences, recognised, coalesce(licenses, '') AS licenses,
       CAST(len(found) AS BIGINT) AS matches
FROM f LEFT JOIN l USING (r)
"""


def _op3() -> str:
    rules = sorted(
        enumerate(url_filter.RULES), key=lambda x: (-len(x[1].text), x[0])
    )
    fits = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
        f"THEN {i}"
        for i, r in rules
    )
    texts = ", ".join(f"({i}, '{r.text}', '{r.verdict}')" for i, r in rules)
    link = url_filter.LINK.replace("'", "''").replace('\\"', '"')
    rest, damping = 1 - url_filter.DAMPING, url_filter.DAMPING
    rounds = "".join(
        f"""
r{k + 1} AS MATERIALIZED (
  SELECT s.host, seed_trust + {damping} * coalesce(t, 0) AS trust,
         seed_distrust + {damping} * coalesce(d, 0) AS distrust
  FROM seeds s
  LEFT JOIN (SELECT e.target AS host, sum(trust * onward) AS t
             FROM edges e JOIN r{k} r ON e.source = r.host GROUP BY 1) a ON s.host = a.host
  LEFT JOIN (SELECT e.source AS host, sum(distrust * back) AS d
             FROM edges e JOIN r{k} r ON e.target = r.host GROUP BY 1) b ON s.host = b.host
),"""
        for k in range(url_filter.ROUNDS)
    )
    return rf"""
WITH u AS (
  SELECT page_id, html,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
),
rules(place, rule, ruled) AS (VALUES {texts}),
p AS (SELECT *, CASE {fits} END AS place FROM u),
j AS (SELECT page_id, html, host, path, rule, ruled FROM p LEFT JOIN rules USING (place)),
l AS (
  SELECT host AS source,
         translate(unnest(regexp_extract_all(html, '{link}', 1)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS target
  FROM j WHERE host <> ''
),
links AS (SELECT source, target, count(*) AS n FROM l WHERE source <> target GROUP BY ALL),
edges AS MATERIALIZED (
  SELECT source, target, n / sum(n) OVER (PARTITION BY source) AS onward,
         n / sum(n) OVER (PARTITION BY target) AS back
  FROM links
),
h AS (
  SELECT host, avg(CASE WHEN ruled = 'allow' THEN 1.0::DOUBLE ELSE 0 END) AS trusted,
         avg(CASE WHEN ruled = 'block' THEN 1.0::DOUBLE ELSE 0 END) AS blocked
  FROM j WHERE host <> '' GROUP BY host
  UNION ALL
  SELECT DISTINCT target, 0, 0 FROM links WHERE target NOT IN (SELECT host FROM j)
),
seeds AS MATERIALIZED (
  SELECT host, CAST({rest} AS DOUBLE) * trusted AS seed_trust,
         CAST({rest} AS DOUBLE) * blocked AS seed_distrust FROM h
),
r0 AS (SELECT host, seed_trust AS trust, seed_distrust AS distrust FROM seeds),{rounds}
last AS (SELECT * FROM r{url_filter.ROUNDS})
SELECT page_id, j.host, path, rule,
       coalesce(ruled, CASE WHEN distrust >= {url_filter.THRESHOLD} AND distrust > trust
                            THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN last ON j.host = last.host
"""


OP3 = _op3()


OP11 = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{WORD}') AS w FROM documents
),
s AS (
  SELECT r, doc_id,
         CASE WHEN len(w) < 2 THEN w
              ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
         END AS shingles
  FROM d
),
e AS MATERIALIZED (SELECT r, doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s WHERE doc_id IS NOT NULL),
links AS MATERIALIZED (
  SELECT DISTINCT least(a.doc_id, b.doc_id) AS x, greatest(a.doc_id, b.doc_id) AS y
  FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.r, b.r, a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
two_way AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT x, y FROM two_way UNION SELECT reach.x, two_way.y FROM reach JOIN two_way ON reach.y = two_way.x),
c AS (SELECT x, min(y) AS least FROM reach GROUP BY x)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles,
       CASE WHEN doc_id IS NOT NULL THEN least(doc_id, coalesce(least, doc_id)) END AS component_id,
       coalesce(doc_id = least(doc_id, coalesce(least, doc_id)), true) AS kept
FROM s LEFT JOIN c ON s.doc_id = c.x
"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8, half a byte at a time."""
    steps = []
    for c in range(16):
        for _ in range(4):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        steps.append(c)
    digits = f"hex(encode({text}))"
    halves = (
        f"list_transform(range(0, length({digits})), lambda i: CAST(instr('0123456789ABCDEF', "
        f"substr({digits}, i + 2 - 2 * (i % 2), 1)) - 1 AS BIGINT))"
    )
    return (
        f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {halves}), "
        f"lambda c, h: xor((c >> 4), CAST(({steps})[(xor(c, h) & 15) + 1] AS BIGINT))), 4294967295)"
    )


def _framed(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_framed, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _risen(name: str, bottom: str) -> str:
    """All nodes of the trees over ``bottom`` (grp, idx, width, digest)."""
    return f"""
{name}(grp, lvl, idx, width, digest) AS (
  SELECT grp, 0, idx, width, digest FROM {bottom}
  UNION ALL
  SELECT grp, lvl + 1, idx // 3, any_value((width + 2) // 3), sha256(string_agg(digest, '' ORDER BY idx))
  FROM {name} WHERE width > 1 GROUP BY grp, lvl, idx // 3
),
{name}_siblings AS (
  SELECT n.grp, n.lvl, n.idx,
         coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx < n.idx), '') AS before,
         coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx > n.idx), '') AS after
  FROM {name} n JOIN {name} s ON n.grp = s.grp AND n.lvl = s.lvl AND n.idx // 3 = s.idx // 3
  WHERE n.width > 1 GROUP BY ALL
)"""


def _walked(name: str, start: str, tree: str) -> str:
    """Each row of ``start`` (r, grp, idx, proof, folded) led up its tree."""
    return f"""
{name}(r, grp, lvl, idx, proof, folded) AS (
  SELECT r, grp, 0, idx, proof, folded FROM {start}
  UNION ALL
  SELECT r, grp, lvl + 1, idx // 3, proof || before || after, sha256(before || folded || after)
  FROM {name} JOIN {tree}_siblings USING (grp, lvl, idx)
),
{name}_end AS (SELECT r, max_by(proof, lvl) AS proof, max_by(folded, lvl) AS folded FROM {name} GROUP BY r)"""


OP12 = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS grp, {_leaf("text")} AS leaf,
         CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 2 = 0
              THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS claimed
  FROM documents
),
leaves AS MATERIALIZED (
  SELECT *, leaf AS digest, count(*) OVER (PARTITION BY grp) AS width,
         row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS idx
  FROM d
),{_risen("lower_tree", "leaves")},
tops AS MATERIALIZED (
  SELECT '' AS grp, grp AS own, digest, count(*) OVER () AS width,
         row_number() OVER (ORDER BY encode(grp)) - 1 AS idx
  FROM lower_tree WHERE width = 1
),{_risen("upper_tree", "tops")},
inner_start AS (SELECT r, grp, idx, '' AS proof, claimed AS folded FROM leaves),{_walked("inner_walk", "inner_start", "lower_tree")},
outer_start AS (
  SELECT r, tops.grp, tops.idx, proof, folded
  FROM inner_walk_end JOIN leaves USING (r) JOIN tops ON leaves.grp = tops.own
),{_walked("outer_walk", "outer_start", "upper_tree")},
top AS (SELECT digest AS root FROM upper_tree WHERE width = 1)
SELECT doc_id, leaf, tops.digest AS subroot, root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = root AS verified
FROM leaves JOIN tops ON leaves.grp = tops.own JOIN outer_walk_end USING (r) CROSS JOIN top
"""


OP13 = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc,
         unnest(regexp_extract_all({_LOWER}, '{RUN}')) AS run
  FROM documents
),
kinds AS MATERIALIZED (SELECT doc, run, count(*) AS times FROM runs GROUP BY doc, run),
h AS (SELECT *, {_crc32("doc || ':' || run")} AS h FROM kinds),
words AS MATERIALIZED (
  SELECT word, CAST(sum(times) AS BIGINT) AS n
  FROM (
    SELECT times, CASE WHEN h % {SLIP} = 0
                       THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                       ELSE run END AS word
    FROM h
  )
  WHERE length(word) >= {MIN_LETTERS} GROUP BY word HAVING sum(times) >= {MIN_COUNT}
),
rests AS MATERIALIZED (
  SELECT word, n, 0 AS place, word AS rest FROM words
  UNION ALL
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1)
  FROM words, unnest(range(1, length(word) + 1)) AS u(i)
),
near AS MATERIALIZED (
  SELECT DISTINCT a.word, b.word AS other, b.n
  FROM rests a JOIN rests b ON a.rest = b.rest AND a.word <> b.word
  WHERE a.place = b.place OR a.place = 0 OR b.place = 0
),
formed AS MATERIALIZED (
  SELECT words.word, words.n, CAST(count(other) AS BIGINT) AS n_near,
         min_by(other, (-near.n, encode(other))) AS best, max(near.n) AS best_n
  FROM words LEFT JOIN near USING (word) GROUP BY words.word, words.n
),
f AS MATERIALIZED (
  SELECT word, n, n_near, CASE WHEN best_n >= {RATIO} * n THEN best END AS form,
         CASE WHEN best_n >= {RATIO} * n THEN best_n END AS form_n
  FROM formed
),
ways(word, place, hops) AS (
  SELECT word, word, 0 FROM f
  UNION ALL
  SELECT ways.word, f.form, hops + 1 FROM ways JOIN f ON ways.place = f.word WHERE f.form IS NOT NULL
),
roots AS (SELECT word, max_by(place, hops) AS root FROM ways GROUP BY word)
SELECT word, n, n_near, form, form_n, root FROM f JOIN roots USING (word)
"""


def sql() -> dict[str, str]:
    return {
        "op3_url_filter": OP3,
        "op6_license_scan": OP6,
        "op9_chat_format": OP9,
        "op10_exact_dedup": OP10,
        "op11_fast_sketch": OP11,
        "op12_merkle_manifest": OP12,
        "op13_spelling_variants": OP13,
    }
