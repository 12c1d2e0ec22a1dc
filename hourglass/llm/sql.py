"""DuckDB SQL of the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from hourglass.llm.line_rules import MAX_DOCUMENTS, MAX_REMOVED
from hourglass.llm.url_rules import PATTERNS

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
#: Lower-cases A-Z only.
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TEXT = "coalesce(text, '')"


def near_duplicates() -> str:
    words = WORDS.format(LOWER.format(_TEXT))
    return f"""WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, {words} AS ws FROM documents),
    sh AS MATERIALIZED (SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ')
            ELSE ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] END AS s
        FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0))),
    n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
    both_ways AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id
                  GROUP BY 1, 2),
    pair AS MATERIALIZED (SELECT x, y FROM both_ways JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
             WHERE 100 * shared >= 85 * (nx.n + ny.n - shared)),
    edge AS MATERIALIZED (SELECT x, y FROM pair UNION SELECT y, x FROM pair),
    reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents
        UNION SELECT r.doc_id, e.y FROM reach r JOIN edge e ON e.x = r.other),
    c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
    FROM documents d JOIN c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""


def decontamination() -> str:
    words = r"regexp_extract_all({}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')".format(LOWER.format(_TEXT))
    return f"""WITH w AS MATERIALIZED (SELECT doc_id, {words} AS ws FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS ws FROM benchmark),
    win AS MATERIALIZED (SELECT DISTINCT item, size, array_to_string(ws[i:i + size - 1], ' ') AS win FROM (
        SELECT item, ws, least(10, len(ws)) AS size, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
    sizes AS (SELECT DISTINCT size FROM win),
    places AS (SELECT doc_id, size, ws, unnest(range(1, greatest(len(ws) - size + 2, 1))) AS i FROM w, sizes),
    found AS MATERIALIZED (SELECT p.doc_id, p.i, p.size, win.item FROM places p
        JOIN win ON win.size = p.size AND win.win = array_to_string(p.ws[p.i:p.i + p.size - 1], ' ')),
    hit AS (SELECT doc_id, count(DISTINCT at_word) AS n FROM (
        SELECT doc_id, unnest(range(i, i + size)) AS at_word FROM found) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
              FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
    SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
        CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.names, '')) AS items_sha256,
        coalesce(hit.n, 0) > 0 AS contaminated
    FROM w LEFT JOIN hit ON hit.doc_id = w.doc_id LEFT JOIN items ON items.doc_id = w.doc_id"""


def substring_dedup() -> str:
    return f"""WITH w AS MATERIALIZED (SELECT doc_id, {WORDS.format(_TEXT)} AS ws FROM documents),
    win AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS win FROM (
        SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 33, 1))) AS i FROM w)),
    again AS (SELECT win FROM win GROUP BY win HAVING count(*) > 1),
    gone AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM win WHERE win IN (SELECT win FROM again)),
    kept AS (SELECT p.doc_id, count(*) AS n, string_agg(p.word, ' ' ORDER BY p.i) AS kept FROM (
        SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w) p
        WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = p.doc_id AND g.i = p.i) GROUP BY p.doc_id)
    SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
        sha256(coalesce(k.kept, '')) AS kept_sha256
    FROM w LEFT JOIN kept k ON k.doc_id = w.doc_id"""


def quality_rules() -> str:
    return f"""WITH w AS MATERIALIZED (SELECT doc_id, source, text, {_TEXT} AS t, {WORDS.format(_TEXT)} AS ws FROM documents),
    g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (
        SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM w)),
    r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
    rw AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY doc_id),
    ln AS MATERIALIZED (SELECT doc_id, source, text, line, {WORDS.format('line')} AS lw FROM (
        SELECT doc_id, source, text, unnest(string_split(t, chr(10))) AS line FROM w) WHERE len({WORDS.format('line')}) > 0),
    dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM ln GROUP BY doc_id),
    nl AS MATERIALIZED (SELECT doc_id, source, text, {LOWER.format("array_to_string(lw, ' ')")} AS norm, len(lw) AS n FROM ln),
    hot AS (SELECT source, norm FROM nl GROUP BY source, norm HAVING count(DISTINCT text) > {MAX_DOCUMENTS}),
    lost AS (SELECT doc_id, sum(n) AS n FROM nl JOIN hot ON hot.norm = nl.norm AND hot.source IS NOT DISTINCT FROM nl.source GROUP BY doc_id),
    b AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rw.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed_words
        FROM w LEFT JOIN rw ON rw.doc_id = w.doc_id LEFT JOIN dup ON dup.doc_id = w.doc_id LEFT JOIN lost ON lost.doc_id = w.doc_id)
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (100 * n_removed_words > {MAX_REMOVED} * n_words) AS kept
    FROM b"""


def warc() -> str:
    return """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
    f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
    SELECT d.page_id, d.payload_bytes, d.payload_digest,
        CASE WHEN f.first_id IS DISTINCT FROM d.page_id AND f.first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN f.first_id IS DISTINCT FROM d.page_id THEN f.first_id END AS refers_to
    FROM d LEFT JOIN f ON f.payload_digest = d.payload_digest"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def url_filter(hosts: tuple[tuple[str, str, str], ...]) -> str:
    """``hosts``: (verdict, host, path)."""
    rules = ", ".join(f"({_quoted(v)}, {_quoted(h)}, {_quoted(p)})" for v, h, p in hosts)
    spec = [("allow" if p.startswith("@@") else "block", p.removeprefix("@@")) for p in PATTERNS]
    pats = ", ".join(f"({_quoted(v)}, {_quoted(p)}, {_quoted('(?s)' + p.replace('^', '([^a-z0-9]|^|$)').replace('*', '.*'))})"
                     for v, p in spec)
    return f"""WITH u AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS after FROM pages),
    s AS (SELECT page_id, {LOWER.format("regexp_extract(after, '^[^/?#]*')")} AS host,
        regexp_extract(after, '^[^/?#]*([^?#]*)', 1) AS path,
        {LOWER.format("after")} AS address FROM u),
    k AS (SELECT row_number() OVER () AS i, * FROM s),
    rules(verdict, rh, rp) AS (VALUES {rules}),
    pats(verdict, pattern, regex) AS (VALUES {pats}),
    h AS (SELECT i, first(rh || rp ORDER BY length(rh || rp) DESC, length(rh) DESC) AS rule,
            first(verdict ORDER BY length(rh || rp) DESC, length(rh) DESC) AS verdict
        FROM k JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY i),
    p AS (SELECT i, first(pattern ORDER BY pats.verdict, pattern) AS pattern, min(pats.verdict) AS verdict
        FROM k JOIN pats ON regexp_matches(address, regex) GROUP BY i)
    SELECT page_id, host, path, h.rule, CASE WHEN h.rule IS NULL THEN p.pattern END AS pattern,
        coalesce(h.verdict, p.verdict, 'allow') AS verdict
    FROM k LEFT JOIN h ON h.i = k.i LEFT JOIN p ON p.i = k.i"""


#: One row: the table of CRC-32 (reflected polynomial EDB88320).
_CRC_TABLE = """crc_table AS MATERIALIZED (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t)"""


def _crc32(text: str) -> str:
    """Of a text column, next to ``crc_table``."""
    of_bytes = f"list_transform(range(strlen({text})), lambda i: CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {of_bytes}), lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])))"


def spelling_variants() -> str:
    word = LOWER.format("unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+'))")
    return f"""WITH RECURSIVE {_CRC_TABLE},
    r AS (SELECT doc_id, {word} AS run FROM documents),
    d AS (SELECT doc_id, run, count(*) AS n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS k FROM r GROUP BY ALL),
    c AS (SELECT run, n, doc_id, {_crc32("k")} AS h FROM d, crc_table),
    t AS (SELECT CASE WHEN doc_id IS NOT NULL AND h % 97 = 0
        THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM c),
    w AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM t WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    less AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (
        SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
    half AS (SELECT a.word AS x, b.word AS y FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
        UNION SELECT w.word, less.word FROM less JOIN w ON w.word = less.rest),
    near AS MATERIALIZED (SELECT x, y FROM half UNION SELECT y, x FROM half),
    best AS (SELECT x, count(*) AS n_near, arg_min(y, (-b.n, y)) AS y, max(b.n) AS y_n FROM near JOIN w b ON b.word = y GROUP BY x),
    f AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN y_n >= 2 * w.n THEN y END AS form,
        CASE WHEN y_n >= 2 * w.n THEN y_n END AS form_n FROM w LEFT JOIN best ON best.x = w.word),
    up(word, root, form) AS (SELECT word, word, form FROM f
        UNION ALL SELECT up.word, f.word, f.form FROM up JOIN f ON f.word = up.form)
    SELECT f.word, f.form, up.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
    FROM f JOIN up ON up.word = f.word AND up.form IS NULL"""


def _levels(name: str, depth: int) -> tuple[str, str]:
    """CTEs of a forest over ``name``0 (tree, i, h): the runs of every level; and the joins of a leaf ``p`` with them."""
    ctes, joins = "", ""
    for k in range(depth):
        ctes += f""", {name}r{k} AS MATERIALIZED (SELECT tree, i // 8 AS run, list(h ORDER BY i) AS hs, any_value(n) AS n FROM (
            SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}{k}) WHERE n > 1 GROUP BY tree, i // 8),
        {name}{k + 1} AS MATERIALIZED (SELECT tree, run AS i, sha256(array_to_string(hs, '')) AS h FROM {name}r{k})"""
        joins += f""" LEFT JOIN {name}r{k} ON {name}r{k}.tree IS NOT DISTINCT FROM p.tree AND {name}r{k}.run = p.i // {8 ** (k + 1)}"""
    return ctes, joins


def _left(name: str, k: int, i: str) -> str:
    return f"array_to_string({name}r{k}.hs[1:{i} // {8 ** k} % 8], '')"


def _right(name: str, k: int, i: str) -> str:
    return f"array_to_string({name}r{k}.hs[{i} // {8 ** k} % 8 + 2:], '')"


def merkle_manifest(depth: int = 8, top: int = 3) -> str:
    """Trees of up to 8^``depth`` rows and 8^``top`` groups."""
    text = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"

    def leaf(body: str) -> str:
        return "sha256(" + " || ".join(text.format(c) for c in ("doc_id", "source", "lang", "n_chars", body)) + ")"

    lower, upper = _levels("a", depth)
    tops, over = _levels("b", top)
    steps, proof, at = "", [], "f0"
    for name, i, n in (("a", "p.i", depth), ("b", "g.i", top)):
        for k in range(n):
            proof.append(f"coalesce({_left(name, k, i)} || {_right(name, k, i)}, '')")
            after = f"f{len(proof)}"
            steps += (f", CASE WHEN {name}r{k}.hs IS NULL THEN {at} ELSE sha256({_left(name, k, i)} || {at} || {_right(name, k, i)}) END AS {after}")
            at = after
    a_roots = " UNION ALL ".join(f"SELECT tree, any_value(h) AS h, {k} AS k FROM a{k} GROUP BY tree HAVING count(*) = 1" for k in range(depth + 1))
    b_roots = " UNION ALL ".join(f"SELECT any_value(h) AS h, {k} AS k FROM b{k} GROUP BY tree HAVING count(*) = 1" for k in range(top + 1))
    return f"""WITH {_CRC_TABLE},
    d AS MATERIALIZED (SELECT doc_id, lang AS tree, {leaf("text")} AS h, {leaf(LOWER.format("text"))} AS low,
        coalesce({_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0, false) AS touched FROM documents, crc_table),
    p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM d),
    a0 AS MATERIALIZED (SELECT tree, i, h FROM p){lower},
    sub AS MATERIALIZED (SELECT tree, min_by(h, k) AS h FROM ({a_roots}) GROUP BY tree),
    g AS MATERIALIZED (SELECT tree, h, row_number() OVER (ORDER BY encode(tree) NULLS FIRST) - 1 AS i FROM sub),
    b0 AS MATERIALIZED (SELECT 0 AS tree, i, h FROM g){tops},
    root AS (SELECT min_by(h, k) AS h FROM ({b_roots})),
    x AS (SELECT p.doc_id, p.h AS leaf, g.h AS subroot, root.h AS root, {" || ".join(proof)} AS proof,
        CASE WHEN touched THEN low ELSE p.h END AS f0{steps}
        FROM p JOIN g ON g.tree IS NOT DISTINCT FROM p.tree CROSS JOIN root{upper}{over.replace("p.tree", "0").replace("p.i", "g.i")})
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, {at} AS folded_root, {at} = root AS verified FROM x"""
