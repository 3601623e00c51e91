"""DuckDB SQL of the operators that SQL can express."""

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
OP7 = rf"""WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
it AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(text, {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
starts AS (SELECT item_id, ws, least(10, len(ws)) AS k, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS s FROM it WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(ws, s, s + k - 1), ' ') AS gram FROM starts),
spots AS (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS s FROM w, (SELECT DISTINCT k FROM win) WHERE len(ws) >= k),
hits AS (SELECT a.doc_id, a.s, a.k, win.item_id
         FROM (SELECT doc_id, s, k, array_to_string(list_slice(ws, s, s + k - 1), ' ') AS gram FROM spots) a JOIN win ON a.k = win.k AND a.gram = win.gram),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN items USING (doc_id)"""
OP6 = rf"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS g FROM w),
sized AS (SELECT doc_id, len(g) AS n, md5(array_to_string(list_sort(g), chr(10))) AS content, g FROM sets),
classes AS (SELECT min(doc_id) AS rep, content, any_value(n) AS n, any_value(g) AS g FROM sized WHERE n > 0 GROUP BY content),
grams AS (SELECT rep, n, unnest(g) AS gram FROM classes),
links AS (
  SELECT a.rep AS x, b.rep AS y FROM grams a JOIN grams b ON a.gram = b.gram AND a.rep <> b.rep AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (SELECT rep AS x, rep AS y FROM classes UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
comp AS (SELECT x AS rep, min(y) AS component_id FROM reach GROUP BY x)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, coalesce(comp.component_id, s.doc_id) AS component_id
FROM sized s LEFT JOIN classes c ON s.n > 0 AND s.content = c.content LEFT JOIN comp ON comp.rep = c.rep"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    fold = "list_reduce(list_concat([xor(a, b)], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)"
    chars = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS UBIGINT))"
    return f"xor(list_reduce(list_concat([4294967295::UBIGINT], {chars}), lambda a, b: {fold}), 4294967295::UBIGINT)"


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR) END"


def _tree_levels(name: str, leaves: str, levels: int) -> str:
    """CTEs {name}0 .. of (t, i, h, n, l, r): node i of tree t with its level's node count and its siblings left and right."""
    out = []
    for k in range(levels + 1):
        rows = leaves if k == 0 else (
            f"SELECT t, i // 8 AS i, CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h FROM {name}{k - 1} GROUP BY t, i // 8")
        run = "PARTITION BY t, i // 8 ORDER BY i ROWS BETWEEN"
        out.append(f"{name}{k} AS (SELECT t, i, h, count(*) OVER (PARTITION BY t) AS n, "
                   f"coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                   f"coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM ({rows}))")
    return ",\n".join(out)


def merkle_sql(levels: int = 9) -> str:
    """Every row's leaf, path and folded root; enough for 8**levels rows of a language."""
    leaf = "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {text})"
    changed = leaf.format(text=_field(f"translate(text, {_LOWER})"))
    rows = ("SELECT *, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS t, "
            f"{leaf.format(text=_field('text'))} AS leaf, "
            f"CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {changed} END AS changed FROM documents")
    ranked = "SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM ({})".format(rows)
    steps = ["p0 AS (SELECT *, coalesce(changed, leaf) AS folded, '' AS proof FROM d)"]
    for k in range(levels + 1):
        steps.append(f"p{k + 1} AS (SELECT p.* REPLACE (CASE WHEN n > 1 THEN sha256(l || folded || r) ELSE folded END AS folded, "
                     f"proof || CASE WHEN n > 1 THEN l || r ELSE '' END AS proof) FROM p{k} p JOIN a{k} x ON x.t = p.t AND x.i = p.pos // {8 ** k})")
    last = f"p{levels + 1}"
    tops = [f"s AS (SELECT t AS lang, h AS subroot, row_number() OVER (ORDER BY t) - 1 AS rank FROM a{levels})",
            _tree_levels("b", "SELECT '' AS t, rank AS i, subroot AS h FROM s", levels)]
    q = [f"q0 AS (SELECT p.*, s.subroot, s.rank FROM {last} p JOIN s ON s.lang = p.t)"]
    for k in range(levels + 1):
        q.append(f"q{k + 1} AS (SELECT q.* REPLACE (CASE WHEN n > 1 THEN sha256(l || folded || r) ELSE folded END AS folded, "
                 f"proof || CASE WHEN n > 1 THEN l || r ELSE '' END AS proof) FROM q{k} q JOIN b{k} x ON x.i = q.rank // {8 ** k})")
    return (f"WITH d AS ({ranked}),\n" + _tree_levels("a", "SELECT t, pos AS i, leaf AS h FROM d", levels) + ",\n"
            + ",\n".join(steps + tops + q)
            + f"\nSELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified "
            f"FROM q{levels + 1}, (SELECT h AS root FROM b{levels})")


OP11 = merkle_sql()
OP13 = f"""WITH t AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, substr(sha256(strlen(role) || ':' || role || text), 1, 32) AS id, length(text) AS chars, turn FROM t),
own AS (SELECT c, list({{'id': id, 'chars': chars}} ORDER BY turn NULLS FIRST, id) AS turns FROM o GROUP BY c),
seq AS (
  SELECT own.c, list_concat(coalesce(b.turns, [])[1:h], own.turns[h + 1:]) AS turns
  FROM (SELECT *, CAST({crc32_sql('CAST(c AS VARCHAR)')} % 6 AS BIGINT) AS h FROM own) own LEFT JOIN own b ON b.c = own.c - own.c % 100),
hashed AS (SELECT c, len(turns) AS n, list_transform(turns, lambda x: x.id) AS ids, list_transform(turns, lambda x: x.chars) AS chars FROM seq),
steps AS (SELECT c, n, ids, chars, unnest(range(0, n + 1)) AS d FROM hashed),
paths AS (SELECT c, d, n, chars[d] AS chars, sha256(array_to_string(ids[1:d], '')) AS node,
                 CASE WHEN d > 0 THEN sha256(array_to_string(ids[1:d - 1], '')) END AS up FROM steps),
nodes AS (SELECT node, any_value(up) AS up, any_value(d) AS depth, coalesce(any_value(chars), 0) AS chars, min(c) AS conv_id, count(*) AS n_convs,
                 sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = n), '')) AS ends_sha256 FROM paths GROUP BY node),
kids AS (SELECT up AS node, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up),
under AS (
  SELECT p.node, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves, sum((m.n_convs - 1) * m.chars) AS saved_tokens
  FROM nodes m LEFT JOIN kids k ON k.node = m.node JOIN paths q ON q.node = m.node AND q.c = m.conv_id JOIN paths p ON p.c = q.c AND p.d <= q.d GROUP BY p.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes u ON u.node = n.up LEFT JOIN kids k ON k.node = n.node JOIN under s ON s.node = n.node"""
