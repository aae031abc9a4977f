"""The registered queries in DuckDB's SQL, where SQL can express them."""

from __future__ import annotations

from tillstream.llm import mixing

_LANES = ", ".join(
    f"('0x' || substr(h{seed}, {8 * k + 1}, 8))::BIGINT / 4294967296.0"
    for seed in range(4)
    for k in range(8)
)
_HASHES = ", ".join(f"sha256('{seed}:' || name) AS h{seed}" for seed in range(4))

_MIX = f"""
WITH sizes AS (
  SELECT *, {_HASHES} FROM (
    SELECT doc_id, coalesce('0' || source, '1') AS key,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
           coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) || ':'
             || (row_number() OVER (PARTITION BY doc_id, source, md5(coalesce(text, ''))) - 1) AS name
    FROM documents)
), totals AS (
  SELECT key, sum(size)::BIGINT AS source_size FROM sizes GROUP BY key
), weighed AS (
  SELECT *, (row_number() OVER (ORDER BY key) - 1) % 3 + 1 AS weight, 3 * source_size AS lim
  FROM totals
), ranked AS (
  SELECT *, sum(source_size) OVER ()
              - coalesce(sum(lim) OVER (ORDER BY lim * (6 // weight), key
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
            sum(weight) OVER ()
              - coalesce(sum(weight) OVER (ORDER BY lim * (6 // weight), key
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open
  FROM weighed
), targets AS (
  SELECT key, source_size,
         CASE WHEN rest * weight < lim * open
              THEN (max(CASE WHEN rest * weight < lim * open THEN rest END) OVER () * weight)::DOUBLE
                   / (max(CASE WHEN rest * weight < lim * open THEN open END) OVER ())::DOUBLE
              ELSE lim::DOUBLE END AS target
  FROM ranked
), drawn AS (
  SELECT *, target / nullif(source_size, 0) AS rate, [{_LANES}] AS u
  FROM sizes JOIN targets USING (key)
), lanes AS (
  SELECT key, lane, abs(sum(size * (floor(rate) + (u[lane] < rate - floor(rate))::INT)) - target) AS miss
  FROM drawn, range(1, {mixing._LANES + 1}) AS r(lane) WHERE rate IS NOT NULL
  GROUP BY key, lane, target
), chosen AS (
  SELECT key, arg_min(lane, miss * 64 + lane / 64.0) AS lane FROM
    (SELECT key, lane, rank() OVER (PARTITION BY key ORDER BY miss) AS miss FROM lanes) GROUP BY key
)
SELECT doc_id, size, source_size, target,
       (size * coalesce(floor(rate) + (u[lane] < rate - floor(rate))::INT, 1))::BIGINT AS taken
FROM drawn LEFT JOIN chosen USING (key)
"""

_LINES = r"""
WITH lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), E'\n') AS l FROM documents))
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT l.*, coalesce(doc_id < keeper, false) AS dropped FROM lines l LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, E'\n' ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_SETS = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
           ELSE list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2]) END)) AS s
  FROM words
), nodes AS (
  SELECT s, min(doc_id) AS node, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s
), grams AS (
  SELECT node, n, unnest(s) AS g FROM nodes
), links AS (
  SELECT x.node AS a, y.node AS b
  FROM grams x JOIN grams y ON x.g = y.g AND x.node < y.node
  GROUP BY x.node, y.node, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
), around AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT a AS node, a AS other FROM around
  UNION SELECT r.node, b.b FROM reach r JOIN around b ON r.other = b.a
), found AS (
  SELECT node, min(other) AS component FROM reach GROUP BY node
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(component, node, doc_id) AS component_id
FROM sets LEFT JOIN nodes USING (s) LEFT JOIN found USING (node)
"""

_VALID = """valid AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
)"""

_COSINES = f"""
WITH RECURSIVE {_VALID}, links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM valid x JOIN valid y ON x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.v, y.v) >= 0.9
), counts AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
), reach AS (
  SELECT a AS vec_id, a AS other FROM links
  UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
), found AS (
  SELECT vec_id, min(other) AS component FROM reach GROUP BY vec_id
)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id,
       vec_id = coalesce(component, vec_id) AS kept
FROM embeddings LEFT JOIN counts USING (vec_id) LEFT JOIN found USING (vec_id)
"""

_NEAREST = f"""
WITH {_VALID}, scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM valid q JOIN valid c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT query_id, vec_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

# Four bits of a CRC-32 at a time, by the rule of its reflected polynomial.
def _nibble(value: int) -> int:
    for _ in range(4):
        value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
    return value


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes, the low half of each byte first."""
    steps = ", ".join(str(_nibble(k)) for k in range(16))
    halves = (
        f"list_transform(range(2 * strlen({text})), lambda i: "
        f"(strpos('0123456789ABCDEF', substr(hex({text}), xor(i, 1) + 1, 1)) - 1)::BIGINT)"
    )
    return (
        f"xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, {halves}), "
        f"lambda c, b: xor(c >> 4, ([{steps}]::BIGINT[])[((xor(c, b) & 15) + 1)::INT])))"
    )


# Levels of a Merkle tree that the SQL goes up; more than tables of this size need.
_LEVELS = range(8)


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"


def _leaf(text: str) -> str:
    fields = " || ".join(_field(value) for value in ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({fields})"


def _tree(name: str, leaves: str, by: str) -> str:
    """Levels of trees, ``(tree, pos, digest)`` and the runs they are cut into; lone nodes move up."""
    levels = [f"{name}0 AS (SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY {by}) - 1 AS pos, "
              f"digest, count(*) OVER (PARTITION BY tree) AS n FROM {leaves})"]
    for k in _LEVELS:
        levels += [
            f"{name}_run{k} AS (SELECT tree, pos // 16 AS run, n, list(digest ORDER BY pos) AS l "
            f"FROM {name}{k} GROUP BY tree, pos // 16, n)",
            f"{name}{k + 1} AS (SELECT tree, run AS pos, (n + 15) // 16 AS n, "
            f"CASE WHEN n > 1 THEN sha256(array_to_string(l, '')) ELSE l[1] END AS digest FROM {name}_run{k})",
        ]
    return ",\n".join(levels)


def _up(name: str, start: str, tree: str, rank: str, k: int) -> str:
    """One level up: the siblings so far and the folded digest of every row of ``start``."""
    place = f"(s.{rank} // {16**k}) % 16"
    before, after = f"array_to_string(r.l[1:{place}], '')", f"array_to_string(r.l[{place} + 2:], '')"
    return f"""SELECT s.* EXCLUDE (siblings, folded), s.siblings || {before} || {after} AS siblings,
    CASE WHEN r.n > 1 THEN sha256({before} || s.folded || {after}) ELSE s.folded END AS folded
  FROM {start} s JOIN {name}_run{k} r ON r.tree = s.{tree} AND r.run = s.{rank} // {16 ** (k + 1)}"""


def _merkle() -> str:
    steps, last = [], "asked"
    for name, tree, rank in (("src", "tree", "pos"), ("top", "one", "place")):
        if name == "top":
            steps.append(f"placed AS (SELECT s.*, t.pos AS place, t.digest AS subroot, '' AS one "
                         f"FROM {last} s JOIN tops t USING (tree))")
            last = "placed"
        for k in _LEVELS:
            steps.append(f"{name}_up{k} AS ({_up(name, last, tree, rank, k)})")
            last = f"{name}_up{k}"
    end = _LEVELS.stop
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ups = ",\n".join(steps)
    return f"""
WITH leaves AS (
  SELECT doc_id, coalesce('1' || source, '0') AS tree, {_leaf('text')} AS digest,
         CASE WHEN {_crc32('doc_id::VARCHAR')} % 5 = 0 THEN {_leaf(lowered)} END AS tampered
  FROM documents
), {_tree('src', 'leaves', 'doc_id NULLS FIRST, digest')},
named AS (SELECT '' AS tree, tree AS source, digest FROM src{end}),
{_tree('top', 'named', 'source')},
tops AS (
  SELECT source AS tree, row_number() OVER (ORDER BY source) - 1 AS pos, digest FROM named
), asked AS (
  SELECT doc_id, tree, digest AS leaf, coalesce(tampered, digest) AS folded, '' AS siblings,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos
  FROM leaves
), {ups}
SELECT doc_id, leaf, subroot, (SELECT digest FROM top{end}) AS root, sha256(siblings) AS proof_sha256,
       folded AS folded_root, folded = (SELECT digest FROM top{end}) AS verified
FROM {last}
"""


# Near words by the strings that a deletion leaves: of one of the two, or of both at the same place.
_SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents
), counted AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
         translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM runs GROUP BY 1, 2
), hashed AS (
  SELECT run, n, {_crc32("(id || ':' || run)")} AS h FROM counted
), typed AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
              ELSE run END AS word, n
  FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cuts AS (
  SELECT word, k, substr(word, 1, k) || substr(word, k + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS k FROM words)
), pairs AS (
  SELECT a.word, b.word AS near FROM cuts a JOIN cuts b USING (k, rest) WHERE a.word <> b.word
  UNION SELECT a.word, b.word FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM cuts a JOIN words b ON a.rest = b.word
), ranked AS (
  SELECT p.word, p.near, w.n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.near) AS nth
  FROM pairs p JOIN words w ON w.word = p.near
), formed AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 5 * w.n THEN r.near END AS form,
         CASE WHEN r.n >= 5 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.nth = 1
), walk AS (
  SELECT word, word AS here, form AS next FROM formed
  UNION ALL SELECT w.word, f.word, f.form FROM walk w JOIN formed f ON f.word = w.next
)
SELECT word, form, here AS root, n, n_near, form_n
FROM formed JOIN (SELECT word, here FROM walk WHERE next IS NULL) USING (word)
"""

_WINDOWS = r"""
WITH worded AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, len(g) AS size, array_to_string(g, ' ') AS g
  FROM (SELECT item, unnest(list_transform(range(greatest(len(w) - 9, 1)), lambda i: w[i + 1:i + 10])) AS g
        FROM items WHERE len(w) > 0)
), grams AS (
  SELECT row, size, pos, array_to_string(w[pos + 1:pos + size], ' ') AS g
  FROM (SELECT row, w, size, unnest(range(len(w) - size + 1)) AS pos
        FROM worded, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), found AS (
  SELECT g.row, g.pos, g.size, w.item FROM grams g JOIN windows w USING (size, g)
), hits AS (
  SELECT row, count(DISTINCT pos) AS n_hit
  FROM (SELECT row, unnest(range(pos, pos + size)) AS pos FROM found) GROUP BY row
), named AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row, item FROM found) GROUP BY row
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM worded LEFT JOIN hits USING (row) LEFT JOIN named USING (row)
"""

ORACLE: dict[str, str] = {
    "op2_mix_sources": _MIX,
    "op5_ngram_join": _SETS,
    "op6_embedding_dedup": _COSINES,
    "op8_nearest_neighbours": _NEAREST,
    "op10_line_dedup": _LINES,
    "op11_decontamination": _WINDOWS,
    "op12_merkle_manifest": _merkle(),
    "op13_spelling_variants": _SPELLING,
}
