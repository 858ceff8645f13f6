"""SQL that must give the same rows as the query of the same name."""

MIXING = r"""WITH marks AS (
  SELECT doc_id, min(CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.25 END) AS weight FROM labels GROUP BY doc_id),
sized AS (
  SELECT d.doc_id, d.source,
    CAST(coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    -ln((CAST(CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 12) AS UBIGINT) AS DOUBLE) + 1)
      / 281474976710656.0::DOUBLE) / CAST(coalesce(m.weight, 1.0) AS DOUBLE) AS key
  FROM documents d LEFT JOIN marks m ON d.doc_id = m.doc_id),
ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST(CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight,
    CAST(source_size * 3 AS DOUBLE) AS cap FROM ranked),
levels AS (
  SELECT *, cap / weight AS stop,
    (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER before, 0.0)) / sum(weight) OVER after AS level
  FROM weighed
  WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after AS (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
opened AS (SELECT stop, place, level FROM levels WHERE level < stop ORDER BY stop, place LIMIT 1),
targets AS (
  SELECT l.source, l.source_size,
    CASE WHEN o.stop IS NULL OR l.stop < o.stop OR (l.stop = o.stop AND l.place < o.place) THEN l.cap
      ELSE least(l.weight * o.level, l.cap) END AS target
  FROM levels l LEFT JOIN opened o ON TRUE),
budgets AS (
  SELECT *, coalesce(CAST(floor(target / nullif(source_size, 0)) AS BIGINT), 0) AS epochs FROM targets),
placed AS (
  SELECT s.doc_id, s.source, s.size, b.source_size, b.target, b.epochs,
    CAST(floor(b.target) AS BIGINT) - b.epochs * b.source_size
      - coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id NULLS FIRST, s.size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, source, size, source_size, target, CAST(epochs * size + greatest(0, least(size, rest)) AS BIGINT) AS taken
FROM placed"""

#: The 256 steps of crc32 as a list, and what folds the ASCII or Latin-1 characters of a text into its crc32.
_CRC_TABLE = """crc_table AS (
  SELECT list(v ORDER BY i) AS steps FROM (
    SELECT i, list_reduce(list_concat([i], range(8)),
      lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
    FROM range(256) AS t(i)))"""


def _crc(bytes_sql: str) -> str:
    """SQL for the unsigned crc32 of a list of byte values; ``steps`` must be in scope."""
    return (
        f"xor(list_reduce(list_concat([4294967295::BIGINT], {bytes_sql}), "
        "lambda c, x: xor(c // 256, steps[1 + xor(c, x) % 256])), 4294967295)"
    )


def _merkle(levels: int = 7, crown_levels: int = 5, arity: int = 16) -> str:
    """Trees of at most ``arity ** levels`` leaves, level by level; a tree that is down to one node stays as it is."""

    def sized(text: str, alias: str) -> str:
        parts = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars")] + [text]
        each = [f"CASE WHEN {p} IS NULL THEN '-' ELSE strlen({p}) || ':' || {p} END" for p in parts]
        return f"sha256({' || '.join(each)}) AS {alias}"

    decimal = _crc("list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: unicode(c)::BIGINT)")
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        _CRC_TABLE,
        f"""digests AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, {sized("text", "leaf")},
    CASE WHEN doc_id IS NOT NULL AND {decimal} % 5 = 0 THEN {sized(lower, "x").removesuffix(" AS x")} END AS changed
  FROM documents, crc_table)""",
        """leaves AS (
  SELECT doc_id, tree, leaf, coalesce(changed, leaf) AS claim,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, changed NULLS FIRST) - 1 AS pos
  FROM digests)""",
    ]

    def climb(name: str, leaves: str, levels: int) -> None:
        steps.append(f"{name}_0 AS (SELECT tree, pos, digest, count(*) OVER (PARTITION BY tree) AS size FROM {leaves})")
        for k in range(levels):
            steps.append(f"""{name}_runs_{k} AS (
  SELECT tree, pos // {arity} AS up, string_agg(digest, '' ORDER BY pos) AS run, any_value(size) AS size
  FROM {name}_{k} GROUP BY tree, pos // {arity})""")
            steps.append(f"""{name}_{k + 1} AS (
  SELECT tree, up AS pos, CASE WHEN size > 1 THEN sha256(run) ELSE run END AS digest,
    (size + {arity - 1}) // {arity} AS size
  FROM {name}_runs_{k})""")

    def fold(name: str, start: str, levels: int) -> str:
        at = start
        for k in range(levels):
            left = f"substr(r.run, 1, CAST(64 * (a.pos_{name} // {arity**k} % {arity}) AS BIGINT))"
            right = f"substr(r.run, CAST(64 * (a.pos_{name} // {arity**k} % {arity}) + 65 AS BIGINT))"
            others = f"CASE WHEN r.size > 1 THEN {left} || {right} ELSE '' END"
            steps.append(f"""{start}_{name}_{k} AS (
  SELECT a.* REPLACE (CASE WHEN r.size > 1 THEN sha256({left} || a.claim || {right}) ELSE a.claim END AS claim,
    a.proof || {others} AS proof)
  FROM {at} a JOIN {name}_runs_{k} r ON r.tree = a.tree_{name} AND r.up = a.pos_{name} // {arity ** (k + 1)})""")
            at = f"{start}_{name}_{k}"
        return at

    steps.append("digested AS (SELECT tree, pos, leaf AS digest FROM leaves)")
    climb("sources", "digested", levels)
    steps.append(f"subroots AS (SELECT 0 AS tree, tree AS pos, digest FROM sources_{levels})")
    climb("crown", "subroots", crown_levels)
    steps.append(f"""paths AS (
  SELECT l.doc_id, l.leaf, l.claim, '' AS proof, s.digest AS subroot, c.digest AS root, l.tree AS tree_sources,
    l.pos AS pos_sources, 0 AS tree_crown, l.tree AS pos_crown
  FROM leaves l JOIN sources_{levels} s ON l.tree = s.tree CROSS JOIN crown_{crown_levels} c)""")
    low = fold("sources", "paths", levels)
    high = fold("crown", low, crown_levels)
    return f"""WITH {", ".join(steps)}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, claim AS folded_root, claim = root AS verified
FROM {high}"""


MERKLE = _merkle()

LINES = r"""WITH split AS (
  SELECT row_number() OVER () AS id, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split),
common AS (
  SELECT key FROM keyed WHERE key <> ''
  GROUP BY key HAVING count(DISTINCT doc_id) + CAST(count(*) > count(doc_id) AS INTEGER) >= 10)
SELECT any_value(k.doc_id) AS doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
  sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.place) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c ON k.key = c.key
GROUP BY k.id"""


def _spelling(steps: int = 16) -> str:
    """Near words share a text after one character of either, or of both at one place, is taken out."""
    latin = "list_transform(string_split(name, ''), lambda c: unicode(c)::BIGINT)"
    as_bytes = f"flatten(list_transform({latin}, lambda u: CASE WHEN u < 128 THEN [u] ELSE [195, u - 64] END))"
    crc = _crc(as_bytes)
    hops = [
        f"""roots_{k + 1} AS (
  SELECT r.word, coalesce(f.form, r.root) AS root FROM roots_{k} r LEFT JOIN formed f ON f.word = r.root)"""
        for k in range(steps)
    ]
    return rf"""WITH {_CRC_TABLE},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc,
    translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]{{6,}}')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
counted AS (SELECT doc || ':' || run AS name, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (SELECT run, n, {crc} AS h FROM counted, crc_table),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) + 2 AS BIGINT))
      ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (
  SELECT word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 5 * w.n THEN b.other END AS form,
    CASE WHEN b.other_n >= 5 * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
roots_0 AS (SELECT word, word AS root FROM words),
{", ".join(hops)}
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM formed f JOIN roots_{steps} r ON f.word = r.word"""


SPELLING = _spelling()
