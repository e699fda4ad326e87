"""DuckDB SQL for the operators that SQL can express on whole tables.

The others hash with functions that DuckDB lacks, or ask a tokenizer or a fitted model; they
are tested against brute-force versions.
"""

from __future__ import annotations

from adstream.llm import codes, mixing, spelling

# The letters of base 32, four for each five hexadecimal digits.
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_FIVE = "CAST('0x' || substr(hex_, 1 + 5 * (i // 4), 5) AS INTEGER)"
_BASE32 = (
    f"list_reduce(list_transform(range(32), lambda i: substr('{_LETTERS}', 1 + (({_FIVE} >> (15 - 5 * (i % 4))) & 31), 1)), "
    "lambda a, b: a || b)"
)

WARC = f"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html_, sha1(coalesce(html, '')) AS hex_ FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex_) AS first_ FROM payloads
)
SELECT page_id, CAST(strlen(html_) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN first_ IS DISTINCT FROM page_id AND first_ IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_ IS DISTINCT FROM page_id THEN first_ END AS refers_to
FROM firsts"""

# Squares are added one after another, as the query does.
_DISTANCE = (
    "sqrt(list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - v.e[i]) * (q.e[i] - v.e[i])), lambda a, b: a + b))"
)

NEAREST = f"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, {_DISTANCE} AS score
  FROM vectors q JOIN vectors v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e)
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""


# CRC-32 four bits at a time: the remainders of the sixteen leading halves of a byte.
def _crc_table() -> list[int]:
    table = []
    for n in range(16):
        for _ in range(4):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        table.append(n)
    return table


# hex() gives the upper half of a byte first, the checksum takes the lower half first.
_CRC32 = f"""xor(4294967295::BIGINT, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(range(length(h)), lambda i:
    CAST('0x' || substr(h, CAST(1 + xor(i, 1) AS INTEGER), 1) AS BIGINT))),
  lambda crc, x: xor(crc >> 4, ({_crc_table()}::BIGINT[])[1 + (xor(crc, x) & 15)])))"""

# One byte for each letter, as levenshtein() compares bytes.
_ACCENTED = "".join(map(chr, range(0xC0, 0x100)))
_PLAIN = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.islower() and c not in "'")[: len(_ACCENTED)]

SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
  FROM documents
), hashed AS MATERIALIZED (
  SELECT d, run, count(*) AS n, hex(encode(d || ':' || run)) AS h FROM runs GROUP BY d, run
), damaged AS (
  SELECT run, n, {_CRC32} AS crc FROM hashed
), counted AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n, translate(word, '{_ACCENTED}', '{_PLAIN}') AS w, length(word) AS l
  FROM (SELECT n, CASE WHEN crc % {spelling.DAMAGED_EVERY} = 0
    THEN substr(run, 1, CAST(crc % length(run) AS INTEGER)) || substr(run, CAST(crc % length(run) AS INTEGER) + 2)
    ELSE run END AS word FROM damaged)
  WHERE length(word) >= {spelling.LEAST_LETTERS} GROUP BY word HAVING sum(n) >= {spelling.LEAST_COUNT}
), near AS MATERIALIZED (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM counted a JOIN counted b
  ON b.l BETWEEN a.l - 1 AND a.l + 1 AND levenshtein(a.w, b.w) = 1
), best AS MATERIALIZED (
  SELECT word, n, other, other_n, n_near, other_n >= {spelling.FORM_FACTOR} * n AS taken FROM (
    SELECT *, count(*) OVER (PARTITION BY word) AS n_near,
      row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place FROM near) WHERE place = 1
), paths AS (
  SELECT word, other AS root, 1 AS steps FROM best WHERE taken
  UNION ALL SELECT p.word, b.other, steps + 1 FROM paths p JOIN best b ON b.word = p.root WHERE b.taken
), roots AS (SELECT word, arg_max(root, steps) AS root FROM paths GROUP BY word)
SELECT c.word, CASE WHEN taken THEN other END AS form, coalesce(root, c.word) AS root, c.n,
  coalesce(n_near, 0) AS n_near, CASE WHEN taken THEN other_n END AS form_n
FROM counted c LEFT JOIN best USING (word) LEFT JOIN roots USING (word)"""

_WEIGHTS = f"{list(mixing.WEIGHTS)}"
MIXING = f"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(size AS VARCHAR)) AS key FROM documents
), sources AS MATERIALIZED (
  SELECT source, CAST(sum(size) AS HUGEINT) AS s,
    {_WEIGHTS}[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}]::HUGEINT AS w
  FROM docs GROUP BY source
), rounds AS (
  SELECT 0 AS round, (SELECT sum(s) FROM sources)::HUGEINT AS rest, (SELECT sum(w) FROM sources)::HUGEINT AS share
  UNION ALL
  SELECT round + 1,
    (SELECT sum(s) FROM sources)::HUGEINT - (SELECT coalesce(sum(s), 0) FROM sources WHERE {mixing.MOST_EPOCHS} * s * share < w * rest)::HUGEINT * {mixing.MOST_EPOCHS},
    (SELECT sum(w) FROM sources WHERE {mixing.MOST_EPOCHS} * s * share >= w * rest)::HUGEINT
  FROM rounds WHERE round < (SELECT count(*) FROM sources)
), aimed AS (
  SELECT source, s, CASE WHEN {mixing.MOST_EPOCHS} * s * share < w * rest THEN CAST({mixing.MOST_EPOCHS} * s AS DOUBLE)
      ELSE CAST(w * rest AS DOUBLE) / CAST(share AS DOUBLE) END AS target,
    CASE WHEN {mixing.MOST_EPOCHS} * s * share < w * rest THEN {mixing.MOST_EPOCHS} * s ELSE w * rest // share END AS budget
  FROM sources, (SELECT rest, share FROM rounds ORDER BY round DESC LIMIT 1)
), placed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) - size AS before_ FROM docs
)
SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, target,
  CAST(CASE WHEN s = 0 THEN 0 ELSE budget // s * size + least(size, greatest(budget % s - before_, 0)) END AS BIGINT) AS taken
FROM placed JOIN aimed ON placed.source IS NOT DISTINCT FROM aimed.source"""


def _vector_codes() -> str:
    """All rounds one after another; lengths have to be divisible by the number of parts."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS row_, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor({codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT row_, part, v[part * len(v) // {codes.PARTS} + 1 : (part + 1) * len(v) // {codes.PARTS}] AS v
  FROM kept, range({codes.PARTS}) AS t(part)
), book0 AS MATERIALIZED (
  SELECT part, row_ - 1 AS entry, v FROM parts WHERE row_ <= {codes.ENTRIES}
)"""
    ]
    apart = "list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - b.v[i]) * (p.v[i] - b.v[i])))"
    for n in range(codes.ROUNDS + 1):
        steps.append(
            f"""near{n} AS MATERIALIZED (
  SELECT row_, part, arg_min(entry, struct_pack(d := d, e := entry)) AS entry, CAST(min(d) AS BIGINT) AS d
  FROM (SELECT p.row_, p.part, b.entry, {apart} AS d FROM parts p JOIN book{n} b ON b.part = p.part) GROUP BY row_, part
)"""
        )
        if n < codes.ROUNDS:
            steps.append(
                f"""sums{n} AS (
  SELECT part, entry, place, CAST(sum(x) AS BIGINT) AS s, count(*) AS c FROM (
    SELECT n.part, n.entry, unnest(p.v) AS x, unnest(range(len(p.v))) AS place
    FROM near{n} n JOIN parts p ON p.row_ = n.row_ AND p.part = n.part) GROUP BY part, entry, place
), book{n + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{n} b LEFT JOIN (
    SELECT part, entry, list((s - ((s % c) + c) % c) // c ORDER BY place) AS v FROM sums{n} GROUP BY part, entry
  ) m ON m.part = b.part AND m.entry = b.entry
)"""
            )
    steps.append(
        f"""digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS sha FROM book{codes.ROUNDS}
), coded AS (
  SELECT row_, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{codes.ROUNDS} GROUP BY row_
)"""
    )
    return f"""
WITH {", ".join(steps)}
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256
FROM coded JOIN kept USING (row_), digest"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc": WARC,
        "op10_nearest": NEAREST,
        "op11_spelling_variants": SPELLING,
        "op12_mixing": MIXING,
        "op13_vector_codes": _vector_codes(),
    }
