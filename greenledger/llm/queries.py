"""One query per numbered operator, over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe_codec, exact_dedup, html_extract, kd_shards, merkle, minhash_dedup, mixing, quality_rules, spelling, suffix_dedup,
    token_counts, toxicity, warc)
from .common import prepare, read_table

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 512
TOXIC_FROM = 0.7
SHARDS = 16


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.token_digests(read_table(spark, sf_dir, "documents"), VOCABULARY)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_documents(read_table(spark, sf_dir, "documents"), VOCABULARY, TOKEN_LIMIT)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_dedup(read_table(spark, sf_dir, "documents"), minhash_dedup.Near(shingle=2))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(read_table(spark, sf_dir, "pages"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


def op12_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes near equal: the law is ``bytes``; a k-d tree has no shard that only takes."""
    placed = kd_shards.kd_shards(read_table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_proofs(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_bpe, op2_quality, op3_token_counts, op4_toxicity, op5_suffix_dedup, op6_minhash, op7_warc, op8_mixing,
        op9_html, op10_exact_dedup, op11_spelling, op12_kd_shards, op13_merkle)}


OP10_SQL = """
WITH rows AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM rows WINDOW same AS (PARTITION BY norm)
"""


OP7_SQL = """
WITH rows AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
kept AS (
  SELECT page_id, payload, strlen(payload) AS payload_bytes,
         CASE WHEN strlen(payload) >= 1000 THEN max(page_id) OVER (PARTITION BY payload) ELSE page_id END AS top
  FROM rows)
SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM kept
"""


_WORDS = r"[^\x20\x09-\x0D]+"

OP6_SQL = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE len(w) WHEN 0 THEN [] WHEN 1 THEN w
                                 ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM texts),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT doc_id, y FROM reached JOIN both_ways ON x = other)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


#: Characters with the Uppercase property: capital letters, and numerals and enclosed letters of that form.
_CAPITALS = r"\p{Lu}\x{2160}-\x{216F}\x{24B6}-\x{24CF}\x{1F130}-\x{1F149}\x{1F150}-\x{1F169}\x{1F170}-\x{1F189}"


def _op2_sql() -> str:
    """The measures and the verdict with the limits of quality_rules."""
    rules = quality_rules.Rules()
    ctes, repeat, top = [], [], []
    for k in range(2, max(quality_rules.REPEAT_LIMITS) + 1):
        if k not in quality_rules.TOP_LIMITS and k not in quality_rules.REPEAT_LIMITS:
            continue
        ctes.append(f"""g{k} AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS m FROM (
    SELECT doc_id, i, array_to_string(w[i:i + {k - 1}], ' ') AS g
    FROM texts, range(1, len(w) - {k - 2}) AS p(i)))""")
        inside = f"max({{}}) OVER (PARTITION BY t.doc_id ORDER BY t.i ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
        if k in quality_rules.REPEAT_LIMITS:
            ctes.append(f"""r{k} AS (
  SELECT doc_id, sum(c) FILTER (again) AS chars, count(*) FILTER (again) AS n_inside FROM (
    SELECT t.doc_id, t.c, {inside.format("coalesce(m, 0)")} > 1 AS again
    FROM words t LEFT JOIN g{k} g ON g.doc_id = t.doc_id AND g.i = t.i) GROUP BY doc_id)""")
            repeat.append((k, quality_rules.REPEAT_LIMITS[k]))
        if k in quality_rules.TOP_LIMITS:
            ctes.append(f"""b{k} AS (
  SELECT doc_id, g, m FROM (SELECT doc_id, g, m, min(i) AS first, m * (length(g) - {k - 1}) AS total
                            FROM g{k} GROUP BY doc_id, g, m)
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY total DESC, first) = 1),
t{k} AS (
  SELECT doc_id, sum(c) FILTER (here) AS chars, any_value(m) AS times FROM (
    SELECT t.doc_id, t.c, b.m, {inside.format("coalesce(g.g = b.g, false)::INTEGER")} = 1 AS here
    FROM words t JOIN b{k} b ON b.doc_id = t.doc_id LEFT JOIN g{k} g ON g.doc_id = t.doc_id AND g.i = t.i)
  GROUP BY doc_id),
any{k} AS (SELECT doc_id, max(m) > 1 AS some FROM g{k} GROUP BY doc_id)""")
            top.append((k, quality_rules.TOP_LIMITS[k]))
    over = [f"coalesce(r{k}.chars, 0) > {limit}::DOUBLE * word_chars" for k, limit in repeat]
    over += [f"coalesce(any{k}.some AND t{k}.chars > {limit}::DOUBLE * word_chars AND n_words > {2 * k} AND t{k}.times > 2, false)"
             for k, limit in top]
    over += [f"coalesce(l.n_dup_lines > {rules.line_share}::DOUBLE * n_lines, false)",
             f"coalesce(dup_chars > {rules.line_char_share}::DOUBLE * line_chars, false)",
             f"n_symbols > {rules.symbol_share}::DOUBLE * word_chars",
             f"shouted > {rules.upper_share}::DOUBLE * greatest(1, word_chars)"]
    joins = " ".join(f"LEFT JOIN r{k} ON r{k}.doc_id = d.doc_id" for k, _ in repeat) + " " + " ".join(
        f"LEFT JOIN t{k} ON t{k}.doc_id = d.doc_id LEFT JOIN any{k} ON any{k}.doc_id = d.doc_id" for k, _ in top)
    widest = ", ".join(f"coalesce(r{k}.chars, 0)" for k, _ in repeat)
    tops = ", ".join(f"CASE WHEN any{k}.some THEN t{k}.chars ELSE 0 END" for k, _ in top)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
words AS (SELECT doc_id, i, w[i] AS word, length(w[i]) AS c FROM texts, range(1, len(w) + 1) AS p(i)),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines, sum(length(line)) AS line_chars,
         sum(length(line)) - list_sum(list_transform(list_distinct(list(line)), lambda x: length(x))) AS dup_chars
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '{_WORDS}') GROUP BY doc_id),
{", ".join(ctes)},
d AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(text, '[^{_CAPITALS}]', '', 'g')) AS shouted
  FROM texts),
measured AS (
  SELECT d.*, n_lines, line_chars, dup_chars, coalesce(l.n_dup_lines, 0) AS n_dup_lines,
         coalesce(r5.n_inside, 0) AS n_repeat_words, greatest({widest}) AS repeat_chars,
         coalesce(greatest({tops}), 0) AS top_chars, {" OR ".join(over)} AS failed
  FROM d LEFT JOIN lines l ON l.doc_id = d.doc_id {joins})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, repeat_chars::BIGINT AS repeat_chars,
       top_chars::BIGINT AS top_chars, base_failed, NOT base_failed AND NOT failed AS kept
FROM (SELECT *, n_words < {rules.least_words} OR 100 * n_repeat_words > {rules.repeat_words_pct} * n_words AS base_failed
      FROM measured)
"""


def _crc_table() -> str:
    """The 256 steps of the crc32 of a byte, from its polynomial."""
    table = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ 0xEDB88320 * (c & 1)
        table.append(str(c))
    return f"[{', '.join(table)}]::BIGINT[]"


def _crc(text: str) -> str:
    """crc32 of the UTF-8 bytes of an SQL expression."""
    return (f"xor(list_reduce(list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT), "
            f"lambda c, b: xor(c >> 8, ({_crc_table()})[1 + (xor(c, b) & 255)]), 4294967295::BIGINT), 4294967295)")


_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11_SQL = f"""
WITH RECURSIVE found AS (
  SELECT doc_id, {_LOWERED.format("unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+'))")} AS run FROM documents),
runs AS (SELECT doc_id, run, count(*) AS n FROM found WHERE length(run) >= {spelling.LEAST_LENGTH} GROUP BY ALL),
hashed AS (SELECT *, {_crc("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs),
written AS (
  SELECT CASE WHEN h % {spelling.DAMAGE} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
              ELSE run END AS word, n FROM hashed),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM written WHERE length(word) >= {spelling.LEAST_LENGTH}
  GROUP BY word HAVING sum(n) >= {spelling.LEAST_COUNT}),
cuts AS (
  SELECT DISTINCT word, n, length(word) AS len, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word AS a, b.word AS b, a.n AS n_a, b.n AS n_b FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest
    AND a.word < b.word AND a.len = b.len
  UNION SELECT a.word, b.word, a.n, b.n FROM words a JOIN cuts b ON a.word = b.rest),
near AS (
  SELECT a AS word, b AS other, n_b AS other_n FROM pairs UNION ALL SELECT b, a, n_a FROM pairs),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, struct_pack(r := -other_n, w := encode(other))) AS other,
         max(other_n) AS other_n
  FROM near GROUP BY word),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {spelling.TIMES} * n THEN other END AS form,
         CASE WHEN other_n >= {spelling.TIMES} * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
steps(word, form_at) AS (
  SELECT word, word FROM words
  UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.form_at WHERE f.form IS NOT NULL),
roots AS (SELECT s.word, s.form_at AS root FROM steps s JOIN forms f ON f.word = s.form_at WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""


def _op12_sql() -> str:
    """The tree level by level: nodes, their widest axis, and bytes ahead in its order."""
    def text_axis(name: str) -> str:
        return f"('0x' || rpad(left(hex(encode({name})), {2 * kd_shards.AXIS_BYTES}), {2 * kd_shards.AXIS_BYTES}, '0'))::BIGINT::DOUBLE"

    ctes, axes = [], ["x0", "x1", "x2"]
    ctes.append(f"""c0 AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {_crc("coalesce(text, '')")} AS text_crc32,
         {text_axis("source")} AS x0, {text_axis("lang")} AS x1, n_chars::DOUBLE AS x2, row_number() OVER () AS tie
  FROM documents)""")
    scaled = ", ".join(
        f"CASE WHEN max({a}) OVER () > min({a}) OVER () THEN coalesce(({a} - min({a}) OVER ()) / "
        f"(max({a}) OVER () - min({a}) OVER ()), 0.0) ELSE 0.0 END AS {a}" for a in axes)
    ctes.append(f"l0 AS (SELECT doc_id, size, text_crc32, tie, {scaled}, 0 AS shard, {SHARDS} AS leaves FROM c0)")
    level, most = 0, SHARDS
    while most > 1:
        wide = [f"(max({a}) OVER node - min({a}) OVER node)" for a in axes]
        along = " ".join(f"WHEN w{k} >= greatest(w0, w1, w2) THEN {a}" for k, a in enumerate(axes))
        ctes.append(f"""w{level} AS (
  SELECT *, {", ".join(f"{w} AS w{k}" for k, w in enumerate(wide))} FROM l{level} WINDOW node AS (PARTITION BY shard)),
s{level} AS (
  SELECT *, sum(size) OVER (PARTITION BY shard) AS total,
         sum(size) OVER (PARTITION BY shard ORDER BY CASE {along} END, x0, x1, x2, doc_id NULLS FIRST, tie) - size AS before
  FROM w{level}),
l{level + 1} AS (
  SELECT doc_id, size, text_crc32, tie, x0, x1, x2, shard + CASE WHEN far THEN leaves // 2 ELSE 0 END AS shard,
         CASE WHEN far THEN leaves - leaves // 2 ELSE leaves // 2 END AS leaves
  FROM (SELECT *, (2.0::DOUBLE * before::DOUBLE + size::DOUBLE) * leaves > 2.0::DOUBLE * total::DOUBLE * (leaves // 2) AS far
        FROM s{level}))""")
        level, most = level + 1, -(-most // 2)
    return f"""
WITH {", ".join(ctes)}
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, tie) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM l{level}
"""


#: Levels that the SQL of op13_merkle climbs: enough for 16 ** 8 leaves.
_LEVELS = 8


def _climb_sql(first: str, into: str) -> str:
    """From ``first`` (tree, i, d, s, p): each node with its digest, the digest that a
    tampered leaf gives, and its leaf's siblings so far, level by level to the root."""
    ctes = [f"{into}0 AS (SELECT tree, i, d, count(*) OVER (PARTITION BY tree) AS width FROM {first})"]
    for k in range(_LEVELS):
        ctes.append(f"""{into}{k + 1} AS (
  SELECT tree, i // 16 AS i, CASE WHEN any_value(width) > 1 THEN sha256(string_agg(d, '' ORDER BY i)) ELSE any_value(d) END AS d,
         (any_value(width) + 15) // 16 AS width
  FROM {into}{k} GROUP BY tree, i // 16)""")
    return ", ".join(ctes)


def _siblings_sql(start: str, into: str, out: str) -> str:
    """``start`` (id, tree, i, f, p): fold f up the tree ``into``; p collects the siblings."""
    ctes, last = [], start
    for k in range(_LEVELS):
        ctes.append(f"""{out}{k + 1} AS (
  SELECT x.id, x.tree, x.i // 16 AS i, CASE WHEN r.width > 1 THEN sha256(r.before || x.f || r.after) ELSE x.f END AS f,
         CASE WHEN r.width > 1 THEN x.p || r.before || r.after ELSE x.p END AS p
  FROM {last} x JOIN (
    SELECT tree, i, width, coalesce(string_agg(d, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
           coalesce(string_agg(d, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM {into}{k} WINDOW run AS (PARTITION BY tree, i // 16 ORDER BY i)) r ON r.tree = x.tree AND r.i = x.i)""")
        last = f"{out}{k + 1}"
    return ", ".join(ctes)


def _op13_sql() -> str:
    def field(x: str) -> str:
        return f"coalesce(strlen({x}) || ':' || {x}, '-')"

    head = " || ".join(field(f"{c}::VARCHAR") for c in ("doc_id", "source", "lang", "n_chars"))
    return f"""
WITH given AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('=' || source, '') AS tree, sha256({head} || {field("text")}) AS leaf,
         CASE WHEN coalesce({_crc("doc_id::VARCHAR")} % 5 = 0, false)
              THEN sha256({head} || {field(_LOWERED.format("text"))}) ELSE leaf END AS start
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS d FROM given),
{_climb_sql("leaves", "a")},
tops AS (SELECT tree AS source, '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, d FROM a{_LEVELS}),
{_climb_sql("tops", "b")},
x0 AS (SELECT id, tree, i, start AS f, '' AS p FROM leaves),
{_siblings_sql("x0", "a", "x")},
y0 AS (SELECT x.id, '' AS tree, t.i, x.f, x.p FROM x{_LEVELS} x JOIN tops t ON t.source = x.tree),
{_siblings_sql("y0", "b", "y")}
SELECT g.doc_id, g.leaf, t.d AS subroot, r.d AS root, sha256(y.p) AS proof_sha256, y.f AS folded_root, y.f = r.d AS verified
FROM y{_LEVELS} y JOIN given g ON g.id = y.id JOIN tops t ON t.source = g.tree CROSS JOIN b{_LEVELS} r
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_quality": _op2_sql(), "op6_minhash": OP6_SQL, "op7_warc": OP7_SQL, "op10_exact_dedup": OP10_SQL,
            "op11_spelling": OP11_SQL, "op12_kd_shards": _op12_sql(), "op13_merkle": _op13_sql()}
