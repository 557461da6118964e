"""Queries ``opN_<name>`` over the driver's tables, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustlake.llm import flac, forest, line_dedup, mixing, ngram_join, sentencepiece_codec, simhash, spelling, substring_dedup, suffix_dedup, token_files, toxicity, vector_codes
from trustlake.llm.common import table, written


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines every document has and loses."""
    return line_dedup.removed_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "chars_removed")


def op2_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Every document's ids as the token files hold them."""
    return token_files.token_files(table(spark, sf_dir, "documents"), tokenizer or tokenizer_path("word_bpe_49k.json"), end_id=1, n_vocab=49408)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learnt from the rows of the other folds."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs.where(~toxicity.held_out()), labels.where(~toxicity.held_out()))
    out = toxicity.scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model, ["doc_id"])
    return out.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "hits")


def op4_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """Every document encoded, decoded again and held against the sentencepiece library."""
    return sentencepiece_codec.encode_documents(table(spark, sf_dir, "documents"), model or tokenizer_path("piece_bpe_32k.model"), keep_ids=False)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the strings of 200 bytes that stand twice."""
    out = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("n").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it."""
    return mixing.mix_documents(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the windows of 13 words that stand in earlier ones."""
    out = substring_dedup.without_copied_passages(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("n").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return forest.neighbours(table(spark, sf_dir, "embeddings"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of similar texts and the number of its links."""
    return ngram_join.similar_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op10_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text as a FLAC stream, stored, read back and described."""
    return flac.media_digests(written(flac.media_column(table(spark, sf_dir, "documents")), "media"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the least document that links of two bits reach."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code and error, the error of its label and the hash of the codebooks."""
    out = vector_codes.compressed(table(spark, sf_dir, "embeddings"))
    codes = vector_codes.with_group_errors(out.codes)
    return codes.select("vec_id", "code", "error", "label_error", F.lit(out.sha256).alias("codebooks_sha256"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its near words counted, its form and its root."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {"op1_line_dedup": op1_line_dedup, "op2_token_files": op2_token_files, "op3_toxicity": op3_toxicity, "op4_sentencepiece": op4_sentencepiece, "op5_suffix_dedup": op5_suffix_dedup, "op6_mixing": op6_mixing, "op7_substring_dedup": op7_substring_dedup, "op8_forest": op8_forest, "op9_ngram_join": op9_ngram_join, "op10_flac": op10_flac, "op11_simhash": op11_simhash, "op12_vector_codes": op12_vector_codes, "op13_spelling": op13_spelling}

#: A round of ``op12_vector_codes`` in SQL: the nearest entry of each part, then the entries' means rounded down.
CODE_ROUND = """
at{k} AS (
  SELECT rid, p.part, arg_min(entry, (list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c)) * 64 + entry) AS entry,
         min(list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c)) AS d
  FROM parts p JOIN book{k} b ON p.part = b.part GROUP BY rid, p.part),
mean{k} AS (
  SELECT part, entry, list(m ORDER BY pos) AS c
  FROM (SELECT part, entry, pos, floor(sum(v) / count(*)) AS m FROM (SELECT part, entry, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM at{k} JOIN parts USING (rid, part)) GROUP BY 1, 2, 3) GROUP BY 1, 2),
book{n} AS (SELECT part, entry, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} m USING (part, entry)),"""

ORACLE = {
    "op1_line_dedup": r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
lines AS (SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs WHERE text IS NOT NULL),
placed AS (SELECT *, length(line) AS n, regexp_matches(line, '[^\x20\x09-\x0D]') AS told, {'d': doc_id, 'p': pos} AS place FROM lines),
firsts AS (SELECT line, n, min(place) AS place FROM placed WHERE told GROUP BY line, n),
halves AS (
  SELECT line, n, place, b, side, CASE side WHEN 0 THEN left(line, CAST(b // 2 AS INT)) ELSE right(line, CAST(b - b // 2 AS INT)) END AS half
  FROM firsts, (VALUES (0), (1)) s(side), (VALUES (0), (1)) l(less), LATERAL (SELECT n - less AS b) WHERE n >= 16),
alike AS (
  SELECT DISTINCT x.line AS later, y.line AS earlier
  FROM halves x JOIN halves y ON x.half = y.half AND x.b = y.b AND x.side = y.side AND y.place < x.place AND abs(x.n - y.n) <= 1),
near AS (SELECT DISTINCT later AS line FROM alike WHERE levenshtein(later, earlier) <= 1),
marked AS (
  SELECT p.rid, p.n, p.told AND (f.place < p.place OR near.line IS NOT NULL) AS gone
  FROM placed p LEFT JOIN firsts f USING (line) LEFT JOIN near USING (line))
SELECT d.doc_id, count(m.n) AS n_lines, CAST(coalesce(sum(CAST(m.gone AS BIGINT)), 0) AS BIGINT) AS n_removed,
       CAST(coalesce(sum(CASE WHEN m.gone THEN m.n ELSE 0 END), 0) AS BIGINT) AS chars_removed
FROM docs d LEFT JOIN marked m USING (rid) GROUP BY d.rid, d.doc_id""",
    "op5_suffix_dedup": r"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS bytes FROM documents),
placed AS (SELECT rid, len(bytes) AS n, unnest(bytes) AS byte, generate_subscripts(bytes, 1) AS pos FROM docs),
windows AS (SELECT rid, byte, pos, CASE WHEN pos + 199 <= n THEN md5(string_agg(byte, '') OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 199 FOLLOWING)) END AS w FROM placed),
told AS (SELECT rid, byte, pos, w IS NOT NULL AND count(*) OVER (PARTITION BY w) > 1 AS again FROM windows),
covered AS (SELECT rid, byte, pos, bool_or(again) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS gone FROM told),
runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY rid ORDER BY pos), false) AS starts FROM covered),
kept AS (SELECT rid, count(*) FILTER (gone) AS n_removed, count(*) FILTER (starts) AS n_spans, string_agg(byte, '' ORDER BY pos) FILTER (NOT gone) AS kept FROM runs GROUP BY 1)
SELECT doc_id, CAST(len(bytes) AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM docs LEFT JOIN kept USING (rid)""",
    "op6_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(length(source) AS VARCHAR), '-') || ':' || coalesce(source, '') || ':' || coalesce(CAST(doc_id AS VARCHAR), '') || ':0:' || coalesce(text, '')) AS key
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
  FROM sized GROUP BY source),
capped AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS full_at FROM per),
levels AS (
  SELECT a.source, a.source_size, a.weight, a.cap, a.full_at,
         ((SELECT sum(source_size)::DOUBLE * 1.5::DOUBLE FROM per) - coalesce((SELECT sum(cap) FROM capped b WHERE b.full_at < a.full_at), 0.0::DOUBLE))
           / (SELECT sum(weight) FROM capped b WHERE b.full_at >= a.full_at) AS level
  FROM capped a),
common AS (SELECT max(level) FILTER (level < full_at) AS common FROM levels),
targets AS (SELECT source, source_size, CASE WHEN common IS NULL OR full_at <= common THEN cap ELSE weight * common END AS target FROM levels, common),
running AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM sized),
planned AS (
  SELECT r.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN CAST(floor(t.target) AS BIGINT) // t.source_size ELSE 0 END AS whole
  FROM running r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + least(size, greatest(0, CAST(floor(target) AS BIGINT) - whole * source_size - ahead)) AS BIGINT) AS taken
FROM planned""",
    "op7_substring_dedup": r"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
placed AS (SELECT rid, doc_id, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM docs),
windows AS (SELECT *, CASE WHEN pos + 12 <= n THEN string_agg(word, ' ') OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) END AS window13 FROM placed),
told AS (SELECT *, window13 IS NOT NULL AND min(doc_id) OVER (PARTITION BY window13) < doc_id AS copied FROM windows),
covered AS (SELECT *, bool_or(copied) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM told),
kept AS (SELECT rid, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM covered GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM docs LEFT JOIN kept USING (rid)""",
    "op9_ngram_join": r"""
WITH RECURSIVE texts AS (SELECT row_number() OVER () AS tid, text, min(doc_id) AS first FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents) GROUP BY text),
listed AS (SELECT tid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts),
placed AS (SELECT tid, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM listed),
grams AS (SELECT tid, n, pos, string_agg(word, ' ') OVER (PARTITION BY tid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS gram FROM placed),
shingles AS (SELECT DISTINCT tid, gram FROM grams WHERE pos + 4 <= n OR (n < 5 AND pos = 1)),
sizes AS (SELECT tid, count(*) AS n FROM shingles GROUP BY 1),
common AS (SELECT a.tid AS x, b.tid AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.gram = b.gram AND a.tid < b.tid GROUP BY 1, 2),
pairs AS (SELECT x, y FROM common JOIN sizes p ON p.tid = x JOIN sizes q ON q.tid = y WHERE 5 * c >= 4 * (p.n + q.n - c)),
links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reached AS (SELECT tid, tid AS other FROM texts UNION SELECT r.tid, l.y FROM reached r JOIN links l ON l.x = r.other),
classes AS (SELECT r.tid, min(t.first) AS class_id FROM reached r JOIN texts t ON t.tid = r.other GROUP BY 1)
SELECT d.doc_id, class_id, (SELECT count(*) FROM links WHERE x = t.tid) AS n_links FROM documents d JOIN texts t ON t.text = coalesce(d.text, '') JOIN classes c ON c.tid = t.tid""",
    "op12_vector_codes": """
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v, len(embedding) // 16 AS w
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT rid, part, v[part * w + 1 : part * w + w] AS x FROM kept, range(16) r(part)),
book0 AS (SELECT part, rid - 1 AS entry, x AS c FROM parts WHERE rid <= 64),"""
    + CODE_ROUND.format(k=0, n=1)
    + CODE_ROUND.format(k=1, n=2)
    + CODE_ROUND.format(k=2, n=3)
    + """
hash AS (SELECT sha256(string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM (SELECT part, entry, unnest(c) AS v, generate_subscripts(c, 1) AS pos FROM book2)),
coded AS (SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM at2 GROUP BY 1)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM kept JOIN coded USING (rid), hash""",
    "op13_spelling": r"""
WITH RECURSIVE codes AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY 1, 2),
hashed AS (
  SELECT run, n, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)), '..'), lambda b: (instr('123456789ABCDEF', b[1]) * 16 + instr('123456789ABCDEF', b[2]))::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h
  FROM counted, codes),
words AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n FROM hashed),
vocabulary AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM words WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
less AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, CAST(unnest(range(1, length(word) + 1)) AS INT) AS i FROM vocabulary)),
near AS (
  SELECT less.word, v.word AS other FROM less JOIN vocabulary v ON v.word = rest UNION SELECT v.word, less.word FROM less JOIN vocabulary v ON v.word = rest
  UNION SELECT a.word, b.word FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word),
best AS (SELECT near.word, count(*) OVER (PARTITION BY near.word) AS n_near, other, v.n AS m FROM near JOIN vocabulary v ON v.word = other QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY v.n DESC, other) = 1),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN other END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n FROM vocabulary LEFT JOIN best USING (word)),
steps AS (SELECT word, word AS root FROM forms UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.root WHERE f.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN steps USING (word) WHERE root IN (SELECT word FROM forms WHERE form IS NULL)""",
}
