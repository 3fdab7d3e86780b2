"""Registered queries of the operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from riskweave.session import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f
    return put


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def packed(docs: DataFrame) -> DataFrame:
    """Pieces with their place and the crc32 of their ids."""
    from riskweave.llm.packing import pack
    found = pack(docs, vocabulary("word_bpe_49k.json"))

    def crc(batches):
        import zlib
        for b in batches:
            sums = [zlib.crc32(x.as_buffer()) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("row", "doc_id", "start", "length", "doc_tokens")),
                                              pa.array(sums, pa.int64())],
                                             names=["row", "doc_id", "start", "length", "doc_tokens", "ids_crc32"])
    pieces = found.pieces.select("row", "doc_id", "start", "length", "doc_tokens", "ids").mapInArrow(
        crc, "row long, doc_id long, start long, length long, doc_tokens long, ids_crc32 long")
    return pieces.join(found.placement, "row").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@register("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op8_direct_codes")
def op8_direct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskweave.llm.direct_codes import crc_of, write_tokens
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    store = write_tokens(docs, vocabulary("byte_bpe_50k.json"), end_id=2)
    return store.documents(crc_of).withColumnRenamed("digest", "ids_crc32")


@register("op10_sentence_pieces")
def op10_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskweave.llm.sentence_pieces import digests
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, vocabulary("piece_bpe_32k.model"))


@register("op1_graph_search")
def op1_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from riskweave.llm.graph_search import nearest
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, 10, F.col("id") % 100 == 0)


OP4_SQL = """
WITH valid AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
terms AS (SELECT vec_id, unnest(w) AS w, generate_subscripts(w, 1) AS t FROM valid),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score
  FROM terms q JOIN terms c ON q.t = c.t AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0 GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@register("op4_exact_topk", OP4_SQL)
def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from riskweave.llm.exact_topk import exact_topk
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return exact_topk(vectors, 10, F.col("vec_id") % 100 == 0)


OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\t\n\x0b\f\r ]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE shared.n >= 0.8 * (x.n + y.n - shared.n) - 1e-9
  UNION ALL
  SELECT x.doc_id, y.doc_id FROM words x JOIN words y ON x.doc_id <> y.doc_id AND len(x.w) = 0 AND len(y.w) = 0),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM words
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
classes AS (SELECT a, min(b) AS class_id FROM reach GROUP BY 1),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
SELECT classes.a AS doc_id, class_id, coalesce(counts.n, 0) AS n_links
FROM classes LEFT JOIN counts ON counts.a = classes.a
"""


@register("op2_ngram_join", OP2_SQL)
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskweave.llm.ngram_join import near_duplicates
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "n_links")


@register("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskweave.llm.toxicity import toxicity
    return toxicity(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                    read_table(spark, sf_dir, "labels").select("doc_id", "toxic"))


@register("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskweave.llm.kneser_ney import quality
    return quality(read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text"),
                   read_table(spark, sf_dir, "labels").select("doc_id", "quality"))


OP5_SQL = """
WITH said AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS said,
         CAST(coalesce(floor(turn / 256), 0) AS BIGINT) AS part
  FROM conversations),
speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM said WHERE role <> 'system'),
drawn AS (
  SELECT said.*, perspective, CASE WHEN role = 'system' THEN '<|system|>' WHEN role = perspective THEN '<|assistant|>'
         ELSE '<|user name=' || role || '|>' END || chr(10) AS head
  FROM said JOIN speakers ON said.conv_id IS NOT DISTINCT FROM speakers.conv_id),
pieces AS (SELECT *, head || said || '<|end|>' || chr(10) AS piece FROM drawn),
placed AS (
  SELECT *, row_number() OVER w AS nth, sum(length(piece)) OVER (w ROWS UNBOUNDED PRECEDING) - 1 AS stop FROM pieces
  WINDOW w AS (PARTITION BY conv_id, perspective, part ORDER BY turn NULLS FIRST, role, said))
SELECT conv_id, perspective, part, count(*) AS n_turns, string_agg(piece, '' ORDER BY nth) AS text,
       coalesce(string_agg(CASE WHEN role = perspective THEN
         CAST(stop + 1 - length(piece) + length(head) AS BIGINT) || '-' || CAST(stop AS BIGINT) END, ',' ORDER BY nth), '') AS mask
FROM placed GROUP BY 1, 2, 3
"""


@register("op5_chat_rotation", OP5_SQL)
def op5_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from riskweave.llm.chat import rotate
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    spans = F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["stop"].cast("string")))
    return rotate(turns).select("conv_id", "perspective", "part", "n_turns", "text", F.array_join(spans, ",").alias("mask"))


def license_sql() -> str:
    from riskweave.llm.licenses import TEMPLATES, template_terms
    rows = ", ".join(f"('{name}', '{w}', {n})" for name, t in template_terms(TEMPLATES).items() for w, n in t.items())
    return f"""
WITH files AS (SELECT doc_id, source || '/' || lang || '/' || doc_id AS path, coalesce(text, '') AS text FROM documents),
tmpl(license, term, n) AS (VALUES {rows}),
vocab AS (SELECT DISTINCT term FROM tmpl),
held AS (
  SELECT DISTINCT f.rowid AS r, term FROM (SELECT row_number() OVER () AS rowid, text FROM files) f,
  unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS u(term) WHERE term IN (SELECT term FROM vocab)),
idf AS (
  SELECT v.term, ln((1 + (SELECT count(*) FROM files)) / (1 + count(held.r))) + 1 AS idf
  FROM vocab v LEFT JOIN held ON held.term = v.term GROUP BY 1),
other AS (SELECT max(idf) AS idf FROM idf),
norm AS (SELECT license, sqrt(sum((n * idf) * (n * idf))) AS len FROM tmpl JOIN idf USING (term) GROUP BY 1),
units AS (
  SELECT doc_id, path, nth AS line, words FROM files, unnest(string_split(text, chr(10))) WITH ORDINALITY AS u(words, nth)
  UNION ALL SELECT doc_id, path, -1, text FROM files),
tokens AS (
  SELECT doc_id, path, line, term, count(*) AS n FROM units, unnest(regexp_split_to_array(lower(words), '[^a-z0-9]+')) AS u(term)
  WHERE term <> '' GROUP BY 1, 2, 3, 4),
weighed AS (SELECT t.*, t.n * coalesce(idf.idf, other.idf) AS w FROM tokens t LEFT JOIN idf USING (term), other),
norms AS (SELECT doc_id, path, line, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY 1, 2, 3),
dots AS (
  SELECT doc_id, path, line, license, sum(w * tmpl.n * idf.idf / norm.len) AS dot
  FROM weighed JOIN tmpl USING (term) JOIN idf USING (term) JOIN norm USING (license) GROUP BY 1, 2, 3, 4),
scored AS (
  SELECT doc_id, path, line, license, round(dot / norm, 9) AS cosine, dot / norm AS exact
  FROM dots JOIN norms USING (doc_id, path, line)),
best AS (
  SELECT doc_id, path, line < 0 AS whole, license, cosine,
         row_number() OVER (PARTITION BY doc_id, path, line < 0 ORDER BY cosine DESC, license) AS k
  FROM scored WHERE exact >= CASE WHEN line < 0 THEN 0.8 ELSE 0.6 END),
header AS (SELECT doc_id, path, license FROM best WHERE k = 1 AND NOT whole),
lfile AS (SELECT doc_id, path, license, cosine, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir FROM best WHERE k = 1 AND whole),
speaks AS (
  SELECT dir AS up, license FROM (SELECT *, row_number() OVER (PARTITION BY dir ORDER BY cosine DESC, license) AS k FROM lfile) WHERE k = 1),
dirs AS (SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir FROM files WHERE path IS NOT NULL),
above AS (
  SELECT DISTINCT dir, array_to_string(list_slice(string_split(dir, '/'), 1, k), '/') AS up
  FROM dirs, unnest(range(0, len(string_split(dir, '/')) + 1)) AS u(k)),
inherited AS (
  SELECT dir, up, license FROM (SELECT dir, up, license, row_number() OVER (PARTITION BY dir ORDER BY length(up) DESC) AS k
                                FROM above JOIN speaks USING (up)) WHERE k = 1)
SELECT f.doc_id, f.path, coalesce(l.license, h.license, i.license) AS license,
       CASE WHEN l.license IS NOT NULL THEN 'file' WHEN h.license IS NOT NULL THEN 'header'
            WHEN i.license IS NOT NULL THEN 'inherited' END AS found,
       CASE WHEN l.license IS NULL AND h.license IS NULL THEN i.up END AS from_dir
FROM files f LEFT JOIN header h USING (doc_id, path) LEFT JOIN lfile l USING (doc_id, path)
LEFT JOIN inherited i ON i.dir = regexp_extract(f.path, '^(.*)/[^/]*$', 1)
"""


@register("op9_license_scan", license_sql())
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: source / language / id."""
    from pyspark.sql import functions as F

    from riskweave.llm.licenses import scan
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    files = docs.select(F.col("doc_id").alias("id"), F.concat(F.col("source"), F.lit("/"), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"))
                        .alias("path"), "text")
    return scan(files).withColumnRenamed("id", "doc_id")


TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
        r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP13_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS w FROM documents),
items AS (SELECT DISTINCT item_id, unnest({TERMS}) AS t FROM benchmark),
whole AS (SELECT count(*) FILTER (len(w) > 0) AS nd, CAST(sum(len(w)) AS BIGINT) AS l FROM docs),
held AS (
  SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM docs)
  WHERE t IN (SELECT t FROM items) GROUP BY ALL),
df AS (SELECT t, count(*) AS df FROM held GROUP BY t),
gains AS (
  SELECT r, doc_id, t, CAST(floor(1000 * ln((2 * nd + 2) / (2 * df + 1))) AS BIGINT)
                       * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // l))) AS gain
  FROM held JOIN df USING (t), whole),
scores AS (SELECT item_id, r, doc_id, CAST(sum(gain) AS BIGINT) AS score FROM gains JOIN items USING (t) GROUP BY 1, 2, 3),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= 10
"""


@register("op13_shared_ranking", OP13_SQL)
def op13_shared_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskweave.llm.shared_ranking import ranked
    return ranked(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                  read_table(spark, sf_dir, "benchmark").select("item_id", "text"), 10)


def fingerprint_sql(k: int = 128) -> str:
    held = "list_filter(regexp_split_to_array(lower({}), '[\\t\\n\\x0b\\f\\r ]+'), lambda x: x <> '')"
    runs = ("CASE WHEN len({0}) >= 5 THEN list_transform(range(1, len({0}) - 3), lambda i: array_to_string({0}[i:i + 4], ' ')) "
            "WHEN len({0}) > 0 THEN [array_to_string({0}, ' ')] ELSE [] END")
    sketch = f"list_sort(list_distinct(list_transform({runs}, lambda s: md5(s)[1:16])))[1:{k}]"
    like = (f"CASE WHEN len({{0}}) = 0 AND len({{1}}) = 0 THEN 1.0 ELSE len(list_intersect(list_intersect({{0}}, {{1}}), "
            f"list_sort(list_distinct(list_concat({{0}}, {{1}})))[1:{k}])) / len(list_sort(list_distinct(list_concat({{0}}, {{1}})))[1:{k}]) END")
    last = f"least(CASE WHEN len(a) < {k} THEN 'g' ELSE a[-1] END, CASE WHEN len(b) < {k} THEN 'g' ELSE b[-1] END)"
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER w AS nth, count(*) OVER () AS total FROM documents
              WINDOW w AS (ORDER BY doc_id NULLS FIRST, sha256(coalesce(text, '')))),
edit AS (
  SELECT d.doc_id, d.text, length(d.text) AS n, n.text AS next_text,
         left(d.text, length(d.text) - length(d.text) // 4) || left(n.text, length(d.text) // 4) AS edited
  FROM docs d JOIN docs n ON n.nth = d.nth % d.total + 1),
cut AS (SELECT *, {held.format('text')} AS w, {held.format('edited')} AS we, {held.format('next_text')} AS wn FROM edit),
held AS (SELECT *, {sketch.format('w')} AS a, {sketch.format('we')} AS b, {sketch.format('wn')} AS c FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, array_to_string(a, '') AS fingerprint,
       array_to_string(b, '') AS edited_fingerprint, {like.format('a', 'b')} AS near_edited, {like.format('a', 'c')} AS near_next,
       CASE WHEN len(list_filter(a, lambda h: h <= {last})) = 0 THEN 1.0 ELSE
         len(list_filter(list_intersect(a, b), lambda h: h <= {last})) / len(list_filter(a, lambda h: h <= {last})) END AS contained_edited,
       CASE WHEN len(a) < {k} THEN len(a)
            ELSE CAST(round({k - 1}.0::DOUBLE / ((CAST('0x' || a[-1][1:13] AS BIGINT)::DOUBLE + 1) / {16 ** 13}.0::DOUBLE)) AS BIGINT) END AS n_shingles
FROM held
"""


@register("op12_fingerprints", fingerprint_sql())
def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from riskweave.llm.fingerprints import containment, distinct_shingles, fingerprints, resemblance
    k = 128
    found = fingerprints(read_table(spark, sf_dir, "documents").select("doc_id", "text"), k)
    own, edited = F.col("sketch"), F.col("edited_sketch")
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.array_join(own, "").alias("fingerprint"),
                        F.array_join(edited, "").alias("edited_fingerprint"), resemblance(own, edited, k).alias("near_edited"),
                        resemblance(own, F.col("next_sketch"), k).alias("near_next"),
                        containment(own, edited, k).alias("contained_edited"), distinct_shingles(own, k).alias("n_shingles"))


OP11_SQL = """
WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, role, text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS nth FROM said),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
             lambda u, i: CASE WHEN u & 1 = 1 THEN xor(u >> 1, 3988292384::BIGINT) ELSE u >> 1 END)), 4294967295::BIGINT) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
mixed AS (
  SELECT convs.conv_id, nth, role, text FROM convs JOIN turns ON turns.conv_id = base AND nth <= h
  UNION ALL SELECT conv_id, nth, role, text FROM convs JOIN turns USING (conv_id) WHERE nth > h),
paths AS (
  SELECT conv_id, row_number() OVER w AS depth, length(text) AS chars,
         string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w AS path
  FROM mixed WINDOW w AS (PARTITION BY conv_id ORDER BY nth ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
nodes AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars FROM paths GROUP BY 1, 2),
member AS (SELECT p.conv_id AS member, depth, n.conv_id, max(depth) OVER (PARTITION BY p.conv_id) AS last
           FROM paths p JOIN nodes n USING (depth, path)),
tied AS (SELECT n.*, m.conv_id AS parent_conv_id FROM nodes n LEFT JOIN member m ON m.member = n.conv_id AND m.depth = n.depth - 1),
kids AS (SELECT depth - 1 AS depth, parent_conv_id AS conv_id, count(*) AS n_children FROM tied WHERE depth > 0 GROUP BY 1, 2),
whole AS (SELECT tied.*, coalesce(n_children, 0) AS n_children FROM tied LEFT JOIN kids USING (depth, conv_id)),
below AS (
  SELECT m.conv_id, m.depth, count(*) FILTER (w.n_children = 0) AS n_leaves, sum((w.n_convs - 1) * w.chars) AS saved_tokens
  FROM whole w JOIN member m ON m.member = w.conv_id AND m.depth <= w.depth GROUP BY 1, 2),
ends AS (SELECT conv_id, depth, string_agg(member::VARCHAR, ',' ORDER BY member) AS ids FROM member WHERE depth = last GROUP BY 1, 2)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM whole JOIN below USING (conv_id, depth) LEFT JOIN ends USING (conv_id, depth)
"""


@register("op11_prefix_trie", OP11_SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskweave.llm.prefix_trie import grafted, numbered, trie
    turns = numbered(read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return trie(*grafted(turns))
