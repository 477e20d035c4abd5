"""The operators as named queries over the given tables, with production parameters."""

from __future__ import annotations

from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.catalog.registry import Run, table
from fleetmart.llm import bitplanes, bytebpe, chosenpath, collocations, forest, packing, pitmanyor, quality, repeats, simhash, toxicity, turntrie, warc
from fleetmart.sinks.scratch import scratch_path

QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.tiktoken"


def query(name: str, sql: str | None = None):
    def register(run: Run) -> Run:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


@query("op1_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), longest=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op2_bit_planes")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = bitplanes.write_ids(docs, public_tokenizers.path(WORD_BPE), bitplanes.fresh_folder(docs), end_id=2)
    return bitplanes.read_ids(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


_COMPONENTS = """reach(a, b) AS (
        SELECT id, id FROM nodes UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
    ), labels AS (SELECT a AS id, min(b) AS label FROM reach GROUP BY a)"""


@query(
    "op8_warc",
    """
    WITH bodies AS (
        SELECT page_id, coalesce(html, '') AS html, first_value(page_id) OVER (PARTITION BY coalesce(html, '') ORDER BY page_id) AS first_id FROM pages
    ), hashed AS (
        SELECT *, strlen(html) AS payload_bytes, unhex(sha1(html))::BIT::VARCHAR AS bits FROM bodies
    )
    SELECT page_id, payload_bytes,
           array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + list_sum(list_transform(range(5), lambda j: substr(bits, 5 * i + j + 1, 1)::INTEGER * (16 >> j)))::INTEGER, 1)), '') AS payload_digest,
           CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM hashed
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    return warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages"), folder, "2026-01-01T00:00:00Z", min_payload=0))


@query("op3_byte_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trip = bytebpe.round_trip(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)
    return trip.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scores(docs, quality.fit(docs, table(spark, sf_dir, "labels")), 0.3)


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), 0.5)


@query(
    "op10_chosen_path",
    rf"""
    WITH RECURSIVE words AS (
        SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
        FROM documents
    ), shingles AS (
        SELECT DISTINCT id, md5(array_to_string(ws[i : i + 4], ' ')) AS s
        FROM (SELECT id, ws, unnest(range(1, greatest(2, len(ws) - 3))) AS i FROM words WHERE len(ws) > 0)
    ), sizes AS (
        SELECT id, count(*) AS n FROM shingles GROUP BY id
    ), shared AS (
        SELECT x.id AS a, y.id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.id <> y.id GROUP BY ALL
    ), links AS (
        SELECT s.a, s.b FROM shared s JOIN sizes x ON x.id = s.a JOIN sizes y ON y.id = s.b WHERE 100 * s.n >= 85 * (x.n + y.n - s.n)
    ), nodes AS (SELECT DISTINCT a AS id FROM links), {_COMPONENTS}
    SELECT d.id AS doc_id, coalesce(n, 0) AS n_shingles, coalesce(label, d.id) AS component_id, coalesce(label, d.id) = d.id AS kept
    FROM words d LEFT JOIN sizes USING (id) LEFT JOIN labels USING (id)
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosenpath.near_duplicates(table(spark, sf_dir, "documents"), Fraction(85, 100))


@query("op9_repeats")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = repeats.remove_repeats(docs, 200)
    return found.select("rest.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_simhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.compared(table(spark, sf_dir, "documents"), radius=3)


@query(
    "op6_forest",
    f"""
    WITH RECURSIVE vectors AS (
        SELECT vec_id AS id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
    ), whole AS (
        SELECT * FROM vectors WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(v, v) > 0
    ), links AS (
        SELECT x.id AS a, y.id AS b FROM whole x JOIN whole y ON x.label = y.label AND x.id <> y.id AND len(x.v) = len(y.v)
        WHERE list_dot_product(x.v, y.v) / sqrt(list_dot_product(x.v, x.v) * list_dot_product(y.v, y.v)) >= 0.98
    ), degree AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a), nodes AS (SELECT id FROM degree), {_COMPONENTS}
    SELECT v.id AS vec_id, coalesce(n, 0) AS n_links, coalesce(label, v.id) AS component_id, coalesce(label, v.id) = v.id AS kept
    FROM (SELECT id FROM vectors) v LEFT JOIN degree USING (id) LEFT JOIN labels USING (id)
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


@query(
    "op12_prefix_trie",
    """
    WITH said AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS said,
               md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS tie, turn
        FROM conversations WHERE conv_id IS NOT NULL
    ), own AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tie) AS pos, tie, length(said) AS chars
        FROM said
    ), convs AS (
        SELECT conv_id, conv_id - conv_id % 100 AS first, xor(4294967295, list_reduce(
            list_concat([4294967295::BIGINT], list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda j: ascii(substr(conv_id::VARCHAR, j, 1))::BIGINT)),
            lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, s: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS lent
        FROM own GROUP BY conv_id
    ), plan AS (
        SELECT c.conv_id, c.first, c.lent, count(b.pos) AS got
        FROM convs c LEFT JOIN own b ON b.conv_id = c.first AND b.pos <= c.lent GROUP BY ALL
    ), rebuilt AS (
        SELECT p.conv_id, b.pos AS depth, b.tie, b.chars FROM plan p JOIN own b ON b.conv_id = p.first AND b.pos <= p.lent
        UNION ALL
        SELECT p.conv_id, o.pos - p.lent + p.got, o.tie, o.chars FROM plan p JOIN own o ON o.conv_id = p.conv_id AND o.pos > p.lent
    ), path AS (
        SELECT conv_id, depth, md5(string_agg(tie, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS key, chars FROM rebuilt
        UNION ALL
        SELECT conv_id, 0, '', 0 FROM plan
    ), nodes AS (
        SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM path GROUP BY depth, key
    ), steps AS (
        SELECT p.conv_id AS member, p.depth, n.conv_id FROM path p JOIN nodes n USING (depth, key)
    ), edges AS (
        SELECT n.depth, n.conv_id, s.conv_id AS parent_conv_id
        FROM nodes n LEFT JOIN steps s ON s.member = n.conv_id AND s.depth = n.depth - 1
    ), kids AS (
        SELECT depth - 1 AS depth, parent_conv_id AS conv_id, count(*) AS n_children FROM edges WHERE depth > 0 GROUP BY ALL
    ), full_nodes AS (
        SELECT n.*, e.parent_conv_id, coalesce(k.n_children, 0) AS n_children
        FROM nodes n JOIN edges e USING (depth, conv_id) LEFT JOIN kids k USING (depth, conv_id)
    ), below AS (
        SELECT s.depth, s.conv_id, sum((v.n_convs - 1) * v.chars)::BIGINT AS saved_tokens, count(*) FILTER (v.n_children = 0) AS n_leaves
        FROM full_nodes v JOIN steps s ON s.member = v.conv_id AND s.depth <= v.depth GROUP BY ALL
    ), ends AS (
        SELECT s.depth, s.conv_id, string_agg(s.member::VARCHAR, ',' ORDER BY s.member) AS ids
        FROM steps s JOIN (SELECT member, max(depth) AS depth FROM steps GROUP BY member) USING (member, depth) GROUP BY ALL
    )
    SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
    FROM full_nodes JOIN below USING (depth, conv_id) LEFT JOIN ends USING (depth, conv_id)
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turntrie.prefix_trie(table(spark, sf_dir, "conversations")).drop("turn")


@query(
    "op11_collocations",
    r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), words AS (
        SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
    ), totals AS (
        SELECT lang, sum(len(ws))::BIGINT AS n FROM words GROUP BY lang
    ), starts AS (
        SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM words
    ), grams AS (
        SELECT lang, array_to_string(ws[i : i + k - 1], ' ') AS phrase, k
        FROM starts, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(ws)
    ), counts AS (
        SELECT lang, phrase, k, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100
    ), candidates AS (
        SELECT *, string_split(phrase, ' ') AS ws FROM counts WHERE k >= 2
    ), cuts AS (
        SELECT lang, phrase, a, ws, unnest(range(1, k)) AS cut FROM candidates
    ), scored AS (
        SELECT c.lang, c.phrase, c.a, f.a AS l, b.a AS r, t.n, c.cut, ((1000::HUGEINT * c.a * t.n) // (f.a::HUGEINT * b.a))::BIGINT AS score
        FROM cuts c JOIN totals t USING (lang)
        JOIN counts f ON f.lang = c.lang AND f.phrase = array_to_string(ws[1 : cut], ' ')
        JOIN counts b ON b.lang = c.lang AND b.phrase = array_to_string(ws[cut + 1 :], ' ')
    ), lowest AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
    ), kept AS (
        SELECT * FROM lowest p WHERE NOT EXISTS (
            FROM candidates q WHERE q.lang = p.lang AND length(q.phrase) > length(p.phrase)
                AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' ') AND 100 * q.a >= 100 * p.a)
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "binary") AS rank, phrase, a, l, r, n, score
    FROM kept QUALIFY rank <= 2000
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=100, most=2000).drop("cut")


@query("op13_pitman_yor")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitmanyor.scores(table(spark, sf_dir, "documents")).drop("perplexity")
