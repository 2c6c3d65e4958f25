"""The contract's queries of this subpackage, each a digest of what its operator gives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratakit.llm import (
    best_fit,
    bit_negatives,
    cutting_stock,
    flow_mix,
    hilbert_search,
    histogram_sort,
    language_gru,
    letter_tree,
    license_index,
    minhash_hamming,
    secret_markov,
    suffix_groups,
    vector_graph,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per packed sequence, with its ids, segment ends and positions."""
    return best_fit.pack(_table(spark, sf_dir, "documents"))


def op5_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 shards of near equal bytes; equal texts lie side by side."""
    body = F.coalesce("text", F.lit(""))
    documents = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"),
    )
    sharded = histogram_sort.shard(documents, F.col("size"), F.col("text_hash"), F.col("doc_id"), 40)
    nothing = F.lit(None).cast("int")
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", nothing.alias("grown_shard")
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from four fifths of the documents, by the hash of their id, and predicts all of them."""
    documents = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = language_gru.fit(documents.where(~held_out))
    found = language_gru.identify(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_hamming.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def op1_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.near_vectors(_table(spark, sf_dir, "embeddings"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans per document; the models are trained on a bounded sample of the same texts."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_markov.find(documents, secret_markov.fit(documents)).select("doc_id", "secrets")

    def of(kind: int):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    base = secret_markov.listed(F.filter("secrets", lambda s: s["kind"] < 3))
    return found.select(
        "doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
        F.sha2(base, 256).alias("base_sha256"), secret_markov.listed(F.col("secrets")).alias("spans"),
    )


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document belongs to its own source; sizes are words between ASCII spaces."""
    documents = _table(spark, sf_dir, "documents")
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    rows = documents.select("doc_id", "source", words.cast("long").alias("size"), F.crc32("text").alias("text_crc32"))
    mixed, sizes, quotas = flow_mix.mix(rows, F.array("source"), F.col("size"))
    schema = "name string, source_size long, target double"
    per_source = spark.createDataFrame([(s, sizes[s], quotas[s]) for s in sizes], schema)
    return mixed.join(F.broadcast(per_source), F.col("source").eqNullSafe(F.col("name"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("given")).alias("taken")
    )


def op8_cutting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cutting_stock.pack(_table(spark, sf_dir, "documents"), with_ids=False)


def op9_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_index.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumns(
        {"base_labels": F.array_join("base_labels", ","), "labels": F.array_join("labels", ",")}
    )


def op10_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_search.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_deepshallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_groups.remove_repeats(_table(spark, sf_dir, "documents"), with_text=False)


def op12_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 31st run, by its hash in its document, loses a letter before words are counted."""
    return letter_tree.variants(_table(spark, sf_dir, "documents"), drop_each=31)


def op13_onebit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every seventh row are moved on by one before mining."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return bit_negatives.mine(rows, F.col("vec_id") % 100 == 0)


_QUERIES = (op1_graph, op2_secrets, op3_minhash, op4_best_fit, op5_histogram, op6_language, op7_mix, op8_cutting, op9_license, op10_hilbert,
            op11_deepshallow, op12_kdtree, op13_onebit)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES}


_NEAR_VECTORS = """
    WITH RECURSIVE usable AS (
        SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings
        WHERE list_count(embedding) = len(embedding) AND list_bool_and(list_transform(embedding, lambda x: isfinite(x)))
          AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
    ), links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.v, b.v) >= 0.95
    ), reach AS (
        SELECT vec_id AS a, vec_id AS b FROM embeddings
        UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
    ), lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
    SELECT a AS vec_id, (SELECT count(*) FROM links WHERE links.a = lowest.a) AS n_links, component_id,
           a = component_id AS kept
    FROM lowest
"""
_SHINGLES = r"""
    WITH words AS (
        SELECT doc_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[ \t-\r]+'), lambda x: x <> '') AS w
        FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
        FROM words
    )
"""
_MINHASH = _SHINGLES.replace("WITH", "WITH RECURSIVE", 1) + """
    , items AS (SELECT doc_id, unnest(s) AS x FROM sets),
    common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
        FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2
    ), pairs AS (
        SELECT a, b FROM common JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
        WHERE 100 * n >= 85 * (len(p.s) + len(q.s) - n)
    ), links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
    reach AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
    ), lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
    FROM sets JOIN lowest ON doc_id = a
"""


_NEGATIVES = """
    WITH usable AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND list_count(embedding) = len(embedding)
          AND list_bool_and(list_transform(embedding, lambda x: isfinite(x)))
    ), scored AS (
        SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id,
               list_inner_product(a.v, b.v)::BIGINT AS score
        FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
    ), positives AS (
        SELECT * FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
    )
    SELECT anchor_id, p.id AS positive_id,
           (row_number() OVER (PARTITION BY anchor_id, p.id ORDER BY n.score DESC, n.id))::INTEGER AS rank,
           n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives p JOIN scored n USING (anchor_id)
    WHERE NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
    QUALIFY rank <= 10
"""
_REPEATS = """
    WITH bodies AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    starts AS (
        SELECT doc_id, unnest(generate_series(0, length(h) // 2 - 100)) AS pos, h FROM bodies WHERE length(h) >= 200
    ), strings AS (SELECT doc_id, pos, md5(substr(h, 2 * pos + 1, 200)) AS s FROM starts),
    repeats AS (
        SELECT doc_id, pos FROM strings QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, pos) > 1
    ), runs AS (
        SELECT doc_id, pos, coalesce(pos - lag(pos) OVER w > 100, true) AS new FROM repeats
        WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
    ), numbered AS (
        SELECT doc_id, pos, sum(new::INTEGER) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM runs
    ), spans AS (
        SELECT doc_id, min(pos) AS first, max(pos) + 100 AS past FROM numbered GROUP BY doc_id, span
    ), cuts AS (
        SELECT doc_id, count(*) AS n_spans, sum(past - first)::BIGINT AS n_removed,
               list([first, past] ORDER BY first) AS cuts FROM spans GROUP BY doc_id
    ), pieces AS (
        SELECT doc_id, h, coalesce(n_spans, 0) AS n_spans, coalesce(n_removed, 0) AS n_removed,
               list_concat([0], list_transform(coalesce(cuts, []), lambda c: c[2])) AS begins,
               list_concat(list_transform(coalesce(cuts, []), lambda c: c[1]), [length(h) // 2]) AS ends
        FROM bodies LEFT JOIN cuts USING (doc_id)
    )
    SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, n_removed, n_spans,
           sha256(unhex(array_to_string(list_transform(range(1, len(begins) + 1),
               lambda i: substr(h, (2 * begins[i] + 1)::BIGINT, (2 * (ends[i] - begins[i]))::BIGINT)), ''))) AS kept_sha256
    FROM pieces
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_graph": _NEAR_VECTORS, "op3_minhash": _MINHASH, "op11_deepshallow": _REPEATS, "op13_onebit": _NEGATIVES}
