"""The registered queries: each applies one operator to its whole table and
returns the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strongroom.llm.common import crc_mod
from strongroom.llm.secrets import KINDS, LONG, RANDOM, RANK, RUN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def word_bpe() -> str:
    """Where the installed vocabulary file of the packing query lies."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of equal label."""
    from strongroom.llm.embedding_links import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the rows not held out."""
    from strongroom.llm.language import identify, learn

    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    out = identify(docs, learn(docs.where(~held), "text", "lang"))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document; a source is an owner, a source's language part a repository."""
    from strongroom.llm.secrets import scan

    return scan(table(spark, sf_dir, "documents")).drop("found")


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    from strongroom.llm.topk import top_k

    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5, scale=256)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    from strongroom.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families of the paragraphs of every document."""
    from strongroom.llm.licences import fit, scan_paragraphs

    docs = table(spark, sf_dir, "documents")
    return scan_paragraphs(docs, fit(docs))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the rows not held out."""
    from strongroom.llm.quality import score, train

    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    out = score(docs, train(docs, table(spark, sf_dir, "labels").where(~held)))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix of sources takes."""
    from strongroom.llm.mixing import mix

    documents, _ = mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), most_times=3)
    return documents.select("doc_id", "size", "source_size", "target", "taken")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in padded sequences of at most 4096 tokens."""
    from strongroom.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), word_bpe(), with_ids=False)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from strongroom.llm.html_text import extract

    return extract(table(spark, sf_dir, "pages"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every vector on the first four components."""
    from strongroom.llm.whitening import whiten

    out = whiten(table(spark, sf_dir, "embeddings"), k=4, scale=256)
    return out.select("vec_id", "component", "n", F.col("deviation").cast("long").alias("deviation"), "whitened", "explained", "identity_error")


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after five rounds from forty seeds."""
    from strongroom.llm.centroids import cluster

    return cluster(table(spark, sf_dir, "embeddings"), width=64, k=40, rounds=5, scale=256, seed="2").drop("centroid")


def op13_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document; a source is a host."""
    from strongroom.llm.host_rules import judge

    return judge(table(spark, sf_dir, "documents")).drop("n_lines")


QUERIES = {
    "op1_embedding_links": op1_embedding_links,
    "op2_language_id": op2_language_id,
    "op3_secret_scan": op3_secret_scan,
    "op4_topk_search": op4_topk_search,
    "op5_simhash": op5_simhash,
    "op6_licence_scan": op6_licence_scan,
    "op7_quality": op7_quality,
    "op8_source_mixing": op8_source_mixing,
    "op9_packing": op9_packing,
    "op10_html_extraction": op10_html_extraction,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_host_rules": op13_host_rules,
}


def rounds_sql(rounds: int, k: int = 40, width: int = 64) -> str:
    """Centroid clustering with every distance computed anew in each round."""
    nearest = """SELECT vec_id, x, cluster, distance FROM (
            SELECT v.vec_id, v.x, c.cluster, list_sum(list_transform(list_zip(v.x, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance,
                   row_number() OVER (PARTITION BY v.vec_id ORDER BY distance, c.cluster) AS place
            FROM vectors v CROSS JOIN c{r} c) WHERE place = 1"""
    update = f"""SELECT c.cluster, coalesce(m.c, c.c) AS c FROM c{{r}} c LEFT JOIN (
            SELECT cluster, list(mean ORDER BY i) AS c FROM (
                SELECT cluster, i, ((sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS mean
                FROM a{{r}}, range(1, {width + 1}) AS places(i) GROUP BY cluster, i) GROUP BY cluster) m USING (cluster)"""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED ({nearest.format(r=r)})")
        if r < rounds:
            steps.append(f"c{r + 1} AS MATERIALIZED ({update.format(r=r)})")
    return f"""
        WITH vectors AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        c0 AS MATERIALIZED (
            SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1)::INTEGER AS cluster, x AS c
            FROM vectors ORDER BY sha256('2:' || vec_id) LIMIT {k}),
        {", ".join(steps)}
        SELECT a.vec_id, a.cluster, a.distance, (sum(a.distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
               (sum(a.distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} c USING (cluster)"""

#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op1_embedding_links": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b
              ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
            WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
        reach AS (
            SELECT x, y FROM links
            UNION
            SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
        SELECT e.vec_id,
               (SELECT count(*) FROM links l WHERE l.x = e.vec_id) AS n_links,
               least(e.vec_id, coalesce((SELECT min(y) FROM reach r WHERE r.x = e.vec_id), e.vec_id)) AS component_id,
               e.vec_id <= coalesce((SELECT min(y) FROM reach r WHERE r.x = e.vec_id), e.vec_id) AS kept
        FROM embeddings e""",
    "op3_secret_scan": f"""
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, coalesce('=' || source, '-') AS owner, coalesce('=' || lang, '-') AS part FROM documents),
        patterns AS (SELECT * FROM (VALUES {", ".join(f"({RANK[k]}, '{k}', {sql_text(LONG.get(k) or KINDS[k])})" for k in RANK)}) AS v(rank, kind, pattern)),
        hits AS (
            SELECT doc_id, owner, part, rank, kind, unnest(range(1, len(h) + 1)) AS i, h,
                   CASE WHEN kind = 'assign' THEN regexp_extract_all(t, {sql_text(KINDS["assign"])}, 2) ELSE h END AS v, g
            FROM (SELECT doc_id, owner, part, rank, kind, t,
                         CASE rank {" ".join(f"WHEN {RANK[k]} THEN regexp_extract_all(t, {sql_text(LONG.get(k) or KINDS[k])})" for k in RANK)} END AS h,
                         CASE rank {" ".join(f"WHEN {RANK[k]} THEN string_split_regex(t, {sql_text(LONG.get(k) or KINDS[k])})" for k in RANK)} END AS g
                  FROM docs CROSS JOIN patterns)),
        placed AS (
            SELECT doc_id, owner, part, rank, kind, v[i] AS value, length(h[i]) AS n,
                   list_sum(list_transform(g[1:i], lambda x: length(x)))
                   + coalesce(list_sum(list_transform(h[1:i-1], lambda x: length(x))), 0) AS s
            FROM hits),
        spans AS (
            SELECT doc_id, owner, part, rank, kind, value, CAST(s AS BIGINT) AS s, CAST(s + n AS BIGINT) AS e FROM placed
            WHERE CASE kind WHEN 'assign' THEN length(value) >= 6
                            WHEN 'token' THEN regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[0-9]')
                                 AND 5 * length(regexp_replace(value, '[^A-Za-z0-9]', '', 'g')) < 13 * len(regexp_extract_all(value, {sql_text(RUN)}))
                                 AND {RANDOM} * list_sum(list_transform(list_distinct(string_split(value, '')), lambda c: pow(length(value) - length(replace(value, c, '')), 2))) <= pow(length(value), 2)
                            ELSE true END),
        taken AS (
            SELECT * FROM spans x WHERE kind <> 'token' OR NOT EXISTS (
                SELECT 1 FROM spans b WHERE b.doc_id = x.doc_id AND b.kind <> 'token' AND b.s < x.e AND x.s < b.e)),
        owned AS (SELECT value, count(*) AS owners, max(parts) AS most FROM (
            SELECT value, owner, count(DISTINCT part) AS parts FROM taken GROUP BY value, owner) GROUP BY value),
        marked AS (SELECT taken.*, owners <= 1 AND most <= 3 AS live FROM taken JOIN owned USING (value)),
        final AS (
            SELECT doc_id,
                   count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
                   count(*) FILTER (WHERE kind = 'hex') AS n_hex,
                   string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (WHERE kind <> 'token') AS base,
                   string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans,
                   count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE NOT live) AS n_example
            FROM marked WHERE kind <> 'token' OR live GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
               coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
        FROM docs d LEFT JOIN final f ON d.doc_id = f.doc_id""",
    "op4_topk_search": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, v.vec_id,
                   CAST(coalesce(list_sum(list_transform(list_zip(q.x, v.x), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
            FROM vectors q JOIN vectors v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id AND len(q.x) = len(v.x)),
        ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                   vec_id, score
            FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op12_centroid_clusters": rounds_sql(5),
    "op13_host_rules": r"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, source FROM documents),
        words AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs),
        windows AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x
                    FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
        repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM windows) WHERE n > 1),
        covered AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM repeated, range(3) AS places(k) GROUP BY r),
        lines AS (SELECT r, line FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
        dups AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY r),
        counts AS (
            SELECT d.r, d.doc_id,
                   nullif(regexp_replace(lower(trim(coalesce(nullif(regexp_extract(source, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1), ''), source))), '^www\.', ''), '') AS host,
                   len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                   length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_lines, 0)::BIGINT AS n_lines,
                   coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
            FROM docs d JOIN words USING (r) LEFT JOIN covered USING (r) LEFT JOIN dups USING (r)),
        failures AS (
            SELECT host, rule, count(*)::DOUBLE AS n, sum(failed::INTEGER)::DOUBLE AS f FROM (
                SELECT host, unnest(['repeats', 'symbols', 'lines', 'length']) AS rule,
                       unnest([100 * n_repeat_words > 50 * n_words, 10 * n_symbols > n_words, n_dup_lines > 5 AND 5 * n_dup_lines > n_lines,
                               word_chars < 3 * n_words OR word_chars > 12 * n_words]) AS failed
                FROM counts WHERE host IS NOT NULL) GROUP BY host, rule),
        sums AS (
            SELECT rule, sum(n) AS docs, sum(f) / sum(n) AS p, count(*) - 1 AS more, sum(n * n) / sum(n) AS squares, sum(f * f / n) AS spread
            FROM failures GROUP BY rule),
        overlap AS (SELECT rule, p, greatest((1 - rho) / rho, 10) AS strength FROM (
            SELECT rule, p, CASE WHEN p * (1 - p) * (docs - squares - more) > 0
                THEN least(greatest((spread - docs * p * p - p * (1 - p) * more) / (p * (1 - p) * (docs - squares - more)), 1e-6), 1 - 1e-6) ELSE 1e-6 END AS rho
            FROM sums)),
        bad AS (
            SELECT DISTINCT host FROM failures JOIN overlap USING (rule)
            WHERE (f + p * strength) / (n + strength) > 0.8)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed, bad.host IS NOT NULL AS host_failed,
               NOT base_failed AND bad.host IS NULL AS kept
        FROM counts LEFT JOIN bad USING (host)""",
}
