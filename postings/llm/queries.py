"""The registered queries of the subpackage, and the SQL of those that SQL can express."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.llm.bpe import digests
from postings.llm.clustering import cluster_vectors, with_inertia
from postings.llm.exact_dedup import exact_duplicates
from postings.llm.language import fit_languages, held_out, identify
from postings.llm.neighbours import nearest_neighbours
from postings.llm.ngram_join import ngram_components
from postings.llm.packing import pack_documents
from postings.llm.phrases import collocations
from postings.llm.sharding import assign_shards, number_slots, shard_of
from postings.llm.token_counts import prefix_counts, total_tokens
from postings.llm.token_files import read_token_files, write_token_files
from postings.llm.tokens import BYTE_BPE, WORD_BPE, tokenizer_path
from postings.llm.toxicity import fit_severity, grade_texts, labelled_sample
from postings.llm.url_filter import Rule, judge_urls
from postings.shared import new_path, settle
from postings.sources.tables import table

SHARDS = 8
SEQUENCE = 4096
END_ID = 2
TOKEN_LIMIT = 2048
CENTROIDS, ROUNDS = 40, 5
URL_RULES = (
    Rule("com", "/", True),
    Rule("example.com", "/en/", False),
    Rule("www.example.com", "/en/", True),
    Rule("net", "/es/", False),
    Rule("net", "/fr/", False),
)


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in eight shards of the same weight; a record's id alone decides."""
    rows = assign_shards(table(spark, folder, "documents"), [1.0] * SHARDS)
    rows = rows.withColumn("grown_shard", shard_of(F.col("doc_id"), [1.0] * (SHARDS + 1)))
    return number_slots(rows).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Expected severity and grade of every document, learned from the labels."""
    docs = table(spark, folder, "documents")
    return grade_texts(docs, fit_severity(labelled_sample(docs, table(spark, folder, "labels"))))


def op3_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents that share nine tenths of their word trigrams."""
    found = ngram_components(table(spark, folder, "documents"), n=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What becomes of every document when of equal texts the smallest id stays."""
    return exact_duplicates(table(spark, folder, "documents"), digest=True)


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, folder, "documents")
    found = identify(docs, fit_languages(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return digests(table(spark, folder, "documents"), tokenizer_path(BYTE_BPE))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, and which have too many."""
    counts = prefix_counts(table(spark, folder, "documents"), tokenizer_path(WORD_BPE))
    total = total_tokens(F.col("prefix_tokens"))
    return counts.select("doc_id", "n_bytes", total.alias("n_tokens")).withColumn(
        "over_limit", F.col("n_tokens") > TOKEN_LIMIT
    )


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return pack_documents(table(spark, folder, "documents"), tokenizer_path(WORD_BPE), END_ID, SEQUENCE)


def op9_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 vectors of largest inner product with every twentieth."""
    found = nearest_neighbours(table(spark, folder, "embeddings"), k=20, every=20)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written as token files, and what is read back from the files."""
    target = new_path(spark, "token-files")
    docs = table(spark, folder, "documents")
    manifest = settle(write_token_files(docs, target, tokenizer_path(BYTE_BPE), END_ID), "token-manifest")
    return read_token_files(manifest, target)


def op11_clustering(spark: SparkSession, folder: str) -> DataFrame:
    """All vectors in 40 clusters after five rounds of k-means in whole numbers."""
    found = cluster_vectors(table(spark, folder, "embeddings"), k=CENTROIDS, rounds=ROUNDS)
    return with_inertia(found).withColumnRenamed("id", "vec_id")


def op12_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """All pages allowed or blocked by their URLs."""
    return judge_urls(table(spark, folder, "pages"), URL_RULES)


def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2000 phrases of each language."""
    return collocations(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_toxicity": op2_toxicity,
    "op3_ngram_join": op3_ngram_join,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_language_id": op5_language_id,
    "op6_bpe": op6_bpe,
    "op7_token_counts": op7_token_counts,
    "op8_packing": op8_packing,
    "op9_neighbours": op9_neighbours,
    "op10_token_files": op10_token_files,
    "op11_clustering": op11_clustering,
    "op12_url_filter": op12_url_filter,
    "op13_phrases": op13_phrases,
}


def _ngram_join_sql() -> str:
    """Overlaps of all sets that share a shingle, and the smallest id that links lead to."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
        WITH RECURSIVE words AS MATERIALIZED (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
        ),
        shingles AS MATERIALIZED (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s
            FROM words
        ),
        sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS MATERIALIZED (
            SELECT a, b
            FROM (
                SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
                FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
            )
            JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
            WHERE 100 * shared >= 90 * (p.n + q.n - shared)
        ),
        ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reached(doc_id, other) AS (
            SELECT a, b FROM ways UNION SELECT r.doc_id, w.b FROM reached r JOIN ways w ON w.a = r.other
        )
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id
        FROM documents d LEFT JOIN sizes USING (doc_id)
        LEFT JOIN (SELECT doc_id, min(other) AS low FROM reached GROUP BY doc_id) USING (doc_id)
    """


def _clustering_sql() -> str:
    """k-means in whole numbers: every round measures all vectors against all centroids."""
    nearest = """
        SELECT row, vec_id, v, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
        FROM (
            SELECT row, vec_id, v, cluster,
                   list_sum(list_transform(range(1, 65), lambda i: CAST((v[i] - c[i]) * (v[i] - c[i]) AS BIGINT))) AS distance
            FROM kept, {centroids}
        )
        GROUP BY row, vec_id, v
    """
    steps = [f"""
        kept AS MATERIALIZED (
            SELECT row_number() OVER () AS row, vec_id,
                   list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64
        ),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY name) - 1 AS cluster, v AS c
            FROM (SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS name, v FROM kept ORDER BY name LIMIT {CENTROIDS})
        )"""]
    for number in range(ROUNDS):
        steps.append(f"a{number} AS MATERIALIZED ({nearest.format(centroids=f'c{number}')})")
        steps.append(f"""
        m{number} AS MATERIALIZED (
            SELECT cluster, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY dim) AS mean
            FROM (
                SELECT cluster, dim, sum(x) AS s, CAST(count(*) AS HUGEINT) AS n
                FROM (SELECT cluster, unnest(range(1, 65)) AS dim, unnest(v) AS x FROM a{number})
                GROUP BY cluster, dim
            )
            GROUP BY cluster
        ),
        c{number + 1} AS MATERIALIZED (
            SELECT cluster, coalesce(mean, c) AS c FROM c{number} LEFT JOIN m{number} USING (cluster)
        )""")
    return "WITH " + ", ".join(steps) + f""",
        last AS MATERIALIZED ({nearest.format(centroids=f'c{ROUNDS}')})
        SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
               CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM last JOIN c{ROUNDS} USING (cluster)
    """


def _url_filter_sql(order: int = 4, held: int = 5) -> str:
    """The rules, the counts of every length, and the mixed chances from the shortest context up."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    gram = " || ".join(f"marked[i + {j}]" for j in range(1, order + 2))
    back = f"(CAST('0x' || substr(md5(text), 1, 7) AS BIGINT) % {held} = 0)"
    levels = []
    for size in range(1, order + 2):
        q = "1.0 / 256" if size == 1 else "{}"
        qa, qb = (f"CAST({q} AS DOUBLE)".format(f"p{kind}") for kind in "ab")
        join = "" if size == 1 else f"JOIN (SELECT s AS shorter, pa, pb FROM p{size - 1}) ON substr(s, 2) = shorter"
        levels.append(f"""
        p{size} AS MATERIALIZED (
            SELECT s,
                   CASE WHEN na > 0 THEN (CAST(a AS DOUBLE) + da * {qa}) / CAST(na + da AS DOUBLE) ELSE {qa} END AS pa,
                   CASE WHEN nb > 0 THEN (CAST(b AS DOUBLE) + db * {qb}) / CAST(nb + db AS DOUBLE) ELSE {qb} END AS pb
            FROM (
                SELECT s, a, b, sum(a) OVER w AS na, sum(b) OVER w AS nb,
                       CAST(count(*) FILTER (a > 0) OVER w AS DOUBLE) AS da,
                       CAST(count(*) FILTER (b > 0) OVER w AS DOUBLE) AS db
                FROM (SELECT right(gram, {size}) AS s, sum(a) AS a, sum(b) AS b FROM counts GROUP BY ALL)
                WINDOW w AS (PARTITION BY left(s, {size - 1}))
            ) {join}
        )""")
    fits = lambda rule: (
        f"WHEN (host = '{rule.host}' OR ends_with(host, '.{rule.host}')) AND starts_with(path, '{rule.path}') "
    )
    longest = sorted(URL_RULES, key=lambda rule: -len(rule.name))
    return f"""
        WITH rest AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ),
        parts AS (
            SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), '{upper}', '{lower}') AS host,
                   regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path
            FROM rest
        ),
        rows AS MATERIALIZED (
            SELECT page_id, host, path, host || path AS text,
                   CASE {' '.join(fits(rule) + f"THEN '{rule.name}'" for rule in longest)} END AS rule,
                   CASE {' '.join(fits(rule) + f"THEN {rule.allow}" for rule in longest)} END AS allow
            FROM parts
        ),
        texts AS MATERIALIZED (SELECT text, allow, count(*) AS n FROM rows GROUP BY ALL),
        spread AS MATERIALIZED (
            SELECT text, allow, n, CASE WHEN {back} THEN 0 ELSE n END AS teaches, {gram} AS gram
            FROM (
                SELECT *, unnest(range(len(marked) - {order})) AS i
                FROM (
                    SELECT *, list_concat([{', '.join(['chr(2)'] * order)}],
                                          regexp_extract_all(translate(text, '{upper}', '{lower}'), '(?s).'),
                                          [chr(3)]) AS marked
                    FROM texts
                )
            )
        ),
        counts AS MATERIALIZED (
            SELECT gram, sum(CASE WHEN allow THEN teaches ELSE 0 END) AS a,
                   sum(CASE WHEN NOT allow THEN teaches ELSE 0 END) AS b
            FROM spread GROUP BY gram
        ),
        {', '.join(levels)},
        scored AS MATERIALIZED (
            SELECT text, allow, n, CAST(floor(CAST(sum(score) AS DOUBLE) / CAST(count(*) * 10000 AS DOUBLE)) AS BIGINT) AS ratio
            FROM spread JOIN (SELECT s, CAST(floor(1000000 * (ln(pa) - ln(pb)) + 0.5) AS BIGINT) AS score FROM p{order + 1})
                 ON gram = s
            GROUP BY text, allow, n
        ),
        kinds AS (
            SELECT ratio, sum(CASE WHEN allow THEN n ELSE 0 END) AS a, sum(CASE WHEN allow THEN 0 ELSE n END) AS b
            FROM scored WHERE allow IS NOT NULL AND {back} GROUP BY ratio
        ),
        cuts AS (
            SELECT floor((ratio + coalesce(lag(ratio) OVER (ORDER BY ratio), ratio) + 1) / 2.0) AS threshold,
                   coalesce(sum(a) OVER below, 0) AS a_below, coalesce(sum(b) OVER below, 0) AS b_below,
                   sum(a) OVER () AS n_a, sum(b) OVER () AS n_b
            FROM kinds
            WINDOW below AS (ORDER BY ratio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ),
        cut AS (
            SELECT CAST(coalesce(any_value(threshold), 0) AS BIGINT) AS threshold
            FROM (
                SELECT threshold FROM cuts WHERE n_a > 0 AND n_b > 0
                ORDER BY a_below * n_b + (n_b - b_below) * n_a, abs(threshold), threshold LIMIT 1
            )
        )
        SELECT page_id, host, path, rule,
               CASE WHEN coalesce(r.allow, ratio >= threshold) THEN 'allow' ELSE 'block' END AS verdict, ratio, threshold
        FROM rows r JOIN scored s ON r.text = s.text, cut
    """


def _phrases_sql() -> str:
    """All phrases of one to four words by their places in the pieces."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
        WITH pieces AS MATERIALIZED (
            SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
            FROM (
                SELECT coalesce(lang, 'und') AS lang,
                       unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'),
                                                    '[.,;:!?\\x0A-\\x0D]')) AS piece
                FROM documents
            )
        ),
        totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
        f AS MATERIALIZED (
            SELECT lang, p, count(*) AS a
            FROM (
                SELECT lang, unnest(list_transform(range(1, len(w) - size + 2), lambda i: w[i:i + size - 1])) AS p
                FROM pieces, range(1, 5) sizes(size)
            )
            GROUP BY lang, p HAVING count(*) >= 30
        ),
        cuts AS (
            SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM f WHERE len(p) > 1
        ),
        scored AS (
            SELECT c.lang, c.p, c.a, k, x.a AS l, y.a AS r,
                   CAST((CAST(2000000 AS HUGEINT) * c.a) // (CAST(x.a AS HUGEINT) + y.a) AS BIGINT) AS score
            FROM cuts c
            JOIN f x ON x.lang = c.lang AND x.p = c.p[1:k]
            JOIN f y ON y.lang = c.lang AND y.p = c.p[k + 1:]
        ),
        lowest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
        ),
        inside AS (
            SELECT lang, p[i:i + size - 1] AS p, max(a) AS longest
            FROM (
                SELECT lang, p, a, size, unnest(range(1, len(p) - size + 2)) AS i
                FROM f, range(2, 4) sizes(size) WHERE len(p) > size
            )
            GROUP BY ALL
        ),
        kept AS (
            SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score
            FROM lowest LEFT JOIN inside USING (lang, p)
            WHERE longest IS NULL OR CAST(100 AS HUGEINT) * longest < CAST(80 AS HUGEINT) * a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, score
        FROM kept JOIN totals USING (lang)
        QUALIFY rank <= 2000
    """


def oracles() -> dict[str, str]:
    return {
        "op4_exact_dedup": """
            WITH hashed AS (
                SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g'))
                       AS text_sha256
                FROM documents
            ),
            groups AS (
                SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size
                FROM hashed GROUP BY text_sha256
            )
            SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
            FROM hashed JOIN groups USING (text_sha256)
        """,
        "op3_ngram_join": _ngram_join_sql(),
        "op11_clustering": _clustering_sql(),
        "op12_url_filter": _url_filter_sql(),
        "op13_phrases": _phrases_sql(),
    }
