"""The registered queries as SQL for an independent engine over the same tables."""

from postings.plans.oracle_words import ENGLISH, EXTRA, SWEDISH

_ADS = """
    lines AS (
        SELECT l_orderkey, min(l_partkey) AS first_part, sum(l_quantity) AS quantity
        FROM lineitem GROUP BY l_orderkey
    ),
    ads AS (
        SELECT CAST(o_orderkey AS VARCHAR) AS id,
               CAST(o_orderdate AS DATE) AS day,
               trim(split_part(p_name || ', ' || p_brand, ',', 1)) AS job_title,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN n_name END AS municipality,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN r_name END AS region,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(quantity AS INTEGER) END AS vacancies
        FROM orders
        LEFT JOIN lines ON l_orderkey = o_orderkey
        LEFT JOIN part ON p_partkey = first_part
        LEFT JOIN customer ON c_custkey = o_custkey
        LEFT JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN region ON r_regionkey = n_regionkey
    ),
    placed AS (SELECT * FROM ads WHERE municipality IS NOT NULL AND vacancies IS NOT NULL),
    pairs AS (
        SELECT municipality, job_title, count(*) AS n FROM placed
        WHERE job_title IS NOT NULL GROUP BY ALL
    ),
    titles AS (SELECT job_title, count(*) AS n FROM placed WHERE job_title IS NOT NULL GROUP BY ALL),
    tops AS (
        SELECT municipality, job_title FROM pairs
        QUALIFY row_number() OVER (PARTITION BY municipality ORDER BY n DESC, job_title) = 1
    ),
    totals AS (
        SELECT municipality, count(*) AS n, avg(vacancies) AS mean,
               CAST(sum(vacancies) AS BIGINT) AS total
        FROM placed GROUP BY municipality
    )
"""

_SUMMARY = f"""
WITH {_ADS}
SELECT municipality, avg(vacancies) AS avg_number_of_vacancies,
       count(*) AS num_vacancies_per_municipality
FROM ads GROUP BY municipality
"""

_REGIONS = f"WITH {_ADS} SELECT region, count(*) AS num_jobs FROM ads GROUP BY region"

_OVER_TIME = f"""
WITH {_ADS}
SELECT day AS date, count(*) AS num_job_ads, avg(vacancies) AS avg_vacancies FROM ads GROUP BY day
"""

_HEADLINE = "split_part(text, chr(10), 1)"

_CLEAN = "regexp_replace(regexp_replace(lower({}), '<[^>]*>', '', 'g'), '[^\\pL]+', ' ', 'g')"

_JOBS = """
    keyed AS (
        SELECT page_id, 'k' || page_id || '_' || i AS job_key
        FROM pages, (VALUES (0), (1)) AS numbers(i) WHERE i < page_id % 3
    )
    SELECT {columns}
    FROM keyed JOIN pages AS p ON job_key = 'k' || p.page_id || '_0' AND p.page_id % 5 <> 0
"""

_CHARS = "CAST(length(html) AS VARCHAR) AS chars"
_COMPANY = "'{\"number\":' || p.page_id || '}' AS company"
_TITLE = "url AS title"

_OFFSETS = """
    offsets AS (
        SELECT page_id, url, CAST(10 * unnest(range(1, greatest(1,
               CAST(1 + floor((least(page_id, 50) - 1) / 10.0) AS BIGINT)))) AS BIGINT) AS "offset"
        FROM pages
    )
"""


def _fixed_stop_words() -> str:
    words = {*ENGLISH, *SWEDISH, *EXTRA}
    values = ", ".join("('{}')".format(word.lower().replace("'", "''")) for word in sorted(words))
    return f"SELECT * FROM (VALUES {values}) AS fixed(word)"


def _keyword_counts() -> str:
    text = f"concat_ws(' ', {_HEADLINE}, text, lang || ', ' || source, lang)"
    return f"""
    stops AS (
        {_fixed_stop_words()}
        UNION SELECT lower(lang) FROM documents UNION SELECT lower(source) FROM documents
    ),
    words AS (
        SELECT source AS municipality,
               unnest(string_split(trim({_CLEAN.format(text)}), ' ')) AS word
        FROM documents
    ),
    counts AS (
        SELECT municipality, word, count(*) AS n FROM words
        WHERE word <> '' AND word NOT IN (SELECT word FROM stops) GROUP BY ALL
    ),
    ranked AS (
        SELECT municipality, word, n,
               row_number() OVER (PARTITION BY municipality ORDER BY n DESC, word) AS rank
        FROM counts QUALIFY rank <= 10
    ),
    overall AS (
        SELECT word, CAST(sum(n) AS BIGINT) AS n,
               row_number() OVER (ORDER BY sum(n) DESC, word) AS rank
        FROM counts GROUP BY word QUALIFY rank <= 20
    )
    """


def oracles() -> dict[str, str]:
    keyword_counts = _keyword_counts()
    return {
        "vacancies_per_municipality": f"""
            WITH {_ADS}
            SELECT id, job_title,
                   (SELECT string_agg(job_title, ', ' ORDER BY n DESC, job_title)
                    FROM (SELECT * FROM titles ORDER BY n DESC, job_title LIMIT 10)
                   ) AS most_common_job_titles,
                   totals.n AS num_job_ads_per_municipality,
                   tops.job_title AS most_common_job_per_municipality,
                   placed.municipality,
                   totals.mean AS avg_number_of_vacancies,
                   totals.n AS num_vacancies_per_municipality
            FROM placed
            LEFT JOIN totals USING (municipality)
            LEFT JOIN tops USING (municipality)
        """.replace("SELECT id, job_title,", "SELECT id, placed.job_title,"),
        "municipality_stats": f"""
            WITH {_ADS}
            SELECT municipality, tops.job_title AS most_common_job_per_municipality,
                   totals.n AS num_vacancies_per_municipality, totals.total AS total_vacancies
            FROM totals LEFT JOIN tops USING (municipality)
        """,
        "municipality_summary": _SUMMARY,
        "summary_csv_roundtrip": _SUMMARY,
        "job_ads_window_count": f"""
            WITH {_ADS}
            SELECT id, count(*) OVER (PARTITION BY municipality) AS num_job_ads_per_municipality
            FROM placed
        """,
        "top_job_titles": f"""
            WITH {_ADS} SELECT job_title, n AS count FROM titles ORDER BY n DESC, job_title LIMIT 10
        """,
        "top_job_per_municipality": f"WITH {_ADS} SELECT municipality, job_title FROM tops",
        "vacancies_over_time": _OVER_TIME,
        "archive_over_time": _OVER_TIME,
        "events_over_time": """
            SELECT CAST(ts AS DATE) AS date, count(*) AS num_events, round(avg(value), 4) AS avg_value
            FROM events GROUP BY 1
        """,
        "job_ads_per_region": _REGIONS,
        "result_json_roundtrip": _REGIONS,
        "large_array_regions": _REGIONS,
        "array_to_lines_regions": _REGIONS,
        "split_array_regions": _REGIONS,
        "landed_regions": f"""
            WITH {_ADS}
            SELECT region, count(*) AS num_jobs,
                   (SELECT count(*) FROM orders WHERE o_orderkey % 7 = 0) AS n_bad_lines
            FROM ads WHERE CAST(id AS BIGINT) % 7 <> 0 GROUP BY region
        """,
        "landing_counts": """
            SELECT CAST(year(o_orderdate) AS INTEGER) AS yyyy, CAST(month(o_orderdate) AS INTEGER) AS mm, 1 AS dd,
                   count(*) AS n, (SELECT count(*) FROM orders) AS n_lines,
                   (SELECT count(*) FROM orders WHERE o_orderkey % 7 <> 0) AS n_ads,
                   (SELECT count(*) FROM orders WHERE o_orderkey % 7 = 0) AS n_bad_lines
            FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY 1, 2
        """,
        "replaced_day": f"""
            WITH {_ADS}
            SELECT 1995 AS yyyy, CAST(month(day) AS INTEGER) AS mm, 1 AS dd, count(*) AS n,
                   CAST(sum(vacancies) AS BIGINT) AS vacancies
            FROM ads JOIN orders ON o_orderkey = CAST(id AS BIGINT)
            WHERE date_trunc('month', day) = DATE '1995-04-01'
                  OR date_trunc('month', day) = DATE '1995-03-01' AND o_orderpriority = '1-URGENT'
            GROUP BY 2
        """,
        "collection_roundtrip": _REGIONS,
        "overview": f"""
            WITH {_ADS},
            asked AS (SELECT p_type FROM lineitem JOIN part ON l_partkey = p_partkey),
            rows AS (
                SELECT 'day' AS kind, CAST(day AS VARCHAR) AS key, vacancies FROM ads
                UNION ALL SELECT 'municipality', municipality, vacancies FROM ads
                UNION ALL SELECT 'region', region, vacancies FROM ads
                UNION ALL SELECT unnest(['day', 'municipality', 'region']), NULL, NULL FROM asked
                UNION ALL SELECT 'skill', p_type, NULL FROM asked WHERE p_type IS NOT NULL
            )
            SELECT kind, key, count(*) AS n, count(vacancies) AS n_stated, CAST(sum(vacancies) AS BIGINT) AS vacancies
            FROM rows GROUP BY kind, key
        """,
        "line_quality": "SELECT o_orderkey % 7 = 0 AS is_bad, count(*) AS n FROM orders GROUP BY 1",
        "top_skills": """
            SELECT p_type AS skill_label, count(*) AS count
            FROM lineitem JOIN part ON l_partkey = p_partkey
            WHERE p_type IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50
        """,
        "snapshot_manifest": """
            SELECT CAST(year(o_orderdate) AS INTEGER) AS yyyy,
                   CAST(month(o_orderdate) AS INTEGER) AS mm,
                   1 AS dd, count(*) AS n
            FROM orders GROUP BY ALL
        """,
        "stop_words": f"""
            {_fixed_stop_words()}
            UNION SELECT lower(lang) FROM documents WHERE lang <> ''
            UNION SELECT lower(source) FROM documents WHERE source <> ''
        """,
        "place_words_split": f"""
            WITH {_ADS},
            names AS (SELECT region AS place FROM ads UNION SELECT municipality FROM ads)
            SELECT DISTINCT word FROM (
                SELECT unnest(string_split(regexp_replace(lower(place), '[^\\pL]+', ' ', 'g'), ' ')) AS word
                FROM names
            ) WHERE word <> ''
        """,
        "keywords_per_municipality": f"""
            WITH {keyword_counts}
            SELECT municipality, CAST(rank AS INTEGER) AS rank, word, n AS count FROM ranked
        """,
        "keywords_global": f"""
            WITH {keyword_counts}
            SELECT CAST(rank AS INTEGER) AS rank, word, n AS count FROM overall
        """,
        "keywords_report": f"""
            WITH {keyword_counts}
            SELECT municipality,
                   string_agg(word || ':' || n, ', ' ORDER BY rank) AS top_words,
                   string_agg(word, ', ' ORDER BY rank) AS top_10_keywords,
                   (SELECT string_agg(word || ':' || n, ', ' ORDER BY rank) FROM overall) AS top_20_global
            FROM ranked GROUP BY municipality
        """,
        "ad_words": f"""
            WITH stops AS (
                {_fixed_stop_words()}
                UNION SELECT lower(lang) FROM documents UNION SELECT lower(source) FROM documents
            ),
            split AS (
                SELECT doc_id, rtrim(regexp_replace(lower({_HEADLINE} || ' ' || text),
                       '[ \\t\\n\\x0B\\f\\r]', ' ', 'g'), ' ') AS t
                FROM documents
            ),
            numbered AS (
                SELECT doc_id, unnest(string_split(t, ' ')) AS word,
                       generate_subscripts(string_split(t, ' '), 1) AS position
                FROM split
            ),
            kept AS (
                SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY position) AS words
                FROM numbered WHERE word NOT IN (SELECT word FROM stops) GROUP BY doc_id
            )
            SELECT CAST(doc_id AS VARCHAR) AS id, lang || ', ' || source AS job_title,
                   CAST(coalesce(n, 0) AS INTEGER) AS n_words, coalesce(words, '') AS words
            FROM documents LEFT JOIN kept USING (doc_id)
        """,
        "clean_text": f"SELECT page_id, trim({_CLEAN.format('html')}) AS clean_text FROM pages",
        "search_results": """
            SELECT page_id, 'k' || page_id || '_' || i AS job_key, CAST(i AS INTEGER) AS position
            FROM pages, (VALUES (0), (1)) AS numbers(i) WHERE i < page_id % 3
        """,
        "first_search_results": """
            SELECT page_id % 7 AS search,
                   CAST(row_number() OVER (PARTITION BY page_id % 7 ORDER BY page_id, i) AS INTEGER) AS rank,
                   'k' || page_id || '_' || i AS job_key
            FROM pages, (VALUES (0), (1)) AS numbers(i) WHERE i < page_id % 3 QUALIFY rank <= 20
        """,
        "page_offsets": f'WITH {_OFFSETS} SELECT page_id, "offset" FROM offsets',
        "search_addresses": f"""
            WITH {_OFFSETS}
            SELECT page_id, "offset",
                   'https://www.indeed.com/jobs?q=' || replace(url_encode(url), '%20', '+')
                   || '&l=S%C3%B6dra+l%C3%A4net+%2A~&filter=0&start=' || "offset" AS address
            FROM offsets
        """,
        "job_details": "WITH " + _JOBS.format(columns=f"job_key, {_CHARS}, {_COMPANY}, {_TITLE}"),
        "job_detail_rows": "WITH "
        + _JOBS.format(columns=f"job_key, {_CHARS}, {_COMPANY}, {_TITLE}").replace("SELECT job_key, ", ", wide AS (SELECT job_key, ", 1)
        + """)
            SELECT job_key, 'chars' AS name, chars AS value FROM wide
            UNION ALL SELECT job_key, 'company', company FROM wide
            UNION ALL SELECT job_key, 'title', title FROM wide
        """,
        "cluster_ads_checks": """
            SELECT count(*) AS n_ads, CAST(0 AS BIGINT) AS n_lost_or_doubled, CAST(0 AS BIGINT) AS n_outside,
                   CAST(0 AS DOUBLE) AS score_difference, 20 AS n_components,
                   CAST(0 AS BIGINT) AS n_wrong_labels, CAST(0 AS BIGINT) AS n_centres_off
            FROM documents
        """,
        "kept_clusters_checks": """
            SELECT count(DISTINCT concat_ws('-', conv_id, turn)) AS n_ads, CAST(0 AS BIGINT) AS n_lost_or_doubled,
                   CAST(0 AS BIGINT) AS n_differing, CAST(0 AS BIGINT) AS n_outside
            FROM conversations
        """,
        "word_vector_checks": "SELECT count(*) AS n, true AS are_means FROM documents",
        "component_checks": """
            WITH flat AS (
                SELECT vec_id, unnest(range(len(embedding))) AS dim, CAST(unnest(embedding) AS DOUBLE) AS x
                FROM embeddings
            ),
            unit AS (SELECT vec_id, dim, x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)) AS x FROM flat)
            SELECT (SELECT count(*) FROM embeddings) AS n, true AS orthonormal, true AS eigenvectors, true AS shares,
                   true AS reduced, round(sum(v), 6) AS variance
            FROM (SELECT dim, var_samp(x) AS v FROM unit GROUP BY dim)
        """,
        "reduce_vectors_checks": """
            SELECT count(*) AS n_vectors, 20 AS least_components, 20 AS most_components,
                   CAST(0 AS DOUBLE) AS largest_covariance
            FROM embeddings
        """,
        "choose_k_checks": """
            SELECT CAST(range AS INTEGER) AS k, true AS in_range, true AS as_from_sums FROM range(2, 11)
        """,
        "jobs_csv_roundtrip": "WITH " + _JOBS.format(columns=f"{_CHARS}, {_COMPANY}, job_key, {_TITLE}"),
        "normalize_vectors": """
            WITH flat AS (
                SELECT vec_id, unnest(range(len(embedding))) AS dim,
                       CAST(unnest(embedding) AS DOUBLE) AS x
                FROM embeddings
            )
            SELECT vec_id, CAST(dim AS INTEGER) AS dim,
                   round(x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)), 6) + 0.0 AS value
            FROM flat
        """,
        "silhouette_labels": """
            WITH points AS (
                SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x,
                       list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) AS xx
                FROM embeddings
            ),
            flat AS (
                SELECT label, unnest(range(len(x))) AS dim, unnest(x) AS v FROM points
            ),
            sums AS (SELECT label, dim, sum(v) AS s FROM flat GROUP BY ALL),
            groups AS (
                SELECT label AS other, y, n, yy
                FROM (SELECT label, list(s ORDER BY dim) AS y FROM sums GROUP BY label)
                JOIN (SELECT label, count(*) AS n, sum(xx) AS yy FROM points GROUP BY label) USING (label)
            ),
            distances AS (
                SELECT vec_id, label, other, n, xx + yy / n - 2 * list_dot_product(x, y) / n AS d
                FROM points, groups
            ),
            scored AS (
                SELECT vec_id, max(CASE WHEN other = label THEN n END) AS n,
                       max(CASE WHEN other = label THEN d * n / nullif(n - 1, 0) END) AS a,
                       min(CASE WHEN other <> label THEN d END) AS b
                FROM distances GROUP BY vec_id
            )
            SELECT round(avg(CASE WHEN n = 1 THEN 0 WHEN a < b THEN 1 - a / b
                                  WHEN a > b THEN b / a - 1 ELSE 0 END), 6) AS silhouette
            FROM scored
        """,
    }
