"""Queries over the test tables, one or more per analysis."""

import datetime
from collections.abc import Callable

import numpy as np
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import PCA, Word2VecModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postings.functions import embedded
from postings.functions.stopwords import place_words, stop_words
from postings.functions.text import clean
from postings.operators import cluster_checks, clusters, keywords, pages, regions, skills, trends, vacancies
from postings.operators.cluster_model import ClusterModel, fit_clusters, load_clusters
from postings.operators.overview import overview_counts
from postings.plans.daily import land
from postings.schema import ad_columns
from postings.shared import new_path, settle, shared_folder
from postings.sources import sinks, snapshots
from postings.sources.arrays import read_split_array
from postings.sources.collections import CollectionSource, read_collection
from postings.sources.tables import document_ads, line_ads, order_ads, table

Query = Callable[[SparkSession, str], DataFrame]

#: How far a centre may be from the mean of its ads: k-means ends when no centre moves far.
CENTRE_ERROR = 0.01

#: Ads of a JSON array that is read whole, about.
ARRAY_ADS = 10_000


def _list_text(entries: str) -> F.Column:
    """An array of (word, count) as text, which both engines can compare."""
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["word"], F.lit(":"), e["count"].cast("string"))), ", "
    )


# Orders as ads.


def vacancies_per_municipality(spark: SparkSession, folder: str) -> DataFrame:
    # The ads are read twice; settled, the joins that make them are not.
    ads = settle(order_ads(spark, folder, title=True, place=True, vacancies=True), "order-ads")
    return vacancies.vacancies_per_municipality(ads)


def municipality_stats(spark: SparkSession, folder: str) -> DataFrame:
    return vacancies.municipality_stats(_title_counts(spark, folder))


def municipality_summary(spark: SparkSession, folder: str) -> DataFrame:
    return vacancies.municipality_summary(order_ads(spark, folder, place=True, vacancies=True))


def job_ads_window_count(spark: SparkSession, folder: str) -> DataFrame:
    return vacancies.job_ads_window_count(order_ads(spark, folder, place=True, vacancies=True))


def top_job_titles(spark: SparkSession, folder: str) -> DataFrame:
    return vacancies.top_job_titles(_title_counts(spark, folder))


def top_job_per_municipality(spark: SparkSession, folder: str) -> DataFrame:
    return vacancies.top_job_per_municipality(_title_counts(spark, folder))


def _title_counts(spark: SparkSession, folder: str) -> DataFrame:
    ads = order_ads(spark, folder, title=True, place=True, vacancies=True)
    return vacancies.title_counts(vacancies.placed_ads(ads))


def vacancies_over_time(spark: SparkSession, folder: str) -> DataFrame:
    return trends.vacancies_over_time(order_ads(spark, folder, vacancies=True))


def events_over_time(spark: SparkSession, folder: str) -> DataFrame:
    per_day = trends.per_day(table(spark, folder, "events"), "ts", "value", "num_events", "mean")
    return per_day.select("date", "num_events", F.round("mean", 4).alias("avg_value"))


def job_ads_per_region(spark: SparkSession, folder: str) -> DataFrame:
    return regions.job_ads_per_region(order_ads(spark, folder, place=True))


def top_skills(spark: SparkSession, folder: str) -> DataFrame:
    return skills.top_skills(line_ads(spark, folder))


def summary_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    summary = municipality_summary(spark, folder)
    path = new_path(spark, "summary-csv")
    order = [F.desc("num_vacancies_per_municipality"), "municipality"]
    sinks.save_csv(summary, path, order)
    return spark.read.schema(summary.schema).option("header", True).option("escape", '"').csv(path)


def result_json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    result = job_ads_per_region(spark, folder)
    target = new_path(spark, "results")
    sinks.save_result(result, "job_ads_per_region", target, fmt="json")
    return spark.read.schema(result.schema).json(f"{target}/job_ads_per_region")


def snapshot_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.manifest(_archived_orders(spark, folder))


def archive_over_time(spark: SparkSession, folder: str) -> DataFrame:
    return trends.vacancies_over_time(_archived_orders(spark, folder))


def _archived_orders(spark: SparkSession, folder: str) -> DataFrame:
    """All orders, archived as one snapshot per month of publication."""
    root = new_path(spark, "archive")
    ads = order_ads(spark, folder, vacancies=True)
    snapshots.write_archive(ads, root, _month(), fmt="parquet")
    return snapshots.read_archive(spark, root, fmt="parquet")


def _month() -> F.Column:
    return F.trunc(F.to_date("publication_date"), "month").cast("date")


def large_array_regions(spark: SparkSession, folder: str) -> DataFrame:
    """Ads per region, of ads written as the comma-separated records of JSON arrays."""
    path = new_path(spark, "array")
    ads = order_ads(spark, folder, place=True)
    ads.select(F.to_json(F.struct("*"))).write.option("lineSep", ",\n").text(path)
    return regions.job_ads_per_region(snapshots.read_large_array(spark, path))


def array_to_lines_regions(spark: SparkSession, folder: str) -> DataFrame:
    """Ads per region, of ads written as JSON arrays, read whole, written as lines and read back."""
    arrays, lines = new_path(spark, "whole-arrays"), new_path(spark, "lines")
    _write_arrays(order_ads(spark, folder, place=True), F.struct("*"), arrays)
    snapshots.read_array(spark, arrays).write.json(lines)
    return regions.job_ads_per_region(snapshots.read_lines(spark, lines))


def _write_arrays(ads: DataFrame, record: F.Column, path: str) -> None:
    """JSON arrays of ``record``, one a file. Their number grows with the ads, so that each stays small
    enough for a task that reads it whole."""
    ads = settle(ads, "array-ads")
    parts = max(1, -(-ads.count() // ARRAY_ADS))
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts))
    listed = ads.groupBy(part.alias("part")).agg(F.collect_list(F.to_json(record)).alias("ads"))
    # All on one line, with blanks around every comma.
    text = F.concat(F.lit(" [ "), F.array_join("ads", " , "), F.lit(" ]"))
    listed.select(text).write.option("maxRecordsPerFile", 1).text(path)


def split_array_regions(spark: SparkSession, folder: str) -> DataFrame:
    """Ads per region, of JSON arrays whose records begin with different keys and hold brackets in strings."""
    path = new_path(spark, "mixed-arrays")
    ads = order_ads(spark, folder, place=True)
    odd = F.concat(F.lit('}], {"id": "\\'), F.repeat(F.lit("{\""), (F.col("id") % 5).cast("int")))
    even = F.col("id") % 2 == 0
    record = F.struct(
        F.when(even, odd).alias("note"),
        F.when(~even, odd).alias("headline"),
        "workplace_address",
        "publication_date",
        F.col("id"),
    )
    _write_arrays(ads, record, path)
    return regions.job_ads_per_region(read_split_array(spark, path))


def landed_regions(spark: SparkSession, folder: str) -> DataFrame:
    """Ads per region, of landed lines of which every seventh is cut short and set apart."""
    path, archive = new_path(spark, "cut-lines"), new_path(spark, "landed")
    _write_lines(order_ads(spark, folder, place=True), path)
    landed = land(spark, path, archive, datetime.date(2025, 9, 29))
    counted = regions.job_ads_per_region(landed.ads)
    return counted.withColumn("n_bad_lines", F.lit(landed.n_bad_lines).cast("long"))


def landing_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Ads of every month, with all, good and bad lines as observed while they were landed by month."""
    path, archive = new_path(spark, "cut-lines"), new_path(spark, "landed")
    _write_lines(order_ads(spark, folder, vacancies=True), path)
    landed = land(spark, path, archive, _month())
    return snapshots.manifest(landed.ads).select(
        "*",
        F.lit(landed.n_ads + landed.n_bad_lines).cast("long").alias("n_lines"),
        F.lit(landed.n_ads).cast("long").alias("n_ads"),
        F.lit(landed.n_bad_lines).cast("long").alias("n_bad_lines"),
    )


def replaced_day(spark: SparkSession, folder: str) -> DataFrame:
    """Two days of an archive by month, after the first was landed again with only its ads of urgent orders."""
    root = new_path(spark, "replaced")
    ads = order_ads(spark, folder, vacancies=True)
    snapshots.write_archive(ads, root, _month(), fmt="parquet")
    again, other = datetime.date(1995, 3, 1), datetime.date(1995, 4, 1)
    urgent = table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'")
    fewer = ads.where(_month() == F.lit(again)).join(urgent, F.col("id") == F.col("o_orderkey"), "left_semi")
    snapshots.write_archive(fewer, root, again, fmt="parquet")
    archive = snapshots.read_archive(spark, root, fmt="parquet")
    days = snapshots.on_day(archive, again).unionByName(snapshots.on_day(archive, other))
    return days.groupBy(*snapshots.DAY_COLUMNS).agg(
        F.count("*").alias("n"), F.sum("number_of_vacancies").alias("vacancies")
    )


def collection_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Every ad as a document of a collection that held only some before; read back per region."""
    target = new_path(spark, "collections")
    ads = order_ads(spark, folder, place=True)
    for documents in (ads.where("workplace_address.region is null"), ads):
        sinks.save_result(documents, "ads", target, fmt=CollectionSource.name(), database="postings")
    return regions.job_ads_per_region(read_collection(spark, target, "postings", "ads", ads.schema))


def overview(spark: SparkSession, folder: str) -> DataFrame:
    """Ads and openings per day, municipality, region and skill from one pass over orders and order lines."""
    ads = order_ads(spark, folder, place=True, vacancies=True).unionByName(line_ads(spark, folder))
    return overview_counts(ads)


def line_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Good and bad lines, of ads written as JSON lines with every seventh cut short."""
    path = new_path(spark, "lines")
    _write_lines(order_ads(spark, folder), path)
    parsed = snapshots.parsed_lines(spark, path)
    return parsed.groupBy("is_bad").agg(F.count("*").alias("n"))


def _write_lines(ads: DataFrame, path: str) -> None:
    line = F.to_json(F.struct("*"))
    cut = F.when(F.col("id").cast("long") % 7 == 0, F.rtrim(line, F.lit("}"))).otherwise(line)
    ads.select(cut).write.text(path)


# Documents as ads.


def stop_words_query(spark: SparkSession, folder: str) -> DataFrame:
    return stop_words(document_ads(spark, folder))


def place_words_split(spark: SparkSession, folder: str) -> DataFrame:
    return place_words(order_ads(spark, folder, place=True), split_places=True)


def keywords_per_municipality(spark: SparkSession, folder: str) -> DataFrame:
    return keywords.keywords_per_municipality(keywords.word_counts(document_ads(spark, folder)))


def keywords_global(spark: SparkSession, folder: str) -> DataFrame:
    return keywords.keywords_global(
        keywords.word_counts(document_ads(spark, folder), by_place=False)
    )


def keywords_report(spark: SparkSession, folder: str) -> DataFrame:
    report = keywords.keywords_report(document_ads(spark, folder))
    return report.select(
        "municipality",
        _list_text("top_words").alias("top_words"),
        "top_10_keywords",
        _list_text("top_20_global").alias("top_20_global"),
    )


def ad_words(spark: SparkSession, folder: str) -> DataFrame:
    words = clusters.ad_words(document_ads(spark, folder))
    return words.select(
        "id", "job_title", F.size("words").alias("n_words"), F.array_join("words", " ").alias("words")
    )


_kept_clusters: dict[tuple[str, str], str] = {}


def _clusters_path(spark: SparkSession, folder: str) -> str:
    """The model fitted on the documents, once in an application: the queries of clusters read what was saved."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _kept_clusters:
        path = f"{shared_folder(spark).rstrip('/')}/postings-models/{key[0]}/{len(_kept_clusters)}"
        fit_clusters(document_ads(spark, folder), path)
        _kept_clusters[key] = path
    return _kept_clusters[key]


def _clusters(spark: SparkSession, folder: str) -> ClusterModel:
    return load_clusters(spark, _clusters_path(spark, folder))


def cluster_ads(spark: SparkSession, folder: str) -> DataFrame:
    return _clusters(spark, folder).assign(document_ads(spark, folder), with_score=True)


def cluster_ads_checks(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of the clusters of the documents, whatever the vectors are: every label is that of the
    nearest of the model's centres, and a centre is the mean of its ads."""
    k = 6
    ads = document_ads(spark, folder)
    model = _clusters(spark, folder)
    centres = model.stage(KMeansModel).clusterCenters()
    predicted = settle(model.transform(ads).select("id", "pcaFeatures", "prediction"), "clusters")
    found = predicted.select(
        "id", F.col("prediction").alias("label"), vector_to_array("pcaFeatures").alias("x")
    )
    lost = _lost_or_doubled(ads, found)
    outside = F.count_if(~F.col("label").between(0, k - 1))
    own, evaluated = _silhouette(found), clusters.silhouette(predicted)
    return found.agg(
        F.count("*").alias("n_ads"),
        F.lit(lost).cast("long").alias("n_lost_or_doubled"),
        outside.alias("n_outside"),
        F.abs(F.round(F.lit(evaluated - own), 6)).alias("score_difference"),
        F.max(F.size("x")).alias("n_components"),
        F.lit(cluster_checks.wrong_labels(predicted, centres)).cast("long").alias("n_wrong_labels"),
        F.lit(sum(e > CENTRE_ERROR for e in cluster_checks.centre_errors(predicted, centres)))
        .cast("long")
        .alias("n_centres_off"),
    )


def _lost_or_doubled(ads: DataFrame, found: DataFrame) -> int:
    given = ads.select("id").groupBy("id").agg(F.count("*").alias("given"))
    rows = found.groupBy("id").agg(F.count("*").alias("rows"))
    return given.join(rows, "id", "full").where("not (given <=> rows)").count()


def kept_clusters_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The documents' model applied to the conversations, as a later day, without a fit: every turn once, and
    no label that a second model loaded from the same folder gives differently."""
    turns = table(spark, folder, "conversations")
    number = F.concat_ws("-", "conv_id", "turn")
    # Turns may repeat: one ad for each number, with all that was said.
    said = turns.groupBy(number.alias("number")).agg(F.min("role").alias("role"), F.max("text").alias("text"))
    ads = settle(said.select(*ad_columns(id=F.col("number"), text=F.col("text"), label=F.col("role"))), "later-day")
    one = settle(_clusters(spark, folder).assign(ads), "assigned")
    other = _clusters(spark, folder).assign(ads).select("id", F.col("clusterNumber").alias("again"))
    compared = one.join(other, "id")
    return compared.agg(
        F.count("*").alias("n_ads"),
        F.lit(_lost_or_doubled(ads, one)).cast("long").alias("n_lost_or_doubled"),
        F.count_if(~F.col("clusterNumber").eqNullSafe(F.col("again"))).alias("n_differing"),
        F.count_if(~F.col("clusterNumber").between(0, 5)).alias("n_outside"),
    )


def word_vector_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The documents' vectors are the means of their words' vectors, words without one counted."""
    model = _clusters(spark, folder)
    word2vec = model.stage(Word2VecModel)
    found = cluster_checks.document_vector_error(
        model.transform(document_ads(spark, folder)), word2vec, words=word2vec.getInputCol()
    )
    return found.select("n", (F.col("error") < 1e-9).alias("are_means"))


def _silhouette(points: DataFrame) -> float:
    """The mean silhouette of ``id, label, x`` worked out from sums per cluster and dimension."""
    square = F.aggregate("x", F.lit(0.0), lambda total, v: total + v * v)
    points = settle(points.withColumn("xx", square), "points")
    sums = (
        points.select("label", F.posexplode("x").alias("dim", "v"))
        .groupBy("label", "dim")
        .agg(F.sum("v").alias("s"))
        .groupBy("label")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("dim", "s"))), lambda e: e["s"]).alias("y"))
    )
    sizes = points.groupBy("label").agg(F.count("*").alias("n"), F.sum("xx").alias("yy"))
    # As many rows as clusters; a list of them on every point, not a join of everything.
    listed = [
        F.struct(
            F.lit(row["label"]).alias("other"),
            F.array(*map(F.lit, row["y"])).alias("y"),
            F.lit(row["n"]).alias("n"),
            F.lit(row["yy"]).alias("yy"),
        )
        for row in sums.join(sizes, "label").collect()
    ]
    dot = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda total, v: total + v)
    distances = points.select("*", F.inline(F.array(*listed))).withColumn(
        "d", F.col("xx") + F.col("yy") / F.col("n") - 2 * dot / F.col("n")
    )
    own = F.col("other") == F.col("label")
    by_point = distances.groupBy("id").agg(
        F.max(F.when(own, F.col("n"))).alias("n"),
        F.max(F.when(own, F.col("d") * F.col("n") / F.nullif(F.col("n") - 1, F.lit(0)))).alias("a"),
        F.min(F.when(~own, F.col("d"))).alias("b"),
    )
    a, b = F.col("a"), F.col("b")
    value = F.when(F.col("n") == 1, 0.0).when(a < b, 1 - a / b).when(a > b, b / a - 1).otherwise(0.0)
    return by_point.agg(F.avg(value)).first()[0]


# Pages.


def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select(
        "page_id", clean(F.col("html")).alias("clean_text")
    )


def _search_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages with search data added: ``page_id % 3`` results, a job count of ``page_id`` in two tiers."""
    numbers = F.filter(F.array(F.lit(0), F.lit(1)), lambda i: i < F.col("page_id") % 3)
    key = lambda i: F.format_string("k%d_%d", "page_id", i)
    half = F.floor(F.col("page_id") / 2)
    cards = F.struct(
        F.transform(numbers, lambda i: F.struct(key(i).alias("jobKey"), F.col("url").alias("link"))).alias(
            "results"
        ),
        F.array(
            F.struct(half.alias("jobCount")),
            F.struct((F.col("page_id") - half).alias("jobCount")),
        ).alias("tierSummaries"),
    )
    data = F.to_json(F.struct(F.struct(cards.alias("mosaicProviderJobCardsModel")).alias("metaData")))
    return table(spark, folder, "pages").select(
        "page_id",
        "url",
        F.concat(
            "html",
            F.lit('<script>window.mosaic.providerData["mosaic-provider-jobcards"]='),
            data,
            F.lit(";</script>"),
        ).alias("html"),
    )


def _job_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as job pages of the key ``k<page_id>_0``, without a job on every fifth."""
    job = F.struct(
        F.col("url").alias("title"),
        F.length("html").alias("chars"),
        F.struct(F.col("page_id").alias("number")).alias("company"),
    )
    data = F.to_json(F.struct(F.struct(job.alias("jobInfoModel")).alias("jobInfoWrapperModel")))
    none = F.lit('{"jobInfoWrapperModel":{"jobInfoModel":{}}}')
    return table(spark, folder, "pages").select(
        "page_id",
        embedded.job_address(F.format_string("k%d_0", "page_id")).alias("url"),
        F.concat(
            "html",
            F.lit("<script>window._initialData="),
            F.when(F.col("page_id") % 5 == 0, none).otherwise(data),
            F.lit(";</script>"),
        ).alias("html"),
    )


def search_results(spark: SparkSession, folder: str) -> DataFrame:
    results = pages.search_results(_search_pages(spark, folder))
    return results.select("page_id", "job_key", "position")


def first_search_results(spark: SparkSession, folder: str) -> DataFrame:
    searched = _search_pages(spark, folder).withColumn("search", F.col("page_id") % 7)
    results = pages.search_results(searched, keep=("search", "page_id"))
    return pages.first_results(results, ["search"], max_results=20).select("search", "rank", "job_key")


def page_offsets(spark: SparkSession, folder: str) -> DataFrame:
    return pages.page_offsets(_search_pages(spark, folder))


def search_addresses(spark: SparkSession, folder: str) -> DataFrame:
    offsets = pages.page_offsets(_search_pages(spark, folder), keep=("page_id", "url"))
    address = embedded.search_address(F.col("url"), F.lit("Södra länet *~"), F.col("offset"))
    return offsets.select("page_id", "offset", address.alias("address"))


def job_details(spark: SparkSession, folder: str) -> DataFrame:
    names = ["chars", "company", "title"]
    return pages.detail_columns(_jobs(spark, folder).select("job_key", "detail"), names, keep=["job_key"])


def job_detail_rows(spark: SparkSession, folder: str) -> DataFrame:
    return pages.detail_rows(_jobs(spark, folder))


def jobs_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    jobs = job_details(spark, folder)
    path = new_path(spark, "jobs-csv")
    sinks.save_sorted_csv(jobs, path)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in sorted(jobs.columns)])
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def _jobs(spark: SparkSession, folder: str) -> DataFrame:
    results = pages.search_results(_search_pages(spark, folder))
    return pages.results_with_details(results, pages.job_details(_job_pages(spark, folder)))


# Vectors.


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        "vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )


def normalize_vectors(spark: SparkSession, folder: str) -> DataFrame:
    unit = clusters.normalized(_vectors(spark, folder))
    values = unit.select("vec_id", F.posexplode(vector_to_array("normFeatures")).alias("dim", "value"))
    return values.select("vec_id", "dim", (F.round("value", 6) + 0.0).alias("value"))


def reduce_vectors(spark: SparkSession, folder: str) -> DataFrame:
    reduced = clusters.reduced(clusters.normalized(_vectors(spark, folder)))
    return reduced.select("vec_id", vector_to_array("pcaFeatures").alias("components"))


def reduce_vectors_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Number and width of the reduced vectors, and their largest covariance between two components."""
    reduced = settle(reduce_vectors(spark, folder), "reduced")
    values = reduced.select("vec_id", F.posexplode("components").alias("i", "x"))
    other = values.select("vec_id", F.col("i").alias("j"), F.col("x").alias("y"))
    pairs = values.join(other, "vec_id").where("i < j").groupBy("i", "j")
    covariance = pairs.agg(F.covar_pop("x", "y").alias("c")).agg(F.max(F.abs("c"))).first()[0]
    return reduced.agg(
        F.count("*").alias("n_vectors"),
        F.min(F.size("components")).alias("least_components"),
        F.max(F.size("components")).alias("most_components"),
        F.round(F.lit(covariance), 6).alias("largest_covariance"),
    )


def component_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The loadings are unit vectors at right angles, eigenvectors of the covariance with the largest
    eigenvalues, and the reduced vectors vary by just these along each."""
    unit = settle(clusters.normalized(_vectors(spark, folder)).select("vec_id", "normFeatures"), "unit")
    model = PCA(k=20, inputCol="normFeatures", outputCol="pcaFeatures").fit(unit)
    loadings, shares = model.pc.toArray(), model.explainedVariance.toArray()
    errors = cluster_checks.component_errors(cluster_checks.moments(unit, "normFeatures"), loadings, shares)
    reduced = cluster_checks.moments(clusters.reduced(unit), "pcaFeatures")
    apart = np.abs(reduced.covariance - np.diag(shares * errors.variance)).max() / errors.variance
    rows = [(reduced.n, *(bool(e < 1e-6) for e in (errors.orthonormal, errors.eigen, errors.share, apart)), round(errors.variance, 6))]
    return spark.createDataFrame(
        rows, "n long, orthonormal boolean, eigenvectors boolean, shares boolean, reduced boolean, variance double"
    )


def choose_k_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Each number of clusters has the score that sums per cluster give, in [-1, 1]."""
    scores = cluster_checks.score_differences(_vectors(spark, folder), range(2, 11), "features")
    rows = [(k, -1 <= score <= 1, difference < 1e-6) for k, score, difference in scores]
    return spark.createDataFrame(rows, "k int, in_range boolean, as_from_sums boolean")


def silhouette_labels(spark: SparkSession, folder: str) -> DataFrame:
    score = clusters.silhouette(_vectors(spark, folder), column="features", label="label")
    return spark.range(1).select(F.round(F.lit(score), 6).alias("silhouette"))


def choose_k(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.choose_k(_vectors(spark, folder), column="features")


QUERIES: dict[str, Query] = {
    "vacancies_per_municipality": vacancies_per_municipality,
    "municipality_stats": municipality_stats,
    "municipality_summary": municipality_summary,
    "job_ads_window_count": job_ads_window_count,
    "top_job_titles": top_job_titles,
    "top_job_per_municipality": top_job_per_municipality,
    "vacancies_over_time": vacancies_over_time,
    "events_over_time": events_over_time,
    "job_ads_per_region": job_ads_per_region,
    "top_skills": top_skills,
    "summary_csv_roundtrip": summary_csv_roundtrip,
    "result_json_roundtrip": result_json_roundtrip,
    "snapshot_manifest": snapshot_manifest,
    "archive_over_time": archive_over_time,
    "large_array_regions": large_array_regions,
    "array_to_lines_regions": array_to_lines_regions,
    "split_array_regions": split_array_regions,
    "landed_regions": landed_regions,
    "landing_counts": landing_counts,
    "replaced_day": replaced_day,
    "collection_roundtrip": collection_roundtrip,
    "overview": overview,
    "line_quality": line_quality,
    "stop_words": stop_words_query,
    "place_words_split": place_words_split,
    "keywords_per_municipality": keywords_per_municipality,
    "keywords_global": keywords_global,
    "keywords_report": keywords_report,
    "ad_words": ad_words,
    "cluster_ads": cluster_ads,
    "cluster_ads_checks": cluster_ads_checks,
    "kept_clusters_checks": kept_clusters_checks,
    "word_vector_checks": word_vector_checks,
    "clean_text": clean_text,
    "search_results": search_results,
    "first_search_results": first_search_results,
    "page_offsets": page_offsets,
    "search_addresses": search_addresses,
    "job_details": job_details,
    "job_detail_rows": job_detail_rows,
    "jobs_csv_roundtrip": jobs_csv_roundtrip,
    "normalize_vectors": normalize_vectors,
    "reduce_vectors": reduce_vectors,
    "reduce_vectors_checks": reduce_vectors_checks,
    "component_checks": component_checks,
    "silhouette_labels": silhouette_labels,
    "choose_k": choose_k,
    "choose_k_checks": choose_k_checks,
}
