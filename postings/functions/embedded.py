"""Records that web pages carry as JSON inside a script, and the addresses of such pages."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where the records stand in a search page and in a job page, and the addresses.
# (?d) lets "." stop at "\n" only.
SEARCH_PATTERN = r'(?d)window.mosaic.providerData\["mosaic-provider-jobcards"\]=(\{.+?\});'
JOB_PATTERN = r"(?d)_initialData=(\{.+?\});"
SEARCH_ADDRESS = "https://www.indeed.com/jobs?"
JOB_ADDRESS = "https://www.indeed.com/m/basecamp/viewjob?viewtype=embedded&jk="
PAGE_SIZE = 10
MAX_RESULTS = 50

_SEARCH_SCHEMA = (
    "metaData struct<mosaicProviderJobCardsModel struct<"
    "results: array<string>, tierSummaries: array<struct<jobCount: bigint>>>>"
)
_JOB_SCHEMA = "jobInfoWrapperModel struct<jobInfoModel: map<string, string>>"


def search_record(html: Column) -> Column:
    """``struct<results array<string>, tierSummaries>`` of the first match; null without one.

    A result is free-form, so each is kept as its JSON text.
    """
    parsed = F.from_json(F.regexp_extract(html, SEARCH_PATTERN, 1), _SEARCH_SCHEMA)
    return parsed["metaData"]["mosaicProviderJobCardsModel"]


def job_record(html: Column) -> Column:
    """Fields of the job as a map, nested values as JSON text; null if there is none."""
    parsed = F.from_json(F.regexp_extract(html, JOB_PATTERN, 1), _JOB_SCHEMA)
    return parsed["jobInfoWrapperModel"]["jobInfoModel"]


def job_key(result: Column) -> Column:
    return F.get_json_object(result, "$.jobKey")


def total_results(tiers: Column, max_results: int = MAX_RESULTS) -> Column:
    """Sum of the job counts of all tiers, at most ``max_results``."""
    total = F.aggregate(
        tiers, F.lit(0).cast("bigint"), lambda sum_, t: sum_ + F.coalesce(t["jobCount"], F.lit(0))
    )
    return F.least(total, F.lit(max_results))


def further_offsets(total: Column) -> Column:
    """Offsets of the pages after the first: 10, 20, ... as far as the total reaches."""
    # Counting from 0 and leaving it out, as sequence(1, 0) would count down.
    pages = F.greatest(F.floor((total - 1) / PAGE_SIZE), F.lit(0))
    numbers = F.filter(F.sequence(F.lit(0).cast("bigint"), pages), lambda i: i > 0)
    return F.transform(numbers, lambda i: i * PAGE_SIZE)


def search_address(query: Column, location: Column, offset: Column) -> Column:
    return F.concat(
        F.lit(SEARCH_ADDRESS + "q="),
        _form_encoded(query),
        F.lit("&l="),
        _form_encoded(location),
        F.lit("&filter=0&start="),
        offset.cast("string"),
    )


def job_address(key: Column) -> Column:
    return F.concat(F.lit(JOB_ADDRESS), key)


def job_key_of(address: Column) -> Column:
    """The job key a job page was asked for with; null if the address has none."""
    return F.try_url_decode(F.try_parse_url(address, F.lit("QUERY"), F.lit("jk")))


def _form_encoded(text: Column) -> Column:
    # Unlike Java, form encoding here escapes "*" and keeps "~".
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
