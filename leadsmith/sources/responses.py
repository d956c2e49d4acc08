"""Scans of landed service responses.

A response lands as one JSON line: the request's ``key``, the ``status`` and
the ``body`` as it came. Bodies are read with declared nested schemas, so no
inference pass runs and columns are pruned; results keep their place in the
response as ``rank``. Nothing is lost on the way: an unreadable line, a
failed request and a body that does not fit its schema become dead letters
with an ``error`` and the raw text, in the same pass as the good rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE = "key string, status int, body string, _line string"


@dataclass(frozen=True)
class Response:
    """``body``: DDL of the JSON object; ``results``: path of its list (one
    object is a list of one); ``fields``: output column -> path in a result.
    ``listed``: the body itself is the list, read as ``results``."""

    body: str
    results: str
    fields: tuple[tuple[str, str], ...]
    listed: bool = False


# The names that the services give their fields.
RESPONSES = {
    "organizations": Response(
        "organizations array<struct<id:string,name:string,primary_domain:string>>", "organizations",
        (("org_id", "id"), ("name", "name"), ("domain", "primary_domain"))),
    "people": Response(
        "people array<struct<id:string,first_name:string,last_name:string,title:string,email:string>>", "people",
        (("id", "id"), ("first_name", "first_name"), ("last_name", "last_name"), ("title", "title"), ("email", "email"))),
    "match": Response("person struct<email:string>", "person", (("email", "email"),)),
    "contacts": Response(
        "data struct<emails:array<struct<value:string,first_name:string,last_name:string,position:string,confidence:int>>>", "data.emails",
        (("first_name", "first_name"), ("last_name", "last_name"), ("position", "position"), ("value", "value"), ("confidence", "confidence"))),
    "suggest": Response("results array<struct<name:string,domain:string>>", "results", (("name", "name"), ("domain", "domain")), listed=True),
    "search": Response("results array<struct<href:string,url:string,title:string>>", "results",
                       (("href", "href"), ("url", "url"), ("title", "title")), listed=True),
    "channels": Response(
        "items array<struct<id:string,statistics:struct<subscriberCount:string,viewCount:string>,"
        "contentDetails:struct<relatedPlaylists:struct<uploads:string>>>>", "items",
        (("channel_id", "id"), ("subscriberCount", "statistics.subscriberCount"), ("viewCount", "statistics.viewCount"),
         ("uploads", "contentDetails.relatedPlaylists.uploads"))),
    "playlist": Response(
        "items array<struct<contentDetails:struct<videoId:string,videoPublishedAt:string>>>", "items",
        (("video_id", "contentDetails.videoId"), ("published_at", "contentDetails.videoPublishedAt"))),
    "videos": Response(
        "items array<struct<id:string,statistics:struct<viewCount:string,likeCount:string,commentCount:string>>>", "items",
        (("video_id", "id"), ("viewCount", "statistics.viewCount"), ("likeCount", "statistics.likeCount"),
         ("commentCount", "statistics.commentCount"))),
}


def landed(spark: SparkSession, path: str) -> DataFrame:
    """(key, status, body, _line) of landed lines; ``_line`` is the text of an
    unreadable one, else NULL."""
    return (spark.read.schema(ENVELOPE).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").json(path))


def results(lines: DataFrame, kind: Response | str) -> DataFrame:
    """(key, rank, fields..., error, raw) of ``landed`` lines.

    One row a result, ``error`` NULL; a response without results (an empty
    list, a missing or null one) has no rows, as a lookup then finds nothing.
    One row a dead letter, with ``rank`` and fields NULL: ``unreadable
    line``, ``no key``, ``status <n>`` (anything but 200) or ``body does not
    fit``. Repeated responses all count.
    """
    r = RESPONSES[kind] if isinstance(kind, str) else kind
    body = F.concat(F.lit('{"results":'), "body", F.lit("}")) if r.listed else F.col("body")
    parsed = lines.withColumn("_b", F.from_json(body, f"{r.body}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    fits = F.col("_b").isNotNull() & F.col("_b._bad").isNull()
    if r.listed:  # '[], "x": 1' would read as an object once it is wrapped
        fits = fits & F.col("body").rlike(r"^\s*(\[[\s\S]*\]|null)\s*$")
    error = (F.when(F.col("_line").isNotNull(), F.lit("unreadable line")).when(F.col("key").isNull(), F.lit("no key"))
             .when(~F.coalesce(F.col("status") == 200, F.lit(False)), F.concat(F.lit("status "), F.coalesce(F.col("status").cast("string"), F.lit("unknown"))))
             .when(~fits, F.lit("body does not fit")))
    found = F.col(f"_b.{r.results}")
    if "array<" not in r.body:
        found = F.when(found.isNotNull(), F.array(found))
    tagged = parsed.select("key", error.alias("error"), F.coalesce("_line", "body").alias("raw"), found.alias("_found"))
    one = tagged.select("key", "error", F.when(F.col("error").isNotNull(), F.col("raw")).alias("raw"),
                        F.posexplode_outer(F.when(F.col("error").isNull(), F.col("_found"))).alias("rank", "_r"))
    one = one.where(F.col("rank").isNotNull() | F.col("error").isNotNull())
    return one.select("key", "rank", *[F.col(f"_r.{path}").alias(name) for name, path in r.fields], "error", "raw")


def scan(spark: SparkSession, path: str, kind: Response | str) -> tuple[DataFrame, DataFrame]:
    """(good rows, dead letters) of the responses landed under ``path``."""
    found = results(landed(spark, path), kind)
    return (found.where(F.col("error").isNull()).drop("error", "raw"),
            found.where(F.col("error").isNotNull()).select("key", "error", "raw"))
