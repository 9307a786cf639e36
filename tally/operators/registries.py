"""Registration dates of domains by way of a bootstrap of services."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions import text as X
from tally.functions.numbers import let


def rdap_domain(x) -> Column:
    """The registrable domain that a service is asked for; empty if the text isn't one."""
    return let(X.domain(x), lambda name: F.when(name == "", "").otherwise(X.registrable(name)))


def services(bootstrap: DataFrame, document: str) -> DataFrame:
    """(suffix, urls) of bootstrap documents, JSON objects with services: [[suffixes], [addresses]].

    What isn't a pair of lists is passed over; of a suffix named twice the first counts; empty addresses don't.  A document without
    services gives no rows.
    """
    pairs = F.from_json(F.get_json_object(document, "$.services"), "array<string>")
    rows = bootstrap.select(F.posexplode(pairs).alias("_place", "_pair"))
    lists = F.from_json("_pair", "array<string>")
    rows = rows.select("_place", lists.alias("_lists")).where("size(_lists) = 2")
    names, urls = (F.from_json(F.get("_lists", F.lit(i)), "array<string>") for i in (0, 1))
    rows = rows.select("_place", F.explode(names).alias("suffix"), F.filter(F.transform(urls, lambda u: F.trim(u)), lambda u: u != "").alias("urls")).where("urls IS NOT NULL")
    rows = rows.withColumn("suffix", F.lower(F.regexp_replace("suffix", r"^\.+", "")))
    return rows.groupBy("suffix").agg(F.min_by("urls", "_place").alias("urls"))


def questions(domains: DataFrame, name: str, known: DataFrame) -> DataFrame:
    """(domain, place, url) of each distinct registrable domain of a column: the addresses of its longest known suffix, in their order.

    domain is empty for what isn't one; place and url are null where no service is known.  Suffixes are exploded (a domain has few) and
    equi-joined with the services, so the bootstrap may be of any size.
    """
    one = domains.select(rdap_domain(name).alias("domain")).distinct()
    labels = F.split("domain", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    each = one.where("domain <> ''").select("domain", F.explode(ends).alias("_end")).join(known, F.col("_end") == F.col("suffix"))
    best = each.groupBy("domain").agg(F.max_by("urls", F.length("_end")).alias("_urls"))
    url = F.concat(F.regexp_replace("_url", "/+$", ""), F.lit("/domain/"), F.col("domain"))
    return one.join(best, "domain", "left").select("domain", F.posexplode_outer("_urls").alias("place", "_url")).select("domain", "place", F.when(F.col("_url").isNotNull(), url).alias("url"))


def resolved(asked: DataFrame, answers: DataFrame, created: Column) -> DataFrame:
    """(domain, status, created_at, error) from the questions and what the services said: url, code, payload, error; one row an address.

    Addresses are tried in their order.  404 ends the search (no_data); one that failed, or wasn't answered, passes it on to the next; the
    first good answer counts: done with its date (`created`, an expression over payload), no_data without one.  Failures: invalid_domain,
    rdap_service_not_found:<domain>, rdap_query_failed:<last error>.
    """
    both = asked.join(answers.withColumnRenamed("url", "_url"), F.col("url") == F.col("_url"), "left")
    ends = F.col("code").between(200, 299) | (F.col("code") == 404)
    first = F.min_by(F.struct("code", created.alias("at")), F.when(ends, F.col("place")))
    error = F.coalesce(F.col("error"), F.concat(F.lit("RDAP HTTP "), F.col("code").cast("string")), F.lit("not answered"))
    last = F.max_by(F.substring(error, 1, 300), "place")
    got = both.groupBy("domain").agg(F.max("place").alias("_n"), F.when(F.count_if(ends) > 0, first).alias("_first"), last.alias("_last"))
    at, code = F.when(F.col("_first.code") != 404, F.col("_first.at")), F.col("_first.code")
    status = F.when(F.col("_first").isNull(), "failed").when(at.isNotNull(), "done").otherwise("no_data")
    failed = F.when(F.col("domain") == "", "invalid_domain").when(F.col("_n").isNull(), F.concat(F.lit("rdap_service_not_found:"), F.col("domain"))).otherwise(F.concat(F.lit("rdap_query_failed:"), F.col("_last")))
    said = F.when(F.col("_first").isNull(), failed).when(code == 404, "rdap_http_404").when(at.isNull(), "created_at_not_found")
    return got.select("domain", status.alias("status"), at.alias("created_at"), said.alias("error"))
