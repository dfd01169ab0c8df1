"""URL functions: host, host match, canonical form and dated paths; all native."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
#: Query parameters that only track a visit.
TRACKING = ("fbclid", "gclid")


def host(url: Column) -> Column:
    """The host name of an http(s) URL, lower case, without user, port and a leading "www."; else null."""
    scheme, place = F.lower(F.regexp_extract(url, _PARTS, 1)), F.regexp_extract(url, _PARTS, 2)
    name = F.regexp_extract(F.regexp_replace(place, "^.*@", ""), r"^(\[[^\]]*\]|[^:]*)", 1)
    name = F.lower(F.regexp_replace(name, r"[\[\]]", ""))
    return F.when(scheme.isin("http", "https") & (name != ""), F.regexp_replace(name, r"^www\.", ""))


def path(url: Column) -> Column:
    return F.regexp_extract(url, _PARTS, 3)


def canonical_url(url: Column) -> Column:
    """https, host, path without trailing slashes, sorted query without tracking parameters, no fragment; null if invalid."""
    pairs = F.filter(F.split(F.regexp_extract(url, _PARTS, 4), "&"), lambda x: x != "")

    def decoded(part: Column) -> Column:
        return F.coalesce(F.try_url_decode(part), part)

    def pair(x: Column) -> Column:
        cut = F.instr(x, "=")
        value = F.when(cut > 0, F.substr(x, cut + 1)).otherwise("")
        return F.struct(decoded(F.substring_index(x, "=", 1)).alias("k"), decoded(value).alias("v"))

    def encoded(x: Column) -> Column:
        return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))

    known = F.filter(F.transform(pairs, pair), lambda p: ~F.lower(p["k"]).startswith("utm_") & ~F.lower(p["k"]).isin(*TRACKING))
    query = F.array_join(F.transform(F.array_sort(known), lambda p: F.concat(encoded(p["k"]), F.lit("="), encoded(p["v"]))), "&")
    bare = F.regexp_replace(path(url), "/+$", "")
    bare = F.when(bare == "", F.lit("/")).otherwise(bare)
    return F.concat(F.lit("https://"), host(url), bare, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def host_matches(actual: Column, expected: Column | str) -> Column:
    """The host is the expected one or lies below it."""
    expected = F.lit(expected) if isinstance(expected, str) else expected
    return (actual == expected) | F.endswith(actual, F.concat(F.lit("."), expected))


def first_matching_host(actual: Column, expected: Sequence[str]) -> Column:
    """The first host of an ordered list (a policy, so a literal) that matches; null if none does."""
    listed = F.array(*[F.lit(x) for x in expected])
    return F.try_element_at(F.filter(listed, lambda e: host_matches(actual, e)), F.lit(1))


def mapped_host(source: Column, hosts: Mapping[str, str]) -> Column:
    if not hosts:
        return F.lit(None).cast("string")
    return F.create_map(*[F.lit(x) for pair in hosts.items() for x in pair])[source]


def dated_path(url: Column) -> Column:
    """struct(found, date) of a /yyyy/mm/dd/ path; date is null when no such day exists."""
    pattern = r"/(\d{4})/(\d{2})/(\d{2})/"
    found = path(url).rlike(pattern)
    written = F.concat_ws("-", *[F.regexp_extract(path(url), pattern, i) for i in (1, 2, 3)])
    return F.struct(found.alias("found"), F.when(found, written.try_cast("date")).alias("date"))
