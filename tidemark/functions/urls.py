"""URL expressions. Regular expressions are used because `try_parse_url` is null on blanks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: query parameters that only track the visitor -----------------
TRACKING = r"(?i)^(utm_|ref$|ref_|fbclid$|gclid$|mc_|igshid$|spm$|from$|share)"

# RFC 3986, appendix B, one pattern a part so that each runs once: host without user info and port, path without end
# slashes, query.
_HOST = r"^(?:[^:/?#]+:)?//(?:[^/?#]*@)?([^/?#]*?)(?::\d*)?(?:[/?#][\s\S]*)?\z"
_PATH = r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*?)/*(?:[?#][\s\S]*)?\z"
_QUERY = r"^[^?#]*\?([^#]*)"


def domain_of(url: Column) -> Column:
    """Lower-case host without user info, port and a leading `www.`."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.trim(url), _HOST, 1)), r"^www\.", "")


def _path_of(url: Column) -> Column:
    return F.regexp_extract(F.trim(url), _PATH, 1)


def _query_of(url: Column) -> Column:
    return F.regexp_extract(F.trim(url), _QUERY, 1)


def _encode(text: Column) -> Column:
    # url_encode leaves * and escapes ~; form encoding wants it the other way round.
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _decode(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), text)


def _kept_query(query: Column) -> Column:
    """The sorted query without tracking or empty parameters."""
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda p: p.rlike("^[^=]*=.+")),
        lambda p: F.struct(
            _decode(F.regexp_extract(p, "^([^=]*)=", 1)).alias("k"),
            _decode(F.regexp_extract(p, r"^[^=]*=([\s\S]*)$", 1)).alias("v"),
        ),
    )
    kept = F.array_sort(F.filter(pairs, lambda p: ~p["k"].rlike(TRACKING)))
    return F.array_join(F.transform(kept, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&")


def canonical_url(url: Column) -> Column:
    """https, bare host, sorted query without tracking or empty parameters, no fragment or end slash."""
    query = _kept_query(_query_of(url))
    path = _path_of(url)
    return F.concat(
        F.lit("https://"),
        domain_of(url),
        F.when(path == "", F.lit("/")).otherwise(path),
        F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)),
    )


def with_canonical_url(df: DataFrame, url: Column, out: str) -> DataFrame:
    """Add `canonical_url(url)` as `out`. Each part of the address is a column before it is used, so every pattern runs once a
    row; in one expression the parts, and whatever `url` is made of, are worked out again wherever they occur."""
    host, path, raw, query = "__host", "__path", "__raw", "__query"
    parts = df.withColumn("__url", F.trim(url)).withColumns({
        host: domain_of(F.col("__url")), path: _path_of(F.col("__url")), raw: _query_of(F.col("__url")),
    })
    asked = parts.withColumn(query, F.when(F.col(raw) == "", F.lit("")).otherwise(_kept_query(F.col(raw))))
    whole = F.concat(
        F.lit("https://"), F.col(host), F.when(F.col(path) == "", F.lit("/")).otherwise(F.col(path)),
        F.when(F.col(query) == "", F.lit("")).otherwise(F.concat(F.lit("?"), F.col(query))),
    )
    return asked.withColumn(out, whole).drop("__url", host, path, raw, query)


def url_id(url: Column) -> Column:
    """Twelve hex digits that identify the canonical URL."""
    return F.substring(F.sha1(canonical_url(url)), 1, 12)


def with_known_domain(df: DataFrame, url: str, domains: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add `known_name`, `known_tier` of the longest known suffix of the URL's host (null if none).

    `domains` (domain -> name, tier) is configuration and becomes a literal map, so nothing is joined or shuffled."""
    if not domains:
        return df.withColumns({"known_name": F.lit(None).cast("string"), "known_tier": F.lit(None).cast("string")})
    pairs = [(F.lit(d.removeprefix("www.")), F.struct(F.lit(n).alias("name"), F.lit(t).alias("tier"))) for d, (n, t) in domains.items()]
    known = F.create_map(*[c for pair in pairs for c in pair])
    labels = F.split(domain_of(F.col(url)), r"\.")
    longest_first = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    hits = F.filter(F.transform(longest_first, lambda s: F.try_element_at(known, s)), lambda k: k.isNotNull())
    found = df.withColumn("__known", F.when(F.size(labels) > 1, F.get(hits, F.lit(0))))
    return found.withColumns({"known_name": F.col("__known.name"), "known_tier": F.col("__known.tier")}).drop("__known")
