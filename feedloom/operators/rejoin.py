"""Results of a model put back to their items when it altered the addresses it echoes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import chain
from feedloom.params import NO_LINK
from feedloom.storage import materialize

#: Parameters that only tell where a reader came from.
TRACKING = r"^(?:utm_[^=]*|fbclid|gclid|dclid|msclkid|mc_cid|mc_eid|igshid|ref|ref_src|source)(?:=|$)"
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[wW]{3}\.)?"
_HOST = r"^[^/?]*"


def canonical(url: Column) -> Column:
    """The address without scheme, ``www.``, fragment, tracking parameters and final slashes, the host in lower case, parameters in order."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), _SCHEME, "")

    def parts(address: Column) -> Column:
        host = F.regexp_extract(address, _HOST, 0)
        rest = F.substring(address, F.length(host) + 1, F.length(address))
        path = F.regexp_replace(F.regexp_replace(rest, r"\?.*$", ""), "/+$", "")
        given = F.when(F.contains(rest, F.lit("?")), F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&")).otherwise(F.array().cast("array<string>"))
        kept = F.sort_array(F.filter(given, lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
        return F.concat(F.lower(host), path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))

    return chain(bare, parts)


def _variants(urls: DataFrame, name: str, run: Sequence[str]) -> DataFrame:
    """Hashes of the lower-cased canonical address and of it with any one character left out.

    Two addresses are one edit apart, or equal, only if they share one of these.
    """
    key = F.lower(canonical(F.col(name)))
    less = lambda k: F.transform(F.sequence(F.lit(0), F.length(k)), lambda i: F.xxhash64(F.when(i == 0, k).otherwise(
        F.concat(F.substring(k, F.lit(1), i - 1), F.substring(k, i + 1, F.length(k))))))
    keyed = urls.select(*run, name, canonical(F.col(name)).alias(f"_{name}"), key.alias(f"_{name}_key"))
    return keyed.withColumn("_variant", F.explode(F.array_distinct(less(F.col(f"_{name}_key")))))


def url_mapping(results: DataFrame, items: DataFrame, run: Sequence[str] = ()) -> DataFrame:
    """run, url, link: to which item's link each echoed url belongs, one to one.

    Equal addresses first. What is left of both sides is paired when the canonical forms agree, then when they agree in lower
    case, then when these are one inserted, lost or wrong character apart and agree in all digits, since a number names
    another item. Of several pairs the closest wins, equal ones by address; no link gets two urls, no url two links.
    Urls that belong to no item are left out, as are further spellings of an address that was found exactly. Each distinct address is looked at once, however often it repeats,
    and pairs meet by hashes of the address with one character left out, never all with all.
    """
    run = list(run)
    urls = results.select(*run, "url").filter("url <> ''").distinct()
    links = items.select(*run, "link").filter((F.col("link") != "") & (F.col("link") != NO_LINK)).distinct()
    same = links.select(*run, F.col("link").alias("url"), "link")
    exact = materialize(urls.join(same, [*run, "url"]).select(*run, "url", "link"), "exact")
    # Another spelling of an address that was found already is no address of another item.
    taken = exact.select(*run, F.lower(canonical(F.col("link"))).alias("_key")).distinct()
    left = urls.join(exact, [*run, "url"], "left_anti").withColumn("_key", F.lower(canonical(F.col("url"))))
    rest = left.join(taken, [*run, "_key"], "left_anti").drop("_key")
    free = links.join(exact, [*run, "link"], "left_anti")
    met = _variants(rest, "url", run).join(_variants(free, "link", run), [*run, "_variant"]).drop("_variant").distinct()
    digits = lambda c: F.regexp_replace(c, "[^0-9]", "")
    near = (F.levenshtein("_url_key", "_link_key") <= 1) & (digits(F.col("_url_key")) == digits(F.col("_link_key")))
    cost = F.when(F.col("_url") == F.col("_link"), 1).when(F.col("_url_key") == F.col("_link_key"), 2).when(near, 3)
    pairs = materialize(met.select(*run, "url", "link", cost.alias("cost")).filter("cost IS NOT NULL"), "url-pairs")
    chosen = exact
    while not pairs.isEmpty():
        # A pair that is the best of both its sides is settled; at least the closest pair of all is.
        by_url = pairs.groupBy(*run, "url").agg(F.min(F.struct("cost", "link"))["link"].alias("link"))
        by_link = pairs.groupBy(*run, "link").agg(F.min(F.struct("cost", "url"))["url"].alias("url"))
        settled = materialize(by_url.join(by_link, [*run, "url", "link"]).select(*run, "url", "link"), "settled")
        chosen = chosen.unionByName(settled)
        pairs = materialize(pairs.join(settled.select(*run, "url"), [*run, "url"], "left_anti").join(settled.select(*run, "link"), [*run, "link"], "left_anti"), "url-pairs")
    return chosen


def url_rejoin(results: DataFrame, items: DataFrame, run: Sequence[str] = ()) -> DataFrame:
    """The results with the item's own link as ``url``; one that belongs to no item keeps what the model wrote."""
    mapping = url_mapping(results, items, run).select(*run, "url", F.col("link").alias("_link"))
    joined = results.join(mapping, [*run, "url"], "left")
    return joined.select(*[F.coalesce("_link", "url").alias("url") if c == "url" else F.col(f"`{c}`") for c in results.columns])
