"""URL filter by a temporal list join: dated list entries become validity intervals, and an as-of join evaluates every capture
against the entries active at its fetch time.

Only built-in functions are used. An entry is keyed by host (it also covers subdomains) and may narrow to a path prefix. The
intervals of one host and prefix are in order, up to SPANS of them in a row, which knows when they begin and end: as many rows
as rules, whatever the times of entries and captures. A capture asks for its host and each parent domain, and there for the
beginnings of its path that are as long as a prefix of that domain; an equi-join on domain and prefix finds the rule, and the
row that holds the capture's time says whether it was active. So a hot host meets its own rules only, and of those one row
each. The list is broadcast if its counted size allows, else the joins' keys are salted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm.common import join_small, stash

#: Intervals that a row of a rule holds.
SPANS = 64
#: The end of intervals that nothing closes.
OPEN_END = "9999-12-31 00:00:00"
#: The host of a URL, after scheme and user and before the port; an IPv6 address keeps its brackets.
_AUTHORITY = r"^(?i:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)"


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without user, port and trailing dot; null where there is none."""
    host = F.lower(F.regexp_replace(F.regexp_extract(url, _AUTHORITY, 1), r"\.+$", ""))
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    """Path of a URL, from its first slash, without query and fragment; `/` where it is empty."""
    rest = F.regexp_replace(url, r"^(?i:[a-z][a-z0-9+.-]*:)?//[^/?#]*", "")
    path = F.regexp_replace(rest, r"[?#].*$", "")
    return F.when(path == "", F.lit("/")).otherwise(path)


def domains_of(host: Column) -> Column:
    """The host and its parent domains, down to the last label; an IP address has no parents."""
    labels = F.split(host, r"\.")
    return F.when(host.rlike(r"^(\[.*\]|[0-9]+(\.[0-9]+){3})$"), F.array(host)).otherwise(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(rule, domain, prefix, valid_from, valid_to): from entries (domain, prefix, action, listed_at). An `add` holds from its time until the next entry of the same domain and prefix; `remove` ends it. Entries at the same time: `remove` wins. Null domains and actions, and times that are null or no times, are left out; a null prefix is `/`."""
    clean = entries.where("domain IS NOT NULL AND action IN ('add', 'remove')").select(F.lower("domain").alias("domain"), F.coalesce("prefix", F.lit("/")).alias("prefix"), "action", F.col("listed_at").try_cast("timestamp").alias("valid_from")).where("valid_from IS NOT NULL")
    one = clean.groupBy("domain", "prefix", "valid_from").agg(F.max("action").alias("action"))
    after = Window.partitionBy("domain", "prefix").orderBy("valid_from")
    ends = one.withColumn("valid_to", F.coalesce(F.lead("valid_from").over(after), F.lit(OPEN_END).cast("timestamp")))
    return ends.where("action = 'add'").select(F.concat("domain", "prefix").alias("rule"), "domain", "prefix", "valid_from", "valid_to")


def rules_of(entries: DataFrame) -> DataFrame:
    """(domain, prefix, rule, first, last, spans array<struct<a, b>>): the intervals of each rule by time, SPANS to a row; first and last bound those of the row."""
    by = Window.partitionBy("domain", "prefix").orderBy("valid_from")
    numbered = validity_intervals(entries).withColumn("part", F.floor((F.row_number().over(by) - 1) / SPANS))
    spans = F.array_sort(F.collect_list(F.struct(F.col("valid_from").alias("a"), F.col("valid_to").alias("b"))))
    return numbered.groupBy("domain", "prefix", "rule", "part").agg(F.min("valid_from").alias("first"), F.max("valid_to").alias("last"), spans.alias("spans")).drop("part")


def filter_urls(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """Each capture with the rules active for it when it was fetched: id, host, fetched_at, blocked, n_rules, first_rule.

    A rule applies if its domain is the capture's host or a parent domain of it, its prefix starts the path, and valid_from <=
    fetched_at < valid_to. first_rule is the smallest of them by code point. Captures without URL or host, or whose
    time is none, are not blocked. One row per input row, repeated ids included; other columns are ignored; an empty list blocks nothing. Times may
    lie however far apart.
    """
    at = F.col(time_col).try_cast("timestamp")
    rows = captures.select(F.col(f"`{id_col}`").alias("_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("_path"), at.alias("fetched_at"))
    rules = stash(rules_of(entries).withColumnRenamed("domain", "_domain"), "rules")
    lengths = stash(rules.groupBy("_domain").agg(F.collect_set(F.length("prefix")).alias("lengths")), "prefix-lengths")
    asked = stash(rows.withColumn("_row", F.monotonically_increasing_id()), "captures")
    keys = asked.where("host IS NOT NULL AND fetched_at IS NOT NULL").select("_row", "_path", "fetched_at", F.explode(domains_of(F.col("host"))).alias("_domain"))
    known = join_small(keys, lengths, ["_domain"], F.col("_row"), how="inner")
    begun = F.explode(F.filter("lengths", lambda n: n <= F.length("_path"))).alias("_n")
    wanted = known.select("_row", "_path", "fetched_at", "_domain", begun).withColumn("prefix", F.substring(F.col("_path"), F.lit(1), F.col("_n")))
    met = join_small(wanted.drop("_path", "_n"), rules, ["_domain", "prefix"], F.col("_row"), how="inner")
    t = F.col("fetched_at")
    hit = met.where((F.col("first") <= t) & (t < F.col("last")) & F.exists("spans", lambda s: (s["a"] <= t) & (t < s["b"])))
    found = hit.groupBy("_row").agg(F.count("*").alias("n_rules"), F.min("rule").alias("first_rule"))
    out = asked.join(found, "_row", "left")
    return out.select(F.col("_id").alias(id_col), "host", "fetched_at", F.col("n_rules").isNotNull().alias("blocked"), F.coalesce("n_rules", F.lit(0)).cast("bigint").alias("n_rules"), "first_rule")
