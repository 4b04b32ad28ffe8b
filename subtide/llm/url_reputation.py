"""URL filters: rules first, then empirical-Bayes reputation of hosts.

Labelled page outcomes are counted per host, registered domain and suffix. Each level has a beta
prior whose mean is the posterior mean of the level above and whose strength is fitted to the spread
of its groups by moments; so a host with few outcomes has the reputation of its domain, and one with
none is judged by domain, suffix or the whole. A page is blocked if the lower bound of its host's
share of bad pages, `z` posterior standard deviations below the mean, exceeds `most_bad`.

Only DataFrame functions. A null url and one without "://" have an empty host and path; no rule
fits those and their reputation is that of an empty host. Of equally long rules that fit, the last by name
decides, and a rule in both lists blocks. Repeated rows are judged one by one, very long urls like others, and an empty
table gives an empty one. Columns of `pages` other than page_id and url take no part, whatever their names. Outcomes are aggregated before they are shuffled; pages meet their host's
reputation in a join whose large partitions adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtide.llm.store import stored

RULES = 1_000  # at most; more belong in a table

# Public suffixes of two labels.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "co.nz", "com.br", "co.in", "co.za")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def judged(
    pages: DataFrame, allow: list[str], block: list[str], outcomes: DataFrame | None = None, z: float = 2.0, most_bad: float = 0.5
) -> DataFrame:
    """(page_id, host, path, rule, verdict, bad_bound) per row of `pages` (page_id, url).

    `outcomes` (url, bad 0 or 1) are labelled pages; by default those of `pages` that a rule decides.
    """
    if len(allow) + len(block) > RULES:
        raise ValueError(f"more than {RULES} rules")
    rows = parsed(pages.select("page_id", F.col("url").cast("string").alias("url"))).withColumn("rule", longest_rule(allow + block))
    ruled = F.when(F.col("rule").isin(*block) if block else F.lit(False), "block").when(F.col("rule").isNotNull(), "allow")
    rows = rows.withColumn("ruled", ruled)
    if outcomes is None:
        told = rows.where("ruled IS NOT NULL").select("host", F.expr("IF(ruled = 'block', 1, 0)").alias("bad"))
    else:
        told = parsed(outcomes.select(F.col("url").cast("string").alias("url"), F.col("bad").cast("int").alias("bad"))).where("bad IS NOT NULL").select("host", "bad")
    hosts = rows.groupBy("host").agg(F.lit(0).alias("n"), F.lit(0).alias("bad")).unionByName(
        told.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
    )
    bounds = reputation(hosts, z)
    verdict = F.coalesce("ruled", F.expr(f"IF(bad_bound > {most_bad}, 'block', 'allow')"))
    return rows.join(bounds, "host").select("page_id", "host", "path", "rule", verdict.alias("verdict"), "bad_bound")


def parsed(pages: DataFrame) -> DataFrame:
    """Adds host and path, drops url."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": host, "path": path}).drop("url")


def longest_rule(rules: list[str]) -> Column:
    """The longest rule (host/path) whose host is the page's or above it and whose path its path begins with."""
    found = F.lit(None).cast("string")
    for rule in sorted(set(rules), key=lambda r: (len(r), r)):
        host, slash, path = rule.partition("/")
        own = (F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))
        found = F.when(own & F.startswith(F.col("path"), F.lit(slash + path)), rule).otherwise(found)
    return found


def reputation(hosts: DataFrame, z: float) -> DataFrame:
    """(host, bad_bound) per host of `hosts` (host, n, bad), whose rows are summed."""
    name = F.regexp_replace(F.regexp_replace("host", "^[^@]*@", ""), ":[0-9]*$", "")
    labels = F.split("name", "\\.")
    two = F.array_join(F.slice("labels", -2, 2), ".")
    depth = F.when((F.size("labels") > 1) & two.isin(*TWO_LABEL_SUFFIXES), 2).otherwise(1)
    sums = (
        hosts.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        .withColumn("name", name).withColumn("labels", labels).withColumn("depth", depth)
        .withColumn("suffix", F.expr("array_join(slice(labels, -least(depth, size(labels)), depth), '.')"))
        .withColumn("domain", F.expr("array_join(slice(labels, -least(depth + 1, size(labels)), depth + 1), '.')"))
        .select("host", "domain", "suffix", "n", "bad")
    )
    sums = stored(sums)
    domains = stored(sums.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    suffixes = stored(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    n, bad = suffixes.agg(F.sum("n"), F.sum("bad")).first()
    whole = F.lit((bad + 0.5) / (n + 1.0) if n else 0.5)

    suffixes = _shrunk(suffixes.withColumn("above", whole))
    domains = _shrunk(domains.join(suffixes.select("suffix", F.col("mean").alias("above")), "suffix"))
    shrunk = _shrunk(sums.join(domains.select("domain", "suffix", F.col("mean").alias("above")), ["domain", "suffix"]))
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("strength") + 1))
    return shrunk.select("host", F.greatest(F.col("mean") - z * spread, F.lit(0.0)).alias("bad_bound"))


def _shrunk(groups: DataFrame) -> DataFrame:
    """Adds the posterior mean of each group (n, bad) under a beta prior with mean `above`.

    Moments: the groups' excess of squared deviations over binomial noise, relative to m(1 - m), is
    1 / (strength + 1). The strength is kept from 1 to 1000.
    """
    groups = stored(groups)
    scale, excess = groups.where("n > 1").agg(
        F.sum(F.expr("(n - 1) * above * (1 - above)")), F.sum(F.expr("n * pow(bad / n - above, 2) - above * (1 - above)"))
    ).first()
    share = round(excess / scale, 9) if scale else 0.0
    strength = min(1000.0, max(1.0, 1 / share - 1)) if share > 0 else 1000.0
    strength = F.lit(float(round(strength, 6)))
    return groups.withColumn("strength", strength).withColumn("mean", (F.col("bad") + strength * F.col("above")) / (F.col("n") + strength))
