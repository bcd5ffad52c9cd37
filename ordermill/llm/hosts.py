"""URL filter: path rules first, then an empirical-Bayes reputation of the host.

``rated`` takes labelled outcomes (url, bad) and gives every host in them a beta-binomial posterior
of its share of bad pages. Priors are nested: all pages, public suffix, registered domain, host. The mean
of a level's prior is the posterior mean of the level above; its strength (pseudo-pages) is fitted by
the method of moments over all groups of that level, between ``WEAKEST`` and ``STRONGEST``. A host
without outcomes takes the posterior of its domain, else of its suffix, else of all pages.
A page is blocked if the lower bound of the posterior (mean less ``BOUND`` standard deviations) is above
``LIMIT``.

Null urls and urls without ``://`` have empty host and path, fit no rule and are allowed. Outcomes with a null
label or no host are not counted; repeated rows count each. Without outcomes everything is left to the
rules. Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LIMIT, BOUND = 0.5, 1.645
WEAKEST, STRONGEST = 1.0, 1000.0
#: Suffixes of two labels below which names are registered; any other suffix is the last label.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "com.br", "co.jp", "co.nz", "co.in", "com.cn")


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """Registered domain: the suffix and one label more."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def rule_for(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """Longest rule, written ``host/path``, that fits; null if none does."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(f"/{rest}"))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _strength(groups: DataFrame, mean: str) -> Column:
    """Pseudo-pages of the prior, from how much the groups' shares vary beyond chance."""
    p = F.col(mean)
    spread = p * (1 - p)
    chance = F.sum(spread)
    excess = F.sum(F.pow(F.col("bad") - F.col("n") * p, 2) - F.col("n") * spread)
    pairs = F.sum(F.col("n") * (F.col("n") - 1) * spread)
    # Within-group correlation r: the variance of a group's count is n p q (1 + (n - 1) r).
    r = F.when((chance > 0) & (pairs > 0), excess / pairs).otherwise(F.lit(0.0))
    return F.when(r > 0, F.least(F.greatest(1 / r - 1, F.lit(WEAKEST)), F.lit(STRONGEST))).otherwise(
        F.lit(STRONGEST)
    )


def _level(groups: DataFrame, mean: str, strength: str, name: str) -> DataFrame:
    """Posterior mean of each group under a prior with the mean of the level above."""
    fitted = groups.agg(_strength(groups, mean).alias(strength))
    return groups.crossJoin(F.broadcast(fitted)).withColumn(
        name, (F.col("bad") + F.col(mean) * F.col(strength)) / (F.col("n") + F.col(strength))
    )


def outcomes(labelled: DataFrame) -> DataFrame:
    """Pages and bad pages per host of rows (url, bad)."""
    return (
        labelled.select(host_of(F.col("url")).alias("host"), F.col("bad").cast("int").alias("bad"))
        .where((F.col("host") != "") & F.col("bad").isNotNull())
        .groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    )


def rated(labelled: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Posteriors of hosts, registered domains, suffixes and all pages, one table each.

    The columns are key, mean and mass (the two parameters of the beta distribution are mean * mass and
    (1 - mean) * mass).
    """
    host = outcomes(labelled).withColumn("suffix", suffix_of(F.col("host"))).withColumn("domain", domain_of(F.col("host")))
    domain = host.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffix = domain.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    # One row: all pages, with a uniform prior.
    world = suffix.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).select(
        ((F.coalesce("bad", F.lit(0)) + 1) / (F.coalesce("n", F.lit(0)) + 2)).alias("m0"),
        (F.coalesce("n", F.lit(0)) + 2).cast("double").alias("mass0"),
    )
    s = _level(suffix.crossJoin(F.broadcast(world.select("m0"))), "m0", "k1", "m1")
    d = _level(domain.join(s.select("suffix", "m1"), "suffix"), "m1", "k2", "m2")
    h = _level(host.join(d.select("suffix", "domain", "m2"), ["suffix", "domain"]), "m2", "k3", "m3")
    return (
        h.select("host", F.col("m3").alias("mean"), (F.col("n") + F.col("k3")).alias("mass")),
        d.select("domain", F.col("m2").alias("mean"), (F.col("n") + F.col("k2")).alias("mass")),
        s.select("suffix", F.col("m1").alias("mean"), (F.col("n") + F.col("k1")).alias("mass")),
        world.select(F.col("m0").alias("mean"), F.col("mass0").alias("mass")),
    )


def lower_bound(mean: Column, mass: Column) -> Column:
    return mean - BOUND * F.sqrt(mean * (1 - mean) / (mass + 1))


def judge(pages: DataFrame, labelled: DataFrame, rules: dict[str, str]) -> DataFrame:
    """page_id, host, path, rule, verdict, and the posterior (mean, mass, bound) that stands behind it."""
    hosts, domains, suffixes, world = rated(labelled)
    seen = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    # One posterior per host of the pages, looked up before it is joined to the pages themselves.
    known = (
        seen.select("host").distinct()
        .withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
        .join(hosts.select("host", F.struct("mean", "mass").alias("by_host")), "host", "left")
        .join(domains.select("domain", F.struct("mean", "mass").alias("by_domain")), "domain", "left")
        .join(suffixes.select("suffix", F.struct("mean", "mass").alias("by_suffix")), "suffix", "left")
        .crossJoin(F.broadcast(world.select(F.struct("mean", "mass").alias("by_all"))))
        .select("host", F.coalesce("by_host", "by_domain", "by_suffix", "by_all").alias("posterior"))
    )
    rule = rule_for(F.col("host"), F.col("path"), rules)
    by_rule = F.lit(None).cast("string")
    for name, verdict in rules.items():
        by_rule = F.when(F.col("rule") == name, F.lit(verdict)).otherwise(by_rule)
    by_method = F.when((F.col("host") != "") & (F.col("bound") > LIMIT), F.lit("block")).otherwise(F.lit("allow"))
    return (
        seen.withColumn("rule", rule)
        .join(known, "host", "left")
        .withColumn("bound", lower_bound(F.col("posterior.mean"), F.col("posterior.mass")))
        .select(
            "page_id", "host", "path", "rule", F.coalesce(by_rule, by_method).alias("verdict"),
            F.col("posterior.mean").alias("mean"), F.col("posterior.mass").alias("mass"), "bound",
        )
    )
