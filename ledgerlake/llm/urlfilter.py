"""URL filter: listed rules first, else the host's reputation.

Reputation is the share of bad pages among a host's labelled pages, shrunk by
beta-binomial priors: the suffix's prior comes from all labels, the registered
domain's from its suffix, the host's from its domain.  The strength of each
level's prior is estimated from the spread of the shares at that level (moment
estimate, the empirical part).  A host without labelled pages has the prior of
its domain, or of its suffix, or that of all labels, the first there is.  A page
is blocked when the lower bound of its host's share exceeds a threshold.

DataFrame functions only; every table that is joined has one row per host,
domain or suffix, joins on hot hosts are left to be split at run time, and
labels are summed before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

# (verdict, host, path prefix) of the listed rules.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
BLOCK_ABOVE = 0.5     # posterior share of bad pages
BOUND_SD = 1.645      # one-sided 95 %
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1000.0   # pseudo-pages of a prior


def url_host(url: str = "url") -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower
    case; empty for null and for urls without ``://``."""
    raw = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: str = "url") -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def registered_domain(host: Column) -> Column:
    """The last two labels (the host itself if it has fewer)."""
    return F.substring_index(host, ".", -2)


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule whose host is the url's host
    or a parent of it and whose path starts the url's path; null if none."""
    fits = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        cond = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        hit = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        fits = F.when(cond, hit) if fits is None else fits.when(cond, hit)
    return fits if fits is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _level(shares: DataFrame, key: str, parent: str) -> DataFrame:
    """Strength of the prior below each ``parent``: method of moments over the
    shares of its members, s = m(1-m)/var - 1 within fixed bounds."""
    p = F.col("bad") / F.col("n")
    t = shares.groupBy(parent).agg(F.sum(F.col("n") * p).alias("sp"), F.sum("n").alias("sn"),
                                   F.sum(F.col("n") * p * p).alias("spp"), F.count(key).alias("k"))
    m = F.col("sp") / F.col("sn")
    var = F.greatest(F.col("spp") / F.col("sn") - m * m, F.lit(0.0))
    s = F.when((F.col("k") < 2) | (var <= 0) | (m <= 0) | (m >= 1), F.lit(MAX_STRENGTH)).otherwise(m * (1 - m) / var - 1)
    return t.select(parent, F.least(F.greatest(s, F.lit(MIN_STRENGTH)), F.lit(MAX_STRENGTH)).alias("s"))


def _mean() -> Column:
    return F.col("a") / (F.col("a") + F.col("b"))


def _bound() -> Column:
    """Lower bound of a beta share with the parameters ``a`` and ``b``."""
    size = F.col("a") + F.col("b")
    sd = F.sqrt(F.col("a") * F.col("b") / (size * size * (size + 1)))
    return F.greatest(_mean() - BOUND_SD * sd, F.lit(0.0))


def _reputation(outcomes: DataFrame, host: str, bad: str) -> tuple[DataFrame, ...]:
    """Posterior (n, bad, a, b) of every labelled host, and the priors (a, b)
    below every labelled domain, suffix and the root."""
    one = F.coalesce(F.col(host), F.lit(""))
    hosts = (outcomes.where(F.col(bad).isNotNull())
             .groupBy(one.alias("host")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(bad).cast("long")).alias("bad"))
             .withColumn("domain", registered_domain(F.col("host"))).withColumn("sfx", suffix(F.col("host")))
             .withColumn("root", F.lit(0)))
    hosts = written(hosts, "url-hosts")         # a row per labelled host, read by every level
    domains = hosts.groupBy("domain", "sfx", "root").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("sfx", "root").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = suffixes.groupBy("root").agg((F.sum("bad") / F.sum("n")).alias("m"))

    def prior(rows: DataFrame, key: str, parent: str, means: DataFrame) -> DataFrame:
        return means.join(_level(rows, key, parent), parent).select(
            parent, (F.col("s") * F.col("m")).alias("a"), (F.col("s") * (1 - F.col("m"))).alias("b"))

    def shrink(rows: DataFrame, parent: str, below: DataFrame) -> DataFrame:
        return rows.join(below, parent).withColumns(
            {"a": F.col("bad") + F.col("a"), "b": F.col("n") - F.col("bad") + F.col("b")})

    of_root = prior(suffixes, "sfx", "root", total)
    of_sfx = prior(domains, "domain", "sfx", shrink(suffixes, "root", of_root).select("sfx", _mean().alias("m")))
    of_dom = prior(hosts, "host", "domain", shrink(domains, "sfx", of_sfx).select("domain", _mean().alias("m")))
    return shrink(hosts, "domain", of_dom), of_dom, of_sfx, of_root


def host_reputation(outcomes: DataFrame, host: str = "host", bad: str = "bad") -> DataFrame:
    """(host, n, bad, mean, bound): posterior mean and lower bound of the share
    of bad pages for every host with a labelled page.

    ``outcomes`` has a row per labelled page; null labels are left out, a null
    host counts as the empty one."""
    h = _reputation(outcomes, host, bad)[0]
    return h.select("host", "n", "bad", _mean().alias("mean"), _bound().alias("bound"))


def bounds_of_hosts(hosts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(host, bound) of every row of ``hosts`` (host): from the posterior of the
    host, else from the prior below its domain, its suffix or the root.  The
    bound is null if there are no labels at all."""
    own, of_dom, of_sfx, of_root = _reputation(outcomes, "host", "bad")

    def bound(level: DataFrame, key: str, name: str) -> DataFrame:
        return level.select(F.col(key).alias("_" + key), _bound().alias(name))

    h = hosts.select("host").withColumns({"domain": registered_domain(F.col("host")), "sfx": suffix(F.col("host"))})
    # Upper levels are joined to the rows of the level below, not to the hosts.
    up = h.select("domain", "sfx").distinct().join(bound(of_dom, "domain", "_d"), F.col("domain") == F.col("_domain"), "left")
    up = up.join(bound(of_sfx, "sfx", "_s"), F.col("sfx") == F.col("_sfx"), "left")
    up = up.join(F.broadcast(bound(of_root, "root", "_t")), F.lit(0) == F.col("_root"), "left")  # at most one row
    up = up.select(F.col("domain").alias("_up"), F.coalesce("_d", "_s", "_t").alias("_prior"))
    h = h.join(bound(own, "host", "_h"), F.col("host") == F.col("_host"), "left")
    h = h.join(up, F.col("domain") == F.col("_up"))
    return h.select("host", F.coalesce("_h", "_prior").alias("bound"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, url: str = "url", rules=RULES,
                block_above: float = BLOCK_ABOVE) -> DataFrame:
    """``pages`` with (host, path, rule, verdict, reputation_bound).

    Null urls and urls without ``://`` have an empty host and path.  A host
    without labels has the bound of its domain, its suffix or all labels;
    without any labels there is none and all is allowed.  Columns of ``pages``
    with one of the new names are replaced."""
    new = ["host", "path", "rule", "verdict", "reputation_bound"]
    kept = [c for c in pages.columns if c not in new]
    # Input columns under names of their own: they cannot clash with those here.
    held = {f"in_{i}": c for i, c in enumerate(kept)}
    u = pages.select(*[F.col(f"`{c}`").alias(n) for n, c in held.items()], url_host(url).alias("host"), url_path(url).alias("path"))
    hosts = pages.select(url_host(url).alias("host")).distinct()
    rep = bounds_of_hosts(hosts, outcomes).select(F.col("host").alias("_rh"), F.col("bound").alias("reputation_bound"))
    hit = matching_rule(F.col("host"), F.col("path"), rules)
    j = u.withColumn("_hit", hit).join(rep, F.col("host") == F.col("_rh"), "left")
    by_rep = F.when(F.col("reputation_bound") > block_above, F.lit("block")).otherwise(F.lit("allow"))
    return j.select(*[F.col(n).alias(c) for n, c in held.items()], "host", "path", F.col("_hit.rule").alias("rule"),
                    F.coalesce("_hit.verdict", by_rep).alias("verdict"), "reputation_bound")
