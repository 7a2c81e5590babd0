"""URL filter by rules and by the reputation of hosts.

Pages with a known outcome (good or not) are counted by host.  A host's share of good pages has a
beta prior around its registered domain's, that one around its suffix's, and that one around the
share of all: a beta-binomial model whose concentration is fitted at each level from how much the
groups differ beyond chance (empirical Bayes).  Few outcomes shrink to the level above, hosts
without any take its share.  A host is blocked only if the upper bound of its posterior is below
the share asked for; rules of (host, path) go before that.

Only counts a host are shuffled, and what the driver takes are three sums a level.
"""

from __future__ import annotations

import string
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialise, read_table, unused, without

#: Suffixes of two labels under which domains are registered; any other suffix is the last label.
SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp", "or.jp", "co.kr", "co.in", "co.za", "com.br", "com.cn", "com.mx", "com.sg", "com.tr")
#: Least and greatest correlation of two outcomes of one group; the latter stands where no group has two.
CORRELATION = (1e-4, 0.5)


@dataclass(frozen=True)
class Rule:
    """``verdict`` for the urls of ``host`` and its subdomains whose path begins with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _rest(url: Column) -> Column:
    """What stands after the first ``://``; empty without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """Up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null and other urls: empty."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """From the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Iterable[Rule]) -> Column:
    """struct<length, rule, verdict> of the longest rule that fits, or null; of equally long ones that of the greatest name."""
    fits = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.struct(F.lit(len(r.name)).alias("length"), F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in rules]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<length:int,rule:string,verdict:string>")


def suffix_and_domain(host: Column, suffixes: Iterable[str] = SUFFIXES) -> tuple[Column, Column]:
    """The suffix and the registered domain of a host, without user, port and final dot.

    The domain is the suffix and one label more; addresses and hosts of one label are their own.
    """
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@|:[0-9]*$", ""), r"\.$", "")
    alone = name.rlike(r"^[0-9.]+$|^\[") | ~name.contains(".")
    suffix = F.when(F.substring_index(name, ".", -2).isin(*suffixes), F.substring_index(name, ".", -2)).otherwise(F.substring_index(name, ".", -1))
    domain = F.when(F.substring_index(name, ".", -2).isin(*suffixes), F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))
    return F.when(alone, name).otherwise(suffix), F.when(alone, name).otherwise(domain)


def concentration(groups: DataFrame) -> float:
    """a + b of the beta prior of ``groups`` (n outcomes, k of them good, prior mean m), by moments.

    (k - n m)^2 is n m (1 - m) (1 + (n - 1) r) on average, r being the correlation of two outcomes
    of one group; the concentration is 1 / r - 1.
    """
    v = F.col("m") * (1 - F.col("m"))
    s, a, b = groups.agg(F.sum(F.pow(F.col("k") - F.col("n") * F.col("m"), 2)), F.sum(F.col("n") * v), F.sum(F.col("n") * (F.col("n") - 1) * v)).first()
    low, high = CORRELATION
    return 1 / (min(high, max(low, (s - a) / b)) if b else high) - 1


def fit_hosts(counts: DataFrame, suffixes: Iterable[str] = SUFFIXES, z: float = 1.645) -> DataFrame:
    """(host, share, upper) of ``counts`` (host, n, k): posterior mean and upper bound of the share of good pages.

    The bound is ``z`` standard deviations above the mean.  Hosts with no outcomes (n = 0) belong in
    the table as well.
    """
    suffix, domain = suffix_and_domain(F.col("host"), suffixes)
    hosts = materialise(counts.select("host", "n", "k", domain.alias("domain"), suffix.alias("suffix")))
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("k"), F.lit(0))).first()
    above, posterior = (1 + total[1]) / (2 + total[0]), None
    for level in ("suffix", "domain", "host"):
        up = {"suffix": [], "domain": ["suffix"], "host": ["domain"]}[level]
        groups = hosts.groupBy(level, *up).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        groups = groups.withColumn("m", F.lit(above)) if posterior is None else groups.join(posterior.select(*up, "m"), up[0])
        c = concentration(groups)
        a, b = c * F.col("m") + F.col("k"), c * (1 - F.col("m")) + F.col("n") - F.col("k")
        last, posterior = posterior, materialise(groups.select(level, *up, (a / (a + b)).alias("m"), (a + b).alias("weight")))
        discard(*([last] if last is not None else []))
    discard(hosts)
    m, weight = F.col("m"), F.col("weight")
    return posterior.select("host", m.alias("share"), F.least(F.lit(1.0), m + z * F.sqrt(m * (1 - m) / (weight + 1))).alias("upper"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Iterable[Rule] = (), least: float = 0.5, z: float = 1.645, url: str = "url", page: str = "page_id", names: tuple[str, str, str, str] = ("host", "path", "rule", "verdict")) -> DataFrame:
    """All pages with host, path, the rule that fits (or null) and the verdict, allow or block.

    ``outcomes`` has page_id and good (0 or 1; null: no outcome), any number of rows a page; rows
    for unknown or null pages do not count.  Without a rule a page is blocked if the upper bound of
    its host's posterior is below ``least``.  A null url, or one without ``://``, has an empty host,
    which is judged like any other.  Repeated pages are judged alike and count each, an empty table
    gives none, urls may be of any length; columns of the result replace columns of their names.
    """
    host, path, rule, verdict = names
    number, good, blocked = unused(pages, "_n", "_k", "_bad")
    parted = without(pages.withColumn(url, F.col(url).cast("string")), *(n for n in names if n != url))
    parted = parted.withColumns({host: host_of(F.col(url)), path: path_of(F.col(url))})
    seen = outcomes.where(F.col("good").isNotNull() & F.col("page_id").isNotNull()).groupBy("page_id").agg(F.count("*").alias(number), F.sum(F.col("good").cast("long")).alias(good))
    counted = parted.select(F.col(page).alias("page_id"), F.col(host).alias("host")).join(seen, "page_id", "left")
    counts = counted.groupBy("host").agg(F.coalesce(F.sum(number), F.lit(0)).alias("n"), F.coalesce(F.sum(good), F.lit(0)).alias("k"))
    bad = materialise(fit_hosts(counts, z=z).where(F.col("upper") < least).select(F.col("host").alias(host), F.lit(True).alias(blocked)))
    bad = F.broadcast(bad) if bad.count() <= 1 << 20 else bad
    found = rule_for(F.col(host), F.col(path), rules)
    kept = [f"`{c}`" for c in parted.columns]
    said = F.when(F.col(blocked), "block").otherwise("allow")
    return parted.join(bad, host, "left").select(*kept, found["rule"].alias(rule), F.coalesce(found["verdict"], said).alias(verdict))


#: The rules of the query.
RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, good) of pages whose path names a labelled document, as in ``/en/825``: good if its quality is 1 and it is not toxic."""
    number = F.regexp_extract(path_of(F.col("url").cast("string")), "^/[a-z]+/([0-9]+)", 1).try_cast("long")
    good = ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int")
    of = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min(good).alias("good"))
    return pages.select("page_id", number.alias("doc_id")).distinct().join(of, "doc_id").select("page_id", "good")


def op12_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, judged by five rules and by the labels of the documents that their paths name."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, labelled_pages(pages, read_table(spark, sf_dir, "labels")), RULES).select("page_id", "host", "path", "rule", "verdict")


_SQL_RULES = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)
_SQL_SUFFIXES = ", ".join(f"'{s}'" for s in SUFFIXES)


def _sql_level(level: str, up: str | None, parent: str | None) -> str:
    """The groups of a level and their posterior."""
    low, high = CORRELATION
    prior = f"JOIN post_{parent} p USING ({parent})" if parent else "CROSS JOIN whole p"
    return f"""
g_{level} AS (
  SELECT g.*, p.m AS m0 FROM (SELECT {level}{', ' + up if up else ''}, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL) g {prior}
), c_{level} AS (
  SELECT 1 / coalesce(least({high}, greatest({low}, (sum((k - n * m0) ** 2) - sum(n * m0 * (1 - m0))) / nullif(sum(n * (n - 1) * m0 * (1 - m0)), 0))), {high}) - 1 AS c FROM g_{level}
), post_{level} AS (
  SELECT {level}, (c * m0 + k) / (c + n) AS m, c + n AS weight FROM g_{level}, c_{level}
)"""


OP12_SQL = f"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u
), good AS (
  SELECT doc_id, min(CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 1 ELSE 0 END) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), outcome AS (
  SELECT page_id, count(*) AS n, sum(good) AS k
  FROM (SELECT DISTINCT page_id, try_cast(regexp_extract(path, '^/[a-z]+/([0-9]+)', 1) AS BIGINT) AS doc_id FROM p WHERE page_id IS NOT NULL) JOIN good USING (doc_id) GROUP BY page_id
), name AS (
  SELECT host, coalesce(sum(n), 0) AS n, coalesce(sum(k), 0) AS k, regexp_replace(regexp_replace(host, '^.*@|:[0-9]*$', '', 'g'), '\\.$', '') AS name
  FROM p LEFT JOIN outcome USING (page_id) GROUP BY host
), labelled AS (
  SELECT *, string_split(name, '.') AS parts, regexp_matches(name, '^[0-9.]+$|^\\[') OR NOT contains(name, '.') AS alone FROM name
), wide AS (
  SELECT *, CASE WHEN array_to_string(parts[-2:], '.') IN ({_SQL_SUFFIXES}) THEN 2 ELSE 1 END AS labels FROM labelled
), hosts AS (
  SELECT host, n, k, CASE WHEN alone THEN name ELSE array_to_string(parts[-labels:], '.') END AS suffix,
         CASE WHEN alone THEN name ELSE array_to_string(parts[-(labels + 1):], '.') END AS domain FROM wide
), whole AS (
  SELECT (1 + coalesce(sum(k), 0)) / (2 + coalesce(sum(n), 0)) AS m FROM hosts
),{_sql_level('suffix', None, None)},{_sql_level('domain', 'suffix', 'suffix')},{_sql_level('host', 'domain', 'domain')},
r AS (
  SELECT v, h, q, h || q AS name FROM (VALUES {_SQL_RULES}) AS t(v, h, q)
)
SELECT p.page_id, p.host, p.path, best.name AS rule,
       coalesce(best.v, CASE WHEN least(1, m + 1.645 * sqrt(m * (1 - m) / (weight + 1))) < 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM p JOIN post_host USING (host)
LEFT JOIN LATERAL (
  SELECT name, v FROM r WHERE (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, q) ORDER BY length(name) DESC, name DESC LIMIT 1
) best ON true
"""
