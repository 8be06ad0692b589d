"""URL verdicts: fixed rules first, then the reputation of the host, with DataFrame functions only.

Reputation is empirical Bayes. Labelled pages of a host are good or bad outcomes; a host's rate of bad
ones is shrunk towards its registered domain's, that towards its suffix's, that towards the rate of
all pages. How strongly a level holds its members together is estimated from the outcomes by moments:
the variance of the members' rates beyond what chance gives is that of a beta distribution, whose
a + b are the pages that the level's rate counts as. A host's posterior is a beta distribution with
a mean and a variance; its lower bound is the mean less `z` standard deviations. Hosts whose bound lies over `worse` times
the rate of all pages are blocked: so few outcomes don't suffice, and a host without any has its domain's rate.

The registered domain is the suffix and one label more; the suffix is the last label, or the last two if they are in `second_level`.
A port or a user's name counts as part of the host, but not of its domain. Numeric addresses are their own domain and suffix.

A page whose label is null has no outcome. A null url, or one without `://`, has the host '' (a host like others) and the path ''. Repeated rows
count each; several labels of a document are bad if any is. Rows without a page_id stay. Empty pages give an empty result; other columns are ignored.

Pages join their host's verdict by a shuffle on the host, but for hosts with over a thousandth of all pages: there are fewer than a thousand, and
these are broadcast. The scratch table of hosts stays until `clear_scratch`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltflow.llm._common import cut, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Two-label suffixes below which names are registered.
SECOND_LEVEL = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp", "or.jp", "com.br", "com.cn", "com.mx", "com.tr", "co.in", "co.kr", "co.za")
WORSE, Z = 1.5, 1.645
#: Bounds of a level's weight, in pages.
LEAST, MOST = 2.0, 1000.0
HOT = 1000


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; then up to `?`, `#` or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def match(rules: tuple[Rule, ...], host: Column, path: Column) -> Column:
    """The longest rule (then the longer host, then the earlier one) that fits, as a struct of rule and verdict, or null. A rule fits its host and all below it, if the path starts with the rule's."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def domain_and_suffix(host: Column, second_level: tuple[str, ...] = SECOND_LEVEL) -> tuple[Column, Column]:
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    two = F.substring_index(bare, ".", -2)
    is_two = two.isin(*second_level)
    numeric = bare.rlike(r"^[0-9.]+$|^\[")
    suffix = F.when(numeric, bare).when(is_two, two).otherwise(F.substring_index(bare, ".", -1))
    return F.when(numeric, bare).when(is_two, F.substring_index(bare, ".", -3)).otherwise(two), suffix


def _weight(units: DataFrame) -> float:
    """The pages that a level's rate counts as, from its members' outcomes (n, bad) and the rate that they are shrunk to (prior)."""
    chance = F.col("prior") * (1 - F.col("prior"))
    off = F.col("bad") / F.col("n") - F.col("prior")
    got = units.filter("n > 0").agg(F.sum(F.col("n") * off * off - chance).alias("beyond"), F.sum(chance * (F.col("n") - 1)).alias("room")).first()
    share = got.beyond / got.room if got.room else 0.0
    return min(max(1 / share - 1, LEAST), MOST) if share > 0 else MOST


def reputation(hosts: DataFrame, worse: float = WORSE, z: float = Z, second_level: tuple[str, ...] = SECOND_LEVEL) -> DataFrame:
    """hosts (host once each, n labelled pages, bad ones of these, others) with domain, suffix, mean and low (bounds of the bad pages' rate) and verdict.

    hosts is read several times, so it should be a table.
    """
    domain, suffix = domain_and_suffix(F.col("host"), second_level)
    hosts = hosts.withColumns({"domain": domain, "suffix": suffix})
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    rate = (total.bad + 1) / (total.n + 2)
    shrunk = lambda weight: (F.lit(weight) * F.col("prior") + F.col("bad")) / (F.lit(weight) + F.col("n"))
    sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = hosts.groupBy("suffix").agg(*sums).withColumn("prior", F.lit(rate))
    suffixes = suffixes.select("suffix", shrunk(_weight(suffixes)).alias("prior"))
    domains = hosts.groupBy("suffix", "domain").agg(*sums).join(suffixes, "suffix")
    domains = domains.select("suffix", "domain", shrunk(_weight(domains)).alias("prior"))
    judged = hosts.join(domains, ["suffix", "domain"])
    weight = _weight(judged)
    a, b = F.lit(weight) * F.col("prior") + F.col("bad"), F.lit(weight) * (1 - F.col("prior")) + F.col("n") - F.col("bad")
    judged = judged.withColumn("mean", a / (a + b)).withColumn("low", F.col("mean") - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))))
    return judged.drop("prior").withColumn("verdict", F.when(F.col("low") > worse * rate, "block").otherwise("allow"))


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Each host's pages, and how many are labelled and bad (a quality of 0, or toxic), from pages (host, doc_id) and labels (doc_id, quality, toxic)."""
    seen = pages.groupBy("host", "doc_id").agg(F.count("*").alias("n"))
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = labels.filter("quality is not null or toxic is not null").groupBy("doc_id").agg(F.max(bad).alias("is_bad"))
    none = F.lit(0).cast("long")
    own = seen.join(known, "doc_id").select("host", none.alias("pages"), "n", F.when(F.col("is_bad"), F.col("n")).otherwise(none).alias("bad"))
    every = seen.select("host", F.col("n").alias("pages"), none.alias("n"), none.alias("bad")).unionAll(own)
    return every.groupBy("host").agg(*(F.sum(c).alias(c) for c in ("pages", "n", "bad")))


def judge(pages: DataFrame, labels: DataFrame, doc_id: Column, rules: tuple[Rule, ...] = RULES, worse: float = WORSE, z: float = Z) -> DataFrame:
    """pages (page_id, url) with host, path, rule and verdict. doc_id: the document that a page shows, by which labels know it, over host and path."""
    host, path = host_and_path(F.coalesce("url", F.lit("")))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    hosts, _ = cut(outcomes(rows.select("host", doc_id.alias("doc_id")), labels), "hosts")
    total = hosts.agg(F.sum("pages")).first()[0] or 0
    judged = reputation(hosts, worse, z).select("host", "pages", "verdict")
    is_hot = F.col("pages") * HOT > total
    hot = judged.filter(is_hot).select(F.col("host").alias("h"), F.col("verdict").alias("hot"))
    # pages of hot hosts know their verdict by now and are dealt out by page; nothing joins them
    rows = rows.join(F.broadcast(hot), F.col("host") == F.col("h"), "left").drop("h").withColumn("away", F.when(F.col("hot").isNotNull(), F.xxhash64("page_id", "path")).otherwise(0))
    cold = judged.filter(~is_hot).select(F.col("host").alias("h"), F.col("verdict").alias("cold"), F.lit(0).cast("long").alias("none"))
    rows = rows.join(cold, (F.col("host") == F.col("h")) & (F.col("away") == F.col("none")), "left")
    return rows.withColumn("matched", match(rules, F.col("host"), F.col("path"))).select(
        "page_id", "host", "path", F.col("matched.rule").alias("rule"), F.coalesce("matched.verdict", "hot", "cold").alias("verdict")
    )


#: The pages of these tables name the document that they show: a number after the language in their path.
SHOWN = r"^/[^/]*/([0-9]{1,18})"


def op13_url_filter(spark, sf_dir: str) -> DataFrame:
    shown = F.expr(f"try_cast(regexp_extract(path, '{SHOWN}', 1) as bigint)")
    return judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), shown)


def _weight_sql(units: str) -> str:
    return f"""(SELECT CASE WHEN coalesce(x / nullif(r, 0), 0) > 0 THEN least(greatest(1 / (x / r) - 1, {LEAST}), {MOST}) ELSE {MOST} END AS w FROM (
  SELECT sum(n * (bad / n - prior) * (bad / n - prior) - prior * (1 - prior)) AS x, sum(prior * (1 - prior) * (n - 1)) AS r FROM {units} WHERE n > 0))"""


_TWO = ", ".join(f"'{x}'" for x in SECOND_LEVEL)
_RULE = "CASE " + " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN {{}}" for r in sorted(RULES, key=lambda r: -len(r.text))) + " END"
#: The query in SQL: the rules, and the same posterior from each host's outcomes.
OP13_SQL = rf"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), k AS (SELECT doc_id, max(coalesce(quality = 0, false) OR coalesce(toxic = 1, false)) AS is_bad FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id
), h AS (SELECT host, count(is_bad) AS n, count(*) FILTER (is_bad) AS bad FROM p LEFT JOIN k ON TRY_CAST(regexp_extract(path, '{SHOWN}', 1) AS BIGINT) = doc_id GROUP BY host
), b AS (SELECT *, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS l FROM h
), s AS (SELECT host, n, bad, CASE WHEN regexp_matches(host, '^[0-9.]+$|^\[') THEN 0 WHEN array_to_string(l[-2:], '.') IN ({_TWO}) THEN 2 ELSE 1 END AS c, l FROM b
), d AS (SELECT host, n, bad, CASE c WHEN 0 THEN array_to_string(l, '.') WHEN 2 THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix, CASE c WHEN 0 THEN array_to_string(l, '.') WHEN 2 THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS domain FROM s
), g AS (SELECT (sum(bad) + 1) / (sum(n) + 2) AS rate FROM d
), f0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(rate) AS prior FROM d, g GROUP BY suffix
), f AS (SELECT suffix, (w * prior + bad) / (w + n) AS prior FROM f0, {_weight_sql('f0')}
), e0 AS (SELECT suffix, domain, sum(d.n) AS n, sum(d.bad) AS bad, any_value(prior) AS prior FROM d JOIN f USING (suffix) GROUP BY suffix, domain
), e AS (SELECT suffix, domain, (w * prior + bad) / (w + n) AS prior FROM e0, {_weight_sql('e0')}
), j0 AS (SELECT host, d.n, d.bad, prior FROM d JOIN e USING (suffix, domain)
), j1 AS (SELECT host, w * prior + bad AS a, w * (1 - prior) + n - bad AS b FROM j0, {_weight_sql('j0')}
), j AS (SELECT host, CASE WHEN a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > {WORSE} * rate THEN 'block' ELSE 'allow' END AS verdict FROM j1, g)
SELECT page_id, host, path, {_RULE.format(*(f"'{r.text}'" for r in sorted(RULES, key=lambda r: -len(r.text))))} AS rule,
  coalesce({_RULE.format(*(f"'{r.verdict}'" for r in sorted(RULES, key=lambda r: -len(r.text))))}, verdict) AS verdict FROM p JOIN j USING (host)
"""
