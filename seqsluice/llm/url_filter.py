"""URL filter: rules first, then empirical-Bayes reputation of hosts. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise, small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, rule); a rule is host and path.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: Common suffixes of two labels under which names are registered; a whole list can be given as a table instead.
TWO_LABEL_SUFFIXES = (
    "ac.jp", "ac.nz", "ac.uk", "ac.za", "blogspot.com", "co.id", "co.il", "co.in", "co.jp", "co.ke", "co.kr", "co.nz", "co.th", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.co", "com.hk", "com.mx", "com.my", "com.ng", "com.pe", "com.ph", "com.pk", "com.pl",
    "com.sa", "com.sg", "com.tr", "com.tw", "com.ua", "com.vn", "edu.au", "edu.cn", "github.io", "gitlab.io", "go.jp", "go.kr", "gob.mx", "gov.au", "gov.br", "gov.cn", "gov.in", "gov.uk", "gov.za", "herokuapp.com", "ne.jp", "net.au", "net.br", "net.cn", "net.uk", "or.jp",
    "or.kr", "org.au", "org.br", "org.cn", "org.nz", "org.tw", "org.uk", "org.za", "pages.dev", "web.app", "wordpress.com",
)
URL = r"(?s)://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ://, up to / ? # or the end, A-Z lower-cased; null or no ://: empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def bare(host: Column) -> Column:
    """The host without user part and port."""
    name = F.substring_index(host, "@", -1)
    return F.when(F.startswith(name, F.lit("[")), F.concat(F.substring_index(name, "]", 1), F.lit("]"))).otherwise(F.substring_index(name, ":", 1))


def _by_suffix(hosts: DataFrame, suffixes: tuple | DataFrame) -> DataFrame:
    """Adds domain and suffix to hosts (name, ...): the longest suffix of two or three labels that the list has, else the last label, and one label more. An address is its own domain, of an empty suffix."""
    last = lambda n: F.substring_index("name", ".", -n)
    if isinstance(suffixes, DataFrame):
        known = suffixes.select(F.trim("suffix").alias("s")).where("s IS NOT NULL").distinct()
        for n in (2, 3):
            hosts = hosts.join(known.select(F.col("s").alias(f"s{n}")), last(n) == F.col(f"s{n}"), "left")
        listed = {n: F.col(f"s{n}").isNotNull() for n in (2, 3)}
    else:
        listed = {n: last(n).isin(*suffixes) for n in (2, 3)}
    address = F.rlike("name", F.lit(r"^(\[.*|[0-9.]+)$"))
    domain = F.when(address, F.col("name")).when(listed[3], last(4)).when(listed[2], last(3)).otherwise(last(2))
    suffix = F.when(address, "").when(listed[3], last(3)).when(listed[2], last(2)).otherwise(last(1))
    return hosts.withColumns({"domain": domain, "suffix": suffix}).drop("s2", "s3")


def _rule(rules: tuple) -> tuple[Column, Column]:
    """The longest rule that fits host and path, and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, text in sorted(rules, key=lambda x: (len(x[1]), x[1])):
        cut = text.index("/")
        fits = ((F.col("host") == text[:cut]) | F.endswith("host", F.lit("." + text[:cut]))) & F.startswith("path", F.lit(text[cut:]))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, say).otherwise(verdict)
    return rule, verdict


def _posterior(stats: DataFrame, key: str, prior_mean: str, least: float) -> DataFrame:
    """Adds post_<key>: each row's bad rate, shrunk to prior_mean; the strength of the prior is fitted by moments over all rows of the level.

    With rates y of n outcomes each, m the mean rate and s2 the n-weighted variance of y, the strength is (m(1-m) - s2) / (s2 - m(1-m)/n'), n' the mean n;
    it is at least `least` and at most 10^6 (rates that vary less than chance)."""
    fit = stats.where("n > 0").agg(F.sum("bad").alias("b"), F.sum("n").alias("t"), F.count("*").alias("g"), F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("bb"))
    m = F.col("b") / F.col("t")
    chance = m * (1 - m)
    s2 = F.col("bb") / F.col("t") - m * m
    over = s2 - chance * F.col("g") / F.col("t")
    strength = F.when(over > 1e-9, F.least(F.greatest((chance - s2) / over, F.lit(least)), F.lit(1e6))).otherwise(1e6)
    fit = fit.select(F.round(F.when(F.col("t") > 0, strength).otherwise(least), 6).alias(f"k_{key}"))
    return stats.crossJoin(F.broadcast(fit)).withColumn(f"post_{key}", (F.col("bad") + F.col(f"k_{key}") * F.col(prior_mean)) / (F.col("n") + F.col(f"k_{key}")))


def judge(pages: DataFrame, rules: tuple = RULES, z: float = 1.0, limit: float = 0.5, least: float = 1.0, suffixes: tuple | DataFrame = TWO_LABEL_SUFFIXES) -> DataFrame:
    """(page_id, host, path, rule, verdict, bad_rate, bound) for every page.

    A page on which a rule falls is a labelled outcome (bad if the rule blocks) and keeps the rule's verdict. The others
    are judged by their host without user part and port: its beta prior comes from its registered domain, whose prior comes
    from its suffix, whose prior comes from all outcomes. bound is the posterior mean less z posterior standard deviations, which
    stands in for a quantile of the beta; above `limit` the page is blocked. suffixes: those of more than one label, or a table of them.

    Pages are read twice: outcomes are summed by host before any join, so a hot host is one row of a summary that is
    written once and from which all levels come; what is judged of hosts (not pages) is joined back by host, where
    adaptive execution may split the pages of a hot one. The one-row totals alone are always broadcast.

    A null url or one without :// has an empty host and path and no rule; the empty host is a host like others. No
    labelled outcome at all gives a bad rate of 0 and allows the page. Repeated pages each count and each return. Further columns of `pages` are ignored.
    """
    rule, said = _rule(rules)
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).select("page_id", "host", "path", rule.alias("rule"), said.alias("said"), bare(F.col("host")).alias("name"))
    hosts = parsed.groupBy("name").agg(F.sum((F.coalesce(F.col("said") == "block", F.lit(False))).cast("long")).alias("bad"), F.count("said").alias("n"))
    hosts = materialise(_by_suffix(hosts, suffixes), "url-hosts")
    sums = (F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    total = hosts.agg(*sums).select(F.coalesce(F.col("bad") / F.when(F.col("n") > 0, F.col("n")), F.lit(0.0)).alias("prior"))
    suffix_rows = materialise(_posterior(hosts.groupBy("suffix").agg(*sums).crossJoin(F.broadcast(total)), "suffix", "prior", least), "url-suffixes")
    domains = hosts.groupBy("domain", "suffix").agg(*sums).join(suffix_rows.select("suffix", "post_suffix"), "suffix")
    domains = materialise(_posterior(domains, "domain", "post_suffix", least), "url-domains")
    judged = _posterior(hosts.join(domains.select("domain", "post_domain"), "domain"), "host", "post_domain", least)
    weight = F.col("n") + F.col("k_host") + 1
    p = F.col("post_host")
    judged = materialise(judged.select("name", F.round(p, 6).alias("bad_rate"), F.round(p - z * F.sqrt(p * (1 - p) / weight), 6).alias("bound")), "url-judged")
    for made in (hosts, suffix_rows, domains):
        discard(made)
    out = parsed.join(small(judged), "name")
    verdict = F.coalesce(F.col("said"), F.when(F.col("bound") > limit, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "bad_rate", "bound")


def oracle(rules: tuple = RULES, z: float = 1.0, limit: float = 0.5, least: float = 1.0) -> str:
    """The same in DuckDB's SQL, over `pages`."""
    by_length = sorted(rules, key=lambda x: (-len(x[1]), x[1]))

    def case(value) -> str:
        whens = []
        for say, text in by_length:
            cut = text.index("/")
            whens.append(f"WHEN (host = '{text[:cut]}' OR ends_with(host, '.{text[:cut]}')) AND starts_with(path, '{text[cut:]}') THEN '{value(say, text)}'")
        return f"CASE {' '.join(whens)} END"

    two = ", ".join(f"'{x}'" for x in TWO_LABEL_SUFFIXES)

    def last(n: int) -> str:
        return f"array_to_string(list_slice(string_split(name, '.'), -{n}, -1), '.')"

    address = r"regexp_matches(name, '^(\[.*|[0-9.]+)$')"

    def fit(level: str, source: str) -> str:
        return f"""fit_{level} AS (SELECT round(CASE WHEN t > 0 THEN CASE WHEN s2 - c * g / t > 1e-9 THEN least(greatest((c - s2) / (s2 - c * g / t), {least}), 1e6) ELSE 1e6 END ELSE {least} END, 6) AS k
  FROM (SELECT t, g, bb / t - (b / t) * (b / t) AS s2, (b / t) * (1 - b / t) AS c FROM (SELECT sum(bad)::DOUBLE b, sum(n)::DOUBLE t, count(*)::DOUBLE g, sum(bad::DOUBLE * bad / n) bb FROM {source} WHERE n > 0)))"""

    return rf"""WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '{URL}', 1), ''), '{UPPER}', '{LOWER}') AS host, coalesce(regexp_extract(url, '{URL}', 2), '') AS path FROM pages),
parsed AS (SELECT *, {case(lambda say, text: text)} AS rule, {case(lambda say, text: say)} AS said FROM u),
named AS (SELECT *, CASE WHEN starts_with(own, '[') THEN concat(split_part(own, ']', 1), ']') ELSE split_part(own, ':', 1) END AS name FROM (SELECT *, regexp_replace(host, '^.*@', '') AS own FROM parsed)),
hosts AS (SELECT name, CASE WHEN {address} THEN name WHEN {last(3)} IN ({two}) THEN {last(4)} WHEN {last(2)} IN ({two}) THEN {last(3)} ELSE {last(2)} END AS domain,
  CASE WHEN {address} THEN '' WHEN {last(3)} IN ({two}) THEN {last(3)} WHEN {last(2)} IN ({two}) THEN {last(2)} ELSE {last(1)} END AS suffix,
  count(*) FILTER (WHERE said = 'block') AS bad, count(said) AS n FROM named GROUP BY ALL),
total AS (SELECT coalesce(sum(bad) / CASE WHEN sum(n) > 0 THEN sum(n) END, 0) AS prior FROM hosts),
s0 AS (SELECT suffix, sum(bad) AS bad, sum(n) AS n FROM hosts GROUP BY 1),
{fit('suffix', 's0')},
s1 AS (SELECT suffix, (bad + k * prior) / (n + k) AS post FROM s0, fit_suffix, total),
d0 AS (SELECT domain, suffix, sum(bad) AS bad, sum(n) AS n FROM hosts GROUP BY 1, 2),
{fit('domain', 'd0')},
d1 AS (SELECT domain, (bad + k * post) / (n + k) AS post FROM d0 JOIN s1 USING (suffix), fit_domain),
{fit('host', 'hosts')},
h1 AS (SELECT name, n, k, (bad + k * post) / (n + k) AS p FROM hosts JOIN d1 USING (domain), fit_host),
h2 AS (SELECT name, round(p, 6) AS bad_rate, round(p - {z} * sqrt(p * (1 - p) / (n + k + 1)), 6) AS bound FROM h1)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN bound > {limit} THEN 'block' ELSE 'allow' END) AS verdict, bad_rate, bound FROM named JOIN h2 USING (name)"""
