"""URL verdicts: explicit rules first, then empirical-Bayes reputation of the host.

Outcomes of labelled pages (bad or not) are counted per host. Reputation is shrunk downwards through
beta-binomial priors: the suffix (last label) towards all pages, the registered domain (last two labels)
towards its suffix, the host towards its domain. A group's prior is its parent without the group itself.
The strength of the priors of a level, in pages, comes from the data by the method of moments (the spread
of the group shares around their priors beyond what chance gives) and is never more than the evidence
behind the prior. A host is blocked if the lower bound of its bad share reaches a mark taken from the evidence:
the share whose odds are ``LIFT`` times those of all labelled pages, within ``BLOCK_SHARES``.

Defined cases: a null url, or one without ``://``, has an empty host and path; hosts without labelled
pages have the reputation of their domain, suffix or all pages; without any label everything that no
rule fits is allowed; repeated labels of a page count once, as bad; repeated pages count each; urls are read whole whatever
their length; columns other than those named do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import store

#: (host, path, verdict); a rule fits its host and all subdomains where the path starts with the rule's.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: How much worse than all pages a blocked host is (odds), and the bounds of the share that follows.
LIFT, BLOCK_SHARES = 2.0, (0.1, 0.5)
#: The confidence of a host's bound, in standard deviations below the mean.
DEVIATIONS = 1.645
#: Bounds of a prior's strength, in pages.
WEAKEST, STRONGEST = 1.0, 1000.0

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
DOMAIN = r"([^.]+\.[^.]+)$"
SUFFIX = r"([^.]*)$"
#: The number of the document that a page shows ends its path.
PAGE_NUMBER = r"/([0-9]{1,18})(?:/|\.html)?$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.lit(""))


def path_of(url: str) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def _parent(host: str, pattern: str) -> Column:
    found = F.regexp_extract(host, pattern, 1)
    return F.when(found == "", F.col(host)).otherwise(found)


def longest_rule(host: str, path: str, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col(host) == h) | F.col(host).endswith(f".{h}")) & F.col(path).startswith(p)
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def _strength(groups: DataFrame) -> float:
    """Pages that a prior counts for, from ``groups(n, bad, prior)``."""
    n, bad, prior = (F.col(c).cast("double") for c in ("n", "bad", "prior"))
    r = (
        groups.where("n > 0")
        .agg(
            F.sum(n * (bad / n - prior) * (bad / n - prior)).alias("spread"),
            F.sum(prior * (1 - prior)).alias("chance"),
            F.sum(n * prior * (1 - prior)).alias("scale"),
            F.sum(n).alias("n"),
        )
        .first()
    )
    if not r["n"]:
        return STRONGEST
    between = (r["spread"] - r["chance"]) / r["n"]
    if between <= 0 or not r["scale"]:
        return STRONGEST
    return min(STRONGEST, max(WEAKEST, r["scale"] / r["n"] / between - 1))


def _mark(share: float) -> float:
    """The bad share that blocks a host where all pages have ``share``."""
    return min(BLOCK_SHARES[1], max(BLOCK_SHARES[0], LIFT * share / (1 - share + LIFT * share)))


def reputations(outcomes: DataFrame) -> DataFrame:
    """``(host, n, bad, share, bound, blocked)`` for every host of ``outcomes(host, bad)``; ``bad`` is null for unlabelled pages.

    ``share`` is the posterior mean of the bad share, ``bound`` its lower bound.
    """
    hosts = store(
        outcomes.groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .withColumn("domain", _parent("host", DOMAIN))
        .withColumn("suffix", _parent("host", SUFFIX)),
        "hosts",
    )
    counts = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = hosts.agg(*counts).first()
    share = total["bad"] / total["n"] if total["n"] else 0.0
    all_pages = [F.lit(float(x)) for x in (total["n"] or 0, total["bad"] or 0, WEAKEST, share)]
    suffixes = _level(hosts.groupBy("suffix").agg(*counts), all_pages)
    domains = hosts.groupBy("domain", "suffix").agg(*counts)
    domains = _level(domains.join(_as_parent(suffixes, "suffix"), "suffix"))
    placed = _level(hosts.join(_as_parent(domains, "domain"), "domain"))
    weight = F.col("n") + F.col("strength")
    mean = (F.col("bad") + F.col("strength") * F.col("prior")) / weight
    bound = F.col("share") - F.lit(DEVIATIONS) * F.sqrt(F.col("share") * (1 - F.col("share")) / (weight + 1))
    return (
        placed.withColumn("share", mean)
        .withColumn("bound", bound)
        .select("host", "n", "bad", "share", "bound", (F.col("bound") >= F.lit(_mark(share))).alias("blocked"))
    )


_PARENT = ("parent_n", "parent_bad", "parent_strength", "parent_prior")


def _as_parent(groups: DataFrame, key: str) -> DataFrame:
    return groups.select(key, *[F.col(c.removeprefix("parent_")).alias(c) for c in _PARENT])


def _level(groups: DataFrame, parent: list[Column] | None = None) -> DataFrame:
    """``groups(n, bad)`` with the ``prior`` share and its ``strength``, stored."""
    n, bad, strength, prior = parent or [F.col(c).cast("double") for c in _PARENT]
    evidence = n - F.col("n") + strength
    own = (bad - F.col("bad") + strength * prior) / evidence
    placed = store(groups.withColumn("prior", own).withColumn("evidence", evidence).drop(*_PARENT), "level")
    return placed.withColumn("strength", F.least(F.lit(_strength(placed)), F.col("evidence")))


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``(host, bad)`` per page: 1 if the document it shows is labelled toxic or of low quality, 0 if labelled otherwise, else null."""
    outcomes = (
        labels.where(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
        .withColumn("bad", F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0))
        .groupBy("doc_id")
        .agg(F.max("bad").alias("bad"))
    )
    shown = pages.select(
        host_of("url").alias("host"), F.regexp_extract(path_of("url"), PAGE_NUMBER, 1).try_cast("long").alias("doc_id")
    )
    return shown.join(outcomes, "doc_id", "left").select("host", "bad")


def page_verdicts(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (null if none fits) and ``verdict`` of every page."""
    known = store(reputations(labelled_pages(pages, labels)).select("host", "blocked", "share", "bound"), "reputations")
    split = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"))
    rule, verdict = longest_rule("host", "path", rules)
    judged = split.withColumn("rule", rule).withColumn("__verdict", verdict).join(known, "host")
    own = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("__verdict", own).alias("verdict"))


def _fits_sql(h: str, p: str) -> str:
    return f"((host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}'))"


def verdict_sql(rules=RULES) -> str:
    """The same verdicts in SQL over ``pages`` and ``labels``."""
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    rule = " ".join(f"when {_fits_sql(h, p)} then '{h}{p}'" for h, p, _ in ordered)
    verdict = " ".join(f"when {_fits_sql(h, p)} then '{v}'" for h, p, v in ordered)

    def strength(groups: str) -> str:
        return f"""(select case when sum(n) is null or sum(n * (bad / n - prior) * (bad / n - prior)) <= sum(prior * (1 - prior))
      or sum(n * prior * (1 - prior)) = 0 then {STRONGEST}
    else least({STRONGEST}, greatest({WEAKEST}, sum(n * prior * (1 - prior))
      / (sum(n * (bad / n - prior) * (bad / n - prior)) - sum(prior * (1 - prior))) - 1)) end
    from {groups} where n > 0)"""

    def level(name: str, groups: str, n: str, bad: str, weight: str, prior: str) -> str:
        return f"""{name}0 as materialized (
  select *, ({bad} - bad + {weight} * {prior}) / ({n} - n + {weight}) prior, {n} - n + {weight} evidence from ({groups})),
{name} as materialized (select *, least({strength(name + "0")}, evidence) strength from {name}0)"""

    above = ("parent_n", "parent_bad", "parent_strength", "parent_prior")
    parent = "n parent_n, bad parent_bad, strength parent_strength, prior parent_prior"
    counts = "sum(n) n, sum(bad) bad"
    all_n, all_bad = "(select coalesce(sum(n), 0) from hosts)", "(select coalesce(sum(bad), 0) from hosts)"
    base, (lowest, highest) = f"coalesce({all_bad} / nullif({all_n}, 0), 0)", BLOCK_SHARES
    levels = ",\n".join(
        [
            level("suffixes", f"select suffix, {counts} from hosts group by 1", all_n, all_bad, str(WEAKEST), base),
            level("domains", f"""select * from (select "domain", suffix, {counts} from hosts group by 1, 2)
    join (select suffix, {parent} from suffixes) using (suffix)""", *above),
            level("placed", f"""select host, n, bad, parent_n, parent_bad, parent_strength, parent_prior from hosts
    join (select "domain", {parent} from domains) using ("domain")""", *above),
        ]
    )
    return f"""
with split as (
  select page_id, coalesce(translate(regexp_extract(url, '{URL}', 1), '{UPPER}', '{LOWER}'), '') host,
    coalesce(regexp_extract(url, '{URL}', 2), '') path from pages),
outcomes as (
  select doc_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) bad from labels
  where doc_id is not null and (quality is not null or toxic is not null) group by 1),
hosts as (
  select host, cast(count(bad) as double) n, cast(coalesce(sum(bad), 0) as double) bad,
    case when regexp_extract(host, '{DOMAIN}', 1) = '' then host else regexp_extract(host, '{DOMAIN}', 1) end as "domain",
    case when regexp_extract(host, '{SUFFIX}', 1) = '' then host else regexp_extract(host, '{SUFFIX}', 1) end suffix
  from split left join outcomes on try_cast(regexp_extract(path, '{PAGE_NUMBER}', 1) as bigint) = doc_id group by 1),
{levels},
mark as (select least({highest}, greatest({lowest}, {LIFT} * b / (1 - b + {LIFT} * b))) mark from (select {base} b)),
judged as (
  select host, (bad + strength * prior) / (n + strength) share, n + strength weight from placed)
select page_id, host, path, case {rule} end rule,
  case {verdict} when share - {DEVIATIONS} * sqrt(share * (1 - share) / (weight + 1)) >= (select mark from mark) then 'block'
  else 'allow' end verdict
from split join judged using (host)"""
