"""URL filter by host reputation: path rules first, else an empirical-Bayes bound on the host's share of bad pages.

Labelled pages are counted per host, registered domain and suffix.  Each level's share
of bad pages is shrunk towards the level above it, all the way to the whole table, by
beta-binomial priors: the prior's mean is the parent's posterior mean, its strength
comes from how much the level's groups differ (method of moments).  A host whose
posterior is surely bad (mean less ``Z`` deviations over ``CUTOFF``) is blocked; a host
without labels has its domain's or suffix's share as its prior.

Everything is DataFrame functions.  Pages are counted per host before anything is
joined, so a host that holds a third of all rows is one row to the model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.session import materialize

Z, CUTOFF = 1.645, 0.5
WEAKEST, STRONGEST = 1.0, 1000.0  # bounds of a prior's strength, in pages
# Suffixes under which strangers register names, in the form of the public list: a name; ``*.name`` for
# every label under it; ``!name`` for a name that such a rule does not cover.  A host that none fits has its last label.
SUFFIXES = (
    "example.com", "example.net", "example.org",
    "com.ar", "edu.ar", "gob.ar", "net.ar", "org.ar",
    "ac.at", "co.at", "gv.at", "or.at",
    "asn.au", "com.au", "edu.au", "gov.au", "id.au", "net.au", "org.au",
    "com.br", "edu.br", "gov.br", "net.br", "org.br",
    "*.ck", "!www.ck",
    "ac.cn", "com.cn", "edu.cn", "gov.cn", "net.cn", "org.cn",
    "com.co", "edu.co", "gov.co", "net.co", "org.co",
    "com.eg", "edu.eg", "gov.eg", "org.eg",
    "com.hk", "edu.hk", "gov.hk", "net.hk", "org.hk",
    "ac.id", "co.id", "go.id", "or.id", "web.id",
    "ac.il", "co.il", "gov.il", "net.il", "org.il",
    "ac.in", "co.in", "edu.in", "firm.in", "gov.in", "net.in", "org.in", "res.in",
    "ac.jp", "ad.jp", "co.jp", "ed.jp", "go.jp", "gr.jp", "lg.jp", "ne.jp", "or.jp", "*.kobe.jp", "!city.kobe.jp",
    "ac.ke", "co.ke", "go.ke", "or.ke",
    "ac.kr", "co.kr", "go.kr", "ne.kr", "or.kr", "pe.kr", "re.kr",
    "com.mx", "edu.mx", "gob.mx", "net.mx", "org.mx",
    "com.my", "edu.my", "gov.my", "net.my", "org.my",
    "com.ng", "edu.ng", "gov.ng", "org.ng",
    "ac.nz", "co.nz", "geek.nz", "govt.nz", "net.nz", "org.nz", "school.nz",
    "com.pe", "edu.pe", "gob.pe", "org.pe",
    "com.ph", "edu.ph", "gov.ph", "org.ph",
    "com.pk", "edu.pk", "gov.pk", "org.pk",
    "com.pl", "edu.pl", "gov.pl", "net.pl", "org.pl",
    "com.sa", "edu.sa", "gov.sa", "org.sa",
    "com.sg", "edu.sg", "gov.sg", "net.sg", "org.sg",
    "ac.th", "co.th", "go.th", "in.th", "or.th",
    "com.tr", "edu.tr", "gov.tr", "net.tr", "org.tr",
    "com.tw", "edu.tw", "gov.tw", "net.tw", "org.tw",
    "com.ua", "edu.ua", "gov.ua", "net.ua", "org.ua",
    "ac.uk", "co.uk", "gov.uk", "ltd.uk", "me.uk", "net.uk", "nhs.uk", "org.uk", "plc.uk", "*.sch.uk",
    "com.vn", "edu.vn", "gov.vn", "net.vn", "org.vn",
    "ac.za", "co.za", "gov.za", "net.za", "org.za", "web.za",
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty where there is no ``://`` or no url."""
    rest = F.expr(f"if(locate('://', {url}) > 0, substring({url}, locate('://', {url}) + 3), '')")
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER).alias("host"),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path"))


def matching_rule(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits host and path; nulls where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for text, say in sorted(rules, key=lambda r: len(r[0])):
        name, slash, tail = text.partition("/")
        fits = ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith(slash + tail)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, say).otherwise(verdict)
    return rule.alias("rule"), verdict


def domain_suffix(suffixes: tuple[str, ...]) -> tuple[Column, Column]:
    """Registered domain and suffix of a host by suffix rules: an exception goes before all others, then the longest rule
    that fits; without one the suffix is the last label.  The domain is the suffix with one label more, or the host
    itself where it has none.  Each length of rules is one set lookup on the host's last labels."""
    def tail(k: int) -> Column:
        return F.substring_index("host", ".", -k)

    labels = F.length("host") - F.length(F.replace(F.col("host"), F.lit("."))) + 1
    longest, spared = F.lit(1), F.lit(None).cast("int")
    for k in range(1, 1 + max((r.count(".") + 1 for r in suffixes), default=0)):
        same = [r for r in suffixes if r.count(".") + 1 == k]
        fits = F.lit(False)
        if plain := [r for r in same if r[0] not in "*!"]:
            fits = tail(k).isin(*plain)
        if under := [r[2:] for r in same if r.startswith("*.")]:
            fits = fits | tail(k - 1).isin(*under)
        longest = F.when(fits & (labels >= k), F.lit(k)).otherwise(longest)
        if but := [r[1:] for r in same if r[0] == "!"]:
            spared = F.when(tail(k).isin(*but), F.lit(k - 1)).otherwise(spared)
    size = F.coalesce(spared, longest)
    return (F.call_function("substring_index", F.col("host"), F.lit("."), -(size + 1)).alias("domain"),
            F.call_function("substring_index", F.col("host"), F.lit("."), -size).alias("suffix"))


def strength(groups: DataFrame) -> float:
    """Strength of the prior over groups (n, b): the strength at which a beta-binomial has the variance they show."""
    row = groups.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum("b").alias("b"),
                     F.sum((F.col("b") * F.col("b") / F.col("n")).cast("decimal(28,12)")).cast("double").alias("q")).first()
    if not row["n"]:
        return STRONGEST
    n, mean = float(row["n"]), row["b"] / row["n"]
    spread = row["q"] - mean * mean * n - (row["k"] - 1) * mean * (1 - mean)
    room = n - row["nn"] / n
    if room <= 0 or spread <= 0 or mean <= 0 or mean >= 1:
        return STRONGEST
    return min(STRONGEST, max(WEAKEST, mean * (1 - mean) / (spread / room) - 1))


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], suffixes: tuple[str, ...] = SUFFIXES,
          z: float = Z, cutoff: float = CUTOFF) -> DataFrame:
    """Verdict on every row of ``pages`` (page_id, url), given ``labels`` (page_id, bad) of some of them.

    Returns page_id, host, path, rule (null where none fits), verdict (allow or block),
    p_bad (posterior mean of the host) and bound (lower bound that is held against
    ``cutoff``).  ``suffixes`` are the rules of ``domain_suffix`` (a few thousand at most, as they are part of the plan);
    a prior's strength is held between ``WEAKEST`` and ``STRONGEST`` pages.  A url that is null or has no ``://`` has an empty host and path, and the
    empty host is judged like any other.  Labels with a null page_id or outcome say
    nothing; a page labelled more than once is bad if any of them says so; a page_id on
    several rows gives its label to each; an empty label table leaves even odds; an
    empty page table gives an empty result.
    """
    named = pages.select("page_id", *host_path())
    outcome = labels.where("page_id is not null and bad is not null").groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    counted = materialize(named.join(outcome, "page_id", "left").groupBy("host")
                          .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("b"))
                          .select("*", *domain_suffix(suffixes)), "hosts")
    seen = counted.where("n > 0")
    domains = seen.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    tops = seen.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    whole = seen.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    root = (whole["b"] + 1) / (whole["n"] + 2)
    of_top, of_domain, of_host = (F.lit(strength(g)) for g in (tops, domains, seen))
    top_mean = ((F.col("b") + of_top * root) / (F.col("n") + of_top)).alias("top_mean")
    domain_mean = (F.coalesce("db", F.lit(0)) + of_domain * F.col("up")) / (F.coalesce("dn", F.lit(0)) + of_domain)
    alpha = F.col("b") + of_host * F.col("domain_mean")
    beta = F.col("n") - F.col("b") + of_host * (1 - F.col("domain_mean"))
    hosts = (counted.join(tops.select("suffix", top_mean), "suffix", "left")
             .join(domains.select("domain", "suffix", F.col("n").alias("dn"), F.col("b").alias("db")), ["domain", "suffix"], "left")
             .withColumn("up", F.coalesce("top_mean", F.lit(root))).withColumn("domain_mean", domain_mean)
             .withColumn("alpha", alpha).withColumn("beta", beta).withColumn("size", F.col("alpha") + F.col("beta"))
             .withColumn("mean", F.col("alpha") / F.col("size"))
             .withColumn("low", F.col("mean") - z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("size") + 1)))
             .select("host", "mean", "low"))
    rule, said = matching_rule(rules)
    return (named.join(hosts, "host")
            .select("page_id", "host", "path", rule, F.coalesce(said, F.when(F.col("low") > cutoff, "block").otherwise("allow")).alias("verdict"),
                    F.round("mean", 6).alias("p_bad"), F.round("low", 6).alias("bound")))
