"""URL filters: rules first, then an empirical-Bayes reputation of the host.

Pages that a rule judges are the labelled outcomes. A host's rate of blocked
pages gets a beta prior centred on its registered domain's rate, that on its
public suffix's, that on the overall rate; how strongly each level leans on
the one above is fitted from the outcomes (beta-binomial, by moments). A host
is blocked if the lower bound of its posterior rate is above a limit.
Everything is native DataFrame code over per-host counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Production rules.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)
#: Standard deviations below the posterior mean, and the rate of blocked pages that this bound may reach.
Z, LIMIT = 1.2816, 0.5


def host_and_path(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host and path of a url; both empty for null or without ``://``."""
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, pattern, 1), UPPER, LOWER), F.regexp_extract(text, pattern, 2)


def matched(host: F.Column, path: F.Column, rules: tuple[Rule, ...], of: str) -> F.Column:
    """``name`` or ``verdict`` of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(getattr(r, of))).otherwise(out)
    return out


def _strength(groups: DataFrame) -> float:
    """Prior weight from columns n, k and m (the parent's rate), by matching moments."""
    v = F.col("m") * (1 - F.col("m"))
    a, b, c = groups.where("n > 0").agg(F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - F.col("m"), 2)), F.sum(v), F.sum((F.col("n") - 1) * v)).first()
    rho = (a - b) / c if c else 0.5
    rho = min(0.99, max(0.01, rho))
    return 1 / rho - 1


def reputations(outcomes: DataFrame, z: float = Z) -> DataFrame:
    """``(host, bound)`` from ``outcomes(host, n, k)``: pages labelled, and blocked, of each distinct host.

    ``bound`` is the lower posterior bound of the host's rate of blocked
    pages. The registered domain is the last two labels of the host (its port
    left out), the suffix the last.
    """
    bare = F.regexp_replace("host", ":[0-9]*$", "")
    hosts = outcomes.select("host", "n", "k", F.substring_index(bare, ".", -2).alias("domain"), F.substring_index(bare, ".", -1).alias("suffix"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    root = ((total.k or 0) + 0.5) / ((total.n or 0) + 1.0)
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("m", F.lit(root))

    def posterior(df: DataFrame, strength: float) -> F.Column:
        return (F.col("k") + strength * F.col("m")) / (F.col("n") + strength)

    by_suffix = suffixes.select("suffix", posterior(suffixes, _strength(suffixes)).alias("m"))
    in_suffix = domains.join(by_suffix, "suffix")
    by_domain = in_suffix.select("domain", "suffix", posterior(in_suffix, _strength(in_suffix)).alias("m"))
    in_domain = hosts.join(by_domain, ["suffix", "domain"])
    s = _strength(in_domain)
    a, b = F.col("k") + s * F.col("m"), F.col("n") - F.col("k") + s * (1 - F.col("m"))
    return in_domain.select("host", (a / (a + b) - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))).alias("bound"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, z: float = Z, limit: float = LIMIT, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(id, host, path, rule, verdict)`` of every row.

    The longest rule that fits decides (of equals, that with the longer host);
    without one, the host's posterior bound. Null urls, and those without
    ``://``, are the host named by the empty string. Repeated rows count as
    repeated outcomes and come back repeated; other columns play no part; an
    empty table gives no rows. Without any outcome all hosts share one prior.
    """
    host, path = host_and_path(F.col(url_col))
    split = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    named = split.select(id_col, "host", "path", matched(F.col("host"), F.col("path"), rules, "name").alias("rule"), matched(F.col("host"), F.col("path"), rules, "verdict").alias("ruled"))
    outcomes = named.groupBy("host").agg(F.count("ruled").alias("n"), F.count_if(F.col("ruled") == "block").alias("k"))
    known = reputations(outcomes, z)
    by_host = F.when(F.col("bound") > limit, "block").otherwise("allow")
    return named.join(known, "host").select(id_col, "host", "path", "rule", F.coalesce("ruled", by_host).alias("verdict"))
