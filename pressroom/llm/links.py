"""URL filters: rules by longest match, and trust and distrust spread over links between hosts.

Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pressroom.llm.common import salted_join, save

DAMPING = 0.7
#: After so many rounds at most ``DAMPING ** ROUNDS`` (2.8 %) of a seed's weight is still to come.
ROUNDS = 10
#: A host is blocked where its distrust, less its trust, is over this; one is a seed judged wholly.
THRESHOLD = 0.5
#: Rules given as a list are literals of the plan; more of them come as a table.
MAX_RULES = 10_000


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    host: str
    path: str = ""

    @property
    def text(self) -> str:
        return f"{self.host}/{self.path}"

    @staticmethod
    def of(action: str, text: str) -> Rule:
        """From ``host/`` or ``host/path/``; the part from the first slash on must start the url's path."""
        host, _, path = text.partition("/")
        return Rule(action, host, path)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without one or for null."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffixes(host: Column) -> Column:
    """The host and every parent domain."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def rule_table(hosts: DataFrame, rules: list[Rule] | DataFrame) -> DataFrame:
    """``(suffix, size, rule, path, action)`` of the rules, each once."""
    if isinstance(rules, DataFrame):
        host, path = (F.coalesce(F.col(c), F.lit("")) for c in ("host", "path"))
        text = F.concat(host, F.lit("/"), path)
        return rules.filter(F.col("action").isin("allow", "block") & (host != "")).select(
            host.alias("suffix"), (-F.length(text)).alias("size"), text.alias("rule"),
            F.concat(F.lit("/"), path).alias("path"), "action",
        ).distinct()
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules in a list: give them as a table")
    known = [
        F.struct(
            F.lit(r.host).alias("suffix"), F.lit(-len(r.text)).alias("size"), F.lit(r.text).alias("rule"),
            F.lit("/" + r.path).alias("path"), F.lit(r.action).alias("action"),
        )
        for r in dict.fromkeys([*rules, Rule("", "", "")])
    ]
    return hosts.sparkSession.range(1).select(F.inline(F.array(*known))).filter("action != ''")


def host_rules(hosts: DataFrame, rules: list[Rule] | DataFrame) -> DataFrame:
    """``(host, rules)``: the rules whose host is the host or a parent of it, longest first.

    ``hosts`` is distinct. The rules are a list of at most ``MAX_RULES``, or a table ``(action, host,
    path)`` of any size, of which rows without a host or of another action say nothing.
    """
    listed = rule_table(hosts, rules)
    each = hosts.select("host", F.explode(suffixes(F.col("host"))).alias("suffix"))
    met = each.join(listed, "suffix")
    return met.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("size", "rule", "path", "action"))).alias("rules"))


def rule_for(path: Column, rules: Column) -> Column:
    """The first rule whose path starts the given one, as a struct; null without one.

    An empty path counts as ``/``, which it stands for.
    """
    real = F.when(path == "", F.lit("/")).otherwise(path)
    return F.try_element_at(F.filter(rules, lambda r: F.startswith(real, r["path"])), F.lit(1))


def host_links(pages: DataFrame, html_col: str) -> DataFrame:
    """``(src, dst, weight)`` between different hosts: links of the pages of ``host``, counted before the shuffle.

    Links count with their own host (``scheme://host``, ``//host``), others with the host of the
    page's ``<base href>``, if it names one; without it they stay on the page's host.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    address = r"(?i)\s(?:href|src)\s*=\s*[\"']?((?:[a-z][a-z0-9+.-]*:)?//[^\s\"'<>]+)"
    based = F.regexp_extract(html, r"(?i)<base\s[^>]*?href\s*=\s*[\"']?((?:[a-z][a-z0-9+.-]*:)?//[^\s\"'<>]+)", 1)
    # A link is relative if its address names neither host nor scheme.
    relative = F.regexp_count(html, F.lit(r"(?i)<a\s[^>]*?href\s*=\s*[\"']?(?![a-z][a-z0-9+.-]*:|//|[\"'#\s>])"))
    own = F.regexp_extract_all(F.regexp_replace(html, r"(?i)<base\s[^>]*>", ""), F.lit(address), 1)
    there = F.transform(own, lambda url: F.struct(url.alias("url"), F.lit(1).cast("double").alias("n")))
    through = F.when((based != "") & (relative > 0), F.array(F.struct(based.alias("url"), relative.cast("double").alias("n"))))
    found = F.concat(there, F.coalesce(through, F.array().cast("array<struct<url:string,n:double>>")))
    links = pages.select(F.col("host").alias("src"), F.explode(found).alias("link"))
    target = F.when(F.startswith("link.url", F.lit("//")), F.concat(F.lit(":"), "link.url")).otherwise(F.col("link.url"))
    links = links.select("src", host_of(target).alias("dst"), "link.n").filter("dst != '' and src != '' and src != dst")
    return links.groupBy("src", "dst").agg(F.sum("n").alias("weight"))


def spread(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``(host, trust, distrust)`` by personalised PageRank from ``seeds(host, trust, distrust)``.

    Trust follows links, distrust goes against them, from the linked to the linking host. In each
    round a host has its seed and ``damping`` of what its neighbours share by link weight, which is
    personalised PageRank in units of the restart: a seed of 1 without links has 1. Both walks are
    one join a round; hubs are salted.
    """
    ways = edges.select(F.lit(0).alias("way"), F.col("src").alias("host"), F.col("dst").alias("to"), "weight").union(
        edges.select(F.lit(1).alias("way"), F.col("dst").alias("host"), F.col("src").alias("to"), "weight")
    )
    sums = ways.groupBy("way", "host").agg(F.sum("weight").alias("total"))
    ways = salted_join(ways, sums, ["way", "host"], by="to")
    ways = save(ways.select("way", "host", "to", (F.col("weight") / F.col("total")).alias("share")), "ways")
    start = save(
        seeds.select("host", F.col("trust").alias("own_trust"), F.col("distrust").alias("own_distrust")), "seeds"
    )
    start = start.withColumns({"trust": F.col("own_trust"), "distrust": F.col("own_distrust")})
    now = start
    for i in range(rounds):
        value = F.when(F.col("way") == 0, F.col("trust")).otherwise(F.col("distrust"))
        moved = salted_join(ways, now.select("host", "trust", "distrust"), ["host"], by="to", how="inner")
        came = moved.withColumn("given", damping * F.col("share") * value).groupBy(F.col("to").alias("host")).agg(
            F.sum(F.when(F.col("way") == 0, F.col("given")).otherwise(0.0)).alias("more_trust"),
            F.sum(F.when(F.col("way") == 1, F.col("given")).otherwise(0.0)).alias("more_distrust"),
        )
        now = start.drop("trust", "distrust").join(came, "host", "left").select(
            "host", "own_trust", "own_distrust",
            (F.col("own_trust") + F.coalesce("more_trust", F.lit(0.0))).alias("trust"),
            (F.col("own_distrust") + F.coalesce("more_distrust", F.lit(0.0))).alias("distrust"),
        )
        if i % 2 or i == rounds - 1:
            now = save(now, "ranks")
    return now.select("host", "trust", "distrust")


def judge(
    pages: DataFrame, rules: list[Rule] | DataFrame, url_col: str = "url", html_col: str = "html",
    id_col: str = "page_id", threshold: float = THRESHOLD,
) -> DataFrame:
    """``(id, host, path, rule, verdict, trust, distrust)`` per page.

    A page has the action of the longest rule that fits its host or a parent of it and starts its
    path. The others have that of their host: each host's seed of trust is the share of its pages
    that rules allow, of distrust the share they block; both spread over the links, and a host
    whose distrust exceeds its trust by more than ``threshold`` is blocked. Pages without a host
    (null url, no ``://``) meet no rule and no host, and are allowed. Repeated rows are judged alike
    and count as often; a null html has no links. No rows give no rows. Other columns are not looked at.
    """
    rows = pages.select(
        F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"),
        F.col(html_col).alias("html"),
    )
    by_host = host_rules(rows.select("host").distinct().filter("host != ''"), rules)
    ruled = salted_join(rows.drop("html"), by_host, ["host"], by="path")
    ruled = ruled.withColumn("found", rule_for(F.col("path"), F.col("rules"))).drop("rules")
    ruled = save(ruled.select("id", "host", "path", "found.rule", "found.action"), "ruled")
    seeds = ruled.filter("host != ''").groupBy("host").agg(
        F.avg(F.when(F.col("action") == "allow", 1.0).otherwise(0.0)).alias("trust"),
        F.avg(F.when(F.col("action") == "block", 1.0).otherwise(0.0)).alias("distrust"),
    )
    edges = save(host_links(rows.select("host", "html"), "html"), "links")
    linked = edges.select(F.col("src").alias("host")).union(edges.select("dst")).distinct()
    zero = linked.select("host", F.lit(0.0).alias("trust"), F.lit(0.0).alias("distrust"))
    seeds = seeds.union(zero).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
    values = spread(edges, seeds)
    out = salted_join(ruled, values, ["host"], by="path")
    bad = F.coalesce(F.col("distrust") - F.col("trust") > threshold, F.lit(False))
    verdict = F.coalesce("action", F.when(bad, "block").otherwise("allow"))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")
