"""URL filters: prefix rules, and for urls without a rule the trust of their host in the link graph.

Trust and distrust are personalised PageRank vectors over host edges, both computed by DataFrame joins: trust flows
along links from hosts with allowed pages, distrust flows against links from hosts with blocked pages.  A host's weight is
the share of its pages that are allowed (blocked), so both vectors have one scale however many seeds a side has.  A host is
blocked where its distrust exceeds its trust by the given factor.

Defined results: a null url, or one without ``://``, has empty host and path, no rule and is allowed; null html has no
links; repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strokelab.llm.common import lower_ascii, materialize

#: (verdict, host, path prefix)
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty where there is none."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict (null where none fits); rules are a short parameter list."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, prefix in reversed(ordered):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(prefix)
        name = F.when(fits, F.lit(rule_host + prefix)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame, html: str = "html", host: str = "host") -> DataFrame:
    """Distinct links between different hosts: src, dst, n (links).  Relative links stay on their host and give no edge."""
    links = F.regexp_extract_all(F.col(html), F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""), F.lit(1))
    found = pages.where(F.col(html).contains("//")).select(
        F.col(host).alias("src"), F.explode(F.transform(links, lambda u: F.regexp_replace(u, "^//", "http://"))).alias("_u")
    )
    edges = found.select("src", host_of(F.col("_u")).alias("dst"))
    return edges.where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst"))).groupBy("src", "dst").agg(
        F.count(F.lit(1)).alias("n")
    )


def personalised_pagerank(
    seeds: DataFrame, edges: DataFrame, damping: float, tolerance: float, max_rounds: int | None = None, stride: int = 8, whole: bool = True
) -> DataFrame:
    """``host, rank`` for restart weights ``host, w``: rank = (1 - damping) * w + damping * what links bring.

    Links ``src, dst, n`` share out all that their source has, by n; what hosts without links have goes nowhere.  So ranks
    are linear in the weights, and hosts that no link ties together don't change each other's.  With ``whole`` they are
    scaled to sum to one, as if what hosts without links have went back to the seeds.  A round is one join and one
    sum on the edge table; each ``stride`` rounds the vector is written.  What it moves shrinks by ``damping`` a round at
    least; rounds end when all that it can still move is under ``tolerance`` of the weights, which bounds them.
    """
    total = edges.groupBy("src").agg(F.sum("n").alias("out"))
    step = materialize(edges.join(total, "src").select("src", "dst", (F.col("n") / F.col("out")).alias("p")), "edges")
    start = seeds.select("host", (F.col("w") * (1 - damping)).alias("rank"))
    weight = seeds.agg(F.coalesce(F.sum("w"), F.lit(0.0))).first()[0]
    if step.isEmpty():  # nothing can move
        return start.withColumn("rank", F.col("rank") / ((1 - damping) * weight)) if whole and weight else start
    rank = seeds.select("host", F.col("w").alias("rank"))
    shrink = damping**stride
    if max_rounds is None:
        max_rounds = math.ceil(math.log(tolerance * (1 - shrink) / 2) / math.log(damping)) + stride
    for _ in range(math.ceil(max_rounds / stride)):
        before = rank
        for _ in range(stride):
            moved = rank.join(step, rank["host"] == step["src"]).select(F.col("dst").alias("host"), (F.col("rank") * F.col("p") * damping).alias("rank"))
            rank = moved.union(start).groupBy("host").agg(F.sum("rank").alias("rank"))
        rank = materialize(rank, "rank")
        both = rank.union(before.select("host", -F.col("rank"))).groupBy("host").agg(F.sum("rank").alias("moved"), F.sum(F.greatest("rank", F.lit(0.0))).alias("rank"))
        moved, now = both.agg(F.coalesce(F.sum(F.abs("moved")), F.lit(0.0)), F.coalesce(F.sum("rank"), F.lit(0.0))).first()
        if moved * shrink / (1 - shrink) <= tolerance * weight:
            return rank.withColumn("rank", F.col("rank") / now) if whole and now else rank
    raise RuntimeError(f"ranks did not settle in {max_rounds} rounds")


def judge_urls(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    rules=RULES,
    damping: float = 0.85,
    factor: float = 1.0,
    tolerance: float = 1e-6,
    max_rounds: int | None = None,
) -> DataFrame:
    """Per page: key, host, path, rule, verdict, and the host's trust and distrust."""
    lean = pages.select(F.col(key).alias("_key"), F.col(url).alias("_url"), F.col(html).alias("_html"))
    parsed = lean.withColumn("host", host_of(F.col("_url"))).withColumn("path", path_of(F.col("_url")))
    name, verdict = match_rules(F.col("host"), F.col("path"), rules)
    ruled = parsed.withColumn("rule", name).withColumn("_verdict", verdict)
    judged = materialize(ruled.select("_key", "host", "path", "rule", "_verdict"), "urls")
    edges = materialize(host_edges(ruled.select("host", F.col("_html").alias("html"))), "links")

    hosts = judged.where("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("_verdict") == "allow").alias("good"),
        F.count_if(F.col("_verdict") == "block").alias("bad"),
    )
    hosts = materialize(hosts, "hosts")

    # Both vectors in one: trust over links, distrust over links turned round, hosts marked by the side they are on.
    both = edges.select(F.concat(F.lit("+"), "src").alias("src"), F.concat(F.lit("+"), "dst").alias("dst"), "n").union(
        edges.select(F.concat(F.lit("-"), "dst").alias("src"), F.concat(F.lit("-"), "src").alias("dst"), "n")
    )
    sides = F.array(F.struct(F.lit("+").alias("side"), F.col("good").alias("k")), F.struct(F.lit("-").alias("side"), F.col("bad").alias("k")))
    seeds = materialize(
        hosts.select("host", "n", F.explode(sides).alias("s")).where("s.k > 0").select(F.concat("s.side", "host").alias("host"), (F.col("s.k") / F.col("n")).alias("w")), "seeds"
    )
    ranks = personalised_pagerank(seeds, both, damping, tolerance, max_rounds, whole=False)
    side, host = F.substring("host", 1, 1), F.expr("substring(host, 2)")
    scores = (
        ranks.groupBy(host.alias("host"))
        .agg(F.coalesce(F.sum(F.when(side == "+", F.col("rank"))), F.lit(0.0)).alias("trust"), F.coalesce(F.sum(F.when(side == "-", F.col("rank"))), F.lit(0.0)).alias("distrust"))
        .withColumn("_blocked", F.col("distrust") > F.col("trust") * factor)
    )
    return judged.join(scores, "host", "left").select(
        F.col("_key").alias(key),
        "host",
        "path",
        "rule",
        F.coalesce("_verdict", F.when(F.col("_blocked"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
