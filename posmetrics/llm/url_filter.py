"""URL filters: explicit rules first, link-graph propagation for the rest, in SQL only.

Hosts are nodes, links between pages of different hosts are edges, weighted by their
number. Trust starts at hosts whose pages an allow rule covers and follows the links
(personalised PageRank); distrust starts at hosts whose pages a block rule covers and goes
against them: who links to a blocked host shares its name. A host is blocked when distrust
is at least ``THRESHOLD`` of both together.

Edges are summed per pair of hosts before anything is joined, so a host with very many
pages or links is one row per partner. Each few steps are written to the shared folder and
compared with the ranks written before, until no host is new and no rank has changed by more
than ``TOLERANCE`` of it; so hosts at any distance are reached, and small ranks are as exact
as large ones. Damping makes it end.

Defined cases: a null url, or one without ``://``, has an empty host and path, no rule, and
is allowed; a null or empty page has no links; hosts that nothing reaches are allowed;
repeated rows and null ids each get their own row; an empty table gives no row; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posmetrics.llm.common import table, written

# fixed values: verdict, host and path of each rule
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
DAMPING = 0.85
TOLERANCE = 1e-6  # least change of a rank, as a share of it, for which it goes on
WRITE_EVERY = 4
THRESHOLD = 0.5
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def split_url(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host and path of a url."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3, F.length(url))
    host = F.regexp_extract(rest, r"^[^/?#]*+", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*+", 0)
    known = F.coalesce(at > 0, F.lit(False))
    lower = F.translate(host, _UPPER, _UPPER.lower())
    return F.when(known, lower).otherwise(""), F.when(known, path).otherwise("")


def rule_of(host: F.Column, path: F.Column, rules=RULES) -> F.Column:
    """The longest fitting rule as a struct (name, verdict), else null."""
    out = None
    for verdict, own, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(start)
        rule = F.struct(F.lit(own + start).alias("name"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, rule) if out is None else out.when(fits, rule)
    return out if out is not None else F.lit(None).cast("struct<name:string,verdict:string>")


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``src, dst, weight``: links between different hosts, summed."""
    host, _ = split_url(F.col(url_col))
    links = pages.select(
        host.alias("src"), F.explode(F.regexp_extract_all(html_col, F.lit(_HREF), F.lit(1))).alias("link")
    )
    to = links.select("src", F.translate("link", _UPPER, _UPPER.lower()).alias("dst"))
    return (
        to.where("src <> '' and dst <> '' and src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").cast("double").alias("weight"))
    )


def propagate(
    edges: DataFrame,
    seeds: DataFrame,
    steps: int | None = None,
    damping: float = DAMPING,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Ranks ``kind, host, rank``, until they have settled or after so many steps.
    ``seeds``: kind, host, share (shares of a kind sum to 1). Both kinds go in one pass;
    distrust runs on reversed edges."""
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionAll(
        edges.select(F.lit("distrust").alias("kind"), "dst", "src", "weight")
    )
    sent = both.groupBy("kind", "src").agg(F.sum("weight").alias("total"))
    share = written(
        both.join(sent, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("total")).alias("part")),
        "links",
    )
    seeds = written(seeds.select("kind", "host", "share"), "seeds")
    start = seeds.select("kind", "host", (F.col("share") * (1 - damping)).alias("rank"))
    # undamped at first, so what has not settled yet is larger than it will be
    rank = last = seeds.select("kind", "host", F.col("share").alias("rank"))
    step = 0
    while step != steps:
        passed = rank.withColumnRenamed("host", "src").join(share, ["kind", "src"]).select(
            "kind", F.col("dst").alias("host"), (F.col("rank") * F.col("part") * damping).alias("rank")
        )
        rank = passed.unionAll(start).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        step += 1
        if step % WRITE_EVERY == 0:
            rank = written(rank, "ranks")
            if steps is None and _change(last, rank) <= tolerance:
                break
            last = rank
    return rank


def _change(before: DataFrame, after: DataFrame) -> float:
    """The largest change of a rank as a share of it, 1 for a host that is new."""
    old = before.select("kind", "host", F.col("rank").alias("old"))
    moved = F.abs(F.col("rank") - F.coalesce("old", F.lit(0.0))) / F.col("rank")
    return after.join(old, ["kind", "host"], "left").agg(F.max(moved)).first()[0] or 0.0


def judge(
    pages: DataFrame,
    rules=RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, distrust`` of every page; the last is the
    host's share of distrust, null where nothing reached it."""
    host, path = split_url(F.col(url_col))
    found = (
        pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
        .withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    )
    counted = (
        found.where("rule is not null")
        .groupBy(F.when(F.col("rule.verdict") == "allow", "trust").otherwise("distrust").alias("kind"), "host")
        .agg(F.count("*").alias("n"))
    )
    # two rows: the seeds' total of either kind
    total = counted.groupBy("kind").agg(F.sum("n").alias("total"))
    seeds = counted.join(total, "kind").select("kind", "host", (F.col("n") / F.col("total")).alias("share"))
    ranks = propagate(host_edges(pages, url_col, html_col), seeds)
    bad = F.sum(F.when(F.col("kind") == "distrust", F.col("rank")).otherwise(0.0))
    scores = ranks.groupBy("host").agg(F.round(bad / F.sum("rank"), 9).alias("distrust"))
    method = F.when(F.col("distrust") >= threshold, "block").otherwise("allow")
    return found.join(scores, "host", "left").select(
        "page_id",
        "host",
        "path",
        F.col("rule.name").alias("rule"),
        F.coalesce("rule.verdict", method).alias("verdict"),
        "distrust",
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
