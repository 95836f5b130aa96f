"""Verdicts on urls: rules for hosts and paths, and beyond them trust and distrust that spread over links between hosts.

Trust is a personalised PageRank from hosts that rules mostly allow, along links; distrust one from hosts that rules mostly
block, against links: who links to bad hosts gains distrust. Both are DataFrame steps over edges summed per pair of hosts,
written to the shared folder each round.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..materialize import Scratch, broadcast_if_bounded, snapshot
from .common import table
from .decontaminate import LOWER, UPPER

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
DAMPING, TOLERANCE = 0.85, 1e-9
MOST_ROUNDS = 5000          # at a damping of 0.85 movements fall below the tolerance within 130 rounds on any graph
MARGIN = 0.0        # a host is blocked if its distrust exceeds its trust by more
LINKS = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/"'?#>\s]+)"""


def ascii_lower(text) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_of(url) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return ascii_lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """``(rule, verdict)`` of the longest rule that fits: its host or a subdomain, and the start of the path. Null if none
    does. Of rules that are equally long the first wins. The rules are a parameter of the plan."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_links(pages: DataFrame) -> DataFrame:
    """``pages(host, html)`` -> ``(src, dst, n)``: links of pages to other hosts, summed per pair."""
    found = pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all(
        F.coalesce("html", F.lit("")), F.lit(LINKS), F.lit(1))).alias("link"))
    return found.select("src", ascii_lower(F.col("link")).alias("dst")).where("src <> '' and dst <> '' and src <> dst").groupBy(
        "src", "dst").agg(F.count("*").alias("n"))


def propagate(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, rounds: int = MOST_ROUNDS,
              tolerance: float = TOLERANCE) -> DataFrame:
    """``seeds(host, good, bad)``, ``links(src, dst, n)`` -> ``(host, trust, distrust)``.

    ``good`` and ``bad`` are each a distribution over hosts, or all zero. A round keeps 1 - damping of it and passes the
    rest on: trust along links by their share of the source's, distrust against links by their share of the target's. What
    reaches a host without further links ends there. Stops when no trust has moved by more than ``tolerance`` times the greatest
    ``good``, and no distrust by more than that share of the greatest ``bad``; raises if ``rounds`` don't suffice.
    """
    total_out = links.groupBy("src").agg(F.sum("n").alias("out_n"))
    total_in = links.groupBy("dst").agg(F.sum("n").alias("in_n"))
    edges = snapshot(links.join(total_out, "src").join(total_in, "dst").select(
        "src", "dst", (F.col("n") / F.col("out_n")).alias("forth"), (F.col("n") / F.col("in_n")).alias("back")), "host-edges")
    known = edges.select(F.col("src").alias("host")).unionByName(edges.select(F.col("dst").alias("host"))).unionByName(
        seeds.select("host")).distinct()
    seeds = snapshot(known.join(seeds, "host", "left").na.fill(0.0, ["good", "bad"]), "host-seeds")
    most = seeds.agg(F.max("good"), F.max("bad")).first()
    scratch = Scratch(seeds.sparkSession)
    ranks, before = seeds.select("host", "good", "bad", F.col("good").alias("trust"), F.col("bad").alias("distrust")), None
    for _ in range(rounds):
        now = ranks.select("host", "trust", "distrust")
        forth = edges.join(now, edges["src"] == now["host"]).select(
            F.col("dst").alias("host"), (F.col("trust") * F.col("forth")).alias("t"), F.lit(0.0).alias("d"))
        back = edges.join(now, edges["dst"] == now["host"]).select(
            F.col("src").alias("host"), F.lit(0.0).alias("t"), (F.col("distrust") * F.col("back")).alias("d"))
        got = forth.unionByName(back).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))

        def kept(seed, gained):
            return (1 - damping) * F.col(seed) + damping * F.coalesce(gained, F.lit(0.0))
        moved = scratch.keep(ranks.join(got, "host", "left").select(
            "host", "good", "bad", kept("good", "t").alias("trust"), kept("bad", "d").alias("distrust"),
            F.abs(kept("good", "t") - F.col("trust")).alias("t_move"), F.abs(kept("bad", "d") - F.col("distrust")).alias("d_move")), "host-ranks")
        moves = moved.agg(F.max("t_move"), F.max("d_move")).first()
        scratch.drop(before)
        ranks, before = moved.drop("t_move", "d_move"), moved
        if moves[0] is None or all(move <= tolerance * (top or 0.0) for move, top in zip(moves, most)):
            return ranks.select("host", "trust", "distrust")
    raise RuntimeError(f"trust and distrust have not converged in {rounds} rounds")


def judge(pages: DataFrame, rules=RULES, margin: float = MARGIN) -> DataFrame:
    """``pages(page_id, url, html)`` -> ``(page_id, host, path, rule, verdict)``, one row per row of ``pages``.

    Where no rule fits, a page gets the verdict of its host: block if distrust exceeds trust by more than ``margin``, else
    allow; so do hosts that no link reaches, and pages without a host. A host is a trusted (blocked) seed if rules allow
    (block) more than half of its pages; seeds weigh the same. Null urls, and urls without ``://``, have neither host nor
    path. Null html has no links. An empty table gives no rows.
    """
    read = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"), "html")
    judged = read.select("page_id", "host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("found")).select(
        "page_id", "host", "path", "found.rule", "found.verdict")

    def share(verdict):
        return F.avg(F.when(F.col("verdict") == verdict, 1.0).otherwise(0.0)) > 0.5
    marked = snapshot(judged.where("host <> ''").groupBy("host").agg(
        share("allow").cast("double").alias("good"), share("block").cast("double").alias("bad")), "host-marks")
    totals = marked.agg(F.sum("good"), F.sum("bad")).first()
    seeds = marked.select("host", *[(F.col(c) / F.lit(total or 1.0)).alias(c) for c, total in zip(("good", "bad"), totals)])
    ranks = propagate(seeds, host_links(read))
    blocked = snapshot(ranks.where(F.col("distrust") - F.col("trust") > margin).select("host"), "blocked-hosts")
    by_host = broadcast_if_bounded(blocked.withColumn("blocked", F.lit("block")))
    return judged.join(by_host, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "blocked", F.lit("allow")).alias("verdict"))


def op7_hosts(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages"))


def _sql_rules() -> str:
    """The longest rule that fits, as SQL: (rule, verdict)."""
    tests = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = ["(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')".format(*r) for r in tests]
    return ", ".join(f"CASE {' '.join(f'WHEN {f} THEN {chr(39)}{value(r)}{chr(39)}' for f, r in zip(fits, tests))} END AS {name}"
                     for name, value in (("rule", lambda r: r[0] + r[1]), ("verdict", lambda r: r[2])))


ORACLE = f"""
WITH RECURSIVE p AS (SELECT page_id, coalesce(html, '') AS html, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
j AS (SELECT page_id, host, path, html, {_sql_rules()} FROM p),
m AS (SELECT host, avg(CASE WHEN verdict = 'allow' THEN 1.0 ELSE 0.0 END) > 0.5 AS good,
             avg(CASE WHEN verdict = 'block' THEN 1.0 ELSE 0.0 END) > 0.5 AS bad FROM j WHERE host <> '' GROUP BY host),
l AS (SELECT src, dst, count(*) AS n FROM (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{LINKS.replace("'", "''")}', 1)), '{UPPER}', '{LOWER}') AS dst FROM j)
      WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
e AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS forth, n / sum(n) OVER (PARTITION BY dst) AS back FROM l),
h AS (SELECT host, coalesce(CAST(good AS INTEGER) / nullif((SELECT count(*) FROM m WHERE good), 0), 0.0) AS good,
             coalesce(CAST(bad AS INTEGER) / nullif((SELECT count(*) FROM m WHERE bad), 0), 0.0) AS bad
      FROM (SELECT src AS host FROM l UNION SELECT dst FROM l UNION SELECT host FROM m) LEFT JOIN m USING (host)),
r(n, host, t, d) AS (
    SELECT 0, host, good, bad FROM h
    UNION ALL
    SELECT (SELECT max(n) FROM r) + 1, h.host, 0.15 * h.good + 0.85 * coalesce(f.t, 0), 0.15 * h.bad + 0.85 * coalesce(b.d, 0)
    FROM h LEFT JOIN (SELECT e.dst AS host, sum(r.t * e.forth) AS t FROM e JOIN r ON r.host = e.src GROUP BY e.dst) f ON f.host = h.host
           LEFT JOIN (SELECT e.src AS host, sum(r.d * e.back) AS d FROM e JOIN r ON r.host = e.dst GROUP BY e.src) b ON b.host = h.host
    WHERE (SELECT max(n) FROM r) < 150),
b AS (SELECT host FROM r WHERE n = 150 AND d > t)
SELECT page_id, j.host, path, rule, coalesce(verdict, CASE WHEN b.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN b ON b.host = j.host
"""
