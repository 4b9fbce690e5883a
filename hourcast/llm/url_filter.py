"""URL filters: host and path rules, and for the rest a verdict by link-graph propagation.

Method, in DataFrame functions only:

1. :func:`located` splits every url and finds its longest rule.
2. :func:`host_graph` gives a weighted graph of hosts.  A page links its host to each
   other host that its html names in ``href`` or ``src`` (once per page), and once to
   itself; a domain and the domain above it, of two labels at least, are linked both
   ways by the pages below the former, since one owner commonly holds both.
3. :func:`propagate` walks two vectors over it: *trust* starts from the pages that a
   rule allows and follows the links; *distrust* starts from the pages that a rule
   blocks and follows the links backwards, to the hosts that link there.  Each round
   keeps ``DAMPING`` of the moved mass and adds the rest of the seeds, as personalised
   PageRank does.
4. A host whose distrust exceeds its trust by more than ``MARGIN`` of its pages is
   blocked (:func:`host_verdicts`); that holds for its pages without a rule.

Mass is counted in integers (``UNIT`` per page) and rounded down edge by edge, so the
sums do not depend on the order of rows, and a recomputed task gives the same result.

Hot hosts: links are counted with partial aggregation before they are shuffled, and
edges and pages of a host with more than a 1000th of the rows are dealt over several
parts, to each of which the host's row is copied (``_frames.hot_parts``).  Every
``ROUNDS_PER_WRITE`` rounds the vectors are written to the shared folder.

Defined results: a null url and one without ``://`` have an empty host and path, no
rule, no place in the graph, and verdict allow; null html has no links; repeated pages
count each; an empty table gives an empty table.  :func:`judge` keeps all columns of
its input and replaces those of the names it adds.  ``rules`` is a list that the caller
writes and every row is tested against, meant for at most some hundred.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.llm._frames import fresh, hot_parts, in_every_part, quoted, with_part, without, written

ALLOW, BLOCK = "allow", "block"
UNIT = 1_000_000
DAMPING = 0.85
ROUNDS = 12
ROUNDS_PER_WRITE = 4
#: Share of a host's pages by which distrust must exceed trust.
MARGIN = 0.25

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hosts that a page names in its links; links without a host stay on their own.
LINK = r"""(?i)(?:href|src)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


class Rule(NamedTuple):
    """A rule fits ``host`` and its subdomains where the path begins with ``path``."""
    verdict: str
    host: str
    path: str


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What stands after the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, of those as long that of the
    longest host, and of equal ones the blocking one; null if none fits."""
    order = sorted(rules, key=lambda r: (-len(r.host + r.path), -len(r.host), r.verdict == ALLOW))
    hit = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in reversed(order):
        hit = F.when(fits(r, host, path),
                     F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(hit)
    return hit


def located(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (both null without a rule)."""
    base = without(pages, "host", "path", "rule", "verdict")
    link, hit = fresh(base, "page_url", "page_hit")
    names = [quoted(c) for c in base.columns]
    split = (pages.select(*names, F.col(url).alias(link))
             .withColumns({"host": host_of(F.col(link)), "path": path_of(F.col(link))}))
    return (split.withColumn(hit, longest_rule(rules, F.col("host"), F.col("path")))
            .select(*names, "host", "path", F.col(hit)["rule"].alias("rule"), F.col(hit)["verdict"].alias("verdict")))


def domains(host: Column) -> Column:
    """The host and the domains above it, down to two labels; a number is no domain name."""
    labels = F.split(host, r"\.")
    up = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
                     lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    named = ~F.element_at(labels, -1).rlike(r"^[0-9]*$")
    return F.when((F.size(labels) > 2) & named, up).otherwise(F.array(host))


def host_graph(pages: DataFrame, rules: Sequence[Rule], url: str = "url", html: str = "html"):
    """(nodes, edges): nodes are (host, n_pages, allowed, blocked), one per host of the
    graph; edges (src, dst, weight), one per pair, each host with an edge to itself."""
    # one pass over the html: a row per page and host that it links to, itself included
    links = F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(LINK), 1), lower_ascii))
    seen = (located(pages.select(F.col(url).alias("url"), F.col(html).alias("html")), rules)
            .filter(F.col("host") != "")
            .select(F.col("host").alias("src"), "verdict",
                    F.explode(F.array_union(F.array("host"), links)).alias("dst")))
    own = F.col("src") == F.col("dst")
    counts = written(seen.groupBy("src", "dst").agg(
        F.count(F.lit(1)).alias("weight"),
        F.count_if(own & (F.col("verdict") == ALLOW)).alias("allowed"),
        F.count_if(own & (F.col("verdict") == BLOCK)).alias("blocked")), "host-links")
    with_pages = counts.filter(own)
    below = (with_pages.select(F.explode(domains(F.col("src"))).alias("d"), "weight")
             .groupBy("d").agg(F.sum("weight").alias("weight")))
    up = below.select("d", "weight", domains(F.col("d")).alias("a")).filter(F.size("a") > 1) \
        .select("d", F.col("a")[1].alias("above"), "weight")
    across = (counts.select("src", "dst", "weight")
              .unionByName(up.select(F.col("d").alias("src"), F.col("above").alias("dst"), "weight"))
              .unionByName(up.select(F.col("above").alias("src"), F.col("d").alias("dst"), "weight")))
    hosts = (across.select(F.explode(F.array("src", "dst")).alias("host"),
                           F.lit(0).cast("long").alias("n_pages"),
                           F.lit(0).cast("long").alias("allowed"), F.lit(0).cast("long").alias("blocked"))
             .unionByName(with_pages.select(F.col("src").alias("host"), F.col("weight").alias("n_pages"),
                                            "allowed", "blocked")))
    nodes = written(hosts.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n_pages", "allowed", "blocked")]),
                    "hosts")
    loops = nodes.filter("n_pages = 0").select(F.col("host").alias("src"), F.col("host").alias("dst"),
                                               F.lit(1).cast("long").alias("weight"))
    edges = across.unionByName(loops).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    return nodes, written(edges, "host-edges")


def _moves(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((node, part, to, share), hot nodes): how a node's mass is split in a round.  A node
    is a host with ``>`` (trust, along the links) or ``<`` (distrust, against them) before it."""
    out = edges.select(F.concat(F.lit(">"), "src").alias("node"), F.concat(F.lit(">"), "dst").alias("to"), "weight") \
        .unionByName(edges.select(F.concat(F.lit("<"), "dst").alias("node"), F.concat(F.lit("<"), "src").alias("to"),
                                  "weight"))
    hot = hot_parts(out, "node")
    dealt = with_part(out, hot, "node", ["to"], "part")
    totals = in_every_part(out.groupBy("node").agg(F.sum("weight").alias("total")), hot, "node", "part")
    shares = dealt.join(totals, ["node", "part"]).select(
        "node", "part", "to", (F.col("weight") / F.col("total")).alias("share"))
    return written(shares, "host-moves"), hot


def propagate(nodes: DataFrame, edges: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """``nodes`` with ``trust`` and ``distrust``, in ``UNIT`` per page."""
    moves, hot = _moves(edges)
    seeds = written(nodes.select(F.explode(F.array(
        F.struct(F.concat(F.lit(">"), "host").alias("node"), (F.col("allowed") * UNIT).alias("mass")),
        F.struct(F.concat(F.lit("<"), "host").alias("node"), (F.col("blocked") * UNIT).alias("mass")))).alias("s"))
        .select("s.*").filter("mass > 0"), "host-seeds")
    again = seeds.select("node", F.floor(F.col("mass") * (1 - damping)).alias("mass"))
    state = seeds
    for i in range(rounds):
        flow = moves.join(in_every_part(state, hot, "node", "part"), ["node", "part"]).select(
            F.col("to").alias("node"), F.floor(F.col("mass") * damping * F.col("share")).alias("mass"))
        state = flow.unionByName(again).groupBy("node").agg(F.sum("mass").alias("mass")).filter("mass > 0")
        if (i + 1) % ROUNDS_PER_WRITE == 0:
            state = written(state, "host-mass")
    mass = state.select(F.substring("node", 2, 1 << 30).alias("host"),
                        F.when(F.startswith("node", F.lit(">")), F.col("mass")).alias("trust"),
                        F.when(F.startswith("node", F.lit("<")), F.col("mass")).alias("distrust"))
    columns = ["n_pages", "allowed", "blocked", "trust", "distrust"]
    zero = F.lit(0).cast("long")
    rows = nodes.withColumns({"trust": zero, "distrust": zero}).unionByName(
        mass.withColumns({"n_pages": zero, "allowed": zero, "blocked": zero}))
    return rows.groupBy("host").agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in columns])


def host_verdicts(scored: DataFrame, margin: float = MARGIN) -> DataFrame:
    """``scored`` hosts with ``verdict``."""
    excess = F.col("distrust") - F.col("trust")
    return scored.withColumn("verdict", F.when(excess > F.floor(F.col("n_pages") * (margin * UNIT)), BLOCK)
                             .otherwise(ALLOW))


def judge(pages: DataFrame, rules: Sequence[Rule], verdicts: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``: that of the rule, or
    else of the host in ``verdicts``."""
    rows = located(pages, rules, url)
    names = [quoted(c) for c in rows.columns if c not in ("host", "path", "rule", "verdict")]
    key, part, held = fresh(rows, "host_key", "host_part", "host_blocked")
    # equal rows stay together; all others of a hot host are spread
    spread = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    open_rows = rows.filter(F.col("rule").isNull()).withColumn(key, F.col("host"))
    hot = hot_parts(open_rows, key)
    blocked = in_every_part(verdicts.filter(F.col("verdict") == BLOCK).select(F.col("host").alias(key)),
                            hot, key, part).withColumn(held, F.lit(True))
    dealt = with_part(open_rows, hot, key, spread, part)
    joined = dealt.join(blocked, [key, part], "left")
    settled = joined.select(*names, "host", "path", "rule",
                            F.when(F.col(held), BLOCK).otherwise(ALLOW).alias("verdict"))
    return settled.unionByName(rows.filter(F.col("rule").isNotNull())
                               .select(*names, "host", "path", "rule", "verdict"))


def url_verdicts(pages: DataFrame, rules: Sequence[Rule], url: str = "url", html: str = "html") -> DataFrame:
    """Every page judged: graph and propagation from all pages, then :func:`judge` for
    the columns of ``pages`` other than ``html``."""
    scored = propagate(*host_graph(pages, rules, url, html))
    verdicts = written(host_verdicts(scored), "host-verdicts")
    return judge(without(pages, html), rules, verdicts, url)
