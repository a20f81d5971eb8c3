"""URL filter: list rules, and a tree of path templates for each host.

A path's segments are generalised in two steps. Segments that look like
numbers, hashes or dates become class wildcards where they stand, with their
ending; then, level by level, a node with more than ``most_children`` different
segments has them replaced by ``*``, and endings of wildcards by ``.*``. Levels
are gone down for as long as a node has so many shapes below it, as only then
any can be replaced. Sibling branches of one host whose continuations and
labelled shares don't differ significantly are merged. A template is blocked
if the smoothed share of blocked pages among its labelled pages reaches
``purity``. Labelled pages are those that a list rule decides.

Everything up to the merging works on counts of (host, path shape) summed
before the shuffle. A branch of at most ``in_one_task`` templates is merged in
one task; of a larger one a task merges the children of its root only, from
counts by child and next segment, and each merged child is a branch of its
own. Both ways give the same templates, so the number only deals out the work.

Defined results: null urls and urls without ``://`` have empty host and path
and are judged like any other; repeated rows get equal rows; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphshed.llm.common import cut

BLOCK, ALLOW = "block", "allow"

MOST_CHILDREN = 32
#: Templates of a branch that one task merges; larger ones are merged level by level.
IN_ONE_TASK = 2000
#: Blocked share from which a template is blocked; pseudo-counts of blocked and allowed pages.
PURITY, PSEUDO_BLOCKED, PSEUDO_ALLOWED = 0.8, 0.5, 1.5
#: Significance at which two branches are told apart.
ALPHA = 0.01


@dataclass(frozen=True)
class Rule:
    """Decides pages of a host and its subdomains whose path starts with a prefix."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rules(*lines: tuple[str, str]) -> list[Rule]:
    """(verdict, host/path) pairs as rules."""
    return [Rule(verdict, *_at_slash(text)) for verdict, text in lines]


def _at_slash(text: str) -> tuple[str, str]:
    host, slash, path = text.partition("/")
    return host, slash + path


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, listed: list[Rule]) -> tuple[Column, Column]:
    """(text, verdict) of the longest fitting rule, null if none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(listed, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


#: A class wildcard with its ending.
CLASS = r"^(\{(?:date|n|hex|id)\})(\.[A-Za-z]{1,5})?$"


def shape(path: Column) -> Column:
    """The path's segments, with class wildcards. A backslash tells a literal segment that begins with a brace from them."""

    def general(segment: Column) -> Column:
        ending = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1)
        stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
        return F.concat(
            F.when(stem.rlike(r"^[0-9]{4}-[0-9]{2}(?:-[0-9]{2})?$"), F.lit("{date}"))
            .when(stem.rlike("^[0-9]+$"), F.lit("{n}"))
            .when(stem.rlike("^[0-9a-fA-F-]{16,}$"), F.lit("{hex}"))
            .when(stem.rlike("[0-9]") & (F.length(stem) >= 12), F.lit("{id}"))
            .when(F.startswith(stem, F.lit("{")), F.concat(F.lit("\\"), stem))
            .otherwise(stem),
            ending,
        )

    return F.transform(F.filter(F.split(path, "/", -1), lambda s: s != ""), general)


def widened(shapes: DataFrame, most_children: int = MOST_CHILDREN) -> DataFrame:
    """(host, raw, n, blocked, allowed, template): the shapes with crowded nodes replaced by ``*``, level by level.

    A node of few shapes has no crowded node below it: its shapes are done.
    """
    rest, done, level = shapes.withColumn("template", F.lit("")), [], 0
    columns = [c for c in rest.columns if c != "segments"]
    while True:
        here = rest.withColumn("child", F.get("segments", F.lit(level)))
        kinds = here.groupBy("host", "template", "child").agg(F.count(F.lit(1)).alias("shapes"))
        nodes = kinds.groupBy("host", "template").agg(F.sum("shapes").alias("shapes"), F.count("child").alias("kinds")).where(F.col("shapes") > most_children)
        # Cut, so that the join deals both sides anew and can split the rows of a crowded node.
        joined = cut(here.join(cut(nodes), ["host", "template"], "left"))
        left = F.slice("segments", level + 1, F.greatest(F.size("segments") - level, F.lit(0)))
        ended = joined.where("kinds is null or child is null")
        done.append(ended.withColumn("template", F.concat("template", F.array_join(F.transform(left, lambda s: F.concat(F.lit("/"), s)), ""))).select(*columns))
        rest = joined.where("kinds is not null and child is not null")
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, done)
        known = F.regexp_extract("child", CLASS, 1)
        wide = F.when(known == "", "*").when(F.regexp_extract("child", CLASS, 2) == "", known).otherwise(F.concat(known, F.lit(".*")))
        segment = F.when(F.col("kinds") > most_children, wide).otherwise(F.col("child"))
        rest = rest.withColumn("template", F.concat("template", F.lit("/"), segment)).select(*columns, "segments")
        level += 1


class Node:
    """A branch of a host's template tree, with counts of all pages below it."""

    def __init__(self):
        self.children: dict[str, Node] = {}
        self.n = self.blocked = self.allowed = 0
        self.ends: list[str] = []  # templates that end here
        self.names: list[str] = []  # of the siblings merged into this one, its own first

    def add(self, segments: list[str], template: str, n: int, blocked: int, allowed: int) -> None:
        node = self
        for segment in [None, *segments]:
            if segment is not None:
                node = node.children.setdefault(segment, Node())
            node.n, node.blocked, node.allowed = node.n + n, node.blocked + blocked, node.allowed + allowed
        node.ends.append(template)

    def continuations(self) -> dict[str, int]:
        """Pages by next segment; those that end here under the empty one."""
        out = {name: child.n for name, child in self.children.items()}
        rest = self.n - sum(out.values())
        return out | ({"": rest} if rest else {})

    def absorb(self, other: Node) -> None:
        """Adds the other branch, node by node. Paths can be deep, so nothing here calls itself."""
        todo = [(self, other)]
        while todo:
            own, more = todo.pop()
            own.n, own.blocked, own.allowed = own.n + more.n, own.blocked + more.blocked, own.allowed + more.allowed
            own.ends += more.ends
            for name, child in more.children.items():
                if name in own.children:
                    todo.append((own.children[name], child))
                else:
                    own.children[name] = child

    def merge_children(self) -> None:
        """Merges similar children, from the largest on, and keeps each under the name of its largest."""
        kept: list[Node] = []
        for name, child in sorted(self.children.items(), key=lambda x: (-x[1].n, x[0])):
            like = next((k for k in kept if similar(k, child)), None)
            if like is None:
                child.names = [name]
                kept.append(child)
            else:
                like.names.append(name)
                like.absorb(child)
        self.children = {child.names[0]: child for child in kept}

    def merge(self) -> None:
        """Merges similar children, then goes down."""
        todo = [self]
        while todo:
            node = todo.pop()
            node.merge_children()
            todo += node.children.values()

    def templates(self, above: str = ""):
        """(merged template, the templates that end in it)"""
        todo = [(self, None)]  # a node, and the names above it as (names, those above them)
        while todo:
            node, path = todo.pop()
            if node.ends:
                names, at = [], path
                while at:
                    names.append(at[0])
                    at = at[1]
                yield "".join([above, *reversed(names)]) or "/", node.ends
            todo += [(child, ("/" + "|".join(child.names), path)) for child in node.children.values()]


def g_test(a: dict[str, int], b: dict[str, int]) -> float:
    """p-value of the hypothesis that two sets of counts have one distribution."""
    na, nb = sum(a.values()), sum(b.values())
    keys = set(a) | set(b)
    if len(keys) < 2 or not na or not nb:
        return 1.0
    g = 0.0
    for k in keys:
        both = a.get(k, 0) + b.get(k, 0)
        for seen, total in ((a.get(k, 0), na), (b.get(k, 0), nb)):
            if seen:
                g += 2 * seen * math.log(seen * (na + nb) / (both * total))
    # Wilson and Hilferty's approximation of the chi-squared tail.
    k = len(keys) - 1
    z = ((max(g, 0) / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    return 0.5 * math.erfc(z / math.sqrt(2))


def similar(a: Node, b: Node) -> bool:
    """Whether neither the continuations nor the labelled shares of two branches differ significantly."""
    if g_test({"b": a.blocked, "a": a.allowed}, {"b": b.blocked, "a": b.allowed}) < ALPHA:
        return False
    return g_test(a.continuations(), b.continuations()) >= ALPHA


def purity(blocked: int, allowed: int) -> float:
    return (blocked + PSEUDO_BLOCKED) / (blocked + allowed + PSEUDO_BLOCKED + PSEUDO_ALLOWED)


VERDICTS = "host string, template string, merged string, share double"


def merge_branch(rows: pd.DataFrame) -> pd.DataFrame:
    """A branch's templates with the merged template that each belongs to and its smoothed purity."""
    root = Node()
    for r in rows.sort_values("template").itertuples():
        root.add(list(r.left), r.template, r.n, r.blocked, r.allowed)
    root.merge()
    found = []
    counts = {r.template: (r.blocked, r.allowed) for r in rows.itertuples()}
    for merged, ends in root.templates(rows.shown.iloc[0]):
        share = purity(*map(sum, zip(*(counts[t] for t in ends))))
        found += [(rows.host.iloc[0], t, merged, share) for t in ends]
    return pd.DataFrame(found, columns=["host", "template", "merged", "share"])


MERGED_CHILDREN = "host string, node string, child string, largest string, names string"


def merge_siblings(rows: pd.DataFrame) -> pd.DataFrame:
    """The children of a node, from counts by child and next segment, with the name of the largest of those each is merged with and all their names."""
    root = Node()
    for r in rows.itertuples():
        root.add([r.child, r.next] if r.next else [r.child], "", r.n, r.blocked, r.allowed)
    root.merge_children()
    found = [(name, child.names[0], "|".join(child.names)) for child in root.children.values() for name in child.names]
    return pd.DataFrame([(rows.host.iloc[0], rows.node.iloc[0], *x) for x in found], columns=["host", "node", "child", "largest", "names"])


def merged(templates: DataFrame, in_one_task: int = IN_ONE_TASK) -> DataFrame:
    """(host, template, merged, share) of every template.

    ``node`` and ``shown`` are the path of the branch that a template is in, by
    the largest names and by all names; ``left`` is what follows. A round ends
    the branches that fit a task and takes the others down by one level.
    """
    at, counts = ["host", "node"], ("n", "blocked", "allowed")
    rest = templates.withColumns({"node": F.lit(""), "shown": F.lit(""), "left": F.filter(F.split("template", "/"), lambda s: s != "")})
    done: list[DataFrame] = []
    while True:
        large = cut(rest.groupBy(*at).count().where(F.col("count") > in_one_task).select(*at))
        done.append(rest.join(large, at, "left_anti").groupBy(*at).applyInPandas(merge_branch, VERDICTS))
        if large.isEmpty():
            break
        here = cut(rest.join(large, at, "left_semi"))
        ended = here.where(F.size("left") == 0)
        pure = ended.groupBy(*at).agg(_share(F.sum("blocked"), F.sum("allowed")).alias("share"))
        done.append(ended.join(pure, at).select("host", "template", F.when(F.col("shown") == "", "/").otherwise(F.col("shown")).alias("merged"), "share"))
        below = here.where(F.size("left") > 0).withColumns({"child": F.get("left", F.lit(0)), "next": F.coalesce(F.get("left", F.lit(1)), F.lit(""))})
        branches = below.groupBy(*at, "child", "next").agg(*(F.sum(c).alias(c) for c in counts))
        siblings = cut(branches.groupBy(*at).applyInPandas(merge_siblings, MERGED_CHILDREN))
        moved = below.join(siblings, [*at, "child"]).withColumns({"node": F.concat("node", F.lit("/"), "largest"), "shown": F.concat("shown", F.lit("/"), "names"), "left": F.slice("left", 2, F.size("left"))})
        rest = cut(moved.select(*rest.columns))
    return reduce(DataFrame.unionByName, done)


def _share(blocked: Column, allowed: Column) -> Column:
    """``purity`` as a column."""
    return (blocked + PSEUDO_BLOCKED) / (blocked + allowed + PSEUDO_BLOCKED + PSEUDO_ALLOWED)


def _some_merged(templates: DataFrame, most_templates: int, in_one_task: int) -> DataFrame:
    """As ``merged``; hosts of more than ``most_templates`` templates keep theirs."""
    many = templates.groupBy("host").count().where(F.col("count") > most_templates).select("host")
    kept = templates.join(many, "host", "left_semi").select("host", "template", F.col("template").alias("merged"), _share(F.col("blocked"), F.col("allowed")).alias("share"))
    return merged(templates.join(many, "host", "left_anti"), in_one_task).unionByName(kept)


def judge(pages: DataFrame, listed: list[Rule], most_children: int = MOST_CHILDREN, most_templates: int | None = None, id_col: str = "page_id", url_col: str = "url", in_one_task: int = IN_ONE_TASK) -> DataFrame:
    """(id, host, path, rule, verdict, template, share) of every page.

    Hosts of all sizes are merged, unless ``most_templates`` is given: then the
    templates of a host that has more are judged one by one.
    """
    url = F.col("url")
    parts = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).select("id", host_of(url).alias("host"), path_of(url).alias("path"))
    text, verdict = rule_of(F.col("host"), F.col("path"), listed)
    parts = parts.withColumns({"rule": text, "ruled": verdict, "segments": shape(F.col("path"))}).withColumn("raw", F.concat_ws("/", "segments"))
    shapes = parts.groupBy("host", "raw").agg(
        F.first("segments").alias("segments"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("ruled") == BLOCK).alias("blocked"),
        F.count_if(F.col("ruled") == ALLOW).alias("allowed"),
    )
    wide = widened(cut(shapes), most_children)
    sums = [F.sum(c).alias(c) for c in ("n", "blocked", "allowed")]
    templates = cut(wide.groupBy("host", "template").agg(*sums))
    judged = merged(templates, in_one_task) if most_templates is None else _some_merged(templates, most_templates, in_one_task)
    verdicts = wide.select("host", "raw", "template").join(cut(judged), ["host", "template"]).select("host", "raw", "merged", "share")
    found = parts.drop("segments").join(cut(verdicts), ["host", "raw"], "left")
    decided = F.coalesce("ruled", F.when(F.col("share") >= PURITY, BLOCK).otherwise(ALLOW))
    return found.select(F.col("id").alias(id_col), "host", "path", "rule", decided.alias("verdict"), F.col("merged").alias("template"), "share")
