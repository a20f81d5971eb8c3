"""URL filter: parts and rules against plain Python, and the template tree."""

import collections
import math
import random
import re
import sys

from graphshed.llm import queries, urls

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]
ODD = [None, "", "no scheme", "http://", "http://A.Example.COM/en/7?x#y", "x://y://z/en/", "https://com/en/", "https://xcom/en/1", "HTTP://e.com?en/", "http://a.com#/en/", "http://example.net/de/8", "http://sub.example.net/de/9", "http://É.org/es/Ñ", "http://a.org:80/es/", "mailto:a@b", "http://host/" + "x/" * 50, "http://host//a//b/", "http://a.com/\nen/"]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host = rest[: min(ends)] if ends else rest
    tail = rest[len(host) :]
    ends = [tail.find(c) for c in "?#" if c in tail]
    return host.translate(LOWER), tail[: min(ends)] if ends else tail


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_parts_and_rules(spark):
    r = random.Random(2)
    made = [f"http://{r.choice(['a', 'b.c', 'www'])}.example.{r.choice(['com', 'net', 'org'])}/{r.choice(['en', 'de', 'es'])}/{r.randrange(9999)}" for _ in range(300)]
    rows = list(enumerate(ODD + made)) + [(None, made[0])]
    df = spark.createDataFrame([(i, u, "x") for i, u in rows], "page_id long, url string, host string")
    found = urls.judge(df, queries.URL_RULES).collect()
    assert len(found) == len(rows)
    for x in found:
        url = made[0] if x.page_id is None else rows[x.page_id][1]
        assert (x.host, x.path) == parts(url)
        text, verdict = rule(x.host, x.path)
        assert x.rule == text and x.verdict in ("block", "allow") and (verdict is None or x.verdict == verdict)


def test_templates(spark):
    """Crowded nodes become wildcards; a template with blocked pages only is rejected, one without labels on another host isn't."""
    listed = urls.rules(("block", "spam.com/buy/"), ("block", "spam.com/shop/"))
    pages = [f"http://spam.com/{a}/{w}{i}" for a in ("buy", "shop") for i in range(60) for w in ("slug",)] + [f"http://spam.com/sell/slug{i}" for i in range(60)]
    pages += [f"http://fine.com/buy/slug{i}" for i in range(60)] + [f"http://spam.com/about/{w}" for w in ("us", "them")]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, url string")
    found = {r.page_id: r for r in urls.judge(df, listed).collect()}
    assert found[0].template.endswith("/*") and "sell" in found[0].template
    assert {found[i].verdict for i in range(120, 180)} == {"block"}
    assert {found[i].verdict for i in range(180, 240)} == {"allow"}
    assert {found[i].verdict for i in (240, 241)} == {"allow"}
    large = {r.page_id: r.verdict for r in urls.judge(df, listed, most_templates=1).collect()}
    assert {large[i] for i in range(120, 180)} == {"allow"} and large[0] == "block"


def test_empty(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string"), queries.URL_RULES).count() == 0


def test_shapes(spark):
    paths = ["/a/123.html", "/2020-01-02/x", "/deadbeefdeadbeef00", "/item-99-with-long-name", "//", "", "/{n}/{x}.y", "/a/b/c/d/e/f/g/h/i/1/2"]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(urls.shape(df_col("p")).alias("s"))
    assert [list(r.s) for r in df.collect()] == [["a", "{n}.html"], ["{date}", "x"], ["{hex}"], ["{id}"], [], [], ["\\{n}", "\\{x}.y"], [*"abcdefghi", "{n}", "{n}"]]


def df_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_large_hosts_are_merged_alike(spark):
    """A host of more templates than one task merges gets the verdicts of the same tree in one task; a literal name like a merged one stays apart."""
    listed = urls.rules(("block", "big.com/buy/"), ("block", "big.com/shop/"))
    pages = [f"http://big.com/{a}/slug{i}" for a in ("buy", "shop", "sell") for i in range(60)]
    pages += [f"http://big.com/s{i}/t{j}/u{k}" for i in range(13) for j in range(13) for k in range(13)]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, url string")
    verdict = {r.page_id: r.verdict for r in urls.judge(df, listed).collect()}
    assert {verdict[i] for i in range(180)} == {"block"}
    r = random.Random(9)
    mixed = [f"http://{r.choice('hij')}.com/" + "/".join(r.choice(["a", "b", "a|b", "c", "7", f"x{r.randrange(50)}"]) for _ in range(r.randrange(5))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(mixed)), "page_id long, url string")
    listed = urls.rules(("block", "h.com/a"), ("allow", "h.com/b/7"), ("block", "i.com/c/a"))
    one = sorted(urls.judge(df, listed).collect())
    two = sorted(urls.judge(df, listed, in_one_task=40).collect())
    assert [x[:-1] for x in one] == [x[:-1] for x in two] and all(x.share is not None and abs(x.share - y.share) < 1e-12 for x, y in zip(one, two))


def plain_judge(pages, most_children):
    """(verdict, share) of every page by the definition, in plain Python."""

    def general(segment):
        stem, dot, ending = segment.rpartition(".")
        if not dot or not re.fullmatch("[A-Za-z]{1,5}", ending):
            stem, dot, ending = segment, "", ""
        for pattern, name in ((r"\d{4}-\d\d(-\d\d)?", "{date}"), (r"\d+", "{n}"), ("[0-9a-fA-F-]{16,}", "{hex}")):
            if re.fullmatch(pattern, stem, re.ASCII):
                return (name, dot + ending)
        return ("{id}", dot + ending) if len(stem) >= 12 and re.search("[0-9]", stem) else (None, stem + dot + ending)

    host_path = [parts(u) for u in pages]
    shapes = [(h, tuple(general(s) for s in p.split("/") if s)) for h, p in host_path]
    template = {}

    def widen(own, at, done):
        children = collections.defaultdict(set)
        for shape in own:
            if len(shape[1]) == at:
                template[shape] = (shape[0], done)
            else:
                children[shape[1][at]].add(shape)
        names = collections.defaultdict(set)
        for (kind, text), group in children.items():
            name = (kind or "") + text
            if len(children) > most_children:
                name = "*" if kind is None else kind + ".*" if text else kind
            names[kind is None, name] |= group
        for name, group in names.items():
            widen(group, at + 1, (*done, name))

    for host in {h for h, _ in shapes}:
        widen({s for s in shapes if s[0] == host}, 0, ())
    counts = collections.defaultdict(lambda: [0, 0, 0])
    for (h, p), s in zip(host_path, shapes):
        verdict = rule(h, p)[1]
        for i, yes in enumerate((True, verdict == "block", verdict == "allow")):
            counts[template[s]][i] += yes

    def p_value(a, b):
        keys = sorted({*a, *b}, key=str)
        na, nb = sum(a.values()), sum(b.values())
        if len(keys) < 2 or not na or not nb:
            return 1
        g = 2 * sum(x * math.log(x * (na + nb) / (n * (a[k] + b[k]))) for k in keys for x, n in ((a[k], na), (b[k], nb)) if x)
        free = len(keys) - 1
        z = ((max(g, 0) / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
        return math.erfc(z / math.sqrt(2)) / 2

    def alike(a, b):
        """Of two branches, lists of (path below, template)."""
        label = lambda x: collections.Counter({"b": sum(counts[t][1] for _, t in x), "a": sum(counts[t][2] for _, t in x)})

        def going_on(x):
            seen = collections.Counter()
            for below, t in x:
                seen[below[0] if below else ""] += counts[t][0]
            return seen

        return p_value(label(a), label(b)) >= 0.01 and p_value(going_on(a), going_on(b)) >= 0.01

    share = {}

    def merge(branch):
        ended = [t for below, t in branch if not below]
        if ended:
            blocked, allowed = (sum(counts[t][i] for t in ended) for i in (1, 2))
            share.update(dict.fromkeys(ended, (blocked + 0.5) / (blocked + allowed + 2)))
        children = collections.defaultdict(list)
        for below, t in branch:
            if below:
                children[below[0]].append((below[1:], t))
        size = lambda name: sum(counts[t][0] for _, t in children[name])
        kept = []
        for name in sorted(children, key=lambda x: (-size(x), x[1])):
            found = next((k for k in kept if alike(k, children[name])), None)
            if found is None:
                kept.append(children[name])
            else:
                found += children[name]
        for group in kept:
            merge(group)

    for host in {h for h, _ in shapes}:
        merge([(t[1], t) for t in set(template.values()) if t[0] == host])
    out = []
    for (h, p), s in zip(host_path, shapes):
        own = share[template[s]]
        out.append((rule(h, p)[1] or ("block" if own >= 0.8 else "allow"), own))
    return out


def test_against_the_definition(spark):
    """Random hosts with rules, crowded nodes at many depths, endings and very deep paths, against plain Python."""
    r = random.Random(11)
    word = lambda n: f"{r.choice('abcdef')}{r.randrange(n)}"
    pages = []
    for _ in range(1500):
        segments = [r.choice(["en", "de", "es"])] + [r.choice([word(3), word(30), str(r.randrange(99)), f"{r.randrange(9)}.html", "2020-01-02"]) for _ in range(r.choice([0, 1, 2, 3, 11]))]
        pages.append(f"http://{r.choice(['a.example.com', 'b.org', 'c.net', 'd.com', 'e.info'])}/" + "/".join(segments))
    pages += [f"http://f.com/{i}.{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    pages += ["http://g.com/" + "/".join("xy"[i % 2] for i in range(3000)) + f"/{word(90)}" for _ in range(3)]
    pages += ["http://h.com/" + "/".join(["p"] * 12) + f"/{word(90)}" for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, url string")
    found = {x.page_id: (x.verdict, x.share) for x in urls.judge(df, queries.URL_RULES, most_children=10).collect()}
    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(30_000)  # of the plain version only
    want = plain_judge(pages, 10)
    sys.setrecursionlimit(limit)
    assert {i for i, x in found.items() if x[0] != want[i][0]} == set()
    assert all(abs(x[1] - want[i][1]) < 1e-9 for i, x in found.items())
    assert len({x for x in want}) > 8
