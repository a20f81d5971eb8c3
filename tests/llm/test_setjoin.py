"""The exact join against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from graphshed.llm import components, setjoin

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, words, percent):
    """{row number: (set size, smallest id reachable)}"""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        n = min(words, len(w))
        sets.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset())
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    return [(i, len(s), least.get(find(a), i)) for a, ((i, _), s) in enumerate(zip(rows, sets))]


def family(r, n, size, copies, first):
    """Copies of a text with few to many words replaced, so that links and near misses both abound."""
    base = [f"w{r.randrange(400)}" for _ in range(size)]
    rows = []
    for k in range(copies):
        text = list(base)
        for _ in range(r.randrange(n)):
            text[r.randrange(size)] = f"x{r.randrange(10_000)}"
        rows.append((first + k, " ".join(text)))
    return rows


def compare(spark, rows, words, percent):
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n int")
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in setjoin.join(df, words, percent).collect()]
    key = lambda x: tuple((v is not None, v or 0) for v in x)
    assert sorted(found, key=key) == sorted(brute(rows, words, percent), key=key)


@pytest.mark.parametrize("words, percent, seed", [(3, 90, 1), (5, 80, 2), (1, 60, 3)])
def test_families(spark, words, percent, seed):
    r = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = []
    for size in (12, 40, 150, 400, 900):
        rows += family(r, max(2, size // 12), size, 40, len(rows))
    rows += [(len(rows) + k, passage + " " + " ".join(f"u{r.randrange(10**6)}" for _ in range(r.randrange(5, 80)))) for k in range(60)]
    rows += [(len(rows) + k, passage) for k in range(20)]
    compare(spark, rows, words, percent)


def test_odd_rows(spark):
    long = " ".join(f"l{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (0, "one\x0btwo"), (5, "one"), (6, "ONE"), (7, "É a b c"), (8, "é a b c"), (9, long), (10, long + " z"), (11, long), (11, long), (12, "a b c"), (12, "x y z"), (None, long), (None, "alone here now"), (13, "a\x85b c")]
    compare(spark, rows, 3, 90)


@pytest.mark.parametrize("percent, seed", [(90, 1), (80, 2), (60, 3)])
def test_lists_by_definition(percent, seed):
    """Blocks that are skipped and lists derived from similar sets' leave exactly what sizes, positions and sketches allow."""
    import numpy as np

    r, measure = np.random.default_rng(seed), setjoin.Measure(3, percent)
    sets = []
    for size in (30, 80, 84, 300):
        base = r.integers(0, 2**63, size).astype(np.uint64)
        for _ in range(40):
            own = base.copy()
            own[: r.integers(0, size // 4)] = r.integers(0, 2**63)
            own = np.concatenate((own, r.integers(0, 2**63, r.integers(0, 3)).astype(np.uint64)))
            sets.append(np.unique(own))
    n = np.array([len(x) for x in sets])
    pos = np.array([r.integers(0, measure.prefix(len(x))) for x in sets])
    number, sketch = np.arange(len(sets)) * 7, setjoin.folded([setjoin.sketch_of(x, measure) for x in sets])
    root = np.where(r.random(len(sets)) < 0.2, 0, number)
    made = setjoin.List(measure, n, number, pos, sketch, root, {7: [14, 21]})
    assert made.square is None
    made.forest()
    assert (made.served >= 0).sum() > 30 and made.rows
    place = {x: i for i, x in enumerate(number.tolist())}
    for i in range(len(sets)):
        a = place[int(made.number[i])]
        want = {}
        for b in range(len(sets)):
            small, large = sorted((n[a], n[b]))
            distance = sum(bin(int(x) ^ int(y)).count("1") for x, y in zip(sketch[a], sketch[b]))
            overlap = -(-(n[a] + n[b]) * percent // (100 + percent))
            fits = 100 * small >= percent * large and distance <= (n[a] + n[b]) * (100 - percent) // (100 + percent) and min(n[a] - pos[a], n[b] - pos[b]) >= overlap
            if fits and root[a] != root[b] and not (number[a] == 7 and number[b] in (14, 21)):
                want[int(number[b])] = distance
        at, distance = made.near(i)
        assert dict(zip(made.number[at].tolist(), distance.tolist())) == want
    for _ in range(500):
        two = r.choice(len(sets), 2, replace=False)
        small = setjoin.List(measure, n[two], number[two], pos[two], sketch[two])
        assert setjoin.two_may_link(measure, n[two].tolist(), pos[two].tolist(), [sketch[k].tobytes() for k in two]) == (not small.idle)


def test_hot_list_in_parts(spark, monkeypatch):
    """Lists longer than the limit are dealt to several tasks and lose no link, hot tokens neither."""
    monkeypatch.setattr(setjoin, "LIST_MOST", 30)
    monkeypatch.setattr(setjoin, "HOT_COUNT", 10)
    compare(spark, family(random.Random(5), 10, 120, 160, 0), 3, 90)


def entries_of(spark, rows, measure):
    """(entries of the index lists, entries with others in their token's list by definition)"""
    slim = spark.createDataFrame(rows, "id long, text string")
    levels, hot = setjoin.frequencies(slim, measure)
    made = setjoin.postings(setjoin.index(slim, measure, levels), hot).collect()
    frame = spark.createDataFrame(made, setjoin.POSTINGS + ", salt int")
    lists = {}
    for r in made:
        lists.setdefault(r.token, {})[r["class"]] = (r.n, r.pos)
    return setjoin.shared(frame, measure).collect(), {k: v for k, v in lists.items() if len(v) > 1}


def test_lists_of_the_same_classes_are_one(spark):
    """Two near copies share all their prefixes but little; their sketches go along once and not for each shared token."""
    rows = []
    for k in range(30):
        text = [f"w{k}x{i}" for i in range(400)]
        rows += [(3 * k + j, " ".join([*text, f"end{j}"])) for j in range(2 + k % 2)]
    found, lists = entries_of(spark, rows, setjoin.Measure(5, 80))
    assert sum(map(len, lists.values())) > 20 * len(rows)
    assert len(found) <= 3 * len(rows)
    first = {}
    for entries in lists.values():
        for number, (n, pos) in entries.items():
            key = frozenset(entries), number
            first[key] = n, min(pos, first.get(key, (n, pos))[1])
    made = {}
    for r in found:
        made.setdefault(r.token, {})[r["class"]] = (r.n, r.pos)
    assert {(frozenset(x), c): v for x in made.values() for c, v in x.items()} == first


@pytest.mark.parametrize("most", [3, 20, 1000])
def test_lists_too_long_to_be_held(spark, monkeypatch, most):
    """They pass through under their token, over batches too; all others are one with those of the same classes."""
    monkeypatch.setattr(setjoin, "NAMED_MOST", most)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = family(random.Random(9), 10, 120, 60, 0) + family(random.Random(10), 6, 80, 8, 100) + family(random.Random(11), 3, 150, 2, 200)
        found, lists = entries_of(spark, rows, setjoin.Measure(3, 90))
        pairs = lambda groups: {(a, b) for x in groups for a in x for b in x if a < b}
        made = {}
        for r in found:
            made.setdefault(r.token, set()).add(r["class"])
        assert max(map(len, lists.values())) > 30
        assert pairs(made.values()) == pairs(lists.values())
        compare(spark, rows, 3, 90)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_empty(spark):
    assert setjoin.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sketch_never_exceeds_the_difference():
    import numpy as np

    r = np.random.default_rng(1)
    measure = setjoin.Measure()
    for n in (20, 300, 5000):
        a = r.integers(0, 2**63, n).astype(np.uint64)
        b = a.copy()
        b[: n // 5] = r.integers(0, 2**63, n // 5).astype(np.uint64)
        b = np.concatenate((b, r.integers(0, 2**63, n // 2).astype(np.uint64)))
        rows = setjoin.folded([setjoin.sketch_of(np.unique(x), measure) for x in (a, b)])
        assert np.bitwise_count(rows[0] ^ rows[1]).sum() <= len(set(a.tolist()) ^ set(b.tolist()))


def test_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 200) if i % 50 != 49] + [(1000, 1000 + i) for i in range(1, 80)] + [(r.randrange(2000, 2100), r.randrange(2000, 2100)) for _ in range(60)]
    found = {x.node: x.root for x in components.connect(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {}
    for i in {x for e in edges for x in e if e[0] != e[1]}:
        seen, todo = {i}, [i]
        while todo:
            a = todo.pop()
            for u, v in edges:
                for x, y in ((u, v), (v, u)):
                    if x == a and y not in seen:
                        seen.add(y)
                        todo.append(y)
        root[i] = min(seen)
    assert found == root


def test_one_of_each(spark):
    rows = family(random.Random(8), 30, 150, 40, 100) + [(900, "only this text here"), (901, None), (902, ""), (None, "no id at all"), (903, "twice the same row"), (903, "twice the same row")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit(1)).withColumn("class", F.lit("x"))
    out = setjoin.one_of_each(df, words=3, percent=80)
    assert out.columns == df.columns
    want = {i for i, _, c in brute(rows, 3, 80) if i == c}
    found = [r.doc_id for r in out.collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
