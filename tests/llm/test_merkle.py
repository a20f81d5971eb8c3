"""Fingerprints against plain Python."""

import collections
import hashlib
import random

import pytest
import xxhash

from graphshed.llm import merkle

ROWS = [(i * 7 % 101, f"paragraph one of {i}\nand a second, {'long ' * (i % 9)}one\n\nlast " + "é🙂x " * i) for i in range(101)]
ODD = [(500, None), (501, ""), (501, "b"), (501, "a"), (501, "a"), (None, "no id"), (None, "another"), (-3, "x" * 200_000), (7_000_000_000, "word " * 40_000)]


def ordered(rows):
    return sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))


def runs_of(text):
    """The runs of words by their definition, as tuples of words."""
    out = []
    for paragraph in text.encode().split(b"\n"):
        run = ()
        for word in paragraph.split():
            run += (word,)
            if (xxhash.xxh3_64_intdigest(word) >> 40) % merkle.RUN_EVERY == 0 or len(run) == merkle.RUN_MOST:
                out.append(run)
                run = ()
        if run:
            out.append(run)
    return out


def alike(a, b):
    """Likeness from the texts."""
    runs_a, runs_b = runs_of(a), runs_of(b)
    if a == b or runs_a == runs_b:
        return 1.0
    if not runs_a or not runs_b:
        return 0.0
    common = (collections.Counter(runs_a) & collections.Counter(runs_b)).total()
    if common == len(runs_a) == len(runs_b):
        return common / (common + 1)
    return common / (len(runs_a) + len(runs_b) - common)


def expected(rows):
    """(id, n_chars, edited_sha256, near_edited, near_next, text, edited text) without any code of the operator."""
    rows = ordered(rows)
    out = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        n = len(text) // 3
        changed = text[: len(text) - n] + following[:n]
        out.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), alike(text, changed), alike(text, following), text, changed))
    return out


@pytest.mark.parametrize("rows", [ROWS, ROWS + ODD, ROWS[:1], ODD[5:7], []])
def test_fingerprints(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, block string")
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:3], r[3], r[4])
    found = sorted(merkle.fingerprints(df).collect(), key=lambda r: key((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next)))
    want = sorted(expected(rows), key=key)
    assert len(found) == len(want)
    prints = {}
    for r, w in zip(found, want):
        assert (r.doc_id, r.n_chars, r.edited_sha256) == w[:3]
        assert (r.near_edited, r.near_next) == pytest.approx(w[3:5], abs=1e-12)
        lines, kept = w[5].split("\n"), set(w[6].split("\n"))
        assert r.lost_paragraphs == [k for k, line in enumerate(lines) if line not in kept]
        for text, own in ((w[5], r.fingerprint), (w[6], r.edited_fingerprint)):
            assert prints.setdefault(text, own) == own
    assert len(set(prints.values())) == len(prints)


@pytest.mark.parametrize("chars", [100, 399, 401, 10_000])
def test_one_word_edits(spark, chars):
    r = random.Random(chars)
    words = []
    while len(" ".join(words)) < chars:
        words.append("".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 9))))
    make, n = merkle.Fingerprints(), len(words)
    for at in (0, n // 2, n - 1):
        other = " ".join([*words[:at], "changed", *words[at + 1 :]])
        assert merkle.likeness(make.of(" ".join(words)), make.of(other)) == pytest.approx(alike(" ".join(words), other))
        assert alike(" ".join(words), other) >= 1 - 4 / max(1, len(runs_of(other)))


def test_equal_texts_and_empty_ones():
    make = merkle.Fingerprints()
    assert make.of("a b\nc") == merkle.Fingerprints().of("a b\nc") != make.of("a b\nc ")
    assert merkle.likeness(make.of(""), make.of("")) == 1.0
    assert merkle.likeness(make.of(""), make.of("a")) == 0.0
    assert merkle.likeness(make.of("a"), make.of(" a ")) == 1.0


def test_edits_are_located():
    lines = [f"line {i} of the text" for i in range(300)]
    changed = lines[:100] + ["something else"] + lines[101:]
    assert merkle.differing("\n".join(lines), "\n".join(changed)) == ([100], [100])
    assert merkle.differing("\n".join(lines), "\n".join(lines)) == ([], [])
    longer = lines[:50] + ["new"] + lines[50:]
    assert merkle.differing("\n".join(lines), "\n".join(longer)) == ([], [50])


def test_lengths_are_compared_alike():
    """A text and its beginning share as much whatever their lengths."""
    make, r = merkle.Fingerprints(), random.Random(5)
    texts = [" ".join("".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 9))) for _ in range(400)) for _ in range(100)]
    mean = lambda n, m: sum(merkle.likeness(make.of(t[:n]), make.of(t[:m])) for t in texts) / len(texts)
    assert mean(405, 395) > 0.75 and mean(300, 290) > 0.75
    assert all(0.55 < mean(n, 2 * n // 3) < 0.7 for n in (450, 390, 900, 600))


def test_likeness_is_exact_at_all_lengths():
    """One changed word of many is seen, and its paragraph is read from the fingerprints."""
    make, r = merkle.Fingerprints(), random.Random(6)
    for n in (60, 1500, 15_000):
        for _ in range(5):
            lines = [" ".join(f"w{r.randrange(9999)}" for _ in range(30)) for _ in range(n // 30)]
            at = r.randrange(len(lines))
            other = lines[:at] + [lines[at] + " more"] + lines[at + 1 :]
            a, b = make.of("\n".join(lines)), make.of("\n".join(other))
            assert 1 - 8 / (n / 16) < merkle.likeness(a, b) < 1
            assert merkle.changed(a, b) == ([at], [at])
    text = " ".join(f"w{i}" for i in range(2000))
    turned = "\n".join(reversed([f"line {i} of it" for i in range(99)])), "\n".join(f"line {i} of it" for i in range(99))
    assert merkle.likeness(make.of(text), make.of(text)) == 1 > merkle.likeness(*map(make.of, turned)) > 0.9
