"""Secrets: fixed patterns, and a battery of randomness tests on other long tokens.

Built-in functions only, in time linear in the text and its matches. A token's
encoding is inferred (hex, letters, base32, base36, base52 or base64: the first
whose alphabet has all its symbols). A chi-squared test of uniformity over
cells of the alphabet (few enough for the token's length), a runs test about
the middle of the alphabet and a serial correlation test, joined by
Bonferroni, say how well a uniformly random token would do.

What is reported are tokens that are *more random than ordinary text*, so that
is the hypothesis whose false discovery rate is controlled. Its distribution
comes from decoys: for each encoding and length class of a document's tokens
DECOYS pieces of the document's other text, at even distances over the whole
of it and as long as the document's shortest such token. They are made to look like
names that people glue together, which are the hardest to tell from noise:
words run on, each with a capital and followed by a digit, less what the
encoding can't spell. A token's p-value is the share of decoys of its encoding and length
class that look as random or more (the token itself counted, so it is never
0); the Benjamini-Hochberg procedure, run apart for each encoding and class
over the tokens of the whole table, reports at the rate ``rate``, and a token's
q is the rate at which it would just be reported.

The procedure needs the tokens' order only up to steps of 1/STEPS of a power
of ten, so the table is reduced to counts of a fixed number of steps; the
driver gets one number for each step that reports anything.

Defined results: null text counts as empty; repeated rows get equal rows; an
empty table gives an empty table; other columns are passed on by ``detect``
(``spans``, ``base_spans``, ``_tokens`` and ``_decoys`` replace columns of
those names). Tokens that
overlap a span of a fixed kind are neither tested nor reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphshed.llm import spans as S
from graphshed.llm.common import cut
from graphshed.llm.spans import let

BASE_KINDS = ("assign", "access", "hex")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# The patterns of the kinds that a contract defines.
# A shorter run can't hold a long enough one, so the least length stands in the pattern.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"

#: Letters from the most frequent in European prose to the least: neighbours in an alphabet share cells, so prose falls into few.
LETTERS = "etaoinsrhldcumfpgwybvkxjzq"
CAPITALS, DIGITS = LETTERS.upper(), "0123456789"
#: Encodings in the order in which they are tried: the alphabet, what spells it, what a whole token looks like, what it is turned to before (upper or lower case, or nothing).
ALPHABETS = {
    "hex": ("eadcfb" + DIGITS, "[0-9a-f]", "^(?:[0-9a-f]+|[0-9A-F]+)$", "lower"),
    "letters": (LETTERS, "[a-z]", "^(?:[a-z]+|[A-Z]+)$", "lower"),
    "base32": (CAPITALS + "234567", "[A-Z2-7]", "^[A-Z2-7]+$", "upper"),
    "base36": (LETTERS + DIGITS, "[0-9a-z]", "^(?:[0-9a-z]+|[0-9A-Z]+)$", "lower"),
    "base52": (LETTERS + CAPITALS, "[A-Za-z]", "^[A-Za-z]+$", "as it is"),
    "base64": (LETTERS + CAPITALS + DIGITS + "+/", "[A-Za-z0-9+/]", "^[A-Za-z0-9+/]+$", "as it is"),
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Decoys for each encoding and class of a document, symbols for each cell of the chi-squared test.
DECOYS, PER_CELL = 20, 5

STEPS, MOST_STEPS = 10, 3000
RATE = 0.05


def base_spans(text: Column) -> Column:
    """The spans of the fixed kinds by start, then kind as listed."""
    assign = F.when(F.contains(text, F.lit("=")) | F.contains(text, F.lit(":")), S.find(text, "assign", ASSIGN)).otherwise(S.none())
    assign = F.filter(assign, lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= 6)
    access = F.when(F.contains(text, F.lit("AKIA")), S.find(text, "access", ACCESS)).otherwise(S.none())
    found = F.concat(assign, access, S.find(text, "hex", HEX))
    rank = F.create_map(*(x for i, k in enumerate(BASE_KINDS) for x in (F.lit(k), F.lit(i))))
    return F.transform(
        F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"), s["match"].alias("match")))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["match"].alias("match")),
    )


def encoding(plain: Column) -> Column:
    """The first encoding whose alphabet spells a token."""
    found = F.lit(None).cast("string")
    for kind, (_, _, fits, _) in reversed(ALPHABETS.items()):
        found = F.when(plain.rlike(fits), kind).otherwise(found)
    return found


def _of_kind(kind: Column, place: int) -> Column:
    return F.create_map(*(F.lit(x) for name, parts in ALPHABETS.items() for x in (name, parts[place])))[kind]


def _cased(text: Column, kind: Column) -> Column:
    case = _of_kind(kind, 3)
    return F.when(case == "lower", F.translate(text, UPPER, LOWER)).when(case == "upper", F.translate(text, LOWER, UPPER)).otherwise(text)


def length_class(n: Column) -> Column:
    return F.floor(F.log2(n.cast("double"))).cast("int")


#: Coefficients of a polynomial for log(erfc(x) * exp(x**2) / t) in t = 1 / (1 + x / 2), relative error below 1.2e-7 for all x >= 0 (Numerical Recipes, erfcc): fixed values.
_ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def tail(z: Column) -> Column:
    """Upper tail of the normal distribution, as exact for large z as for small."""

    def above(x: Column) -> Column:
        def with_t(t: Column) -> Column:
            power = F.lit(0.0)
            for c in reversed(_ERFC):
                power = power * t + c
            return t * F.exp(power - x * x) / 2

        return let(1 / (1 + x / 2), with_t)

    return let(z / F.sqrt(F.lit(2.0)), lambda x: F.when(x >= 0, above(x)).otherwise(1 - above(-x)))


def p_value(symbols: Column, alphabet: Column) -> Column:
    """Bonferroni's p-value of three tests that an array of symbols (two or more) is random over the alphabet."""

    def of_ranks(ranks: Column, k: Column) -> Column:
        n = F.size(ranks)
        cells = F.least(k, F.greatest(F.lit(2), F.floor(n / PER_CELL).cast("int")))

        def uniform(cells: Column, placed: Column) -> Column:
            first = lambda c: F.ceil(c * k / cells)
            squares = F.transform(F.sequence(F.lit(0), cells - 1), lambda c: F.pow(F.size(F.filter(placed, lambda x: x == c)).cast("double"), F.lit(2)) * k / (n * (first(c + 1) - first(c))))
            chi = F.greatest(F.aggregate(squares, F.lit(0.0), lambda a, x: a + x) - n, F.lit(0.0))
            return let(cells - 1, lambda free: let(2 / (9 * free), lambda spread: tail((F.pow(chi / free, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread))))

        by_cell = let(cells, lambda c: let(F.transform(ranks, lambda r: F.floor(r * c / k).cast("int")), lambda placed: uniform(c, placed)))
        pairs = F.zip_with(F.slice(ranks, F.lit(1), n - 1), F.slice(ranks, F.lit(2), n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

        def of_pairs(pairs: Column) -> Column:
            changes = F.aggregate(pairs, F.lit(0), lambda so_far, x: so_far + ((x["a"] * 2 >= k) != (x["b"] * 2 >= k)).cast("int"))
            runs = 2 * tail(F.abs(changes - (n - 1) / 2) / F.sqrt((n - 1) / 4))
            middle, variance = (k - 1) / 2, (k * k - 1) / 12
            serial = F.aggregate(pairs, F.lit(0.0), lambda so_far, x: so_far + (x["a"] - middle) * (x["b"] - middle))
            correlated = 2 * tail(F.abs(serial) / variance / F.sqrt((n - 1).cast("double")))
            return F.least(F.lit(1.0), 3 * F.least(by_cell, runs, correlated))

        return let(pairs, of_pairs)

    return let(F.length(alphabet), lambda k: let(F.transform(symbols, lambda c: F.instr(alphabet, c) - 1), lambda ranks: of_ranks(ranks, k)))


def step(spelled: Column, kind: Column) -> Column:
    """The p-value of a token as a step: 0 for the most random."""
    symbols = F.filter(F.split(spelled, ""), lambda c: c != "")
    p = let(symbols, lambda own: p_value(own, _of_kind(kind, 0)))
    return F.least(F.lit(MOST_STEPS), F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * STEPS)).cast("int")


TOKENS = "array<struct<start:int,stop:int,match:string,encoding:string,n:int,class:int,step:int>>"
COUNTED = "array<struct<encoding:string,class:int,step:int>>"


def tested(tokens: Column) -> Column:
    """Tokens (spans of TOKEN) with encoding, length class and step."""

    def spelled(s: Column) -> Column:
        plain = F.regexp_replace(F.translate(s["match"], "-_", "+/"), "=", "")
        return let(plain, lambda p: let(encoding(p), lambda kind: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["match"].alias("match"), kind.alias("encoding"), _cased(p, kind).alias("spelled"))))

    def of(s: Column) -> Column:
        return F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["match"].alias("match"), s["encoding"].alias("encoding"), F.length(s["spelled"]).alias("n"), length_class(F.length(s["spelled"])).alias("class"), step(s["spelled"], s["encoding"]).alias("step"))

    return F.transform(F.transform(tokens, spelled), of).cast(TOKENS)


def glued(text: Column) -> Column:
    """The words of a text run on, each with a capital and followed by the last digit of its length."""
    words = F.regexp_extract_all(text, F.lit("[A-Za-z]+"), F.lit(0))
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substr(w, F.lit(2))), (F.length(w) % 10).cast("string"))), "")


def decoys(text: Column, tokens: Column) -> Column:
    """Steps of DECOYS pieces of the glued text without its tokens, for each encoding and class of these."""
    strata = F.array_distinct(F.transform(tokens, lambda t: F.struct(t["encoding"].alias("encoding"), t["class"].alias("class"))))

    def of_stratum(rest: Column):
        def made(x: Column) -> Column:
            ring = F.regexp_replace(_cased(rest, x["encoding"]), F.concat(F.lit("[^"), F.substr(_of_kind(x["encoding"], 1), F.lit(2))), F.lit(""))
            least = F.array_min(F.transform(F.filter(tokens, lambda t: (t["encoding"] == x["encoding"]) & (t["class"] == x["class"])), lambda t: t["n"]))

            def pieces(ring: Column, n: Column) -> Column:
                size = F.length(ring)
                # Read on from the beginning where the text ends.
                rings = F.concat(ring, F.repeat(ring, (F.floor(n / F.greatest(size, F.lit(1))) + 1).cast("int")))
                at = lambda j: F.floor(j * size.cast("long") / DECOYS).cast("int") + 1
                return let(rings, lambda r: F.transform(F.sequence(F.lit(0), F.lit(DECOYS - 1)), lambda j: F.struct(x["encoding"].alias("encoding"), x["class"].alias("class"), step(F.substr(r, at(j), n), x["encoding"]).alias("step"))))

            return let(ring, lambda r: let(least, lambda n: F.when(F.length(r) > 0, pieces(r, n).cast(COUNTED)).otherwise(F.array().cast(COUNTED))))

        return made

    return let(glued(F.regexp_replace(text, TOKEN, " ")), lambda rest: F.flatten(F.transform(strata, of_stratum(rest)))).cast(COUNTED)


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns, with base_spans, _tokens and _decoys."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.withColumn("base_spans", base_spans(text))
    # A row without a long run of token characters has nothing to test.
    own = F.when(text.rlike("[A-Za-z0-9+/_-]{20}"), S.apart(S.find(text, "random", TOKEN), F.col("base_spans"))).otherwise(S.none())
    found = found.withColumn("_tokens", tested(own))
    return found.withColumn("_decoys", F.when(F.size("_tokens") > 0, decoys(text, F.col("_tokens"))).otherwise(F.array().cast(COUNTED)))


def limits(found: DataFrame, rate: float = RATE) -> dict[tuple[str, int, int], float]:
    """The q of each encoding, length class and step whose tokens are reported, by Benjamini and Hochberg.

    ``found`` has the columns ``_tokens`` and ``_decoys``. Counts are summed
    before the shuffle; what is ranked are at most MOST_STEPS counts of each
    stratum.
    """
    counted = [found.select(F.explode(name).alias("t")).select("t.encoding", "t.class", "t.step", F.lit(own).alias("own"), F.lit(1 - own).alias("decoy")) for name, own in (("_tokens", 1), ("_decoys", 0))]
    steps = counted[0].unionAll(counted[1]).groupBy("encoding", "class", "step").agg(F.sum("own").alias("own"), F.sum("decoy").alias("decoy"))
    stratum = Window.partitionBy("encoding", "class")
    upto, all_ = stratum.orderBy("step"), stratum.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    p = (1 + F.sum("decoy").over(upto)) / (1 + F.sum("decoy").over(all_))
    # Null where only decoys are that random.
    ranked = steps.withColumn("rate", p * F.sum("own").over(all_) / F.nullif(F.sum("own").over(upto), F.lit(0)))
    # The least rate of this and all larger steps.
    q = ranked.withColumn("q", F.min("rate").over(stratum.orderBy(F.desc("step"))))
    return {(r.encoding, r["class"], r.step): r.q for r in q.where((F.col("q") <= rate) & (F.col("own") > 0)).collect()}


def decided(found: DataFrame, q: dict[tuple[str, int, int], float]) -> DataFrame:
    """What ``scan`` found, with spans (of the fixed kinds, and the reported tokens with their q) in place of the tokens."""
    rank = F.create_map(*(x for i, k in enumerate(BASE_KINDS) for x in (F.lit(k), F.lit(i))))
    null = F.lit(None).cast("double")
    span = lambda s, r, kind, q: F.struct(s["start"].alias("start"), r.alias("rank"), s["stop"].alias("stop"), kind.alias("kind"), s["match"].alias("match"), q.alias("q"))
    every = F.transform("base_spans", lambda s: span(s, rank[s["kind"]], s["kind"], null))
    if q:
        known = F.create_map(*(F.lit(x) for (kind, size, at), rate in sorted(q.items()) for x in (f"{kind} {size} {at}", rate)))
        kept = F.filter(F.transform("_tokens", lambda t: span(t, F.lit(len(BASE_KINDS)), F.lit("random"), known[F.concat_ws(" ", t["encoding"], t["class"].cast("string"), t["step"].cast("string"))])), lambda s: s["q"].isNotNull())
        every = F.concat(every, kept)
    ordered = F.transform(F.array_sort(every), lambda s: F.struct(*(s[c].alias(c) for c in ("kind", "start", "stop", "match", "q"))))
    return found.withColumn("spans", ordered).drop("_tokens", "_decoys")


def detect(docs: DataFrame, rate: float = RATE, text_col: str = "text") -> DataFrame:
    """All columns, with base_spans (the fixed kinds) and spans (these and random tokens), by start. Texts are scanned twice, rather than kept with what was found in them."""
    found = scan(docs, text_col)
    return decided(found, limits(found.select("_tokens", "_decoys"), rate))


def report(docs: DataFrame, rate: float = RATE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``detect``, but only the id of every row is kept: texts are scanned once."""
    found = cut(scan(docs.select(id_col, text_col), text_col).drop(text_col))
    return decided(found, limits(found, rate))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the fixed kinds, the hash of their spans and all spans as text."""
    return found.select(
        id_col,
        *(S.count(F.col("base_spans"), kind).alias(f"n_{kind}") for kind in BASE_KINDS),
        F.sha2(S.written(F.col("base_spans")), 256).alias("base_sha256"),
        S.written(F.col("spans")).alias("spans"),
    )
