"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Built-in functions only: each text is scanned in its own row, so there is no
shuffle, and in time linear in the text and its matches. Kinds with a fixed
definition (email, ip, card, phone) are always kept when they pass their test.
The other kinds are kept if their score reaches ``threshold``: account numbers
(iban), which their mod-97 remainder confirms, unless words nearby speak
against them; and kinds whose pattern is too weak to stand alone (ssn,
passport, birth), which a word before them has to name.

Words nearby are those of the BEFORE code points before a span, back to the
last match of its pattern.

Defined results: null text counts as empty and has no spans; repeated rows get
equal rows; an empty table gives an empty table; other columns are passed on
by ``detect`` (with the new columns ``spans`` and ``base_spans`` replacing
columns of those names) and by ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphshed.llm import spans as S
from graphshed.llm.common import unused
from graphshed.llm.spans import between, let, running

BASE_KINDS = ("email", "ip", "card", "phone")

# The patterns of the kinds that a contract defines.
# Runs are only entered at their first character or where the last match ended:
# an entry further in can't be leftmost, and long runs stay linear. Possessive
# groups don't recurse on long matches.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_IBAN_REST = r"(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"
IBAN = rf"[A-Z]{{2}}[0-9]{{2}}{_IBAN_REST}"
#: Where an account number may begin: not within a longer run of letters and digits. What it may take in, and a letter or digit that follows, are looked ahead at.
IBAN_START = rf"(?<![A-Za-z0-9])[A-Z]{{2}}[0-9]{{2}}(?=({_IBAN_REST}[A-Za-z0-9]?))"
_APART = r"(?<![A-Za-z0-9_])(?:{})(?![A-Za-z0-9_])"
SSN = _APART.format("[0-9]{3}-[0-9]{2}-[0-9]{4}")
PASSPORT = _APART.format("[A-Z]{1,2}[0-9]{6,8}")
_YEAR, _MONTH, _DAY = "(?:19|20)[0-9]{2}", "(?:0?[1-9]|1[0-2])", "(?:0?[1-9]|[12][0-9]|3[01])"
BIRTH = _APART.format(f"{_YEAR}-{_MONTH}-{_DAY}|{_DAY}[./]{_MONTH}[./]{_YEAR}")

#: Of each kind the pattern, and one that a text must match for the kind to be searched.
PATTERNS = {
    "email": (EMAIL, "@"),
    "ip": (IP, r"[0-9]\.[0-9]"),
    "card": (CARD, r"[0-9](?:[\x20-]?[0-9]){12}"),
    "phone": (PHONE, r"\+[0-9]"),
    "iban": (IBAN_START, r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"),
    "ssn": (SSN, "[0-9]-[0-9]{2}-[0-9]"),
    "passport": (PASSPORT, "[A-Z][0-9]{6}"),
    "birth": (BIRTH, "[0-9][-./][0-9]{1,2}[-./][0-9]"),
}
KINDS = tuple(PATTERNS)

_UP_TO_255 = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

#: Words that make a kind likelier when one stands shortly before the span, and words that make any span less likely.
CONTEXT = {
    "email": "mail|contact|kontakt|correo|courriel",
    "ip": "address|host|server|adresse",
    "card": "card|visa|karte|tarjeta|carte",
    "phone": "phone|call|tel|mobil|fax",
    "iban": "iban|account|bank|konto|cuenta|compte",
    "ssn": "ssn|social security|national id|seguridad social",
    "passport": "passport|reisepass|pasaporte|passeport|ausweis",
    "birth": "born|birth|geboren|geburt|nacid|nacimiento|naissance",
}
AGAINST = "example|sample|dummy|fake|beispiel|muster|ejemplo|exemple"
#: Kinds whose test is a checksum, or as good as one.
CHECKED = ("ip", "card", "iban")
#: Score of a pattern alone, of a passed checksum, of a context word, of a word against.
SCORES = {"pattern": 0.4, "checksum": 0.4, "context": 0.4, "against": -0.3}


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def mod97(match: Column) -> Column:
    """The remainder of an account number by 97, its country and check digits moved to the end and letters written as 10 to 35."""
    plain = F.regexp_replace(match, "[^A-Z0-9]", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))

    def step(so_far: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (so_far * 100 + code - 55) % 97).otherwise((so_far * 10 + code - 48) % 97)

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step)


def passes(span: Column) -> Column:
    """Whether a match passes the test of its kind."""
    match, n = span["match"], F.length(digits(span["match"]))
    return (
        F.when(span["kind"] == "ip", match.rlike(rf"^{_UP_TO_255}(?:\.{_UP_TO_255}){{3}}$"))
        .when(span["kind"] == "card", n.between(13, 19) & F.call_function("luhn_check", digits(match)))
        .when(span["kind"] == "phone", n.between(9, 15))
        .when(span["kind"] == "iban", F.length(F.regexp_replace(match, r"\x20", "")).between(15, 34) & (mod97(match) == 1))
        .when(span["kind"] == "ssn", ~match.rlike("^(?:000|666|9)|-00-|0000$"))
        .otherwise(F.lit(True))
    )


def score(kind: str, before: Column) -> Column:
    """Pattern and checksum, and what the words before a span say, from 0 to 1."""
    words = F.lower(before)
    alone = F.lit(SCORES["pattern"] + (SCORES["checksum"] if kind in CHECKED else 0.0))
    said = F.when(words.rlike(CONTEXT[kind]), SCORES["context"]).otherwise(0.0) + F.when(words.rlike(AGAINST), SCORES["against"]).otherwise(0.0)
    return F.round(F.least(alone + said, F.lit(1.0)), 2)


SCORED = "array<struct<kind:string,start:int,stop:int,match:string,score:double>>"


def _scored(kind: str, found: Column) -> Column:
    return F.transform(found, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["match"].alias("match"), score(kind, s["before"]).alias("score")))


def account_numbers(text: Column) -> Column:
    """Confirmed account numbers: from every beginning the longest one that passes, of those that end where no letter or digit follows.

    The pattern takes following words in, so all its ends before a space are
    tried. A number that begins within another one is kept as well.
    """

    def ends(x: Column) -> Column:
        groups = F.split(x["match"], " ")
        tried = let(groups, lambda g: F.transform(F.sequence(F.size(g), F.lit(1)), lambda n: F.array_join(F.slice(g, F.lit(1), n), " ")))
        spans = F.transform(tried, lambda m: F.struct(F.lit("iban").alias("kind"), x["start"].alias("start"), (x["start"] + F.length(m)).alias("stop"), m.alias("match"), x["before"].alias("before")))
        return F.get(F.filter(F.filter(spans, lambda s: s["match"].rlike(f"^{IBAN}$")), passes), F.lit(0))

    return F.filter(F.transform(S.find(text, "iban", IBAN_START, tail_group=1), ends), lambda s: s.isNotNull())


def find(text: Column, kind: str) -> Column:
    """Confirmed and scored spans of a kind in a text; texts without what the kind needs aren't searched."""
    pattern, needed = PATTERNS[kind]
    found = account_numbers(text) if kind == "iban" else F.filter(S.find(text, kind, pattern), passes)
    has = F.contains(text, F.lit(needed)) if kind == "email" else text.rlike(needed)
    return F.when(has, _scored(kind, found).cast(SCORED)).otherwise(F.array().cast(SCORED))


def detect(docs: DataFrame, threshold: float = 0.8, text_col: str = "text") -> DataFrame:
    """All columns, with base_spans (the four fixed kinds) and spans (these and further ones), by kind and start."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = {kind: unused(docs.columns, f"_{kind}") for kind in KINDS}
    found = docs.withColumns({own[kind]: find(text, kind) for kind in KINDS})
    base = F.concat(*(F.col(own[kind]) for kind in BASE_KINDS))
    more = (F.filter(own[kind], lambda s: s["score"] >= threshold) for kind in KINDS if kind not in BASE_KINDS)
    return found.withColumns({"base_spans": base, "spans": F.concat(base, *more)}).drop(*own.values())


def replaced(text: Column, spans: Column) -> Column:
    """The text with its spans replaced by their kinds in brackets."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["stop"]).alias("less"), s["kind"].alias("kind"))))

    def cleaned(parts: Column, row: Column) -> Column:
        reached = running(F.transform(row, lambda s: -s["less"]), F.lit(0), F.greatest)
        return let(reached, lambda upto: F.concat(F.array_join(F.zip_with(row, F.slice(upto, F.lit(1), F.size(row)), piece(parts)), ""), between(parts, F.element_at(upto, -1), F.length(text))))

    def piece(parts: Column):
        # What lies within, or begins within, what is already replaced adds nothing.
        return lambda s, at: F.when(s["start"] < at, F.lit("")).otherwise(F.concat(between(parts, at, s["start"]), F.lit("["), s["kind"], F.lit("]")))

    return let(S.chunks(text), lambda parts: let(ordered, lambda row: cleaned(parts, row)))


def redact(docs: DataFrame, threshold: float = 0.8, text_col: str = "text") -> DataFrame:
    """The same columns, with every span of the text replaced by its kind in brackets.

    Of overlapping spans the one that begins first is taken, the longer one of
    equal begin; a later one is cut to what is left of it. Null texts stay null.
    """
    columns = docs.columns
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = {name: unused(columns, f"_own_{name}") for name in ("spans", "base_spans") if name in columns}
    found = detect(docs.withColumnsRenamed(own), threshold, text_col)
    found = found.withColumn(text_col, F.when(F.size("spans") > 0, replaced(text, F.col("spans"))).otherwise(F.col(text_col)))
    return found.drop("spans", "base_spans").withColumnsRenamed({b: a for a, b in own.items()}).select(*columns)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the fixed kinds, the hash of their spans and all spans as text."""
    return found.select(
        id_col,
        *(S.count(F.col("base_spans"), kind).alias(f"n_{kind}") for kind in BASE_KINDS),
        F.sha2(S.written(F.col("base_spans")), 256).alias("base_sha256"),
        S.written(F.col("spans")).alias("spans"),
    )
