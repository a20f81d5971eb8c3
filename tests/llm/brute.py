"""Plain Python versions of what the queries must return."""

import hashlib
import re

import duckdb

CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def only_digits(text):
    return "".join(c for c in text if c in "0123456789")


PII = {
    "email": (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    "ip": (re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    "card": (CARD, lambda m: 13 <= len(only_digits(m[0])) <= 19 and luhn(only_digits(m[0]))),
    "phone": (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 9 <= len(only_digits(m[0])) <= 15),
}
_NAMES = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
SECRETS = {
    "assign": (re.compile(rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
}


def base(text, kinds, by_start=False):
    found = [(k, m.start(), m.end()) for k, (p, ok) in kinds.items() for m in p.finditer(text or "") if ok(m)]
    if by_start:
        found.sort(key=lambda s: (s[1], list(kinds).index(s[0])))
    counts = [sum(s[0] == k for s in found) for k in kinds]
    return (*counts, hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest())


def rows(path, sql):
    return duckdb.connect().sql(sql.replace("T", f"'{path}'")).fetchall()
