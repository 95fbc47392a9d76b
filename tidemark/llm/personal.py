"""Personal data: generators, boosted trees and calibrated thresholds [native].

Base patterns find emails, IPv4 addresses, card and phone numbers; they always count. High-recall
generators propose further spans, which may overlap: obfuscated emails, IPv6, cards and phones in other
layouts, and three further kinds: secrets (values of token, key or password settings, and long runs of letters
and digits), IBANs and national ids of the form 000-00-0000. Each proposal becomes a row of numbers on its
format and its context; gradient boosted trees score it; a kind's threshold is the least score at which at
least PRECISION of the held-out proposals are right. They are fitted on SAMPLE labelled sentences, half of
them held out: generated values and look-alikes, set into CONTEXTS pieces of the documents' own texts (those of
the documents whose hashes are least; digits and signs are taken out of them, so that they hold no data of their own).
The trees run as SQL expressions. Of overlapping proposals the best score stays, then the best that overlaps
none that stay, and so on; none stays that overlaps a base span. Spans are sorted by start and cut where none
reaches over, so that they are compared within a cluster of overlaps only, however many a text has.

Offsets are code points, ends exclusive. A document is handled within its row. Format limits of proposals:
an obfuscated email has up to 64 characters before the sign and up to 9 labels of up to 63 after it; a secret
has 8 characters or more after a setting's name, else 20 or more.

Edge cases: null and empty texts have no spans; repeated rows are each reported; an empty table gives
none; further columns pass through redacted() unchanged.
"""

from __future__ import annotations

import random
import re
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, let, table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "iban", "id")
#: Labelled sentences the trees are fitted on (half) and calibrated with (half).
SAMPLE = 4000
#: Pieces of texts that the sentences are made with, at most, and their length.
CONTEXTS, PIECE = 1000, 80
TREES, RATE, PRECISION = 40, 0.3, 0.97
#: The contract's patterns. Possessive where nothing can follow, so that no text is scanned twice or deep.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no match of the kind.
HINT = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
MORE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\[at\]|\(at\)|\{at\})\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\[dot\]|\(dot\)|\{dot\}|\.)\x20?[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){2,7}+:?(?:[0-9A-Fa-f]{1,4}:){0,5}+[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z.-])[0-9]{4}[\x20._-]?[0-9]{4,6}[\x20._-]?[0-9]{4,5}(?:[\x20._-]?[0-9]{1,7})?(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20./-][0-9]{3,4}(?:[\x20./-]?[0-9]{2,4}){1,3}(?![0-9A-Za-z])",
    "secret": r"(?<![A-Za-z0-9+/_.-])(?:(?<=(?:oken|ecret|assword|asswd|pwd|[Kk]ey|OKEN|ECRET|ASSWORD|KEY)[\"']?\x20?[:=]\x20?[\"']?)[A-Za-z0-9+/_.-]{8,}+|(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}+)={0,2}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "id": r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
}
MORE_HINT = {"email": r"[\[({]at[\])}]", "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]{0,4}:", "card": r"[0-9]{4}[\x20._-]?[0-9]{4}", "phone": r"[0-9]{2,4}\)?[\x20./-][0-9]{3,4}", "secret": r"[A-Za-z0-9+/_-]{20}|(?i:oken|ecret|assw|pwd|key)[\"']?\x20?[:=]", "iban": r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}", "id": r"[0-9]{3}-[0-9]{2}-[0-9]{4}"}
CONTEXT = 40
#: Values that a pass of a running sum merges, and more matches than any array holds.
RADIX, MOST = 16, 2**31
CUES = (r"(?i)phone|tel\b|call|mobile|fax|ring|dial|sms", r"(?i)card|visa|credit|debit|amex|payment", r"(?i)mail|contact|write|reach", r"(?i)\bip|host|address|server|client", r"(?i)isbn|order|invoice|version|serial|date|time|page|no\.|sku|part|commit|sha|uuid|file|path", r"(?i)(?:token|secret|password|passwd|pwd|key|bearer)[\"']?\x20?[:=]\x20?[\"']?$", r"(?i)iban|account|bank|transfer", r"(?i)ssn|social|security|national|insurance|id\b")
PREFIX = r"^(?:AKIA|ASIA|gh[pousr]_|sk-|xox[abp]-|eyJ|AIza|glpat-)"
FEATURES = ("kind", "digits", "length", "groups", "longest", "parens", "luhn", "letters", "mod97", "prefix", *(f"cue{i}" for i in range(len(CUES))))


def _steps() -> list[int]:
    """Strides of the passes of a running merge: enough for MOST values."""
    return [RADIX**k for k in range(MOST.bit_length()) if RADIX**k < MOST]


def _pass(v: Column, step: int, merge) -> Column:
    """Each value merged with its RADIX - 1 neighbours before it at this stride."""
    more = F.transform(v, lambda x, i: merge(x, *[F.get(v, i - k * step) for k in range(1, RADIX) if k * step < MOST]))
    return F.when(F.size(v) <= step, v).otherwise(more)


def _sum(first: Column, *more: Column) -> Column:
    return reduce(lambda a, b: a + F.coalesce(b, F.lit(0)), more, first)


def _with_found(docs: DataFrame, text: str, name: str, patterns: dict[str, str], hints: dict[str, str]) -> DataFrame:
    """docs with a column of this name: leftmost matches of each kind that do not overlap, as structs of start,
    kind (its place in KINDS), end and text. Each step is a column of its own and reads the last one once, so that
    the plan stays small however filters move through it."""
    whole_text = F.col(text)

    def pieces(kind: str) -> Column:
        """What lies before each match, and the match; the pieces of a kind make up the text."""
        piece = lambda n, match: F.struct(n.cast("long").alias("n"), F.lit(KINDS.index(kind)).alias("kind"), match.alias("text"))
        cut = lambda m: F.transform(F.split(whole_text, patterns[kind], -1), lambda g, i: piece(F.length(g) + F.coalesce(F.length(F.get(m, i)), F.lit(0)), F.get(m, i)))
        whole = F.array(piece(F.length(whole_text), F.lit(None).cast("string")))
        all_of = lambda m: F.when(F.size(m) > 0, cut(m)).otherwise(whole)
        return F.when(whole_text.rlike(hints[kind]), let(F.regexp_extract_all(whole_text, F.lit(patterns[kind]), F.lit(0)), all_of)).otherwise(whole)

    some = lambda parts: F.size(parts) > len(patterns)
    sizes = lambda parts: F.when(some(parts), F.transform(parts, lambda x: x["n"])).otherwise(F.array().cast("array<bigint>"))
    state = lambda n, parts, ends: F.struct(n.alias("n"), parts.alias("parts"), ends.alias("ends"))
    found = docs.withColumn(name, let(F.concat(*[pieces(k) for k in KINDS if k in patterns]), lambda p: state(F.length(whole_text), p, sizes(p))))
    for step in _steps():
        found = found.withColumn(name, let(F.col(name), lambda s: state(s["n"], s["parts"], _pass(s["ends"], step, _sum))))  # noqa: B023
    none = F.array().cast("array<struct<start:int,kind:int,end:int,text:string>>")

    def spans(s: Column) -> Column:
        end = lambda x, i: F.get(s["ends"], i) - x["kind"] * s["n"]
        placed = F.transform(s["parts"], lambda x, i: F.struct((end(x, i) - F.length(x["text"])).cast("int").alias("start"), x["kind"].alias("kind"), end(x, i).cast("int").alias("end"), x["text"].alias("text")))
        return F.when(some(s["parts"]), F.filter(placed, lambda x: x["text"].isNotNull())).otherwise(none)

    return found.withColumn(name, let(F.col(name), spans))


#: Characters of the blocks that pieces of a text are taken from: a place in a text itself is found by counting from its start.
PAGE = 4096


def _pages(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PAGE}}}"), F.lit(0))


def _piece(pages: Column, start: Column, end: Column) -> Column:
    """The characters from start up to end, of a text's pages."""
    a, b = F.floor(start / PAGE).cast("int"), F.floor(end / PAGE).cast("int")
    of = lambda page, low, n: F.coalesce(F.substring(F.get(pages, page), low + 1, n), F.lit(""))
    between = F.when(b > a + 1, F.array_join(F.slice(pages, a + 2, b - a - 1), "")).otherwise(F.lit(""))
    return F.when(a == b, of(a, start - a * PAGE, end - start)).otherwise(F.concat(of(a, start - a * PAGE, F.lit(PAGE)), between, of(b, F.lit(0), end - b * PAGE)))


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    one = lambda k: F.substring(digits, n + 1 - k, F.lit(1)).cast("int")
    weigh = lambda k: let(one(k) * F.when(k % 2 == 0, F.lit(2)).otherwise(F.lit(1)), lambda d: F.when(d > 9, d - 9).otherwise(d))
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, k: a + weigh(k)) % 10 == 0


def _mod97(text: Column) -> Column:
    """Whether the letters and digits of an account number, its first four last, leave 1 when divided by 97."""
    plain = F.regexp_replace(text, "[^0-9A-Z]+", "")
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    add = lambda a, c: let(value(c), lambda v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97)
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), add) == 1


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]+", "")


def with_base(docs: DataFrame, text: str, name: str) -> DataFrame:
    """docs with a column of the base spans, in order."""

    def right(kind: str, x: Column) -> Column:
        if kind == "ip":
            part = lambda p: let(F.regexp_replace(p, "^0+(?=.)", ""), lambda q: F.when(F.length(q) <= 3, q.cast("int") <= 255).otherwise(F.lit(False)))
            return F.forall(F.split(x["text"], r"\."), part)
        if kind == "card":
            return let(_digits(x["text"]), lambda d: F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(F.lit(False)))
        return F.length(_digits(x["text"])).between(10, 15) if kind == "phone" else F.lit(True)

    verdict = lambda x: reduce(lambda c, k: c.when(x["kind"] == KINDS.index(k), right(k, x)), BASE_KINDS, F.when(F.lit(False), True))
    return _with_found(docs, text, name, BASE, HINT).withColumn(name, F.array_sort(F.filter(name, verdict)))


def with_proposals(docs: DataFrame, text: str, name: str) -> DataFrame:
    """docs with a column of structs of start, kind, end, text and features, of all generators."""

    def features(pages: Column, x: Column) -> Column:
        before = _piece(pages, F.greatest(F.lit(0), x["start"] - CONTEXT), x["start"])
        digits = _digits(x["text"])
        groups = F.split(x["text"], "[^0-9A-Za-z]+")
        flag = lambda c: F.when(c, F.lit(1)).otherwise(F.lit(0))
        row = lambda d, g, b: F.array(
            x["kind"],
            F.length(d),
            F.length(x["text"]),
            F.size(g),
            F.array_max(F.transform(g, lambda y: F.length(y))),
            flag(x["text"].contains("(")),
            flag(F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(F.lit(False))),
            F.length(F.regexp_replace(x["text"], "[^A-Za-z]+", "")),
            flag(F.when(x["kind"] == KINDS.index("iban"), _mod97(x["text"])).otherwise(F.lit(False))),
            flag(x["text"].rlike(PREFIX)),
            *[flag(b.rlike(c)) for c in CUES],
        )
        made = let(digits, lambda d: let(groups, lambda g: let(before, lambda b: row(d, g, b))))
        return F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), x["text"].alias("text"), made.alias("features"))

    pages = F.when(F.size(name) > 0, _pages(F.col(text))).otherwise(F.array().cast("array<string>"))
    return _with_found(docs, text, name, MORE, MORE_HINT).withColumn(name, let(pages, lambda p: F.transform(name, lambda x: features(p, x))))


def contexts(docs: DataFrame) -> list[str]:
    """Pieces of the texts of the documents whose hashes are least, CONTEXTS at most."""
    order = F.xxhash64("text")
    piece = F.substring(F.col("text"), F.pmod(order, F.greatest(F.length("text") - PIECE, F.lit(1))).cast("int") + 1, F.lit(PIECE))
    rows = docs.filter(F.length("text") >= PIECE).select(order.alias("order"), piece.alias("piece")).orderBy("order", "piece").limit(CONTEXTS).collect()
    return [r["piece"] for r in rows]


def _sentences(pieces: list[str]) -> list[tuple[str, int]]:
    """Sentences, each with one proposal at most, and whether it is personal data."""
    rng = random.Random(7)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    words = "the and of to in that it was for on are as with his they at be this have from or one had by".split()
    found = [w for x in pieces if (w := re.sub(r"[^\W\d_]*[\d@=:+/_-]\S*", " ", x).split()[1:-1])] or [words]

    def some() -> str:
        own = rng.choice(found)
        at = rng.randrange(len(own))
        return " ".join(own[at : at + rng.randint(3, 9)])

    def card() -> str:
        d = [int(c) for c in rng.choice("45") + digits(14)]
        total = sum(sum(divmod(2 * x, 10)) if k % 2 == 0 else x for k, x in enumerate(reversed(d)))
        return "".join(map(str, d)) + str(-total % 10)

    def spaced(d: str, sep: str) -> str:
        return sep.join(d[k : k + 4] for k in range(0, len(d), 4))

    def email() -> str:
        at, dot = rng.choice([("[at]", "[dot]"), (" (at) ", " (dot) "), (" [at] ", "."), ("(at)", ".")])
        return f"{rng.choice(words)}{digits(2)}{at}{rng.choice(words)}{dot}{rng.choice(['com', 'org', 'net'])}"

    def mixed(n: int) -> str:
        return "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=n - 2)) + digits(2)

    def hexed() -> str:
        return "".join(rng.choices("0123456789abcdef", k=rng.choice([24, 32, 40, 64])))

    def secret() -> str:
        value = rng.choice([hexed, lambda: mixed(rng.choice([12, 16, 24, 32, 40]))])()
        return f"{rng.choice(['token', 'secret', 'password', 'api_key', 'apikey', 'access_key', 'auth token', 'SECRET_KEY', 'client_secret'])}{rng.choice([' = ', '=', ': ', ':'])}{rng.choice(['', chr(34)])}{value}"

    def known() -> str:
        return rng.choice(["AKIA" + mixed(16).upper(), "ghp_" + mixed(36), "sk-" + mixed(40), "xoxb-" + mixed(30), "eyJ" + mixed(60)])

    def iban(valid: bool = True) -> str:
        country, rest = rng.choice(["DE", "GB", "FR", "ES", "IT", "NL"]), digits(18)
        check = 98 - int(rest + "".join(str(ord(c) - 55) for c in country) + "00") % 97
        return spaced(f"{country}{check if valid else (check + 7) % 97:02}{rest}", rng.choice(["", " "]))

    def ip6() -> str:
        return ":".join(f"{rng.randrange(65536):x}" for _ in range(8))

    def phone() -> str:
        return rng.choice([f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}", f"0{digits(2)} {digits(4)} {digits(4)}", f"{digits(3)}.{digits(3)}.{digits(4)}"])

    good = [
        (email, ["", "write to", "contact", "mail"]),
        (ip6, ["", "server", "from ip", "host"]),
        (lambda: spaced(card(), rng.choice("._")), ["card", "visa", "payment by card", "credit card"]),
        (phone, ["call", "phone", "tel", "mobile:", "fax", "dial"]),
        (secret, [""]),
        (known, ["", "with"]),
        (iban, ["", "iban", "account", "transfer to"]),
        (lambda: f"{rng.randint(1, 899):03}-{digits(2)}-{digits(4)}", ["ssn", "social security", "ssn:", "national id", ""]),
    ]
    bad = [
        (lambda: f"{rng.randrange(24):02}:{rng.randrange(60):02}:{rng.randrange(60):02}", ["at", "time", "", "from"]),
        (lambda: digits(rng.choice([8, 10, 11, 12, 13, 14, 16])), ["", "order", "invoice", "serial", "token", "page"]),
        (lambda: spaced(digits(16), rng.choice(["-", " ", "."])), ["", "order", "serial", "part"]),
        (lambda: f"{1990 + rng.randrange(40)}-{rng.randrange(1, 13):02}{rng.randrange(1, 29):02}-{digits(2)}", ["date", "", "on"]),
        (lambda: f"{digits(3)} {digits(3)} {digits(2)}", ["", "order", "of", "the"]),
        (lambda: f"{digits(3)}-{digits(4)}-{digits(3)}", ["isbn", "invoice no.", "part", "sku", ""]),
        (lambda: f"{digits(2)}/{digits(4)}/{digits(3)}", ["", "date", "page", "version"]),
        (hexed, ["", "commit", "sha256", "file", "uuid"]),
        (lambda: mixed(rng.choice([20, 24, 32])), ["", "file", "path", "part"]),
        (lambda: "_".join(rng.choices(words, k=6)) + digits(2), ["", "file", "see"]),
        (lambda: f"{rng.choice(['password', 'token', 'key', 'secret'])}{rng.choice([': ', ' = '])}{''.join(rng.choices(words, k=5))}", [""]),
        (lambda: iban(False), ["", "order", "part", "serial"]),
        (lambda: f"{digits(3)}-{digits(2)}-{digits(4)}", ["isbn", "part", "order", "serial", "invoice"]),
    ]
    out = []
    for k in range(SAMPLE):
        make, cues = rng.choice(good if k % 2 else bad)
        out.append((f"{some()} {rng.choice(cues)} {make()} {some()}.", k % 2))
    return out


def _fit(x: np.ndarray, y: np.ndarray) -> list[tuple]:
    """Boosted trees of depth two for the logistic loss: (feature, cut, ...) with leaf values."""
    cuts = [(f, c) for f in range(x.shape[1]) for c in np.unique(x[:, f])[:-1]]
    sides = np.array([x[:, f] <= c for f, c in cuts])
    score = np.zeros(len(y))
    trees = []

    def best(g: np.ndarray, h: np.ndarray, rows: np.ndarray):
        left_g, left_h = sides @ (g * rows), sides @ (h * rows)
        right_g, right_h = (g * rows).sum() - left_g, (h * rows).sum() - left_h
        gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1)
        return int(gain.argmax())

    leaf = lambda g, h, rows: float(RATE * (g * rows).sum() / ((h * rows).sum() + 1))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        top = best(g, h, np.ones(len(y)))
        tree: list = [cuts[top]]
        for side in (sides[top], ~sides[top]):
            k = best(g, h, side)
            values = leaf(g, h, side & sides[k]), leaf(g, h, side & ~sides[k])
            score += values[0] * (side & sides[k]) + values[1] * (side & ~sides[k])
            tree.append((cuts[k], *values))
        trees.append(tuple(tree))
    return trees


def _scored(trees: list, row) -> list:
    return [
        (side[1] if row[side[0][0]] <= side[0][1] else side[2])
        for top, left, right in trees
        for side in [left if row[top[0]] <= top[1] else right]
    ]


def fitted(docs: DataFrame) -> tuple[list, list[float], list[tuple[int, bool, bool]]]:
    """The trees, each kind's threshold, and of the held-out proposals the kind, the truth and the verdict."""
    sentences = docs.sparkSession.createDataFrame(_sentences(contexts(docs)), "text string, y int")
    # SAMPLE sentences; sorted, so that the halves do not depend on partitions
    rows = with_proposals(sentences.coalesce(1), "text", "p").select("y", F.explode("p").alias("p")).select("y", "p.features").collect()
    x, y = np.array([r["features"] for r in rows]), np.array([r["y"] for r in rows], float)
    half = np.arange(len(y)) % 4 < 2  # two of each label in turn
    trees = _fit(x[half], y[half])
    scores = np.array([sum(_scored(trees, r)) for r in x[~half]])
    kinds, truth = x[~half][:, 0], y[~half]
    cuts = []
    for k in range(len(KINDS)):
        s, t = scores[kinds == k], truth[kinds == k]
        order = np.argsort(-s, kind="stable")
        s, precise = s[order], np.cumsum(t[order]) / np.arange(1, len(s) + 1)
        safe = [v for i, v in enumerate(s) if precise[i] >= PRECISION and v > 0 and (i + 1 == len(s) or s[i + 1] < v)]
        cuts.append(float(min(safe, default=np.inf)))
    return trees, cuts, [(int(k), bool(t), bool(s >= cuts[int(k)])) for k, t, s in zip(kinds, truth, scores, strict=True)]


def _score(trees: list, features: Column) -> Column:
    total = F.lit(0.0)
    for (f, c), *sides in trees:
        (ln, ll, lr), (rn, rl, rr) = [(F.get(features, int(n[0])) <= int(n[1]), a, b) for n, a, b in sides]
        total = total + F.when(F.get(features, int(f)) <= int(c), F.when(ln, F.lit(ll)).otherwise(F.lit(lr))).otherwise(F.when(rn, F.lit(rl)).otherwise(F.lit(rr)))
    return total


def _clusters(v: Column) -> Column:
    """Spans in order of start, cut where none before reaches: spans overlap within their piece only."""

    def cut(s: Column) -> Column:
        fresh = F.filter(F.sequence(F.lit(0), F.size(s["v"]) - 1), lambda i: F.get(s["v"], i)["start"] >= F.coalesce(F.get(s["reach"], i - 1), F.lit(0)))
        return let(fresh, lambda at: F.transform(at, lambda a, k: F.slice(s["v"], a + 1, F.coalesce(F.get(at, k + 1), F.size(s["v"])) - a)))

    reach = reduce(lambda far, step: let(far, lambda x: _pass(x, step, F.greatest)), _steps(), F.transform(v, lambda x: x["end"]))
    return F.when(F.size(v) > 0, let(F.struct(v.alias("v"), reach.alias("reach")), cut)).otherwise(F.array().cast("array<array<struct<start:int,kind:int,end:int,score:double,base:boolean>>>"))


def _taken(cluster: Column) -> Column:
    """Of the proposals of a cluster that meet no base span, the best, then the best that overlaps none taken, and so on."""
    meets = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
    free = lambda base: F.filter(cluster, lambda x: ~x["base"] & ~F.exists(base, lambda b: meets(x, b)))
    ranked = lambda x: F.struct((-x["score"]).alias("rank"), x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))
    plain = lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    best = lambda v: F.aggregate(F.sort_array(F.transform(v, ranked)), none, lambda a, x: F.when(F.exists(a, lambda y: meets(x, y)), a).otherwise(F.concat(a, F.array(plain(x)))))
    alone = F.transform(F.filter(cluster, lambda x: ~x["base"]), plain)
    return F.when(F.size(cluster) == 1, alone).otherwise(best(let(F.filter(cluster, lambda x: x["base"]), free)))


def with_spans(docs: DataFrame, name: str) -> DataFrame:
    """docs with a struct column of this name: base and all spans (start, kind, end), sorted by start and kind."""
    trees, cuts, _ = fitted(docs)
    plain = lambda spans: F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    limit = F.array(*[F.lit(c) for c in cuts])

    def accepted(base: Column, more: Column) -> Column:
        of = lambda x, score, is_base: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), score.alias("score"), F.lit(is_base).alias("base"))
        scored = F.filter(F.transform(more, lambda x: of(x, _score(trees, x["features"]), False)), lambda x: x["score"] >= F.get(limit, x["kind"]))
        chosen = let(F.array_sort(F.concat(F.transform(base, lambda x: of(x, F.lit(0.0), True)), scored)), lambda v: F.flatten(F.transform(_clusters(v), _taken)))
        return F.when(F.size(more) > 0, F.array_sort(F.concat(plain(base), plain(chosen)))).otherwise(plain(base))

    text, base, more = (free_name(docs, x) for x in ("personal_text", "personal_base", "personal_more"))
    hint = "|".join(f"(?:{h})" for h in (r"[0-9]\D{0,2}[0-9]", r"@[A-Za-z0-9]", MORE_HINT["email"], MORE_HINT["ip"], MORE_HINT["secret"]))
    found = docs.withColumn(text, F.when(F.col("text").rlike(hint), F.col("text")).otherwise(F.lit("")))
    found = with_proposals(with_base(found, text, base), text, more)
    return found.withColumn(name, let(F.struct(F.col(base).alias("base"), F.col(more).alias("more")), lambda s: F.struct(plain(s["base"]).alias("base"), accepted(s["base"], s["more"]).alias("all")))).drop(text, base, more)


def _listed(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(docs: DataFrame) -> DataFrame:
    """docs with each span of text replaced by its kind in brackets; spans that overlap become one."""
    name = free_name(docs, "personal")
    found = with_spans(docs, name)
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def rebuild(s: Column) -> Column:
        """s: the spans, and how far those up to each one reach."""
        text, spans, reach = F.col("text"), s["spans"], s["reach"]
        before = lambda i: F.coalesce(F.get(reach, i - 1), F.lit(0))
        pieces = lambda p: F.transform(spans, lambda x, i: F.when(x["start"] >= before(i), F.concat(_piece(p, before(i), x["start"]), F.get(tags, x["kind"]))).otherwise(F.lit("")))
        rest = F.substring(text, F.array_max(reach) + 1, F.length(text))
        return F.when(F.size(spans) > 0, F.concat(F.array_join(let(_pages(text), pieces), ""), rest)).otherwise(text)

    state = lambda spans, reach: F.struct(spans.alias("spans"), reach.alias("reach"))
    found = found.withColumn(name, let(F.col(name)["all"], lambda v: state(v, F.transform(v, lambda x: x["end"]))))
    for step in _steps():
        found = found.withColumn(name, let(F.col(name), lambda s: state(s["spans"], _pass(s["reach"], step, F.greatest))))  # noqa: B023
    changed = found.withColumn("text", let(F.col(name), rebuild)).drop(name)
    return changed.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else changed


def op10_personal_data(spark, sf_dir: str) -> DataFrame:
    found = with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"), "found")
    count = lambda k: F.size(F.filter("found.base", lambda x: x["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(count, BASE_KINDS), F.sha2(_listed(F.col("found.base")), 256).alias("base_sha256"), _listed(F.col("found.all")).alias("spans"), F.size("found.all").cast("long").alias("n_spans"))
