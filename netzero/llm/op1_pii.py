"""Format-preserving pseudonyms for personal data (DataFrame functions only).

Found values are replaced by values of the same format under a secret key, by
Feistel networks over exactly the values of that format, so the mapping is a
permutation: equal values get equal pseudonyms in every document, different
ones different pseudonyms, and the key holder can invert it.

=========  ===================================  ==================================
kind       found and validated                  permuted, everything else stays
=========  ===================================  ==================================
card       13 to 19 digits, Luhn check          all digits but the last, which is
                                                computed again; the check digit of
                                                the whole number stays (see below)
iban       country, check digits, mod 97 = 1    digits of the account; check
                                                digits are computed again
ssn        ddd-dd-dddd, not all zero parts      the nine digits
phone      +, 8 to 15 digits, ( ) - . spaces    the digits after the first
date       yyyy-mm-dd, dd.mm.yyyy, mm/dd/yyyy,  day number of 1900 to 2099
           real days of 1900 to 2099
ip         four numbers 0 to 255                the 32 bits
email      name@host.domain                     letters to letters, digits to
                                                digits, of the name before the @
=========  ===================================  ==================================

Layout characters keep their places, so lengths do not change except where a
number inside an IP address gets longer or shorter.  Equal digits in another
layout (blanks, hyphens) get the same pseudonym digits.

Every place where a pattern fits is tried from the left, with every end its
groups allow: for cards, phones and IBANs the longest one that validates counts
(for IBANs first the length of the country), the rest goes back to the text and
is searched on.  So that the key holder reads the same places in the
pseudonyms, cards are permuted among the numbers that would get the same check
digit if one more digit followed (the permutation is applied until it meets
one): whether a number plus the group behind it validates then stays as it was.
Where only the text around decides (an earlier group that could begin another
card, a phone with groups behind it, an IBAN not of its country's length), numbers that would be read
otherwise are passed over in the same way; there, a value can have another
pseudonym than elsewhere.

Edge cases: null text stays null; texts without finds stay as they are;
candidates that fail validation stay; repeated rows give equal results; null
ids and extra columns are kept; an empty table gives an empty result.  The
function is per row: no shuffle, nothing is collected.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

ROUNDS = 8
#: Placeholder key of tests and queries; a deployment passes its own.
DEFAULT_KEY = "netzero-demo-key"
# Days of 1900-01-01 .. 2099-12-31 are 17 x 4297, so a mixed-radix Feistel covers them exactly.
DAY_LEFT, DAY_RIGHT = 17, 4297
FIRST_DAY = "1900-01-01"

# Kinds in order of preference; one alternation finds them leftmost, non-overlapping.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])",
    "card": r"(?<![0-9]|[0-9]\.)[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Where a find of several groups may end: before these separators.
GROUPS = {"iban": "(?<=[A-Z0-9])(?= )", "phone": "(?<=[0-9])(?=[ .-])", "card": "(?<=[0-9])(?=[ -])"}
#: More characters than any pattern takes.
REACH = 700
#: Characters before a card that are looked at, more than 18 digits with separators.
BEFORE = 40
#: Steps of a walk to the next usable value; each ends it with a chance of 1 in 10 at least.
WALK = 512
#: Lengths of the registered IBANs.
IBAN_LENGTHS = {c: int(n) for c, n in re.findall("([A-Z]{2})([0-9]{2})", (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 "
    "GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 "
    "MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 "
    "VA22 VG24 XK20"))}
#: Kinds reported, by the validated form of a find.
KINDS = ("email", "iban", "ip", "date", "ssn", "phone", "card")


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _round(key: str, kind: str, i: int, value: Column, radix: Column) -> Column:
    """Keyed round function: 60 bits of a SHA-256 over key, format, round and half."""
    h = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), F.lit(i), radix.cast("string"), value.cast("string")), 256)
    return F.pmod(F.conv(F.substring(h, 1, 15), 16, 10).cast("decimal(20,0)"), radix.cast("decimal(20,0)")).cast("long")


def feistel(key: str, kind: str, left: Column, right: Column, a: Column, b: Column, invert: bool = False) -> Column:
    """Alternating mixed-radix Feistel on (left < a, right < b), a struct (l, r).

    Each round is a named step of one fold, so an expression is evaluated once."""
    acc = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    for i in (range(ROUNDS - 1, -1, -1) if invert else range(ROUNDS)):
        def step(x: Column, i: int = i) -> Column:
            sign = -1 if invert else 1
            if i % 2 == 0:
                return F.struct(F.pmod(x["l"] + _round(key, kind, i, x["r"], a) * sign, a).alias("l"), x["r"].alias("r"))
            return F.struct(x["l"].alias("l"), F.pmod(x["r"] + _round(key, kind, i, x["l"], b) * sign, b).alias("r"))
        acc = _let(acc, step)
    return acc


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, with ``value`` evaluated once."""
    return F.transform(F.array(value), lambda x: body(x))[0]


def permute_digits(key: str, kind: str, digits: Column, invert: bool = False) -> Column:
    """A string of 2 to 34 digits to one of the same length."""
    def halves(d: Column) -> Column:
        n = F.length(d)
        k = F.floor(n / 2).cast("int")
        a, b = F.pow(F.lit(10.0), k).cast("long"), F.pow(F.lit(10.0), n - k).cast("long")
        out = feistel(key, kind, F.substring(d, F.lit(1), k).cast("long"), d.substr(k + 1, n).cast("long"), a, b, invert)
        return _let(out, lambda x: F.concat(F.lpad(x["l"].cast("string"), k, "0"), F.lpad(x["r"].cast("string"), n - k, "0")))
    return _let(digits, lambda d: F.when(F.length(d) >= 2, halves(d)).otherwise(d))


def refill(layout: Column, digits: Column, classes: str = "[0-9]") -> Column:
    """``layout`` with the characters of the class replaced, in order, by ``digits``."""
    return _let(F.struct(F.split(layout, classes, -1).alias("gaps"), F.split(digits, "").alias("new")), lambda x: F.array_join(
        F.transform(x["gaps"], lambda g, i: F.concat(g, F.when(i < F.size(x["gaps"]) - 1, F.get(x["new"], i)).otherwise(F.lit("")))), ""))


def luhn_digit(body: Column) -> Column:
    """Check digit of a digit string."""
    def add(acc: Column, x: Column) -> Column:
        doubled = x["d"] * 2
        return acc + F.when(x["i"] % 2 == 0, F.when(doubled > 9, doubled - 9).otherwise(doubled)).otherwise(x["d"])
    ds = F.transform(F.split(F.reverse(body), ""), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")))
    return ((F.lit(10) - F.aggregate(ds, F.lit(0), add) % 10) % 10).cast("string")


def _mod97(s: Column) -> Column:
    """Value mod 97 of an alphanumeric string, letters as 10 to 35."""
    def add(acc: Column, c: Column) -> Column:
        v = F.conv(c, 36, 10).cast("int")
        return F.when(v > 9, (acc * 100 + v) % 97).otherwise((acc * 10 + v) % 97)
    return F.aggregate(F.filter(F.split(s, ""), lambda c: c != ""), F.lit(0), add)


def _day_number(c: Column) -> Column:
    """Days since 1900-01-01 of a date in one of the layouts; null if it is no day of 1900 to 2099."""
    iso = F.when(c.rlike("^[0-9]{4}-"), c).when(
        c.contains("."), F.concat_ws("-", c.substr(7, 4), c.substr(4, 2), c.substr(1, 2))).otherwise(
        F.concat_ws("-", c.substr(7, 4), c.substr(1, 2), c.substr(4, 2)))
    days = F.date_diff(iso.try_cast("date"), F.lit(FIRST_DAY).cast("date"))
    return F.when((days >= 0) & (days < DAY_LEFT * DAY_RIGHT), days)


def _pseudo_date(key: str, c: Column, invert: bool) -> Column:
    def moved(n: Column) -> Column:
        x = feistel(key, "date", F.floor(n / DAY_RIGHT), n % DAY_RIGHT, F.lit(DAY_LEFT).cast("long"), F.lit(DAY_RIGHT).cast("long"), invert)
        return _let(x, lambda y: F.date_add(F.lit(FIRST_DAY).cast("date"), (y["l"] * DAY_RIGHT + y["r"]).cast("int")))
    day = _let(_day_number(c), moved)
    return F.when(c.rlike("^[0-9]{4}-"), F.date_format(day, "yyyy-MM-dd")).when(
        c.contains("."), F.date_format(day, "dd.MM.yyyy")).otherwise(F.date_format(day, "MM/dd/yyyy"))


def _pseudo_ip(key: str, c: Column, invert: bool) -> Column:
    def moved(p: Column) -> Column:
        n = [p[i].cast("long") for i in range(4)]
        radix = F.lit(65536).cast("long")
        x = feistel(key, "ip", n[0] * 256 + n[1], n[2] * 256 + n[3], radix, radix, invert)
        return _let(x, lambda y: F.concat_ws(".", *[v.cast("string") for h in ("l", "r") for v in (F.floor(y[h] / 256), y[h] % 256)]))
    return _let(F.split(c, r"\."), moved)


def _pseudo_email(key: str, c: Column, invert: bool) -> Column:
    """Each letter or digit of the name is shifted within its class by a keyed
    amount that depends on the classes of the name and the domain, and, as in a
    two-round unbalanced Feistel, on the characters of the other half."""
    at = F.instr(c, "@")

    def half(name: Column, other: Column, domain: Column, i: int) -> Column:
        h = lambda j: F.conv(F.substring(F.sha2(F.concat_ws(
            "|", F.lit(key), F.lit("email"), F.lit(i), other, domain, j.cast("string")), 256), 1, 8), 16, 10).cast("long")
        sign = -1 if invert else 1

        def moved(ch: Column, j: Column) -> Column:
            shift = lambda base, n: F.chr((F.pmod(F.ascii(ch) - base + h(j) * sign, F.lit(n)) + base).cast("int"))
            return (F.when(ch.rlike("^[a-z]$"), shift(97, 26)).when(ch.rlike("^[A-Z]$"), shift(65, 26))
                    .when(ch.rlike("^[0-9]$"), shift(48, 10)).otherwise(ch))
        return F.array_join(F.transform(F.split(name, ""), moved), "")

    def whole(p: Column) -> Column:
        k = F.floor(F.length(p["name"]) / 2).cast("int")
        acc = F.struct(F.substring(p["name"], F.lit(1), k).alias("l"), p["name"].substr(k + 1, F.length(p["name"])).alias("r"))
        for i in (range(3, -1, -1) if invert else range(4)):
            def step(x: Column, i: int = i) -> Column:
                if i % 2 == 0:
                    return F.struct(half(x["l"], x["r"], p["domain"], i).alias("l"), x["r"].alias("r"))
                return F.struct(x["l"].alias("l"), half(x["r"], x["l"], p["domain"], i).alias("r"))
            acc = _let(acc, step)
        return _let(acc, lambda x: F.concat(x["l"], x["r"], F.lit("@"), p["domain"]))

    return _let(F.struct(c.substr(F.lit(1), at - 1).alias("name"), c.substr(at + 1, F.length(c)).alias("domain")), whole)


def _walk(c: Column, step, usable) -> Column:
    """``step`` applied to ``c`` until ``usable`` holds: a permutation of the usable values."""
    first = F.struct(c.alias("v"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), first, lambda acc, _: F.when(acc["done"], acc).otherwise(
        _let(step(acc["v"]), lambda x: F.struct(x.alias("v"), usable(x).alias("done")))))["v"]


def _pseudo_iban(key: str, c: Column, rest: Column, invert: bool) -> Column:
    def moved(s: Column) -> Column:  # s: without blanks
        country, account = F.substring(s, 1, 2), s.substr(F.lit(5), F.length(s))
        new = refill(account, permute_digits(key, "iban", _digits(account), invert))
        return _let(new, lambda n: F.concat(country, F.lpad((F.lit(98) - _mod97(F.concat(n, country, F.lit("00")))).cast("string"), 2, "0"), n))

    def step(x: Column) -> Column:
        return refill(c, _let(F.replace(x, F.lit(" "), F.lit("")), moved), "[A-Z0-9]")

    return _walk(c, step, lambda x: F.coalesce(F.length(longest("iban", F.concat(x, rest))) == F.length(c), F.lit(False)))


def _pseudo_card(key: str, c: Column, rest: Column, before: Column, invert: bool) -> Column:
    def step(x: Column) -> Column:
        d = _digits(x)
        return refill(c, _let(permute_digits(key, "card", d.substr(F.lit(1), F.length(d) - 1), invert), lambda b: F.concat(b, luhn_digit(b))))

    def starts(x: Column) -> Column:
        """Groups before ``x`` at which a card would begin."""
        run = F.split(F.regexp_extract(before, "[0-9](?:[ -]?[0-9])*[ -]?$", 0), "(?<=[ -])(?=[0-9])", -1)
        greedy = lambda g: F.regexp_extract(F.concat(g, x, rest), "^(?:" + PATTERNS["card"] + ")", 0)
        return F.when(before.rlike("[0-9][ -]?$"), F.exists(F.transform(run, lambda _, i: F.array_join(F.slice(run, i + 1, F.size(run)), "")),
                                                            lambda g: longest("card", greedy(g)).isNotNull())).otherwise(F.lit(False))

    whole = luhn_digit(_digits(c))
    return _walk(c, step, lambda x: (luhn_digit(_digits(x)) == whole) & ~starts(x))


def _pseudo_phone(key: str, c: Column, rest: Column, invert: bool) -> Column:
    def step(x: Column) -> Column:
        d = _digits(x)
        return refill(c, F.concat(F.substring(d, 1, 1), permute_digits(key, "phone", d.substr(F.lit(2), F.length(d)), invert)))

    def end(x: Column) -> Column:
        m = F.regexp_extract(F.concat(x, rest), "^(?:" + PATTERNS["phone"] + ")", 0)
        return longest("phone", m, F.concat(x, rest).substr(F.length(m) + 1, F.lit(BEFORE)))

    return _walk(c, step, lambda x: F.when(rest.rlike("^[ -][0-9]"), F.coalesce(F.length(end(x)) == F.length(c), F.lit(False))).otherwise(F.lit(True)))


def _valid_card(d: Column) -> Column:
    return F.length(d).between(13, 19) & (luhn_digit(d.substr(F.lit(1), F.length(d) - 1)) == F.right(d, F.lit(1)))


def _valid_iban(s: Column) -> Column:
    account = s.substr(F.lit(5), F.length(s))
    return (F.length(s).between(15, 34) & (_mod97(F.concat(account, F.substring(s, 1, 4))) == 1)
            & F.length(_digits(account)).between(2, 34))


def longest(kind: str, m: Column, after: Column | None = None) -> Column:
    """The longest valid beginning of a match that ends with a group of it, else
    null; of a phone, with the text ``after`` the match, the longest one behind
    which a valid card begins, if there is one."""
    squeezed = lambda c: F.replace(c, F.lit(" "), F.lit(""))
    valid = {"card": lambda c: _valid_card(_digits(c)), "iban": lambda c: _valid_iban(squeezed(c)),
             "phone": lambda c: F.length(_digits(c)).between(8, 15) & c.rlike("^(?:" + PATTERNS["phone"] + ")$")}[kind]

    def first(ends: Column) -> Column:
        if kind == "iban":
            lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])
            own = F.filter(ends, lambda c: F.length(squeezed(c)) == F.coalesce(F.try_element_at(lengths, F.substring(c, 1, 2)), F.lit(0)))
            ends = F.concat(own, ends)
        if after is not None:
            card = lambda c: F.regexp_extract(F.concat(m.substr(F.length(c) + 1, F.length(m)), after), "^[ -](" + PATTERNS["card"] + ")", 1)
            return _let(F.filter(ends, valid), lambda e: F.coalesce(
                F.get(F.filter(e, lambda c: longest("card", card(c)).isNotNull()), F.lit(0)), F.get(e, F.lit(0))))
        return F.get(F.filter(ends, valid), F.lit(0))

    return _let(F.split(m, GROUPS[kind], -1), lambda g: first(F.transform(
        g, lambda _, i: F.array_join(F.slice(g, F.lit(1), F.size(g) - i), ""))))


FIND = "struct<kind:string,c:string,rest:string,before:string>"


def find_at(w: Column, before: Column) -> Column:
    """The valid find at the second character of ``w`` (the first is looked back at), else null."""
    def tried(kind: str) -> Column:
        after = lambda x: w.substr(F.length(x) + 2, F.lit(BEFORE))
        m = F.regexp_extract(w, "(?s)^.(" + PATTERNS[kind] + ")", 1)
        if kind in GROUPS:
            end = lambda x: longest(kind, x, after(x) if kind == "phone" else None)
        else:
            ok = {"email": lambda x: F.lit(True), "date": lambda x: _day_number(x).isNotNull(),
                  "ip": lambda x: F.forall(F.split(x, r"\."), lambda n: n.cast("int") <= 255),
                  "ssn": lambda x: ~_digits(x).rlike("^000|^...00|0000$")}[kind]
            end = lambda x: F.when(ok(x), x)
        found = lambda x: _let(end(x), lambda c: F.when(c.isNotNull(), F.struct(
            F.lit(kind).alias("kind"), c.alias("c"), (after(c) if kind == "phone" else x.substr(F.length(c) + 1, F.length(x))).alias("rest"), before.alias("before"))))
        return _let(m, lambda x: F.when(x != "", found(x)))
    return F.coalesce(*[tried(k) for k in PATTERNS])


def parts(t: Column) -> Column:
    """``t`` cut into valid finds and, with null kind, the text between them.

    The text is split wherever a pattern fits, and the pieces are walked from
    the left; those inside a find are passed over."""
    literal = lambda c: F.array(F.struct(F.lit(None).cast("string").alias("kind"), c.alias("c"), F.lit("").alias("rest"), F.lit("").alias("before")))

    def walk(pieces: Column) -> Column:
        heads = lambda i: F.array_join(F.transform(F.slice(pieces, i, F.lit(REACH)), lambda x: F.left(x, F.lit(REACH))), "")
        last = lambda i: F.when(i > 1, F.right(F.get(pieces, i - 2), F.lit(1))).otherwise(F.lit(" "))

        def step(acc: Column, i: Column) -> Column:
            piece, n = F.get(pieces, i - 1), F.length(F.get(pieces, i - 1))
            state = lambda skip, before, more: F.struct(skip.cast("int").alias("skip"), before.alias("before"), more.alias("out"))
            text = lambda c: state(F.lit(0), F.right(F.concat(acc["before"], c), F.lit(BEFORE)), F.concat(acc["out"], literal(c)))

            def taken(f: Column) -> Column:
                size = F.length(f["c"])
                tail = piece.substr(size + 1, n)
                return F.when(size >= n, state(size - n, F.lit(""), F.concat(acc["out"], F.array(f)))).otherwise(
                    state(F.lit(0), F.right(tail, F.lit(BEFORE)), F.concat(acc["out"], F.array(f), literal(tail))))

            here = _let(find_at(F.left(F.concat(last(i), heads(i)), F.lit(REACH)), acc["before"]),
                        lambda f: F.when(f.isNotNull(), taken(f)).otherwise(text(piece)))
            return (F.when(acc["skip"] >= n, state(acc["skip"] - n, acc["before"], acc["out"]))
                    .when(acc["skip"] > 0, text(piece.substr(acc["skip"] + 1, n))).otherwise(here))

        start = F.struct(F.lit(0).alias("skip"), F.lit("").alias("before"), F.array().cast(f"array<{FIND}>").alias("out"))
        return F.aggregate(F.sequence(F.lit(1), F.size(pieces)), start, step)["out"]

    return _let(F.split(t, f"(?={ANY})", -1), walk)


def pseudonym(key: str, x: Column, invert: bool = False) -> Column:
    """Replacement of a valid find; other strings stay."""
    kind, c = x["kind"], x["c"]
    d = _digits(c)
    return (
        F.when(kind.isNull(), c)
        .when(kind == "card", _pseudo_card(key, c, x["rest"], x["before"], invert))
        .when(kind == "ssn", refill(c, permute_digits(key, "ssn", d, invert)))
        .when(kind == "phone", _pseudo_phone(key, c, x["rest"], invert))
        .when(kind == "date", _pseudo_date(key, c, invert))
        .when(kind == "ip", _pseudo_ip(key, c, invert))
        .when(kind == "email", _pseudo_email(key, c, invert))
        .when(kind == "iban", _pseudo_iban(key, c, x["rest"], invert))
        .otherwise(c)
    )


def pseudonymise(docs: DataFrame, text: str = "text", key: str = DEFAULT_KEY, invert: bool = False) -> DataFrame:
    """``docs`` with ``text`` pseudonymised and ``pii``, an array of (kind, value)
    with the pseudonyms in order of place.  Existing ``pii`` is replaced."""
    t = F.col(text)
    # most texts hold no candidate: they skip everything else
    out = docs.withColumn("_nz_parts", F.when(t.rlike(ANY), parts(t)))
    out = out.withColumn("_nz_new", F.transform("_nz_parts", lambda x: F.struct(x["kind"].alias("kind"), pseudonym(key, x, invert).alias("value"))))
    joined = F.array_join(F.col("_nz_new.value"), "")
    valid = F.filter(F.coalesce("_nz_new", F.array().cast("array<struct<kind:string,value:string>>")), lambda x: x["kind"].isNotNull())
    return out.withColumn(text, F.coalesce(joined, t)).withColumn("pii", valid).drop("_nz_new", "_nz_parts")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("pii", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [count(k) for k in KINDS]
    return out.select("doc_id", F.size("pii").cast("long").alias("n_found"), *counts, "text")

