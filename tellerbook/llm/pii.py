"""Format-preserving Feistel pseudonyms for personal data, in SQL functions only.

Candidates are found by one pattern and validated by kind. A valid one is replaced
by its image under a keyed permutation of all values of its format: a Feistel
network over two parts whose sizes multiply to the format's number of values. So
equal values stay equal in all documents, different values stay different, and a
pseudonym is valid like the original: a card number has a right check digit, a
date is a day of the calendar, an address has octets up to 255. No value is its own
pseudonym: the permutation is the network backwards, one step, and the network again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

#: Characters of an IBAN by country (fixed values of the registry).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
MONTHS = (
    "January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November",
    "December",
)
_MONTH = "(?:" + "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in MONTHS) + "|Sept)"


def _grouped_iban() -> str:
    """IBANs in groups of four, of the length of their country: what follows is not taken for a group."""
    forms = []
    for n, lands in IBAN_LENGTHS.items():
        rest = f"[ -][A-Z0-9]{{{n % 4}}}" if n % 4 else ""
        forms.append(f"(?:{lands.replace(' ', '|')})[0-9]{{2}}(?:[ -][A-Z0-9]{{4}}){{{n // 4 - 1}}}{rest}")
    return f"(?<![A-Za-z0-9])(?:{'|'.join(forms)})(?![A-Za-z0-9])"


#: Fixed patterns of the candidates, in the order in which they are tried.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "access_key": r"(?<![A-Za-z0-9])A[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "hex_secret": r"(?i:(?<![a-z])(?:token|secret|password|api_?key) ?[=:] ?\"?)[0-9a-f]{12,64}(?![0-9A-Za-z])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "grouped_iban": _grouped_iban(),
    "iso_date": (
        r"(?<![0-9-])[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?![0-9-])|(?<![0-9/])[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}(?![0-9/])"
    ),
    "numeric_date": (
        r"(?<![0-9./])[0-9]{1,2}(?:\.[0-9]{1,2}\.|/[0-9]{1,2}/)[0-9]{4}(?![0-9])"
        r"|(?<![0-9./-])[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}(?![0-9-])"
    ),
    "named_date": (
        rf"(?<![A-Za-z]){_MONTH}\.? [0-9]{{1,2}},? [0-9]{{4}}(?![0-9])"
        rf"|(?<![0-9])[0-9]{{1,2}}\.? {_MONTH}\.?,? [0-9]{{4}}(?![0-9])"
    ),
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": (
        r"(?:(?<![0-9+])\+?1[ .-]?|(?<![0-9+]))(?:\([0-9]{3}\) ?|[2-9][0-9]{2}[ .-])"
        r"[0-9]{3}[ .-][0-9]{4}(?![0-9])"
    ),
    "foreign_phone": r"\+[2-9](?:[ .-]?(?:\([0-9]{1,5}\)|[0-9])){7,13}(?![0-9])",
    "card": (
        r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
    ),
}
CANDIDATE = "|".join(KINDS.values())

#: Characters that a permutation may turn into each other (fixed values).
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HEX = "0123456789abcdef"
#: Days of the dates 1900-01-01 to 2099-12-31: 73049 = 229 * 319.
FIRST_DAY, DAYS = "1900-01-01", (229, 319)


def _number(key: str, *parts: Column | str) -> Column:
    """A number from 0 to 2**60 - 1 that the key and the parts determine."""
    texts = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    digest = F.sha2(F.concat_ws("|", F.lit(key), *texts), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _rounds(backwards: bool, n: int) -> Column:
    return F.array(*[F.lit(i) for i in (range(n - 1, -1, -1) if backwards else range(n))])


def _network(value: Column, sizes: tuple[int, int], key: str, kind: str, backwards: bool) -> Column:
    """A Feistel network over the numbers below the product of the two sizes, or its inverse."""
    a, b = sizes
    start = F.struct(F.floor(value / b).cast("long").alias("x"), (value % b).cast("long").alias("y"))

    def turn(now: Column, i: Column) -> Column:
        moved = (now["x"] + _number(key, kind, i, "x", now["y"])) % a
        return let(
            moved, lambda x: F.struct(x.alias("x"), ((now["y"] + _number(key, kind, i, "y", x)) % b).alias("y"))
        )

    def back(now: Column, i: Column) -> Column:
        moved = F.pmod(now["y"] - _number(key, kind, i, "y", now["x"]), F.lit(b))
        return let(
            moved,
            lambda y: F.struct(F.pmod(now["x"] - _number(key, kind, i, "x", y), F.lit(a)).alias("x"), y.alias("y")),
        )

    return F.aggregate(_rounds(backwards, ROUNDS), start, back if backwards else turn, lambda now: now["x"] * b + now["y"])


def permuted(value: Column, sizes: tuple[int, int], key: str, kind: str) -> Column:
    """A keyed permutation of the numbers below the product of the two sizes; none stays.

    The network backwards, a step of one, and the network again: the step leaves no number
    in its place, so neither does the whole.
    """
    a, b = sizes
    return let(_network(value, sizes, key, kind, True), lambda n: _network((n + 1) % (a * b), sizes, key, kind, False))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _turned(c: Column, step: Column, alphabets: tuple[str, ...]) -> Column:
    """The character moved on by so many steps in its alphabet."""
    out = c
    for letters in alphabets:
        place = F.instr(F.lit(letters), c)
        turned = F.substring(F.lit(letters), (F.pmod(place - 1 + step, F.lit(len(letters))) + 1).cast("int"), F.lit(1))
        out = F.when((place > 0) & (c != ""), turned).otherwise(out)
    return out


def _rotated(text: Column, number: Column, alphabets: tuple[str, ...], backwards: bool) -> Column:
    """Each character moved on within its alphabet, by steps drawn from the number."""

    def moved(c: Column, at: Column) -> Column:
        step = F.pmod(F.xxhash64(number, at), F.lit(1 << 40))
        return _turned(c, -step if backwards else step, alphabets)

    return F.array_join(F.transform(F.split(text, ""), moved), "")


def _text_network(text: Column, key: str, kind: str, tweak: Column, alphabets: tuple[str, ...], backwards: bool) -> Column:
    """A Feistel network over the two halves of a text of alphabet characters, or its inverse.

    Each character of one half moves on in its alphabet by a number that key and other
    half determine, then the halves change places.
    """
    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(
        F.substring(text, F.lit(1), half).alias("x"), F.substring(text, half + 1, F.length(text)).alias("y")
    )

    def turn(now: Column, i: Column) -> Column:
        x = let(_number(key, kind, tweak, i, now["y"]), lambda n: _rotated(now["x"], n, alphabets, False))
        return F.struct(now["y"].alias("x"), x.alias("y"))

    def back(now: Column, i: Column) -> Column:
        x = let(_number(key, kind, tweak, i, now["x"]), lambda n: _rotated(now["y"], n, alphabets, True))
        return F.struct(x.alias("x"), now["x"].alias("y"))

    rounds = _rounds(backwards, 2 * ROUNDS)
    return F.aggregate(rounds, start, back if backwards else turn, lambda now: F.concat(now["x"], now["y"]))


def _next_letter(c: Column, key: str, kind: str, tweak: Column, alphabets: tuple[str, ...]) -> Column:
    """The character behind ``c`` in a keyed order of its alphabet, the first behind the last."""
    out = c
    for letters in alphabets:
        drawn = F.transform(
            F.split(F.lit(letters), ""), lambda x: F.struct(_number(key, kind, tweak, x).alias("n"), x.alias("c"))
        )
        order = F.transform(F.array_sort(drawn), lambda x: x["c"])
        behind = let(order, lambda o: F.element_at(o, (F.array_position(o, c) % len(letters) + 1).cast("int")))
        out = F.when((F.instr(F.lit(letters), c) > 0) & (c != ""), behind).otherwise(out)
    return out


def permuted_text(
    text: Column, key: str, kind: str, alphabets: tuple[str, ...], tweak: Column | None = None
) -> Column:
    """A keyed permutation of the texts with the same classes of characters in the same places.

    Characters of no alphabet stay and play no part. The others go backwards through a
    Feistel network, the first of them one step on in its alphabet, and through the
    network again: so no text is its own image. One character alone has no halves; it
    goes to the next in a keyed order of its alphabet. A ``tweak`` chooses the
    permutation.
    """
    tweak = F.lit("") if tweak is None else tweak
    letters = "".join(alphabets)
    own = F.regexp_replace(text, f"[^{letters}]", "")

    def image(chars: Column) -> Column:
        back = _text_network(chars, key, kind, tweak, alphabets, True)
        step = let(
            back,
            lambda t: F.concat(_turned(F.substring(t, 1, 1), F.lit(1), alphabets), F.substring(t, F.lit(2), F.length(t))),
        )
        whole = let(step, lambda t: _text_network(t, key, kind, tweak, alphabets, False))
        return F.when(F.length(chars) == 1, _next_letter(chars, key, kind, tweak, alphabets)).otherwise(whole)

    changed = let(let(own, image), lambda t: F.when(own == text, t).otherwise(_refilled(text, t, f"[{letters}]")))
    return F.when(F.length(own) > 0, changed).otherwise(text)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refilled(shape: Column, chars: Column, place: str = "[0-9]") -> Column:
    """The characters in the places of the shape's (its digits), separators as they were."""

    def put(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substring(shape, F.lit(1), i), f"[^{place[1:]}", ""))
        return F.when(c.rlike(place), F.substring(chars, before + 1, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(shape, ""), put), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn's sum of a number whose check digit is the last digit."""

    def add(total: Column, d: Column) -> Column:
        n = d["d"].cast("int") * (1 + d["twice"].cast("int"))
        return total + F.when(n > 9, n - 9).otherwise(n)

    parts = F.transform(
        F.split(F.reverse(digits), ""), lambda d, i: F.struct(d.alias("d"), (i % 2 == 1).alias("twice"))
    )
    return F.aggregate(parts, F.lit(0), add)


def _card(match: Column, key: str) -> Column:
    digits = _digits(match)
    payload = permuted_text(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card", (DIGITS,))

    def checked(own: Column) -> Column:
        check = (10 - _luhn_sum(F.concat(own, F.lit("0"))) % 10) % 10
        return F.concat(own, check.cast("string"))

    new = let(let(payload, checked), lambda n: _refilled(match, n))
    return F.when(_luhn_sum(digits) % 10 == 0, new)


def _mod97(text: Column) -> Column:
    """The remainder of an IBAN's letters and digits by 97, letters as 10 to 35."""

    def add(rest: Column, c: Column) -> Column:
        letter = F.instr(F.lit(UPPER), c)
        return F.when(letter > 0, rest * 100 + letter + 9).otherwise(rest * 10 + c.cast("int")) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _iban(match: Column, key: str) -> Column:
    """Groups play no part in the value; a card number within a group of what is no IBAN is one."""
    plain = F.regexp_replace(match, "[ -]", "")
    land, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    valid = _mod97(F.concat(account, F.substring(plain, 1, 4))) == 1

    def checked(new: Column) -> Column:
        check = 98 - _mod97(F.concat(new, land, F.lit("00")))
        return F.concat(land, F.lpad(check.cast("string"), 2, "0"), new)

    new = let(let(permuted_text(account, key, "iban", (DIGITS, UPPER)), checked), lambda n: _refilled(match, n, "[A-Z0-9]"))
    card = F.regexp_extract(match, KINDS["card"], 0)
    before = F.instr(match, card) - 1
    around = F.substring(match, F.lit(1), before), F.substring(match, before + F.length(card) + 1, F.length(match))
    return F.when(valid, new).when(card != "", F.concat(around[0], _card(card, key), around[1]))


def _date(day: Column, write, key: str) -> Column:
    number = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
    inside = (number >= 0) & (number < DAYS[0] * DAYS[1])
    new = F.date_add(F.lit(FIRST_DAY).cast("date"), permuted(number, DAYS, key, "date").cast("int"))
    return F.when(inside, let(new, write))


def _numeric_date(match: Column, key: str) -> Column:
    """Year first, or else day first if the calendar has such a day, or else month first."""
    parts, mark = F.split(match, "[./-]"), F.regexp_extract(match, "[./-]", 0)
    year_first, day_first = F.length(parts[0]) == 4, _day(parts[2], parts[1], parts[0])
    day = F.when(year_first, _day(parts[0], parts[1], parts[2])).otherwise(
        F.coalesce(day_first, _day(parts[2], parts[0], parts[1]))
    )
    short = F.exists(parts, lambda p: F.length(p) == 1)

    def write(new: Column) -> Column:
        y = F.year(new).cast("string")
        m, d = (
            F.when(short, f(new).cast("string")).otherwise(F.lpad(f(new).cast("string"), 2, "0"))
            for f in (F.month, F.dayofmonth)
        )
        order = F.when(year_first, F.array(y, m, d)).when(day_first.isNotNull(), F.array(d, m, y))
        parts = order.otherwise(F.array(m, d, y))
        return F.concat(parts[0], mark, parts[1], mark, parts[2])

    return _date(day, write, key)


def _named_date(match: Column, key: str) -> Column:
    """A date with an English month, written out or cut to three letters as it was."""
    name, year = F.regexp_extract(match, "[A-Z][a-z]+", 0), F.regexp_extract(match, "[0-9]{4}$", 0)
    number = r"(?<![0-9])[0-9]{1,2}(?![0-9])"
    starts = F.lit("".join(m[:3] for m in MONTHS))
    month = ((F.instr(starts, F.substring(name, 1, 3)) + 2) / 3).cast("int").cast("string")

    def write(new: Column) -> Column:
        names = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(new))
        names = F.when(F.length(name) > 3, names).otherwise(F.substring(names, 1, 3))
        out = F.regexp_replace(match, F.lit("[0-9]{4}$"), F.year(new).cast("string"))
        out = F.regexp_replace(out, F.lit(number), F.dayofmonth(new).cast("string"))
        return F.regexp_replace(out, F.lit("[A-Z][a-z]+"), names)

    return _date(_day(year, month, F.regexp_extract(match, number, 0)), write, key)


def _day(year: Column, month: Column, day: Column) -> Column:
    """The calendar day, null if there is none."""
    return F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def _ip(match: Column, key: str) -> Column:
    octets = F.transform(F.split(match, "\\."), lambda o: o.cast("long"))
    valid = F.forall(octets, lambda o: o <= 255)
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda n, o: n * 256 + o)

    def dotted(new: Column) -> Column:
        return F.concat_ws(".", *[(F.floor(new / 256**k) % 256).cast("string") for k in (3, 2, 1, 0)])

    return F.when(valid, let(permuted(number, (65536, 65536), key, "ip"), dotted))


def _ssn(match: Column, key: str) -> Column:
    area, group, serial = (F.substring(match, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    number = (place * 99 + group - 1) * 9999 + serial - 1

    def written(new: Column) -> Column:
        place = F.floor(new / (99 * 9999))
        area = place + 1 + F.when(place >= 665, 1).otherwise(0)
        parts = ((area, 3), (F.floor(new / 9999) % 99 + 1, 2), (new % 9999 + 1, 4))
        return F.concat_ws("-", *[F.lpad(p.cast("long").cast("string"), n, "0") for p, n in parts])

    return F.when(valid, let(permuted(number, (898 * 99, 9999), key, "ssn"), written))


def _phone(match: Column, key: str) -> Column:
    digits = _digits(match)
    own = F.substring(digits, F.length(digits) - 9, F.lit(10))
    area, exchange, line = (F.substring(own, a, n).cast("long") for a, n in ((1, 3), (4, 3), (7, 4)))
    number = ((area - 200) * 800 + exchange - 200) * 10000 + line
    country = F.substring(digits, F.lit(1), F.length(digits) - 10)

    def written(new: Column) -> Column:
        parts = (F.floor(new / 8_000_000) + 200, F.floor(new / 10000) % 800 + 200)
        line = F.lpad((new % 10000).cast("string"), 4, "0")
        return F.concat(country, *[p.cast("long").cast("string") for p in parts], line)

    # Numbers outside the numbering plan keep the digits that put them there.
    sub, rest = F.substring, F.concat(F.substring(own, 2, 2), F.substring(own, 5, 6))
    other = let(
        permuted_text(rest, key, "other phone", (DIGITS,)),
        lambda n: F.concat(country, sub(own, 1, 1), sub(n, 1, 2), sub(own, 4, 1), sub(n, 3, 6)),
    )
    planned = (area >= 200) & (exchange >= 200)
    new = F.when(planned, let(permuted(number, (80000, 80000), key, "phone"), written)).otherwise(other)
    return let(new, lambda n: _refilled(match, n))


def pseudonym(match: Column, key: str) -> Column:
    """The pseudonym of a candidate; the candidate itself if it is not valid."""
    alnum = (DIGITS, LOWER, UPPER)
    at = F.instr(match, "@")
    domain = F.substring(match, at, F.length(match))
    email = F.concat(permuted_text(F.substring(match, F.lit(1), at - 1), key, "email", alnum, domain), domain)
    digits = _digits(match)
    number = permuted_text(F.substring(digits, F.lit(3), F.length(digits)), key, "foreign", (DIGITS,))
    foreign = let(F.concat(F.substring(digits, 1, 2), number), lambda n: _refilled(match, n))
    secret = F.regexp_extract(match, r"([0-9a-f]{12,64})$", 1)
    opening = F.substring(match, F.lit(1), F.length(match) - F.length(secret))
    access = F.concat(
        F.substring(match, 1, 4), permuted_text(F.substring(match, 5, 16), key, "access", (DIGITS + UPPER,))
    )
    sub = F.substring
    found = (
        F.when(at > 0, email)
        .when(match.rlike(f"^(?:{KINDS['access_key']})$"), access)
        .when(match.rlike("[=:]"), F.concat(opening, permuted_text(secret, key, "secret", (HEX,))))
        .when(match.rlike(f"^(?:{KINDS['named_date']})$"), _named_date(match, key))
        .when(match.rlike("^[A-Z]"), _iban(match, key))
        .when(match.rlike(f"^(?:{KINDS['iso_date']}|{KINDS['numeric_date']})$"), _numeric_date(match, key))
        .when(match.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), _ip(match, key))
        .when(match.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), _ssn(match, key))
        .when(match.rlike(f"^(?:{KINDS['phone']})$"), _phone(match, key))
        .when(match.startswith("+"), foreign)
        .otherwise(_card(match, key))
    )
    return F.coalesce(found, match)


def pseudonymise(documents: DataFrame, key: str) -> DataFrame:
    """``documents`` with personal data in ``text`` replaced, and ``n_pseudonyms``.

    Emails, access keys, hexadecimal secrets behind their name, IBANs (compact or in
    groups of four), dates from 1900 to 2099 (year first with - or /, day or month
    first with . / or -, English months in title case), IPv4 addresses, social
    security numbers, telephone and card numbers. IBANs, cards, dates and
    telephone numbers get the same pseudonym in each of their forms; a date that reads both
    ways is read day first, and one that is only month first stays so. Not recognised: two-digit years, ordinals (May 5th),
    other languages' months, telephone numbers without separators or with a
    leading 0 (2125550187, 030 1234567), IPv6, IBANs in small letters or in groups
    of countries outside IBAN_LENGTHS, names and postal addresses. What fails
    validation stays as it is. A null text stays null with 0
    pseudonyms, an empty one empty; an empty table stays empty; text of any length is read whole; ``n_chars``, if there is one, is
    that of the new text. All other columns stay, but for an earlier n_pseudonyms;
    repeated rows and equal values get equal results.
    """
    some = F.col("text").rlike("[0-9@]|A[KS]IA")
    found = F.when(some, F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)))
    rest = F.when(F.size("_found") > 0, F.split("text", CANDIDATE, -1))
    new = F.transform("_found", lambda m: pseudonym(m, key))
    pairs = F.zip_with("_rest", "_new", lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    changed = F.size(F.filter(F.zip_with("_found", "_new", lambda a, b: a != b), lambda x: x))
    columns = [c for c in documents.columns if c != "n_pseudonyms"]
    # Further columns travel as one, so none can clash with those made here.
    rows = documents.select(F.struct(*columns).alias("_row"), "text")
    rows = rows.withColumn("_found", found).withColumn("_rest", rest)
    some = F.size("_found") > 0
    rows = rows.withColumn("_new", F.when(some, new))
    rows = rows.withColumn("_n", F.coalesce(F.when(some, changed), F.lit(0)).cast("long"))
    rows = rows.withColumn("text", F.when(some, F.array_join(pairs, "")).otherwise(F.col("text")))
    made = {"text": F.col("text")}
    if "n_chars" in columns:
        kind = documents.schema["n_chars"].dataType
        made["n_chars"] = F.when(some, F.length("text")).otherwise(F.col("_row")["n_chars"]).cast(kind)
    return rows.select(*[made.get(c, F.col("_row")[c]).alias(c) for c in columns], F.col("_n").alias("n_pseudonyms"))
