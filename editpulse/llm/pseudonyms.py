"""Personal data replaced by keyed pseudonyms of the same format, in SQL functions alone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# From 1600-01-01 to 2099-12-31, the dates found, there are 182622 = 66 * 2767 days, so they are permuted without gaps.
_FIRST_DAY, _DAYS_LEFT, _DAYS_RIGHT = "1600-01-01", 66, 2767
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    """What a find looks like as a whole; the first kind whose ``pattern`` it matches is its kind."""

    name: str
    pattern: str


_DATE = r"(?:1[6-9]|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])"
_SSN = r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}"
_LOCAL_PHONE = r"(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
# Layouts of cards: unbroken, and groups of 4-4-4-4, 4-6-5 and 4-6-4 digits.
_CARD_LAYOUT = r"[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}"
# Numbers only where no digit or letter touches them.
_EDGE, _STOP = r"(?<![A-Za-z0-9.+-])", r"(?![A-Za-z0-9]|[.-][0-9])"
# What a longer number with separators must not swallow.
_FIXED = rf"(?:{_DATE}|{_SSN}|{_LOCAL_PHONE}){_STOP}"
_OWN = f"(?!{_FIXED})"

KINDS = (
    # A host has at most 127 labels; the bound also keeps Java from recursing for each label of a long run.
    Kind("email", r"[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.){1,126}[A-Za-z]{2,}"),
    Kind("date", _DATE),
    Kind("ipv4", rf"{_OCTET}(?:\.{_OCTET}){{3}}"),
    Kind("ssn", _SSN),
    Kind("card", r"[0-9](?:[ -]?[0-9]){12,18}"),
    Kind(
        "phone",
        rf"(?:\+[0-9]{{1,3}}[ .-]?)?{_LOCAL_PHONE}"
        rf"|\+[0-9]{{1,3}}(?:[ .-]?\([0-9]{{1,4}}\)[ .-]?)?(?:[ .-]{_OWN}(?!(?:{_CARD_LAYOUT}){_STOP})[0-9]|[0-9]){{6,12}}",
    ),
)
# Groups of digits with single blanks or hyphens between, none of which begins one of the other kinds; the
# cards are sought inside. Possessive, as Java would recurse for each group of a long run.
_GROUP = r"[0-9]++(?![A-Za-z]|\.[0-9]|-[0-9]++(?:[A-Za-z]|\.[0-9]))"
_RUN = rf"(?=(?:[ -]?[0-9]){{13}}){_GROUP}(?:[ -]{_OWN}{_GROUP})*+(?:(?!-[0-9])|(?=-{_FIXED}))"
_PATTERNS = {k.name: k.pattern for k in KINDS}
# One pass over the text; emails before what could be inside them, fixed layouts before runs of digits.
_ANY = "|".join(
    [
        rf"(?<![A-Za-z0-9._%+-]){_PATTERNS['email']}",
        *[f"{_EDGE}(?:{_PATTERNS[k]}){_STOP}" for k in ("date", "ipv4", "ssn")],
        f"(?<![A-Za-z0-9+])(?:{_PATTERNS['phone']}){_STOP}",
        f"{_EDGE}{_RUN}",
    ]
)
# Calling codes, as far as they can be told from the digits after them.
_CODE = r"^(\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})[ .-]?)?"


def _mix(key: str, tweak: Column, step: Column, half: Column) -> Column:
    """A keyed function of one half: 48 bits of a digest."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, step.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")


def _feistel(key: str, tweak: Column, left: Column, right: Column, left_size: Column, right_size: Column) -> Column:
    """A permutation of the pairs (left, right): each round adds a keyed function of one half to the other."""
    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))

    def turn(state: Column, step: Column) -> Column:
        l, r = state.getField("l"), state.getField("r")
        return F.when(
            step % 2 == 0, F.struct(((l + _mix(key, tweak, step, r)) % left_size).alias("l"), r.alias("r"))
        ).otherwise(F.struct(l.alias("l"), ((r + _mix(key, tweak, step, l)) % right_size).alias("r")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("bigint")


def _digits_permuted(key: str, tweak: Column, digits: Column) -> Column:
    """Digits of any number from 2 to 19, permuted within the strings of that length."""
    n = F.length(digits)
    half = (n / 2).cast("int")
    left, right = F.substring(digits, F.lit(1), half), F.substring(digits, half + 1, n)
    pair = _feistel(key, F.concat(tweak, n.cast("string")), left, right, _power(half), _power(n - half))
    return F.concat(F.lpad(pair["l"].cast("string"), half, "0"), F.lpad(pair["r"].cast("string"), n - half, "0"))


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a digit string, modulo 10."""
    listed = F.transform(F.split(F.reverse(digits), "(?<=.)(?=.)"), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(listed, F.lit(0), lambda a, d: a + d) % 10


def _filled(format_: Column, digits: Column) -> Column:
    """``format_`` with its digits replaced, one after another."""
    parts = F.split(format_, "(?<=.)(?=.)")
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def put(state: Column, char: Column) -> Column:
        number = (char >= "0") & (char <= "9")
        return F.struct(
            F.concat(state.getField("out"), F.when(number, F.substring(digits, state.getField("at"), F.lit(1))).otherwise(char)).alias("out"),
            (state.getField("at") + number.cast("int")).alias("at"),
        )

    return F.aggregate(parts, start, put).getField("out")


def _email(key: str, value: Column) -> Column:
    """The part before @, lower-cased, permuted among those with letters and digits in the same places; the domain stays.

    A Feistel network over characters: in each round those at even or odd places are shifted by a keyed stream drawn from
    the others, so different addresses of a domain keep different pseudonyms.
    """
    at = F.instr(value, "@")
    local, domain = F.substring(F.lower(value), F.lit(1), at - 1), F.substring(value, at, F.length(value))
    letters = "abcdefghijklmnopqrstuvwxyz"

    def code(char: Column) -> Column:
        """0 to 25 for letters, 100 to 109 for digits, -1 for what stays."""
        return F.when(char.between("a", "z"), F.ascii(char) - 97).when(char.between("0", "9"), F.ascii(char) + 52).otherwise(-1)

    def turn(state: Column, step: Column) -> Column:
        others = F.array_join(F.transform(state, lambda c, i: F.when(i % 2 != step % 2, c.cast("string")).otherwise("")), ",")
        stream = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(domain), step.cast("string"), others), 512)

        def shifted(drawn: Column) -> Column:
            def shift(c: Column, i: Column) -> Column:
                by = F.conv(F.substring(drawn, ((i / 2).cast("int") % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")
                moved = F.when(c < 26, (c + by) % 26).otherwise((c - 100 + by) % 10 + 100)
                return F.when((c < 0) | (i % 2 != step % 2), c).otherwise(moved)

            return F.transform(state, shift)

        # The stream becomes a variable, so that it is drawn once and not once for each character.
        return F.element_at(F.transform(F.array(stream), shifted), 1)

    parts = F.split(local, "(?<=.)(?=.)")
    codes = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.transform(parts, code), turn)

    def char(c: Column, old: Column) -> Column:
        return F.when(c < 0, old).when(c < 26, F.substring(F.lit(letters), c + 1, F.lit(1))).otherwise((c - 100).cast("string"))

    return F.concat(F.array_join(F.zip_with(codes, parts, char), ""), domain)


def _date(key: str, value: Column) -> Column:
    days = F.datediff(F.try_to_timestamp(value, F.lit("yyyy-MM-dd")).cast("date"), F.lit(_FIRST_DAY).cast("date"))
    left, right = (days / _DAYS_RIGHT).cast("int"), days % _DAYS_RIGHT
    pair = _feistel(key, F.lit("date"), left, right, F.lit(_DAYS_LEFT), F.lit(_DAYS_RIGHT))
    return F.date_format(F.date_add(F.lit(_FIRST_DAY).cast("date"), (pair["l"] * _DAYS_RIGHT + pair["r"]).cast("int")), "yyyy-MM-dd")


def _ipv4(key: str, value: Column) -> Column:
    part = [F.split(value, r"\.").getItem(i).cast("int") for i in range(4)]
    pair = _feistel(key, F.lit("ipv4"), part[0] * 256 + part[1], part[2] * 256 + part[3], F.lit(65536), F.lit(65536))
    octets = [F.floor(pair[h] / 256) if high else pair[h] % 256 for h in ("l", "r") for high in (True, False)]
    return F.concat_ws(".", *[o.cast("string") for o in octets])


def _card(key: str, value: Column) -> Column:
    """All digits but the last are permuted; the last makes the Luhn sum 0 again."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    body = _digits_permuted(key, F.lit("card"), F.substring(digits, F.lit(1), F.length(digits) - 1))
    check = (10 - luhn_sum(F.concat(body, F.lit("0")))) % 10
    return _filled(value, F.concat(body, check.cast("string")))


def _ssn(key: str, value: Column) -> Column:
    """Permuted among the numbers that are given out: areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = (F.substring(value, at, n).cast("bigint") for at, n in ((1, 3), (5, 2), (8, 4)))
    pair = _feistel(key, F.lit("ssn"), area - 1 - (area > 666).cast("int"), (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999))
    new_area = pair["l"] + 1 + (pair["l"] >= 665).cast("int")
    new_group, new_serial = F.floor(pair["r"] / 9999) + 1, pair["r"] % 9999 + 1
    return F.concat_ws("-", *[F.lpad(x.cast("string"), n, "0") for x, n in ((new_area, 3), (new_group, 2), (new_serial, 4))])


def _phone(key: str, value: Column, kept: Column) -> Column:
    """Digits permuted in their places, but for the first ``kept`` characters (a country code).

    A number that begins with 2 to 9 is permuted among those that do, and one that begins with 0 or 1 likewise; of ten digits,
    as area, exchange and line, the same holds for the fourth.
    """
    head, tail = F.substring(value, F.lit(1), kept), F.substring(value, kept + 1, F.length(value))
    digits = F.regexp_replace(tail, "[^0-9]", "")
    n = F.length(digits)
    half = F.when(n == 10, 3).otherwise((n / 2).cast("int"))
    left, right = F.substring(digits, F.lit(1), half), F.substring(digits, half + 1, n)

    def low(part: Column, narrowed: Column) -> Column:
        """(what a part's first digit begins at, how many it may be), as multiples of its place."""
        return F.when(~narrowed, F.struct(F.lit(0).alias("from"), F.lit(10).alias("of"))).when(
            F.substring(part, 1, 1) >= "2", F.struct(F.lit(2).alias("from"), F.lit(8).alias("of"))
        ).otherwise(F.struct(F.lit(0).alias("from"), F.lit(2).alias("of")))

    def permuted(l_from: Column, r_from: Column) -> Column:
        l_place, r_place = _power(half - 1), _power(n - half - 1)
        l_start, r_start = l_from["from"] * l_place, r_from["from"] * r_place
        tweak = F.concat_ws("|", F.lit("phone"), n.cast("string"), l_from["from"].cast("string"), r_from["from"].cast("string"))
        pair = _feistel(key, tweak, left.cast("bigint") - l_start, right.cast("bigint") - r_start, l_from["of"] * l_place, r_from["of"] * r_place)
        return F.concat(F.lpad((pair["l"] + l_start).cast("string"), half, "0"), F.lpad((pair["r"] + r_start).cast("string"), n - half, "0"))

    return F.concat(head, _filled(tail, permuted(low(left, F.lit(True)), low(right, n == 10))))


def _kind_of(value: Column) -> Column:
    """The kind of a find, 'run' for digits in which cards are to be sought, '' for dates that are none."""
    whole = {k.name: value.rlike(rf"^(?:{k.pattern})$") for k in KINDS}
    real_date = F.try_to_timestamp(value, F.lit("yyyy-MM-dd")).isNotNull()
    return (
        F.when(whole["email"], "email")
        .when(whole["date"], F.when(real_date, "date").otherwise(""))
        .when(whole["ipv4"], "ipv4")
        .when(whole["ssn"], "ssn")
        .when(whole["phone"], "phone")
        .otherwise("run")
    )


def _cards_in(run: Column) -> Column:
    """A run of digit groups in pieces (kind, value): cards, and what lies between them with kind ''.

    From each group on, every end after 13 to 19 digits is tried: the layouts of cards first, then the longest. Beside those
    layouts a card has groups of three digits or more, or is the whole run: lists of small numbers
    would hold a right Luhn sum somewhere. What no card takes is tried again from its next group.
    """

    def joined(groups: Column, first: Column, many: Column) -> Column:
        return F.array_join(F.slice(groups, first + 1, many), "")

    def best(groups: Column, first: Column) -> Column:
        """The number of groups of the card that begins here; null if none does."""
        left = F.size(groups) - first
        tried = F.transform(
            F.sequence(F.lit(1), F.least(F.lit(19), left)),
            lambda m: F.struct(m.alias("m"), F.regexp_replace(joined(groups, first, m), "[ -]$", "").alias("value")),
        )
        sized = F.filter(tried, lambda t: F.length(F.regexp_replace(t["value"], "[^0-9]", "")).between(13, 19))
        layout = lambda t: t["value"].rlike(f"^(?:{_CARD_LAYOUT})$")
        loose = lambda t: ~t["value"].rlike("(?<![0-9])[0-9]{1,2}(?![0-9])") | ((first == 0) & (t["m"] == left))
        right = F.filter(sized, lambda t: (layout(t) | loose(t)) & (luhn_sum(F.regexp_replace(t["value"], "[^0-9]", "")) == 0))
        return F.array_max(F.transform(right, lambda t: F.struct(layout(t).alias("layout"), t["m"].alias("m"))))["m"]

    def piece(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.alias("value"))

    def scanned(groups: Column) -> Column:
        start = F.struct(F.array().cast("array<struct<kind:string,value:string>>").alias("out"), F.lit(0).alias("done"))

        def found(state: Column, first: Column, many: Column) -> Column:
            before, card = joined(groups, state["done"], first - state["done"]), joined(groups, first, many)
            bare = F.regexp_replace(card, "[ -]$", "")
            new = F.array(piece("", before), piece("card", bare), piece("", F.substring(card, F.length(bare) + 1, F.lit(1))))
            return F.struct(F.concat(state["out"], new).alias("out"), (first + many).alias("done"))

        def step(state: Column, first: Column) -> Column:
            many = F.element_at(F.transform(F.array(best(groups, first)), lambda m: F.when(m.isNull(), state).otherwise(found(state, first, m))), 1)
            return F.when(first < state["done"], state).otherwise(many)

        def end(state: Column) -> Column:
            return F.concat(state["out"], F.array(piece("", joined(groups, state["done"], F.size(groups) - state["done"]))))

        return F.aggregate(F.sequence(F.lit(0), F.size(groups) - 1), start, step, end)

    # The groups become a variable, so that they are split once and not once for each step.
    return F.element_at(F.transform(F.array(F.split(run, "(?<=[ -])")), scanned), 1)


def pseudonym(key: str, kind: Column, value: Column) -> Column:
    """The pseudonym of a value of its kind; other values stay."""
    prefix = F.length(F.regexp_extract(value, _CODE, 0))
    return (
        F.when(kind == "email", _email(key, value))
        .when(kind == "date", _date(key, value))
        .when(kind == "ipv4", _ipv4(key, value))
        .when(kind == "ssn", _ssn(key, value))
        .when(kind == "card", _card(key, value))
        .when(kind == "phone", _phone(key, value, prefix))
        .otherwise(value)
    )


def pseudonymise(docs: DataFrame, key: str, text: str = "text", found: str = "pii") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``found``: kind, value as written there now, in text order.

    Emails, ISO dates from 1600 to 2099, IPv4 addresses, social security numbers, card numbers with a right
    Luhn sum (13 to 19 digits, blanks or hyphens between, other digits may stand next to them), and phone
    numbers: 3-3-4 with separators, or + and 7 to 15 digits. Other phone layouts can't be told from plain
    numbers and stay. Fixed layouts win over longer runs of digits. Numbers and dates are
    permuted by a keyed Feistel network within their format: digits change in their places, a card
    stays valid, a social security number one that can be given out, a date a date, an address an address; a phone number's
    first digit stays below 2 or not; country codes and email domains stay. Hosts of more than 127 labels make no email. Equal
    values get equal pseudonyms in all documents, for cards and phones also if spaced differently. The same
    key gives the same pseudonyms; without it they can't be undone or linked to the values.

    Everything is a projection: no shuffle, no state, whole texts. A null text stays null with no finds,
    other texts keep every other character. Repeated rows stay. A column named like ``found`` gives way.
    """
    source = F.col(f"`{text}`")
    values = F.regexp_extract_all(source, F.lit(f"({_ANY})"), F.lit(1))
    known = F.transform(values, lambda v: F.struct(_kind_of(v).alias("kind"), v.alias("value")))
    kinds = F.transform(known, lambda x: F.when(x.getField("kind") == "run", _cards_in(x.getField("value"))).otherwise(F.array(x)))
    swapped = F.transform(
        F.col("_kinds"),
        lambda find: F.transform(find, lambda x: F.struct(x.getField("kind").alias("kind"), pseudonym(key, x.getField("kind"), x.getField("value")).alias("value"))),
    )
    between = F.split(source, _ANY, -1)
    new = F.array_join(F.zip_with(between, F.col("_swapped"), lambda a, b: F.concat(a, F.coalesce(F.array_join(b.getField("value"), ""), F.lit("")))), "")
    names = docs.columns
    none = F.array().cast("array<array<struct<kind:string,value:string>>>")
    # Most texts have no digit and no @, and then no find: that test is far cheaper than the pattern.
    kinded = docs.withColumn("_kinds", F.when(source.rlike("[0-9@]") & source.rlike(_ANY), kinds).otherwise(none))
    done = kinded.withColumn("_swapped", F.when(F.size("_kinds") > 0, swapped).otherwise(none))
    replaced = done.withColumn("_new", F.when(F.size("_kinds") > 0, new).otherwise(source))
    listed = F.filter(F.flatten("_swapped"), lambda x: x.getField("kind") != "")
    return replaced.select(
        *[F.col("_new").alias(c) if c == text else F.col(f"`{c}`") for c in names if c != found], listed.alias(found)
    )
