"""Format-preserving pseudonyms for personal numbers, dates and addresses, natively in Spark.

Candidates are found by one pattern and validated by kind.  Each valid value is mapped by a keyed Feistel network over
the values of its own format, a permutation: equal values get equal pseudonyms in every document, different values
different ones, and a pseudonym is again a valid value of the format.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import column, unused

KEY = "change-this-key"
ROUNDS = 8

# The formats.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])"
IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
ISO_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9]|-[0-9])"
DOT_DATE = r"(?<![0-9.])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![0-9]|\.[0-9])"
SLASH_DATE = r"(?<![0-9/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9]|/[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
PHONE = r"(?<![0-9])(?:\+1[ -])?(?:\([0-9]{3}\) ?|[0-9]{3}[ -])[0-9]{3}-[0-9]{4}(?![0-9]|-[0-9])"
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
#: All formats but cards (one look decides at most characters), and, in what they leave, the stretches of digits, blanks
#: and hyphens that may hold cards.
NO_CARD = f"(?=[0-9+(])(?:{'|'.join([IP, ISO_DATE, DOT_DATE, SLASH_DATE, SSN, PHONE])})|{EMAIL}"
STRETCH = r"(?<![0-9])[0-9][0-9 -]{12,}+"
CARD_DIGITS = 19
#: Two noncharacters of Unicode.  The first marks where candidates begin and end; where a text has it, the second
#: follows it meanwhile.
MARK, STAYS = "\ufdd0", "\ufdd1"
FOUND_TYPE = "array<struct<kind:string,value:string,pseudonym:string>>"
KINDS = ("email", "ip", "date", "ssn", "phone", "card")
FIRST_DAY = "1900-01-01"
DAY_SIDE = 270  # 270 x 270 days: 1900-01-01 to 2099-08-04
LATE_SIDE = 210  # 210 x 210 days after the 12th of a month: 1900-01-13 to 2099-04-30
LATE_DAYS_A_MONTH = 18.437  # on average
AREAS, GROUPS, SERIALS = 898, 99, 9999  # assigned social security areas 001-899 without 666, groups, serials


def whole(pattern: str, value: Column) -> Column:
    return F.regexp_like(value, F.lit(f"^(?:{pattern})$"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the value, which is computed once however often the body or its inner functions use it."""
    return F.transform(F.array(value), body)[0]


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def number(text: Column) -> Column:
    return text.try_cast("bigint")


def part(value: Column, start: Column | int, length: Column | int) -> Column:
    return F.substring(value, start, length)


def hashed(key: str, tag: str, step: Column, value: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(key), F.lit(tag), step.cast("string"), value.cast("string")).cast("binary"), 256)


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, tag: str) -> Column:
    """Keyed permutation of the pairs (0 <= left < a, 0 <= right < b): struct (l, r).  Rounds add a hash of one half to
    the other, by turns, so any a and b will do."""

    def step(pair: Column, i: Column) -> Column:
        def moved(half: str, other: str, size: Column) -> Column:
            add = F.conv(F.substring(hashed(key, tag, i, pair[other]), 1, 15), 16, 10).cast("bigint")
            return F.pmod(pair[half] + F.pmod(add, size), size)

        even = i % 2 == 0
        return F.struct(
            F.when(even, moved("l", "r", a)).otherwise(pair["l"]).alias("l"),
            F.when(even, pair["r"]).otherwise(moved("r", "l", b)).alias("r"),
        )

    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def power_of_ten(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("bigint")


def padded(value: Column, width: Column | int) -> Column:
    return F.lpad(value.cast("string"), width, F.lit("0"))


def permuted_digits(value: Column, key: str, tag: str) -> Column:
    """A string of digits mapped to another of the same length."""
    half = F.floor(F.length(value) / 2).cast("int")
    rest = F.length(value) - half
    left, right = number(part(value, F.lit(1), half)), number(part(value, half + 1, rest))
    pair = feistel(left, right, power_of_ten(half), power_of_ten(rest), key, tag)
    return let(pair, lambda p: F.concat(padded(p["l"], half), padded(p["r"], rest)))


def luhn_sum(value: Column, last_weight: int) -> Column:
    """Weighted digit sum, weights 1 and 2 alternating from ``last_weight`` at the last digit."""

    def add(total: Column, i: Column) -> Column:
        d = part(value, F.length(value) - i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((i + last_weight) % 2 == 1, d).otherwise(doubled)

    return F.aggregate(F.sequence(F.lit(0), F.length(value) - 1), F.lit(0), add)


def put_back(value: Column, new_digits: Column) -> Column:
    """``value`` with its digits replaced in order; everything else stays."""

    def char(i: Column) -> Column:
        own = part(value, i, F.lit(1))
        return F.when(own.between("0", "9"), part(new_digits, F.length(digits(part(value, F.lit(1), i))), F.lit(1))).otherwise(own)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), char), "")


def octet(value: Column, i: int) -> Column:
    return number(F.split(value, r"\.")[i])


def date_of(value: Column) -> Column:
    return F.coalesce(
        F.when(whole(ISO_DATE, value), F.try_to_date(value, "yyyy-MM-dd")),
        F.when(whole(DOT_DATE, value), F.try_to_date(value, "dd.MM.yyyy")),
        F.when(whole(SLASH_DATE, value), F.try_to_date(value, "MM/dd/yyyy")),
    )


def day_number(value: Column) -> Column:
    return F.date_diff(date_of(value), F.lit(FIRST_DAY).cast("date"))


def months_on(months: Column) -> Column:
    """The first day of a month, counted from January 1900."""
    return F.add_months(F.lit(FIRST_DAY).cast("date"), months.cast("int"))


def late_days_before(months: Column) -> Column:
    """Days after the 12th in all months before one."""
    return F.date_diff(months_on(months), F.lit(FIRST_DAY).cast("date")) - 12 * months


def late_number(value: Column) -> Column:
    """The place of a slash date that can only be read day first (``24/12/2020``) among all days after the 12th.  These
    dates are a format of their own: were they mapped to any day, some pseudonyms would read as month first."""
    date = F.when(whole(SLASH_DATE, value) & (number(part(value, F.lit(1), F.lit(2))) > 12), F.try_to_date(value, "dd/MM/yyyy"))
    months = (F.year(date) - 1900) * 12 + F.month(date) - 1
    return F.when(date >= F.lit(FIRST_DAY).cast("date"), late_days_before(months) + F.day(date) - 13)


def late_date(place: Column) -> Column:
    """The day after the 12th at a place; its month is at most two from where an average month would have it."""
    about = F.floor(place / LATE_DAYS_A_MONTH).cast("int")
    near = F.sequence(F.greatest(about - 2, F.lit(0)), about + 2)
    month = F.array_max(F.filter(near, lambda m: late_days_before(m) <= place))
    return let(month, lambda m: F.date_add(months_on(m), (place - late_days_before(m) + 12).cast("int")))


def kind_of(value: Column) -> Column:
    """The kind of a valid candidate, null for an invalid one."""
    d = digits(value)
    octets = [F.split(value, r"\.")[i] for i in range(4)]
    plain_octets = F.lit(True)
    for o in octets:
        plain_octets = plain_octets & (number(o) <= 255) & (number(o).cast("string") == o)
    area, group, serial = (number(part(d, F.lit(s), F.lit(n))) for s, n in ((1, 3), (4, 2), (6, 4)))
    assigned = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    is_date = F.coalesce(day_number(value).between(0, DAY_SIDE * DAY_SIDE - 1), F.lit(False))
    is_date = is_date | F.coalesce(late_number(value).between(0, LATE_SIDE * LATE_SIDE - 1), F.lit(False))
    return (
        F.when(F.contains(value, F.lit("@")), "email")
        .when(whole(IP, value), F.when(plain_octets, "ip"))
        .when(whole(ISO_DATE, value) | whole(DOT_DATE, value) | whole(SLASH_DATE, value), F.when(is_date, "date"))
        .when(whole(SSN, value), F.when(assigned, "ssn"))
        .when(whole(PHONE, value), "phone")
    )


def sorted_piece(kind: Column, value: Column) -> Column:
    return F.struct(kind.cast("string").alias("kind"), value.alias("value"))


def cards_in(stretch: Column) -> Column:
    """A stretch as pieces (kind, value): the Luhn-valid runs of 13 to 19 digits that start and end at group borders are
    cards, the rest is plain.  Of runs that overlap the longer one counts, of equally long ones the first."""

    def runs(groups: Column) -> Column:
        """The longest valid run from each group, as places among the groups and separators."""

        def longest(start: Column) -> Column:
            ends = F.sequence(start, F.least(F.size(groups), start + 2 * CARD_DIGITS - 2), F.lit(2))
            made = F.transform(ends, lambda end: F.struct(
                start.alias("start"), end.alias("end"), F.array_join(F.slice(groups, start, end - start + 1), "").alias("value")
            ))
            valid = F.filter(made, lambda r: F.when(whole(CARD, r["value"]), luhn_sum(digits(r["value"]), 1) % 10 == 0).otherwise(False))
            return F.slice(valid, -1, 1)

        found = F.transform(F.sequence(F.lit(1), F.size(groups), F.lit(2)), longest)
        return F.flatten(found)

    def apart(found: Column) -> Column:
        def add(chosen: Column, run: Column) -> Column:
            last = F.get(chosen, F.size(chosen) - 1)
            longer = F.length(digits(run["value"])) > F.length(digits(last["value"]))
            instead = F.concat(F.slice(chosen, F.lit(1), F.size(chosen) - 1), F.array(run))
            after = F.concat(chosen, F.array(run))
            overlap = F.coalesce(last["end"] >= run["start"], F.lit(False))
            return F.when(~overlap, after).when(longer, instead).otherwise(chosen)

        return F.aggregate(found, F.slice(found, F.lit(1), F.lit(0)), add)

    def cut(groups: Column, chosen: Column) -> Column:
        def plain(start: Column, end: Column) -> Column:
            return sorted_piece(F.lit(None), F.array_join(F.slice(groups, start, end - start + 1), ""))

        def with_gap(run: Column, at: Column) -> Column:
            before = F.coalesce(F.get(chosen, at - 1)["end"], F.lit(0))
            return F.array(plain(before + 1, run["start"] - 1), sorted_piece(F.lit("card"), run["value"]))

        rest = F.coalesce(F.get(chosen, F.size(chosen) - 1)["end"], F.lit(0))
        return F.concat(F.flatten(F.transform(chosen, with_gap)), F.array(plain(rest + 1, F.size(groups))))

    groups = F.regexp_extract_all(stretch, F.lit("[0-9]+|[^0-9]+"), F.lit(0))
    return let(groups, lambda g: let(apart(runs(g)), lambda chosen: cut(g, chosen)))


def is_kind(kind: str) -> Callable[[Column], Column]:
    """Predicate on an element of the ``found`` column."""
    return lambda f: f["kind"] == kind


def new_card(value: Column, key: str) -> Column:
    def checked(payload: Column) -> Column:
        return F.concat(payload, ((10 - luhn_sum(payload, 2) % 10) % 10).cast("string"))

    payload = let(digits(value), lambda d: permuted_digits(part(d, F.lit(1), F.length(d) - 1), key, "card"))
    return let(let(payload, checked), lambda new: put_back(value, new))


def new_phone(value: Column, key: str) -> Column:
    def new_digits(d: Column) -> Column:
        return F.concat(part(d, F.lit(1), F.length(d) - 10), permuted_digits(F.right(d, F.lit(10)), key, "phone"))

    return let(let(digits(value), new_digits), lambda new: put_back(value, new))


def new_ip(value: Column, key: str) -> Column:
    side = F.lit(65536).cast("bigint")
    pair = feistel(octet(value, 0) * 256 + octet(value, 1), octet(value, 2) * 256 + octet(value, 3), side, side, key, "ip")

    def dotted(p: Column) -> Column:
        halves = [f(p[h]) for h in ("l", "r") for f in (lambda x: F.floor(x / 256), lambda x: x % 256)]
        return F.concat_ws(".", *(h.cast("bigint").cast("string") for h in halves))

    return let(pair, dotted)


def new_ssn(value: Column, key: str) -> Column:
    d = digits(value)
    area, group, serial = (number(part(d, F.lit(s), F.lit(n))) for s, n in ((1, 3), (4, 2), (6, 4)))
    index = area - 1 - (area > 666).cast("int")
    a, b = F.lit(AREAS * GROUPS).cast("bigint"), F.lit(SERIALS).cast("bigint")
    pair = feistel(index * GROUPS + group - 1, serial - 1, a, b, key, "ssn")

    def dashed(p: Column) -> Column:
        new = F.floor(p["l"] / GROUPS)
        return F.concat_ws(
            "-", padded(new + 1 + (new >= 665).cast("int"), 3), padded(p["l"] % GROUPS + 1, 2), padded(p["r"] + 1, 4)
        )

    return let(pair, dashed)


def new_date(value: Column, key: str) -> Column:
    def permuted(day: Column, sides: int, tag: str) -> Column:
        side = F.lit(sides).cast("bigint")
        return let(feistel(F.floor(day / sides), day % sides, side, side, key, tag), lambda p: p["l"] * sides + p["r"])

    def written(day: Column) -> Column:
        date = F.date_add(F.lit(FIRST_DAY).cast("date"), day.cast("int"))
        return (
            F.when(whole(ISO_DATE, value), F.date_format(date, "yyyy-MM-dd"))
            .when(whole(DOT_DATE, value), F.date_format(date, "dd.MM.yyyy"))
            .otherwise(F.date_format(date, "MM/dd/yyyy"))
        )

    late = let(permuted(late_number(value), LATE_SIDE, "late date"), lambda place: F.date_format(late_date(place), "dd/MM/yyyy"))
    return F.when(late_number(value).isNotNull(), late).otherwise(let(permuted(day_number(value), DAY_SIDE, "date"), written))


def new_email(value: Column, key: str) -> Column:
    """The part before the @ as a Feistel network over its characters: digits, small and capital letters each move
    within their class; at most 64 characters, so a hash has enough bytes for a half."""

    def shifted(half: Column, step: Column, other: Column) -> Column:
        def char(stream: Column, i: Column) -> Column:
            own = part(half, i, F.lit(1))
            add, code = F.conv(part(stream, 2 * i - 1, F.lit(2)), 16, 10).cast("int"), F.ascii(own)

            def within(first: str, n: int) -> Column:
                return F.char(F.lit(ord(first)) + (code - ord(first) + add) % n)

            return (
                F.when(own.between("0", "9"), within("0", 10))
                .when(own.between("a", "z"), within("a", 26))
                .when(own.between("A", "Z"), within("A", 26))
                .otherwise(own)
            )

        places = F.sequence(F.lit(1), F.length(half))
        stream = hashed(key, "email", step, other)
        moved = let(stream, lambda s: F.array_join(F.transform(places, lambda i: char(s, i)), ""))
        return F.when(F.length(half) == 0, half).otherwise(moved)

    def step(pair: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, shifted(pair["l"], i, pair["r"])).otherwise(pair["l"]).alias("l"),
            F.when(even, pair["r"]).otherwise(shifted(pair["r"], i, pair["l"])).alias("r"),
        )

    name = F.substring_index(value, "@", 1)
    half = F.floor(F.length(name) / 2).cast("int")
    start = F.struct(part(name, F.lit(1), half).alias("l"), part(name, half + 1, F.length(name)).alias("r"))
    pair = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)
    return let(pair, lambda p: F.concat(p["l"], p["r"], F.lit("@"), F.substring_index(value, "@", -1)))


def pseudonym(kind: Column, value: Column, key: str) -> Column:
    """The value's pseudonym; an invalid candidate stays."""
    made = F.lit(None).cast("string")
    for name, make in zip(KINDS, (new_email, new_ip, new_date, new_ssn, new_phone, new_card)):
        made = F.when(kind == name, make(value, key)).otherwise(made)
    return F.coalesce(made, value)


def pseudonymise(docs: DataFrame, key: str = KEY, text_col: str = "text", found_col: str = "found") -> DataFrame:
    """``docs`` with pseudonyms in its text, and a column of what was found: array of (kind, value, pseudonym).

    E-mail addresses (the part before the @), IPv4 addresses, dates from 1900-01-01 to 2099-08-04 (slash dates are month
    first, those whose first number is above 12 day first and up to 2099-04-30), social security numbers, North American phone numbers and Luhn-valid card numbers of 13 to 19 digits are replaced; candidates that
    fail validation stay.  A null text stays null with nothing found; an empty text stays empty.  Repeated rows are
    treated alike, other columns stay; ``found_col`` gets another name where ``docs`` has one of that name.
    """
    text = column(docs, text_col).cast("string")
    guarded = F.replace(text, F.lit(MARK), F.lit(MARK + STAYS))

    def split(value: Column, pattern: str) -> Column:
        """Every second piece is a match."""
        return F.split(F.regexp_replace(value, f"({pattern})", f"{MARK}$1{MARK}"), f"{MARK}(?!{STAYS})", -1)

    def within(piece: Column, at: Column) -> Column:
        return F.when(at % 2 == 1, cards_in(piece)).otherwise(F.array(sorted_piece(F.lit(None), piece)))

    def sort(piece: Column, at: Column) -> Column:
        cards = F.flatten(F.transform(split(piece, STRETCH), within))
        return F.when(at % 2 == 1, F.array(sorted_piece(kind_of(piece), piece))).otherwise(cards)

    def judge(f: Column) -> Column:
        return F.struct(f["kind"].alias("kind"), f["value"].alias("value"), pseudonym(f["kind"], f["value"], key).alias("pseudonym"))

    judged, found = unused(docs, "pieces"), unused(docs, found_col)
    named = docs.withColumn(judged, F.transform(F.flatten(F.transform(split(guarded, NO_CARD), sort)), judge))
    new = F.array_join(F.transform(judged, lambda f: f["pseudonym"]), "")
    listed = F.filter(judged, lambda f: f["kind"].isNotNull())
    return (
        named.withColumn(text_col, F.replace(new, F.lit(MARK + STAYS), F.lit(MARK)))
        .withColumn(found, F.coalesce(listed, F.array().cast(FOUND_TYPE)))
        .drop(judged)
    )
