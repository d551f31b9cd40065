"""Format-preserving pseudonyms for numbers, dates and addresses in texts.

A value found in a text is taken apart into small integers, each with its own
radix (a digit, a letter, an octet, a part of a day number). A keyed Feistel
network permutes these tuples: in each round the entries at even or odd places
are shifted, modulo their radix, by a hash of the others. That is a bijection on
values of one format, so equal values get equal pseudonyms in every document and
different values different ones. Values that
fail validation (checksum, calendar, range) are no such numbers and stay.

====== ======================================= ===========================================
kind   validated by                            kept as it is
====== ======================================= ===========================================
card   13-19 digits, Luhn checksum             first digit, separators; new check digit
ssn    area, group and serial in range         separators
date   the calendar, years 1800-2199           format; result is a real date
phone  ten digits, first of area 2-9           country code, separators
ip     four octets of 0-255                    first octet 1-223 stays in 1-223
email  syntax                                  domain, punctuation
secret 16+ hexadecimal digits, both kinds      length, case (mixed: letters and digits, too)
====== ======================================= ===========================================

Not searched for: phones outside North America, phones and social security
numbers without separators, IPv6 addresses, bank accounts, and keys that are no
hexadecimal digits.

Native expressions only, one pass, no shuffle; time grows with the length of a
text, also of one without any space.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import OWN, require

ROUNDS = 8

# Patterns in order of preference; no two of them match the same string whole
# but card and secret, where the check on letters decides.
_OCTET = "(?:25[0-5]|2[0-4]\\d|1\\d\\d|[1-9]?\\d)"
PATTERNS = {
    # begins where a run of its characters begins, so that a long run is read once
    "email": "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}+\\.){1,126}[A-Za-z]{2,24}",
    # a T and a time may follow
    "date": "(?<![\\w./-])(?:\\d{4}-\\d{2}-\\d{2}|\\d{2}/\\d{2}/\\d{4}|\\d{2}\\.\\d{2}\\.\\d{4})"
    "(?!(?![Tt]\\d{2})\\w|[/-]|\\.\\d)",
    "ip": f"(?<![\\w.])(?:{_OCTET}\\.){{3}}{_OCTET}(?![\\w]|\\.\\d)",
    "ssn": "(?<![\\w-])\\d{3}-\\d{2}-\\d{4}(?![\\w-])",
    "phone": "(?<![\\w])(?:\\+1[ .-]?)?(?:\\([2-9]\\d{2}\\) ?|[2-9]\\d{2}[ .-])\\d{3}[ .-]\\d{4}(?!\\w)",
    "card": "",
    "secret": "(?<![\\w])(?=[0-9A-Fa-f]*[A-Fa-f])(?=[0-9A-Fa-f]*[0-9])[0-9A-Fa-f]{16,}(?!\\w)",
}
# A card is searched for in a whole run of digit groups, however many there are
# (:func:`_cards`); the run ends before a group that begins another kind of value.
_GROUP = "\\d++(?!\\w|-[^\\W\\d])"
_OTHER = "|".join(PATTERNS[k] for k in ("email", "date", "ip", "ssn", "phone"))
PATTERNS["card"] = f"(?<![\\w-])(?=\\d(?:[ -]?\\d){{12}}){_GROUP}(?:[ -](?!{_OTHER}){_GROUP})*+"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())

#: Sizes of the digit groups that cards are printed in.
PRINTED = ["4-4-4-4", "4-6-5", "4-6-4", "4-4-4-4-3", *map(str, range(13, 20))]

# 400 Gregorian years from 1800-01-01 are 146,097 days = 773 * 189
_DAY0, _DAYS, _A, _B = "1800-01-01", 146_097, 773, 189
_HEX = "0123456789abcdef"


def feistel(values: Column, radices: Column, tweak: Column, key: str) -> Column:
    """Permute an array of integers; entries with radix 1 or less stay."""

    def one_round(state: Column, k: Column, bound: Column) -> Column:
        other = F.transform(state, lambda x, i: F.when(i % 2 == k % 2, F.lit(-1)).otherwise(x))
        digest = F.sha2(
            F.concat_ws("|", F.lit(key), tweak, k.cast("string"), F.array_join(other, ",")).cast("binary"), 256
        )

        def shifted(h: Column) -> Column:
            def entry(x: Column, i: Column) -> Column:
                # 8 of the 64 hexadecimal digits, another group for each place
                add = F.conv(F.substr(h, ((i * 5) % 57 + 1).cast("int"), F.lit(8)), 16, 10).cast("long")
                radix = F.get(bound, i)
                moves = (i % 2 == k % 2) & (radix > 1)
                return F.when(moves, ((x + add) % radix).cast("int")).otherwise(x)

            return F.transform(state, entry)

        return F.get(F.transform(F.array(digest), shifted), F.lit(0))

    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return _let(radices, lambda r: F.aggregate(rounds, values, lambda state, k: one_round(state, k, r)))


def _chars(value: Column) -> Column:
    return F.split(value, "")


def _is_digit(c: Column) -> Column:
    return c.between("0", "9")


def _digits(value: Column) -> Column:
    return F.transform(F.filter(_chars(value), _is_digit), lambda c: c.cast("int"))


def _refill(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced, separators in place."""
    chars = _chars(value)

    def entry(c: Column, i: Column) -> Column:
        nth = F.size(F.filter(F.slice(chars, 1, i + 1), _is_digit))
        return F.when(_is_digit(c), F.element_at(digits, nth).cast("string")).otherwise(c)

    return F.array_join(F.transform(chars, entry), "")


def _numbers(size: Column, each: object) -> Column:
    return F.array_repeat(F.lit(each), size)


def luhn_total(digits: Column) -> Column:
    """Luhn sum of an array of digits, the last being the check digit."""
    twice = lambda d: d * 2 - F.when(d > 4, 9).otherwise(0)
    return F.aggregate(
        F.transform(F.reverse(digits), lambda d, i: F.when(i % 2 == 1, twice(d)).otherwise(d)),
        F.lit(0),
        lambda a, d: a + d,
    )


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _cards(value: Column, key: str) -> Column:
    """Struct (value, n) of a run of digit groups: the run with its cards
    replaced and their number.

    Each part of the run from one group to another with 13-19 digits that
    passes the Luhn check is a card, at each group the longest one. Parts in
    printed groupings go first: others that reach into one are no cards.
    """

    def part(groups: Column, first: Column, last: Column) -> Column:
        return F.array_join(F.slice(groups, first + 1, last - first + 1), "")

    def ends(groups: Column, i: Column) -> Column:
        """Last groups of the cards that begin at group ``i``, and whether their grouping is a printed one."""

        def end(j: Column) -> Column:
            digits = F.translate(part(groups, i, j), " -", "")
            return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)

        def sizes(j: Column) -> Column:
            one = F.slice(groups, i + 1, j - i + 1)
            return F.array_join(F.transform(one, lambda g: F.length(F.ltrim(F.translate(g, "-", " "))).cast("string")), "-")

        valid = F.filter(F.sequence(i, F.least(i + 18, F.size(groups) - 1)), end)
        return F.transform(valid, lambda j: F.struct(j.alias("end"), sizes(j).isin(PRINTED).alias("printed")))

    def best(groups: Column, i: Column) -> Column:
        last = lambda e: F.coalesce(F.array_max(F.transform(e, lambda x: x["end"])), F.lit(-1))
        return _let(
            ends(groups, i),
            lambda e: F.struct(last(e).alias("any"), last(F.filter(e, lambda x: x["printed"])).alias("printed")),
        )

    def chosen(ends: Column) -> Column:
        """First and last groups of the cards, none of which overlap."""

        def step(state: Column, i: Column) -> Column:
            here = F.element_at(ends, i + 1)
            inside = F.slice(ends, i + 2, F.greatest(here["any"] - i, F.lit(0)))
            free = ~F.exists(inside, lambda e: e["printed"] >= 0)
            end = F.when(here["printed"] >= 0, here["printed"]).when(free, here["any"]).otherwise(F.lit(-1))
            take = lambda j: F.struct(
                (j + 1).alias("next"),
                F.concat(state["cards"], F.array(F.struct(i.alias("first"), j.alias("last")))).alias("cards"),
            )
            return F.when((i < state["next"]) | (here["any"] < 0), state).otherwise(
                _let(end, lambda j: F.when(j >= 0, take(j)).otherwise(state))
            )

        start = F.struct(F.lit(0).alias("next"), F.expr("cast(array() as array<struct<first:int,last:int>>)").alias("cards"))
        return F.aggregate(F.sequence(F.lit(0), F.size(ends) - 1), start, step, lambda state: state["cards"])

    def rebuilt(groups: Column, cards: Column) -> Column:
        after = lambda k: F.coalesce(F.get(cards, k)["last"] + 1, F.lit(0))
        new = F.transform(
            cards,
            lambda c, k: F.concat(
                part(groups, after(k - 1), c["first"] - 1), _card(part(groups, c["first"], c["last"]), key)
            ),
        )
        rest = part(groups, after(F.size(cards) - 1), F.size(groups) - 1)
        return F.struct(F.concat(F.array_join(new, ""), rest).alias("value"), F.size(cards).alias("n"))

    # each group with the separator before it
    groups = F.regexp_extract_all(value, F.lit("[ -]?\\d+"), F.lit(0))
    made = _let(
        groups,
        lambda g: _let(
            _let(F.transform(F.sequence(F.lit(0), F.size(g) - 1), lambda i: best(g, i)), chosen),
            lambda c: rebuilt(g, c),
        ),
    )
    return _let(made, lambda m: F.when(m["n"] > 0, m))


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    n = F.size(digits)
    radices = F.concat(F.array(F.lit(1)), _numbers(n - 2, 10), F.array(F.lit(1)))
    # the check digit is no input of the permutation
    moved = feistel(F.concat(F.slice(digits, 1, n - 1), F.array(F.lit(0))), radices, F.lit("card"), key)
    check = lambda d: F.concat(F.slice(d, 1, n - 1), F.array((10 - luhn_total(d) % 10) % 10))
    whole = F.get(F.transform(F.array(moved), check), F.lit(0))
    return _refill(value, whole)


def _phone(value: Column, key: str) -> Column:
    country = F.regexp_extract(value, "^(?:\\+1[ .-]?)?", 0)
    rest = F.substr(value, F.length(country) + 1)
    digits = _digits(rest)
    coded = F.transform(digits, lambda d, i: F.when(i == 0, d - 2).otherwise(d))
    radices = F.concat(F.array(F.lit(8)), _numbers(F.size(digits) - 1, 10))
    moved = feistel(coded, radices, F.lit("phone"), key)
    return F.concat(country, _refill(rest, F.transform(moved, lambda d, i: F.when(i == 0, d + 2).otherwise(d))))


def _ip(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, "\\."), lambda o: o.cast("int"))
    unicast = F.get(octets, F.lit(0)).between(1, 223)
    coded = F.transform(octets, lambda o, i: F.when((i == 0) & unicast, o - 1).otherwise(o))
    first = F.when(unicast, F.lit(223)).otherwise(F.lit(1))
    moved = feistel(coded, F.concat(F.array(first), _numbers(F.lit(3), 256)), F.lit("ip"), key)
    back = F.transform(moved, lambda o, i: F.when((i == 0) & unicast, o + 1).otherwise(o).cast("string"))
    return F.array_join(back, ".")


def _ssn(value: Column, key: str) -> Column:
    area, group, serial = (F.substring(value, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    moved = feistel(
        F.array(place, group - 1, serial - 1), F.array(F.lit(898), F.lit(99), F.lit(9999)), F.lit("ssn"), key
    )
    text = lambda m: F.concat_ws(
        "-",
        F.lpad((F.when(m[0] >= 665, m[0] + 2).otherwise(m[0] + 1)).cast("string"), 3, "0"),
        F.lpad((m[1] + 1).cast("string"), 2, "0"),
        F.lpad((m[2] + 1).cast("string"), 4, "0"),
    )
    return F.when(valid, F.get(F.transform(F.array(moved), text), F.lit(0)))


def _date(value: Column, key: str) -> Column:
    def of(pattern: str) -> Column:
        day = F.datediff(F.try_to_timestamp(value, F.lit(pattern)).cast("date"), F.lit(_DAY0).cast("date"))
        moved = feistel(
            F.array((day / _B).cast("int"), day % _B), F.array(F.lit(_A), F.lit(_B)), F.lit("date"), key
        )
        back = F.get(F.transform(F.array(moved), lambda m: m[0] * _B + m[1]), F.lit(0))
        return F.when(day.between(0, _DAYS - 1), F.date_format(F.date_add(F.lit(_DAY0).cast("date"), back), pattern))

    return (
        F.when(value.contains("-"), of("yyyy-MM-dd"))
        .when(value.contains("."), of("dd.MM.yyyy"))
        # month first where that is a date, else day first
        .otherwise(F.coalesce(of("MM/dd/yyyy"), of("dd/MM/yyyy")))
    )


def _email(value: Column, key: str) -> Column:
    local = F.substring_index(value, "@", 1)
    kind = lambda c: F.when(_is_digit(c), 48).when(c.between("a", "z"), 97).when(c.between("A", "Z"), 65)
    chars = _chars(local)
    coded = F.transform(chars, lambda c: F.coalesce(F.ascii(c) - kind(c), F.lit(0)))
    radices = F.transform(chars, lambda c: F.coalesce(F.when(_is_digit(c), 10).when(kind(c) > 0, 26), F.lit(1)))
    domain = F.substring_index(value, "@", -1)
    moved = feistel(coded, radices, F.lower(domain), key)
    back = F.zip_with(chars, moved, lambda c, v: F.coalesce(F.char(kind(c) + v), c))
    return F.concat(F.array_join(back, ""), F.lit("@"), domain)


def _secret(value: Column, key: str) -> Column:
    lower, upper = F.lower(value), F.upper(value)
    # in mixed case a digit has no case to give to a letter: digits stay digits and each letter keeps its case
    return _let((value != lower) & (value != upper), lambda mixed: _hexadecimal(value, mixed, key))


def _hexadecimal(value: Column, mixed: Column, key: str) -> Column:
    coded = F.transform(_chars(F.lower(value)), lambda c: F.instr(F.lit(_HEX), c) - 1)
    base = F.transform(coded, lambda v: F.when(mixed & (v > 9), 10).otherwise(0))
    radices = F.transform(coded, lambda v: F.when(~mixed, 16).when(v > 9, 6).otherwise(10))
    moved = feistel(F.zip_with(coded, base, lambda v, b: v - b), radices, F.lit("secret"), key)
    new = F.transform(
        F.zip_with(moved, base, lambda v, b: v + b), lambda v: F.substr(F.lit(_HEX), v + 1, F.lit(1))
    )
    cased = F.zip_with(_chars(value), new, lambda c, v: F.when(c.between("A", "F"), F.upper(v)).otherwise(v))
    joined = F.array_join(F.when(mixed, cased).otherwise(new), "")
    return F.when(~mixed & (value == F.upper(value)), F.upper(joined)).otherwise(joined)


_MAKERS = {"email": _email, "date": _date, "ip": _ip, "ssn": _ssn, "phone": _phone, "card": _cards, "secret": _secret}


def pseudonym(value: Column, key: str) -> Column:
    """Struct (kind, value, n) for one matched string, with the number of values
    in it; null kind if none is valid."""
    out = None
    for kind, pattern in PATTERNS.items():
        new = _MAKERS[kind](value, key)
        if kind != "card":
            new = F.struct(new.alias("value"), F.lit(1).alias("n"))
        made = _let(new, lambda v: F.struct(F.lit(kind).alias("kind"), v["value"].alias("value"), v["n"].alias("n")))  # noqa: B023
        hit = value.rlike(f"^(?:{pattern})\\z")
        out = F.when(hit, made) if out is None else out.when(hit, made)
    return F.get(
        F.transform(
            F.array(out),
            lambda p: F.struct(
                F.when(p["value"].isNotNull(), p["kind"]).alias("kind"),
                F.coalesce(p["value"], value).alias("value"),
                F.when(p["value"].isNotNull(), p["n"]).otherwise(0).alias("n"),
            ),
        ),
        F.lit(0),
    )


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and ``n_private``, the values replaced.

    A null text stays null, a text without such values stays as it is. A column
    named n_private is replaced; other columns are kept. Dates written d/m/y
    and m/d/y can be told apart only where one reading is no date.
    """
    require(docs, text)
    found, made = OWN + "found", OWN + "made"
    between = F.split(F.col(text), ANY, -1)
    # each pseudonym with what follows it; neither array is made anew for an element of the other
    pairs = lambda b: F.zip_with(F.col(made), F.slice(b, 2, F.size(made)), lambda m, t: F.concat(m["value"], t))
    rebuilt = _let(between, lambda b: F.concat(F.get(b, F.lit(0)), F.array_join(pairs(b), "")))
    has = F.size(found) > 0
    columns = [F.when(has, rebuilt).otherwise(F.col(text)).alias(c) if c == text else F.col(c) for c in docs.columns]
    return (
        docs.drop("n_private")
        .withColumn(found, F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0)))
        .withColumn(made, F.transform(found, lambda m: pseudonym(m, key)))
        .select(
            *[c for c, n in zip(columns, docs.columns) if n != "n_private"],
            F.coalesce(F.aggregate(made, F.lit(0), lambda n, m: n + m["n"]), F.lit(0)).cast("long").alias("n_private"),
        )
    )
