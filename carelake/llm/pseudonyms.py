"""Format-preserving pseudonyms for personal data, in DataFrame operations alone.

Card and phone numbers, addresses of machines and dates are permuted *within their format* by a
keyed Feistel network: two halves take turns at adding a digest of the other one, which can be
undone with the key and so never gives two values one pseudonym. Equal values get equal
pseudonyms in all documents. What is validated stays valid: a card number keeps a right check
digit, an address four bytes, a date is another day of the calendar. Mail addresses have no
fixed format; they become a keyed digest at a domain that cannot exist.

Only valid values are touched: card numbers of a length and first digits that issuers use, with a
right check digit, of which the first four stay; phone numbers of 10 to 13 digits written as such, addresses of bytes, days of 1800 to 2199.

A phone number is written with a plus and any grouping, as groups of 3, 3 and 4 digits, or with a
0 and an area code of 1 to 5 digits more, set apart, and any grouping. Its last ten digits change,
so one number in its national and its international form gets two pseudonyms.

A card number begins and ends where a group of digits does, and may stand beside other numbers.
Usual groupings (all in one, 4-4-4-4, 4-4-4-4-3, 4-6-5, 4-6-4) go before all other kinds. After them
come other groupings by single spaces and hyphens, if the groups have two digits or more and no
other number stands beside them. A list of more than eight numbers of four digits holds no cards.

Defined results: NULL text stays NULL and has none; empty text stays empty; repeated rows come
out alike; long texts are rewritten whole; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import let

ROUNDS = 10
KINDS = ("email", "date", "ip", "phone", "card")

# Java walks a repeated group by recursion, one frame a turn, so what may repeat without bound is
# single characters only; whether the labels of a domain are such is looked at afterwards.
_MAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9.-]*[A-Za-z0-9-]\.[A-Za-z]{2,}"
_ISO = r"(?<![\p{N}-])\d{4}-\d{2}-\d{2}(?![\p{N}-])"
_DAY_FIRST = r"(?<![\p{N}./])(?:\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\p{N}/])"
_IP = r"(?<![\p{N}.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\p{N}]|\.\p{N})"
_PHONE = (
    r"(?<![\p{L}\p{N}])(?:\+\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?!\p{N})"
    r"|(?<![\p{L}\p{N}.+-])(?:\+\d{1,3}[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?![\p{N}-])"
    r"|(?<![\p{L}\p{N}])\+\d(?:(?:[ ./-]|[ .-]?\(|\)[ .-]?)?\d){9,12}(?!\p{N})"
    r"|(?<![\p{L}\p{N}./+-])(?=\(0\d{1,5}\)|0\d{1,5}[ ./-])\(?0(?:(?:\)[ ./-]?|[ ./-])?\d){9,12}(?!\p{N}|-\p{N})"
)
_OTHERS = "|".join((_MAIL, _ISO, _DAY_FIRST, _IP, _PHONE))

# Where a card number can begin: not in a word or a number, nor where a phone number of 13 digits
# does, nor far down a list of numbers of four digits.
_AHEAD = r"(?=(\d(?:[ -]?\d){12}(?s:.{0,100})))"
_START = (
    r"(?<![\p{L}\p{N}.-])(?!(?<=\+)\d{13}(?!\p{N}))"
    rf"(?!(?<=(?:\d{{4}}[ -]){{5}})\d{{4}}[ -]\d{{4}}[ -]){_AHEAD}"
)
# Where a number in an unusual grouping can begin: not behind another group of digits either.
_LOOSE_START = rf"(?<![\p{{L}}\p{{N}}.-])(?<!\p{{N}}[ -])(?!(?<=\+)\d{{13}}(?!\p{{N}})){_AHEAD}"
_END = r"(?![\p{L}\p{N}]|-\p{N}|[\p{L}\p{N}._%+-]*@[A-Za-z0-9-])"
_USUAL = (
    r"\d{4}(?:[ -]\d{4}){3}(?!(?:[ -]\d{4}){5})",
    r"\d{4}[ -]\d{6}[ -]\d{5}",
    r"\d{4}[ -]\d{6}[ -]\d{4}",
    r"\d{13,19}",
    r"\d{4}(?:[ -]\d{4}){3}[ -]\d{3}",
)
# Groups of any size, and none beside them.
_LOOSE = tuple(rf"\d(?:[ -]?\d){{{n - 1}}}(?![ -]\p{{N}})" for n in (16, 15, 14, 13, 19, 18, 17))
# First digits that issuers have, with the lengths of their numbers.
_ISSUED = "^(?:" + "|".join((
    r"4\d{12}(?:\d{3}){0,2}",
    r"5[1-5]\d{14}",
    r"2(?:22[1-9]|2[3-9]\d|[3-6]\d\d|7[01]\d|720)\d{12}",
    r"3[47]\d{13}",
    r"3(?:0[0-5]|[689]\d)\d{11}",
    r"35(?:2[89]|[3-8]\d)\d{12,15}",
    r"(?:6011|62\d\d|64[4-9]\d|65\d\d)\d{12,15}",
)) + ")$"
_ISSUER_DIGITS = 4
# Characters that stand for nothing mark where a valid number of 13 to 19 digits begins. Should a
# text have some of its own, they are put between two more.
_MARKS = "\ufdd0\ufdd1\ufdd2\ufdd3\ufdd4\ufdd5\ufdd6"
_OPEN, _CLOSE = "\ufdde", "\ufddf"
_MARKED = "|".join(
    rf"(?<!{_OPEN}){mark}\d(?:[ -]?[{_MARKS}]*\d){{{n - 1}}}" for n, mark in enumerate(_MARKS, 13)
)
_WORTH = rf"{_OTHERS}|{_START}"

_FIRST_DAY = "1800-01-01"
# 400 years of the calendar have 146,097 days, which is 189 times 773.
_DAY_PARTS = (189, 773)


def _digest(key: str, kind: str | Column, round_: Column, half: Column) -> Column:
    """60 bits that nobody without the key can foretell."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    name = F.concat_ws(":", F.lit(key), kind, round_.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(F.encode(name, "UTF-8"), 256), 1, 15), 16, 10).cast("long")


def feistel(key: str, kind: str | Column, a: Column, b: Column, size_a: Column, size_b: Column) -> Column:
    """The keyed permutation of pairs a < ``size_a``, b < ``size_b``, as a struct of both."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def step(pair: Column, i: Column) -> Column:
        left = F.pmod(pair["a"] + F.pmod(_digest(key, kind, i, pair["b"]), size_a), size_a)
        right = F.pmod(pair["b"] + F.pmod(_digest(key, kind, i, pair["a"]), size_b), size_b)
        return F.when(i % 2 == 0, F.struct(left.alias("a"), pair["b"].alias("b"))).otherwise(
            F.struct(pair["a"].alias("a"), right.alias("b"))
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _power_of_ten(n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(10**i) for i in range(11)]), n + 1)


def permute_digits(key: str, kind: str | Column, digits: Column) -> Column:
    """Another string of as many digits, 2 to 20. Lengths are permuted apart from each other."""

    def of(s: Column) -> Column:
        first, second = F.floor(F.length(s) / 2).cast("int"), F.ceil(F.length(s) / 2).cast("int")
        a, b = F.substring(s, F.lit(1), first), F.substring(s, first + 1, second)
        pair = feistel(key, kind, a, b, _power_of_ten(first), _power_of_ten(second))
        return let(
            pair,
            lambda p: F.concat(
                F.lpad(p["a"].cast("string"), first, F.lit("0")), F.lpad(p["b"].cast("string"), second, F.lit("0"))
            ),
        )

    return let(digits, of)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, one by one, by ``digits``."""
    start = F.struct(F.lit(0).alias("used"), F.lit("").alias("text"))

    def step(done: Column, c: Column) -> Column:
        is_digit = F.regexp_like(c, F.lit("^[0-9]$"))
        return F.struct(
            (done["used"] + is_digit.cast("int")).alias("used"),
            F.concat(
                done["text"], F.when(is_digit, F.substring(digits, done["used"] + 1, F.lit(1))).otherwise(c)
            ).alias("text"),
        )

    return F.aggregate(F.split(shape, ""), start, step, lambda done: done["text"])


def _card(key: str, s: Column) -> Column:
    """The issuer's digits stay, and the last is made right for the others, which are permuted."""

    def of(digits: Column) -> Column:
        issuer, own = F.substring(digits, 1, _ISSUER_DIGITS), F.length(digits) - _ISSUER_DIGITS - 1
        named = F.concat(F.lit("card:"), issuer)
        body = F.concat(issuer, permute_digits(key, named, F.substring(digits, F.lit(_ISSUER_DIGITS + 1), own)))

        def checked(b: Column) -> Column:
            right = F.filter(
                F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(b, d.cast("string"))),
                lambda n: F.call_function("luhn_check", n),
            )
            return F.element_at(right, 1)

        return _refill(s, let(body, checked))

    return let(_digits(s), of)


def _phone(key: str, s: Column) -> Column:
    """The last ten digits are permuted; what is before them, the country, stays."""

    def of(digits: Column) -> Column:
        country = F.substring(digits, F.lit(1), F.length(digits) - 10)
        own = permute_digits(key, "phone", F.substring(digits, F.length(digits) - 9, F.lit(10)))
        return _refill(s, F.concat(country, own))

    return let(_digits(s), of)


def _ip(key: str, s: Column) -> Column:
    def of(parts: Column) -> Column:
        n = [parts[i].cast("long") for i in range(4)]
        two = F.lit(65536).cast("long")
        pair = feistel(key, "ip", n[0] * 256 + n[1], n[2] * 256 + n[3], two, two)
        return let(
            pair,
            lambda p: F.concat_ws(
                ".",
                *[x.cast("string") for h in ("a", "b") for x in (F.floor(p[h] / 256).cast("long"), p[h] % 256)],
            ),
        )

    return let(F.split(s, r"\."), of)


def _day(s: Column) -> Column:
    """The day that a date names, the day of the month first where there is a choice; else NULL."""

    def iso(p: Column, day: int, month: int, year: int) -> Column:
        two = lambda c: F.lpad(c, 2, "0")
        return F.concat_ws("-", p[year], two(p[month]), two(p[day])).try_cast("date")

    def of(p: Column) -> Column:
        return F.when(F.length(p[0]) == 4, iso(p, 2, 1, 0)).otherwise(F.coalesce(iso(p, 0, 1, 2), iso(p, 1, 0, 2)))

    return let(F.split(s, "[-/.]"), of)


def _number(day: Column) -> Column:
    return F.datediff(day, F.lit(_FIRST_DAY).cast("date"))


def _date(key: str, s: Column) -> Column:
    """Written like the original; a month before the day stays so where only that could be read."""

    def of(number: Column) -> Column:
        a, b = (F.lit(n).cast("long") for n in _DAY_PARTS)
        pair = feistel(key, "date", F.floor(number / _DAY_PARTS[1]), number % _DAY_PARTS[1], a, b)
        moved = let(pair, lambda p: (p["a"] * _DAY_PARTS[1] + p["b"]).cast("int"))
        day = F.date_add(F.lit(_FIRST_DAY).cast("date"), moved)
        mark = F.when(F.contains(s, F.lit("/")), "/").otherwise(".")
        return F.when(F.regexp_like(s, F.lit("^....-")), day.cast("string")).otherwise(
            let(day, lambda d: F.concat_ws("", F.date_format(d, "dd"), mark, F.date_format(d, "MM"), mark, F.date_format(d, "yyyy")))
        )

    return let(_number(_day(s)), of)


def _mail(key: str, s: Column) -> Column:
    named = F.concat_ws(":", F.lit(key), F.lit("email"), F.lower(s))
    return F.concat(F.lit("u"), F.substring(F.sha2(F.encode(named, "UTF-8"), 256), 1, 20), F.lit("@example.invalid"))


def kind_of(s: Column) -> Column:
    """What a match is, or NULL if it is not valid as that."""
    day = _day(s)
    in_range = day.between(F.lit(_FIRST_DAY).cast("date"), F.lit("2199-12-31").cast("date"))
    bytes_ = F.forall(F.split(s, r"\."), lambda p: p.cast("int") <= 255)
    labels = F.split(F.substring_index(s, "@", -1), r"\.")
    return (
        F.when(F.contains(s, F.lit("@")), F.when(~F.array_contains(labels, ""), "email"))
        .when(F.regexp_like(s, F.lit(f"^(?:{_ISO}|{_DAY_FIRST})$")), F.when(in_range, "date"))
        .when(F.regexp_like(s, F.lit(f"^(?:{_IP})$")), F.when(bytes_, "ip"))
        .when(F.length(_digits(s)).between(10, 13), "phone")
    )


def _pseudonym(key: str, s: Column, kind: Column) -> Column:
    return (
        F.when(kind == "email", _mail(key, s))
        .when(kind == "date", _date(key, s))
        .when(kind == "ip", _ip(key, s))
        .when(kind == "phone", _phone(key, s))
        .otherwise(s)
    )


def _piece(new: Column, kind: Column) -> Column:
    return F.struct(new.alias("new"), kind.cast("string").alias("kind"))


def _cut(text: Column, regex: str, of: Callable[[Column], Column], rest: Callable[[Column], Column]) -> Column:
    """Pieces of a text in order: ``of`` a match is one, ``rest`` of what is between them several."""

    def pieces(t: Column) -> Column:
        found = F.transform(F.regexp_extract_all(t, F.lit(regex), F.lit(0)), of)
        return let(
            found,
            lambda f: F.flatten(
                F.transform(F.split(t, regex, -1), lambda gap, i: F.concat(rest(gap), F.slice(f, i + 1, F.lit(1))))
            ),
        )

    return let(text, pieces)


def _mark_cards(text: Column, forms: Sequence[str], start: str) -> Column:
    """``text`` with a mark wherever a valid card number begins, for the first form that is one."""

    def mark(ahead: Column) -> Column:
        def of_form(form: str) -> Column:
            def mark_of(n: Column) -> Column:
                return F.when(
                    F.call_function("luhn_check", n) & F.regexp_like(n, F.lit(_ISSUED)),
                    F.substring(F.lit(_MARKS), F.length(n) - 12, F.lit(1)),
                )

            written = F.regexp_extract(ahead, f"^({form}){_END}", 1)
            single = F.regexp_like(written, F.lit(r"(?:^|[ -])\d(?:[ -]|$)"))
            return F.when((written != "") & ~single, let(_digits(written), mark_of))

        return F.coalesce(*[of_form(form) for form in forms], F.lit(""))

    def marked(t: Column) -> Column:
        marks = F.transform(F.regexp_extract_all(t, F.lit(start), F.lit(1)), mark)
        return let(
            marks,
            lambda ms: F.array_join(
                F.transform(
                    F.split(t, start, -1),
                    lambda piece, i: F.when(i == 0, F.substring(piece, F.lit(2), F.length(piece))).otherwise(
                        F.concat(F.get(ms, i - 1), piece)
                    ),
                ),
                "",
            ),
        )

    # The line break is there so that no card begins the text, and every piece but the first has a mark.
    own = F.regexp_replace(text, f"([{_MARKS}{_OPEN}{_CLOSE}])", f"{_OPEN}$1{_CLOSE}")
    return let(
        own, lambda t: F.when(F.regexp_like(t, F.lit(start)), marked(F.concat(F.lit("\n"), t))).otherwise(t)
    )


def _unmarked(text: Column) -> Column:
    return F.regexp_replace(text, f"{_OPEN}(.){_CLOSE}|[{_MARKS}]", "$1")


def _pieces(key: str, text: Column) -> Column:
    """Cards in a usual grouping are found first, then all other kinds, then cards grouped anyhow.
    Each kind is looked for in all that those before have left."""

    def plain(t: Column) -> Column:
        return F.array(_piece(t, F.lit(None)))

    def cards(t: Column, forms: Sequence[str], start: str, rest: Callable[[Column], Column]) -> Column:
        return _cut(
            _mark_cards(t, forms, start),
            _MARKED,
            lambda m: let(_unmarked(m), lambda s: _piece(_card(key, s), F.lit("card"))),
            lambda gap: let(_unmarked(gap), rest),
        )

    def others(t: Column) -> Column:
        found = _cut(
            t,
            _OTHERS,
            lambda s: let(kind_of(s), lambda kind: _piece(_pseudonym(key, s, kind), kind)),
            lambda gap: cards(gap, _LOOSE, _LOOSE_START, plain),
        )
        return F.when(F.regexp_like(t, F.lit("[0-9@]")), found).otherwise(plain(t))

    return cards(text, _USUAL, _START, others)


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``pii``, an array of the kinds found,
    in the order of the text. Most texts have neither a digit nor an @ and are passed as they are."""
    text = docs["text"]

    def rebuilt(pieces: Column) -> Column:
        kinds = F.filter(F.transform(pieces, lambda p: p["kind"]), lambda k: k.isNotNull())
        return F.struct(F.array_join(F.transform(pieces, lambda p: p["new"]), "").alias("text"), kinds.alias("pii"))

    untouched = F.struct(text.alias("text"), F.array().cast("array<string>").alias("pii"))
    worth = F.regexp_like(text, F.lit("[0-9@]")) & F.regexp_like(text, F.lit(_WORTH))
    done = docs.withColumn("_done", F.when(worth, let(_pieces(key, text), rebuilt)).otherwise(untouched))
    return done.withColumns({"text": F.col("_done.text"), "pii": F.col("_done.pii")}).drop("_done")
