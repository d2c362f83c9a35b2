"""Personal data: format-preserving pseudonyms for numbers and dates, keyed pseudonyms for addresses and secrets.

A validated number or date is an integer within the numbers of its format. A Feistel network over two mixed-radix halves with a keyed hash as
round function permutes these integers, so the pseudonym has the same format, passes the same check, and two values have one pseudonym
only if they are equal: mentions stay linked across documents and runs with the same key.

Everything is column expressions: one regular expression finds all kinds, the text between the findings stays, and each finding is replaced
by its own pseudonym. There is no shuffle and no state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 10

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+(?<=\.[A-Za-z]{2,24})"
ACCESS_KEY = r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"
# A value has a digit after letters or signs, or more than 80 of these; it runs to the next white space, quote or angle bracket, less the punctuation
# at its end. Looking ahead is bounded, so that a long run of names without a value costs no more than its length.
SECRET = (r"(?<![A-Za-z])(?i:password|passwd|pwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?(?=[A-Za-z/+_-]{0,80}+\d|[A-Za-z/+_-]{81})"
          r"[!#-&(-;=?-_a-~]{7,}[!#-&(*+\-/-9=@-\[^_a-|~]")
DATE = (r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d]|[/.-]\d)")
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PHONE = (r"(?<![\d+])\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\d.+-])\(?[2-9]\d{2}\)?[ .-][2-9]\d{2}[ .-]\d{4}(?!\d)")
ADDRESS = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"
CARD = r"(?<!\d)(?:\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\d)"
KINDS = {"email": EMAIL, "access_key": ACCESS_KEY, "secret": SECRET, "date": DATE, "ssn": SSN, "phone": PHONE, "address": ADDRESS, "card": CARD}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())

#: Days of 400 Gregorian years from 1800-01-01, as 27 x 5411.
FIRST_DAY, DAYS = "1800-01-01", (27, 5411)


def _number(text: Column) -> Column:
    return text.cast("bigint")


def _part(text: Column, start: int | Column, length: int | Column) -> Column:
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.substring(text, as_column(start), as_column(length))


def _digest(key: str, kind: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), *[p.cast("string") for p in parts]).cast("binary"), 256)


def feistel(key: str, kind: str, left: Column, right: Column, left_size: Column, right_size: Column) -> Column:
    """A permutation of the pairs (l, r) with 0 <= l < left_size and 0 <= r < right_size, as a struct of both."""
    def draw(step: Column, other: Column, size: Column) -> Column:
        word = F.conv(F.substring(_digest(key, kind, left_size, right_size, step, other), 1, 15), 16, 10)
        return _number(word) % size

    def turn(state: Column, step: Column) -> Column:
        l, r = state["l"], state["r"]
        even = step % 2 == 0
        return F.struct(F.when(even, (l + draw(step, r, left_size)) % left_size).otherwise(l).alias("l"),
                        F.when(even, r).otherwise((r + draw(step, l, right_size)) % right_size).alias("r"))

    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, turn)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _fill(template: Column, digits: Column) -> Column:
    """``template`` with its digits replaced in turn by ``digits``."""
    def step(state: Column, char: Column) -> Column:
        is_digit = char.rlike("^[0-9]$")
        return F.struct(F.concat(state["out"], F.when(is_digit, _part(digits, state["at"], 1)).otherwise(char)).alias("out"),
                        (state["at"] + is_digit.cast("int")).alias("at"))

    chars = F.transform(F.sequence(F.lit(1), F.length(template)), lambda i: _part(template, i, 1))
    return F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), step)["out"]


def _padded(number: Column, width: int | Column) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum: from the right, every second digit counts twice, less 9 beyond 9."""
    def add(total: Column, i: Column) -> Column:
        x = _part(digits, F.length(digits) - i + 1, 1).cast("int")
        return total + F.when(i % 2 == 0, 2 * x - F.when(x > 4, 9).otherwise(0)).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def card(key: str, value: Column) -> Column:
    """Card numbers with a right check digit: the first digit stays, the others are permuted, the check digit is made anew."""
    digits = _digits(value)
    free = F.length(digits) - 2
    left_width = F.floor(free / 2).cast("int")
    right_width = free - left_width
    power = lambda width: F.pow(F.lit(10.0), width).cast("bigint")
    pair = feistel(key, "card", _number(_part(digits, 2, left_width)), _number(_part(digits, left_width + 2, right_width)),
                   power(left_width), power(right_width))
    body = lambda p: F.concat(_part(digits, 1, 1), _padded(p["l"], left_width), _padded(p["r"], right_width))
    made = _let(pair, lambda p: _let(body(p), lambda b: F.concat(b, ((10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string"))))
    return F.when((luhn_sum(digits) % 10 == 0) & (F.length(digits) >= 13), _fill(value, made)).otherwise(value)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def phone(key: str, value: Column) -> Column:
    """North American numbers. Area and exchange from 200 make a valid number and stay so; with +1, other numbers stay among their own kind."""
    def make(digits: Column) -> Column:
        area, exchange, line = (_number(_part(digits, a, n)) for a, n in ((1, 3), (4, 3), (7, 4)))
        low_area = F.when(area < 200, 0).otherwise(200)
        areas = F.when(area < 200, 200).otherwise(800)
        low_exchange = F.when((area < 200) | (exchange < 200), 0).otherwise(200)
        exchanges = F.when(area < 200, 1000).when(exchange < 200, 200).otherwise(800)
        pair = feistel(key, "phone", area - low_area, (exchange - low_exchange) * 10_000 + line, areas, exchanges * 10_000)
        lead = F.when(value.startswith("+1"), F.lit("1")).otherwise(F.lit(""))
        return _let(pair, lambda p: F.concat(lead, _padded(p["l"] + low_area, 3), _padded(p["r"] + low_exchange * 10_000, 7)))

    return _fill(value, _let(F.right(_digits(value), F.lit(10)), make))


def ssn(key: str, value: Column) -> Column:
    """Area 001-899 without 666, group 01-99, serial 0001-9999; others are no such number."""
    area, group, serial = (_number(_part(value, a, n)) for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    pair = feistel(key, "ssn", area - 1 - (area > 666).cast("int"), (group - 1) * 9_999 + serial - 1, F.lit(898), F.lit(99 * 9_999))

    def make(p: Column) -> Column:
        area = p["l"] + 1 + (p["l"] >= 665).cast("int")
        return F.concat_ws("-", _padded(area, 3), _padded(F.floor(p["r"] / 9_999) + 1, 2), _padded(p["r"] % 9_999 + 1, 4))

    return F.when(valid, _let(pair, make)).otherwise(value)


def address(key: str, value: Column) -> Column:
    """IPv4 addresses with octets up to 255, written without leading zeros."""
    octets = F.split(value, r"\.")
    part = lambda i: _number(octets[i])
    valid = F.forall(octets, lambda o: (o.cast("int") <= 255) & (F.length(o) == F.length(o.cast("int").cast("string"))))
    pair = feistel(key, "address", part(0) * 256 + part(1), part(2) * 256 + part(3), F.lit(65_536), F.lit(65_536))
    made = _let(pair, lambda p: F.concat_ws(".", *[x.cast("bigint").cast("string") for h in ("l", "r") for x in (F.floor(p[h] / 256), p[h] % 256)]))
    return F.when(valid, made).otherwise(value)


def _date_as(key: str, value: Column, layout: str) -> tuple[Column, Column]:
    """Whether ``value`` is a day of the 400 years in this layout, and its pseudonym."""
    day = F.try_to_timestamp(value, F.lit(layout)).cast("date")
    number = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
    pair = feistel(key, "date", F.floor(number / DAYS[1]), number % DAYS[1], F.lit(DAYS[0]), F.lit(DAYS[1]))
    made = _let(pair, lambda p: F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (p["l"] * DAYS[1] + p["r"]).cast("int")), layout))
    shape = "^" + layout.replace(".", r"\.").replace("yyyy", r"\d{4}").replace("MM", r"\d{2}").replace("dd", r"\d{2}") + "$"
    return value.rlike(shape) & day.isNotNull() & number.between(0, DAYS[0] * DAYS[1] - 1), made


def date(key: str, value: Column) -> Column:
    """Days of 1800 to 2199 in one of six layouts, day before month where both readings are valid."""
    out = value
    for layout in ("MM.dd.yyyy", "dd.MM.yyyy", "MM/dd/yyyy", "dd/MM/yyyy", "yyyy/MM/dd", "yyyy-MM-dd"):
        valid, made = _date_as(key, value, layout)
        out = F.when(valid, made).otherwise(out)
    return out


def email(key: str, value: Column) -> Column:
    """A name from the whole address and a host from its host, so that both stay linked."""
    host = F.substring_index(F.lower(value), "@", -1)
    return F.concat(F.lit("u"), F.substring(_digest(key, "email", F.lower(value)), 1, 12), F.lit("@h"),
                    F.substring(_digest(key, "host", host), 1, 8), F.lit(".example"))


def access_key(key: str, value: Column) -> Column:
    letters = F.translate(F.upper(F.substring(_digest(key, "access_key", value), 1, 16)), "0123456789", "GHIJKLMNOP")
    return F.concat(F.lit("AKIA"), letters)


def secret(key: str, value: Column) -> Column:
    """The name and the sign stay, the value becomes as many hex digits."""
    held = F.regexp_extract(value, r"^[A-Za-z_-]+\s{0,3}[=:]\s{0,3}[\"']?(.+)$", 1)
    digest = _digest(key, "secret", held)
    made = F.substring(F.repeat(digest, F.ceil(F.length(held) / 64).cast("int")), F.lit(1), F.length(held))
    return F.concat(F.substring(value, F.lit(1), F.length(value) - F.length(held)), made)


def pseudonym(key: str, value: Column) -> Column:
    """The pseudonym of one finding; a finding that its kind's check refuses stays as it is."""
    return (F.when(value.rlike("[=:]"), secret(key, value)).when(value.contains("@"), email(key, value))
            .when(value.rlike(f"^{ACCESS_KEY}$"), access_key(key, value)).when(value.rlike(f"^(?:{DATE})$"), date(key, value))
            .when(value.rlike(f"^{SSN}$"), ssn(key, value)).when(value.rlike(f"^(?:{PHONE})$"), phone(key, value))
            .when(value.rlike(f"^{ADDRESS}$"), address(key, value)).otherwise(card(key, value)))


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and ``n_private``, the number of findings replaced.

    A null text stays null with 0 findings. All other columns stay; a column n_private is replaced. Repeated rows stay alike.
    """
    text = F.col("text")
    names = [c for c in docs.columns if c != "n_private"]
    work = F.struct(F.split(text, ANY, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)).alias("found"))
    once = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.when(text.rlike(ANY), work).alias("work"))
    once = once.withColumn("made", F.when(F.col("work").isNotNull(), F.transform("work.found", lambda m: pseudonym(key, m))))
    whole = F.array_join(F.transform("work.gaps", lambda g, i: F.concat(g, F.coalesce(F.get(F.col("made"), i), F.lit("")))), "")
    changed = F.size(F.filter(F.zip_with("work.found", "made", lambda a, b: a != b), lambda x: x))
    return once.select(*[F.coalesce(whole, F.col("row.text")).alias("text") if c == "text" else F.col(f"row.`{c}`") for c in names],
                       F.when(F.col("work").isNotNull(), changed).otherwise(0).cast("bigint").alias("n_private"))
