"""Pseudonyms for personal data by Feistel permutations that keep the format.

Numbers that pass their check (card, phone, address of a computer, social security, bank account) and dates
are permuted among the values of their format: two halves take turns in adding to each other a keyed hash
of the other, modulo the size of the half. The same value under the same key always has the same pseudonym,
so it stays linked across documents, and different values have different ones. Names in mail addresses and
hexadecimal secrets are permuted letter by letter in the same way. All of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmill.llm.tables import documents, free_name

# Each turn changes both halves once.
TURNS = 4

# --- Fixed values: how the data look. ---
MAIL = r"[A-Za-z0-9](?:[A-Za-z0-9._%+\-]{0,62}[A-Za-z0-9])?@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63}){1,8}"
IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
PHONE = (r"(?<![\w+])\+\d{1,3}[^\w\r\n]{0,6}\d{2,4}(?:[^\w\r\n]{1,6}\d{2,5}){1,4}(?!\w)"
         r"|(?<!\w)\(\d{3}\)[^\w\r\n]{1,6}\d{3}-\d{4}(?!\w)|(?<![\w.\-])\d{3}-\d{3}-\d{4}(?![\w\-])")
SOCIAL = r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])"
DATE = (r"(?<![\w.\-/])\d{4}-\d{2}-\d{2}(?![\d\-])|(?<![\w.\-/])\d{1,2}/\d{1,2}/\d{4}(?![\d/])"
        r"|(?<![\w.\-/])\d{1,2}\.\d{1,2}\.\d{4}(?![\d])")
ADDRESS = r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)(?!\w)"
CARD = r"(?<![\w.\-])\d(?:[ \-]?\d){12,18}(?![\w])"
SECRET = r"(?<!\w)(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?!\w)"
# In the order in which they are tried at a place in the text.
KINDS = {"mail": MAIL, "iban": IBAN, "phone": PHONE, "social": SOCIAL, "date": DATE, "address": ADDRESS,
         "card": CARD, "secret": SECRET}
# --- End of fixed values. ---

ANY = "|".join(f"(?:{pattern})" for pattern in KINDS.values())
DIGITS, SMALL, LARGE = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _hash(key: str, kind: str, turn: Column, half: Column) -> Column:
    """Keyed hash as hexadecimal digits."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), half.cast("string")), 512)


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def permuted(value: Column, left_size: Column, right_size: Column, key: str, kind: str) -> Column:
    """The number that takes the place of ``value``, both from 0 to ``left_size * right_size - 1``."""
    def turn(state, i):
        left = F.pmod(state["l"] + _number(_hash(key, kind, 2 * i, state["r"])), left_size)
        right = F.pmod(state["r"] + _number(_hash(key, kind, 2 * i + 1, left)), right_size)
        return F.struct(left.alias("l"), right.alias("r"))

    begin = F.struct(F.floor(value / right_size).cast("long").alias("l"), F.pmod(value, right_size).alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(TURNS)), begin, turn, lambda s: s["l"] * right_size + s["r"])


def _power(digits: Column) -> Column:
    """10 to the ``digits``, as a whole number."""
    return F.rpad(F.lit("1"), digits + 1, "0").cast("long")


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """A string of as many digits, up to 18."""
    size = F.length(digits)
    right = F.floor(size / 2).cast("int")
    left_size, right_size = _power(size - right), _power(right)

    # The halves are read from the string: they are exact, a quotient of large numbers need not be.
    def turn(state, i):
        left = F.pmod(state["l"] + _number(_hash(key, kind, 2 * i, state["r"])), left_size)
        new = F.pmod(state["r"] + _number(_hash(key, kind, 2 * i + 1, left)), right_size)
        return F.struct(left.alias("l"), new.alias("r"))

    begin = F.struct(F.substring(digits, F.lit(1), size - right).cast("long").alias("l"),
                     F.coalesce(F.substring(digits, size - right + 1, right).cast("long"), F.lit(0)).cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(TURNS)), begin, turn,
                       lambda s: F.concat(F.lpad(s["l"].cast("string"), size - right, "0"),
                                          F.when(right > 0, F.lpad(s["r"].cast("string"), right, "0")).otherwise("")))


def _shifted(half: Column, digest: Column, alphabets: tuple[str, ...]) -> Column:
    """Each letter moved within its alphabet by the hash at its place; other signs stay."""
    def moved(i):
        letter = F.substring(half, i, F.lit(1))
        by = F.conv(F.substring(digest, F.pmod(2 * i - 2, F.lit(128)) + 1, F.lit(2)), 16, 10).cast("int")
        found = letter
        for alphabet in alphabets:
            at = F.instr(F.lit(alphabet), letter)
            found = F.when(at > 0, F.substring(F.lit(alphabet), F.pmod(at - 1 + by, F.lit(len(alphabet))) + 1,
                                               F.lit(1))).otherwise(found)
        return found

    return F.when(F.length(half) > 0, F.array_join(
        F.transform(F.sequence(F.lit(1), F.greatest(F.length(half), F.lit(1))), moved), "")).otherwise("")


def permuted_letters(text: Column, key: str, kind: str, alphabets: tuple[str, ...]) -> Column:
    """A string of the same length whose letters are of the same alphabets at each place.

    The hash does not see case, so spellings that differ in case only stay so.
    """
    middle = F.floor((F.length(text) + 1) / 2).cast("int")

    def turn(state, i):
        left = _shifted(state["l"], _hash(key, kind, 2 * i, F.lower(state["r"])), alphabets)
        right = _shifted(state["r"], _hash(key, kind, 2 * i + 1, F.lower(left)), alphabets)
        return F.struct(left.alias("l"), right.alias("r"))

    begin = F.struct(F.substring(text, F.lit(1), middle).alias("l"),
                     F.substring(text, middle + 1, F.length(text)).alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(TURNS)), begin, turn, lambda s: F.concat(s["l"], s["r"]))


def refilled(pattern: Column, digits: Column) -> Column:
    """``pattern`` with its digits replaced by ``digits``, one after the other."""
    parts = F.split(pattern, "[0-9]", -1)
    return F.array_join(F.zip_with(parts, F.split(digits, "(?!^)"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_sum(digits: Column, number: Column) -> Column:
    """Luhn sum of the first of ``number`` digits; the last of all of them counts once."""
    def added(total, i):
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = 2 * digit
        return total + F.when(F.pmod(number - i, F.lit(2)) == 1, F.floor(twice / 10).cast("int") + twice % 10).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), added)


def _card(found: Column, key: str) -> Column:
    """The same remainder of the Luhn sum, so that valid numbers stay valid; others are left alone."""
    digits = only_digits(found)
    size = F.length(digits)
    body = permuted_digits(F.substring(digits, F.lit(1), size - 1), key, "card")
    # ``body`` is used twice; a transform over an array of one computes it once.
    full = F.get(F.transform(F.array(body), lambda b: F.concat(
        b, F.pmod(F.lit(0) - luhn_sum(b, size), F.lit(10)).cast("string"))), F.lit(0))
    return F.when(luhn_sum(digits, size) % 10 == 0, refilled(found, full)).otherwise(found)


def _phone(found: Column, key: str) -> Column:
    """A number of 7 to 15 digits; its country code stays."""
    code = F.regexp_extract(found, r"^(\+[0-9]{1,3})", 1)
    rest = F.substring(found, F.length(code) + 1, F.length(found))
    digits, size = only_digits(rest), F.length(only_digits(found))
    return F.when(size.between(7, 15), F.concat(code, refilled(rest, permuted_digits(digits, key, "phone")))) \
        .otherwise(found)


def _social(found: Column, key: str) -> Column:
    """Area 001 to 899 but 666, group 01 to 99, serial number 0001 to 9999."""
    area, group, serial = (F.substring(found, at, n).cast("long") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = F.when(area > 666, area - 2).otherwise(area - 1)
    value = permuted((index * 99 + group - 1) * 9999 + serial - 1, F.lit(898 * 99), F.lit(9999), key, "social")

    def written(v):
        place = F.floor(v / (99 * 9999)).cast("long")
        return F.concat_ws("-", F.lpad(F.when(place >= 665, place + 2).otherwise(place + 1).cast("string"), 3, "0"),
                           F.lpad((F.floor(v / 9999).cast("long") % 99 + 1).cast("string"), 2, "0"),
                           F.lpad((v % 9999 + 1).cast("string"), 4, "0"))

    return F.when(valid, F.get(F.transform(F.array(value), written), F.lit(0))).otherwise(found)


def _address(found: Column, key: str) -> Column:
    parts = F.transform(F.split(found, r"\."), lambda p: p.cast("long"))
    value = F.aggregate(parts, F.lit(0).cast("long"), lambda total, p: total * 256 + p)
    new = permuted(value, F.lit(65536), F.lit(65536), key, "address")
    written = F.get(F.transform(F.array(new), lambda v: F.concat_ws(".", *[
        F.pmod(F.shiftright(v, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)])), F.lit(0))
    return F.when(F.array_max(parts) <= 255, written).otherwise(found)


def _date(found: Column, key: str) -> Column:
    """A day of the same century. With signs between, day first where that is a date, else month first."""
    sign = F.regexp_extract(found, "[^0-9]", 0)
    parts = F.split(found, r"[^0-9]")
    a, b, c = (F.get(parts, F.lit(i)).cast("int") for i in range(3))

    def day(year, month, of):
        return F.try_to_date(F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"),
                                         F.lpad(of.cast("string"), 2, "0")), "yyyy-MM-dd")

    year_first, day_first = sign == "-", day(c, b, a)
    when = F.when(year_first, day(a, b, c)).otherwise(F.coalesce(day_first, day(c, a, b)))
    year = F.year(when)
    century = F.floor(year / 100).cast("int")
    begin = F.make_date(century * 100, F.lit(1), F.lit(1))
    leap = century % 4 == 0  # 36,525 = 75 * 487 days, else 36,524 = 92 * 397
    value = permuted(F.datediff(when, begin).cast("long"), F.when(leap, 75).otherwise(92).cast("long"),
                     F.when(leap, 487).otherwise(397).cast("long"), key, "date")

    def written(v):
        new = F.date_add(begin, v.cast("int"))

        def like(part, number):
            wide = F.length(F.get(parts, F.lit(part))) == 2
            return F.when(wide, F.lpad(number.cast("string"), 2, "0")).otherwise(number.cast("string"))

        first = day_first.isNotNull()
        other = F.concat(like(0, F.when(first, F.day(new)).otherwise(F.month(new))), sign,
                         like(1, F.when(first, F.month(new)).otherwise(F.day(new))), sign,
                         F.lpad(F.year(new).cast("string"), 4, "0"))
        return F.when(year_first, F.date_format(new, "yyyy-MM-dd")).otherwise(other)

    return F.when(when.isNotNull() & (year >= 100), F.get(F.transform(F.array(value), written), F.lit(0))) \
        .otherwise(found)


def _mod97(text: Column) -> Column:
    """Of digits and letters, these as 10 to 35."""
    def added(rest, i):
        value = F.instr(F.lit(DIGITS + LARGE), F.substring(text, i, F.lit(1))) - 1
        return (rest * F.when(value < 10, 10).otherwise(100) + value) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), added)


def _iban(found: Column, key: str) -> Column:
    """The account is permuted, the country stays, the check digits are worked out anew."""
    plain = F.regexp_replace(found, " ", "")
    country, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    valid = _mod97(F.concat(account, F.substring(plain, 1, 4))) == 1

    def written(new):
        check = F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
        signs = F.split(F.concat(country, check, new), "(?!^)")
        # Blanks go where they were.
        gaps = F.split(found, "[A-Z0-9]", -1)
        return F.array_join(F.zip_with(gaps, signs, lambda g, s: F.concat(g, F.coalesce(s, F.lit("")))), "")

    new = permuted_letters(account, key, "iban", (DIGITS, LARGE))
    return F.when(valid, F.get(F.transform(F.array(new), written), F.lit(0))).otherwise(found)


def _mail(found: Column, key: str) -> Column:
    name = F.substring_index(found, "@", 1)
    return F.concat(permuted_letters(name, key, "mail", (DIGITS, SMALL, LARGE)),
                    F.substring(found, F.length(name) + 1, F.length(found)))


def _secret(found: Column, key: str) -> Column:
    return permuted_letters(found, key, "secret", (DIGITS, SMALL[:6], LARGE[:6]))


PERMUTED = {"mail": _mail, "iban": _iban, "phone": _phone, "social": _social, "date": _date,
            "address": _address, "card": _card, "secret": _secret}


def pseudonym(found: Column, key: str) -> Column:
    """What takes the place of a string that matches one of ``KINDS``."""
    result = found
    for kind in reversed(KINDS):
        whole = f"^(?:{KINDS[kind]})$"
        result = F.when(found.rlike(whole), PERMUTED[kind](found, key)).otherwise(result)
    return result


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """All columns of ``docs``, ``text`` with personal data replaced, and ``n_replaced`` (long).

    ``n_replaced`` counts strings that changed; a column of that name is replaced. Strings that look like
    personal data but fail their check (Luhn, mod 97, ranges, calendar) stay. NULL and empty texts stay and
    count 0. Each row is worked on by itself, so repeated rows have equal results and an empty table gives
    an empty result. ``key`` is secret: who has it can undo the pseudonyms.
    """
    found, kept, new = (free_name(docs.columns, n) for n in ("_found", "_kept", "_new"))
    rows = docs.withColumn(found, F.regexp_extract_all("text", F.lit(f"({ANY})"), F.lit(1)))
    rows = rows.withColumn(new, F.transform(found, lambda m: pseudonym(m, key)))
    some = F.size(F.coalesce(F.col(found), F.array())) > 0
    rows = rows.withColumn(kept, F.when(some, F.split("text", ANY, -1)))
    text = F.when(some, F.array_join(F.zip_with(kept, new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")) \
        .otherwise(F.col("text"))
    changed = F.coalesce(F.aggregate(F.zip_with(found, new, lambda a, b: (a != b).cast("long")),
                                     F.lit(0).cast("long"), lambda total, one: total + one), F.lit(0))
    columns = [text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns if c != "n_replaced"]
    return rows.select(*columns, changed.cast("long").alias("n_replaced"))


# Whoever runs this in earnest brings a key of their own.
DEMONSTRATION_KEY = "a key for trials only"


def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymize(documents(spark, sf_dir).select("doc_id", "text"), DEMONSTRATION_KEY)


QUERIES = {"op1_pii_pseudonyms": op1_pii_pseudonyms}
ORACLE: dict[str, str] = {}
