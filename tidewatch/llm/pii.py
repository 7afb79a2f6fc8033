"""Format-preserving pseudonyms for personal data, with DataFrame operations only.

Emails, addresses of machines, account numbers, dates, phone numbers, social security numbers, card-like numbers and secret
hexadecimal tokens are found by one pattern and validated: octets up to 255, mod-97 account numbers, calendar dates of
1900-2099, allowed social security areas. Each value is then permuted within its format by a keyed Feistel network on its
symbols (halves that take turns in being shifted by a hash of the other half), so that equal values get equal pseudonyms in all
documents, different values different ones, and blanks, signs and separators stay. Check digits follow: a number of 13 to 19
digits keeps how far its last digit is from the Luhn digit, an account number gets valid check digits. Dates are permuted by day
number, walking on while the network leaves the range.

Every digit and letter before the @ of an email is permuted; letters and numbers outside ASCII keep the block of 256 code points
that they stand in.

The pattern starts only where a word or number starts and does not go back, so its time grows with the text's length. Texts
without a digit and without an @, which no value can be in, are passed through.

Defined results: null text stays null and counts no values; an empty text stays empty. Values that fail validation stay as they
are. Repeated rows give repeated rows. Other columns of the input are kept by `pseudonymised` and not read by the query. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import table

#: For tests and checks; a deployment passes its own secret.
KEY = "tidewatch-demonstration-key"
ROUNDS = 10

_EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+(?<=\.[A-Za-z]{2,24})"
_HEX = r"(?<![0-9A-Za-z])(?=[0-9]*+[A-Fa-f])(?=[A-Fa-f]*+[0-9])[0-9A-Fa-f]{32,128}(?![0-9A-Za-z])"
_IP = r"(?<![\d.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?!\d|\.\d)"
_ACCOUNT = r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"
_DATE = r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d/]|[.-]\d)"
_SSN = r"(?<![\d-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\d-])"
_PHONE = r"(?<![\d+(])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])|\(\d{3}\) ?|\d{3}[.-])\d{3,4}[ .-]\d{4}(?!\d)"
_NUMBER = r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)"

#: In the order in which they are tried at a place.
KINDS = {"email": _EMAIL, "secret": _HEX, "account": _ACCOUNT, "ip": _IP, "date": _DATE, "ssn": _SSN, "phone": _PHONE, "number": _NUMBER}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())

_FIRST_DAY, _DAYS = "1900-01-01", 73049
_WIDE, _LOW = 271, 270  # 271 * 270 is just above the number of days
_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _bound(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _hashed(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *parts), 512)


def _added(symbol: Column, hashed: Column, radix: Column) -> Column:
    return F.pmod(symbol + hashed, radix)


def feistel(symbols: Column, radix: Column | None, tweak: Column, key: str, added=_added, shown=lambda symbols: symbols) -> Column:
    """A keyed permutation of arrays of numbers below radix, of the same length and tweak.

    `added` shifts a symbol by a number and `shown` gives the numbers of symbols that are more than that.
    """
    half = F.floor(F.size(symbols) / 2).cast("int")
    start = F.struct(F.slice(symbols, 1, half).alias("a"), F.slice(symbols, half + 1, F.size(symbols)).alias("b"))

    def turn(state: Column, number: Column) -> Column:
        def shifted(text: Column) -> Column:
            return F.transform(state["a"], lambda x, k: added(x, F.conv(F.substring(text, k * 2 + 1, F.lit(2)), 16, 10).cast("int"), radix))

        parts = (tweak, number.cast("string"), F.size(symbols).cast("string"), F.array_join(shown(state["b"]), ","))
        text, size = _hashed(key, *parts), F.size(state["a"])
        # A hash of 128 hexadecimal digits shifts 64 symbols; later ones take further hashes.
        more = F.transform(F.sequence(F.lit(1), F.floor((size - 1) / 64).cast("int")), lambda block: _hashed(key, F.lit("block"), block.cast("string"), *parts))
        text = F.when(size > 64, F.concat(text, F.array_join(more, ""))).otherwise(text)
        return F.struct(state["b"].alias("a"), _bound(text, shifted).alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: F.concat(s["a"], s["b"]))


def _symbols(text: Column, alphabet: str) -> Column:
    return F.transform(F.split(text, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)


def _values(text: Column, alphabet: str) -> Column:
    return F.when(text == "", F.array().cast("array<int>")).otherwise(_symbols(text, alphabet))


def _block(c: Column) -> Column:
    """The letters and numbers outside ASCII among the 256 code points around c."""
    first = F.floor(F.conv(F.hex(F.encode(c, "UTF-32")), 16, 10).cast("int") / 256)
    points = F.transform(F.sequence(F.lit(0), F.lit(255)), lambda k: F.lpad(F.hex(first * 256 + k), 8, "0"))
    # Halves of surrogate pairs are no characters; no letter is in their blocks.
    return F.regexp_replace(F.decode(F.unhex(F.array_join(points, "")), "UTF-32"), r"[^\p{L}\p{N}]|[\x00-\x7F]", "")


def _others(text: Column) -> Column:
    """The letters and numbers outside ASCII, each as its place in its block and the block."""
    found = F.regexp_replace(text, r"[^\p{L}\p{N}]|[\x00-\x7F]", "")
    places = F.transform(F.split(found, ""), lambda c: _bound(_block(c), lambda b: F.struct((F.instr(b, c) - 1).alias("x"), b.alias("block"))))
    return F.when(found == "", F.array().cast("array<struct<x:int,block:string>>")).otherwise(places)


def _others_moved(others: Column, tweak: Column, key: str) -> Column:
    def added(symbol: Column, hashed: Column, _) -> Column:
        return F.struct(F.pmod(symbol["x"] + hashed, F.length(symbol["block"])).alias("x"), symbol["block"].alias("block"))

    moved = feistel(others, None, tweak, key, added, lambda symbols: F.transform(symbols, lambda s: s["x"]))
    return F.transform(moved, lambda s: F.substring(s["block"], s["x"] + 1, F.lit(1)))


def _refilled(text: Column, digits: Column, letters: Column, others: Column | None = None) -> Column:
    """text with its digits, its letters a-z in either case, and what else `others` has, replaced in order; all else stays."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("d"), F.lit(0).alias("l"), F.lit(0).alias("o"))

    def next_state(state: Column, out: Column, **moved: int) -> Column:
        return F.struct(F.concat(state["out"], out).alias("out"), *[(state[n] + moved.get(n, 0)).alias(n) for n in "dlo"])

    def put(state: Column, c: Column) -> Column:
        letter = F.substring(F.lit(_LETTERS), F.get(letters, state["l"]) + 1, F.lit(1))
        new = (
            F.when(c.between("0", "9"), next_state(state, F.get(digits, state["d"]).cast("string"), d=1))
            .when(c.between("a", "z"), next_state(state, letter, l=1))
            .when(c.between("A", "Z"), next_state(state, F.upper(letter), l=1))
        )
        if others is not None:
            new = new.when(c > "\x7f", next_state(state, F.get(others, state["o"]), o=1))
        return new.otherwise(next_state(state, c))

    return F.aggregate(F.split(text, ""), start, put, lambda s: s["out"])


def _mixed(text: Column, tweak: str, key: str) -> Column:
    """Digits, letters a-z, and letters and numbers outside ASCII permuted, each among themselves."""
    digits = _values(F.regexp_replace(text, r"[^0-9]", ""), "0123456789")
    letters = _values(F.lower(F.regexp_replace(text, r"[^A-Za-z]", "")), _LETTERS)

    def plain(ds: Column) -> Column:
        return _bound(feistel(letters, F.lit(26), F.concat(F.lit(tweak), F.array_join(ds, ",")), key), lambda ls: _refilled(text, then(ds, ls), ls))

    def then(ds: Column, ls: Column) -> Column:
        return feistel(ds, F.lit(10), F.concat(F.lit(tweak), F.array_join(ls, ",")), key)

    def with_others(ds: Column) -> Column:
        foreign = F.regexp_replace(text, r"[\x00-\x7F]", "")
        moved = feistel(letters, F.lit(26), F.concat(F.lit(tweak), F.array_join(ds, ","), F.lit(";"), foreign), key)
        return _bound(moved, lambda ls: _bound(then(ds, ls), lambda new: _refilled(
            text, new, ls, _others_moved(_others(text), F.concat(F.lit(tweak), F.array_join(new, ","), F.lit(";"), F.array_join(ls, ",")), key))))

    return F.when(text.rlike(r"[^\x00-\x7F]"), _bound(digits, with_others)).otherwise(_bound(digits, plain))


def _luhn(payload: Column) -> Column:
    """The Luhn digit for an array of digits."""

    def weight(x: Column, at: Column) -> Column:
        double = F.when((F.size(payload) - at) % 2 == 1, x * 2).otherwise(x)
        return F.when(double > 9, double - 9).otherwise(double)

    return F.pmod(-F.aggregate(F.transform(payload, weight), F.lit(0), lambda s, x: s + x), F.lit(10))


def _number(text: Column, key: str) -> Column:
    digits = _symbols(F.regexp_replace(text, r"[^0-9]", ""), "0123456789")

    def renewed(ds: Column) -> Column:
        payload = F.slice(ds, 1, F.size(ds) - 1)
        off = F.element_at(ds, -1) - _luhn(payload)
        new = feistel(payload, F.lit(10), F.lit("number"), key)
        return _bound(new, lambda p: _refilled(text, F.concat(p, F.array(F.pmod(_luhn(p) + off, F.lit(10)))), F.array().cast("array<int>")))

    return _bound(digits, renewed)


def _digits_only(text: Column, tweak: str, key: str) -> Column:
    digits = _symbols(F.regexp_replace(text, r"[^0-9]", ""), "0123456789")
    return _bound(feistel(digits, F.lit(10), F.lit(tweak), key), lambda ds: _refilled(text, ds, F.array().cast("array<int>")))


def _ssn(text: Column, key: str) -> Column:
    """Area 001-665 or 667-899, group 01-99, serial 0001-9999, each by its number in that order, in one network per part."""
    area = F.substring(text, 1, 3).cast("int")
    area = area - F.when(area > 666, 2).otherwise(1)
    group, serial = F.substring(text, 5, 2).cast("int") - 1, F.substring(text, 8, 4).cast("int") - 1
    start = F.struct(area.alias("a"), group.alias("g"), serial.alias("s"))

    def shift(value: Column, size: int, *others: Column) -> Column:
        return F.pmod(value + F.conv(F.substring(_hashed(key, F.lit("ssn"), *[o.cast("string") for o in others]), 1, 8), 16, 10).cast("long"), F.lit(size)).cast("int")

    def turn(state: Column, number: Column) -> Column:
        return _bound(shift(state["a"], 898, number, state["g"], state["s"]), lambda a: _bound(shift(state["g"], 99, number, a, state["s"]), lambda g: F.struct(
            a.alias("a"), g.alias("g"), shift(state["s"], 9999, number, a, g).alias("s")
        )))

    def shown(x: Column) -> Column:
        back = x["a"] + F.when(x["a"] + 1 >= 666, 2).otherwise(1)
        return F.format_string("%03d-%02d-%04d", back, x["g"] + 1, x["s"] + 1)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, shown)


def _ip(text: Column, key: str) -> Column:
    octets = F.split(text, r"\.").cast("array<int>")
    return F.array_join(feistel(octets, F.lit(256), F.lit("ip"), key), ".")


def _secret(text: Column, key: str) -> Column:
    alphabet = "0123456789abcdef"
    new = feistel(_symbols(F.lower(text), alphabet), F.lit(16), F.lit("secret"), key)
    shown = F.array_join(F.transform(new, lambda x: F.substring(F.lit(alphabet), x + 1, F.lit(1))), "")
    return F.when(text == F.upper(text), F.upper(shown)).otherwise(shown)


def _remainder(text: Column) -> Column:
    """Mod 97 of an account number whose country and check digits stand last."""
    value = lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(text, ""), F.lit(0), lambda r, c: (r * F.when(c.between("0", "9"), 10).otherwise(100) + value(c)) % 97)


def _account(text: Column, key: str) -> Column:
    plain = F.replace(text, F.lit(" "), F.lit(""))
    rest = F.substr(text, F.lit(5))
    valid = _remainder(F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))) == 1

    def renewed(body: Column) -> Column:
        check = 98 - _remainder(F.concat(F.replace(body, F.lit(" "), F.lit("")), F.substring(text, 1, 2), F.lit("00")))
        return F.concat(F.substring(text, 1, 2), F.lpad(check.cast("string"), 2, "0"), body)

    return F.when(valid, _bound(_mixed(rest, "account", key), renewed)).otherwise(text)


def _date(text: Column, key: str) -> Column:
    def turn(day: Column, number: Column) -> Column:
        high, low = F.floor(day / _LOW).cast("int"), F.pmod(day, F.lit(_LOW)).cast("int")
        hashed = lambda x, side: F.conv(F.substring(_hashed(key, F.lit(f"date{side}"), number.cast("string"), x.cast("string")), 1, 8), 16, 10).cast("long")
        return _bound(F.pmod(high + hashed(low, 0), F.lit(_WIDE)).cast("int"), lambda h: (h * _LOW + F.pmod(low + hashed(h, 1), F.lit(_LOW))).cast("int"))

    def network(day: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), day, turn)

    def renewed(form: str) -> Column:
        day = F.date_diff(F.try_to_timestamp(text, F.lit(form)).cast("date"), F.lit(_FIRST_DAY).cast("date"))
        # One step in 600 leaves the range; a walk that is still outside after 16 more does not occur.
        walk = F.aggregate(F.sequence(F.lit(1), F.lit(16)), network(day), lambda d, _: F.when(d < _DAYS, d).otherwise(network(d)))
        return F.when(day.between(0, _DAYS - 1), F.date_format(F.date_add(F.lit(_FIRST_DAY).cast("date"), walk), form))

    return F.coalesce(
        F.when(text.contains("-"), renewed("yyyy-MM-dd")).when(text.contains("/"), F.coalesce(renewed("dd/MM/yyyy"), renewed("MM/dd/yyyy"))).otherwise(renewed("dd.MM.yyyy")), text
    )


def _email(text: Column, key: str) -> Column:
    local, domain = F.substring_index(text, "@", 1), F.substring_index(text, "@", -1)
    return F.concat(_mixed(local, "email", key), F.lit("@"), domain)


def _whole(kind: str) -> str:
    return f"^(?:{KINDS[kind]})$"


def kind_of(value: Column) -> Column:
    found = F.when(value.rlike(_whole("email")), "email")
    for kind in list(KINDS)[1:]:
        found = found.when(value.rlike(_whole(kind)), kind)
    return found


def pseudonym(value: Column, key: str = KEY) -> Column:
    """The pseudonym of one value that the pattern matched; the value itself where validation fails."""
    makers = {
        "email": _email, "secret": _secret, "account": _account, "ip": _ip, "date": _date, "ssn": _ssn,
        "phone": lambda v, k: _digits_only(v, "phone", k), "number": _number,
    }

    def chosen(kind: Column) -> Column:
        out = F.when(kind == "email", makers["email"](value, key))
        for name, make in list(makers.items())[1:]:
            out = out.when(kind == name, make(value, key))
        return F.coalesce(out, value)

    return _bound(kind_of(value), chosen)


def found_in(text: Column) -> Column:
    """All values that the pattern matches, in order."""
    return F.when(text.rlike(r"[\d@]"), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _rewritten(text: Column, found: Column, key: str) -> Column:
    between = F.split(text, PATTERN, -1)
    joined = F.flatten(F.zip_with(between, found, lambda a, b: F.array(a, F.coalesce(pseudonym(b, key), F.lit("")))))
    return F.when(F.size(found) == 0, text).otherwise(F.array_join(joined, ""))


def pseudonymised(docs: DataFrame, key: str = KEY, column: str = "text") -> DataFrame:
    """docs as `row`, with `masked` (the rewritten text) and `found` (the values that were matched)."""
    rows = docs.select(F.struct("*").alias("row"), found_in(F.col(column).cast("string")).alias("found"))
    return rows.select("row", _rewritten(F.col("row").getField(column).cast("string"), F.col("found"), key).alias("masked"), F.coalesce("found", F.array().cast("array<string>")).alias("found"))


def op8_pii(spark, folder: str) -> DataFrame:
    rows = pseudonymised(table(spark, folder, "documents").select(F.col("doc_id").cast("long"), "text"))
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform("found", kind_of))), ",")
    return rows.select("row.doc_id", F.col("masked").alias("text"), F.size("found").cast("long").alias("n_found"), kinds.alias("kinds"))


QUERIES = {"op8_pii": op8_pii}
ORACLE: dict[str, str] = {}
