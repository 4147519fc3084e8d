"""Format-preserving pseudonyms for personal data, as column expressions only.

Card numbers are looked for first, in all runs of whole digit groups; other values are found by one pattern. All are validated
(check digits of cards and bank accounts, calendar of dates, ranges of address octets and social numbers) and permuted within
their format by a keyed Feistel network: alternating halves are added a keyed hash of the other half, modulo the
half's range. The permutation of a value depends on the key, its kind and its length alone, so equal values get equal
pseudonyms in all documents, and different ones different pseudonyms. Separators, letter case and check digits stay valid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8
#: Longest run permuted at once; longer runs are permuted piece by piece, so that halves fit a long.
LONGEST = {10: 34, 16: 28, 26: 20}
CARD_LENGTHS = (13, 19)
PHONE_LENGTHS = (7, 15)
YEARS = (1900, 200)

# No pattern can start inside a run it might have matched, and runs are possessive: matching stays linear.
EMAIL = r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
SECRET = r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,128}+|[0-9A-F]{32,128}+)(?![A-Za-z0-9])"
TOKEN = r"(?<![A-Za-z0-9_])(?:(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])|[spr]k_(?:live|test)_[0-9A-Za-z]{10,200}+)"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
# A phone number ends on the first group's border at which it may be whole, so that digits after it are none of its own: with the country
# code 1 after ten more digits, with another after ten in all, and if there are no so many, on the last border after seven.
PHONE = (r"(?<![0-9A-Za-z+])\+(?:1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
         r"|[0-9](?:\)?[ .-]?\(?[0-9]){9,14}?(?![0-9])|[0-9](?:\)?[ .-]?\(?[0-9]){6,8}(?![0-9]))")
# Without '+' it needs parentheses, a leading 0, or groups of 3, 3 and 4 digits.
AREA = r"(?<![0-9A-Za-z])(?:\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|\([0-9]{2,5}\)(?:[ .-]?[0-9]){5,9}?(?![0-9]))"
GROUPS = (r"(?<![0-9A-Za-z.+-])(?:(?:1[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z]|[.-][0-9])"
          r"|(?=0[0-9]{1,4}[ .-])(?:00(?:[ .-]?[0-9]){9,14}?|0(?:[ .-]?[0-9]){8,13}?)(?![0-9A-Za-z]|[.-][0-9]))")
COUNTRY = r"^\+(?:[0-9]{1,3}(?![0-9])|1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
#: Digits with spaces and dashes that may hold a card number; a character class, so that any length is matched without recursion.
RUN = r"(?<![0-9A-Za-z.+-])(?=[0-9](?:[ -]?[0-9]){12})(?![A-Za-z0-9._%+-]*+@)[0-9 -]++"
#: A card's pseudonym until the other kinds are replaced lies between marks. A mark of the text itself is escaped until the end.
MARK, ESCAPE = "\uFDD0", "\uFDD1"
DONE = f"{MARK}[0-9][0-9 -]+{MARK}"
ADDRESS = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])"
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
MONTH = "(?:January|February|March|April|May|June|July|August|September|October|November|December)"
DATE = (r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})"
        rf"(?![0-9]|[/.-][0-9])|\b{MONTH} [0-9]{{1,2}}, [0-9]{{4}}(?![0-9])|(?<![0-9])[0-9]{{1,2}} {MONTH} [0-9]{{4}}(?![0-9])")
#: Forms of dates: pattern of the whole value and the format. Of a day and month that may be swapped, the first that is valid.
FORMS = (
    ("[0-9]{4}-[0-9]{2}-[0-9]{2}", "yyyy-MM-dd"), ("[0-9]{4}/[0-9]{2}/[0-9]{2}", "yyyy/MM/dd"),
    ("[0-9]{2}/[0-9]{2}/[0-9]{4}", "MM/dd/yyyy"), ("[0-9]{2}/[0-9]{2}/[0-9]{4}", "dd/MM/yyyy"),
    ("[0-9]{2}[.][0-9]{2}[.][0-9]{4}", "dd.MM.yyyy"), ("[0-9]{1,2}[.][0-9]{1,2}[.][0-9]{4}", "d.M.yyyy"),
    (f"{MONTH} [0-9]{{1,2}}, [0-9]{{4}}", "MMMM d, yyyy"), (f"[0-9]{{1,2}} {MONTH} [0-9]{{4}}", "d MMMM yyyy"),
)
#: Letters and digits of mail names and tokens are permuted in blocks of so many characters, so that long ones cost their length.
BLOCK = 20
#: Valid social numbers: areas without 000, 666 and 900 to 999; groups 01 to 99; serials 0001 to 9999.
AREAS, NUMBERS = 898, 99 * 9999
ANY = "|".join((DONE, EMAIL, TOKEN, IBAN, PHONE, AREA, SECRET, ADDRESS, DATE, SOCIAL, GROUPS))


def _bound(value: Column, use) -> Column:
    """use(value), with the value evaluated once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _power(radix: int, exponent: Column) -> Column:
    """radix ** exponent as a long, for exponents whose power fits."""
    return F.element_at(F.array(*[F.lit(radix ** i).cast("long") for i in range(18) if radix ** i < 1 << 63]), exponent + 1)


def _hash(*parts: Column) -> Column:
    return F.conv(F.substring(F.sha2(F.concat_ws(":", *parts), 256), 1, 15), 16, 10).cast("long")


def _feistel(a: Column, b: Column, range_a: Column, range_b: Column, *tweak: Column) -> Column:
    """The permuted pair (a, b) with a in [0, range_a) and b in [0, range_b)."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")),
        lambda s, i: F.when(i % 2 == 1, F.struct(
            ((s["a"] + _hash(*tweak, i, s["b"]) % range_a) % range_a).alias("a"), s["b"].alias("b"))).otherwise(F.struct(
                s["a"].alias("a"), ((s["b"] + _hash(*tweak, i, s["a"]) % range_b) % range_b).alias("b"))),
    )


def _number(text: Column, radix: int) -> Column:
    """A numeral's value; of letters, a is 0."""
    if radix == 26:
        return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0).cast("long"), lambda n, c: n * 26 + F.ascii(c) - 97)
    return F.coalesce(F.conv(text, radix, 10).cast("long"), F.lit(0).cast("long"))


def _numeral(value: Column, length: Column, radix: int) -> Column:
    if radix == 26:
        letter = lambda i: F.char(97 + F.pmod(_quotient(value, _power(26, i)), F.lit(26)))
        return F.when(length == 0, "").otherwise(F.array_join(F.transform(F.sequence(length - 1, F.lit(0), F.lit(-1)), letter), ""))
    return F.when(length == 0, "").otherwise(F.lpad(F.lower(F.conv(value.cast("string"), 10, radix)), length, "0"))


def _quotient(value: Column, divisor: Column) -> Column:
    """Whole-number division of non-negative longs."""
    return ((value - F.pmod(value, divisor)) / divisor).cast("long")


def permuted(run: Column, radix: int, kind: str, key: str) -> Column:
    """A run of digits of the radix, permuted; its length stays."""
    def piece(part: Column) -> Column:
        n = F.length(part)
        half = F.floor(n / 2).cast("int")
        rest = n - half
        pair = _feistel(_number(F.substr(part, F.lit(1), half), radix), _number(F.substr(part, half + 1, rest), radix),
                        _power(radix, half), _power(radix, rest), F.lit(key), F.lit(kind), n)
        # bound once, so that the network runs once
        both = F.transform(F.array(pair), lambda s: F.concat(_numeral(s["a"], half, radix), _numeral(s["b"], rest, radix)))
        return F.element_at(both, 1)

    size = LONGEST[radix]
    starts = F.sequence(F.lit(1), F.greatest(F.length(run), F.lit(1)), F.lit(size))
    return F.when(run == "", "").otherwise(
        F.array_join(F.transform(starts, lambda at: piece(F.substr(run, at, F.lit(size)))), ""))


def _into(template: Column, kept: str, fill: Column) -> Column:
    """The template with the characters of class kept replaced, in order, by those of fill."""
    return _bound(F.struct(template.alias("template"), fill.alias("fill")), lambda x: F.aggregate(
        F.split(x["template"], ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.when(c.rlike(f"^{kept}$"), F.struct(
            F.concat(s["out"], F.substr(x["fill"], s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))).otherwise(
                F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
        lambda s: s["out"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_sum(digits: Column, doubled_from_right: int) -> Column:
    """Sum of digits where every second one is doubled; doubled_from_right: 1 if the last is, else 0."""
    reversed_ = F.reverse(digits)
    def worth(i: Column) -> Column:
        d = F.substr(reversed_, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == (1 if doubled_from_right else 0), twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + worth(i))


def is_card(value: Column) -> Column:
    """No issuer's numbers begin with 0; international phone numbers do."""
    digits = _digits(value)
    return F.length(digits).between(*CARD_LENGTHS) & ~digits.startswith("0") & (luhn_sum(digits, 0) % 10 == 0)


def card(value: Column, key: str) -> Column:
    """All digits but the last are permuted, then the check digit is set anew."""
    digits = _digits(value)
    body = permuted(F.substr(digits, F.lit(1), F.length(digits) - 1), 10, "card", key)
    full = F.element_at(F.transform(F.array(body), lambda b: F.concat(b, F.pmod(-luhn_sum(b, 1), F.lit(10)).cast("string"))), 1)
    return _into(value, "[0-9]", full)


#: How card numbers are commonly written; such ones are preferred to other runs of groups that pass by chance.
USUAL = "^(?:[0-9]{13,19}|(?:[0-9]{4}[ -]){3}[0-9]{4}(?:[ -]?[0-9]{1,3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})$"


def cards(run: Column, key: str) -> Column:
    """The run with every card number replaced and marked. A card number is a valid run of whole groups with single separators."""
    def joined(tokens: Column, at: Column, n: Column) -> Column:
        return F.array_join(F.slice(tokens, at, n), "")

    def bare(text: Column) -> Column:
        return F.regexp_replace(text, "[ -]+$", "")

    def spans(tokens: Column) -> Column:
        """Of every first group that begins a valid run: place, groups and whether it is usual; the usual ones first, then the longest."""
        def best(at: Column) -> Column:
            lengths = F.sequence(F.lit(1), F.least(F.lit(CARD_LENGTHS[1]), F.size(tokens) - at + 1))
            valid = F.filter(F.transform(lengths, lambda n: F.struct(
                bare(joined(tokens, at, n)).alias("text"), n.alias("n"))), lambda x: is_card(x["text"]) & ~x["text"].rlike("[ -]{2}"))
            rated = F.array_max(F.transform(valid, lambda x: F.struct(x["text"].rlike(USUAL).alias("usual"), x["n"].alias("n"))))
            return F.struct(at.alias("at"), rated["n"].alias("n"), rated["usual"].alias("usual"))

        return F.transform(F.sequence(F.lit(1), F.size(tokens)), best)

    def chosen(all_: Column) -> Column:
        """Spans that do not overlap, from left to right; an unusual one gives way to usual ones that begin within it."""
        def step(state: Column, x: Column) -> Column:
            inside = F.exists(F.slice(all_, x["at"] + 1, x["n"] - 1), lambda y: F.coalesce(y["usual"], F.lit(False)))
            taken = (x["at"] >= state["next"]) & (x["usual"] | ~inside)
            return F.when(taken, F.struct((x["at"] + x["n"]).alias("next"), F.concat(
                state["taken"], F.array(F.struct(x["at"].alias("at"), x["n"].alias("n")))).alias("taken"))).otherwise(state)

        start = F.struct(F.lit(1).alias("next"), F.expr("cast(array() as array<struct<at: int, n: int>>)").alias("taken"))
        return F.aggregate(F.filter(all_, lambda x: x["n"].isNotNull()), start, step, lambda state: state["taken"])

    def made(tokens: Column, found: Column) -> Column:
        ends = F.concat(F.array(F.lit(1)), F.transform(found, lambda x: x["at"] + x["n"]))
        starts = F.concat(F.transform(found, lambda x: x["at"]), F.array(F.size(tokens) + 1))
        gaps = F.zip_with(ends, starts, lambda a, b: joined(tokens, a, b - a))
        values = F.transform(found, lambda x: F.transform(F.array(joined(tokens, x["at"], x["n"])), lambda text: F.concat(
            F.lit(MARK), card(bare(text), key), F.lit(MARK), F.regexp_extract(text, "[ -]*$", 0)))[0])
        return F.array_join(F.flatten(F.zip_with(gaps, F.concat(values, F.array(F.lit(""))), lambda gap, value: F.array(gap, value))), "")

    # each step is bound once
    tokens = F.array(F.regexp_extract_all(run, F.lit("[0-9]+[ -]*"), F.lit(0)))
    return F.transform(tokens, lambda t: F.transform(F.transform(F.array(spans(t)), chosen), lambda found: F.when(F.size(found) == 0, run).otherwise(made(t, found)))[0])[0]


def number(value: Column, kind: str, key: str) -> Column:
    return _into(value, "[0-9]", permuted(_digits(value), 10, kind, key))


def phone(value: Column, key: str) -> Column:
    """The country code after a '+' stays: the digits before the first separator, or in a number without one, those the code list gives."""
    code = F.regexp_extract(value, COUNTRY, 0)
    return F.concat(code, number(F.substr(value, F.length(code) + 1, F.length(value)), "phone", key))


def address(value: Column, key: str) -> Column:
    """Two 16-bit halves of an IPv4 address."""
    octet = [F.split(value, r"\.")[i].cast("int") for i in range(4)]
    pair = _feistel(octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], F.lit(65536), F.lit(65536), F.lit(key), F.lit("address"))
    low = lambda x: F.pmod(x, F.lit(256)).cast("string")
    high = lambda x: F.shiftright(x, 8).cast("string")
    return F.element_at(F.transform(F.array(pair), lambda s: F.concat_ws(".", high(s["a"]), low(s["a"]), high(s["b"]), low(s["b"]))), 1)


def is_address(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda x: x.cast("int") <= 255)


def scrambled(text: Column, kind: str, key: str) -> Column:
    """ASCII letters and digits permuted in blocks of fixed length; case, marks and other letters stay."""
    def block(part: Column) -> Column:
        lower = F.lower(part)
        letters = permuted(F.regexp_replace(lower, "[^a-z]", ""), 26, kind, key)
        made = _into(_into(lower, "[a-z]", letters), "[0-9]", permuted(_digits(part), 10, kind, key))
        cased = F.zip_with(F.split(part, ""), F.split(made, ""), lambda old, new: F.when(
            old.rlike("^[A-Z]$"), F.upper(new)).when(old.rlike("^[a-z0-9]$"), new).otherwise(old))
        return F.array_join(cased, "")

    return _bound(text, lambda t: F.array_join(F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1)), F.lit(BLOCK)),
        lambda at: _bound(F.substr(t, at, F.lit(BLOCK)), block)), ""))


def email(value: Column, key: str) -> Column:
    """The name is scrambled; the domain stays."""
    return _bound(F.substring_index(value, "@", 1), lambda local: F.concat(
        scrambled(local, "email", key), F.substr(value, F.length(local) + 1, F.length(value))))


def token(value: Column, key: str) -> Column:
    """A key of a service: what follows the prefix is scrambled."""
    return _bound(F.regexp_extract(value, "^(?:AKIA|ASIA|.k_(?:live|test)_)", 0), lambda prefix: F.concat(
        prefix, scrambled(F.substr(value, F.length(prefix) + 1, F.length(value)), "token", key)))


def social(value: Column, key: str) -> Column:
    """A valid social number becomes another valid one."""
    area = F.substr(value, F.lit(1), F.lit(3)).cast("int")
    place = area - F.when(area > 666, 2).otherwise(1)
    rest = (F.substr(value, F.lit(5), F.lit(2)).cast("int") - 1) * 9999 + F.substr(value, F.lit(8), F.lit(4)).cast("int") - 1
    pair = _feistel(place, rest, F.lit(AREAS), F.lit(NUMBERS), F.lit(key), F.lit("social"))
    return _bound(pair, lambda s: F.concat_ws(
        "-", F.lpad((s["a"] + F.when(s["a"] >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
        F.lpad((_quotient(s["b"], F.lit(9999)) + 1).cast("string"), 2, "0"),
        F.lpad((F.pmod(s["b"], F.lit(9999)) + 1).cast("string"), 4, "0")))


def _mod_97(text: Column) -> Column:
    """Remainder of a numeral whose letters count as two digits, 10 to 35."""
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), lambda n, c: F.when(
        c.rlike("[0-9]"), (n * 10 + c.try_cast("int")) % 97).otherwise((n * 100 + F.ascii(c) - 55) % 97))


def is_iban(value: Column) -> Column:
    bare = F.replace(value, F.lit(" "), F.lit(""))
    return F.length(bare).between(15, 34) & (_mod_97(F.concat(F.substr(bare, F.lit(5), F.length(bare)), F.substr(bare, F.lit(1), F.lit(4)))) == 1)


def iban(value: Column, key: str) -> Column:
    """Country, bank letters and spaces stay; the account's digits are permuted and the check digits set anew."""
    def made(x: Column) -> Column:
        country = F.substr(x, F.lit(1), F.lit(2))
        body = _into(F.substr(x, F.lit(5), F.length(x)), "[0-9]", permuted(_digits(F.substr(x, F.lit(5), F.length(x))), 10, "iban", key))
        return _bound(body, lambda own: F.concat(
            country, F.lpad((98 - _mod_97(F.concat(F.replace(own, F.lit(" "), F.lit("")), country, F.lit("00")))).cast("string"), 2, "0"), own))

    return _bound(value, made)


def secret(value: Column, key: str) -> Column:
    made = permuted(F.lower(value), 16, "secret", key)
    return F.when(F.lower(value) == value, made).otherwise(F.upper(made))


def _date(value: Column, form: str) -> Column:
    return F.try_to_timestamp(value, F.lit(form)).cast("date")


def date(value: Column, form: str, key: str) -> Column:
    """A date of the years 1900 to 2099 in the same form: year and day of the year are permuted together.

    The 366th day stays one, of another leap year.
    """
    first, years = YEARS
    day = _date(value, form)
    year, of_year = F.year(day) - first, F.dayofyear(day) - 1
    pair = _feistel(year, of_year, F.lit(years), F.lit(365), F.lit(key), F.lit("date"))
    leap = F.pmod((F.year(day) - 1904) / 4 + _hash(F.lit(key), F.lit("leap")) % 49, F.lit(49)).cast("int") * 4 + 1904
    common_day = F.element_at(F.transform(F.array(pair), lambda s: F.date_add(
        F.make_date((s["a"] + first).cast("int"), F.lit(1), F.lit(1)), s["b"].cast("int"))), 1)
    return F.date_format(F.when(of_year == 365, F.make_date(leap, F.lit(12), F.lit(31))).otherwise(common_day), form)


def is_date(value: Column, form: str) -> Column:
    year = F.year(_date(value, form))
    return F.coalesce((year >= YEARS[0]) & (year < YEARS[0] + YEARS[1]), F.lit(False))


def kind(value: Column) -> Column:
    """What a matched value is; of a date its format. Null if it does not validate."""
    whole = lambda pattern: value.rlike(f"^(?:{pattern})$")
    found = F.when(value.startswith(MARK), "done").when(value.contains("@"), "email").when(whole(TOKEN), "token").when(
        whole(IBAN), F.when(is_iban(value), "iban")).when(value.rlike("^[+(]"), "phone").when(
        whole("[0-9]{1,3}(?:[.][0-9]{1,3}){3}"), F.when(is_address(value), "address"))
    for pattern, form in FORMS:
        found = found.when(whole(pattern) & is_date(value, form), form)
    return (
        found.when(whole("|".join(pattern for pattern, _ in FORMS)), None)
        .when(whole("[0-9]{3}-[0-9]{2}-[0-9]{4}"), F.when(~value.rlike("^(?:000|666|9)|-00-|-0000$"), "social"))
        .when(F.length(value) >= 32, F.when(value.rlike("[0-9]") & value.rlike("[A-Fa-f]"), "secret"))
        .when(F.length(_digits(value)).between(*PHONE_LENGTHS), "phone")
    )


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a matched value, or the value itself if it does not validate."""
    def made(k: Column) -> Column:
        out = (
            F.when(k == "email", email(value, key)).when(k == "token", token(value, key)).when(k == "iban", iban(value, key))
            .when(k == "phone", phone(value, key)).when(k == "address", address(value, key)).when(k == "social", social(value, key))
            .when(k == "secret", secret(value, key)).when(k == "done", F.regexp_replace(value, MARK, "")))
        for _, form in FORMS:
            out = out.when(k == form, date(value, form, key))
        return out.otherwise(value)

    return _bound(kind(value), made)


def _replaced(text: Column, pattern: str, by) -> Column:
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), by)
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(between, F.concat(found, F.array(F.lit(""))), lambda gap, value: F.array(gap, value))
    return F.array_join(F.flatten(pairs), "")


def pseudonymised(text: Column, key: str) -> Column:
    """The text with every validated value replaced. Null stays null."""
    escaped = F.replace(text, F.lit(MARK), F.lit(MARK + ESCAPE))
    joined = _replaced(_replaced(escaped, RUN, lambda run: cards(run, key)), ANY, lambda value: pseudonym(value, key))
    return F.when(text.rlike("[0-9@]"), F.replace(joined, F.lit(MARK + ESCAPE), F.lit(MARK))).otherwise(text)


def protect(docs: DataFrame, key: str) -> DataFrame:
    """docs with text pseudonymised, and n_chars, if there, set to its length. All rows and other columns stay.

    A null text stays null; repeated rows get equal texts. A value of any length is replaced whole, in blocks, in time that grows
    with its length.
    """
    made = docs.withColumn("text", pseudonymised(F.col("text").cast("string"), key))
    return made.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else made
