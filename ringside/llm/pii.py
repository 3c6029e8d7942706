"""Operator 4: format-preserving Feistel pseudonyms for personal values.

Values are found by pattern, validated, and replaced by the result of a keyed
Feistel permutation over their own format: digits stay digits, letters stay
letters of the same case, punctuation stays where it is, a card number keeps a
right check digit, a date stays a date, an address octet stays below 256. The
permutation depends on the key and the kind alone, so equal values get equal
pseudonyms in every document and different values get different ones.

DataFrame functions only. A text without any digit or @ holds none of the
values and is passed through without a search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringside.llm.common import fresh, table, whole_text

_EMAIL = r"[A-Za-z0-9](?:[A-Za-z0-9._%+\-]{0,63})@[A-Za-z0-9](?:[A-Za-z0-9\-]{0,62})(?:\.[A-Za-z0-9\-]{1,63})*\.[A-Za-z]{2,24}"
_DATE = r"(?<![\w.\-/])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\w\-/]|\.\d)"
_SSN = r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])"
_IP = r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d)"
_END = r"(?!\w|[.\-]\d)"
_NATIONAL = r"\d{3}[.\- ]\d{3}[.\- ]\d{4}" + _END
#: What a run of digit groups stops at, and a phone number besides at a card.
_OTHERS = f"(?:{_EMAIL}|{_DATE}|{_SSN}|{_IP})"
_CARD_SHAPE = r"(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){3}|\d{4}[ \-]\d{6}[ \-]\d{4,5})(?!\d)"
_STOP, _GROUP = f"(?!{_OTHERS}|{_NATIONAL})", r"\d++(?!\w|\.\d)"

#: The pattern of each kind, tried in this order at each place of a text. A card's is a whole run of digit
#: groups with 13 digits or more, in which _cards() looks for numbers; a phone number has a country code and 8 to 15
#: digits in any grouping, or the national form of 3, 3 and 4.
PATTERNS = {
    "email": _EMAIL,
    "date": _DATE,
    "ssn": _SSN,
    "ip": _IP,
    "card": rf"(?<![\w.\-])(?!{_NATIONAL})(?=(?:\d(?:[ \-]{_STOP})?+){{12}}\d){_GROUP}(?:[ \-]{_STOP}{_GROUP})*+",
    "phone": rf"(?<![\w.+])(?:\+1[ .\-]?(?:\(\d{{3}}\)|\d{{3}})[ .\-]?\d{{3}}[ .\-]?\d{{4}}"
             rf"|\+\d(?:\)?(?:[ .\-](?!{_OTHERS}))?\(?\d){{7}}(?:\)?(?:[ .\-](?!{_OTHERS}|{_CARD_SHAPE}(?![ \-]\d{{4}}(?!\d))))?\(?\d){{0,7}}"
             rf"|\(\d{{3}}\) ?\d{{3}}[.\- ]\d{{4}}|\d{{3}}[.\- ]\d{{3}}[.\- ]\d{{4}}){_END}",
}
KINDS = list(PATTERNS)
ANY = "|".join(PATTERNS.values())
#: How a date can be written, by its shape.
DATE_FORMS = {r"\d{4}-\d{2}-\d{2}": "yyyy-MM-dd", r"\d{4}/\d{2}/\d{2}": "yyyy/MM/dd",
              r"\d{2}\.\d{2}\.\d{4}": "dd.MM.yyyy", r"\d{2}/\d{2}/\d{4}": "MM/dd/yyyy"}
#: Days are counted from FIRST_DAY. Dates from it on for 271 x 270 days (into May 2100) are permuted among themselves, and
#: so are those before it, from 0001-01-01 on, and those after, to 9999-12-31: (first day, radices), latest first.
FIRST_DAY, DATE_RADICES = "1900-01-01", (271, 270)
DATE_SPANS = [(73_170, (538, 5_363)), (0, DATE_RADICES), (-693_595, (245, 2_831))]
ROUNDS = 10
DEFAULT_KEY = "ringside-pseudonyms"


def _bind(column: Column, use) -> Column:
    """use(column), with the column worked out once however often use names it."""
    return F.element_at(F.transform(F.array(column), use), 1)


def _shift(key: str, kind: str, values: Column, radices: Column, other: Column, turn: Column) -> Column:
    """values + F(other) in each place, modulo that place's radix."""

    def one(v, i, seen):
        mixed = F.sha2(F.concat_ws("|", seen, i.cast("string")), 256)
        return F.pmod(v + F.conv(F.substring(mixed, 1, 12), 16, 10).cast("bigint"), F.element_at(radices, i + 1))

    seen = F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), F.array_join(other.cast("array<string>"), ","))
    return _bind(seen, lambda s: F.transform(values, lambda v, i: one(v, i, s)))


def feistel(values: Column, radices: Column, key: str, kind: str, rounds: int = ROUNDS) -> Column:
    """Permute an array of numbers, each below its radix, among all such arrays (same length and radices)."""
    return _bind(F.struct(values.alias("v"), radices.alias("r")), lambda x: _rounds(x["v"], x["r"], key, kind, rounds))


def _rounds(values: Column, radices: Column, key: str, kind: str, rounds: int) -> Column:
    half = (F.size(values) / 2).cast("int")
    left, right = F.slice(values, 1, half), F.slice(values, half + 1, F.size(values))
    left_r, right_r = F.slice(radices, 1, half), F.slice(radices, half + 1, F.size(radices))

    def turn(state, i):
        a, b = state["a"], state["b"]
        odd = i % 2 == 1
        return F.struct(F.when(odd, a).otherwise(_shift(key, kind, a, left_r, b, i)).alias("a"),
                        F.when(odd, _shift(key, kind, b, right_r, a, i)).otherwise(b).alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.struct(left.alias("a"), right.alias("b")), turn,
                       lambda done: F.concat(done["a"], done["b"]))


def _characters(value: Column) -> Column:
    return F.split(value, "(?!^)(?!$)")


def _longs(column: Column) -> Column:
    return column.cast("array<bigint>")


def _letters_and_digits(value: Column, key: str, kind: str) -> Column:
    """Permute all ASCII letters (keeping case) and digits; the rest stays in place."""
    chars = _characters(value)
    slot = lambda c: c.rlike("^[A-Za-z0-9]$")
    number = lambda c: F.when(c.rlike("[0-9]"), c.cast("string").cast("bigint")).otherwise(F.ascii(F.lower(c)) - 97)
    radix = lambda c: F.when(c.rlike("[0-9]"), 10).otherwise(26)

    def put(state, c, moved):
        v = F.element_at(moved, state["n"] + 1)
        new = F.when(c.rlike("[0-9]"), v.cast("string")).when(c.rlike("[a-z]"), F.char(v + 97)).otherwise(F.char(v + 65))
        return F.struct(F.when(slot(c), state["n"] + 1).otherwise(state["n"]).alias("n"),
                        F.concat(state["out"], F.when(slot(c), new).otherwise(c)).alias("out"))

    moved = _bind(F.filter(chars, slot), lambda s: feistel(
        _longs(F.transform(s, number)), _longs(F.transform(s, radix)), key, kind))
    start = F.struct(F.lit(0).alias("n"), F.lit("").alias("out"))
    return _bind(moved, lambda m: F.aggregate(chars, start, lambda s, c: put(s, c, m))["out"])


def _fill(shape: Column, digits: Column) -> Column:
    """Put the digits, in order, where the shape has digits."""
    return _bind(digits, lambda d: _filled(shape, d))


def _filled(shape: Column, digits: Column) -> Column:
    return F.aggregate(
        _characters(shape), F.struct(F.lit(0).alias("n"), F.lit("").alias("out")),
        lambda s, c: F.struct(F.when(c.rlike("[0-9]"), s["n"] + 1).otherwise(s["n"]).alias("n"),
                              F.concat(s["out"], F.when(c.rlike("[0-9]"), F.substring(digits, s["n"] + 1, F.lit(1)))
                                       .otherwise(c)).alias("out")))["out"]


def _digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _permuted_digits(digits: Column, key: str, kind: str) -> Column:
    return F.array_join(feistel(_longs(_characters(digits)), F.array_repeat(F.lit(10).cast("bigint"), F.length(digits)),
                                key, kind), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a payload: the last digit counts double, then every second one."""
    back = F.reverse(_longs(_characters(digits)))
    doubled = F.transform(back, lambda d, i: F.when(i % 2 == 0, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(doubled, F.lit(0).cast("bigint"), lambda a, d: a + d)


def _check_digit(payload: Column) -> Column:
    return F.pmod(-_luhn_sum(payload), F.lit(10)).cast("string")


def _card(value: Column, key: str) -> Column:
    moved = _bind(_digits_of(value), lambda d: _permuted_digits(F.substring(d, F.lit(1), F.length(d) - 1), key, "card"))
    return _fill(value, _bind(moved, lambda m: F.concat(m, _check_digit(m))))


def _card_is_valid(value: Column) -> Column:
    digits = _digits_of(value)
    return (_check_digit(F.substring(digits, F.lit(1), F.length(digits) - 1)) == F.right(digits, F.lit(1))) \
        & digits.rlike("[1-9]")


def _cards(run: Column, key: str) -> Column:
    """(value, hits): the run of digit groups with its card numbers replaced, and those found, in order.

    A number may begin and end at any group. Of numbers that overlap one counts:
    that in a usual grouping, then the longest, then the first; digits that only
    the others have are permuted too, so no valid number stays.
    """
    def windows(groups):
        def one(i, j):
            s = F.array_join(F.slice(groups, i, j - i + 1), "")
            usual = s.rlike(rf"^[ \-]?{_CARD_SHAPE}$")
            return F.struct((~usual).alias("unusual"), (-F.length(_digits_of(s))).alias("size"), i.alias("i"), j.alias("j"), s.alias("s"))

        return F.array_sort(F.flatten(F.transform(F.sequence(F.lit(1), F.size(groups)), lambda i: F.filter(
            F.transform(F.sequence(i, F.least(i + 18, F.size(groups))), lambda j: one(i, j)),
            lambda w: w["size"].between(-19, -13) & _card_is_valid(w["s"])))))

    def chosen(found):
        none = F.filter(found, lambda w: F.lit(False))
        return F.aggregate(found, none, lambda taken, w: F.when(
            F.exists(taken, lambda c: (c["i"] <= w["j"]) & (w["i"] <= c["j"])), taken).otherwise(F.concat(taken, F.array(w))))

    def replaced(groups, found, taken):
        new = F.transform(taken, lambda c: F.struct(c["i"].alias("i"), c["j"].alias("j"), _card(c["s"], key).alias("new")))

        def put(cards, group, x):
            inside = F.filter(cards, lambda c: (c["i"] <= x + 1) & (c["j"] >= x + 1))
            shared = F.exists(found, lambda w: (w["i"] <= x + 1) & (w["j"] >= x + 1))
            return _bind(inside, lambda c: F.when(F.size(c) > 0, F.when(c[0]["i"] == x + 1, c[0]["new"]).otherwise(""))
                         .when(shared, _fill(group, _permuted_digits(_digits_of(group), key, "card"))).otherwise(group))

        def made(cards):
            hits = F.transform(F.array_sort(cards), lambda c: F.struct(
                F.lit("card").alias("kind"), F.regexp_replace(c["new"], r"^[ \-]", "").alias("value")))
            return F.struct(F.array_join(F.transform(groups, lambda g, x: put(cards, g, x)), "").alias("value"), hits.alias("hits"))

        return _bind(new, made)

    groups = F.regexp_extract_all(run, F.lit(r"[ \-]?\d+"), F.lit(0))
    return _bind(groups, lambda g: _bind(windows(g), lambda w: _bind(chosen(w), lambda c: replaced(g, w, c))))


def _phone(value: Column, key: str) -> Column:
    """The country code stays; all other digits are permuted."""
    code = F.regexp_extract(value, r"^(\+1(?!\d)|\+\d{1,3}(?=[ .\-(])|)", 1)
    rest = F.substring(value, F.length(code) + 1, F.length(value))
    return F.concat(code, _fill(rest, _permuted_digits(_digits_of(rest), key, "phone")))


def _email(value: Column, key: str) -> Column:
    """Everything before the last label (the top-level domain) is permuted."""
    top = F.regexp_extract(value, r"(\.[A-Za-z]+)$", 1)
    return F.concat(_letters_and_digits(F.substring(value, F.lit(1), F.length(value) - F.length(top)), key, "email"), top)


def _octets(value: Column) -> Column:
    return _longs(F.split(value, r"\."))


def _ip(value: Column, key: str) -> Column:
    octets = _octets(value)
    return F.array_join(feistel(octets, F.array_repeat(F.lit(256).cast("bigint"), F.lit(4)), key, "ip"), ".")


def _day(value: Column) -> Column:
    day = F.lit(None).cast("date")
    for shape, form in DATE_FORMS.items():
        day = F.when(value.rlike(f"^{shape}$"), F.try_to_timestamp(value, F.lit(form)).cast("date")).otherwise(day)
    return F.datediff(day, F.lit(FIRST_DAY).cast("date"))


def _date(value: Column, key: str) -> Column:
    def of_span(n, pick):
        out = F.lit(pick(*DATE_SPANS[-1]))
        for first, radices in reversed(DATE_SPANS[:-1]):
            out = F.when(n >= first, pick(first, radices)).otherwise(out)
        return out

    def moved_day(n):
        start, a, b = of_span(n, lambda f, r: f), of_span(n, lambda f, r: r[0]), of_span(n, lambda f, r: r[1])
        at = n - start
        new = feistel(_longs(F.array((at / b).cast("int"), at % b)), _longs(F.array(a, b)), key, "date")
        return _bind(new, lambda m: start + m[0] * b + m[1])

    def written(day):
        out = value
        for shape, form in DATE_FORMS.items():
            out = F.when(value.rlike(f"^{shape}$"), F.date_format(day, form)).otherwise(out)
        return out

    return _bind(F.date_add(F.lit(FIRST_DAY).cast("date"), _bind(_day(value), moved_day).cast("int")), written)


def _kind(value: Column) -> Column:
    """The kind of a match, null where validation fails."""
    return _bind(_day(value), lambda day: _kind_by(value, day))


def _kind_by(value: Column, day: Column) -> Column:
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike(f"^(?:{'|'.join(DATE_FORMS)})$"),
              F.when(day >= DATE_SPANS[-1][0], "date"))
        .when(value.rlike(r"^\d{3}-\d{2}-\d{4}$"),
              F.when(~value.rlike(r"^(?:000|666|9\d\d)|-00-|-0000$"), "ssn"))
        .when(value.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"),
              F.when(F.forall(F.split(value, r"\."), lambda o: ~o.rlike("^0[0-9]") & (o.cast("int") <= 255)), "ip"))
        .when(value.rlike(r"^\d++(?:[ \-]\d++)*+$") & ~value.rlike(f"^{_NATIONAL}$"), "card")
        .otherwise("phone")
    )


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """Of any kind but card (see _cards); the value itself where kind is null."""
    return (F.when(kind == "email", _email(value, key)).when(kind == "date", _date(value, key))
            .when(kind == "ssn", _fill(value, _permuted_digits(_digits_of(value), key, "ssn")))
            .when(kind == "ip", _ip(value, key))
            .when(kind == "phone", _phone(value, key)).otherwise(value))


def pseudonymise(docs: DataFrame, key: str = DEFAULT_KEY, text: str = "text", found: str | None = None) -> DataFrame:
    """Replace personal values in a text column.

    All columns and rows stay, extra ones included. A null text stays null, an
    empty one empty; repeated rows get equal results. found names one more
    column: an array of (kind, pseudonym) in the order of the text. Values
    that fail validation (a wrong check digit, 31 February, an octet of 300)
    stay as they are.
    """
    names = set(docs.columns)
    if text not in names:
        raise ValueError(f"no column {text}")
    seen, kinds, new_values = fresh(docs, "_pii_seen", "_pii_kinds", "_pii_new")
    t = F.col(f"`{text}`")
    values = F.when(t.rlike("[0-9@]"), F.regexp_extract_all(t, F.lit(ANY), F.lit(0)))
    worked = docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.struct(values.alias("v")).alias(seen))
    marked = F.transform(F.col(f"{seen}.v"), lambda v: F.struct(v.alias("v"), _kind(v).alias("kind")))
    worked = worked.withColumn(kinds, marked)
    hit = "array<struct<kind:string,value:string>>"

    def one(m):
        other = _bind(pseudonym(m["v"], m["kind"], key), lambda new: F.struct(new.alias("value"), F.when(m["kind"].isNotNull(), F.array(
            F.struct(m["kind"].alias("kind"), new.alias("value")))).otherwise(F.array().cast(hit)).alias("hits")))
        return F.when(m["kind"] == "card", _cards(m["v"], key)).otherwise(other)

    renamed = F.transform(F.col(kinds), one)
    hits = F.size(f"{seen}.v") > 0
    worked = worked.withColumn(new_values, F.when(hits, renamed))
    # a text is its pieces between the matches, with the matches between them
    joined = F.array_join(F.flatten(F.zip_with(
        F.split(t, ANY, -1), F.col(new_values),
        lambda piece, new: F.array(piece, F.coalesce(new["value"], F.lit(""))))), "")
    kept = F.when(hits, joined).otherwise(t)
    out = [kept.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    if found:
        if found in names:
            raise ValueError(f"there is a column {found} already")
        out.append(F.coalesce(F.flatten(F.transform(F.col(new_values), lambda m: m["hits"])), F.array().cast(hit)).alias(found))
    return worked.select(*out)


def op4(spark, sf_dir):
    """Every document with its pseudonymised text and the number of values of each kind."""
    docs = table(spark, sf_dir, "documents").select("doc_id", whole_text().alias("text"))
    out = pseudonymise(docs, found="found")
    of_kind = lambda kind: F.size(F.filter("found", lambda m: m["kind"] == kind))
    counts = [of_kind(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS]
    return out.select("doc_id", "text", *counts, F.col("found.value").alias("pseudonyms"))


QUERIES = {"op4_pii_pseudonyms": op4}
