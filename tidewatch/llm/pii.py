"""Format-preserving pseudonyms by keyed Feistel permutations (operator 6), in DataFrame functions only.

Card numbers (Luhn), North American phone numbers, social security numbers, IPv4 addresses and dates are found in passes,
each over what the ones before left, and validated: e-mail addresses, secrets and IP addresses; cards of a usual layout and
issuer, or that are a whole run of digit groups; dates, phone and social security numbers; cards that are any other part of
a run of digit groups. So a value is found beside whatever digits. The value of each is permuted within its own range (an unbalanced Feistel network over a x b, whose
rounds add a keyed digest modulo a or b), so the result is valid again, keeps its layout, and equal values stay equal in
all documents, however they are written. E-mail addresses and secrets (access keys, tokens, passwords) have no such range;
they become keyed digests, equal for equal values. The key is a parameter; whoever has it can invert the permutations.

Defined results: a null text stays null, an empty one empty, both without findings; numbers that fail validation stay;
an empty table gives no row; repeated rows get equal results; columns of any name pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import bind, unused

KINDS = ["email", "secret", "ip", "date", "phone", "ssn", "card"]

#: Patterns; those looked for at once are in order of precedence at one place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "secret": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])|(?<![A-Za-z0-9])(?i:password|passwd|token|secret|api_key)\s?[=:]\s?[\"']?[A-Za-z0-9_+/-]{8,}+[\"']?",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])",
    "date": r"(?<![0-9A-Za-z])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z]|-[0-9]{2}-[0-9]{2}(?![0-9A-Za-z]))",
    "ssn": r"(?<![0-9A-Za-z]|[0-9A-Za-z]-)[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9A-Za-z])",
}
#: A run of digit groups that is long enough for a card number, and the layouts (groups with a blank between) of known issuers.
RUN = r"(?<![0-9A-Za-z])(?=[0-9](?:[ -]?[0-9]){12})[0-9]++(?![A-Za-z])(?:[ -][0-9]++(?![A-Za-z]))*+"
USUAL_CARD = (
    r"^(?:(?:4[0-9]{3}|5[1-5][0-9]{2}|2[2-7][0-9]{2}|6[0245][0-9]{2}|35[0-9]{2})( ?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{3})?"
    r"|3[47][0-9]{2}( ?)[0-9]{6}\2[0-9]{5}|3[068][0-9]{2}( ?)[0-9]{6}\3[0-9]{4}|4[0-9]{12})$")
#: A card number has 13 to 19 digits, so it ends at most this many groups after its first.
MOST_GROUPS = 19
PIECES = "array<struct<text:string,kind:string>>"
ROUNDS = 8
POWERS = [10**k for k in range(11)]
#: Dates from here on are numbered; the range is two rectangles, 250 x 292 days and the 49 days to the end of 2099.
FIRST_DAY, DAYS, REST = "1900-01-01", (250, 292), (7, 7)


def keyed(value: Column, purpose: str, key: str) -> Column:
    """256 bits of keyed digest as lower-case hex digits."""
    return F.sha2(F.concat(F.lit(f"{key}|{purpose}|"), value.cast("string")).cast("binary"), 256)


def permuted(x: Column, a: Column, b: Column, purpose: str, key: str) -> Column:
    """A keyed permutation of 0 .. a*b - 1: left (below a) and right (below b) take turns to be moved by the other."""
    def shift(value: Column, round_no: int, modulus: Column) -> Column:
        return F.conv(F.substring(keyed(value, f"{purpose}|{round_no}", key), 1, 12), 16, 10).cast("long") % modulus

    state = F.struct(_div(x, b).alias("l"), (x % b).alias("r"))
    def move_left(i: int):
        return lambda s: F.struct(((s["l"] + shift(s["r"], i, a)) % a).alias("l"), s["r"].alias("r"))

    def move_right(i: int):
        return lambda s: F.struct(s["l"].alias("l"), ((s["r"] + shift(s["l"], i, b)) % b).alias("r"))

    for i in range(0, ROUNDS, 2):
        state = bind(bind(state, move_left(i)), move_right(i + 1))
    return bind(state, lambda s: s["l"] * b + s["r"])


def _div(x: Column, y: Column) -> Column:
    """Whole division of longs, exact beyond 2**53."""
    return F.call_function("div", x, y)


def _fill(layout: Column, digits: Column) -> Column:
    """``layout`` with its digits replaced, in order, by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def step(s: Column, c: Column) -> Column:
        digit = c.rlike("^[0-9]$")
        return F.struct(F.concat(s["out"], F.when(digit, F.substring(digits, s["k"], F.lit(1))).otherwise(c)).alias("out"), (s["k"] + digit.cast("int")).alias("k"))

    return F.aggregate(F.split(layout, ""), start, step, lambda s: s["out"])


def _luhn(d: Column) -> Column:
    return F.call_function("luhn_check", d)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _padded(x: Column, width) -> Column:
    return F.lpad(x.cast("string"), width, "0")


def _card(m: Column, key: str) -> Column:
    """All digits but the last are permuted; the last makes the number valid again."""
    def of(d: Column) -> Column:
        body = F.length(d) - 1
        powers = F.array(*[F.lit(p).cast("long") for p in POWERS])
        half = _div(body, F.lit(2)).cast("int")
        new = permuted(F.substring(d, F.lit(1), body).cast("long"), F.get(powers, half), F.get(powers, body - half), "card", key)

        def checked(n: Column) -> Column:
            text = _padded(n, body)
            tries = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda c: F.concat(text, c.cast("string")))
            return F.get(F.filter(tries, _luhn), F.lit(0))

        return F.when(_luhn(d), _fill(m, bind(new, checked)))

    return bind(_digits(m), of)


def _phone(m: Column, key: str) -> Column:
    """The ten national digits are permuted; a leading country code stays. The pattern's layout is the validation."""
    def of(d: Column) -> Column:
        half = F.lit(100_000).cast("long")
        new = permuted(F.substring(d, -10, 10).cast("long"), half, half, "phone", key)
        return _fill(m, F.concat(F.substring(d, F.lit(1), F.length(d) - 10), _padded(new, 10)))

    return bind(_digits(m), of)


def _ssn(m: Column, key: str) -> Column:
    """Area 001-899 but 666, group 01-99, serial 0001-9999."""
    area, group, serial = (F.split_part(m, F.lit("-"), F.lit(i)).cast("long") for i in (1, 2, 3))
    ok = (area >= 1) & (area <= 899) & (area != 666) & (group >= 1) & (serial >= 1)
    place = area - 1 - (area > 666).cast("long")
    new = permuted(place * 989_901 + (group - 1) * 9_999 + serial - 1, F.lit(898).cast("long"), F.lit(989_901).cast("long"), "ssn", key)

    def text(n: Column) -> Column:
        a, r = _div(n, F.lit(989_901)), n % 989_901
        return F.concat_ws("-", _padded(a + 1 + (a >= 665).cast("long"), 3), _padded(_div(r, F.lit(9_999)) + 1, 2), _padded(r % 9_999 + 1, 4))

    return F.when(ok, bind(new, text))


def _ip(m: Column, key: str) -> Column:
    def of(o: Column) -> Column:
        value = F.aggregate(o, F.lit(0).cast("long"), lambda n, x: n * 256 + x)
        new = permuted(value, F.lit(65536).cast("long"), F.lit(65536).cast("long"), "ip", key)
        text = bind(new, lambda n: F.concat_ws(".", *[(_div(n, F.lit(256**k)) % 256).cast("string") for k in (3, 2, 1, 0)]))
        return F.when(F.array_max(o) <= 255, text)

    return bind(F.transform(F.split(m, r"\."), lambda x: x.cast("long")), of)


def _date(m: Column, key: str) -> Column:
    """Year-month-day, day.month.year or month/day/year, back in the same order."""
    iso = (
        F.when(F.substring(m, 5, 1) == "-", m)
        .when(F.substring(m, 3, 1) == ".", F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2)))
        .otherwise(F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 1, 2), F.substring(m, 4, 2)))
    )

    def of(n: Column) -> Column:
        whole = DAYS[0] * DAYS[1]
        day = F.when(n < whole, permuted(n, *[F.lit(x).cast("long") for x in DAYS], "date", key)).otherwise(whole + permuted(n - whole, *[F.lit(x).cast("long") for x in REST], "late-date", key))
        pattern = F.when(F.substring(m, 5, 1) == "-", "yyyy-MM-dd").when(F.substring(m, 3, 1) == ".", "dd.MM.yyyy").otherwise("MM/dd/yyyy")

        def text(d: Column) -> Column:
            y = d.cast("string")
            year, month, dom = F.substring(y, 1, 4), F.substring(y, 6, 2), F.substring(y, 9, 2)
            return F.when(pattern == "yyyy-MM-dd", y).when(pattern == "dd.MM.yyyy", F.concat_ws(".", dom, month, year)).otherwise(F.concat_ws("/", month, dom, year))

        return F.when((n >= 0) & (n < whole + REST[0] * REST[1]), bind(F.date_add(F.lit(FIRST_DAY).cast("date"), day.cast("int")), text))

    return bind(F.datediff(F.try_to_date(iso, "yyyy-MM-dd"), F.lit(FIRST_DAY).cast("date")).cast("long"), of)


def _email(m: Column, key: str) -> Column:
    return F.concat(F.lit("user-"), F.substring(keyed(F.lower(m), "email", key), 1, 16), F.lit("@example.invalid"))


def _secret(m: Column, key: str) -> Column:
    """The name and quotes stay; the value becomes a digest. A name before it makes no difference to equal values."""
    value = F.regexp_extract(m, "^(?:[A-Za-z_]+\\s?[=:]\\s?[\"']?)?([A-Za-z0-9_+/-]+)[\"']?$", 1)
    return F.concat(F.regexp_extract(m, "^((?:[A-Za-z_]+\\s?[=:]\\s?[\"']?)?)", 1), F.lit("redacted-"), F.substring(keyed(value, "secret", key), 1, 16), F.regexp_extract(m, "([\"']?)$", 1))


_MAKERS = {"email": _email, "secret": _secret, "ip": _ip, "date": _date, "phone": _phone, "ssn": _ssn, "card": _card}


def _piece(text: Column, kind: Column | None = None) -> Column:
    return F.struct(text.alias("text"), (F.lit(None).cast("string") if kind is None else kind).alias("kind"))


def _cut(pieces: Column, pattern: str, of) -> Column:
    """``pieces`` with those of no kind cut at the matches of ``pattern``; ``of`` gives the pieces of a match."""
    def each(p: Column) -> Column:
        text = p["text"]
        parts = F.zip_with(
            F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
            lambda s, m: F.concat(F.array(_piece(s)), F.when(m.isNotNull(), of(m)).otherwise(F.array().cast(PIECES))))
        return F.when(p["kind"].isNull() & text.rlike(pattern), F.flatten(parts)).otherwise(F.array(p))

    return bind(F.flatten(F.transform(pieces, each)), lambda cut: F.when(F.size(cut) > 1, _joined(cut)).otherwise(cut))


def _joined(pieces: Column) -> Column:
    """``pieces`` with neighbours of no kind made one, so that the next pass sees what really stands beside a value.

    By places: each stretch between two values is sliced out and joined once, so the work grows with the text alone.
    """
    places = F.filter(F.transform(pieces, lambda p, i: F.when(p["kind"].isNotNull(), i)), lambda i: i.isNotNull())

    def of(k: Column) -> Column:
        def stretch(j: Column) -> Column:
            start = F.when(j == 0, F.lit(0)).otherwise(F.get(k, j - 1) + 1)
            end = F.coalesce(F.get(k, j), F.size(pieces))
            rest = _piece(F.array_join(F.transform(F.slice(pieces, start + 1, end - start), lambda p: p["text"]), ""))
            return F.when(F.get(k, j).isNotNull(), F.array(rest, F.get(pieces, F.get(k, j)))).otherwise(F.array(rest))

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(k)), stretch))

    return bind(places, of)


def _kinds(*kinds: str):
    """Pattern and pieces of a match, for kinds in order of precedence at one place."""
    def of(m: Column) -> Column:
        return F.array(_piece(m, reduce(lambda rest, k: F.when(m.rlike(f"^(?:{PATTERNS[k]})$"), k).otherwise(rest), reversed(kinds), F.lit(None).cast("string"))))

    return "|".join(PATTERNS[k] for k in kinds), of


#: A group of a run that begins a card number is marked with a letter for its number of groups, any other with an x.
LETTERS = "ABCDEFGHIJKLMNOPQRS"
MARKED_CARD = "|".join(f"{c}[0-9]++(?:[ -][A-Sx][0-9]++){{{n}}}" for n, c in enumerate(LETTERS))


def _cards(run: Column, usual: bool) -> Column:
    """Pieces of a run of digit groups: the leftmost, then longest, valid card numbers of whole groups, and what is left.

    If ``usual``, only those of a usual layout, or that are the whole run. Each group is marked with the length of the card
    number that could begin there; a pattern over the marked run then takes them from the left.
    """
    def groups_at(g: Column, i: Column) -> Column:
        """How many groups the longest card number has that begins at group ``i``; null if there is none."""
        def tried(n: Column) -> Column:
            def of(text: Column) -> Column:
                plain = F.replace(text, F.lit(" "), F.lit(""))
                fits = F.when(F.length(plain).between(13, 19), _luhn(plain))
                return F.when(fits & (text.rlike(USUAL_CARD) | ((i == 0) & (n == F.size(g))) if usual else F.lit(True)), n)

            return bind(F.array_join(F.slice(g, i + 1, n), " "), of)

        lengths = F.sequence(F.least(F.lit(MOST_GROUPS), F.size(g) - i), F.lit(1), F.lit(-1))
        return F.get(F.filter(F.transform(lengths, tried), lambda n: n.isNotNull()), F.lit(0))

    def marked(g: Column) -> Column:
        marks = F.transform(g, lambda x, i: bind(groups_at(g, i), lambda n: F.concat(F.when(n.isNull(), F.lit("x")).otherwise(F.substring(F.lit(LETTERS), n, F.lit(1))), x)))
        return F.array_join(F.zip_with(marks, F.regexp_extract_all(run, F.lit("[ -]"), F.lit(0)), lambda m, sep: F.concat(m, F.coalesce(sep, F.lit("")))), "")

    def unmarked(text: Column) -> Column:
        return F.regexp_replace(text, "[A-Sx]", "")

    def cut(text: Column) -> Column:
        return F.flatten(F.zip_with(
            F.split(text, MARKED_CARD, -1), F.regexp_extract_all(text, F.lit(MARKED_CARD), F.lit(0)),
            lambda s, m: F.concat(F.array(_piece(unmarked(s))), F.when(m.isNotNull(), F.array(_piece(unmarked(m), F.lit("card")))).otherwise(F.array().cast(PIECES)))))

    return bind(bind(F.split(run, "[ -]"), marked), cut)


def found_pieces(text: Column) -> Column:
    """``text`` in pieces: private values with their kind, and what is between them."""
    pieces = F.array(_piece(text))
    pieces = _cut(pieces, *_kinds("email", "secret", "ip"))
    pieces = _cut(pieces, RUN, lambda m: _cards(m, True))
    pieces = _cut(pieces, *_kinds("date", "phone", "ssn"))
    return _cut(pieces, RUN, lambda m: _cards(m, False))


def replacement(m: Column, kind: Column, key: str) -> Column:
    """The match's pseudonym; null where it is no valid value."""
    return reduce(lambda rest, k: F.when(kind == k, _MAKERS[k](m, key)).otherwise(rest), reversed(KINDS), F.lit(None).cast("string"))


def pseudonymised(docs: DataFrame, result: str, key: str) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and a struct ``result`` that counts them by kind. ``key`` is the deployment's
    secret: there is no default."""
    text = F.col("text").cast("string")
    private = F.when(text.rlike("[0-9@]|(?i:password|passwd|token|secret|api_key)\\s?[=:]"), found_pieces(text))
    found, made = unused(docs, "matches"), unused(docs, "made")
    rows = docs.withColumn(found, private)
    rows = rows.withColumn(made, F.transform(F.col(found), lambda p: F.when(p["kind"].isNotNull(), replacement(p["text"], p["kind"], key))))
    kinds = F.coalesce(F.filter(F.zip_with(found, made, lambda p, m: F.when(m.isNotNull(), p["kind"])), lambda k: k.isNotNull()), F.array().cast("array<string>"))
    counts = F.struct(*[(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(kind) for kind in KINDS])
    out = F.coalesce(F.array_join(F.zip_with(found, made, lambda p, m: F.coalesce(m, p["text"])), ""), text)
    columns = [out.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return rows.select(*columns, counts.alias(result))
