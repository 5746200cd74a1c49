"""PII surrogates with DataFrame functions only (operator 7).

Detected: e-mail addresses, phone numbers, payment cards (issuer, length and
check digit), IPv4 and IPv6 addresses, US social security numbers, IBANs (mod
97), access keys, secrets of 8 characters or more after ``password=``,
``token =`` and the like, up to the closing quote or white space, and names
after a title, which are then found at their other mentions in that text, too.
A surrogate is a keyed function of the entity's type and canonical form, so all
mentions of an entity, however written, get the same one in every document:

* digits, letters and separators keep their places; country codes, card
  issuers and IBAN countries stay, check digits are right again;
* names come from the same script; given names follow the title's gender (a
  neutral one after "Dr"), and a family name is one entity whoever bears it:
  "Ms Ann Lee", "Mr Lee" and "Lee" stay one family, in Russian with the ending
  that the mention has.

A card is bare or in its usual groups, and nothing is cut out of other groups
of digits: a run that has more than ``OTHER_GROUPS`` further groups of four
digits or more is a table or a list of ids, and stays as it is.  An IBAN may
stand beside other capitals; it has its country's length.

The key comes from the caller, or from the session (``KEY_SETTING``); without
one, the query draws a key for the run and forgets it.  Only digests of it
are in plans.

Collision check: over the distinct entities of the whole table, no surrogate
may stand for two entities of a type nor equal an entity of the table; those
that do draw again (next attempt) until none is left.  Drawing first from the
key alone means that only entities on a later attempt have to be looked up;
that table is empty or tiny, and joined by whatever way its size allows.

Null texts stay null, texts without entities stay as they are byte for byte;
null keys and repeated rows pass through; an empty table gives an empty one.
All other columns are kept whatever their names (they travel in a struct).
"""

from __future__ import annotations

import hashlib
import secrets

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleslake.llm.common import query, scratch, table, written

KEY_SETTING = "spark.saleslake.surrogates.key"
MAX_ATTEMPTS = 64
OTHER_GROUPS = 2

MALE = "Mr|Herr|Monsieur|Señor|Господин"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Госпожа"
NEUTRAL = "Dr|Prof|Professor|Доктор"
PARTICLE = "de|del|della|der|den|des|di|da|do|dos|du|el|la|le|al|bin|van|von|zu|ter|ten|y"
_SECRET_NAME = r"(?<![A-Za-z])(?i:password|passwd|pwd|token|secret|api_?key) ?[:=] ?[\"']?"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|\d\d?)"
# up to the closing quote or white space, without the sentence's punctuation where there is no quote; not a blank or a mask
_SECRET = r"""(?![*_.•=-]+(?:[\s"']|$))(?:(?<=")[^\s"]{8,}+|(?<=')[^\s']{8,}+|(?<!["'])[^\s"']{8,}(?<![.,;:?)\]}>]))"""
PATTERNS = {
    "secret": _SECRET_NAME + _SECRET,
    "access_key": r"(?<![A-Za-z0-9_-])(?:AKIA[0-9A-Z]{16}(?![A-Za-z0-9])|(?:gh[a-z]_|github_pat_|sk-|xox[a-z]-)[A-Za-z0-9_-]{20,}+)",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}",
    "ipv6": r"(?<![0-9A-Fa-f:.])(?=[A-Fa-f:]*\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Fa-f:])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]++(?![a-z]))++",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d(+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{4}(?!\d)|(?<!\d)\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)|(?<![\d.-])(?:1[.-])?\d{3}[.-]\d{3}[.-]\d{4}(?![\d-]|\.\d)|(?<![\d.-])(?<!\d )(?:1 )?[2-9]\d{2} [2-9]\d{2} \d{4}(?![\d-]| \d|\.\d)",
    "card": r"(?<![\d.-])(?!(?<=\b[A-Z]{2})\d\d )\d(?:[ -]?\d){12,}+",
    "person": rf"(?<!\p{{L}})(?:{MALE}|{FEMALE}|{NEUTRAL})\.? \p{{Lu}}[\p{{L}}'-]{{1,40}}(?:(?: (?:{PARTICLE}))*+ \p{{Lu}}[\p{{L}}'-]{{1,40}}){{0,3}}",
}
# what is cut out first (runs that may hold several numbers), with the kinds that go before it; then all others
IBAN_SCAN = "|".join(PATTERNS[k] for k in ("secret", "access_key", "email", "iban"))
CARD_SCAN = "|".join(PATTERNS[k] for k in ("secret", "access_key", "email", "ip", "ssn", "phone", "card"))
ANY = "|".join(p for k, p in PATTERNS.items() if k not in ("iban", "card"))
# what a text without a digit or an at sign can hold
WORDS = "|".join(PATTERNS[k] for k in ("secret", "access_key", "person"))

# a cut starts and ends at a separator: the longest one from each start, all of them (the longest first), and which are numbers
CARD_CUTS = [r"\d(?:[ -]?\d){%d}(?!\d)" % (n - 1) for n in range(19, 12, -1)]
CARD_HINT = r"\d(?:[ -]?\d){12}"
CARD_HEAD = r"(?<!\d)(?=(\d(?:[ -]?\d){12,18}(?!\d)))"
# issuers and their lengths, bare or in the groups that cards are written in
CARD_ISSUER = (r"(?=(?:4(?:\D?\d){12}(?:(?:\D?\d){3}){0,2}|5[1-5](?:\D?\d){14}|2(?:2[2-9]|[3-6]\d|7[01])\d(?:\D?\d){12}|3[47](?:\D?\d){13}"
               r"|3(?:0[0-5]|[689]\d)\d(?:\D?\d){10}|35\d\d(?:\D?\d){12,15}|6(?:011|4[4-9]\d|5\d\d|2\d\d)(?:\D?\d){12,15}|(?:50|5[6-8]|63|67)\d\d(?:\D?\d){8,15})$)")
CARD_FORM = "^" + CARD_ISSUER + r"(?:\d{12,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,4}(?:\1\d{1,3})?|\d{4}([ -])\d{6}\2\d{4,5})$"
IBAN_CUTS = [r"[A-Z0-9](?: ?[A-Z0-9]){%d}(?![A-Z0-9])" % (n - 1) for n in range(34, 11, -1)]
IBAN_HINT = r"[A-Z]{2}\d{2} ?[A-Z0-9]"
IBAN_HEAD = r"(?<![A-Z0-9])(?=([A-Z]{2}\d{2}(?: ?[A-Z0-9]){8,30}(?![A-Z0-9])))"
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN_GROUPS = r"^[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])"
IBAN_LISTED = "^(?:" + "|".join(IBAN_LENGTHS.values()).replace(" ", "|") + ")"
IBAN_FORM = "^(?:" + "|".join(r"(?:%s)(?: ?[A-Z0-9]){%d}" % (c.replace(" ", "|"), n - 2) for n, c in IBAN_LENGTHS.items()) + ")$"

GIVEN = {
    "m_latin": "Adam Bruno Carl David Emil Felix Georg Henri Ivo Jonas Karl Leon Marco Niels Oscar Paul".split(),
    "f_latin": "Anna Berta Clara Diana Emma Flora Greta Helena Ida Julia Karin Laura Maria Nora Olga Paula".split(),
    "m_cyrillic": "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Семён Тимур".split(),
    "n_latin": "Alex Andrea Chris Dana Eden Jody Jules Kim Luca Mika Noel Robin Sacha Sam Toni Val".split(),
    "n_cyrillic": "Валя Женя Паша Саша Слава Шура".split(),
    "f_cyrillic": "Анна Белла Вера Галина Дарья Елена Жанна Зоя Инна Клара Лариса Мария Нина Ольга Полина Раиса".split(),
}
SYLLABLES = {
    "latin": "bar del fen gor hal kim lan mor nel per quin ros sel tam vor wen".split(),
    "cyrillic": "бар вел гор дан зел кам лев мир нов пол род сав тур фед хар яр".split(),
}


def _matches(c: Column, kind: str) -> Column:
    return c.rlike(f"^(?:{PATTERNS[kind]})$")


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn_sum(d: Column) -> Column:
    """Sum of a digit string by Luhn's rule, the last digit counting once."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(d, i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when((F.length(d) - i) % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add)


def _mod97(iban: Column) -> Column:
    """The remainder of an IBAN (letters count 10 to 35, the first four characters come last)."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        v = F.conv(F.substring(turned, i, F.lit(1)), 36, 10).cast("int")
        return F.when(v > 9, (rest * 100 + v) % 97).otherwise((rest * 10 + v) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add)


PARTS = "array<struct<kind:string,canon:string,text:string>>"
FEMALE_ENDING = "(ов|ев|ёв|ин|ын)а$"


def _part(kind: Column, canon: Column, text: Column) -> Column:
    return F.struct(kind.alias("kind"), canon.alias("canon"), text.alias("text"))


def _mention(m: Column) -> Column:
    """Struct (m, before, parts) of a match; without parts it is not an entity."""
    digits = _digits(m)
    before = F.regexp_extract(m, f"^{_SECRET_NAME}", 0)
    secret = F.substring(m, F.length(before) + 1, F.length(m))
    words = F.split(F.regexp_replace(m, r"^\S+ ", ""), " ")
    gender = F.when(m.rlike(f"^(?:{FEMALE})\\b"), "f").when(m.rlike(f"^(?:{MALE})\\b"), "m").otherwise("n")
    script = F.when(m.rlike(r" .*\p{IsCyrillic}"), "cyrillic").otherwise("latin")

    def name(w: Column, i: Column) -> Column:
        given = _part(F.concat_ws("_", F.lit("given"), gender, script), F.lower(w), w)
        family = _part(F.concat(F.lit("family_"), script), F.regexp_replace(F.lower(w), FEMALE_ENDING, "$1"), w)
        return F.when(w.rlike(f"^(?:{PARTICLE})$"), _part(F.lit("particle"), w, w)).when(i == F.size(words) - 1, family).otherwise(given)

    one = lambda kind, canon, text: F.array(_part(F.lit(kind), canon, text))
    none = F.expr(f"cast(array() as {PARTS})")
    parts = (
        F.when(_matches(m, "secret"), one("secret", secret, secret))
        .when(_matches(m, "access_key"), one("access_key", m, m))
        .when(m.contains("@"), one("email", F.lower(m), m))
        .when(_matches(m, "person"), F.transform(words, name))
        .when(_matches(m, "ip"), one("ip", m, m))
        .when(_matches(m, "ipv6"), one("ipv6", F.lower(m), m))
        .when(_matches(m, "ssn"), one("ssn", digits, m))
        .when(_matches(m, "phone"), one("phone", F.right(digits, F.lit(10)), m))
        .otherwise(none)
    )
    title = F.regexp_extract(m, r"^\S+ ", 0)
    prefix = F.when(_matches(m, "secret"), before).when(_matches(m, "person"), title).otherwise("")
    return F.struct(m.alias("m"), prefix.alias("before"), parts.alias("parts"))


def _spans(run: Column, head: str, cuts: list[str], valid) -> Column:
    """Array of (a, b), the places of the valid numbers in a run: a is 0 for its first character, b is behind the last."""
    empty = F.expr("cast(array() as array<struct<a:int,b:int>>)")
    heads, steps = F.regexp_extract_all(run, F.lit(head), F.lit(1)), F.split(run, head, -1)

    def cut(step: Column, longest: Column) -> Column:
        all_cuts = F.array(*[F.regexp_extract(longest, f"^{c}", 0) for c in cuts])
        good = F.get(F.filter(all_cuts, lambda c: (c != "") & valid(c, longest)), F.lit(0))
        return F.struct(F.length(step).alias("step"), F.coalesce(F.length(good), F.lit(0)).alias("n"))

    # without a head at its start, the run's first step belongs to none
    tried = F.zip_with(steps, F.when(F.size(steps) > F.size(heads), F.concat(F.array(F.lit("")), heads)).otherwise(heads), cut)

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"]
        new = (x["n"] > 0) & (at >= acc["scan"])
        span = F.array(F.struct(at.alias("a"), (at + x["n"]).alias("b")))
        return F.struct(
            (at + x["step"]).alias("at"), F.when(new, at + x["n"]).otherwise(acc["scan"]).alias("scan"),
            F.when(new, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("scan"), empty.alias("spans"))
    return F.aggregate(tried, start, step, lambda acc: acc["spans"])


def _among_few(run: Column, spans: Column) -> Column:
    """``spans`` of a run of digits, or none if the run is a table or a list of ids."""
    long = lambda t: F.size(F.filter(F.split(t, "[ -]"), lambda g: F.length(g) >= 4))
    own = F.aggregate(spans, F.lit(0), lambda n, x: n + long(F.substring(run, x["a"] + 1, x["b"] - x["a"])))
    return F.when(long(run) - own <= OTHER_GROUPS, spans).otherwise(F.slice(spans, 1, 0))


def _piece(text: Column, kind: str | None) -> Column:
    return F.struct(text.alias("text"), F.lit(kind).cast("string").alias("kind"))


def _cut_out(text: Column, kind: str, scan: str, hint: str, head: str, cuts: list[str], valid) -> Column:
    """Array of (text, kind): a text's numbers of a kind, and what is between them (no kind)."""

    def run_pieces(run: Column) -> Column:
        def around(spans: Column) -> Column:
            starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["b"]))
            ends = F.concat(F.transform(spans, lambda s: s["a"]), F.array(F.length(run)))
            rests = F.zip_with(starts, ends, lambda a, b: F.array(_piece(F.substring(run, a + 1, b - a), None)))
            own = F.transform(spans, lambda s: F.array(_piece(F.substring(run, s["a"] + 1, s["b"] - s["a"]), kind)))
            return F.flatten(F.flatten(F.zip_with(rests, F.concat(own, F.array(F.expr("cast(array() as array<struct<text:string,kind:string>>)"))), lambda a, b: F.array(a, b))))

        spans = _spans(run, head, cuts, valid)
        return _once(_once(spans, lambda found: _among_few(run, found)) if kind == "card" else spans, around)

    def pieces(between: Column, m: Column) -> Column:
        return F.concat(F.array(_piece(between, None)), F.when(_matches(m, kind), run_pieces(m)).otherwise(F.array(_piece(m, None))))

    found = F.concat(F.regexp_extract_all(text, F.lit(scan), F.lit(0)), F.array(F.lit("")))
    all_pieces = F.flatten(F.zip_with(F.split(text, scan, -1), found, pieces))

    def joined(p: Column) -> Column:
        """The text between two numbers as one, so that it is scanned as one."""
        at = F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda i: F.get(p, i)["kind"].isNotNull())

        def upto(a: Column, b: Column) -> Column:
            rest = F.array_join(F.transform(F.slice(p, a + 2, b - a - 1), lambda x: x["text"]), "")
            return F.filter(F.array(_piece(rest, None), F.get(p, b)), lambda x: x.isNotNull())

        return _once(at, lambda i: F.flatten(F.zip_with(F.concat(F.array(F.lit(-1)), i), F.concat(i, F.array(F.size(p))), upto)))

    # the scan is for the few texts with something like a number of the kind
    return F.when(text.rlike(hint), _once(all_pieces, joined)).otherwise(F.array(_piece(text, None)))


def _tokens(text: Column) -> Column:
    """Array of (m, before, parts) that make up a text: entities, and without parts what is between them."""
    none = F.expr(f"cast(array() as {PARTS})")

    def plain(m: Column) -> Column:
        return F.struct(m.alias("m"), F.lit("").alias("before"), none.alias("parts"))

    def token(p: Column) -> Column:
        t = p["text"]
        canon = F.regexp_replace(t, "[ -]", "")
        number = F.struct(t.alias("m"), F.lit("").alias("before"), F.array(_part(p["kind"], canon, t)).alias("parts"))
        end = F.array(F.expr(f"cast(array() as array<struct<m:string,before:string,parts:{PARTS}>>)"))

        def scanned(pattern: str) -> Column:
            """Most texts have no entity: they are searched once."""
            found = F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), lambda m: F.array(_mention(m)))
            between = F.transform(F.split(t, pattern, -1), plain)
            both = F.flatten(F.zip_with(between, F.concat(found, end), lambda a, b: F.concat(F.array(a), b)))
            return F.when(t.rlike(pattern), both).otherwise(F.array(plain(t)))

        return F.when(p["kind"].isNotNull(), F.array(number)).when(t.rlike("[0-9@]"), scanned(ANY)).otherwise(scanned(WORDS))

    def cards(p: Column) -> Column:
        own = _cut_out(p["text"], "card", CARD_SCAN, CARD_HINT, CARD_HEAD, CARD_CUTS, lambda c, _: c.rlike(CARD_FORM) & (_luhn_sum(_digits(c)) % 10 == 0))
        return F.when(p["kind"].isNotNull(), F.array(p)).otherwise(own)

    def iban(c: Column, longest: Column) -> Column:
        # of a country that is not listed, the longest cut in groups of four
        length = F.when(c.rlike(IBAN_LISTED), c.rlike(IBAN_FORM)).otherwise(c == F.regexp_extract(longest, IBAN_GROUPS, 0))
        return length & (_mod97(F.regexp_replace(c, " ", "")) == 1)

    ibans = _cut_out(text, "iban", IBAN_SCAN, IBAN_HINT, IBAN_HEAD, IBAN_CUTS, iban)
    return F.flatten(F.transform(F.flatten(F.transform(ibans, cards)), token))


def _other_mentions(found: Column) -> Column:
    """``found`` (tokens of a text) with the names of its persons found between the entities, too."""
    names = F.filter(F.flatten(F.transform(found, lambda f: f["parts"])), lambda p: (p["kind"].startswith("given_") | p["kind"].startswith("family_")) & (F.length(p["text"]) > 2))

    def search(names: Column) -> Column:
        # letters, apostrophes and hyphens only: nothing to escape; the longest name first
        texts = F.reverse(F.array_sort(F.array_distinct(F.transform(names, lambda p: F.struct(F.length(p["text"]).alias("n"), p["text"].alias("t"))))))
        return F.concat(F.lit(r"(?<![\p{L}'-])(?:"), F.array_join(F.transform(texts, lambda x: x["t"]), "|"), F.lit(r")(?![\p{L}-])"))

    def retold(names: Column) -> Column:
        def token(f: Column, pattern: Column) -> Column:
            plain = lambda t: F.struct(t.alias("m"), F.lit("").alias("before"), F.slice(f["parts"], 1, 0).alias("parts"))
            again = lambda t: F.struct(t.alias("m"), F.lit("").alias("before"), F.slice(F.filter(names, lambda p: p["text"] == t), 1, 1).alias("parts"))
            hits = F.concat(F.transform(F.regexp_extract_all(f["m"], pattern, F.lit(0)), lambda t: F.array(again(t))), F.array(F.slice(F.array(f), 1, 0)))
            between = F.transform(F.split(f["m"], pattern, -1), plain)
            return F.when((F.size(f["parts"]) == 0) & F.rlike(f["m"], pattern), F.flatten(F.zip_with(between, hits, lambda a, b: F.concat(F.array(a), b)))).otherwise(F.array(f))

        return _once(search(names), lambda pattern: F.flatten(F.transform(found, lambda f: token(f, pattern))))

    return _once(names, lambda n: F.when(F.size(n) > 0, retold(n)).otherwise(found))


def _keys(key: str) -> tuple[str, str]:
    """Inner and outer key of the keyed digest; the caller's key itself stays out of the plan."""
    if not key:
        raise ValueError("surrogates need a key")
    return tuple(hashlib.sha256(f"{side}|{key}".encode()).hexdigest() for side in ("inner", "outer"))


def _digest(key: str, message: Column) -> Column:
    """A keyed digest of 128 hexadecimal digits: a digest of a digest, each with a key of its own."""
    inner, outer = _keys(key)
    return F.sha2(F.concat(F.lit(outer), F.sha2(F.concat(F.lit(inner), message), 512)), 512)


def surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The surrogate of an entity on its attempt-th draw."""
    seed = _digest(key, F.concat_ws("|", kind, attempt.cast("string"), canon))
    stream = F.concat(F.sha2(F.concat(F.lit("0"), seed), 512), F.sha2(F.concat(F.lit("1"), seed), 512))
    # a lambda variable, so that the digests are computed once for an entity and not once for each character
    return F.when(kind == "secret", _secret(seed, canon)).otherwise(_once(stream, lambda h: _from_stream(h, kind, canon, attempt)))


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, 2 * i + 1, F.lit(2)), 16, 10).cast("int")


def _like(c: Column, byte: Column) -> Column:
    return (
        F.when(c.rlike("[0-9]"), F.char(48 + byte % 10))
        .when(c.rlike("[A-Z]"), F.char(65 + byte % 26))
        .when(c.rlike(r"\p{L}"), F.char(97 + byte % 26))
        .otherwise(c)
    )


def _secret(seed: Column, canon: Column) -> Column:
    """A secret of any length, with a digest of its own for every 64 characters.

    Hexadecimal digits also stand for a value with few letters and digits,
    whose shape would leave too little to draw from.
    """
    chunks = F.regexp_extract_all(canon, F.lit("(?s).{1,64}"), F.lit(0))
    as_hex = canon.rlike("^[0-9a-f]+$") | (F.length(F.regexp_replace(canon, r"[^\p{L}0-9]", "")) < 8)

    def shape(c: Column, h: Column) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: _like(F.substring(c, i, F.lit(1)), _byte(h, i - 1))), "")

    def drawn(hexed: Column) -> Column:
        def chunk(c: Column, i: Column) -> Column:
            return _once(F.sha2(F.concat(i.cast("string"), seed), 512), lambda h: F.when(hexed, F.substring(h, F.lit(1), F.length(c))).otherwise(shape(c, h)))

        return F.array_join(F.transform(chunks, chunk), "")

    return _once(as_hex, drawn)


def _from_stream(stream: Column, kind: Column, canon: Column, attempt: Column) -> Column:
    """The surrogate that 256 hexadecimal digits give."""

    def byte(i: Column) -> Column:
        return _byte(stream, F.pmod(i, F.lit(128)))

    def shape(text: Column) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: _like(F.substring(text, i, F.lit(1)), byte(i))), "")

    def several(values: Column, n: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), n), lambda i: F.element_at(values, byte(i) % F.size(values) + 1))

    literals = lambda values: F.array(*map(F.lit, values))
    given = F.lit(None)
    for who, names in GIVEN.items():
        given = F.when(kind == f"given_{who}", literals(names)).otherwise(given)
    cyrillic = kind.endswith("_cyrillic")
    key_head = r"^(?:AKIA|gh[a-z]_|github_pat_|sk-|xox[a-z]-)"
    syllables = F.when(cyrillic, literals(SYLLABLES["cyrillic"])).otherwise(literals(SYLLABLES["latin"]))
    ending = F.when(cyrillic, "ов").otherwise("")
    given = F.array_join(several(given, 1 + F.floor(attempt / 2).cast("int")), "-")
    family = F.concat(F.initcap(F.array_join(several(syllables, 3 + F.floor(attempt / 4).cast("int")), "")), ending)

    digits = shape(F.regexp_replace(canon, "[0-9]", "0"))
    host = F.concat(F.array_join(F.transform(F.sequence(F.lit(60), F.lit(65)), lambda i: F.char(97 + byte(i) % 26)), ""), F.lit(".example.net"))
    body = F.concat(F.substring(canon, 1, 1), F.substring(digits, F.lit(2), F.length(canon) - 2))
    card = F.concat(body, (F.lit(10) - _luhn_sum(F.concat(body, F.lit("0"))) % 10).cast("int") % 10)
    account = shape(F.substring(canon, F.lit(5), F.length(canon)))
    country = F.substring(canon, 1, 2)
    iban = F.concat(country, F.lpad((98 - _mod97(F.concat(country, F.lit("00"), account))).cast("string"), 2, "0"), account)
    out = (
        F.when(kind == "email", F.concat(shape(F.substring_index(canon, "@", 1)), F.lit("@"), host))
        .when(kind == "ip", F.concat_ws(".", 1 + byte(F.lit(1)) % 223, byte(F.lit(2)), byte(F.lit(3)), 1 + byte(F.lit(4)) % 254))
        .when(kind == "phone", F.concat((2 + byte(F.lit(100)) % 8).cast("string"), F.substring(digits, F.lit(2), F.length(canon))))
        .when(kind == "ssn", F.concat(F.lit("9"), F.substring(digits, 2, 8)))
        .when(kind == "card", card)
        .when(kind == "iban", iban)
        .when(kind == "access_key", F.concat(F.regexp_extract(canon, key_head, 0), shape(F.regexp_replace(canon, key_head, ""))))
        .when(kind == "ipv6", F.concat(F.lit("2001:db8"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.concat(F.lit(":"), F.substring(stream, 4 * i + 1, F.lit(4)))), "")))
        .when(kind == "particle", canon)
    )
    out = out.when(kind.startswith("given_"), given).when(kind.startswith("family_"), family)
    return out.otherwise(shape(canon))


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used (a lambda variable)."""
    return F.transform(F.array(value), use)[0]


def _as_written(part: Column, new: Column) -> Column:
    """The surrogate in the mention's format: its digits and letters at the places of the mention's.

    A phone number longer than its ten canonical digits keeps those before them.
    """
    text = part["text"]
    digits = _digits(text)
    code = F.when(part["kind"] == "phone", F.substring(digits, F.lit(1), F.length(digits) - F.length(part["canon"]))).otherwise("")

    def filled(full: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            c = F.substring(text, i, F.lit(1))
            own = c.rlike("[0-9A-Z]")
            return F.struct(
                F.concat(acc["out"], F.when(own, F.substring(full, acc["n"] + 1, F.lit(1))).otherwise(c)).alias("out"),
                (acc["n"] + own.cast("int")).alias("n"),
            )

        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))
        return F.aggregate(F.sequence(F.lit(1), F.length(text)), start, step, lambda acc: acc["out"])

    spaced = part["kind"].isin("ssn", "card", "iban", "phone")
    # a Russian family name has the ending of the mention
    ending = F.when((part["kind"] == "family_cyrillic") & F.lower(text).rlike(FEMALE_ENDING), "а").otherwise("")
    return _once(F.concat(code, new, ending), lambda full: F.when(spaced, filled(full)).otherwise(full))


def _drawn(entities: DataFrame, key: str) -> DataFrame:
    """kind, canon, attempt of entities that need a later attempt than the first."""
    spark = entities.sparkSession
    found = written(entities, scratch(spark, "pii-entities"))
    state = found.withColumn("attempt", F.lit(0))
    # the collision is judged on what is written: phone numbers by their last ten digits, names by lower case
    real = found.select("kind", F.col("canon").alias("new"), F.lit(True).alias("real"))
    for _ in range(MAX_ATTEMPTS):
        state = state.withColumn("new", F.lower(surrogate(F.col("kind"), F.col("canon"), F.col("attempt"), key)))
        state = state.withColumn("first", F.row_number().over(Window.partitionBy("kind", "new").orderBy("attempt", "canon")) == 1)
        state = state.join(real.withColumn("new", F.lower("new")).distinct(), ["kind", "new"], "left")
        clash = ~F.col("first") | F.coalesce("real", F.lit(False))
        state = written(state.select("kind", "canon", (F.col("attempt") + clash.cast("int")).alias("attempt"), clash.alias("again")), scratch(spark, "pii-draw"))
        if state.filter("again").isEmpty():
            return state.filter("attempt > 0").select("kind", "canon", "attempt")
        state = state.drop("again")
    raise RuntimeError(f"surrogates still collide after {MAX_ATTEMPTS} attempts")


def surrogates(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``df`` with its text column rewritten, and ``n_entities`` (replaced mentions) in a column of its own struct.

    Returns (row, n_entities): ``row`` holds all columns of ``df``.
    """
    spark = df.sparkSession
    body = F.col("row")[text]
    base = df.select(F.monotonically_increasing_id().alias("uid"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    base = base.withColumn("found", _once(_tokens(body), _other_mentions))
    # a text is kept once: in its row where it has no entities, else as tokens
    n = F.size(F.filter("found", lambda f: F.size(f["parts"]) > 0))
    base = base.withColumn("n", F.when(body.isNull(), 0).otherwise(n))
    base = written(base.select("uid", F.when(F.col("n") == 0, F.col("row")).otherwise(F.col("row").withField(text, F.lit(None).cast("string"))).alias("row"), F.when(F.col("n") > 0, F.col("found")).alias("found"), "n"), scratch(spark, "pii-documents"))
    parts = base.select("uid", F.explode(F.flatten("found.parts")).alias("p")).select("uid", "p.kind", "p.canon")
    later = _drawn(parts.where("kind <> 'particle'").select("kind", "canon").distinct(), key)
    name = F.concat_ws(":", "kind", "canon")
    by_doc = parts.distinct().join(later, ["kind", "canon"]).groupBy("uid").agg(F.map_from_entries(F.collect_list(F.struct(name, "attempt"))).alias("attempts"))
    by_doc = written(by_doc, scratch(spark, "pii-attempts"))
    rows = base.join(by_doc, "uid", "left")

    def render(f: Column) -> Column:
        def one(p: Column) -> Column:
            attempt = F.coalesce(F.try_element_at("attempts", F.concat_ws(":", p["kind"], p["canon"])), F.lit(0))
            return _as_written(p, surrogate(p["kind"], p["canon"], attempt, key))

        return F.when(F.size(f["parts"]) == 0, f["m"]).otherwise(F.concat(f["before"], F.array_join(F.transform(f["parts"], one), " ")))

    new = F.when(F.col("n") > 0, F.array_join(F.transform("found", render), "")).otherwise(body)
    return rows.select(F.col("row").withField(text, new).alias("row"), F.col("n").alias("n_entities"))


def session_key(spark: SparkSession) -> str:
    """The session's key; without one, a key for this run alone."""
    return spark.conf.get(KEY_SETTING, None) or spark.sparkContext.getConf().get(KEY_SETTING, None) or secrets.token_hex(32)


@query("op7_pii_surrogates")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = surrogates(table(spark, sf_dir, "documents"), session_key(spark))
    return done.select("row.doc_id", "row.text", "n_entities")
