"""PII surrogates: keyed, type-consistent replacements that keep identities apart and together.

Entities are e-mail addresses, IPv4 and IPv6 addresses, phone and social security numbers, card
numbers, secrets (IBANs, long hexadecimal strings and well-known token forms), and
names after a title, whose genitive is not a part of them.  An entity has parts with a form each (letter case and
separators aside): an address has its local part and its domain, a name its words
(so "Mr. John Smith" and "Mr. Smith" share the surname's surrogate), all others one.
All parts of one form get the same surrogate, which is coreference.  A
surrogate is drawn from a hash keyed by ``secret`` and keeps the type, the
kind and script of every character, a card's checksum, a domain's last label,
and a name's gender, which its title tells; it is written in the format
and case of the text.  Initials in names are turned by a keyed step of the alphabet.

Collision checks run over the distinct forms of the whole table: a surrogate
that another form also drew, or that is itself a form in the table, is drawn
again, round by round.  From round ``GROW`` on surrogates get longer, and in round
``LAST`` they take a long hash of the form, so a form without a letter to change ("_@-.com"),
or one whose space is used up, ends there at the latest.

The rows with entities and the table of surrogates stay in the shared folder until
``_shared.clear`` is called, once the result is written: they hold what is to be hidden.  So
does the plan, as it shows the secret.

Not found: names without a title, bare mentions of a name elsewhere in the text, digits
other than 0-9, phone numbers without separators, a plus sign or brackets, long hexadecimal strings of letters alone.  Letters of a script
that has no alphabet here become Latin ones; combining marks and signs stay.

All is DataFrame functions.  Texts are searched once to write the entities
down, and once more for the rows that have none; only rows with entities are shuffled.

Cases: a null text stays null; empty texts and texts without entities stay as
they are; rows with null ids are treated alike; repeated rows get equal
texts; a very long text is one row with all its entities; of equal draws the
form drawn earlier, then the smaller, keeps its own; other columns are not read, so their
names don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from ._shared import discard, stored

#: The rounds from which on surrogates grow, and in which they take a hash of the whole form.
GROW, LAST = 3, 8

#: Titles that tell a gender, and those that don't.
MALE_TITLES = ["Mr", "Herr", "Monsieur", "Señor", "Господин", "Κύριος"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Госпожа", "Κυρία"]
OTHER_TITLES = ["Dr", "Prof"]
#: Small words inside names, which stay.
PARTICLES = ["von", "van", "der", "den", "de", "la", "di", "da", "del", "bin", "al"]

#: Titles that are abbreviations of something else where they stand in capitals without a full stop.
DOTTED = ["MS", "DR", "PROF"]


def _capital(titles: list[str]) -> str:
    """The titles in capitals, before a word in capitals alone."""
    capitals = [t.upper() + (r"(?=\.)" if t.upper() in DOTTED else "") for t in titles]
    return rf"(?:{'|'.join(capitals)})(?=\.? (?:\p{{Lu}}\. )*\p{{Lu}}['’]?\p{{Lu}})"


_TITLES = "|".join([*MALE_TITLES, *FEMALE_TITLES, *OTHER_TITLES, _capital([*MALE_TITLES, *FEMALE_TITLES, *OTHER_TITLES])])
_TITLED = rf"^(?:(?:{_TITLES})\.? )+"
#: A word of a name begins with a capital letter, or is of a script without capitals.
#: An apostrophe in a name, but for the one of a genitive at its end.
_APOSTROPHE = r"['’](?![sS](?![\p{L}\p{M}]))\p{L}"
_WORD = rf"[\p{{Lu}}\p{{Lo}}][\p{{L}}\p{{M}}]*+(?:{_APOSTROPHE}[\p{{L}}\p{{M}}]*+)*+"
_LONG_WORD = rf"(?:\p{{Lu}}(?:[\p{{L}}\p{{M}}]|{_APOSTROPHE})(?:[\p{{L}}\p{{M}}]|{_APOSTROPHE})*+|\p{{Lo}}[\p{{Lo}}\p{{M}}]*+)"
_PARTICLE = "(?:" + "|".join(PARTICLES) + ")"
#: A name's glue: what stands before a word of it.
_GLUE = rf"(?:[ -]|{_PARTICLE} |\p{{Lu}}\. )*"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_HEX = "[0-9A-Fa-f]{1,4}"
PATTERN = "|".join([
    r"(?<![\p{L}\p{M}0-9._%+-])[\p{L}\p{M}0-9._%+-]++@[\p{L}\p{M}0-9-]+(?:\.[\p{L}\p{M}0-9-]+)*\.\p{L}{2,}",
    rf"(?<![\p{{L}}0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[0-9])",
    rf"(?<![\p{{L}}0-9:.])(?=[A-Fa-f:]*[0-9])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}})(?![\p{{L}}0-9:])",
    r"\+[0-9]{1,3}[ -]?\(?[0-9]{2,4}\)?[ -]?[0-9]{3,4}[ -]?[0-9]{3,4}(?![0-9])",
    r"\+[0-9]{1,3}(?:[ .-][0-9]{1,4}){3,6}(?![0-9])",
    r"(?<![\p{L}0-9(])\([0-9]{2,5}\) ?[0-9]{3,4}[ .-]?[0-9]{3,5}(?![0-9])",
    r"(?<![\p{L}0-9.-])(?:(?:1[ .-])?(?:[0-9]{3}-[0-9]{3}-[0-9]{4}|[0-9]{3}\.[0-9]{3}\.[0-9]{4}|[0-9]{3} [0-9]{3} [0-9]{4})|[0-9]{3}-[0-9]{2}-[0-9]{4}|0[0-9](?:[ .][0-9]{2}){4}|0[0-9]{2,4}[ /-][0-9]{6,8})(?![\p{L}0-9]|[.-][0-9])",
    r"(?<![\p{L}0-9])[0-9]{13,19}(?![\p{L}0-9])",
    r"(?<![\p{L}0-9])(?:[0-9]{4}(?:[ -][0-9]{4}){3}|3[0-9]{3}[ -][0-9]{6}[ -][0-9]{5})(?![\p{L}0-9])",
    r"(?<![\p{L}0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{4}){2,7}[A-Z0-9]{1,3}(?![\p{L}0-9])",
    r"(?<![\p{L}0-9])[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){3,7}(?: [A-Z0-9]{1,3})?(?![\p{L}0-9])",
    r"(?<![\p{L}0-9])(?=[a-fA-F]*[0-9])[0-9a-fA-F]{32,128}(?![\p{L}0-9])",
    r"(?<![\p{L}0-9])(?=[A-Za-z_-]*[0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9]{20,}|xox[abeoprs]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_-]{35}|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})(?![\p{L}0-9])",
    rf"(?<!\p{{L}})(?:(?:{_TITLES})\.? )+(?:\p{{Lu}}\. |{_PARTICLE} ){{0,3}}{_LONG_WORD}(?:(?: (?:\p{{Lu}}\. )?(?:{_PARTICLE} ){{0,2}}|-){_LONG_WORD}){{0,3}}",
])


def _letters(first: str, n: int, step: int = 1) -> str:
    return "".join(chr(ord(first) + step * k) for k in range(n))


#: Letters that stand for each script's others.
_SCRIPTS = {
    "IsCyrillic": _letters("а", 32), "IsGreek": _letters("α", 17) + _letters("σ", 7), "IsHan": "一三上中大小山川日月木水火田石竹米花草金", "IsHangul": _letters("가", 20, 28),
    "IsHiragana": _letters("か", 20), "IsKatakana": _letters("カ", 20), "IsArabic": _letters("ب", 19), "IsHebrew": _letters("א", 27), "IsDevanagari": _letters("क", 20),
    "IsBengali": _letters("ক", 20), "IsThai": _letters("ก", 20), "IsArmenian": _letters("ա", 24), "IsGeorgian": _letters("ა", 24), "IsLatin": "àáâäçèéêëìíîïñòóôöùúûü",
}
_SYLLABLES = {
    "latin": "ba be bi da de di fa ga ka la le li ma me mi na ne ni ra re ri sa se ta ti va".split(),
    "cyrillic": "ба ве ги да ди ка ле ли ма ме ми на не ни ра ре ри са та ти".split(),
    "greek": "βα γε δα θε κα λε λι μα με νι πα ρα ρε ρι σα τα τι φα".split(),
}
#: Endings of names by script and gender.
_ENDINGS = {("latin", "f"): "na", ("latin", "m"): "ron", ("latin", "n"): "el", ("cyrillic", "f"): "ина", ("cyrillic", "m"): "ов", ("cyrillic", "n"): "ко", ("greek", "f"): "ου", ("greek", "m"): "ος", ("greek", "n"): "ιδη"}
#: The script of a name that is built of syllables.
_BUILT = {"cyrillic": r"^[\p{IsCyrillic}\p{M}'’]+$", "greek": r"^[\p{IsGreek}\p{M}'’]+$", "latin": r"^[\p{IsLatin}\p{M}'’]+$"}


def entities(text: Column) -> Column:
    """All entities in order; texts that lack the signs that every entity has are not searched."""
    may = text.rlike("[0-9@]")
    for title in [*MALE_TITLES, *FEMALE_TITLES, *OTHER_TITLES]:
        may = may | text.contains(title) | text.contains(title.upper())
    return F.when(may, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _turned(text: Column, secret: str) -> Column:
    """Capital letters (initials) turned by a keyed step in their alphabet."""
    step = int(hashlib.sha256(f"{secret}|initials".encode()).hexdigest(), 16)
    alphabets = [_letters("A", 26), _letters("А", 32), _letters("Α", 17) + _letters("Σ", 7)]
    turned = [a[k:] + a[:k] for a in alphabets for k in [1 + step % (len(a) - 1)]]
    return F.translate(text, "".join(alphabets), "".join(turned))


def parts(surface: Column, secret: str) -> Column:
    """The parts of an entity: ``glue`` that stays before the piece, the ``piece``, and its form ``type|...``."""
    digits, lower = F.regexp_replace(surface, "[^0-9]", ""), F.lower(surface)
    local, domain = F.substring_index(surface, "@", 1), F.substring_index(surface, "@", -1)

    def part(glue: Column, piece: Column, form: Column) -> Column:
        return F.struct(glue.alias("glue"), piece.alias("piece"), form.alias("form"))

    title = F.regexp_extract(surface, _TITLED, 0)
    name = F.regexp_replace(surface, _TITLED, "")
    gender = F.when(title.rlike(rf"(?:^| )(?:{'|'.join([*MALE_TITLES, *(t.upper() for t in MALE_TITLES)])})[. ]"), "m").when(title.rlike(rf"(?:^| )(?:{'|'.join([*FEMALE_TITLES, *(t.upper() for t in FEMALE_TITLES)])})[. ]"), "f").otherwise("n")
    words = F.arrays_zip(F.regexp_extract_all(name, F.lit(rf"({_GLUE})({_WORD})(?!\.)"), F.lit(1)).alias("glue"), F.regexp_extract_all(name, F.lit(rf"({_GLUE})({_WORD})(?!\.)"), F.lit(2)).alias("word"))
    named = F.transform(words, lambda w, i: part(F.concat(F.when(i == 0, title).otherwise(""), _turned(w["glue"], secret)), w["word"], F.concat(F.lit("name|"), gender, F.lit("|"), F.lower(w["word"]))))

    def whole(kind: str, form: Column) -> Column:
        return F.array(part(F.lit(""), surface, F.concat(F.lit(f"{kind}|"), form)))

    return (
        F.when(surface.contains("@"), F.array(part(F.lit(""), local, F.concat(F.lit("local|"), F.lower(domain), F.lit("|"), F.lower(local))), part(F.lit("@"), domain, F.concat(F.lit("domain|"), F.lower(domain)))))
        .when(surface.rlike(_TITLED), named)
        .when(surface.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), whole("ip", surface))
        .when(surface.rlike("^[0-9A-Fa-f:]*:[0-9A-Fa-f:]*$"), whole("ipv6", lower))
        .when(surface.rlike("^[0-9 -]+$") & (F.length(digits) >= 13) & (F.length(digits) <= 19), whole("card", digits))
        .when(surface.rlike(r"^[+(0-9][0-9 ().+/-]+$") & (F.length(digits) <= 19), whole("phone", digits))
        .otherwise(whole("secret", lower))
    )


def _kind(form: Column) -> Column:
    return F.substring_index(form, "|", 1)


def _body(form: Column) -> Column:
    return F.substring_index(form, "|", -1)


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _draw(stream: Column, i: Column) -> Column:
    """The i-th number drawn from a stream of hexadecimal digits."""
    return F.conv(F.substring(stream, F.pmod(i * 3, F.lit(120)).cast("int") + 1, F.lit(5)), 16, 10).cast("long")


def _pick(choices: str, n: Column) -> Column:
    return F.substring(F.lit(choices), F.pmod(n, F.lit(len(choices))).cast("int") + 1, F.lit(1))


_LOWER = _letters("a", 26)


def _masked(body: Column, stream: Column, hexadecimal: Column | None = None) -> Column:
    """Every digit and letter replaced by one of its kind and script."""

    def one(c: Column, i: Column) -> Column:
        n = _draw(stream, i)
        out = F.when(c.rlike("[0-9]"), F.pmod(n, F.lit(10)).cast("string")).when(c.rlike("[a-z]"), _pick(_LOWER, n) if hexadecimal is None else F.when(hexadecimal, _pick("abcdef", n)).otherwise(_pick(_LOWER, n)))
        for script, choices in _SCRIPTS.items():
            out = out.when(c.rlike(rf"\p{{{script}}}"), _pick(choices, n))
        return out.when(c.rlike(r"\p{L}"), _pick(_LOWER, n)).otherwise(c)

    return F.concat_ws("", F.transform(_chars(body), one))


def surrogate(form: Column, secret: str, attempt: Column) -> Column:
    """The surrogate form drawn at the given attempt: all of the form but what follows its last "|" stays."""

    def keyed(*what: Column) -> Column:
        inner = F.sha2(F.concat_ws("|", F.lit(secret), *what), 512)
        return F.sha2(F.concat(F.lit(secret), inner), 512)

    body, kind = _body(form), _kind(form)
    stream, full = keyed(form, attempt.cast("string")), keyed(form, F.lit("full"))
    # what makes it longer: letters of the form's script (a for a form without any), or digits; at last a hash of the form
    more = F.when(attempt >= GROW, F.least(attempt, F.lit(LAST)) - GROW + 1).otherwise(0).cast("int")
    letter = F.regexp_extract(body, r"\p{L}", 0)
    sample = F.when(letter == "", "a").otherwise(letter)
    last = attempt >= LAST
    grown = F.when(last, F.translate(full, "0123456789", "ghijklmnop")).otherwise(_masked(F.repeat(sample, more), F.substring(full, F.lit(1) + attempt, F.lit(125))))
    decimal = F.concat_ws("", F.transform(_chars(F.substring(full, 1, 40)), lambda c: F.pmod(F.conv(c, 16, 10).cast("int"), F.lit(10)).cast("string")))
    digits = F.when(last, decimal).otherwise(F.substring(decimal, F.lit(1) + attempt, more))

    top = F.substring_index(body, ".", -1)
    domain = F.concat(_masked(F.substring(body, F.lit(1), F.length(body) - F.length(top) - 1), stream), grown, F.lit("."), top)
    octets = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (F.pmod(_draw(stream, i), F.lit(254)) + 1).cast("string"))
    ip = F.when(last, F.concat_ws(":", F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.substring(full, i * 4 + 1, F.lit(4))))).otherwise(F.concat_ws(".", octets))
    hexadecimal = F.lit(True)
    ipv6 = F.when(last, F.concat_ws(":", F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.substring(full, i * 4 + 1, F.lit(4))))).otherwise(_masked(body, stream, hexadecimal))
    number = _masked(body, stream)
    phone = F.concat(F.substring(body, 1, 1), F.substring(number, F.lit(2), F.length(body) - 1), digits)
    lead = F.concat((F.pmod(_draw(stream, F.lit(39)), F.lit(9)) + 1).cast("string"), F.substring(number, F.lit(2), F.length(body) - 2), digits)
    checked = F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(lead, d.cast("string"))), lambda x: F.call_function("luhn_check", x))
    card = F.when(F.call_function("luhn_check", body), checked[0]).otherwise(F.concat(lead, F.substring(number, -1, 1)))
    is_hex = body.rlike("^[0-9a-f]+$")
    token = F.concat(F.regexp_extract(body, "^(akia|gh[pousr]_|sk-|xox[abeoprs]-|aiza|eyj)?", 0), _masked(F.regexp_replace(body, "^(akia|gh[pousr]_|sk-|xox[abeoprs]-|aiza|eyj)", ""), stream), grown)
    hash_form = F.concat(_masked(body, stream, is_hex), F.when(last, full).otherwise(F.lit("")))
    gender = F.substring(form, 6, 1)

    def built(alphabet: str) -> Column:
        syllables = F.array(*map(F.lit, _SYLLABLES[alphabet]))
        chosen = F.transform(F.sequence(F.lit(0), F.lit(2) + F.least(attempt, F.lit(6))), lambda i: F.element_at(syllables, F.pmod(_draw(stream, i), F.lit(len(_SYLLABLES[alphabet]))).cast("int") + 1))
        end = F.when(gender == "f", _ENDINGS[alphabet, "f"]).when(gender == "m", _ENDINGS[alphabet, "m"]).otherwise(_ENDINGS[alphabet, "n"])
        return F.concat(F.concat_ws("", chosen), F.when(last, grown).otherwise(F.lit("")), end)

    name = F.lit(None).cast("string")
    for alphabet, pattern in _BUILT.items():
        name = F.coalesce(name, F.when(body.rlike(pattern), built(alphabet)))
    name = F.coalesce(name, F.concat(_masked(body, stream), grown))
    drawn = (
        F.when(kind == "local", F.concat(_masked(body, stream), grown)).when(kind == "domain", domain).when(kind == "ip", ip).when(kind == "ipv6", ipv6)
        .when(kind == "phone", phone).when(kind == "card", card).when(kind == "name", name).when(is_hex, hash_form).otherwise(token)
    )
    return F.concat(F.substring(form, F.lit(1), F.length(form) - F.length(body)), drawn)


def render(piece: Column, drawn: Column) -> Column:
    """The surrogate in the format and letter case of the piece; what is longer than the piece goes on behind it."""
    kind, body = _kind(drawn), _body(drawn)
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    digits = F.aggregate(
        _chars(piece), start,
        lambda acc, c: F.when(c.rlike("[0-9]"), F.struct(F.concat(acc["out"], F.substring(body, acc["at"], F.lit(1))).alias("out"), (acc["at"] + 1).alias("at"))).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["at"].alias("at"))),
        lambda acc: F.concat(acc["out"], F.substring(body, acc["at"], F.length(body))),
    )
    letters = _chars(body)
    cased = F.concat(F.concat_ws("", F.transform(_chars(piece), lambda c, i: F.when(c != F.lower(c), F.upper(F.coalesce(F.get(letters, i), F.lit("")))).otherwise(F.coalesce(F.get(letters, i), F.lit(""))))), F.substring(body, F.length(piece) + 1, F.length(body)))
    name = F.when((F.length(piece) > 1) & (piece == F.upper(piece)), F.upper(body)).otherwise(F.initcap(body))
    return F.when(kind.isin("ip", "ipv6"), body).when(kind.isin("phone", "card"), digits).when(kind == "name", name).otherwise(cased)


def mapping(forms: DataFrame, secret: str) -> DataFrame:
    """form and drawn: a surrogate for each of the distinct forms, none drawn twice and none a form itself."""
    real = stored(forms.distinct())
    now = real.withColumn("attempt", F.lit(0))
    before = None
    for attempt in range(LAST + 1):
        drawn = stored(now.withColumn("drawn", surrogate(F.col("form"), secret, F.col("attempt"))))
        if before is not None:
            discard(*before)
        owner = drawn.groupBy("drawn").agg(F.min(F.struct("attempt", "form")).alias("owner"), F.count(F.lit(1)).alias("n"))
        clash = owner.where("n > 1").join(drawn, "drawn").where("form != owner.form").select("form")
        taken = drawn.join(real.select(F.col("form").alias("drawn")), "drawn", "left_semi").select("form")
        again = stored(clash.unionAll(taken).distinct())
        if again.isEmpty():
            discard(real, again)
            return drawn.select("form", "drawn")
        following = F.when(F.col("again") == 1, attempt + 1).otherwise(F.col("attempt"))
        now = drawn.join(again.withColumn("again", F.lit(1)), "form", "left").select("form", following.alias("attempt"))
        before = drawn, again
    raise RuntimeError("two forms have the same hash of 512 bits")


def pseudonymise(docs: DataFrame, secret: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, the text with every entity replaced, and ``n_entities`` of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # two hashes: one alone would meet another row's among very many
    key = F.struct(F.xxhash64("id", "text").alias("a"), F.xxhash64("text", "id").alias("b"))
    found = stored(rows.withColumn("found", entities(F.col("text"))).where(F.size("found") > 0).withColumn("key", key))
    spots = found.select("key", F.posexplode("found").alias("pos", "surface"))
    spots = spots.select("key", "pos", F.posexplode(parts(F.col("surface"), secret)).alias("sub", "part")).select("key", "pos", "sub", "part.*")
    drawn = mapping(spots.select("form"), secret)
    written = spots.join(drawn, "form").select("key", F.struct("pos", "sub", F.concat("glue", render(F.col("piece"), F.col("drawn"))).alias("text")).alias("spot"))
    written = written.groupBy("key").agg(F.array_sort(F.collect_set("spot")).alias("new"))
    between = F.split("text", PATTERN, -1)
    # before every piece but an entity's first there is no text of the row
    glued = F.concat_ws("", F.transform("new", lambda s: F.concat(F.when(s["sub"] == 0, F.get(F.col("between"), s["pos"])).otherwise(""), s["text"])), F.element_at("between", -1))
    changed = found.join(written, "key").withColumn("between", between).select(F.col("id").alias(id_col), glued.alias(text_col), F.size("found").alias("n_entities"))
    none = rows.where(F.coalesce(F.size(entities(F.col("text"))), F.lit(0)) <= 0).select(F.col("id").alias(id_col), F.col("text").alias(text_col), F.lit(0).alias("n_entities"))
    return changed.unionAll(none)
