"""Surrogates for personal data: keyed, of the same type, script and format, distinct, the same wherever an entity is
named.  Built-in functions only.
"""

from __future__ import annotations

import itertools
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidecast.llm.common import stored, with_row
from tidecast.session import write_scratch

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
MALE, FEMALE = r"Mr|Herr|Monsieur|Señor|Sr|господин|г-н", r"Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|госпожа|г-жа"
NAME = r"\p{Lu}[\p{L}'’-]*+"
#: What follows the check digits of an IBAN, by country: digits (n), capitals (a) or either (c).
ACCOUNTS = {
    "AD": "n8c12", "AE": "n19", "AL": "n8c16", "AT": "n16", "AZ": "a4c20", "BA": "n16", "BE": "n12", "BG": "a4n6c8", "BH": "a4c14", "BR": "n23a1c1",
    "BY": "c4n4c16", "CH": "n5c12", "CR": "n18", "CY": "n8c16", "CZ": "n20", "DE": "n18", "DJ": "n23", "DK": "n14", "DO": "c4n20", "EE": "n16",
    "EG": "n25", "ES": "n20", "FI": "n14", "FK": "a2n12", "FO": "n14", "FR": "n10c11n2", "GB": "a4n14", "GE": "a2n16", "GI": "a4c15", "GL": "n14",
    "GR": "n7c16", "GT": "c24", "HN": "a4n20", "HR": "n17", "HU": "n24", "IE": "a4n14", "IL": "n19", "IQ": "a4n15", "IS": "n22", "IT": "a1n10c12",
    "JO": "a4n4c18", "KW": "a4c22", "KZ": "n3c13", "LB": "n4c20", "LC": "a4c24", "LI": "n5c12", "LT": "n16", "LU": "n3c13", "LV": "a4c13", "LY": "n21",
    "MC": "n10c11n2", "MD": "c20", "ME": "n18", "MK": "n3c10n2", "MN": "n16", "MR": "n23", "MT": "a4n5c18", "MU": "a4n19a3", "NI": "a4n20",
    "NL": "a4n10", "NO": "n11", "OM": "n3c16", "PK": "a4c16", "PL": "n24", "PS": "a4c21", "PT": "n21", "QA": "a4c21", "RO": "a4c16", "RS": "n18",
    "RU": "n14c15", "SA": "n2c18", "SC": "a4n20a3", "SD": "n14", "SE": "n20", "SI": "n15", "SK": "n20", "SM": "a1n10c12", "SO": "n19", "ST": "n21",
    "SV": "a4n20", "TL": "n19", "TN": "n20", "TR": "n6c16", "UA": "n6c19", "VA": "n18", "VG": "a4n16", "XK": "n16", "YE": "a4n4c18",
}


def _account(form: str) -> str:
    """The pattern of what follows the check digits, with a blank or none before every fourth character."""
    chars = "".join(kind * int(count) for kind, count in re.findall(r"([nac])(\d+)", form))
    fours = [re.sub(r"(.)\1*", lambda m: {"n": r"\d", "a": "[A-Z]", "c": "[A-Z0-9]"}[m[1]] + f"{{{len(m[0])}}}", chars[i:i + 4])
             for i in range(0, len(chars), 4)]
    return "".join(" ?" + four for four in fours)


_FORMS = {form: "|".join(c for c in ACCOUNTS if ACCOUNTS[c] == form) for form in dict.fromkeys(ACCOUNTS.values())}
#: IBANs of the length of their country; of others, groups that have a digit each, but for a bank code at first.
IBAN = (r"(?<![A-Z0-9])(?=[A-Z]{2}\d{2})(?:" + "|".join(rf"(?:{countries})\d{{2}}{_account(form)}(?![A-Z0-9])" for form, countries in _FORMS.items())
        + r"|[A-Z]{2}\d{2}(?: ?\d{4}| ?[A-Z0-9]{4}(?= ?[A-Z]{0,3}\d))(?: ?(?=[A-Z]{0,3}\d)[A-Z0-9]{4}){2,6}(?: ?(?=[A-Z]{0,2}\d)[A-Z0-9]{1,3})?(?![A-Z0-9]))")
#: Kinds of entities, tried in this order at every place of a text.  A run is only entered at its start, and what
#: repeats is possessive, so a long run costs its length once.
KINDS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "secret": r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,64}+(?![0-9A-Za-z])",
    "ip": rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d)",
    "card": r"(?<!\d)(?:\d{4}(?:[ -]?\d{4}){3}|3[47]\d{2}[ -]?\d{6}[ -]?\d{5})(?!\d)",
    "id": r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    "phone": r"(?<![\d+])(?:(?:\+\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)",
    "iban": IBAN,
    "person": rf"(?<![\p{{L}}\p{{N}}])(?:{MALE}|{FEMALE}|Dr|Prof)\.? {NAME}(?: {NAME}){{0,2}}",
}
EVERY = "|".join(KINDS.values())
TITLE = rf"^(?:{MALE}|{FEMALE}|Dr|Prof)\.? "

LATIN, CYRILLIC, GREEK = "abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщэюя", "αβγδεζηθικλμνξοπρστυφχψω"
#: Syllables of invented names and the endings of given names, by script.
SYLLABLES = {"latin": "ba be bo da de do fa ga ka ke ko la le lo ma me mo na ne no pa ra re ro sa se so ta te to va vo".split(),
             "cyrillic": "ба бе бо да де до га ка ко ла ле ло ма ме мо на не но па ра ре ро са се со та те то ва ве во".split(),
             "greek": "βα βε βο δα δε δο γα κα κο λα λε λο μα με μο να νε νο πα ρα ρε ρο σα σε σο τα τε το φα φε φο".split()}
ENDINGS = {"latin": ("lin", "rina", "mir"), "cyrillic": ("лин", "рина", "мир"), "greek": ("νος", "ρινα", "μις")}
#: Draws after which an address gets a longer local part, should the short ones of its domain be given away.
LONGER_AFTER = 8


def _byte(stream: Column, i) -> Column:
    """The i-th of a stream's 64 bytes, over again beyond them; the stream is 128 hex digits."""
    at = (i if isinstance(i, Column) else F.lit(i)) % 64
    return F.conv(F.substring(stream, (at * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _stream(key: str, attempt: int, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *parts, F.lit(str(attempt))), 512)


def _letter(alphabet: str, byte: Column) -> Column:
    return F.substring(F.lit(alphabet), byte % len(alphabet) + 1, F.lit(1))


def _alike(text: Column, stream: Column, kept: int = 0) -> Column:
    """Every digit and letter after the first ``kept`` replaced by one of the same class and script."""
    def one(c: Column, i: Column) -> Column:
        b = _byte(stream, i)
        return (F.when(i < kept, c).when(c.rlike(r"[0-9]"), _letter("0123456789", b)).when(c.rlike(r"\p{IsCyrillic}"), _letter(CYRILLIC, b))
                .when(c.rlike(r"\p{IsGreek}"), _letter(GREEK, b)).when(c.rlike(r"\p{L}"), _letter(LATIN, b)).otherwise(c))
    return F.array_join(F.transform(F.split(text, "(?<=.)(?=.)"), one), "")


def _name(stream: Column, script: str, count: Column, ending: Column) -> Column:
    syllables = F.array(*[F.lit(s) for s in SYLLABLES[script]])
    parts = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.element_at(syllables, _byte(stream, i) % len(SYLLABLES[script]) + 1))
    return F.concat(F.array_join(parts, ""), ending)


def _with_luhn(digits: Column) -> Column:
    """The digits with the last one as the check digit of the others."""
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    doubled = F.transform(F.split(F.reverse(body), "(?<=.)(?=.)"), lambda c, i: F.when(i % 2 == 1, c.cast("int")).otherwise(
        F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    total = F.aggregate(doubled, F.lit(0), lambda a, b: a + b)
    return F.concat(body, ((10 - total % 10) % 10).cast("string"))


def _with_mod97(iban: Column) -> Column:
    """The account with the check digits, its third and fourth characters, that make it 1 modulo 97."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 2), F.lit("00"))

    def step(rest: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), (rest * 10 + c.try_cast("int")) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)

    rest = F.aggregate(F.split(turned, "(?<=.)(?=.)"), F.lit(0), step)
    return F.concat(F.substring(iban, 1, 2), F.lpad((98 - rest).cast("string"), 2, "0"), F.substring(iban, F.lit(5), F.length(iban)))


def surrogate(kind: Column, entity: Column, key: str, attempt: int) -> Column:
    """The candidate of an attempt for an entity in its canonical form, which it is in as well."""
    stream = _stream(key, attempt, kind, entity)
    domain = F.substring_index(entity, "@", -1)
    tld = F.concat(F.lit("."), F.substring_index(domain, ".", -1))
    labels = F.substring(domain, F.lit(1), F.length(domain) - F.length(tld))
    more = F.concat(*[_letter(LATIN, _byte(stream, 63 - i)) for i in range(attempt // LONGER_AFTER)]) if attempt >= LONGER_AFTER else F.lit("")
    email = F.concat(_alike(F.substring_index(entity, "@", 1), stream), more, F.lit("@"),
                     _alike(labels, _stream(key, 0, F.lit("domain"), domain)), tld)
    octets = F.concat_ws(".", *[(_byte(stream, i) % 254 + 1).cast("string") for i in range(4)])
    script = F.when(entity.rlike(r"^\p{IsCyrillic}"), "cyrillic").when(entity.rlike(r"^\p{IsGreek}"), "greek").otherwise("latin")
    out = (F.when(kind == "email", email).when(kind == "secret", F.substring(stream, F.lit(1), F.length(entity)))
           .when(kind == "ip", octets).when(kind == "card", _with_luhn(_alike(entity, stream, kept=1))).when(kind == "phone", _alike(entity, stream, kept=1))
           .when(kind == "id", _alike(entity, stream)).when(kind == "iban", _with_mod97(F.upper(_alike(entity, stream, kept=2)))))
    for name in SYLLABLES:  # a later attempt takes longer names, so a free one is always found
        ends = dict(zip(("given m", "given f", "given n"), ENDINGS[name]))
        for what, ending in [*ends.items(), ("surname", "")]:
            out = out.when((kind == what) & (script == name), _name(stream, name, F.lit(2 + (what == "surname") + attempt // 2), F.lit(ending)))
    return out


def assign(entities: DataFrame, key: str) -> DataFrame:
    """kind, entity, surrogate: distinct over the table, and none is an entity that occurs in the texts.

    Candidates that meet another's, an earlier surrogate or an original are drawn again with the next attempt, until all
    have one; of those that meet, the first in order keeps it.  Names and addresses grow with the attempts, so their
    formats don't run out.
    """
    entities = write_scratch(entities, "entities")
    pending, done = entities, None
    originals = entities.select(F.col("kind").alias("_k"), F.col("entity").alias("_s"))
    for attempt in itertools.count():
        drawn = pending.withColumn("surrogate", surrogate(F.col("kind"), F.col("entity"), key, attempt))
        used = originals if done is None else originals.unionByName(done.select(F.col("kind").alias("_k"), F.col("surrogate").alias("_s")))
        free = drawn.join(used, (F.col("kind") == F.col("_k")) & (F.col("surrogate") == F.col("_s")), "left_anti")
        won = write_scratch(free.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity")).select("kind", "entity", "surrogate"), "surrogates")
        done = won if done is None else done.unionByName(won)
        pending = write_scratch(pending.join(won, ["kind", "entity"], "left_anti"), "pending")
        if not pending.take(1):
            return done


def mentions(rows: DataFrame) -> DataFrame:
    """_row, _i (place among the row's mentions), mention, kind; and atoms: what surrogates are given to.

    A person's atoms are given names, with the gender of the title as ``hint``, and the surname, so that a surname alone is
    the same surname; any other mention is one atom, in lower case and without punctuation, a phone in its national
    form where the country is +1.
    """
    found = rows.filter(F.size("_found") > 0).select("_row", F.posexplode("_found").alias("_i", "mention"))
    kind = reduce(lambda c, k: c.when(F.col("mention").rlike(f"^(?:{KINDS[k]})$"), k), list(KINDS)[1:],
                  F.when(F.col("mention").contains("@"), "email"))
    found = found.withColumn("kind", kind)
    gender = F.when(F.col("mention").rlike(rf"^(?:{MALE})\.? "), "m").when(F.col("mention").rlike(rf"^(?:{FEMALE})\.? "), "f")
    names = F.split(F.regexp_replace("mention", TITLE, ""), " ")
    people = F.transform(names, lambda n, i: F.struct(F.when(i == F.size(names) - 1, "surname").otherwise("given").alias("kind"), F.lower(n).alias("entity"), gender.alias("hint")))
    digits = F.regexp_replace("mention", r"[^\p{L}0-9]", "")
    canonical = F.when(F.col("kind").isin("email", "secret"), F.lower("mention")).when(F.col("kind").isin("ip", "id"), F.col("mention")).when(
        (F.col("kind") == "phone") & digits.rlike(r"^1\d{10}$") & F.col("mention").startswith("+1"), F.substring(digits, 2, 10)).otherwise(digits)
    one = F.array(F.struct(F.col("kind").alias("kind"), canonical.alias("entity"), F.lit(None).cast("string").alias("hint")))
    return found.withColumn("atoms", F.when(F.col("kind") == "person", people).otherwise(one))


def distinct_entities(found: DataFrame) -> DataFrame:
    """kind and entity of all mentions; a given name's kind is the gender of its titles, anywhere, if they agree."""
    atoms = found.select(F.explode("atoms").alias("_atom")).select("_atom.kind", "_atom.entity", "_atom.hint")
    hints = atoms.groupBy("kind", "entity").agg(F.max(F.coalesce(F.col("hint") == "m", F.lit(False))).alias("m"), F.max(F.coalesce(F.col("hint") == "f", F.lit(False))).alias("f"))
    gender = F.when(F.col("m") & ~F.col("f"), "given m").when(F.col("f") & ~F.col("m"), "given f").otherwise("given n")
    return hints.select(F.when(F.col("kind") == "given", gender).otherwise(F.col("kind")).alias("kind"), "entity")


def _formatted(mention: Column, kind: Column, given: Column) -> Column:
    """Put a surrogate into the format of a mention: its punctuation, blanks and case."""
    places = F.length(F.regexp_replace(mention, r"[^\p{L}0-9]", ""))
    given = F.when((kind == "phone") & (places == F.length(given) + 1), F.concat(F.lit("1"), given)).otherwise(given)
    chars = F.split(mention, "(?<=.)(?=.)")
    before = F.transform(chars, lambda c, i: F.length(F.regexp_replace(F.substring(mention, F.lit(1), i), r"[^\p{L}0-9]", "")))
    filled = F.array_join(F.zip_with(chars, before, lambda c, n: F.when(c.rlike(r"[\p{L}0-9]"), F.substring(given, n + 1, F.lit(1))).otherwise(c)), "")
    capitals = (mention == F.upper(mention)) & (mention != F.lower(mention))
    cased = F.array_join(F.zip_with(chars, F.split(given, "(?<=.)(?=.)"), lambda c, g: F.when(c.rlike("[A-Z]"), F.upper(g)).otherwise(g)), "")
    return (F.when(kind.isin("card", "phone", "iban"), filled).when(kind.isin("email", "secret") & capitals, F.upper(given))
            .when(kind == "secret", cased).otherwise(given))


def replacements(found: DataFrame, assigned: DataFrame) -> DataFrame:
    """_row and the array of what to put in place of its mentions, in their order."""
    atoms = found.select("_row", "_i", "mention", F.col("kind").alias("_kind"), F.posexplode("atoms").alias("_j", "_atom"))
    atoms = atoms.select("_row", "_i", "mention", "_kind", "_j", "_atom.kind", "_atom.entity")
    joined = atoms.join(assigned.withColumn("kind", F.regexp_replace("kind", "^given .$", "given")), ["kind", "entity"])
    word = F.get(F.split(F.regexp_replace("mention", TITLE, ""), " "), F.col("_j"))
    person = F.when((word == F.upper(word)) & (F.length(word) > 1), F.upper("surrogate")).otherwise(F.initcap("surrogate"))
    piece = F.when(F.col("_kind") == "person", person).otherwise(_formatted(F.col("mention"), F.col("_kind"), F.col("surrogate")))
    joined = joined.select("_row", "_i", "mention", "_kind", F.struct("_j", piece.alias("piece")).alias("_piece"))
    pieces = joined.groupBy("_row", "_i", "mention", "_kind").agg(F.sort_array(F.collect_list("_piece")).alias("_pieces"))
    title = F.when(F.col("_kind") == "person", F.regexp_extract("mention", TITLE, 0)).otherwise("")
    whole = pieces.select("_row", "_i", F.concat(title, F.array_join("_pieces.piece", " ")).alias("_new"))
    return whole.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_i", "_new"))).alias("_new")).select("_row", F.col("_new._new").alias("_new"))


def replace_entities(docs: DataFrame, key: str, counted: str | None = None) -> DataFrame:
    """``docs`` with every entity in ``text`` replaced by its surrogate; ``counted`` names a column for how many.

    All texts are searched; surrogates are given to the distinct entities of the whole table, so an entity has one
    surrogate in every document, and two never share one.  The same key gives the same surrogates for the same
    table.  Cards and accounts keep valid check digits.  A null text stays null, an empty one empty; a very long text is
    searched whole; rows are kept one for one, whatever their ids, and repeated ones get the same text; an empty table
    stays empty; other columns pass through, whatever their names.  A name without a title is not seen as a person's.
    """
    docs = stored(docs)
    found = with_row(docs, columns=["text"]).select("_row", F.regexp_extract_all("text", F.lit(EVERY), F.lit(0)).alias("_found"))
    found = write_scratch(mentions(found), "mentions")
    new = replacements(found, assign(distinct_entities(found), key)).select(F.col("_row").alias("__pii_of"), F.col("_new").alias("__pii_new"))
    joined = with_row(docs, "__pii_row").join(new, F.col("__pii_row") == F.col("__pii_of"), "left")
    between = F.split("text", EVERY, -1)
    rebuilt = F.array_join(F.transform(between, lambda p, i: F.concat(p, F.coalesce(F.get("__pii_new", i), F.lit("")))), "")
    text = F.when(F.col("__pii_new").isNotNull(), rebuilt).otherwise(F.col("text")).alias("text")
    out = [text if c == "text" else F.col(c) for c in docs.columns]
    if counted:
        out.append(F.coalesce(F.size("__pii_new"), F.lit(0)).cast("long").alias(counted))
    return joined.select(*out)
