"""PII surrogates: detected entities get keyed replacements of their own kind.

Entities are found by patterns: mail addresses, phone numbers, IPv4 addresses, card numbers, social security numbers, IBANs,
secrets (hexadecimal, or by the prefix of a key), and persons (a title or a known given name, more given names, initials and
particles, then a surname). A surname found that way is replaced wherever it stands alone in the same text. A replacement
follows from a key, the kind, the normal form of the entity and an attempt, so the same entity is replaced alike everywhere,
however it is written:

* digits become digits, letters letters of the same case, punctuation stays where it is; a phone number keeps the first
  digit after its plus sign, a card number its first digit and a valid check digit, an IBAN its country, a mail address
  its last label, and mail addresses of one domain stay in one domain;
* a given name becomes another of the same gender and script, one to one; a surname becomes a made-up one of its script;
  titles stay, so "Frau Weber" and "Anna Weber" stay one family.

Collisions are checked over the distinct entities of all documents: two entities with one replacement, and a replacement
that is an entity itself, are drawn again with the next attempt until none is left (from the eighth on, one digit longer).
Without the key nobody can tell which replacement belongs to whom.

Everything is SQL functions. Documents are not shuffled but for those redrawn attempts, which travel by document key.

Defined results: a NULL text stays NULL and has no entities; texts without entities stay as they are to the last character;
repeated rows get equal results; an empty table gives no rows; other columns are not touched.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key, stored, whole_row

# Titles, and given names by script and gender.
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Señor Señora Don Doña Sr Sra Господин Госпожа".split()
GIVEN = (
    "Anna Maria Laura Julia Sophie Claire Emma Alice Elena Lucia Carmen Martha Helen Sarah Linda Monika Ursula Isabelle Jennifer "
    "Jessica Karen Nancy Lisa Susan Emily Olivia Hannah Katharina Sabine Petra Marie Camille Chantal Pilar Ana Isabel".split(),
    "John Peter Paul Thomas Michael David Robert Carlos Miguel Javier Pierre Jean Louis Hans Klaus Stefan James William Kevin "
    "Brian Steven Joseph Daniel Matthew Andrew Richard Charles George Jürgen Wolfgang Matthias Luis Antonio Philippe François".split(),
    "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана".split(),
    "Иван Пётр Сергей Алексей Дмитрий Андрей Николай Михаил".split(),
)
# Parts of made-up surnames.
LATIN = "ba be bo da de do fa fe fi ga ge go ha he hi ka ke ko la le lo ma me mo na ne no ra re ro sa se".split()
CYRILLIC = "ба бе бо да де до га ге го ка ке ко ла ле ло ма ме мо на не но па пе по ра ре ро са се та те то".split()

# Particles before a surname.
PARTICLES = "van von de der den del della di da la le dos das du ter zu bin".split()

_NAME = r"(?:\p{Lu}['’])?\p{Lu}\p{Ll}+(?:\p{Lu}\p{Ll}+)?(?:-\p{Lu}\p{Ll}+)*"
_INITIAL = r"\p{Lu}\."
_ANY_GIVEN = "|".join(name for names in GIVEN for name in names)
_ANY_TITLE = "|".join(TITLES)
_SURNAME = rf"(?:(?:{'|'.join(PARTICLES)}) ){{0,3}}{_NAME}"
#: A word that may be a surname on its own.
BARE_NAME = rf"(?<![\p{{L}}\p{{N}}_]){_NAME}(?![\p{{L}}\p{{N}}_])"

#: One pattern for all entities. A match starts and ends at the edge of a word.
ENTITY = (
    r"(?<![\p{L}\p{N}_])(?:"
    r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
    r"|[0-9a-f]{32,64}|[0-9A-F]{32,64}"
    r"|[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?"
    r"|(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?!\.?\d)"
    r"|\d{3}-\d{2}-\d{4}"
    r"|\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,4}"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}"
    r"|\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}"
    r"|AKIA[0-9A-Z]{16}|sk-[A-Za-z0-9]{20,64}"
    rf"|(?:(?:{_ANY_TITLE})\.? )+(?:(?:{_NAME}|{_INITIAL}) ){{0,2}}{_SURNAME}"
    rf"|(?:{_ANY_GIVEN}) (?:(?:{_ANY_GIVEN}|{_INITIAL}) ){{0,3}}{_SURNAME}"
    r")(?![\p{L}\p{N}_])"
)


def kind_of(entity: Column) -> Column:
    return (
        F.when(entity.contains("@"), "mail")
        .when(entity.rlike(r"^(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})$"), "secret")
        .when(entity.rlike(r"^(?:AKIA[0-9A-Z]{16}|sk-[A-Za-z0-9]{20,64})$"), "token")
        .when(entity.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), "ip")
        .when(entity.rlike(r"^[A-Z]{2}\d{2}"), "iban")
        .when(entity.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(entity.rlike(r"^[+(]|^\d{3}[.-]\d{3}[.-]"), "phone")
        .when(entity.rlike(r"^\d"), "card")
        .otherwise("person")
    )


def _normal(entity: Column, kind: Column) -> Column:
    """The form that all spellings of an entity share; of persons, the surname."""
    return (
        F.when(kind.isin("mail", "domain", "secret"), F.lower(entity))
        .when(kind == "person", F.substring_index(entity, " ", -1))
        .when(kind.isin("ip", "token"), entity)
        .otherwise(F.regexp_replace(entity, r"[^0-9A-Z+]", ""))
    )


def named(value: Column, f) -> Column:
    """``f(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _stream(key: str, kind: Column, normal: Column, attempt: Column) -> Column:
    """64 keyed bytes as hexadecimal text."""
    seed = F.concat_ws("|", F.lit(key), kind, normal, attempt.cast("string"))
    return F.concat(F.sha2(F.concat(seed, F.lit("|0")), 256), F.sha2(F.concat(seed, F.lit("|1")), 256))


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substr(stream, (2 * (i % 64) + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _substituted(entity: Column, stream: Column, keep: Column) -> Column:
    """Each letter and digit after the first ``keep`` replaced by one of its class."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("i"))

    def put(at, c):
        b = _byte(stream, at.i)
        letter = F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), b % 26 + 1, F.lit(1))
        new = (
            F.when(at.i < keep, c).when(c.rlike("[0-9]"), (b % 10).cast("string"))
            .when(c.rlike("[a-z]"), letter).otherwise(F.upper(letter))
        )
        return F.when(
            c.rlike("[A-Za-z0-9]"), F.struct(F.concat(at.out, new).alias("out"), (at.i + 1).alias("i"))
        ).otherwise(F.struct(F.concat(at.out, c).alias("out"), at.i.alias("i")))

    return F.aggregate(F.split(entity, ""), start, put, lambda at: at.out)


def _luhn(digits: Column) -> Column:
    """Luhn sum, the last digit counted once."""
    return F.aggregate(
        F.transform(
            F.split(F.reverse(digits), ""),
            lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))),
        ),
        F.lit(0),
        lambda a, x: a + x,
    )


def _card(entity: Column, stream: Column) -> Column:
    """Same layout; a number with a valid check digit gets another one."""
    valid = _luhn(F.regexp_replace(entity, r"\D", "")) % 10 == 0

    def checked(new: Column) -> Column:
        head = F.substr(new, F.lit(1), F.length(new) - 1)
        sum_ = _luhn(F.concat(F.regexp_replace(head, r"\D", ""), F.lit("0")))
        return F.when(valid, F.concat(head, F.pmod(-sum_, F.lit(10)).cast("string"))).otherwise(new)

    return named(_substituted(entity, stream, F.lit(1)), checked)


def _made(name: Column, stream: Column, parts: int) -> Column:
    """A made-up name of the script of ``name``."""

    def put(of: list[str]) -> Column:
        table = F.array(*[F.lit(p) for p in of])
        return F.initcap(F.concat(*[F.element_at(table, _byte(stream, F.lit(i)) % len(of) + 1) for i in range(parts)]))

    return F.when(name.rlike(r"\p{IsCyrillic}"), put(CYRILLIC)).otherwise(put(LATIN))


def _surname(name: Column, stream: Column) -> Column:
    russian = F.when(name.endswith("а"), F.lit("ва")).otherwise(F.lit("в"))
    ending = F.when(name.rlike(r"\p{IsCyrillic}"), russian).otherwise(F.lit("n"))
    return F.concat(_made(name, stream, 4), ending)


def _iban(entity: Column, stream: Column) -> Column:
    """Same country and layout; a number with valid check digits gets valid ones."""

    def rest(number: Column) -> Column:
        bare = F.regexp_replace(number, " ", "")
        turned = F.concat(F.substr(bare, F.lit(5)), F.substr(bare, F.lit(1), F.lit(4)))
        value = lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
        return F.aggregate(
            F.transform(F.filter(F.split(turned, ""), lambda c: c != ""), value),
            F.lit(0),
            lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97,
        )

    def checked(new: Column) -> Column:
        def put(digits: str | Column) -> Column:
            return F.concat(F.substr(new, F.lit(1), F.lit(2)), digits, F.substr(new, F.lit(5)))

        return F.when(rest(entity) == 1, put(F.lpad((98 - rest(put(F.lit("00")))).cast("string"), 2, "0"))).otherwise(new)

    return named(_substituted(entity, stream, F.lit(2)), checked)


def _ssn(entity: Column, stream: Column) -> Column:
    """A number whose area, group and serial are given out."""

    def shaped(new: Column) -> Column:
        area, group, serial = [F.substr(new, F.lit(i), F.lit(n)).cast("int") for i, n in ((1, 3), (5, 2), (8, 4))]
        area = area % 899 + 1
        area = F.when(area == 666, 899).otherwise(area)
        return F.format_string("%03d-%02d-%04d", area, group % 99 + 1, serial % 9999 + 1)

    return named(_substituted(entity, stream, F.lit(0)), shaped)


def _given(token: Column, key: str) -> Column:
    """The replacement of a word before the surname.

    A known given name becomes the next of its list in an order that follows from the key. Titles and particles stay.
    """
    to = {}
    for names in GIVEN:
        order = sorted(names, key=lambda name: hashlib.sha256(f"{key}|{name}".encode()).digest())
        to |= {name: order[(i + 1) % len(order)] for i, name in enumerate(order)}
    table = F.create_map(*[F.lit(x) for pair in to.items() for x in pair])
    stays = F.regexp_replace(token, r"\.$", "").isin(TITLES) | token.rlike(r"^\p{Ll}")

    def other(stream: Column) -> Column:
        letters = F.when(token.rlike(r"\p{IsCyrillic}"), F.lit("АБВГДЕИКЛМНОПРСТ")).otherwise(F.lit("ABCDEFGHIJKLMNOP"))
        initial = F.concat(F.substr(letters, _byte(stream, F.lit(0)) % 16 + 1, F.lit(1)), F.lit("."))
        return F.when(token.endswith("."), initial).otherwise(_made(token, stream, 3))

    unknown = named(_stream(key, F.lit("given"), token, F.lit(0)), other)
    return F.when(stays, token).otherwise(F.coalesce(F.try_element_at(table, token), unknown))


def _site(domain: Column, attempt: Column, key: str) -> Column:
    """Another domain with the same last label."""
    last = F.regexp_extract(domain, r"(\.[A-Za-z]+)$", 1)
    inner = F.substr(domain, F.lit(1), F.length(domain) - F.length(last))
    more = F.when(attempt >= 8, (attempt - 8).cast("string")).otherwise("")
    return F.concat(_substituted(inner, _stream(key, F.lit("domain"), F.lower(domain), attempt), F.lit(0)), more, last)


def replacement(entity: Column, kind: Column, attempt: Column, key: str, of_domain: Column | None = None) -> Column:
    """The surrogate of one written form of an entity; ``of_domain`` is the attempt of the domain of a mail address."""
    of_domain = F.lit(0) if of_domain is None else of_domain

    def made(stream: Column) -> Column:
        local, domain = F.substring_index(entity, "@", 1), F.substring_index(entity, "@", -1)
        more = F.when(attempt >= 8, (attempt - 8).cast("string")).otherwise("")
        hexes = F.when(entity.rlike("[A-F]"), F.upper(stream)).otherwise(stream)
        first = F.array_join(F.transform(F.slice(F.split(entity, " "), 1, F.size(F.split(entity, " ")) - 1), lambda t: _given(t, key)), " ")
        surname = _surname(F.substring_index(entity, " ", -1), stream)
        return (
            F.when(kind == "mail", F.concat(_substituted(local, stream, F.lit(0)), more, F.lit("@"), _site(domain, of_domain, key)))
            .when(kind == "domain", _site(entity, attempt, key))
            .when(kind == "secret", F.concat(F.substr(hexes, F.lit(1), F.length(entity)), more))
            .when(kind == "ip", F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_byte(stream, i) % 254 + 1).cast("string")), "."))
            .when(kind == "card", _card(entity, stream))
            .when(kind == "iban", _iban(entity, stream))
            .when(kind == "ssn", _ssn(F.regexp_replace(entity, r"^(\d{3})(\d{2})(\d{4})$", "$1-$2-$3"), stream))
            .when(kind == "person", F.concat_ws(" ", F.nullif(first, F.lit("")), F.concat(surname, F.translate(more, "0123456789", "abcdefghij"))))
            .when(kind == "token", F.concat(_substituted(entity, stream, F.when(entity.startswith("sk-"), 2).otherwise(4)), more))
            .otherwise(F.concat(_substituted(entity, stream, F.when(entity.startswith("+"), 1).otherwise(0)), more))
        )

    return named(_stream(key, kind, _normal(entity, kind), attempt), made)


def _found(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(ENTITY), F.lit(0))


def _named_entities(texts: DataFrame, *keys: str) -> DataFrame:
    """(keys, kind, normal) of all texts, domains of mail addresses included; a frequent entity is one row per task before
    the shuffle."""
    each = texts.select(*keys, F.explode(_found(F.col("text"))).alias("entity")).withColumn("kind", kind_of(F.col("entity")))
    whole = F.struct("kind", _normal(F.col("entity"), F.col("kind")).alias("normal"))
    domain = F.struct(F.lit("domain").alias("kind"), F.lower(F.substring_index("entity", "@", -1)).alias("normal"))
    both = F.when(F.col("kind") == "mail", F.array(whole, domain)).otherwise(F.array(whole))
    return each.select(*keys, F.inline(both)).distinct()


def distinct_entities(texts: DataFrame) -> DataFrame:
    """(kind, normal) of all texts."""
    return _named_entities(texts)


def redrawn_entities(entities: DataFrame, key: str) -> DataFrame | None:
    """(kind, normal, attempt) of the entities whose first replacement collides; None if there are none."""
    redrawn = None
    while True:
        drawn = entities.withColumn("attempt", F.lit(0)) if redrawn is None else entities.join(
            redrawn, ["kind", "normal"], "left"
        ).withColumn("attempt", F.coalesce("attempt", F.lit(0)))
        made = drawn.withColumn("new", replacement(F.col("normal"), F.col("kind"), F.col("attempt"), key))
        made = stored(made.withColumn("new", _normal(F.col("new"), F.col("kind"))), "surrogates")
        shared = made.groupBy("kind", "new").agg(F.count("*").alias("n"), F.min(F.struct("attempt", "normal")).alias("first"))
        losers = made.join(shared.where("n > 1"), ["kind", "new"]).where("normal <> first.normal").select("kind", "normal", "attempt")
        real = entities.select("kind", F.col("normal").alias("new"))
        losers = losers.unionByName(made.join(real, ["kind", "new"], "left_semi").select("kind", "normal", "attempt")).distinct()
        again = stored(losers.withColumn("attempt", F.col("attempt") + 1), "redrawn")
        if again.isEmpty():
            return redrawn
        rest = [] if redrawn is None else [redrawn.join(again, ["kind", "normal"], "left_anti").select("kind", "normal", "attempt")]
        redrawn = again
        for old in rest:
            redrawn = stored(redrawn.unionByName(old), "redrawn")


def with_surrogates(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """doc (all columns, as struct), text with surrogates and n_entities."""
    parts = docs.select(whole_row(docs).alias("doc"), docs[text].alias("text"))
    entities = stored(distinct_entities(parts.select("text")), "entities")
    redrawn = redrawn_entities(entities, key)
    if redrawn is None:
        known = parts.withColumn("attempts", F.lit(None).cast("map<string,int>"))
    else:
        keyed = parts.select("text", *row_key(F.col("text")))
        used = _named_entities(keyed, "k1", "k2")
        maps = used.join(redrawn, ["kind", "normal"]).groupBy("k1", "k2").agg(
            F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "kind", "normal"), "attempt"))).alias("attempts")
        )
        known = parts.select("*", *row_key(F.col("text"))).join(maps, ["k1", "k2"], "left").drop("k1", "k2")
    cut = known.withColumn("found", _found(F.col("text"))).withColumn(
        "between", F.when(F.size("found") > 0, F.split("text", ENTITY, -1))
    )

    def attempt_of(kind: Column, normal: Column) -> Column:
        return F.coalesce(F.try_element_at(F.col("attempts"), F.concat_ws("|", kind, normal)), F.lit(0))

    def new(entity: Column) -> Column:
        def with_kind(kind: Column) -> Column:
            of_domain = attempt_of(F.lit("domain"), F.lower(F.substring_index(entity, "@", -1)))
            return replacement(entity, kind, attempt_of(kind, _normal(entity, kind)), key, of_domain)

        return named(kind_of(entity), with_kind)

    replaced = cut.withColumn("replaced", F.transform("found", new))
    joined = F.transform("replaced", lambda e, i: F.concat(e, F.get("between", i + 1)))
    whole = replaced.withColumn("whole", F.concat(F.get("between", F.lit(0)), F.array_join(joined, "")))
    # surnames of this text and what became of them; the new ones are no entities, so each word is replaced once
    pairs = F.transform(
        "found",
        lambda e, i: F.when(
            kind_of(e) == "person",
            F.struct(F.substring_index(e, " ", -1).alias("key"), F.substring_index(F.get("replaced", i), " ", -1).alias("value")),
        ),
    )
    surnames = F.map_from_entries(F.array_distinct(F.filter(pairs, lambda p: p.isNotNull())))
    known_names = whole.withColumn("surnames", F.when(F.size("found") > 0, surnames))
    some = F.size("surnames") > 0
    words = known_names.withColumn("words", F.when(some, F.regexp_extract_all("whole", F.lit(BARE_NAME), F.lit(0))))
    words = words.withColumn("gaps", F.when(some, F.split("whole", BARE_NAME, -1)))
    renamed = F.transform("words", lambda w, i: F.concat(F.coalesce(F.try_element_at("surnames", w), w), F.get("gaps", i + 1)))
    bare = F.size(F.filter("words", lambda w: F.map_contains_key("surnames", w)))
    return words.select(
        "doc",
        F.when(some, F.concat(F.get("gaps", F.lit(0)), F.array_join(renamed, "")))
        .when(F.size("found") > 0, F.col("whole"))
        .otherwise(F.col("text"))
        .alias("text"),
        (F.size("found") + F.when(some, bare).otherwise(0)).cast("long").alias("n_entities"),
    )


def surrogate_documents(docs: DataFrame, key: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, text with surrogates, n_entities."""
    return with_surrogates(docs, key, text).select(F.col("doc").getField(id_col).alias(id_col), F.col("text").alias(text), "n_entities")
