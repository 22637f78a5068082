"""Personal data replaced by keyed surrogates, with DataFrame functions only.

Found: e-mail addresses, IPv4 addresses, card, social-security and telephone
numbers, cloud access keys, values after password or token, and names after a
title. A surrogate is drawn from a keyed hash of the entity's canonical form
(digits of a number, lower-cased address or name), so an entity has the same
one everywhere. It keeps type and format: separators, letter case, length,
country code, first card digit and whether the card's check digit is right; a
name keeps gender (of its title) and script (of its own letters: Latin,
Cyrillic, Greek or Armenian; Latin stands for all others). Drawn surrogates of all distinct
entities are compared in one table: where two are equal, or one equals a real
entity, all but the first draw again until every entity has its own. An entity
whose draws were all taken has a format that is full: from then on its
surrogates widen by one sign a draw (see ``widened``). Local parts, labels and
secrets of signs only get letters for them.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

# Patterns in order of precedence; the types below are told apart by the match.
SECRET_NAME = r"(?i:password|passwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?"
TITLES = {
    ("latin", "m"): ["Mr", "Herr", "Monsieur", "Señor"],
    ("latin", "f"): ["Mrs", "Ms", "Miss", "Frau", "Madame", "Señora"],
    ("cyrillic", "m"): ["господин"],
    ("cyrillic", "f"): ["госпожа"],
}
# What a name's letters say about its script; the first is the one for names
# of no other.
SCRIPTS = {"latin": r"\p{IsLatin}", "cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}",
           "armenian": r"\p{IsArmenian}"}
PATTERNS = [
    r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    SECRET_NAME + r"[A-Za-z0-9+/_-]{8,128}",
    r"\bAKIA[0-9A-Z]{16}\b",
    r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.]?\d)",
    r"(?<!\d)\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}(?!\d)",
    r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|(?<!\d)\d{2,4}[ .-])\d{3,4}[ .-]\d{4}(?!\d)",
    r"\b(?:" + "|".join(t for ts in TITLES.values() for t in ts) + r")\.? \p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?",
]
ANY = "|".join(PATTERNS)
# Given names by script and gender, and syllables of surnames.
GIVEN = {
    ("latin", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Lucas",
                     "Martin", "Noah", "Oscar", "Paul", "Simon", "Victor"],
    ("latin", "f"): ["Ada", "Bella", "Clara", "Diana", "Emma", "Flora", "Helen", "Irene", "Julia", "Laura",
                     "Maria", "Nina", "Olivia", "Paula", "Sara", "Vera"],
    ("cyrillic", "m"): ["Антон", "Борис", "Глеб", "Денис", "Егор", "Игорь", "Олег", "Павел"],
    ("cyrillic", "f"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Ольга", "Софья"],
    ("greek", "m"): ["Αντώνης", "Γιώργος", "Δημήτρης", "Ηλίας", "Κώστας", "Λουκάς", "Νίκος", "Πέτρος"],
    ("greek", "f"): ["Άννα", "Ειρήνη", "Ελένη", "Ζωή", "Θάλεια", "Μαρία", "Σοφία", "Φωτεινή"],
    ("armenian", "m"): ["Արամ", "Արմեն", "Գագիկ", "Դավիթ", "Հայկ", "Նարեկ", "Պետրոս", "Տիգրան"],
    ("armenian", "f"): ["Անահիտ", "Գայանե", "Լիլիթ", "Լուսինե", "Մարիամ", "Նարինե", "Սոնա", "Քրիստինե"],
}
SYLLABLES = {
    "latin": ["ba", "den", "fel", "gor", "han", "kel", "lin", "mar", "nor", "pal", "ros", "sten", "tor", "val",
              "win", "zan"],
    "cyrillic": ["бар", "вол", "гор", "дан", "жар", "кал", "лен", "мир", "нов", "пол", "руд", "сав", "тар", "фил",
                 "чер", "яр"],
    "greek": ["βαλ", "γορ", "δαν", "ζαν", "θεο", "καλ", "λεν", "μαρ", "νικ", "παλ", "ροδ", "σαν", "ταρ", "φιλ", "χαρ",
              "ψαλ"],
    "armenian": ["բար", "գար", "դան", "զոր", "թով", "կար", "լեն", "մար", "նար", "պալ", "ռուբ", "սար", "տիր", "փար",
                 "քոչ", "օհան"],
}
# Endings of surnames by script and gender.
ENDINGS = {("cyrillic", "m"): "ов", ("cyrillic", "f"): "ова", ("greek", "m"): "ίδης", ("greek", "f"): "ίδου",
           ("armenian", "m"): "յան", ("armenian", "f"): "յան"}
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# So many draws keep an entity's own format; the next ones widen it.
MAX_ROUNDS = 12


def _digit(c: Column) -> Column:
    return (c >= "0") & (c <= "9") & (F.length(c) == 1)


def _chars(s: Column) -> Column:
    return F.split(s, "")


def kind_of(m: Column) -> Column:
    """Type of a match."""
    return (F.when(F.contains(m, F.lit("@")), "email")
            .when(m.rlike("^" + SECRET_NAME), "secret")
            .when(m.rlike(r"^AKIA"), "key")
            .when(m.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), "ip")
            .when(m.rlike(r"^\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}$"), "card")
            .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
            .when(m.rlike(r"\d{4}$"), "phone")
            .otherwise(_person_kind(m)))


def _person_kind(m: Column) -> Column:
    """Gender from the title, script from the letters of the name."""
    name = F.regexp_replace(m, r"^\S+ ", "")
    script, gender = F.lit("latin"), F.lit("f")
    for s, letters in list(SCRIPTS.items())[1:]:
        script = F.when(name.rlike(letters), s).otherwise(script)
    for (_, g), titles in TITLES.items():
        gender = F.when(m.rlike("^(?:" + "|".join(titles) + r")(?!\p{L})"), g).otherwise(gender)
    return F.concat_ws("_", F.lit("person"), script, gender)


def canonical(kind: Column, m: Column) -> Column:
    """What makes two mentions the same entity."""
    return (F.when(kind == "email", F.lower(m))
            .when(kind == "secret", F.regexp_replace(m, "^" + SECRET_NAME, ""))
            .when(kind.isin("card", "ssn", "phone"), F.regexp_replace(m, r"\D", ""))
            .when(kind.startswith("person"), F.lower(F.regexp_replace(m, r"^\S+ ", "")))
            .otherwise(m))


def _draw(hexes: Column, i: Column, n: int | Column) -> Column:
    """A number below ``n`` from three hex digits of the hash (i from 1)."""
    return F.conv(F.substring(hexes, F.pmod((i - 1) * 3, F.lit(126)) + 1, F.lit(3)), 16, 10).cast("int") % n


def _pick(letters: str, k: Column) -> Column:
    return F.substring(F.lit(letters), k + 1, F.lit(1))


def _scramble(s: Column, hexes: Column) -> Column:
    """Letters and digits drawn anew, case and other characters kept; where
    there are none, letters for all characters but dots."""
    bare = ~s.rlike("[0-9A-Za-z]")
    n = F.when(s.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), 6).otherwise(26)      # hexadecimal stays so
    return F.array_join(F.transform(_chars(s), lambda c, i: (
        F.when(_digit(c), _draw(hexes, i + 1, 10).cast("string"))
        .when((c >= "a") & (c <= "z"), _pick(LOWER, _draw(hexes, i + 1, n)))
        .when((c >= "A") & (c <= "Z"), _pick(UPPER, _draw(hexes, i + 1, n)))
        .when(bare & (c != "."), _pick(LOWER, _draw(hexes, i + 1, 26))).otherwise(c))), "")


def _digits(n: Column, hexes: Column, keep: Column, canon: Column) -> Column:
    """``n`` digits; the first ``keep`` are those of the entity, the next one
    is 2 to 9."""
    return F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: (
        F.when(i <= keep, F.substring(canon, i, F.lit(1)))
        .when(i == keep + 1, (_draw(hexes, i, 8) + 2).cast("string"))
        .otherwise(_draw(hexes, i, 10).cast("string")))), "")


def _luhn(digits: Column) -> Column:
    """The check digit that follows ``digits``."""
    n = F.length(digits)
    d = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(digits, i, F.lit(1)).cast("int"))
    total = F.aggregate(F.transform(d, lambda x, i: F.when((n - i) % 2 == 1, x * 2 - F.when(x > 4, 9).otherwise(0))
                                    .otherwise(x)), F.lit(0), lambda a, x: a + x)
    return F.pmod(10 - total % 10, F.lit(10))


def surrogate(kind: Column, canon: Column, hexes: Column) -> Column:
    """The drawn surrogate, in canonical form."""
    n = F.length(canon)
    body = _digits(n - 1, hexes, F.lit(1), canon)
    right = F.substring(canon, n, F.lit(1)).cast("int") == _luhn(F.substring(canon, F.lit(1), n - 1))
    check = F.pmod(_luhn(body) + F.when(right, 0).otherwise(1 + _draw(hexes, n, 9)), F.lit(10))
    octets = [240 + _draw(hexes, F.lit(1), 16)] + [_draw(hexes, F.lit(i), 256) for i in (2, 3, 4)]
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    out = (F.when(kind == "email", F.concat(_scramble(local, hexes), F.lit("@"), _scramble(
        F.regexp_replace(domain, r"\.[^.]*$", ""), F.reverse(hexes)), F.lit(".example")))
        .when(kind == "key", F.concat(F.lit("AKIA"), _scramble(F.substring(canon, 5, 60), hexes)))
        .when(kind == "ip", F.concat_ws(".", *[o.cast("string") for o in octets]))
        .when(kind == "card", F.concat(body, check.cast("string")))
        .when(kind == "ssn", _digits(n, hexes, F.lit(0), canon))
        .when(kind == "phone", _digits(n, hexes, F.greatest(n - 10, F.lit(0)), canon)))
    for (script, gender), given in GIVEN.items():
        part = [F.element_at(F.array(*map(F.lit, SYLLABLES[script])), _draw(hexes, F.lit(i), 16) + 1)
                for i in (2, 3, 4, 5)]
        surname = F.concat(*part, F.lit(ENDINGS.get((script, gender), "")))
        first = F.lower(F.element_at(F.array(*map(F.lit, given)), _draw(hexes, F.lit(1), len(given)) + 1))
        out = out.when(kind == f"person_{script}_{gender}",
                       F.when(F.contains(canon, F.lit(" ")), F.concat_ws(" ", first, surname)).otherwise(surname))
    return out.otherwise(_scramble(canon, hexes))


def widened(kind: Column, canon: Column, sur: Column, hexes: Column, width: Column) -> Column:
    """``sur`` with ``width`` (1 to 31) more drawn signs than its format has
    room for. E-mail labels and secrets grow by letters (in place of their last
    characters where the pattern ends), surnames by syllables; the last
    characters of keys, and the last digits of numbers (not the kept ones nor a
    card's check digit), become letters; octets go to 999, then letters follow."""
    more = F.sha2(F.concat(hexes, F.lit("wider")), 512)
    n, size, at = F.length(canon), F.length(sur), F.sequence(F.lit(1), width)
    lower = F.array_join(F.transform(at, lambda i: _pick(LOWER, _draw(more, i, 26))), "")

    def over(letters: Column, end: Column, free: Column) -> Column:
        """Letters in place of the last of ``free`` characters before ``end``."""
        w = F.least(width, free)
        return F.concat(F.substring(sur, F.lit(1), end - w), F.substring(letters, F.lit(1), w),
                        F.substring(sur, end + 1, size))

    stem = F.regexp_replace(sur, r"\.example$", "")
    label = F.length(F.regexp_extract(stem, r"[^@.]*$", 0))
    kept = F.when(kind == "phone", F.greatest(n - 10, F.lit(0))).otherwise(0)
    octets = [240 + _draw(more, F.lit(40), 760)] + [_draw(more, F.lit(i), 1000) for i in (41, 42, 39)]
    cased = F.when(canon.rlike("[A-Z]") & ~canon.rlike("[a-z]"), F.upper(lower)).otherwise(lower)
    out = (F.when(kind == "email", F.when(label + width <= 63, F.concat(stem, lower, F.lit(".example")))
                  .otherwise(over(lower, F.length(stem), label)))
           .when(kind == "secret", F.when(n + width <= 128, F.concat(sur, cased)).otherwise(over(cased, size, n)))
           .when(kind == "key", over(F.upper(lower), size, F.lit(16)))
           .when(kind == "ip", F.concat(F.concat_ws(".", *[o.cast("string") for o in octets]),
                                        F.substring(lower, F.lit(1), width - 1)))
           .when(kind == "card", over(F.upper(lower), size - 1, size - 2))
           .when(kind.isin("ssn", "phone"), over(F.upper(lower), size, size - kept)))
    for script, syllables in SYLLABLES.items():
        some = F.array(*map(F.lit, syllables))
        longer = F.array_join(F.transform(at, lambda i: F.element_at(some, _draw(more, i, 16) + 1)), "")
        out = out.when(kind.startswith(f"person_{script}"), F.regexp_replace(
            sur, r"(\p{L}+)$", F.concat(longer, F.lit("$1"))))
    return out


def written(kind: Column, m: Column, sur: Column) -> Column:
    """The surrogate in the format of one mention."""
    filled = F.array_join(F.transform(_chars(m), lambda c, i: F.when(_digit(c), F.substring(
        sur, F.length(F.regexp_replace(F.substring(m, F.lit(1), i + 1), r"\D", "")), F.lit(1))).otherwise(c)), "")
    return (F.when(kind.isin("card", "ssn", "phone"), filled)
            .when(kind == "secret", F.concat(F.regexp_extract(m, "^" + SECRET_NAME, 0), sur))
            .when(kind == "email", F.when(m == F.upper(m), F.upper(sur)).otherwise(sur))
            .when(kind.startswith("person"), F.concat(F.regexp_extract(m, r"^\S+ ", 0), F.initcap(sur)))
            .otherwise(sur))


def _may_match(text: Column) -> Column:
    """A cheap necessary condition: every pattern holds a digit, an ``@``, an
    ``=`` or ``:``, ``AKIA``, or a title. Spares most texts the full pattern."""
    out = text.rlike("[0-9@=:]") | F.contains(text, F.lit("AKIA"))
    for titles in TITLES.values():
        for t in titles:
            out = out | F.contains(text, F.lit(t))
    return out


def _matches(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ANY), 0)


def entity_table(mentions: DataFrame, key: str) -> DataFrame:
    """``(kind, canon, sur)`` of every distinct entity of ``mentions(kind,
    canon)``: surrogates are distinct within a kind and equal no entity.

    Each round settles all entities whose draw is free; the space of the others
    is widened in every round after ``MAX_ROUNDS``, to far more surrogates than
    the pattern has entities of one format, so the rounds end."""
    ents = stored(mentions.groupBy("kind", "canon").agg(F.lit(0).alias("round")), "pii-entities")
    for i in itertools.count():
        kind, canon, turn = F.col("kind"), F.col("canon"), F.col("round")
        hexes = F.sha2(F.concat_ws("\u0000", F.lit(key), "kind", "canon", turn.cast("string")), 512)
        sur = surrogate(kind, canon, hexes)
        if i >= MAX_ROUNDS:
            width = F.least(turn - MAX_ROUNDS + 1, F.lit(31))
            sur = F.when(turn < MAX_ROUNDS, sur).otherwise(
                widened(kind, canon, sur, hexes, F.greatest(width, F.lit(1))))
        drawn = ents.withColumn("sur", sur)
        first = F.row_number().over(W.partitionBy("kind", "sur").orderBy("round", "canon"))
        real = ents.select("kind", F.col("canon").alias("sur"), F.lit(True).alias("real"))
        judged = stored(drawn.withColumn("again", first > 1).join(real, ["kind", "sur"], "left").select(
            "kind", "canon", "sur", "round", (F.col("again") | F.coalesce("real", F.lit(False))).alias("again")),
            "pii-drawn")
        if not judged.filter("again").limit(1).count():
            return judged.select("kind", "canon", "sur")
        ents = judged.select("kind", "canon", (F.col("round") + F.col("again").cast("int")).alias("round"))


def pseudonymize(df: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``df`` with surrogates in its text column, plus ``n_entities``.

    Null texts stay null and empty ones empty, with 0 entities; texts without
    entities come back byte for byte. Repeated rows get the same text. An
    existing ``n_entities`` column is replaced. Texts without entities take no
    part in any shuffle; of the others each distinct one is looked up once.
    """
    names = [c for c in df.columns if c.lower() != "n_entities"]
    # The columns go by neutral names in between, so that none can clash.
    own = [f"c{i}" for i in range(len(names))]
    df = df.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(names, own)])
    text_col = own[names.index(text_col)]
    text = F.col(text_col)
    has = F.coalesce(_may_match(text) & text.rlike(ANY), F.lit(False))
    some = df.filter(has)
    digest = F.sha2(text.cast("binary"), 256)
    found = some.select(digest.alias("sha"), _matches(text).alias("m")).groupBy("sha").agg(F.first("m").alias("m"))
    each = stored(found.select("sha", F.posexplode("m").alias("at", "m")).withColumn("kind", kind_of(F.col("m")))
                  .withColumn("canon", canonical(F.col("kind"), F.col("m"))), "pii-mentions")
    table = entity_table(each.select("kind", "canon"), key)
    new = each.join(table, ["kind", "canon"]).select(
        "sha", "at", written(F.col("kind"), F.col("m"), F.col("sur")).alias("new"))
    new = stored(new.groupBy("sha").agg(F.transform(F.array_sort(F.collect_list(
        F.struct("at", "new"))), lambda x: x["new"]).alias("new")), "pii-replacements")
    pieces = F.split(text, ANY, -1)
    joined = F.array_join(F.zip_with(pieces, F.col("new"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    done = some.withColumn("sha", digest).join(new, "sha").withColumn(text_col, joined).withColumn(
        "n_entities", F.size("new").cast("long"))
    rest = df.filter(~has).withColumn("n_entities", F.lit(0).cast("long"))
    out = rest.unionByName(done.select(*own, "n_entities"))
    return out.select(*[F.col(o).alias(c) for c, o in zip(names, own)], "n_entities")
