"""Personal data and secrets replaced by surrogates, in DataFrame operations only.

Each detected entity receives a replacement of its own type, computed from a keyed hash of what it
refers to: the same person, number or address gets the same surrogate in every document and every
run with that key, written in the format of each mention (coreference). Different entities get
different surrogates, none of which is itself an entity of the corpus (distinctness); where hashes
collide, all but one of the entities draw again until no collision is left. Surnames get longer with
every draw; other formats that have no room after ``IN_FORMAT`` draws are left by a character more a
draw (addresses of hosts for IPv6), so there is a surrogate for every entity of any corpus.

Numbers keep separators, length, country code and a valid card check digit; addresses of hosts stay
valid; mail addresses keep their shape, and addresses of one domain share a surrogate domain; secrets
keep length, case and alphabet, but letters of other scripts become Latin ones, and a value without any
letter or digit becomes letters; tokens keep the letters that tell what they are; names keep title, script,
number of words and, where the title or the given name tells it, gender. Surnames, given names and domains are
entities too: listed given names change places by the key, others get made-up ones, so two people never
become one.

The key is the caller's: whoever knows it can compute surrogates. What the patterns cannot tell stays: a name
without a title or a listed given name before it, and secrets without a label or a known form.

Documents without an entity pass through without a shuffle. Mentions, not texts, are joined with
surrogates, after copies of a mention have been counted as one; an entity that a third of all
documents mention is a skewed join key, which adaptive execution splits.

NULL and empty texts stay as they are. Equal rows are changed alike. Empty tables give empty results.
Other columns are kept; ``n_chars``, where there is one, follows the new text.
"""

from __future__ import annotations

from hashlib import sha256
from itertools import count
from secrets import token_hex

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse.llm.support import Scratch

#: Draws after which a format is taken to be too small for its entities.
IN_FORMAT = 8

# Titles and given names that tell a gender, and parts from which names are made.
TITLES = {
    "m": ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "Signor", "г-н", "господин", "κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña",
          "Signora", "г-жа", "госпожа", "κυρία"],
    "n": ["Dr", "Prof", "Professor"],
}
GIVEN = {
    ("latin", "m"): ["James", "John", "Robert", "Michael", "William", "David", "Thomas", "Charles", "Peter",
                     "Hans", "Karl", "Jean", "Pierre", "Luis", "Carlos", "Juan"],
    ("latin", "f"): ["Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Sarah",
                     "Anna", "Ingrid", "Claire", "Marie", "Sophie", "Lucia", "Carmen", "Elena"],
    ("cyrillic", "m"): ["Иван", "Пётр", "Алексей", "Сергей", "Дмитрий", "Николай", "Павел", "Андрей"],
    ("cyrillic", "f"): ["Анна", "Мария", "Елена", "Ольга", "Наталья", "Ирина", "Татьяна", "Вера"],
    ("greek", "m"): ["Γιώργος", "Νίκος", "Κώστας", "Πέτρος", "Ανδρέας", "Παύλος", "Σπύρος", "Μάνος"],
    ("greek", "f"): ["Μαρία", "Ελένη", "Σοφία", "Άννα", "Κατερίνα", "Ειρήνη", "Ζωή", "Δήμητρα"],
}
SYLLABLES = {
    "latin": ["bar", "den", "fel", "gor", "hal", "kin", "lor", "mar", "nel", "pol", "ras", "sten", "tam",
              "ver", "wen", "zor"],
    "cyrillic": ["бар", "ден", "фел", "гор", "кал", "кин", "лор", "мар", "нел", "пол", "рас", "стен",
                 "там", "вер", "вен", "зор"],
    "greek": ["βαρ", "δεν", "φελ", "γορ", "καλ", "κιν", "λορ", "μαρ", "νελ", "πολ", "ρασ", "στεν",
              "ταμ", "βερ", "βεν", "ζορ"],
}
#: Syllables of a surname's first draw; each further draw has one more.
SURNAME_SYLLABLES = 4


def _any(words: list[str]) -> str:
    return "|".join(w.replace(".", r"\.") for w in sorted(words, key=len, reverse=True))


_TITLE = _any([t for titles in TITLES.values() for t in titles])
_FIRST = _any([n for (script, _), names in GIVEN.items() for n in names])
_NAME = r"\p{Lu}[\p{L}'’-]{1,40}"
#: Where a title or given name may begin, as few ranges as can be: looked at before the long lists.
_NAME_START = "(?=[A-ZΆ-я])"
#: Between quotes anything on a line; else without blanks, short ones with a digit.
_VALUE = (
    r"(?:(?<=\")[^\"\n]{1,200}(?=\")|(?<=')[^'\n]{1,200}(?=')"
    r"|[^\s\"']{6,}|(?=[^\s\"']{0,4}[0-9])[^\s\"']{3,5})"
)
_LABEL_WORD = "(?i:passw(?:or)?d|pwd|secret|token|api[_-]?key)"
_ASSIGNED = r"[\"']? {0,2}[=:]"
#: Whatever stands before the word, as in DB_PASSWORD, stays in the text.
_LABEL = (
    rf"(?=[PSTABpstab])(?:{_LABEL_WORD}{_ASSIGNED} {{0,2}}[\"']?|(?i:bearer) (?=[A-Za-z0-9._~+/=-]{{12}}))"
)
#: What tokens of well-known makers begin with, and stay with.
_TOKEN_START = r"(?:gh[pousr]_|github_pat_|glpat-|xox[abprs]-|sk-|eyJ)"
_HEXTET = "[0-9A-Fa-f]{1,4}"

# In the order in which they are tried at a place; a mention's type is the first that matches it whole.
PATTERNS = {
    "mail": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "secret": _LABEL + _VALUE,
    "token": rf"\b(?=[egsx]){_TOKEN_START}[A-Za-z0-9_.-]{{16,}}+",
    "hex": r"\b(?=[A-Fa-f]*+[0-9])[0-9A-Fa-f]{32,}+\b",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ssn": r"(?=[0-9])(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "card": r"(?=[0-9])(?<![\w-])(?:" + "|".join(
        [f"[0-9]{{4}}{gap}[0-9]{{4}}{gap}[0-9]{{4}}{gap}[0-9]{{1,7}}" for gap in ("", " ", "-")]
        + [f"[0-9]{{4}}{gap}[0-9]{{6}}{gap}[0-9]{{5}}" for gap in (" ", "-")]
    ) + r")(?![\w-])",
    "phone": r"(?=[0-9+(])(?<![\w+.-])(?:"
             r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
             r"|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}|0[0-9]{2,4}[ /-][0-9]{5,8})(?!\w)",
    "ip": r"(?=[0-9])(?<![\w.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}"
          r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\.?\w)",
    "ip6": rf"(?=[0-9A-Fa-f])(?<![\w:.])(?:(?:{_HEXTET}:){{7}}{_HEXTET}"
           rf"|{_HEXTET}(?::{_HEXTET}){{1,5}}::(?:{_HEXTET}(?::{_HEXTET}){{0,4}})?)(?![\w:])",
    "name": rf"{_NAME_START}(?<!\p{{L}})(?:(?:{_TITLE})\.? {_NAME}(?: {_NAME})?|(?:{_FIRST}) {_NAME})(?!\p{{L}})",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def may_mention(text: Column) -> Column:
    """What every text with an entity has; most texts are passed over with this alone."""
    found = F.regexp_like(text, F.lit("[0-9@]"))
    assigns = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    found = found | (assigns & F.regexp_like(text, F.lit(f"{_LABEL_WORD}{_ASSIGNED}")))
    return found | F.regexp_like(text, F.lit(f"{_NAME_START}(?:{_TITLE}|{_FIRST})[. ]"))


def mentions(text: str | Column) -> Column:
    """All mentions of a text in order; NULL where there is none."""
    text = F.col(text) if isinstance(text, str) else text
    found = F.when(may_mention(text), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    # As a lambda's value the array is made once.
    return F.get(F.filter(F.array(found), lambda m: F.size(m) > 0), F.lit(0))


def kind_of(mention: Column) -> Column:
    """Type of a mention: the first whose pattern matches it whole."""
    kind = F.lit("secret")
    for name in reversed(PATTERNS):
        pattern = F.lit(f"^(?:{PATTERNS[name]})$")
        kind = F.when(F.regexp_like(mention, pattern), name).otherwise(kind)
    return kind


def _bare_name(mention: Column) -> Column:
    return F.regexp_replace(mention, F.lit(rf"^(?:{_TITLE})\.? "), F.lit(""))


def referent(kind: Column, mention: Column) -> Column:
    """What mentions in different formats have in common."""
    digits = F.regexp_replace(mention, "[^0-9]", "")
    return (
        F.when((kind == "phone") & _with_country(mention), F.substring(digits, 2, 10))
        .when(kind.isin("card", "phone", "ssn"), digits)
        .when(kind.isin("mail", "ip6"), F.lower(mention))
        .when(kind == "iban", F.regexp_replace(mention, " ", ""))
        .when(kind == "name", F.element_at(F.split(_bare_name(mention), " "), -1))
        .when(kind == "secret", F.regexp_replace(mention, F.lit(f"^{_LABEL}"), F.lit("")))
        .otherwise(mention)
    )


def _with_country(mention: Column) -> Column:
    """A number of ten digits with the country code 1, which is often left out."""
    return F.regexp_like(mention, F.lit(r"^\+1(?:[^0-9]*[0-9]){10}[^0-9]*$"))


def _digest(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *parts).cast("binary"), 512)


def _drawn(digest: Column, place: Column, size: int | Column) -> Column:
    """A number below ``size`` from the hash, for each place of a long text another."""
    offset = (place * 7) % 120 + 1
    number = F.conv(F.substring(digest, offset, F.lit(7)), 16, 10).cast("long")
    # Beyond the length of the hash its digits come round again, shifted by the round.
    return F.pmod(number + F.floor(place / 120) * 31, F.lit(size) if isinstance(size, int) else size).cast("int")


_DIGITS, _LOWER, _UPPER, _HEX = (
    "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"
)
#: Hexadecimal texts, with a letter, by the case of their letters.
_HEXADECIMAL = {
    "lower": "^[0-9a-f]*[a-f][0-9a-f]*$", "upper": "^[0-9A-F]*[A-F][0-9A-F]*$",
    "mixed": "^(?=.*[a-f])(?=.*[A-F])[0-9A-Fa-f]*$",
}


def _hex_case(text: Column) -> Column:
    case = F.lit(None).cast("string")
    for name, pattern in _HEXADECIMAL.items():
        case = F.when(F.regexp_like(text, F.lit(pattern)), name).otherwise(case)
    return case


def _scrambled(text: Column, digest: Column, hex_case: Column | None = None) -> Column:
    """Letters and digits replaced by others of their kind, or by hexadecimal ones of the same case; all
    else stays but in a text without either."""
    blank = ~F.regexp_like(text, F.lit(r"[\p{L}\p{N}]"))
    text = F.when(blank, F.repeat(F.lit("x"), F.char_length(text))).otherwise(text)

    def other(char: Column, place: Column) -> Column:
        pick = lambda letters: F.substring(F.lit(letters), _drawn(digest, place, len(letters)) + 1, F.lit(1))
        plain = (
            F.when(F.regexp_like(char, F.lit("[0-9]")), pick(_DIGITS))
            .when(F.regexp_like(char, F.lit("[a-z]")), pick(_LOWER))
            .when(F.regexp_like(char, F.lit(r"\p{Lu}")), pick(_UPPER))
            .when(F.regexp_like(char, F.lit(r"[\p{L}\p{N}]")), pick(_LOWER)).otherwise(char)
        )
        if hex_case is None:
            return plain
        return (
            F.when(hex_case == "lower", pick(_HEX)).when(hex_case == "upper", pick(_HEX.upper()))
            .when((hex_case == "mixed") & F.regexp_like(char, F.lit("[a-f]")), pick(_HEX[10:]))
            .when((hex_case == "mixed") & F.regexp_like(char, F.lit("[A-F]")), pick(_HEX[10:].upper()))
            .otherwise(plain)
        )

    return F.array_join(F.transform(F.split(text, ""), other), "")


def _beyond_format(digest: Column, letters: str) -> Column:
    """What a draw has on top of the format: nothing at first, then a character more each time."""
    more = F.greatest(F.lit(0), F.col("turn") - IN_FORMAT + 1)
    places = F.slice(F.sequence(F.lit(0), more), F.lit(1), more)
    return F.array_join(F.transform(
        places, lambda i: F.substring(F.lit(letters), _drawn(digest, i, len(letters)) + 1, F.lit(1))
    ), "")


def _luhn_sum(digits: Column) -> Column:
    """Sum of a number's digits, every second from the right doubled and folded."""
    chars = F.reverse(F.split(digits, ""))
    def folded(char: Column, place: Column) -> Column:
        value = char.cast("int") * F.when(place % 2 == 1, 2).otherwise(1)
        return F.when(value > 9, value - 9).otherwise(value)
    return F.aggregate(F.transform(chars, folded), F.lit(0), lambda a, x: a + x)


def _card(entity: Column, digest: Column) -> Column:
    body = F.concat(F.substring(entity, 1, 1), F.expr("substring(scrambled, 2, length(scrambled) - 2)"))
    check = F.pmod(10 - F.pmod(_luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10))
    valid = F.pmod(_luhn_sum(entity), F.lit(10)) == 0
    return F.concat(body, F.when(valid, check.cast("string")).otherwise(F.right("scrambled", F.lit(1))))


def _surname(entity: Column, digest: Column) -> Column:
    made = None
    for script, pattern in (("cyrillic", r"\p{IsCyrillic}"), ("greek", r"\p{IsGreek}")):
        parts = _syllables(script, digest)
        when = F.regexp_like(entity, F.lit(pattern))
        made = F.when(when, parts) if made is None else made.when(when, parts)
    return F.initcap(made.otherwise(_syllables("latin", digest)))


def _syllables(script: str, digest: Column) -> Column:
    table = F.array(*map(F.lit, SYLLABLES[script]))
    places = F.sequence(F.lit(0), F.col("turn") + SURNAME_SYLLABLES - 1)
    return F.array_join(F.transform(
        places, lambda i: F.get(table, _drawn(digest, i, len(SYLLABLES[script])))
    ), "")


def _address(digest: Column) -> Column:
    first = 1 + _drawn(digest, F.lit(0), 223)
    short = F.concat_ws(".", first.cast("string"), *[_drawn(digest, F.lit(i), 256).cast("string") for i in (1, 2, 3)])
    return F.when(F.col("turn") < IN_FORMAT, short).otherwise(_long_address(digest))


def _long_address(digest: Column) -> Column:
    """A unique local address: 2^120 of them."""
    return F.concat_ws(":", F.concat(F.lit("fd"), F.substring(digest, 1, 2)), *[
        F.substring(digest, 4 * i - 1, 4) for i in range(1, 8)
    ])


def draw(entities: DataFrame, key: str) -> DataFrame:
    """(kind, entity, turn, surrogate): what each entity receives at its ``turn``-th draw."""
    kind, entity = F.col("kind"), F.col("entity")
    digest = _digest(key, kind, entity, F.col("turn").cast("string"))
    # As a lambda's value the case is found once, not for every character.
    scrambled = F.get(F.transform(
        F.array(_hex_case(entity)), lambda case: _scrambled(entity, F.col("digest"), case)
    ), F.lit(0))
    rows = entities.withColumn("digest", digest).withColumn("scrambled", scrambled)
    digest = F.col("digest")
    # A domain keeps its last part.
    host = _scrambled(F.regexp_replace(entity, r"\.[^.]*$", ""), digest)
    kept = F.length(F.regexp_extract(entity, f"^{_TOKEN_START}", 0))
    surrogate = (
        F.when(kind == "mail", F.concat(
            _scrambled(F.substring_index(entity, "@", 1), digest), _beyond_format(digest, _LOWER)
        ))
        .when(kind == "domain", F.concat(
            host, _beyond_format(digest, _LOWER), F.lit("."), F.substring_index(entity, ".", -1)
        ))
        .when(kind == "ip", _address(digest)).when(kind == "ip6", _long_address(digest))
        .when(kind.isin("name", "given"), _surname(entity, digest))
        .when(kind == "token", F.concat(
            F.substring(entity, F.lit(1), kept), F.substring("scrambled", kept + 1, F.length("scrambled"))
        ))
        .when(kind == "card", _card(entity, digest))
        .when(kind == "ssn", F.concat(F.lit("9"), F.expr("substring(scrambled, 2)")))
        .when(kind.isin("key", "iban"), F.concat(
            F.substring(entity, F.lit(1), F.when(kind == "key", 4).otherwise(2)),
            F.substring("scrambled", F.when(kind == "key", 5).otherwise(3), F.length("scrambled")),
        ))
        .when(kind == "phone", F.concat(
            F.when(F.length(entity) > 10, F.expr("left(entity, length(entity) - 10)")).otherwise(F.lit("")),
            F.expr("right(scrambled, least(10, length(scrambled)))"),
        ))
        .otherwise(F.col("scrambled"))
    )
    surrogate = (
        F.when(kind.isin("mail", "domain", "ip", "ip6", "name", "given"), surrogate)
        .when(kind.isin("card", "ssn", "phone"), F.concat(surrogate, _beyond_format(digest, _DIGITS)))
        .when(kind.isin("key", "iban"), F.concat(surrogate, _beyond_format(digest, _UPPER)))
        .otherwise(F.concat(surrogate, _beyond_format(digest, _HEX)))
    )
    return rows.select("kind", "entity", "turn", surrogate.alias("surrogate"))


def distinct_surrogates(entities: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(kind, entity, surrogate) for distinct (kind, entity), one to one and off the entities.

    Of entities that draw the same surrogate the least keeps it; the others, and those that drew an
    entity of the corpus or a surrogate given before, draw again, from ever more surrogates.
    """
    # Of a mail address the part before its domain is drawn, one to one over all domains.
    user = F.when(F.col("kind") == "mail", F.substring_index("entity", "@", 1)).otherwise(F.col("entity"))
    known = entities.select("kind", user.alias("surrogate")).distinct()
    left, given = entities.withColumn("turn", F.lit(0)), None
    for turn in count():
        drawn, _ = scratch.write(draw(left.withColumn("turn", F.lit(turn)), key))
        first = drawn.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"))
        first = first.join(known, ["kind", "surrogate"], "left_anti")
        if given is not None:
            first = first.join(given, ["kind", "surrogate"], "left_anti")
        kept, _ = scratch.write(first.select("kind", "entity", "surrogate"))
        given = kept if given is None else given.unionAll(kept)
        left = drawn.join(kept, ["kind", "entity"], "left_anti").select("kind", "entity")
        left, _ = scratch.write(left)
        if left.isEmpty():
            return given


def _given_parts(mention: Column) -> tuple[Column, Column]:
    """The given name of a name of two words, else NULL, and whether it is a listed one."""
    names = F.split(_bare_name(mention), " ")
    first = F.when(F.size(names) > 1, F.get(names, F.lit(0)))
    return first, first.isin([n for names_of in GIVEN.values() for n in names_of])


def _given_name(mention: Column, made: Column, key: str) -> Column:
    """The given name in a surrogate, the same wherever that given name occurs, others for others.

    Listed names stand in an order that the key decides, for each script and gender, and each becomes the next
    one. Others become ``made`` with an ending for the gender that the title tells."""
    title = F.regexp_extract(mention, rf"^({_TITLE})\.? ", 1)
    first, _ = _given_parts(mention)
    next_of = [
        F.lit(x) for names_of in GIVEN.values() for pair in _in_keyed_ring(names_of, key) for x in pair
    ]
    female, male = title.isin(TITLES["f"]), title.isin(TITLES["m"])
    endings = (("cyrillic", "а", "ий", "о"), ("greek", "α", "ος", "ι"), ("latin", "a", "us", "e"))
    ended = None
    for script, f, m, n in endings:
        end = F.when(female, f).when(male, m).otherwise(n)
        name = f"Is{script.capitalize()}"
        when = F.regexp_like(made, F.lit(rf"\p{{{name}}}"))
        ended = F.when(when, end) if ended is None else ended.when(when, end)
    return F.coalesce(F.element_at(F.create_map(*next_of), first), F.concat(made, ended))


def _in_keyed_ring(names: list[str], key: str) -> list[tuple[str, str]]:
    order = sorted(names, key=lambda n: sha256(f"{key}\x1fgiven\x1f{n}".encode()).digest())
    return list(zip(order, order[1:] + order[:1]))


def written_like(
    mention: Column, kind: Column, surrogate: Column, key: str, domain: Column | None = None, made: Column | None = None
) -> Column:
    """The surrogate in the format of the mention; ``domain``: that of a mail address, ``made``: for a given
    name that is not listed."""
    none = F.lit(None).cast("string")
    domain, made = (none if c is None else c for c in (domain, made))
    surrogate = F.when((kind == "phone") & _with_country(mention), F.concat(F.lit("1"), surrogate)).otherwise(surrogate)
    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("next"))
    def fill(done: Column, char: Column) -> Column:
        takes = char.rlike("[0-9]") | ((kind == "iban") & char.rlike("[A-Z0-9]"))
        return F.struct(
            F.concat(done["text"], F.when(takes, F.substring(surrogate, done["next"], F.lit(1))).otherwise(char)).alias("text"),
            (done["next"] + F.when(takes, 1).otherwise(0)).alias("next"),
        )
    # A surrogate beyond the format has its last characters behind it.
    filled = F.aggregate(F.split(mention, ""), start, fill, lambda done: F.concat(
        done["text"], F.substring(surrogate, done["next"], F.length(surrogate))
    ))
    title = F.regexp_extract(mention, rf"^((?:{_TITLE})\.? )", 1)
    named = F.concat(title, F.concat_ws(" ", _given_name(mention, made, key), surrogate))
    labelled = F.concat(F.regexp_extract(mention, f"^({_LABEL})", 1), surrogate)
    return (
        F.when(kind.isin("card", "phone", "ssn", "iban"), filled).when(kind == "name", named)
        .when(kind == "secret", labelled).when(kind == "mail", F.concat_ws("@", surrogate, domain))
        .otherwise(surrogate)
    )


#: Session setting that holds the key of queries and pipelines; without it each driver process has its own.
KEY_SETTING = "spark.forgepulse.surrogates.key"
_PROCESS_KEY = token_hex(32)


def session_key(spark: SparkSession) -> str:
    return spark.conf.get(KEY_SETTING, None) or _PROCESS_KEY


def with_surrogates(docs: DataFrame, key: str) -> DataFrame:
    """(row, n_entities): all columns of ``docs``, with entities in ``text`` replaced, in ``row``."""
    scratch = Scratch(docs.sparkSession, "surrogates")
    found, _ = scratch.write(docs.select(
        F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number"),
        mentions(F.col("text")).alias("mentions"),
    ))
    named = found.where(F.col("mentions").isNotNull())
    said, _ = scratch.write(
        named.select("number", F.explode(F.array_distinct("mentions")).alias("mention"))
    )
    kinds = said.select("mention").distinct().withColumn("kind", kind_of(F.col("mention"))).withColumn(
        "entity", referent(F.col("kind"), F.col("mention"))
    )
    first, listed = _given_parts(F.col("mention"))
    # What else a mention holds that is an entity of its own: a domain, or a given name that is not listed.
    second = F.when(F.col("kind") == "mail", F.substring_index("entity", "@", -1)).when(
        (F.col("kind") == "name") & ~listed, first
    )
    of_second = F.when(F.col("kind") == "mail", "domain").otherwise("given")
    kinds, _ = scratch.write(kinds.withColumn("second", second).withColumn("second_kind", F.when(second.isNotNull(), of_second)))
    entities = kinds.select("kind", "entity").unionAll(
        kinds.where(F.col("second").isNotNull()).select("second_kind", "second")
    ).distinct()
    given, _ = scratch.write(distinct_surrogates(entities, key, scratch))
    seconds = given.select(
        F.col("kind").alias("second_kind"), F.col("entity").alias("second"), F.col("surrogate").alias("second_surrogate")
    )
    mention, kind = F.col("mention"), F.col("kind")
    written = kinds.join(given, ["kind", "entity"]).join(seconds, ["second_kind", "second"], "left").select(
        "mention",
        written_like(mention, kind, F.col("surrogate"), key, F.col("second_surrogate"), F.col("second_surrogate")).alias("instead"),
    )
    written, _ = scratch.write(written)
    of_document = said.join(written, "mention").groupBy("number").agg(
        F.map_from_entries(F.collect_list(F.struct("mention", "instead"))).alias("instead")
    )
    gaps = F.split("row.text", ANY, -1)
    texts = F.array_join(F.concat(
        F.slice(gaps, F.lit(1), F.lit(1)),
        F.transform("mentions", lambda m, i: F.concat(F.element_at("instead", m), F.get(gaps, i + 1))),
    ), "")
    changed = named.join(of_document, "number").withColumn("text", texts)
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    changed = changed.select(row.alias("row"), F.size("mentions").cast("long").alias("n_entities"))
    same = found.where(F.col("mentions").isNull()).select("row", F.lit(0).cast("long").alias("n_entities"))
    return same.unionAll(changed)
