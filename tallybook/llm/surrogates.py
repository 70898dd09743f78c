"""Personal data replaced by keyed surrogates of the same type and format.

DataFrame functions only. Entities are found by one pattern: e-mail and IPv4 addresses, phone,
card and identity numbers, access keys, the values of passwords and tokens, and names after a
title. Each distinct entity gets a surrogate from a keyed hash of its type and value, so the same
person, number or secret has the same surrogate in all documents:

* numbers keep their separators, length and country code, and a card number stays valid if it was;
* addresses and secrets keep their length and, letter by letter, digits and upper or lower case;
  a secret is what follows its keyword up to a blank, quote, comma or bracket, however long. One
  of few possible values may become longer;
* a name is a title and any number of capitalised words after it. It keeps its title, script,
  gender, hyphens and capitals. Given and family names are entities of their own, so "Ms. Ann Lee"
  and "Ms. LEE" share the family name's surrogate, and initials stay. Where a name has been found
  in a document, its words are replaced there without a title too.

Surrogates are checked for collisions over the whole corpus: one that is a real value of its type,
its own value, or another's surrogate is replaced by the next of the keyed sequence, until all are
distinct. Values are made distinct before any join, so that a value in a third of all documents
is a few rows; a document meets only its own entities.

Defined cases: a null text stays null, and an empty one empty. Text outside of entities is kept as
it is. Upper and lower case of an e-mail address are one entity, and so are the formats of one
phone or card number. Rows that repeat, or have no id, are treated alike; other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.spread import broadcast_if_small
from tallybook.session import RowCounter, materialize

#: Rounds of new surrogates after which a type has too few of them.
MAX_ROUNDS = 40

#: Titles by gender and script, and the endings of given and family names made up for them.
TITLES = {
    "m": {"latin": "Mr|Herr|Señor|Monsieur", "cyrillic": "Господин|господин|г-н", "greek": "Κύριος|κύριος"},
    "f": {"latin": "Mrs|Ms|Miss|Frau|Señora|Madame|Mme", "cyrillic": "Госпожа|госпожа|г-жа", "greek": "Κυρία|κυρία"},
    "n": {"latin": "Dr|Prof|Doctor|Professor|Mx", "cyrillic": "Доктор|доктор|д-р", "greek": "Δρ"},
}
CONSONANTS = {"latin": "bdfgklmnprstvz", "cyrillic": "бвгдзклмнпрстф", "greek": "βγδζκλμνπρστφχ"}
VOWELS = {"latin": "aeiou", "cyrillic": "аеиоу", "greek": "αειου"}
GIVEN = {"m": {"latin": "o", "cyrillic": "ан", "greek": "ος"}, "f": {"latin": "a", "cyrillic": "а", "greek": "η"}, "n": {"latin": "i", "cyrillic": "и", "greek": "ι"}}
FAMILY = {"latin": "son", "cyrillic": "енко", "greek": "ιδη"}

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_ALL_TITLES = "|".join(t for by_script in TITLES.values() for t in by_script.values())
_TITLE_STARTS = "".join(sorted({t[0] for t in _ALL_TITLES.split("|")}))
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}(?![A-Za-z0-9])"
IPV4 = rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9])(?!\.[0-9])"
CARD = r"(?<![0-9])[3-6](?:[ -]?[0-9]){12,18}(?![0-9])"
IDENTITY = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-]?)|\([0-9]{2,4}\)[ .-]?|[0-9]{3}[.-])[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
ACCESS_KEY = r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36})(?![A-Za-z0-9])"
# The short tests only say early what the last one says: most places end there.
_VALUE = r"[^\s\"'`,;&<>()\[\]{}]"
SECRET = (
    r"(?<=[=: \"'])(?<=[=:][ ]{0,2}[\"']?)"
    r"(?<=(?i:password|passwd|pwd|secret|token|api_key|apikey)[\"']?[ ]{0,2}[=:][ ]{0,2}[\"']?)"
    # It has a letter or digit, and a digit or symbol if it is short.
    rf"(?={_VALUE}*[\p{{L}}\p{{N}}])(?:(?={_VALUE}*[0-9!@#$%^*?~|+=_/-]){_VALUE}{{4,}}+|{_VALUE}{{8,}}+)"
)
_WORD = r"(?:\p{Lu}(?:[\p{L}\p{M}]|['’-](?=\p{L}))++|\p{Lu}\.(?=[ ]\p{Lu}))"
NAME = rf"(?<!\p{{L}})(?=[{_TITLE_STARTS}])(?:{_ALL_TITLES})\.?[ ]{_WORD}(?:[ ]{_WORD})*+"
# Inside a word only numbers can begin, so other places there are passed over at once.
ENTITY = "(?:(?<![A-Za-z])|(?=[0-9]))(?:" + "|".join([SECRET, EMAIL, ACCESS_KEY, IPV4, IDENTITY, CARD, PHONE, NAME]) + ")"

_PART = "array<struct<kind: string, norm: string>>"


def found_entities(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _whole(pattern: str) -> str:
    return rf"\A(?:{pattern})\z"


def entity_parts(value: Column) -> Column:
    """The parts of an entity that get surrogates, as (kind, norm)."""

    def one(kind: str, norm: Column) -> Column:
        return F.array(F.struct(F.lit(kind).alias("kind"), norm.alias("norm")))

    words = F.split(value, " ")

    def named(gender: str) -> Column:
        """Given names and the family name, by their places; initials are no parts."""

        def part(word: Column, place: Column) -> Column:
            script = F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
            own = F.when(place == F.size(words) - 1, F.lit("family/")).otherwise(F.lit(f"given/{gender}/"))
            return F.struct(F.concat(own, script).alias("kind"), F.lower(word).alias("norm"))

        return F.transform(words, lambda word, place: F.when((place > 0) & ~word.endswith("."), part(word, place)))

    parts = F.when(value.rlike(_whole(EMAIL)), one("email", F.lower(value)))
    parts = parts.when(value.rlike(_whole(IPV4)), one("ipv4", value))
    parts = parts.when(value.rlike(_whole(IDENTITY)), one("identity", value))
    parts = parts.when(value.rlike(_whole(CARD)), one("card", _digits(value)))
    # What stands before the last ten digits is the country's.
    parts = parts.when(value.rlike(_whole(PHONE)), one("phone", F.right(_digits(value), F.lit(10))))
    for gender, by_script in TITLES.items():
        parts = parts.when(value.rlike(rf"\A(?:{'|'.join(by_script.values())})\.?[ ]"), named(gender))
    return parts.otherwise(one("secret", value)).cast(_PART)


def _byte(stream: Column, place: Column) -> Column:
    """The byte of a hexadecimal stream at a place from 0 on; the stream repeats."""
    return F.conv(F.substr(stream, F.pmod(place * 2, F.length(stream)) + 1, F.lit(2)), 16, 10).cast("int")


def _pick(alphabet: str, number: Column) -> Column:
    return F.substr(F.lit(alphabet), F.pmod(number, F.lit(len(alphabet))).cast("int") + 1, F.lit(1))


def _alike(text: Column, stream: Column) -> Column:
    """Another text with digits, upper and lower case letters, and all else in the same places."""
    lower, digit = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    hexadecimal = text.rlike(r"\A[0-9a-f]+\z") & text.rlike("[a-f]")

    def changed(place: Column) -> Column:
        c = F.substr(text, place + 1, F.lit(1))
        byte = _byte(stream, place)
        return (
            F.when(hexadecimal, _pick("0123456789abcdef", byte))
            .when(c.rlike("[0-9]"), _pick(digit, byte))
            .when(c.rlike("[a-z]"), _pick(lower, byte))
            .when(c.rlike(r"\p{Lu}"), _pick(lower.upper(), byte))
            .when(c.rlike(r"\p{L}"), _pick(lower, byte))
            .otherwise(c)
        )

    places = F.sequence(F.lit(0), F.length(text) - 1)
    return F.array_join(F.transform(places, changed), "")


def _luhn_sum(digits: Column) -> Column:
    """Checksum of a number; every second digit from the right counts double."""
    places = F.sequence(F.lit(0), F.length(digits) - 1)

    def weighed(place: Column) -> Column:
        d = F.substr(digits, F.length(digits) - place, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(place % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(places, weighed), F.lit(0), lambda total, x: total + x)


def _card(norm: Column, stream: Column) -> Column:
    """Same length and issuer digit; the check digit is right if it was."""
    body = F.concat(F.substr(norm, F.lit(1), F.lit(1)), _alike(F.substr(norm, F.lit(2), F.length(norm) - 2), stream))
    check = F.pmod(F.lit(10) - F.pmod(_luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10))
    free = F.pmod(check + 1 + F.pmod(_byte(stream, F.lit(100)), F.lit(9)), F.lit(10))
    return F.concat(body, F.when(_luhn_sum(norm) % 10 == 0, check).otherwise(free).cast("string"))


def _name(script: str, ending: str, norm: Column, stream: Column, attempt: Column) -> Column:
    """Syllables with an ending, in lower case, with a hyphen if the name has one; later attempts
    are longer, so that names never run out."""

    def syllables(first: int) -> Column:
        places = F.sequence(F.lit(first), F.lit(first + 2) + F.floor(attempt / 3).cast("int"))
        one = lambda i: F.concat(_pick(CONSONANTS[script], _byte(stream, i * 2)), _pick(VOWELS[script], _byte(stream, i * 2 + 1)))
        return F.array_join(F.transform(places, one), "")

    before = F.when(F.contains(norm, F.lit("-")), F.concat(syllables(24), F.lit("-"))).otherwise(F.lit(""))
    return F.concat(before, syllables(0), F.lit(ending))


def surrogate(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a part at this place of its keyed sequence."""
    seed = F.concat_ws("/", F.lit(key), kind, attempt.cast("string"), norm)
    stream = F.concat(F.sha2(F.concat(F.lit("1/"), seed), 512), F.sha2(F.concat(F.lit("2/"), seed), 512))
    # An address keeps its top-level domain.
    top = F.substring_index(norm, ".", -1)
    made = F.when(kind == "email", F.concat(_alike(F.substr(norm, F.lit(1), F.length(norm) - F.length(top)), stream), top))
    octets = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (F.pmod(_byte(stream, i), F.lit(254)) + 1).cast("string"))
    made = made.when(kind == "ipv4", F.array_join(octets, ".")).when(kind == "card", _card(norm, stream))
    for gender, by_script in GIVEN.items():
        for script, ending in by_script.items():
            made = made.when(kind == f"given/{gender}/{script}", _name(script, ending, norm, stream, attempt))
    for script, ending in FAMILY.items():
        made = made.when(kind == f"family/{script}", _name(script, ending, norm, stream, attempt))
    # A secret of few possible values grows, so that it never runs out of them.
    more = F.floor(attempt / 8).cast("int")
    longer = F.transform(F.sequence(F.lit(1), more), lambda i: _pick("abcdefghijklmnopqrstuvwxyz", _byte(stream, i + 40)))
    grown = F.when((kind == "secret") & (more > 0), F.array_join(longer, "")).otherwise(F.lit(""))
    return made.otherwise(F.concat(_alike(norm, stream), grown))


def assign(parts: DataFrame, key: str) -> DataFrame:
    """kind, norm, made: distinct surrogates for distinct parts (kind, norm)."""
    accepted, attempt = None, 0
    # Few bytes but much work a row: adaptive execution would leave them to one task.
    partitions = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pending = parts
    while attempt < MAX_ROUNDS:
        seen = RowCounter()
        spread = pending.repartition(partitions, "kind", "norm")
        tried = spread.select("kind", "norm", surrogate(F.col("kind"), F.col("norm"), F.lit(attempt), key).alias("made"))
        tried = materialize(seen.watch(tried), "tried")
        if not seen.rows:
            return accepted if accepted is not None else tried
        taken = parts.select("kind", F.col("norm").alias("made"))
        if accepted is not None:
            taken = taken.unionByName(accepted.select("kind", "made"))
        free = tried.join(taken, ["kind", "made"], "left_anti")
        won = free.groupBy("kind", "made").agg(F.min("norm").alias("norm")).select("kind", "norm", "made")
        accepted = materialize(won if accepted is None else accepted.unionByName(won), "surrogates")
        pending = tried.select("kind", "norm").join(accepted, ["kind", "norm"], "left_anti")
        attempt += 1
    raise ValueError("a type of entities has too few surrogates for its distinct values")


def _rendered(value: Column, kind: Column, made: Column) -> Column:
    """A number's new digits in the places of the old ones, or the surrogate itself."""
    digits = F.length(_digits(value))
    kept = digits - F.length(made)
    before = lambda place: F.length(_digits(F.substr(value, F.lit(1), place)))

    def changed(place: Column) -> Column:
        c = F.substr(value, place, F.lit(1))
        number = before(place) - kept
        return F.when(c.rlike("[0-9]") & (number > 0), F.substr(made, number, F.lit(1))).otherwise(c)

    in_place = F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), changed), "")
    return F.when(kind.isin("card", "phone"), in_place).otherwise(made)


def _is_name(kind: Column) -> Column:
    return kind.startswith("given/") | kind.startswith("family/")


def _recased(made: Column, word: Column) -> Column:
    """A name with the capitals of the word it replaces."""
    capital = F.array_join(F.transform(F.split(made, "-"), lambda part: F.initcap(part)), "-")
    return F.when((F.length(word) > 1) & (word == F.upper(word)), F.upper(made)).otherwise(capital)


def replacements(values: DataFrame, key: str) -> DataFrame:
    """value, replaced, words: for distinct entities; `words` pairs the words of a name with theirs."""
    split = values.select("value", F.posexplode(entity_parts(F.col("value"))).alias("place", "part")).where("part is not null")
    split = materialize(split.select("value", "place", "part.kind", "part.norm"), "parts")
    parts = materialize(split.select("kind", "norm").distinct(), "distinct-parts")
    joined = split.join(assign(parts, key), ["kind", "norm"])
    pieces = joined.groupBy("value").agg(
        F.min("kind").alias("kind"), F.sort_array(F.collect_list(F.struct("place", "made"))).alias("made")
    )
    made = F.array_join(F.transform("made", lambda x: x["made"]), " ")
    by_place = F.map_from_entries("made")
    words = F.split("value", " ")
    renamed = F.transform(words, lambda word, place: F.coalesce(_recased(F.try_element_at(by_place, place), word), word))
    pairs = F.arrays_zip(words.alias("word"), renamed.alias("shown"))
    new = F.filter(pairs, lambda p: p["word"] != p["shown"])
    is_name = _is_name(F.col("kind"))
    return pieces.select(
        "value",
        F.when(is_name, F.array_join(renamed, " ")).otherwise(_rendered(F.col("value"), F.col("kind"), made)).alias("replaced"),
        F.when(is_name, new).alias("words"),
    )


#: A word that stands alone.
_ALONE = (r"(?<![\p{L}\p{N}])\Q", r"\E(?![\p{L}\p{N}])")


def _without_names(text: Column, words: Column) -> Column:
    """Replace the words of names that the document holds with a title elsewhere."""
    begin, end = (F.lit(x) for x in _ALONE)
    return F.aggregate(
        words, text, lambda done, w: F.regexp_replace(done, F.concat(begin, w["word"], end), w["shown"])
    )


def replace_entities(docs: DataFrame, key: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, text with its entities replaced, n_replaced (later mentions without a title don't
    count): one row per row of `docs`."""
    source = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text")
    ).withColumn("mark", F.xxhash64("text"))
    # An outer explode, since an inner one would search the text again in a filter of its own.
    found_once = F.explode_outer(F.array_distinct(found_entities(F.col("text"))))
    owned = source.select("doc_id", "mark", found_once.alias("value")).where("value is not null").distinct()
    # Entities are counted, not documents: they are what a broadcast would hold.
    seen = RowCounter()
    owned = materialize(seen.watch(owned), "entities")
    made = materialize(replacements(owned.select("value").distinct(), key), "replacements")
    own = owned.join(made, "value").groupBy("doc_id", "mark").agg(
        F.map_from_entries(F.collect_list(F.struct("value", "replaced"))).alias("own"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("words")))).alias("words"),
    )
    own = materialize(own, "replacements-by-document").withColumnsRenamed({"doc_id": "_id", "mark": "_mark"})
    joined = source.join(
        broadcast_if_small(own, seen.rows), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left"
    )
    found = found_entities(F.col("text"))
    between = F.split("text", ENTITY, -1)
    between = F.when(F.size("words") > 0, F.transform(between, lambda t: _without_names(t, F.col("words")))).otherwise(between)
    pieces = F.zip_with(between, found, lambda text, value: F.concat(text, F.coalesce(F.element_at("own", value), F.lit(""))))
    changed = F.col("own").isNotNull()
    return joined.select(
        "doc_id",
        F.when(changed, F.array_join(pieces, "")).otherwise(F.col("text")).alias("text"),
        F.when(changed, F.size(found)).otherwise(0).alias("n_replaced"),
    )
