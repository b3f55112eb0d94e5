"""Personal data: detected entities become keyed surrogates of the same type and format. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardpulse.llm.shared import written

# Titles before names, by gender (fixed values).
TITLES = {
    "m": ("Mr", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "господин", "κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "госпожа", "κυρία"),
}
# Given names that are exchanged inside their list (fixed values).
GIVEN = {
    "m": ("james", "john", "robert", "michael", "thomas", "peter", "paul", "hans", "karl", "jean", "pierre", "luc",
          "carlos", "juan", "miguel", "andreas"),
    "f": ("mary", "anna", "linda", "sarah", "julia", "emma", "laura", "petra", "heidi", "marie", "claire", "sophie",
          "carmen", "lucia", "elena", "ingrid"),
}
# Letters and digits are replaced inside their class, so script, case, vowels and digits stay what they are (fixed
# values). Upper case follows the lower-case letter.
CLASSES = (
    "0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóúàèìòùâêîôûäëïöüãõåæø", "çñýœ",
    "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщъь", "αειουωη", "βγδζθκλμνξπρστφχψ", "άέίόύώή",
)
_HEX = ("0123456789abcdef",)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"\p{Lu}\p{Ll}+(?:[-'’]\p{Lu}\p{Ll}+)?"
# Of each type, what it looks like; types that come first win where several fit. Every expression is bounded or
# starts only where a run starts, so a long text without blanks costs no more than another one.
PATTERNS = {
    "email": r"(?<![\w.%+-])[\w.%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w-])",
    "access_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "hex_secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32}|[0-9A-F]{64}|[0-9A-F]{40}|[0-9A-F]{32})(?![A-Za-z0-9])",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])"
             r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?![\w-])",
    "card": r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "name": rf"(?<!\w)(?:{'|'.join(t for g in TITLES.values() for t in g)})\.? {_NAME}(?: {_NAME})?(?!\w)",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
TYPES = tuple(PATTERNS)


def entity_type(entity: Column) -> Column:
    """The first type whose expression fits a detected entity."""
    named = None
    for name, pattern in PATTERNS.items():
        fits = F.regexp_like(entity, F.lit(f"^(?:{pattern})$"))
        named = F.when(fits, F.lit(name)) if named is None else named.when(fits, F.lit(name))
    return named


def canonical(entity: Column, kind: Column) -> Column:
    """What makes two mentions the same entity: e-mails and names ignore case, numbers their punctuation."""
    digits = F.regexp_replace(entity, r"\D", "")
    return (
        F.when(kind.isin("ssn", "phone", "card"), digits)
        .when(kind == "name", F.lower(F.regexp_replace(entity, r"^\S+ ", "")))
        .otherwise(F.lower(entity)))


def _draw(key: str, kind: Column, step: str, seen: Column, size: Column | int) -> Column:
    """A keyed number below ``size`` that depends on what stands before."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, F.lit(step), seen), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 14), 16, 10).cast("bigint"), F.lit(size).cast("bigint"))


def _shifted(char: Column, seen: Column, key: str, kind: Column, step: str, classes: tuple[str, ...]) -> Column:
    """``char`` moved inside its class; characters of no class stay."""
    low = F.lower(char)
    moved = None
    for letters in classes:
        here = F.call_function("instr", F.lit(letters), low)
        target = F.substr(F.lit(letters), F.pmod(
            here - 1 + _draw(key, kind, step, seen, len(letters)), F.lit(len(letters))).cast("int") + 1, F.lit(1))
        moved = F.when(here > 0, target) if moved is None else moved.when(here > 0, target)
    moved = moved.otherwise(low)
    return F.when(char == low, moved).otherwise(F.upper(moved))


def _chain(chars: Column, key: str, kind: Column, step: str, classes: tuple[str, ...]) -> Column:
    """Each character of an array is moved by a keyed amount that depends on all letters and digits before it. The
    first is known from its image, then the second and so on: different inputs have different images.
    """
    empty = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("seen"))
    return F.aggregate(
        chars, empty,
        lambda state, c: F.struct(
            F.concat(state["out"], F.array(_shifted(c, state["seen"], key, kind, step, classes))).alias("out"),
            F.concat(state["seen"], F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")).alias("seen")),
        lambda state: state["out"])


def scramble(text: Column, key: str, kind: Column, classes: tuple[str, ...] = CLASSES) -> Column:
    """A keyed one-to-one map of strings that keeps format: forwards, then backwards, so that each letter depends on
    all others. Punctuation neither changes nor counts, and case is kept without counting.
    """
    there = _chain(F.split(text, ""), key, kind, ">", classes)
    back = _chain(F.reverse(there), key, kind, "<", classes)
    return F.array_join(F.reverse(back), "")


def _scrambled_ip(entity: Column, key: str) -> Column:
    """Octets move inside 0 to 255, forwards and backwards."""
    def chain(octets, step):
        empty = F.struct(F.array().cast("array<int>").alias("out"), F.lit("").alias("seen"))
        return F.aggregate(
            octets, empty,
            lambda s, o: F.struct(
                F.concat(s["out"], F.array(F.pmod(o + _draw(key, F.lit("ip"), step, s["seen"], 256), F.lit(256)).cast("int"))).alias("out"),
                F.concat_ws(".", s["seen"], o.cast("string")).alias("seen")),
            lambda s: s["out"])

    octets = F.transform(F.split(entity, r"\."), lambda o: o.cast("int"))
    moved = F.reverse(chain(F.reverse(chain(octets, ">")), "<"))
    return F.array_join(F.transform(moved, lambda o: o.cast("string")), ".")


def _luhn(digits: Column) -> Column:
    """The Luhn sum, modulo 10, of digits that a check digit will follow."""
    weighed = F.transform(F.reverse(F.split(digits, "")), lambda d, i: F.when(
        i % 2 == 0, d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)).otherwise(d.cast("int")))
    return F.pmod(F.aggregate(weighed, F.lit(0), lambda a, d: a + d), F.lit(10))


def _fill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    return F.aggregate(
        F.split(shape, ""), start,
        lambda s, c: F.struct(
            F.concat(s["out"], F.when(F.regexp_like(c, F.lit(r"^\d$")), F.substr(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"),
            (s["at"] + F.regexp_like(c, F.lit(r"^\d$")).cast("int")).alias("at")),
        lambda s: s["out"])


def _surrogate_card(entity: Column, key: str) -> Column:
    """The first digit (the network) stays; a valid check digit stays valid, a wrong one equally wrong."""
    digits = F.regexp_replace(entity, r"\D", "")
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    check = F.right(digits, F.lit(1)).cast("int")
    new = F.concat(F.substr(body, F.lit(1), F.lit(1)),
                   scramble(F.substr(body, F.lit(2)), key, F.concat(F.lit("card"), F.length(digits).cast("string"))))
    last = F.pmod(check + _luhn(body) - _luhn(new), F.lit(10)).cast("string")
    return _fill(entity, F.concat(new, last))


def _surrogate_phone(entity: Column, key: str) -> Column:
    """The last ten digits move, as one number in every notation; what stands before (the country) stays."""
    digits = F.regexp_replace(entity, r"\D", "")
    keep = F.greatest(F.length(digits) - 10, F.lit(0))
    own = F.substr(digits, keep + 1)
    return _fill(entity, F.concat(F.substr(digits, F.lit(1), keep), scramble(own, key, F.lit("phone"))))


def _surrogate_name(entity: Column, key: str) -> Column:
    """The title stays and with it the gender. A given name of a list becomes another one of its list; other names move
    inside script and kind of letter.
    """
    words = F.split(entity, " ")
    out = F.transform(F.slice(words, 2, 3), lambda w: _given(w, key))
    return F.concat(words[0], F.lit(" "), F.array_join(out, " "))


def _given(word: Column, key: str) -> Column:
    named = None
    for gender, names in GIVEN.items():
        at = F.array_position(F.array(*map(F.lit, names)), F.lower(word)).cast("int")
        other = F.initcap(F.element_at(F.array(*map(F.lit, names)), F.pmod(
            at + _draw(key, F.lit(gender), "given", F.lit(""), len(names) - 1), F.lit(len(names))).cast("int") + 1))
        named = F.when(at > 0, other) if named is None else named.when(at > 0, other)
    return named.otherwise(scramble(word, key, F.lit("name")))


def surrogate(entity: Column, kind: Column, key: str) -> Column:
    """The replacement of an entity: a function of its type, its canonical form and the key alone, so that mentions of
    one entity stay mentions of one entity in all documents; one-to-one for each type.
    """
    at = F.call_function("instr", entity, F.lit("@"))
    host = F.substr(entity, at + 1)
    top = F.regexp_extract(host, r"\.([^.]+)$", 1)
    email = F.concat(
        scramble(F.substr(entity, F.lit(1), F.length(entity) - F.length(top) - 1), key, F.lit("email")),
        F.lit("."), top)
    return (
        F.when(kind == "email", email)
        .when(kind == "access_key", F.concat(F.substr(entity, F.lit(1), F.lit(4)),
                                             scramble(F.substr(entity, F.lit(5)), key, kind)))
        .when(kind == "hex_secret", scramble(entity, key, kind, _HEX))
        .when(kind == "ip", _scrambled_ip(entity, key))
        .when(kind == "ssn", _fill(entity, scramble(F.regexp_replace(entity, r"\D", ""), key, kind)))
        .when(kind == "phone", _surrogate_phone(entity, key))
        .when(kind == "card", _surrogate_card(entity, key))
        .otherwise(_surrogate_name(entity, key)))


def with_surrogates(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` rewritten and ``_entities``: an array of (kind, canonical, replacement canonical) of
    the entities, in order. Texts without entities, and null ones, stay as they are.
    """
    text = F.col(text_col)
    found = F.transform(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)), lambda e: F.struct(
        e.alias("entity"), entity_type(e).alias("kind")))
    has = F.regexp_like(text, F.lit(ENTITY))
    marked = docs.withColumn("_found", F.when(has, found))
    replaced = marked.withColumn("_made", F.transform("_found", lambda e: F.struct(
        e["kind"].alias("kind"), canonical(e["entity"], e["kind"]).alias("canonical"),
        surrogate(e["entity"], e["kind"], key).alias("made"))))
    between = F.split(text, ENTITY, -1)
    joined = F.concat(between[0], F.array_join(F.zip_with(
        F.slice(between, F.lit(2), F.size(between)), F.col("_made"), lambda part, e: F.concat(e["made"], part)), ""))
    return replaced.withColumn(text_col, F.when(F.col("_found").isNotNull(), joined).otherwise(text)).withColumn(
        "_entities", F.transform("_made", lambda e: F.struct(
            e["kind"].alias("kind"), e["canonical"].alias("canonical"),
            canonical(e["made"], e["kind"]).alias("replacement")))).drop("_found", "_made")


def collisions(replaced: DataFrame) -> DataFrame:
    """(kind, replacement, originals): replacements that stand for more than one entity; none are expected."""
    return (
        replaced.where(F.col("_entities").isNotNull()).select(F.explode("_entities").alias("e")).select("e.*")
        .groupBy("kind", "replacement").agg(F.min("canonical").alias("_a"), F.max("canonical").alias("_b"))
        .where(F.col("_a") != F.col("_b")).select("kind", "replacement", F.array("_a", "_b").alias("originals")))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text_col``, and ``n_entities`` (long) and ``entity_kinds`` (sorted, joined by
    commas) added. All other columns stay.

    Replacements depend on the entity and the key alone; each type's map is one-to-one, and the result is checked over
    all rows: should two entities share a replacement, the query fails instead of merging them. Null and empty texts
    stay; repeated rows change alike; columns of the input named like the two added ones are replaced.
    """
    made = written(with_surrogates(docs.drop("n_entities", "entity_kinds"), key, text_col), "pii")
    clash = collisions(made).limit(1).collect()
    if clash:
        raise ValueError(f"{clash[0]['kind']}: one replacement stands for two entities")
    return made.withColumn(
        "n_entities", F.coalesce(F.array_size("_entities"), F.lit(0)).cast("bigint")
    ).withColumn("entity_kinds", F.coalesce(F.array_join(F.array_sort(F.array_distinct(
        F.transform("_entities", lambda e: e["kind"]))), ","), F.lit(""))).drop("_entities")
