"""Replace personal data by surrogates that keep type, format, script and gender.

Built-in functions only: no Python runs on the executors. A surrogate is a keyed hash in the shape of
what it replaces, so the same entity gets the same one everywhere without a table (coreference).
A check over all distinct entities finds surrogates that two entities share, or that are
themselves entities of the input; those entities are hashed again until none is (distinctness). Where a
format has too few values for that, short numbers get the values that are left, and the rest a longer form.
"""

from __future__ import annotations

from itertools import count as count_up

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.llm import _common as c
from strandloom.llm._common import let

#: Attempts in an entity's own format, before free values and longer forms.
NARROW = 8
#: Phone and other numbers of at most so many digits can be listed to find free values.
FREE_DIGITS = 9

# What is looked for, in the order in which it is tried at a place.
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Unbounded repeats of a group are possessive: then their matching is a loop, however long the text, and not a recursion.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++"
TOKEN_PREFIX = "AKIA|ASIA|AIza|sk-|gh[opsru]_|github_pat_|xox[abprs]-"
TOKEN = (
    r"(?<![\p{L}\p{N}_-])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|AIza[0-9A-Za-z_-]{35}|sk-[A-Za-z0-9_-]{20,200}|gh[opsru]_[A-Za-z0-9]{36,200}"
    r"|github_pat_[A-Za-z0-9_]{22,200}|xox[abprs]-[A-Za-z0-9-]{10,200})(?![\p{L}\p{N}_-])"
)
HEX = r"(?<![\p{L}\p{N}])(?=[0-9a-fA-F]{0,63}[0-9])[0-9a-fA-F]{32,64}(?![\p{L}\p{N}])"
IBAN = r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![\p{L}\p{N}])"
_H = "[0-9A-Fa-f]{1,4}"
_SHORT = "|".join(f"(?:{_H}:){{1,{7 - n}}}(?::{_H}){{1,{n}}}" for n in range(1, 7))
#: Eight groups, or fewer around "::" if one has three digits (a slice such as 1::2 in code has none).
IPV6 = (
    rf"(?<![\p{{L}}\p{{N}}:])(?:(?:{_H}:){{7}}{_H}|(?=[0-9A-Fa-f:]*[0-9A-Fa-f]{{3}})(?=[A-Fa-f:]*[0-9]|(?:[A-Fa-f]*:){{3}})"
    rf"(?:(?:{_H}:){{1,7}}:|{_SHORT}|:(?::{_H}){{2,7}}))(?![\p{{L}}\p{{N}}]|:[0-9A-Fa-f:]|\.\d)"
)
IPV4 = rf"(?<![\p{{L}}\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\p{{L}}\p{{N}}]|\.\d)"
CARD = r"(?<![\p{L}\p{N}])(?:\d{13,19}|\d{4}([ -])(?:\d{4}\1\d{4}\1\d{1,7}(?:\1\d{1,3})?|\d{6}\1\d{4,5}))(?![\p{L}\p{N}])"
SSN = r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])"
#: National forms: a leading 0, by pairs, in three parts or two, unbroken, or 00 and a country; then those of Russia and Spain.
_NATIONAL = (
    r"(?<!\d[.,:/-])(?:0\d(?:[ .-]\d{2}){4}|0\d{2,4}(?:[ /-]\d{2,3}){3,4}|0\d{1,4}[ .-]\d{3,4}[ .-]\d{3,4}|0\d{2,4}/\d{3,4}[ .-]\d{3,4}"
    r"|00\d{1,3}(?:[ .-]?\d{2,4}){2,5}|0\d{2,5}[ /-]\d{5,8}|0\d[ /-]\d{6,8}|\(0\d{1,5}\)[ .-]?\d{2,8}(?:[ .-]\d{2,4}){0,3}|0\d{8,11}"
    r"|8[ -]?(?:\(\d{3}\)|\d{3})[ -]?\d{3}[ -]\d{2}[ -]\d{2}|(?<!\d )[6-9]\d{2} (?:\d{3} \d{3}|\d{2} \d{2} \d{2})(?![ .,]\d))"
)
PHONE = (
    r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\+\d{1,3}[ .-]\d(?:[ .-]\d{2,4}){3,5}"
    rf"|\(\d{{2,4}}\) ?\d{{3,4}}[ .-]\d{{3,4}}|(?:1[ .-])?\d{{3}}[ .-]\d{{3}}[ .-]\d{{4}}|{_NATIONAL})(?![\p{{L}}\p{{N}}])"
)
MALE = "Mr Herr Hr Señor Sr Mister Monsieur Signor Sir Господин Κύριος"
FEMALE = "Mrs Ms Miss Frau Mme Mlle Madame Señora Señorita Sra Srta Signora Госпожа Κυρία"
NEUTRAL = "Dr Prof Mx"
_TITLES = "|".join(f"{MALE} {FEMALE} {NEUTRAL}".split())
_SPACE = r"[ \x{A0}]"
#: One title; M. needs its dot, a space, and a word that isn't an initial.
_TITLE = rf"(?:(?:{_TITLES})(?:\.{_SPACE}?|{_SPACE})|(?<!\p{{Lu}}\.)(?<!\p{{Lu}}\. )M\.{_SPACE}(?=\p{{Lu}}[\p{{L}}'’]|d['’]))"
#: A word of a name (Smith, SMITH, McDonald, O'Brien) or an initial without its dot, and what may stand before it in lower case. A title is no word: another name begins with it.
WORD = rf"(?!(?:{_TITLES})(?![\p{{L}}\p{{M}}]))" r"(?:\p{Lu}(?:['’]\p{L})?[\p{L}\p{M}]+|\p{Lu}(?![\p{L}\p{M}'’]))"
_LEAD = rf"(?:(?:van|von|vom|zu|zum|zur|der|den|ten|ter|de|del|della|di|da|do|dos|das|du|des|la|le|los|las|af|av|al|el|bin|ibn|y){_SPACE}|[dl]['’]){{0,3}}"
_JOIN = rf"(?:(?<=(?<![\p{{L}}\p{{M}}])\p{{Lu}})\.{_SPACE}?|{_SPACE}|-)"
#: Up to three titles and up to eight words.
NAME = rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE}){{1,3}}{_LEAD}{WORD}(?:{_JOIN}{_LEAD}{WORD}){{0,7}}(?!\p{{L}})"
KINDS = {"email": EMAIL, "token": TOKEN, "secret": HEX, "ipv6": IPV6, "iban": IBAN, "card": CARD, "ssn": SSN, "ipv4": IPV4, "phone": PHONE, "name": NAME}
#: All in one pattern; the back reference of a card is the pattern's only group.
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
#: Texts without a match of this have no entity; it is cheap to look for.
HINT = rf"[@0-9]|::|{TOKEN_PREFIX}|(?:{_TITLES}|M)(?:\.|{_SPACE})"
#: A word that may be one of a name without its title.
BARE = r"\p{Lu}(?:['’]\p{L})?[\p{L}\p{M}]++"
#: ANY, and such words where they are whole.
ANY_OR_BARE = rf"{ANY}|(?<![\p{{L}}\p{{M}}\p{{N}}]){BARE}(?![\p{{N}}])"

_HEX = "0123456789abcdef"
_CONSONANTS, _VOWELS = "bdfghklmnprstvzj", "aeiouaeiouaeioua"
# Letters of a Latin syllable in other scripts.
_LATIN = "bdfghklmnprstvzjaeiou"
_CYRILLIC = "бдфгхклмнпрствзйаеиоу"
_GREEK = "βδφγχκλμνπρστθζξαειου"


def kind_of(entity: Column) -> Column:
    """Which of KINDS a found entity is: the first that matches it whole."""
    out = F.lit("name")
    for kind, pattern in reversed(list(KINDS.items())):
        out = F.when(entity.rlike(rf"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def _title(entity: Column) -> Column:
    """The titles before a name, with the space after them; empty for a bare word."""
    return F.regexp_extract(entity, rf"^((?:{_TITLE}){{0,3}})", 1)


def _untitled(entity: Column) -> Column:
    return F.substring(entity, F.length(_title(entity)) + 1, F.length(entity))


def _words(entity: Column) -> Column:
    """The words and initials of a name after its titles, without what stands before them in lower case."""
    return F.regexp_extract_all(_untitled(entity), F.lit(WORD), F.lit(0))


def _title_gender(entity: Column) -> Column:
    one_of = lambda titles: rf"(?<!\p{{L}})(?:{'|'.join(titles.split())})(?!\p{{L}})"
    title = _title(entity)
    return F.when(title.rlike(one_of(FEMALE)), "f").when(title.rlike(one_of(MALE) + r"|^M\."), "m").otherwise("n")


def _groups(address: Column) -> Column:
    """An IPv6 address as eight groups of four digits."""
    side = lambda x: F.transform(F.filter(F.split(x, ":"), lambda g: g != ""), lambda g: F.lpad(g, 4, "0"))
    left, right = side(F.substring_index(address, "::", 1)), F.when(address.contains("::"), side(F.substring_index(address, "::", -1))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(left, F.array_repeat(F.lit("0000"), F.greatest(F.lit(0), 8 - F.size(left) - F.size(right))), right), ":")


def canonical(kind: Column, entity: Column) -> Column:
    """What all spellings of an entity share: digits alone, whole groups, or lower case without spaces; a token has one spelling."""
    digits = F.regexp_replace(entity, "[^0-9]", "")
    return F.when(kind == "token", entity).when(kind.isin("card", "phone", "ssn"), digits).when(kind == "ipv6", _groups(F.lower(entity))).otherwise(F.regexp_replace(F.lower(entity), " ", ""))


def _parts(entity: Column) -> Column:
    """The (kind, canonical) entities in what was found: one, or the words of a name.

    The last word of a name is a family name, of no gender; one before it is a given name of the title's gender.
    A letter alone is an initial.
    """
    kind = kind_of(entity)
    n = F.size(_words(entity))
    name_kind = lambda w, i: F.when(F.length(w) == 1, F.lit("initial")).when(i == n - 1, F.lit("family")).otherwise(F.concat(F.lit("given_"), _title_gender(entity)))
    words = F.transform(_words(entity), lambda w, i: F.struct(name_kind(w, i).alias("kind"), F.lower(w).alias("entity")))
    return let(kind, lambda k: F.when(k == "name", words).otherwise(F.array(F.struct(k.alias("kind"), canonical(k, entity).alias("entity")))))


def _stream(secret: str, kind: Column, entity: Column, attempt: Column) -> Column:
    """128 hexadecimal digits that depend on the secret, the kind, the entity and the attempt."""
    return F.sha2(F.concat_ws("\x1f", F.lit(secret), kind, entity, attempt.cast("string")), 512)


def _luhn_sum(digits: Column, first: int) -> Column:
    """The Luhn sum of digits, counted from the right; ``first``: 1 if the last is a check digit, else 0."""

    def worth(d: Column, i: Column) -> Column:
        v = d.cast("int")
        return F.when(i % 2 == first, F.when(v > 4, v * 2 - 9).otherwise(v * 2)).otherwise(v)

    each = F.transform(F.regexp_extract_all(F.reverse(digits), F.lit("([0-9])"), F.lit(1)), worth)
    return F.aggregate(each, F.lit(0), lambda a, b: a + b)


def _digits(kind: Column, entity: Column, stream: Column) -> Column:
    """As many digits as ``entity`` has: the first stays, and a number with a right check digit gets one."""
    decimals = F.translate(stream, _HEX, "0123456789724681")
    n = F.length(entity)
    made = F.concat(F.substring(entity, 1, 1), F.substring(decimals, F.lit(2), n - 1))
    body = F.substring(made, F.lit(1), n - 1)
    check = ((10 - _luhn_sum(body, 0) % 10) % 10).cast("string")
    return F.when((kind == "card") & (_luhn_sum(entity, 1) % 10 == 0), F.concat(body, check)).otherwise(made)


def _mod97(text: Column) -> Column:
    """The remainder by 97 of lower-case letters (10 to 35) and digits read as one number."""

    def step(a: Column, ch: Column) -> Column:
        v = F.instr(F.lit("0123456789abcdefghijklmnopqrstuvwxyz"), ch) - 1
        return F.when(v < 10, (a * 10 + v) % 97).otherwise((a * 100 + v) % 97).cast("int")

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _iban(entity: Column, made: Column) -> Column:
    """The country of ``entity`` and what follows the fourth character of ``made``, with check digits that are right."""
    country, rest = F.substring(entity, 1, 2), F.substring(made, F.lit(5), F.length(made))
    return let(rest, lambda r: F.concat(country, F.lpad((98 - _mod97(F.concat(r, country, F.lit("00")))).cast("string"), 2, "0"), r))


def _shape(text: Column, stream: Column, keep: int | Column = 0) -> Column:
    """Letters for letters and digits for digits, beyond the first ``keep`` characters; all else stays."""
    letters, decimals = F.translate(stream, _HEX, "acdefhkmnprtuvxz"), F.translate(stream, _HEX, "0123456789724681")

    def one(ch: Column, i: Column) -> Column:
        at = i % 128 + 1
        letter = F.substring(letters, at, F.lit(1))
        new = F.when(ch.rlike(r"\p{N}"), F.substring(decimals, at, F.lit(1))).when(ch.rlike(r"\p{Lu}"), F.upper(letter)).when(ch.rlike(r"\p{L}"), letter).otherwise(ch)
        return F.when(i < keep, ch).otherwise(new)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _octets(stream: Column) -> Column:
    byte = lambda i: F.conv(F.substring(stream, 2 * i + 1, 2), 16, 10).cast("int")
    return F.concat_ws(".", (byte(0) % 223 + 1).cast("string"), *[byte(i).cast("string") for i in (1, 2, 3)])


def _syllables(kind: Column, entity: Column, stream: Column, wide: Column) -> Column:
    """A pronounceable word in the entity's script; given names end as the gender asks."""
    pair = lambda i: F.concat(F.translate(F.substring(stream, 2 * i + 1, 1), _HEX, _CONSONANTS), F.translate(F.substring(stream, 2 * i + 2, 1), _HEX, _VOWELS))
    stem = F.concat(*[pair(i) for i in range(4)], F.when(wide, F.concat(*[pair(i) for i in range(4, 8)])).otherwise(F.lit("")))
    ending = F.when(kind == "given_f", "na").when(kind == "given_m", "n").when(kind == "family", "r").otherwise("l")
    latin = F.concat(stem, ending)
    script = F.when(entity.rlike(r"\p{IsCyrillic}"), F.translate(latin, _LATIN, _CYRILLIC)).when(entity.rlike(r"\p{IsGreek}"), F.translate(latin, _LATIN, _GREEK))
    return script.otherwise(latin)


def _initial(entity: Column, stream: Column) -> Column:
    """Another letter of the entity's script."""
    made = F.substring(_syllables(F.lit("initial"), entity, stream, F.lit(False)), 1, 1)
    letters = [_LATIN[:16], _CYRILLIC[:16], _GREEK[:16]]
    return F.when(made == entity, F.translate(made, "".join(letters), "".join(x[1:] + x[0] for x in letters))).otherwise(made)


def surrogate(kind: Column, entity: Column, secret: str, attempt: Column) -> Column:
    """The canonical surrogate of a canonical entity; from attempt NARROW on in a longer form of its format.

    Then e-mail addresses, numbers and IBANs get twelve more characters and names four more syllables, and an IPv4 address
    becomes one of eight groups. Other formats have values enough.
    """
    wide = attempt >= NARROW

    def of(stream: Column) -> Column:
        local, domain = F.substring_index(entity, "@", 1), F.regexp_extract(entity, "@([^.]+)", 1)
        rotated = F.concat(F.substring(stream, 65, 64), F.substring(stream, 1, 64))
        more = lambda digits: F.when(wide, F.translate(F.substring(stream, 109, 12), _HEX, digits)).otherwise(F.lit(""))
        groups = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.substring(stream, i * 4 + 1, F.lit(4))), ":")
        return (
            F.when(kind == "email", F.concat(_shape(local, stream), more("acdefhkmnprtuvxz"), F.lit("@"), _shape(domain, rotated), F.lit(".example")))
            .when(kind == "secret", F.substring(stream, F.lit(1), F.length(entity)))
            .when(kind == "ipv4", F.when(wide, groups).otherwise(_octets(stream)))
            .when(kind == "ipv6", groups)
            .when(kind == "token", _shape(entity, stream, F.length(F.regexp_extract(entity, f"^({TOKEN_PREFIX})", 1))))
            .when(kind == "iban", _iban(entity, F.concat(_shape(entity, stream), more("0123456789724681"))))
            .when(kind.isin("card", "phone", "ssn"), F.concat(_digits(kind, entity, stream), more("0123456789724681")))
            .when(kind == "initial", _initial(entity, stream))
            .otherwise(_syllables(kind, entity, stream, wide))
        )

    return let(_stream(secret, kind, entity, attempt), of)


def _spelled(kind: Column, entity: Column, new: Column) -> Column:
    """A canonical surrogate in the spelling of the entity found: its separators, and its case; what is longer follows."""
    gaps = F.split(entity, "[0-9]", -1)
    digits = F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.substring(new, i + 1, F.when(i < F.size(gaps) - 1, 1).otherwise(F.length(new))))), "")
    groups = F.array_join(F.transform(F.split(F.upper(entity), ""), lambda ch, i: F.when(ch == " ", ch).otherwise(F.substring(F.upper(new), i + 1 - F.length(F.regexp_replace(F.substring(entity, F.lit(1), i), "[^ ]", "")), F.lit(1)))), "")
    groups = F.concat(groups, F.substring(new, F.length(F.regexp_replace(entity, " ", "")) + 1, F.length(new)))
    shouted = F.when((entity == F.upper(entity)) & (entity != F.lower(entity)), F.upper(new)).otherwise(new)
    return F.when(kind.isin("card", "phone", "ssn"), digits).when(kind == "iban", groups).otherwise(shouted)


def _found(text: Column) -> Column:
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def entities(df: DataFrame, text: str = "text") -> DataFrame:
    """The distinct (kind, entity) of all texts, canonical; a grouping with a partial step.

    Initials are left out: there are too few letters for surrogates of their own.
    """
    each = df.select(F.explode_outer(_found(F.col(text))).alias("found")).where("found is not null").select(F.explode(_parts(F.col("found"))).alias("e"))
    return each.select("e.kind", "e.entity").where("kind <> 'initial'").distinct()


def _space(kind: Column) -> Column:
    """Kinds whose surrogates must differ from each other's and from each other's entities."""
    return F.when(kind.startswith("given_") | (kind == "family"), "name").otherwise(kind)


def _ranked(df: DataFrame, place: Column, what: str) -> DataFrame:
    """Add ``rank``: the number of rows of the same format that come before in the order of ``place``."""
    rows = df.withColumns({"place": F.concat_ws(":", "format", place), "one": F.lit(1)})
    rows = c.materialise(c.running_start(c.ordered_parts(rows, "place", what), "place", "one", [], "rank"), what)
    low = rows.groupBy("format").agg(F.min("rank").alias("low"))
    return rows.join(F.broadcast(low), "format").withColumn("rank", F.col("rank") - F.col("low")).drop("low", "place", "one", "part")


def _free(todo: DataFrame, taken: DataFrame, secret: str) -> DataFrame | None:
    """Short numbers of ``todo`` with a value of their format (first digit and length) that isn't in ``taken``, as far as there are any.

    Entities, in the order of a keyed hash, meet free values by rank.
    """
    n, first = F.length("entity"), F.substring("entity", 1, 1)
    short = todo.where(F.col("space").isin("phone", "ssn") & (n <= FREE_DIGITS)).withColumn("format", F.concat_ws("-", "space", n, first))
    formats = short.select("format", "space", n.alias("n"), first.alias("first")).distinct().collect()
    if not formats:
        return None
    values = None
    for length in sorted({f["n"] for f in formats}):
        own = todo.sparkSession.createDataFrame([(f["format"], f["space"], f["first"]) for f in formats if f["n"] == length], "format string, space string, first string")
        made = todo.sparkSession.range(10 ** (length - 1)).crossJoin(F.broadcast(own))
        made = made.select("format", "space", F.concat("first", F.lpad(F.col("id").cast("string"), length - 1, "0")).alias("surrogate"))
        values = made if values is None else values.unionByName(made)
    values = _ranked(values.join(taken, ["space", "surrogate"], "left_anti"), F.col("surrogate"), "free-values")
    short = _ranked(short, _stream(secret, F.col("kind"), F.col("entity"), F.lit("free")), "short-numbers")
    given = short.join(values.select("format", "rank", "surrogate"), ["format", "rank"])
    return c.materialise(given.select("kind", "entity", "space", "surrogate", "attempt"), "given-values")


def assign(found: DataFrame, secret: str) -> DataFrame:
    """(kind, entity, surrogate, attempt): surrogates that are distinct and are no entity of the input.

    Each round hashes again the entities whose surrogate another one has (all but the first of them, in the
    order of attempts and entities) or which is an entity; the rest keep theirs. After NARROW rounds short numbers
    get free values, and what is left gets longer forms, of which there are always enough. Rounds end when no entity is left.
    """
    known = c.materialise(found.withColumn("space", _space(F.col("kind"))), "entities")
    taken = known.select("space", F.col("entity").alias("surrogate")).distinct()
    todo, done = known.withColumn("attempt", F.lit(0)), None
    for attempt in count_up(1):
        made = todo.withColumn("surrogate", surrogate(F.col("kind"), F.col("entity"), secret, F.col("attempt")))
        first = F.row_number().over(Window.partitionBy("space", "surrogate").orderBy("kind", "entity"))
        made = made.withColumn("first", first == 1)
        clash = taken.withColumn("clash", F.lit(True))
        made = c.materialise(made.join(clash, ["space", "surrogate"], "left").withColumn("good", F.col("first") & F.col("clash").isNull()), "surrogates")
        good = made.where("good").select("kind", "entity", "space", "surrogate", "attempt")
        done = good if done is None else done.unionByName(good)
        todo = made.where("not good").select("kind", "entity", "space", (F.col("attempt") + 1).alias("attempt"))
        if todo.isEmpty():
            break
        taken = taken.unionByName(good.select("space", "surrogate"))
        given = _free(todo, taken, secret) if attempt == NARROW else None
        if given is not None:
            done, taken = done.unionByName(given), taken.unionByName(given.select("space", "surrogate"))
            todo = c.materialise(todo.join(given.select("kind", "entity"), ["kind", "entity"], "left_anti"), "without-value")
    return done.drop("space")


def replace(df: DataFrame, secret: str, text: str = "text", count: str = "n_entities") -> DataFrame:
    """``df`` with entities in ``text`` replaced by their surrogates, and their number in ``count``.

    Whole texts are searched. Null and empty texts stay as they are with no entities; equal texts get
    equal results; all columns stay, whatever their names (but one named ``count`` is replaced). Texts aren't shuffled, unless an entity
    that they hold was hashed more than once: then such texts, found by their hash, get its surrogate by a join.
    """
    again = c.materialise(assign(entities(df, text), secret).where("attempt > 0").select(F.concat_ws(":", "kind", "entity").alias("name"), "surrogate"), "again")
    rows = df.select(F.struct(*[F.col(f"`{x}`") for x in df.columns]).alias("row"), F.col(text).alias("t"))
    given = None
    if not again.isEmpty():
        # surrogates by text: only texts that hold an entity with more than one attempt
        # the hash is made before the rows of a text are many, and an outer explode doesn't search the text for a filter as well
        holds = df.select(F.col(text).alias("t")).where(F.col("t").rlike(HINT)).select(F.sha2("t", 256).alias("hash"), _found(F.col("t")).alias("found"))
        holds = holds.select("hash", F.explode_outer("found").alias("found")).where("found is not null").distinct()
        holds = holds.select("hash", F.explode(_parts(F.col("found"))).alias("e")).select("hash", F.concat_ws(":", "e.kind", "e.entity").alias("name")).distinct()
        wanted = holds.join(c.maybe_broadcast(again), "name").groupBy("hash").agg(F.map_from_entries(F.collect_list(F.struct("name", "surrogate"))).alias("given"))
        rows = rows.withColumn("hash", F.sha2("t", 256)).join(c.maybe_broadcast(c.materialise(wanted, "given")), "hash", "left")
        given = F.col("given")
    out = _replaced(rows, secret, given)
    kept = [F.col("changed").alias(x) if x == text else F.col(f"row.`{x}`").alias(x) for x in df.columns if x != count]
    return out.select(*kept, F.col("n").alias(count))


def _named_words(titled: Column) -> Column:
    """The words of all titled names as an array of (entity, at, kind), sorted, without initials; ``at`` is their order in the text."""
    each = F.transform(F.flatten(F.transform(titled, _parts)), lambda p, i: F.struct(p["entity"].alias("entity"), i.alias("at"), p["kind"].alias("kind")))
    return F.array_sort(F.filter(each, lambda p: F.length(p["entity"]) > 1))


def _look_up(names: Column, steps: Column, entity: Column) -> Column:
    """The first of ``names`` with this entity, or null, by binary search, so that a long text of many names takes no time by their square."""
    at = F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(names, at + s - 1)["entity"] < entity, at + s).otherwise(at))
    return let(F.get(names, at), lambda p: F.when(p["entity"] == entity, p))


def _replaced(rows: DataFrame, secret: str, given: Column | None) -> DataFrame:
    """``rows`` with ``changed``, their text ``t`` with surrogates, and ``n``, how many."""

    def made(kind: Column, entity: Column) -> Column:
        hashed = surrogate(kind, entity, secret, F.lit(0))
        return hashed if given is None else F.coalesce(given[F.concat_ws(":", kind, entity)], hashed)

    def new(entity: Column, bare: Column) -> Column:
        def named(parts: Column) -> Column:
            words = F.transform(parts, lambda p: made(p["kind"], p["entity"]))
            gaps = F.split(_untitled(entity), WORD, -1)
            loud = lambda w: (F.length(w) > 1) & (w == F.upper(w))
            cased = F.zip_with(_words(entity), words, lambda w, x: F.when(loud(w), F.upper(x)).otherwise(F.initcap(x)))
            return F.concat(_title(entity), F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(cased, i), F.lit("")))), ""))

        def other(parts: Column) -> Column:
            kind, name = parts[0]["kind"], parts[0]["entity"]
            return _spelled(kind, entity, made(kind, name))

        # a bare word is what it was where it has a title
        is_name = lambda p: p[0]["kind"].startswith("given_") | p[0]["kind"].isin("family", "initial")
        parts = F.when(bare.isNotNull(), F.array(F.struct(bare["kind"].alias("kind"), bare["entity"].alias("entity")))).otherwise(_parts(entity))
        return let(parts, lambda p: F.when(is_name(p), named(p)).otherwise(other(p)))

    t = F.col("t")
    out = rows.withColumn("found", _found(t))
    # names of the text; where there are any, words that may be theirs are found too and looked up
    out = out.withColumn("names", F.coalesce(_named_words(F.filter("found", lambda x: x.rlike(rf"^(?:{NAME})$"))), F.array().cast("array<struct<entity:string,at:int,kind:string>>")))
    steps = F.filter(F.array(*[F.lit(1 << i) for i in range(20, -1, -1)]), lambda s: s <= F.size("names"))
    out = out.withColumns({"steps": steps, "pattern": F.when(F.size("names") > 0, F.lit(ANY_OR_BARE)).otherwise(F.lit(ANY))})
    out = out.withColumn("found", F.when(F.size("names") > 0, F.regexp_extract_all(t, F.col("pattern"), F.lit(0))).otherwise(F.col("found")))

    def hit(x: Column) -> Column:
        bare = F.when(F.size("names") > 0, x.rlike(f"^{BARE}$")).otherwise(F.lit(False))
        name = F.when(bare, _look_up(F.col("names"), F.col("steps"), F.lower(x)))
        return let(name, lambda p: F.struct(x.alias("x"), p.alias("name"), (~bare | p.isNotNull()).alias("is_one")))

    out = out.withColumn("hits", F.transform("found", hit))
    put = lambda x, h: F.concat(x, F.when(h["is_one"], new(h["x"], h["name"])).otherwise(h["x"]))
    pieces = let(F.split(t, F.col("pattern"), -1), lambda s: F.transform(s, lambda x, i: F.when(i < F.size("hits"), put(x, F.get(F.col("hits"), i))).otherwise(x)))
    n = F.coalesce(F.size(F.filter("hits", lambda h: h["is_one"])), F.lit(0))
    return out.withColumn("n", n.cast("long")).withColumn("changed", F.when(F.col("n") > 0, F.array_join(pieces, "")).otherwise(t))
