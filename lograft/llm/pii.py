"""Personal data replaced by surrogates (operator 7); DataFrame functions only.

One pattern finds mail addresses, phone, card, social security and account numbers, IP
addresses and names after a title. An entity is a type and a normal form (lower case,
digits only, and so on), so all its mentions, however written, are one. Its surrogate
comes from a keyed hash of the type and normal form: every letter becomes a letter of
the same script and case (of a script without an alphabet below, a Latin one), every digit
a digit, other signs stay; vowels stay vowels, a
given name's last letter follows the gender that most of its titles in the corpus tell, the parts of a type that carry its format
(country code, top-level domain, issuer digit, check digit of card numbers) are kept.

A name found after a title, or after several, is replaced wherever its text has it, with a title
or not: full names in any case, single words where they begin with a capital. Its surrogate is
written in the case of the mention. Particles ("de la", "van der") and initials stay. A single word
is a given name if the text has it only as the first word of full names, else a family name.

Collision checks keep entities apart: of the entities that want one surrogate, one gets
it, and none that is itself an entity of the corpus or already given away; the others
try the next number of the hash. After ``PLAIN_ROUNDS`` tries a surrogate grows by a
sign, so that this ends whatever the formats leave free.

Only texts with a mention are shuffled; all others pass through in place.

Defined cases: a null text stays null and an empty one empty; equal texts get the same
text; repeated rows are each returned; mentions never overlap (leftmost first); an empty
table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lograft.llm.shared import cut, join_hot

PLAIN_ROUNDS = 12

# Titles and the gender that they tell (fixed values).
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Señora", "Sra", "госпожа", "κυρία"),
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "господин", "κύριος"),
    "u": ("Dr", "Prof"),
}
# Words that belong to a name but are none, and those that may follow them (fixed values).
PARTICLES = ("de", "del", "della", "dos", "du", "van", "von")
LOWER_PARTICLES = ("da", "di", "al", "bin", "ibn")  # given names when capitalised
SECOND_PARTICLES = ("la", "las", "los", "der", "den", "dem", "zu")
# Titles that mean something else in capitals, unless a point follows (fixed values).
CAPITALS_WITH_POINT = ("MS", "DR", "SR")
# Alphabets by script, upper and lower, vowels and consonants (fixed values).
ALPHABETS = {
    "latin": ("aeiou", "bcdfghjklmnpqrstvwxyz"),
    "latin marks": ("àáâäãåèéêëìíîïòóôöõùúûü", "çñß"),
    "greek": ("αεηιουω", "βγδζθκλμνξπρστφχψ"),
    "greek marks": ("άέήίόύώ", "ς"),
    "cyrillic": ("аеиоуыэюя", "бвгджзклмнпрстфхцчшщ"),
}
# a name's word, without a possessive 's
_NAME = r"\p{Lu}[\p{L}\p{M}]*+(?:(?!['’]s(?![\p{L}\p{M}]))['’-]++[\p{L}\p{M}]++)*+"


def _cases(words: tuple[str, ...]) -> list[str]:
    """Each word as it is, capitalised and in capitals."""
    return list(dict.fromkeys(w for word in words for w in (word, word[:1].upper() + word[1:], word.upper())))


def _titles(words: tuple[str, ...]) -> str:
    """A pattern for these titles."""
    plain = [t for t in _cases(words) if t not in CAPITALS_WITH_POINT]
    return "|".join([*plain, *(rf"{t}(?=\.)" for t in _cases(words) if t in CAPITALS_WITH_POINT)])


# one title or more; the words before or inside a name
_TITLE = r"(?:(?:" + "|".join(_titles(own) for own in TITLES.values()) + r")(?:\.? |\.(?=\p{Lu})))++"
_SMALL = [*_cases(PARTICLES), *LOWER_PARTICLES, *_cases(SECOND_PARTICLES)]
_INITIALS = r"(?:\p{Lu}\.)+"
_INSIDE = (
    r"(?:(?:" + "|".join([*_cases(PARTICLES), *LOWER_PARTICLES]) + r") (?:(?:" + "|".join(_cases(SECOND_PARTICLES)) + rf") )?|{_INITIALS} )"
)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_LETTERS = r"\p{L}\p{M}\p{N}"  # Java's \w is ASCII only
# Phone numbers: five pairs, area and number, a country code with any groups (8 to 15 digits), '/' after the area.
_PHONES = (
    r"(?:\+\d{1,3}[ .-]?(?:\(0\) ?)?\d{1,2}|0\d)(?:(?: \d{2}){4}|(?:\.\d{2}){4}|(?:-\d{2}){4})(?!\w)",
    r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,5}\)[ ./-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?!\w)",
    r"\+\d(?:[ ./-]?\(?\d\)?){7,14}(?!\w)",
    r"(?<![./-])(?:0\d{1,4}/ ?(?:\d{5,8}|\d{3,4}[ .-]\d{3,5}|\d{2}(?: \d{2}){2,3})|\d{3}/\d{3}[ ./-]\d{4})(?!\w)",
)
# Card numbers: four fours; 4-6-5 and 4-6-4 (without separators only where the issuer's digits tell them).
_CARDS = (
    r"\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}",
    r"\d{4}([ -])\d{6}\2\d{5}",
    r"3[47]\d{13}",
    r"3\d{3}([ -])\d{6}\3\d{4}",
)
# What each type looks like, in order of precedence (fixed values).
PATTERNS = {
    "email": rf"(?<![{_LETTERS}_.%+-])[{_LETTERS}_.%+-]++@[{_LETTERS}-]+(?:\.[{_LETTERS}-]+)+",
    "card": r"(?<![\w.-])(?:" + "|".join(_CARDS) + r")(?![\w-])",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "ip": r"(?<![\w.])" + rf"{_OCTET}(?:\.{_OCTET}){{3}}" + r"(?!\.?\w)",
    "phone": r"(?<![\w+])(?:" + "|".join(_PHONES) + ")",
    "name": rf"(?<![{_LETTERS}_]){_TITLE}{_INSIDE}{{0,3}}{_NAME}(?: {_INSIDE}{{0,3}}{_NAME})?",
}
_FIRST = "".join(sorted({t[0] for own in TITLES.values() for t in _cases(own)}))  # of the titles
# the card pattern's own groups are the first of all
ANY = "|".join(f"(?:{p})" for p in [PATTERNS["card"], *(p for k, p in PATTERNS.items() if k != "card")])


def has_entity(text: Column) -> Column:
    """Whether the text holds a mention. Each pattern is only tried on texts with a sign that it needs."""
    digits = "|".join(f"(?=[+(0-9])(?:{PATTERNS[k]})" for k in ("phone", "ip", "ssn"))
    return F.coalesce(
        (text.contains("@") & text.rlike(PATTERNS["email"]))
        | (
            text.rlike("[0-9]")
            & (text.rlike(digits) | text.rlike(r"(?=\d)" + PATTERNS["card"]) | text.rlike("(?=[A-Z])" + PATTERNS["iban"]))
        )
        | text.rlike(f"(?=[{_FIRST}])" + PATTERNS["name"]),
        F.lit(False),
    )


def _signs(text: Column) -> Column:
    """The characters of a text."""
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def type_of(mention: Column) -> Column:
    """The type of a mention, by its signs."""
    digits = F.length(F.regexp_replace(mention, r"\D", ""))
    return (
        F.when(mention.contains("@"), "email")
        .when(~mention.rlike(r"\d"), "name")
        .when(mention.rlike(r"^[A-Z]{2}\d{2}"), "iban")
        .when(mention.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(mention.rlike(r"^\d+(?:\.\d+){3}$"), "ip")
        .when((digits >= 14) & ~mention.startswith("+"), "card")  # phones without a country code are shorter
        .otherwise("phone")
    )


def _tokens(mention: Column) -> Column:
    """What a name has between blanks, without its titles."""
    return F.split(F.regexp_replace(mention, f"^{_TITLE}", ""), " ")


def _is_small(token: Column) -> Column:
    """Whether a token, not the last of its name, is a particle or initials."""
    return token.isin(_SMALL) | token.rlike(f"^{_INITIALS}$")


def _words(mention: Column) -> Column:
    """The words of a name, one or two, in lower case."""
    tokens = _tokens(mention)
    size = F.size(tokens)
    return F.transform(F.filter(tokens, lambda t, i: (i == size - 1) | ~_is_small(t)), F.lower)


def with_untitled(texts: DataFrame) -> DataFrame:
    """``texts (blob, gaps, found)`` with the names of ``found`` also found in the gaps, and ``givens``: the
    words that a text has only as the first of full names."""
    titled = F.filter("found", lambda m: type_of(m) == "name")
    texts = texts.withColumn("_names", F.transform(titled, _words))
    full = F.filter("_names", lambda n: F.size(n) > 1)
    texts = texts.withColumns({"_first": F.array_distinct(F.transform(full, lambda n: n[0])), "_last": F.transform(full, lambda n: n[1])})
    # names hold nothing that means something in a pattern
    each = F.concat(F.lit("(?iu:"), F.array_join(F.array_distinct(F.flatten("_names")), "|"), F.lit(rf")(?![{_LETTERS}_])"))
    both = F.concat(F.lit("(?iu:"), F.array_join("_first", "|"), F.lit(rf") {_INSIDE}{{0,3}}"), each, F.lit("|"))
    both = F.when(F.size("_first") > 0, both).otherwise("")
    own = F.concat(F.lit(rf"(?<![{_LETTERS}_])(?:"), both, F.lit(r"(?=\p{Lu})"), each, F.lit(")"))
    texts = texts.withColumn("_own", F.when(F.size("_names") > 0, own))
    gaps = F.flatten(F.transform("gaps", lambda g: F.split(g, F.col("_own"), -1)))
    # what a gap holds, then the mention that ends it; none ends the last
    inner = lambda g, i: F.concat(F.regexp_extract_all(g, F.col("_own"), F.lit(0)), F.slice("found", i + 1, F.lit(1)))
    found = F.flatten(F.transform("gaps", inner))
    return texts.select(
        "blob",
        F.when(F.col("_own").isNull(), F.col("gaps")).otherwise(gaps).alias("gaps"),
        F.when(F.col("_own").isNull(), F.col("found")).otherwise(found).alias("found"),
        F.array_except("_first", "_last").alias("givens"),
    )


def parts_of(mention: Column, kind: Column, givens: Column) -> Column:
    """The entities of a mention: type, normal form and, for given names, the gender that its title tells
    (1, -1 or 0). A mail address has two (the name at its domain, and the domain), a name one for each
    word, given names (of one word, those of ``givens``) apart from family names."""
    titles = F.regexp_extract(mention, f"^({_TITLE})", 1)
    tells = lambda g: titles.rlike(rf"(?<!\p{{L}})(?:{_titles(TITLES[g])})(?!\p{{L}})")
    gender = F.when(tells("f"), 1).when(tells("m"), -1).otherwise(0)
    words = _words(mention)
    entity = lambda kind, form, gender=F.lit(0): F.struct(F.lit(kind).alias("type"), form.alias("form"), gender.alias("gender"))
    given, family = F.array(entity("given", words[0], gender)), F.array(entity("family", F.element_at(words, -1)))
    name = F.when(F.size(words) > 1, F.concat(given, family)).when(F.array_contains(givens, words[0]), given).otherwise(family)
    low = F.lower(mention)
    local, domain = entity("email", low), entity("domain", F.substring_index(low, "@", -1))
    plain = F.regexp_replace(mention, r"[^\p{L}\d]", "")
    return (
        F.when(kind == "email", F.array(local, domain))
        .when(kind == "name", name)
        .when(kind == "ip", F.array(entity(kind, mention)))
        .otherwise(F.array(entity(kind, plain)))
    )


def _stream(key: str, kind: Column, form: Column, turn: Column) -> Column:
    """Two hex digits for each character of a form, from keyed hashes of as many blocks as it takes."""
    block = lambda k: F.sha2(F.concat_ws("\x1f", F.lit(key), kind, turn, k, form).cast("binary"), 256)
    return F.array_join(F.transform(F.sequence(F.lit(0), F.floor(F.length(form) / 32).cast("int")), block), "")


def _other_sign(sign: Column, number: Column) -> Column:
    """Another sign of the same class, chosen by a number; letters and digits of other scripts become
    Latin ones, other signs stay."""
    pick = lambda signs: F.substring(F.lit(signs), (number % len(signs) + 1).cast("int"), F.lit(1))
    out = F.when(sign.rlike(r"^\d$"), pick("0123456789"))
    for vowels, consonants in ALPHABETS.values():
        for signs in (vowels, consonants):
            out = out.when(F.lit(signs).contains(sign), pick(signs))
            upper = "".join(c.upper() for c in signs if len(c.upper()) == 1)
            out = out.when(F.lit(upper).contains(sign), pick(upper))
    plain = "".join(ALPHABETS["latin"])
    out = out.when(sign.rlike(r"^\p{Lu}$"), pick(plain.upper())).when(sign.rlike(r"^\p{L}$"), pick(plain))
    return out.when(sign.rlike(r"^\p{N}$"), pick("0123456789")).otherwise(sign)


def _luhn(digits: Column) -> Column:
    """The sum that is a multiple of ten for valid card numbers: every second digit from the right is doubled."""

    def step(acc: Column, x: Column) -> Column:
        twice = x["d"] * 2
        weighed = F.when((F.length(digits) - x["i"]) % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(x["d"])
        return acc + weighed

    numbered = F.transform(_signs(digits), lambda d, i: F.struct(d.try_cast("int").alias("d"), i.alias("i")))
    return F.aggregate(numbered, F.lit(0), step)


def with_surrogates(entities: DataFrame, key: str, turn: int) -> DataFrame:
    """``type, form, surrogate``: the surrogate of every normal form at the given try.

    One column after the other, each made from the last: nested in one expression, the
    plan would hold the inner ones many times over.
    """
    kind, form, swapped = F.col("type"), F.col("form"), F.col("surrogate")
    # how many leading and trailing signs are kept as they are
    lead = (
        F.when(kind.isin("card", "iban"), F.when((kind == "card") & (F.length(form) == 16), 1).otherwise(2))
        .when((kind == "phone") & (F.length(form) > 10), F.length(form) - 10)
        .otherwise(0)
    )
    tail = F.when(kind == "domain", F.length(F.substring_index(form, ".", -1)) + 1).otherwise(0)
    local = F.when(kind == "email", F.substring_index(form, "@", 1)).otherwise(form)

    def swap(sign: Column, i: Column) -> Column:
        number = F.conv(F.substring(F.col("_hex"), (2 * i + 1).cast("int"), F.lit(2)), 16, 10).cast("int")
        return F.when((i >= F.col("_lead")) & (i < F.col("_end")), _other_sign(sign, number)).otherwise(sign)

    def octet(o: Column, i: Column) -> Column:
        number = F.conv(F.substring(F.col("_hex"), (4 * i + 1).cast("int"), F.lit(4)), 16, 10).cast("int")
        size = F.length(o)
        least = F.when(size == 1, 0).when(size == 2, 10).otherwise(100)
        return (number % F.when(size == 1, 10).when(size == 2, 90).otherwise(156) + least).cast("string")

    rows = entities.select("type", "form", "gender", _stream(key, kind, form, F.lit(turn)).alias("_hex"), local.alias("_local"), lead.alias("_lead"), tail.alias("_tail"))
    rows = rows.withColumns({"_signs": _signs(F.col("_local")), "_end": F.length("_local") - F.col("_tail")})
    letters = F.array_join(F.transform("_signs", swap), "")
    rows = rows.withColumn(
        "surrogate", F.when(kind == "ip", F.array_join(F.transform(F.split(form, r"\."), octet), ".")).otherwise(letters)
    )
    # the last letter of a given name tells the gender
    vowels = "".join(v for v, _ in ALPHABETS.values())
    ends = {1: ("a", "α", "а"), -1: ("n", "ν", "н")}
    for g, signs in ends.items():
        last = F.substring(swapped, -1, 1)
        wrong = F.lit(vowels).contains(last) if g == -1 else ~last.isin(*signs)
        sign = F.when(last.rlike(r"\p{IsCyrillic}"), signs[2]).when(last.rlike(r"\p{IsGreek}"), signs[1]).otherwise(signs[0])
        changed = F.concat(F.substring(swapped, F.lit(1), F.length(swapped) - 1), sign)
        rows = rows.withColumn("surrogate", F.when((kind == "given") & (F.col("gender") == g) & wrong, changed).otherwise(swapped))
    # a valid card number stays valid
    rows = rows.withColumn("_valid", (kind == "card") & (_luhn(F.when(kind == "card", form)) % 10 == 0))
    rows = rows.withColumn("_stem", F.when(F.col("_valid"), F.substring(swapped, F.lit(1), F.length(swapped) - 1)))
    check = F.pmod(F.lit(10) - _luhn(F.concat("_stem", F.lit("0"))) % 10, F.lit(10)).cast("string")
    final = F.when(F.col("_valid"), F.concat("_stem", check)).otherwise(swapped)
    if turn >= PLAIN_ROUNDS:
        final = F.concat(final, F.lit(str(turn)))
    return rows.select("type", "form", final.alias("surrogate"))


def give_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``type, form, surrogate`` of the distinct ``entities (type, form)``; no two entities of a type share
    one, and none is itself an entity's form. ``gender``, if there: 1, -1 or 0 for given names."""
    if "gender" not in entities.columns:
        entities = entities.withColumn("gender", F.lit(0))
    taken_forms = entities.select("type", F.col("form").alias("surrogate"))
    pending, turn, given = entities, 0, None
    while True:
        wanted = cut(with_surrogates(pending, key, turn))
        free = wanted.join(taken_forms, ["type", "surrogate"], "left_anti")
        if given is not None:
            free = free.join(given.select("type", "surrogate"), ["type", "surrogate"], "left_anti")
        # one of those that want the same: the smallest form
        won = free.groupBy("type", "surrogate").agg(F.min("form").alias("form")).select("type", "form", "surrogate")
        given = cut(won if given is None else given.unionByName(won))
        pending = cut(pending.join(given.select("type", "form"), ["type", "form"], "left_anti"))
        turn += 1
        if pending.isEmpty():
            return given


def _in_case_of(word: Column, surrogate: Column) -> Column:
    """A surrogate with capitals where the word has them (letters whose capital is no single one stay)."""

    def cased(sign: Column, i: Column) -> Column:
        capital = F.substring(word, i + 1, F.lit(1)).rlike(r"^\p{Lu}$") & (F.length(F.upper(sign)) == 1)
        return F.when(capital, F.upper(sign)).otherwise(sign)

    return F.array_join(F.transform(_signs(surrogate), cased), "")


def _written(mention: Column, kind: Column, subs: Column) -> Column:
    """The surrogates of a mention's entities, written as the mention is."""
    digits = _signs(subs[0])
    letters = _signs(mention)
    # the k-th letter or digit of the mention becomes the k-th of the surrogate
    start = F.struct(F.lit(0).alias("k"), F.lit("").alias("out"))
    spread = F.aggregate(
        letters,
        start,
        lambda acc, c: F.struct(
            (acc["k"] + F.when(c.rlike(r"[\p{L}\d]"), 1).otherwise(0)).alias("k"),
            F.concat(acc["out"], F.when(c.rlike(r"[\p{L}\d]"), F.get(digits, acc["k"])).otherwise(c)).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.array_join(F.slice(digits, acc["k"] + 1, F.size(digits)), "")),
    )
    title = F.regexp_extract(mention, f"^({_TITLE})", 1)
    tokens = _tokens(mention)
    last = F.size(tokens) - 1
    name = F.transform(
        tokens,
        lambda t, i: F.when(i == last, _in_case_of(t, F.element_at(subs, -1))).when(_is_small(t), t).otherwise(_in_case_of(t, subs[0])),
    )
    return (
        F.when(kind == "email", F.concat_ws("@", subs[0], subs[1]))
        .when(kind == "name", F.concat(title, F.array_join(name, " ")))
        .when(kind == "ip", subs[0])
        .otherwise(spread)
    )


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text, n_entities, entities``: every text with its mentions replaced. ``entities``: type and
    replacement of each mention, in order."""
    docs = docs.select(id_col, F.col(text_col).alias("text"))
    has = has_entity(F.col("text"))
    entity = "array<struct<type:string,surrogate:string>>"
    clean = docs.where(~has).select(
        id_col, "text", F.lit(0).cast("long").alias("n_entities"), F.array().cast(entity).alias("entities")
    )
    marked = docs.where(has).withColumn("blob", F.sha2(F.col("text").cast("binary"), 256))
    texts = marked.select("blob", "text").dropDuplicates(["blob"]).select(
        "blob", F.split("text", ANY, -1).alias("gaps"), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)).alias("found")
    )
    texts = cut(with_untitled(texts))
    mentions = texts.select("blob", "givens", F.posexplode("found").alias("at", "mention")).withColumn("type", type_of(F.col("mention")))
    parts = cut(
        mentions.select(
            "blob", "at", "mention", F.col("type").alias("kind"),
            F.posexplode(parts_of(F.col("mention"), F.col("type"), F.col("givens"))).alias("part", "entity"),
        ).select("blob", "at", "mention", "kind", "part", "entity.type", "entity.form", "entity.gender")
    )
    entities = parts.groupBy("type", "form").agg(F.signum(F.sum("gender")).cast("int").alias("gender"))
    surrogates = give_surrogates(cut(entities), key)
    # a mention has at most two parts, a text's mentions are bounded by its length
    subs = parts.drop("gender").join(surrogates, ["type", "form"]).groupBy("blob", "at", "mention", "kind").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("part", "surrogate"))), lambda x: x["surrogate"]).alias("subs")
    )
    written = subs.select(
        "blob", "at", "kind", _written(F.col("mention"), F.col("kind"), F.col("subs")).alias("surrogate")
    )
    by_text = written.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("at", "kind", "surrogate"))).alias("subs"))
    pieces = F.zip_with("gaps", "subs", lambda g, s: F.concat(g, F.coalesce(s["surrogate"], F.lit(""))))
    named = F.transform("subs", lambda s: F.struct(s["kind"].alias("type"), s["surrogate"].alias("surrogate")))
    new = texts.join(by_text, "blob").select("blob", F.array_join(pieces, "").alias("text"), named.alias("entities"))
    replaced = join_hot(marked.drop("text"), new, "blob", id_col, salts=8)
    replaced = replaced.select(id_col, "text", F.size("entities").cast("long").alias("n_entities"), "entities")
    return clean.unionByName(replaced)
