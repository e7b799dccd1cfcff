"""PII: keyed surrogates for detected entities, with DataFrame functions only.

1. One regular expression finds the mentions of every text (e-mail and IP addresses, payment cards, phone,
   account and social security numbers, secrets, and runs of name words after a title or known first names).  A mention stands for one or
   more entities; digits alone identify a number, so that its spellings are one entity, and first and last names
   are entities of their own, so that "Mr. Smith" and "John Smith" stay one person.
2. Every distinct entity gets a surrogate from a keyed hash: letters become letters of the same script, case and kind
   (vowel or consonant), letters of other alphabets become letters of their script, digits become digits, all else stays; IP addresses stay valid, card numbers keep a valid check
   digit, first names come from the list of the same gender and script
   (an unlisted one after a title: names of the title's gender joined).
3. Collision checks: a surrogate that another entity of its type has as well, or that is some entity of the
   corpus, is drawn again with the next attempt, until none is left; after ``DRAWS`` attempts each further one is a character longer.
   No surrogate is made from its entity's characters.  So distinct entities stay distinct
   and each entity has one surrogate throughout.
4. Mentions meet their entities' surrogates in a join; a mention's own spelling (brackets, blanks, capitals) is
   filled with the surrogate's characters.  Only documents with mentions take part; the others pass.

The key decides the surrogates; without it they can't be linked to the originals.

Defined results: a null or empty text stays as it is with no mentions; rows that repeat an id are replaced one by
one, and alike; an empty table gives an empty table; ``replace_pii`` keeps other columns, and its result columns
``n_mentions`` and ``mentions`` replace input columns of these names; however often one entity occurs, it is counted
before it is joined.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import stage, table

#: First names by script and gender (fixed values): detected as such, and replaced within their list.
FIRST_NAMES = {
    ("latin", "f"): "Alice Anna Barbara Carla Claire Clara Elena Emma Eva Grace Hannah Helen Ines Isabel Jane Julia Karen Laura Linda Lucia Maria Marie Marta Mary Monika Nina Olivia Paula Sarah Sofia Susan Ursula".split(),
    ("latin", "m"): "Adam Alan Albert Andrew Antonio Carlos Charles Daniel David Edward Eric Frank George Hans Henry Jack Jacques James John Juan Karl Louis Luis Mark Michael Oliver Paul Peter Pierre Robert Thomas William".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Ирина Лариса Мария Наталья Ольга Светлана Татьяна".split(),
    ("cyrillic", "m"): "Алексей Андрей Борис Виктор Дмитрий Иван Михаил Николай Олег Павел Сергей Юрий".split(),
    ("greek", "f"): "Άννα Ελένη Ειρήνη Κατερίνα Μαρία Σοφία".split(),
    ("greek", "m"): "Αλέξανδρος Γιώργος Δημήτρης Κώστας Νίκος Πέτρος".split(),
}
#: Titles by gender (fixed values); the gender decides the list for a first name after it.
TITLES_BY_GENDER = {"m": "Mr Herr Monsieur Señor Господин Κύριος".split(), "f": "Mrs Ms Miss Frau Madame Señora Госпожа Κυρία".split(), "": "Dr Prof".split()}
TITLES = [t for titles in TITLES_BY_GENDER.values() for t in titles]
#: Small words inside names (fixed values); they stay.
PARTICLES = "van von der den de da di del della du dos das la le bin ibn al el ter ten zu zur".split()

_GIVEN = "|".join(n for names in FIRST_NAMES.values() for n in names)
_TITLED = rf"(?:(?:{'|'.join(TITLES)})\.? )+"
_INITIAL = r"\p{Lu}\.(?:-?\p{Lu}\.)*+"
#: A word with a capital, capitals, hyphens and apostrophes inside, without a genitive's ending.
_WORD = r"\p{Lu}(?:[\p{L}\p{M}]++|(?=['’-]))(?:['’-](?!s(?!\p{L}))[\p{L}\p{M}]++)*+"
#: Names that may follow one name, as many as there are.
_MORE = rf"(?: (?:(?:{'|'.join(PARTICLES)}) )*(?:{_INITIAL}|{_WORD}))"
#: Patterns by type, first match counts (Java regular expressions).
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{32,128}|(?:sk|pk|ghp|gho|xoxb|AKIA)[_-]?[0-9A-Za-z_-]{16,})(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)",
    "ssn": r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    "card": r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)",
    "phone": r"(?<!\d)(?:\+\d{1,3}[ .-]?)?(?:\(\d{1,4}\)[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){1,3}|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\d)|\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)",
    "name": rf"(?<!\p{{L}})(?=\p{{Lu}})(?:{_TITLED}(?:(?:{'|'.join(PARTICLES)}) )*(?:{_INITIAL}|{_WORD}){_MORE}*+|(?:{_GIVEN})(?![\p{{L}}\p{{M}}]){_MORE}++)(?![\p{{L}}\p{{M}}])",
}
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_NUMBERS = ("ssn", "card", "phone")
#: What can be found in a text without digits and at signs.
_WORDS_ONLY = "|".join(f"(?:{PATTERNS[k]})" for k in ("secret", "name"))

#: Alphabets by kind (fixed values): a letter is replaced within its kind.
ALPHABETS = ("aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "0123456789",
             "аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "АЕИОУЭЮЯ", "БВГДЖЗКЛМНПРСТФХЦЧШЩ",
             "αεηιουω", "βγδζθκλμνξπρστφχψ", "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ")
_ACCENTED = ("áàâäãåæéèêëíìîïóòôöõøœúùûüýÿ", "ñçšžßđłćč", "ÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕØÚÙÛÜÝ", "ÑÇŠŽĐŁĆČ")


#: A script with fewer letters (or figures) than this borrows the Latin ones; of a larger one than the second, so many common ones are drawn.
_FEWEST, _MOST = 8, 64
#: Draws of an entity's own form; each later one is a character longer than the one before.
DRAWS = 5


def _common(letter: str) -> bool:
    """Whether a sign of a large script is an everyday one: the older national character sets hold no others (of the
    Chinese one, the part for everyday signs)."""
    try:
        return letter.encode("gb2312") < b"\xd8" if "一" <= letter <= "鿿" else bool(letter.encode("euc_kr"))
    except UnicodeEncodeError:
        return False


def _other_letters() -> tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...], tuple[str, ...]]:
    """For the letters and figures that no alphabet above holds: those whose base letter one of ALPHABETS holds, by
    alphabet; and runs of code points of one script, as the first one of each in hexadecimal digits, with the capitals and
    the other signs to draw from."""
    known = set("".join(ALPHABETS + _ACCENTED))
    accented = [""] * len(ALPHABETS)
    scripts: dict[str, list[list[str]]] = {}
    runs: list[tuple[str, str]] = []
    for code in range(0x80, sys.maxunicode + 1):
        c = chr(code)
        kind = unicodedata.category(c)
        if kind[0] not in "LN" or c in known:
            continue
        base = next((k for k, a in enumerate(ALPHABETS) if unicodedata.normalize("NFKD", c)[0] in a), None)
        if base is not None:
            accented[base] += c
            continue
        script = unicodedata.name(c, "?").split(" ")[0] + kind[0]
        scripts.setdefault(script, [[], []])[kind not in ("Lu", "Lt")].append(c)
        if not runs or runs[-1][1] != script:
            runs.append((f"{code:06X}", script))
    own = {"LATINL": 0, "CYRILLICL": 5, "GREEKL": 9}
    targets = {}
    for script, (capitals, others) in scripts.items():
        k = own.get(script, 0)
        plain, large = ("0123456789",) * 2 if script[-1] == "N" else (ALPHABETS[k + 1], ALPHABETS[k + 3])
        enough = script not in own and len(others) >= _FEWEST
        if len(others) > _MOST:
            others.sort(key=lambda c: not _common(c))
        targets[script] = "".join(capitals[:_MOST]) if enough and len(capitals) >= _FEWEST else large, "".join(others[:_MOST]) if enough else plain
    return tuple(accented), tuple(r[0] for r in runs), tuple(targets[r[1]][0] for r in runs), tuple(targets[r[1]][1] for r in runs)


_MARKED, _RUNS, _RUN_CAPITALS, _RUN_OTHERS = _other_letters()


def _digest(key: str, kind: Column, entity: Column, attempt: Column) -> Column:
    """256 hexadecimal digits that only the key's holder can make."""
    base = F.concat_ws("\x1f", F.lit(key), kind, entity, attempt.cast("string"))
    return F.concat(F.sha2(base, 512), F.sha2(F.concat(base, F.lit("\x1f2")), 512))


def _draw(digest: Column, i: Column, n: int) -> Column:
    """A number below n from the digest's four digits at place i."""
    return (F.conv(F.substr(digest, (i % 63) * 4 + 1, F.lit(4)), 16, 10).cast("int") % n).cast("int")


def _other(c: Column) -> Column:
    """What to draw from for a letter that is in no alphabet: the letters of its script."""
    words = lambda x: F.split(F.lit(" ".join(x)), " ")
    code = F.lpad(F.hex(F.ascii(c)), 6, "0")
    run = F.size(F.filter(words(_RUNS), lambda r: r <= code))
    return F.when(F.lower(c) != c, F.element_at(words(_RUN_CAPITALS), run)).otherwise(F.element_at(words(_RUN_OTHERS), run))


def _letter(c: Column, i: Column, digest: Column, kinds) -> Column:
    def drawn_from(base: Column) -> Column:
        letters = F.when(c.rlike(r"[\p{L}\p{N}&&[^\x00-\x7F]]"), _other(c)) if kinds is ALPHABETS else F.lit(None).cast("string")
        for k in reversed(kinds):
            letters = F.when(F.instr(F.lit(k), base) > 0, F.lit(k)).otherwise(letters)
        return letters

    def drawn(letters: Column) -> Column:
        number = F.conv(F.substr(digest, (i % 63) * 4 + 1, F.lit(4)), 16, 10).cast("int") % F.length(letters)
        return F.coalesce(F.substr(letters, number.cast("int") + 1, F.lit(1)), c)

    # the long texts are bound once: repeated in the plan they would fill the driver
    base = F.array(F.translate(c, *_BASES) if kinds is ALPHABETS else c)
    return F.get(F.transform(F.transform(base, drawn_from), drawn), F.lit(0))


def _spelled(entity: Column, digest: Column, kinds) -> Column:
    return F.array_join(F.transform(F.split(entity, ""), lambda c, i: F.when(c == "", c).otherwise(_letter(c, i, digest, kinds))), "")


#: Letters with marks, and for each a letter of its alphabet.
_BASES = "".join(_ACCENTED) + "".join(_MARKED), "".join(a[0] * len(m) for m, a in zip((*_ACCENTED, *_MARKED), (*ALPHABETS[:4], *ALPHABETS), strict=True))
_ASCII = ALPHABETS[:5]
_DIGITS = ("0123456789",)
_HEX = ("0123456789", "abcdef", "ABCDEF")


def _luhn(digits: Column) -> Column:
    """Sum of a digit string by the card rule, its last digit counted once."""
    value = lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2).cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0))
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.coalesce(F.when(c == "", 0).otherwise(value(c, i)), F.lit(0))), F.lit(0), lambda a, b: a + b)


def surrogate(kind: Column, entity: Column, digest: Column, grown: Column) -> Column:
    """The surrogate of an entity in its own spelling, with ``grown`` more characters.  If there are any, signs are drawn
    too, so that even an entity of signs only leaves none of itself."""
    more = lambda x: F.repeat(F.lit(x), grown)
    signs = lambda x: F.when(grown > 0, F.regexp_replace(x, r"[^\p{L}\p{N}]", "e")).otherwise(x)
    digits = _spelled(F.concat(entity, more("0")), digest, _DIGITS)
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    check = ((10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")
    card = F.when(_luhn(entity) % 10 == 0, F.concat(body, check)).otherwise(digits)
    octets = F.array_join(F.transform(F.split(F.concat(entity, more(".0")), r"\."), lambda c, i: (_draw(digest, i, 254) + 1).cast("string")), ".")
    at = F.instr(entity, "@")
    # the local part and the first label of the domain change, the rest of the domain stays
    local = _spelled(F.concat(signs(F.substr(entity, F.lit(1), at - 1)), more("e")), digest, ALPHABETS)
    label = _spelled(signs(F.regexp_extract(entity, r"@([^.]*)", 1)), F.sha2(digest, 512), ALPHABETS)
    email = F.concat(local, F.lit("@"), label, F.regexp_extract(entity, r"@[^.]*(.*)$", 1))
    hexadecimal = _spelled(F.concat(entity, more("0")), digest, _HEX)
    secret = F.when(entity.rlike("^[0-9a-fA-F]+$"), hexadecimal).otherwise(F.concat(F.substr(entity, F.lit(1), F.lit(4)), _spelled(F.concat(signs(F.substr(entity, F.lit(5), F.length(entity))), more("e")), digest, _ASCII)))
    iban = F.concat(F.substr(entity, F.lit(1), F.lit(2)), _spelled(F.concat(F.substr(entity, F.lit(3), F.length(entity)), more("0")), digest, _ASCII))
    code = F.regexp_extract(entity, r"^(\+\d+ )?", 0)           # the country stays
    phone = F.concat(code, _spelled(F.concat(F.substr(entity, F.length(code) + 1, F.length(entity)), more("0")), digest, _DIGITS))
    # a name grows by letters of the kind of its last one
    name = _spelled(F.concat(entity, F.repeat(F.lower(F.regexp_extract(entity, r"(\p{L})[^\p{L}]*$", 1)), grown)), digest, ALPHABETS)
    return (F.when(kind == "email", email).when(kind == "ip", octets).when(kind == "card", card).when(kind == "secret", secret)
            .when(kind == "iban", iban).when(kind == "ssn", digits).when(kind == "phone", phone).otherwise(name))


def _kind(mention: Column) -> Column:
    out = F.lit("name")
    for kind, pattern in reversed([x for x in PATTERNS.items() if x[0] != "name"]):
        out = F.when(mention.rlike(f"^(?:{pattern})$"), kind).otherwise(out)
    return out


def _entities(mention: Column) -> Column:
    """The entities of a mention: (kind, entity, the gender that its title tells)."""
    kind = _kind(mention)
    title, bare = F.regexp_extract(mention, f"^{_TITLED}", 0), F.regexp_replace(mention, f"^{_TITLED}", "")
    gender = F.lit(None).cast("string")
    for g in "mf":
        gender = F.when(title.rlike(rf"^(?:.* )?(?:{'|'.join(TITLES_BY_GENDER[g])})\.? "), g).otherwise(gender)
    # the word after a title is a first name if another word follows
    led = (title != "") & bare.rlike(rf"^{_WORD} (?:.* )?{_WORD}$")
    role = lambda w, i: (F.when(w.isin(*PARTICLES), "particle").when(w.rlike(f"^{_INITIAL}$"), "initial").when(w.rlike(f"^(?:{_GIVEN})$"), "first")
                         .when(led & (i == 0), "given").otherwise("last"))
    words = F.transform(F.split(bare, " "), lambda w, i: F.struct(role(w, i).alias("kind"), w.alias("entity"), F.when(i == 0, gender).alias("gender")))
    code = F.regexp_extract(mention, r"^\+\d{1,3}(?=[^0-9])", 0)
    rest = F.regexp_replace(F.substr(mention, F.length(code) + 1, F.length(mention)), r"\D", "")
    phone = F.when(code != "", F.concat(code, F.lit(" "), rest)).otherwise(F.regexp_replace(mention, r"\D", ""))
    one = F.when(kind == "email", F.lower(mention)).when(kind == "phone", phone).when(kind.isin(*_NUMBERS), F.regexp_replace(mention, r"\D", "")).when(kind == "iban", F.regexp_replace(mention, " ", "")).otherwise(mention)
    return F.when(kind == "name", words).otherwise(F.array(F.struct(kind.alias("kind"), one.alias("entity"), F.lit(None).cast("string").alias("gender"))))


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(kind, entity, surrogate): distinct entities, each with a surrogate that no other entity of its kind has and
    that is no entity itself."""
    # a first name's gender is that of most of its titles
    side = F.when(F.col("gender") == "f", 1).when(F.col("gender") == "m", -1).otherwise(0)
    entities = stage(entities.groupBy("kind", "entity").agg(F.sum(side if "gender" in entities.columns else F.lit(0)).alias("side")), "entities")
    own = F.col("kind").isin("first", "initial", "particle")
    todo = entities.filter(~own).withColumn("attempt", F.lit(0))
    done = None
    digest = _digest(key, F.col("kind"), F.col("entity"), F.col("attempt"))
    draw = surrogate(F.col("kind"), F.col("entity"), digest, F.greatest(F.col("attempt") - (DRAWS - 1), F.lit(0)))
    draw = F.coalesce(F.when(F.col("kind") == "given", _given_name(F.col("entity"), F.col("side"), digest, F.col("attempt"))), draw)
    while True:
        drawn = todo.withColumn("surrogate", draw)
        # of entities that draw the same, the smallest keeps it; nobody takes a real entity's value or a taken one
        first = drawn.groupBy("kind", "surrogate").agg(F.min("entity").alias("holder"))
        checked = drawn.join(first, ["kind", "surrogate"]).join(entities.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("real")), ["kind", "surrogate"], "left")
        if done is not None:
            checked = checked.join(done.select("kind", "surrogate", F.lit(True).alias("taken")), ["kind", "surrogate"], "left")
        else:
            checked = checked.withColumn("taken", F.lit(None).cast("boolean"))
        checked = stage(checked.withColumn("good", (F.col("entity") == F.col("holder")) & F.col("real").isNull() & F.col("taken").isNull()), "surrogates")
        good = checked.filter("good").select("kind", "entity", "surrogate")
        done = good if done is None else done.union(good)
        # those whose form has no free value left draw longer ones, so the values never run out
        todo = checked.filter("not good").select("kind", "entity", "side", (F.col("attempt") + 1).alias("attempt"))
        if todo.isEmpty():
            break
    kept = F.when(F.col("kind") == "first", _first_name(F.col("entity"), key)).when(F.col("kind") == "initial", _initials(F.col("entity"), key)).otherwise(F.col("entity"))
    return done.union(entities.filter(own).select("kind", "entity", kept))


def _initials(initials: Column, key: str) -> Column:
    """Initials in an alphabet turned by a keyed step, so distinct ones stay distinct."""
    import hashlib
    source = target = ""
    for first, last in (("A", "Z"), ("А", "Я"), ("Α", "Ρ"), ("Σ", "Ω")):
        letters = [chr(c) for c in range(ord(first), ord(last) + 1)]
        ranked = sorted(letters, key=lambda c: hashlib.sha256(f"{key}\x1finitial\x1f{c}".encode()).digest())
        source, target = source + "".join(ranked), target + "".join(ranked[1:] + ranked[:1])
    turned = F.translate(initials, source, target)
    return F.when(turned != initials, turned).otherwise(F.regexp_replace(initials, r"\p{Lu}", target[0]))


def _given_name(name: Column, side: Column, digest: Column, attempt: Column) -> Column:
    """Names of the script's and gender's list joined by hyphens, as the list's own names stand for each other: two, and
    one more after each ``DRAWS`` attempts; null without a gender or list."""
    def joined(names: list[str]) -> Column:
        own = F.split(F.lit(" ".join(names)), " ")
        return F.array_join(F.transform(F.sequence(F.lit(0), F.least((attempt / DRAWS).cast("int") + 1, F.lit(62))), lambda i: F.element_at(own, _draw(digest, i, len(names)) + 1)), "-")
    out = F.lit(None).cast("string")
    for script, signs in (("latin", r"\p{IsLatin}"), ("cyrillic", r"\p{IsCyrillic}"), ("greek", r"\p{IsGreek}")):
        for gender, sign in (("f", 1), ("m", -1)):
            out = F.when(name.rlike(signs) & (F.signum(side) == sign), joined(FIRST_NAMES[script, gender])).otherwise(out)
    return out


def _first_name(name: Column, key: str) -> Column:
    """Another name of the same list.  Lists are turned by a keyed step, so distinct names stay distinct."""
    import hashlib
    out = {}
    for (script, gender), names in FIRST_NAMES.items():
        ranked = sorted(names, key=lambda n: hashlib.sha256(f"{key}\x1f{script}\x1f{gender}\x1f{n}".encode()).digest())
        out |= {n: ranked[(i + 1) % len(ranked)] for i, n in enumerate(ranked)}
    return F.create_map(*[F.lit(x) for pair in out.items() for x in pair])[name]


def _filled(mention: Column, kind: Column, values: Column) -> Column:
    """The mention's own spelling with the surrogate's characters."""
    def poured(other: str) -> Column:
        value = F.regexp_replace(F.element_at(values, 1), other, "")
        before = lambda i: F.length(F.regexp_replace(F.substr(mention, F.lit(1), i + 1), other, ""))
        full = F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(c.rlike(other), c).otherwise(F.substr(value, before(i), F.lit(1)))), "")
        # a number that had to grow is written as it is
        return F.when(F.length(value) == F.length(F.regexp_replace(mention, other, "")), full).otherwise(F.element_at(values, 1))
    title = F.regexp_extract(mention, f"^{_TITLED}", 0)
    return (F.when(kind.isin(*_NUMBERS), poured(r"[^0-9]")).when(kind == "iban", poured(r"[^0-9A-Z]"))
            .when(kind == "name", F.concat(title, F.array_join(values, " "))).otherwise(F.element_at(values, 1)))


def replace_pii(docs: DataFrame, key: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All rows and columns with the text's entities replaced, ``n_mentions`` and ``mentions``: the number, and the
    number of each type."""
    names = [c for c in docs.columns if c.lower() not in ("n_mentions", "mentions")]
    text = F.coalesce(F.col(text_column), F.lit(""))
    mentions = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(_ANY), F.lit(0))).otherwise(F.regexp_extract_all(text, F.lit(_WORDS_ONLY), F.lit(0)))
    found = docs.select(*names, mentions.alias("_found"), F.xxhash64(id_column, text_column).alias("_row"))
    some = stage(found.filter(F.size("_found") > 0), "mentions")
    none = found.filter(F.size("_found") == 0)
    mentions = some.select("_row", F.explode(F.array_distinct("_found")).alias("mention")).distinct()
    spelled = mentions.select("mention").distinct().withColumn("entities", _entities(F.col("mention"))).select("mention", F.posexplode("entities").alias("place", "e")).select("mention", "place", "e.kind", "e.entity", "e.gender")
    spelled = stage(spelled, "spelled")
    values = spelled.drop("gender").join(surrogate_table(spelled, key), ["kind", "entity"]).groupBy("mention").agg(F.sort_array(F.collect_list(F.struct("place", "surrogate"))).alias("v"))
    kind = _kind(F.col("mention"))
    replaced = values.select("mention", kind.alias("kind"), _filled(F.col("mention"), kind, F.col("v.surrogate")).alias("new"))
    by_row = mentions.join(replaced, "mention").groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("mention", F.struct("new", "kind")))).alias("_new"))
    gaps = F.split(F.col(text_column), _ANY, -1)
    put = F.transform("_found", lambda m: F.col("_new")[m]["new"])
    whole = F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(put, i), F.lit("")))), "")
    kinds = F.transform("_found", lambda m: F.col("_new")[m]["kind"])
    of_kind = lambda k: F.size(F.filter(kinds, lambda x: x == k))
    counts = F.create_map(*[x for k in PATTERNS for x in (F.lit(k), of_kind(k))])
    changed = some.join(by_row, "_row").select(*[whole.alias(c) if c == text_column else F.col(c) for c in names], F.size("_found").cast("long").alias("n_mentions"), counts.alias("mentions"))
    nothing = F.create_map(*[x for k in PATTERNS for x in (F.lit(k), F.lit(0))])
    return changed.union(none.select(*names, F.lit(0).cast("long").alias("n_mentions"), nothing.alias("mentions")))


def op1_surrogates(spark, sf_dir: str) -> DataFrame:
    """Every document's text with surrogates, and its number of mentions."""
    out = replace_pii(table(spark, sf_dir, "documents"), key="query key, not a secret")
    return out.select("doc_id", "text", "n_mentions", *[F.col("mentions")[k].alias(f"n_{k}") for k in PATTERNS])
