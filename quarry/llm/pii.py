"""Surrogates for personal data, with DataFrame functions only.

Detected entities get replacements of the same type and format: each letter or digit gives way to one of its kind, drawn
from a keyed digest of the entity's canonical form (so spellings of one entity stay one entity), IPv4 octets stay
octets of as many digits, a number that passes the Luhn check and an IBAN that passes its own still do, and names get
names of the same gender and script. A name has two parts, given name and surname, each an entity of its own: whoever
shares a surname still does. All distinct entities of the table are checked together, whatever their types: where two
of them share a replacement, or a replacement is itself an entity of the table, all but one draw again until every
replacement stands for one entity. Where `NARROW` draws in an entity's format all collided, that format counts as
exhausted: the next draws come from wider ones, each attempt one character longer (names: a syllable; IPv4: octets of
any length), so the search always ends.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import without, written

#: Titles that tell a gender (f, m) or none (n), replacement given names by script and gender, and further
#: given names by which a name without a title is known.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Г-жа"),
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Г-н"),
    "n": ("Dr", "Prof", "Doctor", "Professor"),
}
GIVEN = {
    ("latin", "f"): ("Anna", "Clara", "Diana", "Elena", "Flora", "Greta", "Helen", "Irene", "Julia", "Karin", "Laura", "Marta", "Nora", "Paula", "Rosa", "Vera"),
    ("latin", "m"): ("Adam", "Bruno", "Carlo", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Martin", "Oscar", "Paul", "Victor"),
    ("latin", "n"): ("Alex", "Andrea", "Chris", "Dominique", "Jamie", "Kim", "Lee", "Morgan", "Nikita", "Noa", "Pat", "Robin", "Sam", "Sasha", "Toni", "Yael"),
    ("cyrillic", "f"): ("Анна", "Вера", "Дарья", "Елена", "Жанна", "Зоя", "Инна", "Ирина", "Клара", "Лидия", "Мария", "Нина", "Ольга", "Полина", "Раиса", "Софья"),
    ("cyrillic", "m"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Игорь", "Кирилл", "Лев", "Марк", "Олег", "Павел", "Роман", "Семён", "Юрий"),
    ("cyrillic", "n"): ("Женя", "Никита", "Саша", "Слава", "Шура", "Валя", "Тоня", "Ася"),
}
KNOWN = {
    "f": ("Alice", "Amy", "Barbara", "Carol", "Catherine", "Christine", "Deborah", "Elizabeth", "Emily", "Emma", "Erika", "Fatima", "Jane", "Jennifer", "Jessica", "Karen", "Linda", "Lisa", "Margaret", "Maria", "Mary", "Michelle", "Nancy", "Patricia", "Rebecca", "Ruth", "Sandra", "Sarah", "Sophie", "Susan"),
    "m": ("Ahmed", "Andrew", "Anthony", "Brian", "Charles", "Daniel", "Edward", "George", "Hans", "Henry", "James", "Jason", "John", "Joseph", "Kevin", "Matthew", "Michael", "Mohammed", "Peter", "Richard", "Robert", "Ryan", "Scott", "Stephen", "Steven", "Thomas", "Timothy", "Walter", "William", "José"),
}
#: Syllables of replacement surnames.
SYLLABLES = {
    "latin": ("ba", "ber", "do", "dal", "fen", "gar", "hol", "ka", "lin", "mor", "nes", "per", "ros", "sten", "tal", "wen"),
    "cyrillic": ("ба", "бер", "до", "дал", "фен", "гар", "хол", "ка", "лин", "мор", "нес", "пер", "рос", "стен", "тал", "вен"),
}
#: Draws in an entity's own format before wider ones are tried; for given names, of which there are few.
NARROW, NARROW_GIVEN = 16, 2
_ALL_TITLES = "|".join(t for ts in TITLES.values() for t in ts)
_FIRST = {g: [n for (_, of), names in GIVEN.items() if of == g for n in names] + list(KNOWN.get(g, ())) for g in "fmn"}
_ALL_FIRST = "|".join(n for g in "fm" for n in _FIRST[g])
_PAIR = r"\p{Lu}[\p{L}-]*+\.? \p{Lu}"
_CAPITAL = r"\p{Lu}\p{Ll}++(?![\p{L}])"
_H = "[0-9A-Fa-f]{1,4}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: Patterns by type, in the order in which they are tried at a place. What has no length of its own has no upper bound:
#: possessive quantifiers keep a run linear. A keyed secret may hold dots and pads (JWT), but ends before a final dot.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    "secret": r"(?<![0-9A-Za-z])(?:(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![0-9A-Za-z])|(?:AKIA[0-9A-Z]{16}|sk-[0-9A-Za-z]{20,}+|gh[pousr]_[0-9A-Za-z]{36,}+)(?![0-9A-Za-z])|(?<=(?i:token|secret|password|passwd|api_key|api-key|apikey)[ ]?[=:][ ]?[\"']?)(?=[0-9A-Za-z_+/~.=-]{8})[0-9A-Za-z_+/~-]++(?:[0-9A-Za-z_+/~=-]++|\.++(?=[0-9A-Za-z_+/~=-]))*+)",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "ipv6": rf"(?<![0-9A-Za-z:.])(?:(?:{_H}:){{7}}{_H}|(?:{_H}:){{2,6}}(?::{_H}){{1,5}}|[Ff][Ee]80:(?::{_H}){{1,4}})(?![0-9A-Za-z:])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}|\(\d{3}\) ?\d{3}[.-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "number": r"(?<![\d.,])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{13,19})(?!\d)",
    "street": r"(?<![\p{L}\d])\d{1,5}[a-z]? (?:\p{Lu}\p{Ll}++ ){1,3}(?:Street|Road|Avenue|Lane|Drive|Boulevard|Square|St|Rd|Ave)(?![\p{L}])|(?<![\p{L}])\p{Lu}\p{Ll}*(?:straße|strasse|weg|platz|allee) \d{1,5}[a-z]?(?![\p{L}\d])",
    "name": rf"(?<![\p{{L}}])(?={_PAIR})(?:(?:{_ALL_TITLES})\.? {_CAPITAL}(?: {_CAPITAL})?|(?:{_ALL_FIRST}) {_CAPITAL})",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
TYPES = tuple(PATTERNS)
_TITLES = [t for ts in TITLES.values() for t in ts]
#: What every entity holds a part of; a text without a match has none, and the long pattern need not run. Names are looked
#: for only where a word with a capital comes before another.
GATE = rf"[0-9@=:]|(?<![\p{{L}}])(?={_PAIR})(?:{_ALL_TITLES}|{_ALL_FIRST})\.? \p{{Lu}}|[A-Fa-f]{{32}}|AKIA|sk-|gh[pousr]_"


def entities(text: Column) -> Column:
    """The entities of a text in order."""
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(text.rlike(GATE), F.lit(False)), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(none)


def kind(entity: Column) -> Column:
    """Type of a detected entity: the first whose pattern it is as a whole."""
    shape = F.when(entity.contains("@"), F.lit("email"))
    shape = shape.when(entity.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"), F.lit("ip"))
    shape = shape.when(entity.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.lit("ssn"))
    shape = shape.when(entity.rlike(r"^(?:\d{13,19}|\d{4}([ -]\d{4}){3})$"), F.lit("number"))
    shape = shape.when(entity.rlike(r"^(?:\+\d|\(\d{3}\)|\d{3}[.-]\d{3}[.-]\d{4}$)"), F.lit("phone"))
    for name in ("iban", "ipv6", "street"):
        shape = shape.when(entity.rlike(rf"^(?:{PATTERNS[name]})$"), F.lit(name))
    return shape.when(entity.rlike(rf"^(?:(?:{_ALL_TITLES})\.?|{_ALL_FIRST}) \p{{Lu}}"), F.lit("name")).otherwise(F.lit("secret"))


def canonical(entity: Column, kind_of: Column) -> Column:
    """What spellings of one entity share."""
    bare = F.when(kind_of.isin("phone", "ssn", "number"), F.regexp_replace(entity, r"\D", ""))
    return bare.when(kind_of == "iban", F.regexp_replace(entity, " ", "")).otherwise(F.lower(entity))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _piece(title: Column, kind_of: Column, part: Column) -> Column:
    return F.struct(title.alias("title"), kind_of.alias("kind"), canonical(part, kind_of).alias("canon"), part.alias("part"))


def _of_name(entity: Column) -> Column:
    """The given name, if there is one, and the surname of a name; types of the two by script and gender."""

    def told(x: Column) -> Column:
        title, given = F.when(x["titled"], x["w"][0]), F.when(~x["titled"], x["w"][0]).when(F.size(x["w"]) > 2, x["w"][1])
        gender = F.when(x["titled"] & x["bare"].isin(*TITLES["f"]), "f").when(x["titled"] & x["bare"].isin(*TITLES["m"]), "m").when(given.isin(*_FIRST["f"]), "f").when(given.isin(*_FIRST["m"]), "m").otherwise("n")
        script = F.when(x["last"].rlike("[А-Яа-яЁё]"), F.lit("cyrillic")).otherwise(F.lit("latin"))
        return F.struct(title.alias("title"), given.alias("given"), gender.alias("gender"), script.alias("script"), x["last"].alias("last"))

    def pieces(x: Column) -> Column:
        first = _piece(x["title"], F.concat_ws(" ", F.lit("given"), x["script"], x["gender"]), x["given"])
        return F.filter(F.array(first, _piece(x["title"], F.concat_ws(" ", F.lit("surname"), x["script"]), x["last"])), lambda p: p["part"].isNotNull())

    bare = lambda w: F.regexp_replace(w[0], r"\.$", "")
    titled = lambda w: bare(w).isin(*_TITLES) & ((F.size(w) > 2) | ~w[0].isin(*_FIRST["f"], *_FIRST["m"]))
    cut = _let(F.split(entity, " "), lambda w: F.struct(w.alias("w"), bare(w).alias("bare"), titled(w).alias("titled"), F.element_at(w, -1).alias("last")))
    return _let(_let(cut, told), pieces)


def parts(entity: Column) -> Column:
    """array<struct<title, kind, canon, part>>: what an entity is replaced by; a name has a title, which stays, and up to
    two parts, others are one."""
    plain = lambda x: F.array(_piece(F.lit(None).cast("string"), x["k"], x["e"]))
    return _let(F.struct(entity.alias("e"), kind(entity).alias("k")), lambda x: F.when(x["k"] == "name", _of_name(x["e"])).otherwise(plain(x)))


def _draw(digest: Column, i: Column) -> Column:
    """The i-th number from 0 to 255 of a 128-digit hexadecimal digest, read round and round."""
    return F.conv(digest.substr((2 * (i % 64) + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _as(ch: Column, n: Column, hexadecimal: Column) -> Column:
    """A character of the kind of `ch`, chosen by n; others stay."""
    digits, low, up = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    small, great = "абвгдежзиклмнопрстуфхцчшэюя", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"
    of = F.when(ch.rlike("[0-9]"), digits).when(hexadecimal & ch.rlike("[a-f]"), "abcdef").when(hexadecimal & ch.rlike("[A-F]"), "ABCDEF")
    of = of.when(ch.rlike(r"[а-яё]"), small).when(ch.rlike(r"[А-ЯЁ]"), great).when(ch.rlike(r"\p{Ll}|\p{Lo}"), low).when(ch.rlike(r"\p{Lu}"), up).otherwise(ch)
    return _let(of, lambda letters: F.substr(letters, (n % F.length(letters) + 1).cast("int"), F.lit(1)))


def _like(entity: Column, digest: Column, skip: Column, hexadecimal: Column) -> Column:
    """`entity` with each letter and digit but the first `skip` of them drawn again. Marks between do not count, so
    spellings with different marks get the same draws."""
    bare = F.split(F.regexp_replace(entity, r"[^\p{L}\p{N}]", ""), "")
    drawn = F.transform(bare, lambda c, i: F.when(i < skip, c).otherwise(_as(c, _draw(digest, i), hexadecimal)))
    marks = F.split(entity, r"[\p{L}\p{N}]", -1)
    return F.array_join(F.zip_with(marks, F.concat(drawn, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")


def _luhn(digits: Column) -> Column:
    """Sum of the Luhn check over a string of digits; valid where it is a multiple of ten."""
    turned = F.split(F.reverse(digits), "")
    each = F.transform(turned, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((2 * c.cast("int")) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _number(drawn: Column) -> Column:
    """A drawn number with its last digit set so that the Luhn check is valid."""
    bare = lambda x: F.regexp_replace(x, r"\D", "")
    head = F.regexp_extract(drawn, r"(?s)^(.*)\d(\D*)$", 1)
    check = ((10 - _luhn(F.concat(bare(head), F.lit("0"))) % 10) % 10).cast("string")
    return F.concat(head, check)


def _octets(entity: Column, digest: Column, wide: Column) -> Column:
    """Octets drawn again among those of as many digits, or among all."""
    parts = F.split(entity, r"\.")
    drawn = lambda i: _draw(digest, 2 * i)
    one = lambda p, i: F.when(wide, drawn(i)).when(F.length(p) == 3, 100 + (drawn(i) * 256 + _draw(digest, 2 * i + 1)) % 156).when(F.length(p) == 2, 10 + drawn(i) % 90).otherwise(drawn(i) % 10)
    return F.array_join(F.transform(parts, lambda p, i: one(p, i).cast("string")), ".")


def _rest(iban: Column, check: Column) -> Column:
    """What the check of an IBAN without blanks leaves, with these check digits; 1 where it is valid."""
    turned = F.concat(F.substring(iban, 5, 40), F.substring(iban, 1, 2), check)
    step = lambda acc, c: F.when(c.rlike("[0-9]"), (acc * 10 + c.cast("int")) % 97).otherwise((acc * 100 + F.ascii(F.upper(c)) - 55) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), step)


def _iban(entity: Column, drawn: Column) -> Column:
    """A drawn IBAN, with check digits set if the one it replaces was valid."""
    own = F.regexp_replace(entity, " ", "")
    check = F.lpad((98 - _rest(F.regexp_replace(drawn, " ", ""), F.lit("00"))).cast("string"), 2, "0")
    return F.when(_rest(own, F.substring(own, 3, 2)) == 1, F.concat(F.substring(drawn, 1, 2), check, F.substring(drawn, 5, 60))).otherwise(drawn)


def _part_of_name(kind_of: Column, digest: Column, attempt: Column) -> Column:
    """A given name by script and gender, or a surname of syllables; further attempts are longer, so the supply never
    ends."""
    pool = F.lit(None).cast("string")
    for (script, gender), choices in GIVEN.items():
        pool = F.when(kind_of == f"given {script} {gender}", F.lit(" ".join(choices))).otherwise(pool)
    syllables = F.split(F.when(kind_of.endswith("latin") | kind_of.contains(" latin "), F.lit(" ".join(SYLLABLES["latin"]))).otherwise(F.lit(" ".join(SYLLABLES["cyrillic"]))), " ")
    pick = lambda choices, i: F.element_at(choices, (_draw(digest, i) % F.size(choices) + 1).cast("int"))
    n = F.when(kind_of.startswith("surname "), 4 + attempt).otherwise(F.greatest(F.lit(0), attempt - NARROW_GIVEN + 1))
    tail = F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: pick(syllables, i)), "")).otherwise(F.lit(""))
    return F.when(kind_of.startswith("surname "), F.initcap(tail)).otherwise(F.concat(pick(F.split(pool, " "), F.lit(0)), tail))


def _drawn(what: Column, entity: Column, digest: Column, attempt: Column) -> Column:
    extra = F.greatest(F.lit(0), attempt - (NARROW - 1)).cast("int")
    wider, digits = F.repeat(F.lit("a"), extra), F.regexp_replace(entity, r"\D", "")
    form = r"((?:straße|strasse|weg|platz|allee) | (?:Street|Road|Avenue|Lane|Drive|Boulevard|Square|St|Rd|Ave)$)"
    # what is drawn again: an address without its last label, a street without its kind, anything else whole
    text = F.when(what == "email", F.concat(wider, F.regexp_replace(entity, r"\.[^.]*$", ""))).when(what == "street", F.concat(wider, F.regexp_replace(entity, form, "\0")))
    text = text.otherwise(F.concat(entity, F.repeat(F.lit("0"), extra)))
    country = F.length(F.regexp_extract(entity, r"^\+(\d{1,3}?)(?=[ .(-]|\d{7})", 1))
    skip = F.when(what == "phone", F.when(entity.startswith("+"), country).otherwise(0)).when(what == "number", 1).when(what == "iban", 4).otherwise(0)
    hexadecimal = (what == "ipv6") | ((what == "secret") & entity.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"))

    def finished(drawn: Column) -> Column:
        out = F.when(what == "email", F.concat(drawn, F.regexp_extract(entity, r"(\.[^.]*)$", 1))).when(what == "street", F.replace(drawn, F.lit("\0"), F.regexp_extract(entity, form, 1)))
        return out.when((what == "number") & (_luhn(digits) % 10 == 0), _number(drawn)).when(what == "iban", _iban(entity, drawn)).otherwise(drawn)

    named = what.startswith("given ") | what.startswith("surname ")
    like = _let(_like(text, digest, skip, hexadecimal), finished)
    return F.when(named, _part_of_name(what, digest, attempt)).when(what == "ip", _octets(entity, digest, extra > 0)).otherwise(like)


def _part(what: Column, entity: Column, key: str, attempt: Column) -> Column:
    """Replacement of an entity, or of a part of a name, on its attempt-th draw."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), what, attempt.cast("string"), canonical(entity, what)), 512)
    bound = F.struct(what.alias("k"), entity.alias("e"), digest.alias("d"), attempt.alias("a"))
    return _let(bound, lambda x: _drawn(x["k"], x["e"], x["d"], x["a"]))


def surrogate(entity: Column, key: str, attempt_of: Callable[[Column, Column], Column]) -> Column:
    """Replacement of a detected entity; attempt_of(kind, canon) is the draw of each of its parts."""
    made = lambda p: _part(p["kind"], p["part"], key, attempt_of(p["kind"], p["canon"]))
    return _let(parts(entity), lambda ps: F.concat_ws(" ", ps[0]["title"], F.transform(ps, made)))


def attempts(found: DataFrame, key: str) -> DataFrame:
    """kind, canon, attempt of the entities (array column `e`) that had to draw again, when no replacement collides any
    more."""
    every = found.select(F.explode("e").alias("entity")).distinct()
    spelled = every.select(F.explode(parts(F.col("entity"))).alias("p")).groupBy("p.kind", "p.canon").agg(F.min("p.part").alias("part"))
    state = written(spelled.withColumn("attempt", F.lit(0)), "pii-entities")
    real = state.select(F.col("canon").alias("to")).distinct().withColumn("real", F.lit(True))
    while True:
        to = canonical(_part(F.col("kind"), F.col("part"), key, F.col("attempt")), F.col("kind"))
        drawn = written(state.withColumn("to", to), "pii-drawn")
        own = F.struct("kind", "canon")
        twice = drawn.groupBy("to").agg(F.min(own).alias("keeps"), F.count("*").alias("n")).where("n > 1").drop("n")
        checked = drawn.join(twice, "to", "left").join(real, "to", "left")
        again = F.coalesce((own != F.col("keeps")) | F.col("real"), F.lit(False))
        checked = written(checked.select("kind", "canon", "part", "attempt", again.alias("again")), "pii-checked")
        state = checked.select("kind", "canon", "part", (F.col("attempt") + F.col("again").cast("int")).alias("attempt"))
        if checked.where("again").isEmpty():
            break
    return state.where("attempt > 0").select("kind", "canon", "attempt")


def _count(kinds: str, of: str) -> Column:
    return F.size(F.filter(kinds, lambda k: k == of)).cast("long")


def pseudonymised(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """`docs` with entities of its text replaced, and n_entities plus n_<type> for each type (long).

    Columns of these names are replaced; all others stay as they are. A null text stays null, an empty one empty, both
    with counts 0. Equal entities get equal replacements anywhere in the table, spellings of one entity (marks in
    numbers, case in addresses and secrets) get the spellings of one replacement, different entities of a type get
    different ones, and none is an entity of the table. Repeated rows get equal results; texts are handled whole.
    """
    counts = ["n_entities", *(f"n_{t}" for t in TYPES)]
    base = without(docs, *counts)
    held = written(base.select(F.xxhash64(text).alias("_h"), F.array_distinct(entities(F.col(text))).alias("e")).where(F.size("e") > 0), "pii-held")
    redrawn = written(attempts(held, key), "pii-again")
    if redrawn.isEmpty():
        first = lambda k, c: F.lit(0)
        found = base.withColumn("_e", entities(F.col(text))).withColumn("_to", F.transform("_e", lambda e: surrogate(e, key, first)))
    else:
        own = held.select("_h", F.explode("e").alias("entity")).distinct()
        own = own.select("_h", F.explode(parts(F.col("entity"))).alias("p")).select("_h", "p.kind", "p.canon").join(redrawn, ["kind", "canon"])
        of = own.groupBy("_h").agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "kind", "canon"), F.col("attempt")))).alias("_m"))
        joined = base.withColumn("_h", F.xxhash64(text)).join(of, "_h", "left").drop("_h").withColumn("_e", entities(F.col(text)))
        known = lambda k, c: F.coalesce(F.col("_m")[F.concat_ws("|", k, c)], F.lit(0))
        found = joined.withColumn("_to", F.transform("_e", lambda e: surrogate(e, key, known))).drop("_m")
    between = F.split(F.col(text), PATTERN, -1)
    whole = F.array_join(F.zip_with(between, F.concat(F.col("_to"), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    kinds = F.transform("_e", kind)
    named = found.withColumn("_k", kinds).select(
        *[F.when(F.size("_e") > 0, whole).otherwise(F.col(text)).alias(text) if c == text else F.col(f"`{c}`") for c in base.columns],
        F.size("_e").cast("long").alias("n_entities"),
        *[_count("_k", t).alias(f"n_{t}") for t in TYPES],
    )
    return named
