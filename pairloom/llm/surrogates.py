"""Personal data replaced by surrogates.

Entities are found by patterns: email addresses, IPv4 and IPv6 addresses, card numbers, social security numbers,
phone numbers, long hexadecimal secrets, and names behind a title (any number of parts, initials and particles). Each gets a replacement of its own kind, drawn from
a keyed hash of its type and normal form, so the same entity has the same surrogate in every document and
writing (coreference), and without the key nobody can go back:

* letters become letters of the same script and case, digits become digits, separators stay;
* a phone number keeps its country code, a card its first digit, an address stays an address;
* a name gets a first name of the gender of its title and a surname, both in its script (Latin, Cyrillic, Greek,
  Armenian), in capitals if it was; the title stays.

The surrogates of all entities of the table are checked against each other and against all originals. Where two
entities of one type meet in one surrogate, or a surrogate is somebody's original, all but one are drawn anew with
the next attempt until nothing collides; after ROUNDS attempts (a form too short for so many entities) the rest
become `[type-hash]`, which is distinct but not of the form. Only redrawn entities are carried to the documents;
all others are rewritten where they stand.

Texts without entities stay as they are, null stays null. Rows, also equal ones, are kept one for one, with all
columns; a column `n_entities` of the table is replaced by the count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import let, spare_name, written

ROUNDS = 12
#: Texts with redrawn entities whose maps are sent to every executor at most.
BROADCAST_TEXTS = 50_000

_WORD = r"\p{L}\p{N}"
_EDGE, _END = rf"(?<![{_WORD}_])", rf"(?![{_WORD}_])"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
MALE = ("Mr", "Herr", "Señor", "Monsieur", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Госпожа")
_TITLE = "(?:" + "|".join((*MALE, *FEMALE)) + r")\.? "
#: A part of a name: `McDonald`, `O'Brien`, `Smith-Jones`, `JOHN`, `J.`, `J.R.R.`; the 's of a genitive is none.
_MARKS = r"\p{L}\p{M}"
_NAME = (
    rf"(?:(?:\p{{Lu}}\.-?)++(?![{_MARKS}])|(?:\p{{Lu}}\.)*+(?:[dDlL]['’])?\p{{Lu}}[{_MARKS}]*+"
    rf"(?:['’](?!(?i:s|ll|ve|re|d|m)(?![{_WORD}]))[{_MARKS}]++|[\-‐‑][{_MARKS}]++)*+){_END}"
)
_PARTICLE = (
    "(?:(?:van|von|vom|der|den|de|du|da|di|do|dos|das|del|della|la|le|el|al|bin|ibn|ben|ter|ten|te|zu|zur|zum|af|av|y|e|und)"
    " ){0,4}+"
)
_HEX4 = "[0-9a-fA-F]{1,4}"
#: Bare numbers are cards only behind the first digits that issuers of their length use, and phone numbers only as
#: area and exchange codes allow: times since 1970 in seconds and milliseconds are neither.
_BARE_CARD = "4[0-9]{12}|3[0689][0-9]{12}|3[47][0-9]{13}|[2-6][0-9]{15}|[0-9]{17,19}"
_BARE_PHONE = "[2-9][0-9]{2}[2-9][0-9]{6}"
# The country codes of one and two digits; all others have three.
_COUNTRY = "1|7|20|27|3[0-4]|36|39|4[01]|4[3-9]|5[1-8]|6[0-6]|81|82|84|86|9[0-5]|98|[0-9]{3}"

PATTERNS = {
    "email": rf"(?<![{_WORD}._%+\-])[{_WORD}._%+\-]{{1,64}}+@[{_WORD}\-]{{1,63}}+(?:\.[{_WORD}\-]{{1,63}}+){{1,8}}+",
    "secret": rf"{_EDGE}[0-9a-fA-F]{{32,128}}+{_END}",
    "ip": rf"(?<![{_WORD}_.])(?:{_OCTET}\.){{3}}{_OCTET}(?![{_WORD}_]|\.[0-9])",
    "ip6": rf"(?<![{_WORD}_])(?<![0-9a-fA-F]:)(?:(?:{_HEX4}:){{7}}{_HEX4}|[23fF][0-9a-fA-F]{{3}}(?::{_HEX4}){{0,6}}::"
           rf"(?:{_HEX4}(?::{_HEX4}){{0,5}})?)(?![{_WORD}_:])",
    "card": rf"{_EDGE}(?:[0-9]{{4}}([ \-])[0-9]{{4}}\1[0-9]{{4}}\1[0-9]{{4}}(?:\1[0-9]{{3}})?"
            rf"|[0-9]{{4}}(?:-[0-9]{{6}}-| [0-9]{{6}} )[0-9]{{5}}|{_BARE_CARD}){_END}",
    "ssn": rf"{_EDGE}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_END}",
    "phone": rf"(?<![{_WORD}_+])(?:(?:\+?[0-9]{{1,3}}[ .\-]?)?\([0-9]{{3}}\)[ .\-]?|(?:\+?[0-9]{{1,3}}[ .\-])?[0-9]{{3}}[ .\-])"
             rf"[0-9]{{3}}[ .\-][0-9]{{4}}{_END}"
             rf"|(?<![{_WORD}_+])(?:[0-9]{{1,3}}[ .\-][0-9]{{10}}|{_BARE_PHONE}){_END}"
             rf"|(?<![{_WORD}_+])\+[0-9](?:[ .\-/()]{{0,2}}[0-9]){{7,14}}{_END}",
    "person": rf"{_EDGE}{_TITLE}{_PARTICLE}{_NAME}(?: {_PARTICLE}{_NAME})*+",
}
ANY = "|".join(PATTERNS.values())

_LATIN, _ACCENTED = "abcdefghijklmnopqrstuvwxyz", "àâäåæçèéêëìíîïñòóôöøùúûüýÿ"
_GREEK, _CYRILLIC = "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрстуфхцчшщыэюя"
_KANA, _HAN = "あいうえおかきくけこさしすせそたちつてとなにぬねの", "山川田中村林木石水火土金花草竹雨雪風月星"
_SCRIPTS = (
    ("[0-9]", "0123456789"), ("[a-z]", _LATIN), (r"\p{IsLatin}", _ACCENTED), (r"\p{IsGreek}", _GREEK),
    (r"\p{IsCyrillic}", _CYRILLIC), (r"\p{IsHiragana}|\p{IsKatakana}", _KANA), (r"\p{IsHan}", _HAN),
    (r"[\p{L}\p{N}]", _LATIN),
)
_HEX = (("[0-9]", "0123456789"), ("[a-f]", "abcdef"))
_FIRST_NAMES = {
    ("latin", "male"): ("Adrian", "Bruno", "Caspar", "Dario", "Emil", "Felix", "Gregor", "Hugo", "Ivo", "Julian"),
    ("latin", "female"): ("Alba", "Bettina", "Clara", "Daria", "Elena", "Flora", "Greta", "Helena", "Irma", "Julia"),
    ("cyrillic", "male"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Захар", "Игорь", "Кирилл", "Лев"),
    ("cyrillic", "female"): ("Анна", "Белла", "Вера", "Галина", "Дарья", "Ева", "Зоя", "Ирина", "Клара", "Лидия"),
    ("greek", "male"): ("Άρης", "Βασίλης", "Γιώργος", "Δημήτρης", "Ηλίας", "Κώστας", "Λουκάς", "Μάρκος", "Νίκος", "Πέτρος"),
    ("greek", "female"): ("Άννα", "Βασιλική", "Γεωργία", "Δήμητρα", "Ελένη", "Ζωή", "Ιωάννα", "Κατερίνα", "Μαρία", "Σοφία"),
    ("armenian", "male"): ("Արամ", "Արմեն", "Գոռ", "Դավիթ", "Հայկ", "Կարեն", "Նարեկ", "Սամվել", "Տիգրան", "Վահան"),
    ("armenian", "female"): ("Անահիտ", "Անի", "Արփի", "Գոհար", "Լիլիթ", "Մարիամ", "Նարե", "Շուշան", "Սոնա", "Տաթև"),
}
_SYLLABLES = {
    "latin": [c + v for c in "bdfgklmnprstvz" for v in "aeiou"],
    "cyrillic": [c + v for c in "бвгдзклмнпрст" for v in "аеиоу"],
    "greek": [c + v for c in "βγδζθκλμνπρστφ" for v in "αεηιου"],
    "armenian": [c + v for c in "բգդզթլկհմնպռսվտ" for v in "աեիոու"],
}


def found(text: Column) -> Column:
    """The entities of a text as they are written, in order."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(ANY), F.lit(0))


def type_of(entity: Column) -> Column:
    out = F.lit("person")
    for name in ("phone", "ssn", "card", "ip6", "ip", "secret", "email"):
        pattern = "@" if name == "email" else f"^(?:{PATTERNS[name]})$"
        out = F.when(entity.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def _bare_name(entity: Column) -> Column:
    return F.regexp_replace(entity, f"^{_TITLE}", "")


def normal(entity: Column, kind: Column) -> Column:
    """What is the same in all writings of an entity: a phone number without its country code, a person with
    the gender of the title."""
    digits = F.regexp_replace(entity, "[^0-9]", "")
    # a number behind a plus sign begins with its country code; of others the last ten digits are the number
    national = F.when(entity.startswith("+"), F.regexp_replace(digits, f"^(?:{_COUNTRY})", "")).otherwise(digits)
    male = entity.rlike(f"^(?:{'|'.join(MALE)})" + r"\.? ")
    person = F.concat(F.when(male, F.lit("m ")).otherwise(F.lit("f ")), F.lower(_bare_name(entity)))
    return (
        F.when(kind == "phone", F.right(national, F.lit(10))).when(kind.isin("card", "ssn"), digits).when(kind == "person", person).otherwise(F.lower(entity))
    )


def _stream(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """320 hexadecimal digits, keyed."""
    blocks = [
        F.sha2(F.concat_ws("\x1f", F.lit(key), kind, norm, attempt.cast("string"), F.lit(str(b))), 256) for b in range(5)
    ]
    return F.concat(*blocks)


def _value(stream: Column, i: Column | int) -> Column:
    """The ``i``-th of 80 numbers under 65,536, from the start again beyond."""
    i = F.lit(i) if isinstance(i, int) else i
    return F.conv(F.substring(stream, (i % 80) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _drawn(norm: Column, stream: Column, scripts) -> Column:
    """``norm`` with every character replaced by one of its own script."""

    def one(char: Column, i: Column) -> Column:
        letters = F.lit(None).cast("string")
        for pattern, own in reversed(scripts):
            letters = F.when(char.rlike(f"^(?:{pattern})$"), F.lit(own)).otherwise(letters)

        def letter(own: Column) -> Column:
            drawn = F.substring(own, _value(stream, i) % F.char_length(own) + 1, F.lit(1))
            return F.when(own.isNull(), char).otherwise(drawn)

        return let(letters, letter)

    return F.array_join(F.transform(F.split(norm, ""), one), "")


def _choices(of: list[str] | tuple[str, ...]) -> Column:
    # one literal: an array of them would make the plan large, which the driver has to hold
    return F.struct(F.lit(",".join(of)).alias("list"), F.lit(len(of)).alias("n"))


def _pick(choices: Column, value: Column) -> Column:
    return F.split_part(choices["list"], F.lit(","), value % choices["n"] + 1)


def _person(norm: Column, stream: Column, family: Column) -> Column:
    """First name (if there was one) and surname, by gender and script; ``family`` is drawn for the surname."""

    def lists(script: str) -> Column:
        male, female = _choices(_FIRST_NAMES[script, "male"]), _choices(_FIRST_NAMES[script, "female"])
        first = F.when(norm.startswith("m "), male).otherwise(female)
        return F.struct(first.alias("first"), _choices(_SYLLABLES[script]).alias("syllables"))

    def named(own: Column) -> Column:
        first = F.when(F.size(F.split(norm, " ")) > 2, _pick(own["first"], _value(stream, 0)))
        last = let(family, lambda f: F.initcap(F.concat(*[_pick(own["syllables"], _value(f, i)) for i in (1, 2, 3, 4)])))
        return F.concat_ws(" ", first, last)  # which leaves out a null

    chosen = lists("latin")
    for script in ("armenian", "greek", "cyrillic"):
        chosen = F.when(norm.rlike(rf"\p{{Is{script.capitalize()}}}"), lists(script)).otherwise(chosen)
    return let(chosen, named)


def drawn(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a normal form."""
    family = _stream(F.lit("surname"), F.element_at(F.split(norm, " "), -1), attempt, key)

    def of(stream: Column) -> Column:
        ip = F.concat_ws(
            ".", (_value(stream, 0) % 223 + 1).cast("string"), (_value(stream, 1) % 256).cast("string"),
            (_value(stream, 2) % 256).cast("string"), (_value(stream, 3) % 254 + 1).cast("string"),
        )
        # a card keeps its first digit
        kept = F.when(kind == "card", F.substring(norm, 1, 1)).otherwise("")
        changed = F.when(kind == "card", F.substring(norm, 2, 99)).otherwise(norm)
        return (
            F.when(kind == "ip", ip).when(kind == "person", _person(norm, stream, family))
            .when(kind.isin("secret", "ip6"), _drawn(norm, stream, _HEX))
            .otherwise(F.concat(kept, _drawn(changed, stream, _SCRIPTS)))
        )

    return let(_stream(kind, norm, attempt, key), of)


def _in_digits(entity: Column, digits: Column) -> Column:
    """``entity`` with its digits replaced by ``digits`` in turn."""
    state = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
    end = F.aggregate(
        F.split(entity, ""), state,
        lambda s, c: F.when(
            c.rlike("^[0-9]$"),
            F.struct((s["at"] + 1).alias("at"), F.concat(s["out"], F.substring(digits, s["at"], F.lit(1))).alias("out")),
        ).otherwise(F.struct(s["at"].alias("at"), F.concat(s["out"], c).alias("out"))),
    )
    return end["out"]


def _in_case(entity: Column, letters: Column) -> Column:
    """``letters`` with upper case where ``entity`` has it."""
    pairs = F.zip_with(
        F.split(entity, ""), F.split(letters, ""),
        lambda old, new: F.when(old.rlike(r"^\p{Lu}$"), F.upper(new)).otherwise(new),
    )
    same = F.char_length(entity) == F.char_length(letters)
    return F.when(same, F.array_join(pairs, "")).otherwise(letters)


def laid_out(entity: Column, kind: Column, surrogate: Column) -> Column:
    """A surrogate in the writing of one occurrence of its entity."""
    digits = F.regexp_replace(entity, "[^0-9]", "")
    phone = F.concat(F.substring(digits, F.lit(1), F.char_length(digits) - F.char_length(surrogate)), surrogate)
    number = F.when(kind == "phone", phone).otherwise(surrogate)
    title, name = F.regexp_extract(entity, f"^({_TITLE})", 1), _bare_name(entity)
    person = F.when(name.rlike(r"\p{Lu}{2}") & ~name.rlike(r"\p{Ll}"), F.upper(surrogate)).otherwise(surrogate)
    return (
        F.when(surrogate.startswith("["), surrogate)
        .when(kind.isin("phone", "card", "ssn"), let(number, lambda new: _in_digits(entity, new)))
        .when(kind == "person", F.concat(title, person))
        .when(kind == "ip", surrogate)
        .otherwise(_in_case(entity, surrogate))
    )


def _collision_free(entities: DataFrame, key: str) -> DataFrame:
    """`kind`, `norm`, `surrogate` of the entities (`kind`, `norm`) whose first draw collides."""
    draw = lambda df: df.withColumn("surrogate", drawn(F.col("kind"), F.col("norm"), F.col("attempt"), key))
    taken = written(draw(entities.withColumn("attempt", F.lit(0))), "drawn")
    originals = entities.select("kind", F.regexp_replace("norm", "^[mf] ", "").alias("original")).distinct()

    def losers(fresh: DataFrame, kept: DataFrame | None) -> DataFrame:
        best = fresh.groupBy("kind", "surrogate").agg(F.min("norm").alias("best"))
        checked = fresh.join(best, ["kind", "surrogate"]).join(
            originals.withColumnRenamed("kind", "their_kind").withColumn("theirs", F.lit(True)),
            (F.col("kind") == F.col("their_kind")) & (F.lower("surrogate") == F.col("original")), "left",
        )
        bad = (F.col("norm") != F.col("best")) | F.col("theirs").isNotNull()
        if kept is not None:
            held = kept.select("kind", "surrogate", F.lit(True).alias("held")).distinct()
            checked = checked.join(held, ["kind", "surrogate"], "left")
            bad = bad | F.col("held").isNotNull()
        return checked.select("kind", "norm", "attempt", "surrogate", bad.alias("bad"))

    state = written(losers(taken, None), "checked")
    kept, left, redrawn = state.where("not bad"), state.where("bad"), None
    for _ in range(ROUNDS):
        if not left.limit(1).count():
            break
        fresh = draw(left.select("kind", "norm", (F.col("attempt") + 1).alias("attempt")))
        state = written(losers(fresh, kept), "checked")
        good, left = state.where("not bad"), state.where("bad")
        kept = kept.unionByName(good)
        redrawn = good if redrawn is None else redrawn.unionByName(good)
    mark = F.concat(F.lit("["), F.col("kind"), F.lit("-"), F.substring(F.sha2(F.concat(F.lit(key), "norm"), 256), 1, 32), F.lit("]"))
    rest = left.withColumn("surrogate", mark)
    return (rest if redrawn is None else redrawn.unionByName(rest)).select("kind", "norm", "surrogate")


def replaced(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with its entities replaced in ``text``, and `n_entities`."""
    occurrences = docs.select(F.explode(F.array_distinct(found(F.col(text)))).alias("entity"))
    occurrences = occurrences.groupBy("entity").count().select("entity", type_of(F.col("entity")).alias("kind"))
    entities = occurrences.select("kind", normal(F.col("entity"), F.col("kind")).alias("norm")).distinct()
    redrawn = written(_collision_free(written(entities, "entities"), key), "redrawn")

    ents, parts, fixes, digest = (spare_name(docs, c) for c in ("entities", "parts", "fixes", "text_digest"))
    out = docs.withColumn(ents, found(F.col(text)))
    if redrawn.limit(1).count():
        body = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
        told = docs.select(body.alias(digest), F.explode(F.array_distinct(found(F.col(text)))).alias("entity"))
        told = told.withColumn("kind", type_of(F.col("entity"))).withColumn("norm", normal(F.col("entity"), F.col("kind")))
        by_text = told.join(redrawn, ["kind", "norm"]).groupBy(digest).agg(
            F.map_from_entries(F.collect_set(F.struct(F.concat("kind", F.lit(" "), "norm"), "surrogate"))).alias(fixes)
        )
        by_text = written(by_text, "fixes")
        if by_text.count() <= BROADCAST_TEXTS:
            by_text = F.broadcast(by_text)
        out = out.withColumn(digest, body).join(by_text, digest, "left").drop(digest)
    else:
        out = out.withColumn(fixes, F.lit(None).cast("map<string,string>"))

    def one(entity: Column) -> Column:
        def of_kind(kind: Column) -> Column:
            def of_norm(norm: Column) -> Column:
                fixed = F.try_element_at(F.col(fixes), F.concat(kind, F.lit(" "), norm))
                surrogate = F.coalesce(fixed, drawn(kind, norm, F.lit(0), key))
                # named once: the driver holds the plan, its copies and its text
                return let(surrogate, lambda new: laid_out(entity, kind, new))

            return let(normal(entity, kind), of_norm)

        return let(type_of(entity), of_kind)

    pieces = F.split(F.col(text), ANY, -1)
    new = F.array_join(
        F.zip_with(pieces, F.concat(F.transform(F.col(ents), one), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), ""
    )
    out = out.withColumn(text, F.when(F.size(ents) > 0, new).otherwise(F.col(text)))
    return out.withColumn("n_entities", F.size(ents).cast("long")).drop(ents, fixes)
