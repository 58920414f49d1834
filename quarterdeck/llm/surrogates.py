"""Keyed surrogates for personal data, in DataFrame functions only.

Detected entities are e-mail addresses, phone numbers, IPv4 addresses, card numbers (16 digits),
titled names (``Mrs Anna Berg``) and secrets: access keys, tokens of 40 hex
digits and ``password=`` values. Each is replaced by another of its kind, drawn from a keyed hash of
its normal form, so one entity has one surrogate wherever it stands and the same key gives the same
surrogates again. Digits become digits, letters letters of the same case and script (Latin,
Cyrillic or Greek), other characters stay, and what makes the kind valid is kept: the first digit of
a phone number's country code and its ``555``, bytes below 256 in an address, whether a card passes
the Luhn check. Given names come from a list of the title's gender, after some rounds joined from two
or more of them; surnames are entities of their own, with their own round in every name that holds
them, so a person named again by surname alone keeps it.

Distinctness is checked over the whole corpus: where a surrogate of one entity is the surrogate of
another or an entity that occurs, all but the first draw again with the next round number until none
collides. Only texts in which something was found are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarterdeck.llm.components import small_or_whole
from quarterdeck.llm.text import let, whole
from quarterdeck.workspace import written

# What each kind looks like, in order of precedence at one place.
_TITLE = r"(?:Mr|Mrs|Ms|Miss|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra|Г-н|Г-жа|Κύριος|Κυρία)\.?"
_NAME = r"\p{Lu}\p{Ll}+"
PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|[0-9a-f]{40}|(?:password|passwd|pwd|token|secret)=[^\s\"',;]{5,}[^\s\"',;.:!?)])(?![A-Za-z0-9])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "card": r"(?<![\d-])\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}(?![\d-])",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)",
    "name": rf"(?<![\p{{L}}])(?:{_TITLE}) {_NAME}(?: {_NAME})?",
}
WOMEN = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Г-жа", "Κυρία")
GIVEN = {
    "f": "Alba Berta Clara Dora Edith Flora Greta Helga Irma Julia Karla Lena Maren Nora Olga Paula".split(),
    "m": "Anton Bruno Carlo David Egon Felix Georg Hugo Ivan Jonas Kurt Lukas Martin Nils Otto Peter".split(),
    "fc": "Алла Вера Галина Дарья Елена Зоя Инна Клара Лариса Мария Нина Ольга Полина Рита Софья Тамара".split(),
    "mc": "Антон Борис Виктор Глеб Денис Егор Захар Иван Кирилл Лев Марк Никита Олег Павел Роман Семён".split(),
    "fg": "Άννα Βάσω Γωγώ Δάφνη Ελένη Ζωή Ηρώ Θάλεια Ιωάννα Κατερίνα Λήδα Μαρία Νίκη Όλγα Ρένα Σοφία".split(),
    "mg": "Άρης Βασίλης Γιώργος Δήμος Ευάγγελος Ζήσης Ηλίας Θανάσης Ιάσων Κώστας Λάμπρος Μάνος Νίκος Πέτρος Σάκης Τάσος".split(),
}
ALPHABETS = (
    "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
)
# All kinds at once. Only cards have a group of their own, so it is the first here too.
ANY = "|".join(PATTERNS.values())

MOST_ROUNDS = 64
# Rounds from which a given name is joined from one more of its list.
LONGER = (4, 12, 24)


def _luhn_sum(digits: Column, check: bool) -> Column:
    """Sum of the digits of a card number, every second one doubled from the right; ``check`` tells
    whether the last digit is there."""
    odd = 0 if check else 1

    def term(d: Column, i: Column) -> Column:
        x = d.cast("int")
        twice = F.when(x * 2 > 9, x * 2 - 9).otherwise(x * 2)
        return F.when((F.length(digits) - 1 - i + odd) % 2 == 1, twice).otherwise(x)

    return F.aggregate(F.transform(F.split(digits, ""), term), F.lit(0), lambda a, b: a + b)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def kind_of(value: Column) -> Column:
    """The kind of a mention, the first that fits the whole of it."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        out = F.when(value.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def normal_form(kind: Column, value: Column) -> Column:
    """What makes two mentions the same entity: case of addresses, punctuation of numbers aside."""
    return (
        F.when(kind == "email", F.lower(value))
        .when(kind.isin("phone", "card"), _digits(value))
        .when(kind == "name", F.regexp_replace(value, rf"^{_TITLE} ", ""))
        .otherwise(value)
    )


def _hash(key: str, kind: Column, normal: Column, round_: Column) -> Column:
    """256 keyed bits as 64 hex digits: the key is hashed in twice, inside and outside."""
    inner = F.sha2(F.concat_ws("\x1f", F.lit(f"{key}\x1e"), kind, normal, round_.cast("string")).cast("binary"), 256)
    return F.sha2(F.concat(F.lit(f"\x1d{key}"), inner).cast("binary"), 256)


def _stream(bits: Column, i: Column) -> Column:
    """The i-th of any number of draws, 0..65535."""
    block = F.sha2(F.concat(bits, (F.floor(i / 16)).cast("string")).cast("binary"), 256)
    return F.conv(F.substring(block, F.pmod(i, F.lit(16)).cast("int") * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _substituted(value: Column, bits: Column) -> Column:
    """Every digit and letter replaced by another of its alphabet, everything else as it is. Draws
    are counted over characters that change, so punctuation does not shift them."""

    def one(c: Column, i: Column) -> Column:
        draw = _stream(bits, i.cast("long"))
        out = F.when(c.rlike(r"^\d$"), F.pmod(draw, F.lit(10)).cast("string"))
        for letters in ALPHABETS:
            out = out.when(
                F.instr(F.lit(letters), c) > 0, F.substring(F.lit(letters), F.pmod(draw, F.lit(len(letters))) + 1, F.lit(1))
            )
        return out.otherwise(F.when(c.rlike(r"^\p{Lu}$"), F.substring(F.lit(ALPHABETS[1]), F.pmod(draw, F.lit(26)) + 1, F.lit(1)))
                             .when(c.rlike(r"^\p{L}$"), F.substring(F.lit(ALPHABETS[0]), F.pmod(draw, F.lit(26)) + 1, F.lit(1)))
                             .otherwise(c))

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _numbered(value: Column, bits: Column, keep: int, fixed: str) -> Column:
    """Digits of the value in order replaced by those drawn, but for the first ``keep``; where the
    digits hold ``fixed`` from there on (after three), it stays."""
    plain = _digits(value)

    def drawn(d: Column, i: Column) -> Column:
        stays = (i < keep) | ((F.substring(plain, keep + 4, len(fixed)) == fixed) & i.between(keep + 3, keep + 2 + len(fixed)))
        return F.when(stays, d).otherwise(F.pmod(_stream(bits, i.cast("long")), F.lit(10)).cast("string"))

    return F.array_join(F.transform(F.split(plain, ""), drawn), "")


def _poured(digits: Column, value: Column) -> Column:
    """``digits`` in the places of the digits of ``value``."""

    def both(parts: Column) -> Column:
        gaps = F.split(value, r"\d", -1)
        return F.concat(
            F.array_join(F.transform(parts, lambda d, i: F.concat(F.get(gaps, i), d)), ""), F.element_at(gaps, -1)
        )

    return let(F.split(digits, ""), both)


def surrogate(key: str, kind: Column, value: Column, round_: Column, surname_round: Column) -> Column:
    """The surrogate of a mention: that of its entity, in the mention's own format. The surname in a name
    has its own round."""

    def drawn(bits: Column) -> Column:
        plain = _digits(value)
        passes = _luhn_sum(plain, True) % 10 == 0
        # the check digit, or another one where the card did not pass
        last = lambda body: F.pmod(F.when(passes, 10).otherwise(13) - _luhn_sum(body, False) % 10, F.lit(10))
        card = let(
            _numbered(F.substring(plain, 1, 15), bits, 1, ""), lambda body: F.concat(body, last(body).cast("string"))
        )

        def byte(i: int) -> Column:
            return (F.pmod(_stream(bits, F.lit(i).cast("long")), F.lit(223 if i == 0 else 254)) + 1).cast("string")

        email = F.concat(
            _substituted(F.lower(F.substring_index(value, "@", 1)), bits), F.lit("@"), F.lower(F.substring_index(value, "@", -1))
        )
        label = F.regexp_extract(value, r"^((?:password|passwd|pwd|token|secret)=|AKIA)", 1)
        rest = F.substring(value, F.length(label) + 1, F.length(value))
        return (
            F.when(kind == "email", F.when(value == F.upper(value), F.upper(email)).otherwise(email))
            .when((kind == "secret") & value.rlike("^[0-9a-f]{40}$"), F.substring(bits, 1, 40))
            .when(kind == "secret", F.concat(label, _substituted(rest, bits)))
            .when(kind == "ip", F.concat_ws(".", *[byte(i) for i in range(4)]))
            .when(kind == "card", _poured(card, value))
            .when(kind == "phone", _poured(_numbered(value, bits, 1, "555"), value))
            .when(kind == "name", _renamed(key, value, bits, round_, surname_round))
            .when(kind == "surname", _substituted(value, bits))
        )

    return let(_hash(key, kind, normal_form(kind, value), round_), drawn)


def _surname(value: Column) -> Column:
    return F.substring_index(value, " ", -1)


def _renamed(key: str, value: Column, bits: Column, round_: Column, surname_round: Column) -> Column:
    title = F.regexp_extract(value, rf"^({_TITLE}) ", 1)
    names = F.split(F.substring(value, F.length(title) + 2, F.length(value)), " ")
    woman = F.regexp_replace(title, r"\.$", "").isin(*WOMEN)
    script = F.when(value.rlike(r" \p{IsCyrillic}"), "c").when(value.rlike(r" \p{IsGreek}"), "g").otherwise("")
    given = F.lit(None).cast("string")
    for group, choices in GIVEN.items():
        fits = (woman if group[0] == "f" else ~woman) & (script == group[1:])
        pick = lambda i: F.get(F.array(*map(F.lit, choices)), F.pmod(_stream(bits, F.lit(400 + i).cast("long")), F.lit(len(choices))))  # noqa: B023, E731
        more = [F.when(round_ >= least, F.lower(pick(i))).otherwise("") for i, least in enumerate(LONGER, 1)]
        given = F.when(fits, F.concat(pick(0), *more)).otherwise(given)
    last = F.element_at(names, -1)
    surname = let(_hash(key, F.lit("surname"), last, surname_round), lambda b: _substituted(last, b))
    return F.concat_ws(" ", title, F.when(F.size(names) > 1, given), surname)


def _mentions(text: Column) -> Column:
    return F.regexp_extract_all(whole(text), F.lit(f"(?:{ANY})"), F.lit(0))


def entities(mentions: DataFrame) -> DataFrame:
    """(value, kind, normal) of every different ``value`` among mentions."""
    kind = kind_of(F.col("value"))
    return mentions.select("value").distinct().withColumn("kind", kind).withColumn(
        "normal", normal_form(F.col("kind"), F.col("value"))
    )


def redrawn(found: DataFrame, key: str, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """(kind, normal, round) of the entities of (kind, value, normal), and of the surnames in them, whose
    first draw collides, with the round that does not. Raises if some still collide after ``most_rounds``."""
    last = _surname(F.col("value"))
    names = found.where("kind = 'name'")
    surnames = names.select(F.lit("surname").alias("kind"), last.alias("value"), last.alias("normal")).distinct()
    rest = found.where("kind <> 'name'").select("kind", "value", "normal").unionByName(surnames)
    settled = written(_settled(rest.withColumn("surname_round", F.lit(0)), key, most_rounds), "settled")
    # a name of one word is its surname, and differs as that does
    whole_names = names.where(F.instr("normal", " ") > 0).select("kind", "value", "normal")
    return settled.unionByName(_settled(with_surname_rounds(whole_names, settled), key, most_rounds))


def with_surname_rounds(found: DataFrame, settled: DataFrame) -> DataFrame:
    """(kind, value, normal) with the round of the surname that a name holds, by ``redrawn``."""
    rounds = settled.where("kind = 'surname'").select(F.col("normal").alias("surname"), F.col("round").alias("surname_round"))
    last = F.when(F.col("kind") == "name", _surname(F.col("value")))
    joined = found.withColumn("surname", last).join(small_or_whole(rounds), "surname", "left").drop("surname")
    return joined.withColumn("surname_round", F.coalesce("surname_round", F.lit(0)))


def _settled(found: DataFrame, key: str, most_rounds: int) -> DataFrame:
    """(kind, normal, round) of those of (kind, value, normal, surname_round) that draw again. All values
    of an entity are checked, and draw again together."""
    state = written(found.withColumn("round", F.lit(0)), "surrogates")
    real = state.select("kind", F.col("normal").alias("drawn"), F.lit(True).alias("real")).distinct()
    for _ in range(most_rounds):
        made = surrogate(key, F.col("kind"), F.col("value"), F.col("round"), F.col("surname_round"))
        own = written(state.withColumn("drawn", normal_form(F.col("kind"), made)), "drawn")
        order = W.partitionBy("kind", "drawn").orderBy("round", "normal")
        placed = own.withColumn("place", F.dense_rank().over(order)).join(real, ["kind", "drawn"], "left")
        bad = ((F.col("place") > 1) | F.col("real").isNotNull()).cast("int")
        after = written(
            placed.withColumn("bad", F.max(bad).over(W.partitionBy("kind", "normal"))).drop("real", "place", "drawn"), "surrogates"
        )
        if not after.where("bad > 0").count():
            return after.where("round > 0").select("kind", "normal", "round").distinct()
        state = after.withColumn("round", F.col("round") + F.col("bad")).drop("bad")
    raise ValueError(f"surrogates still collide after {most_rounds} rounds: too few of their kind")


def _put_back(text: Column, found: Column) -> Column:
    """The text with the surrogates of ``found``, which has its mentions in order."""

    def woven(gaps: Column) -> Column:
        pairs = F.transform(found, lambda m, i: F.concat(F.get(gaps, i), m["surrogate"]))
        return F.concat(F.array_join(pairs, ""), F.element_at(gaps, -1))

    return let(F.split(whole(text), f"(?:{ANY})", -1), woven)


def replace(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(``_row``, ``_text``, ``_found``): the other columns of every row of ``docs`` as a struct, the text
    with surrogates, and what was found as array<struct<place, kind, value, surrogate>>, in order.

    Null and empty texts stay as they are; the same entity has the same surrogate in all rows, repeated
    ones too; columns of any name pass through; no rows give no rows.
    """
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("_row"), F.col(text).alias("_text")
    )
    has_any = F.coalesce(F.col("_text").rlike(f"(?:{ANY})"), F.lit(False))
    hits = written(packed.where(has_any).withColumn("_hit", F.monotonically_increasing_id()), "hits")
    mentions = written(
        hits.select("_hit", F.posexplode(_mentions(F.col("_text"))).alias("place", "value")), "mentions"
    )
    found = written(entities(mentions), "entities")
    again = written(redrawn(found, key), "redrawn")
    made = written(
        with_surname_rounds(found, again).join(small_or_whole(again), ["kind", "normal"], "left").select(
            "value",
            "kind",
            surrogate(key, F.col("kind"), F.col("value"), F.coalesce("round", F.lit(0)), F.col("surname_round")).alias("surrogate"),
        ),
        "made",
    )
    of_text = (
        mentions.join(small_or_whole(made), "value")
        .groupBy("_hit")
        .agg(F.sort_array(F.collect_list(F.struct("place", "kind", "value", "surrogate"))).alias("_found"))
    )  # all mentions of one text: bounded by it
    changed = hits.join(of_text, "_hit").select(
        "_row", _put_back(F.col("_text"), F.col("_found")).alias("_text"), "_found"
    )
    kind = changed.schema["_found"].dataType
    return changed.unionByName(packed.where(~has_any).withColumn("_found", F.array().cast(kind)))


def surrogate_report(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_found, text``: every row with its text in surrogates. What was found is not shown."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return replace(narrow, key).select(
        F.col("_row.doc_id").alias("doc_id"), F.size("_found").cast("long").alias("n_found"), F.col("_text").alias("text")
    )
