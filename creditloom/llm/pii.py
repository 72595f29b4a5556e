"""Personal data replaced by keyed surrogates of the same type and format.

Mentions are found by one pattern.  Each is reduced to a canonical form (letters in lower case,
digits without separators), so that all forms of an entity, in all documents, get one surrogate.
Surrogates are drawn from a keyed hash: letters stay letters of their script and case, digits stay
digits, country codes, issuers, prefixes and top-level domains stay, card numbers keep a valid check
digit, and a name keeps the gender of its title and its script.  A draw that meets another
entity's surrogate or a real entity is drawn again, until all are distinct; what still collides when
a round settles nothing, or after MOST_DRAWS rounds, gets a longer surrogate with a number.
A secret of one repeated sign (``********``) is a mask, not an entity, and stays.

All work is in SQL expressions.  Texts without a mention never move; entities are keyed by the
digest of their text, so copies of one text, however many, share one row.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

KEY = "replace-this-key"
MOST_DRAWS = 50

# Titles by gender, and given names by script and gender.
TITLES = {
    "male": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "г-н", "господин"],
    "female": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "госпожа"],
    "any": ["Dr", "Prof"],
}
GIVEN = {
    "latin_male": "Adam Bruno Carl David Emil Felix Hugo Ivan Jonas Karl Leo Martin Noel Oscar Paul Robert".split(),
    "latin_female": "Alice Bella Clara Diana Emma Flora Greta Helen Irene Julia Karin Laura Maria Nora Olivia Paula".split(),
    "latin_any": "Alex Andrea Charlie Dominique Jules Kim Lou Maxime Noa Robin Sacha Sam Sascha Toni Val Yael".split(),
    "cyrillic_male": "Антон Борис Виктор Глеб Денис Егор Захар Иван Кирилл Лев Максим Никита Олег Павел Роман Семён".split(),
    "cyrillic_female": "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Клара Лидия Мария Нина Ольга Полина Раиса София".split(),
    "cyrillic_any": "Саша Женя Валя Шура Слава Паша Миша Вася Витя Толя Тоня Рая Фая Нюра Люба Леся".split(),
}
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe ka ke la le li lo ma me mi mo na ne ni no ra re ri ro sa se ta ve".split(),
    "cyrillic": "ба бе би бо да де ди до фа фе ка ке ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се та ве".split(),
}
ALPHABETS = {
    "[0-9]": "0123456789",
    "[a-z]": "abcdefghijklmnopqrstuvwxyz",
    "[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "[à-öø-ÿß]": "àáâãäåæçèéêëìíîïñòóôõöùúûü",
    "[а-яё]": "абвгдежзийклмнопрстуфхцчшщэюя",
    "[α-ωά-ώ]": "αβγδεζηθικλμνξοπρστυφχψω",
}

HAN, HANGUL = (0x4E00, 20_902), (0xAC00, 11_172)
SIGNS = {"password": "!#$%&*+-./:;=?@^_~", "token": "+/_=.-"}


def _block_alphabets() -> tuple[str, str]:
    """Letters and digits of the other scripts, as texts of two maps.

    The first leads from rows of 16 code points and the class (``row-class``) to an alphabet, the second
    holds the alphabets: what has one script and class within 128 code points.
    """
    alphabets: dict[tuple[int, int, str], str] = {}
    rows: dict[tuple[int, int], tuple[int, int, str]] = {}
    for code in range(0x80, 0x20000):
        kind = unicodedata.category(chr(code))
        if kind in ("Lu", "Ll", "Lo", "Nd") and not (0x3400 <= code < 0xA000 or 0xAC00 <= code < 0xD800):
            case = {"Lu": 1, "Nd": 2}.get(kind, 0)
            at = (code >> 7, case, unicodedata.name(chr(code), "?").split()[0])
            alphabets[at] = alphabets.get(at, "") + chr(code)
            rows.setdefault((code >> 4, case), at)
    number = {at: i for i, at in enumerate(alphabets)}
    return (
        ",".join(f"{row}-{case}:{number[at]}" for (row, case), at in rows.items()),
        ",".join(f"{number[at]}:{letters}" for at, letters in alphabets.items()),
    )


ALPHABET_ROWS, BLOCK_ALPHABETS = _block_alphabets()

_titles = "|".join(t for group in TITLES.values() for t in sorted(group, key=len, reverse=True))
_name = r"\p{Lu}[\p{Ll}'’-]+"
#: Alternatives in order of precedence.  Possessive runs and look-behinds keep the scan linear.
PATTERNS = {
    "email": r"(?<![\w.%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "password": r"(?i:\b(?:password|passwd|pwd)\s?[=:]\s?\"?)[^\s\"]{6,}",
    "token": r"(?i:\b(?:token|secret|api[_-]?key|access[_-]?key)\s?[=:]\s?\"?)[A-Za-z0-9+/_=.-]{12,}",
    "access": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b|\bgh[pousr]_[A-Za-z0-9]{30,}|\bsk-[A-Za-z0-9]{20,}",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![0-9.])(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])"
    r"|(?<![0-9])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9-])",
    # A run of numbers, up to the start of an address, an SSN or a phone number; cards_in finds the cards in it.
    "card": r"(?<![0-9.-])[0-9](?:(?![ -](?:[0-9]{1,3}\.[0-9]|[\p{L}\p{N}._%+-]++@|[0-9]{3}[.-][0-9]{2,3}[.-][0-9]{4}(?![0-9-])))[ -]?[0-9]){12,}+",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{_titles})\.? {_name}(?: {_name})?",
}
PATTERN = "|".join(PATTERNS.values())
#: Digits of the groups of a card number that does not begin its run.
CARD_GROUPS = r"^(?:1[3-9]|4,4,4,4(?:,[1-3])?|4,6,[45]|4,4,4,1)$"
_SECRETS = ("password", "token")
MASK = r"^([^\p{L}\p{N}])\1*$"


def may_mention(text: str) -> Column:
    """A cheap necessary condition: a digit, a sign, a title or the head of a key.  Plain text skips the pattern."""
    hint = F.col(text).rlike("[0-9@=]")
    for word in sorted({t for group in TITLES.values() for t in group} | {":", "_", "AKIA", "ASIA", "sk-"}):
        hint = hint | F.contains(F.col(text), F.lit(word))
    return hint


def kind_of(mention: str) -> Column:
    """The type of a mention: the first pattern that takes all of it."""
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        kind = F.when(F.col(mention).rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    return kind


def luhn_sum(digits: Column) -> Column:
    """Check sum of a digit string, the last digit counted once."""
    def part(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = (F.length(digits) - i) % 2 == 1
        return F.when(twice, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + part(i))


def cards_in(run: Column) -> Column:
    """The card numbers in a run of numbers, from the left and the longest first, none overlapping.

    A card has 13 to 19 digits, whole groups and a valid check digit.  At the start of the run any
    grouping will do, after it the usual ones.
    """
    listed = F.split(run, "[ -]")
    # Groups and the digits before each travel in the state: made from the run, they would be at every step.
    before = F.aggregate(
        listed,
        F.struct(F.array(F.lit(0)).alias("ends"), F.lit(0).alias("sum")),
        lambda s, g: F.struct(F.concat(s["ends"], F.array(s["sum"] + F.length(g))).alias("ends"), (s["sum"] + F.length(g)).alias("sum")),
        lambda s: s["ends"],
    )
    start = F.struct(
        F.lit(1).alias("at"), F.lit(0).alias("next"), F.array().cast("array<string>").alias("cards"),
        listed.alias("groups"), before.alias("before"),
    )

    def step(state: Column, i: Column) -> Column:
        groups = state["groups"]
        count = F.size(groups)

        def first(n: Column) -> Column:
            return F.slice(groups, i + 1, n)

        def sized(n: Column) -> Column:
            return (F.get(state["before"], i + n) - F.get(state["before"], i)).between(13, 19)

        def is_card(n: Column) -> Column:
            shape = F.array_join(F.transform(first(n), lambda g: F.length(g).cast("string")), ",")
            return ((i == 0) | shape.rlike(CARD_GROUPS)) & (luhn_sum(F.array_join(first(n), "")) % 10 == 0)

        lengths = F.filter(F.sequence(F.least(count - i, F.lit(19)), F.lit(1), F.lit(-1)), sized)
        best = F.when(i >= state["next"], F.get(F.filter(lengths, is_card), F.lit(0)))
        card = F.substring(run, state["at"], F.length(F.array_join(first(best), " ")))
        return F.struct(
            (state["at"] + F.length(F.get(groups, i)) + 1).alias("at"),
            F.coalesce(i + best, state["next"]).alias("next"),
            F.when(best.isNull(), state["cards"]).otherwise(F.concat(state["cards"], F.array(card))).alias("cards"),
            groups.alias("groups"),
            state["before"].alias("before"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.size(listed) - 1), start, step, lambda state: state["cards"])


def with_cards(run: Column, cards: Column, surrogates: Column) -> Column:
    """A run of numbers with its cards, in order, replaced by what a map has for them."""
    start = F.struct(F.lit("").alias("done"), run.alias("rest"))

    def step(state: Column, card: Column) -> Column:
        at = F.instr(state["rest"], card)
        return F.struct(
            F.concat(state["done"], F.substring(state["rest"], F.lit(1), at - 1), F.coalesce(F.element_at(surrogates, card), card)).alias("done"),
            F.substring(state["rest"], at + F.length(card), F.length(state["rest"])).alias("rest"),
        )

    return F.aggregate(cards, start, step, lambda state: F.concat(state["done"], state["rest"]))


def is_run(mention: Column) -> Column:
    """Whether a mention may be a run of numbers with cards: digits with single separators, none of another type."""
    return mention.rlike(r"^[0-9](?:[ -]?[0-9])*+$") & (F.length(F.regexp_replace(mention, "[^0-9]", "")) >= 13)


def secret_head(mention: Column) -> Column:
    return F.regexp_extract(mention, r"^(?i:[a-z_-]+)\s?[=:]\s?\"?", 0)


def canonical_of(mention: Column, kind: Column) -> Column:
    """The form shared by all mentions of an entity."""
    digits = F.regexp_replace(mention, "[^0-9]", "")
    return (
        F.when(kind == "email", F.lower(mention))
        .when(kind == "phone", F.regexp_replace(mention, "[^0-9+]", ""))
        .when(kind.isin("card", "ssn"), digits)
        .when(kind == "iban", F.regexp_replace(mention, " ", ""))
        .when(kind.isin(*_SECRETS), F.substring(mention, F.length(secret_head(mention)) + 1, F.length(mention)))
        .when(kind == "name", F.lower(F.regexp_replace(mention, r"^(\S+?)\.? ", "$1 ")))
        .otherwise(mention)
    )


def mentions_of(texts: DataFrame) -> DataFrame:
    """(text_key, mention, kind, canonical): the distinct mentions of every distinct text."""
    listed = F.array_distinct(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)))
    found = texts.select(F.md5("text").alias("text_key"), F.explode(listed).alias("mention")).distinct()
    runs = is_run(F.col("mention"))
    cards = found.where(runs).select("text_key", F.explode(F.array_distinct(cards_in(F.col("mention")))).alias("mention")).distinct()
    found = (
        found.where(~runs).withColumn("kind", kind_of("mention"))
        .unionByName(cards.withColumn("kind", F.lit("card")))
        .withColumn("canonical", canonical_of(F.col("mention"), F.col("kind")))
    )
    mask = F.col("kind").isin(*_SECRETS) & F.col("canonical").rlike(MASK)
    return found.where(F.col("kind").isNotNull() & ~mask)


def draw(seed: Column, at: Column) -> Column:
    """A number from 0 to 65535 for position ``at`` of a keyed stream."""
    block = F.sha2(F.concat_ws("|", seed, F.floor(at / 16).cast("string")), 256)
    return F.conv(F.substring(block, (at % 16 * 4 + 1).cast("int"), F.lit(4)), 16, 10).cast("int")


def listed(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def pick(words: Column, seed: Column, at: int) -> Column:
    return F.element_at(words, draw(seed, F.lit(at)) % F.size(words) + 1)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the expression of ``value`` in the plan once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def code_point(number: Column) -> Column:
    """The character of a code point below 65536."""
    return F.decode(F.unhex(F.lpad(F.hex(number.cast("long")), 4, "0")), "UTF-16BE")


def like_character(c: Column, number: Column, any_script: bool) -> Column:
    """Another character of the same class and script; only ASCII is looked at without ``any_script``."""
    out = F.when(F.lit(False), c)
    for pattern, letters in ALPHABETS.items():
        if not any_script and not letters.isascii():
            break
        out = out.when(c.rlike(pattern), F.substring(F.lit(letters), number % len(letters) + 1, F.lit(1)))
    if not any_script:
        return out.otherwise(c)
    for script, (first, size) in (("IsHan", HAN), ("IsHangul", HANGUL)):
        out = out.when(c.rlike(rf"[\p{{{script}}}&&\p{{L}}]"), code_point(number % size + first))
    # Any other letter or digit: one of the same script and case near it.
    case = F.when(c.rlike(r"\p{Lu}"), "-1").when(c.rlike(r"\p{Nd}"), "-2").otherwise("-0")
    row = F.concat(F.shiftright(F.ascii(c), 4).cast("string"), case)
    near = F.try_element_at(F.str_to_map(F.lit(BLOCK_ALPHABETS), F.lit(","), F.lit(":")), F.try_element_at(F.str_to_map(F.lit(ALPHABET_ROWS), F.lit(","), F.lit(":")), row))
    other = F.substring(near, number % F.length(near) + 1, F.lit(1))
    return out.when(c.rlike(r"[\p{L}\p{Nd}]"), F.coalesce(other, c)).otherwise(c)


def surrogate_of(kind: Column, canonical: Column, seed: Column) -> Column:
    """The drawn surrogate in canonical form."""
    size = F.length(canonical)
    places = F.sequence(F.lit(1), size)

    def rewritten(first: Column, last: Column, any_script: bool = False) -> Column:
        """The places from ``first`` to ``last`` drawn anew, the others as they are."""
        def one(i: Column) -> Column:
            c = F.substring(canonical, i, F.lit(1))
            other = bound(draw(seed, i), lambda number: like_character(c, number, any_script))
            return F.when((i >= first) & (i <= last), other).otherwise(c)
        return F.array_join(F.transform(places, one), "")

    def signs(letters: str) -> Column:
        return F.array_join(F.transform(places, lambda i: F.substring(F.lit(letters), draw(seed, i) % len(letters) + 1, F.lit(1))), "")

    hexed = F.array_join(F.transform(places, lambda i: F.substring(F.lit("0123456789abcdef"), draw(seed, i) % 16 + 1, F.lit(1))), "")
    # The label after the last dot of an address stays.
    tld = F.length(F.substring_index(canonical, ".", -1)) + 1
    country = F.when(canonical.startswith("+1"), 2).when(canonical.startswith("+"), 3).otherwise(0)
    head = F.substring(rewritten(F.lit(2), size - 1), F.lit(1), size - 1)

    def with_check(digits: Column) -> Column:
        check = (10 - luhn_sum(F.concat(digits, F.lit("0"))) % 10) % 10
        return F.concat(digits, check.cast("string"))

    octets = [F.concat_ws(".", *[(draw(seed, F.lit(i)) % 254 + 1).cast("string") for i in range(4)])]
    script = F.when(canonical.rlike(r" \p{IsCyrillic}"), "cyrillic").otherwise("latin")
    title = F.substring_index(canonical, " ", 1)
    gender = F.lit(None).cast("string")
    given, syllables = (F.lit(None).cast("array<string>") for _ in range(2))
    for one in ("male", "female", "any"):
        gender = F.when(title.isin([t.lower() for t in TITLES[one]]), one).otherwise(gender)
    for way in SYLLABLES:
        syllables = F.when(script == way, listed(SYLLABLES[way])).otherwise(syllables)
        for one in ("male", "female", "any"):
            given = F.when((script == way) & (gender == one), listed(GIVEN[f"{way}_{one}"])).otherwise(given)
    surname = bound(syllables, lambda words: F.concat(*[pick(words, seed, 2 + i) for i in range(5)]))
    called = bound(given, lambda words: F.lower(pick(words, seed, 1)))
    # A single name is a surname.
    full = F.when(F.size(F.split(canonical, " ")) > 2, F.concat_ws(" ", title, called, surname)).otherwise(F.concat_ws(" ", title, surname))
    name = F.when(gender.isNotNull(), full)
    return (
        F.when(kind.isin(*_SECRETS) & canonical.rlike("^[0-9a-f]+$"), hexed)
        .when((kind == "password") & ~canonical.rlike(r"[\p{L}\p{N}]"), signs(SIGNS["password"]))
        .when((kind == "token") & ~canonical.rlike(r"[\p{L}\p{N}]"), signs(SIGNS["token"]))
        .when(kind.isin("access", "iban", "phone"), rewritten(F.when(kind == "access", 5).when(kind == "iban", 3).otherwise(country + 1), size))
        .when(kind == "ip", octets[0])
        .when(kind == "card", bound(head, with_check))
        .when(kind == "name", name)
        .otherwise(rewritten(F.lit(1), F.when(kind == "email", size - tld).otherwise(size), any_script=True))
    )


def numbered(kind: Column, surrogate: Column, number: Column) -> Column:
    """A surrogate made longer by a number; cards, addresses and SSNs have a fixed form and many draws."""
    digits = number.cast("string")

    def spelled(script: str) -> Column:
        words = F.array(*[F.lit(w) for w in SYLLABLES[script][:10]])
        return F.array_join(F.transform(F.split(digits, ""), lambda d: F.element_at(words, d.cast("int") + 1)), "")

    return (
        F.when(kind.isin("card", "ip", "ssn"), surrogate)
        .when(kind == "email", F.regexp_replace(surrogate, F.lit("@"), F.concat(digits, F.lit("@"))))
        .when(kind == "name", F.concat(surrogate, F.when(surrogate.rlike(r"\p{IsCyrillic}$"), spelled("cyrillic")).otherwise(spelled("latin"))))
        .otherwise(F.concat(surrogate, digits))
    )


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, surrogate) with distinct surrogates per type, none of them a real entity.

    Each round keeps the draws that collide with nothing kept so far, nothing drawn by a smaller
    entity, and no real entity; the rest draw again.  When a round settles nothing, or after
    MOST_DRAWS rounds, draws get a number that grows with the rounds, so that they must end.
    """
    seed = F.sha2(F.concat_ws("|", F.lit(key), "kind", "canonical", F.col("round").cast("string")), 256)
    spark = entities.sparkSession
    open_rows = staged(entities.select("kind", "canonical").distinct(), "pii-entities")
    real = open_rows.select(F.col("kind").alias("__kind"), F.col("canonical").alias("__real"))
    kept = spark.createDataFrame([], "kind string, canonical string, surrogate string")
    left, number, longer = open_rows.count(), 0, 0
    while left:
        drawn = open_rows.withColumn("round", F.lit(number)).withColumn("seed", seed)
        drawn = drawn.select("kind", "canonical", surrogate_of(F.col("kind"), F.col("canonical"), F.col("seed")).alias("surrogate"))
        if longer:
            alike = Window.partitionBy("kind", "surrogate").orderBy("canonical")
            drawn = drawn.withColumn("__n", F.row_number().over(alike) + (longer - 1))
            drawn = drawn.select("kind", "canonical", numbered(F.col("kind"), F.col("surrogate"), F.col("__n")).alias("surrogate"))
        drawn = staged(drawn, "pii-drawn")
        taken = real.union(kept.select("kind", "surrogate"))
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical"))
        good = first.join(taken, (F.col("kind") == F.col("__kind")) & (F.col("surrogate") == F.col("__real")), "left_anti")
        kept = staged(kept.unionByName(good.select("kind", "canonical", "surrogate")), "pii-kept")
        open_rows = staged(open_rows.join(kept, ["kind", "canonical"], "left_anti"), "pii-open")
        before, left, number = left, open_rows.count(), number + 1
        if longer or left == before or number >= MOST_DRAWS:
            longer += 1
    return kept


def in_format(mention: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate written the way the mention was: separators, case, quotes and heads."""
    places = F.sequence(F.lit(1), F.length(mention))

    def spread(inside: str) -> Column:
        def one(i: Column) -> Column:
            c = F.substring(mention, i, F.lit(1))
            before = F.length(F.regexp_replace(F.substring(mention, F.lit(1), i), f"[^{inside}]", ""))
            return F.when(c.rlike(f"[{inside}]"), F.substring(surrogate, before, F.lit(1))).otherwise(c)
        used = F.length(F.regexp_replace(mention, f"[^{inside}]", ""))
        return F.concat(F.array_join(F.transform(places, one), ""), F.substring(surrogate, used + 1, F.length(surrogate)))

    def cased(i: Column) -> Column:
        c, s = F.substring(mention, i, F.lit(1)), F.substring(surrogate, i, F.lit(1))
        return F.when(c != F.lower(c), F.upper(s)).otherwise(s)

    title = F.regexp_extract(mention, r"^\S+ ", 0)
    rest = F.substring(surrogate, F.instr(surrogate, " ") + 1, F.length(surrogate))
    return (
        F.when((kind == "email") & (F.length(surrogate) > F.length(mention)), surrogate)
        .when(kind == "email", F.array_join(F.transform(places, cased), ""))
        .when(kind == "phone", spread("0-9+"))
        .when(kind.isin("card", "ssn"), spread("0-9"))
        .when(kind == "iban", spread("A-Z0-9"))
        .when(kind.isin(*_SECRETS), F.concat(secret_head(mention), surrogate))
        .when(kind == "name", F.concat(title, F.initcap(rest)))
        .otherwise(surrogate)
    )


def replace_mentions(docs: DataFrame, key: str = KEY) -> DataFrame:
    """The documents with surrogates in ``text``, plus ``n_replaced``; other columns as they were.

    NULL and empty texts stay; ids may be null or repeated.  An input column n_replaced is replaced.
    """
    own = [c for c in docs.columns if c != "n_replaced"]
    packed = docs.select(F.struct(*own).alias("__row"), F.col("text").cast("string").alias("__text"))
    has = F.coalesce(may_mention("__text") & F.col("__text").rlike(PATTERN), F.lit(False))
    with_mentions = packed.where(has)
    mentions = staged(mentions_of(with_mentions.select(F.col("__text").alias("text"))), "pii-mentions")
    table = surrogate_table(mentions, key)
    # One row per text: its mentions and what they become.
    per_text = (
        mentions.join(table, ["kind", "canonical"])
        .groupBy("text_key")
        .agg(F.map_from_entries(F.collect_list(F.struct("mention", in_format(F.col("mention"), F.col("kind"), F.col("surrogate"))))).alias("__map"))
        .withColumnRenamed("text_key", "__key")
    )
    joined = with_mentions.join(per_text, F.md5("__text") == F.col("__key"), "left")
    found = F.regexp_extract_all("__text", F.lit(PATTERN), F.lit(0))
    pieces = F.split("__text", PATTERN, -1)
    becomes = F.transform(found, lambda m: F.when(is_run(m), with_cards(m, cards_in(m), F.col("__map"))).otherwise(F.coalesce(F.element_at("__map", m), m)))
    text = F.array_join(F.zip_with(pieces, becomes, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    entities = F.flatten(F.transform(found, lambda m: F.when(is_run(m), cards_in(m)).otherwise(F.array(m))))
    count = F.size(F.filter(entities, lambda m: F.element_at("__map", m).isNotNull())).cast("long")
    changed = joined.select("__row", F.when(F.col("__map").isNotNull(), text).otherwise(F.col("__text")).alias("__new"), F.coalesce(F.when(F.col("__map").isNotNull(), count), F.lit(0).cast("long")).alias("n_replaced"))
    unchanged = packed.where(~has).select("__row", F.col("__text").alias("__new"), F.lit(0).cast("long").alias("n_replaced"))
    return changed.unionByName(unchanged).select(
        *[F.col("__new").alias(c) if c == "text" else F.col("__row")[c].alias(c) for c in own], "n_replaced"
    )


def surrogate_documents(docs: DataFrame, key: str = KEY) -> DataFrame:
    """(doc_id, text, n_replaced) of every document."""
    return replace_mentions(docs.select("doc_id", "text"), key)
