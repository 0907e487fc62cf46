"""Surrogates for personal data. DataFrame functions only.

Entities are marked by one pattern, keyed surrogates of their type and format are
made once per distinct entity of the corpus, checked against each other and against the
real entities, and put in the entities' places. The same entity gets the same
surrogate everywhere, different ones get different surrogates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.frames import written
from feedloom.llm.common import free_name

# Forms of address, by the gender they tell, and particles of surnames.
_MALE = "Mr|Mister|Sir|Herr|Herrn|Monsieur|Señor|Don|господин|κύριος"
_FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mademoiselle|Señora|Señorita|Doña|госпожа|κυρία"
_NEUTRAL = "Dr|Doctor|Prof|Professor|Mx|доктор|профессор"
_PARTICLE = r"(?:von|van|de|del|della|di|da|du|dos|le|al|bin|ibn|ter|ten|zu|zum)\x20(?:(?:der|den|dem|la|los)\x20)?"
_PARTICLES = f"(?:{_PARTICLE})?" * 2
# Names with these endings are a woman's.
_WOMANS = "(?:ова|ева|ёва|ина|ына|ая|ου)$"

_FORMS = f"(?:{_MALE}|{_FEMALE}|{_NEUTRAL})"
_TITLE = rf"(?<!\p{{L}}){_FORMS}\.?\x20{_PARTICLES}"
_WORD = rf"(?:(?!{_FORMS}\.?\x20)(?:[ODLM]['’])?\p{{Lu}}[\p{{L}}\p{{M}}]*+|\p{{IsHan}}{{1,3}}+)"
# Words that follow each other, with hyphens, particles and points after initials between them.
_NAMES = rf"{_WORD}(?:(?:-|(?:(?<=(?<!\p{{L}})\p{{Lu}})\.)?\x20{_PARTICLES}){_WORD})*+"

_SECRET = r"(?i:password|passwd|secret|token|api_key|apikey)(?:\x20?[=:]\x20?|\x20is:?\x20)[\"']?"
# Letters that have two cases; scripts without spaces may stand right before an address.
_CASED = r"\p{Lu}\p{Ll}\p{N}"
_HEX = "[0-9A-Fa-f]{1,4}"

# Types in the order in which they are tried. No pattern has a capturing group; repeats that
# could be tried again at every length are possessive, and lengths are bounded only where a standard
# bounds them (host names, phone numbers, IBANs, cards).
PATTERNS: dict[str, str] = {
    "email": rf"(?<![{_CASED}_.%+-])[{_CASED}_.%+-]++@[{_CASED}](?:[{_CASED}-]{{0,62}}\.){{1,127}}[\p{{Lu}}\p{{Ll}}]{{2,63}}(?![{_CASED}_])",
    # the short look-behinds are cheap and spare the long one at most places
    "secret": rf"(?<=[=:\"']|[=:]\x20)(?<={_SECRET})[A-Za-z0-9+/_-]{{8,}}+"
    rf"|(?<=is:?\x20[\"']?)(?<={_SECRET})(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{{6,}}+"
    r"|\bAKIA[0-9A-Z]{16}\b|\b(?=[0-9]*+[a-f])(?=[a-f]*+[0-9])[0-9a-f]{32,}+\b",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)",
    "ip6": rf"(?<![\w:.])(?=[0-9A-Fa-f]{{0,4}}:)(?=[A-Fa-f:]*+[0-9])(?:(?:{_HEX}:){{7}}{_HEX}|(?=[0-9A-Fa-f:]*?::)(?:{_HEX})?(?:::?{_HEX}){{1,7}}(?:::)?)(?![\w:])",
    "iban": r"\b[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
    "phone": r"\+\d{1,3}[\x20-]?\(?\d{2,4}\)?(?:[\x20-]?\d{2,4}){2,4}+\b"
    r"|(?<![\d(.-])(?:\(\d{3}\)\x20?|\d{3}[.-])\d{3}[.-]\d{4}(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d-])\d{4}(?:([\x20-]?)\d{4}){2}[\x20-]?\d{1,7}(?![\d-])".replace("([", "(?:["),
    "name": rf"(?=[\p{{Lu}}\p{{IsHan}}])(?<=[\p{{L}}.]\x20)(?<={_TITLE}){_NAMES}",
}
_EITHER = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Entities whose surrogates one task makes.
_TASK_ENTITIES = 5_000
_NAME_KINDS = ("given_f", "given_m", "given_n", "surname")
_MARK = "\x01"
# A text that holds the mark itself is read with the mark (and the letter it becomes) spelled out.
_ESCAPE = "\x02"


def _cut(text: Column, pattern: Column) -> Column:
    """The text's pieces: between matches at even places, matches at odd ones."""
    return F.split(F.regexp_replace(text, pattern, F.lit(f"{_MARK}$1{_MARK}")), _MARK)


def _marked(text: Column) -> Column:
    """The text's pieces: between entities at even places, entities at odd ones."""
    plain = F.when(
        text.contains(_MARK) | text.contains(_ESCAPE),
        F.replace(F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPE + "b")), F.lit(_MARK), F.lit(_ESCAPE + "a")),
    ).otherwise(text)
    return _cut(plain, F.lit(f"({_EITHER})"))


def _unescaped(text: Column) -> Column:
    return F.when(
        text.contains(_ESCAPE),
        F.replace(F.replace(text, F.lit(_ESCAPE + "a"), F.lit(_MARK)), F.lit(_ESCAPE + "b"), F.lit(_ESCAPE)),
    ).otherwise(text)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of the value, which is computed once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _piece(text: Column, kind: Column | None = None) -> Column:
    return F.struct(text.alias("t"), (F.lit(None) if kind is None else kind).cast("string").alias("kind"))


def _by_word(parts: Column) -> Column:
    """Pieces (t, kind) with names cut into words: given names by the form of address before them, surnames last."""

    def words(names: Column, before: Column) -> Column:
        given = F.lit("given_n")
        for kind, forms in (("given_f", _FEMALE), ("given_m", _MALE)):
            given = F.when(before.rlike(rf"(?<!\p{{L}})(?:{forms})\.?\x20{_PARTICLES}$"), F.lit(kind)).otherwise(given)

        def kinds(told: Column) -> Column:
            pieces, last = told["pieces"], told["last"]
            return F.transform(
                pieces,
                lambda x, i: _piece(
                    x, F.when(i % 2 == 1, F.lit(None)).otherwise(F.when(i < last, told["given"]).otherwise(F.lit("surname")))
                ),
            )

        # nothing stands before the first word and after the last one
        cut = _cut(names, F.lit(f"({_WORD})"))
        pieces = _let(cut, lambda x: F.slice(x, 2, F.size(x) - 2))
        # the last piece with a space, after which the surname stands
        last = F.aggregate(
            F.transform(pieces, lambda x, i: F.when(x.contains(" "), i).otherwise(-1)), F.lit(-1), lambda a, x: F.greatest(a, x)
        )
        return _let(F.struct(pieces.alias("pieces"), last.alias("last"), given.alias("given")), kinds)

    def part(x: Column, i: Column) -> Column:
        before = F.element_at(parts, i)
        named = (i % 2 == 1) & x.rlike(f"^{_NAMES}$") & F.when(i > 0, before).rlike(f"{_TITLE}$")
        return F.when(named, words(x, before)).otherwise(F.array(_piece(x)))

    return F.flatten(F.transform(parts, part))


def _bare_names(pieces: Column) -> Column:
    """The pieces with later or earlier mentions of a text's names, without a form of address, marked too."""
    names = F.filter(pieces, lambda p: p["kind"].isNotNull() & (F.length(p["t"]) > 1))

    def asked(names: Column) -> Column:
        forms = F.flatten(F.transform(names, lambda p: F.array(p["t"], F.upper(p["t"]))))
        pattern = F.concat(
            F.lit(r"(?<![\p{L}\p{M}])("), F.array_join(F.array_distinct(forms), "|"), F.lit(r")(?![\p{L}\p{M}])")
        )
        known = F.transform(names, lambda p: F.struct(F.lower(p["t"]).alias("word"), p["kind"].alias("kind")))
        # one kind per word
        return F.struct(pattern.alias("pattern"), F.array_distinct(known).alias("known"))

    def marked(told: Column) -> Column:
        def kind(word: Column) -> Column:
            return F.element_at(F.filter(told["known"], lambda n: n["word"] == F.lower(word)), 1)["kind"]

        def part(x: Column, i: Column) -> Column:
            cut = F.transform(_cut(x["t"], told["pattern"]), lambda t, j: _piece(t, F.when(j % 2 == 1, kind(t))))
            return F.when(i % 2 == 0, cut).otherwise(F.array(x))

        return F.flatten(F.transform(pieces, part))

    return F.when(F.exists(pieces, lambda p: p["kind"].isNotNull() & (F.length(p["t"]) > 1)), _let(_let(names, asked), marked)).otherwise(pieces)


def _type(entity: Column, before: Column) -> Column:
    """The type of an entity that is no name."""
    kind = F.when(entity.rlike(r"^[^@]+@[^@]+$"), F.lit("email"))
    shapes = {
        "ip": r"^(?:\d{1,3}\.){3}\d{1,3}$",
        "ip6": r"^[0-9A-Fa-f:]*:[0-9A-Fa-f:]*$",
        "phone": r"^(?:\+[\d\x20()-]+|(?:\(\d{3}\)\x20?|\d{3}[.-])\d{3}[.-]\d{4})$",
        "ssn": r"^\d{3}-\d{2}-\d{4}$",
        "card": r"^\d{4}[\d\x20-]{9,}$",
        "iban": r"^[A-Z]{2}\d{2}[A-Z0-9\x20]{8,}$",
    }
    for t, shape in shapes.items():
        kind = kind.when(entity.rlike(shape) & ~before.rlike(f"{_SECRET}$"), F.lit(t))
    return kind.otherwise(F.lit("secret"))


def _canon(kind: Column, entity: Column) -> Column:
    """What two mentions of the same entity have in common, whatever their format."""
    return (
        F.when(kind.isin("email", "ip", "ip6", *_NAME_KINDS), F.lower(entity))
        .when(kind == "secret", entity)
        .otherwise(F.lower(F.regexp_replace(entity, "[^0-9A-Za-z]", "")))
    )


def _byte(digest: Column, i: Column) -> Column:
    """The i-th byte (from 0) of a hex digest of 64 bytes, read in a circle."""
    at = (F.pmod(i, F.lit(64)) * 2 + 1).cast("int")
    return F.conv(F.substring(digest, at, F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, byte: Column) -> Column:
    return F.substring(F.lit(letters), (F.pmod(byte, F.lit(len(letters))) + 1).cast("int"), F.lit(1))


def _same_form(value: Column, digest: Column, keep: Column) -> Column:
    """Digits for digits and letters of the same case for letters after the first ``keep`` characters.

    Values of hex digits only stay hex digits.
    """
    hexes = value.rlike("^[0-9a-f]+$") & value.rlike("[a-f]")

    def one(c: Column, i: Column) -> Column:
        b = _byte(digest, i)
        return (
            F.when(i < keep, c)
            .when(c.rlike("[0-9]"), _pick("0123456789", b))
            .when(c.rlike("[a-z]") & hexes, _pick("abcdef", b))
            .when(c.rlike("[a-z]"), _pick("abcdefghijklmnopqrstuvwxyz", b))
            .when(c.rlike("[A-Z]"), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", b))
            .when(c.rlike("[а-я]"), _pick("абвгдежзиклмнопрстуфхцчшэюя", b))
            .when(c.rlike("[α-ω]"), _pick("αβγδεζηθικλμνξοπρστυφχψω", b))
            .when(c.rlike(r"\p{L}"), _pick("abcdefghijklmnopqrstuvwxyz", b))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _luhn(digits: Column) -> Column:
    """The number with its last digit set so that the Luhn sum is a multiple of ten."""
    n = F.length(digits)

    def part(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.pmod(n - i, F.lit(2)) == 0  # counted from the right, the last digit is not doubled
        return F.when(i == n - 1, 0).when(twice, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    total = F.aggregate(F.transform(F.split(digits, ""), part), F.lit(0), lambda a, x: a + x)
    return F.concat(F.substring(digits, F.lit(1), n - 1), F.pmod(-total, F.lit(10)).cast("string"))


def _name(kind: Column, canon: Column, digest: Column, attempt: Column) -> Column:
    """Syllables of the name's script; given names, and surnames where they tell it, end as names of their gender do.

    More syllables from every third attempt on, so there is always another name.
    """
    scripts = (  # syllables, consonants, vowels, endings of given_f, given_m, given_n, surname and a woman's surname
        (r"\p{IsHan}", 1, "王李张刘陈杨赵黄周吴徐孙", "明华文国建平志春海云", ("芳", "伟", "文", "", "")),
        (r"\p{IsCyrillic}", 2, "бвгдзклмнпрст", "аеиоу", ("а", "н", "и", "ов", "ова")),
        (r"\p{IsGreek}", 2, "βγδκλμνπρστ", "αειου", ("α", "ος", "ι", "ης", "ου")),
        (r"", 2, "bdfglmnprstvz", "aeiou", ("a", "n", "i", "er", "er")),
    )
    made = None
    for script, least, consonants, vowels, (f, m, n, surname, womans) in scripts:
        syllables = F.transform(
            F.sequence(F.lit(1), F.lit(least) + F.floor(attempt / 3).cast("int")),
            lambda i: F.concat(_pick(consonants, _byte(digest, 2 * i)), _pick(vowels, _byte(digest, 2 * i + 1))),
        )
        link = F.lit("") if least == 1 else _pick(consonants, _byte(digest, F.lit(0)))
        end = (
            F.when(kind == "given_f", F.concat(link, F.lit(f)))
            .when(kind == "given_m", F.lit(m))
            .when(kind == "given_n", F.concat(link, F.lit(n)))
            .otherwise(F.concat(link, F.when(canon.rlike(_WOMANS), F.lit(womans)).otherwise(F.lit(surname))))
        )
        name = F.concat(F.array_join(syllables, ""), end)
        made = F.when(canon.rlike(script), name) if made is None else made.when(canon.rlike(script), name)
    return made


def _surrogate(key: str, kind: Column, canon: Column, host: Column, attempt: Column, roomy: int) -> Column:
    """The keyed surrogate of a canonical entity; another one at each attempt.

    ``host`` is the surrogate of an address's domain. From attempt ``roomy`` on values get longer, so that
    a format without free values left finds one.
    """

    def digest(*parts: Column) -> Column:
        first = F.sha2(F.concat_ws("|", F.lit(key), *parts), 256)
        return F.concat(first, F.sha2(F.concat(first, F.lit(key)), 256))

    own = digest(kind, canon, attempt.cast("string"))
    zero = F.lit(0)
    longer = F.when(attempt > 3, attempt.cast("string")).otherwise("")
    email = F.concat(_same_form(F.substring_index(canon, "@", 1), own, zero), longer, F.lit("@"), host)
    # a domain keeps its ending
    ending = F.substring_index(canon, ".", -1)
    domain = F.substring(canon, F.lit(1), F.length(canon) - F.length(ending) - 1)
    domain = F.concat(_same_form(domain, own, zero), longer, F.lit("."), ending)
    ip = F.concat_ws(".", *[(1 + F.pmod(_byte(own, F.lit(i)), F.lit(254))).cast("string") for i in range(4)])
    hexes = F.transform(
        F.split(canon, ""),
        lambda c, i: F.when(c.rlike("[0-9a-f]"), _pick("123456789abcdef", _byte(own, i))).otherwise(c),
    )
    whole = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.substring(own, 4 * i + 1, F.lit(4))), ":")
    keep = (
        F.when(kind == "card", 1)
        .when(kind == "phone", F.greatest(F.length(canon) - 10, F.lit(1)))
        .when(kind == "iban", 2)
        .when(canon.startswith("AKIA"), 4)
        .otherwise(0)
    )
    digits = F.regexp_replace(own, "[^0-9]", "")
    form = F.concat(
        _same_form(canon, own, keep),
        F.when(attempt >= roomy, F.substring(digits, F.lit(1), attempt - roomy + 1)).otherwise(""),
    )
    return (
        F.when(kind == "email", email)
        .when(kind == "domain", domain)
        .when(kind == "ip", ip)
        .when(kind == "ip6", F.when(attempt > 3, whole).otherwise(F.array_join(hexes, "")))
        .when(kind.isin(*_NAME_KINDS), _name(kind, canon, own, attempt))
        .when(kind == "card", _luhn(form))
        .otherwise(form)
    )


def _rendered(kind: Column, entity: Column, surrogate: Column) -> Column:
    """The surrogate in the format of one mention."""

    def one(c: Column, i: Column) -> Column:
        place = F.length(F.regexp_replace(F.substring(entity, F.lit(1), i + 1), "[^0-9A-Za-z]", ""))
        ours = F.substring(surrogate, place, F.lit(1))
        return (
            F.when(~c.rlike("[0-9A-Za-z]"), c).when(c.rlike("[A-Z]"), F.upper(ours)).otherwise(ours)
        )

    name = (
        F.when(entity.rlike(r"^\p{Lu}{2,}$"), F.upper(surrogate))
        .when(entity.rlike("^.['’]"), F.concat(F.substring(entity, 1, 2), F.initcap(surrogate)))
        .otherwise(F.initcap(surrogate))
    )
    room = F.length(F.regexp_replace(entity, "[^0-9A-Za-z]", ""))
    return (
        F.when(kind.isin("email", "ip", "ip6", "secret"), surrogate)
        .when(kind.isin(*_NAME_KINDS), name)
        .otherwise(
            F.concat(
                F.array_join(F.transform(F.split(entity, ""), one), ""),
                F.substring(surrogate, room + 1, F.length(surrogate)),
            )
        )
    )


def _distinct_surrogates(entities: DataFrame, key: str, roomy: int) -> DataFrame:
    """(kind, canon, host, surrogate): those that collide try again until none does."""
    real = written(entities.distinct())

    def tried(attempt: Column) -> Column:
        return _surrogate(key, F.col("kind"), F.col("canon"), F.col("host"), attempt, roomy)

    # digests are work for a processor, few bytes: dealt by number
    tasks = real.count() // _TASK_ENTITIES + 1
    now = written(real.repartition(tasks).withColumn("attempt", F.lit(0)).withColumn("surrogate", tried(F.lit(0))))
    while True:
        shared = now.groupBy("kind", "surrogate").agg(
            F.min(F.struct("attempt", "canon")).alias("keeper"), F.count("*").alias("n")
        ).filter("n > 1").select("kind", "surrogate", F.col("keeper.canon").alias("keeper"))
        taken = now.join(
            real.select("kind", F.col("canon").alias("surrogate")), ["kind", "surrogate"], "left_semi"
        ).select("kind", "surrogate").distinct()
        bad = (
            now.join(shared, ["kind", "surrogate"]).filter("canon <> keeper").select("kind", "canon")
            .union(now.join(taken, ["kind", "surrogate"]).select("kind", "canon"))
            .distinct()
        )
        bad = written(bad.withColumn("again", F.lit(True)))
        if bad.isEmpty():
            return now.drop("attempt")
        again = F.col("again").isNotNull()
        now = written(
            now.join(bad, ["kind", "canon"], "left")
            .withColumn("attempt", F.col("attempt") + again.cast("int"))
            .withColumn("surrogate", F.when(again, tried(F.col("attempt"))).otherwise(F.col("surrogate")))
            .drop("again")
        )


def assign(entities: DataFrame, key: str, roomy: int = 40) -> DataFrame:
    """(kind, canon, surrogate) of distinct entities (kind, canon), without collisions.

    A surrogate that two entities of a type share, or that is itself a real entity
    of the type, is tried again until there is none; of sharers the smallest keeps it. After
    ``roomy`` attempts a crowded format gets longer values. Domains of addresses are
    entities of their own, so different domains stay different.
    """
    none = F.lit(None).cast("string")
    domain = F.when(F.col("kind") == "email", F.substring_index("canon", "@", -1))
    listed = written(entities.select("kind", "canon", domain.alias("domain")).distinct())
    domains = listed.filter("domain IS NOT NULL").select(F.lit("domain").alias("kind"), F.col("domain").alias("canon"), none.alias("host"))
    hosts = _distinct_surrogates(domains, key, roomy).select(F.col("canon").alias("domain"), F.col("surrogate").alias("host"))
    hosted = listed.join(hosts, "domain", "left").select("kind", "canon", "host")
    return _distinct_surrogates(hosted, key, roomy).drop("host")


def with_surrogates(
    docs: DataFrame, key: str, text: str = "text", n_entities: str = "n_entities"
) -> DataFrame:
    """The input rows with every entity of ``text`` replaced, and the number of entities.

    Types: e-mail addresses, passwords, tokens and keys, IPv4 and IPv6 addresses, phone numbers,
    IBANs, card numbers (with a valid check digit), social security numbers, and names:
    all capitalised words (or one to three Han characters) after a form of address, and the same words
    of two letters or more anywhere else in the text. Formats, letter case, issuer and country prefixes stay; names
    keep gender and script, particles stay, and a given name that follows a neutral form gets a neutral one. Mentions that differ only in separators are one entity. Null texts stay null;
    texts without an entity are unchanged; all rows and columns stay. ``docs`` must
    not have a column named like ``n_entities``.
    """
    rid, parts = free_name(docs.columns, "rid"), free_name(docs.columns, "parts")
    marked = written(
        docs.withColumn(parts, _marked(F.col(text)))
        .drop(text)
        .withColumn(parts, F.when(F.size(parts) > 1, _by_word(F.col(parts))).otherwise(F.transform(parts, lambda x: _piece(x))))
        .withColumn(parts, _bare_names(F.col(parts)))
        .withColumn(rid, F.monotonically_increasing_id())
    )
    several = F.size(parts) > 1
    found = marked.filter(several).select(
        F.col(rid).alias("rid"),
        F.explode(
            F.filter(
                F.transform(
                    F.col(parts),
                    lambda x, i: F.struct(
                        i.alias("i"),
                        x["t"].alias("entity"),
                        x["kind"].alias("kind"),
                        F.when(i > 0, F.element_at(parts, i)["t"]).otherwise("").alias("before"),
                    ),
                ),
                lambda s: s["i"] % 2 == 1,
            )
        ).alias("e"),
    ).select("rid", "e.*")
    typed = found.withColumn("kind", F.coalesce("kind", _type(F.col("entity"), F.col("before"))))
    mentions = written(
        typed.select("rid", "i", "entity", "kind").withColumn("canon", _canon(F.col("kind"), F.col("entity")))
    )
    given = written(assign(mentions.select("kind", "canon"), key))
    replaced = (
        mentions.join(given, ["kind", "canon"])
        .select("rid", "i", _rendered(F.col("kind"), F.col("entity"), F.col("surrogate")).alias("new"))
        .groupBy("rid")
        # one document's own entities
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "new"))), lambda s: s["new"]).alias("news"))
    )
    news = free_name(docs.columns, "news")
    mended = marked.filter(several).join(
        replaced.select(F.col("rid").alias(rid), F.col("news").alias(news)), rid
    )
    whole = F.array_join(
        F.transform(
            F.col(parts),
            lambda x, i: F.when(i % 2 == 1, F.element_at(news, F.floor(i / 2).cast("int") + 1)).otherwise(x["t"]),
        ),
        "",
    )

    def shown(df: DataFrame, value: Column, n: Column) -> DataFrame:
        columns = [_unescaped(value).alias(c) if c == text else F.col(c) for c in docs.columns]
        return df.select(*columns, n.cast("long").alias(n_entities))

    untouched = marked.filter(F.col(parts).isNull() | ~several)
    return shown(mended, whole, F.size(news)).union(
        shown(untouched, F.element_at(parts, 1)["t"], F.lit(0))
    )
