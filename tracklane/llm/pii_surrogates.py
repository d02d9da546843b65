"""PII: entities get keyed surrogates of their own type, gender, script and format, in DataFrame expressions only.

An entity's core is drawn from a keyed hash of its type and canonical form (lower case; of numbers the digits, of phone
numbers without a leading 1), so the same entity has the same surrogate everywhere (coreference) and any spelling of it
keeps its own punctuation. A name that a text gives with a title is replaced wherever its words stand in that text as
whole words in the same case. A given name is one entity whatever its titles; its gender only chooses the surrogate's
ending: that of the first title in the text that tells one for this name, else the one that all such titles of the corpus
tell, else neither. Cores are checked over the whole corpus: where two entities of a type would share one, or
a core is some entity's own form, all but the least canonical form draw again with the next attempt; names then get
longer, so their space has no end. Only entities that move take part in a further round, and only their attempts are
joined back, to the documents that hold one; all other text is rewritten where it is read. Formats of fixed length (card,
SSN, phone, IP) can hold only so many distinct entities: beyond MAX_ATTEMPTS rounds the job ends with an error.

Null texts stay null with zero counts; texts without entities come back as they are. Repeated rows are rewritten alike.
An empty table gives no rows. Very long texts are like any others. Surrogates keep what is no letter or digit; e-mail
domains become subdomains of example.com; card numbers that satisfy the Luhn check still do, IBANs the mod-97 check.

The key is a parameter; the query takes it from the setting spark.tracklane.pii.key, and only without one from KEY.

Phone numbers are found with an area code in brackets, with a plus (spaced or E.164), as ten digits 3-3-4 with or without
1 in front, or in three groups with 0 in front (020 7946 0958). Not found: phone numbers without any sign or gap
(5551234567), without an area code (555-1234), with 00 for the plus (0044 20 7946 0958); IPv6 addresses with fewer than
two groups before the gap (::1); cards in other groups than 4-4-4-4 and 4-6-5; SSNs in spaces; names that have nowhere in
the text a title of the lists below and a space after it, in capitals or small letters only, or beginning with an initial
(Dr. J. Smith).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.llm import common
from tracklane.llm.common import let

KEY = "tracklane"
MAX_ATTEMPTS = 40
_GAP = r"[^\p{L}\p{N}\n]{0,6}"
MALE, FEMALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Г-н", "Κύριος"), ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Г-жа", "Κυρία")
FEMALE = (*FEMALE, "Dra", "Profesora")
#: Titles that tell no gender.
NEUTRAL = ("Dr", "Prof", "Professor", "Doctor", "Docteur", "Doktor", "Profesor", "Mx", "Д-р", "Доктор", "Профессор", "Δρ", "Καθηγητής")
_TITLES = "|".join(sorted((*MALE, *FEMALE, *NEUTRAL), key=len, reverse=True))
_TITLE = rf"(?:(?:{_TITLES})\.? )++"
_NAME = r"\p{Lu}[\p{Ll}\p{M}]+(?:[-'’]\p{Lu}[\p{Ll}\p{M}]+)?"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"
IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\d|\.\d)"
PHONE = (
    rf"(?<![\p{{L}}\p{{N}}])(?:(?:\+\d{{1,3}}|1){_GAP})?\(\d{{2,4}}\){_GAP}(?:\d{{3,4}}[ .-]\d{{3,4}}|\d{{7}})(?!\d)"
    r"|(?<![\p{L}\p{N}+])\+\d{1,3}(?:[ .-]\d{2,4}){2,4}(?!\d)"
    r"|(?<![\p{L}\p{N}+])\+(?:[1-9]\d{7,14}|\d{1,3}(?:[ -]\d{1,5})?[ -]\d{6,11})(?![\p{L}\p{N}])"
    r"|(?<![\p{L}\p{N}])(?<!\d[ .-])0\d{2,4}[ -]\d{3,4}[ -]\d{3,4}(?!\d|[.-]\d)"
    r"|(?<![\p{L}\p{N}])(?<!\d[.-])(?:1[ .-])?(?:\d{3}[.-]\d{3}[.-]|[2-9]\d{2}[ .-]\d{3}[ .-])\d{4}(?!\d|[.-]\d)"
)
CARD = r"(?<![\p{L}\p{N}])(?:(?:\d{4}[ -]){3}\d{4}|3[47]\d{2}[ -]\d{6}[ -]\d{5})(?!\d)|(?<![\p{L}\p{N}])\d{13,19}(?![\p{L}\p{N}])"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
IBAN = r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
_HEX = "[0-9A-Fa-f]{1,4}"
IP6 = rf"(?<![\p{{L}}\p{{N}}:])(?:(?:{_HEX}:){{7}}{_HEX}|{_HEX}(?::{_HEX}){{1,5}}::(?:{_HEX}(?::{_HEX}){{0,4}})?)(?![\p{{L}}\p{{N}}:])"
NAME = rf"(?<![\p{{L}}\p{{N}}]){_TITLE}{_NAME}(?: {_NAME})?"
# The look ahead at one character is much cheaper than the looks behind that the patterns begin with.
ENTITY = "|".join((EMAIL, rf"(?=[0-9A-Fa-f])(?:{IP6})", rf"(?=[\d+(])(?:{IP}|{PHONE}|{CARD}|{SSN})", rf"(?=\p{{Lu}})(?:{IBAN}|{NAME})"))
#: A text without these characters holds no address or number, and with them only where such a run stands in it.
HINT = r"[@\d:]"
NUMBERS = r"@|\d[ .()\d-]{5}|[A-Z]{2}\d{2} ?[A-Z0-9]{4}|[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{0,4}:"
_BY_LETTER: dict[str, list[str]] = {}
for _t in _TITLES.split("|"):
    _BY_LETTER.setdefault(_t[0], []).append(_t[1:])
#: A text without a title holds no name.
TITLED = rf"(?=[{''.join(_BY_LETTER)}])(?:{'|'.join(f'{k}(?:{"|".join(v)})' for k, v in _BY_LETTER.items())})\.? "
TYPES = ("email", "ip", "ip6", "phone", "card", "ssn", "iban", "name")
_ALPHABETS = (("[a-z]", "abcdefghijklmnopqrstuvwxyz"), ("[\\u0430-\\u044f]", "абвгдежзийклмнопрстуфхцчшщъыьэюя"), ("[\\u03b1-\\u03c9]", "αβγδεζηθικλμνξοπρστυφχψω"), ("[\\u00df-\\u00ff]", "àáâäæçèéêëìíîïñòóôöøùúûü"))
_SYLLABLES = {
    "latin": ("ba be bi bo da de di do fa fe fi ga ge go ka ke ki ko la le li lo ma me mi mo na ne ni no pa pe pi po ra re ri ro sa se so ta te ti to va ve vi".split(), {"m": "rik", "f": "lia", "s": "nor"}),
    "cyrillic": ("ба бе би бо да де ди до га го ка ки ко ла ле ли ло ма ми мо на не ни но па по ра ри ро са се со та ти то ва ве".split(), {"m": "рик", "f": "лия", "s": "нов"}),
    "greek": ("βα βε βο δα δε δι γα γο κα κε κι λα λε λι μα με μι να νε νο πα πε πο ρα ρε ρι σα σε τα τε".split(), {"m": "ρος", "f": "λια", "s": "νος"}),
}


def kind_of(m: Column) -> Column:
    digits = F.length(F.regexp_replace(m, r"\D", ""))
    return (
        F.when(m.contains("@"), "email").when(m.rlike(rf"^(?:{IP})$"), "ip").when(m.rlike(rf"^(?:{SSN})$"), "ssn").when(m.rlike(rf"^(?:{IP6})$"), "ip6")
        .when(m.rlike(rf"^(?:{IBAN})$"), "iban").when(m.rlike(r"^\p{L}"), "name")
        .when((digits >= 13) & ~m.rlike(r"[+(]"), "card").otherwise("phone")
    )


def name_words(m: Column) -> Column:
    """The words of a name, without its titles."""
    return F.split(F.regexp_replace(m, rf"^{_TITLE}", ""), " ")


def parts(m: Column) -> Column:
    """The (type, canonical form) pairs of a match: a given name and a surname count one each."""

    def of(kind: Column) -> Column:
        one = lambda t, c: F.struct(t.alias("type"), c.alias("canon"))
        words = name_words(m)
        names = F.transform(words, lambda w, i: one(F.when(i == F.size(words) - 1, "surname").otherwise("given"), F.lower(w)))
        return (
            F.when(kind == "name", names).when(kind.isin("email", "ip", "ip6"), F.array(one(kind, F.lower(m))))
            .when(kind == "iban", F.array(one(kind, F.regexp_replace(m, " ", ""))))
            .when(kind == "phone", F.array(one(kind, F.regexp_replace(F.regexp_replace(m, r"\D", ""), r"^1(\d{10})$", "$1"))))
            .otherwise(F.array(one(kind, F.regexp_replace(m, r"\D", ""))))
        )

    return let(kind_of(m), of)


def told(m: Column) -> Column:
    """The (gender, canonical form) pairs of a match's given names where its title tells a gender: m or f."""
    says = lambda titles: F.regexp_extract(m, rf"^{_TITLE}", 0).rlike(rf"(?:^| )(?:{'|'.join(titles)})\.? ")
    gender, words = F.when(says(MALE), "m").when(says(FEMALE), "f"), name_words(m)
    named = (kind_of(m) == "name") & gender.isNotNull()
    given = F.transform(F.slice(words, F.lit(1), F.size(words) - 1), lambda w: F.struct(gender.alias("gender"), F.lower(w).alias("canon")))
    return F.when(named, given).otherwise(F.array().cast("array<struct<gender: string, canon: string>>"))


def own_gender(all_told: Column, canon: Column) -> Column:
    """What the first of a text's titles tells of a given name, or null."""
    return F.get(F.filter(all_told, lambda x: x["canon"] == canon), 0)["gender"]


def ended(canon: Column, stem: Column, gender: Column) -> Column:
    """A given name's surrogate: the stem with the ending of its script and gender."""
    of = lambda script: F.when(gender == "m", _SYLLABLES[script][1]["m"]).when(gender == "f", _SYLLABLES[script][1]["f"]).otherwise(_SYLLABLES[script][1]["s"])
    return F.concat(stem, F.when(canon.rlike(r"\p{IsCyrillic}"), of("cyrillic")).when(canon.rlike(r"\p{IsGreek}"), of("greek")).otherwise(of("latin")))


def core(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The canonical form of the surrogate; of a given name its stem, which `ended` makes whole."""
    draw = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string")), 256)
    at = lambda h, i: F.conv(F.substring(h, F.pmod(i * 2, F.lit(62)) + 1, F.lit(2)), 16, 10).cast("int")

    def pick(h: Column, i: Column, chars: str) -> Column:
        return F.substring(F.lit(chars), F.pmod(at(h, i), F.lit(len(chars))) + 1, F.lit(1))

    def letter(h: Column, c: Column, i: Column) -> Column:
        out = F.when(c.rlike("[0-9]"), pick(h, i, "0123456789"))
        for chars, alphabet in _ALPHABETS:
            out = out.when(c.rlike(chars), pick(h, i, alphabet))
        return out.otherwise(F.when(c.rlike(r"\p{L}"), pick(h, i, _ALPHABETS[0][1])).otherwise(c))

    spelled = lambda h, s: F.array_join(F.transform(F.split(s, ""), lambda c, i: letter(h, c, i)), "")

    def email(h: Column) -> Column:
        domain = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("domain"), F.substring_index(canon, "@", -1)), 256)
        return F.concat(spelled(h, F.substring_index(canon, "@", 1)), F.lit("@mail"), F.substring(domain, 1, 4), F.lit(".example.com"))

    octet = lambda h, i: F.pmod(at(h, F.lit(i)) * 256 + at(h, F.lit(i + 9)), F.lit(223)) + 1

    def card(h: Column) -> Column:
        body = lambda s: F.concat(F.substring(canon, 1, 1), F.substring(s, F.lit(2), F.length(canon) - 2))
        closed = lambda b: F.when(F.call_function("luhn_check", canon), F.filter(F.array(*[F.concat(b, F.lit(str(d))) for d in range(10)]), lambda x: F.call_function("luhn_check", x))[0])
        return let(spelled(h, canon), lambda s: F.coalesce(closed(body(s)), F.concat(F.substring(canon, 1, 1), F.substring(s, 2, 100))))

    def phone(h: Column) -> Column:
        # The last ten digits change, the first of them stays a valid area code's; what stands before is the country.
        n = F.greatest(F.length(canon) - 10, F.lit(0))
        fresh = lambda s: F.concat(F.substring(canon, F.lit(1), n), F.when(F.length(canon) >= 10, pick(h, F.lit(30), "23456789")).otherwise(F.substring(s, 1, 1)), F.substring(s, n + 2, F.length(canon)))
        return let(spelled(h, canon), fresh)

    def iban(h: Column) -> Column:
        country, body = F.substring(canon, 1, 2), F.upper(spelled(h, F.lower(F.substring(canon, 5, 100))))
        turned = F.split(F.concat(body, country, F.lit("00")), "")
        number = lambda c: F.when(c.rlike("[0-9]"), F.try_to_number(c, F.lit("9")).cast("int")).otherwise(F.ascii(c) - 55)
        rest = F.aggregate(F.filter(turned, lambda c: c != ""), F.lit(0), lambda a, c: F.pmod(F.when(c.rlike("[0-9]"), a * 10).otherwise(a * 100) + number(c), F.lit(97)))
        return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), body)

    def ip6(h: Column) -> Column:
        return F.array_join(F.transform(F.split(canon, ""), lambda c, i: F.when(c.rlike("[0-9a-f]"), pick(h, i, "123456789abcdef")).otherwise(c)), "")

    def name(h: Column, ending: str) -> Column:
        def of(script: str) -> Column:
            syllables, ends = _SYLLABLES[script]
            own = F.array(*map(F.lit, syllables))
            # A syllable more with each attempt.
            drawn = F.transform(F.sequence(F.lit(0), F.lit(3) + attempt), lambda k: F.get(own, F.pmod(at(h, k) * 256 + at(h, k + 7), F.lit(len(syllables)))))
            return F.concat(F.array_join(drawn, ""), F.lit(ends.get(ending, "")))

        return F.when(canon.rlike(r"\p{IsCyrillic}"), of("cyrillic")).when(canon.rlike(r"\p{IsGreek}"), of("greek")).otherwise(of("latin"))

    return let(
        draw,
        lambda h: F.when(kind == "email", email(h)).when(kind == "ip", F.concat_ws(".", *[octet(h, 2 * i).cast("string") for i in range(4)])).when(kind == "card", card(h))
        .when(kind == "ssn", spelled(h, canon)).when(kind == "phone", phone(h)).when(kind == "iban", iban(h)).when(kind == "ip6", ip6(h)).when(kind == "given", name(h, "")).otherwise(name(h, "s")),
    )


def render(m: Column, cores: Column) -> Column:
    """The match with its parts' cores in place, in the match's own format."""
    first = cores[0]
    # The core's characters go, in turn, to the places of the match's digits (of an IBAN also its letters); what the match
    # has before them, such as a country's 1, stays.
    places = F.length(F.regexp_replace(m, r"\D", ""))
    spelt = lambda mark, k: F.aggregate(
        F.split(m, ""), F.struct(F.lit("").alias("out"), k.alias("k")),
        lambda a, c: F.when(c.rlike(mark), F.struct(F.concat(a["out"], F.when(a["k"] > 0, F.substring(first, a["k"], F.lit(1))).otherwise(c)).alias("out"), (a["k"] + 1).alias("k")))
        .otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["k"].alias("k"))),
        lambda a: a["out"],
    )
    title = F.regexp_extract(m, rf"^{_TITLE}", 0)
    names = F.array_join(F.transform(cores, lambda c: F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1000))), " ")
    shaped = F.when(m.contains("@") & (F.upper(m) == m), F.upper(first)).otherwise(first)
    return let(kind_of(m), lambda k: F.when(k == "name", F.concat(title, names)).when(k.isin("email", "ip", "ip6"), shaped).when(k == "iban", spelt("[0-9A-Z]", F.lit(1))).otherwise(spelt("[0-9]", F.length(first) - places + 1)))


def matches(text: Column) -> Column:
    """All entities of a text in turn; an empty array for a null text or one without."""
    may = (text.rlike(HINT) & text.rlike(NUMBERS)) | text.rlike(TITLED)
    return F.when(may, F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def attempts(found: DataFrame, key: str) -> DataFrame:
    """(type, canon, attempt) of the distinct entities `found` whose first draw collides; usually no rows.

    First draws keep their core where it is theirs alone, or they are the least of those that share it. The others draw
    until theirs is new: each round works on those that still move, against all first draws, earlier moves and real forms.
    """
    draw = lambda df, n: df.select("type", "canon").withColumn("core", core(F.col("type"), F.col("canon"), F.lit(n), key)).withColumn("attempt", F.lit(n))
    least = lambda df: df.groupBy("type", "core").agg(F.min("canon").alias("canon"))
    # A given name's real form stands for the stems that would make it, with whatever ending.
    endings = "|".join(e for _, ends in _SYLLABLES.values() for e in ends.values())
    form = F.when(F.col("type") == "given", F.regexp_extract("canon", rf"^(.+)(?:{endings})$", 1)).otherwise(F.col("canon"))
    real = found.select("type", form.alias("core")).filter("core <> ''").distinct()
    first = common.cut(draw(found, 0))
    shared = first.groupBy("type", "core").agg(F.min("canon").alias("least"), F.count("*").alias("n")).filter("n > 1")
    lost = first.join(shared, ["type", "core"]).filter("canon <> least").select("type", "canon")
    moving = common.cut(lost.union(first.join(real, ["type", "core"], "left_semi").select("type", "canon")).distinct())
    settled = first.filter("attempt > 0")
    for n in range(1, MAX_ATTEMPTS + 1):
        if moving.isEmpty():
            return settled.select("type", "canon", "attempt")
        drawn = draw(moving, n)
        free = drawn.join(least(drawn), ["type", "core", "canon"], "left_semi")
        for taken in (first, settled, real):
            free = free.join(taken.select("type", "core"), ["type", "core"], "left_anti")
        settled = common.cut(settled.unionByName(free))
        moving = common.cut(moving.join(settled.select("type", "canon"), ["type", "canon"], "left_anti"))
    if moving.isEmpty():
        return settled.select("type", "canon", "attempt")
    raise RuntimeError(f"entities still collide after {MAX_ATTEMPTS} draws: too many for their format")


def with_recurrences(rows: DataFrame, text: Column) -> DataFrame:
    """`rows` of matches m with all (m and the recurrences of names), kept (the text between them) and the names' words and types."""
    named = F.filter("m", lambda x: kind_of(x) == "name")
    pairs = F.flatten(F.transform(named, lambda x: F.arrays_zip(name_words(x).alias("word"), parts(x).alias("part"))))
    rows = rows.withColumn("named", F.when(F.size("m") > 0, pairs)).withColumn("word_list", F.transform("named", lambda x: x["word"]))
    rows = rows.withColumn("words", F.array_distinct("word_list"))
    rows = rows.withColumn("types", F.transform("words", lambda w: F.get(F.col("named"), F.array_position("word_list", w).cast("int") - 1)["part"]["type"]))
    longest = F.array_sort("words", lambda a, b: F.length(b) - F.length(a))
    again = F.concat(F.lit(rf"{ENTITY}|(?<![\p{{L}}\p{{N}}])(?:"), F.array_join(longest, "|"), F.lit(r")(?![\p{L}\p{N}])"))
    rows = rows.withColumn("again", F.when(F.size("words") > 0, again))
    every = F.when(F.col("again").isNotNull(), F.regexp_extract_all(text, F.col("again"), F.lit(0))).otherwise(F.col("m"))
    between = F.when(F.col("again").isNotNull(), F.split(text, F.col("again"), -1)).otherwise(F.split(text, ENTITY, -1))
    return rows.withColumn("all", every).withColumn("kept", F.when(F.size("m") > 0, between)).drop("named", "word_list", "again")


def entities(m: Column) -> Column:
    """The distinct (type, canon) pairs of a text's matches. Of given names also told_m and told_f, or untold where the text tells no gender."""
    told_here = F.flatten(F.transform(m, told))
    pair = lambda t, c: F.struct(t.alias("type"), c.alias("canon"))

    def of(all_parts: Column, genders: Column) -> Column:
        untold = F.filter(all_parts, lambda p: (p["type"] == "given") & own_gender(genders, p["canon"]).isNull())
        return F.concat(all_parts, F.transform(genders, lambda g: pair(F.concat(F.lit("told_"), g["gender"]), g["canon"])), F.transform(untold, lambda p: pair(F.lit("untold"), p["canon"])))

    return F.array_distinct(let(F.flatten(F.transform(m, parts)), lambda a: let(told_here, lambda g: of(a, g))))


def replace(df: DataFrame, key: str = KEY, text_col: str = "text") -> DataFrame:
    """(doc, pii): each row of `df` as a struct, and the rewritten text with the number of entities of each type."""
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc"), matches(df[text_col]).alias("m"))
    found = common.cut(df.select(matches(df[text_col]).alias("m")).select(F.explode(entities(F.col("m"))).alias("x")).select("x.type", "x.canon").distinct())
    odd = attempts(found.filter("type NOT LIKE '%told%'"), key)
    # What all titles of the corpus tell of a given name, for texts that tell nothing.
    agreed = found.filter("type LIKE 'told%'").groupBy("canon").agg(F.min("type").alias("a"), F.max("type").alias("b")).filter("a = b")
    genders = found.filter("type = 'untold'").join(agreed, "canon").select("type", "canon", F.substring("a", 6, 1).alias("value"))
    known = common.cut(odd.select("type", "canon", F.col("attempt").cast("string").alias("value")).unionByName(genders))
    if known.isEmpty():
        rows = rows.withColumn("known", F.create_map().cast("map<string,string>"))
    else:
        # By the list of its entities, each document that holds such a one finds what is known of it.
        signature = F.when(F.size("m") > 0, F.sha2(F.array_join("m", "\x1f"), 256)).alias("sig")
        lists = df.select(matches(df[text_col]).alias("m")).filter(F.size("m") > 0).distinct().select(signature, F.explode(entities(F.col("m"))).alias("x")).select("sig", "x.type", "x.canon")
        held = lists.join(known, ["type", "canon"]).groupBy("sig").agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("\x1f", "type", "canon"), "value"))).alias("known"))
        rows = rows.withColumn("sig", signature).join(common.cut(held), "sig", "left").drop("sig")
    text = F.col("doc")[text_col]
    known_of = lambda t, c: F.try_element_at(F.col("known"), F.concat_ws("\x1f", t, c))
    # A name's word that stands without a title has the type under which it was found.
    bare = lambda m: F.array_position("words", m)
    one = lambda m: F.array(F.struct(F.get("types", bare(m).cast("int") - 1).alias("type"), F.lower(m).alias("canon")))
    gender = lambda c: F.coalesce(own_gender(F.col("told"), c), known_of(F.lit("untold"), c), F.lit("s"))

    def surrogate(p: Column) -> Column:
        # The draw is a large expression: bound once, so that it stands in the plan once.
        drawn = core(p["type"], p["canon"], F.coalesce(known_of(p["type"], p["canon"]).cast("int"), F.lit(0)), key)
        return let(drawn, lambda d: F.when(p["type"] == "given", ended(p["canon"], d, gender(p["canon"]))).otherwise(d))

    cores = lambda m: F.transform(F.when(bare(m) > 0, one(m)).otherwise(parts(m)), surrogate)
    rows = with_recurrences(rows, text).withColumn("told", F.when(F.size("words") > 0, F.flatten(F.transform("m", told))))
    fresh = F.array_join(F.transform("kept", lambda s, i: F.concat(s, F.coalesce(let(F.get(F.col("all"), i), lambda m: render(m, cores(m))), F.lit("")))), "")
    count = lambda k: F.size(F.filter(F.col("all"), lambda m: kind_of(m) == k)).cast("bigint").alias(f"n_{k}")
    return rows.select("doc", F.struct(F.when(F.size("m") > 0, fresh).otherwise(text).alias("text"), *map(count, TYPES)).alias("pii"))


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get("spark.tracklane.pii.key", KEY)
    return replace(common.table(spark, sf_dir, "documents", "doc_id", "text"), key).select("doc.doc_id", "pii.*")
