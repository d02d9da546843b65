"""Surrogates keep type and format, one for each entity, and leave the rest alone."""

from helpers import no_docs, odd_docs
from pyspark.sql import functions as F

from tracklane.llm import pii_surrogates as pii

TEXTS = [
    "Write to Anna.Lee@corp.com or ANNA.LEE@CORP.COM today.", "Call +1 (555) 123-4567, or +1 555 123 4567.", "Card 4111 1111 1111 1111, host 10.0.0.12.", "Mr. John Smith met Mrs Mary Smith.",
    "ssn 123-45-6789 again 123-45-6789", "Nothing here, 12 apples and 3.5 pears.", "Г-н Иванов ушёл.",
]


def replaced(spark, key="k"):
    docs = odd_docs(spark, *TEXTS)
    return {r.doc_id: r.pii for r in pii.replace(docs, key).select("doc.doc_id", "pii").collect() if r.doc_id is not None}


def test_surrogates(spark):
    got = replaced(spark)
    a, b = [w for w in got[10].text.split() if "@" in w]
    assert a != "Anna.Lee@corp.com"
    assert a.lower() == b.lower()
    assert a.endswith(".example.com")
    assert b.isupper()
    assert (got[10].n_email, got[11].n_phone, got[12].n_card, got[12].n_ip, got[13].n_name, got[14].n_ssn) == (2, 2, 1, 1, 2, 2)
    assert got[11].text.startswith("Call +1 (")
    assert "4567" not in got[11].text
    card = "".join(c for c in got[12].text.split(",")[0] if c.isdigit())
    digits = [int(c) for c in reversed(card)]
    assert len(card) == 16 and sum(digits[0::2]) % 10 == -sum(x * 2 - 9 * (x > 4) for x in digits[1::2]) % 10
    w = got[13].text.rstrip(".").split()
    assert (w[0], w[3], w[4]) == ("Mr.", "met", "Mrs")
    assert w[2] == w[6] != "Smith"
    assert w[1] != w[5]
    s = got[14].text.split()
    assert s[1] == s[3] != "123-45-6789"
    assert got[15].text == TEXTS[5]
    assert got[16].text.startswith("Г-н ") and "Иванов" not in got[16].text


def test_keyed_and_repeatable(spark):
    assert {k: v.text for k, v in replaced(spark).items()} == {k: v.text for k, v in replaced(spark).items()}
    assert replaced(spark)[10].text != replaced(spark, "other")[10].text


def test_distinct_entities_stay_distinct(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("Mr Name"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"))
    got = pii.replace(rows, "k").select("pii.*")
    assert got.select("text").distinct().count() == 3000
    ssn = spark.range(2000).select(F.col("id").alias("doc_id"), F.format_string("ssn 123-45-%04d", F.col("id")).alias("text"))
    assert pii.replace(ssn, "k").select("pii.text").distinct().count() == 2000


def test_odd_and_empty_tables(spark):
    got = pii.replace(odd_docs(spark), "k")
    assert got.count() == 7
    assert got.filter("doc.text is null and pii.text is not null or doc.text is not null and pii.text is null").count() == 0
    assert pii.replace(no_docs(spark), "k").count() == 0


FOUND = {
    "phone": [
        "+15551234567", "(555)123-4567", "(555) 1234567", "+1(555)123-4567", "1 (555) 123-4567", "555 123 4567", "555 123-4567", "1-555-123-4567", "1 555 123 4567",
        "555-123-4567", "+44 20 79460958", "+1 5551234567", "+1 (017) 555-7713", "+44 20 7946 0958", "020 7946 0958",
    ],
    "ip6": ["2001:db8::1", "fe80:1:2::", "2001:0db8:85a3:0000:0000:8a2e:0370:7334"],
    "iban": ["DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819"],
    "card": ["3782 822463 10005", "3782-822463-10005", "4111 1111 1111 1111"],
    "name": ["Dr. Smith", "Prof. Anna Smith", "Professor Smith", "Herr Dr. Smith", "Доктор Иванов"],
}
MISSED = [
    "5551234567", "555-1234", "0044 20 7946 0958", "::1", "std::vector", "12:34:56", "41111 11111 111111", "123 45 6789", "John Smith", "Mr. SMITH", "mr. smith", "Dr. J. Smith", "Prof.Smith",
    "1.555-123-45678", "7-555-123-4567-8", "555-123-4567-89", "4.555.123.4567", "+1.2345678",
]


def test_forms_found_and_not_found(spark):
    ways = ("Reach {}", "Reach {}.", "Reach {}- now", "({}), then", "tel.{} or so")
    rows = [(k, x, w.format(x)) for k, all_ in FOUND.items() for x in all_ for w in ways[: 4 if k == "name" else 5]]
    got = pii.replace(spark.createDataFrame(rows, "kind string, x string, text string"), "k").select("doc.*", F.col("pii").alias("p")).collect()
    bad = [r.text for r in got if r.p[f"n_{r.kind}"] != 1 or sum(r.p[f"n_{t}"] for t in pii.TYPES) != 1 or r.x in r.p.text or r.text[: r.text.index(r.x)] != r.p.text[: r.text.index(r.x)]]
    assert bad == []
    got = pii.replace(spark.createDataFrame([(f"Reach {x} now",) for x in MISSED], "text string"), "k").select("doc.text", "pii").collect()
    assert [(r.text, r.pii.text) for r in got if r.text != r.pii.text] == []


def test_a_given_name_is_one_entity_whatever_its_titles(spark):
    text = "Herr Dr. Hans Meyer met Dr. Hans Meyer and Herr Hans Meyer."
    got = pii.replace(spark.createDataFrame([(text,)], "text string"), "k").first().pii.text.rstrip(".").split()
    assert got[:2] == ["Herr", "Dr."] and got[2] == got[6] == got[10] and got[3] == got[7] == got[11]
    got = pii.replace(spark.createDataFrame([("Dr. John Smith met Mr. John Smith and John.",)], "text string"), "k").first().pii.text.rstrip(".").split()
    assert got[1] == got[5] == got[8] and got[1].endswith("rik") and got[2] == got[6]


def test_gender_is_the_texts_then_the_corpuses(spark):
    texts = ["Dr. Kim Lee", "Mrs. Kim Lee", "Mr. Kim Lee and Mrs. Kim Lee", "Dr. Ann Lee", "Mrs. Ann Poe", "Prof. Max Poe"]
    got = [r.pii.text.split() for r in pii.replace(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), "k").orderBy("doc.i").collect()]
    end = lambda w: w[-3:]
    assert [end(w[1]) for w in got] == ["nor", "lia", "rik", "lia", "lia", "nor"]  # Kim: both in the corpus; Ann: one; Max: none
    assert got[2][1] == got[2][5] and got[3][1] == got[4][1]
    assert len({w[1][:-3] for w in got[:3]}) == 1 and len({w[1][:-3] for w in got}) == 3


def test_generated_names_keep_coreference_and_stay_distinct(spark):
    """The documents hold no titled name: names are made, and every word has one stem whatever the title and the text."""
    import random

    rng = random.Random(3)
    made = lambda n: ["".join(rng.choice("bcdfg") + rng.choice("aeiou") for _ in range(3)).capitalize() for _ in range(n)]
    given, family = made(60), [f"{x}son" for x in made(60)]
    texts = [[(rng.choice(["Mr.", "Mrs", "Dr.", "Prof."]), rng.choice(given), rng.choice(family)) for _ in range(6)] for _ in range(200)]
    rows = [(k, "; ".join(" ".join(x) for x in t)) for k, t in enumerate(texts)]
    stems, surnames = {}, {}
    for r in pii.replace(spark.createDataFrame(rows, "i int, text string"), "k").select("doc.i", F.col("pii.text").alias("t")).collect():
        here = {}
        for (title, g, f), new in zip(texts[r.i], r.t.split("; "), strict=True):
            t, a, b = new.split()
            assert t == title and here.setdefault(g, a) == a
            assert stems.setdefault(g, a[:-3]) == a[:-3] and surnames.setdefault(f, b) == b
            first = next((x for x, n, _ in texts[r.i] if n == g and x in ("Mr.", "Mrs")), None)
            assert first is None or a[-3:] == {"Mr.": "rik", "Mrs": "lia"}[first]
    assert len(set(stems.values())) == len(stems) and len(set(surnames.values())) == len(surnames)


def test_names_are_replaced_wherever_they_recur(spark):
    text = "Mr. John Smith called. John Smith said Smith is here; Smithson and john stay. Mrs Mary Smith-Jones, Smith-Jones, Mary."
    got = pii.replace(spark.createDataFrame([(text,)], "text string"), "k").first().pii
    w = [x.strip(".,;") for x in got.text.split()]
    assert "John" not in w and "Smith" not in w and "Mary" not in w and "Smith-Jones" not in w
    assert w[1:3] == w[4:6] and w[2] == w[7] and w[10] == "Smithson" and w[12] == "john"
    assert w[15] == w[18] and w[16] == w[17] != w[2] and got.n_name == 7


def test_forms_of_one_number_share_a_surrogate(spark):
    forms = ["+1 555-123-4567", "555-123-4567", "1-555-123-4567", "(555) 123-4567"]
    got = pii.replace(spark.createDataFrame([(x,) for x in forms], "text string"), "k").collect()
    digits = {"".join(c for c in r.pii.text if c.isdigit())[-10:] for r in got}
    assert len(digits) == 1 and digits != {"5551234567"}
    assert sorted(r.pii.text[:2] for r in got)[1:3] == ["+1", "1-"]


def test_an_iban_keeps_its_check(spark):
    got = pii.replace(spark.createDataFrame([("to DE89 3704 0044 0532 0130 00 now",)], "text string"), "k").first().pii.text
    x = got.removeprefix("to ").removesuffix(" now")
    bare = x.replace(" ", "")
    assert [len(p) for p in x.split(" ")] == [4, 4, 4, 4, 4, 2] and bare != "DE89370400440532013000" and bare[:2] == "DE"
    assert int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


def test_names_without_end(spark, monkeypatch):
    """With few syllables far more names than short surrogates: longer ones keep all distinct."""
    monkeypatch.setattr(pii, "_SYLLABLES", {k: (v[0][:3], v[1]) for k, v in pii._SYLLABLES.items()})
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.concat(F.lit("Mr Name"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"))
    assert pii.replace(rows, "k").select("pii.text").distinct().count() == 1000


def test_against_a_plain_walk_over_all_documents(spark):
    """Every match of every text has its entity's one surrogate, no two entities share one, and all else is as it was."""
    import regex
    from conftest import DATA

    from tracklane.llm import common

    docs = common.table(spark, f"{DATA}/sf0.01", "documents", "doc_id", "text").union(spark.createDataFrame(list(enumerate(TEXTS * 3)), "doc_id bigint, text string"))
    entity, title = regex.compile(pii.ENTITY.replace(r"\p{IsCyrillic}", r"\p{Cyrillic}")), regex.compile(rf"^{pii._TITLE}")
    surrogate, owner, n = {}, {}, 0
    for r in pii.replace(docs, "k").select("doc.text", F.col("pii.text").alias("new")).collect():
        if r.text is None:
            assert r.new is None
            continue
        found = entity.findall(r.text)
        words = {w for m in found if title.match(m) for w in title.sub("", m).split(" ")}
        pattern = regex.compile(entity.pattern + "".join([r"|(?<![\p{L}\p{N}])(?:", "|".join(sorted(words, key=len, reverse=True)), r")(?![\p{L}\p{N}])"] if words else []))
        at = 0
        # The text between matches stands in the new text in the same order; what lies between is the surrogate.
        kept, ms = pattern.split(r.text), pattern.findall(r.text)
        assert r.new.startswith(kept[0]) and r.new.endswith(kept[-1])
        for k, m in enumerate(ms):
            at += len(kept[k])
            end = r.new.index(kept[k + 1], at + 1) if kept[k + 1] else len(r.new) if k == len(ms) - 1 else at + len(m)
            new, at = r.new[at:end], end
            assert new != m
            if not title.match(m) and m not in words:
                digits = "".join(c for c in m if c.isdigit())
                form = m.lower() if "@" in m or ":" in m or regex.fullmatch(pii.IP, m) else m if m[0].isalpha() else digits[1:] if len(digits) == 11 and digits[0] == "1" else digits
                shown = new.lower() if form == m.lower() else "".join(c for c in new if c.isdigit())[-len(form) :]
                n += 1
                assert surrogate.setdefault(form, shown) == shown and owner.setdefault(shown, form) == form
                assert "@" in m or len(new) == len(m) or "." in m
    assert n > 100
