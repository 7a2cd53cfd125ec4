"""Surrogates for personal data, by built-in expressions only.

Entities are found by pattern, brought to one form (so a mention's punctuation or case does not make
another entity), and each distinct entity gets one surrogate from a keyed digest. A surrogate has the
type, length, script and, for names, the gender of its entity; it is put into each mention in that
mention's own format. Surrogates that two entities share, or that are entities themselves, are drawn
again until none is left, so distinct entities stay distinct and mentions of one stay the same. The words
of a name found behind a title are replaced wherever else they stand in that row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltline.llm.common import Workspace, fresh, quoted, table

# Titles by gender, and given names by gender and script.
TITLES = {"f": "Mrs|Ms|Miss|Madam|Frau|Mme|Madame|Mlle|Sra|Señora|Госпожа|Κυρία", "m": "Mr|Sir|Herr|Monsieur|Sr|Señor|Господин|Κύριος", "n": "Dr|Prof"}
NAMES = {
    ("f", "latin"): "Anna Berta Clara Diana Elena Flora Greta Helena Irma Julia Karla Laura".split(),
    ("m", "latin"): "Albert Bruno Conrad David Emil Felix Georg Hugo Igor Jakob Karl Leo".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Кира Лидия Мария Нина".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Захар Иван Кирилл Лев Максим Никита".split(),
    ("f", "greek"): "Άννα Δάφνη Ελένη Ζωή Ηλέκτρα Θάλεια Ιωάννα Μαρία Νίκη Ξένια Ρέα Σοφία".split(),
    ("m", "greek"): "Άρης Γιάννης Δήμος Ηλίας Θάνος Κώστας Λέων Μάριος Νίκος Πάνος Σάκης Φώτης".split(),
}
TAILS = {"latin": "bergner holt mann rowe stein vale wick dorf", "cyrillic": "ов ин ский енко евич ман ук ян", "greek": "ίδης όπουλος άκης ίδου άς έας άκος ής"}
ALPHABETS = {"latin": "abdefgiklmnoprstuvz", "cyrillic": "абвгдежзиклмнопрст", "greek": "αβγδεζηικλμνοπρστ"}

# A genitive's 's is no part of the name.
WORD = r"\p{Lu}(?:\p{L}|['’-](?=\p{L})(?!s(?!\p{L})))++"
NAME = rf"{WORD}(?:[ ]{WORD}){{0,2}}"
# A long quoted value that is given to a secret's name; the value needs a letter, and a digit or capital.
GIVEN = r"(?i:token|secret|passw|pwd|credential|(?:api|access|private|auth)[_-]?key)[A-Za-z0-9_-]{0,20}+[\"']?\s{0,3}[:=]{1,2}>?\s{0,3}[\"']"
VALUE = r"(?=[^\"'\s]*[0-9A-Z])(?=[^\"'\s]*[A-Za-z])[A-Za-z0-9+/_=.~-]{16,}+(?=[\"']|\z)"
# In order: the first pattern that matches at a place decides.
PATTERNS = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"),
    ("secret", r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pos]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64})(?![A-Za-z0-9])" + f"|{GIVEN}{VALUE}"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){3,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("ip", r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])"),
    ("card", r"(?<![0-9+])(?:[0-9]{4}[ -]?){3}[0-9]{4}(?![0-9])"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    # 7 to 15 digits in groups of any number.
    ("phone", r"\+[0-9](?:(?:[ .-]?\(|\)[ .-]?|[ .-])?[0-9]){6,14}(?![0-9])"),
    ("person", rf"(?<!\p{{L}})(?:{'|'.join(TITLES.values())})\.?[ ]{NAME}"),
)
ANY = "|".join(f"(?:{p})" for _, p in PATTERNS)
# What stands in every match of a pattern, and is quicker to look for.
HINTS = {
    "email": "@",
    "secret": r"AKIA|gh[pos]_|sk-|[:=]>?\s{0,3}[\"']",
    "iban": "[A-Z]{2}[0-9]{2}",
    "ip": r"[0-9]\.[0-9]",
    "card": "[0-9]{4}",
    "ssn": "[0-9]{3}-",
    "phone": r"\+[0-9]",
    "person": rf"(?:{'|'.join(TITLES.values())})\.?[ ]\p{{Lu}}",
}
HINT = "|".join(HINTS[name] for name, _ in PATTERNS)


def kind_of(mention: Column) -> Column:
    found = F.when(F.lit(False), "")
    for name, pattern in PATTERNS:
        found = found.when(mention.rlike(rf"\A(?:{pattern})\z"), name)
    return found.otherwise("other")


def script_of(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def gender_of(mention: Column) -> Column:
    found = F.when(F.lit(False), "")
    for gender, titles in TITLES.items():
        found = found.when(mention.rlike(rf"\A(?:{titles})\.?[ ]"), gender)
    return found.otherwise("n")


def bare_name(mention: Column) -> Column:
    return F.regexp_replace(mention, F.lit(rf"\A(?:{'|'.join(TITLES.values())})\.?[ ]"), F.lit(""))


def secret_value(mention: Column) -> Column:
    return F.regexp_replace(mention, F.lit(rf"\A{GIVEN}"), F.lit(""))


def entities_of(mention: Column, kind: Column) -> Column:
    """The entities of a mention, each as (kind, form): a person has one for the surname and one for
    each given name, so full and short mentions agree; anything else is one entity."""
    digits = F.regexp_replace(mention, F.lit("[^0-9]"), F.lit(""))
    form = (
        F.when(kind.isin("card", "ssn", "phone"), digits)
        .when(kind == "iban", F.replace(mention, F.lit(" "), F.lit("")))
        .when(kind == "email", F.lower(mention))
        .when(kind == "secret", secret_value(mention))
        .otherwise(mention)
    )
    words = F.split(bare_name(mention), " ")
    given = F.concat(F.lit("given:"), gender_of(mention), F.lit(":"), script_of(mention))
    persons = F.transform(
        words,
        lambda w, i: F.struct(
            F.when(i == F.size(words) - 1, F.concat(F.lit("surname:"), script_of(mention))).otherwise(given).alias("kind"), w.alias("form")
        ),
    )
    return F.when(kind == "person", persons).otherwise(F.array(F.struct(kind.alias("kind"), form.alias("form"))))


def _drawn(digest: Column, i: Column, n: int) -> Column:
    """The i-th number below ``n`` from a hex digest of 128 digits."""
    return F.conv(F.substring(digest, (i * 3) % 120 + 1, F.lit(4)), 16, 10).cast("int") % n


def _letter(c: Column, digest: Column, i: Column, small: str) -> Column:
    """Another character of the same class; anything but ASCII letters and digits stays."""
    def pick(alphabet: str) -> Column:
        return F.substring(F.lit(alphabet), _drawn(digest, i, len(alphabet)) + 1, F.lit(1))

    return F.when(c.rlike("[0-9]"), pick("0123456789")).when(c.rlike("[a-z]"), pick(small)).when(
        c.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).otherwise(c)


def _rewritten(text: Column, digest: Column, small: str = "abcdefghijklmnopqrstuvwxyz") -> Column:
    return F.array_join(F.transform(F.split(text, ""), lambda c, i: _letter(c, digest, i, small)), "")


def _check_digit(digits: Column) -> Column:
    """The last digit that makes digits without it pass the Luhn test."""
    n = F.char_length(digits)

    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1)
        return F.floor(d / 10).cast("int") + d % 10

    total = F.aggregate(F.transform(F.split(digits, ""), worth), F.lit(0), lambda a, b: a + b)
    return ((10 - total % 10) % 10).cast("string")


def surrogate(kind: Column, form: Column, attempt: Column, key: str) -> Column:
    """What stands for an entity's form."""
    digest = F.sha2(F.concat_ws("\0", F.lit(key), kind, form, attempt.cast("string")), 512)
    # Where few forms of this length exist, later attempts are longer, so that a free one is found.
    more = F.when(attempt < 6, 0).otherwise(F.floor(attempt / 3) - 1).cast("int")
    digits = _rewritten(F.repeat(F.lit("0"), more), F.sha2(digest, 512))
    rest = lambda skip: F.substr(form, F.lit(skip + 1))
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_drawn(digest, i, 254) + 1).cast("string")), ".")
    head = F.concat(F.substring(form, 1, 1), _rewritten(F.substr(form, F.lit(2), F.char_length(form) - 2), digest))
    luhn = F.substring(form, -1, 1) == _check_digit(F.substr(form, F.lit(1), F.char_length(form) - 1))
    card = F.when(luhn, F.concat(head, _check_digit(head))).otherwise(F.concat(F.substring(form, 1, 1), _rewritten(rest(1), digest)))
    local, domain = F.substring_index(form, "@", 1), F.substring_index(form, "@", -1)
    top = F.substring_index(domain, ".", -1)
    host = F.substr(domain, F.lit(1), F.char_length(domain) - F.char_length(top))
    email = F.concat(_rewritten(F.concat(local, F.repeat(F.lit("a"), more), F.lit("@"), host), digest), top)
    out = (
        F.when(kind == "email", email)
        .when(kind == "ip", octets)
        .when(kind == "card", card)
        .when(kind == "phone", F.concat(F.substring(form, 1, 1), _rewritten(rest(1), digest), digits))
        .when(kind == "ssn", F.concat(_rewritten(form, digest), digits))
        .when(kind == "iban", F.concat(F.substring(form, 1, 2), _rewritten(rest(2), digest)))
        .when(kind == "secret", F.when(form.startswith("AKIA"), F.concat(F.substring(form, 1, 4), _rewritten(rest(4), digest)))
              .when(form.startswith("sk-"), F.concat(F.substring(form, 1, 3), _rewritten(rest(3), digest)))
              .when(form.rlike(r"\Agh[pos]_"), F.concat(F.substring(form, 1, 4), _rewritten(rest(4), digest)))
              .when(form.rlike(r"\A[0-9a-f]+\z"), _rewritten(form, digest, "abcdef"))
              .otherwise(_rewritten(form, digest)))
    )
    for script, alphabet in ALPHABETS.items():
        tails = F.array(*[F.lit(t) for t in TAILS[script].split()])
        stem = F.array_join(
            F.transform(F.sequence(F.lit(0), more + 4), lambda i: F.substring(F.lit(alphabet), _drawn(digest, i, len(alphabet)) + 1, F.lit(1))), ""
        )
        out = out.when(kind == f"surname:{script}", F.concat(F.initcap(stem), F.element_at(tails, _drawn(digest, F.lit(9), 8) + 1)))
        for gender in "fmn":
            listed = NAMES[("f", script)] + NAMES[("m", script)] if gender == "n" else NAMES[(gender, script)]
            first = F.element_at(F.array(*[F.lit(n) for n in listed]), _drawn(digest, F.lit(11), len(listed)) + 1)
            # Lists are short: the syllables behind the hyphen keep names apart once a list is used up.
            out = out.when(kind == f"given:{gender}:{script}", F.when(attempt < 3, first).otherwise(F.concat(first, F.lit("-"), F.initcap(stem))))
    return F.coalesce(out, _rewritten(form, digest))


def assign(entities: DataFrame, key: str, keep: Workspace) -> DataFrame:
    """(kind, form, surrogate) for distinct ``entities``, injective within a kind, and never an entity of it."""
    settled, turn = None, 0
    left = entities.withColumn("attempt", F.lit(0))
    while True:
        tried = keep.keep(left.withColumn("surrogate", surrogate(F.col("kind"), F.col("form"), F.col("attempt"), key)), f"tried-{turn}")
        rank = F.concat(F.sha2(F.concat_ws("\0", F.lit(key), "form"), 256), F.lit("\0"), F.col("form"))
        first = tried.groupBy("kind", "surrogate").agg(F.min(rank).alias("first"), F.count("*").alias("n"))
        real = entities.select("kind", F.col("form").alias("surrogate"), F.lit(True).alias("real"))
        checked = tried.join(first, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        if settled is not None:
            used = settled.select("kind", "surrogate", F.lit(True).alias("used"))
            checked = checked.join(used, ["kind", "surrogate"], "left")
        else:
            checked = checked.withColumn("used", F.lit(None).cast("boolean"))
        good = F.col("real").isNull() & F.col("used").isNull() & (rank == F.col("first"))
        checked = keep.keep(checked.select("kind", "form", "attempt", "surrogate", good.alias("good")), f"checked-{turn}")
        fine = checked.where("good").select("kind", "form", "surrogate")
        settled = fine if settled is None else settled.union(fine)
        left = checked.where("NOT good").select("kind", "form", (F.col("attempt") + 1).alias("attempt"))
        turn += 1
        if not left.limit(1).count():
            return settled


def rendered(mention: Column, kind: Column, made: Column) -> Column:
    """A mention with the surrogates of its entities (array of strings) in its own format."""
    # Digit kinds: the n-th digit of the mention becomes the n-th of the surrogate; a longer one ends behind it.
    places = F.aggregate(
        F.split(mention, ""),
        F.struct(F.lit(0).alias("n"), F.lit("").alias("out")),
        lambda s, c: F.struct(
            (s["n"] + F.when(c.rlike("[0-9A-Z]"), 1).otherwise(0)).alias("n"),
            F.concat(s["out"], F.when(c.rlike("[0-9A-Z]"), F.substring(made[0], s["n"] + 1, F.lit(1))).otherwise(c)).alias("out"),
        ),
        lambda s: F.concat(s["out"], F.substr(made[0], s["n"] + 1)),
    )
    # An upper-case letter of an address stays upper case where the surrogate has as many letters.
    cased = F.array_join(
        F.transform(F.split(made[0], ""), lambda c, i: F.when(F.substring(mention, i + 1, F.lit(1)).rlike("[A-Z]"), F.upper(c)).otherwise(c)), ""
    )
    title = F.substr(mention, F.lit(1), F.char_length(mention) - F.char_length(bare_name(mention)))
    return (
        F.when(kind.isin("card", "ssn", "phone", "iban"), places)
        .when(kind == "email", cased)
        .when(kind == "person", F.concat(title, F.array_join(made, " ")))
        .when(kind == "secret", F.concat(F.substr(mention, F.lit(1), F.char_length(mention) - F.char_length(secret_value(mention))), made[0]))
        .otherwise(made[0])
    )


def name_words(mention: Column, kind: Column, made: Column) -> Column:
    """The words of a person's mention, each as (word, whether it is a given name, title's rank, surrogate)."""
    words = F.split(bare_name(mention), " ")
    rank = F.when(gender_of(mention) == "f", 0).when(gender_of(mention) == "m", 1).otherwise(2)
    each = F.transform(
        words,
        lambda w, i: F.struct(w.alias("word"), (i < F.size(words) - 1).alias("given"), rank.alias("rank"), F.get(made, i).alias("surrogate")),
    )
    return F.when(kind == "person", each).otherwise(F.slice(each, 1, 0))


def words_of(words: Column, surname: bool) -> Column:
    """Map from the words that are surnames (or given names) of a row to their surrogates; where titles
    differ, the first of sorted ``words`` decides."""
    mine = F.filter(words, lambda w: w["given"] != F.lit(surname))
    first = F.filter(mine, lambda w, i: (i == 0) | (F.get(mine, F.greatest(i - 1, F.lit(0)))["word"] != w["word"]))
    return F.map_from_entries(F.transform(first, lambda w: F.struct(w["word"], w["surrogate"])))


def any_or_words(words: Column) -> Column:
    """A pattern of mentions and of runs of ``words``, longer words first."""
    longest = F.transform(F.reverse(F.array_sort(F.transform(words, lambda w: F.struct(F.char_length(w).alias("n"), w.alias("w"))))), lambda x: x["w"])
    one = F.concat(F.lit("(?:"), F.array_join(longest, "|"), F.lit(r")(?!\p{L})"))
    return F.when(F.size(words) > 0, F.concat(F.lit(ANY + r"|(?<!\p{L})"), one, F.lit("(?:[ ]"), one, F.lit(")*+"))).otherwise(F.lit(ANY))


def bare_rendered(run: Column, surnames: Column, given: Column) -> Column:
    """A run of names without a title: the last word is a surname if it can be, the others given names."""
    words = F.split(run, " ")
    return F.array_join(
        F.transform(
            words,
            lambda w, i: F.when(i == F.size(words) - 1, F.coalesce(F.element_at(surnames, w), F.element_at(given, w)))
            .otherwise(F.coalesce(F.element_at(given, w), F.element_at(surnames, w))),
        ), " "
    )


def replace_entities(docs: DataFrame, key: str = "siltline-surrogates", text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with surrogates in ``text``, and the name of a further column that counts the mentions.

    Null and empty texts stay as they are; equal rows are rewritten alike; rows with null or repeated
    ids are told apart by a hash of their text; an empty table gives no rows.
    """
    spark, place = docs.sparkSession, Workspace(docs.sparkSession, "surrogates")
    names = {c: fresh(docs.columns, c) for c in ("n_entities", "row_hash", "mentions", "by_form", "surnames", "given", "pattern", "other_id", "other_hash")}
    hashed = docs.withColumn(names["row_hash"], F.xxhash64(quoted(text)))
    hinted = quoted(text).rlike(HINT)
    found = F.when(hinted, F.regexp_extract_all(quoted(text), F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    mentions = place.keep(
        hashed.where(hinted).select("doc_id", quoted(names["row_hash"]).alias("row_hash"), found.alias("found"))
        .select("doc_id", "row_hash", F.explode(F.array_distinct("found")).alias("mention")).distinct()
        .select("doc_id", "row_hash", "mention", kind_of(F.col("mention")).alias("kind")),
        "mentions",
    )
    # Each mention once, however many rows have it.
    parts = mentions.select("mention", "kind").distinct()
    parts = place.keep(parts.select("mention", F.col("kind").alias("mention_kind"), F.posexplode(entities_of(F.col("mention"), F.col("kind"))).alias("at", "e")), "parts")
    entities = place.keep(parts.select("e.kind", "e.form").distinct(), "entities")
    made = assign(entities, key, place)
    joined = parts.join(made, (F.col("e.kind") == made["kind"]) & (F.col("e.form") == made["form"]))
    by_mention = joined.groupBy("mention", "mention_kind").agg(F.sort_array(F.collect_list(F.struct("at", "surrogate"))).alias("made"))
    instead = place.keep(
        by_mention.select(
            "mention", rendered(F.col("mention"), F.col("mention_kind"), F.col("made.surrogate")).alias("instead"),
            name_words(F.col("mention"), F.col("mention_kind"), F.col("made.surrogate")).alias("words"),
        ),
        "instead",
    )
    replaced = mentions.join(instead, "mention")
    # A text's own mentions, and the words of its names: no more than the text holds.
    by_row = replaced.groupBy("doc_id", "row_hash").agg(
        F.map_from_entries(F.collect_list(F.struct("mention", "instead"))).alias("by_form"),
        F.array_sort(F.flatten(F.collect_list(F.col("words")))).alias("words"),
    )
    last, any_place = (words_of(F.col("words"), surname) for surname in (True, False))
    by_row = place.keep(by_row.select("doc_id", "row_hash", "by_form", last.alias("surnames"), any_place.alias("given")), "by-row").select(
        *[F.col(c).alias(names[n]) for c, n in (("doc_id", "other_id"), ("row_hash", "other_hash"), ("by_form", "by_form"), ("surnames", "surnames"), ("given", "given"))]
    )

    plain = docs.where(~F.coalesce(hinted & quoted(text).rlike(ANY), F.lit(False))).withColumn(names["n_entities"], F.lit(0).cast("long"))
    some = hashed.where(hinted & quoted(text).rlike(ANY)).join(
        by_row, F.col("doc_id").eqNullSafe(quoted(names["other_id"])) & (quoted(names["row_hash"]) == quoted(names["other_hash"]))
    )
    surnames, given, by_form = (quoted(names[n]) for n in ("surnames", "given", "by_form"))
    pattern = any_or_words(F.map_keys(F.map_concat(surnames, F.map_filter(given, lambda k, v: ~F.map_contains_key(surnames, k)))))
    some = some.withColumn(names["pattern"], pattern).withColumn(names["mentions"], F.regexp_extract_all(quoted(text), quoted(names["pattern"]), F.lit(0)))
    between = F.split(quoted(text), quoted(names["pattern"]), -1)
    new = F.array_join(
        F.zip_with(between, F.transform(quoted(names["mentions"]), lambda m: F.coalesce(F.element_at(by_form, m), bare_rendered(m, surnames, given))),
                   lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""
    )
    some = some.withColumn(text, new).withColumn(names["n_entities"], F.size(quoted(names["mentions"])).cast("long"))
    columns = [*docs.columns, names["n_entities"]]
    pick = lambda df: df.select(*[quoted(c) for c in columns])
    return pick(plain).union(pick(some)), names["n_entities"]


def op10_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with surrogates in place of the personal data found."""
    found, counted = replace_entities(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", quoted(counted).alias("n_entities"), F.sha2("text", 256).alias("text_sha256"), "text")
