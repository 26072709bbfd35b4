"""Personal data and secrets replaced by keyed surrogates, with DataFrame functions only.

Every entity gets one surrogate, drawn by a keyed hash of its type and normal form, so the
same person, address or number reads the same everywhere (in any spelling of case and
separators), and different ones differ: surrogates that two entities would share, or that
are themselves an entity of the corpus, are drawn again. Surrogates keep the type, the
format (kinds of characters, separators, check digits, address structure), and for names
gender and script.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import materialise, quoted

#: Given names by gender and script; more are made by joining two or more.
GIVEN = {
    ("f", "latin"): "Anna Clara Emma Julia Laura Lena Maria Martha Nina Olivia Paula Rosa Sara Sofia Teresa Vera".split(),
    ("m", "latin"): "Adam Bruno Carl David Emil Felix Hugo Jonas Leo Martin Oscar Paul Robert Simon Thomas Victor".split(),
    ("u", "latin"): "Alex Andrea Chris Jean Kim Lee Luca Max Nicola Noa Pat Robin Sam Sascha Toni Val".split(),
    ("f", "cyrillic"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Егор Иван Олег Павел Юрий".split(),
    ("u", "cyrillic"): "Женя Саша Валя Слава".split(),
    ("f", "greek"): "Άννα Ελένη Ειρήνη Μαρία Σοφία Ζωή".split(),
    ("m", "greek"): "Γιώργος Κώστας Νίκος Πέτρος Σπύρος Φώτης".split(),
    ("u", "greek"): "Άρης Φοίβη".split(),
}
#: Titles before names, by gender.
TITLES = {
    "f": "Mrs Ms Miss Frau Madame Mme Mademoiselle Mlle Señora Sra Señorita Srta Signora госпожа г-жа κυρία".split(),
    "m": "Mr Herr Monsieur Señor Sr Signor господин г-н κύριος".split(),
    "u": "Dr Prof Professor доктор".split(),
}
SYLLABLES = {
    "latin": "ba bel bor da del dor fa fel for ga gel gor ka kel kor la lel lor ma mel mor na nel nor ra rel ror sa sel sor ta tel".split(),
    "cyrillic": "ба бел бор да дел дор за зел зор ка кел кор ла лел лор ма мел мор на нел нор ра рел рор са сел сор та тел тор ва вел".split(),
    "greek": "βα βελ βορ γα γελ γορ δα δελ δορ κα κελ κορ λα λελ λορ μα μελ μορ να νελ νορ ρα ρελ ρορ σα σελ σορ τα τελ τορ πα πελ".split(),
}
_SCRIPT = {"cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}"}

_NAME = r"\p{Lu}[\p{L}'’-]{1,30}"
_TITLE = "|".join(t for titles in TITLES.values() for t in titles)
_KNOWN = "|".join(n for names in GIVEN.values() for n in names)
#: Titles and given names stand at the start of a text or after one of these.
_BETWEEN = " \t\n\r\f\x0b\xa0\"'“”„‘«»()[]{}<>.,;:!?¡¿/|*_#&%$+=~–—…"
_AFTER = "(?<![^" + "".join("\\" + c if c in "[]()" else c for c in _BETWEEN) + "])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: What is looked for, in order of preference, and the quantifiers of which are all bounded.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "hex": r"(?<![A-Za-z0-9])(?=[0-9A-Fa-f]{0,127}[A-Fa-f])[0-9A-Fa-f]{32,128}(?![A-Za-z0-9])",
    "password": r"(?<=(?i:password|passwd|pwd)[=:])[^\s\"']{4,256}",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)",
    "iban": r"(?<![\w])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w+-])\d(?:[ -]?\d){12,18}(?!\w)",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\w)"
    r"|(?<![\w+(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w.+-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w.-])",
    "name": rf"{_AFTER}(?:(?:{_TITLE})\.? {_NAME}(?: {_NAME})?|(?:{_KNOWN}) {_NAME})(?![\p{{L}}])",
}
_ALL = "|".join(f"(?:{p})" for p in PATTERNS.values())
_OTHERS = "|".join(f"(?:{p})" for kind, p in PATTERNS.items() if kind != "name")
#: Found in every text in which one of the other patterns is.
HINT = "[0-9@]|AKIA|ASIA|[A-Fa-f]{32}|[Pp][Aa][Ss][Ss][Ww]|[Pp][Ww][Dd]"
_DIGITS = ("card", "phone", "ssn", "iban")
#: Draws in a row without a free surrogate after which a format is taken to be used up
#: (names grow with each draw and never are).
FULL = 64


def _at(text: Column, i: Column) -> Column:
    return F.substring(text, i, F.lit(1))


def _luhn(digits: Column, check: int) -> Column:
    """Sum of a digit string, every second digit doubled from the right; ``check``: 1 to double the last."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = _at(digits, n - i + 1).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == check, twice).otherwise(d)

    return F.when(n > 0, F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)).otherwise(0)


def _script(text: Column) -> Column:
    out = F.lit("latin")
    for name, pattern in _SCRIPT.items():
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return out


def _part(before: Column, kind: Column, norm: Column, raw: Column) -> Column:
    return F.struct(before.alias("before"), kind.cast("string").alias("kind"), norm.cast("string").alias("norm"), raw.alias("raw"))


def _parts(match: Column, gap: Column) -> Column:
    """What a match is made of: texts left as they are, each followed by an entity or by nothing."""
    whole = lambda p: match.rlike(rf"\A(?:{p})\z")
    alnum = F.regexp_replace(match, "[^0-9A-Za-z]", "")
    nothing = F.lit(None).cast("string")
    one = lambda kind, norm: F.array(_part(gap, F.lit(kind), norm, match))
    words = F.split(match, " ")
    titled = match.rlike(rf"\A(?:{_TITLE})\.? ")
    gender = F.lit("u")
    for g in ("f", "m"):
        pattern = rf"\A(?:{'|'.join(TITLES[g])})\.? |\A(?:{'|'.join(n for (x, _), names in GIVEN.items() if x == g for n in names)}) "
        gender = F.when(match.rlike(pattern), g).otherwise(gender)
    last = F.element_at(words, -1)
    script = _script(last)
    given = F.element_at(words, F.when(titled, 2).otherwise(1))
    # a woman's surname in -а is that of her family
    stem = F.lower(F.when((script == "cyrillic") & (gender == "f"), F.regexp_replace(last, "а$", "")).otherwise(last))
    ended = F.when(script == "cyrillic", F.concat(F.lit("surname_cyrillic_"), gender)).otherwise(F.concat(F.lit("surname_"), script))
    title = F.when(titled, F.concat(gap, words[0], F.lit(" "))).otherwise(gap)
    surname = lambda before: _part(before, ended, stem, last)
    full = F.array(
        _part(title, F.concat(F.lit("given_"), gender, F.lit("_"), _script(given)), F.lower(given), given), surname(F.lit(" "))
    )
    name = F.when(titled & (F.size(words) == 2), F.array(surname(title))).otherwise(full)
    out = F.when(whole(PATTERNS["email"]), one("email", F.lower(match)))
    out = out.when(whole(PATTERNS["key"]), one("key", match))
    out = out.when(whole(PATTERNS["hex"]), one("hex", F.lower(match)))
    out = out.when(whole(PATTERNS["ip"]), one("ip", match))
    out = out.when(whole(PATTERNS["ssn"]), one("ssn", alnum))
    card = F.when(_luhn(alnum, 0) % 10 == 0, F.array(_part(gap, F.lit("card"), alnum, match)))
    out = out.when(whole(PATTERNS["card"]), card.otherwise(F.array(_part(gap, nothing, nothing, match))))
    out = out.when(match.rlike(r"\A[+(]?\d[\d ().-]+\z"), one("phone", alnum))
    out = out.when(whole(r"[A-Z]{2}\d{2}[A-Z0-9 ]{12,40}"), one("iban", alnum))
    out = out.when(whole(rf"(?:(?:{_TITLE})\.? {_NAME}(?: {_NAME})?|(?:{_KNOWN}) {_NAME})"), name)
    # a password in capitals only is that of a text in capitals
    return out.otherwise(one("password", F.when(F.upper(match) == match, F.lower(match)).otherwise(match)))


def _with_stream(entities: DataFrame, draw: int, secret: str) -> DataFrame:
    """Add the keyed hash of each entity and draw: ``seed``, and two hex digits for every character in ``stream``."""
    seed = F.concat_ws("|", F.lit(secret), "kind", "norm", F.lit(str(draw)))
    blocks = F.sequence(F.lit(0), (F.greatest(F.length("norm"), F.lit(draw)) / 32).cast("int") + 1)
    stream = F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat_ws("|", F.col("seed"), b.cast("string")), 256)), "")
    return entities.withColumn("seed", seed).withColumn("stream", stream)


def _surrogate(kind: Column, norm: Column, draw: Column, secret: str) -> Column:
    """The surrogate of a normal form; another one for every draw (see ``_with_stream``)."""
    seed, stream = F.col("seed"), F.col("stream")

    def byte(i: Column) -> Column:
        return F.conv(F.substring(stream, i * 2 - 1, F.lit(2)), 16, 10).cast("int")

    def letter(alphabet: str, i: Column) -> Column:
        return _at(F.lit(alphabet), byte(i) % len(alphabet) + 1)

    low, digit, hexa = "abcdefghijklmnopqrstuvwxyz", "0123456789", "0123456789abcdef"

    def alike(text: Column, first: int = 1) -> Column:
        def one(i: Column) -> Column:
            c = _at(text, i)
            out = F.when(c.rlike("[0-9]"), letter(digit, i)).when(c.rlike("[a-z]"), letter(low, i)).when(c.rlike("[A-Z]"), letter(low.upper(), i)).otherwise(c)
            return F.when(i < first, c).otherwise(out)

        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), one), "")

    more = F.when(draw > 2, F.substring(F.regexp_replace(F.sha2(seed, 256), "[^0-9]", ""), 1, 6)).otherwise("")
    local, domain = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
    host = F.translate(F.substring(F.sha2(F.concat_ws("|", F.lit(secret), F.lit("domain"), domain), 256), 1, 10), hexa, "bcdfghjklmnpqrst")
    top = F.when(domain.rlike(r"\.(?:com|net|org)\z"), F.substring_index(domain, ".", -1)).otherwise("org")
    email = F.concat(alike(local), more, F.lit("@"), host, F.lit(".example."), top)
    octets = F.concat_ws(".", byte(F.lit(1)) % 223 + 1, byte(F.lit(2)), byte(F.lit(3)), byte(F.lit(4)) % 254 + 1)
    hexes = F.array_join(F.transform(F.sequence(F.lit(1), F.length(norm)), lambda i: letter(hexa, i)), "")
    body = F.substring(alike(norm, 2), F.lit(1), F.length(norm) - 1)
    card = F.concat(body, ((10 - _luhn(body, 1) % 10) % 10).cast("string"))
    kept = F.when(F.length(norm) < 11, 1).when(norm.rlike("^[17]"), 2).otherwise(3)
    phone = F.array_join(
        F.transform(F.sequence(F.lit(1), F.length(norm)), lambda i: F.when(i < kept, _at(norm, i)).when(i == kept, letter("23456789", i)).otherwise(letter(digit, i))), ""
    )
    chain = F.when(kind == "email", email).when(kind == "ip", octets).when(kind == "hex", hexes).when(kind == "card", card).when(kind == "phone", phone)
    chain = chain.when(kind == "key", alike(norm, 5)).when(kind == "iban", alike(norm, 3)).when(kind == "password", F.concat(alike(norm), more))

    def of(words: list[str], count: Column, between: str) -> Column:
        listed = F.array(*map(F.lit, words))
        return F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: F.element_at(listed, byte(i) % len(words) + 1)), between)

    for (g, script), names in GIVEN.items():
        several = of(names, draw + 1, "-")
        chain = chain.when(kind == f"given_{g}_{script}", several)
    for script, syllables in SYLLABLES.items():
        made = F.initcap(of(syllables, draw + 3, ""))
        if script == "cyrillic":
            for g, end in (("m", "ов"), ("f", "ова"), ("u", "енко")):
                chain = chain.when(kind == f"surname_cyrillic_{g}", F.concat(made, F.lit(end)))
        else:
            chain = chain.when(kind == f"surname_{script}", made)
    return chain.otherwise(alike(norm))


def _render(kind: Column, raw: Column, made: Column) -> Column:
    """A surrogate in the spelling of a mention: its separators, its capitals."""

    def one(i: Column) -> Column:
        c = _at(raw, i)
        k = F.length(F.regexp_replace(F.substring(raw, F.lit(1), i), "[^0-9A-Za-z]", ""))
        return F.when(c.rlike("[0-9A-Za-z]"), _at(made, k)).otherwise(c)

    spaced = F.array_join(F.transform(F.sequence(F.lit(1), F.length(raw)), one), "")
    loud = kind.rlike("^(?:email|hex|password|given|surname)") & (F.upper(raw) == raw) & (F.lower(raw) != raw) & (F.length(raw) > 1)
    return F.when(kind.isin(*_DIGITS), spaced).when(loud, F.upper(made)).otherwise(made)


def draw_surrogates(entities: DataFrame, secret: str) -> DataFrame:
    """``kind, norm, made`` for distinct entities ``kind, norm``: different ones get different surrogates, none gets an entity's own form.

    Each draw is checked against the entities and the surrogates given out so far; only
    those that fail go on to the next one. Names get a part more with each draw, so there
    are enough of them however many people a corpus names.
    """
    spark = entities.sparkSession
    entities = materialise(entities, "entities")
    left, done, waiting, vain = entities, None, entities.count(), 0
    for draw in itertools.count():
        family = F.regexp_replace("kind", "^surname_cyrillic_.*", "surname_cyrillic")
        tried = _with_stream(left, draw, secret).select("kind", "norm", _surrogate(F.col("kind"), F.col("norm"), F.lit(draw), secret).alias("made"))
        tried = materialise(tried.withColumns({"low": F.lower("made"), "family": family}), "drawn")
        taken = entities.select(family.alias("family"), F.lower("norm").alias("low")).distinct()
        if done is not None:
            taken = taken.unionByName(done.select("family", "low")).distinct()
        first = tried.groupBy("family", "low").agg(F.min(F.struct("kind", "norm")).alias("first"))
        won = first.join(materialise(taken, "taken"), ["family", "low"], "left_anti").select("first.kind", "first.norm")
        good = materialise(tried.join(materialise(won, "won"), ["kind", "norm"], "left_semi"), "settled")
        left = materialise(left.join(good, ["kind", "norm"], "left_anti"), "to-draw-again")
        done = good if done is None else done.unionByName(good)
        before, waiting = waiting, left.count()
        if not waiting:
            return done.select("kind", "norm", "made")
        vain = 0 if waiting < before else vain + 1
        if vain == FULL:
            raise RuntimeError(f"{waiting} entities found no surrogate of their format in {FULL} draws")


def replace_personal_data(docs: DataFrame, secret: str = "change me", text: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text``, and a column ``n_entities`` (how many mentions were replaced) after the others.

    All other columns are kept as they are, whatever they are called; one called
    ``n_entities`` is replaced. Null texts stay null and empty ones empty (0 mentions).
    Repeated rows are replaced each, alike. An empty table gives no rows. Runs jobs when
    called: entities are gathered over all texts before any is replaced.
    """
    docs = docs.drop("n_entities")
    columns = docs.columns
    body = F.col(text)
    # cheap looks first: most texts have neither a digit nor a sign that others need
    hint = body.rlike(HINT)
    words = F.split(F.translate(body, _BETWEEN, " " * len(_BETWEEN)), " ")
    named = F.arrays_overlap(words, F.array(*map(F.lit, f"{_TITLE}|{_KNOWN}".split("|")))) & body.rlike(PATTERNS["name"])
    has = F.coalesce((hint & body.rlike(_OTHERS)) | named, F.lit(False))
    matches = F.regexp_extract_all(F.col("body"), F.lit(_ALL), F.lit(0))
    rows = docs.where(has).select(F.struct(*quoted(columns)).alias("row"), body.alias("body"))
    cut = rows.select("row", matches.alias("matches"), F.split("body", _ALL, -1).alias("gaps"))
    parts = F.flatten(F.transform("matches", lambda m, i: _parts(m, F.get(F.col("gaps"), i))))
    # read back once written, the numbers of rows are fixed
    found = materialise(cut.select(F.monotonically_increasing_id().alias("at"), "row", parts.alias("parts"), F.element_at("gaps", -1).alias("tail")), "mentions")
    pieces = found.select("at", F.posexplode("parts").alias("pos", "p")).select("at", "pos", "p.*")
    made = draw_surrogates(pieces.where("kind IS NOT NULL").select("kind", "norm").distinct(), secret)
    made = materialise(made, "surrogates")
    shown = pieces.join(made, ["kind", "norm"], "left").select(
        "at",
        F.struct("pos", F.concat("before", F.when(F.col("made").isNull(), F.col("raw")).otherwise(_render(F.col("kind"), F.col("raw"), F.col("made")))).alias("t")).alias("piece"),
        F.col("made").isNotNull().cast("long").alias("n"),
    )
    joined = shown.groupBy("at").agg(F.sort_array(F.collect_list("piece")).alias("pieces"), F.sum("n").alias("n_entities"))
    joined = joined.select("at", F.array_join(F.transform("pieces", lambda p: p["t"]), "").alias("head"), "n_entities")
    full = found.select("at", "row", "tail").join(joined, "at")
    changed = full.select(*[F.concat("head", "tail").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in columns], "n_entities")
    return changed.unionByName(docs.where(~has).withColumn("n_entities", F.lit(0).cast("long")))
