"""Personal data replaced by keyed surrogates.

One pattern finds e-mail addresses, IP addresses, bank accounts, card, phone and social security numbers, secrets, and titled
names. Mentions with the same canonical form (case, spaces and separators aside) are one entity, and one entity gets the
same surrogate in all documents (coreference). A surrogate comes from a keyed hash and keeps type and format: digits stay
digits, letters stay letters of their case, separators, country codes, top-level domains and secret prefixes stay, card
numbers that pass the Luhn test pass it again. Surrogates are checked against each other and against all real entities of
their type; whoever collides takes the next number of the hash until none does, so different entities stay different. Which
number that is hangs on the other entities of the table: a larger table may show an entity differently.

A name is a title with up to three words, and its words are the entities: "Mrs Anna Keller", "Mr Keller" and "MRS ANNA" keep
their common words in common. Words keep script, capitals, hyphens, a leading O' or D', and particles such as von. A word has
a female ending if it ends so itself, or if it is only ever a given name behind a female title. Names without a title
are not found. Surrogates of words and e-mail addresses grow with each draw, so they do not run out.

The patterns run once over each text, and once more over those few that hold an entity; only mentions are shuffled, and
the texts of documents that can hold one. Defined results: null text stays null and has no entities, and so does an empty
one; very long texts are read whole; repeated rows get equal results; where patterns overlap the first in PATTERNS wins;
an empty table gives an empty table; extra columns of any name are ignored, those named in keep are passed on (a column
text among them is the changed one).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import dropped, free_names, settled

#: A title, and a word of a name: a capital and letters of any case, with apostrophes and hyphens inside, to its very end; no other title.
_TITLE = r"(?:Mrs|Mr|Ms|Miss|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señora|Señor|Господин|Госпожа)"
_WORD = rf"(?!{_TITLE}(?!\p{{L}}))" + r"\p{Lu}\p{L}{0,30}(?:['’-]\p{L}{1,30}){0,3}(?!\p{L})"
#: What each type looks like. An alternative can only begin where a word or number begins, so long words cost linear time.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9A-Fa-f]{32,64}|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,64})(?![0-9A-Za-z])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\d)",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?:[0-9A-Z]{11,30}|(?: [0-9A-Z]{4}){2,7}(?: [0-9A-Z]{1,3})?)(?![0-9A-Za-z])",
    "card": r"(?<!\d)(?:\d{4}(?:[ -]?\d{4}){3}|3[47]\d{2}[ -]?\d{6}[ -]?\d{5})(?!\d)",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ -]?\(?\d{2,4}\)?(?:[ -]?\d{2,4}){2,3}|\(\d{3}\) ?\d{3}[ -]\d{4}|(?<!-)\d{3}-\d{3}-\d{4})(?![\d-]*\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "name": r"(?<!\p{L})" + _TITLE + r"\.? " + _WORD + r"(?: (?:(?:van|von|der|den|de|la|del|di|da) ){0,2}" + _WORD + r"){0,2}",
}
ANY = "|".join(PATTERNS.values())
FEMALE, MALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Госпожа"), ("Mr", "Herr", "Monsieur", "Señor", "Господин")
#: Syllables of surrogate names, and those that end a name without a female ending. Each turn adds one, so names do not run out.
LATIN = ("al", "be", "cor", "da", "el", "fin", "gar", "ho", "in", "jo", "ka", "lem", "mor", "na", "or", "per")
CYRILLIC = ("ал", "бе", "вор", "да", "ел", "фин", "гор", "хо", "ин", "ко", "ла", "лем", "мор", "на", "ор", "пер")
LATIN_ENDS, CYRILLIC_ENDS = (tuple(x for x in syllables if x[-1] not in "aeoаео") for syllables in (LATIN, CYRILLIC))
#: Kinds of a word: with a female ending and without. Their surrogates end differently, so they never meet.
WORD_KINDS = ("name:f", "name:m")
ROUNDS = 50
#: E-mail addresses get a letter more with each draw beyond these.
SAME_LENGTH = 4
MOST_MENTIONS = 200_000
#: What a text with an entity must hold.
TITLES = ("Mr", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Señor", "Господин", "Госпожа")


def may_hold(text: Column) -> Column:
    """False only for texts in which no pattern can match: a cheap test before the patterns."""
    titled = F.lit(False)
    for title in TITLES:
        titled = titled | text.contains(title)
    return F.coalesce(text.contains("@") | text.rlike("[0-9]") | titled | text.rlike("AKIA|gh[pousr]_|sk-|[A-Fa-f]{32}"), F.lit(False))


def entity_type(mention: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        kind = F.when(mention.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)
    return kind


def canonical(mention: Column, kind: Column) -> Column:
    return (
        F.when(kind == "email", F.lower(mention))
        .when(kind.isin("card", "ssn"), F.regexp_replace(mention, r"[^0-9]", ""))
        .when(kind == "phone", F.regexp_replace(mention, r"[^0-9+]", ""))
        .when(kind == "iban", F.regexp_replace(mention, " ", ""))
        .otherwise(mention)
    )


def _stream(kind: Column, entity: Column, turn: Column, secret: str) -> Column:
    """Hex digits of the keyed hash, two for each character of the entity."""
    block = lambda j: F.sha2(F.concat_ws("|", F.lit(secret), kind, entity, turn.cast("string"), j.cast("string")), 512)
    return F.array_join(F.transform(F.sequence(F.lit(0), (F.length(entity) / 64).cast("int")), block), "")


def _draw(stream: Column, i: Column, n: int) -> Column:
    """A number below n for character i."""
    return F.pmod(F.conv(F.substring(stream, i * 2 + 1, F.lit(2)), 16, 10).cast("int"), F.lit(n))


def _luhn(digits: Column) -> Column:
    """The sum that must be a multiple of ten: every second digit from the last but one on is doubled."""
    twice = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    each = F.transform(F.split(digits, ""), lambda d, i: F.when((F.length(digits) - i) % 2 == 0, twice(d.cast("int"))).otherwise(d.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, d: a + d)


def surrogate(kind: Column, entity: Column, turn: Column, secret: str) -> Column:
    stream = _stream(kind, entity, turn, secret)
    # Characters of the head and the tail stay: country code, prefix of a secret, top-level domain.
    head = F.when(kind.isin("phone", "iban"), F.when(entity.rlike("^[+A-Z]"), F.lit(2)).otherwise(F.lit(0))).when(entity.rlike("^(AKIA|gh._)"), F.lit(4)).when(entity.rlike("^sk-"), F.lit(3)).otherwise(F.lit(0))
    tail = F.when(kind == "email", F.length(F.substring_index(entity, ".", -1)) + 1).otherwise(F.lit(0))

    def char(c: Column, i: Column) -> Column:
        inside = (i >= head) & (i < F.length(entity) - tail)
        pick = lambda letters: F.substring(F.lit(letters), _draw(stream, i, len(letters)) + 1, F.lit(1))
        hexed = (kind == "secret") & (head == 0)
        # Hex keeps its case; a digit may become a letter of the case that the entity has.
        upper = c.rlike("[A-F]") | (c.rlike("[0-9]") & entity.rlike("[A-F]") & ~entity.rlike("[a-f]"))
        return F.when(~inside, c).when(hexed & upper, pick("0123456789ABCDEF")).when(hexed, pick("0123456789abcdef")).when(c.rlike("[0-9]"), pick("0123456789")).when(c.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz")).when(c.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).otherwise(c)

    # substring with Column arguments is not lazy about types, so positions are ints throughout.
    shaped = F.array_join(F.transform(F.split(entity, ""), lambda c, i: char(c, i)), "")
    octets = F.array_join(F.transform(F.split(entity, r"\."), lambda o, i: (_draw(stream, i, 222) + 1).cast("string")), ".")
    base = F.substring(shaped, F.lit(1), F.length(entity) - 1)
    card = F.concat(base, F.pmod(-_luhn(F.concat(base, F.lit("0"))), F.lit(10)).cast("string"))
    longer = F.when((kind == "email") & (turn > SAME_LENGTH), F.array_join(F.transform(F.sequence(F.lit(1), turn - SAME_LENGTH), lambda i: F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), _draw(stream, i, 26) + 1, F.lit(1))), ""))
    own = F.sha2(F.concat_ws("|", F.lit(secret), F.lit("word"), entity, turn.cast("string")), 512)
    russian, female = entity.rlike(r"\p{IsCyrillic}"), kind == WORD_KINDS[0]
    of = lambda latin, cyrillic, i, n: F.element_at(F.when(russian, F.array(*map(F.lit, cyrillic))).otherwise(F.array(*map(F.lit, latin))), _draw(own, i, n) + 1)
    syllables = F.array_join(F.transform(F.sequence(F.lit(0), turn + 1), lambda i: of(LATIN, CYRILLIC, i, len(LATIN))), "")
    ending = F.when(female, F.when(russian, "а").otherwise("a")).otherwise("")
    name = F.concat(syllables, of(LATIN_ENDS, CYRILLIC_ENDS, turn + 2, len(LATIN_ENDS)), ending)
    shaped = F.concat(F.coalesce(longer, F.lit("")), shaped)
    return F.when(kind == "ip", octets).when((kind == "card") & (F.pmod(_luhn(entity), F.lit(10)) == 0), card).when(kind.isin(*WORD_KINDS), name).otherwise(shaped)


def formatted(mention: Column, kind: Column, stand_in: Column) -> Column:
    """The surrogate in the mention's own format: its separators, its case."""
    kept = F.when(kind == "iban", F.regexp_replace(stand_in, "[^0-9A-Za-z]", "")).otherwise(F.regexp_replace(stand_in, "[^0-9]", ""))
    mark = F.when(kind == "iban", F.lit("[0-9A-Za-z]")).otherwise(F.lit("[0-9]"))
    refill = F.aggregate(
        F.split(mention, ""), F.struct(F.lit("").alias("text"), F.lit(1).alias("at")),
        lambda a, c: F.struct(F.concat(a["text"], F.when(F.regexp_like(c, mark), F.substring(kept, a["at"], F.lit(1))).otherwise(c)).alias("text"), (a["at"] + F.regexp_like(c, mark).cast("int")).alias("at")),
        lambda a: a["text"],
    )
    upper = F.transform(F.split(stand_in, ""), lambda c, i: F.when(F.substring(mention, i + 1, F.lit(1)).rlike("[A-Z]"), F.upper(c)).otherwise(c))
    return F.when(kind.isin("card", "ssn", "phone", "iban"), refill).when(kind == "email", F.array_join(upper, "")).otherwise(stand_in)


def name_pieces(names: DataFrame) -> DataFrame:
    """mention, at, piece, word: each name cut into runs of letters and what stands between; word is null for pieces that stay.

    The title stays, and so do particles and the single letter before an apostrophe.
    """
    pieces = F.regexp_extract_all("mention", F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    cut = names.select("mention", pieces.alias("pieces")).select("mention", "pieces", F.posexplode("pieces").alias("at", "piece"))
    after = F.coalesce(F.get("pieces", F.col("at") + 1), F.lit(""))
    word = (F.col("at") > 0) & F.col("piece").rlike(r"^\p{Lu}|^\p{L}") & ~((F.length("piece") == 1) & after.rlike("^['’]"))
    inner = F.col("piece").rlike(r"^\p{Ll}") & F.get("pieces", F.col("at") - 1).rlike(r"^ $")  # a particle: small, and a word of its own
    return cut.select("mention", "at", "piece", F.when(word & ~inner, F.lower("piece")).alias("word"), F.get("pieces", F.lit(0)).alias("title"), ((F.col("at") == 2) & F.array_contains(F.expr("slice(pieces, 4, size(pieces))"), " ")).alias("given"))


def word_kinds(pieces: DataFrame) -> DataFrame:
    """kind, entity for each distinct word."""
    given = lambda titles: F.coalesce(F.bool_or(F.col("given") & F.col("title").isin(*titles)), F.lit(False))
    female = F.col("word").rlike("[aая]$") | (given(FEMALE) & ~given(MALE))
    return pieces.where("word is not null").groupBy("word").agg(female.alias("female")).select(F.when(F.col("female"), WORD_KINDS[0]).otherwise(WORD_KINDS[1]).alias("kind"), F.col("word").alias("entity"))


def shown_names(pieces: DataFrame, names: DataFrame) -> DataFrame:
    """mention, shown of each name, from its words' surrogates in the case of what they stand for."""
    words = names.where(F.col("kind").isin(*WORD_KINDS)).select(F.col("entity").alias("word"), "surrogate")
    met = pieces.join(words, "word", "left")
    loud = F.col("piece").rlike(r"^\p{Lu}{2,}$")
    cased = F.when(F.col("surrogate").isNull(), F.col("piece")).when(loud, F.upper("surrogate")).when(F.col("piece").rlike(r"^\p{Lu}"), F.initcap("surrogate")).otherwise(F.col("surrogate"))
    return met.groupBy("mention").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", cased.alias("text")))), lambda p: p["text"]), "").alias("shown"))


def assigned(entities: DataFrame, secret: str) -> DataFrame:
    """kind, entity, surrogate for the distinct entities (kind, entity), without collisions."""
    named = lambda df: settled(df.select("kind", "entity", "turn", surrogate(F.col("kind"), F.col("entity"), F.col("turn"), secret).alias("surrogate")), "surrogates")
    now = named(entities.select("kind", "entity", F.lit(0).alias("turn")))
    real = entities.select("kind", F.col("entity").alias("surrogate"))
    # A word is no surrogate of either kind of words.
    other = F.when(F.col("kind") == WORD_KINDS[0], WORD_KINDS[1]).otherwise(WORD_KINDS[0])
    real = real.union(real.where(F.col("kind").isin(*WORD_KINDS)).select(other.alias("kind"), "surrogate"))
    for _ in range(ROUNDS):
        # The least entity keeps a shared surrogate; a surrogate that is someone's real value goes.
        owners = now.groupBy("kind", "surrogate").agg(F.min(F.struct("turn", "entity")).alias("owner"), F.count(F.lit(1)).alias("n"))
        losers = owners.where("n > 1").join(now, ["kind", "surrogate"]).where(F.col("entity") != F.col("owner.entity")).select("kind", "entity")
        lost = settled(losers.union(now.join(real, ["kind", "surrogate"], "left_semi").select("kind", "entity")).distinct(), "collisions")
        if lost.isEmpty():
            dropped(lost)
            return now
        again, before = now.join(lost.withColumn("lost", F.lit(1)), ["kind", "entity"], "left"), now
        now = named(again.select("kind", "entity", (F.col("turn") + F.coalesce("lost", F.lit(0))).alias("turn")))
        dropped(lost, before)
    raise ValueError(f"more entities of one type than surrogates: collisions are left after {ROUNDS} rounds")


def _text_key(text: Column) -> Column:
    """128 bits: texts of one key are equal."""
    return F.struct(F.xxhash64(text, F.length(text)).alias("one"), F.xxhash64(F.lit(1), text).alias("two"))


def replace(docs: DataFrame, secret: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, text with surrogates, n_entities (mentions), kinds (array of (kind, mentions))."""
    kept = [c for c in keep if c.lower() != "text"]
    key, found = free_names(docs, "key", "found")
    text = F.col("text").cast("string")
    # One pass of the patterns: the mentions of each text that has some.
    met = docs.where(may_hold(text)).select(text.alias("text")).select(_text_key(F.col("text")).alias("key"), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)).alias("mentions"))
    touched = settled(met.where(F.size("mentions") > 0), "touched")
    distinct = touched.select(F.explode(F.array_distinct("mentions")).alias("mention")).distinct()
    typed = distinct.select("mention", entity_type(F.col("mention")).alias("kind"))
    mentions = settled(typed.select("mention", "kind", canonical(F.col("mention"), F.col("kind")).alias("entity")), "mentions")
    pieces = settled(name_pieces(mentions.where("kind = 'name'")), "name-pieces")
    plain = mentions.where("kind <> 'name'")
    entities = settled(plain.select("kind", "entity").distinct().unionByName(word_kinds(pieces)), "entities")
    names = assigned(entities, secret)
    others = plain.join(names.select("kind", "entity", "surrogate"), ["kind", "entity"]).select("mention", "kind", formatted(F.col("mention"), F.col("kind"), F.col("surrogate")).alias("shown"))
    shown = settled(others.unionByName(shown_names(pieces, names).select("mention", F.lit("name").alias("kind"), "shown")), "shown")
    dropped(mentions, pieces, entities, names)

    # Mentions are looked up one by one and put back in order, a row for each text.
    few = shown.count() <= MOST_MENTIONS
    places = touched.dropDuplicates(["key"]).select("key", F.posexplode("mentions").alias("at", "mention"))
    filled = places.join(F.broadcast(shown) if few else shown, "mention").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("at", "shown", "kind"))).alias("found"))
    filled = settled(filled.select(F.col("key").alias(key), F.col("found").alias(found)), "filled")

    # The texts of those rows are cut at their mentions. Rows that cannot hold any stay where they are.
    rows = docs.select(*kept, text.alias("text"))
    few = places.count() <= MOST_MENTIONS
    dropped(touched, shown)
    tested = F.when(may_hold(F.col("text")), _text_key(F.col("text")))
    if few:
        joined, rest = rows.withColumn(key, tested).join(F.broadcast(filled), key, "left"), None
    else:
        joined, rest = rows.where(may_hold(F.col("text"))).withColumn(key, _text_key(F.col("text"))).join(filled, key, "left"), rows.where(~may_hold(F.col("text")))
    parts = F.split(F.col("text"), ANY, -1)
    whole = F.array_join(F.zip_with(parts, F.transform(found, lambda f: f["shown"]), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    kinds = F.array_sort(F.array_distinct(F.transform(found, lambda f: f["kind"])))
    nothing = F.lit(0).cast("long"), F.array().cast("array<string>")
    has = F.col(found).isNotNull()
    changed = joined.select(*kept, F.when(has, whole).otherwise(F.col("text")).alias("text"), F.when(has, F.size(found).cast("long")).otherwise(nothing[0]).alias("n_entities"), F.when(has, kinds).otherwise(nothing[1]).alias("kinds"))
    return changed if rest is None else changed.unionByName(rest.select(*kept, "text", nothing[0].alias("n_entities"), nothing[1].alias("kinds")))
