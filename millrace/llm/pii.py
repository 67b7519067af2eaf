"""Personal data and secrets replaced by keyed surrogates, in DataFrame expressions alone.

Found are e-mail addresses, phone numbers, card numbers, social security numbers, IBANs, IPv4
addresses, keys and tokens, passwords after a sign, and names after a title. Spellings of one entity
(case, spaces, punctuation) have one canonical value, and so one surrogate everywhere.

A surrogate has the form of what it replaces: digits stand for digits, letters for letters of the same
script and case, punctuation stays. Card numbers and IBANs keep their check digits right if they were,
phone numbers their country code, addresses of the e-mail kind their top-level domain; a domain has
one surrogate for all its addresses. A name gets names for the gender of its title; under titles of two
genders it stands for two people. A plus sign begins a phone number from seven digits on.

Surrogates are drawn by a keyed hash over (kind, canonical value, attempt). Collision checks work on
all distinct entities: a draw that is itself an entity of the corpus, that another entity holds, or
that another draws in the same attempt is given up by all but the first, who draws again. Distinct
entities thus keep distinct surrogates. The attempts are joins over the entities still without one,
whose number falls by the share of free values each time.

Only documents with entities are joined. A frequent entity or list of entities is one row on the
other side of each join. Null texts stay null; texts without entities stay as they are, as do empty ones. Repeated
rows are treated alike. An empty table gives an empty result. The patterns begin where no sign of theirs
stands before and don't go back, so long texts, also of one run of letters, take time in proportion. Column ``text`` is replaced, ``n_entities`` added, all others kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.workspace import apart, spare, written

#: Attempts after which a kind's values are taken to be used up, and those after which addresses grow by a sign.
MOST_ATTEMPTS, GROWING = 60, 10

# Titles, and names to draw from, by gender.
MALE_TITLES = ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Signor", "г-н", "господин", "κύριος")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Signora", "г-жа", "госпожа", "κυρία")
NEUTRAL_TITLES = ("Dr", "Prof")
GIVEN = {
    "male": ("Adam", "Bruno", "Carl", "Daniel", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karim", "Leon", "Martin", "Nils", "Oscar", "Paul"),
    "female": ("Anna", "Berta", "Clara", "Diana", "Elena", "Flora", "Greta", "Helena", "Irene", "Julia", "Karla", "Laura", "Maria", "Nora", "Olga", "Paula"),
    "neutral": ("Alex", "Chris", "Dana", "Eli", "Jules", "Kim", "Lou", "Mika", "Noa", "Robin", "Sam", "Toni", "Uli", "Vanja", "Jona", "Sascha"),
}
SYLLABLES = ("ba", "del", "for", "gan", "hol", "jen", "kar", "lin", "mor", "nes", "par", "ros", "san", "tel", "vin", "wes")
#: Country codes of phone numbers with one digit and with two; the others have three.
ONE_DIGIT, TWO_DIGITS = "[17]", "2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзийклмнопрстуфхцчшщыэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}

_TITLES = "|".join(sorted(MALE_TITLES + FEMALE_TITLES + NEUTRAL_TITLES, key=len, reverse=True))
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Kinds in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@(?:[\p{L}\p{N}\-]++\.){1,126}\p{L}{2,}",
    "key": r"(?<![\p{L}\p{N}])(?:AKIA|ASIA)[A-Z0-9]{16}(?![\p{L}\p{N}])|(?<![\p{L}\p{N}])(?:ghp|gho|ghs|sk|pk|xoxb|xoxp)[_\-][A-Za-z0-9_\-]{16,}|(?<![\p{L}\p{N}])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![\p{L}\p{N}])",
    "password": r"(?<![\p{L}\p{N}])(?i:password|passwd|pwd|secret)[=:][^\s\"']{6,}",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "phone": r"(?<![\p{L}\p{N}])\+(?=(?:[ .\-()]{0,3}[0-9]){7})[0-9]{1,3}(?:[ .\-]?\(?[0-9]{1,4}\)?){2,5}(?![0-9])|(?<![\p{L}\p{N}])\([0-9]{3}\) ?[0-9]{3}[ .\-][0-9]{4}(?![0-9])|(?<![\p{L}\p{N}.\-])[0-9]{3}[ .\-][0-9]{3}[ .\-][0-9]{4}(?![0-9])",
    "card": r"(?<![\p{L}\p{N}])[0-9](?:[ \-]?[0-9]){12,18}(?![\p{L}\p{N}])",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLES})\.? \p{{Lu}}[\p{{L}}'\-]+(?: \p{{Lu}}[\p{{L}}'\-]+)?",
}


def kind(mention: Column) -> Column:
    """The first kind whose pattern is the whole mention."""
    found = F.lit("key")
    for name, pattern in reversed(PATTERNS.items()):
        found = F.when(mention.rlike(f"^(?:{pattern})$"), name).otherwise(found)
    return found


def canonical(kind_: Column, mention: Column) -> Column:
    """One value for all spellings of an entity."""
    digits = F.regexp_replace(mention, r"[^0-9]", "")
    return (
        F.when(kind_ == "email", F.lower(mention))
        .when(kind_.isin("phone", "card", "ssn"), digits)
        .when(kind_ == "iban", F.regexp_replace(mention, " ", ""))
        .when(kind_ == "password", F.regexp_extract(mention, r"[=:](.*)$", 1))
        .when(kind_ == "name", F.lower(F.regexp_extract(mention, rf"^(?:{_TITLES})\.? (.*)$", 1)))
        .otherwise(mention)
    )


def _gender(mention: Column) -> Column:
    title = F.regexp_extract(mention, rf"^({_TITLES})", 1)
    return F.when(title.isin(*MALE_TITLES), "male").when(title.isin(*FEMALE_TITLES), "female").otherwise("neutral")


def _drawn(seed: Column, place: Column, values: int) -> Column:
    """A number below ``values`` for a place, from the seed's hash."""
    return F.pmod(F.xxhash64(seed, place), F.lit(values))


def _pick(text: str, at: Column) -> Column:
    return F.substring(F.lit(text), (at + 1).cast("int"), F.lit(1))


def _redrawn(value: Column, seed: Column, keep: Column | None = None) -> Column:
    """Each digit and letter replaced by one of its own kind; ``keep``: how many first characters stay."""

    def one(sign: Column, i: Column) -> Column:
        fresh = F.when(sign.rlike("^[0-9]$"), _drawn(seed, i, 10).cast("string"))
        for name, script in (("latin", r"\p{IsLatin}"), ("cyrillic", r"\p{IsCyrillic}"), ("greek", r"\p{IsGreek}")):
            letters = ALPHABETS[name]
            fresh = fresh.when(sign.rlike(f"^{script}$"), _pick(letters, _drawn(seed, i, len(letters))))
        fresh = fresh.otherwise(sign)
        fresh = F.when(sign == F.lower(sign), fresh).otherwise(F.upper(fresh))
        return fresh if keep is None else F.when(i < keep, sign).otherwise(fresh)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _hex(value: Column, seed: Column) -> Column:
    low = F.transform(F.split(value, ""), lambda sign, i: _pick("0123456789abcdef", _drawn(seed, i, 16)))
    joined = F.array_join(low, "")
    return F.when(value.rlike("[A-F]"), F.upper(joined)).otherwise(joined)


def _digit(value: Column, i: Column) -> Column:
    return F.substring(value, i.cast("int"), F.lit(1)).cast("int")


def _luhn_sum(digits: Column) -> Column:
    """The sum of a number whose last digit is still to come."""
    places = F.sequence(F.lit(1), F.length(digits))

    def share(i: Column) -> Column:
        doubled = _digit(digits, i) * F.when((F.length(digits) - i) % 2 == 0, 2).otherwise(1)
        return F.when(doubled > 9, doubled - 9).otherwise(doubled)

    return F.aggregate(F.transform(places, share), F.lit(0), lambda a, x: a + x)


def _checked_card(digits: Column, seed: Column) -> Column:
    body = F.substring(_redrawn(digits, seed, F.lit(1)), F.lit(1), F.length(digits) - 1)
    own = F.substring(digits, F.lit(1), F.length(digits) - 1)
    check = lambda x: F.pmod(10 - _luhn_sum(x) % 10, F.lit(10)).cast("string")
    right = check(own) == F.substring(digits, F.length(digits), F.lit(1))
    return F.when(right, F.concat(body, check(body))).otherwise(_redrawn(digits, seed, F.lit(1)))


def _remainder97(text: Column) -> Column:
    """Of an IBAN in its order for checking, letters counting from 10."""
    signs = F.split(F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, F.lit(1), F.lit(4))), "")

    def add(a: Column, sign: Column) -> Column:
        value = F.when(sign.rlike("^[0-9]$"), sign.cast("int")).otherwise(F.ascii(sign) - 55)
        return F.when(value < 10, (a * 10 + value) % 97).otherwise((a * 100 + value) % 97)

    return F.aggregate(signs, F.lit(0), add)


def _checked_iban(value: Column, seed: Column) -> Column:
    country = F.substring(value, F.lit(1), F.lit(2))
    body = F.substring(_redrawn(value, seed, F.lit(4)), F.lit(5), F.length(value))
    check = F.lpad((98 - _remainder97(F.concat(country, F.lit("00"), body))).cast("string"), 2, "0")
    return F.concat(country, F.when(_remainder97(value) == 1, check).otherwise(F.substring(_redrawn(value, seed), F.lit(3), F.lit(2))), body)


def _fresh_name(value: Column, gender: Column, seed: Column, key: str, attempt: Column) -> Column:
    """A surname of syllables, and a given name if there was one.

    A surname has the same surrogate with every given name. Later attempts draw other and longer given
    names; a surname alone is drawn anew, and gets longer.
    """
    syllables = F.array(*[F.lit(s) for s in SYLLABLES])
    last = F.substring_index(value, " ", -1)
    redraw = F.when(value.contains(" "), F.lit(0)).otherwise(attempt).cast("int")
    own = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("surname"), last, redraw.cast("string")), 256)
    count = F.lit(4) + F.floor(redraw / 4).cast("int")
    surname = F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: F.element_at(syllables, (_drawn(own, i, len(SYLLABLES)) + 1).cast("int"))), "")
    given = F.lit(None).cast("string")
    for name, pool in GIVEN.items():
        found = F.element_at(F.array(*[F.lit(p.lower()) for p in pool]), (_drawn(seed, F.lit(0), len(pool)) + 1).cast("int"))
        given = F.when(gender == name, found).otherwise(given)
    more = F.transform(F.sequence(F.lit(0), F.floor(attempt / 2).cast("int")), lambda i: F.when(i > 0, F.element_at(syllables, (_drawn(seed, i, len(SYLLABLES)) + 1).cast("int"))).otherwise(""))
    given = F.concat(given, F.array_join(more, ""))
    latin = F.when(value.contains(" "), F.concat(given, F.lit(" "), surname)).otherwise(surname)
    # names of other scripts keep their shape in that script
    return F.when(value.rlike(r"[\p{IsCyrillic}\p{IsGreek}]"), _redrawn(value, seed)).otherwise(latin)


def surrogate(kind_: Column, value: Column, gender: Column, key: str, attempt: Column) -> Column:
    """The draw of one attempt for a canonical value."""
    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), kind_, value, F.when(kind_ == "name", gender), attempt.cast("string")), 256)
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    top = F.substring_index(domain, ".", -1)
    site = F.substring(domain, F.lit(1), F.length(domain) - F.length(top) - 1)
    # a domain has the same surrogate in all addresses
    site_seed = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("domain"), domain), 256)
    octets = F.transform(F.split(value, r"\."), lambda x, i: (_drawn(seed, i, 254) + 1).cast("string"))
    code = F.when(value.rlike(f"^(?:{ONE_DIGIT})"), 1).when(value.rlike(f"^(?:{TWO_DIGITS})"), 2).otherwise(3)
    country = F.when(F.length(value) > 10, code).otherwise(0)
    # where short addresses are used up, later attempts are longer
    grown = F.substring(seed, F.lit(1), F.floor(attempt / GROWING).cast("int"))
    return (
        F.when(kind_ == "email", F.concat(_redrawn(local, seed), grown, F.lit("@"), _redrawn(site, site_seed), F.lit("."), top))
        .when(kind_ == "phone", _redrawn(value, seed, country))
        .when(kind_ == "card", _checked_card(value, seed))
        .when(kind_ == "iban", _checked_iban(value, seed))
        .when(kind_ == "ip", F.array_join(octets, "."))
        .when(kind_ == "name", _fresh_name(value, gender, seed, key, attempt))
        .when((kind_ == "key") & value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), _hex(value, seed))
        .when(kind_ == "key", _redrawn(value, seed, F.lit(4)))
        .otherwise(_redrawn(value, seed))
    )


def rendered(kind_: Column, mention: Column, fresh: Column) -> Column:
    """The surrogate in the spelling of a mention: its punctuation, spaces and case."""
    places = F.sequence(F.lit(1), F.length(mention))

    def digit(i: Column) -> Column:
        sign = F.substring(mention, i, F.lit(1))
        before = F.length(F.regexp_replace(F.substring(mention, F.lit(1), i), "[^0-9]", ""))
        return F.when(sign.rlike("^[0-9]$"), F.substring(fresh, before, F.lit(1))).otherwise(sign)

    def spaced(i: Column) -> Column:
        sign = F.substring(mention, i, F.lit(1))
        before = F.length(F.replace(F.substring(mention, F.lit(1), i), F.lit(" "), F.lit("")))
        return F.when(sign == " ", sign).otherwise(F.substring(fresh, before, F.lit(1)))

    def cased(i: Column) -> Column:
        sign, new = F.substring(mention, i, F.lit(1)), F.substring(fresh, i, F.lit(1))
        return F.when(sign == F.lower(sign), new).otherwise(F.upper(new))

    each = lambda f: F.array_join(F.transform(places, f), "")
    title = F.regexp_extract(mention, rf"^((?:{_TITLES})\.? )", 1)
    name = F.substring(mention, F.length(title) + 1, F.length(mention))
    spelled = F.split(name, " ")

    def word(new: Column, i: Column) -> Column:
        old = F.get(spelled, i)
        return F.when((old == F.upper(old)) & (F.length(old) > 1), F.upper(new)).otherwise(F.initcap(new))

    return (
        F.when(kind_ == "email", each(cased))
        .when(kind_.isin("phone", "card", "ssn"), each(digit))
        .when(kind_ == "iban", each(spaced))
        .when(kind_ == "password", F.concat(F.regexp_extract(mention, r"^([^=:]*[=:])", 1), fresh))
        .when(kind_ == "name", F.concat(title, F.array_join(F.transform(F.split(fresh, " "), word), " ")))
        .otherwise(fresh)
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """kind, value, gender, fresh for distinct entities (kind, value, gender): no two of a kind alike, none an entity.

    Should a kind's values be used up after ``MOST_ATTEMPTS``, what is left of it gets zeros, all alike.
    """
    entities = entities.withColumn("gender", F.coalesce("gender", F.lit("neutral")))
    taken = apart(entities).select(F.col("kind").alias("taken_kind"), F.col("value").alias("taken")).distinct()
    pending, held, attempt = entities, [], 0
    while attempt < MOST_ATTEMPTS and not pending.isEmpty():
        drawn = pending.select("kind", "value", "gender", surrogate(F.col("kind"), F.col("value"), F.col("gender"), key, F.lit(attempt)).alias("fresh"))
        for used in [taken, *[apart(h).select(F.col("kind").alias("taken_kind"), F.col("fresh").alias("taken")) for h in held]]:
            used = used.withColumnsRenamed({"taken_kind": "used_kind", "taken": "used"})
            drawn = drawn.join(used, (F.col("kind") == F.col("used_kind")) & (F.col("fresh") == F.col("used")), "left_anti")
        first = drawn.groupBy("kind", "fresh").agg(F.min(F.struct("value", "gender")).alias("first"))
        won = written(first.select("kind", F.col("first.value").alias("value"), F.col("first.gender").alias("gender"), "fresh"), "surrogates")
        held.append(won)
        done = apart(won).select(F.col("kind").alias("done_kind"), F.col("value").alias("done"), F.col("gender").alias("done_gender"))
        same = (F.col("kind") == F.col("done_kind")) & (F.col("value") == F.col("done")) & (F.col("gender") == F.col("done_gender"))
        pending = written(pending.join(done, same, "left_anti"), "pending")
        attempt += 1
    result = pending.select("kind", "value", "gender", F.regexp_replace("value", r"[\p{L}\p{N}]", "0").alias("fresh"))
    for more in held:
        result = result.unionByName(more)
    return result


def pseudonymised(docs: DataFrame, key: str, keep: Sequence[str] = ()) -> DataFrame:
    """The rows of ``docs`` with surrogates in ``text``, and n_entities. ``keep``: kinds left as they are."""
    columns = [c for c in docs.columns if c.lower() != "n_entities"]
    mentions, list_hash = spare(docs, "mentions"), spare(docs, "list_hash")
    wanted = "|".join(p for name, p in PATTERNS.items() if name not in keep)
    found = docs.select(*columns, F.regexp_extract_all("text", F.lit(wanted), F.lit(0)).alias(mentions))
    found = found.withColumn(list_hash, F.when(F.size(mentions) > 0, F.sha2(F.array_join(mentions, "\x1f"), 256)))
    found = written(found, "mentions")
    without = found.where(F.col(list_hash).isNull()).select(*columns, F.lit(0).cast("long").alias("n_entities"))
    holders = found.where(F.col(list_hash).isNotNull())
    lists = written(holders.groupBy(F.col(list_hash).alias("list_hash")).agg(F.first(mentions).alias("mentions")), "lists")
    spelled = lists.select(F.explode("mentions").alias("mention")).distinct().withColumn("kind", kind(F.col("mention")))
    spelled = spelled.withColumn("value", canonical(F.col("kind"), F.col("mention")))
    spelled = written(spelled.withColumn("gender", F.when(F.col("kind") == "name", _gender(F.col("mention")))), "spellings")
    # a name of two genders is two people; without a gender it is the one person of that name, if there is one
    told = F.when(F.col("gender") != "neutral", F.col("gender"))
    known = spelled.groupBy("kind", "value").agg(F.min(told).alias("least"), F.max(told).alias("greatest"))
    known = known.select(F.col("kind").alias("known_kind"), F.col("value").alias("known_value"), F.when(F.col("least") == F.col("greatest"), F.col("least")).alias("only"))
    spelled = spelled.join(known, (F.col("kind") == F.col("known_kind")) & (F.col("value") == F.col("known_value")))
    spelled = spelled.select("mention", "kind", "value", F.coalesce(told, "only", F.lit("neutral")).alias("gender"))
    spelled = written(spelled, "spellings")
    entities = written(spelled.select("kind", "value", "gender").distinct(), "entities")
    fresh = surrogates(entities, key)
    named = spelled.select("mention", *[F.col(c).alias(f"its_{c}") for c in ("kind", "value", "gender")])
    table = named.join(fresh, (F.col("its_kind") == F.col("kind")) & (F.col("its_value") == F.col("value")) & (F.col("its_gender") == F.col("gender")))
    table = written(table.select(F.col("mention").alias("old"), rendered(F.col("kind"), F.col("mention"), F.col("fresh")).alias("new")), "renderings")
    places = lists.select("list_hash", F.posexplode("mentions").alias("place", "mention"))
    placed = places.join(table, F.col("mention") == F.col("old"))
    new = spare(docs, "new")
    replaced = placed.groupBy("list_hash").agg(F.array_sort(F.collect_list(F.struct("place", "new"))).alias(new)).withColumnRenamed("list_hash", list_hash)
    pieces = F.split("text", wanted, -1)
    joined = F.array_join(
        F.transform(F.sequence(F.lit(1), F.size(pieces)), lambda i: F.concat(F.element_at(pieces, i), F.coalesce(F.get(new, i - 1)["new"], F.lit("")))), ""
    )
    changed = holders.join(replaced, list_hash).withColumn("text", joined)
    changed = changed.select(*columns, F.size(mentions).cast("long").alias("n_entities"))
    return changed.unionByName(without)
