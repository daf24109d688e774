"""Personal data: detection and keyed, type-consistent surrogates.

SQL functions only.

Detected: e-mail, IPv4 and IPv6 addresses, telephone, card, social-security and
account (IBAN) numbers, and names after a title, in Latin, Cyrillic and Greek script. A match
is one or two entities: its kind and a normal value (lower-case address, bare
digits, a given or a family name), so that a number written in two ways or a
family name met alone and with a given name is one entity (coreference). A
family name found after a title is replaced wherever else it stands as a word in
the same text, also in capitals or before a possessive 's.

A surrogate is drawn from SHA-256 of a secret key, the kind, the value and an
attempt number. It has the kind's format: digits for digits in the place and
punctuation of the original, valid octets, a valid check digit where the
original had one, letters of the same script and case, given names of the
title's gender (of either for Dr and Prof). Later attempts add letters, digits or
syllables, and for IPv4 turn to documentation addresses of IPv6, so no format is
ever used up. Entities of the whole corpus are compared: of those that drew
the same surrogate, or one that is some entity's real value, the first by hash
keeps it and the others draw again, until all differ (distinctness).

Texts without a match pass through; the others are joined to their own
entities' surrogates, so no map of all entities is ever broadcast by hand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import write_once

# Fixed lists: titles by gender, and given names by gender and script.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Госпожа", "г-жа", "Κυρία"),
    "m": ("Mr", "Sir", "Herr", "Señor", "Sr", "Monsieur", "Господин", "г-н", "Κύριος"),
    "n": ("Dr", "Doctor", "Prof", "Professor"),
}
GIVEN = {
    "f_latin": ("Anna", "Clara", "Elena", "Greta", "Helen", "Ida", "Julia", "Laura", "Maria", "Nina", "Rosa", "Sofia"),
    "m_latin": ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Leo", "Martin", "Oscar", "Paul", "Victor"),
    "f_cyrillic": ("Анна", "Вера", "Дарья", "Елена", "Ирина", "Лидия", "Мария", "Нина", "Ольга", "Софья"),
    "m_cyrillic": ("Антон", "Борис", "Виктор", "Глеб", "Иван", "Кирилл", "Лев", "Олег", "Павел", "Юрий"),
    "f_greek": ("Άννα", "Ελένη", "Ζωή", "Ιωάννα", "Μαρία", "Σοφία"),
    "m_greek": ("Ανδρέας", "Γιώργος", "Νίκος", "Παύλος", "Πέτρος", "Σπύρος"),
}
GIVEN |= {f"n_{script}": GIVEN[f"f_{script}"] + GIVEN[f"m_{script}"] for script in ("latin", "cyrillic", "greek")}
# Attempts that keep the exact format of addresses and numbers.
SAME_FORMAT = 6
# Syllables of made-up names: first, middle, last.
SYLLABLES = {
    "latin": (("Bar", "Cal", "Den", "Fal", "Gor", "Hal", "Kel", "Lam", "Mor", "Nor", "Pel", "Ral", "Sor", "Tal", "Var", "Wil"),
              ("ba", "de", "ga", "ko", "la", "me", "no", "ra", "se", "ti"), ("dan", "ler", "man", "ner", "son", "ton", "vik", "wood")),
    "cyrillic": (("Бар", "Вол", "Гор", "Дол", "Жар", "Кал", "Лаз", "Мор", "Нов", "Пол", "Рад", "Сол", "Тар", "Фил"),
                 ("ба", "ви", "до", "ко", "ла", "ми", "но", "ра", "со", "ти"), ("нов", "лев", "рин", "сов", "тин")),
    "greek": (("Βασ", "Γεω", "Δημ", "Καλ", "Λαμ", "Μαν", "Νικ", "Παπ", "Σταμ", "Χρισ"),
              ("α", "ι", "ο", "ατο", "ικο"), ("δης", "κης", "λου", "νος", "πουλος", "της")),
}
_TITLE = "|".join(t for ts in TITLES.values() for t in sorted(ts, key=len, reverse=True))
# An apostrophe belongs to a name (O'Brien) unless a possessive s follows it.
_NAME = r"\p{Lu}(?:[\p{L}\p{M}-]|['’](?![sS](?![\p{L}\p{M}])))*+"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# Runs are possessive and start at their boundary, so matching stays linear.
# 1.2.3.4 after one of these is a version.
_VERSION = r"(?<!\b[vV](?:er|ersion)?[. ]{0,2})"
_HEX4 = "[0-9A-Fa-f]{1,4}"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+",
    "ip": rf"(?<![\d.]){_VERSION}(?:{OCTET}\.){{3}}{OCTET}(?!\.?\d)",
    "card": r"(?<![\p{L}\d])(?<!\d[.,])(?:(?:\d{4}[ -]?){3}\d{4}|3[47]\d{2}[ -]?\d{6}[ -]?\d{5})(?![\p{L}\d])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    # In groups, in pairs after a 0, after a country code, and without any mark.
    "phone": (
        r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3,4}[ .-]\d{3,4}(?!\d)"
        r"|(?<![\p{L}\d.,+-])0\d(?:[ .-]\d{2}){4}(?![\p{L}\d])"
        r"|(?<![\p{L}\d+])\+(?=(?:[ .-]?\d){7,15}(?!\d))\d{1,3}(?:[ .-]\d{1,8}){2,6}(?![\p{L}\d])"
        r"|(?<![\p{L}\d+])\+\d{8,15}(?![\p{L}\d])"
        r"|(?<![\p{L}\d.,+/=_-])[2-9]\d{2}[2-9]\d{6}(?![\p{L}\d]|[.,/=_-]\d)"
    ),
    # Eight groups, or fewer around a double colon, with a digit somewhere.
    "ipv6": (
        rf"(?<![\p{{L}}\p{{N}}:.])(?=[0-9A-Fa-f:]*\d)(?:(?:{_HEX4}:){{7}}{_HEX4}|(?:{_HEX4}:){{1,6}}(?::{_HEX4}){{1,6}})(?![\p{{L}}\p{{N}}:])"
    ),
    "iban": r"(?<![\p{L}\p{N}])(?=(?:[A-Z0-9 ]*?\d){10})[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE})(?![\p{{L}}\p{{M}}])\.?\x20{_NAME}(?:\x20{_NAME})?",
}
# A look at the next character spares most places the patterns of numbers.
ANY = "|".join([
    PATTERNS["email"],
    rf"(?=[0-9+(])(?:{'|'.join(PATTERNS[k] for k in ('ip', 'card', 'ssn', 'phone'))})",
    rf"(?=[0-9A-Fa-f]{{1,4}}:)(?:{PATTERNS['ipv6']})",
    rf"(?=[A-Z]{{2}}\d)(?:{PATTERNS['iban']})",
    rf"(?=\p{{Lu}}|г)(?:{PATTERNS['name']})",
])
DEFAULT_KEY = "change this key"


def _kind(match: Column) -> Column:
    return (
        F.when(match.contains("@"), "email")
        .when(match.rlike(rf"^(?:{_TITLE})(?![\p{{L}}\p{{M}}])"), "name")
        .when(match.contains(":"), "ipv6")
        .when(match.rlike(r"^[A-Z]{2}\d"), "iban")
        .when(match.rlike(rf"^(?:{OCTET}\.){{3}}{OCTET}$"), "ip")
        .when(match.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(match.rlike(r"^(?:(?:\d{4}[ -]?){3}\d{4}|3[47]\d{2}[ -]?\d{6}[ -]?\d{5})$"), "card")
        .otherwise("phone")
    )


def _script(name: Column) -> Column:
    return F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic").when(name.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _name_parts(match: Column) -> dict[str, Column]:
    """Title with its spaces, given name (may be empty) and family name."""
    parts = F.split(match, " ")
    n = F.size(parts)
    titled = lambda g: match.rlike(rf"^(?:{'|'.join(TITLES[g])})(?![\p{{L}}\p{{M}}])")
    return {
        "title": F.get(parts, F.lit(0)),
        "given": F.when(n > 2, F.get(parts, F.lit(1))).otherwise(F.lit("")),
        "family": F.get(parts, n - 1),
        "gender": F.when(titled("f"), "f").when(titled("n"), "n").otherwise("m"),
    }


def _plain_name(name: Column) -> Column:
    """A name without capitals throughout: JONES is Jones."""
    return F.when(_capitals(name), F.initcap(F.lower(name))).otherwise(name)


def _capitals(name: Column) -> Column:
    return (F.length(name) > 1) & (name == F.upper(name)) & (name != F.lower(name))


def _family_kind(script: Column, gender: Column) -> Column:
    # Family names have a gender in Cyrillic script only: Mr and Mrs Smith share theirs.
    gendered = F.when((script == "cyrillic") & (gender != "n"), F.concat_ws("_", F.lit("family"), gender, script))
    return F.coalesce(gendered, F.concat_ws("_", F.lit("family"), script))


def _entities(match: Column) -> Column:
    """``array<struct<kind, value>>`` of a match."""

    def one(kind: Column, value: Column) -> Column:
        return F.struct(kind.alias("kind"), value.alias("value"))

    kind = _kind(match)
    name = _name_parts(match)
    script = _script(name["family"])
    given = one(F.concat_ws("_", F.lit("given"), name["gender"], script), _plain_name(name["given"]))
    family = one(_family_kind(script, name["gender"]), _plain_name(name["family"]))
    return (
        F.when(kind == "name", F.when(name["given"] != "", F.array(given, family)).otherwise(F.array(family)))
        .when(kind == "email", F.array(one(kind, F.lower(match))))
        .when(kind == "ip", F.array(one(kind, match)))
        .when(kind == "ipv6", F.array(one(kind, F.lower(match))))
        .when(kind == "iban", F.array(one(kind, F.replace(match, F.lit(" "), F.lit("")))))
        .otherwise(F.array(one(kind, F.regexp_replace(match, r"\D", ""))))
    )


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of a digit string (0: valid)."""
    places = F.transform(F.reverse(F.split(digits, "")), lambda d, i: (d.cast("int") * (1 + i % 2)))
    return F.aggregate(places, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10


def _iban_check(country: Column, account: Column) -> Column:
    """The two check digits of an IBAN: 98 less its number modulo 97, letters
    standing for 10 to 35."""
    def place(c: Column) -> Column:
        return F.ascii(c) - F.when(c.rlike("[0-9]"), 48).otherwise(55)

    def step(acc: Column, c: Column) -> Column:
        return (acc * F.when(place(c) > 9, 100).otherwise(10) + place(c)) % 97

    chars = F.split(F.concat(account, country, F.lit("00")), "")
    return F.lpad((98 - F.aggregate(chars, F.lit(0), step)).cast("string"), 2, "0")


def _surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The surrogate that an entity draws in an attempt."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, value, attempt.cast("string"))
    stream = F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("\x1f2")), 256))

    def byte(i: Column) -> Column:
        return F.conv(F.substring(stream, (i * 2) % 126 + 1, F.lit(2)), 16, 10).cast("int")

    def letter(first: str, count: int, i: Column) -> Column:
        letters = "".join(chr(ord(first) + k) for k in range(count))
        return F.substring(F.lit(letters), byte(i) % count + 1, F.lit(1))

    digit = lambda i: (byte(i) % 10).cast("string")
    # The first digit stays (country code, card network); the second isn't 0.
    digits = F.array_join(F.transform(F.split(value, ""), lambda c, i: F.when(i == 0, c).when(i == 1, (byte(i) % 9 + 1).cast("string")).otherwise(digit(i))), "")
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    check = (10 - _luhn(F.concat(body, F.lit("0")))) % 10
    card = F.when(_luhn(value) == 0, F.concat(body, check.cast("string"))).otherwise(digits)
    extra = F.greatest(attempt - F.lit(SAME_FORMAT - 1), F.lit(0))
    places = F.when(extra > 0, F.sequence(F.lit(1), extra)).otherwise(F.array().cast("array<int>"))
    more_digits = F.array_join(F.transform(places, lambda i: digit(i + 40)), "")
    more_letters = F.array_join(F.transform(places, lambda i: letter("a", 26, i + 40)), "")
    ip = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (byte(i) % 254 + 1).cast("string")), ".")
    # 2001:db8::/32 is kept for documentation.
    groups = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.substring(stream, i * 4 + 1, F.lit(4))), ":")
    ip = F.when(attempt < SAME_FORMAT, ip).otherwise(F.concat(F.lit("2001:db8:"), groups))

    # The country stays; letters and digits of the account keep their places.
    country = F.left(value, F.lit(2))
    drawn_account = F.transform(
        F.split(F.substr(value, F.lit(5)), ""), lambda c, i: F.when(c.rlike("[0-9]"), digit(i)).otherwise(letter("A", 26, i))
    )
    account = F.concat(F.array_join(drawn_account, ""), more_digits)
    iban = F.concat(country, _iban_check(country, account), account)
    hexes = F.transform(F.split(value, ""), lambda c, i: F.when(c == ":", c).when(i == 0, c).otherwise(F.substring(stream, i + 1, F.lit(1))))
    ipv6 = F.when(attempt < SAME_FORMAT, F.array_join(hexes, "")).otherwise(F.concat(F.lit("2001:db8:"), groups))

    def in_address(c: Column, i: Column) -> Column:
        return (
            F.when(c.rlike("[0-9]"), digit(i))
            .when(c.rlike(r"\p{IsCyrillic}"), letter("а", 32, i))
            .when(c.rlike(r"\p{IsGreek}"), letter("α", 17, i))
            .when(c.rlike(r"\p{L}"), letter("a", 26, i))
            .otherwise(c)
        )

    # The last label of an address stays.
    last = F.concat(F.lit("."), F.substring_index(value, ".", -1))
    front = F.substring(value, F.lit(1), F.length(value) - F.length(last))
    drawn = F.array_join(F.transform(F.split(front, ""), in_address), "")
    email = F.concat(F.replace(drawn, F.lit("@"), F.concat(more_letters, F.lit("@"))), last)

    def pick(values: tuple[str, ...], i: int) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), byte(F.lit(i)) % len(values))

    # Each further attempt may add a middle syllable, so the names never run out.
    out = F.when(kind == "email", email).when(kind == "ip", ip)
    out = out.when(kind == "iban", iban).when(kind == "ipv6", ipv6)
    out = out.when(kind == "card", F.when(attempt < SAME_FORMAT, card).otherwise(F.concat(digits, more_digits)))
    for script, (first, middle, last_one) in SYLLABLES.items():
        middles = F.array(*[F.lit(m) for m in middle])
        inner = F.array_join(F.transform(F.sequence(F.lit(0), attempt + 1), lambda i: F.get(middles, byte(i + 8) % F.size(middles))), "")
        made = F.concat(pick(first, 1), inner, pick(last_one, 2))
        out = out.when(kind.isin(f"family_{script}", f"family_m_{script}"), made)
        out = out.when(kind == f"family_f_{script}", F.concat(made, F.lit("а")))
        for gender in ("f", "m", "n"):
            listed = pick(GIVEN[f"{gender}_{script}"], 3)
            out = out.when(kind == f"given_{gender}_{script}", F.when(attempt < 3, listed).otherwise(F.concat(listed, F.lit("-"), made)))
    return out.otherwise(F.concat(digits, more_digits))


def resolve_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind, value, surrogate`` for distinct entities (``kind, value``): no two
    values of a kind have the same surrogate, and none has a real value."""
    pending = entities.withColumn("attempt", F.lit(0))
    taken = None
    while True:
        drawn = pending.withColumn("surrogate", _surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key))
        real = entities.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("is_real"))
        drawn = drawn.join(real, ["kind", "surrogate"], "left")
        if taken is not None:
            held = taken.select("kind", "surrogate", F.lit(True).alias("held"))
            drawn = drawn.join(held, ["kind", "surrogate"], "left")
        else:
            drawn = drawn.withColumn("held", F.lit(None).cast("boolean"))
        free = F.col("is_real").isNull() & F.col("held").isNull()
        drawn = write_once(drawn.select("kind", "value", "attempt", "surrogate", free.alias("free")), "pii-drawn")
        order = F.struct(F.xxhash64("value"), "value")
        first = drawn.filter("free").groupBy("kind", "surrogate").agg(F.min_by("value", order).alias("winner"))
        placed = drawn.join(first, ["kind", "surrogate"], "left").withColumn("wins", F.coalesce(F.col("free") & (F.col("value") == F.col("winner")), F.lit(False)))
        placed = write_once(placed, "pii-placed")
        won = placed.filter("wins").select("kind", "value", "surrogate")
        taken = won if taken is None else taken.union(won)
        pending = placed.filter("not wins").select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
        if pending.limit(1).count() == 0:
            return taken


def _as_written(match: Column, surrogate: Column, places: str = r"\d") -> Column:
    """The surrogate's digits in the places of the match's digits (or whatever
    ``places`` are), any others at the end."""
    chars = F.split(match, "")
    spread = F.aggregate(
        chars,
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda acc, c: F.when(
            c.rlike(places),
            F.struct(F.concat(acc["out"], F.substring(surrogate, acc["at"], F.lit(1))).alias("out"), (acc["at"] + 1).alias("at")),
        ).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["at"].alias("at"))),
        lambda acc: F.concat(acc["out"], F.substr(surrogate, acc["at"])),
    )
    return spread


def _same_case(match: Column, surrogate: Column) -> Column:
    letters = F.transform(F.split(surrogate, ""), lambda c, i: F.when(F.substring(match, i + 1, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c))
    return F.array_join(letters, "")


def _in_case(name: Column, surrogate: Column) -> Column:
    return F.when(_capitals(name), F.upper(surrogate)).otherwise(surrogate)


def _replacement(match: Column, surrogates: Column) -> Column:
    """A match with its surrogates, which come in the order of its entities."""
    kind = _kind(match)
    name = _name_parts(match)
    first = F.get(surrogates, F.lit(0))
    family = _in_case(name["family"], F.element_at(surrogates, -1))
    named = F.when(name["given"] != "", F.concat(_in_case(name["given"], first), F.lit(" "), family)).otherwise(family)
    return (
        F.when(kind == "name", F.concat(name["title"], F.lit(" "), named))
        .when(kind == "email", _same_case(match, first))
        .when(kind.isin("ip", "ipv6"), first)
        .when(kind == "iban", _as_written(match, first, "[A-Z0-9]"))
        .otherwise(_as_written(match, first))
    )


# A capitalised word, as a name may stand in a text without a title.
WORD_NAME = rf"(?<![\p{{L}}\p{{N}}]){_NAME}"


def _family_of(word: Column, known: Column) -> Column:
    """The surrogate of a word that is a known family name of its text, else null."""
    script, plain = _script(word), _plain_name(word)
    keys = [F.concat(_family_kind(script, F.lit(g)), F.lit("\x1f"), plain) for g in ("n", "f", "m")]
    return F.coalesce(*[F.try_element_at(known, k) for k in keys])


def replace_pii(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """``docs`` with ``text`` pseudonymised, and two more columns: ``n_pii``
    (matches) and ``pii_kinds`` (their kinds in text order; family names that
    stand without a title come last).

    Equal entities have equal surrogates in all documents of the call, and
    different ones different. ``key`` should be secret: who has it can test
    guesses.

    Defined cases: a null text stays null; a text without a match stays as it
    is; repeated rows are replaced alike; a null doc_id is a value like any
    other; columns pass through, and input columns named ``n_pii`` or
    ``pii_kinds`` are replaced; an empty table gives an empty result.
    """
    columns = [c for c in docs.columns if c not in ("n_pii", "pii_kinds")]
    docs = docs.select(*columns)
    text = F.coalesce(F.col("text"), F.lit(""))
    # The texts with a match are written with what was found: the pattern runs once for both later reads.
    found = docs.withColumn("__found", F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).filter(F.size("__found") > 0)
    same = F.concat_ws("\x1f", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text)
    found = write_once(found.withColumn("__row", F.sha2(same, 256)), "pii-found")
    clean = docs.filter(~text.rlike(ANY))
    each = found.select("__row", F.explode(F.flatten(F.transform("__found", _entities))).alias("e")).select("__row", "e.kind", "e.value").distinct()
    each = write_once(each, "pii-entities")
    known = resolve_surrogates(write_once(each.select("kind", "value").distinct(), "pii-distinct"), key)
    known = write_once(known, "pii-surrogates")
    pair = F.struct(F.concat_ws("\x1f", "kind", "value").alias("key"), F.col("surrogate").alias("value"))
    own = each.join(known, ["kind", "value"]).groupBy("__row").agg(F.map_from_entries(F.collect_list(pair)).alias("__map"))
    done = found.join(own, "__row")

    def new(match: Column) -> Column:
        drawn = F.transform(_entities(match), lambda e: F.element_at(F.col("__map"), F.concat_ws("\x1f", e["kind"], e["value"])))
        return _replacement(match, drawn)

    def untitled(cut: Column) -> Column:
        """A stretch between matches: its words and what they become (or null)."""
        words = F.regexp_extract_all(cut, F.lit(WORD_NAME), F.lit(0))
        become = F.transform(words, lambda w: F.struct(w.alias("was"), _in_case(w, _family_of(w, F.col("__map"))).alias("now")))
        return F.struct(F.split(cut, WORD_NAME, -1).alias("rest"), become.alias("words"))

    named = F.exists(F.map_keys("__map"), lambda k: k.startswith("family"))
    done = done.withColumns({"__new": F.transform("__found", new), "__cuts": F.split(text, ANY, -1), "__named": named})
    plain = F.transform("__cuts", lambda c: F.struct(F.array(c).alias("rest"), F.array().cast("array<struct<was:string,now:string>>").alias("words")))
    done = done.withColumn("__parts", F.when(F.col("__named"), F.transform("__cuts", untitled)).otherwise(plain))

    def woven(part: Column) -> Column:
        return F.array_join(F.zip_with(part["rest"], part["words"], lambda r, w: F.concat(r, F.coalesce(w["now"], w["was"], F.lit("")))), "")

    whole = F.zip_with(F.transform("__parts", woven), F.col("__new"), lambda cut, n: F.concat(cut, F.coalesce(n, F.lit(""))))
    more = F.flatten(F.transform("__parts", lambda p: F.filter(p["words"], lambda w: w["now"].isNotNull())))
    kinds = F.concat(F.transform("__found", _kind), F.transform(more, lambda w: F.lit("name")))
    done = done.withColumns({"__text": F.array_join(whole, ""), "pii_kinds": kinds})
    replaced = [F.col("__text").alias("text") if c == "text" else F.col(c) for c in columns]
    done = done.select(*replaced, F.size("pii_kinds").alias("n_pii"), "pii_kinds")
    return clean.withColumns({"n_pii": F.lit(0), "pii_kinds": F.array().cast("array<string>")}).unionByName(done)
