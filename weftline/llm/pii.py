"""Personal data and surrogates for it, in DataFrame functions alone.

One pattern finds mail addresses, telephone numbers, payment cards, bank
accounts, addresses of machines, US social security numbers, secrets and titled
names; the words of a text's titled names are then found in it without a title
too. Each entity has a canonical form; given and family names are entities of
their own, so a family name has one surrogate whatever stands before it. A keyed
hash of the form and of an attempt gives a surrogate of the same type and shape,
so mentions of one entity get the same surrogate everywhere. Surrogates that
meet each other or a real entity are found by an aggregation over the distinct
entities, and move to their next attempt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import width, written

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_HEX = "[0-9A-Fa-f]{1,4}"
#: Titles that tell a name, with the gender that they tell: m, f, or n for neither.
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "n", "Prof": "n", "Herr": "m", "Frau": "f", "Mme": "f", "Monsieur": "m", "Madame": "f", "Señor": "m", "Señora": "f", "Г-н": "m", "Г-жа": "f"}
#: What given names end with, by gender and script.
ENDINGS = {
    ("m", "latin"): ["an", "us", "or", "on", "er", "ald", "mir", "ert"],
    ("f", "latin"): ["a", "ia", "ina", "elle", "ette", "ane", "issa", "ora"],
    ("n", "latin"): ["y", "is", "el", "ou", "en", "ay", "in", "ey"],
    ("m", "cyrillic"): ["ан", "ил", "ор", "им", "ей", "ан", "ир", "слав"],
    ("f", "cyrillic"): ["а", "ия", "ина", "ана", "ея", "ора", "ика", "елла"],
    ("n", "cyrillic"): ["и", "о", "ель", "ю", "ис", "ай", "ень", "эй"],
}
#: Syllables that names are made of, by script.
SYLLABLES = {
    "latin": ["ba", "ber", "co", "dan", "fel", "gar", "hol", "ka", "lin", "mar", "nor", "per", "ros", "sen", "tor", "win"],
    "cyrillic": ["ба", "вер", "го", "дан", "зем", "кор", "ла", "лин", "мар", "нор", "пет", "рос", "сен", "тов", "фел", "чер"],
}
_TITLE = "|".join(sorted(TITLES, key=len, reverse=True))
_WORD = r"\p{Lu}[\p{L}'-]*+"
#: Fixed: what some services' keys begin with.
_PREFIX = "AKIA|ASIA|ghp_|gho_|xoxb-|xoxp-|sk_live_|sk-"
#: What is looked for; the first alternative that matches at a place wins. No group repeats without a small bound, as Java takes each round of a group by recursion.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}][\p{L}\p{N}.-]*\.\p{L}{2,}",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "ip6": rf"(?<![\p{{L}}\p{{N}}:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{2,6}}(?::{_HEX}){{1,5}}|{_HEX}:(?::{_HEX}){{2,6}})(?![\p{{L}}\p{{N}}:])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){1,4}(?!\d)|(?<![\d)])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])",
    "card": r"(?<!\d)(?:\d{4}[ -]){3}\d{1,7}(?!\d)|(?<!\d)\d{13,19}(?!\d)",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "secret": rf"(?<![\p{{L}}\p{{N}}_-])(?:(?=[A-Za-z0-9_-]{{16}})(?<=(?i:token|secret|passwd|password|api_key|apikey|api-key)[\"']?\s{{0,3}}[=:]\s{{0,3}}[\"']?)[A-Za-z0-9_-]++|(?:{_PREFIX})[A-Za-z0-9_-]{{16,}}+)",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE})\.? (?!(?:{_TITLE})[. ]){_WORD}(?: {_WORD})?",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
_CARD = r"^(?:4\d{12}(?:\d{3}){0,2}|5[1-5]\d{14}|2[2-7]\d{14}|3[47]\d{13}|6(?:011|5\d\d|4[4-9]\d)\d{12})$"
_SHAPED = ("email", "ip6", "secret")
_DIGITS = ("card", "phone", "ssn")
#: A code point that is no character; it sets matches apart from what lies between them.
_MARK = "\ufdd0"


def _digits(e: Column) -> Column:
    return F.regexp_replace(e, r"[^0-9]", "")


def _luhn_sum(digits: Column) -> Column:
    """The weighted sum of a string of digits that a right check digit makes divisible by ten."""
    twice = lambda d: F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
    step = lambda acc, c: F.struct((acc["sum"] + F.when(acc["odd"], twice(c.cast("int"))).otherwise(c.cast("int"))).alias("sum"), (~acc["odd"]).alias("odd"))
    return F.aggregate(F.split(F.reverse(digits), ""), F.struct(F.lit(0).alias("sum"), F.lit(False).alias("odd")), step, lambda acc: acc["sum"])


def _mod97(account: Column) -> Column:
    """The remainder of an account's letters and digits, letters standing for 10 to 35; 1 if its check digits, moved to the end, are right."""
    value = lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(account, ""), F.lit(0), lambda acc, c: (acc * F.when(c.between("0", "9"), 10).otherwise(100) + value(c)) % 97)


def kind(e: Column) -> Column:
    """The type of a match, or null for what only looks like one: a domain with an empty label, a card or account with a wrong check."""
    digits, account = _digits(e), F.regexp_replace(e, " ", "")
    right = _mod97(F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))) == 1
    return (
        F.when(e.rlike(rf"^(?:{_TITLE})\.? \p{{Lu}}"), "name")
        .when(e.contains("@"), F.when(~e.contains("..") & ~e.contains("-.") & ~e.contains(".-"), "email"))
        .when(e.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"), "ip")
        .when(e.rlike(r"^[0-9A-Fa-f]{1,4}:[0-9A-Fa-f:]+$"), "ip6")
        .when(e.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(e.rlike(r"^(?:\+|\()") | e.rlike(r"^\d{3}[.-]\d{3}[.-]\d{4}$"), "phone")
        .when(e.rlike(r"^[\d -]+$"), F.when(digits.rlike(_CARD) & (_luhn_sum(digits) % 10 == 0), "card"))
        .when(e.rlike(r"^[A-Z]{2}\d{2}[A-Z0-9 ]+$") & right, "iban")
        .when(e.rlike(rf"^(?:{_PREFIX})") | ~e.contains(" ") & ~e.rlike(r"^[A-Z]{2}\d{2}[A-Z0-9]{8,31}$") | e.rlike(r"[a-z_-]"), "secret")
    )


def canonical(e: Column, k: Column) -> Column:
    """What mentions of one entity share: lower case for mail, machines and names, digits for numbers, no blanks in accounts."""
    return F.when(k.isin("email", "ip6", "given", "family"), F.lower(e)).when(k.isin(*_DIGITS), _digits(e)).when(k == "iban", F.regexp_replace(e, " ", "")).otherwise(e)


def _token(e: Column, k: Column | None = None, g: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(e.alias("e"), (none if k is None else k).alias("k"), (none if g is None else g).alias("g"))


def _name(e: Column) -> Column:
    """A titled name as its title, its given name if there is one, and its family name."""
    title = F.regexp_extract(e, rf"^(?:{_TITLE})\.? ", 0)
    words = F.split(F.substr(e, F.length(title) + 1), " ")
    bare = F.regexp_replace(title, r"\.? $", "")
    gender = F.when(bare.isin(*[t for t, g in TITLES.items() if g == "m"]), "m").when(bare.isin(*[t for t, g in TITLES.items() if g == "f"]), "f").otherwise("n")
    family = _token(F.element_at(words, -1), F.lit("family"))
    return F.when(F.size(words) > 1, F.array(_token(title), _token(F.get(words, F.lit(0)), F.lit("given"), gender), _token(F.lit(" ")), family)).otherwise(F.array(_token(title), family))


def _barrier(value: Column, make) -> Column:
    """``make`` of a value that is computed once, however often ``make`` uses it."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def _parted(text: Column, pattern: Column) -> Column:
    """The text cut at its matches: what lies between them at even places, the matches at odd ones."""
    mark = F.when(~text.contains(_MARK), _MARK).otherwise(F.concat(F.lit(_MARK), F.sha2(text, 256), F.lit(_MARK)))
    return F.split(F.regexp_replace(text, pattern, F.concat(mark, F.lit("$0"), mark)), mark, -1)


def _untitled(tokens: Column) -> Column:
    """Tokens with the words of the titled names among them, of three letters or more, also found where no title stands before them.

    A given name whose titles tell no gender takes that of its first mention
    with one in the text. A word that is both given and family is what it is first.
    """
    named = F.array_distinct(F.filter(tokens, lambda d: d["k"].isin("given", "family")))

    def over(pair: Column) -> Column:
        tokens, known = pair["tokens"], pair["known"]
        words = F.transform(F.array_sort(F.transform(F.filter(known, lambda d: F.length(d["e"]) > 2), lambda d: F.struct((-F.length(d["e"])).alias("n"), d["e"].alias("e")))), lambda d: d["e"])
        pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), F.array_join(F.array_distinct(words), "|"), F.lit(r")(?![\p{L}\p{N}])"))
        told = lambda e: F.get(F.filter(known, lambda x: (x["e"] == e) & (x["k"] == "given") & (x["g"] != "n")), F.lit(0))["g"]
        first = lambda e: F.get(F.filter(known, lambda x: x["e"] == e), F.lit(0))

        def cut(found: Column) -> Column:
            def again(d: Column) -> Column:
                parts = _parted(d["e"], found["pattern"])
                looked = F.transform(parts, lambda x, i: F.when(i % 2 == 1, _barrier(first(x), lambda f: _token(x, f["k"], F.when(f["k"] == "given", F.coalesce(told(x), f["g"]))))).otherwise(_token(x)))
                settled = _token(d["e"], d["k"], F.when(d["g"] == "n", F.coalesce(told(d["e"]), d["g"])).otherwise(d["g"]))
                return F.when(d["k"].isNotNull() | (F.size(found["words"]) == 0), F.array(settled)).otherwise(looked)

            return F.flatten(F.transform(tokens, again))

        return _barrier(F.struct(pattern.alias("pattern"), words.alias("words")), cut)

    return F.when(F.size(named) == 0, tokens).otherwise(_barrier(F.struct(tokens.alias("tokens"), named.alias("known")), over))


def tokens(text: Column) -> Column:
    """The whole text as an array of ``(e, k, g)``: entities with their type, and a gender for given names, and what lies between them, with a null type.

    A null text is an empty array. Texts without any sign of an entity are not searched.
    """
    signs = text.rlike("[0-9@]") | text.rlike("(?i)token|secret|passw|api[_-]?key") | text.contains("::")
    for word in (*(f"{t} " for t in TITLES), *(f"{t}. " for t in TITLES), *_PREFIX.split("|")):
        signs = signs | text.contains(word)
    typed = F.transform(_parted(text, F.lit(PATTERN)), lambda e, i: _token(e, F.when(i % 2 == 1, kind(e))))
    flat = F.flatten(F.transform(typed, lambda d: F.when(d["k"] == "name", _name(d["e"])).otherwise(F.array(d))))
    none = F.array().cast("array<struct<e:string,k:string,g:string>>")
    return F.when(text.isNull(), none).when(signs, _barrier(flat, _untitled)).otherwise(F.array(_token(text)))


def _hash(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *parts), 256)


def _number(h: Column, at, size: int = 4) -> Column:
    at = at if isinstance(at, Column) else F.lit(at)
    return F.conv(F.substr(h, at, F.lit(size)), 16, 10).cast("int")


def _pick(words: list[str], h: Column, at) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), _number(h, at, 3) % len(words) + 1)


def _characters(c: Column) -> Column:
    return F.split(c, "")


def _names(d: Column) -> Column:
    """A name of syllables, a given name with an ending of its gender; every fourth attempt has a syllable more, so the space grows with the entities."""
    given = d["k"] == "given"
    size = F.when(given, 2).otherwise(4) + F.floor(d["a"] / 4).cast("int")

    def made(script: str) -> Column:
        stem = F.array_join(F.transform(F.sequence(F.lit(1), size), lambda i: _pick(SYLLABLES[script], d["h"], i * 3 - 2)), "")
        ends = [F.when(d["g"] == g, _pick(ENDINGS[g, script], d["h"], 61)) for g in "mf"]
        return F.concat(stem, F.when(given, F.coalesce(*ends, _pick(ENDINGS["n", script], d["h"], 61))).otherwise(""))

    return F.when(d["c"].rlike(r"\p{IsCyrillic}"), made("cyrillic")).otherwise(made("latin"))


def surrogates(found: Column, key: str) -> Column:
    """``found``, an array of ``(e, k, c, g, a)``, with ``n``: the canonical form of each entity's surrogate at attempt ``a``; null where ``k`` is.

    Each step is a ``transform`` of the one before, so hashes are taken once for an entity and not once for each of its characters.
    """
    kept = ("e", "k", "c", "g", "a")
    carried = lambda d, *more: [d[f].alias(f) for f in (*kept, *more)]

    def hashed(d: Column) -> Column:
        h = F.when(d["k"].isNotNull(), _hash(key, d["k"], d["c"], F.coalesce(d["g"], F.lit("")), d["a"].cast("string")))
        domain = F.when(d["k"] == "email", _hash(key, F.lit("domain"), F.regexp_extract(d["c"], "@(.*)$", 1)))
        return F.struct(*carried(d), h.alias("h"), domain.alias("m"))

    def spread(d: Column) -> Column:
        more = F.when(d["k"].isin(*_SHAPED, *_DIGITS, "iban"), F.transform(_characters(F.concat(d["h"], F.sha2(d["h"], 256))), lambda c: F.conv(c, 16, 10).cast("int")))
        return F.struct(*carried(d, "h", "m"), more.alias("v"))

    def body(d: Column) -> Column:
        """Numbers, of a card without its check digit: what is kept, then two hash characters a digit. Else characters of the same class, with ``a`` to ``f`` where all letters are."""
        keep = F.when(d["k"] == "card", 2).when(d["k"] == "phone", F.greatest(F.lit(0), F.length(d["c"]) - 10)).otherwise(0)
        size = F.length(d["c"]) - keep - F.when(d["k"] == "card", 1).otherwise(0)
        pair = lambda i: F.get(d["v"], (i * 2) % 128) * 16 + F.get(d["v"], (i * 2 + 1) % 128)
        made = F.array_join(F.transform(F.sequence(F.lit(1), size), lambda i: (pair(i) % 10).cast("string")), "")
        number = F.when(d["k"].isin(*_DIGITS), F.concat(F.substr(d["c"], F.lit(1), keep), made))
        lead = F.when(d["k"] == "iban", F.substr(d["c"], F.lit(1), F.lit(2))).when(d["k"] == "secret", F.regexp_extract(d["c"], rf"^(?:{_PREFIX})", 0)).otherwise("")
        rest = F.when(d["k"] == "email", F.regexp_extract(d["c"], "^([^@]*)@", 1)).when(d["k"] == "iban", F.substr(d["c"], F.lit(5))).otherwise(F.substr(d["c"], F.length(lead) + 1))
        hexadecimal = rest.rlike("^[0-9a-fA-F:]*$")
        letter = lambda i: F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), pair(i) % F.when(hexadecimal, 6).otherwise(26) + 1, F.lit(1))
        other = lambda c, i: F.when(c.rlike(r"\p{IsCyrillic}"), F.substr(F.lit("абвгдежзиклмнопр"), pair(i) % 16 + 1, F.lit(1))).when(c.rlike(r"\p{L}"), letter(i)).otherwise(c)
        one = lambda c, i: F.when(c.between("0", "9"), (pair(i) % 10).cast("string")).when(c.between("a", "z"), letter(i)).when(c.between("A", "Z"), F.upper(letter(i))).otherwise(other(c, i))
        shaped = F.when(d["k"].isin(*_SHAPED, "iban"), F.array_join(F.transform(_characters(rest), one), ""))
        # What a short form leaves too little room for grows after some attempts.
        more = F.when((d["k"] == "email") & (d["a"] > 3), F.substr(F.translate(d["h"], "0123456789", "ghijklmnop"), F.lit(1), F.least(d["a"] - 3, F.lit(12)))).otherwise("")
        return F.struct(*carried(d, "h", "m"), F.coalesce(number, F.concat(shaped, more)).alias("b"), lead.alias("lead"))

    def last(d: Column) -> Column:
        top = F.regexp_extract(d["c"], r"\.(com|net|org)$", 1)
        mail = F.concat(d["b"], F.lit("@m"), F.substring(d["m"], 1, 10), F.lit(".example."), F.when(top != "", top).otherwise("org"))
        address = F.concat_ws(".", (_number(d["h"], 1) % 223 + 1).cast("string"), *[(_number(d["h"], 5 + 4 * i) % 254 + 1).cast("string") for i in range(3)])
        card = F.concat(d["b"], ((10 - _luhn_sum(F.concat(d["b"], F.lit("0"))) % 10) % 10).cast("string"))
        account = F.concat(d["lead"], F.lpad((98 - _mod97(F.concat(d["b"], d["lead"], F.lit("00")))).cast("string"), 2, "0"), d["b"])
        new = F.when(d["k"] == "email", mail).when(d["k"] == "ip", address).when(d["k"] == "card", card).when(d["k"].isin("ssn", "phone"), d["b"])
        new = new.when(d["k"].isin("given", "family"), _names(d)).when(d["k"].isin("secret", "ip6"), F.concat(d["lead"], d["b"])).when(d["k"] == "iban", account)
        return F.struct(*carried(d), new.alias("n"))

    return F.transform(F.transform(F.transform(F.transform(found, hashed), spread), body), last)


def _as_mentioned(d: Column) -> Column:
    """The surrogate in the format of the mention: its digits or characters in place, its case."""
    e, k, n = d["e"], d["k"], d["n"]
    step = lambda acc, c: F.when(
        acc["all"] & (c != " ") | c.between("0", "9"), F.struct(F.concat(acc["out"], F.substr(n, acc["at"], F.lit(1))).alias("out"), (acc["at"] + 1).alias("at"), acc["all"].alias("all"))
    ).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["at"].alias("at"), acc["all"].alias("all")))
    placed = F.aggregate(_characters(e), F.struct(F.lit("").alias("out"), F.lit(1).alias("at"), (k == "iban").alias("all")), step, lambda acc: acc["out"])
    raised = F.array_join(F.transform(_characters(n), lambda c, i: F.when(F.substr(e, i + 1, F.lit(1)).rlike(r"\p{Lu}") & (i < F.length(F.regexp_extract(e, "^[^@]*", 0))), F.upper(c)).otherwise(c)), "")
    upper = (e == F.upper(e)) & (e != F.lower(e)) & (F.length(e) > 1)
    cased = F.when(upper, F.upper(n)).when(e == F.lower(e), n).when(k.isin("given", "family"), F.initcap(n)).otherwise(raised)
    return F.when(k.isNull(), e).when(k.isin(*_DIGITS, "iban"), placed).when(k.isin("email", "ip6", "given", "family"), cased).otherwise(n)


def attempts(entities: DataFrame, key: str, rounds: int = 64) -> DataFrame:
    """``(k, c, g, attempt)`` of the distinct entities ``(k, c, g)`` whose first surrogates collide.

    Of entities with the same surrogate the first by canonical form, then by
    gender, keeps it; one that meets a real entity's form gives way in any case.
    Each round tries those again against all surrogates that stand.
    """
    one = F.array(F.struct(F.lit(None).cast("string").alias("e"), "k", "c", "g", F.col("attempt").alias("a")))
    fresh = lambda df: df.withColumn("s", F.get(surrogates(one, key), F.lit(0))["n"])
    real = written(entities.select("k", "c", F.coalesce("g", F.lit("")).alias("g")).distinct(), "entities")
    # Few rows of heavy work: dealt out evenly, whatever their size in bytes.
    now = written(fresh(real.repartition(width(real.sparkSession)).withColumn("attempt", F.lit(0))), "surrogates")
    for _ in range(rounds):
        owners = now.groupBy("k", "s").agg(F.min(F.struct("attempt", "c", "g")).alias("first"))
        taken = now.join(owners, ["k", "s"]).filter((F.col("c") != F.col("first.c")) | (F.col("g") != F.col("first.g"))).select("k", "c", "g")
        met = now.join(real.select("k", F.col("c").alias("s")).distinct(), ["k", "s"], "left_semi").select("k", "c", "g")
        clash = written(taken.unionByName(met).distinct(), "clashes")
        if clash.isEmpty():
            return now.filter("attempt > 0").select("k", "c", "g", "attempt")
        again = fresh(now.join(clash, ["k", "c", "g"], "left_semi").drop("s").withColumn("attempt", F.col("attempt") + 1))
        now = written(now.join(clash, ["k", "c", "g"], "left_anti").unionByName(again), "surrogates")
    raise RuntimeError(f"surrogates still collide after {rounds} rounds: their space is too small for the entities")


def _described(found: Column) -> Column:
    """Tokens as an array of ``(e, k, c, g)``; ``c`` is null where ``k`` is."""
    return F.transform(found, lambda d: F.struct(d["e"].alias("e"), d["k"].alias("k"), F.when(d["k"].isNotNull(), canonical(d["e"], d["k"])).alias("c"), F.coalesce(d["g"], F.lit("")).alias("g")))


def replace(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` with surrogates in ``text``, and ``entities``, an array of (kind, surrogate) in order.

    Null and empty texts stay as they are, with no entities; so does an empty
    table. Ids do not matter and may be null or repeat. A column ``entities``
    that exists is replaced. Equal texts get equal surrogates. Names are found
    by their titles, and then by their words in the same text; a given name is
    one entity for each gender that its titles tell.
    """
    kept = [c for c in docs.columns if c != "entities"]
    text = F.col(text_col)
    found = docs.select(*kept).withColumn("__wl_found", _described(tokens(text)))
    typed = lambda column: F.filter(column, lambda d: d["k"].isNotNull())
    seen = docs.select(F.explode(typed(_described(tokens(text)))).alias("d")).select("d.k", "d.c", "d.g").distinct()
    moved = attempts(seen, key)
    if moved.isEmpty():
        found = found.withColumn("__wl_moved", F.lit(None).cast("map<string,int>"))
    else:
        # Only texts that hold a moved entity have a row here; a text is named by two hashes of it.
        name = [F.xxhash64(text_col).alias("__wl_a"), F.crc32(F.col(text_col).cast("binary")).alias("__wl_b")]
        held = found.select(*name, F.explode(typed(F.col("__wl_found"))).alias("d")).select("__wl_a", "__wl_b", F.col("d.k").alias("k"), F.col("d.c").alias("c"), F.col("d.g").alias("g")).distinct()
        maps = held.join(moved, ["k", "c", "g"]).groupBy("__wl_a", "__wl_b").agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "k", "g", "c"), "attempt"))).alias("__wl_moved"))
        found = found.select("*", *name).join(maps, ["__wl_a", "__wl_b"], "left").drop("__wl_a", "__wl_b")

    attempt = lambda d: F.when(F.col("__wl_moved").isNull() | d["k"].isNull(), 0).otherwise(F.coalesce(F.element_at(F.col("__wl_moved"), F.concat_ws("|", d["k"], d["g"], d["c"])), F.lit(0)))
    tried = F.transform("__wl_found", lambda d: F.struct(d["e"].alias("e"), d["k"].alias("k"), d["c"].alias("c"), d["g"].alias("g"), attempt(d).alias("a")))
    named = F.transform(surrogates(tried, key), lambda d: F.struct(d["k"].alias("kind"), _as_mentioned(d).alias("surrogate")))
    plain = F.transform("__wl_found", lambda d: F.struct(d["k"].alias("kind"), d["e"].alias("surrogate")))
    made = found.withColumn("__wl_new", F.when(F.exists("__wl_found", lambda d: d["k"].isNotNull()), named).otherwise(plain))
    out = made.withColumn(text_col, F.when(text.isNotNull(), F.array_join(F.transform("__wl_new", lambda x: x["surrogate"]), "")))
    return out.select(*kept, F.filter("__wl_new", lambda x: x["kind"].isNotNull()).alias("entities"))


def digest(docs: DataFrame, key: str = "weftline") -> DataFrame:
    """``doc_id, n_entities, text`` for each row of ``docs``, the text with surrogates."""
    return replace(docs.select("doc_id", "text"), key).select("doc_id", F.size("entities").cast("long").alias("n_entities"), "text")
