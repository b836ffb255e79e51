"""Personal data replaced by surrogates (operator 9), in SQL functions only.

Detected entities -- mail addresses, phone, card, account (IBAN) and
social-security numbers, IP addresses of both kinds, access keys, private keys,
passwords and tokens, names after a title -- are replaced by values of the same
type, script and format, drawn from a keyed hash of the entity's canonical
form.  One entity written in several ways (case, punctuation) keeps one
surrogate, so references stay linked.  Names are linked by surname: ``Mr. John
Smith``, ``Mr. Smith``, ``Mr. Smith's`` and, in a text that has one of these, a
bare ``Smith`` get one surname; given names are drawn on their own.  The
surrogates of all entities are checked: where two entities share one, or a
surrogate is itself an entity of the corpus, all but the first of them draw
again, until every entity has its own.  Entities that are still left after
``MAX_ROUNDS`` (their format has fewer values than the corpus entities) become
a token in brackets, distinct by construction.

Only texts with entities are moved: they are cut into plain parts and
entities once, staged, and their entities joined with the surrogates.

Formats: digits stay digits and letters letters in their case; a card number
that passes the Luhn check gets one that does; an account number keeps its
country and has valid check digits; ``+<country code>`` and the
prefix of an access key stay; a surrogate social-security number starts with 9,
which is never issued; mail goes to ``<label>.example.<top level>``; a name
follows its title's gender and its own script.

Edge cases: a null text stays null, an empty one empty; repeated rows are
rewritten alike; texts without entities are returned as they are; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import Stage

MAX_ROUNDS = 50
#: after so many draws names and mail addresses grow by a syllable or letter
WIDEN = 3

# Titles that tell a gender, and given names that replace those behind them.
NEUTRAL_TITLES = ("Dr", "Prof")
MALE_TITLES = ("Mr", "Herr", "Señor", "Monsieur", "г-н")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Madame", "Mme", "г-жа")
GIVEN = {
    ("latin", "m"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Gavin", "Hugo", "Ivan", "Jonas", "Leo", "Oscar"),
    ("latin", "f"): ("Alma", "Bianca", "Clara", "Diana", "Elsa", "Flora", "Greta", "Helen", "Irene", "Julia", "Laura", "Nora"),
    ("latin", "n"): ("Alex", "Chris", "Dana", "Eden", "Jamie", "Kim", "Lee", "Robin", "Sam", "Sasha", "Toni", "Val"),
    ("cyrillic", "m"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Игорь", "Лев"),
    ("cyrillic", "f"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Лидия", "Нина"),
}
CYRILLIC = "абвгдежзиклмнопрстуфхцчшэюя"
SYLLABLES = {"latin": ("ba", "den", "fo", "gar", "hel", "kin", "lo", "mar", "ne", "por", "ras", "sel", "ta", "vin", "wes", "zo"),
             "cyrillic": ("ба", "ве", "го", "да", "ке", "ли", "мо", "на", "пе", "ро", "са", "те", "фа", "хо", "ча", "ши")}

# Country calling codes (codes of one and two digits; all others
# have three), and the prefixes of service keys.
COUNTRY_CODES = r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}"
KEY_PREFIXES = "ghp_|gho_|ghu_|ghs_|ghr_|glpat-|xoxb-|xoxp-|sk-"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_QUAD = rf"(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)"
_GROUP = rf"(?!{_QUAD})\d{{2,4}}"
_KINDS = {
    "secret": r"(?iu:password|passwd|pwd|secret|token|api[_\-]?key|пароль)[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
              r"[\p{L}0-9+/_\-]{8,}+",
    "private_key": r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[^\-]*+-----END [A-Z ]{0,20}PRIVATE KEY-----",
    "access_key": rf"(?:AKIA[0-9A-Z]{{16}}|(?:{KEY_PREFIXES})[A-Za-z0-9_]{{20,}}+)(?![A-Za-z0-9])",
    "email": r"[\p{L}0-9._%+\-]{1,64}+@(?:[\p{L}0-9\-]{1,63}\.){1,8}\p{L}{2,24}(?![\p{L}0-9])",
    "ip": _QUAD,
    "ipv6": r"(?=[0-9A-Fa-f:]*\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
            r"|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Fa-f:])",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    # groups of digits, none of which begins an address
    "phone": rf"(?:\+1[ .\-]?(?:\(\d{{3}}\)|\d{{3}})[ .\-]?\d{{3}}[ .\-]?\d{{4}}"
             rf"|\+(?:{COUNTRY_CODES})[ .\-]?(?:\(\d{{1,4}}\)[ .\-]?|\d[ .\-])?{_GROUP}(?:[ .\-]?{_GROUP}){{1,4}}"
             r"|\(\d{3}\) ?\d{3}[ .\-]\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4}|0\d{2,4} \d{3,4} \d{3,4})(?!\d)",
    "ssn": r"\d{3}-\d{2}-\d{4}(?!\d)",
    "card": rf"\d(?:\d|[ \-](?!{_QUAD})\d){{12,18}}(?!\d|\.\d)",
    "name": rf"(?:{'|'.join(MALE_TITLES + FEMALE_TITLES + NEUTRAL_TITLES)})\.? \p{{Lu}}[\p{{L}}'\-]{{1,40}}(?: \p{{Lu}}[\p{{L}}'\-]{{1,40}})?",
}
# at the start of a word only: inside a word one look back settles it; the key
# word of a secret may end a longer one (access_token, dbPassword)
PATTERN = _KINDS["secret"] + r"|(?<![\p{L}\d_.])(?:" + "|".join(p for k, p in _KINDS.items() if k != "secret") + ")"


def entities(text: Column) -> Column:
    """All entities of a text, from left to right."""
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def kind_of(raw: Column) -> Column:
    out = None
    for kind, pattern in _KINDS.items():
        test = raw.rlike(f"^(?:{pattern})$")
        out = F.when(test, kind) if out is None else out.when(test, kind)
    return out


def _digits(raw: Column) -> Column:
    return F.regexp_replace(raw, r"\D", "")


def _secret_head(raw: Column) -> Column:
    return F.regexp_extract(raw, r"^[A-Za-z_\-]+[\"']?\s{0,3}[=:]\s{0,3}[\"']?", 0)


def _title(raw: Column) -> Column:
    return F.regexp_extract(raw, r"^[^ ]+ ", 0)


def _country(raw: Column) -> Column:
    return F.regexp_extract(raw, rf"^\+({COUNTRY_CODES})", 1)


_POSSESSIVE = "(?:'s|')$"


def _full_name(raw: Column) -> Column:
    return F.regexp_replace(F.substring(raw, F.length(_title(raw)) + 1, F.length(raw)), _POSSESSIVE, "")


def _gender(raw: Column) -> Column:
    title = F.regexp_replace(_title(raw), r"\.? $", "")
    return F.when(title.isin(*MALE_TITLES), "m").when(title.isin(*NEUTRAL_TITLES), "n").otherwise("f")


def surname_of(raw: Column) -> Column:
    return F.element_at(F.split(_full_name(raw), " "), -1)


def given_of(raw: Column) -> Column:
    """The given name of a titled name, or an empty text."""
    parts = F.split(_full_name(raw), " ")
    return F.when(F.size(parts) > 1, F.get(parts, F.lit(0))).otherwise("")


def canonical(kind: Column, raw: Column) -> Column:
    """One text for all spellings of an entity (of a name: of its surname)."""
    d = _digits(raw)
    code = _country(raw)
    # numbers of the +1 plan are often written without it; other codes are part of the number
    phone = (F.when(code == "1", F.substring(d, 2, 20)).when(code != "", F.concat(
        code, F.lit(" "), F.substring(d, F.length(code) + 1, F.length(d))))
        .when((F.length(d) == 11) & d.startswith("1"), F.substring(d, 2, 20)).otherwise(d))
    return (F.when(kind.isin("email", "ipv6"), F.lower(raw)).when(kind == "phone", phone)
            .when(kind.isin("card", "ssn"), d).when(kind == "iban", F.replace(raw, F.lit(" "), F.lit("")))
            .when(kind == "secret", F.substring(raw, F.length(_secret_head(raw)) + 1, F.length(raw)))
            .when(kind == "name", F.lower(surname_of(raw))).otherwise(raw))


def _byte(digest: Column, i: Column | int) -> Column:
    """The i-th byte of a hex digest, from 0."""
    i = F.lit(i) if isinstance(i, int) else i
    return F.conv(F.substring(digest, i * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, value: Column) -> Column:
    return F.substring(F.lit(letters), F.pmod(value, F.lit(len(letters))) + 1, F.lit(1))


def _shaped(text: Column, digest: Column, digits: str = "0123456789", hexed: bool = False) -> Column:
    """Every digit and letter drawn anew, all else as it is."""
    chars = F.split(text, "")
    lower = "abcdef" if hexed else "abcdefghijklmnopqrstuvwxyz"

    def one(c: Column, i: Column) -> Column:
        b = _byte(digest, F.pmod(i, F.lit(250)))
        return (F.when(c.rlike("^[0-9]$"), _pick(digits, b)).when(c.rlike("^[a-z]$"), _pick(lower, b))
                .when(c.rlike("^[A-Z]$"), _pick(lower.upper(), b)).when(c.rlike(r"^[\x00-\x7F]$"), c)
                .when(c.rlike(r"^\p{IsCyrillic}$") & (c == F.lower(c)), _pick(CYRILLIC, b))
                .when(c.rlike(r"^\p{IsCyrillic}$"), F.upper(_pick(CYRILLIC, b)))
                .when(c.rlike(r"^\p{Ll}$"), _pick(lower, b)).when(c.rlike(r"^\p{Lu}$"), _pick(lower.upper(), b))
                .otherwise(c))

    return F.array_join(F.transform(chars, one), "")


def _luhn(digits: Column) -> Column:
    """The sum of the Luhn check, from the right."""
    def add(s: Column, x: Column) -> Column:
        return s + x

    def value(c: Column, i: Column) -> Column:
        v = c.cast("int")
        two = F.when(v > 4, v * 2 - 9).otherwise(v * 2)
        return F.when(F.pmod(i, F.lit(2)) == 1, two).otherwise(v)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), add)


def _wider(attempt: Column, digest: Column, at: int, parts: tuple[str, ...] | str) -> Column:
    """One more part for every ``WIDEN`` draws, so that no pool is exhausted."""
    each = F.array(*[F.lit(s) for s in parts])
    more = F.sequence(F.lit(1), F.floor(attempt / WIDEN).cast("int"))
    return F.when(attempt < WIDEN, "").otherwise(F.array_join(F.transform(
        more, lambda i: F.get(each, F.pmod(_byte(digest, i + at), F.lit(len(parts))))), ""))


def _syllables(script: str, digest: Column, at: int, n: int, attempt: Column) -> Column:
    names = F.array(*[F.lit(s) for s in SYLLABLES[script]])
    return F.initcap(F.concat(*[F.get(names, F.pmod(_byte(digest, at + i), F.lit(len(SYLLABLES[script]))))
                                for i in range(n)], _wider(attempt, digest, at + n, SYLLABLES[script])))


def _remainder(chars: Column) -> Column:
    """Remainder by 97 of a number whose letters stand for 10 to 35."""
    def add(r: Column, c: Column) -> Column:
        v = F.conv(c, 36, 10).cast("int")
        return F.pmod(F.when(v > 9, r * 100 + v).otherwise(r * 10 + v), F.lit(97))

    return F.aggregate(F.split(chars, ""), F.lit(0), add)


def _surname(canon: Column, digest: Column, attempt: Column) -> Column:
    """Four syllables of the name's script (five and more in later draws)."""
    return F.when(canon.rlike(r"\p{IsCyrillic}"), F.concat(
        _syllables("cyrillic", digest, 1, 4, attempt),
        F.when(canon.rlike("[ая]$"), "ова").otherwise("ов"))).otherwise(_syllables("latin", digest, 1, 4, attempt))


def _given(canon: Column, digest: Column, attempt: Column) -> Column:
    """``canon`` is gender, colon and given name; the lists are short, so later
    draws add syllables."""
    out = None
    for (script, gender), names in GIVEN.items():
        one = F.get(F.array(*[F.lit(g) for g in names]), F.pmod(_byte(digest, 0), F.lit(len(names))))
        cyrillic = canon.rlike(r"\p{IsCyrillic}")
        test = canon.startswith(f"{gender}:") & (cyrillic if script == "cyrillic" else ~cyrillic)
        value = F.concat(one, _wider(attempt, digest, 9, SYLLABLES[script]))
        out = F.when(test, value) if out is None else out.when(test, value)
    return F.coalesce(out, F.lit("Alex"))


def surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a canonical entity, in canonical form."""
    seed = F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), canon)
    digest = F.concat(*[F.sha2(F.concat(seed, F.lit(f"|{i}")), 512) for i in range(4)])
    local = F.regexp_extract(canon, "^[^@]*", 0)
    label = F.regexp_extract(canon, r"@([^.]*)", 1)
    tail = F.regexp_extract(canon, r"\.([^.]*)$", 1)
    # the address starts with a letter or digit of its own whatever its form
    email = F.concat(_shaped(local, digest), _wider(attempt, digest, 64, "abcdefghijklmnopqrstuvwxyz"), F.lit("@"),
                     _shaped(label, F.substring(digest, 257, F.lit(768))), F.lit(".example."), tail)
    ip = F.concat_ws(".", (F.pmod(_byte(digest, 0), F.lit(223)) + 1).cast("string"),
                     _byte(digest, 1).cast("string"), _byte(digest, 2).cast("string"),
                     (F.pmod(_byte(digest, 3), F.lit(254)) + 1).cast("string"))
    body = F.concat(F.substring(canon, F.lit(1), F.lit(1)), F.substring(_shaped(canon, digest), F.lit(2), F.length(canon)))
    stem = F.substring(body, F.lit(1), F.length(body) - 1)
    check = F.pmod(F.lit(10) - F.pmod(_luhn(F.concat(stem, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")
    card = F.when(F.pmod(_luhn(canon), F.lit(10)) == 0, F.concat(stem, check)).otherwise(body)
    ssn = F.concat(F.lit("9"), F.substring(_shaped(canon, digest), F.lit(2), F.lit(8)))
    prefix = F.regexp_extract(canon, f"^(?:AKIA|{KEY_PREFIXES})", 0)
    rest = F.substring(canon, F.length(prefix) + 1, F.length(canon))
    access = F.concat(prefix, F.when(prefix == "AKIA", _shaped(rest, digest, "234567")).otherwise(_shaped(rest, digest)))
    head, foot = (F.regexp_extract(canon, p, 0) for p in ("^-----BEGIN [A-Z ]*-----", "-----END [A-Z ]*-----$"))
    inner = F.substring(canon, F.length(head) + 1, F.length(canon) - F.length(head) - F.length(foot))
    pem = F.concat(head, _shaped(inner, digest), foot)
    account = _shaped(F.substring(canon, F.lit(5), F.length(canon)), digest)
    land = F.substring(canon, F.lit(1), F.lit(2))
    iban = F.concat(land, F.lpad((98 - _remainder(F.concat(account, land, F.lit("00")))).cast("string"), 2, "0"), account)
    code = F.regexp_extract(canon, r"^\d+ ", 0)
    phone = F.concat(code, _shaped(F.substring(canon, F.length(code) + 1, F.length(canon)), digest))
    secret = F.when(canon.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), _shaped(canon, digest, hexed=True)).otherwise(_shaped(canon, digest))
    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "ssn", ssn)
            .when(kind == "access_key", access).when(kind == "secret", secret).when(kind == "private_key", pem)
            .when(kind == "iban", iban).when(kind == "ipv6", _shaped(canon, digest, hexed=True))
            .when(kind == "phone", phone).when(kind == "name", _surname(canon, digest, attempt))
            .when(kind == "given", _given(canon, digest, attempt)).otherwise(_shaped(canon, digest)))


def rendered(kind: Column, raw: Column, value: Column, given: Column) -> Column:
    """A surrogate in the format of one spelling."""
    plain = F.regexp_replace(value, r"^\d+ (?=\d)", "")      # a phone's own number, without its country code
    spare = F.length(_digits(raw)) - F.length(plain)      # digits of a country code in front stay
    start = F.struct(F.lit("").alias("s"), (-spare).cast("int").alias("k"))

    def put(digits: Column, fits: str):
        def one(a: Column, c: Column) -> Column:
            hit = c.rlike(fits)
            shown = F.when(hit & (a["k"] >= 0), F.substring(digits, a["k"] + 1, F.lit(1))).otherwise(c)
            return F.struct(F.concat(a["s"], shown).alias("s"), (a["k"] + hit.cast("int")).alias("k"))

        return one

    number = F.aggregate(F.split(raw, ""), start, put(plain, "^[0-9]$"))["s"]
    spaced = F.aggregate(F.split(raw, ""), F.struct(F.lit("").alias("s"), F.lit(0).alias("k")),
                         put(value, "^[0-9A-Z]$"))["s"]
    name = F.concat(_title(raw), F.when(given_of(raw) != "", F.concat(given, F.lit(" "))).otherwise(""), value,
                    F.regexp_extract(raw, _POSSESSIVE, 0))
    return (F.when(kind == "name", name).when(value.startswith("["), value)
            .when(kind.isin("phone", "card", "ssn"), number).when(kind == "iban", spaced)
            .when(kind == "secret", F.concat(_secret_head(raw), value))
            .when(kind.isin("email", "ipv6") & (raw == F.upper(raw)), F.upper(value)).otherwise(value))


def distinct_surrogates(found: DataFrame, stage: Stage, key: str) -> DataFrame:
    """(kind, canon, value) of all distinct entities ``found(kind, canon)``,
    drawn again until no value belongs to two of them or is one of them."""
    table = stage.put(found.distinct().withColumn("attempt", F.lit(0)), "entities")
    # names are compared as they are written
    known = table.select("kind", F.when(F.col("kind") == "name", F.initcap("canon")).when(
        F.col("kind") == "given", F.initcap(F.substring("canon", 3, 99))).otherwise(F.col("canon")).alias("value"))
    for _ in range(MAX_ROUNDS):
        drawn = table.withColumn("value", surrogate(F.col("kind"), F.col("canon"), F.col("attempt"), key))
        drawn = stage.put(drawn, "drawn")
        shared = drawn.groupBy("kind", "value").agg(F.min("canon").alias("keeps"), F.count("*").alias("n")).where("n > 1")
        again = (drawn.join(shared, ["kind", "value"]).where("canon <> keeps").select("kind", "canon")
                 .union(drawn.join(known, ["kind", "value"], "left_semi").select("kind", "canon")).distinct())
        again = stage.put(again, "again")
        if again.isEmpty():
            return drawn.select("kind", "canon", "value")
        table = table.join(again.withColumn("more", F.lit(1)), ["kind", "canon"], "left").select(
            "kind", "canon", (F.col("attempt") + F.coalesce("more", F.lit(0))).alias("attempt"))
        table = stage.put(table, "entities")
    token = F.concat(F.lit("["), "kind", F.lit("-"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), "kind", "canon"),
                                                                         256), 1, 24), F.lit("]"))
    left = again.select(F.col("kind").alias("k"), F.col("canon").alias("c"))
    return drawn.join(left, (F.col("kind") == F.col("k")) & (F.col("canon") == F.col("c")), "left").select(
        "kind", "canon", F.when(F.col("k").isNotNull(), token).otherwise(F.col("value")).alias("value"))


def replace_entities(docs: DataFrame, stage: Stage, key: str) -> DataFrame:
    """doc_id, n_entities, entity_kinds and text with the entities replaced.
    Whoever knows ``key`` can find short entities again by trying: keep it.
    n_entities counts what the patterns find, bare surnames not included."""
    if not key:
        raise ValueError("surrogates need a secret key")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    holds = F.coalesce(F.col("text").rlike(PATTERN), F.lit(False))
    cut = rows.where(holds).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", entities(F.col("text")).alias("found"),
        F.split("text", PATTERN, -1).alias("plain"))
    cut = stage.put(cut, "cut")
    one = cut.select("row", F.posexplode("found").alias("at", "raw")).withColumn("kind", kind_of(F.col("raw")))
    one = one.withColumn("canon", canonical(F.col("kind"), F.col("raw"))).withColumn("given", F.when(
        (F.col("kind") == "name") & (given_of(F.col("raw")) != ""),
        F.concat(_gender(F.col("raw")), F.lit(":"), F.lower(given_of(F.col("raw"))))))
    one = stage.put(one, "found")
    asked = one.select("kind", "canon").union(
        one.where("given is not null").select(F.lit("given"), "given"))
    values = stage.put(distinct_surrogates(asked, stage, key), "values")
    firsts = values.where("kind = 'given'").select(F.col("canon").alias("given"), F.col("value").alias("first"))
    new = one.join(values, ["kind", "canon"]).join(firsts, "given", "left").select(
        "row", "at", "kind", rendered(F.col("kind"), F.col("raw"), F.col("value"), F.col("first")).alias("new"),
        F.when(F.col("kind") == "name", F.struct(surname_of(F.col("raw")).alias("old"), F.col("value").alias("new")))
        .alias("surname"))
    per = new.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "new"))).alias("new"),
                                 F.array_sort(F.collect_set("surname")).alias("surnames"),
                                 F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"))

    def bare(part: Column) -> Column:
        """A part between entities, the text's own surnames replaced."""
        return F.aggregate("surnames", part, lambda t, x: F.regexp_replace(
            t, F.concat(F.lit(r"(?<![\p{L}\d])"), x["old"], F.lit(r"(?![\p{L}\d])")), x["new"]))

    parts = F.transform("plain", bare)
    woven = F.array_join(F.zip_with(parts, F.col("new")["new"], lambda p, n: F.concat(p, F.coalesce(n, F.lit("")))), "")
    replaced = cut.join(per, "row").select("doc_id", F.size("found").cast("long").alias("n_entities"),
                                           F.col("kinds").alias("entity_kinds"), woven.alias("text"))
    clean = rows.where(~holds).select("doc_id", F.lit(0).cast("long").alias("n_entities"),
                                      F.lit("").alias("entity_kinds"), "text")
    return clean.union(replaced)
