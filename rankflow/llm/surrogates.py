"""Personal data replaced by keyed surrogates, with DataFrame functions only.

A mention is found by one pattern and belongs to an entity: its kind and its normal form.
Each entity gets one surrogate of its kind (so all mentions of it stay coreferent), derived
from a secret key; before use, surrogates are checked against each other and against the
real values of the corpus, and an entity whose surrogate is taken draws again.  A mention
is rendered in its own format: separators, letter case and title stay.

A name is found after a title, in Latin, Cyrillic, Greek or Armenian letters; a name in another
script is left as it is, since a surrogate would change its script.  Its full form and its surname are then found without one in
the same text too.  A surname has one surrogate, which all full names with it end in, so that
"Mr John Smith", "Mr Smith", "John Smith" and "Smith" stay one person's names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.sources.workspace import Workspace

#: The key of the registered query; a real run passes its own secret.
KEY = "rotate-this-key"
#: From this draw on surrogates get longer, so that a crowded format runs out of collisions.
LENGTHEN_FROM = 8
#: No format is crowded at its greatest length; whoever gets here has a corpus of values that derive from the key.
MOST_DRAWS = 64

# Titles by gender, then first names and syllables of surnames by script.
_TITLES = {
    "m": ("Mr", "Mister", "Sir", "Lord", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Господин", "Κύριος", "Պարոն"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Sra", "Señorita", "Signora", "Lady", "Dame", "Госпожа", "Κυρία", "Տիկին", "Օրիորդ"),
    "n": ("Mx", "Dr", "Doctor", "Prof", "Professor", "Rev", "Reverend", "Доктор", "Профессор", "Δρ", "Դոկտոր"),
}
_FIRST_NAMES = {
    ("latin", "m"): ("Adam", "Boris", "Carl", "David", "Emil", "Frank", "Hugo", "Ivan", "Jonas", "Leon", "Oscar", "Paul"),
    ("latin", "f"): ("Anna", "Berta", "Clara", "Diana", "Emma", "Flora", "Greta", "Irene", "Julia", "Lena", "Olga", "Paula"),
    ("cyrillic", "m"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Олег"),
    ("cyrillic", "f"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Зоя", "Ирина", "Ольга"),
    ("greek", "m"): ("Αλέξης", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος"),
    ("greek", "f"): ("Άννα", "Βασιλική", "Δέσποινα", "Ελένη", "Κατερίνα", "Μαρία"),
    ("armenian", "m"): ("Արամ", "Դավիթ", "Հայկ", "Կարեն", "Տիգրան", "Վահե"),
    ("armenian", "f"): ("Անահիտ", "Աննա", "Լուսինե", "Մարիամ", "Նարե", "Սոնա"),
}
_SYLLABLES = {
    "latin": ("ba", "do", "fe", "gi", "ka", "lo", "me", "ni", "pa", "ro", "se", "ti", "va", "zo", "ru", "le"),
    "cyrillic": ("ба", "до", "фе", "ги", "ка", "ло", "ме", "ни", "па", "ро", "се", "ти", "ва", "зо", "ру", "ле"),
    "armenian": ("բա", "դո", "ֆե", "գի", "կա", "լո", "մե", "նի", "պա", "ռո", "սե", "տի", "վա", "զո", "ռա", "լե"),
    "greek": ("βα", "δο", "φε", "γι", "κα", "λο", "με", "νι", "πα", "ρο", "σε", "τι", "μα", "ζο", "ρυ", "λε"),
}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# A host name has at most 127 labels, of 63 letters each.
_EMAIL = r"[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]{1,63}+\.){1,126}\p{L}{2,63}(?![\p{L}\p{N}])"
_IP = rf"{_OCTET}(?:\.{_OCTET}){{3}}(?![\p{{L}}\p{{N}}]|\.\d)"
_PHONE = r"(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[.-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\p{L}\p{N}])"
_CARD = r"(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7})(?![\p{L}\p{N}])"
_SSN = r"\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}])"
# Quantifiers of secrets are open-ended and possessive: a long one is taken whole, without stack or retries.
_SK = r"sk-(?:(?=[A-Za-z_-]*+\d)|(?=[A-Za-z0-9]{20}))[0-9A-Za-z_-]{20,}+"
_SECRET = rf"(?:[0-9a-f]{{32,}}+|[0-9A-F]{{32,}}+|AKIA[0-9A-Z]{{16}}|{_SK})(?![\p{{L}}\p{{N}}])"
_LABEL = r"(?i:password|passwd|pwd|secret|token|api[_-]?key)\s{0,2}[=:]\s{0,2}[\"']?"
# A dot belongs to a secret where more of it follows, as in a JWT, and not at the end of a sentence.
_TOKEN = r"[A-Za-z0-9_/+=!@#$%^&*-]"
_LABELLED = rf"{_LABEL}(?=[^\s\"'\d]*+\d)(?={_TOKEN}(?:{_TOKEN}|\.(?=\.*+{_TOKEN})){{5}}){_TOKEN}++(?:\.++{_TOKEN}++)*+(?![\p{{L}}\p{{N}}])"
_TITLE = "|".join(sorted((t for own in _TITLES.values() for t in own), key=len, reverse=True))
_GAP = r"[ \u00a0]"
# A word of a name has a small letter, and may have inner capitals and apostrophes.  Names in scripts without
# surrogates of their own, or without capitals, are left alone: they would change script.
_CAPITAL = r"[\p{Lu}&&[\p{IsLatin}\p{IsCyrillic}\p{IsGreek}\p{IsArmenian}]]"
_WORD = rf"{_CAPITAL}(?=[\p{{Lu}}'’]*+\p{{Ll}})(?:[\p{{L}}\p{{M}}]++|['’](?=\p{{Lu}}))++"
# Small words inside names.
_PARTICLES = ("van", "von", "der", "den", "de", "del", "della", "di", "da", "dos", "das", "du", "la", "le", "el", "al", "bin", "ibn", "bint", "ten", "ter", "zu", "zur", "af", "av", "фон", "де")
_PARTICLE = rf"(?:{'|'.join(_PARTICLES)}){_GAP}"
_BARE = rf"(?:{_CAPITAL}\.{_GAP})*+(?:{_PARTICLE}){{0,3}}{_WORD}(?:(?:-|{_GAP}(?:{_CAPITAL}\.{_GAP})*+(?:{_PARTICLE}){{0,3}}){_WORD})*+(?![\p{{L}}\p{{M}}])"
_TITLED = rf"(?:(?:{_TITLE})\.?{_GAP}){{1,3}}"
_NAME = rf"{_TITLED}{_BARE}"
MENTION = rf"(?<![\p{{L}}\p{{N}}_])(?:{_LABELLED}|{_EMAIL}|{_IP}|{_PHONE}|{_CARD}|{_SSN}|{_SECRET}|{_NAME})"


_LEFT, _RIGHT = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{M}\p{N}_])"


def _gender(title: Column) -> Column:
    """f, m, or n where no title tells."""
    word = lambda sex: rf"{_LEFT}(?:{'|'.join(_TITLES[sex])}){_RIGHT}"
    return F.when(title.rlike(word("f")), "f").when(title.rlike(word("m")), "m").otherwise("n")


def _bare(mention: Column) -> Column:
    """A name without its titles, its words one space apart."""
    return F.regexp_replace(F.regexp_replace(mention, f"^{_TITLED}", ""), r"[\s\u00a0]+", " ")


def titled_names(text: Column) -> Column:
    """The (name, gender) pairs that have titles in the text."""
    own = F.transform(F.regexp_extract_all(text, F.lit(_LEFT + _NAME), F.lit(0)), lambda m: F.struct(_bare(m).alias("name"), _gender(F.regexp_extract(m, f"^{_TITLED}", 0)).alias("gender")))
    return F.array_distinct(own)


def pattern_of(names: Column) -> Column:
    """The pattern of the mentions of one text: those that show themselves, and its titled names and their surnames, longer ones first."""
    forms = F.array_distinct(F.flatten(F.transform(names, lambda x: F.array(x["name"], F.substring_index(x["name"], " ", -1)))))
    longest = F.transform(F.reverse(F.array_sort(F.transform(forms, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))), lambda x: x["x"])
    quoted = F.transform(longest, lambda x: F.concat(F.lit(r"\Q"), F.replace(x, F.lit(" "), F.lit(r"\E[\s\u00a0]+\Q")), F.lit(r"\E")))
    return F.when(F.size(names) == 0, MENTION).otherwise(F.concat(F.lit(f"{MENTION}|{_LEFT}(?:"), F.array_join(quoted, "|"), F.lit(f"){_RIGHT}")))


def kind_of(mention: Column) -> Column:
    """The kind of a mention, by its shape; a name without a space is a surname."""
    name = F.when(_bare(mention).contains(" "), "name").otherwise("surname")
    return (
        F.when(mention.rlike(f"^{_LABEL}"), "secret")
        .when(mention.contains("@"), "email")
        .when(mention.rlike(f"^(?:{_NAME})$"), name)
        .when(mention.rlike(f"^(?:{_IP})$"), "ip")
        .when(mention.rlike(f"^(?:{_SSN})$"), "ssn")
        .when(mention.rlike(f"^(?:{_PHONE})$"), "phone")
        .when(mention.rlike(f"^(?:{_CARD})$"), "card")
        .when(mention.rlike(f"^(?:{_SECRET})$"), "secret")
        .otherwise(name)
    )


def normal_of(mention: Column, kind: Column, names: Column) -> Column:
    """What makes two mentions the same entity: digits of numbers, lower case of addresses, gender and full name, surname.

    A mention whose title tells no gender takes that of the same name in its text.
    """
    name = _bare(mention)
    own = _gender(F.regexp_extract(mention, f"^{_TITLED}", 0))
    told = F.array_min(F.transform(F.filter(names, lambda x: x["name"] == name), lambda x: x["gender"]))
    return (
        F.when(kind == "email", F.lower(mention))
        .when(kind.isin("phone", "card", "ssn"), F.regexp_replace(mention, r"[^0-9+]", ""))
        .when(kind == "name", F.concat(F.when(own == "n", F.coalesce(told, own)).otherwise(own), F.lit(":"), name))
        .when(kind == "surname", name)
        .otherwise(F.regexp_replace(mention, f"^{_LABEL}", ""))
    )


def _nibble(digest: Column, i: Column) -> Column:
    """A number from 0 to 65535 out of the digest, another one for each i below 60."""
    return F.conv(F.substring(digest, F.pmod(i, F.lit(61)).cast("int") + 1, 4), 16, 10).cast("int")


def _chars(value: Column, digest: Column, alphabet: Column | None = None) -> Column:
    """Every letter and digit drawn anew within its own class; all else stays."""

    def drawn(c: Column, i: Column) -> Column:
        n = _nibble(digest, i)
        if alphabet is not None:
            return F.substring(alphabet, F.pmod(n, F.length(alphabet)) + 1, F.lit(1))
        return (
            F.when(c.rlike("[0-9]"), F.pmod(n, F.lit(10)).cast("string"))
            .when(c.rlike("[A-Z]"), F.char(F.pmod(n, F.lit(26)) + 65))
            .when(c.rlike(r"\p{IsCyrillic}"), F.substring(F.lit("абвгдежзиклмнопрстуфхцчшэюя"), F.pmod(n, F.lit(27)) + 1, F.lit(1)))
            .when(c.rlike(r"\p{IsGreek}"), F.substring(F.lit("αβγδεζηθικλμνξοπρστυφχψω"), F.pmod(n, F.lit(24)) + 1, F.lit(1)))
            .when(c.rlike(r"\p{L}"), F.char(F.pmod(n, F.lit(26)) + 97))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.filter(F.split(value, ""), lambda c: c != ""), drawn), "")


def _surname(script: str, digest: Column, syllables: Column) -> Column:
    parts = F.array(*map(F.lit, _SYLLABLES[script]))
    drawn = F.transform(F.sequence(F.lit(1), syllables), lambda i: F.element_at(parts, F.pmod(_nibble(digest, i * 5), F.lit(16)) + 1))
    return F.initcap(F.array_join(drawn, ""))


def surrogate_of(kind: Column, normal: Column, key: str, draw: Column) -> Column:
    """The surrogate in normal form that an entity gets at its n-th draw; a full name's has the real surname, whose own surrogate takes its place."""
    salt = F.sha2(F.concat(F.lit(key), F.lit("|"), kind), 256)
    digest = F.sha2(F.concat_ws("|", salt, draw.cast("string"), F.sha2(F.concat_ws("|", salt, normal), 256)), 256)
    longer = draw >= LENGTHEN_FROM
    # Every format gets longer with the draws, so that it cannot run out of values.
    more = F.substring(F.sha2(digest, 256), F.lit(1), F.greatest(F.lit(0), F.least(4 * (draw - (LENGTHEN_FROM - 1)), F.lit(64))))

    local, domain = F.substring_index(normal, "@", 1), F.substring_index(normal, "@", -1)
    host = F.regexp_replace(domain, r"\.[^.]*$", "")
    host = _chars(host, F.sha2(F.concat_ws("|", salt, host), 256))
    email = F.concat(_chars(local, digest), more, F.lit("@"), host, F.lit("."), F.substring_index(domain, ".", -1))

    octets = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (F.pmod(_nibble(digest, i * 7), F.lit(254)) + 1).cast("string"))
    digits = F.regexp_replace(normal, r"\+", "")
    head = F.when(kind == "phone", F.regexp_extract(normal, r"^\+(?:1|7|[2-69]\d|\d{1,2})", 0)).when(kind == "card", F.substring(normal, 1, 1)).otherwise("")
    number = F.concat(head, _chars(F.substring(normal, F.length(head) + 1, F.length(digits) + 1), digest))

    hexed = F.when(normal.rlike("^[0-9a-f]+$"), _chars(normal, digest, F.lit("0123456789abcdef"))).when(
        normal.rlike("^[0-9A-F]+$"), _chars(normal, digest, F.lit("0123456789ABCDEF"))
    )
    prefix = F.regexp_extract(normal, "^(AKIA|sk-)", 1)
    bare = F.coalesce(hexed, F.concat(prefix, _chars(F.substring(normal, F.length(prefix) + 1, F.length(normal)), digest)))
    secret = F.concat(bare, F.when(bare.rlike("^[0-9A-Z]+$"), F.upper(more)).otherwise(more))

    gender, name = F.substring(normal, 1, 1), F.when(kind == "surname", normal).otherwise(F.substring(normal, F.lit(3), F.length(normal)))
    last = F.substring_index(name, " ", -1)
    script = F.lit("latin")
    for other in ("Cyrillic", "Greek", "Armenian"):
        script = F.when(last.rlike(rf"^\p{{Is{other}}}"), other.lower()).otherwise(script)
    given, surname = F.lit(None).cast("string"), F.lit(None).cast("string")
    for alphabet in _SYLLABLES:
        sexes = {sex: _FIRST_NAMES[alphabet, sex] for sex in "mf"}
        for sex, firsts in (sexes | {"n": sexes["m"] + sexes["f"]}).items():
            first = F.element_at(F.array(*map(F.lit, firsts)), F.pmod(_nibble(digest, F.lit(0)), F.lit(len(firsts))) + 1)
            # Many full names share a surname, so given names get longer than the list.
            first = F.when(longer, F.concat(first, F.lit("-"), _surname(alphabet, digest, F.greatest(F.lit(4), draw - 4)))).otherwise(first)
            given = F.when((script == alphabet) & (gender == sex), first).otherwise(given)
        surname = F.when(script == alphabet, _surname(alphabet, digest, F.when(longer, F.greatest(F.lit(8), draw)).otherwise(5))).otherwise(surname)
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", F.concat_ws(".", octets))
        .when(kind.isin("phone", "card", "ssn"), F.concat(number, F.translate(more, "abcdef", "234567")))
        .when(kind == "name", F.concat(gender, F.lit(":"), given, F.lit(" "), F.substring_index(name, " ", -1)))
        .when(kind == "surname", surname)
        .otherwise(secret)
    )


def assign_surrogates(entities: DataFrame, key: str, work: Workspace) -> DataFrame:
    """``kind, normal, surrogate``: one per row of ``entities (kind, normal)``, all distinct within a kind.

    A draw is refused where the value is real in the corpus, or taken by an earlier draw or by
    an entity of lesser normal form in the same draw; those refused draw again.  Every
    round is a written table over the refused entities only.
    """
    known = entities.select("kind", F.col("normal").alias("surrogate"))
    pending, taken, draw = entities, None, 0
    while True:
        drawn = pending.select("kind", "normal", surrogate_of(F.col("kind"), F.col("normal"), key, F.lit(draw)).alias("surrogate"))
        free = drawn.join(known, ["kind", "surrogate"], "left_anti")
        if taken is not None:
            free = free.join(taken, ["kind", "surrogate"], "left_anti")
        won = work.keep(free.groupBy("kind", "surrogate").agg(F.min("normal").alias("normal")), f"surrogates-{draw}")
        taken = won if taken is None else taken.unionByName(won)
        pending = work.keep(pending.join(won, ["kind", "normal"], "left_anti"), f"refused-{draw}")
        draw += 1
        if pending.isEmpty():
            return taken.select("kind", "normal", "surrogate")
        if draw == MOST_DRAWS:
            raise RuntimeError(f"no free surrogate after {draw} draws; is the key public and the corpus its output?")


def rendered(mention: Column, kind: Column, surrogate: Column, surname: Column) -> Column:
    """The surrogate in the format of the mention that it replaces; ``surname`` is the surrogate of a full name's."""
    digits = F.regexp_replace(surrogate, r"[^0-9]", "")

    def digit(c: Column, i: Column) -> Column:
        rank = F.length(F.regexp_replace(F.substring(mention, F.lit(1), i + 1), r"[^0-9]", ""))
        return F.when(c.rlike("[0-9]"), F.substring(digits, rank, F.lit(1))).otherwise(c)

    laid = F.array_join(F.transform(F.filter(F.split(mention, ""), lambda c: c != ""), digit), "")
    rest = F.substring(digits, F.length(F.regexp_replace(mention, r"[^0-9]", "")) + 1, F.length(digits))
    title = F.regexp_extract(mention, f"^{_TITLED}", 0)
    label = F.regexp_extract(mention, f"^{_LABEL}", 0)
    return (
        F.when(kind.isin("phone", "card", "ssn"), F.concat(laid, rest))
        .when(kind == "name", F.concat(title, F.substring_index(F.substring(surrogate, F.lit(3), F.length(surrogate)), " ", 1), F.lit(" "), surname))
        .when(kind == "surname", F.concat(title, surrogate))
        .when((kind == "email") & (mention == F.upper(mention)), F.upper(surrogate))
        .when(kind == "secret", F.concat(label, surrogate))
        .otherwise(surrogate)
    )


def replace_entities(documents: DataFrame, key: str = KEY, work: Workspace | None = None) -> DataFrame:
    """``documents`` with every mention replaced, and ``n_entities``, the mentions replaced per row.

    Rows without mentions, null and empty texts among them, pass unchanged and are not
    shuffled.  Rows that share id and text, and so all mentions, are replaced alike.  Other columns
    pass unread; a column ``n_entities`` of the input is replaced.
    """
    work = work or Workspace(documents.sparkSession)
    has = F.coalesce(F.col("text").rlike(MENTION), F.lit(False))
    row_key = [F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h1"), F.hash("text", F.lit(1)).alias("_h2")]
    names = F.col("_names")
    named = documents.where(has).select(*row_key, "text", titled_names(F.col("text")).alias("_names"))
    found = named.select("_id", "_h1", "_h2", "_names", F.posexplode(F.regexp_extract_all("text", pattern_of(names), F.lit(0))).alias("_at", "_mention"))
    found = found.withColumn("kind", kind_of(F.col("_mention"))).withColumn("normal", normal_of(F.col("_mention"), F.col("kind"), names))
    last = F.when(F.col("kind") == "name", F.substring_index("normal", " ", -1))
    mentions = work.keep(found.withColumn("_last", last).drop("_names"), "mentions")
    own = mentions.select("kind", "normal")
    surnames = mentions.where("_last is not null").select(F.lit("surname").alias("kind"), F.col("_last").alias("normal"))
    chosen = work.keep(assign_surrogates(work.keep(own.union(surnames).distinct(), "entities"), key, work), "chosen")
    lasts = chosen.where("kind = 'surname'").select(F.col("normal").alias("_last"), F.col("surrogate").alias("_surname"))
    new = mentions.join(chosen, ["kind", "normal"]).join(lasts, "_last", "left")
    value = rendered(F.col("_mention"), F.col("kind"), F.col("surrogate"), F.col("_surname"))
    new = new.select("_id", "_h1", "_h2", F.struct("_at", value.alias("value")).alias("_new"))
    per_row = new.groupBy("_id", "_h1", "_h2").agg(F.array_sort(F.collect_set("_new")).alias("_new"))

    columns = [c for c in documents.columns if c != "n_entities"]
    old = F.col("_row.text")
    text = F.array_join(F.transform(F.split(old, pattern_of(names), -1), lambda part, i: F.concat(part, F.coalesce(F.get(F.col("_new"), i)["value"], F.lit("")))), "")
    held = documents.where(has).select(F.struct(*columns).alias("_row"), titled_names(F.col("text")).alias("_names"), *(c.alias(n) for c, n in zip(row_key, ("_k0", "_k1", "_k2"), strict=True)))
    same = F.col("_k0").eqNullSafe(F.col("_id")) & (F.col("_k1") == F.col("_h1")) & (F.col("_k2") == F.col("_h2"))
    changed = held.join(per_row, same).select(*((text if c == "text" else F.col("_row")[c]).alias(c) for c in columns), F.size("_new").alias("n_entities"))
    return documents.where(~has).select(*columns, F.lit(0).alias("n_entities")).union(changed)


def op9_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the table with its personal data replaced."""
    return replace_entities(spark.read.parquet(f"{folder}/documents.parquet")).select("doc_id", "text", "n_entities")
