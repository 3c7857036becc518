"""Surrogates for personal data: keyed, type-consistent and collision-checked.

Entities (mail addresses, phone, card, account and social security numbers, IP addresses, secrets,
names behind a form of address) are found by one pattern. Equal entities, in whatever
case or punctuation, share one canonical form, and so one surrogate wherever they occur.
A surrogate is drawn from a keyed digest of the canonical form and keeps type and
format: digits stay digits, letters letters of their script and case, punctuation
stays; a card number is valid by its check digit if the original was; an IPv4 address
keeps the widths of its octets, an IPv6 address becomes one of 2001:db8::/32; a name keeps gender (by the form of address) and script;
mail goes to example.com.

Collision checks keep different entities different: canonical forms whose surrogates meet, or that would
get a form which itself occurs in the corpus, are drawn again, all but the smallest of
each meeting, until none is left. After ``STRICT`` rounds a format widens (a narrow
one may have fewer values than the corpus has entities): octets take any width, all else
gets more characters, in each round two more.

DataFrame functions only. The entities of a document are few; entities, not documents, are shuffled by
their canonical form, distinct ones first; the join of a frequent entity with its one
surrogate is split by AQE. Documents without entities are not moved.

A null text stays null and an empty one empty, without entities. Ids may repeat or be null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repolens.session import cut_lineage

KEY = "surrogates-1"
STRICT = 8
ROUNDS = 40

# Forms of address by gender, and names by gender and script.
MALE = ["Mr", "Sir", "Herr", "Señor", "Sr", "Monsieur", "M", "г-н", "господин", "κύριος", "κ", "السيد", "מר"]
FEMALE = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Señora", "Señorita", "Sra", "Madame", "Mme", "Mlle", "г-жа", "госпожа", "κυρία", "κα", "السيدة", "الآنسة", "גברת"]
NEUTRAL = ["Dr", "Prof", "Mx", "الدكتور", "الدكتورة"]
FIRST = {
    ("latin", "male"): "Adam Alan Bruno Carl Daniel Emil Felix Georg Henry Ivan Jonas Karl Leon Martin Nils Oscar Paul Robert Simon Thomas".split(),
    ("latin", "female"): "Alice Anna Berta Clara Diana Emma Frida Greta Helen Irene Julia Karla Laura Maria Nora Olga Paula Rosa Sarah Tina".split(),
    ("cyrillic", "male"): "Алексей Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Олег Павел Роман Семён Фёдор".split(),
    ("cyrillic", "female"): "Алла Анна Вера Галина Дарья Елена Жанна Зоя Ирина Лидия Мария Нина Ольга Раиса Софья Юлия".split(),
    ("greek", "male"): "Ανδρέας Γιώργος Δημήτρης Ηλίας Θωμάς Ιάσων Κώστας Λουκάς Μάρκος Νίκος Πέτρος Στέφανος".split(),
    ("greek", "female"): "Άννα Βασιλική Δάφνη Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Νίκη Ουρανία Σοφία Χριστίνα".split(),
    ("hebrew", "male"): "אברהם בנימין גדעון דוד יוסף יעקב משה נתן עמוס שמעון".split(),
    ("hebrew", "female"): "אסתר דבורה חנה יעל לאה מרים נעמי רבקה רחל תמר".split(),
    ("arabic", "male"): "أحمد حسن خالد سالم طارق عمر كريم محمود ناصر يوسف".split(),
    ("arabic", "female"): "أمينة خديجة زينب سلمى عائشة فاطمة ليلى مريم نادية هدى".split(),
    ("han", "male"): "王伟 李强 张军 刘勇 陈杰 杨涛 赵明 黄磊 周鹏 吴刚".split(),
    ("han", "female"): "王芳 李娜 张敏 刘静 陈丽 杨艳 赵娟 黄霞 周玲 吴燕".split(),
}
#: Letters of which a surrogate's letters are drawn, by script.
LETTERS = {
    "latin": "abcdefghijklmnopqrstuvwxyz",
    "accented": "àáâäçèéêëìíîïñòóôöùúûü",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
    "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "hebrew": "אבגדהוזחטיכלמנסעפצקרשת",
    "arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    "han": "一二三四五六七八九十人口日月山水火木金土大小中上下左右",
}
_SCRIPT = [("latin", r"^[a-z]$"), ("accented", r"^\p{IsLatin}$"), ("greek", r"^\p{IsGreek}$"), ("cyrillic", r"^\p{IsCyrillic}$"), ("hebrew", r"^\p{IsHebrew}$"), ("arabic", r"^\p{IsArabic}$"), ("han", r"^\p{IsHan}$")]

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_LOCAL = r"[\p{L}\p{N}._%+\-]"
_GROUP = "[0-9A-Fa-f]{1,4}"
_TITLE = "|".join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True))
_TITLED = rf"(?:{_TITLE})(?:\.? |\.)"
# Words of a name: O'Neil, McDonald, SMITH; initials; particles; words of scripts without case.
_WORD = r"(?:\p{Lu}['’](?=\p{L}{3})\p{L}|\p{Lu})[\p{L}\p{M}]++(?:['’]\p{Lu}[\p{L}\p{M}]++)*+"
_BEFORE = r"(?:\p{Lu}\.[ \-]?|\p{Lu} |(?:van|von|der|den|de|del|della|di|da|dos|du|la|le|el|al|bin|ibn|ben|zu|zur|ter|y)[ \-]|d['’])"
_EAST = r"\p{IsHan}\p{IsHangul}\p{IsHiragana}\p{IsKatakana}"
_UNCASED = rf"[{_EAST}]{{1,4}}+|(?![{_EAST}])\p{{Lo}}[\p{{Lo}}\p{{M}}]++(?:[ \-]\p{{Lo}}[\p{{Lo}}\p{{M}}]++)?"
PATTERNS = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++@[\p{{L}}\p{{N}}\-]++(?:\.[\p{{L}}\p{{N}}\-]++)+",
    "secret": r"(?<![A-Za-z0-9])(?:[A-Fa-f0-9]{32,}+|AKIA[A-Z0-9]{16}|gh[opusr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}+)(?![A-Za-z0-9])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ip6": rf"(?<![\p{{L}}\p{{N}}:.])(?:(?:{_GROUP}:){{7}}{_GROUP}|(?=[A-Fa-f:]*[0-9])(?:{_GROUP}(?::{_GROUP}){{0,6}})?::(?:{_GROUP}(?::{_GROUP}){{0,6}})?)(?![\p{{L}}\p{{N}}:])(?!\.[0-9])",
    "ip": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[0-9])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "phone": r"(?<![\p{L}\p{N}])(?:\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)[ .\-]?)?[0-9]{2,4}(?:[ .\-]?[0-9]{2,4}){1,4}|\([0-9]{3}\)[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}|[0-9]{3}[ .\-][0-9]{3}[ .\-][0-9]{4})(?![\p{L}\p{N}])",
    "card": r"(?<![\p{L}\p{N}.\-])(?:[0-9]{4}(?:[ \-]?[0-9]{4}){2}[ \-]?[0-9]{1,7}|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{4,5})(?![\p{L}\p{N}\-])",
    "name": rf"(?<!\p{{L}}){_TITLED}(?:{_BEFORE}{{0,4}}{_WORD}(?:[ \-]{_BEFORE}{{0,4}}{_WORD})*+|{_UNCASED})",
}
PATTERN = "|".join(PATTERNS.values())


def entities(text: Column) -> Column:
    """All entities of a text, in its order."""
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def kind(e: Column) -> Column:
    """The type of an entity: the first pattern that takes the whole of it."""
    out = F.when(F.contains(e, F.lit("@")), F.lit("email"))
    for name, pattern in PATTERNS.items():
        if name != "email":
            out = out.when(e.rlike(f"^(?:{pattern})$"), F.lit(name))
    return out.otherwise(F.lit("secret"))


def canonical(e: Column, k: Column) -> Column:
    """What all forms of one entity share."""
    bare = F.lower(F.regexp_replace(e, r"[^\p{L}\p{N}]", ""))
    # Of a name the title, and the words without punctuation; of an IPv6 address all eight groups.
    words = F.regexp_replace(F.regexp_extract(e, rf"^{_TITLED}(.*)$", 1), "['’]", "")
    name = F.lower(F.concat_ws(" ", F.regexp_extract(e, f"^({_TITLE})", 1), F.trim(F.regexp_replace(words, r"[.\s\-]+", " "))))
    groups = lambda part: F.filter(F.split(part, ":"), lambda x: x != "")
    left, right = groups(F.substring_index(F.lower(e), "::", 1)), F.when(F.contains(e, F.lit("::")), groups(F.substring_index(F.lower(e), "::", -1))).otherwise(F.array().cast("array<string>"))
    all_ = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(F.lit(0), F.lit(8) - F.size(left) - F.size(right))), right)
    ip6 = F.array_join(F.transform(all_, lambda g: F.regexp_replace(g, "^0+(?=.)", "")), ":")
    return F.when(k == "email", F.lower(e)).when(k == "name", name).when(k == "ip6", ip6).when(k.isin("ip", "secret"), e).otherwise(bare)


def _stream(key: str, k: Column, c: Column, attempt: Column, n: Column) -> Column:
    """n keyed pseudo-random numbers from 0 to 65535."""
    block = lambda i: F.sha2(F.concat_ws("\x1f", F.lit(key), k, c, attempt.cast("string"), i.cast("string")).cast("binary"), 512)
    hexes = F.concat_ws("", F.transform(F.sequence(F.lit(0), F.floor(n / 32).cast("int")), block))
    return F.transform(F.sequence(F.lit(0), n), lambda i: F.conv(F.substring(hexes, i * 4 + 1, F.lit(4)), 16, 10).cast("int"))


def _pick(values: str | list[str], r: Column) -> Column:
    items = F.array(*[F.lit(v) for v in values])
    return F.element_at(items, (r % F.lit(len(values)) + 1).cast("int"))


def _drawn(c: Column, r: Column, hexadecimal: Column) -> Column:
    """A character of the class of ``c`` (lower case): digit, or letter of its script."""
    out = F.when(c.rlike("^[0-9]$"), (r % 10).cast("string")).when(hexadecimal & c.rlike("^[a-f]$"), _pick("abcdef", r))
    for script, pattern in _SCRIPT:
        out = out.when(c.rlike(pattern), _pick(LETTERS[script], r))
    return out.when(c.rlike(r"^\p{N}$"), (r % 10).cast("string")).otherwise(_pick(LETTERS["latin"], r))


def _luhn(digits: Column) -> Column:
    """The check digit that a row of digits needs."""
    n = F.size(digits)
    weigh = lambda d, i: F.when((n - i) % 2 == 1, F.when(d.cast("int") * 2 > 9, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)).otherwise(d.cast("int"))
    total = F.aggregate(F.transform(digits, weigh), F.lit(0), lambda s, x: s + x)
    return (F.lit(10) - total % 10) % 10


def drawn(df: DataFrame, key: str) -> DataFrame:
    """``df`` (kind, canon, attempt) with ``body``: the letters and digits of the surrogate, or its name."""
    chars = F.split(F.lower(F.regexp_replace("canon", r"[^\p{L}\p{N}]", "")), "")
    df = df.withColumn("chars", F.filter(chars, lambda x: x != "")).withColumn("r", _stream(key, F.col("kind"), F.col("canon"), F.col("attempt"), F.size("chars")))
    hexadecimal = (F.col("kind") == "secret") & F.col("canon").rlike("^[A-Fa-f0-9]+$")
    plain = F.zip_with("chars", F.slice("r", F.lit(1), F.size("chars")), lambda c, r: _drawn(c, r, hexadecimal))
    df = df.withColumn("plain", plain)
    wide = F.col("attempt") >= STRICT
    octet = lambda o, i: (
        F.when(wide, F.get("r", i) % 254 + 1).when(F.length(o) == 1, F.get("r", i) % 9 + 1).when(F.length(o) == 2, F.get("r", i) % 90 + 10).otherwise(F.get("r", i) % 156 + 100).cast("string")
    )
    ip = F.array_join(F.transform(F.split("canon", r"\."), octet), ".")
    # A number does not begin with 0, a card keeps its first digit and its validity.
    head = F.when(F.col("kind") == "card", F.get("chars", F.lit(0))).when(F.col("kind") == "iban", F.array_join(F.slice("chars", 1, 2), "")).otherwise((F.get("r", F.size("chars")) % 9 + 1).cast("string"))
    skip = F.when(F.col("kind") == "iban", 3).otherwise(2)
    number = F.concat(head, F.array_join(F.slice("plain", skip, F.size("plain")), ""))
    front, own = F.split(F.substring(number, F.lit(1), F.length(number) - 1), ""), F.slice("chars", F.lit(1), F.size("chars") - 1)
    valid = _luhn(own).cast("string") == F.get("chars", F.size("chars") - 1)
    check = F.when(valid, _luhn(front)).otherwise((_luhn(front) + 1 + F.get("r", F.lit(0)) % 9) % 10)
    card = F.concat(F.array_join(front, ""), check.cast("string"))
    title = F.regexp_extract("canon", r"^(\S+?)\.? ", 1)
    gender = F.when(title.isin([x.lower() for x in MALE]), "male").when(title.isin([x.lower() for x in FEMALE]), "female").otherwise(F.when(F.get("r", F.lit(0)) % 2 == 0, "male").otherwise("female"))
    rest = F.regexp_extract("canon", r"^\S+ (.*)$", 1)
    script = F.when(rest.rlike(r"\p{IsCyrillic}"), "cyrillic").when(rest.rlike(r"\p{IsGreek}"), "greek")
    for s, letter in (("hebrew", "Hebrew"), ("arabic", "Arabic"), ("han", "Han")):
        script = script.when(rest.rlike(rf"\p{{Is{letter}}}"), s)
    script = script.otherwise("latin")
    name = None
    for (s, g), names in FIRST.items():
        picked = _pick(names, F.get("r", F.lit(1)))
        name = F.when((script == s) & (gender == g), picked) if name is None else name.when((script == s) & (gender == g), picked)
    last = F.initcap(F.array_join(F.slice("plain", F.greatest(F.lit(1), F.size("plain") - 5), 6), ""))
    name = F.when(rest.rlike("[ -]"), F.concat_ws(" ", name, last)).otherwise(F.when(F.col("attempt") < 2, name).otherwise(F.concat(name, F.lower(last))))
    ip6 = F.concat_ws(":", F.lit("2001"), F.lit("db8"), *[F.lower(F.hex(F.get("r", F.lit(i)) % 65535 + 1)) for i in range(6)])
    body = F.when(F.col("kind") == "ip", ip).when(F.col("kind") == "ip6", ip6).when(F.col("kind") == "card", card).when(F.col("kind") == "name", name)
    body = body.when(F.col("kind").isin("email", "secret"), F.array_join("plain", "")).otherwise(number)
    # Drawn characters behind the format, of no bounded number: no format runs out.
    more = F.substring(F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("more"), F.col("kind"), F.col("canon"), F.col("attempt").cast("string")).cast("binary"), 256), F.lit(1), (F.col("attempt") - STRICT + 1) * 2)
    digits, letters = F.translate(more, "abcdef", "012345"), F.translate(more, "0123456789", "ghijklmnop")
    long_card = F.concat(F.array_join(front, ""), digits)
    long_luhn = _luhn(F.filter(F.split(long_card, ""), lambda x: x != ""))
    long_check = F.when(valid, long_luhn).otherwise((long_luhn + 1 + F.get("r", F.lit(0)) % 9) % 10)
    wider = F.when(F.col("kind").isin("ip", "ip6"), body).when(F.col("kind") == "card", F.concat(long_card, long_check.cast("string")))
    wider = wider.when(F.col("kind") == "name", F.concat(body, letters)).when(F.col("kind").isin("email", "secret"), F.concat(body, more))
    body = F.when(wide, wider.otherwise(F.concat(body, digits))).otherwise(body)
    return df.withColumn("body", body).drop("chars", "r", "plain")


def dressed(surface: Column, k: Column, body: Column) -> Column:
    """The surrogate's letters and digits in the format of a surface form. What a widened one has more
    stands behind the format, or behind the local part of an address."""
    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))

    def put(s: Column, c: Column) -> Column:
        new = F.substring(body, s["at"], F.lit(1))
        cased = F.when(c != F.lower(c), F.upper(new)).otherwise(new)
        own = c.rlike(r"^[\p{L}\p{N}]$")
        return F.struct((s["at"] + own.cast("int")).alias("at"), F.concat(s["out"], F.when(own, cased).otherwise(c)).alias("out"))

    put_in = F.aggregate(F.filter(F.split(surface, ""), lambda x: x != ""), start, put)
    folded, more = put_in["out"], F.substring(body, put_in["at"], F.length(body))
    more = F.when(surface == F.upper(surface), F.upper(more)).otherwise(more)
    home = F.when(surface == F.upper(surface), "EXAMPLE.COM").otherwise("example.com")
    mail = F.regexp_replace(folded, r"(?<=[.@])[^.@]+\.[^.@]+$", "")
    mail = F.concat(F.substring_index(mail, "@", 1), more, F.lit("@"), F.substring_index(mail, "@", -1), home)
    title = F.regexp_extract(surface, f"^({_TITLED})", 1)
    return F.when(k == "email", mail).when(k.isin("ip", "ip6"), body).when(k == "name", F.concat(title, body)).otherwise(F.concat(folded, more))


def surrogates(found: DataFrame, key: str = KEY) -> DataFrame:
    """(entity, surrogate) of distinct surface forms ``found`` (entity)."""
    forms = found.withColumn("kind", kind(F.col("entity"))).withColumn("canon", canonical(F.col("entity"), F.col("kind")))
    forms = cut_lineage(forms, "pii-forms")
    # One form stands for the entity in the checks.
    open_ = forms.groupBy("kind", "canon").agg(F.min("entity").alias("form"), F.count(F.lit(1)).alias("n")).drop("n")
    taken = cut_lineage(open_, "pii-entities")
    open_, settled = taken, None
    for attempt in range(ROUNDS):
        tried = drawn(open_.withColumn("attempt", F.lit(attempt)), key)
        tried = tried.withColumn("other", canonical(dressed(F.col("form"), F.col("kind"), F.col("body")), F.col("kind")))
        tried = cut_lineage(tried, "pii-tried")
        # Two of one surrogate: the smallest keeps it. None that occurs, none that is given.
        first = tried.groupBy("kind", "other").agg(F.min("canon").alias("canon"))
        fine = tried.join(first, ["kind", "other", "canon"], "left_semi").join(taken.select("kind", F.col("canon").alias("other")), ["kind", "other"], "left_anti")
        if settled is not None:
            fine = fine.join(settled.select("kind", "other"), ["kind", "other"], "left_anti")
        fine = cut_lineage(fine.select("kind", "canon", "form", "body", "other"), "pii-settled")
        settled = fine if settled is None else cut_lineage(settled.union(fine), "pii-settled")
        open_ = cut_lineage(open_.join(fine, ["kind", "canon"], "left_anti").select("kind", "canon", "form"), "pii-open")
        if open_.isEmpty():
            return forms.join(settled.select("kind", "canon", "body"), ["kind", "canon"]).select("entity", dressed(F.col("entity"), F.col("kind"), F.col("body")).alias("surrogate"))
    raise ValueError("a type has more entities than surrogates of its format")


def replace(docs: DataFrame, key_column: str = "doc_id", text: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text``, and n_entities. The last replaces a column of its name."""
    names = [c for c in docs.columns if c != "n_entities"]
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    body = F.col(f"c{names.index(text)}")
    id_ = F.col(f"c{names.index(key_column)}")
    inner = inner.withColumn("found", F.coalesce(entities(body), F.array().cast("array<string>")))
    plain = inner.filter(F.size("found") == 0).withColumn("n_entities", F.lit(0).cast("long")).drop("found")
    marked = cut_lineage(inner.filter(F.size("found") > 0).withColumn("row", F.xxhash64(body, id_)), "pii-marked")
    named = marked.select("row", F.explode(F.array_distinct("found")).alias("entity"))
    given = cut_lineage(surrogates(named.select("entity").distinct(), key), "pii-surrogates")
    by_row = named.distinct().join(given, "entity").groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("entity", "surrogate"))).alias("given"))
    both = marked.join(by_row, "row")
    pieces = F.split(body, PATTERN, -1)
    new = F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.element_at("given", F.get("found", i)), F.lit(""))))
    done = both.withColumn("n_entities", F.size("found").cast("long")).withColumn("new", F.array_join(new, ""))
    done = done.withColumn(f"c{names.index(text)}", F.col("new")).select(*plain.columns)
    return plain.unionByName(done).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "n_entities")
