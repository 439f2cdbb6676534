"""Personal data replaced by keyed surrogates; DataFrame and SQL functions only.

Detected: e-mail and IP addresses, phone, card and account numbers, social security numbers,
and names behind a title.  Every entity (kind and normalised value) gets one surrogate for the whole corpus,
derived from a secret key, so that mentions keep referring to each other in whatever
format they are written.  Surrogates keep the type: digits stay digits in their places and
layout, a valid card check digit stays valid, letters keep their script and case, given names keep
the gender of the title, mail domains become reserved ones.

Collision check: candidates are grouped; of entities with the same candidate, or one that is itself
an entity of the corpus, all but the smallest draw again with the next attempt number until all
are distinct and no surrogate is a real value.  Only the entity table takes part in this.

Defined cases: a null text stays null; texts without entities stay as they are; repeated rows get the
same text; equal entities get equal surrogates wherever they occur; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.llm import query
from cytoframe.llm.common import row_key, table
from cytoframe.session import cut

#: Titles by gender.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "Господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "Госпожа"],
    "n": ["Dr", "Prof", "Mx"],
}
#: Common names; the surrogates of names are drawn from them.
GIVEN = {
    "m": ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Karim", "Leo", "Martin", "Nils", "Oscar", "Paul", "Ruben"],
    "f": ["Alma", "Bella", "Clara", "Diana", "Elsa", "Flora", "Hanna", "Ines", "Julia", "Klara", "Laura", "Maria", "Nora", "Olga", "Paula", "Rosa"],
    "n": ["Alex", "Charlie", "Dominique", "Eden", "Kim", "Luca", "Noa", "Robin", "Sasha", "Toni"],
}
FAMILY = ["Alder", "Brook", "Castell", "Dahl", "Ebert", "Fontan", "Graf", "Holm", "Ibarra", "Jansen", "Keller", "Lindt", "Moreau", "Novak", "Ortega", "Petit", "Quiroga", "Rossi", "Stein", "Tanner", "Urban", "Vidal", "Weber", "Zeller"]
SYLLABLES = ["an", "bel", "cor", "dan", "er", "fin", "gar", "hol", "in", "jo", "kas", "len", "mar", "no", "ol", "per", "ri", "sen", "tal", "ver"]
#: Letters of the scripts whose words keep their script.
SCRIPTS = [
    "abcdefghijklmnopqrstuvwxyz", "àáâäãåçèéêëìíîïñòóôöõùúûüýß", "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрстуфхцчшщыэюя",
    "אבגדהוזחטיכלמנסעפצקרשת", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "あいうえおかきくけこさしすせそたちつてとなにぬねの", "アイウエオカキクケコサシスセソタチツテトナニヌネノ",
    "安白本成大东方高国海和华江金京开乐林明南平青清人山水天文西新阳一玉中",
]
DIGITS = "0123456789"

_TITLE = "(?:" + "|".join(t for group in TITLES.values() for t in group) + ")"
#: Kind and pattern, in order of precedence.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]+\.)+[A-Za-z]{2,}",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\d|\.\d)",
    "phone": r"\+\d{1,3}[ .-]?\(\d{1,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|\+\d{1,3}(?:[ .-]\d{2,4}){2,4}(?!\d)|\+\d{9,15}(?!\d)|(?<![\d+])\(\d{3}\) ?\d{3}[.-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "account": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "card": r"(?<![\p{L}\d.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\p{L}\d])",
    "name": rf"(?<![\p{{L}}]){_TITLE}\.?\x20\p{{Lu}}[\p{{L}}'’-]+(?:\x20\p{{Lu}}[\p{{L}}'’-]+)?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
MAY = rf"[0-9@]|{_TITLE}\.?\x20\p{{Lu}}"


def let(value: Column, f) -> Column:
    """f(value) with ``value`` computed once per row."""
    return F.transform(F.array(value), f)[0]


def _kind(hit: Column) -> Column:
    out = F.when(hit.contains("@"), "email")
    for kind in ("ip", "phone", "ssn", "account", "card"):
        out = out.when(hit.rlike(f"^(?:{PATTERNS[kind]})$"), kind)
    return out.otherwise("name")


def _gender(title: Column) -> Column:
    return F.when(title.isin(TITLES["m"]), "given_m").when(title.isin(TITLES["f"]), "given_f").otherwise("given_n")


def _entities(hit: Column) -> Column:
    """The (kind, norm) pairs a hit mentions: one, or given and family name."""
    pair = lambda kind, norm: F.struct(kind.alias("kind"), norm.alias("norm"))
    words = F.split(hit, " ")
    names = F.when(F.size(words) == 2, F.array(pair(F.lit("family"), F.lower(words[1])))).otherwise(
        F.array(pair(_gender(F.rtrim(words[0], F.lit("."))), F.lower(words[1])), pair(F.lit("family"), F.lower(F.element_at(words, -1))))
    )
    digits = F.regexp_replace(hit, r"[^0-9]", "")
    return let(_kind(hit), lambda kind: F.when(kind == "name", names)
               .when(kind == "email", F.array(pair(kind, F.lower(hit))))
               .when(kind == "ip", F.array(pair(kind, hit)))
               .when(kind == "account", F.array(pair(kind, F.regexp_replace(hit, " ", ""))))
               .otherwise(F.array(pair(kind, digits))))


def _at(seed: Column, i: Column) -> Column:
    """The i-th number (0 to 65535) of a seed of 128 hexadecimal digits."""
    return F.conv(F.substring(seed, F.pmod(i * 4, F.lit(128)).cast("int") + 1, F.lit(4)), 16, 10).cast("int")


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _like(text: Column, seed: Column) -> Column:
    """Text of the same shape: each letter another of its script and case, each digit another digit."""
    def swap(c: Column, i: Column) -> Column:
        n, low = _at(seed, i), F.lower(c)
        pick = lambda letters: F.substring(F.lit(letters), F.pmod(n, F.lit(len(letters))) + 1, F.lit(1))
        out = F.when(F.instr(F.lit(DIGITS), c) > 0, pick(DIGITS))
        for letters in SCRIPTS:
            out = out.when(F.instr(F.lit(letters), low) > 0, F.when(c == low, pick(letters)).otherwise(F.upper(pick(letters))))
        return out.otherwise(c)

    return F.array_join(F.transform(_chars(text), swap), "")


def _luhn(digits: Column) -> Column:
    """Sum of the check digit rule; a valid number's is divisible by ten."""
    def weigh(c: Column, i: Column) -> Column:
        v = c.cast("int")
        return F.when((F.char_length(digits) - i) % 2 == 0, F.when(v > 4, v * 2 - 9).otherwise(v * 2)).otherwise(v)

    return F.aggregate(F.transform(_chars(digits), weigh), F.lit(0), lambda a, v: a + v)


def _draw(key: str) -> Column:
    """The candidate of an entity (kind, norm) at its attempt."""
    kind, norm, attempt = F.col("kind"), F.col("norm"), F.col("attempt")
    seed = F.sha2(F.concat_ws("|", F.lit(key), kind, norm, attempt.cast("string")), 512)

    def make(seed: Column) -> Column:
        local, tld = F.substring_index(norm, "@", 1), F.regexp_extract(norm, r"\.([a-z]+)$", 1)
        label = F.array_join(F.transform(F.sequence(F.lit(24), F.lit(29)), lambda i: F.substring(F.lit(SCRIPTS[0]), F.pmod(_at(seed, i), F.lit(26)) + 1, F.lit(1))), "")
        email = F.concat(_like(local, seed), F.lit("@"), label, F.lit(".example."), F.when(tld.isin("com", "net", "org"), tld).otherwise("com"))
        ip = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (F.pmod(_at(seed, i), F.lit(254)) + 1).cast("string")), ".")
        number = F.concat(F.substring(norm, 1, 1), _like(F.expr("substring(norm, 2)"), seed))
        card = let(F.concat(F.substring(norm, 1, 1), _like(F.expr("substring(norm, 2, length(norm) - 2)"), seed)), lambda body: F.concat(
            body, F.when(_luhn(norm) % 10 == 0, F.pmod(-_luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")).otherwise(F.pmod(_at(seed, F.lit(30)), F.lit(10)).cast("string"))))
        account = F.concat(F.substring(norm, 1, 2), _like(F.expr("substring(norm, 3)"), seed))
        listed = lambda names: F.lower(F.array(*[F.lit(n) for n in names])[F.pmod(_at(seed, F.lit(0)), F.lit(len(names)))])
        more = F.when(attempt == 0, "").otherwise(F.array_join(F.transform(F.sequence(F.lit(1), F.least(attempt * 2, F.lit(20))), lambda i: F.array(*[F.lit(s) for s in SYLLABLES])[F.pmod(_at(seed, i), F.lit(len(SYLLABLES)))]), ""))
        latin = F.regexp_replace(norm, r"[a-zß-ÿ'’-]", "") == ""
        name = F.when(kind == "given_m", listed(GIVEN["m"])).when(kind == "given_f", listed(GIVEN["f"])).when(kind == "given_n", listed(GIVEN["n"])).otherwise(listed(FAMILY))
        name = F.when(latin, F.concat(name, more)).otherwise(_like(norm, seed))
        return F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "account", account).when(kind.isin("phone", "ssn"), number).otherwise(name)

    return let(seed, make)


def assign(entities: DataFrame, key: str, rounds: int = 60) -> DataFrame:
    """(kind, norm, surrogate) for the distinct (kind, norm): all surrogates of a kind distinct, none a real value."""
    real = cut(entities.distinct())
    now = cut(real.withColumn("attempt", F.lit(0)).withColumn("surrogate", _draw(key)))
    for _ in range(rounds):
        first = now.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "norm")).alias("first"), F.count(F.lit(1)).alias("n"))
        taken = real.select("kind", F.col("norm").alias("surrogate"), F.lit(True).alias("real"))
        bad = first.join(taken, ["kind", "surrogate"], "left").where("n > 1 OR real").select("kind", "surrogate", F.when(F.col("real"), F.lit(None)).otherwise(F.col("first.norm")).alias("winner"))
        bad = cut(bad)
        if bad.isEmpty():
            return now.select("kind", "norm", "surrogate")
        told = now.join(bad.withColumn("hit", F.lit(True)), ["kind", "surrogate"], "left")
        again = F.coalesce(F.col("hit"), F.lit(False)) & ~F.coalesce(F.col("winner") == F.col("norm"), F.lit(False))
        told = told.select("kind", "norm", "surrogate", again.alias("again"), (F.col("attempt") + again.cast("int")).alias("attempt"))
        now = cut(told.withColumn("surrogate", F.when(F.col("again"), _draw(key)).otherwise(F.col("surrogate"))).drop("again"))
    raise RuntimeError(f"surrogates still collide after {rounds} rounds")


def _render(hit: Column, found: Column) -> Column:
    """The hit with its entities' surrogates, in the hit's own layout and case."""
    one = found[0]["surrogate"]
    cased = lambda new, old: F.when(old == F.upper(old), F.upper(new)).otherwise(F.concat(F.upper(F.substring(new, 1, 1)), F.substring(new, F.lit(2), F.lit(1000))))
    words = F.split(hit, " ")
    name = F.concat_ws(" ", words[0], cased(one, words[1]), F.when(F.size(words) > 2, cased(found[1]["surrogate"], F.element_at(words, -1))))
    filled = F.array_join(F.transform(_chars(hit), lambda c, i: F.when(
        F.instr(F.lit(DIGITS), c) > 0, F.substring(one, F.char_length(F.regexp_replace(F.substring(hit, F.lit(1), i + 1), "[^0-9]", "")), F.lit(1))).otherwise(c)), "")
    spaced = F.array_join(F.transform(_chars(hit), lambda c, i: F.when(
        c != " ", F.substring(one, F.char_length(F.regexp_replace(F.substring(hit, F.lit(1), i + 1), " ", "")), F.lit(1))).otherwise(c)), "")
    kind = found[0]["kind"]
    return (F.when(kind == "email", F.when(hit == F.upper(hit), F.upper(one)).otherwise(one)).when(kind == "ip", one)
            .when(kind == "account", spaced).when(kind.isin("phone", "ssn", "card"), filled).otherwise(name))


def replace(docs: DataFrame, key: str = "corpus") -> DataFrame:
    """doc_id, ``text`` with surrogates and ``n_entities`` (replaced mentions) of every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id"), *[c.alias(n) for n, c in row_key().items()], "text")
    hits = F.when(F.col("text").rlike(MAY), F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    mentions = rows.select("_id", "_t", F.posexplode(hits).alias("i", "hit"))
    mentions = mentions.select("_id", "_t", "i", "hit", F.posexplode(_entities(F.col("hit"))).alias("j", "e")).select("_id", "_t", "i", "j", "hit", "e.kind", "e.norm")
    mentions = cut(mentions)
    named = mentions.join(assign(mentions.select("kind", "norm"), key), ["kind", "norm"])
    each = named.groupBy("_id", "_t", "i").agg(F.first("hit").alias("hit"), F.array_sort(F.collect_set(F.struct("j", "kind", "surrogate"))).alias("found"))
    each = each.select("_id", "_t", F.struct("i", _render(F.col("hit"), F.col("found")).alias("new")).alias("x"))
    new = each.groupBy("_id", "_t").agg(F.array_sort(F.collect_list("x")).alias("new"))
    joined = rows.join(new, ["_id", "_t"], "left")
    pieces = F.flatten(F.zip_with(F.split("text", ANY, -1), F.col("new"), lambda gap, x: F.array(F.coalesce(gap, F.lit("")), F.coalesce(x["new"], F.lit("")))))
    text = F.when(F.col("new").isNull(), F.col("text")).otherwise(F.array_join(pieces, ""))
    return joined.select("doc_id", text.alias("text"), F.coalesce(F.size("new"), F.lit(0)).cast("long").alias("n_entities"))


@query("op5_surrogates")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return replace(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "n_entities", "text")
