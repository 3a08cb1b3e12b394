"""Surrogates for personal data, with DataFrame and SQL functions only.

Entities (e-mail addresses, IBANs, IPv4 and IPv6 addresses, telephone numbers, card and social security numbers, names of persons) are found by one
regular expression. A mention is split into its canonical entity (format taken off) and its format. Each distinct entity gets one surrogate,
drawn from SHA-512 of key, type, canonical form and attempt: letters for letters and digits for digits, octets in range and of the same
private or public class, card numbers that pass the Luhn check and IBANs that pass theirs exactly if the original does, given names of the same gender and script,
surnames of the same script. Domains are entities of their own, so addresses of one domain stay together and those of two stay apart. Surrogates that clash with another one of the type, or with any entity of the corpus, are drawn again,
letters and names from wider spaces; so distinct entities stay distinct. Where a range of numbers (addresses of one private network, say) has hardly a free value left, the entities that are
still open after ATTEMPTS draws take each other's values in a keyed order. The surrogate is then put into the format of each mention, so that mentions of one
entity agree in all documents.

Persons are found by an honorific, by a given name of the list, or by words before a name (as in "my name is"); a name on its own that isn't in the list isn't told from other
capitalised words. Names are replaced word by word, whatever their letter case: a surname has the same surrogate after an honorific as after a given name, and where it stands alone
in a text that names its bearer. Initials and particles stay. Names in a cased script without sounds of its own here stay, too, rather than change script.
"""

from __future__ import annotations

from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from harvestry.llm.common import clash_free, written

ATTEMPTS = 12
DEFAULT_KEY = "harvestry"
#: Mentions of one form beyond which it is joined by broadcast, so that no task holds more of one form; at most one form for each HOT mentions is.
HOT = 1 << 17

#: Given names by gender and script, honorifics, particles, words before names, and the sounds that surrogates are built from: fixed values.
GIVEN = {
    ("male", "latin"): (
        "James John Robert Michael William David Richard Thomas Charles Daniel Matthew Anthony Mark Paul Steven Andrew George Kevin Brian Edward Peter Henry Jack Oliver Samuel Benjamin Alexander Max "
        "Hans Klaus Jürgen Wolfgang Stefan Lukas Pierre Jean Jacques François Louis Antoine Carlos José Juan Miguel Pedro Luis Javier Diego Marco Giovanni Luca Ahmed Mohammed Ali Omar Rahul Arjun Raj Wei Hiroshi Kenji"
    ).split(),
    ("female", "latin"): (
        "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Emma Olivia Anna Emily Laura Julia Lisa Nancy Helen Alice Grace Charlotte Sophia Hannah Rachel Catherine Margaret Jane "
        "Ursula Ingrid Sabine Petra Heike Monika Marie Claire Sophie Isabelle Camille Amélie María Carmen Ana Lucía Elena Rosa Sofia Giulia Francesca Fatima Aisha Leila Priya Ananya Mei Yuki Sakura"
    ).split(),
    ("male", "cyrillic"): "Иван Сергей Алексей Дмитрий Николай Владимир Михаил Андрей Олег Павел".split(),
    ("female", "cyrillic"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Юлия Екатерина".split(),
    ("male", "greek"): "Γιώργος Νίκος Δημήτρης Κώστας Γιάννης".split(),
    ("female", "greek"): "Μαρία Ελένη Κατερίνα Βασιλική Σοφία".split(),
    ("male", "armenian"): "Արմեն Դավիթ Հայկ Տիգրան".split(),
    ("female", "armenian"): "Անի Մարիամ Նարե Լուսինե".split(),
}
HONORIFICS = "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Mme Mlle Señor Señora Sra Don Doña Господин Госпожа Κύριος Κυρία".split()
PARTICLES = "van von de der den da di del la le du dos bin al ter ten zu".split()
CUES = ("name is", "Name:", "name:", "named", "Signed:", "signed by", "Regards,", "regards,", "Sincerely,", "Dear", "Contact:", "Attn:", "Patient:", "Customer:")
SOUNDS = {
    "latin": (["b", "br", "d", "f", "g", "h", "k", "l", "m", "n", "p", "r", "s", "st", "t", "v"], ["a", "e", "i", "o", "u", "ai", "ei", "ou"], {"male": ["n", "r", "s", "d"], "female": ["na", "la", "ra", "sa"], "any": ["ler", "man", "son", "vin"]}),
    "cyrillic": (["б", "бр", "в", "г", "д", "з", "к", "л", "м", "н", "п", "р", "с", "ст", "т", "ф"], ["а", "е", "и", "о", "у", "я", "ю", "э"], {"male": ["н", "р", "с", "м"], "female": ["на", "ла", "ра", "са"], "any": ["ов", "ин", "ев", "ко"]}),
    "greek": (["β", "γ", "δ", "ζ", "θ", "κ", "λ", "μ", "ν", "ξ", "π", "ρ", "σ", "τ", "φ", "χ"], ["α", "ε", "ι", "ο", "υ", "αι", "ει", "ου"], {"male": ["ος", "ης", "ας", "ων"], "female": ["να", "λα", "ρα", "σα"], "any": ["ίδης", "άκης", "όπουλος", "ίου"]}),
    "armenian": (["բ", "գ", "դ", "զ", "թ", "լ", "կ", "հ", "ղ", "մ", "ն", "պ", "ս", "վ", "տ", "ր"], ["ա", "ե", "ի", "ո", "ու", "ա", "ե", "ի"], {"male": ["ն", "ր", "ս", "մ"], "female": ["նե", "լա", "րե", "սա"], "any": ["յան", "ունի", "եան", "ենց"]}),
}


def one_of(words: list[str]) -> str:
    """A pattern for any of the words that shares their beginnings, so that few are tried at a place; longer words win."""
    ends, groups = "" in words, groupby(sorted({w for w in words if w}), key=lambda w: w[0])
    parts = [first + one_of([w[1:] for w in group]) for first, group in groups]
    if len(parts) > 1 or (parts and ends):
        return "(?:" + "|".join(parts) + ")" + ("?" if ends else "")
    return "".join(parts)


_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_GROUP = r"[0-9A-Fa-f]{1,4}"
_LISTED = [n for names in GIVEN.values() for n in names]
_GIVEN = rf"{one_of(_LISTED + [n.upper() for n in _LISTED])}(?!\p{{L}})"
_WORD = r"\p{Lu}(?:\p{L}+(?:[-'’]\p{L}+)*|[-'’]\p{L}{2,})(?!\p{L})"
_BETWEEN = rf"(?:(?:\p{{Lu}}\.|{one_of(PARTICLES)}) ){{0,3}}"
_NAME = rf"{_BETWEEN}{_WORD}(?: {_BETWEEN}{_WORD}){{0,2}}"
_TITLE = rf"{one_of(HONORIFICS + [h.upper() for h in HONORIFICS if len(h) > 2])}(?!\p{{L}})"
_CUE = "(?<=" + "|".join(f"{c}[ \\n]" for c in CUES) + ")"
#: Types in order of precedence; each pattern matches a whole mention.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?![0-9A-Za-z])",
    "ip6": rf"(?<![0-9A-Za-z:.])(?:(?:{_GROUP}:){{7}}{_GROUP}|(?:{_GROUP}:){{1,6}}(?::{_GROUP}){{1,6}})(?![0-9A-Za-z:])",
    "ip": rf"(?<![0-9A-Za-z.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9A-Za-z])(?!\.[0-9])",
    "phone": r"(?<![0-9A-Za-z+])\+(?=(?:[ .()-]{0,2}[0-9]){7,15})[1-9][0-9]{0,2}(?:[ .-]?\([0-9]{2,4}\))?(?:[ .-]?[0-9]{1,4}){2,5}(?![0-9A-Za-z])|(?<![0-9A-Za-z+(])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9A-Za-z-])"
    r"|(?<![0-9A-Za-z+.,:/-])0[1-9][0-9]{1,3}(?: |/| / |-)[0-9]{5,8}(?![0-9A-Za-z.,:/-])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "card": r"(?<![0-9A-Za-z-])(?:[0-9]{4}(?:[ -]?[0-9]{4}){3}(?:[ -]?[0-9]{1,3})?|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}|[0-9]{13,15})(?![0-9A-Za-z])",
    "person": rf"(?<![\p{{L}}\p{{N}}])(?=\p{{Lu}})(?:{_TITLE}\.? {_NAME}|{_GIVEN} {_NAME}|{_CUE}{_WORD}(?: {_BETWEEN}{_WORD}){{1,3}})",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
_PLAIN = {
    "email": "@", "iban": r"^[A-Z]{2}[0-9]{2}[A-Z0-9 ]+$", "ip6": r"^[0-9A-Fa-f]{0,4}:", "ip": r"^[0-9]+[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}$",
    "phone": r"^\+|^\(|^[0-9]{3}[-.][0-9]{3}[-.]|^0[0-9]{2,4}(?: |/| / |-)[0-9]{5,8}$", "ssn": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$", "card": r"^[0-9]",
}
#: A text without any of these holds no entity; it is cheaper than PATTERN.
SIGN = rf"[0-9@]|(?<!\p{{L}})(?=\p{{Lu}})(?:{_TITLE}\.? |{_GIVEN} |{_CUE})|{_GROUP}:{_GROUP}:|:{{2}}"


def kind_of(mention: Column) -> Column:
    """Type of a mention that PATTERN found."""
    out = None
    for kind, plain in _PLAIN.items():
        out = F.when(mention.rlike(plain), kind) if out is None else out.when(mention.rlike(plain), kind)
    return out.otherwise("person")


def _in(word: Column, words: list[str]) -> Column:
    return word.isin(*words)


def word_kind(word: Column) -> Column:
    """Type of a word of a person's name: kept (honorifics, initials, particles), given name with gender and script, or surname with script."""
    low = F.lower(word)
    out = F.when(_in(F.regexp_replace(low, r"\.$", ""), [h.lower() for h in HONORIFICS]) | _in(word, PARTICLES) | word.rlike(r"^\p{Lu}\.$"), "keep")
    for (gender, script), names in GIVEN.items():
        out = out.when(_in(low, [n.lower() for n in names]), f"given_{gender}_{script}")
    for script in ("cyrillic", "greek", "armenian", "latin"):
        out = out.when(word.rlike(rf"^[\p{{Is{script.capitalize()}}}'’-]+$"), f"surname_any_{script}")
    return out.otherwise("keep")


def canonical(kind: Column, mention: Column) -> Column:
    """The entity without its format: digits of numbers, lower case of addresses, no spaces in IBANs."""
    digits = F.regexp_replace(mention, "[^0-9]", "")
    return (
        F.when(kind.isin("card", "ssn"), digits)
        .when(kind == "phone", F.concat(F.regexp_extract(mention, r"^\+?", 0), digits))
        .when(kind.isin("email", "ip6"), F.lower(mention))
        .when(kind == "iban", F.replace(mention, F.lit(" "), F.lit("")))
        .otherwise(mention)
    )


def _stream(kind: Column, name: Column, attempt: Column, key: str) -> Column:
    """256 hexadecimal digits that depend on the key, the entity and the attempt."""
    seed = lambda k: F.sha2(F.concat_ws("\u0001", F.lit(key), kind, name, attempt.cast("string"), F.lit(k)).cast("binary"), 512)
    return F.concat(seed("a"), seed("b"))


def _number(stream: Column, place: Column) -> Column:
    """A number from 0 to 65535 for a place of the entity; places beyond the stream start again, rotated."""
    at = (F.pmod(place * 4, F.lit(253)) + 1).cast("int")
    return F.conv(F.substr(stream, at, F.lit(4)), 16, 10).cast("int")


def _chars(text: Column) -> Column:
    return F.split(text, "")


def _pick(values: str, n: Column) -> Column:
    return F.substr(F.lit(values), F.pmod(n, F.lit(len(values))) + 1, F.lit(1))


def _like(text: Column, stream: Column, letters: str = "a-z", pool: str = "abcdefghijklmnopqrstuvwxyz") -> Column:
    """Letters for a-z, digits for digits, by place; other characters stay."""
    def one(c: Column, i: Column) -> Column:
        n = _number(stream, i)
        return F.when(c.rlike("[0-9]"), _pick("0123456789", n)).when(c.rlike(f"[{letters}]"), _pick(pool, n)).otherwise(c)

    return F.array_join(F.transform(_chars(text), one), "")


def _more(stream: Column, attempt: Column) -> Column:
    """Letters that later attempts add: one more for every three of them."""
    return F.when(attempt < 3, "").otherwise(F.array_join(F.transform(F.sequence(F.lit(1), F.floor(attempt / 3).cast("int")), lambda i: _pick("abcdefghijklmnopqrstuvwxyz", _number(stream, 40 + i))), ""))


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of a string of digits."""
    terms = F.transform(_chars(F.reverse(digits)), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))))
    return F.pmod(F.aggregate(terms, F.lit(0), lambda s, x: s + x), F.lit(10))


def _card(name: Column, stream: Column) -> Column:
    drawn = _like(name, stream)
    head = F.concat(F.substring(name, 1, 1), F.substr(drawn, F.lit(2), F.length(drawn) - 2))  # the first digit names the network
    check = F.pmod(10 - _luhn(F.concat(head, F.lit("0"))), F.lit(10))
    wrong = F.pmod(check + 1 + F.pmod(_number(stream, F.lit(60)), F.lit(9)), F.lit(10))
    return F.concat(head, F.when(_luhn(name) == 0, check).otherwise(wrong).cast("string"))


def _mod97(text: Column) -> Column:
    """The remainder by 97 of a string of digits and capitals, which count from A = 10."""
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(_chars(text), F.lit(0), lambda s, c: F.pmod(s * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c), F.lit(97)))


def _iban(name: Column, stream: Column) -> Column:
    """The country stays; the check digits are right if the original's are, and drawn like the rest if not."""
    country, rest = F.substring(name, 1, 2), F.substr(name, F.lit(5), F.length(name))
    drawn = _like(rest, stream, "A-Z", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    check = F.lpad((98 - _mod97(F.concat(drawn, country, F.lit("00")))).cast("string"), 2, "0")
    right = _mod97(F.concat(rest, F.substring(name, 1, 4))) == 1
    other = F.lpad(F.pmod(check.cast("int") + 1 + F.pmod(_number(stream, F.lit(60)), F.lit(90)), F.lit(100)).cast("string"), 2, "0")
    return F.concat(country, F.when(right, check).otherwise(other), drawn)


def _kept(name: Column) -> Column:
    """How many octets of an IPv4 address tell its private network."""
    return F.when(name.rlike(r"^(?:10|127)\."), 1).when(name.rlike(r"^(?:192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|169\.254)\."), 2).otherwise(0)


def _ip(name: Column, stream: Column) -> Column:
    kept, first = _kept(name), 11 + F.pmod(_number(stream, F.lit(0)), F.lit(112))  # 11 to 122: public unicast addresses
    return F.array_join(F.transform(F.split(name, r"\."), lambda c, i: F.when(i < kept, c).when(i == 0, first.cast("string")).otherwise((1 + F.pmod(_number(stream, i), F.lit(254))).cast("string"))), ".")


def _ip6(name: Column, stream: Column) -> Column:
    """The first group stays, as it tells the range; a group's first digit is no zero."""
    first = F.substring_index(name, ":", 1)
    rest = F.substr(name, F.length(first) + 1, F.length(name))
    opens = lambda i: F.substr(rest, i, F.lit(1)) == ":"
    digit = lambda c, i: F.when(c == ":", c).when((i > 0) & opens(i), _pick("123456789abcdef", _number(stream, i))).otherwise(_pick("0123456789abcdef", _number(stream, i)))
    return F.concat(first, F.array_join(F.transform(_chars(rest), digit), ""))


def _domain(name: Column, stream: Column, attempt: Column) -> Column:
    """All labels but the last one are drawn; later attempts make the first one longer."""
    last = F.substring_index(name, ".", -1)
    return F.concat(_more(stream, attempt), _like(F.substr(name, F.lit(1), F.length(name) - F.length(last) - 1), stream), F.lit("."), last)


def _email(name: Column, stream: Column, attempt: Column, domain: Column) -> Column:
    return F.concat(_like(F.substring_index(name, "@", 1), stream), _more(stream, attempt), F.lit("@"), domain)


def _phone(name: Column, stream: Column) -> Column:
    """Digits for digits; an international number keeps its plus sign and first digit, a national one its leading zero or the lack of one."""
    drawn = _like(name, stream)
    rest = F.substr(drawn, F.lit(2), F.length(drawn))
    national = F.when(name.startswith("0"), F.concat(F.lit("0"), F.when(F.substring(rest, 1, 1) == "0", "7").otherwise(F.substring(rest, 1, 1)), F.substr(rest, F.lit(2), F.length(rest)))).otherwise(
        F.concat(F.when(F.substring(drawn, 1, 1) == "0", F.lit("7")).otherwise(F.substring(drawn, 1, 1)), rest)
    )
    return F.when(name.startswith("+"), F.concat(F.substring(name, 1, 2), F.substr(drawn, F.lit(3), F.length(drawn)))).otherwise(national)


def _name(kind: Column, stream: Column, attempt: Column) -> Column:
    """Three syllables (more with later attempts) and an ending of the gender, in the script of the original and in lower case."""
    out = None
    for script, (onsets, vowels, ends) in SOUNDS.items():
        for gender, endings in ends.items():
            pick = lambda values, place: F.element_at(F.array(*(F.lit(v) for v in values)), F.pmod(_number(stream, place), F.lit(len(values))) + 1)  # noqa: B023, E731
            parts = F.transform(F.sequence(F.lit(0), F.lit(2) + F.floor(attempt / 4).cast("int")), lambda i: F.concat(pick(onsets, 2 * i + 1), pick(vowels, 2 * i + 2)))  # noqa: B023
            made = F.concat(F.array_join(parts, ""), pick(endings, F.lit(0)))
            fits = kind.endswith(f"_{gender}_{script}")
            out = F.when(fits, made) if out is None else out.when(fits, made)
    return out


def surrogate(kind: Column, name: Column, attempt: Column, key: str, domain: Column | None = None) -> Column:
    """The draw of an attempt; `domain` is the surrogate of an address's domain."""
    s = _stream(kind, name, attempt, key)
    makers = {
        "domain": _domain(name, s, attempt), "email": _email(name, s, attempt, domain if domain is not None else F.substring_index(name, "@", -1)), "ip": _ip(name, s), "ip6": _ip6(name, s),
        "card": _card(name, s), "phone": _phone(name, s), "ssn": _like(name, s), "iban": _iban(name, s),
    }
    return reduce(lambda out, item: F.when(kind == item[0], item[1]).otherwise(out), makers.items(), _name(kind, s, attempt))


def range_of(kind: Column, name: Column) -> Column:
    """Entities of one kind with the same value here can take each other's surrogates without a change of class or format."""
    return (
        F.when(kind == "ip", F.concat_ws(".", F.slice(F.split(name, r"\."), F.lit(1), _kept(name))))
        .when(kind == "ip6", F.regexp_replace(name, "(?<=:)[0-9a-f]", "0"))
        .when(kind == "card", F.concat_ws(":", F.substring(name, 1, 1), F.length(name).cast("string"), (_luhn(name) == 0).cast("string")))
        .when(kind == "phone", F.concat_ws(":", F.substring(name, 1, 2), F.length(name).cast("string")))
        .when(kind == "iban", F.concat_ws(":", F.substring(name, 1, 2), F.length(name).cast("string"), (_mod97(F.concat(F.substr(name, F.lit(5), F.length(name)), F.substring(name, 1, 4))) == 1).cast("string")))
        .otherwise("")
    )


def assign(entities: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """(kind, name, surrogate) for distinct entities (kind, name, and domain for addresses): no surrogate occurs twice in a kind, and none is an entity of it while its range has free values.

    What clashes is drawn again with the next attempt, the entity that sorts first keeping its draw. Each round is written, and is
    over the entities that are left only. After ATTEMPTS rounds those of one range that are left are few, or the range is nearly full: they take each other's values, each that of the next
    in a keyed order; one alone takes that of another entity of its range.
    """
    if "domain" not in entities.columns:
        entities = entities.withColumn("domain", F.lit(None).cast("string"))
    done, pending = None, entities
    for attempt in range(ATTEMPTS):
        drawn = written(pending.withColumn("surrogate", surrogate(F.col("kind"), F.col("name"), F.lit(attempt), key, F.col("domain"))), "drawn")
        first = drawn.groupBy("kind", "surrogate").agg(F.min("name").alias("name"))
        taken = entities.select("kind", F.col("name").alias("surrogate"))
        if done is not None:
            taken = taken.unionByName(done.select("kind", "surrogate"))
        good = drawn.join(first, ["kind", "surrogate", "name"], "left_semi").join(taken, ["kind", "surrogate"], "left_anti").select("kind", "name", "surrogate")
        good = written(good, "good")
        done = good if done is None else done.unionByName(good)
        pending = written(drawn.join(good, ["kind", "name"], "left_anti").select("kind", "name", "domain"), "pending")
        if pending.isEmpty():
            return done
    ranged = lambda df: df.select("kind", "name", range_of(F.col("kind"), F.col("name")).alias("range"))
    order = Window.partitionBy("kind", "range").orderBy(F.sha2(F.concat(F.lit(key), F.col("name")).cast("binary"), 256), "name")
    left = ranged(pending).withColumn("next", F.coalesce(F.lead("name").over(order), F.first("name").over(order)))
    others = ranged(entities).groupBy("kind", "range").agg(F.min("name").alias("lo"), F.max("name").alias("hi"))
    swapped = left.join(others, ["kind", "range"]).select("kind", "name", F.when(F.col("next") != F.col("name"), F.col("next")).when(F.col("lo") != F.col("name"), F.col("lo")).otherwise(F.col("hi")).alias("surrogate"))
    return done.unionByName(written(swapped, "swapped"))


def fill(mention: Column, drawn: Column, kept: str = "0-9") -> Column:
    """The mention's format with the surrogate's digits (or other characters that count), one after the other."""
    drawn = F.regexp_replace(drawn, f"[^{kept}]", "")
    before = lambda i: F.length(F.regexp_replace(F.substr(mention, F.lit(1), i), f"[^{kept}]", ""))
    return F.array_join(F.transform(_chars(mention), lambda c, i: F.when(c.rlike(f"[{kept}]"), F.substr(drawn, before(i) + 1, F.lit(1))).otherwise(c)), "")


def _cased(mention: Column, drawn: Column) -> Column:
    """The surrogate in the letter case of the mention: all capitals, or place by place."""
    by_place = F.array_join(F.transform(_chars(drawn), lambda c, i: F.when(F.substr(mention, i + 1, F.lit(1)).rlike("[A-Z]"), F.upper(c)).otherwise(c)), "")
    return F.when(mention.rlike("[A-Z]") & ~mention.rlike("[a-z]"), F.upper(drawn)).otherwise(by_place)


def replacements(mentions: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """(mention, replacement, words) for distinct mentions that are replaced; words: surnames of a person and their surrogates, as they are written.

    Words of persons' names are entities of their own and put together again. Numbers of 13 to 19 digits that aren't grouped by fours to 16 are cards only if they pass the Luhn check.
    """
    kinds = mentions.select("mention", kind_of(F.col("mention")).alias("kind"))
    numbers = kinds.where("kind <> 'person'").withColumn("name", canonical(F.col("kind"), F.col("mention")))
    numbers = numbers.where((F.col("kind") != "card") | (F.length("name") == 16) | (_luhn(F.when(F.col("kind") == "card", F.col("name")).otherwise("0")) == 0))
    words = kinds.where("kind = 'person'").select("mention", F.posexplode(F.split("mention", " ")).alias("place", "word")).withColumn("kind", word_kind(F.col("word"))).withColumn("name", F.lower("word"))
    with_domain = numbers.withColumn("of", F.when(F.col("kind") == "email", F.substring_index("name", "@", -1)))
    domains = assign(written(with_domain.where("of IS NOT NULL").select(F.lit("domain").alias("kind"), F.col("of").alias("name")).distinct(), "domains"), key)
    known = domains.select(F.col("name").alias("of"), F.col("surrogate").alias("domain"))
    entities = with_domain.select("kind", "name", "of").distinct().join(known, "of", "left").select("kind", "name", "domain")
    entities = written(entities.union(words.where("kind <> 'keep'").select("kind", "name", F.lit(None).cast("string")).distinct()), "entities")
    chosen = written(assign(entities, key), "chosen")
    mention, drawn = F.col("mention"), F.col("surrogate")
    form = F.when(F.col("kind").isin("phone", "card", "ssn"), fill(mention, drawn)).when(F.col("kind") == "iban", fill(mention, drawn, "A-Z0-9")).when(F.col("kind").isin("email", "ip6"), _cased(mention, drawn)).otherwise(drawn)
    none = F.array().cast("array<struct<word:string,drawn:string>>")
    formed = numbers.join(chosen, ["kind", "name"]).select("mention", form.alias("replacement"), none.alias("words"))
    upper = (F.length("word") > 1) & (F.upper("word") == F.col("word"))
    named = words.join(chosen, ["kind", "name"], "left").withColumn("drawn", F.when(F.col("surrogate").isNull(), F.col("word")).when(upper, F.upper("surrogate")).otherwise(F.initcap("surrogate")))
    parts = F.array_sort(F.collect_list(F.struct("place", "drawn")))
    surnames = F.collect_set(F.when(F.col("kind").startswith("surname"), F.struct("word", "drawn")))
    spoken = named.groupBy("mention").agg(F.array_join(F.transform(parts, lambda x: x["drawn"]), " ").alias("replacement"), surnames.alias("words"), F.count("surrogate").alias("n")).where("n > 0").drop("n")
    return formed.unionByName(spoken)


def pseudonymise(df: DataFrame, key: str = DEFAULT_KEY, text: str = "text", count: str | None = None) -> DataFrame:
    """df with surrogates in its text; with `count`, a long column of the mentions replaced as well (surnames that stand alone don't count).

    A null text stays null, an empty one empty, both with no mention. Every row is read once by PATTERN and written with what that found and a number of its own; what
    follows is joined by that number, so null ids, repeated rows and clashing names of columns make no difference, and texts without an entity take part in no join.
    A column named as `count` is replaced. A form that more than HOT rows mention is joined by broadcast. Long texts and texts with many mentions are rebuilt by split and zip, in linear time.
    An empty table gives an empty one.
    """
    base = df.drop(count) if count else df
    hits, row = clash_free(base.schema, "hits"), clash_free(base.schema, "row")
    found = F.when(F.col(text).rlike(SIGN), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))
    scanned = written(base.withColumn(hits, F.coalesce(found, F.array().cast("array<string>"))).withColumn(row, F.monotonically_increasing_id()), "scanned")
    some = F.size(hits) > 0
    held = written(scanned.where(some).select(F.col(row).alias("row"), F.explode(F.array_distinct(hits)).alias("mention")), "mentions", sparse=True)
    forms = written(held.groupBy("mention").agg(F.count("*").alias("n")), "forms")
    pairs = written(replacements(forms.select("mention"), key).join(forms, "mention"), "replacements")
    told = pairs.select("mention", F.struct("mention", "replacement").alias("pair"), "words")
    cold = held.join(told.join(forms.where(F.col("n") <= HOT).select("mention"), "mention", "left_semi"), "mention")
    hot = held.join(F.broadcast(told.join(forms.where(F.col("n") > HOT).select("mention"), "mention", "left_semi")), "mention")  # at most one for each HOT mentions
    swaps = cold.unionByName(hot).groupBy("row").agg(F.map_from_entries(F.collect_list("pair")).alias("swap"), F.array_distinct(F.flatten(F.collect_list("words"))).alias("words"))
    mine, theirs, words = (clash_free(base.schema, c) for c in ("swap", "row_swap", "words"))
    swaps = written(swaps.select(F.col("row").alias(theirs), F.col("swap").alias(mine), F.col("words").alias(words)), "swaps")
    joined = scanned.where(some).join(swaps.hint("merge"), F.col(row) == F.col(theirs), "left").drop(theirs)
    alone = lambda w: F.concat(F.lit(r"(?<![\p{L}\p{N}])"), w, F.lit(r"(?![\p{L}\p{N}])"))
    rest = F.transform(F.split(F.col(text), PATTERN, -1), lambda part: F.aggregate(F.coalesce(F.col(words), F.array().cast("array<struct<word:string,drawn:string>>")), part, lambda t, w: F.regexp_replace(t, alone(w["word"]), w["drawn"])))
    rebuilt = F.array_join(F.zip_with(rest, F.col(hits), lambda a, b: F.concat(a, F.coalesce(F.element_at(F.col(mine), b), b, F.lit("")))), "")
    number = F.size(F.filter(hits, lambda b: F.element_at(F.col(mine), b).isNotNull())).cast("long")
    changed = joined.select(*(rebuilt.alias(c) if c == text else F.col(f"`{c}`") for c in base.columns), *([F.coalesce(number, F.lit(0).cast("long")).alias(count)] if count else []))
    same = scanned.where(~some).select(*(F.col(f"`{c}`") for c in base.columns))
    return changed.unionByName(same.withColumn(count, F.lit(0).cast("long")) if count else same)


def surrogate_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_entities (mentions replaced), text, for each row of documents."""
    return pseudonymise(docs.select("doc_id", "text"), count="n_entities").select("doc_id", "n_entities", "text")
