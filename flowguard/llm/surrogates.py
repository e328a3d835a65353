"""Personal data replaced by keyed surrogates, in DataFrame functions only.

One expression finds e-mail addresses, IPv4 addresses, card and account numbers, phone numbers,
SSN- and IBAN-like numbers, access keys, assigned passwords and tokens, long hexadecimal secrets
and names after a title. Surrogates are made for parts: a surname, a first name with its gender,
or the canonical form of any other entity (the digits of a number, an address in small letters).
The surrogate of a part is a function of a secret key, the part and an attempt number (SHA-256),
so a surname is replaced alike after every title and first name, and a number in every spelling.
It keeps the type and the format: separators, letter case, digit counts, the country code of a
phone number, the top domain of an address, the first digit of a card and its valid check digit;
names take the gender of their title and the script of their letters.

Collision check: the distinct parts of the whole table are gathered (map-side combined), and
parts whose surrogate is shared with another part or is itself a part of the table move to their
next attempt, until none is left. Names grow with the attempt; from ``LONGER`` attempts on, other
surrogates carry a tail of their own, so the search ends even where a format has fewer members
than parts. Texts are rewritten in place; only the few parts with an attempt above zero are
looked up by a join.

Defined results: a null text stays null, an empty one empty, a text without entities as it is;
repeated rows are rewritten alike; an empty table gives an empty table; texts may be of any
length; a null id is allowed. All columns but the text keep their values, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import let, quoted, stage, unused

# Titles and what they say about gender.
MALE = "Mr Herr Monsieur Señor Sr Mister господин г-н".split()
FEMALE = "Mrs Ms Miss Frau Madame Mme Señora Sra Señorita госпожа г-жа".split()
NEUTRAL = "Dr Prof".split()
# Surrogate first names by script and gender, and syllables of surnames.
FIRST = {
    ("latin", "m"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Marc Nils Oscar Paul".split(),
    ("latin", "f"): "Anna Berta Clara Diana Emma Fiona Greta Helen Irene Julia Karin Laura Maria Nora Olga Paula".split(),
    ("latin", "n"): "Alex Andrea Chris Dana Eli Frankie Gale Jamie Jo Kim Lee Mika Noa Robin Sam Toni".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Семён Тимур".split(),
    ("cyrillic", "f"): "Алла Белла Вера Галина Дарья Ева Жанна Зоя Инна Клара Лидия Майя Нина Ольга Полина Рита".split(),
    ("cyrillic", "n"): "Саша Женя Валя Шура Слава Никита Паша Тоня Лёля Миша Дима Стася Лёша Глаша Юля Вася".split(),
}
SYLLABLES = {"latin": "bar ben cor dal fen gar hol kel lin mar nor pel ran sol ter wen".split(),
             "cyrillic": "бар бен вор дал фен гар хол кел лин мар нор пел ран сол тер вен".split()}

#: The look-ahead tells most places apart by one character.
TITLE = "(?=[" + "".join(sorted({t[0] for t in MALE + FEMALE + NEUTRAL})) + "])(?:" + "|".join(MALE + FEMALE + NEUTRAL) + r")\.?"
NAME = r"\p{Lu}[\p{L}'’-]+"
PATTERNS = [
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    rf"(?<![\p{{L}}\d]){TITLE} {NAME}(?: {NAME})?",
    r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)",
    r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    r"(?<=(?i:password|passwd|pwd|secret|token|api_key|apikey|api-key)[\"']?\s{0,2}[=:]\s{0,2}[\"']?)[^\s\"'=:][^\s\"'=]{5,}",
    r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![A-Za-z0-9])",
    r"\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)",
    r"\(\d{3}\) ?\d{3}-\d{4}(?!\d)",
    r"(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])",
    r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)",
]
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS)
#: What every entity has: a digit, an at sign, a title or the mark before a secret. Tested first, as most texts have none.
HINT = rf"[0-9@=:]|{TITLE} \p{{Lu}}"
PERSON = rf"^{TITLE} \p{{Lu}}"
MAIL = r"^[A-Za-z0-9._%+-]+@"
IPV4 = r"^(\d{1,3}\.){3}\d{1,3}$"
NUMBER = r"^[+(]?\d[\d ().-]{9,}$"
IBAN = r"^[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?$"
# Country codes of one and two digits; all others have three.
COUNTRY = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
#: Before the parts of names.
MARK = "\u001f"
LONGER = 8
ATTEMPTS = 40


def entities(text: Column) -> Column:
    """The entities of a text in their order."""
    return F.when(F.regexp_like(text, F.lit(HINT)), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))) \
            .otherwise(F.array().cast("array<string>"))


def byte(digest: Column, i: Column) -> Column:
    return F.conv(F.substr(digest, F.pmod(i, F.lit(64)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def digest_of(key: str, entity: Column, attempt: Column) -> Column:
    parts = [F.sha2(F.concat_ws("\u001f", F.lit(key), F.lit(str(n)), attempt.cast("string"), entity), 256) for n in (0, 1)]
    return F.concat(*parts)


def scrambled(text: Column, digest: Column, hexadecimal: bool = False) -> Column:
    """Digits to digits (none zero at the start of a group), letters to letters of their case."""
    letters = "abcdef" if hexadecimal else "abcdefghijklmnopqrstuvwxyz"

    def one(chars: Column):
        def char(c: Column, i: Column) -> Column:
            b = byte(digest, i)
            digit = F.pmod(b, F.lit(10)) if hexadecimal else F.when(
                F.coalesce(F.get(chars, i - 1).between("0", "9"), F.lit(False)), F.pmod(b, F.lit(10))).otherwise(F.pmod(b, F.lit(9)) + 1)
            letter = F.substr(F.lit(letters), F.pmod(b, F.lit(len(letters))) + 1, F.lit(1))
            return F.when(c.between("0", "9"), digit.cast("string")).when(c.between("a", "z"), letter) \
                    .when(c.between("A", "Z"), F.upper(letter)).otherwise(c)
        return F.array_join(F.transform(chars, char), "")

    return let(F.split(text, ""), one)


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def renumbered(digits: Column, digest: Column, kept: Column) -> Column:
    """Digits to digits from 1 to 9, after the first ``kept``."""
    return F.array_join(F.transform(F.split(digits, ""), lambda c, i: F.when(i < kept, c).otherwise(
        (F.pmod(byte(digest, i), F.lit(9)) + 1).cast("string"))), "")


def check_digit(body: Column) -> Column:
    """The Luhn digit that completes ``body``."""
    places = F.transform(F.split(F.reverse(body), ""), lambda c, i: let(c.cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
                         lambda x: F.coalesce(F.when(x > 9, x - 9).otherwise(x), F.lit(0))))
    return F.pmod(-F.aggregate(F.filter(places, lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + x), F.lit(10)).cast("string")


def card(old: Column, digest: Column) -> Column:
    """The digits of a card: the first stays, and the last is a valid check digit if it was."""
    def valid(x: Column) -> Column:
        return check_digit(F.substr(x, F.lit(1), F.length(x) - 1)) == F.substr(x, F.length(x), F.lit(1))

    body = F.concat(F.substr(old, F.lit(1), F.lit(1)), F.substr(scrambled(old, digest), F.lit(2), F.length(old) - 2))
    return F.concat(body, F.when(valid(old), check_digit(body)).otherwise(F.pmod(byte(digest, F.lit(60)), F.lit(10)).cast("string")))


def address(entity: Column, digest: Column) -> Column:
    """An IPv4 address from 1.0.0.1 to 223.255.255.254."""
    return F.concat_ws(".", (F.pmod(byte(digest, F.lit(0)), F.lit(223)) + 1).cast("string"), byte(digest, F.lit(1)).cast("string"),
                       byte(digest, F.lit(2)).cast("string"), (F.pmod(byte(digest, F.lit(3)), F.lit(254)) + 1).cast("string"))


def email(entity: Column, digest: Column) -> Column:
    top = F.regexp_extract(entity, r"\.[A-Za-z]+$", 0)
    return F.concat(scrambled(F.substr(entity, F.lit(1), F.length(entity) - F.length(top)), digest), top)


def phone(number: Column, digest: Column) -> Column:
    """The country code as it is."""
    code = F.coalesce(F.nullif(F.regexp_extract(number, rf"^\+({COUNTRY})", 1), F.lit("")), F.substr(number, F.lit(2), F.lit(3)))
    return F.concat(F.lit("+"), renumbered(digits_of(number), digest, F.length(code)))


def pick(values: list[str], b: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), F.pmod(b, F.lit(len(values))) + 1)


def is_like(text: Column, pattern: str) -> Column:
    return F.regexp_like(text, F.lit(pattern))


def canonical(entity: Column) -> Column:
    """What all spellings of an entity share: the digits of a number (with a plus before a country
    code), an account code without blanks, an address in small letters."""
    return F.when(is_like(entity, MAIL), F.lower(entity)) \
            .when(is_like(entity, IPV4) | is_hex(entity), entity) \
            .when(is_like(entity, NUMBER), F.concat(F.when(F.startswith(entity, F.lit("+")), "+").otherwise(""), digits_of(entity))) \
            .when(is_like(entity, IBAN), F.replace(entity, F.lit(" "), F.lit(""))).otherwise(entity)


def is_hex(entity: Column) -> Column:
    return is_like(entity, r"^([0-9a-f]{16,64}|[0-9A-F]{16,64})$") & ~is_like(entity, r"^\d{13,19}$")


def parts_of(entity: Column) -> Column:
    """What surrogates are made for: the first name (marked by its gender) and the surname of a
    person, of any other entity its canonical form."""
    def of_person(tokens: Column) -> Column:
        title = F.regexp_replace(tokens[0], r"\.$", "")
        gender = F.when(title.isin(*MALE), "m").when(title.isin(*FEMALE), "f").otherwise("n")
        last = F.concat(F.lit(MARK + "s"), F.element_at(tokens, -1))
        return F.when(F.size(tokens) > 2, F.array(F.concat(F.lit(MARK), gender, tokens[1]), last)).otherwise(F.array(last))

    return F.when(is_like(entity, PERSON), let(F.split(entity, " "), of_person)).otherwise(F.array(canonical(entity)))


def name(part: Column, digest: Column, attempt: Column) -> Column:
    """A name of the gender and script of the part: each attempt has one more first name, or one
    more syllable of the surname, so there are more names than parts after few attempts."""
    def joined(values: list[str], n: Column, between: str) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: pick(values, byte(digest, i))), between)

    def by_kind(script: str) -> Column:
        kind = F.substr(part, F.lit(2), F.lit(1))
        out = F.when(kind == "s", F.initcap(joined(SYLLABLES[script], attempt + 3, "")))
        for gender in "mfn":
            out = out.when(kind == gender, joined(FIRST[script, gender], attempt + 1, "-"))
        return out

    made = F.when(is_like(part, r"\p{IsCyrillic}"), by_kind("cyrillic")).otherwise(by_kind("latin"))
    return F.concat(F.substr(part, F.lit(1), F.lit(2)), made)


def made_for(part: Column, key: str, attempt: Column) -> Column:
    """The surrogate of a part, in canonical form."""
    def of(d: Column) -> Column:
        made = F.when(is_like(part, MAIL), email(part, d)) \
                .when(is_like(part, IPV4), address(part, d)) \
                .when(is_like(part, r"^AKIA[0-9A-Z]{16}$"), F.concat(F.lit("AKIA"), scrambled(F.substr(part, F.lit(5), F.lit(16)), d))) \
                .when(is_hex(part), scrambled(part, d, hexadecimal=True)) \
                .when(is_like(part, r"^\d{13,19}$"), card(part, d)) \
                .when(is_like(part, r"^\+\d+$"), phone(part, d)) \
                .when(is_like(part, r"^\d{10,}$|^\d{9}$"), renumbered(part, d, F.lit(0))) \
                .otherwise(scrambled(part, d))
        tail = F.when(attempt < LONGER, "").otherwise(F.substr(d, F.lit(1), 2 * (attempt - LONGER + 1)))
        return F.when(F.startswith(part, F.lit(MARK)), name(part, d, attempt)).otherwise(F.concat(made, tail))

    return let(digest_of(key, part, attempt), of)


def laid_out(entity: Column, made: Column) -> Column:
    """Letters and digits of ``made`` in the places of those of ``entity``, then what is left of them."""
    def with_signs(new: Column) -> Column:
        def char(c: Column, i: Column) -> Column:
            place = F.length(F.regexp_replace(F.substr(entity, F.lit(1), i + 1), "[^0-9A-Za-z]", ""))
            return F.when(is_like(c, "[0-9A-Za-z]"), F.substr(new, place, F.lit(1))).otherwise(c)
        used = F.length(F.regexp_replace(entity, "[^0-9A-Za-z]", ""))
        return F.concat(F.array_join(F.transform(F.split(entity, ""), char), ""), F.substr(new, used + 1, F.length(new)))

    return let(F.regexp_replace(made, "[^0-9A-Za-z]", ""), with_signs)


def in_case(entity: Column, made: Column) -> Column:
    """``made`` with capitals where ``entity`` has them."""
    return F.array_join(F.transform(F.split(made, ""), lambda c, i: F.when(
        F.coalesce(F.substr(entity, i + 1, F.lit(1)).between("A", "Z"), F.lit(False)), F.upper(c)).otherwise(c)), "")


def surrogate(entity: Column, key: str, attempt: Callable[[Column], Column]) -> Column:
    """The surrogate of an entity, where ``attempt`` gives that of a part."""
    def written(made: Column) -> Column:
        names = F.transform(made, lambda m: F.substr(m, F.lit(3), F.length(m)))
        return F.when(is_like(entity, PERSON), F.concat_ws(" ", F.substring_index(entity, " ", 1), names)) \
                .when(is_like(entity, MAIL), in_case(entity, made[0])) \
                .when(~is_like(entity, IPV4) & ~is_hex(entity) & (is_like(entity, NUMBER) | is_like(entity, IBAN)), laid_out(entity, made[0])) \
                .otherwise(made[0])

    return let(F.transform(parts_of(entity), lambda p: made_for(p, key, attempt(p))), written)


def parts_in(text: Column) -> Column:
    return F.flatten(F.transform(entities(text), parts_of))


def attempts(docs: DataFrame, key: str, text_col: str) -> DataFrame:
    """part and attempt for the parts whose first surrogate is not theirs alone."""
    state = stage(docs.select(F.explode(parts_in(F.col(quoted(text_col)))).alias("part")).distinct()
                  .withColumn("attempt", F.lit(0)), "parts")
    for _ in range(ATTEMPTS):
        made = state.withColumn("made", made_for(F.col("part"), key, F.col("attempt")))
        shared = made.groupBy("made").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("attempt", "part")).alias("keeps"))
        crowded = made.join(shared.filter("n > 1"), "made").filter(F.col("part") != F.col("keeps.part")).select("part")
        known = made.join(state.select(F.col("part").alias("made")), "made", "left_semi").select("part")
        moved = stage(crowded.union(known).distinct(), "collisions")
        if moved.isEmpty():
            break
        state = stage(state.join(moved.withColumn("step", F.lit(1)), "part", "left")
                      .select("part", (F.col("attempt") + F.coalesce("step", F.lit(0))).alias("attempt")), "parts")
    else:
        raise RuntimeError("surrogates still collide")
    return stage(state.filter("attempt > 0"), "attempts")


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the entities in the text replaced; the columns stay as they are."""
    moved, text = attempts(docs, key, text_col), F.col(quoted(text_col))
    source, attempt = docs, lambda part: F.lit(0)
    if not moved.isEmpty():
        row, same, tries = unused(docs.columns, "row", "same", "tries")
        # Rows of one id and one text have the same parts, so no group is larger than a text.
        rows = docs.withColumn(row, F.struct(F.col(quoted(id_col)).alias("id"), F.xxhash64(text).alias("text")))
        per_row = rows.select(F.col(row).alias(same), F.explode(F.array_distinct(parts_in(text))).alias("part")) \
                      .join(moved, "part").groupBy(same) \
                      .agg(F.map_from_entries(F.collect_set(F.struct("part", "attempt"))).alias(tries))
        source = rows.join(stage(per_row, "moved"), F.col(row).eqNullSafe(F.col(same)), "left")
        attempt = lambda part: F.coalesce(F.try_element_at(F.col(tries), part), F.lit(0))
    new = let(entities(text), lambda found: F.when(F.size(found) == 0, text).otherwise(
        let(F.transform(found, lambda e: surrogate(e, key, attempt)), lambda made: F.array_join(F.transform(
            F.split(text, ENTITY), lambda gap, i: F.concat(gap, F.coalesce(F.get(made, i), F.lit("")))), ""))))
    return source.select(*[F.when(text.isNotNull(), new).alias(c) if c == text_col else F.col(quoted(c)) for c in docs.columns])


def count_entities(text: Column) -> Column:
    return F.coalesce(F.size(entities(text)), F.lit(0)).cast("long")
