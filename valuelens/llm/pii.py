"""Personal data replaced by surrogates. Built-in expressions only.

An entity is a type and a canonical value, so that all its mentions in all texts get one surrogate. Of persons the
given name and the surname are entities of their own, so that a mention by surname gets that of the full name. A surrogate is
drawn by a keyed hash in the entity's own format. Surrogates that meet another one, or a value that really
occurs, are drawn again until there are none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuelens.llm.common import plain, written

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Without a country code: (212) 555-0199, 212-555-0199, 212.555.0199; 030 1234567, 0171/1234567; 01 23 45 67 89.
_NATIONAL = (
    r"(?<![\d.+-])(?:\([2-9]\d{2}\) ?\d{3}[ .-]\d{4}|[2-9]\d{2}-\d{3}-\d{4}|[2-9]\d{2}\.\d{3}\.\d{4}"
    r"|\(?0\d{2,4}\)?[ /-]\d{3,4}[ -]?\d{3,4}|0\d(?:[ .]\d{2}){4})(?![.-]?\d)"
)
#: Tried in this order at every place of a text.
PATTERNS = {
    "email": r"[\p{L}\d](?:[\p{L}\d._%+-]{0,62}[\p{L}\d_%+-])?@[\p{L}\d](?:[\p{L}\d-]{0,62}\.)+\p{L}{2,24}",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3}[ .-]?\d{3,4}(?!\d)|" + _NATIONAL,
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?!\d)",
    "person": r"(?<![\p{L}\d])(?:Mrs?|Ms|Miss|Herr|Frau|Monsieur|Madame|Mme|Se\x{f1}ora?|Sra|\x{413}-\x{43d}|\x{413}-\x{436}\x{430}|\x{39a}\x{3bf}\x{3c2}|\x{39a}\x{3b1}|\x{39a}\x{3c5}\x{3c1}\x{3af}\x{3b1})\.? \p{Lu}\p{Ll}{1,30}(?: \p{Lu}\p{Ll}{1,30})?",
}
ANY = "|".join(PATTERNS.values())
_FEMALE = r"^(?:Mrs|Ms|Miss|Frau|Madame|Mme|Se\x{f1}ora|Sra|\x{413}-\x{436}\x{430}|\x{39a}\x{3b1}|\x{39a}\x{3c5}\x{3c1}\x{3af}\x{3b1})(?!\p{L})"
#: Country codes of one and two digits; all others have three.
_CODES = (r"^[17]", r"^(?:2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])")
#: Given names by gender and script.
NAMES = {
    "f latin": "Ada Carla Elena Greta Ines Karin Lena Maria Nora Olga Petra Rosa Sara Tessa Vera Yvonne",
    "m latin": "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Luis Marco Oscar Paul Victor",
    "f cyrillic": "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Лариса Мария Нина Ольга Раиса Софья Тамара Юлия",
    "m cyrillic": "Антон Борис Виктор Глеб Денис Егор Захар Иван Кирилл Леонид Максим Никита Олег Павел Роман Степан",
    "f greek": "Αθηνά Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Ηλέκτρα Θάλεια Ιωάννα Καλλιόπη Λυδία Μαρία Νίκη Ξένια Ρέα Σοφία",
    "m greek": "Ανδρέας Βασίλης Γιώργος Δημήτρης Ευάγγελος Ζήνων Ηλίας Θανάσης Ιάσων Κώστας Λάμπρος Μιχάλης Νίκος Πέτρος Σπύρος Φώτης",
}
SYLLABLES = {
    "latin": "ba be di do fa ge ka ko la le ma mi na ne ro sa",
    "cyrillic": "ба ве ги да жо зе ка ли ма но па ро са ти фу хо",
    "greek": "βα γε δι ζο θα κε λι μα νο πα ρε σι τα φο χι ψα",
}


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _list(words: str) -> str:
    return f"split('{words}', ' ')"


def kind_of(mention: str) -> str:
    return f"""CASE WHEN contains({mention}, '@') THEN 'email' WHEN startswith({mention}, '+') THEN 'phone'
        WHEN {mention} rlike {_sql(f"^(?:{PATTERNS['ip']})$")} THEN 'ip'
        WHEN {mention} rlike {_sql(f"^(?:{_NATIONAL})$")} THEN 'phone'
        WHEN {mention} rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' THEN 'ssn'
        WHEN {mention} rlike '^[0-9]' THEN 'card' WHEN {mention} rlike {_sql(_FEMALE)} THEN 'f person' ELSE 'm person' END"""


def _code(digits: str) -> str:
    """How many digits the country code of a number has."""
    return f"CASE WHEN {digits} rlike '{_CODES[0]}' THEN 1 WHEN {digits} rlike '{_CODES[1]}' THEN 2 ELSE 3 END"


def canonical(mention: str) -> str:
    """Equal for all ways of writing one entity."""
    digits = f"regexp_replace({mention}, '[^0-9]', '')"
    return f"""CASE {kind_of(mention)} WHEN 'email' THEN lower({mention}) WHEN 'ip' THEN {mention}
        WHEN 'phone' THEN concat(if(startswith({mention}, '+'), {_code(digits)}, 0), ':', {digits})
        WHEN 'ssn' THEN {digits} WHEN 'card' THEN {digits}
        ELSE lower(regexp_replace({mention}, '^[^ ]+ ', '')) END"""


def entities_of(text: str) -> str:
    """All mentions from left to right, as kind, value (canonical) and mention."""
    return f"""transform(regexp_extract_all({text}, {_sql(ANY)}, 0), m -> struct(
        {kind_of('m')} AS kind, {canonical('m')} AS value, m AS mention))"""


def names_of(entity: str) -> str:
    """What has a surrogate of its own, as kind and value: a person's given name and surname, anything else as a whole."""
    surname = f"struct('surname' AS kind, substring_index({entity}.value, ' ', -1) AS value)"
    given = f"struct(concat(left({entity}.kind, 1), ' given') AS kind, substring_index({entity}.value, ' ', 1) AS value)"
    return f"""CASE WHEN NOT endswith({entity}.kind, ' person') THEN array(struct({entity}.kind AS kind, {entity}.value AS value))
        WHEN contains({entity}.value, ' ') THEN array({given}, {surname}) ELSE array({surname}) END"""


def _letter(place: str) -> str:
    """A number from 0 to 255 from the hash, by place."""
    return f"cast(conv(substr(hash, 2 * ({place} % 32) + 1, 2), 16, 10) AS int)"


def _like(text: str) -> str:
    """Every letter and digit replaced by one of the same script; other characters stay."""
    n = _letter("i")
    return f"""array_join(transform(split({text}, ''), (c, i) -> CASE
        WHEN c rlike '[0-9]' THEN cast({n} % 10 AS string)
        WHEN c rlike r'\\p{{IsCyrillic}}' THEN substr('абвгдежзиклмнопрстуфхцчшщыэюя', 1 + {n} % 29, 1)
        WHEN c rlike r'\\p{{IsGreek}}' THEN substr('αβγδεζηθικλμνξοπρστυφχψω', 1 + {n} % 24, 1)
        WHEN c rlike r'\\p{{L}}' THEN substr('abcdefghijklmnopqrstuvwxyz', 1 + {n} % 26, 1)
        ELSE c END), '')"""


def _digits(kept: str, value: str) -> str:
    """As many digits as the value has, its first ones kept, the others from the hash."""
    drawn = "concat(" + ", ".join(
        f"right(lpad(conv(substr(hash, {at}, 15), 16, 10), 18, '0'), 10)" for at in (1, 16, 31)
    ) + ")"
    return f"concat(substr({value}, 1, {kept}), substr({drawn}, 1, char_length({value}) - {kept}))"


def _person(value: str) -> str:
    """A name in the script of the value; a given name has the gender of the title, and is made up if the known are taken."""

    def name(script: str) -> str:
        syllables = _list(SYLLABLES[script])
        made_up = f"initcap(concat_ws('', transform(sequence(1, 4 + attempt), k -> {syllables}[{_letter('k')} % 16])))"
        given = f"if(kind = 'f given', {_list(NAMES['f ' + script])}, {_list(NAMES['m ' + script])})[{_letter('0')} % 16]"
        return f"if(kind = 'surname' OR attempt > 0, {made_up}, {given})"

    return f"""CASE WHEN {value} rlike r'\\p{{IsCyrillic}}' THEN {name('cyrillic')}
        WHEN {value} rlike r'\\p{{IsGreek}}' THEN {name('greek')} ELSE {name('latin')} END"""


def drawn(key: str) -> Column:
    """The surrogate of kind and value at an attempt, in canonical form."""
    phone = "substring_index(value, ':', -1)"
    code = "greatest(1, least(cast(substring_index(value, ':', 1) AS int), 3))"
    body = _digits("1", "value")
    luhn = f"""transform(array(left({body}, char_length(value) - 1)), b -> concat(b, if(luhn_check(value),
        filter(sequence(0, 9), c -> luhn_check(concat(b, c)))[0], {_letter('30')} % 10)))[0]"""
    at = "instr(value, '@')"
    domain = f"substr(value, {at})"
    suffix = f"concat('.', substring_index({domain}, '.', -1))"
    octets = ", ".join(_letter(str(i)) for i in range(4))
    sql = f"""transform(array(sha2(concat_ws('\\u0001', {_sql(key)}, kind, value, attempt), 256)), hash -> CASE kind
        WHEN 'email' THEN concat({_like(f"left(value, char_length(value) - char_length({suffix}))")}, {suffix})
        WHEN 'ip' THEN concat_ws('.', {octets})
        WHEN 'phone' THEN concat(substring_index(value, ':', 1), ':', {_digits(code, phone)})
        WHEN 'ssn' THEN {_digits('0', 'value')}
        WHEN 'card' THEN {luhn}
        ELSE {_person('value')} END)[0]"""
    return F.expr(sql)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """kind, value, surrogate: one to one within a kind, and no surrogate is a value that occurs.

    Of entities that draw alike the smallest value keeps the surrogate; the others, and those that draw a real
    value, draw again. Every round needs fewer; rounds are written.
    """
    values = written(entities.select("kind", "value").distinct(), "entities")
    taken = values.select("kind", F.lower("value").alias("low"), F.lit("").alias("owner"))
    done, open_ = None, values.withColumn("attempt", F.lit(0))
    while True:
        tried = open_.withColumn("surrogate", drawn(key))
        lows = tried.select("kind", F.lower("surrogate").alias("low"), F.col("value").alias("owner"))
        owners = lows.unionByName(taken).groupBy("kind", "low").agg(F.min("owner").alias("owner"))
        checked = written(
            tried.withColumn("low", F.lower("surrogate"))
            .join(owners, ["kind", "low"])
            .select("kind", "value", "attempt", "surrogate", (F.col("owner") == F.col("value")).alias("ok")),
            "surrogates",
        )
        good = checked.where("ok").select("kind", "value", "surrogate")
        done = good if done is None else done.unionByName(good)
        open_ = checked.where("NOT ok").select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
        if open_.isEmpty():
            return done
        taken = taken.unionByName(good.select("kind", F.lower("surrogate").alias("low"), F.lit("").alias("owner")))


def rendered(mention: str, kind: str, surrogate: str) -> str:
    """The surrogate as the mention is written: its separators, title and capitals."""
    digits = f"substring_index({surrogate}, ':', -1)"
    formatted = f"""array_join(transform(split({mention}, ''), (c, i) -> if(c rlike '[0-9]',
        substr({digits}, char_length(regexp_replace(substr({mention}, 1, i + 1), '[^0-9]', '')), 1), c)), '')"""
    return f"""CASE {kind} WHEN 'email' THEN if({mention} = upper({mention}), upper({surrogate}), {surrogate})
        WHEN 'ip' THEN {surrogate} WHEN 'f person' THEN concat(substring_index({mention}, ' ', 1), ' ', {surrogate})
        WHEN 'm person' THEN concat(substring_index({mention}, ' ', 1), ' ', {surrogate}) ELSE {formatted} END"""


def replace(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text with surrogates, n_entities (mentions), for every row.

    Texts without personal data take no part in any shuffle. Null texts stay null with 0 mentions; empty ones
    are empty. Rows that repeat id and text share their look-up and each get the result; null ids are matched
    null-safely. The table of surrogates of a text is as long as the text has entities, and no longer.
    """
    rows = plain(docs, id_col, text_col).withColumn("found", F.expr(f"coalesce({entities_of('text')}, array())"))
    clean = rows.where("size(found) = 0").select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"))
    marked = written(rows.where("size(found) > 0").withColumn("text_hash", F.xxhash64("text")), "private")
    mentions = marked.select("doc_id", "text_hash", F.explode("found").alias("e")).select(
        "doc_id", "text_hash", F.explode(F.expr(names_of("e"))).alias("name")
    ).select("doc_id", "text_hash", "name.kind", "name.value").distinct()
    known = surrogates(mentions, key)
    tables = (
        mentions.join(known, ["kind", "value"])
        .groupBy("doc_id", "text_hash")
        .agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(" ", "kind", "value"), "surrogate"))).alias("names"))
        .select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "names")
    )
    by_mention = f"array_join(transform({names_of('e')}, n -> element_at(names, concat_ws(' ', n.kind, n.value))), ' ')"
    text = f"""transform(array(split(text, {_sql(ANY)}, -1)), parts -> array_join(transform(parts, (p, i) -> concat(p,
        if(i >= size(found), '', transform(array(found[i]), e -> {rendered('e.mention', 'e.kind', by_mention)})[0]))), ''))[0]"""
    changed = (
        marked.join(tables, marked["doc_id"].eqNullSafe(tables["id"]) & (marked["text_hash"] == tables["hash"]))
        .select("doc_id", F.expr(text).alias("text"), F.size("found").cast("long").alias("n_entities"))
    )
    return clean.unionByName(changed)
