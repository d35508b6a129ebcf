"""PII surrogates in SQL expressions: no Python runs on the executors.

Detected: e-mail addresses, IBANs, SSNs, payment cards, phone numbers, IPv4 addresses, and personal names after a title, with
what else the same text holds of the whole name or its last word. Each gets a surrogate of its kind, keyed and the same wherever it occurs:

- letters and digits go through a keyed permutation (alternating Feistel rounds over the mixed radix of the entity's own letters
  and digits), so different entities get different surrogates; case, punctuation and length stay. The domain of an address
  is permuted apart from the local part and keeps its last label; a phone keeps its country code; a card keeps its
  first digit, and its Luhn validity; a valid IBAN keeps its country and gets the check digits of its new number; octets stay octets.
- names keep their title; a given name of the same gender and script comes from a list, surnames are built of syllables of the same
  script. A name's gender is decided once, from all titles it has in all documents: that of its titles, or neither where they differ or
  say nothing. So Mr. and Dr. John Smith are one entity with one surrogate. Where a text's own titles say something else, the
  decision is joined to the text by the text's digest.
- the distinct entities of all documents are checked both ways. While two of them share a surrogate, or a name's surrogate is some
  document's own name, the level rises, which lengthens surnames and given names and changes the permutations; a level has 32 times the
  surnames of the one before. An entity with two surrogates, or names that collide at the last level (their keyed hashes are equal;
  another key helps), raise ValueError.

Edge cases: a null text stays null; an empty one and those without entities stay as they are, byte for byte; repeated rows get the
same text; a text of any length is read whole; an empty table gives an empty result; order and ties don't matter, a surrogate depends on
its entity alone; other columns pass through; column names that clash with the ones made here are kept under their own name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.storage import durable, release, table, unused

KEY = "quern"
#: Given names by script and gender; surnames' syllables by script.
_GIVEN = {
    ("latin", "m"): "Adam Albert Anton Bruno Carl Daniel David Emil Erik Felix Frank Georg Hugo Ivan Jakob Jan Karl Leo Lucas Marco Martin Max Milan Nils Oscar Paul Peter Rafael Simon Stefan Thomas Viktor",
    ("latin", "f"): "Ada Alice Anna Bella Carla Clara Diana Elena Ella Emma Eva Flora Frida Greta Helena Ida Irma Julia Karin Laura Lena Lucia Maria Marta Mila Nina Nora Olga Paula Rosa Sara Vera",
    ("latin", "n"): "Alex Andrea Ariel Ash Bela Blair Cameron Casey Charlie Chris Dana Eden Elis Finley Jamie Jules Kai Kim Kit Lee Lou Max Nico Noa Quinn Robin Sam Sasha Sky Taylor Toni Val",
    ("cyrillic", "m"): "Антон Борис Вадим Виктор Глеб Денис Егор Иван Игорь Илья Кирилл Лев Максим Марк Олег Павел",
    ("cyrillic", "f"): "Алла Анна Вера Галина Дарья Елена Зоя Инна Ирина Лариса Лидия Мария Нина Ольга Раиса Софья",
    ("cyrillic", "n"): "Саша Женя Валя Слава Шура Паша Тоня Мила Лёля Ника Рита Тася Юля Яна Лада Рада",
    ("greek", "m"): "Άγγελος Γιώργος Δημήτρης Κώστας Λευτέρης Μανώλης Νίκος Πέτρος",
    ("greek", "f"): "Άννα Βασιλική Γεωργία Δέσποινα Ελένη Ιωάννα Κατερίνα Μαρία",
    ("greek", "n"): "Αλέξης Άρης Γιάννης Δάφνη Ηλέκτρα Θάλεια Κλειώ Φοίβος",
}
_SYLLABLES = {
    "latin": "ba be bo da do fa ga go ha ja ka ko la le lo ma mi mo na ne no pa ra ri ro sa se ta ti to va vo",
    "cyrillic": "ба бо ва ве га го да до за зо ка ко ла ло ма ми мо на не но па по ра ри ро са со та ти то ха хо",
    "greek": "βα βο γα γο δα δο ζα κα κο λα λε λο μα μι μο να νε νο πα πο ρα ρι ρο σα σε σο τα τι το φα χα χο",
}
_MALE = ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Signor", "Г-н", "Господин", "Κύριος")
_FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Señorita", "Sra", "Srta", "Signora", "Г-жа", "Госпожа", "Κυρία")
_EITHER = ("Dr", "Prof")

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLE = "|".join(sorted((*_MALE, *_FEMALE, *_EITHER), key=len, reverse=True))
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])"
IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
CARD = r"(?<!\w)(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?!\w)"
PHONE = r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\w)|(?<!\w)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])"
IPV4 = rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)"
NAME = rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE})\.? \p{{Lu}}[\p{{L}}'’-]++(?: \p{{Lu}}[\p{{L}}'’-]++){{0,2}}"
#: Most positions of a text fail at the first test of this.
PATTERN = rf"(?=[0-9+(])(?:{IBAN}|{SSN}|{CARD}|{PHONE}|{IPV4})|{EMAIL}|(?=[A-ZГΚ])(?:{IBAN}|{NAME})"
#: Holds of every text with a name that PATTERN finds.
TITLED = rf"(?=[A-ZГΚ])(?<![\p{{L}}\p{{N}}])(?:{_TITLE})\.? \p{{Lu}}"
KINDS = ("email", "iban", "ssn", "card", "phone", "ip", "name")


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, body: str) -> str:
    """SQL: body with name standing for value."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _hash(key: str, tag: str, *values: str) -> str:
    """60 keyed bits."""
    said = ", ".join(f"cast({v} as string)" for v in values)
    return f"cast(conv(substr(sha2(concat_ws('|', {_text(key)}, {_text(tag)}, {said}), 256), 1, 15), 16, 10) as bigint)"


def _moved(body: str, tag: str, key: str) -> str:
    """SQL: body with its letters and digits (octets, if tag is 'ip') moved by a keyed permutation; case and other signs stay.

    Up to 24 of them go through Feistel rounds between two halves, each a number in the mixed radix of its signs, so different bodies of
    a form stay different; the rest is shifted by a stream from these.
    """
    tokens = f"regexp_extract_all({body}, if({tag} = 'ip', '[0-9]+|[.]', '(?s).'), 0)"
    is_sign = "rlike '^[0-9A-Za-z]+$'"
    value = f"case when t rlike '^[0-9]' then cast(t as bigint) when t rlike '^[a-z]' then ascii(t) - 97L else ascii(t) - 65L end"
    radix = f"case when {tag} = 'ip' then 256L when t rlike '^[0-9]' then 10L else 26L end"
    signs = f"transform(filter(ts, t -> t {is_sign}), t -> struct({value} as x, {radix} as r))"
    halves = "transform(array(slice(sg, 1, cast(least(size(sg), 24) div 2 as int)), slice(sg, cast(least(size(sg), 24) div 2 as int) + 1, cast((least(size(sg), 24) + 1) div 2 as int))), h -> struct(h as h, aggregate(h, struct(0L as n, 1L as p), (s, d) -> struct(s.n * d.r + d.x as n, s.p * d.r as p)) as m))"
    turn = _let(_hash(key, "i", tag, "i", "if(i % 2 = 0, s.v, s.u)"), "k", "if(i % 2 = 0, struct(pmod(s.u + k, hs[0].m.p) as u, s.v as v), struct(s.u as u, pmod(s.v + k, hs[1].m.p) as v))")
    rounds = f"aggregate(sequence(0, 7), struct(hs[0].m.n as u, hs[1].m.n as v), (s, i) -> {turn})"
    digits = "flatten(transform(hs, (h, j) -> aggregate(reverse(h.h), struct(if(j = 0, uv.u, uv.v) as q, cast(array() as array<bigint>) as o), (s, d) -> struct(s.q div d.r as q, concat(array(s.q % d.r), s.o) as o)).o))"
    rest = f"transform(slice(sg, 25, greatest(size(sg) - 24, 0)), (d, i) -> pmod(d.x + {_hash(key, 'rest', tag, 'uv.u', 'uv.v', 'i')}, d.r))"
    put = f"if(t {is_sign}, struct(concat(s.o, case when t rlike '^[0-9]' then cast(nv[s.i] as string) when t rlike '^[a-z]' then char(97 + nv[s.i]) else char(65 + nv[s.i]) end) as o, s.i + 1 as i), struct(concat(s.o, t) as o, s.i as i))"
    woven = f"aggregate(ts, struct('' as o, 0 as i), (s, t) -> {put}).o"
    return _let(tokens, "ts", _let(signs, "sg", _let(halves, "hs", _let(rounds, "uv", _let(f"concat({digits}, {rest})", "nv", woven)))))


def _luhn(number: str) -> str:
    """SQL: the check digit for the digits of a number that come before it."""
    doubled = f"transform(reverse(regexp_extract_all({number}, '[0-9]', 0)), (x, i) -> if(i % 2 = 0, if(2 * x > 9, 2 * x - 9, 2 * x), cast(x as double)))"
    return f"pmod(0 - cast(aggregate({doubled}, 0D, (n, x) -> n + x) as bigint), 10L)"


def _parts(m: str) -> str:
    """SQL: array of (what stays before, what moves, what stays after, the permutation's tag) for the kind kd."""
    row = lambda before, body, after, tag: f"struct({before} as b, {body} as m, {after} as a, {tag} as tag)"
    domain = _let(f"substring_index({m}, '@', -1)", "dm", _let("length(dm) - length(substring_index(dm, '.', -1)) - 1", "n", row("'@'", "left(dm, n)", "substr(dm, n + 1)", "'domain'")))
    code = f"if(kd = 'phone', length(regexp_extract({m}, '^\\\\+(?:1|7|[2-9]\\\\d)', 0)), case kd when 'iban' then 2 when 'card' then 1 else 0 end)"
    number = _let(code, "n", row(f"left({m}, n)", f"substr({m}, n + 1, length({m}) - n - if(kd = 'card', 1, 0))", "''", "kd"))
    return f"if(kd = 'email', array({row(_text(''), f'substring_index({m}, {_text("@")}, 1)', _text(''), _text('local'))}, {domain}), array({number}))"


def _chosen(kind: str, script: str, gender: str, word: str, key: str, times: int, between: str) -> str:
    """SQL: `times` words of the list for script (and gender), each chosen by other bits, put together."""
    if kind == "given":
        branches = " ".join(f"when '{s}{g}' then split({_text(words)}, ' ')" for (s, g), words in _GIVEN.items())
        listed = f"case concat({script}, {gender}) {branches} end"
    else:
        listed = f"case {script} " + " ".join(f"when '{s}' then split({_text(words)}, ' ')" for s, words in _SYLLABLES.items()) + " end"
    pick = f"element_at(ls, cast({_hash(key, kind, gender if kind == 'given' else _text(''), 'k', f'lower({word})')} % size(ls) as int) + 1)"
    return _let(listed, "ls", f"array_join(transform(sequence(1, {times}), k -> {pick}), {_text(between)})")


def _title(m: str) -> str:
    return f"regexp_extract({m}, {_text(f'^(?:{_TITLE})[.]? ')}, 0)"


def title_gender(m: str) -> str:
    """SQL: m, f or n by the title of a name."""
    of = lambda titles: f"rtrim('. ', {_title(m)}) in ({', '.join(map(_text, titles))})"
    return f"case when {of(_MALE)} then 'm' when {of(_FEMALE)} then 'f' else 'n' end"


def _name(m: str, key: str, level: int, gender: str | None) -> str:
    title, gender = _title(m), gender or title_gender(m)
    script = "case when w rlike '^[\\u0400-\\u04FF]' then 'cyrillic' when w rlike '^[\\u0370-\\u03FF\\u1F00-\\u1FFF]' then 'greek' else 'latin' end"
    last, first = f"initcap({_chosen('surname', 'sc', 'ge', 'w', key, 3 + level, '')})", _chosen("given", "sc", "ge", "w", key, 1 + level, "-")
    made = _let(script, "sc", _let(f"if(j = size(ws) - 1, {last}, {first})", "mw", "if(length(w) > 1 and w = upper(w), upper(mw), mw)"))
    words = f"split(substr({m}, length(ti) + 1), ' ')"
    return _let(title, "ti", _let(gender, "ge", _let(words, "ws", f"concat(ti, array_join(transform(ws, (w, j) -> {made}), ' '))")))


def kind_of(m: str) -> str:
    """SQL: the kind of a match."""
    return (
        f"case when contains({m}, '@') then 'email' when {m} rlike '^[A-Z]{{2}}[0-9]{{2}}' then 'iban' when {m} rlike '^[^0-9+(]' then 'name' "
        f"when {m} rlike {_text('^' + SSN + '$')} then 'ssn' when {m} rlike '^[0-9]+([.][0-9]+){{3}}$' then 'ip' "
        f"when {m} rlike '^[0-9]' and length(regexp_replace({m}, '[^0-9]', '')) >= 13 then 'card' else 'phone' end"
    )


def _mod97(number: str) -> str:
    """SQL: an account number (letters count 10 to 35) modulo 97."""
    step = "case when c rlike '[0-9]' then (s * 10 + cast(c as bigint)) % 97 else (s * 100 + ascii(c) - 55) % 97 end"
    return f"aggregate(regexp_extract_all({number}, '[0-9A-Z]', 0), 0L, (s, c) -> {step})"


def _iban(m: str, moved: str) -> str:
    """SQL: moved, but with check digits that make it valid if m is valid."""
    valid = f"{_mod97(f'concat(substr({m}, 5), left({m}, 4))')} = 1"
    return f"if({valid}, concat(left({m}, 2), lpad(cast(98 - {_mod97(f'concat(substr({moved}, 5), left({m}, 2), {_text("00")})')} as string), 2, '0'), substr({moved}, 5)), {moved})"


def surrogate(m: str, key: str = KEY, level: int = 0, gender: str | None = None) -> str:
    """SQL: the surrogate of the match that the SQL expression m stands for; gender: SQL for a name's, its title's by default."""
    key = f"{key}/{level}" if level else key
    moved = f"array_join(transform({_parts(m)}, p -> concat(p.b, {_moved('p.m', 'p.tag', key)}, p.a)), '')"
    checked = f"concat(o, cast(pmod({_luhn('o')} + cast(right({m}, 1) as bigint) - {_luhn(f'left({m}, length({m}) - 1)')}, 10L) as string))"
    valid = f"case kd when 'card' then {checked} when 'iban' then {_iban(m, 'o')} else o end"
    return _let(kind_of(m), "kd", f"if(kd = 'name', {_name(m, key, level, gender)}, {_let(moved, 'o', valid)})")


def canonical(m: str) -> str:
    """SQL: the same for all spellings of an entity."""
    return f"case {kind_of(m)} when 'email' then lower({m}) when 'name' then lower(regexp_replace({m}, {_text(f'^(?:{_TITLE})[.]? ')}, '')) when 'ip' then {m} else regexp_replace({m}, '[^0-9A-Za-z]', '') end"


def mentions(docs: DataFrame, column: str = "text") -> DataFrame:
    """The distinct entities of each distinct text: digest of the text, entity, kind, own (the same for all its spellings), gender by title."""
    found = docs.select(F.md5(column).alias("digest"), F.explode(F.regexp_extract_all(F.col(column), F.lit(PATTERN), F.lit(0))).alias("entity")).distinct()
    named = found.withColumn("kind", F.expr(kind_of("entity"))).withColumn("own", F.expr(canonical("entity")))
    return named.withColumn("gender", F.when(F.col("kind") == "name", F.expr(title_gender("entity"))))


def genders(found: DataFrame) -> DataFrame:
    """own, decided: the gender of each name, from all its titles."""
    said = lambda g: F.max(F.col("gender") == g)
    decided = F.when(said("m") & ~said("f"), "m").when(said("f") & ~said("m"), "f").otherwise("n")
    return found.where("kind = 'name'").groupBy("own").agg(decided.alias("decided"))


def surrogates(found: DataFrame, key: str, level: int) -> DataFrame:
    """kind, own and made (the same for all spellings) of the distinct entities among mentions."""
    each = found.select("kind", "entity", "own").distinct().join(genders(found), "own", "left")
    return each.select("kind", "own", F.expr(surrogate("entity", key, level, "decided")).alias("_m")).select("kind", "own", F.expr(canonical("_m")).alias("made"))


def collisions(made: DataFrame) -> DataFrame:
    """Surrogates that stand for several entities, and names' surrogates that are names themselves."""
    twice = made.groupBy("kind", "made").agg(F.min("own").alias("_a"), F.max("own").alias("_b")).where("_a != _b").select("kind", "made")
    names = made.where("kind = 'name'")
    return twice.union(names.select("kind", "made").join(names.select(F.col("own").alias("made")), "made", "left_semi").select("kind", "made"))


def torn(made: DataFrame) -> DataFrame:
    """Entities that have several surrogates."""
    return made.groupBy("kind", "own").agg(F.min("made").alias("_a"), F.max("made").alias("_b")).where("_a != _b").select("kind", "own")


def level_for(found: DataFrame, key: str = KEY, most: int = 9) -> int:
    """The lowest level without collisions among all mentions (of mentions())."""
    for level in range(most + 1):
        parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        made = durable(surrogates(found.repartition(parts, "own"), key, level))  # spread by entities: the work isn't in the bytes
        if not (lost := torn(made)).isEmpty():
            raise ValueError(f"{lost.first()} has several surrogates")
        clear = collisions(made).isEmpty()
        release(made)
        if clear:
            return level
    raise ValueError(f"surrogates still collide at level {most}; take another key")


def decided_in(docs: DataFrame, found: DataFrame, column: str = "text", out: str = "_genders") -> DataFrame:
    """docs with a map of own to the decided gender, for the names of a text whose titles there don't say the same."""
    names = found.where("kind = 'name'").select("digest", "own", "gender")
    other = names.join(genders(found), "own").where("gender != decided").select("digest", "own", "decided").distinct()
    maps = other.groupBy("digest").agg(F.map_from_entries(F.collect_list(F.struct("own", "decided"))).alias(out))
    own = unused("_digest", docs)
    some, rest = docs.where(F.col(column).rlike(TITLED)), docs.where(~F.coalesce(F.col(column).rlike(TITLED), F.lit(False)))
    # only texts with a title are shuffled, and always so, whatever the size
    named = some.withColumn(own, F.md5(column)).join(maps.withColumnRenamed("digest", own).hint("merge"), own, "left").drop(own)
    return named.unionByName(rest.withColumn(out, F.lit(None).cast("map<string,string>")))


def _mentions(found: str, made: str) -> str:
    """SQL: array of (what stands in the text without a title, its surrogate) for the names among the matches found, longest first."""
    names = f"filter(zip_with({found}, {made}, (m, s) -> struct(split(m, ' ') as m, split(s, ' ') as s, {kind_of('m')} as k)), x -> x.k = 'name')"
    bare = lambda w: f"regexp_replace({w}, {_text(chr(91) + chr(39) + chr(8217) + ']s$|[' + chr(39) + chr(8217) + '-]+$')}, '')"
    whole = lambda w: f"array_join(slice({w}, 2, size({w}) - 1), ' ')"
    both = f"flatten(transform({names}, x -> array(struct({bare(whole('x.m'))} as w, {bare(whole('x.s'))} as s), struct({bare('element_at(x.m, -1)')} as w, {bare('element_at(x.s, -1)')} as s))))"
    return f"transform(array_sort(array_distinct(transform(filter({both}, e -> length(e.w) > 1), e -> struct(-length(e.w) as l, e.w as w, e.s as s)))), e -> struct(e.w as w, e.s as s))"


def _reworded(p: str) -> str:
    """SQL: the text p, which holds no match, with the mentions ms replaced in one pass."""
    pattern = "concat('(?<![\\\\p{L}\\\\p{N}])(?:', array_join(transform(ms, e -> e.w), '|'), ')(?![\\\\p{L}\\\\p{N}])')"
    found = f"transform(regexp_extract_all({p}, pt, 0), w -> element_at(filter(ms, e -> e.w = w), 1).s)"
    return _let(pattern, "pt", f"array_join(flatten(zip_with(split({p}, pt, -1), concat({found}, array('')), (a, b) -> array(a, b))), '')")


def replaced(docs: DataFrame, key: str = KEY, level: int = 0, column: str = "text", out: str = "_matches", decided: str | None = None) -> DataFrame:
    """docs with surrogates in their texts, and the matches in the column out; decided: a column of decided_in(). No shuffle."""
    matches = F.regexp_extract_all(F.col(column), F.lit(PATTERN), F.lit(0))
    parts = f"split({column}, {_text(PATTERN)}, -1)"
    between = _let(_mentions(out, "su"), "ms", f"if(size(ms) = 0, {parts}, transform({parts}, p -> {_reworded('p')}))")
    gender = f"coalesce(element_at({decided}, {canonical('m')}), {title_gender('m')})" if decided else None
    woven = _let(f"transform({out}, m -> {surrogate('m', key, level, gender)})", "su", f"array_join(flatten(zip_with({between}, concat(su, array('')), (p, s) -> array(p, s))), '')")
    return docs.withColumn(out, matches).withColumn(column, F.when(F.size(out) > 0, F.expr(woven)).otherwise(F.col(column)))


def anonymised(docs: DataFrame, key: str = KEY, column: str = "text", out: str = "_matches") -> DataFrame:
    """docs with surrogates in their texts, checked over all of them, and the matches in the column out."""
    found = durable(mentions(docs, column))
    level = level_for(found, key)
    own = unused("_genders", docs)
    return replaced(decided_in(docs, found, column, own), key, level, column, out, own).drop(own)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: every whole text with surrogates, and how many entities of each kind it had."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kinds = anonymised(docs).withColumn("_kinds", F.expr(f"transform(_matches, m -> {kind_of('m')})"))
    counts = [F.expr(f"coalesce(size(filter(_kinds, k -> k = '{k}')), 0)").alias(f"n_{k}") for k in KINDS]
    return kinds.select("doc_id", "text", F.coalesce(F.size("_kinds"), F.lit(0)).alias("n_entities"), *counts)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in their texts; n_chars follows the text."""
    own = unused("_matches", docs)
    made = anonymised(docs, out=own).drop(own)
    return made.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))).select(*docs.columns)
