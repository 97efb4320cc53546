"""Surrogates for personal data, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlelens.llm.common import cut, text_key

_NAME = r"\p{Lu}[\p{L}'’-]+"
# M is a title only with a point.
_HE, _SHE, _ANY = r"Mr|Herr|Monsieur|M(?=\.)|Señor|Sr|Г-н", r"Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Srta|Sra|Г-жа", r"Dr|Prof"

_SECRET = r"(?i:password|passwd|pwd|secret|token|api_key|apikey|access_key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?"

# Kind, and the pattern of its entities, in the order in which they are tried. Conditions of one
# character stand before the lookbehinds that imply them, so that few places try these; a mail begins where its characters do.
KINDS = [
    ("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    ("secret", rf"(?<=[=:\s\"'])(?<=[=:]\s{{0,3}}[\"']?)(?<={_SECRET})[^\s\"',;=:]{{6,}}"),
    ("key", r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36}\b|\bsk-[A-Za-z0-9]{20,}\b"),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("phone", r"(?<![\w+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![\w])|(?<![\w(])\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}\b|(?<![\w.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![\w.-])"),
    ("ssn", r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    ("card", r"(?<![\w-])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,4}(?![\w-])"),
    ("ip", r"(?<![\w.])(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}(?![\w]|\.[0-9])"),
    ("he", rf"(?=\p{{Lu}})(?<=\b(?:{_HE})\.? ){_NAME}(?: {_NAME}){{0,2}}"),
    ("she", rf"(?=\p{{Lu}})(?<=\b(?:{_SHE})\.? ){_NAME}(?: {_NAME}){{0,2}}"),
    ("they", rf"(?=\p{{Lu}})(?<=\b(?:{_ANY})\.? ){_NAME}(?: {_NAME}){{0,2}}"),
]
# What each kind needs somewhere in the text; no entity lies in a text without one of these.
NEEDS = {"email": "@", "secret": _SECRET, "key": "AKIA|ASIA|gh[pousr]_|sk-", "iban": "[0-9]", "phone": "[0-9]", "ssn": "[0-9]", "card": "[0-9]", "ip": "[0-9]",
         "he": rf"\b(?:{_HE})\.? \p{{Lu}}", "she": rf"\b(?:{_SHE})\.? \p{{Lu}}", "they": rf"\b(?:{_ANY})\.? \p{{Lu}}"}
GATE = "|".join(dict.fromkeys(NEEDS.values()))
ALL = "|".join(f"(?:{p})" for _, p in KINDS)

# Syllables of invented names, by script.
SYLLABLES = {
    "latin": "ba be bi bo bra da de di do dra fa fe fi ga ge gi go ha he ja jo ka ke ki ko la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se si so sta ta te ti to tra va ve vi za zo".split(),
    "cyrillic": "ба бе би бо бра ва ве ви во га ге го да де ди до дра жа за зо ка ке ки ко ла ле ли ло ма ме ми мо на не ни но па пе ра ре ри ро са се си со ста та те ти то тра фа фе ха хо ша".split(),
    "greek": "βα βε βι βο γα γε γι δα δε δι δο ζα ζε θα θε κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο πα πε πι πο ρα ρε ρι ρο σα σε σι σο τα τε τι το φα φε φι χα χε χι".split(),
}
# Endings of given names, by script: for him, for her.
ENDINGS = {"latin": (["n", "s", "r", "k"], ["a", "ia", "na", "ella"]), "cyrillic": (["н", "р", "й", "к"], ["а", "я", "на", "ия"]),
           "greek": (["ς", "ος", "ης", "ας"], ["α", "η", "ια", "νη"])}
MAX_ROUNDS = 40


def kind_of(entity: Column) -> Column:
    """What a match of ``ALL`` is, by its shape; secrets have any shape, and names of no title but a
    person's: both are told by what stands before them."""
    out = F.when(entity.rlike(rf"^(?:{KINDS[0][1]})$"), "email")
    for kind, pattern in KINDS:
        if kind in ("key", "iban", "phone", "ssn", "card", "ip"):
            out = out.when(entity.rlike(rf"^(?:{pattern})$"), kind)
    return out


def with_entities(df: DataFrame, text: str, found: str, gaps: str) -> DataFrame:
    """Adds ``found``, all entities of a text in order as ``(kind, entity)``, and ``gaps``,
    what stands before, between and after them; both null for a null text."""
    df = df.withColumns({found: F.regexp_extract_all(text, F.lit(f"({ALL})"), F.lit(1)), gaps: F.split(text, ALL, -1)})
    # What decides the kind is near the entity: titles are short.
    df = df.withColumn(gaps + "_ends", F.transform(gaps, lambda x: F.substr(x, F.greatest(F.char_length(x) - 12, F.lit(1)))))
    titled = lambda titles, i: F.get(gaps + "_ends", i).rlike(rf"\b(?:{titles})\.? $")
    kind = lambda x, i: F.coalesce(
        F.when(titled(_HE, i), "he").when(titled(_SHE, i), "she").when(titled(_ANY, i), "they"), kind_of(x), F.lit("secret"))
    df = df.withColumn(found, F.transform(found, lambda x, i: F.struct(kind(x, i).alias("kind"), x.alias("entity")))).drop(gaps + "_ends")
    return with_repeats(df, found, gaps)


def with_repeats(df: DataFrame, found: str, gaps: str) -> DataFrame:
    """Names of two or more words that stand behind a title somewhere in the text
    are entities wherever else they stand in it, of the kind of the first such place."""
    names, pattern, kinds = found + "_names", found + "_pattern", found + "_kinds"
    person = lambda x: x["kind"].isin("he", "she", "they") & F.contains(x["entity"], F.lit(" "))
    df = df.withColumn(names, F.filter(found, person))
    # Longer names first: of names that begin alike the longest counts.
    longest = F.array_sort(F.array_distinct(F.transform(names, lambda x: x["entity"])), lambda a, b: F.char_length(b) - F.char_length(a))
    quoted = F.transform(longest, lambda x: F.concat(F.lit(r"\Q"), x, F.lit(r"\E")))
    first = F.array_distinct(F.transform(names, lambda x: x["entity"]))
    df = df.withColumns({
        pattern: F.when(F.size(names) > 0, F.concat(F.lit(r"(?<![\p{L}'’-])("), F.array_join(quoted, "|"), F.lit(r")(?![\p{L}'’-])"))),
        kinds: F.map_from_arrays(first, F.transform(first, lambda e: F.get(F.filter(names, lambda x: x["entity"] == e), F.lit(0))["kind"]))})
    bare = lambda g: F.transform(F.regexp_extract_all(g, F.col(pattern), F.lit(1)), lambda e: F.struct(F.col(kinds)[e].alias("kind"), e.alias("entity")))
    more = F.flatten(F.transform(gaps, lambda g, i: F.when(i < F.size(found), F.concat(bare(g), F.slice(found, i + 1, 1))).otherwise(bare(g))))
    apart = F.flatten(F.transform(gaps, lambda g: F.split(g, F.col(pattern), -1)))
    return df.withColumns({found: F.when(F.col(pattern).isNull(), F.col(found)).otherwise(more),
                           gaps: F.when(F.col(pattern).isNull(), F.col(gaps)).otherwise(apart)}).drop(names, pattern, kinds)


def _digest(key: str, *parts: Column) -> Column:
    """128 hex digits that only the holder of ``key`` can compute."""
    inner = F.sha2(F.concat_ws("\x1f", F.lit(key + ":inner"), *parts), 512)
    return F.sha2(F.concat(F.lit(key + ":outer"), inner), 512)


def _number(digest: Column, i: Column | int, below: int) -> Column:
    """A number under ``below`` from the digest's digits at ``i``."""
    at = (F.lit(i) if isinstance(i, int) else i) * 3 % 120 + 1
    return F.conv(F.substr(digest, at, F.lit(6)), 16, 10).cast("int") % below


def _letters(text: Column, digest: Column, hexadecimal: Column) -> Column:
    """Digits for digits and letters for letters of the same case; the rest stays. Non-ASCII letters stay as they are."""
    def swap(c: Column, i: Column) -> Column:
        pick = lambda alphabet: F.substr(F.lit(alphabet), _number(digest, i, len(alphabet)) + 1, F.lit(1))
        return (F.when(c.between("0", "9"), pick("0123456789"))
                .when(c.between("a", "z"), F.when(hexadecimal, pick("abcdef")).otherwise(pick("abcdefghijklmnopqrstuvwxyz")))
                .when(c.between("A", "Z"), F.when(hexadecimal, pick("ABCDEF")).otherwise(pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))).otherwise(c))

    return F.array_join(F.transform(F.split(text, ""), swap), "")


def _name(key: str, kind: Column, name: Column, attempt: Column) -> Column:
    """Word by word: the last is a family name, the same whoever bears it, those
    before are given names with one stem for all genders and the ending of theirs, all in the script of the word."""
    words = F.split(name, " ")

    def one(word: Column, i: Column) -> Column:
        given = i < F.size(words) - 1
        digest = _digest(key, F.when(given, "given").otherwise("family"), word, attempt.cast("string"))

        def spelled(script: str) -> Column:
            s, (him, her) = SYLLABLES[script], ENDINGS[script]
            part = lambda k: F.element_at(F.array(*map(F.lit, s)), _number(digest, k, len(s)) + 1)
            end = lambda xs: F.element_at(F.array(*map(F.lit, xs)), _number(digest, 30, len(xs)) + 1)
            last = F.when(given & (kind == "she"), end(her)).when(given & (kind == "he"), end(him)).otherwise(part(4))
            return F.concat(part(0), part(1), F.when(F.char_length(word) > 6, F.concat(part(2), part(3))).otherwise(part(2)), last)

        text = F.when(word.rlike(r"^\p{IsCyrillic}"), spelled("cyrillic")).when(word.rlike(r"^\p{IsGreek}"), spelled("greek")).otherwise(spelled("latin"))
        return F.when(F.upper(word) == word, F.upper(text)).otherwise(F.concat(F.upper(F.substr(text, F.lit(1), F.lit(1))), F.substr(text, F.lit(2))))

    return F.array_join(F.transform(words, one), " ")


def _card(card: Column) -> Column:
    """The number with the last digit that makes its check sum (every second digit from the right doubled) a multiple of ten."""
    body = F.substr(card, F.lit(1), F.char_length(card) - 1)
    digits = F.reverse(F.split(F.regexp_replace(body, "[^0-9]", ""), ""))
    worth = F.transform(digits, lambda d, i: F.when(i % 2 == 1, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    total = F.aggregate(worth, F.lit(0), lambda a, x: a + x)
    return F.concat(body, ((F.lit(10) - total % 10) % 10).cast("string"))


def _iban(iban: Column) -> Column:
    """The number with the two check digits that make the account, country and digits leave 1 over 97 (letters count from 10)."""
    lead, account = F.substr(iban, F.lit(1), F.lit(2)), F.substr(iban, F.lit(5))
    signs = F.split(F.regexp_replace(F.concat(account, lead), "[^0-9A-Z]", ""), "")
    step = lambda a, c: F.when(c.between("0", "9"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    left = F.aggregate(signs, F.lit(0), step) * 100 % 97
    return F.concat(lead, F.lpad((F.lit(98) - left).cast("string"), 2, "0"), account)


def surrogate(key: str, kind: Column, entity: Column, attempt: Column) -> Column:
    """A value of the same kind and format: the mail's domain keeps its last label and is the same for the same
    domain, a phone its country code, a card its first digit, an account its country, both with valid check digits,
    an address four numbers in range. Names keep script, case, number of words and the gender of their title."""
    digest = _digest(key, kind, entity, attempt.cast("string"))
    no = F.lit(False)
    local, domain = F.substring_index(entity, "@", 1), F.substring_index(entity, "@", -1)
    host = F.substr(domain, F.lit(1), F.char_length(domain) - F.char_length(F.substring_index(domain, ".", -1)))
    mail = F.concat(_letters(local, digest, no), F.lit("@"), _letters(host, _digest(key, F.lit("domain"), F.lower(domain)), no), F.substring_index(domain, ".", -1))
    lead = F.regexp_extract(entity, r"^(?:AKIA|ASIA|gh[pousr]_|sk-|[A-Z]{2}(?=[0-9]{2})|\+[0-9]{1,3}(?=[ .(-])|[0-9](?=[0-9]{3}))", 0)
    fixed = F.when(kind.isin("key", "iban", "phone", "card"), lead).otherwise("")
    rest = F.substr(entity, F.char_length(fixed) + 1)
    ip = F.concat_ws(".", *((_number(digest, k, 254) + 1).cast("string") for k in range(4)))
    return (F.when(kind == "email", mail).when(kind == "ip", ip).when(kind.isin("he", "she", "they"), _name(key, kind, entity, attempt))
            .when(kind == "card", _card(F.concat(fixed, _letters(rest, digest, no)))).when(kind == "iban", _iban(F.concat(fixed, _letters(rest, digest, no))))
            .otherwise(F.concat(fixed, _letters(rest, digest, (kind == "secret") & entity.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")))))


def _family(kind: Column) -> Column:
    """Names of all genders are told apart from each other, other kinds each on their own."""
    return F.when(kind.isin("he", "she", "they"), "name").otherwise(kind)


def resolve(found: DataFrame, key: str) -> DataFrame:
    """``kind, entity, as_kind, attempt`` of the entities that do not get the first surrogate of their kind.

    A name behind a title that tells no gender is that of the one gender with which it occurs elsewhere, if there is just one: the
    same person, so ``as_kind`` differs. The others' first surrogate is taken, by an entity of the corpus or by the
    surrogate of a smaller entity; they try again, with another digest, until each has one of its own."""
    distinct = cut(found.select("kind", "entity").distinct(), "entities-by-kind")
    genders = distinct.where(F.col("kind").isin("he", "she")).groupBy(F.col("entity").alias("__e")).agg(F.min("kind").alias("__least"), F.max("kind").alias("__most"))
    told = distinct.where("kind = 'they'").join(genders.where("__least = __most"), F.col("entity") == F.col("__e")).select("kind", "entity", F.col("__least").alias("as_kind"))
    told = cut(told, "told")
    everything = cut(distinct.join(told, ["kind", "entity"], "left_anti"), "entities")
    real = everything.select(_family(F.col("kind")).alias("family"), F.col("entity").alias("own")).distinct()
    settled, waiting, attempt = None, everything, 0
    moved = []
    while True:
        tried = waiting.select("kind", "entity", surrogate(key, F.col("kind"), F.col("entity"), F.lit(attempt)).alias("own"), _family(F.col("kind")).alias("family"))
        tried = cut(tried, f"surrogates-{attempt}")
        best = tried.groupBy("family", "own").agg(F.min(F.struct("kind", "entity")).alias("x")).select("family", "own", "x.kind", "x.entity")
        good = best.join(real, ["family", "own"], "left_anti")
        if settled is not None:
            good = good.join(settled, ["family", "own"], "left_anti")
        good = cut(good, f"settled-{attempt}")
        waiting = cut(tried.join(good, ["kind", "entity"], "left_anti").select("kind", "entity"), f"waiting-{attempt}")
        if attempt:
            moved.append(good.select("kind", "entity", F.lit(attempt).alias("attempt")))
        if not waiting.limit(1).count():
            break
        taken = good.select("family", "own")
        settled = taken if settled is None else settled.unionByName(taken)
        attempt += 1
        if attempt > MAX_ROUNDS:
            raise RuntimeError("the space of surrogates is too small for these entities")
    out = everything.select("kind", "entity", F.lit(0).alias("attempt")).limit(0) if not moved else moved[0]
    for more in moved[1:]:
        out = out.unionByName(more)
    same = told.join(out.select(F.col("kind").alias("as_kind"), "entity", "attempt"), ["as_kind", "entity"], "left")
    return out.withColumn("as_kind", F.col("kind")).unionByName(same.withColumn("attempt", F.coalesce("attempt", F.lit(0))))


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every detected entity replaced in its text, and the number
    of them as ``n_entities`` (in place of a column of that name).

    A surrogate follows from the key, the kind and the entity alone, so the same entity
    gets the same one in every document; entities are compared across the
    whole corpus, and those whose surrogates collide, with each other or with an
    entity that occurs, get another. Only those are joined back to their documents.

    Found are mails, keys, accounts, phones, social security and card numbers, addresses, secrets behind one of the words of
    ``_SECRET`` in any case, and names behind one of the titles above, in Latin, Cyrillic or Greek letters; names of
    two or more words also where they stand without title in the same text.

    A null text stays null and has no entities; text between entities is not changed;
    repeated rows are changed alike; an empty table stays empty.
    """
    text = F.col(text_col)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "n_entities")).alias("__row")
    rows = docs.select(row, F.col(id_col).alias("__id"), text_key(text).alias("__key"), F.when(F.rlike(text, F.lit(GATE)), text).alias("__text"))
    rows = with_entities(rows, "__text", "__found", "__gaps")
    some = F.coalesce(F.size("__found") > 0, F.lit(False))
    # The gaps and entities are the text. Each text is searched once and written once.
    rows = rows.select(F.when(some, F.col("__row").withField(text_col, F.lit(None).cast("string"))).otherwise(F.col("__row")).alias("__row"),
                       "__id", "__key", some.alias("__some"), F.when(some, F.col("__found")).alias("__found"), F.when(some, F.col("__gaps")).alias("__gaps"))
    rows = cut(rows, "documents-in-pieces")
    found = rows.where("__some").select("__id", "__key", F.explode("__found").alias("x")).select("__id", "__key", "x.*")
    again = resolve(found, key)
    retried = found.join(again, ["kind", "entity"]).groupBy(F.col("__id").alias("__i"), F.col("__key").alias("__k")).agg(
        F.map_from_entries(F.collect_set(F.struct(F.concat_ws(":", "kind", "entity"), F.struct("as_kind", "attempt")))).alias("__again"))
    retried = cut(retried, "entities-tried-again")
    joined = rows.where("__some").join(retried, [rows["__id"].eqNullSafe(retried["__i"]), rows["__key"] == retried["__k"]], "left")

    def put(x: Column, i: Column) -> Column:
        other = F.col("__again")[F.concat_ws(":", x["kind"], x["entity"])]
        return F.concat(surrogate(key, F.coalesce(other["as_kind"], x["kind"]), x["entity"], F.coalesce(other["attempt"], F.lit(0))), F.get("__gaps", i + 1))

    changed = F.concat(F.get("__gaps", F.lit(0)), F.array_join(F.transform("__found", put), ""))
    changed = joined.select(F.col("__row").withField(text_col, changed).alias("__row"), F.size("__found").cast("long").alias("n_entities"))
    clean = rows.where("not __some").select("__row", F.lit(0).cast("long").alias("n_entities"))
    return clean.unionByName(changed).select("__row.*", "n_entities")
