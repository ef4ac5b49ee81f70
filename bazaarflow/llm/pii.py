"""Personal data spans: patterns propose, checksums confirm, nearby words adjust the score.

Everything is column expressions. A pattern cuts the text into what lies between its matches and the matches themselves;
their lengths, added up in blocks, give the places of all matches. Context is the text within ``NEAR`` code points of a match
that belongs to no other match of its kind. Patterns start only where a run of their characters
starts (or where the last match ended) and never give characters back, so they stay linear on texts of one long run.

Kinds: email, ip, card (Luhn), phone, and iban (length of its country, mod 97). Places count code points, the end is exclusive.
Defined cases: a null text is empty; matches that fail their check are dropped and not tried again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The countries of account numbers by the length of the number.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def iban_form() -> str:
    """Account numbers of their country's length, all in upper or all in lower case; a blank or hyphen may stand between any two characters after the check digits."""
    forms = []
    for case, letters in ((str.upper, "A-Z"), (str.lower, "a-z")):
        for length, countries in IBAN_LENGTHS.items():
            forms.append(f"(?:{'|'.join(case(countries).split())})[0-9]{{2}}(?:[\\x20-]?[{letters}0-9]){{{length - 4}}}")
    return f"(?<![A-Za-z0-9])(?=[A-Za-z]{{2}}[0-9]{{2}})(?:{'|'.join(forms)})(?![A-Za-z0-9])"


# The proposed form of each kind, in the order of kinds, and what a text must hold to have one.
KINDS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    "iban": (iban_form(), None),
}
BASE = ("email", "ip", "card", "phone")

# The score of a confirmed span, and the words near it that raise it.
SCORES = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.6, "iban": 0.9}
CONTEXT = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": "ip|address|host|server|adresse",
    "card": "card|visa|master|credit|karte|tarjeta|carte",
    "phone": "phone|call|tel|mobile|anruf|llama",
    "iban": "iban|account|bank|konto|cuenta|compte",
}
NEAR = 40
BLOCK = 256


def luhn(digits: Column) -> Column:
    """The check of card numbers: from the right, every second digit is doubled and its digits are added."""
    d = F.transform(F.split(F.reverse(digits), ""), lambda c: c.try_cast("int"))
    twice = F.transform(d, lambda x, i: F.when(i % 2 == 0, x).otherwise(x * 2 - F.when(x > 4, 9).otherwise(0)))
    return F.aggregate(twice, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def mod97(code: Column) -> Column:
    """The check of account numbers: the first four characters go last, letters count from ten, the rest by 97 is 1."""
    chars = F.split(F.concat(F.substring(code, 5, 60), F.substring(code, 1, 4)), "")
    value = lambda c: F.when(c.rlike("[0-9]"), c.try_cast("int")).otherwise(F.ascii(c) - 55)
    step = lambda a, c: F.when(c == "", a).otherwise((a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97)
    return F.aggregate(chars, F.lit(0), step) == 1


def confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        # Without leading zeros; of a part of zeros the last one stays.
        part = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
        small = lambda p: F.coalesce(part(p).try_cast("int") <= 255, F.lit(False))
        return F.forall(F.split(match, "\\."), small)
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        return mod97(F.upper(F.regexp_replace(match, "[\\x20-]", "")))
    return F.lit(True)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also where an array function uses it for each element."""
    return F.get(F.transform(F.array(value), body), 0)


def spans(kind: str, text: Column) -> Column:
    """array<struct<start, end, score>> of the confirmed matches of one kind.

    Matches are placed in blocks of ``BLOCK``, so the work on lists stays near linear in the matches of a text.
    """
    pattern, needs = KINDS[kind]
    empty = F.array().cast("array<struct<start:int,end:int,score:double>>")
    cut = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"))

    def one(s: Column):
        def found(match: Column, i: Column) -> Column:
            before, after = F.get(s["gaps"], i), F.get(s["gaps"], i + 1)
            around = F.concat_ws(" ", F.substring(before, -NEAR, NEAR), F.substring(after, 1, NEAR))
            score = F.when(F.lower(around).rlike(CONTEXT[kind]), SCORES[kind] + 0.1).otherwise(SCORES[kind])
            held = F.when(confirmed(kind, match), score)
            return F.struct(F.length(before).alias("gap"), F.length(match).alias("size"), held.alias("score"))

        return F.transform(s["matches"], found)

    def in_block(part: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["gap"]
            end = start + x["size"]
            span = F.array(F.struct(start.alias("start"), end.alias("end"), x["score"].alias("score")))
            return F.struct(end.alias("at"), F.when(x["score"].isNotNull(), F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

        return F.aggregate(part, F.struct(F.lit(0).alias("at"), empty.alias("out")), step)

    def moved(acc: Column, block: Column) -> Column:
        to = lambda x: F.struct((x["start"] + acc["at"]).alias("start"), (x["end"] + acc["at"]).alias("end"), x["score"].alias("score"))
        lists = F.concat(acc["lists"], F.array(F.transform(block["out"], to)))
        return F.struct((acc["at"] + block["at"]).alias("at"), lists.alias("lists"))

    def placed(all_: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int"))
        blocks = F.transform(numbers, lambda b: in_block(F.slice(all_, b * BLOCK + 1, F.lit(BLOCK))))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,end:int,score:double>>>").alias("lists"))
        return F.when(F.size(all_) == 0, empty).otherwise(F.aggregate(blocks, start, moved, lambda acc: F.flatten(acc["lists"])))

    out = let(let(cut, one), placed)
    return F.when(F.contains(text, F.lit(needs)), out).otherwise(empty) if needs else out


def scored(kind: str, found: Column) -> Column:
    """Each span as kind:start:end:score."""
    return F.transform(found, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"], F.format_number(s["score"], 2)))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, one array of spans (start, end, score) for each kind, and the list of all of them as text."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", "text", *[spans(k, F.col("text")).alias(k) for k in KINDS])
    listed = F.concat(*[scored(k, F.col(k)) for k in KINDS])
    return rows.select("doc_id", *KINDS, listed.alias("scored"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans, and all spans as text."""
    listed = lambda k: F.transform(k, lambda s: F.concat_ws(":", F.lit(k), s["start"], s["end"]))
    join = lambda kinds: F.array_join(F.concat(*[listed(k) for k in kinds]), ",")
    return found.select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in BASE],
        F.sha2(join(BASE), 256).alias("base_sha256"),
        join(KINDS).alias("spans"),
        F.array_join("scored", ",").alias("scored"),
    )
